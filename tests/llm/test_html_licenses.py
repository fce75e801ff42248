import math
import re
from collections import Counter

import pytest

from tallyho.llm import html, licenses
from tallyho.llm.common import table
from tallyho.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad banner">Buy   now</div>
<article><h1>Head &amp; title</h1><p>First <b>bold</b>
 part<br>line<p>Second&nbsp;one &lt;tag&gt;<aside>side words</aside><form><input value=">">send</form><p>Third
<div class="comments"><p>reader says</p></div></article><footer>&copy; me</footer></body></html>"""


def test_extracts_the_article():
    learned = html.weights(html.counted([PAGE] * 3))
    assert html.extract(PAGE, learned) == "Head & title\nFirst bold part line\nSecond one <tag>\nThird"
    # without weights one word doesn't outweigh two containers before it
    assert html.extract(PAGE, {}) == "Head & title\nFirst bold part line\nSecond one <tag>"


def test_unmarked_page_uses_learned_places():
    learned = html.weights(html.counted([PAGE] * 3))
    page = PAGE.replace("<article>", "<div>").replace("</article>", "</div>")
    assert html.extract(page, learned) == "Head & title\nFirst bold part line\nSecond one <tag>\nThird"


@pytest.mark.parametrize("page,text", [
    ("", ""), ("plain words", "plain words"), ("<p>cut <b>of", "cut of"), ("<p>cut &am", "cut &am"), ("<p>a</p><p", "a"),
    ("<p>x</b></div></p>y", "x\ny"), ("<!-- only -->", ""), ("<script>1</script>", ""), ("<p>" * 3000 + "deep", "deep")])
def test_odd_pages(page, text):
    assert html.extract(page, {}) == text


WORDS = " ".join(f"word{i}" for i in range(120))
ORDINARY = """<html><head><title>T</title></head>%s<nav><a href="/">Home</a></nav>%s<h1>Heading</h1>
<p>%s</p><p>%s</p>%s<div class="site-footer widget">All rights</div><ul class="related-posts"><li>Other</li></ul></body></html>"""


@pytest.mark.parametrize("body,opens,closes", [
    ('<body class="post-template no-sidebar">', "<article>", "</article>"),
    ("<body>", '<article class="post has-comments">', "</article>"),
    ("<body>", '<article id="social-studies">', "</article>"),
    ("<body>", '<div class="content share-enabled">', "</div>"),
    ("<body>", '<main aria-label="Notice to readers">', "</main>"),
    ("<body id=comments class='promo'>", "<main class=sidebar>", "</main>"),
    ("<body>", '<div class="widget">', "</div>"), ("<body>", "<section id=popup><article>", "</article></section>"),
    ("<body>", "<p title=it's>", "</p>"), ("<body>", '<div data-x="a>b" title=\'c>d\'>', "</div>")])
def test_class_names_of_ordinary_pages(body, opens, closes):
    page = ORDINARY % (body, opens, WORDS, WORDS, closes)
    learned = html.weights(html.counted([PAGE] * 3))
    assert html.extract(page, learned) == f"Heading\n{WORDS}\n{WORDS}"


def test_a_long_discussion_is_no_article():
    page = f"<body><h1>Heading</h1><p>{WORDS}</p><div class='comments'>" + f"<p>{WORDS}</p>" * 9 + "</div></body>"
    assert html.extract(page, html.weights(html.counted([PAGE] * 3))) == f"Heading\n{WORDS}"


def test_articles_in_plain_divisions(spark, sf):
    """Held-out pages whose article is a division with a class no page has: nothing is lost or added."""
    rows = [r.html for r in table(spark, sf, "pages").orderBy("page_id").limit(60).collect()]
    learned = html.weights(html.counted(rows[:30]))
    for page in rows[30:]:
        other = page.replace("<article>", '<div class="entry-body no-comments">').replace("</article>", "</div>")
        assert html.extract(other, learned) == html.extract(page, learned) != ""


@pytest.mark.parametrize("name,hint", [("sidebar", True), ("site-footer", True), ("comment-list", True), ("no-sidebar", False),
                                       ("has-comments", False), ("share-enabled", False), ("main_nav", True), ("studies", False),
                                       ("page-header", False), ("", False)])
def test_hints_are_whole_classes(name, hint):
    assert html.is_hint(name) == hint


def test_unclosed_attributes_take_linear_time():
    assert html.extract("<a " + 'x="y" ' * 50_000, {}) == ""
    assert html.extract("<p " + "x='y\" " * 50_000 + ">end", {}).endswith("end")


def test_best_run_by_brute_force():
    import random

    rng = random.Random(2)
    for _ in range(500):
        s = [rng.randrange(-4, 5) for _ in range(rng.randrange(0, 12))]
        a, b = html.best_run(s)
        most = max([0] + [sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)])
        assert sum(s[a:b]) == most and (most > 0 or (a, b) == (0, 0))


def test_html_query(spark, sf):
    pages = {r.page_id: r for r in table(spark, sf, "pages").collect()}
    got = QUERIES["op5_html_extraction"](spark, sf).collect()
    assert len(got) == len(pages)
    from html import unescape
    for r in got:
        body = re.sub(r"<[^>]*$", "", pages[r.page_id].html.split("<article>")[1].split("</article>")[0])
        blocks = (" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_html_edge_cases(spark):
    pages = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, PAGE, "x"), (3, PAGE, "x")],
                                  "page_id bigint, html string, text string")
    got = html.main_text(pages, html.fit(pages), "html", "page_id").orderBy("page_id").collect()
    assert [r.text for r in got[:2]] == ["", ""] and got[2] == got[3]
    assert html.fit(pages.limit(0)) == {} and html.main_text(pages.limit(0), {}, "html", "page_id").count() == 0


TERM = re.compile(r"[0-9]+(?:\.[0-9]+)*|[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def scanned(files):
    """path -> (own, score, licence, directory) by direct computation."""
    known = licenses.templates()
    df = Counter(t for _, text in known for t in set(TERM.findall(text.lower())))
    cue = set(licenses.all_cues(known))

    def vector(text):
        return {t: c * (math.log((len(known) + 1) / (df[t] + 1)) if t in df else licenses.UNKNOWN)
                for t, c in Counter(TERM.findall(text.lower())).items()}

    def cosine(a, b):
        norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(a[t] * b.get(t, 0) for t in a) / norm if norm else 0

    templates = [(k, vector(v), set(own)) for (k, v), own in zip(known, licenses.cues(known))]
    own, grants = {}, {}
    for path, text in files:
        name, text = path.rsplit("/", 1)[-1], text or ""
        lines = text.split("\n")
        passages = {" ".join(lines[max(i - a, 0):i + b + 1]) for i, line in enumerate(lines) if cue & set(TERM.findall(line.lower()))
                    for a in (0, 1) for b in (0, 1)}
        if passages and re.search(licenses.LICENCE_FILE, name):
            passages.add(text)
        found = [(-round(cosine(vector(p), v), 6), k) for p in passages for k, v, c in templates
                 if c & set(vector(p))]
        found = [f for f in found if -f[0] >= licenses.COSINE]
        if found:
            own[path] = min(found)
            if re.search(licenses.LICENCE_FILE, name) and "/" in path:
                d = path.rsplit("/", 1)[0]
                grants[d] = min(grants.get(d, (0, "~", "")), (min(found)[0], path, min(found)[1]))
    out = {}
    for path, _ in files:
        parts = path.split("/")[:-1]
        dirs = ["/".join(parts[:k]) for k in range(len(parts), 0, -1)]
        near = next((d for d in dirs if d in grants), None)
        mine = own.get(path)
        out[path] = (mine and mine[1], mine and -mine[0], mine[1] if mine else near and grants[near][2],
                     None if mine else near)
    return out


FILES = [
    ("a/LICENSE", "Released under the MIT License."), ("a/b/COPYING", "This work is licensed under the GNU General Public "
                                                                      "License, version 3.\nmore"),
    ("a/b/c/x.py", "code\n# Licensed under the Apache License, Version 2.0.\n"), ("a/b/c/y.py", "no header"), ("a/z.py", None),
    ("a/b2/q", ""), ("top", "Licensed under CC BY-NC 4.0."), ("ab/c", "licence unknown to all"), ("a/b/LICENSE-2", "words"),
    ("a/NOTICE", "Released under the ISC License."), ("d/LICENSE", "x " * 50_000 + "\nReleased under the MIT License.")]


def test_license_scan_by_brute_force(spark):
    rows = spark.createDataFrame([(p, t, 1, "x") for p, t in FILES], "path string, text string, score int, directory string")
    got = licenses.scan(rows).collect()
    assert {r.path: (r.own_licence, r.score, r.licence, r.from_directory) for r in got} == \
        {p: pytest.approx(v) if v[1] is None else (v[0], pytest.approx(v[1], abs=2e-6), *v[2:]) for p, v in scanned(FILES).items()}
    assert {r.path: r.licence for r in got}["a/b/c/y.py"] == "GPL-3.0"


@pytest.mark.parametrize("text,licence", [
    ("Copyright (c) 2021 Jane Doe. Released under the MIT License.", "MIT"), ("SPDX-License-Identifier: MIT", "MIT"),
    ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("This file is distributed under the MIT license, see LICENSE for details", "MIT"),
    (" * it under the terms of the GNU General Public License as published by", "GPL-3.0"),  # no version: the closest
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation "
     "files (the \"Software\"), to deal", "MIT"),
    ("# This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as "
     "published by\n# the Free Software Foundation; either version 2 of the License, or", "GPL-2.0"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\");", "Apache-2.0"),
    ("This Source Code Form is subject to the terms of the Mozilla\nPublic License, v. 2.0.", "MPL-2.0"),
    ("The licence of poets is not granted to all.", None), ("under the terms of the treaty", None), ("a plain line of text", None)])
def test_headers_are_found_wherever_they_stand(spark, text, licence):
    """The score is that of the passage: it doesn't depend on what else the file or the table holds."""
    body = "\n".join(["import os", "x = 1"] * 20)
    files = [("a/one.py", text), ("b/two.py", f"{body}\n{text}\n{body}")] + [(f"c/{i}", f"word{i} other") for i in range(50)]
    rows = {r.path: r for r in licenses.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert rows["a/one.py"].own_licence == rows["b/two.py"].own_licence == licence
    alone = licenses.scan(spark.createDataFrame(files[:1], "path string, text string")).first()
    assert alone.score == rows["a/one.py"].score


def test_every_template_has_its_cues():
    known = licenses.templates()
    assert all(set(own) & set(TERM.findall(text.lower())) for (_, text), own in zip(known, licenses.cues(known)))
    assert len(licenses.all_cues(known)) < 80


def test_documents_inherit(spark):
    from tests.conftest import SF_ORACLE

    rows = QUERIES["op8_license_scan"](spark, SF_ORACLE)
    own, inherited = rows.where("own_licence IS NOT NULL").count(), rows.where("from_directory IS NOT NULL")
    depths = {len(r.from_directory.split("/")) for r in inherited.select("from_directory").distinct().collect()}
    assert own > 20 and inherited.count() > 50 and len(depths) > 1
    assert inherited.where("licence IS NULL OR own_licence IS NOT NULL").isEmpty()


def test_passages_that_cannot_reach_the_cosine_are_not_stored(spark):
    """A cue in plain prose is no passage; one that can be near a template is, with both neighbours or none."""
    prose = "\n".join(["a letter sent by a friend to the house on the hill"] * 20)
    files = [("a", "a", prose), ("b", "b", prose + "\nReleased under the MIT License.")]
    rows = licenses.passages(spark.createDataFrame(files, "file string, name string, text string"), licenses.templates()).collect()
    assert {r.file for r in rows} == {"b"} and "Released under the MIT License." in {r.text for r in rows}


def test_license_edge_cases(spark):
    schema = "path string, text string"
    assert licenses.scan(spark.createDataFrame([], schema)).count() == 0
    got = licenses.scan(spark.createDataFrame([(None, "Released under the MIT License."), ("a/f", None), ("a/f", None)], schema))
    assert sorted((r.path or "", r.licence) for r in got.collect()) == [("", None), ("a/f", None), ("a/f", None)]
