"""License scans: sparse TF-IDF cosine to templates, then directory inheritance (DataFrame functions only).

Templates are headers, notices, permission texts and SPDX tags, several for each licence
(``templates``).  Term weights are tf * idf with idf = ln((templates + 1) / (templates with the term + 1));
a term that no template has weighs ``UNKNOWN``, so a score doesn't depend on the other files.

A file's passages are its lines with a cue, each alone and with the line before, behind
or both (headers are wrapped), and the whole text of a licence file (by its name).  Cues are no
list of words but the two heaviest terms of each template (``cues``): a passage that holds neither of
them isn't compared with it, nor is one that can't reach ``COSINE`` by its number of terms and those that
the templates have (a bound, so no result changes): only passages that can are stored.  The closest template at ``COSINE`` or more is the file's own licence.

A file without an own licence inherits from the nearest ancestor directory with a
licence file: each directory's ancestors are joined with the directories of licence
files, and the deepest one counts; files meet their directory's result last, so the
ancestor join has a row per directory, not per file.

Defined cases: a null or empty text has no licence of its own but may inherit; a null
path is in no directory; ties go to the smallest licence name; of several licence
files in a directory the most similar counts, then the smallest path; equal rows get
equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyho.llm.common import materialize

COSINE = 0.55
UNKNOWN = 0.3
LICENCE_FILE = "(?i)^(licen[cs]e|copying|notice)([-._].*)?$"

#: Licences by their SPDX identifier, and the names that notices use.
NAMES = {
    "AGPL-3.0": "GNU Affero General Public License, version 3", "Apache-2.0": "Apache License, Version 2.0",
    "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License", "CC-BY-4.0": "CC BY 4.0",
    "CC-BY-NC-4.0": "CC BY-NC 4.0", "CC-BY-SA-4.0": "CC BY-SA 4.0", "CC0-1.0": "CC0 1.0",
    "GPL-2.0": "GNU General Public License, version 2", "GPL-3.0": "GNU General Public License, version 3", "ISC": "ISC License",
    "LGPL-3.0": "GNU Lesser General Public License, version 3", "MIT": "MIT License",
    "MPL-2.0": "Mozilla Public License, version 2.0",
}

#: Headers and permission texts of the licences.
TEXTS = [
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "under the BSD 3-Clause License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

#: How notices name a licence.
NOTICES = ("Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "Licensed under {}.",
           "This work is subject to the terms of the {}.", "This file is distributed under the {}.")


def templates() -> list[tuple[str, str]]:
    """``(licence, text)`` of all templates, in order."""
    named = [(licence, notice.format(name)) for licence, name in NAMES.items() for notice in NOTICES]
    return sorted({*named, *TEXTS, *((x, f"SPDX-License-Identifier: {x}") for x in NAMES)})


_TERM = re.compile(r"[0-9]+(?:\.[0-9]+)*|[a-z]+[a-z0-9]*")  # as ``terms`` finds them in these ASCII texts


def weights(known: list[tuple[str, str]]) -> dict[str, float]:
    """idf of every term of the templates."""
    found = Counter(t for _, text in known for t in set(_TERM.findall(text.lower())))
    return {t: math.log((len(known) + 1) / (n + 1)) for t, n in sorted(found.items())}


def cues(known: list[tuple[str, str]]) -> list[list[str]]:
    """Of each template the two heaviest terms (then the longest, then the first) that weigh more than 1, of three letters
    or more, or else of two."""
    idf, out = weights(known), []
    for _, text in known:
        words = [t for t in set(_TERM.findall(text.lower())) if t[0].isalpha() and idf[t] > 1]
        pool = [t for t in words if len(t) > 2] or [t for t in words if len(t) > 1]
        out.append(sorted(pool, key=lambda t: (-idf[t], -len(t), t))[:2])
    return out


def all_cues(known: list[tuple[str, str]]) -> list[str]:
    return sorted({t for own in cues(known) for t in own})


def terms(text: Column) -> Column:
    """Lower-cased runs of letters and digits, dots inside numbers kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([0-9]+(?:\.[0-9]+)*|[^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), 1)


def _vectors(rows: DataFrame, key: list[str], idf: DataFrame) -> DataFrame:
    """``key, term, weight`` of the vectors of ``rows`` (key, text)."""
    counts = (rows.select(*key, F.explode(terms(F.col("text"))).alias("term"))
              .groupBy(*key, "term").agg(F.count(F.lit(1)).alias("tf")))
    return (counts.join(F.broadcast(idf), "term", "left")  # a row per template term
            .withColumn("weight", F.col("tf") * F.coalesce("idf", F.lit(UNKNOWN))).drop("tf", "idf"))


def _word(cue: list[str]) -> str:
    """A pattern found in every lower-cased text that has one of these terms (and in few others)."""
    by_first: dict[str, list[str]] = {}
    for t in cue:
        by_first.setdefault(t[0], []).append(t[1:])
    words = "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in sorted(by_first.items()))
    return rf"(?<![^\x00-\x60\x7B-\x7F])(?:{words})(?![^\x00-\x2F\x3A-\x60\x7B-\x7F])"


def _shares(known: list[tuple[str, str]]) -> list[list[tuple[str, float, float]]]:
    """``(term, idf, share of the unit vector)`` of each template."""
    idf, out = weights(known), []
    for _, text in known:
        tf = Counter(_TERM.findall(text.lower()))
        length = math.sqrt(sum((n * idf[t]) ** 2 for t, n in tf.items()))
        out.append([(t, idf[t], n * idf[t] / length) for t, n in sorted(tf.items())])
    return out


def _possible(found: Column, n: Column, known: list[tuple[str, str]], cosine: float) -> Column:
    """Whether a passage of ``n`` terms, of which ``found`` are terms of the templates, can reach ``cosine`` with a template
    of which it has a cue: its vector is at least as long as that template's terms and the unknown ones make it."""
    entries, shares = {}, _shares(known)
    for own, terms_of in zip(cues(known), shares):
        for c in own:
            entries.setdefault(c, []).append(terms_of)
    kind = "map<string,array<array<struct<term:string,idf:double,share:double>>>>"
    by_cue = F.from_json(F.lit(json.dumps({c: [[dict(zip(("term", "idf", "share"), t)) for t in terms_of] for terms_of in e]
                                           for c, e in sorted(entries.items())})), kind)
    some = F.flatten(F.filter(F.transform(F.array_distinct(found), lambda t: by_cue[t]), lambda e: e.isNotNull()))
    zero = F.struct(F.lit(0.0).alias("dot"), F.lit(0.0).alias("square"))
    unknown = UNKNOWN * UNKNOWN * (n - F.size(found))
    least = max(cosine - 1e-6, 0) ** 2 * (1 - 1e-9)

    def add(sums: Column, t: Column) -> Column:
        tf = F.size(F.filter(found, lambda x: x == t["term"]))
        return F.struct((sums["dot"] + tf * t["idf"] * t["share"]).alias("dot"),
                        (sums["square"] + tf * t["idf"] * tf * t["idf"]).alias("square"))

    return F.exists(some, lambda e: F.aggregate(
        e, zero, add, lambda sums: sums["dot"] * sums["dot"] >= least * (sums["square"] + unknown) - 1e-9))


def passages(files: DataFrame, known: list[tuple[str, str]], cosine: float = COSINE) -> DataFrame:
    """``file, text``: lines with a cue and their neighbours, and whole licence files (file, name, text), but for
    those that can't reach ``cosine``."""
    cue = F.lit(all_cues(known))
    vocabulary = F.lit(sorted(weights(known)))
    some = files.where(F.lower("text").rlike(_word(all_cues(known))))  # most files have none
    # Terms end with their line: a passage's are those of its lines, found once.
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text"), terms(x).alias("terms")))
    lines = F.transform(lines, lambda x: F.struct(x["text"].alias("text"), x["terms"].alias("terms"),
                                                  F.array_intersect(x["terms"], vocabulary).alias("met")))
    lines = F.transform(lines, lambda x: F.struct(
        x["text"].alias("text"), F.size(x["terms"]).alias("n"), F.arrays_overlap(x["met"], cue).alias("cue"),
        F.filter(x["terms"], lambda t: F.array_contains(x["met"], t)).alias("found")))
    rows = some.select("file", "name", F.explode(F.array(lines)).alias("lines"))  # a row each: the lines are computed once
    rows = rows.where(F.exists("lines", lambda x: x["cue"]))
    at = F.filter(F.sequence(F.lit(1), F.size("lines")), lambda i: F.get("lines", i - 1)["cue"])
    around = F.array(*[F.struct(F.lit(a).alias("before"), F.lit(b).alias("behind")) for a in (0, 1) for b in (0, 1)])

    def window(i: Column, w: Column) -> Column:
        first = F.greatest(i - w["before"], F.lit(1))
        return F.struct(first.alias("first"), (F.least(i + w["behind"], F.size("lines")) - first + 1).alias("length"))

    windows = F.flatten(F.transform(at, lambda i: F.transform(around, lambda w: window(i, w))))
    bounds = F.array_distinct(windows)
    bounds = F.transform(bounds, lambda w: F.struct(F.slice("lines", w["first"], w["length"]).alias("lines"), F.lit(" ").alias("by")))
    bounds = F.concat(bounds, F.when(F.col("name").rlike(LICENCE_FILE), F.array(F.struct(F.col("lines"), F.lit("\n").alias("by"))))
                      .otherwise(F.array().cast("array<struct<lines:array<struct<text:string,n:int,cue:boolean,found:array<string>>>,by:string>>")))
    parts = F.filter(
        F.transform(bounds, lambda p: F.struct(
            p["lines"].alias("lines"), p["by"].alias("by"), F.flatten(F.transform(p["lines"], lambda x: x["found"])).alias("found"),
            F.aggregate(p["lines"], F.lit(0), lambda n, x: n + x["n"]).alias("n"))),
        lambda p: _possible(p["found"], p["n"], known, cosine))
    texts = F.transform(parts, lambda p: F.when(p["by"] == " ", F.array_join(p["lines"]["text"], " "))
                        .otherwise(F.array_join(p["lines"]["text"], "\n")))
    return rows.select("file", F.explode(F.array_distinct(texts)).alias("text"))


def own_licences(files: DataFrame, known: list[tuple[str, str]] | None = None, cosine: float = COSINE) -> DataFrame:
    """``file, licence, score`` of those files (file, name, text) that have a licence of their own."""
    spark = files.sparkSession
    known = templates() if known is None else known
    idf = spark.createDataFrame(list(weights(known).items()), "term string, idf double")
    texts = spark.createDataFrame([(i, name, text, own) for i, ((name, text), own) in enumerate(zip(known, cues(known)))],
                                  "entry int, template string, text string, cues array<string>")
    target = _vectors(texts, ["entry", "template", "cues"], idf)
    size = target.groupBy("entry").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    target = F.broadcast(target.join(size, "entry").select(
        "entry", "template", "term", (F.col("weight") / F.col("length")).alias("share"),
        F.array_contains("cues", F.col("term")).alias("cue")))
    found = materialize(passages(files, known, cosine).withColumn("passage", F.md5(F.col("text").cast("binary"))), "licence-passages")
    # Equal passages, however many files repeat them, are compared once.
    vectors = _vectors(found.select("passage", "text").dropDuplicates(["passage"]), ["passage"], idf)
    length = vectors.groupBy("passage").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    likeness = (vectors.join(target, "term").groupBy("passage", "entry", "template")
                .agg(F.sum(F.col("weight") * F.col("share")).alias("dot"), F.max("cue").alias("cue")).where("cue").join(length, "passage")
                .select("passage", "template", F.round(F.col("dot") / F.col("length"), 6).alias("score")))
    best = (likeness.where(F.col("score") >= cosine).groupBy("passage")
            .agg(F.min(F.struct((-F.col("score")).alias("less"), "template")).alias("best")))
    return (found.join(best, "passage").groupBy("file").agg(F.min("best").alias("best"))
            .select("file", F.col("best.template").alias("licence"), (-F.col("best.less")).alias("score")))


def scan(files: DataFrame, path: str = "path", text: str = "text", known: list[tuple[str, str]] | None = None,
         cosine: float = COSINE, *keep: str) -> DataFrame:
    """The ``keep`` columns, ``path, own_licence, score, licence, from_directory`` of every file;
    ``from_directory`` is null unless the licence is inherited."""
    inner = files.select(*keep, F.col(path).alias("file"), F.col(text).alias("text"))
    rows = inner.select(*keep, "file", F.substring_index("file", "/", -1).alias("name"),
                        F.when(F.instr("file", "/") > 0, F.regexp_replace("file", "/[^/]*$", "")).alias("directory"), "text")
    own = materialize(own_licences(rows.where("file IS NOT NULL").select("file", "name", "text"), known, cosine), "licence-own")
    names = materialize(rows.drop("text").join(own, "file", "left"), "licence-files")
    granted = (names.where(F.col("name").rlike(LICENCE_FILE) & F.col("licence").isNotNull() & F.col("directory").isNotNull())
               .groupBy(F.col("directory").alias("ancestor"))
               .agg(F.min(F.struct((-F.col("score")).alias("less"), "file", "licence")).alias("grant"))
               .select("ancestor", F.col("grant.licence").alias("granted")))
    parts = F.split("directory", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(
        F.array_join(F.slice(parts, 1, k), "/").alias("ancestor"), k.alias("depth")))
    nearest = (names.where("directory IS NOT NULL").select("directory").distinct()
               .select("directory", F.explode(ancestors).alias("a")).select("directory", "a.ancestor", "a.depth")
               .join(granted, "ancestor").groupBy("directory")
               .agg(F.max(F.struct("depth", "ancestor", "granted")).alias("n"))
               .select("directory", F.col("n.ancestor").alias("nearest"), F.col("n.granted").alias("granted")))
    found = names.join(nearest, "directory", "left")
    return found.select(*keep, F.col("file").alias("path"), F.col("licence").alias("own_licence"), "score",
                        F.coalesce("licence", "granted").alias("licence"),
                        F.when(F.col("licence").isNull(), F.col("nearest")).alias("from_directory"))
