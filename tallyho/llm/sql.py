"""DuckDB SQL for those queries that SQL can express, by the same definitions."""

from __future__ import annotations

from tallyho.llm.licenses import COSINE, LICENCE_FILE, UNKNOWN, all_cues, cues, templates

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TEST_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_PLAIN_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_TEST_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_TEST_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, list_slice(w, s, s + least(13, len(w)) - 1) AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(win) AS n FROM iw),
dw AS (SELECT doc_id, s, n, list_slice(w, s, s + n - 1) AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, s, n, item_id FROM dw JOIN iw USING (win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""

MIXING = f"""
WITH d AS (SELECT doc_id, source, CAST(len({_PLAIN_WORDS}) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2 ELSE 1 END AS w
      FROM d GROUP BY source),
c AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total,
             row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, source) AS k FROM s),
r AS (SELECT *, sum(cap) OVER below AS used, sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
      FROM c WINDOW below AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT (total - coalesce(used, 0)) / free AS level FROM r
      WHERE (total - coalesce(used, 0)) / free < cap / w ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(cap, w * (SELECT level FROM l)) AS target FROM c),
o AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS e,
             ('0x' || substr(md5(concat_ws('|', '7', 'offset', coalesce(d.source, ''))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u,
             row_number() OVER (PARTITION BY d.source ORDER BY d.size,
                 ('0x' || substr(md5(concat_ws('|', '7', d.doc_id)), 1, 8))::BIGINT, d.doc_id) - 1 AS k
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST((floor(u + e * (k + 1)) - floor(u + e * k)) * size AS BIGINT) AS taken FROM o"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
win AS (SELECT doc_id, s, list_slice(w, s, s + 12) AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13)),
f AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM win JOIN f USING (g) WHERE m < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS k
         FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
g AS (SELECT count(*) FILTER (len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS length FROM d),
i AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
t AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight
      FROM p, g GROUP BY term, docs),
m AS (SELECT r, doc_id, 25 + (75 * len(w) * docs) // length AS m FROM d, g WHERE len(w) > 0),
s AS (SELECT item_id, r, CAST(sum(q * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM i JOIN p USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM s JOIN m USING (r) WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 10"""

# CRC-32 from its polynomial; a run's bytes are those of ASCII and of U+00C0 to U+00FF.
VARIANTS = f"""
WITH RECURSIVE bits AS (SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
                unnest(regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[a-z\u00C0-\u00FF]+')) AS run FROM documents),
pairs AS (SELECT id, run, count(*) AS n FROM runs WHERE len(run) >= 6 GROUP BY ALL),
bytes AS (SELECT run, n, flatten([CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [195, unicode(ch)::BIGINT - 64] END
                                  FOR ch IN string_split(id || ':' || run, '')]) AS b FROM pairs),
hashed AS (SELECT run, n, xor(4294967295::BIGINT, list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT)) AS h
           FROM bytes, crc),
slips AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word, n FROM hashed),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slips WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM v)),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
         UNION SELECT l.word, s.word, s.n FROM less l JOIN v s ON l.rest = s.word
         UNION SELECT s.word, l.word, l.n FROM less l JOIN v s ON l.rest = s.word),
best AS (SELECT word, count(*) AS n_near, min((-other_n, other)) AS b FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b[1] >= 5 * n THEN b[2] END AS form,
             CASE WHEN -b[1] >= 5 * n THEN -b[1] END AS form_n FROM v LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM v UNION ALL SELECT c.word, f.form FROM chain c JOIN f ON c.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM f JOIN chain c USING (word) JOIN f l ON c.root = l.word WHERE l.form IS NULL"""


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_sql(folder_rows: int, licence_line: str) -> str:
    known = templates()
    def array(words: list[str]) -> str:
        return "[" + ", ".join(_literal(w) for w in words) + "]"

    values = ", ".join(f"({i}, {_literal(k)}, {_literal(v)}, {array(own)})" for i, ((k, v), own) in enumerate(zip(known, cues(known))))
    cue = array(all_cues(known))
    terms = r"regexp_extract_all(lower({}), '[0-9]+(?:\.[0-9]+)*|[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH t(entry, template, text, cues) AS (VALUES {values}),
s AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '-') AS source, coalesce(lang, '-') AS lang,
             CASE WHEN regexp_matches(coalesce(text, ''), {_literal(licence_line)}) THEN doc_id % 3 END AS depth FROM documents),
f AS (SELECT doc_id, text, CASE WHEN depth IS NULL THEN CAST(doc_id AS VARCHAR) ELSE 'LICENSE-' || doc_id END AS name,
             source || CASE WHEN coalesce(depth, 2) >= 1 THEN '/' || lang ELSE '' END
             || CASE WHEN coalesce(depth, 2) >= 2 THEN '/' || CAST(doc_id // {folder_rows} AS VARCHAR) ELSE '' END AS dir FROM s),
tv AS (SELECT entry, template, term, list_contains(cues, term) AS cue, count(*) AS tf
       FROM (SELECT entry, template, cues, unnest({terms.format('text')}) AS term FROM t) GROUP BY ALL),
idf AS (SELECT term, ln({len(known) + 1}::DOUBLE / (count(*) + 1)) AS idf FROM tv GROUP BY term),
tw AS (SELECT entry, template, term, cue, tf * idf AS w FROM tv JOIN idf USING (term)),
tn AS (SELECT entry, sqrt(sum(w * w)) AS n FROM tw GROUP BY entry),
l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM f WHERE list_has_any({terms.format('text')}, {cue})),
c AS (SELECT doc_id, l, i FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM l) WHERE list_has_any({terms.format('l[i]')}, {cue})),
p AS (SELECT DISTINCT doc_id, passage FROM (
        SELECT doc_id, array_to_string(list_slice(l, greatest(i - a, 1), least(i + b, len(l))), ' ') AS passage
        FROM c, (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) x(a, b)
        UNION ALL SELECT doc_id, text FROM f JOIN l USING (doc_id) WHERE regexp_matches(name, {_literal(LICENCE_FILE)}))),
q AS (SELECT DISTINCT passage FROM p),
pw AS (SELECT passage, term, count(*) * coalesce(any_value(idf), {UNKNOWN}::DOUBLE) AS w
       FROM (SELECT passage, unnest({terms.format('passage')}) AS term FROM q) LEFT JOIN idf USING (term) GROUP BY passage, term),
pn AS (SELECT passage, sqrt(sum(w * w)) AS n FROM pw GROUP BY passage),
sc AS (SELECT passage, template, round(sum(pw.w * tw.w) / any_value(pn.n) / any_value(tn.n), 6) AS score
       FROM pw JOIN tw USING (term) JOIN tn USING (entry) JOIN pn USING (passage)
       GROUP BY passage, entry, template HAVING bool_or(cue)),
own AS (SELECT doc_id, template, score FROM p JOIN sc USING (passage) WHERE score >= {COSINE}
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, template) = 1),
g AS (SELECT dir, template FROM f JOIN own USING (doc_id) WHERE regexp_matches(name, {_literal(LICENCE_FILE)})
      QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, dir || '/' || name) = 1),
nearest AS (SELECT d.dir, g.dir AS anc, g.template FROM (SELECT DISTINCT dir FROM f) d
            JOIN g ON d.dir = g.dir OR starts_with(d.dir, g.dir || '/')
            QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY len(g.dir) DESC) = 1)
SELECT doc_id, f.dir || '/' || name AS path, own.template AS own_licence, score,
       coalesce(own.template, nearest.template) AS licence, CASE WHEN own.template IS NULL THEN anc END AS from_directory
FROM f LEFT JOIN own USING (doc_id) LEFT JOIN nearest ON f.dir = nearest.dir"""
