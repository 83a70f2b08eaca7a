"""DuckDB SQL for the queries that SQL can express, from the operators' parameters."""

from __future__ import annotations

from .decontaminate import Search
from .line_dedup import Spread
from .mixing import Mix
from .quality_rules import CLASSES, WORDS, Rules

WHITE = r"[\x20\x09-\x0D]"
DARK = r"[^\x20\x09-\x0D]"


def line_dedup(s: Spread = Spread()) -> str:
    ok = rf"'^{WHITE}*({DARK}+{WHITE}+){{{s.min_words - 1}}}{DARK}'"
    bare = rf"regexp_replace(l, '^{WHITE}+|{WHITE}+$', '', 'g')"
    return rf"""
WITH lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
seen AS (SELECT *, {bare} AS k, regexp_matches(l, {ok}) AS ok FROM lines),
bad AS (SELECT k, min(doc_id) AS first_id FROM seen WHERE ok GROUP BY k HAVING count(DISTINCT source) >= {s.min_sites}),
marked AS (SELECT seen.*, bad.k IS NOT NULL AND doc_id <> first_id AS gone FROM seen LEFT JOIN bad ON seen.ok AND seen.k = bad.k),
left_ AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '') AS clean FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, md5(CASE WHEN d.text IS NULL THEN NULL ELSE clean END) AS clean_md5
FROM documents d LEFT JOIN left_ USING (doc_id)
"""


def decontaminate(s: Search = Search()) -> str:
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')"
    w = s.window
    windows = lambda t, key: f"SELECT {key}, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k FROM (SELECT {key}, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM {t})"
    return rf"""
WITH items AS (SELECT item_id, {words} AS w FROM benchmark),
sized AS (SELECT item_id, w, least({w}, len(w)) AS n FROM items WHERE len(w) > 0),
wanted AS (SELECT DISTINCT item_id, n, k FROM ({windows("sized", "item_id")})),
docs AS (SELECT doc_id, {words} AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM wanted),
cut AS (SELECT doc_id, w, n FROM docs, lengths WHERE len(w) >= n),
found AS (SELECT doc_id, item_id, i, x.n FROM ({windows("cut", "doc_id")}) x JOIN wanted USING (n, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(h, sha256('')) AS items_sha256, coalesce(n_items, 0) >= {s.min_items} AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def mix(m: Mix = Mix()) -> str:
    weights = "[" + ", ".join(str(float(w)) for w in m.weights) + "]"
    return rf"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{DARK}+'))::BIGINT AS size,
    -ln((('0x' || md5('{m.seed}:' || doc_id::VARCHAR)[:13])::BIGINT + 0.5::DOUBLE) / {float(2**52)!r}::DOUBLE)
      / greatest(0.1::DOUBLE, 1 - 5.0::DOUBLE * len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) / greatest(length(coalesce(text, '')), 1)) AS key
  FROM documents),
a AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
b AS (SELECT *, {weights}[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(m.weights)}]::DOUBLE AS weight, source_size * {float(m.max_epochs)}::DOUBLE AS cap FROM a),
c AS (SELECT *, cap / weight AS ratio,
  (sum(source_size) OVER () * {m.share}::DOUBLE - coalesce(sum(cap) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM b WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT level AS common FROM c WHERE ratio > level ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, round(least(cap, coalesce(weight * (SELECT common FROM f), cap)), 6) AS target FROM c),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
  coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sizes s JOIN e ON s.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (size * (epochs + CASE WHEN before + size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM p
"""


def warc(min_payload: int = 0) -> str:
    five = "list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + (((('0x' || (h || '00')[(i * 5) // 4 + 1 : (i * 5) // 4 + 2])::INT) >> (3 - (i * 5) % 4)) & 31)])"
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x FROM pages),
s AS (SELECT page_id, strlen(x)::BIGINT AS payload_bytes, sha1(x) AS h, CASE WHEN strlen(x) >= {min_payload} THEN min(page_id) OVER (PARTITION BY x) ELSE page_id END AS first_id FROM p)
SELECT page_id, payload_bytes, array_to_string({five}, '') AS payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to FROM s
"""


def quality_rules(r: Rules = Rules()) -> str:
    width = r.window
    listed = ", ".join(f"'{w}'" for w in WORDS)
    count = lambda p: f"len(regexp_extract_all(t, '{p}'))"
    patterns = ["[a-z]", WHITE] + [p.replace("'", "''") for _, p in CLASSES]
    classes = ", ".join(f"{count(p)} AS c{i}" for i, p in enumerate(patterns))
    n = len(patterns)
    rest = " - ".join(f"c{i}" for i in range(n))
    half = lambda x, y: f"((CASE WHEN {x} > 0 THEN {x} * log2({x} / (({x} + {y}) / 2)) ELSE 0 END) + (CASE WHEN {y} > 0 THEN {y} * log2({y} / (({x} + {y}) / 2)) ELSE 0 END)) / 2"
    sums = lambda a: " + ".join(f"{a}.c{i}" for i in range(n + 1))
    class_terms = " + ".join(half(f"(d.c{i}::DOUBLE / nullif({sums('d')}, 0))", f"(r.c{i}::DOUBLE / nullif({sums('r')}, 0))") for i in range(n + 1))
    return rf"""
WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{DARK}+') AS ws FROM documents),
d0 AS (SELECT doc_id, lang, t, ws, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, {count("[#*$%&|<>]")}::BIGINT AS n_symbols, {classes},
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{DARK}')) AS ls FROM w),
d AS (SELECT *, (length(t) - {rest})::BIGINT AS c{n}, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines FROM d0),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + {width - 1}), ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {width} + 2)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) >= 2),
cov AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n FROM (SELECT doc_id, unnest(range(i, i + {width})) AS p FROM rep) GROUP BY doc_id),
own AS (SELECT doc_id, lang, x, count(*) AS n FROM (SELECT doc_id, lang, unnest(ws) AS x FROM w) WHERE x IN ({listed}) GROUP BY ALL),
per AS (SELECT lang, sum(n_words) AS total, {", ".join(f"sum(c{i}) AS c{i}" for i in range(n + 1))} FROM d GROUP BY lang),
r0 AS (SELECT lang AS k, true AS named, total, {", ".join(f"c{i}" for i in range(n + 1))} FROM per WHERE lang IS NOT NULL AND total >= {r.min_reference_words}
  UNION ALL SELECT NULL, false, {", ".join(["sum(total)"] + [f"sum(c{i})" for i in range(n + 1)])} FROM per),
rw AS (SELECT lang AS k, true AS named, x, sum(n) AS n FROM own WHERE lang IS NOT NULL GROUP BY ALL UNION ALL SELECT NULL, false, x, sum(n) FROM own GROUP BY x),
pick AS (SELECT d.doc_id, d.lang, d.n_words, CASE WHEN EXISTS (SELECT 1 FROM r0 WHERE named AND k = d.lang) THEN d.lang END AS k FROM d),
shares AS (SELECT p.doc_id, o.n::DOUBLE / p.n_words AS x, coalesce(rw.n, 0)::DOUBLE / r0.total AS y FROM pick p JOIN own o USING (doc_id)
  JOIN r0 ON r0.k IS NOT DISTINCT FROM p.k LEFT JOIN rw ON rw.k IS NOT DISTINCT FROM p.k AND rw.x = o.x),
known AS (SELECT k, sum(n) AS n FROM rw GROUP BY k),
js AS (SELECT doc_id, sum({half("x", "y")}) AS dv, sum(x) AS sx, sum(y) AS sy FROM shares GROUP BY doc_id),
wd AS (SELECT p.doc_id, coalesce(dv, 0) AS dv, 1 - coalesce(sx, 0) AS x, 1 - coalesce(kn.n, 0)::DOUBLE / r0.total AS y, coalesce(kn.n, 0)::DOUBLE / r0.total - coalesce(sy, 0) AS z
  FROM pick p JOIN r0 ON r0.k IS NOT DISTINCT FROM p.k LEFT JOIN known kn ON kn.k IS NOT DISTINCT FROM p.k LEFT JOIN js USING (doc_id)),
wdist AS (SELECT doc_id, round(sqrt(greatest(0, dv + {half("x", "y")} + z / 2)), 6) AS v FROM wd),
cdist AS (SELECT d.doc_id, round(sqrt(greatest(0, {class_terms})), 6) AS v FROM d JOIN pick p USING (doc_id) JOIN r0 r ON r.k IS NOT DISTINCT FROM p.k),
f AS (SELECT d.doc_id, d.n_words, word_chars, n_symbols, n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
  CASE WHEN length(t) >= {r.min_chars} THEN cdist.v END AS class_distance, CASE WHEN d.n_words >= {r.min_hist_words} THEN wdist.v END AS word_distance
  FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN cdist USING (doc_id) LEFT JOIN wdist USING (doc_id)),
g AS (SELECT *, n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND coalesce(class_distance, 0) <= {r.max_class_distance} AND coalesce(word_distance, 0) <= {r.max_word_distance} AS kept FROM g
"""


ORACLE_SQL = {"op1_line_dedup": line_dedup(), "op4_decontaminate": decontaminate(), "op7_mix": mix(), "op8_warc": warc(), "op10_quality_rules": quality_rules()}
