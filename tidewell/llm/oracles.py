"""SQL for DuckDB that gives the rows of those queries that SQL can express, over whole tables."""

from __future__ import annotations

WORDS = r"""d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
)"""

LOWERED = WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

OP1_SQL = f"""
WITH RECURSIVE {LOWERED},
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.other) AS component_id
FROM d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY 1
"""

OP2_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
x AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS m FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 199, 0))) AS i FROM d)),
f AS (SELECT m FROM x GROUP BY 1 HAVING count(*) > 1),
r AS (SELECT doc_id, i FROM x SEMI JOIN f ON x.m = f.m),
b AS (SELECT doc_id, j, substr(h, 2 * j + 1, 2) AS byte FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS j FROM d)),
m AS (
  SELECT b.*, coalesce(max(r.i) OVER (PARTITION BY b.doc_id ORDER BY j) > j - 200, false) AS gone FROM b LEFT JOIN r ON r.doc_id = b.doc_id AND r.i = b.j
),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY j), false) AS begins FROM m),
k AS (SELECT doc_id, count_if(gone) AS n_removed, count_if(begins) AS n_spans, string_agg(byte, '' ORDER BY j) FILTER (NOT gone) AS kept FROM e GROUP BY 1)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

OP7_SQL = f"""
WITH {WORDS},
x AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS m FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 48, 1))) AS i FROM d)),
f AS (SELECT m, min(doc_id) AS first FROM x GROUP BY 1),
r AS (SELECT x.doc_id, x.i FROM x JOIN f ON x.m = f.m WHERE f.first < x.doc_id),
t AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
g AS (SELECT t.*, coalesce(max(r.i) OVER (PARTITION BY t.doc_id ORDER BY j) > j - 50, false) AS gone FROM t LEFT JOIN r ON r.doc_id = t.doc_id AND r.i = t.j),
k AS (SELECT doc_id, count_if(gone) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS kept FROM g GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""
