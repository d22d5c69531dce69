"""DuckDB SQL of the training-data queries that SQL can express.

The spans of secrets and personal data need match positions and the methods' own spans, URL
verdicts mined rules, and the trained scores their networks: those queries are compared with
brute force and held-out rows in tests/llm.
"""

from __future__ import annotations

from tessera.llm import bwt_dedup, hard_negatives, jaccard_join, nn_descent
from tessera.llm.mixing import mix_sql

# components by reachability from every node; edges hold both directions
_REACH = """reach AS (
  SELECT node, node AS seen FROM nodes UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.seen = e.a
),
parts AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)"""


def jaccard_sql(gram: int = jaccard_join.GRAM, percent: int = jaccard_join.PERCENT) -> str:
    return f"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
),
sh AS (
  SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[])
      WHEN len(ws) < {gram} THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - {gram - 2}), lambda i: array_to_string(ws[i:i + {gram - 1}], ' ')) END) AS g FROM w)
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= {percent} * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
nodes AS (SELECT doc_id AS node FROM documents),
{_REACH}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, p.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN parts p ON p.node = d.doc_id"""


def repeats_sql(length: int = bwt_dedup.LENGTH) -> str:
    return f"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
b AS (SELECT doc_id, hx, CAST(length(hx) // 2 AS BIGINT) AS n FROM d),
w AS (SELECT doc_id, s, md5_number(substr(hx, 2 * s + 1, {2 * length})) AS g
      FROM (SELECT doc_id, hx, unnest(range(0, greatest(n - {length - 1}, 0))) AS s FROM b)),
lead AS (SELECT g, min((doc_id, s)) AS first FROM w GROUP BY g HAVING count(*) > 1),
dup AS (SELECT doc_id, s FROM w JOIN lead USING (g) WHERE (doc_id, s) <> first),
cuts AS (SELECT doc_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= {length} THEN 0 ELSE 1 END AS cut FROM dup),
numbered AS (SELECT doc_id, s, sum(cut) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM cuts),
runs AS (SELECT doc_id, min(s) AS start, max(s) + {length} AS stop FROM numbered GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, start AS o, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS lo, start AS hi FROM runs
  UNION ALL SELECT b.doc_id, b.n + 1 AS o, coalesce(max(stop), 0) AS lo, b.n AS hi FROM b LEFT JOIN runs USING (doc_id) GROUP BY b.doc_id, b.n
),
kept AS (SELECT g.doc_id, string_agg(substr(b.hx, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY o) AS hx
         FROM gaps g JOIN b ON b.doc_id = g.doc_id GROUP BY g.doc_id),
counts AS (SELECT doc_id, count(*) AS n_spans, sum(stop - start) AS n_removed FROM runs GROUP BY doc_id)
SELECT b.doc_id, b.n AS n_bytes, CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed, coalesce(c.n_spans, 0) AS n_spans,
       sha256(unhex(k.hx)) AS kept_sha256
FROM b JOIN kept k ON k.doc_id = b.doc_id LEFT JOIN counts c ON c.doc_id = b.doc_id"""


def embeddings_sql(threshold: float = nn_descent.THRESHOLD) -> str:
    return f"""WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= {threshold!r} ELSE false END
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
nodes AS (SELECT vec_id AS node FROM embeddings),
{_REACH},
degree AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT e.vec_id, coalesce(g.n, 0) AS n_links, p.component_id, e.vec_id = p.component_id AS kept
FROM embeddings e JOIN parts p ON p.node = e.vec_id LEFT JOIN degree g ON g.a = e.vec_id"""


def hard_negatives_sql(scale: int = hard_negatives.SCALE, positives: int = hard_negatives.POSITIVES,
                       negatives: int = hard_negatives.NEGATIVES, low: int = hard_negatives.LOW_PERCENT) -> str:
    return f"""WITH v AS (
  SELECT row_number() OVER () AS rn, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.rn AS anchor, a.vec_id AS anchor_id, b.vec_id AS other_id, b.rn AS other, a.label = b.label AS same,
         CAST(coalesce(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.rn <> b.rn AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0
),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) <= {positives})
SELECT p.anchor_id, p.other_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor = p.anchor AND NOT n.same AND {low} * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other_id) <= {negatives}"""


ORACLES: dict[str, str] = {"op6_rlbwt_dedup": repeats_sql(), "op7_ngram_jaccard_join": jaccard_sql(),
                           "op8_nn_descent": embeddings_sql(), "op9_source_mixing": mix_sql(),
                           "op11_hard_negatives": hard_negatives_sql()}
