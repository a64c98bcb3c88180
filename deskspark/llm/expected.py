"""Expected results of the queries as DuckDB SQL, where SQL has them in bearable time."""

from __future__ import annotations

_FINITE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

NEGATIVES = f"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND {_FINITE}),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS place
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE place <= 3
"""

REPEATS = """
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, encode(coalesce(text, '')) AS b FROM documents),
hexed AS MATERIALIZED (SELECT row, doc_id, hex(b) AS h, octet_length(b) AS n FROM texts),
starts AS MATERIALIZED (SELECT row, pos, hash(substr(h, 2 * pos + 1, 800)) AS k FROM hexed, unnest(range(n - 399)) AS u(pos)),
twice AS MATERIALIZED (SELECT row, pos FROM starts WHERE k IN (SELECT k FROM starts GROUP BY k HAVING count(*) > 1)),
steps AS (
  SELECT row, pos, CASE WHEN pos <= lag(pos) OVER (PARTITION BY row ORDER BY pos) + 400 THEN 0 ELSE 1 END AS fresh FROM twice),
runs AS (SELECT row, sum(fresh) OVER (PARTITION BY row ORDER BY pos) AS run, pos FROM steps),
ends AS MATERIALIZED (SELECT row, min(pos) AS low, max(pos) + 400 AS high FROM runs GROUP BY row, run),
spans AS (SELECT *, lag(high, 1, 0) OVER (PARTITION BY row ORDER BY low) AS before FROM ends),
kept AS (
  SELECT row, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS last,
         string_agg(substr(h, 2 * before + 1, 2 * (low - before)), '' ORDER BY low) AS head
  FROM spans JOIN hexed USING (row) GROUP BY row)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM hexed LEFT JOIN kept USING (row)
"""


def codes(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    """Rounds of assigning every part to its nearest entry and moving the entries, one after the other."""
    steps = [f"""
WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings WHERE {_FINITE}),
pieces AS MATERIALIZED (
  SELECT vec_id, label, part, v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}] AS p FROM whole, unnest(range({parts})) AS u(part)),
ordered AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, p AS e FROM pieces),
book0 AS MATERIALIZED (SELECT part, entry, e FROM ordered WHERE entry < {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""
far{k} AS (
  SELECT vec_id, label, part, p, entry, CAST(list_sum(list_transform(list_zip(p, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS far
  FROM pieces JOIN book{k} USING (part)),
near{k} AS MATERIALIZED (
  SELECT vec_id, label, part, p, entry, far FROM far{k} QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY far, entry) = 1)""")
        if k < rounds:
            steps.append(f"""
cells{k} AS (
  SELECT part, entry, pos, CAST(sum(p[pos]) AS BIGINT) AS total, count(*) AS n FROM near{k}, unnest(range(1, len(p) + 1)) AS u(pos) GROUP BY part, entry, pos),
means{k} AS (SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY pos) AS e FROM cells{k} GROUP BY part, entry),
book{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.e, b.e) AS e FROM book{k} b LEFT JOIN means{k} m USING (part, entry))""")
    steps.append(f"""
coded AS (
  SELECT vec_id, label, string_agg(lpad(to_hex(entry), 2, '0'), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id, label)
SELECT vec_id, lower(code) AS code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM book{rounds}) AS codebooks_sha256
FROM coded""")
    return ",".join(steps)
