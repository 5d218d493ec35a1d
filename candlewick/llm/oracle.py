"""DuckDB SQL of the queries that SQL can express."""

OP10 = r"""
WITH docs AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), ':' || coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) AS pos
  FROM docs GROUP BY source),
ranked AS (
  SELECT source, source_size, [5.0, 2.0, 1.0][((pos - 1) % 3 + 1)::INT]::DOUBLE AS w, source_size * 2.0::DOUBLE AS cap,
         sum(source_size) OVER () * 1.5::DOUBLE AS total
  FROM sizes),
levels AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, source IS NULL, source) AS nr,
         (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM ranked),
opened AS (
  SELECT arg_min(lvl, nr) AS lvl FROM levels WHERE cap / w >= lvl),
plan AS (
  SELECT l.source, l.source_size, CASE WHEN o.lvl IS NULL THEN l.cap ELSE least(l.cap, l.w * o.lvl) END AS target
  FROM levels l LEFT JOIN opened o ON true),
budget AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM plan),
groups AS (
  SELECT source, h, sum(size)::BIGINT AS n, sum(sum(size)) OVER (PARTITION BY source ORDER BY h)::BIGINT AS upto
  FROM docs GROUP BY source, h),
edge AS (
  SELECT b.source, min(g.h) AS h, arg_min(g.n, g.h) AS n, arg_min(g.upto, g.h) AS upto
  FROM budget b JOIN groups g ON g.source IS NOT DISTINCT FROM b.source
  WHERE g.upto > b.target - b.whole * b.source_size GROUP BY b.source),
cut AS (
  SELECT b.*, CASE WHEN e.h IS NULL THEN 9223372036854775807
                   WHEN e.n - (b.target - b.whole * b.source_size - (e.upto - e.n)) < b.target - b.whole * b.source_size - (e.upto - e.n)
                   THEN e.h + 1 ELSE e.h END AS below
  FROM budget b LEFT JOIN edge e ON e.source IS NOT DISTINCT FROM b.source)
SELECT d.doc_id, d.size, c.source_size, c.target, d.size * (c.whole + (d.h < c.below)::BIGINT) AS taken,
       c.whole + (d.h < c.below)::BIGINT AS copies
FROM docs d JOIN cut c ON c.source IS NOT DISTINCT FROM d.source
"""

ORACLES = {"op10_mixing": OP10}
