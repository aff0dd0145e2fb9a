"""DuckDB SQL for those corpus queries that SQL can express.

The other queries use trained models, code of their own formats, hashes that
DuckDB lacks or graph search; ``tests/llm`` holds them against brute force,
exact round trips and held-out accuracy.
"""

from __future__ import annotations

from candela.llm.queries import MIX_ALPHA

#: Poisson replication: thresholds by source, a uniform number from md5, one row for each copy.
MIX = f"""
WITH sources AS (SELECT source, sum(greatest(coalesce(length(text), 0), 1)) AS chars FROM documents GROUP BY source),
weighted AS (SELECT source, chars, pow(chars::DOUBLE, {MIX_ALPHA}) AS w FROM sources),
rates AS (SELECT source, w / sum(w) OVER () * sum(chars) OVER () / chars AS rate FROM weighted),
bounds AS (SELECT source, rate, greatest(0, floor(rate - 12 * sqrt(rate) - 30))::BIGINT AS lo, floor(rate + 12 * sqrt(rate) + 30)::BIGINT AS hi FROM rates),
terms AS (SELECT source, rate, lo, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p FROM (SELECT *, unnest(range(lo, hi + 1)) AS k FROM bounds)),
thresholds AS (SELECT source, rate, lo, k, sum(p) OVER (PARTITION BY source ORDER BY k) / sum(p) OVER (PARTITION BY source) AS t FROM terms),
lists AS (SELECT source, any_value(rate) AS rate, any_value(lo) AS lo, list(t) FILTER (WHERE t < 1 - 1e-16) AS ts FROM thresholds GROUP BY source),
drawn AS (SELECT d.*, l.rate, l.lo, l.ts, ('0x' || substr(md5('42/count|' || coalesce(doc_id::VARCHAR, '\\N') || '|' || coalesce(md5(text), '\\N')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents d JOIN lists l ON d.source IS NOT DISTINCT FROM l.source),
counted AS (SELECT *, CAST(lo + len(list_filter(ts, lambda t: t <= u)) AS INTEGER) AS n_copies FROM drawn),
copies AS (SELECT *, CAST(unnest(range(n_copies)) AS INTEGER) AS copy FROM counted WHERE n_copies > 0)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS rate, n_copies, copy,
  ('0x' || substr(md5('42/order|' || coalesce(doc_id::VARCHAR, '\\N') || '|' || coalesce(md5(text), '\\N') || '|' || copy), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS shuffle_key FROM copies
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": MIX}
