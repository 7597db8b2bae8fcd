"""Queries of the data quality profile (problem 2) over ``extraction_records``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.operators import quality
from lavra.session import read_table


def _records(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "extraction_records").select("id", "created_at", *[r.name for r in quality.EXTRACTION_RULES])


def _load():
    return F.to_date(F.to_utc_timestamp("created_at", F.current_timezone()))  # the UTC day in any session zone


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    df = _records(spark, base)
    values = quality.violations(df, quality.EXTRACTION_RULES, "id").select(F.lit("value").alias("kind"), "field_name", "case_key")
    moved = quality.shifts(df, quality.EXTRACTION_RULES, _load())
    return values.unionByName(moved.select(F.lit("shift").alias("kind"), "field_name", F.date_format("load", "yyyy-MM-dd").alias("case_key")))


def p2_profile(spark: SparkSession, base: str) -> DataFrame:
    out = quality.profile(_records(spark, base), quality.EXTRACTION_RULES, _load())
    doubles = ("null_share", "lowest", "q1", "median", "q3", "highest", "lowest_any", "highest_any", "ks")
    return out.select("field_name", F.date_format("load", "yyyy-MM-dd").alias("load"), "n_rows", "n_null", "n_distinct", "n_outside", "first_text", "last_text", *[F.round(c, 6).alias(c) for c in doubles])


# Shared head of both statements: rows in long form with their load, and the load before each load.
_LONG = """
e AS (SELECT id, status, page_count, extraction_duration_in_seconds AS dur, error_log,
        CAST(created_at AT TIME ZONE 'UTC' AS DATE) AS load FROM extraction_records),
long AS (
  SELECT id, load, 'status' AS field_name, CAST(NULL AS DOUBLE) AS num, status AS txt,
    status IS NOT NULL AND status NOT IN ('EXTRACTED','FAILED','IN_PROGRESS') AS bad FROM e
  UNION ALL SELECT id, load, 'page_count', CAST(page_count AS DOUBLE), NULL,
    page_count IS NOT NULL AND page_count NOT BETWEEN 1 AND 5000 FROM e
  UNION ALL SELECT id, load, 'extraction_duration_in_seconds', dur, NULL,
    dur IS NOT NULL AND NOT coalesce(dur BETWEEN 0 AND 7200, false) FROM e
  UNION ALL SELECT id, load, 'error_log', NULL, error_log,
    coalesce(status = 'FAILED' AND (error_log IS NULL OR regexp_matches(error_log, '^[\\s\\p{Z}]*$')), false)
    OR coalesce(status = 'EXTRACTED' AND error_log IS NOT NULL, false) FROM e),
loads AS (SELECT load, lag(load) OVER (ORDER BY load) AS prev FROM (SELECT DISTINCT load FROM e WHERE load IS NOT NULL))
"""

SQL = {
    "p2_found": f"""
WITH {_LONG},
size AS (SELECT field_name, load, count(*) AS n, count(*) FILTER (num IS NULL AND txt IS NULL) AS nulls,
    median(num) FILTER (NOT bad AND num IS NOT NULL) AS med FROM long GROUP BY 1, 2),
pairs AS (SELECT b.field_name, b.load, a.load AS prev, a.n AS n_a, b.n AS n_b, a.nulls AS nulls_a, b.nulls AS nulls_b, a.med AS med_a, b.med AS med_b
  FROM loads l JOIN size b ON b.load = l.load JOIN size a ON a.load = l.prev AND a.field_name = b.field_name),
vals AS (SELECT load, txt, count(*) AS c FROM long WHERE field_name = 'status' AND txt IS NOT NULL GROUP BY 1, 2),
either AS (SELECT DISTINCT p.load, p.prev, p.n_a, p.n_b, v.txt FROM pairs p JOIN vals v ON v.load IN (p.load, p.prev) WHERE p.field_name = 'status'),
moved AS (
  SELECT field_name, load FROM pairs WHERE abs(nulls_a / n_a - nulls_b / n_b) > 0.117
    OR greatest(med_a, med_b) > 1.5 * least(med_a, med_b) AND med_a IS NOT NULL AND med_b IS NOT NULL
  UNION SELECT 'status', x.load FROM either x LEFT JOIN vals a ON a.load = x.prev AND a.txt = x.txt LEFT JOIN vals b ON b.load = x.load AND b.txt = x.txt
    WHERE abs(coalesce(a.c, 0) / n_a - coalesce(b.c, 0) / n_b) > 0.117)
SELECT DISTINCT 'value' AS kind, field_name, id AS case_key FROM long WHERE bad AND id IS NOT NULL
UNION ALL SELECT DISTINCT 'shift', field_name, strftime(load, '%Y-%m-%d') FROM moved
""",
    "p2_profile": f"""
WITH {_LONG},
base AS (SELECT field_name, load, count(*) AS n_rows, count(*) FILTER (num IS NULL AND txt IS NULL) AS n_null,
    count(DISTINCT coalesce(txt, CAST(num AS VARCHAR))) AS n_distinct, count(*) FILTER (bad) AS n_outside,
    min(num) FILTER (NOT bad) AS lowest, max(num) FILTER (NOT bad) AS highest,
    min(num) AS lowest_any, max(num) AS highest_any, min(txt) AS first_text, max(txt) AS last_text,
    quantile_disc(num, 0.25) FILTER (NOT bad) AS q1, median(num) FILTER (NOT bad) AS median, quantile_disc(num, 0.75) FILTER (NOT bad) AS q3
  FROM long WHERE load IS NOT NULL GROUP BY 1, 2),
live AS (SELECT field_name, load, num, txt FROM long WHERE NOT bad AND (num IS NOT NULL OR txt IS NOT NULL) AND load IS NOT NULL),
both_ AS (SELECT x.field_name, l.load, x.num, x.txt, CASE WHEN x.load = l.load THEN 1 ELSE 0 END AS is_new
  FROM live x JOIN loads l ON x.load IN (l.load, l.prev)),
agg AS (SELECT field_name, load, num, txt, sum(is_new) AS n, sum(1 - is_new) AS o FROM both_ GROUP BY 1, 2, 3, 4),
cum AS (SELECT field_name, load, sum(n) OVER w AS cn, sum(o) OVER w AS co, sum(n) OVER t AS tn, sum(o) OVER t AS to_ FROM agg
  WINDOW w AS (PARTITION BY field_name, load ORDER BY num NULLS FIRST, txt NULLS FIRST ROWS UNBOUNDED PRECEDING), t AS (PARTITION BY field_name, load)),
ks AS (SELECT field_name, load, max(abs(co / to_ - cn / tn)) AS ks FROM cum WHERE tn > 0 AND to_ > 0 GROUP BY 1, 2)
SELECT b.field_name, strftime(b.load, '%Y-%m-%d') AS load, n_rows, n_null, round(n_null / n_rows, 6) AS null_share, n_distinct, n_outside,
  round(lowest, 6) AS lowest, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(highest, 6) AS highest, round(lowest_any, 6) AS lowest_any, round(highest_any, 6) AS highest_any, first_text, last_text, round(ks, 6) AS ks
FROM base b LEFT JOIN ks k ON k.field_name = b.field_name AND k.load = b.load
""",
}

QUERIES = {"p2_found": p2_found, "p2_profile": p2_profile}
