"""Queries over the checks of extraction: totals, counts, missing detail, coverage, inventories."""

from __future__ import annotations

from pyspark.sql import functions as F

from almoner.operators import filings as fil
from almoner.operators import quality as q
from almoner.plans.analogs import table
from almoner.plans.filings import DUCK_LINES, ELEMENTS, READABLE, xml_filings
from almoner.plans.register import query
from almoner.sources.shared import written

FILED = f"""{DUCK_LINES}, f AS (SELECT object_id, o_orderkey, count(*) AS n, CAST(sum(CASE WHEN grp = 'pf_paid' AND s_suppkey % 10 <> 7 THEN dollars ELSE 0 END) AS BIGINT) AS parsed, sum(CASE WHEN grp = 'pf_paid' THEN dollars ELSE 0 END) AS listed,
  count(*) FILTER (WHERE grp = 'pf_paid') AS paid_rows, count(*) FILTER (WHERE grp <> 'sched_i' AND s_suppkey % 10 = 6) AS stand_ins FROM lines WHERE {READABLE} GROUP BY 1, 2),
p AS (SELECT *, CASE WHEN o_orderkey % 7 = 1 THEN NULL WHEN o_orderkey % 7 = 2 THEN CAST(floor(listed * 0.9::DOUBLE) AS BIGINT) ELSE CAST(listed AS BIGINT) END AS reported FROM f WHERE o_orderkey % 3 <> 0),
t AS (SELECT object_id, parsed, reported, CASE WHEN reported IS NULL THEN NULL WHEN reported = 0 THEN CASE WHEN parsed = 0 THEN 0.0::DOUBLE ELSE 'inf'::DOUBLE END ELSE 100.0::DOUBLE * abs(parsed - reported) / reported END AS pct, paid_rows FROM p),
s AS (SELECT *, CASE WHEN paid_rows = 0 AND reported IS NULL THEN 'no_rows' WHEN reported IS NULL THEN 'no_total' WHEN pct <= 1.0 THEN 'within_tolerance' ELSE 'over_tolerance' END AS status FROM t),
c AS (SELECT object_id, n AS parsed_rows, n - CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS reported_total FROM f WHERE o_orderkey % 3 = 0)"""


def _docs(spark, sf_dir):
    return fil.filed(fil.parsed(xml_filings(spark, sf_dir)).filter("error IS NULL"))


def _filings(spark, sf_dir):
    return q.filing_sums(_docs(spark, sf_dir))


@query(
    "v07_pf_totals",
    FILED + " SELECT object_id, parsed AS parsed_paid, reported AS reported_paid, parsed - reported AS delta, pct AS delta_pct, status FROM s"
)
def v07(spark, sf_dir):
    return q.pf_totals(_filings(spark, sf_dir)).select("object_id", "parsed_paid", "reported_paid", "delta", "delta_pct", "status")


@query(
    "v08_table_counts",
    FILED + " SELECT object_id, parsed_rows, reported_total, parsed_rows - reported_total AS delta, CASE WHEN parsed_rows = reported_total THEN 'exact' ELSE 'mismatch' END AS status FROM c"
)
def v08(spark, sf_dir):
    return q.table_counts(_filings(spark, sf_dir)).select("object_id", "parsed_rows", "reported_total", "delta", "status")


@query("v09_missing_detail", FILED + """ SELECT object_id, reason FROM (SELECT object_id, CASE WHEN n > stand_ins THEN NULL WHEN coalesce(reported, 0) > 0 AND n = 0 THEN 'no structured rows' WHEN coalesce(reported, 0) > 0 THEN 'only aggregate placeholder rows'
  WHEN stand_ins > 0 THEN 'only aggregate placeholder rows, no stated total' END AS reason FROM p) WHERE reason IS NOT NULL""")
def v09(spark, sf_dir):
    return q.missing_detail(_filings(spark, sf_dir)).select("object_id", "reason")


@query("a16_summary", FILED + """, a AS (SELECT count(*) AS pf_filings, count(*) FILTER (WHERE status IN ('within_tolerance', 'over_tolerance')) AS pf_with_total, count(*) FILTER (WHERE status = 'within_tolerance') AS pf_within, count(*) FILTER (WHERE status = 'no_total') AS pf_no_total FROM s),
b AS (SELECT count(*) AS table_filings, count(*) FILTER (WHERE parsed_rows = reported_total) AS table_exact, CAST(0 AS BIGINT) AS table_no_count FROM c)
SELECT *, 100.0::DOUBLE * pf_within / pf_with_total AS pf_share, 100.0::DOUBLE * table_exact / table_filings AS table_share FROM a, b""")
def a16(spark, sf_dir):
    f = written(_filings(spark, sf_dir).select("object_id", "funder_ein", "return_version", "return_type", "n_rows", "paid_rows", "parsed_paid", *fil.TOTALS))
    return q.summary(q.pf_totals(f), q.table_counts(f))


COVERED = """SELECT CASE WHEN o_orderkey % 2 = 0 THEN '2022v5.0' ELSE '2021v4.0' END AS return_version, CASE WHEN o_orderkey % 3 = 0 THEN '990' ELSE '990PF' END AS return_type,
  bool_or(grp = 'sched_i' OR s_suppkey % 10 <> 7) AS amount, bool_or(true) AS name, bool_or(grp <> 'sched_i' AND s_suppkey % 4 <> 0) AS zip, object_id FROM lines WHERE """ + READABLE + " GROUP BY object_id, o_orderkey"


@query("a12_v01_v02_v03_coverage", f"""{DUCK_LINES}, k AS ({COVERED}) SELECT return_version, return_type, count(*) AS filings, count(*) AS with_rows, count(*) FILTER (WHERE amount) AS amount, count(*) FILTER (WHERE name) AS name, count(*) FILTER (WHERE zip) AS zip,
  count(*) FILTER (WHERE amount AND name) AS fully_resolved, count(*) FILTER (WHERE amount AND name AND zip) AS all_common, round(100.0::DOUBLE * count(*) FILTER (WHERE amount AND name) / count(*), 2) AS percent FROM k GROUP BY 1, 2""")
def a12(spark, sf_dir):
    return _coverage(spark, sf_dir)


def _coverage(spark, sf_dir):
    has = {
        "amount": lambda r: r["amount_usd"].isNotNull(), "name": lambda r: r["recipient_name_raw"] != "",
        "zip": lambda r: r["recipient_zip"].isNotNull()
    }
    return q.coverage(_docs(spark, sf_dir), has, F.col("amount") & F.col("name"))


@query(
    "a15_v06_headline",
    f"{DUCK_LINES}, k AS ({COVERED}) SELECT coalesce(100.0::DOUBLE * count(*) FILTER (WHERE amount AND name) / nullif(count(*), 0), 0) AS percent FROM k"
)
def a15(spark, sf_dir):
    return q.headline(_coverage(spark, sf_dir))


@query("v04_u04_path_versions", ELEMENTS + " SELECT * FROM versioned")
def v04(spark, sf_dir):
    return q.versions_of(fil.path_counts(xml_filings(spark, sf_dir)))


@query("e18_present_in_version", """WITH p AS (SELECT DISTINCT '/p' || CAST(p_partkey % 40 AS VARCHAR) AS path, 'v' || CAST(p_partkey % 3 AS VARCHAR) AS return_version FROM part),
i AS (SELECT DISTINCT '/p' || CAST(p_partkey % 25 AS VARCHAR) AS path, 'v' || CAST(p_partkey % 2 AS VARCHAR) AS return_version FROM part)
SELECT p.path, p.return_version, CASE WHEN p.return_version IN (SELECT return_version FROM i) THEN (p.path, p.return_version) IN (SELECT (path, return_version) FROM i) END AS present FROM p""")
def e18(spark, sf_dir):
    k, parts = F.col("p_partkey"), table(spark, sf_dir, "part")
    shown = lambda paths, versions: parts.select(F.concat(F.lit("/p"), (k % paths).cast("string")).alias("path"), F.concat(F.lit("v"), (k % versions).cast("string")).alias("return_version"))
    return q.present_in_version(shown(40, 3).distinct(), shown(25, 2))


@query("l04_report_order", FILED + " SELECT object_id, row_number() OVER (ORDER BY status, -pct, object_id) AS place FROM s WHERE pct IS NOT NULL")
def l04(spark, sf_dir):
    from almoner.operators.relational import global_row_number

    t = q.pf_totals(_filings(spark, sf_dir)).filter("delta_pct IS NOT NULL")
    return global_row_number(
        t, [F.col("status"), -F.col("delta_pct"), F.col("object_id")], "place"
    ).select("object_id", F.col("place").cast("long").alias("place"))
