"""Queries over joins, aggregates, windows, limits and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from almoner.operators import relational as rel
from almoner.operators.profiles import paid
from almoner.plans.analogs import analog, ctes, edges, table
from almoner.plans.register import query


# predicates


@query(
    "p01_return_types",
    ctes("filing_index") + " SELECT object_id, return_type FROM filing_index WHERE return_type IN ('990', '990O', '990PF', '990PR')"
)
def p01(spark, sf_dir):
    return analog(spark, sf_dir, "filing_index").filter(F.col("return_type").isin("990", "990O", "990PF", "990PR")).select("object_id", "return_type")


@query("p02_wanted_ids", ctes("filing_index") + " SELECT object_id FROM filing_index WHERE filing_year = 1997")
def p02(spark, sf_dir):
    return analog(spark, sf_dir, "filing_index").filter("filing_year = 1997").select("object_id")


@query(
    "p03_p04_year_and_prefix",
    ctes("edges") + " SELECT grant_id, amount_usd FROM edges WHERE filing_year IN (1997, 1999) AND funder_ein LIKE '0000001%'"
)
def p03(spark, sf_dir):
    return edges(spark, sf_dir).filter(
        F.col("filing_year").isin(1997, 1999) & F.col("funder_ein").startswith("0000001")
    ).select("grant_id", "amount_usd")


@query("p05_code_prefix", ctes("registry") + " SELECT ein, ntee_code FROM registry WHERE ntee_code LIKE 'B%'")
def p05(spark, sf_dir):
    return analog(spark, sf_dir, "registry").filter(F.col("ntee_code").startswith("B")).select("ein", "ntee_code")


@query("p08_replace_column", ctes("edges") + " SELECT grant_id, CAST(amount_usd * 2 AS BIGINT) AS amount_usd FROM edges")
def p08(spark, sf_dir):
    return edges(spark, sf_dir).withColumns({"amount_usd": F.col("amount_usd") * 2}).select("grant_id", "amount_usd")


@query(
    "p11_keyword",
    ctes("edges") + " SELECT grant_id, grant_purpose FROM edges WHERE contains(upper(grant_purpose), 'WIDGET') OR contains(upper(recipient_name_raw), 'WIDGET')"
)
def p11(spark, sf_dir):
    hit = F.upper("grant_purpose").contains("WIDGET") | F.upper("recipient_name_raw").contains("WIDGET")
    return edges(spark, sf_dir).filter(hit).select("grant_id", "grant_purpose")


@query(
    "p12_organizations",
    ctes("edges") + " SELECT grant_id FROM edges WHERE recipient_type = 'organization' AND recipient_name_normalized IS NOT NULL"
)
def p12(spark, sf_dir):
    return edges(spark, sf_dir).filter("recipient_type = 'organization' AND recipient_name_normalized IS NOT NULL").select("grant_id")


@query("p13_group_by_all", ctes("edges") + " SELECT amount_type, match_tier, count(*) AS n FROM edges GROUP BY ALL")
def p13(spark, sf_dir):
    return edges(spark, sf_dir).groupBy("amount_type", "match_tier").agg(F.count(F.lit(1)).alias("n"))


# index and archives

RANKED = ctes("filing_index", "members") + """, ranked AS (SELECT *, row_number() OVER w AS rank, lag(object_id) OVER w AS superseded_by, first_value(object_id) OVER w AS final_winner FROM filing_index
  WINDOW w AS (PARTITION BY ein, tax_period, return_type ORDER BY coalesce(sub_date, '') DESC, object_id DESC))"""


@query("w06_dedup_latest", RANKED + " SELECT object_id, CAST(rank AS INTEGER) AS rank, superseded_by, final_winner FROM ranked")
def w06(spark, sf_dir):
    return rel.superseded(analog(spark, sf_dir, "filing_index")).select("object_id", "rank", "superseded_by", "final_winner")


@query(
    "j01_matched",
    ctes("filing_index", "members") + " SELECT i.object_id, m.zip_file, m.bytes FROM filing_index i JOIN members m USING (object_id)"
)
def j01(spark, sf_dir):
    return analog(spark, sf_dir, "filing_index").join(analog(spark, sf_dir, "members"), "object_id").select("object_id", "zip_file", "bytes")


@query(
    "j02_index_only",
    ctes("filing_index", "members") + " SELECT i.object_id FROM filing_index i LEFT JOIN members m USING (object_id) WHERE m.object_id IS NULL"
)
def j02(spark, sf_dir):
    return analog(spark, sf_dir, "filing_index").join(analog(spark, sf_dir, "members"), "object_id", "left_anti").select("object_id")


@query(
    "j03_v11_u02_reconciliation",
    RANKED
    + r""" SELECT object_id, 'index_only' AS side FROM ranked WHERE rank = 1 AND filing_year = 1997 AND object_id NOT IN (SELECT object_id FROM members)
UNION ALL SELECT DISTINCT object_id, 'zip_only' FROM members WHERE regexp_extract(zip_file, '(\d{4})', 1) = '1997' AND object_id NOT IN (SELECT object_id FROM ranked)""",
)
def j03(spark, sf_dir):
    return rel.reconcile(analog(spark, sf_dir, "filing_index"), analog(spark, sf_dir, "members"), 1997)


TUPLE = ["name_normalized", "name_raw", "city", "state", "zip5", "ein_reported", "recipient_type"]
_same = " AND ".join(f"p.{c} IS NOT DISTINCT FROM s.{c}" for c in TUPLE)


@query(
    "j04_m01_pending_tuples",
    ctes("probes") + f", s AS (SELECT * FROM probes WHERE CAST(expected_ein AS BIGINT) % 2 = 0) SELECT DISTINCT {', '.join('p.' + c for c in TUPLE)} FROM probes p WHERE NOT EXISTS (SELECT 1 FROM s WHERE {_same})"
)
def j04(spark, sf_dir):
    p = analog(spark, sf_dir, "probes")
    stored = p.filter(F.col("expected_ein").cast("long") % 2 == 0).select(*[F.col(c).alias(c) for c in TUPLE])
    return rel.anti_null_safe(p.select(*TUPLE).distinct(), stored, TUPLE)


@query(
    "j05_p09_p10_apply_answers",
    ctes("probes") + f", s AS (SELECT *, 'B' AS tier, expected_ein AS answer FROM probes WHERE CAST(expected_ein AS BIGINT) % 3 = 0) SELECT p.expected_ein AS id, CASE WHEN s.tier IS NULL THEN 'U' ELSE s.tier END AS tier, s.answer FROM probes p LEFT JOIN s ON {_same}"
)
def j05(spark, sf_dir):
    p = analog(spark, sf_dir, "probes")
    s = p.filter(F.col("expected_ein").cast("long") % 3 == 0).select(*TUPLE, F.lit("B").alias("tier"), F.col("expected_ein").alias("answer"))
    joined = p.join(s, rel.all_equal_null_safe(p, s, TUPLE), "left")
    return joined.select(F.col("expected_ein").alias("id"), F.when(F.col("tier").isNull(), "U").otherwise(F.col("tier")).alias("tier"), "answer")


@query(
    "j06_j07_registry_lookups",
    ctes("edges", "registry") + " SELECT grant_id, f.ntee_code AS funder_ntee, r.ntee_code AS recipient_ntee, r.name AS bmf_name FROM edges e LEFT JOIN registry f ON e.funder_ein = f.ein LEFT JOIN registry r ON e.recipient_ein_resolved = r.ein"
)
def j06(spark, sf_dir):
    e, r = edges(spark, sf_dir), analog(spark, sf_dir, "registry")
    f = r.select(F.col("ein").alias("funder_ein"), F.col("ntee_code").alias("funder_ntee"))
    r = r.select(F.col("ein").alias("recipient_ein_resolved"), F.col("ntee_code").alias("recipient_ntee"), F.col("name").alias("bmf_name"))
    return e.join(f, "funder_ein", "left").join(r, "recipient_ein_resolved", "left").select("grant_id", "funder_ntee", "recipient_ntee", "bmf_name")


@query(
    "j08_a07_keep_largest",
    ctes("edges") + ", keep AS (SELECT funder_ein FROM edges WHERE amount_type = 'paid' GROUP BY 1 ORDER BY sum(amount_usd) DESC, 1 LIMIT 20) SELECT funder_ein, count(*) AS n FROM edges WHERE funder_ein IN (SELECT funder_ein FROM keep) GROUP BY 1"
)
def j08(spark, sf_dir):
    e = edges(spark, sf_dir)
    keep = e.filter(paid()).groupBy("funder_ein").agg(F.sum("amount_usd").alias("t")).orderBy(F.col("t").desc(), "funder_ein").limit(20).select("funder_ein")
    return e.join(keep, "funder_ein", "left_semi").groupBy("funder_ein").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j09_reported_ein",
    ctes("probes", "registry") + " SELECT p.expected_ein AS id, r.name AS found FROM probes p LEFT JOIN registry r ON p.ein_reported = r.ein"
)
def j09(spark, sf_dir):
    r = analog(spark, sf_dir, "registry").select(F.col("ein").alias("ein_reported"), F.col("name").alias("found"))
    return analog(spark, sf_dir, "probes").join(r, "ein_reported", "left").select(F.col("expected_ein").alias("id"), "found")


@query("j13_submission_lookup", ctes("edges", "filing_index") + " SELECT grant_id, sub_date FROM edges LEFT JOIN filing_index USING (object_id)")
def j13(spark, sf_dir):
    return edges(spark, sf_dir).join(
        analog(spark, sf_dir, "filing_index").select("object_id", "sub_date"), "object_id", "left"
    ).select("grant_id", "sub_date")


# aggregates


@query("a01_by_return_type", ctes("filing_index") + " SELECT return_type, count(*) AS n FROM filing_index GROUP BY 1")
def a01(spark, sf_dir):
    return analog(spark, sf_dir, "filing_index").groupBy("return_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a03_funder_years",
    ctes("edges") + " SELECT funder_ein, tax_year, amount_type, CAST(sum(amount_usd) AS BIGINT) AS total, count(*) AS n FROM edges GROUP BY 1, 2, 3"
)
def a03(spark, sf_dir):
    return edges(spark, sf_dir).groupBy("funder_ein", "tax_year", "amount_type").agg(F.sum("amount_usd").alias("total"), F.count(F.lit(1)).alias("n"))


@query(
    "a08_a09_tiers_and_types",
    ctes("edges") + " SELECT 'amount_type' AS facet, amount_type AS value, count(*) AS n FROM edges GROUP BY 2 UNION ALL SELECT 'tier', coalesce(nullif(match_tier, 'U'), 'null'), count(*) FROM edges GROUP BY 2"
)
def a08(spark, sf_dir):
    e = edges(spark, sf_dir)
    by_type = e.groupBy(F.col("amount_type").alias("value")).agg(F.count(F.lit(1)).alias("n")).withColumn("facet", F.lit("amount_type"))
    tier = F.coalesce(F.nullif(F.col("match_tier"), F.lit("U")), F.lit("null")).alias("value")
    return by_type.unionByName(e.groupBy(tier).agg(F.count(F.lit(1)).alias("n")).withColumn("facet", F.lit("tier")))


@query(
    "a10_vintages",
    ctes("registry_later") + " SELECT count(*) AS n, max(vintage) AS newest, count(DISTINCT vintage) AS vintages FROM registry_later"
)
def a10(spark, sf_dir):
    return analog(spark, sf_dir, "registry_later").agg(
        F.count(F.lit(1)).alias("n"), F.max("vintage").alias("newest"), F.count_distinct("vintage").alias("vintages")
    )


@query(
    "a11_parsed_totals",
    ctes("edges") + " SELECT object_id, CAST(sum(CASE WHEN amount_type = 'paid' THEN coalesce(amount_usd, 0) ELSE 0 END) AS BIGINT) AS parsed_paid FROM edges GROUP BY 1"
)
def a11(spark, sf_dir):
    return edges(spark, sf_dir).groupBy("object_id").agg(F.sum(F.when(paid(), F.coalesce("amount_usd", F.lit(0))).otherwise(0)).alias("parsed_paid"))


@query("a18_states", ctes("edges") + " SELECT funder_state AS state, count(DISTINCT funder_ein) AS funders FROM edges GROUP BY 1")
def a18(spark, sf_dir):
    return edges(spark, sf_dir).groupBy(F.col("funder_state").alias("state")).agg(F.count_distinct("funder_ein").alias("funders"))


@query("a19_filtered_counts", ctes("registry") + " SELECT count(*) AS total FROM registry WHERE state = 'NATION_3'")
def a19(spark, sf_dir):
    return analog(spark, sf_dir, "registry").filter("state = 'NATION_3'").agg(F.count(F.lit(1)).alias("total"))


@query("a21_archive_counts", ctes("members") + " SELECT zip_file, count(*) AS members, CAST(sum(bytes) AS BIGINT) AS bytes FROM members GROUP BY 1")
def a21(spark, sf_dir):
    return analog(spark, sf_dir, "members").groupBy("zip_file").agg(F.count(F.lit(1)).alias("members"), F.sum("bytes").alias("bytes"))


# windows, limits, sets


@query(
    "w07_runner_up",
    ctes("edges") + ", b AS (SELECT object_id, grant_id, amount_usd, row_number() OVER w AS rn, amount_usd - lead(amount_usd) OVER w AS margin FROM edges WINDOW w AS (PARTITION BY object_id ORDER BY amount_usd DESC, grant_id)) SELECT object_id, grant_id, margin FROM b WHERE rn = 1"
)
def w07(spark, sf_dir):
    w = Window.partitionBy("object_id").orderBy(F.col("amount_usd").desc(), "grant_id")
    e = edges(spark, sf_dir).withColumn("rn", F.row_number().over(w)).withColumn("margin", F.col("amount_usd") - F.lead("amount_usd").over(w))
    return e.filter("rn = 1").select("object_id", "grant_id", "margin")


@query(
    "w09_l08_year_pages",
    ctes("edges") + ", b AS (SELECT funder_ein, tax_year, grant_id, row_number() OVER (PARTITION BY funder_ein, tax_year ORDER BY amount_usd DESC, grant_id) AS rn FROM edges) SELECT funder_ein, tax_year, grant_id, CAST(ceil(rn / 5.0) AS INTEGER) AS page FROM b"
)
def w09(spark, sf_dir):
    w = Window.partitionBy("funder_ein", "tax_year").orderBy(F.col("amount_usd").desc(), "grant_id")
    return edges(spark, sf_dir).select("funder_ein", "tax_year", "grant_id", F.ceil(F.row_number().over(w) / 5).cast("int").alias("page"))


@query(
    "w10_v14_stratified_sample",
    ctes("edges") + ", s AS (SELECT match_tier, grant_id, row_number() OVER (PARTITION BY match_tier ORDER BY sha256(grant_id || 'label')) AS place FROM edges) SELECT match_tier, grant_id, CAST(place AS INTEGER) AS place FROM s WHERE place <= greatest(1, 50 // (SELECT count(DISTINCT match_tier) FROM edges))"
)
def w10(spark, sf_dir):
    return rel.stratified(edges(spark, sf_dir), "match_tier", F.col("grant_id"), 50, "label").select("match_tier", "grant_id", "place")


@query(
    "l02_l05_publish_order",
    ctes("edges") + " SELECT grant_id, row_number() OVER (PARTITION BY filing_year ORDER BY funder_ein, tax_year NULLS FIRST, amount_usd DESC NULLS LAST, grant_id) AS place FROM edges"
)
def l02(spark, sf_dir):
    w = Window.partitionBy("filing_year").orderBy(
        "funder_ein", F.col("tax_year").asc_nulls_first(), F.col("amount_usd").desc_nulls_last(), "grant_id"
    )
    return edges(spark, sf_dir).select("grant_id", F.row_number().over(w).cast("long").alias("place"))


@query(
    "l06_q17_top_funders",
    ctes("edges") + " SELECT funder_ein, funder_name, CAST(sum(amount_usd) AS BIGINT) AS total FROM edges WHERE amount_type = 'paid' GROUP BY 1, 2 ORDER BY total DESC, funder_ein LIMIT 12"
)
def l06(spark, sf_dir):
    return edges(spark, sf_dir).filter(paid()).groupBy("funder_ein", "funder_name").agg(F.sum("amount_usd").alias("total")).orderBy(F.col("total").desc(), "funder_ein").limit(12)


@query("l07_page", ctes("registry") + " SELECT ein, name FROM registry ORDER BY name, ein LIMIT 4 OFFSET 4")
def l07(spark, sf_dir):
    return rel.page_of(analog(spark, sf_dir, "registry").select("ein", "name"), [F.col("name"), F.col("ein")], 2, 4)


@query(
    "l10_k14_sitemap_chunks",
    ctes("registry") + " SELECT ein, CAST((row_number() OVER (ORDER BY ein) - 1) // 30 AS INTEGER) AS chunk FROM registry"
)
def l10(spark, sf_dir):
    return rel.chunk_numbers(analog(spark, sf_dir, "registry").select("ein"), [F.col("ein")], 30)


@query("u01_union_distinct", ctes("probes", "registry") + " SELECT name_normalized FROM probes UNION SELECT name_normalized FROM registry")
def u01(spark, sf_dir):
    return analog(spark, sf_dir, "probes").select("name_normalized").unionByName(
        analog(spark, sf_dir, "registry").select("name_normalized")
    ).dropDuplicates()


@query("u03_distinct_filings", ctes("edges") + " SELECT DISTINCT funder_ein, object_id, return_version FROM edges")
def u03(spark, sf_dir):
    return edges(spark, sf_dir).select("funder_ein", "object_id", "return_version").distinct()


@query(
    "u04_difference",
    ctes("probes", "registry") + " SELECT DISTINCT name_normalized FROM probes WHERE name_normalized NOT IN (SELECT name_normalized FROM registry)"
)
def u04(spark, sf_dir):
    return analog(spark, sf_dir, "probes").select("name_normalized").distinct().join(
        analog(spark, sf_dir, "registry").select("name_normalized"), "name_normalized", "left_anti"
    )


@query(
    "k09_upsert_registry",
    ctes("registry", "registry_later") + ", u AS (SELECT ein, name_normalized, state, '2026-07' AS vintage FROM registry UNION ALL SELECT ein, name_normalized, state, vintage FROM registry_later) SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY ein ORDER BY vintage DESC, name_normalized) AS k FROM u) WHERE k = 1",
)
def k09(spark, sf_dir):
    old = analog(spark, sf_dir, "registry").select("ein", "name_normalized", "state", F.lit("2026-07").alias("vintage"))
    return rel.upsert(old, analog(spark, sf_dir, "registry_later"), ["ein"], [F.col("vintage").desc(), F.col("name_normalized")])


@query(
    "v16_v18_assertions",
    ctes("edges") + " SELECT count(DISTINCT return_version) AS versions, count(*) FILTER (WHERE grant_id IS NULL OR object_id IS NULL OR funder_ein IS NULL) AS missing FROM edges"
)
def v16(spark, sf_dir):
    bad = F.col("grant_id").isNull() | F.col("object_id").isNull() | F.col("funder_ein").isNull()
    return edges(spark, sf_dir).agg(F.count_distinct("return_version").alias("versions"), F.count_if(bad).alias("missing"))
