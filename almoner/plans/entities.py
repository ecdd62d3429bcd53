"""Queries over entity resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from almoner.operators import resolve as res
from almoner.plans.analogs import analog, ctes
from almoner.plans.register import query

T = ", ".join(res.TUPLE)
BLOCKED = ctes("probes", "registry") + f""", t AS (SELECT row_number() OVER () AS idx, *, nullif(split_part(name_normalized, ' ', 1), '') AS first_token,
  CASE WHEN length(regexp_replace(ein_reported, '\\D', '', 'g')) = 9 AND ein_reported <> '000000000' THEN ein_reported END AS valid FROM (SELECT DISTINCT {T} FROM probes)),
o AS (SELECT * FROM t WHERE recipient_type NOT IN ('individual', 'government') AND valid IS NULL AND name_normalized <> ''),
pairs AS (SELECT o.idx, r.ein FROM o JOIN registry r ON o.name_normalized = r.name_normalized UNION SELECT o.idx, r.ein FROM o JOIN registry r ON o.name_normalized = r.sort_name_normalized
  UNION SELECT o.idx, r.ein FROM o JOIN registry r ON o.state = r.state AND o.first_token = r.first_token UNION SELECT o.idx, r.ein FROM o JOIN registry r ON o.zip5 = r.zip5 AND o.first_token = r.first_token)"""
NEAR = BLOCKED + """, near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY idx ORDER BY sim DESC, c_ein) AS k FROM (
  SELECT o.*, r.ein AS c_ein, r.name AS c_name, r.name_normalized AS c_nn, r.sort_name_normalized AS c_sn, r.city AS c_city, r.state AS c_state, r.zip5 AS c_zip, r.ntee_code AS c_ntee, r.subsection_code AS c_sub,
    greatest(jaro_winkler_similarity(o.name_normalized, r.name_normalized), coalesce(jaro_winkler_similarity(o.name_normalized, r.sort_name_normalized), 0.0)) AS sim
  FROM pairs JOIN o USING (idx) JOIN registry r ON pairs.ein = r.ein) WHERE sim >= 0.9) WHERE k <= 50)"""
SCORED = NEAR + """, flags AS (SELECT *, (name_normalized = c_nn OR coalesce(name_normalized = c_sn, false)) AS exact, coalesce(zip5 = c_zip, false) AS za, coalesce(zip5 <> c_zip, false) AS zd,
  coalesce(city = c_city, false) AS ca, coalesce(city <> c_city, false) AS cd, upper(regexp_replace(name_raw, '[^A-Za-z0-9]', '', 'g')) = upper(regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g')) AS rx, state IS NOT NULL AS ins
  FROM near WHERE state IS NULL OR state = c_state),
scored AS (SELECT * FROM (SELECT *, CASE WHEN exact AND za AND ins THEN 'B' WHEN exact AND ins THEN 'C' WHEN exact THEN 'D' WHEN sim >= 0.94 AND za AND ins THEN 'C' WHEN ins THEN 'D' END AS tier,
  round(CASE WHEN exact AND za AND ins THEN least(greatest(0.90::DOUBLE + CASE WHEN ca THEN 0.02::DOUBLE ELSE 0 END + CASE WHEN rx THEN 0.02::DOUBLE ELSE 0 END, 0.90), 0.94)
    WHEN exact AND ins THEN least(greatest(0.80::DOUBLE + CASE WHEN ca THEN 0.05::DOUBLE ELSE 0 END + CASE WHEN rx THEN 0.04::DOUBLE ELSE 0 END - CASE WHEN zd THEN 0.03::DOUBLE ELSE 0 END - CASE WHEN cd THEN 0.02::DOUBLE ELSE 0 END, 0.75), 0.89)
    WHEN exact THEN least(greatest(0.70::DOUBLE - CASE WHEN zd THEN 0.03::DOUBLE ELSE 0 END, 0.50), 0.74)
    WHEN sim >= 0.94 AND za AND ins THEN least(greatest(0.75::DOUBLE + (sim - 0.94::DOUBLE) / (1.0::DOUBLE - 0.94::DOUBLE) * 0.08::DOUBLE + CASE WHEN ca THEN 0.06::DOUBLE ELSE 0 END, 0.75), 0.89)
    WHEN ins THEN least(greatest(0.50::DOUBLE + (sim - 0.90::DOUBLE) / (1.0::DOUBLE - 0.90::DOUBLE) * 0.24::DOUBLE - CASE WHEN zd THEN 0.03::DOUBLE ELSE 0 END - CASE WHEN cd THEN 0.02::DOUBLE ELSE 0 END, 0.50), 0.74) END, 2) AS confidence,
  CASE WHEN exact AND za AND ins THEN 'name_zip5_state_exact' WHEN exact AND ins THEN 'name_state_exact' WHEN exact THEN 'name_exact_no_state' WHEN sim >= 0.94 AND za AND ins THEN 'name_jw_zip5' WHEN ins THEN 'name_jw_state' END AS method FROM flags) WHERE tier IS NOT NULL)"""
RESOLVED = SCORED + f""", best AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY idx) AS n, row_number() OVER w AS rn, lead(confidence) OVER w AS second FROM scored WINDOW w AS (PARTITION BY idx ORDER BY confidence DESC, c_ein)) WHERE rn = 1),
j AS (SELECT t.*, r.ein AS r_ein, r.name AS r_name, r.ntee_code AS r_ntee, r.subsection_code AS r_sub, b.c_ein, b.c_name, b.c_ntee, b.c_sub, b.tier AS b_tier, b.confidence AS b_conf, b.method AS b_method,
  CASE WHEN t.recipient_type IN ('individual', 'government') THEN 'recipient_type_' || t.recipient_type WHEN t.valid IS NOT NULL THEN NULL WHEN t.idx NOT IN (SELECT idx FROM near) THEN 'no_candidates' WHEN b.n IS NULL THEN 'no_candidate_above_threshold'
    WHEN b.n > 1 AND b.confidence - b.second < 0.03::DOUBLE THEN 'ambiguous_' || CAST(b.n AS VARCHAR) || '_candidates' WHEN b.n > 1 AND b.tier = 'D' THEN 'probable_not_unique' END AS why
  FROM t LEFT JOIN registry r ON t.valid = r.ein LEFT JOIN best b ON t.idx = b.idx),
answers AS (SELECT {T}, CASE WHEN why IS NOT NULL THEN NULL WHEN valid IS NOT NULL THEN valid ELSE c_ein END AS ein,
  CASE WHEN why IS NOT NULL THEN 'unresolved' WHEN r_ein IS NOT NULL THEN 'reported_verified' WHEN valid IS NOT NULL THEN 'reported_unverified' ELSE CASE b_tier WHEN 'B' THEN 'bmf_deterministic' WHEN 'C' THEN 'bmf_strong' ELSE 'bmf_probable' END END AS source,
  CASE WHEN why IS NOT NULL THEN NULL WHEN r_ein IS NOT NULL THEN 1.0::DOUBLE WHEN valid IS NOT NULL THEN 0.95::DOUBLE ELSE b_conf END AS confidence,
  CASE WHEN why IS NOT NULL THEN 'U' WHEN valid IS NOT NULL THEN 'A' ELSE b_tier END AS tier,
  CASE WHEN why IS NOT NULL THEN why WHEN r_ein IS NOT NULL THEN 'reported_ein_in_bmf' WHEN valid IS NOT NULL THEN 'reported_ein_not_in_bmf' ELSE b_method END AS method,
  CASE WHEN why IS NOT NULL THEN NULL WHEN valid IS NOT NULL THEN r_name ELSE c_name END AS bmf_name, CASE WHEN why IS NOT NULL THEN NULL WHEN valid IS NOT NULL THEN r_ntee ELSE c_ntee END AS ntee_code,
  CASE WHEN why IS NOT NULL THEN NULL WHEN valid IS NOT NULL THEN r_sub ELSE c_sub END AS subsection_code FROM j)"""


def _tuples(spark, sf_dir):
    return analog(spark, sf_dir, "probes").select(*res.TUPLE).distinct()


def _answers(spark, sf_dir, **how):
    return res.resolve(_tuples(spark, sf_dir), analog(spark, sf_dir, "registry"), **how)


def _open(spark, sf_dir):
    probes = res.with_aliases(res.with_id(_tuples(spark, sf_dir)), None)
    return probes.filter(~F.col("recipient_type").isin("individual", "government") & ~res.is_valid(F.coalesce("ein_reported", F.lit("0"))))


@query("j10_m04_m05_blocks", BLOCKED + " SELECT o.name_normalized, o.name_raw, p.ein FROM pairs p JOIN o USING (idx)")
def j10(spark, sf_dir):
    p = _open(spark, sf_dir)
    return res.candidates(p, analog(spark, sf_dir, "registry"), phonetic=False).join(p, "idx").select("name_normalized", "name_raw", "ein")


@query("m04_phonetic_block")
def m04(spark, sf_dir):
    return res.candidates(_open(spark, sf_dir), analog(spark, sf_dir, "registry")).groupBy("idx").agg(F.count(F.lit(1)).alias("candidates"))


@query("m06_m07_w01_compared", NEAR + " SELECT name_raw, c_ein, round(sim, 6) AS sim FROM near")
def m06(spark, sf_dir):
    p, r = _open(spark, sf_dir), analog(spark, sf_dir, "registry")
    return res.compared(res.candidates(p, r, phonetic=False), p, r).select("name_raw", "c_ein", F.round("sim", 6).alias("sim"))


@query("m08_m09_scored", SCORED + " SELECT name_raw, c_ein, tier, confidence, method FROM scored")
def m08(spark, sf_dir):
    p, r = _open(spark, sf_dir), analog(spark, sf_dir, "registry")
    return res.scored(res.compared(res.candidates(p, r, phonetic=False), p, r)).select("name_raw", "c_ein", "tier", "confidence", "method")


@query("m10_resolved", RESOLVED + " SELECT * FROM answers")
def m10(spark, sf_dir):
    return _answers(spark, sf_dir, phonetic=False)


@query("m10_resolved_with_phonetic")
def m10b(spark, sf_dir):
    return _answers(spark, sf_dir)


@query("a09_tier_distribution", RESOLVED + " SELECT tier, count(*) AS n FROM answers GROUP BY 1")
def a09(spark, sf_dir):
    return _answers(spark, sf_dir, phonetic=False).groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


FIX = " CASE WHEN CAST(zip5 AS BIGINT) % 4 = 0 THEN '000000001' END"


@query("j12_m11_corrections", RESOLVED + """, fix AS (SELECT DISTINCT name_normalized, state, zip5 FROM answers WHERE zip5 LIKE '%0')
SELECT a.name_raw, CASE WHEN f.zip5 IS NOT NULL THEN '000000001' ELSE a.ein END AS ein, CASE WHEN f.zip5 IS NOT NULL THEN 'manual_correction' ELSE a.source END AS source, CASE WHEN f.zip5 IS NOT NULL THEN 'A' ELSE a.tier END AS tier,
  CASE WHEN f.zip5 IS NULL THEN a.bmf_name END AS bmf_name, CASE WHEN f.zip5 IS NULL THEN a.ntee_code END AS ntee_code, CASE WHEN f.zip5 IS NULL THEN a.subsection_code END AS subsection_code
FROM answers a LEFT JOIN fix f ON a.name_normalized IS NOT DISTINCT FROM f.name_normalized AND a.state IS NOT DISTINCT FROM f.state AND a.zip5 IS NOT DISTINCT FROM f.zip5""")
def j12(spark, sf_dir):
    fix = _tuples(spark, sf_dir).filter("zip5 LIKE '%0'").select(
        F.col("name_normalized").alias("recipient_name_normalized"), "state", "zip5", F.lit("000000001").alias("ein")
    )
    return _answers(spark, sf_dir, phonetic=False, corrections=fix).select(
        "name_raw", "ein", "source", "tier", "bmf_name", "ntee_code", "subsection_code"
    )


@query(
    "j11_m02_aliases",
    ctes("probes") + " SELECT name_raw, CASE WHEN name_normalized LIKE 'UNHEARD%' THEN 'HARBOR YOUTH FDN' END AS alias FROM (SELECT DISTINCT " + T + " FROM probes)"
)
def j11(spark, sf_dir):
    t = _tuples(spark, sf_dir)
    aliases = t.filter("name_normalized LIKE 'UNHEARD%'").select(
        F.col("name_normalized").alias("alias_normalized"), F.lit("HARBOR YOUTH FDN").alias("canonical_normalized")
    )
    return res.with_aliases(t, aliases).select("name_raw", "alias")


@query("m13_unresolved_again", RESOLVED + f" SELECT DISTINCT {T} FROM answers WHERE tier = 'U'")
def m13(spark, sf_dir):
    return res.pending(_tuples(spark, sf_dir), _answers(spark, sf_dir, phonetic=False), again_unresolved=True)


@query(
    "q10_best_candidates",
    NEAR + ", b AS (SELECT name_raw, c_ein, round(sim, 6) AS sim, count(*) OVER (PARTITION BY idx) AS candidate_count, row_number() OVER (PARTITION BY idx ORDER BY sim DESC, c_ein) AS rn FROM near) SELECT name_raw, candidate_count, c_ein AS best, sim FROM b WHERE rn = 1"
)
def q10(spark, sf_dir):
    from pyspark.sql import Window

    p, r = _open(spark, sf_dir), analog(spark, sf_dir, "registry")
    near = res.compared(res.candidates(p, r, phonetic=False), p, r)
    w = Window.partitionBy("idx").orderBy(F.col("sim").desc(), "c_ein")
    near = near.withColumn("candidate_count", F.count(F.lit(1)).over(Window.partitionBy("idx"))).withColumn("rn", F.row_number().over(w))
    return near.filter("rn = 1").select("name_raw", "candidate_count", F.col("c_ein").alias("best"), F.round("sim", 6).alias("sim"))


@query("m12_m14_k08_resolved_edges", RESOLVED + f""" SELECT p.expected_ein AS grant_id, 2001 + CAST(p.expected_ein AS BIGINT) % 3 AS filing_year, a.ein, a.tier, a.source, a.confidence, a.method, a.bmf_name
FROM probes p JOIN answers a ON {" AND ".join(f"p.{c} IS NOT DISTINCT FROM a.{c}" for c in res.TUPLE)}""")
def m12(spark, sf_dir):
    """Pending tuples resolved in chunks, stored, applied to the edges, their years rewritten; then once more, when nothing is pending."""
    from datetime import datetime

    from almoner.operators.publish import rewrite_years
    from almoner.sources.shared import scratch

    registry, root, answers = analog(spark, sf_dir, "registry"), scratch(spark), scratch(spark)
    none = F.lit(None).cast("string")
    own = analog(spark, sf_dir, "probes").select(
        F.col("expected_ein").alias("grant_id"), (F.lit(2001) + F.col("expected_ein").cast("long") % 3).alias("filing_year"),
        *[F.col(c).alias(res.EDGE_COLUMNS.get(c, c)) for c in res.TUPLE],
        none.alias("recipient_ein_resolved"), F.lit("unresolved").alias("recipient_ein_source"),
        F.lit(None).cast("double").alias("match_confidence"), F.lit("U").alias("match_tier"), none.alias("match_method"),
        *[none.alias(f"recipient_{c}") for c in ("bmf_name", "ntee_code", "subsection_code")],
    )
    own.write.partitionBy("filing_year").parquet(root)
    for k in range(2):
        edges = spark.read.schema(own.schema).parquet(root)
        done = res.resolve_edges(edges, registry, answers, "2026-08", datetime(2026, 8, 1), again_unresolved=bool(k), phonetic=False, chunks=2)
        rewrite_years(spark, done, root, f"{root}-staged-{k}")
    out = spark.read.schema(own.schema).parquet(root)
    return out.select(
        "grant_id", "filing_year", F.col("recipient_ein_resolved").alias("ein"), F.col("match_tier").alias("tier"),
        F.col("recipient_ein_source").alias("source"), F.col("match_confidence").alias("confidence"),
        F.col("match_method").alias("method"), F.col("recipient_bmf_name").alias("bmf_name")
    )


@query("v12_recall_and_abstention", RESOLVED + """, e AS (SELECT CASE WHEN p.name_normalized LIKE 'UNHEARD%' THEN NULL ELSE p.expected_ein END AS expected_ein, a.ein, a.tier FROM probes p JOIN answers a ON p.name_raw = a.name_raw),
n AS (SELECT count(*) FILTER (WHERE ein = expected_ein) AS recalled, count(*) FILTER (WHERE expected_ein IS NOT NULL) AS with_expected, count(*) FILTER (WHERE expected_ein IS NULL AND tier = 'U') AS abstained, count(*) FILTER (WHERE expected_ein IS NULL) AS without_expected FROM e)
SELECT *, CAST(recalled AS DOUBLE) / nullif(with_expected, 0) AS recall, CAST(abstained AS DOUBLE) / nullif(without_expected, 0) AS abstention FROM n""")
def v12b(spark, sf_dir):
    from almoner.operators.quality import overall

    pairs = analog(spark, sf_dir, "probes").select(
        "name_raw", F.when(~F.col("name_normalized").startswith("UNHEARD"), F.col("expected_ein")).alias("expected_ein")
    )
    return overall(_answers(spark, sf_dir, phonetic=False).join(pairs, "name_raw"))


@query(
    "v12_misses",
    RESOLVED + " SELECT p.name_raw, a.ein, p.expected_ein FROM probes p JOIN answers a ON p.name_raw = a.name_raw WHERE a.ein IS NOT NULL AND a.ein IS DISTINCT FROM p.expected_ein"
)
def v12c(spark, sf_dir):
    from almoner.operators.quality import misses

    pairs = analog(spark, sf_dir, "probes").select("name_raw", "expected_ein")
    return misses(_answers(spark, sf_dir, phonetic=False).join(pairs, "name_raw")).select("name_raw", "ein", "expected_ein")


@query("v12_a17_evaluation", RESOLVED + """, e AS (SELECT p.expected_ein, a.ein, a.tier FROM probes p JOIN answers a ON p.name_raw = a.name_raw)
SELECT tier, count(*) AS pairs, count(*) FILTER (WHERE ein IS NOT NULL) AS resolved, count(*) FILTER (WHERE ein = expected_ein) AS correct,
  CASE WHEN count(*) FILTER (WHERE ein IS NOT NULL) > 0 THEN CAST(count(*) FILTER (WHERE ein = expected_ein) AS DOUBLE) / count(*) FILTER (WHERE ein IS NOT NULL) END AS precision FROM e GROUP BY 1""")
def v12(spark, sf_dir):
    from almoner.operators.quality import evaluation

    pairs = analog(spark, sf_dir, "probes").select("name_raw", "expected_ein")
    return evaluation(_answers(spark, sf_dir, phonetic=False).join(pairs, "name_raw"))
