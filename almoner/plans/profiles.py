"""Queries over profiles, companion tables, pages and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from almoner.functions import formats
from almoner.functions.values import quoted
from almoner.operators import profiles as pro
from almoner.plans.analogs import analog, ctes, edges
from almoner.plans.register import query

KEY = "coalesce(recipient_ein_resolved, coalesce(recipient_name_normalized, '') || '|' || coalesce(recipient_state, ''))"
FUNDERS = f"""SELECT e.*, ntee_code FROM (SELECT funder_ein, min(funder_name) AS funder_name, min(funder_state) AS funder_state,
  CAST(coalesce(sum(amount_usd) FILTER (WHERE amount_type = 'paid'), 0) AS BIGINT) AS paid_usd, count(*) FILTER (WHERE amount_type = 'paid') AS paid_grants,
  CAST(coalesce(sum(amount_usd) FILTER (WHERE amount_type = 'approved_future'), 0) AS BIGINT) AS future_usd, count(*) FILTER (WHERE amount_type = 'approved_future') AS future_grants,
  count(DISTINCT {KEY}) FILTER (WHERE amount_type = 'paid') AS recipients, min(tax_year) AS first_year, max(tax_year) AS last_year, max(tax_period_end) AS last_period_end, count(*) AS rows
  FROM edges GROUP BY funder_ein) e LEFT JOIN registry r ON e.funder_ein = r.ein"""
RECIPIENTS = """SELECT recipient_ein_resolved, paid_usd, paid_grants, future_usd, funders, first_year, last_year, ntee_code, coalesce(name, raw) AS name FROM (SELECT recipient_ein_resolved,
  CAST(coalesce(sum(amount_usd) FILTER (WHERE amount_type = 'paid'), 0) AS BIGINT) AS paid_usd, count(*) FILTER (WHERE amount_type = 'paid') AS paid_grants,
  CAST(coalesce(sum(amount_usd) FILTER (WHERE amount_type = 'approved_future'), 0) AS BIGINT) AS future_usd, count(DISTINCT funder_ein) AS funders, min(tax_year) AS first_year, max(tax_year) AS last_year,
  min(recipient_name_raw) AS raw FROM edges WHERE recipient_ein_resolved IS NOT NULL GROUP BY 1) e LEFT JOIN registry r ON recipient_ein_resolved = r.ein"""
BOTH = ctes("edges", "registry")


@query(
    "q01_funder_grants",
    ctes("edges") + " SELECT grant_id, amount_usd, tax_year, recipient_name_raw FROM edges WHERE funder_ein = '000000007' AND amount_type = 'paid' AND amount_usd >= 1000 AND match_confidence >= 0.6 ORDER BY amount_usd DESC, grant_id LIMIT 25"
)
def q01(spark, sf_dir):
    return pro.funder_grants(
        edges(spark, sf_dir), "000000007", min_amount=1000, min_confidence=0.6, limit=25
    ).select("grant_id", "amount_usd", "tax_year", "recipient_name_raw")


@query(
    "q02_funders_of_recipient",
    ctes("edges") + " SELECT recipient_ein_resolved, funder_ein, funder_name, CAST(sum(amount_usd) AS BIGINT) AS total_usd, count(*) AS grants, max(tax_year) AS last_year FROM edges WHERE amount_type = 'paid' AND match_confidence >= 0.9 AND recipient_ein_resolved IS NOT NULL GROUP BY 1, 2, 3"
)
def q02(spark, sf_dir):
    return pro.funders_of_recipients(edges(spark, sf_dir))


@query(
    "a20_p07_one_recipient",
    ctes("edges") + " SELECT funder_ein, CAST(sum(amount_usd) AS BIGINT) AS total_usd, count(*) AS grants, max(tax_year) AS last_year FROM edges WHERE amount_type = 'paid' AND match_confidence >= 0.9 AND recipient_ein_resolved = '000000003' GROUP BY funder_ein"
)
def a20(spark, sf_dir):
    return pro.funders_of_recipients(edges(spark, sf_dir), recipient_ein="000000003").select("funder_ein", "total_usd", "grants", "last_year")


@query(
    "q03_funders_by_keyword",
    ctes("edges") + " SELECT funder_ein, funder_name, CAST(sum(amount_usd) AS BIGINT) AS total_usd, count(*) AS grants FROM edges WHERE amount_type = 'paid' AND (contains(upper(grant_purpose), 'RING') OR contains(upper(recipient_name_raw), 'RING')) AND amount_usd >= 500 GROUP BY 1, 2 ORDER BY total_usd DESC, funder_ein LIMIT 25"
)
def q03(spark, sf_dir):
    return pro.funders_by_keyword(edges(spark, sf_dir), "ring", min_amount=500)


@query("a02_j06_q08_funder_totals", f"{BOTH} {FUNDERS}")
def a02(spark, sf_dir):
    return pro.funder_totals(edges(spark, sf_dir), analog(spark, sf_dir, "registry"))


@query(
    "a04_w02_funder_recipients",
    ctes("edges") + f" SELECT * EXCLUDE (rn), CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY funder_ein ORDER BY total_usd DESC, recipient) AS rn FROM (SELECT funder_ein, {KEY} AS recipient, min(recipient_name_raw) AS name, CAST(sum(amount_usd) AS BIGINT) AS total_usd, count(*) AS grants, max(tax_year) AS last_year FROM edges WHERE amount_type = 'paid' GROUP BY 1, 2)) WHERE rn <= 5"
)
def a04(spark, sf_dir):
    return pro.funder_recipients(edges(spark, sf_dir), 5)


@query("a05_j07_q09_recipient_totals", f"{BOTH} {RECIPIENTS}")
def a05(spark, sf_dir):
    return pro.recipient_totals(edges(spark, sf_dir), analog(spark, sf_dir, "registry"))


@query(
    "a06_w04_recipient_funders",
    ctes("edges") + " SELECT * EXCLUDE (rn), CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY recipient_ein_resolved ORDER BY total_usd DESC, funder_ein) AS rn FROM (SELECT recipient_ein_resolved, funder_ein, CAST(sum(amount_usd) AS BIGINT) AS total_usd, count(*) AS grants, max(tax_year) AS last_year, string_agg(DISTINCT match_tier, '' ORDER BY match_tier) AS tiers FROM edges WHERE amount_type = 'paid' AND recipient_ein_resolved IS NOT NULL GROUP BY 1, 2)) WHERE rn <= 5"
)
def a06(spark, sf_dir):
    return pro.recipient_funders(edges(spark, sf_dir), 5)


def _recent(by: str) -> str:
    return ctes("edges") + f" SELECT {by}, grant_id, CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY tax_year DESC NULLS LAST, amount_usd DESC NULLS LAST, grant_id) AS rn FROM edges WHERE {by} IS NOT NULL) WHERE rn <= 10"


@query("w03_recent_by_funder", _recent("funder_ein"))
def w03(spark, sf_dir):
    return pro.recent_grants(edges(spark, sf_dir), "funder_ein", 10).select("funder_ein", "grant_id", "rn")


@query("w05_recent_by_recipient", _recent("recipient_ein_resolved"))
def w05(spark, sf_dir):
    return pro.recent_grants(edges(spark, sf_dir), "recipient_ein_resolved", 10).select("recipient_ein_resolved", "grant_id", "rn")


@query(
    "a22_q10_unmatched",
    ctes("edges") + " SELECT recipient_name_normalized, recipient_state, count(*) AS occurrences, CAST(sum(amount_usd) AS BIGINT) AS total_usd FROM edges WHERE recipient_ein_resolved IS NULL GROUP BY 1, 2"
)
def a22(spark, sf_dir):
    return pro.unmatched(edges(spark, sf_dir))


@query(
    "q04_k11_q19_funder_payloads",
    f"""{BOTH}, f AS ({FUNDERS}),
y AS (SELECT funder_ein, string_agg(concat_ws('/', tax_year, paid, future, n, filings), ' ' ORDER BY tax_year) AS years FROM (
  SELECT funder_ein, tax_year, CAST(coalesce(sum(amount_usd) FILTER (WHERE amount_type = 'paid'), 0) AS BIGINT) AS paid, CAST(coalesce(sum(amount_usd) FILTER (WHERE amount_type = 'approved_future'), 0) AS BIGINT) AS future,
    count(*) AS n, count(DISTINCT object_id) AS filings FROM edges GROUP BY 1, 2) GROUP BY 1),
o AS (SELECT funder_ein, string_agg(object_id || '/' || tax_year || '/' || return_version, ' ' ORDER BY object_id, tax_year, filing_year) AS filings FROM (SELECT DISTINCT funder_ein, object_id, tax_year, filing_year, return_version FROM edges) GROUP BY 1),
t AS (SELECT funder_ein, string_agg(recipient || '/' || total || '/' || n, ' ' ORDER BY rn) AS top FROM (SELECT *, row_number() OVER (PARTITION BY funder_ein ORDER BY total DESC, recipient) AS rn FROM (
  SELECT funder_ein, {KEY} AS recipient, CAST(sum(amount_usd) AS BIGINT) AS total, count(*) AS n FROM edges WHERE amount_type = 'paid' GROUP BY 1, 2)) WHERE rn <= 5 GROUP BY 1),
g AS (SELECT funder_ein, string_agg(concat_ws('/', grant_id, tax_year, amount_type, amount_usd, recipient_name_raw, coalesce(recipient_ein_resolved, '-'), match_tier, grant_purpose, recipient_city, recipient_type), ' ' ORDER BY rn) AS recent
  FROM (SELECT *, row_number() OVER (PARTITION BY funder_ein ORDER BY tax_year DESC NULLS LAST, amount_usd DESC NULLS LAST, grant_id) AS rn FROM edges) WHERE rn <= 10 GROUP BY 1)
SELECT funder_ein, paid_usd, future_usd, recipients, years, filings, coalesce(top, '') AS top, recent, '2026.08.1' AS version FROM f JOIN y USING (funder_ein) JOIN o USING (funder_ein) JOIN g USING (funder_ein) LEFT JOIN t USING (funder_ein)""",
)
def q04(spark, sf_dir):
    docs = pro.funder_payloads(edges(spark, sf_dir), analog(spark, sf_dir, "registry"), 5, 10, {"dataset_version": "2026.08.1"})
    grant = "struct<grant_id:string,tax_year:int,amount_type:string,amount_usd:long,recipient_name:string,recipient_ein:string,match_tier:string,purpose:string,city:string,recipient_type:string>"
    shape = f"""paid_usd long, future_usd long, recipients long, years array<struct<tax_year:int,paid_usd:long,future_usd:long,grants:long,filings:long>>, dataset_version string,
      filings array<struct<object_id:string,tax_year:int,filing_year:int,return_version:string>>, top_recipients array<struct<recipient:string,total_usd:long,grants:long>>, recent_grants array<{grant}>"""
    p = F.from_json("payload", shape)
    return docs.select(
        "funder_ein", p["paid_usd"].alias("paid_usd"), p["future_usd"].alias("future_usd"), p["recipients"].alias("recipients"),
        _shown(p["years"], "tax_year", "paid_usd", "future_usd", "grants", "filings").alias("years"),
        _shown(p["filings"], "object_id", "tax_year", "return_version").alias("filings"),
        _shown(p["top_recipients"], "recipient", "total_usd", "grants").alias("top"),
        _shown(
            p["recent_grants"], "grant_id", "tax_year", "amount_type", "amount_usd", "recipient_name", "recipient_ein",
            "match_tier", "purpose", "city", "recipient_type"
        ).alias("recent"),
        p["dataset_version"].alias("version"),
    )


def _shown(rows, *fields):
    """A document's array as one text."""
    return F.coalesce(
        F.array_join(F.transform(rows, lambda x: F.concat_ws("/", *[F.coalesce(x[f].cast("string"), F.lit("-")) for f in fields])), " "),
        F.lit("")
    )


@query(
    "q05_recipient_payloads",
    f"""{BOTH}, r AS ({RECIPIENTS}), n AS (SELECT funder_ein, min(funder_name) AS funder_name FROM edges GROUP BY 1),
t AS (SELECT recipient_ein_resolved, string_agg(concat_ws('/', funder_ein, funder_name, total, n, last, tiers), ' ' ORDER BY rn) AS funders_by_total FROM (SELECT *, row_number() OVER (PARTITION BY recipient_ein_resolved ORDER BY total DESC, funder_ein) AS rn FROM (
  SELECT recipient_ein_resolved, funder_ein, CAST(sum(amount_usd) AS BIGINT) AS total, count(*) AS n, max(tax_year) AS last, string_agg(DISTINCT match_tier, '' ORDER BY match_tier) AS tiers FROM edges
  WHERE amount_type = 'paid' AND recipient_ein_resolved IS NOT NULL GROUP BY 1, 2)) JOIN n USING (funder_ein) WHERE rn <= 5 GROUP BY 1),
g AS (SELECT recipient_ein_resolved, string_agg(concat_ws('/', grant_id, funder_ein, funder_name, tax_year, amount_usd, match_tier), ' ' ORDER BY rn) AS recent
  FROM (SELECT *, row_number() OVER (PARTITION BY recipient_ein_resolved ORDER BY tax_year DESC NULLS LAST, amount_usd DESC NULLS LAST, grant_id) AS rn FROM edges WHERE recipient_ein_resolved IS NOT NULL) WHERE rn <= 10 GROUP BY 1)
SELECT r.recipient_ein_resolved, r.name, r.paid_usd, r.future_usd, r.funders, r.first_year, r.last_year, b.city, b.state, coalesce(t.funders_by_total, '') AS funders_by_total, g.recent
FROM r JOIN g USING (recipient_ein_resolved) LEFT JOIN t USING (recipient_ein_resolved) LEFT JOIN registry b ON r.recipient_ein_resolved = b.ein""",
)
def q05b(spark, sf_dir):
    docs = pro.recipient_payloads(edges(spark, sf_dir), analog(spark, sf_dir, "registry"), 5, 10)
    shape = """name string, paid_usd long, future_usd long, funders long, first_year int, last_year int, city string, state string,
      funders_by_total array<struct<funder_ein:string,funder_name:string,total_usd:long,grants:long,last_year:int,tiers:string>>,
      recent_grants array<struct<grant_id:string,funder_ein:string,funder_name:string,tax_year:int,amount_usd:long,match_tier:string>>"""
    p = F.from_json("payload", shape)
    return docs.select(
        "recipient_ein_resolved", *[p[c].alias(c) for c in ("name", "paid_usd", "future_usd", "funders", "first_year", "last_year", "city", "state")],
        _shown(p["funders_by_total"], "funder_ein", "funder_name", "total_usd", "grants", "last_year", "tiers").alias("funders_by_total"),
        _shown(p["recent_grants"], "grant_id", "funder_ein", "funder_name", "tax_year", "amount_usd", "match_tier").alias("recent"),
    )


@query(
    "q05_recipient_profile",
    f"{BOTH}, r AS ({RECIPIENTS}) SELECT recipient_ein_resolved, name, paid_usd, funders FROM r WHERE recipient_ein_resolved = '000000005'"
)
def q05(spark, sf_dir):
    return pro.recipient_totals(
        edges(spark, sf_dir), analog(spark, sf_dir, "registry")
    ).filter("recipient_ein_resolved = '000000005'").select("recipient_ein_resolved", "name", "paid_usd", "funders")


PAGED = ctes("edges") + ", l AS (SELECT funder_ein FROM edges GROUP BY 1 HAVING count(*) > 60), p AS (SELECT funder_ein, tax_year, grant_id, CAST(ceil(row_number() OVER (PARTITION BY funder_ein, tax_year ORDER BY amount_usd DESC, grant_id) / 4.0) AS INTEGER) AS page FROM edges WHERE funder_ein IN (SELECT funder_ein FROM l))"


@query("k12_q18_year_pages", PAGED + " SELECT funder_ein, tax_year, grant_id, page FROM p")
def k12(spark, sf_dir):
    return pro.year_pages(edges(spark, sf_dir), 60, 4).select("funder_ein", "tax_year", "grant_id", "page")


@query(
    "k12_page_counts",
    PAGED + " SELECT funder_ein, string_agg(tax_year || ':' || pages, ' ' ORDER BY tax_year) AS pages FROM (SELECT funder_ein, tax_year, max(page) AS pages FROM p GROUP BY 1, 2) GROUP BY 1"
)
def k12b(spark, sf_dir):
    pages = pro.page_counts(pro.year_pages(edges(spark, sf_dir), 60, 4))
    return pages.select(
        "funder_ein",
        F.array_join(
            F.transform(F.sort_array(F.map_entries("pages")), lambda x: F.concat_ws(":", x["key"], x["value"].cast("string"))),
            " "
        ).alias("pages")
    )


def _browse(where: str, page: int, size: int) -> str:
    return f"{BOTH}, f AS ({FUNDERS}) SELECT funder_ein, funder_name, paid_usd FROM f WHERE {where} ORDER BY paid_usd DESC, funder_ein LIMIT {size} OFFSET {(page - 1) * size}"


@query("q12_browse_by_state", _browse("funder_state = 'NATION_19'", 2, 4))
def q12(spark, sf_dir):
    page, _ = pro.browse(pro.funder_totals(edges(spark, sf_dir), analog(spark, sf_dir, "registry")), F.col("funder_state") == "NATION_19", 2, 4)
    return page.select("funder_ein", "funder_name", "paid_usd")


@query("q13_browse_by_field", _browse("ntee_code LIKE 'B%'", 1, 10))
def q13(spark, sf_dir):
    page, _ = pro.browse(pro.funder_totals(edges(spark, sf_dir), analog(spark, sf_dir, "registry")), F.col("ntee_code").startswith("B"), 1, 10)
    return page.select("funder_ein", "funder_name", "paid_usd")


def _entities(spark, sf_dir):
    e, r = edges(spark, sf_dir), analog(spark, sf_dir, "registry")
    funders = e.select(F.col("funder_ein").alias("ein"), F.lit("funder").alias("kind"), F.col("funder_name").alias("name")).distinct()
    return funders.unionByName(r.select("ein", F.lit("recipient").alias("kind"), F.col("name_normalized").alias("name")))


@query(
    "q14_name_search",
    ctes("registry") + " SELECT ein, 'recipient' AS kind, name_normalized AS name FROM registry WHERE list_contains(string_split(name_normalized, ' '), 'HARBOR') AND len(list_filter(string_split(name_normalized, ' '), lambda x: starts_with(x, 'YOU'))) > 0 ORDER BY len(string_split(name_normalized, ' ')), name_normalized, ein LIMIT 25"
)
def q14(spark, sf_dir):
    return pro.search(pro.search_index(_entities(spark, sf_dir)), "harbor you")


@query("q15_number_search", ctes("edges") + " SELECT DISTINCT funder_ein AS ein, 'funder' AS kind, funder_name AS name FROM edges WHERE funder_ein = '000000004'")
def q15(spark, sf_dir):
    return pro.search(pro.search_index(_entities(spark, sf_dir)), "00-0000004")


@query(
    "q11_by_recipient_order",
    ctes("edges") + " SELECT grant_id, row_number() OVER (PARTITION BY filing_year ORDER BY recipient_ein_resolved NULLS LAST, amount_usd DESC, grant_id) AS place FROM edges"
)
def q11(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("filing_year").orderBy(F.col("recipient_ein_resolved").asc_nulls_last(), F.col("amount_usd").desc(), "grant_id")
    return edges(spark, sf_dir).select("grant_id", F.row_number().over(w).cast("long").alias("place"))


@query(
    "k13_sql_literals",
    ctes("registry") + " SELECT ein, 'INSERT INTO recipients VALUES (' || '''' || ein || '''' || ', ' || '''' || replace(name, '''', '''''') || '''' || ');' AS statement FROM registry"
)
def k13(spark, sf_dir):
    r = analog(spark, sf_dir, "registry")
    return r.select(
        "ein",
        F.concat(F.lit("INSERT INTO recipients VALUES ("), quoted(F.col("ein")), F.lit(", "), quoted(F.col("name")), F.lit(");")).alias("statement")
    )


@query(
    "q_page_values",
    f"{BOTH}, f AS ({FUNDERS}), m AS (SELECT max(paid_usd) AS m FROM f) SELECT funder_ein, CAST(greatest(1, round(100.0 * paid_usd / m, 0)) AS INTEGER) AS bar, coalesce('$' || format('{{:,}}', paid_usd), '—') AS shown FROM f, m"
)
def q_page(spark, sf_dir):
    f = pro.funder_totals(edges(spark, sf_dir), analog(spark, sf_dir, "registry"))
    top = f.agg(F.max("paid_usd").alias("m"))
    bar = F.greatest(F.lit(1.0), F.round(F.lit(100.0) * F.col("paid_usd") / top.scalar(), 0)).cast("int")
    return f.select("funder_ein", bar.alias("bar"), formats.money(F.col("paid_usd")).alias("shown"))
