"""Queries over filings: XML is built from orders, parsed back, and held against the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from almoner.operators import filings as fil
from almoner.plans.analogs import table
from almoner.plans.register import query
from almoner.sources.shared import bound_batches

LINES = """
SELECT CAST(o_orderkey AS STRING) AS object_id, CASE WHEN o_orderkey % 3 = 0 THEN 'sched_i' WHEN l_linestatus = 'F' THEN 'pf_paid' ELSE 'pf_future' END AS grp,
       CAST(floor(l_extendedprice) AS BIGINT) AS dollars, s_name AS name, p_name AS purpose, lpad(CAST(s_suppkey AS STRING), 9, '0') AS ein, s_suppkey, o_orderkey,
       lpad(CAST(l_linenumber AS STRING), 4, '0') || lpad(CAST(l_suppkey AS STRING), 9, '0') || lpad(CAST(l_partkey AS STRING), 9, '0') || lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING), 12, '0') AS k
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {supplier} ON l_suppkey = s_suppkey JOIN {part} ON l_partkey = p_partkey
"""
DUCK_LINES = "WITH lines AS (" + LINES.replace("{", "").replace("}", "").replace("AS STRING", "AS VARCHAR") + """),
rows AS (SELECT *, row_number() OVER (PARTITION BY object_id, grp ORDER BY k) - 1 AS ordinal FROM lines)"""


def xml_filings(spark, sf_dir):
    """object_id, filing_year and xml: one document for each order, a few of them broken."""
    lines = spark.sql(LINES, **{t: table(spark, sf_dir, t) for t in ("lineitem", "orders", "supplier", "part")})
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    s = F.col("s_suppkey")
    foreign = tag(
        "RecipientForeignAddress",
        F.concat(tag("AddressLine1Txt", F.lit("1 Rue")), tag("CityNm", F.lit("Paris")), tag("CountryCd", F.lit("FR")))
    )
    here = tag(
        "RecipientUSAddress",
        F.concat(
            tag("AddressLine1Txt", F.lit("9 Main St")), tag("CityNm", F.concat(F.lit("City"), (s % 7).cast("string"))),
            tag("StateAbbreviationCd", F.lit("CA")), tag("ZIPCd", F.lit("94022-1234"))
        )
    )
    person = F.when(s % 10 == 3, tag("RecipientPersonNm", F.col("name"))).when(
        s % 10 == 4, tag("RecipientPersonNm", F.concat(F.lit("Fund "), "name"))
    )
    person = person.otherwise(
        tag(
            "RecipientBusinessName",
            tag(
                "BusinessNameLine1Txt",
                F.when(s % 10 == 5, F.concat(F.lit("City of "), "name")).when(s % 10 == 6, "See attached list").otherwise(F.col("name"))
            )
        )
    )
    amount = F.when(s % 10 == 7, F.lit("N/A")).when(
        s % 10 == 8, F.concat(F.lit("$"), F.format_number("dollars", 0))
    ).otherwise(F.col("dollars").cast("string"))
    pf = F.concat(person, F.when(s % 4 == 0, foreign).otherwise(here), tag("GrantOrContributionPurposeTxt", F.col("purpose")), tag("Amt", amount))
    tables = F.concat(
        tag("RecipientBusinessName", tag("BusinessNameLine1Txt", F.col("name"))),
        tag("USAddress", tag("StateAbbreviationCd", F.lit("NY"))),
        tag("RecipientEIN", F.when(s % 5 == 0, F.lit("12345")).otherwise(F.col("ein"))),
        tag("CashGrantAmt", F.col("dollars").cast("string")), tag("PurposeOfGrantTxt", F.col("purpose"))
    )
    item = F.when(F.col("grp") == "sched_i", tag("RecipientTable", tables)).when(
        F.col("grp") == "pf_paid", tag("GrantOrContributionPdDurYrGrp", pf)
    ).otherwise(tag("GrantOrContriApprvForFutGrp", pf))
    # an item is made before it is collected: aggregates of arrays evaluate without compiled code
    place = F.when(F.col("grp") == "pf_paid", 0).otherwise(1)  # a document has tables, or paid grants and future ones after them
    paid = F.when(F.col("grp") == "pf_paid", F.col("dollars")).otherwise(0)
    made = lines.select("object_id", "o_orderkey", paid.alias("paid"), F.struct(place.alias("place"), "k", item.alias("x")).alias("item"))
    body = made.groupBy("object_id").agg(
        F.array_join(F.sort_array(F.collect_list("item"))["x"], "").alias("items"),
        F.sum("paid").alias("total"), F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("o")
    )
    head = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("object_id"), "o_custkey", F.col("o_orderdate").cast("date").alias("day")
    )
    d = body.join(head, "object_id")
    is_table = F.col("o") % 3 == 0
    header = tag(
        "ReturnHeader",
        F.concat(
            tag("ReturnTypeCd", F.when(is_table, "990").otherwise("990PF")), tag("TaxPeriodEndDt", F.col("day").cast("string")),
            tag(
                "Filer",
                F.concat(
                    tag("EIN", F.lpad(F.col("o_custkey").cast("string"), 8, "1")),
                    tag("BusinessName", F.concat(tag("BusinessNameLine1Txt", F.lit(" Giving ")), tag("BusinessNameLine2Txt", F.lit("House"))))
                )
            )
        )
    )
    pf_body = tag(
        "IRS990PF",
        tag(
            "SupplementaryInformationGrp",
            F.concat(
                "items",
                F.when(F.col("o") % 7 == 1, "").otherwise(
                    tag(
                        "TotalGrantOrContriPdDurYrAmt",
                        F.when(F.col("o") % 7 == 2, F.floor(F.col("total") * 0.9)).otherwise(F.col("total")).cast("string")
                    )
                )
            )
        )
    )
    si_body = tag(
        "IRS990ScheduleI",
        F.concat(
            "items", tag("Total501c3OrgCnt", (F.col("n") - F.when(F.col("o") % 2 == 0, 1).otherwise(0)).cast("string")),
            tag("TotalOtherOrgCnt", F.lit("0"))
        )
    )
    version = F.when(F.col("o") % 2 == 0, "2022v5.0").otherwise("2021v4.0")
    doc = F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?><Return xmlns="http://www.irs.gov/efile" returnVersion="'), version,
        F.lit('">'), header, tag("ReturnData", F.when(is_table, si_body).otherwise(pf_body)), F.lit("</Return>")
    )
    xml = F.when(F.col("o") % 101 == 0, F.substring(doc, 1, 60)).when(F.col("o") % 103 == 0, "<html><body>gone</body></html>").otherwise(doc)
    return d.select("object_id", F.year("day").alias("filing_year"), xml.alias("xml"))


READABLE = "o_orderkey % 101 <> 0 AND o_orderkey % 103 <> 0"


@query(
    "s09_e14_bad_documents",
    f"{DUCK_LINES} SELECT object_id, CASE WHEN o_orderkey % 101 = 0 THEN '{fil.MALFORMED}' ELSE '{fil.NOT_A_RETURN}' END AS error FROM (SELECT DISTINCT object_id, o_orderkey FROM lines) WHERE NOT ({READABLE})"
)
def s09(spark, sf_dir):
    return fil.parsed(xml_filings(spark, sf_dir)).filter("error IS NOT NULL").select("object_id", "error")


@query(
    "e01_e04_e09_headers",
    f"""{DUCK_LINES} SELECT object_id, CASE WHEN o_orderkey % 2 = 0 THEN '2022v5.0' ELSE '2021v4.0' END AS return_version, CASE WHEN o_orderkey % 3 = 0 THEN '990' ELSE '990PF' END AS return_type, '0' || lpad(CAST(o_custkey AS VARCHAR), 8, '1') AS funder_ein,
  'Giving House' AS funder_name, CAST(o_orderdate AS DATE) AS tax_period_end,
  CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 7 = 1 THEN NULL WHEN o_orderkey % 7 = 2 THEN CAST(floor(paid * 0.9::DOUBLE) AS BIGINT) ELSE CAST(paid AS BIGINT) END AS total_paid, CASE WHEN o_orderkey % 3 = 0 THEN n - CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END END AS total_501c3
FROM (SELECT object_id, o_orderkey, sum(CASE WHEN grp = 'pf_paid' THEN dollars ELSE 0 END) AS paid, count(*) AS n FROM lines WHERE {READABLE} GROUP BY 1, 2) JOIN orders USING (o_orderkey)""",
)
def e01(spark, sf_dir):
    h = fil.headers(fil.parsed(xml_filings(spark, sf_dir)).filter("error IS NULL"))
    return h.select("object_id", "return_version", "return_type", "funder_ein", "funder_name", "tax_period_end", "total_paid", "total_501c3")


NAME = "CASE WHEN grp <> 'sched_i' AND s_suppkey % 10 = 4 THEN 'Fund ' || name WHEN grp <> 'sched_i' AND s_suppkey % 10 = 5 THEN 'City of ' || name WHEN grp <> 'sched_i' AND s_suppkey % 10 = 6 THEN 'See attached list' ELSE name END"


@query(
    "e05_e06_e07_w08_grant_rows",
    f"""{DUCK_LINES} SELECT object_id, grp AS "group", CAST(ordinal AS INTEGER) AS ordinal, CASE WHEN grp <> 'sched_i' AND s_suppkey % 10 = 7 THEN NULL ELSE dollars END AS amount_usd, CASE WHEN grp = 'pf_future' THEN 'approved_future' ELSE 'paid' END AS amount_type,
  {NAME} AS recipient_name_raw, purpose AS grant_purpose, CASE WHEN grp = 'sched_i' AND s_suppkey % 5 <> 0 THEN ein END AS recipient_ein_reported,
  CASE WHEN grp = 'sched_i' THEN 'US' WHEN s_suppkey % 4 = 0 THEN 'FR' ELSE 'US' END AS recipient_country FROM rows WHERE {READABLE}""",
)
def e05(spark, sf_dir):
    rows = fil.grant_rows(fil.parsed(xml_filings(spark, sf_dir)))
    return rows.select(
        "object_id", "group", "ordinal", "amount_usd", "amount_type", "recipient_name_raw", "grant_purpose",
        "recipient_ein_reported", "recipient_country"
    )


@query(
    "e10_e11_e12_classified",
    f"""{DUCK_LINES} SELECT object_id, grp AS "group", CAST(ordinal AS INTEGER) AS ordinal, CASE WHEN grp <> 'sched_i' AND s_suppkey % 10 = 6 THEN 'unknown' WHEN grp <> 'sched_i' AND s_suppkey % 10 = 3 THEN 'individual' WHEN grp <> 'sched_i' AND s_suppkey % 10 = 5 THEN 'government' ELSE 'organization' END AS recipient_type,
  CASE WHEN grp <> 'sched_i' AND s_suppkey % 10 = 7 THEN ['unparsed amount: N/A'] WHEN grp = 'sched_i' AND s_suppkey % 5 = 0 THEN ['recipient EIN is not nine digits: 12345'] ELSE [] END AS errors FROM rows WHERE {READABLE}""",
)
def e10(spark, sf_dir):
    return fil.grant_rows(fil.parsed(xml_filings(spark, sf_dir))).select("object_id", "group", "ordinal", "recipient_type", "errors")


@query("e15_f13_edge_records", f"""{DUCK_LINES} SELECT substr(sha256(object_id || ':' || grp || ':' || CAST(ordinal AS VARCHAR)), 1, 32) AS grant_id, object_id, CAST(year(o_orderdate) AS INTEGER) AS tax_year, CAST(year(o_orderdate) AS INTEGER) AS filing_year,
  trim(regexp_replace(upper({NAME}), '[^A-Z0-9]+', ' ', 'g')) AS recipient_name_normalized, CASE WHEN grp = 'sched_i' OR s_suppkey % 4 = 0 THEN NULL ELSE '94022' END AS recipient_zip5, 'U' AS match_tier FROM rows JOIN orders USING (o_orderkey) WHERE {READABLE}""")
def e15(spark, sf_dir):
    from almoner.plans.analogs import analog

    g = fil.grants(xml_filings(spark, sf_dir), analog(spark, sf_dir, "filing_index"), "2026.08.1")
    return g.select("grant_id", "object_id", "tax_year", "filing_year", "recipient_name_normalized", "recipient_zip5", "match_tier")


def _paths(at: str, *under: str) -> str:
    return ", ".join(f"'{at}/{x}'" if x else f"'{at}'" for x in under)


_BASE = _paths(
    "/Return", "", "ReturnHeader", "ReturnHeader/ReturnTypeCd", "ReturnHeader/TaxPeriodEndDt", "ReturnHeader/Filer",
    "ReturnHeader/Filer/EIN", "ReturnHeader/Filer/BusinessName", "ReturnHeader/Filer/BusinessName/BusinessNameLine1Txt",
    "ReturnHeader/Filer/BusinessName/BusinessNameLine2Txt", "ReturnData"
)
_PF, _SI = "/Return/ReturnData/IRS990PF/SupplementaryInformationGrp", "/Return/ReturnData/IRS990ScheduleI"
_FOREIGN, _HERE = ("RecipientForeignAddress", "RecipientForeignAddress/AddressLine1Txt", "RecipientForeignAddress/CityNm", "RecipientForeignAddress/CountryCd"), (
    "RecipientUSAddress", "RecipientUSAddress/AddressLine1Txt", "RecipientUSAddress/CityNm",
    "RecipientUSAddress/StateAbbreviationCd", "RecipientUSAddress/ZIPCd"
)
_TABLE = _paths(
    f"{_SI}/RecipientTable", "", "RecipientBusinessName", "RecipientBusinessName/BusinessNameLine1Txt", "USAddress",
    "USAddress/StateAbbreviationCd", "RecipientEIN", "CashGrantAmt", "PurposeOfGrantTxt"
)


def _group(name: str) -> str:
    """The paths below a repeating group of a line, as a SQL list."""
    g = f"{_PF}/{name}"
    person = f"CASE WHEN s_suppkey % 10 IN (3, 4) THEN [{_paths(g, 'RecipientPersonNm')}] ELSE [{_paths(g, 'RecipientBusinessName', 'RecipientBusinessName/BusinessNameLine1Txt')}] END"
    place = f"CASE WHEN s_suppkey % 4 = 0 THEN [{_paths(g, *_FOREIGN)}] ELSE [{_paths(g, *_HERE)}] END"
    return f"[{_paths(g, '', 'GrantOrContributionPurposeTxt', 'Amt')}] || {person} || {place}"


#: Every element path of each order's document, by how xml_filings() makes it.
ELEMENTS = f"""{DUCK_LINES},
kinds AS (SELECT DISTINCT object_id, o_orderkey FROM lines),
elements AS (
  SELECT object_id, o_orderkey, unnest([{_BASE}]) AS path FROM kinds WHERE {READABLE}
  UNION SELECT object_id, o_orderkey, unnest([{_paths("/html", "", "body")}]) FROM kinds WHERE o_orderkey % 103 = 0 AND o_orderkey % 101 <> 0
  UNION SELECT object_id, o_orderkey, unnest([{_paths("/Return/ReturnData/IRS990PF", "")}, '{_PF}']) FROM kinds WHERE {READABLE} AND o_orderkey % 3 <> 0
  UNION SELECT object_id, o_orderkey, '{_PF}/TotalGrantOrContriPdDurYrAmt' FROM kinds WHERE {READABLE} AND o_orderkey % 3 <> 0 AND o_orderkey % 7 <> 1
  UNION SELECT object_id, o_orderkey, unnest([{_paths(_SI, "", "Total501c3OrgCnt", "TotalOtherOrgCnt")}, {_TABLE}]) FROM kinds WHERE {READABLE} AND o_orderkey % 3 = 0
  UNION SELECT object_id, o_orderkey, unnest({_group("GrantOrContributionPdDurYrGrp")}) FROM lines WHERE {READABLE} AND grp = 'pf_paid'
  UNION SELECT object_id, o_orderkey, unnest({_group("GrantOrContriApprvForFutGrp")}) FROM lines WHERE {READABLE} AND grp = 'pf_future'),
versioned AS (SELECT path, string_agg(DISTINCT v, ';;' ORDER BY v) AS versions, count(DISTINCT object_id) AS filings
  FROM (SELECT *, CASE WHEN starts_with(path, '/html') THEN '' WHEN o_orderkey % 2 = 0 THEN '2022v5.0' ELSE '2021v4.0' END AS v FROM elements) GROUP BY path)"""


@query(
    "e16_element_paths",
    ELEMENTS + " SELECT object_id, count(path) AS n_paths, string_agg(path, ',' ORDER BY path) AS paths FROM elements GROUP BY 1 UNION ALL SELECT object_id, -1, NULL FROM kinds WHERE o_orderkey % 101 = 0"
)
def e16(spark, sf_dir):
    bound_batches(spark)
    paths = xml_filings(spark, sf_dir).select("object_id", fil.element_paths(F.col("xml")).alias("paths"))
    return paths.select("object_id", F.coalesce(F.size("paths"), F.lit(-1)).cast("long").alias("n_paths"), F.array_join("paths", ",").alias("paths"))


@query(
    "e17_a13_unread_paths",
    ELEMENTS + " SELECT * FROM versioned WHERE path NOT IN (" + ", ".join(f"'{p}'" for p in sorted(fil.consumed_paths())) + ")"
)
def e17(spark, sf_dir):
    from almoner.operators.quality import unmapped, versions_of

    seen = versions_of(fil.path_counts(xml_filings(spark, sf_dir)))
    consumed = spark.createDataFrame([(p,) for p in sorted(fil.consumed_paths())], "path string")
    return unmapped(seen, consumed)


@query("e02_modern_first", """WITH p AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 1 THEN 'R/GrantGrp/' ELSE 'R/Grant/' END || 'Leaf' || CAST(n_nationkey AS VARCHAR) || ['Amt', 'Amount', 'Txt', 'Name'][CAST(n_nationkey % 4 + 1 AS BIGINT)] AS path FROM nation)
SELECT CAST(row_number() OVER (ORDER BY k % 4 IN (0, 2) DESC, k % 2 DESC, k) - 1 AS INTEGER) AS place, path FROM p""")
def e02(spark, sf_dir):
    keys = sorted(r[0] for r in table(spark, sf_dir, "nation").select("n_nationkey").collect())  # a field's paths are a list
    paths = [("R/Grant/", "R/GrantGrp/")[k % 2] + f"Leaf{k}" + ("Amt", "Amount", "Txt", "Name")[k % 4] for k in keys]
    return spark.createDataFrame(list(enumerate(fil.modern_first([*paths, *paths]))), "place int, path string")


@query("q20_diagnose", f"""{DUCK_LINES} SELECT object_id, CASE WHEN o_orderkey % 3 = 0 THEN '990' ELSE '990PF' END AS return_type, '{{"funder_ein":"0' || lpad(CAST(o_custkey AS VARCHAR), 8, '1') || '","funder_name":"Giving House","errors":[]}}' AS header, n AS rows, dollars
FROM (SELECT object_id, o_orderkey, count(*) AS n, CAST(sum(CASE WHEN grp = 'sched_i' OR s_suppkey % 10 <> 7 THEN dollars END) AS BIGINT) AS dollars FROM lines WHERE {READABLE} GROUP BY 1, 2) JOIN orders USING (o_orderkey) WHERE object_id IN ('7', '33', '66')""")
def q20(spark, sf_dir):
    """A few filings: their headers, rows and errors."""
    docs = fil.filed(fil.parsed(xml_filings(spark, sf_dir).filter("object_id IN ('7', '33', '66')")).filter("error IS NULL"))
    head = docs.select("object_id", "return_type", F.to_json(F.struct("funder_ein", "funder_name", "errors")).alias("header"))
    rows = fil.grant_rows(docs).groupBy("object_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("amount_usd").alias("dollars"))
    return head.join(rows, "object_id", "left")
