"""Grant records, registries, indexes and recipients made from the order tables.

Each is one SELECT that Spark and DuckDB both take (`{table}` names an input, and what differs between the two has
a name of its own), so that a query and its SQL begin from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK = {"sha": "sha2({}, 256)", "string": "STRING"}
DUCK = {"sha": "sha256({})", "string": "VARCHAR"}

# words of organizations' names: 13 x 11 x 7 combinations
PLACES = "HARBOR,MAPLE,RIVER,SUMMIT,CEDAR,PRAIRIE,GRANITE,LAKESIDE,VALLEY,ORCHARD,PIONEER,BEACON,MERIDIAN"
WORKS = "YOUTH,ARTS,HEALTH,HOUSING,LITERACY,WILDLIFE,SCIENCE,MUSIC,FOOD,JUSTICE,HERITAGE"
KINDS = "FDN,TRUST,COUNCIL,ALLIANCE,CENTER,FUND,SOC"


def _sha(text: str) -> str:
    return "<sha>" + text + "</sha>"


def _name(key: str) -> str:
    return f"split_part('{PLACES}', ',', CAST({key} % 13 + 1 AS INT)) || ' ' || split_part('{WORKS}', ',', CAST({key} % 11 + 1 AS INT)) || ' ' || split_part('{KINDS}', ',', CAST({key} % 7 + 1 AS INT))"


GRANT_KEY = "CAST(o_orderkey AS STRING) || ':' || CAST(l_linenumber AS STRING) || ':' || CAST(l_suppkey AS STRING) || ':' || CAST(l_partkey AS STRING) || ':' || CAST(CAST(l_shipdate AS DATE) AS STRING) || ':' || CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING)"

EDGES = f"""
SELECT CAST(o_orderkey AS STRING) AS object_id, substr({_sha(GRANT_KEY)}, 1, 32) AS grant_id,
       lpad(CAST(c_custkey AS STRING), 9, '0') AS funder_ein, c_name AS funder_name, cn.n_name AS funder_state,
       CASE WHEN o_orderkey % 3 = 0 THEN '990' ELSE '990PF' END AS funder_form_type,
       CAST(year(o_orderdate) AS INT) AS tax_year, CAST(year(l_shipdate) AS INT) AS filing_year, CAST(o_orderdate AS DATE) AS tax_period_end,
       CASE WHEN o_orderkey % 4 = 0 THEN '2021v4.0' WHEN o_orderkey % 4 = 1 THEN '2022v5.0' ELSE '2020v4.0' END AS return_version,
       CAST(floor(l_extendedprice) AS BIGINT) AS amount_usd,
       CASE WHEN l_linestatus = 'F' THEN 'paid' ELSE 'approved_future' END AS amount_type,
       p_name AS grant_purpose, s_name AS recipient_name_raw, {_name("s_suppkey")} AS recipient_name_normalized,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE lpad(CAST(l_suppkey AS STRING), 9, '0') END AS recipient_ein_resolved,
       CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE sn.n_name END AS recipient_state,
       'CITY' || CAST(s_suppkey % 7 AS STRING) AS recipient_city, lpad(CAST(s_suppkey * 37 % 100000 AS STRING), 5, '0') AS recipient_zip5,
       CASE WHEN p_partkey % 50 = 0 THEN 'government' WHEN p_partkey % 50 = 1 THEN 'unknown' ELSE 'organization' END AS recipient_type,
       CASE WHEN l_returnflag = 'N' THEN 'U' WHEN l_quantity >= 40 THEN 'A' WHEN l_quantity >= 25 THEN 'B' WHEN l_quantity >= 10 THEN 'C' ELSE 'D' END AS match_tier,
       CAST(CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_quantity >= 40 THEN 1.0 WHEN l_quantity >= 25 THEN 0.93 WHEN l_quantity >= 10 THEN 0.8 ELSE 0.6 END AS DOUBLE) AS match_confidence
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} cn ON c_nationkey = cn.n_nationkey
     JOIN {{supplier}} ON l_suppkey = s_suppkey JOIN {{nation}} sn ON s_nationkey = sn.n_nationkey JOIN {{part}} ON l_partkey = p_partkey
"""

REGISTRY = f"""
SELECT lpad(CAST(s_suppkey AS STRING), 9, '0') AS ein, {_name("s_suppkey")} AS name_normalized,
       CASE WHEN s_suppkey % 5 = 0 THEN split_part('{PLACES}', ',', CAST(s_suppkey % 13 + 1 AS INT)) || ' CHAPTER ' || CAST(s_suppkey AS STRING) ELSE NULL END AS sort_name_normalized,
       s_name AS name, 'CITY' || CAST(s_suppkey % 7 AS STRING) AS city, n_name AS state, lpad(CAST(s_suppkey * 37 % 100000 AS STRING), 5, '0') AS zip5,
       substr('ABCDEFGHIJ', CAST(s_suppkey % 10 + 1 AS INT), 1) || lpad(CAST(s_suppkey % 90 AS STRING), 2, '0') AS ntee_code,
       '0' || CAST(s_suppkey % 3 + 2 AS STRING) AS subsection_code, split_part('{PLACES}', ',', CAST(s_suppkey % 13 + 1 AS INT)) AS first_token
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
"""

#: A later vintage: some organizations renamed, some new.
REGISTRY_LATER = f"""
SELECT lpad(CAST(s_suppkey + 5 AS STRING), 9, '0') AS ein, {_name("s_suppkey")} || ' RENAMED' AS name_normalized, n_name AS state, '2026-08' AS vintage
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey WHERE s_suppkey % 3 = 0
"""

#: Recipients as filed: exact, shortened, reworded, in the wrong state, without place, misspelt, unknown.
PROBES = f"""
SELECT CASE s_suppkey % 8 WHEN 1 THEN substr(n, 1, length(n) - 1) WHEN 5 THEN substr(n, 1, 4) || 'X' || substr(n, 6) WHEN 7 THEN 'UNHEARD OF ' || CAST(s_suppkey AS STRING) ELSE n END AS name_normalized,
       s_name AS name_raw, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'CITY' || CAST(s_suppkey % 7 AS STRING) END AS city,
       CASE s_suppkey % 8 WHEN 3 THEN 'NOWHERE' WHEN 6 THEN NULL ELSE st END AS state,
       CASE WHEN s_suppkey % 8 IN (4, 6) THEN NULL ELSE lpad(CAST(s_suppkey * 37 % 100000 AS STRING), 5, '0') END AS zip5,
       CASE s_suppkey % 17 WHEN 1 THEN lpad(CAST(s_suppkey AS STRING), 9, '0') WHEN 2 THEN '99' || lpad(CAST(s_suppkey AS STRING), 7, '0') WHEN 3 THEN '000000000' ELSE NULL END AS ein_reported,
       CASE WHEN s_suppkey % 29 = 28 THEN 'individual' WHEN s_suppkey % 29 = 27 THEN 'government' ELSE 'organization' END AS recipient_type,
       lpad(CAST(s_suppkey AS STRING), 9, '0') AS expected_ein
FROM (SELECT s_suppkey, s_name, n_name AS st, {_name("s_suppkey")} AS n FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey) x
"""

INDEX = """
SELECT CAST(o_orderkey AS STRING) AS object_id, lpad(CAST(o_custkey % 40 AS STRING), 9, '0') AS ein, CAST(year(o_orderdate) AS STRING) || '12' AS tax_period,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '990' WHEN '2' THEN '990O' WHEN '3' THEN '990PF' WHEN '4' THEN '990PR' ELSE '990EO' END AS return_type,
       CASE WHEN o_orderkey % 4 = 0 THEN CAST(year(o_orderdate) AS STRING) WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS sub_date,
       CAST(year(o_orderdate) AS INT) AS filing_year
FROM {orders}
"""

MEMBERS = """
SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'X' || CAST(o_orderkey AS STRING) ELSE CAST(o_orderkey AS STRING) END AS object_id,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(year(o_orderdate) AS STRING) || '_TEOS_XML_0' || CAST(o_orderkey % 3 + 1 AS STRING) || 'A.zip' ELSE 'download990xml_' || CAST(year(o_orderdate) AS STRING) || '_1.zip' END AS zip_file,
       o_orderkey * 7 + 100 AS bytes
FROM {orders} WHERE o_orderkey % 10 <> 0
"""

ANALOGS = {"edges": EDGES, "registry": REGISTRY, "registry_later": REGISTRY_LATER, "probes": PROBES, "filing_index": INDEX, "members": MEMBERS}
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "benchmark", "pages", "labels",
    "conversations", "events"
)


def _dialect(sql: str, kind: dict[str, str]) -> str:
    while "<sha>" in sql:
        before, _, rest = sql.partition("<sha>")
        inner, _, after = rest.partition("</sha>")
        sql = before + kind["sha"].format(inner) + after
    return sql.replace("AS STRING", f"AS {kind['string']}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def analog(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = _dialect(ANALOGS[name], SPARK)
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql})


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analog(spark, sf_dir, "edges")


def ctes(*names: str) -> str:
    """WITH clause of those analogs, for DuckDB."""
    return "WITH " + ",\n".join(f"{n} AS ({_dialect(ANALOGS[n], DUCK).replace('{', '').replace('}', '')})" for n in names)
