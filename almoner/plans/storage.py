"""Queries over sources, sinks and streams: written, read back, and held against what was written."""

from __future__ import annotations

import os
import shutil
import struct
import tempfile
import uuid
import zlib
from pathlib import Path

import pandas as pd
from pyspark.sql import functions as F

from almoner.functions.values import quoted
from almoner.operators import filings as fil
from almoner.operators import publish as pub
from almoner.operators import relational as rel
from almoner.plans.analogs import analog, ctes, edges, table
from almoner.plans.register import query
from almoner.sources import archives, tables
from almoner.sources.shared import put, scratch, written
from almoner.streaming import postings


def _grants(spark, sf_dir):
    return edges(spark, sf_dir).withColumn("dataset_version", F.lit("2026.08.1"))


@query("k01_s15_edge_files", ctes("edges") + " SELECT grant_id, filing_year, amount_usd FROM edges WHERE filing_year = 1998")
def k01(spark, sf_dir):
    root = scratch(spark)
    pub.write_edges(_grants(spark, sf_dir), root)
    return tables.published(spark, f"{root}/grants", [1998]).select("grant_id", "filing_year", "amount_usd")


@query(
    "k02_k10_rewritten_years",
    ctes("edges") + " SELECT grant_id, CASE WHEN filing_year = 1999 THEN 'X' ELSE match_tier END AS match_tier FROM edges"
)
def k02(spark, sf_dir):
    root = scratch(spark)
    pub.write_edges(_grants(spark, sf_dir), root)
    year = tables.published(spark, f"{root}/grants", [1999])
    pub.rewrite_years(spark, year.withColumn("match_tier", F.lit("X")), f"{root}/grants", f"{root}/staged")
    return tables.published(spark, f"{root}/grants").select("grant_id", "match_tier")


@query(
    "k03_l01_l03_s16_staged_order",
    ctes("edges") + " SELECT grant_id, row_number() OVER (PARTITION BY filing_year ORDER BY funder_ein, tax_year NULLS FIRST, amount_usd DESC NULLS LAST, grant_id) - 1 AS row_index FROM edges"
)
def k03(spark, sf_dir):
    out = pub.stage(_grants(spark, sf_dir), scratch(spark), "2026.08.1", files=None)  # no task holds a year
    return tables.ordered_rows(spark, out).select("grant_id", "row_index")


@query("k05_l04_csv_report", ctes("filing_index") + " SELECT return_type, CAST(count(*) AS VARCHAR) AS n FROM filing_index GROUP BY 1")
def k05(spark, sf_dir):
    path = scratch(spark)
    pub.report(analog(spark, sf_dir, "filing_index").groupBy("return_type").agg(F.count(F.lit(1)).alias("n")), path, [F.col("return_type")])
    return tables.csv(spark, path)


@query("k06_error_lines", ctes("members") + " SELECT object_id || ': unreadable' AS value FROM members WHERE object_id LIKE 'X%'")
def k06(spark, sf_dir):
    path = scratch(spark)
    pub.error_lines(analog(spark, sf_dir, "members").filter("object_id LIKE 'X%'").withColumn("error", F.lit("unreadable")), path)
    return spark.read.text(path)


SITEMAPS = """, f AS (SELECT DISTINCT funder_ein AS ein FROM edges), u AS (SELECT 'recipients' AS series, ein FROM registry UNION ALL SELECT 'funders', ein FROM f),
n AS (SELECT series, CAST((row_number() OVER (PARTITION BY series ORDER BY ein) - 1) // 30 + 1 AS INTEGER) AS number, ein FROM u)
SELECT series, number, '<url><loc>/' || series || '/' || ein || '</loc><lastmod>2026-08-01</lastmod></url>' AS value FROM n
UNION ALL SELECT DISTINCT series, number, unnest(['<?xml version="1.0" encoding="UTF-8"?>', '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">', '</urlset>']) FROM n
UNION ALL SELECT DISTINCT 'index', 0, '<sitemap><loc>/' || series || '/number=' || lpad(CAST(number AS VARCHAR), 5, '0') || '</loc><lastmod>2026-08-01</lastmod></sitemap>' FROM n"""


@query("k14_sitemaps", ctes("edges", "registry") + SITEMAPS)
def k14(spark, sf_dir):
    path = scratch(spark)
    series = {
        "funders": edges(spark, sf_dir).select(F.col("funder_ein").alias("ein")).distinct(),
        "recipients": analog(spark, sf_dir, "registry").select("ein")
    }
    pub.sitemaps({k: v.select(F.concat(F.lit(f"/{k}/"), "ein").alias("url")) for k, v in series.items()}, path, "2026-08-01", "", 30)
    index = spark.read.text(f"{path}/sitemap-index.xml").filter("value LIKE '<sitemap>%'").select(
        F.lit("index").alias("series"), F.lit(0).alias("number"), "value"
    )
    for k in series:
        index = index.unionByName(spark.read.text(f"{path}/{k}").select(F.lit(k).alias("series"), "number", "value"))
    return index


@query(
    "k13_insert_files",
    ctes("registry") + " SELECT CAST((row_number() OVER (ORDER BY ein) - 1) // 30 AS INTEGER) AS chunk, 'INSERT INTO r VALUES (''' || ein || ''');' AS value FROM registry"
)
def k13(spark, sf_dir):
    path = scratch(spark)
    rows = analog(spark, sf_dir, "registry").select(
        "ein", F.concat(F.lit("INSERT INTO r VALUES ("), quoted(F.col("ein")), F.lit(");")).alias("statement")
    )
    pub.write_inserts(rows, path, [F.col("ein")], 30)
    return spark.read.text(path).select("chunk", "value")


@query("s04_ledger", "SELECT 'f' || CAST(o_custkey AS VARCHAR) AS url, max(CAST(o_orderdate AS DATE)) AS fetched_at FROM orders GROUP BY 1")
def s04(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("f"), F.col("o_custkey").cast("string")).alias("url"),
        F.col("o_orderdate").cast("date").alias("fetched_at"), F.lit("00").alias("sha256"), "o_orderkey"
    )
    return pub.put_ledger(o.filter("o_orderkey % 2 = 0"), o.filter("o_orderkey % 2 = 1")).select("url", "fetched_at")


@query("s05_index_csv", ctes("filing_index") + " SELECT object_id, ein, tax_period, return_type, sub_date FROM filing_index")
def s05(spark, sf_dir):
    path = scratch(spark)
    cols = {
        "OBJECT_ID": "object_id", "Ein": "ein", "TAX_PERIOD": "tax_period", "RETURN_TYPE": "return_type", "Sub_Date": "sub_date",
        "Taxpayer Name": "ein"
    }
    analog(spark, sf_dir, "filing_index").select(*[F.col(c).alias(k) for k, c in cols.items()]).write.csv(path, header=True)
    return tables.index(spark, path).select("object_id", "ein", "tax_period", "return_type", "sub_date")


class _ZipWriter:
    """An archive that is written as a stream: its directory waits in a file, not in memory."""

    def __init__(self, path: str):
        self.file, self.index, self.n, self.at = open(path, "wb"), tempfile.TemporaryFile(), 0, 0  # noqa: SIM115

    def add(self, name: str, body: bytes) -> None:
        deflate, title = zlib.compressobj(wbits=-15), name.encode()
        packed = deflate.compress(body) + deflate.flush()
        facts = struct.pack("<HHHHHLLLH", 20, 0x800, 8, 0, 33, zlib.crc32(body), len(packed), len(body), len(title))
        self.file.write(b"PK\x03\x04" + facts + b"\0\0" + title + packed)
        wide = struct.pack("<HHQ", 1, 8, self.at) if self.at >= 0xFFFFFFFF else b""
        self.index.write(b"PK\x01\x02\x14\0" + facts + struct.pack("<HHHHLL", len(wide), 0, 0, 0, 0, min(self.at, 0xFFFFFFFF)) + title + wide)
        self.n, self.at = self.n + 1, self.at + 30 + len(title) + len(packed)

    def close(self) -> None:
        size, n, at = self.index.tell(), self.n, self.at
        self.index.seek(0)
        shutil.copyfileobj(self.index, self.file)
        if n >= 0xFFFF or at >= 0xFFFFFFFF or size >= 0xFFFFFFFF:
            self.file.write(b"PK\x06\x06" + struct.pack("<QHHLLQQQQ", 44, 45, 45, 0, 0, n, n, size, at) + b"PK\x06\x07" + struct.pack("<LQL", 0, at + size, 1))
        self.file.write(b"PK\x05\x06" + struct.pack("<HHHHLLH", 0, 0, min(n, 0xFFFF), min(n, 0xFFFF), min(size, 0xFFFFFFFF), min(at, 0xFFFFFFFF), 0))
        self.index.close()
        self.file.close()


def _zips(spark, sf_dir) -> str:
    """A shared folder with the archives of all members, each written by one task (the archives are these queries' fixture)."""
    folder = scratch(spark)
    local = folder.removeprefix("file:")  # the folder is mounted on every machine
    local = "/" + local.lstrip("/")

    def write(batches):
        os.makedirs(local, exist_ok=True)
        name = z = part = None

        def close():
            if z is not None:
                z.add("part/readme.txt", b"not a filing")
                z.close()
                os.replace(part, f"{local}/{name}")

        for batch in batches:
            for zip_file, i in zip(batch["zip_file"], batch["object_id"], strict=True):
                if zip_file != name:
                    close()
                    name, part = zip_file, f"{local}/.{uuid.uuid4().hex}"
                    z = _ZipWriter(part)
                z.add(f"part/{i}_public.xml", f"<Return id='{i}'/>".encode())
        close()
        yield pd.DataFrame({"n": [0]})

    rows = analog(spark, sf_dir, "members").select("zip_file", "object_id")
    rows.repartition("zip_file").sortWithinPartitions("zip_file", "object_id").mapInPandas(write, "n long").count()
    return "file://" + local


@query(
    "s06_archive_members",
    ctes("members") + " SELECT object_id, zip_file, 'part/' || object_id || '_public.xml' AS member, CAST(length(object_id) + 15 AS BIGINT) AS bytes FROM members"
)
def s06(spark, sf_dir):
    return archives.members(spark, _zips(spark, sf_dir))


@query(
    "s07_p02_wanted_members",
    ctes("members") + " SELECT object_id, '<Return id=''' || object_id || '''/>' AS xml FROM members WHERE object_id NOT LIKE 'X%'"
)
def s07(spark, sf_dir):
    wanted = analog(spark, sf_dir, "filing_index").select("object_id")
    return archives.documents(spark, _zips(spark, sf_dir), wanted).select("object_id", "xml")


@query("s07_zip_data_source", ctes("members") + " SELECT object_id, '<Return id=''' || object_id || '''/>' AS xml FROM members")
def s07b(spark, sf_dir):
    spark.dataSource.register(archives.ZipFilings)
    folder = Path(_zips(spark, sf_dir).removeprefix("file://"))
    paths = ",".join(sorted(str(p) for p in folder.glob("*.zip")))
    return spark.read.format("zip_filings").option("paths", paths).load().select("object_id", "xml")


@query(
    "s05_index_of_two_headers",
    ctes("filing_index") + " SELECT object_id, ein, sub_date, CASE WHEN filing_year >= 1996 THEN 'b' || object_id END AS xml_batch_id FROM filing_index"
)
def s05b(spark, sf_dir):
    folder, rows = scratch(spark), analog(spark, sf_dir, "filing_index")
    cols = {"RETURN_ID": F.concat(F.lit("r"), "object_id"), "EIN": F.col("ein"), "TAX_PERIOD": F.col("tax_period"), "SUB_DATE": F.col("sub_date")}
    cols |= {"TAXPAYER_NAME": F.concat("ein", F.lit("\nand, co")), "RETURN_TYPE": F.col("return_type"), "OBJECT_ID": F.col("object_id")}
    later = ("OBJECT_ID", "RETURN_TYPE", "EIN", "TAX_PERIOD", "SUB_DATE", "TAXPAYER_NAME")
    old = rows.filter("filing_year < 1996").select(*[v.alias(k) for k, v in cols.items()])
    new = rows.filter("filing_year >= 1996").select(*[cols[k].alias(k) for k in later], F.concat(F.lit("b"), "object_id").alias("XML_BATCH_ID"))
    old.write.csv(f"{folder}/old", header=True, quote='"', escape='"')
    new.write.csv(f"{folder}/new", header=True, quote='"', escape='"')
    index = tables.index(spark, [f"{folder}/old", f"{folder}/new"])
    return index.filter(F.col("taxpayer_name").endswith("\nand, co")).select("object_id", "ein", "sub_date", "xml_batch_id")


@query(
    "s13_registry_csv",
    "SELECT lpad(CAST(s_suppkey + 1 AS VARCHAR), 9, '0') AS ein, s_name AS name, trim(replace(upper(s_name), '#', ' ')) AS name_normalized, '94022' AS zip5 FROM supplier"
)
def s13(spark, sf_dir):
    path = scratch(spark)
    s = table(spark, sf_dir, "supplier").select(
        F.lpad((F.col("s_suppkey") + 1).cast("string"), 9, "0").alias("EIN"), F.col("s_name").alias("NAME"),
        F.lit(" ").alias("SORT_NAME"), F.lit("Palo, Alto").alias("CITY"), F.lit("CA").alias("STATE"),
        F.lit("94022-1").alias("ZIP"), F.lit("B20").alias("NTEE_CD"), F.lit("03").alias("SUBSECTION"),
        F.lit("01").alias("STATUS"), F.lit("").alias("RULING")
    )
    s.unionByName(s.limit(3)).unionByName(s.limit(1).withColumn("EIN", F.lit("x"))).write.csv(path, header=True, quote='"', escape='"')
    good, _ = tables.registry(spark, path, "2026-08")
    return good.select("ein", "name", "name_normalized", "zip5")


@query(
    "s14_s18_registry_view",
    ctes("registry") + " SELECT ein, name, city, state, ntee_code AS ntee_cd, subsection_code AS subsection FROM registry"
)
def s14(spark, sf_dir):
    path = scratch(spark)
    names = {"EIN": "ein", "NAME": "name", "CITY": "city", "STATE": "state", "NTEE_CD": "ntee_code", "SUBSECTION": "subsection_code"}
    analog(spark, sf_dir, "registry").select(*[F.col(c).alias(k) for k, c in names.items()], F.lit("x").alias("OTHER")).write.csv(path, header=True)
    return tables.registry_view(spark, path).unionByName(tables.registry_view(spark, f"{path}/none.csv"))  # the second isn't there: no rows, the same columns


@query("s01_landing_links", """WITH p AS (SELECT s_suppkey AS k, 2015 + s_suppkey % 9 AS y FROM supplier)
SELECT 'http://x/a/' || y || '_S' || k || '.zip' AS url, y || '_S' || k || '.zip' AS filename, CAST(y AS INTEGER) AS year, false AS is_index FROM p
UNION ALL SELECT 'http://y/' || y || '_I' || k || '.CSV', y || '_I' || k || '.CSV', CAST(y AS INTEGER), true FROM p WHERE k % 2 = 0""")
def s01(spark, sf_dir):
    k, y = F.col("s_suppkey").cast("string"), (F.lit(2015) + F.col("s_suppkey") % 9).cast("string")
    zipped = F.concat(F.lit('<a href="/a/'), y, F.lit("_S"), k, F.lit('.zip#x">z</a> '))
    listed = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit('<A HREF="http://y/'), y, F.lit("_I"), k, F.lit('.CSV">'))).otherwise(F.lit('<a href="none.zip"><a href="2020_x.pdf">'))
    return tables.landing_files(spark, table(spark, sf_dir, "supplier").select(F.concat(zipped, listed, zipped).alias("html")), "http://x/")


@query("s24_single_filings", "SELECT CAST(n_nationkey AS VARCHAR) AS object_id, CASE WHEN n_nationkey % 2 = 0 THEN '990' ELSE '990PF' END AS return_type FROM nation")
def s24(spark, sf_dir):
    folder = scratch(spark)
    for (k,) in table(spark, sf_dir, "nation").select("n_nationkey").collect():  # the fixture: a file for each nation
        name = (f"2022v5.0__{k}.xml", f"{k}_public.xml", f"{k}.xml")[k % 3]
        put(spark, f"{folder}/{name}", f"<Return><ReturnHeader><ReturnTypeCd>{'990PF' if k % 2 else '990'}</ReturnTypeCd></ReturnHeader></Return>")
    return fil.headers(fil.parsed(fil.from_files(spark, folder))).select("object_id", "return_type")


@query("s19_j12_overrides", """SELECT s_name AS name, CASE WHEN s_suppkey % 3 <> 0 THEN 'CA' END AS state, CASE WHEN s_suppkey % 4 <> 0 THEN '94000' END AS zip5,
  lpad(CAST(s_suppkey + 1 AS VARCHAR), 9, '0') AS ein FROM supplier""")
def s19(spark, sf_dir):
    path, k = scratch(spark), F.col("s_suppkey")
    ein = F.lpad((k + 1).cast("string"), 9, "0")
    table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("recipient_name_normalized"), F.when(k % 3 == 0, " ").otherwise("CA").alias("state"),
        F.when(k % 4 == 0, "").otherwise("94000").alias("zip5"), F.concat(F.substring(ein, 1, 2), F.lit("-"), F.substring(ein, 3, 7)).alias("ein"),
        F.lit("seen").alias("source"), F.lit("a, b").alias("note"),
    ).write.csv(path, header=True)
    return tables.corrections(spark, path).select(F.col("recipient_name_normalized").alias("name"), "state", "zip5", "ein")


@query("s20_labelled_pairs", "SELECT s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN lpad(CAST(s_suppkey + 1 AS VARCHAR), 9, '0') END AS expected_ein FROM supplier")
def s20(spark, sf_dir):
    path, k, none = scratch(spark), F.col("s_suppkey"), F.lit(None).cast("string")
    own = {"recipient_name_raw": F.col("s_name"), "expected_ein": F.when(k % 2 == 0, F.lpad((k + 1).cast("string"), 9, "0")).otherwise(" ")}
    own |= {"verified_by": F.lit("me"), "verified_on": F.lit("2026-08-01"), "source": F.lit("site")}
    table(spark, sf_dir, "supplier").select(*[own.get(c, none).alias(c) for c in tables.LABEL_COLUMNS]).write.csv(path, header=True)
    return tables.labelled_pairs(spark, path).select(F.col("recipient_name_raw").alias("name"), "expected_ein")


@query("s11_inventories", "SELECT DISTINCT '202' || CAST(p_partkey % 3 AS VARCHAR) || 'v5.0' AS return_version, '/p' || CAST(p_partkey % 40 AS VARCHAR) AS path FROM part")
def s11(spark, sf_dir):
    folder = scratch(spark)
    for k in range(3):
        rows = table(spark, sf_dir, "part").filter(F.col("p_partkey") % 3 == k)
        rows.select(F.concat(F.lit("/p"), (F.col("p_partkey") % 40).cast("string")).alias("xpath"), F.lit("1").alias("other")).write.csv(f"{folder}/mapping_202{k}v5.0.csv", header=True)
    return tables.inventories(spark, f"{folder}/mapping_*.csv")


FIELDS = """SELECT p_partkey AS k, CASE WHEN p_partkey % 3 <> 0 THEN 'NEW_' || CAST(p_partkey % 7 AS {string}) END AS new, 'OLD_' || CAST(p_partkey % 5 AS {string}) AS old, '/a/b' || CAST(p_partkey AS {string}) AS xpath FROM {part}"""


@query("s10_field_entries", "WITH f AS (" + FIELDS.format(string="VARCHAR", part="part") + """), n AS (SELECT coalesce(new, old) AS variable, xpath, k FROM f),
o AS (SELECT old AS variable, xpath, k FROM f WHERE old NOT IN (SELECT variable FROM n)),
e AS (SELECT * FROM n UNION ALL SELECT * FROM o UNION ALL SELECT 'X_' || variable, xpath, k FROM n WHERE k % 9 = 0)
SELECT variable, xpath, CASE WHEN k % 2 = 0 THEN '2020v4.0|2021v4.0' ELSE '' END AS versions, k % 4 = 0 AS current FROM e""")
def s10(spark, sf_dir):
    folder, parts = scratch(spark), table(spark, sf_dir, "part")
    rows = spark.sql(FIELDS.format(string="STRING", part="{part}"), part=parts)
    rest = [
        F.when(F.col("k") % 2 == 0, "2020v4.0; 2021v4.0;").alias("versions"),
        F.when(F.col("k") % 4 == 0, "t").otherwise("F").alias("current_version")
    ]
    rows.select(F.col("new").alias("variable_name_new"), F.col("old").alias("variable_name"), "xpath", *rest).write.csv(f"{folder}/pf", header=True)
    rows.filter("k % 9 = 0").select(
        F.concat(F.lit("X_"), F.coalesce("new", "old")).alias("variable_name"), "xpath", *rest
    ).write.csv(f"{folder}/main", header=True)
    return tables.field_entries(spark, f"{folder}/pf", f"{folder}/main").select(
        "variable", "xpath", F.array_join("versions", "|").alias("versions"), "current"
    )


@query("k15_site_manifest", ctes("edges") + """, f AS (SELECT funder_ein, count(*) AS n FROM edges GROUP BY 1), s AS (SELECT string_agg(DISTINCT funder_state, ',' ORDER BY funder_state) AS states FROM edges)
SELECT count(*) AS funders, count(*) FILTER (WHERE n > 60) AS funders_chunked, CAST(sum(n) AS BIGINT) AS grant_rows, (SELECT count(DISTINCT recipient_ein_resolved) FROM edges) AS recipients, (SELECT states FROM s) AS states, '2026.08.1' AS dataset_version FROM f""")
def k15(spark, sf_dir):
    m = pub.site_manifest(edges(spark, sf_dir), "2026.08.1", "2026-08-01", 60)
    return m.select("funders", "funders_chunked", "grant_rows", "recipients", F.array_join("states", ",").alias("states"), "dataset_version")


@query("q07_f27_versions", "SELECT CAST(2001 + n_nationkey AS VARCHAR) || '.08.' || CAST(n_nationkey AS VARCHAR) AS version FROM nation WHERE n_nationkey % 3 = 0")
def q07(spark, sf_dir):
    keys = [r[0] for r in table(spark, sf_dir, "nation").select("n_nationkey").collect()]  # names of folders, as listed
    return pub.versions(spark, [(f"{2001 + k}.08.{k}", f"{2001 + k}.8.{k}", f"latest{k}")[k % 3] for k in keys])


@query(
    "t01_t03_streamed_postings",
    ctes("filing_index") + " SELECT object_id, ein, tax_period, return_type FROM (SELECT *, row_number() OVER (PARTITION BY ein, tax_period, return_type ORDER BY coalesce(sub_date, '') DESC, object_id DESC) AS k FROM filing_index) WHERE k = 1"
)
def t01(spark, sf_dir):
    root = scratch(spark)
    rows = analog(spark, sf_dir, "filing_index").select(*postings.INDEX.names, "filing_year")
    for k in range(2):
        rows.filter(F.col("filing_year") % 2 == k).drop("filing_year").coalesce(1).write.mode("append").parquet(f"{root}/in")
        postings.follow(spark, f"{root}/in", f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return postings.state(spark, f"{root}/state").select("object_id", "ein", "tax_period", "return_type")


CHANGED = ctes("filing_index") + """, p AS (SELECT object_id, filing_year FROM filing_index WHERE CAST(object_id AS BIGINT) % 3 <> 0), i AS (SELECT * FROM filing_index WHERE CAST(object_id AS BIGINT) % 10 <> 1),
w AS (SELECT *, row_number() OVER (PARTITION BY ein, tax_period, return_type ORDER BY coalesce(sub_date, '') DESC, object_id DESC) AS k FROM i),
c AS (SELECT coalesce(p.object_id, w.object_id) AS object_id, coalesce(w.filing_year, p.filing_year) AS filing_year,
  CASE WHEN p.object_id IS NOT NULL AND w.k = 1 THEN 'kept' WHEN p.object_id IS NOT NULL AND w.object_id IS NULL THEN 'removed' WHEN p.object_id IS NOT NULL THEN 'superseded' WHEN w.k = 1 THEN 'added' END AS change
  FROM p FULL JOIN w ON p.object_id = w.object_id)"""


#: The filings that have been processed.
PROCESSED = "CAST(object_id AS BIGINT) % 3 <> 0"


def _changes(spark, sf_dir):
    """Two thirds of the filings have been processed; a tenth is listed no more."""
    index, n = analog(spark, sf_dir, "filing_index"), F.col("object_id").cast("long")
    return rel.filing_changes(index.filter(PROCESSED).select("object_id", "filing_year"), index.filter(n % 10 != 1))


@query("q21_filing_changes", CHANGED + " SELECT object_id, filing_year, change FROM c WHERE change IS NOT NULL")
def q21(spark, sf_dir):
    return _changes(spark, sf_dir)


@query("q21_version_delta", CHANGED + """ SELECT filing_year, count(*) FILTER (WHERE change = 'added') AS added, count(*) FILTER (WHERE change = 'kept') AS kept, count(*) FILTER (WHERE change = 'superseded') AS superseded,
  count(*) FILTER (WHERE change = 'removed') AS removed, count(*) FILTER (WHERE change <> 'kept') > 0 AS touched FROM c WHERE change IS NOT NULL GROUP BY 1""")
def q21b(spark, sf_dir):
    return rel.version_delta(_changes(spark, sf_dir))


@query(
    "q21_incremental_build",
    CHANGED.replace("WITH ", ctes("edges") + ", ") + """ SELECT e.grant_id, e.filing_year FROM (SELECT grant_id, CAST(year(tax_period_end) AS INTEGER) AS filing_year, object_id FROM edges) e JOIN c USING (object_id) WHERE change IN ('added', 'kept')"""
)
def q21c(spark, sf_dir):
    """A version's edges after a month's postings: rows of filings that went are retired, added ones come, only touched years are rewritten."""
    changes = written(_changes(spark, sf_dir))
    every = edges(spark, sf_dir).withColumn("filing_year", F.year("tax_period_end"))
    root = scratch(spark)
    every.filter(PROCESSED).write.partitionBy("filing_year").parquet(root)  # the fixture: what the version before had
    new = written(changes.filter("change = 'added'").select("object_id"))  # by its size it is sent to the edges or not
    added = every.join(new, "object_id", "left_semi")
    old = spark.read.schema(every.schema).parquet(root)
    pub.rewrite_years(spark, rel.carried_over(old, added, changes), root, f"{root}-staged")
    return spark.read.schema(every.schema).parquet(root).select("grant_id", "filing_year")
