"""Commands over one work folder: python -m almoner --root FOLDER COMMAND ...

index      index files -> <root>/index
filings    archives -> <root>/filings (headers and raw rows), reports/; exit 2 if too few filings resolve, 3 if totals are off
edges      <root>/filings -> <root>/edges, by filing year
registry   registry files of a vintage -> <root>/registry (newer vintages replace a number's row)
resolve    recipients of the edges -> <root>/answers, and into the edges
evaluate   labelled pairs -> reports/matching; exit 4 below the targets
sample     recipients to label, an equal share of each tier
publish    <root>/edges -> <root>/published/v=<version>, its manifest, and the pointer
info       the current version's manifest
parse      one filing, as JSON lines
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.operators import filings, publish, quality, relational, resolve
from almoner.sources import archives, tables
from almoner.sources.shared import exists, get, put, replace, scratch

#: What a row of a filing must have, and what is counted besides.
FIELDS = {
    "amount": lambda r: r["amount_usd"].isNotNull(), "name": lambda r: r["recipient_name_raw"] != "",
    "purpose": lambda r: r["grant_purpose"].isNotNull(), "zip": lambda r: r["recipient_zip"].isNotNull()
}


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="almoner", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--root", required=True)
    c = p.add_subparsers(dest="command", required=True)
    add = lambda name, *args: [
        x := c.add_parser(name),
        *[x.add_argument(*([a] if isinstance(a, str) else a[0]), **({} if isinstance(a, str) else a[1])) for a in args]
    ]
    add("index", (["files"], {"nargs": "+"}), (["--year"], {"type": int, "required": True}))
    add("filings", "archives", (["--years"], {"default": None}))
    add("edges", (["--version"], {"required": True}))
    add("registry", (["files"], {"nargs": "+"}), (["--vintage"], {"required": True}))
    add(
        "resolve", (["--again-unresolved"], {"action": "store_true"}), (["--aliases"], {"default": ""}),
        (["--corrections"], {"default": ""}), (["--chunks"], {"type": int, "default": 1})
    )
    add("evaluate", "labels")
    add("sample", (["--n"], {"type": int, "default": 1000}), (["--seed"], {"default": "0"}))
    add("publish", "version")
    add("info")
    add("parse", "file")
    return p


def renewed(df: DataFrame, path: str) -> DataFrame:
    """df as the table at path, in place of what was there (which df may read)."""
    spark = df.sparkSession
    if not exists(spark, path):
        df.write.parquet(path)
    else:
        df.write.parquet(f"{path}.next")
        replace(spark, f"{path}.next", path)
    return spark.read.parquet(path)


def answered(spark: SparkSession, root: str, labels: DataFrame) -> DataFrame:
    """Labelled pairs with the tier and number that the registry gives them now; without the labels' own corrections."""
    from almoner.functions.names import normalize_name

    pairs = labels.select("*", normalize_name(F.col("recipient_name_raw")).alias("name_normalized"), F.lit("organization").alias("recipient_type"))
    pairs = pairs.withColumnsRenamed(
        {
            "recipient_name_raw": "name_raw", "recipient_city": "city", "recipient_state": "state", "recipient_zip5": "zip5",
            "recipient_ein_reported": "ein_reported"
        }
    )
    answers = resolve.resolve(pairs.select(*resolve.TUPLE).distinct(), spark.read.parquet(f"{root}/registry"))
    a = answers.select(*[F.col(c).alias(f"_{c}") for c in resolve.TUPLE], "ein", "tier")
    same = F.lit(True)
    for c in resolve.TUPLE:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return pairs.join(a, same).select("tier", "ein", "expected_ein")


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    root = a.root.rstrip("/")
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    if a.command == "index":
        rows = tables.index(spark, a.files).withColumn("filing_year", F.lit(a.year))
        old = read("index").filter(F.col("filing_year") != a.year) if exists(spark, f"{root}/index") else rows.limit(0)
        print(
            renewed(old.unionByName(rows, allowMissingColumns=True), f"{root}/index").filter(F.col("filing_year") == a.year).count(),
            "filings listed"
        )
    elif a.command == "filings":
        wanted = relational.superseded(read("index")).filter("rank = 1").filter(F.col("return_type").isin("990", "990O", "990PF", "990PR"))
        if a.years:
            wanted = wanted.filter(F.col("filing_year").isin(*tables.years_of(a.years)))
        docs = archives.documents(spark, a.archives, wanted.select("object_id"))
        docs = docs.filter("error IS NULL").drop("error").join(wanted.select("object_id", "filing_year"), "object_id")
        done = renewed(filings.filed(filings.parsed(docs)), f"{root}/filings")
        sums, cov = quality.filing_sums(done), quality.coverage(done, FIELDS, F.col("amount") & F.col("name"))
        publish.report(cov, f"{root}/reports/version-coverage", [F.col("return_version"), F.col("return_type")])
        totals, counts = quality.pf_totals(sums), quality.table_counts(sums)
        publish.report(quality.summary(totals, counts), f"{root}/reports/totals", [F.col("pf_filings")])
        publish.error_lines(done.select("object_id", F.explode("errors").alias("error")), f"{root}/reports/errors")
        if not quality.coverage_passes(quality.headline(cov).first()[0]):
            return quality.EXIT_COVERAGE
        years = totals.join(done.select("object_id", "filing_year"), "object_id").groupBy("filing_year")
        good = years.agg(
            F.try_divide(
                100.0 * F.count_if(F.col("status") == "within_tolerance"),
                F.count_if(F.col("status").isin("within_tolerance", "over_tolerance"))
            ).alias("share")
        )
        return 0 if quality.totals_pass([r.share for r in good.collect()]) else quality.EXIT_TOTALS  # a row for each year
    elif a.command == "edges":
        counts = publish.write_edges(filings.edges_of(read("filings"), read("index"), a.version), f"{root}/edges")
        print(counts)
    elif a.command == "registry":
        new, bad = tables.registry(spark, a.files, a.vintage)
        old = read("registry") if exists(spark, f"{root}/registry") else new.limit(0)
        done = renewed(relational.upsert(old, new, ["ein"], [F.col("vintage").desc()]), f"{root}/registry")
        print(done.count(), "organizations,", bad.count(), "rows without a valid number")
    elif a.command == "resolve":
        edges = spark.read.option("basePath", f"{root}/edges/grants").parquet(f"{root}/edges/grants")
        aliases = tables.aliases(spark, a.aliases) if a.aliases else None
        fixes = tables.corrections(spark, a.corrections) if a.corrections else None
        vintage = read("registry").agg(F.max("vintage")).first()[0] if exists(spark, f"{root}/registry") else ""
        if not vintage:
            print("load a registry first", file=sys.stderr)
            return 1
        done = resolve.resolve_edges(
            edges, read("registry"), f"{root}/answers", vintage, datetime.now(), aliases=aliases, corrections=fixes,
            again_unresolved=a.again_unresolved, chunks=a.chunks
        )
        print(publish.rewrite_years(spark, done, f"{root}/edges/grants", scratch(spark)), "rows rewritten")
    elif a.command == "evaluate":
        pairs = answered(spark, root, tables.labelled_pairs(spark, a.labels))
        tiers, all_ = [r.asDict() for r in quality.evaluation(pairs).orderBy("tier").collect()], quality.overall(pairs).first()  # a row for each tier
        failures = quality.matching_failures({t["tier"]: t["precision"] for t in tiers}, pairs.count())
        put(spark, f"{root}/reports/matching-eval.md", quality.evaluation_report(tiers, all_.recall, all_.abstention, failures))
        return quality.EXIT_MATCHING if failures else 0
    elif a.command == "sample":
        rows = resolve.stored(spark, f"{root}/answers").filter("recipient_type = 'organization' AND name_raw IS NOT NULL")
        key = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in resolve.TUPLE])
        publish.report(
            relational.stratified(rows, "tier", key, a.n, a.seed).drop("resolved_at"), f"{root}/reports/to-label",
            [F.col("tier"), F.col("place")]
        )
    elif a.command == "publish":
        edges = spark.read.option("basePath", f"{root}/edges/grants").parquet(f"{root}/edges/grants").withColumn("dataset_version", F.lit(a.version))
        out = publish.stage(edges, f"{root}/published", a.version, files=None)
        local = out.removeprefix("file://")
        put(spark, f"{root}/published/{a.version}.json", json.dumps(publish.manifest(spark, local, a.version, quality.matching_status(0))))
        put(spark, f"{root}/published/_CURRENT", a.version)
    elif a.command == "info":
        print(get(spark, f"{root}/published/{get(spark, f'{root}/published/_CURRENT')}.json"))
    elif a.command == "parse":
        docs = filings.filed(filings.parsed(filings.from_files(spark, a.file)))
        for row in [*docs.drop("rows").toJSON().collect(), *filings.grant_rows(docs).toJSON().collect()]:  # one filing
            print(row)
    return 0


def main(argv: list[str] | None = None) -> int:
    a = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"almoner {a.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    return run(spark, a)


if __name__ == "__main__":
    sys.exit(main())
