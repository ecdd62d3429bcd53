"""A training corpus from raw documents: quality rules, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
run() writes each stage's result to the shared folder and reads it again as the next one's input.

Extra columns are carried, whatever their names: a stage's own columns get names that docs doesn't use. Texts are
judged whole, however long. An empty table gives an empty one. Rows are named by two hashes of all their columns, so
rows that agree in every column are one row given several times, and all others are kept apart, also if ids repeat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.llm import decontaminate, mixing, near, repetition, sharding
from almoner.llm.common import write_table


def unused(docs: DataFrame, name: str) -> str:
    """A column name that docs doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def named_rows(docs: DataFrame) -> DataFrame:
    """doc (the whole row) and row, its name: 128 hash bits (nulls and their places count)."""
    shown = [x for c in docs.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    name = F.struct(F.xxhash64(*shown).alias("a"), F.xxhash64(F.lit("second"), *shown).alias("b"))
    return docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("doc"), name.alias("row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep. Null and empty texts go (they have too few words); repeated rows are judged alike."""
    out = unused(docs, "quality")
    return repetition.judged(docs, out=out).filter(F.col(out)["kept"]).select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id (null last; ties: by the row's hash).

    Documents without words are in no group and stay; of rows that agree in every column one stays."""
    rows = named_rows(docs)
    key = F.struct(F.col("doc.doc_id").isNull().alias("none"), F.col("doc.doc_id").alias("id"), "row")
    groups = near.near_components(rows.select(key.alias("doc_id"), "doc.text"))
    first = groups.filter((F.col("component_id") == F.col("doc_id")) | (F.col("n_shingles") == 0)).select("doc_id.row")
    return rows.join(first, "row", "left_semi").dropDuplicates(["row"]).select("doc.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; the others lose the spans that benchmark items share. Null texts stay; rows are judged one by one."""
    out = unused(docs, "benchmark")
    found = decontaminate.find_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out=out)
    clean = decontaminate.remove_spans(found.filter(F.size(F.col(out)["items"]) < decontaminate.CONTAMINATED), result=out)
    cut = F.size(F.col(out)["spans"]) > 0
    return clean.select(
        *[
            F.when(
                cut, F.length("text").cast(dict(docs.dtypes)[c])
            ).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns
        ]
    )


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Texts without words aren't taken; rows that agree in every column share their copies."""
    rows = named_rows(docs)
    mixed = mixing.mix(rows.select("row", "doc.doc_id", "doc.text", "doc.source"), carry="row")
    copies = mixed.groupBy(F.col("_row").alias("row")).agg(F.sum("copies").alias("copies")).filter("copies > 0")
    rows = rows.join(copies, "row").dropDuplicates(["row"])
    return rows.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc.*")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's shard and slot. Null texts have size 1; null ids come first; rows that agree are interchangeable."""
    return sharding.contract(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixture),
    ("sharding", shards),
]

#: Suffix arrays and the groups of linked documents aren't expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = write_table(docs, name)
    return docs
