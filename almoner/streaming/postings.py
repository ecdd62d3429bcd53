"""Monthly postings as a stream of files: each micro-batch supersedes earlier filings by their submission date.

A later filing must win over an earlier one, so rows are upserted in foreachBatch; dropping duplicates within a
watermark would keep the first. Every batch writes its result as a new version and moves a pointer to it, so a
batch that is run again after a failure does no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from almoner.operators.relational import latest_per_key

KEYS = ["ein", "tax_period", "return_type"]
INDEX = StructType([StructField(c, StringType()) for c in ("object_id", "ein", "tax_period", "return_type", "sub_date")])


def newest(filings: DataFrame) -> DataFrame:
    return latest_per_key(filings, KEYS, [F.coalesce("sub_date", F.lit("")).desc(), F.col("object_id").desc()])


def _versions(spark: SparkSession, root: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    done = [n for n in names if n.startswith("batch=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{n}/_SUCCESS"))]
    return sorted(int(n.partition("=")[2]) for n in done)


def state(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The newest filings as of the last finished batch (before the given one)."""
    known = [v for v in _versions(spark, root) if before is None or v < before]
    return spark.read.schema(INDEX).parquet(f"{root}/batch={known[-1]}") if known else spark.createDataFrame([], INDEX)


def follow(spark: SparkSession, source: str, root: str, checkpoint: str) -> StreamingQuery:
    """Take in every posting that has arrived, then stop."""

    def take(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        newest(state(own, root, number).unionByName(batch)).write.mode("overwrite").parquet(f"{root}/batch={number}")

    rows = spark.readStream.schema(INDEX).parquet(source)
    return rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
