"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir; where that is unset, a local one, and only if all tasks run on this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.gettempdir()
    return f"{root.rstrip('/')}/almoner-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: what is read twice is the same both times, also if executors are lost between."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a bucket.
BUCKET_ROWS = 500_000


def bucketed(df: DataFrame, column: str) -> DataFrame:
    """df as a table in the shared folder, dealt by a column: what is grouped, ranked or joined by it needs no further exchange."""
    spark, path, name = df.sparkSession, scratch(df.sparkSession), f"almoner_{uuid.uuid4().hex}"
    n = max(spark.sparkContext.defaultParallelism, -(-df.count() // BUCKET_ROWS))
    by_column = df.repartition(n, column).write.bucketBy(n, column).sortBy(column)
    by_column.format("parquet").option("compression", "zstd").option("path", path).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # only its name: the files have a place of their own


#: Bytes of an Arrow batch between the JVM and a Python worker; only a single longer row exceeds it.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches in bytes (Spark bounds their rows only), unless the cluster's settings do."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext.getConf().get(key) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def put(spark: SparkSession, path: str, text: str) -> str:
    """A small file of that name, by whatever file system the path is on."""
    system, p = _path(spark, path)
    stream = system.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return path


def get(spark: SparkSession, path: str) -> str:
    """What put() wrote."""
    system, p = _path(spark, path)
    stream = system.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _path(spark: SparkSession, path: str) -> tuple:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    system, p = _path(spark, path)
    return system.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    system, p = _path(spark, path)
    return sorted(x.getPath().getName() for x in system.listStatus(p) if x.isDirectory() and not x.getPath().getName().startswith(("_", ".")))


def replace(spark: SparkSession, new: str, old: str) -> None:
    """A folder takes another one's place; the old one, if there is one, is kept aside until the new one stands."""
    system, p = _path(spark, old)
    aside = _path(spark, f"{old.rpartition('/')[0]}/.{old.rpartition('/')[2]}.old")[1]  # a hidden name, which no reader takes for a part
    system.delete(aside, True)
    if system.exists(p) and not system.rename(p, aside) or not (system.mkdirs(p.getParent()) and system.rename(_path(spark, new)[1], p)):
        raise OSError(f"{new} could not take the place of {old}")
    system.delete(aside, True)
