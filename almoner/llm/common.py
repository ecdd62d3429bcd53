"""What the text operators share: tables in the shared folder, Arrow tokenisation, hashing."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of text that a Python worker takes apart at once; only a single longer text exceeds it.
CHUNK_BYTES = 1 << 20
#: Bytes of an Arrow batch between the JVM and a Python worker; only a single longer row exceeds it.
BATCH_BYTES = 4 << 20

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; where the session names none, a local one, and only if all tasks run on this machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.gettempdir() + "/almoner-shared"
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches in bytes (Spark bounds their rows only), unless the cluster's settings do."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext.getConf().get(key) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: lost executors cost one stage, not the lineage.

    The write's own shuffle files go with its end, as nothing but the table is read afterwards."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Remove what write_table wrote, once nothing reads it any more."""
    for f in df.inputFiles():
        for k, (spark, path) in enumerate(_written):
            if path.rpartition("/")[2] in f:
                _remove(spark, path)
                del _written[k]
                return


def tables_written() -> int:
    """How many tables write_table has written so far, as a mark for drop_since()."""
    return len(_written)


def drop_since(mark: int, keep: DataFrame) -> None:
    """Remove the tables written since a mark, but for the one that is still read."""
    kept = {f.rpartition("/")[0].rpartition("/")[2] for f in keep.inputFiles()}
    for spark, path in _written[mark:]:
        if path.rpartition("/")[2] not in kept:
            _remove(spark, path)
    _written[mark:] = [x for x in _written[mark:] if x[1].rpartition("/")[2] in kept]


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of results that have been written and that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _remove_all() -> None:
    for spark, path in _written:
        try:
            _remove(spark, path)
        except Exception:  # the JVM has gone already
            return


atexit.register(_remove_all)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """Runs of whole texts of about `limit` bytes each; nulls become empty texts. Arrow's free memory goes back at the end."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield texts.slice(at, stop - at)
        at = stop
    pa.default_memory_pool().release_unused()


class Words:
    """The words of some texts: ids into a vocabulary, and where each text's words begin."""

    def __init__(self, texts: pa.Array):
        parts = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
        lens = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        ids, vocab = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        empty = pc.index(vocab, "").as_py()
        if empty >= 0:
            doc = np.repeat(np.arange(len(lens)), lens)[ids != empty]
            ids = ids[ids != empty]
            ids -= ids > empty
            lens = np.bincount(doc, minlength=len(lens)).astype(np.int64)
            vocab = pa.concat_arrays([vocab.slice(0, empty), vocab.slice(empty + 1)])
        self.ids, self.lens, self.vocab, self.n = ids, lens, vocab, len(lens)
        self.starts = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
        self.doc = np.repeat(np.arange(self.n), lens)

    def hashes(self) -> np.ndarray:
        """64 hash bits of each word of the vocabulary: the sum of its bytes, each mixed with its place, mixed with its length."""
        if not len(self.vocab):
            return np.zeros(0, np.uint64)
        _, offsets, data = self.vocab.buffers()
        at = np.frombuffer(offsets, np.int32)[self.vocab.offset : self.vocab.offset + len(self.vocab) + 1].astype(np.int64)
        body, at = np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]
        lens = np.diff(at)
        place = (np.arange(len(body)) - np.repeat(at[:-1], lens)).astype(np.uint64)
        each = mix(body + (place + np.uint64(1)) * np.uint64(ODD))
        return mix(np.add.reduceat(each, at[:-1]) + lens.astype(np.uint64))  # words aren't empty


def translate_bytes(texts: pa.Array, table: bytes) -> pa.Array:
    """Each byte replaced by table[byte]; table must keep UTF-8 valid."""
    if not len(texts):
        return texts
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    body = (data.slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if data else b"").translate(table)
    return pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(body)])


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: near inputs give far outputs."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


#: An odd factor for each place in a window.
ODD = 0x9E3779B97F4A7C15


def window_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n consecutive words (over the joined texts; callers mask runs that cross a text's end)."""
    m = len(word_hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = mix(out + word_hashes[k : k + m]) * np.uint64(ODD)
    return mix(out)


def add_result(df: DataFrame, name: str, result: Column) -> DataFrame:
    """df with `result` as its last column; a column of that name is replaced."""
    return df.select(*[c for c in df.columns if c.lower() != name.lower()], result.alias(name))

