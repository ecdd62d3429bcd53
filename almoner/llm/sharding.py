"""Contiguous shards of near equal bytes.

Documents are ordered by id (ties by text hash and size). Each range of the order is summed by itself, the ranges'
totals give every document's global byte offset, and equal targets cut that line: a document goes where its middle
byte falls. Only ids, sizes and hashes are dealt out, never texts.

Texts of any length count whole. A null text has no bytes (size 1, hash of the empty text). Null ids come first. Rows that agree in id, size and
hash are interchangeable. An empty table gives an empty one. More shards than documents leave some shards empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.llm.common import write_table
from almoner.llm.prefix import ranged, with_starts

SHARDS = 8


def byte_shards(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, start (global byte offset), shard and slot (place in the shard) of every row."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    thin = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    placed = with_starts(ranged(write_table(thin, "sizes"), order, "ranges"), order, "size", [])
    total = placed.agg(F.max(F.col("_start") + F.col("size"))).first()[0] or 1
    cut = F.least(F.lit(shards - 1).cast("long"), F.expr(f"((2 * _start + size) * {shards}L) div {2 * total}L")).cast("int")
    placed = placed.withColumn("shard", cut)
    firsts = placed.groupBy(F.col("shard").alias("_shard")).agg(F.min("_at").alias("_first"))
    placed = placed.join(F.broadcast(firsts), F.col("shard") == F.col("_shard"))  # a row for each shard
    return placed.select("doc_id", "size", "text_crc32", F.col("_start").alias("start"), "shard", (F.col("_at") - F.col("_first")).alias("slot"))


def contract(docs: DataFrame) -> DataFrame:
    s = byte_shards(docs)
    return s.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The CRC goes over each byte's two halves, with the table of the 16 halves.
ORACLE = r"""
WITH t AS (SELECT list_transform(range(0, 16), lambda x: list_reduce([x] || range(0, 4), lambda c, k: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END))) AS t),
d AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
  list_transform(string_split(hex(encode(coalesce(text, ''))), ''), lambda x: CAST(strpos('0123456789ABCDEF', x) - 1 AS BIGINT)) AS h FROM documents),
c AS (SELECT doc_id, size, CASE WHEN size = 1 THEN 0 ELSE xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(0, len(h)), lambda k: h[k + 2 - 2 * (k % 2)]), lambda c, x: xor(c >> 4, t[xor(c % 16, x) + 1])), 4294967295) END AS text_crc32 FROM d, t),
p AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS start, sum(size) OVER () AS total FROM c),
s AS (SELECT *, CAST(least(7, ((2 * start + size) * 8) // (2 * total)) AS INTEGER) AS shard FROM p)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY start) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""


def op5(spark, sf_dir: str) -> DataFrame:
    return contract(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
