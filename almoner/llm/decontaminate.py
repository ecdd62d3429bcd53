"""Benchmark decontamination: training windows looked up in a broadcast hash set of benchmark n-grams.

Words are runs of [0-9a-z] and non-ASCII characters after A-Z are lower-cased. Every item's windows of `n` words
(an item with fewer is one window of its own length) become rows of word numbers and a sorted array of their
hashes. Each document window whose words all belong to the benchmark's vocabulary is looked up by hash and
verified word by word; hits mark words and items.

The set is broadcast in blocks of at most `block_words` item words, each a scan of its own over the documents; a
benchmark of any size passes, and no worker holds more than one block. Items are gathered on the driver block by
block. Texts of any length are searched whole. Null texts have no words. Null item ids are items too, named by the empty text. Rows with one item id are
one item. Without items nothing is hit. A column named as the result is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.llm.common import Words, add_result, mix, slices, small_batches, translate_bytes

#: Bytes that aren't in a word become spaces, A-Z become a-z.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
FIELDS = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"


def keys(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n word numbers."""
    h = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    for k in range(n):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + len(h)].astype(np.uint64) + np.uint64(1))
    return h


class Grams:
    """The n-grams of a block of benchmark items."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        names = sorted({name for name, _ in items})
        at = {name: k for k, name in enumerate(names)}
        w = Words(translate_bytes(pa.array([text or "" for _, text in items], pa.string()), TABLE))
        self.names, self.vocab = names, w.vocab
        found: dict[int, list] = {}
        for k, (name, _) in enumerate(items):
            ids = w.ids[w.starts[k] : w.starts[k + 1]]
            if size := min(n, len(ids)):
                rows = np.lib.stride_tricks.sliding_window_view(ids, size)
                found.setdefault(size, []).append((keys(ids, size), rows, np.full(len(rows), at[name])))
        #: By window length: sorted hashes, the windows' words, and their items.
        self.by_size = {}
        for size, parts in found.items():
            h, rows, item = (np.concatenate(x) for x in zip(*parts, strict=True))
            by = np.argsort(h, kind="stable")
            self.by_size[size] = h[by], rows[by], item[by]

    def scan(self, w: Words) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Which words are hit, and (document, item) of the hits."""
        known = pc.fill_null(pc.index_in(w.vocab, value_set=self.vocab), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = known[w.ids] if len(w.ids) else w.ids
        edge, pairs = np.zeros(len(ids) + 1, np.int64), []
        foreign = np.r_[0, np.cumsum(ids < 0)]
        for size, (h, rows, item) in self.by_size.items():
            at = np.flatnonzero(foreign[size:] == foreign[:-size]) if len(ids) >= size else np.zeros(0, np.int64)
            at = at[w.doc[at] == w.doc[at + size - 1]]
            if not len(at):
                continue
            own = np.zeros(len(at), np.uint64)
            for k in range(size):
                own = mix(own * np.uint64(0x9E3779B97F4A7C15) + ids[at + k].astype(np.uint64) + np.uint64(1))
            lo, hi = np.searchsorted(h, own, "left"), np.searchsorted(h, own, "right")
            at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
            while len(at):  # each round verifies one more entry of an equal hash
                same = np.all(ids[at[:, None] + np.arange(size)] == rows[lo], axis=1)
                edge += np.bincount(at[same], minlength=len(edge)) - np.bincount(at[same] + size, minlength=len(edge))
                pairs.append((w.doc[at[same]], item[lo[same]]))
                lo = lo + 1
                at, lo, hi = at[lo < hi], lo[lo < hi], hi[lo < hi]
        return np.cumsum(edge)[:-1] > 0, pairs


def merged(found: pa.Array | None, texts: pa.Array, grams: Grams) -> pa.StructArray:
    """FIELDS of each text; found: what earlier blocks of items have hit."""
    w = Words(translate_bytes(texts, TABLE))
    hit, pairs = grams.scan(w)
    items: list[list[str]] = [[] for _ in range(w.n)]
    if found is not None:
        for k, old in enumerate(found.to_pylist()):
            items[k] = old["items"]
            for span in old["spans"]:
                hit[w.starts[k] + span["start"] : w.starts[k] + span["end"]] = True
    if pairs:
        own = np.unique(np.concatenate([d for d, _ in pairs]) * len(grams.names) + np.concatenate([i for _, i in pairs]))
        for x in own.tolist():
            items[x // len(grams.names)] = [*items[x // len(grams.names)], grams.names[x % len(grams.names)]]
    same = w.doc[1:] == w.doc[:-1]
    on = np.flatnonzero(hit & ~(np.r_[False, hit[:-1] & same])) if len(hit) else np.zeros(0, np.int64)
    off = np.flatnonzero(hit & ~(np.r_[hit[1:] & same, False])) if len(hit) else on
    d = w.doc[on] if len(on) else on
    spans = pa.ListArray.from_arrays(
        pa.array(np.r_[0, np.cumsum(np.bincount(d, minlength=w.n))].astype(np.int32)),
        pa.StructArray.from_arrays(
            [pa.array((on - w.starts[d]).astype(np.int32)), pa.array((off + 1 - w.starts[d]).astype(np.int32))], ["start", "end"]
        ),
    )
    return pa.StructArray.from_arrays(
        [pa.array(w.lens), spans, pa.array([sorted(set(x)) for x in items], pa.list_(pa.string()))], ["n_words", "spans", "items"]
    )


def blocks(items: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list[tuple[str, str]]]:
    """The items as (name, text), in runs of about block_words words."""
    block, size = [], 0
    for name, body in items.select(
        F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    ).distinct().toLocalIterator():
        n = len(body.split())
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((name, body))
        size += n
    yield block


def scans(grams: Broadcast, later: bool) -> Callable:
    """The function of a scan of the documents for one block; later: it gets what earlier blocks have hit."""

    def first_scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.concat_arrays([merged(None, part, grams.value) for part in slices(texts)])

    def later_scan(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            at, parts = 0, []
            for part in slices(texts):
                parts.append(merged(found.slice(at, len(part)), part, grams.value))
                at += len(part)
            yield pa.concat_arrays(parts)

    return later_scan if later else first_scan


def find_benchmark(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = 8,
    block_words: int = 1_000_000, out: str = "benchmark"
) -> DataFrame:
    """docs with a struct `out`: n_words, spans of hit words, items (ids as text, sorted), n_hit."""
    small_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    for k, block in enumerate(blocks(items, item_id, item_text, block_words)):
        grams = sc.broadcast(Grams(block, n))  # at most block_words words, or one item
        body = F.col(f"`{text}`").cast("string")
        scan = F.arrow_udf(scans(grams, bool(k)), FIELDS).asNondeterministic()
        docs = add_result(docs, out, scan(body, F.col(f"`{out}`")) if k else scan(body))
    r = F.col(f"`{out}`")
    hit = F.aggregate(r["spans"], F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return add_result(docs, out, r.withField("n_hit", hit))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """text less the runs of hit words, with the separators inside a run; what surrounds a run stays."""
    body = text.encode()
    flat = body.translate(TABLE)
    edges, at = [], 0
    for word in flat.split():
        at = flat.index(word, at)
        edges.append((at, at + len(word)))
        at += len(word)
    keep, at = [], 0
    for start, end in spans:
        keep.append(body[at : edges[start][0]])
        at = edges[end - 1][1]
    return b"".join([*keep, body[at:]]).decode()


def remove_spans(docs: DataFrame, text: str = "text", result: str = "benchmark") -> DataFrame:
    """docs whose texts have lost the spans that find_benchmark() hit; null texts stay null."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array(
            [
                without_spans(t, [(s["start"], s["end"]) for s in x]) if t and x else t for t,
                x in zip(texts.to_pylist(), spans.to_pylist(), strict=True)
            ],
            pa.string()
        )

    return docs.withColumn(
        text,
        F.when(F.size(F.col(f"`{result}`.spans")) > 0, cut(F.col(f"`{text}`"), F.col(f"`{result}`.spans"))).otherwise(F.col(f"`{text}`"))
    )


#: As many items make a document contaminated.
CONTAMINATED = 2


def op6(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    r = find_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    b = F.col("benchmark")
    n_items = F.size(b["items"]).cast("long")
    return r.select(
        "doc_id", b["n_words"].alias("n_words"), b["n_hit"].alias("n_hit"), n_items.alias("n_items"),
        F.sha2(F.array_join(b["items"], ","), 256).alias("items_sha256"), (n_items >= CONTAMINATED).alias("contaminated")
    )


ORACLE = r"""
WITH words AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', CAST(item_id AS VARCHAR), regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
b AS (SELECT DISTINCT id AS item, n, array_to_string(w[i:i + n - 1], ' ') AS g
      FROM (SELECT id, w, least(8, len(w)) AS n, unnest(range(1, len(w) - least(8, len(w)) + 2)) AS i FROM words WHERE kind = 'b' AND len(w) > 0)),
d AS (SELECT id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
      FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (SELECT DISTINCT n FROM b) WHERE kind = 'd' AND len(w) >= n)),
h AS (SELECT d.id, d.i, d.n, b.item FROM d JOIN b USING (n, g)),
p AS (SELECT id, count(DISTINCT place) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS place FROM h) GROUP BY id),
t AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM h) GROUP BY id)
SELECT CAST(words.id AS BIGINT) AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM words LEFT JOIN p USING (id) LEFT JOIN t USING (id) WHERE kind = 'd'
"""
