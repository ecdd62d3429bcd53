"""N-gram Jaccard join: a size-aware heavy-light join, and the groups of linked documents.

A document's set holds the 64-bit hashes of its distinct shingles of `n` words (A-Z lower-cased; a shorter text is
one shingle). Two sets of sizes s <= t have a Jaccard similarity of at least j/100 only if they share
c(s, t) = ceil(j (s + t) / (100 + j)) members.

1. Equal sets fall together: a class is named by a hash of its set, and only classes are joined.
2. Light sets (at most `boundary` members) enumerate their subsets of the sizes c(s, t), which are their keys.
   Heavy sets (and light ones a heavy one may match) use the first s - c + 1 members of a global order as keys, c
   the least overlap with any partner, and scan the keys' inverted lists. The order puts members with long lists
   last; which those are is measured over all documents and handed out as a bitmap of fixed size (a wrong bit
   costs time, never a link). The boundary is the size up to which a set's subsets are no more than the list
   entries it would scan, from the measured mean list length.
3. Pairs that share a key are candidates, but a list is never expanded into all its pairs: each round compares its
   members with one pivot, in an order that changes from round to round, and members of components that are
   already one are left out. After `rounds` rounds what is still between components, if anything, is compared list
   by list, long lists in blocks, so no link between components is lost.
4. A candidate first has its sets' signatures compared (a bitmap of 4 to 8 bits for each member): a bit that the other
   lacks stands for a member that it lacks, which bounds the intersection from above. What passes is verified on the
   whole sets, which are gathered only for those classes. Links are joined into components.

Texts of any length are taken whole. Nulls and texts without words: empty set, linked with nothing. Rows with one doc_id are one document that has
several sets. A null doc_id is never a component's name (null where a component has no other). Extra columns are
ignored. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.llm.common import Words, drop_since, drop_table, mix, release, slices, small_batches, tables_written, window_hashes, write_table
from almoner.llm.components import components

SHINGLE, PERCENT, ROUNDS, MAX_LIGHT, LONG_LIST, BITMAP_BITS = 5, 80, 3, 10, 8, 1 << 26
#: As many ids of wanted documents are broadcast (8 bytes each); beyond, a bitmap of fixed size picks them.
BROADCAST_IDS = 1_000_000
#: Lists of more members than LIST are compared by blocks of about BLOCK.
LIST, BLOCK = 64, 2048


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = Words(pc.ascii_lower(texts))
    if not len(w.ids):
        return [np.zeros(0, np.uint64)] * w.n
    words = w.hashes()[w.ids]
    grams = window_hashes(words, n)
    out = []
    for a, b in zip(w.starts[:-1].tolist(), w.starts[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        else:
            out.append(window_hashes(words[a:b], b - a) + np.uint64(b - a) if b > a else np.zeros(0, np.uint64))
    return out


def overlap(s: int, t: int, percent: int) -> int:
    """The least intersection of linked sets of s and t members: percent (s + t - i) <= 100 i."""
    return -(-percent * (s + t) // (100 + percent))


def partners(s: int, percent: int) -> range:
    """Sizes that a set of s members may link with."""
    return range(-(-percent * s // 100), 100 * s // percent + 1)


def light_sizes(s: int, boundary: int, percent: int) -> list[int]:
    """Subset sizes that a light set of s members enumerates."""
    return sorted({overlap(s, t, percent) for t in partners(s, percent) if t <= boundary and overlap(s, t, percent) <= min(s, t)})


def prefix_length(s: int, percent: int) -> int:
    return s - overlap(s, partners(s, percent)[0], percent) + 1  # the smallest partner asks for the least


def boundary_by_cost(mean_list: float, percent: int, most: int = MAX_LIGHT) -> int:
    """The largest size up to which enumerating subsets is no dearer than scanning the keys' lists."""
    x = 0
    while x < most and sum(math.comb(x + 1, c) for c in light_sizes(x + 1, x + 1, percent)) <= prefix_length(x + 1, percent) * (1 + mean_list):
        x += 1
    return x


def _bits(h: np.ndarray) -> np.ndarray:
    return mix(h ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(BITMAP_BITS - 1)


def in_bitmap(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _bits(h)
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def bitmap_of(values: DataFrame) -> np.ndarray:
    """A bitmap of BITMAP_BITS bits (8 MB, whatever the number of values) that has every value of the long column v."""

    @F.arrow_udf("long")
    def place(v: pa.Array) -> pa.Array:
        return pa.array(_bits(v.to_numpy(zero_copy_only=False).view(np.uint64)).astype(np.int64))

    spots = values.select(place("v").alias("p"))
    word = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))
    words = spots.groupBy(F.call_function("shiftright", F.col("p"), F.lit(6)).alias("at")).agg(F.bit_or(word).alias("w")).toPandas()
    out = np.zeros(BITMAP_BITS // 64, np.uint64)
    out[words["at"].to_numpy(np.int64)] = words["w"].to_numpy(np.int64).view(np.uint64)
    return out


def set_keys(s: np.ndarray, long_lists: np.ndarray, boundary: int, percent: int) -> np.ndarray:
    """The keys of a set: tagged subsets, first members of the global order, or both near the boundary."""
    n, keys = len(s), []
    if not n:
        return s
    if n <= boundary:
        for c in light_sizes(n, boundary, percent):
            subsets = np.array(list(combinations(s.tolist(), c)), np.uint64)
            h = np.full(len(subsets), c, np.uint64)
            for k in range(c):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + subsets[:, k])
            keys.append(h)
    if partners(n, percent)[-1] > boundary:
        s = mix(s)  # from here on an order that is independent of the sorted one
        last = in_bitmap(long_lists, s)
        take = prefix_length(n, percent)
        s = s[np.lexsort((s, last))] if last.any() else np.sort(s)
        keys.append(s[:take])
    return np.concatenate(keys)


def signature(s: np.ndarray) -> bytes:
    """Which of a power of two of hash values (4 to 8 for each member) the members have, as bits."""
    flags = np.zeros(1 << max(6, (4 * len(s)).bit_length()), bool)
    flags[(mix(s) & np.uint64(len(flags) - 1)).astype(np.int64)] = True
    return np.packbits(flags).tobytes()


def folded(x: np.ndarray, size: int) -> np.ndarray:
    """Signatures (in rows, as 64-bit words) of fewer values: halves laid over each other."""
    while x.shape[-1] > size:
        x = x[..., : x.shape[-1] // 2] | x[..., x.shape[-1] // 2 :]
    return x


def most_shared(x: np.ndarray, y: np.ndarray, s: int, t: np.ndarray) -> np.ndarray:
    """An upper bound of the intersections of a set of s members with sets of t: a bit that the other lacks is a member that it lacks."""
    alone, theirs = np.bitwise_count(x & ~y).sum(-1, dtype=np.int64), np.bitwise_count(y & ~x).sum(-1, dtype=np.int64)
    return np.minimum(s - alone, t - theirs)


def may_link(a: bytes, b: bytes, s: int, t: int, percent: int) -> bool:
    """Whether sets of s and t members with these signatures can share enough."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    size = min(len(x), len(y))
    return int(most_shared(folded(x, size), folded(y, size), s, t)) >= overlap(s, t, percent)


def block_pairs(key: int, rows: dict[str, list], twice: bool, first: list[bool], percent: int) -> list[tuple[int, int]]:
    """Pairs of a long list's members (first: those of the one block, others of the second; twice: both are one block) that
    are of different components, not both of the class below, share no earlier long list, and may link by size and signature."""
    n, fp, c = (np.array(rows[k], np.int64) for k in ("n", "fp", "c"))
    order = np.lexsort((fp, n))
    n, fp, c, first, own_class = n[order], fp[order], c[order], np.array(first)[order], np.array(rows["own"])[order]
    earlier = [[k for k in rows["keys"][i] if k < key] for i in order]
    names = {k: i for i, k in enumerate(sorted({k for ks in earlier for k in ks}))}
    has = np.zeros((len(n), len(names)), bool)
    for i, ks in enumerate(earlier):
        has[i, [names[k] for k in ks]] = True
    words = [np.frombuffer(rows["signature"][i], np.uint64) for i in order]
    sizes = np.array([len(x) for x in words])
    out = []
    for size in np.unique(sizes):
        near = np.flatnonzero((sizes == size) | (sizes == 2 * size))
        table = np.stack([folded(words[i], size) for i in near])
        for at in np.flatnonzero(sizes[near] == size):
            x = near[at]
            # the larger set of a pair comes later in the order, and its signature is as long or twice as long
            stop = np.searchsorted(n[near], 100 * n[x] // percent, side="right")
            ys = near[at + 1 : stop]
            ok = (c[ys] != c[x]) & (own_class[ys] | own_class[x])
            if not twice:
                ok &= first[ys] != first[x]
            ok &= ~(has[ys] & has[x]).any(1)
            ys, own = ys[ok], table[at + 1 : stop][ok]
            if len(ys):
                least = -(-percent * (n[x] + n[ys]) // (100 + percent))
                good = ys[most_shared(table[at], own, n[x], n[ys]) >= least]
                out += zip(np.minimum(fp[good], fp[x]).tolist(), np.maximum(fp[good], fp[x]).tolist(), strict=True)
    return out


class Join:
    """The stages of the join over documents with columns doc_id and text."""

    def __init__(self, docs: DataFrame, n: int, percent: int, rounds: int):
        self.docs, self.n, self.percent, self.rounds = docs, n, percent, rounds
        self.spark = docs.sparkSession
        small_batches(self.spark)

    def long_lists(self) -> tuple[np.ndarray, float]:
        """The members whose inverted lists are long, as a bitmap; the mean list length that a key sees."""
        n, percent, none = self.n, self.percent, np.zeros(BITMAP_BITS // 64, np.uint64)

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches:
                for part in slices(batch.column(0)):
                    keys = []
                    for s in shingle_sets(part, n):
                        if len(s) and (f := xxhash.xxh3_64_intdigest(s)) not in seen:
                            seen.add(f)
                            keys.append(set_keys(s, none, 0, percent))
                    if keys:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64))], ["v"])

        lists = self.docs.select("text").mapInArrow(emit, "v long").groupBy("v").agg(F.count(F.lit(1)).alias("k"))
        lists = lists.filter("k > 1")
        long = write_table(lists.filter(F.col("k") > LONG_LIST), "long")
        shared = long.agg(F.sum("k"), F.sum(F.col("k") * F.col("k"))).first()
        mean = float(shared[1]) / float(shared[0]) if shared[0] else 1.0
        bitmap = bitmap_of(long.select("v"))
        drop_table(long)
        return bitmap, mean

    def keyed(self, long_lists: np.ndarray, boundary: int) -> DataFrame:
        """doc_id, n_shingles, fp (the class); keys and signature once for each class and task."""
        n, percent, held = self.n, self.percent, self.spark.sparkContext.broadcast(long_lists)

        @F.arrow_udf("n_shingles long, fp long, keys array<long>, signature binary")
        def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            seen: set[int] = set()
            for texts in batches:
                sizes, fps, keys, lens, counts = [], [], [], [0], []
                for part in slices(texts):
                    for s in shingle_sets(part, n):
                        f = xxhash.xxh3_64_intdigest(s) if len(s) else 0
                        sizes.append(len(s))
                        fps.append(f)
                        if len(s) and f not in seen:
                            seen.add(f)
                            keys.append(set_keys(s, held.value, boundary, percent))
                            lens.append(lens[-1] + len(keys[-1]))
                            counts.append(signature(s))
                        else:
                            lens.append(lens[-1])
                            counts.append(None)
                flat = pa.array((np.concatenate(keys) if keys else np.zeros(0, np.uint64)).view(np.int64))
                yield pa.StructArray.from_arrays(
                    [
                        pa.array(np.array(sizes, np.int64)), pa.array(np.array(fps, np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.array(lens, np.int32)), flat), pa.array(counts, pa.binary())
                    ],
                    ["n_shingles", "fp", "keys", "signature"],
                )

        signed = self.docs.select("doc_id", sign.asNondeterministic()(F.col("text")).alias("s")).select("doc_id", "s.*")
        return write_table(signed, "signed")

    def lists(self, keyed: DataFrame) -> DataFrame:
        """key, fp and n of the members of lists that have two classes or more, once each."""
        entries = keyed.filter(F.size("keys") > 0).select(F.explode("keys").alias("key"), "fp", F.col("n_shingles").alias("n"))
        shared = entries.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low <> high").select("key")
        shared = write_table(shared, "shared")
        lists = write_table(entries.join(shared, "key", "left_semi").distinct(), "lists")
        drop_table(shared)
        return lists

    def sets(self, keyed: DataFrame, wanted: DataFrame) -> DataFrame:
        """fp and set of the classes in `wanted`, from one document of each; its id's hash picks it before its text is taken apart."""
        n = self.n
        ids = keyed.filter("first").join(wanted, "fp", "left_semi")
        ids = write_table(ids.groupBy("fp").agg(F.min(F.xxhash64("doc_id")).alias("h")).select("h").distinct(), "ids")
        hashed = self.docs.select(F.xxhash64("doc_id").alias("h"), "text")
        if ids.count() <= BROADCAST_IDS:
            hashed, held = hashed.join(F.broadcast(ids), "h", "left_semi"), None
        else:
            held = self.spark.sparkContext.broadcast(bitmap_of(ids.select(F.col("h").alias("v"))))

        def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches:
                texts = batch.column(1)
                if held is not None:
                    texts = texts.filter(pa.array(in_bitmap(held.value, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))))
                for part in slices(texts):
                    rows = [
                        (f, s.tobytes()) for s in shingle_sets(part, n) if len(s) and (f := xxhash.xxh3_64_intdigest(s)) not in seen and not seen.add(f)
                    ]
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.array([f for f, _ in rows], np.uint64).view(np.int64)), pa.array([b for _, b in rows], pa.binary())],
                            ["fp", "set"]
                        )

        found = hashed.mapInArrow(take, "fp long, set binary")
        sets = write_table(found.join(wanted, "fp", "left_semi").dropDuplicates(["fp"]), "sets")
        drop_table(ids)
        return sets

    def possible(self, pairs: DataFrame, counts: DataFrame) -> DataFrame:
        """Those of the pairs (u, v) whose signatures allow a link."""
        percent = self.percent

        @F.arrow_udf("boolean")
        def may(a: pa.Array, b: pa.Array, s: pa.Array, t: pa.Array) -> pa.Array:
            return pa.array([may_link(*x, percent) for x in zip(a.to_pylist(), b.to_pylist(), s.to_pylist(), t.to_pylist(), strict=True)], pa.bool_())

        one = pairs.join(counts.select(F.col("fp").alias("u"), F.col("signature").alias("a"), F.col("n").alias("s")), "u")
        two = one.join(counts.select(F.col("fp").alias("v"), F.col("signature").alias("b"), F.col("n").alias("t")), "v")
        return two.filter(may(F.col("a"), F.col("b"), F.col("s"), F.col("t"))).select("u", "v")

    def linked(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Those of the pairs (u, v) whose sets are similar enough."""
        percent = self.percent

        @F.arrow_udf("boolean")
        def similar(a: pa.Array, b: pa.Array) -> pa.Array:
            out = []
            for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                out.append(100 * shared >= percent * (len(both) - shared))
            return pa.array(out, pa.bool_())

        one = pairs.join(sets.select(F.col("fp").alias("u"), F.col("set").alias("a")), "u")
        two = one.join(sets.select(F.col("fp").alias("v"), F.col("set").alias("b")), "v")
        return two.filter(similar(F.col("a"), F.col("b"))).select("u", "v")

    def run(self) -> DataFrame:
        """The keyed documents; self.roots names the components of their classes."""
        percent = self.percent
        long_lists, mean = self.long_lists()
        release(self.spark)
        signed = self.keyed(long_lists, boundary_by_cost(mean, percent))
        lists = self.lists(signed)
        counts = signed.filter("signature IS NOT NULL").select("fp", "signature", F.col("n_shingles").alias("n"))
        counts = write_table(counts.join(lists.select("fp").distinct(), "fp", "left_semi").dropDuplicates(["fp"]), "signatures")
        keyed = write_table(signed.select("doc_id", "n_shingles", "fp", F.col("signature").isNotNull().alias("first")), "keyed")
        drop_table(signed)
        release(self.spark)
        same_doc = keyed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        first = same_doc.groupBy("doc_id").agg(F.min("fp").alias("u"), F.max("fp").alias("_v")).filter("u <> _v")
        self.links = write_table(same_doc.join(first, "doc_id").select("u", F.col("fp").alias("v")).filter("u <> v").distinct(), "links")
        self.roots = write_table(components(self.links), "roots")
        self.held: DataFrame | None = None
        fits = lambda a, b: 100 * F.least(a, b) >= percent * F.greatest(a, b)
        open_lists = self._open(lists)
        for k in range(self.rounds):
            order = F.xxhash64("fp", F.lit(k)) if k else F.col("fp")
            pivots = write_table(open_lists.groupBy("key").agg(F.min_by(F.struct("fp", "n", "c"), F.struct(order, "fp")).alias("p")), "pivots")
            pairs = open_lists.join(pivots, "key").filter((F.col("p.c") != F.col("c")) & fits(F.col("p.n"), F.col("n")))
            if self._compare(keyed, counts, pairs.select(F.least("fp", "p.fp").alias("u"), F.greatest("fp", "p.fp").alias("v")).distinct()):
                drop_table(open_lists)
                open_lists = self._open(lists)
            drop_table(pivots)
            release(self.spark)
            if open_lists.isEmpty():
                return keyed
        self._compare(keyed, counts, self._rest(open_lists, counts))
        return keyed

    def _rest(self, open_lists: DataFrame, counts: DataFrame) -> DataFrame:
        """Every pair of list members that are still in different components and may link.

        Short lists are joined with themselves. Long lists are cut by size: as linked sets differ by less than one class
        of sizes, a member is compared with those of its own class and of the next. What is still long is cut into
        blocks of about BLOCK members, and pairs of blocks are compared in tasks of their own. A pair is looked at only
        in the first long list that it shares, and only what its signatures allow comes out."""
        percent = self.percent
        sizes = write_table(open_lists.groupBy("key").agg(F.count(F.lit(1)).alias("k")), "sizes")
        sized = write_table(open_lists.join(sizes, "key"), "open")
        short, long = sized.filter(F.col("k") <= LIST), sized.filter(F.col("k") > LIST)
        a = short.select("key", F.col("fp").alias("u"), F.col("n").alias("_n"), F.col("c").alias("_c"))
        b = short.select("key", F.col("fp").alias("v"), "n", "c")
        fits = 100 * F.least("_n", "n") >= percent * F.greatest("_n", "n")
        pairs = a.join(b, "key").filter((F.col("u") < F.col("v")) & (F.col("_c") != F.col("c")) & fits).select("u", "v").distinct()

        def compare(key: tuple, table: pa.Table) -> pa.Table:
            rows = {c: table.column(c).to_pylist() for c in ("fp", "n", "c", "keys", "signature", "block", "own")}
            k, _, i, j = (x.as_py() for x in key)
            found = block_pairs(k, rows, i == j, [x == i for x in rows["block"]], percent)
            return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})

        keys = long.groupBy("fp").agg(F.sort_array(F.collect_list("key")).alias("keys"))  # at most a set's keys
        rows = long.join(keys, "fp").join(counts.select("fp", "signature"), "fp").drop("k")
        # a little wider than the largest ratio, so that rounding never puts linked sets two classes apart
        size_class = F.floor(F.log(F.col("n")) / (1.001 * math.log(100 / percent))).cast("long") if percent < 100 else F.col("n")
        own = F.array(F.struct(size_class.alias("g"), F.lit(True).alias("own")), F.struct((size_class + 1).alias("g"), F.lit(False).alias("own")))
        rows = write_table(rows.select("*", F.inline(own)), "classes")
        sizes = rows.groupBy("key", "g").agg(F.count(F.lit(1)).alias("k"), F.bool_or("own").alias("any")).filter("any").drop("any")
        rows = rows.join(write_table(sizes, "sizes"), ["key", "g"]).withColumn("_blocks", F.ceil(F.col("k") / BLOCK).cast("long"))
        rows = rows.withColumn("block", F.pmod(F.xxhash64("fp", F.lit("block")), "_blocks")).withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
        )
        rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).select(
            "key", "g", "i", "j", "fp", "n", "c", "keys", "signature", "block", "own"
        )
        return pairs.unionByName(rows.groupBy("key", "g", "i", "j").applyInArrow(compare, "u long, v long").distinct()).distinct()

    def _compare(self, keyed: DataFrame, counts: DataFrame, pairs: DataFrame) -> bool:
        """Verify pairs; new links go into self.links and self.roots. Sets that are still missing are gathered first."""
        pairs = write_table(self.possible(pairs, counts), "pairs")
        wanted = pairs.select(F.col("u").alias("fp")).unionByName(pairs.select(F.col("v").alias("fp"))).distinct()
        wanted = write_table(wanted.join(self.held.select("fp"), "fp", "left_anti") if self.held else wanted, "wanted")
        if not wanted.isEmpty():
            more = self.sets(keyed, wanted)
            self.held = self.held.unionByName(more) if self.held else more
        found = write_table(self.linked(pairs, self.held) if self.held else pairs, "links")
        drop_table(wanted)
        drop_table(pairs)
        if found.isEmpty():
            return False
        self.links = self.links.unionByName(found)
        self.roots = write_table(components(self.links), "roots")
        return True

    def _open(self, lists: DataFrame) -> DataFrame:
        """Lists that still have members of two components or more, each member with its component c."""
        known = lists.join(self.roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("c", F.coalesce("root", "fp")).drop("root")
        known = write_table(known, "known")
        several = known.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high").select("key")
        several = write_table(several, "several")
        out = write_table(known.join(several, "key", "left_semi"), "open")
        drop_table(known)
        drop_table(several)
        return out


def near_components(
    docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, rounds: int = ROUNDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row."""
    mark = tables_written()
    thin = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    join = Join(thin, n, percent, rounds)
    keyed, roots = join.run(), join.roots
    classes = keyed.filter("n_shingles > 0").groupBy("fp").agg(F.min("doc_id").alias("_low"))
    classes = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = classes.groupBy("root").agg(F.min("_low").alias("component_id"))
    classes = write_table(classes.select("fp", "root").join(named, "root").select(F.col("fp").alias("_fp"), "component_id"), "classes")
    own = keyed.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("fp")).alias("fp"))
    out = own.join(classes, F.col("fp") == F.col("_fp"), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    result = write_table(out.select("doc_id", "n_shingles", component.alias("component_id")), "components")
    drop_since(mark, result)
    return result


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM p JOIN n a ON u = a.doc_id JOIN n b ON v = b.doc_id WHERE 100 * i >= 80 * (a.n + b.n - i)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r AS (SELECT u AS doc_id, v AS reached FROM e UNION SELECT r.doc_id, e.v FROM r JOIN e ON r.reached = e.u),
m AS (SELECT doc_id, min(reached) AS low FROM r GROUP BY 1)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(least(low, w.doc_id), w.doc_id) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""


def op8(spark, sf_dir: str) -> DataFrame:
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
