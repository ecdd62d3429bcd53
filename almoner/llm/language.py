"""Language identification by interpolated Kneser-Ney character models, one for each language.

Texts are lower-cased and cut into runs of letters; a run is scored as its characters and an end mark, in the
context of the characters before it in the run (from a begin mark on). A model needs only how often each run occurs
in each language, so that is all that training gathers, from a sample bounded by `docs_per_language` (expected rows,
drawn by a hash of id and text; whole texts; rows that agree in both are drawn together).

For order n down to 1: P_n(c|h) = max(a(hc) - D_n, 0)/a(h) + D_n T(h)/a(h) P_(n-1)(c|h'), where a counts occurrences
at the highest order and after a begin mark, and distinct left extensions elsewhere; T(h) is the number of distinct
continuations; D_n = n1/(n1 + 2 n2). P_0 is uniform over the language's characters and one unseen one. Finished
probabilities and back-off weights lie in arrays sorted by hash, shared by all languages (one column each).

A text gets the language of the lowest cross-entropy for each character (ties: the first by code point). Its score
is the softmax of those entropies at a temperature, and it is `accepted` if the entropy is at most a limit; both
are calibrated on a fifth of the sample that the counts don't use.

Texts of any length are judged whole. Null texts and texts without a letter: `und`, score 0, not accepted; so is every text if nothing was learned. Rows
are judged one by one. A column named as the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.llm.common import BATCH_BYTES, Words, add_result, fold, mix, slices, small_batches

ORDER, DOCS_PER_LANGUAGE, UND = 4, 1500, "und"
#: Temperatures tried in calibration, and how many deviations above the mean entropy are still accepted.
TEMPERATURES, DEVIATIONS = (1, 2, 4, 8, 16, 32, 64), 4.0
BEGIN, END = 1, 2
BLOCK = 2_000_000
K = np.uint64(0x9E3779B97F4A7C15)


def letter_runs(texts: pa.Array) -> Words:
    return Words(pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}]+", " "))


def symbols(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, each between its marks; for each symbol its place in the word."""
    text = "".join(chr(BEGIN) + w + chr(END) for w in words.to_pylist())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    at = np.arange(len(codes))
    return codes, at - np.maximum.accumulate(np.where(codes == BEGIN, at, 0))


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1..order, the hash of the n symbols that end at each position (meaningless where fewer stand before)."""
    out = [mix(codes + K)]
    for n in range(1, order):
        left = np.r_[np.zeros(n, np.uint64), codes[:-n]] if n < len(codes) else np.zeros(len(codes), np.uint64)
        out.append(mix(out[-1] * K + left + np.uint64(n)))
    return out


def _find(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Row of each hash in a sorted array, -1 where it isn't."""
    at = np.minimum(np.searchsorted(table, h), max(0, len(table) - 1))
    return np.where(table[at] == h, at, -1) if len(table) else np.full(len(h), -1)


@dataclass
class Models:
    languages: list[str]
    order: int
    grams: list[tuple[np.ndarray, np.ndarray]]  # for n = 1..order: sorted hashes, log probabilities (NaN: not seen)
    contexts: list[tuple[np.ndarray, np.ndarray]]  # sorted hashes of n - 1 symbols, log back-off weights (0: not seen)
    floor: np.ndarray  # log P_0
    temperature: float = 1.0
    limits: np.ndarray | None = None

    def entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy for each character of each text in each language, and each text's number of characters."""
        w, n_lang = letter_runs(texts), len(self.languages)
        logs, length = np.zeros((len(w.vocab), n_lang)), np.zeros(len(w.vocab), np.int64)
        sizes = pc.utf8_length(w.vocab).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes + 2), 0
        while at < len(w.vocab):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK // max(1, n_lang))))
            logs[at:stop] = self._words(w.vocab.slice(at, stop - at))
            at = stop
        length = (sizes + 1)[w.ids] if len(w.ids) else length[:0]
        total = np.bincount(w.doc, length, minlength=w.n) if len(w.ids) else np.zeros(w.n)
        sums = np.stack(
            [np.bincount(w.doc, logs[w.ids, k], minlength=w.n) if len(w.ids) else np.zeros(w.n) for k in range(n_lang)], 1
        ) if n_lang else np.zeros((w.n, 0))
        return -sums / np.maximum(total, 1)[:, None], total

    def _words(self, words: pa.Array) -> np.ndarray:
        codes, place = symbols(words)
        hashes = gram_hashes(codes, self.order)
        scored = np.flatnonzero(place > 0)
        out = np.full((len(scored), len(self.languages)), np.nan)
        weight = np.zeros_like(out)
        for n in range(self.order, 0, -1):
            here = np.flatnonzero(place[scored] + 1 >= n)
            pos = scored[here]
            table, values = self.grams[n - 1]
            row = _find(table, hashes[n - 1][pos])
            seen = np.where((row >= 0)[:, None], values[row], np.nan) if len(table) else np.full((len(pos), out.shape[1]), np.nan)
            open_ = np.isnan(out[here])
            out[here] = np.where(open_, weight[here] + seen, out[here])
            table, values = self.contexts[n - 1]
            if n == 1:
                weight[here] += values[0]
            elif len(table):
                row = _find(table, hashes[n - 2][pos - 1])
                weight[here] += np.where((row >= 0)[:, None], values[row], 0.0)
        out = np.where(np.isnan(out), weight + self.floor, out)
        first = np.searchsorted(scored, np.flatnonzero(place == 0))
        return np.add.reduceat(out, first, axis=0) if len(first) else np.zeros((0, out.shape[1]))

    def judge(self, texts: pa.Array) -> pa.StructArray:
        lang, score, low, ok = np.full(len(texts), UND, object), np.zeros(len(texts)), np.full(len(texts), np.nan), np.zeros(len(texts), bool)
        if self.languages:
            ce, size = self.entropies(texts)
            best = np.argmin(ce, 1)
            some = size > 0
            low = np.where(some, ce[np.arange(len(ce)), best], np.nan)
            p = np.exp(-self.temperature * (ce - ce.min(1, keepdims=True)))
            score = np.where(some, 1 / p.sum(1), 0.0)
            lang = np.where(some, np.array(self.languages, object)[best], UND)
            ok = some & (self.limits is None or low <= self.limits[best])
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score), pa.array(low), pa.array(ok)],
            ["lang_pred", "score", "cross_entropy", "accepted"]
        )


def kneser_ney(words: list[str], counts: np.ndarray, order: int) -> tuple[list, list, float]:
    """One language's grams and contexts for n = 1..order (as in Models), and log P_0."""
    codes, place = symbols(pa.array(words, pa.string()))
    hashes = gram_hashes(codes, order)
    weight = np.repeat(counts, [len(w) + 2 for w in words])
    floor = -np.log(len(np.unique(codes[place > 0])) + 1.0)
    tables, raw, left = [None] * order, None, None
    for n in range(order, 0, -1):
        pos = np.flatnonzero((place > 0) & (place + 1 >= n))
        h, at, inverse = np.unique(hashes[n - 1][pos], return_index=True, return_inverse=True)
        raw = np.bincount(inverse, weight[pos])
        from_begin = place[pos[at]] + 1 == n
        a = raw
        if n < order:
            extended = np.bincount(_find(h, left), minlength=len(h)).astype(float)
            a = np.where(from_begin, raw, extended)
        one = pos[at]
        context = hashes[n - 2][one - 1] if n > 1 else np.zeros(len(h), np.uint64)
        lower = hashes[n - 2][one] if n > 1 else None
        tables[n - 1] = h, a, context, lower
        left = lower
    grams, contexts, below = [], [], None
    for n in range(1, order + 1):
        h, a, context, lower = tables[n - 1]
        n1, n2 = np.count_nonzero(a == 1), np.count_nonzero(a == 2)
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        c, inverse = np.unique(context, return_inverse=True)
        total, kinds = np.bincount(inverse, a), np.bincount(inverse)
        gamma = d * kinds / total
        p0 = np.exp(floor) if n == 1 else below[1][_find(below[0], lower)]
        p = np.maximum(a - d, 0) / total[inverse] + gamma[inverse] * p0
        grams.append((h, np.log(p)))
        contexts.append((c, np.log(gamma)))
        below = h, p
    return grams, contexts, floor


def _merge(parts: list[tuple[np.ndarray, np.ndarray]], missing: float) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(np.concatenate([h for h, _ in parts]))
    out = np.full((len(keys), len(parts)), missing)
    for k, (h, v) in enumerate(parts):
        out[np.searchsorted(keys, h), k] = v
    return keys, out


def build(counts: pd.DataFrame, order: int = ORDER) -> Models:
    """Models from lang, word and n (occurrences)."""
    languages = sorted(counts["lang"].unique(), key=lambda x: x.encode())
    own = [counts[counts["lang"] == x].sort_values("word") for x in languages]
    fits = [kneser_ney(x["word"].tolist(), x["n"].to_numpy(float), order) for x in own]
    return Models(
        languages,
        order,
        [_merge([f[0][n] for f in fits], np.nan) for n in range(order)] if fits else [],
        [_merge([f[1][n] for f in fits], 0.0) for n in range(order)] if fits else [],
        np.array([f[2] for f in fits]),
    )


def fit(
    docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", order: int = ORDER,
    docs_per_language: int = DOCS_PER_LANGUAGE
) -> Models:
    """Models from the rows where `learn` holds and the language isn't null."""
    small_batches(docs.sparkSession)
    rows = docs.filter(learn & F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"),
        F.col(f"`{lang}`").cast("string").alias("lang")
    )
    sizes = rows.groupBy("lang").count()  # a row for each language
    share = sizes.select(F.col("lang").alias("_lang"), (F.lit(float(docs_per_language)) / F.col("count")).alias("_share"))
    drawn = F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(1 << 30).cast("long")) < F.col("_share") * (1 << 30)
    sample = rows.join(F.broadcast(share), F.col("lang") == F.col("_lang")).filter(drawn)
    sample = sample.select("text", "lang", (F.pmod(F.xxhash64("doc_id", "text", F.lit("calibrate")), F.lit(5)) == 0).alias("held"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, at = batch.column(1).dictionary_encode(), 0
            for part in slices(batch.column(0)):
                w = letter_runs(part)
                own = langs.indices.to_numpy(zero_copy_only=False)[at : at + len(part)].astype(np.int64)
                at += len(part)
                if len(w.ids):
                    key, n = np.unique(own[w.doc] * len(w.vocab) + w.ids, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [langs.dictionary.take(pa.array(key // len(w.vocab))), w.vocab.take(pa.array(key % len(w.vocab))), pa.array(n)],
                        ["lang", "word", "n"]
                    )

    counts = sample.filter("NOT held").select("text", "lang").mapInArrow(
        count, "lang string, word string, n long"
    ).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    models = build(counts.toPandas(), order)  # bounded by the sample
    if models.languages:
        calibrate(models, sample.filter("held").select("text", "lang"))
    return models


def calibrate(models: Models, held: DataFrame) -> None:
    shared = held.sparkSession.sparkContext.broadcast(models)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(0)):
                ce, size = shared.value.entropies(part)
                rows = np.flatnonzero(size > 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(at, len(part)).take(pa.array(rows)), pa.array(ce[rows].tolist(), pa.list_(pa.float64()))],
                    ["lang", "ce"]
                )
                at += len(part)

    rows = held.mapInArrow(measure, "lang string, ce array<double>").toPandas()  # a fifth of the bounded sample
    rows = rows[rows["lang"].isin(models.languages)]
    limits = np.full(len(models.languages), np.inf)
    if len(rows):
        ce = np.stack(rows["ce"].to_numpy())
        own = np.array([models.languages.index(x) for x in rows["lang"]])
        rel = ce - ce.min(1, keepdims=True)
        loss = [np.mean(t * rel[np.arange(len(own)), own] + np.log(np.exp(-t * rel).sum(1))) for t in TEMPERATURES]
        models.temperature = float(TEMPERATURES[int(np.argmin(loss))])
        for k in range(len(limits)):
            mine = ce[(own == k) & (ce.argmin(1) == k), k]
            if len(mine) > 1:
                limits[k] = mine.mean() + DEVIATIONS * mine.std()
    models.limits = limits


def identify(docs: DataFrame, models: Models, text: str = "text", out: str = "language") -> DataFrame:
    """docs with a struct `out`: lang_pred, score, cross_entropy, accepted."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    @F.arrow_udf("lang_pred string, score double, cross_entropy double, accepted boolean")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.concat_arrays([shared.value.judge(part) for part in slices(texts, BATCH_BYTES)])

    return add_result(docs, out, judge.asNondeterministic()(F.col(f"`{text}`").cast("string")))


def op3(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = fold(F.col("doc_id"), 4) == 2
    r = identify(docs.select("doc_id", "text"), fit(docs, ~held))
    return r.select(
        "doc_id", held.alias("held_out"), F.col("language.lang_pred").alias("lang_pred"), F.col("language.score").alias("score"),
        F.col("language.cross_entropy").alias("cross_entropy"), F.col("language.accepted").alias("accepted")
    )
