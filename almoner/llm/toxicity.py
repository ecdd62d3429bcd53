"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are positives; texts drawn regardless of their labels are the unlabelled ones. A linear
classifier on the presence of words is trained in numpy on the risk

    pi R_P+ + max(0, R_U- - pi R_P-)

with the logistic loss, where pi is the class prior (the share of toxic rows among the labelled ones that may be
learned from). Where the second part falls below zero its gradient is turned round, as a negative risk of the
unseen negatives can only be overfitting. Words are picked before by how much more often positives have them.

The fit takes a sample bounded by `positives` and `unlabelled` (expected rows; positives drawn by a hash of the id, which
names one document, unlabelled ones by a hash of id and text; whole texts of any length); scoring covers every text. Words are runs of [0-9a-z] and non-ASCII characters, A-Z lower-cased.

Null and empty texts get the score of no words. Without positives or unlabelled texts every score is the prior.
Null labels count as no label; several labels of one document count one by one. A column named as the result is
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.llm.common import Words, add_result, fold, slices, small_batches, translate_bytes
from almoner.llm.decontaminate import TABLE

POSITIVES, UNLABELLED = 2000, 8000
FEATURES, STEPS, RATE, DECAY, LEAST_Z = 512, 400, 0.1, 1e-4, 4.0
THRESHOLD = 0.3


@dataclass
class Classifier:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        w = Words(translate_bytes(texts, TABLE))
        total = np.full(w.n, self.bias)
        if len(w.ids) and len(self.words):
            h = w.hashes()
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            known = self.words[at] == h
            use = known[w.ids]
            pairs = np.unique(w.doc[use] * len(self.words) + at[w.ids[use]])
            total += np.bincount(pairs // len(self.words), self.weights[pairs % len(self.words)], minlength=w.n)
        return 1 / (1 + np.exp(-total))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


def risk(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """pi R_P+ and R_U- - pi R_P- of a linear classifier; p, u: rows of positives and unlabelled."""
    fp, fu = p @ w, u @ w
    return prior * np.logaddexp(0, -fp).mean(), np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()


def gradient(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """What to go down along: the gradient of the sum of both parts, or, where the second is negative, that of its opposite."""
    fp, fu = p @ w, u @ w
    second = u.T @ sigmoid(fu) / len(u) - prior * (p.T @ sigmoid(fp)) / len(p)
    if risk(w, p, u, prior)[1] < 0:
        return -second
    return second - prior * (p.T @ sigmoid(-fp)) / len(p)


def train(x: np.ndarray, positive: np.ndarray, prior: float, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias from a presence matrix whose rows are positives or unlabelled."""
    x = np.c_[x, np.ones(len(x))].astype(np.float64)
    p, u = x[positive], x[~positive]
    w = np.zeros(x.shape[1])
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        grad = gradient(w, p, u, prior)
        grad[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def fit_rows(sets: list[np.ndarray], positive: np.ndarray, prior: float) -> Classifier:
    """A classifier from each row's distinct word hashes."""
    n_p, n_u = int(positive.sum()), int((~positive).sum())
    if not n_p or not n_u:
        return Classifier(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    words, code = np.unique(np.concatenate(sets), return_inverse=True)
    in_p = np.bincount(code[positive[rows]], minlength=len(words))
    in_u = np.bincount(code[~positive[rows]], minlength=len(words))
    pooled = (in_p + in_u + 1) / (n_p + n_u + 2)
    z = (in_p / n_p - in_u / n_u) / np.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u))
    best = np.argsort(-np.abs(z), kind="stable")[:FEATURES]
    best = np.sort(best[(np.abs(z[best]) >= LEAST_Z) & (in_p + in_u >= 3)[best]])
    place = np.full(len(words), -1)
    place[best] = np.arange(len(best))
    x = np.zeros((len(sets), len(best)), np.float32)
    use = place[code] >= 0
    x[rows[use], place[code[use]]] = 1
    weights, bias = train(x, positive, prior)
    return Classifier(words[best], weights, bias)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Classifier:
    """docs: doc_id and text; labels: doc_id and toxic; learn: which doc_ids may be learned from."""
    small_batches(docs.sparkSession)
    known = labels.filter(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    n, toxic = known.agg(F.count(F.lit(1)), F.sum((F.col("toxic") == 1).cast("long"))).first()
    prior = min(0.9, max(0.001, (toxic or 0) / n)) if n else 0.5
    scale = 1 << 30
    drawn = lambda share, *by: F.pmod(F.xxhash64(*by), F.lit(scale).cast("long")) < int(min(1.0, share) * scale)
    chosen = known.filter((F.col("toxic") == 1) & drawn(positives / max(1, toxic or 0), "doc_id", F.lit("p"))).select("doc_id").distinct()
    n_docs = docs.filter(learn).count()
    rows = docs.filter(learn).select("doc_id", "text", drawn(unlabelled / max(1, n_docs), "doc_id", "text", F.lit("u")).alias("_u"))
    rows = rows.join(F.broadcast(chosen.withColumn("_p", F.lit(True))), "doc_id", "left")  # at most `positives` ids
    rows = rows.select("text", F.coalesce("_p", F.lit(False)).alias("p"), "_u").filter("p OR _u")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(0)):
                w = Words(translate_bytes(part, TABLE))
                h = w.hashes()
                sets = [h[np.unique(w.ids[a:b])].tobytes() for a, b in zip(w.starts[:-1], w.starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets, pa.binary()), batch.column(1).slice(at, len(part)), batch.column(2).slice(at, len(part))],
                    ["s", "p", "u"]
                )
                at += len(part)

    sets, positive = [], []
    for row in rows.mapInArrow(take, "s binary, p boolean, u boolean").toLocalIterator():  # the bounded sample
        for use, label in ((row.p, True), (row.u, False)):
            if use:
                sets.append(np.frombuffer(bytes(row.s), np.uint64))
                positive.append(label)
    return fit_rows(sets, np.array(positive, bool), prior)


def score(docs: DataFrame, model: Classifier, text: str = "text", out: str = "toxicity") -> DataFrame:
    """docs with the probability of toxicity as column `out`."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.concat_arrays([pa.array(shared.value.scores(part)) for part in slices(texts)])

    return add_result(docs, out, judge.asNondeterministic()(F.col(f"`{text}`").cast("string")))


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held = fold(F.col("doc_id"), 4) == 2
    r = score(docs, fit(docs, labels, ~held))
    s = F.col("toxicity")
    return r.select("doc_id", held.alias("held_out"), s.alias("score"), (s >= THRESHOLD).cast("int").alias("predicted"))
