"""Quality rules from a suffix array: how much of a text repeats within it, and for how long.

Each text's words are sorted into a suffix array by prefix doubling (only groups that still tie are sorted
again). An interval of equal longest-common-prefix (LCP) values is a maximal repeat; the suffix at rank r lies
deepest in the one of value max(LCP[r], LCP[r+1]). The union of the spans of repeats of at least `min_words`
words is the repeated part. A text is kept if that part covers at most `max_covered` of its word characters and
no repeat is longer than `max_longest` words.

Null text: as an empty one. Empty or short texts have no repeats. Texts of any length are taken whole (one longer than a
chunk is a chunk of its own). Rows are judged one by one: repeated rows and
ties change nothing, an empty table gives an empty table. A column named as the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.llm.common import Words, add_result, slices, small_batches

FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, repeat_chars long, longest_repeat long, repeat_spans array<struct<start:int,end:int>>"
SYMBOLS = "[#*$%&|<>]"


def suffix_array(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted suffixes, and for each doubling k the class of each position's first 2**k symbols.

    ends[i] is where the text of position i stops; symbols of different texts must differ."""
    n = len(symbols)
    place = np.int32 if n < 1 << 31 else np.int64
    order = np.argsort(symbols, kind="stable").astype(place)
    first = np.r_[True, np.diff(symbols[order]) != 0]
    rank = np.empty(n, place)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n, dtype=place), 0))
    levels, width = [rank], 1
    while len(slots := np.flatnonzero(~(first & np.r_[first[1:], True]))):
        pos = order[slots]
        after = pos.astype(np.int64) + width
        second = np.where(after < ends[pos], rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[pos].astype(np.int64) * (n + 1) + second
        by = np.argsort(key, kind="stable")
        order[slots], key = pos[by], key[by]
        new = np.r_[True, np.diff(key) != 0]
        first[slots] = new
        rank = rank.copy()
        rank[order[slots]] = np.maximum.accumulate(np.where(new, slots, 0))
        levels.append(rank)
        width *= 2
    return order, levels


def longest_repeats(order: np.ndarray, levels: list[np.ndarray], ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a repeat of at least `least` symbols begins, and the longest one's length."""
    k = min(least.bit_length() - 1, len(levels) - 1)
    same = levels[k][order]
    r = np.flatnonzero(same[1:] == same[:-1])
    a, b = order[r].astype(np.int64), order[r + 1].astype(np.int64)
    lcp = np.zeros(len(r), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        inside = (x < ends[a]) & (y < ends[b])
        x, y = np.minimum(x, len(order) - 1), np.minimum(y, len(order) - 1)
        lcp += np.where(inside & (levels[k][x] == levels[k][y]), 1 << k, 0)
    long = lcp >= least
    pos, best = np.concatenate([a[long], b[long]]), np.concatenate([lcp[long]] * 2)
    by = np.lexsort((-best, pos))
    pos, best = pos[by], best[by]
    top = np.r_[True, np.diff(pos) != 0][: len(pos)]
    return pos[top], best[top]


def measure(texts: pa.Array, min_words: int) -> pa.StructArray:
    """FIELDS for each text."""
    w = Words(texts)
    count = lambda x, weights=None: np.bincount(x, weights, minlength=w.n).astype(np.int64)
    chars = pc.utf8_length(w.vocab).to_numpy(zero_copy_only=False).astype(np.int64)[w.ids]
    covered, longest = np.zeros(len(w.ids), bool), np.zeros(w.n, np.int64)
    if len(w.ids):
        ends = w.starts[1:][w.doc]
        order, levels = suffix_array(w.doc * len(w.vocab) + w.ids, ends)
        pos, best = longest_repeats(order, levels, ends, min_words)
        edge = np.bincount(pos, minlength=len(w.ids) + 1) - np.bincount(pos + best, minlength=len(w.ids) + 1)
        covered = np.cumsum(edge)[:-1] > 0
        np.maximum.at(longest, w.doc[pos], best)
    on = np.flatnonzero(
        covered & ~(np.r_[False, covered[:-1]] & np.r_[True, w.doc[1:] == w.doc[:-1]][: len(covered)])
    ) if len(covered) else np.zeros(0, np.int64)
    off = np.flatnonzero(covered & ~(np.r_[covered[1:], False] & np.r_[w.doc[1:] == w.doc[:-1], True][: len(covered)])) if len(covered) else on
    at = w.doc[on] if len(on) else on
    spans = pa.ListArray.from_arrays(
        pa.array(np.r_[0, np.cumsum(count(at))].astype(np.int32)),
        pa.StructArray.from_arrays(
            [pa.array((on - w.starts[at]).astype(np.int32)), pa.array((off + 1 - w.starts[at]).astype(np.int32))],
            ["start", "end"]
        ),
    )
    lines = pc.split_pattern(texts, "\n")
    of = np.repeat(np.arange(w.n), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    coded = lines.flatten().dictionary_encode()
    line = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    worded = (
        pc.binary_length(pc.ascii_trim_whitespace(coded.dictionary)).to_numpy(zero_copy_only=False) > 0
    )[line] if len(line) else np.zeros(0, bool)
    of, line = of[worded], line[worded]
    size = max(1, len(coded.dictionary))
    values = {
        "n_words": w.lens,
        "word_chars": count(w.doc, chars),
        "n_symbols": pc.count_substring_regex(texts, SYMBOLS).to_numpy(zero_copy_only=False).astype(np.int64),
        "n_dup_lines": count(of) - count(np.unique(of * size + line) // size),
        "n_repeat_words": count(w.doc[covered]),
        "repeat_chars": count(w.doc[covered], chars[covered]),
        "longest_repeat": longest,
    }
    return pa.StructArray.from_arrays([*map(pa.array, values.values()), spans], [*values, "repeat_spans"])


def repetition_quality(
    docs: DataFrame, text: str = "text", min_words: int = 8, max_covered: float = 0.3, max_longest: int = 100,
    out: str = "repetition"
) -> DataFrame:
    """docs with a struct `out`: FIELDS and `repeats_kept`, the verdict."""

    @F.arrow_udf(FIELDS)
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.concat_arrays([measure(part, min_words) for part in slices(texts)])

    small_batches(docs.sparkSession)
    found = add_result(docs, out, measured.asNondeterministic()(F.col(f"`{text}`").cast("string")))
    r = F.col(f"`{out}`")
    ok = (r["repeat_chars"] <= F.lit(max_covered) * r["word_chars"]) & (r["longest_repeat"] <= max_longest)
    return add_result(found, out, r.withField("repeats_kept", ok))


#: The base rule's limits.
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30


def judged(docs: DataFrame, out: str = "repetition") -> DataFrame:
    """repetition_quality() with `base_failed` (too short, or too many words in repeated windows) and `kept` (neither it nor the method objects)."""
    r = F.col(f"`{out}`")
    base = (r["n_words"] < MIN_WORDS) | (100 * r["n_repeat_words"] > MAX_REPEAT_PERCENT * r["n_words"])
    return add_result(repetition_quality(docs, out=out), out, r.withField("base_failed", base).withField("kept", ~base & r["repeats_kept"]))


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    r = judged(docs)
    return r.select(
        "doc_id",
        *[F.col(f"repetition.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")]
    )


ORACLE = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 7], ' ')) AS k FROM p),
d AS (SELECT DISTINCT doc_id, place FROM (SELECT doc_id, unnest(range(i, i + 8)) AS place FROM g WHERE k > 1)),
r AS (SELECT d.doc_id, count(*) AS n, sum(length(w[place])) AS chars FROM d JOIN w USING (doc_id) GROUP BY 1),
q AS (SELECT doc_id, w, unnest(range(1, len(w) - 99)) AS i FROM w WHERE len(w) >= 101),
l AS (SELECT DISTINCT doc_id FROM (SELECT doc_id FROM q GROUP BY doc_id, array_to_string(w[i:i + 100], ' ') HAVING count(*) > 1)),
n AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dups FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
a AS (SELECT w.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
        coalesce(n.dups, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(r.chars, 0) AS chars, l.doc_id IS NOT NULL AS long
      FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM a)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND chars <= 0.3 * word_chars AND NOT long AS kept FROM b
"""
