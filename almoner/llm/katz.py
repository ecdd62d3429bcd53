"""Language-model scores by Katz back-off with Good-Turing discounts, for n-grams of any order.

Tokens are a text's words (A-Z lower-cased), then one end; a beginning stands before them as context. With c a count
over the training documents, h a context of n - 1 tokens and h' the same less its first one,

    P(w|h) = scale(h) d(c(hw)) c(hw)/c(h)   if hw was seen
           = alpha(h) P(w|h')               if not, and recursively so (alpha = 1 where h wasn't seen)
    P(w)   = scale d(c(w)) c(w)/N           if w was seen, else what that leaves, for the one unknown word

d(r) is Katz's Good-Turing discount of the order for r <= k and 1 above; where the counts of counts don't give one
between 0 and 1, absolute discounting by n1/(n1 + 2 n2). alpha(h) makes the probabilities after h sum to exactly one:
what the seen words leave, over what P(.|h') gives the unseen ones. A context that its counts leave nothing gives up
1/(c(h)+1), by `scale`.

Counts and look-ups share their shuffles. Documents are packed by task (tokens as numbers in the pack's own
vocabulary). A pack asks for each of its distinct grams once, with its own training count, in messages to the parts
that hold the order's table. A part sums the counts, numbers its seen grams, keeps them as its partition of the table,
and answers every pack with the counts and numbers of just the grams it asked for, and with the sums of those contexts
whose weights it needs. Told of its words, a pack is written anew with their numbers for their hashes. A gram of the next order is named by its context's part and number and its last word's number,
so names are exact and short, and a context's continuations meet in its own part; contexts of more than `spread`
tokens are dealt over several parts, whose sums are added up and joined to the packs that want them. Nothing that
grows with the corpus is broadcast or sent to the driver: only N, V and the counts of counts are.

Packs and parts grow as the square root of the corpus up to a bound, so that messages stay worth their overhead. Sizes
change times, never results.

Null texts are empty texts (one token, the end). Without training tokens every probability is 1. Rows with equal
ids are scored one by one; an empty table gives an empty one. A text longer than a pack is a pack of its own. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.llm.common import Words, drop_table, fold, mix, partitions, slices, small_batches, write_table

ORDER, MOST_DISCOUNTED = 3, 5
#: Tokens of a pack and grams of a part: so many for each root of the corpus's tokens, within bounds.
PER_ROOT, LEAST_SIZE, MOST_SIZE = 64, 250_000, 8_000_000
BEGIN, END = np.uint64(0x1B873593CC9E2D51), np.uint64(0x2545F4914F6CDD1D)
#: Kinds of messages: a pack itself; counts go by their order, sums of spread contexts by its negative.
PACK = 0
MESSAGE = "pack long, kind int, part int, number long, a binary, b binary, sums array<double>"
FIELDS = ("pack", "kind", "part", "number", "a", "b", "sums")
#: Whose rows they are that no pack has: the model's table, and a part's sums of spread contexts.
MODEL, SUMS = -1, -2
#: A context's key is its number, then (in so many bits) which of its parts this is, counted from 1; 0: it has one.
STEP_BITS = 16
MOST_STEPS = (1 << STEP_BITS) - 1


def planes(x: np.ndarray) -> bytes:
    """An array's bytes by significance (the unused high ones shrink to nothing), compressed."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes(), 1)


def unplanes(b: bytes, kind: type) -> np.ndarray:
    b, size = zstandard.decompress(b), np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, len(b) // size).T).view(kind).ravel()


def joined(parts: list[bytes]) -> bytes:
    """Byte strings with their lengths, as one."""
    return b"".join([np.array([len(parts), *map(len, parts)], np.int64).tobytes(), *parts])


def apart(b: bytes) -> list[bytes]:
    n = int(np.frombuffer(b, np.int64, 1)[0])
    ends = np.cumsum(np.frombuffer(b, np.int64, n, 8)) + 8 + 8 * n
    return [b[x:y] for x, y in zip([8 + 8 * n, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def pack_keys(h: np.ndarray) -> bytes:
    """Numbers as differences (exact in any order, short in rising order)."""
    return planes(np.diff(h.astype(np.uint64), prepend=np.uint64(0)))


def unpack_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unplanes(b, np.uint64), dtype=np.uint64)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ((),) * len(FIELDS)
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], list(FIELDS))


def runs(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The parts of a sorted array, and where each lies."""
    at = [*np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(part)]).tolist(), len(part)]
    for lo, hi in zip(at, at[1:], strict=False):
        yield int(part[lo]), slice(lo, hi)


def distinct(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct numbers in order, where each is first, and each entry's place among them."""
    bits = max(1, (len(code) - 1).bit_length())
    if not len(code) or int(code.max()).bit_length() + bits > 63:
        return np.unique(code, return_index=True, return_inverse=True)
    both = np.sort((code << bits) | np.arange(len(code)))  # much faster than sorting places by numbers
    at, code = both & ((1 << bits) - 1), both >> bits
    new = np.r_[True, code[1:] != code[:-1]]
    inverse = np.empty(len(code), np.int64)
    inverse[at] = np.cumsum(new) - 1
    return code[new], at[new], inverse


def size_for(tokens: float) -> int:
    return int(min(MOST_SIZE, max(LEAST_SIZE, PER_ROOT * max(0.0, tokens) ** 0.5)))


class Discounts:
    """What the counts of counts give: d(r) c for each count, and the unigrams' remainder."""

    def __init__(self, stats: list[int]):
        """stats: how many grams have the counts 1..k+1, the sum of all counts, the number of grams."""
        k = len(stats) - 3
        n = [0, *stats[: k + 1]]
        self.total, self.kinds = stats[-2], stats[-1]
        d = np.ones(k + 1)
        if n[1] and (common := (k + 1) * n[k + 1] / n[1]) < 1:
            for r in range(1, k + 1):
                d[r] = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if n[r] else np.nan
        if not all(0 < x < 1 for x in d[1:]):
            cut = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
            d[1:] = 1 - cut / np.arange(1, k + 1)
        self.d = d
        #: What is taken from a context by each of its grams of count 1..k.
        self.freed = (1 - d[1:]) * np.arange(1, k + 1)
        spare = sum((1 - d[r]) * r * n[r] for r in range(1, k + 1)) / self.total if self.total else 1.0
        self.unknown = spare if spare > 0 else 1 / (self.total + 1)
        self.scale = (1 - self.unknown) / (1 - spare) if spare < 1 else 1.0

    def mass(self, c: np.ndarray) -> np.ndarray:
        return np.where(c < len(self.d), self.d[np.minimum(c, len(self.d) - 1)], 1.0) * c

    def unigram(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.scale * self.mass(c) / max(1, self.total), self.unknown)


def wanted_runs(total: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of runs of grams with one context: whether its sums are needed, as a gram is unseen or none is discounted."""
    if not len(first):
        return np.zeros(0, bool)
    unseen = np.logical_or.reduceat(total == 0, first)
    return unseen | ~np.logical_or.reduceat((total > 0) & (total <= MOST_DISCOUNTED), first)


class Grams:
    """A pack's distinct grams of one order that have a seen context, in the order in which they are asked for."""

    def __init__(self, pack: Pack, n: int, home: np.ndarray, number: np.ndarray, count: np.ndarray, context: np.ndarray, low: np.ndarray):
        """home, number, count: of the contexts, in rising order; context: each token's (-1: none); low: each token's count at order n - 1."""
        self.n, self.home, self.number, self.count, self.context = n, home, number, count, context
        words = len(pack.code) + 1
        valid = np.flatnonzero(context >= 0)
        code, at, inverse = distinct(context[valid] * words + pack.tokens[valid])
        of, word = code // words, code % words
        own = np.bincount(inverse[pack.trained[valid]], minlength=len(code))
        code = np.r_[np.int64(0), pack.code + 1][word]
        # a context of more than `spread` tokens has its continuations dealt over parts from its home on
        wide = np.minimum(-(-count[of] // pack.spread), min(pack.parts, MOST_STEPS))
        step = np.where(wide > 1, mix(code.astype(np.uint64)).astype(np.int64) & ((1 << 62) - 1), 0) % np.maximum(1, wide)
        part = (home[of] + step) % pack.parts
        by = np.argsort(part, kind="stable")
        self.part, self.of, self.code, self.own = part[by], of[by], code[by], own[by]
        self.low = low[valid][at][by]
        self.wide = wide[by] > 1
        self.key = ((number[self.of] << STEP_BITS) | np.where(self.wide, step[by] + 1, 0)).astype(np.uint64)
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        self.gram = np.full(len(context), -1)  # each token's
        self.gram[valid] = place[inverse]
        self.first = np.flatnonzero(np.r_[True, (self.of[1:] != self.of[:-1]) | (self.part[1:] != self.part[:-1])][: len(by)])

    def asked(self, pack: int) -> pa.RecordBatch:
        rows = []
        for p, x in runs(self.part):
            a = joined([pack_keys(self.key[x]), planes(self.code[x].astype(np.uint64))])
            rows.append((pack, self.n, p, None, a, joined([planes(self.own[x].astype(np.uint32)), planes(self.low[x].astype(np.uint64))]), None))
        return batch(rows)

    def told(self, answers: list[tuple]) -> None:
        """Takes in the parts' answers, (part, number, a, b, sums) in the parts' order."""
        a = [apart(x[2]) for x in answers]
        self.total = np.concatenate([unplanes(x[0], np.uint64) for x in a] or [np.zeros(0, np.uint64)]).astype(np.int64)
        seen = np.flatnonzero(self.total > 0)
        self.rank = np.full(len(self.total), -1)
        if a and a[0][1]:
            self.rank[seen] = np.concatenate([unpack_keys(x[1]) for x in a]).astype(np.int64)
        b = [apart(x[3]) for x in answers if x[3] is not None]
        wanted = self.first[wanted_runs(self.total, self.first) & ~self.wide[self.first]]
        #: Of the contexts that it wanted: how many continuations have the counts 1..k, and the sum of their lower masses.
        self.few = np.zeros((len(self.home), MOST_DISCOUNTED))
        self.mass = np.zeros(len(self.home))
        self.known = np.zeros(len(self.home), bool)
        if len(wanted) and b:
            of = self.of[wanted]
            self.known[of] = True
            self.few[of] = np.concatenate([unplanes(x[0], np.uint32).reshape(-1, MOST_DISCOUNTED) for x in b])
            self.mass[of] = np.concatenate([unplanes(x[1], np.float64) for x in b])

    def told_sums(self, rows: list[tuple]) -> None:
        """Takes in the sums of spread contexts, (part, number, a, b, sums)."""
        if rows:
            at = np.searchsorted((self.home << 40) | self.number, np.array([(x[0] << 40) | x[1] for x in rows], np.int64))
            sums = np.array([x[4] for x in rows])
            self.few[at], self.mass[at], self.known[at] = sums[:, :-1], sums[:, -1], True

    def next_contexts(self, pack: Pack) -> tuple:
        """What Grams of the next order take: the seen grams of this one are its contexts."""
        seen = np.flatnonzero(self.total > 0)
        seen = seen[np.argsort((self.part[seen] << 40) | self.rank[seen], kind="stable")]
        place = np.full(len(self.total) + 1, -1)  # the last: a token without a gram
        place[seen] = np.arange(len(seen))
        context = np.r_[-1, place[self.gram[:-1]]]
        context[pack.first] = -1
        low = np.r_[self.total, 0][self.gram]
        return self.part[seen], self.rank[seen], self.total[seen], context, low


class Pack:
    """A pack's tokens and what it has been told about them."""

    def __init__(self, rows: list[tuple], parts: int, spread: int):
        """rows: (kind, part, number, a, b, sums). Tokens are places in the sorted hashes; once told, in `code`, counted from 1."""
        self.parts, self.spread = parts, spread
        a, b = next(x[3:5] for x in rows if x[0] == PACK)
        self.told = lambda kind: [x[1:] for x in sorted(rows, key=lambda x: x[1]) if x[0] == kind]
        lens, train, begin, *words = apart(b)
        lens, train = unplanes(lens, np.int64), unplanes(train, np.bool_)
        self.n, self.train = len(lens), train
        self.begin = int(np.frombuffer(begin, np.int64)[0])  # the beginning's place in the vocabulary
        self.tokens = unplanes(a, np.uint32).astype(np.int64)
        if words:
            self.code = unpack_keys(words[0]).astype(np.int64)
            self.c1 = np.r_[0, unplanes(words[1], np.uint64).astype(np.int64)]  # the first: of any unknown word
        self.doc = np.repeat(np.arange(self.n), lens)
        self.first = np.cumsum(lens) - lens
        self.trained = train[self.doc]

    @staticmethod
    def of(lens: np.ndarray, train: np.ndarray, words: np.ndarray, vocab: np.ndarray) -> tuple[bytes, bytes, bytes]:
        begin = np.searchsorted(vocab, BEGIN).astype(np.int64).tobytes()
        return planes(words.astype(np.uint32)), joined([planes(lens.astype(np.int64)), planes(train.astype(np.bool_)), begin]), pack_keys(vocab)

    def asked(self, pack: int, vocab: np.ndarray) -> pa.RecordBatch:
        """Its words (their sorted hashes), with training counts."""
        own = np.bincount(self.tokens[self.trained], minlength=len(vocab))
        own[self.begin] = self.train.sum()
        home = ((vocab >> np.uint64(32)) * np.uint64(self.parts)) >> np.uint64(32)
        return batch([(pack, 1, p, None, pack_keys(vocab[x]), planes(own[x].astype(np.uint32)), None) for p, x in runs(home)])

    def with_words(self) -> tuple[bytes, bytes]:
        """The pack's a and b once it has been told of its words: tokens by their numbers, which take the place of hashes and answers."""
        answers = [(x[0], *apart(x[2])) for x in self.told(1)]
        counts = [unplanes(x[1], np.uint64) for x in answers]
        c1 = np.concatenate(counts)
        home = np.repeat([x[0] for x in answers], [len(x) for x in counts])
        rank = np.full(len(c1), -1)
        rank[c1 > 0] = np.concatenate([unplanes(x[2], np.uint64) for x in answers]).astype(np.int64)
        # words by the numbers that all packs use: frequent ones have small ones
        code = rank * self.parts + home
        seen = np.flatnonzero(rank >= 0)
        by = seen[np.argsort(code[seen])]
        place = np.zeros(len(rank), np.int64)
        place[by] = np.arange(1, len(by) + 1)
        lens = np.bincount(self.doc, minlength=self.n)
        own = [planes(lens), planes(self.train), place[self.begin].tobytes(), pack_keys(code[by]), planes(c1[by])]
        return planes(place[self.tokens].astype(np.uint32)), joined(own)

    def grams(self, order: int) -> list[Grams]:
        """Its grams of the orders 2..order; the last may still have to be told."""
        home, rank = self.code % self.parts, self.code // self.parts
        by = np.argsort((home << 40) | rank)
        place = np.full(len(by) + 1, -1)
        place[by + 1] = np.arange(len(by))
        before = np.r_[0, self.tokens[:-1]]
        before[self.first] = self.begin
        out, given = [], (home[by], rank[by], self.c1[1:][by], place[before], self.c1[self.tokens])
        for n in range(2, order + 1):
            out.append(Grams(self, n, *given))
            answers = self.told(n)
            if answers or not len(out[-1].part):
                out[-1].told(answers)
                out[-1].told_sums(self.told(-n))
                given = out[-1].next_contexts(self)
        return out


def pack_documents(docs: DataFrame, pack_words: int) -> DataFrame:
    """docs: doc_id, text, train. Packs, with their ids."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, size, made = TaskContext.get().partitionId() << 32, [], 0, 0

        def out() -> pa.RecordBatch:
            ids, train = pa.concat_arrays([x[0] for x in held]), np.concatenate([x[1] for x in held])
            vocab = np.unique(np.concatenate([np.array([BEGIN, END]), *[x[4] for x in held]]))
            lens, tokens = np.concatenate([x[2] for x in held]) + 1, []
            for _, _, n, words, hashes in held:
                known = np.searchsorted(vocab, hashes)
                tokens.append(np.insert(known[words] if len(words) else words, np.cumsum(n), np.searchsorted(vocab, END)))
            parts = [pa.array([x], pa.binary()) for x in Pack.of(lens, train, np.concatenate(tokens), vocab)]
            values = [pa.array([own + made]), pa.array([int(lens.sum())]), *parts, pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)]
            return pa.RecordBatch.from_arrays(values, ["pack", "tokens", "a", "b", "vocab", "ids"])

        for x in batches:
            at = 0
            for part in slices(x.column(1)):
                w = Words(pc.ascii_lower(part))
                held.append(
                    (
                        x.column(0).slice(at, len(part)), x.column(2).slice(at, len(part)).to_numpy(zero_copy_only=False), w.lens,
                        w.ids.astype(np.int32), w.hashes()
                    )
                )
                at, size = at + len(part), size + len(w.ids)
                if size >= pack_words:
                    yield out()
                    held, size, made = [], 0, made + 1
        if held:
            yield out()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "train").mapInArrow(take, f"pack long, tokens long, a binary, b binary, vocab binary, ids array<{kind}>")


def stats_of(counts: np.ndarray) -> list[int]:
    return [
        *np.bincount(np.minimum(counts, MOST_DISCOUNTED + 2), minlength=MOST_DISCOUNTED + 3)[1 : MOST_DISCOUNTED + 2].tolist(),
        int(counts.sum()), len(counts)
    ]


def answered(rows: list[tuple], stats: list[int], keep: bool) -> pa.Table:
    """The rows of a part, the first (its partition of the table, which may be left out) with its counts of counts."""
    out = pa.Table.from_batches([batch(rows if keep else [(*rows[0][:4], None, None, None), *rows[1:]])])
    return out.append_column("stats", pa.array([stats] + [None] * (len(rows) - 1), pa.list_(pa.int64())))


def answer_words(keep: bool):
    """What a part does with the packs' words: its partition of the table, and the answers."""

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("pack")
        keys = [unpack_keys(b) for b in table.column("a").to_pylist()]
        own = np.concatenate([unplanes(b, np.uint32) for b in table.column("b").to_pylist()])
        h, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inverse, own, minlength=len(h)).astype(np.int64)
        seen = np.flatnonzero(total)
        number = np.zeros(len(h), np.uint64)
        number[seen[np.lexsort((h[seen], -total[seen]))]] = np.arange(len(seen))  # frequent words have small numbers
        part, at = key[0].as_py(), 0
        rows = [(MODEL, 1, part, None, joined([pack_keys(h[seen]), planes(number[seen])]), planes(total[seen]), None)]
        for pack, k in zip(table.column("pack").to_pylist(), keys, strict=True):
            mine = inverse[at : at + len(k)]
            rows.append((pack, 1, part, None, joined([planes(total[mine].astype(np.uint64)), planes(number[mine][total[mine] > 0])]), None, None))
            at += len(k)
        return answered(rows, stats_of(total[seen][h[seen] != BEGIN]), keep)

    return answer


def answer_grams(n: int, lower: Discounts, parts: int, last: bool, keep: bool):
    """The same for grams of order n, with the sums of contexts; lower: the discounts of order n - 1."""

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("pack")
        a = [apart(x) for x in table.column("a").to_pylist()]
        b = [apart(x) for x in table.column("b").to_pylist()]
        keys = [unpack_keys(x[0]) for x in a]
        context, word = np.concatenate(keys), np.concatenate([unplanes(x[1], np.uint64) for x in a])
        own, low = np.concatenate([unplanes(x[0], np.uint32) for x in b]), np.concatenate([unplanes(x[1], np.uint64) for x in b])
        bits = int(word.max()).bit_length()
        if int(context.max()).bit_length() + bits <= 64:
            by = np.argsort((context << np.uint64(bits)) | word, kind="stable")
        else:
            by = np.lexsort((word, context))
        new = np.r_[True, (context[by][1:] != context[by][:-1]) | (word[by][1:] != word[by][:-1])]
        gram = np.empty(len(by), np.int64)
        gram[by] = np.cumsum(new) - 1
        total = np.bincount(gram, own).astype(np.int64)
        context, word, low = context[by][new], word[by][new], low[by][new].astype(np.int64)
        seen = total > 0
        rank = np.cumsum(seen) - 1
        start = np.r_[True, context[1:] != context[:-1]]
        of = np.cumsum(start) - 1
        mass = np.bincount(of, np.where(seen, lower.unigram(low) if n == 2 else lower.mass(low), 0.0))
        size = MOST_DISCOUNTED + 2
        few = np.bincount(of * size + np.minimum(total, size - 1), minlength=len(mass) * size).reshape(-1, size)[:, 1:-1]
        part, at = key[0].as_py(), 0
        rows = [(MODEL, n, part, None, joined([pack_keys(context[seen]), planes(word[seen])]), planes(total[seen]), None)]

        def home(k: np.uint64) -> tuple[int, int]:
            """The part and number of a spread context."""
            return (part + 1 - int(k & np.uint64(MOST_STEPS))) % parts, int(k >> np.uint64(STEP_BITS))

        for k in np.flatnonzero(start & (context & np.uint64(MOST_STEPS) > 0)).tolist():
            p, number = home(context[k])
            rows.append((SUMS, n, p, number, None, None, [*few[of[k]].tolist(), float(mass[of[k]])]))
        for pack, k in zip(table.column("pack").to_pylist(), keys, strict=True):
            mine = gram[at : at + len(k)]
            at += len(k)
            got = total[mine]
            first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            want = first[wanted_runs(got, first)]
            wide = k[want] & np.uint64(MOST_STEPS) > 0
            own = of[mine[want[~wide]]]
            told = joined([planes(got.astype(np.uint64)), b"" if last else pack_keys(rank[mine][got > 0])])
            rows.append((pack, n, part, None, told, joined([planes(few[own].astype(np.uint32).ravel()), planes(mass[own])]), None))
            for x in k[want[wide]]:
                p, number = home(x)
                rows.append((pack, -n, p, number, None, None, None))
        return answered(rows, stats_of(total[seen]), keep)

    return answer


def rows_of(table: pa.Table) -> list[tuple]:
    return list(zip(*[table.column(c).to_pylist() for c in FIELDS[1:]], strict=True))


def log_probabilities(pack: Pack, grams: list[Grams], discounts: list[Discounts]) -> np.ndarray:
    """log10 of each token's probability."""
    out = np.log10(discounts[0].unigram(pack.c1[pack.tokens]))
    below = np.ones(len(out))  # scale of each token's context at the order below
    for x, d in zip(grams, discounts[1:], strict=True):
        count = np.maximum(1, x.count)
        left = np.where(x.known, x.few @ d.freed / count, 1.0)
        given = np.where(left < 1e-9, 1 / (count + 1), left)
        scale = np.where(left < 1e-9, 1 - given, 1.0)
        at = np.flatnonzero(x.gram >= 0)
        of, gram = x.context[at], x.gram[at]
        seen = x.total[gram] > 0
        low = x.mass[of] if x.n == 2 else below[at] * x.mass[of] / np.maximum(1, x.lower[at])
        open_ = np.log10(given[of]) - np.log10(np.maximum(1e-300, 1 - low)) + out[at]
        with np.errstate(divide="ignore"):
            own = np.log10(scale[of] * d.mass(x.total[gram]) / count[of])
        out[at] = np.where(seen, own, open_)
        below = np.ones(len(out))
        below[at] = scale[of]
    return out


class Katz:
    """The model of the documents' training rows, and every row's score."""

    def __init__(
        self, docs: DataFrame, learn: Column, order: int = ORDER, doc_id: str = "doc_id", text: str = "text", size: int | None = None, keep: bool = True
    ):
        """size: tokens of a pack and grams of a part, where it shouldn't follow from the corpus. keep: the model's tables
        too; without them the packs are answered, and so scored, just the same."""
        thin = docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"),
            F.coalesce(learn, F.lit(False)).alias("train")
        )
        self.spark, self.order, self.keep = docs.sparkSession, order, keep
        small_batches(self.spark)
        guess = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) / 4  # of packs, whose exact size says nothing
        self.packs = write_table(pack_documents(thin, size or size_for(guess)), "packs")
        tokens = self.packs.agg(F.sum("tokens")).first()[0] or 0
        size = size or size_for(tokens)
        self.parts = max(2 * partitions(self.spark), tokens // size)
        self.spread = max(1, size // 8)
        #: The model's tables by order (rows of MODEL: a part's names and counts), and the answers to the packs.
        self.tables: list[DataFrame] = []
        self.discounts: list[Discounts] = []
        self._count(1)
        self._tell_words()
        for n in range(2, order + 1):
            self._count(n)

    def _own(self) -> DataFrame:
        """The packs themselves, as messages with their ids."""
        none = F.lit(None)
        return self.packs.select(
            "pack", F.lit(PACK).alias("kind"), F.lit(0).alias("part"), none.cast("long").alias("number"), "a", "b",
            none.cast("array<double>").alias("sums"), "ids"
        )

    def _tell_words(self) -> None:
        """Packs with the numbers of their words, for their hashes and the answers of order 1."""
        parts, spread = self.parts, self.spread

        def tell(key: tuple, table: pa.Table) -> pa.Table:
            a, b = Pack(rows_of(table), parts, spread).with_words()
            ids = pa.concat_arrays(table.column("ids").chunks).flatten()
            values = [pa.array([key[0].as_py()]), pa.array([a], pa.binary()), pa.array([b], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)]
            return pa.table(values, ["pack", "a", "b", "ids"])

        both = self._own().unionByName(self._answers(1, False), allowMissingColumns=True)
        kind = self.packs.schema["ids"].dataType.simpleString()
        told = write_table(both.groupBy("pack").applyInArrow(tell, f"pack long, a binary, b binary, ids {kind}"), "packs")
        drop_table(self.packs)
        if not self.keep:
            drop_table(self.tables[0])
        self.packs = told

    def _answers(self, n: int, sums: bool) -> DataFrame:
        """What the packs have been told of order n; counts and numbers only, or with the sums of contexts."""
        rows = self.tables[n - 1].select(*FIELDS)
        told = rows.filter((F.col("pack") >= 0) & (F.col("kind") == n))
        if n == 1 or not sums:
            return told.withColumn("b", F.lit(None).cast("binary"))
        totals = rows.filter(F.col("pack") == SUMS).groupBy("part", "number").agg(
            F.array(*[F.sum(F.col("sums")[k]) for k in range(MOST_DISCOUNTED + 1)]).alias("sums")
        )
        wanted = rows.filter((F.col("pack") >= 0) & (F.col("kind") == -n)).drop("sums").distinct()
        return told.unionByName(wanted.join(totals, ["part", "number"]).select(*FIELDS))

    def _messages(self, n: int, sums: bool) -> DataFrame:
        """The packs, and what they have been told of the orders from 2 to below n."""
        out = self._own()
        for k in range(2, n):
            out = out.unionByName(self._answers(k, sums), allowMissingColumns=True)
        return out

    def _count(self, n: int) -> None:
        parts, spread, keep = self.parts, self.spread, self.keep

        def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in batches:
                for pack, a, b, vocab in zip(*[x.column(c).to_pylist() for c in ("pack", "a", "b", "vocab")], strict=True):
                    yield Pack([(PACK, 0, None, a, b, None)], parts, spread).asked(pack, unpack_keys(vocab))

        def ask_grams(key: tuple, table: pa.Table) -> pa.Table:
            return pa.Table.from_batches([Pack(rows_of(table), parts, spread).grams(n)[-1].asked(key[0].as_py())])

        if n == 1:
            asked, answer = self.packs.select("pack", "a", "b", "vocab").mapInArrow(ask_words, MESSAGE), answer_words(keep)
        else:
            asked = self._messages(n, False).drop("ids").groupBy("pack").applyInArrow(ask_grams, MESSAGE)
            answer = answer_grams(n, self.discounts[-1], parts, n == self.order, keep)
        table = write_table(asked.groupBy("part").applyInArrow(answer, MESSAGE + ", stats array<long>"), f"katz-{n}")
        self.tables.append(table)
        got = table.filter("stats IS NOT NULL").agg(*[F.sum(F.col("stats")[k]) for k in range(MOST_DISCOUNTED + 3)]).first()
        self.discounts.append(Discounts([int(x or 0) for x in got]))

    def scores(self) -> DataFrame:
        """doc_id, trained, n_tokens, n_known, train_tokens, base_score and score of every row."""
        parts, spread, order, discounts = self.parts, self.spread, self.order, self.discounts
        one, kind = discounts[0], self.packs.schema["ids"].dataType.simpleString()

        def finish(key: tuple, table: pa.Table) -> pa.Table:
            x = Pack(rows_of(table), parts, spread)
            grams = x.grams(order)
            for g, below in zip(grams[1:], grams, strict=False):
                g.lower = np.r_[below.count, 1][below.context]  # c(h') at each token
            known = x.c1[x.tokens]
            total = lambda v: np.bincount(x.doc, v, minlength=x.n)
            base = total(np.log10((known + 1) / (one.total + one.kinds + 1)))
            score = total(log_probabilities(x, grams, discounts))
            ids = pa.concat_arrays(table.column("ids").chunks).flatten()
            values = [
                ids, pa.array(x.train), pa.array(total(None).astype(np.int64)), pa.array(total(known > 0).astype(np.int64)),
                pa.array(base), pa.array(score)
            ]
            return pa.table(values, ["doc_id", "trained", "n_tokens", "n_known", "base_score", "score"])

        done = self._messages(order + 1, True).groupBy("pack").applyInArrow(
            finish, f"doc_id {kind[6:-1]}, trained boolean, n_tokens long, n_known long, base_score double, score double"
        )
        return done.withColumn("train_tokens", F.lit(one.total).cast("long")).select(
            "doc_id", "trained", "n_tokens", "n_known", "train_tokens", "base_score", "score"
        )

    def drop(self) -> None:
        for t in (self.packs, *self.tables):
            drop_table(t)


def op4(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = fold(F.col("doc_id"), 7) == 2
    return Katz(docs, ~held, keep=False).scores().select(
        "doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
