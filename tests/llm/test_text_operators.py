"""The text operators against brute force, on small fixtures with nulls, ties, repeats and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache
from itertools import combinations

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from almoner.llm import common, decontaminate, katz, language, line_templates, mixing, near, queries, repetition, sharding, toxicity, url_filter
from almoner.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")
lower = lambda s: s.translate({c: c + 32 for c in range(65, 91)})


def docs_of(spark, rows, schema="doc_id long, text string, source string"):
    return spark.createDataFrame(rows, schema)


def some_docs(seed=3, n=120):
    r = random.Random(seed)
    words = ["the", "of", "Ab", "cd", "é", "x1"] + [f"w{k}" for k in range(60)]
    out = []
    for k in range(n):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "\n", "\t "]) for _ in range(r.randint(0, 90)))
        out.append((k, text, r.choice(["a", "b", "é", None])))
    for k in range(n, n + 30):
        base = out[r.randrange(n)][1].split(" ")
        if len(base) > 3:
            base[r.randrange(len(base))] = "edited"
        out.append((k, " ".join(base), "b"))
    return out + [(n + 40, None, "a"), (n + 41, "", None), (n + 42, " \n", "a"), (n + 43, out[5][1], "a"), out[7]]


# quality rules


def brute_repetition(text, m=8):
    w = WORD.findall(text or "")
    windows = Counter(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    covered = {j for i in range(len(w) - m + 1) if windows[tuple(w[i : i + m])] > 1 for j in range(i, i + m)}
    longest = 0
    for size in range(m, len(w)):
        if max(Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1)).values()) < 2:
            break
        longest = size
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")), "n_dup_lines": dup,
        "n_repeat_words": len(covered), "repeat_chars": sum(len(w[i]) for i in covered), "longest_repeat": longest,
    }


def test_repetition_matches_brute_force():
    r = random.Random(1)
    texts = ["", " ", "a", "a " * 70, "\n\na b\n a b\na b", "é#*  x y\x85z\x1c"]
    texts += ["".join(r.choice(["a", "b", "cc", "dé"]) + r.choice([" ", "\n", " \t"]) for _ in range(r.randint(0, 90))) for _ in range(150)]
    for text, got in zip(texts, repetition.measure(pa.array(texts), 8).to_pylist(), strict=True):
        spans = got.pop("repeat_spans")
        assert got == brute_repetition(text)
        assert sum(s["end"] - s["start"] for s in spans) == got["n_repeat_words"]


def test_repetition_verdict(spark):
    clean = " ".join(f"word{k}" for k in range(60))
    rows = [
        (1, clean, "a"), (2, "short text", "a"), (3, "again and " * 40, "a"), (4, None, "a"),
        (5, clean + " " + " ".join(f"z{k}" for k in range(800)) + " " + clean, "a")
    ]
    got = {r.doc_id: r.repetition for r in repetition.judged(docs_of(spark, rows).withColumn("repetition", F.lit(1))).collect()}
    assert {k: v.kept for k, v in got.items()} == {1: True, 2: False, 3: False, 4: False, 5: True}
    assert got[5].longest_repeat == 60 and not got[5].base_failed
    assert repetition.judged(docs_of(spark, [])).count() == 0


# address filter


def test_cascade_is_exact(spark):
    keys = spark.range(3000).select(F.concat(F.lit("h"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    c = url_filter.Cascade(keys, bits_per_key=3)
    assert c.fits and len(c.levels) > 2
    assert keys.filter(c.member(F.col("key")) != F.col("listed")).count() == 0
    assert not url_filter.Cascade(keys, most_bytes=1).fits


def test_urls(spark):
    urls = {
        "http://A.com/x?y": ("a.com", "/x", "com/", "allow"),
        "https://www.example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://m.example.com/en/1#t": ("m.example.com", "/en/1", "example.com/en/", "block"),
        "http://a.net/fr/": ("a.net", "/fr/", "net/fr/", "block"),
        "http://x.spam-farm.example.org": ("x.spam-farm.example.org", "", None, "block"),
        "http://notspam-farm.example.org/": ("notspam-farm.example.org", "/", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://" + "a." * 20_000 + "cheap-pills.example.net/x": ("a." * 20_000 + "cheap-pills.example.net", "/x", None, "block"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    listed = spark.createDataFrame([(d,) for d in url_filter.LISTED], "domain string")
    for how in ({}, {"most_bytes": 0}):
        got = {r.url: r.url_filter for r in url_filter.filter_urls(pages, listed, **how).collect()}
        assert {u: (f.host, f.path, f.rule, "allow" if f.allowed else "block") for u, f in got.items()} == urls
    assert url_filter.filter_urls(pages.limit(0), listed).count() == 0
    assert url_filter.filter_urls(pages, listed.limit(0)).filter("url_filter.listed").count() == 0


# language


def test_kneser_ney_sums_to_one():
    words, counts = ["abba", "ab", "cab", "ba"], np.array([3.0, 5, 2, 1])
    grams, contexts, floor = language.kneser_ney(words, counts, 3)
    m = language.Models(["x"], 3, [(h, v[:, None]) for h, v in grams], [(h, v[:, None]) for h, v in contexts], np.array([floor]))
    for start in ("", "a", "ab", "abb", "c"):
        # probabilities of every next symbol after `start`, by differences of whole-run scores
        symbols = ["a", "b", "c", chr(language.END)]
        logs = []
        for s in symbols:
            codes = np.array([language.BEGIN, *map(ord, start), ord(s)], np.uint64)
            logs.append(_next(m, codes))
        unseen = _next(m, np.array([language.BEGIN, *map(ord, start), ord("z")], np.uint64))
        assert math.isclose(sum(map(math.exp, [*logs, unseen])), 1, abs_tol=1e-9)


def _next(m, codes):
    h, at, weight = language.gram_hashes(codes, m.order), len(codes) - 1, 0.0
    for n in range(min(m.order, len(codes)), 0, -1):
        row = language._find(m.grams[n - 1][0], h[n - 1][at : at + 1])[0]
        if row >= 0:
            return weight + m.grams[n - 1][1][row, 0]
        row = 0 if n == 1 else language._find(m.contexts[n - 1][0], h[n - 2][at - 1 : at])[0]
        weight += m.contexts[n - 1][1][row, 0] if row >= 0 else 0
    return weight + m.floor[0]


def test_language_held_out(spark, data):
    rows = language.op3(spark, data).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.9


def test_language_edges(spark):
    docs = spark.createDataFrame(
        [(1, None, "en"), (2, "12 34 !", "en"), (3, "the then", "en"), (4, "der und", "de"), (5, "", None)],
        "doc_id long, text string, lang string"
    )
    models = language.fit(docs, F.lit(True), docs_per_language=10**9)
    got = {r.doc_id: r.language for r in language.identify(docs, models).collect()}
    assert [got[k].lang_pred for k in (1, 2, 5)] == ["und"] * 3 and got[1].score == 0
    none = language.fit(docs.limit(0), F.lit(True))
    assert {r.language.lang_pred for r in language.identify(docs, none).collect()} == {"und"}


def brute_kneser_ney(words, order):
    """The log probability of each symbol of a run, from {run: occurrences}."""
    begin, end = chr(language.BEGIN), chr(language.END)
    raw = [Counter() for _ in range(order + 1)]
    for w, k in words.items():
        s = begin + w + end
        for n in range(1, order + 1):
            for i in range(max(1, n - 1), len(s)):
                raw[n][s[i - n + 1 : i + 1]] += k
    adjusted = [None] * (order + 1)
    for n in range(1, order + 1):
        longer = Counter(g[1:] for g in raw[n + 1]) if n < order else None
        adjusted[n] = {g: raw[n][g] if n == order or g[0] == begin else longer[g] for g in raw[n]}
    cut = [0.0]
    for n in range(1, order + 1):
        ones, twos = (sum(v == k for v in adjusted[n].values()) for k in (1, 2))
        cut.append(ones / (ones + 2 * twos) if ones and twos else 0.5)
    after = [defaultdict(dict) for _ in range(order + 1)]
    for n in range(1, order + 1):
        for g, v in adjusted[n].items():
            after[n][g[:-1]][g[-1]] = v
    symbols = {c for w in words for c in w + end}

    def p(h, c):
        if h is None:
            return 1 / (len(symbols) + 1)
        n = len(h) + 1
        lower_p = p(h[1:] if h else None, c)
        seen = after[n].get(h)
        if not seen:
            return lower_p
        total = sum(seen.values())
        return max(seen.get(c, 0) - cut[n], 0) / total + cut[n] * len(seen) / total * lower_p

    return lambda s: [math.log(p(s[max(0, i - order + 1) : i], s[i])) for i in range(1, len(s))]


@pytest.mark.parametrize("order", [1, 2, 4])
def test_kneser_ney_matches_brute_force(order):
    r = random.Random(6)
    learned = {
        lang: Counter("".join(r.choice(letters) for _ in range(r.randint(1, 6))) for _ in range(300)) for lang,
        letters in (("x", "abcdé"), ("y", "bcdef"))
    }
    models = language.build(pd.DataFrame([(lang, w, n) for lang, c in learned.items() for w, n in c.items()], columns=["lang", "word", "n"]), order)
    texts = ["abc dé fed", "ABBA b2b", "zzz aéz", "", "12", "c " * 9]
    got, sizes = models.entropies(pa.array(texts))
    for k, text in enumerate(texts):
        runs = re.findall(r"[^\W\d_]+", text.lower())
        assert sizes[k] == sum(len(w) + 1 for w in runs)
        for j, lang in enumerate(models.languages):
            logs = [x for w in runs for x in brute_kneser_ney(learned[lang], order)(chr(language.BEGIN) + w + chr(language.END))]
            assert got[k, j] == pytest.approx(-sum(logs) / max(1, len(logs)))


# language-model scores


def brute_katz(rows, train, order):
    docs = {k: [*WORD.findall(lower(t or "")), "</s>"] for k, t in rows}
    uni, grams = Counter(), [Counter() for _ in range(order + 1)]  # by order: (context, word)
    for k in train:
        uni.update(docs[k])
        t = ["<s>", *docs[k]]
        for n in range(2, order + 1):
            grams[n].update((tuple(t[i - n + 1 : i]), t[i]) for i in range(n - 1, len(t)))
    n = sum(uni.values())

    def discounts(counts):
        cc, k = Counter(counts.values()), katz.MOST_DISCOUNTED
        d = {}
        if cc[1] and (x := (k + 1) * cc[k + 1] / cc[1]) < 1:
            d = {r: ((r + 1) * cc[r + 1] / cc[r] / r - x) / (1 - x) if cc[r] else -1 for r in range(1, k + 1)}
        if not d or not all(0 < v < 1 for v in d.values()):
            cut = cc[1] / (cc[1] + 2 * cc[2]) if cc[1] and cc[2] else 0.5
            d = {r: 1 - cut / r for r in range(1, k + 1)}
        return d

    d1, d = discounts(uni), [discounts(g) for g in grams]
    spare = 1 - sum(d1.get(c, 1) * c for c in uni.values()) / n if n else 1
    unknown = spare if spare > 1e-12 else 1 / (n + 1)
    p1 = lambda w: (1 - unknown) / (1 - spare) * d1.get(uni[w], 1) * uni[w] / n if uni[w] else unknown
    after, context = defaultdict(dict), Counter()
    for g in grams:
        for (h, w), c in g.items():
            after[h][w] = c
            context[h] += c

    @cache
    def weights(h):
        """Of a seen context: scale and alpha."""
        dn = d[len(h) + 1]
        spent = sum(dn.get(c, 1) * c / context[h] for c in after[h].values())
        left = 1 - spent if 1 - spent >= 1e-9 else 1 / (context[h] + 1)
        return (1 - left) / spent, left / (1 - sum(p(h[1:], w) for w in after[h]))

    def p(h, w):
        if not h:
            return p1(w)
        if not context[h]:
            return p(h[1:], w)
        if w in after[h]:
            return weights(h)[0] * d[len(h) + 1].get(after[h][w], 1) * after[h][w] / context[h]
        return weights(h)[1] * p(h[1:], w)

    out = {}
    for k, tokens in docs.items():
        base = sum(math.log10((uni[w] + 1) / (n + len(uni) + 1)) for w in tokens)
        t = ["<s>", *tokens]
        score = sum(math.log10(p(tuple(t[max(0, i - order + 1) : i]), t[i])) for i in range(1, len(t)))
        out[k] = len(tokens), sum(uni[w] > 0 for w in tokens), n, base, score
    for size in range(1, order):  # exactly normalised
        for h in [h for h in context if len(h) == size][:20]:
            assert math.isclose(sum(p(h, w) for w in uni) + p(h, "never seen"), 1, rel_tol=1e-9)
    return out


@pytest.mark.parametrize("order, size", [(3, 40), (2, None), (4, 100)])
def test_katz_matches_brute_force(spark, order, size):
    rows = [(k, t) for k, t, _ in some_docs()[:-1]]
    train = {k for k, _ in rows if zlib.crc32(str(k).encode()) % 7 != 2}
    model = katz.Katz(
        docs_of(spark, rows, "doc_id long, text string"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2,
        order=order, size=size
    )
    want = brute_katz(rows, train, order)
    got = {r.doc_id: r for r in model.scores().collect()}
    assert got.keys() == want.keys()
    for k, r in got.items():
        assert (r.n_tokens, r.n_known, r.train_tokens, r.trained) == (*want[k][:3], k in train)
        assert r.base_score == pytest.approx(want[k][3]) and r.score == pytest.approx(want[k][4])
    assert all(t.filter(F.col("pack") == katz.MODEL).count() > 0 for t in model.tables)


def test_katz_edges(spark):
    docs = docs_of(spark, [(1, "a b", "x"), (1, "a b", "x"), (2, None, None)])
    assert [r.score for r in katz.Katz(docs, F.lit(False)).scores().collect()] == [0, 0, 0]
    assert katz.Katz(docs, F.lit(True)).scores().count() == 3
    assert katz.Katz(docs.limit(0), F.lit(True)).scores().count() == 0


def test_katz_query_backs_off_from_trigrams(spark, tmp_path):
    rows = [(k, t) for k, t, _ in some_docs()[:-1]]
    docs_of(spark, rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    train = {k for k, _ in rows if zlib.crc32(str(k).encode()) % 7 != 2}
    want = brute_katz(rows, train, 3)
    got = {r.doc_id: r for r in katz.op4(spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys()
    for k, r in got.items():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (k not in train, *want[k][:3])
        assert r.base_score == pytest.approx(want[k][3]) and r.score == pytest.approx(want[k][4])


# sharding


def test_shards(spark):
    rows = [*some_docs(), (None, "no id", "a"), (None, None, None)]
    got = sharding.contract(docs_of(spark, rows)).collect()
    sizes = sorted(len((t or "").encode()) + 1 for _, t, _ in rows)
    assert sorted(r["size"] for r in got) == sizes and len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert set(by) == set(range(8))
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    total = {s: sum(r["size"] for r in rs) for s, rs in by.items()}
    assert max(total.values()) - min(total.values()) <= 2 * max(sizes)
    order = [r.doc_id for s in range(8) for r in sorted(by[s], key=lambda r: r.slot)]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    texts = {k: t for k, t, _ in rows if k is not None}
    assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in got if r.doc_id is not None)
    assert sharding.contract(docs_of(spark, [])).count() == 0


# decontamination


def brute_benchmark(text, items):
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    w = pattern.findall(lower(text or ""))
    hit, names = set(), set()
    for name, body in items:
        v = pattern.findall(lower(body or ""))
        n = min(8, len(v))
        for i in range(len(v) - n + 1) if n else ():
            for k in range(len(w) - n + 1):
                if w[k : k + n] == v[i : i + n]:
                    hit |= set(range(k, k + n))
                    names.add(str(name))
    return len(w), hit, sorted(names)


@pytest.mark.parametrize("block", [5, 10**6])
def test_decontamination_matches_brute_force(spark, block):
    r = random.Random(5)
    docs = some_docs(9)
    items = [
        (k, " ".join(re.findall(r"\w+", docs[r.randrange(100)][1])[:r.choice([3, 8, 12])])) for k in range(25)
    ] + [(90, ""), (91, None), (3, "the; of"), (92, docs[4][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_benchmark(docs_of(spark, docs).withColumn("benchmark", F.lit(0)), bench, block_words=block)
    got = found.collect()
    for x in got:
        n, hit, names = brute_benchmark(x.text, items)
        assert (x.benchmark.n_words, x.benchmark.n_hit, x.benchmark["items"]) == (n, len(hit), names)
        assert {j for s in x.benchmark.spans for j in range(s.start, s.end)} == hit
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    before = {(x.doc_id, x.text): {j for s in x.benchmark.spans for j in range(s.start, s.end)} for x in got}
    after = decontaminate.remove_spans(found.withColumn("old", F.col("text"))).collect()
    for x in after:
        rest = [w for j, w in enumerate(pattern.findall(lower(x.old or ""))) if j not in before[x.doc_id, x.old]]
        assert [w for w in pattern.findall(lower(x.text or ""))] == rest
    none = decontaminate.find_benchmark(docs_of(spark, docs), bench.limit(0))
    assert none.filter("benchmark.n_hit > 0").count() == 0


# mixing


def test_mixing(spark):
    rows = some_docs(11, 400)
    got = mixing.mix(docs_of(spark, rows)).collect()
    again = mixing.mix(docs_of(spark, rows[::-1]).repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    size = Counter()
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(size.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * size[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2 * size[s]
            left -= target[s]
        free -= over
    taken, largest = Counter(), max(len(WORD.findall(t or "")) for _, t, _ in rows)
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r["size"]
    assert all(abs(taken[s] - target[s]) <= largest for s in names)
    assert mixing.mix(docs_of(spark, [])).count() == 0
    assert {r.copies for r in mixing.mix(docs_of(spark, [(1, None, "a"), (2, "", None)])).collect()} == {0}


# n-gram Jaccard join


def brute_near(rows):
    sets = defaultdict(list)
    for k, t in rows:
        w = WORD.findall(lower(t or ""))
        sets[k].append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sets, 2):
        if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {k: ({len(s) for s in sets[k]}, find(k)) for k in sets}


def near_cases(seed):
    r = random.Random(seed)
    vocab = [f"v{k}" for k in range(40)]
    rows, k = [], 0
    passage = [f"p{j}" for j in range(60)]
    for _ in range(12):
        base = [r.choice(vocab) for _ in range(r.choice([1, 3, 6, 8, 9, 12, 30, 120, 200]))]
        for _ in range(r.randint(1, 9)):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                j = r.randrange(len(t) or 1)
                t[j : j + 1] = r.choice([[], [r.choice(vocab)], [*t[j : j + 1], "Extra"]])
            if r.random() < 0.2:
                t = t + passage
            rows.append((k, " ".join(t)))
            k += r.randint(1, 3)
    return rows + [(k + 1, None), (k + 2, ""), (k + 3, " "), (k + 4, rows[0][1].upper()), rows[1]]


@pytest.mark.parametrize("seed, light", [(1, 10), (2, 0)])
def test_near_matches_brute_force(spark, monkeypatch, seed, light):
    monkeypatch.setattr(near, "boundary_by_cost", lambda *a: light)
    monkeypatch.setattr(near, "LONG_LIST", 3)
    monkeypatch.setattr(near, "LIST", 3 * seed)
    monkeypatch.setattr(near, "BLOCK", 4)
    rows = near_cases(seed)
    got = near.near_components(docs_of(spark, [(*x, "s") for x in rows]), rounds=seed - 1).collect()
    want = brute_near(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles in want[r.doc_id][0] and r.component_id == want[r.doc_id][1], r


def test_near_edges(spark):
    assert near.near_components(docs_of(spark, [])).count() == 0
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(None, text, "a"), (4, text, "a"), (2, "x", "a"), (2, text, "a"), (9, "x", "a"), (None, "alone here", "a")]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in near.near_components(docs_of(spark, rows)).collect()}
    assert got == {(None, 26, 2), (4, 26, 2), (2, 1, 2), (2, 26, 2), (9, 1, 2), (None, 1, None)}


def test_boundary_grows_with_lists():
    assert near.boundary_by_cost(0, 80) <= near.boundary_by_cost(50, 80)
    for s in range(1, 40):
        for t in near.partners(s, 80):
            i = near.overlap(s, t, 80)
            assert 100 * i >= 80 * (s + t - i) and not 100 * (i - 1) >= 80 * (s + t - i + 1)


@pytest.mark.parametrize("in_one_task", [0, 10**6])
def test_components(spark, monkeypatch, in_one_task):
    monkeypatch.setattr("almoner.llm.components.ONE_TASK_LINKS", in_one_task)
    r = random.Random(2)
    edges = [(k, k + 1) for k in range(50, 90)] + [(7, 7 + r.randint(1, 40)) for _ in range(20)] + [(1, 2), (2, 1), (3, 3)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for u, v in edges:
        u, v = sorted((find(u), find(v)))
        root[v] = u
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: find(k) for k in root if k != 3}


# toxicity


def test_nnpu_learns(spark):
    r = random.Random(4)
    rows, labels = [], []
    for k in range(1500):
        toxic = r.random() < 0.15
        words = [f"w{r.randrange(300)}" for _ in range(40)] + (["idiot"] if toxic else [])
        r.shuffle(words)
        rows.append((k, " ".join(words), "s"))
        if r.random() < 0.6:
            labels.append((k, int(toxic)))
    rows += [(5000, None, "s"), (5001, "", "s"), (5002, "an Idiot!", "s")]
    docs = docs_of(spark, rows).withColumn("toxicity", F.lit("old"))
    model = toxicity.fit(docs, spark.createDataFrame([*labels, (9999, 1), (None, 1), (3, None)], "doc_id long, toxic int"), F.lit(True))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    for k, x in got.items():
        assert 0 <= x.toxicity <= 1 and (x.toxicity >= 0.3) == ("idiot" in lower(x.text or "")), x
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    assert len({r.toxicity for r in toxicity.score(docs, none).collect()}) == 1


def test_nnpu_risk_and_gradient():
    r = np.random.default_rng(3)
    p, u = (r.random((30, 6)) < 0.9).astype(float), (r.random((80, 6)) < 0.3).astype(float)
    turned = 0
    for k in range(40):
        w, prior = r.normal(1, 2, 6), (0.2, 0.9)[k % 2]
        loss = lambda f: np.log1p(np.exp(f))
        first = lambda w: prior * np.mean([loss(-x @ w) for x in p])
        second = lambda w: np.mean([loss(x @ w) for x in u]) - prior * np.mean([loss(x @ w) for x in p])
        assert toxicity.risk(w, p, u, prior) == pytest.approx((first(w), second(w)))
        goal = (lambda w: -second(w)) if second(w) < 0 else (lambda w: first(w) + second(w))
        turned += second(w) < 0
        plain = [(goal(w + d) - goal(w - d)) / 2e-6 for d in np.eye(6) * 1e-6]
        assert toxicity.gradient(w, p, u, prior) == pytest.approx(plain, abs=1e-6)
    assert 0 < turned < 40


# line templates


def brute_lines(rows, min_docs):
    parsed, docs_of_mask, leaf_masks, docs_of_leaf = {}, defaultdict(set), defaultdict(set), defaultdict(set)
    for key in {(k, t) for k, t, _ in rows if t is not None}:
        for at, line in enumerate(key[1].split("\n")):
            t = ["<*>" if re.search("[0-9]", w) else w for w in WORD.findall(line)]
            if len(t) >= line_templates.MIN_TOKENS:
                leaf = (len(t), *t[: line_templates.DEPTH])
                parsed[key, at] = leaf, tuple(t)
                docs_of_mask[leaf, tuple(t)].add(key)
                leaf_masks[leaf].add(tuple(t))
                docs_of_leaf[leaf].add(key)
    whole = set()
    for leaf, masks in leaf_masks.items():
        if len(masks) > 1 and sum(len(docs_of_mask[leaf, m]) for m in masks) >= min_docs:
            if np.mean([len(set(x)) == 1 for x in zip(*masks)]) >= line_templates.ALIKE:
                whole.add(leaf)
    drop = defaultdict(set)
    for (key, at), (leaf, m) in parsed.items():
        if len(docs_of_leaf[leaf]) >= min_docs if leaf in whole else len(docs_of_mask[leaf, m]) >= min_docs:
            drop[key].add(at)
    return drop


def test_line_templates_match_brute_force(spark):
    r = random.Random(8)
    rows = []
    for k in range(60):
        lines = [" ".join(r.choice(["a", "b", "c", "d"]) for _ in range(r.randint(0, 5))) for _ in range(6)]
        lines.append(r.choice(["Posted by user %d at 10:%d", "Copyright %d someone, all of the rights reserved %d"]) % (k, r.randrange(60)))
        lines.append(f"All these words stay constant except {r.choice(['red', 'green', 'blue'])} here")
        rows.append((k, "\n".join(lines), "s"))
    rows += [(70, None, "s"), (71, "", "s"), rows[3], (None, "Posted by user 9 at 9:9", "s")]
    drop = brute_lines(rows, 5)
    got = line_templates.drop_templates(docs_of(spark, rows).withColumn("lines", F.lit(1)), min_docs=5).collect()
    assert len(got) == len(rows)
    texts = {k: t for k, t, _ in rows}
    for x in got:
        gone = drop[x.doc_id, texts[x.doc_id]] if texts[x.doc_id] is not None else set()
        assert set(x.lines.dropped) == gone
        want = texts[x.doc_id] if not gone else "\n".join(v for j, v in enumerate(texts[x.doc_id].split("\n")) if j not in gone)
        assert x.text == want
    assert line_templates.drop_templates(docs_of(spark, [])).count() == 0


def test_short_lines_are_counted(spark):
    rows = [(k, f"Les.\nAnd ornd.\nonly {'abcdefghijkl'[k]}\n", "s") for k in range(12)]
    got = line_templates.drop_templates(docs_of(spark, rows)).collect()
    assert len(got) == 12 and all(list(x.lines.dropped) == [0, 1] for x in got)


def brute_alike(rows, min_docs):
    """Lines of which so many documents hold one in the same leaf that agrees at enough positions."""
    parsed, leaves = {}, defaultdict(list)
    for key in {(k, t) for k, t, _ in rows if t is not None}:
        for at, line in enumerate(key[1].split("\n")):
            t = ["<*>" if re.search("[0-9]", w) else w for w in WORD.findall(line)]
            if t:
                parsed[key, at] = t
                leaves[(len(t), *t[: line_templates.DEPTH])].append((key, t))
    drop = defaultdict(set)
    for (key, at), t in parsed.items():
        alike = {
            k for k,
            u in leaves[(len(t), *t[: line_templates.DEPTH])] if t == u or (rest := t[line_templates.DEPTH :]) and sum(
                x == y for x, y in zip(rest, u[line_templates.DEPTH :])
            ) >= round(line_templates.ALIKE * len(rest), 6)
        }
        if len(alike) >= min_docs:
            drop[key].add(at)
    return drop


def test_several_templates_in_a_leaf(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(3))
    groups = [(["one", "two", "three"] + [word() for _ in range(r.choice([5, 9, 9, 9]))], r.choice([1, 2, 4])) for _ in range(12)]
    rows = []
    for k in range(150):
        lines = [" ".join(["one", "two", "three"] + [r.choice("xyz") for _ in range(9)])]
        for g, edits in r.sample(groups, 3):
            g = list(g)
            for _ in range(edits):
                g[r.randrange(3, len(g))] = word()
            lines.append(" ".join(g))
        rows.append((k, "\n".join(lines), "s"))
    for some in (rows[:70], rows):
        drop = brute_alike(some, 20)
        got = line_templates.drop_templates(docs_of(spark, some), min_docs=20).collect()
        assert all(set(x.lines.dropped) == drop[x.doc_id, some[x.doc_id][1]] for x in got)
        assert 0 < sum(map(len, drop.values())) < sum(t.count("\n") + 1 for _, t, _ in some)


def test_foreign_lines_undo_no_template(spark):
    rows = [(k, f"Read our notice about {'abcdefghijkl'[k]} and the law", "s") for k in range(12)]
    rows += [(k, f"Read our notice {k * 'q'}u {k * 'q'}v {k * 'q'}w {k * 'q'}x {k * 'q'}y", "s") for k in range(12, 40)]
    got = line_templates.drop_templates(docs_of(spark, rows)).collect()
    assert all(x.lines.n_dropped == (x.doc_id < 12) for x in got)


def test_lines_without_hope_are_not_paired(spark, monkeypatch):
    """Two groups of alike lines, too small and large enough, among many that share a common token at times."""
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    groups = [[word() for _ in range(12)] for _ in range(3)]
    rows = []
    for k in range(90):
        rest = list(groups[0 if k < 6 else 1 if k < 24 else 2]) if k < 42 else [r.choice(["common", word(), word(), word()]) for _ in range(12)]
        for j in r.sample(range(12), 2 if k < 42 else 0):
            rest[j] = word()
        rows.append((k, " ".join(["one", "two", "three", *rest]), "s"))
    seen, real = [], line_templates.paired

    def spy(open_masks, held, left):
        seen.append(left.count())
        return real(open_masks, held, left)

    monkeypatch.setattr(line_templates, "paired", spy)
    monkeypatch.setattr(line_templates, "ROUNDS", 1)
    drop = brute_alike(rows, 10)
    got = line_templates.drop_templates(docs_of(spark, rows)).collect()
    assert all(set(x.lines.dropped) == drop[x.doc_id, rows[x.doc_id][1]] for x in got)
    assert sum(map(len, drop.values())) == 36 and sum(seen) <= 40


def test_only_documents_of_open_lines_are_parsed_again(spark, monkeypatch):
    """Lines with digits and odd spaces in open leaves, held by few of many documents."""
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    rows = [(k, "\n".join(" ".join(word() for _ in range(r.randint(1, 9))) for _ in range(3)), "s") for k in range(400)]
    ends = ["the  law", "the\tlaw", "thé law", "the law", "no law"]
    rows += [(k, f"own {word()}\n  Read our notice {k} about {word()} and {r.choice(ends)} \r", "s") for k in range(400, 425)]
    rows += [(k, t, "s") for k, (_, t, _) in enumerate(rows[400:410] * 3, 500)]  # copies: read from one of them
    seen, real = [], line_templates.parsed

    def spy(docs, *args):
        seen.append(docs.count())
        return real(docs, *args)

    monkeypatch.setattr(line_templates, "parsed", spy)
    drop = brute_alike(rows, 10)
    got = line_templates.drop_templates(docs_of(spark, rows)).collect()
    texts = {k: t for k, t, _ in rows}
    assert len(got) == len(rows) and all(set(x.lines.dropped) == drop[x.doc_id, texts[x.doc_id]] for x in got)
    assert sum(map(len, drop.values())) >= 55 and seen[0] == len(rows) and len(seen) == 2 and seen[1] <= 40


def test_long_lines_go_from_the_third_document(spark):
    long, short = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(51)), "a short line of six words"
    rows = [(k, f"{long}\n{short}\n{long[1:] if k < 2 else 'own'}", "s") for k in range(3)]
    got = line_templates.drop_templates(docs_of(spark, rows)).collect()
    assert len(got) == 3 and all(list(x.lines.dropped) == [0] for x in got)


def test_leading_tokens_alone_are_no_template(spark):
    rows = [(k, f"See also our {'abcdefghijkl'[k]}\nSee also our {'abcdefghijkl'[k]} {'mnopqrstuvwx'[k]}", "s") for k in range(12)]
    got = line_templates.drop_templates(docs_of(spark, rows)).collect()
    assert len(got) == 12 and all(x.lines.n_dropped == 0 for x in got)


# against SQL


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_against_sql(spark, data, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    df = queries.QUERIES[name](spark, data)
    found = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(str(tuple(r[columns.index(c)] for c in df.columns)) for r in found.fetchall())
    assert sorted(str(tuple(r)) for r in df.collect()) == want


# very long texts: longer than a chunk and than an Arrow batch


def test_very_long_texts(spark):
    long = " ".join(f"w{k}" for k in range(700_000))
    assert len(long) > max(common.CHUNK_BYTES, common.BATCH_BYTES)
    passage = " ".join(f"bench{k}" for k in range(12))
    rows = [
        (1, long + " tail", "a"), (2, "short text here", "a"), (3, long.replace("w350000 ", "edited ") + " tail", "b"),
        (4, passage + " " + long + " " + passage, "b"), (5, None, "b")
    ]
    docs = docs_of(spark, rows).repartition(1).cache()
    by = lambda df: {r.doc_id: r for r in df.collect()}
    r = {k: x.repetition for k, x in by(repetition.judged(docs)).items()}
    assert [r[k].n_words for k in range(1, 6)] == [700_001, 3, 700_001, 700_024, 0] and (r[1].n_repeat_words, r[4].n_repeat_words) == (0, 24)
    b = {
        k: x.benchmark for k,
        x in by(decontaminate.find_benchmark(docs, spark.createDataFrame([(7, passage)], "item_id long, text string"))).items()
    }
    assert [b[k].n_hit for k in range(1, 6)] == [0, 0, 0, 24, 0] and [(s.start, s.end) for s in b[4].spans] == [(0, 12), (700_012, 700_024)]
    c = {k: x.component_id for k, x in by(near.near_components(docs)).items()}
    assert c == {1: 1, 2: 2, 3: 1, 4: 1, 5: 5}
    k = by(katz.Katz(docs, F.col("doc_id") != 3, order=2).scores())
    assert (k[1].n_tokens, k[3].n_known, k[5].n_tokens) == (700_002, 700_001, 1) and k[3].score < k[1].score < 0
    models = language.build(pd.DataFrame({"lang": ["x", "y"], "word": ["w", "short"], "n": [5, 5]}))
    assert by(language.identify(docs, models))[1].language.lang_pred == "x"
    model = toxicity.Classifier(np.array([], np.uint64), np.array([]), 0.0)
    assert {x.toxicity for x in toxicity.score(docs, model).collect()} == {0.5}
    t = by(line_templates.drop_templates(docs, min_docs=2, long_docs=2))
    assert [t[k].lines.n_dropped for k in range(1, 6)] == [1, 0, 1, 0, 0]
    assert by(sharding.byte_shards(docs))[1]["size"] == len(long) + 6
    assert sum(x["copies"] > 0 for x in mixing.mix(docs).collect()) > 0


# the pipeline


def without(text, hit):
    """text less its runs of hit words, from the first one's begin to the last one's end."""
    words = list(re.finditer("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text)))
    out, at, k = "", 0, 0
    while k < len(words):
        if k in hit:
            end = k
            while end + 1 in hit:
                end += 1
            out, at, k = out + text[at : words[k].start()], words[end].end(), end
        k += 1
    return out + text[at:]


def brute_mix(rows):
    """Copies of (doc_id, text, source)."""
    size = {k: len(WORD.findall(t or "")) for k, t, _ in rows}
    of = defaultdict(list)
    for k, _, s in rows:
        of[s].append(k)
    total = {s: sum(size[k] for k in ks) for s, ks in of.items()}
    names = sorted((s for s in of if s is not None), key=lambda s: s.encode()) + ([None] if None in of else [])
    weight, target, free, left = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, {}, set(names), 1.5 * sum(total.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        if not (over := {s for s in free if share[s] > 2 * total[s]}):
            target |= share
            break
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
        free -= over
    copies = {}
    for s, ks in of.items():
        q = target[s] / total[s] if total[s] else 0.0
        whole = math.floor(q)
        copies |= dict.fromkeys(ks, whole)
        if not (f := q - whole):
            continue
        u = {k: (int(hashlib.md5(str(k).encode()).hexdigest()[:13], 16) + 0.5) / 2**52 for k in ks}
        ranked = sorted(((u[k] / (1 - u[k])) / (f / (1 - f)), k) for k in ks)
        want, got, rest = target[s] - whole * total[s], 0, []
        start = 0
        for odds, k in ranked:
            start += size[k]
            if start <= want:
                copies[k] += 1
                got += size[k]
            else:
                rest.append((odds, k))
        gap = want - got
        if close := [(abs(size[k] - gap), odds, k) for odds, k in rest if abs(size[k] - gap) < gap]:
            copies[min(close)[2]] += 1
    return copies


def brute_shards(rows):
    """(doc_id, size, crc, shard, slot) of (doc_id, text)."""
    sized = sorted((k, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for k, t in rows)
    total, start, slots, out = sum(x[2] for x in sized), 0, Counter(), []
    for k, crc, n in sized:
        shard = min(7, (2 * start + n) * 8 // (2 * total))
        out.append((k, n, crc, shard, slots[shard]))
        slots[shard] += 1
        start += n
    return out


def test_pipeline_matches_brute_force(spark, data):
    pipeline = pytest.importorskip("corpus_pipeline")
    raw = spark.read.parquet(f"{data}/documents.parquet").collect()
    rows = [
        (x.doc_id, x.text, x.source) for x in raw if (b := brute_repetition(x.text)) and b["n_words"] >= 20 and 100 * b["n_repeat_words"] <= 30 * b["n_words"] and b["repeat_chars"] <= 0.3 * b["word_chars"] and b["longest_repeat"] <= 100
    ]
    groups = brute_near([x[:2] for x in rows])
    rows = [x for x in rows if groups[x[0]][1] == x[0]]
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    clean = []
    for k, t, s in rows:
        _, hit, names = brute_benchmark(t, items)
        if len(names) < 2:
            clean.append((k, without(t, hit), s))
    copies = brute_mix(clean)
    want = brute_shards([(k, t) for k, t, _ in clean for _ in range(copies[k])])
    assert len(want) > 50
    got = pipeline.run(spark, data).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_stages_on_odd_rows(spark, data):
    pipeline = pytest.importorskip("corpus_pipeline")
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in ("alpha", "beta"))
    rows = [
        (1, a, "s"), (1, b, "s"), (2, a + " x", "s"), (3, b + " y", "t"), (None, a, None), (None, None, None), (7, "", "t"),
        (9, a, "s"), (9, a, "s"), (42, "one two three", "t")
    ]
    odd = docs_of(spark, rows).select(
        "doc_id", "text", F.lit(None).cast("string").alias("lang"), "source", F.length("text").cast("long").alias("n_chars"),
        *[F.lit(c).alias(c) for c in ("quality", "benchmark", "_row", "row", "doc", "_key", "key", "copies", "size", "_copy")]
    )
    stages = dict(pipeline.STAGES)
    out = {}
    for name, stage in pipeline.STAGES[:-1]:
        df = stage(spark, odd, data)
        assert df.columns == odd.columns, name
        got = df.collect()
        assert all((r.quality, r.row, r.doc, r.copies, r["_row"]) == ("quality", "row", "doc", "copies", "_row") for r in got), name
        out[name] = sorted([(r.doc_id, r.text) for r in got], key=str)
        assert stage(spark, odd.limit(0), data).count() == 0, name
    show = lambda xs: sorted(xs, key=str)
    assert out["quality_rules"] == show([x[:2] for x in rows if x[1] and len(x[1]) > 20])
    # one of each group, by the smallest id: two unlike texts with one id are two documents
    assert out["ngram_jaccard_join"] == show([(1, a), (1, b), (None, None), (7, ""), (42, "one two three")])
    assert out["benchmark_decontamination"] == show([x[:2] for x in rows])
    assert all(x[1] for x in out["source_mixing"] if x[0] not in (None, 7)) and len(stages["sharding"](spark, odd, data).collect()) == len(rows)
