"""Line deduplication by a log-template tree. DataFrame functions only.

Lines (cut at \\n, trimmed) are parsed as in a fixed-depth log tree: fields that look variable (any token with a
digit) become <*>; a line then descends by its number of tokens and its first `depth` tokens to a leaf. Within a
leaf, two masked lines are alike if they agree on at least `alike` of the positions after those first tokens. Each masked line is a template
with the lines that are alike, whatever else is in its leaf, and is dropped if at least `min_docs` documents hold one
of them (`long_docs` for lines of more than 50 tokens; two are left to the near-duplicate join, as every copy of a
dropped line goes). More lines can only raise that count, so they never undo a template. `min_tokens` above 1 keeps shorter
lines.

Leaves, masked lines and documents go by 64-bit hashes, so lines are counted without dealing out their texts. Only
leaves in which rare lines could be alike to others are opened. Their masked lines are read from one document each: a
Bloom filter sieves the documents before they are parsed again, another the lines by their leaves. Lines near a
document-weighted centre of their leaf are settled together, in several rounds; lines whose tokens others hold
too seldom stay; only the rest are compared in pairs, by their rarest pairs of neighbouring tokens. Every group is summed before it is dealt out. Documents are named
by a hash of id and text, so repeated rows count once.

Texts and lines of any length are taken whole. Null texts have no lines and stay null. Empty lines are kept. Null ids are ids. Ties don't arise. An empty table
gives an empty one. Extra columns stay; one named as the result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.llm.common import write_table
from almoner.llm.url_filter import BITS_PER_KEY, MOST_BYTES, build, passes

DEPTH, ALIKE, MIN_DOCS, MIN_TOKENS = 3, 0.6, 10, 1
#: Lines of more tokens than the first are no accident: they go if the second number of documents holds them.
LONG_TOKENS, LONG_DOCS = 50, 3
#: How often lines are held against their leaf's centre before pairs are compared; more rounds change times, never results.
ROUNDS = 4
#: A token with a digit, tried only where a token begins and read without going back.
VARIABLE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
SPACE = r"[\x20\x09-\x0D]+"


def masked(line: Column) -> Column:
    """The line's tokens with <*> for those that have a digit, joined by single spaces; empty for an empty line."""
    odd = line.rlike(r"[0-9\t\x0B\f\r]") | line.contains("  ")  # most lines have neither digits nor other spaces
    return F.trim(F.when(odd, F.regexp_replace(F.regexp_replace(line, VARIABLE, "<*>"), SPACE, " ")).otherwise(line))


def count_of(text: Column, byte: str) -> Column:
    """How often an ASCII character stands in the text."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(byte), F.lit("")))


def parsed(docs: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    """docs: _doc, _text. Each line that is long enough: _doc, at, n (tokens), m (masked), leaf and mask (hashes)."""
    # worked out within the array: as columns, each use of them would work them out again

    def keyed(m: Column) -> Column:
        n = count_of(m, " ") + 1
        return F.struct(m.alias("m"), n.alias("n"), F.xxhash64(n, F.substring_index(m, " ", depth)).alias("leaf"), F.xxhash64(m).alias("mask"))

    lines = docs.select("_doc", F.posexplode(F.transform(F.transform(F.split("_text", "\n"), masked), keyed)).alias("at", "x"))
    return lines.filter((F.col("x.n") >= min_tokens) & (F.col("x.m") != "")).select("_doc", "at", "x.n", "x.m", "x.leaf", "x.mask")


def sieved(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """df less rows whose `column` is none of the keys (one column), but for a few; all of it if the filter would be too large."""
    bits = 64 * (1 + keys.count() * BITS_PER_KEY // 64)
    if bits > 8 * MOST_BYTES:
        return df
    words = write_table(build(keys.toDF("key"), 0, bits), "bloom")
    return df.filter(passes(F.col(column), words.scalar(), 0, bits))


def agreeing(a: Column, b: Column) -> Column:
    """At how many positions two arrays of one length agree."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))


def central(open_masks: DataFrame, held: DataFrame, left: DataFrame, every: bool) -> DataFrame:
    """Masks (leaf, mask) of `left` that the nearness to their leaf's centre shows to be alike to enough others.

    The centre has the token of most documents at each position (of all the leaf's masks, or of those left). With r
    positions, masks that agree with it at a and b of them agree with each other at a + b - r or more. So if enough
    documents hold a mask that agrees at b or more, all masks that agree at need + r - b are settled, and none of
    them is compared in pairs."""
    live = open_masks.join(left.select("leaf").distinct(), "leaf", "left_semi")
    own = live if every else live.join(left, ["leaf", "mask"], "left_semi")
    spots = own.select("leaf", "docs", F.posexplode("tok").alias("k", "token")).groupBy("leaf", "k", "token").agg(F.sum("docs").alias("f"))
    most = spots.groupBy("leaf", "k").agg(F.max_by("token", F.struct("f", "token")).alias("c"))
    centre = most.groupBy("leaf").agg(  # a line's tokens
        F.transform(F.sort_array(F.collect_list(F.struct("k", "c"))), lambda x: x["c"]).alias("centre")
    )
    near = live.join(write_table(centre, "centre"), "leaf")
    near = write_table(
        near.select("leaf", "mask", "least", (F.col("need") + F.size("tok")).alias("both"), agreeing(F.col("tok"), F.col("centre")).alias("a")),
        "near"
    )
    docs = held.join(near, ["leaf", "mask"]).groupBy("leaf", "least", "_doc").agg(F.max("a").alias("a"))
    levels = docs.groupBy("leaf", "least", "a").agg(F.count(F.lit(1)).alias("docs"))  # as many rows as a line has tokens
    levels = levels.withColumn("docs", F.sum("docs").over(Window.partitionBy("leaf").orderBy(F.col("a").desc())))
    least = levels.filter("docs >= least").groupBy("leaf").agg(F.max("a").alias("b"))
    return write_table(near.join(left, ["leaf", "mask"], "left_semi").join(least, "leaf").filter("a + b >= both").select("leaf", "mask"), "central")


def hopeful(open_masks: DataFrame, left: DataFrame) -> DataFrame:
    """Masks (leaf, mask) of `left` but those that no pair can settle.

    Summed over a mask's positions, the documents of other masks with the same token there count each document of an
    alike one `need` times or more; so where that sum is too small for the documents still wanted, they aren't there."""
    spot = F.posexplode("tok").alias("k", "token")
    live = open_masks.join(left.select("leaf").distinct(), "leaf", "left_semi")
    spots = live.select("leaf", "docs", spot).groupBy("leaf", "k", "token").agg(F.sum("docs").alias("f"))
    own = live.join(left, ["leaf", "mask"], "left_semi").select("leaf", "mask", "docs", "least", "need", spot)
    others = own.join(spots, ["leaf", "k", "token"]).groupBy("leaf", "mask", "docs", "least", "need").agg(F.sum(F.col("f") - F.col("docs")).alias("others"))
    return write_table(others.filter(F.col("others") >= F.col("need") * (F.col("least") - F.col("docs"))).select("leaf", "mask"), "hopeful")


def paired(open_masks: DataFrame, held: DataFrame, left: DataFrame) -> DataFrame:
    """Masks (leaf, mask) of `left` for which enough documents of the leaf hold one that is alike.

    Positions lie on a circle: of r positions, two masks that agree at t share at least 2t - r pairs of neighbours
    (more than none, as alike > 0.5), so a mask meets all that are alike by its r - (2t - r) + 1 rarest pairs."""

    def pairs(x: Column) -> Column:
        r = F.size(x)
        return F.transform(x, lambda v, k: F.xxhash64(F.col("leaf"), k, v, F.get(x, (k + 1) % r)))

    open_masks = open_masks.join(left.select("leaf").distinct(), "leaf", "left_semi")
    # written, as it is read three times: one row for each position of a mask
    keyed = write_table(open_masks.select("leaf", "mask", "docs", F.explode(pairs(F.col("tok"))).alias("key")), "keyed")
    weight = keyed.groupBy("key").agg(F.sum("docs").alias("w"))
    rare = keyed.join(open_masks.join(left, ["leaf", "mask"], "left_semi").select("leaf", "mask", "least", "need", F.size("tok").alias("r")), ["leaf", "mask"])
    own = rare.join(weight, "key").groupBy("leaf", "mask", "docs", "least", "need", "r").agg(  # a line's tokens
        F.sort_array(F.collect_list(F.struct((F.col("w") - F.col("docs")).alias("others"), "key"))).alias("x")
    )
    probes = own.withColumn("x", F.slice("x", F.lit(1), 2 * (F.col("r") - F.col("need")) + 1))
    enough = F.col("docs") + F.aggregate("x", F.lit(0).cast("long"), lambda a, y: a + y["others"]) >= F.col("least")
    probes = probes.filter(enough).select("leaf", "mask", F.explode(F.filter("x", lambda y: y["others"] > 0)["key"]).alias("key"))
    met = probes.join(keyed.select("key", F.col("mask").alias("other")), "key").filter("mask <> other").select("leaf", "mask", "other").distinct()
    others = open_masks.select("leaf", F.col("mask").alias("other"), F.col("tok").alias("other_tok"), F.col("docs").alias("other_docs"))
    met = met.join(open_masks.select("leaf", "mask", "tok", "need", "least"), ["leaf", "mask"]).join(others, ["leaf", "other"])
    alike = write_table(
        met.filter(agreeing(F.col("tok"), F.col("other_tok")) >= F.col("need")).select("leaf", "mask", "other", "other_docs", "least"),
        "alike"
    )
    few = alike.filter("other_docs < least").select("leaf", "mask", "other", "least")
    few = few.unionByName(few.select("leaf", "mask", F.col("mask").alias("other"), "least").distinct())
    docs = few.join(
        held.withColumnRenamed("mask", "other"), ["leaf", "other"]
    ).groupBy("leaf", "mask", "least").agg(F.countDistinct("_doc").alias("n_docs"))
    return alike.filter("other_docs >= least").select("leaf", "mask").unionByName(docs.filter("n_docs >= least").select("leaf", "mask"))


def templates(docs: DataFrame, lines: DataFrame, depth: int, alike: float, min_docs: int, min_tokens: int, long_docs: int) -> DataFrame:
    """The masked lines to drop: leaf and mask. lines: the written _doc, at, leaf, n and mask of every line."""
    if alike <= 0.5:
        raise ValueError("alike must exceed 0.5")
    least = F.when(F.col("n") > LONG_TOKENS, min(min_docs, long_docs)).otherwise(min_docs)
    r = F.col("n") - depth  # the leading tokens say nothing, as a leaf shares them
    need = F.ceil(F.round(r * alike, 6)).cast("int")
    once = lines.select("leaf", "n", "mask", "_doc").distinct()
    by_mask = write_table(once.groupBy("leaf", "n", "mask").agg(F.count(F.lit(1)).alias("docs")).withColumn("least", least), "masks")
    often = by_mask.filter(F.col("docs") >= F.col("least")).select("leaf", "mask")
    # a leaf is open if some of its masked lines are rare, others may be alike, and all of them have enough documents
    by_leaf = by_mask.groupBy("leaf", "n", "least").agg(F.sum("docs").alias("docs"), F.min("docs").alias("rarest"), F.count(F.lit(1)).alias("masks"))
    open_leaves = write_table(
        by_leaf.filter((F.col("docs") >= F.col("least")) & (F.col("rarest") < F.col("least")) & (F.col("masks") > 1) & (need < r)).select("leaf"),
        "leaves"
    )
    held = write_table(lines.join(open_leaves, "leaf", "left_semi").select("leaf", "mask", "_doc").distinct(), "held")
    # one document of each masked line is enough to read it; lines are sieved before any of them is dealt out
    sources = write_table(held.groupBy("leaf", "mask").agg(F.min("_doc").alias("_doc")).select("_doc").distinct(), "sources")
    in_open = sieved(parsed(sieved(docs, "_doc", sources), depth, min_tokens), "leaf", open_leaves)
    in_open = in_open.groupBy("leaf", "mask").agg(F.min("m").alias("m")).join(open_leaves, "leaf", "left_semi").join(by_mask, ["leaf", "mask"])
    tok = F.transform(F.slice(F.split("m", " "), depth + 1, r), lambda x: F.xxhash64(x))
    open_masks = write_table(in_open.select("leaf", "mask", "docs", "least", need.alias("need"), tok.alias("tok")), "open")
    found = often
    left = write_table(open_masks.filter(F.col("docs") < F.col("least")).select("leaf", "mask"), "left")
    for k in range(ROUNDS):
        if left.isEmpty():
            break
        settled = central(open_masks, held, left, not k)
        found = found.unionByName(settled)
        left = write_table(left.join(settled, ["leaf", "mask"], "left_anti"), "left")
        if not k:
            left = hopeful(open_masks, left)
    if not left.isEmpty():
        found = found.unionByName(paired(open_masks, held, left))
    return write_table(found.distinct(), "templates")


def drop_templates(
    docs: DataFrame, depth: int = DEPTH, alike: float = ALIKE, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS,
    long_docs: int = LONG_DOCS, doc_id: str = "doc_id", text: str = "text", out: str = "lines"
) -> DataFrame:
    """docs whose texts have lost recurring lines, with a struct `out`: n_lines, n_dropped, dropped (line numbers from 0)."""
    body = F.col(f"`{text}`").cast("string")
    named = docs.select(F.xxhash64(F.col(f"`{doc_id}`"), body).alias("_doc"), F.struct("*").alias("_row"))
    texts = named.select("_doc", F.col("_row")[text].cast("string").alias("_text"))
    lines = write_table(parsed(texts, depth, min_tokens).drop("m"), "lines")
    drop = templates(texts, lines, depth, alike, min_docs, min_tokens, long_docs)
    hit = lines.join(drop, ["leaf", "mask"], "left_semi").select("_doc", "at").distinct().groupBy(F.col("_doc").alias("_d")).agg(  # at most a document's lines
        F.sort_array(F.collect_list("at")).alias("_at")
    )
    joined = named.join(hit, F.col("_doc") == F.col("_d"), "left").withColumn("_at", F.coalesce("_at", F.array().cast("array<int>")))
    own = F.col("_row")[text].cast("string")
    kept = F.when(F.size("_at") > 0, F.array_join(F.filter(F.split(own, "\n"), lambda x, k: ~F.array_contains(F.col("_at"), k)), "\n")).otherwise(own)
    n_lines = F.coalesce(count_of(own, "\n") + 1, F.lit(0)).cast("long")
    result = F.struct(n_lines.alias("n_lines"), F.size("_at").cast("long").alias("n_dropped"), F.col("_at").alias("dropped"))
    rest = [kept.alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns if c.lower() != out.lower()]
    return joined.select(*rest, result.alias(out))


def op10(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    r = drop_templates(docs)
    return r.select(
        "doc_id", F.col("lines.n_lines").alias("n_lines"), F.col("lines.n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


ORACLE = rf"""
WITH l AS (SELECT doc_id, line, place FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS place FROM documents WHERE text IS NOT NULL)),
m AS (SELECT *, trim(regexp_replace(regexp_replace(line, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS m FROM l),
t AS (SELECT doc_id, place, m, string_split(m, ' ') AS t FROM m WHERE m <> ''),
k AS (SELECT DISTINCT m, len(t) AS n, array_to_string(t[1:{DEPTH}], ' ') AS lead, t[{DEPTH + 1}:] AS rest, CAST(ceil(round((len(t) - {DEPTH}) * {ALIKE}, 6)) AS BIGINT) AS need, CASE WHEN len(t) > {LONG_TOKENS} THEN {LONG_DOCS} ELSE {MIN_DOCS} END AS least FROM t),
d AS (SELECT DISTINCT m, doc_id FROM t),
a AS (SELECT x.m, x.least, y.m AS other FROM k x JOIN k y ON x.n = y.n AND x.lead = y.lead WHERE x.m = y.m OR (x.n > {DEPTH} AND len(list_filter(range(1, x.n - {DEPTH} + 1), lambda i: x.rest[i] = y.rest[i])) >= x.need)),
gone AS (SELECT a.m FROM a JOIN d ON a.other = d.m GROUP BY a.m, a.least HAVING count(DISTINCT d.doc_id) >= a.least),
x AS (SELECT m.doc_id, m.place, m.line, g.m IS NOT NULL AS gone FROM m LEFT JOIN gone g ON m.m = g.m AND m.m <> ''),
s AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS kept FROM x GROUP BY 1)
SELECT documents.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents LEFT JOIN s USING (doc_id)
"""
