"""URL filters: address rules, then a Bloom filter cascade over the corpus's hosts. DataFrame functions only.

The key universe is every distinct host of the corpus, so membership can be made exact: level 0 encodes the listed
hosts; level 1 encodes the unlisted hosts that level 0 lets through; level 2 the listed hosts that level 1 lets
through; and so on until nothing is let through wrongly. A page is judged by walking its host down the levels,
without a join. A listed domain stands for its subdomains; that is resolved when the universe is marked.

A level is an array of 64-bit words in a scalar subquery; its size follows from a count. If one would exceed
`most_bytes`, listed hosts are marked by a semi-join instead (same answer).

Null urls and urls without "://" have an empty host and path: no rule fits, and the empty host is never listed. An
empty list or table gives empty levels. Hosts of any length and number of labels are taken whole. Repeated pages are judged alike. A column named as the result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.llm.common import ascii_lower, write_table

#: Address rules: whether to allow, and what. A rule fits its host, that host's subdomains, and paths that begin with its path.
RULES = ((True, "com/"), (False, "example.com/en/"), (True, "www.example.com/en/"), (False, "net/es/"), (False, "net/fr/"))

#: Domains known for spam (fixed values).
SPAM_NAMES = ("cheap-pills", "spam-farm")
LISTED = tuple(f"{name}.example.{top}" for name in SPAM_NAMES for top in ("com", "net", "org"))

HASHES, BITS_PER_KEY, MOST_BYTES, MOST_LEVELS = 5, 10, 32 << 20, 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return ascii_lower(raw), F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)


def by_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and whether it allows; null where none fits."""
    rule, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for good, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        rule, allow = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(good)).otherwise(allow)
    return rule, allow


def places(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * HASHES + j)), F.lit(bits).cast("long")) for j in range(HASHES)]


def passes(key: Column, words: Column, level: int, bits: int) -> Column:
    """Whether the filter `words` lets the key through."""
    found = F.lit(True)
    for p in places(key, level, bits):
        word = F.element_at(words, (p / 64).cast("int") + 1)
        found = found & (word.bitwiseAND(bit(p)) != 0)
    return found


def bit(place: Column) -> Column:
    """A word with only that place's bit."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))


def build(keys: DataFrame, level: int, bits: int) -> DataFrame:
    """One row with the filter's words: bits/64 of them."""
    spots = keys.select(F.explode(F.array(*places(F.col("key"), level, bits))).alias("p"))
    words = spots.groupBy(F.floor(F.col("p") / 64).cast("long").alias("at")).agg(F.bit_or(bit(F.col("p"))).alias("w"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("at")).join(words, "at", "left")
    held = F.sort_array(F.collect_list(F.struct("at", F.coalesce("w", F.lit(0).cast("long")).alias("w"))))
    return every.agg(F.transform(held, lambda x: x["w"]).alias("words"))


class Cascade:
    """Exact membership of the universe's keys, as levels of Bloom filters."""

    def __init__(self, universe: DataFrame, bits_per_key: int = BITS_PER_KEY, most_bytes: int = MOST_BYTES):
        """universe: key (distinct) and listed."""
        self.levels: list[tuple[DataFrame, int]] = []
        self.fits = True
        inside, outside = universe.filter("listed"), universe.filter("NOT listed")
        for level in range(MOST_LEVELS):
            n = inside.count()
            if not n:
                return
            bits = 64 * -(-n * bits_per_key // 64)
            if bits > 8 * most_bytes:
                break
            words = write_table(build(inside, level, bits), "bloom")
            self.levels.append((words, bits))
            wrong = write_table(outside.filter(passes(F.col("key"), words.scalar(), level, bits)), "passed")
            inside, outside = wrong, inside
        self.fits = False  # a filter beyond most_bytes, or keys that no level tells apart

    def member(self, key: Column) -> Column:
        found = F.lit(len(self.levels) % 2 == 1)
        for level in range(len(self.levels) - 1, -1, -1):
            words, bits = self.levels[level]
            found = F.when(passes(key, words.scalar(), level, bits), found).otherwise(F.lit(level % 2 == 1))
        return found


def marked_hosts(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """key (distinct hosts) and listed: whether the host or a domain above it is in `listed` (column domain)."""
    hosts = pages.select(F.col("host").alias("key")).filter("key != ''").distinct()
    parts, labels = F.split("key", r"\."), listed.agg(F.max(F.size(F.split("domain", r"\.")))).first()[0] or 1
    # no listed domain has more labels, so a host of many labels makes no more names than that
    above = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
        lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), ".")
    )
    hits = hosts.select("key", F.explode(above).alias("domain")).join(
        listed.select("domain").distinct(), "domain", "left_semi"
    ).select("key").distinct()
    return hosts.join(hits.withColumn("_hit", F.lit(True)), "key", "left").select("key", F.col("_hit").isNotNull().alias("listed"))


def filter_urls(pages: DataFrame, listed: DataFrame, url: str = "url", rules=RULES, out: str = "url_filter", **how) -> DataFrame:
    """pages with a struct `out`: host, path, rule (the longest that fits), listed, allowed."""
    host, path = host_and_path(F.col(f"`{url}`").cast("string"))
    keyed = pages.select(F.struct("*").alias("_row"), host.alias("host"), path.alias("path"))
    universe = write_table(marked_hosts(keyed, listed), "hosts")
    cascade = Cascade(universe, **how)
    if cascade.fits:
        keyed = keyed.withColumn("listed", (F.col("host") != "") & cascade.member(F.col("host")))
    else:
        own = universe.filter("listed").select(F.col("key").alias("_key"))
        keyed = keyed.join(own, F.col("host") == F.col("_key"), "left").withColumn("listed", F.col("_key").isNotNull())
    rule, allow = by_rules(F.col("host"), F.col("path"), rules)
    result = F.struct("host", "path", rule.alias("rule"), "listed", F.coalesce(allow, ~F.col("listed")).alias("allowed"))
    return keyed.select(*[F.col("_row")[c].alias(c) for c in pages.columns if c.lower() != out.lower()], result.alias(out))


def op2(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    listed = spark.createDataFrame([(d,) for d in LISTED], "domain string")
    r, f = filter_urls(pages, listed), F.col("url_filter")
    return r.select(
        "page_id", f["host"].alias("host"), f["path"].alias("path"), f["rule"].alias("rule"),
        F.when(f["allowed"], "allow").otherwise("block").alias("verdict")
    )


def _oracle() -> str:
    fits = [(len(r), r, "allow" if good else "block") for good, r in RULES]
    rules = ", ".join(f"({n}, '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{v}')" for n, r, v in fits)
    hosts = " OR ".join(f"host = '{d}' OR ends_with(host, '.{d}')" for d in LISTED)
    return f"""
WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
rules AS (SELECT * FROM (VALUES {rules}) t(n, rule, rule_host, rule_path, verdict)),
best AS (SELECT p.*, rule, verdict, row_number() OVER (PARTITION BY page_id, host, path ORDER BY n DESC) AS k
         FROM p LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN verdict WHEN {hosts} THEN 'block' ELSE 'allow' END AS verdict FROM best WHERE k = 1
"""


ORACLE = _oracle()
