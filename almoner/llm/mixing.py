"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1, ...; together they get `share` times all
words; no target exceeds `most` times its source, and what that cuts off goes to the others by weight.

A source with target t and size s needs q = t/s copies of each document. The floor(q) whole copies are certain.
The rest, f = q - floor(q), is the documents' inclusion probability: each draws u from a hash of its id, ranks by
the ratio of odds (u/(1-u)) / (f/(1-f)), and the lowest ranks are taken up to the source's remaining words, a
sample of fixed size in words. One more document, the one nearest the words still missing, closes the gap where
that brings the sum nearer. The hash is fixed by `seed`, so reruns agree.

Null text or no words: size 0, nothing to take. Null ids draw as the empty id. Rows that agree in id and size are
interchangeable. A source without words has target 0. An empty table gives an empty one. Sources may be as many as
documents (no task holds them all), texts of any length count as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.llm.common import WORD_PATTERN, write_table
from almoner.llm.prefix import ranged, with_starts

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """_source, source_size and target from source and size: one row for each source.

    With sources sorted by cap/weight, level_k = (budget - caps before k) / (weights from k on) never exceeds the
    common level, and meets it at the first source that isn't capped; so the level is the largest of them."""
    by_source = sizes.groupBy(F.col("source").alias("_source")).agg(F.sum("size").alias("source_size"))
    order = [F.col("_source").asc_nulls_last()]
    placed = with_starts(ranged(by_source, order, "sources"), order, "source_size", [])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_at") % len(weights) + 1).cast("int")).cast("long")
    capped = placed.select("_source", "source_size", weight.alias("_w"), (most * F.col("source_size")).alias("_cap"))
    order = [F.col("_cap") / F.col("_w"), *order]
    capped = with_starts(ranged(capped, order, "sources"), order, "_cap", []).withColumnRenamed("_start", "_caps").drop("_at")
    capped = write_table(with_starts(capped, order, "_w", []), "targets")  # _start: the weights before
    total, w = capped.agg(F.sum("source_size"), F.sum("_w")).first()
    level = (F.lit(float(total or 0) * share) - F.col("_caps")) / (F.lit(w or 0) - F.col("_start"))
    top = capped.agg(F.max(level)).first()[0]
    return capped.select("_source", "source_size", F.least(F.col("_cap").cast("double"), F.lit(top).cast("double") * F.col("_w")).alias("target"))


def draw(doc_id: Column, seed: str) -> Column:
    """A number between 0 and 1 from 52 hash bits."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def mix(
    docs: DataFrame, seed: str = "", doc_id: str = "doc_id", text: str = "text", source: str = "source", carry: str | None = None,
    **how
) -> DataFrame:
    """doc_id, source, size, source_size, target and copies of every row; with carry, that column too, as _row (it settles ties)."""
    size = F.coalesce(F.regexp_count(F.col(f"`{text}`").cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    thin = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), size.alias("size"),
        *([F.col(f"`{carry}`").alias("_row")] if carry else [])
    )
    thin = write_table(thin, "sizes")
    t = targets(thin, **how)
    u = draw(F.col("doc_id"), seed)
    q = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ranks = thin.join(t, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_whole", F.floor(q)).withColumn("_f", q - F.col("_whole"))
    odds = F.when(F.col("_f") > 0, (u / (1 - u)) / (F.col("_f") / (1 - F.col("_f"))))
    ranks = ranks.withColumn("_odds", odds).withColumn("_left", F.col("target") - F.col("_whole") * F.col("source_size")).drop("_source", "_f")
    order = [F.col("source").asc_nulls_first(), F.col("_odds"), F.col("doc_id").asc_nulls_first(), F.col("size"), *([F.col("_row")] if carry else [])]
    table = with_starts(ranged(ranks, order, "odds"), order, "size", ["source"])
    table = write_table(table.withColumn("_in", F.col("_odds").isNotNull() & (F.col("_start") + F.col("size") <= F.col("_left"))), "taken")
    gap = table.groupBy("source").agg(F.sum(F.when(F.col("_in"), F.col("size")).otherwise(0)).alias("_got"), F.first("_left").alias("_want"))
    gap = gap.select(F.col("source").alias("_source"), (F.col("_want") - F.col("_got")).alias("_gap"))
    off = F.abs(F.col("size") - F.col("_gap"))
    rest = table.filter(~F.col("_in") & F.col("_odds").isNotNull()).join(
        gap, F.col("source").eqNullSafe(F.col("_source"))
    ).filter(off < F.col("_gap"))
    close = rest.groupBy("source").agg(
        F.min(
            F.struct(
                off.alias("off"), F.col("_odds").alias("odds"), F.col("doc_id").alias("id"), F.col("_pid").alias("pid"),
                F.col("_rank").alias("rank")
            )
        ).alias("_last")
    )
    close = close.select(F.col("source").alias("_source"), F.col("_last.pid").alias("_p"), F.col("_last.rank").alias("_r"))
    hit = (F.col("_pid") == F.col("_p")) & (F.col("_rank") == F.col("_r"))
    done = table.join(close, hit, "left")
    copies = (F.col("_whole") + (F.col("_in") | F.col("_p").isNotNull()).cast("long")).alias("copies")
    return done.select("doc_id", "source", "size", "source_size", "target", copies, *(["_row"] if carry else []))


def op7(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         (CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size AS cap, [5, 2, 1][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS w FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE - CAST(coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
       / CAST(sum(w) OVER (ORDER BY CAST(cap AS DOUBLE) / w, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS lv FROM w),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), max(lv) OVER () * w) AS target FROM l),
q AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, d.u, CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0.0::DOUBLE END AS q
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, CAST(floor(q) AS BIGINT) AS whole, q - floor(q) AS f FROM q),
o AS (SELECT *, CASE WHEN f > 0 THEN (u / (1 - u)) / (f / (1 - f)) END AS odds, target - whole * source_size AS want FROM f),
c AS (SELECT *, odds IS NOT NULL AND sum(size) OVER (PARTITION BY source ORDER BY odds NULLS FIRST, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) <= want AS taken_in FROM o),
g AS (SELECT source, max(want) - sum(CASE WHEN taken_in THEN size ELSE 0 END) AS gap FROM c GROUP BY source),
r AS (SELECT c.source, c.doc_id, row_number() OVER (PARTITION BY c.source ORDER BY abs(c.size - g.gap), c.odds, c.doc_id) AS k
      FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source WHERE NOT c.taken_in AND c.odds IS NOT NULL AND abs(c.size - g.gap) < g.gap)
SELECT c.doc_id, c.size, c.source_size, c.target,
       CAST((c.whole + CASE WHEN c.taken_in OR r.doc_id IS NOT NULL THEN 1 ELSE 0 END) * c.size AS BIGINT) AS taken
FROM c LEFT JOIN r ON r.k = 1 AND r.doc_id = c.doc_id
"""
