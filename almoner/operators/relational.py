"""Relational operators that grants, filings and registries share."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.sources.shared import written


def all_equal_null_safe(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality that matches null with null; planned as a hash or merge join on every column."""
    return reduce(operator.and_, [left[c].eqNullSafe(right[c]) for c in columns])


def anti_null_safe(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of left without a partner in right, null matching null."""
    return left.join(right, all_equal_null_safe(left, right, columns), "left_anti")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first in `order`."""
    k = unused(df, "k")
    return df.withColumn(k, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(k) == 1).drop(k)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Both tables' rows, the latest by `order` for each key."""
    return latest_per_key(old.unionByName(new, allowMissingColumns=True), keys, order)


def superseded(index: DataFrame) -> DataFrame:
    """Filings with `superseded_by` (the next newer filing of the same organization, period and form; null for the
    newest), `rank` (1: newest) and `final_winner`."""
    w = Window.partitionBy("ein", "tax_period", "return_type").orderBy(F.coalesce("sub_date", F.lit("")).desc(), F.col("object_id").desc())
    return index.withColumn("rank", F.row_number().over(w)).withColumn("superseded_by", F.lag("object_id").over(w)).withColumn(
        "final_winner", F.first("object_id").over(w)
    )


def reconcile(index: DataFrame, members: DataFrame, year: int | None = None) -> DataFrame:
    """object_id and side: in the index only, or in an archive only and not superseded (of the year that its file name has)."""
    from almoner.functions.values import file_year

    ranked = superseded(index)
    current, gone = ranked.filter("rank = 1"), ranked.filter("rank > 1").select("object_id")
    in_year = members if year is None else members.filter(file_year(F.col("zip_file")) == year)
    wanted = current if year is None else current.filter(F.col("filing_year") == year)
    index_only = wanted.join(members.select("object_id"), "object_id", "left_anti").select("object_id", F.lit("index_only").alias("side"))
    zip_only = in_year.select("object_id").distinct().join(current.select("object_id"), "object_id", "left_anti").join(gone, "object_id", "left_anti")
    return index_only.unionByName(zip_only.select("object_id", F.lit("zip_only").alias("side")))


def top_per_group(df: DataFrame, groups: list[str], order: list[Column], most: int, rank: str = "rn") -> DataFrame:
    """The first `most` rows of each group (Spark keeps no more of them before the shuffle), with their rank."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).filter(F.col(rank) <= most)


def page_of(df: DataFrame, order: list[Column], page: int, size: int = 100) -> DataFrame:
    return df.orderBy(*order).offset((max(1, page) - 1) * size).limit(size)


def unused(df: DataFrame, name: str, *also: str) -> str:
    """A column name that df doesn't have, and that is none of `also`."""
    while name.lower() in {c.lower() for c in (*df.columns, *also)}:
        name += "_"
    return name


def global_row_number(df: DataFrame, order: list[Column], name: str = "rn") -> DataFrame:
    """Row numbers over the whole table: ranges of `order` are numbered by themselves and shifted by what precedes them.

    The ranges are written first, so that both uses of them see the same. df must not have a column of that name."""
    own, before, place = (unused(df, x, name) for x in ("range", "before", "place"))
    spread = written(df.repartitionByRange(*order).withColumn(own, F.spark_partition_id()))
    sizes = spread.groupBy(own).agg(F.count(F.lit(1)).alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.orderBy(own).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(own, earlier.alias(before))  # a row for each range
    inside = F.row_number().over(Window.partitionBy(own).orderBy(*order))
    return spread.withColumn(place, inside).join(F.broadcast(sizes), own).withColumn(name, F.col(before) + F.col(place)).drop(own, before, place)


def chunk_numbers(df: DataFrame, order: list[Column], size: int, name: str = "chunk") -> DataFrame:
    """Which chunk of `size` rows, from 0, each row falls into."""
    row = unused(df, "row")
    return global_row_number(df, order, row).withColumn(name, F.floor((F.col(row) - 1) / size).cast("int")).drop(row)


def stratified(df: DataFrame, stratum: str, key: Column, n: int, seed: str) -> DataFrame:
    """An equal share of about n rows from each stratum, in a stable order that depends on the seed."""
    from almoner.functions.values import seeded_order

    strata = df.select(stratum).distinct().count()
    share, h = max(1, n // max(1, strata)), unused(df, "h")
    return top_per_group(df.withColumn(h, seeded_order(key, seed)), [stratum], [F.col(h)], share, "place").drop(h)


def filing_changes(processed: DataFrame, index: DataFrame) -> DataFrame:
    """object_id, filing_year and change of each filing that was processed before (object_id, filing_year) or is listed now.

    added: listed, the newest of its kind, not processed; kept: processed and still that; superseded: processed, but a
    newer one is listed; removed: processed and not listed any more."""
    now = superseded(index).select("object_id", F.col("filing_year").alias("_year"), (F.col("rank") == 1).alias("_newest"))
    both = processed.select("object_id", F.col("filing_year").alias("_old")).join(now, "object_id", "full")
    old, newest = F.col("_old").isNotNull(), F.coalesce("_newest", F.lit(False))
    change = F.when(old & newest, "kept").when(old & F.col("_newest").isNull(), "removed").when(old, "superseded").when(newest, "added")
    return both.select("object_id", F.coalesce("_year", "_old").alias("filing_year"), change.alias("change")).filter("change IS NOT NULL")


def version_delta(changes: DataFrame) -> DataFrame:
    """How many filings of each year were added, kept, superseded and removed; years with nothing but kept ones need no rewriting."""
    kinds = ("added", "kept", "superseded", "removed")
    out = changes.groupBy("filing_year").agg(*[F.count_if(F.col("change") == c).alias(c) for c in kinds])
    return out.withColumn("touched", F.col("added") + F.col("superseded") + F.col("removed") > 0)


def carried_over(edges: DataFrame, added: DataFrame, changes: DataFrame) -> DataFrame:
    """The edges of a new version's touched years: those of filings that are kept, and the added filings'."""
    gone = changes.filter("change IN ('superseded', 'removed')").select("object_id")
    years = [r[0] for r in version_delta(changes).filter("touched").select("filing_year").collect()]  # a row for each year
    year = F.col("filing_year").isin([y for y in years if y is not None])
    old = edges.filter(year | F.col("filing_year").isNull() if None in years else year)
    # only ids are dealt out; where few filings stay, their ids' table is small enough to be sent to the edges
    stay = written(old.select("object_id").distinct().join(gone, "object_id", "left_anti"))
    kept = old.join(stay, "object_id", "left_semi")
    return kept.unionByName(added, allowMissingColumns=True)
