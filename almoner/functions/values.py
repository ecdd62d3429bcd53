"""Amounts, dates, identifiers and sums as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from almoner.functions.names import clean

NUMBER = r"^[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def amount(c: Column) -> Column:
    """Whole dollars from $ , and parentheses for negative ones; null where no finite number is left (rounded half to even)."""
    s = F.trim(F.regexp_replace(c, "[$,]", ""))
    negative = s.startswith("(") & s.endswith(")")
    s = F.when(negative, F.concat(F.lit("-"), F.substring(s, 2, F.length(s) - 2))).otherwise(s)
    number = F.when(s.rlike(NUMBER), F.replace(s, F.lit("_"), F.lit(""))).try_cast("double")
    return F.when(F.abs(number) < 9e18, F.rint(number).cast("long"))


def amount_error(c: Column, name: str) -> Column:
    """What to record about an amount that is stated but can't be read."""
    return F.when(clean(c).isNotNull() & amount(c).isNull(), F.concat(F.lit(f"unparsed {name}: "), c))


def iso_date(c: Column) -> Column:
    """The date that the first ten characters spell, else null."""
    return F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")


def submission_date(c: Column) -> Column:
    """Only a whole, real ISO date; a bare year is null."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c, "yyyy-MM-dd"))


def grant_id(object_id: Column, group: Column, ordinal: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", object_id, group, ordinal.cast("string")), 256), 1, 32)


def file_year(c: Column) -> Column:
    return F.try_element_at(F.regexp_extract_all(c, F.lit(r"(\d{4})"), 1), F.lit(1)).cast("int")


def seeded_order(key: Column, seed: str) -> Column:
    """A stable pseudo-random order, the same in every engine that has SHA-256."""
    return F.sha2(F.concat(key, F.lit(seed)), 256)


def percent_off(parsed: Column, stated: Column) -> Column:
    """100 |parsed - stated| / stated; for a stated zero 0 or infinity."""
    gap = F.abs(parsed - stated)
    return F.when(stated == 0, F.when(gap == 0, 0.0).otherwise(float("inf"))).otherwise(100.0 * gap / F.nullif(stated, F.lit(0)))


def share(part: Column, whole: Column) -> Column:
    """100 part / whole, null without a whole."""
    return F.try_divide(100.0 * part, whole)


def is_version(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\d{4}\.\d{2}\.\d+$"), F.lit(False))


def quoted(c: Column) -> Column:
    """A SQL text literal."""
    return F.when(c.isNull(), "NULL").otherwise(F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'")))


def compact_json(c: Column) -> Column:
    return F.to_json(c)
