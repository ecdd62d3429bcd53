"""Names, ZIP codes and identification numbers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The canonical form of common words in organizations' names.
CANONICAL_WORDS = {
    "INCORPORATED": "INC",
    "CORPORATION": "CORP",
    "FOUNDATION": "FDN",
    "UNIVERSITY": "UNIV",
    "ASSOCIATION": "ASSN",
    "SOCIETY": "SOC",
    "INTERNATIONAL": "INTL",
    "SAINT": "ST",
}

# Organizations with many chapters of nearly the same name.
CHAPTER_NAMES = (
    "BOYS AND GIRLS CLUB", "UNITED WAY", "HABITAT FOR HUMANITY", "YMCA", "YWCA", "GOODWILL",
    "BIG BROTHERS BIG SISTERS", "SALVATION ARMY", "AMERICAN RED CROSS", "RED CROSS", "ROTARY", "KIWANIS",
)
CHAPTER_PATTERN = r"\b(" + "|".join(CHAPTER_NAMES) + r")\b"

# Fixed value: what joins a name and another one for the same organization.
ALIAS_PATTERN = r"(?i)\b(?:D/?B/?A|A/?K/?A|F/?K/?A)\b\.?"


def clean(c: Column) -> Column:
    """Trimmed, and null where nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def normalize_name(c: Column) -> Column:
    """The form in which names are compared; empty for null."""
    s = F.translate(F.replace(F.upper(F.coalesce(c, F.lit(""))), F.lit("&"), F.lit(" AND ")), "'’‘", "")
    s = F.trim(F.regexp_replace(F.regexp_replace(s, "[^A-Z0-9 ]+", " "), r"\s+", " "))
    s = F.regexp_replace(s, "^THE( |$)", "")
    words = F.create_map(*[F.lit(x) for pair in CANONICAL_WORDS.items() for x in pair])
    s = F.array_join(F.transform(F.split(s, " "), lambda t: F.coalesce(F.element_at(words, t), t)), " ")
    return F.regexp_replace(s, "(?:^| )INC(?: INC)*$", "")


def split_aliases(c: Column) -> Column:
    """The names that a name joined by DBA, AKA or FKA holds."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), ALIAS_PATTERN), lambda x: F.btrim(x, F.lit(" ,;-")))
    return F.filter(parts, lambda x: x != "")


def is_chapter(normalized: Column) -> Column:
    return normalized.rlike(CHAPTER_PATTERN)


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def zip5(c: Column) -> Column:
    return F.when(F.length(digits(c)) >= 5, F.substring(digits(c), 1, 5))


def tax_year(period_end: Column) -> Column:
    return F.year(period_end)


def valid_ein(c: Column) -> Column:
    """Nine digits that aren't all zero, else null."""
    d = digits(c)
    return F.when((F.length(d) == 9) & (d != "000000000"), d)


def padded_ein(c: Column) -> Column:
    """Digits; eight or nine of them are padded to nine."""
    d = digits(c)
    return F.when(F.length(d).between(8, 9), F.lpad(d, 9, "0")).otherwise(d)


def squash(c: Column) -> Column:
    return F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9]+", "")


def clamp(c: Column, low: Column, high: Column) -> Column:
    return F.round(F.least(F.greatest(c, low), high), 2)


def first_token(normalized: Column) -> Column:
    return F.nullif(F.substring_index(normalized, " ", 1), F.lit(""))


def search_form(c: Column) -> Column:
    """Upper case, other characters than letters, digits and spaces replaced; not canonical."""
    return F.trim(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9 ]+", " "))


def search_tokens(c: Column, most: int = 8) -> Column:
    words = F.split(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9]+", " "), " ")
    return F.slice(F.filter(words, lambda w: w != ""), 1, most)


def canonical_ein(c: Column) -> Column:
    """Nine digits from up to nine, null otherwise."""
    d = digits(c)
    return F.when(F.length(d).between(1, 9), F.lpad(d, 9, "0"))


def is_canonical_ein(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9]{9}$"), F.lit(False))


def display_ein(c: Column) -> Column:
    e = canonical_ein(c)
    return F.concat(F.substring(e, 1, 2), F.lit("-"), F.substring(e, 3, 7))


def joined_name(*parts: Column) -> Column:
    """The parts that hold anything, separated by a space; null without any."""
    return F.nullif(F.concat_ws(" ", *[clean(p) for p in parts]), F.lit(""))
