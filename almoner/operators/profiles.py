"""Questions that grants answer: by funder, by recipient, by keyword; profiles, pages, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.functions.names import search_tokens
from almoner.operators.relational import page_of, top_per_group
from almoner.sources.shared import bucketed

TOP, RECENT, CHUNK_ABOVE, PREVIEW, PAGE = 250, 2000, 2000, 500, 1000


def paid() -> Column:
    return F.col("amount_type") == "paid"


def future() -> Column:
    return F.col("amount_type") == "approved_future"


def dollars(which: Column) -> Column:
    return F.coalesce(F.sum(F.when(which, F.col("amount_usd"))), F.lit(0))


def recipient_key(name: str = "recipient_name_normalized", state: str = "recipient_state") -> Column:
    """The resolved number, else name|state."""
    return F.coalesce(F.col("recipient_ein_resolved"), F.concat_ws("|", F.coalesce(name, F.lit("")), F.coalesce(state, F.lit(""))))


def funder_grants(
    edges: DataFrame, funder_ein: str, min_amount: int | None = None, max_amount: int | None = None,
    years: list[int] | None = None, state: str | None = None,
    purpose: str | None = None, amount_type: str = "paid", min_confidence: float | None = None, limit: int = 100,
) -> DataFrame:
    """What a funder gave, largest first."""
    g = edges.filter((F.col("funder_ein") == funder_ein) & (F.col("amount_type") == amount_type))
    if min_amount is not None:
        g = g.filter(F.col("amount_usd") >= min_amount)
    if max_amount is not None:
        g = g.filter(F.col("amount_usd") <= max_amount)
    if years:
        g = g.filter(F.col("tax_year").isin(*years))
    if state is not None:
        g = g.filter(F.col("recipient_state") == state)
    if purpose is not None:
        g = g.filter(F.upper("grant_purpose").contains(purpose.upper()))
    if min_confidence is not None:
        g = g.filter(F.col("match_confidence") >= min_confidence)
    return g.orderBy(F.col("amount_usd").desc_nulls_last(), "grant_id").limit(limit)


def funders_of_recipients(edges: DataFrame, min_confidence: float = 0.9, recipient_ein: str | None = None) -> DataFrame:
    """Who funded a recipient (or each recipient): paid grants matched with enough confidence."""
    g = edges.filter(paid() & (F.col("match_confidence") >= min_confidence) & F.col("recipient_ein_resolved").isNotNull())
    if recipient_ein is not None:
        g = g.filter(F.col("recipient_ein_resolved") == recipient_ein)
    return g.groupBy("recipient_ein_resolved", "funder_ein", "funder_name").agg(
        F.sum("amount_usd").alias("total_usd"), F.count(F.lit(1)).alias("grants"), F.max("tax_year").alias("last_year")
    )


def funders_by_keyword(edges: DataFrame, keyword: str, state: str | None = None, min_amount: int = 0, limit: int = 25) -> DataFrame:
    hit = F.upper("grant_purpose").contains(keyword.upper()) | F.upper("recipient_name_raw").contains(keyword.upper())
    g = edges.filter(paid() & hit & (F.col("amount_usd") >= min_amount))
    if state is not None:
        g = g.filter(F.col("funder_state") == state)
    totals = g.groupBy("funder_ein", "funder_name").agg(F.sum("amount_usd").alias("total_usd"), F.count(F.lit(1)).alias("grants"))
    return totals.orderBy(F.col("total_usd").desc(), "funder_ein").limit(limit)


def funder_totals(edges: DataFrame, registry: DataFrame) -> DataFrame:
    """Identity and totals of each funder; paid and future money are never added up."""
    totals = edges.groupBy("funder_ein").agg(
        F.min("funder_name").alias("funder_name"), F.min("funder_state").alias("funder_state"),
        dollars(paid()).alias("paid_usd"), F.count_if(paid()).alias("paid_grants"), dollars(future()).alias("future_usd"),
        F.count_if(future()).alias("future_grants"),
        F.count_distinct(F.when(paid(), recipient_key())).alias("recipients"),
        F.min("tax_year").alias("first_year"), F.max("tax_year").alias("last_year"),
        F.max("tax_period_end").alias("last_period_end"), F.count(F.lit(1)).alias("rows"),
    )
    return totals.join(registry.select(F.col("ein").alias("funder_ein"), "ntee_code"), "funder_ein", "left")


def funder_recipients(edges: DataFrame, most: int = TOP) -> DataFrame:
    """Each funder's largest recipients by paid dollars."""
    sums = edges.filter(paid()).groupBy("funder_ein", recipient_key().alias("recipient")).agg(
        F.min("recipient_name_raw").alias("name"), F.sum("amount_usd").alias("total_usd"), F.count(F.lit(1)).alias("grants"),
        F.max("tax_year").alias("last_year")
    )
    return top_per_group(sums, ["funder_ein"], [F.col("total_usd").desc(), F.col("recipient")], most)


def recent_grants(edges: DataFrame, by: str, most: int = RECENT) -> DataFrame:
    """The latest grants of each funder or recipient, largest first within a year."""
    return top_per_group(
        edges.filter(F.col(by).isNotNull()), [by],
        [F.col("tax_year").desc_nulls_last(), F.col("amount_usd").desc_nulls_last(), F.col("grant_id")], most
    )


def recipient_totals(edges: DataFrame, registry: DataFrame) -> DataFrame:
    """Identity and totals of each resolved recipient; funders counts both kinds of money."""
    g = edges.filter(F.col("recipient_ein_resolved").isNotNull())
    totals = g.groupBy("recipient_ein_resolved").agg(
        dollars(paid()).alias("paid_usd"), F.count_if(paid()).alias("paid_grants"), dollars(future()).alias("future_usd"),
        F.count_distinct("funder_ein").alias("funders"),
        F.min("tax_year").alias("first_year"), F.max("tax_year").alias("last_year"), F.min("recipient_name_raw").alias("_raw"),
    )
    named = totals.join(
        registry.select(F.col("ein").alias("recipient_ein_resolved"), F.col("name").alias("_bmf"), "ntee_code"),
        "recipient_ein_resolved", "left"
    )
    return named.withColumn("name", F.coalesce("_bmf", "_raw")).drop("_bmf", "_raw")


def recipient_funders(edges: DataFrame, most: int = TOP) -> DataFrame:
    """Each recipient's largest funders, with the tiers of the matches."""
    sums = edges.filter(paid() & F.col("recipient_ein_resolved").isNotNull()).groupBy("recipient_ein_resolved", "funder_ein").agg(
        F.sum("amount_usd").alias("total_usd"), F.count(F.lit(1)).alias("grants"), F.max("tax_year").alias("last_year"),
        F.array_join(F.sort_array(F.collect_set("match_tier")), "").alias("tiers")
    )
    return top_per_group(sums, ["recipient_ein_resolved"], [F.col("total_usd").desc(), F.col("funder_ein")], most)


def unmatched(edges: DataFrame) -> DataFrame:
    """Recipients that no registered organization could be found for."""
    g = edges.filter(F.col("recipient_ein_resolved").isNull())
    return g.groupBy("recipient_name_normalized", "recipient_state").agg(
        F.count(F.lit(1)).alias("occurrences"), F.sum("amount_usd").alias("total_usd")
    )


def gathered(rows: DataFrame, key: str, rank: str, columns: list[str], name: str) -> DataFrame:
    """One array of structs for each key, in rank order; rows are already bounded for each key."""
    item = F.struct(F.col(rank), *columns)
    return rows.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: F.struct(*[x[c].alias(c) for c in columns])).alias(name))


#: What a document says of each grant, and under which names.
GRANT = {
    "grant_id": "grant_id", "tax_year": "tax_year", "amount_type": "amount_type", "amount_usd": "amount_usd",
    "noncash_amount_usd": "noncash_amount_usd", "recipient_name_raw": "recipient_name",
    "recipient_ein_resolved": "recipient_ein", "match_tier": "match_tier", "match_confidence": "match_confidence",
    "match_method": "match_method", "grant_purpose": "purpose",
    "recipient_city": "city", "recipient_state": "state", "recipient_type": "recipient_type", "object_id": "object_id",
}


def _grant(edges: DataFrame, *more: str) -> list[Column]:
    return [F.col(c).alias(n) for c, n in GRANT.items() if c in edges.columns] + [F.col(c) for c in more]


def _latest(edges: DataFrame, by: str, most: int, *more: str) -> DataFrame:
    """Each key's latest grants as one array (at most `most`), under GRANT's names."""
    rows = recent_grants(edges, by, most).select(F.col(by).alias("_key"), "rn", F.struct(*_grant(edges, *more)).alias("g"))
    return rows.groupBy("_key").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rn", "g"))), lambda x: x["g"]).alias("recent_grants")
    ).withColumnRenamed("_key", by)


#: What a funder's or recipient's document is made from.
PAYLOAD = {
    *GRANT, "funder_ein", "funder_name", "funder_state", "funder_form_type", "tax_period_end", "filing_year", "return_version",
    "recipient_name_normalized"
}


def funder_payloads(edges: DataFrame, registry: DataFrame, top: int = TOP, recent: int = RECENT, about: dict[str, str] | None = None) -> DataFrame:
    """One compact JSON document for each funder: totals, years, top recipients, recent grants, filings; `about`: fixed values,
    such as the version. An organization files once a year and form, so its years and filings are few.

    Edges are dealt by funder once, into a table; its parts are made and joined where they lie."""
    edges = bucketed(edges.select(*[c for c in edges.columns if c in PAYLOAD]), "funder_ein")
    years = edges.groupBy("funder_ein", "tax_year").agg(
        dollars(paid()).alias("paid_usd"), dollars(future()).alias("future_usd"), F.count(F.lit(1)).alias("grants"),
        F.count_distinct("object_id").alias("filings")
    )
    years = years.groupBy("funder_ein").agg(
        F.sort_array(F.collect_list(F.struct("tax_year", "paid_usd", "future_usd", "grants", "filings"))).alias("years")
    )
    filings = edges.select(
        "funder_ein", "object_id", "tax_year", "tax_period_end", "filing_year", "return_version",
        F.col("funder_form_type").alias("form_type")
    ).distinct()
    filings = filings.groupBy("funder_ein").agg(
        F.sort_array(
            F.collect_list(F.struct("object_id", "tax_year", "tax_period_end", "filing_year", "return_version", "form_type"))
        ).alias("filings")
    )
    largest = gathered(funder_recipients(edges, top), "funder_ein", "rn", ["recipient", "name", "total_usd", "grants", "last_year"], "top_recipients")
    doc = funder_totals(edges, registry)
    for part in (years, largest, filings, _latest(edges, "funder_ein", recent)):
        doc = doc.join(part, "funder_ein", "left")
    chunked = F.col("rows") > CHUNK_ABOVE
    doc = doc.withColumn("chunked", chunked).withColumn(
        "recent_grants", F.when(chunked, F.slice("recent_grants", 1, PREVIEW)).otherwise(F.col("recent_grants"))
    )
    return doc.select("funder_ein", F.to_json(F.struct(*doc.columns, *_about(about))).alias("payload"))


def recipient_payloads(edges: DataFrame, registry: DataFrame, top: int = TOP, recent: int = RECENT, about: dict[str, str] | None = None) -> DataFrame:
    """The same for each resolved recipient: identity and place, totals, largest funders with the matches' tiers, recent grants."""
    key = "recipient_ein_resolved"
    place = registry.select(F.col("ein").alias(key), *[c for c in ("city", "state", "subsection_code") if c in registry.columns])
    names = edges.groupBy("funder_ein").agg(F.min("funder_name").alias("funder_name"), F.min("funder_state").alias("funder_state"))
    edges = bucketed(edges.filter(F.col(key).isNotNull()).select(*[c for c in edges.columns if c in PAYLOAD]), key)
    largest = recipient_funders(edges, top).join(names, "funder_ein")
    largest = gathered(
        largest, key, "rn", ["funder_ein", "funder_name", "funder_state", "total_usd", "grants", "last_year", "tiers"],
        "funders_by_total"
    )
    doc = recipient_totals(edges, registry).join(place, key, "left").join(largest, key, "left").join(
        _latest(edges, key, recent, "funder_ein", "funder_name"), key, "left"
    )
    return doc.select(key, F.to_json(F.struct(*doc.columns, *_about(about))).alias("payload"))


def _about(about: dict[str, str] | None) -> list[Column]:
    return [F.lit(v).alias(k) for k, v in (about or {}).items()]


def year_pages(edges: DataFrame, chunk_above: int = CHUNK_ABOVE, size: int = PAGE) -> DataFrame:
    """Pages of grants by funder and year for funders with more than `chunk_above` rows; rows without a year are in none."""
    large = edges.groupBy("funder_ein").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > chunk_above).select("funder_ein")
    own = edges.filter(F.col("tax_year").isNotNull()).join(large, "funder_ein", "left_semi")
    place = F.row_number().over(Window.partitionBy("funder_ein", "tax_year").orderBy(F.col("amount_usd").desc_nulls_last(), "grant_id"))
    ranked = own.withColumn("rn", place)
    return ranked.withColumn("page", F.ceil(F.col("rn") / size).cast("int"))


def page_counts(pages: DataFrame) -> DataFrame:
    """How many pages each year of a chunked funder has, as a map."""
    n = pages.groupBy("funder_ein", "tax_year").agg(F.max("page").alias("pages"))
    return n.groupBy("funder_ein").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("tax_year").cast("string"), "pages")))).alias("pages")
    )


def browse(totals: DataFrame, condition: Column, page: int, size: int = 100) -> tuple[DataFrame, int]:
    """A page of funders, the largest first, and how many there are."""
    found = totals.filter(condition)
    return page_of(found, [F.col("paid_usd").desc(), F.col("funder_ein")], page, size), found.count()


def search_index(entities: DataFrame) -> DataFrame:
    """ein, kind, name and each token of the name, from ein, kind and name."""
    return entities.select("ein", "kind", "name", F.explode(F.array_distinct(search_tokens(F.col("name"), 64))).alias("token"))


def search(index: DataFrame, text: str, limit: int = 25) -> DataFrame:
    """Entities that have every token of `text` (the last as a prefix), the rarest tokens' matches and shortest names first.

    A text of nine digits names an entity by its number: a funder if there is one, else a recipient."""
    digits = "".join(c for c in text if c.isdigit())
    if len(digits) == 9 and not any(c.isalpha() for c in text):
        hit = index.filter(F.col("ein") == digits).select("ein", "kind", "name").distinct()
        return hit.orderBy(F.col("kind"), "ein").limit(1)
    words = "".join(c if c.isalnum() and c.isascii() else " " for c in text.upper()).split()[:8]
    if not words:
        return index.select("ein", "kind", "name").limit(0)
    wanted = [*[F.col("token") == w for w in words[:-1]], F.col("token").startswith(words[-1])]
    flags = [F.max(w.cast("int")).alias(f"_{k}") for k, w in enumerate(wanted)]
    any_of = wanted[0]
    for w in wanted[1:]:
        any_of = any_of | w
    found = index.filter(any_of).groupBy("ein", "kind", "name").agg(*flags)
    for k in range(len(wanted)):
        found = found.filter(F.col(f"_{k}") == 1)
    found = found.withColumn("score", F.lit(1.0) / F.size(search_tokens(F.col("name"), 64)))
    return found.orderBy(F.col("score").desc(), "name", "kind", "ein").limit(limit).select("ein", "kind", "name")


