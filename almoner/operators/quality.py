"""Checks of what was extracted: coverage, reconciliation with stated totals, missing detail, evaluation, gates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.functions.values import percent_off, share
from almoner.operators.filings import as_filed

# Tolerance, gates and targets.
TOLERANCE, COVERAGE_GATE, TOTALS_GATE, LEAST_PAIRS = 1.0, 95.0, 95.0, 1000
TARGETS = {"A": 1.00, "B": 0.99, "C": 0.95, "D": 0.80}
EXIT_COVERAGE, EXIT_TOTALS, EXIT_MATCHING = 2, 3, 4
PF_FIELDS = ("amount", "purpose", "name", "city", "state", "zip", "relationship", "status")


def filing_sums(filings: DataFrame) -> DataFrame:
    """Each filing (of filed()) with sums over its own rows, without dealing any out."""
    graded = F.transform("rows", lambda r: F.struct(*[as_filed(r)[c].alias(c) for c in ("amount_type", "amount_usd", "is_placeholder")]))
    out = filings.withColumn("rows", graded)
    paid = F.filter("rows", lambda r: r["amount_type"] == "paid")
    return out.select(
        *[c for c in out.columns if c != "rows"], F.size("rows").cast("long").alias("n_rows"), F.size(paid).cast("long").alias("paid_rows"),
        F.size(F.filter("rows", lambda r: r["is_placeholder"])).cast("long").alias("placeholder_rows"),
        F.aggregate(paid, F.lit(0).cast("long"), lambda a, r: a + F.coalesce(r["amount_usd"], F.lit(0))).alias("parsed_paid"),
    )


def pf_totals(filings: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Status of each foundation filing: what its rows sum to against the paid total it states."""
    parsed, stated = F.col("parsed_paid"), F.col("total_paid")
    pct = percent_off(parsed, stated)
    status = F.when(
        (F.col("paid_rows") == 0) & stated.isNull(), "no_rows"
    ).when(stated.isNull(), "no_total").when(pct <= tolerance, "within_tolerance").otherwise("over_tolerance")
    return filings.filter("return_type = '990PF'").select(
        "object_id", "funder_ein", "return_version", parsed, stated.alias("reported_paid"), (parsed - stated).alias("delta"),
        pct.alias("delta_pct"), status.alias("status")
    )


def table_counts(filings: DataFrame) -> DataFrame:
    """Status of each Schedule I filing: its rows against the organizations it counts."""
    a, b = F.col("total_501c3"), F.col("total_other")
    total = F.when(a.isNull() & b.isNull(), None).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    delta = F.col("n_rows") - total
    status = F.when(total.isNull(), "no_count").when(delta == 0, "exact").otherwise("mismatch")
    return filings.filter("return_type = '990'").select(
        "object_id", "funder_ein", "return_version", F.col("n_rows").alias("parsed_rows"), total.alias("reported_total"),
        delta.alias("delta"), status.alias("status")
    )


def missing_detail(filings: DataFrame) -> DataFrame:
    """Foundation filings without one itemized row, and why."""
    rows, stand_ins, stated = F.col("n_rows"), F.col("placeholder_rows"), F.coalesce("total_paid", F.lit(0))
    reason = (
        F.when(rows > stand_ins, None)
        .when((stated > 0) & (rows == 0), "no structured rows")
        .when(stated > 0, "only aggregate placeholder rows")
        .when(stand_ins > 0, "only aggregate placeholder rows, no stated total")
    )
    out = filings.filter("return_type = '990PF'").withColumn("reason", reason).filter("reason IS NOT NULL")
    return out.select(
        "object_id", "funder_ein", "funder_name", "return_version", F.col("total_paid").alias("reported_paid"),
        rows.alias("structured_rows"), stand_ins, "reason"
    )


def summary(totals: DataFrame, counts: DataFrame) -> DataFrame:
    """One row of counters and shares (null without a denominator)."""
    of = lambda s: F.count_if(F.col("status") == s)
    t = totals.agg(
        F.count(F.lit(1)).alias("pf_filings"),
        F.count_if(F.col("status").isin("within_tolerance", "over_tolerance")).alias("pf_with_total"),
        of("within_tolerance").alias("pf_within"), of("no_total").alias("pf_no_total")
    )
    c = counts.agg(F.count(F.lit(1)).alias("table_filings"), of("exact").alias("table_exact"), of("no_count").alias("table_no_count"))
    both = t.join(F.broadcast(c))  # one row each
    return both.withColumns(
        {
            "pf_share": share(F.col("pf_within"), F.col("pf_with_total")),
            "table_share": share(F.col("table_exact"), F.col("table_filings") - F.col("table_no_count"))
        }
    )


def coverage(filings: DataFrame, fields: dict[str, Callable[[dict[str, Column]], Column]], required: Column) -> DataFrame:
    """For each version and form: filings, filings with rows, how many have each field at least once, and how many have all that is required.

    filings: of filed(); fields: what makes a row (its as_filed() columns) have a field; required: over the per-filing flags named as the fields."""
    def any_row(has: Callable[[dict[str, Column]], Column]) -> Column:
        return F.coalesce(F.exists("rows", lambda r: F.coalesce(has(as_filed(r)), F.lit(False))), F.lit(False))

    some = {k: any_row(has) for k, has in fields.items()}
    flags = filings.select("return_version", "return_type", (F.size("rows") > 0).alias("_has"), *[v.alias(k) for k, v in some.items()])
    per = flags.withColumn("_full", F.coalesce(required, F.lit(False)))
    every = F.lit(True)
    for k in fields:
        every = every & F.col(k)
    out = per.groupBy("return_version", "return_type").agg(
        F.count(F.lit(1)).alias("filings"), F.count_if(F.col("_has")).alias("with_rows"), *[F.count_if(F.col(k)).alias(k) for k in fields],
        F.count_if("_full").alias("fully_resolved"), F.count_if(every).alias("all_common"),
    )
    return out.withColumn("percent", F.when(F.col("with_rows") > 0, F.round(100.0 * F.col("fully_resolved") / F.col("with_rows"), 2)))


def headline(cov: DataFrame) -> DataFrame:
    """Filings with rows whose required fields all resolve, in percent; 0 without any."""
    return cov.agg(F.coalesce(share(F.sum("fully_resolved"), F.sum("with_rows")), F.lit(0.0)).alias("percent"))


def path_versions(inventory: DataFrame) -> DataFrame:
    """Each path's versions, joined, and how many filings have it. inventory: object_id, return_version, paths."""
    one = inventory.select("return_version", F.explode("paths").alias("path")).groupBy("path", "return_version").agg(F.count(F.lit(1)).alias("n"))
    return versions_of(one)


def versions_of(counts: DataFrame) -> DataFrame:
    """The same from counts by path and return_version (n), of which there may be several for one pair."""
    one = counts.groupBy("path", "return_version").agg(F.sum("n").alias("n"))
    return one.groupBy("path").agg(F.concat_ws(";;", F.sort_array(F.collect_set("return_version"))).alias("versions"), F.sum("n").alias("filings"))


def unmapped(paths: DataFrame, consumed: DataFrame) -> DataFrame:
    """Observed paths that extraction doesn't read, the most frequent first."""
    return paths.join(consumed.select("path"), "path", "left_anti").orderBy(F.col("filings").desc(), "path")


def present_in_version(paths: DataFrame, inventories: DataFrame) -> DataFrame:
    """paths (path, return_version) with `present`: true, false, or null where no inventory of the version exists."""
    known = inventories.select(F.col("return_version").alias("_v")).distinct()
    hits = inventories.select(F.col("path").alias("_p"), F.col("return_version").alias("_hv")).distinct()
    j = paths.join(known, F.col("return_version") == F.col("_v"), "left").join(
        hits, (F.col("path") == F.col("_p")) & (F.col("return_version") == F.col("_hv")), "left"
    )
    return j.select("path", "return_version", F.when(F.col("_v").isNotNull(), F.col("_p").isNotNull()).alias("present"))


def evaluation(answered: DataFrame) -> DataFrame:
    """For each tier: pairs, resolved, correct, precision. answered: tier, ein, expected_ein."""
    resolved = F.col("ein").isNotNull()
    out = answered.groupBy("tier").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(resolved).alias("resolved"),
        F.count_if(F.col("ein") == F.col("expected_ein")).alias("correct")
    )
    return out.withColumn("precision", F.try_divide(F.col("correct").cast("double"), F.col("resolved")))


def overall(answered: DataFrame) -> DataFrame:
    """Recall over pairs that expect a number, abstention over those that don't."""
    hit, expects, none = F.col("ein") == F.col("expected_ein"), F.col("expected_ein").isNotNull(), F.col("expected_ein").isNull()
    n = answered.agg(
        F.count_if(hit).alias("recalled"), F.count_if(expects).alias("with_expected"),
        F.count_if(none & (F.col("tier") == "U")).alias("abstained"), F.count_if(none).alias("without_expected")
    )
    return n.withColumns(
        {
            "recall": F.try_divide(F.col("recalled").cast("double"), "with_expected"),
            "abstention": F.try_divide(F.col("abstained").cast("double"), "without_expected")
        }
    )


def misses(answered: DataFrame) -> DataFrame:
    """Labelled pairs that were resolved, but to something else than expected."""
    return answered.filter(F.col("ein").isNotNull() & ~F.col("ein").eqNullSafe(F.col("expected_ein")))


def matching_failures(tiers: dict[str, float | None], pairs: int, targets: dict[str, float] = TARGETS, least: int = LEAST_PAIRS) -> list[str]:
    """Why matching may not be published; a tier without rows doesn't fail."""
    out = [f"{pairs} labelled pairs, {least} needed"] if pairs < least else []
    return out + [
        f"tier {t}: precision {p:.3f}, target {targets[t]:.2f}" for t,
        p in sorted(tiers.items()) if t in targets and p is not None and p < targets[t]
    ]


def coverage_passes(percent: float) -> bool:
    return percent >= COVERAGE_GATE


def totals_pass(shares: list[float | None]) -> bool:
    """The worst year decides; years without totals don't count."""
    known = [s for s in shares if s is not None]
    return not known or min(known) >= TOTALS_GATE


def matching_status(pairs: int, least: int = LEAST_PAIRS) -> str:
    return "precision_verified" if pairs >= least else "precision_unverified"


def evaluation_report(tiers: list[dict], recall: float | None, abstention: float | None, failures: list[str]) -> str:
    """The evaluation as Markdown."""
    pct = lambda v: "n/a" if v is None else f"{100 * v:.1f}%"
    lines = ["# Evaluation of matching", "", "| Tier | Resolved | Correct | Precision | Target | Status |", "|---|---|---|---|---|---|"]
    for t in tiers:
        target = TARGETS.get(t["tier"])
        if target is not None:
            status = "no rows" if t["precision"] is None else "meets" if t["precision"] >= target else "**BELOW**"
            lines.append(f"| {t['tier']} | {t['resolved']:,} | {t['correct']:,} | {pct(t['precision'])} | {target:.0%} | {status} |")
    lines += [
        "", f"- Recall: {pct(recall)}", f"- Abstention: {pct(abstention)}", "", "## Gate: " + ("FAIL" if failures else "PASS"),
        *[f"- {f}" for f in failures]
    ]
    return "\n".join(lines) + "\n"
