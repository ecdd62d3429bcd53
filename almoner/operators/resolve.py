"""Recipients matched to registered organizations: block, compare, score, and abstain when in doubt.

Six equality joins find candidates (never one join on alternatives, which would be a nested loop); a pair that
several of them find is compared once. Candidates are scored by name and place into tiers; the best one counts only
if it is clear of the second. Rows: distinct tuples of name_normalized, name_raw, city, state, zip5, ein_reported,
recipient_type.
"""

from __future__ import annotations

import operator
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almoner.functions.names import first_token, is_chapter, squash, valid_ein
from almoner.functions.similarity import jaro_winkler, phonetic_key
from almoner.operators.relational import anti_null_safe, latest_per_key
from almoner.sources.shared import exists, replace, written

TUPLE = ["name_normalized", "name_raw", "city", "state", "zip5", "ein_reported", "recipient_type"]
#: How edges name a tuple's columns.
EDGE_COLUMNS = {
    "name_normalized": "recipient_name_normalized", "name_raw": "recipient_name_raw", "city": "recipient_city",
    "state": "recipient_state", "zip5": "recipient_zip5", "ein_reported": "recipient_ein_reported"
}
ANSWER = ["ein", "source", "confidence", "tier", "method", "bmf_name", "ntee_code", "subsection_code"]

# Thresholds, bands and steps of confidence.
STRONG, PROBABLE, CANDIDATES, MARGIN, CHAPTER_CONFIDENCE = 0.94, 0.90, 50, 0.03, 0.80
B_BAND, C_BAND, D_BAND = (0.90, 0.94), (0.75, 0.89), (0.50, 0.74)
SOURCES = {"B": "bmf_deterministic", "C": "bmf_strong", "D": "bmf_probable"}


@F.arrow_udf(T.DoubleType())
def round2(x: pa.Array) -> pa.Array:
    """Two decimals, ties by the binary value (the built-in rounds the shortest decimal form up)."""
    return pa.array([None if v is None else round(v, 2) for v in x.to_pylist()], pa.float64())


def with_id(tuples: DataFrame) -> DataFrame:
    return tuples.withColumn("idx", F.xxhash64(*[F.struct(F.col(c).isNull(), c) for c in TUPLE]))


def pending(tuples: DataFrame, stored: DataFrame, again_unresolved: bool = False) -> DataFrame:
    """Distinct tuples without a stored answer; unresolved answers may be asked again."""
    kept = stored.filter("tier <> 'U'") if again_unresolved else stored
    clean = tuples.withColumn("name_normalized", F.coalesce("name_normalized", F.lit("")))
    return anti_null_safe(clean.select(*TUPLE).distinct(), kept.select(*[F.col(c).alias(c) for c in TUPLE]), TUPLE)


def with_aliases(tuples: DataFrame, aliases: DataFrame | None) -> DataFrame:
    """The canonical name of each name that has one, from alias_normalized and canonical_normalized."""
    if aliases is None:
        return tuples.withColumn("alias", F.lit(None).cast("string"))
    known = last_of(aliases, ["alias_normalized"], "canonical_normalized")
    known = known.select(F.col("alias_normalized").alias("name_normalized"), F.col("canonical_normalized").alias("alias"))
    return tuples.join(known, "name_normalized", "left")


def candidates(probes: DataFrame, registry: DataFrame, phonetic: bool = True) -> DataFrame:
    """Distinct idx and ein of the pairs that agree on a blocking key."""
    p = probes.withColumn("first_token", first_token(F.col("name_normalized")))
    r = registry.withColumnRenamed("ein", "c_ein")
    sides = [
        (["name_normalized"], ["name_normalized"]),
        (["name_normalized"], ["sort_name_normalized"]),
        (["alias"], ["name_normalized"]),
        (["state", "first_token"], ["state", "first_token"]),
        (["zip5", "first_token"], ["zip5", "first_token"]),
    ]
    if phonetic:
        p = p.withColumn("phonetic", phonetic_key(F.col("name_normalized")))
        r = r if "phonetic" in r.columns else r.withColumn("phonetic", phonetic_key(F.col("name_normalized")))
        sides.append((["state", "phonetic"], ["state", "phonetic"]))
    blocks = []
    for mine, theirs in sides:
        left = p.select("idx", *[F.nullif(F.col(c), F.lit("")).alias(f"k{i}") for i, c in enumerate(mine)]).dropna()
        right = r.select("c_ein", *[F.nullif(F.col(c), F.lit("")).alias(f"k{i}") for i, c in enumerate(theirs)]).dropna()
        blocks.append(left.join(right, [f"k{i}" for i in range(len(mine))]).select("idx", F.col("c_ein").alias("ein")))
    found = blocks[0]
    for b in blocks[1:]:
        found = found.unionByName(b)
    return found.dropDuplicates(["idx", "ein"])


def may_reach(a: Column, b: Column, least: float) -> Column:
    """Whether the lengths and common first letters of two names allow a Jaro-Winkler similarity of `least`.

    With l common first letters (4 at most) the Jaro similarity j must be (least - 0.1 l) / (1 - 0.1 l) or more, and j is at
    most (2 + shorter/longer) / 3."""
    same = lambda n: (F.substring(a, 1, n) == F.substring(b, 1, n)) & (F.length(a) >= n) & (F.length(b) >= n)
    common = F.when(same(4), 4).when(same(3), 3).when(same(2), 2).when(same(1), 1).otherwise(0)
    jaro = (F.lit(least) - 0.1 * common) / (F.lit(1.0) - 0.1 * common)
    return 3 * jaro <= 2 + F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1)) + 1e-9


def compared(pairs: DataFrame, probes: DataFrame, registry: DataFrame, most: int = CANDIDATES) -> DataFrame:
    """Pairs whose names are similar enough, at most `most` for each probe, with both sides' columns."""
    c = registry.select(
        *[
            F.col(x).alias(f"c_{x}") for x in (
                "ein", "name", "name_normalized", "sort_name_normalized", "city", "state", "zip5", "ntee_code", "subsection_code"
            )
        ]
    )
    both = pairs.join(probes, "idx").join(c, F.col("ein") == F.col("c_ein")).drop("ein")
    zero = F.lit(0.0)
    sim = F.greatest(
        jaro_winkler(F.col("name_normalized"), F.col("c_name_normalized")),
        F.coalesce(jaro_winkler(F.col("name_normalized"), F.col("c_sort_name_normalized")), zero),
        F.coalesce(jaro_winkler(F.col("alias"), F.col("c_name_normalized")), zero),
    )
    # most pairs of a block can't be similar enough by their lengths and first letters, and never reach Python
    forms = [("name_normalized", "c_name_normalized"), ("name_normalized", "c_sort_name_normalized"), ("alias", "c_name_normalized")]
    may = reduce(operator.or_, [F.coalesce(may_reach(F.col(a), F.col(b), PROBABLE), F.lit(False)) for a, b in forms])
    near = both.filter(may).withColumn("sim", sim).filter(F.col("sim") >= PROBABLE)
    w = Window.partitionBy("idx").orderBy(F.col("sim").desc(), "c_ein")
    return near.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= most).drop("_k")


def scored(pairs: DataFrame) -> DataFrame:
    """tier, confidence and method of each compared pair; pairs that earn none are dropped."""
    stated = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    both = lambda c: stated(c) & stated(f"c_{c}")
    name_in = lambda c: F.coalesce(
        (F.col(c) == F.col("c_name_normalized")) | F.col(c).eqNullSafe(F.col("c_sort_name_normalized")), F.lit(False)
    ) & F.col(c).isNotNull()
    exact = name_in("name_normalized") | name_in("alias")
    zip_agrees, zip_differs = both("zip5") & (F.col("zip5") == F.col("c_zip5")), both("zip5") & (F.col("zip5") != F.col("c_zip5"))
    city_agrees = both("city") & (squash(F.col("city")) == squash(F.col("c_city")))
    city_differs = both("city") & ~city_agrees
    raw_exact = stated("name_raw") & (squash(F.col("name_raw")) == squash(F.col("c_name")))
    in_state = both("state")
    step = lambda condition, by: F.when(condition, by).otherwise(0.0)
    sim = F.col("sim")
    rules = [
        (exact & zip_agrees & in_state, "B", B_BAND, 0.90 + step(city_agrees, 0.02) + step(raw_exact, 0.02), "name_zip5_state_exact"),
        (
            exact & in_state, "C", C_BAND,
            0.80 + step(city_agrees, 0.05) + step(raw_exact, 0.04) + step(zip_differs, -0.03) + step(city_differs, -0.02),
            "name_state_exact"
        ),
        (exact, "D", D_BAND, 0.70 + step(zip_differs, -0.03), "name_exact_no_state"),
        (
            (sim >= STRONG) & zip_agrees & in_state, "C", C_BAND,
            0.75 + (sim - STRONG) / F.lit(1.0 - STRONG) * 0.08 + step(city_agrees, 0.06), "name_jw_zip5"
        ),
        (
            in_state, "D", D_BAND,
            0.50 + (sim - PROBABLE) / F.lit(1.0 - PROBABLE) * 0.24 + step(zip_differs, -0.03) + step(city_differs, -0.02),
            "name_jw_state"
        ),
    ]
    tier = confidence = method = F.lit(None)
    for condition, t, (low, high), value, how in reversed(rules):
        tier = F.when(condition, t).otherwise(tier)
        confidence = F.when(condition, F.least(F.greatest(value, F.lit(low)), F.lit(high))).otherwise(confidence)
        method = F.when(condition, how).otherwise(method)
    out = pairs.filter(~(both("state") & (F.col("state") != F.col("c_state"))))
    out = out.withColumns(
        {"tier": tier, "confidence": confidence, "method": method, "_placed": zip_agrees | city_agrees}
    ).filter(F.col("tier").isNotNull())
    out = out.withColumn("confidence", round2(F.col("confidence")))
    capped = is_chapter(F.col("name_normalized")) & ~F.col("_placed") & (
        (F.col("tier") == "B") | ((F.col("tier") == "C") & (F.col("confidence") > CHAPTER_CONFIDENCE))
    )
    return out.withColumns({
        "tier": F.when(capped, "C").otherwise(F.col("tier")),
        "confidence": F.when(capped, CHAPTER_CONFIDENCE).otherwise(F.col("confidence")),
        "method": F.when(capped, F.concat("method", F.lit("+chapter_capped"))).otherwise(F.col("method")),
    }).drop("_placed")


def resolve(
    tuples: DataFrame, registry: DataFrame, aliases: DataFrame | None = None, corrections: DataFrame | None = None, revoked: DataFrame | None = None, phonetic: bool = True
) -> DataFrame:
    """Every tuple with the columns of ANSWER."""
    probes = with_aliases(with_id(tuples.select(*TUPLE)), aliases)
    guarded = F.col("recipient_type").isin("individual", "government") | valid_ein(F.col("ein_reported")).isNotNull()
    open_ = probes.filter(~F.coalesce(guarded, F.lit(False)) & (F.coalesce("name_normalized", F.lit("")) != ""))
    near = compared(candidates(open_, registry, phonetic), open_, registry)
    w = Window.partitionBy("idx").orderBy(F.col("confidence").desc(), "c_ein")
    ranked = scored(near).withColumns(
        {"_n": F.count(F.lit(1)).over(Window.partitionBy("idx")), "_rn": F.row_number().over(w), "_second": F.lead("confidence").over(w)}
    )
    best = ranked.filter("_rn = 1").select(
        "idx", "_n", "_second", *[F.col(c).alias(f"_{c}") for c in ("tier", "confidence", "method")],
        *[F.col(f"c_{c}").alias(f"_{c}") for c in ("ein", "name", "ntee_code", "subsection_code")]
    )
    some = near.select("idx").distinct().withColumn("_near", F.lit(True))
    reported = registry.select(
        F.col("ein").alias("_r_ein"), F.col("name").alias("_r_name"), F.col("ntee_code").alias("_r_ntee"),
        F.col("subsection_code").alias("_r_sub")
    )
    t = probes.withColumn("_valid", valid_ein(F.col("ein_reported")))
    t = t.join(reported, F.col("_valid") == F.col("_r_ein"), "left").join(best, "idx", "left").join(some, "idx", "left")
    if revoked is not None:
        t = t.join(revoked.select(F.col("ein").alias("_valid")).distinct().withColumn("_revoked", F.lit(True)), "_valid", "left")
    else:
        t = t.withColumn("_revoked", F.lit(None).cast("boolean"))
    person = F.col("recipient_type").isin("individual", "government")
    stated, known = F.col("_valid").isNotNull(), F.col("_r_ein").isNotNull()
    why_not = (
        F.when(person, F.concat(F.lit("recipient_type_"), "recipient_type"))
        .when(stated, None)
        .when((F.coalesce("name_normalized", F.lit("")) == "") | F.col("_near").isNull(), "no_candidates")
        .when(F.col("_n").isNull(), "no_candidate_above_threshold")
        .when(
            (F.col("_n") > 1) & (F.col("_confidence") - F.col("_second") < MARGIN),
            F.concat(F.lit("ambiguous_"), F.col("_n").cast("string"), F.lit("_candidates"))
        )
        .when((F.col("_n") > 1) & (F.col("_tier") == "D"), "probable_not_unique")
    )
    t = t.withColumn("_why", why_not)
    none, stated = F.col("_why").isNotNull(), stated & ~F.coalesce(person, F.lit(False))
    sources = F.create_map(*[F.lit(x) for pair in SOURCES.items() for x in pair])
    pick = lambda unresolved, a_known, a_other, found: F.when(none, unresolved).when(stated & known, a_known).when(stated, a_other).otherwise(found)
    null = F.lit(None)
    out = t.select(
        *TUPLE,
        pick(null, F.col("_valid"), F.col("_valid"), F.col("_ein")).alias("ein"),
        pick(F.lit("unresolved"), F.lit("reported_verified"), F.lit("reported_unverified"), F.element_at(sources, F.col("_tier"))).alias("source"),
        pick(null, F.lit(1.0), F.lit(0.95), F.col("_confidence")).alias("confidence"),
        pick(F.lit("U"), F.lit("A"), F.lit("A"), F.col("_tier")).alias("tier"),
        pick(
            F.col("_why"), F.lit("reported_ein_in_bmf"),
            F.when(F.col("_revoked"), "reported_ein_revoked").otherwise("reported_ein_not_in_bmf"), F.col("_method")
        ).alias("method"),
        pick(null, F.col("_r_name"), null, F.col("_name")).alias("bmf_name"),
        pick(null, F.col("_r_ntee"), null, F.col("_ntee_code")).alias("ntee_code"),
        pick(null, F.col("_r_sub"), null, F.col("_subsection_code")).alias("subsection_code"),
    )
    return corrected(out, corrections) if corrections is not None else out


def last_of(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row for each key: the last by `row` where df has it, else the largest value."""
    return latest_per_key(df, keys, [F.col("row" if "row" in df.columns else value).desc_nulls_last()])


def corrected(answers: DataFrame, corrections: DataFrame) -> DataFrame:
    """Manual corrections by (name, state, zip5), null for null, override everything. What the registry says of the number
    isn't filled in, as nobody has checked that it has it. Of several corrections the last counts (by `row`, else by number)."""
    fix = last_of(corrections, ["recipient_name_normalized", "state", "zip5"], "ein")
    fix = fix.select(
        F.col("recipient_name_normalized").alias("_name"), F.col("state").alias("_state"), F.col("zip5").alias("_zip"),
        F.col("ein").alias("_fix")
    )
    on = F.col("name_normalized").eqNullSafe(F.col("_name")) & F.col("state").eqNullSafe(F.col("_state")) & F.col("zip5").eqNullSafe(F.col("_zip"))
    t = answers.join(fix, on, "left")
    hit = F.col("_fix").isNotNull()
    new = {
        "ein": F.col("_fix"), "source": F.lit("manual_correction"), "confidence": F.lit(1.0), "tier": F.lit("A"),
        "method": F.lit("manual_correction")
    }
    return t.select(*TUPLE, *[F.when(hit, new.get(c, F.lit(None))).otherwise(F.col(c)).alias(c) for c in ANSWER])


def apply_answers(edges: DataFrame, answers: DataFrame, renamed: dict[str, str]) -> DataFrame:
    """Edges with the answers to their tuples; `renamed` maps a tuple's columns to the edges'. Other edges keep what they had."""
    a = answers.select(*[F.col(c).alias(f"_t_{c}") for c in TUPLE], *[F.col(c).alias(f"_a_{c}") for c in ANSWER])
    on = None
    for c in TUPLE:
        same = F.col(renamed.get(c, c)).eqNullSafe(F.col(f"_t_{c}"))
        on = same if on is None else on & same
    joined = edges.join(a, on, "left")
    into = {
        "ein": "recipient_ein_resolved", "source": "recipient_ein_source", "confidence": "match_confidence", "tier": "match_tier",
        "method": "match_method", "bmf_name": "recipient_bmf_name", "ntee_code": "recipient_ntee_code",
        "subsection_code": "recipient_subsection_code"
    }
    values = {
        into[c]: F.when(
            F.col("_a_tier").isNull(), F.col(into[c]) if into[c] in edges.columns else F.lit(None)
        ).otherwise(F.col(f"_a_{c}")) for c in ANSWER
    }
    return joined.select(
        *[values.pop(c).alias(c) if c in values else F.col(c) for c in edges.columns],
        *[v.alias(c) for c, v in list(values.items())]
    )


#: A stored answer: the tuple, what was answered, from which registry, and when.
STORED = ", ".join(
    [
        *[f"{c} string" for c in TUPLE], *[f"{c} {'double' if c == 'confidence' else 'string'}" for c in ANSWER],
        "bmf_vintage string", "resolved_at timestamp"
    ]
)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The answers stored so far (none: an empty table)."""
    if exists(spark, path):
        return spark.read.schema(STORED).parquet(path)
    return spark.createDataFrame([], STORED)


def store(answers: DataFrame, path: str, vintage: str, at: datetime) -> None:
    """Append answers. Nothing is stored twice, as pending() leaves out what is there."""
    stamped = answers.withColumns({"bmf_vintage": F.lit(vintage), "resolved_at": F.lit(at)})
    stamped.select(*[F.col(c).cast(t) for c, t in (x.split() for x in STORED.split(", "))]).write.mode("append").parquet(path)


def forget_unresolved(spark: SparkSession, path: str) -> None:
    """Drop stored answers of tier U, so that they are asked again: the others are written beside, then take the place."""
    if exists(spark, path):
        stored(spark, path).filter("tier <> 'U'").write.parquet(f"{path}.next")
        replace(spark, f"{path}.next", path)


def tuples_of(edges: DataFrame, renamed: dict[str, str]) -> DataFrame:
    """The distinct tuples of edges; `renamed` maps a tuple's columns to the edges'."""
    return edges.select(*[F.col(renamed.get(c, c)).alias(c) for c in TUPLE]).withColumn(
        "name_normalized", F.coalesce("name_normalized", F.lit(""))
    ).distinct()


def resolve_edges(
    edges: DataFrame, registry: DataFrame, answers: str, vintage: str, at: datetime, renamed: dict[str, str] = EDGE_COLUMNS,
    aliases: DataFrame | None = None, corrections: DataFrame | None = None,
    again_unresolved: bool = False, phonetic: bool = True, chunks: int = 1,
) -> DataFrame:
    """Edges with the answers to all their tuples; what isn't stored yet (at `answers`) is resolved and stored.

    Tuples are resolved in `chunks` jobs by hash, each stored as it ends: a run that dies resumes after the last one.
    An empty registry is refused. The edges' rows stay as many as they were."""
    spark = edges.sparkSession
    require_registry(registry)
    if again_unresolved:
        forget_unresolved(spark, answers)
    open_ = written(with_id(pending(tuples_of(edges, renamed), stored(spark, answers))))
    for k in range(chunks):
        part = open_.filter(F.pmod(F.col("idx"), F.lit(chunks)) == k) if chunks > 1 else open_
        store(resolve(part.drop("idx"), registry, aliases, corrections, phonetic=phonetic), answers, vintage, at)
    name = renamed.get("name_normalized", "name_normalized")
    return apply_answers(edges.withColumn(name, F.coalesce(name, F.lit(""))), stored(spark, answers), renamed)


def require_registry(registry: DataFrame) -> None:
    if registry.isEmpty():
        raise ValueError("the registry is empty: load one before resolving recipients")


def is_valid(c: Column) -> Column:
    return valid_ein(c).isNotNull()
