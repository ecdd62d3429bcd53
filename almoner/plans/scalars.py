"""Queries over the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from almoner.functions import formats, names, similarity, values
from almoner.plans.analogs import analog, ctes, edges, table
from almoner.plans.register import query

#: Names as filed, made from part and customer names.
RAW_NAMES = """
SELECT p_partkey AS id, CASE p_partkey % 12 WHEN 0 THEN 'The ' || p_name || ' Foundation, Inc.' WHEN 1 THEN p_name || ' & Sons Incorporated' WHEN 2 THEN 'Saint ' || p_name || ' Children''s Society'
  WHEN 3 THEN p_name || ' dba ' || p_brand || ' Corp.' WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'YMCA of ' || p_name WHEN 7 THEN p_name || '-UNIVERSITY/ASSOCIATION INC INC'
  WHEN 8 THEN 'The' WHEN 9 THEN '  United  Way of ' || p_name || '  ' WHEN 10 THEN 'd/b/a ' || p_type || ' A.K.A ' || p_name || ',;' ELSE p_name END AS raw,
  CASE p_partkey % 7 WHEN 0 THEN '94022-' || CAST(p_partkey AS STRING) WHEN 1 THEN '123' WHEN 2 THEN NULL WHEN 3 THEN ' 0 1 2 3 4 ' ELSE CAST(p_partkey + 10000 AS STRING) END AS zip,
  CASE p_partkey % 6 WHEN 0 THEN '12-' || lpad(CAST(p_partkey AS STRING), 7, '0') WHEN 1 THEN '000000000' WHEN 2 THEN NULL WHEN 3 THEN '12345' WHEN 4 THEN lpad(CAST(p_partkey AS STRING), 8, '1') ELSE lpad(CAST(p_partkey AS STRING), 10, '7') END AS ein,
  CASE p_partkey % 9 WHEN 0 THEN '$1,' || lpad(CAST(p_partkey % 1000 AS STRING), 3, '0') WHEN 1 THEN '(' || CAST(p_partkey AS STRING) || ')' WHEN 2 THEN 'N/A' WHEN 3 THEN NULL WHEN 4 THEN CAST(p_partkey AS STRING) || '.00' WHEN 5 THEN '' WHEN 6 THEN CAST(p_partkey AS STRING) || '.5' WHEN 7 THEN 'inf' ELSE ' ' || CAST(p_partkey AS STRING) || ' ' END AS amount,
  CASE p_partkey % 6 WHEN 0 THEN '2022-12-31' WHEN 1 THEN '2023' WHEN 2 THEN '2023-02-30' WHEN 3 THEN '12/31/2022' WHEN 4 THEN NULL ELSE '2021-06-30T00:00:00' END AS stamp, p_size, p_retailprice
FROM {part}
"""
DUCK_NAMES = "WITH raw_names AS (" + RAW_NAMES.replace("{part}", "part").replace("AS STRING", "AS VARCHAR") + ")"

DUCK_CANON = "trim(regexp_replace(regexp_replace(replace(replace(replace(replace(upper(coalesce(raw, '')), '&', ' AND '), '''', ''), '’', ''), '‘', ''), '[^A-Z0-9 ]+', ' ', 'g'), '\\s+', ' ', 'g'))"
_words = f"regexp_replace({DUCK_CANON}, '^THE( |$)', '')"
for _long, _short in names.CANONICAL_WORDS.items():
    _words = f"regexp_replace({_words}, '\\b{_long}\\b', '{_short}', 'g')"
DUCK_NORMALIZED = f"regexp_replace({_words}, '(?:^| )INC(?: INC)*$', '')"


def raw_names(spark, sf_dir):
    return spark.sql(RAW_NAMES, part=table(spark, sf_dir, "part"))


@query("f01_normalize_name", f"{DUCK_NAMES} SELECT id, {DUCK_NORMALIZED} AS normalized FROM raw_names")
def f01(spark, sf_dir):
    return raw_names(spark, sf_dir).select("id", names.normalize_name(F.col("raw")).alias("normalized"))


@query(
    "f02_split_aliases",
    f"{DUCK_NAMES} SELECT id, list_filter(list_transform(string_split_regex(coalesce(raw, ''), '(?i)\\b(?:D/?B/?A|A/?K/?A|F/?K/?A)\\b\\.?'), lambda x: trim(x, ' ,;-')), lambda x: x <> '') AS aliases FROM raw_names",
)
def f02(spark, sf_dir):
    return raw_names(spark, sf_dir).select("id", names.split_aliases(F.col("raw")).alias("aliases"))


@query("f03_chapter_names", f"{DUCK_NAMES} SELECT id, regexp_matches({DUCK_NORMALIZED}, '{names.CHAPTER_PATTERN}') AS chapter FROM raw_names")
def f03(spark, sf_dir):
    return raw_names(spark, sf_dir).select("id", names.is_chapter(names.normalize_name(F.col("raw"))).alias("chapter"))


@query(
    "f04_f09_codes",
    DUCK_NAMES
    + r""", d AS (SELECT *, regexp_replace(zip, '\D', '', 'g') AS zd, regexp_replace(ein, '\D', '', 'g') AS ed FROM raw_names)
SELECT id, CASE WHEN length(zd) >= 5 THEN substr(zd, 1, 5) END AS zip5, CASE WHEN length(ed) = 9 AND ed <> '000000000' THEN ed END AS valid_ein,
       CASE WHEN length(ed) BETWEEN 8 AND 9 THEN lpad(ed, 9, '0') ELSE ed END AS header_ein,
       regexp_replace(upper(coalesce(raw, '')), '[^A-Z0-9]+', '', 'g') AS squashed, nullif(split_part("""
    + DUCK_NORMALIZED
    + r""", ' ', 1), '') AS first_token, nullif(trim(raw), '') AS cleaned FROM d""",
)
def f04(spark, sf_dir):
    raw = F.col("raw")
    return raw_names(spark, sf_dir).select(
        "id", names.zip5(F.col("zip")).alias("zip5"), names.valid_ein(F.col("ein")).alias("valid_ein"),
        names.padded_ein(F.col("ein")).alias("header_ein"),
        names.squash(raw).alias("squashed"), names.first_token(names.normalize_name(raw)).alias("first_token"), names.clean(raw).alias("cleaned"),
    )


@query("f05_tax_year", ctes("edges") + " SELECT grant_id, CAST(year(tax_period_end) AS INTEGER) AS year FROM edges")
def f05(spark, sf_dir):
    return edges(spark, sf_dir).select("grant_id", names.tax_year(F.col("tax_period_end")).alias("year"))


@query(
    "f08_clamp",
    "SELECT s_suppkey, round(least(greatest(s_acctbal / 10000, 0.5), 0.89), 2) AS clamped FROM (SELECT s_suppkey, CAST(floor(s_acctbal) AS DOUBLE) AS s_acctbal FROM supplier)"
)
def f08(spark, sf_dir):
    x = F.floor("s_acctbal").cast("double") / 10000
    return table(spark, sf_dir, "supplier").select("s_suppkey", names.clamp(x, F.lit(0.5), F.lit(0.89)).alias("clamped"))


@query(
    "f10_f12_jaro_winkler",
    ctes("registry", "probes")
    + """ SELECT p.expected_ein, p.name_normalized, round(greatest(jaro_winkler_similarity(p.name_normalized, r.name_normalized), coalesce(jaro_winkler_similarity(p.name_normalized, r.sort_name_normalized), 0.0)), 6) AS sim
FROM probes p JOIN registry r ON p.expected_ein = r.ein""",
)
def f10(spark, sf_dir):
    p, r = analog(spark, sf_dir, "probes"), analog(spark, sf_dir, "registry").select(
        "ein", F.col("name_normalized").alias("candidate"), "sort_name_normalized"
    )
    sim = similarity.best_similarity(F.col("name_normalized"), F.col("sort_name_normalized"), F.lit(None).cast("string"), F.col("candidate"))
    return p.join(r, F.col("expected_ein") == F.col("ein")).select("expected_ein", "name_normalized", F.round(sim, 6).alias("sim"))


@query("f11_phonetic_key")
def f11(spark, sf_dir):
    return analog(spark, sf_dir, "registry").select("ein", similarity.phonetic_key(F.col("name_normalized")).alias("phonetic"))


@query(
    "f13_grant_id",
    "SELECT o_orderkey, substr(sha256(CAST(o_orderkey AS VARCHAR) || ':pf_paid:' || CAST(o_custkey % 5 AS VARCHAR)), 1, 32) AS grant_id FROM orders"
)
def f13(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", values.grant_id(F.col("o_orderkey").cast("string"), F.lit("pf_paid"), F.col("o_custkey") % 5).alias("grant_id"))


@query(
    "f14_f15_dates",
    DUCK_NAMES + r" SELECT id, CASE WHEN regexp_matches(stamp, '^\d{4}-\d{2}-\d{2}$') THEN TRY_CAST(stamp AS DATE) END AS submitted, CASE WHEN regexp_matches(substr(stamp, 1, 10), '^\d{4}-\d{2}-\d{2}$') THEN TRY_CAST(substr(stamp, 1, 10) AS DATE) END AS period_end FROM raw_names",
)
def f14(spark, sf_dir):
    return raw_names(spark, sf_dir).select(
        "id", values.submission_date(F.col("stamp")).alias("submitted"), values.iso_date(F.col("stamp")).alias("period_end")
    )


@query(
    "f17_file_year",
    ctes("members") + r" SELECT object_id, TRY_CAST(nullif(regexp_extract(zip_file, '(\d{4})', 1), '') AS INTEGER) AS year FROM members"
)
def f17(spark, sf_dir):
    return analog(spark, sf_dir, "members").select("object_id", values.file_year(F.col("zip_file")).alias("year"))


@query("f18_seeded_order", "SELECT s_suppkey, row_number() OVER (ORDER BY sha256(s_name || 'seed')) AS place FROM supplier")
def f18(spark, sf_dir):
    from almoner.operators.relational import global_row_number

    s = table(spark, sf_dir, "supplier").select("s_suppkey", values.seeded_order(F.col("s_name"), "seed").alias("h"))
    return global_row_number(s, [F.col("h")], "place").select("s_suppkey", F.col("place").cast("long").alias("place"))


@query(
    "f19_f24_search_forms",
    DUCK_NAMES + " SELECT id, trim(regexp_replace(upper(coalesce(raw, '')), '[^A-Z0-9 ]+', ' ', 'g')) AS search_form, list_filter(string_split(regexp_replace(upper(coalesce(raw, '')), '[^A-Z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')[1:8] AS tokens FROM raw_names",
)
def f19(spark, sf_dir):
    return raw_names(spark, sf_dir).select(
        "id", names.search_form(F.col("raw")).alias("search_form"), names.search_tokens(F.col("raw")).alias("tokens")
    )


@query(
    "f20_ein_forms",
    DUCK_NAMES
    + r""", d AS (SELECT id, ein, regexp_replace(ein, '\D', '', 'g') AS ed FROM raw_names), c AS (SELECT *, CASE WHEN length(ed) BETWEEN 1 AND 9 THEN lpad(ed, 9, '0') END AS canonical FROM d)
SELECT id, canonical, substr(canonical, 1, 2) || '-' || substr(canonical, 3, 7) AS shown, coalesce(regexp_matches(ein, '^[0-9]{9}$'), false) AS is_canonical FROM c""",
)
def f20(spark, sf_dir):
    e = F.col("ein")
    return raw_names(spark, sf_dir).select(
        "id", names.canonical_ein(e).alias("canonical"), names.display_ein(e).alias("shown"),
        names.is_canonical_ein(e).alias("is_canonical")
    )


def _duck_scaled(unit: str, plain: str, letter: str) -> str:
    return f"'$' || CASE WHEN abs(v) >= {plain} THEN format('{{:.0f}}', round(v / {unit}, 0)) ELSE format('{{:.1f}}', round(v / {unit}, 1)) END || '{letter}'"


@query(
    "f21_shown_values",
    f"""WITH d AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_totalprice AS BIGINT) * CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN -1 WHEN 2 THEN 1000 WHEN 3 THEN 1000000 ELSE 0 END + o_orderkey % 900 END AS v,
  CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE 2010 + o_custkey % 3 END AS a, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 2012 END AS b FROM (SELECT o_orderkey, o_custkey, floor(o_totalprice) AS o_totalprice FROM orders))
SELECT id, coalesce(CASE WHEN v < 0 THEN '-$' ELSE '$' END || format('{{:,}}', abs(v)), '—') AS money, coalesce(format('{{:,}}', v), '—') AS counted,
  format('{{:,}}', id) || ' ' || CASE WHEN id = 1 THEN 'grant' ELSE 'grants' END AS plural,
  CASE WHEN coalesce(a, b) IS NULL THEN '' WHEN a IS NULL OR b IS NULL OR a = b THEN CAST(coalesce(b, a) AS VARCHAR) ELSE CAST(a AS VARCHAR) || '–' || CAST(b AS VARCHAR) END AS span FROM d""",
)
def f21(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    factor = F.element_at(F.array(*map(F.lit, (1, -1, 1000, 1000000, 0))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    v = F.when(F.col("o_orderkey") % 13 == 0, None).otherwise(F.floor("o_totalprice").cast("long") * factor + F.col("o_orderkey") % 900)
    d = o.select(
        F.col("o_orderkey").alias("id"), v.alias("v"),
        F.when(F.col("o_custkey") % 4 != 0, 2010 + F.col("o_custkey") % 3).alias("a"),
        F.when(F.col("o_custkey") % 5 != 0, F.lit(2012).cast("long")).alias("b")
    )
    return d.select(
        "id", formats.money(F.col("v")).alias("money"), formats.counted(F.col("v")).alias("counted"),
        formats.plural(F.col("id"), "grant").alias("plural"), formats.year_span(F.col("a"), F.col("b")).alias("span")
    )


def _tenths(unit: int) -> str:
    """x in tenths of the unit, ties away from zero, as text with one decimal place."""
    t = f"((x * 10 + {unit // 2}) // {unit})"
    return f"'$' || CAST({t} // 10 AS VARCHAR) || '.' || CAST({t} % 10 AS VARCHAR)"


def _wholes(unit: int) -> str:
    return f"'$' || CAST((x + {unit // 2}) // {unit} AS VARCHAR)"


@query("f21_compact", f"""WITH o AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS HUGEINT) * CAST(pow(10, o_orderkey % 6) AS HUGEINT) AS x FROM orders)
SELECT o_orderkey, CASE WHEN x >= 10000000000 THEN {_wholes(10**9)} || 'B' WHEN x >= 1000000000 THEN {_tenths(10**9)} || 'B' WHEN x >= 10000000 THEN {_wholes(10**6)} || 'M' WHEN x >= 1000000 THEN {_tenths(10**6)} || 'M'
  WHEN x >= 1000 THEN {_wholes(1000)} || 'K' ELSE '$' || CAST(x AS VARCHAR) END AS compact FROM o""")
def f21b(spark, sf_dir):
    amount = (F.floor("o_totalprice") * F.pow(F.lit(10), F.col("o_orderkey") % 6)).cast("long")
    return table(spark, sf_dir, "orders").select("o_orderkey", formats.compact_money(amount).alias("compact"))


@query("f21_nice_names")
def f21c(spark, sf_dir):
    return raw_names(spark, sf_dir).select(
        "id", formats.nice_name(F.col("raw")).alias("nice"), formats.shown_date(F.col("stamp")).alias("shown_date")
    )


@query(
    "f22_sum_of_known",
    ctes("edges") + " SELECT funder_ein, CAST(coalesce(sum(CASE WHEN recipient_ein_resolved IS NOT NULL THEN amount_usd END), 0) AS BIGINT) AS total FROM edges GROUP BY 1"
)
def f22(spark, sf_dir):
    known = F.when(F.col("recipient_ein_resolved").isNotNull(), F.col("amount_usd"))
    return edges(spark, sf_dir).groupBy("funder_ein").agg(F.coalesce(F.sum(known), F.lit(0)).alias("total"))


@query(
    "f23_joined_name",
    DUCK_NAMES + " SELECT id, nullif(concat_ws(' ', nullif(trim(raw), ''), nullif(trim(zip), '')), '') AS joined FROM raw_names"
)
def f23(spark, sf_dir):
    return raw_names(spark, sf_dir).select("id", names.joined_name(F.col("raw"), F.col("zip")).alias("joined"))


@query(
    "f25_json",
    'SELECT s_suppkey, \'{"ein":\' || CAST(s_suppkey AS VARCHAR) || \',"name":"\' || s_name || \'"}\' AS body, s_name AS decoded FROM supplier'
)
def f25(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(
        "s_suppkey", values.compact_json(F.struct(F.col("s_suppkey").alias("ein"), F.col("s_name").alias("name"))).alias("body")
    )
    return s.withColumn("decoded", F.from_json("body", "ein long, name string")["name"])


@query("f26_digests", "SELECT p_partkey, sha256(p_name) AS sha, md5(p_name) AS md5 FROM part")
def f26(spark, sf_dir):
    b = F.col("p_name").cast("binary")
    return table(spark, sf_dir, "part").select("p_partkey", F.sha2(b, 256).alias("sha"), F.md5(b).alias("md5"))


@query(
    "f27_version_strings",
    "SELECT s_suppkey, v, regexp_matches(v, '^\\d{4}\\.\\d{2}\\.\\d+$') AS valid FROM (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '2026.08.' || CAST(s_suppkey AS VARCHAR) WHEN 1 THEN 'v1' WHEN 2 THEN '2026.8.1' ELSE '2025.12.0' END AS v FROM supplier)",
)
def f27(spark, sf_dir):
    k = F.col("s_suppkey")
    v = F.when(k % 4 == 0, F.concat(F.lit("2026.08."), k.cast("string"))).when(k % 4 == 1, "v1").when(k % 4 == 2, "2026.8.1").otherwise("2025.12.0")
    return table(spark, sf_dir, "supplier").select("s_suppkey", v.alias("v"), values.is_version(v).alias("valid"))


@query(
    "f28_percent_off",
    "SELECT o_orderkey, CASE WHEN b = 0 THEN CASE WHEN a = 0 THEN 0.0 ELSE 'inf'::DOUBLE END ELSE 100.0::DOUBLE * abs(a - b) / b END AS pct FROM (SELECT o_orderkey, o_orderkey % 11 AS a, o_custkey % 5 AS b FROM orders)",
)
def f28(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", values.percent_off(F.col("o_orderkey") % 11, F.col("o_custkey") % 5).alias("pct"))


def _duck_case(column: str, labels: dict[str, str], other: str) -> str:
    text = lambda v: v.replace("'", "''")
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{text(v)}'" for k, v in labels.items()) + f" ELSE {other} END"


@query(
    "f29_field_labels",
    ctes("registry") + f" SELECT ein, {_duck_case('substr(ntee_code, 1, 1)', formats.FIELDS_OF_WORK, 'ntee_code')} AS field FROM registry"
)
def f29(spark, sf_dir):
    return analog(spark, sf_dir, "registry").select("ein", formats.field_of_work(F.col("ntee_code")).alias("field"))


@query(
    "f30_tier_labels",
    ctes("edges") + f" SELECT match_tier, {_duck_case('match_tier', formats.TIER_LABELS, 'match_tier')} AS label, {_duck_case('match_tier', formats.TIER_CLASSES, 'match_tier')} AS class, count(*) AS n FROM edges GROUP BY match_tier",
)
def f30(spark, sf_dir):
    t = edges(spark, sf_dir).groupBy("match_tier").agg(F.count(F.lit(1)).alias("n"))
    return t.select("match_tier", formats.tier_label(F.col("match_tier")).alias("label"), formats.tier_class(F.col("match_tier")).alias("class"), "n")


@query(
    "e08_amounts",
    DUCK_NAMES
    + r""", s AS (SELECT id, amount, trim(regexp_replace(amount, '[$,]', '', 'g')) AS t FROM raw_names), n AS (SELECT id, amount, CASE WHEN starts_with(t, '(') AND ends_with(t, ')') THEN '-' || substr(t, 2, length(t) - 2) ELSE t END AS t FROM s),
v AS (SELECT id, amount, CASE WHEN regexp_matches(t, '^[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+)?|\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN CAST(round_even(TRY_CAST(t AS DOUBLE), 0) AS BIGINT) END AS amount_usd FROM n)
SELECT id, amount_usd, CASE WHEN nullif(trim(amount), '') IS NOT NULL AND amount_usd IS NULL THEN 'unparsed amount: ' || amount END AS error FROM v""",
)
def e08(spark, sf_dir):
    a = F.col("amount")
    return raw_names(spark, sf_dir).select("id", values.amount(a).alias("amount_usd"), values.amount_error(a, "amount").alias("error"))
