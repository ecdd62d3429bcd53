"""Scalar functions: golden pairs, and Jaro-Winkler against DuckDB."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from almoner.functions import formats, names, similarity, values


def column(spark, rows, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i int, v string")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_normalized_names(spark):
    pairs = {
        "HARBOR & HILLS CLUBS": "HARBOR AND HILLS CLUBS",
        "The Orchard Project": "ORCHARD PROJECT",
        "Maple Minds INC": "MAPLE MINDS",
        "State UNIVERSITY Alumni Association": "STATE UNIV ALUMNI ASSN",
        "Saint Anne Children's Hospital Incorporated": "ST ANNE CHILDRENS HOSPITAL",
        "Saint Anne Children’s Hospital, Inc.": "ST ANNE CHILDRENS HOSPITAL",
        "River International USA": "RIVER INTL USA",
        "  Feeding   Hills  ": "FEEDING HILLS",
        "FEEDING-HILLS": "FEEDING HILLS",
        "The": "",
        "THEATRE CORPORATION": "THEATRE CORP",
        "Inc": "",
        "": "",
        None: "",
    }
    assert column(spark, pairs, names.normalize_name) == list(pairs.values())
    assert column(
        spark, ["Hill House DBA Hill Home", "x d/b/a y, aka z;", None], names.split_aliases
    ) == [["Hill House", "Hill Home"], ["x", "y", "z"], []]


def test_codes(spark):
    assert column(spark, ["94022-1234", "940221234", "123", None], names.zip5) == ["94022", "94022", None, None]
    assert column(spark, ["12-3456789", "000000000", "1234", None], names.valid_ein) == ["123456789", None, None, None]
    assert column(spark, ["12345678", "1234567", "12-3456789"], names.padded_ein) == ["012345678", "1234567", "123456789"]
    assert column(spark, ["4", "00-0000004", "1234567890", ""], names.display_ein) == ["00-0000004", "00-0000004", None, None]


def test_amounts(spark):
    got = column(spark, ["33333", "$1,234", "1234.00", "(500)", None, "N/A", "2.5", "3.5", "inf", "nan", "1e5", "1_000", "", "1" * 30], values.amount)
    assert got == [33333, 1234, 1234, -500, None, None, 2, 4, None, None, 100000, 1000, None, None]
    assert column(spark, ["N/A", " ", None, "5"], lambda c: values.amount_error(c, "amount")) == ["unparsed amount: N/A", None, None, None]


def test_dates(spark):
    assert [
        str(x) for x in column(spark, ["2022-12-31", "2023", "2023-02-30", "12/31/2022", None], values.submission_date)
    ] == ["2022-12-31", "None", "None", "None", "None"]
    assert [str(x) for x in column(spark, ["2021-06-30T00:00", "2021-6-30"], values.iso_date)] == ["2021-06-30", "None"]


def test_shown(spark):
    number = lambda f: lambda c: f(c.cast("long"))
    assert column(spark, ["2147500", "-5", None], number(formats.money)) == ["$2,147,500", "-$5", "—"]
    assert column(
        spark, ["2147500", "21475000", "999", "1500", "3200000000"], number(formats.compact_money)
    ) == ["$2.1M", "$21M", "$999", "$2K", "$3.2B"]
    assert column(spark, ["1", "1200"], number(lambda c: formats.plural(c, "grant"))) == ["1 grant", "1,200 grants"]
    assert column(spark, ["YMCA OF THE HILLS-USA", "the 4th CLUB", None], formats.nice_name) == ["YMCA of the Hills-USA", "The 4th Club", ""]
    assert column(spark, ["B20", "?1", "Z"], formats.field_of_work) == ["Education", "?1", "Unknown"]
    assert column(spark, ["CA", "XX"], formats.state_name) == ["California", "XX"]


def test_jaro_winkler_agrees_with_duckdb():
    r = random.Random(7)
    pairs = [
        (
            "".join(r.choice("ABCD ") for _ in range(r.randint(0, 12))),
            "".join(r.choice("ABCD ") for _ in range(r.randint(0, 12)))
        ) for _ in range(3000)
    ]
    c = duckdb.connect()
    c.execute("CREATE TABLE p (a VARCHAR, b VARCHAR)")
    c.executemany("INSERT INTO p VALUES (?, ?)", pairs)
    for a, b, want in c.execute("SELECT a, b, jaro_winkler_similarity(a, b) FROM p").fetchall():
        assert similarity.jaro_winkler_of(a, b) == pytest.approx(want, abs=1e-12), (a, b)


def test_metaphone():
    keys = {"PHONE": "FN", "BOMB": "BM", "WRITE": "RT", "XENIA": "SN", "KNOCK": "NK", "WHITE": "WT", "THIN": "0N", "ACTION": "AKXN"}
    assert {w: similarity.metaphone_of(w) for w in keys} == keys
    assert similarity.metaphone_of("SMITH") == similarity.metaphone_of("SMYTH")
    assert similarity.metaphone_of("") == ""
