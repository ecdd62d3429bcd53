"""Resolution, filings, quality, sources, sinks and streams on small inputs of our own."""

import os
import random
import struct
import tracemalloc
import zipfile
import zlib
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from almoner import __main__ as commands
from almoner.functions.similarity import jaro_winkler
from almoner.operators import filings as fil
from almoner.operators import profiles, publish, quality, relational, resolve
from almoner.sources import archives, inflate64, tables
from almoner.streaming import postings

DATA = os.environ.get("ALMONER_TESTDATA", "/root/testdata/sf0.001")

REGISTRY = "ein string, name string, name_normalized string, sort_name_normalized string, city string, state string, zip5 string, ntee_code string, subsection_code string, first_token string"
TUPLES = "name_normalized string, name_raw string, city string, state string, zip5 string, ein_reported string, recipient_type string"


@pytest.fixture(scope="module")
def registry(spark):
    rows = [
        ("100000001", "Harbor Arts Fdn", "HARBOR ARTS FDN", None, "Bay", "CA", "94000", "A20", "03", "HARBOR"),
        ("100000002", "Twin Oaks", "TWIN OAKS", None, "Elm", "TX", "75001", "B20", "03", "TWIN"),
        ("100000003", "Twin Oaks", "TWIN OAKS", None, "Fir", "TX", "75002", "B20", "03", "TWIN"),
        ("100000004", "YMCA North", "YMCA NORTH", None, "Oak", "NY", "10001", "P20", "03", "YMCA"),
        ("100000005", "Old Style", "OLD STYLE", "NEW STYLE", "Bay", "CA", "94001", "A20", "03", "OLD"),
    ]
    return spark.createDataFrame(rows, REGISTRY)


def test_ladder(spark, registry):
    t = [
        ("HARBOR ARTS FDN", "HARBOR ARTS FDN", "Bay", "CA", "94000", None, "organization"),
        ("HARBOR ARTS FDN", "Harbor", None, "CA", "99999", None, "organization"),
        ("HARBOR ARTS FDN", "Harbor B", None, None, None, None, "organization"),
        ("HARBOR ARTS FND", "Harbor", None, "CA", "94000", None, "organization"),
        ("TWIN OAKS", "Twin", None, "TX", None, None, "organization"),
        ("TWIN OAKS", "Twin", "Fir", "TX", None, None, "organization"),
        ("YMCA NORTH", "y", None, "NY", None, None, "organization"),
        ("NEW STYLE", "n", None, "CA", "94001", None, "organization"),
        ("ANY", "a", None, None, None, "10-0000001", "organization"),
        ("ANY", "b", None, None, None, "99-9999999", "organization"),
        ("ANY", "c", None, None, None, None, "individual"),
        ("", "d", None, None, None, None, "organization"),
        ("HARBOR ARTS FDN", "w", None, "NY", "94000", None, "organization"),
    ]
    got = {
        (r.name_normalized, r.name_raw, r.city): (r.tier, r.confidence, r.method) for r in resolve.resolve(
            spark.createDataFrame(t, TUPLES), registry
        ).collect()
    }
    assert list(got[tuple(x[:3])] for x in t) == [
        ("B", 0.94, "name_zip5_state_exact"), ("C", 0.77, "name_state_exact"), ("D", 0.7, "name_exact_no_state"), ("C", 0.81, "name_jw_zip5"),
        ("U", None, "ambiguous_2_candidates"), ("C", 0.85, "name_state_exact"), ("C", 0.8, "name_state_exact"), ("B", 0.9, "name_zip5_state_exact"),
        ("A", 1.0, "reported_ein_in_bmf"), ("A", 0.95, "reported_ein_not_in_bmf"), ("U", None, "recipient_type_individual"),
        ("U", None, "no_candidates"), ("U", None, "no_candidate_above_threshold"),
    ]


def test_corrections_and_pending(spark, registry):
    t = spark.createDataFrame(
        [("TWIN OAKS", "t", None, "TX", None, None, "organization"), ("NOBODY", "n", None, None, None, None, "organization")],
        TUPLES
    )
    fix = spark.createDataFrame([("TWIN OAKS", "TX", None, "100000003")], "recipient_name_normalized string, state string, zip5 string, ein string")
    answers = resolve.resolve(t, registry, corrections=fix)
    assert {
        (r.name_normalized, r.tier, r.ein, r.bmf_name) for r in answers.collect()
    } == {("TWIN OAKS", "A", "100000003", None), ("NOBODY", "U", None, None)}
    again = fix.unionByName(
        spark.createDataFrame([("TWIN OAKS", "TX", None, "100000002")], fix.schema)
    ).withColumn("row", F.col("ein").cast("int") * -1)
    last = resolve.resolve(t, registry, corrections=again).filter("tier = 'A'").first()  # the last row counts
    assert last.ein == "100000002"
    assert resolve.pending(t, answers).count() == 0
    assert resolve.pending(t, answers, again_unresolved=True).count() == 1
    with pytest.raises(ValueError):
        resolve.require_registry(registry.limit(0))


FILING = """<?xml version="1.0"?><Return xmlns="urn:x" returnVersion="2022v5.0"><ReturnHeader><ReturnTypeCd>990PF</ReturnTypeCd><TaxPeriodEndDt>2022-12-31</TaxPeriodEndDt>
<Filer><EIN>12345678</EIN><BusinessName><BusinessNameLine1Txt>Giving</BusinessNameLine1Txt></BusinessName></Filer></ReturnHeader><ReturnData><IRS990PF><SupplementaryInformationGrp>{}</SupplementaryInformationGrp></IRS990PF></ReturnData></Return>"""
PAID = "<GrantOrContributionPdDurYrGrp>{}</GrantOrContributionPdDurYrGrp>"


def test_filings(spark):
    body = PAID.format(
        "<RecipientBusinessName><BusinessNameLine1Txt>Hill</BusinessNameLine1Txt></RecipientBusinessName><RecipientUSAddress><CityNm>A</CityNm></RecipientUSAddress><Amt>40</Amt>"
    )
    body += PAID.format(
        "<RecipientPersonNm>Ann Example</RecipientPersonNm><RecipientForeignAddress><CountryCd>FR</CountryCd></RecipientForeignAddress><Amt>x</Amt>"
    )
    body += PAID.format("<RecipientPersonNm>Community Food Pantry</RecipientPersonNm><Amt>1</Amt>")
    body += "<GrantOrContriApprvForFutGrp><RecipientPersonNm>VARIOUS</RecipientPersonNm><Amt>9</Amt></GrantOrContriApprvForFutGrp><TotalGrantOrContriPdDurYrAmt>41</TotalGrantOrContriPdDurYrAmt>"
    docs = [
        ("1", FILING.format(body)), ("2", "<not xml"), ("3", "<html></html>"),
        ("4", FILING.format("").replace("990PF", "990EZ", 1)),
        ("5", FILING.format(body).replace("<", "<e:").replace("<e:/", "</e:").replace("<e:?", "<?")), ("6", None),
        ("7", FILING.format(""))
    ]
    parsed = fil.parsed(spark.createDataFrame(docs, "object_id string, xml string"))
    assert {
        r.object_id: r.error for r in parsed.filter("error IS NOT NULL").collect()
    } == {"2": fil.MALFORMED, "3": fil.NOT_A_RETURN, "6": fil.MALFORMED}
    rows = {(r.object_id, r.group, r.ordinal): r for r in fil.grant_rows(parsed).collect()}
    assert len(rows) == 8 and {k[0] for k in rows} == {"1", "5"}
    of = [rows["1", g, i] for g, i in (("pf_paid", 0), ("pf_paid", 1), ("pf_paid", 2), ("pf_future", 0))]
    assert [r.recipient_type for r in of] == ["organization", "individual", "organization", "unknown"]
    assert [r.amount_usd for r in of] == [40, None, 1, 9] and [r.recipient_country for r in of] == ["US", "FR", None, None]
    assert of[1]["errors"] == ["unparsed amount: x"] and of[3].amount_type == "approved_future"
    heads = fil.headers(parsed.filter("error IS NULL"))
    head = {r.object_id: r for r in heads.collect()}
    assert head["1"].funder_ein == "012345678" and head["1"].total_paid == 41 and head["4"]["errors"]
    sums = quality.filing_sums(fil.filed(parsed.filter("error IS NULL")))
    assert {r.object_id: r.status for r in quality.pf_totals(sums).collect()} == {"1": "within_tolerance", "5": "within_tolerance", "7": "no_rows"}
    assert quality.missing_detail(sums).count() == 0
    assert fil.unresolved_fields(fil.PF_FIELDS) == [] and "/Return/ReturnData" in fil.consumed_paths()


def test_odd_documents(spark):
    odd = {
        "blanks": " \n" * 50_000 + FILING.format("").partition("?>")[2],
        "comments": "<?xml version='1.0'?>" + "<!-- x -->" * 20_000 + FILING.format("").partition("?>")[2],
        "prefixed": "<a:Return xmlns:a='urn:x'><a:ReturnHeader><a:ReturnTypeCd>990</a:ReturnTypeCd></a:ReturnHeader></a:Return>",
        "nothing": "", "text": "<" * 30_000,
    }
    got = {r.object_id: r.error for r in fil.parsed(spark.createDataFrame(list(odd.items()), "object_id string, xml string")).collect()}
    assert got["blanks"] is None and got["comments"] is None and got["prefixed"] is None
    assert got["nothing"] is not None and got["text"] is not None


def test_one_parse(spark):
    docs = fil.filed(fil.parsed(spark.createDataFrame([("1", FILING.format(""))], "object_id string, xml string")).filter("error IS NULL"))
    plans = [
        quality.pf_totals(quality.filing_sums(docs)),
        quality.coverage(docs, {"name": lambda r: r["recipient_name_raw"] != ""}, F.col("name")), fil.grant_rows(docs)
    ]
    for df in plans:
        assert df._jdf.queryExecution().executedPlan().toString().count("from_xml") == 1


def test_index_files_of_two_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("RETURN_ID,EIN,TAX_PERIOD,SUB_DATE,TAXPAYER_NAME,RETURN_TYPE,OBJECT_ID\nr1,1,202212,2023,\"a\nb\",990,7\n")
    (tmp_path / "b.csv").write_text(
        "\ufeffEIN,TAX_PERIOD,SUB_DATE,TAXPAYER_NAME,RETURN_TYPE,OBJECT_ID,XML_BATCH_ID\n2,202312,2024,c,990PF,8,x\n",
        encoding="utf-8"
    )
    got = {r.object_id: r for r in tables.index(spark, str(tmp_path)).collect()}
    assert {
        k: (r.ein, r.tax_period, r.taxpayer_name, r.return_id, r.xml_batch_id) for k, r in got.items()
    } == {"7": ("1", "202212", "a\nb", "r1", None), "8": ("2", "202312", "c", None, "x")}
    with pytest.raises(ValueError):
        tables.index(spark, str(tmp_path / "none*.csv"))


def test_no_edge_is_lost(spark, tmp_path):
    rows = [
        (
            f"g{k}", "1", None if k % 5 == 0 else 2000 + k % 2, k,
            "individual" if k % 3 == 0 else None if k % 3 == 1 else "organization", 2001 + k % 2
        ) for k in range(50)
    ]
    g = spark.createDataFrame(rows, "grant_id string, funder_ein string, tax_year int, amount_usd long, recipient_type string, filing_year int")
    for files in (1, 3, None):
        assert publish.write_edges(g, str(tmp_path / str(files)), files) == {"grants": 33, "grants_individuals": 17}


def test_year_pages_leave_out_rows_without_a_year(spark):
    rows = [(f"g{k}", "1", None if k < 3 else 2001, k) for k in range(10)]
    pages = profiles.year_pages(spark.createDataFrame(rows, "grant_id string, funder_ein string, tax_year int, amount_usd long"), 5, 4)
    assert sorted((r.grant_id, r.page) for r in pages.collect()) == [(f"g{k}", 1 if k > 5 else 2) for k in range(3, 10)]
    assert [r.pages for r in profiles.page_counts(pages).collect()] == [{"2001": 2}]


def test_gates():
    assert quality.matching_failures({"A": 1.0, "B": 0.667, "D": None}, 1000) == ["tier B: precision 0.667, target 0.99"]
    assert quality.matching_failures({}, 3)
    assert quality.coverage_passes(95.0) and not quality.coverage_passes(94.9)
    assert quality.totals_pass([99.0, None]) and not quality.totals_pass([99.0, 94.0])
    assert "BELOW" in quality.evaluation_report([{"tier": "B", "resolved": 3, "correct": 2, "precision": 2 / 3}], 0.75, None, ["x"])


def test_sources(spark, tmp_path):
    assert tables.years_of("2019-2021,2021,2023") == [2019, 2020, 2021, 2023]
    with pytest.raises(ValueError):
        tables.years_of("21")
    p = tmp_path / "index.csv"
    p.write_text("Ein,TAX_PERIOD,SUB_DATE,TAXPAYER_NAME,RETURN_TYPE,OBJECT_ID\n1,202212,2023,\"a, b\",990,7\n,,,,,\n2,202212\n")
    assert [r.taxpayer_name for r in tables.index(spark, str(p)).collect()] == ["a, b", None]
    p.write_text("Ein,Surprise\n1,2\n")
    with pytest.raises(ValueError, match="Surprise"):
        tables.index(spark, str(p))
    fix = tmp_path / "fix.csv"
    fix.write_text("recipient_name_normalized,state,zip5,ein,source,note\nA,,94000,12-3456789,seen,\n")
    row = tables.corrections(spark, str(fix)).first()
    assert row.state is None and row.ein == "123456789"
    fix.write_text("recipient_name_normalized,state,zip5,ein,source,note\nA,,94000,12,seen,\n")
    with pytest.raises(ValueError):
        tables.corrections(spark, str(fix))
    assert tables.aliases(spark, str(tmp_path / "none.csv")).count() == 0


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "2023_A.zip", "w") as z:
        for k in range(3):
            z.writestr(f"x/{k}_PUBLIC.xml", f"<Return>{k}</Return>")
        z.writestr("x/readme.txt", "no")
    url = "file://" + str(tmp_path)
    assert {r.object_id for r in archives.members(spark, url).collect()} == {"0", "1", "2"}
    got = archives.documents(spark, url, spark.createDataFrame([("1",)], "object_id string")).collect()
    assert [(r.object_id, r.xml, r.error) for r in got] == [("1", "<Return>1</Return>", None)]
    body = bytearray((tmp_path / "2023_A.zip").read_bytes())
    at = body.index(b"<Return>2")
    body[at : at + 9] = b"?" * 9
    (tmp_path / "2024_B.zip").write_bytes(bytes(body))
    with zipfile.ZipFile(tmp_path / "2025_C.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x/9_public.xml", "<Return>" + "9" * 500 + "</Return>")
    body = bytearray((tmp_path / "2025_C.zip").read_bytes())
    start = 30 + len("x/9_public.xml")
    body[start : start + 4] = b"\xff\xff\xff\xff"
    (tmp_path / "2025_C.zip").write_bytes(bytes(body))
    broken = {r.object_id + r.zip_file[:4]: r for r in archives.documents(spark, url).collect()}
    assert len(broken) == 7 and {k for k, r in broken.items() if r.error} == {"22024", "92025"} and broken["92025"].xml is None
    spark.dataSource.register(archives.ZipFilings)
    read = spark.read.format("zip_filings").option("paths", str(tmp_path / "2023_A.zip")).option("wanted", "2").load()
    assert [r.object_id for r in read.collect()] == ["2"]


def fixed_block(symbols):
    """A Deflate64 stream of one block with fixed codes, from literals (bytes) and (length code, its bits, distance code, its bits)."""
    bits = []

    def code(value, size):  # a code's first bit comes first
        bits.extend(int(x) for x in format(value, f"0{size}b"))

    def number(value, size):  # a number's lowest bit comes first
        bits.extend((value >> k) & 1 for k in range(size))

    def literal(v):
        if v < 144:
            code(0x30 + v, 8)
        elif v < 256:
            code(0x190 + v - 144, 9)
        elif v < 280:
            code(v - 256, 7)
        else:
            code(0xC0 + v - 280, 8)

    number(1, 1)
    number(1, 2)
    for s in symbols:
        if isinstance(s, int):
            literal(s)
        else:
            (length, extra), (distance, more) = s
            literal(length)
            number(extra, inflate64.LENGTHS[length - 257][1])
            code(distance, 5)
            number(more, inflate64.DISTANCES[distance][1])
    literal(256)
    bits += [0] * (-len(bits) % 8)
    return bytes(sum(b << k for k, b in enumerate(bits[i : i + 8])) for i in range(0, len(bits), 8))


def test_inflate64():
    r = random.Random(2)
    for n in (0, 1, 50, 5000, 60_000):
        text = "".join(r.choice("abcdefghij <>") for _ in range(n)).encode()  # no matches of 258 bytes, where the methods differ
        for level in (0, 1, 9):
            packed = zlib.compressobj(level, zlib.DEFLATED, -15)
            assert inflate64.inflate64(packed.compress(text) + packed.flush(), n) == text
    # 285: 3 and 16 bits; distance codes 30 and 31: 14 bits
    long = fixed_block([97, 200, ((285, 65_000), (1, 0)), ((257, 0), (30, 100)), ((260, 0), (31, 5))])
    body = bytearray(b"a\xc8") + b"a\xc8" * 32_501 + b"a"
    for base, extra, size in ((32_769, 100, 3), (49_153, 5, 6)):
        back = base + extra
        body += body[-back : len(body) - back + size]
    assert inflate64.inflate64(long, 10**6) == bytes(body)
    for broken in (b"", long[:6], b"\x07", fixed_block([((257, 0), (3, 0))])):
        with pytest.raises(ValueError):
            inflate64.inflate64(broken, 10**6)
    with pytest.raises(ValueError):
        inflate64.inflate64(long, 100)


def test_deflate64_members(spark, tmp_path):
    body = f"<Return>{'x' * 40}</Return>".encode()
    packed = zlib.compressobj(9, zlib.DEFLATED, -15)
    stream = packed.compress(body) + packed.flush()
    for name, crc in (("a", zlib.crc32(body)), ("b", 1)):
        member = f"x/{name}_public.xml".encode()
        common = struct.pack("<HHHHHIIIHH", 21, 0, 9, 0, 0, crc, len(stream), len(body), len(member), 0)
        local = b"PK\x03\x04" + common + member + stream
        central = b"PK\x01\x02" + struct.pack("<H", 21) + common + struct.pack("<HHHII", 0, 0, 0, 0, 0) + member
        end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 1, 1, len(central), len(local), 0)
        (tmp_path / f"{name}.zip").write_bytes(local + central + end)
    got = {r.object_id: (r.xml, r.error) for r in archives.documents(spark, f"file://{tmp_path}").collect()}
    assert got["a"] == (body.decode(), None) and got["b"][0] is None and "CRC" in got["b"][1]


def test_publish(spark, tmp_path):
    from almoner.plans.analogs import edges

    g = edges(spark, "/root/testdata/sf0.001").withColumn("dataset_version", F.lit("2026.08.1"))
    out = publish.stage(g, str(tmp_path), "2026.08.1")
    m = publish.manifest(spark, out, "2026.08.1", quality.matching_status(3))
    assert m["rows"] == g.count() == sum(f["rows"] for f in m["files"]) and m["matching_status"] == "precision_unverified"
    with pytest.raises(ValueError):
        publish.stage(g, str(tmp_path), "2026.08.2")
    copied = publish.upload(out, str(tmp_path / "up"))
    assert copied and not publish.upload(out, str(tmp_path / "up"))
    assert publish.current(str(tmp_path), ["2026.08.1"]) == "2026.08.1"
    publish.point_to(str(tmp_path), "2026.09.0")
    assert publish.current(str(tmp_path), []) == "2026.09.0"
    assert publish.payload(str(tmp_path / "nothing.json")) is None
    with pytest.raises(SystemExit):
        publish.build([("a", lambda: 0), ("b", lambda: 3)])
    assert publish.prune(str(Path(tmp_path) / "up"), 1e12) > 0


def test_stored_answers_resume(spark, registry, tmp_path):
    columns = "grant_id string, filing_year int, recipient_name_normalized string, recipient_name_raw string, recipient_city string, recipient_state string, recipient_zip5 string, recipient_ein_reported string, recipient_type string, recipient_ein_resolved string, recipient_ein_source string, match_confidence double, match_tier string, match_method string, recipient_bmf_name string, recipient_ntee_code string, recipient_subsection_code string"
    none = (None, "unresolved", None, "U", None, None, None, None)
    rows = [
        ("g1", 2001, "HARBOR ARTS FDN", "Harbor", "Bay", "CA", "94000", None, "organization", *none),
        ("g2", 2001, None, "?", None, None, None, None, "unknown", *none),
        ("g3", 2002, "HARBOR ARTS FDN", "Harbor", "Bay", "CA", "94000", None, "organization", *none)
    ]
    edges, path, now = spark.createDataFrame(rows, columns), str(tmp_path / "answers"), datetime(2026, 8, 1)
    with pytest.raises(ValueError):
        resolve.resolve_edges(edges, registry.limit(0), path, "2026-08", now)
    for k in range(3):  # first everything, then nothing, then the unresolved again
        done = resolve.resolve_edges(edges, registry, path, f"2026-{k}", now, again_unresolved=k == 2, chunks=3 - k).collect()
        assert {(r.grant_id, r.match_tier, r.recipient_ein_resolved, r.recipient_bmf_name) for r in done} == {
            ("g1", "B", "100000001", "Harbor Arts Fdn"), ("g2", "U", None, None), ("g3", "B", "100000001", "Harbor Arts Fdn")
        }
        assert {
            (r.name_raw, r.bmf_vintage) for r in resolve.stored(spark, path).collect()
        } == {("Harbor", "2026-0"), ("?", "2026-2" if k == 2 else "2026-0")}


def test_filing_changes(spark):
    index = spark.createDataFrame(
        [
            ("1", "a", "p", "990", "2020", 2001), ("2", "a", "p", "990", "2021", 2001), ("4", "b", "p", "990", "2021", 2002),
            ("5", "c", "p", "990", None, 2003)
        ],
        "object_id string, ein string, tax_period string, return_type string, sub_date string, filing_year int"
    )
    processed = spark.createDataFrame([("1", 2001), ("3", 2002), ("5", 2003)], "object_id string, filing_year int")
    changes = relational.filing_changes(processed, index)
    assert {(r.object_id, r.change) for r in changes.collect()} == {
        ("1", "superseded"), ("2", "added"), ("3", "removed"), ("4", "added"), ("5", "kept")
    }
    assert {r.filing_year for r in relational.version_delta(changes).filter("touched").collect()} == {2001, 2002}


def test_commands(spark, tmp_path, capsys):
    root = f"file://{tmp_path}/work"
    row = "<RecipientBusinessName><BusinessNameLine1Txt>{}</BusinessNameLine1Txt></RecipientBusinessName><RecipientUSAddress><CityNm>Bay</CityNm><StateAbbreviationCd>CA</StateAbbreviationCd><ZIPCd>94000</ZIPCd></RecipientUSAddress><Amt>40</Amt>"
    with zipfile.ZipFile(tmp_path / "2023_A.zip", "w") as z:
        for k, name in enumerate(("Harbor Arts Fdn", "Nobody Knows")):
            z.writestr(
                f"x/{k}_public.xml",
                FILING.format(PAID.format(row.format(name)) + "<TotalGrantOrContriPdDurYrAmt>40</TotalGrantOrContriPdDurYrAmt>")
            )
    (tmp_path / "index.csv").write_text(
        "EIN,TAX_PERIOD,SUB_DATE,TAXPAYER_NAME,RETURN_TYPE,OBJECT_ID\n" + "".join(f"{k},202212,2023-01-0{k + 1},x,990PF,{k}\n" for k in range(2))
    )
    (tmp_path / "eo.csv").write_text(
        "EIN,NAME,STREET,CITY,STATE,ZIP,GROUP,SUBSECTION,AFFILIATION,FOUNDATION,STATUS,NTEE_CD,SORT_NAME\n100000001,Harbor Arts Fdn,1 Main,Bay,CA,94000-1,0,03,3,15,01,A20,\nx,bad,,,,,,,,,,,\n"
    )
    (tmp_path / "labels.csv").write_text(",".join(tables.LABEL_COLUMNS) + "\nHarbor Arts Fdn,Bay,CA,94000,,100000001,me,2026-08-01,site,\n")
    call = lambda *args: commands.run(spark, commands.arguments().parse_args(["--root", root, *args]))
    assert call("index", str(tmp_path / "index.csv"), "--year", "2023") == call("index", str(tmp_path / "index.csv"), "--year", "2023") == 0
    assert call("filings", f"file://{tmp_path}", "--years", "2023") == 0
    assert call("edges", "--version", "2026.08.1") == 0
    assert call("resolve") == 1  # no registry
    assert call("registry", str(tmp_path / "eo.csv"), "--vintage", "2026-08") == 0
    known = spark.read.parquet(f"{root}/registry").first()
    assert (
        known.street, known.group_exemption, known.affiliation, known.foundation, known.zip, known.zip5
    ) == ("1 Main", "0", "3", "15", "94000-1", "94000")
    assert call("resolve") == call("resolve", "--again-unresolved", "--chunks", "2") == 0
    tiers = {r.recipient_name_raw: r.match_tier for r in spark.read.parquet(f"{root}/edges/grants").collect()}
    assert tiers == {"Harbor Arts Fdn": "B", "Nobody Knows": "U"}
    assert call("evaluate", str(tmp_path / "labels.csv")) == quality.EXIT_MATCHING  # too few pairs
    assert call("sample", "--n", "2") == call("publish", "2026.08.1") == call("info") == 0
    out = capsys.readouterr().out
    assert '"rows": 2' in out and "1 organizations, 1 rows" in out


def test_stream_supersedes(spark, tmp_path):
    rows = [("1", "a", "p", "990", "2023"), ("2", "a", "p", "990", "2024")]
    for k, batch in enumerate((rows[1:], rows[:1])):
        spark.createDataFrame(batch, postings.INDEX).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        postings.follow(spark, str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "cp")).awaitTermination()
        assert [r.object_id for r in postings.state(spark, str(tmp_path / "state")).collect()] == ["2"], k


def test_bound_of_similarity_loses_nothing(spark):
    r = random.Random(7)
    words = ["".join(r.choice("ABC ") for _ in range(r.randint(0, 14))) for _ in range(400)]
    rows = spark.createDataFrame([(r.choice(words), r.choice(words)) for _ in range(4000)], "a string, b string")
    got = rows.select(
        "a", "b", jaro_winkler(F.col("a"), F.col("b")).alias("sim"), resolve.may_reach(F.col("a"), F.col("b"), 0.9).alias("may")
    ).collect()
    assert all(x.may for x in got if x.sim >= 0.9) and sum(x.sim >= 0.9 for x in got) > 20 and sum(not x.may for x in got) > 1000


def test_field_map(spark, tmp_path):
    (tmp_path / "pf.csv").write_text(
        "variable_name_new,variable_name,xpath,versions,current_version\nA,OLD,/g/Amount,2019v1;2020v1,\nA,OLD,/g/Amt,2021v1,T\n,B,/x/Name,,\n,B,/x/Nm,,\n,B,/x/Nm,,\n"
    )
    (tmp_path / "main.csv").write_text("variable_name,xpath,versions,current_version\nB,/y/Nm,,\nC,/z,,\nD,,,T\n")
    entries = tables.field_entries(spark, str(tmp_path / "pf.csv"), str(tmp_path / "main.csv"))
    assert {(r.variable, r.xpath): r.versions for r in entries.collect()}["A", "/g/Amount"] == ["2019v1", "2020v1"]
    found = tables.field_map(entries)
    assert found["A"] == ["/g/Amt"] and found["OLD"] == ["/g/Amt"] and found["C"] == ["/z"] and found["B"][-1] == "/x/Name" and set(found["B"]) == {"/x/Nm", "/y/Nm", "/x/Name"}
    assert fil.unresolved_fields(found | {"E": []}) == ["E"]


def test_search_and_numbers(spark):
    e = spark.createDataFrame(
        [("000000001", "funder", "Hill House"), ("000000001", "recipient", "Hill House"), ("000000002", "recipient", "House on the Hill")],
        "ein string, kind string, name string"
    )
    index = profiles.search_index(e)
    assert [r.ein for r in profiles.search(index, "hill hou").collect()] == ["000000001", "000000001", "000000002"]
    assert [r.kind for r in profiles.search(index, "00-0000001").collect()] == ["funder"]
    assert profiles.search(index, "hill x").count() == 0 and profiles.search(index, " ;").count() == 0
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    assert relational.global_row_number(df, [F.col("k")]).filter("rn <> k + 1").count() == 0


def test_a_directory_is_read_as_a_stream(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "2023_A.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(70_000):  # more than the small form's count
            z.writestr(f"x/{k}_public.xml", f"<Return>{k}</Return>")
    reader = archives._ZipReader({"paths": str(tmp_path / "2023_A.zip")})
    tracemalloc.start()
    n = sum(getattr(x, "num_rows", 1) for p in reader.partitions() for x in reader.read(p))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 70_000 and peak < 16 << 20
    url = "file://" + str(tmp_path)
    assert archives.members(spark, url).agg(F.count_distinct("object_id")).first()[0] == 70_000
    wanted = spark.range(0, 70_000, 1000).select(F.col("id").cast("string").alias("object_id"))
    assert {(r.object_id, r.xml, r.error) for r in archives.documents(spark, url, wanted).collect()} == {(str(k), f"<Return>{k}</Return>", None) for k in range(0, 70_000, 1000)}


def test_odd_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for k, method in enumerate((zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)):
            z.writestr(f"é/{k}_public.xml", "x" * k * 1000, method)
        z.comment = b"c" * 500
    (tmp_path / "b.zip").write_bytes(b"before" * 100 + (tmp_path / "a.zip").read_bytes())
    zipfile.ZipFile(tmp_path / "empty.zip", "w").close()
    got = archives.documents(spark, "file://" + str(tmp_path)).collect()
    assert sorted((r.zip_file, r.object_id, len(r.xml), r.error) for r in got) == [(f, str(k), k * 1000, None) for f in ("a.zip", "b.zip") for k in range(4)]


def test_what_parsers_make_of_odd_forms(spark):
    row = lambda x: FILING.format(PAID.format(x))
    odd = {
        "empty address": row("<RecipientUSAddress/>"), "repeated": row("<Amt>1</Amt><Amt>2</Amt><RecipientUSAddress><CityNm>A</CityNm></RecipientUSAddress><RecipientUSAddress><CityNm>B</CityNm></RecipientUSAddress>"),
        "older name first": row("<Amount>9</Amount><Amt>5</Amt>"), "small letters": row("<amt>5</amt>"), "markup": row("<RecipientPersonNm>A <b>x</b> c</RecipientPersonNm>"),
        "parts": row("<RecipientPersonNm>A<!-- c --><![CDATA[ & ]]>&#66;</RecipientPersonNm>"), "no declaration": row("<x:Amt y:z='1'>5</x:Amt>"),
        "more after it": row("<Amt>5</Amt>") + "<x/>", "other encoding stated": row("<RecipientPersonNm>é</RecipientPersonNm>").replace('"1.0"', '"1.0" encoding="iso-8859-1"'),
        "cut off": row("<Amt>5</Amt>")[:-3], "empty row": FILING.format("<GrantOrContributionPdDurYrGrp/>"),
    }
    docs = fil.parsed(spark.createDataFrame(list(odd.items()), "object_id string, xml string"))
    got = {r.object_id: r for r in fil.grant_rows(docs).collect()}
    assert set(odd) - set(got) == {"cut off"}
    assert {r.object_id: r.error for r in docs.filter("error IS NOT NULL").collect()} == {"cut off": fil.MALFORMED}
    assert [(got[k].recipient_country, got[k].recipient_city, got[k].amount_usd) for k in ("empty address", "repeated", "empty row")] == [("US", None, None), ("US", "B", 1), (None, None, None)]
    assert [got[k].amount_usd for k in ("older name first", "small letters", "no declaration", "more after it")] == [5] * 4
    assert [got[k].recipient_name_raw for k in ("markup", "parts", "other encoding stated")] == ["A <b>x</b> c", "A & B", "é"]


def test_documents_are_read_outside_the_jvm_and_paths_counted_there(spark):
    docs = spark.createDataFrame([("1", FILING.format(PAID.format("<Amt>1</Amt>") * 3)), ("2", FILING.format("")), ("3", "<not xml")], "object_id string, xml string")
    counts = fil.path_counts(docs)
    own = docs.withColumn("paths", fil.element_paths("xml")).filter("paths IS NOT NULL").withColumn("return_version", F.lit("2022v5.0"))
    assert sorted(map(tuple, quality.versions_of(counts).collect())) == sorted(map(tuple, quality.path_versions(own).collect()))
    plan = fil.headers(fil.parsed(docs))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython [from_xml" in plan and plan.count("from_xml") == 1


def test_a_year_is_staged_by_several_tasks(spark, tmp_path):
    rows = [(f"g{k:04d}", f"{k % 7}", 2000 + k % 2, k % 50, 2001, "v") for k in range(3000)]
    g = spark.createDataFrame(rows, "grant_id string, funder_ein string, tax_year int, amount_usd long, filing_year int, dataset_version string")
    out = publish.stage(g.repartition(4), str(tmp_path), "v", files=4)
    got = {r.grant_id: r.row_index for r in tables.ordered_rows(spark, out).collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda x: x[1])] == [r[0] for r in sorted(rows, key=lambda r: (r[1], r[2], -r[3], r[0]))]
    assert sorted(got.values()) == list(range(3000)) and len(list(Path(out).rglob("*.parquet"))) == 4
    from almoner.registry import QUERIES

    staged = []
    stage, publish.stage = publish.stage, lambda *a, **k: staged.append(k.get("files", 1)) or stage(*a, **k)
    try:
        QUERIES["k03_l01_l03_s16_staged_order"](spark, DATA)
    finally:
        publish.stage = stage
    assert staged == [None]  # 1: a task sorts a year


def test_years_are_written_once(spark, tmp_path):
    rows = [(k, 2000 + k % 3) for k in range(30)]
    df = spark.createDataFrame(rows, "k long, filing_year int")
    root, staging = f"file://{tmp_path}/edges", f"file://{tmp_path}/staged"
    df.write.partitionBy("filing_year").parquet(root)
    new = df.filter("filing_year = 2001 AND k > 10").unionByName(spark.createDataFrame([(99, 2005)], df.schema))
    assert publish.rewrite_years(spark, new, root, staging) == 7
    got = spark.read.schema(df.schema).parquet(root)
    assert sorted(map(tuple, got.collect())) == sorted([r for r in rows if r[1] != 2001] + [r for r in rows if r[1] == 2001 and r[0] > 10] + [(99, 2005)])
    assert not list((tmp_path / "staged").rglob("*.parquet"))  # they were moved, not copied


def test_a_funders_document_is_made_where_its_edges_lie(spark):
    from almoner.plans.analogs import analog, edges

    e, r = edges(spark, DATA), analog(spark, DATA, "registry")
    plan = profiles.funder_payloads(e, r, 5, 10)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and plan.count("Exchange hashpartitioning(funder_ein") == 0
    plan = profiles.recipient_payloads(e, r, 5, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") <= 1  # the funders' names
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("almoner_")]
