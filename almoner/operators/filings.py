"""Filings in XML to grant rows: one parse, repeating groups exploded, every value by its first non-empty path."""

from __future__ import annotations

import gc
import xml.etree.ElementTree as ET
from collections import Counter
from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almoner.functions.names import normalize_name, padded_ein, valid_ein, zip5
from almoner.functions.values import amount, amount_error, grant_id, iso_date, submission_date
from almoner.sources.shared import bound_batches

# Where header values, groups, totals and their fields stand. Ordered by preference, modern names first.
HEADER = {
    "return_type": ["ReturnHeader/ReturnTypeCd", "ReturnHeader/ReturnType"],
    "ein": ["ReturnHeader/Filer/EIN"],
    "name1": ["ReturnHeader/Filer/BusinessName/BusinessNameLine1Txt", "ReturnHeader/Filer/Name/BusinessNameLine1"],
    "name2": ["ReturnHeader/Filer/BusinessName/BusinessNameLine2Txt", "ReturnHeader/Filer/Name/BusinessNameLine2"],
    "state": ["ReturnHeader/Filer/USAddress/StateAbbreviationCd", "ReturnHeader/Filer/USAddress/State"],
    "period_end": ["ReturnHeader/TaxPeriodEndDt", "ReturnHeader/TaxPeriodEndDate"],
}
GROUPS = {
    "pf_paid": "ReturnData/IRS990PF/SupplementaryInformationGrp/GrantOrContributionPdDurYrGrp",
    "pf_future": "ReturnData/IRS990PF/SupplementaryInformationGrp/GrantOrContriApprvForFutGrp",
    "sched_i": "ReturnData/IRS990ScheduleI/RecipientTable",
}
TOTALS = {
    "total_paid": ["ReturnData/IRS990PF/SupplementaryInformationGrp/TotalGrantOrContriPdDurYrAmt"],
    "total_future": ["ReturnData/IRS990PF/SupplementaryInformationGrp/TotalGrantOrContriApprvFutAmt"],
    "total_501c3": ["ReturnData/IRS990ScheduleI/Total501c3OrgCnt"],
    "total_other": ["ReturnData/IRS990ScheduleI/TotalOtherOrgCnt"],
}
PF_FIELDS = {
    "name1": ["RecipientBusinessName/BusinessNameLine1Txt", "RecipientBusinessName/BusinessNameLine1", "RecipientNameBusiness/BusinessNameLine1"],
    "name2": ["RecipientBusinessName/BusinessNameLine2Txt", "RecipientBusinessName/BusinessNameLine2", "RecipientNameBusiness/BusinessNameLine2"],
    "person": ["RecipientPersonNm", "RecipientPersonName"],
    "line1": ["RecipientUSAddress/AddressLine1Txt", "RecipientForeignAddress/AddressLine1Txt", "RecipientAddressUS/AddressLine1"],
    "city": ["RecipientUSAddress/CityNm", "RecipientForeignAddress/CityNm", "RecipientAddressUS/City"],
    "state": ["RecipientUSAddress/StateAbbreviationCd", "RecipientAddressUS/State"],
    "zip": ["RecipientUSAddress/ZIPCd", "RecipientForeignAddress/ForeignPostalCd", "RecipientAddressUS/ZIPCode"],
    "country": ["RecipientForeignAddress/CountryCd"],
    "relationship": ["RecipientRelationshipTxt"],
    "status": ["RecipientFoundationStatusTxt"],
    "purpose": ["GrantOrContributionPurposeTxt", "PurposeOfGrantOrContribution"],
    "amount": ["Amt", "Amount"],
}
TABLE_FIELDS = {
    "name1": ["RecipientBusinessName/BusinessNameLine1Txt", "RecipientBusinessName/BusinessNameLine1", "NameOfOrganization/BusinessNameLine1"],
    "name2": ["RecipientBusinessName/BusinessNameLine2Txt", "RecipientBusinessName/BusinessNameLine2", "NameOfOrganization/BusinessNameLine2"],
    "ein": ["RecipientEIN", "EINOfRecipient"],
    "line1": ["USAddress/AddressLine1Txt", "ForeignAddress/AddressLine1Txt", "USAddress/AddressLine1"],
    "city": ["USAddress/CityNm", "ForeignAddress/CityNm", "USAddress/City"],
    "state": ["USAddress/StateAbbreviationCd", "USAddress/State"],
    "zip": ["USAddress/ZIPCd", "ForeignAddress/ForeignPostalCd", "USAddress/ZIPCode"],
    "country": ["ForeignAddress/CountryCd"],
    "irc": ["IRCSectionDesc", "IRCSection"],
    "amount": ["CashGrantAmt", "AmountOfCashGrant"],
    "noncash": ["NonCashAssistanceAmt", "AmountOfNonCashAssistance"],
    "purpose": ["PurposeOfGrantTxt", "PurposeOfGrant"],
}
FIELDS = {"pf_paid": PF_FIELDS, "pf_future": PF_FIELDS, "sched_i": TABLE_FIELDS}
US_ADDRESS = {
    "pf_paid": ["RecipientUSAddress", "RecipientAddressUS"], "pf_future": ["RecipientUSAddress", "RecipientAddressUS"],
    "sched_i": ["USAddress"]
}
RAW = sorted({f for x in FIELDS.values() for f in x})
#: Paths that a task counts before it hands them over.
MOST_PATHS = 100_000
MODERN_ENDINGS = ("Txt", "Amt", "Nm", "Cd", "Ind", "Dt", "Cnt")

# Words that make a name an organization's, a government's, or a stand-in for an attached list.
ORGANIZATION_WORDS = (
    "INC", "INCORPORATED", "LLC", "LTD", "CORP", "CORPORATION", "CO", "COMPANY", "FOUNDATION", "FDN", "FUND", "TRUST", "ASSOCIATION", "ASSN",
    "SOCIETY", "SOC", "INSTITUTE", "UNIVERSITY", "UNIV", "COLLEGE", "SCHOOL", "CHURCH", "MINISTRY", "MINISTRIES", "HOSPITAL", "CLINIC", "CENTER",
    "CENTRE", "COUNCIL", "COMMITTEE", "CLUB", "LEAGUE", "ORGANIZATION", "ORGANIZATIONS", "CHARITY", "CHARITIES", "MUSEUM", "LIBRARY", "THEATER",
    "THEATRE", "ORCHESTRA", "ALLIANCE", "COALITION", "NETWORK", "PARTNERSHIP", "PROJECT", "PROGRAM", "SERVICES", "DEPARTMENT", "AGENCY", "AUTHORITY",
    "DISTRICT", "CITY", "COUNTY", "STATE", "YMCA", "YWCA", "UNITED WAY", "GOODWILL", "HABITAT", "ROTARY", "KIWANIS", "LIONS", "ELKS", "SCOUTS",
    "SALVATION ARMY", "RED CROSS", "BOYS", "GIRLS", "PANTRY", "FOOD BANK", "KITCHEN", "SHELTER", "MISSION", "CHAPEL", "TEMPLE", "SYNAGOGUE",
    "MOSQUE", "FRATERNITY", "SORORITY", "CHAPTER", "LODGE", "GUILD", "TROOP", "CHOIR", "BAND",
)
ORGANIZATION = r"(?i)\b(" + "|".join(ORGANIZATION_WORDS) + r")\b"
GOVERNMENT = r"(?i)\b(CITY|COUNTY|TOWN|TOWNSHIP|VILLAGE|BOROUGH|PARISH|STATE) OF\b|\b(DEPARTMENT|DEPT|BUREAU|OFFICE) OF\b|\bSCHOOL DISTRICT\b|\bPUBLIC SCHOOLS?\b|\bUNITED STATES\b|\bU\.?S\.? (ARMY|NAVY|AIR FORCE|MARINE|COAST GUARD|TREASURY)\b"
PLACEHOLDER = r"(?i)\b(VARIOUS|MISCELLANEOUS|MISC|MULTIPLE|NUMEROUS|SEVERAL|N/?A|NONE)\b|\bSEE (ATTACHED|ATTACHMENT|SCHEDULE|STATEMENT|LIST)\b|\bATTACHED (SCHEDULE|LIST)\b"

NOT_A_RETURN, MALFORMED, OTHER_FORM = "the root element is not Return", "malformed XML", "form carries no grants: "


def modern_first(paths: list[str]) -> list[str]:
    """Distinct paths, modern endings first, then modern groups."""
    return sorted(dict.fromkeys(paths), key=lambda p: (p.rpartition("/")[2].endswith(MODERN_ENDINGS), "Grp/" in p), reverse=True)


_HEAD = {**HEADER, **TOTALS}
_ROWS = pa.struct([("group", pa.string()), ("ordinal", pa.int32()), ("us", pa.bool_()), *[(f, pa.string()) for f in RAW]])
_DOC = pa.struct([("root", pa.string()), ("version", pa.string()), *[(f, pa.string()) for f in _HEAD], ("rows", pa.list_(_ROWS))])
_TEXT = T.StringType()
DOCUMENT = T.StructType([T.StructField(f, _TEXT) for f in ("root", "version", *_HEAD)]).add(
    "rows", T.ArrayType(T.StructType([
        T.StructField("group", _TEXT), T.StructField("ordinal", T.IntegerType()), T.StructField("us", T.BooleanType()),
        *[T.StructField(f, _TEXT) for f in RAW]
    ]))
)
#: Blanks of XML.
_BLANK = " \t\r\n"


class _Locals(dict):
    """Names of tags and attributes without their namespace or prefix, in small letters; a form has some hundred."""

    def __missing__(self, tag: str) -> str:
        name = self[tag] = unprefixed(tag).lower()
        return name


def unprefixed(tag: str) -> str:
    return tag.rpartition("}")[2].rpartition(":")[2]


_local = _Locals()


def tree(text: str) -> ET.Element | None:
    """The root of a document, whatever encoding it states and whether its prefixes are declared or not; None where it is malformed."""
    body = text.encode("utf-8", "replace")
    parser = ET.XMLParser(encoding="utf-8")
    try:
        parser.feed(body)
        return parser.close()
    except ET.ParseError:
        pass
    # by itself, an undeclared prefix is no fault, nor is what follows the root
    build, plain, depth = ET.TreeBuilder(), expat.ParserCreate("utf-8"), 0

    def start(tag: str, attributes: dict[str, str]) -> None:
        nonlocal depth
        if depth >= 0:
            depth += 1
            build.start(tag, attributes)

    def end(tag: str) -> None:
        nonlocal depth
        if depth >= 0:
            build.end(tag)
            depth = depth - 1 or -1  # the root's end

    plain.buffer_text = True
    plain.StartElementHandler, plain.EndElementHandler = start, end
    plain.CharacterDataHandler = lambda text: build.data(text) if depth > 0 else None
    try:
        plain.Parse(body, True)
    except expat.ExpatError:
        if depth >= 0:
            return None
    return build.close()


def _markup(node: ET.Element) -> str:
    return (node.text or "") + "".join(f"<{unprefixed(x.tag)}>{_markup(x)}</{unprefixed(x.tag)}>{x.tail or ''}" for x in node)


def _slots(fields: dict[str, list[str]], groups: dict[str, str]) -> dict:
    """Names below names, down to a leaf's (place of its field, rank among the field's paths, own bit) or a repeating group's name."""
    tree: dict = {}
    places = [(p, k, rank) for k, paths in enumerate(fields.values()) for rank, p in enumerate(paths)]
    ends = [(p, (k, rank, 1 << n)) for n, (p, k, rank) in enumerate(places)] + [(p, g) for g, p in groups.items()]
    for path, end in ends:
        *above, last = path.lower().split("/")
        at = tree
        for name in above:
            at = at.setdefault(name, {})
        at[last] = end
    return tree


_IN_DOC = _slots(_HEAD, GROUPS)
_US = {g: [x.lower() for x in names] for g, names in US_ADDRESS.items()}
_IN_ROW = {g: _slots({f: FIELDS[g].get(f, []) for f in RAW}, {}) for g in GROUPS}


def _read(node: ET.Element, slots: dict, values: list, ranks: list[int], rows: list | None = None) -> dict[str, ET.Element]:
    """Fill values with the first non-empty text among each field's paths, rows with the repeating groups' elements. Returns
    the elements that have some below them, by name.

    A repeated leaf counts by its first occurrence, a repeated element above leaves by its last."""
    seen, inner = 0, {}
    for child in node:
        slot = slots.get(name := _local[child.tag])
        if slot is None:
            continue
        if slot.__class__ is tuple:
            k, rank, bit = slot
            if not seen & bit:
                seen |= bit
                text = _markup(child) if len(child) else child.text
                if text and (values[k] is None or rank < ranks[k]) and (text := text.strip(_BLANK)):
                    values[k], ranks[k] = text, rank
        elif slot.__class__ is dict:
            inner[name] = child
        elif rows is not None:
            rows.append((slot, child))
    for name, child in inner.items():
        _read(child, slots[name], values, ranks, rows)
    return inner


def _take(texts: list[str | None]) -> pa.Array:
    heads: list[list | None] = []
    sizes, groups, ordinals, us, rows = [0], [], [], [], []
    n, width = len(_HEAD), len(RAW)
    for text in texts:
        root = None if text is None else tree(text)
        if root is None:
            heads.append(None)
        elif (name := unprefixed(root.tag)) != "Return":
            heads.append([name, None, *[None] * n])
        else:
            values, found = [None] * n, []
            _read(root, _IN_DOC, values, [0] * n, found)
            version = next((v.strip(_BLANK) for k, v in root.attrib.items() if _local[k] == "returnversion"), None)
            heads.append([name, version, *values])
            for group in GROUPS:
                if values[0] == ("990" if group == "sched_i" else "990PF"):
                    for k, node in enumerate(x for g, x in found if g == group):
                        raw = [None] * width
                        inner = _read(node, _IN_ROW[group], raw, [0] * width)
                        us.append(not inner.keys().isdisjoint(_US[group]))
                        groups.append(group)
                        ordinals.append(k)
                        rows.append(raw)
        sizes.append(len(rows))
    columns = zip(*rows, strict=True) if rows else [()] * width
    values = [pa.array(groups, pa.string()), pa.array(ordinals, pa.int32()), pa.array(us, pa.bool_()), *[pa.array(c, pa.string()) for c in columns]]
    lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(values, fields=list(_ROWS)))
    columns = zip(*[h or [None] * (n + 2) for h in heads], strict=True) if heads else [()] * (n + 2)
    null = pa.array([h is None for h in heads], pa.bool_())
    return pa.StructArray.from_arrays([*[pa.array(c, pa.string()) for c in columns], lists], fields=list(_DOC), mask=null)


@F.arrow_udf(DOCUMENT)
def from_xml(xml: pa.Array) -> pa.Array:
    """Of each document its root's name, version, header values, stated totals and rows as they stand; null where it is malformed."""
    gc.disable()  # trees hold no cycles, and there are many
    if len(_local) > MOST_PATHS:
        _local.clear()
    try:
        return _take(xml.to_pylist())
    finally:
        gc.enable()


def parsed(filings: DataFrame, xml: str = "xml") -> DataFrame:
    """filings with `_doc` (null where unreadable) and `error`: a bad document is a recorded error, never a failure or an empty filing.

    The parser stands in a generator, which neither filters nor projections above it can copy or pass: one parse for each document."""
    bound_batches(filings.sparkSession)
    with_doc = filings.select("*", F.inline_outer(F.array(F.struct(from_xml(F.col(xml)).alias("_doc")))))
    error = F.when(F.col("_doc").isNull(), MALFORMED).when(F.col("_doc.root") != "Return", NOT_A_RETURN)
    return with_doc.withColumn("error", error).withColumn("_doc", F.when(F.col("error").isNull(), F.col("_doc")))


def filed(docs: DataFrame) -> DataFrame:
    """One row for each filing: object_id, header columns, stated totals, errors, and its grant rows, as they stand, in an array `rows`."""
    d = F.col("_doc")
    h = {k: d[k] for k in HEADER}
    kind = h["return_type"]
    form_error = F.when(
        F.col("error").isNull() & ~F.coalesce(kind.isin("990PF", "990"), F.lit(False)),
        F.concat(F.lit(OTHER_FORM), F.coalesce(kind, F.lit("none")))
    )
    totals = {k: d[k] for k in TOTALS}
    keep = [c for c in docs.columns if c not in ("_doc", "error", "xml")]
    return docs.select(
        *keep, F.coalesce(d["version"], F.lit("")).alias("return_version"), kind.alias("return_type"),
        padded_ein(h["ein"]).alias("funder_ein"),
        F.concat_ws(" ", h["name1"], h["name2"]).alias("funder_name"), h["state"].alias("funder_state"),
        iso_date(h["period_end"]).alias("tax_period_end"),
        *[amount(v).alias(k) for k, v in totals.items()],
        F.filter(F.array(F.col("error"), form_error, *[amount_error(v, k) for k, v in totals.items()]), lambda x: x.isNotNull()).alias("errors"),
        F.coalesce(d["rows"], F.array()).alias("rows"),
    )


def headers(docs: DataFrame) -> DataFrame:
    """object_id, header columns, stated totals and errors of each filing."""
    return filed(docs).drop("rows")


def recipient_type(business: Column, person: Column, line1: Column) -> Column:
    name = F.coalesce(business, person)
    stand_in = F.coalesce(name.rlike(PLACEHOLDER), F.lit(False)) | F.coalesce(line1.rlike(PLACEHOLDER), F.lit(False))
    return (
        F.when(stand_in, "unknown")
        .when(person.isNotNull() & business.isNull() & ~person.rlike(ORGANIZATION), "individual")
        .when(name.rlike(GOVERNMENT), "government")
        .when(name.isNotNull(), "organization")
        .otherwise("unknown")
    )


def as_filed(r: Column) -> dict[str, Column]:
    """What a raw row says: names, amounts, type, whether it stands in for a list."""
    business = F.nullif(F.concat_ws(" ", r["name1"], r["name2"]), F.lit(""))
    name = F.coalesce(business, r["person"])
    return {
        "amount_type": F.when(r["group"] == "pf_future", "approved_future").otherwise("paid"), "amount_usd": amount(r["amount"]),
        "noncash_amount_usd": amount(r["noncash"]),
        "grant_purpose": r["purpose"], "recipient_name_raw": F.coalesce(name, F.lit("")),
        "recipient_ein_reported": F.when(F.length(F.regexp_replace(r["ein"], r"\D", "")) == 9, F.regexp_replace(r["ein"], r"\D", "")),
        "recipient_address_line1": r["line1"], "recipient_city": r["city"], "recipient_state": r["state"], "recipient_zip": r["zip"],
        "recipient_country": F.when(r["us"], "US").otherwise(r["country"]), "recipient_type": recipient_type(business, r["person"], r["line1"]),
        "is_placeholder": F.coalesce(name.rlike(PLACEHOLDER), F.lit(False)) | F.coalesce(r["line1"].rlike(PLACEHOLDER), F.lit(False)),
        "recipient_relationship": r["relationship"], "recipient_foundation_status": r["status"], "irc_section": r["irc"],
    }


def grant_rows(filings: DataFrame) -> DataFrame:
    """Grant rows as filed (amounts, names, type, country, errors), from filed() or parsed() documents; the filings' columns come along."""
    filings = filed(filings) if "_doc" in filings.columns else filings
    keep = [c for c in filings.columns if c not in ("rows", "errors")]
    rows = filings.select(*keep, F.explode("rows").alias("_r"))
    r = F.col("_r")
    odd_ein = r["ein"].isNotNull() & (F.length(F.regexp_replace(r["ein"], r"\D", "")) != 9)
    errors = F.array(
        amount_error(r["amount"], "amount"), amount_error(r["noncash"], "noncash"),
        F.when(odd_ein, F.concat(F.lit("recipient EIN is not nine digits: "), r["ein"]))
    )
    return rows.select(
        *keep, r["group"].alias("group"), r["ordinal"].alias("ordinal"), grant_id(F.col("object_id"), r["group"], r["ordinal"]).alias("grant_id"),
        *[v.alias(k) for k, v in as_filed(r).items()], F.filter(errors, lambda x: x.isNotNull()).alias("errors"),
    )


#: The published columns, in order.
GRANTS = (
    "grant_id", "funder_ein", "funder_name", "funder_state", "funder_form_type", "object_id", "tax_year", "tax_period_end",
    "filing_submission_date", "filing_year",
    "return_version", "amount_usd", "noncash_amount_usd", "amount_type", "grant_purpose", "recipient_name_raw",
    "recipient_name_normalized", "recipient_ein_reported",
    "recipient_ein_resolved", "recipient_ein_source", "match_confidence", "match_tier", "match_method", "recipient_address_line1",
    "recipient_city", "recipient_state",
    "recipient_zip", "recipient_zip5", "recipient_country", "recipient_bmf_name", "recipient_ntee_code",
    "recipient_subsection_code", "recipient_type",
    "recipient_relationship", "recipient_foundation_status", "concordance_version", "dataset_version", "ingested_at",
)


def grants(
    filings: DataFrame, index: DataFrame, dataset_version: str, concordance_version: str = "own-paths-1",
    zero_unparsed: bool = False
) -> DataFrame:
    """The edge list. filings: object_id, filing_year, xml; index: object_id, sub_date. An amount that can't be read is null
    (0 with zero_unparsed)."""
    return edges_of(filed(parsed(filings)), index, dataset_version, concordance_version, zero_unparsed)


def edges_of(
    filings: DataFrame, index: DataFrame, dataset_version: str, concordance_version: str = "own-paths-1",
    zero_unparsed: bool = False
) -> DataFrame:
    """The same from filed() documents."""
    subs = index.select("object_id", submission_date(F.col("sub_date")).alias("filing_submission_date"))
    g = grant_rows(filings).join(subs, "object_id", "left").dropDuplicates(["grant_id"])
    null = F.lit(None).cast("string")
    g = g.withColumns({
        "funder_form_type": F.col("return_type"), "tax_year": F.year("tax_period_end"),
        "recipient_name_normalized": normalize_name(F.col("recipient_name_raw")), "recipient_zip5": zip5(F.col("recipient_zip")),
        "recipient_ein_resolved": null, "recipient_ein_source": F.lit("unresolved"),
        "match_confidence": F.lit(None).cast("double"), "match_tier": F.lit("U"), "match_method": null,
        "recipient_bmf_name": null, "recipient_ntee_code": null, "recipient_subsection_code": null,
        "concordance_version": F.lit(concordance_version), "dataset_version": F.lit(dataset_version),
        "ingested_at": F.current_timestamp(), "amount_usd": F.coalesce("amount_usd", F.lit(0)) if zero_unparsed else F.col("amount_usd"),
    })
    return g.select(*GRANTS)


class _Below(dict):
    """Paths of elements by their parent's path and their tag; a form has some thousand."""

    def __missing__(self, at: tuple[str, str]) -> str:
        path = self[at] = f"{at[0]}/{at[1].rpartition('}')[2]}"
        return path


_below = _Below()


def _paths(text: str | None) -> set[str] | None:
    """Every distinct element path of a document; None where it can't be read."""
    parser = ET.XMLParser(encoding="utf-8")
    try:
        parser.feed((text or "").encode("utf-8", "replace"))
        root = parser.close()
    except ET.ParseError:
        return None
    stack = [(root, _below["", root.tag])]
    found = {stack[0][1]}
    for node, path in stack:  # which grows
        for child in node:
            below = _below[path, child.tag]
            found.add(below)
            if len(child):
                stack.append((child, below))
    return found


@F.arrow_udf(T.ArrayType(T.StringType()))
def element_paths(xml: pa.Array) -> pa.Array:
    """Every distinct element path of each document; null where it can't be read."""
    gc.disable()  # trees hold no cycles, and there are many
    if len(_below) > MOST_PATHS:
        _below.clear()
    try:
        return pa.array([None if (found := _paths(text)) is None else sorted(found) for text in xml.to_pylist()], pa.list_(pa.string()))
    finally:
        gc.enable()


def path_counts(filings: DataFrame, xml: str = "xml") -> DataFrame:
    """path, return_version and n: how many of a task's readable documents of a version have an element path. Versions and
    paths are few, so they are counted where documents are read; a version's counts of several tasks are yet to be summed."""
    bound_batches(filings.sparkSession)
    columns = (pa.string(), pa.string(), pa.int64())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[tuple[str, str]] = Counter()

        def counted() -> pa.RecordBatch:
            keys = list(n)
            values = ([k[1] for k in keys], [k[0] for k in keys], list(n.values()))
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, columns, strict=True)], ["path", "return_version", "n"])

        gc.disable()
        try:
            for batch in batches:
                for text, version in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    n.update((version, path) for path in _paths(text) or ())
                if len(n) > MOST_PATHS:  # documents that aren't forms
                    yield counted()
                    n.clear()
                    _below.clear()
            yield counted()
        finally:
            gc.enable()

    version = F.regexp_extract(xml, 'returnVersion="([^"]*)"', 1)
    return filings.select(F.col(xml), version.alias("version")).mapInArrow(count, "path string, return_version string, n long")


def from_files(spark: SparkSession, path: str) -> DataFrame:
    """object_id and xml of single filings; the id is the file's name without a version before it or an ending."""
    name = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_name"), r"^\d{4}v[\d.]+__", ""), r"(_public)?\.xml$", "")
    return spark.read.text(path, wholetext=True).select(name.alias("object_id"), F.col("value").alias("xml"))


def consumed_paths() -> set[str]:
    """Paths that extraction reads, and all their ancestors."""
    leaves = [p for x in [*HEADER.values(), *TOTALS.values()] for p in x] + [
        f"{g}/{p}" for name, g in GROUPS.items() for x in FIELDS[name].values() for p in x
    ]
    return {"/" + "/".join(["Return", *p.split("/")][: k + 1]) for p in leaves for k in range(len(p.split("/")) + 1)}


def unresolved_fields(table: dict[str, list[str]]) -> list[str]:
    """Logical fields without any path."""
    return sorted(k for k, v in table.items() if not v)


def is_known_ein(c: Column) -> Column:
    return valid_ein(c).isNotNull()
