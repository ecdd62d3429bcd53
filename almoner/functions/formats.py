"""How values are shown: money, counts, spans, names, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DASH, EN_DASH = "—", "–"

# Words of a name that stay in capitals, and words that stay small.
KEPT_UPPER = (
    "LLC", "USA", "US", "NY", "NYC", "DC", "II", "III", "IV", "YMCA", "YWCA", "UCLA", "MIT", "PTA", "PTO", "VFW",
    "AIDS", "HIV", "STEM", "TR", "UW", "DBA",
)
KEPT_LOWER = ("of", "the", "and", "for", "in", "at", "to", "by", "a", "an", "de", "la", "del", "du")

# Labels and classes of match tiers.
TIER_LABELS = {"A": "Reported EIN", "B": "Exact name and place", "C": "Strong name match", "D": "Probable name match", "U": "Unresolved"}
TIER_CLASSES = {"A": "tier-a", "B": "tier-b", "C": "tier-c", "D": "tier-d", "U": "tier-u"}

#: Meanings of tiers, in our words.
TIER_MEANINGS = {
    "A": "The filer stated this recipient's identification number.",
    "B": "The normalized name and the place are those of exactly one registered organization.",
    "C": "A close name in the same state, without a comparable alternative.",
    "D": "A probable name in the same state, without a comparable alternative; a lead to follow up.",
    "U": "No registered organization could be identified; the recipient is shown as filed.",
}

# Major fields of work by the first letter of their code.
FIELDS_OF_WORK = {
    "A": "Arts, culture and humanities", "B": "Education", "C": "Environment", "D": "Animal-related", "E": "Health care",
    "F": "Mental health and crisis intervention", "G": "Diseases, disorders and medical disciplines", "H": "Medical research",
    "I": "Crime and legal-related", "J": "Employment", "K": "Food, agriculture and nutrition", "L": "Housing and shelter",
    "M": "Public safety, disaster preparedness and relief", "N": "Recreation and sports", "O": "Youth development",
    "P": "Human services", "Q": "International, foreign affairs and national security", "R": "Civil rights, social action and advocacy",
    "S": "Community improvement and capacity building", "T": "Philanthropy, voluntarism and grantmaking foundations",
    "U": "Science and technology", "V": "Social science", "W": "Public and societal benefit", "X": "Religion-related",
    "Y": "Mutual and membership benefit", "Z": "Unknown",
}

# Postal codes of states and territories.
STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut",
    "DE": "Delaware", "DC": "District of Columbia", "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois",
    "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska",
    "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York", "NC": "North Carolina",
    "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island",
    "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia",
    "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming", "PR": "Puerto Rico", "GU": "Guam",
    "VI": "U.S. Virgin Islands", "AS": "American Samoa", "MP": "Northern Mariana Islands",
}


def looked_up(c: Column, table: dict[str, str], missing: Column | None = None) -> Column:
    found = F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)
    return F.coalesce(found, c if missing is None else missing)


def tier_label(c: Column) -> Column:
    return looked_up(c, TIER_LABELS)


def tier_class(c: Column) -> Column:
    return looked_up(c, TIER_CLASSES)


def tier_meaning(c: Column) -> Column:
    return looked_up(c, TIER_MEANINGS)


def state_name(c: Column) -> Column:
    return looked_up(c, STATES)


def field_of_work(code: Column) -> Column:
    """The major field of a code by its first letter, else the code."""
    return looked_up(F.substring(code, 1, 1), FIELDS_OF_WORK, code)


def money(c: Column) -> Column:
    shown = F.concat(F.when(c < 0, "-$").otherwise("$"), F.format_number(F.abs(c), 0))
    return F.coalesce(shown, F.lit(DASH))


def compact_money(c: Column) -> Column:
    size = F.abs(c)

    def scaled(unit: float, plain_from: float, letter: str) -> Column:
        # half away from zero, on the decimal digits
        x = c / F.lit(unit)
        whole, tenth = F.format_string("%.0f", F.round(x, 0)), F.format_string("%.1f", F.round(x, 1))
        return F.concat(F.lit("$"), F.when(size >= plain_from, whole).otherwise(tenth), F.lit(letter))

    shown = F.when(size >= 1e9, scaled(1e9, 1e10, "B")).when(size >= 1e6, scaled(1e6, 1e7, "M")).when(size >= 1e3, scaled(1e3, 0, "K"))
    return F.coalesce(shown, money(c))


def counted(c: Column) -> Column:
    return F.coalesce(F.format_number(c, 0), F.lit(DASH))


def plural(c: Column, one: str, many: str | None = None) -> Column:
    return F.concat(F.format_number(c, 0), F.lit(" "), F.when(c == 1, one).otherwise(many or one + "s"))


def year_span(first: Column, last: Column) -> Column:
    either = F.coalesce(last, first).cast("string")
    both = F.concat(first.cast("string"), F.lit(EN_DASH), last.cast("string"))
    return F.when(either.isNull(), "").when(first.isNull() | last.isNull() | (first == last), either).otherwise(both)


def shown_date(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", "not stated").otherwise(F.substring(c, 1, 10))


def nice_name(c: Column) -> Column:
    """Title case, word by word; separators stay as they are."""
    low = F.lower(F.coalesce(c, F.lit("")))
    words = F.regexp_extract_all(low, F.lit(r"([^\s/-]+|[\s/-])"), 1)

    def shown(w: Column) -> Column:
        capital = F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, F.length(w)))
        return F.when(F.upper(w).isin(*KEPT_UPPER), F.upper(w)).when(w.rlike("^[0-9]") | w.isin(*KEPT_LOWER), w).otherwise(capital)

    s = F.array_join(F.transform(words, shown), "")
    return F.when(s.rlike("^[a-z]"), F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, F.length(s)))).otherwise(s)
