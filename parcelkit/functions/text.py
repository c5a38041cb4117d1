"""String Column builders (native expressions only, no UDFs)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference behaviour; listed in natural order)
# ---------------------------------------------------------------------------
# Address abbreviations, applied on word boundaries in this order.
ADDRESS_ABBREVIATIONS = [
    ("APT", "APARTMENT"),
    ("ST", "STREET"),
    ("RD", "ROAD"),
    ("AVE", "AVENUE"),
    ("BLVD", "BOULEVARD"),
    ("N", "NORTH"),
    ("S", "SOUTH"),
    ("E", "EAST"),
    ("W", "WEST"),
]
# Categorical text groups: first key contained in the value wins.
CONDITION_TEXT_GROUPS = [
    ("EXCELLENT", "EXCELLENT"),
    ("VERY GOOD", "VERY GOOD"),
    ("GOOD", "GOOD"),
    ("FAIR", "FAIR"),
    ("POOR", "POOR"),
]
STYLE_TEXT_GROUPS = [
    ("COLONIAL", "COLONIAL"),
    ("RANCH", "RANCH"),
    ("CAPE", "CAPE COD"),
    ("CAPE COD", "CAPE COD"),
    ("CONTEMPORARY", "CONTEMPORARY"),
    ("SPLIT", "SPLIT LEVEL"),
    ("SPLIT LEVEL", "SPLIT LEVEL"),
]
# Overall-condition normalisation (exact keys after upper-casing).
CONDITION_LABELS = {
    "POOR": "Poor",
    "FAIR": "Fair",
    "GOOD": "Good",
    "AVERAGE": "Average",
    "AVG": "Average",
    "EXCELLENT": "Excellent",
    "DEFAULT": "Average",
    "1": "Poor",
    "2": "Fair",
    "3": "Average",
    "4": "Good",
    "5": "Excellent",
}
CONDITION_DEFAULT_LABEL = "Average"
# Quality ordinal; anything else (UNKNOWN included) scores 3.
QUALITY_ORDINAL = {"POOR": 1, "FAIR": 2, "AVERAGE": 3, "GOOD": 4, "EXCELLENT": 5, "UNKNOWN": 3}
QUALITY_ORDINAL_DEFAULT = 3
# ---------------------------------------------------------------------------


#: Put around the words of an address that are expanded.
_MARKS = "\x01\x02"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c) -> Column:
    """Null for empty text: a ``try_cast`` of it builds an exception for every row, and drops it."""
    return F.nullif(_col(c), F.lit(""))


def clean_address(c) -> Column:
    """Upper, trim, collapse whitespace, expand abbreviations (word bounded)."""
    out = F.regexp_replace(F.trim(F.upper(_col(c))), r"\s+", " ")
    # One regular expression marks the words; no expansion holds another abbreviation as a word.  A mark is no word
    # character, so text that looks like a marked word is one.
    words = "|".join(short for short, _ in ADDRESS_ABBREVIATIONS)
    marked = F.regexp_replace(out, rf"\b({words})\b", f"{_MARKS[0]}$1{_MARKS[1]}")
    return reduce(lambda acc, kv: F.replace(acc, F.lit(f"{_MARKS[0]}{kv[0]}{_MARKS[1]}"), F.lit(kv[1])),
                  ADDRESS_ABBREVIATIONS, marked)


def to_trimmed_string(c) -> Column:
    """Force to string and trim; null stays null (not the text 'nan')."""
    return F.trim(_col(c).cast("string"))


def strip_money(c) -> Column:
    """Remove '$' and ',' characters."""
    return F.translate(_col(c).cast("string"), "$,", "")


def parse_number(c) -> Column:
    """CSV converter semantics: drop commas, parse float, failure -> null.

    A leading '$' is *not* accepted (the reference converter rejects it).
    """
    return F.replace(_col(c).cast("string"), F.lit(","), F.lit("")).try_cast("double")


def standardize_text(c) -> Column:
    return F.trim(F.upper(_col(c).cast("string")))


def first_contained(c, groups) -> Column:
    """Map to the first group whose key is contained in the value; else keep."""
    c = _col(c)
    expr = None
    for key, val in groups:
        cond = F.instr(c, key) > 0
        expr = F.when(cond, F.lit(val)) if expr is None else expr.when(cond, F.lit(val))
    return expr.otherwise(c)


def standardize_condition(c) -> Column:
    """null -> AVERAGE; text after the first '-' (trimmed); upper; exact map;
    unmapped -> 'Average'."""
    c = F.coalesce(_col(c).cast("string"), F.lit("AVERAGE"))
    part = F.when(F.instr(c, "-") > 0, F.trim(F.split_part(c, F.lit("-"), F.lit(2)))).otherwise(c)
    return F.coalesce(_literal_map(CONDITION_LABELS)[F.upper(part)], F.lit(CONDITION_DEFAULT_LABEL))


def quality_ordinal(c) -> Column:
    key = F.upper(F.coalesce(_col(c).cast("string"), F.lit("UNKNOWN")))
    return F.coalesce(_literal_map(QUALITY_ORDINAL)[key], F.lit(QUALITY_ORDINAL_DEFAULT)).cast("bigint")


def _literal_map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def zip_to_number(c) -> Column:
    """'02118' -> 2118.0; empty / all-zero / non-numeric -> null."""
    return present(F.regexp_replace(_col(c).cast("string"), r"^0+", "")).try_cast("double")


def fill_category(c, fill: str = "UNKNOWN") -> Column:
    return F.upper(F.coalesce(_col(c).cast("string"), F.lit(fill)))


# -- number formatting (HALF_EVEN on the binary value, like Python format) --

def fmt_fixed(c, decimals: int) -> Column:
    """Fixed decimals without grouping separators."""
    return F.regexp_replace(F.format_number(_col(c), decimals), ",", "")


def fmt_percent(c, decimals: int = 1) -> Column:
    return F.concat(fmt_fixed(c, decimals), F.lit("%"))


def fmt_thousands(c, decimals: int = 2, missing: str = "N/A") -> Column:
    return F.coalesce(F.format_number(_col(c), decimals), F.lit(missing))


def fmt_dollar_suffix(c) -> Column:
    """$x (<1000), $xK (<1e6), else $x.xM."""
    x = _col(c)
    return (F.when(x < 1000, F.concat(F.lit("$"), F.format_number(x, 0)))
            .when(x < 1_000_000, F.concat(F.lit("$"), F.format_number(x / 1000, 0), F.lit("K")))
            .otherwise(F.concat(F.lit("$"), F.format_number(x / 1_000_000, 1), F.lit("M"))))
