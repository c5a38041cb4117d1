"""Feature engineering: ratios, property features, the model feature frame,
and the form/request record -> feature row mapping used for scoring.

Every operator is one projection (``withColumns``/``select``) of native
expressions: no shuffle, one codegen stage.  Engineered columns are always
emitted (null when the inputs are invalid) so the schema does not depend on
the data.  Training and scoring share ``model_features``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType

from parcelkit.functions import text as T
from parcelkit.functions.numeric import (age_category, finite_or_zero, nonneg_diff, round_half_even,
                                         safe_ratio, valid_year)

DEFAULT_AS_OF_YEAR = 2025

# Model feature names.
NUMERIC_FEATURES = [
    "GROSS_AREA", "LIVING_AREA", "LAND_SF", "YR_BUILT", "BED_RMS", "FULL_BTH", "HLF_BTH",
    "NUM_PARKING", "FIREPLACES", "KITCHENS", "TT_RMS", "ZIP_CODE", "YR_REMODEL",
]
INDICATOR_FEATURES = [
    "STRUCTURE_CLASS_C - BRICK/CONCR",
    "STRUCTURE_CLASS_D - WOOD/FRAME",
    "STRUCTURE_CLASS_B - REINF CONCR",
    "INT_COND_E - EXCELLENT",
    "INT_COND_G - GOOD",
    "INT_COND_A - AVERAGE",
    "INT_COND_F - FAIR",
    "INT_COND_P - POOR",
    "OVERALL_COND_E - EXCELLENT",
    "OVERALL_COND_VG - VERY GOOD",
    "OVERALL_COND_G - GOOD",
    "OVERALL_COND_A - AVERAGE",
    "OVERALL_COND_F - FAIR",
    "OVERALL_COND_P - POOR",
    "KITCHEN_STYLE2_M - MODERN",
    "KITCHEN_STYLE2_L - LUXURY",
    "KITCHEN_STYLE2_S - SEMI-MODERN",
    "KITCHEN_TYPE_F - FULL EAT IN",
    "AC_TYPE_C - CENTRAL AC",
    "AC_TYPE_D - DUCTLESS AC",
    "HEAT_TYPE_F - FORCED HOT AIR",
    "HEAT_TYPE_W - HT WATER/STEAM",
    "PROP_VIEW_E - EXCELLENT",
    "PROP_VIEW_G - GOOD",
    "CORNER_UNIT_Y - YES",
    "ORIENTATION_E - END",
    "ORIENTATION_F - FRONT/STREET",
    "EXT_COND_E - EXCELLENT",
    "EXT_COND_G - GOOD",
    "ROOF_COVER_S - SLATE",
    "ROOF_COVER_A - ASPHALT SHINGL",
]
CONDITION_CODE_SCORES = {"E": 5.0, "VG": 4.5, "G": 4.0, "A": 3.0, "F": 2.0, "P": 1.0}
CONDITION_SCORE_DEFAULT = 3.0
SCORE_GROUPS = [("INT_COND_", "interior_score"), ("EXT_COND_", "exterior_score"),
                ("OVERALL_COND_", "overall_score")]
ENGINEERED_FEATURES = [
    "price_per_sqft", "land_value_ratio", "building_value_ratio", "property_age", "age_category",
    "total_bathrooms", "non_living_area", "living_area_ratio", "has_renovation", "years_since_renovation",
]
# Form drop-down text -> indicator column (the payload the form sends).
FORM_CHOICES = [
    ("structureClass", "Brick/Concrete", "STRUCTURE_CLASS_C - BRICK/CONCR"),
    ("structureClass", "Wood/Frame", "STRUCTURE_CLASS_D - WOOD/FRAME"),
    ("structureClass", "Reinforced Concrete", "STRUCTURE_CLASS_B - REINF CONCR"),
    ("intCondition", "Excellent", "INT_COND_E - EXCELLENT"),
    ("intCondition", "Good", "INT_COND_G - GOOD"),
    ("intCondition", "Average", "INT_COND_A - AVERAGE"),
    ("intCondition", "Fair", "INT_COND_F - FAIR"),
    ("intCondition", "Poor", "INT_COND_P - POOR"),
    ("overallCondition", "Excellent", "OVERALL_COND_E - EXCELLENT"),
    ("overallCondition", "Very Good", "OVERALL_COND_VG - VERY GOOD"),
    ("overallCondition", "Good", "OVERALL_COND_G - GOOD"),
    ("overallCondition", "Average", "OVERALL_COND_A - AVERAGE"),
    ("overallCondition", "Fair", "OVERALL_COND_F - FAIR"),
    ("overallCondition", "Poor", "OVERALL_COND_P - POOR"),
    ("kitchenStyle", "Modern", "KITCHEN_STYLE2_M - MODERN"),
    ("kitchenStyle", "Luxury", "KITCHEN_STYLE2_L - LUXURY"),
    ("kitchenStyle", "Semi-Modern", "KITCHEN_STYLE2_S - SEMI-MODERN"),
    ("kitchenTypeFullEatIn", True, "KITCHEN_TYPE_F - FULL EAT IN"),
    ("acType", "Central AC", "AC_TYPE_C - CENTRAL AC"),
    ("acType", "Ductless AC", "AC_TYPE_D - DUCTLESS AC"),
    ("heatType", "Forced Hot Air", "HEAT_TYPE_F - FORCED HOT AIR"),
    ("heatType", "Hot Water/Steam", "HEAT_TYPE_W - HT WATER/STEAM"),
    ("propView", "Excellent", "PROP_VIEW_E - EXCELLENT"),
    ("propView", "Good", "PROP_VIEW_G - GOOD"),
    ("cornerUnit", True, "CORNER_UNIT_Y - YES"),
    ("orientation", "End", "ORIENTATION_E - END"),
    ("orientation", "Front/Street", "ORIENTATION_F - FRONT/STREET"),
    ("extCondition", "Excellent", "EXT_COND_E - EXCELLENT"),
    ("extCondition", "Good", "EXT_COND_G - GOOD"),
    ("roofCover", "Slate", "ROOF_COVER_S - SLATE"),
    ("roofCover", "Asphalt Shingle", "ROOF_COVER_A - ASPHALT SHINGL"),
]
FORM_FLOAT_FIELDS = ["GROSS_AREA", "LIVING_AREA", "LAND_SF"]
FORM_INT_FIELDS = ["YR_BUILT", "BED_RMS", "FULL_BTH", "HLF_BTH", "NUM_PARKING", "FIREPLACES",
                   "KITCHENS", "TT_RMS"]
FORM_DEFAULT_ZIP = "00000"

_FLOAT_PREFIX = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)"
_INT_PREFIX = r"^\s*[+-]?\d+"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _num(df: DataFrame, c: str) -> Column:
    """``c`` as a double, null where its text is no number; doubles and integers do not go through text."""
    if isinstance(df.schema[c].dataType, (DoubleType, IntegralType)):
        return _q(c).cast("double")
    return _q(c).cast("string").try_cast("double")


# ----------------------------------------------------------------- ratios ---

def ratio_features(df: DataFrame) -> DataFrame:
    """price_per_sqft, land_value_ratio, building_value_ratio (null when the
    inputs are missing or the denominator is not positive)."""
    cols = set(df.columns)
    tv, ga, lv, bv = (_num(df, c) if c in cols else F.lit(None).cast("double")
                      for c in ("TOTAL_VALUE", "GROSS_AREA", "LAND_VALUE", "BLDG_VALUE"))
    return df.withColumns({
        "price_per_sqft": F.when((tv > 0) & (ga > 0), tv / ga),
        "land_value_ratio": F.when(lv.isNotNull() & (tv > 0), lv / tv),
        "building_value_ratio": F.when(bv.isNotNull() & (tv > 0), bv / tv),
    })


# ------------------------------------------------------- property features ---

def property_features(df: DataFrame, as_of_year: int = DEFAULT_AS_OF_YEAR, compat: bool = False) -> DataFrame:
    """Condition text, age and its category, bathrooms, area split, renovation.

    ``compat=True`` reproduces the reference quirk where one valid build year
    makes the age of *every* row (including invalid years) be computed.
    """
    cols = set(df.columns)
    out: dict[str, Column] = {}
    if "OVERALL_COND" in cols:
        out["OVERALL_COND"] = T.standardize_condition(_q("OVERALL_COND"))
    yb = _num(df, "YR_BUILT") if "YR_BUILT" in cols else F.lit(None).cast("double")
    if "YR_BUILT" in cols:
        raw_age = F.greatest(F.lit(as_of_year) - yb, F.lit(0.0))
        if compat:
            # one scalar subquery (not a single-partition window)
            any_valid = df.select(F.max(valid_year(yb, as_of_year).cast("int"))).scalar() > 0
            age = F.when(any_valid, raw_age)
        else:
            age = F.when(valid_year(yb, as_of_year), raw_age)
        out["YR_BUILT"] = yb
        out["property_age"] = age
    if {"FULL_BTH", "HLF_BTH"} <= cols:
        tb = F.coalesce(_num(df, "FULL_BTH"), F.lit(0.0)) + 0.5 * F.coalesce(_num(df, "HLF_BTH"), F.lit(0.0))
        out["total_bathrooms"] = tb
        out["total_bathrooms_int"] = round_half_even(tb)
    if {"GROSS_AREA", "LIVING_AREA"} <= cols:
        g, lv = _num(df, "GROSS_AREA"), _num(df, "LIVING_AREA")
        ok = (g > 0) & (lv > 0) & (g >= lv)
        out["non_living_area"] = F.when(ok, g - lv)
        out["living_area_ratio"] = F.when(ok, lv / g)
    if {"YR_REMODEL", "YR_BUILT"} <= cols:
        rm = _num(df, "YR_REMODEL")
        ok = (rm.isNotNull() & valid_year(yb, as_of_year) & (rm >= yb) & (rm <= as_of_year))
        out["has_renovation"] = F.coalesce(ok & (rm > yb), F.lit(False))
        out["years_since_renovation"] = F.when(ok, F.greatest(F.lit(as_of_year) - rm, F.lit(0.0)))
    res = df.withColumns(out)
    if "property_age" in out:
        res = res.withColumn("age_category", age_category(F.col("property_age")))
    return res


# ------------------------------------------------------ model feature frame ---

def model_features(df: DataFrame, as_of_year: int = DEFAULT_AS_OF_YEAR, keep: list[str] | None = None) -> DataFrame:
    """The training / scoring feature frame.

    Available base numerics and indicator columns, then derived ratios and
    ages (unclipped, 0 when a denominator is not positive), every null /
    NaN / inf -> 0, then condition scores: max(3, score of set flags).
    ``keep`` columns (e.g. the row key, the label) are passed through.
    """
    cols = set(df.columns)
    keep = [c for c in (keep or []) if c in cols]
    nums = [c for c in NUMERIC_FEATURES if c in cols]
    inds = [c for c in INDICATOR_FEATURES if c in cols]
    is_text = {c for c in nums if c == "ZIP_CODE" and not isinstance(df.schema[c].dataType, DoubleType)}
    base = {c: (T.zip_to_number(_q(c)) if c in is_text else _q(c).cast("double")) for c in nums}
    base.update({c: _q(c).cast("double") for c in inds})
    feats = dict(base)

    def b(c):
        return base[c]

    if "YR_BUILT" in base:
        feats["property_age"] = (F.lit(as_of_year) - b("YR_BUILT").cast("bigint")).cast("double")
    if {"FULL_BTH", "HLF_BTH"} <= base.keys():
        feats["total_bathrooms"] = b("FULL_BTH") + 0.5 * b("HLF_BTH")
    if {"GROSS_AREA", "LIVING_AREA"} <= base.keys():
        feats["living_area_ratio"] = safe_ratio(b("LIVING_AREA"), b("GROSS_AREA"), 0.0)
    if {"YR_REMODEL", "YR_BUILT"} <= base.keys():
        feats["years_since_renovation"] = (
            F.lit(as_of_year) - F.coalesce(b("YR_REMODEL"), b("YR_BUILT")).cast("bigint")).cast("double")
        feats["has_renovation"] = F.coalesce((b("YR_REMODEL") > b("YR_BUILT")).cast("double"), F.lit(0.0))
    if {"LAND_SF", "GROSS_AREA"} <= base.keys():
        feats["floor_area_ratio"] = safe_ratio(b("GROSS_AREA"), b("LAND_SF"), 0.0)
        if "LIVING_AREA" in base:
            feats["non_living_area"] = nonneg_diff(b("GROSS_AREA"), b("LIVING_AREA"))
    if {"TT_RMS", "LIVING_AREA"} <= base.keys():
        feats["rooms_per_area"] = safe_ratio(b("TT_RMS"), b("LIVING_AREA"), 0.0)
    clean = {k: finite_or_zero(v) for k, v in feats.items()}
    for prefix, name in SCORE_GROUPS:
        flags = [c for c in inds if c.startswith(prefix)]
        if flags:
            clean[name] = condition_score({c: clean[c] for c in flags})
    return df.select(*[_q(c) for c in keep], *[v.alias(k) for k, v in clean.items()])


def condition_code(col_name: str) -> str:
    """'INT_COND_E - EXCELLENT' -> 'E'."""
    return col_name.split(" - ")[0].split("_")[-1]


def condition_score(flags: dict[str, Column]) -> Column:
    """max(default, score of every set flag); unknown codes score 0."""
    parts = [F.lit(CONDITION_SCORE_DEFAULT)]
    for name, c in flags.items():
        parts.append(F.when(c != 0, F.lit(CONDITION_CODE_SCORES.get(condition_code(name), 0.0))))
    return F.greatest(*parts)


# ---------------------------------------------------- form -> model record ---

def parse_float_prefix(c: Column) -> Column:
    """JavaScript ``parseFloat(x) || 0``: leading number, else 0 (and 0 for -0)."""
    found = F.regexp_extract(F.coalesce(c.cast("string"), F.lit("")), _FLOAT_PREFIX, 0)
    return F.coalesce(T.present(found).try_cast("double"), F.lit(0.0)) + F.lit(0.0)


def parse_int_prefix(c: Column) -> Column:
    """JavaScript ``parseInt(x) || 0``: leading integer, else 0 (as bigint)."""
    found = F.regexp_extract(F.coalesce(c.cast("string"), F.lit("")), _INT_PREFIX, 0)
    return F.coalesce(T.present(found).try_cast("bigint"), F.lit(0).cast("bigint"))


def form_to_record(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Form fields (text, drop-downs, check boxes) -> the 44-field payload."""
    keep = keep or []
    out = [_q(c) for c in keep]
    out += [parse_float_prefix(_q(c)).alias(c) for c in FORM_FLOAT_FIELDS]
    ints = {c: parse_int_prefix(_q(c)) for c in FORM_INT_FIELDS}
    out += [ints["YR_BUILT"].alias("YR_BUILT")]
    rm = parse_int_prefix(_q("YR_REMODEL"))
    out += [F.when(rm != 0, rm).otherwise(ints["YR_BUILT"]).alias("YR_REMODEL")]
    out += [v.alias(k) for k, v in ints.items() if k != "YR_BUILT"]
    zc = _q("ZIP_CODE").cast("string")
    out += [F.when(zc.isNull() | (zc == ""), F.lit(FORM_DEFAULT_ZIP)).otherwise(zc).alias("ZIP_CODE")]
    for field, choice, name in FORM_CHOICES:
        if isinstance(choice, bool):
            flag = F.coalesce(_q(field).cast("boolean"), F.lit(False))
        else:
            flag = F.coalesce(_q(field) == F.lit(choice), F.lit(False))
        out.append(flag.cast("bigint").alias(name))
    return df.select(*out)


def request_features(df: DataFrame, as_of_year: int = DEFAULT_AS_OF_YEAR, keep: list[str] | None = None) -> DataFrame:
    """Request record -> model feature row: missing fields default to 0
    (fixed read schema + coalesce), ZIP text -> number, then the same
    derivations as training (``model_features``)."""
    cols = set(df.columns)
    filled = {c: F.coalesce(_q(c).cast("double"), F.lit(0.0)) for c in NUMERIC_FEATURES
              if c in cols and c != "ZIP_CODE"}
    filled.update({c: F.lit(0.0) for c in NUMERIC_FEATURES if c not in cols})
    filled["ZIP_CODE"] = (F.coalesce(T.zip_to_number(_q("ZIP_CODE")), F.lit(0.0))
                          if "ZIP_CODE" in cols else F.lit(0.0))
    filled.update({c: F.coalesce(_q(c).cast("double"), F.lit(0.0)) if c in cols else F.lit(0.0)
                   for c in INDICATOR_FEATURES})
    return model_features(df.withColumns(filled), as_of_year, keep)
