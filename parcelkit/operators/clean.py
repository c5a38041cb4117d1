"""Cleaning operators: numeric coercion, imputation, outlier clipping,
categorical and address standardisation, deduplication, target split.

Statistics (medians, modes, quartiles, means) are *fit* in fused passes and
returned as small per-column objects; *apply* is a single projection of
literals, so it never shuffles and stays inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from parcelkit.functions import text as T
from parcelkit.functions.numeric import clip, round_half_even
from parcelkit.functions.stats import exact_quantiles, group_modes, nan_to_null, nulls_for_nan, unpivot
from parcelkit.operators.roles import matches

# Column routing by name substring.
EXCLUDE_PATTERNS = ["zip", "postal", "phone", "id", "code", "placekey"]
INTEGER_PATTERNS = ["bed", "bath", "room", "floor", "parking", "garage", "fireplaces", "kitchens",
                    "num_", "yr_", "year", "rc_units", "res_units", "com_units", "unit_num", "st_num",
                    "cond"]
CONDITION_PATTERN = "cond"
AREA_PATTERNS = ["area", "sqft", "feet", "sf"]
PRICE_PATTERNS = ["price", "value", "tax"]
STRING_KEEP_PATTERNS = ["zip", "postal", "id", "code"]
IMPUTE_SKIP_PATTERNS = ["zip", "postal", "id", "code"]
YEAR_PATTERNS = ["year", "yr"]
OUTLIER_SKIP_PATTERNS = ["id", "code", "year", "zip"]
OUTLIER_PRICE_PATTERNS = ["price", "value"]
CONDITION_TEXT_KEY = "CONDITION"
STYLE_TEXT_KEY = "STYLE"


def _q(name: str):
    return F.col(f"`{name}`")


# --------------------------------------------------------------- numeric ---

def clean_numeric(df: DataFrame, cols: list[str], exclude_patterns: list[str] | None = None,
                  keep: list[str] | None = None) -> DataFrame:
    """Coerce ``cols`` to numbers and apply the name-routed rules:

    strip '$' and ',', parse (failure -> null); 'cond' columns clipped to
    [1, 5] and rounded half-even; integer-like names rounded; area-like
    values <= 0 -> null; price-like values < 0 -> null.  Columns whose name
    marks an identifier / ZIP stay trimmed strings; those in ``keep`` (row
    key, columns only passed through) are not touched.
    """
    untouched = set(keep or [])
    exclude = EXCLUDE_PATTERNS if exclude_patterns is None else exclude_patterns
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c in cols:
        if matches(c, exclude):
            continue
        v = _q(c).cast("double") if isinstance(types[c], NumericType) else \
            T.strip_money(_q(c)).try_cast("double")
        v = nan_to_null(v, "double")
        if CONDITION_PATTERN in c.lower():
            v = round_half_even(clip(v, 1.0, 5.0))
        elif matches(c, INTEGER_PATTERNS):
            v = round_half_even(v)
        if matches(c, AREA_PATTERNS):
            v = F.when(~(v <= 0), v)
        elif matches(c, PRICE_PATTERNS):
            v = F.when(~(v < 0), v)
        out[c] = v
    for c in df.columns:
        if c not in out and c not in untouched and matches(c, STRING_KEEP_PATTERNS):
            out[c] = T.to_trimmed_string(_q(c))
    return df.withColumns(out)


def numeric_audit(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, invalid) counts of values that ``clean_numeric`` turns null
    (area-like <= 0, price-like < 0) -- one aggregate."""
    rules = []
    for c in cols:
        v = _q(c).cast("double")
        if matches(c, AREA_PATTERNS):
            rules.append((c, v <= 0))
        elif matches(c, PRICE_PATTERNS):
            rules.append((c, v < 0))
    if not rules:
        return df.sparkSession.createDataFrame([], "column string, invalid bigint")
    wide = df.agg(*[F.count_if(cond).alias(c) for c, cond in rules])
    return wide.unpivot([], [c for c, _ in rules], "column", "invalid")


# ------------------------------------------------------------- imputation ---

@dataclass
class ImputeModel:
    values: dict = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in df.schema.fields}
        return df.withColumns({c: F.coalesce(nan_to_null(_q(c), types[c]), F.lit(v).cast(types[c]))
                               for c, v in self.values.items() if v is not None and c in df.columns})


def fit_impute(df: DataFrame, roles: dict[str, list[str]], numerical_strategy: str = "median",
               categorical_strategy: str = "most_frequent", fill_value=0.0, exact: bool = True) -> ImputeModel:
    """Per-column fill values: year-like numerics -> mode (falls back to the
    numeric strategy); other numerics -> ``numerical_strategy`` (median,
    mean, most_frequent, constant); categoricals -> mode or 'UNKNOWN';
    booleans -> false.  Identifier / ZIP-like numerics are left alone."""
    num = [c for c in roles.get("numerical", []) if not matches(c, IMPUTE_SKIP_PATTERNS)]
    year = [c for c in num if matches(c, YEAR_PATTERNS)]
    other = [c for c in num if c not in year]
    cat = roles.get("categorical", [])
    values: dict = {}

    # year-like columns need their mode, plus the strategy statistic as a
    # fallback; every other numeric needs only the strategy statistic.
    need_mode_num = year + (other if numerical_strategy == "most_frequent" else [])
    need_median = (other + year) if numerical_strategy == "median" else []
    need_mean = (other + year) if numerical_strategy == "mean" else []

    num_modes = _modes(df, need_mode_num, "double")
    medians = _medians(df, need_median, exact)
    known = nulls_for_nan(df, need_mean)
    means = known.agg(*[F.avg(_q(c)).alias(c) for c in need_mean]).first().asDict() if need_mean else {}

    def strategy_value(c):
        s = numerical_strategy
        if s == "median":
            return medians.get(c)
        if s == "mean":
            return means.get(c)
        if s == "most_frequent":
            return num_modes.get(c)
        return fill_value

    for c in other:
        values[c] = strategy_value(c)
    for c in year:
        values[c] = num_modes.get(c) if num_modes.get(c) is not None else strategy_value(c)
    if cat:
        if categorical_strategy == "most_frequent":
            cat_modes = _modes(df, cat, "string")
            for c in cat:
                values[c] = cat_modes.get(c) if cat_modes.get(c) is not None else "UNKNOWN"
        else:
            for c in cat:
                values[c] = "UNKNOWN"
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in roles.get("boolean", []):
        # boolean role: real booleans and 0/1 numerics; both fill as false / 0
        values[c] = False if isinstance(types[c], BooleanType) else 0
    return ImputeModel(values)


def _modes(df: DataFrame, cols: list[str], cast: str) -> dict:
    if not cols:
        return {}
    long = unpivot(df, [], cols, "column", "value", cast)
    return {r["column"]: r["mode"] for r in group_modes(long, ["column"], "value").collect()}


def _medians(df: DataFrame, cols: list[str], exact: bool = True) -> dict:
    """Median per column: exact (skew-safe, linear interpolation) or, with
    ``exact=False``, a bounded-memory sketch (``percentile_approx``)."""
    if not cols:
        return {}
    long = unpivot(df, [], cols, "column", "value", "double")
    if not exact:
        approx = long.groupBy("column").agg(F.percentile_approx("value", 0.5, 100000).alias("median"))
        return {r["column"]: r["median"] for r in approx.collect()}
    return {r["column"]: r["median"] for r in
            exact_quantiles(long, ["column"], "value", [0.5], ["median"]).collect()}


def impute(df: DataFrame, roles: dict[str, list[str]], **kw) -> DataFrame:
    return fit_impute(df, roles, **kw).apply(df)


# --------------------------------------------------------------- outliers ---

@dataclass
class ClipModel:
    bounds: dict = field(default_factory=dict)  # column -> (lo or None, hi or None)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: clip(_q(c), lo, hi) for c, (lo, hi) in self.bounds.items()})


def outlier_columns(cols: list[str], skip_integers: bool = False) -> list[str]:
    """Columns that are clipped.  ``skip_integers`` leaves out those whose name
    marks an integer: after ``clean_numeric`` they are integers, which the
    chain's outlier step does not touch (a year 0 stays, to be found invalid)."""
    skip = OUTLIER_SKIP_PATTERNS + (INTEGER_PATTERNS if skip_integers else [])
    return [c for c in cols if not matches(c, skip)]


def fit_outliers(df: DataFrame, cols: list[str], method: str = "iqr", threshold: float = 1.5,
                 exact: bool = True, skip_integers: bool = False) -> ClipModel:
    """Bounds per column: IQR (exact linear quartiles) or z-score (mean and
    sample std).  Price-like: upper bound only; area-like: [lo, 1.5 * hi];
    others: [lo, hi]."""
    cols = outlier_columns(cols, skip_integers)
    if not cols:
        return ClipModel({})
    raw = {}
    if method == "iqr":
        long = unpivot(df, [], cols, "column", "value", "double")
        if exact:
            qs = exact_quantiles(long, ["column"], "value", [0.25, 0.75], ["q1", "q3"]).collect()
        else:
            qs = (long.groupBy("column")
                  .agg(F.percentile_approx("value", [0.25, 0.75], 100000).alias("q"))
                  .select("column", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3")).collect())
        for r in qs:
            iqr = r["q3"] - r["q1"]
            raw[r["column"]] = (r["q1"] - threshold * iqr, r["q3"] + threshold * iqr)
    else:
        stats = nulls_for_nan(df, cols).agg(*[F.avg(_q(c)).alias(f"m|{c}") for c in cols],
                       *[F.stddev_samp(_q(c)).alias(f"s|{c}") for c in cols]).first().asDict()
        for c in cols:
            m, s = stats[f"m|{c}"], stats[f"s|{c}"]
            if m is not None and s is not None:
                raw[c] = (m - threshold * s, m + threshold * s)
    bounds = {}
    for c, (lo, hi) in raw.items():
        if matches(c, OUTLIER_PRICE_PATTERNS):
            bounds[c] = (None, hi)
        elif matches(c, AREA_PATTERNS):
            bounds[c] = (lo, hi * 1.5)
        else:
            bounds[c] = (lo, hi)
    return ClipModel(bounds)


def clip_outliers(df: DataFrame, cols: list[str], method: str = "iqr", threshold: float = 1.5) -> DataFrame:
    return fit_outliers(df, cols, method, threshold).apply(df)


def outlier_audit(df: DataFrame, model: ClipModel) -> DataFrame:
    """(column, n_clipped) for a fitted model, one aggregate."""
    if not model.bounds:
        return df.sparkSession.createDataFrame([], "column string, n_clipped bigint")
    aggs = []
    for c, (lo, hi) in model.bounds.items():
        cond = F.lit(False)
        if lo is not None:
            cond = cond | (_q(c) < lo)
        if hi is not None:
            cond = cond | (_q(c) > hi)
        aggs.append(F.count_if(cond).alias(c))
    return df.agg(*aggs).unpivot([], list(model.bounds), "column", "n_clipped")


# ------------------------------------------------------------------- text ---

def standardize_categorical(df: DataFrame, cols: list[str]) -> DataFrame:
    """Upper + trim; names containing CONDITION / STYLE get the text groups."""
    out = {}
    for c in cols:
        v = T.standardize_text(_q(c))
        if CONDITION_TEXT_KEY in c.upper():
            v = T.first_contained(v, T.CONDITION_TEXT_GROUPS)
        elif STYLE_TEXT_KEY in c.upper():
            v = T.first_contained(v, T.STYLE_TEXT_GROUPS)
        out[c] = v
    return df.withColumns(out)


def clean_address(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: T.clean_address(_q(c)) for c in cols if c in df.columns})


def to_trimmed_string(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: T.to_trimmed_string(_q(c)) for c in cols if c in df.columns})


# ------------------------------------------------------------------ dedup ---

def dedup_rows(df: DataFrame) -> DataFrame:
    """Whole-row duplicates removed (hash aggregate, combined map-side)."""
    return df.dropDuplicates()


def count_rows(df: DataFrame, name: str) -> DataFrame:
    """``dedup_rows`` with how often each row stood there, in the column ``name``."""
    return df.groupBy(*[_q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(name))


def dedup_keep_first(df: DataFrame, subset: list[str], order: list[str]) -> DataFrame:
    """Keep the first row (by ``order``) of each ``subset`` key.

    A ``min`` over a struct led by the order columns: partial aggregation
    keeps one candidate per key per map task, so a hot key never gathers
    its rows in one task (unlike a row_number window).
    """
    rest = [c for c in df.columns if c not in subset]
    packed = F.struct(*[_q(c).alias(f"_o{i}") for i, c in enumerate(order)], *[_q(c) for c in rest])
    agg = df.groupBy(*[_q(c) for c in subset]).agg(F.min(packed).alias("_r"))
    return agg.select(*[F.col(f"`{c}`") if c in subset else F.col("_r").getField(c).alias(c)
                        for c in df.columns])


# ------------------------------------------------------------- target split --

def split_target(df: DataFrame, target: str, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(features, target) frames that both carry the row key."""
    if target not in df.columns:
        raise ValueError(f"Target column {target} not found in dataframe")
    return df.drop(target), df.select(*key, target)
