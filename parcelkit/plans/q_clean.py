"""Registered queries: sources, predicates, cleaning, quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelkit.functions import text as T
from parcelkit.functions.numeric import finite_or_zero
from parcelkit.operators import clean as C
from parcelkit.operators import quality as Q
from parcelkit.operators.roles import column_roles, roles_frame
from parcelkit.plans import bindings as b
from parcelkit.plans.oracle import with_ctes
from parcelkit.plans.registry import register, rounded
from parcelkit.session import cut_lineage

KEY = b.ROW_KEY
KEY_SQL = ", ".join(KEY)


def _dirty(spark, sf):
    return b.dirty(spark, sf)


# ------------------------------------------------------------ A1 converter --
@register("numeric_converter", with_ctes(f"""
SELECT {KEY_SQL}, MONEY_TEXT, TRY_CAST(replace(MONEY_TEXT, ',', '') AS DOUBLE) AS parsed
FROM dirty""", "dirty"))
def q_numeric_converter(spark, sf):
    d = _dirty(spark, sf)
    return rounded(d.select(*KEY, "MONEY_TEXT", T.parse_number(F.col("MONEY_TEXT")).alias("parsed")))


# ------------------------------------------------------ B4 invalid -> null --
@register("invalid_to_null", with_ctes(f"""
SELECT {KEY_SQL},
  CASE WHEN GROSS_AREA_RAW <= 0 THEN NULL ELSE GROSS_AREA_RAW END AS GROSS_AREA_RAW,
  CASE WHEN TOTAL_VALUE_RAW < 0 THEN NULL ELSE TOTAL_VALUE_RAW END AS TOTAL_VALUE_RAW
FROM dirty""", "dirty"))
def q_invalid_to_null(spark, sf):
    d = _dirty(spark, sf).select(*KEY, "GROSS_AREA_RAW", "TOTAL_VALUE_RAW")
    return rounded(C.clean_numeric(d, ["GROSS_AREA_RAW", "TOTAL_VALUE_RAW"]))


# ----------------------------------------------------- B11 inf/nan -> zero --
@register("inf_nan_to_zero", with_ctes(f"""
SELECT {KEY_SQL},
  round(CASE WHEN x IS NULL OR isnan(x) OR isinf(x) THEN 0 ELSE x END, 4) AS living_ratio,
  round(CASE WHEN y IS NULL OR isnan(y) OR isinf(y) THEN 0 ELSE y END, 4) AS floor_ratio
FROM (SELECT *,
  CASE WHEN l_linenumber = 7 THEN NULL WHEN p_size % 25 = 0 THEN CAST('inf' AS DOUBLE)
       WHEN p_size % 24 = 0 THEN CAST('nan' AS DOUBLE) ELSE LIVING_AREA / GROSS_AREA END AS x,
  GROSS_AREA / LAND_SF AS y FROM assess)""", "assess"))
def q_inf_nan_to_zero(spark, sf):
    a = b.assess(spark, sf)
    ln, ps = F.col("l_linenumber"), F.col("p_size")
    x = (F.when(ln == 7, F.lit(None).cast("double")).when(ps % 25 == 0, F.lit(float("inf")))
         .when(ps % 24 == 0, F.lit(float("nan"))).otherwise(F.col("LIVING_AREA") / F.col("GROSS_AREA")))
    y = F.col("GROSS_AREA") / F.col("LAND_SF")
    return rounded(a.select(*KEY, finite_or_zero(x).alias("living_ratio"), finite_or_zero(y).alias("floor_ratio")))


# ------------------------------------------------------------ D24 / E2 dedup --
_DUP_SQL = f"""dup AS (
  SELECT {KEY_SQL}, TOTAL_VALUE, ZIP_CODE FROM assess
  UNION ALL
  SELECT {KEY_SQL}, TOTAL_VALUE, ZIP_CODE FROM assess WHERE l_linenumber = 1)"""


def _dup(spark, sf):
    a = b.assess(spark, sf).select(*KEY, "TOTAL_VALUE", "ZIP_CODE")
    return a.unionByName(a.where(F.col("l_linenumber") == 1))


@register("dedup_rows", with_ctes("SELECT DISTINCT * FROM dup", "assess", extra=[_DUP_SQL]), bench=True)
def q_dedup_rows(spark, sf):
    return C.dedup_rows(_dup(spark, sf))


@register("dedup_keep_first", with_ctes(f"""
SELECT {KEY_SQL}, TOTAL_VALUE, ZIP_CODE FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {KEY_SQL}) AS rn FROM dup)
WHERE rn = 1""", "assess", extra=[_DUP_SQL]))
def q_dedup_keep_first(spark, sf):
    return C.dedup_keep_first(_dup(spark, sf), ["l_orderkey", "l_linenumber"], KEY)


# ------------------------------------------------------------ G1 address --


def _address_sql():
    expr = "regexp_replace(trim(upper(ADDRESS)), '\\s+', ' ', 'g')"
    for k, v in T.ADDRESS_ABBREVIATIONS:
        expr = f"regexp_replace({expr}, '\\b{k}\\b', '{v}', 'g')"
    return expr


@register("clean_address", with_ctes(f"SELECT {KEY_SQL}, {_address_sql()} AS ADDRESS FROM dirty", "dirty"))
def q_clean_address(spark, sf):
    d = _dirty(spark, sf).select(*KEY, "ADDRESS")
    return C.clean_address(d, ["ADDRESS"])


# ---------------------------------------------------------- G4/G5 groups --
def _groups_sql(x, groups):
    whens = " ".join(f"WHEN instr({x}, '{k}') > 0 THEN '{v}'" for k, v in groups)
    return f"CASE {whens} ELSE {x} END"


@register("standardize_categorical", with_ctes(f"""
SELECT {KEY_SQL}, {_groups_sql('c', T.CONDITION_TEXT_GROUPS)} AS CONDITION_TEXT,
  {_groups_sql('s', T.STYLE_TEXT_GROUPS)} AS STYLE_TEXT
FROM (SELECT *, trim(upper(CONDITION_TEXT)) AS c, trim(upper(STYLE_TEXT)) AS s FROM dirty)""", "dirty"))
def q_standardize_categorical(spark, sf):
    d = _dirty(spark, sf).select(*KEY, "CONDITION_TEXT", "STYLE_TEXT")
    return C.standardize_categorical(d, ["CONDITION_TEXT", "STYLE_TEXT"])


# ------------------------------------------------------------ G6 / G7 --
def _condition_sql(src):
    m = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in T.CONDITION_LABELS.items())
    return f"""(SELECT *, coalesce(CASE u {m} END, 'Average') AS OVERALL_COND_STD FROM (
  SELECT *, upper(CASE WHEN instr(s, '-') > 0 THEN trim(split_part(s, '-', 2)) ELSE s END) AS u
  FROM (SELECT *, coalesce({src}, 'AVERAGE') AS s FROM dirty)))"""


@register("standardize_condition", with_ctes(f"""
SELECT {KEY_SQL}, OVERALL_COND_STD AS OVERALL_COND FROM {_condition_sql('OVERALL_COND_RAW')}""", "dirty"))
def q_standardize_condition(spark, sf):
    d = _dirty(spark, sf)
    return d.select(*KEY, T.standardize_condition(F.col("OVERALL_COND_RAW")).alias("OVERALL_COND"))


def _ordinal_sql(x):
    m = " ".join(f"WHEN '{k}' THEN {v}" for k, v in T.QUALITY_ORDINAL.items())
    return f"CAST(coalesce(CASE upper(coalesce({x}, 'UNKNOWN')) {m} END, {T.QUALITY_ORDINAL_DEFAULT}) AS BIGINT)"


@register("quality_ordinal", with_ctes(f"""
SELECT {KEY_SQL}, OVERALL_COND_STD AS OVERALL_COND, {_ordinal_sql('OVERALL_COND_STD')} AS condition_score
FROM {_condition_sql('OVERALL_COND_RAW')}""", "dirty"))
def q_quality_ordinal(spark, sf):
    d = _dirty(spark, sf)
    s = T.standardize_condition(F.col("OVERALL_COND_RAW"))
    return d.select(*KEY, s.alias("OVERALL_COND"), T.quality_ordinal(s).alias("condition_score"))


# ------------------------------------------------------------ K2 numeric --
_K2_COLS = ["SALE_PRICE", "GROSS_AREA", "INT_COND", "YR_BUILT", "TOTAL_VALUE", "ZIP_CODE"]


@register("clean_numeric", with_ctes(f"""
SELECT {KEY_SQL},
  TRY_CAST(replace(replace(MONEY_TEXT, '$', ''), ',', '') AS DOUBLE) AS SALE_PRICE,
  CASE WHEN GROSS_AREA_RAW <= 0 THEN NULL ELSE GROSS_AREA_RAW END AS GROSS_AREA,
  CAST(round_even(CASE WHEN INT_COND_NUM < 1 THEN 1.0 WHEN INT_COND_NUM > 5 THEN 5.0 ELSE INT_COND_NUM END, 0) AS BIGINT) AS INT_COND,
  CAST(round_even(YR_FRAC, 0) AS BIGINT) AS YR_BUILT,
  CASE WHEN TOTAL_VALUE_RAW < 0 THEN NULL ELSE TOTAL_VALUE_RAW END AS TOTAL_VALUE,
  trim(ZIP_CODE) AS ZIP_CODE
FROM dirty""", "dirty"))
def q_clean_numeric(spark, sf):
    d = _dirty(spark, sf).select(*KEY, F.col("MONEY_TEXT").alias("SALE_PRICE"),
                                 F.col("GROSS_AREA_RAW").alias("GROSS_AREA"),
                                 F.col("INT_COND_NUM").alias("INT_COND"), F.col("YR_FRAC").alias("YR_BUILT"),
                                 F.col("TOTAL_VALUE_RAW").alias("TOTAL_VALUE"), "ZIP_CODE")
    return rounded(C.clean_numeric(d, _K2_COLS))


@register("numeric_audit", with_ctes("""
SELECT 'GROSS_AREA_RAW' AS "column", CAST(count_if(GROSS_AREA_RAW <= 0) AS BIGINT) AS invalid FROM dirty
UNION ALL SELECT 'TOTAL_VALUE_RAW', CAST(count_if(TOTAL_VALUE_RAW < 0) AS BIGINT) FROM dirty""", "dirty"))
def q_numeric_audit(spark, sf):
    return C.numeric_audit(_dirty(spark, sf), ["GROSS_AREA_RAW", "TOTAL_VALUE_RAW"])


# ------------------------------------------------------------ K3 impute --
_K3 = ["LIVING_AREA_N", "YR_REMODEL", "BLDG_TYPE_N", "OWN_OCC_FLAG"]


@register("impute_missing", with_ctes(f"""
SELECT {KEY_SQL},
  round(coalesce(LIVING_AREA_N, (SELECT median(LIVING_AREA_N) FROM dirty)), 4) AS LIVING_AREA_N,
  coalesce(YR_REMODEL, (SELECT YR_REMODEL FROM dirty WHERE YR_REMODEL IS NOT NULL GROUP BY 1
                        ORDER BY count(*) DESC, 1 ASC LIMIT 1)) AS YR_REMODEL,
  coalesce(BLDG_TYPE_N, (SELECT BLDG_TYPE_N FROM dirty WHERE BLDG_TYPE_N IS NOT NULL GROUP BY 1
                         ORDER BY count(*) DESC, 1 ASC LIMIT 1)) AS BLDG_TYPE_N,
  coalesce(OWN_OCC_FLAG, false) AS OWN_OCC_FLAG
FROM dirty""", "dirty"), bench=True)
def q_impute_missing(spark, sf):
    d = cut_lineage(_dirty(spark, sf).select(*KEY, *_K3))   # joined once, read by every fit and by the projection
    roles = column_roles(d.select(*_K3))
    return rounded(C.impute(d, roles))


# ------------------------------------------------------------ K4 outliers --
_K4 = ["TOTAL_VALUE_OUT", "GROSS_AREA", "TT_RMS"]


def _clip_sql(lo_hi: dict) -> str:
    t_lo, t_hi = lo_hi["TOTAL_VALUE_OUT"]
    g_lo, g_hi = lo_hi["GROSS_AREA"]
    r_lo, r_hi = lo_hi["TT_RMS"]
    return f"""
SELECT {KEY_SQL},
  round(CASE WHEN TOTAL_VALUE_OUT > {t_hi} THEN {t_hi} ELSE TOTAL_VALUE_OUT END, 4) AS TOTAL_VALUE_OUT,
  round(CASE WHEN GROSS_AREA < {g_lo} THEN {g_lo} WHEN GROSS_AREA > ({g_hi}) * 1.5 THEN ({g_hi}) * 1.5
        ELSE GROSS_AREA END, 4) AS GROSS_AREA,
  round(CASE WHEN TT_RMS < {r_lo} THEN {r_lo} WHEN TT_RMS > {r_hi} THEN {r_hi} ELSE TT_RMS END, 4) AS TT_RMS
FROM dirty"""


def _iqr(c):
    q1 = f"(SELECT quantile_cont({c}, 0.25) FROM dirty)"
    q3 = f"(SELECT quantile_cont({c}, 0.75) FROM dirty)"
    return (f"({q1} - 1.5 * ({q3} - {q1}))", f"({q3} + 1.5 * ({q3} - {q1}))")


def _z(c, t=3.0):
    m, s = f"(SELECT avg({c}) FROM dirty)", f"(SELECT stddev_samp({c}) FROM dirty)"
    return (f"({m} - {t} * {s})", f"({m} + {t} * {s})")


@register("clip_iqr", with_ctes(_clip_sql({c: _iqr(c) for c in _K4}), "dirty"), bench=True)
def q_clip_iqr(spark, sf):
    d = _dirty(spark, sf).select(*KEY, *_K4)
    return rounded(C.clip_outliers(d.withColumn("TT_RMS", F.col("TT_RMS").cast("double")), _K4, "iqr", 1.5))


@register("clip_zscore", with_ctes(_clip_sql({c: _z(c) for c in _K4}), "dirty"))
def q_clip_zscore(spark, sf):
    d = _dirty(spark, sf).select(*KEY, *_K4)
    return rounded(C.clip_outliers(d.withColumn("TT_RMS", F.col("TT_RMS").cast("double")), _K4, "zscore", 3.0))


@register("outlier_audit", with_ctes(f"""
SELECT 'TOTAL_VALUE_OUT' AS "column", CAST(count_if(TOTAL_VALUE_OUT > {_iqr('TOTAL_VALUE_OUT')[1]}) AS BIGINT) AS n_clipped FROM dirty
UNION ALL SELECT 'GROSS_AREA', CAST(count_if(GROSS_AREA < {_iqr('GROSS_AREA')[0]} OR GROSS_AREA > {_iqr('GROSS_AREA')[1]} * 1.5) AS BIGINT) FROM dirty
UNION ALL SELECT 'TT_RMS', CAST(count_if(TT_RMS < {_iqr('TT_RMS')[0]} OR TT_RMS > {_iqr('TT_RMS')[1]}) AS BIGINT) FROM dirty""",
                                        "dirty"))
def q_outlier_audit(spark, sf):
    d = _dirty(spark, sf).select(*_K4)
    return C.outlier_audit(d, C.fit_outliers(d, _K4, "iqr", 1.5))


# ------------------------------------------------------------ K1 roles --
_ROLE_COLS = ["TOTAL_VALUE", "GROSS_AREA", "YR_BUILT", "HLF_BTH", "ZIP_CODE", "ADDRESS", "OWN_OCC_FLAG",
              "BLDG_TYPE", "STYLE_TEXT", "l_shipdate", "p_name", "c_nationkey"]


def _role_stats_sql():
    """One row per column: kind, only 0 and 1, share of time texts, mean length."""
    parts = []
    for c in _ROLE_COLS:
        text, number = f"CAST({c} AS VARCHAR)", f"TRY_CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS "column", typeof(any_value({c})) AS kind, coalesce(bool_and({c} IS NULL OR {number} IN (0, 1)), true) AS zero_one,
  count(TRY_CAST({text} AS TIMESTAMP)) / nullif(count({c}), 0) AS times, avg(length({text})) AS len FROM dirty""")
    return " UNION ALL ".join(parts)


@register("column_roles", with_ctes(f"""
SELECT "column", CASE WHEN regexp_matches(lower("column"), 'id|code|pid|upi') THEN 'identifier'
  WHEN regexp_matches(lower("column"), 'latitude|longitude|coord') THEN 'coordinates'
  WHEN regexp_matches(lower("column"), 'address|street|city|state') THEN 'address'
  WHEN contains(lower("column"), 'zip') AND (kind = 'VARCHAR' OR len = 5) THEN 'address'
  WHEN kind = 'BOOLEAN' THEN 'boolean' WHEN kind = 'DATE' OR starts_with(kind, 'TIMESTAMP') THEN 'datetime'
  WHEN kind <> 'VARCHAR' THEN CASE WHEN zero_one THEN 'boolean' ELSE 'numerical' END
  WHEN times >= 0.9 THEN 'datetime' WHEN len > 50 THEN 'text' ELSE 'categorical' END AS role
FROM ({_role_stats_sql()})""", "dirty"))
def q_column_roles(spark, sf):
    d = _dirty(spark, sf).select(*_ROLE_COLS)
    return roles_frame(spark, column_roles(d))


# ------------------------------------------------------------ D1-D3 --
_MISSING_COLS = ["TOTAL_VALUE", "GROSS_AREA", "LIVING_AREA_N", "BLDG_TYPE_N", "OWN_OCC_FLAG", "YR_REMODEL",
                 "CONDITION_TEXT", "OVERALL_COND_RAW"]


def _missing_sql(threshold=0.1):
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS r FROM dirty"
        for c in _MISSING_COLS)
    return f"""SELECT "column", round(r, 4) AS missing_ratio,
  'High missing values in ' || "column" || ': ' || format('{{:.2f}}', r * 100) || '%' AS message
FROM ({parts}) WHERE r > {threshold}"""


def _bounds_sql(src):
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count_if({c} < {lo} OR {c} > {hi}) AS BIGINT) AS n FROM {src}"
        for c, (lo, hi) in Q.DEFAULT_BOUNDS.items())
    return f"""SELECT "column", n AS n_outliers, 'Found ' || n || ' outliers in ' || "column" AS message
FROM ({parts}) WHERE n > 0"""


@register("missing_ratio", with_ctes(_missing_sql(), "dirty"))
def q_missing_ratio(spark, sf):
    d = _dirty(spark, sf).select(*_MISSING_COLS)
    return rounded(Q.missing_issues(d))


@register("bounds_violations", with_ctes(_bounds_sql("assess"), "assess"))
def q_bounds_violations(spark, sf):
    a = b.assess(spark, sf)
    return Q.bounds_issues(a)


@register("quality_suite", with_ctes(f"""
SELECT 'missing' AS "check", "column", missing_ratio AS value, message FROM ({_missing_sql()})
UNION ALL
SELECT 'bounds', "column", CAST(n_outliers AS DOUBLE), message FROM ({_bounds_sql('dirty')})""", "dirty"),
          bench=True)
def q_quality_suite(spark, sf):
    d = _dirty(spark, sf).select(*dict.fromkeys(_MISSING_COLS + list(Q.DEFAULT_BOUNDS)))
    return rounded(Q.quality_suite(d, cols=_MISSING_COLS))
