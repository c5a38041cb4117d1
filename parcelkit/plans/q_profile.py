"""Registered queries: profiling and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelkit.functions import text as T
from parcelkit.operators import features as FE
from parcelkit.operators import joins as J
from parcelkit.operators import profile as P
from parcelkit.plans import bindings as b
from parcelkit.plans.oracle import with_ctes
from parcelkit.plans.registry import register, round_to, rounded

KEY = b.ROW_KEY
KEY_SQL = ", ".join(KEY)

# (column, spark type name, numeric coercion in SQL)
_PROFILE_COLS = [
    ("TOTAL_VALUE_RAW", "double", "TOTAL_VALUE_RAW"),
    ("GROSS_AREA_RAW", "double", "GROSS_AREA_RAW"),
    ("LIVING_AREA_N", "double", "LIVING_AREA_N"),
    ("YR_REMODEL", "bigint", "CAST(YR_REMODEL AS DOUBLE)"),
    ("BLDG_TYPE_N", "string", "TRY_CAST(BLDG_TYPE_N AS DOUBLE)"),
    ("OWN_OCC_FLAG", "boolean", "CAST(OWN_OCC_FLAG AS DOUBLE)"),
    ("MONEY_TEXT", "string", "TRY_CAST(MONEY_TEXT AS DOUBLE)"),
    ("ZIP_CODE", "string", "TRY_CAST(ZIP_CODE AS DOUBLE)"),
    ("price_per_sqft", "double", "price_per_sqft"),
    ("property_age", "double", "property_age"),
]


def _profile_sql():
    eng = set(FE.ENGINEERED_FEATURES)
    parts = []
    for c, t, x in _PROFILE_COLS:
        cat = "Engineered" if c in eng else "Original"
        parts.append(f"""SELECT '{c}' AS feature, '{t}' AS type, count(*) - count({c}) AS missing_values,
  round((count(*) - count({c})) / count(*) * 100, 4) AS missing_percentage,
  count(DISTINCT {c}) AS unique_values, round(avg({x}), 4) AS mean, round(stddev_samp({x}), 4) AS std,
  round(min({x}), 4) AS min, round(max({x}), 4) AS max, '{cat}' AS category FROM prof""")
    return "\nUNION ALL\n".join(parts)


_PROF_CTE = """prof AS (SELECT *,
  CASE WHEN TOTAL_VALUE_RAW > 0 AND GROSS_AREA_RAW > 0 THEN TOTAL_VALUE_RAW / GROSS_AREA_RAW END AS price_per_sqft,
  CASE WHEN YR_BUILT_RAW > 1700 AND YR_BUILT_RAW <= 2025 THEN greatest(2025 - CAST(YR_BUILT_RAW AS DOUBLE), 0.0) END
    AS property_age
  FROM dirty)"""


def _prof_frame(spark, sf):
    d = b.dirty(spark, sf)
    r = FE.ratio_features(d.select(*[c for c, _, _ in _PROFILE_COLS if c in d.columns],
                                   F.col("TOTAL_VALUE_RAW").alias("TOTAL_VALUE"),
                                   F.col("GROSS_AREA_RAW").alias("GROSS_AREA"),
                                   F.col("YR_BUILT_RAW").alias("YR_BUILT")))
    p = FE.property_features(r)
    return p.select(*[c for c, _, _ in _PROFILE_COLS])


@register("column_profile", with_ctes(_profile_sql(), "dirty", extra=[_PROF_CTE]), bench=True)
def q_column_profile(spark, sf):
    return rounded(P.column_profile(_prof_frame(spark, sf)))


@register("profile_report", with_ctes(f"""
SELECT 'missing' AS section, feature, CAST(missing_values AS VARCHAR) AS cell_1,
  format('{{:.1f}}', missing_percentage) || '%' AS cell_2, NULL AS cell_3, NULL AS cell_4
FROM ({_profile_sql()}) WHERE missing_values > 0
UNION ALL
SELECT 'numeric', feature, coalesce(format('{{:,.2f}}', mean), 'N/A'), coalesce(format('{{:,.2f}}', std), 'N/A'),
  coalesce(format('{{:,.2f}}', min), 'N/A'), coalesce(format('{{:,.2f}}', max), 'N/A')
FROM ({_profile_sql()}) WHERE type IN ('double', 'bigint', 'int', 'float')""", "dirty", extra=[_PROF_CTE]))
def q_profile_report(spark, sf):
    prof = rounded(P.column_profile(_prof_frame(spark, sf)))
    return P.summary_tables(prof)


@register("value_counts", with_ctes("""
SELECT TT_RMS AS value, count(*) AS count FROM assess WHERE TT_RMS IS NOT NULL GROUP BY 1 ORDER BY 1""", "assess"))
def q_value_counts(spark, sf):
    return P.value_counts(b.assess(spark, sf), "TT_RMS")


@register("room_counts_outer", with_ctes("""
SELECT coalesce(t.value, r.value) AS value, t.n AS TT_RMS, r.n AS BED_RMS
FROM (SELECT CAST(TT_RMS AS DOUBLE) AS value, count(*) AS n FROM assess WHERE TT_RMS IS NOT NULL GROUP BY 1) t
FULL OUTER JOIN (SELECT CAST(BED_RMS AS DOUBLE) AS value, count(*) AS n FROM assess WHERE BED_RMS IS NOT NULL GROUP BY 1) r
ON t.value = r.value ORDER BY 1""", "assess"))
def q_room_counts_outer(spark, sf):
    return J.outer_align(b.assess(spark, sf), P.ROOM_COLUMNS)


def _corr_sql():
    cols = P.CORRELATION_COLUMNS
    rows = [f"SELECT '{a}' AS feature_a, '{c}' AS feature_b, round(corr({a}, {c}), 4) AS corr FROM assess"
            for a in cols for c in cols]
    return "\nUNION ALL\n".join(rows)


@register("correlation_matrix", with_ctes(_corr_sql(), "assess"))
def q_correlation_matrix(spark, sf):
    return rounded(P.correlation_matrix(b.assess(spark, sf)))


@register("regression_line", with_ctes("""
SELECT CAST(regr_count(BLDG_VALUE, LIVING_AREA_N) AS BIGINT) AS n,
  round(regr_slope(BLDG_VALUE, LIVING_AREA_N), 4) AS slope,
  round(regr_intercept(BLDG_VALUE, LIVING_AREA_N), 4) AS intercept,
  round(regr_r2(BLDG_VALUE, LIVING_AREA_N), 4) AS r2
FROM dirty""", "dirty"))
def q_regression_line(spark, sf):
    """Least-squares line over the non-null (x, y) pairs of all rows."""
    d = b.dirty(spark, sf)
    return rounded(P.regression_line(d, "BLDG_VALUE", "LIVING_AREA_N"))


@register("histogram", with_ctes("""
SELECT g.bin, round(mn + g.bin * w, 4) AS lo,
  round(CASE WHEN g.bin = 49 THEN mx ELSE mn + (g.bin + 1) * w END, 4) AS hi, coalesce(c.n, 0) AS count
FROM (SELECT range AS bin FROM range(50)) g
CROSS JOIN (SELECT min(TOTAL_VALUE) AS mn, max(TOTAL_VALUE) AS mx, (max(TOTAL_VALUE) - min(TOTAL_VALUE)) / 50 AS w
            FROM assess) s
LEFT JOIN (SELECT CAST(least(floor((TOTAL_VALUE - (SELECT min(TOTAL_VALUE) FROM assess)) /
                 ((SELECT max(TOTAL_VALUE) - min(TOTAL_VALUE) FROM assess) / 50)), 49) AS BIGINT) AS bin, count(*) AS n
           FROM assess GROUP BY 1) c ON c.bin = g.bin
ORDER BY 1""", "assess"), bench=True)
def q_histogram(spark, sf):
    return rounded(P.histogram(b.assess(spark, sf), "TOTAL_VALUE", 50))


@register("format_values", with_ctes(f"""
SELECT {KEY_SQL},
  CASE WHEN TOTAL_VALUE < 1000 THEN '$' || format('{{:,.0f}}', TOTAL_VALUE)
       WHEN TOTAL_VALUE < 1000000 THEN '$' || format('{{:,.0f}}', TOTAL_VALUE / 1000) || 'K'
       ELSE '$' || format('{{:,.1f}}', TOTAL_VALUE / 1000000) || 'M' END AS value_text,
  coalesce(format('{{:,.2f}}', round(LIVING_AREA_N, 4)), 'N/A') AS living_area_text,
  format('{{:.1f}}', round(LAND_VALUE / TOTAL_VALUE * 100, 4)) || '%' AS land_share_text
FROM dirty""", "dirty"))
def q_format_values(spark, sf):
    d = b.dirty(spark, sf)
    return d.select(*KEY, T.fmt_dollar_suffix(F.col("TOTAL_VALUE")).alias("value_text"),
                    T.fmt_thousands(round_to(F.col("LIVING_AREA_N"))).alias("living_area_text"),
                    T.fmt_percent(round_to(F.col("LAND_VALUE") / F.col("TOTAL_VALUE") * 100), 1)
                    .alias("land_share_text"))


@register("residual_histogram", with_ctes("""
SELECT g.bin, round(mn + g.bin * w, 4) AS lo,
  round(CASE WHEN g.bin = 29 THEN mx ELSE mn + (g.bin + 1) * w END, 4) AS hi, coalesce(c.n, 0) AS count
FROM (SELECT range AS bin FROM range(30)) g
CROSS JOIN (SELECT min(r) AS mn, max(r) AS mx, (max(r) - min(r)) / 30 AS w FROM res) s
LEFT JOIN (SELECT CAST(least(floor((r - (SELECT min(r) FROM res)) /
                 ((SELECT max(r) - min(r) FROM res) / 30)), 29) AS BIGINT) AS bin, count(*) AS n
           FROM res GROUP BY 1) c ON c.bin = g.bin
ORDER BY 1""", "assess", extra=["res AS (SELECT TOTAL_VALUE - prediction AS r FROM assess)"]))
def q_residual_histogram(spark, sf):
    """Residual distribution (30 equal-width bins) of the stand-in model."""
    a = b.assess(spark, sf).select((F.col("TOTAL_VALUE") - F.col("prediction")).alias("residual"))
    return rounded(P.histogram(a, "residual", 30))


def _cells_sql(*values):
    return " || ' | ' || ".join(f"coalesce(format('{{:,.2f}}', {v}), 'N/A')" for v in values)


@register("markdown_report", with_ctes(f"""
SELECT unnest(['# Feature Analysis Report', '', '## Dataset Overview', '- Total Features: ' || count(*),
  '- Total Samples: ' || (SELECT count(*) FROM prof), '- Original Features: ' || count_if(category = 'Original'),
  '- Engineered Features: ' || count_if(category = 'Engineered'), '']) AS value FROM profile
UNION ALL
SELECT unnest(['## Missing Values', '| Feature | Missing_Values | Missing_Percentage |', '|---|---|---|', ''])
FROM profile HAVING count_if(missing_values > 0) > 0
UNION ALL
SELECT '| ' || feature || ' | ' || missing_values || ' | ' || format('{{:.1f}}', missing_percentage) || '% |'
FROM profile WHERE missing_values > 0
UNION ALL
SELECT unnest(['## Numeric Features', '| Feature | Mean | Std | Min | Max |', '|---|---|---|---|---|', ''])
UNION ALL
SELECT '| ' || feature || ' | ' || {_cells_sql('mean', 'std', 'min', 'max')} || ' |'
FROM profile WHERE type IN ('double', 'bigint', 'int', 'float')""", "dirty", extra=[_PROF_CTE, f"profile AS ({_profile_sql()})"]))
def q_markdown_report(spark, sf):
    """Markdown summary (A12): overview, missing and numeric tables from the
    profile, written as one text file and read back as lines."""
    from parcelkit.session import scratch_path
    frame = _prof_frame(spark, sf)
    prof = rounded(P.column_profile(frame))
    ov = P.overview(frame, prof).first().asDict()
    lines = P.markdown_lines(ov, P.summary_tables(prof))
    path = scratch_path(spark, "feature-report-md")
    P.write_markdown(lines, path)
    return spark.read.text(path)
