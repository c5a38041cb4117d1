"""Registered queries: metrics, gate, fairness, attribution (D14-D18, D22,
D23, B13, E6, E7, E10, J4, M1-M4, M6, M9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelkit.operators import attribution as AT
from parcelkit.operators import fairness as FA
from parcelkit.operators import metrics as M
from parcelkit.operators import ranking as R
from parcelkit.operators.joins import flag_members
from parcelkit.plans import bindings as b
from parcelkit.plans.oracle import with_ctes
from parcelkit.plans.registry import register, rounded

KEY = b.ROW_KEY
KEY_SQL = ", ".join(KEY)
Y, P = "TOTAL_VALUE", "prediction"


def _r(x):
    return f"round({x}, 4)"


# ------------------------------------------------------------ D14 / D15 --
@register("regression_metrics", with_ctes(f"""
SELECT {_r('1 - sum((TOTAL_VALUE - prediction) * (TOTAL_VALUE - prediction)) / (var_pop(TOTAL_VALUE) * count(TOTAL_VALUE))')} AS r2,
  {_r('sqrt(avg((TOTAL_VALUE - prediction) * (TOTAL_VALUE - prediction)))')} AS rmse,
  {_r('avg(abs(TOTAL_VALUE - prediction))')} AS mae,
  {_r('avg(abs((TOTAL_VALUE - prediction) / NULLIF(TOTAL_VALUE, 0))) * 100')} AS mape,
  {_r('stddev_pop(TOTAL_VALUE - prediction)')} AS std_residuals,
  {_r('max(abs(TOTAL_VALUE - prediction))')} AS max_error,
  {_r('median(abs(TOTAL_VALUE - prediction))')} AS median_error,
  {_r('avg(prediction)')} AS mean_prediction,
  {_r('stddev_pop(prediction)')} AS std_prediction
FROM assess""", "assess"), bench=True)
def q_regression_metrics(spark, sf):
    return rounded(M.regression_metrics(b.assess(spark, sf), Y, P))


_VAL_SQL = f"""SELECT {_r('pow(corr(prediction, TOTAL_VALUE), 2)')} AS r2,
  {_r('sqrt(avg((prediction - TOTAL_VALUE) * (prediction - TOTAL_VALUE)))')} AS rmse,
  {_r('avg(abs(prediction - TOTAL_VALUE))')} AS mae FROM assess"""


@register("validation_metrics", with_ctes(_VAL_SQL, "assess"))
def q_validation_metrics(spark, sf):
    return rounded(M.validation_metrics(b.assess(spark, sf), Y, P))


@register("threshold_table", with_ctes(f"""
SELECT metric, value, threshold, coalesce(CASE WHEN metric = 'r2' THEN value >= threshold
                                               ELSE value <= threshold END, true) AS passed
FROM (SELECT 'r2' AS metric, r2 AS value FROM v UNION ALL SELECT 'rmse', rmse FROM v UNION ALL SELECT 'mae', mae FROM v
      UNION ALL SELECT 'n', CAST(n AS DOUBLE) FROM v) m
LEFT JOIN (SELECT 'r2' AS metric, CAST(0.8 AS DOUBLE) AS threshold UNION ALL SELECT 'rmse', CAST(1.0 AS DOUBLE)
           UNION ALL SELECT 'mae', CAST(0.8 AS DOUBLE)) t
USING (metric)""", "assess", extra=[f"v AS ({_VAL_SQL.replace(' FROM assess', ', count(*) AS n FROM assess')})"]))
def q_threshold_table(spark, sf):
    a = b.assess(spark, sf)
    m = rounded(a.agg(F.pow(F.corr(P, Y), 2).alias("r2"), F.sqrt(F.avg((F.col(P) - F.col(Y)) ** 2)).alias("rmse"),
                      F.avg(F.abs(F.col(P) - F.col(Y))).alias("mae"), F.count(F.lit(1)).alias("n")))
    return M.threshold_table(M.to_long(m))


@register("metrics_json", with_ctes(f"""
SELECT r2, (r2 >= 0.8 AND rmse <= 1.0 AND mae <= 0.8) AS validation_passed FROM ({_VAL_SQL})""",
                                    "assess"))
def q_metrics_json(spark, sf):
    from parcelkit.sources.files import read_metric_from_json
    m = rounded(M.validation_metrics(b.assess(spark, sf), Y, P))
    th = M.VALIDATION_THRESHOLDS
    passed = ((F.col("r2") >= th["r2"]) & (F.col("rmse") <= th["rmse"]) & (F.col("mae") <= th["mae"]))
    doc = m.select(F.to_json(F.struct(F.struct("r2", "rmse", "mae").alias("metrics"),
                                      passed.alias("validation_passed"))).alias("doc"))
    return read_metric_from_json(doc, "doc", "metrics.r2").select(
        F.col("value").alias("r2"), F.get_json_object("doc", "$.validation_passed").cast("boolean").alias(
            "validation_passed"))


# ---------------------------------------------------------- D16 / D17 --
_MET_SQL = """n, {rm} AS rmse, {r2} AS r2, {mae} AS mae, {mp} AS mean_prediction, {pd} AS prediction_difference"""


def _metrics_sql(y="TOTAL_VALUE", p="prediction", min_size=None, rnd=True):
    parts = {
        "rmse": f"sqrt(avg(({y} - {p}) * ({y} - {p})))",
        "r2": f"1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count({y}))",
        "mae": f"avg(abs({y} - {p}))",
        "mean_prediction": f"avg({p})",
        "prediction_difference": f"avg(abs({p} - {y}))",
    }
    out = []
    for k, v in parts.items():
        e = f"CASE WHEN count(*) >= {min_size} THEN {v} END" if min_size else v
        out.append(f"{_r(e) if rnd else e} AS {k}")
    return ", ".join(out)


@register("group_metrics", with_ctes(f"""
SELECT CASE WHEN grouping(OWN_OCC) = 1 THEN 'overall' ELSE 'group' END AS level, OWN_OCC AS "group",
  count(*) AS n, {_metrics_sql(min_size=5)}
FROM assess GROUP BY ROLLUP (OWN_OCC)""", "assess"))
def q_group_metrics(spark, sf):
    return rounded(M.group_metrics(b.assess(spark, sf), Y, P, "OWN_OCC", min_size=5))


_GM_SQL = f"""gm AS (SELECT OWN_OCC AS g, {_metrics_sql(rnd=False)} FROM assess GROUP BY 1)"""


def _disp_sql(src="gm", feature=None):
    rows = []
    for m in M.DISPARITY_METRICS:
        p = f"max(CASE WHEN g = 1 THEN {m} END)"
        u = f"max(CASE WHEN g = 0 THEN {m} END)"
        f = f"'{feature}' AS feature, " if feature else ""
        rows.append(f"SELECT {f}'{m}_difference' AS disparity, {p} - {u} AS value FROM {src} HAVING count(*) = 2")
        rows.append(f"SELECT {f}'{m}_ratio', CASE WHEN {u} <> 0 THEN {p} / {u} END FROM {src} HAVING count(*) = 2")
    return "\nUNION ALL\n".join(rows)


@register("group_disparities", with_ctes(f"""
SELECT disparity, round(value, 4) AS value FROM ({_disp_sql()})
WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)""", "assess", extra=[_GM_SQL]))
def q_group_disparities(spark, sf):
    a = b.assess(spark, sf)
    by_group = M.group_metrics(a, Y, P, "OWN_OCC", overall=False)
    return rounded(M.disparities(by_group))


# ------------------------------------------------------------- M1 / M2 --
_HZ_SQL = """zm AS (SELECT ZIP_CODE, median(TOTAL_VALUE) AS m FROM assess GROUP BY 1 HAVING count(*) >= 5),
hz AS (SELECT ZIP_CODE FROM zm WHERE m > (SELECT median(m) FROM zm)),
fa AS (SELECT a.*, CAST(CASE WHEN hz.ZIP_CODE IS NULL THEN 0 ELSE 1 END AS BIGINT) AS HIGH_VALUE_ZIP
       FROM assess a LEFT JOIN hz ON a.ZIP_CODE = hz.ZIP_CODE)"""
FEATURES = {"OWN_OCC": "OWN_OCC", "ZIP_CODE": "HIGH_VALUE_ZIP"}


def _fairness_frame(spark, sf):
    a = b.assess(spark, sf).select(*KEY, "ZIP_CODE", "OWN_OCC", Y, P)
    high = FA.high_value_zips(a, "ZIP_CODE", Y)
    return flag_members(a, high, "ZIP_CODE", "HIGH_VALUE_ZIP")


_BM_SQL = f"""bm AS (
  SELECT 'OWN_OCC' AS feature, OWN_OCC AS g, 'group' AS level, count(*) AS n, {_metrics_sql(rnd=False)}
  FROM fa GROUP BY OWN_OCC
  UNION ALL SELECT 'ZIP_CODE', HIGH_VALUE_ZIP, 'group', count(*), {_metrics_sql(rnd=False)} FROM fa GROUP BY HIGH_VALUE_ZIP
  UNION ALL SELECT 'OWN_OCC', NULL, 'overall', count(*), {_metrics_sql(rnd=False)} FROM fa
  UNION ALL SELECT 'ZIP_CODE', NULL, 'overall', count(*), {_metrics_sql(rnd=False)} FROM fa)"""


@register("bias_analysis", with_ctes("SELECT feature, g AS \"group\", level, n, round(rmse, 4) AS rmse, round(r2, 4) AS r2, "
                                     "round(mae, 4) AS mae, round(mean_prediction, 4) AS mean_prediction, "
                                     "round(prediction_difference, 4) AS prediction_difference FROM bm",
                                     "assess", extra=[_HZ_SQL, _BM_SQL]))
def q_bias_analysis(spark, sf):
    fa = _fairness_frame(spark, sf)
    return rounded(FA.bias_metrics(FA.sensitive_long(fa, FEATURES, Y, P)))


def _bias_report_sql():
    def dsel(feature):
        src = f"(SELECT g, rmse, r2, mean_prediction FROM bm WHERE level = 'group' AND feature = '{feature}')"
        return (f"SELECT '{feature}' AS feature, "
                f"CASE WHEN count(*) = 2 AND max(CASE WHEN g = 0 THEN rmse END) <> 0 THEN "
                f"max(CASE WHEN g = 1 THEN rmse END) / max(CASE WHEN g = 0 THEN rmse END) END AS rr, "
                f"CASE WHEN count(*) = 2 THEN max(CASE WHEN g = 1 THEN r2 END) - max(CASE WHEN g = 0 THEN r2 END) END AS r2d, "
                f"CASE WHEN count(*) = 2 THEN max(CASE WHEN g = 1 THEN mean_prediction END) - "
                f"max(CASE WHEN g = 0 THEN mean_prediction END) END AS mpd FROM {src}")
    t, s = FA.TIGHT, FA.STANDARD
    return f"""
d AS ({dsel('OWN_OCC')} UNION ALL {dsel('ZIP_CODE')}),
base AS (SELECT coalesce(median(mean_prediction), {FA.DEFAULT_BASE_PRICE}) AS bp FROM bm WHERE level = 'group' AND g IN (0, 1)),
sw AS (SELECT coalesce((SELECT rr FROM d WHERE feature = 'OWN_OCC'), 1.0) < {FA.TIGHT_SWITCH} AS tight),
rep AS (SELECT feature, coalesce(rr, 1.0) AS rr, abs(coalesce(r2d, 0.0)) AS r2d, abs(coalesce(mpd, 0.0)) AS mpd,
  (SELECT bp FROM base) AS bp,
  CASE WHEN (SELECT tight FROM sw) THEN {t['rmse_ratio_upper']} ELSE {s['rmse_ratio_upper']} END AS up,
  CASE WHEN (SELECT tight FROM sw) THEN {t['rmse_ratio_lower']} ELSE {s['rmse_ratio_lower']} END AS lo,
  CASE WHEN (SELECT tight FROM sw) THEN {t['r2_difference']} ELSE {s['r2_difference']} END AS r2t,
  CASE WHEN (SELECT tight FROM sw) THEN {t['price_share']} ELSE {s['price_share']} END AS ps
  FROM d)"""


@register("bias_report", with_ctes(f"""
SELECT feature, round(rr, 4) AS rmse_ratio, round(r2d, 4) AS r2_difference, round(mpd, 4) AS mean_prediction_difference,
  round(bp, 4) AS base_price, CAST(up AS DOUBLE) AS rmse_ratio_upper, CAST(lo AS DOUBLE) AS rmse_ratio_lower,
  CAST(r2t AS DOUBLE) AS r2_threshold, round(bp * ps, 4) AS mean_prediction_threshold,
  ((rr > up OR rr < lo OR r2d > r2t OR mpd > bp * ps) AND NOT isnan(rr) AND NOT isinf(rr)) AS significant,
  concat_ws('; ',
    CASE WHEN rr > 1.2 THEN 'Model predictions show ' || format('{{:.1f}}', (rr - 1) * 100) ||
         '% higher error rates for disadvantaged groups in ' || feature
         WHEN rr < 0.8 THEN 'Model predictions show ' || format('{{:.1f}}', (1 - rr) * 100) ||
         '% higher error rates for privileged groups in ' || feature END,
    CASE WHEN abs(r2d) > 0.1 THEN 'Model performance (R²) is ' || format('{{:.1f}}', abs(r2d * 100)) || '% better for ' ||
         CASE WHEN r2d > 0 THEN 'privileged' ELSE 'unprivileged' END || ' groups in ' || feature END,
    CASE WHEN abs(mpd) > 0 THEN 'Average predictions are $' || format('{{:,.2f}}', abs(mpd)) || ' higher for ' ||
         CASE WHEN mpd > 0 THEN 'privileged' ELSE 'unprivileged' END || ' groups in ' || feature END) AS interpretation
FROM rep""", "assess", extra=[_HZ_SQL, _BM_SQL, _bias_report_sql()]))
def q_bias_report(spark, sf):
    fa = _fairness_frame(spark, sf)
    metrics = FA.bias_metrics(FA.sensitive_long(fa, FEATURES, Y, P))
    return rounded(FA.bias_report(metrics, list(FEATURES)))


@register("bias_summary", with_ctes(f"""
SELECT count_if(sig) > 0 AS bias_detected, count(*) AS features_analyzed, CAST(count_if(sig) AS BIGINT) AS features_with_bias,
  CASE WHEN count_if(sig) > 0 THEN 'Bias Detected' ELSE 'No Significant Bias' END AS status
FROM (SELECT ((rr > up OR rr < lo OR r2d > r2t OR mpd > bp * ps) AND NOT isnan(rr) AND NOT isinf(rr)) AS sig FROM rep)""",
                                   "assess", extra=[_HZ_SQL, _BM_SQL, _bias_report_sql()]))
def q_bias_summary(spark, sf):
    fa = _fairness_frame(spark, sf)
    rep = FA.bias_report(FA.bias_metrics(FA.sensitive_long(fa, FEATURES, Y, P)), list(FEATURES))
    return FA.bias_summary(rep)


@register("bias_report_json")
def q_bias_report_json(spark, sf):
    fa = _fairness_frame(spark, sf)
    rep = FA.bias_report(FA.bias_metrics(FA.sensitive_long(fa, FEATURES, Y, P)), list(FEATURES))
    return FA.report_document(rep)


_DOC_SCHEMA = """bias_detected boolean,
  summary struct<status: string, features_analyzed: bigint, features_with_bias: bigint, base_price: double,
    thresholds: struct<rmse_ratio_upper: double, rmse_ratio_lower: double, r2_threshold: double, mean_prediction_threshold: double>>,
  significant_disparities array<struct<feature: string, significant: boolean, interpretation: string,
    disparities: struct<rmse_ratio: double, r2_difference: double, mean_prediction_difference: double>>>"""


@register("bias_report_fields", with_ctes("""
SELECT s.k > 0 AS bias_detected, CASE WHEN s.k > 0 THEN 'Bias Detected' ELSE 'No Significant Bias' END AS status,
  s.n AS features_analyzed, s.k AS features_with_bias, round(s.bp, 4) AS base_price, s.up AS rmse_ratio_upper, s.lo AS rmse_ratio_lower,
  s.r2t AS r2_threshold, round(s.bp * s.ps, 4) AS mean_prediction_threshold,
  r.feature, round(r.rr, 4) AS rmse_ratio, round(r.r2d, 4) AS r2_difference, round(r.mpd, 4) AS mean_prediction_difference
FROM (SELECT count(*) AS n, CAST(count_if(sig) AS BIGINT) AS k, max(bp) AS bp, CAST(max(up) AS DOUBLE) AS up,
        CAST(max(lo) AS DOUBLE) AS lo, CAST(max(r2t) AS DOUBLE) AS r2t, max(ps) AS ps FROM flagged) s
LEFT JOIN flagged r ON r.sig""", "assess", extra=[_HZ_SQL, _BM_SQL, _bias_report_sql(), """flagged AS (
  SELECT *, (rr > up OR rr < lo OR r2d > r2t OR mpd > bp * ps) AND NOT isnan(rr) AND NOT isinf(rr) AS sig FROM rep)"""]))
def q_bias_report_fields(spark, sf):
    """The JSON document read back: its summary beside each significant feature (one row without, if there is none)."""
    doc = q_bias_report_json(spark, sf).select(F.from_json("report", _DOC_SCHEMA).alias("d")).select("d.*")
    one = doc.select("bias_detected", "summary.*", F.explode_outer("significant_disparities").alias("f"))
    return rounded(one.select("bias_detected", "status", "features_analyzed", "features_with_bias", "base_price", "thresholds.*",
                              "f.feature", "f.disparities.*"))


@register("fairness_groups", with_ctes("""
SELECT HIGH_VALUE_ZIP AS "group", count(*) AS n, round(avg(prediction), 4) AS mean_prediction,
  round(avg(TOTAL_VALUE), 4) AS mean_actual,
  round(sqrt(avg((TOTAL_VALUE - prediction) * (TOTAL_VALUE - prediction))), 4) AS rmse
FROM fa GROUP BY 1""", "assess", extra=[_HZ_SQL]))
def q_fairness_groups(spark, sf):
    return rounded(FA.group_stats(_fairness_frame(spark, sf), Y, P, "HIGH_VALUE_ZIP"))


# ------------------------------------------------------------- M3 / M4 / M6 --
_GS_SQL = """gs AS (SELECT
  max(CASE WHEN OWN_OCC = 0 THEN mp END) AS m0, max(CASE WHEN OWN_OCC = 1 THEN mp END) AS m1,
  max(CASE WHEN OWN_OCC = 0 THEN ma END) AS t0, max(CASE WHEN OWN_OCC = 1 THEN ma END) AS t1,
  max(CASE WHEN OWN_OCC = 0 THEN e END) AS e0, max(CASE WHEN OWN_OCC = 1 THEN e END) AS e1,
  max(CASE WHEN OWN_OCC = 0 THEN n END) AS n0, max(CASE WHEN OWN_OCC = 1 THEN n END) AS n1
  FROM (SELECT OWN_OCC, count(*) AS n, avg(prediction) AS mp, avg(TOTAL_VALUE) AS ma,
        sqrt(avg((TOTAL_VALUE - prediction) * (TOTAL_VALUE - prediction))) AS e FROM assess GROUP BY 1)),
sw AS (SELECT *, e1 / e0 AS r, abs(m1 - m0) / (m0 + m1) AS share FROM gs),
bw AS (SELECT *, CASE WHEN r < 0.8 THEN greatest(1.0, (1 / r) * share) ELSE greatest(1.0, r * share) END AS base FROM sw)"""


@register("sample_weights", with_ctes(f"""
SELECT {KEY_SQL}, OWN_OCC,
  round(CASE WHEN OWN_OCC = 1 THEN (CASE WHEN m1 > m0 THEN base ELSE 1 / base END)
        ELSE (CASE WHEN r < 0.8 THEN 1.0 ELSE base END) END, 4) AS weight_pass1,
  round(CASE WHEN OWN_OCC = 1 THEN (n0 + n1) / (2 * n1) ELSE (n0 + n1) / (2 * n0) END, 4) AS weight_pass2
FROM assess, bw""", "assess", extra=[_GS_SQL]))
def q_sample_weights(spark, sf):
    a = b.assess(spark, sf).select(*KEY, "OWN_OCC", Y, P)
    return rounded(FA.sample_weights(a, Y, P, "OWN_OCC").drop(Y, P))


@register("disparity_score", with_ctes(f"""
SELECT round(rr, 4) AS rmse_ratio, round(mpd, 4) AS mean_prediction_difference, round(r2d, 4) AS r2_difference,
  round(rd, 4) AS rmse_disparity, round(pd, 4) AS pred_disparity, round(r2dd, 4) AS r2_disparity,
  round(CASE WHEN rr < 0.8 THEN 0.5 * rd + 0.3 * pd + 0.2 * r2dd ELSE 0.5 * pd + 0.3 * rd + 0.2 * r2dd END, 4)
    AS disparity_score
FROM (SELECT *, CASE WHEN rr >= 1.0 THEN abs(rr - 1.0) ELSE abs(1 / rr - 1.0) END AS rd,
        abs(mpd) / (SELECT avg(TOTAL_VALUE) FROM assess) AS pd, abs(r2d) AS r2dd
      FROM (SELECT max(CASE WHEN g = 1 THEN rmse END) / max(CASE WHEN g = 0 THEN rmse END) AS rr,
              max(CASE WHEN g = 1 THEN mean_prediction END) - max(CASE WHEN g = 0 THEN mean_prediction END) AS mpd,
              max(CASE WHEN g = 1 THEN r2 END) - max(CASE WHEN g = 0 THEN r2 END) AS r2d FROM gm))""",
                                       "assess", extra=[f"gm AS (SELECT OWN_OCC AS g, {_metrics_sql(rnd=False)} FROM assess GROUP BY 1)"]))
def q_disparity_score(spark, sf):
    a = b.assess(spark, sf)
    wide = FA.disparity_wide(a, Y, P, "OWN_OCC")
    mean_y = a.select(F.avg(Y)).scalar()
    return rounded(FA.disparity_score(wide, mean_y))


@register("calibrate", with_ctes(f"""
SELECT {KEY_SQL}, OWN_OCC, prediction, round(f, 4) AS calibration_factor, round(prediction * f, 4) AS calibrated
FROM (SELECT a.*, CASE WHEN keep THEN (CASE WHEN OWN_OCC = 1 THEN f1 WHEN OWN_OCC = 0 THEN f0 ELSE 1.0 END)
                       ELSE 1.0 END AS f
      FROM assess a, (SELECT *, ok AND abs(m1 * f1 - m0 * f0) < abs(m1 - m0) AS keep FROM (
          SELECT *, m0 > 0 AND m1 > 0 AS ok,
            CASE WHEN m0 > 0 AND m1 > 0 AND (t1 / t0) / (m1 / m0) > 1 THEN (t1 / t0) / (m1 / m0) ELSE 1.0 END AS f1,
            CASE WHEN m0 > 0 AND m1 > 0 AND NOT ((t1 / t0) / (m1 / m0) > 1) THEN 1 / ((t1 / t0) / (m1 / m0)) ELSE 1.0 END AS f0
          FROM gs)) c)""", "assess", extra=[_GS_SQL]))
def q_calibrate(spark, sf):
    a = b.assess(spark, sf).select(*KEY, "OWN_OCC", Y, P)
    return rounded(FA.calibrate(a, Y, P, "OWN_OCC").drop(Y))


# ------------------------------------------------------- attribution --
# Stand-in linear valuation model (coefficients per feature).
LINEAR_COEFS = {"GROSS_AREA": 20.0, "LIVING_AREA": 5.0, "LAND_SF": 2.0, "YR_BUILT": 100.0, "FULL_BTH": 5000.0,
                "HLF_BTH": 2500.0, "TT_RMS": 1000.0, "BED_RMS": 3000.0, "LAND_VALUE": 0.1, "BLDG_VALUE": 0.2,
                "p_retailprice": 1.0, "l_discount": -20000.0}


def _attr_sql():
    rows = [f"SELECT '{f}' AS feature, avg(abs({w} * (CAST({f} AS DOUBLE) - (SELECT avg(CAST({f} AS DOUBLE)) FROM assess)))) AS importance FROM assess"
            for f, w in LINEAR_COEFS.items()]
    return "imp AS (" + "\nUNION ALL\n".join(rows) + ")"


@register("top_importance", with_ctes("""
SELECT feature, round(importance, 4) AS importance FROM imp ORDER BY importance DESC LIMIT 10""", "assess",
                                      extra=[_attr_sql()]))
def q_top_importance(spark, sf):
    a = b.assess(spark, sf)
    imp = AT.mean_abs_attribution(a, LINEAR_COEFS)
    return rounded(R.top_k(imp, "importance", 10))


@register("mean_importance", with_ctes("SELECT round(avg(importance), 4) AS mean_importance FROM imp", "assess",
                                       extra=[_attr_sql()]))
def q_mean_importance(spark, sf):
    a = b.assess(spark, sf)
    return rounded(AT.overall_importance(a, LINEAR_COEFS))


def _total_sql():
    parts = [f"abs({w} * (CAST({f} AS DOUBLE) - (SELECT avg(CAST({f} AS DOUBLE)) FROM assess)))"
             for f, w in LINEAR_COEFS.items()]
    return " + ".join(parts)


@register("argmax_row", with_ctes(f"""
SELECT {KEY_SQL}, round(total_abs_attribution, 4) AS total_abs_attribution FROM (
  SELECT {KEY_SQL}, {_total_sql()} AS total_abs_attribution FROM assess)
ORDER BY total_abs_attribution DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 1""",
                                  "assess"))
def q_argmax_row(spark, sf):
    a = b.assess(spark, sf)
    totals = AT.attribution_totals(a, LINEAR_COEFS, KEY)
    return rounded(R.argmax_row(totals, "total_abs_attribution", KEY))


# ------------------------------------------------------------------ E10 --
_MODELS_SQL = """models AS (
  SELECT 1 AS position, 'linear_a' AS model, l_quantity * 2000 + p_retailprice AS p, TOTAL_VALUE FROM assess
  UNION ALL SELECT 2, 'linear_b', l_quantity * 1800 + p_retailprice * CAST(1.5 AS DOUBLE), TOTAL_VALUE FROM assess
  UNION ALL SELECT 3, 'building_share', BLDG_VALUE * CAST(1.05 AS DOUBLE), TOTAL_VALUE FROM assess)"""


def _candidates(a):
    q, rp = F.col("l_quantity"), F.col("p_retailprice")
    return a.select(Y, F.stack(F.lit(3), F.lit(1), F.lit("linear_a"), q * 2000 + rp,
                               F.lit(2), F.lit("linear_b"), q * 1800 + rp * 1.5,
                               F.lit(3), F.lit("building_share"), F.col("BLDG_VALUE") * 1.05)
                    .alias("position", "model", "p"))


@register("best_model", with_ctes(f"""
SELECT model, round(r2, 4) AS r2 FROM (
  SELECT position, model, 1 - sum((TOTAL_VALUE - p) * (TOTAL_VALUE - p)) / (var_pop(TOTAL_VALUE) * count(*)) AS r2
  FROM models GROUP BY 1, 2) WHERE r2 > 0 ORDER BY r2 DESC, position LIMIT 1""", "assess", extra=[_MODELS_SQL]))
def q_best_model(spark, sf):
    c = _candidates(b.assess(spark, sf))
    scores = c.groupBy("position", "model").agg(M.r2_score(Y, "p").alias("r2"))
    return rounded(R.best_model(scores))


@register("model_scores", with_ctes(f"""
SELECT model, round(1 - sum((TOTAL_VALUE - p) * (TOTAL_VALUE - p)) / (var_pop(TOTAL_VALUE) * count(*)), 4) AS r2
FROM models GROUP BY 1""", "assess", extra=[_MODELS_SQL]))
def q_model_scores(spark, sf):
    c = _candidates(b.assess(spark, sf))
    return rounded(c.groupBy("model").agg(M.r2_score(Y, "p").alias("r2")))
