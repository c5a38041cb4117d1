"""Registered queries: pipelines (K10-K12, K17, flagship), Spark ML (L2-L10,
K16, M5) and streaming (O1-O4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelkit.functions import text as T
from parcelkit.operators import clean as C
from parcelkit.operators import features as FE
from parcelkit.operators import forest as FO
from parcelkit.operators import metrics as M
from parcelkit.operators import mitigation as MI
from parcelkit.operators import ml as ML
from parcelkit.operators import profile as P
from parcelkit.operators import ranking as R
from parcelkit.operators.attribution import permutation_importance
from parcelkit.plans import bindings as b
from parcelkit.plans import pipeline as PL
from parcelkit.plans.oracle import with_ctes
from parcelkit.plans.q_clean import _address_sql, _groups_sql
from parcelkit.plans.q_encode import SPLIT_SQL, split_hash_col
from parcelkit.plans.q_features import _AREA_OK, _RENO_OK, _VALID_YB, _age_cat_sql, _cond_sql, _r
from parcelkit.plans.q_metrics import _metrics_sql
from parcelkit.plans.registry import register, rounded
from parcelkit.session import cut_lineage, scratch_path
from parcelkit.sources.tables import read_table, table_path
from parcelkit.streaming import feedback_stream as ST
from parcelkit.streaming import retrain_state as RS

KEY = b.ROW_KEY
Y = "TOTAL_VALUE"
AS_OF = FE.DEFAULT_AS_OF_YEAR


# ------------------------------------------------------------- pipelines --
def property_frame(spark, sf):
    """Raw property records with defects (the input of the clean chain)."""
    d = b.dirty(spark, sf)
    return d.select(*KEY, F.col("TOTAL_VALUE_RAW").alias("TOTAL_VALUE"), F.col("GROSS_AREA_RAW").alias("GROSS_AREA"),
                    F.col("LIVING_AREA_N").alias("LIVING_AREA"), "LAND_VALUE", "BLDG_VALUE",
                    F.col("YR_BUILT_RAW").alias("YR_BUILT"), "YR_REMODEL", "FULL_BTH", "HLF_BTH", "TT_RMS",
                    "ZIP_CODE", "ADDRESS", F.col("BLDG_TYPE_N").alias("BLDG_TYPE"), F.col("STYLE_TEXT").alias("STYLE"),
                    F.col("OVERALL_COND_RAW").alias("OVERALL_COND"), "OWN_OCC", "prediction")


def _clean(spark, sf):
    return PL.clean_data(property_frame(spark, sf), KEY, Y, passthrough=["prediction", "OWN_OCC"],
                         split_hash=split_hash_col())


# The chain in SQL: each step a CTE, the fitted statistics scalar subqueries.
KEY_SQL = ", ".join(KEY)
_REST = "ZIP_CODE, ADDRESS, STYLE, OWN_OCC, prediction, HLF_BTH"


def _mode_sql(c):
    return f"(SELECT {c} FROM prop WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


def _clip_sql(c, low, factor):
    """IQR clip of one column: an upper bound (times ``factor``), and a lower one unless price-like."""
    q1, q3 = (f"(SELECT quantile_cont({c}, {q}) FROM nums)" for q in (0.25, 0.75))
    lo, hi = f"({q1} - 1.5 * ({q3} - {q1}))", f"(({q3} + 1.5 * ({q3} - {q1})) * {factor})"
    floor = f"WHEN {c} < {lo} THEN {lo} " if low else ""
    return f"round(CASE {floor}WHEN {c} > {hi} THEN {hi} ELSE {c} END, 4) AS {c}"


_PROP_SQL = f"""prop AS (
  SELECT DISTINCT {KEY_SQL}, TOTAL_VALUE_RAW AS TOTAL_VALUE, GROSS_AREA_RAW AS GROSS_AREA,
    LIVING_AREA_N AS LIVING_AREA, LAND_VALUE, BLDG_VALUE, YR_BUILT_RAW AS YR_BUILT, YR_REMODEL, FULL_BTH, HLF_BTH,
    TT_RMS, ZIP_CODE, ADDRESS, BLDG_TYPE_N AS BLDG_TYPE, STYLE_TEXT AS STYLE, OVERALL_COND_RAW AS OVERALL_COND,
    OWN_OCC, prediction FROM dirty)"""
_NUMS_SQL = f"""nums AS (
  SELECT {KEY_SQL}, {_REST},
    CASE WHEN TOTAL_VALUE >= 0 THEN TOTAL_VALUE END AS TOTAL_VALUE,
    CASE WHEN GROSS_AREA > 0 THEN GROSS_AREA END AS GROSS_AREA,
    CASE WHEN LIVING > 0 THEN LIVING END AS LIVING_AREA,
    CASE WHEN LAND_VALUE >= 0 THEN LAND_VALUE END AS LAND_VALUE,
    CASE WHEN BLDG_VALUE >= 0 THEN BLDG_VALUE END AS BLDG_VALUE,
    coalesce(YR_BUILT, {_mode_sql('YR_BUILT')}) AS YR_BUILT,
    coalesce(YR_REMODEL, {_mode_sql('YR_REMODEL')}) AS YR_REMODEL,
    CAST(FULL_BTH AS DOUBLE) AS FULL_BTH, CAST(TT_RMS AS DOUBLE) AS TT_RMS,
    coalesce(BLDG_TYPE, {_mode_sql('BLDG_TYPE')}) AS BLDG_TYPE,
    coalesce(OVERALL_COND, {_mode_sql('OVERALL_COND')}) AS OVERALL_COND
  FROM (SELECT *, coalesce(LIVING_AREA, (SELECT quantile_cont(LIVING_AREA, 0.5) FROM prop)) AS LIVING FROM prop))"""
_CLEANED_SQL = f"""cleaned AS (
  SELECT {KEY_SQL}, {_clip_sql('TOTAL_VALUE', False, 1)}, {_clip_sql('GROSS_AREA', True, 1.5)},
    {_clip_sql('LIVING_AREA', True, 1.5)}, {_clip_sql('LAND_VALUE', False, 1)}, {_clip_sql('BLDG_VALUE', False, 1)},
    YR_BUILT, YR_REMODEL, {_clip_sql('FULL_BTH', True, 1)}, HLF_BTH, {_clip_sql('TT_RMS', True, 1)},
    trim(ZIP_CODE) AS ZIP_CODE, {_address_sql()} AS ADDRESS, upper(trim(BLDG_TYPE)) AS BLDG_TYPE,
    {_groups_sql('upper(trim(STYLE))', T.STYLE_TEXT_GROUPS)} AS STYLE, upper(trim(OVERALL_COND)) AS OVERALL_COND,
    OWN_OCC, prediction, {SPLIT_SQL} AS split
  FROM nums)"""
_CHAIN = [_PROP_SQL, _NUMS_SQL, _CLEANED_SQL]


def _flags_sql(c, categories):
    flags = ", ".join(f"CAST({c} = '{v}' AS DOUBLE) AS \"{c}_{v}\"" for v in categories)
    known = ", ".join(f"'{v}'" for v in categories)
    return f"{flags}, CAST({c} NOT IN ({known}) AS DOUBLE) AS \"{c}_UNKNOWN\""


# The categories of the table's building types and style groups, all in the train split.
_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_STYLES = ["CAPE COD", "COLONIAL", "CONTEMPORARY", "RANCH", "SPLIT LEVEL", "VICTORIAN"]
_BATHS = "coalesce(FULL_BTH, 0.0) + 0.5 * coalesce(CAST(HLF_BTH AS DOUBLE), 0.0)"
_ENGINEERED_SQL = f"""
SELECT {KEY_SQL}, TOTAL_VALUE, GROSS_AREA, LIVING_AREA, LAND_VALUE, BLDG_VALUE, YR_BUILT, YR_REMODEL, FULL_BTH, HLF_BTH, TT_RMS,
  ZIP_CODE, ADDRESS, {_flags_sql('BLDG_TYPE', _TYPES)}, {_flags_sql('STYLE', _STYLES)},
  {_cond_sql('OVERALL_COND')} AS OVERALL_COND, OWN_OCC, prediction, split,
  {_r('CASE WHEN TOTAL_VALUE > 0 AND GROSS_AREA > 0 THEN TOTAL_VALUE / GROSS_AREA END')} AS price_per_sqft,
  {_r('CASE WHEN TOTAL_VALUE > 0 THEN LAND_VALUE / TOTAL_VALUE END')} AS land_value_ratio,
  {_r('CASE WHEN TOTAL_VALUE > 0 THEN BLDG_VALUE / TOTAL_VALUE END')} AS building_value_ratio,
  CASE WHEN {_VALID_YB} THEN greatest({AS_OF} - yb, 0.0) END AS property_age,
  {_age_cat_sql(f'CASE WHEN {_VALID_YB} THEN greatest({AS_OF} - yb, 0.0) END')} AS age_category,
  {_BATHS} AS total_bathrooms, CAST(round_even({_BATHS}, 0) AS BIGINT) AS total_bathrooms_int,
  {_r(f'CASE WHEN {_AREA_OK} THEN g - lv END')} AS non_living_area,
  {_r(f'CASE WHEN {_AREA_OK} THEN lv / g END')} AS living_area_ratio,
  coalesce({_RENO_OK} AND rm > yb, false) AS has_renovation,
  CASE WHEN {_RENO_OK} THEN greatest({AS_OF} - rm, 0.0) END AS years_since_renovation
FROM (SELECT *, CAST(YR_BUILT AS DOUBLE) AS yb, CAST(YR_REMODEL AS DOUBLE) AS rm, GROSS_AREA AS g, LIVING_AREA AS lv
      FROM cleaned)"""


@register("flagship", with_ctes(f"""
SELECT CASE WHEN grouping(OWN_OCC) = 1 THEN 'overall' ELSE 'group' END AS level, OWN_OCC AS "group",
  count(*) AS n, {_metrics_sql(min_size=5)}
FROM cleaned GROUP BY ROLLUP (OWN_OCC)""", "dirty", extra=_CHAIN))
def q_flagship(spark, sf):
    """Clean chain (K10) -> property features (K8) -> grouped metrics."""
    c = _clean(spark, sf)
    feats = FE.property_features(c.data, AS_OF)
    return rounded(M.group_metrics(feats, Y, "prediction", "OWN_OCC", min_size=5))


@register("clean_pipeline", with_ctes("SELECT * FROM cleaned", "dirty", extra=_CHAIN))
def q_clean_pipeline(spark, sf):
    return rounded(_clean(spark, sf).data)


@register("engineer_pipeline", with_ctes(_ENGINEERED_SQL, "dirty", extra=_CHAIN))
def q_engineer_pipeline(spark, sf):
    return rounded(PL.engineer_features(_clean(spark, sf)).data)


@register("saved_pipeline", with_ctes("SELECT * EXCLUDE (split) FROM cleaned", "dirty", extra=_CHAIN))
def q_saved_pipeline(spark, sf):
    """Cleaning fitted once, saved as a pipeline model, loaded and applied to the raw records."""
    from pyspark.ml import PipelineModel

    from parcelkit.operators.stages import fit_cleaning
    raw = cut_lineage(C.dedup_rows(property_frame(spark, sf)))
    path = scratch_path(spark, "cleaning")
    ML.save_model(PipelineModel([fit_cleaning(raw, KEY, Y, ["prediction", "OWN_OCC"])]), path)
    return rounded(ML.load_model(path).transform(raw))


@register("chain_issues", with_ctes("""
SELECT 'missing' AS "check", c AS "column", round(v, 4) AS value, concat('High missing values in ', c, ': ', printf('%.2f', v * 100), '%') AS message
FROM (SELECT unnest(['LIVING_AREA', 'YR_REMODEL', 'OVERALL_COND', 'BLDG_TYPE']) AS c,
        unnest([avg(CAST(LIVING_AREA IS NULL AS INT)), avg(CAST(YR_REMODEL IS NULL AS INT)),
                avg(CAST(OVERALL_COND IS NULL AS INT)), avg(CAST(BLDG_TYPE IS NULL AS INT))]) AS v FROM raw)
WHERE v > 0.1
UNION ALL
SELECT 'bounds', c, CAST(n AS DOUBLE), concat('Found ', n, ' outliers in ', c)
FROM (SELECT unnest(['TOTAL_VALUE', 'GROSS_AREA', 'LAND_VALUE', 'BLDG_VALUE']) AS c,
        unnest([count_if(TOTAL_VALUE < 50000 OR TOTAL_VALUE > 5000000), count_if(GROSS_AREA < 100 OR GROSS_AREA > 20000),
                count_if(LAND_VALUE < 10000 OR LAND_VALUE > 2000000),
                count_if(BLDG_VALUE < 10000 OR BLDG_VALUE > 3000000)]) AS n FROM raw)
WHERE n > 0""", "dirty", extra=["""raw AS (
  SELECT TOTAL_VALUE_RAW AS TOTAL_VALUE, GROSS_AREA_RAW AS GROSS_AREA, LIVING_AREA_N AS LIVING_AREA, LAND_VALUE, BLDG_VALUE,
    YR_REMODEL, OVERALL_COND_RAW AS OVERALL_COND, BLDG_TYPE_N AS BLDG_TYPE FROM dirty)"""]))
def q_chain_issues(spark, sf):
    """Issues that the quality step of the clean chain finds in the raw records."""
    return rounded(_clean(spark, sf).issues)


@register("feature_report")
def q_feature_report(spark, sf):
    """All tables of the report job as one (table, row) listing, a row as JSON."""
    e = PL.engineer_features(_clean(spark, sf)).data
    tables = PL.feature_reports(e.drop(*KEY))
    out = None
    for name, df in tables.items():
        df = rounded(df)
        part = df.select(F.lit(name).alias("table"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out


@register("feature_report_counts", with_ctes("""
SELECT 'value_counts' AS "table", TT_RMS AS value, count(*) AS n_1, NULL::BIGINT AS n_2 FROM cleaned WHERE TT_RMS IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'room_counts', TT_RMS, count(*), NULL FROM cleaned WHERE TT_RMS IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'regression_line', NULL, CAST(regr_count(BLDG_VALUE, LIVING_AREA) AS BIGINT), NULL FROM cleaned
UNION ALL
SELECT 'correlation', NULL, count(*), NULL FROM (SELECT unnest(range(_CORR_)))
UNION ALL
SELECT 'value_histogram', NULL, count(*), 50 FROM cleaned""".replace("_CORR_", str(len(set(P.CORRELATION_COLUMNS) - {"BED_RMS"}) ** 2)), "dirty", extra=_CHAIN))
def q_feature_report_counts(spark, sf):
    """The counts in the report's tables (K12, K13), read back from their JSON rows: values, room counts, pairs of the regression
    line, pairs of correlated columns (the records have no BED_RMS), and the rows and bins of the histogram."""
    rows = cut_lineage(q_feature_report(spark, sf))

    def field(name, kind="bigint"):
        return F.get_json_object("row", f"$.{name}").cast(kind)

    def part(table):
        return rows.where(F.col("table") == table)

    none = F.lit(None).cast("bigint")
    value = F.lit(None).cast("double").alias("value")
    table = F.col("table")
    listed = part("value_counts").select(table, field("value", "double").alias("value"), field("count").alias("n_1"), none.alias("n_2"))
    rooms = part("room_counts").select(table, field("value", "double").alias("value"), field("TT_RMS").alias("n_1"), none.alias("n_2"))
    line = part("regression_line").select(table, value, field("n").alias("n_1"), none.alias("n_2"))
    pairs = part("correlation").agg(F.count(F.lit(1)).alias("n_1")).select(F.lit("correlation").alias("table"), value, "n_1", none.alias("n_2"))
    bins = part("value_histogram").agg(F.sum(field("count")).alias("n_1"), F.count(F.lit(1)).alias("n_2")).select(
        F.lit("value_histogram").alias("table"), value, "n_1", "n_2")
    return listed.unionByName(rooms).unionByName(line).unionByName(pairs).unionByName(bins)


@register("final_dataset", with_ctes(_ENGINEERED_SQL, "dirty", extra=_CHAIN))
def q_final_dataset(spark, sf):
    """Engineered X joined back to y (K17), written partitioned by split (A4)
    and read back, both splits."""
    from parcelkit.sources.files import write_dataset
    e = PL.engineer_features(_clean(spark, sf)).data
    x = e.drop(Y)
    y = e.select(*KEY, Y)
    path = scratch_path(spark, "final-dataset")
    write_dataset(rounded(PL.final_dataset(x, y, KEY)), path, "split")
    return spark.read.parquet(path)


# ------------------------------------------------------------------- ML --
def _ml_frame(spark, sf):
    a = b.with_indicators(b.assess(spark, sf))
    mf = FE.model_features(a, AS_OF, keep=KEY + [Y, "OWN_OCC"])
    return cut_lineage(R.hash_split(mf, split_hash_col()))


def _features(df):
    return [c for c in df.columns if c not in KEY + [Y, "split", "OWN_OCC"]]


def _forest(d):
    """The declared forest, fitted on the train split once per model store."""
    return FO.stored_forest(d.where("split = 'train'"), _features(d), Y, **ML.TRAINING_CONFIGS["random_forest"])


def _tested(d, model):
    """Key, label and prediction of the test split, scored once."""
    return cut_lineage(model.transform(d.where("split = 'test'")).select(*KEY, Y, "prediction"))


def _held_out(d):
    """The train split without its last fifth, and that fifth: the validation rows."""
    parts = R.holdout_tail(d.where("split = 'train'"), [F.col(c) for c in KEY], 0.2, "part")
    return tuple(cut_lineage(parts.where(F.col("part") == F.lit(p)).drop("part")) for p in ("train", "validation"))


@register("rf_score")
def q_rf_score(spark, sf):
    d = _ml_frame(spark, sf)
    return rounded(_tested(d, _forest(d)))


@register("gbt_score")
def q_gbt_score(spark, sf):
    d = _ml_frame(spark, sf)
    m, _ = ML.train_with_patience(*_held_out(d), _features(d), Y, **ML.TRAINING_CONFIGS["gbt"])
    return rounded(m.transform(d.where("split = 'test'")).select(*KEY, Y, "prediction"))


_TEST_ROWS_SQL = f"SELECT {KEY_SQL}, TOTAL_VALUE FROM assess WHERE {SPLIT_SQL} = 'test'"


@register("score_checks", with_ctes(f"""
SELECT unnest(['random_forest', 'gbt']) AS model, *, true AS plausible FROM ({_TEST_ROWS_SQL})""", "assess"))
def q_score_checks(spark, sf):
    """Every test row once per model.  ``plausible``: a forest's prediction, a mean of labels, lies between the least and the
    largest training label, a boosted one is finite.  (In this binding the features hardly tell the label, so a model need not beat
    the mean label.)"""
    d = _ml_frame(spark, sf)
    lo, hi = d.where("split = 'train'").agg(F.min(Y), F.max(Y)).first()
    boosted, _ = ML.train_with_patience(*_held_out(d), _features(d), Y, **ML.TRAINING_CONFIGS["gbt"])
    p, parts = F.col("prediction"), []
    for name, model, ok in (("random_forest", _forest(d), p.between(lo - 1e-6, hi + 1e-6)),
                            ("gbt", boosted, ~F.isnan(p) & (F.abs(p) < 1e12))):
        parts.append(_tested(d, model).select(F.lit(name).alias("model"), *KEY, Y, ok.alias("plausible")))
    return parts[0].unionByName(parts[1])


@register("random_search")
def q_random_search(spark, sf):
    d = _ml_frame(spark, sf).where("split = 'train'")
    _, table = FO.search_forest(d, _features(d), Y, KEY, ML.sample_grid(ML.RF_SEARCH, 2), folds=2,
                                base=ML.TRAINING_CONFIGS["random_forest"])
    return rounded(table)


@register("feature_importance")
def q_feature_importance(spark, sf):
    d = _ml_frame(spark, sf)
    return rounded(R.top_k(_forest(d).importance(), "importance", 10, tiebreak=["feature"]))


def _trained(d):
    train, validation = _held_out(d)
    return ML.train_models(train, d.where("split = 'test'"), _features(d), Y, params=ML.TRAINING_CONFIGS,
                           validation_df=validation, fitted={"random_forest": _forest(d)})


@register("train_models")
def q_train_models(spark, sf):
    d = _ml_frame(spark, sf)
    res = _trained(d)
    table = res[0].metrics
    for r in res[1:]:
        table = table.unionByName(r.metrics)
    return rounded(table)


@register("run_log")
def q_run_log(spark, sf):
    """Train loop (L7) with the experiment log (A9): metric rows of every
    model appended to a Parquet log, read back."""
    from parcelkit.sources.files import log_run, read_runs
    d = _ml_frame(spark, sf)
    res = _trained(d)
    path = scratch_path(spark, "run-log")
    for r in res:
        metrics = r.metrics.drop("model").first().asDict()          # one aggregated row
        log_run(spark, path, "run-1", r.name, metrics, ML.TRAINING_CONFIGS[r.name])
    return read_runs(spark, path).drop("ts")


@register("validation_gate")
def q_validation_gate(spark, sf):
    d = _ml_frame(spark, sf)
    pred = _tested(d, _forest(d))
    t = M.threshold_table(M.to_long(M.validation_metrics(pred, Y, "prediction")))
    return rounded(t.withColumn("validation_passed", M.gate(t).select("validation_passed").scalar()))


@register("permutation_importance")
def q_permutation_importance(spark, sf):
    d = _ml_frame(spark, sf)
    feats = _features(d)
    m = _forest(d)
    test = d.where("split = 'test'")
    pi = permutation_importance(m, test, feats, Y, KEY, assemble=lambda x: x)
    return rounded(pi)


@register("batch_score")
def q_batch_score(spark, sf):
    d = _ml_frame(spark, sf)
    m = _forest(d)
    path = scratch_path(spark, "model")
    FO.copy_forest(m, path)
    loaded = FO.load_forest(spark, path)
    return ML.score(loaded, d, KEY, version="1").drop("scored_at")


@register("batch_score_checks", with_ctes(f"SELECT {KEY_SQL}, '1' AS model_version, true AS as_fitted FROM assess", "assess"))
def q_batch_score_checks(spark, sf):
    """Every row scored once by the model that was saved, copied and loaded; ``as_fitted``: as by the fitted one."""
    d = _ml_frame(spark, sf)
    path = scratch_path(spark, "model")
    fitted = _forest(d)
    FO.copy_forest(fitted, path)
    first = cut_lineage(fitted.transform(d).withColumnRenamed("prediction", "_fitted"))
    again = ML.score(FO.load_forest(spark, path), first, [*KEY, "_fitted"], version="1")
    return again.select(*KEY, "model_version", (F.abs(F.col("prediction") - F.col("_fitted")) < 1e-6).alias("as_fitted"))


@register("residual_summary")
def q_residual_summary(spark, sf):
    from parcelkit.functions.stats import exact_quantiles
    d = _ml_frame(spark, sf)
    res = _tested(d, _forest(d)).select((F.col(Y) - F.col("prediction")).alias("residual"))
    return rounded(exact_quantiles(res, [], "residual", [0.1, 0.25, 0.5, 0.75, 0.9]))


@register("mitigate")
def q_mitigate(spark, sf):
    d = _ml_frame(spark, sf)
    res = PL.mitigate(d, _features(d), Y, "OWN_OCC", KEY, name="linear")
    return rounded(res.candidates)


@register("bias_mitigation_rounds")
def q_bias_mitigation_rounds(spark, sf):
    """Evaluate -> mitigate significant features -> re-evaluate (M7)."""
    d = _gap_frame(spark, sf)
    reports, _ = PL.evaluate_and_mitigate(d, _gap_features(d), Y, _GROUPS, KEY, name="linear")
    return rounded(reports)


_GROUPS = {"OWN_OCC": "OWN_OCC", "GROUP_2": "GROUP_2"}


def _gap_frame(spark, sf):
    """One group's values are 40 % higher, and the features do not say which group a row is in."""
    a = b.with_indicators(b.assess(spark, sf))
    mf = FE.model_features(a, AS_OF, keep=KEY + [Y, "OWN_OCC"])
    second = F.pmod(F.col("l_suppkey"), F.lit(2)).cast("bigint")
    gap = F.when(F.col("OWN_OCC") == 1, 1.4).otherwise(1.0)
    return cut_lineage(mf.withColumn("GROUP_2", second).withColumn(Y, F.col(Y) * gap))


def _gap_features(df):
    """Model features without the air-conditioning indicators, of which one equals OWN_OCC in this binding."""
    return [c for c in _features(df) if c != "GROUP_2" and not c.startswith("AC_TYPE_")]


def _mitigated(spark, sf):
    d = _gap_frame(spark, sf)
    return PL.evaluate_and_mitigate(d, _gap_features(d), Y, _GROUPS, KEY, name="linear")[1]


@register("mitigated_predictions")
def q_mitigated_predictions(spark, sf):
    """Every row's label, groups, mitigated prediction and the plain model's."""
    return rounded(_mitigated(spark, sf))


_MITIGATED_SQL = f"""
SELECT {KEY_SQL}, round(TOTAL_VALUE * CASE WHEN OWN_OCC = 1 THEN 1.4 ELSE 1.0 END, 4) AS TOTAL_VALUE, OWN_OCC,
  CAST(l_suppkey % 2 AS BIGINT) AS GROUP_2, true AS predicted, true AS score_lower FROM assess"""


@register("mitigation_checks", with_ctes(_MITIGATED_SQL, "assess"))
def q_mitigation_checks(spark, sf):
    """Every row once, with a finite prediction; ``score_lower``: the disparity score of OWN_OCC, whose values were
    raised, is lower than that of the plain model."""
    out = cut_lineage(_mitigated(spark, sf))
    now, first = PL.disparity_scores(out, Y, "OWN_OCC", ["prediction", "first_prediction"])
    return rounded(out.select(*KEY, Y, "OWN_OCC", "GROUP_2", (~F.isnan("prediction") & (F.abs("prediction") < 1e12)).alias("predicted"),
                              F.lit(now < first).alias("score_lower")))


_MOMENT_COLUMNS = ["LIVING_AREA", "GROSS_AREA", "BED_RMS", "TT_RMS"]


_SCALED_SQL = ", ".join(f"(CAST({c} AS DOUBLE) - avg({c}) OVER ()) / stddev_pop({c}) OVER ()" for c in [*_MOMENT_COLUMNS, Y])


@register("group_moments", with_ctes(f"""
SELECT a."group" AS "group", a.name AS a, b.name AS b, count(*) AS n, round(avg(a.z * b.z), 4) AS moment
FROM z a JOIN z b USING ({KEY_SQL}) GROUP BY ALL""", "assess", extra=[f"""z AS (
  SELECT OWN_OCC AS "group", unnest({[*_MOMENT_COLUMNS, Y]}) AS name, unnest([{_SCALED_SQL}]) AS z, {KEY_SQL} FROM assess)"""]))
def q_group_moments(spark, sf):
    """Standardised moments of some features and the label in each group, from the pass that the mitigation reads."""
    a = b.assess(spark, sf)
    spread = a.agg(F.avg(Y).alias("m"), F.stddev_pop(Y).alias("s")).first()
    scaled = a.withColumn(Y, (F.col(Y) - F.lit(spread["m"])) / F.lit(spread["s"]))
    got = MI.group_moments(scaled, _MOMENT_COLUMNS, Y, "OWN_OCC")
    names = [*_MOMENT_COLUMNS, Y]
    rows = [(g, p, q, int(m[0, 0]), float(m[i, j] / m[0, 0])) for g, m in got.by_group.items()
            for i, p in enumerate(names, 1) for j, q in enumerate(names, 1)]
    return rounded(spark.createDataFrame(rows, '`group` long, a string, b string, n long, moment double'))


# ------------------------------------------------------------- streaming --
def _events_stream(spark, sf):
    schema = read_table(spark, sf, "events").schema
    return ST.file_stream(spark, table_path(sf, "events"), schema)


@register("stream_feedback_daily", with_ctes("""
SELECT CAST(created_at AS DATE) AS date, count(*) AS feedback_count,
  round(avg(deviation), 4) AS avg_deviation,
  round(sqrt(avg((actual_price - predicted_price) * (actual_price - predicted_price))), 4) AS rmse,
  round(avg(abs(actual_price - predicted_price)), 4) AS mae,
  round(avg(confidence), 4) AS avg_confidence
FROM feedback GROUP BY 1""", "feedback"))
def q_stream_feedback_daily(spark, sf):
    return rounded(ST.stream_feedback_daily(spark, _events_stream(spark, sf)))


@register("stream_retrain", with_ctes("""
SELECT window_start, CAST(window_start + INTERVAL 30 DAY AS DATE) AS window_end, CAST(sum(n) AS BIGINT) AS feedback_count,
  round(sqrt(sum(sse) / sum(n)), 4) AS rmse, round(sum(sae) / sum(n), 4) AS mae,
  round(sum(sdev) / sum(n), 4) AS avg_deviation,
  coalesce(sum(n) >= 50 AND (sqrt(sum(sse) / sum(n)) > 150000 OR sum(sae) / sum(n) > 100000
           OR sum(sdev) / sum(n) > 0.3), false) AS retrain_needed
FROM (SELECT CAST(unnest(generate_series(day - INTERVAL 29 DAY, day, INTERVAL 1 DAY)) AS DATE) AS window_start,
        n, sse, sae, sdev
      FROM (SELECT CAST(created_at AS DATE) AS day, count(*) AS n,
              sum((actual_price - predicted_price) * (actual_price - predicted_price)) AS sse,
              sum(abs(actual_price - predicted_price)) AS sae, sum(deviation) AS sdev
            FROM feedback WHERE confidence >= 7 GROUP BY 1))
GROUP BY 1""", "feedback"))
def q_stream_retrain(spark, sf):
    return rounded(ST.stream_retrain(spark, _events_stream(spark, sf)))


@register("stream_retrain_state", with_ctes("""
SELECT 'all' AS feed, d AS day, feedback_count, rmse, mae, avg_deviation, needed AS retrain_needed,
  needed <> lag(needed, 1, false) OVER (ORDER BY d) AS flipped
FROM (SELECT d, CAST(coalesce(sum(n), 0) AS BIGINT) AS feedback_count, round(sqrt(sum(sse) / sum(n)), 4) AS rmse,
        round(sum(sae) / sum(n), 4) AS mae, round(sum(sdev) / sum(n), 4) AS avg_deviation,
        coalesce(sum(n) >= 50 AND (sqrt(sum(sse) / sum(n)) > 150000 OR sum(sae) / sum(n) > 100000
                 OR sum(sdev) / sum(n) > 0.3), false) AS needed
      FROM (SELECT CAST(unnest(generate_series(min(day), CAST(max(newest) - INTERVAL 1 DAY AS DATE) - INTERVAL 1 DAY,
                                               INTERVAL 1 DAY)) AS DATE) AS d FROM sums)
      LEFT JOIN sums ON day BETWEEN d - INTERVAL 29 DAY AND d GROUP BY d)""", "feedback", extra=["""sums AS (
  SELECT CAST(created_at AS DATE) AS day, max(created_at) AS newest, count(*) AS n, sum(abs(actual_price - predicted_price)) AS sae,
    sum((actual_price - predicted_price) * (actual_price - predicted_price)) AS sse, sum(deviation) AS sdev
  FROM feedback WHERE confidence >= 7 GROUP BY 1)"""]))
def q_stream_retrain_state(spark, sf):
    """The trailing trigger of every day that the watermark has closed, from arbitrary state and timers."""
    return rounded(RS.stream_retrain_state(spark, _events_stream(spark, sf), every_day=True))


@register("stream_validate", with_ctes("SELECT id, reasons = '' AS accepted, reasons FROM feedback_checked",
                                       "feedback_checked"))
def q_stream_validate(spark, sf):
    acc, rej = ST.stream_validate(spark, _events_stream(spark, sf))
    return acc.unionByName(rej).select("id", "accepted", "reasons")


@register("stream_score")
def q_stream_score(spark, sf):
    d = _ml_frame(spark, sf)
    feats = _features(d)
    m = ML.train(d.where("split = 'train'"), feats, Y, "linear")
    li = ST.file_stream(spark, table_path(sf, "lineitem"), read_table(spark, sf, "lineitem").schema)
    o, p, c = (read_table(spark, sf, t) for t in ("orders", "part", "customer"))
    rows = b.with_indicators(b.assess_from_joined(b.joined(li, o, p, c)))
    feats_stream = FE.model_features(rows, AS_OF, keep=KEY)
    return ST.stream_score(spark, feats_stream, m, KEY).drop("scored_at")


@register("stream_score_checks", with_ctes(f"SELECT {KEY_SQL}, '1' AS model_version, count(*) AS n FROM assess GROUP BY ALL", "assess"))
def q_stream_score_checks(spark, sf):
    """Rows of the scoring stream per key, counted where the prediction equals the batch model's on the same row."""
    d = _ml_frame(spark, sf)
    m = ML.train(d.where("split = 'train'"), _features(d), Y, "linear")
    batch = m.transform(d).groupBy(*KEY).agg(F.min("prediction").alias("lo"), F.max("prediction").alias("hi"))
    live = q_stream_score(spark, sf)
    same = live.join(batch, KEY).where(F.col("prediction").between(F.col("lo") - 1e-4, F.col("hi") + 1e-4))
    return same.groupBy(*KEY, "model_version").agg(F.count(F.lit(1)).alias("n"))
