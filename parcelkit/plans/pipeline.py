"""Job chains: clean (K10), engineer (K11), reports (K12), final dataset
(K17), bias mitigation (M5, M7).

Each chain is a lazy plan with a handful of small "fit" actions (roles,
impute values, clip bounds, vocabularies).  The deduplicated frame is
written once to the shared checkpoint folder so that the fits and the final
write read it instead of recomputing the dedup shuffle (and survive an
executor loss without recomputing from the source).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.functions.numeric import log_grid
from parcelkit.operators import clean as C
from parcelkit.operators import encode as E
from parcelkit.operators import fairness as FA
from parcelkit.operators import features as FE
from parcelkit.operators import mitigation as MI
from parcelkit.operators import ml as ML
from parcelkit.operators import profile as P
from parcelkit.operators import quality as Q
from parcelkit.operators.ranking import hash_split
from parcelkit.operators.roles import column_roles
from parcelkit.session import cut_lineage


#: How often a deduplicated record stood in the input.
_ROWS = "_rows"


@dataclass
class CleanResult:
    data: DataFrame            # key + cleaned columns + target + split
    issues: DataFrame          # quality issues of the raw input
    roles: dict = field(default_factory=dict)


def clean_data(df: DataFrame, key: list[str], target: str = "TOTAL_VALUE", passthrough: list[str] | None = None,
               rules: Q.Rules = Q.Rules(), split_hash=None, test_fraction: float = 0.2,
               checkpoint: bool = True, fit_on: str = "all") -> CleanResult:
    """quality -> roles -> dedup -> impute -> numeric -> address -> categorical
    -> outliers -> target split -> train/test split (K10).

    ``fit_on='all'`` fits statistics on all rows (the reference order);
    ``'train'`` fits them on the train split only (no leakage)."""
    passthrough = passthrough or []
    value_cols = [c for c in df.columns if c not in key and c not in passthrough]
    d = C.count_rows(df, _ROWS)
    if split_hash is None:
        split_hash = F.xxhash64(*[F.col(c) for c in key])
    d = hash_split(d, split_hash, test_fraction)
    if checkpoint:
        d = cut_lineage(d)
    # The check of the records as they came: each distinct one counts as often as it stood there; a few rows.
    issues = cut_lineage(Q.quality_suite(d, rules, value_cols, _ROWS))
    d = d.drop(_ROWS)
    # roles from the deduplicated, checkpointed frame: one pass over the
    # checkpoint instead of another pass over the source
    roles = column_roles(d.select(*value_cols))
    fit_rows = d.where(F.col("split") == "train") if fit_on == "train" else d
    d = C.fit_impute(fit_rows, roles).apply(d)
    numeric_cols = [c for c in roles["numerical"] if c != target] + ([target] if target in roles["numerical"] else [])
    d = C.clean_numeric(d, numeric_cols, keep=key + passthrough)
    d = C.clean_address(d, roles["address"])
    d = C.standardize_categorical(d, roles["categorical"])
    fit_rows = d.where(F.col("split") == "train") if fit_on == "train" else d
    d = C.fit_outliers(fit_rows, roles["numerical"], skip_integers=True).apply(d)
    if target not in d.columns:
        raise ValueError(f"Target column {target} not found in dataframe")
    return CleanResult(d, issues, roles)


@dataclass
class EngineerResult:
    data: DataFrame
    encoders: dict
    issues: DataFrame


def engineer_features(clean: CleanResult, as_of_year: int = FE.DEFAULT_AS_OF_YEAR,
                      max_categories: int = 10) -> EngineerResult:
    """Fit encoders on the train split, apply to all rows, then ratio and
    property features, and the quality suite on the train split (K11)."""
    d = clean.data
    train = d.where(F.col("split") == "train")
    cat = [c for c in clean.roles.get("categorical", []) if c != "OVERALL_COND"]
    enc = E.fit_encoders(train, cat, max_categories)
    out = E.apply_encoders(d, enc)
    out = FE.ratio_features(out)
    out = FE.property_features(out, as_of_year)
    issues = cut_lineage(Q.quality_suite(out.where(F.col("split") == "train")))
    return EngineerResult(out, enc, issues)


def feature_reports(df: DataFrame) -> dict[str, DataFrame]:
    """Report tables (K12): profile, value counts, room counts, correlation,
    regression line, value histogram (total recomputed from its parts)."""
    total = F.coalesce(F.col("BLDG_VALUE").try_cast("double"), F.lit(0.0)) + \
        F.coalesce(F.col("LAND_VALUE").try_cast("double"), F.lit(0.0)) \
        if {"BLDG_VALUE", "LAND_VALUE"} & set(df.columns) else F.lit(None).cast("double")
    with_total = df.withColumn("REPORT_TOTAL_VALUE", total)
    out = {"profile": P.column_profile(df), "correlation": P.correlation_matrix(df)}
    if "TT_RMS" in df.columns:
        out["value_counts"] = P.value_counts(df, "TT_RMS")
    if set(P.ROOM_COLUMNS) & set(df.columns):
        from parcelkit.operators.joins import outer_align
        out["room_counts"] = outer_align(df, [c for c in P.ROOM_COLUMNS if c in df.columns])
    if {"BLDG_VALUE", "LIVING_AREA"} <= set(df.columns):
        out["regression_line"] = P.regression_line(df)
    out["value_histogram"] = P.histogram(with_total, "REPORT_TOTAL_VALUE", 50)
    return out


def final_dataset(features: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Engineered X joined back to y on the row key."""
    from parcelkit.operators.joins import align_target
    return align_target(features, target, key)


# ------------------------------------------------------------- mitigation --

@dataclass
class MitigationResult:
    candidates: DataFrame      # pass, strength, disparity_score, chosen
    predictions: DataFrame     # key, group, prediction (best or original, calibrated)


def constraint_grid(pred: DataFrame, label: str, group: str) -> tuple[int, int, int]:
    """(low, high, size) of the log grid of constraint weights: tighter where
    the ratio of the groups' errors is far from 1."""
    error = F.pow(F.col(label) - F.col("prediction"), 2)
    rmse = pred.select(*[F.sqrt(F.avg(F.when(F.col(group) == g, error))).alias(f"g{g}") for g in (0, 1)])
    ratio = rmse.select(F.abs(1 - F.try_divide("g1", "g0"))).first()[0]
    return (-3, -1, 15) if ratio is not None and ratio > 0.3 else (-4, -1, 10)


def _mitigate_by_fits(df: DataFrame, features: list[str], label: str, group: str, key: list[str],
                      name: str, grid_size: int | None = None, checkpoint: bool = True, **params) -> MitigationResult:
    """Mitigation search (M5) for models without closed form: fit the model with group sample
    weights of pass 1 and pass 2 (M3) at several strengths (log grid:
    ``grid_size`` values, or 15 where the groups' errors differ by more than
    30 % and 10 from a lower start where not), score each by the disparity score (M4), keep the lowest, fall back to the
    unweighted model, then apply group calibration (M6)."""
    base_df = cut_lineage(df) if checkpoint else df
    mean_y = base_df.select(F.avg(label)).first()[0]

    def fit_score(weight_col=None):
        kw = dict(params)
        if weight_col:
            kw["weightCol"] = weight_col
        m = ML.train(base_df, features, label, name, **kw)
        pred = m.transform(base_df).select(*key, group, label, "prediction")
        wide = FA.disparity_wide(pred, label, "prediction", group)
        s = FA.disparity_score(wide, F.lit(mean_y)).select("disparity_score").first()
        return m, pred, (s[0] if s else None)

    orig_model, orig_pred, orig_score = fit_score()
    # weights from the original model's predictions
    w = FA.sample_weights(orig_pred.join(base_df.drop(label, group), key), label, "prediction", group)
    w = w.drop("prediction")
    w = cut_lineage(w) if checkpoint else w
    grid = (-3, -1, grid_size) if grid_size else constraint_grid(orig_pred, label, group)
    strengths = [g / 0.1 for g in log_grid(*grid)]   # (0, 1]
    rows = [(0, 0.0, orig_score)]
    best, best_at = (orig_score if orig_score is not None else float("inf"), orig_pred), 0
    for p in (1, 2):
        for s in strengths:
            col = f"_w{p}"
            cand = w.withColumn(col, F.lit(1.0) + (F.col(f"weight_pass{p}") - 1.0) * F.lit(s))
            m = ML.train(cand, features, label, name, weightCol=col, **params)
            pred = m.transform(cand).select(*key, group, label, "prediction")
            wide = FA.disparity_wide(pred, label, "prediction", group)
            sc = FA.disparity_score(wide, F.lit(mean_y)).select("disparity_score").first()
            sc = sc[0] if sc else None
            rows.append((p, float(s), sc))
            if sc is not None and sc < best[0]:
                best, best_at = (sc, pred), len(rows) - 1
    # Equal scores: the first candidate, so exactly one row is chosen.
    cands = df.sparkSession.createDataFrame([(*r, i == best_at) for i, r in enumerate(rows)],
                                            "pass int, strength double, disparity_score double, chosen boolean")
    calibrated = FA.calibrate(best[1], label, "prediction", group)
    return MitigationResult(cands, calibrated)


def mitigate(df: DataFrame, features: list[str], label: str, group: str, key: list[str],
             name: str = "linear", grid_size: int | None = None, **params) -> MitigationResult:
    """Mitigation search (M5) followed by group calibration (M6).

    For the linear model every candidate (both passes' weights, the grid of bounds on a group's loss, squared and
    absolute loss) is the averaged predictor of a reductions loop over the groups' moments: three passes over the data
    in all, the first some columns at a time (``operators.mitigation``).  Other models are fitted again per pass and strength of the weights."""
    if name != "linear" or params:
        return _mitigate_by_fits(df, features, label, group, key, name, grid_size, **params)
    found = MI.fit_mitigation(df, features, label, group, grid_size and (lambda _: log_grid(-3, -1, grid_size)))
    candidates = df.sparkSession.createDataFrame(
        found.candidates, "pass int, loss string, bound double, holds boolean, disparity_score double, chosen boolean")
    predicted = df.select(*key, label, group, found.prediction().alias("prediction"), found.factor(group).alias("calibration_factor"))
    return MitigationResult(candidates, predicted.withColumn("calibrated", F.col("prediction") * F.col("calibration_factor")))


def disparity_scores(df: DataFrame, label: str, group: str, predictions: list[str]) -> list[float]:
    """The disparity score of each prediction column, one aggregate; infinite where there are not two groups."""
    y = F.col(label)
    aggs = [F.avg(y).alias("y"), F.count(label).alias("n")]
    for i, p in enumerate(predictions):
        error = F.pow(y - F.col(p), 2)
        aggs += [F.sqrt(F.avg(error)).alias(f"e{i}"), F.avg(p).alias(f"m{i}"),
                 (1 - F.try_divide(F.sum(error), F.var_pop(y) * F.count(label))).alias(f"r{i}")]
    rows = {r[group]: r for r in df.where(F.col(group).isin(0, 1)).groupBy(group).agg(*aggs).collect()}   # two rows
    if set(rows) != {0, 1}:
        return [float("inf")] * len(predictions)
    mean = sum(r["y"] * r["n"] for r in rows.values()) / sum(r["n"] for r in rows.values())
    out = []
    for i in range(len(predictions)):
        of = {k: [rows[g][f"{c}{i}"] or 0.0 for g in (0, 1)] for k, c in (("rmse", "e"), ("mean_prediction", "m"), ("r2", "r"))}
        out.append(MI.disparity(of, mean))
    return out


def evaluate_and_mitigate(df: DataFrame, features: list[str], label: str, sensitive: dict[str, str],
                          key: list[str], rounds: int = 3, name: str = "linear", **kw) -> tuple[DataFrame, DataFrame]:
    """Up to ``rounds`` rounds (M7): analyse bias of the current predictions,
    mitigate each significant feature after the other, and analyse once more
    at the end.  Returns (the report of every round, the mitigated predictions
    with the key, label and groups); the last round's report is of the latter.

    Features are chained: a later one's result replaces the predictions that the
    earlier one left, but only if the feature's disparity score gets lower; the
    rounds end when none does.  ``first_prediction`` is that of the plain model."""
    pred_col = "prediction"
    model = ML.train(df, features, label, name)
    kept = [*dict.fromkeys([*key, label, *sensitive.values(), pred_col, "first_prediction"])]   # the joins carry no features
    current = cut_lineage(model.transform(df).withColumn("first_prediction", F.col(pred_col)).select(*kept))
    found: dict[str, DataFrame] = {}
    reports = None
    for r in range(rounds + 1):
        long = FA.sensitive_long(current, sensitive, label, pred_col)
        rep = cut_lineage(FA.bias_report(FA.bias_metrics(long), list(sensitive)).withColumn("round", F.lit(r)))
        reports = rep if reports is None else reports.unionByName(rep)
        flagged = [row["feature"] for row in rep.where("significant").select("feature").collect()]   # sensitive features
        if not flagged or r == rounds:
            break
        better = False
        for f in flagged:
            if f not in found:   # the fit depends on the data, not on the predictions it replaces
                result = mitigate(df, features, label, sensitive[f], key, name=name, **kw)
                found[f] = cut_lineage(result.predictions.select(*key, F.col("calibrated").alias("_new")))
            tried = current.join(found[f], key)
            now, then = disparity_scores(tried, label, sensitive[f], [pred_col, "_new"])
            if then < now:
                current = cut_lineage(tried.drop(pred_col).withColumnRenamed("_new", pred_col))
                better = True
        if not better:
            break
    return reports, current.select(*kept)
