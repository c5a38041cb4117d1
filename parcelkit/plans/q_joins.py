"""Registered queries: joins (C1, C2 + D19, C4, C6, C8) and set ops."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelkit.operators import joins as J
from parcelkit.operators.metrics import r2_score
from parcelkit.operators.fairness import high_value_zips
from parcelkit.plans import bindings as b
from parcelkit.plans.oracle import with_ctes
from parcelkit.plans.registry import register, rounded

KEY = b.ROW_KEY
KEY_SQL = ", ".join(KEY)


@register("align_target", with_ctes(f"""
SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey, f.l_extendedprice,
  round(f.GROSS_AREA, 4) AS GROSS_AREA, round(f.LIVING_AREA, 4) AS LIVING_AREA, f.YR_BUILT, t.TOTAL_VALUE
FROM assess f JOIN assess t USING ({KEY_SQL})""", "assess"))
def q_align_target(spark, sf):
    a = b.assess(spark, sf)
    feats = a.select(*KEY, "GROSS_AREA", "LIVING_AREA", "YR_BUILT")
    target = a.select(*KEY, "TOTAL_VALUE")
    return rounded(J.align_target(feats, target, KEY))


_ZIP_SQL = """zm AS (SELECT ZIP_CODE, median(TOTAL_VALUE) AS m FROM assess GROUP BY 1 HAVING count(*) >= 5),
hz AS (SELECT ZIP_CODE FROM zm WHERE m > (SELECT median(m) FROM zm))"""


@register("high_value_zip_flag", with_ctes(f"""
SELECT {KEY_SQL}, a.ZIP_CODE, CAST(CASE WHEN hz.ZIP_CODE IS NULL THEN 0 ELSE 1 END AS BIGINT) AS HIGH_VALUE_ZIP
FROM assess a LEFT JOIN hz ON a.ZIP_CODE = hz.ZIP_CODE""", "assess", extra=[_ZIP_SQL]), bench=True)
def q_high_value_zip_flag(spark, sf):
    a = b.assess(spark, sf).select(*KEY, "ZIP_CODE", "TOTAL_VALUE")
    high = high_value_zips(a, "ZIP_CODE", "TOTAL_VALUE")
    return J.flag_members(a, high, "ZIP_CODE", "HIGH_VALUE_ZIP").drop("TOTAL_VALUE")


@register("zip_medians", with_ctes("""
SELECT ZIP_CODE, round(m, 4) AS median_value, n, m > (SELECT median(m) FROM zm2) AS high_value
FROM (SELECT ZIP_CODE, median(TOTAL_VALUE) AS m, count(*) AS n FROM assess GROUP BY 1 HAVING count(*) >= 5)""",
                                     "assess", extra=["""zm2 AS (SELECT median(TOTAL_VALUE) AS m FROM assess
                                     GROUP BY ZIP_CODE HAVING count(*) >= 5)"""]))
def q_zip_medians(spark, sf):
    from parcelkit.operators.fairness import zip_value_groups
    a = b.assess(spark, sf)
    return rounded(zip_value_groups(a, "ZIP_CODE", "TOTAL_VALUE").select(
        "ZIP_CODE", "median_value", "n", "high_value"))


_ZIP_DIM_SQL = """zip_dim AS (
  SELECT DISTINCT lpad(CAST(c_nationkey + 2100 AS VARCHAR), 5, '0') AS ZIP_CODE,
    CAST(42.0 AS DOUBLE) + c_nationkey * CAST(0.01 AS DOUBLE) AS latitude,
    CAST(-71.0 AS DOUBLE) - c_nationkey * CAST(0.01 AS DOUBLE) AS longitude
  FROM customer WHERE c_nationkey < 20)"""


def zip_dim(spark, sf):
    from parcelkit.sources.tables import read_table
    c = read_table(spark, sf, "customer").where(F.col("c_nationkey") < 20)
    return c.select(F.lpad((F.col("c_nationkey") + 2100).cast("string"), 5, "0").alias("ZIP_CODE"),
                    (F.lit(42.0) + F.col("c_nationkey") * 0.01).alias("latitude"),
                    (F.lit(-71.0) - F.col("c_nationkey") * 0.01).alias("longitude")).distinct()


@register("geo_lookup", with_ctes(f"""
SELECT {KEY_SQL}, a.ZIP_CODE, round(coalesce(z.latitude, 42.3601), 4) AS latitude,
  round(coalesce(z.longitude, -71.0589), 4) AS longitude
FROM assess a LEFT JOIN zip_dim z ON a.ZIP_CODE = z.ZIP_CODE""", "assess", extra=[_ZIP_DIM_SQL]))
def q_geo_lookup(spark, sf):
    a = b.assess(spark, sf).select(*KEY, "ZIP_CODE")
    return rounded(J.geo_lookup(a, zip_dim(spark, sf)))


_CURRENT_PRED = "l_quantity * 1800 + p_retailprice * 1.5"


def _r2_sql(pred):
    return (f"1 - sum((TOTAL_VALUE - ({pred})) * (TOTAL_VALUE - ({pred}))) / "
            f"(var_pop(TOTAL_VALUE) * count(*))")


@register("champion_challenger", with_ctes(f"""
SELECT n.ZIP_CODE, round(n.r2, 4) AS new_r2, round(c.r2, 4) AS current_r2,
  coalesce(n.r2 >= c.r2, c.r2 IS NULL) AS promote
FROM (SELECT ZIP_CODE, {_r2_sql('prediction')} AS r2 FROM assess GROUP BY 1) n
LEFT JOIN (SELECT ZIP_CODE, {_r2_sql('l_quantity * 1800 + p_retailprice * CAST(1.5 AS DOUBLE)')} AS r2
           FROM assess WHERE c_nationkey < 20 GROUP BY 1) c ON n.ZIP_CODE = c.ZIP_CODE""", "assess"))
def q_champion_challenger(spark, sf):
    a = b.assess(spark, sf)
    new = a.groupBy("ZIP_CODE").agg(r2_score("TOTAL_VALUE", F.col("prediction")).alias("r2"))
    cur_pred = F.col("l_quantity") * 1800 + F.col("p_retailprice") * 1.5
    cur = (a.where(F.col("c_nationkey") < 20).groupBy("ZIP_CODE")
             .agg(r2_score("TOTAL_VALUE", cur_pred).alias("r2")))
    return rounded(J.promote(new, cur, ["ZIP_CODE"], "r2"))


@register("compare_models", with_ctes(f"""
SELECT model, count(*) AS n, round(avg(r), 4) AS mean_residual, round(stddev_pop(r), 4) AS std_residual,
  round(sqrt(avg(r * r)), 4) AS rmse, round(avg(abs(r)), 4) AS mae, round(corr(TOTAL_VALUE, p), 4) AS corr
FROM (SELECT 'pred_a' AS model, TOTAL_VALUE, prediction AS p, TOTAL_VALUE - prediction AS r FROM assess
      UNION ALL
      SELECT 'pred_b', TOTAL_VALUE, {_CURRENT_PRED.replace('1.5', 'CAST(1.5 AS DOUBLE)')},
        TOTAL_VALUE - ({_CURRENT_PRED.replace('1.5', 'CAST(1.5 AS DOUBLE)')}) FROM assess)
GROUP BY 1""", "assess"))
def q_compare_models(spark, sf):
    a = b.assess(spark, sf)
    pa = a.select(*KEY, "TOTAL_VALUE", F.col("prediction").alias("pred_a"))
    pb = a.select(*KEY, (F.col("l_quantity") * 1800 + F.col("p_retailprice") * 1.5).alias("pred_b"))
    return rounded(J.compare_models(pa, pb, KEY, "TOTAL_VALUE"))


@register("membership_semi_anti", with_ctes(f"""
SELECT 'inside' AS side, count(*) AS n FROM assess WHERE ZIP_CODE IN (SELECT ZIP_CODE FROM zip_dim)
UNION ALL
SELECT 'outside', count(*) FROM assess WHERE ZIP_CODE NOT IN (SELECT ZIP_CODE FROM zip_dim)""", "assess",
                                              extra=[_ZIP_DIM_SQL]))
def q_membership(spark, sf):
    a = b.assess(spark, sf).select("ZIP_CODE")
    z = zip_dim(spark, sf)
    inside = J.membership(a, z, "ZIP_CODE", True).agg(F.count(F.lit(1)).alias("n"))
    outside = J.membership(a, z, "ZIP_CODE", False).agg(F.count(F.lit(1)).alias("n"))
    return inside.select(F.lit("inside").alias("side"), "n").unionByName(
        outside.select(F.lit("outside").alias("side"), "n"))
