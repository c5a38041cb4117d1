"""Numbers of features, without text between them and without exceptions for empty text."""
import math
import re

from pyspark.sql import functions as F

from parcelkit.functions import text as T
from parcelkit.functions.numeric import finite_or_zero
from parcelkit.operators import features as FE


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_numbers_do_not_go_through_text(spark):
    df = spark.createDataFrame([(100.0, 10.0, 4, 2000, 2001.0, 2, 1), (float("nan"), None, None, 0, float("inf"), None, 1)],
                               "TOTAL_VALUE double, GROSS_AREA double, LAND_VALUE int, YR_BUILT long, YR_REMODEL double, FULL_BTH int, HLF_BTH int")
    out = FE.property_features(FE.ratio_features(df))
    assert "as string" not in _plan(out.select("price_per_sqft", "land_value_ratio", "property_age", "total_bathrooms", "has_renovation"))
    by_text = FE.property_features(FE.ratio_features(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])))
    new = ["price_per_sqft", "land_value_ratio", "building_value_ratio", "property_age", "total_bathrooms", "has_renovation", "years_since_renovation"]
    assert [str(r) for r in out.select(*new).collect()] == [str(r) for r in by_text.select(*new).collect()]


def test_empty_prefixes_are_not_cast(spark):
    texts = ["", None, "n/a", "-0", " -12.5abc", "1e3x", ".5", "+7", "007", "99999999999999999999", "1e999"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select(FE.parse_float_prefix(F.col("t")).alias("f"), FE.parse_int_prefix(F.col("t")).alias("i"),
                    T.zip_to_number(F.col("t")).alias("z"))
    casts = re.findall(r"try_cast\((\w+)\(", _plan(out).lower())
    assert "regexp_extract" not in casts and "regexp_replace" not in casts   # an empty match is null before its cast
    rows = out.collect()
    assert [r.f for r in rows] == [0.0, 0.0, 0.0, 0.0, -12.5, 1000.0, 0.5, 7.0, 7.0, 1e20, math.inf]
    assert math.copysign(1.0, rows[3].f) == 1.0
    assert [r.i for r in rows] == [0, 0, 0, 0, -12, 1, 0, 7, 7, 0, 1]
    assert [r.z for r in rows][:3] == [None, None, None] and rows[8].z == 7.0


def test_finite_or_zero_of_odd_numbers(spark):
    df = spark.createDataFrame([(v,) for v in (1.5, -2.0, None, float("nan"), float("inf"), float("-inf"))], "v double")
    assert [r[0] for r in df.select(finite_or_zero("v")).collect()] == [1.5, -2.0, 0.0, 0.0, 0.0, 0.0]
