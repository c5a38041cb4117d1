"""Cleaning operators (reference assertions re-expressed + exact values)."""
from pyspark.sql import functions as F

from parcelkit.operators import clean as C
from parcelkit.operators.roles import column_roles


def test_address_abbreviations(spark):
    df = spark.createDataFrame([("123 Main St",), ("456 Oak Apt 2B  Rd",), ("789 E  Pine Ave",)], "ADDRESS string")
    out = [r[0] for r in C.clean_address(df, ["ADDRESS"]).collect()]
    assert out == ["123 MAIN STREET", "456 OAK APARTMENT 2B ROAD", "789 EAST PINE AVENUE"]


def test_categorical_standardise(spark):
    df = spark.createDataFrame([("excellent", "Split Level"), ("GOOD", "cape"), ("Very good", "Colonial"),
                                (None, "ranch")], "condition string, style string")
    rows = C.standardize_categorical(df, ["condition", "style"]).collect()
    assert [tuple(r) for r in rows] == [("EXCELLENT", "SPLIT LEVEL"), ("GOOD", "CAPE COD"),
                                        ("VERY GOOD", "COLONIAL"), (None, "RANCH")]


def test_outlier_max_clipped(spark):
    df = spark.createDataFrame([(100000, 1000), (200000, 1500), (300000, 2000), (50000000, 2500)],
                               "price bigint, area bigint")
    df = df.select(F.col("price").cast("double"), F.col("area").cast("double"))
    out = C.clip_outliers(df, ["price", "area"])
    assert out.agg(F.max("price")).first()[0] < 50000000
    # price: upper bound only = Q3 + 1.5 IQR (pandas linear quartiles)
    import numpy as np
    p = np.array([100000, 200000, 300000, 50000000.0])
    q1, q3 = np.quantile(p, [0.25, 0.75])
    assert out.agg(F.max("price")).first()[0] == q3 + 1.5 * (q3 - q1)
    assert out.agg(F.min("price")).first()[0] == 100000


def test_clip_idempotent(spark):
    df = spark.range(1000).select((F.col("id") * F.col("id")).cast("double").alias("value"))
    m = C.fit_outliers(df, ["value"])
    once = m.apply(df)
    twice = m.apply(once)
    assert once.exceptAll(twice).count() == 0


def test_remove_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c")], "A bigint, B string")
    assert C.dedup_rows(df).count() == 3


def test_remove_duplicates_subset_keeps_first(spark):
    df = spark.createDataFrame([(1, "x", 0), (1, "y", 1), (2, "z", 2), (2, "w", 3)], "id bigint, value string, pos int")
    out = {r["id"]: r["value"] for r in C.dedup_keep_first(df, ["id"], ["pos"]).collect()}
    assert out == {1: "x", 2: "z"}


def test_clean_numeric_money_and_rules(spark):
    df = spark.createDataFrame([("$100,000", "1,500", "-500", "4.5", "6", "02118"),
                                ("invalid", "0", "2000", "2.5", "0.2", "02119"),
                                ("$1,234.50", "800", "10", "3.5", "3", None)],
                               "SALE_PRICE string, GROSS_AREA string, LAND_VALUE string, BED_RMS string, "
                               "INT_COND string, ZIP_CODE string")
    out = C.clean_numeric(df, ["SALE_PRICE", "GROSS_AREA", "LAND_VALUE", "BED_RMS", "INT_COND", "ZIP_CODE"]).collect()
    assert [r["SALE_PRICE"] for r in out] == [100000.0, None, 1234.5]
    assert [r["GROSS_AREA"] for r in out] == [1500.0, None, 800.0]          # area <= 0 -> null
    assert [r["LAND_VALUE"] for r in out] == [None, 2000.0, 10.0]           # price < 0 -> null
    assert [r["BED_RMS"] for r in out] == [4, 2, 4]                          # half-even rounding
    assert [r["INT_COND"] for r in out] == [5, 1, 3]                         # clipped to [1, 5]
    assert [r["ZIP_CODE"] for r in out] == ["02118", "02119", None]         # stays text


def test_impute_values(spark):
    df = spark.createDataFrame([(1.0, 1990, "A", True), (None, 1990, "B", None), (3.0, None, None, False),
                                (4.0, 2000, "A", None), (None, 2000, "B", True)],
                               "numeric double, yr_built bigint, categorical string, flag boolean")
    roles = column_roles(df)
    model = C.fit_impute(df, roles)
    assert model.values["numeric"] == 3.0          # median of 1, 3, 4
    assert model.values["yr_built"] == 1990        # mode tie -> smallest
    assert model.values["categorical"] == "A"      # mode tie -> smallest
    assert model.values["flag"] is False
    out = model.apply(df)
    assert out.where(F.col("numeric").isNull() | F.col("categorical").isNull() | F.col("flag").isNull()).count() == 0


def test_dedup_partition_invariance(spark):
    rows = [(i % 7, f"v{i % 3}") for i in range(500)]
    base = spark.createDataFrame(rows, "k bigint, v string")
    expected = sorted(tuple(r) for r in C.dedup_rows(base).collect())
    for n in (1, 4, 32):
        got = sorted(tuple(r) for r in C.dedup_rows(base.repartition(n)).collect())
        assert got == expected


def test_sketch_options_close_to_exact(spark):
    df = spark.range(2001).select((F.col("id") * 3.0).alias("area"))
    roles = {"numerical": ["area"]}
    exact = C.fit_impute(df, roles).values["area"]
    approx = C.fit_impute(df, roles, exact=False).values["area"]
    assert exact == 3000.0 and abs(approx - exact) <= 6.0
    b_exact = C.fit_outliers(df, ["area"]).bounds["area"]
    b_approx = C.fit_outliers(df, ["area"], exact=False).bounds["area"]
    assert all(abs(x - y) <= 30.0 for x, y in zip(b_exact, b_approx))
