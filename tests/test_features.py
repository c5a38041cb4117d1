"""Feature operators (condition cases, encoder reuse, ratios, ranges)."""
from pyspark.sql import functions as F

from parcelkit.functions import text as T
from parcelkit.operators import encode as E
from parcelkit.operators import features as FE


def test_condition_cases(spark):
    vals = ["1-POOR", "2-FAIR", "3-AVERAGE", "4-GOOD", "5-EXCELLENT", "AVG", None, "3-"]
    df = spark.createDataFrame([(v,) for v in vals], "OVERALL_COND string")
    out = [r[0] for r in df.select(T.standardize_condition(F.col("OVERALL_COND"))).collect()]
    assert out == ["Poor", "Fair", "Average", "Good", "Excellent", "Average", "Average", "Average"]


def test_quality_ordinal(spark):
    df = spark.createDataFrame([("poor",), ("Good",), ("unknown",), (None,), ("other",)], "c string")
    assert [r[0] for r in df.select(T.quality_ordinal(F.col("c"))).collect()] == [1, 4, 3, 3, 3]


def test_encoder_reuse_unseen(spark):
    fit = spark.createDataFrame([("Single", "A"), ("Multi", "B"), ("Single", "C"), ("Condo", "A")],
                                "property_type string, many_categories string")
    apply = spark.createDataFrame([("Single", "A"), ("Town", "D"), ("Multi", "B")],
                                  "property_type string, many_categories string")
    enc = E.fit_encoders(fit, ["property_type", "many_categories"], max_categories=2)
    assert enc["property_type"].kind == "label" and enc["many_categories"].kind == "label"
    enc = E.fit_encoders(fit, ["property_type", "many_categories"], max_categories=10)
    out = E.apply_encoders(apply, enc).collect()
    cols = out[0].asDict().keys()
    assert {"property_type_CONDO", "property_type_MULTI", "property_type_SINGLE", "property_type_UNKNOWN"} <= set(cols)
    assert [r["property_type_SINGLE"] for r in out] == [1.0, 0.0, 0.0]
    assert [r["property_type_UNKNOWN"] for r in out] == [0.0, 1.0, 0.0]


def test_label_unknown(spark):
    fit = spark.createDataFrame([(f"S{i:02d}",) for i in range(15)], "style string")
    enc = E.fit_encoders(fit, ["style"], max_categories=10)
    assert enc["style"].kind == "label"
    apply = spark.createDataFrame([("S00",), ("S14",), ("NEW",)], "style string")
    out = [r[0] for r in E.apply_encoders(apply, enc).collect()]
    # sorted vocabulary S00..S14 + UNKNOWN -> UNKNOWN is index 15
    assert out == [0, 14, 15]


def test_price_per_sqft_exact(spark):
    df = spark.createDataFrame([(500000, 2000, 200000, 300000), (750000, 2500, 300000, 450000),
                                (0, 1000, 1, 1), (100, None, None, 50)],
                               "TOTAL_VALUE bigint, GROSS_AREA bigint, LAND_VALUE bigint, BLDG_VALUE bigint")
    out = FE.ratio_features(df).collect()
    assert [r["price_per_sqft"] for r in out] == [250.0, 300.0, None, None]
    assert [r["land_value_ratio"] for r in out] == [0.4, 0.4, None, None]
    assert [r["building_value_ratio"] for r in out] == [0.6, 0.6, None, 0.5]


def test_property_features_ranges(spark):
    df = spark.createDataFrame([(1990, 2000, 2, 1, 2000, 1500, "3-AVERAGE"), (2000, 2000, 1, 0, 1500, 1200, "GOOD"),
                                (1950, 1950, 3, 2, 3000, 2500, None), (0, None, None, None, 1000, 1200, "9")],
                               "YR_BUILT bigint, YR_REMODEL bigint, FULL_BTH bigint, HLF_BTH bigint, GROSS_AREA bigint, "
                               "LIVING_AREA bigint, OVERALL_COND string")
    out = FE.property_features(df, 2025).collect()
    assert [r["property_age"] for r in out] == [35.0, 25.0, 75.0, None]
    assert [r["age_category"] for r in out] == ["30-50 years", "20-30 years", "50+ years", None]
    assert [r["total_bathrooms"] for r in out] == [2.5, 1.0, 4.0, 0.0]
    assert [r["total_bathrooms_int"] for r in out] == [2, 1, 4, 0]
    assert [r["has_renovation"] for r in out] == [True, False, False, False]
    assert [r["years_since_renovation"] for r in out] == [25.0, 25.0, 75.0, None]
    assert [r["living_area_ratio"] for r in out][:3] == [0.75, 0.8, 2500 / 3000]
    assert out[3]["living_area_ratio"] is None     # gross < living
    assert [r["OVERALL_COND"] for r in out] == ["Average", "Good", "Average", "Average"]


def test_age_bins_right_closed(spark):
    from parcelkit.functions.numeric import age_category
    df = spark.createDataFrame([(x,) for x in [0.0, 5.0, 5.5, 10.0, 20.0, 30.0, 50.0, 50.1]], "a double")
    assert [r[0] for r in df.select(age_category(F.col("a"))).collect()] == [
        "New", "New", "5-10 years", "5-10 years", "10-20 years", "20-30 years", "30-50 years", "50+ years"]


def test_model_features_scores(spark):
    df = spark.createDataFrame([(2000.0, 1500.0, 4000.0, 1990, None, 2, 1, 6, "02118", 1, 0, 0, 1),
                                (0.0, 0.0, 0.0, 2000, 2010, 1, 0, 3, "00000", 0, 1, 0, 0)],
                               "GROSS_AREA double, LIVING_AREA double, LAND_SF double, YR_BUILT bigint, YR_REMODEL bigint, "
                               "FULL_BTH bigint, HLF_BTH bigint, TT_RMS bigint, ZIP_CODE string, "
                               "`INT_COND_E - EXCELLENT` bigint, `INT_COND_P - POOR` bigint, "
                               "`OVERALL_COND_VG - VERY GOOD` bigint, `OVERALL_COND_F - FAIR` bigint")
    out = FE.model_features(df, 2025).collect()
    r0, r1 = out
    assert r0["property_age"] == 35.0 and r0["years_since_renovation"] == 35.0 and r0["has_renovation"] == 0.0
    assert r0["living_area_ratio"] == 0.75 and r0["floor_area_ratio"] == 0.5 and r0["rooms_per_area"] == 6 / 1500
    assert r0["ZIP_CODE"] == 2118.0 and r1["ZIP_CODE"] == 0.0
    assert r1["living_area_ratio"] == 0.0 and r1["has_renovation"] == 1.0 and r1["years_since_renovation"] == 15.0
    assert r0["interior_score"] == 5.0 and r1["interior_score"] == 3.0    # P never lowers below 3
    assert r0["overall_score"] == 3.0


def test_form_to_record(spark):
    cols = ["GROSS_AREA", "LIVING_AREA", "LAND_SF", "YR_BUILT", "YR_REMODEL", "BED_RMS", "FULL_BTH", "HLF_BTH",
            "NUM_PARKING", "FIREPLACES", "KITCHENS", "TT_RMS", "ZIP_CODE"]
    drop = ["structureClass", "intCondition", "overallCondition", "kitchenStyle", "acType", "heatType", "propView",
            "orientation", "extCondition", "roofCover"]
    row = ["1500.5sqft", "abc", "", "1990", "", "3", "2.7", "1", "", "", "1", "7", ""]
    row += ["Wood/Frame", "Excellent", "Very Good", "", "Central AC", "", "Good", "End", "", "Slate"]
    schema = ", ".join(f"{c} string" for c in cols + drop) + ", kitchenTypeFullEatIn boolean, cornerUnit boolean"
    df = spark.createDataFrame([tuple(row) + (True, False)], schema)
    r = FE.form_to_record(df).first().asDict()
    assert r["GROSS_AREA"] == 1500.5 and r["LIVING_AREA"] == 0.0 and r["LAND_SF"] == 0.0
    assert r["YR_BUILT"] == 1990 and r["YR_REMODEL"] == 1990 and r["FULL_BTH"] == 2
    assert r["ZIP_CODE"] == "00000"
    assert r["STRUCTURE_CLASS_D - WOOD/FRAME"] == 1 and r["OVERALL_COND_VG - VERY GOOD"] == 1
    assert r["KITCHEN_TYPE_F - FULL EAT IN"] == 1 and r["CORNER_UNIT_Y - YES"] == 0
    assert sum(v for k, v in r.items() if " - " in k) == 8
