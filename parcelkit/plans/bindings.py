"""Bindings of the property roles to the driver tables (Spark side).

The driver tables hold no property data, so one projection, ``assess``,
gives every role a column; ``dirty`` adds injected defects (nulls, invalid
numbers, money text, outliers, free text) computed from the same rows, and
``feedback_raw`` / ``feedback`` map ``events`` onto the feedback table.
All of it is lazy: Catalyst prunes the columns a query does not use, so a
query over three roles only scans and joins what those roles need.

At scale the joins are sort-merge, or broadcast by AQE when the runtime size is
under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.sources.tables import read_table

# Row key of lineitem (the 2-column business key is not unique in the data).
ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]

# Fixed values of the binding: priority digit -> condition text.
PRIORITY_CONDITION = {"1": "1-POOR", "2": "2-FAIR", "3": "3-AVERAGE", "4": "4-GOOD", "5": "5-EXCELLENT"}


def assess(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """The role projection of the driver tables; ``by_order`` joins them as ``joined`` does, where nothing that is fitted
    depends on the order of the rows."""
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    p = read_table(spark, sf_dir, "part")
    c = read_table(spark, sf_dir, "customer")
    if by_order:
        return assess_from_joined(joined(li, o, p, c))
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(p, li.l_partkey == p.p_partkey)
           .join(c, o.o_custkey == c.c_custkey))
    return assess_from_joined(j)


def joined(li: DataFrame, o: DataFrame, p: DataFrame, c: DataFrame) -> DataFrame:
    """Line items (batch or streaming) with their part, order and customer: line items are shuffled twice, not three times,
    and lie by order key afterwards, so grouping by whole rows needs no further exchange."""
    ordered = o.join(c, o.o_custkey == c.c_custkey)
    return li.join(p, li.l_partkey == p.p_partkey).join(ordered, li.l_orderkey == o.o_orderkey)


def assess_from_joined(j: DataFrame) -> DataFrame:
    """The role projection over lineitem x orders x part x customer rows
    (batch or streaming line items)."""
    ln, q, ep = F.col("l_linenumber"), F.col("l_quantity"), F.col("l_extendedprice")
    digit = F.substring("o_orderpriority", 1, 1)
    cond = F.when(digit == "1", PRIORITY_CONDITION["1"])
    for d in ("2", "3", "4"):
        cond = cond.when(digit == d, PRIORITY_CONDITION[d])
    cond = cond.otherwise(PRIORITY_CONDITION["5"])
    return j.select(
        *ROW_KEY,
        ep.alias("TOTAL_VALUE"),
        (ep * F.col("l_discount") * 5).alias("LAND_VALUE"),
        (ep * (1 - F.col("l_discount") * 5)).alias("BLDG_VALUE"),
        (q * 100).alias("GROSS_AREA"),
        (q * 100 * (1 - F.col("l_tax") * 5)).alias("LIVING_AREA"),
        (F.col("p_size") * 200).cast("double").alias("LAND_SF"),
        (F.year("o_orderdate") - F.col("p_size")).cast("bigint").alias("YR_BUILT"),
        F.when(ln % 2 == 0, F.year("l_shipdate").cast("bigint")).alias("YR_REMODEL"),
        (ln % 4).cast("bigint").alias("FULL_BTH"),
        (ln % 2).cast("bigint").alias("HLF_BTH"),
        (F.floor(q).cast("bigint") % 12).alias("TT_RMS"),
        (ln % 5).cast("bigint").alias("BED_RMS"),
        cond.alias("OVERALL_COND"),
        F.col("p_type").alias("BLDG_TYPE"),
        F.col("p_brand").alias("STYLE"),
        F.lpad((F.col("c_nationkey") + 2100).cast("string"), 5, "0").alias("ZIP_CODE"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("bigint").alias("OWN_OCC"),
        (q * 2000 + F.col("p_retailprice")).alias("prediction"),
        "p_size", "p_name", "p_type", "p_retailprice", "c_nationkey", "c_mktsegment",
        "o_orderstatus", "o_orderpriority", "o_orderdate", "l_shipdate",
        "l_quantity", "l_discount", "l_tax",
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``assess`` plus injected defects (same expressions as the oracle)."""
    a = assess(spark, sf_dir, by_order=True)
    ln, ps, ep, q = F.col("l_linenumber"), F.col("p_size"), F.col("l_extendedprice"), F.col("l_quantity")
    v = F.floor(ep).cast("bigint")
    money = (F.when(ln % 3 == 0, F.concat(F.lit("$"), v.cast("string")))
             .when(ln % 3 == 1, F.concat(F.floor(v / 1000).cast("bigint").cast("string"), F.lit(","),
                                         F.lpad((v % 1000).cast("string"), 3, "0")))
             .otherwise(F.lit("invalid")))
    side = (F.when(ln % 4 == 0, "N").when(ln % 4 == 1, "s").when(ln % 4 == 2, "E").otherwise("w"))
    kind = F.when(ps % 3 == 0, "St").when(ps % 3 == 1, "Ave").otherwise("Rd")
    address = F.concat(F.lit(" "), F.col("l_suppkey").cast("string"), F.lit(" "), side, F.lit("  "),
                       F.col("p_name"), F.lit(" "), kind, F.lit(" Apt "), ps.cast("string"))
    cond_text = (F.when(ln == 1, "excellent").when(ln == 2, "Very Good").when(ln == 3, " good ")
                 .when(ln == 4, "fair condition").when(ln == 5, "POOR").when(ln == 6, "avg"))
    style_text = (F.when(ps % 7 == 0, "colonial").when(ps % 7 == 1, " Ranch ").when(ps % 7 == 2, "cape")
                  .when(ps % 7 == 3, "Cape Cod").when(ps % 7 == 4, "split level")
                  .when(ps % 7 == 5, "contemporary").otherwise("Victorian"))
    overall_raw = (F.when(ln == 7, F.lit(None).cast("string")).when(ps % 11 == 0, "AVG")
                   .when(ps % 13 == 0, "3-").when(ps % 19 == 0, "VG - VERY GOOD")
                   .otherwise(F.col("OVERALL_COND")))
    return a.select(
        "*",
        F.when(ln != 7, F.col("LIVING_AREA")).alias("LIVING_AREA_N"),
        F.when(ps % 10 != 0, F.col("BLDG_TYPE")).alias("BLDG_TYPE_N"),
        F.when(ln != 3, F.col("o_orderstatus") == "F").alias("OWN_OCC_FLAG"),
        F.when(ps % 25 == 0, -q * 100).otherwise(q * 100).alias("GROSS_AREA_RAW"),
        F.when(ps % 23 == 0, -ep).otherwise(ep).alias("TOTAL_VALUE_RAW"),
        F.when(ps % 17 == 0, F.lit(0).cast("bigint")).otherwise(F.col("YR_BUILT")).alias("YR_BUILT_RAW"),
        F.when(ps % 13 == 0, F.col("GROSS_AREA") * 1.2).otherwise(F.col("LIVING_AREA")).alias("LIVING_AREA_RAW"),
        money.alias("MONEY_TEXT"),
        F.when(F.col("l_orderkey") % 500 == 0, ep * 50).otherwise(ep).alias("TOTAL_VALUE_OUT"),
        address.alias("ADDRESS"),
        cond_text.alias("CONDITION_TEXT"),
        style_text.alias("STYLE_TEXT"),
        overall_raw.alias("OVERALL_COND_RAW"),
        (ln.cast("double") - 1 + F.col("l_tax") * 10).alias("INT_COND_NUM"),
        (F.col("YR_BUILT") + F.col("l_discount") * 10).alias("YR_FRAC"),
    )


def feedback_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` mapped onto feedback records (before any validation)."""
    e = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    predicted = F.round((k * 2.45 + 1) * 4000, 2)
    actual = F.round(F.col("value") * 10000, 2)
    return e.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("created_at"),
        predicted.alias("predicted_price"),
        actual.alias("actual_price"),
        (k % 12).alias("confidence"),
        F.col("event_type").alias("notes"),
        F.col("props").alias("property_data"),
        F.col("user_id").cast("string").alias("user_id"),
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored feedback table: records that pass the table constraints
    and the submit checks, with the stored 4-decimal deviation."""
    from parcelkit.operators.feedback import validate_feedback
    v = validate_feedback(feedback_raw(spark, sf_dir))
    return v.where(F.col("accepted")).drop("accepted", "reasons", "needs_confirmation")


def with_indicators(a: DataFrame) -> DataFrame:
    """Indicator (one-hot) columns of the model feature list, derived from
    ``assess`` rows (a subset of the 31, to exercise 'available only')."""
    ln, ps = F.col("l_linenumber"), F.col("p_size")
    digit = F.substring("o_orderpriority", 1, 1)

    def flag(cond):
        return F.coalesce(cond, F.lit(False)).cast("bigint")

    cols = {
        "OVERALL_COND_P - POOR": flag(digit == "1"),
        "OVERALL_COND_F - FAIR": flag(digit == "2"),
        "OVERALL_COND_A - AVERAGE": flag(digit == "3"),
        "OVERALL_COND_G - GOOD": flag(digit == "4"),
        "OVERALL_COND_E - EXCELLENT": flag(digit == "5"),
        "OVERALL_COND_VG - VERY GOOD": flag(ps % 9 == 0),
        "INT_COND_E - EXCELLENT": flag(ln % 5 == 0),
        "INT_COND_G - GOOD": flag(ln % 5 == 1),
        "INT_COND_A - AVERAGE": flag(ln % 5 == 2),
        "INT_COND_F - FAIR": flag(ln % 5 == 3),
        "INT_COND_P - POOR": flag(ln % 5 == 4),
        "EXT_COND_E - EXCELLENT": flag(ps % 3 == 0),
        "EXT_COND_G - GOOD": flag(ps % 3 == 1),
        "STRUCTURE_CLASS_C - BRICK/CONCR": flag(F.col("p_type").isin("ECONOMY", "SMALL")),
        "STRUCTURE_CLASS_D - WOOD/FRAME": flag(F.col("p_type").isin("MEDIUM", "STANDARD")),
        "STRUCTURE_CLASS_B - REINF CONCR": flag(F.col("p_type") == "LARGE"),
        "KITCHEN_STYLE2_M - MODERN": flag(F.col("c_mktsegment") == "HOUSEHOLD"),
        "KITCHEN_STYLE2_L - LUXURY": flag(F.col("c_mktsegment") == "MACHINERY"),
        "KITCHEN_STYLE2_S - SEMI-MODERN": flag(F.col("c_mktsegment") == "FURNITURE"),
        "AC_TYPE_C - CENTRAL AC": flag(F.col("o_orderstatus") == "F"),
        "AC_TYPE_D - DUCTLESS AC": flag(F.col("o_orderstatus") == "O"),
        "CORNER_UNIT_Y - YES": flag(ln == 1),
    }
    return a.withColumns(cols)


def valuation_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw form records (text fields, drop-downs, check boxes) from rows."""
    a = assess(spark, sf_dir)
    ln, ps = F.col("l_linenumber"), F.col("p_size")
    digit = F.substring("o_orderpriority", 1, 1)

    def s(c):
        return F.col(c).cast("string")

    overall = (F.when(ps % 9 == 0, "Very Good").when(digit == "1", "Poor").when(digit == "2", "Fair")
               .when(digit == "3", "Average").when(digit == "4", "Good").otherwise("Excellent"))
    return a.select(
        *ROW_KEY,
        F.when(ln == 5, F.lit("n/a")).otherwise(s("GROSS_AREA")).alias("GROSS_AREA"),
        s("LIVING_AREA").alias("LIVING_AREA"),
        s("LAND_SF").alias("LAND_SF"),
        s("YR_BUILT").alias("YR_BUILT"),
        F.coalesce(s("YR_REMODEL"), F.lit("")).alias("YR_REMODEL"),
        s("BED_RMS").alias("BED_RMS"),
        F.when(ps % 5 == 0, F.concat(s("FULL_BTH"), F.lit(".7"))).otherwise(s("FULL_BTH")).alias("FULL_BTH"),
        s("HLF_BTH").alias("HLF_BTH"),
        (ln % 3).cast("string").alias("NUM_PARKING"),
        F.lit("").alias("FIREPLACES"),
        F.lit("1").alias("KITCHENS"),
        s("TT_RMS").alias("TT_RMS"),
        F.when(F.col("c_nationkey") % 7 == 0, F.lit("")).otherwise(F.col("ZIP_CODE")).alias("ZIP_CODE"),
        F.when(F.col("p_type") == "ECONOMY", "Brick/Concrete").when(F.col("p_type") == "MEDIUM", "Wood/Frame")
         .when(F.col("p_type") == "LARGE", "Reinforced Concrete").otherwise("").alias("structureClass"),
        F.when(ln % 6 == 0, "Excellent").when(ln % 6 == 1, "Good").when(ln % 6 == 2, "Average")
         .when(ln % 6 == 3, "Fair").when(ln % 6 == 4, "Poor").otherwise("").alias("intCondition"),
        overall.alias("overallCondition"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Modern").when(F.col("c_mktsegment") == "MACHINERY", "Luxury")
         .when(F.col("c_mktsegment") == "FURNITURE", "Semi-Modern").otherwise("").alias("kitchenStyle"),
        (ln % 2 == 0).alias("kitchenTypeFullEatIn"),
        F.when(F.col("o_orderstatus") == "F", "Central AC").when(F.col("o_orderstatus") == "O", "Ductless AC")
         .otherwise("None").alias("acType"),
        F.when(ps % 3 == 0, "Forced Hot Air").when(ps % 3 == 1, "Hot Water/Steam").otherwise("None").alias("heatType"),
        F.when(ps % 4 == 0, "Excellent").when(ps % 4 == 1, "Good").otherwise("Average/Other").alias("propView"),
        (ln == 1).alias("cornerUnit"),
        F.when(ln % 3 == 0, "End").when(ln % 3 == 1, "Front/Street").otherwise("None").alias("orientation"),
        F.when(ps % 5 == 0, "Excellent").when(ps % 5 == 1, "Good").otherwise("Average/Other").alias("extCondition"),
        F.when(ln % 4 == 0, "Slate").when(ln % 4 == 1, "Asphalt Shingle").otherwise("None").alias("roofCover"),
    )
