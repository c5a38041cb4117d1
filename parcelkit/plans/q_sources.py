"""Registered queries: sources / sinks round trips
and data validation (N1-N4)."""

from __future__ import annotations


from pyspark.sql import functions as F

from parcelkit.operators import validation as V
from parcelkit.operators.quality import DEFAULT_BOUNDS, alert_payload, quality_suite
from parcelkit.plans import bindings as b
from parcelkit.plans.oracle import with_ctes
from parcelkit.plans.registry import register, rounded
from parcelkit.session import cut_lineage, scratch_path
from parcelkit.sources import files as S
from parcelkit.sources.tables import read_table

KEY = b.ROW_KEY
#: Rows that one task sorts for a table aligned by position.
ROWS_PER_SORT = 1_000_000
KEY_SQL = ", ".join(KEY)
FIT_FILTER_SQL = "l_linenumber <= 5 AND p_type <> 'PROMO'"


@register("csv_scan", with_ctes(f"""
SELECT {KEY_SQL}, TRY_CAST(replace(MONEY_TEXT, ',', '') AS DOUBLE) AS TOTAL_VALUE,
  GROSS_AREA_RAW AS GROSS_AREA, ADDRESS
FROM dirty""", "dirty"))
def q_csv_scan(spark, sf):
    """Write rows as CSV text (money text, padded header names, quoted
    address), then read them back with the tolerant scan + converters."""
    d = b.dirty(spark, sf).select(*[F.col(c).cast("string").alias(f" {c} ") for c in KEY],
                                  F.col("MONEY_TEXT").alias(" TOTAL_VALUE"),
                                  F.col("GROSS_AREA_RAW").cast("string").alias("GROSS_AREA "),
                                  F.col("ADDRESS").alias("ADDRESS"))
    path = scratch_path(spark, "assessments-csv")
    d.write.option("header", True).option("escape", "\\").option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    r = S.read_assessments_csv(spark, path, ["TOTAL_VALUE", "GROSS_AREA"])
    return rounded(r.select(*[F.col(c).cast(t).alias(c) for c, t in zip(
        KEY, ["bigint", "int", "bigint", "bigint", "double"])], "TOTAL_VALUE", "GROSS_AREA", "ADDRESS"))


@register("json_records", with_ctes(f"""
SELECT {KEY_SQL}, CAST(GROSS_AREA AS DOUBLE) AS GROSS_AREA, CAST(YR_REMODEL AS DOUBLE) AS YR_REMODEL, ZIP_CODE
FROM assess""", "assess"))
def q_json_records(spark, sf):
    """Scoring requests as JSON lines under a fixed schema; absent fields
    (YR_REMODEL is omitted when null) read back as null."""
    a = b.assess(spark, sf).select(*KEY, "GROSS_AREA", "YR_REMODEL", "ZIP_CODE")
    path = scratch_path(spark, "requests-json")
    a.write.json(path)   # to_json drops null fields
    schema = ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, "
              "GROSS_AREA double, YR_REMODEL double, ZIP_CODE string")
    from pyspark.sql.types import _parse_datatype_string
    return rounded(S.read_records_json(spark, path, _parse_datatype_string(schema)))


@register("pack_property", with_ctes(f"""
SELECT {KEY_SQL}, round(GROSS_AREA, 4) AS GROSS_AREA, YR_BUILT, BLDG_TYPE FROM assess""", "assess"))
def q_pack_property(spark, sf):
    """Property record -> JSON document -> parsed back."""
    a = b.assess(spark, sf).select(*KEY, "GROSS_AREA", "YR_BUILT", "BLDG_TYPE")
    packed = S.pack_property(a, ["GROSS_AREA", "YR_BUILT", "BLDG_TYPE"]).select(*KEY, "property_data")
    out = S.unpack_property(packed, "GROSS_AREA double, YR_BUILT bigint, BLDG_TYPE string")
    return rounded(out.drop("property_data"))


def _bounds_sql_assess():
    from parcelkit.plans.q_clean import _bounds_sql
    return _bounds_sql("assess")


@register("rules_bounds_check", with_ctes(_bounds_sql_assess(), "assess"))
def q_rules_bounds_check(spark, sf):
    """Rules written as a multi-line JSON config, loaded back (bounds map ->
    rules), then the configured bounds checked over the table (A8, J3, D2)."""
    from parcelkit.operators.quality import Rules, bounds_issues
    path = scratch_path(spark, "rules-config")
    S.write_rules(spark, Rules(), path)
    rules = S.load_rules(spark, path)
    return bounds_issues(b.assess(spark, sf), rules)


_SCHEMA_COLS = ["BLDG_TYPE", "STYLE_TEXT", "ZIP_CODE", "TOTAL_VALUE", "YR_REMODEL"]


@register("schema_anomalies", with_ctes(f"""
SELECT 'LIVING_AREA_N' AS "column", 'unexpected_column' AS anomaly, '' AS detail
UNION ALL SELECT 'YR_REMODEL', 'missing_column', ''
UNION ALL SELECT 'TOTAL_VALUE', 'type_mismatch', 'expected double, got string'
UNION ALL SELECT "column", 'out_of_domain', CAST(n AS VARCHAR) FROM (
  SELECT 'BLDG_TYPE' AS "column", count(*) AS n FROM dirty
  WHERE BLDG_TYPE NOT IN (SELECT DISTINCT BLDG_TYPE FROM dirty WHERE {FIT_FILTER_SQL})
  UNION ALL SELECT 'STYLE_TEXT', count(*) FROM dirty
  WHERE STYLE_TEXT NOT IN (SELECT DISTINCT STYLE_TEXT FROM dirty WHERE {FIT_FILTER_SQL})) WHERE n > 0""", "dirty"))
def q_schema_anomalies(spark, sf):
    d = b.dirty(spark, sf)
    ref = d.where((F.col("l_linenumber") <= 5) & (F.col("p_type") != "PROMO")).select(*_SCHEMA_COLS)
    schema = V.infer_schema(ref, max_domain=20)
    new = d.select("BLDG_TYPE", "STYLE_TEXT", "ZIP_CODE", F.col("TOTAL_VALUE").cast("string").alias("TOTAL_VALUE"),
                   "LIVING_AREA_N")
    return V.validate_against(new, schema)


@register("inferred_schema", with_ctes(f"""
SELECT 'BLDG_TYPE' AS "column", 'string' AS type, true AS required,
  (SELECT list(DISTINCT BLDG_TYPE ORDER BY BLDG_TYPE) FROM dirty WHERE {FIT_FILTER_SQL}) AS domain
UNION ALL SELECT 'STYLE_TEXT', 'string', true,
  (SELECT list(DISTINCT STYLE_TEXT ORDER BY STYLE_TEXT) FROM dirty WHERE {FIT_FILTER_SQL})
UNION ALL SELECT 'ZIP_CODE', 'string', true, NULL
UNION ALL SELECT 'TOTAL_VALUE', 'double', true, NULL
UNION ALL SELECT 'YR_REMODEL', 'bigint', false, NULL""", "dirty"))
def q_inferred_schema(spark, sf):
    d = b.dirty(spark, sf)
    ref = d.where((F.col("l_linenumber") <= 5) & (F.col("p_type") != "PROMO")).select(*_SCHEMA_COLS)
    return V.infer_schema(ref, max_domain=20)


@register("top_values", with_ctes("""
SELECT "column", value, count, rank FROM (
  SELECT "column", value, count, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value) AS rank FROM (
    SELECT 'BLDG_TYPE' AS "column", BLDG_TYPE AS value, count(*) AS count FROM assess GROUP BY 2
    UNION ALL SELECT 'STYLE', STYLE, count(*) FROM assess GROUP BY 2
    UNION ALL SELECT 'ZIP_CODE', ZIP_CODE, count(*) FROM assess GROUP BY 2))
WHERE rank <= 5""", "assess"))
def q_top_values(spark, sf):
    a = b.assess(spark, sf)
    return V.top_values(a, ["BLDG_TYPE", "STYLE", "ZIP_CODE"], 5).withColumn("rank", F.col("rank").cast("bigint"))


_ALERT_MISSING = ["TOTAL_VALUE", "GROSS_AREA", "LIVING_AREA_N", "BLDG_TYPE_N", "YR_REMODEL"]
_ALERT_BOUNDS = {c: DEFAULT_BOUNDS[c] for c in ("TOTAL_VALUE", "GROSS_AREA")}
_ALERT_SQL = " UNION ALL ".join(
    [f"""SELECT 'High missing values in {c}: ' || format('{{:.2f}}', r * 100) || '%' AS message
FROM (SELECT avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS r FROM dirty) WHERE r > 0.1""" for c in _ALERT_MISSING]
    + [f"SELECT 'Found ' || n || ' outliers in {c}' FROM (SELECT count_if({c} < {lo} OR {c} > {hi}) AS n FROM dirty) WHERE n > 0"
       for c, (lo, hi) in _ALERT_BOUNDS.items()])


@register("quality_alert", with_ctes(f"""
SELECT 'Data Quality Alert' AS subject, 'Data quality issues found:' || chr(10) || string_agg(message, chr(10) ORDER BY message) AS body
FROM ({_ALERT_SQL}) HAVING count(*) > 0""", "dirty"))
def q_quality_alert(spark, sf):
    d = b.dirty(spark, sf).select(*_ALERT_MISSING)
    return alert_payload(quality_suite(d))


@register("align_by_position", with_ctes(f"""
SELECT {KEY_SQL}, GROSS_AREA, TOTAL_VALUE, true AS same_place FROM assess""", "assess"))
def q_align_by_position(spark, sf):
    """Features and target in two tables of other file sizes without a common key, put side by side by position.
    ``same_place``: the price that each table carries along agrees."""
    from parcelkit.sources.positions import align_by_position
    a = cut_lineage(b.assess(spark, sf, by_order=True).select(*KEY, "GROSS_AREA", "TOTAL_VALUE"))   # joined once, sorted twice
    x, y = scratch_path(spark, "x"), scratch_path(spark, "y")
    order = [F.col(c) for c in KEY]
    rows = read_table(spark, sf, "lineitem").count()   # from the footer
    five, three = (n * max(1, -(-rows // (n * ROWS_PER_SORT))) for n in (5, 3))   # files of other sizes, bounded sorts
    a.select(*KEY, "GROSS_AREA").repartitionByRange(five, *order).sortWithinPartitions(*order).write.parquet(x)
    target = a.repartitionByRange(three, *order).sortWithinPartitions(*order)
    target.select("TOTAL_VALUE", F.col("l_extendedprice").alias("price")).write.parquet(y)
    both = align_by_position(spark, x, y)
    return rounded(both.withColumn("same_place", F.col("price") == F.col("l_extendedprice")).drop("price"))


@register("variant_payload", with_ctes(f"""
SELECT {KEY_SQL}, CASE WHEN l_linenumber % 5 < 3 THEN round(GROSS_AREA, 4) END AS GROSS_AREA,
  CASE l_linenumber % 5 WHEN 0 THEN 'number' WHEN 1 THEN 'text' WHEN 2 THEN 'object' WHEN 3 THEN 'null' ELSE 'absent' END AS kind,
  CASE WHEN l_linenumber % 5 < 4 THEN YR_BUILT END AS YR_BUILT
FROM assess""", "assess"))
def q_variant_payload(spark, sf):
    """Payloads of five shapes (area as number, text, object or null, and no JSON) read as VARIANT."""
    a = b.assess(spark, sf)
    area, year = F.col("GROSS_AREA").cast("string"), F.col("YR_BUILT").cast("string")
    shapes = ['{"area": %s, "built": [%s]}', '{"area": "%s", "built": [%s]}', '{"area": {"value": %s}, "built": [%s]}',
              '{"area": null, "built": [%s]}']
    text = F.lit("area %s").cast("string")
    for i, shape in enumerate(shapes):
        args = [year] if i == 3 else [area, year]
        text = F.when(F.col("l_linenumber") % 5 == i, F.format_string(shape, *args)).otherwise(text)
    d = S.parse_payload(a.select(*KEY, text.alias("property_data")))
    return rounded(d.select(*KEY, S.payload_field("payload", ["$.area", "$.area.value"], "double").alias("GROSS_AREA"),
                            S.payload_kind("payload", "$.area").alias("kind"),
                            S.payload_field("payload", ["$.built[0]"], "bigint").alias("YR_BUILT")))


_STATISTICS = {"predicted_price": "predicted_price", "actual_price": "actual_price", "confidence": "confidence",
               "deviation": "deviation", "notes": "length(notes)"}


@register("merged_statistics", with_ctes(f"""
SELECT "column", count(v) AS n, count(*) - count(v) AS nulls, count_if(v = 0) AS zeros, round(min(v), 4) AS least,
  round(max(v), 4) AS greatest, true AS ranks_hold
FROM (SELECT unnest({list(_STATISTICS)}) AS "column", unnest([{", ".join(f"CAST({v} AS DOUBLE)" for v in _STATISTICS.values())}]) AS v
      FROM feedback)
GROUP BY 1""", "feedback"))
def q_merged_statistics(spark, sf):
    """Statistics kept per day, merged without reading the data again (N1).  ``ranks_hold``: every decile of the merged
    sketch has an exact rank within RANK_ERROR."""
    from parcelkit.operators import sketches as SK
    f = b.feedback(spark, sf).withColumn("day", F.to_date("created_at"))
    path = scratch_path(spark, "daily-statistics")
    S.append_table(SK.daily_statistics(f, ["day"], [c for c in _STATISTICS if c != "notes"], ["notes"]), path, batch_by=["day"])
    merged = SK.merge_statistics(spark.read.parquet(path))
    probs = [i / 10 for i in range(1, 10)]
    deciles = {r["column"]: r["quantiles"] for r in SK.sketch_quantiles(merged, probs).select("column", "quantiles").collect()}
    checks = []
    for c, values in deciles.items():
        x = F.length("notes").cast("double") if c == "notes" else F.col(c).cast("double")
        held = F.lit(True)
        for p, q in zip(probs, values or []):
            below, upto = (F.count_if(t) / F.count(x) for t in (x < q, x <= q))
            held = held & (below <= p + SK.RANK_ERROR) & (upto >= p - SK.RANK_ERROR)
        checks.append(held.alias(c))
    holds = f.agg(*checks).unpivot([], list(deciles), "column", "ranks_hold")
    return rounded(merged.drop("sketch", "total").join(holds, "column"))
