"""DuckDB SQL of the bindings (independent restatement of ``bindings.py``).

The driver registers the raw tables as views; each oracle query prepends the
CTEs it needs.  Expressions are written to give bit-identical doubles to the
Spark side (same operation order, explicit casts, ``floor`` before BIGINT).
"""

from __future__ import annotations

ASSESS = """
assess AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    l_extendedprice AS TOTAL_VALUE,
    l_extendedprice * l_discount * 5 AS LAND_VALUE,
    l_extendedprice * (1 - l_discount * 5) AS BLDG_VALUE,
    l_quantity * 100 AS GROSS_AREA,
    l_quantity * 100 * (1 - l_tax * 5) AS LIVING_AREA,
    CAST(p_size * 200 AS DOUBLE) AS LAND_SF,
    CAST(year(o_orderdate) - p_size AS BIGINT) AS YR_BUILT,
    CASE WHEN l_linenumber % 2 = 0 THEN CAST(year(l_shipdate) AS BIGINT) END AS YR_REMODEL,
    CAST(l_linenumber % 4 AS BIGINT) AS FULL_BTH,
    CAST(l_linenumber % 2 AS BIGINT) AS HLF_BTH,
    CAST(floor(l_quantity) AS BIGINT) % 12 AS TT_RMS,
    CAST(l_linenumber % 5 AS BIGINT) AS BED_RMS,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '1-POOR' WHEN '2' THEN '2-FAIR'
      WHEN '3' THEN '3-AVERAGE' WHEN '4' THEN '4-GOOD' ELSE '5-EXCELLENT' END AS OVERALL_COND,
    p_type AS BLDG_TYPE,
    p_brand AS STYLE,
    lpad(CAST(c_nationkey + 2100 AS VARCHAR), 5, '0') AS ZIP_CODE,
    CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS OWN_OCC,
    l_quantity * 2000 + p_retailprice AS prediction,
    p_size, p_name, p_type, p_retailprice, c_nationkey, c_mktsegment, o_orderstatus,
    o_orderpriority, o_orderdate, l_shipdate, l_quantity, l_discount, l_tax
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
)"""

DIRTY = """
dirty AS (
  SELECT *,
    CASE WHEN l_linenumber <> 7 THEN LIVING_AREA END AS LIVING_AREA_N,
    CASE WHEN p_size % 10 <> 0 THEN BLDG_TYPE END AS BLDG_TYPE_N,
    CASE WHEN l_linenumber <> 3 THEN o_orderstatus = 'F' END AS OWN_OCC_FLAG,
    CASE WHEN p_size % 25 = 0 THEN -l_quantity * 100 ELSE l_quantity * 100 END AS GROSS_AREA_RAW,
    CASE WHEN p_size % 23 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS TOTAL_VALUE_RAW,
    CASE WHEN p_size % 17 = 0 THEN CAST(0 AS BIGINT) ELSE YR_BUILT END AS YR_BUILT_RAW,
    CASE WHEN p_size % 13 = 0 THEN GROSS_AREA * 1.2 ELSE LIVING_AREA END AS LIVING_AREA_RAW,
    CASE WHEN l_linenumber % 3 = 0 THEN concat('$', CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR))
         WHEN l_linenumber % 3 = 1 THEN concat(CAST(CAST(floor(CAST(floor(l_extendedprice) AS BIGINT) / 1000) AS BIGINT) AS VARCHAR), ',',
                                              lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0'))
         ELSE 'invalid' END AS MONEY_TEXT,
    CASE WHEN l_orderkey % 500 = 0 THEN l_extendedprice * 50 ELSE l_extendedprice END AS TOTAL_VALUE_OUT,
    concat(' ', CAST(l_suppkey AS VARCHAR), ' ',
           CASE l_linenumber % 4 WHEN 0 THEN 'N' WHEN 1 THEN 's' WHEN 2 THEN 'E' ELSE 'w' END, '  ',
           p_name, ' ', CASE p_size % 3 WHEN 0 THEN 'St' WHEN 1 THEN 'Ave' ELSE 'Rd' END,
           ' Apt ', CAST(p_size AS VARCHAR)) AS ADDRESS,
    CASE l_linenumber WHEN 1 THEN 'excellent' WHEN 2 THEN 'Very Good' WHEN 3 THEN ' good '
         WHEN 4 THEN 'fair condition' WHEN 5 THEN 'POOR' WHEN 6 THEN 'avg' END AS CONDITION_TEXT,
    CASE p_size % 7 WHEN 0 THEN 'colonial' WHEN 1 THEN ' Ranch ' WHEN 2 THEN 'cape' WHEN 3 THEN 'Cape Cod'
         WHEN 4 THEN 'split level' WHEN 5 THEN 'contemporary' ELSE 'Victorian' END AS STYLE_TEXT,
    CASE WHEN l_linenumber = 7 THEN NULL WHEN p_size % 11 = 0 THEN 'AVG' WHEN p_size % 13 = 0 THEN '3-'
         WHEN p_size % 19 = 0 THEN 'VG - VERY GOOD' ELSE OVERALL_COND END AS OVERALL_COND_RAW,
    CAST(l_linenumber AS DOUBLE) - 1 + l_tax * 10 AS INT_COND_NUM,
    YR_BUILT + l_discount * 10 AS YR_FRAC
  FROM assess
)"""

FEEDBACK_RAW = """
feedback_raw AS (
  SELECT event_id AS id, ts AS created_at,
    round((CAST(props->>'k' AS BIGINT) * CAST(2.45 AS DOUBLE) + 1) * 4000, 2) AS predicted_price,
    round(value * 10000, 2) AS actual_price,
    CAST(props->>'k' AS BIGINT) % 12 AS confidence,
    event_type AS notes, props AS property_data, CAST(user_id AS VARCHAR) AS user_id
  FROM events
)"""

FEEDBACK_CHECKED = """
feedback_checked AS (
  SELECT *,
    concat_ws('; ',
      CASE WHEN predicted_price IS NULL THEN 'predicted_price is null' END,
      CASE WHEN actual_price IS NULL THEN 'actual_price is null' END,
      CASE WHEN confidence IS NULL THEN 'confidence is null' END,
      CASE WHEN property_data IS NULL THEN 'property_data is null' END,
      CASE WHEN user_id IS NULL THEN 'user_id is null' END,
      CASE WHEN NOT (confidence BETWEEN 1 AND 10) THEN 'confidence out of range' END,
      CASE WHEN NOT (actual_price BETWEEN 50000 AND 5000000) THEN 'actual_price out of range' END,
      CASE WHEN predicted_price IS NOT NULL AND actual_price IS NOT NULL AND deviation IS NULL
           THEN 'deviation undefined' END) AS reasons
  FROM (SELECT *, round(abs(actual_price - predicted_price) / NULLIF(predicted_price, 0), 4) AS deviation
        FROM feedback_raw)
)"""

FEEDBACK = """
feedback AS (
  SELECT id, created_at, predicted_price, actual_price, confidence, notes, property_data, user_id, deviation
  FROM feedback_checked WHERE reasons = ''
)"""

_CTES = {
    "assess": (ASSESS, []),
    "dirty": (DIRTY, ["assess"]),
    "feedback_raw": (FEEDBACK_RAW, []),
    "feedback_checked": (FEEDBACK_CHECKED, ["feedback_raw"]),
    "feedback": (FEEDBACK, ["feedback_checked"]),
}


def with_ctes(body: str, *names: str, extra: list[str] | None = None) -> str:
    """Prefix ``body`` with the named binding CTEs (dependencies first)."""
    order: list[str] = []

    def add(n):
        for dep in _CTES[n][1]:
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [_CTES[n][0].strip() for n in order] + [e.strip() for e in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()

INDICATORS = """
assess_ind AS (
  SELECT *,
    CAST(substr(o_orderpriority, 1, 1) = '1' AS BIGINT) AS "OVERALL_COND_P - POOR",
    CAST(substr(o_orderpriority, 1, 1) = '2' AS BIGINT) AS "OVERALL_COND_F - FAIR",
    CAST(substr(o_orderpriority, 1, 1) = '3' AS BIGINT) AS "OVERALL_COND_A - AVERAGE",
    CAST(substr(o_orderpriority, 1, 1) = '4' AS BIGINT) AS "OVERALL_COND_G - GOOD",
    CAST(substr(o_orderpriority, 1, 1) = '5' AS BIGINT) AS "OVERALL_COND_E - EXCELLENT",
    CAST(p_size % 9 = 0 AS BIGINT) AS "OVERALL_COND_VG - VERY GOOD",
    CAST(l_linenumber % 5 = 0 AS BIGINT) AS "INT_COND_E - EXCELLENT",
    CAST(l_linenumber % 5 = 1 AS BIGINT) AS "INT_COND_G - GOOD",
    CAST(l_linenumber % 5 = 2 AS BIGINT) AS "INT_COND_A - AVERAGE",
    CAST(l_linenumber % 5 = 3 AS BIGINT) AS "INT_COND_F - FAIR",
    CAST(l_linenumber % 5 = 4 AS BIGINT) AS "INT_COND_P - POOR",
    CAST(p_size % 3 = 0 AS BIGINT) AS "EXT_COND_E - EXCELLENT",
    CAST(p_size % 3 = 1 AS BIGINT) AS "EXT_COND_G - GOOD",
    CAST(p_type IN ('ECONOMY', 'SMALL') AS BIGINT) AS "STRUCTURE_CLASS_C - BRICK/CONCR",
    CAST(p_type IN ('MEDIUM', 'STANDARD') AS BIGINT) AS "STRUCTURE_CLASS_D - WOOD/FRAME",
    CAST(p_type = 'LARGE' AS BIGINT) AS "STRUCTURE_CLASS_B - REINF CONCR",
    CAST(c_mktsegment = 'HOUSEHOLD' AS BIGINT) AS "KITCHEN_STYLE2_M - MODERN",
    CAST(c_mktsegment = 'MACHINERY' AS BIGINT) AS "KITCHEN_STYLE2_L - LUXURY",
    CAST(c_mktsegment = 'FURNITURE' AS BIGINT) AS "KITCHEN_STYLE2_S - SEMI-MODERN",
    CAST(o_orderstatus = 'F' AS BIGINT) AS "AC_TYPE_C - CENTRAL AC",
    CAST(o_orderstatus = 'O' AS BIGINT) AS "AC_TYPE_D - DUCTLESS AC",
    CAST(l_linenumber = 1 AS BIGINT) AS "CORNER_UNIT_Y - YES"
  FROM assess
)"""

FORM = """
valuation_form AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    CASE WHEN l_linenumber = 5 THEN 'n/a' ELSE CAST(GROSS_AREA AS VARCHAR) END AS GROSS_AREA,
    CAST(LIVING_AREA AS VARCHAR) AS LIVING_AREA,
    CAST(LAND_SF AS VARCHAR) AS LAND_SF,
    CAST(YR_BUILT AS VARCHAR) AS YR_BUILT,
    coalesce(CAST(YR_REMODEL AS VARCHAR), '') AS YR_REMODEL,
    CAST(BED_RMS AS VARCHAR) AS BED_RMS,
    CASE WHEN p_size % 5 = 0 THEN CAST(FULL_BTH AS VARCHAR) || '.7' ELSE CAST(FULL_BTH AS VARCHAR) END AS FULL_BTH,
    CAST(HLF_BTH AS VARCHAR) AS HLF_BTH,
    CAST(l_linenumber % 3 AS VARCHAR) AS NUM_PARKING,
    '' AS FIREPLACES,
    '1' AS KITCHENS,
    CAST(TT_RMS AS VARCHAR) AS TT_RMS,
    CASE WHEN c_nationkey % 7 = 0 THEN '' ELSE ZIP_CODE END AS ZIP_CODE,
    CASE p_type WHEN 'ECONOMY' THEN 'Brick/Concrete' WHEN 'MEDIUM' THEN 'Wood/Frame'
      WHEN 'LARGE' THEN 'Reinforced Concrete' ELSE '' END AS structureClass,
    CASE l_linenumber % 6 WHEN 0 THEN 'Excellent' WHEN 1 THEN 'Good' WHEN 2 THEN 'Average'
      WHEN 3 THEN 'Fair' WHEN 4 THEN 'Poor' ELSE '' END AS intCondition,
    CASE WHEN p_size % 9 = 0 THEN 'Very Good' ELSE CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Poor'
      WHEN '2' THEN 'Fair' WHEN '3' THEN 'Average' WHEN '4' THEN 'Good' ELSE 'Excellent' END END AS overallCondition,
    CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Modern' WHEN 'MACHINERY' THEN 'Luxury'
      WHEN 'FURNITURE' THEN 'Semi-Modern' ELSE '' END AS kitchenStyle,
    l_linenumber % 2 = 0 AS kitchenTypeFullEatIn,
    CASE o_orderstatus WHEN 'F' THEN 'Central AC' WHEN 'O' THEN 'Ductless AC' ELSE 'None' END AS acType,
    CASE p_size % 3 WHEN 0 THEN 'Forced Hot Air' WHEN 1 THEN 'Hot Water/Steam' ELSE 'None' END AS heatType,
    CASE p_size % 4 WHEN 0 THEN 'Excellent' WHEN 1 THEN 'Good' ELSE 'Average/Other' END AS propView,
    l_linenumber = 1 AS cornerUnit,
    CASE l_linenumber % 3 WHEN 0 THEN 'End' WHEN 1 THEN 'Front/Street' ELSE 'None' END AS orientation,
    CASE p_size % 5 WHEN 0 THEN 'Excellent' WHEN 1 THEN 'Good' ELSE 'Average/Other' END AS extCondition,
    CASE l_linenumber % 4 WHEN 0 THEN 'Slate' WHEN 1 THEN 'Asphalt Shingle' ELSE 'None' END AS roofCover
  FROM assess
)"""

_CTES["assess_ind"] = (INDICATORS, ["assess"])
_CTES["valuation_form"] = (FORM, ["assess"])
