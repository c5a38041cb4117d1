"""Registered queries: categorical encoding (K6 one-hot, E1 label, F1 union
vocabulary, G7 via the ordinal branch) and splits (E4, E5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelkit.operators import encode as E
from parcelkit.operators import ranking as R
from parcelkit.plans import bindings as b
from parcelkit.plans.oracle import with_ctes
from parcelkit.plans.registry import register

KEY = b.ROW_KEY
KEY_SQL = ", ".join(KEY)
FIT_FILTER_SQL = "l_linenumber <= 5 AND p_type <> 'PROMO'"


def _fit_rows(a):
    return a.where((F.col("l_linenumber") <= 5) & (F.col("p_type") != "PROMO"))


def split_hash_col(seed: int = 42):
    """Arithmetic key hash (same in SQL) used by the registered split."""
    return (F.col("l_orderkey") * 1000003 + F.col("l_linenumber") * 10007 + F.col("l_partkey") * 101
            + F.col("l_suppkey") * 7 + seed)


SPLIT_HASH_SQL = "(l_orderkey * 1000003 + l_linenumber * 10007 + l_partkey * 101 + l_suppkey * 7 + 42)"
SPLIT_SQL = f"CASE WHEN ({SPLIT_HASH_SQL} % 100 + 100) % 100 < 20 THEN 'test' ELSE 'train' END"


# ------------------------------------------------------------- one-hot --
_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD"]


@register("one_hot", with_ctes(f"""
SELECT {KEY_SQL}, {", ".join(f"CAST(upper(coalesce(BLDG_TYPE, 'UNKNOWN')) = '{t}' AS DOUBLE) AS BLDG_TYPE_{t}" for t in _TYPES)},
  CAST(upper(coalesce(BLDG_TYPE, 'UNKNOWN')) NOT IN (SELECT DISTINCT upper(coalesce(BLDG_TYPE, 'UNKNOWN'))
       FROM assess WHERE {FIT_FILTER_SQL}) AS DOUBLE) AS BLDG_TYPE_UNKNOWN
FROM assess""", "assess"))
def q_one_hot(spark, sf):
    a = b.assess(spark, sf).select(*KEY, "BLDG_TYPE", "p_type")
    enc = E.fit_encoders(_fit_rows(a), ["BLDG_TYPE"], max_categories=10)
    return E.apply_encoders(a.drop("p_type"), enc)


# --------------------------------------------------------------- label --
_LABEL_VOCAB = f"""vocab AS (
  SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) AS idx FROM (
    SELECT DISTINCT upper(coalesce(STYLE, 'UNKNOWN')) AS v FROM assess WHERE {FIT_FILTER_SQL}
    UNION SELECT 'UNKNOWN'))"""


@register("label_encode", with_ctes(f"""
SELECT {KEY_SQL}, coalesce(vk.idx, (SELECT idx FROM vocab WHERE v = 'UNKNOWN')) AS STYLE
FROM assess a LEFT JOIN vocab vk ON upper(coalesce(a.STYLE, 'UNKNOWN')) = vk.v""", "assess", extra=[_LABEL_VOCAB]))
def q_label_encode(spark, sf):
    a = b.assess(spark, sf).select(*KEY, "STYLE", "p_type")
    enc = E.fit_encoders(_fit_rows(a), ["STYLE"], max_categories=10)
    return E.apply_encoders(a.drop("p_type"), enc)


# ------------------------------------------------------- union vocabulary --
_UNION_VOCAB = """uvocab AS (
  SELECT 'STYLE' AS c, v, CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) AS idx
  FROM (SELECT DISTINCT CAST(STYLE AS VARCHAR) AS v FROM assess WHERE STYLE IS NOT NULL)
  UNION ALL
  SELECT 'BLDG_TYPE', v, CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT)
  FROM (SELECT DISTINCT CAST(BLDG_TYPE AS VARCHAR) AS v FROM assess WHERE BLDG_TYPE IS NOT NULL))"""


@register("label_encode_union", with_ctes(f"""
SELECT {KEY_SQL}, {SPLIT_SQL} AS split, s.idx AS STYLE, t.idx AS BLDG_TYPE
FROM assess a
LEFT JOIN uvocab s ON s.c = 'STYLE' AND s.v = a.STYLE
LEFT JOIN uvocab t ON t.c = 'BLDG_TYPE' AND t.v = a.BLDG_TYPE""", "assess", extra=[_UNION_VOCAB]))
def q_label_encode_union(spark, sf):
    a = R.hash_split(b.assess(spark, sf).select(*KEY, "STYLE", "BLDG_TYPE"), split_hash_col())
    train, test = a.where(F.col("split") == "train"), a.where(F.col("split") == "test")
    out = a
    for c in ("STYLE", "BLDG_TYPE"):
        out = E.apply_label(out, E.fit_label_union([train, test], c), raw_keys=True)
    return out


# -------------------------------------------------------------- splits --
@register("hash_split", with_ctes(f"SELECT {KEY_SQL}, {SPLIT_SQL} AS split FROM assess", "assess"))
def q_hash_split(spark, sf):
    return R.hash_split(b.assess(spark, sf).select(*KEY), split_hash_col())


@register("holdout_tail", with_ctes(f"""
SELECT {KEY_SQL}, CASE WHEN rn > n - floor(n * 0.2) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT {KEY_SQL}, row_number() OVER (ORDER BY {KEY_SQL}) AS rn, count(*) OVER () AS n FROM assess)""",
                                      "assess"))
def q_holdout_tail(spark, sf):
    return R.holdout_tail(b.assess(spark, sf).select(*KEY), [F.col(c) for c in KEY], 0.2)


@register("sample_rows", with_ctes(f"""
SELECT {KEY_SQL}, TOTAL_VALUE FROM assess ORDER BY {SPLIT_HASH_SQL} % 1000003, {KEY_SQL} LIMIT 100""", "assess"))
def q_sample_rows(spark, sf):
    a = b.assess(spark, sf).select(*KEY, "TOTAL_VALUE")
    h = F.struct(F.pmod(split_hash_col(), F.lit(1000003)), *[F.col(c) for c in KEY])
    return R.sample_n(a, h, 100)
