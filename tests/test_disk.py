"""What is shuffled and written: each table joined once, rows grouped where the join left them."""
from conftest import SF_SMALL
from pyspark.sql import functions as F

from parcelkit.operators import clean as C
from parcelkit.operators import quality as Q
from parcelkit.plans import bindings as b
from parcelkit.plans import pipeline as PL
from parcelkit.plans import q_ml
from parcelkit.plans.catalog import QUERIES

ROWS = [(1, 60000.0, None), (1, 60000.0, None), (1, 60000.0, None), (2, 40000.0, "a"), (3, float("nan"), "b"), (3, float("nan"), "b"), (4, -0.0, "c"), (4, 0.0, "c")]


def records(spark, rows=ROWS):
    return spark.createDataFrame(rows, "k int, TOTAL_VALUE double, kind string")


def test_counted_rows_are_the_distinct_ones(spark):
    df = records(spark)
    got = C.count_rows(df, "n")
    assert sorted(r.n for r in got.collect()) == [1, 2, 2, 3]
    plain = lambda d: sorted(map(str, d.drop("n").collect()))
    assert plain(got) == plain(C.dedup_rows(df))


def test_quality_of_counted_rows_is_that_of_all(spark):
    for rows in (ROWS, []):
        df = records(spark, rows)
        of = lambda d: sorted(map(tuple, d.collect()))
        every = of(Q.quality_suite(df.drop("k")))
        assert of(Q.quality_suite(C.count_rows(df, "n"), cols=["TOTAL_VALUE", "kind"], rows="n")) == every
        assert len(every) == (3 if rows else 0)


def test_records_are_joined_once_and_deduplicated_in_place(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    cut = []
    monkeypatch.setattr(PL, "cut_lineage", lambda df, f=PL.cut_lineage: cut.append(df._jdf.queryExecution().executedPlan().toString()) or f(df))
    try:
        QUERIES["chain_issues"](spark, SF_SMALL)
        counted = C.count_rows(q_ml.property_frame(spark, SF_SMALL), "n")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("Join" in plan for plan in cut) == 1
    assert counted.count("Exchange hashpartitioning") == 6   # three joins, two sides each


def test_joins_by_order_give_the_same_rows(spark):
    one, other = (b.assess(spark, SF_SMALL, by_order=x) for x in (False, True))
    assert one.columns == other.columns and one.count() == other.count()
    assert one.exceptAll(other).isEmpty()


def test_mitigation_rounds_carry_no_features(spark, monkeypatch):
    rows = [(i, i % 2, float(i % 17), (1.0 + 0.8 * (i % 2)) * (100 + 5.0 * (i % 17) + i % 3)) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, g int, x double, y double")
    cut = []
    monkeypatch.setattr(PL, "cut_lineage", lambda d, f=PL.cut_lineage: cut.append(d.columns) or f(d))
    _, out = PL.evaluate_and_mitigate(df, ["x"], "y", {"g": "g"}, ["k"], rounds=1)
    assert out.columns == ["k", "y", "g", "prediction", "first_prediction"] and out.count() == 400
    assert cut and not any("x" in c for c in cut)


def test_aligned_tables_are_joined_once(spark, monkeypatch):
    from parcelkit.plans import q_sources
    cut = []
    monkeypatch.setattr(q_sources, "cut_lineage", lambda d, f=q_sources.cut_lineage: cut.append(d.columns) or f(d))
    got = QUERIES["align_by_position"](spark, SF_SMALL)
    assert len(cut) == 1 and got.where(~F.col("same_place")).isEmpty()
