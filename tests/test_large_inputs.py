"""What keeps time and memory of a task bounded on large tables."""
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from parcelkit.operators import forest as FO
from parcelkit.operators import ml as ML
from parcelkit.operators.attribution import permutation_importance
from parcelkit.plans import q_sources
from parcelkit.plans.catalog import QUERIES
from parcelkit.session import JIT_BYTES, scratch_path

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_queries_keep_generated_methods_within_the_jit(spark):
    spark.conf.unset(LIMIT)
    QUERIES["form_payload"](spark, SF_SMALL)
    assert spark.conf.get(LIMIT) == str(JIT_BYTES)
    spark.conf.set(LIMIT, "9000")
    QUERIES["form_payload"](spark, SF_SMALL)
    assert spark.conf.get(LIMIT) == "9000"
    spark.conf.unset(LIMIT)


def test_imputation_joins_its_rows_once(spark):
    plan = QUERIES["impute_missing"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_sorts_of_aligned_tables_are_bounded(spark, monkeypatch):
    want = sorted(QUERIES["align_by_position"](spark, SF_SMALL).collect())
    paths = []
    monkeypatch.setattr(q_sources, "ROWS_PER_SORT", 300)
    monkeypatch.setattr(q_sources, "scratch_path", lambda s, name: paths.append(scratch_path(s, name)) or paths[-1])
    assert sorted(QUERIES["align_by_position"](spark, SF_SMALL).collect()) == want
    for path in paths:
        most = spark.read.parquet(path).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
        assert most < 900


def test_boosting_reads_bounded_tasks(spark, monkeypatch):
    path = scratch_path(spark, "one-file")
    spark.range(1000).selectExpr("id % 7 AS x", "cast(id % 7 + id % 3 AS double) AS y").coalesce(1).write.parquet(path)
    seen, fit = [], ML.train
    monkeypatch.setattr(ML, "train", lambda df, *a, **k: seen.append(df.rdd.getNumPartitions()) or fit(df, *a, **k))
    df = spark.read.parquet(path)
    monkeypatch.setattr(ML, "ROWS_PER_TASK", 100)
    assert ML.bounded_tasks(df, 100).rdd.getNumPartitions() == 10
    assert ML.bounded_tasks(df, 1000).rdd.getNumPartitions() == 1
    ML.train_with_patience(df, df, ["x"], "y", maxIter=2)
    assert seen == [10]


def _leaf_by_loop(tree, row):
    node = 0
    while tree["left"][node] != node:
        node = tree["left"][node] + (row[tree["feature"][node]] > tree["bin"][node])
    return node


@pytest.mark.parametrize("rows", [1, 7, 20])
def test_walk_in_blocks_against_a_loop(monkeypatch, rows):
    monkeypatch.setattr(FO, "BLOCK", 7)
    rng = np.random.default_rng(rows)
    x = rng.integers(0, FO.BINS, (60, 3)).astype(np.uint8)
    grown = FO._grow(x, rng.normal(size=60), np.ones(60), 9, 1, 2, rng)
    leaf = grown["feature"] < 0
    left = np.where(leaf, np.arange(len(leaf)), grown["left"])
    tree = {"feature": np.where(leaf, 0, grown["feature"]).astype(np.int16), "left": left.astype(np.int32),
            "bin": np.where(leaf, FO.BINS, grown["bin"]).astype(np.uint8), "levels": FO._levels(left)}
    x = x[:rows]
    want = [_leaf_by_loop(tree, r) for r in x]
    leaves, asked = FO._walk(FO._steps(tree), FO._cells(x), np.arange(rows) * 3, FO._asks(tree))
    assert leaves.tolist() == want == FO._leaf(tree, x).tolist()
    for r, bits in zip(x, asked):
        node, seen = 0, 0
        while left[node] != node:
            seen |= 1 << int(tree["feature"][node])
            node = left[node] + (r[tree["feature"][node]] > tree["bin"][node])
        assert bits == seen


def test_draws_are_those_of_every_counter():
    seeds = np.random.default_rng(3).integers(-2 ** 62, 2 ** 62, 700)
    whole = FO._row_draws(seeds, 300, 0.02, 42)
    apart = np.concatenate([FO._row_draws(seeds[i:i + 9], 300, 0.02, 42) for i in range(0, 700, 9)])
    assert (whole == apart).all() and 0 < whole.mean() < 0.03


def test_importance_of_a_forest_as_by_scoring_every_swapped_row(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, float(a), None if i % 9 == 4 else float(b), float(c), float(3 * a + (b > 6) * 10 + rng.normal()))
            for i, (a, b, c) in enumerate(rng.integers(0, 12, (300, 3)))]
    rows += [(300, 1.0, 2.0, 3.0, None)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, y double")
    feats = ["a", "b", "c"]
    forest = FO.fit_forest(df, feats, "y", scratch_path(spark, "forest"), numTrees=6, maxDepth=5)
    swapped = []
    quick = FO.Forest.transform_swapped
    monkeypatch.setattr(FO.Forest, "transform_swapped", lambda *a, **k: swapped.append(1) or quick(*a, **k))
    got = permutation_importance(forest, df, feats, "y", ["k"], lambda x: x)

    class Plain:   # any other model: each row once per feature
        transform = staticmethod(forest.transform)

    want = permutation_importance(Plain(), df, feats, "y", ["k"], lambda x: x)
    assert swapped == [1]
    for g, w in zip(got.orderBy("feature").collect(), want.orderBy("feature").collect()):
        assert g.feature == w.feature
        assert np.allclose(g[1:], w[1:], rtol=1e-12)
