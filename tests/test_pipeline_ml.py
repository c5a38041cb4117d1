"""Sources, validation, job chains and Spark ML on small inputs."""
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from parcelkit.operators import ml as ML
from parcelkit.operators import validation as V
from parcelkit.session import scratch_path
from parcelkit.sources import files as S


def test_csv_scan_tolerant(spark):
    path = scratch_path(spark, "csv-test")
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write(" TOTAL_VALUE ,GROSS_AREA, ADDRESS\n")
        f.write('"1,234",100,"1 Main St"\n')
        f.write("$7,abc,2 Oak\n")
        f.write("1,2,3,4,5\n")                   # malformed width -> dropped
        f.write('500,"2,000",x\n')
    df = S.read_assessments_csv(spark, path)
    assert df.columns == ["TOTAL_VALUE", "GROSS_AREA", "ADDRESS"]
    rows = [tuple(r) for r in df.collect()]
    assert rows == [(1234.0, 100.0, "1 Main St"), (None, None, "2 Oak"), (500.0, 2000.0, "x")]


def test_rules_default_and_file(spark):
    r = S.load_rules(spark, "/nonexistent/config.json")
    assert r.missing_threshold == 0.1 and r.numeric_bounds["GROSS_AREA"] == (100.0, 20000.0)
    path = os.path.join(scratch_path(spark, "rules-test"), "c.json")
    os.makedirs(os.path.dirname(path))
    with open(path, "w") as f:
        f.write('{\n "missing_threshold": 0.2,\n "numeric_bounds": {"X": {"min": 1, "max": 2}}\n}')
    r2 = S.load_rules(spark, path)
    p2 = scratch_path(spark, "rules-test-2")
    S.write_rules(spark, r2, p2)
    assert S.load_rules(spark, p2) == r2
    assert r2.missing_threshold == 0.2 and r2.numeric_bounds == {"X": (1.0, 2.0)}


def test_schema_file_create_if_absent(spark):
    df = spark.createDataFrame([(1, "a")], "x bigint, y string")
    path = scratch_path(spark, "schema-test")
    s1 = S.schema_or_create(df, path)
    other = spark.createDataFrame([(1.0,)], "z double")
    assert S.schema_or_create(other, path) == s1 == df.schema


def test_infer_and_validate(spark):
    ref = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("A", None)], "kind string, v double")
    schema = V.infer_schema(ref)
    s = {r["column"]: r for r in schema.collect()}
    assert s["kind"]["domain"] == ["A", "B"] and s["kind"]["required"] is True and s["v"]["required"] is False
    new = spark.createDataFrame([("A", "x", 1), ("C", "y", 2), (None, "z", 3)], "kind string, v string, extra bigint")
    a = {(r["column"], r["anomaly"]): r["detail"] for r in V.validate_against(new, schema).collect()}
    assert a[("v", "type_mismatch")] == "expected double, got string"
    assert ("extra", "unexpected_column") in a
    assert a[("kind", "out_of_domain")] == "1" and a[("kind", "missing_required")] == "1"
    assert V.validation_status(V.validate_against(ref, schema)).first()["status"] == "valid"


def test_pipeline_and_flagship(spark):
    import __spark_entry__ as e
    out = e.queries()["clean_pipeline"](spark, SF_SMALL)
    assert out.where(F.col("LIVING_AREA").isNull()).count() == 0          # imputed
    assert set(r[0] for r in out.select("split").distinct().collect()) == {"train", "test"}
    fl = e.entry(spark).collect()
    assert {r["level"] for r in fl} == {"group", "overall"}


def test_train_save_load_score(spark):
    rows = [(float(i), float(i % 7), 3.0 * i + (i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    m = ML.train(df, ["a", "b"], "y", "linear")
    path = scratch_path(spark, "model-test")
    ML.save_model(m, path)
    scored = ML.score(ML.load_model(path), df.withColumn("k", F.monotonically_increasing_id()), ["k", "y"], "7")
    r = scored.agg(F.max(F.abs(F.col("y") - F.col("prediction"))).alias("e"), F.first("model_version")).first()
    assert r[0] < 1e-6 and r[1] == "7"
    assert set(ML.list_models()) == {"random_forest", "gbt", "linear"}
    try:
        ML.get_model("nope")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass
