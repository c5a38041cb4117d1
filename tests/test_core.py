"""Target split and column roles."""
import pytest

from parcelkit.operators.clean import split_target
from parcelkit.operators.roles import column_roles


def test_split_target(spark):
    df = spark.createDataFrame([(1, 10.0, 100.0), (2, 20.0, 200.0)], "row_id bigint, a double, target double")
    x, y = split_target(df, "target", ["row_id"])
    assert "target" not in x.columns and y.columns == ["row_id", "target"]
    assert x.count() == df.count() == y.count()


def test_split_target_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    with pytest.raises(ValueError):
        split_target(df, "target", ["a"])


def test_column_roles(spark):
    df = spark.createDataFrame(
        [(1, 1.5, "A", "X", 100, "P1", "1 Main St", 42.3, -71.0, "x" * 60, True, "2020-01-01", 1990),
         (2, 2.5, "B", "Y", 200, "P2", "2 Oak St", 42.4, -71.1, "y" * 60, False, "2021-02-03", 2000),
         (3, 3.5, "A", "Z", 300, "P3", "3 Elm St", 42.5, -71.2, "z" * 60, True, "2022-03-04", 2010)],
        "num1 bigint, num2 double, cat1 string, cat2 string, target bigint, property_id string, address string, "
        "latitude double, longitude double, description string, is_renovated boolean, last_sale string, "
        "year_built bigint")
    r = column_roles(df)
    assert r["identifier"] == ["property_id"]
    assert set(r["coordinates"]) == {"latitude", "longitude"}
    assert r["address"] == ["address"]
    assert r["text"] == ["description"]
    assert r["datetime"] == ["last_sale"]
    assert r["boolean"] == ["is_renovated"]
    assert set(r["categorical"]) == {"cat1", "cat2"}
    assert set(r["numerical"]) == {"num1", "num2", "target", "year_built"}


def test_all_null_numeric_is_boolean(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert column_roles(df)["boolean"] == ["x"]
