"""Address words are marked by one regular expression."""
import random

from pyspark.sql import functions as F

from parcelkit.functions import text as T
from parcelkit.operators import clean as C


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_addresses_are_expanded_by_two_regular_expressions(spark):
    rng = random.Random(3)
    words = ["Apt", "ST", "St.", "Rd", "ave", "Blvd", "n", "S", "e", "W", "STS", "NN", "St_1", "\x01APT\x02", "\x01", "\x02S", "12", "N-S",
             "é", "N'", "\t", "", "$1", "\\"]
    texts = [rng.choice([" ", "  ", ""]).join(rng.choices(words, k=rng.randint(0, 8))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "ADDRESS string")
    got = C.clean_address(df.withColumn("RAW", F.col("ADDRESS")), ["ADDRESS"])
    assert _plan(got).count("regexp_replace(") == 2
    # As one replacement after the other.
    want = F.regexp_replace(F.trim(F.upper("RAW")), r"\s+", " ")
    for short, long in T.ADDRESS_ABBREVIATIONS:
        want = F.regexp_replace(want, rf"\b{short}\b", long)
    assert got.select("RAW", want.alias("w"), "ADDRESS").where(~F.col("w").eqNullSafe(F.col("ADDRESS"))).collect() == []
