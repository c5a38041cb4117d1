"""Query registry used by ``__spark_entry__`` and ``bench.py``.

Each registered query is ``fn(spark, sf_dir) -> DataFrame`` reading the whole
driver tables; its oracle (when SQL can express it) is DuckDB SQL over the
same tables.  Doubles are rounded to 4 decimals on both sides because the
two engines may differ in the last bit of a floating sum.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from parcelkit.session import within_jit

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
BENCH: list[str] = []


def register(name: str, sql: str | None = None, bench: bool = False):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @wraps(fn)
        def run(spark, sf_dir):
            within_jit(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        if bench:
            BENCH.append(name)
        return fn
    return deco


def round_to(c, digits: int = 4):
    """sign(x) * floor(|x| * 10^d + 0.5) / 10^d: half-away-from-zero rounding
    with the same IEEE steps as the oracle engine's double rounding (a value
    between two 4-decimal numbers in decimal text but not in binary rounds
    the same way on both sides).  Cheap math only -- ``round`` on doubles
    goes through BigDecimal, 2-3x slower on wide frames."""
    m = float(10 ** digits)
    scaled = F.abs(c * m)
    # From 2^53 on a double has no decimals to round; floor() would overflow BIGINT.
    return F.when(scaled < float(1 << 53), F.signum(c) * F.floor(scaled + 0.5) / m).otherwise(c)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double/float column (presentation for cross-engine checks)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(round_to(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
