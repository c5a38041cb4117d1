"""Sharding by a keyed Feistel permutation of global row numbers.

Rows get gapless global numbers in a total order, a generalised Feistel
network over ``Z_a x Z_b`` (``a * b`` is the smallest such box of side
``ceil(sqrt(N))`` holding N) permutes them, and numbers that leave ``[0, N)``
walk the cycle until they return.  The permuted position p gives
``shard = p mod shards`` and ``slot = p div shards``: shard sizes differ by at
most one, slots are gapless, and both directions can be computed from the row
number alone (``row_number_at``).  All expressions are native; only
(id, size, checksum) rows are shuffled, never texts.

Defined cases: a null text has no bytes (size 1) and the checksum of the empty
text; null ids sort first; rows equal in every ordered column are
interchangeable and are numbered in scan order; an empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelkit.llm.common import materialize

ROUNDS = 6
SEED = 20240229
_POSITION_BITS = 33  # monotonically_increasing_id: partition << 33 | position


def box(n: int) -> tuple[int, int]:
    """Sides (a, b) of the Feistel domain: a * b >= n and a * b - n < a."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def network(x: Column, n: int, seed: int = SEED, inverse: bool = False) -> Column:
    """``x`` sent once through the network over [0, a*b).

    The rounds are folded over an array of their constants (halves swap places
    after each), so the expression does not double with every round."""
    a, b = box(n)
    rounds = [(r, a if r % 2 == 0 else b) for r in range(ROUNDS)]
    if inverse:
        rounds = rounds[::-1]
    constants = F.array(*[F.struct(F.lit(r).alias("no"), F.lit(m).cast("long").alias("side")) for r, m in rounds])
    right = F.pmod(x, F.lit(b)).cast("long")
    left = ((x - F.pmod(x, F.lit(b))) / F.lit(b)).cast("long")

    def forward(half: Column, r: Column) -> Column:
        changed = F.pmod(half["x"] + F.pmod(F.xxhash64(half["y"], F.lit(seed), r["no"]), r["side"]), r["side"])
        return F.struct(half["y"].alias("x"), changed.alias("y"))

    def backward(half: Column, r: Column) -> Column:
        changed = F.pmod(half["y"] - F.pmod(F.xxhash64(half["x"], F.lit(seed), r["no"]), r["side"]), r["side"])
        return F.struct(changed.alias("x"), half["x"].alias("y"))

    return F.aggregate(constants, F.struct(left.alias("x"), right.alias("y")), backward if inverse else forward,
                       lambda half: half["x"] * F.lit(b).cast("long") + half["y"])


def permute(df: DataFrame, source: str, name: str, n: int, seed: int = SEED, inverse: bool = False) -> DataFrame:
    """Column ``name``: the permuted ``source`` in [0, n).

    Rows outside [0, n) after a pass take another one.  Three more passes are
    planned at once, of which each leaves a share below ``1 / sqrt(n)``; the
    loop repeats them until none is outside, which ends because the network is
    a bijection of the box and each row started inside."""
    def step(x: Column, _: Column) -> Column:
        return F.when(x < n, x).otherwise(network(x, n, seed, inverse))

    def walk(x: Column) -> Column:
        return F.aggregate(F.array(*map(F.lit, range(3))), x, step)

    df = df.withColumn(name, walk(network(F.col(source), n, seed, inverse)))
    while not df.where(F.col(name) >= n).isEmpty():
        df = df.withColumn(name, walk(F.col(name)))
    return df


def number_rows(df: DataFrame, order: list[str], name: str = "row_no") -> tuple[DataFrame, int, str]:
    """Gapless numbers from 0 in the order of ``order`` without a one-task
    sort: (frame, rows, path of the table that holds it).

    The scan position breaks ties, so a key that holds a third of all rows is
    still cut into several ranges.  Partition and position are written with
    the rows; the offsets table has one row per partition, which is the bound
    of its broadcast."""
    mid = F.col("_mid")
    ranged = (df.withColumn("_scan", F.monotonically_increasing_id())
              .repartitionByRange(*order, "_scan").sortWithinPartitions(*order, "_scan")
              .withColumn("_mid", F.monotonically_increasing_id()).drop("_scan")
              .withColumn("_part", F.shiftright(mid, _POSITION_BITS))
              .withColumn("_at", mid.bitwiseAND((1 << _POSITION_BITS) - 1)).drop("_mid"))
    ranged, path = materialize(ranged, "row-numbers")
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = (ranged.join(F.broadcast(offsets), "_part")
                .withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before"))
    return numbered, ranged.count(), path


def shard_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16,
               seed: int = SEED) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row, law
    ``rows``: shard sizes at most one apart, order inside a shard shuffled."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    sized = docs.select(F.col(id_col), (F.octet_length(raw).cast("long") + 1).alias("size"),
                        F.crc32(raw).alias("text_crc32"))
    numbered, n, _ = number_rows(sized, [id_col, "size", "text_crc32"])
    if n == 0:
        numbered = numbered.withColumn("position", F.lit(0).cast("long"))
    else:
        numbered = permute(numbered, "row_no", "position", n, seed)
    slot = ((F.col("position") - F.pmod("position", F.lit(shards))) / F.lit(shards)).cast("long")
    return numbered.select(id_col, "size", "text_crc32", F.lit("rows").alias("law"),
                           F.pmod("position", F.lit(shards)).cast("int").alias("shard"), slot.alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"), "row_no")


def row_number_at(df: DataFrame, n: int, shards: int = 16, seed: int = SEED) -> DataFrame:
    """Column ``row_no`` computed back from ``shard`` and ``slot``."""
    placed = df.withColumn("_position", F.col("slot") * F.lit(shards) + F.col("shard"))
    return permute(placed, "_position", "row_no", n, seed, inverse=True).drop("_position")
