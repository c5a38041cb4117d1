"""Embedding near-duplicates by an epsilon grid order join.

Cosine >= t of unit vectors is a distance of at most eps = sqrt(2 - 2 t).
Vectors are projected on a few leading principal directions (an orthonormal
basis, so projected distances never exceed true ones), get a grid cell of
width eps in each, and are sorted by cell.  The sorted sequence is cut into
blocks; two blocks are joined only if a cell of one is next to a cell of the
other and their bounding boxes lie within eps.  Block pairs are grouped in
tiles, which bounds how often a block is shipped.  Inside a task the join is
recursive: two sequence intervals whose boxes lie farther apart than eps are
skipped, others are halved until they are small, and the rest is compared in
double precision.  Skipping is exact, so recall is 1; the basis is fitted on at
most ``sample`` vectors and decides only how much is skipped.

Equal vectors are one class with a count.  A task returns for each vector how
many others it links with there and one edge to the smallest vector of its
local component, so output is linear in a block however many pairs link.

Defined cases: vectors that are null, zero, empty or hold null or non-finite
components link with nothing; vectors of different lengths link with nothing;
repeated rows are linked with each other; null ids take part but never name a
component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import drop_table, materialize
from parcelkit.llm.components import connected_components

THRESHOLD = 0.95
DIRECTIONS, KEYS = 6, 3      # projected on, and of them used to find neighbouring blocks
BLOCK = 4096
LEAF = 256
SAMPLE = 20_000
TILE_BYTES = 32 << 20


def epsilon(threshold: float) -> float:
    """Largest distance of linked unit vectors, with room for rounding."""
    return float(np.sqrt(max(0.0, 2 - 2 * threshold))) * (1 + 1e-9) + 1e-9


def units(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def principal_directions(vectors: np.ndarray, count: int = DIRECTIONS) -> np.ndarray:
    """Leading orthonormal directions (columns) of a sample of vectors."""
    unit = units(vectors)
    _, directions = np.linalg.eigh(unit.T @ unit)
    return directions[:, ::-1][:, :count]


def box_gap(low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray, high_b: np.ndarray) -> float:
    """Squared distance of two boxes."""
    gap = np.maximum(0.0, np.maximum(low_a - high_b, low_b - high_a))
    return float(gap @ gap)


def interval_join(unit_a: np.ndarray, place_a: np.ndarray, unit_b: np.ndarray, place_b: np.ndarray, eps: float,
                  threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of linked vectors of two sorted intervals; i < j if
    they are the same one."""
    todo = [(0, len(unit_a), 0, len(unit_b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if same and b1 <= a0:
            continue
        pa_, pb_ = place_a[a0:a1], place_b[b0:b1]
        if box_gap(pa_.min(0), pa_.max(0), pb_.min(0), pb_.max(0)) > eps * eps:
            continue
        if a1 - a0 <= LEAF and b1 - b0 <= LEAF:
            i, j = np.nonzero(unit_a[a0:a1] @ unit_b[b0:b1].T >= threshold - 1e-9)
            i, j = i + a0, j + b0
            exact = (unit_a[i] * unit_b[j]).sum(1) >= threshold
            if same:
                exact &= i < j
            if exact.any():
                yield i[exact], j[exact]
        elif a1 - a0 >= b1 - b0:
            middle = (a0 + a1) // 2
            todo += [(a0, middle, b0, b1), (middle, a1, b0, b1)]
        else:
            middle = (b0 + b1) // 2
            todo += [(a0, a1, b0, middle), (a0, a1, middle, b1)]


class _Forest:
    """Smallest-member union-find over the vectors of a block pair."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: int) -> int:
        root = x
        while self.parent[root] != root:
            root = self.parent[root]
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def join(self, pairs: np.ndarray) -> None:
        for x, y in pairs.tolist():
            x, y = self.find(x), self.find(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)

    def join_all(self, i: np.ndarray, j: np.ndarray) -> None:
        """A star per left vector is enough: links first to each i's smallest partner, then i to the rest."""
        roots = np.unique(np.stack([self.roots(i), self.roots(j)], 1), axis=0)
        self.join(roots[roots[:, 0] != roots[:, 1]])

    def roots(self, x: np.ndarray) -> np.ndarray:
        found = self.parent[x]
        while not np.array_equal(up := self.parent[found], found):
            found = up
        return found


def _classes(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """(every row with its class key, valid classes with a node number, paths)."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    valid = F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    source = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    keyed = source.withColumn("v", F.when(valid, F.transform(v, lambda x: x + F.lit(0.0))))   # -0.0 is 0.0
    keyed, keyed_path = materialize(keyed.withColumn("k1", F.when(v.isNotNull(), F.xxhash64("v")))
                                    .withColumn("k2", F.when(v.isNotNull(), F.xxhash64(F.lit(7), "v"))), "ego-rows")
    classes, path = materialize(
        keyed.where("k1 IS NOT NULL").groupBy("k1", "k2")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
        .withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("v")), "ego-classes")
    return keyed, classes, [keyed_path, path]


def _blocks(classes: DataFrame, directions: np.ndarray, eps: float) -> DataFrame:
    """Blocks of the grid order: block, low, high (box), cells, and the vectors
    as node, copies, data (bytes of doubles)."""
    dim, count = directions.shape
    keys = min(KEYS, count)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("v").flatten().to_numpy().reshape(-1, dim)
            cells = np.floor(units(flat) @ directions / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("copies"), batch.column("v"),
                 *[pa.array(cells[:, k]) for k in range(count)]],
                ["node", "copies", "v", *[f"c{k}" for k in range(count)]])

    cells = ", ".join(f"c{k} int" for k in range(count))
    placed = classes.select("node", "copies", "v").mapInArrow(place, f"node bigint, copies bigint, v array<double>, {cells}")
    order = [f"c{k}" for k in range(count)] + ["node"]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, copies, vectors = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, dim)))

        def emit(n: int) -> pa.RecordBatch:
            data = np.ascontiguousarray(vectors[:n])
            at = units(data) @ directions
            found = np.unique(np.floor(at[:, :keys] / eps).astype(np.int64), axis=0)
            return pa.RecordBatch.from_arrays(
                [pa.array([int(node[0])]), pa.array([at.min(0).tolist()]), pa.array([at.max(0).tolist()]),
                 pa.array([[",".join(map(str, c)) for c in found.tolist()]]), pa.array([node[:n].tobytes()], pa.binary()),
                 pa.array([copies[:n].tobytes()], pa.binary()), pa.array([data.tobytes()], pa.binary())],
                ["block", "low", "high", "cells", "node", "copies", "data"])

        for batch in batches:
            node = np.concatenate([node, batch.column("node").to_numpy()])
            copies = np.concatenate([copies, batch.column("copies").to_numpy()])
            vectors = np.concatenate([vectors, batch.column("v").flatten().to_numpy().reshape(-1, dim)])
            while len(node) >= BLOCK:
                yield emit(BLOCK)
                node, copies, vectors = node[BLOCK:], copies[BLOCK:], vectors[BLOCK:]
        if len(node):
            yield emit(len(node))

    return ordered.mapInArrow(pack, "block bigint, low array<double>, high array<double>, cells array<string>, "
                                    "node binary, copies binary, data binary")


def _block_pairs(blocks: DataFrame, eps: float, keys: int) -> DataFrame:
    """(a, b), a <= b: blocks with neighbouring cells and boxes within eps."""
    meta = blocks.select("block", "low", "high", "cells")
    steps = F.array(*[F.array(*map(F.lit, s)) for s in product((-1, 0, 1), repeat=keys)])
    near = F.flatten(F.transform("cells", lambda c: F.transform(
        steps, lambda s: F.array_join(F.zip_with(F.split(c, ",").cast("array<int>"), s, lambda x, y: x + y)
                                      .cast("array<string>"), ","))))
    left = meta.select(F.col("block").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"),
                       F.explode(F.array_distinct(near)).alias("cell"))
    right = meta.select(F.col("block").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"),
                        F.explode("cells").alias("cell"))
    zero = F.lit(0.0)
    gaps = F.zip_with(
        F.zip_with("low_a", "high_b", lambda x, y: F.greatest(zero, x - y)),
        F.zip_with("low_b", "high_a", lambda x, y: F.greatest(zero, x - y)), lambda x, y: F.greatest(x, y))
    gap = F.aggregate(gaps, zero, lambda s, x: s + x * x)
    return left.join(right, "cell").where(F.col("a") <= F.col("b")).where(gap <= eps * eps).select("a", "b").distinct()


def _tiles(blocks: DataFrame) -> int:
    """Into how many parts the blocks are dealt: the tile of two parts is a task, so there are about two tiles per core,
    and a tile's blocks have at most about 2 * TILE_BYTES."""
    size = blocks.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    return max(int(np.ceil(np.sqrt(4 * cores))), -(-size // TILE_BYTES))


def _links(blocks: DataFrame, pairs: DataFrame, directions: np.ndarray, eps: float,
           threshold: float) -> tuple[DataFrame, str]:
    """(node, partner_copies, root) per block pair and linked vector, and the folder of tiles that the frame reads.

    Pairs are grouped in tiles, so a block travels once to each tile that has a pair of it, not once per pair."""
    dim, parts = directions.shape[0], _tiles(blocks)
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(parts))
    tiled, path = materialize(pairs.select("a", "b", (
        F.least(part("a"), part("b")) * parts + F.greatest(part("a"), part("b"))).alias("tile")), "ego-tiles")
    needed = tiled.select(F.col("tile").alias("at"), F.explode(F.array("a", "b")).alias("block")).distinct()
    shipped = needed.join(blocks.select("block", "node", "copies", "data"), "block")

    def join_pair(a: tuple, b: tuple, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        node, copies, unit = a
        other, shift = unit, 0
        if not same:
            node, copies, other, shift = np.concatenate([node, b[0]]), np.concatenate([copies, b[1]]), b[2], len(node)
        order = np.argsort(node)               # so the forest's smallest member is the smallest node
        rank = np.empty(len(node), np.int64)
        rank[order] = np.arange(len(node))
        degree, forest = np.zeros(len(node), np.int64), _Forest(len(node))
        for i, j in interval_join(unit, unit @ directions, other, other @ directions, eps, threshold, same):
            j = j + shift
            degree += np.bincount(i, copies[j], len(node)).astype(np.int64)
            degree += np.bincount(j, copies[i], len(node)).astype(np.int64)
            forest.join_all(rank[i], rank[j])
        linked = np.flatnonzero(degree)
        return node[linked], degree[linked], node[order[forest.roots(rank[linked])]]

    def join(held: pa.Table, wanted: pa.Table) -> pa.Table:
        read = {}
        for block, node, copies, data in zip(*[held.column(c) for c in ("block", "node", "copies", "data")]):
            read[block.as_py()] = (np.frombuffer(node.as_buffer(), np.int64), np.frombuffer(copies.as_buffer(), np.int64),
                                   units(np.frombuffer(data.as_buffer(), np.float64).reshape(-1, dim)))
        found = [join_pair(read[a], read[b], a == b) for a, b in zip(wanted.column("a").to_pylist(), wanted.column("b").to_pylist())]
        columns = [np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in range(3)]
        return pa.table(dict(zip(("node", "partner_copies", "root"), columns)))

    grouped = shipped.groupBy("at").cogroup(tiled.groupBy("tile"))
    return grouped.applyInArrow(join, "node bigint, partner_copies bigint, root bigint"), path


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    spark = rows.sparkSession
    eps = epsilon(threshold)
    keyed, classes, paths = _classes(rows, id_col, vector_col)
    found = spark.createDataFrame([], "node bigint, partner_copies bigint, root bigint")
    for (dim,) in classes.select("dim").distinct().collect():   # one row per vector length
        part = classes.where(F.col("dim") == dim)
        sample = part.orderBy(F.xxhash64("node")).limit(SAMPLE).select("v").toPandas()
        directions = principal_directions(np.array(sample["v"].tolist(), np.float64))
        blocks, blocks_path = materialize(_blocks(part, directions, eps), "ego-blocks")
        pairs = _block_pairs(blocks, eps, min(KEYS, directions.shape[1]))
        linked, tiles_path = _links(blocks, pairs, directions, eps, threshold)
        links, links_path = materialize(linked, "ego-links")
        found = found.union(links)
        paths += [blocks_path, tiles_path, links_path]
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    degrees = found.groupBy("node").agg(F.sum("partner_copies").alias("degree"))
    grouped = (classes.select("k1", "k2", "id", "copies", "node").join(degrees, "node", "left")
               .join(roots, F.col("node") == F.col("u"), "left")
               .select("k1", "k2", "id", (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                       F.coalesce("v", "node").alias("root")))
    least = grouped.groupBy("root").agg(F.min("id").alias("component_id"))
    named = grouped.join(least, "root").select("k1", "k2", "n_links", "component_id")
    alone = F.col("k1").isNull()
    result, _ = materialize(
        keyed.select("id", "k1", "k2").join(named, ["k1", "k2"], "left")
        .select("id", F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
                F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
        .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))), "ego-result")
    drop_table(spark, *paths)
    return result.withColumnRenamed("id", id_col)
