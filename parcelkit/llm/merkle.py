"""Merkle manifest of a table: a content-addressed DAG that proofs descend.

A row is a leaf, the digest of its fields.  Within a group (``source``) the
leaves ascend by key, and runs of 16 neighbours become the digest of their
concatenated digests until one node, the subroot, remains; the subroots,
ascending by group, become the root in the same way.  Every inner node is a
record ``digest -> children`` in a store below the shared folder.

A proof is not built upwards beside the tree but read from the store: the
request for leaf number r of its group starts at the root and at each record
takes the child that the next base-16 digit of its rank names, and collects
the children it leaves aside.  The segments found on the way down, reversed,
are the proof.  Requests that share their first digits share the descent, so a
level touches each record once, whatever the number of requests below it.

Text is read once, for the leaf digests; everything after that moves digests
and numbers.  A level is one grouping by (group, rank div 16), so a group that
holds a third of the rows is as spread out as any other, and no level gives a
task more than 16 rows of a run.

Defined cases: a null field counts as ``-``; a null group is a group of its own
and comes first; null keys come first in their group; rows with equal keys are
ordered by leaf digest, so only equal rows are interchangeable (each has its own
place and proof); a group of one row has its leaf as subroot, a table of one
group its subroot as root; an empty table gives no rows and a null root; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.llm.common import drop_table, materialize
from parcelkit.llm.sharding import number_rows
from parcelkit.session import scratch_path

FANOUT = 16
_BITS = 4
_PATH = "array<struct<place:int,before:string,after:string>>"


def field(value: Column) -> Column:
    """One field of a leaf: its UTF-8 byte count, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and the proof's segments (leaf level first) give."""
    return F.aggregate(proof, leaf, lambda node, seg: F.sha2(F.concat(seg["before"], node, seg["after"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level and left to right, as one text."""
    return F.array_join(F.transform(proof, lambda seg: F.concat(seg["before"], seg["after"])), "")


@dataclass
class Manifest:
    """A stored tree.  ``leaves`` (row columns, group_no, rank, leaf) and ``groups`` (group, group_no, rank, n, height,
    digest) are frames over tables in ``folder``; ``records`` are the folders of the two stores there."""
    folder: str
    leaves: DataFrame
    groups: DataFrame
    root: str | None
    root_height: int

    def records(self, spark: SparkSession, store: str, level: int) -> DataFrame:
        """digest -> children of one level; equal subtrees are one record."""
        table = spark.read.parquet(f"{self.folder}/{store}/level={level}")
        return table.select("digest", "children").dropDuplicates(["digest"])

    def drop(self, spark: SparkSession) -> None:
        drop_table(spark, self.folder)


def _height(n: int) -> int:
    """Levels above ``n`` nodes."""
    height = 0
    while n > 1:
        n, height = -(-n // FANOUT), height + 1
    return height


def _store_levels(nodes: DataFrame, most: int, folder: str) -> None:
    """Write the records above ``nodes`` (group_no, rank, n, digest; n: nodes of that level in the group, at most
    ``most``), a folder per level."""
    spark = nodes.sparkSession
    for level in range(1, _height(most) + 1):
        kids = F.array_sort(F.collect_list(F.struct("rank", "digest")))
        runs = (nodes.where("n > 1").groupBy("group_no", F.shiftright("rank", _BITS).alias("up"))
                .agg(kids.alias("kids"), F.first("n").alias("n")))
        above = runs.select("group_no", F.col("up").alias("rank"),
                            F.shiftright(F.col("n") + (FANOUT - 1), _BITS).alias("n"),
                            F.transform("kids", lambda k: k["digest"]).alias("children"))
        path = f"{folder}/level={level}"
        above.withColumn("digest", F.sha2(F.array_join("children", ""), 256)).write.parquet(path)
        nodes = spark.read.parquet(path).select("group_no", "rank", "n", "digest")


def _tops(base: DataFrame, most: int, folder: str) -> DataFrame:
    """(group_no, height, digest): the node that remains of every group."""
    spark = base.sparkSession
    tops = base.where("n = 1").select("group_no", F.lit(0).alias("height"), "digest")
    for level in range(1, _height(most) + 1):
        above = spark.read.parquet(f"{folder}/level={level}").where("n = 1")
        tops = tops.union(above.select("group_no", F.lit(level).alias("height"), "digest"))
    return tops


def build(leaves: DataFrame, group_col: str, key_col: str) -> Manifest:
    """The manifest of ``leaves``: a column ``leaf`` (digest), the group and the key; further columns are kept."""
    spark = leaves.sparkSession
    folder = scratch_path(spark, "merkle")
    leaves.write.parquet(f"{folder}/digests")
    written = spark.read.schema(leaves.schema).parquet(f"{folder}/digests")
    numbered, n, number_path = number_rows(written, [group_col, key_col, "leaf"], "_row")
    (numbered.groupBy(group_col).agg(F.min("_row").alias("group_no"), F.count(F.lit(1)).alias("n"))
     .write.parquet(f"{folder}/spans"))
    spans = spark.read.parquet(f"{folder}/spans")
    placed = numbered.alias("l").join(spans.alias("s"), F.col(f"l.{group_col}").eqNullSafe(F.col(f"s.{group_col}")))
    (placed.select(*[f"l.{c}" for c in leaves.columns], "group_no", (F.col("_row") - F.col("group_no")).alias("rank"), "n")
     .write.parquet(f"{folder}/leaves"))
    drop_table(spark, number_path, f"{folder}/digests")
    ranked = spark.read.parquet(f"{folder}/leaves")
    most = spans.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    base = ranked.select("group_no", "rank", "n", F.col("leaf").alias("digest"))
    _store_levels(base, most, f"{folder}/rows")

    ordered, count, order_path = number_rows(spans, ["group_no"], "rank")
    tops = _tops(base, most, f"{folder}/rows")
    ordered.join(tops, "group_no").write.parquet(f"{folder}/groups")
    drop_table(spark, order_path)
    groups = spark.read.parquet(f"{folder}/groups")
    subroots = groups.select(F.lit(0).cast("long").alias("group_no"), "rank", F.lit(count).cast("long").alias("n"), "digest")
    _store_levels(subroots, count, f"{folder}/groups-above")
    top = _tops(subroots, count, f"{folder}/groups-above").first()
    return Manifest(folder, ranked, groups, top and top["digest"], _height(count))


def _choose(parents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (group_no, rank, ...) below ``parents`` (group_no, rank, children, path): the child that the last
    digit of the rank names as ``digest``, the others added to ``path``."""
    p = parents.select(F.col("group_no").alias("_g"), F.col("rank").alias("_r"), "children", "path")
    below = wanted.join(p, (F.col("group_no") == F.col("_g")) & (F.shiftright("rank", _BITS) == F.col("_r")))
    place = F.col("rank").bitwiseAND(FANOUT - 1).cast("int")
    segment = F.struct(place.alias("place"), F.array_join(F.slice("children", 1, place), "").alias("before"),
                       F.array_join(F.slice("children", place + 2, FANOUT), "").alias("after"))
    return below.select(*wanted.columns, F.get("children", place).alias("digest"),
                        F.concat("path", F.array(segment)).alias("path"))


def _descend(manifest: Manifest, store: str, entries: DataFrame, requests: DataFrame,
             height: int) -> tuple[DataFrame, list[str]]:
    """Send ``requests`` (group_no, rank, ...) down from ``entries`` (group_no, height, digest, path), the tops of
    their groups: (requests with ``digest`` and ``path``, root level first; scratch tables this frame reads)."""
    spark = requests.sparkSession
    paths: list[str] = []
    at_top = entries.select("group_no", "height", "digest", "path")
    done = requests.join(at_top.where("height = 0").drop("height"), "group_no").select(*requests.columns, "digest", "path")
    frontier = None
    for level in range(height, 0, -1):
        entering = (at_top.where(F.col("height") == level)
                    .select("group_no", F.lit(0).cast("long").alias("rank"), "digest", "path"))
        frontier = entering if frontier is None else frontier.unionByName(entering)
        parents = frontier.join(manifest.records(spark, store, level), "digest")
        if level == 1:
            return done.unionByName(_choose(parents, requests)), paths
        inner = entries.where(F.col("height") >= level).select("group_no")
        wanted = (requests.join(inner, "group_no", "left_semi")
                  .select("group_no", F.shiftright("rank", _BITS * (level - 1)).alias("rank")).distinct())
        frontier, path = materialize(_choose(parents, wanted), "merkle-frontier")
        paths.append(path)
    return done, paths


def prove(manifest: Manifest, requests: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Proofs of ``requests``, rows of ``manifest.leaves`` (default: all): their columns with ``subroot``, ``found``
    (the leaf the descent ended at) and ``proof`` (segments from the leaf up: place in the run, digests before and
    after it, 64 characters each).  Also the scratch tables that the frame reads; drop them when it is written."""
    spark = manifest.leaves.sparkSession
    requests = manifest.leaves if requests is None else requests
    carried = [c for c in requests.columns if c not in ("group_no", "rank", "n")]
    groups = manifest.groups.select(F.lit(0).cast("long").alias("group_no"), "rank", F.col("group_no").alias("_group"),
                                    "height", F.col("digest").alias("subroot"))
    empty = F.array().cast(_PATH)
    top = spark.createDataFrame([(0, manifest.root_height, manifest.root)], "group_no long, height int, digest string")
    found, paths = _descend(manifest, "groups-above", top.withColumn("path", empty), groups, manifest.root_height)
    entries, entry_path = materialize(found.select(F.col("_group").alias("group_no"), "height", "digest", "path"),
                                      "merkle-entries")
    drop_table(spark, *paths)
    most = manifest.groups.agg(F.coalesce(F.max("height"), F.lit(0))).first()[0]
    got, paths = _descend(manifest, "rows", entries, requests.select("group_no", "rank", F.struct(*carried).alias("_row")), most)
    subroots = manifest.groups.select("group_no", F.col("digest").alias("subroot"))
    out = got.join(subroots, "group_no").select("_row.*", "subroot", F.col("digest").alias("found"),
                                                F.reverse("path").alias("proof"))
    return out, [*paths, entry_path]


def verified_documents(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text",
                       columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """The manifest of ``docs`` put to the test: (id, leaf, subroot, root, proof_sha256, folded_root, verified).

    In rows whose id has a CRC-32 (of its decimal text) that 5 divides, the text is lower-cased (A-Z) after the
    manifest was made; ``folded_root`` is what the row as it then is and the proof give."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    chosen = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0
    changed = leaf_digest([F.translate(c, capitals, capitals.lower()) if c == text_col else F.col(c) for c in columns])
    leaf = leaf_digest([F.col(c) for c in columns])
    digests = docs.select(F.col(id_col).alias("_id"), F.col(group_col).alias("_group"), leaf.alias("leaf"),
                          F.when(chosen, changed).alias("_changed"))
    manifest = build(digests, "_group", "_id")
    proofs, _ = prove(manifest)
    folded = proofs.withColumn("folded_root", fold(F.coalesce("_changed", "found"), F.col("proof")))
    root = F.lit(manifest.root).cast("string")
    return folded.select(F.col("_id").alias(id_col), F.col("found").alias("leaf"), "subroot", root.alias("root"),
                         F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == root).alias("verified"))
