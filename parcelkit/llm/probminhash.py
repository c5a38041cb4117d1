"""Near duplicates by ProbMinHash over weighted word shingles.

Every shingle of a text (``words`` words, weight: how often it occurs) is a
Poisson process whose rate is its weight; each arrival hits one of the
signature's components at random, and a component keeps the shingle that hits
it first.  Two texts agree in a component with the probability Jaccard
similarity of their shingles.  Arrivals are generated in rounds for all texts
of a slice at once, and a shingle stops as soon as its next arrival comes after
every component of its text is taken by an earlier one.

Equal texts are one class first.  Signatures are cut into bands; texts of a
bucket (same band) are compared with the bucket's pivot by the exact
similarity, and linked ones become components.  Buckets that then still hold
several components have all pairs across components compared, in blocks, with
the signatures as a filter that keeps similarities four standard deviations
below the threshold; what passes is verified exactly.  Pairs inside one
component need no comparison, so a group of thousands of near copies costs one
comparison each, and no link between components is lost.

Words are the lower-cased text split at white space.  Defined cases: a text of
fewer than ``words`` words is one shingle; texts without words (null, empty)
are only joined with equal ones; repeated rows belong to the class of their
text; null ids never become a class id unless all ids of the class are null; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import drop_table, materialize, text_slices
from parcelkit.llm.components import connected_components

WORDS, THRESHOLD = 5, 0.8
#: At similarity 0.8 a pair shares no band with probability (1 - 0.8**5)**25 < 0.0001.
BANDS, ROWS = 25, 5
COMPONENTS = BANDS * ROWS
#: Members of a bucket, and bytes of their shingles, that one task compares with as many others.
BLOCK, BLOCK_BYTES = 512, 16 << 20
SLICE = 2 << 20

_U = np.uint64
_GOLDEN = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64: a bijection of 64-bit numbers that looks random."""
    x = x.astype(_U) + _U(_GOLDEN)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _WordHashes(dict):
    """64-bit hash of each word, remembered while the table is small."""

    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingles(text: str | None, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, sorted; how often each occurs)."""
    parts = text.lower().split() if text else []
    if not parts:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    get = _HASHES.__getitem__
    hashes = np.fromiter(map(get, parts), _U, len(parts))
    width = min(words, len(parts))
    n = len(parts) - width + 1
    with np.errstate(over="ignore"):
        joined = np.full(n, _U(width))
        for k in range(width):
            joined = mix(joined ^ hashes[k:k + n])
    return np.unique(joined, return_counts=True)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over shared shingles i of 1 / sum_j max(a_j / a_i, b_j / b_i).

    max takes the first where a_j / b_j >= a_i / b_i, so with shingles sorted
    by that ratio both parts are running sums."""
    union = np.union1d(a[0], b[0])
    wa, wb = np.zeros(len(union)), np.zeros(len(union))
    wa[np.searchsorted(union, a[0])] = a[1]
    wb[np.searchsorted(union, b[0])] = b[1]
    both = (wa > 0) & (wb > 0)
    if not both.any():
        return 0.0
    with np.errstate(divide="ignore"):
        ratio = wa / wb
    order = np.argsort(-ratio, kind="stable")
    ratio, wa, wb, both = ratio[order], wa[order], wb[order], both[order]
    sum_a, sum_b = np.cumsum(wa), np.cumsum(wb)
    last = np.searchsorted(-ratio, -ratio[both], side="right") - 1     # the last at least as high
    return float(np.sum(1.0 / (sum_a[last] / wa[both] + (sum_b[-1] - sum_b[last]) / wb[both])))


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], components: int = COMPONENTS) -> np.ndarray:
    """ProbMinHash signatures (one row per set, uint64); empty sets give zeros."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(e) for e, _ in sets])
    out = np.zeros(n * components, _U)
    if not len(owner):
        return out.reshape(n, components)
    element = np.concatenate([e for e, _ in sets])
    rate = np.concatenate([w for _, w in sets]).astype(np.float64)
    first = np.full(n * components, np.inf)
    arrival = np.zeros(len(owner))
    with np.errstate(over="ignore"):
        for t in range(1 << 20):
            draw = mix(element ^ mix(np.full(1, t, _U)))
            arrival = arrival - np.log(((draw >> _U(11)).astype(np.float64) + 1.0) * 2.0 ** -53) / rate
            place = owner * components + (mix(draw) % _U(components)).astype(np.int64)
            np.minimum.at(first, place, arrival)
            won = first[place] == arrival
            out[place[won]] = element[won]
            # Early termination: nothing that comes later can be the first of any component.
            alive = arrival < first.reshape(n, components).max(1)[owner]
            if not alive.any():
                break
            if not alive.all():
                owner, element, rate, arrival = owner[alive], element[alive], rate[alive], arrival[alive]
    return out.reshape(n, components)


def band_hashes(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit hash per band of ``rows`` components."""
    parts = signature.reshape(len(signature), -1, rows)
    with np.errstate(over="ignore"):
        out = np.zeros(parts.shape[:2], _U)
        for k in range(rows):
            out = mix(out ^ parts[:, :, k])
    return out.view(np.int64)


def _sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k1, k2, bands, prints) of every row; prints are 16 bits of each component."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SLICE):
            sets = [shingles(t) for t in part.column("text").to_pylist()]
            signature = signatures(sets)
            some = np.array([len(e) > 0 for e, _ in sets])
            bands = band_hashes(signature)
            offsets = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
            prints = mix(signature).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("k1"), part.column("k2"),
                 pa.ListArray.from_arrays(offsets, pa.array(bands[some].ravel())),
                 pa.array([p.tobytes() for p in prints], pa.binary())], ["id", "k1", "k2", "bands", "prints"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("k1"),
                        F.xxhash64(F.lit(7), text).alias("k2"))
    return keyed.mapInArrow(sketch, "id bigint, k1 bigint, k2 bigint, bands array<bigint>, prints binary")


def _texts(nodes: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """(node, text) of each wanted class, written; (frame, path).

    Always a sort-merge join: at scale the wanted keys are too many to be
    broadcast, and the plan should not differ from that on a small table."""
    wanted, wanted_path = materialize(nodes.distinct().join(classes.select("node", "k1", "k2", "id"), "node"),
                                      "near-wanted")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("k1"),
                        F.xxhash64(F.lit(7), text).alias("k2"))
    same = (keyed["k1"] == wanted["k1"]) & (keyed["k2"] == wanted["k2"]) & keyed["id"].eqNullSafe(wanted["id"])
    found = materialize(keyed.join(wanted.hint("merge"), same).select("node", "text").dropDuplicates(["node"]),
                        "near-texts")
    drop_table(docs.sparkSession, wanted_path)
    return found


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> tuple[DataFrame, str]:
    """The pairs (a, b) whose exact similarity reaches the threshold, and their folder; a
    text in very many pairs is a hot key of a join that AQE can split."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[int, tuple] = {}

        def of(node: int, text: str) -> tuple:
            found = recent.get(node)
            if found is None:
                if len(recent) > 64:
                    recent.clear()
                found = recent[node] = shingles(text)
            return found

        for batch in batches:
            for part in text_slices([batch], ("text_a", "text_b")):
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                ta, tb = part.column("text_a").to_pylist(), part.column("text_b").to_pylist()
                linked = [probability_jaccard(of(x, s), of(y, t)) >= threshold
                          for x, y, s, t in zip(a, b, ta, tb, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(
                    pa.array(linked, pa.bool_()))

    with_texts = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
                  .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
                  .select("a", "b", "text_a", "text_b"))
    return materialize(with_texts.mapInArrow(verify, "a bigint, b bigint"), "near-links")


def _packed(texts: DataFrame) -> DataFrame:
    """(node, sets): each text's shingles and counts as bytes."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SLICE):
            found = [shingles(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array([e.tobytes() + w.astype(np.uint32).tobytes() for e, w in found],
                                               pa.binary())], ["node", "sets"])

    return texts.mapInArrow(pack, "node bigint, sets binary")


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw) // 12
    return np.frombuffer(raw, _U, n), np.frombuffer(raw, np.uint32, n, 8 * n).astype(np.int64)


def _cross_links(members: DataFrame, threshold: float) -> tuple[DataFrame, str]:
    """Links (a, b) between different components in a bucket, and a folder that the frame reads.

    ``members``: band, hash, node, label, prints, sets.  Pairs whose signatures
    agree in enough components are verified exactly where they first share a
    band, the likeliest first, and a pair that earlier links of the task have
    joined already needs none; so a task returns a spanning forest, not pairs.
    A large bucket is cut into blocks by members and bytes; each member goes to
    the groups (i, j) of its block with every block, so a task holds two."""
    least = COMPONENTS * threshold - 4 * (COMPONENTS * threshold * (1 - threshold)) ** 0.5
    size, size_path = materialize(
        members.groupBy("band", "hash")
        .agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)),
                        F.ceil(F.sum(F.octet_length("sets")) / F.lit(BLOCK_BYTES))).cast("int").alias("blocks")),
        "near-sizes")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (members.join(size, ["band", "hash"]).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("band", "hash", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "own", "node", "label", "prints", "sets"))

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        band, _, i, j = (k.as_py() for k in key)
        own = group.column("own").to_numpy()
        node, label = group.column("node").to_numpy(), group.column("label").to_numpy()
        prints = np.frombuffer(b"".join(group.column("prints").to_pylist()), np.uint16).reshape(len(node), COMPONENTS)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        found = []
        for x in left:
            rivals = right[label[right] != label[x]]
            if i == j:
                rivals = rivals[node[rivals] > node[x]]
            if not len(rivals):
                continue
            equal = prints[rivals] == prints[x]
            agree = equal.sum(1)
            good = agree >= least
            if band:   # a band they share before this one has the pair already
                good &= ~equal[:, :band * ROWS].reshape(len(rivals), band, ROWS).all(2).any(1)
            if good.any():
                found.append(np.stack([agree[good], np.full(good.sum(), x), rivals[good]], 1).astype(np.int32))
        a, b = [], []
        if found:
            pairs = np.concatenate(found)
            raw = group.column("sets").to_pylist()
            parent = {v: v for v in label.tolist()}

            def root(v: int) -> int:
                while parent[v] != v:
                    parent[v] = v = parent[parent[v]]
                return v

            sets: dict[int, tuple] = {}
            for x, y in pairs[np.argsort(-pairs[:, 0], kind="stable"), 1:].tolist():
                u, v = root(int(label[x])), root(int(label[y]))
                if u == v:
                    continue
                for k in (x, y):
                    if k not in sets:
                        sets[k] = _unpacked(raw[k])
                if probability_jaccard(sets[x], sets[y]) >= threshold:
                    parent[u] = v
                    a.append(int(node[x]))
                    b.append(int(node[y]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("band", "hash", "i", "j").applyInArrow(compare, "a bigint, b bigint").distinct(), size_path


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame, list[str]]:
    """(every row's id and text keys, every distinct text's group, paths of
    both tables).  A group has ``class_id``, its smallest id, and one text that
    is ``chosen``: the one with that id (of several, the first by key)."""
    spark = docs.sparkSession
    sketch, sketch_path = materialize(_sketch(docs, id_col, text_col), "near-sketch")
    classes, classes_path = materialize(
        sketch.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.first("bands").alias("bands"),
                                       F.first("prints").alias("prints"))
        .withColumn("node", F.monotonically_increasing_id()), "near-classes")
    rows = classes.select("node", F.posexplode("bands").alias("band", "hash"))
    # Aggregates by bucket are written before they are joined: else the join would run in their
    # stage, where AQE cannot split the rows of a very large bucket.
    buckets, buckets_path = materialize(
        rows.groupBy("band", "hash").agg(F.min("node").alias("pivot"), F.max("node").alias("far"),
                                         F.count(F.lit(1)).alias("n")).where("n > 1"), "near-pivots")
    held, held_path = materialize(rows.join(buckets, ["band", "hash"]), "near-buckets")

    # 1. Each member of a bucket with the bucket's two pivots.
    pairs = (held.select(F.col("node").alias("a"), F.explode(F.array("pivot", "far")).alias("b")).where("a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    pairs, pairs_path = materialize(pairs, "near-pairs")
    texts, texts_path = _texts(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))),
                               classes, docs, id_col, text_col)
    links, links_path = _verified(pairs, texts, threshold)
    roots = connected_components(links)

    # 2. Buckets that still hold several components: links across them.  Every
    # member of a bucket was in a pair, so its text is at hand.
    label = F.coalesce(F.col("v"), F.col("node"))
    labelled = held.where("n > 2").join(roots, held["node"] == roots["u"], "left").withColumn("label", label)
    labelled, labelled_path = materialize(labelled.select("band", "hash", "node", "label"), "near-labelled")
    mixed, mixed_path = materialize(
        labelled.groupBy("band", "hash").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where("lo <> hi").select("band", "hash"), "near-mixed")
    members, members_path = materialize(labelled.join(mixed, ["band", "hash"]), "near-members")
    sets, sets_path = materialize(
        _packed(texts.join(members.select("node").distinct(), "node", "left_semi"))
        .join(classes.select("node", "prints"), "node"), "near-sets")
    crossing, size_path = _cross_links(members.join(sets, "node"), threshold)
    more, more_path = materialize(crossing, "near-links")
    if not more.isEmpty():
        roots = connected_components(links.union(more))

    grouped = (classes.select("k1", "k2", "id", "node").join(roots, classes["node"] == roots["u"], "left")
               .select("k1", "k2", "id", F.coalesce("v", "node").alias("root")))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")
    first = grouped.groupBy("root").agg(F.min(order).alias("first"))
    named, named_path = materialize(
        grouped.join(first, "root").select("k1", "k2", F.col("first.id").alias("class_id"),
                                           ((F.col("k1") == F.col("first.k1")) & (F.col("k2") == F.col("first.k2")))
                                           .alias("chosen")), "near-named")
    drop_table(spark, classes_path, buckets_path, held_path, pairs_path, texts_path, labelled_path, mixed_path,
               members_path, sets_path, links_path, more_path, size_path)
    return sketch.select("id", "k1", "k2"), named, [sketch_path, named_path]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(id, class_id, kept) of every row: ``class_id`` is the smallest id of
    the near-duplicate group, ``kept`` is true for the row with that id."""
    rows, named, paths = near_classes(docs, id_col, text_col, threshold)
    kept = F.col("chosen") & F.col("id").eqNullSafe(F.col("class_id"))
    result, _ = materialize(rows.join(named, ["k1", "k2"]).select("id", "class_id", kept.alias("kept")), "near-result")
    drop_table(docs.sparkSession, *paths)
    return result.withColumnRenamed("id", id_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` per near-duplicate group, with all its columns, whatever their names.
    The join key holds the id, so the copies of a hot text are spread out and end there."""
    _, named, paths = near_classes(docs, id_col, text_col, threshold)
    drop_table(docs.sparkSession, paths[0])
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, text = (f"c{names.index(c)}" for c in (id_col, text_col))
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = plain.withColumn("k1", F.xxhash64(whole)).withColumn("k2", F.xxhash64(F.lit(7), whole))
    chosen = named.where("chosen").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "class_id")
    same = ((F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & F.col(doc_id).cast("long").eqNullSafe(F.col("class_id")))
    kept = keyed.join(chosen, same, "left_semi").dropDuplicates(["k1", "k2"]).drop("k1", "k2")
    return kept.toDF(*names)
