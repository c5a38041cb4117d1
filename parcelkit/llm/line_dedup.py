"""Line deduplication: blocks of lines that an earlier document has too go.

A block is any run of neighbouring lines of at least ``min_chars`` characters
that stands, in the same order and without a gap, in any earlier document, no
matter where, in what order or how often.  What documents share is found by the
hashes of lines; a line under ``min_chars`` counts with its neighbours, as the
shortest window of lines that reaches it, and every line of a block is in such a
window that begins or ends inside the block.

Documents that share a rare window (at most ``rare`` places) are paired: each
with the earliest that has the window.  A pair's line sequences are aligned by
patience diff, then the runs that stand in another order or more than once are
matched, and the aligned blocks go from the later document.  A window in more
places would pair too many documents for what it tells; its places go without a
pair, all but those of its earliest document.  Together that is every block of
every earlier document.  Equal texts are one class first: all but the earliest
are one block.

Only line and window hashes travel, and the line hashes of the two documents of
a pair; texts are joined once with what is to be deleted.

Order is that of the ids (null last, then by text digest).  Defined cases: a
null text stays null, an empty one empty; rows with equal id and text are the
same document and are treated alike; blank lines go only inside a block; line
ends are not counted as characters; an empty table gives no rows; other
columns are carried through unchanged, whatever their names (an added column
whose name is taken gets underscores at its end until it is free).
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import drop_table, materialize

MIN_CHARS = 40
RARE = 16
WINDOW_ROWS = 100_000
_PRIME, _BASE = (1 << 107) - 1, 0x3C6EF372FE94F82BE73980C0B9
_LAST = (1 << 63) - 1


def _longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs (sorted by the first) that increases in the second."""
    tails: list[int] = []
    ends: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        back[k] = ends[at - 1] if at else -1
        tails[at:at + 1] = [j]
        ends[at:at + 1] = [k]
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def common_runs(a: list, b: list) -> Iterator[tuple[int, int, int]]:
    """Runs of equal items as (i, j, length): of each place in ``b`` the longest one that ends
    there and stands anywhere in ``a``, unless the next place makes it longer.  In linear time
    by the suffix automaton of ``a``."""
    step, link, size, end, last = [{}], [-1], [0], [-1], 0
    for i, x in enumerate(a):
        new, at = len(step), last
        step.append({})
        link.append(0)
        size.append(i + 1)
        end.append(i)
        while at >= 0 and x not in step[at]:
            step[at][x] = new
            at = link[at]
        if at >= 0:
            to = step[at][x]
            if size[to] != size[at] + 1:
                copy = len(step)
                step.append(dict(step[to]))
                link.append(link[to])
                size.append(size[at] + 1)
                end.append(end[to])
                while at >= 0 and step[at].get(x) == to:
                    step[at][x] = copy
                    at = link[at]
                link[to] = to = copy
            link[new] = to
        last = new
    at = n = 0
    before = (-1, -1, 0)
    for j, x in enumerate(b):
        while at and x not in step[at]:
            at = link[at]
            n = size[at]
        n = n + 1 if x in step[at] else 0
        at = step[at].get(x, 0)
        if before[2] and n != before[2] + 1:
            yield before
        before = (end[at] - n + 1, j - n + 1, n)
    if before[2]:
        yield before


def patience_matches(a: list, b: list, weights: list[int] | None = None, least: int = 0) -> list[tuple[int, int]]:
    """Positions (i, j) of equal items: the patience alignment, then the runs it cannot have
    because they stand in another order or more than once in a text.

    With the ``weights`` of ``b``, of these runs only what is needed that each item of a run of
    at least ``least`` is in one."""
    out = _patience(a, b)
    aligned, until = {j: i for i, j in out}, {}
    for i, j in reversed(out):
        until[j] = until[j + 1] if aligned.get(j + 1) == i + 1 else j + 1
    total = list(accumulate(weights, initial=0)) if weights is not None else None
    done = 0
    for i, j, n in common_runs(a, b):
        if until.get(j, 0) >= j + n:
            continue
        start, stop = j, j + n
        if total is not None:
            if total[stop] - total[start] < least:
                continue
            start = max(start, done)
            while total[stop] - total[start] < least:
                start -= 1
            done = stop
        out += [(i + k - j, k) for k in range(start, stop)]
    return out


def _patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned positions (i, j) of equal items: equal ends first, then the
    items unique in both as anchors, and the same between the anchors."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: j for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1 and in_a[x] == 1}
        anchors = _longest_increasing([(i, place[x]) for i, x in enumerate(a[a0:a1], a0) if x in place])
        if not anchors:
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(i + 1, i2, j + 1, j2) for (i, j), (i2, j2) in zip(edges, edges[1:], strict=False)
                 if i + 1 < i2 and j + 1 < j2]
    return sorted(out)


def heavy_blocks(matches: list[tuple[int, int]], weights: list[int], least: int) -> list[int]:
    """Positions j of the runs of matches without a gap that weigh at least ``least``."""
    out: list[int] = []
    block: list[int] = []
    before = (-2, -2)
    for i, j in [*matches, (-9, -9)]:
        if (i, j) != (before[0] + 1, before[1] + 1):
            if sum(weights[k] for k in block) >= least:
                out += block
            block = []
        block.append(j)
        before = (i, j)
    return out


def _lines(text_col: str):
    """Trimmed lines as (hash, characters); the length makes the key wider than the hash alone."""
    return F.transform(F.split(F.col(text_col), "\n"),
                       lambda x: F.struct(F.xxhash64(F.trim(x)).alias("h"), F.length(F.trim(x)).alias("n")))


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.withColumn("_k1", F.xxhash64(text_col)).withColumn("_k2", F.xxhash64(F.lit(7), text_col))


def _line_keys(lines: pa.Array, row: int) -> tuple[list, list[int]]:
    """(hash, characters) of the lines of one row, and the characters alone."""
    at, to = lines.offsets[row].as_py(), lines.offsets[row + 1].as_py()
    part = lines.values.slice(at, to - at)
    sizes = part.field("n").to_pylist()
    return list(zip(part.field("h").to_pylist(), sizes, strict=True)), sizes


def _aligned_blocks(pairs: DataFrame, min_chars: int) -> DataFrame:
    """(_k1, _k2, gone) from pairs with the line arrays ``early`` and ``late``."""
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for row in range(batch.num_rows):
                (a, _), (b, weights) = (_line_keys(batch.column(c), row) for c in ("early", "late"))
                gone.append(heavy_blocks(patience_matches(a, b, weights, min_chars), weights, min_chars))
            yield pa.RecordBatch.from_arrays([batch.column("_k1"), batch.column("_k2"),
                                              pa.array(gone, pa.list_(pa.int32()))], ["_k1", "_k2", "gone"])

    return pairs.mapInArrow(align, "_k1 bigint, _k2 bigint, gone array<int>")


def block_windows(sizes: list[int], least: int) -> list[tuple[int, int]]:
    """(first, last) of the shortest windows of at least ``least`` from each
    place and up to each place.  Each item of a run of at least ``least`` is in
    one of them that does not leave the run."""
    total = list(accumulate(sizes, initial=0))
    out, stop, start = set(), 0, 0
    for first in range(len(sizes)):
        stop = max(stop, first + 1)
        while stop < len(sizes) and total[stop] - total[first] < least:
            stop += 1
        if total[stop] - total[first] < least:
            break
        out.add((first, stop - 1))
    for last in range(len(sizes)):
        while start < last and total[last + 1] - total[start + 1] >= least:
            start += 1
        if total[last + 1] - total[start] >= least:
            out.add((start, last))
    return sorted(out)


def _windows(classes: DataFrame, min_chars: int) -> DataFrame:
    """(_rep, _k1, _k2, w1, w2, first, last): every window with its hash, a polynomial of the lines modulo a prime."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = [1]

        def made(batch, rows, found):
            columns = [batch.column(c).take(pa.array(rows, pa.int32())) for c in ("_rep", "_k1", "_k2")]
            columns += [pa.array([f[k] for f in found], t) for k, t in enumerate([pa.int64()] * 2 + [pa.int32()] * 2)]
            return pa.RecordBatch.from_arrays(columns, ["_rep", "_k1", "_k2", "w1", "w2", "first", "last"])

        for batch in batches:
            lines, rows, found = batch.column("lines"), [], []
            offsets = lines.offsets.to_pylist()
            for row, (at, to) in enumerate(zip(offsets, offsets[1:], strict=False)):
                part = lines.values.slice(at, to - at)
                sizes = part.field("n").to_pylist()
                ahead = [0]
                for h, n in zip(part.field("h").to_pylist(), sizes, strict=True):
                    ahead.append((ahead[-1] * _BASE + ((h & (1 << 64) - 1) << 32 | n) + 1) % _PRIME)
                for first, last in block_windows(sizes, min_chars):
                    while len(powers) <= last + 1 - first:
                        powers.append(powers[-1] * _BASE % _PRIME)
                    w = (ahead[last + 1] - ahead[first] * powers[last + 1 - first]) % _PRIME
                    rows.append(row)
                    found.append((w & (1 << 63) - 1, w >> 63, first, last))
                if len(rows) >= WINDOW_ROWS:
                    yield made(batch, rows, found)
                    rows, found = [], []
            yield made(batch, rows, found)

    return classes.select("_rep", "_k1", "_k2", "lines").mapInArrow(
        cut, "_rep bigint, _k1 bigint, _k2 bigint, w1 bigint, w2 bigint, first int, last int")


def _covered(spans: DataFrame) -> DataFrame:
    """(_k1, _k2, gone) from the spans (first, last) of each document."""
    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for found in batch.column("spans").to_pylist():
                places, done = [], 0
                for x in sorted(found, key=lambda x: x["first"]):
                    places += range(max(done, x["first"]), x["last"] + 1)
                    done = max(done, x["last"] + 1)
                gone.append(places)
            yield pa.RecordBatch.from_arrays([batch.column("_k1"), batch.column("_k2"),
                                              pa.array(gone, pa.list_(pa.int32()))], ["_k1", "_k2", "gone"])

    return (spans.groupBy("_k1", "_k2").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
            .mapInArrow(union, "_k1 bigint, _k2 bigint, gone array<int>"))


def _repeats(classes: DataFrame, min_chars: int, rare: int) -> tuple[DataFrame, list[str]]:
    """(_k1, _k2, gone): by aligned pairs through rare windows and by the places of common ones; and the folders that
    the frame is read from."""
    windows, windows_path = materialize(_windows(classes, min_chars), "line-windows")
    holder = F.struct(F.col("_rep").alias("rep"), F.col("_k1").alias("k1"), F.col("_k2").alias("k2"))
    # Written before it is joined, as AQE cannot split a very common window in the stage of this aggregate.
    shared, shared_path = materialize(
        windows.groupBy("w1", "w2").agg(F.min(holder).alias("home"), F.max(holder).alias("_latest"), F.count(F.lit(1)).alias("places"))
        .where("home <> _latest").select("w1", "w2", "home.k1", "home.k2", "places"), "line-shared")
    later, later_path = materialize(windows.join(shared, ["w1", "w2"]).where("_k1 <> k1 OR _k2 <> k2").select(
        "_k1", "_k2", "first", "last", "k1", "k2", (F.col("places") <= rare).alias("rare")), "line-later")
    arrays = classes.select("_k1", "_k2", "lines")
    pairs = later.where("rare").select("_k1", "_k2", "k1", "k2").distinct()
    paired = (pairs.join(arrays.withColumnRenamed("lines", "late"), ["_k1", "_k2"])
              .join(arrays.select(F.col("_k1").alias("k1"), F.col("_k2").alias("k2"), F.col("lines").alias("early")),
                    ["k1", "k2"]))
    common = _covered(later.where("NOT rare").select("_k1", "_k2", "first", "last"))
    found = (_aligned_blocks(paired, min_chars).union(common).where(F.size("gone") > 0).groupBy("_k1", "_k2")
             .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone")))
    return found, [windows_path, shared_path, later_path]


def find_repeats(docs: DataFrame, id_col: str, text_col: str, min_chars: int, rare: int = RARE) -> DataFrame:
    """(_k1, _k2, _rep, _copies, _gone, _chars) of every class of equal texts
    with something to delete: numbers of the lines, ascending, that go from its
    earliest document, which is ``_rep``; later documents of the class go whole."""
    spark = docs.sparkSession
    sketch = (_keyed(docs.where(F.col(text_col).isNotNull()), text_col)
              .select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("_rep"), "_k1", "_k2",
                      _lines(text_col).alias("lines")))
    classes, classes_path = materialize(
        sketch.groupBy("_k1", "_k2").agg(F.min("_rep").alias("_rep"), F.count(F.lit(1)).alias("_copies"),
                                         F.first("lines").alias("lines")), "line-classes")
    found, paths = _repeats(classes, min_chars, rare)
    gone = found.withColumnRenamed("gone", "_gone")
    chars = F.aggregate("lines", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    plan, _ = materialize(
        classes.select("_k1", "_k2", "_rep", "_copies", chars.alias("_chars")).join(gone, ["_k1", "_k2"], "left")
        .where("_copies > 1 OR _gone IS NOT NULL"), "line-plan")
    drop_table(spark, classes_path, *paths)
    return plan


def _free(name: str, taken: list[str]) -> str:
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                rare: int = RARE) -> DataFrame:
    """``docs`` with the repeated blocks deleted from ``text_col``, and
    ``removed_lines`` and ``removed_chars`` (0 where nothing went)."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, text = (f"c{names.index(c)}" for c in (id_col, text_col))
    plan = find_repeats(plain, doc_id, text, min_chars, rare)
    joined = _keyed(plain, text).join(plan, ["_k1", "_k2"], "left")
    cut = F.split(F.col(text), "\n")
    copy = (F.col("_copies") > 1) & (F.col("_chars") >= min_chars) & (
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)) != F.col("_rep"))
    # What stands between neighbouring deleted lines stays: linear in the lines.
    bounds = F.concat(F.array(F.lit(-1)), F.col("_gone"), F.array(F.size("_cut")))
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("_gone")), lambda i: F.slice(
        F.col("_cut"), F.get("_bounds", i) + 2, F.get("_bounds", i + 1) - F.get("_bounds", i) - 1)))
    left = F.when(copy, F.lit("")).when(F.col("_gone").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(text))
    removed = (F.when(copy, F.size("_cut")).when(F.col("_gone").isNotNull(), F.size("_gone")).otherwise(F.lit(0)))
    out = joined.withColumn("_cut", cut).withColumn("_bounds", bounds).withColumn("_new", left)
    lost = F.coalesce(F.length(text) - F.length("_new"), F.lit(0)).cast("long")
    return out.select(*[F.col("_new" if c == text_col else f"c{i}").alias(c) for i, c in enumerate(names)],
                      removed.cast("int").alias(_free("removed_lines", names)), lost.alias(_free("removed_chars", names)))
