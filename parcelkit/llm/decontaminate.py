"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may be hit with up to k = floor(m * rate) edits.
Cut into k + 1 pieces, an occurrence with at most k edits leaves one piece
whole, so every occurrence holds an exact piece hit.  All pieces form one
Aho-Corasick automaton that runs over each whole text.  Pieces are the leaves
of a binary tree, and the same principle gives a path from an unharmed leaf to
the root on which a node of l pieces has at most l - 1 edits; so a hit climbs
from node to node as long as Myers' bit-parallel distance finds the node's
text within that budget, and chance hits end at the first node.  At the root
Myers' distance decides whether the window holds the item with at most k edits.

Items and texts are compared lower-cased with white space as one space.  The
benchmark is the stated query set: its items go in blocks of at most
``block_chars`` characters, one pass over the texts per block, so neither the
driver nor a task ever holds more than a block of it.

Defined cases: null or blank items match nothing; equal items are matched
each by its own id; an item without budget (shorter than 1 / rate characters)
must occur exactly and at word borders; null and empty texts hold nothing;
repeated rows are matched each by itself; texts of any length are searched
whole; empty tables give no hits; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import text_slices

RATE = 0.1
BLOCK_CHARS = 4 << 20
_WHITE = re.compile(r"\s+")


def normalize(text: str | None) -> str:
    return _WHITE.sub(" ", text.lower()).strip() if text else ""


def budget(item: str, rate: float = RATE) -> int:
    return int(len(item) * rate)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(place, piece): the item cut into k + 1 nearly equal parts."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str, masks: dict[str, int], k: int) -> tuple[int, int] | None:
    """(fewest edits, first end) of an occurrence of ``pattern`` in ``text``
    with at most k edits, by bit-parallel columns (one integer holds a
    column's differences, whatever the pattern's length)."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, None
    for at, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | minus
        d = ((((eq & plus) + plus) ^ plus) | eq) & full
        up = minus | (full & ~(d | plus))
        down = plus & d
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1) & full          # a match may begin anywhere, so nothing enters below
        down = (down << 1) & full
        plus = down | (full & ~(x | up))
        minus = up & x
        if score <= k and (best is None or score < best[0]):
            best = (score, at + 1)
            if score == 0:
                break
    return best


def masks_of(pattern: str) -> dict[str, int]:
    """Bit i of a character's mask: the pattern has it at place i."""
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def ancestors(leaf: int, leaves: int) -> list[tuple[int, int]]:
    """Ranges of leaves of the nodes above a leaf, from its parent to below the root."""
    out, low, high = [], 0, leaves
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if leaf < middle else (middle, high)
        out.append((low, high))
    return out[-2::-1]


class Matcher:
    """The items of one block, ready to be searched."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick
        self.items, places = [], {}
        for item_id, item in items:
            k, n = budget(item, rate), len(self.items)
            cut = pieces(item, k)
            self.items.append((item_id, item, k, [at for at, _ in cut] + [len(item)]))
            for leaf, (at, piece) in enumerate(cut):
                places.setdefault(piece, []).append((n, leaf, at, len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, found)
        if places:
            self.automaton.make_automaton()
        self.empty = not places
        self._nodes: dict[tuple, tuple[str, dict[str, int]]] = {}

    def node(self, n: int, low: int, high: int) -> tuple[str, dict[str, int]]:
        found = self._nodes.get((n, low, high))
        if found is None:
            if len(self._nodes) > 20_000:
                self._nodes.clear()
            cuts = self.items[n][3]
            pattern = self.items[n][1][cuts[low]:cuts[high]]
            found = self._nodes[n, low, high] = (pattern, masks_of(pattern))
        return found

    def climbs(self, text: str, n: int, leaf: int, start: int) -> bool:
        """True if every node above the leaf, below the root, is within its budget;
        ``start``: where the item would begin without edits."""
        cuts = self.items[n][3]
        for low, high in ancestors(leaf, len(cuts) - 1):
            pattern, masks = self.node(n, low, high)
            edits = high - low - 1
            at = start + cuts[low]
            if myers(pattern, text[max(0, at - edits):at + len(pattern) + edits], masks, edits) is None:
                return False
        return True

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Merged windows [start, stop) of the text per item that may hold it."""
        spans: dict[int, list[list[int]]] = {}
        for end, found in self.automaton.iter(text):
            for n, leaf, at, size in found:
                start = end + 1 - size - at
                if not self.climbs(text, n, leaf, start):
                    continue
                _, item, k, _ = self.items[n]
                spans.setdefault(n, []).append([max(0, start - k), min(len(text), start + len(item) + k)])
        for n, mine in spans.items():
            mine.sort()
            merged = mine[:1]
            for low, high in mine[1:]:
                if low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            spans[n] = merged
        return spans

    def search(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item id, edits, start of the window, end of the best occurrence, budget) of each item found."""
        if self.empty or not text:
            return []
        out = []
        for n, spans in self.windows(text).items():
            item_id, item, k, cuts = self.items[n]
            masks = self.node(n, 0, len(cuts) - 1)[1]
            best = None
            for low, high in spans:
                if k == 0:
                    found = next(((0, m.end()) for m in re.finditer(
                        rf"(?<!\w){re.escape(item)}(?!\w)", text[max(0, low - 1):high + 1])), None)
                    low = max(0, low - 1)
                else:
                    found = myers(item, text[low:high], masks, k)
                if found and (best is None or found[0] < best[0]):
                    best = (found[0], low, low + found[1])
            if best:
                out.append((item_id, *best, k))
        return out


#: Matchers that this worker built last.
_kept: dict[str, Matcher] = {}


def _key(block: list[tuple[int, str]], rate: float) -> str:
    return hashlib.sha256(repr((rate, block)).encode()).hexdigest()


def kept_matcher(key: str, shared, rate: float) -> Matcher:
    """The matcher of a block, built once per worker and not once per task."""
    if key not in _kept:
        while len(_kept) > 1:
            _kept.pop(next(iter(_kept)))
        _kept[key] = Matcher(shared.value, rate)
    return _kept[key]


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Normalised items in blocks of bounded size, fetched one partition at a time."""
    block, held = [], 0
    for row in benchmark.select(id_col, text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        item = normalize(row[1])
        if not item:
            continue
        if block and held + len(item) > block_chars:
            yield block
            block, held = [], 0
        block.append((row[0], item))
        held += len(item)
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", rate: float = RATE,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item_id, edits, budget, found_end) for every document that holds an
    item, one row per row of ``docs`` and row of ``benchmark`` (rows of one item id
    with different texts are searched each with its own budget); ``found_end``: code
    points of the normalised text up to the end of the best occurrence."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, item_id bigint, edits int, budget int, found_end bigint"
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = spark.createDataFrame([], schema)
    for block in item_blocks(benchmark, item_id_col, item_text_col, block_chars):
        shared = spark.sparkContext.broadcast(block)
        key = _key(block, rate)

        def match(batches: Iterator[pa.RecordBatch], shared=shared, key=key) -> Iterator[pa.RecordBatch]:
            matcher = kept_matcher(key, shared, rate)
            for part in text_slices(batches, "text"):
                at, hits = [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    for hit in matcher.search(normalize(text)):
                        at.append(i)
                        hits.append(hit)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(at, pa.int64())), pa.array([h[0] for h in hits], pa.int64()),
                     pa.array([h[1] for h in hits], pa.int32()), pa.array([h[4] for h in hits], pa.int32()),
                     pa.array([h[3] for h in hits], pa.int64())],
                    ["id", "item_id", "edits", "budget", "found_end"])

        out = out.union(source.mapInArrow(match, schema))
    return out.withColumnRenamed("id", id_col)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                         item_text_col: str = "text", rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with all their columns;
    a filter inside the tasks, without a join."""
    spark, out = docs.sparkSession, docs
    for block in item_blocks(benchmark, item_id_col, item_text_col, block_chars):
        shared, key = spark.sparkContext.broadcast(block), _key(block, rate)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared, key=key) -> Iterator[pa.RecordBatch]:
            matcher = kept_matcher(key, shared, rate)
            for part in text_slices(batches, text_col):
                texts = part.column(text_col).to_pylist()
                yield part.filter(pa.array([not matcher.search(normalize(t)) for t in texts], pa.bool_()))

        out = out.mapInArrow(clean, docs.schema)
    return out
