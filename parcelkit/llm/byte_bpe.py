"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Texts of a slice are one array of code points.  Each code point becomes one of
a few symbols (its class, and what the next ones are), each symbol is a
transition function over the states of a scanner, and functions compose
associatively: the array is cut into lanes, every lane composes its functions
in lock-step with the others, a logarithmic scan over the lanes gives each
lane's first state, and a second lock-step pass reads off where a piece
begins.  No regular expression runs.  The pieces, as slices of the UTF-8
buffer, go through a merge cache; piece and token offsets are kept, so
decoding is a concatenation of token bytes with the same offsets.

The pieces are those of the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+|
 ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` (no special tokens).

Defined cases: null and empty texts have no tokens; a piece of any length is
merged in n log n; every row is encoded by itself; other columns are carried
only if named.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.codepoints import LETTER, NUMBER, SPACE, classes
from parcelkit.llm.common import text_slices

#: Distinct pieces remembered by one Python worker, in each of two generations.
CACHE_PIECES = 150_000
#: Text bytes scanned at once.
SLICE = 4 << 20

NONE = 1 << 40

# States of the scanner: what the next code point continues.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, LEAD, IN_SPACE, ENDING_1, ENDING_2 = range(8)
# Symbols. A blank is the last white space before something visible.
(S_LETTER, S_NUMBER, S_OTHER, S_APOSTROPHE_1, S_APOSTROPHE_2, S_BLANK, S_LAST_SPACE, S_SPACE, S_TEXT_END) = range(9)


def _scanner() -> tuple[np.ndarray, np.ndarray]:
    """(next state, piece begins here) by symbol and state."""
    step = np.zeros((9, 8), np.uint8)
    begins = np.ones((9, 8), bool)
    runs = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHER,
            S_APOSTROPHE_1: IN_OTHER, S_APOSTROPHE_2: IN_OTHER}
    for symbol, run in runs.items():
        step[symbol] = run                              # a new run, unless it goes on with
        begins[symbol, [run, LEAD]] = False             # the same run or the blank before it
    # An apostrophe that opens a piece takes its one or two letters with it.
    opens = [FRESH, IN_LETTERS, IN_NUMBERS, IN_SPACE]
    step[S_APOSTROPHE_1, opens], step[S_APOSTROPHE_2, opens] = ENDING_1, ENDING_2
    step[S_LETTER, ENDING_2], step[S_LETTER, ENDING_1] = ENDING_1, FRESH
    begins[S_LETTER, [ENDING_1, ENDING_2]] = False
    # White space: all but the last before something visible is one piece, the last begins a piece.
    step[S_BLANK], step[S_LAST_SPACE], step[S_SPACE] = LEAD, FRESH, IN_SPACE
    begins[S_SPACE, IN_SPACE] = False
    step[S_TEXT_END] = FRESH
    return step, begins


STEP, BEGINS = _scanner()


def symbols_of(points: np.ndarray) -> np.ndarray:
    """Symbol of every code point; -1 marks the end of a text."""
    end = points < 0
    kind = classes()[np.where(end, 0x20, points)]
    nxt = np.append(points[1:], -1)
    blank_next = np.append(kind[1:], SPACE) == SPACE       # a text's end counts as one
    out = np.full(len(points), S_OTHER, np.uint8)
    out[kind == LETTER] = S_LETTER
    out[kind == NUMBER] = S_NUMBER
    space = kind == SPACE
    out[space] = np.where(blank_next[space], S_SPACE, np.where(points[space] == 0x20, S_BLANK, S_LAST_SPACE))
    apostrophes = np.flatnonzero(points == 0x27)
    if len(apostrophes):
        first = nxt[apostrophes]
        second = np.append(nxt[1:], -1)[apostrophes]
        out[apostrophes[np.isin(first, [ord(c) for c in "stmd"])]] = S_APOSTROPHE_1
        pair = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e")) | (
            (first == ord("l")) & (second == ord("l")))
        out[apostrophes[pair]] = S_APOSTROPHE_2
    out[end] = S_TEXT_END
    return out


def piece_starts(symbols: np.ndarray, lanes: int = 4096) -> np.ndarray:
    """True where a piece begins, by an associative scan of transition functions."""
    n = len(symbols)
    lanes = max(1, min(lanes, n // 64))
    width = -(-n // lanes)
    grid = np.full(lanes * width, S_TEXT_END, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(lanes, width).T)          # one row per step
    flat_step = STEP.ravel()
    # 1. Each lane's whole function: where every state ends up.
    whole = np.tile(np.arange(8, dtype=np.uint8), (lanes, 1))
    for row in grid:
        whole = flat_step[(row.astype(np.intp) << 3)[:, None] | whole]
    # 2. Inclusive scan over the lanes by doubling; composition is associative.
    ahead, gap = whole, 1
    while gap < lanes:
        ahead = np.concatenate([ahead[:gap], np.take_along_axis(ahead[gap:], ahead[:-gap].astype(np.intp), 1)])
        gap *= 2
    state = np.concatenate([[np.uint8(FRESH)], ahead[:-1, FRESH]])
    # 3. Replay with the known first states.
    flat_begins = BEGINS.ravel()
    starts = np.empty(grid.shape, bool)
    for i, row in enumerate(grid):
        at = (row.astype(np.intp) << 3) | state
        starts[i] = flat_begins[at]
        state = flat_step[at]
    return starts.T.ravel()[:n]


class ByteBpe:
    """Ranks of one vocabulary file and a cache of merged pieces."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        # Every way to cut a token into two tokens.
        pairs = sorted((i << 32 | j, rank) for token, rank in self.ranks.items() for k in range(1, len(token))
                       if (i := self.ranks.get(token[:k])) is not None and (j := self.ranks.get(token[k:])) is not None)
        self.pair_keys, self.pair_values = np.array(pairs, np.int64).T
        self.pair_keys, self.pair_values = self.pair_keys.copy(), self.pair_values.copy()
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self._new: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece: the pair of lowest rank is joined first, the left
        one of equal pairs; a heap and a linked list, so n log n."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        after, before, stop = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if stop[i] <= i or j >= n or stop[j] != end or stop[i] != j:
                continue   # one of the two has changed since
            k = stop[i] = end
            stop[j] = -1
            after[i] = k
            if k < n:
                before[k] = i
                if (rank := ranks.get(piece[i:stop[k]])) is not None:
                    heapq.heappush(heap, (rank, i, stop[k]))
            h = before[i]
            if h >= 0 and (rank := ranks.get(piece[h:end])) is not None:
                heapq.heappush(heap, (rank, h, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:stop[i]]])
            i = stop[i]
        return tuple(out)

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two neighbouring tokens form, or NONE."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_values[at], NONE)

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian uint32 bytes) of many short pieces at once: every
        round joins the leftmost pair of lowest rank in each of them."""
        out: list[bytes] = [b""] * len(pieces)
        owner = np.arange(len(pieces))                       # piece of each row of starts
        tokens = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        starts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])[:-1]]).astype(np.int64)
        ranks = np.full(len(tokens), NONE, np.int64)
        ranks[:-1] = self._pair_ranks(tokens[:-1], tokens[1:])
        ranks[starts[1:] - 1] = NONE
        while len(owner):
            size = np.diff(np.append(starts, len(tokens)))
            low = np.minimum.reduceat(ranks, starts)
            done = low == NONE
            if done.any():
                raw = tokens.astype("<u4").tobytes()
                for i, a, n in zip(owner[done].tolist(), starts[done].tolist(), size[done].tolist(), strict=True):
                    out[i] = raw[4 * a:4 * (a + n)]
                keep = np.repeat(~done, size)
                tokens, ranks, owner, size, low = tokens[keep], ranks[keep], owner[~done], size[~done], low[~done]
                if not len(owner):
                    break
                starts = np.cumsum(size) - size
            hits = np.flatnonzero(ranks == np.repeat(low, size))
            row = np.searchsorted(starts, hits, side="right") - 1
            at = hits[np.flatnonzero(np.diff(row, prepend=-1))]   # leftmost of each piece
            tokens[at] = low
            gone = at + 1
            ends = gone == starts + size - 1
            keep = np.ones(len(tokens), bool)
            keep[gone] = False
            tokens, ranks = tokens[keep], ranks[keep]
            starts = starts - np.arange(len(starts))
            at = at - np.arange(len(at))
            ranks[at] = NONE
            inner = at[~ends]
            ranks[inner] = self._pair_ranks(tokens[inner], tokens[inner + 1])
            back = at[at > starts]
            ranks[back - 1] = self._pair_ranks(tokens[back - 1], tokens[back])
        return out

    def _coded(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian uint32 bytes; new pieces are merged once."""
        found = list(map(self._new.get, pieces))
        if None in found:
            unseen = list({p for p, ids in zip(pieces, found, strict=True) if ids is None})
            new = {p: ids for p in unseen if (ids := self._old.get(p)) is not None}
            unseen = [p for p in unseen if p not in new]
            short = [p for p in unseen if len(p) <= 64]
            new.update(zip(short, self.merge_many(short) if short else [], strict=True))
            new.update((p, np.array(self.merge(p), "<u4").tobytes()) for p in unseen if len(p) > 64)
            found = [new[p] if ids is None else ids for p, ids in zip(pieces, found, strict=True)]
            if len(self._new) + len(new) > CACHE_PIECES:
                self._old, self._new = self._new, {}
            self._new.update((p, ids) for p, ids in new.items() if len(p) <= 64)
        return found

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of each text."""
        return [ids for ids, _ in self.encode_with_offsets(texts)]

    def encode_with_offsets(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(token ids, byte offset of each token in the text's UTF-8) of each text."""
        texts = [t or "" for t in texts]
        lengths = np.array([len(t) for t in texts], np.int64)
        joined = np.frombuffer("".join(texts).encode("utf-32-le"), np.int32)
        if not len(joined):
            return [(np.zeros(0, np.uint32), np.zeros(0, np.int64))] * len(texts)
        # One array with an end mark after each text.
        ends = np.cumsum(lengths + 1) - 1
        points = np.full(len(joined) + len(texts), -1, np.int32)
        inside = np.ones(len(points), bool)
        inside[ends] = False
        points[inside] = joined
        starts = np.flatnonzero(piece_starts(symbols_of(points)) & inside)
        width = np.where(inside, 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000), 0)
        byte_at = np.concatenate([[0], np.cumsum(width)])
        raw = "".join(texts).encode("utf-8")
        cuts = byte_at[np.append(starts, len(points))]
        bounds = cuts.tolist()
        coded = self._coded([raw[a:b] for a, b in zip(bounds, bounds[1:], strict=False)])
        counts = np.array(list(map(len, coded)), np.int64) >> 2
        ids = np.frombuffer(b"".join(coded), "<u4")
        token_at = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        tokens_before = np.concatenate([[0], np.cumsum(counts)])
        first_piece = np.searchsorted(starts, np.concatenate([[0], ends[:-1] + 1]))
        cut = np.append(tokens_before[first_piece], len(ids))
        text_at = byte_at[np.concatenate([[0], ends[:-1] + 1])]
        return [(ids[a:b], token_at[a:b] - o) for a, b, o in zip(cut[:-1], cut[1:], text_at, strict=True)]

    def decode(self, ids: np.ndarray) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids.tolist()])


@lru_cache(maxsize=4)
def codec(path: str) -> ByteBpe:
    """One codec per worker and vocabulary file; its cache outlives a task."""
    return ByteBpe(path)


def encode_texts(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
                 keep_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, and the token
    ids (array<int>) with ``keep_ids``; one narrow pass without a shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocab_path)
        for part in text_slices(batches, "text", SLICE):
            coded = bpe.encode(part.column("text").to_pylist())
            columns = [part.column("id"), pa.array([len(i) for i in coded], pa.int64()),
                       pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in coded]),
                       pa.array([hashlib.sha256(bpe.decode(i)).hexdigest() for i in coded])]
            if keep_ids:
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in coded])]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(coded).astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (
        ", ids array<int>" if keep_ids else "")
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(encode, schema)
    return out.withColumnRenamed("id", id_col)


def decode_ids(frame: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from token ids; bytes that are not UTF-8 become U+FFFD; null ids give null."""
    id_type = frame.schema[id_col].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocab_path)
        for batch in batches:
            texts = [None if i is None else bpe.decode(np.array(i, np.int64)).decode("utf-8", "replace")
                     for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    out = frame.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(
        decode, f"id {id_type}, text string")
    return out.withColumnRenamed("id", id_col)
