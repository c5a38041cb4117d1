"""Token counts at every prefix by dynamic programming.

A byte-pair encoding is decided by its last token: the encoding of a prefix
ends in the one token t for which the encoding of what stands before t ends in
a token that does not merge with t.  ``PrefixCounter`` fills that table from
left to right for each distinct word, so the exact number of tokens is known
at *every* prefix of a text, and truncation ("how much of it fits in 2048
tokens") or budget questions need no second encoding.

Word boundaries and normalisation follow the tokenizer file (lower case, NFC,
white space dropped, byte-level symbols, word-end suffix).  Prefixes are those
of the normalised text, counted in code points.

Defined cases: null and empty texts have no tokens; words of any length are
handled in linear space; repeated rows are counted again, each by itself;
other columns are carried only if named.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.codepoints import LETTER, NUMBER, SPACE, charset
from parcelkit.llm.common import text_slices

#: Distinct pieces between spaces remembered by one Python worker, in each of two generations.
CACHE_PIECES = 250_000
#: Text bytes whose new words are looked at together.
SLICE = 2 << 20

_SPACE = r"[\t\n\x0b\x0c\r][\t\n\x0b\x0c\r ]*| [\t\n\x0b\x0c\r ]+"
_WORD = "[{L}]+|'(?:[stmd]|re|ve|ll)|[{N}]|[^{S}{L}{N}]+"   # letters, ending, one number, or the rest without spaces
_TWO_LETTER_ENDINGS = frozenset({"'re", "'ve", "'ll"})


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Recent:
    """A dictionary of two generations: what was not asked for lately goes when the newer one is full."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.new[key] = found
        return found

    def update(self, items: dict) -> None:
        if len(self.new) + len(items) > self.size:
            self.old, self.new = self.new, {}
        self.new.update(items)


class PrefixCounter:
    """Exact token counts of one vocabulary file (BPE with word ends)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.ids = vocab
        # Merge number that forms a token (-1: a base symbol) and the two tokens it joins.
        self._whole: dict[int, bool] = {}
        self.formed = {i: -1 for i in vocab.values()}
        self.left, self.right, self.merge_no = {}, {}, {}
        for n, m in enumerate(model["merges"]):
            x, y = m if isinstance(m, list) else m.split(" ")
            i, j, k = vocab[x], vocab[y], vocab[x + y]
            self.formed[k], self.left[k], self.right[k], self.merge_no[i, j] = n, i, j, n
        # Tokens by their symbols from the last to the first: inside a word, and at its end.
        self.inner: dict = {}
        self.final: dict = {}
        for token, i in vocab.items():
            if not self.encodes_itself(i):
                continue
            ends_word = token.endswith(self.suffix) and token != self.suffix
            node = self.final if ends_word else self.inner
            for c in reversed(token.removesuffix(self.suffix) if ends_word else token):
                node = node.setdefault(c, {})
            node[""] = i
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self._split = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")").split
        words = re.compile(_WORD.format(L=charset(LETTER), N=charset(NUMBER), S=charset(SPACE)))
        self._find, self._iterate = words.findall, words.finditer
        self._space = re.compile(_SPACE)
        self._normalizer = Tokenizer.from_file(path).normalizer
        self._symbols = _byte_symbols()
        self._apart: dict[tuple[int, int], bool] = {}
        self._chunks, self._words = Recent(CACHE_PIECES), Recent(CACHE_PIECES)

    # -- dynamic programme over one word --------------------------------

    def encodes_itself(self, token: int) -> bool:
        known = self._whole.get(token)
        if known is None:
            known = self.formed[token] < 0 or (
                self.encodes_itself(self.left[token]) and self.encodes_itself(self.right[token])
                and self._keeps(self.left[token], self.right[token], self.formed[token]))
            self._whole[token] = known
        return known

    def _keeps(self, x: int, y: int, limit: float) -> bool:
        """No merge earlier than ``limit`` crosses the border of x and y.  The
        border's neighbours are followed back in time: the piece formed last is
        split again, and a crossing merge counts if its number is below that of
        the merge that used up one of the two (at equal numbers the left place
        goes first)."""
        while True:
            if self.merge_no.get((x, y), limit) < limit:
                return False
            fx, fy = self.formed[x], self.formed[y]
            if fx < 0 and fy < 0:
                return True
            if fx > fy:
                limit, x = fx, self.right[x]
            else:
                limit, y = fy + 1, self.left[y]

    def stays_apart(self, x: int, y: int) -> bool:
        """True if the tokens x and y, side by side, are the encoding of their joint text."""
        known = self._apart.get((x, y))
        if known is None:
            if len(self._apart) > 2 * CACHE_PIECES:
                self._apart.clear()
            known = self._apart[x, y] = self._keeps(x, y, float("inf"))
        return known

    def _last(self, node: dict, symbols: str, end: int, last: list[int]) -> tuple[int, int]:
        """(start, token) of the last token of the encoding of the first ``end`` symbols."""
        found, start = [], end
        while start and (node := node.get(symbols[start - 1])) is not None:
            start -= 1
            token = node.get("")
            if token is not None:
                found.append((start, token))
        apart = self._apart.get
        for start, token in reversed(found):
            if start == 0 or apart((last[start], token)) or self.stays_apart(last[start], token):
                return start, token
        raise ValueError(f"no token of the vocabulary ends {symbols[max(0, end - 20):end]!r}")

    def _extend(self, symbols: str, last: list[int], count: list[int]) -> None:
        """Fill the table of an open word (no word end yet) from its known prefix on:
        last token and token count of every prefix."""
        for end in range(len(last), len(symbols) + 1):
            start, token = self._last(self.inner, symbols, end, last)
            last.append(token)
            count.append(count[start] + 1)

    def _closed(self, symbols: str, end: int, last: list[int], count: list[int]) -> int:
        """Tokens of the prefix of ``end`` symbols when the word ends there."""
        return count[self._last(self.final, symbols, end, last)[0]] + 1

    def _shown(self, word: str) -> str:
        if word.isascii() and word.isprintable():
            return word
        return "".join([self._symbols[b] for b in word.encode("utf-8")])

    def learn(self, words: set[str]) -> dict[str, int]:
        """Tokens of each word; in sorted order, words share the table of their common prefix."""
        totals, last, count, before = {}, [-1], [0], ""
        for symbols, word in sorted((self._shown(w), w) for w in words):
            same = 0
            for x, y in zip(before, symbols):   # noqa: B905
                if x != y:
                    break
                same += 1
            del last[same + 1:], count[same + 1:]
            self._extend(symbols, last, count)
            totals[word] = self._closed(symbols, len(symbols), last, count)
            before = symbols
        return totals

    def word_counts(self, word: str) -> np.ndarray:
        """Token counts after each code point of ``word``, each prefix taken as a word of its own."""
        raw = word.encode("utf-8")
        symbols = self._shown(word)
        last, count = [-1], [0]
        self._extend(symbols, last, count)
        ends = [i + 1 for i in range(len(raw)) if i + 1 == len(raw) or raw[i + 1] & 0xC0 != 0x80]
        closed = [self._closed(symbols, end, last, count) for end in ends]
        if word in _TWO_LETTER_ENDINGS:   # a shorter prefix is two words: the apostrophe and a letter
            closed[1] = 1 + self.learn({word[1]})[word[1]]
        return np.array(closed, np.int64)

    # -- whole texts ------------------------------------------------------

    def normalize(self, text: str) -> str:
        if text.isascii():
            return self._space.sub(" ", text).lower()
        return self._normalizer.normalize_str(text)

    def parts(self, text: str) -> list[tuple[str, str]]:
        """(normalised segment, special string that follows it or "")."""
        cut = self._split(text) if any(s in text for s in self.specials) else [text]
        return [(self.normalize(cut[i]), cut[i + 1] if i + 1 < len(cut) else "") for i in range(0, len(cut), 2)]

    def _learn_pieces(self, pieces: set[str]) -> None:
        """Remember the tokens of pieces between spaces, each of one or more words."""
        words = {p: self._find(p) for p in pieces}
        known = {w: n for ws in words.values() for w in ws if (n := self._words.get(w)) is not None}
        new = self.learn({w for ws in words.values() for w in ws if w not in known})
        known |= new
        self._words.update(new)
        self._chunks.update({p: sum([known[w] for w in ws]) for p, ws in words.items()})

    def totals(self, segments: list[str]) -> list[list[int]]:
        """Tokens of each piece between the spaces of normalised segments."""
        cut = [s.split(" ") for s in segments]
        get = self._chunks.get
        out = [[get(c) for c in pieces] for pieces in cut]
        new = {c for pieces, counts in zip(cut, out, strict=True) if None in counts
               for c, n in zip(pieces, counts, strict=True) if n is None}
        if new:
            self._learn_pieces(new)
            out = [[get(c) for c in p] if None in n else n for p, n in zip(cut, out, strict=True)]
        return out

    def measure(self, texts: list[str | None], limit: int) -> list[tuple[int, int]]:
        """(tokens, code points of the normalised text that fit in ``limit`` tokens) of each text:
        the last entry of its prefix table, and the last entry of at most ``limit``."""
        parts = [self.parts(t) if t else [] for t in texts]
        pieces = iter(self.totals([segment for p in parts for segment, _ in p]))
        out = []
        for p in parts:
            total, fit, open_ = 0, 0, True
            for segment, special in p:
                counts = next(pieces)
                after = sum(counts) + bool(special)
                if open_ and total + after <= limit:
                    fit += len(segment) + len(special)
                elif open_:
                    fit, open_ = fit + self._fits(segment, special, counts, limit - total), False
                total += after
            out.append((total, fit))
        return out

    def _fits(self, segment: str, special: str, counts: list[int], limit: int) -> int:
        """Code points of the longest prefix of at most ``limit`` tokens; fills
        the prefix table of one piece only, or of the one with a special string."""
        after = np.cumsum([0, *counts])
        if after[-1] <= limit:   # only the complete special string is too much
            within = np.flatnonzero(self._plain(segment + special)[:-1] <= limit)
            return int(within[-1]) + 1 if len(within) else 0
        k = int(np.searchsorted(after, limit, side="right")) - 1
        chunks = segment.split(" ")
        within = np.flatnonzero(self._plain(chunks[k]) + after[k] <= limit)
        return sum(map(len, chunks[:k])) + k + (int(within[-1]) + 1 if len(within) else 0)

    def _plain(self, segment: str) -> np.ndarray:
        """Counts at each code point of a normalised text without special strings."""
        out, base, at = np.zeros(len(segment), np.int64), 0, 0
        for m in self._iterate(segment):
            out[at:m.start()] = base
            out[m.start():m.end()] = base + self.word_counts(m.group())
            base, at = int(out[m.end() - 1]), m.end()
        out[at:] = base
        return out

    def prefix_counts(self, text: str | None) -> np.ndarray:
        """Token count of each prefix of the normalised text; entry k is the
        prefix of k + 1 code points."""
        tables, base = [np.zeros(0, np.int64)], 0
        for segment, special in self.parts(text or ""):
            table = self._plain(segment + special)
            if special:   # until it is complete, a special string is ordinary text
                table[-1] = (table[len(segment) - 1] if segment else 0) + 1
            tables.append(table + base)
            base += int(table[-1]) if len(table) else 0
        return np.concatenate(tables)


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    """One counter per worker and vocabulary file; its caches outlive a task."""
    return PrefixCounter(path)


def token_counts(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, fit_chars) of every row; one narrow
    pass without a shuffle.  ``fit_chars``: code points of the normalised text
    that fit in ``limit`` tokens."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counter(vocab_path)
        for part in text_slices(batches, "text", SLICE):
            texts = part.column("text").to_pylist()
            totals, fit = zip(*table.measure(texts, limit), strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                 pa.array(totals, pa.int64()), pa.array([n > limit for n in totals], pa.bool_()),
                 pa.array(fit, pa.int64())],
                ["id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        count, f"id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean, fit_chars bigint")
    return out.withColumnRenamed("id", id_col)
