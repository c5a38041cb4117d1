"""Supervised subword embeddings for quality scores.

Every word and every character n-gram of it (with word borders) is hashed to a
learned vector, and so is a mark for every word that repeats the one before; the mean vector of a text goes through a softmax of two
classes.  Training is numpy stochastic gradient descent over bags of feature
counts, which tasks build from whole texts; the driver holds the bags of at
most ``max_docs`` labelled texts (the documented bound of the sample, chosen
by a hash of the id).  Scoring needs only how much each bucket moves the
logit, one number per bucket, which is broadcast (4 bytes x ``BUCKETS``).

Defined cases: a text without words (null, empty, blank) has the mean vector
0, so its score is the bias alone; without any training row every score is
0.5; null ids are never held out and never train; labels that are null are not
used; rows with the same id and text score the same; texts and words of any
length are used whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import text_digest, text_slices

BUCKETS = 1 << 17
DIM = 8
GRAMS = (3, 4, 5)
MAX_DOCS = 3000
EPOCHS, RATE = 4, 0.5
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
SEED = 11
#: Stands for a word that repeats the one before it.
AGAIN = "\x04"

_U = np.uint64
#: Code points of new words looked at together, and words remembered by one worker.
_CHUNK, _REMEMBERED = 1 << 18, 300_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every feature, index of its word): the word itself and its
    n-grams, from one array of code points with a border mark on both sides."""
    points = np.frombuffer("".join([f"\x02{w}\x03" for w in words]).encode("utf-32-le"), np.uint32).astype(_U)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    starts = np.cumsum(lengths) - lengths
    with np.errstate(over="ignore"):
        place = np.arange(len(points)) - np.repeat(starts, lengths)
        power = np.cumprod(np.concatenate([[_U(1)], np.full(int(lengths.max()) - 1, _U(0x100000001B3))]))
        whole = np.add.reduceat(_mix(points + _U(1)) * power[place], starts)
        buckets, owners = [_mix(whole) % _U(BUCKETS)], [np.arange(len(words))]
        for size in GRAMS:
            n = len(points) - size + 1
            if n <= 0:
                continue
            inside = owner[:n] == owner[size - 1:]
            code = np.full(n, _U(size))
            for k in range(size):
                code = (code ^ points[k:k + n]) * _U(0x9E3779B97F4A7C15)
                code ^= code >> _U(29)
            buckets.append(_mix(code[inside]) % _U(BUCKETS))
            owners.append(owner[:n][inside])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def tokens(text: str | None) -> list[str]:
    """Words of a text, then one mark for each word equal to the word before it."""
    words = (text or "").split()
    return words + [AGAIN] * sum(map(eq, words, words[1:]))


def chunks(words: list[str]) -> Iterator[list[str]]:
    """Words in groups of bounded total length (a longer word is a group of its own)."""
    group, held = [], 0
    for w in words:
        if group and held + len(w) > _CHUNK:
            yield group
            group, held = [], 0
        group.append(w)
        held += len(w)
    if group:
        yield group


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of a whole text."""
    words: dict[str, int] = {}
    for w in tokens(text):
        words[w] = words.get(w, 0) + 1
    total = np.zeros(BUCKETS, np.int64)
    for group in chunks(list(words)):
        buckets, owner = word_features(group)
        total += np.bincount(buckets, np.array([words[w] for w in group])[owner], BUCKETS).astype(np.int64)
    found = np.flatnonzero(total)
    return found.astype(np.int32), total[found].astype(np.int32)


@dataclass
class Model:
    """Logit of class 1 against class 0: bias + mean of ``push`` over a text's features."""

    push: np.ndarray
    bias: float

    def probability(self, means: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(means + self.bias, -60, 60)))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE,
          seed: int = SEED) -> Model:
    """Stochastic gradient descent, one text a step, rate falling to zero.

    The gradient of a mean is shared out over a text's features; steps of the
    vectors are scaled back by the share of an average feature, so long texts
    learn as fast as short ones."""
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((BUCKETS, DIM)) - 0.5) / DIM).astype(np.float32)
    weights, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    steps, step = max(1, epochs * len(bags)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            buckets, counts = bags[i]
            lr = rate * (1 - step / steps)
            step += 1
            share = (counts / max(1, counts.sum())).astype(np.float32)
            mean = share @ vectors[buckets]
            logits = weights @ mean + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[int(labels[i])] -= 1
            back = weights.T @ error
            weights -= lr * np.outer(error, mean)
            bias -= 0.1 * lr * error
            if len(buckets):
                vectors[buckets] -= lr * np.minimum(share * len(buckets), 10)[:, None] * back * 0.1
    return Model((vectors @ (weights[1] - weights[0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(id_col: str):
    """True where crc32 of the id as text leaves ``HELD_OUT`` by ``FOLDS``."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_docs: int = MAX_DOCS) -> Model:
    """Train on at most ``max_docs`` labelled rows outside the held-out fold.

    An id with contradicting labels counts as 1; of several texts of an id the
    first by digest is learned."""
    chosen = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
              .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(max_docs))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            found = [bag(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"), pa.array([b.tobytes() for b, _ in found], pa.binary()),
                 pa.array([c.tobytes() for _, c in found], pa.binary())], ["id", "label", "buckets", "counts"])

    # The chosen labels are at most max_docs rows, which bounds the broadcast and what is collected.
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    first = F.min(F.struct(text_digest().alias("digest"), "label", "text")).alias("first")
    rows = (sample.groupBy("id").agg(first).select("id", "first.label", "first.text")
            .mapInArrow(bags, f"id {docs.schema[id_col].dataType.simpleString()}, label int, buckets binary, counts binary")
            .collect())
    rows.sort(key=lambda r: r["id"])
    return train([(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["counts"], np.int32)) for r in rows],
                 np.array([r["label"] for r in rows], np.int64))


class Scorer:
    """Scores texts in a task; remembers what each word adds."""

    def __init__(self, model: Model):
        self.model = model
        self.words: dict[str, tuple[float, int]] = {}

    def _learn(self, words: list[str], into: dict[str, tuple[float, int]]) -> None:
        for group in chunks(words):
            buckets, owner = word_features(group)
            sums = np.bincount(owner, self.model.push[buckets].astype(np.float64), len(group))
            into.update(zip(group, zip(sums.tolist(), np.bincount(owner, minlength=len(group)).tolist(), strict=True),
                            strict=True))

    def score(self, texts: list[str | None]) -> np.ndarray:
        cut = [tokens(t) for t in texts]
        if len(self.words) > _REMEMBERED:
            self.words = {}
        known = self.words
        self._learn(list({w for ws in cut for w in ws if w not in known}), known)
        means = np.zeros(len(texts))
        for i, ws in enumerate(cut):
            if ws:
                push, n = np.array([known[w] for w in ws]).sum(0)
                means[i] = push / n
        return self.model.probability(means)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, carry: list[str] | None = None) -> DataFrame:
    """(id, held_out, score, predicted) of every row, and the columns named in
    ``carry``; one narrow pass without a shuffle."""
    carry = carry or []
    shared = docs.sparkSession.sparkContext.broadcast(model)
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(["id " + types[id_col], "score double"] + [f"c{i} {types[c]}" for i, c in enumerate(carry)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for part in text_slices(batches, "text"):
            scores = pa.array(scorer.score(part.column("text").to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), scores, *[part.column(f"c{i}") for i in range(len(carry))]],
                ["id", "score", *[f"c{i}" for i in range(len(carry))]])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]).mapInArrow(run, schema)
    return rows.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
                       F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
                       *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)])
