"""ProbMinHash and epsilon grid order join against brute force."""
import random

import numpy as np
import pytest

from parcelkit.llm import ego_join, probminhash
from parcelkit.llm.components import connected_components
from parcelkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def components(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def slow_similarity(a, b):
    a, b = dict(zip(a[0].tolist(), a[1].tolist(), strict=True)), dict(zip(b[0].tolist(), b[1].tolist(), strict=True))
    return sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys())
               for i in a.keys() & b.keys())


def near_classes(rows):
    sets = [probminhash.shingles(t) for _, t in rows]
    links = [(x, y) for x in range(len(rows)) for y in range(x)
             if (rows[x][1] or "") == (rows[y][1] or "")
             or len(sets[x][0]) and slow_similarity(sets[x], sets[y]) >= probminhash.THRESHOLD]
    roots = components(len(rows), links)
    ids = {}
    for (i, _), r in zip(rows, roots, strict=True):
        if i is not None:
            ids[r] = min(i, ids.get(r, i))
    return sorted(((i, ids.get(r)) for (i, _), r in zip(rows, roots, strict=True)), key=str)


def test_exact_similarity_is_the_definition():
    rng = random.Random(1)
    for _ in range(200):
        sets = []
        for _ in range(2):
            w = {rng.randrange(12): rng.randint(1, 5) for _ in range(rng.randint(1, 9))}
            k = np.array(sorted(w), np.uint64)
            sets.append((k, np.array([w[int(x)] for x in k])))
        assert probminhash.probability_jaccard(*sets) == pytest.approx(slow_similarity(*sets))


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(5)
    for share in (0.3, 0.6, 0.9):
        a = np.unique(rng.integers(0, 1 << 62, 300).astype(np.uint64))
        b = a.copy()
        b[int(share * len(b)):] = rng.integers(0, 1 << 62, len(b) - int(share * len(b))).astype(np.uint64)
        x = (a, rng.integers(1, 6, len(a)))
        keep = np.argsort(b)
        y = (b[keep], x[1][keep] * 3)   # the similarity does not depend on scale
        s = probminhash.signatures([x, y], 4000)
        assert (s[0] == s[1]).mean() == pytest.approx(probminhash.probability_jaccard(x, y), abs=0.04)


def test_signature_does_not_depend_on_the_slice():
    sets = [probminhash.shingles(t) for t in ("a b c d e f g", "x", "", "a a a a a a a a a", "b c d e f g h i j")]
    together = probminhash.signatures(sets)
    assert all((probminhash.signatures([s])[0] == t).all() for s, t in zip(sets, together, strict=True))
    assert (together[2] == 0).all()


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", "  ", "one", "one", "one two", "ONE two", "a b c d e", "a b c d e"]
    for size, n, edits in ((60, 6, 1), (120, 12, 3), (200, 10, 4), (40, 5, 2), (300, 8, 9)):
        texts += family(rng, [f"w{rng.randrange(500)}" for _ in range(size)], n, edits)
    texts += ["same line here again " * 30, "same line here again " * 31, "x " * 5000, "x " * 5001]
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts)] + [(None, "one"), (None, "only nulls"), (3, "one")]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id bigint, text string, node string")
    got = sorted(((r.doc_id, r.class_id) for r in probminhash.near_duplicates(df).collect()), key=str)
    assert got == near_classes(rows)


def test_cross_component_pairs_come_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(probminhash, "BLOCK", 3)
    rng = random.Random(9)
    rows = list(enumerate(family(rng, [f"w{k}" for k in range(90)], 40, 2)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.class_id) for r in probminhash.near_duplicates(df).collect()), key=str)
    assert got == near_classes(rows)


def test_near_duplicates_of_an_empty_table(spark):
    assert probminhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_query_on_the_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.class_id) for r in QUERIES["op4_minhash"](spark, SF).collect()), key=str)
    assert got == near_classes(rows)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(300, 300), (501, 500)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = dict(map(tuple, connected_components(df).collect()))
    assert got == {**{i: 100 for i in range(101, 141)}, **{i: 7 for i in range(8, 60)}, 501: 500}
    assert connected_components(df.where("a < 0")).collect() == []


def brute_vectors(rows, threshold=0.95):
    ok, unit = [], []
    for _, v in rows:
        good = v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(good)
        unit.append(np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if good else None)
    links = [(x, y) for x in range(len(rows)) for y in range(x) if ok[x] and ok[y] and len(unit[x]) == len(unit[y])
             and unit[x] @ unit[y] >= threshold]
    roots = components(len(rows), links)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        least[r] = min(i, least.get(r, i))
    degree = [0] * len(rows)
    for x, y in links:
        degree[x] += 1
        degree[y] += 1
    return sorted((i, d, least[r], i == least[r]) for (i, _), d, r in zip(rows, degree, roots, strict=True))


@pytest.mark.parametrize("block, leaf", [(4096, 256), (16, 4)])
def test_vectors_match_brute_force(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(ego_join, "BLOCK", block)
    monkeypatch.setattr(ego_join, "LEAF", leaf)
    rng = np.random.default_rng(4)
    rows, centres = [], rng.normal(size=(12, 10))
    for _ in range(220):
        v = centres[rng.integers(12)] + rng.normal(size=10) * rng.choice([0.0, 0.15, 0.3, 1.0])
        rows.append([float(x) for x in (v * rng.choice([1.0, 1e-3, 50.0])).astype(np.float32)])
    rows += [None, [], [0.0] * 10, [float("nan")] + [1.0] * 9, [float("inf")] + [1.0] * 9, [None] + [1.0] * 9,
             [1.0, 2.0], [2.0, 4.0], [-0.0, 1.0], [0.0, 1.0], rows[0], rows[0]]
    rows = list(enumerate(rows, 100))
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, node int")
    got = sorted(map(tuple, ego_join.near_vectors(df).collect()))
    assert got == brute_vectors(rows)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert ego_join.near_vectors(df).collect() == []
    df = spark.createDataFrame([(5, None)], "vec_id bigint, embedding array<float>")
    assert list(map(tuple, ego_join.near_vectors(df).collect())) == [(5, 0, 5, True)]


def test_vector_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op6_embeddings"](spark, SF).collect())) == brute_vectors(rows)
