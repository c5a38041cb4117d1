"""Operators against plain-Python forms of their inner steps, and long or clashing inputs."""
import math

import numpy as np
import xxhash
from pyspark.sql import functions as F

from parcelkit.llm import decontaminate, ego_join, probminhash, quality, sharding, warc

MASK = (1 << 64) - 1


def mix(x):
    x = (x ^ x >> 33) * 0xFF51AFD7ED558CCD & MASK
    x = (x ^ x >> 33) * 0xC4CEB9FE1A85EC53 & MASK
    return x ^ x >> 33


def plain_features(word):
    """Buckets of a word: itself and its n-grams, one code point at a time."""
    points = [2, *map(ord, word), 3]
    whole = sum(mix(p + 1) * pow(0x100000001B3, k, 1 << 64) for k, p in enumerate(points)) & MASK
    out = [mix(whole) % quality.BUCKETS]
    for size in quality.GRAMS:
        for at in range(len(points) - size + 1):
            code = size
            for p in points[at:at + size]:
                code = (code ^ p) * 0x9E3779B97F4A7C15 & MASK
                code ^= code >> 29
            out.append(mix(code) % quality.BUCKETS)
    return out


def plain_score(text, model):
    words = (text or "").split()
    words += ["\x04" for a, b in zip(words, words[1:]) if a == b]
    found = [f for w in words for f in plain_features(w)]
    mean = sum(float(model.push[f]) for f in found) / len(found) if found else 0.0
    return 1 / (1 + math.exp(-(mean + model.bias)))


def test_quality_features_and_score_by_a_plain_loop(spark):
    words = ["a", "être", "naïve", "\U0001f600x", "word", "x" * 70]
    buckets, owner = quality.word_features(words)
    for i, w in enumerate(words):
        assert sorted(buckets[owner == i].tolist()) == sorted(plain_features(w))
    texts = ["good plain words here", "buy buy buy now now", "", None, "très bien \n\t merci", "long " * 30_000, "a"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 4)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(28)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    for r in quality.score_documents(docs, model).collect():
        assert math.isclose(r.score, plain_score(texts[r.doc_id % 7], model), rel_tol=1e-6)


def test_quality_ties_do_not_depend_on_order(spark):
    rows = [(i, t) for i in range(40) for t in (f"first {i}", f"second {i}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 0), (3, 1)], "doc_id long, quality int")
    a = quality.fit(docs.repartition(7, "text"), labels)
    b = quality.fit(docs.coalesce(1), labels.repartition(5))
    assert np.array_equal(a.push, b.push) and a.bias == b.bias


def test_items_of_one_id_have_their_own_budgets(spark):
    short, long = "alpha beta gamma delta", " ".join(f"word{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"x {short} y"), (2, f"x {long} y")], "doc_id long, text string")
    items = spark.createDataFrame([(7, short), (7, long)], "item_id long, text string")
    got = {r.doc_id: (r.item_id, r.budget) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {1: (7, decontaminate.budget(short)), 2: (7, decontaminate.budget(long))}


def test_keep_one_keeps_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(1, text, "a", 1), (2, text + " end", "b", 2), (3, "other words stand here in this", "c", 3), (4, None, "d", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _k1 string, class_id int")
    out = probminhash.keep_one(docs)
    assert out.columns == docs.columns and sorted(tuple(r) for r in out.collect()) == [rows[0], rows[2], rows[3]]


def test_very_long_texts(spark):
    base = " ".join(f"w{i}" for i in range(150_000))
    rows = [(1, base), (2, base + " tail"), (3, "tail"), (4, " ".join(f"v{i}" for i in range(120_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.class_id) for r in probminhash.near_duplicates(docs).collect()) == [(1, 1), (2, 1), (3, 3), (4, 4)]
    pages = spark.createDataFrame([(i, "u", t) for i, t in rows], "page_id long, url string, html string")
    folder = warc.archive_folder(spark)
    back = warc.read_records(warc.write_archives(pages, folder), folder).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in back) == [(i, len(t)) for i, t in rows]


def test_long_vectors(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(6, 3000))
    v[3] = v[0] + 0.01 * rng.normal(size=3000)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in ego_join.near_vectors(df).collect())
    assert got == [(0, 1, 0), (1, 0, 1), (2, 0, 2), (3, 1, 0), (4, 0, 4), (5, 0, 5)]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_network(x, n, seed):
    """The Feistel rounds on whole numbers."""
    a, b = sharding.box(n)
    left, right = divmod(x, b)
    for r in range(sharding.ROUNDS):
        h = xxhash.xxh64_intdigest(right.to_bytes(8, "little", signed=True), seed=42)
        h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), seed=h)
        h = xxhash.xxh64_intdigest(r.to_bytes(4, "little"), seed=h)
        side = a if r % 2 == 0 else b
        left, right = right, (left + signed(h) % side) % side
    return left * b + right


def test_permutation_in_plain_python(spark):
    for n in (1, 2, 13, 97, 100, 1000):
        df = sharding.permute(spark.range(n), "id", "p", n)
        for r in df.collect():
            x = plain_network(r.id, n, sharding.SEED)
            while x >= n:
                x = plain_network(x, n, sharding.SEED)
            assert r.p == x
    placed = sharding.shard_rows(spark.range(50).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")), shards=4)
    for r in placed.collect():
        x = plain_network(r.row_no, 50, sharding.SEED)
        while x >= 50:
            x = plain_network(x, 50, sharding.SEED)
        assert (r.shard, r.slot) == (x % 4, x // 4)
