"""Spelling variants against a comparison of all pairs."""
import random
import re
import zlib
from collections import Counter

from parcelkit.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(rows):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, words[w], len(near[w]), form[w], form[w] and words[form[w]], root(w)) for w in words)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, word string, n int")
    return sorted(tuple(r) for r in spelling.spelling_forms(df.repartition(3)).select(
        "word", "n", "n_near", "form", "form_n", "root").collect())


def test_variants_against_all_pairs(spark):
    rng = random.Random(5)
    letters = "abcdeé÷ßZ"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(60)]
    rows = []
    for i in range(400):
        words = []
        for _ in range(30):
            w = rng.choice(stems[:1 + rng.randrange(60)])
            if rng.random() < 0.5:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1:]])
            words.append(w)
        rows.append((i, rng.choice([" ", "\n", "1", "Ā"]).join(words)))
    rows += [(None, " ".join(stems)), (1, None), (2, ""), (3, "12 34"), (4, "Àbcde " * 20_000), (4, "Àbcdef " * 9)]
    rows += [(7, "hotword " * 50)] * 40
    out = got(spark, rows)
    assert out == expected(rows)
    assert sum(r[2] > 0 for r in out) > 50


def test_chains_and_ties(spark):
    text = ("aaaaaaaa " * 64 + "aaaaaaab " * 31 + "aaaaaabb " * 15 + "aaaaabbb " * 7 + "aaaabbbb " * 3
            + "mmmmm " * 3 + "mmmmn " * 8 + "mmmml " * 8 + "nopqr " * 3 + "npoqr " * 9)
    whole = next(i for i in range(99) if all(zlib.crc32(f"{i}:{w}".encode()) % 97 for w in text.split()))
    rows = [(whole, text)]
    out = {r[0]: r for r in got(spark, rows)}
    assert got(spark, rows) == expected(rows)
    assert out["aaaabbbb"][5] == "aaaaaaaa" and out["mmmmm"][3] == "mmmml" and out["nopqr"][2:4] == (0, None)


def test_every_near_pair_shares_a_signature(spark):
    rng = random.Random(8)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(5, 8))) for _ in range(700)}
    df = spark.createDataFrame([(w, 1) for w in sorted(words)], "word string, n long")
    pairs = {(r.a, r.b) for r in spelling.near_pairs(df)[0].collect()}
    assert pairs == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    per_word = spelling.signatures(spelling.vectors(df)).groupBy("word").count().select("count").distinct().collect()
    assert [r[0] for r in per_word] == [28 + 16]


def test_empty_tables(spark):
    assert got(spark, []) == [] and got(spark, [(1, None), (2, "a b c")]) == []
