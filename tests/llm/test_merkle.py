"""Merkle manifest against a tree built in plain Python."""
import hashlib
import zlib

from pyspark.sql import functions as F

from parcelkit.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, rank int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def climb(nodes):
    """Levels of a tree, the nodes first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + 16])) for i in range(0, len(below), 16)])
    return levels


def path(levels, at):
    steps = []
    for level in levels[:-1]:
        run = level[at // 16 * 16:at // 16 * 16 + 16]
        steps.append((run[:at % 16], run[at % 16 + 1:]))
        at //= 16
    return steps


def expected(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees, members = {}, {}
    for s in sources:
        members[s] = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = climb([leaf(r) for r in members[s]])
    top = climb([trees[s][-1][0] for s in sources])
    out = []
    for no, s in enumerate(sources):
        for at, r in enumerate(members[s]):
            proof = path(trees[s], at) + path(top, no)
            chosen = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf(r) if not chosen else leaf((*r[:4], r[4] and r[4].translate(LOWER)))
            for lhs, rhs in proof:
                node = sha("".join(lhs) + node + "".join(rhs))
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], sha("".join("".join(a + b) for a, b in proof)), node,
                        node == top[-1][0]))
    return sorted(out, key=str)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "other", 3) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.verified_documents(df.repartition(5)).collect()), key=str)


def test_manifest_against_plain_tree(spark):
    rows = [(i, "hot", "en", 4, f"Text {i}") for i in range(300)]
    rows += [(1000 + i, f"s{i % 17}", None, None, None if i % 3 else "Ü" * (i + 1)) for i in range(60)]
    rows += [(5, "lone", "de", 1, "A"), (6, None, "de", 1, ""), (7, None, "de", 2, "B"), (None, "keyless", "x", 0, "C"),
             (None, "keyless", "x", 0, "D"), (9, "twice", "x", 0, "same"), (9, "twice", "x", 0, "same"),
             (10, "twice", "x", 0, "E" * 300_000), (11, "Ztwice", "x", 0, "F"), (12, "\U0001f600", "x", 0, "F"), (13, "�", "x", 0, "F")]
    assert got(spark, rows) == expected(rows)


def test_equal_subtrees_are_one_record(spark):
    rows = [(1, "a", "en", 1, "X")] * 64 + [(2, "a", "en", 1, "Y")] * 3
    assert got(spark, rows) == expected(rows)


def test_small_tables(spark):
    for n in (0, 1, 2, 16, 17):
        rows = [(i, "s", "en", 1, f"T{i}") for i in range(n)]
        assert got(spark, rows) == (expected(rows) if rows else [])
    apart = [(i, f"s{i}", "en", 1, "T") for i in range(18)]
    assert got(spark, apart) == expected(apart)


def test_proofs_of_some_rows(spark):
    rows = [(i, "s", "en", 1, f"T{i}") for i in range(40)] + [(100, "t", "en", 1, "U")]
    df = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA).drop("leaf", "rank")
    digests = df.withColumn("leaf", merkle.leaf_digest([F.col(c) for c in df.columns]))
    manifest = merkle.build(digests, "source", "doc_id")
    some, paths = merkle.prove(manifest, manifest.leaves.where("doc_id in (0, 17, 39, 100)"))
    out = some.withColumn("folded", merkle.fold(F.col("leaf"), F.col("proof"))).collect()
    assert sorted(r.doc_id for r in out) == [0, 17, 39, 100]
    assert all(r.found == r.leaf and r.folded == manifest.root for r in out)
    assert [s.place for s in next(r.proof for r in out if r.doc_id == 39)] == [7, 2, 0]
    assert len(next(r.proof for r in out if r.doc_id == 17)[0].before) == 64
    manifest.drop(spark)
