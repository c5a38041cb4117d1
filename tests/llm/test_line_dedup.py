"""Line deduplication by pairwise alignment."""
import random

from parcelkit.llm import line_dedup
from parcelkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LONG = "this line is long enough to be a block of its own and a bit more"


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, lines string, rep int")
    out = line_dedup.dedup_lines(df, **kw)
    assert out.columns == ["doc_id", "text", "lines", "rep", "removed_lines", "removed_chars"]
    return sorted([(r.doc_id, r.text, r.removed_lines) for r in out.collect()], key=str)


def test_patience_anchors_and_blocks():
    assert line_dedup.patience_matches(list("axbyc"), list("abc")) == [(0, 0), (2, 1), (4, 2)]
    assert line_dedup.patience_matches(list("pqAxyBr"), list("AzyB")) == [(2, 0), (4, 2), (5, 3)]
    assert line_dedup.patience_matches([], list("ab")) == []
    assert line_dedup.heavy_blocks([(0, 0), (1, 1), (5, 3)], [30, 30, 0, 20], 40) == [0, 1]


def test_edges(spark):
    rows = [(1, LONG), (2, f"new\n{LONG}\nend"), (2, f"new\n{LONG}\nend"), (3, None), (4, ""), (5, "short\nlines"),
            (6, "short\nother"), (None, LONG), (7, LONG), (1, LONG), (8, f"  {LONG}  \nrest")]
    assert run(spark, rows) == all_blocks(rows)
    assert (7, "", 1) in run(spark, rows) and (8, "rest", 1) in run(spark, rows)
    assert run(spark, []) == []


def test_common_lines_and_moved_blocks(spark):
    rng = random.Random(5)
    pool = [f"{k} " + " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randint(1, 14))) for k in range(60)]
    rows = []
    for i in range(80):
        lines = [f"own {i} {k} " + "z" * rng.randint(0, 50) for k in range(rng.randint(0, 5))]
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(55)
            lines[rng.randrange(len(lines) + 1):0] = pool[k:k + rng.randint(1, 5)]
        if rng.random() < 0.6:
            lines.insert(0, pool[0])
        rows.append((rng.randrange(10**6), "\n".join(lines)))
    rows += rows[:5]
    for rare in (0, 2, 6, 1000):
        assert run(spark, rows, rare=rare) == all_blocks(rows)


def test_query_on_the_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.text, r.removed_lines) for r in QUERIES["op9_line_dedup"](spark, SF).collect()), key=str)
    assert got == all_blocks(rows)


def common_blocks(a, b, weights, least):
    """Places in ``b`` of all heavy runs that also stand in ``a``, by a matcher of its own."""
    gone = set()
    for i in range(len(a)):
        for j in range(len(b)):
            k = 0
            while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                k += 1
            if sum(weights[j:j + k]) >= least:
                gone |= set(range(j, j + k))
    return gone


def test_repeated_and_moved_passages(spark):
    p, q = [f"p{k} " + "p" * 18 for k in range(3)], [f"q{k} " + "q" * 18 for k in range(3)]
    for early, late, kept in ((p + ["x"] + p, ["y"] + p + ["z"], "y\nz"), (p, p + ["y"] + p, "y"), (p + q, q + p, ""),
                              (p + ["x"], ["y"] + p[1:] + p + q, "\n".join(["y"] + q))):
        assert run(spark, [(1, "\n".join(early)), (2, "\n".join(late))])[1][1] == kept
    rng = random.Random(3)
    for _ in range(3000):
        size = [rng.choice([0, 1, 5, 20, 41]) for _ in range(rng.randint(2, 8))]
        a, b = ([rng.randrange(len(size)) for _ in range(rng.randrange(14))] for _ in "ab")
        weights = [size[x] for x in b]
        for more in ([], [weights, 40]):
            got = line_dedup.patience_matches(a, b, *more)
            assert all(a[i] == b[j] for i, j in got)
            assert set(line_dedup.heavy_blocks(got, weights, 40)) == common_blocks(a, b, weights, 40)


def all_blocks(rows, min_chars=line_dedup.MIN_CHARS):
    """Every heavy run of lines against every earlier text, by plain loops."""
    first, last = {}, 1 << 70
    number = lambda i: last if i is None else i
    for i, t in rows:
        if t is not None:
            first[t] = min(number(i), first.get(t, last))
    cut = {t: [x.strip(" ") for x in t.split("\n")] for t in first}
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, t, 0))
            continue
        size = [len(x) for x in cut[t]]
        gone = set()
        for e in first:
            if first[e] < first[t] and set(cut[e]) & set(cut[t]):
                gone |= common_blocks(cut[e], cut[t], size, min_chars)
        if number(i) != first[t] and sum(size) >= min_chars:
            gone = set(range(len(size)))
        out.append((i, "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone), len(gone)))
    return sorted(out, key=str)


def test_block_whose_lines_have_other_earliest_holders(spark):
    a, b = "first line of the block, 30 ch", "second line of it, under forty"
    texts = [f"{a}\nx", f"y\n{b}", f"own\n{a}\n{b}", f"{a}\n{b}\nrest"]
    for more in (0, 20):                                 # rare and common lines
        rows = list(enumerate(texts[:2] + [f"{k}\n{a}\nz\n{b}" for k in range(more)] + texts[2:]))
        assert ("rest", 2) in [r[1:] for r in run(spark, rows)]


def test_every_block_against_every_earlier_text(spark):
    rng = random.Random(8)
    pool = [" " * (k % 2) + f"{k} " + "w" * rng.randint(0, 45) for k in range(25)] + ["", "", ""]
    rows = []
    for _ in range(90):
        text = []
        for _ in range(rng.randint(1, 5)):
            k = rng.randrange(len(pool))
            text += pool[k:k + rng.randint(1, 5)] + [f"own {rng.random()}"] * rng.randrange(2)
        rows.append((len(rows), "\n".join(text)))
    rows += [(200 + k, rows[k][1]) for k in range(4)]
    assert run(spark, rows) == all_blocks(rows)
    assert run(spark, rows, min_chars=90) == all_blocks(rows, 90)


def test_long_text_and_taken_names(spark):
    own = [f"line {k} of a text that is very long indeed, word {k * k}" for k in range(12_000)]
    late = ["short"] + own[3000:9000] + ["between"] + own[:10] + ["end"]
    rows = [(1, "\n".join(own), "a", "b"), (2, "\n".join(late), "c", "d")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _new string, removed_lines string")
    out = line_dedup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "_new", "removed_lines", "removed_lines_", "removed_chars"]
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == rows[0][1] and got[1]._new == "a" and got[2].removed_lines == "d"
    assert got[2].text == "short\nbetween\nend" and got[2].removed_lines_ == 6010
