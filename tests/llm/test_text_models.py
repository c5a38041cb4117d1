"""Quality scores, page extraction, decontamination and the pipeline."""
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from parcelkit.llm import byte_bpe, decontaminate, html_extract, quality
from parcelkit.llm.html_blocks import blocks
from parcelkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def test_quality_on_held_out_rows(spark):
    scores = {r.doc_id: r for r in QUERIES["op2_quality"](spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in scores.items())
    held = [i for i in labels if scores[i].held_out]
    right = np.mean([(scores[i].predicted == 1) == (labels[i] == 1) for i in held])
    assert right > 0.95
    assert all((r.score >= 0.3) == (r.predicted == 1) and 0 <= r.score <= 1 for r in scores.values())


def test_quality_ignores_what_is_not_text(spark):
    rows = [(1, "good words here", 1), (2, None, 0), (None, "", 1), (3, "x" * 300_000, 0), (4, "a a a a", 1), (4, "a a a a", 1)]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id bigint, text string, score int, label string")
    labels = spark.createDataFrame([(1, 1), (4, 0), (9, None), (None, 1)], "doc_id bigint, quality int")
    out = quality.score_documents(docs, quality.fit(docs, labels)).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    nothing = quality.fit(docs, labels.where("doc_id > 99"))
    assert quality.score_documents(docs.where("doc_id = 2"), nothing).first().score == 0.5
    assert quality.score_documents(docs.where("doc_id > 99"), nothing).collect() == []


def test_word_features_do_not_depend_on_the_group():
    words = ["a", "word", "W\xf6rter", "x" * 50]
    together, owner = quality.word_features(words)
    for k, w in enumerate(words):
        alone, _ = quality.word_features([w])
        assert sorted(alone) == sorted(together[owner == k])


def test_pages_on_held_out_layouts():
    model = html_extract.default_model()
    chains = html_extract.labelled_chains(html_extract.labelled_pages(150, seed=77))
    right = [x == y for chain, labels in chains for x, y in zip(model.viterbi(chain), labels, strict=True)]
    assert np.mean(right) > 0.98


def test_viterbi_and_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    crf = html_extract.Crf(rng.normal(size=html_extract.FEATURES), rng.normal(size=(2, 2)))
    chain = [[1, 5], [2], [3, 9, 4], [7], [8, 8]]
    e = crf.emissions(chain)
    score = {}
    for m in range(32):
        y = [m >> k & 1 for k in range(5)]
        score[tuple(y)] = sum(e[k] * y[k] for k in range(5)) + sum(crf.follow[a, b] for a, b in zip(y, y[1:], strict=False))
    assert tuple(crf.viterbi(chain)) == max(score, key=score.get)
    total = sum(np.exp(s) for s in score.values())
    single, pairs = crf.marginals(chain)
    assert single == pytest.approx([sum(np.exp(s) for y, s in score.items() if y[k]) / total for k in range(5)])
    assert pairs[0, 1] == pytest.approx(sum(np.exp(s) * sum((a, b) == (0, 1) for a, b in zip(y, y[1:], strict=False))
                                            for y, s in score.items()) / total)


def test_blocks_of_broken_pages():
    text = lambda h: [b.text for b in blocks(h)]
    assert text("<p>a<b>b</b> c<br>d<p>e &amp; f&nbsp;g &lt;x&gt;") == ["ab c d", "e & f g <x>"]
    assert text("<script>if (a<b) '</p>'</script ><div>x<!-- <p>no</p> -->y</div>1 < 2 <") == ["xy", "1 < 2 <"]
    assert text("<ul><li>a<li>b<ul><li>c</ul></ul><td>d</div></p>e<a href='>'>f</a>") == ["a", "b", "c", "d", "ef"]
    assert text("<p title=\"a>b\">x</p><p class='open>y") == ["x"]
    assert text(None) == text("") == text("<!DOCTYPE html><html><head><style>p{}</style>") == []
    assert len(text("<p>x" * 30_000)) == 30_000


def test_page_query(spark):
    import html
    import re
    rows = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op7_html_extraction"](spark, SF).collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", rows[r.page_id], re.S)[1]
        plain = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", body))
        assert r.text == " ".join(html.unescape(plain).split()) and r.n_chars == len(r.text)
    df = spark.createDataFrame([(1, None, None, 1), (1, "u", "", 1)], "page_id bigint, url string, html string, text int")
    assert [(r.text, r.n_chars) for r in html_extract.extract_pages(df).collect()] == [("", 0)] * 2
    assert html_extract.extract_pages(df.where("page_id > 9")).collect() == []


def sellers(p, t, k):
    column, best = list(range(len(p) + 1)), None
    for j, c in enumerate(t):
        new = [0]
        for i in range(1, len(p) + 1):
            new.append(min(column[i] + 1, new[i - 1] + 1, column[i - 1] + (p[i - 1] != c)))
        column = new
        if column[-1] <= k and (best is None or column[-1] < best[0]):
            best = (column[-1], j + 1)
    return best


def test_myers_distance():
    rng = random.Random(3)
    for _ in range(600):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 80)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) + p[rng.randrange(len(p)):] + p[:40]
        k = rng.randint(0, len(p) // 2)
        assert decontaminate.myers(p, t, decontaminate.masks_of(p), k) == sellers(p, t, k)


def test_every_occurrence_within_the_budget_is_found(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("etaoin") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, say(rng.randint(8, 30))) for i in range(12)] + [(90, None), (91, " \n"), (92, "zz"), (0, "Zebra  STRIPES zebra")]
    docs = [(0, None), (1, ""), (2, "a zz top"), (3, "azztop"), (4, "my\nzebra stripes ZEBRA")]
    for i in range(5, 90):
        text = list(say(rng.randint(0, 80)))
        for _ in range(rng.randint(0, 2)):
            hit = list(rng.choice(items[:12])[1])
            for _ in range(rng.randint(0, int(len(hit) * 0.13))):
                k = rng.randrange(len(hit))
                hit[k:k + rng.randint(0, 1)] = rng.choice(["", "x", "y "])
            at = rng.randrange(len(text) + 1)
            text[at:at] = hit
        docs.append((i, "".join(text)))
    expected = set()
    for i, t in docs:
        for j, item in items:
            p, t2 = decontaminate.normalize(item), decontaminate.normalize(t)
            k = decontaminate.budget(p)
            found = sellers(p, t2, k) if p and k else None
            if p and not k and f" {p} " in f" {t2} ":
                found = (0, 0)
            if found:
                expected.add((i, j, found[0]))
    d = spark.createDataFrame([(*r, "e") for r in docs], "doc_id bigint, text string, item_id string")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, doc_id int")
    for size in (1 << 20, 150):   # one block and several
        out = decontaminate.contaminated(d, b, block_chars=size).collect()
        assert {(r.doc_id, r.item_id, r.edits) for r in out} == expected and len(out) == len(expected)
        clean = decontaminate.without_contaminated(d, b, block_chars=size)
        assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - {i for i, _, _ in expected}
        assert clean.columns == d.columns
    assert decontaminate.contaminated(d, b.where("item_id > 99")).collect() == []
    assert decontaminate.contaminated(d.where("doc_id > 99"), b).collect() == []


def test_pipeline_stages_on_their_own_inputs(spark):
    bpe = byte_bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    schema = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.columns == schema and after.dtypes == docs.dtypes, name
        rows, before = after.collect(), docs.collect()
        assert {r.doc_id for r in rows} <= {r.doc_id for r in before}
        assert all(r.n_chars == len(r.text) for r in rows)
        docs = spark.createDataFrame(rows, docs.schema)
    left = {r.doc_id: r.text for r in docs.collect()}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert out.keys() == left.keys()
    for i, r in out.items():
        assert bpe.decode(np.array(r.ids)).decode() == left[i] and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(left[i].encode()).hexdigest()


def test_pipeline_with_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "", "en", "s", 0), (None, "The same text again and again, the same.", "en", "s", 3),
            (5, "x", None, None, None), (5, "x", None, None, None), (6, None, "en", None, None)]
    docs = spark.createDataFrame([(*r, 1.5) for r in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, extra double")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        out.collect()
        assert stage(spark, docs.where("doc_id > 99"), SMALL).collect() == [], name
    near = corpus_pipeline.keep_one_of_near_copies(spark, docs, SMALL)
    assert sorted((str(r.doc_id), str(r.text)) for r in near.collect()) == [
        ("5", "x"), ("6", "None"), ("None", "The same text again and again, the same.")]


def test_letter_share_is_of_the_whole_block():
    from parcelkit.llm.html_blocks import Block
    first, last = "1" * 400 + "a" * 1200 + ".", "a" * 1200 + "1" * 400 + "."
    one, other = (html_extract.features([Block(t, frozenset(), "p", 0, 3)]) for t in (first, last))
    assert one == other


def test_deep_pages_with_closing_tags_of_nothing_open():
    """40,000 open elements and as many closing tags: names of open elements are counted, not searched."""
    deep = "<b>" * 40_000 + "in" + "</i>" * 40_000 + "side" + "<p>" * 3 + "next</p>" + "</b>" * 40_000 + "<p>last"
    assert [b.text for b in blocks(deep)] == ["inside", "next", "last"]
    nested = "<ul>" + "<li>a<ul>" * 50 + "<li>b" + "</ul>" * 50 + "</ul>c"
    assert [b.text for b in blocks(nested)] == ["a"] * 50 + ["b", "c"]
