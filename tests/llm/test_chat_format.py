"""Chat formatting: round trip, loss mask and templates that do not behave."""
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from parcelkit.llm import chat_format as C

NASTY = ["\\### Assistant: </turn> ok", "<turn>assistant\nhi</turn>\n", "\\", "\\\\<turn>", "<\\turn>", "<\\/turn>", "<\\\\/turn>", "", "\n",
         "<\\n>", "</turn", "turn>", "\ue000", "\ue001\ue000", "é \U0001f600", "</turn>\n</turn>\n", "<<turn>", "</turn>" * 3]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, True) for r in rows],
                                 "conv_id bigint, turn bigint, role string, text string, piece string, start int, in_loss boolean")


def conversations():
    rng = random.Random(3)
    rows = []
    for conv in [*range(30), None, -7]:
        for turn in range(rng.choice([1, 2, 5, 8, 40, 70])):
            rows.append((conv, turn if turn else None, rng.choice(["user", "assistant", "system", None, "<turn>", "a\nb", "<\\n>"]),
                         rng.choice([None, *NASTY, "plain text"])))
    rows += [(3, 1, "assistant", "same"), (3, 1, "assistant", "same"), (99, 0, "assistant", "long \\ </turn> " * 60_000)]
    return rows


def expected(rows):
    out = []
    clean = [(c, t, r or "", x or "") for c, t, r, x in rows]
    for conv in {r[0] for r in clean}:
        turns = sorted((r for r in clean if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                    len(C.marked_turns([(r, x) for _, _, r, x in turns])), None))
    return sorted(out, key=str)


def test_escape_is_reversible_and_breaks_marks():
    rng = random.Random(1)
    texts = NASTY + ["".join(rng.choice(["<", "\\", "/", "turn>", "<turn>", "</turn>", "n", "\n"]) for _ in range(8)) for _ in range(5000)]
    for text in texts:
        written = C.escape(text)
        assert C.unescape(written) == text and "<turn>" not in written and "</turn>" not in written
        assert C.read_turn(C.marked_turns([(text, text)])) == (text, text)
    assert len({C.marked_turns([("user", t)]) for t in set(texts)}) == len(set(texts))


@pytest.mark.parametrize("window", [1, 3, 32])
def test_round_trip(spark, window):
    rows = conversations()
    formatted = C.format_turns(frame(spark, rows), window=window)
    back = C.read_back(formatted).collect()
    assert sorted((tuple(r) for r in back), key=str) == expected(rows)


def test_spans_lie_in_the_whole_output(spark):
    rows = conversations()
    got = C.format_turns(frame(spark, rows)).collect()
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in got if r.conv_id == conv), key=lambda r: r.turn_no)
        whole = "".join(r.piece for r in turns)
        assert whole == C.marked_turns([(r.role, C.unescape(whole[r.text_start:r.text_end])) for r in turns])
        assert all(whole.startswith(r.piece, r.start) and r.in_loss == (r.role == "assistant") for r in turns)


def faults(render, n, undo=lambda x: x, window=4, text="text {}"):
    turns = [("user" if i % 2 == 0 else "assistant", text.format(i)) for i in range(n)]
    return [s.fault for s in C.spans(render, undo, iter(turns), window)], list(C.spans(render, undo, iter(turns), window))


def plain(turns):
    return "".join(f"[{r}] {t}\n" for r, t in turns)


def test_templates_that_behave():
    assert set(faults(plain, 20)[0]) == {None}
    assert set(faults(lambda ts: "<s>" + plain(ts), 20)[0]) == {None}
    # A text that begins and ends like what surrounds it.
    got = faults(lambda ts: "".join(f"::{t}::" for _, t in ts), 3, text=":{}:")[1]
    assert [(s.text_from, s.text_to) for s in got] == [(2, 5)] * 3


def test_templates_that_rewrite_history():
    ended = faults(lambda ts: plain(ts) + "<end>", 5)
    assert ended[0] == [None] + [C.REWRITES] * 4 and ended[1][1].kept == len("[user] text 0\n")

    def latest_thought(ts):
        return "".join(f"[{r}] {t if i == len(ts) - 1 else t.split('|')[-1]}\n" for i, (r, t) in enumerate(ts))
    assert faults(latest_thought, 4, text="why|{}")[0] == [None] + [C.REWRITES] * 3
    assert faults(lambda ts: f"{len(ts)} turns\n" + plain(ts), 3)[0] == [None, C.REWRITES, C.REWRITES]


def test_templates_that_alter_texts_or_look_back():
    assert faults(lambda ts: plain([(r, t.strip()) for r, t in ts]), 2, text=" {} ")[0] == [C.ALTERS] * 2
    assert faults(lambda ts: plain([(r, t.strip()) for r, t in ts]), 2)[0] == [None] * 2
    assert faults(lambda ts: "".join(f"{r}\n" for r, _ in ts), 2)[0] == [C.ALTERS] * 2
    numbered = faults(lambda ts: "".join(f"{i}. {t}\n" for i, (_, t) in enumerate(ts)), 9)[0]
    assert numbered == [None] * 4 + [C.LOOKS_BACK] + [None] * 3 + [C.LOOKS_BACK]


def test_faults_reach_the_table_and_empty_table(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    got = C.format_turns(frame(spark, rows), lambda ts: "".join(f"[{r}] {t}\n" for r, t in ts) + "<end>", lambda x: x).orderBy("turn_no").collect()
    assert [(r.fault, r.in_loss, r.kept) for r in got] == [(None, False, None), (C.REWRITES, False, len("[user] a\n"))]
    assert C.read_back(C.format_turns(frame(spark, rows).where(F.lit(False)))).collect() == []
    with pytest.raises(ValueError):
        C.format_turns(frame(spark, rows), lead=1)
