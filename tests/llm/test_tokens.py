"""Prefix token counts and byte-level BPE against the public libraries."""
import base64
import hashlib
import json
import random
from pathlib import Path

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from parcelkit.llm import byte_bpe, token_counts
from parcelkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = ["a", "b", "the ", "THE", "ing", "'", "'s", "'re", "'l", "ll", "'v", "don't ", " ", "  ", "\n", "\t", "\x85",
         "　", "\xa0", "\x1c", "​", "İ", "Σ", "ΣΑΣ", "\xe9", "é", "1", "23",
         "\xbd", "!", "!!", "''", "…", "<|endoftext|>", "<|endoftext", "<|", "|>", "漢字", "\U0001f642",
         "\xdf", "ﬁ", "ǅ", "한", "ab" * 60, "!" * 90]


def mixed(n, seed, most=9):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_every_prefix_has_the_library_count():
    counter, library = token_counts.counter(WORDS), Tokenizer.from_file(WORDS)
    size = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for text in mixed(1500, 1):
        counts = counter.prefix_counts(text)
        assert (int(counts[-1]) if len(counts) else 0) == size(text) == counter.measure([text], 5)[0][0]
        for limit in range(6):
            within = np.flatnonzero(counts <= limit)
            assert counter.measure([text], limit)[0][1] == (within[-1] + 1 if len(within) else 0)
        if "<|" not in text:
            plain = counter.normalize(text)
            for k in range(1, len(plain) + 1):
                if library.normalizer.normalize_str(plain[:k]) == plain[:k]:
                    assert counts[k - 1] == size(plain[:k])


def test_code_points_count_as_in_the_library():
    counter, library = token_counts.counter(WORDS), Tokenizer.from_file(WORDS)
    texts = [f"a{chr(c)}1{chr(c)}" for c in range(1, 0x30000, 3) if not 0xD800 <= c < 0xE000]
    theirs = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [n for n, _ in counter.measure(texts, 9)] == theirs


def test_special_strings_of_another_form(tmp_path):
    """A vocabulary whose special strings do not begin as those of the given file."""
    spec = json.loads(Path(WORDS).read_text())
    for i, token in enumerate(spec["added_tokens"]):
        vocab, own = spec["model"]["vocab"], f"[END{i}]"
        if token["content"] in vocab:
            vocab[own] = vocab.pop(token["content"])
        token["content"] = own
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec))
    counter, library = token_counts.counter(str(path)), Tokenizer.from_file(str(path))
    assert counter.specials[0] == "[END0]"
    for text in ("a [END0] b", "[END0][END0]", "one two[END1]", "[END", "<|endoftext|> x", "x[END0]" * 3):
        assert counter.measure([text], 9)[0][0] == len(library.encode(text, add_special_tokens=False).ids), text


def test_token_query(spark):
    library = Tokenizer.from_file(WORDS)
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op3_token_counts"](spark, SF).collect():
        n = len(library.encode(rows[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(rows[r.doc_id].encode()), n > 2048)
    df = spark.createDataFrame([(1, None, 9), (None, "", 9), (2, "x" * 100_000, 9), (2, "x" * 100_000, 9)],
                               "doc_id bigint, text string, n_tokens int")
    out = token_counts.token_counts(df, WORDS, limit=5)
    n = len(library.encode("x" * 100_000, add_special_tokens=False).ids)
    assert sorted(((r.doc_id, r.n_tokens, r.over_limit) for r in out.collect()), key=str) == sorted(
        [(1, 0, False), (None, 0, False), (2, n, True), (2, n, True)], key=str)
    assert token_counts.token_counts(df.where("doc_id > 5"), WORDS).collect() == []


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTES, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_is_the_library_encoding():
    bpe, library = byte_bpe.codec(BYTES), reference()
    texts = [*mixed(20_000, 2, 12), None, "", "a" * 50_000, "ab c" * 9000]
    for text, (ids, offsets) in zip(texts, bpe.encode_with_offsets(texts), strict=True):
        raw = (text or "").encode()
        assert ids.tolist() == library.encode_ordinary(text or "") and bpe.decode(ids) == raw
        assert all(raw.startswith(bpe.tokens[i], o) for i, o in zip(ids.tolist()[:30], offsets.tolist(), strict=False))


def test_code_points_split_as_in_the_library():
    bpe, library = byte_bpe.codec(BYTES), reference()
    texts = [f"a{chr(c)}1{chr(c)}{chr(c)} {chr(c)}" for c in range(0, 0x30000, 3) if not 0xD800 <= c < 0xE000]
    assert [i.tolist() for i in bpe.encode(texts)] == library.encode_ordinary_batch(texts)


def test_scan_does_not_depend_on_the_lanes():
    points = np.frombuffer("".join(mixed(300, 4)).encode("utf-32-le"), np.int32)
    symbols = byte_bpe.symbols_of(points)
    first = byte_bpe.piece_starts(symbols, 1)
    assert all((byte_bpe.piece_starts(symbols, n) == first).all() for n in (2, 7, 64))


def test_byte_bpe_query(spark):
    library = reference()
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op10_byte_bpe"](spark, SF).collect():
        ids = np.array(library.encode_ordinary(rows[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].encode()).hexdigest()
    df = spark.createDataFrame([(1, None, 2), (None, "", 2), (3, "caf\xe9 's", 2)], "doc_id bigint, text string, ids int")
    back = byte_bpe.decode_ids(byte_bpe.encode_texts(df, BYTES, keep_ids=True), BYTES)
    assert sorted(map(tuple, back.collect()), key=str) == sorted([(1, ""), (None, ""), (3, "caf\xe9 's")], key=str)
    assert byte_bpe.encode_texts(df.where("doc_id > 5"), BYTES).collect() == []
