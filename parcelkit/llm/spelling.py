"""Spelling variants: words one edit apart, found by PartEnum signatures.

A word's letter multiset is a set of (letter, number of the occurrence), a
binary vector.  One inserted or deleted code point changes one component of it,
one replaced code point two, so near words have vectors at Hamming distance one
or two.  The components are dealt to ``PARTS`` parts by a hash; a signature is
the vector without the parts it leaves out.  Vectors of equal size at distance
two differ in at most two parts, so leaving out every pair of parts finds them;
a word and one that is longer by one differ in one part, so leaving out every
single part finds those.  The signatures are exact: no near pair is missed, and
they are equi-joined and each pair verified by its edit distance.

What a vector keeps is held as the exclusive-or of 64-bit hashes of its
components, so a signature of any parts is three operations on numbers; equal
hashes of different sets only bring a pair more to the verification.

Everything runs on native expressions.  Words are counted before the shuffle;
signatures exist once per distinct word, never per occurrence.  A word has at
most (2 L + 1) A near words (L its length, A the alphabet), which bounds what
any grouping by word holds.  Following forms halves the way to the root at each
step, and ends because a form is at least twice as frequent as its word.

Defined cases: a null text has no words; a null id counts as an empty one in the
check sum; a text without letters gives nothing; repeated rows count each; ties
between forms go to the smallest word in code point order; an empty table gives
no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import drop_table, materialize

# Fixed value: a run of letters.
WORD = r"[A-Za-zÀ-ÿ]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_CHARS = 5
MIN_COUNT = 3
#: A run loses a code point when this number divides its check sum.
DROP_EVERY = 97
PARTS = 8
#: How many times as frequent a form is at least.
RATIO = 2


def dropped(doc_id: Column, run: Column) -> Column:
    """``run``, without one code point if DROP_EVERY divides the check sum of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    return F.when(F.pmod(h, F.lit(DROP_EVERY)) == 0,
                  F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of whole texts with their number of occurrences."""
    runs = docs.select(F.col(id_col).alias("_id"), F.explode(F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0))).alias("_run"))
    runs = runs.where(F.length("_run") >= min_chars).withColumn("_run", F.translate("_run", _UPPER, _UPPER.lower()))
    counted = runs.groupBy(dropped(F.col("_id"), F.col("_run")).alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= min_count) & (F.length("word") >= min_chars))


def _part_hashes(letters: str, parts: int) -> Column:
    """Per part, the exclusive-or of the hashes of the components in it, from the column of sorted letters."""
    components = F.transform(letters, lambda c, i: F.struct(c.alias("c"), (i - F.array_position(letters, c)).alias("no")))
    hashed = F.transform(components, lambda x: F.struct(
        F.xxhash64(x["c"], x["no"]).alias("hash"), F.pmod(F.xxhash64(F.lit("part"), x["c"], x["no"]), F.lit(parts)).alias("part")))
    nothing = F.array_repeat(F.lit(0).cast("long"), parts)
    return F.aggregate(hashed, nothing, lambda acc, x: F.transform(
        acc, lambda h, p: F.when(p == x["part"], h.bitwiseXOR(x["hash"])).otherwise(h)))


def vectors(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(word, size, part, all): the hash of each part of the word's vector, and of all of it."""
    letters = words.select("word", F.array_sort(F.filter(F.split("word", ""), lambda c: c != "")).alias("letters"))
    hashed = letters.select("word", F.size("letters").alias("size"), _part_hashes("letters", parts).alias("part"))
    return hashed.withColumn("all", F.aggregate("part", F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(h)))


def signatures(hashed: DataFrame, parts: int = PARTS) -> DataFrame:
    """(signature, role, word) of ``vectors``: role 0 for pairs of equal length, 1 and 2 for the shorter and the longer
    word of a pair of lengths one apart.  The signature holds the parts left out, the (longer) length and what is kept."""
    def signature(left_out: tuple[int, ...], size: Column) -> Column:
        kept = F.col("all")
        for p in left_out:
            kept = kept.bitwiseXOR(F.get("part", F.lit(p)))
        return F.xxhash64(F.lit(".".join(map(str, left_out))), size, kept)

    made = [F.struct(F.lit(0).alias("role"), signature(pair, F.col("size")).alias("signature"))
            for pair in combinations(range(parts), 2)]
    for p in range(parts):
        made.append(F.struct(F.lit(1).alias("role"), signature((p,), F.col("size") + 1).alias("signature")))
        made.append(F.struct(F.lit(2).alias("role"), signature((p,), F.col("size")).alias("signature")))
    return hashed.select("word", F.explode(F.array(*made)).alias("s")).select("s.signature", "s.role", "word")


def near_pairs(words: DataFrame, parts: int = PARTS) -> tuple[DataFrame, str]:
    """(a, b): every pair of words exactly one edit apart, once; also the folder of vectors that the frame reads.

    The roles are compared as one number, so that no filter on them parts the two sides of the join and both read one
    exchange.  Signatures of role 0 and of the others never meet, as they name the parts left out."""
    hashed, path = materialize(vectors(words, parts), "spelling-vectors")
    signed = signatures(hashed, parts)
    a, b = signed.alias("a"), signed.alias("b")
    roles = (F.col("a.role") + 3 * F.col("b.role")).isin(0, 1 + 3 * 2) & ((F.col("a.role") == 1) | (F.col("a.word") < F.col("b.word")))
    # A file of vectors is small beside its signatures: a merge join, whatever Spark takes the size to be.
    met = a.join(b.hint("merge"), (F.col("a.signature") == F.col("b.signature")) & roles & (F.levenshtein("a.word", "b.word", 1) == 1))
    return met.select(F.least("a.word", "b.word").alias("a"), F.greatest("a.word", "b.word").alias("b")).distinct(), path


def _with_roots(forms: DataFrame) -> tuple[DataFrame, str]:
    """(word, root) of every word that has a form (word, form), by doubling: each step follows what the last one
    found, until no root has a form itself.  Also the folder that holds them."""
    spark = forms.sparkSession
    roots, path = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        if roots.join(ahead, "root", "left_semi").isEmpty():
            return roots, path
        further, following = materialize(roots.join(ahead, "root", "left").select(
            "word", F.coalesce("ahead", "root").alias("root")), "spelling-roots")
        drop_table(spark, path)
        roots, path = further, following


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = PARTS,
                   ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``docs``.

    ``form``: the most frequent near word if it is at least ``ratio`` times as frequent as the word; ``root``: where
    following forms ends."""
    spark = docs.sparkSession
    words, words_path = materialize(count_words(docs, id_col, text_col), "spelling-words")
    near, vectors_path = near_pairs(words, parts)
    pairs, pairs_path = materialize(near, "spelling-pairs")
    drop_table(spark, vectors_path)
    links = pairs.union(pairs.select("b", "a")).toDF("word", "near")
    counted = links.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # The least of (-n, word) is the most frequent near word, and of those the first in code point order.
    best = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                       F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    frequent = -F.col("best.less") >= ratio * F.col("n")
    described = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n"))
    described, _ = materialize(described, "spelling-forms")
    drop_table(spark, words_path, pairs_path)
    roots, _ = _with_roots(described.where("form is not null"))
    return described.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
