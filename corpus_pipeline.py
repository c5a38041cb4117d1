"""Corpus cleaning: quality, line dedup, near-duplicates, decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it
as Parquet to the shared checkpoint folder and gives it, reread, to the next
one.  All stages but the last return the columns of ``documents``; the text
and its length are what the stages so far have left of it.

SQL expresses none of the learned, hashed and tokenizing stages, so
``ORACLE_SQL`` is None and the run is tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.llm import byte_bpe, decontaminate, line_dedup, probminhash, quality
from parcelkit.llm.common import drop_table, materialize, ship_package
from parcelkit.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the classifier is
    trained on the labelled rows outside the held-out fold."""
    ship_package(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    carried = [c for c in COLUMNS if c != "doc_id"]
    return quality.score_documents(docs, model, carry=carried).where("predicted = 1").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the blocks that an earlier document has; documents of
    which nothing but white space is left, though something was there, go."""
    ship_package(spark)
    cut = line_dedup.dedup_lines(docs.select(*COLUMNS))
    emptied = (F.col("removed_lines") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    return (cut.where(~emptied).withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast("long"))
            .select(*COLUMNS))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    ship_package(spark)
    return probminhash.keep_one(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its edit budget."""
    ship_package(spark)
    return decontaminate.without_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests and the token ids of what is left."""
    ship_package(spark)
    return byte_bpe.encode_texts(docs, vocabulary("byte_bpe_50k.tiktoken"), keep_ids=True)


STAGES = [("quality classifier", keep_quality), ("line dedup", drop_repeated_lines),
          ("MinHash near-dedup", keep_one_of_near_copies), ("benchmark decontamination", drop_contaminated),
          ("byte-level BPE", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the table between two stages goes when the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs, path = materialize(stage(spark, docs, sf_dir), "corpus")
        if before:
            drop_table(spark, before)
        before = path
    return docs
