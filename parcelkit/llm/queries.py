"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelkit.llm import (byte_bpe, chat_format, decontaminate, ego_join, html_extract, line_dedup, merkle, probminhash, quality,
                           sharding, spelling, token_counts, warc)
from parcelkit.llm.common import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op1_warc", sql="""
WITH p AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
r AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS response
  FROM p)
SELECT page_id, url, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN response IS NOT NULL AND page_id IS DISTINCT FROM response THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM r""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    index = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_records(index, folder)


@register("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@register("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), limit=2048)


@register("op4_minhash")
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=16)


@register("op6_embeddings")
def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


@register("op7_html_extraction")
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


@register("op8_decontamination")
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "removed_lines", "removed_chars")


@register("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_texts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


# CRC-32 in SQL: the table of the 256 byte values, and a fold of a text's bytes over it.
_CRC_SQL = """
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)), CAST(i AS BIGINT)) AS c
    FROM range(256) r(i)))"""


def _crc_sql(text: str) -> str:
    """CRC-32 of a text, where a column ``t`` of crc_table is in scope."""
    codes = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295)"


def _field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(concat(" + ", ".join(map(_field_sql, ["doc_id", "source", "lang", "n_chars", text])) + "))"


_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@register("op11_merkle", sql=f"""
WITH RECURSIVE {_CRC_SQL},
leaves AS (
  SELECT doc_id, source, {_leaf_sql('text')} AS leaf,
    CASE WHEN {_crc_sql('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {_leaf_sql(_LOWER_SQL)} ELSE {_leaf_sql('text')} END AS now
  FROM documents, crc_table),
ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY source) AS n
  FROM leaves),
below AS (
  SELECT 0 AS lv, s, r, n, leaf AS d FROM ranked
  UNION ALL
  SELECT lv + 1, s, r // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY r)) FROM below WHERE n > 1
  GROUP BY lv, s, r // 16, n),
subroots AS (SELECT s, lv AS height, d, count(*) OVER () AS n FROM below WHERE n = 1),
above AS (
  SELECT 0 AS lv, s AS r, n, d FROM subroots
  UNION ALL
  SELECT lv + 1, r // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY r)) FROM above WHERE n > 1 GROUP BY lv, r // 16, n),
places AS (
  SELECT s AS ps, r AS pr, k.lv, r // CAST(16 ** k.lv AS BIGINT) AS place, false AS up
  FROM ranked JOIN (SELECT s AS hs, unnest(range(height)) AS lv FROM subroots) k ON k.hs = s
  UNION ALL
  SELECT s, r, k.lv, s // CAST(16 ** k.lv AS BIGINT), true
  FROM ranked, (SELECT unnest(range(max(lv))) AS lv FROM above) k),
nodes AS (SELECT lv, s, r, d, false AS up FROM below UNION ALL SELECT lv, NULL, r, d, true FROM above),
steps AS (
  SELECT ps, pr, up, lv, row_number() OVER (PARTITION BY ps, pr ORDER BY up, lv) AS step, lhs, rhs
  FROM (SELECT ps, pr, p.up, p.lv, coalesce(string_agg(d, '' ORDER BY r) FILTER (WHERE r < place), '') AS lhs,
          coalesce(string_agg(d, '' ORDER BY r) FILTER (WHERE r > place), '') AS rhs
        FROM places p JOIN nodes n ON n.up = p.up AND n.lv = p.lv AND n.r // 16 = place // 16 AND (p.up OR n.s = ps)
        GROUP BY ps, pr, p.up, p.lv)),
folded AS (
  SELECT s, r, 0::BIGINT AS step, now AS d FROM ranked
  UNION ALL
  SELECT s, r, f.step + 1, sha256(concat(lhs, d, rhs)) FROM folded f JOIN steps t ON ps = s AND pr = r AND t.step = f.step + 1),
proofs AS (SELECT ps, pr, sha256(string_agg(lhs || rhs, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY ps, pr),
total AS (SELECT d AS root FROM above WHERE n = 1),
ends AS (SELECT s AS es, r AS er, arg_max(d, step) AS folded_root FROM folded GROUP BY s, r)
SELECT doc_id, leaf, b.d AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM ranked k JOIN subroots b ON b.s = k.s JOIN ends ON es = k.s AND er = k.r
LEFT JOIN proofs ON ps = k.s AND pr = k.r, total""")
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_documents(table(spark, sf_dir, "documents"))


@register("op12_spelling", sql=f"""
WITH RECURSIVE {_CRC_SQL},
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL),
summed AS (SELECT run, n, {_crc_sql("doc_id || ':' || run")} AS h FROM runs, crc_table),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
              ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM summed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
holes AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT w.word, h.word, h.n FROM words w JOIN holes h ON h.rest = w.word
  UNION SELECT h.word, w.word, w.n FROM words w JOIN holes h ON h.rest = w.word),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most, min(other) FILTER (WHERE other_n = top) AS first
  FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS top FROM near) GROUP BY word),
formed AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * n THEN first END AS form,
    CASE WHEN most >= 2 * n THEN most END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
ways AS (
  SELECT word, word AS place, form AS ahead FROM formed
  UNION ALL SELECT y.word, f.word, f.form FROM ways y JOIN formed f ON f.word = y.ahead)
SELECT f.word, n, n_near, form, form_n, place AS root FROM formed f JOIN ways y ON y.word = f.word AND y.ahead IS NULL""")
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(table(spark, sf_dir, "documents"))


#: The conversation that the query adds: both of its texts hold what templates use as marks.
_PROBE_TEXT = "\\### Assistant: </turn> ok"
_BROKEN_SQL = r"""replace(replace(replace({}, '\', '\\'), '<turn>', '<\turn>'), '</turn>', '<\/turn>')"""


@register("op13_chat_format", sql=f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '{_PROBE_TEXT}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
written AS (SELECT *, {_BROKEN_SQL.format('text')} AS body, replace({_BROKEN_SQL.format('role')}, chr(10), '<\\n>') AS head FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(head) + length(body) + 15) AS BIGINT) AS formatted_chars, CAST(NULL AS VARCHAR) AS fault
FROM written GROUP BY conv_id""")
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", _PROBE_TEXT), (-7, 1, "assistant", _PROBE_TEXT)], turns.schema)
    return chat_format.read_back(chat_format.format_turns(turns.unionByName(probe)))
