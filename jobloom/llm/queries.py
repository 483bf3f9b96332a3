"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm import bpe, chat, hard_negatives, language_id, lm_scoring, media, near_dedup, packing, prefix_trie, quality, sharding, token_files, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out() -> F.Column:
    return (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3) == 1


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~held_out()))
    return language_id.identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _vocabulary_path("byte_bpe_50k.tiktoken"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.pseudo_likelihood(_table(spark, sf_dir, "documents"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(_table(spark, sf_dir, "documents"), _vocabulary_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), 16)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(_table(spark, sf_dir, "conversations"))


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, rows.where(F.col("vec_id") % 100 == 0))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_of(prefix_trie.share_heads(prefix_trie.segments(_table(spark, sf_dir, "conversations"))))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_table(spark, sf_dir, "documents"), _vocabulary_path("byte_bpe_50k.tiktoken"))


def queries() -> dict[str, Query]:
    found = [
        op1_language_id, op2_best_fit_packing, op3_lm_scoring, op4_minhash_near_dedup, op5_byte_bpe,
        op6_quality_rules, op7_sharding, op8_warc, op9_chat_formatting, op10_media_columns, op11_hard_negatives,
        op12_prefix_trie, op13_token_files,
    ]
    return {f.__name__: f for f in found}


#: Equal payloads point to their smallest page; a SHA-1 is 32 groups of 5 bits, four for every 5 hex digits.
OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
 array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
 CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f"""


OP11_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
 FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS row_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5),
n AS (SELECT p.anchor_id, p.row_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.row_id ORDER BY s.score DESC, s.row_id) AS INTEGER) AS rank,
 s.row_id AS negative_id, p.score AS positive_score, s.score AS negative_score
 FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT * FROM n WHERE rank <= 10"""


#: CRC-32 bit by bit over the digits; nodes by the hash of all turns up to them; subtrees by pairs of a node and its ancestors on its owner's path.
OP12_SQL = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS r FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
u AS (SELECT c.conv_id, t.r AS place, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.r <= c.h
 UNION ALL SELECT c.conv_id, 1000000 + t.r, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.r > c.h),
s AS (SELECT conv_id, row_number() OVER w AS depth, sha256(string_agg(sha256(strlen(role) || ':' || role || text), '') OVER w) AS k, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
 FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY place)),
p AS (SELECT conv_id, depth, k, lag(k, 1, 'root') OVER (PARTITION BY conv_id ORDER BY depth) AS up, words FROM s UNION ALL SELECT conv_id, 0, 'root', NULL, 0 FROM c),
n AS (SELECT k, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(up) AS up, count(*) AS n_convs, any_value(words) AS words FROM p GROUP BY k),
kids AS (SELECT up, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids ON kids.up = n.k),
subs AS (SELECT a.k, count(*) FILTER (m.n_children = 0) AS n_leaves, sum((m.n_convs - 1) * m.words) AS saved FROM m JOIN p a ON a.conv_id = m.conv_id AND a.depth <= m.depth GROUP BY a.k),
ends AS (SELECT k, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) GROUP BY k)
SELECT m.conv_id, CAST(m.depth AS BIGINT) AS depth, b.conv_id AS parent_conv_id, m.n_convs, m.n_children, subs.n_leaves, CAST(saved AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM m JOIN subs USING (k) LEFT JOIN ends USING (k) LEFT JOIN n b ON b.k = m.up"""


def oracle_sql() -> dict[str, str]:
    """The others need CRC-32, tokenizers, models or components of links, which DuckDB has not; tests hold them against brute force."""
    return {"op8_warc": OP8_SQL, "op11_hard_negatives": OP11_SQL, "op12_prefix_trie": OP12_SQL}
