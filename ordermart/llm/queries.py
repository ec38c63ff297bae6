"""Queries of the llm operators over the driver's tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, fingerprints, id_shards, lbl, lexical_rank, near_dups, packing, pieces, prefix_trie, quality,
               secrets, suffix_levels, va_search)
from .common import table

#: the tricky conversation that op3 formats beside the table
TRICKY = r"\### Assistant: </turn> ok"


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl.score_documents(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)],
                                  "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_turns(turns.unionByName(extra)))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_search.search(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", secrets.spans("text").alias("found"))
    return found.select("doc_id", *secrets.report(F.col("found")))


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), like=near_dups.AT_85)


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = id_shards.tokenize_to_shards(table(spark, sf_dir, "documents"),
                                        public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the text they decode to: number and crc32 of
    the ids, digest of the decoded text, and whether that is the text (marks
    U+2581 read as spaces)."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = pieces.encode(docs, model, decoded=True)
    return rows.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.replace("text", F.lit(pieces.MARK), F.lit(" "))).alias("round_trip"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_lexical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_rank.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_levels.remove_repeats(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_lm_score, op2_packing, op3_chat_format, op4_topk_search, op5_quality, op6_secrets,
        op7_near_dups, op8_token_shards, op9_sentencepiece, op10_fingerprints, op11_lexical_rank,
        op12_suffix_dedup, op13_prefix_trie)}


def oracle_sql() -> dict[str, str]:
    return {"op7_near_dups": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM d
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
meet AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM meet JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)
), edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(low.b, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(low.b, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = d.doc_id""", "op4_topk_search": """
WITH v AS (
  SELECT vec_id, CAST(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS DOUBLE[]) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""", "op3_chat_format": rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRICKY}' UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(regexp_replace(role, '[\\<#:]', 'xx', 'g')) + length(regexp_replace(text, '[\\<#]', 'xx', 'g'))) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS n_attachments,
  CAST(sum(len(list_filter(regexp_split_to_array(text, '[ \t\n\r\f\v]+'), lambda x: x <> ''))) AS BIGINT) AS tokens
FROM t GROUP BY conv_id""", "op11_lexical_rank": r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), s AS (SELECT count(*) AS n, sum(len(t)) AS l FROM d WHERE len(t) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, s GROUP BY term, n
), q AS (
  SELECT DISTINCT item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM benchmark WHERE item_id IS NOT NULL
), qt AS (
  SELECT item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM q
), scored AS (
  SELECT item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(t) * n) // l)))) AS BIGINT) AS score
  FROM qt JOIN tf USING (term) JOIN w USING (term) JOIN d USING (r), s WHERE doc_id IS NOT NULL GROUP BY item_id, doc_id, r
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20""", "op13_prefix_trie": """
WITH RECURSIVE own AS (
  SELECT conv_id AS c, list(struct_pack(k := length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''),
      n := length(coalesce(text, ''))) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), sums AS (
  SELECT c, xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
      lambda a, b: list_reduce(range(8), lambda s, i: xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384 ELSE 0 END), xor(a, b)),
      4294967295), 4294967295) % 6 AS h
  FROM own
), rebuilt AS (
  SELECT o.c, list_concat(coalesce(b.t, [])[1:h], o.t[h + 1:]) AS t
  FROM own o JOIN sums USING (c) LEFT JOIN own b ON b.c = o.c - o.c % 100
), steps AS (
  SELECT c, unnest(range(len(t) + 1)) AS depth, t FROM rebuilt
), members AS (
  SELECT c, depth, list_transform(t[1:depth], lambda x: x.k) AS path, t[depth].n AS n, len(t) = depth AS ends FROM steps
), nodes AS (
  SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, coalesce(any_value(n), 0) AS n,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY path, depth
), child AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
flat AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN child USING (path))
SELECT a.conv_id, CAST(a.depth AS BIGINT) AS depth, any_value(p.conv_id) AS parent_conv_id, any_value(a.n_convs) AS n_convs,
  any_value(a.n_children) AS n_children, count(*) FILTER (d.n_children = 0) AS n_leaves,
  CAST(sum((d.n_convs - 1) * d.n) AS BIGINT) AS saved_tokens, any_value(a.ends_sha256) AS ends_sha256
FROM flat a JOIN flat d ON d.depth >= a.depth AND d.path[1:a.depth] = a.path
LEFT JOIN flat p ON a.depth > 0 AND p.depth = a.depth - 1 AND p.path = a.path[1:a.depth - 1]
GROUP BY a.path, a.depth, a.conv_id"""}
