"""The registered queries of the text operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    byte_bpe,
    conversation_trie,
    decontamination,
    language_id,
    near_dedup,
    packing,
    perplexity,
    personal_data,
    quality_rules,
    repair_files,
    substring_dedup,
    toxicity,
    whitening,
)
from shelfmark.llm.common import held_out, read_table, working_path

SEQUENCE = 1024  # tokens of a packed sequence
SEQUENCE_END = 2
FILE_END = 1


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    prototypes = language_id.fit(docs.where(~held_out(F.col("doc_id"))))
    return language_id.identify(docs.select("doc_id", "text"), prototypes).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score"
    )


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = working_path(spark, "token-files")
    repair_files.write(read_table(spark, folder, "documents"), path, tokenizer_path("word_bpe_49k.json"), FILE_END)
    return repair_files.read(spark, path)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    trained = docs.where(~held_out(F.col("doc_id")))
    model = toxicity.fit(trained, read_table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    labels = read_table(spark, folder, "labels")
    return perplexity.judge(read_table(spark, folder, "documents"), labels.where("quality = 1").select("doc_id"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return packing.packed_documents(docs, tokenizer_path("byte_bpe_50k.json"), SEQUENCE_END, SEQUENCE)


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules.ledger(read_table(spark, folder, "documents"))
    base_failed = ~quality_rules.passes("base")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & quality_rules.passes(quality_rules.CURRENT)).alias("kept"),
        "failures",
    )


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that hold a repeated passage, their own or one of other documents."""
    return substring_dedup.documents(read_table(spark, folder, "documents")).select(
        "doc_id", "n_passages", "longest_shared", "repeated_words", "removed_words",
        F.xxhash64("removed_spans").alias("removed_spans_hash"),
    )


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.find(read_table(spark, folder, "documents"))


def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, folder, "documents"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The test items that each document leaks."""
    return decontamination.leaks(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    )


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.conversation_trie(read_table(spark, folder, "conversations"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read_table(spark, folder, "embeddings"))


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(read_table(spark, folder, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_token_files": op2_token_files,
    "op3_toxicity": op3_toxicity,
    "op4_perplexity": op4_perplexity,
    "op5_packing": op5_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_personal_data": op7_personal_data,
    "op8_near_dedup": op8_near_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_whitening": op12_whitening,
    "op13_byte_bpe": op13_byte_bpe,
}
# A statement for a table of CRC-32 remainders; DuckDB has no such function.
_CRC_TABLE = """
crc_steps(byte, step, value) AS (
    SELECT i, 0, i FROM range(256) t(i)
    UNION ALL
    SELECT byte, step + 1, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END
    FROM crc_steps WHERE step < 8
),
crc_table AS (SELECT list(value ORDER BY byte) AS entries FROM crc_steps WHERE step = 8)
"""

OP11 = f"""
WITH RECURSIVE {_CRC_TABLE},
own AS (
    SELECT conv_id, role, text, sha256(concat(strlen(role), ':', role, text))[:32] AS id,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(concat(strlen(role), ':', role, text))) AS place
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
          FROM conversations WHERE conv_id IS NOT NULL)
),
members AS (
    SELECT conv_id, conv_id - conv_id % 100 AS head, xor(list_reduce(
        list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
        lambda crc, byte: xor(crc >> 8, entries[(xor(crc, byte) & 255) + 1]), 4294967295), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM own), crc_table
),
rebuilt AS (
    SELECT m.conv_id, 0 AS part, o.place, o.id, length(o.text) AS chars
    FROM members m JOIN own o ON o.conv_id = m.head AND o.place <= m.h
    UNION ALL
    SELECT m.conv_id, 1, o.place, o.id, length(o.text) FROM members m JOIN own o ON o.conv_id = m.conv_id AND o.place > m.h
),
paths AS (
    SELECT conv_id, chars, row_number() OVER w AS depth, string_agg(id, '') OVER w AS path
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)
    UNION ALL
    SELECT conv_id, 0, 0, '' FROM members
),
lasts AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
nodes AS (
    SELECT path, any_value(p.depth) AS depth, min(p.conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * any_value(chars) AS saved,
           sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (p.depth = l.depth), '')) AS ends_sha256
    FROM paths p JOIN lasts l ON l.conv_id = p.conv_id GROUP BY path
),
counted AS (
    SELECT n.*, up.conv_id AS parent_conv_id,
           (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.path[:32 * n.depth] = n.path) AS n_children
    FROM nodes n LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.path = n.path[:32 * (n.depth - 1)]
),
ancestors AS (
    SELECT path[:32 * d] AS path, saved, n_children FROM counted, LATERAL (SELECT unnest(range(depth + 1)) AS d)
),
subtrees AS (
    SELECT path, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
    FROM ancestors GROUP BY path
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM counted JOIN subtrees USING (path)
"""

SQL: dict[str, str] = {"op11_conversation_trie": OP11}
