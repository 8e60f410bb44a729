"""Registered queries of this subpackage and the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duelmetrics.llm import (
    chat,
    clustering,
    conversation_repair,
    decontaminate,
    exact_dedup,
    language_id,
    license_scan,
    mixing,
    near_dedup,
    pii,
    quality,
    secrets,
    warc,
)
from duelmetrics.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents")).drop("text_hash")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licences(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def op8_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_digests(table(spark, sf_dir, "conversations"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clusters(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damaged_and_repaired(table(spark, sf_dir, "conversations"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_flags(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_near_dedup": op4_near_dedup,
    "op5_personal_data": op5_personal_data,
    "op6_license_scan": op6_license_scan,
    "op7_mixing": op7_mixing,
    "op8_warc_revisit": op8_warc_revisit,
    "op9_chat_format": op9_chat_format,
    "op10_secrets": op10_secrets,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_quality_rules": op13_quality_rules,
}

ORACLES = {
    "op2_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_license_scan": license_scan.oracle_sql(),
    "op7_mixing": """
        WITH sized AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                   ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS key0,
                   ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS key1
            FROM documents
        ), totals AS (
            SELECT source, sum(size)::BIGINT AS total,
                   [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
            FROM sized GROUP BY source
        ), opened AS (
            SELECT *, 2.0::DOUBLE * total AS room, 2.0::DOUBLE * total / weight AS fills,
                   (sum(total) OVER ()::DOUBLE * 1.5::DOUBLE
                    - coalesce(sum(2.0::DOUBLE * total) OVER earlier, 0))
                   / sum(weight) OVER later AS open
            FROM totals
            WINDOW earlier AS (ORDER BY 2.0::DOUBLE * total / weight, source NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   later AS (ORDER BY 2.0::DOUBLE * total / weight, source NULLS LAST
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        ), level AS (
            SELECT coalesce(arg_min(open, fills) FILTER (open <= fills), max(fills)) AS level FROM opened
        ), queued AS (
            SELECT s.*, o.total, o.weight, least(o.weight * level, o.room) AS target,
                   sum(size) OVER (PARTITION BY s.source ORDER BY key0, key1
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS sent
            FROM sized s JOIN opened o ON s.source IS NOT DISTINCT FROM o.source CROSS JOIN level
        )
        SELECT doc_id, size, total AS source_size, target,
               greatest(0, least(size, round(target)::BIGINT - (sent - size)))
               + greatest(0, least(size, round(target)::BIGINT - (sent - size) - total)) AS taken,
               sent / weight AS finish
        FROM queued
    """,
    "op8_warc_revisit": """
        WITH hashed AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
        ), coded AS (
            SELECT page_id, html, strlen(html)::BIGINT AS payload_bytes,
                   array_to_string(list_transform(range(0, 32), lambda i: substr(
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       1 + ((('0x' || substr(hex, 1 + (i // 4) * 5, 5))::INTEGER
                             >> (15 - 5 * (i % 4))::INTEGER) & 31), 1)), '') AS payload_digest,
                   max(page_id) OVER (PARTITION BY html) AS original
            FROM hashed
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> original THEN original END AS refers_to
        FROM coded
    """,
    "op9_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -7, turn, role, '\### Assistant: </turn> ok'
            FROM (VALUES (0, 'user'), (1, 'assistant')) AS control(turn, role)
        ), sized AS (
            SELECT *, length('### ' || role || ':' || chr(10) || text || '</turn>' || chr(10))
                + length(text) - length(replace(text, chr(92), ''))
                + coalesce(list_sum(list_transform(
                    regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0)
                + len(regexp_extract_all(text, '</turn>')) AS chars
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), ''))
                   AS loss_sha256,
               sum(chars)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op11_centroid_clusters": clustering.oracle_sql(),
    "op12_conversation_repair": conversation_repair.oracle_sql(),
}
