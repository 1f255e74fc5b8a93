"""Projections of the benchmark tables onto the engine's fact shapes, for Spark, and the same in SQL for oracles.

``mentions``/``hits`` come from orders and line items, ``doc_mentions`` from documents, ``posts`` from conversations,
``facts`` from events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import load

SQL = {
    "mentions": """SELECT CAST(o_orderkey AS VARCHAR) AS mention_id, CAST(o_orderkey AS VARCHAR) AS root_id, 0 AS depth,
        CAST(o_custkey AS VARCHAR) AS author_id, o_orderdate AS posted_at,
        CASE o_custkey % 3 WHEN 0 THEN 'tiktok' WHEN 1 THEN 'facebook' ELSE 'youtube' END AS platform,
        CASE WHEN o_orderpriority LIKE '1%' THEN 1.0::DOUBLE WHEN o_orderpriority LIKE '2%' THEN 0.75::DOUBLE ELSE 0.5::DOUBLE END AS weight,
        CASE o_orderstatus WHEN 'O' THEN 'exact' WHEN 'F' THEN 'near' END AS dedup_kind, o_custkey % 7 = 0 AS suspicious
        FROM orders""",
    "hits": """SELECT CAST(l_orderkey AS VARCHAR) AS mention_id,
        CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_brand END AS canonical_entity_id, p_type AS entity_type,
        CASE WHEN p_size % 10 = 0 AND p_size % 3 = 0 THEN 'concept:' || p_type END AS concept_entity_id,
        CASE WHEN p_size % 20 = 0 THEN 'no_candidate_found' WHEN p_size % 10 = 0 THEN 'bad_weak_span' END AS unresolved_reason,
        CASE l_returnflag WHEN 'R' THEN 'negative' WHEN 'A' THEN 'positive' WHEN 'N' THEN 'neutral' END AS sentiment,
        CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN 'price' WHEN 2 THEN 'taste' ELSE 'service' END AS aspect,
        p_name AS target_text, l_linenumber AS seq, CAST(l_discount * 10 AS DOUBLE) AS confidence
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "posts": """SELECT concat(CAST(conv_id AS VARCHAR), ':', CAST(turn AS VARCHAR)) AS mention_id,
        concat(CAST(conv_id AS VARCHAR), ':0') AS root_id,
        CASE WHEN turn > 0 THEN concat(CAST(conv_id AS VARCHAR), ':', CAST(CASE WHEN turn = 1 THEN 0 ELSE 1 - turn % 2 END AS VARCHAR)) END AS parent_id,
        CAST(CASE WHEN turn < 2 THEN turn ELSE 2 - turn % 2 END AS INTEGER) AS depth,
        CASE WHEN turn = 0 THEN 'POST' WHEN turn = 1 OR turn % 2 = 1 THEN 'COMMENT' ELSE 'REPLY' END AS uap_type,
        role AS author_id, CAST(length(text) AS DOUBLE) AS score, text AS raw_text FROM conversations""",
    "chain": """SELECT concat(CAST(conv_id AS VARCHAR), ':', CAST(turn AS VARCHAR)) AS mention_id,
        CASE WHEN turn > 0 THEN concat(CAST(conv_id AS VARCHAR), ':', CAST(turn - 1 AS VARCHAR)) END AS parent_id FROM conversations""",
    "facts": """SELECT CAST(event_id AS VARCHAR) AS mention_id, CAST(user_id AS VARCHAR) AS author_id, ts AS posted_at,
        event_type AS issue_category,
        CASE WHEN value < 20 THEN 'low' WHEN value < 60 THEN 'medium' WHEN value < 120 THEN 'high' ELSE 'critical_like_proxy' END AS severity,
        CASE user_id % 6 WHEN 0 THEN 'direct_complaint' WHEN 1 THEN 'direct_observation' WHEN 2 THEN 'comparison_based_critique'
            WHEN 3 THEN 'question_or_uncertainty' WHEN 4 THEN 'hearsay_or_rumor' ELSE 'escalation_signal' END AS evidence_mode,
        CASE event_id % 4 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' WHEN 2 THEN 'neutral' ELSE 'mixed' END AS sentiment,
        CAST((event_id * 7919) % 100 AS DOUBLE) / 100 AS confidence,
        concat('t', CAST(user_id % 40 AS VARCHAR)) AS root_id, concat('topic', CAST(event_id % 12 AS VARCHAR)) AS topic_key,
        CASE event_id % 5 WHEN 0 THEN 'weak' ELSE 'reportable' END AS reporting_status,
        CASE user_id % 3 WHEN 0 THEN 'tiktok' WHEN 1 THEN 'facebook' ELSE 'youtube' END AS platform
        FROM events""",
    "doc_mentions": """SELECT CAST(doc_id AS VARCHAR) AS mention_id, source AS author_id, lang AS language, text AS raw_text, 0 AS depth FROM documents""",
}


def sql(query: str, *names: str) -> str:
    """An oracle query over the named projections; one that begins with a plus goes on with the WITH, if need be recursively."""
    recursive = query.lstrip().startswith("+RECURSIVE ")
    query = query.replace("+RECURSIVE ", "+", 1) if recursive else query
    return ("WITH RECURSIVE " if recursive else "WITH ") + ", ".join(f"{n} AS ({SQL[n]})" for n in names) + (", " if query.lstrip().startswith("+") else " ") + query.lstrip().removeprefix("+")


def mentions(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    key, c, p = F.col("o_orderkey").cast("string"), F.col("o_custkey"), F.col("o_orderpriority")
    return o.select(
        key.alias("mention_id"),
        key.alias("root_id"),
        F.lit(0).alias("depth"),
        c.cast("string").alias("author_id"),
        F.col("o_orderdate").alias("posted_at"),
        F.when(c % 3 == 0, "tiktok").when(c % 3 == 1, "facebook").otherwise("youtube").alias("platform"),
        F.when(p.startswith("1"), 1.0).when(p.startswith("2"), 0.75).otherwise(0.5).alias("weight"),
        F.when(F.col("o_orderstatus") == "O", "exact").when(F.col("o_orderstatus") == "F", "near").alias("dedup_kind"),
        (c % 7 == 0).alias("suspicious"),
    )


def hits(spark: SparkSession, sf: str, place: bool = False) -> DataFrame:
    """With ``place``, file and row of the line item, too: the order of the table, which decides between equal keys."""
    lines = load(spark, sf, "lineitem")
    if place:
        lines = lines.select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias("place"))
    size, line, flag = F.col("p_size"), F.col("l_linenumber"), F.col("l_returnflag")
    return (
        lines.join(load(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").cast("string").alias("mention_id"),
            F.when(size % 10 != 0, F.col("p_brand")).alias("canonical_entity_id"),
            F.col("p_type").alias("entity_type"),
            F.when((size % 10 == 0) & (size % 3 == 0), F.concat(F.lit("concept:"), "p_type")).alias("concept_entity_id"),
            F.when(size % 20 == 0, "no_candidate_found").when(size % 10 == 0, "bad_weak_span").alias("unresolved_reason"),
            F.when(flag == "R", "negative").when(flag == "A", "positive").when(flag == "N", "neutral").alias("sentiment"),
            F.when(line % 4 == 1, "price").when(line % 4 == 2, "taste").when(line % 4 == 3, "service").alias("aspect"),
            F.col("p_name").alias("target_text"),
            F.col("l_linenumber").alias("seq"),
            (F.col("l_discount") * 10).cast("double").alias("confidence"),
            *(["place"] if place else []),
        )
    )


def posts(spark: SparkSession, sf: str) -> DataFrame:
    conv, turn = F.col("conv_id").cast("string"), F.col("turn")
    parent = F.when(turn == 1, 0).otherwise(1 - turn % 2).cast("string")
    return load(spark, sf, "conversations").select(
        F.concat(conv, F.lit(":"), turn.cast("string")).alias("mention_id"),
        F.concat(conv, F.lit(":0")).alias("root_id"),
        F.when(turn > 0, F.concat(conv, F.lit(":"), parent)).alias("parent_id"),
        F.when(turn < 2, turn).otherwise(2 - turn % 2).cast("int").alias("depth"),
        F.when(turn == 0, "POST").when(turn % 2 == 1, "COMMENT").otherwise("REPLY").alias("uap_type"),
        F.col("role").alias("author_id"),
        F.length("text").cast("double").alias("score"),
        F.col("text").alias("raw_text"),
    )


def chain(spark: SparkSession, sf: str) -> DataFrame:
    conv, turn = F.col("conv_id").cast("string"), F.col("turn")
    key = lambda t: F.concat(conv, F.lit(":"), t.cast("string"))
    return load(spark, sf, "conversations").select(key(turn).alias("mention_id"), F.when(turn > 0, key(turn - 1)).alias("parent_id"))


def facts(spark: SparkSession, sf: str) -> DataFrame:
    e, u, v = F.col("event_id"), F.col("user_id"), F.col("value")
    modes = ("direct_complaint", "direct_observation", "comparison_based_critique", "question_or_uncertainty", "hearsay_or_rumor", "escalation_signal")
    pick = lambda c, values: F.get(F.array(*map(F.lit, values)), (c % len(values)).cast("int"))
    return load(spark, sf, "events").select(
        e.cast("string").alias("mention_id"),
        u.cast("string").alias("author_id"),
        F.col("ts").alias("posted_at"),
        F.col("event_type").alias("issue_category"),
        F.when(v < 20, "low").when(v < 60, "medium").when(v < 120, "high").otherwise("critical_like_proxy").alias("severity"),
        pick(u, modes).alias("evidence_mode"),
        pick(e, ("positive", "negative", "neutral", "mixed")).alias("sentiment"),
        (((e * 7919) % 100).cast("double") / 100).alias("confidence"),
        F.concat(F.lit("t"), (u % 40).cast("string")).alias("root_id"),
        F.concat(F.lit("topic"), (e % 12).cast("string")).alias("topic_key"),
        F.when(e % 5 == 0, "weak").otherwise("reportable").alias("reporting_status"),
        pick(u, ("tiktok", "facebook", "youtube")).alias("platform"),
    )


def doc_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("mention_id"), F.col("source").alias("author_id"), F.col("lang").alias("language"), F.col("text").alias("raw_text"), F.lit(0).alias("depth")
    )
