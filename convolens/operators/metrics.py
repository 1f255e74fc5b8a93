"""Metric families over fact tables: volumes, shares of voice, concentrations, distributions, issue rates.

Every function takes fact DataFrames and gives rows with exact counts and ratios.  Totals ride along as windows over
aggregated rows or as one-row cross joins, never as driver-side values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import ratio, round_to

LOW_CONFIDENCE = 0.45
CONFIRMED = ("direct_complaint", "direct_observation")
UNCERTAIN = ("question_or_uncertainty", "hearsay_or_rumor")
SEVERE = ("high", "critical_like_proxy")

def _n() -> Column:
    return F.count(F.lit(1))


def with_total(df: DataFrame, total: DataFrame) -> DataFrame:
    """Attach a one-row table."""
    return df.crossJoin(F.broadcast(total))


def share_of_voice(hits: DataFrame, mentions: DataFrame, basis: str = "mentions") -> DataFrame:
    """(canonical_entity_id, mention_count, entity_hit_count, ratio); basis picks the denominator: all ``mentions``,
    entity ``hits``, or ``resolved`` mentions."""
    resolved = hits.where("canonical_entity_id is not null")
    rows = resolved.groupBy("canonical_entity_id").agg(F.count_distinct("mention_id").alias("mention_count"), _n().alias("entity_hit_count"))
    total = {"mentions": mentions.agg(_n().alias("total")), "hits": resolved.agg(_n().alias("total")), "resolved": resolved.agg(F.count_distinct("mention_id").alias("total"))}[basis]
    part = "entity_hit_count" if basis == "hits" else "mention_count"
    return with_total(rows, total).withColumn("ratio", ratio(F.col(part), F.greatest("total", F.lit(1)))).drop("total")


def volumes(mentions: DataFrame, weight: str = "weight") -> DataFrame:
    """One row: raw and weighted volume, duplicate and suspicion rates."""
    flag = lambda c: F.count_if(c)
    row = mentions.agg(
        _n().alias("mention_volume"),
        round_to(F.coalesce(F.sum(weight), F.lit(0.0))).alias("weighted_volume"),
        flag(F.col("dedup_kind") == "exact").alias("exact"),
        flag(F.col("dedup_kind") == "near").alias("near"),
        flag(F.col("suspicious")).alias("suspicious"),
    )
    volume = F.col("mention_volume")
    return row.select(
        "mention_volume", "weighted_volume", ratio(F.col("exact") + F.col("near"), volume).alias("duplicate_rate"), ratio(F.col("exact"), volume).alias("exact_duplicate_rate"),
        ratio(F.col("near"), volume).alias("near_duplicate_rate"), ratio(F.col("suspicious"), volume).alias("spam_suspicion_rate"),
    )


def target_rates(hits: DataFrame, mentions: DataFrame) -> DataFrame:
    """One row: share of mentions with a resolved entity, and with a concept."""
    seen = lambda c: F.count_distinct(F.when(F.col(c).isNotNull(), F.col("mention_id")))
    row = hits.agg(seen("canonical_entity_id").alias("resolved"), seen("concept_entity_id").alias("concept"))
    row = with_total(row, mentions.agg(_n().alias("total")))
    return row.select(ratio(F.col("resolved"), F.col("total")).alias("resolved_entity_mention_rate"), ratio(F.col("concept"), F.col("total")).alias("concept_target_mention_rate"))


def low_confidence_rate(tables: list[DataFrame], mentions: DataFrame) -> DataFrame:
    """One row: share of mentions with a fact below LOW_CONFIDENCE in any of ``tables``."""
    low = [t.where(F.col("confidence") < LOW_CONFIDENCE).select("mention_id") for t in tables]
    row = reduce(DataFrame.union, low).agg(F.count_distinct("mention_id").alias("low_confidence_mentions"))
    row = with_total(row, mentions.agg(_n().alias("total")))
    return row.select("low_confidence_mentions", ratio(F.col("low_confidence_mentions"), F.col("total")).alias("reviewable_low_confidence_rate"))


def concentration(df: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys, the largest share, and the sum of squared shares."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(_n().alias("n"))
    # Sums of counts stay exact whole numbers; the shares follow from them.
    row = counts.agg(F.count(F.lit(1)).alias("count"), F.max("n").alias("top"), F.sum("n").alias("total"), F.sum((F.col("n") * F.col("n")).cast("decimal(38,0)")).alias("squares"))
    total = F.col("total").cast("double")
    return row.select(
        F.col("count"), F.when(total > 0, round_to(F.col("top") / total)).otherwise(0.0).alias("top_share"), F.when(total > 0, round_to(F.col("squares").cast("double") / (total * total))).otherwise(0.0).alias("hhi_proxy")
    )


def leaders(df: DataFrame, key: str, limit: int = 5) -> DataFrame:
    """The ``limit`` keys with most rows and their shares; ties by key."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(_n().alias("count"))
    total = counts.agg(F.sum("count").alias("total"))
    return with_total(counts.orderBy(F.desc("count"), key).limit(limit), total).select(key, "count", ratio(F.col("count"), F.col("total")).alias("ratio"))


def suspicious_authors(mentions: DataFrame) -> DataFrame:
    """One row: suspicious mentions, their share of all, and the share of the largest author among them."""
    by_author = mentions.where("suspicious").groupBy("author_id").agg(_n().alias("n"))
    row = with_total(by_author.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.max("n").alias("top")), mentions.agg(_n().alias("total")))
    return row.select("count", ratio(F.col("count"), F.col("total")).alias("suspicious_author_share"), F.coalesce(ratio(F.col("top"), F.col("count")), F.lit(0.0)).alias("top_share"))


def distribution(df: DataFrame, key: str, of_all: bool = False) -> DataFrame:
    """(key, count, ratio) of non-null values, to their own total or (``of_all``) to all rows."""
    total = df.agg((_n() if of_all else F.count(key)).alias("total"))
    return with_total(df.where(F.col(key).isNotNull()).groupBy(key).agg(_n().alias("count")), total).select(key, "count", ratio(F.col("count"), F.col("total")).alias("ratio"))


def business_target(df: DataFrame) -> DataFrame:
    """Adds target_key and target_kind: the entity, else the concept, else only a surface form."""
    entity, concept = F.col("canonical_entity_id"), F.col("concept_entity_id")
    kind = F.when(entity.isNotNull(), "canonical_entity").when(concept.isNotNull(), "concept").otherwise("surface")
    return df.withColumn("target_key", F.coalesce(entity, concept)).withColumn("target_kind", kind)


def _within(counts: DataFrame, key: str, total: str) -> DataFrame:
    counts = counts.withColumn(total, F.sum("count").over(Window.partitionBy(key)))
    return counts.withColumn("ratio", ratio(F.col("count"), F.col(total)))


def target_sentiment(df: DataFrame) -> DataFrame:
    """Sentiment counts and shares of each business target, with the first text (by mention, place) that names it."""
    cols = ["target_key", "target_kind", "canonical_entity_id", "concept_entity_id", "entity_type"]
    rows = business_target(df).where("target_key is not null and sentiment is not null")
    text = F.min_by("target_text", F.struct("mention_id", "seq", "target_text"))
    return _within(rows.groupBy(*cols, "sentiment").agg(_n().alias("count"), text.alias("representative_target_text")), "target_key", "target_total")


def target_sentiment_forensic(df: DataFrame) -> DataFrame:
    """The same for every surface form."""
    rows = df.where("target_text is not null and sentiment is not null")
    counts = rows.groupBy("target_text", "canonical_entity_id", "concept_entity_id", "entity_type", "sentiment").agg(_n().alias("count"))
    return _within(counts, "target_text", "target_total")


def aspect_occurrences(df: DataFrame) -> DataFrame:
    return df.where("aspect is not null").groupBy("aspect").agg(_n().alias("count"))


def aspect_targets(df: DataFrame) -> DataFrame:
    rows = business_target(df).where("aspect is not null and target_key is not null")
    return rows.groupBy("aspect", "target_key", "canonical_entity_id", "concept_entity_id", "target_kind").agg(_n().alias("count"), F.min_by("target_text", F.struct("mention_id", "seq", "target_text")).alias("representative_target_text"))


def aspect_targets_forensic(df: DataFrame) -> DataFrame:
    return df.where("aspect is not null and target_text is not null").groupBy("aspect", "target_text", "canonical_entity_id").agg(_n().alias("count"))


def aspect_sentiment(df: DataFrame, resolved_only: bool = False) -> DataFrame:
    rows = df.where("aspect is not null and sentiment is not null")
    rows = rows.where("canonical_entity_id is not null") if resolved_only else rows
    return _within(rows.groupBy("aspect", "sentiment").agg(_n().alias("count")), "aspect", "aspect_total")


def issue_rates(issues: DataFrame, mentions: DataFrame) -> DataFrame:
    counts = issues.where("issue_category is not null").groupBy("issue_category").agg(_n().alias("count"))
    return with_total(counts, mentions.agg(_n().alias("mention_total"))).withColumn("ratio", ratio(F.col("count"), F.col("mention_total")))


def issue_class_ratio(issues: DataFrame, condition: Column, needed: str) -> DataFrame:
    """Share of each issue's facts that meet ``condition``, among those with a value in ``needed``."""
    rows = issues.where(F.col("issue_category").isNotNull() & F.col(needed).isNotNull())
    out = rows.groupBy("issue_category").agg(_n().alias("issue_total"), F.count_if(condition).alias("count"))
    return out.withColumn("ratio", ratio(F.col("count"), F.col("issue_total")))


def confirmed(issues: DataFrame) -> DataFrame:
    return issue_class_ratio(issues, F.col("evidence_mode").isin(*CONFIRMED), "evidence_mode")


def direct_complaints(issues: DataFrame) -> DataFrame:
    return issue_class_ratio(issues, F.col("evidence_mode") == "direct_complaint", "evidence_mode")


def uncertain(issues: DataFrame) -> DataFrame:
    return issue_class_ratio(issues, F.col("evidence_mode").isin(*UNCERTAIN), "evidence_mode")


def severe(issues: DataFrame) -> DataFrame:
    return issue_class_ratio(issues, F.col("severity").isin(*SEVERE), "severity")


def interaction_structure(threads: DataFrame) -> DataFrame:
    """One row: replies to comments, and depth to mentions, over all threads."""
    row = threads.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("reply_count", "comment_count", "max_depth_observed", "total_mentions")))
    return row.select(
        ratio(F.col("reply_count"), F.col("comment_count")).alias("reply_to_comment_ratio_proxy"), ratio(F.col("max_depth_observed"), F.col("total_mentions")).alias("interaction_recursion_proxy")
    )


def source_ratios(mentions: DataFrame, column: str = "language_source", explicit: str = "explicit") -> DataFrame:
    """One row: shares of mentions whose language was given, and inferred."""
    row = mentions.agg(_n().alias("n"), F.count_if(F.col(column) == explicit).alias("given"), F.count_if(F.col(column).isNotNull() & (F.col(column) != explicit)).alias("guessed"))
    return row.select(ratio(F.col("given"), F.col("n")).alias("explicit_language_ratio"), ratio(F.col("guessed"), F.col("n")).alias("inferred_language_ratio"))


def batch_totals(clusters: DataFrame, aspects: DataFrame) -> DataFrame:
    """One row: batch_candidate_cluster_count and aspect_fact_total (facts that name an aspect)."""
    return with_total(clusters.agg(_n().alias("batch_candidate_cluster_count")), aspects.agg(F.count("aspect").alias("aspect_fact_total")))


def representative_text(df: DataFrame, keys: list[str], text: str, order: list[str]) -> DataFrame:
    """(keys, count, representative): rows of each group and its first text that isn't null by ``order``, nulls last."""
    places = (c for name in order for c in (F.col(name).isNull(), F.col(name)))
    first = F.min_by(F.col(text), F.when(F.col(text).isNotNull(), F.struct(*places)))
    return df.groupBy(*keys).agg(_n().alias("count"), first.alias("representative"))


def with_columns_as_null(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` with those of ``columns`` (name: type) that it lacks, as null."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns})


def window_label(start: Column, end: Column) -> Column:
    """``start`` to ``end`` as ISO dates and times, or all_time where one is missing."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.coalesce(F.concat(iso(start), F.lit(" to "), iso(end)), F.lit("all_time"))


def ranked_authors(profiles: DataFrame, limit: int | None = None) -> DataFrame:
    """profiles by author_inorganic_score, then mentions, then id."""
    rows = profiles.orderBy(F.desc("author_inorganic_score"), F.desc("mention_count"), "author_id")
    return rows if limit is None else rows.limit(limit)


def ranked_clusters(clusters: DataFrame, limit: int | None = None) -> DataFrame:
    """Clusters of open texts by mentions, then text."""
    rows = clusters.orderBy(F.desc("mention_count"), "text")
    return rows if limit is None else rows.limit(limit)
