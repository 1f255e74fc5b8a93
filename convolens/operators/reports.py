"""Business reports: share of voice, buzz, emerging topics, issue pressure, controversy, creators and sources, cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import growth, ratio, round_to
from .halves import earlier_half
from .metrics import with_total

TOP = 10
CONTROVERSIAL = 0.35

# Weights of issue pressure and of the controversy score.
SEVERITY_WEIGHT = {"low": 0.6, "medium": 1.0, "high": 1.45, "critical_like_proxy": 1.8}
EVIDENCE_WEIGHT = {
    "direct_complaint": 1.0,
    "direct_observation": 0.95,
    "comparison_based_critique": 0.8,
    "question_or_uncertainty": 0.55,
    "hearsay_or_rumor": 0.45,
    "escalation_signal": 1.15,
}
CONTROVERSY_WEIGHT = {"reply_density": 0.28, "recursion": 0.24, "mixed_sentiment": 0.24, "author_diversity": 0.14, "issue_diversity": 0.10}

def _n() -> Column:
    return F.count(F.lit(1))


def _lookup(key: Column, table: dict[str, float], default: float) -> Column:
    out = None
    for name, value in table.items():
        out = F.when(key == name, F.lit(value)) if out is None else out.when(key == name, F.lit(value))
    return out.otherwise(F.lit(default))


def halves(mentions: DataFrame) -> DataFrame:
    """(mention_id, earlier, weight) of every mention."""
    return mentions.select("mention_id", earlier_half(mentions).alias("earlier"), "weight")


def presence(rows: DataFrame, key: str, split: DataFrame) -> DataFrame:
    """Counts of one row per (key, mention): raw and weighted, whole and by half.

    A mention without a weight counts 1; one without a half counts in neither."""
    pairs = rows.where(F.col(key).isNotNull()).groupBy(key, "mention_id").agg(_n().alias("hits"))
    w, early, late = F.coalesce("weight", F.lit(1.0)), F.col("earlier"), ~F.col("earlier")
    some = lambda cond, value: F.sum(F.when(cond, value).otherwise(F.lit(0)))
    return (
        pairs.join(split, "mention_id", "left")
        .groupBy(key)
        .agg(
            _n().alias("mention_count"),
            F.sum("hits").alias("hit_count"),
            F.sum(w).alias("effective_count"),
            some(early, F.lit(1)).alias("mentions_before"),
            some(late, F.lit(1)).alias("mentions_after"),
            some(early, F.col("hits")).alias("hits_before"),
            some(late, F.col("hits")).alias("hits_after"),
            F.sum(F.when(early, w).otherwise(0.0)).alias("effective_before"),
            F.sum(F.when(late, w).otherwise(0.0)).alias("effective_after"),
        )
    )


def share_of_voice(hits: DataFrame, mentions: DataFrame, limit: int | None = TOP, weighted: bool = False) -> DataFrame:
    """Shares of each entity, their change from the earlier to the later half, best first."""
    seen = presence(hits, "canonical_entity_id", halves(mentions))
    everything = seen.agg(
        F.sum("hit_count").alias("all_hits"), F.sum("hits_before").alias("all_hits_before"), F.sum("hits_after").alias("all_hits_after"), F.sum("effective_before").alias("all_before"), F.sum("effective_after").alias("all_after")
    )
    resolved = hits.where("canonical_entity_id is not null").agg(F.count_distinct("mention_id").alias("resolved"))
    volume = mentions.agg(_n().alias("volume"), F.sum("weight").alias("effective_volume"))
    rows = with_total(with_total(with_total(seen, everything), resolved), volume)
    least = lambda c, floor: F.greatest(F.col(c), F.lit(floor))
    out = rows.select(
        "canonical_entity_id",
        "mention_count",
        ratio(F.col("mention_count"), F.col("volume")).alias("mention_share"),
        F.col("effective_count").alias("effective_mention_count"),
        ratio(F.col("effective_count"), F.col("effective_volume")).alias("effective_mention_share"),
        F.col("hit_count").alias("entity_hit_count"),
        ratio(F.col("hit_count"), F.col("all_hits")).alias("entity_hit_share"),
        ratio(F.col("mention_count"), F.col("resolved")).alias("resolved_mention_share"),
        (F.col("mentions_after") - F.col("mentions_before")).alias("delta_mention_count"),
        round_to(ratio(F.col("effective_after"), least("all_after", 1.0)) - ratio(F.col("effective_before"), least("all_before", 1.0))).alias("delta_mention_share"),
        (F.col("hits_after") - F.col("hits_before")).alias("delta_entity_hit_count"),
        round_to(ratio(F.col("hits_after"), least("all_hits_after", 1)) - ratio(F.col("hits_before"), least("all_hits_before", 1))).alias("delta_entity_hit_share"),
    )
    best = out.orderBy(F.desc("effective_mention_share" if weighted else "mention_share"), F.desc("entity_hit_share"), "canonical_entity_id")
    return best.limit(limit) if limit else out


def unresolved_summary(hits: DataFrame, mentions: DataFrame) -> DataFrame:
    """(reason, mention_count, unresolved, unresolved_ratio): mentions without any entity, and why hits have none."""
    resolved = hits.agg(F.count_distinct(F.when(F.col("canonical_entity_id").isNotNull(), F.col("mention_id"))).alias("resolved"))
    total = with_total(mentions.agg(_n().alias("volume")), resolved).select(
        F.greatest(F.col("volume") - F.col("resolved"), F.lit(0)).alias("unresolved"), ratio(F.greatest(F.col("volume") - F.col("resolved"), F.lit(0)), F.col("volume")).alias("unresolved_ratio")
    )
    open_hits = hits.where("canonical_entity_id is null and concept_entity_id is null and unresolved_reason is not null")
    return with_total(open_hits.groupBy("unresolved_reason").agg(F.count_distinct("mention_id").alias("mention_count")), total)


def buzz(rows: DataFrame, key: str, mentions: DataFrame, limit: int | None = TOP) -> DataFrame:
    """Weighted presence times one plus positive growth, best first."""
    seen = with_total(presence(rows, key, halves(mentions)), mentions.agg(_n().alias("volume"), F.sum("weight").alias("effective_volume")))
    rise = growth(F.col("effective_after"), F.col("effective_before"))
    out = seen.select(
        key,
        "mention_count",
        ratio(F.col("mention_count"), F.greatest("volume", F.lit(1))).alias("mention_share"),
        F.col("effective_count").alias("effective_mention_count"),
        ratio(F.col("effective_count"), F.greatest("effective_volume", F.lit(1.0))).alias("effective_mention_share"),
        (F.col("mentions_after") - F.col("mentions_before")).alias("delta_count"),
        rise.alias("growth_ratio_proxy"),
        round_to(F.col("effective_count") * (1.0 + F.greatest(rise, F.lit(0.0)))).alias("buzz_score_proxy"),
    )
    return out.orderBy(F.desc("buzz_score_proxy"), F.desc("effective_mention_count"), key).limit(limit) if limit else out


def reportable_topics(topics: DataFrame) -> DataFrame:
    """Topic rows under their reporting key, only reportable ones unless there are none."""
    some = topics.agg(F.coalesce(F.max((F.col("reporting_status") == "reportable").cast("int")), F.lit(0)).alias("some"))
    return with_total(topics, some).where((F.col("some") == 0) | (F.col("reporting_status") == "reportable")).drop("some")


def topic_buzz(topics: DataFrame, mentions: DataFrame, artifacts: DataFrame | None = None, limit: int | None = TOP) -> DataFrame:
    """Buzz of topics; weak and noisy ones are left out unless nothing else is there."""
    rows = buzz(reportable_topics(topics), "topic_key", mentions, None)
    if artifacts is not None:
        rows = rows.join(artifacts.select("topic_key", "reporting_status", "weak_topic", "noisy_topic"), "topic_key", "left")
        stable = (F.coalesce("reporting_status", F.lit("reportable")) == "reportable") & ~F.coalesce("weak_topic", F.lit(False)) & ~F.coalesce("noisy_topic", F.lit(False))
        rows = rows.withColumn("stable", stable)
        rows = with_total(rows, rows.agg(F.max(F.col("stable").cast("int")).alias("any_stable"))).where("stable or any_stable = 0").drop("stable", "any_stable", "reporting_status", "weak_topic", "noisy_topic")
    return rows.orderBy(F.desc("buzz_score_proxy"), F.desc("effective_mention_count"), "topic_key").limit(limit) if limit else rows


def emerging_topics(artifacts: DataFrame, limit: int = TOP) -> DataFrame:
    return artifacts.where("emerging_topic and reporting_status = 'reportable'").orderBy(F.desc("growth_delta"), F.desc("quality_score"), "topic_key").limit(limit)


def pressure_of(row_confidence: str = "confidence", grounding: str | None = None, corroboration: str | None = None) -> Column:
    """Pressure of one issue fact; a stored zero counts as missing, as do absent columns."""
    read = lambda c, default, floor: F.greatest(F.coalesce(F.nullif(F.col(c), F.lit(0.0)), F.lit(default)) if c else F.lit(default), F.lit(floor))
    trust = 0.35 + 0.65 * ((read(row_confidence, 0.0, 0.25) + read(grounding, 0.55, 0.35) + read(corroboration, 0.5, 0.35)) / 3.0)
    return _lookup(F.col("severity"), SEVERITY_WEIGHT, 1.0) * _lookup(F.col("evidence_mode"), EVIDENCE_WEIGHT, 0.7) * trust


def top_issues(issues: DataFrame, mentions: DataFrame, limit: int | None = TOP) -> DataFrame:
    """Issues by summed pressure, with prevalence and change between halves."""
    # Whole millionths add up to the same sum in any order.
    rows = issues.where("issue_category is not null").withColumn("pressure", F.floor(pressure_of() * 1e6 + 0.5).cast("long"))
    per_mention = rows.groupBy("issue_category", "mention_id").agg(_n().alias("facts"), F.sum("pressure").alias("pressure"))
    per_mention = per_mention.join(mentions.select("mention_id", earlier_half(mentions).alias("earlier")), "mention_id", "left")
    side = lambda c: F.sum(F.when(c, 1).otherwise(0))
    out = per_mention.groupBy("issue_category").agg(
        F.sum("facts").alias("issue_fact_count"), _n().alias("mention_count"), F.sum("pressure").alias("p"), (side(~F.col("earlier")) - side(F.col("earlier"))).alias("growth_delta_mentions")
    )
    out = with_total(out, mentions.agg(_n().alias("volume"))).select(
        "issue_category", "issue_fact_count", "mention_count", ratio(F.col("mention_count"), F.greatest("volume", F.lit(1))).alias("mention_prevalence_ratio"),
        round_to(F.col("p") / 1e6).alias("issue_pressure_proxy"), "growth_delta_mentions",
    )
    return out.orderBy(F.desc("issue_pressure_proxy"), F.desc("mention_count"), "issue_category").limit(limit) if limit else out


def mix(df: DataFrame, group: str, key: str) -> DataFrame:
    """(group, key, ratio): the make-up of each group."""
    counts = df.where(F.col(group).isNotNull() & F.col(key).isNotNull()).groupBy(group, key).agg(_n().alias("n"))
    return counts.select(group, key, ratio(F.col("n"), F.sum("n").over(Window.partitionBy(group))).alias("ratio"))


def controversy(threads: DataFrame, mentions: DataFrame, sentiment: DataFrame, issues: DataFrame, limit: int | None = TOP) -> DataFrame:
    """Threads by a weighted sum of reply density, depth, opposed sentiment, and diversity of authors and issues."""
    roots = mentions.select("mention_id", "root_id")
    authors = mentions.groupBy("root_id").agg(F.count_distinct("author_id").alias("authors"))
    moods = sentiment.select("mention_id", "sentiment").join(roots, "mention_id").groupBy("root_id").agg(F.count_if(F.col("sentiment") == "positive").alias("pos"), F.count_if(F.col("sentiment") == "negative").alias("neg"))
    themes = issues.select("mention_id", "issue_category").join(roots, "mention_id").groupBy("root_id").agg(F.count_distinct("issue_category").alias("kinds"), _n().alias("issues"))
    rows = threads.join(authors, "root_id", "left").join(moods, "root_id", "left").join(themes, "root_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    parts = {
        "reply_density": ratio(F.col("reply_count"), F.greatest("comment_count", F.lit(1))),
        "recursion": ratio(F.col("max_depth_observed"), F.greatest("total_mentions", F.lit(1))),
        "mixed_sentiment": F.least(zero("pos"), zero("neg")) / F.greatest(zero("pos") + zero("neg"), F.lit(1)),
        "author_diversity": ratio(zero("authors"), F.col("total_mentions")),
        "issue_diversity": ratio(zero("kinds"), F.greatest(zero("issues"), F.lit(1))),
    }
    score = F.lit(0.0)
    for name, weight in CONTROVERSY_WEIGHT.items():
        score = score + parts[name] * weight
    out = rows.select(
        "root_id", "total_mentions", round_to(F.least(score, F.lit(1.0))).alias("controversy_score_proxy"), parts["reply_density"].alias("reply_density_proxy"), parts["recursion"].alias("recursion_proxy"),
        round_to(parts["mixed_sentiment"]).alias("mixed_sentiment_proxy"), parts["author_diversity"].alias("author_diversity_proxy"), parts["issue_diversity"].alias("issue_diversity_proxy"),
    )
    return out.orderBy(F.desc("controversy_score_proxy"), F.desc("total_mentions"), "root_id").limit(limit) if limit else out


def top_values(df: DataFrame, group: str, key: str, limit: int = 3) -> DataFrame:
    """(group, place, key): the most frequent values of each group; ties by value."""
    counts = df.where(F.col(key).isNotNull()).groupBy(group, key).agg(_n().alias("n"))
    ranked = counts.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), key)))
    return ranked.where(F.col("place") <= limit).select(group, "place", key)


def breakdown(mentions: DataFrame, by: str, limit: int | None = TOP) -> DataFrame:
    """(by, mention_count, conversation_share): creators, sources, or (over roots) thread initiators."""
    rows = with_total(mentions.groupBy(by).agg(_n().alias("mention_count")), mentions.agg(_n().alias("total")))
    out = rows.select(by, "mention_count", ratio(F.col("mention_count"), F.greatest("total", F.lit(1))).alias("conversation_share"))
    return out.orderBy(F.desc("mention_count"), by).limit(limit) if limit else out


def controversial_threads_by_creator(mentions: DataFrame, top_threads: DataFrame) -> DataFrame:
    """(author_id, controversy_thread_count) over the report's threads only."""
    hot = top_threads.where(F.col("controversy_score_proxy") >= CONTROVERSIAL).select("root_id")
    return mentions.join(F.broadcast(hot), "root_id", "left_semi").groupBy("author_id").agg(F.count_distinct("root_id").alias("controversy_thread_count"))


def evidence(df: DataFrame, group: str, order: list[str], limit: int = 5) -> DataFrame:
    """(group, place, mention_id): the first distinct mentions of each group in table order."""
    first = df.where("mention_id is not null").groupBy(group, "mention_id").agg(F.min(F.struct(*order)).alias("at"))
    ranked = first.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy("at", "mention_id")))
    return ranked.where(F.col("place") <= limit).select(group, "place", "mention_id")


def insight_cards(voice: DataFrame, topics: DataFrame, emerging: DataFrame, issues: DataFrame, threads: DataFrame, creators: DataFrame) -> DataFrame:
    """Up to seven cards, each from the first row of a ranked report; an empty report gives none."""
    some = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    text = F.format_string
    best = lambda df, *order: df.orderBy(*order).limit(1)
    shift = F.when(F.col("delta_mention_count") > 0, "gained").otherwise("lost")
    card = lambda kind, title, summary, confidence: (F.lit(kind).alias("insight_type"), title.alias("title"), summary.alias("summary"), round_to(confidence).alias("confidence"))
    first_topic = best(topics, F.desc("buzz_score_proxy"), F.desc("effective_mention_count"), "topic_key")
    rise = F.greatest("growth_ratio_proxy", F.lit(0.0))
    cards = [
        best(voice, F.desc("mention_share"), F.desc("entity_hit_share"), "canonical_entity_id").where("delta_mention_count <> 0").select(
            *card("share_of_voice_shift", F.concat(F.lit("Share of voice moved: "), "canonical_entity_id"), text("%s %s %d mentions in the later half", "canonical_entity_id", shift, F.abs("delta_mention_count")), F.least(0.55 + F.abs("delta_mention_share"), F.lit(0.9)))
        ),
        first_topic.select(*card("trending_topic", F.concat(F.lit("Topic gaining volume: "), "topic_key"), text("%s stands in %d mentions", "topic_key", "mention_count"), F.least(0.5 + rise * 0.1, F.lit(0.86)))),
        first_topic.select(*card("conversation_hotspot", F.concat(F.lit("Conversation gathers around "), "topic_key"), text("%s has a buzz score of %.4f", "topic_key", "buzz_score_proxy"), F.least(0.52 + rise * 0.12, F.lit(0.88)))),
        best(emerging, F.desc("growth_delta"), F.desc("quality_score"), "topic_key").select(
            *card("emerging_topic", F.concat(F.lit("Emerging topic: "), "topic_key"), text("%s grew by %.1f", "topic_key", some("growth_delta")), F.least(0.54 + some("quality_score") * 0.14 + some("reportability_score") * 0.18, F.lit(0.92)))
        ),
        best(issues, F.desc("issue_pressure_proxy"), F.desc("mention_count"), "issue_category").select(
            *card("issue_warning", F.concat(F.lit("Issue pressure: "), "issue_category"), text("%s leads with %.4f over %d mentions", "issue_category", "issue_pressure_proxy", "mention_count"), F.least(0.58 + F.col("issue_pressure_proxy") / F.greatest("issue_pressure_proxy", F.lit(1.0)) * 0.18, F.lit(0.86)))
        ),
        best(threads, F.desc("controversy_score_proxy"), F.desc("total_mentions"), "root_id").select(
            *card("controversy_alert", F.concat(F.lit("Contested thread: "), "root_id"), text("Thread %s scores %.4f", "root_id", "controversy_score_proxy"), F.least(0.52 + F.col("controversy_score_proxy") * 0.25, F.lit(0.84)))
        ),
        best(creators, F.desc("mention_count"), "author_id").select(
            *card("creator_concentration", F.concat(F.lit("Much from one creator: "), "author_id"), text("%s wrote %d mentions", "author_id", "mention_count"), F.least(0.5 + F.col("conversation_share") * 0.5, F.lit(0.8)))
        ),
    ]
    out = cards[0]
    for c in cards[1:]:
        out = out.unionByName(c)
    return out
