"""Spam scores of mentions, profiles of authors, and quality weights.

Input rows carry mention_id, author_id, posted_at, text (compact), normalized (before compacting), url_count and the
columns of dedup.annotate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import round_to
from ..functions.text import repost_like, runs, template_key, words

SUSPICIOUS = 0.65
WINDOW_MINUTES = 60
FLOOR = 0.15
MENTION_DISCOUNT = 0.65
AUTHOR_DISCOUNT = 0.45
TEMPLATE_USES = 3

# Weights of the mention's and the author's score, and the author's thresholds.
MENTION_WEIGHT = {"high_url_density": 0.22, "low_lexical_diversity": 0.22, "high_repetition_ratio": 0.20, "duplicate_cluster_participation": 0.22, "repost_like_behavior": 0.14}
AUTHOR_WEIGHT = {"average": 0.42, "burst": 0.18, "duplicate": 0.20, "template": 0.12, "repost": 0.08}
AUTHOR_REASON = {"author_burstiness": ("burst", 0.55), "author_duplicate_participation": ("duplicate", 0.45), "author_template_reuse": ("template", 0.45), "author_repost_like_ratio": ("repost", 0.4), "high_average_mention_spam_score": ("average", 0.55)}


def _weighted(parts: dict[str, Column], weights: dict[str, float]) -> Column:
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + parts[name] * weight
    return F.least(total, F.lit(1.0))


def _reasons(parts: dict[str, tuple[Column, float]]) -> Column:
    return F.array_compact(F.array(*(F.when(value >= least, F.lit(name)) for name, (value, least) in parts.items())))


def mention_features(mentions: DataFrame) -> DataFrame:
    """Adds token_count, top_share, template, repost, mention_spam_score (whole ten-thousandths are exact) and reason_codes."""
    rows = mentions.withColumn("toks", words(F.col("text")))
    n = F.size("toks")
    longest = F.coalesce(F.array_max(F.transform(runs(F.array_sort("toks")), lambda r: r["n"])), F.lit(0))
    rows = rows.withColumns({"token_count": n, "distinct_count": F.size(F.array_distinct("toks")), "most_count": longest, "template": template_key(F.col("normalized")), "repost": repost_like(F.col("text"))}).drop("toks")
    count = F.col("token_count")
    diversity = F.when(count > 0, F.col("distinct_count") / F.greatest(count, F.lit(1))).otherwise(F.lit(1.0))
    top = F.when(count > 0, F.col("most_count") / F.greatest(count, F.lit(1))).otherwise(F.lit(0.0))
    size = F.greatest("dedup_cluster_size", F.lit(1))
    parts = {
        "high_url_density": F.least(F.col("url_count") / F.greatest(count, F.lit(1)) * 2.5, F.lit(1.0)),
        "low_lexical_diversity": F.when(count >= 4, F.greatest(0.45 - diversity, F.lit(0.0)) / 0.45).otherwise(F.lit(0.0)),
        "high_repetition_ratio": F.when(count > 0, F.greatest(1.0 - diversity, top)).otherwise(F.lit(0.0)),
        "duplicate_cluster_participation": (size - 1) / size,
        "repost_like_behavior": F.col("repost").cast("double"),
    }
    rows = rows.withColumn("reason_codes", _reasons({k: (v, 0.5) for k, v in parts.items()}))
    return rows.withColumn("mention_spam_score", round_to(_weighted(parts, MENTION_WEIGHT)))


def burstiness(mentions: DataFrame) -> DataFrame:
    """(author_id, burstiness_score): most mentions in any trailing hour over all dated ones; 0 for fewer than two."""
    width = 60_000_000 * WINDOW_MINUTES
    rows = mentions.where("posted_at is not null").select("author_id", F.unix_micros(F.col("posted_at").cast("timestamp")).alias("at"))
    # A mention counts for those of its own stretch of time and of the next one, so an author is sorted by stretches, not as a whole.
    both = rows.select("author_id", "at", F.explode(F.array(F.lit(0), F.lit(1))).alias("later")).withColumn("stretch", F.floor(F.col("at") / width) + F.col("later"))
    trailing = Window.partitionBy("author_id", "stretch").orderBy("at").rangeBetween(-width, 0)
    counted = both.withColumn("n", F.count(F.lit(1)).over(trailing)).where("later = 0")
    best = counted.groupBy("author_id").agg(F.max("n").alias("best"), F.count(F.lit(1)).alias("total"))
    return best.select("author_id", F.when(F.col("total") < 2, 0.0).otherwise(round_to(F.col("best") / F.col("total"))).alias("burstiness_score"))


def author_profiles(features: DataFrame) -> DataFrame:
    """One row for each author: counts, rates, author_inorganic_score, author_suspicious and reason_codes."""
    templates = features.where("template <> ''").groupBy("template").agg(F.count(F.lit(1)).alias("uses")).where(F.col("uses") >= TEMPLATE_USES).select("template", F.lit(1).alias("reused"))
    rows = features.join(templates, "template", "left")
    score = (F.col("mention_spam_score") * 10000.0 + 0.5).cast("long")
    sums = rows.groupBy("author_id").agg(
        F.count(F.lit(1)).alias("mention_count"),
        F.count_if(F.col("mention_spam_score") >= SUSPICIOUS).alias("suspicious_mention_count"),
        F.sum(score).alias("scores"),
        F.count_if(F.col("dedup_cluster_size") > 1).alias("duplicates"),
        F.count("reused").alias("reuses"),
        F.count_if(F.col("repost")).alias("reposts"),
    )
    rows = sums.join(burstiness(features), "author_id", "left")
    n = F.col("mention_count")
    parts = {
        "average": F.col("scores") / 10000.0 / n,
        "burst": F.coalesce("burstiness_score", F.lit(0.0)),
        "duplicate": F.col("duplicates") / n,
        "template": F.col("reuses") / n,
        "repost": F.col("reposts") / n,
    }
    reasons = _reasons({name: (parts[part], least) for name, (part, least) in AUTHOR_REASON.items()})
    score = round_to(F.least(round_to(_weighted(parts, AUTHOR_WEIGHT)) + F.least(F.size(reasons) * 0.03, F.lit(0.09)), F.lit(1.0)))
    return rows.select(
        "author_id", "mention_count", "suspicious_mention_count", score.alias("author_inorganic_score"), (score >= SUSPICIOUS).alias("author_suspicious"), parts["burst"].alias("burstiness_score"),
        round_to(parts["template"]).alias("template_ratio"), round_to(parts["duplicate"]).alias("duplicate_cluster_participation_rate"), round_to(parts["repost"]).alias("repost_like_ratio"),
        round_to(parts["average"]).alias("average_mention_spam_score"), reasons.alias("reason_codes"),
    )


def quality_weight(dedup_weight: Column, mention_score: Column, author_score: Column) -> Column:
    left = lambda score, strength: F.greatest(1.0 - score * strength, F.lit(FLOOR))
    return round_to(dedup_weight * left(mention_score, MENTION_DISCOUNT) * left(author_score, AUTHOR_DISCOUNT), 6)


def annotate(features: DataFrame) -> DataFrame:
    """features with author scores, suspicion, quality_weight, and text quality flags, label, score and route."""
    profiles = author_profiles(features).select("author_id", "author_inorganic_score", "author_suspicious", F.col("reason_codes").alias("author_reasons"))
    rows = features.join(profiles, "author_id", "left").withColumn("mention_suspicious", F.col("mention_spam_score") >= SUSPICIOUS)
    rows = rows.withColumn("quality_weight", quality_weight(F.col("dedup_weight"), F.col("mention_spam_score"), F.col("author_inorganic_score")))
    given = F.col("text_quality_flags") if "text_quality_flags" in features.columns else F.array().cast("array<string>")
    more = F.array_compact(F.array(F.when(F.col("dedup_cluster_size") > 1, "duplicate_like"), F.when(F.col("mention_suspicious") | F.col("author_suspicious"), "spam_like")))
    label = F.col("text_quality_label") if "text_quality_label" in features.columns else F.lit("normal")
    score = F.col("text_quality_score") if "text_quality_score" in features.columns else F.lit(1.0)
    rows = rows.withColumn("text_quality_flags", F.array_distinct(F.concat(given, more)))
    has = lambda f: F.array_contains("text_quality_flags", f)
    light = F.arrays_overlap("text_quality_flags", F.array(*map(F.lit, ("reaction_only", "low_information", "duplicate_like", "spam_like", "url_heavy"))))
    return rows.withColumns(
        {
            "suspicion_reason_codes": F.concat("reason_codes", F.when(F.col("author_suspicious"), F.col("author_reasons")).otherwise(F.array().cast("array<string>"))),
            "text_quality_label": F.when(has("spam_like"), "spam_like").when(has("duplicate_like") & (label == "normal"), "duplicate_like").otherwise(label),
            "text_quality_score": round_to(F.least(score, F.col("quality_weight"))),
            "semantic_route_hint": F.when(light, "semantic_lite").otherwise("semantic_full"),
        }
    ).drop("author_reasons")
