"""Entity discovery and linking: alias scan, other candidates, merging, resolution, and clusters of what stays open.

Aliases meet texts by an equi-join on runs of tokens, so the alias table may be of any size and no text is compared
with every alias.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import fold_accents, let, ngrams, normalize_alias, tokens
from ..tables import settle

# Confidence of each way to find a candidate.
CONFIDENCE = {"alias_scan": 0.95, "product_code": 0.68, "hashtag": 0.52, "title_span": 0.64, "token_ngram": 0.40}
SIGNAL = {"exact": 1.0, "normalized": 0.97, "compact": 0.94}
BONUS, MOST = 0.03, 0.96
#: Words of a run, at least; as many as the longest alias has otherwise.
LONGEST = 5
CODE = r"\b([A-Za-z]{1,6}[- ]?[0-9]{1,4}[A-Za-z]{0,3})\b"
AMBIGUITY_GAP = 0.05
LEAST_MENTIONS = 2
PROMOTABLE = 3


def _runs(text: Column, longest: int = LONGEST) -> Column:
    return let(tokens(normalize_alias(text)), lambda t: F.array_distinct(F.concat(*(ngrams(t, n) for n in range(1, longest + 1)))))


#: Rows up to which an alias table is broadcast; beyond, both sides are shuffled by the run.
BROADCAST_ROWS = 50_000


def alias_hits(mentions: DataFrame, aliases: DataFrame) -> DataFrame:
    """(mention_id, text, canonical_entity_id, entity_type, entity_kind, signal): aliases whose words stand in the text, also run
    together there or written apart.

    Only runs that are aliases meet their texts again; the runs carry no text."""
    table = settle(aliases, "aliases")
    # As many words as the longest alias has, and no more letters, so that few runs leave their text.
    rows, words, letters = table.agg(F.count(F.lit(1)), F.max(F.size(F.split("normalized", " "))), F.max(F.length("compact"))).first()
    table = F.broadcast(table) if rows <= BROADCAST_ROWS else table.hint("shuffle_merge")
    found = F.filter(_runs(F.col("raw_text"), max(LONGEST, words or 0)), lambda r: F.length(F.translate(r, " ", "")) <= (letters or 0))
    runs = mentions.select("mention_id", F.explode(found).alias("run")).withColumn("compact", F.translate("run", " ", ""))
    found = settle(runs.join(table, "compact").distinct(), "alias_runs")
    texts = mentions.select("mention_id", F.lower("raw_text").alias("__text"))
    exact = F.contains("__text", F.lower("alias"))
    signal = F.when(F.col("run") != F.col("normalized"), "compact").when(exact, "exact").otherwise("normalized")
    return found.join(texts, "mention_id").select("mention_id", F.col("run").alias("text"), "canonical_entity_id", "entity_type", "entity_kind", signal.alias("signal")).distinct()


def candidates(mentions: DataFrame, hits: DataFrame, noise: list[str] | None = None, repeated: DataFrame | None = None) -> DataFrame:
    """(mention_id, text, method, confidence) from alias hits, hashtags, product codes, titles and repeated phrases."""
    make = lambda df, method: df.select("mention_id", "text", F.lit(method).alias("method"), F.lit(CONFIDENCE[method]).alias("confidence"))
    out = make(hits.select("mention_id", "text").distinct(), "alias_scan")
    if "hashtags" in mentions.columns:
        out = out.unionByName(make(mentions.select("mention_id", F.explode("hashtags").alias("h")).select("mention_id", normalize_alias(F.col("h")).alias("text")), "hashtag"))
    codes = mentions.select("mention_id", F.explode(F.array_distinct(F.regexp_extract_all("raw_text", F.lit(CODE), 1))).alias("c"))
    out = out.unionByName(make(codes.select("mention_id", normalize_alias(F.col("c")).alias("text")), "product_code"))
    if "title" in mentions.columns:
        out = out.unionByName(make(mentions.where("title is not null").select("mention_id", normalize_alias(F.col("title")).alias("text")).where(F.size(tokens(F.col("text"))) <= LONGEST), "title_span"))
    if repeated is not None:
        runs = mentions.select("mention_id", F.explode(_runs(F.col("raw_text"), 3)).alias("text"))
        out = out.unionByName(make(runs.join(repeated.select("text"), "text", "left_semi"), "token_ngram"))
    out = out.where(F.length("text") > 1)
    return out.where(~F.col("text").isin(*noise)) if noise else out


def repeated_phrases(mentions: DataFrame, aliases: DataFrame, noise: list[str] | None = None, least: int = LEAST_MENTIONS, shortest: int = 2) -> DataFrame:
    """(text, mentions): runs of two or three tokens in enough mentions that are no alias and no noise."""
    phrases = let(tokens(normalize_alias(F.col("raw_text"))), lambda t: F.array_distinct(F.concat(*(ngrams(t, n) for n in range(shortest, 4)))))
    runs = mentions.select("mention_id", F.explode(phrases).alias("text"))
    counts = runs.groupBy("text").agg(F.count(F.lit(1)).alias("mentions")).where(F.col("mentions") >= least)
    counts = counts.join(aliases.select(F.col("normalized").alias("text")).distinct(), "text", "left_anti")
    return counts.where(~F.col("text").isin(*noise)) if noise else counts


def merge(found: DataFrame) -> DataFrame:
    """(mention_id, text, confidence, methods): one row for a text of a mention, a little surer for each further method."""
    out = found.groupBy("mention_id", "text").agg(F.max("confidence").alias("best"), F.array_sort(F.collect_set("method")).alias("methods"))
    sure = F.when(F.size("methods") > 1, F.greatest("best", F.least(F.col("best") + BONUS, F.lit(MOST)))).otherwise(F.col("best"))
    return out.select("mention_id", "text", sure.alias("confidence"), "methods")


def resolve(merged: DataFrame, hits: DataFrame, noise: list[str] | None = None) -> DataFrame:
    """Adds canonical_entity_id, concept_entity_id, entity_type, link_confidence and unresolved_reason: the entity of the
    best signal, none where two entities are too close, and why none."""
    weight = F.lit(0.0)
    for name, value in SIGNAL.items():
        weight = F.when(F.col("signal") == name, value).otherwise(weight)
    best = hits.groupBy("mention_id", "text", "canonical_entity_id", "entity_type", "entity_kind").agg(F.max(weight).alias("s"))
    ranked = best.withColumn("place", F.row_number().over(Window.partitionBy("mention_id", "text").orderBy(F.desc("s"), "canonical_entity_id")))
    two = ranked.where("place <= 2").groupBy("mention_id", "text").agg(
        F.max_by(F.struct("canonical_entity_id", "entity_type", "entity_kind", "s"), -F.col("place")).alias("first"), F.max(F.when(F.col("place") == 2, F.col("s"))).alias("second")
    )
    rows = merged.join(two, ["mention_id", "text"], "left")
    close = F.col("first.s") - F.col("second") < AMBIGUITY_GAP
    ok = F.col("first").isNotNull() & ~F.coalesce(close, F.lit(False))
    concept = F.col("first.entity_kind") == "concept"
    noisy = F.col("text").isin(*noise) if noise else F.lit(False)
    reason = F.when(noisy, "noise_term").when(F.col("first").isNull(), "no_candidate_found").when(~ok, "ambiguous_multi_candidate")
    return rows.select(
        "mention_id", "text", "confidence", "methods", F.when(ok & ~concept, F.col("first.canonical_entity_id")).alias("canonical_entity_id"), F.when(ok & concept, F.col("first.canonical_entity_id")).alias("concept_entity_id"),
        F.when(ok, F.col("first.entity_type")).alias("entity_type"), F.when(ok, F.col("confidence") * F.col("first.s")).otherwise(0.0).alias("link_confidence"), reason.alias("unresolved_reason"),
    )


def facts(resolved: DataFrame, open_limit: int = 2) -> DataFrame:
    """One row for each entity of a mention, its best text; of a mention without any, its best open texts."""
    key = F.coalesce("canonical_entity_id", "concept_entity_id")
    linked = resolved.where(key.isNotNull()).withColumn("place", F.row_number().over(Window.partitionBy("mention_id", key).orderBy(F.desc("link_confidence"), F.desc(F.length("text")), "text"))).where("place = 1")
    open_ = resolved.where(key.isNull()).join(linked.select("mention_id").distinct(), "mention_id", "left_anti")
    open_ = open_.withColumn("place", F.row_number().over(Window.partitionBy("mention_id").orderBy(F.desc("confidence"), F.desc(F.length("text")), "text"))).where(F.col("place") <= open_limit)
    return linked.unionByName(open_).drop("place")


def open_clusters(entity_facts: DataFrame) -> DataFrame:
    """(cluster_id, text, mention_count, promotable) of open texts that several mentions share."""
    rows = entity_facts.where("canonical_entity_id is null and concept_entity_id is null")
    out = rows.groupBy("text").agg(F.count_distinct("mention_id").alias("mention_count")).where(F.col("mention_count") >= LEAST_MENTIONS)
    return out.select(F.concat(F.lit("candclu."), F.left(F.sha2("text", 256), F.lit(12))).alias("cluster_id"), "text", "mention_count", (F.col("mention_count") >= PROMOTABLE).alias("promotable"))


def variants(aliases: DataFrame) -> DataFrame:
    """aliases with an accent-free spelling of each as further rows."""
    folded = aliases.withColumn("normalized", fold_accents(F.col("normalized"))).withColumn("compact", fold_accents(F.col("compact")))
    return aliases.unionByName(folded).distinct()


def link(mentions: DataFrame, aliases: DataFrame, noise: list[str] | None = None, repeated: bool = False) -> DataFrame:
    """From mentions (mention_id, raw_text, and hashtags and title if there) to entity facts."""
    phrases = repeated_phrases(mentions, aliases, noise) if repeated else None
    hits = settle(alias_hits(mentions, aliases), "alias_hits")
    merged = merge(candidates(mentions, hits, noise, phrases))
    return facts(resolve(merged, hits, noise))
