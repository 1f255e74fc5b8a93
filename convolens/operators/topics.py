"""Topics: assignment, terms, quality, identity across runs, lineage, reporting status.

Prototypes are an ontology's topics, met in blocks of a set size; documents are never paired with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import round_to
from ..functions.text import jaccard, normalize_alias, tokens
from ..tables import settle

# Shares of the assignment score, its threshold, and the quality thresholds.
LEXICAL, SEMANTIC, ENTITY, ASPECT, ISSUE, PRIMARY = 0.54, 0.2, 0.12, 0.08, 0.08, 0.1
NEGATIVE, LEAK, BOTH, CLEAR = 0.18, 0.14, 0.08, 0.08
LEAST_SCORE, MOST_SCORE = 0.32, 0.98
#: Topics that are broadcast together.
TOPICS_AT_ONCE = 2000
LEAST_SUPPORT, LEAST_STABILITY, GROWTH = 3, 0.35, 0.2
LINEAGE = ("profile", "signature", "term", "key")


def prototypes(spark: SparkSession, ontology: dict) -> DataFrame:
    """(topic_key, label, phrases, negatives, entities, aspects, issues, primary, issue_centric) of an ontology's reportable topics."""
    rows = []
    for t in ontology["topics"]:
        if not t.get("reportable", True) or t.get("main_path_policy") == "discovery_only":
            continue
        low = lambda name, t=t: [p.lower().strip() for p in t.get(name, ()) if p.strip()]
        rows.append((t["id"], t["name"], low("seed_phrases") or [t["name"].lower()], low("negative_phrases"), *(list(t.get(f"related_{k}_ids", [])) for k in ("entity", "aspect", "issue")), t.get("main_path_policy") == "domain_primary", bool(t.get("issue_centric"))))
    schema = "topic_key string, label string, phrases array<string>, negatives array<string>, entities array<string>, aspects array<string>, issues array<string>, primary boolean, issue_centric boolean"
    return spark.createDataFrame(rows, schema)


def assignments(docs: DataFrame, topics: DataFrame, likeness: DataFrame | None = None) -> DataFrame:
    """(mention_id, topic_key, score): every topic of every document that reaches the threshold.

    ``docs`` has mention_id and text, and the labels entities, aspects and issues if there; ``likeness`` (mention_id, topic_key,
    semantic) that of their vectors.  A topic is scored by its seed phrases in the text, likeness, and labels that it names; phrases that
    speak against it and a lone issue cost.  Topics are an ontology's; they are met in blocks of ``TOPICS_AT_ONCE``, each small enough to be
    broadcast."""
    none = F.array().cast("array<string>")
    own = {k: F.coalesce(F.col(k).cast("array<string>"), none) if k in docs.columns else none for k in ("entities", "aspects", "issues")}
    rows = docs.select("mention_id", F.lower(F.trim("text")).alias("text"), *(c.alias(f"own_{k}") for k, c in own.items())).where("text <> ''")
    place = topics.withColumn("__block", F.floor((F.row_number().over(Window.orderBy("topic_key")) - 1) / TOPICS_AT_ONCE))
    place = settle(place, "prototypes")
    met: DataFrame | None = None
    for block in range(-(-place.count() // TOPICS_AT_ONCE)):
        part = rows.crossJoin(F.broadcast(place.where(F.col("__block") == block)))
        met = part if met is None else met.unionByName(part)
    if met is None:
        return rows.select("mention_id", F.lit("").alias("topic_key"), F.lit(0.0).alias("score")).where(F.lit(False))
    here = lambda p: F.contains(F.col("text"), p)
    hits = F.aggregate("phrases", F.lit(0.0), lambda acc, p: acc + F.when(here(p), F.when(F.contains(p, F.lit(" ")), 1.0).otherwise(0.65)).otherwise(0.0))
    met = met.withColumn("hits", hits)
    wanted = F.greatest(F.least(F.size("phrases"), F.lit(4)) * 0.65, F.lit(1.0))
    met = met.withColumn("lexical", F.when(F.col("hits") > 0, F.least(F.col("hits") / wanted + 0.18, F.lit(1.0))).otherwise(0.0))
    some = F.size("own_entities") + F.size("own_aspects") + F.size("own_issues") > 0
    met = met.where((F.col("lexical") > 0) | some)
    if likeness is not None:
        met = met.join(likeness.select("mention_id", "topic_key", "semantic"), ["mention_id", "topic_key"], "left")
    semantic = F.greatest(F.coalesce("semantic", F.lit(0.0)), F.lit(0.0)) if likeness is not None else F.lit(0.0)
    on = lambda c, v: F.when(F.coalesce(c, F.lit(False)), v).otherwise(0.0)
    entity, aspect, issue = (F.arrays_overlap(f"own_{k}", k) for k in ("entities", "aspects", "issues"))
    lexical = F.col("lexical")
    labelled = on(entity, ENTITY) + on(aspect, ASPECT) + on(issue, ISSUE)
    primary = on(F.col("primary") & ((lexical >= 0.2) | (labelled > 0)), PRIMARY)
    leak = on(F.coalesce(issue, F.lit(False)) & ~F.col("issue_centric") & ~F.coalesce(aspect, F.lit(False)) & ~F.coalesce(entity, F.lit(False)) & (lexical < 0.42), LEAK)
    score = lexical * LEXICAL + semantic * SEMANTIC + labelled + primary - on(F.exists("negatives", here), NEGATIVE) - leak + on((lexical > 0) & (semantic > 0), BOTH) + on(lexical >= 0.45, CLEAR)
    return met.select("mention_id", "topic_key", round_to(F.least(score, F.lit(MOST_SCORE))).alias("score")).where(F.col("score") >= LEAST_SCORE)


def family(key: Column) -> Column:
    """What stands before the second dot of a topic key."""
    return F.substring_index(key, ".", 2)


def best(scored: DataFrame) -> DataFrame:
    """The best topic of each document: best of each family, then best of all; ties by key."""
    order = [F.desc("score"), "topic_key"]
    fam = scored.withColumn("family", family(F.col("topic_key")))
    first = fam.withColumn("place", F.row_number().over(Window.partitionBy("mention_id", "family").orderBy(*order))).where("place = 1")
    return first.withColumn("place", F.row_number().over(Window.partitionBy("mention_id").orderBy(*order))).where("place = 1").select("mention_id", "topic_key", "score")


def top_terms(assigned: DataFrame, docs: DataFrame, limit: int = 8) -> DataFrame:
    """(topic_key, place, term, count): commonest words of the topic's documents."""
    words = assigned.join(docs, "mention_id").select("topic_key", "mention_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term")).where(F.length("term") > 2)
    counts = words.groupBy("topic_key", "term").agg(F.count(F.lit(1)).alias("count"))
    ranked = counts.withColumn("place", F.row_number().over(Window.partitionBy("topic_key").orderBy(F.desc("count"), "term")))
    return ranked.where(F.col("place") <= limit).select("topic_key", "place", "term", "count")


def select_diverse(phrases: DataFrame, limit: int = 5, apart: float = 0.8) -> DataFrame:
    """(topic_key, place, phrase): greedily the best scored phrases (topic_key, phrase, score) that don't repeat the words
    of one taken before.  Phrases of one topic are bounded by top_terms and seeds."""

    def run(key, table):
        import pyarrow as pa

        taken: list[set] = []
        out = []
        for row in sorted(table.to_pylist(), key=lambda r: (-r["score"], r["phrase"])):
            words = set(row["phrase"].split())
            if words and all(len(words & x) / len(words | x) < apart for x in taken):
                taken.append(words)
                out.append((row["topic_key"], len(taken), row["phrase"]))
                if len(out) == limit:
                    break
        cols = list(zip(*out, strict=True)) if out else [(), (), ()]
        return pa.table({"topic_key": pa.array(cols[0], pa.string()), "place": pa.array(cols[1], pa.int32()), "phrase": pa.array(cols[2], pa.string())})

    return phrases.select("topic_key", "phrase", "score").groupBy("topic_key").applyInArrow(run, "topic_key string, place int, phrase string")


def artifacts(assigned: DataFrame, terms: DataFrame, mentions: DataFrame) -> DataFrame:
    """One row for each topic: size, authors, time window, terms, scores, flags and reporting status."""
    words = terms.groupBy("topic_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "term"))), lambda x: x["term"]).alias("terms"))
    spread = Window.partitionBy("term")
    own = terms.withColumn("topics", F.count(F.lit(1)).over(spread)).groupBy("topic_key").agg(F.avg(1.0 / F.col("topics")).alias("distinctness"))
    size = assigned.join(mentions.select("mention_id", "author_id", "posted_at"), "mention_id", "left").groupBy("topic_key").agg(
        F.count_distinct("mention_id").alias("topic_size"), F.count_distinct("author_id").alias("authors"), F.min("posted_at").alias("first_seen"), F.max("posted_at").alias("last_seen"), F.avg("score").alias("coherence")
    )
    rows = size.join(words, "topic_key", "left").join(own, "topic_key", "left")
    support = F.least(F.col("topic_size") / 10.0, F.lit(1.0))
    diversity = F.col("authors") / F.greatest("topic_size", F.lit(1))
    quality = round_to(0.4 * support + 0.3 * F.coalesce("distinctness", F.lit(0.0)) + 0.3 * diversity)
    rows = rows.withColumns({"quality_score": quality, "weak_topic": F.col("topic_size") < LEAST_SUPPORT, "noisy_topic": F.coalesce(F.col("distinctness") < 0.25, F.lit(True)), "reportability_score": round_to(0.5 * quality + 0.5 * F.col("coherence"))})
    status = F.when(F.col("weak_topic"), "weak").when(F.col("noisy_topic"), "noisy").otherwise("reportable")
    return rows.withColumn("reporting_status", status).withColumn("signature", signature(F.col("terms")))


def signature(terms: Column) -> Column:
    return F.left(F.sha2(F.array_join(F.array_sort(F.coalesce(terms, F.array().cast("array<string>"))), "|"), 256), F.lit(16))


def stability(now: DataFrame, before: DataFrame | None) -> DataFrame:
    """Adds previous_key, stability_score, growth_delta and emerging_topic: the most similar topic of the previous snapshot
    by shared terms.  Without one, stability is 0 and growth the size itself, so all that qualifies is emerging."""
    if before is None:
        rows = now.withColumns({"previous_key": F.lit(None).cast("string"), "stability_score": F.lit(0.0), "growth_delta": F.col("topic_size").cast("double")})
    else:
        # Topics that share no term have similarity 0, so only those that share one are compared.
        mine, theirs = now.select("topic_key", F.explode("terms").alias("t")), before.select(F.col("topic_key").alias("previous_key"), F.explode("terms").alias("t"))
        pairs = mine.join(theirs, "t").select("topic_key", "previous_key").distinct()
        pairs = pairs.join(now.select("topic_key", F.col("terms").alias("a")), "topic_key").join(before.select(F.col("topic_key").alias("previous_key"), F.col("terms").alias("b"), F.col("topic_size").alias("was")), "previous_key")
        scored = pairs.withColumn("s", round_to(jaccard(F.col("a"), F.col("b"))))
        one = scored.groupBy("topic_key").agg(F.min_by(F.struct("previous_key", "s", "was"), F.struct(-F.col("s"), F.col("previous_key"))).alias("m"))
        rows = now.join(one, "topic_key", "left")
        was = F.coalesce("m.was", F.lit(0))
        rows = rows.withColumns({"previous_key": F.col("m.previous_key"), "stability_score": F.coalesce("m.s", F.lit(0.0)), "growth_delta": F.when(was > 0, round_to((F.col("topic_size") - was) / F.greatest(was, F.lit(1)))).otherwise(F.col("topic_size").cast("double"))}).drop("m")
    emerging = (F.col("growth_delta") > GROWTH) & ((F.col("stability_score") < LEAST_STABILITY) | (F.col("growth_delta") >= 1)) & ~F.col("weak_topic") & ~F.col("noisy_topic")
    return rows.withColumn("emerging_topic", emerging)


def lineage(now: DataFrame, known: DataFrame) -> DataFrame:
    """now with the effective_key of the strongest kind of match in ``known`` (match, value, effective_key); a kind whose
    matches disagree gives none, and no weaker kind is tried."""
    offers = now.select(
        "topic_key", F.explode(F.concat(F.array(*(F.struct(F.lit(k).alias("match"), v.alias("value")) for k, v in (("signature", F.col("signature")), ("key", F.col("topic_key"))))), F.transform("terms", lambda t: F.struct(F.lit("term").alias("match"), t.alias("value"))))).alias("o")
    ).select("topic_key", "o.*")
    rank = F.array_position(F.array(*map(F.lit, LINEAGE)), F.col("match"))
    hits = offers.join(known, ["match", "value"]).withColumn("rank", rank)
    best_rank = F.min("rank").over(Window.partitionBy("topic_key"))
    kept = hits.withColumn("best", best_rank).where("rank = best").groupBy("topic_key").agg(F.count_distinct("effective_key").alias("n"), F.min("effective_key").alias("effective_key"))
    return now.join(kept.select("topic_key", F.when(F.col("n") == 1, F.col("effective_key")).alias("effective_key")), "topic_key", "left")


def with_reporting_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reporting_topic_key", F.coalesce("effective_key", "topic_key"))


def documents(mentions: DataFrame, segments: DataFrame, entities: DataFrame, aspects: DataFrame, issues: DataFrame) -> DataFrame:
    """(document_id, mention_id, segment_id, text, entities, aspects, issues): a topic document for each segment (mention_id, segment, text),
    the whole mention where it has none.  The first has the mention's title hint in front of nothing else said; labels are the mention's.

    ``mentions`` has mention_id, text (compact) and summary_title, which may be null."""
    hint = normalize_alias(F.coalesce("summary_title", F.lit("")))
    hint = F.when((hint != "") & ~F.contains(F.col("text"), hint), hint).otherwise("")
    own = mentions.select("mention_id", F.col("text").alias("whole"), hint.alias("hint"))
    rows = own.join(segments.select("mention_id", "segment", F.col("text").alias("part")), "mention_id", "left")
    name = F.coalesce(F.concat(F.lit("seg-"), F.col("segment").cast("string")), F.lit("whole"))
    first = F.coalesce(F.col("segment") == 0, F.lit(True))
    text = F.concat_ws(" ", F.array_distinct(F.filter(F.array(F.trim(F.coalesce("part", "whole")), F.when(first, F.col("hint")).otherwise("")), lambda x: x != "")))
    labels = [df.where(F.col(c).isNotNull()).groupBy("mention_id").agg(F.array_sort(F.collect_set(c)).alias(alias)) for df, c, alias in ((entities, "entity_id", "entities"), (aspects, "aspect", "aspects"), (issues, "issue_category", "issues"))]
    rows = rows.select(F.concat("mention_id", F.lit(":"), name).alias("document_id"), "mention_id", F.when(F.col("segment").isNotNull(), name).alias("segment_id"), text.alias("text"))
    for table in labels:
        rows = rows.join(table, "mention_id", "left")
    none = F.array().cast("array<string>")
    return rows.select("document_id", "mention_id", "segment_id", "text", *(F.coalesce(c, none).alias(c) for c in ("entities", "aspects", "issues")))
