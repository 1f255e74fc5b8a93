"""The whole batch: records to mentions, quality, threads, facts, marts, reports and cards, with a manifest."""

from __future__ import annotations

import json
import os
import time
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import providers
from ..functions import text as x
from ..operators import dedup, entities, halves, language, linking, metrics, ontology, reports, review, rules, semantics, spam, threads, topics, validation
from ..sources import records
from ..tables import settle


@dataclass
class Settings:
    """What a run can choose."""

    weighting: str = "quality"
    near_duplicates: bool = True
    require_supported_language: bool = False
    #: A line that is no JSON object ends the run; otherwise it counts as an invalid record.
    strict: bool = True
    gate: language.Gate = field(default_factory=lambda: language.VI_EN)
    cues: semantics.Cues = field(default_factory=semantics.Cues)
    #: Names of registered enrichers; each adds a table fact_<name>.
    enrichers: tuple[str, ...] = ()
    #: Folder where topics of every run are kept, and those of the last one found; none keeps and finds nothing.
    state_dir: str = ""

    @classmethod
    def from_environment(cls, environment: dict[str, str] | None = None, prefix: str = "CONVOLENS_") -> Settings:
        """Plain settings from variables such as CONVOLENS_WEIGHTING; what isn't named keeps its default."""
        given = {k.removeprefix(prefix).lower(): v for k, v in (os.environ if environment is None else environment).items() if k.startswith(prefix)}
        out = cls()
        for name, value in given.items():
            now = getattr(out, name, None)
            if isinstance(now, bool):
                setattr(out, name, value.strip().lower() in ("1", "true", "yes", "on"))
            elif isinstance(now, str):
                setattr(out, name, value)
            elif isinstance(now, tuple):
                setattr(out, name, tuple(x.strip() for x in value.split(",") if x.strip()))
        return out


class Timing:
    """Wall-clock seconds of each stage, in order."""

    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}

    @contextmanager
    def stage(self, name: str):
        start = time.perf_counter()
        try:
            yield
        finally:
            self.seconds[name] = round(time.perf_counter() - start, 4)


def run_id() -> str:
    return datetime.now(UTC).strftime("run-%Y%m%dT%H%M%SZ")


def normalize(mentions: DataFrame, settings: Settings) -> DataFrame:
    """mentions with raw, processing and compact text, links, tags, language and text quality."""
    raw = x.squeeze(x.nfkc(F.col("source_text")))
    rows = mentions.withColumn("raw_text", raw)
    rows = rows.withColumns({"urls": x.urls(F.col("raw_text")), "hashtags": x.hashtags(F.col("raw_text"), F.col("explicit_hashtags")), "emojis": x.emojis(F.col("raw_text"))})
    rows = rows.withColumn("normalized", x.processing_text(F.col("raw_text"), F.col("hashtags"))).withColumn("text", x.compact_text(F.col("normalized")))
    hint = language.best_hint(F.col("raw_text"))
    given = F.col("explicit_language").isNotNull()
    rows = rows.withColumn("language_guess", F.when(given, language.canonical_label(F.col("explicit_language"))).otherwise(hint["language"]))
    gate = settings.gate.decide(F.col("raw_text"), F.col("text"), F.col("language_guess"))
    rows = rows.withColumn("gate", gate).withColumns({"language": F.col("gate.language"), "language_supported": F.col("gate.supported"), "language_rejection_reason": F.col("gate.reason"), "language_source": F.when(given, "explicit").otherwise("inferred")}).drop("gate")
    provider = F.when(given, "record").otherwise("heuristic")
    rows = rows.withColumns({
        "language_confidence": F.when(given, 1.0).otherwise(hint["confidence"]), "language_provider": provider, "language_provider_version": F.when(given, F.lit(None).cast("string")).otherwise("hints-v1"), "language_model_id": F.lit(None).cast("string"),
        "mixed_language_uncertain": F.col("language") == "mixed",
    })
    flags = language.quality_flags(F.col("raw_text"), F.col("normalized"), F.col("text"), F.size("urls"), F.size("emojis"), F.col("language_supported"))
    rows = rows.withColumn("text_quality_flags", flags)
    return rows.withColumns({
        "text_quality_label": language.quality_label(F.col("text_quality_flags")), "text_quality_score": language.quality_score(F.col("text_quality_flags")),
        "url_count": F.size("urls"), "links": F.array_distinct(F.concat("urls", "links")), "score": F.coalesce("sort_score", F.col("likes").cast("double"), F.lit(0.0)),
    })


def facts(spark: SparkSession, mentions: DataFrame, onto: dict, settings: Settings, previous_topics: DataFrame | None = None) -> dict[str, DataFrame]:
    """All fact tables from quality-scored mentions."""
    aliases = ontology.aliases(spark, onto)
    said = mentions.join(threads.contexts(mentions), "mention_id", "left").select("mention_id", "raw_text", "hashtags", "title", "context_text")
    entity = settle(linking.link(said, aliases, ontology.noise_terms(onto)), "entity_facts")
    targets = entity.where("canonical_entity_id is not null or concept_entity_id is not null").select("mention_id", F.col("text").alias("target_text"), F.coalesce("canonical_entity_id", "concept_entity_id").alias("target_key"))
    anchors = settle(semantics.anchors(mentions, targets, settings.cues), "anchors")
    parts = settle(semantics.segments(anchors), "segments")
    inherited = semantics.inherited_targets(targets, threads.lineage(mentions))
    mood = semantics.target_sentiment(anchors, parts, inherited)
    issue = settle(semantics.corroborate(semantics.issues(anchors, parts, settings.cues), mentions, "text"), "issue_facts")
    aspect = settle(semantics.aspects(anchors, parts), "aspect_facts")
    tagged = mentions.select("mention_id", "text")
    for table, column, name in ((targets, "target_key", "entities"), (aspect, "aspect", "aspects"), (issue, "issue_category", "issues")):
        tagged = tagged.join(table.groupBy("mention_id").agg(F.collect_set(column).alias(name)), "mention_id", "left")
    topic = settle(topics.best(topics.assignments(tagged, topics.prototypes(spark, onto))), "topic_facts")
    artifact = topics.stability(topics.artifacts(topic, topics.top_terms(topic, tagged), mentions), previous_topics)
    artifact = settle(artifact, "topic_artifacts")
    return {
        "fact_mentions": mentions,
        "fact_entity_mentions": entity,
        "fact_entity_candidate_clusters": entities.open_clusters(entity),
        "fact_threads": threads.summaries(mentions),
        "fact_dedup_clusters": mentions.where("dedup_cluster_id is not null").groupBy("dedup_cluster_id", "dedup_kind", "dedup_representative_id").agg(F.count(F.lit(1)).alias("cluster_size")),
        "fact_topics": topic.join(artifact.select("topic_key", "reporting_status"), "topic_key"),
        "fact_topic_artifacts": artifact,
        "fact_aspects": aspect,
        "fact_sentiment": semantics.mention_sentiment(parts),
        "fact_target_sentiment": mood,
        "fact_intents": mentions.select("mention_id", rules.intent(F.col("raw_text"), F.col("normalized")).alias("r")).select("mention_id", F.col("r.label").alias("intent"), F.col("r.confidence").alias("confidence")),
        "fact_issue_signals": issue,
        "fact_author_quality": spam.author_profiles(mentions),
    }


def dimensions(spark: SparkSession, mentions: DataFrame, onto: dict) -> dict[str, DataFrame]:
    day = F.to_date("posted_at")
    time_ = mentions.select(day.alias("date"), F.year(day).alias("year"), F.month(day).alias("month"), F.weekofyear(day).alias("week"), (F.weekday(day) + 1).alias("weekday")).distinct()
    return ontology.dimension_tables(spark, onto) | {"dim_projects": mentions.select("project_id", "task_id", "platform").distinct(), "dim_time": time_}


def build_reports(t: dict[str, DataFrame], weighting: str) -> dict[str, DataFrame]:
    column = {"raw": F.lit(1.0), "dedup": F.col("dedup_weight"), "quality": F.col("quality_weight")}[weighting]
    m = halves.mark_halves(t["fact_mentions"].withColumn("weight", column.cast("double")))
    return {
        "sov_report": reports.share_of_voice(t["fact_entity_mentions"], m, weighted=weighting != "raw"),
        "buzz_entities": reports.buzz(t["fact_entity_mentions"], "canonical_entity_id", m),
        "buzz_topics": reports.topic_buzz(t["fact_topics"], m, t["fact_topic_artifacts"]),
        "emerging_topics": reports.emerging_topics(t["fact_topic_artifacts"]),
        "top_issues": reports.top_issues(t["fact_issue_signals"], m),
        "thread_controversy": reports.controversy(t["fact_threads"], m, t["fact_sentiment"], t["fact_issue_signals"]),
        "creators": reports.breakdown(m, "author_id"),
        "initiators": reports.breakdown(m.where("depth = 0"), "author_id"),
        "sources": reports.breakdown(m, "platform"),
    }


def build_metrics(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    m, i = t["fact_mentions"], t["fact_issue_signals"]
    m = m.withColumn("weight", F.col("quality_weight")).withColumn("suspicious", F.col("mention_suspicious"))
    return {
        "volumes": metrics.volumes(m),
        "sov_by_mentions": metrics.share_of_voice(t["fact_entity_mentions"], m),
        "author_concentration": metrics.concentration(m, "author_id"),
        "channel_concentration": metrics.concentration(m, "platform"),
        "language_distribution": metrics.distribution(m, "language", of_all=True),
        "sentiment_distribution": metrics.distribution(t["fact_sentiment"], "sentiment"),
        "target_sentiment": metrics.distribution(t["fact_target_sentiment"], "sentiment"),
        "aspect_occurrences": metrics.aspect_occurrences(t["fact_aspects"]),
        "issue_rates": metrics.issue_rates(i, m),
        "issue_confirmed": metrics.confirmed(i),
        "issue_severe": metrics.severe(i),
        "interaction_structure": metrics.interaction_structure(t["fact_threads"]),
    }


def run(spark: SparkSession, source: str, ontology_path: str, out: str, settings: Settings | None = None, overlays: tuple[str, ...] = (), previous_topics: str | None = None) -> dict:
    """Read ``source``, write bronze, silver, marts and reports under ``out``, and return the manifest (also written)."""
    settings, timing, name = settings or Settings(), Timing(), run_id()
    onto = ontology.load(ontology_path, overlays)
    if errors := ontology.integrity_errors(onto):
        raise ValueError("ontology: " + "; ".join(errors))
    with timing.stage("ingest"):
        lines = records.read_records(spark, source)
        records.tee_lines(lines, f"{out}/bronze")
        checked = settle(validation.validated(lines, settings.strict), "checked")
        report = validation.report(checked).first().asDict()
        records.write_tables({"invalid": validation.error_items(checked), "field_profile": validation.field_profile(lines)}, f"{out}/bronze_checks")
        profile = spark.read.parquet(f"{out}/bronze_checks/field_profile")
        records.write_text_if_changed(spark, f"{out}/bronze_checks/report.md", validation.markdown(report, validation.counts(checked, "uap_type", valid_only=True), profile))
    with timing.stage("normalize"):
        rows = settle(normalize(validation.mentions(checked).dropDuplicates(["mention_id"]), settings), "normalized")
        kept = rows.where("language_supported") if settings.require_supported_language else rows
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("language_supported")).alias("unsupported")).first()
        left_out = seen["unsupported"] if settings.require_supported_language else 0
        filtered = {"normalized": seen["n"], "kept": seen["n"] - left_out, "filtered_out_records": left_out, "filtered_out_unsupported_language": left_out, "unsupported_language": seen["unsupported"]}
    with timing.stage("quality"):
        unique = settle(dedup.annotate(kept, settings.near_duplicates), "dedup")
        scored = settle(spam.annotate(spam.mention_features(unique)), "quality")
    with timing.stage("facts"):
        before = spark.read.parquet(previous_topics) if previous_topics else None
        if before is None and settings.state_dir:
            before = records.latest_snapshot(spark, f"{settings.state_dir}/topics", name)
        tables = facts(spark, scored, onto, settings, before) | dimensions(spark, scored, onto)
        tables |= {f"fact_{n.replace('-', '_')}": providers.make("enricher", n)(scored) for n in settings.enrichers}
        for key, column, known in (("fact_topics", "topic_key", [t["id"] for t in onto["topics"]]), ("fact_entity_mentions", "canonical_entity_id", [e["id"] for e in onto["entities"]])):
            if wrong := ontology.alignment_errors(tables[key], column, known).limit(5).collect():
                raise ValueError(f"{key} names what the ontology lacks: {[r['label'] for r in wrong]}")
        paths = records.write_tables(tables, f"{out}/marts")
        tables = {k: spark.read.parquet(p) for k, p in paths.items()}
        if settings.state_dir:
            records.save_snapshot(tables["fact_topic_artifacts"], f"{settings.state_dir}/topics", name)
    with timing.stage("review"):
        labels = tables["fact_intents"].join(scored.select("mention_id", "raw_text"), "mention_id").select("mention_id", F.lit("intent").alias("kind"), F.col("raw_text").alias("text"), F.col("intent").alias("label"), "confidence")
        open_items = review.queue(tables["fact_entity_mentions"].withColumn("target_text", F.col("text")).withColumn("confidence", F.col("link_confidence")), labels)
        records.write_tables({"review_queue": review.with_signature(open_items), "review_groups": review.groups(open_items)}, f"{out}/review", "json")
    with timing.stage("reports"):
        built = build_reports(tables, settings.weighting)
        stored = records.write_tables(built, f"{out}/reports", "json")
        ranked = [spark.read.schema(built[k].schema).json(stored[k]) for k in ("sov_report", "buzz_topics", "emerging_topics", "top_issues", "thread_controversy", "creators")]
        records.write_tables({"insight_cards": reports.insight_cards(*ranked)}, f"{out}/reports", "json")
        records.write_tables(build_metrics(tables), f"{out}/metrics", "json")
    manifest = {"run_id": name, "source": records.inspect(spark, source), "domain": onto["domain_id"], "ontology": ontology.fingerprint(ontology_path), "records": report, "filtered": filtered, "weighting": settings.weighting, "seconds": timing.seconds, "marts": sorted(paths)}
    records.write_text_if_changed(spark, f"{out}/manifest.json", json.dumps(manifest, indent=2, sort_keys=True))
    return manifest


def load_reports(spark: SparkSession, out: str, names: tuple[str, ...] = ("sov_report", "insight_cards")) -> dict[str, DataFrame]:
    """Reports of a finished run."""
    return {n: spark.read.json(f"{out}/reports/{n}") for n in names}
