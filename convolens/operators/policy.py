"""Review policy: contexts, scope keys, grouping and applicability of decisions, checks of contributions, stored reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalize_alias
from ..sources.records import upsert_latest

SIGNATURE_VERSION = 2
# How items of a problem class are grouped - the scope, what has to match, and which knowledge must be the same.
GROUPING = {
    "low_confidence_label": ("task_ontology", "classification_label", "base_with_non_review_overlays"),
    "ambiguous_alias": ("project_ontology", "ambiguity_set", "reviewed_state_sensitive"),
    "suspicious_noise": ("project_ontology", "normalized_form_and_type", "reviewed_state_sensitive"),
}
DEFAULT_GROUPING = ("project_ontology", "normalized_form_and_type", "reviewed_state_sensitive")
#: Scopes that a record's project, task and thread belong to, and those that knowledge belongs to.
WITH_PROJECT, WITH_TASK, WITH_THREAD = ("project", "project_ontology", "task", "task_ontology", "thread_ontology"), ("task", "task_ontology", "thread_ontology"), ("thread_ontology",)
WITH_KNOWLEDGE = ("project_ontology", "task_ontology", "thread_ontology")
#: Knowledge that each mode compares: the ontology, its overlays, and what reviews added.
WITH_OVERLAY = ("base_with_non_review_overlays", "reviewed_state_sensitive", "exact_full_state")
WITH_REVIEWS = ("reviewed_state_sensitive", "exact_full_state")
EFFECTS = {"future_overlay": "apply_alias_overlay", "future_noise_suppression": "apply_noise_suppression"}

#: What annotation tools exchange: tasks out, annotations in.
TASK_SCHEMA = T.StructType(
    [
        T.StructField("task_id", T.StringType(), False), T.StructField("mention_id", T.StringType()), T.StructField("text", T.StringType()), T.StructField("context", T.StringType()),
        T.StructField("predictions", T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("label", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("score", T.DoubleType())]))),
    ]
)
ANNOTATION_SCHEMA = T.StructType(
    [
        T.StructField("task_id", T.StringType(), False), T.StructField("annotator", T.StringType()), T.StructField("created_at", T.TimestampType()),
        T.StructField("result", T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("label", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))),
    ]
)


def fingerprint(*parts: Column) -> Column:
    """Sixteen hex digits of the parts in order; a null part differs from an empty one."""
    return F.left(F.sha2(F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts)), 256), F.lit(16))


def language_family(c: Column) -> Column:
    """A language tag's first part in lower case."""
    return F.nullif(F.lower(F.substring_index(F.translate(c, "_", "-"), "-", 1)), F.lit(""))


CONTEXT = ("project_id", "task_id", "platform", "root_id", "language", "ontology_fingerprint", "overlay_fingerprint", "reviewed_fingerprint")


def with_context(items: DataFrame, ontology: str, overlay: str = "none", reviewed: str = "none") -> DataFrame:
    """``items`` (project_id, task_id, platform, root_id, language) with the knowledge they were made with, language_family,
    static_fingerprint, knowledge_fingerprint and context_fingerprint."""
    rows = items.withColumns({"ontology_fingerprint": F.lit(ontology), "overlay_fingerprint": F.lit(overlay), "reviewed_fingerprint": F.lit(reviewed), "language_family": language_family(F.col("language"))})
    version = F.lit(SIGNATURE_VERSION)
    return rows.withColumns(
        {
            "static_fingerprint": fingerprint(*(F.col(c) for c in ("project_id", "task_id", "platform", "root_id", "language_family")), version),
            "knowledge_fingerprint": fingerprint(*(F.col(c) for c in ("ontology_fingerprint", "overlay_fingerprint", "reviewed_fingerprint")), version),
            "context_fingerprint": fingerprint(*(F.col(c) for c in CONTEXT), F.col("language_family"), version),
        }
    )


def _chosen(place: int) -> Column:
    out = F.lit(DEFAULT_GROUPING[place])
    for name, values in GROUPING.items():
        out = F.when(F.col("problem_class") == name, values[place]).otherwise(out)
    return out


def relevant_knowledge(contributions: DataFrame) -> DataFrame:
    """(normalized_text, relevant_fingerprint): of the reviewed aliases and noise terms (normalized_text, kind, target_id) of one
    text; what reviews said of other texts doesn't regroup its items."""
    each = F.concat_ws("=", "kind", F.coalesce("target_id", F.lit("")))
    return contributions.groupBy("normalized_text").agg(F.array_join(F.array_sort(F.collect_set(each)), "|").alias("said")).select("normalized_text", fingerprint(F.col("said")).alias("relevant_fingerprint"))


def with_policy(items: DataFrame, contributions: DataFrame | None = None) -> DataFrame:
    """``items`` (see with_context, with problem_class, signature and normalized_text) with scope_level, match_mode,
    knowledge_mode, scope_key and group_fingerprint: items of equal group_fingerprint are settled together."""
    rows = items.withColumns({"scope_level": _chosen(0), "match_mode": _chosen(1), "knowledge_mode": _chosen(2)})
    if contributions is not None:
        rows = rows.join(relevant_knowledge(contributions), "normalized_text", "left").withColumn("relevant_fingerprint", F.coalesce("relevant_fingerprint", F.lit("none")))
    else:
        rows = rows.withColumn("relevant_fingerprint", F.lit("none"))
    level, mode = F.col("scope_level"), F.col("knowledge_mode")
    knows = level.isin(*WITH_KNOWLEDGE)
    key = fingerprint(
        level, F.when(level.isin(*WITH_PROJECT), F.col("project_id")), F.when(level.isin(*WITH_TASK), F.col("task_id")), F.when(level.isin(*WITH_THREAD), F.col("root_id")),
        F.when(knows & (mode != "ignore"), F.col("ontology_fingerprint")), F.when(knows & mode.isin(*WITH_OVERLAY), F.col("overlay_fingerprint")), F.when(knows & mode.isin(*WITH_REVIEWS), F.col("relevant_fingerprint")), F.lit(SIGNATURE_VERSION),
    )
    rows = rows.withColumn("scope_key", key)
    return rows.withColumn("group_fingerprint", fingerprint(F.lit(SIGNATURE_VERSION), F.col("problem_class"), F.col("signature"), F.col("scope_key")))


def with_applicability(decisions: DataFrame) -> DataFrame:
    """``decisions`` (resolution_scope, authority_level item or group, ontology_fingerprint of their scope) with future_effect,
    knowledge_match and terminates_future: what a decision does to items yet to come."""
    effect = F.lit("none")
    for scope, value in EFFECTS.items():
        effect = F.when(F.col("resolution_scope") == scope, value).otherwise(effect)
    rows = decisions.withColumn("future_effect", effect)
    none = F.col("future_effect") == "none"
    match = F.when(F.col("ontology_fingerprint").isNull(), "ignore").when(none, "exact_full_state").otherwise("base_with_non_review_overlays")
    ends = none & ((F.col("resolution_scope") == "close_only") | (F.col("authority_level") == "group"))
    return rows.withColumns({"knowledge_match": match, "terminates_future": ends})


def checked_contributions(new: DataFrame, aliases: DataFrame, noise: DataFrame, entity_ids: DataFrame) -> DataFrame:
    """``new`` (contribution_id, kind alias, noise or remap, text, target_id) with problem, null where it may be taken over: an
    alias needs a text, a known target and no other meaning, and noise must not be an alias in use."""
    rows = new.withColumn("normalized_text", normalize_alias(F.coalesce("text", F.lit(""))))
    used = aliases.groupBy(F.col("normalized").alias("normalized_text")).agg(F.array_sort(F.collect_set("canonical_entity_id")).alias("targets"))
    silent = noise.select(F.col("normalized").alias("normalized_text"), F.lit(True).alias("suppressed")).distinct()
    known = entity_ids.select(F.col("id").alias("target_id"), F.lit(True).alias("known")).distinct()
    rows = rows.join(used, "normalized_text", "left").join(silent, "normalized_text", "left").join(known, "target_id", "left")
    targets = F.coalesce("targets", F.array().cast("array<string>"))
    other = (F.size(targets) > 0) & (targets != F.array("target_id"))
    problem = (
        F.when(F.col("kind").isin("alias", "remap") & F.col("known").isNull(), "unknown_target").when((F.col("kind") != "remap") & (F.col("normalized_text") == ""), "empty_text")
        .when((F.col("kind") == "alias") & F.col("suppressed"), "suppressed_as_noise").when((F.col("kind") == "alias") & other, "maps_to_another").when((F.col("kind") == "noise") & (F.size(targets) > 0), "alias_in_use")
    )
    return rows.select(*new.columns, problem.alias("problem"))


def overlay_problems(ontology: dict, overlay: dict) -> list[str]:
    """What an overlay would break: the integrity errors of the ontology with it that are not there without."""
    from .ontology import integrity_errors
    from .ontology import overlay as laid_over

    before = set(integrity_errors(ontology))
    return [e for e in integrity_errors(laid_over(ontology, overlay)) if e not in before]


def assigned(items: DataFrame, groups: DataFrame) -> DataFrame:
    """``items`` with group_id of the open group of their fingerprint, or of a new one named after it."""
    known = groups.where("status = 'open'").groupBy("group_fingerprint").agg(F.min("group_id").alias("group_id"))
    return items.join(known, "group_fingerprint", "left").withColumn("group_id", F.coalesce("group_id", F.concat(F.lit("grp-"), "group_fingerprint")))


def rebuilt_groups(items: DataFrame) -> DataFrame:
    """(group_id, group_fingerprint, problem_class, items, open_items, mentions, status, first_seen, last_seen) from assigned items
    with status and created_at; a group with an open item is open, also one that was closed before."""
    out = items.groupBy("group_id", "group_fingerprint").agg(
        F.min("problem_class").alias("problem_class"), F.count(F.lit(1)).alias("items"), F.count_if(F.col("status") == "open").alias("open_items"), F.count_distinct("mention_id").alias("mentions"),
        F.min("created_at").alias("first_seen"), F.max("created_at").alias("last_seen"),
    )
    return out.withColumn("status", F.when(F.col("open_items") > 0, "open").otherwise("resolved"))


def propagated(items: DataFrame, decisions: DataFrame) -> DataFrame:
    """``items`` (item_id, group_id, status) with the action that settles them: their own decision (item_id), else the latest of
    their group; a decision that ends future authority settles only items made before it."""
    order = F.struct("created_at", "decision_id")
    own = decisions.where("item_id is not null").groupBy("item_id").agg(F.max_by(F.struct("decision_id", "action"), order).alias("own"))
    whole = decisions.where("item_id is null").groupBy("group_id").agg(F.max_by(F.struct("decision_id", "action", "terminates_future", "created_at"), order).alias("whole"))
    rows = items.join(own, "item_id", "left").join(whole, "group_id", "left")
    later = F.col("whole.terminates_future") & (F.col("created_at") > F.col("whole.created_at"))
    took = F.when(F.col("own").isNotNull(), F.col("own")).when(F.col("whole").isNotNull() & ~F.coalesce(later, F.lit(False)), F.struct("whole.decision_id", "whole.action"))
    rows = rows.withColumn("took", took)
    return rows.select(*items.columns, F.col("took.decision_id").alias("decision_id"), F.col("took.action").alias("action"), F.when(F.col("took").isNotNull(), "resolved").otherwise(F.col("status")).alias("new_status"))


def overlay_rows(decisions: DataFrame) -> DataFrame:
    """(kind, normalized_text, target_id, project_id, decision_id) of standing decisions that go on in an overlay: aliases and noise
    terms, the latest of each text and project."""
    live = decisions.where(F.col("future_effect") != "none")
    best = live.groupBy("normalized_text", "project_id").agg(F.max_by(F.struct("future_effect", "target_id", "decision_id"), F.struct("created_at", "decision_id")).alias("b"))
    kind = F.when(F.col("b.future_effect") == "apply_alias_overlay", "alias").otherwise("noise")
    return best.select(kind.alias("kind"), "normalized_text", F.when(kind == "alias", F.col("b.target_id")).alias("target_id"), "project_id", F.col("b.decision_id").alias("decision_id"))


def export_reviews(rows: DataFrame, path: str) -> None:
    """Items, groups or decisions as JSON lines, with a key order that doesn't change."""
    rows.select(*sorted(rows.columns)).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


DECISIONS = "decision_id string, item_id string, group_id string, action string, created_at timestamp"


def import_decisions(spark: SparkSession, path: str, known: DataFrame, schema: str = DECISIONS) -> DataFrame:
    """``known`` with the decisions of JSON lines added; of one decision_id the latest stays, and lines without one or without an
    action are left out."""
    new = spark.read.schema(schema).json(path).where("decision_id is not null and action is not null")
    return upsert_latest(known, new, ["decision_id"], "created_at")


#: Versions of the stored review tables: what each added.
MIGRATIONS = {1: "items, groups and decisions", 2: "signatures with knowledge state"}


def schema_version(spark: SparkSession, folder: str) -> int:
    """The version that a review store was last brought to; 0 for none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/schema_version")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return 0
    return spark.read.schema("version int, applied_at timestamp").parquet(f"{folder}/schema_version").agg(F.max("version")).first()[0] or 0


def migrate(spark: SparkSession, folder: str) -> list[int]:
    """Bring a review store to the newest version; the versions that were applied."""
    now = schema_version(spark, folder)
    todo = [v for v in sorted(MIGRATIONS) if v > now]
    if todo:
        spark.createDataFrame([(v,) for v in todo], "version int").withColumn("applied_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{folder}/schema_version")
    return todo


def ready(spark: SparkSession, folder: str) -> bool:
    return schema_version(spark, folder) == max(MIGRATIONS)


class ReviewSession:
    """Changes to stored review tables that are all written or not at all: each table's new state goes to a folder of its own,
    and the commit appends one row that names them.  Readers see the tables of the last commit."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.changes = spark, folder.rstrip("/"), {}

    def _log(self) -> DataFrame | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.spark.read.schema("number long, tables map<string,string>").parquet(f"{self.folder}/commits")

    def _last(self) -> tuple[int, dict[str, str]]:
        log = self._log()
        row = None if log is None else log.orderBy(F.desc("number")).first()
        return (0, {}) if row is None else (row["number"], dict(row["tables"]))

    def table(self, name: str) -> DataFrame | None:
        path = self._last()[1].get(name)
        return None if path is None else self.spark.read.parquet(path)

    def put(self, name: str, rows: DataFrame) -> None:
        self.changes[name] = rows

    def __enter__(self) -> ReviewSession:
        return self

    def __exit__(self, kind, *_) -> None:
        changes, self.changes = self.changes, {}
        if kind is not None or not changes:
            return
        number, paths = self._last()
        for name, rows in changes.items():
            paths[name] = f"{self.folder}/{name}/v{number + 1}"
            rows.write.mode("overwrite").parquet(paths[name])
        self.spark.createDataFrame([(number + 1, paths)], "number long, tables map<string,string>").coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")
