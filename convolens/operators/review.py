"""Human review: queue, signatures, groups, decisions in force, suppression, and feedback.

Decisions are append-only rows; what is in force is derived from them, so writers never change each other's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import ratio
from ..functions.text import normalize_alias

ENTITY_CONFIDENCE = 0.65
LABEL_CONFIDENCE = 0.55
NOISE = ("noise_term", "bad_weak_span")
AMBIGUOUS = ("ambiguous_alias", "ambiguous_multi_candidate")
#: Scopes from narrow to wide; a narrower decision wins.
SCOPES = ("mention", "thread", "project", "domain", "global")


def queue(entities: DataFrame, labels: DataFrame) -> DataFrame:
    """(mention_id, kind, text, label, confidence, reason): unresolved or unsure entity facts that aren't noise, and
    unsure labels.  ``labels`` carries mention_id, kind, text, label, confidence."""
    open_ = entities.where(((F.col("canonical_entity_id").isNull()) | (F.col("confidence") < ENTITY_CONFIDENCE)) & ~F.coalesce(F.col("unresolved_reason").isin(*NOISE), F.lit(False)))
    a = open_.select("mention_id", F.lit("entity").alias("kind"), F.col("target_text").alias("text"), F.col("canonical_entity_id").alias("label"), "confidence", F.col("unresolved_reason").alias("reason"))
    b = labels.where(F.col("confidence") < LABEL_CONFIDENCE).select("mention_id", "kind", "text", "label", "confidence", F.lit(None).cast("string").alias("reason"))
    return a.unionByName(b)


def problem_class() -> Column:
    r = F.col("reason")
    return F.when(F.col("kind") != "entity", "low_confidence_label").when(r.isin(*AMBIGUOUS), "ambiguous_alias").when(F.col("label").isNull(), "unresolved_entity").otherwise("low_confidence_entity")


def with_signature(items: DataFrame) -> DataFrame:
    """Adds problem_class, normalized_text and signature: items that one decision can settle share it."""
    rows = items.withColumns({"problem_class": problem_class(), "normalized_text": normalize_alias(F.coalesce("text", F.lit("")))})
    return rows.withColumn("signature", F.left(F.sha2(F.to_json(F.struct("kind", F.coalesce("label", F.lit("")).alias("label"), "normalized_text", "problem_class")), 256), F.lit(16)))


def groups(items: DataFrame) -> DataFrame:
    """(signature, problem_class, normalized_text, occurrences, mentions, lowest_confidence)."""
    return with_signature(items).groupBy("signature", "problem_class", "normalized_text").agg(
        F.count(F.lit(1)).alias("occurrences"), F.count_distinct("mention_id").alias("mentions"), F.min("confidence").alias("lowest_confidence")
    )


def page(rows: DataFrame, order: list, offset: int, limit: int) -> DataFrame:
    return rows.orderBy(*order).offset(offset).limit(limit)


def in_force(decisions: DataFrame) -> DataFrame:
    """The decision of each (signature, scope_level, scope_id) that holds: the latest one by (created_at, decision_id)
    that no later decision names in ``supersedes``, unless its action is ``terminate``."""
    named = decisions.where("supersedes is not null").select(F.col("supersedes").alias("gone"), F.struct("created_at", "decision_id").alias("by")).groupBy("gone").agg(F.max("by").alias("by"))
    alive = decisions.join(named, (F.col("decision_id") == F.col("gone")) & (F.col("by") > F.struct("created_at", "decision_id")), "left_anti")
    latest = Window.partitionBy("signature", "scope_level", "scope_id").orderBy(F.desc("created_at"), F.desc("decision_id"))
    return alive.withColumn("place", F.row_number().over(latest)).where("place = 1 and action <> 'terminate'").drop("place")


def scope_rank(level: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, SCOPES)), level)


def effective(items: DataFrame, decisions: DataFrame) -> DataFrame:
    """items (signature and a column for each scope: mention_id, root_id, project_id, domain_id) with the action of the
    decision that applies: the narrowest scope, then the latest."""
    held = in_force(decisions).select("signature", "scope_level", "scope_id", "action", "created_at", "decision_id")
    scopes = {"mention": F.col("mention_id"), "thread": F.col("root_id"), "project": F.col("project_id"), "domain": F.col("domain_id"), "global": F.lit("*")}
    own = items.withColumn("s", F.explode(F.array(*(F.struct(F.lit(k).alias("scope_level"), v.alias("scope_id")) for k, v in scopes.items())))).select("*", "s.*").drop("s")
    best = F.min_by(F.struct("action", "decision_id"), F.struct(scope_rank(F.col("scope_level")), -F.unix_micros("created_at"), F.col("decision_id")))
    found = own.join(held, ["signature", "scope_level", "scope_id"]).groupBy("signature", "mention_id").agg(best.alias("b")).select("signature", "mention_id", "b.*")
    return items.join(found, ["signature", "mention_id"], "left")


def suppress(items: DataFrame, decisions: DataFrame) -> DataFrame:
    """Items that no standing decision for the future covers.  A decision's null problem_class or project matches any."""
    standing = in_force(decisions.where("future_effect = 'apply'")).select(F.col("normalized_text").alias("t"), F.col("problem_class").alias("c"), F.col("project_id").alias("p"))
    match = (F.col("normalized_text") == F.col("t")) & (F.col("c").isNull() | (F.col("c") == F.col("problem_class"))) & (F.col("p").isNull() | (F.col("p") == F.col("project_id")))
    return items.join(standing, match, "left_anti")


def scope_relation(a: dict[str, str | None], b: dict[str, str | None]) -> str:
    """How the set of records that ``a`` admits stands to that of ``b``; a missing constraint admits everything."""
    left, right = ({k: v for k, v in x.items() if v is not None} for x in (a, b))
    if any(k in right and right[k] != v for k, v in left.items()):
        return "disjoint"
    if left == right:
        return "same"
    if left.items() <= right.items():
        return "broader"
    return "narrower" if right.items() <= left.items() else "overlapping"


def reconcile(old: list[dict], new: dict) -> str:
    """What a new alias or noise contribution does to those there: identical, reject, replace or coexist.

    The same claim in the same scope is identical; one that a broader claim already covers is rejected; one that covers
    narrower equal claims replaces them; a different meaning in the same scope replaces, elsewhere it coexists."""
    for x in old:
        if x["key"] != new["key"]:
            continue
        relation = scope_relation(x.get("scope", {}), new.get("scope", {}))
        same = x["value"] == new["value"]
        if same and relation == "same":
            return "identical"
        if same and relation == "broader":
            return "reject"
        if (same and relation == "narrower") or (not same and relation == "same"):
            return "replace"
    return "coexist"


def metrics(items: DataFrame) -> DataFrame:
    """One row: items, groups, and shares by state (column status: open, resolved, suppressed)."""
    row = items.agg(F.count(F.lit(1)).alias("items"), F.count_distinct("signature").alias("groups"), *(F.count_if(F.col("status") == s).alias(s) for s in ("open", "resolved", "suppressed")))
    return row.select("items", "groups", *(ratio(F.col(s), F.col("items")).alias(f"{s}_ratio") for s in ("open", "resolved", "suppressed")), ratio(F.col("groups"), F.col("items")).alias("grouping_ratio"))


def decide(item: dict, action: str, scope_level: str = "mention", **fields) -> dict:
    """A decision row for one item; group decisions carry a wider scope."""
    if scope_level not in SCOPES:
        raise ValueError(f"unknown scope: {scope_level}")
    if action == "remap" and not fields.get("target_id"):
        raise ValueError("a remap names its target")
    return {"signature": item["signature"], "scope_level": scope_level, "action": action, **fields}


def match_feedback(facts: DataFrame, feedback: DataFrame) -> DataFrame:
    """facts with the label of the best feedback row of their kind: one that names the mention before one that names the
    normalised text, then the latest."""
    own = feedback.where("mention_id is not null").groupBy("kind", "mention_id").agg(F.max_by("label", F.struct("created_at", "feedback_id")).alias("own_label"))
    general = feedback.where("mention_id is null").groupBy("kind", "normalized_text").agg(F.max_by("label", F.struct("created_at", "feedback_id")).alias("general_label"))
    rows = facts.join(own, ["kind", "mention_id"], "left").join(general, ["kind", "normalized_text"], "left")
    rows = rows.withColumn("feedback_label", F.coalesce("own_label", "general_label")).withColumn("label", F.coalesce("feedback_label", "label"))
    return rows.select(*facts.columns, "feedback_label")


def promote(annotations: DataFrame, least_agreement: int = 2) -> DataFrame:
    """(kind, normalized_text, label, votes): labels that enough annotators gave and no other label matches."""
    votes = annotations.groupBy("kind", "normalized_text", "label").agg(F.count_distinct("annotator").alias("votes"))
    w = Window.partitionBy("kind", "normalized_text")
    rows = votes.withColumn("best", F.max("votes").over(w)).withColumn("ties", F.sum(F.when(F.col("votes") == F.col("best"), 1).otherwise(0)).over(w))
    return rows.where((F.col("votes") == F.col("best")) & (F.col("votes") >= least_agreement)).withColumn("n", F.count(F.lit(1)).over(w)).where("n = 1").select("kind", "normalized_text", "label", "votes")
