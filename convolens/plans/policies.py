"""Queries over review policy: contexts, groups, applicability, checks, propagation and overlays."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters as a
from ..operators import policy
from ..tables import load

QUERIES = {}
ORACLE_SQL = {}


def query(name: str, oracle: str | None = None, *adapters: str):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLE_SQL[name] = a.sql(oracle, *adapters) if adapters else oracle
        return f

    return add


CLASSES = ("low_confidence_label", "ambiguous_alias", "suspicious_noise", "unresolved_entity")
LANGUAGES = ("en-US", "vi", "pt_BR", None)
pick = lambda values: f"([{', '.join('NULL' if v is None else repr(v) for v in values)}])"
#: Events as review items.
ITEMS = f"""items AS (SELECT event_id::VARCHAR AS item_id, user_id::VARCHAR AS mention_id, 'p' || user_id % 3 AS project_id, 't' || user_id % 5 AS task_id, event_type AS platform, 'r' || user_id % 11 AS root_id, {pick(LANGUAGES)}[event_id % 4 + 1] AS language,
    {pick(CLASSES)}[event_id % 4 + 1] AS problem_class, 's' || event_id % 6 AS signature, 'text ' || event_id % 9 AS normalized_text, CASE WHEN event_id % 3 = 0 THEN 'open' ELSE 'resolved' END AS status, ts AS created_at FROM events)"""


def items(s, d):
    e, i, u = load(s, d, "events"), F.col("event_id"), F.col("user_id")
    text = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    choose = lambda values, c: F.get(F.array(*map(F.lit, values)), (c % len(values)).cast("int"))
    return e.select(
        i.cast("string").alias("item_id"), u.cast("string").alias("mention_id"), text("p", u % 3).alias("project_id"), text("t", u % 5).alias("task_id"), F.col("event_type").alias("platform"), text("r", u % 11).alias("root_id"),
        choose(LANGUAGES, i).alias("language"), choose(CLASSES, i).alias("problem_class"), text("s", i % 6).alias("signature"), text("text ", i % 9).alias("normalized_text"), F.when(i % 3 == 0, "open").otherwise("resolved").alias("status"), F.col("ts").alias("created_at"),
    )


def print_sql(*parts: str) -> str:
    joined = " || chr(31) || ".join(f"coalesce(({p})::VARCHAR, chr(0))" for p in parts)
    return f"left(sha256({joined}), 16)"


FAMILY = "nullif(lower(string_split(replace(language, '_', '-'), '-')[1]), '')"
CONTEXT = f"""c AS (SELECT *, {FAMILY} AS family, {print_sql('project_id', 'task_id', 'platform', 'root_id', FAMILY, '2')} AS static_fingerprint, {print_sql("'onto'", "'over'", "'rev'", '2')} AS knowledge_fingerprint,
    {print_sql('project_id', 'task_id', 'platform', 'root_id', 'language', "'onto'", "'over'", "'rev'", FAMILY, '2')} AS context_fingerprint FROM items)"""
context = lambda s, d: policy.with_context(items(s, d), "onto", "over", "rev")
query("review_contexts", f"WITH {ITEMS}, {CONTEXT} SELECT item_id, family AS language_family, static_fingerprint, knowledge_fingerprint, context_fingerprint FROM c")(
    lambda s, d: context(s, d).select("item_id", "language_family", "static_fingerprint", "knowledge_fingerprint", "context_fingerprint")
)
#: Reviewed aliases and noise terms of some texts.
SAID = "said AS (SELECT 'text ' || p_size % 9 AS normalized_text, CASE WHEN p_partkey % 2 = 0 THEN 'alias' ELSE 'noise' END AS kind, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS target_id FROM part WHERE p_size % 9 < 4 AND p_partkey < 60)"


def contributions(s, d):
    p = load(s, d, "part").where("p_size % 9 < 4 and p_partkey < 60")
    even = F.col("p_partkey") % 2 == 0
    return p.select(F.concat(F.lit("text "), (F.col("p_size") % 9).cast("string")).alias("normalized_text"), F.when(even, "alias").otherwise("noise").alias("kind"), F.when(even, F.col("p_brand")).alias("target_id"))


RELEVANT = f"relevant AS (SELECT normalized_text, {print_sql('said')} AS relevant_fingerprint FROM (SELECT normalized_text, array_to_string(list_sort(list(DISTINCT kind || '=' || coalesce(target_id, ''))), '|') AS said FROM said GROUP BY normalized_text))"
query("relevant_knowledge", f"WITH {SAID}, {RELEVANT} SELECT * FROM relevant")(lambda s, d: policy.relevant_knowledge(contributions(s, d)))


def grouped_sql(place: int) -> str:
    return "CASE problem_class " + " ".join(f"WHEN '{k}' THEN '{v[place]}'" for k, v in policy.GROUPING.items()) + f" ELSE '{policy.DEFAULT_GROUPING[place]}' END"


KEY = print_sql("scope_level", "project_id", "CASE WHEN scope_level = 'task_ontology' THEN task_id END", "NULL", "'onto'", "'over'", "CASE WHEN knowledge_mode = 'reviewed_state_sensitive' THEN coalesce(relevant_fingerprint, 'none') END", "2")
POLICY = f"""g AS (SELECT i.*, {grouped_sql(0)} AS scope_level, {grouped_sql(1)} AS match_mode, {grouped_sql(2)} AS knowledge_mode, relevant_fingerprint FROM items i LEFT JOIN relevant USING (normalized_text)),
    k AS (SELECT *, {KEY} AS scope_key FROM g), p AS (SELECT *, {print_sql('2', 'problem_class', 'signature', 'scope_key')} AS group_fingerprint FROM k)"""
policed = lambda s, d: policy.with_policy(context(s, d), contributions(s, d))
query("review_group_keys", f"WITH {ITEMS}, {SAID}, {RELEVANT}, {POLICY} SELECT item_id, scope_level, match_mode, knowledge_mode, scope_key, group_fingerprint FROM p")(
    lambda s, d: policed(s, d).select("item_id", "scope_level", "match_mode", "knowledge_mode", "scope_key", "group_fingerprint")
)
#: Groups that were there before: those of the first items, some of them closed.
OLD = "old AS (SELECT 'g' || min(item_id::BIGINT) AS group_id, group_fingerprint, CASE WHEN min(item_id::BIGINT) % 2 = 0 THEN 'open' ELSE 'resolved' END AS status FROM p WHERE item_id::BIGINT < 40 GROUP BY group_fingerprint)"
ASSIGNED = f"assigned AS (SELECT p.*, coalesce(o.group_id, 'grp-' || p.group_fingerprint) AS group_id FROM p LEFT JOIN (SELECT * FROM old WHERE status = 'open') o USING (group_fingerprint))"


def assigned(s, d):
    rows = policed(s, d)
    first = F.min(F.col("item_id").cast("long"))
    old = rows.where("cast(item_id as bigint) < 40").groupBy("group_fingerprint").agg(F.concat(F.lit("g"), first.cast("string")).alias("group_id"), F.when(first % 2 == 0, "open").otherwise("resolved").alias("status"))
    return policy.assigned(rows, old)


query("review_assigned_groups", f"WITH {ITEMS}, {SAID}, {RELEVANT}, {POLICY}, {OLD}, {ASSIGNED} SELECT item_id, group_id FROM assigned")(lambda s, d: assigned(s, d).select("item_id", "group_id"))
query(
    "review_rebuilt_groups",
    f"""WITH {ITEMS}, {SAID}, {RELEVANT}, {POLICY}, {OLD}, {ASSIGNED} SELECT group_id, group_fingerprint, min(problem_class) AS problem_class, count(*) AS items, count_if(status = 'open') AS open_items, count(DISTINCT mention_id) AS mentions, min(created_at) AS first_seen,
    max(created_at) AS last_seen, CASE WHEN count_if(status = 'open') > 0 THEN 'open' ELSE 'resolved' END AS status FROM assigned GROUP BY group_id, group_fingerprint""",
)(lambda s, d: policy.rebuilt_groups(assigned(s, d)))
SCOPES = ("future_overlay", "future_noise_suppression", "close_only", "current_batch")
#: Orders as decisions, on items and on groups of items.
DECISIONS = f"""d AS (SELECT o_orderkey::VARCHAR AS decision_id, CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 500)::VARCHAR END AS item_id, 's' || o_custkey % 6 AS group_id, CASE o_orderkey % 3 WHEN 0 THEN 'accept' WHEN 1 THEN 'remap' ELSE 'reject' END AS action,
    {pick(SCOPES)}[o_orderkey % 4 + 1] AS resolution_scope, CASE WHEN o_orderkey % 2 = 0 THEN 'item' ELSE 'group' END AS authority_level, CASE WHEN o_custkey % 5 > 0 THEN 'onto' END AS ontology_fingerprint,
    'text ' || o_custkey % 9 AS normalized_text, 'p' || o_custkey % 3 AS project_id, 'e' || o_custkey % 7 AS target_id, TIMESTAMP '2024-01-01' + to_seconds(o_custkey) AS created_at FROM orders),
    f AS (SELECT *, CASE resolution_scope WHEN 'future_overlay' THEN 'apply_alias_overlay' WHEN 'future_noise_suppression' THEN 'apply_noise_suppression' ELSE 'none' END AS future_effect FROM d),
    e AS (SELECT *, CASE WHEN ontology_fingerprint IS NULL THEN 'ignore' WHEN future_effect = 'none' THEN 'exact_full_state' ELSE 'base_with_non_review_overlays' END AS knowledge_match,
        future_effect = 'none' AND (resolution_scope = 'close_only' OR authority_level = 'group') AS terminates_future FROM f)"""


def decisions(s, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda prefix, x: F.concat(F.lit(prefix), x.cast("string"))
    rows = load(s, d, "orders").select(
        k.cast("string").alias("decision_id"), F.when(k % 2 == 0, (k % 500).cast("string")).alias("item_id"), text("s", c % 6).alias("group_id"), F.when(k % 3 == 0, "accept").when(k % 3 == 1, "remap").otherwise("reject").alias("action"),
        F.get(F.array(*map(F.lit, SCOPES)), (k % 4).cast("int")).alias("resolution_scope"), F.when(k % 2 == 0, "item").otherwise("group").alias("authority_level"), F.when(c % 5 > 0, "onto").alias("ontology_fingerprint"),
        text("text ", c % 9).alias("normalized_text"), text("p", c % 3).alias("project_id"), text("e", c % 7).alias("target_id"), F.timestamp_seconds(F.lit(1704067200) + c).alias("created_at"),
    )
    return policy.with_applicability(rows)


query("decision_applicability", f"WITH {DECISIONS} SELECT decision_id, future_effect, knowledge_match, terminates_future FROM e")(lambda s, d: decisions(s, d).select("decision_id", "future_effect", "knowledge_match", "terminates_future"))
query(
    "review_propagation",
    f"""WITH {ITEMS}, {DECISIONS}, own AS (SELECT item_id, max_by(decision_id, (created_at, decision_id)) AS decision_id, max_by(action, (created_at, decision_id)) AS action FROM e WHERE item_id IS NOT NULL GROUP BY item_id),
    whole AS (SELECT group_id, max_by(decision_id, (created_at, decision_id)) AS decision_id, max_by(action, (created_at, decision_id)) AS action, max_by(terminates_future, (created_at, decision_id)) AS ends, max(created_at) AS at_ FROM e WHERE item_id IS NULL GROUP BY group_id),
    j AS (SELECT i.item_id, i.status, own.decision_id AS o, own.action AS oa, CASE WHEN whole.decision_id IS NOT NULL AND NOT (ends AND i.created_at > at_) THEN whole.decision_id END AS w, whole.action AS wa FROM items i LEFT JOIN own USING (item_id) LEFT JOIN whole ON i.signature = whole.group_id)
    SELECT item_id, coalesce(o, w) AS decision_id, CASE WHEN o IS NOT NULL THEN oa WHEN w IS NOT NULL THEN wa END AS action, CASE WHEN o IS NOT NULL OR w IS NOT NULL THEN 'resolved' ELSE status END AS new_status FROM j""",
)(lambda s, d: policy.propagated(items(s, d).withColumn("group_id", F.col("signature")), decisions(s, d)).select("item_id", "decision_id", "action", "new_status"))
query(
    "review_overlay",
    f"""WITH {DECISIONS}, b AS (SELECT normalized_text, project_id, max_by(future_effect, (created_at, decision_id)) AS x, max_by(target_id, (created_at, decision_id)) AS t, max_by(decision_id, (created_at, decision_id)) AS decision_id FROM e WHERE future_effect <> 'none' GROUP BY ALL)
    SELECT CASE x WHEN 'apply_alias_overlay' THEN 'alias' ELSE 'noise' END AS kind, normalized_text, CASE x WHEN 'apply_alias_overlay' THEN t END AS target_id, project_id, decision_id FROM b""",
)(lambda s, d: policy.overlay_rows(decisions(s, d)))
query(
    "contribution_checks",
    """WITH n AS (SELECT p_partkey AS contribution_id, CASE p_partkey % 3 WHEN 0 THEN 'alias' WHEN 1 THEN 'noise' ELSE 'remap' END AS kind, CASE WHEN p_size % 6 = 0 THEN '' WHEN p_size % 6 = 1 THEN 'junk' WHEN p_size % 6 = 2 THEN 'newer ' || p_name ELSE upper(p_name) END AS text,
        CASE WHEN p_size % 7 = 0 THEN 'nobody' WHEN p_size % 7 < 4 THEN p_name ELSE 'red widget' END AS target_id FROM part), a AS (SELECT DISTINCT p_name AS x FROM part), k AS (SELECT x FROM a UNION SELECT 'red widget')
    SELECT contribution_id, kind, text, target_id, CASE WHEN kind <> 'noise' AND target_id NOT IN (SELECT x FROM k) THEN 'unknown_target' WHEN kind <> 'remap' AND text = '' THEN 'empty_text' WHEN kind = 'alias' AND text = 'junk' THEN 'suppressed_as_noise'
    WHEN kind = 'alias' AND lower(text) IN (SELECT x FROM a) AND lower(text) <> target_id THEN 'maps_to_another' WHEN kind = 'noise' AND lower(text) IN (SELECT x FROM a) THEN 'alias_in_use' END AS problem FROM n""",
)(lambda s, d: _checks(s, d))


def _checks(s, d):
    p, size = load(s, d, "part"), F.col("p_size")
    new = p.select(
        F.col("p_partkey").alias("contribution_id"), F.when(F.col("p_partkey") % 3 == 0, "alias").when(F.col("p_partkey") % 3 == 1, "noise").otherwise("remap").alias("kind"),
        F.when(size % 6 == 0, "").when(size % 6 == 1, "junk").when(size % 6 == 2, F.concat(F.lit("newer "), "p_name")).otherwise(F.upper("p_name")).alias("text"),
        F.when(size % 7 == 0, "nobody").when(size % 7 < 4, F.col("p_name")).otherwise("red widget").alias("target_id"),
    )
    names = p.select(F.col("p_name").alias("normalized"), F.col("p_name").alias("canonical_entity_id")).distinct()
    return policy.checked_contributions(new, names, s.createDataFrame([("junk",)], "normalized string"), names.select(F.col("normalized").alias("id")).unionByName(s.createDataFrame([("red widget",)], "id string")))
