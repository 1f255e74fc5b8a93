"""Queries over what runs keep: latest rows, decisions, feedback, topics across runs, components, and the last reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters as a
from ..functions import text as x
from ..operators import components, metrics, ontology, reports, review, threads, topics
from ..sources import records
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


query(
    "upsert_latest",
    """WITH o AS (SELECT user_id AS id, event_type AS kind, ts, value, 0 AS new FROM events WHERE event_id % 2 = 0 UNION ALL SELECT user_id, event_type, ts, value, 1 FROM events WHERE event_id % 2 = 1)
    SELECT id, kind, max_by(ts, (ts, new)) AS ts, max_by(value, (ts, new)) AS value FROM o GROUP BY id, kind""",
)(lambda s, d: (lambda e: records.upsert_latest(e.where("event_id % 2 = 0").drop("event_id"), e.where("event_id % 2 = 1").drop("event_id"), ["id", "kind"], "ts"))(load(s, d, "events").select("event_id", F.col("user_id").alias("id"), F.col("event_type").alias("kind"), "ts", "value")))

#: Topics with numbers of a last run.
ARTIFACTS = """t AS (SELECT o_custkey AS k, 'topic.' || o_custkey AS topic_key, count(*) AS n, sum(o_totalprice) AS v FROM orders GROUP BY o_custkey),
    a AS (SELECT topic_key, (n * 7 % 40)::DOUBLE / 10.0::DOUBLE AS growth_delta, (k % 20)::DOUBLE / 20.0::DOUBLE AS quality_score, (k % 7)::DOUBLE / 7.0::DOUBLE AS reportability_score, n % 3 > 0 AS emerging_topic, CASE WHEN k % 5 = 0 THEN 'weak' ELSE 'reportable' END AS reporting_status FROM t)"""


def artifacts(s, d):
    t = load(s, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return t.select(
        F.concat(F.lit("topic."), F.col("k").cast("string")).alias("topic_key"), ((F.col("n") * 7 % 40) / 10.0).alias("growth_delta"), ((F.col("k") % 20) / 20.0).alias("quality_score"), ((F.col("k") % 7) / 7.0).alias("reportability_score"),
        (F.col("n") % 3 > 0).alias("emerging_topic"), F.when(F.col("k") % 5 == 0, "weak").otherwise("reportable").alias("reporting_status"),
    )


query("emerging_topics", f"WITH {ARTIFACTS} SELECT * FROM a WHERE emerging_topic AND reporting_status = 'reportable' ORDER BY growth_delta DESC, quality_score DESC, topic_key LIMIT 10")(lambda s, d: reports.emerging_topics(artifacts(s, d)))


def fixed(number: str, places: int) -> str:
    return f"printf('%.{places}f', {number})"


def to4(number: str) -> str:
    return f"floor(({number}) * 10000.0 + 0.5) / 10000.0"


NATIONS = "v AS (SELECT 'n' || n_nationkey AS canonical_entity_id, (n_nationkey + 1)::DOUBLE / 100.0::DOUBLE AS share, n_nationkey::BIGINT AS m FROM nation)"
query(
    "insight_cards",
    f"""WITH {ARTIFACTS}, {NATIONS}, top AS (SELECT * FROM v ORDER BY share DESC LIMIT 1), e AS (SELECT * FROM a WHERE emerging_topic ORDER BY growth_delta DESC, quality_score DESC, topic_key LIMIT 1)
    SELECT 'share_of_voice_shift' AS insight_type, 'Share of voice moved: ' || canonical_entity_id AS title, canonical_entity_id || ' gained ' || m || ' mentions in the later half' AS summary, {to4('least(0.55::DOUBLE + share / 2.0::DOUBLE, 0.9::DOUBLE)')} AS confidence FROM top
    UNION ALL SELECT 'trending_topic', 'Topic gaining volume: ' || canonical_entity_id, canonical_entity_id || ' stands in ' || m || ' mentions', {to4('least(0.5::DOUBLE + share * 0.1::DOUBLE, 0.86::DOUBLE)')} FROM top
    UNION ALL SELECT 'conversation_hotspot', 'Conversation gathers around ' || canonical_entity_id, canonical_entity_id || ' has a buzz score of ' || {fixed('share', 4)}, {to4('least(0.52::DOUBLE + share * 0.12::DOUBLE, 0.88::DOUBLE)')} FROM top
    UNION ALL SELECT 'emerging_topic', 'Emerging topic: ' || topic_key, topic_key || ' grew by ' || {fixed('growth_delta', 1)}, {to4('least(0.54::DOUBLE + quality_score * 0.14::DOUBLE + reportability_score * 0.18::DOUBLE, 0.92::DOUBLE)')} FROM e
    UNION ALL SELECT 'issue_warning', 'Issue pressure: ' || canonical_entity_id, canonical_entity_id || ' leads with ' || {fixed('share * 8.0::DOUBLE', 4)} || ' over ' || m || ' mentions', {to4('least(0.58::DOUBLE + (share * 8.0::DOUBLE) / greatest(share * 8.0::DOUBLE, 1.0::DOUBLE) * 0.18::DOUBLE, 0.86::DOUBLE)')} FROM top
    UNION ALL SELECT 'controversy_alert', 'Contested thread: ' || canonical_entity_id, 'Thread ' || canonical_entity_id || ' scores ' || {fixed('share', 4)}, {to4('least(0.52::DOUBLE + share * 0.25::DOUBLE, 0.84::DOUBLE)')} FROM top
    UNION ALL SELECT 'creator_concentration', 'Much from one creator: ' || canonical_entity_id, canonical_entity_id || ' wrote ' || m || ' mentions', {to4('least(0.5::DOUBLE + share * 0.5::DOUBLE, 0.8::DOUBLE)')} FROM top""",
)(lambda s, d: _cards(s, d))


def _cards(s, d):
    n = F.col("n_nationkey")
    v = load(s, d, "nation").select(F.concat(F.lit("n"), n.cast("string")).alias("key"), ((n + 1) / 100.0).alias("share"), n.cast("long").alias("m"))
    as_ = lambda **c: v.select(*(F.expr(e).alias(k) for k, e in c.items()))
    return reports.insight_cards(
        as_(canonical_entity_id="key", mention_share="share", entity_hit_share="share", delta_mention_count="m", delta_mention_share="share / 2"),
        as_(topic_key="key", buzz_score_proxy="share", effective_mention_count="m", mention_count="m", growth_ratio_proxy="share"),
        artifacts(s, d).where("emerging_topic"), as_(issue_category="key", issue_pressure_proxy="share * 8", mention_count="m"),
        as_(root_id="key", controversy_score_proxy="share", total_mentions="m"), as_(author_id="key", mention_count="m", conversation_share="share"),
    )


query(
    "controversial_threads_by_creator",
    "+h AS (SELECT root_id, count(*)::DOUBLE / 10.0::DOUBLE AS s FROM posts GROUP BY root_id) SELECT author_id, count(DISTINCT root_id) AS controversy_thread_count FROM posts WHERE root_id IN (SELECT root_id FROM h WHERE s >= 0.35) GROUP BY author_id",
    "posts",
)(lambda s, d: reports.controversial_threads_by_creator(a.posts(s, d), a.posts(s, d).groupBy("root_id").agg((F.count(F.lit(1)) / 10.0).alias("controversy_score_proxy"))))
query(
    "conversation_slice",
    "+RECURSIVE w AS (SELECT parent_id AS ancestor_id, 1::BIGINT AS distance FROM chain WHERE mention_id = '6:6' UNION ALL SELECT c.parent_id, distance + 1 FROM w JOIN chain c ON c.mention_id = w.ancestor_id WHERE distance < 3) SELECT * FROM w WHERE ancestor_id IS NOT NULL",
    "chain",
)(lambda s, d: threads.conversation_slice(a.chain(s, d), "6:6", 3).select("ancestor_id", F.col("distance").cast("long").alias("distance")))
query(
    "components_of_customers",
    """WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS u, o_orderkey % 97 + 1000000 AS v FROM orders WHERE o_orderkey % 40 = 0), b AS (SELECT u, v FROM e UNION SELECT v, u FROM e), w AS (SELECT u AS node, u AS root FROM b UNION SELECT b.v, w.root FROM w JOIN b ON w.node = b.u)
    SELECT node, min(root) AS root FROM w GROUP BY node""",
)(lambda s, d: components.connected_components(load(s, d, "orders").where("o_orderkey % 40 = 0").select(F.col("o_custkey").alias("u"), (F.col("o_orderkey") % 97 + 1_000_000).alias("v"))))

#: Decisions of several scopes over review items.
ITEMS = "i AS (SELECT event_id::VARCHAR AS mention_id, event_type AS signature, 'r' || user_id % 9 AS root_id, 'p' || user_id % 4 AS project_id, 'd' || user_id % 2 AS domain_id, 't' || event_id % 12 AS normalized_text, ['low_confidence_label', 'ambiguous_alias', 'unresolved_entity'][event_id % 3 + 1] AS problem_class, CASE event_id % 4 WHEN 0 THEN 'open' WHEN 1 THEN 'suppressed' ELSE 'resolved' END AS status FROM events)"
DECIDED = """d AS (SELECT o_orderkey::VARCHAR AS decision_id, (SELECT list(t ORDER BY t) FROM (SELECT DISTINCT event_type AS t FROM events))[o_orderkey % 3 + 1] AS signature, ['thread', 'project', 'domain', 'mention'][o_orderkey % 4 + 1] AS scope_level,
    CASE o_orderkey % 4 WHEN 0 THEN 'r' || o_custkey % 9 WHEN 1 THEN 'p' || o_custkey % 4 WHEN 2 THEN 'd' || o_custkey % 2 ELSE (o_custkey % 500)::VARCHAR END AS scope_id, CASE WHEN o_orderkey % 13 = 0 THEN 'terminate' ELSE 'a' || o_orderkey % 5 END AS action,
    TIMESTAMP '2024-01-01' + to_seconds(o_custkey) AS created_at, CASE WHEN o_orderkey % 17 = 0 THEN (o_orderkey - 17)::VARCHAR END AS supersedes, CASE WHEN o_orderkey % 6 = 0 THEN 'apply' ELSE 'none' END AS future_effect,
    't' || o_custkey % 12 AS normalized_text, CASE WHEN o_custkey % 2 = 0 THEN 'ambiguous_alias' END AS problem_class, CASE WHEN o_custkey % 3 = 0 THEN 'p' || o_custkey % 4 END AS project_id FROM orders),
    alive AS (SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM d n WHERE n.supersedes = d.decision_id AND (n.created_at, n.decision_id) > (d.created_at, d.decision_id))),
    held AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY signature, scope_level, scope_id ORDER BY created_at DESC, decision_id DESC) AS place FROM alive) WHERE place = 1 AND action <> 'terminate')"""


def items(s, d):
    i, u = F.col("event_id"), F.col("user_id")
    text = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    return load(s, d, "events").select(
        i.cast("string").alias("mention_id"), F.col("event_type").alias("signature"), text("r", u % 9).alias("root_id"), text("p", u % 4).alias("project_id"), text("d", u % 2).alias("domain_id"), text("t", i % 12).alias("normalized_text"),
        F.get(F.array(*map(F.lit, ("low_confidence_label", "ambiguous_alias", "unresolved_entity"))), (i % 3).cast("int")).alias("problem_class"), F.when(i % 4 == 0, "open").when(i % 4 == 1, "suppressed").otherwise("resolved").alias("status"),
    )


def decided(s, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    kinds = load(s, d, "events").agg(F.array_sort(F.collect_set("event_type")).alias("kinds"))
    text = lambda prefix, x_: F.concat(F.lit(prefix), x_.cast("string"))
    return metrics.with_total(load(s, d, "orders"), kinds).select(
        k.cast("string").alias("decision_id"), F.get("kinds", (k % 3).cast("int")).alias("signature"), F.get(F.array(*map(F.lit, ("thread", "project", "domain", "mention"))), (k % 4).cast("int")).alias("scope_level"),
        F.when(k % 4 == 0, text("r", c % 9)).when(k % 4 == 1, text("p", c % 4)).when(k % 4 == 2, text("d", c % 2)).otherwise((c % 500).cast("string")).alias("scope_id"), F.when(k % 13 == 0, "terminate").otherwise(text("a", k % 5)).alias("action"),
        F.timestamp_seconds(F.lit(1704067200) + c).alias("created_at"), F.when(k % 17 == 0, (k - 17).cast("string")).alias("supersedes"), F.when(k % 6 == 0, "apply").otherwise("none").alias("future_effect"), text("t", c % 12).alias("normalized_text"),
        F.when(c % 2 == 0, "ambiguous_alias").alias("problem_class"), F.when(c % 3 == 0, text("p", c % 4)).alias("project_id"),
    )


query(
    "review_effective",
    f"""WITH {ITEMS}, {DECIDED}, s AS (SELECT mention_id, signature, 'mention' AS scope_level, mention_id AS scope_id, 1 AS r FROM i UNION ALL SELECT mention_id, signature, 'thread', root_id, 2 FROM i UNION ALL SELECT mention_id, signature, 'project', project_id, 3 FROM i
    UNION ALL SELECT mention_id, signature, 'domain', domain_id, 4 FROM i), m AS (SELECT s.mention_id, h.action, h.decision_id, row_number() OVER (PARTITION BY s.mention_id ORDER BY r, created_at DESC, decision_id) AS p FROM s JOIN held h USING (signature, scope_level, scope_id))
    SELECT i.mention_id, action, decision_id FROM i LEFT JOIN m ON i.mention_id = m.mention_id AND p = 1""",
)(lambda s, d: review.effective(items(s, d), decided(s, d)).select("mention_id", "action", "decision_id"))
query(
    "review_suppressed",
    f"""WITH {ITEMS}, {DECIDED.replace("FROM d WHERE NOT EXISTS (SELECT 1 FROM d n", "FROM (SELECT * FROM d WHERE future_effect = 'apply') d WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM d WHERE future_effect = 'apply') n")}
    SELECT mention_id FROM i WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.normalized_text = i.normalized_text AND (h.problem_class IS NULL OR h.problem_class = i.problem_class) AND (h.project_id IS NULL OR h.project_id = i.project_id))""",
)(lambda s, d: review.suppress(items(s, d), decided(s, d)).select("mention_id"))
RATE = "floor({0}::DOUBLE / count(*)::DOUBLE * 10000.0 + 0.5) / 10000.0"
query(
    "review_metrics",
    f"WITH {ITEMS} SELECT count(*) AS items, count(DISTINCT signature) AS groups, " + ", ".join(f"{RATE.format(f"count_if(status = '{k}')")} AS {k}_ratio" for k in ("open", "resolved", "suppressed")) + f", {RATE.format('count(DISTINCT signature)')} AS grouping_ratio FROM i",
)(lambda s, d: review.metrics(items(s, d)))
FEEDBACK = """b AS (SELECT o_orderkey AS feedback_id, 'k' || o_custkey % 3 AS kind, CASE WHEN o_orderkey % 3 = 0 THEN (o_custkey % 700)::VARCHAR END AS mention_id, 't' || o_custkey % 40 AS normalized_text, o_orderpriority AS label, o_orderdate AS created_at FROM orders),
    f AS (SELECT event_id AS fact_id, 'k' || event_id % 4 AS kind, event_id::VARCHAR AS mention_id, 't' || event_id % 50 AS normalized_text, event_type AS label FROM events)"""


def feedback(s, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda prefix, x_: F.concat(F.lit(prefix), x_.cast("string"))
    return load(s, d, "orders").select(k.alias("feedback_id"), text("k", c % 3).alias("kind"), F.when(k % 3 == 0, (c % 700).cast("string")).alias("mention_id"), text("t", c % 40).alias("normalized_text"), F.col("o_orderpriority").alias("label"), F.col("o_orderdate").alias("created_at"))


query(
    "feedback_matches",
    f"""WITH {FEEDBACK}, own AS (SELECT kind, mention_id, max_by(label, (created_at, feedback_id)) AS own FROM b WHERE mention_id IS NOT NULL GROUP BY ALL), gen AS (SELECT kind, normalized_text, max_by(label, (created_at, feedback_id)) AS gen FROM b WHERE mention_id IS NULL GROUP BY ALL)
    SELECT fact_id, coalesce(own, gen) AS feedback_label, coalesce(own, gen, label) AS label FROM f LEFT JOIN own USING (kind, mention_id) LEFT JOIN gen USING (kind, normalized_text)""",
)(lambda s, d: review.match_feedback(
    load(s, d, "events").select(F.col("event_id").alias("fact_id"), F.concat(F.lit("k"), (F.col("event_id") % 4).cast("string")).alias("kind"), F.col("event_id").cast("string").alias("mention_id"), F.concat(F.lit("t"), (F.col("event_id") % 50).cast("string")).alias("normalized_text"), F.col("event_type").alias("label")),
    feedback(s, d),
).select("fact_id", "feedback_label", "label"))
query(
    "promoted_feedback",
    f"""WITH {FEEDBACK}, v AS (SELECT kind, normalized_text, label, count(DISTINCT feedback_id % 7) AS votes FROM b GROUP BY ALL), m AS (SELECT *, max(votes) OVER (PARTITION BY kind, normalized_text) AS best, count(*) OVER (PARTITION BY kind, normalized_text, votes) AS n FROM v)
    SELECT kind, normalized_text, label, votes FROM m WHERE votes = best AND votes >= 2 AND n = 1""",
)(lambda s, d: review.promote(feedback(s, d).withColumn("annotator", F.col("feedback_id") % 7)))
query(
    "topic_windows",
    "SELECT 'topic' || event_id % 12 AS topic_key, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS topic_size, count(DISTINCT user_id) AS authors FROM events GROUP BY 1",
)(lambda s, d: (lambda f: topics.artifacts(f.select("mention_id", "topic_key", F.lit(1.0).alias("score")), f.select("topic_key", F.lit(1).alias("place"), F.col("topic_key").alias("term")).distinct(), f).select("topic_key", "first_seen", "last_seen", "topic_size", "authors"))(a.facts(s, d)))
query(
    "topic_lineage",
    """WITH n AS (SELECT n_nationkey AS k, 'topic.' || n_nationkey AS topic_key, 's' || n_nationkey AS signature, ['w' || n_nationkey % 5, 'x' || n_nationkey % 3] AS terms FROM nation),
    o AS (SELECT topic_key, 1 AS rank, signature AS value FROM n UNION ALL SELECT topic_key, 2, unnest(terms) FROM n UNION ALL SELECT topic_key, 3, topic_key FROM n),
    known AS (SELECT DISTINCT 1 AS rank, 's' || n_nationkey AS value, 'old' || n_nationkey % 4 AS effective_key FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT DISTINCT 2, 'w' || n_nationkey % 5, 'old' || n_nationkey % 6 FROM nation WHERE n_nationkey % 5 < 2 UNION ALL SELECT DISTINCT 3, 'topic.' || n_nationkey, 'kept' FROM nation),
    h AS (SELECT topic_key, rank, effective_key, min(rank) OVER (PARTITION BY topic_key) AS best FROM o JOIN known USING (rank, value)), e AS (SELECT topic_key, CASE WHEN count(DISTINCT effective_key) = 1 THEN min(effective_key) END AS effective_key FROM h WHERE rank = best GROUP BY topic_key)
    SELECT topic_key, effective_key, coalesce(effective_key, topic_key) AS reporting_topic_key FROM n LEFT JOIN e USING (topic_key)""",
)(lambda s, d: _lineage(s, d))


def _lineage(s, d):
    n = F.col("n_nationkey")
    text = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    table = load(s, d, "nation")
    now = table.select(text("topic.", n).alias("topic_key"), text("s", n).alias("signature"), F.array(text("w", n % 5), text("x", n % 3)).alias("terms"))
    known = table.where(n % 3 == 0).select(F.lit("signature").alias("match"), text("s", n).alias("value"), text("old", n % 4).alias("effective_key"))
    known = known.unionByName(table.where(n % 5 < 2).select(F.lit("term").alias("match"), text("w", n % 5).alias("value"), text("old", n % 6).alias("effective_key")))
    known = known.unionByName(table.select(F.lit("key").alias("match"), text("topic.", n).alias("value"), F.lit("kept").alias("effective_key"))).distinct()
    return topics.with_reporting_key(topics.lineage(now, known)).select("topic_key", "effective_key", "reporting_topic_key")


query(
    "ontology_aliases",
    "SELECT * FROM (VALUES ('There Th', 'there th', 'thereth', 'brand.b0'), ('Elle', 'elle', 'elle', 'brand.b1')) v(alias, normalized, compact, canonical_entity_id)",
)(lambda s, d: ontology.aliases(s, {"entities": [{"id": f"brand.b{k}", "name": n, "entity_type": "brand"} for k, n in enumerate(("There Th", "Elle"))] + [{"id": "x", "name": "Off", "active_linking": False}], "alias_contributions": []}).select("alias", "normalized", "compact", "canonical_entity_id"))
query("repost_like", r"+d AS (SELECT mention_id, CASE CAST(mention_id AS BIGINT) % 5 WHEN 0 THEN 'rt ' WHEN 1 THEN 'repost ' WHEN 2 THEN 'shared from ' WHEN 3 THEN 'rtx ' ELSE '' END || raw_text AS t FROM doc_mentions) SELECT mention_id, starts_with(t, 'rt ') OR starts_with(t, 'repost ') OR starts_with(t, 'shared from ') AS repost FROM d", "doc_mentions")(
    lambda s, d: a.doc_mentions(s, d).select("mention_id", x.repost_like(F.concat(F.get(F.array(*map(F.lit, ("rt ", "repost ", "shared from ", "rtx ", ""))), (F.col("mention_id").cast("long") % 5).cast("int")), "raw_text")).alias("repost"))
)
