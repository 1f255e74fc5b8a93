"""Queries over metrics, reports and threads, each with its oracle in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters as a
from ..operators import metrics as m
from ..operators import reports as r
from ..operators import threads as t
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


def R(part: str, whole: str) -> str:
    """ratio() in SQL."""
    return f"CASE WHEN ({whole}) > 0 THEN floor((({part})::DOUBLE / ({whole})::DOUBLE) * 10000.0 + 0.5) / 10000.0 ELSE 0.0 END"


SPLIT = """halves AS (SELECT mention_id, weight, CASE WHEN posted_at IS NOT NULL THEN row_number() OVER (PARTITION BY posted_at IS NULL ORDER BY posted_at, mention_id)
    <= greatest(count(posted_at) OVER () // 2, 1) END AS earlier FROM mentions)"""
PRESENCE = """pairs AS (SELECT {key} AS k, mention_id, count(*) AS hits FROM {rows} WHERE {key} IS NOT NULL GROUP BY ALL),
    seen AS (SELECT k, count(*) AS mention_count, sum(hits)::BIGINT AS hit_count, sum(coalesce(weight, 1.0))::DOUBLE AS effective_count,
        sum(CASE WHEN earlier THEN 1 ELSE 0 END)::BIGINT AS mb, sum(CASE WHEN NOT earlier THEN 1 ELSE 0 END)::BIGINT AS ma,
        sum(CASE WHEN earlier THEN hits ELSE 0 END)::BIGINT AS hb, sum(CASE WHEN NOT earlier THEN hits ELSE 0 END)::BIGINT AS ha,
        sum(CASE WHEN earlier THEN coalesce(weight, 1.0) ELSE 0.0 END)::DOUBLE AS eb, sum(CASE WHEN NOT earlier THEN coalesce(weight, 1.0) ELSE 0.0 END)::DOUBLE AS ea
        FROM pairs LEFT JOIN halves USING (mention_id) GROUP BY k)"""
VOICE = f"""voice AS (SELECT k AS canonical_entity_id, mention_count, {R('mention_count', '(SELECT count(*) FROM mentions)')} AS mention_share,
    effective_count AS effective_mention_count, {R('effective_count', '(SELECT sum(weight) FROM mentions)')} AS effective_mention_share,
    hit_count AS entity_hit_count, {R('hit_count', 'sum(hit_count) OVER ()')} AS entity_hit_share,
    {R('mention_count', '(SELECT count(DISTINCT mention_id) FROM hits WHERE canonical_entity_id IS NOT NULL)')} AS resolved_mention_share,
    ma - mb AS delta_mention_count,
    floor(({R('ea', 'greatest(sum(ea) OVER (), 1.0)')} - {R('eb', 'greatest(sum(eb) OVER (), 1.0)')}) * 10000.0 + 0.5) / 10000.0 AS delta_mention_share,
    ha - hb AS delta_entity_hit_count,
    floor(({R('ha', 'greatest(sum(ha) OVER (), 1)')} - {R('hb', 'greatest(sum(hb) OVER (), 1)')}) * 10000.0 + 0.5) / 10000.0 AS delta_entity_hit_share FROM seen)"""
GROWTH = "CASE WHEN eb <= 0 THEN CASE WHEN ea <= 0 THEN 0.0 ELSE floor(ea * 10000.0 + 0.5) / 10000.0 END ELSE floor(((ea - eb) / eb) * 10000.0 + 0.5) / 10000.0 END"
BUZZ = f"""buzz AS (SELECT k AS {{key}}, mention_count, {R('mention_count', 'greatest((SELECT count(*) FROM mentions), 1)')} AS mention_share, effective_count AS effective_mention_count,
    {R('effective_count', 'greatest((SELECT sum(weight) FROM mentions), 1.0)')} AS effective_mention_share, ma - mb AS delta_count, {GROWTH} AS growth_ratio_proxy,
    floor(effective_count * (1.0 + greatest({GROWTH}, 0.0)) * 10000.0 + 0.5) / 10000.0 AS buzz_score_proxy FROM seen)"""
RESOLVED = "resolved AS (SELECT * FROM hits WHERE canonical_entity_id IS NOT NULL)"
TARGET = """targets AS (SELECT *, coalesce(canonical_entity_id, concept_entity_id) AS target_key,
    CASE WHEN canonical_entity_id IS NOT NULL THEN 'canonical_entity' WHEN concept_entity_id IS NOT NULL THEN 'concept' ELSE 'surface' END AS target_kind FROM hits)"""


def voice_basis(basis: str, part: str, total: str) -> str:
    return f"""+{RESOLVED} SELECT canonical_entity_id, count(DISTINCT mention_id) AS mention_count, count(*) AS entity_hit_count, {R(part, total)} AS ratio
        FROM resolved GROUP BY canonical_entity_id"""


query("sov_by_mentions", voice_basis("mentions", "count(DISTINCT mention_id)", "(SELECT count(*) FROM mentions)"), "mentions", "hits")(lambda s, d: m.share_of_voice(a.hits(s, d), a.mentions(s, d)))
query("sov_by_entity_hits", voice_basis("hits", "count(*)", "(SELECT count(*) FROM resolved)"), "hits")(lambda s, d: m.share_of_voice(a.hits(s, d), a.mentions(s, d), "hits"))
query("sov_resolved_only", voice_basis("resolved", "count(DISTINCT mention_id)", "(SELECT count(DISTINCT mention_id) FROM resolved)"), "hits")(lambda s, d: m.share_of_voice(a.hits(s, d), a.mentions(s, d), "resolved"))

SOV = f"+{SPLIT}, {PRESENCE.format(key='canonical_entity_id', rows='hits')}, {VOICE}"
query("sov_report_delta", SOV + " SELECT * FROM voice ORDER BY mention_share DESC, entity_hit_share DESC, canonical_entity_id LIMIT 10", "mentions", "hits")(lambda s, d: r.share_of_voice(a.hits(s, d), a.mentions(s, d)))
query("sov_report_weighted", SOV + " SELECT * FROM voice", "mentions", "hits")(lambda s, d: r.share_of_voice(a.hits(s, d), a.mentions(s, d), None, True))
query(
    "unresolved_summary",
    f"""SELECT unresolved_reason, count(DISTINCT mention_id) AS mention_count, any_value(u) AS unresolved, any_value({R('u', 'v')}) AS unresolved_ratio FROM hits,
    (SELECT greatest((SELECT count(*) FROM mentions) - (SELECT count(DISTINCT mention_id) FROM hits WHERE canonical_entity_id IS NOT NULL), 0) AS u, (SELECT count(*) FROM mentions) AS v)
    WHERE canonical_entity_id IS NULL AND concept_entity_id IS NULL AND unresolved_reason IS NOT NULL GROUP BY unresolved_reason""",
    "mentions", "hits",
)(lambda s, d: r.unresolved_summary(a.hits(s, d), a.mentions(s, d)))
query("buzz_entity_report", f"+{SPLIT}, {PRESENCE.format(key='canonical_entity_id', rows='hits')}, {BUZZ.format(key='canonical_entity_id')} SELECT * FROM buzz ORDER BY buzz_score_proxy DESC, effective_mention_count DESC, canonical_entity_id LIMIT 10", "mentions", "hits")(
    lambda s, d: r.buzz(a.hits(s, d), "canonical_entity_id", a.mentions(s, d))
)


def event_mentions(s, d):
    return a.facts(s, d).withColumn("weight", F.lit(1.0))


EVENTS = "mentions AS (SELECT *, 1.0::DOUBLE AS weight FROM facts)"
REPORTABLE = "topics AS (SELECT * FROM facts WHERE reporting_status = 'reportable' OR NOT EXISTS (SELECT 1 FROM facts WHERE reporting_status = 'reportable'))"
query("buzz_topic_report", f"+{EVENTS}, {REPORTABLE}, {SPLIT}, {PRESENCE.format(key='topic_key', rows='topics')}, {BUZZ.format(key='topic_key')} SELECT * FROM buzz ORDER BY buzz_score_proxy DESC, effective_mention_count DESC, topic_key LIMIT 10", "facts")(
    lambda s, d: r.topic_buzz(a.facts(s, d), event_mentions(s, d))
)
query(
    "mention_volumes",
    f"""SELECT count(*) AS mention_volume, floor(sum(weight) * 10000.0 + 0.5) / 10000.0 AS weighted_volume, {R("count_if(dedup_kind IN ('exact', 'near'))", 'count(*)')} AS duplicate_rate,
    {R("count_if(dedup_kind = 'exact')", 'count(*)')} AS exact_duplicate_rate, {R("count_if(dedup_kind = 'near')", 'count(*)')} AS near_duplicate_rate, {R('count_if(suspicious)', 'count(*)')} AS spam_suspicion_rate FROM mentions""",
    "mentions",
)(lambda s, d: m.volumes(a.mentions(s, d)))
query(
    "target_rates",
    f"""SELECT {R('count(DISTINCT CASE WHEN canonical_entity_id IS NOT NULL THEN mention_id END)', '(SELECT count(*) FROM mentions)')} AS resolved_entity_mention_rate,
    {R('count(DISTINCT CASE WHEN concept_entity_id IS NOT NULL THEN mention_id END)', '(SELECT count(*) FROM mentions)')} AS concept_target_mention_rate FROM hits""",
    "mentions", "hits",
)(lambda s, d: m.target_rates(a.hits(s, d), a.mentions(s, d)))
query(
    "low_confidence_rate",
    f"""SELECT count(DISTINCT mention_id) AS low_confidence_mentions, {R('count(DISTINCT mention_id)', '(SELECT count(*) FROM facts)')} AS reviewable_low_confidence_rate
    FROM (SELECT mention_id FROM facts WHERE confidence < 0.45 UNION ALL SELECT mention_id FROM hits WHERE confidence < 0.45)""",
    "facts", "hits",
)(lambda s, d: m.low_confidence_rate([a.facts(s, d), a.hits(s, d)], a.facts(s, d)))


def concentration_sql(rows: str, key: str) -> str:
    return f"""SELECT count(*) AS count, floor(max(n)::DOUBLE / sum(n)::DOUBLE * 10000.0 + 0.5) / 10000.0 AS top_share,
        floor(sum((n * n)::HUGEINT)::DOUBLE / (sum(n)::DOUBLE * sum(n)::DOUBLE) * 10000.0 + 0.5) / 10000.0 AS hhi_proxy FROM (SELECT {key}, count(*) AS n FROM {rows} WHERE {key} IS NOT NULL GROUP BY 1)"""


def leaders_sql(rows: str, key: str) -> str:
    return f"SELECT {key}, count(*) AS count, {R('count(*)', f'(SELECT count({key}) FROM {rows})')} AS ratio FROM {rows} WHERE {key} IS NOT NULL GROUP BY {key} ORDER BY count DESC, {key} LIMIT 5"


query("author_concentration", concentration_sql("mentions", "author_id"), "mentions")(lambda s, d: m.concentration(a.mentions(s, d), "author_id"))
query("initiator_concentration", concentration_sql("posts WHERE depth = 0 AND true", "author_id").replace("AND true WHERE", "AND"), "posts")(lambda s, d: m.concentration(a.posts(s, d).where("depth = 0"), "author_id"))
query("channel_concentration", concentration_sql("mentions", "platform"), "mentions")(lambda s, d: m.concentration(a.mentions(s, d), "platform"))
query("author_leaders", leaders_sql("mentions", "author_id"), "mentions")(lambda s, d: m.leaders(a.mentions(s, d), "author_id"))
query(
    "suspicious_author_concentration",
    f"""SELECT count_if(suspicious) AS count, {R('count_if(suspicious)', 'count(*)')} AS suspicious_author_share,
    {R('(SELECT max(n) FROM (SELECT count(*) AS n FROM mentions WHERE suspicious GROUP BY author_id))', 'count_if(suspicious)')} AS top_share FROM mentions""",
    "mentions",
)(lambda s, d: m.suspicious_authors(a.mentions(s, d)))
query("sentiment_distribution", f"SELECT sentiment, count(*) AS count, {R('count(*)', 'sum(count(*)) OVER ()')} AS ratio FROM facts GROUP BY sentiment", "facts")(lambda s, d: m.distribution(a.facts(s, d), "sentiment"))
query("language_distribution", f"SELECT language, count(*) AS count, {R('count(*)', '(SELECT count(*) FROM doc_mentions)')} AS ratio FROM doc_mentions WHERE language IS NOT NULL GROUP BY language", "doc_mentions")(
    lambda s, d: m.distribution(a.doc_mentions(s, d), "language", of_all=True)
)
query("target_sentiment_global", f"SELECT sentiment, count(*) AS count, {R('count(*)', 'sum(count(*)) OVER ()')} AS ratio FROM hits WHERE sentiment IS NOT NULL GROUP BY sentiment", "hits")(lambda s, d: m.distribution(a.hits(s, d), "sentiment"))
query(
    "target_sentiment_distribution",
    f"""+{TARGET}, c AS (SELECT target_key, target_kind, canonical_entity_id, concept_entity_id, entity_type, sentiment, count(*) AS count,
    arg_min(target_text, (mention_id, seq, target_text)) AS representative_target_text FROM targets WHERE target_key IS NOT NULL AND sentiment IS NOT NULL GROUP BY ALL)
    SELECT *, (sum(count) OVER (PARTITION BY target_key))::BIGINT AS target_total, {R('count', 'sum(count) OVER (PARTITION BY target_key)')} AS ratio FROM c""",
    "hits",
)(lambda s, d: m.target_sentiment(a.hits(s, d)))
query(
    "target_sentiment_forensic",
    f"""+c AS (SELECT target_text, canonical_entity_id, concept_entity_id, entity_type, sentiment, count(*) AS count FROM hits WHERE target_text IS NOT NULL AND sentiment IS NOT NULL GROUP BY ALL)
    SELECT *, (sum(count) OVER (PARTITION BY target_text))::BIGINT AS target_total, {R('count', 'sum(count) OVER (PARTITION BY target_text)')} AS ratio FROM c""",
    "hits",
)(lambda s, d: m.target_sentiment_forensic(a.hits(s, d)))
query("aspect_occurrences", "SELECT aspect, count(*) AS count FROM hits WHERE aspect IS NOT NULL GROUP BY aspect", "hits")(lambda s, d: m.aspect_occurrences(a.hits(s, d)))
query(
    "aspect_pair_count",
    f"""+{TARGET} SELECT aspect, target_key, canonical_entity_id, concept_entity_id, target_kind, count(*) AS count, arg_min(target_text, (mention_id, seq, target_text)) AS representative_target_text
    FROM targets WHERE aspect IS NOT NULL AND target_key IS NOT NULL GROUP BY ALL""",
    "hits",
)(lambda s, d: m.aspect_targets(a.hits(s, d)))
query("aspect_pair_count_forensic", "SELECT aspect, target_text, canonical_entity_id, count(*) AS count FROM hits WHERE aspect IS NOT NULL AND target_text IS NOT NULL GROUP BY ALL", "hits")(lambda s, d: m.aspect_targets_forensic(a.hits(s, d)))
for name, only in (("aspect_sentiment_distribution", "true"), ("aspect_sentiment_resolved_only", "canonical_entity_id IS NOT NULL")):
    query(
        name,
        f"""+c AS (SELECT aspect, sentiment, count(*) AS count FROM hits WHERE aspect IS NOT NULL AND sentiment IS NOT NULL AND {only} GROUP BY ALL)
        SELECT *, (sum(count) OVER (PARTITION BY aspect))::BIGINT AS aspect_total, {R('count', 'sum(count) OVER (PARTITION BY aspect)')} AS ratio FROM c""",
        "hits",
    )(lambda s, d, only=only: m.aspect_sentiment(a.hits(s, d), only != "true"))
query("issue_rate_by_class", f"SELECT issue_category, count(*) AS count, any_value((SELECT count(*) FROM facts)) AS mention_total, {R('count(*)', '(SELECT count(*) FROM facts)')} AS ratio FROM facts WHERE issue_category IS NOT NULL GROUP BY issue_category", "facts")(
    lambda s, d: m.issue_rates(a.facts(s, d), a.facts(s, d))
)
for name, condition, f in (
    ("issue_ratio_confirmed", "evidence_mode IN ('direct_complaint', 'direct_observation')", m.confirmed),
    ("issue_ratio_direct", "evidence_mode = 'direct_complaint'", m.direct_complaints),
    ("issue_ratio_uncertain", "evidence_mode IN ('question_or_uncertainty', 'hearsay_or_rumor')", m.uncertain),
    ("issue_ratio_severe", "severity IN ('high', 'critical_like_proxy')", m.severe),
):
    query(name, f"SELECT issue_category, count(*) AS issue_total, count_if({condition}) AS count, {R(f'count_if({condition})', 'count(*)')} AS ratio FROM facts WHERE issue_category IS NOT NULL GROUP BY issue_category", "facts")(
        lambda s, d, f=f: f(a.facts(s, d))
    )

SEVERITY = "CASE severity " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in r.SEVERITY_WEIGHT.items()) + " ELSE 1.0::DOUBLE END"
EVIDENCE = "CASE evidence_mode " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in r.EVIDENCE_WEIGHT.items()) + " ELSE 0.7::DOUBLE END"
query(
    "top_issues_pressure",
    f"""+{EVENTS}, {SPLIT}, i AS (SELECT f.*, h.earlier, floor({SEVERITY} * {EVIDENCE} * (0.35::DOUBLE + 0.65::DOUBLE * ((greatest(coalesce(nullif(confidence, 0.0), 0.0), 0.25::DOUBLE) + 0.55::DOUBLE + 0.5::DOUBLE) / 3.0::DOUBLE)) * 1e6 + 0.5)::BIGINT AS p
        FROM facts f LEFT JOIN halves h USING (mention_id) WHERE issue_category IS NOT NULL)
    SELECT issue_category, count(*) AS issue_fact_count, count(DISTINCT mention_id) AS mention_count, {R('count(DISTINCT mention_id)', 'greatest((SELECT count(*) FROM facts), 1)')} AS mention_prevalence_ratio,
    floor(sum(p)::DOUBLE / 1e6 * 10000.0 + 0.5) / 10000.0 AS issue_pressure_proxy, count(DISTINCT CASE WHEN NOT earlier THEN mention_id END) - count(DISTINCT CASE WHEN earlier THEN mention_id END) AS growth_delta_mentions
    FROM i GROUP BY issue_category ORDER BY issue_pressure_proxy DESC, mention_count DESC, issue_category LIMIT 10""",
    "facts",
)(lambda s, d: r.top_issues(a.facts(s, d), a.facts(s, d)))
for name, key in (("severity_mix", "severity"), ("evidence_mode_mix", "evidence_mode")):
    query(name, f"SELECT issue_category, {key}, {R('count(*)', 'sum(count(*)) OVER (PARTITION BY issue_category)')} AS ratio FROM facts WHERE issue_category IS NOT NULL AND {key} IS NOT NULL GROUP BY issue_category, {key}", "facts")(
        lambda s, d, key=key: r.mix(a.facts(s, d), "issue_category", key)
    )

SUMMARY = """summary AS (SELECT root_id, count(*) AS total_mentions, greatest(count(*) - 1, 0) AS total_descendants, max(depth) AS max_depth_observed,
    count_if(uap_type = 'COMMENT') AS comment_count, count_if(uap_type = 'REPLY') AS reply_count FROM posts GROUP BY root_id)"""
TOPC = """topc AS (SELECT root_id, string_agg(mention_id, '|' ORDER BY place) AS top_comment_ids FROM (SELECT root_id, mention_id, row_number() OVER (PARTITION BY root_id ORDER BY score DESC, mention_id) AS place
    FROM posts WHERE uap_type = 'COMMENT') WHERE place <= 5 GROUP BY root_id)"""
query("thread_summary", f"+{SUMMARY}, {TOPC} SELECT summary.*, coalesce(top_comment_ids, '') AS top_comment_ids FROM summary LEFT JOIN topc USING (root_id)", "posts")(lambda s, d: t.summaries(a.posts(s, d)))
query("thread_edges", "SELECT root_id, parent_id, mention_id AS child_id, depth FROM posts WHERE parent_id IS NOT NULL", "posts")(lambda s, d: t.edges(a.posts(s, d)))
query(
    "thread_children_siblings",
    """+c AS (SELECT parent_id AS p, count(*) AS n FROM posts WHERE parent_id IS NOT NULL GROUP BY 1)
    SELECT mention_id, coalesce(s.n - 1, 0) AS sibling_count, coalesce(k.n, 0) AS child_count FROM posts LEFT JOIN c s ON parent_id = s.p LEFT JOIN c k ON mention_id = k.p""",
    "posts",
)(lambda s, d: t.neighbours(a.posts(s, d)))
query(
    "thread_lineage",
    """WITH RECURSIVE chain AS ({chain}), up AS (SELECT mention_id, parent_id AS ancestor_id, 1 AS distance FROM chain WHERE parent_id IS NOT NULL
    UNION ALL SELECT up.mention_id, chain.parent_id, distance + 1 FROM up JOIN chain ON up.ancestor_id = chain.mention_id WHERE chain.parent_id IS NOT NULL) SELECT * FROM up""".replace("{chain}", a.SQL["chain"]),
)(lambda s, d: t.lineage(a.chain(s, d)))
query(
    "thread_context_text",
    """SELECT c.mention_id, CASE WHEN p.raw_text IS NOT NULL AND p.raw_text <> '' AND p.raw_text <> r.raw_text THEN
        CASE WHEN c.raw_text IN (r.raw_text, p.raw_text) THEN r.raw_text || ' | ' || p.raw_text ELSE r.raw_text || ' | ' || p.raw_text || ' | ' || c.raw_text END
        ELSE CASE WHEN c.raw_text = r.raw_text THEN r.raw_text ELSE r.raw_text || ' | ' || c.raw_text END END AS context_text
    FROM posts c JOIN posts r ON r.mention_id = c.root_id LEFT JOIN posts p ON p.mention_id = c.parent_id""",
    "posts",
)(lambda s, d: t.contexts(a.posts(s, d)))
query("thread_roots", "SELECT root_id, arg_min(mention_id, (mention_id <> root_id, depth, mention_id)) AS resolved_root_id FROM posts GROUP BY root_id", "posts")(lambda s, d: t.roots(a.posts(s, d)))
query("interaction_structure", f"+{SUMMARY} SELECT {R('sum(reply_count)', 'sum(comment_count)')} AS reply_to_comment_ratio_proxy, {R('sum(max_depth_observed)', 'sum(total_mentions)')} AS interaction_recursion_proxy FROM summary", "posts")(
    lambda s, d: m.interaction_structure(t.summaries(a.posts(s, d)))
)


def event_threads(f):
    """Thread rows made of events: depth and kinds of posts stand in by id and sentiment."""
    return f.groupBy("root_id").agg(
        F.count(F.lit(1)).alias("total_mentions"), F.max(F.col("mention_id").cast("long") % 4).cast("int").alias("max_depth_observed"), F.count_if(F.col("sentiment") == "positive").alias("comment_count"), F.count_if(F.col("sentiment") == "neutral").alias("reply_count")
    )


THREADS = """threads AS (SELECT root_id, count(*) AS total_mentions, max(CAST(mention_id AS BIGINT) % 4)::INTEGER AS max_depth_observed, count_if(sentiment = 'positive') AS comment_count,
    count_if(sentiment = 'neutral') AS reply_count, count(DISTINCT author_id) AS authors, count_if(sentiment = 'positive') AS pos, count_if(sentiment = 'negative') AS neg, count(DISTINCT issue_category) AS kinds, count(issue_category) AS issues FROM facts GROUP BY root_id)"""
DENSITY, RECURSION = R("reply_count", "greatest(comment_count, 1)"), R("max_depth_observed", "greatest(total_mentions, 1)")
AUTHORS, ISSUES = R("authors", "total_mentions"), R("kinds", "greatest(issues, 1)")
query(
    "thread_controversy",
    f"""+{THREADS}, scored AS (SELECT root_id, total_mentions, {DENSITY} AS reply_density_proxy, {RECURSION} AS recursion_proxy, least(pos, neg)::DOUBLE / greatest(pos + neg, 1)::DOUBLE AS mixed, {AUTHORS} AS author_diversity_proxy, {ISSUES} AS issue_diversity_proxy FROM threads)
    SELECT root_id, total_mentions, floor(least(0.0::DOUBLE + reply_density_proxy * 0.28::DOUBLE + recursion_proxy * 0.24::DOUBLE + mixed * 0.24::DOUBLE + author_diversity_proxy * 0.14::DOUBLE + issue_diversity_proxy * 0.1::DOUBLE, 1.0) * 10000.0 + 0.5) / 10000.0 AS controversy_score_proxy,
    reply_density_proxy, recursion_proxy, floor(mixed * 10000.0 + 0.5) / 10000.0 AS mixed_sentiment_proxy, author_diversity_proxy, issue_diversity_proxy FROM scored ORDER BY controversy_score_proxy DESC, total_mentions DESC, root_id LIMIT 10""",
    "facts",
)(lambda s, d: r.controversy(event_threads(a.facts(s, d)), a.facts(s, d), a.facts(s, d), a.facts(s, d)))
BREAK = "SELECT {k}, count(*) AS mention_count, " + R("count(*)", "greatest((SELECT count(*) FROM {rows}), 1)") + " AS conversation_share FROM {rows} GROUP BY {k} ORDER BY mention_count DESC, {k} LIMIT 10"
query("creator_breakdown", BREAK.format(k="author_id", rows="mentions"), "mentions")(lambda s, d: r.breakdown(a.mentions(s, d), "author_id"))
query("source_breakdown", BREAK.format(k="platform", rows="facts"), "facts")(lambda s, d: r.breakdown(a.facts(s, d), "platform"))
query("initiator_breakdown", BREAK.format(k="author_id", rows="(SELECT * FROM posts WHERE depth = 0)"), "posts")(lambda s, d: r.breakdown(a.posts(s, d).where("depth = 0"), "author_id"))
query(
    "source_breakdown_top3",
    "SELECT platform, place::INTEGER AS place, issue_category FROM (SELECT platform, issue_category, row_number() OVER (PARTITION BY platform ORDER BY count(*) DESC, issue_category) AS place FROM facts WHERE issue_category IS NOT NULL GROUP BY platform, issue_category) WHERE place <= 3",
    "facts",
)(lambda s, d: r.top_values(a.facts(s, d), "platform", "issue_category"))
query(
    "evidence_references",
    "SELECT issue_category, place::INTEGER AS place, mention_id FROM (SELECT issue_category, mention_id, row_number() OVER (PARTITION BY issue_category ORDER BY min(posted_at), mention_id) AS place FROM facts GROUP BY issue_category, mention_id) WHERE place <= 5",
    "facts",
)(lambda s, d: r.evidence(a.facts(s, d), "issue_category", ["posted_at"]))
query(
    "dim_time",
    "SELECT DISTINCT d AS date, year(d)::INTEGER AS year, month(d)::INTEGER AS month, week(d)::INTEGER AS week, isodow(d)::INTEGER AS weekday FROM (SELECT CAST(posted_at AS DATE) AS d FROM mentions)",
    "mentions",
)(lambda s, d: dim_time(a.mentions(s, d)))
query("dim_projects", "SELECT DISTINCT author_id, platform FROM mentions", "mentions")(lambda s, d: a.mentions(s, d).select("author_id", "platform").distinct())
query(
    "taxonomy_path",
    """WITH RECURSIVE node AS (SELECT 'r' || r_regionkey AS id, NULL AS parent, r_name AS name FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation
    UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, s_name FROM supplier), up AS (SELECT id, name AS path, parent FROM node
    UNION ALL SELECT up.id, node.name || ' > ' || up.path, node.parent FROM up JOIN node ON up.parent = node.id) SELECT id, path FROM up WHERE parent IS NULL""",
)(lambda s, d: taxonomy_paths(s, d))


def dim_time(rows):
    day = F.to_date("posted_at")
    return rows.select(day.alias("date"), F.year(day).alias("year"), F.month(day).alias("month"), F.weekofyear(day).alias("week"), (F.weekday(day) + 1).alias("weekday")).distinct()


def taxonomy_nodes(spark, folder):
    """(mention_id, parent_id, name) of a three-level tree of regions, nations and suppliers."""
    node = lambda df, tag, key, up, parent, name: df.select(
        F.concat(F.lit(tag), F.col(key).cast("string")).alias("mention_id"), (F.concat(F.lit(up), F.col(parent).cast("string")) if up else F.lit(None).cast("string")).alias("parent_id"), F.col(name).alias("name")
    )
    parts = [node(load(spark, folder, "region"), "r", "r_regionkey", "", "", "r_name"), node(load(spark, folder, "nation"), "n", "n_nationkey", "r", "n_regionkey", "n_name"), node(load(spark, folder, "supplier"), "s", "s_suppkey", "n", "s_nationkey", "s_name")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def taxonomy_paths(spark, folder):
    """(id, path): names from the root down."""
    nodes = taxonomy_nodes(spark, folder)
    up = t.lineage(nodes).unionByName(nodes.select("mention_id", F.col("mention_id").alias("ancestor_id"), F.lit(0).alias("distance")))
    named = up.join(nodes.select(F.col("mention_id").alias("ancestor_id"), "name"), "ancestor_id")
    path = F.array_join(F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("distance", "name")))), lambda x: x["name"]), " > ")
    return named.groupBy(F.col("mention_id").alias("id")).agg(path.alias("path"))


query("language_source_ratios", f"SELECT {R('count_if(user_id % 3 = 0)', 'count(*)')} AS explicit_language_ratio, {R('count_if(user_id % 3 = 1)', 'count(*)')} AS inferred_language_ratio FROM events")(
    lambda s, d: m.source_ratios(load(s, d, "events").withColumn("language_source", F.when(F.col("user_id") % 3 == 0, "explicit").when(F.col("user_id") % 3 == 1, "model")))
)
query("batch_totals", "+c AS (SELECT target_text FROM hits WHERE canonical_entity_id IS NULL GROUP BY target_text HAVING count(DISTINCT mention_id) > 1) SELECT (SELECT count(*) FROM c) AS batch_candidate_cluster_count, count(aspect) AS aspect_fact_total FROM hits", "hits")(
    lambda s, d: m.batch_totals(a.hits(s, d).where("canonical_entity_id is null").groupBy("target_text").agg(F.count_distinct("mention_id").alias("n")).where("n > 1"), a.hits(s, d))
)
query(
    "representative_texts",
    "+h AS (SELECT *, CASE WHEN seq % 2 = 0 THEN target_text END AS shown FROM hits) SELECT canonical_entity_id, sentiment, count(*) AS count, arg_min(shown, (mention_id, seq)) FILTER (shown IS NOT NULL) AS representative FROM h GROUP BY canonical_entity_id, sentiment",
    "hits",
)(lambda s, d: m.representative_text(a.hits(s, d, place=True).withColumn("shown", F.when(F.col("seq") % 2 == 0, F.col("target_text"))), ["canonical_entity_id", "sentiment"], "shown", ["mention_id", "seq", "place"]))
query("missing_columns_as_null", "SELECT event_id, event_type AS kind, NULL::VARCHAR AS missing_text, NULL::BIGINT AS missing_number FROM events")(
    lambda s, d: m.with_columns_as_null(load(s, d, "events").select("event_id", F.col("event_type").alias("kind")), {"kind": "string", "missing_text": "string", "missing_number": "long"})
)
query("window_labels", "SELECT user_id, CASE WHEN user_id % 4 = 0 THEN 'all_time' ELSE strftime(min(ts), '%Y-%m-%dT%H:%M:%S') || ' to ' || strftime(max(ts), '%Y-%m-%dT%H:%M:%S') END AS label FROM events GROUP BY user_id")(
    lambda s, d: load(s, d, "events").groupBy("user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last")).select("user_id", m.window_label(F.when(F.col("user_id") % 4 > 0, F.col("first")), F.col("last")).alias("label"))
)
query("ranked_authors", "SELECT author_id, count(*) AS mention_count, max(confidence) AS author_inorganic_score FROM facts GROUP BY author_id ORDER BY author_inorganic_score DESC, mention_count DESC, author_id LIMIT 10", "facts")(
    lambda s, d: m.ranked_authors(a.facts(s, d).groupBy("author_id").agg(F.count(F.lit(1)).alias("mention_count"), F.max("confidence").alias("author_inorganic_score")), 10)
)
query("ranked_clusters", "SELECT target_text AS text, count(DISTINCT mention_id) AS mention_count FROM hits WHERE canonical_entity_id IS NULL GROUP BY target_text ORDER BY mention_count DESC, text LIMIT 10", "hits")(
    lambda s, d: m.ranked_clusters(a.hits(s, d).where("canonical_entity_id is null").groupBy(F.col("target_text").alias("text")).agg(F.count_distinct("mention_id").alias("mention_count")), 10)
)
