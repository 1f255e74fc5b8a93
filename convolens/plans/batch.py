"""Queries over validation, linking, semantics, topics and review."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters as a
from ..functions import text as x
from ..operators import entities, ontology, review, semantics, topics, validation
from ..tables import load
from .texts import DOCS, TOKENS, docs

QUERIES = {}
ORACLE_SQL = {}


def query(name: str, oracle: str | None = None, *adapters: str):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLE_SQL[name] = a.sql(oracle, *adapters) if adapters else oracle
        return f

    return add


def event_lines(s, d):
    """Events as JSON lines."""
    rows = load(s, d, "events")
    value = F.to_json(F.struct(F.struct(F.col("event_id").cast("string").alias("uap_id"), F.col("event_type").alias("platform")).alias("identity"), F.struct(F.when(F.col("user_id") % 3 == 0, "").otherwise("note").alias("text")).alias("content")), {"ignoreNullFields": "false"})
    return rows.select(F.lit("events").alias("source_path"), F.col("event_id").alias("line_number"), value.alias("value"))


query(
    "field_profile",
    """WITH t AS (SELECT event_id, event_type, CASE WHEN user_id % 3 <> 0 THEN 'note' END AS note FROM events), f AS (SELECT 'identity.uap_id' AS field, event_id, event_id::VARCHAR AS v FROM t UNION ALL SELECT 'identity.platform', event_id, event_type FROM t UNION ALL SELECT 'content.text', event_id, note FROM t)
    SELECT field, count(v) AS present_count, count(*) - count(v) AS missing_count, array_to_string(list(v ORDER BY event_id) FILTER (v IS NOT NULL)[1:3], '|') AS example_values FROM f GROUP BY field""",
)(lambda s, d: validation.field_profile(event_lines(s, d)))
def record_lines(s, d):
    """Events as records: a third valid posts, comments and replies each in turn, the others wrong in different ways."""
    e, k = load(s, d, "events"), F.col("event_id") % 6
    key = F.col("event_id").cast("string")
    is_post, is_comment = k.isin(0, 3), k.isin(1, 4)
    parent = F.when(k.isin(1, 2, 3), F.concat(F.lit("up"), key))
    identity = F.struct(key.alias("uap_id"), F.lit("o").alias("origin_id"), F.lit("t").alias("task_id"), F.lit("p").alias("project_id"), F.when(is_post, "POST").when(is_comment, "COMMENT").otherwise("REPLY").alias("uap_type"), F.lit("tiktok").alias("platform"), F.lit("http://u").alias("url"))
    depth = F.when(k == 0, 0).when(k.isin(1, 3), 1).otherwise(2)
    hierarchy = F.struct(parent.alias("parent_id"), F.when(k == 0, key).otherwise("root").alias("root_id"), depth.alias("depth"))
    whole = F.struct(identity.alias("identity"), hierarchy.alias("hierarchy"), F.struct(F.col("user_id").cast("string").alias("id")).alias("author"), F.struct(F.col("event_type").alias("text")).alias("content"))
    bare = F.struct(F.struct(key.alias("uap_id"), F.col("event_type").alias("platform")).alias("identity"), F.struct(F.lit("note").alias("text")).alias("content"))
    value = F.when(k == 5, F.to_json(bare)).otherwise(F.to_json(whole))
    return e.select(F.lit("events").alias("source_path"), F.col("event_id").alias("line_number"), value.alias("value"))


query("validation_report", "SELECT count(*) AS total_records, count_if(event_id % 6 < 3) AS valid_records, count_if(event_id % 6 >= 3) AS invalid_records FROM events")(lambda s, d: validation.report(validation.validated(record_lines(s, d))))
query(
    "validation_errors",
    """SELECT error, count(*) AS records FROM (SELECT unnest(CASE event_id % 6 WHEN 3 THEN ['POST has a parent', 'POST must be its own root', 'POST must have depth 0'] WHEN 4 THEN ['COMMENT needs a parent', 'COMMENT must have depth 1']
    WHEN 5 THEN ['identity.origin_id is blank', 'identity.task_id is blank', 'identity.project_id is blank', 'identity.uap_type is unknown', 'identity.platform is unknown', 'author.id is missing', 'hierarchy.depth is missing or negative', 'root_id is missing'] ELSE [] END) AS error FROM events) GROUP BY error""",
)(lambda s, d: validation.error_items(validation.validated(record_lines(s, d))).groupBy("error").agg(F.count(F.lit(1)).alias("records")))
query("validation_counts", "SELECT CASE event_id % 6 WHEN 0 THEN 'POST' WHEN 1 THEN 'COMMENT' ELSE 'REPLY' END AS value, count(*) AS count FROM events WHERE event_id % 6 < 3 GROUP BY 1")(
    lambda s, d: validation.counts(validation.validated(record_lines(s, d)), "uap_type", valid_only=True)
)
query(
    "record_mentions",
    "SELECT event_id::VARCHAR AS mention_id, CASE event_id % 6 WHEN 0 THEN 'POST' WHEN 1 THEN 'COMMENT' ELSE 'REPLY' END AS uap_type, CASE WHEN event_id % 6 > 0 THEN 'up' || event_id END AS parent_id, (event_id % 6)::INTEGER AS depth, user_id::VARCHAR AS author_id, event_type AS source_text, 0 AS likes_known FROM events WHERE event_id % 6 < 3",
)(lambda s, d: validation.mentions(validation.validated(record_lines(s, d))).select("mention_id", "uap_type", "parent_id", "depth", "author_id", "source_text", F.when(F.col("likes").isNull(), 0).otherwise(1).alias("likes_known")))
query("text_lengths", "SELECT floor(avg(length(event_type)) * 100 + 0.5) / 100 AS avg, min(length(event_type))::DOUBLE AS min, max(length(event_type))::DOUBLE AS max FROM events WHERE event_id % 6 < 5")(
    lambda s, d: validation.text_lengths(validation.validated(record_lines(s, d)).where("cast(line_number as bigint) % 6 < 5"))
)
query("flatten_props", "SELECT event_id, k AS field, json_extract_string(props, k) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)")(
    lambda s, d: validation.flatten(load(s, d, "events").select(F.lit("e").alias("source_path"), F.col("event_id").alias("line_number"), F.col("props").alias("value"))).select(F.col("line_number").alias("event_id"), "field", "value")
)

BRANDS = ("There Th", "Elle", "Keit Ein", "The Of", "Ción")


#: Seed phrases of three topics, and a phrase against each.
TOPICS = ((("the of", "that", "with it"), "qui"), (("de la", "les", "des", "sur", "dans le"), "the of"), (("der die", "und"), "nicht"))


def demo_ontology() -> dict:
    """A small ontology over the invented languages of the test documents."""
    names = [{"id": f"brand.b{k}", "name": n, "entity_type": "brand", "aliases": [], "taxonomy_ids": []} for k, n in enumerate(BRANDS)]
    seeds = [
        {"id": f"topic.t{k}", "name": f"T{k}", "seed_phrases": list(p), "negative_phrases": [n], "related_entity_ids": [f"l{k}"], "related_aspect_ids": ["a1"], "related_issue_ids": ["i0"], "main_path_policy": "domain_primary" if k == 2 else "core"}
        for k, (p, n) in enumerate(TOPICS)
    ]
    out = {"domain_id": "demo", "entities": names, "topics": seeds}
    for name in ontology.LISTS:
        out.setdefault(name, [])
    return out


WORDS = r"list_filter(string_split(trim(regexp_replace(regexp_replace(lower(raw_text), '[^\p{L}\p{N}_\s\x0b]', ' ', 'g'), '[\s\x0b]+', ' ', 'g')), ' '), lambda z: z <> '')"
ALIASES = f"b AS (SELECT * FROM (VALUES {', '.join(f"('brand.b{k}', '{n.lower()}', '{n.lower().replace(' ', '')}')" for k, n in enumerate(BRANDS))}) v(canonical_entity_id, alias, compact))"
RUN = "list_transform(range(1, greatest(len(t) - {n}, 0) + 1), lambda i: array_to_string(list_slice(t, i, i + {n}), ' '))"
#: Every run of up to five words whose letters are those of an alias.
HITS = f"""{ALIASES}, t AS (SELECT mention_id, raw_text, {WORDS} AS t FROM doc_mentions), r AS (SELECT DISTINCT mention_id, unnest(list_concat(list_concat(list_concat(list_concat({RUN.format(n=0)}, {RUN.format(n=1)}), {RUN.format(n=2)}), {RUN.format(n=3)}), {RUN.format(n=4)})) AS text FROM t),
    hits AS (SELECT r.mention_id, text, canonical_entity_id, CASE WHEN text <> alias THEN 0.94::DOUBLE WHEN contains(lower(raw_text), alias) THEN 1.0::DOUBLE ELSE 0.97::DOUBLE END AS s FROM r JOIN b ON replace(text, ' ', '') = compact JOIN t USING (mention_id))"""
query("alias_scan", f"+{HITS} SELECT DISTINCT mention_id, canonical_entity_id, CASE s WHEN 1.0 THEN 'exact' WHEN 0.97 THEN 'normalized' ELSE 'compact' END AS signal FROM hits", "doc_mentions")(
    lambda s, d: entities.alias_hits(a.doc_mentions(s, d), ontology.aliases(s, demo_ontology())).select("mention_id", "canonical_entity_id", "signal").distinct()
)
query(
    "entity_facts",
    f"""+{HITS}, codes AS (SELECT DISTINCT mention_id, trim(regexp_replace(regexp_replace(lower(c), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM (SELECT mention_id, unnest(regexp_extract_all(raw_text, '{entities.CODE}', 1)) AS c FROM doc_mentions)),
    found AS (SELECT DISTINCT mention_id, text, 'alias_scan' AS method, 0.95::DOUBLE AS c FROM hits UNION ALL SELECT mention_id, text, 'product_code', 0.68::DOUBLE FROM codes WHERE length(text) > 1),
    merged AS (SELECT mention_id, text, CASE WHEN count(*) > 1 THEN greatest(max(c), least(max(c) + 0.03::DOUBLE, 0.96::DOUBLE)) ELSE max(c) END AS confidence FROM found GROUP BY ALL),
    best AS (SELECT mention_id, text, canonical_entity_id, max(s) AS s FROM hits GROUP BY ALL), placed AS (SELECT *, row_number() OVER (PARTITION BY mention_id, text ORDER BY s DESC, canonical_entity_id) AS p, lead(s) OVER (PARTITION BY mention_id, text ORDER BY s DESC, canonical_entity_id) AS second FROM best),
    res AS (SELECT m.mention_id, m.text, confidence, CASE WHEN p.s IS NOT NULL AND NOT coalesce(p.s - second < 0.05, false) THEN canonical_entity_id END AS canonical_entity_id, p.s AS s FROM merged m LEFT JOIN (SELECT * FROM placed WHERE p = 1) p USING (mention_id, text)),
    linked AS (SELECT *, row_number() OVER (PARTITION BY mention_id, canonical_entity_id ORDER BY confidence * s DESC, length(text) DESC, text) AS p FROM res WHERE canonical_entity_id IS NOT NULL),
    open_ AS (SELECT *, row_number() OVER (PARTITION BY mention_id ORDER BY confidence DESC, length(text) DESC, text) AS p FROM res WHERE canonical_entity_id IS NULL AND mention_id NOT IN (SELECT mention_id FROM linked))
    SELECT mention_id, text, confidence, canonical_entity_id, NULL::VARCHAR AS concept_entity_id, CASE WHEN canonical_entity_id IS NOT NULL THEN 'brand' END AS entity_type, CASE WHEN canonical_entity_id IS NOT NULL THEN confidence * s ELSE 0.0::DOUBLE END AS link_confidence,
    CASE WHEN canonical_entity_id IS NOT NULL THEN NULL WHEN s IS NULL THEN 'no_candidate_found' ELSE 'ambiguous_multi_candidate' END AS unresolved_reason FROM (SELECT * FROM linked WHERE p = 1 UNION ALL SELECT * FROM open_ WHERE p <= 2)""",
    "doc_mentions",
)(lambda s, d: entities.link(a.doc_mentions(s, d), ontology.aliases(s, demo_ontology())).drop("methods"))
query(
    "repeated_phrases",
    f"""+t AS (SELECT mention_id, {WORDS} AS t FROM doc_mentions), w AS (SELECT mention_id, unnest(t) AS w1, unnest(list_concat(t[2:], [NULL])) AS w2, unnest(list_concat(t[3:], [NULL, NULL])) AS w3 FROM t),
    p AS (SELECT DISTINCT mention_id, w1 || ' ' || w2 AS text FROM w WHERE w2 IS NOT NULL UNION SELECT DISTINCT mention_id, w1 || ' ' || w2 || ' ' || w3 FROM w WHERE w3 IS NOT NULL)
    SELECT text, count(*) AS mentions FROM p WHERE text NOT IN ({', '.join(repr(n.lower()) for n in BRANDS)}) GROUP BY text HAVING count(*) >= 2""",
    "doc_mentions",
)(lambda s, d: entities.repeated_phrases(a.doc_mentions(s, d), ontology.aliases(s, demo_ontology())))
CUES = semantics.Cues(
    polarity={"that": 0.7, "with": 0.6, "from": -0.8, "nicht": -0.7, "avec": 0.5}, aspects={"first": ("there", "elle"), "second": ("and",)}, issues={"product_defect": ("was",)}, aspect_issue={"first": "service_problem"},
    negation=("not", "of"), uncertainty=("is",), comparison=("than",), hearsay=("by",), escalation=("for",), first_person=("a",), contrast=("but", "et"),
)


def anchored(s, d):
    return semantics.anchors(a.doc_mentions(s, d), None, CUES)


CUE_ROWS = ", ".join(f"('{kind}', '{label}', '{cue}', {score}::DOUBLE)" for kind, label, cue, score in CUES.table())
query(
    "anchored_text",
    rf"""+q(kind, label, cue, score) AS (VALUES {CUE_ROWS}), w AS (SELECT mention_id, unnest(string_split_regex(lower(raw_text), '[^\p{{L}}\p{{N}}_]+')) AS w FROM doc_mentions)
    SELECT mention_id, kind, label, score, count(*) AS n FROM w JOIN q ON w = cue GROUP BY ALL""",
    "doc_mentions",
)(lambda s, d: anchored(s, d).where("kind <> 'segment'").groupBy("mention_id", "kind", "label", "score").agg(F.count(F.lit(1)).alias("n")))
CUT = r"regexp_replace({}, '(^|[^\p{{L}}\p{{N}}_])(?i:but|et)([^\p{{L}}\p{{N}}_]|$)', '\1' || chr(1) || '\2', 'g')"
query("mention_segments", rf"+p AS (SELECT mention_id, unnest(string_split_regex({CUT.format(CUT.format('raw_text'))}, '[,.!?;\n|*\x01]+')) AS part FROM doc_mentions) SELECT mention_id, count(*) AS segments, sum(length(trim(part, ' ,')))::BIGINT AS chars FROM p WHERE trim(part, ' ,') <> '' GROUP BY mention_id", "doc_mentions")(
    lambda s, d: anchored(s, d).where("kind = 'segment'").groupBy("mention_id").agg(F.count(F.lit(1)).alias("segments"), F.sum(F.col("stop") - F.col("start")).cast("long").alias("chars"))
)
#: Events as anchors: twelve to a mention, in three segments, of every kind.
KINDS = ("polarity", "negation", "aspect", "issue", "target", "polarity", "uncertainty", "polarity", "comparison", "polarity", "hearsay", "escalation", "first_person")
ANCHORS = f"""e AS (SELECT (event_id // 12)::VARCHAR AS mention_id, ((event_id // 4) % 3)::INTEGER AS segment, ([{', '.join(repr(k) for k in KINDS)}])[event_id % {len(KINDS)} + 1] AS kind, user_id, event_id, ((event_id * 37) % 60)::INTEGER AS start FROM events),
    anchors AS (SELECT mention_id, segment, kind, CASE kind WHEN 'aspect' THEN 'aspect' || user_id % 3 WHEN 'issue' THEN CASE user_id % 3 WHEN 0 THEN 'safety_concern' ELSE 'other_issue' END WHEN 'target' THEN 'target' || user_id % 2 ELSE kind END AS label,
        CASE WHEN kind = 'polarity' THEN ((event_id * 7919) % 21 - 10)::DOUBLE / 10.0::DOUBLE ELSE 0.0::DOUBLE END AS score, start, start + 4 AS stop FROM e
        UNION ALL SELECT mention_id, segment, 'segment', CASE min(event_id) % 4 WHEN 0 THEN 'contrast' WHEN 1 THEN 'question' WHEN 2 THEN 'contrast question' ELSE '' END, 0.0::DOUBLE, 0, 80 FROM e GROUP BY ALL),
    signed AS (SELECT p.mention_id, p.segment, p.label, p.score, p.start, p.stop, count(n.start) > 0 AS negated FROM anchors p LEFT JOIN anchors n ON n.kind = 'negation' AND n.mention_id = p.mention_id AND n.segment = p.segment AND p.start - n.start BETWEEN 0 AND 14
        WHERE p.kind = 'polarity' GROUP BY ALL), cues AS (SELECT mention_id, segment, start, stop, CASE WHEN negated THEN -score ELSE score END AS score, negated FROM signed),
    flags AS (SELECT mention_id, segment, bool_or(kind = 'segment' AND contains(label, 'contrast')) AS contrast, bool_or((kind = 'segment' AND contains(label, 'question')) OR kind = 'uncertainty') AS uncertain, bool_or(kind = 'hearsay') AS hearsay,
        bool_or(kind = 'comparison') AS comparison, bool_or(kind = 'escalation') AS escalation, bool_or(kind = 'first_person') AS first_person FROM anchors GROUP BY ALL),
    sums AS (SELECT mention_id, segment, sum(score::DECIMAL(10, 4))::DOUBLE AS score, count(*) AS cues, bool_or(negated) AS negated FROM cues GROUP BY ALL),
    segs AS (SELECT f.*, coalesce(score, 0.0::DOUBLE) AS score, coalesce(cues, 0) AS cues, coalesce(negated, false) AS negated FROM flags f LEFT JOIN sums USING (mention_id, segment))"""


def anchor_rows(s, d):
    e = load(s, d, "events")
    i, u = F.col("event_id"), F.col("user_id")
    kind = F.get(F.array(*map(F.lit, KINDS)), (i % len(KINDS)).cast("int"))
    rows = e.select(F.floor(i / 12).cast("string").alias("mention_id"), (F.floor(i / 4) % 3).cast("int").alias("segment"), kind.alias("kind"), u.alias("u"), i.alias("i"), ((i * 37) % 60).cast("int").alias("start"))
    label = F.when(F.col("kind") == "aspect", F.concat(F.lit("aspect"), (F.col("u") % 3).cast("string"))).when(F.col("kind") == "issue", F.when(F.col("u") % 3 == 0, "safety_concern").otherwise("other_issue"))
    label = label.when(F.col("kind") == "target", F.concat(F.lit("target"), (F.col("u") % 2).cast("string"))).otherwise(F.col("kind"))
    score = F.when(F.col("kind") == "polarity", ((F.col("i") * 7919) % 21 - 10).cast("double") / 10.0).otherwise(0.0)
    own = rows.select("mention_id", "segment", "kind", label.alias("label"), score.alias("score"), "start", (F.col("start") + 4).alias("stop"))
    first = F.min("i") % 4
    whole = rows.groupBy("mention_id", "segment").agg(F.when(first == 0, "contrast").when(first == 1, "question").when(first == 2, "contrast question").otherwise("").alias("label"))
    return own.unionByName(whole.select("mention_id", "segment", F.lit("segment").alias("kind"), "label", F.lit(0.0).alias("score"), F.lit(0).alias("start"), F.lit(80).alias("stop")))


MOOD = "CASE WHEN {0} >= 0.35 THEN 'positive' WHEN {0} <= -0.35 THEN 'negative' WHEN abs({0}) < 0.15 THEN 'neutral' ELSE 'mixed' END"
MERGED = "CASE WHEN (list_contains({0}, 'positive') AND list_contains({0}, 'negative')) OR list_contains({0}, 'mixed') THEN 'mixed' WHEN list_contains({0}, 'positive') THEN 'positive' WHEN list_contains({0}, 'negative') THEN 'negative' ELSE 'neutral' END"


def thousandths(sql: str) -> str:
    return f"floor(({sql}) * 1000.0 + 0.5) / 1000.0"


def clamp_sql(base: float, *parts: tuple[str, str]) -> str:
    total = f"{base}::DOUBLE" + "".join(f" + CASE WHEN {c} THEN {v} ELSE 0.0::DOUBLE END" for c, v in parts)
    return thousandths(f"greatest(0.05::DOUBLE, least(0.99::DOUBLE, {total}))")


def sentiment_sql(base: float, explicit: str, inherited: str, support: str, mood: str, contrast: str, negated: str, unsure: str) -> str:
    return clamp_sql(
        base, (explicit, "0.12::DOUBLE"), (inherited, "-0.12::DOUBLE"), (f"{support} > 1", f"least(0.04::DOUBLE * ({support} - 1), 0.14::DOUBLE)"), (f"{mood} = 'mixed'", "-0.1::DOUBLE"), (contrast, "-0.04::DOUBLE"), (negated, "-0.03::DOUBLE"), (unsure, "-0.1::DOUBLE")
    )


def near_sql(kind: str) -> str:
    gap = "least(abs(c.start - t.start), abs(c.stop - t.stop))"
    return f"""SELECT t.mention_id, t.segment, t.label, t.start, sum((c.score * greatest(0.35::DOUBLE, 1.0::DOUBLE - {gap} / 48.0::DOUBLE))::DECIMAL(20, 8))::DOUBLE AS score, count(*) AS support, bool_or(c.negated) AS negated
        FROM (SELECT * FROM anchors WHERE kind = '{kind}') t JOIN cues c USING (mention_id, segment) WHERE {gap} <= 48 GROUP BY ALL"""


def first_sql(rows: str) -> str:
    return f"SELECT * FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY mention_id, segment, label ORDER BY start) = 1"


query("segment_polarity", f"WITH {ANCHORS} SELECT * FROM segs")(lambda s, d: semantics.segments(anchor_rows(s, d)))
query(
    "mention_sentiment",
    f"""WITH {ANCHORS}, l AS (SELECT *, {MOOD.format('score')} AS l, uncertain OR hearsay OR comparison OR contrast AS u FROM segs WHERE cues > 0),
    g AS (SELECT mention_id, list(l) AS ls, sum(score::DECIMAL(10, 4))::DOUBLE AS t, sum(cues)::BIGINT AS n, bool_or(contrast) AS c, bool_or(negated) AS neg, bool_or(u) AS u FROM l GROUP BY mention_id), m AS (SELECT *, {MERGED.format('ls')} AS sentiment FROM g)
    SELECT mention_id, sentiment, {thousandths('abs(t)')} AS score, {sentiment_sql(0.5, 'false', 'false', 'n', 'sentiment', 'c', 'neg', 'u')} AS confidence FROM m""",
)(lambda s, d: semantics.mention_sentiment(semantics.segments(anchor_rows(s, d))))
query(
    "aspect_opinions",
    f"""WITH {ANCHORS}, n AS ({first_sql(near_sql('aspect'))}), j AS (SELECT n.*, contrast, uncertain, {MOOD.format('n.score')} AS sentiment FROM n JOIN segs USING (mention_id, segment) WHERE abs(n.score) >= 0.18)
    SELECT mention_id, segment, label AS aspect, score, sentiment, {sentiment_sql(0.48, 'false', 'false', 'support', 'sentiment', 'contrast', 'negated', 'uncertain')} AS confidence FROM j""",
)(lambda s, d: (lambda r: semantics.aspects(r, semantics.segments(r)))(anchor_rows(s, d)))
MODE = "CASE WHEN escalation THEN 'escalation_signal' WHEN hearsay THEN 'hearsay_or_rumor' WHEN uncertain THEN 'question_or_uncertainty' WHEN comparison AND score < 0 THEN 'comparison_based_critique' WHEN score < 0 AND first_person THEN 'direct_complaint' ELSE 'direct_observation' END"
HOW_BAD = """CASE WHEN issue_category = 'safety_concern' AND evidence_mode IN ('escalation_signal', 'direct_complaint') THEN 'critical_like_proxy' WHEN evidence_mode = 'escalation_signal' OR abs(score) >= 1.05 THEN 'high'
    WHEN evidence_mode IN ('question_or_uncertainty', 'hearsay_or_rumor') THEN 'low' WHEN abs(score) >= 0.55 THEN 'medium' ELSE 'low' END"""
FOLLOWS = semantics.Cues(aspect_issue={"aspect0": "other_issue", "aspect1": "pricing_value_concern"})
ISSUES = f"""named AS (SELECT mention_id, segment, label AS issue_category, coalesce(score, 0.0::DOUBLE) AS score FROM ({first_sql(f"SELECT a.mention_id, a.segment, a.label, a.start, n.score FROM anchors a LEFT JOIN ({near_sql('issue')}) n USING (mention_id, segment, label, start) WHERE a.kind = 'issue'")})),
    derived AS (SELECT mention_id, segment, CASE label WHEN 'aspect0' THEN 'other_issue' WHEN 'aspect1' THEN 'pricing_value_concern' END AS issue_category, score FROM ({first_sql(near_sql('aspect'))}) WHERE score < -0.2),
    both_ AS (SELECT * FROM named UNION ALL SELECT * FROM derived d WHERE issue_category IS NOT NULL AND NOT EXISTS (SELECT 1 FROM named n WHERE n.mention_id = d.mention_id AND n.segment = d.segment AND n.issue_category = d.issue_category)),
    one AS (SELECT mention_id, segment, issue_category, min(score) AS score FROM both_ GROUP BY ALL), moded AS (SELECT o.*, hearsay, uncertain, {MODE.replace('score', 'o.score')} AS evidence_mode FROM one o JOIN segs USING (mention_id, segment)),
    issues AS (SELECT mention_id, segment, issue_category, score, evidence_mode, {HOW_BAD} AS severity, uncertain OR hearsay AS unsure FROM moded)"""
query("issue_signals", f"WITH {ANCHORS}, {ISSUES} SELECT * FROM issues")(lambda s, d: (lambda r: semantics.issues(r, semantics.segments(r), FOLLOWS))(anchor_rows(s, d)))
THREADS = "SELECT DISTINCT mention_id, 'r' || CAST(mention_id AS BIGINT) % 20 AS root_id, 't' || CAST(mention_id AS BIGINT) % 3 AS normalized_text FROM e"


def threaded(s, d):
    k = F.col("mention_id").cast("long")
    return anchor_rows(s, d).select("mention_id").distinct().select("mention_id", F.concat(F.lit("r"), (k % 20).cast("string")).alias("root_id"), F.concat(F.lit("t"), (k % 3).cast("string")).alias("normalized_text"))


query(
    "issue_corroboration",
    f"""WITH {ANCHORS}, {ISSUES}, t AS ({THREADS}), c AS (SELECT *, count(*) OVER (PARTITION BY root_id, issue_category, normalized_text) AS n FROM issues JOIN t USING (mention_id))
    SELECT mention_id, segment, issue_category, score, evidence_mode, unsure, root_id, n AS corroboration_count, CASE WHEN n >= 3 AND NOT unsure THEN CASE severity WHEN 'low' THEN 'medium' WHEN 'medium' THEN 'high' ELSE severity END ELSE severity END AS severity,
    {clamp_sql(0.44, ('unsure', '-0.22::DOUBLE'), ('n > 1 AND NOT unsure', 'least(0.05::DOUBLE * (n - 1), 0.16::DOUBLE)'), ("evidence_mode = 'escalation_signal'", '0.08::DOUBLE'), ("evidence_mode IN ('direct_complaint', 'direct_observation')", '0.06::DOUBLE'))} AS confidence FROM c""",
)(lambda s, d: (lambda r: semantics.corroborate(semantics.issues(r, semantics.segments(r), FOLLOWS), threaded(s, d)))(anchor_rows(s, d)))
TARGETS = "t AS (SELECT DISTINCT mention_id, label AS target_key FROM anchors WHERE kind = 'target'), mentions AS (SELECT DISTINCT mention_id FROM e)"
query(
    "inherited_targets",
    f"""WITH {ANCHORS}, {TARGETS}, one AS (SELECT mention_id AS ancestor_id, min(target_key) AS target_key FROM t GROUP BY mention_id HAVING count(*) = 1),
    up AS (SELECT m.mention_id, (CAST(m.mention_id AS BIGINT) - k)::VARCHAR AS ancestor_id, k AS distance FROM mentions m, range(1, 4) r(k) WHERE CAST(m.mention_id AS BIGINT) % 4 >= k) SELECT mention_id, arg_min(target_key, distance) AS target_key FROM up JOIN one USING (ancestor_id) GROUP BY mention_id""",
)(lambda s, d: semantics.inherited_targets(anchor_targets(s, d), uplinks(s, d)))


def anchor_targets(s, d):
    return anchor_rows(s, d).where("kind = 'target'").select("mention_id", F.col("label").alias("target_key")).distinct()


def uplinks(s, d):
    k = F.col("mention_id").cast("long")
    return anchor_rows(s, d).select("mention_id").distinct().select("mention_id", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("distance")).where(k % 4 >= F.col("distance")).select("mention_id", (k - F.col("distance")).cast("string").alias("ancestor_id"), "distance")


INHERITED = "i AS (" + ORACLE_SQL["inherited_targets"].split(", one AS", 1)[1].join(("WITH one AS", "")) + ")"
TARGETED = f"""own AS (SELECT mention_id, segment, label, score, support, negated, false AS inherited FROM ({first_sql(near_sql('target'))})),
    taken AS (SELECT mention_id, segment, target_key AS label, score * 0.75::DOUBLE AS score, cues AS support, negated, true AS inherited FROM i JOIN segs USING (mention_id) WHERE cues > 0 AND mention_id NOT IN (SELECT mention_id FROM t)),
    rows_ AS (SELECT r.*, contrast, uncertain OR hearsay OR comparison OR contrast AS unsure, {MOOD.format('r.score')} AS l FROM (SELECT * FROM own UNION ALL SELECT * FROM taken) r JOIN segs USING (mention_id, segment)),
    sure AS (SELECT *, {sentiment_sql(0.48, 'NOT inherited', 'inherited', 'support', 'l', 'contrast', 'negated', 'unsure')} AS confidence FROM rows_)"""
query(
    "target_sentiment",
    f"""WITH {ANCHORS}, {TARGETS}, {INHERITED}, {TARGETED} SELECT mention_id, label AS target_key, {MERGED.format('list(l)')} AS sentiment, {thousandths('max(abs(score))')} AS score, {thousandths('avg(confidence)')} AS confidence, bool_or(inherited) AS inherited FROM sure GROUP BY mention_id, label""",
)(lambda s, d: (lambda r: semantics.target_sentiment(r, semantics.segments(r), semantics.inherited_targets(anchor_targets(s, d), uplinks(s, d))))(anchor_rows(s, d)))


def tagged(s, d):
    k = F.col("mention_id").cast("long")
    one = lambda c, v: F.when(c, F.array(v)).otherwise(F.array().cast("array<string>"))
    return docs(s, d).withColumns({"entities": one(k % 4 == 0, F.concat(F.lit("l"), (k % 3).cast("string"))), "aspects": one(k % 5 == 0, F.lit("a1")), "issues": one(k % 3 == 0, F.lit("i0"))})


def likeness(s, d):
    k = F.col("mention_id").cast("long")
    return docs(s, d).select("mention_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("t")).select("mention_id", F.concat(F.lit("topic.t"), F.col("t").cast("string")).alias("topic_key"), (((k + F.col("t")) % 5) / 10.0).alias("semantic"))


SEEDS = ", ".join(f"('topic.t{k}', {k}, [{', '.join(repr(x_) for x_ in p)}], '{n}')" for k, (p, n) in enumerate(TOPICS))
SCORED = f"""{DOCS}, p(topic_key, k, phrases, negative) AS (VALUES {SEEDS}), j AS (SELECT mention_id, topic_key, k, text, phrases, negative, CAST(mention_id AS BIGINT) AS m, ((CAST(mention_id AS BIGINT) + k) % 5)::DOUBLE / 10.0::DOUBLE AS semantic,
    list_sum(list_transform(phrases, lambda z: CASE WHEN contains(text, z) THEN CASE WHEN contains(z, ' ') THEN 1.0::DOUBLE ELSE 0.65::DOUBLE END ELSE 0.0::DOUBLE END)) AS hits FROM docs, p WHERE text <> ''),
    l AS (SELECT *, CASE WHEN hits > 0 THEN least(hits / greatest(least(len(phrases), 4) * 0.65::DOUBLE, 1.0::DOUBLE) + 0.18::DOUBLE, 1.0::DOUBLE) ELSE 0.0::DOUBLE END AS lexical, m % 4 = 0 AND m % 3 = k AS e, m % 5 = 0 AS a, m % 3 = 0 AS i FROM j),
    s AS (SELECT mention_id, topic_key, lexical * 0.54::DOUBLE + semantic * 0.2::DOUBLE + (CASE WHEN e THEN 0.12::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN a THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN i THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END)
        + CASE WHEN k = 2 AND (lexical >= 0.2 OR e OR a OR i) THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END - CASE WHEN contains(text, negative) THEN 0.18::DOUBLE ELSE 0.0::DOUBLE END - CASE WHEN i AND NOT a AND NOT e AND lexical < 0.42 THEN 0.14::DOUBLE ELSE 0.0::DOUBLE END
        + CASE WHEN lexical > 0 AND semantic > 0 THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN lexical >= 0.45 THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END AS raw FROM l WHERE lexical > 0 OR m % 4 = 0 OR a OR i),
    r AS (SELECT mention_id, topic_key, floor(least(raw, 0.98::DOUBLE) * 10000.0 + 0.5) / 10000.0 AS score FROM s)"""
query("topic_scores", f"+{SCORED} SELECT * FROM r WHERE score >= 0.32", "doc_mentions")(lambda s, d: topics.assignments(tagged(s, d), topics.prototypes(s, demo_ontology()), likeness(s, d)))
query("topic_assignment_best", f"+{SCORED} SELECT mention_id, topic_key, score FROM r WHERE score >= 0.32 QUALIFY row_number() OVER (PARTITION BY mention_id ORDER BY score DESC, topic_key) = 1", "doc_mentions")(
    lambda s, d: topics.best(topics.assignments(tagged(s, d), topics.prototypes(s, demo_ontology()), likeness(s, d)))
)


def snapshots(s, d):
    """Topics by language and by source, as two snapshots."""
    base = docs(s, d)
    out = []
    for column in ("language", "author_id"):
        assigned = base.select("mention_id", F.col(column).alias("topic_key"), F.lit(0.5).alias("score"))
        terms = topics.top_terms(assigned, base)
        out.append(topics.artifacts(assigned, terms, base.withColumn("posted_at", F.lit(None).cast("timestamp"))))
    return out


TERMS = """terms AS (SELECT {k} AS topic_key, list(term ORDER BY n DESC, term) AS terms, any_value(size) AS topic_size FROM (SELECT {k}, term, count(*) AS n, any_value(size) AS size, row_number() OVER (PARTITION BY {k} ORDER BY count(*) DESC, term) AS place
    FROM (SELECT {k}, mention_id, unnest(list_distinct({t})) AS term, count(DISTINCT mention_id) OVER (PARTITION BY {k}) AS size FROM docs) WHERE length(term) > 2 GROUP BY {k}, term) WHERE place <= 8 GROUP BY {k})"""
query(
    "topic_artifacts",
    f"""+{DOCS}, {TERMS.format(k='language', t=TOKENS).replace('terms AS (', 'now AS (', 1)}, e AS (SELECT topic_key, unnest(terms) AS term FROM now), shared AS (SELECT term, count(*)::DOUBLE AS n FROM e GROUP BY term),
    own AS (SELECT topic_key, avg(1.0::DOUBLE / n) AS distinctness FROM e JOIN shared USING (term) GROUP BY topic_key), size AS (SELECT language AS topic_key, count(DISTINCT mention_id) AS topic_size, count(DISTINCT author_id) AS authors FROM docs GROUP BY language)
    SELECT topic_key, topic_size, authors, floor((0.4::DOUBLE * least(topic_size / 10.0::DOUBLE, 1.0::DOUBLE) + 0.3::DOUBLE * distinctness + 0.3::DOUBLE * (authors::DOUBLE / topic_size::DOUBLE)) * 10000.0 + 0.5) / 10000.0 AS quality_score,
    CASE WHEN topic_size < 3 THEN 'weak' WHEN distinctness < 0.25 THEN 'noisy' ELSE 'reportable' END AS reporting_status, left(sha256(array_to_string(list_sort(terms), '|')), 16) AS signature FROM size JOIN now USING (topic_key) JOIN own USING (topic_key)""".replace("any_value(size) AS topic_size", "any_value(size) AS size_"),
    "doc_mentions",
)(lambda s, d: snapshots(s, d)[0].select("topic_key", "topic_size", "authors", "quality_score", "reporting_status", "signature"))
query(
    "topic_stability_best_match",
    f"""+{DOCS}, {TERMS.format(k='language', t=TOKENS).replace('terms AS (', 'now AS (', 1)}, {TERMS.format(k='author_id', t=TOKENS).replace('terms AS (', 'was AS (', 1)},
    pairs AS (SELECT n.topic_key, w.topic_key AS previous_key, floor(len(list_intersect(n.terms, w.terms))::DOUBLE / len(list_distinct(list_concat(n.terms, w.terms)))::DOUBLE * 10000.0 + 0.5) / 10000.0 AS stability_score FROM now n, was w WHERE len(list_intersect(n.terms, w.terms)) > 0)
    SELECT topic_key, previous_key, coalesce(stability_score, 0.0) AS stability_score FROM now LEFT JOIN (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY topic_key ORDER BY stability_score DESC, previous_key) = 1) USING (topic_key)""",
    "doc_mentions",
)(lambda s, d: topics.stability(*snapshots(s, d)).select("topic_key", "previous_key", "stability_score"))


def review_items(s, d):
    hits, facts = a.hits(s, d), a.facts(s, d)
    labels = facts.select("mention_id", F.lit("intent").alias("kind"), F.col("evidence_mode").alias("text"), F.col("issue_category").alias("label"), "confidence")
    return review.queue(hits, labels)


QUEUE = """q AS (SELECT mention_id, 'entity' AS kind, target_text AS text, canonical_entity_id AS label, confidence, unresolved_reason AS reason FROM hits
    WHERE (canonical_entity_id IS NULL OR confidence < 0.65) AND coalesce(unresolved_reason, '') NOT IN ('noise_term', 'bad_weak_span')
    UNION ALL SELECT mention_id, 'intent', evidence_mode, issue_category, confidence, NULL FROM facts WHERE confidence < 0.55)"""
query("review_queue", f"+{QUEUE} SELECT kind, reason, count(*) AS items FROM q GROUP BY ALL", "hits", "facts")(lambda s, d: review_items(s, d).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("items")))
query(
    "review_queue_grouping",
    f"""+{QUEUE}, g AS (SELECT *, CASE WHEN kind <> 'entity' THEN 'low_confidence_label' WHEN reason IN ('ambiguous_alias', 'ambiguous_multi_candidate') THEN 'ambiguous_alias' WHEN label IS NULL THEN 'unresolved_entity' ELSE 'low_confidence_entity' END AS problem_class,
    trim(regexp_replace(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS normalized_text FROM q)
    SELECT problem_class, normalized_text, count(*) AS occurrences, count(DISTINCT mention_id) AS mentions, min(confidence) AS lowest_confidence FROM g GROUP BY problem_class, normalized_text, kind, coalesce(label, '')""",
    "hits", "facts",
)(lambda s, d: review.groups(review_items(s, d)).drop("signature"))


def decisions(s, d):
    e = load(s, d, "events")
    return e.select(
        F.col("event_id").cast("string").alias("decision_id"), F.col("event_type").alias("signature"), F.lit("project").alias("scope_level"), F.col("user_id").cast("string").alias("scope_id"),
        F.when(F.col("event_id") % 7 == 0, "terminate").otherwise("accept").alias("action"), F.col("ts").alias("created_at"), F.when(F.col("event_id") % 11 == 0, (F.col("event_id") - 11).cast("string")).alias("supersedes"),
    )


query(
    "review_latest_authority",
    """WITH d AS (SELECT CAST(event_id AS VARCHAR) AS decision_id, event_type AS signature, CAST(user_id AS VARCHAR) AS scope_id, CASE WHEN event_id % 7 = 0 THEN 'terminate' ELSE 'accept' END AS action, ts AS created_at,
        CASE WHEN event_id % 11 = 0 THEN CAST(event_id - 11 AS VARCHAR) END AS supersedes FROM events),
    alive AS (SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM d n WHERE n.supersedes = d.decision_id AND (n.created_at, n.decision_id) > (d.created_at, d.decision_id)))
    SELECT signature, scope_id, decision_id FROM (SELECT *, row_number() OVER (PARTITION BY signature, scope_id ORDER BY created_at DESC, decision_id DESC) AS place FROM alive) WHERE place = 1 AND action <> 'terminate'""",
)(lambda s, d: review.in_force(decisions(s, d)).select("signature", "scope_id", "decision_id"))
EMOJI = "[" + "".join(f"{chr(lo)}-{chr(hi)}" for lo, hi in ((0x1F300, 0x1F5FF), (0x1F600, 0x1F64F), (0x1F680, 0x1F6FF), (0x1F700, 0x1F77F), (0x1F900, 0x1F9FF), (0x1FA70, 0x1FAFF))) + "]+"
query("hashtags", rf"SELECT mention_id, len(list_distinct(list_transform(regexp_extract_all(raw_text, '#([\p{{L}}\p{{N}}_-]+)', 1), lambda z: lower(z))))::INTEGER AS tags, len(regexp_extract_all(raw_text, '{EMOJI}'))::INTEGER AS emoji_runs FROM doc_mentions", "doc_mentions")(lambda s, d: a.doc_mentions(s, d).select("mention_id", F.size(x.hashtags(F.col("raw_text"))).alias("tags"), F.size(x.emojis(F.col("raw_text"))).alias("emoji_runs")))


#: Hits with what makes a link sure, made of their numbers.
FACTS = """f AS (SELECT mention_id, target_text AS text, CASE WHEN seq % 5 = 0 THEN NULL ELSE canonical_entity_id END AS canonical_entity_id, CASE WHEN seq % 5 = 0 OR canonical_entity_id IS NULL THEN 'concept:' || entity_type END AS concept_entity_id,
    ['product', 'brand', 'concept', 'location', 'facility'][seq % 5 + 1] AS entity_type, 0.6::DOUBLE + confidence / 2.5::DOUBLE AS confidence, ['exact_alias', 'contextual_support', 'fuzzy_support'][seq % 3 + 1] AS matched_by,
    CASE seq % 4 WHEN 0 THEN ['alias_scan'] WHEN 1 THEN ['context_span'] WHEN 2 THEN ['title_span', 'ner'] ELSE [] END AS methods, (seq % 6) / 10.0::DOUBLE AS specificity, CASE WHEN seq % 2 = 0 THEN 'domain' ELSE 'base' END AS layer, seq % 7 <> 6 AS eligible FROM hits)"""


def linked_facts(s, d):
    h, q = a.hits(s, d), F.col("seq")
    choose = lambda values, n: F.get(F.array(*map(F.lit, values)), (q % n).cast("int"))
    text = lambda *v: F.array(*map(F.lit, v)).cast("array<string>")
    concept = F.when((q % 5 == 0) | F.col("canonical_entity_id").isNull(), F.concat(F.lit("concept:"), "entity_type"))
    return h.select(
        "mention_id", F.col("target_text").alias("text"), F.when(q % 5 != 0, F.col("canonical_entity_id")).alias("canonical_entity_id"), concept.alias("concept_entity_id"), choose(("product", "brand", "concept", "location", "facility"), 5).alias("entity_type"),
        (F.lit(0.6) + F.col("confidence") / 2.5).alias("confidence"), choose(("exact_alias", "contextual_support", "fuzzy_support"), 3).alias("matched_by"),
        F.when(q % 4 == 0, text("alias_scan")).when(q % 4 == 1, text("context_span")).when(q % 4 == 2, text("title_span", "ner")).otherwise(text()).alias("methods"), ((q % 6) / 10.0).alias("specificity"),
        F.when(q % 2 == 0, "domain").otherwise("base").alias("knowledge_layer"), (q % 7 != 6).alias("target_eligible"),
    )


def any_in(values) -> str:
    return f"len(list_intersect(methods, [{', '.join(repr(v) for v in values)}])) > 0"


TARGET_ROWS = f"""k AS (SELECT mention_id, coalesce(canonical_entity_id, concept_entity_id) AS target_key, text, CASE WHEN canonical_entity_id IS NOT NULL THEN 'canonical_entity' ELSE 'concept' END AS target_kind, entity_type,
    CASE WHEN canonical_entity_id IS NOT NULL THEN floor(greatest(0.84::DOUBLE, least(confidence, 0.96::DOUBLE)) * 1000.0 + 0.5) / 1000.0 ELSE 0.74::DOUBLE END AS grounding FROM f
    WHERE eligible AND entity_type <> 'facility' AND (len(methods) = 0 OR (len(list_filter(methods, lambda z: z <> 'context_span')) > 0 AND (concept_entity_id IS NULL OR {any_in(semantics.CONCEPT_FINDS)})))
    AND CASE WHEN canonical_entity_id IS NOT NULL THEN confidence >= 0.78 OR (matched_by = 'exact_alias' AND confidence >= 0.72) OR (specificity >= 0.2 AND confidence >= 0.68)
        OR (matched_by = 'contextual_support' AND entity_type IN ('brand', 'organization', 'retailer', 'location', 'facility', 'person') AND confidence >= 0.74 AND layer = 'domain' AND {any_in(semantics.CONTEXT_FINDS)})
        ELSE confidence >= 0.88 AND specificity >= 0.34 END),
    one AS (SELECT mention_id, target_key, target_kind, min(text) AS target_text, arg_min(entity_type, (text, entity_type, grounding)) AS entity_type, arg_min(grounding, (text, entity_type, grounding)) AS grounding FROM k GROUP BY ALL),
    targets AS (SELECT * FROM one WHERE target_kind = 'canonical_entity' OR mention_id NOT IN (SELECT mention_id FROM one WHERE target_kind = 'canonical_entity'))"""
query("eligible_targets", f"+{FACTS}, {TARGET_ROWS} SELECT mention_id, target_key, target_kind, target_text FROM targets", "hits")(lambda s, d: semantics.eligible_targets(linked_facts(s, d)).select("mention_id", "target_key", "target_kind", "target_text"))
RANK = "CASE entity_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in semantics.SPECIFICITY.items()) + " ELSE 0 END"
query(
    "preferred_targets",
    f"+{FACTS}, r AS (SELECT DISTINCT mention_id, canonical_entity_id AS target_key, entity_type, {RANK} AS rank FROM f WHERE canonical_entity_id IS NOT NULL), t AS (SELECT *, max(rank) OVER (PARTITION BY mention_id) AS top FROM r) SELECT mention_id, min(target_key) AS target_key FROM t WHERE rank = top GROUP BY mention_id HAVING count(*) = 1",
    "hits",
)(lambda s, d: semantics.preferred_targets(linked_facts(s, d).where("canonical_entity_id is not null").select("mention_id", F.col("canonical_entity_id").alias("target_key"), "entity_type").distinct().withColumn("target_text", F.col("target_key"))))
query(
    "aspect_corroboration",
    """+o AS (SELECT mention_id, aspect, canonical_entity_id AS target_key, sentiment, 0.5::DOUBLE + confidence / 4.0::DOUBLE AS confidence, 'r' || CAST(mention_id AS BIGINT) % 50 AS root_id, 't' || CAST(mention_id AS BIGINT) % 2 AS t FROM hits WHERE aspect IS NOT NULL),
    c AS (SELECT *, count(*) OVER (PARTITION BY root_id, aspect, target_key, sentiment, t) AS n FROM o) SELECT mention_id, aspect, target_key, sentiment, root_id, n AS corroboration_count, floor(least(confidence + (n - 1) * 0.03::DOUBLE, 0.97::DOUBLE) * 1000.0 + 0.5) / 1000.0 AS confidence FROM c""",
    "hits",
)(lambda s, d: semantics.corroborate_aspects(
    a.hits(s, d).where("aspect is not null").select("mention_id", "aspect", F.col("canonical_entity_id").alias("target_key"), "sentiment", (F.lit(0.5) + F.col("confidence") / 4.0).alias("confidence")),
    a.mentions(s, d).select("mention_id", F.concat(F.lit("r"), (F.col("mention_id").cast("long") % 50).cast("string")).alias("root_id"), F.concat(F.lit("t"), (F.col("mention_id").cast("long") % 2).cast("string")).alias("normalized_text")),
))
query(
    "feedback_override",
    """+v AS (SELECT 'k' || o_custkey % 3 AS kind, 't' || o_custkey % 20 AS normalized_text, o_orderpriority AS label, count(*) AS votes FROM orders GROUP BY ALL), b AS (SELECT kind, normalized_text, max_by(label, (votes, label)) AS told FROM v WHERE votes >= 3 GROUP BY ALL)
    SELECT mention_id, coalesce(told, issue_category) AS label, CASE WHEN told IS NULL THEN confidence ELSE 1.0::DOUBLE END AS confidence, CASE WHEN told IS NULL THEN 'model' ELSE 'feedback' END AS label_source
    FROM (SELECT *, 'k' || CAST(mention_id AS BIGINT) % 4 AS kind, 't' || CAST(mention_id AS BIGINT) % 23 AS normalized_text FROM facts) f LEFT JOIN b USING (kind, normalized_text)""",
    "facts",
)(lambda s, d: semantics.override_by_feedback(
    a.facts(s, d).select("mention_id", F.concat(F.lit("k"), (F.col("mention_id").cast("long") % 4).cast("string")).alias("kind"), F.concat(F.lit("t"), (F.col("mention_id").cast("long") % 23).cast("string")).alias("normalized_text"), F.col("issue_category").alias("label"), "confidence"),
    load(s, d, "orders").groupBy(F.concat(F.lit("k"), (F.col("o_custkey") % 3).cast("string")).alias("kind"), F.concat(F.lit("t"), (F.col("o_custkey") % 20).cast("string")).alias("normalized_text"), F.col("o_orderpriority").alias("label")).agg(F.count(F.lit(1)).alias("votes")).where("votes >= 3"),
).select("mention_id", "label", "confidence", "label_source"))
query(
    "topic_documents",
    f"""+{DOCS}, m AS (SELECT mention_id, text, CASE WHEN CAST(mention_id AS BIGINT) % 3 = 0 THEN 'Big Hint!' WHEN CAST(mention_id AS BIGINT) % 3 = 1 THEN left(text, 3) END AS title FROM docs), s AS (SELECT mention_id, k AS segment, 'part ' || k AS part FROM m, range(0, 3) r(k) WHERE CAST(mention_id AS BIGINT) % 4 > k),
    h AS (SELECT *, CASE WHEN title = 'Big Hint!' THEN 'big hint' ELSE '' END AS hint FROM m), j AS (SELECT h.*, segment, trim(coalesce(part, text)) AS part FROM h LEFT JOIN s USING (mention_id))
    SELECT mention_id || ':' || coalesce('seg-' || segment, 'whole') AS document_id, mention_id, 'seg-' || segment AS segment_id, array_to_string(list_filter([part, CASE WHEN coalesce(segment, 0) = 0 THEN hint ELSE '' END], lambda z: z <> ''), ' ') AS text,
    CASE WHEN CAST(mention_id AS BIGINT) % 2 = 0 THEN language ELSE '' END AS entities, author_id AS aspects, '' AS issues FROM j JOIN (SELECT mention_id, language, author_id FROM docs) USING (mention_id)""",
    "doc_mentions",
)(lambda s, d: _topic_documents(s, d))


def _topic_documents(s, d):
    rows, k = docs(s, d), F.col("mention_id").cast("long")
    mentions = rows.withColumn("summary_title", F.when(k % 3 == 0, "Big Hint!").when(k % 3 == 1, F.left("text", F.lit(3))))
    parts = rows.select("mention_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("segment")).where(k % 4 > F.col("segment")).withColumn("text", F.concat(F.lit("part "), F.col("segment").cast("string")))
    even = rows.select("mention_id", F.when(k % 2 == 0, F.col("language")).alias("entity_id"))
    out = topics.documents(mentions, parts, even.unionByName(even), rows.select("mention_id", F.col("author_id").alias("aspect")), rows.select("mention_id", F.lit(None).cast("string").alias("issue_category")))
    return out.select("document_id", "mention_id", "segment_id", "text", *(F.array_join(c, "|").alias(c) for c in ("entities", "aspects", "issues")))
