"""Queries over entity resolution: specificity, signals, open types, overlapping spans and decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters as a
from ..operators import linking
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


#: Parts as candidates of several shapes, and their names as aliases.
CANDIDATES = """c AS (SELECT p_partkey::VARCHAR AS mention_id, CASE p_partkey % 8 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN replace(p_name, ' ', '') WHEN 3 THEN 'the ' || p_name || ' pro'
    WHEN 4 THEN string_split(p_name, ' ')[2] WHEN 5 THEN 'store' WHEN 6 THEN p_name || 's' ELSE 'Model ' || p_size END AS text, CASE p_size % 4 WHEN 0 THEN 'product' WHEN 1 THEN 'brand' WHEN 2 THEN 'concept' END AS hint,
    CASE p_size % 3 WHEN 0 THEN ['alias_scan'] WHEN 1 THEN ['token_ngram'] ELSE ['hashtag', 'title_span'] END AS methods, 'about ' || p_name AS context FROM part),
    n AS (SELECT *, lower(text) AS normalized, replace(lower(text), ' ', '') AS compact, string_split(lower(text), ' ') AS t FROM c),
    a AS (SELECT DISTINCT p_name AS alias, replace(p_name, ' ', '') AS acompact, 'e.' || replace(p_name, ' ', '_') AS canonical_entity_id, CASE WHEN p_name LIKE 'red%' THEN 'brand' ELSE 'product' END AS entity_type,
    CASE WHEN p_name LIKE 'small%' THEN 'concept' ELSE 'entity' END AS entity_kind FROM part)"""


def candidates(s, d):
    k, name, size = F.col("p_partkey") % 8, F.col("p_name"), F.col("p_size")
    made = (
        F.when(k == 0, name).when(k == 1, F.upper(name)).when(k == 2, F.replace(name, F.lit(" "), F.lit(""))).when(k == 3, F.concat(F.lit("the "), name, F.lit(" pro"))).when(k == 4, F.get(F.split(name, " "), F.lit(1)))
        .when(k == 5, "store").when(k == 6, F.concat(name, F.lit("s"))).otherwise(F.concat(F.lit("Model "), size.cast("string")))
    )
    text = lambda *v: F.array(*map(F.lit, v))
    return load(s, d, "part").select(
        F.col("p_partkey").cast("string").alias("mention_id"), made.alias("text"), F.when(size % 4 == 0, "product").when(size % 4 == 1, "brand").when(size % 4 == 2, "concept").alias("entity_type_hint"),
        ((size % 6) / 10.0 + 0.4).alias("confidence"), F.when(size % 3 == 0, text("alias_scan")).when(size % 3 == 1, text("token_ngram")).otherwise(text("hashtag", "title_span")).alias("methods"),
        F.concat(F.lit("about "), name).alias("context_text"), F.concat(F.lit("about "), name).alias("full_text"),
    )


def aliases(s, d):
    name = F.col("p_name")
    return load(s, d, "part").select(name.alias("alias")).distinct().select(
        "alias", F.col("alias").alias("normalized"), F.replace("alias", F.lit(" "), F.lit("")).alias("compact"), F.concat(F.lit("e."), F.translate("alias", " ", "_")).alias("canonical_entity_id"),
        F.when(F.col("alias").startswith("red"), "brand").otherwise("product").alias("entity_type"), F.when(F.col("alias").startswith("small"), "concept").otherwise("entity").alias("entity_kind"),
    )


def inside(values: str, names) -> str:
    return f"len(list_filter({values}, lambda z: list_contains([{', '.join(repr(n) for n in names)}], z))) > 0"


GENERIC = f"[{', '.join(repr(n) for n in linking.GENERIC_SURFACES)}]"
SPECIFICITY = f"""CASE WHEN list_contains({GENERIC}, normalized) THEN 0.0::DOUBLE ELSE floor(least(greatest(0.0::DOUBLE + CASE WHEN regexp_matches(normalized, '[0-9]') THEN 0.35::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN len(t) >= 2 THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN len(list_filter(t, lambda z: length(z) >= 6)) > 0 THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN hint IN ('product', 'brand', 'retailer', 'organization') THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN {inside('methods', linking.HIGH_SIGNAL)} THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END
    - CASE WHEN {inside('t', linking.GENERIC_SURFACES)} THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END, 0.0::DOUBLE), 1.0::DOUBLE) * 10000.0 + 0.5) / 10000.0 END"""
query("entity_specificity", f"WITH {CANDIDATES} SELECT mention_id, text, {SPECIFICITY} AS specificity, regexp_matches(text, '[A-Z0-9]') AND length(text) >= 4 AS marked FROM n")(
    lambda s, d: linking.prepared(candidates(s, d)).select("mention_id", "text", "specificity", linking.distinctive(F.col("text")).alias("marked"))
)
SIGNIFICANT = f"list_distinct(list_filter({{}}, lambda z: NOT list_contains([{', '.join(repr(w) for w in linking.STOP_WORDS)}], z) AND (length(z) >= 3 OR regexp_matches(z, '[0-9]'))))"
PAIRS = f"""p AS (SELECT *, {SIGNIFICANT.format("t")} AS own, {SIGNIFICANT.format("string_split(alias, ' ')")} AS other, {SPECIFICITY} AS spec FROM n, a),
    m AS (SELECT *, len(list_intersect(own, other))::DOUBLE / greatest(len(own), 1)::DOUBLE AS overlap, coalesce(hint = entity_type, false) AS same_type FROM p WHERE len(list_intersect(own, other)) > 0 OR compact = acompact)"""
PREFIX = f"""len(own) = 1 AND length(own[1]) >= 4 AND NOT list_contains({GENERIC}, own[1]) AND entity_type IN ('brand', 'organization', 'retailer', 'campaign', 'influencer') AND (hint IS NULL OR same_type)
    AND (string_split(alias, ' ')[1] = own[1] OR starts_with(acompact, own[1])) AND (spec >= 0.1 OR (regexp_matches(text, '[A-Z0-9]') AND length(text) >= 4))"""
SIGNALS = f"""CASE WHEN lower(text) = alias THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS exact_alias, CASE WHEN normalized = alias THEN 0.97::DOUBLE ELSE 0.0::DOUBLE END AS normalized_alias,
    CASE WHEN compact = acompact AND length(compact) >= 3 THEN 0.94::DOUBLE ELSE 0.0::DOUBLE END AS compact_alias,
    CASE WHEN alias <> normalized AND contains(' ' || normalized || ' ', ' ' || alias || ' ') THEN least(length(alias)::DOUBLE / greatest(length(normalized), 1)::DOUBLE + CASE WHEN same_type THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END, 0.96::DOUBLE) ELSE 0.0::DOUBLE END AS boundary_support,
    CASE WHEN overlap >= 0.6::DOUBLE AND contains(' ' || context || ' ', ' ' || alias || ' ') THEN least(0.58::DOUBLE + overlap * 0.22::DOUBLE, 0.9::DOUBLE) ELSE 0.0::DOUBLE END AS contextual_support,
    CASE WHEN {PREFIX} THEN least(0.72::DOUBLE + CASE WHEN same_type THEN 0.04::DOUBLE ELSE 0.0::DOUBLE END, 0.86::DOUBLE) ELSE 0.0::DOUBLE END AS unique_prefix_support"""
FIVE = linking.SIGNALS[:-1]
query(
    "entity_signals",
    f"WITH {CANDIDATES}, {PAIRS}, s AS (SELECT mention_id, canonical_entity_id, {SIGNALS} FROM m) SELECT * FROM s WHERE greatest({', '.join(FIVE)}) > 0",
)(
    lambda s, d: (lambda c: linking.signals(c, aliases(s, d)).join(c.select("candidate_id", "mention_id"), "candidate_id").where(F.greatest(*FIVE) > 0).select("mention_id", "canonical_entity_id", *FIVE))(
        linking.prepared(candidates(s, d))
    )
)
# One ratio needs no common subsequence: names against themselves with one letter more.
query("entity_fuzzy_signals", f"WITH {CANDIDATES} SELECT mention_id, 'e.' || replace(left(normalized, length(normalized) - 1), ' ', '_') AS canonical_entity_id, 0.9::DOUBLE AS fuzzy_support FROM n WHERE mention_id::BIGINT % 8 = 6")(
    lambda s, d: (lambda c: linking.signals(c, aliases(s, d)).join(c.select("candidate_id", "mention_id", "normalized"), "candidate_id"))(linking.prepared(candidates(s, d).where("cast(mention_id as bigint) % 8 = 6")))
    .where(F.col("canonical_entity_id") == F.concat(F.lit("e."), F.translate(F.expr("left(normalized, length(normalized) - 1)"), " ", "_")))
    .select("mention_id", "canonical_entity_id", "fuzzy_support")
)
VOTES = f"""v AS (SELECT entity_type, unnest({SIGNIFICANT.format("string_split(alias, ' ')")}) AS token FROM a), tv AS (SELECT token, entity_type, count(*) AS n FROM v GROUP BY ALL),
    cast_ AS (SELECT mention_id, entity_type, sum(tv.n) AS n FROM (SELECT mention_id, unnest({SIGNIFICANT.format('t')}) AS token FROM n) JOIN tv USING (token) GROUP BY ALL),
    voted AS (SELECT mention_id, arg_min(entity_type, list_position([{', '.join(repr(t) for t in linking.OPEN_TYPES)}], entity_type)) AS voted FROM cast_ WHERE n >= 2 GROUP BY mention_id)"""
CUES = "CASE " + " ".join(f"WHEN {' OR '.join(f"contains(said, '{cue}')" for cue in linking.TYPE_CUES[t])} THEN '{t}'" for t in linking.OPEN_TYPES) + " END"
query(
    "open_entity_types",
    f"""WITH {CANDIDATES}, {VOTES}, w AS (SELECT n.*, normalized || ' || ' || context AS said, a.entity_type AS alias_type FROM n LEFT JOIN a ON normalized = alias)
    SELECT mention_id, CASE WHEN alias_type IS NOT NULL THEN alias_type WHEN voted IS NOT NULL THEN voted WHEN regexp_matches(normalized, '[0-9]') THEN 'product' ELSE {CUES} END AS entity_type FROM w LEFT JOIN voted USING (mention_id)""",
)(lambda s, d: linking.open_types(linking.prepared(candidates(s, d)).withColumnRenamed("mention_id", "phrase_id"), aliases(s, d)).select(F.col("phrase_id").alias("mention_id"), "entity_type"))
# Events as spans over their users' time lines.
query(
    "span_overlaps",
    """WITH s AS (SELECT user_id::VARCHAR AS mention_id, event_id::VARCHAR AS span_id, event_id AS start, event_id + 1 + CAST(floor(value) AS BIGINT) % 90 AS stop FROM events)
    SELECT l.mention_id, l.span_id AS left, r.span_id AS right FROM s l JOIN s r ON l.mention_id = r.mention_id AND l.start < r.stop AND r.start < l.stop AND (l.start < r.start OR (l.start = r.start AND l.span_id < r.span_id))""",
)(
    lambda s, d: linking.overlapping(
        load(s, d, "events").select(F.col("user_id").cast("string").alias("mention_id"), F.col("event_id").cast("string").alias("span_id"), F.col("event_id").alias("start"), (F.col("event_id") + 1 + F.floor("value") % 90).alias("stop"))
    )
)
query("entity_decisions")(lambda s, d: linking.decide(candidates(s, d), aliases(s, d), ["store"]))
# Names, and the same names recognised again as places beside them: each pair becomes one candidate.
query(
    "merged_sources",
    """SELECT p_partkey::VARCHAR AS mention_id, CASE WHEN p_size % 2 = 0 THEN p_name ELSE upper(p_name) END AS text, 10::INTEGER AS start, floor((0.64::DOUBLE + 0.02::DOUBLE + 0.01::DOUBLE) * 1000.0 + 0.5) / 1000.0 AS confidence,
    CASE WHEN p_size % 2 = 0 THEN 'alias_scan|ner' ELSE 'ner|title_span' END AS methods FROM part UNION ALL SELECT p_partkey::VARCHAR, 'zzz', 900, 0.3::DOUBLE, 'ner' FROM part""",
)(
    lambda s, d: linking.merge_sources(
        _spans(s, d, F.col("p_name"), 10, 0.6, F.when(F.col("p_size") % 2 == 0, "alias_scan").otherwise("title_span")),
        _spans(s, d, F.upper("p_name"), 10, 0.64, F.lit("ner")).unionByName(_spans(s, d, F.lit("zzz"), 900, 0.3, F.lit("ner"))),
    ).select("mention_id", "text", "start", "confidence", F.array_join("methods", "|").alias("methods"))
)


def _spans(s, d, text, start, confidence, method):
    return load(s, d, "part").select(
        F.col("p_partkey").cast("string").alias("mention_id"), text.alias("text"), F.lower(text).alias("normalized"), F.lit(start).alias("start"), (start + F.length(text)).alias("stop"), F.lit(None).cast("string").alias("entity_type_hint"),
        F.lit(confidence).alias("confidence"), F.array(method).alias("methods"),
    )


#: Signals and likeness of two entities to each candidate, made of the parts' numbers.
FOUND = """cand AS (SELECT p_partkey::VARCHAR AS candidate_id, CASE p_size % 3 WHEN 0 THEN 'brand' WHEN 1 THEN 'product' END AS hint, 0.4::DOUBLE + (p_size % 6) / 10.0::DOUBLE AS confidence, CASE p_size % 4 WHEN 0 THEN ['alias_scan'] WHEN 1 THEN ['title_span', 'hashtag'] ELSE ['token_ngram'] END AS methods,
    (p_size % 10) / 10.0::DOUBLE AS specificity, p_size, p_partkey FROM part), two AS (SELECT cand.*, 'e' || k AS canonical_entity_id, CASE WHEN (p_size + k) % 2 = 0 THEN 'brand' ELSE 'product' END AS entity_type, CASE WHEN (p_partkey + k) % 4 = 0 THEN 'concept' ELSE 'entity' END AS entity_kind,
    CASE WHEN (p_partkey + k) % 7 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS exact_alias, CASE WHEN (p_partkey + k) % 5 = 0 THEN 0.97::DOUBLE ELSE 0.0::DOUBLE END AS normalized_alias, CASE WHEN (p_partkey + k) % 5 < 2 THEN 0.94::DOUBLE ELSE 0.0::DOUBLE END AS compact_alias,
    ((p_size * k) % 9) / 10.0::DOUBLE AS boundary_support, ((p_size + k) % 8) / 10.0::DOUBLE AS contextual_support, CASE WHEN k = 2 THEN 0.72::DOUBLE ELSE 0.0::DOUBLE END AS unique_prefix_support, 0.5::DOUBLE AS fuzzy_support, ((p_partkey + k) % 11) / 11.0::DOUBLE AS alias_surface_support,
    ((p_size + k) % 10) / 10.0::DOUBLE - 0.2::DOUBLE AS span, ((p_size + 2 * k) % 10) / 10.0::DOUBLE AS local, ((p_size + 3 * k) % 10) / 10.0::DOUBLE AS full_, 0.3::DOUBLE AS thread, (k % 3) / 20.0::DOUBLE AS context_support FROM cand, range(1, 8) r(k))"""


def found(s, d):
    size, key, k = F.col("p_size"), F.col("p_partkey"), F.col("k")
    text = lambda *v: F.array(*map(F.lit, v))
    if_ = lambda c, v: F.when(c, v).otherwise(0.0)
    cand = load(s, d, "part").select(
        key.cast("string").alias("candidate_id"), F.when(size % 3 == 0, "brand").when(size % 3 == 1, "product").alias("entity_type_hint"), ((size % 6) / 10.0 + 0.4).alias("confidence"),
        F.when(size % 4 == 0, text("alias_scan")).when(size % 4 == 1, text("title_span", "hashtag")).otherwise(text("token_ngram")).alias("methods"), ((size % 10) / 10.0).alias("specificity"), "p_size", "p_partkey",
    )
    two = cand.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(7)))).select(
        "candidate_id", F.concat(F.lit("e"), k.cast("string")).alias("canonical_entity_id"), F.when((size + k) % 2 == 0, "brand").otherwise("product").alias("entity_type"), F.when((key + k) % 4 == 0, "concept").otherwise("entity").alias("entity_kind"),
        if_((key + k) % 7 == 0, 1.0).alias("exact_alias"), if_((key + k) % 5 == 0, 0.97).alias("normalized_alias"), if_((key + k) % 5 < 2, 0.94).alias("compact_alias"), (((size * k) % 9) / 10.0).alias("boundary_support"), (((size + k) % 8) / 10.0).alias("contextual_support"),
        if_(k == 2, 0.72).alias("unique_prefix_support"), F.lit(0.5).alias("fuzzy_support"), (((key + k) % 11) / 11.0).alias("alias_surface_support"), (((size + k) % 10) / 10.0 - 0.2).alias("span"), (((size + 2 * k) % 10) / 10.0).alias("local"),
        (((size + 3 * k) % 10) / 10.0).alias("full"), F.lit(0.3).alias("thread"), ((k % 3) / 20.0).alias("context_support"),
    )
    return cand, two


BONUS = "greatest(0.0::DOUBLE, " + ", ".join(f"CASE WHEN list_contains(methods, '{m}') THEN {v}::DOUBLE ELSE 0.0::DOUBLE END" for m, v in linking.SOURCE_BONUS.items()) + ")"
BASE = f"""b AS (SELECT *, CASE WHEN hint IS NULL THEN 0.0::DOUBLE WHEN hint = entity_type THEN 0.14::DOUBLE ELSE -0.16::DOUBLE END AS tb, {BONUS} AS sb, CASE WHEN specificity < 0.15 AND entity_kind = 'entity' THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END AS gp,
    CASE WHEN entity_kind = 'entity' THEN 1 ELSE 0 END AS ent FROM two)"""


def rounded6(x: str) -> str:
    return f"floor(({x}) * 1000000.0 + 0.5) / 1000000.0"


def clamp6(x: str) -> str:
    return rounded6(f"greatest(least({x}, 0.995::DOUBLE), 0.0::DOUBLE)")


LINES = {"exact_alias": (0.94, 0.04), "normalized_alias": (0.88, 0.08), "compact_alias": (0.84, 0.12), "boundary_support": (0.52, 0.38), "contextual_support": (0.5, 0.34), "unique_prefix_support": (0.5, 0.3), "fuzzy_support": (0.42, 0.24)}
SURE = "greatest(" + ", ".join(f"CASE WHEN {c} > 0 THEN {v}::DOUBLE + {c} * {w}::DOUBLE ELSE 0.0::DOUBLE END" for c, (v, w) in LINES.items()) + ")"
TOP = f"greatest({', '.join(linking.SIGNALS)}, alias_surface_support)"
VERIFIED = "+ {c} * 0.05::DOUBLE + specificity * 0.08::DOUBLE + {anchor} + greatest(tb, 0.0::DOUBLE) * 0.08::DOUBLE + ent * 0.04::DOUBLE - greatest(-tb, 0.0::DOUBLE) * 0.22::DOUBLE - cp * 0.72::DOUBLE - gp * 0.8::DOUBLE".format
CONF = "least(confidence, 1.0::DOUBLE)"
query(
    "entity_ranking",
    f"""WITH {FOUND}, {BASE}, c AS (SELECT *, CASE WHEN entity_kind = 'concept' AND specificity >= 0.34 AND compact_alias <= 0 THEN 0.18::DOUBLE ELSE 0.0::DOUBLE END AS cp FROM b),
    h AS (SELECT *, {SURE} + alias_surface_support * 0.08::DOUBLE + {CONF} * 0.04::DOUBLE + sb + tb - gp - cp AS heur, {clamp6(f"{TOP} * 0.34::DOUBLE {VERIFIED(c=CONF, anchor='least(sb + ent * 0.03::DOUBLE, 0.32::DOUBLE)')}")} AS ver FROM c),
    f AS (SELECT candidate_id, canonical_entity_id, {clamp6('ver * 0.58::DOUBLE + heur * 0.42::DOUBLE')} AS score, ver AS verifier_score, hint IS NULL OR hint = entity_type AS type_consistent FROM h)
    SELECT *, place::INTEGER AS place FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY score DESC, canonical_entity_id) AS place_ FROM f) t(candidate_id, canonical_entity_id, score, verifier_score, type_consistent, place) WHERE place <= 5""".replace("SELECT *, place::INTEGER AS place FROM", "SELECT candidate_id, canonical_entity_id, score, verifier_score, type_consistent, place::INTEGER AS place FROM"),
)(lambda s, d: (lambda c, f: linking.ranked(c, f).select("candidate_id", "canonical_entity_id", "score", "verifier_score", "type_consistent", "place"))(*found(s, d)))
ALL_PARTS = " + ".join(f"{c} * {w}::DOUBLE" for c, w in linking.PROTOTYPE_WEIGHT.items()) + " + " + " + ".join(f"{'full_' if c == 'full' else c} * {w}::DOUBLE" for c, w in linking.VIEW_WEIGHT.items())
AGREED = " + ".join(f"{'full_' if c == 'full' else c} * {w}::DOUBLE" for c, w in linking.CONSENSUS.items())
query(
    "prototype_ranking",
    f"""WITH {FOUND}, {BASE}, c AS (SELECT * REPLACE (greatest(span, 0.0::DOUBLE) AS span), CASE WHEN entity_kind = 'concept' AND specificity >= 0.34 AND exact_alias <= 0 AND compact_alias <= 0 THEN 0.18::DOUBLE ELSE 0.0::DOUBLE END AS cp FROM b),
    h AS (SELECT *, 0.0::DOUBLE + {ALL_PARTS} + {CONF} * 0.05::DOUBLE + sb + context_support + ent * 0.03::DOUBLE + tb - cp - gp AS heur, {clamp6(f"(0.0::DOUBLE + {AGREED}) * 0.34::DOUBLE + {TOP} * 0.34::DOUBLE {VERIFIED(c=CONF, anchor='least(sb + context_support + ent * 0.03::DOUBLE, 0.32::DOUBLE)')}")} AS ver FROM c),
    f AS (SELECT candidate_id, canonical_entity_id, {clamp6('ver * 0.62::DOUBLE + heur * 0.38::DOUBLE')} AS score, {rounded6('heur')} AS heuristic_score, ver AS verifier_score FROM h)
    SELECT candidate_id, canonical_entity_id, score, heuristic_score, verifier_score, place::INTEGER AS place FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY score DESC, canonical_entity_id) AS place FROM f) WHERE place <= 5""",
)(lambda s, d: (lambda c, f: linking.ranked_by_prototypes(c, f.drop("span", "local", "full", "thread", "context_support"), f.select("candidate_id", "canonical_entity_id", "entity_type", "entity_kind", "span", "local", "full", "thread", "context_support")))(*found(s, d)))
query("span_proposals", rf"SELECT mention_id, text, count(*) AS n FROM (SELECT doc_id::VARCHAR AS mention_id, unnest(regexp_extract_all(text, '(?:^|[^\p{{L}}\p{{N}}])({linking.PROPOSED})', 1)) AS text FROM documents) GROUP BY ALL")(
    lambda s, d: linking.proposals(a.doc_mentions(s, d)).groupBy("mention_id", "text").agg(F.count(F.lit(1)).alias("n"))
)
query(
    "recognised_spans",
    """WITH p AS (SELECT p_partkey::VARCHAR AS mention_id, p_name || ' ' || p_size AS text, (p_size % 10) / 10.0::DOUBLE AS a, (p_partkey % 10) / 10.0::DOUBLE AS t FROM part), one AS (SELECT text, max(a) AS a, max(t) AS t FROM p GROUP BY text), j AS (SELECT p.mention_id, p.text, one.a, one.t + 0.08::DOUBLE AS t FROM p JOIN one USING (text))
    SELECT mention_id, text, CASE WHEN a >= 0.66 THEN 'brand' ELSE 'product' END AS entity_type_hint, floor((CASE WHEN a >= 0.66 THEN least(greatest(a, 0.72::DOUBLE), 0.99::DOUBLE) ELSE least(t, 0.92::DOUBLE) END) * 1000.0 + 0.5) / 1000.0 AS confidence FROM j WHERE a >= 0.66 OR t >= 0.62""",
)(lambda s, d: _recognised(s, d))


def _recognised(s, d):
    text = F.concat_ws(" ", "p_name", F.col("p_size").cast("string"))
    p = load(s, d, "part").select(F.col("p_partkey").cast("string").alias("mention_id"), text.alias("text"), F.lit(0).alias("start"), F.length(text).alias("stop"), ((F.col("p_size") % 10) / 10.0).alias("a"), ((F.col("p_partkey") % 10) / 10.0).alias("t"))
    best = lambda c, kind: p.groupBy("text").agg(F.max(c).alias("score")).withColumn("entity_type", F.lit(kind))
    return linking.recognised(p.drop("a", "t"), best("a", "brand"), best("t", "product")).select("mention_id", "text", "entity_type_hint", "confidence")
