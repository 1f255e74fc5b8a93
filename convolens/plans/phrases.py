"""Queries over phrases: spellings, likeness, windows, significance, readability and text functions of their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters as a
from ..functions import phrases as p
from ..functions import text as x
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


#: Tags, accents, long letters, slashes, codes, links and noise, made of the parts' columns.
PHRASES = """phrases AS (SELECT p_partkey AS id, CASE p_partkey % 8 WHEN 0 THEN '#' || replace(p_name, ' ', '') WHEN 1 THEN p_name || '/' || lower(p_type) || '-' || p_size WHEN 2 THEN 'Sooo Niiice ' || p_name || '!!!'
    WHEN 3 THEN 'Café ' || p_brand || ' éclair' WHEN 4 THEN 'this' WHEN 5 THEN '  the ' || p_name || '  ok ' WHEN 6 THEN 'http://x.y/' || p_size || ' @' || p_name ELSE '' END AS phrase, p_name AS name, p_type AS type, p_size AS size FROM part)"""


def phrases(s, d):
    k, name = F.col("p_partkey") % 8, F.col("p_name")
    c = lambda *parts: F.concat(*(F.lit(z) if isinstance(z, str) else z for z in parts))
    size = F.col("p_size").cast("string")
    made = (
        F.when(k == 0, c("#", F.replace(name, F.lit(" "), F.lit("")))).when(k == 1, c(name, "/", F.lower("p_type"), "-", size)).when(k == 2, c("Sooo Niiice ", name, "!!!"))
        .when(k == 3, c("Café ", F.col("p_brand"), " éclair")).when(k == 4, "this").when(k == 5, c("  the ", name, "  ok ")).when(k == 6, c("http://x.y/", size, " @", name)).otherwise("")
    )
    return load(s, d, "part").select(F.col("p_partkey").alias("id"), made.alias("phrase"), name.alias("name"), F.col("p_type").alias("type"), F.col("p_size").alias("size"))


ALIAS = r"trim(regexp_replace(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}_\s\x0b]', ' ', 'g'), '[\s\x0b]+', ' ', 'g'))"
PLAIN = r"trim(regexp_replace(translate(lower({}), '_-', '  '), '[\s\x0b]+', ' ', 'g'))"
LIST = "list_filter(string_split({}, ' '), lambda z: z <> '')"
TOGETHER = "replace({}, ' ', '')"


def distinct_in_order(items: str) -> str:
    """First occurrences in order (list_distinct keeps no order)."""
    return f"list_filter({items}, lambda z, i: z <> '' AND list_position({items}, z) = i)"


def words_sql(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def long4(sql: str) -> str:
    return f"CASE WHEN length({sql}) >= 4 THEN {sql} ELSE '' END"


ALIASED = ALIAS.format("phrase")
query("nfkc", "SELECT p_partkey AS id, nfc_normalize(replace(replace(replace('ﬁne ' || p_name || ' ①②' || chr(8482) || 'e' || chr(769), 'ﬁ', 'fi'), '①②', '12'), chr(8482), 'TM')) AS text FROM part")(
    lambda s, d: load(s, d, "part").select(F.col("p_partkey").alias("id"), x.nfkc(F.concat(F.lit("ﬁne "), "p_name", F.lit(" ①②™é"))).alias("text"))
)
query("squeeze", rf"WITH {PHRASES} SELECT id, trim(regexp_replace(phrase, '[\s\x0b]+', ' ', 'g')) AS text FROM phrases")(lambda s, d: phrases(s, d).select("id", x.squeeze(F.col("phrase")).alias("text")))
# DuckDB's expressions know no back-references, so each letter that repeats here is written out.
COLLAPSED = "regexp_replace(regexp_replace(regexp_replace(phrase, 'o{3,}', 'oo', 'g'), 'i{3,}', 'ii', 'g'), '!{3,}', '!!', 'g')"
query("collapse_repeats", f"WITH {PHRASES} SELECT id, {COLLAPSED} AS text FROM phrases")(lambda s, d: phrases(s, d).select("id", x.collapse_repeats(F.col("phrase")).alias("text")))
query("fold_phrases", f"WITH {PHRASES} SELECT id, strip_accents(phrase) AS text FROM phrases")(lambda s, d: phrases(s, d).select("id", x.fold_accents(F.col("phrase")).alias("text")))
FOLDED = "strip_accents(phrase)"
VARIANTS = f"""[trim(phrase), {ALIASED}, {ALIAS.format("regexp_replace(phrase, '^[#@]+', '')")}, trim({FOLDED}), {ALIAS.format(FOLDED)}, {long4(TOGETHER.format(ALIASED))}, {ALIAS.format(COLLAPSED)},
    {long4(TOGETHER.format(ALIAS.format(COLLAPSED)))}, {ALIAS.format("translate(phrase, '/-', '  ')")}]"""
query("phrase_variants", f"WITH {PHRASES}, v AS (SELECT id, {VARIANTS} AS v FROM phrases) SELECT id, array_to_string({distinct_in_order('v')}, '|') AS variants FROM v")(
    lambda s, d: phrases(s, d).select("id", F.array_join(p.phrase_variants(F.col("phrase")), "|").alias("variants"))
)
query("query_variants", f"WITH {PHRASES}, v AS (SELECT id, [phrase, {ALIASED}, strip_accents({ALIASED}), replace({ALIASED}, ' ', '')] AS v FROM phrases) SELECT id, array_to_string({distinct_in_order('v')}, '|') AS variants FROM v")(
    lambda s, d: phrases(s, d).select("id", F.array_join(x.query_variants(F.col("phrase")), "|").alias("variants"))
)
PLAINED = PLAIN.format("phrase")
query("prototype_variants", f"WITH {PHRASES}, v AS (SELECT id, [trim(phrase), {PLAINED}, strip_accents({PLAINED}), replace({PLAINED}, ' ', '')] AS v FROM phrases) SELECT id, array_to_string({distinct_in_order('v')}, '|') AS variants FROM v")(
    lambda s, d: phrases(s, d).select("id", F.array_join(p.prototype_variants(F.col("phrase")), "|").alias("variants"))
)
query(
    "lexical_similarity",
    f"""WITH {PHRASES}, t AS (SELECT id, {PLAINED} AS x, {PLAIN.format("name || CASE WHEN id % 16 = 0 THEN '' ELSE '_' || type END")} AS y FROM phrases), s AS (SELECT *, list_distinct({LIST.format('x')}) AS s, list_distinct({LIST.format('y')}) AS t FROM t)
    SELECT id, CASE WHEN len(s) = 0 OR len(t) = 0 THEN 0.0::DOUBLE WHEN replace(x, ' ', '') = replace(y, ' ', '') THEN 1.0::DOUBLE ELSE len(list_intersect(s, t))::DOUBLE / len(list_distinct(list_concat(s, t)))::DOUBLE END AS similarity FROM s""",
)(lambda s, d: phrases(s, d).select("id", p.lexical_similarity(F.col("phrase"), F.concat("name", F.when(F.col("id") % 16 == 0, "").otherwise(F.concat(F.lit("_"), "type")))).alias("similarity")))


def jaccard_sql(empty: float) -> str:
    return f"CASE WHEN len(list_distinct(list_concat(s, t))) = 0 THEN {empty}::DOUBLE ELSE len(list_intersect(s, t))::DOUBLE / len(list_distinct(list_concat(s, t)))::DOUBLE END"


query(
    "token_jaccard",
    f"WITH {PHRASES}, t AS (SELECT id, list_distinct({LIST.format(ALIASED)}) AS s, list_distinct({LIST.format('CASE WHEN id % 8 = 7 THEN phrase ELSE name END')}) AS t FROM phrases) SELECT id, {jaccard_sql(1.0)} AS one, {jaccard_sql(0.0)} AS nought FROM t",
)(
    lambda s, d: phrases(s, d)
    .select("id", F.array_distinct(x.tokens(x.normalize_alias(F.col("phrase")))).alias("s"), F.array_distinct(x.tokens(F.when(F.col("id") % 8 == 7, F.col("phrase")).otherwise(F.col("name")))).alias("t"))
    .select("id", x.jaccard(F.col("s"), F.col("t"), 1.0).alias("one"), x.jaccard(F.col("s"), F.col("t"), 0.0).alias("nought"))
)


def runs_sql(items: str, n: int) -> str:
    return f"list_transform(range(1, greatest(len({items}) - {n - 1}, 0) + 1), lambda i: array_to_string(list_slice({items}, i, i + {n - 1}), ' '))"


WINDOWS = "list_concat(" * 3 + f"{runs_sql('t', 1)}, {runs_sql('t', 2)}), {runs_sql('t', 3)}), {runs_sql('t', 4)})"
query(
    "phrase_windows",
    f"""WITH {PHRASES}, t AS (SELECT id, {LIST.format(ALIASED)} AS t FROM phrases)
    SELECT id, array_to_string(list_sort(list_distinct(list_filter({WINDOWS}, lambda w: length(w) >= 3 AND len(list_filter(string_split(w, ' '), lambda z: NOT list_contains({words_sql(p.GENERIC_WORDS)}, z))) > 0))), '|') AS windows FROM t""",
)(lambda s, d: phrases(s, d).select("id", F.array_join(F.array_sort(p.phrase_windows(x.normalize_alias(F.col("phrase")))), "|").alias("windows")))
query(
    "significant_phrases",
    rf"""WITH {PHRASES}, t AS (SELECT id, list_filter(regexp_extract_all({ALIASED}, '[\p{{L}}\p{{N}}_]+'), lambda z: NOT list_contains({words_sql(p.STOP_WORDS)}, z) AND (length(z) >= 3 OR regexp_matches(z, '[0-9]'))) AS t FROM phrases)
    SELECT id, array_to_string(list_sort(list_distinct(list_concat(list_concat(list_filter(t, lambda z: length(z) >= 5 OR regexp_matches(z, '[0-9]')), {runs_sql('t', 2)}), {runs_sql('t', 3)}))), '|') AS phrases FROM t""",
)(lambda s, d: phrases(s, d).select("id", F.array_join(F.array_sort(p.significant_phrases(x.normalize_alias(F.col("phrase")))), "|").alias("phrases")))


def any_sql(test: str) -> str:
    return f"len(list_filter(t, lambda z: {test})) > 0"


def score_sql(start: float, *parts: tuple[str, float]) -> str:
    total = f"{start}::DOUBLE" + "".join(f" + CASE WHEN {c} THEN {v}::DOUBLE ELSE 0.0::DOUBLE END" for c, v in parts)
    return f"floor(least(greatest({total}, 0.0::DOUBLE), 1.0::DOUBLE) * 10000.0 + 0.5) / 10000.0"


NOISE, GENERIC = f"list_contains({words_sql(p.NOISE_WORDS)}, z)", f"list_contains({words_sql(p.GENERIC_WORDS)}, z)"
HYGIENE = score_sql(0.34, (any_sql(f"NOT {NOISE} AND (length(z) >= 4 OR regexp_matches(z, '[0-9]'))"), 0.28), ("len(t) >= 2", 0.18), ("regexp_matches(alias, '[0-9]')", 0.08), (any_sql(NOISE), -0.12))
EVIDENCE = score_sql(0.34, ("len(t) >= 2", 0.2), (any_sql(NOISE), -0.18), (any_sql("contains(z, 'http')"), -0.3), ("len(t) = 1 AND length(t[1]) < 4 AND NOT regexp_matches(t[1], '[0-9]')", -0.14))
LABEL = score_sql(0.36, ("len(t) >= 2", 0.18), (any_sql(GENERIC), -0.18), (any_sql("starts_with(z, '#') OR starts_with(z, '@')"), -0.34), (any_sql("contains(z, 'http')"), -0.34), (any_sql("length(z) >= 5"), 0.14), ("regexp_matches(clean, '[0-9]')", 0.08))
query(
    "phrase_scores",
    f"""WITH {PHRASES}, n AS (SELECT id, {ALIASED} AS alias, trim(regexp_replace(lower(phrase), '[\\s\\x0b]+', ' ', 'g')) AS clean FROM phrases), one AS (SELECT *, {LIST.format('alias')} AS t FROM n),
    two AS (SELECT id, clean, {LIST.format("translate(clean, '/', ' ')")} AS t FROM n),
    scored AS (SELECT id, CASE WHEN len(t) = 0 OR (len(t) = 1 AND {any_sql(NOISE)}) THEN 0.0::DOUBLE ELSE {HYGIENE} END AS hygiene, CASE WHEN len(t) = 0 THEN 0.0::DOUBLE ELSE {EVIDENCE} END AS evidence FROM one)
    SELECT id, hygiene, evidence, CASE WHEN len(t) = 0 THEN 0.0::DOUBLE ELSE {LABEL} END AS label FROM scored JOIN two USING (id)""",
)(lambda s, d: phrases(s, d).select("id", p.hygiene(F.col("phrase")).alias("hygiene"), p.artifact_readability(F.col("phrase")).alias("evidence"), p.label_readability(F.col("phrase")).alias("label")))
query(
    "boundary_spans",
    r"""WITH w AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '[^\p{L}\p{N}_]', ' ', 'g'), ' ')) AS w, generate_subscripts(string_split(regexp_replace(text, '[^\p{L}\p{N}_]', ' ', 'g'), ' '), 1) AS k FROM documents),
    spots AS (SELECT doc_id, w, (sum(length(w) + 1) OVER (PARTITION BY doc_id ORDER BY k))::BIGINT - length(w) - 1 AS start FROM w)
    SELECT doc_id, start, start + 3 AS stop FROM spots WHERE lower(w) = 'the'""",
)(lambda s, d: load(s, d, "documents").select("doc_id", F.explode(p.boundary_spans(F.col("text"), "the")).alias("z")).select("doc_id", F.col("z.start").cast("long").alias("start"), F.col("z.stop").cast("long").alias("stop")))
query("boundary_contains", r"SELECT doc_id, list_contains(string_split(regexp_replace(lower(text), '[^\p{L}\p{N}_]', ' ', 'g'), ' '), 'the') AS held FROM documents")(
    lambda s, d: load(s, d, "documents").select("doc_id", x.boundary_contains(F.col("text"), "the").alias("held"))
)
joined = PLAINED
for words in ("red widget", "small ring", "blue gear"):
    joined = f"regexp_replace({joined}, '(^| ){words}( |$)', '\\1{words.replace(' ', '_')}\\2', 'g')"
LEXICON = ("red widget", "small ring", "red", "blue-gear")
query(
    "prepared_phrases",
    f"""WITH {PHRASES} SELECT id, 'entity: ' || CASE WHEN trim(phrase) = '' THEN '<empty>' ELSE {joined} END AS prepared FROM phrases""",
)(lambda s, d: p.prepare(phrases(s, d).withColumnRenamed("phrase", "text"), LEXICON, "linking").select("id", "prepared"))
query("split_hashtags", "SELECT p_partkey AS id, replace(p_name, ' ', '') || ' X ' || p_size || ' pro ' || lower(p_type) AS words FROM part")(
    lambda s, d: load(s, d, "part").select(F.col("p_partkey").alias("id"), x.split_hashtag(F.concat(F.replace("p_name", F.lit(" "), F.lit("")), F.lit("X"), F.col("p_size").cast("string"), F.lit("pro_"), F.lower("p_type"))).alias("words"))
)
query("processing_text", "SELECT p_partkey AS id, 'soo good ' || p_name || '! không ' || replace(p_name, ' ', '') || ' ' || p_size || ' end.' AS text FROM part")(
    lambda s, d: load(s, d, "part")
    .select("*", F.concat(F.replace("p_name", F.lit(" "), F.lit("")), F.col("p_size").cast("string")).alias("tag"))
    .select(F.col("p_partkey").alias("id"), x.processing_text(F.concat(F.lit("sooo good 😀 "), "p_name", F.lit("!!! hok @someone #"), "tag", F.lit(" https://a.b/c end..")), F.array("tag")).alias("text"))
)
query("normalized_hashtags", "SELECT p_partkey AS id, array_to_string(CASE WHEN p_size % 2 = 0 THEN [lower(replace(p_name, ' ', '')), 'new', 'extra'] ELSE [lower(replace(p_name, ' ', '')), 'new'] END, '|') AS tags FROM part")(
    lambda s, d: load(s, d, "part").select(
        F.col("p_partkey").alias("id"),
        F.array_join(x.hashtags(F.concat(F.lit("look #"), F.initcap(F.replace("p_name", F.lit(" "), F.lit(""))), F.lit(" #NEW #new!")), F.when(F.col("p_size") % 2 == 0, F.array(F.lit("##Extra"), F.lit("new"), F.lit("")))), "|").alias("tags"),
    )
)
query("emoji_runs", "SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN '😀🎉|🚀' ELSE '' END AS runs FROM part")(
    lambda s, d: load(s, d, "part").select(F.col("p_partkey").alias("id"), F.array_join(x.emojis(F.concat("p_name", F.when(F.col("p_size") % 2 == 0, "😀🎉 ok🚀").otherwise(" none"))), "|").alias("runs"))
)
query("mojibake", "SELECT p_partkey AS id, CASE p_size % 3 WHEN 0 THEN p_name || ' déjà' WHEN 1 THEN p_name || ' Ãx' ELSE p_name END AS text FROM part")(
    lambda s, d: load(s, d, "part").select(F.col("p_partkey").alias("id"), x.repair_mojibake(F.concat("p_name", F.when(F.col("p_size") % 3 == 0, " dÃ©jÃ ").when(F.col("p_size") % 3 == 1, " Ãx").otherwise(""))).alias("text"))
)
# Names of parts against other names: longest common subsequences, by the closed form for words of one letter each.
query(
    "fuzzy_ratios",
    """SELECT p_partkey AS id, 200.0::DOUBLE * least(p_size, 7) / (p_size + 7)::DOUBLE AS ratio, CASE WHEN p_size % 2 = 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS token_set FROM part""",
)(
    lambda s, d: load(s, d, "part").select(
        F.col("p_partkey").alias("id"), x.fuzzy_ratio(F.repeat(F.lit("a"), F.col("p_size")), F.lit("a" * 7)).alias("ratio"),
        x.fuzzy_token_set(F.lit("fresh red paint"), F.when(F.col("p_size") % 2 == 0, "paint red fresh red").otherwise("")).alias("token_set"),
    )
)
