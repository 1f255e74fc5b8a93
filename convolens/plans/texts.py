"""Queries over documents: text functions, duplicates, spam, language, rule enrichers, vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters as a
from ..functions import text as x
from ..operators import dedup, language, rules, spam, vectors
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


def docs(s, d):
    """Documents as mentions with compact text."""
    return a.doc_mentions(s, d).withColumn("text", x.compact_text(F.col("raw_text")))


SQUEEZE = r"trim(regexp_replace({}, '[\s\x0b]+', ' ', 'g'))"
COMPACT = SQUEEZE.format(r"translate(regexp_replace(lower(raw_text), '[^\p{L}\p{N}_\s\x0b#:/+-]', ' ', 'g'), '/_', '  ')")
DOCS = f"docs AS (SELECT *, {COMPACT} AS text FROM doc_mentions)"
TOKENS = "list_filter(string_split(text, ' '), lambda t: t <> '')"

query("compact_text", f"+{DOCS} SELECT mention_id, text FROM docs", "doc_mentions")(lambda s, d: docs(s, d).select("mention_id", "text"))
query("normalize_alias", "SELECT mention_id, " + SQUEEZE.format(r"regexp_replace(lower(raw_text), '[^\p{L}\p{N}_\s\x0b]', ' ', 'g')") + " AS alias FROM doc_mentions", "doc_mentions")(
    lambda s, d: a.doc_mentions(s, d).select("mention_id", x.normalize_alias(F.col("raw_text")).alias("alias"))
)
query("extract_urls", r"SELECT page_id, array_to_string(regexp_extract_all(url || ' ' || html, 'https?://[^\s]+'), '|') AS urls FROM pages")(
    lambda s, d: load(s, d, "pages").select("page_id", F.array_join(x.urls(F.concat_ws(" ", "url", "html")), "|").alias("urls"))
)
query("fold_accents", "SELECT mention_id, strip_accents(raw_text) AS folded FROM doc_mentions", "doc_mentions")(lambda s, d: a.doc_mentions(s, d).select("mention_id", x.fold_accents(F.col("raw_text")).alias("folded")))
query("template_key", f"+{DOCS} SELECT mention_id, " + SQUEEZE.format(r"regexp_replace(regexp_replace(regexp_replace(text, '<url>', ' <url> ', 'g'), '#[\p{L}\p{N}_]+', ' <tag> ', 'g'), '[0-9]+', ' <num> ', 'g')") + " AS template FROM docs", "doc_mentions")(
    lambda s, d: docs(s, d).select("mention_id", x.template_key(F.col("text")).alias("template"))
)
#: Letters of every script by turns, after the text's own.
SCRIPT_TAILS = ("かな", "漢字", "한국어", "привет", "سلام", "नमस्ते", "สวัสดี", "")
SCRIPTED = "s AS (SELECT mention_id, raw_text || CASE CAST(mention_id AS BIGINT) % 8 " + " ".join(f"WHEN {k} THEN '{t}'" for k, t in enumerate(SCRIPT_TAILS)) + " END AS raw_text FROM doc_mentions)"


def scripted(s, d):
    return a.doc_mentions(s, d).withColumn("raw_text", F.concat("raw_text", F.get(F.array(*map(F.lit, SCRIPT_TAILS)), (F.col("mention_id").cast("long") % 8).cast("int"))))


def count_sql(low: str, high: str) -> str:
    return rf"length(regexp_replace(raw_text, '[^\x{{{low}}}-\x{{{high}}}]', '', 'g'))"


query("script_histogram", f"+{SCRIPTED} SELECT mention_id, {', '.join(f'{count_sql(*pair)} AS {k}' for k, pair in language.SCRIPTS.items())} FROM s", "doc_mentions")(
    lambda s, d: scripted(s, d).select("mention_id", *(c.cast("long").alias(k) for k, c in language.script_counts(F.col("raw_text")).items()))
)
TOTAL = " + ".join(count_sql(*pair) for pair in language.SCRIPTS.values())
query(
    "script_shares",
    f"+{SCRIPTED} " + " UNION ALL ".join(f"SELECT mention_id, '{k}' AS script, floor({count_sql(*pair)}::DOUBLE / ({TOTAL})::DOUBLE * 10000.0 + 0.5) / 10000.0 AS share FROM s WHERE {count_sql(*pair)} > 0" for k, pair in language.SCRIPTS.items()),
    "doc_mentions",
)(lambda s, d: scripted(s, d).select("mention_id", F.explode(language.script_shares(F.col("raw_text"))).alias("script", "share")))
LETTERS = r"regexp_replace(raw_text, '[^\p{L}]', '', 'g')"
ODD = "".join(rf"\x{{{low}}}-\x{{{high}}}" for low, high in language.UNSUPPORTED)
query("unsupported_script_share", f"+{SCRIPTED} SELECT mention_id, CASE WHEN length({LETTERS}) > 0 THEN length(regexp_replace({LETTERS}, '[^{ODD}]', '', 'g'))::DOUBLE / length({LETTERS})::DOUBLE ELSE 0.0::DOUBLE END AS share FROM s", "doc_mentions")(
    lambda s, d: scripted(s, d).select("mention_id", language.unsupported_script_share(F.col("raw_text")).alias("share"))
)
CODED = r"list_filter(string_split(regexp_replace(lower(regexp_replace(raw_text, '[^\p{L}\p{N}_\s]', ' ', 'g')), '\s', ' ', 'g'), ' '), lambda z: z <> '')"


def hinted_sql(lang: str) -> str:
    hits = f"len(list_filter(t, lambda z: z IN ({', '.join(repr(w) for w in language.LATIN_HINTS[lang])})))"
    bonus = " + CASE WHEN regexp_matches(raw_text, '[^\\x00-\\x7f]') THEN 0.12::DOUBLE ELSE 0.0::DOUBLE END" if lang == "vi" else ""
    score = f"CASE WHEN {hits} > 0 THEN floor(least({hits}::DOUBLE / greatest(len(t), 1)::DOUBLE{bonus}, 0.96::DOUBLE) * 10000.0 + 0.5) / 10000.0 ELSE 0.0::DOUBLE END".replace("\\\\", "\\")
    return f"CASE WHEN regexp_matches(lower(raw_text), '[{language.VI_MARKERS}]') THEN greatest({score}, 0.52::DOUBLE) ELSE {score} END" if lang == "vi" else score


SCRIPT_SCORE = "CASE WHEN {n} > 0 THEN floor(least(0.55::DOUBLE + floor({n}::DOUBLE / ({total})::DOUBLE * 10000.0 + 0.5) / 10000.0 * 0.4::DOUBLE, 0.98::DOUBLE) * 10000.0 + 0.5) / 10000.0 ELSE 0.0::DOUBLE END"
query(
    "heuristic_language_scores",
    f"+{SCRIPTED}, h AS (SELECT mention_id, raw_text, {CODED} AS t FROM s) SELECT mention_id, {', '.join(f'{hinted_sql(k)} AS {k}_' for k in language.LATIN_HINTS)}, {', '.join(f'{SCRIPT_SCORE.format(n=count_sql(*pair), total=TOTAL)} AS {k}_' for k, pair in language.SCRIPTS.items())} FROM h",
    "doc_mentions",
)(lambda s, d: scripted(s, d).select("mention_id", *(c.alias(f"{k}_") for k, c in language.heuristic_scores(F.col("raw_text")).items())))
query(
    "canonical_labels",
    "SELECT p_partkey AS id, CASE p_size % 8 WHEN 0 THEN 'en' WHEN 1 THEN 'pt' WHEN 2 THEN 'ja' WHEN 3 THEN 'id' WHEN 4 THEN 'unknown' WHEN 5 THEN 'vi' WHEN 6 THEN 'mixed' ELSE 'unknown' END AS label FROM part",
)(lambda s, d: load(s, d, "part").select(F.col("p_partkey").alias("id"), language.canonical_label(F.get(F.array(*(F.lit(z) for z in (" EN_us", "pt-BR", "jp", "in", None, "__label__vi", "mixed", ""))), F.col("p_size").cast("int") % 8)).alias("label")))
HINTS = ", ".join(
    f"floor(least(len(list_filter(t, lambda z: z IN ({', '.join(repr(w) for w in words)})))::DOUBLE / greatest(len(t), 1)::DOUBLE, 0.96::DOUBLE) * 10000.0 + 0.5) / 10000.0 AS {lang}" for lang, words in language.HINTS.items()
)
query("language_hints", rf"SELECT mention_id, {HINTS} FROM (SELECT mention_id, list_filter(string_split(lower(regexp_replace(raw_text, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')), ' '), lambda z: z <> '') AS t FROM (SELECT mention_id, replace(raw_text, chr(10), ' ') AS raw_text FROM doc_mentions))", "doc_mentions")(
    lambda s, d: a.doc_mentions(s, d).withColumn("raw_text", F.translate("raw_text", "\n", " ")).select("mention_id", *(c.alias(k) for k, c in language.hint_scores(F.col("raw_text")).items()))
)
RANKED = f"""h AS (SELECT mention_id, {HINTS} FROM (SELECT mention_id, list_filter(string_split(lower(regexp_replace(raw_text, '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')), ' '), lambda z: z <> '') AS t FROM (SELECT mention_id, replace(raw_text, chr(10), ' ') AS raw_text FROM doc_mentions))),
    e AS ({" UNION ALL ".join(f"SELECT mention_id, '{k}' AS l, {k} AS s FROM h WHERE {k} > 0" for k in language.HINTS)}), r AS (SELECT *, row_number() OVER (PARTITION BY mention_id ORDER BY s DESC, l) AS p FROM e)"""
query(
    "language_best_hint",
    f"""+{RANKED} SELECT h.mention_id, CASE WHEN one.l IS NULL THEN 'unknown' WHEN two.s >= 0.55::DOUBLE * 0.45::DOUBLE AND one.s - two.s <= 0.12 THEN 'mixed' ELSE one.l END AS language,
    CASE WHEN one.l IS NULL THEN 0.0::DOUBLE WHEN two.s >= 0.55::DOUBLE * 0.45::DOUBLE AND one.s - two.s <= 0.12 THEN floor(greatest((one.s + two.s) / 2.0, 0.55::DOUBLE) * 10000.0 + 0.5) / 10000.0 ELSE one.s END AS confidence
    FROM h LEFT JOIN (SELECT * FROM r WHERE p = 1) one ON h.mention_id = one.mention_id LEFT JOIN (SELECT * FROM r WHERE p = 2) two ON h.mention_id = two.mention_id""",
    "doc_mentions",
)(lambda s, d: a.doc_mentions(s, d).withColumn("raw_text", F.translate("raw_text", "\n", " ")).select("mention_id", language.best_hint(F.col("raw_text")).alias("h")).select("mention_id", "h.*"))
GATE = language.Gate("fr", "en", frozenset(language.HINTS["fr"]), frozenset(language.HINTS["en"]), frozenset(language.HINTS["de"]), "de", "èêéàçù")


def gate_sql(g: language.Gate) -> str:
    """The nine decisions of the gate over word counts, for its vocabulary."""
    words = lambda values: "[" + ", ".join(f"'{w}'" for w in sorted(values)) + "]"
    n = lambda items, test: f"len(list_filter({items}, lambda z: {test}))"
    one, two, odd = (f"list_contains({words(w)}, z)" for w in (g.first_words, g.second_words, g.other_words))
    mark, digit = f"regexp_matches(z, '[{g.marks}]')", "regexp_matches(z, '[0-9]')"
    short = f"(length(z) <= 3 AND regexp_full_match(z, '[a-z]+') AND NOT {two} AND NOT {odd})"
    return rf"""t AS (SELECT mention_id, raw_text, language AS p, regexp_extract_all(lower(text), '([\p{{L}}0-9][\p{{L}}0-9+-]*)', 1) AS t FROM docs),
    m AS (SELECT *, list_filter(t, lambda z: NOT {digit} AND length(z) >= 2 AND regexp_full_match(z, '\p{{L}}+')) AS sem, greatest(len(t), 1)::DOUBLE AS n, regexp_matches(lower(raw_text), '[{g.marks}]') AS has_mark FROM t),
    c AS (SELECT *, len(sem) AS n_sem, {n('t', f'{digit} OR {short}')} AS entity, {n('sem', f'{one} OR {mark}')} AS first_sem, {n('sem', two)} AS second_sem, {n('sem', f"regexp_full_match(z, '[a-z]{{4,}}') AND NOT {odd}")} AS ascii_sem,
        {n('t', one)}::DOUBLE / n + CASE WHEN has_mark THEN 0.28::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN p = '{g.first}' THEN 0.18::DOUBLE ELSE 0.0::DOUBLE END AS a,
        {n('t', two)}::DOUBLE / n + CASE WHEN p = '{g.second}' THEN 0.16::DOUBLE ELSE 0.0::DOUBLE END AS b, {n('t', odd)}::DOUBLE / n + CASE WHEN p = '{g.other}' THEN 0.18::DOUBLE ELSE 0.0::DOUBLE END AS odd, p = '{g.second}' AS open FROM m),
    v AS (SELECT mention_id, CASE WHEN len(t) = 0 THEN 'no_semantic_content' WHEN odd >= 0.42 AND odd > a + b + 0.08 THEN 'unsupported_language' WHEN n_sem = 0 AND entity > 0 THEN 'non_vi_en_latin_noise' WHEN n_sem = 0 THEN 'no_semantic_content'
        WHEN (a >= 0.18 OR first_sem >= 2 OR has_mark) AND (b >= 0.12 OR second_sem >= 1) AND n_sem >= 2 AND odd < 0.24 THEN '=mixed' WHEN first_sem >= 1 AND ascii_sem >= 2 AND n_sem >= 4 AND open AND odd < 0.18 THEN '=mixed'
        WHEN a >= 0.2 OR first_sem >= 2 THEN '={g.first}' WHEN b >= 0.2 AND n_sem >= 2 AND odd < 0.18 THEN '={g.second}' WHEN entity / n >= 0.5 AND a + b < 0.18 THEN 'non_vi_en_latin_noise' WHEN a + b < 0.18 AND n_sem <= 2 THEN 'low_vi_en_evidence'
        ELSE 'unsupported_language' END AS v FROM c)
    SELECT mention_id, CASE WHEN v LIKE '=%' THEN v[2:] ELSE 'unsupported' END AS language, v LIKE '=%' AS supported, CASE WHEN v NOT LIKE '=%' THEN v END AS reason FROM v"""


query("language_gate", f"+{DOCS}, {gate_sql(GATE)}", "doc_mentions")(lambda s, d: docs(s, d).select("mention_id", GATE.decide(F.col("raw_text"), F.col("text"), F.col("language")).alias("g")).select("mention_id", "g.*"))
#: Documents, and short texts that every flag is made for.
SHORT_TEXTS = ("ok", "haha 😀😀 🎉", "https://a.b/c https://d.e/f look", "red red red red", "", "this is fine and good today", "hehe nice https://a.b/c", "😀 😀")
QUALITY = f"""q AS (SELECT mention_id, raw_text, {COMPACT} AS text, len(regexp_extract_all(raw_text, 'https?://[^\\s]+')) AS urls, 0 AS emojis, language <> 'es' AS supported FROM doc_mentions
    UNION ALL SELECT 'p' || p_partkey, raw_text, {COMPACT}, len(regexp_extract_all(raw_text, 'https?://[^\\s]+')), CASE p_partkey % 8 WHEN 1 THEN 2 WHEN 7 THEN 2 ELSE 0 END, p_size % 5 <> 0 FROM (SELECT *, CASE p_partkey % 8 {" ".join(f"WHEN {k} THEN '{t}'" for k, t in enumerate(SHORT_TEXTS))} END AS raw_text FROM part)),
    t AS (SELECT *, list_filter({TOKENS}, lambda z: z NOT IN ('url', 'mention')) AS t FROM q),
    f AS (SELECT mention_id, list_sort(list_filter([CASE WHEN NOT supported THEN 'unsupported_language' END, CASE WHEN len(t) <= 2 AND emojis >= 2 THEN 'emoji_dominant' END, CASE WHEN len(t) <= 2 AND urls = 0 THEN 'low_information' END,
        CASE WHEN len(t) = 0 AND length(raw_text) > 0 OR len(t) <= 3 AND lower(raw_text) IN ('ok', 'oke', 'haha', 'hehe', 'nice') THEN 'reaction_only' END, CASE WHEN urls >= 2 OR (urls > 0 AND len(t) <= 3) THEN 'url_heavy' END,
        CASE WHEN len(list_distinct(t)) <= 2 AND len(t) >= 4 THEN 'template_like' END, CASE WHEN len(t) = 0 THEN 'no_semantic_content' END], lambda z: z IS NOT NULL)) AS f FROM t)"""


def quality_texts(s, d):
    own = a.doc_mentions(s, d).select("mention_id", "raw_text", (F.col("language") != "es").alias("supported"))
    short = F.get(F.array(*map(F.lit, SHORT_TEXTS)), (F.col("p_partkey") % 8).cast("int"))
    rows = own.unionByName(load(s, d, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("mention_id"), short.alias("raw_text"), (F.col("p_size") % 5 != 0).alias("supported")))
    rows = rows.withColumns({"text": x.compact_text(F.col("raw_text")), "urls": F.size(x.urls(F.col("raw_text"))), "emojis": F.size(x.emojis(F.col("raw_text")))})
    return rows.withColumn("f", language.quality_flags(F.col("raw_text"), F.col("raw_text"), F.col("text"), F.col("urls"), F.col("emojis"), F.col("supported")))


query("text_quality_flags", f"+{QUALITY} SELECT mention_id, array_to_string(f, '|') AS flags FROM f", "doc_mentions")(lambda s, d: quality_texts(s, d).select("mention_id", F.array_join("f", "|").alias("flags")))
LABEL = "CASE " + " ".join(f"WHEN list_contains(f, '{flag}') THEN '{label}'" for flag, label in language.LABELS) + " ELSE 'normal' END"
SCORE = "1.0::DOUBLE" + "".join(f" - CASE WHEN list_contains(f, '{flag}') THEN {v}::DOUBLE ELSE 0.0::DOUBLE END" for flag, v in language.PENALTY.items())
query("text_quality_label", f"+{QUALITY} SELECT mention_id, {LABEL} AS label, floor(greatest({SCORE}, 0.05::DOUBLE) * 10000.0 + 0.5) / 10000.0 AS score FROM f", "doc_mentions")(
    lambda s, d: quality_texts(s, d).select("mention_id", language.quality_label(F.col("f")).alias("label"), language.quality_score(F.col("f")).alias("score"))
)
EXACT = f"""{DOCS}, prints AS (SELECT *, CASE WHEN length(text) >= 10 THEN sha256(text) END AS fingerprint FROM docs),
    clusters AS (SELECT fingerprint, count(*) AS cluster_size, arg_min(mention_id, (-length(text), depth, mention_id)) AS representative_id FROM prints WHERE fingerprint IS NOT NULL GROUP BY fingerprint HAVING count(*) > 1)"""
query("dedup_exact_clusters", f"+{EXACT} SELECT *, 'exact:' || left(fingerprint, 16) AS cluster_id FROM clusters", "doc_mentions")(lambda s, d: dedup.exact_clusters(docs(s, d)))
query(
    "dedup_weights",
    f"+{EXACT} SELECT mention_id, CASE WHEN c.fingerprint IS NOT NULL THEN 'exact' END AS dedup_kind, coalesce(cluster_size, 1) AS dedup_cluster_size, floor(1.0 / coalesce(cluster_size, 1)::DOUBLE * 1000000.0 + 0.5) / 1000000.0 AS dedup_weight FROM prints p LEFT JOIN clusters c USING (fingerprint)",
    "doc_mentions",
)(lambda s, d: dedup.annotate(docs(s, d), near=False).select("mention_id", "dedup_kind", "dedup_cluster_size", "dedup_weight"))
query("dedup_representative", f"+{EXACT} SELECT representative_id, cluster_size FROM clusters", "doc_mentions")(lambda s, d: dedup.exact_clusters(docs(s, d)).select("representative_id", "cluster_size"))
CHARS = "replace(text, ' ', '')"
SETS = f"""sets AS (SELECT mention_id, depth, text, list_distinct(CASE WHEN len(t) >= 3 THEN list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])
    WHEN length({CHARS}) >= 5 THEN list_transform(range(1, length({CHARS}) - 3), lambda i: substring({CHARS}, i, 5)) WHEN length(text) > 0 THEN [text] ELSE [] END) AS x FROM (SELECT *, {TOKENS} AS t FROM docs))"""
query("dedup_shingles", f"+{DOCS}, {SETS} SELECT mention_id, len(x) AS shingles FROM sets", "doc_mentions")(lambda s, d: docs(s, d).select("mention_id", F.size(x.shingles(F.col("text"))).cast("long").alias("shingles")))
#: All pairs that share a shingle; far more than banding looks at.
NEAR = f"""{SETS}, e AS (SELECT mention_id, unnest(x) AS x FROM sets WHERE length(text) >= 10), n AS (SELECT mention_id, count(*) AS n FROM e GROUP BY mention_id),
    shared AS (SELECT l.mention_id AS left, r.mention_id AS right, count(*) AS k FROM e l JOIN e r ON l.x = r.x AND l.mention_id < r.mention_id GROUP BY ALL),
    pairs AS (SELECT s.left, s.right, floor(k::DOUBLE / (a.n + b.n - k)::DOUBLE * 10000.0 + 0.5) / 10000.0 AS similarity FROM shared s JOIN n a ON s.left = a.mention_id JOIN n b ON s.right = b.mention_id)"""
query("dedup_near_lsh", f"+{DOCS}, {NEAR} SELECT * FROM pairs WHERE similarity >= 0.82", "doc_mentions")(lambda s, d: dedup.similar_pairs(docs(s, d)))
SINGLE = EXACT.replace("docs AS", "all_docs AS").replace("FROM docs)", "FROM all_docs)") + ", docs AS (SELECT * FROM prints WHERE fingerprint IS NULL OR fingerprint NOT IN (SELECT fingerprint FROM clusters))"
GROUPS = f"""{SINGLE}, {NEAR}, p AS (SELECT * FROM pairs WHERE similarity >= 0.82), edges AS (SELECT p.left AS u, p.right AS v FROM p UNION ALL SELECT p.right, p.left FROM p),
    walk AS (SELECT u AS node, u AS root FROM edges UNION SELECT e.v, w.root FROM walk w JOIN edges e ON w.node = e.u), members AS (SELECT node AS mention_id, min(root) AS root FROM walk GROUP BY node),
    near AS (SELECT 'near:' || left(sha256(root), 16) AS cluster_id, root, count(*) AS cluster_size, arg_min(mention_id, (-length(text), depth, mention_id)) AS representative_id FROM members JOIN docs USING (mention_id) GROUP BY root),
    mean AS (SELECT root, floor(avg(similarity) * 10000.0 + 0.5) / 10000.0 AS similarity FROM p JOIN members ON p.left = mention_id GROUP BY root)"""
query("dedup_components", f"+RECURSIVE {GROUPS} SELECT cluster_id, cluster_size, representative_id, similarity FROM near JOIN mean USING (root)", "doc_mentions")(lambda s, d: dedup.near_clusters(docs(s, d))[1])
query(
    "dedup_annotated",
    f"""+RECURSIVE {GROUPS}, g AS (SELECT m.mention_id, near.*, similarity FROM members m JOIN near USING (root) JOIN mean USING (root))
    SELECT a.mention_id, a.author_id, a.language, a.depth, CASE WHEN c.fingerprint IS NOT NULL THEN 'exact' WHEN g.cluster_id IS NOT NULL THEN 'near' END AS dedup_kind, coalesce('exact:' || left(c.fingerprint, 16), g.cluster_id) AS dedup_cluster_id,
    coalesce(c.cluster_size, g.cluster_size, 1) AS dedup_cluster_size, coalesce(c.representative_id, g.representative_id) AS dedup_representative_id, CASE WHEN c.fingerprint IS NOT NULL THEN 1.0::DOUBLE ELSE similarity END AS dedup_similarity,
    floor(1.0::DOUBLE / coalesce(c.cluster_size, g.cluster_size, 1)::DOUBLE * 1000000.0 + 0.5) / 1000000.0 AS dedup_weight FROM prints a LEFT JOIN clusters c USING (fingerprint) LEFT JOIN g ON a.mention_id = g.mention_id""",
    "doc_mentions",
)(lambda s, d: dedup.annotate(docs(s, d).drop("raw_text")).drop("text"))

BURST = """SELECT author_id, CASE WHEN count(*) < 2 THEN 0.0 ELSE floor(max(n)::DOUBLE / count(*)::DOUBLE * 10000.0 + 0.5) / 10000.0 END AS burstiness_score
    FROM (SELECT author_id, count(*) OVER (PARTITION BY author_id ORDER BY posted_at RANGE BETWEEN INTERVAL 60 MINUTES PRECEDING AND CURRENT ROW) AS n FROM facts) GROUP BY author_id"""
query("author_burstiness", BURST, "facts")(lambda s, d: spam.burstiness(a.facts(s, d)))


def spam_input(s, d):
    """Documents with their exact clusters, and days by id for the authors' windows."""
    rows = dedup.annotate(docs(s, d), near=False)
    minute = F.col("mention_id").cast("long") * 600
    return rows.withColumns({"normalized": F.col("text"), "url_count": F.size(x.urls(F.col("raw_text"))), "posted_at": F.timestamp_seconds(minute)})


SPAM = rf"""{EXACT}, base AS (SELECT mention_id, author_id, text, coalesce(cluster_size, 1) AS size, len(regexp_extract_all(raw_text, 'https?://[^\s]+')) AS urls, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+') AS t,
    {SQUEEZE.format(r"regexp_replace(regexp_replace(regexp_replace(text, '<url>', ' <url> ', 'g'), '#[\p{L}\p{N}_]+', ' <tag> ', 'g'), '[0-9]+', ' <num> ', 'g')")} AS template,
    starts_with(text, 'rt ') OR starts_with(text, 'repost ') OR starts_with(text, 'shared from ') AS repost FROM prints LEFT JOIN clusters USING (fingerprint)),
    counted AS (SELECT *, len(t) AS n, len(list_distinct(t)) AS d, coalesce(list_max(map_values(list_histogram(t))), 0) AS most FROM base),
    parts AS (SELECT *, least(urls::DOUBLE / greatest(n, 1) * 2.5::DOUBLE, 1.0) AS p1, CASE WHEN n >= 4 THEN greatest(0.45::DOUBLE - d::DOUBLE / n, 0.0) / 0.45::DOUBLE ELSE 0.0 END AS p2,
    CASE WHEN n > 0 THEN greatest(1.0::DOUBLE - d::DOUBLE / n, most::DOUBLE / n) ELSE 0.0 END AS p3, (size - 1)::DOUBLE / size AS p4, repost::INTEGER::DOUBLE AS p5 FROM counted),
    scored AS (SELECT *, floor(least(0.0::DOUBLE + p1 * 0.22::DOUBLE + p2 * 0.22::DOUBLE + p3 * 0.2::DOUBLE + p4 * 0.22::DOUBLE + p5 * 0.14::DOUBLE, 1.0) * 10000.0 + 0.5) / 10000.0 AS score FROM parts)"""
query("spam_features", f"+{SPAM} SELECT mention_id, n AS token_count, template, repost, score AS mention_spam_score FROM scored", "doc_mentions")(
    lambda s, d: spam.mention_features(spam_input(s, d)).select("mention_id", F.col("token_count").cast("long").alias("token_count"), "template", "repost", "mention_spam_score")
)
query("template_counts", f"+{SPAM} SELECT template, count(*) AS uses FROM scored GROUP BY template", "doc_mentions")(lambda s, d: spam.mention_features(spam_input(s, d)).groupBy("template").agg(F.count(F.lit(1)).alias("uses")))
query(
    "author_quality",
    f"""+{SPAM}, reused AS (SELECT template FROM scored WHERE template <> '' GROUP BY template HAVING count(*) >= 3),
    timed AS (SELECT author_id, count(*) OVER (PARTITION BY author_id ORDER BY CAST(mention_id AS BIGINT) * 600 RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS n FROM scored),
    burst AS (SELECT author_id, CASE WHEN count(*) < 2 THEN 0.0 ELSE floor(max(n)::DOUBLE / count(*)::DOUBLE * 10000.0 + 0.5) / 10000.0 END AS b FROM timed GROUP BY author_id),
    sums AS (SELECT author_id, count(*) AS mention_count, count_if(score >= 0.65) AS suspicious_mention_count, sum(CAST(floor(score * 10000.0 + 0.5) AS BIGINT))::DOUBLE / 10000.0 / count(*) AS average,
        count_if(size > 1)::DOUBLE / count(*) AS duplicate, count_if(template IN (SELECT template FROM reused))::DOUBLE / count(*) AS template, count_if(repost)::DOUBLE / count(*) AS repost FROM scored GROUP BY author_id),
    joined AS (SELECT *, (b >= 0.55)::INTEGER + (duplicate >= 0.45)::INTEGER + (template >= 0.45)::INTEGER + (repost >= 0.4)::INTEGER + (average >= 0.55)::INTEGER AS reasons,
        floor(least(0.0::DOUBLE + average * 0.42::DOUBLE + b * 0.18::DOUBLE + duplicate * 0.2::DOUBLE + template * 0.12::DOUBLE + repost * 0.08::DOUBLE, 1.0) * 10000.0 + 0.5) / 10000.0 AS s FROM sums JOIN burst USING (author_id))
    SELECT author_id, mention_count, suspicious_mention_count, floor(least(s + least(reasons * 0.03::DOUBLE, 0.09::DOUBLE), 1.0) * 10000.0 + 0.5) / 10000.0 AS author_inorganic_score, b AS burstiness_score,
    floor(template * 10000.0 + 0.5) / 10000.0 AS template_ratio, floor(duplicate * 10000.0 + 0.5) / 10000.0 AS duplicate_cluster_participation_rate, floor(average * 10000.0 + 0.5) / 10000.0 AS average_mention_spam_score FROM joined""",
    "doc_mentions",
)(lambda s, d: spam.author_profiles(spam.mention_features(spam_input(s, d))).drop("author_suspicious", "reason_codes", "repost_like_ratio"))
WEIGHTED = "floor({d} * greatest(1.0::DOUBLE - {m} * 0.65::DOUBLE, 0.15::DOUBLE) * greatest(1.0::DOUBLE - {a} * 0.45::DOUBLE, 0.15::DOUBLE) * 1000000.0 + 0.5) / 1000000.0"
query(
    "quality_weights",
    ORACLE_SQL["author_quality"].rsplit("SELECT author_id, mention_count", 1)[0].replace("WITH doc_mentions", "WITH doc_mentions", 1)
    + f""", authors AS (SELECT author_id, floor(least(s + least(reasons * 0.03::DOUBLE, 0.09::DOUBLE), 1.0) * 10000.0 + 0.5) / 10000.0 AS a FROM joined),
    w AS (SELECT mention_id, score, a, {WEIGHTED.format(d='(floor(1.0::DOUBLE / size::DOUBLE * 1000000.0 + 0.5) / 1000000.0)', m='score', a='a')} AS w, size > 1 AS dup, score >= 0.65 OR a >= 0.65 AS spam FROM scored JOIN authors USING (author_id))
    SELECT mention_id, score AS mention_spam_score, a AS author_inorganic_score, w AS quality_weight, CASE WHEN spam THEN 'spam_like' WHEN dup THEN 'duplicate_like' ELSE 'normal' END AS text_quality_label, floor(least(1.0::DOUBLE, w) * 10000.0 + 0.5) / 10000.0 AS text_quality_score,
    CASE WHEN spam OR dup THEN 'semantic_lite' ELSE 'semantic_full' END AS semantic_route_hint FROM w""",
)(lambda s, d: spam.annotate(spam.mention_features(spam_input(s, d))).select("mention_id", "mention_spam_score", "author_inorganic_score", "quality_weight", "text_quality_label", "text_quality_score", "semantic_route_hint"))

TOPK = f"""+{DOCS}, e AS (SELECT mention_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM (SELECT mention_id, {TOKENS} AS t FROM docs)),
    c AS (SELECT mention_id, token, count(*) AS count, min(pos) AS pos FROM e WHERE length(token) > 2 AND token NOT IN ({', '.join(repr(w) for w in rules.STOPWORDS)}, 'url') GROUP BY ALL)
    SELECT mention_id, place::INTEGER AS place, token, count FROM (SELECT *, row_number() OVER (PARTITION BY mention_id ORDER BY count DESC, pos) AS place FROM c) WHERE place <= 3"""
query("keyword_topk", TOPK, "doc_mentions")(lambda s, d: rules.keywords(docs(s, d)))
query(
    "keyphrases",
    TOPK.rsplit("SELECT mention_id, place::INTEGER", 1)[0].rstrip() + """, k AS (SELECT mention_id, list(token ORDER BY count DESC, pos) AS toks FROM (SELECT *, row_number() OVER (PARTITION BY mention_id ORDER BY count DESC, pos) AS place FROM c) WHERE place <= 3 GROUP BY mention_id),
    v AS (SELECT d.mention_id, list_concat(list_concat(coalesce(toks, []), list_slice(list_distinct_in_order, 1, 3)), [language]) AS v, language FROM docs d LEFT JOIN k USING (mention_id), LATERAL (SELECT ['first', 'second', 'third'] AS list_distinct_in_order)),
    p AS (SELECT mention_id, language, list_filter(v, lambda z, i: list_position(v, z) = i) AS p FROM v)
    SELECT mention_id, unnest(p[1:5]) AS keyphrase, CASE WHEN unnest(p[1:5]) = language THEN 0.55::DOUBLE ELSE 0.42::DOUBLE END AS confidence FROM p""",
    "doc_mentions",
)(lambda s, d: rules.keyphrases(docs(s, d).withColumn("hashtags", F.array(*map(F.lit, ("first", "second", "third", "fourth")))).withColumn("keywords", F.array("language"))))
query("document_frequency", f"+{DOCS} SELECT token, count(*) AS documents FROM (SELECT unnest(list_distinct({TOKENS})) AS token FROM docs) GROUP BY token", "doc_mentions")(lambda s, d: rules.document_frequency(docs(s, d)))
query(
    "salient_terms",
    f"""+{DOCS}, c AS (SELECT language, token, count(*) AS n FROM (SELECT language, unnest({TOKENS}) AS token FROM docs) GROUP BY ALL),
    s AS (SELECT *, 0.7::DOUBLE * (n::DOUBLE / (sum(n) OVER (PARTITION BY token))::DOUBLE) + 0.3::DOUBLE * (n::DOUBLE / (max(n) OVER (PARTITION BY language))::DOUBLE) AS score FROM c)
    SELECT language, place::INTEGER AS place, token, score FROM (SELECT *, row_number() OVER (PARTITION BY language ORDER BY score DESC, n DESC, token) AS place FROM s) WHERE place <= 5""",
    "doc_mentions",
)(lambda s, d: rules.salient_terms(docs(s, d), "language"))


def cue_sql(cues, text: str = "text") -> str:
    return " OR ".join(f"contains({text}, '{c}')" for c in cues) or "false"


def rule_sql(rules_, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {'contains(raw_text, chr(63)) OR ' if k == 0 else ''}{cue_sql(cues)} THEN '{label}'" for k, (label, _, cues) in enumerate(rules_)) + f" ELSE '{default}' END"


#: Every shipped cue by turns, behind the text's own words.
CUES = sorted({c for _, _, cues in (*rules.STANCE, *rules.INTENT) for c in cues} | {c for t in (rules.ASPECTS, rules.ISSUES) for cues in t.values() for c in cues} | {*rules.POSITIVE, *rules.NEGATIVE, *rules.ASPECT_POSITIVE, *rules.ASPECT_NEGATIVE} | {"?", "none"})
CUED = f"cued AS (SELECT mention_id, depth, raw_text || ' ' || c AS raw_text, text || ' ' || c AS text FROM (SELECT *, ([{', '.join(repr(c) for c in CUES)}])[CAST(mention_id AS BIGINT) % {len(CUES)} + 1] AS c FROM docs))"


def cued(s, d):
    cue = F.get(F.array(*map(F.lit, CUES)), (F.col("mention_id").cast("long") % len(CUES)).cast("int"))
    return docs(s, d).withColumn("raw_text", F.concat_ws(" ", "raw_text", cue)).withColumn("text", F.concat_ws(" ", "text", cue))


query("stance_rules", f"+{DOCS}, {CUED} SELECT mention_id, {rule_sql(rules.STANCE, 'neutral')} AS label FROM cued", "doc_mentions")(lambda s, d: cued(s, d).select("mention_id", rules.stance(F.col("raw_text"), F.col("text"))["label"].alias("label")))
query("intent_rules", f"+{DOCS}, {CUED} SELECT mention_id, {rule_sql(rules.INTENT, 'commentary')} AS label FROM cued", "doc_mentions")(lambda s, d: cued(s, d).select("mention_id", rules.intent(F.col("raw_text"), F.col("text"))["label"].alias("label")))
P, N = (" + ".join(f"contains(text, '{c}')::INTEGER" for c in cues) for cues in (rules.POSITIVE, rules.NEGATIVE))
query(
    "lexicon_sentiment",
    f"+{DOCS}, {CUED}, h AS (SELECT mention_id, {P} AS p, {N} AS n FROM cued) SELECT mention_id, CASE WHEN p > 0 AND n > 0 THEN 'mixed' WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END AS label, p AS positive, n AS negative, 0.45::DOUBLE + least((p + n)::DOUBLE * 0.1::DOUBLE, 0.45::DOUBLE) AS confidence FROM h",
    "doc_mentions",
)(lambda s, d: cued(s, d).select("mention_id", rules.lexicon_sentiment(F.col("text")).alias("r")).select("mention_id", "r.*"))
MOOD = f"CASE WHEN {cue_sql(rules.ASPECT_NEGATIVE)} THEN 'negative' WHEN {cue_sql(rules.ASPECT_POSITIVE)} THEN 'positive' ELSE 'neutral' END"
query("aspect_rules", f"+{DOCS}, {CUED} " + " UNION ALL ".join(f"SELECT mention_id, '{k}' AS aspect, {MOOD} AS sentiment, 0.62::DOUBLE AS confidence FROM cued WHERE {cue_sql(cues)}" for k, cues in rules.ASPECTS.items()), "doc_mentions")(
    lambda s, d: rules.aspect_facts(cued(s, d))
)
query(
    "issue_rules",
    f"+{DOCS}, {CUED} " + " UNION ALL ".join(f"SELECT mention_id, '{k}' AS issue_category, CASE WHEN CAST(mention_id AS BIGINT) % 3 = 0 THEN 'high' WHEN CAST(mention_id AS BIGINT) % 50 > 20 THEN 'medium' ELSE 'low' END AS severity, 0.66::DOUBLE AS confidence FROM cued WHERE {cue_sql(cues)}" for k, cues in rules.ISSUES.items()),
    "doc_mentions",
)(lambda s, d: rules.issue_facts(cued(s, d).withColumn("depth", (F.col("mention_id").cast("long") % 3)).withColumn("likes", F.col("mention_id").cast("long") % 50)))
query(
    "influence_tier",
    """SELECT author_id, e AS engagement_score, CASE WHEN e >= 500 THEN 'macro' WHEN e >= 100 THEN 'mid' WHEN e >= 20 THEN 'micro' ELSE 'nano' END AS influence_tier
    FROM (SELECT author_id, count(*)::DOUBLE + count_if(sentiment = 'positive')::DOUBLE + 0 + count_if(severity = 'high')::DOUBLE + (count(*) * 7)::DOUBLE / 100.0 AS e FROM facts GROUP BY author_id)""",
    "facts",
)(
    lambda s, d: a.facts(s, d)
    .groupBy("author_id")
    .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("sentiment") == "positive").alias("p"), F.count_if(F.col("severity") == "high").alias("h"))
    .withColumn("engagement_score", rules.engagement(F.col("n"), F.col("p"), F.lit(None), F.col("h"), F.col("n") * 7))
    .select("author_id", "engagement_score", rules.influence_tier(F.col("engagement_score")).alias("influence_tier"))
)


def vec(s, d):
    return load(s, d, "embeddings").select("vec_id", "embedding")


DOT = "list_dot_product(q.embedding::DOUBLE[], i.embedding::DOUBLE[])"
query(
    "knn_cosine_topk",
    f"""SELECT query_id, place::INTEGER AS place, item_id, floor(score * 1000000.0 + 0.5) / 1000000.0 AS score FROM (SELECT q.vec_id AS query_id, i.vec_id AS item_id, {DOT} AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY {DOT} DESC, i.vec_id) AS place
    FROM embeddings q JOIN embeddings i ON q.vec_id <> i.vec_id WHERE q.vec_id % 50 = 0) WHERE place <= 5""",
)(lambda s, d: vectors.nearest(vec(s, d).where("vec_id % 50 = 0"), vec(s, d), 5).withColumn("score", F.floor(F.col("score") * 1e6 + 0.5) / 1e6))
query(
    "cluster_cohesion",
    f"SELECT q.label AS label, any_value((SELECT count(*) FROM embeddings e WHERE e.label = q.label)) AS size, floor(avg({DOT}) * 1000000.0 + 0.5) / 1000000.0 AS cohesion FROM embeddings q JOIN embeddings i ON q.label = i.label AND q.vec_id < i.vec_id GROUP BY q.label",
)(lambda s, d: vectors.cohesion(load(s, d, "embeddings"), "label", "embedding").withColumn("cohesion", F.floor(F.col("cohesion") * 1e6 + 0.5) / 1e6))


def vector_digest():
    return F.sha2(F.array_join(F.transform("vector", lambda v: v.cast("string")), ","), 256).alias("vector_sha256")


query("embed_documents")(lambda s, d: vectors.embed(load(s, d, "documents").select(F.col("doc_id").alias("id"), "text"))[0].select("id", F.size("vector").alias("dimensions"), vector_digest()))

