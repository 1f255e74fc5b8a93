"""Entity resolution: signals between candidates and aliases, ranking with a verifier, and the reasons for leaving open.

Candidates (mention_id, text, entity_type_hint, confidence, methods, context_text, full_text) meet aliases by an equi-join
on their significant tokens and on their compact forms; everything after that is arithmetic on columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import round_to
from ..functions.phrases import STOP_WORDS
from ..functions.text import W, fuzzy_ratio, fuzzy_token_set, normalize_alias, tokens
from ..tables import settle
from . import entities

# How discoveries and surfaces are told apart, and the thresholds and weights of the decision.
LOW_PRECISION = ("context_span", "repeated_phrase", "title_span", "token_ngram")
HIGH_SIGNAL = ("alias_scan", "brand_context", "handle_pattern", "hashtag", "ner", "product_code")
GENERIC_SURFACES = (
    "branch", "brand", "company", "cua hang", "factory", "facility", "hang", "job", "location", "market", "item", "model", "opening", "plant", "product", "service", "site", "shop", "store",
)
UNIQUE_PREFIX_TYPES = ("brand", "organization", "retailer", "campaign", "influencer")
SPECIFICITY_FLOOR = {"brand": 0.08, "organization": 0.12, "retailer": 0.12, "product": 0.08, "product_line": 0.1, "facility": 0.18, "location": 0.18, "person": 0.2, "concept": 0.32}
EMBEDDING_FLOOR = {"brand": 0.1, "organization": 0.14, "retailer": 0.14, "product": 0.1, "product_line": 0.14, "facility": 0.22, "location": 0.22, "person": 0.26, "concept": 0.38}
SOURCE_BONUS = {"alias_scan": 0.16, "product_code": 0.18, "brand_context": 0.12, "ner": 0.12, "hashtag": 0.08, "title_span": 0.06}
OPEN_TYPES = ("product", "brand", "retailer", "organization", "facility", "location", "concept")
TYPE_CUES = {
    "brand": ("brand", "hãng", "thuong hieu", "thương hiệu", "nhãn hàng"),
    "product": ("product", "model", "variant", "gel", "cleanser", "serum", "foam"),
    "organization": ("organization", "company", "tap doan", "tập đoàn", "cong ty", "công ty"),
    "retailer": ("retailer", "official mall", "dealer", "showroom", "store", "cua hang", "cửa hàng"),
    "facility": ("facility", "factory", "plant", "nha may", "nhà máy", "xuong", "xưởng"),
    "location": ("location", "city", "province", "thi truong", "thị trường", "quoc gia", "quốc gia"),
    "concept": ("concept", "routine", "category", "phan khuc", "phân khúc"),
}
THRESHOLD = 0.75
CONTEXT_OVERLAP = 0.6
MARGIN = 0.06
FUZZY = 0.91
#: Longest tokens of a candidate that look aliases up, and entities that a decision keeps.
LOOKED_UP, RANKED = 3, 5

SIGNALS = ("exact_alias", "normalized_alias", "compact_alias", "boundary_support", "contextual_support", "unique_prefix_support", "fuzzy_support")


def significant(c: Column) -> Column:
    """Different tokens of three characters or with a digit that are no stop words."""
    words = F.regexp_extract_all(c, F.lit(rf"([{W}]+)"), 1)
    return F.array_distinct(F.filter(words, lambda w: ~w.isin(*STOP_WORDS) & ((F.length(w) >= 3) | w.rlike(r"\p{Nd}"))))


def _found(methods: Column, names: tuple[str, ...]) -> Column:
    return F.exists(methods, lambda m: m.isin(*names))


def _only_low(methods: Column) -> Column:
    return (F.size(methods) > 0) & F.forall(methods, lambda m: m.isin(*LOW_PRECISION))


def _table(key: Column, values: dict[str, float], default: float) -> Column:
    out = F.lit(default)
    for name, value in values.items():
        out = F.when(key == name, value).otherwise(out)
    return out


def _clamped(x: Column, high: float = 0.995, places: int = 6) -> Column:
    return round_to(F.greatest(F.least(x, F.lit(high)), F.lit(0.0)), places)


def distinctive(text: Column) -> Column:
    """Four characters or more, with a capital or a digit."""
    return (F.length(F.trim(text)) >= 4) & text.rlike(r"[\p{Lu}\p{Nd}]")


def specificity(text: Column, normalized: Column, hint: Column, methods: Column) -> Column:
    """How much a surface says by itself, 0 to 1."""
    t = tokens(normalized)
    add = lambda condition, value: F.when(F.coalesce(condition, F.lit(False)), value).otherwise(0.0)
    score = (
        add(normalized.rlike(r"\p{Nd}"), 0.35) + add(F.size(t) >= 2, 0.25) + add(F.exists(t, lambda w: F.length(w) >= 6), 0.15) + add(hint.isin("product", "brand", "retailer", "organization"), 0.15)
        + add(_found(methods, HIGH_SIGNAL), 0.2) - add(F.exists(t, lambda w: w.isin(*GENERIC_SURFACES)), 0.2)
    )
    return F.when((F.size(t) == 0) | normalize_alias(text).isin(*GENERIC_SURFACES), 0.0).otherwise(_clamped(score, 1.0, 4))


def open_types(phrases: DataFrame, aliases: DataFrame) -> DataFrame:
    """``phrases`` (phrase_id, text, normalized, full_text) with entity_type: of the aliases that are the phrase when they agree,
    else one that two alias tokens vote for, else product for a phrase with a digit, else one whose cue words stand in the
    phrase or its text, else null."""
    whole = aliases.groupBy(F.col("normalized").alias("alias")).agg(F.count_distinct("entity_type").alias("kinds"), F.min("entity_type").alias("alias_type"))
    votes = settle(aliases.select("entity_type", F.explode(significant(F.col("normalized"))).alias("token")).groupBy("token", "entity_type").agg(F.count(F.lit(1)).alias("n")), "alias_tokens")
    cast = phrases.select("phrase_id", F.explode(significant(F.col("normalized"))).alias("token")).join(votes, "token").groupBy("phrase_id", "entity_type").agg(F.sum("n").alias("n"))
    place = F.array_position(F.array(*map(F.lit, OPEN_TYPES)), F.col("entity_type"))
    voted = cast.where((F.col("n") >= 2) & (place > 0)).groupBy("phrase_id").agg(F.min_by("entity_type", place).alias("voted"))
    said = F.concat(F.col("normalized"), F.lit(" || "), normalize_alias(F.col("full_text")))
    cued = F.coalesce(*(F.when(F.exists(F.array(*map(F.lit, TYPE_CUES[t])), lambda cue: F.contains(said, cue)), t) for t in OPEN_TYPES))
    rows = phrases.join(whole, phrases["normalized"] == whole["alias"], "left").join(voted, "phrase_id", "left")
    kind = F.when(F.col("kinds") == 1, F.col("alias_type")).when(F.col("voted").isNotNull(), F.col("voted")).when(F.col("normalized").rlike(r"\p{Nd}"), "product").otherwise(cued)
    return rows.select(*phrases.columns, kind.alias("entity_type"))


def _pairs(candidates: DataFrame, aliases: DataFrame) -> DataFrame:
    """Every candidate with the aliases that share one of its longest significant tokens or its compact form."""
    index = aliases.withColumn("alias_id", F.xxhash64("alias", "canonical_entity_id"))
    looked = F.slice(F.array_sort(F.transform(significant(F.col("normalized")), lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))), 1, LOOKED_UP)
    keys = F.array_distinct(F.concat(F.transform(looked, lambda x: F.concat(F.lit("t:"), x["t"])), F.array(F.concat(F.lit("c:"), "compact"))))
    there = index.select("alias_id", F.explode(F.concat(F.transform(significant(F.col("normalized")), lambda t: F.concat(F.lit("t:"), t)), F.array(F.concat(F.lit("c:"), "compact")))).alias("key"))
    met = candidates.select("candidate_id", F.explode(keys).alias("key")).join(there, "key").select("candidate_id", "alias_id").distinct()
    named = index.select("alias_id", "alias", F.col("normalized").alias("alias_normalized"), F.col("compact").alias("alias_compact"), "canonical_entity_id", "entity_type", "entity_kind")
    return met.join(candidates, "candidate_id").join(named, "alias_id")


def signals(candidates: DataFrame, aliases: DataFrame) -> DataFrame:
    """(candidate_id, canonical_entity_id, entity_type, entity_kind, the seven signals, alias_surface_support): the strongest
    of each over an entity's aliases.  ``candidates`` are those of ``prepared``."""
    rows = _pairs(candidates, aliases)
    n, a = F.col("normalized"), F.col("alias_normalized")
    inside = lambda whole, part: F.contains(F.concat(F.lit(" "), whole, F.lit(" ")), F.concat(F.lit(" "), part, F.lit(" ")))
    own, other = significant(n), significant(a)
    overlap = F.when((F.size(own) > 0) & (F.size(other) > 0), F.size(F.array_intersect(own, other)) / F.greatest(F.size(own), F.lit(1))).otherwise(0.0)
    same_type = F.coalesce(F.col("entity_type_hint") == F.col("entity_type"), F.lit(False))
    # Of repeated pairs of names the ratio is the same, so it is taken once for each.
    names = settle(rows.select("normalized", "alias_normalized").distinct(), "name_pairs")
    ratio = names.withColumn("fuzzy", F.greatest(fuzzy_ratio(n, a), fuzzy_token_set(n, a)) / 100.0)
    rows = rows.join(settle(ratio, "name_ratios"), ["normalized", "alias_normalized"])
    prefix = (
        (F.size(own) == 1) & (F.length(F.get(own, F.lit(0))) >= 4) & ~F.get(own, F.lit(0)).isin(*GENERIC_SURFACES) & F.col("entity_type").isin(*UNIQUE_PREFIX_TYPES) & (F.col("entity_type_hint").isNull() | same_type)
        & ((F.substring_index(a, " ", 1) == F.get(own, F.lit(0))) | F.col("alias_compact").startswith(F.get(own, F.lit(0)))) & ((F.col("specificity") >= 0.1) | distinctive(F.col("text")))
    )
    context = normalize_alias(F.coalesce("context_text", F.lit("")))
    close = (F.length(n) >= 4) & (F.abs(F.length(a) - F.length(n)) <= 12) & (F.col("fuzzy") >= FUZZY)
    found = {
        "exact_alias": F.when(F.lower("text") == F.lower("alias"), 1.0),
        "normalized_alias": F.when(n == a, 0.97),
        "compact_alias": F.when((F.col("compact") == F.col("alias_compact")) & (F.length("compact") >= 3), 0.94),
        "boundary_support": F.when((a != n) & inside(n, a), F.least(F.length(a) / F.greatest(F.length(n), F.lit(1)) + F.when(same_type, 0.05).otherwise(0.0), F.lit(0.96))),
        "contextual_support": F.when((overlap >= CONTEXT_OVERLAP) & inside(context, a), F.least(0.58 + overlap * 0.22, F.lit(0.9))),
        "unique_prefix_support": F.when(prefix, F.least(0.72 + F.when(same_type, 0.04).otherwise(0.0), F.lit(0.86))),
        "fuzzy_support": F.when(close, F.least(F.col("fuzzy"), F.lit(0.9))),
    }
    support = F.greatest(overlap, F.least(F.col("fuzzy") + F.when(inside(n, a) | inside(a, n), 0.15).otherwise(0.0), F.lit(1.0)))
    best = [F.coalesce(F.max(value), F.lit(0.0)).alias(name) for name, value in found.items()]
    out = rows.groupBy("candidate_id", "canonical_entity_id", "entity_type", "entity_kind").agg(*best, round_to(F.max(support), 6).alias("alias_surface_support"))
    return out.where(F.greatest(*SIGNALS) > 0)


def prepared(candidates: DataFrame) -> DataFrame:
    """``candidates`` with candidate_id, normalized, compact and specificity."""
    rows = candidates.withColumn("normalized", normalize_alias(F.col("text")))
    rows = rows.withColumn("compact", F.replace("normalized", F.lit(" "), F.lit("")))
    rows = rows.withColumn("specificity", specificity(F.col("text"), F.col("normalized"), F.col("entity_type_hint"), F.col("methods")))
    return rows.withColumn("candidate_id", F.sha2(F.concat_ws("\x1f", "mention_id", "text", F.coalesce("entity_type_hint", F.lit(""))), 256))


def ranked(candidates: DataFrame, found: DataFrame, verify: bool = True) -> DataFrame:
    """``found`` (see signals) with heuristic_score, verifier_score, score, type_consistent and place: the best ``RANKED``
    entities of each candidate.  With ``verify`` the score blends both, .58 and .42."""
    mine = candidates.select("candidate_id", "entity_type_hint", "confidence", "methods", "specificity", F.lit(0).alias("__"))
    rows = found.join(mine, "candidate_id")
    consistent = F.col("entity_type_hint").isNull() | (F.col("entity_type_hint") == F.col("entity_type"))
    type_bonus = F.when(F.col("entity_type_hint").isNull(), 0.0).when(consistent, 0.14).otherwise(-0.16)
    bonus = F.greatest(F.lit(0.0), *(F.when(F.array_contains("methods", m), v).otherwise(0.0) for m, v in SOURCE_BONUS.items()))
    entity = F.col("entity_kind") == "entity"
    generic = F.when((F.col("specificity") < 0.15) & entity, 0.08).otherwise(0.0)
    concept = F.when((F.col("entity_kind") == "concept") & (F.col("specificity") >= 0.34) & (F.col("compact_alias") <= 0), 0.18).otherwise(0.0)
    line = lambda name, start, slope: F.when(F.col(name) > 0, start + F.col(name) * slope).otherwise(0.0)
    sure = F.greatest(
        line("exact_alias", 0.94, 0.04), line("normalized_alias", 0.88, 0.08), line("compact_alias", 0.84, 0.12), line("boundary_support", 0.52, 0.38), line("contextual_support", 0.5, 0.34),
        line("unique_prefix_support", 0.5, 0.3), line("fuzzy_support", 0.42, 0.24),
    )
    confidence = F.least(F.col("confidence"), F.lit(1.0))
    heuristic = sure + F.col("alias_surface_support") * 0.08 + confidence * 0.04 + bonus + type_bonus - generic - concept
    surface = F.greatest(*SIGNALS, "alias_surface_support")
    anchor = F.least(bonus + F.when(entity, 0.03).otherwise(0.0), F.lit(0.32))
    verifier = (
        surface * 0.34 + confidence * 0.05 + F.col("specificity") * 0.08 + anchor + F.greatest(type_bonus, F.lit(0.0)) * 0.08 + F.when(entity, 0.04).otherwise(0.0)
        - F.greatest(-type_bonus, F.lit(0.0)) * 0.22 - concept * 0.72 - generic * 0.8
    )
    rows = rows.withColumns({"heuristic_score": round_to(heuristic, 6), "verifier_score": _clamped(verifier), "type_consistent": consistent})
    final = F.col("verifier_score") * 0.58 + heuristic * 0.42 if verify else heuristic
    rows = rows.withColumn("score", _clamped(final))
    place = F.row_number().over(Window.partitionBy("candidate_id").orderBy(F.desc("score"), "canonical_entity_id"))
    return rows.withColumn("place", place).where(F.col("place") <= RANKED).drop("entity_type_hint", "confidence", "methods", "specificity", "__")


# Shares of the signals, and of the likeness of a candidate's views, in the score of a prototype.
PROTOTYPE_WEIGHT = {"exact_alias": 0.29, "normalized_alias": 0.16, "compact_alias": 0.22, "boundary_support": 0.12, "contextual_support": 0.1, "unique_prefix_support": 0.06, "fuzzy_support": 0.04, "alias_surface_support": 0.14}
VIEW_WEIGHT = {"span": 0.11, "local": 0.1, "full": 0.07, "thread": 0.04}
CONSENSUS = {"span": 0.34, "local": 0.28, "full": 0.2, "thread": 0.12}


def ranked_by_prototypes(candidates: DataFrame, found: DataFrame, likeness: DataFrame) -> DataFrame:
    """The best ``RANKED`` entities of each candidate by its signals (see signals; none count as 0) and by the likeness of its views to the
    entity's prototype: (candidate_id, canonical_entity_id, entity_type, entity_kind, span, local, full, thread, context_support).

    The score blends a verifier, which weighs agreement of the views, and the sum of all parts, .62 and .38."""
    none = F.lit(0.0)
    # Both sides grow with the candidates: a merge, as estimates from small files would have them broadcast through the driver.
    mine = candidates.select("candidate_id", "entity_type_hint", "confidence", "methods", "specificity").hint("merge")
    rows = likeness.join(found.drop("entity_type", "entity_kind").hint("merge"), ["candidate_id", "canonical_entity_id"], "left").join(mine, "candidate_id")
    rows = rows.withColumns({c: F.coalesce(c, none) for c in PROTOTYPE_WEIGHT} | {c: F.greatest(F.coalesce(c, none), none) for c in VIEW_WEIGHT})
    hint, entity = F.col("entity_type_hint"), F.col("entity_kind") == "entity"
    type_bonus = F.when(hint.isNull(), 0.0).when(hint == F.col("entity_type"), 0.14).otherwise(-0.16)
    bonus = F.greatest(none, *(F.when(F.array_contains("methods", m), v).otherwise(0.0) for m, v in SOURCE_BONUS.items()))
    kind = F.when(entity, 0.03).otherwise(0.0)
    concept = F.when((F.col("entity_kind") == "concept") & (F.col("specificity") >= 0.34) & (F.col("exact_alias") <= 0) & (F.col("compact_alias") <= 0), 0.18).otherwise(0.0)
    generic = F.when((F.col("specificity") < 0.15) & entity, 0.08).otherwise(0.0)
    confidence = F.least(F.col("confidence"), F.lit(1.0))
    weighed = lambda table: sum((F.col(c) * w for c, w in table.items()), none)
    heuristic = weighed(PROTOTYPE_WEIGHT) + weighed(VIEW_WEIGHT) + confidence * 0.05 + bonus + F.col("context_support") + kind + type_bonus - concept - generic
    anchor = F.least(bonus + F.col("context_support") + kind, F.lit(0.32))
    verifier = (
        weighed(CONSENSUS) * 0.34 + F.greatest(*PROTOTYPE_WEIGHT) * 0.34 + confidence * 0.05 + F.col("specificity") * 0.08 + anchor + F.greatest(type_bonus, none) * 0.08 + F.when(entity, 0.04).otherwise(0.0)
        - F.greatest(-type_bonus, none) * 0.22 - concept * 0.72 - generic * 0.8
    )
    rows = rows.withColumns({"heuristic_score": round_to(heuristic, 6), "verifier_score": _clamped(verifier)}).withColumn("score", _clamped(F.col("verifier_score") * 0.62 + heuristic * 0.38))
    place = F.row_number().over(Window.partitionBy("candidate_id").orderBy(F.desc("score"), "canonical_entity_id"))
    return rows.withColumn("place", place).where(F.col("place") <= RANKED).select("candidate_id", "place", "canonical_entity_id", "score", "heuristic_score", "verifier_score")


#: What a name looks like: up to four words in a row that begin with a capital, or a word with a digit in it.
PROPOSED = r"(?:\p{Lu}[\p{L}\p{N}-]*(?: \p{Lu}[\p{L}\p{N}-]*){0,3}|\p{L}+[0-9][\p{L}\p{N}-]*)"
LEAST_LIKENESS, SURE_ALIAS, DIGIT_BONUS = 0.62, 0.66, 0.08


def proposals(mentions: DataFrame) -> DataFrame:
    """(mention_id, text, start, stop): spans of ``raw_text`` that look like names; code points, stop exclusive, overlapping none."""
    mark = "\ue000"
    text = F.translate(F.coalesce("raw_text", F.lit("")), mark, "")
    pieces = F.split(F.regexp_replace(text, rf"(?<![\p{{L}}\p{{N}}])({PROPOSED})(?![\p{{L}}\p{{N}}])", f"{mark}$1{mark}"), mark)
    # Pieces stand outside and inside marks by turns; what comes before each gives its place.
    empty = F.array().cast("array<struct<text: string, start: int, stop: int>>")

    def step(acc: Column, piece: Column) -> Column:
        stop = acc["at"] + F.length(piece)
        hit = F.struct(piece.alias("text"), acc["at"].alias("start"), stop.alias("stop"))
        return F.struct((acc["n"] + 1).alias("n"), stop.alias("at"), F.when(acc["n"] % 2 == 1, F.concat(acc["out"], F.array(hit))).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(pieces, F.struct(F.lit(0).alias("n"), F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    return mentions.select("mention_id", F.explode(found).alias("s")).select("mention_id", "s.*")


def recognised(spans: DataFrame, pool: DataFrame, type_pool: DataFrame) -> DataFrame:
    """``spans`` in the columns of ``MERGED`` with a type: that of the nearest alias when it is near enough, else the nearest type, surer
    with a digit.  ``pool`` has text, score and entity_type of each different text's best alias, ``type_pool`` text, score and entity_type of its
    best type; both come from vector_store.rank_pool.  Generic words and spans near nothing are left out."""
    rows = spans.withColumn("normalized", normalize_alias(F.col("text"))).where((F.col("normalized") != "") & ~F.col("normalized").isin(*GENERIC_SURFACES))
    near = pool.select("text", F.col("score").alias("alias_score"), F.col("entity_type").alias("alias_type"))
    kind = type_pool.select("text", F.col("score").alias("type_score"), "entity_type")
    rows = rows.join(near, "text", "left").join(kind, "text", "left")
    by_alias = F.coalesce(F.col("alias_score") >= SURE_ALIAS, F.lit(False))
    score = F.col("type_score") + F.when(F.col("normalized").rlike(r"\p{Nd}"), DIGIT_BONUS).otherwise(0.0)
    sure = F.when(by_alias, F.least(F.greatest("alias_score", F.lit(0.72)), F.lit(0.99))).otherwise(F.least(score, F.lit(0.92)))
    return rows.where(by_alias | F.coalesce(score >= LEAST_LIKENESS, F.lit(False))).select(
        "mention_id", "text", "normalized", "start", "stop", F.when(by_alias, F.col("alias_type")).otherwise(F.col("entity_type")).alias("entity_type_hint"), round_to(sure, 3).alias("confidence"), F.array(F.lit("ner")).alias("methods")
    )


def worthy(rows: DataFrame) -> Column:
    """Is a candidate worth linking?  ``rows`` has a candidate and ``strongest``, the maxima of its signals over all entities."""
    n = F.size(significant(F.col("normalized")))
    hint = F.col("entity_type_hint")
    floor = _table(hint, SPECIFICITY_FLOOR, 0.16)
    any_strong = (F.col("strongest.exact_alias") >= 0.99) | (F.col("strongest.normalized_alias") >= 0.92) | (F.col("strongest.compact_alias") >= 0.9)
    any_strong = any_strong | (F.greatest("strongest.boundary_support", "strongest.contextual_support", "strongest.unique_prefix_support") >= 0.62)
    brand_like, product_like = hint.isin("brand", "organization", "retailer"), hint.isin("product", "product_line")
    one = lambda c: F.when(F.coalesce(c, F.lit(False)), 1.0).otherwise(0.0)
    digit, marked = F.col("normalized").rlike(r"\p{Nd}"), distinctive(F.col("text"))
    alias = F.coalesce(F.greatest(*(F.col(f"strongest.{s}") for s in SIGNALS)), F.lit(0.0))
    high, low = _found(F.col("methods"), HIGH_SIGNAL), _only_low(F.col("methods"))
    score = (
        F.col("specificity") * 0.26 + alias * 0.24 + F.least(F.col("confidence"), F.lit(1.0)) * 0.06 + F.least(n / 4.0, F.lit(1.0)) * 0.06 + one(digit) * 0.04 + one(high) * 0.06
        + one(marked) * 0.06 + one(brand_like) * 0.04 + one(product_like) * 0.05 - one(hint == "concept") * 0.04 - one(low) * 0.08 + one(product_like & digit) * 0.06 + one(brand_like & marked) * 0.04
    )
    needed = F.when(hint.isin("brand", "product", "product_line"), 0.48).otherwise(0.52) + F.when(low, 0.04).otherwise(0.0)
    yes = lambda c: F.coalesce(c, F.lit(False))
    marked_brand = yes(brand_like & marked)
    return (
        F.when(yes(any_strong) | high | digit, True).when((n >= 2) & (F.col("specificity") >= floor), True)
        .when(marked_brand, F.col("specificity") >= F.greatest(floor - 0.06, F.lit(0.06))).otherwise(_clamped(score) >= needed)
    )


def _score_floor(hint: Column) -> Column:
    between = F.greatest("boundary_support", "contextual_support", "unique_prefix_support")
    return (
        F.when(F.col("exact_alias") >= 0.99, 0.78).when((F.col("normalized_alias") >= 0.95) | (F.col("compact_alias") >= 0.9), 0.72).when(between >= 0.66, max(THRESHOLD - 0.08, 0.66))
        .when(F.col("fuzzy_support") >= 0.93, max(THRESHOLD, 0.8)).when(hint == "concept", max(THRESHOLD + 0.04, 0.8)).otherwise(THRESHOLD)
    )


def _supported(n: Column) -> Column:
    """Does the surface itself support the best entity?"""
    strong = (F.col("exact_alias") >= 0.99) | (F.col("normalized_alias") >= 0.95) | (F.col("compact_alias") >= 0.9) | (F.greatest("boundary_support", "contextual_support", "unique_prefix_support") >= 0.62)
    spec, support = F.col("specificity"), F.col("alias_surface_support")
    high, low = _found(F.col("methods"), HIGH_SIGNAL), _only_low(F.col("methods"))
    return (
        F.when(n == 0, False).when(strong, True).when((spec < 0.15) & (n == 1) & F.col("normalized").isin(*GENERIC_SURFACES), False).when(high | F.col("normalized").rlike(r"\p{Nd}"), True)
        .when(spec < _table(F.col("entity_type_hint"), SPECIFICITY_FLOOR, 0.18), False).when(low, support >= F.greatest(F.lit(0.48), 0.62 - spec * 0.08))
        .when((support >= 0.48) & (spec >= 0.3), True).when((n >= 2) & (support >= 0.3) & (spec >= 0.45), True).otherwise(support >= F.greatest(F.lit(0.36), 0.58 - spec * 0.1))
    )


def decide(candidates: DataFrame, aliases: DataFrame, noise: list[str] | None = None, verify: bool = True) -> DataFrame:
    """One row for each different candidate of a mention: mention_id, text, entity_type_hint, confidence, methods,
    canonical_entity_id, concept_entity_id, entity_type, link_confidence, matched_by, candidate_ids and unresolved_reason.

    An empty text, a noise term, a span too weak to mention anything, no alias near, a conflict of types, two entities too
    close, too low a score and too little support by the surface leave it open, in this order."""
    rows = settle(prepared(candidates).dropDuplicates(["candidate_id"]), "candidates")
    found = settle(signals(rows, aliases), "signals")
    best = settle(ranked(rows, found, verify), "ranked")
    strongest = found.groupBy("candidate_id").agg(F.struct(*(F.max(s).alias(s) for s in SIGNALS)).alias("strongest"))
    two = best.groupBy("candidate_id").agg(
        F.min_by(F.struct("canonical_entity_id", "entity_type", "entity_kind", "score", "type_consistent", "alias_surface_support", *SIGNALS), "place").alias("top"),
        F.max(F.when(F.col("place") == 2, F.col("score"))).alias("second"), F.transform(F.array_sort(F.collect_list(F.struct("place", "canonical_entity_id"))), lambda x: x["canonical_entity_id"]).alias("candidate_ids"),
    )
    rows = rows.join(strongest, "candidate_id", "left").join(two, "candidate_id", "left").select("*", "top.*")
    hint, n = F.col("entity_type_hint"), F.size(significant(F.col("normalized")))
    margin = MARGIN + F.when(hint.isin("product", "product_line"), 0.01).when(hint.isin("brand", "organization", "retailer", "concept"), 0.015).otherwise(0.0)
    close = (F.col("alias_surface_support") < 0.58) & (F.col("contextual_support") < 0.08) & ~_found(F.col("methods"), HIGH_SIGNAL) & (F.col("score") >= max(THRESHOLD - 0.02, 0.7)) & (F.col("score") - F.col("second") < margin)
    reason = (
        F.when(F.col("normalized") == "", "empty_candidate_text").when(F.col("normalized").isin(*(noise or ["\x00"])), "noise_term").when(~worthy(rows), "bad_weak_span").when(F.col("score").isNull(), "no_candidate_found")
        .when(~F.col("type_consistent") & (F.col("score") >= max(THRESHOLD - 0.05, 0.6)), "type_conflict").when(F.coalesce(close, F.lit(False)), "ambiguous_multi_candidate")
        .when((F.col("score") < _score_floor(hint)) & (F.col("alias_surface_support") < 0.38), "no_match_above_threshold").when((F.col("score") < _score_floor(hint)) | ~_supported(n), "embedding_surface_support_insufficient")
    )
    rows = rows.withColumn("unresolved_reason", reason)
    linked, concept = F.col("unresolved_reason").isNull(), F.col("entity_kind") == "concept"
    by = F.coalesce(*(F.when(F.col(s) > 0, s) for s in SIGNALS))
    return rows.select(
        "mention_id", "text", "entity_type_hint", "confidence", "methods", F.when(linked & ~concept, F.col("canonical_entity_id")).alias("canonical_entity_id"), F.when(linked & concept, F.col("canonical_entity_id")).alias("concept_entity_id"),
        F.when(linked, F.col("entity_type")).alias("entity_type"), F.when(linked, round_to(F.col("score"), 3)).otherwise(0.0).alias("link_confidence"), F.when(linked, by).otherwise("unresolved").alias("matched_by"),
        F.coalesce("candidate_ids", F.array().cast("array<string>")).alias("candidate_ids"), "unresolved_reason",
    )


def link(mentions: DataFrame, aliases: DataFrame, noise: list[str] | None = None, repeated: bool = True) -> DataFrame:
    """From mentions (mention_id, raw_text, and hashtags, title and context_text if there) to entity facts: candidates of every kind are
    merged, given a type, and resolved by their signals."""
    hits = settle(entities.alias_hits(mentions, aliases), "alias_hits")
    phrases = entities.repeated_phrases(mentions, aliases, noise) if repeated else None
    merged = entities.merge(entities.candidates(mentions, hits, None, phrases))
    context = F.col("context_text") if "context_text" in mentions.columns else F.lit(None).cast("string")
    rows = merged.join(mentions.select("mention_id", context.alias("context_text"), F.col("raw_text").alias("full_text")), "mention_id")
    rows = settle(rows.withColumns({"normalized": normalize_alias(F.col("text")), "phrase_id": F.sha2(F.concat_ws("\x1f", "mention_id", "text"), 256)}), "untyped")
    typed = settle(open_types(rows, aliases).withColumnRenamed("entity_type", "entity_type_hint").drop("phrase_id", "normalized"), "typed")
    return entities.facts(decide(typed, aliases, noise))


def overlapping(spans: DataFrame, by: str = "mention_id") -> DataFrame:
    """Pairs (``by``, left, right) of spans (``by``, span_id, start, stop) that share a character: left is the one that begins first
    (of the smaller id on ties).  Spans are met in buckets of their own length scale, so long texts give no all-pairs."""
    width = F.greatest(F.col("stop") - F.col("start"), F.lit(1))
    rows = spans.withColumn("scale", F.ceil(F.log2(width.cast("double"))).cast("int")).withColumn("cell", F.floor(F.col("start") / F.pow(F.lit(2), F.col("scale"))).cast("long"))
    scales = rows.select(F.col(by).alias("__by"), F.col("scale").alias("other")).distinct()
    # A span covers at most two cells of its own scale; at each scale that its text has it asks for all cells it touches.
    asked = rows.join(scales, rows[by] == scales["__by"]).where("other >= scale")
    size = F.pow(F.lit(2), F.col("other"))
    asked = asked.withColumn("at", F.explode(F.sequence(F.floor(F.col("start") / size).cast("long") - 1, F.floor((F.col("stop") - 1) / size).cast("long"))))
    left = asked.select(by, F.col("span_id").alias("l"), F.col("start").alias("ls"), F.col("stop").alias("le"), F.col("other").alias("scale"), F.col("at").alias("cell"))
    right = rows.select(by, F.col("span_id").alias("r"), F.col("start").alias("rs"), F.col("stop").alias("re"), "scale", "cell")
    met = left.join(right, [by, "scale", "cell"]).where("l <> r and ls < re and rs < le")
    first = (F.col("ls") < F.col("rs")) | ((F.col("ls") == F.col("rs")) & (F.col("l") < F.col("r")))
    return met.select(by, F.when(first, F.col("l")).otherwise(F.col("r")).alias("left"), F.when(first, F.col("r")).otherwise(F.col("l")).alias("right")).distinct()


#: What a further source adds, and the likeness from which two spans are one.
MERGE_BONUS, SOURCE_STEP, MOST_STEPS, MOST_MERGED, SAME_TOKENS, SAME_VECTORS, NEAR_TOKENS = 0.02, 0.01, 0.03, 0.98, 0.85, 0.82, 0.34
_SURFACES = (("alias_scan", 5), ("product_code", 4), ("ner", 3), ("hashtag", 2))
MERGED = "mention_id string, text string, normalized string, start int, stop int, entity_type_hint string, confidence double, methods array<string>"


def _priority(c: dict) -> tuple:
    rank = next((r for m, r in _SURFACES if m in c["methods"]), 1)
    length = max(c["stop"] - c["start"], 0) if c["start"] is not None and c["stop"] is not None else 0
    return rank, c["confidence"], length if rank == 1 else -length


def _one(a: dict, b: dict, fold, encode) -> bool:
    """Are two spans of a mention the same thing?"""
    if a["entity_type_hint"] and b["entity_type_hint"] and a["entity_type_hint"] != b["entity_type_hint"]:
        return False
    x, y = a["normalized"], b["normalized"]
    if x in y or y in x or x.replace(" ", "") == y.replace(" ", "") or fold(x).replace(" ", "") == fold(y).replace(" ", ""):
        return True
    if None not in (a["start"], a["stop"], b["start"], b["stop"]) and a["start"] < b["stop"] and b["start"] < a["stop"]:
        return True
    s, t = set(x.split()), set(y.split())
    share = len(s & t) / len(s | t) if s and t else 0.0
    if share >= SAME_TOKENS:
        return True
    digits = any(c.isdigit() for c in x) and any(c.isdigit() for c in y)
    if encode is None or not x or not y or (share < NEAR_TOKENS and not digits):
        return False
    u, v = encode([x, y])
    return sum(p * q for p, q in zip(u, v, strict=True)) >= SAME_VECTORS


def merge_sources(base: DataFrame, spans: DataFrame, encode=None) -> DataFrame:
    """Candidates of ``base`` joined by recognised ``spans``, both with the columns of ``MERGED``; each span in order of its place
    joins the first candidate that it is one with - same text, also run together or without accents, one inside the other,
    overlapping places, nearly the same words, or vectors of ``encode`` alike - and stands by itself otherwise.

    A joined candidate gains a little confidence, keeps all methods and takes the surface of the better source.  The
    candidates of one mention are merged in one task; a mention has few."""
    both = base.select(F.lit(0).alias("later"), *(x.split()[0] for x in MERGED.split(", "))).unionByName(spans.select(F.lit(1).alias("later"), *(x.split()[0] for x in MERGED.split(", "))))

    def run(table):
        import unicodedata

        import pyarrow as pa

        fold = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
        last = 1 << 60
        rows = sorted(table.to_pylist(), key=lambda r: (r["later"], r["start"] if r["start"] is not None else last, r["stop"] if r["stop"] is not None else last, r["text"], r["methods"]))
        kept: list[dict] = []
        for r in rows:
            at = next((k for k, c in enumerate(kept) if _one(c, r, fold, encode)), None) if r["later"] else None
            if at is None:
                kept.append(r)
                continue
            c = kept[at]
            better = _priority(r) > _priority(c)
            methods = sorted({*c["methods"], *r["methods"]})
            sure = min(max(c["confidence"], r["confidence"]) + MERGE_BONUS + min((len(methods) - 1) * SOURCE_STEP, MOST_STEPS), MOST_MERGED)
            one, other = (r, c) if better else (c, r)
            pick = lambda name, one=one, other=other: one[name] if one[name] is not None else other[name]
            kept[at] = c | {"text": one["text"], "normalized": one["normalized"], "entity_type_hint": pick("entity_type_hint"), "start": pick("start"), "stop": pick("stop"), "confidence": round(sure, 3), "methods": methods}
        schema = pa.schema([("mention_id", pa.string()), ("text", pa.string()), ("normalized", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("entity_type_hint", pa.string()), ("confidence", pa.float64()), ("methods", pa.list_(pa.string()))])
        return pa.Table.from_pylist([{k: r[k] for k in schema.names} for r in kept], schema=schema)

    return both.groupBy("mention_id").applyInArrow(run, MERGED)
