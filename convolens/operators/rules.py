"""Rule enrichers: keywords, stance, intent, influence, lexicon sentiment, aspect and issue markers.

Cue lists are parameters; the defaults are fixed values of the rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import counted, tokens

# Cues of each label, in the order the rules are tried.
STOPWORDS = ("và", "là", "của", "cho", "the", "and", "with", "that", "this", "mấy", "bác")
STANCE = (("question", 0.8, ("hỏi", "sao", "why", "what")), ("oppose", 0.65, ("không", "lỗi", "bad", "hate", "chậm")), ("support", 0.65, ("đẹp", "tốt", "love", "good", "tự hào")))
INTENT = (
    ("question", 0.85, ("hỏi",)),
    ("purchase_intent", 0.7, ("mua", "đặt", "giá", "buy")),
    ("praise", 0.7, ("đẹp", "tốt", "love", "chúc mừng")),
    ("complaint", 0.65, ("lỗi", "chậm", "bad", "không")),
    ("compare", 0.6, ("so với", "compare", "hơn")),
)
TIERS = (("macro", 500), ("mid", 100), ("micro", 20))
POSITIVE = ("tốt", "đẹp", "ổn", "ngon", "xịn", "thích", "nice", "great", "love", "good", "tự hào")
NEGATIVE = ("tệ", "xấu", "chán", "kém", "lỗi", "chậm", "ghét", "bad", "slow", "hate", "không", "khó")
ASPECTS = {
    "price": ("giá", "price", "rẻ", "đắt"), "quality": ("chất lượng", "quality", "ổn", "kém"), "design": ("đẹp", "thiết kế", "design"),
    "performance": ("mạnh", "performance", "vận hành", "ổn"), "battery": ("pin", "battery"), "charging": ("sạc", "charging"),
    "safety": ("an toàn", "safety"), "trust": ("tin", "trust", "uy tín"), "delivery": ("giao", "delivery"),
}
ASPECT_NEGATIVE = ("không", "chậm", "kém", "bad")
ASPECT_POSITIVE = ("đẹp", "tốt", "ổn", "good")
ISSUES = {
    "defect": ("lỗi", "hỏng", "defect"), "service_issue": ("dịch vụ", "service", "bảo hành"), "safety_issue": ("nguy hiểm", "an toàn", "safety"),
    "supply_issue": ("chờ", "trễ", "delivery"), "trust_issue": ("lùa", "lừa", "trust"),
}


def any_of(text: Column, cues) -> Column:
    return reduce(lambda a, b: a | b, (text.contains(c) for c in cues), F.lit(False))


def hits(text: Column, cues) -> Column:
    return sum((text.contains(c).cast("int") for c in cues), F.lit(0))


def _first_rule(raw: Column, text: Column, rules, default: tuple[str, float]) -> Column:
    """struct<label, confidence> of the first rule whose cue occurs; a question mark in the raw text fires the first."""
    out = None
    for k, (label, confidence, cues) in enumerate(rules):
        cond = any_of(text, cues) | raw.contains("?") if k == 0 else any_of(text, cues)
        value = F.struct(F.lit(label).alias("label"), F.lit(confidence).alias("confidence"))
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(F.struct(F.lit(default[0]).alias("label"), F.lit(default[1]).alias("confidence")))


def stance(raw: Column, text: Column, rules=STANCE) -> Column:
    return _first_rule(raw, text, rules, ("neutral", 0.45))


def intent(raw: Column, text: Column, rules=INTENT) -> Column:
    return _first_rule(raw, text, rules, ("commentary", 0.4))


def engagement(likes: Column, comments: Column, replies: Column, shares: Column, views: Column) -> Column:
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    return zero(likes) + zero(comments) + zero(replies) + zero(shares) + zero(views) / 100.0


def influence_tier(score: Column) -> Column:
    out = F.when(score >= TIERS[0][1], TIERS[0][0])
    for name, least in TIERS[1:]:
        out = out.when(score >= least, name)
    return out.otherwise("nano")


def lexicon_sentiment(text: Column, positive=POSITIVE, negative=NEGATIVE) -> Column:
    """struct<label, positive, negative, confidence>."""
    p, n = hits(text, positive), hits(text, negative)
    label = F.when((p > 0) & (n > 0), "mixed").when(p > n, "positive").when(n > p, "negative").otherwise("neutral")
    return F.struct(label.alias("label"), p.alias("positive"), n.alias("negative"), (0.45 + F.least((p + n) * 0.1, F.lit(0.45))).alias("confidence"))


def marked(text: Column, markers: dict[str, tuple[str, ...]]) -> Column:
    """Array of the labels that have a marker in the text."""
    return F.array_compact(F.array(*(F.when(any_of(text, cues), F.lit(label)) for label, cues in markers.items())))


def aspect_facts(mentions: DataFrame, aspects=None) -> DataFrame:
    """(mention_id, aspect, sentiment, confidence), one row for each aspect of each mention."""
    text = F.col("text")
    mood = F.when(any_of(text, ASPECT_NEGATIVE), "negative").when(any_of(text, ASPECT_POSITIVE), "positive").otherwise("neutral")
    return mentions.select("mention_id", F.explode(marked(text, aspects or ASPECTS)).alias("aspect"), mood.alias("sentiment"), F.lit(0.62).alias("confidence"))


def issue_facts(mentions: DataFrame, issues=None) -> DataFrame:
    """(mention_id, issue_category, severity, confidence): severity by depth and likes."""
    severity = F.when(F.col("depth") == 0, "high").when(F.col("likes") > 20, "medium").otherwise("low")
    return mentions.select("mention_id", F.explode(marked(F.col("text"), issues or ISSUES)).alias("issue_category"), severity.alias("severity"), F.lit(0.66).alias("confidence"))


def top_tokens(text: Column, stopwords=STOPWORDS, top: int = 3) -> Column:
    """array<struct<n, first, item>> of the commonest tokens, -n in front: counted inside the row, the earlier one first on ties."""
    kept = F.filter(tokens(text), lambda t: (F.length(t) > 2) & ~t.isin(*stopwords, "url"))
    return F.slice(F.array_sort(F.transform(counted(kept), lambda c: F.struct((-c["n"]).alias("n"), c["first"].alias("first"), c["item"].alias("item")))), 1, top)


def keywords(mentions: DataFrame, stopwords=STOPWORDS, top: int = 3) -> DataFrame:
    """(mention_id, place, token, count): the commonest tokens of each mention, the earlier one first on ties."""
    rows = mentions.select("mention_id", F.posexplode(top_tokens(F.col("text"), stopwords, top)).alias("at", "t"))
    return rows.select("mention_id", (F.col("at") + 1).alias("place"), F.col("t.item").alias("token"), (-F.col("t.n")).cast("long").alias("count"))


def keyphrases(mentions: DataFrame, stopwords=STOPWORDS, limit: int = 5) -> DataFrame:
    """(mention_id, keyphrase, confidence): top tokens, then three hashtags, then two given keywords, each once.

    ``mentions`` carries hashtags and keywords arrays."""
    none = F.array().cast("array<string>")
    part = lambda c, n: F.slice(F.coalesce(c, none), 1, n)
    joined = mentions.withColumn("toks", F.transform(top_tokens(F.col("text"), stopwords), lambda t: t["item"]))
    phrases = F.filter(F.transform(F.concat(part(F.col("toks"), 3), part(F.col("hashtags"), 3), part(F.col("keywords"), 2)), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    rows = joined.select("mention_id", F.explode(F.slice(F.array_distinct(phrases), 1, limit)).alias("keyphrase"), F.coalesce("keywords", none).alias("keywords"))
    return rows.select("mention_id", "keyphrase", F.when(F.array_contains("keywords", F.col("keyphrase")), 0.55).otherwise(0.42).alias("confidence"))


def document_frequency(mentions: DataFrame) -> DataFrame:
    return mentions.select("mention_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("documents"))


def salient_terms(rows: DataFrame, group: str, top: int = 5) -> DataFrame:
    """(group, place, token, score): .7 specificity + .3 frequency of each group's tokens."""
    terms = rows.select(group, F.explode(tokens(F.col("text"))).alias("token")).groupBy(group, "token").agg(F.count(F.lit(1)).alias("n"))
    # Sums by aggregation; only the ranking is a window, and its limit holds before rows move.
    whole = terms.groupBy("token").agg(F.sum("n").alias("everywhere"))
    largest = terms.groupBy(group).agg(F.max("n").alias("largest"))
    score = 0.7 * (F.col("n") / F.col("everywhere")) + 0.3 * (F.col("n") / F.col("largest"))
    scored = terms.join(whole, "token").join(largest, group).withColumn("score", score)
    ranked = scored.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("score"), F.desc("n"), "token")))
    return ranked.where(F.col("place") <= top).select(group, "place", "token", "score")
