"""Semantic inference: segments, cue anchors, polarity with negation, targets, aspects, issues, confidence.

Segments and anchors are found by an Arrow function (they need character places); everything after is joins and
aggregates over a long table of anchors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import round_to

NEGATION_REACH = 14
SCOPE = 48
# Label thresholds and the smallest weight of a far cue.
STRONG, WEAK, LEAST_WEIGHT = 0.35, 0.15, 0.35
MODES = ("escalation_signal", "hearsay_or_rumor", "question_or_uncertainty", "comparison_based_critique", "direct_complaint", "direct_observation")


# Cues in Vietnamese, with and without accents, and English.
POLARITY = {
    "good": 0.7, "great": 0.9, "love": 1.0, "nice": 0.7, "smooth": 0.75, "đẹp": 0.75, "dep": 0.75, "ổn": 0.65, "on": 0.65, "ok": 0.55, "xịn": 0.85, "xin": 0.85, "nhanh": 0.7,
    "bad": -0.7, "hate": -1.0, "slow": -0.8, "lag": -0.85, "delay": -0.75, "confusing": -0.65, "chậm": -0.8, "cham": -0.8, "kém": -0.75, "kem": -0.75, "tệ": -0.85, "te": -0.85, "lỗi": -0.85, "loi": -0.85, "khó": -0.65, "kho": -0.65,
    "đắt": -0.65, "dat": -0.65,
}
ASPECTS = {
    "price": ("price", "giá", "gia", "đắt", "dat", "rẻ", "re", "value", "cost"),
    "quality": ("quality", "chất lượng", "chat luong", "build", "finish", "texture"),
    "design": ("design", "thiết kế", "thiet ke", "look", "style", "đẹp", "dep", "mã"),
    "performance": ("performance", "hiệu năng", "hieu nang", "lag", "slow", "nhanh", "chậm", "cham"),
    "durability": ("durable", "durability", "bền", "ben", "wear", "broken"),
    "availability": ("stock", "available", "availability", "hết hàng", "het hang", "sold out"),
    "customer_service": ("service", "support", "cskh", "bảo hành", "bao hanh", "refund"),
    "delivery": ("delivery", "ship", "shipping", "giao", "arrive", "delay", "trễ", "tre"),
    "trust": ("trust", "fake", "uy tín", "uy tin", "scam", "legit"),
    "safety": ("safety", "safe", "an toàn", "an toan", "unsafe", "danger"),
    "battery": ("battery", "pin"),
    "charging": ("charging", "charge", "sạc", "sac"),
    "usability": ("easy", "hard to use", "khó dùng", "kho dung", "confusing", "usability"),
}
ISSUES = {
    "product_defect": ("defect", "broken", "lỗi", "loi", "hỏng", "hong", "fail"),
    "performance_problem": ("lag", "slow", "chậm", "cham", "freeze", "crash", "nóng", "nong"),
    "service_problem": ("service", "support", "bảo hành", "bao hanh", "refund"),
    "delivery_problem": ("delivery", "ship", "delay", "trễ", "tre", "giao"),
    "trust_concern": ("fake", "scam", "lừa", "lua", "suspicious", "trust"),
    "safety_concern": ("unsafe", "danger", "nguy hiểm", "nguy hiem", "cháy", "chay"),
    "compliance_concern": ("policy", "compliance", "ban", "legal", "regulation"),
    "pricing_value_concern": ("overpriced", "expensive", "đắt", "dat", "pricey", "value"),
    "usability_problem": ("hard to use", "confusing", "khó dùng", "kho dung", "buggy flow"),
    "availability_problem": ("sold out", "hết hàng", "het hang", "unavailable", "backorder"),
}
ASPECT_ISSUE = {
    "price": "pricing_value_concern", "quality": "product_defect", "performance": "performance_problem", "durability": "product_defect", "availability": "availability_problem", "customer_service": "service_problem",
    "delivery": "delivery_problem", "trust": "trust_concern", "safety": "safety_concern", "battery": "performance_problem", "charging": "performance_problem", "usability": "usability_problem",
}


@dataclass(frozen=True)
class Cues:
    """Words that anchors are made of; a deployment may pass its own."""

    polarity: dict[str, float] = field(default_factory=lambda: dict(POLARITY))
    aspects: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(ASPECTS))
    issues: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(ISSUES))
    aspect_issue: dict[str, str] = field(default_factory=lambda: dict(ASPECT_ISSUE))
    negation: tuple[str, ...] = ("không", "khong", "not", "never", "chưa", "chua", "chẳng", "chang")
    uncertainty: tuple[str, ...] = ("có ai", "co ai", "hình như", "hinh nhu", "maybe", "perhaps", "seems", "có vẻ", "co ve")
    comparison: tuple[str, ...] = ("hơn", "hon", "better", "worse", "than", "compared")
    hearsay: tuple[str, ...] = ("nghe nói", "nghe noi", "đồn", "don", "apparently", "people say", "rumor")
    escalation: tuple[str, ...] = ("report", "refund", "never again", "quá tệ", "qua te", "gấp", "urgent", "danger")
    first_person: tuple[str, ...] = ("mình", "minh", "tôi", "toi", "em", "i", "my", "me")
    contrast: tuple[str, ...] = ("nhung", "nhưng", "but", "however", "though", "although", "tuy nhien", "tuy nhiên", "con", "còn", "ma", "mà")

    def table(self) -> list[tuple[str, str, str, float]]:
        """(kind, label, cue, score)."""
        rows = [("polarity", "positive" if s > 0 else "negative", c, s) for c, s in self.polarity.items()]
        rows += [("aspect", label, c, 0.0) for label, cues in self.aspects.items() for c in cues]
        rows += [("issue", label, c, 0.0) for label, cues in self.issues.items() for c in cues]
        for kind in ("negation", "uncertainty", "comparison", "hearsay", "escalation", "first_person"):
            rows += [(kind, c, c, 0.0) for c in getattr(self, kind)]
        return rows


_HARD = re.compile(r"[,.!?;\n]+|[|*]+")


def segment(text: str, contrast: tuple[str, ...] = Cues().contrast) -> list[tuple[int, int, str, bool, bool]]:
    """(start, stop, text, contrastive, question) of the parts between marks and words of contrast."""
    if not text.strip():
        return []
    words = re.compile(rf"\b(?:{'|'.join(map(re.escape, contrast))})\b", re.I) if contrast else None
    cuts = [(m.start(), m.end(), "hard") for m in _HARD.finditer(text)] + ([(m.start(), m.end(), "contrast") for m in words.finditer(text)] if words else [])
    out, at, before = [], 0, None
    for start, stop, kind in [*sorted(cuts), (len(text), len(text), "end")]:
        part = text[at:start].strip(" ,")
        if part:
            where = text.index(part, at)
            question = "?" in part or "?" in text[start:stop] or (kind == "end" and text.strip().endswith("?"))
            out.append((where, where + len(part), part, before == "contrast", question))
        at, before = max(at, stop), kind
    return out


def _finder(rows: list[tuple[str, str, str, float]]):
    """A function that gives (kind, label, score, start, stop) of all cues in a text as whole words, whatever the case: one run of an
    automaton over all cues.  Places of one cue don't overlap."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    by_cue: dict[str, list] = {}
    for kind, label, cue, score in rows:
        by_cue.setdefault(cue.lower(), []).append((kind, label, score))
    for cue, meant in by_cue.items():
        if cue:
            automaton.add_word(cue, (len(cue), cue, meant))
    automaton.make_automaton()
    inside = lambda c: c.isalnum() or c == "_"

    def find(text: str):
        # Letter by letter, so that places stay those of the text.
        low = text.lower()
        if len(low) != len(text):
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        free: dict[str, int] = {}
        if not by_cue:
            return
        for end, (size, cue, meant) in automaton.iter(low):
            start, stop = end - size + 1, end + 1
            if start < free.get(cue, 0) or (start and inside(low[start - 1])) or (stop < len(low) and inside(low[stop])):
                continue
            free[cue] = stop
            for kind, label, score in meant:
                yield kind, label, score, start, stop

    return find


def anchors(mentions: DataFrame, targets: DataFrame | None = None, cues: Cues | None = None) -> DataFrame:
    """(mention_id, segment, kind, label, score, start, stop): every cue, each segment itself (kind ``segment``, label
    ``contrast``/``question``/both/empty), and mentions of targets (mention_id, target_text, target_key)."""
    cues = cues or Cues()
    rows = mentions.select("mention_id", F.coalesce("raw_text", F.lit("")).alias("raw_text"))
    if targets is not None:
        named = targets.groupBy("mention_id").agg(F.sort_array(F.collect_set(F.struct("target_text", "target_key"))).alias("targets"))
        rows = rows.join(named, "mention_id", "left")
    else:
        rows = rows.withColumn("targets", F.lit(None).cast("array<struct<target_text: string, target_key: string>>"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found_by = _finder([(kind, label, cue, score) for kind, label, cue, score in cues.table()])
        schema = pa.schema([("mention_id", pa.string()), ("segment", pa.int32()), ("kind", pa.string()), ("label", pa.string()), ("score", pa.float64()), ("start", pa.int32()), ("stop", pa.int32())])
        for batch in batches:
            out = []
            for key, text, named in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for n, (start, stop, part, contrast, question) in enumerate(segment(text, cues.contrast)):
                    out.append((key, n, "segment", " ".join(filter(None, ("contrast" if contrast else "", "question" if question else ""))), 0.0, start, stop))
                    out.extend((key, n, kind, label, score, start + x, start + y) for kind, label, score, x, y in found_by(part))
                    for t in named or ():
                        if t["target_text"]:
                            found = re.finditer(rf"(?<!\w){re.escape(t['target_text'])}(?!\w)", part, re.I)
                            out.extend((key, n, "target", t["target_key"], 0.0, start + m.start(), start + m.end()) for m in found)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [()] * 7, schema, strict=True)], schema=schema)

    return rows.select("mention_id", "raw_text", "targets").mapInArrow(run, "mention_id string, segment int, kind string, label string, score double, start int, stop int")


def signed_cues(a: DataFrame) -> DataFrame:
    """Polarity cues with their score, turned round when a negation starts within NEGATION_REACH before, and negated."""
    p = a.where("kind = 'polarity'").alias("p")
    n = a.where("kind = 'negation'").select("mention_id", "segment", F.col("start").alias("n_start")).alias("n")
    hit = (F.col("p.mention_id") == F.col("n.mention_id")) & (F.col("p.segment") == F.col("n.segment")) & (F.col("p.start") - F.col("n_start")).between(0, NEGATION_REACH)
    rows = p.join(n, hit, "left").groupBy("p.mention_id", "p.segment", "p.label", "p.score", "p.start", "p.stop").agg(F.max(F.col("n_start").isNotNull().cast("int")).alias("negated"))
    return rows.select("mention_id", "segment", "start", "stop", F.when(F.col("negated") == 1, -F.col("score")).otherwise(F.col("score")).alias("score"), (F.col("negated") == 1).alias("negated"))


def label(score: Column) -> Column:
    return F.when(score >= STRONG, "positive").when(score <= -STRONG, "negative").when(F.abs(score) < WEAK, "neutral").otherwise("mixed")


def merged_label(labels: Column) -> Column:
    """Of an array of labels: mixed if opposed or already mixed."""
    has = lambda x: F.array_contains(labels, x)
    return F.when((has("positive") & has("negative")) | has("mixed"), "mixed").when(has("positive"), "positive").when(has("negative"), "negative").otherwise("neutral")


def segments(a: DataFrame) -> DataFrame:
    """(mention_id, segment, score, cues, negated, contrast, uncertain, hearsay, comparison, escalation, first_person)."""
    signed = signed_cues(a).groupBy("mention_id", "segment").agg(F.sum(F.col("score").cast("decimal(10,4)")).cast("double").alias("score"), F.count(F.lit(1)).alias("cues"), F.max("negated").alias("negated"))
    any_of = lambda kind: F.coalesce(F.max(F.col("kind") == kind), F.lit(False))
    flags = a.groupBy("mention_id", "segment").agg(
        F.max((F.col("kind") == "segment") & F.col("label").contains("contrast")).alias("contrast"),
        F.max(((F.col("kind") == "segment") & F.col("label").contains("question")) | (F.col("kind") == "uncertainty")).alias("uncertain"),
        any_of("hearsay").alias("hearsay"), any_of("comparison").alias("comparison"), any_of("escalation").alias("escalation"), any_of("first_person").alias("first_person"),
    )
    rows = flags.join(signed, ["mention_id", "segment"], "left")
    return rows.withColumns({"score": F.coalesce("score", F.lit(0.0)), "cues": F.coalesce("cues", F.lit(0)), "negated": F.coalesce("negated", F.lit(False))})


def clamp(base: float, parts: list[Column]) -> Column:
    return round_to(F.greatest(F.lit(0.05), F.least(F.lit(0.99), sum(parts, F.lit(base)))), 3)


def sentiment_parts(explicit: Column, inherited: Column, support: Column, mixed: Column, contrast: Column, negated: Column, uncertain: Column) -> list[Column]:
    on = lambda cond, value: F.when(cond, value).otherwise(0.0)
    more = F.when(support > 1, F.least(0.04 * (support - 1), F.lit(0.14))).otherwise(0.0)
    return [on(explicit, 0.12), on(inherited, -0.12), more, on(mixed, -0.1), on(contrast, -0.04), on(negated, -0.03), on(uncertain, -0.1)]


def mention_sentiment(s: DataFrame) -> DataFrame:
    """(mention_id, sentiment, score, confidence) of mentions with a polarity cue."""
    rows = s.where("cues > 0").withColumn("l", label(F.col("score")))
    flag = F.col("uncertain") | F.col("hearsay") | F.col("comparison") | F.col("contrast")
    g = rows.groupBy("mention_id").agg(F.collect_set("l").alias("ls"), F.sum(F.col("score").cast("decimal(10,4)")).cast("double").alias("t"), F.sum("cues").alias("n"), F.max("contrast").alias("c"), F.max("negated").alias("neg"), F.max(flag).alias("u"))
    mood = merged_label(F.col("ls"))
    no = F.lit(False)
    return g.select("mention_id", mood.alias("sentiment"), round_to(F.abs("t"), 3).alias("score"), clamp(0.5, sentiment_parts(no, no, F.col("n"), mood == "mixed", F.col("c"), F.col("neg"), F.col("u"))).alias("confidence"))


def near(a: DataFrame, kind: str) -> DataFrame:
    """(mention_id, segment, label, start, score, support): for each anchor of ``kind`` the cues of its segment within SCOPE,
    weighted down with distance."""
    t = a.where(F.col("kind") == kind).select("mention_id", "segment", "label", F.col("start").alias("t_start"), F.col("stop").alias("t_stop"))
    c = signed_cues(a)
    gap = F.least(F.abs(F.col("start") - F.col("t_start")), F.abs(F.col("stop") - F.col("t_stop")))
    rows = t.join(c, ["mention_id", "segment"]).withColumn("gap", gap).where(F.col("gap") <= SCOPE)
    weight = F.greatest(F.lit(LEAST_WEIGHT), 1.0 - F.col("gap") / SCOPE)
    value = (F.col("score") * weight).cast("decimal(20,8)")
    return rows.groupBy("mention_id", "segment", "label", "t_start").agg(F.sum(value).cast("double").alias("score"), F.count(F.lit(1)).alias("support"), F.max("negated").alias("negated")).withColumnRenamed("t_start", "start")


def first_of_label(rows: DataFrame) -> DataFrame:
    """Only the first anchor of each label in a segment."""
    w = Window.partitionBy("mention_id", "segment", "label").orderBy("start")
    return rows.withColumn("place", F.row_number().over(w)).where("place = 1").drop("place")


def target_sentiment(a: DataFrame, s: DataFrame, inherited: DataFrame | None = None) -> DataFrame:
    """(mention_id, target_key, sentiment, score, confidence, inherited): from cues near the target; a target taken over
    from the thread (mention_id, target_key) gets three quarters of each segment's score, where the mention names none."""
    own = first_of_label(near(a, "target")).withColumn("inherited", F.lit(False))
    rows = own
    if inherited is not None:
        silent = inherited.join(a.where("kind = 'target'").select("mention_id").distinct(), "mention_id", "left_anti")
        taken = silent.join(s.where("cues > 0"), "mention_id").select("mention_id", "segment", F.col("target_key").alias("label"), F.lit(0).alias("start"), (F.col("score") * 0.75).alias("score"), F.col("cues").alias("support"), "negated", F.lit(True).alias("inherited"))
        rows = own.unionByName(taken)
    rows = rows.join(s.select("mention_id", "segment", "contrast", (F.col("uncertain") | F.col("hearsay") | F.col("comparison") | F.col("contrast")).alias("unsure")), ["mention_id", "segment"])
    mood = label(F.col("score"))
    rows = rows.withColumn("l", mood).withColumn("confidence", clamp(0.48, sentiment_parts(~F.col("inherited"), F.col("inherited"), F.col("support"), mood == "mixed", F.col("contrast"), F.col("negated"), F.col("unsure"))))
    return rows.groupBy("mention_id", F.col("label").alias("target_key")).agg(
        merged_label(F.collect_set("l")).alias("sentiment"), round_to(F.max(F.abs("score")), 3).alias("score"), round_to(F.avg("confidence"), 3).alias("confidence"), F.max("inherited").alias("inherited")
    )


def inherited_targets(targets: DataFrame, lineage: DataFrame) -> DataFrame:
    """(mention_id, target_key): the target of the nearest ancestor that names exactly one."""
    one = targets.groupBy(F.col("mention_id").alias("ancestor_id")).agg(F.count_distinct("target_key").alias("n"), F.min("target_key").alias("target_key"))
    return lineage.join(one.where("n = 1"), "ancestor_id").groupBy("mention_id").agg(F.min_by("target_key", "distance").alias("target_key"))


def aspects(a: DataFrame, s: DataFrame) -> DataFrame:
    """(mention_id, segment, aspect, score, sentiment, confidence) of aspects with cues of weight around them."""
    rows = first_of_label(near(a, "aspect")).where(F.abs("score") >= 0.18).join(s.select("mention_id", "segment", "contrast", "uncertain"), ["mention_id", "segment"])
    mood = label(F.col("score"))
    no = F.lit(False)
    confidence = clamp(0.48, sentiment_parts(no, no, F.col("support"), mood == "mixed", F.col("contrast"), F.col("negated"), F.col("uncertain")))
    return rows.select("mention_id", "segment", F.col("label").alias("aspect"), "score", mood.alias("sentiment"), confidence.alias("confidence"))


def evidence_mode(score: Column) -> Column:
    """How an issue is known, from the segment's flags."""
    return (
        F.when(F.col("escalation"), MODES[0]).when(F.col("hearsay"), MODES[1]).when(F.col("uncertain"), MODES[2]).when(F.col("comparison") & (score < 0), MODES[3]).when((score < 0) & F.col("first_person"), MODES[4]).otherwise(MODES[5])
    )


def severity(issue: Column, mode: Column, score: Column) -> Column:
    size = F.abs(score)
    return (
        F.when((issue == "safety_concern") & mode.isin("escalation_signal", "direct_complaint"), "critical_like_proxy")
        .when((mode == "escalation_signal") | (size >= 1.05), "high").when(mode.isin("question_or_uncertainty", "hearsay_or_rumor"), "low").when(size >= 0.55, "medium").otherwise("low")
    )


def issues(a: DataFrame, s: DataFrame, cues: Cues | None = None) -> DataFrame:
    """(mention_id, segment, issue_category, score, evidence_mode, severity): named issues, and those that follow from an
    aspect with clearly negative cues."""
    cues = cues or Cues()
    scored = near(a, "issue").select("mention_id", "segment", "label", "start", "score")
    named = a.where("kind = 'issue'").select("mention_id", "segment", "label", "start").join(scored, ["mention_id", "segment", "label", "start"], "left")
    named = first_of_label(named).withColumn("score", F.coalesce("score", F.lit(0.0))).select("mention_id", "segment", F.col("label").alias("issue_category"), "score")
    follows = F.create_map(*(F.lit(x) for pair in cues.aspect_issue.items() for x in pair)) if cues.aspect_issue else None
    if follows is not None:
        derived = first_of_label(near(a, "aspect")).where(F.col("score") < -0.2).select("mention_id", "segment", F.try_element_at(follows, F.col("label")).alias("issue_category"), "score").where("issue_category is not null")
        named = named.unionByName(derived.join(named.select("mention_id", "segment", "issue_category"), ["mention_id", "segment", "issue_category"], "left_anti"))
    rows = named.join(s.drop("score", "cues"), ["mention_id", "segment"])
    mode = evidence_mode(F.col("score"))
    rows = rows.groupBy("mention_id", "segment", "issue_category", "contrast", "uncertain", "hearsay", "comparison", "escalation", "first_person").agg(F.min("score").alias("score"))
    return rows.select("mention_id", "segment", "issue_category", "score", mode.alias("evidence_mode"), severity(F.col("issue_category"), mode, F.col("score")).alias("severity"), (F.col("uncertain") | F.col("hearsay")).alias("unsure"))


def corroborate(found: DataFrame, mentions: DataFrame, text: str = "normalized_text") -> DataFrame:
    """issues with corroboration_count (facts of the same thread, issue and equal normalised text, themselves included) and
    a confidence that grows with it; one step of severity more from three on, unless only heard or asked.

    Counting equal texts needs no pairs, so a group may be of any size."""
    rows = found.join(mentions.select("mention_id", "root_id", text), "mention_id")
    rows = rows.withColumn("corroboration_count", F.count(F.lit(1)).over(Window.partitionBy("root_id", "issue_category", text)))
    n, unsure = F.col("corroboration_count"), F.col("unsure")
    on = lambda cond, value: F.when(cond, value).otherwise(0.0)
    parts = [on(unsure, -0.22), F.when((n > 1) & ~unsure, F.least(0.05 * (n - 1), F.lit(0.16))).otherwise(0.0), on(F.col("evidence_mode") == "escalation_signal", 0.08), on(F.col("evidence_mode").isin("direct_complaint", "direct_observation"), 0.06)]
    up = F.when((n >= 3) & ~unsure, F.when(F.col("severity") == "low", "medium").when(F.col("severity") == "medium", "high").otherwise(F.col("severity"))).otherwise(F.col("severity"))
    return rows.withColumn("confidence", clamp(0.44, parts)).withColumn("severity", up).drop(text)


# Kinds of entities that can be targets, how specific they are, and what makes a link sure.
SPECIFICITY = {"product": 4, "product_line": 4, "brand": 3, "retailer": 3, "organization": 3, "campaign": 2, "influencer": 2, "category": 1, "concept": 1, "person": 1, "location": 1}
SURE_MATCHES = ("exact_alias", "normalized_alias", "compact_alias")
CONTEXT_TYPES = ("brand", "organization", "retailer", "location", "facility", "person")
CONTEXT_LAYERS = ("domain", "domain_overlay", "review_overlay")
CONTEXT_FINDS = ("alias_scan", "title_span", "model_code_pattern")
CONCEPT_FINDS = ("alias_scan", "brand_context", "product_code", "ner")


def eligible_targets(facts: DataFrame, seed_terms: list[str] | None = None) -> DataFrame:
    """(mention_id, target_key, target_text, target_kind, entity_type, grounding): the entities of a mention that opinions can be about,
    each once by its first text; concepts only where it has no other.

    ``facts`` has mention_id, text, canonical_entity_id, concept_entity_id, entity_type, confidence, matched_by, methods, specificity,
    knowledge_layer and target_eligible."""
    c, m = F.col("confidence"), F.col("methods")
    found = lambda names: F.exists(m, lambda x: x.isin(*names))
    own = (
        (c >= 0.78) | (F.col("matched_by").isin(*SURE_MATCHES) & (c >= 0.72)) | ((F.col("specificity") >= 0.2) & (c >= 0.68))
        | ((F.col("matched_by") == "contextual_support") & F.col("entity_type").isin(*CONTEXT_TYPES) & (c >= 0.74) & F.col("knowledge_layer").isin(*CONTEXT_LAYERS) & found(CONTEXT_FINDS))
    )
    general = (c >= 0.88) & (F.col("specificity") >= 0.34)
    here = (F.size(m) == 0) | (F.exists(m, lambda x: x != "context_span") & (F.col("concept_entity_id").isNull() | found(CONCEPT_FINDS)))
    entity = F.col("canonical_entity_id").isNotNull()
    rows = facts.where(here & F.col("target_eligible") & F.col("entity_type").isin(*SPECIFICITY) & F.when(entity, own).when(F.col("concept_entity_id").isNotNull(), general).otherwise(False))
    if seed_terms:
        rows = rows.where(~F.lower("text").isin(*seed_terms))
    rows = rows.select(
        "mention_id", F.coalesce("canonical_entity_id", "concept_entity_id").alias("target_key"), "text", F.when(entity, "canonical_entity").otherwise("concept").alias("target_kind"), "entity_type",
        F.when(entity, round_to(F.greatest(F.lit(0.84), F.least(c, F.lit(0.96))), 3)).otherwise(0.74).alias("grounding"),
    )
    one = rows.groupBy("mention_id", "target_key", "target_kind").agg(F.min_by(F.struct(F.col("text").alias("target_text"), "entity_type", "grounding"), "text").alias("b")).select("mention_id", "target_key", "target_kind", "b.*")
    named = one.where("target_kind = 'canonical_entity'").select("mention_id").distinct()
    return one.where("target_kind = 'canonical_entity'").unionByName(one.where("target_kind = 'concept'").join(named, "mention_id", "left_anti"))


def preferred_targets(targets: DataFrame) -> DataFrame:
    """(mention_id, target_key): the target of the most specific kind, where only one has it."""
    rank = F.lit(0)
    for name, value in SPECIFICITY.items():
        rank = F.when(F.col("entity_type") == name, value).otherwise(rank)
    rows = targets.withColumn("rank", rank)
    best = rows.groupBy("mention_id").agg(F.max(F.struct("rank", F.length("target_text").alias("n"), "target_key")).alias("b"), F.max("rank").alias("top"))
    ties = rows.groupBy("mention_id", "rank").agg(F.count(F.lit(1)).alias("n"))
    return best.join(ties, (best["mention_id"] == ties["mention_id"]) & (best["top"] == ties["rank"])).where(ties["n"] == 1).select(best["mention_id"], F.col("b.target_key").alias("target_key"))


def corroborate_aspects(found: DataFrame, mentions: DataFrame, text: str = "normalized_text") -> DataFrame:
    """Aspect opinions (mention_id, aspect, target_key, sentiment, confidence) with corroboration_count - opinions of the same thread, aspect,
    target, sentiment and equal normalised text, themselves included - and .03 more confidence for each further one, at most .97."""
    rows = found.join(mentions.select("mention_id", "root_id", text), "mention_id")
    counts = rows.groupBy("root_id", "aspect", "target_key", "sentiment", text).agg(F.count(F.lit(1)).alias("corroboration_count"))
    keys = [F.col(f"f.{c}").eqNullSafe(F.col(f"c.{c}")) for c in ("root_id", "aspect", "target_key", "sentiment", text)]
    joined = rows.alias("f").join(counts.alias("c"), keys).select("f.*", "c.corroboration_count")
    return joined.withColumn("confidence", round_to(F.least(F.col("confidence") + (F.col("corroboration_count") - 1) * 0.03, F.lit(0.97)), 3)).drop(text)


def override_by_feedback(facts: DataFrame, promoted: DataFrame) -> DataFrame:
    """``facts`` (kind, normalized_text, label, confidence) with the label of promoted feedback (kind, normalized_text, label, votes) of their
    text, full confidence and label_source ``feedback``; others keep theirs with ``model``."""
    best = promoted.groupBy("kind", "normalized_text").agg(F.max_by("label", F.struct("votes", "label")).alias("told"))
    rows = facts.join(best, ["kind", "normalized_text"], "left")
    told = F.col("told").isNotNull()
    return rows.withColumns({"label": F.coalesce("told", "label"), "confidence": F.when(told, 1.0).otherwise(F.col("confidence")), "label_source": F.when(told, "feedback").otherwise("model")}).drop("told")
