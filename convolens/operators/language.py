"""Language hints and gate, scripts, and text quality flags."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..functions.text import W, squeeze, tokens

# Code-point ranges of scripts, in the order they are tried.
SCRIPTS = {"ja": ("3040", "30FF"), "zh": ("4E00", "9FFF"), "ko": ("AC00", "D7AF"), "ru": ("0400", "04FF"), "ar": ("0600", "06FF"), "hi": ("0900", "097F"), "th": ("0E00", "0E7F")}
UNSUPPORTED = (("0900", "097F"), ("0E00", "0E7F"), ("0980", "09FF"), ("4E00", "9FFF"), ("3040", "30FF"), ("AC00", "D7AF"))
# Penalties of quality flags, and the order in which flags name a text.
PENALTY = {"unsupported_language": 0.9, "reaction_only": 0.45, "low_information": 0.3, "url_heavy": 0.2, "template_like": 0.2, "emoji_dominant": 0.15}
LABELS = (("unsupported_language", "unsupported_language"), ("no_semantic_content", "no_semantic_content"), ("reaction_only", "reaction_only"), ("emoji_dominant", "low_information"), ("low_information", "low_information"), ("url_heavy", "spam_like"), ("template_like", "spam_like"))
REACTIONS = ("ok", "oke", "haha", "hehe", "nice")
#: Frequent words that hint at a language; a deployment passes its own.
HINTS = {
    "en": ("the", "and", "of", "to", "is", "that", "this", "with"),
    "fr": ("le", "la", "les", "des", "est", "dans", "que", "une"),
    "de": ("der", "die", "das", "und", "ist", "nicht", "mit", "ein"),
    "es": ("el", "los", "las", "que", "del", "por", "una", "con"),
}


# Words that hint at a language, and letters that only Vietnamese writes among these.
LATIN_HINTS = {
    "en": ("and", "are", "bad", "but", "charging", "for", "good", "link", "not", "review", "slow", "that", "the", "this", "with"),
    "vi": ("ban", "bác", "cho", "của", "cua", "đẹp", "dep", "khong", "la", "may", "nha", "nhe", "thoi", "vay", "voi", "xe", "vậy", "nhé", "thôi", "máy", "không", "mà"),
    "es": ("con", "de", "el", "esta", "muy", "para", "pero", "que", "una", "y"),
    "fr": ("avec", "ce", "dans", "des", "est", "mais", "pas", "pour", "que", "une"),
    "de": ("aber", "das", "dem", "die", "gut", "mit", "nicht", "und"),
    "pt": ("com", "esta", "mais", "muito", "nao", "para", "por", "que", "uma", "voce"),
    "id": ("banget", "dan", "dengan", "ini", "itu", "tidak", "untuk", "yang"),
}
VI_MARKERS = "đăâêôơư"
# Vocabularies of the gate between Vietnamese and English, Indonesian told apart.
VI_WORDS = (
    "ai", "anh", "bác", "ban", "bạn", "cham", "chua", "cho", "co", "của", "cua", "da", "được", "giao", "khong", "không", "là", "la", "mấy", "mình", "này", "nha", "nhé", "nhanh", "nhung", "nay", "roi", "rồi", "sao", "tang", "thu",
    "thế", "thì", "và", "vậy", "ve", "với", "xe",
)
EN_WORDS = (
    "all", "and", "are", "back", "battery", "beats", "but", "charging", "cleaner", "day", "design", "drop", "for", "feed", "good", "issue", "is", "last", "launch", "looks", "matte", "most", "my", "nice", "price", "quality", "routine",
    "service", "slow", "soft", "still", "support", "the", "than", "this", "tints", "with",
)
ID_WORDS = ("ada", "aja", "banget", "bagus", "dan", "dengan", "ini", "itu", "kerja", "mau", "nya", "pabrik", "produk", "sangat", "tidak", "untuk", "yang")
EN_SHORT = ("flashsale", "delivery", "battery", "charging", "launch", "support")
VI_MARKS = "ăâđêôơưàáạảãầấậẩẫằắặẳẵèéẹẻẽềếệểễìíịỉĩòóọỏõồốộổỗờớợởỡùúụủũừứựửữỳýỵỷỹ"


def canonical_label(c: Column) -> Column:
    """A language label's primary part in lower case; old codes mapped, missing is unknown."""
    clean = F.translate(F.regexp_replace(F.lower(F.trim(c)), "^__label__", ""), "_", "-")
    first = F.substring_index(clean, "-", 1)
    kept = F.when(first.rlike("^[a-z]{2,3}$"), first).when(F.length(clean) > 0, clean).otherwise("unknown")
    return F.when(c.isNull(), "unknown").when(first == "jp", "ja").when(first == "in", "id").otherwise(kept)


def _count(c: Column, ranges: str) -> Column:
    return F.length(F.regexp_replace(c, f"[^{ranges}]", ""))


def _range(pair: tuple[str, str]) -> str:
    return rf"\x{{{pair[0]}}}-\x{{{pair[1]}}}"


def script_counts(c: Column) -> dict[str, Column]:
    return {name: _count(c, _range(pair)) for name, pair in SCRIPTS.items()}


def script_shares(c: Column) -> Column:
    """map<script, share> of the scripts that occur, to four places."""
    counts = script_counts(c)
    total = sum(counts.values(), F.lit(0))
    entries = F.array(*(F.when(n > 0, F.struct(F.lit(k), round_to(n / F.greatest(total, F.lit(1))))) for k, n in counts.items()))
    return F.map_from_entries(F.array_compact(entries))


def unsupported_script_share(c: Column) -> Column:
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    odd = F.length(F.regexp_replace(F.regexp_replace(c, r"[^\p{L}]", ""), f"[^{''.join(map(_range, UNSUPPORTED))}]", ""))
    return F.when(letters > 0, odd / F.greatest(letters, F.lit(1))).otherwise(F.lit(0.0))


def hint_scores(c: Column, hints: dict[str, tuple[str, ...]] | None = None) -> dict[str, Column]:
    """Share of tokens that hint at each language, at most .96."""
    t = tokens(F.lower(F.regexp_replace(c, rf"[^{W}\s]", " ")))
    n = F.greatest(F.size(t), F.lit(1))
    count = lambda values: F.size(F.filter(t, lambda x: x.isin(*values)))
    return {lang: round_to(F.least(count(values) / n, F.lit(0.96))) for lang, values in (hints or HINTS).items()}


def heuristic_scores(c: Column) -> dict[str, Column]:
    """Score of each language, 0 for none: share of hinting words (a little more for Vietnamese beside letters beyond ASCII), at least .52 for
    Vietnamese where a letter of its own stands, and .55 to .98 by the share of letters of a language's own script."""
    t = tokens(squeeze(F.lower(F.regexp_replace(c, rf"[^{W}\s]", " "))))
    n = F.greatest(F.size(t), F.lit(1))
    one_of = lambda words: lambda x: x.isin(*words)
    out = {}
    for lang, words in LATIN_HINTS.items():
        hits = F.size(F.filter(t, one_of(words)))
        bonus = F.when(c.rlike(r"[^\x00-\x7f]"), 0.12).otherwise(0.0) if lang == "vi" else F.lit(0.0)
        out[lang] = F.when(hits > 0, round_to(F.least(hits / n + bonus, F.lit(0.96)))).otherwise(0.0)
    out["vi"] = F.when(F.lower(c).rlike(f"[{VI_MARKERS}]"), F.greatest(out["vi"], F.lit(0.52))).otherwise(out["vi"])
    counts = script_counts(c)
    total = sum(counts.values(), F.lit(0))
    for lang, count in counts.items():
        out[lang] = F.when(count > 0, round_to(F.least(0.55 + round_to(count / F.greatest(total, F.lit(1))) * 0.4, F.lit(0.98)))).otherwise(0.0)
    return out


def best_hint(c: Column, hints: dict[str, tuple[str, ...]] | None = None, mixed_confidence: float = 0.55, mixed_gap: float = 0.12) -> Column:
    """struct<language, confidence>: the best hint, ``mixed`` when two are strong and close, else unknown."""
    scores = hint_scores(c, hints)
    ranked = F.array_sort(F.array_compact(F.array(*(F.when(s > 0, F.struct((-s).alias("s"), F.lit(k).alias("l"))) for k, s in scores.items()))))
    first, second = F.get(ranked, F.lit(0)), F.get(ranked, F.lit(1))
    mixed = (-second["s"] >= mixed_confidence * 0.45) & (second["s"] - first["s"] <= mixed_gap)
    both = round_to(F.greatest((-first["s"] - second["s"]) / 2.0, F.lit(mixed_confidence)))
    return (
        F.when(F.size(ranked) == 0, F.struct(F.lit("unknown").alias("language"), F.lit(0.0).alias("confidence")))
        .when(F.coalesce(mixed, F.lit(False)), F.struct(F.lit("mixed").alias("language"), both.alias("confidence")))
        .otherwise(F.struct(first["l"].alias("language"), (-first["s"]).alias("confidence")))
    )


@dataclass(frozen=True)
class Gate:
    """Vocabulary and thresholds of the language gate: two supported languages and one that is told apart."""

    first: str = "vi"
    second: str = "en"
    first_words: frozenset[str] = frozenset()
    second_words: frozenset[str] = frozenset()
    other_words: frozenset[str] = frozenset()
    other: str = "id"
    #: Letters that only the first language writes.
    marks: str = ""
    names: frozenset[str] = frozenset()
    short_forms: frozenset[str] = field(default_factory=frozenset)

    def decide(self, raw: Column, compact: Column, provider_language: Column) -> Column:
        """struct<language, supported, reason>: nine ordered decisions over word counts."""
        t = F.transform(F.regexp_extract_all(compact, F.lit(r"([\p{L}0-9][\p{L}0-9+-]*)"), 1), lambda x: F.lower(x))
        inside = lambda x, values: x.isin(*values) if values else F.lit(False)
        marked = lambda x: F.length(F.translate(x, self.marks, "")) < F.length(x) if self.marks else F.lit(False)
        digit = lambda x: x.rlike("[0-9]")
        semantic = F.filter(t, lambda x: ~inside(x, self.names) & ~digit(x) & (F.length(x) >= 2) & x.rlike(r"^\p{L}+$"))
        short = lambda x: (F.length(x) <= 3) & x.rlike("^[a-z]+$") & ~inside(x, self.second_words) & ~inside(x, self.other_words)
        count = lambda items, f: F.size(F.filter(items, f))
        n = F.greatest(F.size(t), F.lit(1))
        n_sem = F.size(semantic)
        entity = count(t, lambda x: digit(x) | inside(x, self.names) | short(x))
        first_sem = count(semantic, lambda x: inside(x, self.first_words) | marked(x))
        second_sem = count(semantic, lambda x: inside(x, self.second_words))
        ascii_sem = count(semantic, lambda x: x.rlike("^[\\x00-\\x7f]{4,}$") & ~inside(x, self.other_words))
        has_mark = marked(F.lower(raw))
        p = canonical_label(provider_language)
        a = count(t, lambda x: inside(x, self.first_words)) / n + F.when(has_mark, 0.28).otherwise(0.0) + F.when(p == self.first, 0.18).when(p == "mixed", 0.08).otherwise(0.0)
        b = count(t, lambda x: inside(x, self.second_words)) / n + F.when(p == self.second, 0.16).when(p == "mixed", 0.08).otherwise(0.0)
        odd = count(t, lambda x: inside(x, self.other_words)) / n + F.when(p == self.other, 0.18).otherwise(0.0) + unsupported_script_share(raw)
        open_provider = p.isin(self.second, "mixed", "unknown")
        verdict = lambda lang, reason: F.struct(F.lit(lang).alias("language"), F.lit(lang != "unsupported").alias("supported"), F.lit(reason).cast("string").alias("reason"))
        lone = (n_sem == 1) & inside(F.get(semantic, F.lit(0)), self.short_forms) & open_provider
        return (
            F.when(F.size(t) == 0, verdict("unsupported", "no_semantic_content"))
            .when((odd >= 0.42) & (odd > a + b + 0.08), verdict("unsupported", "unsupported_language"))
            .when((n_sem == 0) & (entity > 0), verdict("unsupported", "non_vi_en_latin_noise"))
            .when(n_sem == 0, verdict("unsupported", "no_semantic_content"))
            .when(((a >= 0.18) | (first_sem >= 2) | has_mark) & ((b >= 0.12) | (second_sem >= 1)) & (n_sem >= 2) & (odd < 0.24), verdict("mixed", None))
            .when((first_sem >= 1) & (ascii_sem >= 2) & (n_sem >= 4) & open_provider & (odd < 0.18), verdict("mixed", None))
            .when((a >= 0.2) | (first_sem >= 2), verdict(self.first, None))
            .when((((b >= 0.2) & (n_sem >= 2)) | lone) & (odd < 0.18), verdict(self.second, None))
            .when((entity / n >= 0.5) & (a + b < 0.18), verdict("unsupported", "non_vi_en_latin_noise"))
            .when((a + b < 0.18) & (n_sem <= 2), verdict("unsupported", "low_vi_en_evidence"))
            .otherwise(verdict("unsupported", "unsupported_language"))
        )


#: The gate between Vietnamese and English.
VI_EN = Gate("vi", "en", frozenset(VI_WORDS), frozenset(EN_WORDS), frozenset(ID_WORDS), "id", VI_MARKS, short_forms=frozenset(EN_SHORT))


def quality_flags(raw: Column, normalized: Column, compact: Column, url_count: Column, emoji_count: Column, supported: Column) -> Column:
    """Sorted flags of a text."""
    t = F.filter(tokens(compact), lambda x: ~x.isin("url", "mention"))
    n = F.size(t)
    reaction = ((n == 0) & (F.length(raw) > 0)) | ((n <= 3) & F.lower(normalized).isin(*REACTIONS))
    rules = {
        "unsupported_language": ~supported,
        "emoji_dominant": (n <= 2) & (emoji_count >= 2),
        "low_information": (n <= 2) & (url_count == 0),
        "reaction_only": reaction,
        "url_heavy": (url_count >= 2) | ((url_count > 0) & (n <= 3)),
        "template_like": (F.size(F.array_distinct(t)) <= 2) & (n >= 4),
        "no_semantic_content": n == 0,
    }
    return F.array_sort(F.array_compact(F.array(*(F.when(cond, F.lit(name)) for name, cond in rules.items()))))


def quality_label(flags: Column) -> Column:
    out = None
    for flag, label in LABELS:
        has = F.array_contains(flags, flag)
        out = F.when(has, label) if out is None else out.when(has, label)
    return out.otherwise("normal")


def quality_score(flags: Column) -> Column:
    score = F.lit(1.0)
    for flag, penalty in PENALTY.items():
        score = score - F.when(F.array_contains(flags, flag), penalty).otherwise(0.0)
    return round_to(F.greatest(score, F.lit(0.05)))


def blended(model: Column, text: Column, hints: dict[str, tuple[str, ...]] | None = None, mixed_confidence: float = 0.55, mixed_gap: float = 0.12, share: float = 0.72) -> Column:
    """struct<language, confidence> from a model's best two labels (``model``: array<struct<label, probability>>) and the hints, which
    count for ``share`` of their score; each language has the better of both, and the choice is that of best_hint."""
    zero = F.array().cast("array<struct<l: string, s: double>>")
    top = F.slice(F.array_sort(F.transform(F.coalesce(model, F.array().cast("array<struct<label: string, probability: double>>")), lambda x: F.struct((-x["probability"]).alias("n"), canonical_label(x["label"]).alias("l")))), 1, 2)
    given = F.transform(top, lambda x: F.struct(x["l"].alias("l"), round_to(-x["n"]).alias("s")))
    guessed = F.filter(F.array(*(F.struct(F.lit(k).alias("l"), round_to(v * share).alias("s")) for k, v in hint_scores(text, hints).items())), lambda x: x["s"] > 0)
    both = F.concat(given, guessed, zero)
    names = F.array_distinct(F.transform(both, lambda x: x["l"]))
    best = F.array_sort(F.transform(names, lambda n: F.struct((-F.array_max(F.transform(F.filter(both, lambda x: x["l"] == n), lambda x: x["s"]))).alias("s"), n.alias("l"))))
    one, two = F.get(best, F.lit(0)), F.get(best, F.lit(1))
    mixed = F.coalesce((-two["s"] >= mixed_confidence * 0.45) & (two["s"] - one["s"] <= mixed_gap), F.lit(False))
    none = F.struct(F.lit("unknown").alias("language"), F.lit(0.0).alias("confidence"))
    return (
        F.when((F.size(best) == 0) | (F.trim(text) == ""), none)
        .when(mixed, F.struct(F.lit("mixed").alias("language"), round_to(F.greatest((-one["s"] - two["s"]) / 2.0, F.lit(mixed_confidence))).alias("confidence")))
        .otherwise(F.struct(one["l"].alias("language"), (-one["s"]).alias("confidence")))
    )
