"""Phrases as Column expressions: spellings, likeness, windows, significance and readability."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import round_to
from .text import W, collapse_repeats, fold_accents, let, ngrams, normalize_alias, squeeze, tokens

# Words that say nothing of a topic, by what they are kept out of.
NOISE_WORDS = ("ban", "biet", "cho", "co", "cua", "haha", "hehe", "hello", "khong", "la", "nay", "nhe", "ok", "okay", "roi", "the", "thi", "this", "thoi", "va", "voi")
GENERIC_WORDS = ("a", "an", "and", "ban", "cho", "co", "cua", "di", "khong", "la", "nay", "ok", "the", "this", "va", "voi")
STOP_WORDS = ("a", "an", "and", "but", "cho", "co", "cua", "for", "hay", "la", "the", "this", "va", "voi", "with")
_PLAIN_WORD = rf"[^{W}\s\x0b]"


def _kept(forms: Iterable[Column]) -> Column:
    """The non-blank ones trimmed, each once, in order."""
    cleaned = F.transform(F.array(*forms), lambda x: F.trim(x))
    return F.array_distinct(F.filter(cleaned, lambda x: x != ""))


def boundary_spans(text: Column, needle: str) -> Column:
    """array<struct<start, stop>> of ``needle`` as whole words, whatever the case; code points, stop exclusive."""
    empty = F.array().cast("array<struct<start: int, stop: int>>")
    if not needle:
        return empty
    quoted = "\\Q" + needle.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    mark = "\ue000"
    marked = F.regexp_replace(F.translate(text, mark, ""), rf"(?iu)(?<![{W}])({quoted})(?![{W}])", f"{mark}$1{mark}")

    def step(acc: Column, piece: Column) -> Column:
        stop = acc["at"] + F.length(piece)
        hit = F.struct(acc["at"].alias("start"), stop.alias("stop"))
        return F.struct((acc["n"] + 1).alias("n"), stop.alias("at"), F.when(acc["n"] % 2 == 1, F.concat(acc["out"], F.array(hit))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("at"), empty.alias("out"))
    return F.coalesce(F.aggregate(F.split(marked, mark), start, step, lambda acc: acc["out"]), empty)


def phrase_variants(c: Column) -> Column:
    """Nine spellings of a phrase: as it is, as an alias, without leading # and @, without accents (and as an alias), run
    together, with repeated letters shortened (and run together), and parted at slashes and hyphens."""
    alias = normalize_alias(c)
    folded = fold_accents(c)
    together = lambda x: F.replace(x, F.lit(" "), F.lit(""))
    long = lambda x: F.when(F.length(x) >= 4, x).otherwise("")
    short = normalize_alias(collapse_repeats(c))
    return _kept((c, alias, normalize_alias(F.regexp_replace(c, "^[#@]+", "")), folded, normalize_alias(folded), long(together(alias)), short, long(together(short)), normalize_alias(F.translate(c, "/-", "  "))))


def taxonomy_form(c: Column) -> Column:
    """Lower case, underscores and hyphens as spaces."""
    return squeeze(F.translate(F.lower(c), "_-", "  "))


def prototype_variants(c: Column) -> Column:
    """A taxonomy phrase as it is, plain, without accents and run together."""
    plain = taxonomy_form(c)
    return _kept((c, plain, fold_accents(plain), F.replace(plain, F.lit(" "), F.lit(""))))


def lexical_similarity(a: Column, b: Column) -> Column:
    """1 for phrases that are equal run together, else the share of their words that they have in common; 0 for none."""
    x, y = taxonomy_form(a), taxonomy_form(b)
    compact = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    s, t = F.array_distinct(tokens(x)), F.array_distinct(tokens(y))
    share = F.size(F.array_intersect(s, t)) / F.greatest(F.size(F.array_union(s, t)), F.lit(1))
    return F.when((F.size(s) == 0) | (F.size(t) == 0), 0.0).when(compact(x) == compact(y), 1.0).otherwise(share)


def phrase_windows(c: Column, longest: int = 4, least_chars: int = 3, generic: Iterable[str] = GENERIC_WORDS) -> Column:
    """All phrases of one to ``longest`` tokens with at least ``least_chars`` characters, each once, but for those of generic
    words alone."""
    t = tokens(c)
    said = lambda p: F.exists(F.split(p, " "), lambda w: ~w.isin(*generic))
    return F.array_distinct(F.filter(F.concat(*(ngrams(t, n) for n in range(1, longest + 1))), lambda p: (F.length(p) >= least_chars) & said(p)))


def significant_tokens(c: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Words of three characters or more, or with a digit, that are no stop words."""
    words = F.regexp_extract_all(c, F.lit(rf"([{W}]+)"), 1)
    return F.filter(words, lambda w: ~w.isin(*stop_words) & ((F.length(w) >= 3) | w.rlike("[0-9]")))


def significant_phrases(c: Column, stop_words: Iterable[str] = STOP_WORDS, noise: Iterable[str] = ()) -> Column:
    """Runs of one to three significant tokens, each once, without noise; a lone one needs five characters or a digit."""
    lone = F.filter(significant_tokens(c, stop_words), lambda w: (F.length(w) >= 5) | w.rlike("[0-9]"))
    out = let(significant_tokens(c, stop_words), lambda t: F.concat(ngrams(t, 2), ngrams(t, 3)))
    found = F.array_distinct(F.concat(lone, out))
    return F.filter(found, lambda p: ~p.isin(*noise)) if noise else found


def _score(start: float, *parts: tuple[Column, float]) -> Column:
    total = F.lit(start)
    for condition, value in parts:
        total = total + F.when(F.coalesce(condition, F.lit(False)), value).otherwise(0.0)
    return round_to(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


# Fixed values in the next three functions: what each property of a phrase adds.
def hygiene(c: Column, noise: Iterable[str] = NOISE_WORDS) -> Column:
    """How fit a phrase is as evidence of a topic, 0 to 1."""
    alias = normalize_alias(c)

    def body(t: Column) -> Column:
        informative = F.exists(t, lambda w: ~w.isin(*noise) & ((F.length(w) >= 4) | w.rlike(r"\p{Nd}")))
        noisy = F.exists(t, lambda w: w.isin(*noise))
        score = _score(0.34, (informative, 0.28), (F.size(t) >= 2, 0.18), (alias.rlike(r"\p{Nd}"), 0.08), (noisy, -0.12))
        return F.when((F.size(t) == 0) | ((F.size(t) == 1) & noisy), 0.0).otherwise(score)

    return let(tokens(alias), body)


def artifact_readability(c: Column, noise: Iterable[str] = NOISE_WORDS) -> Column:
    """How well a phrase reads as a topic's evidence, 0 to 1."""
    alias = normalize_alias(c)

    def body(t: Column) -> Column:
        first = F.get(t, F.lit(0))
        score = _score(0.34, (F.size(t) >= 2, 0.2), (F.exists(t, lambda w: w.isin(*noise)), -0.18), (F.exists(t, lambda w: F.contains(w, F.lit("http"))), -0.3), ((F.size(t) == 1) & (F.length(first) < 4) & ~first.rlike(r"\p{Nd}"), -0.14))
        return F.when(F.size(t) == 0, 0.0).otherwise(score)

    return let(tokens(alias), body)


def label_readability(c: Column, generic: Iterable[str] = GENERIC_WORDS) -> Column:
    """How well a phrase reads as a topic's label, 0 to 1; here tags, handles and links still show."""
    clean = squeeze(F.lower(c))

    def body(t: Column) -> Column:
        score = _score(
            0.36, (F.size(t) >= 2, 0.18), (F.exists(t, lambda w: w.isin(*generic)), -0.18), (F.exists(t, lambda w: w.startswith("#") | w.startswith("@")), -0.34),
            (F.exists(t, lambda w: F.contains(w, F.lit("http"))), -0.34), (F.exists(t, lambda w: F.length(w) >= 5), 0.14), (clean.rlike(r"\p{Nd}"), 0.08),
        )
        return F.when(F.size(t) == 0, 0.0).otherwise(score)

    return let(tokens(squeeze(F.translate(clean, "/", " "))), body)


#: What an encoder's text begins with, by what it is for.
PURPOSES = {"query": "query:", "linking": "entity:", "clustering": "topic:", "passage": ""}


def prepare(rows: DataFrame, lexicon: Iterable[str], purpose: str = "passage", *, text_col: str = "text", out_col: str = "prepared") -> DataFrame:
    """``rows`` with the text an encoder gets: folded to NFKC and lower case, the longest lexicon phrase at each place joined by
    underscores, and the purpose in front; a blank text is <empty>.  A null text stays null."""
    phrases: dict[str, list[tuple[str, ...]]] = {}
    for phrase in lexicon:
        words = tuple(_surface(phrase).split())
        if len(words) > 1:
            phrases.setdefault(words[0], []).append(words)
    for found in phrases.values():
        found.sort(key=lambda w: (-len(w), w))
    prefix = PURPOSES[purpose]

    @F.pandas_udf("string")
    def run(texts):
        return texts.map(lambda t: None if t is None else f"{prefix} {_joined(_surface(t).split(), phrases) or '<empty>'}".strip())

    return rows.withColumn(out_col, run(F.col(text_col)))


def _surface(text: str) -> str:
    import unicodedata

    return " ".join(unicodedata.normalize("NFKC", text).replace("_", " ").replace("-", " ").split()).casefold()


def _joined(words: list[str], phrases: dict[str, list[tuple[str, ...]]]) -> str:
    out, at = [], 0
    while at < len(words):
        hit = next((p for p in phrases.get(words[at], ()) if tuple(words[at : at + len(p)]) == p), words[at : at + 1])
        out.append("_".join(hit))
        at += len(hit)
    return " ".join(out)
