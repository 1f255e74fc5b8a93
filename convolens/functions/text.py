"""Text functions as Column expressions; two that the engine lacks are Arrow functions at the end.

A word character is a letter, a digit or an underscore of any script.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

W = r"\p{L}\p{N}_"
S = r"\s\x0b"
URL = r"https?://[^\s]+"
HANDLE = rf"(?<![{W}])@[{W}.]+"
HASHTAG = rf"#([{W}-]+)"
EMOJI = r"[\x{1F300}-\x{1F5FF}\x{1F600}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F700}-\x{1F77F}\x{1F900}-\x{1F9FF}\x{1FA70}-\x{1FAFF}]+"

# Short forms of social text and what they stand for.
SHORT_FORMS = {"ko": "không", "k": "không", "hok": "không", "dc": "được", "đc": "được", "vs": "với", "sp": "sản phẩm", "nv": "nhân viên"}


def squeeze(c: Column) -> Column:
    """One space for any white space, none at the ends."""
    return F.trim(F.regexp_replace(c, rf"[{S}]+", " "))


def urls(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f"({URL})"), 1)


def emojis(c: Column) -> Column:
    """Runs of emoji."""
    return F.regexp_extract_all(c, F.lit(f"({EMOJI})"), 1)


def hashtags(c: Column, explicit: Column | None = None) -> Column:
    """Lower-cased tags of the text, then explicit ones, each once, in order."""
    found = F.transform(F.regexp_extract_all(c, F.lit(HASHTAG), 1), lambda t: F.lower(t))
    if explicit is not None:
        given = F.transform(F.filter(explicit, lambda t: F.length(t) > 0), lambda t: F.regexp_replace(F.lower(t), "^#+", ""))
        found = F.concat(found, F.coalesce(given, F.array().cast("array<string>")))
    return F.array_distinct(found)


def split_hashtag(c: Column) -> Column:
    """A tag's words, parted at case changes, digits, underscores and hyphens."""
    c = F.translate(F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2"), "_-", "  ")
    c = F.regexp_replace(c, "([A-Za-z])([0-9])", "$1 $2")
    return squeeze(F.regexp_replace(c, "([0-9])([A-Za-z])", "$1 $2"))


def processing_text(c: Column, tags: Column | None = None, short_forms: dict[str, str] | None = None) -> Column:
    """Without links, handles and emoji; tags spelt out, repeated letters and marks shortened, short forms expanded."""
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, URL, " "), HANDLE, " "), EMOJI, " ")
    if tags is not None:
        out = F.aggregate(tags, out, lambda acc, t: F.replace(acc, F.concat(F.lit("#"), t), F.concat(F.lit(" "), split_hashtag(t), F.lit(" "))))
    out = F.regexp_replace(out, r"(\p{L})\1{2,}", "$1$1")
    out = squeeze(F.regexp_replace(out, r"([!?.,])\1+", "$1"))
    for short, long in (SHORT_FORMS if short_forms is None else short_forms).items():
        out = F.regexp_replace(out, rf"(?iu)(?<![{W}]){short}(?![{W}])", long)
    return squeeze(out)


def compact_text(c: Column) -> Column:
    """Lower case, punctuation gone but for # : + -."""
    return squeeze(F.translate(F.regexp_replace(F.lower(c), rf"[^{W}{S}#:/+-]", " "), "/_", "  "))


def normalize_alias(c: Column) -> Column:
    return squeeze(F.regexp_replace(F.lower(repair_mojibake(c)), rf"[^{W}{S}]", " "))


def repair_mojibake(c: Column) -> Column:
    """Text whose UTF-8 bytes were read as Latin-1, read again; only where all fits and fewer odd letters remain."""
    marks = "ÃÆâð"
    count = lambda x: F.length(x) - F.length(F.translate(x, marks, ""))
    narrow = ~c.rlike(r"[^\x{00}-\x{FF}]")
    raw = F.when(narrow, F.encode(F.when(narrow, c), "ISO-8859-1"))
    again = F.try_validate_utf8(raw.cast("string"))
    return F.when((count(c) > 0) & narrow & again.isNotNull() & (F.length(again) > 0) & (count(again) < count(c)), again).otherwise(c)


def boundary_contains(text: Column, needle: str) -> Column:
    """Is ``needle`` there as whole words, whatever the case?"""
    if not needle:
        return F.lit(False)
    quoted = "\\Q" + needle.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    return F.coalesce(text.rlike(rf"(?iu)(?<![{W}]){quoted}(?![{W}])"), F.lit(False))


def collapse_repeats(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)(.)\1{2,}", "$1$1")


def fold_accents(c: Column) -> Column:
    """Latin letters without their marks."""
    plain = {
        "a": "áàảãạăắằẳẵặâấầẩẫậäåā", "c": "çćč", "d": "đď", "e": "éèẻẽẹêếềểễệëēę", "i": "íìỉĩịîïī", "l": "ł", "n": "ñńň",
        "o": "óòỏõọôốồổỗộơớờởỡợöøō", "s": "śšş", "u": "úùủũụưứừửữựûüūů", "y": "ýỳỷỹỵÿ", "z": "źżž",
    }
    source = "".join(plain.values())
    target = "".join(k * len(v) for k, v in plain.items())
    return F.translate(c, source + source.upper(), target + target.upper())


def template_key(c: Column) -> Column:
    """Tags and numbers replaced by what they are."""
    c = F.regexp_replace(F.regexp_replace(c, "<url>", " <url> "), rf"#[{W}]+", " <tag> ")
    return squeeze(F.regexp_replace(c, r"[0-9]+", " <num> "))


def repost_like(c: Column) -> Column:
    return c.startswith("rt ") | c.startswith("repost ") | c.startswith("shared from ")


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " +"), lambda t: t != "")


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f"([{W}]+)"), 1)


def let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def runs(ordered: Column) -> Column:
    """array<struct<start, n>>: runs of equal neighbours of a sorted array."""

    def lengths(s: Column, size: Column) -> Column:
        return F.transform(s, lambda p, k: F.struct(p.alias("start"), (F.coalesce(F.get(s, k + 1), size) - p).alias("n")))

    def starts(t: Column) -> Column:
        return F.array_compact(F.transform(t, lambda x, i: F.when((i == 0) | (x != F.get(t, i - 1)), i)))

    return let(ordered, lambda t: let(starts(t), lambda s: lengths(s, F.size(t))))


def counted(items: Column) -> Column:
    """array<struct<item, n, first>>: each different item with how often and where it first stands."""
    placed = F.array_sort(F.transform(items, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

    def rows(t: Column) -> Column:
        same = runs(F.transform(t, lambda p: p["x"]))
        return F.transform(same, lambda r: F.struct(F.get(t, r["start"])["x"].alias("item"), r["n"].alias("n"), F.get(t, r["start"])["i"].alias("first")))

    return let(placed, rows)


def ngrams(items: Column, n: int) -> Column:
    """All runs of n items joined by a space; none when there are fewer."""

    def runs(t: Column) -> Column:
        out = F.transform(F.sequence(F.lit(0), F.greatest(F.size(t) - n, F.lit(0))), lambda i: F.array_join(F.slice(t, i + 1, n), " "))
        return F.when(F.size(t) >= n, out).otherwise(F.array().cast("array<string>"))

    return let(items, runs)


def shingles(c: Column, k: int = 3, chars: int = 5) -> Column:
    """Distinct word k-shingles; of shorter texts character shingles, and of the shortest the text itself."""
    t = tokens(c)
    bare = F.replace(c, F.lit(" "), F.lit(""))
    pieces = let(bare, lambda b: F.transform(F.sequence(F.lit(0), F.greatest(F.length(b) - chars, F.lit(0))), lambda i: F.substring(b, i + 1, chars)))
    short = F.when(F.length(bare) >= chars, pieces).when(F.length(c) > 0, F.array(c)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.when(F.size(t) >= k, ngrams(t, k)).otherwise(short))


def jaccard(a: Column, b: Column, empty: float = 1.0) -> Column:
    """Of two sets, unrounded; ``empty`` if neither has an element."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(empty))


def query_variants(c: Column) -> Column:
    """The text raw, as an alias, without accents and without spaces, each once."""
    alias = normalize_alias(c)
    forms = F.array(c, alias, fold_accents(alias), F.replace(alias, F.lit(" "), F.lit("")))
    return F.filter(F.array_distinct(forms), lambda x: F.length(x) > 0)


def phrase_windows(c: Column, longest: int = 4, least_chars: int = 3) -> Column:
    """All phrases of one to ``longest`` tokens with at least ``least_chars`` characters, each once."""
    t = tokens(c)
    return F.array_distinct(F.filter(F.concat(*(ngrams(t, n) for n in range(1, longest + 1))), lambda p: F.length(p) >= least_chars))


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    import unicodedata

    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def indel_ratio(a: str, b: str) -> float:
    """100 times one less the share of characters to delete or insert."""
    if not a and not b:
        return 100.0
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return 200.0 * row[-1] / (len(a) + len(b))


def token_set_ratio(a: str, b: str) -> float:
    """Best ratio among the shared words and the shared words with either rest."""
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    both = " ".join(sorted(left & right))
    one, two = (" ".join(filter(None, (both, " ".join(sorted(x))))) for x in (left - right, right - left))
    if both and (one == both or two == both):
        return 100.0
    scores = [indel_ratio(one, two)]
    if both:
        scores += [indel_ratio(both, one), indel_ratio(both, two)]
    return max(scores)


@F.pandas_udf(T.DoubleType())
def fuzzy_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else indel_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def fuzzy_token_set(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else token_set_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")
