"""Personal data: base patterns, widened by bootstrapped contextual extraction.

The base kinds are found by regular expressions.  Their hits are the seeds of a pattern-instance graph: patterns are
the words next to an instance (left, right, and both), instances are the base hits and all other identifier-like
tokens.  Rounds alternate: a pattern is trusted for a kind when enough different known instances of that kind, and
little else, stand in it; an unknown instance in trusted patterns becomes known when their joint score is high.

Everything is built-in functions and DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import settle, texts

KINDS = ("email", "ip", "card", "phone")
#: Base patterns as matched; repetition is possessive where nothing follows it and starts inside a run are skipped, so
#: that matching stays linear and iterative in very long runs and finds the same leftmost matches.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a match to be possible.
HINTS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][\x20-]?){12}[0-9]", "phone": r"\+[0-9]"}
#: Identifier-like tokens: whole words with a digit, an at sign or a spelt one.
TOKEN = r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D]*?(?:[0-9@]|\(at\)|\[at\]))[^\x20\x09-\x0D]+"
_MARK, _PLAIN = "", ""
#: The last word of what stands before a match and the first of what follows it, with the white space between.
_BEFORE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*+[\x20\x09-\x0D]*+$"
_AFTER = r"^[\x20\x09-\x0D]*+[^\x20\x09-\x0D]*+"
_PUNCTUATION = ".,;:!?\"'()[]{}<>|*#$%&=-_/\\"

ROUNDS = 3
#: A trusted pattern holds so many different known instances of its kind, and they are this share of its places.
LEAST_SUPPORT = 5
LEAST_CONFIDENCE = 0.8
#: Joint score (noisy or over trusted patterns) that makes an instance known.
LEAST_SCORE = 0.9

_SPAN = "struct<start: int, stop: int, token: string, left: string, right: string>"


def spans(text: Column, pattern: str, hint: str | None = None) -> Column:
    """All leftmost non-overlapping matches as array<struct<start, stop, token, left, right>>; code points, stop exclusive,
    left and right are the neighbouring words, as far as the next match leaves them."""
    clean = F.translate(text, _MARK, _PLAIN)
    marked = F.regexp_replace(clean, pattern, f"{_MARK}$0{_MARK}")
    pieces = F.split(marked, _MARK)
    empty = F.array().cast(f"array<{_SPAN}>")

    def step(acc: Column, piece: Column) -> Column:
        n, at = acc["n"], acc["at"]
        stop = at + F.length(piece)
        found = F.struct(at.alias("start"), stop.alias("stop"), piece.alias("token"), F.regexp_extract(acc["before"], _BEFORE, 0).alias("left"), F.lit("").alias("right"))
        odd = n % 2 == 1
        return F.struct((n + 1).alias("n"), stop.alias("at"), piece.alias("before"), F.when(odd, F.concat(acc["out"], F.array(found))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("at"), F.lit("").alias("before"), empty.alias("out"))

    def walk(parts: Column) -> Column:
        found = F.aggregate(parts, start, step, lambda acc: acc["out"])
        return F.transform(found, lambda s, i: s.withField("right", F.regexp_extract(F.get(parts, 2 * i + 2), _AFTER, 0)))

    # The pieces are a lambda's variable, so that they are made once and not for every match.
    withright = F.get(F.transform(F.array(pieces), walk), F.lit(0))
    return F.when(text.rlike(hint or pattern), withright).otherwise(empty)


def _digits(token: Column) -> Column:
    return F.regexp_replace(token, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(d: Column, i: Column) -> Column:
        v = d.cast("int")
        doubled = F.when(v > 4, 2 * v - 9).otherwise(2 * v)
        return F.when(i % 2 == 1, doubled).otherwise(v)

    each = F.transform(F.reverse(F.filter(F.split(digits, ""), lambda d: d != "")), value)
    return F.aggregate(each, F.lit(0), lambda a, v: a + v) % 10 == 0


def _valid(kind: str, token: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return token.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(_digits(token)).between(13, 19), _luhn(_digits(token))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(token)).between(9, 15)
    return F.lit(True)


def base_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, row_key, text, email, ip, card, phone, tokens): the valid spans of each kind, and the identifier-like
    tokens that overlap none of them."""
    d = texts(docs, id_col=id_col, text_col=text_col, carry=carry)
    # 128 bits name a row; of an id and its text together, so that copies don't meet in one key.
    d = d.withColumn("row_key", F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "text"))))
    for kind in KINDS:
        d = d.withColumn(kind, F.filter(spans(F.col("text"), PATTERNS[kind], HINTS[kind]), lambda s: _valid(kind, s["token"])))
    known = F.concat(*KINDS)
    apart = lambda s: ~F.exists("known", lambda k: (k["start"] < s["stop"]) & (s["start"] < k["stop"]))
    return d.withColumn("known", known).withColumn("tokens", F.filter(spans(F.col("text"), TOKEN, r"[0-9@]|\(at\)|\[at\]"), apart)).drop("known")


def _context(side: Column, last: bool) -> Column:
    words = F.filter(F.split(side, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    word = F.try_element_at(words, F.lit(-1)) if last else F.get(words, F.lit(0))
    return F.nullif(F.lower(F.translate(word, _PUNCTUATION, "")), F.lit(""))


def instances(found: DataFrame) -> DataFrame:
    """(row_key, kind or null, start, stop, token, left, right, word) of base hits and other identifier-like tokens; word:
    it fills one place between two words."""
    each = [F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s.alias("s"))) for kind in KINDS]
    each.append(F.transform("tokens", lambda s: F.struct(F.lit(None).cast("string").alias("kind"), s.alias("s"))))
    rows = found.select("row_key", F.explode(F.concat(*each)).alias("i")).select("row_key", "i.kind", "i.s.*")
    # A token takes its closing punctuation along; what is extracted ends before it.
    bare = F.regexp_replace("token", r"[.,;:!?\"')\]}>|]+$", "")
    token = F.when(F.col("kind").isNull(), bare).otherwise(F.col("token"))
    return rows.select(
        "row_key", "kind", "start", F.when(F.col("kind").isNull(), F.col("start") + F.length(bare)).otherwise(F.col("stop")).alias("stop"), token.alias("token"),
        _context(F.col("left"), True).alias("left"), _context(F.col("right"), False).alias("right"),
        (F.col("left").rlike(r"[\x20\x09-\x0D]$") & F.col("right").rlike(r"^[\x20\x09-\x0D]") & ~token.rlike(r"[\x20\x09-\x0D]")).alias("word"),
    ).where("stop > start")


def _places(found: DataFrame) -> DataFrame:
    """(cue) for each word of each text, and for each two words with one word between them."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    bare = F.transform(words, lambda w: F.lower(F.translate(w, _PUNCTUATION, "")))

    def walk(parts: Column) -> Column:
        return F.transform(parts, lambda w, i: F.struct(w.alias("one"), F.get(parts, i + 2).alias("after")))

    # The words are a lambda's variable, so that they are made once and not for every word.
    pairs = found.select(F.explode(F.get(F.transform(F.array(bare), walk), F.lit(0))).alias("p")).select("p.*").where("one <> ''")
    both = F.when(F.col("after") != "", F.concat_ws(" _ ", "one", "after"))
    return pairs.select(F.explode(F.array("one", both)).alias("cue")).where("cue is not null")


def bootstrap(found: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(new spans (row_key, kind, start, stop), trusted patterns) learned from ``found`` (see base_spans).

    A pattern's places are counted in all texts, also those without an instance: everything that stands next to its word
    or between its two words, ordinary words too, speaks against it.
    """
    seen = settle(instances(found), "pii_instances")
    sides = F.array(
        F.struct(F.lit("left").alias("side"), F.col("left").alias("cue")),
        F.struct(F.lit("right").alias("side"), F.col("right").alias("cue")),
        F.struct(F.lit("both").alias("side"), F.concat_ws(" _ ", "left", "right").alias("cue")),
    )
    with_cues = seen.select("*", F.explode(sides).alias("p")).select("*", "p.side", "p.cue").where("cue is not null and (side <> 'both' or (left is not null and right is not null))").drop("p")
    graph = settle(with_cues, "pii_graph")
    supported = graph.where("kind is not null").groupBy("kind", "side", "cue").agg(F.countDistinct("token").alias("n")).where(F.col("n") >= LEAST_SUPPORT)
    if supported.isEmpty():
        none = seen.where(F.lit(False))
        return none.select("row_key", "kind", "start", "stop"), supported.withColumn("confidence", F.lit(0.0))
    # Later rounds know more tokens, so a cue stays when it has enough of them, known or not.
    cues = settle(graph.groupBy("side", "cue").agg(F.countDistinct("token").alias("n")).where(F.col("n") >= LEAST_SUPPORT).select("cue").distinct(), "pii_cues")
    places = settle(_places(found).join(cues, "cue", "left_semi").groupBy("cue").agg(F.count(F.lit(1)).alias("places")), "pii_places")
    graph = settle(graph.join(places, "cue", "left"), "pii_graph_sized")
    known = settle(seen.where("kind is not null").select("kind", "token").distinct(), "pii_known")
    patterns = None
    for k in range(rounds):
        # Repeats of one token count once for support, but every place counts against.
        held = graph.drop("kind").join(known, "token")
        # Between two words, places are those of one word; what is longer or touches them comes on top.
        size = F.when(F.col("side") == "both", F.greatest(F.col("hits"), F.coalesce("places", F.lit(0)) + F.col("longer"))).otherwise(F.greatest("hits", "places"))
        in_all = graph.groupBy("side", "cue").agg(
            F.countDistinct("row_key", "start", "stop").alias("hits"), F.countDistinct(F.when(~F.col("word"), F.struct("row_key", "start", "stop"))).alias("longer"), F.max("places").alias("places")
        ).withColumn("size", size)
        scored = held.groupBy("side", "cue", "kind").agg(F.countDistinct("token").alias("support"), F.countDistinct("row_key", "start", "stop").alias("good"))
        patterns = scored.join(in_all, ["side", "cue"]).withColumn("confidence", F.col("good") / F.col("size"))
        patterns = settle(patterns.where((F.col("support") >= LEAST_SUPPORT) & (F.col("confidence") >= LEAST_CONFIDENCE)).select("side", "cue", "kind", "support", "confidence"), f"pii_patterns{k}")
        open_ = graph.where("kind is null").drop("kind").join(known, "token", "left_anti")
        score = 1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))
        scores = open_.join(patterns, ["side", "cue"]).groupBy("token", "kind").agg(score.alias("score")).where(F.col("score") >= LEAST_SCORE)
        # A token that two kinds claim goes to the higher score, then to the first by name.
        best = scores.groupBy("token").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind")).select("kind", "token")
        new = settle(best, f"pii_new{k}")
        if new.isEmpty():
            break
        known = settle(known.unionByName(new), f"pii_known{k}")
    extra = seen.where("kind is null").drop("kind").join(known, "token").select("row_key", "kind", "start", "stop").distinct()
    return extra, patterns


def personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, email, ip, card, phone, all_spans) for every row of ``docs``.

    The kinds are the base spans; all_spans is array<struct<rank, start, stop>> (rank: the kind's place in KINDS) of
    base and learned spans, sorted.  Null texts count as empty.  Repeated rows get equal results.
    """
    found = settle(base_spans(docs, id_col=id_col, text_col=text_col, carry=carry), "pii_base")
    extra, _ = bootstrap(found, rounds)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    added = settle(extra.groupBy("row_key").agg(F.collect_set(F.struct(rank.alias("rank"), "start", "stop")).alias("added")), "pii_added")
    own = F.concat(*(F.transform(kind, lambda s: F.struct(F.lit(k).alias("rank"), s["start"].alias("start"), s["stop"].alias("stop"))) for k, kind in enumerate(KINDS)))
    none = F.array().cast("array<struct<rank: int, start: int, stop: int>>")
    out = found.join(added, "row_key", "left").withColumn("all_spans", F.array_sort(F.concat(own, F.coalesce("added", none))))
    return out.select("doc_id", "text", *carry, *KINDS, "all_spans")


def digest(spans_col: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(found: DataFrame, *, text_col: str = "text") -> Column:
    """The text with every span of all_spans replaced by its kind in brackets; overlapping spans become one."""
    text = found[text_col]
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    ordered = F.array_sort(F.transform(found["all_spans"], lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["rank"].alias("rank"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        between = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["rank"]))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.when(s["start"] >= acc["at"], between).otherwise(acc["out"]).alias("out"))

    tail = F.aggregate(ordered, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size("all_spans") > 0, tail).otherwise(text)
