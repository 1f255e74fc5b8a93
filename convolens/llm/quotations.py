"""Quotation linking for conversations.

Messages are cut into their own words and quoted passages with nested levels.  Normalised passages are hashed and
joined to the messages that first held them; a message's best link is what it replies to, chains of replies make
threads, and ordering by (conversation, thread, place, turn) gives conversations in reply order without quotes: a
message stands right after what it replies to and the earlier replies to that.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import settle

_QUOTED = re.compile(r"^[ \t]*((?:>[ \t]?)+)(.*)$")
#: What a line that introduces a quotation ends with, before a colon.
INTRODUCING = ("wrote", "schrieb", "a écrit", "escribió")
#: Characters of a normalised passage from which it may link to another conversation; shorter ones recur by chance.
FAR_CHARS = 16
_WORD = re.compile(r"\w")

_PARSED = (
    "conv_id long, turn long, role string, message long, text string, max_level int, "
    "quotes array<struct<place: int, level: int, digest: string, chars: int, whole: boolean>>, own array<string>"
)


def normal(text: str) -> str:
    """Case, white space and outer punctuation don't tell passages apart."""
    words = " ".join(text.casefold().split())
    first = _WORD.search(words)
    if first is None:
        return ""
    stop = len(words)
    while not (words[stop - 1].isalnum() or words[stop - 1] == "_"):
        stop -= 1
    return words[first.start() : stop]


def introduces(line: str) -> bool:
    """Does the line announce a quotation, as in "Ann wrote:"?"""
    said = line.rstrip()
    if not said.endswith(":"):
        return False
    said = said[:-1].rstrip().casefold()
    return any(said.endswith(x) and not said[: -len(x)][-1:].isalnum() for x in INTRODUCING)


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode(), digest_size=16).hexdigest()


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """The message's own text, and its quoted passages as (level, text): runs of lines of one level."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    last = 0
    for line in (text or "").split("\n"):
        found = _QUOTED.match(line)
        level = found[1].count(">") if found else 0
        if not level:
            own.append(line)
        elif level == last:
            passages[-1][1].append(found[2])
        else:
            if own and introduces(own[-1]):
                own.pop()
            passages.append((level, [found[2]]))
        last = level
    return "\n".join(own).strip(), [(level, "\n".join(lines).strip()) for level, lines in passages]


def _units(text: str) -> list[tuple[str, bool]]:
    """What of a passage can be looked up: all of it, and its lines when it has several."""
    whole = normal(text)
    lines = [x for x in map(normal, text.split("\n")) if x]
    out = [(whole, True)] if whole else []
    return out + ([(x, False) for x in dict.fromkeys(lines)] if len(lines) > 1 else [])


def parsed(messages: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Each message with its own text, the digests of its own passages and those it quotes."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        quote = pa.struct([("place", pa.int32()), ("level", pa.int32()), ("digest", pa.string()), ("chars", pa.int32()), ("whole", pa.bool_())])
        names = ["conv_id", "turn", "role", "message", "text", "max_level", "quotes", "own"]
        for batch in batches:
            texts, levels, quotes, own = [], [], [], []
            for raw in batch.column(4):
                body, found = parse(raw.as_py())
                texts.append(body)
                levels.append(max((level for level, _ in found), default=0))
                quotes.append([{"place": k, "level": level, "digest": _digest(u), "chars": len(u), "whole": w} for k, (level, t) in enumerate(found) for u, w in _units(t)])
                own.append([_digest(u) for u, _ in _units(body)])
            cols = [pa.array(texts, pa.string()), pa.array(levels, pa.int32()), pa.array(quotes, pa.list_(quote)), pa.array(own, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), *cols], names=names)

    conv, turn, role, text = (messages[c] for c in (conv_col, turn_col, role_col, text_col))
    rows = messages.select(
        conv.cast("long").alias("conv_id"), turn.cast("long").alias("turn"), role.cast("string").alias("role"), F.xxhash64(conv, turn, role, text).alias("message"), text.cast("string").alias("text")
    )
    return rows.mapInArrow(run, _PARSED)


def threads(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, thread) from (conv_id, turn, reply_to) with reply_to < turn: the turn at each chain's end, by
    pointer doubling."""
    up = settle(replies.select("conv_id", "turn", F.col("reply_to").alias("thread")), "threads")
    while True:
        step = up.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("further"))
        up = settle(up.join(step, ["conv_id", "thread"], "left").select("conv_id", "turn", F.coalesce("further", "thread").alias("thread"), F.col("further").isNotNull().alias("moved")), "threads")
        moved = up.agg(F.max(F.col("moved").cast("int"))).first()[0]
        up = up.drop("moved")
        if not moved:
            return up


def _followers(rows: DataFrame, group: tuple[str, ...], by: str, bucket: int = 1024) -> DataFrame:
    """``rows`` with ``next``: the next greater value of ``by`` in the group.  Groups are cut by value, so a crowded one is
    not sorted in one task; only the buckets' least values meet."""
    cut = rows.withColumn("__bucket", F.floor(F.col(by) / bucket))
    inside = cut.withColumn("next", F.lead(by).over(Window.partitionBy(*group, "__bucket").orderBy(by)))
    firsts = cut.groupBy(*group, "__bucket").agg(F.min(by).alias("__first"))
    after = firsts.withColumn("__after", F.lead("__first").over(Window.partitionBy(*group).orderBy("__bucket"))).drop("__first")
    return inside.join(after, [*group, "__bucket"]).withColumn("next", F.coalesce("next", "__after")).drop("__bucket", "__after")


def places(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, place): how many messages of its thread come before a message in reply order, for every message
    that replies or is replied to.

    The tree's tour (enter a message, its replies by turn, leave it) is a linked list; pointer doubling counts what is
    left of it from each step, so a chain of any length takes logarithmically many joins."""
    child = replies.select("conv_id", "turn", F.col("reply_to").alias("parent"))
    after = _followers(child, ("conv_id", "parent"), "turn")
    first = child.groupBy("conv_id", F.col("parent").alias("turn")).agg(F.min("turn").alias("first"))
    nodes = child.select("conv_id", "turn").unionByName(child.select("conv_id", F.col("parent").alias("turn"))).distinct()
    step = lambda turn, leaving: F.struct(turn.alias("turn"), F.lit(leaving).alias("leaving"))
    enter = nodes.join(first, ["conv_id", "turn"], "left").select(
        "conv_id", step(F.col("turn"), False).alias("at"), F.when(F.col("first").isNotNull(), step(F.col("first"), False)).otherwise(step(F.col("turn"), True)).alias("to"), F.lit(1).cast("long").alias("left")
    )
    leave = nodes.join(after, ["conv_id", "turn"], "left").select(
        "conv_id", step(F.col("turn"), True).alias("at"), F.when(F.col("next").isNotNull(), step(F.col("next"), False)).when(F.col("parent").isNotNull(), step(F.col("parent"), True)).alias("to"), F.lit(0).cast("long").alias("left")
    )
    tour = settle(enter.unionByName(leave), "tour")
    while not tour.where("to is not null").isEmpty():
        on = tour.select("conv_id", F.col("at").alias("to"), F.col("to").alias("further"), F.col("left").alias("rest"))
        tour = settle(tour.join(on, ["conv_id", "to"], "left").select("conv_id", "at", F.col("further").alias("to"), (F.col("left") + F.coalesce("rest", F.lit(0))).alias("left")), "tour")
    return tour.where("not at.leaving").select("conv_id", F.col("at.turn").alias("turn"), "left")


def link_quotations(messages: DataFrame, **cols: str) -> DataFrame:
    """One row for each message: conv_id, turn, role, text (own words), max_level, n_quotes, n_linked, linked_conv,
    linked_turn, reply_to, thread, place; ``ORDER`` sorts them into reply order.

    A quoted passage links to the first earlier message of its conversation that holds it as a whole or as a line,
    else, when it has ``FAR_CHARS`` characters, to the first message of any other conversation that does.  The best link of a message is in its own
    conversation, of the lowest level, whole, of the most characters, and latest; reply_to is its turn when it is in
    the same conversation, thread the turn that the chain of replies begins with (its own without a reply), and place the
    number of messages before it in its thread.  Null texts have no words; rows with a null conversation or turn keep to themselves.  Repeated rows get equal
    results.
    """
    rows = settle(parsed(messages, **cols), "messages")
    own = rows.where("conv_id is not null and turn is not null").select("conv_id", "turn", F.explode("own").alias("digest"))
    here = settle(own.groupBy("conv_id", "digest").agg(F.min("turn").alias("first_turn")), "own_here")
    # Two conversations for each digest, so that one is left when the quoting one is the other; the limit holds before rows move.
    two = here.withColumn("place", F.row_number().over(Window.partitionBy("digest").orderBy("conv_id"))).where("place <= 2")
    holder = F.struct("conv_id", "first_turn")
    anywhere = settle(two.groupBy("digest").agg(F.min(holder).alias("first"), F.max(holder).alias("second")), "own_anywhere")
    quotes = rows.where("conv_id is not null and turn is not null").select("conv_id", "turn", "message", F.explode("quotes").alias("q")).select("conv_id", "turn", "message", "q.*").distinct()
    near = quotes.join(here, ["conv_id", "digest"], "left").withColumn("first_turn", F.when(F.col("first_turn") < F.col("turn"), F.col("first_turn")))
    near = settle(near, "quotes_here")
    far = near.where((F.col("first_turn").isNull()) & (F.col("chars") >= FAR_CHARS)).join(anywhere, "digest")
    far = far.withColumn("first", F.when(F.col("first.conv_id") != F.col("conv_id"), F.col("first")).otherwise(F.col("second"))).drop("second").where("first.conv_id <> conv_id")
    found = near.where("first_turn is not null").withColumn("linked_conv", F.col("conv_id")).unionByName(
        far.withColumn("linked_conv", F.col("first.conv_id")).withColumn("first_turn", F.col("first.first_turn")).drop("first")
    )
    rank = F.struct((F.col("linked_conv") == F.col("conv_id")).alias("same"), (-F.col("level")).alias("up"), "whole", "chars", "first_turn")
    best = found.groupBy("conv_id", "turn", "message").agg(
        F.max_by(F.struct("linked_conv", F.col("first_turn").alias("linked_turn")), rank).alias("b"), F.count_distinct("place").alias("n_linked")
    ).select("conv_id", "turn", "message", "b.*", "n_linked")
    best = settle(best.withColumn("reply_to", F.when(F.col("linked_conv") == F.col("conv_id"), F.col("linked_turn"))), "links")
    replies = settle(best.where("reply_to is not null").groupBy("conv_id", "turn").agg(F.max("reply_to").alias("reply_to")), "replies")
    chains, rest = threads(replies), places(replies)
    # What is left of the tour, from a thread's beginning and from the message, differ by its place.
    begun = rest.select("conv_id", F.col("turn").alias("thread"), F.col("left").alias("whole"))
    chains = chains.join(rest, ["conv_id", "turn"]).join(begun, ["conv_id", "thread"]).select("conv_id", "turn", "thread", (F.col("whole") - F.col("left")).alias("place"))
    n_quotes = F.size(F.array_distinct(F.transform("quotes", lambda q: q["place"]))).cast("long")
    out = rows.withColumn("n_quotes", n_quotes).drop("quotes", "own").join(best, ["conv_id", "turn", "message"], "left").join(chains, ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", "text", "max_level", "n_quotes", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "linked_conv", "linked_turn", "reply_to", F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("place", F.lit(0)).cast("long").alias("place"),
    )


#: Sorts the rows of link_quotations into reply order.
ORDER = ("conv_id", "thread", "place", "turn")
