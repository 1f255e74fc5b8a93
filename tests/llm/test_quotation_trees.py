"""Made-up conversations with nested quotes against a brute-force linker, and texts that are slow to read badly."""

import random
import time

from convolens.llm import quotations

MESSAGES = "conv_id long, turn long, role string, text string"


def conversations(seed):
    """(rows, replies): every message but the first answers one before it, quoting what that said and quoted."""
    rng = random.Random(seed)
    rows, replies = [], {}
    for conv in range(8):
        said = []
        for turn in range(rng.choice((1, 3, 12, 25))):
            own = f"message {turn} of talk {conv} says " + " ".join(rng.choice(("alpha", "beta", "gamma")) for _ in range(rng.randrange(3, 9)))
            text = own
            if turn:
                to = rng.randrange(turn)
                replies[conv, turn] = to
                quoted = said[to].split("\n")
                text = "\n".join([*rng.choice(([], [f"user {to} wrote:"])), *(f"> {x}" if not x.startswith(">") else f">{x}" for x in quoted if not x.endswith("wrote:")), own])
            said.append(text)
            rows.append((conv, turn, "user", text))
    return rows, replies


def tour(replies, turns):
    """Turns in reply order."""
    out = []

    def visit(t):
        out.append(t)
        for c in sorted(c for c, p in replies.items() if p == t):
            visit(c)

    for t in sorted(t for t in turns if t not in replies):
        visit(t)
    return out


def test_nested_replies(spark):
    for seed in range(2):
        rows, replies = conversations(seed)
        got = quotations.link_quotations(spark.createDataFrame(rows, MESSAGES)).collect()
        assert {(r.conv_id, r.turn): r.reply_to for r in got if r.reply_to is not None} == replies
        for conv in {r[0] for r in rows}:
            mine = sorted((r for r in got if r.conv_id == conv), key=lambda r: tuple(r[c] for c in quotations.ORDER))
            assert [r.turn for r in mine] == tour({t: p for (c, t), p in replies.items() if c == conv}, [r.turn for r in mine])
        own = {(c, t): x.split("\n")[-1] for c, t, _, x in rows}
        assert {(r.conv_id, r.turn): r.text for r in got} == own


def test_short_lines_do_not_link_far(spark):
    rows = [(1, 0, "u", "ok"), (2, 0, "u", "> ok\nfine"), (3, 0, "u", "hello"), (3, 1, "u", "> hello\nyes")]
    got = {(r.conv_id, r.turn): (r.n_linked, r.linked_conv) for r in quotations.link_quotations(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert got[2, 0] == (0, None) and got[3, 1] == (1, 3)


def test_crowded_replies(spark):
    """More replies to one message than a bucket of turns holds."""
    rows = [(1, 0, "u", "what do you all think of this")] + [(1, t, "u", f"> what do you all think of this\nanswer {t}") for t in range(1, 3000)]
    got = quotations.link_quotations(spark.createDataFrame(rows, MESSAGES)).select("turn", "reply_to", "thread", "place").collect()
    assert all((r.reply_to, r.thread, r.place) == (0 if r.turn else None, 0, r.turn) for r in got)


def test_linear():
    for text in ("!" * 200_000, "a" + "!" * 200_000, "!" * 200_000 + "a", " wrote" * 50_000 + ":", "> " * 100_000):
        start = time.process_time()
        quotations.normal(text)
        quotations.parse(f"{text}\n> x")
        assert time.process_time() - start < 2
    assert quotations.normal("  «Well,   yes!»\n") == "well, yes"
    assert quotations.introduces("On Monday Ann wrote : ") and not quotations.introduces("rewrote:") and not quotations.introduces("she wrote")
