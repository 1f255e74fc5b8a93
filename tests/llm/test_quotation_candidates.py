"""A quoting conversation that holds the words itself, later, still links to the other one that holds them."""

from convolens.llm import quotations


def test_first_holder_is_the_quoting_conversation(spark):
    line = "the ferry leaves the northern pier at noon"
    rows = [
        (5, 0, f"> {line}\nis that so?"), (5, 1, line), (9, 0, "hello"), (9, 3, f"well,\n{line}"), (12, 0, line),
        (7, 0, f"> {line}\nso they say"), (3, 0, "> only we say so\nindeed"), (3, 1, "only we say so"),
    ]
    messages = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.n_linked, r.linked_conv, r.linked_turn, r.reply_to) for r in quotations.link_quotations(messages).collect()}
    assert got[5, 0] == (1, 9, 3, None)
    assert got[7, 0] == (1, 5, 1, None)
    assert got[3, 0] == (0, None, None, None)
