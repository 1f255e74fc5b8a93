"""Words and two-sided contexts of texts without an identifier speak against a pattern."""

from convolens.llm import pii


def learned(spark, context, plain):
    rows = [(k, context.format(f"user{k}@mail.example")) for k in range(30)] + [(100, context.format("room12"))] + [(200 + k, t) for k, t in enumerate(plain)]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(len(got[k].all_spans) == 1 for k in range(30))
    return len(got[100].all_spans)


def test_counts_cover_texts_without_identifiers(spark):
    context = "please contact {} today again"
    assert learned(spark, context, ["nothing of the kind here"] * 50) == 1
    assert learned(spark, context, ["please contact somebody today again"] * 50) == 0
    # The words alone are common, but not as the two sides of one place.
    assert learned(spark, context, ["we contact the office", "come today"] * 50) == 1
