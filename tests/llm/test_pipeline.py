"""The pipeline's stages, each held against a plain version on its own input."""

import duckdb
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from convolens.llm import quality_rules
from convolens.llm.queries import tokenizer_path

from . import reference_versions as plain
from .test_near_copies import kept as least_of_groups


def statistics(text):
    """The features of the decision list, plainly."""
    n_words, chars, symbols, dup_lines, repeats = plain.base_quality(text)
    text = text or ""
    words, lines = plain.words(text), [x for x in text.split("\n") if plain.words(x)]
    share = lambda a, b: a / max(b, 1)
    return {
        "n_words": n_words, "mean_word": share(chars, n_words), "symbol_share": share(symbols, chars), "upper_share": share(sum(c.isupper() for c in text), chars),
        "mark_share": share(sum(c in "!?.,;:" for c in text), chars), "digit_share": share(sum(c in "0123456789" for c in text), chars), "dup_line_share": share(dup_lines, len(lines)),
        "repeat_share": share(repeats, n_words), "top_word_share": share(len(set(words)), n_words), "words_a_line": share(n_words, len(lines)),
        "bare_mark_share": share(sum(not w.strip("|#*$%&<>!?.,;:-_=+/\\~") for w in words), n_words),
    }


def good(text, rules):
    s = statistics(text)
    if s["n_words"] < 20 or 100 * s["repeat_share"] > 30 + 1e-9:
        return False
    return not any(all((s[c.feature] > c.threshold) == c.above for c in rule) for rule in rules)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    step = dict(pipeline.STAGES)
    assert list(step) == ["quality", "near_duplicates", "decontaminate", "personal_data", "encode"]
    rows = lambda df: {r.doc_id: r.text for r in df.collect()}
    kept = step["quality"](spark, docs, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    _, learned = quality_rules.judge(docs, labels)
    assert learned.rules
    before = rows(docs)
    assert kept.columns == docs.columns and set(rows(kept)) == {i for i, t in before.items() if good(t, learned.rules)}
    # Rejected by label, and kept by label: the list tells them apart.
    votes = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(votes[i], i in rows(kept)) for i in before if i in votes]
    assert sum((v == 1) == k for v, k in judged) >= 0.9 * len(judged)

    first = step["near_duplicates"](spark, kept, sf_dir)
    assert first.columns == docs.columns and set(rows(first)) == least_of_groups(rows(kept).items())

    clean = step["decontaminate"](spark, first, sf_dir)
    held = plain.contaminated(rows(first).items(), duckdb.sql(f"select item_id, text from '{sf_dir}/benchmark.parquet'").fetchall())
    assert clean.columns == docs.columns and set(rows(clean)) == set(rows(first)) - {i for i, _ in held}

    private = step["personal_data"](spark, clean, sf_dir)
    assert private.columns == docs.columns and private.count() == clean.count()
    before = rows(clean)
    for r in private.collect():
        assert not plain.base_pii(r.text) or not plain.base_pii(before[r.doc_id])
        assert plain.base_pii(before[r.doc_id]) or r.text == before[r.doc_id]
        assert r.n_chars == len(r.text)

    coded = step["encode"](spark, private, sf_dir).collect()
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    texts = rows(private)
    assert {r.doc_id: r.text for r in coded} == texts
    for r in coded:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


ODD = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, "x" * 50_000, "en", "s", 9), (4, "word " * 30_000, "en", "s", 9), (None, "some text without an id " * 3, "en", "s", 3), (5, "said twice", "en", "s", 3), (5, "said twice", "en", "s", 3), (6, "said twice", None, "s", 3)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_on_odd_rows(spark, sf_dir):
    """Every stage sees nulls, empty and very long texts, repeats, an extra column of a clashing name, and no rows."""
    step = dict(pipeline.STAGES)
    docs = spark.createDataFrame(ODD, SCHEMA).withColumn("fp", F.lit(1)).withColumn("digest", F.lit("x"))
    ids = lambda df: sorted((r.doc_id or 0) for r in df.collect())
    whole = sorted(r[0] or 0 for r in ODD)
    assert ids(step["quality"](spark, docs, sf_dir)) == []
    assert ids(step["near_duplicates"](spark, docs, sf_dir)) == [0, 1, 3, 4, 5]
    assert ids(step["decontaminate"](spark, docs, sf_dir)) == whole
    assert ids(step["personal_data"](spark, docs, sf_dir)) == whole
    assert ids(step["encode"](spark, docs, sf_dir)) == whole
    for stage in step.values():
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_run_on_odd_tables(spark, sf_dir, tmp_path):
    for name, data in (("documents", ODD), ("empty", [])):
        folder = tmp_path / name
        spark.createDataFrame(data, SCHEMA).withColumn("fp", F.lit(1)).write.parquet(str(folder / "documents.parquet"))
        for table in ("labels", "benchmark"):
            spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(str(folder / f"{table}.parquet"))
        assert pipeline.run(spark, str(folder)).count() == 0
