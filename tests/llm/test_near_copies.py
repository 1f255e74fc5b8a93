"""The pipeline's near-duplicate stage against all pairs of five-word shingle sets."""

import random

import duckdb

import corpus_pipeline as pipeline

from . import reference_versions as plain


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def kept(rows):
    """Smallest ids of the components of all pairs with Jaccard >= 0.8."""
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            x, y = sets[i], sets[j]
            if 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i for i in ids if find(i) == i}


def stage(spark, rows):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return {r.doc_id for r in pipeline.near_duplicates(spark, docs, "").collect()}


def test_copies_with_changed_words(spark):
    rng = random.Random(5)
    rows, line = [], " ".join(f"common{k}" for k in range(30))
    for group in range(12):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice((30, 120, 400)))]
        for copy in range(5):
            out = list(words)
            for at in rng.sample(range(len(out)), len(out) * copy // 100):
                out[at] = f"new{rng.randrange(10_000)}"
            rows.append((100 * group + copy, " ".join(out) + (" " + line if group % 2 else "")))
    rows += [(5000, None), (5001, ""), (5002, "one two"), (5003, "One  TWO"), (5004, "one two three")]
    want = kept(rows)
    found = stage(spark, rows)
    assert found == want
    # Several words changed: beyond two bits of the fingerprint, and similar all the same.
    assert len(set(plain.components({i: plain.simhash(t) for i, t in rows}).values())) > len(want)


def test_stage_on_documents(spark, sf_dir):
    rows = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    assert stage(spark, rows) == kept(rows)
