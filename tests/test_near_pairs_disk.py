"""What the operators on near pairs keep on disk, against the texts they read."""

import random
from pathlib import Path

import pytest

from convolens.operators import components, dedup


def mentions(spark, folder):
    """400 long texts: every second one is a near copy of the one before, every tenth an exact copy."""
    rng = random.Random(5)
    names = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(30_000)]
    rows, words = [], []
    for k in range(400):
        words = [*words[:-1], "last"] if k % 2 else [rng.choice(names) for _ in range(1500)]
        rows.append((str(k), " ".join(words), 0))
    rows += [(f"x{k}", rows[k][1], 0) for k in range(0, 400, 10)]
    spark.createDataFrame(rows, "mention_id string, text string, depth int").repartition(4).write.parquet(folder)
    return spark.read.parquet(folder)


def size(folder):
    return sum(p.stat().st_size for p in Path(folder).rglob("*.parquet"))


@pytest.fixture
def watched(spark, tmp_path, monkeypatch):
    """The texts, their bytes, and a function that gives the most bytes of settled tables so far and those that are left."""
    texts = mentions(spark, str(tmp_path / "texts"))
    shared = Path(spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file://"), "convolens")
    before, most, settle = size(shared) if shared.exists() else 0, [0], dedup.settle

    def watch(*args, **kwargs):
        out = settle(*args, **kwargs)
        most[0] = max(most[0], size(shared) - before)
        return out

    monkeypatch.setattr(dedup, "settle", watch)
    monkeypatch.setattr(components, "settle", watch)
    return texts, size(tmp_path / "texts"), lambda: (most[0], size(shared) - before)


def test_similar_pairs(watched):
    texts, read, kept = watched
    assert dedup.similar_pairs(texts).count() == 200 + 40 * 2
    most, left = kept()
    assert most < 1.5 * read and left < 0.1 * read


def test_near_clusters(watched):
    texts, read, kept = watched
    members, clusters = dedup.near_clusters(texts)
    assert clusters.count() == 160 and members.count() == 320
    most, left = kept()
    assert most < 1.5 * read and left < 0.1 * read


def test_annotate(watched):
    texts, read, kept = watched
    counts = {r[0]: r[1] for r in dedup.annotate(texts).groupBy("dedup_kind").count().collect()}
    assert counts == {"exact": 80, "near": 320, None: 40}
    most, left = kept()
    # One copy of the texts stays, as the result reads it.
    assert most < 1.5 * read and left < read


def test_bitmaps_never_exceed_the_difference():
    import numpy as np

    rng = np.random.default_rng(7)
    for n, m, shared in ((0, 0, 0), (1, 1, 0), (1, 1, 1), (70, 64, 60), (3000, 2500, 2400), (5000, 40, 40)):
        h = np.unique(rng.integers(-(2**63), 2**63 - 1, n + m, np.int64))
        rng.shuffle(h)
        x, y = np.sort(h[:n]), np.sort(np.concatenate((h[:shared], h[n : n + m - shared])))
        apart = dedup._apart(dedup._parities(x), dedup._parities(y))
        assert apart <= n + m - 2 * shared and (apart > 0) == (n + m > 2 * shared)
