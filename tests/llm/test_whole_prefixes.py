"""A similar pair that shares none of the 32 first shingles of its prefixes."""

import random

import numpy as np

from convolens.llm import simhash

from .test_near_copies import kept, shingles, stage


def test_pair_beyond_the_first_shingles(spark):
    rng = random.Random(7)
    words = [f"w{rng.randrange(100_000)}" for _ in range(1604)]
    hashes = simhash.shingle_hashes(" ".join(words), 5)
    other = list(words)
    for k, at in enumerate(np.argsort(hashes)[:32].tolist()):
        other[at + 2] = f"new{k}"
    first = sorted(hashes.tolist())[:32]
    assert not set(first) & set(simhash.shingle_hashes(" ".join(other), 5).tolist())
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, "quite another text of some words")]
    x, y = shingles(rows[0][1]), shingles(rows[1][1])
    assert 5 * len(x & y) >= 4 * len(x | y)
    assert stage(spark, rows) == kept(rows) == {1, 3}
