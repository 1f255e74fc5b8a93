"""Near pairs against all pairs of shingle sets: crowded groups, pairs at the threshold, equal sets of different texts."""

import math
import random

from convolens.operators import dedup


def plain(rows):
    sets = {}
    for i, text in rows:
        t = text.split()
        x = {" ".join(t[k : k + 3]) for k in range(len(t) - 2)}
        if len(text) >= 10 and x:
            sets[i] = x
    out, ids = set(), sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            shared = len(sets[i] & sets[j])
            similarity = math.floor(shared / (len(sets[i]) + len(sets[j]) - shared) * 10000 + 0.5) / 10000
            if similarity >= 0.82:
                out.add((i, j, similarity))
    return out


def found(spark, rows):
    got = [tuple(r) for r in dedup.similar_pairs(spark.createDataFrame(rows, "mention_id string, text string")).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_all_near_pairs(spark):
    rng = random.Random(3)
    base = " ".join(f"w{k}" for k in range(40))
    rows = [(f"c{k}", f"{base} own{k}") for k in range(300)]
    for group in range(40):
        words = [f"g{rng.randrange(400)}" for _ in range(rng.choice((12, 60, 300)))]
        for copy in range(6):
            some = list(words)
            for at in rng.sample(range(len(some)), len(some) * copy // 100 + copy % 2):
                some[at] = f"n{rng.randrange(10_000)}"
            rows.append((f"g{group}.{copy}", " ".join(some)))
    rows += [("e1", "a b c a b c a b c"), ("e2", "a b c a b c a b c a b c"), ("e3", "a b c a b c a b c"), ("s", "a b c d")]
    want = plain(rows)
    assert sum(a[0] == b[0] == "c" for a, b, _ in want) == 300 * 299 // 2
    assert {("e1", "e2", 1.0), ("e1", "e3", 1.0), ("e2", "e3", 1.0)} <= want
    assert found(spark, rows) == want


def test_few_near_pairs(spark):
    assert found(spark, [("2", "one two three four"), ("1", "one two three four"), ("3", "short"), ("4", "quite another text here")]) == {("1", "2", 1.0)}
    assert found(spark, [("1", "short")]) == set()
