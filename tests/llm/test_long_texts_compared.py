"""Long texts that share a shingle and little else: bitmaps tell them apart, so that their sets don't move."""

import random

from convolens.llm import near_copies, simhash

from .test_near_copies import kept, stage


def compared(spark, rows, monkeypatch):
    """Ids that the stage keeps, and of how many texts it made sets of shingles to compare."""
    sets, settle = [], near_copies.settle

    def counted(df, name):
        out = settle(df, name)
        if name.endswith("_sets"):
            sets.append(out.count())
        return out

    monkeypatch.setattr(near_copies, "settle", counted)
    return stage(spark, rows), sum(sets)


def test_long_texts_of_one_passage(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(1_000_000)}"
    rows = []
    for group in range(16):
        passage = [word() for _ in range(1200)]
        rows += [(10 * group + k, " ".join(passage + [word() for _ in range(1200)])) for k in range(2)]
    found, sets = compared(spark, rows, monkeypatch)
    assert found == kept(rows) == {i for i, _ in rows}
    assert sets == 0


def test_similar_texts_of_all_sizes(spark, monkeypatch):
    """Pairs at the threshold, also where one bitmap is wider than the other."""
    rng = random.Random(12)
    rows = []
    for n in (5, 60, 64, 65, 130, 500, 512, 513, 1020, 1024, 1030, 2050):
        words = [f"w{rng.randrange(1_000_000)}" for _ in range(n + 4)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[: n * 4 // 5 + 4])), (len(rows) + 2, " ".join(words + [f"more{k}" for k in range(n // 4)]))]
    found, sets = compared(spark, rows, monkeypatch)
    assert found == kept(rows)
    assert len(found) < len(rows) and sets > 0


def test_bitmaps_never_exceed_the_difference():
    rng = random.Random(13)
    for _ in range(300):
        words = [str(rng.randrange(300)) for _ in range(rng.randrange(1, 700))]
        other = words[rng.randrange(len(words)) :] + [str(rng.randrange(300)) for _ in range(rng.randrange(80))]
        a, b = (near_copies.shingle_set(" ".join(x)) for x in (words, other or ["x"]))
        assert near_copies._apart(near_copies._parities(a), near_copies._parities(b)) <= len(set(a.tolist()) ^ set(b.tolist()))
    empty = near_copies.shingle_set("")
    assert near_copies._apart(near_copies._parities(empty), near_copies._parities(simhash.shingle_hashes("a b", 5))) == 1
