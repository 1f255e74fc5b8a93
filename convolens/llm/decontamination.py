"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are joined on shared seeds, hashes of ``SEED`` tokens in a row that roll over the text as in
Karp-Rabin.  For each joined pair, equal stretches along the diagonals that hold a seed are laid as tiles, longest first,
without overlap in either text; a stretch that a tile cuts goes back with what is left of it.  The share of the item's
tokens under tiles decides, so passages taken in another order count in full.

A bitmap of the benchmark's seeds, of bounded size, goes to the executors, so that only documents with a possible seed
move; the join itself is exact, whatever the size of the benchmark.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import settle, texts

SEED = 5
#: Items of fewer tokens than a seed count when they stand whole in a document, from so many tokens on.
SHORTEST = 3
#: Share of an item's tokens under tiles from which a document counts as holding it.
COVERAGE = 0.5
#: Bits of the bitmap for each seed, and the logarithm of the least and the greatest size of it (8 MB).
BITS_A_SEED, LEAST_BITS, MOST_BITS = 256, 16, 26
#: Different tokens whose hashes a worker remembers, and characters of them.
TOKENS_KEPT, CHARS_KEPT = 500_000, 16_000_000

_BASE = 0x9E3779B97F4A7C15
_PROBES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


def _letters() -> bytes:
    word = {*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), ord("_"), *range(128, 256)}
    return bytes(b if b in word else 32 for b in range(256))


_TABLE = _letters()


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII punctuation separates, other characters belong to words."""
    return text.lower().encode().translate(_TABLE).split() if text else []


class _Hashes(dict):
    held = 0

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= TOKENS_KEPT or self.held > CHARS_KEPT:
            self.clear()
            self.held = 0
        self.held += len(word)
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def codes(text: str | None, hashes: _Hashes | None = None):
    """64-bit hashes of the tokens; ``hashes`` remembers those of earlier texts."""
    import numpy as np

    words = tokens(text)
    return np.fromiter(map((_Hashes() if hashes is None else hashes).__getitem__, words), np.uint64, len(words))


def rolling(words, width: int):
    """Hash of every ``width`` tokens in a row."""
    import numpy as np

    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n] + np.uint64(width)
    for k in range(1, width):
        out *= np.uint64(_BASE)
        out += words[k : k + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(_PROBES[1])
    return out ^ (out >> np.uint64(32))


def least_match(n: int, seed: int = SEED, shortest: int = SHORTEST) -> int:
    """Tokens of the shortest tile for an item of ``n`` tokens; 0 when it is too short for any."""
    return 0 if n < shortest else min(n, seed)


def _probes(seeds, bits: int):
    import numpy as np

    return [(seeds * np.uint64(p)) >> np.uint64(64 - bits) for p in _PROBES]


def _possible(bitmap, bits: int, seeds):
    """Which seeds the bitmap may hold."""
    import numpy as np

    out = np.ones(len(seeds), bool)
    for at in _probes(seeds, bits):
        out &= (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0
    return out


def greedy_tiles(doc, item, least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in doc, place in item, length): longest first, then by place in the item, then in the document.

    Equal stretches are found along diagonals, so a repeated token costs one comparison of a diagonal and not one entry
    for each pair of its places."""
    import numpy as np

    doc, item = np.asarray(doc, np.uint64), np.asarray(item, np.uint64)
    n, m = len(doc), len(item)
    if least < 1 or n < least or m < least:
        return []
    here, there = rolling(doc, least), rolling(item, least)
    order = np.argsort(here, kind="stable")
    low, high = np.searchsorted(here[order], there, "left"), np.searchsorted(here[order], there, "right")
    crossed = np.zeros(n + m, bool)
    for q in np.flatnonzero(high > low).tolist():
        crossed[order[low[q] : high[q]] - q + m] = True
    heap: list[tuple[int, int, int]] = []
    for d in (np.flatnonzero(crossed) - m).tolist():
        p, q = max(d, 0), max(-d, 0)
        length = min(n - p, m - q)
        equal = np.zeros(length + 2, np.int8)
        equal[1:-1] = doc[p : p + length] == item[q : q + length]
        turn = np.flatnonzero(np.diff(equal))
        for a, b in zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True):
            if b - a >= least:
                heap.append((a - b, q + a, p + a))
    heapq.heapify(heap)
    in_doc, in_item = np.zeros(n, bool), np.zeros(m, bool)
    tiles = []
    while heap and not in_item.all():
        size, q, p = heapq.heappop(heap)
        taken = in_doc[p : p - size] | in_item[q : q - size]
        if not taken.any():
            tiles.append((p, q, -size))
            in_doc[p : p - size] = True
            in_item[q : q - size] = True
            continue
        free = np.zeros(2 - size, np.int8)
        free[1:-1] = ~taken
        turn = np.flatnonzero(np.diff(free))
        for a, b in zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True):
            if b - a >= least:
                heapq.heappush(heap, (a - b, q + a, p + a))
    return tiles


def covered(doc, item, least: int) -> int:
    """The item's tokens under tiles."""
    return sum(t[2] for t in greedy_tiles(doc, item, least))


def _items(benchmark: DataFrame, item_col: str, text_col: str, seed: int, shortest: int) -> DataFrame:
    """(item_id, item_key, n, least, words, seeds) of the different items that are long enough."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            ids, keys, sizes, leasts, words, seeds = [], [], [], [], [], []
            for item, text in zip(batch.column(0), batch.column(1), strict=True):
                w = codes(text.as_py())
                if least := least_match(len(w), seed, shortest):
                    ids.append(item.as_py())
                    keys.append(xxhash.xxh3_128_digest(w.tobytes()))
                    sizes.append(len(w))
                    leasts.append(least)
                    words.append(w.view("i8"))
                    seeds.append(rolling(w, least).view("i8"))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (words, seeds)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(leasts, pa.int64()), *lists], names=["item_id", "item_key", "n", "least", "words", "seeds"])

    rows = benchmark.select(benchmark[item_col].cast("long").alias("item_id"), benchmark[text_col].cast("string").alias("text")).where("text is not null")
    out = rows.mapInArrow(run, "item_id long, item_key binary, n long, least long, words array<long>, seeds array<long>")
    return settle(out.dropDuplicates(["item_id", "item_key"]), "items")


def _bitmap(seeds: DataFrame):
    """(words of 64 bits, logarithm of the number of bits) of a bitmap over the column ``seed``."""
    import numpy as np

    n = seeds.select("seed").distinct().count()
    bits = min(MOST_BITS, max(LEAST_BITS, (BITS_A_SEED * max(n, 1)).bit_length()))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        words = np.zeros(1 << bits - 6, np.uint64)
        for batch in batches:
            for at in _probes(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits):
                np.bitwise_or.at(words, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        some = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(words[some].view(np.int64))], names=["place", "word"])

    rows = seeds.select("seed").mapInArrow(run, "place long, word long").groupBy("place").agg(F.bit_or("word").alias("word")).collect()
    bitmap = np.zeros(1 << bits - 6, np.uint64)
    if rows:
        bitmap[[r[0] for r in rows]] = np.array([r[1] for r in rows], np.int64).view(np.uint64)
    return bitmap, bits


def _identity(id_col: Column, text_col: Column) -> list[Column]:
    """What names a row: its id and 128 bits of its text."""
    return [id_col.cast("long"), F.unhex(F.md5(F.coalesce(text_col.cast("string"), F.lit(""))))]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = COVERAGE, seed: int = SEED, shortest: int = SHORTEST
) -> DataFrame:
    """(doc_id, digest, item_id, covered, item_tokens, coverage): the items that a document holds to ``threshold``.

    digest is the MD5 of the text (null as ''), so repeated rows share their pairs.  Items of fewer than ``shortest``
    tokens, null and empty texts on either side match nothing; of repeated items with one id the best coverage counts.
    """
    spark = docs.sparkSession
    items = _items(benchmark, item_col, item_text_col, seed, shortest)
    places = settle(items.select("item_id", "item_key", "n", "least", F.explode("seeds").alias("seed")).groupBy("item_id", "item_key", "n", "least", "seed").agg(F.count(F.lit(1)).alias("times")), "item_seeds")
    widths = sorted(r[0] for r in items.select("least").distinct().collect())  # at most as many as a seed has tokens
    shared = spark.sparkContext.broadcast(_bitmap(places))

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        bitmap, bits = shared.value
        hashes = _Hashes()
        for batch in batches:
            rows, words, seeds = [], [], []
            for k, text in enumerate(batch.column(2)):
                w = codes(text.as_py(), hashes)
                found = [s[_possible(bitmap, bits, s)] for s in (rolling(w, width) for width in widths)]
                if any(map(len, found)):
                    rows.append(k)
                    words.append(w.view("i8"))
                    seeds.append(np.unique(np.concatenate(found)).view("i8"))
            part = batch.select([0, 1]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(words, pa.list_(pa.int64())), pa.array(seeds, pa.list_(pa.int64()))], names=["doc_id", "digest", "words", "seeds"])

    rows = texts(docs, id_col=id_col, text_col=text_col)
    rows = rows.select(*(c.alias(a) for c, a in zip(_identity(rows["doc_id"], rows["text"]), ("doc_id", "digest"), strict=True)), "text")
    suspects = settle(rows.mapInArrow(scan, "doc_id long, digest binary, words array<long>, seeds array<long>"), "suspects")
    hits = suspects.select("doc_id", "digest", F.explode("seeds").alias("seed")).distinct().join(places, "seed")
    # A tile holds a seed at every place but its last ones, so a pair with too few seeds cannot be covered enough.
    enough = F.sum("times") * F.first("least") >= threshold * F.first("n")
    pairs = settle(hits.groupBy("doc_id", "digest", "item_id", "item_key").agg(enough.alias("enough")).where("enough").drop("enough"), "candidate_pairs")

    def tile(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            got = [covered(x.values.to_numpy().view(np.uint64), y.values.to_numpy().view(np.uint64), least) for x, y, least in zip(batch.column(4), batch.column(5), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(got, pa.int64()), batch.column(6)], names=["doc_id", "digest", "item_id", "covered", "item_tokens"])

    texts_of = suspects.select(F.col("doc_id").alias("d"), F.col("digest").alias("g"), F.col("words").alias("x")).dropDuplicates(["d", "g"])
    both = pairs.join(texts_of, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g"))).join(items.select("item_id", "item_key", "n", "least", F.col("words").alias("y")).withColumnsRenamed({"item_id": "i", "item_key": "k"}), F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item_key") == F.col("k")))
    found = both.select("doc_id", "digest", "item_id", "least", "x", "y", "n").mapInArrow(tile, "doc_id long, digest binary, item_id long, covered long, item_tokens long")
    found = found.where(F.col("covered") >= threshold * F.col("item_tokens")).withColumn("coverage", F.col("covered") / F.col("item_tokens"))
    best = found.groupBy("doc_id", "digest", "item_id").agg(F.max_by(F.struct("covered", "item_tokens", "coverage"), F.struct("coverage", "covered")).alias("b"))
    return settle(best.select("doc_id", "digest", "item_id", "b.*"), "contaminated")


def caught(pairs: DataFrame) -> DataFrame:
    """One row for each document that holds an item: doc_id, item_ids (sorted), n_items, best_item, coverage."""
    order = F.struct(F.col("coverage"), -F.col("item_id"))
    return pairs.groupBy("doc_id").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.countDistinct("item_id").alias("n_items"), F.max_by("item_id", order).alias("best_item"), F.max("coverage").alias("coverage")
    )


def clean(docs: DataFrame, pairs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no item."""
    bad = pairs.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    key, digest = _identity(docs[id_col], docs[text_col])
    return docs.join(bad, key.eqNullSafe(bad["__id"]) & (digest == bad["__digest"]), "left_anti")
