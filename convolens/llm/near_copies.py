"""Near copies: SimHash links and their exact completion to a similarity of 4/5 over sets of five-word shingles.

Links of the tiled SimHash comparison are candidates, as are pairs that share a shingle of their prefixes.  A prefix is
the first ``n - ceil(4n/5) + 1`` shingles in a fixed order of all: two sets that similar share one of them for certain, and
no prefix is cut.  Common shingles (met often in a sample) come last in the order, which only saves work.  Sizes, parity
bitmaps (whose difference never exceeds that of the sets) and the place of a shared shingle drop pairs that cannot be
similar: first bitmaps of 512 bits, then ones of a bit a shingle, as in short ones the differences of long texts vanish.
The shingles of all others are compared.

Pairs with the least document of each shared shingle come first; only documents that these leave in different components
are then paired with each other, so a group of copies does not give all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from . import simhash
from .shared import discard, settle, texts

SHINGLE = 5
#: Rows sampled to find common shingles, how often one of these is met there, and how many are told apart.
SAMPLE, COMMON, MOST_COMMON = 20_000, 3, 50_000
_WORDS = 8
_PRINT = "doc_id long, digest binary, fp long, n long, bits array<long>, wide binary, prefix array<long>"


def shingle_set(text: str):
    """Hashes of the different word shingles, sorted; all words make one when there are fewer, and none make none."""
    import numpy as np

    return np.unique(simhash.shingle_hashes(text, SHINGLE))


def _parities(s) -> bytes:
    """Bitmap of a set of hashes, a power of two and at least as many bits as hashes: is the number of those at a bit odd?"""
    import numpy as np

    width = max(64, 1 << max(len(s) - 1, 0).bit_length())
    return np.packbits((np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8)).tobytes()


def _apart(x: bytes, y: bytes) -> int:
    """Least number of hashes that two sets differ in, from their bitmaps; the wider is folded."""
    import numpy as np

    a, b = (np.frombuffer(z, np.uint64) for z in (x, y))
    while len(a) != len(b):
        a, b = (a, b) if len(a) < len(b) else (b, a)
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _sets(rows: DataFrame) -> DataFrame:
    """(doc_id, shingles) of (doc_id, text)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                sets = [shingle_set(t.as_py()).view("i8") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "shingles"])

    return rows.select("doc_id", "text").mapInArrow(run, "doc_id long, shingles array<long>")


def _prints(rows: DataFrame, common: dict[int, int]) -> DataFrame:
    """A row of fingerprint, set size, bitmaps and prefix for each of (doc_id, text); common: how often a shingle was met in
    the sample."""
    import numpy as np

    names = np.sort(np.array(sorted(common), np.int64).view(np.uint64))
    counts = np.array([common[x] for x in names.view(np.int64).tolist()], np.int64)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        for batch in batches:
            digests, codes, sizes, bits, wides, prefixes = [], [], [], [], [], []
            for t in batch.column(1):
                text = t.as_py()
                hashes = simhash.shingle_hashes(text, SHINGLE)
                codes.append(simhash.of_hashes(hashes))
                digests.append(xxhash.xxh3_128_digest(b" ".join(text.encode().lower().split())))
                s = np.unique(hashes)
                n = len(s)
                sizes.append(n)
                odd = (np.bincount((s & np.uint64(64 * _WORDS - 1)).astype(np.int64), minlength=64 * _WORDS) & 1).astype(np.uint8)
                bits.append(np.packbits(odd).view("i8"))
                wides.append(_parities(s))
                take = n - (4 * n + 4) // 5 + 1 if n else 0
                if len(names) and n:
                    at = np.minimum(np.searchsorted(names, s), len(names) - 1)
                    rank = np.where(names[at] == s, counts[at], 0)
                    s = s[np.lexsort((s, rank))]
                prefixes.append(s[:take].view("i8"))
            columns = [pa.array(digests, pa.binary()), pa.array(np.array(codes, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(bits, pa.list_(pa.int64())), pa.array(wides, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "digest", "fp", "n", "bits", "wide", "prefix"])

    return rows.select("doc_id", "text").mapInArrow(run, _PRINT)


def _common(rows: DataFrame) -> dict[int, int]:
    total = rows.count()
    grain = 1 << 20
    some = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < max(1, min(grain, grain * SAMPLE // max(total, 1))))
    met = _sets(some).select(F.explode("shingles").alias("s")).groupBy("s").count().where(F.col("count") >= COMMON)
    return {r[0]: r[1] for r in met.orderBy(F.desc("count"), "s").limit(MOST_COMMON).collect()}


def _possible(a: str, b: str) -> Column:
    """Whether sizes and bitmaps allow a similarity of 4/5: then 9 times the sets' difference is at most the sum of their sizes."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = sum((F.bit_count(F.get(f"{a}.bits", F.lit(k)).bitwiseXOR(F.get(f"{b}.bits", F.lit(k)))) for k in range(_WORDS)), F.lit(0))
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * apart <= n + m)


def _likely(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs (u, v) that the bitmaps of a bit a shingle allow.  These move for each pair, in place of 64 bits a shingle."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            total = (x.to_pylist() for x in (batch.column("total"), batch.column("x"), batch.column("y")))
            keep = [9 * _apart(x, y) <= n for n, x, y in zip(*total, strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    own = lambda end, n, wide: marks.select(F.col("doc_id").alias(end), F.col("n").alias(n), F.col("wide").alias(wide))
    both = pairs.join(own("u", "n", "x"), "u").join(own("v", "m", "y"), "v")
    return both.select("u", "v", (F.col("n") + F.col("m")).alias("total"), "x", "y").mapInArrow(run, "u long, v long")


def _similar(pairs: DataFrame, marks: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """The pairs (u, v) of documents whose sets have at least 4/5 of their shingles in common; only texts of these are read
    again."""
    pairs = settle(_likely(pairs, marks), f"{name}_likely")
    ends = settle(pairs.select(F.col("u").alias("doc_id")).unionByName(pairs.select(F.col("v").alias("doc_id"))).distinct(), f"{name}_ends")
    sets = settle(_sets(rows.join(ends, "doc_id", "left_semi")), f"{name}_sets")
    a = pairs.join(sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("x")), "u")
    both = a.join(sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("y")), "v")
    links = settle(both.where(9 * F.size(F.array_intersect("x", "y")) >= 4 * (F.size("x") + F.size("y"))).select("u", "v").distinct(), f"{name}_links")
    discard(pairs, ends, sets)
    return links


def near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, component_id) for every different id of ``docs``.

    component_id is the smallest doc_id that can be reached over pairs of similar texts.  Texts without words count as
    equal.  Rows that repeat an id are one document, similar to whatever one of them is similar to; rows without an id
    are left out, as nothing can name them."""
    rows = texts(docs, id_col=id_col, text_col=text_col).where("doc_id is not null")
    prints = settle(_prints(rows, _common(rows)), "prints")
    # Equal word sequences are one: the least document stands for them.
    marks = settle(prints.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ("fp", "n", "bits", "wide", "prefix"))), "marks")
    copies = prints.select("digest", "doc_id").join(marks.select("digest", F.col("doc_id").alias("v")), "digest")
    equal = settle(copies.select(F.col("doc_id").alias("u"), "v").where("u <> v").distinct(), "equal")
    discard(prints)

    shown = settle(marks.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "shown")
    close = settle(simhash.links(shown.select("fp")), "close")
    named = lambda end: shown.select(F.col("fp").alias(end), F.col("doc_id").alias(f"{end}_id"))
    near = close.join(named("u"), "u").join(named("v"), "v").select(F.col("u_id").alias("u"), F.col("v_id").alias("v"))
    same = marks.join(shown.withColumnRenamed("doc_id", "first"), "fp").where("doc_id <> first").select(F.col("first").alias("u"), F.col("doc_id").alias("v"))

    tokens = marks.select("doc_id", F.posexplode("prefix").alias("at", "token"))
    shared = settle(tokens.groupBy("token").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("token", "first"), "shared")
    # Only shingles that several documents begin with.
    members = settle(tokens.join(shared, "token"), "members")
    stars = members.where("doc_id <> first").select(F.col("first").alias("u"), F.col("doc_id").alias("v"))
    possible = near.unionByName(same).unionByName(stars).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u < v").distinct()
    sized = marks.select("doc_id", "n", "bits")
    kept = possible.join(sized.alias("a"), F.col("u") == F.col("a.doc_id")).join(sized.alias("b"), F.col("v") == F.col("b.doc_id")).where(_possible("a", "b"))
    pairs = settle(kept.select("u", "v").distinct(), "star_pairs")
    linked = _similar(pairs, marks, rows, "star")
    discard(pairs, close, shown)
    found = linked.unionByName(equal)
    parts = settle(connected_components(found), "star_parts")

    held = members.select("token", "doc_id", "at").join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("part", F.coalesce("root", "doc_id")).drop("root")
    mixed = settle(held.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("token"), "mixed")
    open_ = settle(held.join(mixed, "token").join(sized, "doc_id"), "open_members")
    discard(members, shared)
    a, b = open_.alias("a"), open_.alias("b")
    # At the first shingle that two prefixes share, what is left of the sets holds all that they share.
    left = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    enough = 9 * left >= 4 * (F.col("a.n") + F.col("b.n"))
    rest = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.doc_id") < F.col("b.doc_id")) & (F.col("a.part") != F.col("b.part")) & enough & _possible("a", "b"))
    rest = settle(rest.select(F.col("a.doc_id").alias("u"), F.col("b.doc_id").alias("v")).distinct(), "open_pairs")
    discard(open_, mixed, parts)
    others = _similar(rest, marks, rows, "open")
    discard(rest, marks)
    roots = settle(connected_components(found.unionByName(others)), "copy_roots")
    discard(linked, equal, others)
    return rows.select("doc_id").distinct().join(roots, F.col("doc_id") == F.col("node"), "left").select("doc_id", F.coalesce("root", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) with one document of each group left, the one of the smallest id.

    Of rows that repeat an id the one of the least text stays.  Rows without an id stay as they are."""
    ids = docs.select(docs[id_col].cast("long").alias("__id")).where("__id is not null")
    again = settle(ids.groupBy("__id").count().where("count > 1").select("__id"), "repeated_ids")
    found = near_copies(docs, id_col=id_col, text_col=text_col)
    gone = settle(found.where("doc_id <> component_id").select(F.col("doc_id").alias("__id")), "removed_ids")
    kept = docs.join(gone, docs[id_col].cast("long") == gone["__id"], "left_anti")
    if again.isEmpty():
        return kept
    once = kept.join(again, kept[id_col].cast("long") == again["__id"], "left_anti")
    several = kept.join(again, kept[id_col].cast("long") == again["__id"], "left_semi")
    least = several.groupBy(several[id_col].alias("__id")).agg(F.min_by(F.struct(*several.columns), F.struct(F.col(text_col), F.xxhash64(*several.columns))).alias("row"))
    return once.unionByName(least.select("row.*"))
