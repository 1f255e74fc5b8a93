"""Exact and near duplicates among mentions, and the weights that follow.

Input rows carry mention_id, text (compact) and depth.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..functions.text import squeeze
from ..tables import discard, settle
from .components import connected_components

LEAST_LENGTH = 10
SIMILARITY = 0.82
#: Rows sampled to find common shingles, how often one of these is met there, and how many are told apart.
SAMPLE, COMMON, MOST_COMMON = 20_000, 3, 50_000
#: Shingles of a group of sets: a task holds those of two groups, 32 MB.  Pairs of a tile, and shingles of a bucket of small tiles.
TILE_SHINGLES, TILE_PAIRS, BUCKET_SHINGLES = 2_000_000, 50_000, 250_000
#: Words whose hashes a task remembers.
WORDS_KEPT = 500_000


def fingerprint(text: Column) -> Column:
    squeezed = squeeze(text)
    return F.when(F.length(squeezed) >= LEAST_LENGTH, F.sha2(squeezed, 256))


def _exact(rows: DataFrame) -> DataFrame:
    """(fingerprint, cluster_id, cluster_size, representative_id) of rows (mention_id, depth, text_length, fingerprint).

    The longest text represents a cluster, then the least depth, then the least id."""
    out = rows.where("fingerprint is not null").groupBy("fingerprint").agg(F.count(F.lit(1)).alias("cluster_size"), _representative().alias("representative_id"))
    return out.where("cluster_size > 1").withColumn("cluster_id", F.concat(F.lit("exact:"), F.left("fingerprint", F.lit(16))))


def _representative() -> Column:
    return F.min_by("mention_id", F.struct(-F.col("text_length"), F.col("depth"), F.col("mention_id")))


def _marked(mentions: DataFrame) -> DataFrame:
    """With text_length and fingerprint."""
    return mentions.withColumns({"text_length": F.length("text"), "fingerprint": fingerprint(F.col("text"))})


def exact_clusters(mentions: DataFrame) -> DataFrame:
    """(fingerprint, cluster_id, cluster_size, representative_id) of texts that occur twice or more."""
    # Settled, as a condition on a computed column would have it computed twice.
    return _exact(settle(_marked(mentions).select("mention_id", "depth", "text_length", "fingerprint"), "fingerprints"))


class _Known(dict):
    """Hashes of the words met so far."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word.encode())
        return out


def _shingle_sets(texts: Iterable[str], known: _Known) -> Iterator:
    """A sorted array of 64-bit hashes for each text: of the strings of ``shingles``."""
    import numpy as np
    import xxhash

    one, two, three, mix = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD))
    for text in texts:
        words = text.split(" ")
        if "" in words:
            words = [w for w in words if w]
        if len(words) >= 3:
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            x = h[:-2] * one + h[1:-1] * two + h[2:] * three
            x = (x ^ (x >> np.uint64(32))) * mix
        else:
            # Words of these hold no space and word shingles two, so none is like another.
            bare = text.replace(" ", "")
            short = [bare[k : k + 5] for k in range(len(bare) - 4)] or ([text] if text else [])
            x = np.array([xxhash.xxh64_intdigest(t.encode(), 1) for t in short], np.uint64)
        yield np.unique(x.view(np.int64))


def _common(rows: DataFrame) -> dict[int, int]:
    """How often the most frequent shingles are met in a sample of bounded size.  They only order shingles; no pair hangs on them."""
    grain = 1 << 20
    some = rows.where(F.pmod(F.xxhash64("mention_id"), F.lit(grain)) < max(1, min(grain, grain * SAMPLE // max(rows.count(), 1))))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        known = _Known()
        for part in (whole.slice(k, 256) for whole in batches for k in range(0, whole.num_rows, 256)):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(list(_shingle_sets(part.column(0).to_pylist(), known))))], names=["token"])

    met = some.select("text").mapInArrow(run, "token long").groupBy("token").count().where(F.col("count") >= COMMON)
    most = settle(met.orderBy(F.desc("count"), "token").limit(MOST_COMMON), "common")
    found = {r[0]: r[1] for r in most.collect()}
    discard(most)
    return found


def _parities(h) -> bytes:
    """Bitmap of a set of hashes, a power of two and at least as many bits as hashes: is the number of those at a bit odd?"""
    import numpy as np

    width = max(64, 1 << max(len(h) - 1, 0).bit_length())
    return np.packbits((np.bincount(h & (width - 1), minlength=width) & 1).astype(np.uint8)).tobytes()


def _apart(x: bytes, y: bytes) -> int:
    """Least number of hashes that two sets differ in, from their bitmaps; the wider is folded."""
    import numpy as np

    a, b = sorted((np.frombuffer(z, np.uint64) for z in (x, y)), key=len)
    while len(a) != len(b):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _likely(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose bitmaps allow a similarity of ``least``: a bit a shingle moves for each, and no text of the others."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            total, x, y = (batch.column(c).to_pylist() for c in ("total", "x", "y"))
            keep = [_apart(i, j) * (1 + least) <= (1 - least) * n + 1e-6 for n, i, j in zip(total, x, y, strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    own = lambda end, n, wide: sets.select(F.col("k").alias(end), F.col("n").alias(n), F.col("wide").alias(wide))
    both = pairs.join(own("u", "n", "x"), "u").join(own("v", "m", "y"), "v")
    return both.select("u", "v", (F.col("n") + F.col("m")).alias("total"), "x", "y").mapInArrow(run, "u long, v long")


def _heads(rows: DataFrame, common: dict[int, int], least: float) -> DataFrame:
    """(mention_id, fingerprint, digest, n, wide, prefix) of (mention_id, fingerprint, text): digest, size and bitmap of the set of
    shingles, and its first n - ceil(least * n) + 1 shingles, rare ones first.  Two sets of a similarity of ``least`` have one of them in common."""
    import numpy as np

    names = np.array(sorted(common), np.int64)
    counts = np.array([common[x] for x in names.tolist()], np.int64)

    def run(batches: Iterator) -> Iterator:
        import math

        import numpy as np
        import pyarrow as pa
        import xxhash

        known = _Known()
        for part in (whole.slice(k, 256) for whole in batches for k in range(0, whole.num_rows, 256)):
            digests, sizes, wides, prefixes = [], [], [], []
            for h in _shingle_sets(part.column(2).to_pylist(), known):
                digests.append(xxhash.xxh3_128_digest(h.tobytes()))
                sizes.append(len(h))
                wides.append(_parities(h))
                if len(names):
                    at = np.minimum(np.searchsorted(names, h), len(names) - 1)
                    h = h[np.lexsort((h, np.where(names[at] == h, counts[at], 0)))]
                prefixes.append(h[: len(h) - math.ceil(least * len(h) - 1e-9) + 1])
            edges = np.cumsum([0, *map(len, prefixes)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(prefixes)))
            columns = [part.column(0), part.column(1), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(wides, pa.binary()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["mention_id", "fingerprint", "digest", "n", "wide", "prefix"])

    return rows.select("mention_id", "fingerprint", "text").mapInArrow(run, "mention_id string, fingerprint string, digest binary, n int, wide binary, prefix array<long>")


def _candidates(sets: DataFrame, least: float) -> DataFrame:
    """(u, v) of (k, n, prefix), u < v: sets that share a shingle of their prefixes at places that allow a similarity of ``least``."""
    tokens = sets.select("k", F.explode("prefix").alias("token"))
    # Most shingles are met in one prefix only, so the others are found first, and sizes and places move for these alone.
    shared = settle(tokens.groupBy("token").count().where("count > 1").select("token"), "shared")
    met = settle(tokens.join(shared, "token").select("k", "token"), "met")
    at = (F.array_position("prefix", F.col("token")) - 1).cast("int")
    members = met.join(sets.select("k", "n", "prefix"), "k").select("token", "k", "n", at.alias("at"), "prefix")
    members = settle(members.select("token", "k", "n", "at", F.get("prefix", F.col("at") - 1).alias("before")), "members")
    discard(shared, met)
    a, b = members.alias("a"), members.alias("b")
    n, m, left = F.col("a.n"), F.col("b.n"), F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    possible = (F.least(n, m) + 1e-6 >= least * F.greatest(n, m)) & (left * (1 + least) + 1e-6 >= least * (n + m))
    # A pair with the same shingle before this one has met there.
    met = F.coalesce(F.col("a.before") == F.col("b.before"), F.lit(False))
    pairs = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.k") < F.col("b.k")) & possible & ~met)
    pairs = settle(pairs.select(F.col("a.k").alias("u"), F.col("b.k").alias("v")).distinct(), "candidates")
    discard(members)
    return pairs


def _packed(texts: DataFrame) -> DataFrame:
    """(mention_id, packed) of (mention_id, text): compressed, as they move."""

    def run(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        for part in (whole.slice(k, 256) for whole in batches for k in range(0, whole.num_rows, 256)):
            packed = pa.array([zlib.compress(t.encode(), 1) for t in part.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), packed], names=["mention_id", "packed"])

    return texts.select("mention_id", "text").mapInArrow(run, "mention_id string, packed binary")


def _overlaps(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(u, v, shared, united): sizes of the intersection and the union of the sets of each of ``pairs``.

    sets: (k, n, first, digest).  What moves is the text of ``first``, to each tile once.  A tile has the pairs whose ends have the
    same least neighbours, so a group of copies is one tile; those of large groups are cut by ids.  Tiles share buckets of a set size."""
    ends = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = ends.groupBy(F.col("u").alias("k")).agg(F.least("k", F.min("v")).alias("low"))
    own = lambda end, low: least.select(F.col("k").alias(end), F.col("low").alias(low))
    met = pairs.join(own("u", "x"), "u").join(own("v", "y"), "v")
    met = settle(met.select("u", "v", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")), "met")
    both = lambda t, *by: t.select(F.col("u").alias("k"), *by).unionByName(t.select(F.col("v").alias("k"), *by)).distinct()
    amount = both(met, "x", "y").join(sets.select("k", "n"), "k").groupBy("x", "y").agg(F.sum("n").alias("amount"))
    parts = met.groupBy("x", "y").agg(F.count(F.lit(1)).alias("some")).join(amount, ["x", "y"])
    cuts = F.lit(1) + F.greatest(F.floor(F.col("amount") / TILE_SHINGLES), F.floor(F.sqrt(2 * F.col("some") / TILE_PAIRS)))
    cut = settle(parts.select("x", "y", "amount", cuts.alias("cuts")), "cuts")
    buckets = 1 + (cut.agg(F.sum(F.col("amount") * F.col("cuts"))).first()[0] or 0) // BUCKET_SHINGLES
    part = lambda c: F.pmod(F.xxhash64(c), F.col("cuts"))
    bucket = F.pmod(F.xxhash64("x", "y", F.least(part("u"), part("v")), F.greatest(part("u"), part("v"))), F.lit(buckets))
    tiled = settle(met.join(cut, ["x", "y"]).select(bucket.alias("bucket"), "u", "v"), "tiled")
    discard(met, cut)
    needed = both(tiled, "bucket").join(sets.select("k", "digest", F.col("first").alias("mention_id")), "k")
    needed = needed.join(_packed(texts), "mention_id").select(F.col("bucket").alias("to"), "k", "digest", "packed")

    def compare(some, own):
        import zlib

        import numpy as np
        import pyarrow as pa
        import xxhash

        texts = (zlib.decompress(t).decode() for t in own["packed"].to_pylist())
        found = zip(own["k"].to_pylist(), own["digest"].to_pylist(), _shingle_sets(texts, _Known()), strict=True)
        # Of rows that repeat an id, the one that is meant.
        by = {k: h for k, digest, h in found if xxhash.xxh3_128_digest(h.tobytes()) == digest}
        us, vs = some["u"].to_pylist(), some["v"].to_pylist()
        shared = np.array([len(np.intersect1d(by[u], by[v], assume_unique=True)) for u, v in zip(us, vs, strict=True)], np.int64)
        total = np.array([len(by[u]) + len(by[v]) for u, v in zip(us, vs, strict=True)], np.int64)
        return pa.table({"u": some["u"], "v": some["v"], "shared": shared, "united": total - shared})

    out = settle(tiled.groupBy("bucket").cogroup(needed.groupBy("to")).applyInArrow(compare, "u long, v long, shared long, united long"), "overlaps")
    discard(tiled)
    return out


def _similar(rows: DataFrame, threshold: float, exact: DataFrame | None = None) -> DataFrame:
    """(left, right, similarity) of settled rows (mention_id, fingerprint, text); without those whose fingerprint is in ``exact``."""
    rows = rows.where((F.length("text") >= LEAST_LENGTH) & F.col("mention_id").isNotNull())
    # What rounds up to the threshold counts.
    least = threshold - 1e-4
    heads = settle(_heads(rows, _common(rows), least), "heads")
    alone = heads if exact is None else heads.join(exact, "fingerprint", "left_anti")
    sets = alone.groupBy("digest").agg(F.min("mention_id").alias("first"), *(F.first(c).alias(c) for c in ("n", "wide", "prefix")))
    sets = settle(sets.select(F.monotonically_increasing_id().alias("k"), "*"), "sets")
    members = settle(alone.join(sets.select("digest", "k"), "digest").select("k", "mention_id"), "members")
    discard(heads)
    pairs = _candidates(sets, least)
    marks = settle(sets.drop("prefix"), "marks")
    discard(sets)
    likely = settle(_likely(pairs, marks, least), "likely")
    discard(pairs)
    compared = _overlaps(likely, marks, rows)
    discard(likely, marks)
    found = settle(compared.withColumn("similarity", round_to(F.col("shared") / F.col("united"))).where(F.col("similarity") >= threshold), "similar")
    discard(compared)
    own = lambda end, name: members.select(F.col("k").alias(end), F.col("mention_id").alias(name))
    across = found.join(own("u", "x"), "u").join(own("v", "y"), "v").select(F.least("x", "y").alias("left"), F.greatest("x", "y").alias("right"), "similarity")
    equal = own("u", "left").join(own("u", "right"), "u").where("left < right").select("left", "right", F.lit(1.0).alias("similarity"))
    return across.unionByName(equal)


def similar_pairs(mentions: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """(left, right, similarity) with left < right: all pairs of near texts.

    Equal sets of shingles stand for one while sets are compared, and only sets that share a shingle of their prefixes and
    whose sizes and places of that shingle allow the threshold are.  Sets are never written: they are hashed from the texts, once
    for the prefixes and again where candidates meet."""
    rows = settle(mentions.select("mention_id", F.lit(None).cast("string").alias("fingerprint"), "text"), "texts", compression="zstd")
    pairs = _similar(rows, threshold)
    discard(rows)
    return pairs


def _near(rows: DataFrame, exact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """near_clusters of settled rows (mention_id, depth, text, text_length, fingerprint); exact: the exact clusters, settled."""
    pairs = settle(_similar(rows, SIMILARITY, exact.select("fingerprint")), "pairs")
    roots = settle(connected_components(pairs.select(F.col("left").alias("u"), F.col("right").alias("v"))), "roots")
    members = settle(roots.select(F.col("node").alias("mention_id"), F.concat(F.lit("near:"), F.left(F.sha2("root", 256), F.lit(16))).alias("cluster_id")), "near_members")
    discard(roots)
    mean = pairs.join(members, F.col("left") == F.col("mention_id")).groupBy("cluster_id").agg(round_to(F.avg("similarity")).alias("similarity"))
    single = rows.select("mention_id", "depth", "text_length", "fingerprint").join(exact.select("fingerprint"), "fingerprint", "left_anti")
    clusters = single.join(members, "mention_id").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("cluster_size"), _representative().alias("representative_id")).join(mean, "cluster_id")
    clusters = settle(clusters, "near_clusters")
    discard(pairs)
    return members, clusters


def near_clusters(mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members (mention_id, cluster_id), clusters (cluster_id, cluster_size, representative_id, similarity)) among
    mentions that are in no exact cluster; similarity is the mean over the cluster's linked pairs."""
    rows = settle(_marked(mentions.select("mention_id", "text", "depth")), "texts", compression="zstd")
    exact = settle(_exact(rows), "exact")
    members, clusters = _near(rows, exact)
    discard(rows, exact)
    return members, clusters


def annotate(mentions: DataFrame, near: bool = True) -> DataFrame:
    """mentions with dedup_kind, dedup_cluster_id, dedup_cluster_size, dedup_representative_id, dedup_similarity and dedup_weight."""
    # The one copy of the texts; all else reads it, and most of that without the texts.
    marked = settle(_marked(mentions), "mentions", compression="zstd")
    exact = settle(_exact(marked), "exact_clusters")
    rows = marked.join(
        exact.select("fingerprint", F.col("cluster_id").alias("e_id"), F.col("cluster_size").alias("e_size"), F.col("representative_id").alias("e_rep")), "fingerprint", "left"
    )
    n_id, n_size, n_rep, n_sim = (F.lit(None).cast(t) for t in ("string", "bigint", "string", "double"))
    if near:
        members, clusters = _near(marked, exact)
        found = settle(members.join(clusters, "cluster_id"), "near").select("mention_id", F.col("cluster_id").alias("n_id"), F.col("cluster_size").alias("n_size"), F.col("representative_id").alias("n_rep"), F.col("similarity").alias("n_sim"))
        rows = rows.join(found, "mention_id", "left")
        n_id, n_size, n_rep, n_sim = (F.col(c) for c in ("n_id", "n_size", "n_rep", "n_sim"))
    size = F.coalesce(F.col("e_size"), n_size, F.lit(1))
    out = rows.withColumns(
        {
            "dedup_kind": F.when(F.col("e_id").isNotNull(), "exact").when(n_id.isNotNull(), "near"),
            "dedup_cluster_id": F.coalesce(F.col("e_id"), n_id),
            "dedup_cluster_size": size,
            "dedup_representative_id": F.coalesce(F.col("e_rep"), n_rep),
            "dedup_similarity": F.when(F.col("e_id").isNotNull(), 1.0).otherwise(n_sim),
            "dedup_weight": round_to(1.0 / size, 6),
        }
    )
    return out.drop("fingerprint", "text_length", "e_id", "e_size", "e_rep", "n_id", "n_size", "n_rep", "n_sim")
