"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are compared whole, tile against tile, with numpy's exclusive-or and bit counts.  A tile holds
fingerprints of one population count; tiles whose counts differ by more than the radius are never paired.  Tiles are
first cut along blocks of bits: of ``radius + 2`` blocks at least two are equal in any two fingerprints within the
radius, so comparing inside each choice of two equal blocks loses no link.  Tiles of crowded choices are cut again to
``TILE`` rows, so that a task holds two tiles whatever the size of a group of copies, and from each pair of tiles
only a spanning forest of its links is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.components import connected_components
from .shared import discard, settle, texts

RADIUS = 2
SHINGLE = 3
#: Rows of a tile: two of them and their bit counts stay below 40 MB.
TILE = 1024


def shingle_hashes(text: str, shingle: int = SHINGLE):
    """XXH64 of each word shingle, repeats included; of all words when there are fewer, and none without words."""
    import numpy as np
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(b" ".join(words), 42)], np.uint64)
    return np.fromiter((digest(b" ".join(w), 42) for w in zip(*(words[k:] for k in range(shingle)), strict=False)), np.uint64, len(words) - shingle + 1)


def of_hashes(hashes) -> int:
    """64-bit SimHash: a bit is set when more than half of the hashes have it."""
    import numpy as np

    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 for a text without words."""
    return of_hashes(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) with fp the fingerprint as a signed long; null and empty texts get 0."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
        for batch in batches:
            got = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got.view(np.int64))], schema=schema)

    return texts(docs, id_col=id_col, text_col=text_col).mapInArrow(run, "doc_id long, fp long")


def _masks(radius: int) -> list[int]:
    blocks = radius + 2
    edges = [64 * k // blocks for k in range(blocks + 1)]
    bits = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [x | y for x, y in combinations(bits, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def spanning_links(left, right, radius: int):
    """Links within the radius between two arrays of uint64, reduced to a forest with the same components."""
    import numpy as np

    near = np.empty((len(left), len(right)), bool)
    for at in range(0, len(left), 256):
        near[at : at + 256] = np.bitwise_count(left[at : at + 256, None] ^ right[None, :]) <= radius
    rows, cols = np.nonzero(near)
    if len(rows) <= len(left) + len(right):
        return rows, cols
    out: list[tuple[int, int]] = []
    free_rows, free_cols = near.any(1), near.any(0)
    while free_rows.any():
        start = int(np.argmax(free_rows))
        free_rows[start] = False
        front = [start]
        while front:
            new_cols = []
            for r in front:
                hit = np.flatnonzero(near[r] & free_cols)
                free_cols[hit] = False
                out.extend((r, int(c)) for c in hit)
                new_cols.extend(hit.tolist())
            front = []
            for c in new_cols:
                hit = np.flatnonzero(near[:, c] & free_rows)
                free_rows[hit] = False
                out.extend((int(r), c) for r in hit)
                front.extend(hit.tolist())
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(u, v): links between different fingerprints of ``distinct`` (column fp), at least a spanning forest of each
    component of the graph of all pairs within ``radius`` bits."""
    masks = _masks(radius)
    rows = distinct.select("fp", F.bit_count("fp").alias("pop")).select(
        "fp", "pop", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")) for m in masks))).alias("cut", "block")
    )
    around = Window.partitionBy("cut", "block").orderBy("pop").rangeBetween(-radius, radius)
    sizes = rows.groupBy("cut", "block", "pop").agg(F.count(F.lit(1)).alias("n")).withColumn("near", F.sum("n").over(around))
    sizes = settle(sizes.where("near > 1").select("cut", "block", "pop", F.ceil(F.col("n") / tile).alias("parts")), "tile_sizes")
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).alias("part")
    tiles = settle(
        rows.join(sizes, ["cut", "block", "pop"]).select("cut", "block", "pop", part, "fp").groupBy("cut", "block", "pop", "part").agg(F.collect_list("fp").alias("fps")), "tiles"
    )
    left = tiles.select("cut", "block", "part", F.col("fps").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(radius))).alias("step"), "pop").withColumn("pop", (F.col("pop") + F.col("step")).cast("int"))
    right = tiles.select("cut", "block", "pop", F.col("part").alias("other"), F.col("fps").alias("b"))
    pairs = left.join(right, ["cut", "block", "pop"]).where("step > 0 or other > part or (other = part and size(a) > 1)").select("a", "b")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
        for batch in batches:
            us, vs = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for a, b in zip(batch.column(0), batch.column(1), strict=True):
                x, y = (z.values.to_numpy(zero_copy_only=False).view(np.uint64) for z in (a, b))
                i, j = spanning_links(x, y, radius)
                us.append(x[i])
                vs.append(y[j])
            u, v = np.concatenate(us), np.concatenate(vs)
            keep = u != v
            yield pa.RecordBatch.from_arrays([pa.array(u[keep].view(np.int64)), pa.array(v[keep].view(np.int64))], schema=schema)

    return pairs.mapInArrow(run, T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())]))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    component_id is the smallest doc_id whose fingerprint can be reached over links of at most ``radius`` bits.  Null
    and empty texts have fingerprint 0 and link like any other.  Repeated rows each get a row; a null id gets the
    component of its fingerprint (null when no row of the component has an id).
    """
    spark = docs.sparkSession
    prints = settle(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "fingerprints")
    distinct = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct_fingerprints")
    roots = settle(connected_components(links(distinct, radius, tile)), "roots")
    named = settle(roots.join(distinct, roots["node"] == distinct["fp"]).select("fp", "root", "first_doc"), "named")
    least = settle(named.groupBy("root").agg(F.min("first_doc").alias("component_id")), "least")
    linked = named.join(least, "root").select("fp", "component_id")
    alone = distinct.join(roots, distinct["fp"] == roots["node"], "left_anti").select("fp", F.col("first_doc").alias("component_id"))
    classes = settle(linked.unionByName(alone), "classes")
    discard(distinct, named, least)
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")
