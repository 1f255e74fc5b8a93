"""Vector search and cohesion over embeddings, and an embedding cache.

Queries are a stated set; they go to the executors in blocks of bounded size, and each block scans the items once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..tables import settle

BLOCK_ROWS = 10_000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def _blocks(queries: DataFrame, rows: int) -> Iterator[list]:
    block = []
    for row in queries.toLocalIterator():
        block.append((row[0], list(row[1])))
        if len(block) == rows:
            yield block
            block = []
    if block:
        yield block


def nearest(queries: DataFrame, items: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, place, item_id, score): the k items of greatest inner product; ties by id, a query's own id left out.

    ``queries`` and ``items`` have an id and a vector.  Each task keeps its k best of each query before the shuffle."""
    spark = items.sparkSession
    out: DataFrame | None = None
    kind = items.schema[0].dataType
    schema = T.StructType([T.StructField("query_id", kind), T.StructField("item_id", kind), T.StructField("score", T.DoubleType())])
    for block in _blocks(queries, block_rows):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator, shared=shared) -> Iterator:
            import heapq

            import numpy as np
            import pyarrow as pa

            ids = [q for q, _ in shared.value]
            matrix = np.array([v for _, v in shared.value], np.float64)
            best: list[list] = [[] for _ in ids]
            for batch in batches:
                keys = batch.column(0).to_pylist()
                if not keys:
                    continue
                vectors = np.array(batch.column(1).to_pylist(), np.float64)
                # The sum in order, so that scores are the same in any engine.
                scores = np.zeros((len(ids), len(keys)))
                for j in range(matrix.shape[1]):
                    scores += matrix[:, j : j + 1] * vectors[:, j][None, :]
                for q in range(len(ids)):
                    row = scores[q]
                    some = np.argpartition(-row, min(k + 1, len(row) - 1))[: k + 2] if len(row) > k + 2 else np.arange(len(row))
                    edge = row[some].min()
                    for j in np.flatnonzero(row >= edge).tolist() if len(row) > k + 2 else some.tolist():
                        if keys[j] != ids[q]:
                            best[q].append((row[j], keys[j]))
                    if len(best[q]) > 4 * k + 16:
                        best[q] = heapq.nsmallest(k, best[q], key=lambda x: (-x[0], x[1]))
            rows = [(ids[q], item, float(s)) for q in range(len(ids)) for s, item in heapq.nsmallest(k, best[q], key=lambda x: (-x[0], x[1]))]
            cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_pydict({"query_id": cols[0], "item_id": cols[1], "score": pa.array(cols[2], pa.float64())})

        part = items.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], schema).withColumn("place", F.lit(1)).select("query_id", "place", "item_id", "score")
    ranked = out.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "item_id")))
    return ranked.where(F.col("place") <= k).select("query_id", "place", "item_id", "score")


def cohesion(items: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, size, cohesion): mean inner product over all pairs of a group, from its sum vector.

    The sum over pairs is (|sum of vectors|^2 - sum of |vector|^2) / 2, so no pairs are made."""
    parts = items.select(group, F.posexplode(vector).alias("at", "x"))
    sums = parts.groupBy(group, "at").agg(F.sum(F.col("x").cast("double")).alias("s"), F.sum(F.col("x").cast("double") * F.col("x").cast("double")).alias("q"))
    sizes = items.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    out = sums.groupBy(group).agg(((F.sum(F.col("s") * F.col("s")) - F.sum("q")) / 2).alias("total")).join(sizes, group)
    pairs = F.col("size") * (F.col("size") - 1) / 2
    return out.select(group, "size", F.when(pairs > 0, F.col("total") / F.greatest(pairs, F.lit(1.0))).otherwise(1.0).alias("cohesion"))


def hashed_encoder(dimensions: int = 256, sizes: tuple[int, ...] = (3, 4)) -> Callable[[list[str]], list[list[float]]]:
    """Deterministic character n-gram vectors of unit length: the default encoder where no model is at hand."""

    def encode(texts: list[str]) -> list[list[float]]:
        import math
        import zlib

        out = []
        for text in texts:
            v = [0.0] * dimensions
            t = f" {text.lower()} "
            for n in sizes:
                for k in range(len(t) - n + 1):
                    h = zlib.crc32(t[k : k + n].encode())
                    v[h % dimensions] += 1.0 if h >> 31 else -1.0
            norm = math.sqrt(sum(x * x for x in v)) or 1.0
            out.append([x / norm for x in v])
        return out

    return encode


def embed(texts: DataFrame, cache: DataFrame | None = None, encoder: Callable[[list[str]], list[list[float]]] | None = None, model: str = "hashed-ngrams") -> tuple[DataFrame, DataFrame]:
    """(vectors of all rows (id, vector), rows to append to the cache (model, text_hash, vector)); each text is encoded once."""
    encode = encoder or hashed_encoder()
    rows = texts.withColumn("text_hash", F.sha2(F.coalesce("text", F.lit("")), 256))
    distinct = rows.groupBy("text_hash").agg(F.first("text").alias("text"))
    if cache is not None:
        distinct = distinct.join(cache.where(F.col("model") == model), "text_hash", "left_anti")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            vectors = encode([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.list_(pa.float64()))], names=["text_hash", "vector"])

    new = settle(distinct.mapInArrow(run, "text_hash string, vector array<double>").select(F.lit(model).alias("model"), "text_hash", "vector"), "encoded")
    known = new if cache is None else cache.where(F.col("model") == model).select("model", "text_hash", "vector").unionByName(new)
    return rows.join(settle(known, "known_vectors").select("text_hash", "vector"), "text_hash").select("id", "vector"), new


def embed_stored(texts: DataFrame, path: str, encoder: Callable[[list[str]], list[list[float]]] | None = None, model: str = "hashed-ngrams") -> DataFrame:
    """(id, vector) of all rows through a stored cache (model, text_hash, vector, added_at): texts that it lacks are encoded once and
    appended, the others cost a join."""
    spark = texts.sparkSession
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    schema = "model string, text_hash string, vector array<double>, added_at timestamp"
    known = spark.read.schema(schema).parquet(path).drop("added_at") if there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there) else None
    vectors, new = embed(texts, known, encoder, model)
    new.withColumn("added_at", F.current_timestamp()).write.mode("append").parquet(path)
    return vectors
