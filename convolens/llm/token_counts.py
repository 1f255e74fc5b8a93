"""Token counts through a digest cache.

The cache is a Parquet table (tokenizer digest, content digest, n_tokens).  Contents are digested in the JVM; the
digests that the cache lacks are found first, so that only their texts move.  They are encoded once each, appended to the
cache, and all rows get their count by a join on the digest.  Normalisation before the digest may only remove differences that the tokenizer can't see; byte-level and
sentencepiece vocabularies see every character, so the content is the text itself with null as empty.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from importlib.metadata import version

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import byte_bpe, is_byte_level, portions
from .shared import discard, settle, texts

CACHE_SCHEMA = "tokenizer_digest string, content_digest string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Names the version of a tokenizer: its file's content and the library that reads it."""
    kind = path.rpartition(".")[2]
    h = hashlib.sha256(f"{kind} {version('sentencepiece' if kind == 'model' else 'tokenizers')}\n".encode())
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
    return h.hexdigest()


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts as the library of the file gives them, without begin, end or added special tokens."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda batch: [len(x) for x in pieces.encode(batch, num_threads=1)] if batch else []
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if is_byte_level(spec):
        bpe = byte_bpe(path)  # the same ids as the library's at several times its speed
        return lambda batch: [len(bpe.encode(t)) for t in batch]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return lambda batch: [len(library.encode(t, add_special_tokens=False).ids) for t in batch]


def read_cache(spark: SparkSession, cache_path: str) -> DataFrame:
    """The cache table; empty when nothing has been stored yet."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache_path)


def count_tokens(docs: DataFrame, path: str, cache_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row of ``docs``; appends what the cache lacked.

    Null texts count as empty (0 bytes, 0 tokens).  Repeated rows each get a row; null ids stay.  A cache that was
    written twice for one digest (two writers at once) holds equal counts, so any of them is taken.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer_digest(path)
    rows = texts(docs, id_col=id_col, text_col=text_col).withColumn("content_digest", F.sha2(F.col("text"), 256))
    stored = read_cache(spark, cache_path).where(F.col("tokenizer_digest") == tokenizer)

    sized = rows.select("doc_id", "content_digest", F.octet_length("text").cast("long").alias("n_bytes"))
    # One row stands for each digest; joined by digest and id, copies of a text don't meet in one task.
    no_id = F.lit(-(1 << 63)).cast("long")
    standing = sized.groupBy("content_digest").agg(F.coalesce(F.min("doc_id"), no_id).alias("standing"))
    lacking = settle(standing.join(stored, "content_digest", "left_anti"), "lacking")
    keyed = rows.select("content_digest", F.coalesce("doc_id", no_id).alias("standing"), "text")
    # Rows that repeat are where the join has left them, so the texts move once.
    misses = keyed.join(lacking, ["content_digest", "standing"]).groupBy("content_digest", "standing").agg(F.first("text").alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        count = counter(path)
        schema = pa.schema([("tokenizer_digest", pa.string()), ("content_digest", pa.string()), ("n_tokens", pa.int64())])
        for batch in portions(batches):
            counts = count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([tokenizer] * len(counts), pa.string()), batch.column(0), pa.array(counts, pa.int64())], schema=schema)

    misses.select("content_digest", "text").mapInArrow(run, CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    known = read_cache(spark, cache_path).where(F.col("tokenizer_digest") == tokenizer).groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    known = settle(known, "known_counts")  # read anew, so that a digest with very many rows can be split in the join
    discard(lacking)
    return sized.join(known, "content_digest").select("doc_id", "n_bytes", "n_tokens")
