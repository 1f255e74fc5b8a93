"""From raw documents to token ids: quality rules, near-duplicates, benchmark passages, personal data, encoding.

Each stage works on what its predecessor kept and writes Parquet in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convolens.llm import bpe, decontamination, near_copies, pii, quality_rules
from convolens.llm.queries import tokenizer_path
from convolens.llm.shared import discard, load, settle

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the base rules or the learned decision list reject."""
    judged, _ = quality_rules.judge(docs, load(spark, sf_dir, "labels"), carry=COLUMNS)
    return judged.where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity of 0.8 or more) stays."""
    return near_copies.keep_one(docs).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark items."""
    return decontamination.clean(docs, decontamination.contaminated(docs, load(spark, sf_dir, "benchmark"))).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind."""
    found = pii.personal_data(docs, carry=("lang", "source"))
    out = found.withColumn("text", pii.redact(found))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text decoded from them."""
    coded = bpe.encode_documents(docs, tokenizer_path(), memo_bytes=96_000_000)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("encode", encode),
]

#: Learning, components, tiling and encoding are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; what a stage has written goes when the next one is done."""
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline_{name}")
        if before is not None:
            discard(before)
        before = docs
    return docs
