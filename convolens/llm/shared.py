"""Input projection and small helpers of the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import discard, fresh_path, load, settle, shared_dir  # noqa: F401


def size_in_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate (file sizes for a scan), used to choose numbers of buckets."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", null_as: str | None = "", carry: tuple[str, ...] = ()) -> DataFrame:
    """Only (doc_id long, text string) of ``docs`` and the columns named in ``carry``, whatever else it has."""
    text: Column = docs[text_col].cast("string")
    if null_as is not None:
        text = F.coalesce(text, F.lit(null_as))
    return docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"), *(docs[c] for c in carry))


def fewer_collections() -> None:
    """In a worker whose tables hold many small objects and no cycles: let the collector run rarely."""
    import gc

    gc.set_threshold(500_000, 20, 200)
