"""Stored vectors by namespace: saving, loading, resetting, deciding whether a stored namespace still serves, and rankings over it.

A namespace is a folder with the items (item_id, vector, text, metadata) and a manifest row, both Parquet in a folder that all executors
see; nothing of it is kept in one process.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import round_to
from ..functions.text import query_variants
from .vectors import dot, embed, hashed_encoder

NORMALIZED = "cosine_normalized"
#: What a state asks for.
ACTION = {"missing": "build", "stale": "refresh", "incompatible": "refresh by force", "refresh_required": "refresh by force", "valid": None}
#: Scores of all spellings but the first count less; aliases from outside the ontology count a little more.
VARIANT_WEIGHT, OVERLAY_BONUS, MOST = 0.92, 0.03, 0.995


@dataclass(frozen=True)
class Expected:
    """What a namespace has to be like; None asks for nothing."""

    namespace: str | None = None
    backend: str | None = None
    dimension: int | None = None
    normalization_mode: str | None = None
    model: str | None = None
    model_version: str | None = None
    purpose: str | None = None
    corpus_hash: str | None = None


def corpus_hash(items: DataFrame) -> str:
    """Of all items whatever their order: their number and the sum of 128 bits of each, as one digest."""
    each = F.md5(F.concat_ws("\x1f", "item_id", F.coalesce("text", F.lit("\x00")), F.size("vector").cast("string"), F.coalesce(F.to_json("metadata"), F.lit(""))))
    halves = [F.conv(F.substring(each, at, 12), 16, 10).cast("decimal(38,0)") for at in (1, 13, 21)]
    row = items.agg(F.count(F.lit(1)).alias("n"), *(F.sum(h).alias(f"s{k}") for k, h in enumerate(halves)))
    return row.select(F.sha2(F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("n", "s0", "s1", "s2"))), 256)).first()[0]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def reset(spark: SparkSession, folder: str, namespace: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{namespace}")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def manifest(spark: SparkSession, folder: str, namespace: str) -> dict | None:
    """The stored manifest, None without one."""
    path = f"{folder}/{namespace}/manifest"
    return spark.read.parquet(path).first().asDict() if _exists(spark, path) else None


def save(items: DataFrame, folder: str, namespace: str, *, model: str, model_version: str = "1", purpose: str = "passage", backend: str = "parquet") -> dict:
    """Replace a namespace by ``items`` (item_id, vector, text, metadata map); its manifest.  The manifest goes last, so a namespace
    that was only written in part counts as missing."""
    spark = items.sparkSession
    before = manifest(spark, folder, namespace)
    reset(spark, folder, namespace)
    items.write.parquet(f"{folder}/{namespace}/items")
    stored = spark.read.parquet(f"{folder}/{namespace}/items")
    first = stored.select(F.size("vector")).first()
    row = {
        "namespace": namespace, "backend": backend, "item_count": stored.count(), "dimension": first[0] if first else 0, "normalization_mode": NORMALIZED, "model": model, "model_version": model_version, "purpose": purpose,
        "corpus_hash": corpus_hash(stored), "created_at": before["created_at"] if before else None,
    }
    schema = "namespace string, backend string, item_count long, dimension int, normalization_mode string, model string, model_version string, purpose string, corpus_hash string, created_at timestamp"
    out = spark.createDataFrame([tuple(row.values())], schema).withColumn("created_at", F.coalesce("created_at", F.current_timestamp())).withColumn("updated_at", F.current_timestamp())
    out.coalesce(1).write.parquet(f"{folder}/{namespace}/manifest")
    return manifest(spark, folder, namespace)


def state(found: dict | None, expected: Expected | None) -> tuple[str, list[str]]:
    """(missing, valid, incompatible, stale or refresh_required; why) of a stored manifest."""
    if found is None:
        return "missing", ["manifest_missing"]
    if expected is None:
        return "valid", []
    wanted = {f.name: getattr(expected, f.name) for f in fields(expected) if getattr(expected, f.name) is not None}
    corpus = wanted.pop("corpus_hash", None)
    if corpus is not None and not found.get("corpus_hash"):
        return "refresh_required", ["corpus_hash_missing"]
    errors = [f"{name}_mismatch" for name, value in wanted.items() if found.get(name) != value]
    if errors:
        return "incompatible", errors
    if corpus is not None and corpus != found["corpus_hash"]:
        return "stale", ["corpus_hash_mismatch"]
    return "valid", []


def load(spark: SparkSession, folder: str, namespace: str, expected: Expected | None = None) -> DataFrame | None:
    """The stored items when they serve as they are, else None."""
    return spark.read.parquet(f"{folder}/{namespace}/items") if state(manifest(spark, folder, namespace), expected)[0] == "valid" else None


def rank_pool(queries: DataFrame, items: DataFrame, top: int = 5, encode: Callable[[list[str]], list[list[float]]] | None = None) -> DataFrame:
    """(query_id, place, canonical_entity_id, score, variant): the entities nearest to any spelling of a text.

    ``queries`` has query_id and text, ``items`` item_id, canonical_entity_id, source and vector - a bounded alias table, which is broadcast
    by Spark only while its size allows.  An entity has the best score of its aliases and of the spellings."""
    forms = queries.select("query_id", F.posexplode(query_variants(F.trim("text"))).alias("n", "variant"))
    encoded, _ = embed(forms.select(F.col("variant").alias("id"), F.col("variant").alias("text")).distinct(), None, encode or hashed_encoder())
    rows = forms.join(encoded.withColumnsRenamed({"id": "variant", "vector": "q"}), "variant").crossJoin(items)
    score = F.least(dot(F.col("q"), F.col("vector")) + F.when(F.col("source") != "ontology", OVERLAY_BONUS).otherwise(0.0), F.lit(MOST))
    weight = F.when(F.col("n") == 0, 1.0).otherwise(VARIANT_WEIGHT)
    rows = rows.select("query_id", "canonical_entity_id", round_to(round_to(score, 6) * weight, 6).alias("score"), F.struct((-F.col("n")).alias("n"), "variant").alias("form"))
    best = rows.groupBy("query_id", "canonical_entity_id").agg(F.max(F.struct("score", "form")).alias("b")).select("query_id", "canonical_entity_id", "b.score", F.col("b.form.variant").alias("variant"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "canonical_entity_id"))
    return best.withColumn("place", place).where(F.col("place") <= top).select("query_id", "place", "canonical_entity_id", "score", "variant")


# How taxonomy mapping blends the likeness of vectors and of words, and what longer phrases gain.
EMBEDDED, LEXICAL, SAME, WINDOW_STEP, MOST_STEPS = 0.45, 0.55, 0.04, 0.03, 0.09


def map_phrases(phrases: DataFrame, prototypes: DataFrame, top: int = 4, encode: Callable[[list[str]], list[list[float]]] | None = None) -> DataFrame:
    """(phrase, place, label, prototype, score, ambiguity_gap): the taxonomy labels nearest to each phrase, by .45 of the vectors' likeness,
    .55 of the words' and a bonus for equal letters; the gap is to the second label.

    ``phrases`` has the column phrase, ``prototypes`` label and prototype - a taxonomy's, few and bounded."""
    from ..functions.phrases import lexical_similarity, taxonomy_form

    encode = encode or hashed_encoder()
    vectors = lambda df, c, name: embed(df.select(F.col(c).alias("id"), F.col(c).alias("text")).distinct(), None, encode)[0].withColumnsRenamed({"id": c, "vector": name})
    rows = vectors(phrases, "phrase", "p").crossJoin(prototypes.join(vectors(prototypes, "prototype", "q"), "prototype"))
    letters = lambda c: F.replace(taxonomy_form(c), F.lit(" "), F.lit(""))
    equal = F.when(letters(F.col("phrase")) == letters(F.col("prototype")), SAME).otherwise(0.0)
    score = F.greatest(round_to(dot(F.col("p"), F.col("q")), 6), F.lit(0.0)) * EMBEDDED + lexical_similarity(F.col("phrase"), F.col("prototype")) * LEXICAL + equal
    best = rows.select("phrase", "label", "prototype", round_to(score, 6).alias("score")).groupBy("phrase", "label").agg(F.max_by("prototype", F.struct("score", "prototype")).alias("prototype"), F.max("score").alias("score"))
    own = Window.partitionBy("phrase").orderBy(F.desc("score"), "label")
    longer = F.least((F.size(F.split("phrase", " ")) - 1) * WINDOW_STEP, F.lit(MOST_STEPS))
    rows = best.withColumns({"place": F.row_number().over(own), "second": F.coalesce(F.max("score").over(own.rowsBetween(1, 1)), F.lit(0.0))})
    rows = rows.withColumn("second", F.first("second").over(own.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("place") <= top)
    final = round_to(F.least(F.col("score") + longer, F.lit(MOST)))
    return rows.select("phrase", "place", "label", "prototype", final.alias("score"), round_to(F.greatest(final - F.col("second"), F.lit(0.0))).alias("ambiguity_gap"))


def rerank(rows: DataFrame, query: str, candidate: str, score: str = "score", weight: float = 0.3, encode: Callable[[list[str]], list[list[float]]] | None = None) -> DataFrame:
    """``rows`` with ``score`` blended with the likeness of the texts in ``query`` and ``candidate`` by ``weight``, and reranked set; a null or
    blank text leaves its row as it is."""
    encode = encode or hashed_encoder()
    texts = rows.select(F.col(query).alias("t")).unionByName(rows.select(F.col(candidate).alias("t"))).where("trim(t) <> ''").distinct()
    known, _ = embed(texts.select(F.col("t").alias("id"), F.col("t").alias("text")), None, encode)
    named = lambda c, name: known.withColumnsRenamed({"id": c, "vector": name})
    out = rows.join(named(query, "__q"), query, "left").join(named(candidate, "__c"), candidate, "left")
    likeness = F.greatest(dot(F.col("__q"), F.col("__c")), F.lit(0.0))
    some = F.col("__q").isNotNull() & F.col("__c").isNotNull()
    blended = F.when(some, round_to(F.col(score) * (1 - weight) + likeness * weight)).otherwise(F.col(score))
    return out.withColumns({score: blended, "reranked": some}).select(*rows.columns, "reranked")

