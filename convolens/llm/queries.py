"""The queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontamination, html_text, langid, pii, quality_rules, quotations, simhash, substring_dedup, token_counts
from .shared import fresh_path, load


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.link_quotations(load(spark, sf_dir, "conversations"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality_rules.judge(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def quality_base_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op2 that SQL can express: the statistics and the base rules."""
    stats = quality_rules.statistics(load(spark, sf_dir, "documents")).withColumn("base_failed", quality_rules.base_failed())
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(load(spark, sf_dir, "documents"), tokenizer_path())


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold benchmark items, each with the list of them."""
    return decontamination.caught(decontamination.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(load(spark, sf_dir, "documents"))
    base = F.concat(*(F.transform(kind, lambda s: F.struct(F.lit(k).alias("rank"), s["start"].alias("start"), s["stop"].alias("stop"))) for k, kind in enumerate(pii.KINDS)))
    return found.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(pii.digest(base), 256).alias("base_sha256"),
        pii.digest(F.col("all_spans")).alias("spans"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache of its own, so that every run does the whole work."""
    counts = token_counts.count_tokens(load(spark, sf_dir, "documents"), tokenizer_path(), fresh_path(spark, "token_cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op7_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(load(spark, sf_dir, "pages"))


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = langid.train(langid.training_rows(docs))
    return langid.identify(docs, model).select("doc_id", "held_out", "lang_pred", "score")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.repeated_passages(load(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quotation_linking": op1_quotation_linking,
    "op2_quality_rules": op2_quality_rules,
    "quality_base_statistics": quality_base_statistics,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_decontamination": op4_decontamination,
    "op5_personal_data": op5_personal_data,
    "op6_token_counts": op6_token_counts,
    "op7_simhash_components": op7_simhash_components,
    "op8_html_text": op8_html_text,
    "op9_language_mixture": op9_language_mixture,
    "op10_substring_dedup": op10_substring_dedup,
}

_WORDS = r"""t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, coalesce(text, '') AS text FROM documents),
    w AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS p FROM t)"""


def _windows(width: int) -> str:
    """Every window of ``width`` words with the hash of its words, which hold no space."""
    over = f"OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {width - 1} FOLLOWING)"
    return f"g AS (SELECT doc_id, p, md5(string_agg(word, ' ') {over}) AS k, count(*) {over} AS n FROM w), h AS (SELECT doc_id, p, k FROM g WHERE n = {width})"


ORACLE_SQL: dict[str, str] = {
    "op10_substring_dedup": f"""WITH {_WORDS}, {_windows(substring_dedup.WINDOW)},
    d AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS place FROM h) WHERE place > 1),
    gone AS (SELECT DISTINCT doc_id, p + i AS p FROM d, range({substring_dedup.WINDOW}) r(i)),
    cut AS (SELECT w.doc_id, count(gone.p) AS n_removed, string_agg(CASE WHEN gone.p IS NULL THEN word END, ' ' ORDER BY w.p) AS kept FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.p = gone.p GROUP BY w.doc_id)
    SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM t LEFT JOIN cut USING (doc_id)""",
    "quality_base_statistics": rf"""WITH {_WORDS}, {_windows(quality_rules.REPEAT_WIDTH)},
    again AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, k) AS n FROM h) WHERE n > 1),
    covered AS (SELECT doc_id, count(*) AS n_repeat_words FROM (SELECT DISTINCT doc_id, p + i FROM again, range({quality_rules.REPEAT_WIDTH}) r(i)) GROUP BY doc_id),
    lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t)
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(words) < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * len(words) AS base_failed FROM t JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)""",
}
