"""Record contract: parsing, alias back-fill, rule checks, batch profile and report.

Records are JSON lines (source_path, line_number, value).  A line that isn't JSON aborts the batch, or with
``strict=False`` is reported like any other invalid record.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLATFORMS = ("tiktok", "facebook", "youtube")

_TEXTS = "array<string>"
RECORD = f"""
identity struct<uap_id: string, origin_id: string, task_id: string, project_id: string, uap_type: string, platform: string, url: string>,
hierarchy struct<parent_id: string, root_id: string, depth: long>,
author struct<id: string, username: string, nickname: string, avatar: string, profile_url: string, is_verified: boolean, account_type: string, follower_count: long, location_city: string>,
content struct<text: string, title: string, summary_title: string, subtitle: string, subtitle_url: string, language: string, hashtags: {_TEXTS}, keywords: {_TEXTS}, tiktok_keywords: {_TEXTS}, links: {_TEXTS}, external_links: {_TEXTS},
    is_shop_video: boolean, music_title: string, music_url: string, is_edited: boolean, detected_entities: string>,
engagement struct<likes: long, comments_count: long, shares: long, views: long, saves: long, bookmarks: long, reply_count: long, discussion_depth: double, velocity_score: double, sort_score: double>,
media array<struct<type: string, url: string, download_url: string, duration: double, thumbnail: string, width: long, height: long>>,
temporal struct<posted_at: string, updated_at: string, ingested_at: string>,
platform_meta struct<tiktok: struct<is_shop_video: boolean, music_title: string, music_url: string, sort_score: double>>
"""
COUNTS = ("likes", "comments_count", "shares", "views", "saves", "bookmarks", "reply_count")
BLANKS = {
    "identity": ("url",), "author": ("username", "nickname", "avatar", "profile_url", "account_type", "location_city"),
    "content": ("title", "summary_title", "subtitle", "subtitle_url", "language", "music_title", "music_url"), "hierarchy": ("parent_id", "root_id"),
    "temporal": ("posted_at", "updated_at", "ingested_at"),
}


def parse(lines: DataFrame, strict: bool = True) -> DataFrame:
    """lines with the record's structs, and malformed (the line isn't a JSON object)."""
    rows = lines.withColumn("r", F.from_json("value", RECORD, {"mode": "PERMISSIVE"})).withColumn("malformed", F.try_parse_json("value").isNull() | F.col("r").isNull())
    if strict:
        fail = F.raise_error(F.concat(F.lit("not JSON: "), "source_path", F.lit(":"), F.col("line_number").cast("string")))
        rows = rows.withColumn("malformed", F.when(F.col("malformed"), fail.cast("boolean")).otherwise(F.lit(False)))
    return rows.select(*lines.columns, "malformed", "r.*")


def _blank(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def clean(rows: DataFrame) -> DataFrame:
    """Blank optional texts become null, and aliases fill each other in."""
    for group, names in BLANKS.items():
        col = F.col(group)
        for name in names:
            col = col.withField(name, F.when(_blank(F.col(f"{group}.{name}")).isNotNull(), F.col(f"{group}.{name}")))
        rows = rows.withColumn(group, col)
    c, e, t = "content", "engagement", "platform_meta.tiktok"
    pair = lambda a, b: F.coalesce(F.col(a), F.col(b))
    content = F.col(c)
    for a, b in (("title", "summary_title"), ("keywords", "tiktok_keywords"), ("links", "external_links")):
        content = content.withField(a, pair(f"{c}.{a}", f"{c}.{b}")).withField(b, pair(f"{c}.{b}", f"{c}.{a}"))
    for a in ("is_shop_video", "music_title", "music_url"):
        content = content.withField(a, pair(f"{c}.{a}", f"{t}.{a}"))
    engagement = F.coalesce(F.col(e), F.from_json(F.lit("{}"), rows.schema[e].dataType))
    engagement = engagement.withField("saves", pair(f"{e}.saves", f"{e}.bookmarks")).withField("bookmarks", pair(f"{e}.bookmarks", f"{e}.saves")).withField("sort_score", pair(f"{e}.sort_score", f"{t}.sort_score"))
    return rows.withColumn(c, content).withColumn(e, engagement)


def rules() -> dict[str, Column]:
    """What is wrong with a record, by message."""
    i, h, kind = (lambda n: F.col(f"identity.{n}")), (lambda n: F.col(f"hierarchy.{n}")), F.col("identity.uap_type")
    out: dict[str, Column] = {"malformed JSON": F.col("malformed")}
    for name in ("uap_id", "origin_id", "task_id", "project_id"):
        out[f"identity.{name} is blank"] = _blank(i(name)).isNull()
    out |= {
        "identity.uap_type is unknown": ~F.coalesce(kind.isin("POST", "COMMENT", "REPLY"), F.lit(False)),
        "identity.platform is unknown": ~F.coalesce(i("platform").isin(*PLATFORMS), F.lit(False)),
        "author.id is missing": F.col("author.id").isNull(),
        "content.text is missing": F.col("content.text").isNull(),
        "hierarchy.depth is missing or negative": ~F.coalesce(h("depth") >= 0, F.lit(False)),
        "POST needs a url": (kind == "POST") & i("url").isNull(),
        "POST has a parent": (kind == "POST") & h("parent_id").isNotNull(),
        "POST must be its own root": (kind == "POST") & ~F.coalesce(h("root_id") == i("uap_id"), F.lit(False)),
        "POST must have depth 0": (kind == "POST") & (h("depth") != 0),
        "COMMENT needs a parent": (kind == "COMMENT") & h("parent_id").isNull(),
        "COMMENT must have depth 1": (kind == "COMMENT") & (h("depth") != 1),
        "REPLY needs a parent": (kind == "REPLY") & h("parent_id").isNull(),
        "REPLY must have depth 2 or more": (kind == "REPLY") & (h("depth") < 2),
        "root_id is missing": h("root_id").isNull(),
    }
    for name in COUNTS:
        out[f"engagement.{name} is negative"] = F.col(f"engagement.{name}") < 0
    return out


def check(rows: DataFrame) -> DataFrame:
    """Adds errors (array of messages) and valid."""
    errors = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(message)) for message, bad in rules().items())))
    return rows.withColumn("errors", errors).withColumn("valid", F.size("errors") == 0)


def validated(lines: DataFrame, strict: bool = False) -> DataFrame:
    return check(clean(parse(lines, strict)))


def read_validated(lines: DataFrame) -> DataFrame:
    """Valid records only; the first invalid one is an error."""
    rows = validated(lines, strict=True)
    message = F.concat_ws(": ", "source_path", F.col("line_number").cast("string"), F.array_join("errors", "; "))
    return rows.withColumn("valid", F.when(F.col("valid"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))).where("valid").drop("errors", "valid", "malformed")


def report(rows: DataFrame) -> DataFrame:
    """One row: total, valid and invalid records."""
    return rows.agg(F.count(F.lit(1)).alias("total_records"), F.count_if("valid").alias("valid_records"), F.count_if(~F.col("valid")).alias("invalid_records"))


def error_items(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("valid")).select("source_path", "line_number", F.explode("errors").alias("error"))


def counts(rows: DataFrame, field: str, valid_only: bool = False) -> DataFrame:
    """(value, count) of identity.``field``; the standalone report counts valid records only."""
    rows = rows.where("valid") if valid_only else rows
    return rows.where(F.col(f"identity.{field}").isNotNull()).groupBy(F.col(f"identity.{field}").alias("value")).agg(F.count(F.lit(1)).alias("count"))


class _Number(str):
    """A JSON number as it was written."""


def _written(x) -> str:
    if isinstance(x, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_written(v)}" for k, v in x.items()) + "}"
    if isinstance(x, list):
        return "[" + ",".join(map(_written, x)) + "]"
    return str(x) if isinstance(x, _Number) else json.dumps(x, ensure_ascii=False)


def _leaves(value: str | None) -> Iterator[tuple[str, str | None]]:
    """(dotted path, text) of the leaves of a JSON object, at any depth; lists and empty objects stay one value."""
    try:
        whole = json.loads(value or "", parse_float=_Number, parse_int=_Number)
    except (ValueError, RecursionError):
        return
    stack = [("", whole)] if isinstance(whole, dict) else []
    while stack:
        path, x = stack.pop()
        if isinstance(x, dict) and (x or not path):
            stack.extend((f"{path}.{k}" if path else k, v) for k, v in reversed(x.items()))
        else:
            yield path, None if x is None else str(x) if isinstance(x, str) else _written(x)


def flatten(lines: DataFrame) -> DataFrame:
    """(source_path, line_number, field, value): leaves of each JSON object by dotted path, read once; lists stay one value, and what is
    no object has none."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in (batch.slice(k, 512) for k in range(0, batch.num_rows, 512)):
                out = [(path, line, field, value) for path, line, text in zip(*(c.to_pylist() for c in part.columns), strict=True) for field, value in _leaves(text)]
                cols = list(zip(*out, strict=True)) if out else [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["source_path", "line_number", "field", "value"])

    rows = lines.select("source_path", F.col("line_number").cast("long").alias("line_number"), "value")
    return rows.mapInArrow(run, "source_path string, line_number long, field string, value string")


def field_profile(lines: DataFrame, examples: int = 3, width: int = 80) -> DataFrame:
    """(field, present_count, missing_count, example_values): null, blank and empty values are missing; a record without
    the path counts as neither.  Examples are the first in file and line order, joined by a bar.

    Each task reduces its lines to one row a field, with no more examples than are wanted."""

    def run(batches: Iterator) -> Iterator:
        import heapq

        import pyarrow as pa

        found: dict[str, list] = {}
        for batch in batches:
            for path, line, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for field, value in _leaves(text):
                    row = found.setdefault(field, [0, 0, []])
                    if value is None or value in ("", "[]", "{}"):
                        row[1] += 1
                        continue
                    row[0] += 1
                    row[2].append((path or "", line or 0, value[:width]))
                    if len(row[2]) > 16 * examples:
                        row[2] = heapq.nsmallest(examples, row[2])
        example = pa.struct([("path", pa.string()), ("line", pa.int64()), ("value", pa.string())])
        shown = [[{"path": p, "line": n, "value": v} for p, n, v in heapq.nsmallest(examples, x[2])] for x in found.values()]
        cols = [pa.array(list(found), pa.string()), pa.array([x[0] for x in found.values()], pa.int64()), pa.array([x[1] for x in found.values()], pa.int64()), pa.array(shown, pa.list_(example))]
        yield pa.RecordBatch.from_arrays(cols, names=["field", "present", "missing", "shown"])

    rows = lines.select("source_path", F.col("line_number").cast("long").alias("line_number"), "value").mapInArrow(run, "field string, present long, missing long, shown array<struct<path: string, line: long, value: string>>")
    out = rows.groupBy("field").agg(F.sum("present").alias("present_count"), F.sum("missing").alias("missing_count"), F.slice(F.array_sort(F.flatten(F.collect_list("shown"))), 1, examples).alias("shown"))
    return out.select("field", "present_count", "missing_count", F.array_join(F.transform("shown", lambda x: x["value"]), "|").alias("example_values"))


def text_lengths(rows: DataFrame) -> DataFrame:
    n = F.length("content.text")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    return rows.agg(F.floor(zero(F.avg(n)) * 100 + 0.5) / 100, zero(F.min(n)), zero(F.max(n))).toDF("avg", "min", "max")


def notes(profile: DataFrame, total: int) -> list[str]:
    """Remarks on sparse fields, from the profile's rows of three fields."""
    some = {r["field"]: r["present_count"] for r in profile.where(F.col("field").isin("content.language", "content.keywords", "content.tiktok_keywords")).collect()}
    out = []
    if total and not some.get("content.language"):
        out.append("No record names its language; it has to be detected.")
    if total and max(some.get("content.keywords", 0), some.get("content.tiktok_keywords", 0)) < total:
        out.append("Keywords are sparse and stay optional.")
    return out


def markdown(report_row: dict, by_type: DataFrame, profile: DataFrame) -> str:
    """The validation report to read: totals, records by type, remarks, and the fields with how often they are there.  A batch has some
    dozens of fields."""
    cell = lambda x: str(x).replace("|", "\\|").replace("\n", " ")
    out = ["# Validation report", "", *(f"- {name.replace('_', ' ')}: {value}" for name, value in report_row.items())]
    out += ["", "## Records by type", "", "| type | records |", "|---|---|", *(f"| {cell(r['value'])} | {r['count']} |" for r in by_type.orderBy("value").collect())]
    if remarks := notes(profile, report_row["total_records"]):
        out += ["", "## Remarks", "", *(f"- {x}" for x in remarks)]
    out += ["", "## Fields", "", "| field | present | missing | examples |", "|---|---|---|---|"]
    out += [f"| {cell(r['field'])} | {r['present_count']} | {r['missing_count']} | {cell(r['example_values'])} |" for r in profile.orderBy("field").toLocalIterator()]
    return "\n".join(out) + "\n"


def mentions(rows: DataFrame) -> DataFrame:
    """Valid records as mentions."""
    c, e, h, i = "content", "engagement", "hierarchy", "identity"
    none = F.array().cast("array<string>")
    return rows.where("valid").select(
        F.col(f"{i}.uap_id").alias("mention_id"), F.col(f"{i}.uap_id").alias("source_uap_id"), f"{i}.origin_id", f"{i}.task_id", f"{i}.project_id", f"{i}.uap_type", f"{i}.platform", f"{i}.url",
        f"{h}.parent_id", f"{h}.root_id", F.col(f"{h}.depth").cast("int").alias("depth"), F.col("author.id").alias("author_id"), "author.username", F.col("author.nickname").alias("author_nickname"), "author.is_verified", "author.account_type", "author.follower_count",
        F.col(f"{i}.url").alias("source_url"), F.col(f"{c}.text").alias("source_text"), f"{c}.title", f"{c}.summary_title", f"{c}.is_shop_video", F.col(f"{c}.language").alias("explicit_language"), F.coalesce(f"{c}.hashtags", none).alias("explicit_hashtags"),
        F.coalesce(f"{c}.keywords", none).alias("keywords"), F.coalesce(f"{c}.links", none).alias("links"), *(F.col(f"{e}.{n}").alias(n) for n in (*COUNTS, "sort_score")),
        *(F.try_to_timestamp(f"temporal.{n}").alias(n) for n in ("posted_at", "updated_at", "ingested_at")),
    )
