"""Chronological half split: the first floor(n/2) mentions in order of (posted_at, mention_id) are the earlier half.

The border is found by counting at ever finer grain (day, second, instant, id prefix), so that only rows of one instant and one
prefix are ever ranked, and the split itself is a comparison with two constants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PREFIX = 3
#: Column in which mentions carry their half once it is known.
MARK = "__earlier_half"


def border(mentions: DataFrame) -> tuple[object, str] | None:
    """(posted_at, mention_id) of the earlier half's last row; None with fewer than two dated rows."""
    rows = mentions.where("posted_at is not null").select("posted_at", F.coalesce("mention_id", F.lit("")).alias("mention_id"))
    total = rows.count()
    if total < 2:
        return None
    left = max(total // 2, 1)
    for grain in (F.to_date("posted_at"), F.date_trunc("second", "posted_at"), F.col("posted_at"), F.left("mention_id", F.lit(PREFIX))):
        counts = rows.groupBy(grain.alias("g")).agg(F.count(F.lit(1)).alias("n"))
        upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, 0)))
        hit = upto.where(F.col("upto") >= left).orderBy("upto").first()
        left -= hit["upto"] - hit["n"]
        rows = rows.where(grain == F.lit(hit["g"]))
    row = rows.orderBy("posted_at", "mention_id").offset(left - 1).limit(1).first()
    return row["posted_at"], row["mention_id"]


def is_earlier(split: tuple[object, str] | None) -> Column:
    """True in the earlier half, false in the later one, null without a split or date."""
    if split is None:
        return F.lit(None).cast("boolean")
    at, key = F.lit(split[0]), F.lit(split[1])
    return (F.col("posted_at") < at) | ((F.col("posted_at") == at) & (F.coalesce("mention_id", F.lit("")) <= key))


def earlier_half(mentions: DataFrame) -> Column:
    """The half of each mention: as marked, or by a search for the border."""
    return F.col(MARK) if MARK in mentions.columns else is_earlier(border(mentions))


def mark_halves(mentions: DataFrame) -> DataFrame:
    """Mentions with their half, so that reports on the same mentions look for the border once."""
    return mentions.withColumn(MARK, is_earlier(border(mentions)))
