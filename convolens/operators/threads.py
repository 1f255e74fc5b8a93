"""Reply threads: edges, summaries, lineage, neighbours, context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..tables import settle

TOP_COMMENTS = 5


def edges(posts: DataFrame) -> DataFrame:
    return posts.where("parent_id is not null").select("root_id", "parent_id", F.col("mention_id").alias("child_id"), "depth")


def summaries(posts: DataFrame) -> DataFrame:
    """One row for each root: sizes, depth, and the ids of the best comments (by score, then id), joined by a bar."""
    comment = F.col("uap_type") == "COMMENT"
    counts = posts.groupBy("root_id").agg(
        F.count(F.lit(1)).alias("total_mentions"), F.max("depth").alias("max_depth_observed"), F.count_if(comment).alias("comment_count"), F.count_if(F.col("uap_type") == "REPLY").alias("reply_count")
    )
    ranked = posts.where(comment).withColumn("place", F.row_number().over(Window.partitionBy("root_id").orderBy(F.desc("score"), "mention_id")))
    top = ranked.where(F.col("place") <= TOP_COMMENTS).groupBy("root_id").agg(F.sort_array(F.collect_list(F.struct("place", "mention_id"))).alias("t"))
    out = counts.join(top, "root_id", "left").withColumn("total_descendants", F.greatest(F.col("total_mentions") - 1, F.lit(0)))
    return out.withColumn("top_comment_ids", F.coalesce(F.array_join(F.transform("t", lambda x: x["mention_id"]), "|"), F.lit(""))).drop("t")


def roots(posts: DataFrame) -> DataFrame:
    """(root_id, resolved_root_id): the mention of that id, else the shallowest one, without a known parent, of least id."""
    ids = posts.select(F.col("mention_id").alias("known")).distinct()
    rows = posts.join(ids, posts["parent_id"] == ids["known"], "left")
    order = F.struct(F.col("mention_id") != F.col("root_id"), "depth", F.col("known").isNotNull().cast("int"), "mention_id")
    return rows.groupBy("root_id").agg(F.min_by("mention_id", order).alias("resolved_root_id"))


def lineage(posts: DataFrame) -> DataFrame:
    """(mention_id, ancestor_id, distance) for all ancestors, each at its least distance, ids of parents missing from the table included.

    Distances double each round, so depth d takes log2(d) joins.  It ends when a round finds no new ancestor, which a cycle of parents
    comes to as well; no mention is its own ancestor."""
    step = posts.where("parent_id is not null and parent_id <> mention_id").groupBy("mention_id", F.col("parent_id").alias("ancestor_id")).agg(F.lit(1).alias("distance"))
    found = settle(step, "lineage")
    reach = 1
    while True:
        far = found.where(F.col("distance") == reach).select("mention_id", F.col("ancestor_id").alias("mid"))
        near = found.select(F.col("mention_id").alias("mid"), F.col("ancestor_id"), F.col("distance").alias("d"))
        new = far.join(near, "mid").where("ancestor_id <> mention_id").groupBy("mention_id", "ancestor_id").agg((F.min("d") + reach).alias("distance"))
        new = settle(new.join(found, ["mention_id", "ancestor_id"], "left_anti"), "lineage")
        if new.isEmpty():
            return found
        found = settle(found.unionByName(new), "lineage")
        reach *= 2


def neighbours(posts: DataFrame) -> DataFrame:
    """(mention_id, sibling_count, child_count): other mentions under the same parent, and direct replies."""
    children = posts.where("parent_id is not null").groupBy(F.col("parent_id").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    rows = posts.select("mention_id", "parent_id").join(children, F.col("parent_id") == F.col("p"), "left").select("mention_id", F.coalesce(F.col("n") - 1, F.lit(0)).alias("sibling_count"))
    own = children.select(F.col("p").alias("mention_id"), F.col("n").alias("child_count"))
    return rows.join(own, "mention_id", "left").withColumn("child_count", F.coalesce("child_count", F.lit(0)))


def contexts(posts: DataFrame) -> DataFrame:
    """(mention_id, context_text): the texts of root, parent and mention joined by ' | ', each only once."""
    texts = posts.select(F.col("mention_id").alias("id"), F.col("raw_text").alias("text"))
    root = roots(posts).join(texts, F.col("resolved_root_id") == F.col("id")).select("root_id", F.col("text").alias("root_text"))
    rows = posts.select("mention_id", "root_id", "parent_id", "raw_text").join(root, "root_id")
    rows = rows.join(texts.withColumnRenamed("text", "parent_text"), F.col("parent_id") == F.col("id"), "left")
    parent = F.when(F.length("parent_text") > 0, F.col("parent_text"))
    parts = F.array_distinct(F.array_compact(F.array("root_text", parent, "raw_text")))
    return rows.select("mention_id", F.array_join(parts, " | ").alias("context_text"))


def conversation_slice(posts: DataFrame, mention_id: str, window: int = 3) -> DataFrame:
    """(ancestor_id, distance) of the ``window`` nearest ancestors of one mention."""
    return lineage(posts).where((F.col("mention_id") == mention_id) & (F.col("distance") <= window)).select("ancestor_id", "distance")
