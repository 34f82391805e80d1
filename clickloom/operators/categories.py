"""Category ranking, and the sessions most active in each top category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import with_task_id
from clickloom.operators.ranking import top_per_group

# Length of the category list and of each session list.
TOP_CATEGORIES = 10
TOP_SESSIONS = 10


def category_counts(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category, for every category that has any.

    One pass: each action becomes its (kind, category) items, and one aggregate counts the
    kinds. Counting starts before the shuffle, so a popular category costs no more. The
    lists are taken apart as text and cast afterwards, which stays in generated code.
    """
    sources = {"click": "click_category_id", "order": "order_category_ids", "pay": "pay_category_ids"}
    any_list = F.coalesce(*[F.col(source).cast("string") for source in sources.values()]).isNotNull()
    lists = actions.where(any_list).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(kind).alias("kind"), F.col(source).cast("string").alias("ids"))
                    for kind, source in sources.items()
                ]
            )
        )
    ).where(F.col("ids").isNotNull())
    items = lists.select("kind", F.explode(F.split("ids", ",")).alias("item")).select(
        "kind", F.trim("item").try_cast("bigint").alias("category_id")
    )
    return (
        items.where(F.col("category_id").isNotNull())
        .groupBy("category_id")
        .agg(*[F.count_if(F.col("kind") == kind).alias(f"{kind}_count") for kind in sources])
    )


def category_top(counts: DataFrame, limit: int = TOP_CATEGORIES) -> DataFrame:
    """The first categories by clicks, then orders, then payments."""
    return counts.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")
    ).limit(limit)


def category_top10(counts: DataFrame, task_id: str) -> DataFrame:
    """The top categories as a result table."""
    return with_task_id(category_top(counts), task_id)


def category_session_counts(actions: DataFrame) -> DataFrame:
    """Clicks per category and session; actions without a session id are left out."""
    return (
        actions.where(F.col("click_category_id").isNotNull() & F.col("session_id").isNotNull())
        .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
    )


def top_sessions(
    actions: DataFrame, top_categories: DataFrame, limit: int = TOP_SESSIONS
) -> DataFrame:
    """The sessions with the most clicks in each given category.

    Clicks in other categories are dropped before they are counted; a short list of
    categories is sent to the tasks that read, by Spark's own measure of its size.
    """
    wanted = top_categories.select(F.col("category_id").alias("click_category_id"))
    counts = category_session_counts(actions.join(wanted, "click_category_id", "left_semi"))
    order = [F.desc("click_count"), F.asc("session_id")]
    return top_per_group(counts, ["category_id"], order, limit).drop("rank")


def category_top_sessions(actions: DataFrame, top_categories: DataFrame, task_id: str) -> DataFrame:
    """The top sessions of each top category as a result table."""
    return with_task_id(top_sessions(actions, top_categories), task_id)
