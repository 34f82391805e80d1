"""Jobs in the plain shape, for comparison only: groups gathered whole, one join per count.

They give the same results as the jobs of the same name and do not scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.operators import areas, categories, sessions
from clickloom.plans import parameters as P
from clickloom.sources import testdata as D


def plain_session_ratio_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole sessions are gathered, and their lists built, before the users are filtered."""
    grouped = D.actions(spark, sf_dir).groupBy("session_id").agg(
        F.collect_list(F.struct("user_id", "action_time", "search_keyword", "click_category_id")).alias("rows")
    )
    profile = grouped.select(
        "session_id",
        F.array_min("rows.user_id").alias("user_id"),
        (F.unix_timestamp(F.array_max("rows.action_time")) - F.unix_timestamp(F.array_min("rows.action_time"))).alias(
            "visit_length"
        ),
        F.size("rows").cast("bigint").alias("step_length"),
        F.array_distinct("rows.search_keyword").alias("search_keywords"),
        F.array_distinct("rows.click_category_id").alias("click_category_ids"),
    )
    joined = profile.join(D.users(spark, sf_dir), "user_id")
    passing = sessions.filter_sessions(joined, P.AGE_FILTER)
    return sessions.session_ratio_stat(sessions.session_bucket_counts(passing), P.TASK_ID)


def plain_category_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All categories first, then one count and one outer join per kind."""
    actions = D.actions(spark, sf_dir)

    def of_kind(column: str) -> DataFrame:
        listed = actions.where(F.col(column).isNotNull())
        items = listed.select(F.explode(F.split(F.col(column).cast("string"), ",")).alias("item"))
        return items.select(F.col("item").cast("bigint").alias("category_id"))

    kinds = {"click": "click_category_id", "order": "order_category_ids", "pay": "pay_category_ids"}
    parts = [of_kind(column) for column in kinds.values()]
    counts = parts[0].union(parts[1]).union(parts[2]).distinct()
    for kind, part in zip(kinds, parts):
        counted = part.groupBy("category_id").agg(F.count(F.lit(1)).alias(f"{kind}_count"))
        counts = counts.join(counted, "category_id", "left")
    return categories.category_top10(counts.na.fill(0), P.TASK_ID)


def plain_page_convert_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole sessions are gathered and sorted as arrays, and every pair is counted."""
    gathered = D.actions(spark, sf_dir).groupBy("session_id").agg(
        F.array_sort(F.collect_list(F.struct("action_time", "event_id", "page_id"))).alias("rows")
    )
    page_ids = F.col("rows.page_id")
    pairs = F.arrays_zip(
        F.slice(page_ids, F.lit(1), F.size("rows") - 1).alias("a"),
        F.slice(page_ids, F.lit(2), F.size("rows") - 1).alias("b"),
    )
    return gathered.select(F.inline(pairs).alias("from_page", "to_page")).groupBy("from_page", "to_page").count()


def plain_area_top3_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks are joined with their city one by one, then grouped."""
    clicks = areas.area_clicks(D.actions(spark, sf_dir), D.cities(spark, sf_dir))
    counts = clicks.groupBy("area", "product_id").agg(
        F.count(F.lit(1)).alias("click_count"),
        F.array_join(
            F.array_sort(F.collect_set(F.concat_ws(":", F.col("city_id").cast("string"), "city_name"))), ","
        ).alias("city_infos"),
    )
    full = areas.area_product_full(counts, D.products(spark, sf_dir))
    ranked = full.withColumn(
        "rank", F.row_number().over(Window.partitionBy("area").orderBy(F.desc("click_count"), "product_id"))
    )
    return ranked.where(F.col("rank") <= F.lit(3))


def plain_queries():
    plans = [plain_session_ratio_stat, plain_category_top10, plain_page_convert_rate, plain_area_top3_product]
    return {plan.__name__: plan for plan in plans}
