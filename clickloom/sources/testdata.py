"""The given test tables in the shape of the action log, its dimensions and the ad log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parameters of the registered queries.
START_DATE = "2024-01-05"
END_DATE = "2024-01-25"
PAGE_FLOW = [1, 2, 3, 4, 5, 6, 7]
BLACKLIST_THRESHOLD = 2
# The ad streams are fed in this many parts, by day of the month.
STREAM_PARTS = 3
PART = "CAST(least((day(ts) - 1) div 10, 2) AS INT)"
SERIES_DATE = "2024-01-15"
SERIES_HOUR = 10
AREA_LEVELS = {"A Level": ["ASIA", "EUROPE"], "B Level": ["AMERICA"], "C Level": ["AFRICA"]}


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the files once, later reads are given it."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


_K = "CAST(get_json_object(props, '$.k') AS BIGINT)"


def actions_of(events: DataFrame) -> DataFrame:
    """Typed actions from event rows."""
    return events.selectExpr("event_id", "ts", "user_id", "event_type", f"{_K} AS k").selectExpr(
        "to_date(ts) AS date",
        "user_id",
        "concat_ws('-', user_id, replace(CAST(to_date(ts) AS STRING), '-', '')) AS session_id",
        "k % 10 AS page_id",
        "CAST(ts AS TIMESTAMP) AS action_time",
        "CASE WHEN event_type = 'view' THEN concat('kw', k % 10) END AS search_keyword",
        "CASE WHEN event_type = 'click' THEN k % 20 END AS click_category_id",
        "CASE WHEN event_type = 'click' THEN k END AS click_product_id",
        "CASE WHEN event_type = 'signup' THEN concat_ws(',', k % 20, (k * 7) % 20) END AS order_category_ids",
        "CASE WHEN event_type = 'signup' THEN CAST(k AS STRING) END AS order_product_ids",
        "CASE WHEN event_type = 'purchase' THEN concat_ws(',', k % 20, (k * 3) % 20) END AS pay_category_ids",
        "CASE WHEN event_type = 'purchase' THEN CAST(k AS STRING) END AS pay_product_ids",
        "user_id % 25 AS city_id",
        "event_id",
    )


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions_of(table(spark, sf_dir, "events"))


def raw_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same actions as logged: all text, hours not padded, keywords URL-encoded, blanks.

    Also here -1 stands for an absent clicked product.
    """
    return actions(spark, sf_dir).selectExpr(
        "CAST(date AS STRING) AS date",
        "CAST(user_id AS STRING) AS user_id",
        "session_id",
        "CAST(page_id AS STRING) AS page_id",
        "date_format(action_time, 'yyyy-MM-dd H:m:s') AS action_time",
        "coalesce(url_encode(concat('词 ', search_keyword)), '') AS search_keyword",
        "coalesce(CAST(click_category_id AS STRING), '') AS click_category_id",
        "coalesce(CAST(click_product_id AS STRING), '-1') AS click_product_id",
        "coalesce(order_category_ids, '') AS order_category_ids",
        "coalesce(order_product_ids, '') AS order_product_ids",
        "coalesce(pay_category_ids, '') AS pay_category_ids",
        "coalesce(pay_product_ids, '') AS pay_product_ids",
        "CAST(city_id AS STRING) AS city_id",
        "event_id",
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id",
        "c_name AS username",
        "c_name AS name",
        "CAST(c_custkey % 60 AS INT) AS age",
        "c_mktsegment AS professional",
        "concat('city', c_nationkey) AS city",
        "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        """concat('{"product_status": ', p_partkey % 2, '}') AS extend_info""",
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS city_id", "n_name AS city_name", "n_regionkey AS r_regionkey"
    )
    region = table(spark, sf_dir, "region").selectExpr("r_regionkey", "r_name AS area")
    return nation.join(region, "r_regionkey").select("city_id", "city_name", "area")


def ad_clicks_of(events: DataFrame) -> DataFrame:
    """Typed ad clicks from the click events."""
    return events.where("event_type = 'click'").selectExpr(
        "CAST(ts AS TIMESTAMP) AS ts",
        "CAST(user_id % 5 AS STRING) AS province",
        "CAST(user_id % 25 AS STRING) AS city",
        "user_id AS userid",
        f"{_K} % 10 AS adid",
    )


def ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_clicks_of(table(spark, sf_dir, "events"))


def ad_lines_of(events: DataFrame, *more: str) -> DataFrame:
    """Ad log lines: one per click event, and a cut-off line per error event."""
    return events.where("event_type IN ('click', 'error')").selectExpr(
        f"""CASE WHEN event_type = 'click'
            THEN concat_ws(' ', unix_millis(CAST(ts AS TIMESTAMP)), user_id % 5, user_id % 25, user_id, {_K} % 10)
            ELSE concat_ws(' ', unix_millis(CAST(ts AS TIMESTAMP)), user_id % 5) END AS value""",
        *more,
    )


def ad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_lines_of(table(spark, sf_dir, "events"))


def ad_lines_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ad log lines with the part of the month that they come in, from 0."""
    events = table(spark, sf_dir, "events")
    lines = ad_lines_of(events.withColumn("part", F.expr(PART)), "part")
    return lines
