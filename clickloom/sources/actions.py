"""The action log and its dimension tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import blank_to_null, clean_id, clean_time

ID_COLUMNS = ("user_id", "page_id", "click_category_id", "click_product_id", "city_id")
LIST_COLUMNS = ("order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids")

# Columns of a cleaned action, in table order. An `event_id` column is kept if the
# log has one: it orders actions of the same instant.
ACTION_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("action_time", T.TimestampType()),
        T.StructField("search_keyword", T.StringType()),
        T.StructField("click_category_id", T.LongType()),
        T.StructField("click_product_id", T.LongType()),
        T.StructField("order_category_ids", T.StringType()),
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),
        T.StructField("pay_product_ids", T.StringType()),
        T.StructField("city_id", T.LongType()),
    ]
)

# Columns of the user table.
USER_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("professional", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("sex", T.StringType()),
    ]
)

# Columns of the product table.
PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("extend_info", T.StringType()),
    ]
)

# The city dimension (city id, city name, area).
CITIES = [
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]


def in_date_range(
    actions: DataFrame,
    start_date: str | date | None = None,
    end_date: str | date | None = None,
) -> DataFrame:
    """Actions whose `date` lies in the range, both ends included; a missing end is open.

    The bounds are compared with the stored column itself, so the filter reaches the
    Parquet scan and prunes directories of a log partitioned by `date`.
    """
    if start_date is not None:
        actions = actions.where(F.col("date") >= F.lit(str(start_date)))
    if end_date is not None:
        actions = actions.where(F.col("date") <= F.lit(str(end_date)))
    return actions


def clean_actions(
    raw: DataFrame,
    start_date: str | date | None = None,
    end_date: str | date | None = None,
) -> DataFrame:
    """Typed actions in a date range, from a log whose columns are text or already typed.

    Text is trimmed and blank becomes NULL, times and keywords are URL-decoded (a keyword
    that is not encoded stays as it is), ids become bigint with NULL for blank or -1.
    """
    kinds = {field.name: field.dataType for field in raw.schema.fields}

    def cleaned(name: str):
        column = F.col(name)
        is_text = isinstance(kinds[name], T.StringType)
        if name == "date":
            return column.try_cast("date") if is_text else column.cast("date")
        if name == "action_time":
            return clean_time(column) if is_text else column.cast("timestamp")
        if name in ID_COLUMNS:
            if is_text:
                return clean_id(column)
            return F.nullif(column.cast("bigint"), F.lit(-1).cast("bigint"))
        if name == "search_keyword":
            return blank_to_null(F.coalesce(F.try_url_decode(column), column))
        return blank_to_null(column)

    columns = [cleaned(name).alias(name) for name in ACTION_SCHEMA.fieldNames()]
    if "event_id" in kinds:
        columns.append(F.col("event_id"))
    return in_date_range(raw, start_date, end_date).select(*columns)


def unreadable_times(raw: DataFrame) -> DataFrame:
    """One row: actions, and those whose time is there but cannot be read. They count as
    steps, but not for lengths, starts or the page order."""
    time = F.col("action_time")
    kind = raw.schema["action_time"].dataType
    read = clean_time(time) if isinstance(kind, T.StringType) else time.cast("timestamp")
    given = F.trim(time.cast("string")) != ""
    return raw.agg(
        F.count(F.lit(1)).alias("action_count"), F.count_if(given & read.isNull()).alias("unreadable_count")
    )


def read_actions(
    spark: SparkSession,
    path: str,
    start_date: str | date | None = None,
    end_date: str | date | None = None,
    source_format: str = "parquet",
) -> DataFrame:
    """Scan a stored action log and clean it."""
    return clean_actions(spark.read.format(source_format).load(path), start_date, end_date)


def write_actions(actions: DataFrame, path: str) -> None:
    """Store cleaned actions by day, so that date ranges prune directories.

    Rows are rebalanced by day: adaptive execution splits the days with the most rows over
    many tasks and merges small ones, which gives files of an even size.
    """
    actions.hint("rebalance", F.col("date")).write.mode("overwrite").partitionBy("date").parquet(path)


def write_session_log(actions: DataFrame, table: str, path: str, buckets: int) -> None:
    """Store cleaned actions as a table bucketed by session and sorted by time.

    Profiles, session filters and detail joins read it without a shuffle of the log, as long as
    there are no fewer buckets than shuffle partitions. A session lies in one bucket, so this layout is for logs where no session has more rows than a bucket
    should hold; others stay in the layout by day, whose jobs split busy sessions.
    """
    named = actions.where(F.col("session_id").isNotNull()).repartition(buckets, "session_id")
    writer = named.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, "session_id").sortBy("session_id", "action_time").saveAsTable(table)


def read_session_log(
    spark: SparkSession, table: str, start_date: str | date | None = None, end_date: str | date | None = None
) -> DataFrame:
    """The actions of a table from `write_session_log`."""
    return in_date_range(spark.table(table), start_date, end_date)


def city_dimension(spark: SparkSession) -> DataFrame:
    """The literal city table."""
    return spark.createDataFrame(CITIES, "city_id bigint, city_name string, area string")
