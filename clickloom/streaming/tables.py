"""The result tables of the ad streams."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from clickloom.sinks.batch_table import ADD, APPEND, IGNORE, REPLACE_SLICE, BatchTable


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


STAT_SCHEMA = _schema(
    date=T.DateType(), province=T.StringType(), city=T.StringType(), adid=T.LongType(), click_count=T.LongType()
)
USER_COUNT_SCHEMA = _schema(date=T.DateType(), userid=T.LongType(), adid=T.LongType(), click_count=T.LongType())
BLACKLIST_SCHEMA = _schema(userid=T.LongType())
TOP_SCHEMA = _schema(date=T.DateType(), province=T.StringType(), adid=T.LongType(), click_count=T.LongType())
TREND_SCHEMA = _schema(date=T.DateType(), minute_start=T.TimestampType(), adid=T.LongType(), click_count=T.LongType())
PANE_SCHEMA = _schema(date=T.DateType(), pane=T.LongType(), adid=T.LongType(), click_count=T.LongType())
REJECT_SCHEMA = _schema(date=T.DateType(), value=T.StringType())
LOG_SCHEMA = _schema(
    ts=T.TimestampType(), province=T.StringType(), city=T.StringType(), userid=T.LongType(), adid=T.LongType()
)
STORED_LOG_SCHEMA = _schema(date=T.DateType(), **{field.name: field.dataType for field in LOG_SCHEMA})


def stat_table(spark: SparkSession, path: str, rule: str = ADD) -> BatchTable:
    return BatchTable(spark, path, STAT_SCHEMA, ["date", "province", "city", "adid"], rule, partition_by=["date"])


def user_count_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, USER_COUNT_SCHEMA, ["date", "userid", "adid"], ADD, partition_by=["date"])


def blacklist_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, BLACKLIST_SCHEMA, ["userid"], IGNORE)


def top_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, TOP_SCHEMA, ["date", "province"], REPLACE_SLICE, partition_by=["date"])


def trend_table(spark: SparkSession, path: str, rule: str = ADD) -> BatchTable:
    return BatchTable(spark, path, TREND_SCHEMA, ["date", "minute_start", "adid"], rule, partition_by=["date"])


def pane_table(spark: SparkSession, path: str) -> BatchTable:
    """Counts of the panes of sliding windows; `pane` is the second a pane begins."""
    return BatchTable(spark, path, PANE_SCHEMA, ["date", "pane", "adid"], ADD, partition_by=["date"])


def reject_table(spark: SparkSession, path: str) -> BatchTable:
    """Log lines that could not be read, under the day they were met."""
    return BatchTable(spark, path, REJECT_SCHEMA, [], APPEND, partition_by=["date"])


def log_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, STORED_LOG_SCHEMA, [], APPEND, partition_by=["date"])
