"""Shaping of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: time pattern of the result tables.
RESULT_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"


def with_task_id(result: DataFrame, task_id: str) -> DataFrame:
    """Stamp the run's id as the first column."""
    return result.select(F.lit(task_id).alias("task_id"), "*")


def text_result(result: DataFrame) -> DataFrame:
    """Dates, times and lists as text, the form in which result tables are stored."""

    def as_text(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, RESULT_TIME_PATTERN).alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(column.cast("array<string>"), ",").alias(field.name)
        return column

    return result.select(*[as_text(field) for field in result.schema.fields])
