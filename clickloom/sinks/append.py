"""Append-only results, told apart by their task id."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def append_parquet(result: DataFrame, path: str) -> None:
    """Add the rows to a Parquet table, one directory per task id, in files of an even size."""
    result.hint("rebalance").write.mode("append").partitionBy("task_id").parquet(path)


def append_jdbc(
    result: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 16,
) -> None:
    """Add the rows to a database table; `connections` bounds the writers the database sees.

    The result is shuffled to the writers, so the work before it keeps all its tasks.
    """
    result.repartition(connections).write.jdbc(url, table, mode="append", properties=dict(properties or {}))
