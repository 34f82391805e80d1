"""Top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    rows: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    limit: int,
    rank_column: str = "rank",
) -> DataFrame:
    """The first `limit` rows of each group, numbered from 1.

    Filtering the row number by a literal lets Spark keep only `limit` rows per group in
    each task before the shuffle, so a group with most of the rows still reaches the
    ranking task with at most `limit` rows per upstream task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(rank_column, F.row_number().over(window)).where(F.col(rank_column) <= limit)
