"""Whole jobs: from inputs and task parameters to result tables.

Each job returns its result tables by name, as DataFrames in result-table form. Nothing
runs until they are written, for example by `write_results`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import text_result, with_task_id
from clickloom.functions.columns import AREA_LEVELS, OTHER_AREA_LEVEL
from clickloom.operators import areas, categories, pages, sampling, sessions
from clickloom.operators.sessions import SessionFilter
from clickloom.plans.session import work_dir
from clickloom.sinks import append_parquet

Results = dict[str, DataFrame]


def new_task_id() -> str:
    return str(uuid.uuid4())


def session_job(
    actions: DataFrame,
    users: DataFrame,
    task_id: str,
    session_filter: SessionFilter = SessionFilter(),
    sample_size: int = sampling.SAMPLE_SIZE,
    extra_per_hour: int = 0,
    seed: str = "0",
    sessions_from: str = "all",
    folder: str | None = None,
) -> Results:
    """Length ratios of the filtered sessions; sample and top lists over all sessions, or over
    the filtered ones with `sessions_from="filtered"`.

    The lengths of filtered sessions are counted into buckets while they are written. The small
    results that others build on (filtered ids if asked for, sampled ids, top
    categories and top sessions) are written to `folder`, by default one of the working
    directory, and read back; both sets of details are then one join with the log.
    """
    if sessions_from not in ("all", "filtered"):
        raise ValueError("sessions_from is 'all' or 'filtered'")
    folder = folder or work_dir(actions.sparkSession, "session-job")

    def kept(rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
        return actions.sparkSession.read.schema(rows.schema).parquet(f"{folder}/{name}")

    lengths = sessions.filtered_session_lengths(actions, users, session_filter)
    source = actions
    buckets = sessions.session_bucket_counts(lengths)
    if sessions_from == "filtered":
        lengths, buckets = sessions.observed_bucket_counts(lengths, lambda rows: kept(rows, "filtered"))
        source = actions.join(lengths.select("session_id"), "session_id", "left_semi")
    starts = sampling.session_starts(source, users)
    sampled = kept(sampling.sampled_sessions(starts, sample_size, extra_per_hour, seed), "sampled")
    top = kept(categories.category_top(categories.category_counts(source)), "top-categories")
    active = kept(categories.top_sessions(source, top), "top-sessions")
    chosen = sampled.withColumn("drawn", F.lit(1)).unionByName(
        active.select("session_id").distinct().withColumn("drawn", F.lit(0))
    )
    detail = actions.join(chosen.select("session_id", "drawn"), "session_id").select(*sessions.DETAIL_COLUMNS)
    return {
        "session_stat_ratio": sessions.session_ratio_stat(buckets, task_id),
        "session_random_extract": text_result(sampling.session_sample(actions, sampled, task_id)),
        # a session that is both sampled and in a top list has its actions in both sets
        "session_detail": text_result(with_task_id(detail, task_id)),
        "top10_category": with_task_id(top, task_id),
        "top10_session": with_task_id(active, task_id),
    }


def page_job(actions: DataFrame, flow: Sequence[int], task_id: str) -> Results:
    """Conversion rates along the page flow."""
    rates = pages.page_convert_rate(actions, flow)
    return {"page_split_convert_rate": pages.page_convert_rate_text(rates, task_id)}


def area_job(
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    task_id: str,
    levels: Mapping[str, Sequence[str]] = AREA_LEVELS,
    other_level: str = OTHER_AREA_LEVEL,
) -> Results:
    """Most clicked products of each area."""
    full = areas.area_product_full(areas.area_product_counts(actions, cities), products)
    return {"area_top3_product": areas.area_top3_product(full, task_id, levels, other_level)}


def write_results(
    results: Results, folder: str, writer: Callable[[DataFrame, str], None] = append_parquet
) -> None:
    """Append each result table under its name in the folder."""
    for name, result in results.items():
        writer(result, f"{folder.rstrip('/')}/{name}")
