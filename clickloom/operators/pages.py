"""Step-by-step page conversion along a given flow of pages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import half_up_ratio, with_task_id

# One row per range of the ordered log: what was counted in it, and its first and last action.
_RANGE = (
    "part int, start_pv long, pairs array<bigint>, "
    "first_session string, first_page long, last_session string, last_page long"
)
_RANGE_TYPES = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.string(), pa.int64(), pa.string(), pa.int64()]


def _pairs(flow: Sequence[int]) -> list[tuple[int, int]]:
    return list(zip(flow, flow[1:]))


def _count_range(start: int, pairs: list[tuple[int, int]]):
    """Counts in one range; columns: session (null for an action without a place in an order)
    and page. Batches are counted as Arrow vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, views = np.zeros(len(pairs), np.int64), 0
        first = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            sessions, pages = batch.columns
            views += pc.sum(pc.equal(pages, start)).as_py() or 0
            if first is None:
                first = sessions[0].as_py(), pages[0].as_py()
            else:
                # the last action of the batch before comes first
                sessions = pa.concat_arrays([pa.array([last[0]], sessions.type), sessions])
                pages = pa.concat_arrays([pa.array([last[1]], pages.type), pages])
            last = sessions[-1].as_py(), pages[-1].as_py()
            same = pc.equal(sessions[:-1], sessions[1:]).fill_null(False).to_numpy(zero_copy_only=False)
            known = pc.is_valid(pages).to_numpy(zero_copy_only=False)
            page = pages.fill_null(0).to_numpy()
            same &= known[:-1] & known[1:]
            for i, (one, following) in enumerate(pairs):
                counts[i] += np.count_nonzero(same & (page[:-1] == one) & (page[1:] == following))
        if first is not None:
            row = [TaskContext.get().partitionId(), views, counts.tolist(), *first, *last]
            yield pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(row, _RANGE_TYPES)],
                names=[field.split()[0] for field in _RANGE.split(", ")],
            )

    return run


def _flow_totals(actions: DataFrame, flow: Sequence[int], ranges: int | None) -> DataFrame:
    """One row: views of the first page (`start_pv`) and, per distinct pair, its count.

    A pair is a page and the next one in the same session. The log is put in order by session,
    time and id over ranges of about the same number of rows, which is the only shuffle; a
    session with a great share of all rows, even one of a single instant, is spread over many
    ranges. Each range gives one row with its counts; pairs over a border are found from the
    last and first actions of ranges. Actions without a session or a time only count as views.
    """
    pairs = list(dict.fromkeys(_pairs(flow)))
    tie_breaker = "event_id" if "event_id" in actions.columns else "page_id"
    timed = F.col("action_time").isNotNull()
    rows = actions.select(
        F.when(timed, F.col("session_id").cast("string")).alias("session"),
        F.col("action_time").alias("time"),
        F.col(tie_breaker).alias("tie"),
        F.col("page_id").cast("bigint").alias("page"),
    )
    order = ["session", "time", "tie"]
    ranged = rows.repartitionByRange(*([ranges] if ranges else []), *order).sortWithinPartitions(*order)
    counted = ranged.select("session", "page").mapInArrow(_count_range(flow[0], pairs), _RANGE)
    # one row per range
    following = Window.partitionBy(F.lit(0)).orderBy("part")
    crossed = counted.select(
        "start_pv",
        "pairs",
        "last_page",
        F.lead("first_page").over(following).alias("next_page"),
        (F.col("last_session") == F.lead("first_session").over(following)).alias("crossed"),
    )
    return crossed.agg(
        F.expr("coalesce(sum(start_pv), 0) AS start_pv"),
        *[
            F.expr(
                f"coalesce(sum(pairs[{i}]), 0)"
                f" + count_if(crossed AND last_page = {page} AND next_page = {following}) AS pair_{i}"
            )
            for i, (page, following) in enumerate(pairs)
        ],
    )


def _flow_steps(actions: DataFrame, flow: Sequence[int], ranges: int | None) -> DataFrame:
    """One row per step of the flow: its pair, count, and the count of the step before."""
    if len(flow) < 2:
        raise ValueError("a page flow needs at least two pages")
    flow = [int(page) for page in flow]
    pairs = _pairs(flow)
    column_of = {pair: f"pair_{i}" for i, pair in enumerate(dict.fromkeys(pairs))}
    before = ["start_pv"] + [column_of[pair] for pair in pairs[:-1]]
    rows = [
        f"struct({step} AS step, {pair[0]}L AS from_page, {pair[1]}L AS to_page, "
        f"{column_of[pair]} AS pair_count, {base} AS base_count)"
        for step, (pair, base) in enumerate(zip(pairs, before), start=1)
    ]
    return _flow_totals(actions, flow, ranges).selectExpr(f"inline(array({', '.join(rows)}))")


def page_transition_counts(
    actions: DataFrame, flow: Sequence[int], ranges: int | None = None
) -> DataFrame:
    """How often each pair of the flow occurs as consecutive pages of a session."""
    steps = _flow_steps(actions, flow, ranges)
    return steps.select("step", "from_page", "to_page", "pair_count")


def page_start_pv(actions: DataFrame, start_page: int) -> DataFrame:
    """One row: views of the first page of the flow."""
    return (
        actions.where(F.col("page_id") == start_page)
        .agg(F.count(F.lit(1)).alias("start_pv"))
        .select(F.lit(start_page).cast("bigint").alias("page_id"), "start_pv")
    )


def page_convert_rate(
    actions: DataFrame, flow: Sequence[int], ranges: int | None = None
) -> DataFrame:
    """Rate of each step: its count over the step before, the first over the start page's views.

    A step whose base is 0 has no rate.
    """
    steps = _flow_steps(actions, flow, ranges)
    rate = half_up_ratio(F.col("pair_count"), F.col("base_count"))
    return steps.select("step", "from_page", "to_page", "pair_count", "base_count", rate.alias("convert_rate"))


def page_convert_rate_text(rates: DataFrame, task_id: str) -> DataFrame:
    """All steps in one text, ``a_b=rate`` joined by bars."""
    text = F.concat(
        F.concat_ws("_", F.col("from_page").cast("string"), F.col("to_page").cast("string")),
        F.lit("="),
        F.coalesce(F.col("convert_rate").cast("string"), F.lit("")),
    )
    in_order = F.array_sort(F.collect_list(F.struct("step", text.alias("text"))))
    joined = F.array_join(F.transform(in_order, lambda item: item["text"]), "|")
    return with_task_id(rates.agg(joined.alias("convert_rate")), task_id)
