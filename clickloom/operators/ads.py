"""Ad click counts, blacklist, ranking and trends over a set of clicks.

The functions work on clicks of any origin: a stored log, or one batch of a stream.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.ranking import top_per_group

# Daily clicks on one ad that put a user on the blacklist; ads kept per province.
BLACKLIST_THRESHOLD = 10
TOP_ADS = 3
# Seconds of the sliding window of the trend, and between its ends.
WINDOW_SECONDS, SLIDE_SECONDS = 60, 5
# Running sums of one ad are cut into blocks of this many seconds.
BLOCK_SECONDS = 3600


def ad_user_daily_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per day, user and ad."""
    return clicks.groupBy(F.to_date("ts").alias("date"), "userid", "adid").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def ad_blacklist(daily_counts: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users who reached the threshold on any day with any ad."""
    return daily_counts.where(F.col("click_count") >= threshold).select("userid").distinct()


def ad_filtered_log(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users not on the blacklist.

    The list grows with the data, so no broadcast is asked for: Spark picks one only while
    the list is under its size limit, and otherwise splits the partitions of busy users.
    """
    return clicks.join(blacklist.select("userid"), "userid", "left_anti").select(*clicks.columns)


def ad_stat(clicks: DataFrame) -> DataFrame:
    """Clicks per day, province, city and ad."""
    return clicks.groupBy(F.to_date("ts").alias("date"), "province", "city", "adid").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def ad_province_top3(stat: DataFrame, limit: int = TOP_ADS) -> DataFrame:
    """The most clicked ads per day and province."""
    by_province = stat.groupBy("date", "province", "adid").agg(F.sum("click_count").alias("click_count"))
    order = [F.desc("click_count"), F.asc("adid")]
    return top_per_group(by_province, ["date", "province"], order, limit).drop("rank")


def trend_columns(minute_counts: DataFrame) -> DataFrame:
    """Counts keyed by the minute's timestamp (`minute_start`) in result form."""
    return minute_counts.select(
        F.to_date("minute_start").alias("date"),
        F.date_format("minute_start", "HH").alias("hour"),
        F.date_format("minute_start", "mm").alias("minute"),
        "adid",
        "click_count",
    )


def recent(rows: DataFrame, time_column: str, horizon: str | None) -> DataFrame:
    """Rows of the minutes within the horizon, measured back from the minute of the latest
    time; all rows if None. Whole minutes, so that clicks and stored minutes agree."""
    if horizon is None:
        return rows
    minute = F.date_trunc("minute", F.col(time_column))
    latest = rows.agg(F.max(minute)).scalar()
    return rows.where(minute > latest - F.expr(f"INTERVAL {horizon}"))


def ad_click_trend(clicks: DataFrame, horizon: str | None = None) -> DataFrame:
    """Clicks per minute and ad, if asked only for the last hour or other horizon."""
    counts = (
        recent(clicks.select("ts", "adid"), "ts", horizon)
        .groupBy(F.date_trunc("minute", "ts").alias("minute_start"), "adid")
        .agg(F.count(F.lit(1)).alias("click_count"))
    )
    return trend_columns(counts)


def pane_counts(clicks: DataFrame, slide: int = SLIDE_SECONDS) -> DataFrame:
    """Clicks per pane and ad; a pane is the time between two ends of sliding windows."""
    return clicks.groupBy(_floor(F.unix_seconds("ts"), slide).alias("pane"), "adid").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def _floor(seconds: Column, unit: int) -> Column:
    """The seconds cut down to whole units, before 1970 too."""
    return seconds - F.pmod(seconds, F.lit(unit).cast("bigint"))


def sliding_counts(panes: DataFrame, window: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS) -> DataFrame:
    """Clicks per ad in every window of `window` seconds that ends on a multiple of `slide`
    and holds a click of the ad: window_end, adid, click_count.

    `panes` are counts from `pane_counts`. A pane enters the windows once and leaves them once,
    so a window's count is a running sum of what enters and leaves, and no click is copied for
    each window it is in. The sums run inside blocks of an hour, to which the sum of all blocks
    before is added; an ad with a great share of all clicks is thus spread over tasks. Counts
    are written out per window at the very end, where the result asks for them.
    """
    if window % slide:
        raise ValueError("the window must be a multiple of the slide")
    step = lambda moved, sign: F.struct(
        (F.col("pane") + moved).alias("at"), (F.col("click_count") * sign).alias("change")
    )
    moves = panes.select("adid", F.inline(F.array(step(slide, 1), step(slide + window, -1))))
    moves = moves.groupBy("adid", _floor(F.col("at"), BLOCK_SECONDS).alias("block"), "at").agg(F.sum("change").alias("change"))
    inside = Window.partitionBy("adid", "block").orderBy("at")
    local = moves.select(
        "adid",
        "block",
        "at",
        F.sum("change").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"),
        F.lead("at").over(inside).alias("next_at"),
    )
    blocks = moves.groupBy("adid", "block").agg(F.sum("change").alias("change"), F.min("at").alias("first_at"))
    in_turn = Window.partitionBy("adid").orderBy("block")
    blocks = blocks.select(
        F.col("adid").alias("block_adid"),
        F.col("block").alias("block_start"),
        F.sum("change").over(in_turn.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.lead("first_at").over(in_turn).alias("next_block_at"),
    )
    same = F.col("adid").eqNullSafe(F.col("block_adid")) & (F.col("block") == F.col("block_start"))
    held = local.join(blocks, same).select(
        "adid",
        "at",
        (F.col("so_far") + F.coalesce("before", F.lit(0))).alias("click_count"),
        F.coalesce("next_at", "next_block_at").alias("until"),
    )
    ends = F.sequence(F.col("at"), F.col("until") - slide, F.lit(slide).cast("bigint"))
    windows = held.where("click_count > 0").select(F.explode(ends).alias("end"), "adid", "click_count")
    return windows.select(F.timestamp_seconds("end").alias("window_end"), "adid", "click_count")


def ad_sliding_trend(clicks: DataFrame, window: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS) -> DataFrame:
    """Clicks per ad in every sliding window that holds one."""
    return sliding_counts(pane_counts(clicks, slide), window, slide)


def ad_trend_series(trend: DataFrame, day: str | date, hour: int) -> DataFrame:
    """For one hour, 60 points per ad, 0 where a minute has no clicks, with the line's
    maximum, minimum and average.

    The points of an ad are at most 60 rows, so they are gathered into a map and laid out
    along the minutes; no grid of ads and minutes has to be joined.
    """
    of_hour = trend.where((F.col("date") == F.lit(str(day)).cast("date")) & (F.col("hour") == f"{hour:02d}"))
    lines = (
        of_hour.groupBy("adid", F.col("minute").cast("int").alias("minute"))
        .agg(F.sum("click_count").alias("click_count"))
        .groupBy("adid")
        .agg(F.map_from_entries(F.collect_list(F.struct("minute", "click_count"))).alias("points"))
        .select(
            "adid",
            F.transform(
                F.sequence(F.lit(0), F.lit(59)),
                lambda minute: F.coalesce(F.try_element_at("points", minute), F.lit(0).cast("bigint")),
            ).alias("line"),
        )
    )
    total = F.aggregate("line", F.lit(0).cast("bigint"), lambda sum_, point: sum_ + point)
    return lines.select(
        "adid",
        F.array_max("line").alias("max_count"),
        F.array_min("line").alias("min_count"),
        (total / F.lit(60.0)).alias("avg_count"),
        F.posexplode("line").alias("minute", "click_count"),
    ).select("adid", "minute", "click_count", "max_count", "min_count", "avg_count")
