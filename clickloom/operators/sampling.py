"""A repeatable sample of sessions, spread over days and hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import joined_text, with_task_id
from clickloom.operators.ranking import top_per_group
from clickloom.operators.sessions import session_profile

# Fixed value: sessions to draw in all.
SAMPLE_SIZE = 100


def session_starts(actions: DataFrame, users: DataFrame) -> DataFrame:
    """Session id and start time of the sessions of known users.

    All that the sample is drawn from: no list is built for sessions that are not drawn.
    """
    starts = actions.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(
        F.min("user_id").alias("user_id"), F.min("action_time").alias("start_time")
    )
    known = starts.join(users.select("user_id"), "user_id")
    return known.where(F.col("start_time").isNotNull()).select("session_id", "start_time")


def _with_hour(starts: DataFrame) -> DataFrame:
    return starts.select(
        F.to_date("start_time").alias("date"), F.hour("start_time").alias("hour"), "session_id", "start_time"
    )


def _day_quotas(days: DataFrame, sample_size: int) -> DataFrame:
    """Of one row per day with its `day_count`: the number of sessions to draw from each.

    The sample is shared evenly over the days. A day with fewer sessions than its share
    gives all it has, and the places left are shared over the others; what cannot be shared
    evenly goes, one each, to the days with the most sessions, ties to the earlier day.
    """
    rising = Window.orderBy("day_count", F.desc("date"))
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = days.withColumns(
        {
            "from_here": F.count(F.lit(1)).over(everything) - F.row_number().over(rising) + 1,
            "taken": F.coalesce(F.sum("day_count").over(before), F.lit(0)),
        }
    )
    # a day whose count fits into an even share of what is left gives all it has
    whole = F.col("day_count") * F.col("from_here") + F.col("taken") <= sample_size
    open_ = F.when(~whole, 1)
    left = F.lit(sample_size).cast("bigint") - F.coalesce(F.sum(F.when(whole, F.col("day_count"))).over(everything), F.lit(0))
    shared = ranked.withColumns(
        {
            "whole": whole,
            "left": left,
            "open": F.count(open_).over(everything),
            "place": F.row_number().over(Window.orderBy(F.col("day_count").desc(), "date")),
        }
    )
    even = F.call_function("div", F.col("left"), F.col("open"))
    more = F.when(F.col("place") <= F.call_function("mod", F.col("left"), F.col("open")), 1).otherwise(0)
    return shared.select("date", F.when(F.col("whole"), F.col("day_count")).otherwise(even + more).alias("day_quota"))


def session_hour_counts(starts: DataFrame, sample_size: int = SAMPLE_SIZE, extra: int = 0) -> DataFrame:
    """Sessions per start day and hour, with the number to draw from each hour.

    The quotas add up to the sample size, or to all sessions if there are fewer. A day's
    share goes to its hours in proportion to their sessions, by largest remainder with ties
    to the earlier hour; an hour never gives more than it has. `extra` is added per hour, up
    to what it has. The day step sorts one row per day, the hour step at most 24 rows.
    """
    hours = _with_hour(starts).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("session_count"))
    of_day = Window.partitionBy("date")
    counted = hours.withColumn("day_count", F.sum("session_count").over(of_day))
    days = hours.groupBy("date").agg(F.sum("session_count").alias("day_count"))
    product = F.col("session_count") * F.col("day_quota")
    shared = counted.join(_day_quotas(days, sample_size), "date").withColumns(
        {
            "share": F.call_function("div", product, F.col("day_count")),
            "remainder": F.call_function("mod", product, F.col("day_count")),
        }
    )
    rest = F.col("day_quota") - F.sum("share").over(of_day)
    place = F.row_number().over(of_day.orderBy(F.desc("remainder"), "hour"))
    quota = F.col("share") + F.when(place <= rest, 1).otherwise(0)
    return shared.select(
        "date",
        "hour",
        "session_count",
        "day_count",
        F.least(F.col("session_count"), quota + extra).alias("quota"),
    )


def sampled_sessions(
    starts: DataFrame, sample_size: int = SAMPLE_SIZE, extra: int = 0, seed: str = "0"
) -> DataFrame:
    """The ids of the sampled sessions: at most `sample_size`, plus `extra` per hour.

    Sessions of an hour are drawn in the order of a seeded hash, so the same seed gives the
    same sample on any cluster. No quota exceeds `sample_size + extra`; cutting each hour to
    that many first lets every task drop the rest before the shuffle.
    """
    order = [F.md5(F.concat(F.lit(seed), F.col("session_id"))), F.col("session_id")]
    candidates = top_per_group(
        _with_hour(starts), ["date", "hour"], order, sample_size + extra, rank_column="draw"
    )
    quotas = session_hour_counts(starts, sample_size, extra).select("date", "hour", "quota")
    return candidates.join(quotas, ["date", "hour"]).where(F.col("draw") <= F.col("quota")).select("session_id")


def session_sample(actions: DataFrame, sampled: DataFrame, task_id: str) -> DataFrame:
    """The sampled sessions as a result table.

    Keywords and categories are gathered for the sampled sessions alone.
    """
    profile = session_profile(actions.join(sampled, "session_id", "left_semi"))
    return with_task_id(
        profile.select(
            "session_id",
            "start_time",
            joined_text(F.col("search_keywords")).alias("search_keywords"),
            # lists of ids keep the order of numbers, not of their text
            F.array_join(F.col("click_category_ids").cast("array<string>"), ",").alias("click_category_ids"),
        ),
        task_id,
    )
