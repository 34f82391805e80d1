"""Session profiles, session filters, and the spread of visit and step lengths."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickloom.functions import half_up_ratio, with_task_id

# Bucket names with inclusive bounds, in seconds and in actions.
VISIT_LENGTH_BUCKETS = [
    ("visit_length_1s_3s", 1, 3),
    ("visit_length_4s_6s", 4, 6),
    ("visit_length_7s_9s", 7, 9),
    ("visit_length_10s_30s", 10, 30),
    ("visit_length_30s_60s", 31, 60),
    ("visit_length_1m_3m", 61, 180),
    ("visit_length_3m_10m", 181, 600),
    ("visit_length_10m_30m", 601, 1800),
    ("visit_length_30m", 1801, None),
]
STEP_LENGTH_BUCKETS = [
    ("step_length_1_3", 1, 3),
    ("step_length_4_6", 4, 6),
    ("step_length_7_9", 7, 9),
    ("step_length_10_30", 10, 30),
    ("step_length_30_60", 31, 60),
    ("step_length_60", 61, None),
]

# Columns of the detail table.
DETAIL_COLUMNS = (
    "user_id",
    "session_id",
    "page_id",
    "action_time",
    "search_keyword",
    "click_category_id",
    "click_product_id",
    "order_category_ids",
    "order_product_ids",
    "pay_category_ids",
    "pay_product_ids",
)


@dataclass(frozen=True)
class SessionFilter:
    """Task parameters that pick sessions; an empty parameter does not filter."""

    start_age: int | None = None
    end_age: int | None = None
    professionals: Sequence[str] = ()
    cities: Sequence[str] = ()
    sex: str | None = None
    keywords: Sequence[str] = ()
    category_ids: Sequence[int] = ()

    def user_predicates(self) -> list[Column]:
        predicates = []
        # the age range applies only if both ends are given
        if self.start_age is not None and self.end_age is not None:
            predicates.append(F.col("age").between(self.start_age, self.end_age))
        if self.professionals:
            predicates.append(F.col("professional").isin(list(self.professionals)))
        if self.cities:
            predicates.append(F.col("city").isin(list(self.cities)))
        if self.sex:
            predicates.append(F.col("sex") == self.sex)
        return predicates

    def action_matches(self) -> dict[str, Column]:
        """Per action, whether it satisfies each list parameter by itself."""
        matches = {}
        if self.keywords:
            matches["keyword_match"] = F.col("search_keyword").isin(list(self.keywords))
        if self.category_ids:
            matches["category_match"] = F.col("click_category_id").isin(list(self.category_ids))
        return matches

    def profile_predicates(self) -> list[Column]:
        predicates = self.user_predicates()
        if self.keywords:
            wanted = F.array(*[F.lit(keyword) for keyword in self.keywords])
            predicates.append(F.arrays_overlap("search_keywords", wanted))
        if self.category_ids:
            wanted = F.array(*[F.lit(item).cast("bigint") for item in self.category_ids])
            predicates.append(F.arrays_overlap("click_category_ids", wanted))
        return predicates


def _where_all(rows: DataFrame, predicates: list[Column]) -> DataFrame:
    return rows.where(reduce(and_, predicates)) if predicates else rows


def _visit_length() -> Column:
    return F.unix_timestamp("end_time") - F.unix_timestamp("start_time")


def session_profile(actions: DataFrame) -> DataFrame:
    """One row per session: user, first and last time, length, actions, keywords, categories.

    Built in two steps: per session, keyword and category, then per session. The first one
    has aggregates of fixed size only, which start before the shuffle, and its keys spread a
    session with a great share of all rows over many tasks. The second one sees each keyword
    and category of a session about once, however often it occurs; a list is as long as the
    session has distinct items (`session_items` has them as rows). Actions without a session
    id belong to no session and are left out.
    """
    of_sessions = actions.where(F.col("session_id").isNotNull())
    combined = of_sessions.groupBy("session_id", "search_keyword", "click_category_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
    )
    return (
        combined.groupBy("session_id")
        .agg(
            F.min("user_id").alias("user_id"),
            F.min("start_time").alias("start_time"),
            F.max("end_time").alias("end_time"),
            F.sum("step_length").alias("step_length"),
            F.array_sort(F.collect_set("search_keyword")).alias("search_keywords"),
            F.array_sort(F.collect_set("click_category_id")).alias("click_category_ids"),
        )
        .select(
            "session_id",
            "user_id",
            "start_time",
            "end_time",
            _visit_length().alias("visit_length"),
            "step_length",
            "search_keywords",
            "click_category_ids",
        )
    )


def session_items(actions: DataFrame) -> DataFrame:
    """The keywords and categories of sessions as rows: session, kind, value. For sessions
    with more distinct items than fit into a list."""
    kinds = {"keyword": "search_keyword", "category": "click_category_id"}
    items = F.array(
        *[F.struct(F.lit(kind).alias("kind"), F.col(name).cast("string").alias("value")) for kind, name in kinds.items()]
    )
    rows = actions.where(F.col("session_id").isNotNull()).select("session_id", F.inline(items))
    return rows.where(F.col("value").isNotNull()).distinct()


def session_user_profile(profile: DataFrame, users: DataFrame) -> DataFrame:
    """Profiles with the traits of their user; sessions of unknown users drop out."""
    traits = users.select("user_id", "age", "professional", "sex", "city")
    return profile.join(traits, "user_id").select(*profile.columns, "age", "professional", "sex", "city")


def filter_sessions(user_profile: DataFrame, session_filter: SessionFilter) -> DataFrame:
    """Profiles that pass the task parameters."""
    return _where_all(user_profile, session_filter.profile_predicates())


def filtered_session_lengths(actions: DataFrame, users: DataFrame, session_filter: SessionFilter) -> DataFrame:
    """Visit and step length of the sessions that pass, without building their lists.

    The same sessions as `filter_sessions` over the full profile, but the list parameters
    are tested per action and folded with `bool_or`. All aggregates then have fixed size:
    one shuffle, and a session of any size arrives as one row per upstream task.
    """
    matches = session_filter.action_matches()
    sessions = actions.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
        *[F.bool_or(match).alias(name) for name, match in matches.items()],
    )
    passing = _where_all(sessions, [F.col(name) for name in matches])
    wanted_users = _where_all(users, session_filter.user_predicates()).select("user_id")
    return passing.join(wanted_users, "user_id").select(
        "session_id", "user_id", _visit_length().alias("visit_length"), "step_length"
    )


def filtered_session_profile(
    actions: DataFrame, users: DataFrame, session_filter: SessionFilter
) -> DataFrame:
    """Profiles with traits of the sessions that pass the task parameters.

    The same rows as `filter_sessions` gives, but the passing sessions are found first, by
    aggregates of fixed size, and lists are gathered for these alone.
    """
    passing = filtered_session_lengths(actions, users, session_filter).select("session_id")
    profile = session_profile(actions.join(passing, "session_id", "left_semi"))
    return session_user_profile(profile, users)


def _bucket_count(length: str, name: str, low: int, high: int | None) -> Column:
    upper = "" if high is None else f" AND {length} <= {high}"
    return F.expr(f"count_if({length} >= {low}{upper}) AS {name}")


def bucket_metrics() -> list[Column]:
    """The number of sessions, and of those in each length bucket."""
    return [
        F.count(F.lit(1)).alias("session_count"),
        *[_bucket_count("visit_length", *bucket) for bucket in VISIT_LENGTH_BUCKETS],
        *[_bucket_count("step_length", *bucket) for bucket in STEP_LENGTH_BUCKETS],
    ]


def session_bucket_counts(sessions: DataFrame) -> DataFrame:
    """One row: the number of sessions, and of those in each length bucket."""
    return sessions.agg(*bucket_metrics())


def observed_bucket_counts(
    sessions: DataFrame, write: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """What `write` gives for the sessions, and `session_bucket_counts` of them, taken while
    they are written: the rows are not read again to be counted."""
    observation = Observation("session_buckets")
    written = write(sessions.observe(observation, *bucket_metrics()))
    fields = [f"{name} bigint" for name in session_bucket_counts(sessions).columns]
    counts = observation.get
    row = tuple(counts[field.split()[0]] for field in fields)
    return written, sessions.sparkSession.createDataFrame([row], ", ".join(fields))


def session_ratio_stat(bucket_counts: DataFrame, task_id: str) -> DataFrame:
    """One row: the share of sessions in each bucket. Without sessions the total is 1."""
    total = F.greatest(F.col("session_count"), F.lit(1).cast("bigint"))
    buckets = [name for name, _, _ in VISIT_LENGTH_BUCKETS + STEP_LENGTH_BUCKETS]
    ratios = bucket_counts.select(
        total.alias("session_count"),
        *[half_up_ratio(F.col(name), total).alias(f"{name}_ratio") for name in buckets],
    )
    return with_task_id(ratios, task_id)


def session_detail(actions: DataFrame, session_ids: DataFrame, task_id: str) -> DataFrame:
    """The actions of chosen sessions, each once.

    The way to join is left to Spark, which sends a short list of ids to every task once its
    size is known and otherwise splits sessions with many actions.
    """
    chosen = session_ids.select("session_id").distinct()
    return with_task_id(actions.join(chosen, "session_id", "left_semi").select(*DETAIL_COLUMNS), task_id)
