"""Session rules on hand-made rows."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickloom.operators import categories, pages, sampling, sessions
from clickloom.operators.sessions import SessionFilter
from clickloom.sources.actions import (
    ACTION_SCHEMA,
    clean_actions,
    read_actions,
    read_session_log,
    write_actions,
    write_session_log,
)

START = datetime(2024, 1, 5, 5, 3, 7)


def action(session="s1", seconds=0, **values):
    row = dict.fromkeys(ACTION_SCHEMA.fieldNames())
    row.update(session_id=session, user_id=1, page_id=1, city_id=1)
    row["action_time"] = None if seconds is None else START + timedelta(seconds=seconds)
    row["date"] = START.date()
    row.update(values)
    return tuple(row[name] for name in ACTION_SCHEMA.fieldNames())


def frame(spark, rows):
    return spark.createDataFrame(rows, ACTION_SCHEMA)


def users(spark, *rows):
    return spark.createDataFrame(
        list(rows), "user_id bigint, age int, professional string, city string, sex string"
    )


def raw(spark, **values):
    row = dict.fromkeys(ACTION_SCHEMA.fieldNames(), "")
    row.update(session_id="s1", date="2024-01-05")
    row.update(values)
    names = ACTION_SCHEMA.fieldNames()
    schema = ", ".join(f"`{name}` string" for name in names)
    return spark.createDataFrame([tuple(row[name] for name in names)], schema)


def test_cleaning_of_text_rows(spark):
    dirty = raw(
        spark,
        user_id=" 7 ",
        page_id="",
        action_time="2024-01-05 5:03:07",
        search_keyword="%E7%81%AB%E9%94%85",
        click_category_id="-1",
        click_product_id="abc",
        order_category_ids="  ",
        pay_category_ids=None,
        city_id="3",
    )
    row = clean_actions(dirty).collect()[0]
    assert (row.user_id, row.page_id, row.city_id) == (7, None, 3)
    assert row.action_time == START
    assert row.search_keyword == "火锅"
    assert (row.click_category_id, row.click_product_id) == (None, None)
    assert (row.order_category_ids, row.pay_category_ids) == (None, None)


def test_encoded_and_unreadable_times(spark):
    assert clean_actions(raw(spark, action_time="2024-01-05+5%3A03%3A07")).collect()[0].action_time == START
    assert clean_actions(raw(spark, action_time="yesterday")).collect()[0].action_time is None


def test_date_range_includes_both_ends_and_prunes_directories(spark, tmp_path):
    days = [datetime(2024, 1, day).date() for day in (4, 5, 6, 7)]
    rows = [action(session=f"s{day.day}", date=day) for day in days]
    path = str(tmp_path / "actions")
    write_actions(frame(spark, rows), path)
    found = read_actions(spark, path, "2024-01-05", "2024-01-06")
    assert sorted(row.session_id for row in found.collect()) == ["s5", "s6"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_profile(spark):
    rows = [
        action(seconds=0, search_keyword="cab", click_category_id=44),
        action(seconds=9, search_keyword="ab", click_category_id=4),
        action(seconds=4, search_keyword="ab", click_category_id=4),
        action(seconds=None),
    ]
    row = sessions.session_profile(frame(spark, rows)).collect()[0]
    # a keyword inside another one is kept, repeats are not; ids are ordered as numbers
    assert row.search_keywords == ["ab", "cab"]
    assert row.click_category_ids == [4, 44]
    # an action without a readable time counts as a step, not for the length
    assert (row.visit_length, row.step_length) == (9, 4)


def test_session_of_one_action_is_in_no_visit_bucket(spark):
    profile = sessions.session_profile(frame(spark, [action()]))
    counts = sessions.session_bucket_counts(profile).collect()[0].asDict()
    assert counts["session_count"] == 1
    assert counts["step_length_1_3"] == 1
    assert sum(n for name, n in counts.items() if name.startswith("visit")) == 0


@pytest.mark.parametrize(
    ("seconds", "bucket"),
    [
        (1, "1s_3s"),
        (3, "1s_3s"),
        (4, "4s_6s"),
        (6, "4s_6s"),
        (7, "7s_9s"),
        (9, "7s_9s"),
        (10, "10s_30s"),
        (30, "10s_30s"),
        (31, "30s_60s"),
        (60, "30s_60s"),
        (61, "1m_3m"),
        (180, "1m_3m"),
        (181, "3m_10m"),
        (600, "3m_10m"),
        (601, "10m_30m"),
        (1800, "10m_30m"),
        (1801, "30m"),
    ],
)
def test_visit_bucket_edges(spark, seconds, bucket):
    lengths = spark.createDataFrame([(seconds, 1)], "visit_length bigint, step_length bigint")
    counts = sessions.session_bucket_counts(lengths).collect()[0].asDict()
    assert [n for n, c in counts.items() if n.startswith("visit") and c] == [f"visit_length_{bucket}"]


@pytest.mark.parametrize(
    ("steps", "bucket"),
    [(3, "1_3"), (4, "4_6"), (9, "7_9"), (10, "10_30"), (30, "10_30"), (31, "30_60"), (60, "30_60"), (61, "60")],
)
def test_step_bucket_edges(spark, steps, bucket):
    lengths = spark.createDataFrame([(0, steps)], "visit_length bigint, step_length bigint")
    counts = sessions.session_bucket_counts(lengths).collect()[0].asDict()
    assert [n for n, c in counts.items() if n.startswith("step") and c] == [f"step_length_{bucket}"]


def test_ratios_round_half_up_and_no_sessions_give_zero(spark):
    # 1 of 8 is 0.125
    lengths = spark.createDataFrame([(1, 1)] + [(5, 1)] * 7, "visit_length bigint, step_length bigint")
    row = sessions.session_ratio_stat(sessions.session_bucket_counts(lengths), "t").collect()[0]
    assert (row.task_id, row.session_count) == ("t", 8)
    assert row.visit_length_1s_3s_ratio == 0.13
    assert row.visit_length_4s_6s_ratio == 0.88
    none = sessions.session_ratio_stat(sessions.session_bucket_counts(lengths.limit(0)), "t").collect()[0]
    assert none.session_count == 1
    assert none.step_length_1_3_ratio == 0.0


FILTERS = [
    (SessionFilter(), {"a", "b", "c"}),
    (SessionFilter(start_age=20), {"a", "b", "c"}),
    (SessionFilter(start_age=20, end_age=30), {"a", "b"}),
    (SessionFilter(professionals=["cook", "nurse"]), {"b"}),
    (SessionFilter(cities=["Rome"]), {"a", "b"}),
    (SessionFilter(sex="male"), {"a"}),
    (SessionFilter(keywords=["tea", "ink"]), {"a"}),
    (SessionFilter(category_ids=[1, 3]), {"b"}),
    (SessionFilter(category_ids=[1], keywords=["tea"]), set()),
]


@pytest.mark.parametrize(("chosen", "expected"), FILTERS)
def test_filters(spark, chosen, expected):
    rows = [
        action("a", 0, user_id=1, search_keyword="tea"),
        action("a", 5, user_id=1, click_category_id=2),
        action("b", 0, user_id=2, click_category_id=3),
        action("c", 0, user_id=3),
        action("d", 0, user_id=4, search_keyword="tea"),
    ]
    actions = frame(spark, rows)
    people = users(
        spark,
        (1, 20, "smith", "Rome", "male"),
        (2, 30, "cook", "Rome", "female"),
        (3, None, None, None, None),
    )
    full = sessions.session_user_profile(sessions.session_profile(actions), people)
    found = {row.session_id for row in sessions.filter_sessions(full, chosen).collect()}
    # the user of session d is unknown
    assert found == expected
    lengths = sessions.filtered_session_lengths(actions, people, chosen)
    assert {row.session_id for row in lengths.collect()} == expected


def starts(spark, counts):
    rows = []
    for (day, hour), number in counts.items():
        for i in range(number):
            rows.append((f"s-{day}-{hour}-{i}", datetime(2024, 1, day, hour, 0, 1)))
    return spark.createDataFrame(rows, "session_id string, start_time timestamp")


def test_quotas_follow_the_hours(spark):
    given = starts(spark, {(1, 0): 30, (1, 5): 10, (2, 7): 1})
    rows = sampling.session_hour_counts(given, sample_size=40).collect()
    quotas = {(row.date.day, row.hour): (row.session_count, row.day_count, row.quota) for row in rows}
    # 20 sessions a day; the day with one session gives that one, the other day the rest:
    # 29.25 and 9.75 of 39, the last place to the larger remainder
    assert quotas == {(1, 0): (30, 40, 29), (1, 5): (10, 40, 10), (2, 7): (1, 1, 1)}


@pytest.mark.parametrize("size", [0, 1, 2, 5, 17, 40, 99, 1000])
def test_quotas_add_up(spark, size):
    counts = {(1, 0): 30, (1, 5): 10, (2, 7): 1, (3, 1): 7, (3, 2): 7, (3, 3): 7, (4, 0): 2, (5, 0): 21}
    rows = sampling.session_hour_counts(starts(spark, counts), sample_size=size).collect()
    assert sum(row.quota for row in rows) == min(size, sum(counts.values()))
    assert all(0 <= row.quota <= row.session_count for row in rows)
    days = {}
    for row in rows:
        days[row.date.day] = days.get(row.date.day, 0) + row.quota
    held = {d: sum(n for (day, _), n in counts.items() if day == d) for d, _ in counts}
    # no day gives less than another by more than one place, unless it gives all it has
    assert all(days[a] >= days[b] - 1 or days[a] == held[a] for a in days for b in days)


def test_sample_takes_each_quota_and_repeats(spark):
    given = starts(spark, {(1, 0): 30, (1, 5): 10, (2, 7): 1})
    first = sorted(row.session_id for row in sampling.sampled_sessions(given, 40, seed="x").collect())
    again = sampling.sampled_sessions(given.repartition(5), 40, seed="x").collect()
    other = sampling.sampled_sessions(given, 40, seed="y").collect()
    assert first == sorted(row.session_id for row in again)
    assert first != sorted(row.session_id for row in other)
    hours = [session.rsplit("-", 1)[0] for session in first]
    assert {hour: hours.count(hour) for hour in hours} == {"s-1-0": 29, "s-1-5": 10, "s-2-7": 1}


def test_sample_over_more_days_than_sessions_to_draw(spark):
    counts = {(day, hour): 2 for day in range(1, 4) for hour in (1, 2)}
    counts[2, 5] = 1
    drawn = sampling.sampled_sessions(starts(spark, counts), sample_size=2).collect()
    # the day with the most sessions first, then the earliest
    assert sorted(row.session_id.split("-")[1] for row in drawn) == ["1", "2"]
    assert sampling.sampled_sessions(starts(spark, counts), sample_size=2, extra=1).count() > 2


def without_session(spark, n=90, known=10):
    """Actions of which nine in ten have no session id."""
    return spark.range(n + known).select(
        F.when(F.col("id") >= n, F.concat(F.lit("s"), F.col("id") % 2)).alias("session_id"),
        (F.col("id") % 7).alias("user_id"),
        F.timestamp_seconds(F.col("id") + 1704067200).alias("action_time"),
        F.lit("k").alias("search_keyword"),
        (F.col("id") % 5).alias("click_category_id"),
        F.lit(None).cast("string").alias("order_category_ids"),
        F.lit(None).cast("string").alias("pay_category_ids"),
        (F.col("id") % 2 + 1).alias("page_id"),
    )


def test_actions_without_a_session_form_none(spark):
    actions = without_session(spark)
    users = spark.range(7).withColumnRenamed("id", "user_id").withColumn("age", F.lit(30))
    assert {row.session_id for row in sessions.session_profile(actions).collect()} == {"s0", "s1"}
    assert sum(row.step_length for row in sessions.session_profile(actions).collect()) == 10
    assert sessions.filtered_session_lengths(actions, users, sessions.SessionFilter()).count() == 2
    assert sampling.session_starts(actions, users).count() == 2
    assert {row.session_id for row in categories.category_session_counts(actions).collect()} == {"s0", "s1"}
    assert sessions.session_items(actions).where("session_id is null").count() == 0
    # they still count for categories and page views
    assert sum(row.click_count for row in categories.category_counts(actions).collect()) == 100
    rows = pages.page_convert_rate(actions, [1, 2]).collect()
    assert (rows[0].pair_count, rows[0].base_count) == (0, 50)


def test_actions_without_a_session_do_not_meet_in_one_task(spark):
    actions = without_session(spark, 45_000, 5_000)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        assert pages.page_convert_rate(actions, [1, 2]).collect()[0].pair_count == 0
        moves = pages._flow_steps(actions, [1, 2], None)
        plan = moves._jdf.queryExecution().executedPlan().toString()
        # ranges go by session, time and id, so the id spreads actions without the others
        assert "rangepartitioning(session" in plan and plan.count("hashpartitioning(session") == 0
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_every_hour_keeps_only_a_few_rows_before_the_shuffle(spark):
    plan = sampling.sampled_sessions(starts(spark, {(1, 0): 3}))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_lists_are_gathered_for_passing_sessions_only(spark):
    """The filters stand below the aggregate that gathers lists, and give the same rows."""
    actions = without_session(spark, 10, 200)
    users = spark.range(7).select(F.col("id").alias("user_id"), F.lit(30).alias("age"), *[F.lit("x").alias(c) for c in ("professional", "sex", "city")])
    chosen = sessions.SessionFilter(keywords=("k",), category_ids=(1, 3))
    found = sessions.filtered_session_profile(actions, users, chosen)
    direct = sessions.filter_sessions(sessions.session_user_profile(sessions.session_profile(actions), users), chosen)
    assert sorted(map(str, found.collect())) == sorted(map(str, direct.collect()))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("collect_set") < plan.index("LeftSemi")
    passing = sessions.filtered_session_lengths(actions, users, chosen)
    assert "collect_set" not in passing._jdf.queryExecution().optimizedPlan().toString()


def test_detail_has_each_action_once(spark):
    actions = frame(spark, [action("a", 0), action("a", 0), action("b", 0)])
    ids = spark.createDataFrame([("a",), ("a",)], "session_id string")
    rows = sessions.session_detail(actions, ids, "t").collect()
    assert [(row.task_id, row.session_id) for row in rows] == [("t", "a"), ("t", "a")]


def test_one_session_with_most_rows(spark):
    """A session of any share of the rows gives the same profile as counted by hand."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "bot").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("session_id"),
        F.lit(1).cast("bigint").alias("user_id"),
        F.timestamp_seconds(F.col("id") + 1704067200).alias("action_time"),
        F.concat(F.lit("k"), F.col("id") % 7).alias("search_keyword"),
        (F.col("id") % 5).alias("click_category_id"),
    )
    bot = sessions.session_profile(rows).where(F.col("session_id") == "bot").collect()[0]
    assert (bot.step_length, bot.visit_length) == (10000, 29997)
    assert bot.click_category_ids == [0, 1, 2, 3, 4]
    assert bot.search_keywords == [f"k{i}" for i in range(7)]


def test_a_log_bucketed_by_session_is_not_shuffled(spark, tmp_path):
    rows = [action(f"s{i % 7}", 10 * i, page_id=i) for i in range(60)] + [action(None, 5, page_id=1)]
    log = frame(spark, rows)
    write_session_log(log, "test_session_log", str(tmp_path / "log"), buckets=8)
    stored = read_session_log(spark, "test_session_log")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chosen = spark.createDataFrame([("s1",), ("s3",)], "session_id string")
        for of in (
            sessions.session_profile,
            # the lengths, before their users are looked up by another key
            lambda log: log.groupBy("session_id").agg(F.max("action_time").alias("end_time")),
            lambda log: sessions.session_detail(log, chosen, "t"),
        ):
            found = of(stored)
            assert sorted(map(str, found.collect())) == sorted(map(str, of(log.where("session_id IS NOT NULL")).collect()))
            plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            above = []  # indents and names of what stands over a line of the tree
            scans = 0
            for line in plan.splitlines():
                indent = re.match(r"[\s:+\-]*", line).end()
                above = [(depth, name) for depth, name in above if depth < indent] + [(indent, line)]
                if "FileScan" in line:
                    scans += 1
                    assert not any("Exchange" in name for _, name in above), plan
            assert scans == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE test_session_log")
