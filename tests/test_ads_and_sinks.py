"""Ad rules, result tables and streams on hand-made rows."""

import glob
import os
import random
import shutil
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from clickloom.functions import text_result, with_task_id
from clickloom.operators import ads
from clickloom.plans.session import work_dir
from clickloom.sinks import BatchTable, append_parquet
from clickloom.sinks.batch_table import ADD, IGNORE, OVERWRITE, REPLACE_SLICE
from clickloom.sources.ad_log import (
    kafka_options,
    marked_ad_log,
    parse_ad_log,
    read_ad_log,
    rejected_ad_log,
    stream_ad_log,
)
from clickloom.streaming import ad_jobs, tables

DAY = datetime(2024, 1, 5)
CLICK_SCHEMA = "ts timestamp, province string, city string, userid bigint, adid bigint"


def click(seconds=0, user=1, ad=1, province="p", city="c"):
    return (DAY + timedelta(seconds=seconds), province, city, user, ad)


def clicks(spark, rows):
    return spark.createDataFrame(rows, CLICK_SCHEMA)


def line(seconds=0, user=1, ad=1, province="3", city="3"):
    millis = int((DAY - datetime(1970, 1, 1)).total_seconds() + seconds) * 1000
    return f"{millis} {province} {city} {user} {ad}"


def sorted_rows(frame):
    return sorted(tuple(row) for row in frame.collect())


# -- log lines ---------------------------------------------------------------------------


def test_parsing_and_rejects(spark, tmp_path):
    bad = ["", "1704412800000 3 3", "soon 3 3 7 5", "1704412800000 3 3 seven 5"]
    (tmp_path / "log.txt").write_text("\n".join([line(5, user=7, ad=5), *bad]) + "\n")
    lines = read_ad_log(spark, str(tmp_path))
    assert sorted_rows(parse_ad_log(lines)) == [(DAY + timedelta(seconds=5), "3", "3", 7, 5)]
    assert sorted(row.value for row in rejected_ad_log(lines).collect()) == sorted(bad)


# -- batch jobs --------------------------------------------------------------------------


def test_blacklist_counts_per_day_and_ad(spark):
    rows = [click(i, user=1, ad=1) for i in range(10)]
    rows += [click(i, user=2, ad=i % 2) for i in range(18)]
    rows += [click(i * 86400, user=3) for i in range(12)]
    daily = ads.ad_user_daily_counts(clicks(spark, rows))
    assert sorted_rows(ads.ad_blacklist(daily)) == [(1,)]
    assert sorted_rows(ads.ad_blacklist(daily, 9)) == [(1,), (2,)]
    kept = ads.ad_filtered_log(clicks(spark, rows), ads.ad_blacklist(daily))
    assert kept.count() == 30
    assert kept.columns == ["ts", "province", "city", "userid", "adid"]


def test_top_ads_are_ranked_within_the_day(spark):
    rows = [click(i, ad=ad, city=f"c{i % 2}") for ad in range(1, 6) for i in range(ad)]
    rows += [click(86400, ad=9)]
    top = ads.ad_province_top3(ads.ad_stat(clicks(spark, rows)))
    assert sorted_rows(top) == [
        (date(2024, 1, 5), "p", 3, 3),
        (date(2024, 1, 5), "p", 4, 4),
        (date(2024, 1, 5), "p", 5, 5),
        (date(2024, 1, 6), "p", 9, 1),
    ]


def test_trend_and_its_horizon(spark):
    rows = [click(5), click(59), click(60), click(7200), click(7300, ad=2)]
    assert sorted_rows(ads.ad_click_trend(clicks(spark, rows))) == [
        (date(2024, 1, 5), "00", "00", 1, 2),
        (date(2024, 1, 5), "00", "01", 1, 1),
        (date(2024, 1, 5), "02", "00", 1, 1),
        (date(2024, 1, 5), "02", "01", 2, 1),
    ]
    assert ads.ad_click_trend(clicks(spark, rows), "1 hour").count() == 2


def test_the_horizon_is_of_whole_minutes_in_both_forms(spark, tmp_path):
    rows = clicks(spark, [click(30), click(59), click(3600 + 45), click(60)])
    trend = tables.trend_table(spark, str(tmp_path / "trend"))
    trend.write(ad_jobs.minute_counts(rows), 0)
    assert sorted_rows(ad_jobs.trend_result(trend, "1 hour")) == sorted_rows(ads.ad_click_trend(rows, "1 hour"))
    assert sorted_rows(ads.ad_click_trend(rows, "1 hour")) == [
        (date(2024, 1, 5), "00", "01", 1, 1),
        (date(2024, 1, 5), "01", "00", 1, 1),
    ]


def test_series_is_dense(spark):
    rows = [click(0), click(1), click(150), click(3600, ad=2)]
    series = ads.ad_trend_series(ads.ad_click_trend(clicks(spark, rows)), "2024-01-05", 0).collect()
    assert {row.adid for row in series} == {1}
    assert {row.minute: row.click_count for row in series} == {m: {0: 2, 2: 1}.get(m, 0) for m in range(60)}
    assert {(row.max_count, row.min_count, row.avg_count) for row in series} == {(2, 0, 3 / 60)}


# -- result tables -----------------------------------------------------------------------

KEYED = tables.USER_COUNT_SCHEMA


def keyed(spark, *rows):
    return spark.createDataFrame([(DAY.date(), user, 1, count) for user, count in rows], KEYED)


def table(spark, tmp_path, rule, keys=("date", "userid", "adid")):
    return BatchTable(spark, str(tmp_path / "table"), KEYED, list(keys), rule)


def content(stored):
    return {row.userid: row.click_count for row in stored.read().collect()}


RULES = [
    (ADD, {1: 11, 2: 5, 3: 7}),
    (OVERWRITE, {1: 1, 2: 5, 3: 7}),
    (IGNORE, {1: 10, 2: 5, 3: 7}),
]


@pytest.mark.parametrize(("rule", "expected"), RULES)
def test_rules_replay_and_compaction(spark, tmp_path, rule, expected):
    stored = table(spark, tmp_path, rule)
    assert content(stored) == {}
    stored.write(keyed(spark, (1, 10), (2, 5)), 0)
    stored.write(keyed(spark, (1, 1), (3, 7)), 1)
    assert content(stored) == expected
    # a batch that comes again changes nothing
    stored.write(keyed(spark, (1, 1), (3, 7)), 1)
    assert content(stored) == expected
    assert {row.userid for row in stored.read_before(1).collect()} == {1, 2}
    stored.compact()
    assert content(stored) == expected
    # nor does it after the batches are folded
    stored.write(keyed(spark, (1, 1), (3, 7)), 1)
    stored.compact()
    assert content(stored) == expected
    stored.write(keyed(spark, (2, 1)), 2)
    stored.compact()
    assert content(stored)[2] == {ADD: 6, OVERWRITE: 1, IGNORE: 5}[rule]
    # what an older fold covers is gone; what it does not is still there
    assert [os.path.basename(p) for p in glob.glob(f"{stored.path}/batches/batch_id=*")] == ["batch_id=2"]


def test_add_sums_repeats_within_a_batch(spark, tmp_path):
    stored = table(spark, tmp_path, ADD)
    stored.write(keyed(spark, (1, 2), (1, 3)), 0)
    assert content(stored) == {1: 5}


def test_replaced_slices(spark, tmp_path):
    stored = table(spark, tmp_path, REPLACE_SLICE, keys=("date", "adid"))

    def rows(*values):
        return spark.createDataFrame([(DAY.date(), user, ad, 1) for ad, user in values], KEYED)

    stored.write(rows((1, 10), (1, 11), (2, 20)), 0)
    stored.write(rows((1, 12)), 1)
    stored.write(rows((1, 12)), 1)
    assert sorted((row.adid, row.userid) for row in stored.read().collect()) == [(1, 12), (2, 20)]
    stored.compact()
    stored.write(rows((2, 21), (3, 30)), 2)
    assert sorted((row.adid, row.userid) for row in stored.read().collect()) == [(1, 12), (2, 21), (3, 30)]


def test_half_written_batches_and_folds_do_no_harm(spark, tmp_path):
    stat = tables.stat_table(spark, str(tmp_path / "stat"))
    day = lambda n: ads.ad_stat(clicks(spark, [click(86400 * n)]))
    for batch_id, n in enumerate((0, 1, 1)):
        stat.write(day(n), batch_id)
    want = sorted_rows(stat.read())
    # as if the job had died while storing a batch: what is not committed is hidden
    staged = tmp_path / "stat" / "batches" / ".spark-staging-x" / "batch_id=3"
    staged.mkdir(parents=True)
    (staged / "part-0.parquet").write_bytes(b"half")
    assert sorted_rows(stat.read()) == want
    # as if it had died while folding: one day is folded, the other is not
    stat.compact()
    shutil.rmtree(glob.glob(f"{stat.path}/folded/date=2024-01-06")[0])
    assert sorted_rows(stat.read()) == want


def test_tables_do_not_hang_on_success_marks(spark, tmp_path):
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark._jsc.hadoopConfiguration()
    conf.set(key, "false")
    try:
        stored = table(spark, tmp_path, ADD)
        stored.write(keyed(spark, (1, 2)), 0)
        stored.compact()
        stored.write(keyed(spark, (1, 3)), 1)
        assert not glob.glob(f"{stored.path}/*/_SUCCESS")
        assert content(stored) == {1: 5}
    finally:
        conf.unset(key)


def test_slices_with_null_keys_stay(spark, tmp_path):
    top = tables.top_table(spark, str(tmp_path / "top"))
    rows = lambda *provinces: spark.createDataFrame([(DAY.date(), p, 1, n) for p, n in provinces], tables.TOP_SCHEMA)
    top.write(rows((None, 1), ("a", 2)), 0)
    top.write(rows((None, 3)), 1)
    assert {(row.province, row.click_count) for row in top.read().collect()} == {(None, 3), ("a", 2)}
    stat = tables.stat_table(spark, str(tmp_path / "stat"))
    stat.write(ads.ad_stat(clicks(spark, [click(1, province=None), click(2, province="x")])), 0)
    ranked = tables.top_table(spark, str(tmp_path / "ranked"))
    ad_jobs.refresh_top3(stat, ranked, 0)
    assert {row.province for row in ranked.read().collect()} == {None, "x"}


def test_many_batches_stay_few_folders_and_old_days_stay_untouched(spark, tmp_path):
    stat = tables.stat_table(spark, str(tmp_path / "stat"))
    day = lambda n: ads.ad_stat(clicks(spark, [click(86400 * n)])).persist()
    days, first = [day(0), day(1), day(2)], None
    for batch_id in range(60):
        if batch_id and batch_id % 10 == 0:
            stat.compact(before=batch_id)
        if batch_id == 10:
            first = glob.glob(f"{stat.path}/folded/date=2024-01-05/part-*")
        stat.write(days[0 if batch_id < 10 else 1 + batch_id // 40], batch_id)
    assert len(glob.glob(f"{stat.path}/batches/batch_id=*")) <= 21
    stat.compact()
    # the first day was folded once, with its own batches, and its files are still the same
    assert first and glob.glob(f"{stat.path}/folded/date=2024-01-05/part-*") == first
    assert len(glob.glob(f"{stat.path}/folded/date=*")) == 3
    assert {str(row.date): row.click_count for row in stat.read().collect()} == {
        "2024-01-05": 10,
        "2024-01-06": 30,
        "2024-01-07": 20,
    }
    for each in days:
        each.unpersist()


def test_a_batch_is_written_in_as_many_files_as_its_size_asks_for(spark, tmp_path):
    stored = table(spark, tmp_path, ADD)
    stored.write(keyed(spark, (1, 2)), 0)
    assert len(glob.glob(f"{stored.path}/batches/batch_id=0/part-*")) == 1


def test_a_table_with_another_rule_is_refused(spark, tmp_path):
    stat = tables.stat_table(spark, str(tmp_path / "stat"), OVERWRITE)
    with pytest.raises(ValueError, match="add"):
        ad_jobs.start_ad_stat(clicks(spark, []), stat, str(tmp_path / "c"))


def test_days_need_the_zone_they_are_counted_in(spark, tmp_path):
    stat = tables.stat_table(spark, str(tmp_path / "stat"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            ad_jobs.start_ad_stat(streamed(spark, log_files(tmp_path, BATCHES)), stat, str(tmp_path / "c"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_batch_reads_only_the_days_it_touches(spark, tmp_path):
    stat = tables.stat_table(spark, str(tmp_path / "stat"), ADD)
    days = [click(86400 * i) for i in range(5)]
    stat.write(ads.ad_stat(clicks(spark, days)), 0)
    stat.compact()
    stat.write(ads.ad_stat(clicks(spark, days[2:3])), 1)
    touched = stat.read_batch(1).select("date", "province").distinct()
    slices = stat.read().join(touched, ["date", "province"], "left_semi")
    assert [row.click_count for row in slices.collect()] == [2]
    assert "dynamicpruning" in slices._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_a_busy_user_is_split_when_the_list_is_too_large_to_send(spark, no_broadcast):
    log = spark.range(0, 60000, 1, 8).selectExpr(
        "timestamp_seconds(id) AS ts",
        "'p' AS province",
        "'c' AS city",
        "IF(id % 3 = 0, 1, id) AS userid",
        "id % 10 AS adid",
    )
    listed = spark.range(5, 30000).selectExpr("id AS userid")
    kept = ads.ad_filtered_log(log, listed)
    rows = kept.collect()
    assert sum(row.userid == 1 for row in rows) == 20001
    assert len(rows) == 20000 + sum(i % 3 != 0 and not 5 <= i < 30000 for i in range(60000))
    assert "SortMergeJoin(skew=true)" in kept._jdf.queryExecution().executedPlan().toString()


def test_append_by_task(spark, tmp_path):
    path = str(tmp_path / "results")
    for task in ("a", "b"):
        append_parquet(with_task_id(keyed(spark, (1, 2)), task), path)
    assert sorted((row.task_id, row.userid) for row in spark.read.parquet(path).collect()) == [("a", 1), ("b", 1)]


def test_unknown_rule(spark, tmp_path):
    with pytest.raises(ValueError):
        table(spark, tmp_path, "merge")


# -- streams over several files ----------------------------------------------------------


def log_files(tmp_path, batches):
    path = tmp_path / "log"
    path.mkdir()
    for i, batch in enumerate(batches):
        file = path / f"{i:03d}.txt"
        file.write_text("\n".join(batch) + "\n")
        os.utime(file, (1700000000 + i * 60, 1700000000 + i * 60))
    return str(path)


def streamed(spark, path):
    return parse_ad_log(stream_ad_log(spark, path, max_files_per_trigger=1))


BATCHES = [
    [line(10, user=1, ad=1), line(20, user=2, ad=2), line(70, user=1, ad=1)],
    ["broken line", line(15, user=3, ad=1), line(100, user=1, ad=3)],
    [line(86400 + 5, user=1, ad=1), line(130, user=2, ad=2, province="4", city="4")],
]


def test_streams_equal_the_batch_jobs(spark, tmp_path):
    path = log_files(tmp_path, BATCHES)
    whole = parse_ad_log(read_ad_log(spark, path))
    base = str(tmp_path)

    stat, top = tables.stat_table(spark, f"{base}/stat"), tables.top_table(spark, f"{base}/top")
    query = ad_jobs.start_province_top3(streamed(spark, path), stat, top, f"{base}/c1", until_done=True)
    query.awaitTermination()
    assert query.recentProgress[-1]["batchId"] >= 2
    assert sorted_rows(stat.read()) == sorted_rows(ads.ad_stat(whole))
    assert sorted_rows(top.read()) == sorted_rows(ads.ad_province_top3(ads.ad_stat(whole)))

    trend = tables.trend_table(spark, f"{base}/trend")
    ad_jobs.start_click_trend(streamed(spark, path), trend, f"{base}/c2", until_done=True).awaitTermination()
    assert sorted_rows(ad_jobs.trend_result(trend)) == sorted_rows(ads.ad_click_trend(whole))
    assert sorted_rows(ad_jobs.trend_result(trend, "1 hour")) == sorted_rows(ads.ad_click_trend(whole, "1 hour"))

    counts, listed = tables.user_count_table(spark, f"{base}/counts"), tables.blacklist_table(spark, f"{base}/black")
    ad_jobs.start_blacklist(
        streamed(spark, path), counts, listed, f"{base}/c3", threshold=2, until_done=True
    ).awaitTermination()
    daily = ads.ad_user_daily_counts(whole)
    assert sorted_rows(counts.read()) == sorted_rows(daily)
    assert sorted_rows(listed.read()) == sorted_rows(ads.ad_blacklist(daily, 2))


def test_running_counts_equal_added_ones(spark, tmp_path):
    path = log_files(tmp_path, BATCHES)
    whole = parse_ad_log(read_ad_log(spark, path))
    base = str(tmp_path)
    stat, top = tables.stat_table(spark, f"{base}/stat", OVERWRITE), tables.top_table(spark, f"{base}/top")
    ad_jobs.start_province_top3(
        streamed(spark, path), stat, top, f"{base}/c1", watermark="2 days", until_done=True
    ).awaitTermination()
    assert sorted_rows(stat.read()) == sorted_rows(ads.ad_stat(whole))
    assert sorted_rows(top.read()) == sorted_rows(ads.ad_province_top3(ads.ad_stat(whole)))


def test_no_click_is_too_late_by_default(spark, tmp_path):
    path = log_files(tmp_path, [[line(86400 * 20)], [line(0)], [line(86400 * 21), line(5)]])
    trend = tables.trend_table(spark, str(tmp_path / "trend"))
    ad_jobs.start_click_trend(streamed(spark, path), trend, str(tmp_path / "c"), until_done=True, compact_every=2).awaitTermination()
    whole = parse_ad_log(read_ad_log(spark, path))
    assert sorted_rows(ad_jobs.trend_result(trend)) == sorted_rows(ads.ad_click_trend(whole))


def test_no_number_ends_the_stream(spark, tmp_path):
    odd = ["9223372036854775807 3 3 7 5", "-9223372036854775808 3 3 7 5", "9" * 30 + " 3 3 7 5", "253402300800000 3 3 7 5"]
    path = log_files(tmp_path, [[line(1)], odd, [line(2), "1 1 1 " + "9" * 30 + " 1"]])
    lines = read_ad_log(spark, path)
    assert parse_ad_log(lines).count() == 2
    assert {row.value for row in rejected_ad_log(lines).collect()} == {*odd, "1 1 1 " + "9" * 30 + " 1"}
    stat = tables.stat_table(spark, str(tmp_path / "stat"))
    ad_jobs.start_ad_stat(streamed(spark, path), stat, str(tmp_path / "c"), until_done=True).awaitTermination()
    assert sum(row.click_count for row in stat.read().collect()) == 2


def test_late_clicks_count_until_the_watermark(spark, tmp_path):
    batches = [
        [line(3600)],
        [line(3000), line(3700)],
        # the watermark stands at 30 minutes: the first is too late, the second is late but counts
        [line(600), line(2400)],
    ]
    trend = tables.trend_table(spark, str(tmp_path / "trend"), OVERWRITE)
    ad_jobs.start_click_trend(
        streamed(spark, log_files(tmp_path, batches)),
        trend,
        str(tmp_path / "checkpoint"),
        watermark="30 minutes",
        until_done=True,
    ).awaitTermination()
    assert [row.minute for row in ad_jobs.trend_result(trend).orderBy("hour", "minute").collect()] == ["40", "50", "00", "01"]


def test_all_jobs_feed_the_blacklist_back(spark, tmp_path):
    batches = [
        # user 1 reaches the threshold of 2 here, and is still counted in this batch
        [line(1, user=1), line(2, user=1), line(3, user=2)],
        # from here on user 1 is dropped from the counts, but not from the trend
        [line(4, user=1), line(5, user=2, ad=2)],
        [line(6, user=1), line(70, user=3)],
    ]
    path = log_files(tmp_path, batches)
    base = str(tmp_path)
    stored = dict(
        counts=tables.user_count_table(spark, f"{base}/counts"),
        blacklist=tables.blacklist_table(spark, f"{base}/black"),
        stat=tables.stat_table(spark, f"{base}/stat", ADD),
        top=tables.top_table(spark, f"{base}/top"),
        trend=tables.trend_table(spark, f"{base}/trend", ADD),
    )

    def run(checkpoint):
        ad_jobs.start_all_ad_jobs(
            streamed(spark, path), **stored, checkpoint=checkpoint, threshold=2, until_done=True, compact_every=2
        ).awaitTermination()
        return {name: sorted_rows(each.read()) for name, each in stored.items()}

    first = run(f"{base}/checkpoint")
    day = date(2024, 1, 5)
    assert first["blacklist"] == [(1,)]
    assert first["stat"] == [(day, "3", "3", 1, 4), (day, "3", "3", 2, 1)]
    assert first["top"] == [(day, "3", 1, 4), (day, "3", 2, 1)]
    assert first["trend"] == [(day, DAY, 1, 5), (day, DAY, 2, 1), (day, DAY + timedelta(minutes=1), 1, 1)]
    assert first["counts"] == [(day, 1, 1, 4), (day, 2, 1, 1), (day, 2, 2, 1), (day, 3, 1, 1)]
    # all batches replayed from the start, as if no progress had been recorded
    assert run(f"{base}/other-checkpoint") == first


def test_filtered_log_reads_the_list_for_each_batch(spark, tmp_path):
    listed = tables.blacklist_table(spark, str(tmp_path / "black"))
    path = log_files(tmp_path, BATCHES[:1])
    log, checkpoint = tables.log_table(spark, str(tmp_path / "kept")), str(tmp_path / "checkpoint")

    def run(checkpoint=checkpoint):
        ad_jobs.start_filtered_log(streamed(spark, path), listed, log, checkpoint, until_done=True).awaitTermination()
        return sorted(row.userid for row in log.read().collect())

    assert run() == [1, 1, 2]
    listed.write(spark.createDataFrame([(1,)], "userid bigint"), 0)
    with open(f"{path}/later.txt", "w") as file:
        file.write("\n".join([line(500, user=1), line(501, user=2)]) + "\n")
    assert run() == [1, 1, 2, 2]
    # a replay holds each batch against the list as it was then
    listed.write(spark.createDataFrame([(2,)], "userid bigint"), 1)
    assert run(str(tmp_path / "other")) == [1, 1, 2, 2]


def test_rejects_of_every_starter(spark, tmp_path):
    path = log_files(tmp_path, [*BATCHES, ["also broken", "1 2 3"]])
    lines = lambda: marked_ad_log(stream_ad_log(spark, path, max_files_per_trigger=1))
    whole, base = parse_ad_log(read_ad_log(spark, path)), str(tmp_path / "out")
    want = sorted(row.value for row in rejected_ad_log(read_ad_log(spark, path)).collect())
    assert len(want) == 3
    make = {name: getattr(tables, f"{name}_table") for name in ("stat", "top", "trend", "user_count", "blacklist", "pane", "log")}
    starters = {
        "stat": lambda of, **kw: ad_jobs.start_ad_stat(lines(), of("stat"), **kw),
        "top": lambda of, **kw: ad_jobs.start_province_top3(lines(), of("stat"), of("top"), **kw),
        "trend": lambda of, **kw: ad_jobs.start_click_trend(lines(), of("trend"), **kw),
        "user_count": lambda of, **kw: ad_jobs.start_user_daily_counts(lines(), of("user_count"), **kw),
        "blacklist": lambda of, **kw: ad_jobs.start_blacklist(lines(), of("user_count"), of("blacklist"), threshold=2, **kw),
        "pane": lambda of, **kw: ad_jobs.start_sliding_trend(lines(), of("pane"), **kw),
        "log": lambda of, **kw: ad_jobs.start_filtered_log(lines(), of("blacklist"), of("log"), **kw),
        "all": lambda of, **kw: ad_jobs.start_all_ad_jobs(
            lines(), of("user_count"), of("blacklist"), of("stat"), of("top"), of("trend"), threshold=2, **kw
        ),
        "rejects": lambda of, **kw: ad_jobs.start_rejects(lines(), **kw),
    }
    for name, start in starters.items():
        rejects = tables.reject_table(spark, f"{base}/{name}/rejects")
        of = lambda kind: make[kind](spark, f"{base}/{name}/{kind}")  # noqa: B023, E731
        for checkpoint in ("c", "replayed"):  # the second time all batches come again
            query = start(of, checkpoint=f"{base}/{name}/{checkpoint}", rejects=rejects, until_done=True)
            query.awaitTermination()
            assert sorted(row.value for row in rejects.read().collect()) == want
            seen = [p["observedMetrics"]["ad_log"] for p in query.recentProgress if p["observedMetrics"]]
            assert (sum(m["lines"] for m in seen), sum(m["rejected"] for m in seen)) == (whole.count() + 3, 3)
        if name == "stat":
            assert sorted_rows(of("stat").read()) == sorted_rows(ads.ad_stat(whole))
    with pytest.raises(ValueError, match="start_rejects"):
        running = tables.stat_table(spark, f"{base}/running", OVERWRITE)
        ad_jobs.start_ad_stat(lines(), running, f"{base}/r", watermark="1 day", rejects=rejects)


def test_marked_lines_count_like_parsed_ones(spark, tmp_path):
    path = log_files(tmp_path, BATCHES)
    lines = read_ad_log(spark, path)
    marked = marked_ad_log(lines)
    assert sorted_rows(marked.where("rejected IS NULL").drop("rejected")) == sorted_rows(parse_ad_log(lines))
    assert [row.rejected for row in marked.where("rejected IS NOT NULL").collect()] == ["broken line"]
    stat = tables.stat_table(spark, str(tmp_path / "stat"), OVERWRITE)
    ad_jobs.start_ad_stat(
        marked_ad_log(stream_ad_log(spark, path)), stat, str(tmp_path / "c"), watermark="2 days", until_done=True
    ).awaitTermination()
    assert sorted_rows(stat.read()) == sorted_rows(ads.ad_stat(parse_ad_log(lines)))


def test_sliding_windows(spark, tmp_path):
    """Panes against Spark's own windows, over block borders, before 1970, for a busy ad."""
    dice = random.Random(3)
    seconds = [dice.choice([dice.randint(0, 400), 3590 + dice.randint(0, 40), dice.randint(0, 86400 * 3)]) for _ in range(400)]
    seconds += [-(10**9) * 2 + n for n in (0, 3, 59, 61)]
    path = log_files(tmp_path, [[line(n, ad=1 + n % 3 * (n % 2)) for n in seconds[i::3]] for i in range(3)])
    log = parse_ad_log(read_ad_log(spark, path))
    plain = log.groupBy(F.window("ts", "60 seconds", "5 seconds").alias("w"), "adid").agg(F.count(F.lit(1)).alias("n"))
    want = sorted_rows(plain.select("w.end", "adid", "n"))
    found = ads.ad_sliding_trend(log)
    assert sorted_rows(found) == want and len(want) > 1000
    assert "Expand" not in found._jdf.queryExecution().toString()
    panes = tables.pane_table(spark, str(tmp_path / "panes"))
    ad_jobs.start_sliding_trend(streamed(spark, path), panes, str(tmp_path / "c"), until_done=True).awaitTermination()
    assert sorted_rows(ad_jobs.sliding_result(panes)) == want
    last = max(row[0] for row in want) - timedelta(seconds=55)
    assert sorted_rows(ad_jobs.sliding_result(panes, latest=True)) == [row for row in want if row[0] == last]
    with pytest.raises(ValueError):
        ads.sliding_counts(ads.pane_counts(log), 60, 7)


def test_a_pile_of_files_becomes_several_batches(spark, tmp_path):
    path = log_files(tmp_path, [[line(n)] for n in range(10)])
    stat = tables.stat_table(spark, str(tmp_path / "stat"))
    lines = stream_ad_log(spark, path, max_files_per_trigger=3)
    query = ad_jobs.start_ad_stat(parse_ad_log(lines), stat, str(tmp_path / "c"), until_done=True)
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [3, 3, 3, 1]
    by_size = stream_ad_log(spark, path, max_bytes_per_trigger=40)
    query = ad_jobs.start_ad_stat(parse_ad_log(by_size), tables.stat_table(spark, str(tmp_path / "s2")), str(tmp_path / "c2"), until_done=True)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 10 and query.recentProgress[-1]["batchId"] >= 3
    with pytest.raises(ValueError):
        stream_ad_log(spark, path, 1, 1000)


def test_kafka_options():
    options = kafka_options("a:1,b:2", "clicks", max_offsets_per_trigger=5000, min_partitions=64)
    assert options == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "clicks",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "5000",
        "minPartitions": "64",
    }
    assert "maxOffsetsPerTrigger" in kafka_options("a", "t") and "minPartitions" not in kafka_options("a", "t")
    with pytest.raises(ValueError):
        kafka_options("a", "t", max_offsets_per_trigger=0)


@pytest.mark.parametrize("dies_at", ["stat", "top", "trend", "counts", "blacklist", "end"])
def test_a_query_that_dies_in_a_batch_goes_on(spark, tmp_path, monkeypatch, dies_at):
    """The second batch dies once, after one of its tables is written and before it is
    recorded; the query is started again on its checkpoint."""
    path = log_files(tmp_path, [[line(1, user=1), line(2, user=1)], [line(4, user=1), line(5, user=2, ad=2)], [line(6, user=1), line(70, user=3)]])
    make = {"counts": "user_count", "blacklist": "blacklist", "stat": "stat", "top": "top", "trend": "trend"}

    def run(base, faults):
        stored = {name: getattr(tables, f"{kind}_table")(spark, f"{base}/{name}") for name, kind in make.items()}
        write = BatchTable.write

        def failing(self, batch, batch_id):
            write(self, batch, batch_id)
            if faults and batch_id == 1 and self is stored[faults[0]]:
                faults.pop()
                raise RuntimeError("lost between a table and the checkpoint")

        monkeypatch.setattr(BatchTable, "write", failing)
        for _ in range(2):
            query = ad_jobs.start_all_ad_jobs(
                streamed(spark, path), **stored, checkpoint=f"{base}/c", threshold=2, until_done=True, compact_every=2
            )
            try:
                query.awaitTermination()
                break
            except StreamingQueryException:
                continue
        monkeypatch.setattr(BatchTable, "write", write)
        return {name: sorted_rows(each.read()) for name, each in stored.items()}

    whole = run(str(tmp_path / "whole"), [])
    faults = ["blacklist" if dies_at == "end" else dies_at]
    assert run(str(tmp_path / "broken"), faults) == whole and not faults


def test_running_state_survives_a_restart_and_expires(spark, tmp_path):
    path, base = log_files(tmp_path, [[line(86400 * d + n) for n in range(5)] for d in range(3)]), str(tmp_path)
    stat = tables.stat_table(spark, f"{base}/stat", OVERWRITE)

    def run():
        query = ad_jobs.start_ad_stat(streamed(spark, path), stat, f"{base}/c", watermark="1 hour", until_done=True)
        query.awaitTermination()
        return query

    first = run()
    assert any(key.startswith("rocksdb") for key in first.recentProgress[-1]["stateOperators"][0]["customMetrics"])
    with open(f"{path}/later.txt", "w") as file:
        file.write("\n".join([line(86400 * 2 + 60), line(86400 * 2 + 61), line(3)]) + "\n")
    second = run()
    counts = {str(row.date): row.click_count for row in stat.read().collect()}
    # the third day goes on from the stored state; the first is past the watermark
    assert counts == {"2024-01-05": 5, "2024-01-06": 5, "2024-01-07": 7}
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in second.recentProgress if p["stateOperators"]) == 1
    # only days the watermark has not passed are kept: it stands an hour before the third
    assert second.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 2


# -- working folder ----------------------------------------------------------------------


def test_work_dir_is_in_the_shared_folder(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_dir(spark, "job"), work_dir(spark, "job")
    assert first != second
    if before:
        assert first.startswith(f"{before.rstrip('/')}/clickloom-{spark.sparkContext.applicationId}/job-")


def test_text_result(spark):
    row = text_result(
        spark.sql("SELECT DATE'2024-01-05' d, TIMESTAMP'2024-01-05 05:03:07.25' t, array(2, 10) a, 1.5D x")
    ).collect()[0]
    assert tuple(row) == ("2024-01-05", "2024-01-05 05:03:07", "2,10", 1.5)
