"""Whole jobs over the smallest test tables."""

from clickloom.operators import sampling, sessions
from clickloom.plans import jobs
from clickloom.plans.parameters import AGE_FILTER
from clickloom.sources import testdata as D

SF_DIR = "/root/testdata/sf0.001"


def test_session_job_writes_all_tables(spark, tmp_path):
    actions, users = D.actions(spark, SF_DIR), D.users(spark, SF_DIR)
    for task in ("one", "two"):
        jobs.write_results(jobs.session_job(actions, users, task, AGE_FILTER, folder=str(tmp_path / f"small-{task}")), str(tmp_path / "results"))
    stored = {path.name: spark.read.parquet(str(path)) for path in (tmp_path / "results").iterdir()}
    assert set(stored) == {
        "session_stat_ratio",
        "session_random_extract",
        "session_detail",
        "top10_category",
        "top10_session",
    }
    for table in stored.values():
        counts = {row.task_id: row["count"] for row in table.groupBy("task_id").count().collect()}
        assert set(counts) == {"one", "two"}
        assert counts["one"] == counts["two"]
    assert stored["session_stat_ratio"].count() == 2
    assert stored["top10_category"].count() == 20
    # a full sample by default
    known = sampling.session_starts(actions, users).count()
    assert stored["session_random_extract"].where("task_id = 'one'").count() == min(100, known) == 100


def scans(frame):
    """How often the plan that ran reads the action log."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum("event_type" in line and "FileScan" in line for line in plan.splitlines())


def test_session_job_reads_the_log_a_few_times(spark, tmp_path):
    actions, users = D.actions(spark, SF_DIR), D.users(spark, SF_DIR)
    results = jobs.session_job(actions, users, "t", AGE_FILTER, folder=str(tmp_path))
    # three small results are written with one read each; what is left reads once per table
    assert sum(scans(results[name]) for name in results) <= 3


def test_session_job_over_filtered_sessions(spark, tmp_path):
    actions, users = D.actions(spark, SF_DIR), D.users(spark, SF_DIR)
    every = jobs.session_job(actions, users, "t", AGE_FILTER, folder=str(tmp_path / "all"))
    some = jobs.session_job(actions, users, "t", AGE_FILTER, sessions_from="filtered", folder=str(tmp_path / "some"))
    passing = {r.session_id for r in sessions.filtered_session_lengths(actions, users, AGE_FILTER).collect()}
    for name in ("session_random_extract", "session_detail", "top10_session"):
        assert {r.session_id for r in some[name].collect()} <= passing
        assert not {r.session_id for r in every[name].collect()} <= passing
    assert every["session_stat_ratio"].collect() == some["session_stat_ratio"].collect()


def test_buckets_are_counted_while_lengths_are_written(spark, tmp_path):
    """The same row as by counting, without reading the lengths or the log again."""
    actions, users = D.actions(spark, SF_DIR), D.users(spark, SF_DIR)
    lengths = sessions.filtered_session_lengths(actions, users, AGE_FILTER)

    def write(rows):
        rows.write.parquet(str(tmp_path / "lengths"))
        return spark.read.parquet(str(tmp_path / "lengths"))

    written, observed = sessions.observed_bucket_counts(lengths, write)
    counted = sessions.session_bucket_counts(lengths)
    assert observed.dtypes == counted.dtypes and observed.collect() == counted.collect()
    assert sorted(written.collect()) == sorted(lengths.collect())
    ratios = jobs.session_job(actions, users, "t", AGE_FILTER, sessions_from="filtered", folder=str(tmp_path / "job"))
    plan = ratios["session_stat_ratio"]._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def test_page_and_area_jobs(spark):
    actions = D.actions(spark, SF_DIR)
    text = jobs.page_job(actions, D.PAGE_FLOW, "t")["page_split_convert_rate"].collect()[0].convert_rate
    assert [step.split("=")[0] for step in text.split("|")] == ["1_2", "2_3", "3_4", "4_5", "5_6", "6_7"]
    top = jobs.area_job(actions, D.cities(spark, SF_DIR), D.products(spark, SF_DIR), "t", D.AREA_LEVELS)
    assert top["area_top3_product"].groupBy("area").count().where("count > 3").count() == 0
    assert jobs.new_task_id() != jobs.new_task_id()
