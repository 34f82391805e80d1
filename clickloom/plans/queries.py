"""The registered queries: each job over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions import text_result, with_task_id
from clickloom.operators import ads, areas, categories, pages, sampling, sessions
from clickloom.plans import parameters as P
from clickloom.plans.session import work_dir
from clickloom.sinks import BatchTable, append_parquet
from clickloom.sources import testdata as D
from clickloom.sources.actions import clean_actions, in_date_range, read_session_log, write_session_log
from clickloom.sources.ad_log import marked_ad_log, parse_ad_log, rejected_ad_log, stream_ad_log
from clickloom.sinks.batch_table import OVERWRITE
from clickloom.streaming import ad_jobs, tables

Query = Callable[[SparkSession, str], DataFrame]


# -- sessions ----------------------------------------------------------------------------


def action_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_actions(D.raw_actions(spark, sf_dir), D.START_DATE, D.END_DATE)


def session_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_profile(D.actions(spark, sf_dir))


def session_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_items(D.actions(spark, sf_dir))


def session_user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_user_profile(session_profile(spark, sf_dir), D.users(spark, sf_dir))


def session_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.filtered_session_profile(D.actions(spark, sf_dir), D.users(spark, sf_dir), P.FULL_FILTER)


def _lengths(spark: SparkSession, sf_dir: str, chosen: sessions.SessionFilter) -> DataFrame:
    return sessions.filtered_session_lengths(D.actions(spark, sf_dir), D.users(spark, sf_dir), chosen)


def session_bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_bucket_counts(_lengths(spark, sf_dir, P.FULL_FILTER))


def session_ratio_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = sessions.session_bucket_counts(_lengths(spark, sf_dir, P.AGE_FILTER))
    return sessions.session_ratio_stat(counts, P.TASK_ID)


def _starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.session_starts(D.actions(spark, sf_dir), D.users(spark, sf_dir))


def session_hour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.session_hour_counts(_starts(spark, sf_dir), P.SAMPLE_SIZE)


def _sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sampled_sessions(_starts(spark, sf_dir), P.SAMPLE_SIZE, seed=P.SAMPLE_SEED)


def session_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.session_sample(D.actions(spark, sf_dir), _sampled(spark, sf_dir), P.TASK_ID)


def session_sample_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_detail(D.actions(spark, sf_dir), _sampled(spark, sf_dir), P.TASK_ID)


def _session_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actions stored in buckets by session."""
    path = work_dir(spark, "session-log")
    name = "session_log_" + path.rsplit("-", 1)[1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_session_log(D.actions(spark, sf_dir), name, path, buckets)
    return read_session_log(spark, name)


def bucketed_session_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_profile(_session_log(spark, sf_dir))


def bucketed_sample_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_detail(_session_log(spark, sf_dir), _sampled(spark, sf_dir), P.TASK_ID)


# -- categories --------------------------------------------------------------------------


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_counts(D.actions(spark, sf_dir))


def category_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_top10(category_counts(spark, sf_dir), P.TASK_ID)


def category_session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_session_counts(D.actions(spark, sf_dir))


def _top_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = categories.category_top(category_counts(spark, sf_dir))
    return categories.top_sessions(D.actions(spark, sf_dir), top)


def category_top_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = categories.category_top(category_counts(spark, sf_dir))
    return categories.category_top_sessions(D.actions(spark, sf_dir), top, P.TASK_ID)


def top_session_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = _top_sessions(spark, sf_dir)
    return sessions.session_detail(D.actions(spark, sf_dir), top, P.TASK_ID)


# -- pages -------------------------------------------------------------------------------


def page_transition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_transition_counts(D.actions(spark, sf_dir), D.PAGE_FLOW)


def page_start_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_start_pv(D.actions(spark, sf_dir), D.PAGE_FLOW[0])


def page_convert_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_convert_rate(D.actions(spark, sf_dir), D.PAGE_FLOW)


def page_convert_rate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_convert_rate_text(page_convert_rate(spark, sf_dir), P.TASK_ID)


# -- areas -------------------------------------------------------------------------------


def area_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranged = in_date_range(D.actions(spark, sf_dir), D.START_DATE, D.END_DATE)
    return areas.area_clicks(ranged, D.cities(spark, sf_dir))


def area_product_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.area_product_counts(D.actions(spark, sf_dir), D.cities(spark, sf_dir))


def area_product_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.area_product_full(area_product_counts(spark, sf_dir), D.products(spark, sf_dir))


def area_top3_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.area_top3_product(area_product_full(spark, sf_dir), P.TASK_ID, D.AREA_LEVELS)


# -- ads ---------------------------------------------------------------------------------


def ad_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_ad_log(D.ad_lines(spark, sf_dir))


def ad_log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_ad_log(D.ad_lines(spark, sf_dir))


def ad_user_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_user_daily_counts(D.ad_clicks(spark, sf_dir))


def ad_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_blacklist(ad_user_daily_counts(spark, sf_dir), D.BLACKLIST_THRESHOLD)


def ad_filtered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_filtered_log(D.ad_clicks(spark, sf_dir), ad_blacklist(spark, sf_dir))


def ad_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_stat(ad_filtered_log(spark, sf_dir))


def ad_province_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_province_top3(ad_stat(spark, sf_dir))


def ad_click_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_click_trend(D.ad_clicks(spark, sf_dir))


def ad_click_trend_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_click_trend(D.ad_clicks(spark, sf_dir), horizon="1 hour")


def ad_sliding_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_sliding_trend(D.ad_clicks(spark, sf_dir))


def ad_trend_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_trend_series(ad_click_trend(spark, sf_dir), D.SERIES_DATE, D.SERIES_HOUR)


# -- streams, run to completion ----------------------------------------------------------


def _in_batches(
    spark: SparkSession,
    sf_dir: str,
    base: str,
    start: Callable[[DataFrame], StreamingQuery],
    read: Callable[[DataFrame], DataFrame] = parse_ad_log,
) -> None:
    """Feed the ad lines as they would come: one part of the month after another is written
    to the folder that the stream reads, and the query goes on from its checkpoint. Each
    part is a batch."""
    lines = D.ad_lines_by_part(spark, sf_dir)
    for part in range(D.STREAM_PARTS):
        lines.where(F.col("part") == part).select("value").write.mode("append").text(f"{base}/lines")
        start(read(stream_ad_log(spark, f"{base}/lines"))).awaitTermination()


def stream_ad_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "stream-ad-stat")
    stat = tables.stat_table(spark, f"{base}/stat")
    listed = ad_blacklist(spark, sf_dir)

    def start(clicks: DataFrame) -> StreamingQuery:
        kept = ads.ad_filtered_log(clicks, listed)
        return ad_jobs.start_ad_stat(kept, stat, f"{base}/checkpoint", until_done=True)

    _in_batches(spark, sf_dir, base, start)
    return stat.read()


def stream_ad_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "stream-ad-blacklist")
    blacklist = tables.blacklist_table(spark, f"{base}/blacklist")
    counts = tables.user_count_table(spark, f"{base}/counts")

    def start(clicks: DataFrame) -> StreamingQuery:
        return ad_jobs.start_blacklist(
            clicks, counts, blacklist, f"{base}/checkpoint", threshold=D.BLACKLIST_THRESHOLD, until_done=True
        )

    _in_batches(spark, sf_dir, base, start)
    return blacklist.read()


def stream_ad_filtered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After each batch of the log, the list is extended from that batch; a click is thus held
    against the users listed before its batch."""
    base = work_dir(spark, "stream-ad-filtered-log")
    blacklist = tables.blacklist_table(spark, f"{base}/blacklist")
    counts = tables.user_count_table(spark, f"{base}/counts")
    log = tables.log_table(spark, f"{base}/log")

    def start(clicks: DataFrame) -> StreamingQuery:
        ad_jobs.start_filtered_log(clicks, blacklist, log, f"{base}/checkpoint", until_done=True).awaitTermination()
        return ad_jobs.start_blacklist(
            clicks, counts, blacklist, f"{base}/list-checkpoint", threshold=D.BLACKLIST_THRESHOLD, until_done=True
        )

    _in_batches(spark, sf_dir, base, start)
    return log.read().drop("date")


def stream_ad_province_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "stream-ad-province-top3")
    stat = tables.stat_table(spark, f"{base}/stat")
    top = tables.top_table(spark, f"{base}/top")
    listed = ad_blacklist(spark, sf_dir)

    def start(clicks: DataFrame) -> StreamingQuery:
        kept = ads.ad_filtered_log(clicks, listed)
        return ad_jobs.start_province_top3(kept, stat, top, f"{base}/checkpoint", until_done=True)

    _in_batches(spark, sf_dir, base, start)
    return top.read()


def _stream_trend(spark: SparkSession, sf_dir: str, purpose: str) -> BatchTable:
    base = work_dir(spark, purpose)
    trend = tables.trend_table(spark, f"{base}/trend")
    _in_batches(
        spark, sf_dir, base, lambda clicks: ad_jobs.start_click_trend(clicks, trend, f"{base}/checkpoint", until_done=True)
    )
    return trend


def stream_ad_click_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_jobs.trend_result(_stream_trend(spark, sf_dir, "stream-ad-click-trend"))


def stream_ad_click_trend_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_jobs.trend_result(_stream_trend(spark, sf_dir, "stream-ad-click-trend-recent"), "1 hour")


def stream_ad_sliding_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "stream-ad-sliding-trend")
    panes = tables.pane_table(spark, f"{base}/panes")
    _in_batches(
        spark, sf_dir, base, lambda clicks: ad_jobs.start_sliding_trend(clicks, panes, f"{base}/checkpoint", until_done=True)
    )
    return ad_jobs.sliding_result(panes)


def stream_ad_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broken lines, stored by the stream that counts the others."""
    base = work_dir(spark, "stream-ad-rejects")
    stat, rejects = tables.stat_table(spark, f"{base}/stat"), tables.reject_table(spark, f"{base}/rejects")

    def start(clicks: DataFrame) -> StreamingQuery:
        return ad_jobs.start_ad_stat(clicks, stat, f"{base}/checkpoint", until_done=True, rejects=rejects)

    _in_batches(spark, sf_dir, base, start, marked_ad_log)
    return rejects.read().select("value")


def stream_running_ad_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily counts as state of the stream, dropped once a day is a day past."""
    base = work_dir(spark, "stream-running-ad-stat")
    stat = tables.stat_table(spark, f"{base}/stat", OVERWRITE)
    listed = ad_blacklist(spark, sf_dir)

    def start(clicks: DataFrame) -> StreamingQuery:
        kept = ads.ad_filtered_log(clicks, listed)
        return ad_jobs.start_ad_stat(kept, stat, f"{base}/checkpoint", watermark="1 day", until_done=True)

    _in_batches(spark, sf_dir, base, start)
    return stat.read()


def stream_running_click_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "stream-running-click-trend")
    trend = tables.trend_table(spark, f"{base}/trend", OVERWRITE)

    def start(clicks: DataFrame) -> StreamingQuery:
        return ad_jobs.start_click_trend(clicks, trend, f"{base}/checkpoint", watermark="1 day", until_done=True)

    _in_batches(spark, sf_dir, base, start)
    return ad_jobs.trend_result(trend)


def stream_ad_user_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "stream-ad-user-daily-counts")
    counts = tables.user_count_table(spark, f"{base}/counts")
    _in_batches(
        spark,
        sf_dir,
        base,
        lambda clicks: ad_jobs.start_user_daily_counts(clicks, counts, f"{base}/checkpoint", until_done=True),
    )
    return counts.read()


def _stream_all(spark: SparkSession, sf_dir: str, result: str) -> DataFrame:
    """All ad jobs in one query over several batches, the list feeding back into them."""
    base = work_dir(spark, f"stream-all-{result}")
    stored = {
        "counts": tables.user_count_table(spark, f"{base}/counts"),
        "blacklist": tables.blacklist_table(spark, f"{base}/blacklist"),
        "stat": tables.stat_table(spark, f"{base}/stat"),
        "top": tables.top_table(spark, f"{base}/top"),
        "trend": tables.trend_table(spark, f"{base}/trend"),
    }

    def start(clicks: DataFrame) -> StreamingQuery:
        return ad_jobs.start_all_ad_jobs(
            clicks,
            **stored,
            checkpoint=f"{base}/checkpoint",
            threshold=D.BLACKLIST_THRESHOLD,
            until_done=True,
            compact_every=2,
        )

    _in_batches(spark, sf_dir, base, start)
    return stored[result].read()


def stream_all_ad_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_all(spark, sf_dir, "stat")


def stream_all_ad_province_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_all(spark, sf_dir, "top")


def stream_all_ad_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_all(spark, sf_dir, "blacklist")


# -- sinks, after two batches ------------------------------------------------------------


def _halves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All clicks in two batches: those before noon of any day, then the rest."""
    clicks = D.ad_clicks(spark, sf_dir)
    morning = F.hour("ts") < 12
    return [clicks.where(morning), clicks.where(~morning)]


def _two_batches(table: BatchTable, batches: list[DataFrame]) -> DataFrame:
    for batch_id, batch in enumerate(batches):
        table.write(batch, batch_id)
    # the last batch comes again, as after a failure
    table.write(batches[-1], len(batches) - 1)
    return table.read()


def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "sink-append")
    append_parquet(with_task_id(ad_stat(spark, sf_dir), P.TASK_ID), path)
    append_parquet(with_task_id(ads.ad_stat(D.ad_clicks(spark, sf_dir)), P.OTHER_TASK_ID), path)
    # the task id is a directory: without a schema its type would be guessed
    stored = T.StructType([*tables.STAT_SCHEMA.fields, T.StructField("task_id", T.StringType())])
    return spark.read.schema(stored).parquet(path)


def sink_upsert_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = tables.user_count_table(spark, work_dir(spark, "sink-upsert-add"))
    return _two_batches(table, [ads.ad_user_daily_counts(half) for half in _halves(spark, sf_dir)])


def sink_upsert_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = tables.stat_table(spark, work_dir(spark, "sink-upsert-overwrite"), OVERWRITE)
    return _two_batches(table, [ads.ad_stat(half) for half in _halves(spark, sf_dir)])


def sink_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = tables.blacklist_table(spark, work_dir(spark, "sink-insert-ignore"))
    return _two_batches(table, [half.select("userid") for half in _halves(spark, sf_dir)])


def sink_replace_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = tables.top_table(spark, work_dir(spark, "sink-replace-slice"))
    batches = [ads.ad_province_top3(ads.ad_stat(half)) for half in _halves(spark, sf_dir)]
    return _two_batches(table, batches)


REGISTERED: list[Query] = [
    action_clean,
    session_profile,
    session_items,
    session_user_profile,
    session_filtered,
    session_bucket_counts,
    session_ratio_stat,
    session_hour_counts,
    session_sample,
    session_sample_detail,
    bucketed_session_profile,
    bucketed_sample_detail,
    category_counts,
    category_top10,
    category_session_counts,
    category_top_sessions,
    top_session_detail,
    page_transition_counts,
    page_start_pv,
    page_convert_rate,
    page_convert_rate_text,
    area_clicks,
    area_product_counts,
    area_product_full,
    area_top3_product,
    ad_log_parse,
    ad_log_rejects,
    ad_user_daily_counts,
    ad_blacklist,
    ad_filtered_log,
    ad_stat,
    ad_province_top3,
    ad_click_trend,
    ad_click_trend_recent,
    ad_sliding_trend,
    ad_trend_series,
    stream_ad_stat,
    stream_ad_blacklist,
    stream_ad_filtered_log,
    stream_ad_province_top3,
    stream_ad_click_trend,
    stream_ad_click_trend_recent,
    stream_ad_user_daily_counts,
    stream_ad_sliding_trend,
    stream_ad_rejects,
    stream_running_ad_stat,
    stream_running_click_trend,
    stream_all_ad_stat,
    stream_all_ad_province_top3,
    stream_all_ad_blacklist,
    sink_append,
    sink_upsert_add,
    sink_upsert_overwrite,
    sink_insert_ignore,
    sink_replace_slice,
]


def as_results(query: Query) -> Query:
    """The query with its columns in result-table form, under UTC."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return text_result(query(spark, sf_dir))

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def all_queries() -> dict[str, Query]:
    return {query.__name__: as_results(query) for query in REGISTERED}
