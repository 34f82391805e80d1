"""Streaming ad jobs. Each function starts a query over parsed clicks and returns it.

State that must survive lives in the query's checkpoint and in the result tables; both
belong in a folder all executors reach. A result table belongs to one query checkpoint.
Every query folds its tables each `COMPACT_EVERY` batches.

Counts are kept by adding each batch to its table, which drops no click however late. With
a watermark they are kept as running counts in the stream's state instead; clicks later than
the watermark are then dropped, and the progress of the query tells how many
(`numRowsDroppedByWatermark`). State lies in RocksDB, with a log of changes per batch. Days and
minutes are UTC: the session must be.

Clicks may come from `parse_ad_log`, or from `marked_ad_log` with a table for the lines that
cannot be read (`rejects`): the batch that brings a line stores it there, and the progress of
the query tells how many lines and rejects came (`observedMetrics`, `ad_log`). Running counts
lose the lines before a batch is seen; beside them `start_rejects` stores the rejects.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from clickloom.operators import ads
from clickloom.sinks import BatchTable
from clickloom.sinks.batch_table import ADD, APPEND, IGNORE, OVERWRITE, REPLACE_SLICE, matching

# Fixed value: seconds between micro-batches.
BATCH_INTERVAL = "5 seconds"
COMPACT_EVERY = 100
# Settings of Spark's own state store on disk.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _start(
    rows: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    tables: Sequence[BatchTable],
    checkpoint: str,
    output_mode: str,
    until_done: bool,
    compact_every: int = COMPACT_EVERY,
    rejects: BatchTable | None = None,
) -> StreamingQuery:
    zone = rows.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"days are UTC, but spark.sql.session.timeZone is {zone}")
    marked = "rejected" in rows.columns
    if rejects is not None:
        rejects.require(APPEND)
        if output_mode != "append":
            raise ValueError("running counts keep no rejects; use start_rejects beside them")
        if not marked:
            raise ValueError("rejects need clicks from marked_ad_log")
        is_rejected = F.col("rejected").isNotNull()
        rows = rows.observe("ad_log", F.count(F.lit(1)).alias("lines"), F.count_if(is_rejected).alias("rejected"))

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            for table in [*tables, *([rejects] if rejects is not None else [])]:
                table.compact(before=batch_id)
        if rejects is None:
            return on_batch(_readable(batch), batch_id)
        # one reading of the batch feeds both sinks
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            broken = batch.where("rejected IS NOT NULL").select(F.current_date().alias("date"), F.col("rejected").alias("value"))
            rejects.write(broken, batch_id)
            on_batch(_readable(batch), batch_id)
        finally:
            batch.unpersist()

    writer = rows.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if until_done else {"processingTime": BATCH_INTERVAL}
    return writer.foreachBatch(run).trigger(**trigger).start()


def _readable(clicks: DataFrame) -> DataFrame:
    """The clicks without lines that could not be read."""
    if "rejected" not in clicks.columns:
        return clicks
    return clicks.where("rejected IS NULL").drop("rejected")


def start_rejects(
    lines: DataFrame, rejects: BatchTable, checkpoint: str, until_done: bool = False, compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Store the lines of `marked_ad_log` that cannot be read, and nothing else."""
    return _start(lines, lambda batch, batch_id: None, [], checkpoint, "append", until_done, compact_every, rejects)


def _start_running(rows: DataFrame, *arguments) -> StreamingQuery:
    """A query whose state lies in RocksDB, whatever the session has set otherwise."""
    conf = rows.sparkSession.conf
    before = {name: conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        conf.set(name, value)
    try:
        return _start(rows, *arguments)
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def running_ad_stat(clicks: DataFrame, watermark: str) -> DataFrame:
    """Running counts per day, province, city and ad, for `update` mode.

    Days are event-time windows: their state is dropped once the watermark passes their
    end, and a click later than that is dropped too.
    """
    return (
        _readable(clicks).withWatermark("ts", watermark)
        .groupBy(F.window("ts", "1 day").alias("day"), "province", "city", "adid")
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select(F.to_date("day.start").alias("date"), "province", "city", "adid", "click_count")
    )


def minute_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per minute and ad, with the day of the minute."""
    counts = clicks.groupBy(F.date_trunc("minute", "ts").alias("minute_start"), "adid").agg(
        F.count(F.lit(1)).alias("click_count")
    )
    return counts.withColumn("date", F.to_date("minute_start"))


def running_click_trend(clicks: DataFrame, watermark: str) -> DataFrame:
    """Running counts per minute and ad, for `update` mode; late clicks count until the watermark."""
    return (
        _readable(clicks).withWatermark("ts", watermark)
        .groupBy(F.window("ts", "1 minute").alias("span"), "adid")
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select(F.to_date("span.start").alias("date"), F.col("span.start").alias("minute_start"), "adid", "click_count")
    )


def start_ad_stat(
    clicks: DataFrame,
    stat: BatchTable,
    checkpoint: str,
    watermark: str | None = None,
    until_done: bool = False,
    compact_every: int = COMPACT_EVERY,
    rejects: BatchTable | None = None,
) -> StreamingQuery:
    """Keep the daily counts table up to date. It adds, or with a watermark overwrites."""
    if watermark is not None:
        stat.require(OVERWRITE)
        rows = running_ad_stat(clicks, watermark)
        return _start_running(rows, stat.write, [stat], checkpoint, "update", until_done, compact_every, rejects)
    stat.require(ADD)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        stat.write(ads.ad_stat(batch), batch_id)

    return _start(clicks, on_batch, [stat], checkpoint, "append", until_done, compact_every, rejects)


def start_province_top3(
    clicks: DataFrame,
    stat: BatchTable,
    top: BatchTable,
    checkpoint: str,
    watermark: str | None = None,
    until_done: bool = False,
    compact_every: int = COMPACT_EVERY,
    rejects: BatchTable | None = None,
) -> StreamingQuery:
    """Keep the daily counts and, from them, the top ads per day and province up to date.

    Only the days and provinces that a batch touched are ranked again. The counts table
    adds, or with a watermark overwrites.
    """
    stat.require(ADD if watermark is None else OVERWRITE)
    top.require(REPLACE_SLICE)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        stat.write(ads.ad_stat(batch) if watermark is None else batch, batch_id)
        refresh_top3(stat, top, batch_id)

    if watermark is not None:
        rows = running_ad_stat(clicks, watermark)
        return _start_running(rows, on_batch, [stat, top], checkpoint, "update", until_done, compact_every, rejects)
    return _start(clicks, on_batch, [stat, top], checkpoint, "append", until_done, compact_every, rejects)


def refresh_top3(stat: BatchTable, top: BatchTable, batch_id: int) -> None:
    """Rank again the slices whose counts a stored batch changed."""
    touched = stat.read_batch(batch_id).select("date", "province").distinct()
    top.write(ads.ad_province_top3(matching(stat.read_before(batch_id + 1), touched)), batch_id)


def start_click_trend(
    clicks: DataFrame,
    trend: BatchTable,
    checkpoint: str,
    watermark: str | None = None,
    until_done: bool = False,
    compact_every: int = COMPACT_EVERY,
    rejects: BatchTable | None = None,
) -> StreamingQuery:
    """Keep the counts per minute and ad up to date. The table adds, or with a watermark
    overwrites."""
    if watermark is not None:
        trend.require(OVERWRITE)
        rows = running_click_trend(clicks, watermark)
        return _start_running(rows, trend.write, [trend], checkpoint, "update", until_done, compact_every, rejects)
    trend.require(ADD)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        trend.write(minute_counts(batch), batch_id)

    return _start(clicks, on_batch, [trend], checkpoint, "append", until_done, compact_every, rejects)


def trend_result(trend: BatchTable, horizon: str | None = None) -> DataFrame:
    """The trend table in result form, if asked only back to the horizon."""
    return ads.trend_columns(ads.recent(trend.read(), "minute_start", horizon))


def start_sliding_trend(
    clicks: DataFrame,
    panes: BatchTable,
    checkpoint: str,
    until_done: bool = False,
    compact_every: int = COMPACT_EVERY,
    rejects: BatchTable | None = None,
) -> StreamingQuery:
    """Add each batch's clicks per pane and ad to the pane table; a click is counted once, and
    windows are summed when they are asked for."""
    panes.require(ADD)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        counted = ads.pane_counts(batch)
        panes.write(counted.withColumn("date", F.to_date(F.timestamp_seconds("pane"))), batch_id)

    return _start(clicks, on_batch, [panes], checkpoint, "append", until_done, compact_every, rejects)


def sliding_result(panes: BatchTable, latest: bool = False) -> DataFrame:
    """The counts of all sliding windows, or of the last one that holds a click."""
    rows = panes.read()
    if latest:
        last = F.lit(rows.agg(F.max("pane")).scalar())
        rows = rows.where(F.col("pane") > last - ads.WINDOW_SECONDS)
        end = F.timestamp_seconds(last + ads.SLIDE_SECONDS)
        return ads.sliding_counts(rows).where(F.col("window_end") == end)
    return ads.sliding_counts(rows)


def start_user_daily_counts(
    clicks: DataFrame,
    counts: BatchTable,
    checkpoint: str,
    until_done: bool = False,
    compact_every: int = COMPACT_EVERY,
    rejects: BatchTable | None = None,
) -> StreamingQuery:
    """Add each batch's clicks per day, user and ad to the counts table; no stream state."""
    counts.require(ADD)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        counts.write(ads.ad_user_daily_counts(batch), batch_id)

    return _start(clicks, on_batch, [counts], checkpoint, "append", until_done, compact_every, rejects)


def extend_blacklist(counts: BatchTable, blacklist: BatchTable, batch_id: int, threshold: int) -> None:
    """List the users of a stored batch whose total reached the threshold.

    Totals are needed only for the keys of the batch; one join finds them all.
    """
    changed = counts.read_batch(batch_id).select(*counts.keys)
    totals = matching(counts.read_before(batch_id + 1), changed)
    blacklist.write(ads.ad_blacklist(totals, threshold), batch_id)


def start_blacklist(
    clicks: DataFrame,
    counts: BatchTable,
    blacklist: BatchTable,
    checkpoint: str,
    threshold: int = ads.BLACKLIST_THRESHOLD,
    until_done: bool = False,
    compact_every: int = COMPACT_EVERY,
    rejects: BatchTable | None = None,
) -> StreamingQuery:
    """Add each batch to the daily counts, then list the users who reached the threshold."""
    counts.require(ADD)
    blacklist.require(IGNORE)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        counts.write(ads.ad_user_daily_counts(batch), batch_id)
        extend_blacklist(counts, blacklist, batch_id, threshold)

    return _start(clicks, on_batch, [counts, blacklist], checkpoint, "append", until_done, compact_every, rejects)


def start_filtered_log(
    clicks: DataFrame,
    blacklist: BatchTable,
    log: BatchTable,
    checkpoint: str,
    until_done: bool = False,
    compact_every: int = COMPACT_EVERY,
    rejects: BatchTable | None = None,
) -> StreamingQuery:
    """Store the clicks of users not on the blacklist, which is read afresh for every batch.

    A batch that is stored already stays as it is, so a replay cannot hold it against a later
    list.
    """
    log.require(APPEND)
    blacklist.require(IGNORE)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if log.read_batch(batch_id).isEmpty():
            kept = ads.ad_filtered_log(batch, blacklist.read())
            log.write(kept.withColumn("date", F.to_date("ts")), batch_id)

    return _start(clicks, on_batch, [log], checkpoint, "append", until_done, compact_every, rejects)


def start_all_ad_jobs(
    clicks: DataFrame,
    counts: BatchTable,
    blacklist: BatchTable,
    stat: BatchTable,
    top: BatchTable,
    trend: BatchTable,
    checkpoint: str,
    threshold: int = ads.BLACKLIST_THRESHOLD,
    until_done: bool = False,
    compact_every: int = COMPACT_EVERY,
    rejects: BatchTable | None = None,
) -> StreamingQuery:
    """All ad jobs in one query, with the blacklist feeding back into it.

    Per batch: read the list, count the clicks it lets through, rank the touched slices;
    then count all clicks per user and per minute and extend the list. A user who reaches
    the threshold in one batch is therefore dropped from the next batch on.
    """
    for table, rule in ((counts, ADD), (blacklist, IGNORE), (stat, ADD), (top, REPLACE_SLICE), (trend, ADD)):
        table.require(rule)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            listed = blacklist.read_before(batch_id)
            stat.write(ads.ad_stat(ads.ad_filtered_log(batch, listed)), batch_id)
            refresh_top3(stat, top, batch_id)
            trend.write(minute_counts(batch), batch_id)
            counts.write(ads.ad_user_daily_counts(batch), batch_id)
            extend_blacklist(counts, blacklist, batch_id, threshold)
        finally:
            batch.unpersist()

    tables = [counts, blacklist, stat, top, trend]
    return _start(clicks, on_batch, tables, checkpoint, "append", until_done, compact_every, rejects)
