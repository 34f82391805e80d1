"""The ad click log: one text line per click, space separated.

Fields: epoch milliseconds, province, city, user id, ad id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AD_LINE_FIELDS = ("timestamp", "province", "city", "userid", "adid")

# Epoch milliseconds of the years 1 to 9999, the range of a timestamp.
FIRST_MILLIS, LAST_MILLIS = -62_135_596_800_000, 253_402_300_799_999


def _parsed(lines: DataFrame) -> DataFrame:
    parts = F.split(F.trim("value"), " +")
    fields = {name: F.get(parts, F.lit(i)) for i, name in enumerate(AD_LINE_FIELDS)}
    millis = fields["timestamp"].try_cast("bigint")
    # a number outside the range would end the job
    in_range = F.when(millis.between(FIRST_MILLIS, LAST_MILLIS), millis)
    return lines.select(
        "value",
        F.timestamp_millis(in_range).alias("ts"),
        fields["province"].alias("province"),
        fields["city"].alias("city"),
        fields["userid"].try_cast("bigint").alias("userid"),
        fields["adid"].try_cast("bigint").alias("adid"),
    )


def _complete():
    # city needs no test of its own: a line without it has no user or ad id either
    return F.col("ts").isNotNull() & F.col("userid").isNotNull() & F.col("adid").isNotNull()


def parse_ad_log(lines: DataFrame) -> DataFrame:
    """Typed clicks from log lines (column `value`); lines that cannot be read are left out."""
    return _parsed(lines).where(_complete()).select("ts", "province", "city", "userid", "adid")


def rejected_ad_log(lines: DataFrame) -> DataFrame:
    """The log lines that `parse_ad_log` leaves out, for a side table."""
    return _parsed(lines).where(~_complete()).select("value")


def marked_ad_log(lines: DataFrame) -> DataFrame:
    """All log lines, typed, and those that cannot be read in a column `rejected`, which is
    NULL for the others. The streams take this form to store rejects beside their results."""
    rejected = F.when(~_complete(), F.col("value")).alias("rejected")
    return _parsed(lines).select("ts", "province", "city", "userid", "adid", rejected)


def read_ad_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines from text files."""
    return spark.read.text(path)


def stream_ad_log(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None
) -> DataFrame:
    """Log lines from text files as they arrive in a directory.

    The limits, of which one may be given, bound a batch: after a stop, what has piled up is
    taken in many batches. At least one file is taken at a time.
    """
    if max_files_per_trigger is not None and max_bytes_per_trigger is not None:
        raise ValueError("a batch is limited by files or by bytes, not by both")
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.text(path)


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = 1_000_000,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source. `max_offsets_per_trigger` bounds the lines of a batch, over
    all partitions of the topic; `min_partitions` spreads few topic partitions over more tasks."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    limits = {"maxOffsetsPerTrigger": max_offsets_per_trigger, "minPartitions": min_partitions}
    for name, value in limits.items():
        if value is not None:
            if value < 1:
                raise ValueError(f"{name} must be positive")
            options[name] = str(value)
    return options


def kafka_ad_log(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = 1_000_000,
    min_partitions: int | None = None,
) -> DataFrame:
    """Log lines from a Kafka topic; needs Spark's Kafka connector on the class path."""
    options = kafka_options(servers, topic, starting_offsets, max_offsets_per_trigger, min_partitions)
    lines = spark.readStream.format("kafka").options(**options).load()
    return lines.select(F.col("value").cast("string").alias("value"))
