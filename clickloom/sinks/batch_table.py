"""Keyed result tables fed by micro-batches: two plain Parquet tables in one folder.

`batches` is partitioned by batch id. A batch overwrites its own partition, so one that Spark
replays after a failure changes nothing and costs no more than its own rows. `folded` is
partitioned by day and holds earlier batches merged; folding overwrites the days that these
batches touched, and each day says up to which batch it goes (`upto`), so a fold that died
half-way counts for the days it reached. Reading merges both by one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ADD, OVERWRITE, IGNORE, REPLACE_SLICE, APPEND = "add", "overwrite", "ignore", "replace_slice", "append"


class BatchTable:
    """A table with key columns and one rule for rows that meet again in a later batch.

    add            the counts of a key are summed
    overwrite      the count of the latest batch stands
    ignore         a key once stored stays as it is
    replace_slice  the rows of the latest batch that has the slice stand; `keys` are the
                   columns of the slice, and a batch brings a slice as a whole
    append         all rows stand; there are no keys

    `value` is the count column (used by add and overwrite); `partition_by` is empty or one key
    column, such as the day, that lays out folded rows. Batch ids must grow, as those of one
    streaming query do.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], rule: str,
        value: str = "click_count", partition_by: Sequence[str] = (),
    ):
        if rule not in (ADD, OVERWRITE, IGNORE, REPLACE_SLICE, APPEND):
            raise ValueError(f"unknown rule {rule!r}")
        if len(partition_by) > 1:
            raise ValueError("folded rows are laid out by one column at most")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.rule, self.value = list(keys), rule, value
        # a table without such a column is folded as one part
        self.day = partition_by[0] if partition_by else "slot"
        self._batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        slot = [] if partition_by else [T.StructField("slot", T.IntegerType())]
        self._fold = T.StructType([*self._batch.fields, T.StructField("upto", T.LongType()), *slot])
        for name, kind, by in (("batches", self._batch, "batch_id"), ("folded", self._fold, self.day)):
            spark.createDataFrame([], kind).write.mode("ignore").partitionBy(by).parquet(f"{self.path}/{name}")

    def require(self, *rules: str) -> None:
        """Fail early where a job needs another rule than the table has."""
        if self.rule not in rules:
            raise ValueError(f"{self.path} merges by {self.rule!r}; this job needs {' or '.join(map(repr, rules))}")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Store a batch; has the signature that `foreachBatch` calls. The number of files
        follows the size of the batch."""
        rows = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        if self.rule == ADD:
            rows = rows.groupBy(*self.keys).agg(F.sum(self.value).alias(self.value))
        elif self.rule == IGNORE:
            rows = rows.dropDuplicates(self.keys)
        self._overwrite(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).hint("rebalance"), "batches", "batch_id")

    def _overwrite(self, rows: DataFrame, name: str, by: str) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(by).parquet(f"{self.path}/{name}")

    def compact(self, before: int | None = None) -> None:
        """Fold the stored batches, or those before a batch, so that reading stays cheap. Batches
        that an earlier fold holds are removed; readers under way may still use the newer ones."""
        if before is None:
            before = (self._stored("batches").agg(F.max("batch_id")).first()[0] or 0) + 1
        fresh, folded = self._unfolded(before), self._stored("folded")
        earlier = folded.agg(F.max("upto")).first()[0]
        rows = self._merged(before).withColumn("upto", F.lit(before - 1).cast("bigint"))
        if self.day == "slot":
            rows = rows.withColumn("slot", F.lit(0))
        else:
            rows = matching(rows, fresh.select(self.day).distinct())
        self._overwrite(rows.select(*self._fold.fieldNames()).hint("rebalance", F.col(self.day)), "folded", self.day)
        if earlier is not None:
            gone = self._stored("batches").where(F.col("batch_id") <= earlier).select("batch_id").distinct().collect()
            for row in gone:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batches/batch_id={row.batch_id}")
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def read(self) -> DataFrame:
        """The table after all stored batches."""
        return self._merged().select(*self.schema.fieldNames())

    def read_before(self, batch_id: int) -> DataFrame:
        """The table as it was before a batch, also if that batch is being replayed."""
        return self._merged(batch_id).select(*self.schema.fieldNames())

    def read_batch(self, batch_id: int) -> DataFrame:
        """The rows of one stored batch."""
        return self._stored("batches").where(F.col("batch_id") == batch_id).select(*self.schema.fieldNames())

    def _stored(self, name: str) -> DataFrame:
        return self.spark.read.schema(self._batch if name == "batches" else self._fold).parquet(f"{self.path}/{name}")

    def _unfolded(self, before: int | None) -> DataFrame:
        """Rows of batches that the fold of their day does not hold yet."""
        rows = self._stored("batches")
        if before is not None:
            rows = rows.where(F.col("batch_id") < before)
        day = F.col(self.day) if self.day != "slot" else F.lit(0)
        marks = self._stored("folded").groupBy(F.col(self.day).alias("__day")).agg(F.max("upto").alias("__upto"))
        kept = rows.join(marks, day.eqNullSafe(F.col("__day")), "left").where("__upto IS NULL OR batch_id > __upto")
        return kept.select(*self._batch.fieldNames())

    def _merged(self, before: int | None = None) -> DataFrame:
        folded = self._stored("folded").select(*self._batch.fieldNames())
        rows = folded.unionByName(self._unfolded(before))
        if self.rule == IGNORE and before is not None:
            # each key carries its first batch, so an earlier state can be told from a fold too
            rows = rows.where(F.col("batch_id") < before)
        if self.rule == APPEND:
            return rows
        if self.rule == REPLACE_SLICE:
            latest = rows.groupBy(*self.keys).agg(F.max("batch_id").alias("batch_id"))
            return matching(rows, latest)
        others = [n for n in self.schema.fieldNames() if n not in self.keys]
        if self.rule == ADD:
            merged = [F.sum(self.value).alias(self.value), F.max("batch_id").alias("batch_id")]
        else:
            pick, last = (F.max_by, F.max) if self.rule == OVERWRITE else (F.min_by, F.min)
            merged = [pick(n, "batch_id").alias(n) for n in others] + [last("batch_id").alias("batch_id")]
        return rows.groupBy(*self.keys).agg(*merged)


def matching(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose values in all columns of `keys` occur there; NULL matches NULL."""
    renamed = keys.select(*[F.col(name).alias(f"__{name}") for name in keys.columns])
    same = [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in keys.columns]
    return rows.join(renamed, reduce(lambda a, b: a & b, same), "left_semi")
