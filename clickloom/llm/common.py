"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.plans.session import work_dir


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows that go to a Python worker at once, besides the last one.
BATCH_BYTES = 2 << 20


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this library from where the driver did.

    Enough where all machines have it under the same path, as a local session does;
    elsewhere ship it with the application (`--py-files`).
    """
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), ROOT]))


def modest_batches(spark: SparkSession) -> None:
    """Lets tasks hand their rows to Python in batches of at most `BATCH_BYTES`, in what runs
    from now on; a session that is set to less keeps its setting.

    A batch is built in native memory beside the heap and held again by the Python worker.
    Spark's own limits, 10,000 rows and 64 MB, would let the texts of a whole task be one.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read again.

    Cuts the lineage: what follows reads files that every executor reaches, so a lost
    executor costs a reread and not a recomputation. The folder goes with the application.
    """
    spark = rows.sparkSession
    path = work_dir(spark, purpose)
    rows.write.parquet(path)
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(folder)
    read = spark.read.schema(rows.schema).parquet(path)
    read.stored_at = path
    return read


def few(rows: DataFrame, count: int, together: int) -> DataFrame:
    """The rows, about `count`, in partitions of no fewer than `together`, if they have smaller
    ones; but one for each core, as far as they have so many.

    For small rows that are to be `stored`: a task writes a file, and the work on a file, as
    the processes a JVM starts to set its mode on a plain local disk, does not shrink with it.
    """
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, -(-count // together), 1))


def discard(*rows: DataFrame) -> None:
    """Removes what `stored` wrote, once nothing that is still to run reads it."""
    for each in rows:
        spark = each.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(each.stored_at)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


Batches = Iterator[pa.RecordBatch]


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The function over batches, which at the end of a task gives freed memory back.

    Python workers live on and serve later stages; what an earlier one has freed would stay
    theirs, and count against the executor.
    """

    @functools.wraps(run)
    def wrapped(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:  # glibc only
                trim(0)

    return wrapped


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(rows: DataFrame, base: str) -> str:
    """A column name that `rows` does not have, in any case."""
    taken = {name.lower() for name in rows.columns}
    while base in taken:
        base += "_"
    return base
