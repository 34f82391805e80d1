"""Exact dedup by two-pass Bloom filtering.

The first pass adds every text's hash to a Bloom filter whose slots count up to two. A hash
that finds all its slots at two is possibly repeated. In the second pass only rows with such
a hash are shuffled and compared exactly; all others pass straight through. A filter has no
false negatives, so the result is exact whatever its size.

The filter has at most `MAX_SLOTS` slots, one bit each in the form that is sent to tasks, so
the broadcast is at most 64 MB however large the input. Beyond about 30 million texts it
fills up and lets more rows through to the shuffle, which carries only a digest and an id
per row; the result stays exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import stored, text_or_empty

BLOCK = 1 << 16  # slots per block; an offset in a block takes two bytes
PROBES = 3
SLOTS_PER_ROW = 16
MAX_SLOTS = 1 << 29

# The letters that are lower-cased before texts are compared.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def normalised(text: str = "text") -> Column:
    """The text with A-Z lower-cased and nothing else changed; null is the empty text."""
    return F.translate(text_or_empty(text), UPPER, LOWER)


def filter_slots(rows: int) -> int:
    """Slots for so many rows: a power of two between one block and `MAX_SLOTS`."""
    wanted = max(BLOCK, rows * SLOTS_PER_ROW)
    return min(MAX_SLOTS, 1 << (wanted - 1).bit_length())


def probe_slots(hashes: np.ndarray, slots: int) -> np.ndarray:
    """The slots of each 64-bit hash, one row per probe."""
    low = hashes & np.uint64(0xFFFFFFFF)
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(low + np.uint64(i) * step) & np.uint64(slots - 1) for i in range(PROBES)])


def _count_slots(slots: int):
    """Per task: each slot it meets, at most twice, as two-byte offsets by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            # probes of one row that fall together count once, or it would look repeated
            own = np.sort(probe_slots(hashes, slots), axis=0)
            fresh = np.vstack([np.ones((1, own.shape[1]), bool), own[1:] != own[:-1]])
            seen, counts = np.unique(own[fresh], return_counts=True)
            seen = np.repeat(seen, np.minimum(counts, 2))
            blocks = (seen // BLOCK).astype(np.int64)
            offsets = (seen % BLOCK).astype("<u2")
            starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else []
            ends = np.r_[starts[1:], len(blocks)] if len(blocks) else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(blocks[s]) for s in starts], pa.int64()),
                    pa.array([offsets[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
                ],
                names=["block", "offsets"],
            )

    return run


def _merge_block(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slots of a block that were met twice or more, as a bitmap."""
    counts = np.zeros(BLOCK, np.uint8)
    for batch in batches:
        for offsets in batch.column("offsets"):
            seen, n = np.unique(np.frombuffer(offsets.as_py(), "<u2"), return_counts=True)
            counts[seen] = np.minimum(counts[seen] + np.minimum(n, 2), 2)
    bitmap = np.packbits(counts == 2).tobytes() if (counts == 2).any() else None
    if bitmap is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([bitmap], pa.binary())], names=["block", "bitmap"])


def repeated_slots(hashes: DataFrame, slots: int) -> dict[int, bytes]:
    """First pass over a frame of one column of 64-bit hashes: the bitmaps of the blocks
    that hold slots met at least twice. In all at most slots / 8 bytes."""
    met = hashes.mapInArrow(_count_slots(slots), "block long, offsets binary")
    merged = met.groupBy("block").applyInArrow(_merge_block, "block long, bitmap binary")
    return {row.block: row.bitmap for row in merged.toLocalIterator()}


def possibly_repeated(keys: DataFrame, column: str, rows: int) -> DataFrame:
    """The keys with a column `repeated`: false only if no other row has the same hash."""
    slots = filter_slots(rows)
    bitmaps = repeated_slots(keys.select(column), slots)
    sent = keys.sparkSession.sparkContext.broadcast(bitmaps)

    @F.pandas_udf("boolean")
    def probe(values):
        own = probe_slots(values.to_numpy(np.int64).view(np.uint64), slots)
        hit = np.ones(own.shape[1], bool)
        for row in own:
            blocks, offsets = (row // BLOCK).astype(np.int64), (row % BLOCK).astype(np.int64)
            order = np.argsort(blocks, kind="stable")
            cuts = np.flatnonzero(np.diff(blocks[order])) + 1
            for part in np.split(order, cuts) if len(order) else []:
                bitmap = sent.value.get(int(blocks[part[0]]))
                if bitmap is None:
                    hit[part] = False
                else:
                    bits = np.frombuffer(bitmap, np.uint8)
                    hit[part] &= (bits[offsets[part] >> 3] >> (7 - (offsets[part] & 7)) & 1).astype(bool)
        import pandas as pd

        return pd.Series(hit)

    return keys.withColumn("repeated", probe(F.col(column)))


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after lower-casing A-Z; null counts as empty, so all null
    and empty texts form one group. The row with the largest id stays; a null id is smaller
    than all others. Of repeated rows (same id and text) one stays, and each counts towards
    group_size. An empty table gives an empty result; other columns are not read.
    """
    digests = docs.select(F.col(id_column).alias("doc_id"), F.sha2(normalised(text), 256).alias("text_sha256"))
    keys = stored(digests, "exact-dedup-keys")
    hashed = keys.withColumn("hash", F.conv(F.substring("text_sha256", 1, 15), 16, 10).cast("long"))
    # 60 bits of the digest, spread over the 64 that the probes use
    hashed = hashed.withColumn("hash", F.xxhash64("hash"))
    marked = possibly_repeated(hashed, "hash", keys.count())
    marked = stored(marked.select("doc_id", "text_sha256", "repeated"), "exact-dedup-marks")
    alone = marked.where(~F.col("repeated")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    suspects = marked.where("repeated")
    # equal ids and texts are counted before the shuffle, then groups before the join
    rows = suspects.groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    groups = suspects.groupBy(F.unhex("text_sha256").alias("digest")).agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    # joined by another form of the key: both sides are dealt out anew, so that adaptive
    # execution can split the rows of a large group over several tasks
    joined = rows.join(groups.withColumn("text_sha256", F.lower(F.hex("digest"))), "text_sha256")
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    compared = joined.select("doc_id", "keep_id", "group_size", "text_sha256", copy).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(compared)


def without_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    As `exact_groups`, but rows whose hash is not repeated are passed on where they are
    read; only the texts of possibly repeated rows are shuffled. Needs two reads of `docs`.
    """
    names = docs.columns
    row = F.struct(*[F.col(f"`{name}`") for name in names])
    digest = F.sha2(normalised(text), 256)
    hash_ = F.xxhash64(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    hashes = stored(docs.select(hash_.alias("hash")), "exact-dedup-hashes")
    packed = docs.select(row.alias("row"), F.col(id_column).alias("id"), digest.alias("digest"), hash_.alias("hash"))
    marked = possibly_repeated(packed, "hash", hashes.count())
    suspects = marked.where("repeated")
    stays = suspects.groupBy("digest").agg(F.max("id").alias("keep"))
    chosen = suspects.join(
        stays.select(F.unhex("digest").alias("digest_bytes"), "keep"),
        (F.unhex("digest") == F.col("digest_bytes")) & F.col("id").eqNullSafe(F.col("keep")),
        "left_semi",
    ).dropDuplicates(["digest", "id"])
    return marked.where(~F.col("repeated")).select("row.*").unionByName(chosen.select("row.*"))
