"""The trie of conversation prefixes, with subtree totals by parallel tree contraction.

Every distinct sequence of first turns is a node. Its key is the exclusive or of 128-bit
hashes of each turn with its place, so the keys of all prefixes of a conversation are running
values. Turns are sorted over all tasks by ranges; a conversation that goes on in the next
range takes the value so far along, so one with a great share of all turns is spread.

Totals of subtrees come from a contraction of the tree in rounds of joins. *Compress*: a chain
of nodes with one child each is taken out at once; its nodes look up where the node they point
at points, which doubles the way each round, until they point at the end of the chain and know
what lies between; those that do are done. *Rake*: all leaves are taken out and added to their parents. A phase of both
leaves less than half of the nodes. At last the contracted nodes are put back from the last
phase to the first: the total of a chain node is what lies between it and the end of its chain,
and the total of that end.

Joins are on keys that occur once on both sides, or read written tables and so can be split
where one parent has a great share of all nodes; sums by parent begin before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import stored, text_or_empty

# Groups of conversations that share a beginning, and a word, by the contract.
GROUP, MOST_SHARED = 20, 3
WORD = "[^\\x20\\x09-\\x0D]+"

#: Ids joined to one text before they are hashed in order.
IDS_AT_ONCE = 20_000


def turns_of(conversations: DataFrame) -> DataFrame:
    """Per row: conv_id, turn, said (hash of role and text), words of the text."""
    role, text = text_or_empty("role"), text_or_empty("text")
    said = F.unhex(F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        said.alias("said"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


def _numbered(turns: DataFrame) -> DataFrame:
    """The turns with their place (`at`) in the conversation, from 0; without `turn`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, current, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            new = np.flatnonzero(np.r_[ids[0] != current, ids[1:] != ids[:-1]])
            # a conversation that began in an earlier batch goes on counting
            starts = np.zeros(len(ids), np.int64)
            if not len(new) or new[0] > 0:
                starts[: new[0] if len(new) else len(ids)] = -count
            lengths = np.diff(np.r_[new, len(ids)])
            if len(new):
                starts[new[0] :] = np.repeat(new, lengths)
            at = np.arange(len(ids)) - starts
            current, count = ids[-1], int(at[-1]) + 1
            parts = pa.array(np.full(len(ids), part, np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), parts, pa.array(at), batch.column(2), batch.column(3)],
                names=["conv_id", "part", "at", "said", "words"],
            )

    order = ["conv_id", "turn", "said"]
    ranged = turns.where("conv_id IS NOT NULL").repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(run, "conv_id long, part int, at long, said binary, words long")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns (conv_id, at, said, words, ends: whether it is the last one) and one
    row per conversation (conv_id, size of the rebuilt one)."""
    rows = stored(_numbered(turns_of(conversations)), "trie-turns")
    runs = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    parts = Window.partitionBy("conv_id").orderBy("part")
    before = F.sum("n").over(parts.rowsBetween(Window.unboundedPreceding, -1))
    runs = stored(runs.select("conv_id", "part", "n", F.coalesce(before, F.lit(0)).alias("before")), "trie-runs")
    # of conversations that lie in more than one range: at most two rows per range
    later = runs.where("before > 0").select("conv_id", "part", "before")
    rows = rows.join(later, ["conv_id", "part"], "left")
    rows = rows.select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"), "said", "words")

    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("long")
    sizes = runs.groupBy("conv_id").agg(F.sum("n").alias("size"))
    sizes = sizes.select("conv_id", "size", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("first"))
    firsts = sizes.select(F.col("conv_id").alias("first"), F.col("size").alias("first_size"))
    taken = F.least("h", F.coalesce("first_size", F.lit(0)))
    convs = sizes.join(firsts, "first", "left").select(
        "conv_id", "first", "h", taken.alias("taken"), (taken + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("size")
    )
    convs = stored(convs, "trie-conversations")

    heads = rows.where((F.col("at") < MOST_SHARED) & (F.col("conv_id") % GROUP == 0))
    heads = heads.select(F.col("conv_id").alias("first"), "at", "said", "words")
    begun = convs.where("taken > 0").join(heads, "first").where("at < taken")
    # the row of a conversation among its many turns: that side can be split
    own = rows.join(convs, "conv_id").where("at >= h").withColumn("at", F.col("at") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "at", "said", "words", (F.col("at") == F.col("size") - 1).alias("ends")]
    return begun.select(*columns).unionByName(own.select(*columns)), convs.select("conv_id", "size")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running exclusive or inside each run of a conversation, before (`p`) and after (`k`)
    each turn, as two halves."""
    part, current, carried = TaskContext.get().partitionId(), None, np.zeros(2, np.int64)
    for batch in batches:
        ids = batch.column(0).to_numpy()
        if not len(ids):
            continue
        hashes = b"".join(
            hashlib.sha256(at.to_bytes(8, "little") + said).digest()[:16]
            for at, said in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        )
        own = np.frombuffer(hashes, "<i8").reshape(-1, 2)
        after = np.bitwise_xor.accumulate(own, axis=0)
        before = after ^ own
        # what came before the run is taken out again; a run from an earlier batch has it carried
        new = np.flatnonzero(np.r_[ids[0] != current, ids[1:] != ids[:-1]])
        lengths = np.diff(np.r_[new, len(ids)])
        out = np.zeros_like(own)
        first = new[0] if len(new) else len(ids)
        out[:first] = carried
        if len(new):
            out[first:] = np.repeat(before[new], lengths, axis=0)
        after, before = after ^ out, before ^ out
        current, carried = ids[-1], after[-1].copy()
        arrays = [batch.column(0), pa.array(np.full(len(ids), part, np.int32)), *batch.columns[1:2], *batch.columns[3:]]
        arrays += [pa.array(np.ascontiguousarray(x[:, i])) for x in (before, after) for i in range(2)]
        yield pa.RecordBatch.from_arrays(
            arrays, names=["conv_id", "part", "at", "words", "ends", "p0", "p1", "k0", "k1"]
        )


def _key(high: Column, low: Column) -> Column:
    return F.unhex(F.concat(*[F.lpad(F.hex(half), 16, "0") for half in (high, low)]))


ROOT = bytes(16)


def prefixes(turns: DataFrame) -> DataFrame:
    """One row per conversation and depth from 1 on: conv_id, depth, id and parent (keys of
    nodes), words, ends."""
    order = ["conv_id", "at"]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(
        ranged.mapInArrow(
            _running, "conv_id long, part int, at long, words long, ends boolean, p0 long, p1 long, k0 long, k1 long"
        ),
        "trie-prefixes",
    )
    spans = rows.groupBy("conv_id").agg(F.min("part").alias("first"), F.max("part").alias("last"))
    # conversations in more than one range: fewer than ranges
    broken = spans.where("first < last").select("conv_id")
    halves = [F.max_by(half, "at").alias(half) for half in ("k0", "k1")]
    ends = rows.join(broken, "conv_id", "left_semi").groupBy("conv_id", "part").agg(*halves)
    parts = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "conv_id", "part", *[F.expr(f"bit_xor({half})").over(parts).alias(f"c{half[1]}") for half in ("k0", "k1")]
    )
    joined = rows.join(carried, ["conv_id", "part"], "left")

    def whole(name: str) -> Column:
        return _key(*[F.col(f"{name}{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0))) for i in range(2)])

    return joined.select(
        "conv_id", (F.col("at") + 1).alias("depth"), whole("k").alias("id"), whole("p").alias("parent"), "words", "ends"
    )


def _ends(ends: DataFrame) -> DataFrame:
    """Per node of (id, conv_id) the hash of its conversation ids in order: id, ends_sha256."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, IDS_AT_ONCE):
                pieces: dict[bytes, list[str]] = {}
                piece = batch.slice(at, IDS_AT_ONCE)
                for node, conv_id in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    pieces.setdefault(node, []).append(str(conv_id))
                n = len(pieces)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(pieces), pa.binary()),
                        pa.array([part] * n, pa.int32()),
                        pa.array(range(number, number + n), pa.int64()),
                        pa.array([",".join(ids) for ids in pieces.values()], pa.string()),
                    ],
                    names=["id", "part", "piece", "ids"],
                )
                number += n

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, hashed = None, None
        for batch in batches:
            done = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(3)):
                if node == current:
                    hashed.update(b",")
                else:
                    if hashed is not None:
                        done.append((current, hashed.hexdigest()))
                    current, hashed = node, hashlib.sha256()
                hashed.update(ids.as_py().encode())
            yield _two(done)
        if hashed is not None:
            yield _two([(current, hashed.hexdigest())])

    def _two(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], names=["id", "ends_sha256"]
        )

    ranged = ends.select("id", "conv_id").repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
    pieces = ranged.mapInArrow(join, "id binary, part int, piece long, ids string")
    in_order = pieces.repartition("id").sortWithinPartitions("id", "part", "piece")
    return in_order.mapInArrow(digest, "id binary, ends_sha256 string")


def _summed(rows: DataFrame, by: str, values: list[str]) -> DataFrame:
    """Sums of the values by a column, as `key` and `add_*`."""
    sums = [F.sum(value).alias(f"add_{value}") for value in values]
    return rows.where(F.col(by).isNotNull()).groupBy(F.col(by).alias("key")).agg(*sums)


def _with_sums(rows: DataFrame, sums: DataFrame, values: list[str], others: list[Column]) -> DataFrame:
    joined = rows.join(sums, F.col("id") == F.col("key"), "left")
    added = [(F.col(value) + F.coalesce(f"add_{value}", F.lit(0))).alias(value) for value in values]
    return joined.select("id", *others, *added)


def _compress(active: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame] | None:
    """What is left without the nodes of one child, and these nodes (id, stop, values): the end
    of their chain and what lies between. None if there are none."""
    kids = active.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("stop")
    )
    single = stored(kids.where("n = 1").select("of", "stop"), "trie-single")
    if single.isEmpty():
        return None
    above = single.select(F.col("stop").alias("below"))
    inside = single.select(F.col("of").alias("next"))
    rows = active.join(single, F.col("id") == F.col("of")).join(above, F.col("id") == F.col("below"), "left")
    rows = rows.join(inside, F.col("stop") == F.col("next"), "left")
    more = F.col("next").isNotNull().alias("more")
    rows = stored(rows.select("id", "parent", "stop", F.col("below").isNull().alias("top"), more, *values), "trie-chains")
    # nodes that point at the end of their chain are done; others, ever fewer, look further
    done, looking = [rows.where("NOT more")], rows.where("more")
    while not looking.isEmpty():
        known = reduce(DataFrame.unionByName, [looking, *done])
        known = known.select(
            F.col("id").alias("key"), F.col("stop").alias("next"), F.col("more").alias("further"), *[F.col(v).alias(f"add_{v}") for v in values]
        )
        sums = [(F.col(v) + F.col(f"add_{v}")).alias(v) for v in values]
        jumped = looking.join(known, F.col("stop") == F.col("key"))
        jumped = stored(
            jumped.select("id", "parent", F.col("next").alias("stop"), "top", F.col("further").alias("more"), *sums), "trie-chains"
        )
        done.append(jumped.where("NOT more"))
        looking = jumped.where("more")
    chains = reduce(DataFrame.unionByName, done)
    tops = chains.where("top")
    hung = tops.select(F.col("stop").alias("end"), F.col("parent").alias("above"))
    rest = active.join(single.select(F.col("of").alias("gone")), F.col("id") == F.col("gone"), "left_anti")
    rest = rest.join(hung, F.col("id") == F.col("end"), "left")
    parent = F.when(F.col("end").isNotNull(), F.col("above")).otherwise(F.col("parent")).alias("parent")
    left = _with_sums(rest, _summed(tops, "parent", values), values, [parent])
    return stored(left, "trie-compressed"), chains.select("id", "stop", *values)


def _rake(active: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """What is left without the leaves, and the leaves (id, values)."""
    inner = stored(active.where("parent IS NOT NULL").select(F.col("parent").alias("of")).distinct(), "trie-inner")
    leaves = stored(active.join(inner, F.col("id") == F.col("of"), "left_anti"), "trie-leaves")
    rest = active.join(inner, F.col("id") == F.col("of"), "left_semi")
    left = _with_sums(rest, _summed(leaves, "parent", values), values, [F.col("parent")])
    return stored(left, "trie-raked"), leaves.select("id", *values)


def subtree_sums(tree: DataFrame, values: list[str]) -> DataFrame:
    """Per node of `tree` (id, parent, values; the root's parent is null) the sums of the
    values over its subtree, itself included: id, values.

    Any number of roots; ids must be distinct and every parent a node. An empty tree gives no
    rows.
    """
    active = stored(tree.select("id", "parent", *values), "trie-active")
    phases = []
    while not active.isEmpty():
        compressed = _compress(active, values)
        active, chains = compressed if compressed is not None else (active, None)
        active, leaves = _rake(active, values)
        phases.append((chains, leaves))
    known = None
    for chains, leaves in reversed(phases):
        known = leaves if known is None else known.unionByName(leaves)
        if chains is not None:
            below = known.select(F.col("id").alias("key"), *[F.col(v).alias(f"add_{v}") for v in values])
            back = chains.join(below, F.col("stop") == F.col("key"))
            sums = [(F.col(v) + F.col(f"add_{v}")).alias(v) for v in values]
            known = known.unionByName(stored(back.select("id", *sums), "trie-expanded"))
    return known if known is not None else active


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Turns are taken by number, null first, those of one number by the hash of role and text;
    null roles and texts are empty. Repeated turns stay. Rows without a conv_id belong to no
    conversation and take no part. A conversation whose rebuilt form has no turn ends at the
    root. An empty table has no conversation and gives no rows; other columns are not read.
    """
    turns, convs = rebuilt(conversations)
    rows = stored(prefixes(turns), "trie-rows")
    root = F.lit(ROOT)
    # depth, parent and words are the same in all rows of a node
    nodes = rows.groupBy("id", "parent", "depth", "words").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    top = convs.groupBy().agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    top = top.select(
        root.alias("id"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), "conv_id", "n_convs"
    )
    nodes = stored(nodes.unionByName(top), "trie-nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, F.col("id") == F.col("of"), "left").select(
        *nodes.columns, F.coalesce("n_children", F.lit(0)).alias("n_children")
    )
    nodes = stored(nodes, "trie-nodes")
    tree = nodes.select(
        "id",
        "parent",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    totals = subtree_sums(tree, ["n_leaves", "saved_tokens"])
    at_root = convs.where("size = 0").select(root.alias("id"), "conv_id")
    ends = stored(_ends(rows.where("ends").select("id", "conv_id").unionByName(at_root)), "trie-ends")
    parents = nodes.select(F.col("id").alias("of"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(parents, F.col("parent") == F.col("of"), "left").join(totals, "id").join(ends, "id", "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
