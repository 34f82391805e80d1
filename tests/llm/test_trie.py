"""The prefix trie against plain dictionaries; subtree sums against a walk of the tree."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from clickloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(table):
    convs = defaultdict(list)
    for conv_id, turn, role, text in table:
        if conv_id is not None:
            convs[conv_id].append((turn, role or "", text or ""))
    for own in convs.values():
        said = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, said(r)))
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(r[1:] for r in [*convs.get(c - c % 20, [])[:h], *own[h:]])
    nodes = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in nodes:
        if node:
            children[node[:-1]] += 1
    for node, members in nodes.items():
        words = len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(members) - 1) * words
    out = []
    for node, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(rebuilt[c]) == len(node)))
        out.append((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), children[node],
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def made(seed, convs):
    """Few different turns, so that beginnings and whole conversations repeat."""
    random_ = random.Random(seed)
    rows = []
    for c in [None, *range(convs)]:
        if random_.random() < 0.1:
            continue
        for turn in range(random_.randint(1, 9)):
            turn = random_.choice([turn, turn, turn, None, 0])
            rows.append((c, turn, random_.choice(["user", "assistant", None]), random_.choice(["one two", "", None, " three four "])))
    return rows


def run(frame):
    return sorted(map(tuple, trie.prefix_trie(frame).collect()), key=str)


def test_same_as_dictionaries(spark):
    rows = made(1, 120)
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_long_and_equal_conversations_over_many_tasks(spark):
    rows = made(2, 60) + [(200, n, "user", f"turn {n}") for n in range(700)]
    rows += [(c, n, "user", f"turn {n}") for c in range(1000, 1160) for n in range(6)]
    frame = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = run(frame.repartition(5))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_subtree_sums(spark, seed):
    random_ = random.Random(seed)
    parent = {0: None}
    for n in range(1, 300):
        # chains, bushes and stars
        parent[n] = random_.choice([n - 1, n - 1, n - 1, random_.randrange(n), 5 if n > 5 else 0])
    total = dict.fromkeys(parent, 0)
    for n in parent:
        at = n
        while at is not None:
            total[at] += n + 1
            at = parent[at]
    names = {n: hashlib.md5(str((seed, n)).encode()).digest() for n in parent} | {None: None}
    rows = [(names[n], names[p], n + 1) for n, p in parent.items()]
    found = trie.subtree_sums(spark.createDataFrame(rows, "id binary, parent binary, weight long"), ["weight"]).collect()
    assert {bytes(r.id): r.weight for r in found} == {names[n]: w for n, w in total.items()} and len(found) == 300


def test_empty_table_and_other_columns(spark):
    rows = made(3, 30)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert run(frame.where("false")) == []
    assert run(frame.where("conv_id IS NULL")) == []
    assert run(frame.selectExpr("*", "1 AS id", "2 AS part", "'x' AS said", "3 AS depth", "4 AS ends")) == brute(rows)


def test_turnless_and_very_long(spark):
    # 1 loses its only turn to its absent group's beginning, 40 keeps a very long text
    rows = [(c, 0, "user", "word " * 200_000 + str(c % 2)) for c in (1, 2, 3, 4, 5, 40, 41, 42)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
