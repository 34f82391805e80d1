"""Repairs against a search over all edits; pieces against whole conversations."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from clickloom.llm import repair

WHITE = " \t\n\x0b\x0c\r"
WHOLE = re.compile("(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit, turns) of the first repair found in the order of cost and audit."""
    heap = [(0, "", 0, ())]
    seen = set()
    while heap:
        cost, audit, at, turns = heapq.heappop(heap)
        initials = "".join(role[:1] if role else "?" for role, _ in turns)
        if at == len(rows) and WHOLE.fullmatch(initials):
            return cost, audit, turns
        if (at, len(audit), initials) in seen or len(turns) > 2 * len(rows) + 2:
            continue
        seen.add((at, len(audit), initials))
        if not re.fullmatch("s?(ua)*u?", initials):
            continue
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2, audit + "I", at, (*turns, (role, ""))))
        if at == len(rows):
            continue
        (role, text), fault = rows[at]
        heapq.heappush(heap, (cost + 3, audit + "D", at + 1, turns))
        if fault != "condemned":
            late = int(fault == "truncated")
            heapq.heappush(heap, (cost + late, audit + "K", at + 1, (*turns, (role, text))))
            for other in ("user", "assistant"):
                heapq.heappush(heap, (cost + late + 2, audit + "R", at + 1, (*turns, (other, text))))
    raise AssertionError


def brute(table):
    """Rows of the query from (conv_id, turn, role, text)."""
    out, convs = [], {}
    for conv_id, turn, role, text in table:
        own = convs.setdefault(conv_id, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own.extend([(turn, role, text)] * (2 if kind == 3 else 1))
    for conv_id, own in convs.items():
        shown = " " if conv_id is None else str(conv_id)
        key = lambda r: hashlib.sha256(f"{shown}:{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, key(r)))
        seen, judged, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in own:
            said = text.strip(WHITE)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            judged.append(((role, text), "condemned" if fault in ("blank", "duplicate") else fault))
        cost, audit, turns = cheapest(judged)
        given = [r[0] for r in own if r[0] is not None]
        gaps = max(given) - min(given) + 1 - len(set(given)) if given else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        repaired = "\n".join(f"{role}:{text}" for role, text in turns)
        out.append((conv_id, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256(repaired.encode()).hexdigest()))
    return out


def key(row):
    return (row[0] is not None, row[0] or 0)


def made(seed, convs, most):
    """Odd conversations: all kinds of roles and texts, gaps, ties, nulls and repeats."""
    random_ = random.Random(seed)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "Well", "", " \n", None, "Why? ", "Hm\t", " ", "…"]
    rows = []
    for conv_id in [None, *range(convs)]:
        for _ in range(random_.randint(1, most)):
            turn = random_.choice([None, *range(8)])
            rows.append((conv_id, turn, random_.choice(roles), random_.choice(texts)))
            if random_.random() < 0.1:
                rows.append(rows[-1])
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("piece_rows", [repair.PIECE_ROWS, 1, 2])
def test_same_as_search(spark, piece_rows):
    rows = made(5, 150, 5)
    frame = spark.createDataFrame(rows, SCHEMA)
    found = repair.repair(repair.damaged(frame), piece_rows).collect()
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows), key=key)


def test_a_conversation_over_many_tasks(spark):
    rows = made(6, 40, 4) + [(7, n, ("user", "assistant", "system")[n * 7 % 3], f"Turn {n % 90}.") for n in range(3000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = repair.repair(repair.damaged(frame), 16)
        spread = sorted(map(tuple, found.collect()), key=key)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    whole = repair.repair(repair.damaged(frame), 1 << 20).collect()
    assert spread == sorted(map(tuple, whole), key=key)
    long = next(r for r in spread if r[0] == 7)
    assert len(long[7]) > 2500 and long[3] > 2000


def test_joined_pieces_are_as_cheap_and_early_as_the_whole():
    random_ = random.Random(8)
    for _ in range(400):
        codes = bytes(random_.choice([0, 1, 1, 2, 2, 3, 5, 6, 8]) for _ in range(random_.randint(0, 14)))
        cuts = sorted(random_.randint(0, len(codes)) for _ in range(random_.randint(0, 4)))
        pieces = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        solved = [repair.solve_between(piece) for piece in pieces]
        cost, states = repair.join_pieces([(costs, ranks) for costs, ranks, _ in solved])
        audit = "".join(audits[4 * a + b] for (_, _, audits), a, b in zip(solved, states, states[1:]))
        assert (cost, audit + "I" * repair.MISSING[states[-1]]) == repair.solve_whole(codes)


def test_numbers_hold_cost_then_letters():
    number = repair._pack(5, "DIK", 6)
    assert repair.unpack(number, 6) == (5, "DIK")
    assert repair._pack(5, "DI", 6) < number < repair._pack(5, "DK", 6) < repair._pack(6, "", 6)


def test_empty_and_other_columns(spark):
    frame = spark.createDataFrame(made(9, 5, 4), SCHEMA)
    assert repair.repair(repair.damaged(frame.where("false"))).collect() == []
    wide = frame.selectExpr("*", "1 AS piece", "2 AS copies", "3 AS cost", "'x' AS audit")
    assert sorted(repair.repair(repair.damaged(wide)).collect(), key=key) == sorted(
        repair.repair(repair.damaged(frame)).collect(), key=key
    )


def test_very_long_text(spark):
    rows = [(1, 0, "user", "x" * 3_000_000 + "?"), (1, 1, "assistant", "y " * 1_000_000), (1, 2, "user", "Thanks.")]
    found = repair.repair(repair.damaged(spark.createDataFrame(rows, SCHEMA))).collect()
    assert list(map(tuple, found)) == brute(rows)
