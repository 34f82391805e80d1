"""Revisits against plain code, on few records of many kinds."""

import random

import pytest
from pyspark.sql import functions as F

from clickloom.llm import warc

SCHEMA = "record_id long, url string, ts long, kind string, headers map<string,string>, payload_digest string, payload_length long"


def canonical(spark, urls):
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    return [r[0] for r in frame.select(warc.canonical_url(F.col("u"))).collect()]


def test_canonical_urls(spark):
    same = ["http://www.A.org:80/x/?utm_source=q#f", "HTTPS://a.org:443/x", "a.ORG/x?ref=1&sessionid=2", " http://a.org/x/ "]
    assert set(canonical(spark, same)) == {"a.org/x"}
    assert canonical(spark, ["http://a.org:443/X?b=1&utm_id=2&c=3", None, ""]) == ["a.org:443/X?b=1&c=3", None, ""]


def plain(records):
    out = {}
    for r in records:
        id_, url, ts, kind, headers, digest, length = r
        own = {}
        for k, v in (headers or {}).items():
            own[k.lower()] = v
        if url is None or ts is None or kind not in ("response", "revisit"):
            out[id_] = ("unplaced", None, own, digest, length)
            continue
        if kind == "response":
            out[id_] = ("response", None, own, digest, length)
            continue
        before = [x for x in records if x[1] == url and x[3] == "response" and x[2] is not None and (x[2], x[0]) < (ts, id_)]
        if not before:
            out[id_] = ("no_original", None, own, digest, length)
            continue
        o = max(before, key=lambda x: (x[2], x[0]))
        its = {k.lower(): v for k, v in (o[4] or {}).items()}
        if "etag" in own and "etag" in its:
            agree = own["etag"].removeprefix("W/") == its["etag"].removeprefix("W/")
        elif "last-modified" in own and "last-modified" in its:
            agree = own["last-modified"] == its["last-modified"]
        else:
            agree = None if digest is None or o[5] is None else digest == o[5]
        if agree:
            merged = its | {k: v for k, v in own.items() if k not in warc.NOT_UPDATED}
            out[id_] = ("resolved", o[0], merged, o[5], o[6])
        else:
            out[id_] = ("no_validator" if agree is None else "mismatch", None, own, digest, length)
    return out


def made(n, urls):
    random.seed(n)
    rows = []
    for i in range(n):
        headers = {}
        if random.random() < 0.6:
            headers[random.choice(["ETag", "etag"])] = random.choice(["", "W/"]) + random.choice("ab")
        if random.random() < 0.4:
            headers["Last-Modified"] = random.choice("xy")
        headers |= {"Content-Length": str(i), "Date": str(i)} if random.random() < 0.7 else {}
        url = None if random.random() < 0.02 else f"h.org/{random.choice(urls)}"
        ts = None if random.random() < 0.02 else random.randint(0, n // 3)
        kind = random.choices(["response", "revisit", "request", None], [3, 7, 0.3, 0.1])[0]
        rows.append((i, url, ts, kind, headers if random.random() < 0.95 else None, random.choice(["d1", "d2", None]), i))
    return rows


@pytest.mark.parametrize("urls", [["hot"], ["hot"] * 5 + [str(i) for i in range(20)]])
def test_same_as_plain_code(spark, urls):
    """One URL with all records is dealt over several ranges and still resolved."""
    rows = made(600, urls)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("part", F.lit("clash")).repartition(4)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.record_id: (r.status, r.original_id, r.headers, r.payload_digest, r.payload_length) for r in warc.resolve_revisits(frame).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert found == plain(rows)


def test_repeated_rows_and_empty_table(spark):
    row = (1, "a.org/", 5, "response", {"ETag": "a"}, "d", 3)
    again = (2, "a.org/", 5, "revisit", {"etag": "a"}, None, None)
    frame = spark.createDataFrame([row, row, again, again], SCHEMA)
    assert sorted(r.status for r in warc.resolve_revisits(frame).collect()) == ["resolved"] * 2 + ["response"] * 2
    assert warc.resolve_revisits(frame.where("false")).count() == 0
