"""URL filter: rules against plain code, the model by its accuracy on labels it has not seen."""

import math

from pyspark.sql import functions as F

from clickloom.llm import url_filter as U


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name), default=None)


URLS = [
    None,
    "",
    "no scheme",
    "http://a.example.org/es/1",
    "http://example.org/en/1",
    "http://example.org/en/2",
    "HTTP://WWW.Example.ORG/en/17?x=1",
    "http://notexample.org/es/",
    "http://x.com/fr/1",
    "http://x.com/de/1",
    "http://com/de/1",
    "http://x.com/en/1",
    "https://x.org",
    "https://x.org?q=://y.com/de/",
    "http://x.net/a://b.com/de/#f",
    "ftp://ÄÖ.org/ß",
    "http://x.org:80/a",
    "http://" + "a" * 5000 + ".org/" + "b" * 5000,
    "x://://",
]


def test_rules_and_odd_rows(spark):
    frame = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(3, URLS[3], "x")], "page_id long, url string, host string")
    rows = U.judge(frame).collect()
    assert len(rows) == len(URLS) + 1
    for row in rows:
        host, path, rule = plain(URLS[row.page_id])
        assert (row.host, row.path, row.rule) == (host, path, rule and rule.name)
        assert row.verdict == rule.verdict if rule else row.verdict in ("allow", "block")


def test_empty_table_and_no_labels(spark):
    assert U.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
    only = spark.createDataFrame([(1, None), (2, "http://x.net/")], "page_id long, url string")
    assert [r.verdict for r in U.judge(only).collect()] == ["allow", "allow"]


def test_features(spark):
    url = "http://a.b-c.org/x/y1.html?p=1&q=2#f"
    frame = spark.createDataFrame([(url,)], "url string").withColumns({"host": U.host_of(F.col("url")), "path": U.path_of(F.col("url"))})
    row = U.features(frame).first()
    entropy = -sum(url.count(c) / len(url) * math.log2(url.count(c) / len(url)) for c in set(url))
    assert abs(row.f_entropy - entropy) < 1e-9
    assert (row.f_depth, row.f_labels, row.f_parameters, row.f_hyphens) == (2, 2, 2, 1)
    assert (row.f_length, row.f_fragment) == (len(url), 1)
    assert abs(row.f_digit_ratio - 3 / len(url)) < 1e-9


def test_held_out_accuracy(spark):
    """Labels follow length and digits; the model is measured on URLs it has not seen."""
    rows = [(i, f"http://h{i % 40}.net/{'p' * (i % 37)}/{i * 7919 % 10**(1 + i % 9)}") for i in range(2000)]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    frame = frame.withColumns({"host": U.host_of(F.col("url")), "path": U.path_of(F.col("url"))})
    frame = frame.withColumn("blocked", ((F.length("path") > 20) & F.rlike("path", F.lit("[0-9]{3}"))).cast("int"))
    model = U.fit(frame.where("page_id % 4 != 0"))
    held = model.verdicts(frame.where("page_id % 4 = 0"))
    right = held.agg(F.avg(((F.col("model_verdict") == "block").cast("int") == F.col("blocked")).cast("int"))).first()[0]
    assert right > 0.95


def test_every_suffix_has_a_rate_and_whole_urls_count(spark):
    rows = [(i, f"http://h.site{i // 4}.net/{'bad' if i // 4 % 2 else 'good'}", f"h.site{i // 4}.net", "/x", i // 4 % 2) for i in range(6000)]
    labelled = spark.createDataFrame(rows, "page_id long, url string, host string, path string, blocked int")
    model = U.fit(labelled)
    rates = {r.f_suffix: r.f_rate for r in model.rates.collect()}
    assert len(rates) == 1500 and rates["site0.net"] == 0.25 and rates["site1499.net"] == 0.75
    rated = U._with_suffix_rate(labelled, model.rates, model.base)
    assert rated.count() == 6000 and rated.where("f_suffix_rate = 0.5").count() == 0
    url = "a" * 4096 + "bcdefghi" * 512
    one = spark.createDataFrame([(url, "", ""), (None, "", ""), ("aaaa", "", "")], "url string, host string, path string")
    found = [r.f_entropy for r in U.features(one).collect()]
    assert abs(found[0] - (0.5 + 0.5 * 4)) < 1e-9 and found[1:] == [0.0, 0.0]
