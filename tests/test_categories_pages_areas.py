"""Category, page and area rules on hand-made rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickloom.operators import areas, categories, pages
from clickloom.sources.actions import city_dimension

from test_sessions import action, frame


def counts_of(spark, rows):
    found = categories.category_counts(frame(spark, rows)).collect()
    return {row.category_id: (row.click_count, row.order_count, row.pay_count) for row in found}


def test_category_counts_in_one_pass(spark):
    rows = [
        action(click_category_id=1),
        action(click_category_id=1),
        action(order_category_ids="1, 2"),
        action(order_category_ids="2,2"),
        action(pay_category_ids="3"),
        action(pay_category_ids="x,"),
        action(),
    ]
    assert counts_of(spark, rows) == {1: (2, 1, 0), 2: (0, 3, 0), 3: (0, 0, 1)}


def test_ties_go_to_the_lower_category(spark):
    counts = spark.createDataFrame(
        [(9, 1, 1, 1), (3, 1, 1, 1), (5, 1, 1, 1), (7, 1, 1, 2), (1, 2, 0, 0), (2, 1, 2, 0)],
        "category_id bigint, click_count bigint, order_count bigint, pay_count bigint",
    )
    top = categories.category_top10(counts, "t").collect()
    assert [row.category_id for row in top] == [1, 2, 7, 3, 5, 9]
    assert len(categories.category_top(counts, 2).collect()) == 2


def test_sessions_rank_by_number_not_text(spark):
    rows = [action("nine", i, click_category_id=1) for i in range(9)]
    rows += [action("ten", i, click_category_id=1) for i in range(10)]
    rows += [action("also-ten", i, click_category_id=1) for i in range(10)]
    rows += [action("other", i, click_category_id=8) for i in range(50)]
    top = spark.createDataFrame([(1,)], "category_id bigint")
    found = categories.top_sessions(frame(spark, rows), top, limit=3).orderBy(F.desc("click_count"), "session_id")
    assert [(row.session_id, row.click_count) for row in found.collect()] == [
        ("also-ten", 10),
        ("ten", 10),
        ("nine", 9),
    ]


def walk(session, page_ids, gap=10):
    return [action(session, gap * i, page_id=page) for i, page in enumerate(page_ids)]


@pytest.mark.parametrize("ranges", [1, 2, 5, 40])
def test_page_pairs_do_not_depend_on_the_ranges(spark, ranges):
    rows = walk("a", [1, 2, 3, 1, 2, None, 3]) + walk("b", [2, 3, 3, 4]) + walk("c", [1])
    rows += [action("a", None, page_id=1), action("a", None, page_id=2)]
    found = pages.page_convert_rate(frame(spark, rows), [1, 2, 3, 4], ranges).orderBy("step").collect()
    assert [tuple(row) for row in found] == [
        # start page: 3 timed views and 1 without a time
        (1, 1, 2, 2, 4, 0.5),
        (2, 2, 3, 2, 2, 1.0),
        (3, 3, 4, 1, 2, 0.5),
    ]


def test_pairs_against_brute_force_with_one_long_session(spark):
    dice = random.Random(5)
    start = datetime(2024, 1, 5)
    rows, expected = [], {}
    for session in ["bot"] + [f"s{i}" for i in range(40)]:
        steps = 2000 if session == "bot" else dice.randint(1, 30)
        times = sorted(dice.sample(range(40000), steps))
        visited = [dice.randint(1, 4) for _ in times]
        for pair in zip(visited, visited[1:]):
            expected[pair] = expected.get(pair, 0) + 1
        rows += [
            action(session, page_id=page, action_time=start + timedelta(seconds=time))
            for page, time in zip(visited, times)
        ]
    dice.shuffle(rows)
    flow = [1, 2, 2, 3, 4, 1, 2]
    found = pages.page_transition_counts(frame(spark, rows), flow).orderBy("step").collect()
    assert [row.pair_count for row in found] == [expected[pair] for pair in zip(flow, flow[1:])]


def test_a_session_of_one_instant_is_spread_over_tasks(spark):
    """All actions of one session at one time, so that only the id orders them."""
    n = 40_000
    log = spark.range(n, numPartitions=4).selectExpr(
        "'bot' AS session_id", "TIMESTAMP'2024-01-05 00:00:00' AS action_time", "id AS event_id", "id * id % 4 + 1 AS page_id"
    )
    flow = [1, 2, 1]
    found = pages.page_transition_counts(log, flow, ranges=16).orderBy("step").collect()
    visited = [i * i % 4 + 1 for i in range(n)]
    assert [row.pair_count for row in found] == [sum(p == pair for p in zip(visited, visited[1:])) for pair in [(1, 2), (2, 1)]]
    ranged = log.repartitionByRange(16, "session_id", "action_time", "event_id")
    sizes = [row["count"] for row in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * n / 16
    plan = pages.page_transition_counts(log, flow)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning(session" not in plan


def test_times_before_1970_keep_their_order(spark):
    start = datetime(1970, 1, 1)
    rows = [
        action("a", page_id=page, action_time=start + timedelta(seconds=600 * i))
        for i, page in zip((-2, -1, 0, 1), (1, 2, 3, 4))
    ]
    rows.append(action("a", None, page_id=9))
    found = pages.page_transition_counts(frame(spark, rows), [1, 2, 3, 4]).collect()
    assert [row.pair_count for row in found] == [1, 1, 1]


def test_pair_never_seen_and_start_never_seen(spark):
    rows = walk("a", [2, 3])
    rates = pages.page_convert_rate(frame(spark, rows), [1, 2, 3]).orderBy("step").collect()
    assert [(row.pair_count, row.base_count, row.convert_rate) for row in rates] == [(0, 0, None), (1, 0, None)]
    rates = pages.page_convert_rate(frame(spark, rows), [2, 1, 3]).orderBy("step").collect()
    assert [row.convert_rate for row in rates] == [0.0, None]
    empty = pages.page_convert_rate(frame(spark, []), [1, 2]).collect()
    assert [(row.pair_count, row.base_count) for row in empty] == [(0, 0)]
    with pytest.raises(ValueError):
        pages.page_convert_rate(frame(spark, rows), [1])


def test_repeated_pair_has_one_row_per_step(spark):
    rows = walk("a", [1, 2, 1, 2])
    rates = pages.page_convert_rate(frame(spark, rows), [1, 2, 1, 2])
    assert [(row.step, row.pair_count) for row in rates.orderBy("step").collect()] == [(1, 2), (2, 1), (3, 2)]
    text = pages.page_convert_rate_text(rates, "t").collect()[0].convert_rate
    assert text == "1_2=1.0|2_1=0.5|1_2=2.0"


def test_start_page_views(spark):
    row = pages.page_start_pv(frame(spark, walk("a", [1, 2, 1])), 1).collect()[0]
    assert (row.page_id, row.start_pv) == (1, 2)


def test_area_counts_keep_all_cities(spark):
    cities = spark.createDataFrame(
        [(1, "A", "east"), (11, "A", "east"), (2, "B", "west")], "city_id bigint, city_name string, area string"
    )
    rows = [action(city_id=c, click_product_id=p) for c, p in [(11, 5), (1, 5), (1, 5), (2, 5), (1, None), (99, 5)]]
    found = areas.area_product_counts(frame(spark, rows), cities).orderBy("area").collect()
    assert [(row.area, row.product_id, row.click_count, row.city_infos) for row in found] == [
        ("east", 5, 3, "11:A,1:A"),
        ("west", 5, 1, "2:B"),
    ]
    assert areas.area_clicks(frame(spark, rows), cities).count() == 4


def test_ownership_and_missing_products(spark):
    counts = spark.createDataFrame(
        [("east", i, 1, "1:A") for i in range(1, 7)],
        "area string, product_id bigint, click_count bigint, city_infos string",
    )
    products = spark.createDataFrame(
        [
            (1, "own", '{"product_status": 0}'),
            (2, "other", '{"product_status": 1}'),
            (3, "encoded", "%7B%22product_status%22%3A+0%7D"),
            (4, "silent", "{}"),
            (5, "none", None),
        ],
        "product_id bigint, product_name string, extend_info string",
    )
    found = areas.area_product_full(counts, products).orderBy("product_id").collect()
    assert [(row.product_name, row.product_status) for row in found] == [
        ("own", "Self"),
        ("other", "Third Party"),
        ("encoded", "Self"),
        ("silent", "Third Party"),
        ("none", "Third Party"),
    ]


def test_top_products_and_levels(spark):
    cities = city_dimension(spark)
    level_of = {}
    rows = [
        action(city_id=city.city_id, click_product_id=product)
        for city in cities.collect()
        for product, clicks in ((1, 1), (2, 3), (3, 2), (4, 2))
        for _ in range(clicks)
    ]
    products = spark.createDataFrame(
        [(i, f"p{i}", "{}") for i in range(1, 5)], "product_id bigint, product_name string, extend_info string"
    )
    full = areas.area_product_full(areas.area_product_counts(frame(spark, rows), cities), products)
    found = areas.area_top3_product(full, "t").collect()
    per_area = {}
    for row in found:
        level_of[row.area] = row.area_level
        per_area.setdefault(row.area, []).append(row.product_id)
    assert all(sorted(ids) == [2, 3, 4] for ids in per_area.values())
    assert level_of == {
        "华北": "A Level",
        "华东": "A Level",
        "华南": "B Level",
        "华中": "B Level",
        "西北": "C Level",
        "西南": "C Level",
        "东北": "D Level",
    }
