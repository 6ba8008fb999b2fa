import datetime as dt
import random

import pytest
from conftest import rows

from streammart.operators.latest import last_per_key
from streammart.operators.visits import daily_unique_visits, detect_bounces, repair_is_new

SCHEMA = "id BIGINT, mid STRING, last_page_id STRING, is_new STRING, event_time TIMESTAMP"
T0 = dt.datetime(2024, 1, 1)


def log(spark, records):
    return spark.createDataFrame(
        [
            (i, mid, last, new, T0 + dt.timedelta(milliseconds=ms))
            for i, (mid, last, new, ms) in enumerate(records)
        ],
        SCHEMA,
    )


def test_bounce_boundaries(spark):
    e, f = None, "home"
    df = log(
        spark,
        [
            ("m", e, "0", 1000), ("m", e, "0", 3000), ("m", f, "0", 5000), ("m", e, "0", 30000),
            ("m", f, "0", 40000), ("n", e, "0", 1000),
            # one millisecond short of ten seconds is in time
            ("p", e, "0", 0), ("p", f, "0", 9999),
            # a follow-up at the same moment counts if it comes later in order
            ("q", e, "0", 100), ("q", f, "0", 100), ("r", f, "0", 100), ("r", e, "0", 100),
        ],
    )
    assert rows(detect_bounces(df, "id"), "mid", "id") == [("m", 3), ("n", 5), ("r", 11)]


def brute_bounces(records, span):
    found = []
    for i, (mid, last, _, at) in enumerate(records):
        if last:
            continue
        later = [
            t for j, (m, l, _, t) in enumerate(records)
            if m == mid and l and (t, j) > (at, i) and t - at < span
        ]
        if not later:
            found.append((mid, i))
    return sorted(found)


@pytest.mark.parametrize("seed", [1, 2])
def test_bounces_against_brute_force_with_one_hot_visitor(spark, seed):
    rng = random.Random(seed)
    records = [
        ("hot" if rng.random() < 0.5 else f"v{rng.randrange(20)}", rng.choice([None, "a"]), "0",
         rng.randrange(0, 600_000, 500))
        for _ in range(600)
    ]
    found = rows(detect_bounces(log(spark, records), "id"), "mid", "id")
    assert found == brute_bounces(records, 10_000)


def test_new_visitor_repair(spark):
    df = log(
        spark,
        [("a", None, "1", 0), ("a", None, "0", 1), ("a", None, "1", 2), ("a", None, "1", 3),
         ("b", None, None, 0), ("b", None, "1", 5), ("b", None, "1", 5)],
    )
    fixed = repair_is_new(df, ["event_time", "id"])
    assert rows(fixed, "id", "is_new") == [
        (0, "1"), (1, "0"), (2, "0"), (3, "0"), (4, None), (5, "1"), (6, "0")
    ]


def test_daily_unique(spark):
    hour, day = 3_600_000, 86_400_000
    df = log(
        spark,
        [("a", None, "0", 9 * hour), ("a", "", "0", 10 * hour), ("a", "x", "0", day),
         ("a", "", "0", day + hour)],
    )
    assert rows(daily_unique_visits(df, ["id"]), "id", "visit_date") == [
        (0, "2024-01-01"), (3, "2024-01-02")
    ]


def test_first_and_last_are_cut_before_the_shuffle(spark):
    df = log(spark, [("a", None, "1", 0)])
    for plan in (last_per_key(df, ["mid"], ["id"]), daily_unique_visits(df, ["id"])):
        text = plan._jdf.queryExecution().executedPlan().toString()
        partial = text.index("Partial")
        assert text.index("Exchange") < partial, "the limit must run below the exchange"
