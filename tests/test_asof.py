"""As-of lookups against a search through all versions, hot keys and stretches included."""

import datetime as dt
import random

import pytest
from conftest import rows

from streammart.operators.asof import asof_join, row_versions

BASE = dt.datetime(2024, 1, 1)
HOW = {"on": ("k", "id"), "times": ("at", "since"), "columns": {"name": "name"}}


def made(spark, seed, facts, versions, keys):
    draw = random.Random(seed)
    at = lambda: BASE + dt.timedelta(seconds=draw.randrange(500))
    key = lambda: draw.choice(["hot", "hot", *keys])
    f = [(n, draw.choice([key(), key(), None]), draw.choice([at(), at(), at(), None])) for n in range(facts)]
    v = [(key(), at(), draw.choice([f"v{n}", f"v{n}", None]), n, n % 5 == 0) for n in range(versions)]
    v += [(None, BASE, "lost", -1, False), ("hot", None, "lost", -2, False)]
    return (
        spark.createDataFrame(f, "n INT, k STRING, at TIMESTAMP"),
        spark.createDataFrame(v, "id STRING, since TIMESTAMP, name STRING, n INT, removed BOOLEAN"),
        f,
        [x for x in v if x[0] and x[1]],
    )


def searched(facts, versions, removed):
    out = []
    for n, key, at in facts:
        held = [v for v in versions if key and at and v[0] == key and v[1] <= at]
        last = max(held, key=lambda v: (v[1], v[3])) if held else None
        out.append((n, None if last is None or (removed and last[4]) else last[2]))
    return sorted(out)


@pytest.mark.parametrize("stretch_rows", [10_000, 40, 7])
@pytest.mark.parametrize("removed", [None, "removed"])
def test_asof_join(spark, stretch_rows, removed):
    facts, versions, f, v = made(spark, 1, 300, 90, ["a", "b", "c"])
    unique = row_versions(versions, "id", "since", ["n"])
    found = asof_join(facts, unique, **HOW, removed=removed, stretch_rows=stretch_rows)
    assert rows(found, "n", "name") == searched(f, v, removed)
    assert found.columns == ["n", "k", "at", "name"]


def test_asof_join_of_little(spark):
    facts, versions, *_ = made(spark, 2, 5, 5, ["a"])
    unique = row_versions(versions, "id", "since", ["n"])
    assert rows(asof_join(facts, unique.limit(0), **HOW), "name") == [(None,)] * 5
    assert asof_join(facts.limit(0), unique, **HOW).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        asof_join(facts, unique, on=("k", "id"), times=("at", "since"), columns={"name": "k"})


def test_valid_to_is_the_next_version(spark):
    versions = spark.createDataFrame([("a", 1, "x"), ("a", 5, "y"), ("a", 5, "z"), ("b", 2, "w")], "id STRING, since INT, name STRING")
    found = row_versions(versions, "id", "since", ["name"])
    assert rows(found, "id", "since", "name", "valid_to") == [("a", 1, "x", 5), ("a", 5, "z", None), ("b", 2, "w", None)]
