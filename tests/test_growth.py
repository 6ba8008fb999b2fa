"""Steps whose cost must not grow faster than their input."""

from __future__ import annotations

import datetime as dt
import json
import re

import pandas as pd
from pyspark.sql import functions as F

from streammart.functions.text import PIECE, _pieces, words
from streammart.operators import skew
from streammart.operators.joins import interval_join
from streammart.plans.product_stats import with_product_dims
from streammart.workload import queries as q
from streammart.workload import roles
from streammart.workload.streams import Run

SMALL = "/root/testdata/sf0.001"


def test_statistics_are_computed_once_whatever_the_size_of_the_dimension(spark, monkeypatch):
    wide = q.province_wide(spark, SMALL)
    stats = q.product_measures([q.order_rows(wide)], "1 day")
    expected = sorted(map(tuple, with_product_dims(stats, roles.dims(spark, SMALL), small=True).collect()))
    searched = []
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(skew, "hot_keys", lambda *a, **k: searched.append(a) or [])
    named = with_product_dims(stats, roles.dims(spark, SMALL))
    assert not searched and sorted(map(tuple, named.collect())) == expected


def test_joined_lines_lie_by_their_order(spark):
    """Neither a grouping by order nor a second join by order moves the joined rows again."""
    orders = spark.range(5000).select(F.col("id").alias("order"), F.timestamp_seconds("id").alias("t"))
    lines = spark.range(20000).select((F.col("id") % 5000).alias("of"), F.timestamp_seconds(F.col("id") % 5000).alias("lt"), "id")
    pairs = interval_join(orders, lines, ("order", "of"), ("t", "lt"), "-5 seconds", "5 seconds", hot=[])
    assert pairs.columns == ["order", "t", "of", "lt", "id"]
    counted = pairs.groupBy("order", "lt").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2, plan
    assert counted.count() == 5000 and counted.filter("count != 4").count() == 0


def test_stream_join_runs_once_per_query(spark, monkeypatch):
    """The stream of wide lines is written once, and read by the payments and by the statistics."""
    from streammart.workload import streams

    ran = []
    finish = Run.finish
    monkeypatch.setattr(Run, "finish", lambda self, *a, **k: ran.append(1) or finish(self, *a, **k))
    streams.stream_product_stats(spark, SMALL)
    assert len(ran) == 3


def test_a_worker_cuts_texts_in_pieces(spark):
    texts = pd.Series(["a" * 3, None, "b" * 3, "", "c" * 9, "d"])
    assert [list(p) for p in _pieces(texts, 6)] == [["aaa", None, "bbb", ""], ["c" * 9], ["d"]]
    assert [len(p) for p in _pieces(pd.Series([], dtype=object))] == [0]
    some = ["the mit license " * 2000] * 30 + [None, ""]
    assert sum(len(t or "") for t in some) > 2 * PIECE
    df = spark.createDataFrame([(k, t) for k, t in enumerate(some)], "n INT, s STRING").coalesce(1)
    for smart in (False, True):
        cut = df.select("n", words("s", ["mit license"], smart).alias("w")).collect()
        assert {r["n"]: r["w"] for r in cut} == {**{k: ["the", "mit license"] * 2000 for k in range(30)}, 30: None, 31: []}


def test_day_reports_leave_the_lines_where_they_are(spark, monkeypatch, tmp_path):
    """Only the orders of the day meet the lines, so no line is shuffled by its order; a large day still is."""
    head = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ"
    day = [dt.datetime(1997, 5, 28), dt.datetime(1997, 5, 28, 23, 59, 59), dt.datetime(1997, 5, 29), dt.datetime(1997, 5, 27, 23, 59, 59), None]
    orders = [(k % 17, k % 3 or None, "F", 10.0 + k, day[k % 5]) for k in range(40)]
    line = "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_shipdate TIMESTAMP_NTZ"
    lines = [(k % 19 or None, k % 4, k % 6 or None, 1.0, 2.0, day[k % 4]) for k in range(90)]
    tables = {"orders": (orders, head), "lineitem": (lines, line), "customer": ([(1, 7), (1, 8), (2, 9), (None, 5)], "c_custkey BIGINT, c_nationkey INT")}
    for name, (given, schema) in tables.items():
        spark.createDataFrame(given, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    stats = lambda wide: q.product_measures([q.order_rows(wide)], "1 day")
    of_day = lambda wide, d: sorted(map(tuple, q.reports.on_day(stats(wide), d).collect()))
    days = [q.ORDER_DAY, 19970529, 19000101]
    whole = [of_day(q._wide(spark, str(tmp_path), **q.ANY_TIME), d) for d in days]
    assert whole[0] and whole[1] and not whole[2]
    for limit in (skew.BROADCAST_BYTES, -1):
        monkeypatch.setattr(skew, "fits_broadcast", lambda df, limit=limit: skew.content_bytes(df) <= limit)
        for d, expected in zip(days, whole):
            wide = q._wide_on(spark, str(tmp_path), d)
            plan = wide._jdf.queryExecution().executedPlan().toString()
            assert ("SortMergeJoin" in plan) == (limit < 0), plan
            assert of_day(wide, d) == sorted(map(tuple, stats(wide).collect())) == expected


def test_topic_files_can_be_read_by_many_tasks(spark, tmp_path):
    """A topic's file has parts of a few MB of values, so one file does not mean one task."""
    import pyarrow.parquet as pq

    from streammart.sources.topics import ROW_GROUP, Topics

    topics = Topics(root=str(tmp_path))
    value = F.concat_ws("-", *[F.xxhash64("id", F.lit(k)) for k in range(12)])
    topics.put(spark.range(150_000).select(F.lit("t").alias("topic"), value.alias("value")), "s")
    groups = [pq.ParquetFile(f).metadata.num_row_groups for f in tmp_path.rglob("topic=t/**/*.parquet")]
    assert ROW_GROUP < 16 << 20 and sum(groups) > len(groups) and topics.read(spark, "t", streaming=False).count() == 150_000


def test_no_day_report_looks_through_the_lines_for_their_orders(spark, monkeypatch, tmp_path):
    """The five registered reports (F15-F19): no search for hot orders, no merge join, and the rows counted by hand."""
    first = dt.datetime(1997, 5, 28)
    orders = [(k, k % 4, "F", 10.5 + k, first + dt.timedelta(hours=9 * (k % 6 - 1))) for k in range(30)] + [(30, 1, "F", 7.0, None)]
    lines = [(k % 32, k % 3, k % 7, 1.0, 2.0, first) for k in range(100)] + [(4, 1, None, 1.0, 2.0, first), (None, 1, 1, 1.0, 2.0, first)]
    parts = [(k, f"part {k}", f"Brand#{k % 3}", "LARGE", k % 2, 9.0) for k in range(6)]
    tables = {
        "orders": (orders, "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ"),
        "lineitem": (lines, "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_shipdate TIMESTAMP_NTZ"),
        "part": (parts, "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"),
        "customer": ([(k, k % 2, 1.0, "A") for k in range(3)], "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"),
        "nation": ([(0, "n", 0)], "n_nationkey INT, n_name STRING, n_regionkey INT"),
        "region": ([(0, "r")], "r_regionkey INT, r_name STRING"),
    }
    for name, (given, schema) in tables.items():
        spark.createDataFrame(given, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    searched = []
    for module in (skew, q):
        monkeypatch.setattr(module, "hot_keys", lambda *a, **k: searched.append(a) or [])
    found = {}
    for name in ("report_spu", "report_trademark", "report_chart_spu", "report_chart_trademark", "report_gmv_empty_day"):
        report = q.QUERIES[name](spark, str(tmp_path))
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert not searched and "SortMergeJoin" not in plan, (name, plan)
        found[name] = [tuple(r) for r in report.collect()]

    total = {k: price for k, _, _, price, at in orders if at and at.date() == first.date()}
    sold = [(sku, order) for order, _, sku, *_ in lines if order in total and sku is not None]

    def top(key, label):
        """By key: amounts, and different orders of every sku; skus without a part have no key."""
        of = lambda sku: (key(sku), label(key(sku))) if sku < len(parts) else (None, None)
        ranked = [(*g, sum(total[o] for s, o in sold if of(s) == g), len({x for x in sold if of(x[0]) == g})) for g in {of(s) for s, _ in sold}]
        return sorted(ranked, key=lambda r: -r[2])

    spu, brand = top(lambda s: s % 2, "size {}".format), top(lambda s: s % 3, "Brand#{}".format)
    assert len(total) == 15 and len({r[2] for r in spu}) == len(spu) == 3 and len({r[2] for r in brand}) == len(brand) == 4
    assert found["report_spu"] == spu and found["report_trademark"] == [r[:3] for r in brand]
    assert found["report_gmv_empty_day"] == [(0.0,)]
    kept = lambda row, **names: {n: v for n, v in zip(names, (row[i] for i in names.values())) if v is not None}
    data = lambda name: json.loads(found[name][0][0])["data"]
    assert data("report_chart_spu")["rows"] == [kept(r, spu_name=1, order_amount=2, order_ct=3) for r in spu]
    assert data("report_chart_trademark")["series"] == [{"name": "order_amount", "data": [r[2] for r in brand]}]


def test_statistics_are_made_where_they_meet_a_large_dimension(spark, monkeypatch, tmp_path):
    """no row of the statistics moves for the join by sku; hot skus are measured apart; the rows stay the same."""
    at = lambda k: dt.datetime(1997, 5, 27) + dt.timedelta(hours=7 * (k % 9))
    orders = [(k % 23 or None, k % 4, "FOP"[k % 3], 10.5 + k, at(k), "2-HIGH") for k in range(30)]
    lines = [(k % 25 or None, k % 3, 5 if k % 2 else k % 7 or None, 1.0, 2.0 + k, "RN"[k % 2], at(k // 2)) for k in range(160)]
    events = [(k, at(k), k % 5, ("click", "view", "signup", "error")[k % 4], 1.5, f'{{"k": {k % 6}}}') for k in range(60)]
    tables = {
        "orders": (orders, "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
        "lineitem": (lines, "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_returnflag STRING, l_shipdate TIMESTAMP_NTZ"),
        "events": (events, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"),
        "part": ([(k, f"part {k}", f"Brand#{k % 3}", "LARGE", k % 2, 9.0) for k in range(6)], "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"),
        "customer": ([(k, k % 2, 1.0, "A") for k in range(3)], "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"),
        "nation": ([(0, "n", 0)], "n_nationkey INT, n_name STRING, n_regionkey INT"),
        "region": ([(0, "r")], "r_regionkey INT, r_name STRING"),
    }
    for name, (given, schema) in tables.items():
        spark.createDataFrame(given, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    made = lambda: sorted((tuple(r) for r in q.products(spark, str(tmp_path)).collect()), key=str)
    expected = made()
    assert len(expected) >= 20
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    monkeypatch.setitem(skew.lookup_join.__globals__, "fits_broadcast", lambda df: False)
    plan = q.products(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and not re.search(r"Exchange hashpartitioning\(sku_id#\d+L?, \d+\), ENSURE", plan), plan
    assert made() == expected
    # Sku 5 has half of all lines.
    monkeypatch.setattr(q, "hot_keys", lambda df, keys, **how: [(5, 2)] if keys == ["l_partkey"] else [])
    assert made() == expected and {r[2] for r in expected} >= {5, 1}


def test_long_decimals_move_in_eight_bytes(spark, tmp_path):
    """sums of money cross a shuffle as short decimals, and come out as they were."""
    from decimal import Decimal

    from streammart.functions.decimals import moved
    from streammart.sources.tables import write_stats

    values = [None, "0.00", "-12.34", "9999999999999999.99", "-9999999999999999.99", "10000000000000000.00", "123456789012345678901234.56", "-123456789012345678901234.56"]
    given = [(f"2024-01-0{1 + k % 3} 00:00:00", k, None if v is None else Decimal(v), Decimal(k)) for k, v in enumerate(values)]
    df = spark.createDataFrame(given, "stt STRING, n INT, a DECIMAL(26,2), b DECIMAL(16,2)")
    seen = []
    out = moved(df, lambda rows: seen.append(rows) or rows.repartition(3, "n"))
    assert out.schema == df.schema and sorted(map(tuple, out.collect()), key=lambda r: r[1]) == given
    assert all(f.dataType.precision <= 18 for f in seen[0].schema.fields if f.dataType.typeName() == "decimal")
    assert seen[0].filter("_large_a IS NOT NULL").count() == 3
    assert moved(df.drop("a"), lambda rows: rows).columns == ["stt", "n", "b"]
    write_stats(df, f"{tmp_path}/stats")
    back = spark.read.parquet(f"{tmp_path}/stats")
    assert back.columns == [*df.columns, "dt"] and dict(back.dtypes)["a"] == "decimal(26,2)"
    assert sorted((tuple(r)[:4] for r in back.collect()), key=lambda r: r[1]) == given
