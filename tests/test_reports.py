import json
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from streammart.plans import charts, reports
from streammart.sources.tables import query, write_stats

DAY = 20240131


def products(spark, *data):
    return spark.createDataFrame(
        [("2024-01-31 10:00:00", *d) for d in data] + [("2024-02-01 00:00:00", 9, "other", Decimal(99), 1)],
        "stt STRING, tm_id INT, tm_name STRING, order_amount DECIMAL(16,2), order_ct BIGINT",
    )


def test_gmv(spark):
    df = products(spark, (1, "a", Decimal(5), 1), (2, "b", Decimal("0.50"), 1))
    assert rows(reports.gmv(df, DAY)) == [(Decimal("5.50"),)]
    assert rows(reports.gmv(df, 20200101)) == [(Decimal("0.00"),)]


def test_only_positive_amounts_are_ranked(spark):
    df = products(spark, (1, "a", Decimal(5), 1), (2, "b", Decimal(0), 1), (3, "c", Decimal(-1), 1))
    assert rows(reports.by_trademark(df, DAY)) == [(1, "a", Decimal("5.00"))]


def test_top_n_is_one_ordered_limit(spark):
    df = products(spark, *[(i, str(i), Decimal(i), 1) for i in range(1, 8)])
    top = reports.by_trademark(df, DAY, limit=3)
    assert [r["tm_id"] for r in top.collect()] == [7, 6, 5]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def visitors(spark, *data):
    return spark.createDataFrame(
        list(data),
        "stt STRING, is_new STRING, uv_ct BIGINT, pv_ct BIGINT, sv_ct BIGINT, uj_ct BIGINT, dur_sum BIGINT",
    )


def test_ratios(spark):
    df = visitors(spark, ("2024-01-31 05:00:00", "1", 3, 20, 8, 1, 100397),
                  ("2024-01-31 05:00:00", "0", 0, 0, 0, 0, 0))
    out = reports.with_ratios(reports.by_visitor_flag(df, DAY))
    assert rows(out, "is_new", "uj_rate", "dur_per_sv", "pv_per_sv") == [
        ("0", Decimal(0), Decimal(0), Decimal(0)),
        ("1", Decimal("12.50"), Decimal("12.6"), Decimal("2.50")),
    ]
    table = reports.new_versus_old(df, DAY)
    assert rows(table, "line", "type", "new", "old")[2] == (
        2, "bounce_rate", Decimal("12.50"), Decimal("0.00"))


def test_hours(spark):
    df = visitors(spark, ("2024-01-31 05:10:00", "1", 2, 3, 1, 0, 0),
                  ("2024-01-31 05:20:00", "0", 1, 1, 1, 0, 0))
    assert rows(reports.by_hour(df, DAY), "hr", "uv_ct", "new_uv") == [(5, 3, 2)]
    dense = rows(reports.all_hours(df, DAY))
    assert len(dense) == 24 and dense[5] == ("05", 3, 4, 2)
    assert all(r[1:] == (0, 0, 0) for r in dense if r[0] != "05")


def test_keywords_rank_by_plain_count(spark):
    df = spark.createDataFrame(
        [("2024-01-31 01:00:00", "a", 1, "SEARCH"), ("2024-01-31 02:00:00", "a", 5, "CLICK"),
         ("2024-01-31 03:00:00", "b", 2, "SEARCH"), ("2024-01-31 03:00:00", "c", 1, "?")],
        "stt STRING, keyword STRING, ct BIGINT, source STRING",
    )
    found = [tuple(r) for r in reports.by_keyword(df, DAY).collect()]
    assert found == [("a", 15), ("b", 20), ("c", 0)]


def test_day_partition_is_selected(spark, tmp_path):
    path = str(tmp_path / "stats")
    write_stats(products(spark, (1, "a", Decimal(5), 1)), path)
    day = reports.on_day(spark.read.parquet(path), DAY)
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "PushedFilters: [IsNotNull(stt)" in plan
    assert day.count() == 1


def test_charts(spark):
    df = products(spark, (1, "a", Decimal(5), 2), (2, "b", Decimal(7), 1))
    top = reports.by_trademark(df, DAY)

    def data(chart):
        document = json.loads(chart.first()["chart"])
        assert document["status"] == 0
        return document["data"]

    assert data(charts.name_values(top, "tm_name", "order_amount")) == [
        {"name": "b", "value": 7.0}, {"name": "a", "value": 5.0}
    ]
    assert data(charts.map_values(top, "tm_name", "order_amount"))["mapData"][0]["name"] == "a"
    assert data(charts.series(top, "tm_name", ["order_amount"], [F.col("tm_name")])) == {
        "categories": ["a", "b"], "series": [{"name": "order_amount", "data": [5.0, 7.0]}]
    }
    assert data(charts.table(top, {"tm_name": "Name"}, [F.col("tm_id")])) == {
        "columns": [{"name": "Name", "id": "tm_name"}], "rows": [{"tm_name": "a"}, {"tm_name": "b"}]
    }
    assert data(charts.single(reports.gmv(df, DAY), "gmv")) == 12.0


def test_a_report_of_any_size_is_written_as_rows(spark):
    report = spark.range(20_000).select(F.col("id").cast("string").alias("n"), F.col("id").alias("v"))
    out = charts.as_rows(report, "n", "v")
    assert out.count() == 20_000 and out.first()["value"] == 19_999


def test_sql_over_tables(spark):
    out = query(spark, "SELECT count(*) AS n FROM {t}", t=spark.range(3))
    assert rows(out) == [(3,)]
