"""The batch warehouse against the same results computed directly."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streammart.plans.warehouse import REPORTS, Batch
from streammart.workload import queries, roles

SF = "/root/testdata/sf0.001"
YEAR = "1997%"


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    b = Batch(spark, str(tmp_path_factory.mktemp("batch")), size="1 day")
    b.split_log(roles.raw_app_log(spark, SF), ["ts", "src_offset"])
    b.visits("src_offset", queries.BOUNCE)
    # one year of orders and returns keeps the number of day folders low
    b.put("order_info", roles.orders(spark, SF).filter(f"create_date LIKE '{YEAR}'"))
    b.put("order_detail", roles.details(spark, SF))
    b.put("payment_info", roles.payments(spark, SF))
    for name, kind in (("favor_info", "signup"), ("cart_info", "view"), ("comment_info", "error")):
        b.put(name, roles.product_events(spark, SF, kind))
    refunds = roles.refunds(spark, SF).filter(F.year("event_time") == int(YEAR[:4]))
    b.put("order_refund_info", refunds)
    dims = roles.dims(spark, SF)
    as_of = F.lit(queries.AGE_AS_OF).cast("timestamp")
    b.wide_orders(dims, as_of, **queries.ANY_TIME)
    b.wide_payments(lower="-15 days")
    b.statistics(dims)
    return b


def test_layers_have_every_row(spark, batch):
    raw = roles.raw_app_log(spark, SF)
    assert batch.table("dwd_log").count() + batch.table("dwd_dirty").count() == raw.count()
    start = batch.table("dwd_log").filter("kind = 'start'")
    assert start.count() == queries.log_split_start(spark, SF).count()
    assert batch.table("dwd_display").count() == queries.log_explode_display(spark, SF).count()
    wide = queries.order_wide_full(spark, SF).join(
        batch.table("order_info"), F.col("order_id") == F.col("id"), "left_semi")
    assert rows(batch.table("dwm_order_wide"), "order_id", "detail_id", "user_age") == rows(
        wide, "order_id", "detail_id", "user_age")
    paid = queries.payment_wide_all(spark, SF).filter(f"order_create_time LIKE '{YEAR}'")
    assert rows(batch.table("dwm_payment_wide"), "order_id", "detail_id") == rows(
        paid, "order_id", "detail_id")


def test_invariants(batch):
    total = batch.table("visitor_stats").agg(
        *[F.sum(c).alias(c) for c in ("uv_ct", "pv_ct", "sv_ct", "uj_ct")]).first()
    assert total["pv_ct"] == batch.pages().count()
    assert 0 < total["uv_ct"] <= total["sv_ct"] <= total["pv_ct"]
    assert total["uj_ct"] <= total["sv_ct"]


def test_statistics_and_reports(spark, batch):
    direct = queries.province_stats_day(spark, SF).filter(f"stt LIKE '{YEAR}'")
    stored = batch.table("province_stats").withColumn("order_amount", F.col("order_amount").cast("double"))
    assert rows(stored.select(*direct.columns)) == rows(direct)
    day = int(batch.table("product_stats").agg(F.max("dt")).first()[0].strftime("%Y%m%d"))
    for name, (source, _) in REPORTS.items():
        out = batch.report(name, day if source != "visitor_stats" else queries.VISIT_DAY)
        out.collect()
        document = json.loads(batch.chart(name, day).first()["chart"])
        assert document["status"] == 0 and "data" in document
    assert batch.report("hr", queries.VISIT_DAY).count() == 24
    amount = batch.table("province_stats").agg(F.sum("order_amount")).first()[0]
    wide = batch.table("dwm_order_wide").agg(F.sum("split_total_amount")).first()[0]
    assert amount == wide
