"""Schemas of the layers and the fixed business codes."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(16, 2)
MONEY_SUM = T.DecimalType(26, 2)
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


_TYPES = {
    "text": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "money": MONEY,
    "total": MONEY_SUM,
    "variant": T.VariantType(),
    "variants": T.ArrayType(T.VariantType()),
    "row": T.MapType(T.StringType(), T.VariantType()),
}


def _struct(**kinds: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in kinds.items()])


#: One raw click-log record.  ``start`` and each display keep every attribute
#: the client sent, so they stay semi-structured.
APP_LOG = T.StructType(
    [
        T.StructField("common", _struct(mid="text", vc="text", ch="text", ar="text", is_new="text")),
        T.StructField(
            "page",
            _struct(
                page_id="text", last_page_id="text", item="text", item_type="text",
                during_time="long",
            ),
        ),
        *_struct(start="variant", displays="variants", ts="long").fields,
    ]
)

#: A change event; ``ts`` is when the database made the change, if it is told.
CHANGE = _struct(database="text", table="text", type="text", ts="long", data="row")

#: One record of a database log reader, before it is flattened.
FEED_RECORD = _struct(op="text", before="row", after="row", ts_ms="long")

RULES = _struct(
    source_table="text", operate_type="text", sink_type="text", sink_table="text",
    sink_columns="text", sink_pk="text", sink_extend="text",
)

ORDER_INFO = _struct(
    id="long", province_id="long", order_status="text", user_id="long", total_amount="money",
    activity_reduce_amount="money", coupon_reduce_amount="money", original_total_amount="money",
    feight_fee="money", expire_time="text", create_time="text", operate_time="text",
)

ORDER_DETAIL = _struct(
    id="long", order_id="long", sku_id="long", order_price="money", sku_num="long",
    sku_name="text", create_time="text", split_total_amount="money",
    split_activity_amount="money", split_coupon_amount="money",
)

PAYMENT_INFO = _struct(
    id="long", order_id="long", user_id="long", total_amount="money", subject="text",
    payment_type="text", create_time="text", callback_time="text",
)

FAVOR_INFO = CART_INFO = _struct(sku_id="long", create_time="text")
ORDER_REFUND_INFO = _struct(
    sku_id="long", order_id="long", refund_amount="money", create_time="text"
)
COMMENT_INFO = _struct(sku_id="long", appraise="text", create_time="text")

_DIMENSION_COLUMNS = dict(
    province_name="text", province_area_code="text", province_iso_code="text",
    province_3166_2_code="text", user_age="int", user_gender="text", spu_id="long", tm_id="long",
    category3_id="long", spu_name="text", tm_name="text", category3_name="text",
)
_LINE_COLUMNS = dict(
    detail_id="long", order_id="long", sku_id="long", order_price="money", sku_num="long",
    sku_name="text", province_id="long", order_status="text", user_id="long",
    total_amount="money", activity_reduce_amount="money", coupon_reduce_amount="money",
    original_total_amount="money", feight_fee="money", split_feight_fee="money",
    split_activity_amount="money", split_coupon_amount="money", split_total_amount="money",
)

ORDER_WIDE = _struct(
    **_LINE_COLUMNS, expire_time="text", create_time="text", operate_time="text",
    create_date="text", create_hour="text", **_DIMENSION_COLUMNS,
)

PAYMENT_WIDE = _struct(
    payment_id="long", subject="text", payment_type="text", payment_create_time="text",
    callback_time="text", **_LINE_COLUMNS, order_create_time="text", **_DIMENSION_COLUMNS,
)

#: The statistics tables as reports read them.
STATS = {
    "visitor_stats": _struct(
        stt="text", edt="text", vc="text", ch="text", ar="text", is_new="text", uv_ct="long",
        pv_ct="long", sv_ct="long", uj_ct="long", dur_sum="long",
    ),
    "product_stats": _struct(
        stt="text", edt="text", sku_id="long", sku_name="text", sku_price="money", spu_id="long",
        spu_name="text", tm_id="long", tm_name="text", category3_id="long", category3_name="text",
        display_ct="long", click_ct="long", favor_ct="long", cart_ct="long", order_sku_num="long",
        order_amount="total", order_ct="long", payment_amount="total", paid_order_ct="long",
        refund_order_ct="long", refund_amount="total", comment_ct="long", good_comment_ct="long",
    ),
    "province_stats": _struct(
        stt="text", edt="text", province_id="long", province_name="text",
        province_area_code="text", province_iso_code="text", province_3166_2_code="text",
        order_amount="total", order_count="long",
    ),
    "keyword_stats": _struct(keyword="text", ct="long", source="text", stt="text", edt="text"),
}
VISITOR_STATS, PRODUCT_STATS, PROVINCE_STATS, KEYWORD_STATS = (
    tuple(schema.fieldNames()) for schema in STATS.values()
)

# Business codes, by group.
CODES = {
    "order_status": {
        "1001": "unpaid", "1002": "paid", "1003": "cancelled",
        "1004": "finished", "1005": "refunding", "1006": "refunded",
    },
    "payment_type": {"1101": "alipay", "1102": "wechat", "1103": "unionpay"},
    "appraise": {"1201": "bad", "1202": "soso", "1203": "good", "1204": "auto"},
    "refund_reason": {
        "1301": "bad goods", "1302": "wrong description", "1303": "sold out",
        "1304": "size issue", "1305": "mistake", "1306": "no reason", "1307": "other",
    },
    "coupon_status": {"1401": "unused", "1402": "using", "1403": "used"},
    "refund_type": {"1501": "money only", "1502": "with goods"},
    "source_type": {
        "2401": "query", "2402": "promotion", "2403": "auto recommend", "2404": "activity",
    },
    "coupon_range": {"3301": "category3", "3302": "trademark", "3303": "spu"},
    "coupon_type": {"3201": "full reduction", "3202": "full discount", "3203": "voucher"},
    "activity_rule": {"3101": "full reduction", "3102": "full discount", "3103": "discount"},
}
APPRAISE_GOOD = "1203"

# Weight of one keyword hit, by where it came from.
KEYWORD_WEIGHTS = {"SEARCH": 10, "ORDER": 3, "CART": 2, "CLICK": 1}
