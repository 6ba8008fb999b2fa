"""Order lines joined with their order and all dimensions, and their payments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streammart.functions.times import age_years
from streammart.operators.joins import enrich, interval_join
from streammart.schemas import MONEY, ORDER_WIDE, PAYMENT_WIDE


@dataclass(frozen=True)
class Dims:
    """Dimension tables.  Columns as stored by the dimension sink:

    ``user``: id, birthday, gender; ``province``: id, name, area_code, iso_code,
    iso_3166_2; ``sku``: id, sku_name, price, spu_id, tm_id, category3_id;
    ``spu``: id, spu_name; ``trademark``: id, tm_name; ``category3``: id, name.
    """

    user: DataFrame
    province: DataFrame
    sku: DataFrame
    spu: DataFrame
    trademark: DataFrame
    category3: DataFrame

    def flat_sku(self) -> DataFrame:
        """The sku table with the names its keys lead to.

        The chain sku -> spu / trademark / category3 is resolved among the
        dimensions, so that facts are joined once instead of four times.
        """
        sku = self.sku.select(
            F.col("id").try_cast("bigint").alias("id"),
            F.col("sku_name"),
            F.col("price").cast(MONEY).alias("sku_price"),
            *[F.col(c).try_cast("bigint").alias(c) for c in ("spu_id", "tm_id", "category3_id")],
        )
        for key, dim, name in (
            ("spu_id", self.spu, F.col("spu_name")),
            ("tm_id", self.trademark, F.col("tm_name")),
            ("category3_id", self.category3, F.col("name").alias("category3_name")),
        ):
            named = dim.select(F.col("id").try_cast("bigint").alias("_id"), name)
            sku = sku.join(named, F.col(key) == F.col("_id"), "left").drop("_id")
        return sku


def join_order_lines(
    orders: DataFrame,
    details: DataFrame,
    lower: str = "-5 seconds",
    upper: str = "5 seconds",
    hot: list[tuple] | None = None,
    small: bool | None = False,
) -> DataFrame:
    """Each order line with its order, one wide row per line.

    ``orders`` and ``details`` have an ``event_time`` and, for orders,
    ``create_date`` and ``create_hour``.  Amounts the feeds do not carry stay
    null, as do the dimension columns, which :func:`with_dimensions` fills.
    ``small=None`` is for orders that may be few, such as those of one day.
    """
    order = orders.select(
        F.col("id").alias("order_id"),
        *_present(
            orders,
            "province_id", "order_status", "user_id", "total_amount", "activity_reduce_amount",
            "coupon_reduce_amount", "original_total_amount", "feight_fee", "create_time",
            "create_date", "create_hour",
        ),
        F.col("event_time"),
    )
    detail = details.select(
        F.col("id").alias("detail_id"),
        F.col("order_id").alias("_detail_order"),
        *_present(
            details,
            "sku_id", "order_price", "sku_num", "sku_name", "split_activity_amount",
            "split_coupon_amount", "split_total_amount",
        ),
        F.col("event_time").alias("_detail_time"),
    )
    pairs = interval_join(
        order,
        detail,
        on=("order_id", "_detail_order"),
        times=("event_time", "_detail_time"),
        lower=lower,
        upper=upper,
        hot=hot,
        small=small,
    )
    return _shaped(pairs, ORDER_WIDE)


def with_user(
    wide: DataFrame, user: DataFrame, as_of: Column | None = None, small: bool | None = None
) -> DataFrame:
    """Fill age and gender.  ``as_of`` is the moment ages refer to, now by default."""
    person = user.select(
        F.col("id").try_cast("bigint").alias("id"),
        age_years("birthday", F.current_timestamp() if as_of is None else as_of).alias("age"),
        "gender",
    )
    names = {"age": "user_age", "gender": "user_gender"}
    return enrich(wide, person, {"user_id": "id"}, names, small).select(*wide.columns)


def with_province(wide: DataFrame, province: DataFrame, small: bool | None = None) -> DataFrame:
    """Fill the province's name and codes."""
    place = province.withColumn("id", F.col("id").try_cast("bigint"))
    names = {
        "name": "province_name",
        "area_code": "province_area_code",
        "iso_code": "province_iso_code",
        "iso_3166_2": "province_3166_2_code",
    }
    return enrich(wide, place, {"province_id": "id"}, names, small).select(*wide.columns)


def with_product(wide: DataFrame, dims: Dims, small: bool | None = None) -> DataFrame:
    """Fill the product's names and keys; the dimension's sku name comes first."""
    columns = ("sku_name", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name",
               "category3_name")
    joined = enrich(wide, dims.flat_sku(), {"sku_id": "id"}, {c: c for c in columns}, small)
    return joined.select(*wide.columns)


def with_dimensions(
    wide: DataFrame,
    dims: Dims,
    as_of: Column | None = None,
    small: dict[str, bool] | None = None,
) -> DataFrame:
    """Fill all dimension columns; a missing dimension row leaves nulls.

    ``small`` tells for ``user``, ``province`` and ``sku`` whether the table is
    known to be small or known not to be; sizes are measured otherwise.
    """
    small = small or {}
    out = with_user(wide, dims.user, as_of, small.get("user"))
    out = with_province(out, dims.province, small.get("province"))
    return with_product(out, dims, small.get("sku"))


def join_payments(
    payments: DataFrame,
    wide: DataFrame,
    lower: str = "-15 minutes",
    upper: str = "0 seconds",
    hot: list[tuple] | None = None,
) -> DataFrame:
    """Each payment with the wide lines of its order.

    A line is kept when its order is at most ``-lower`` older than the payment.
    Where both carry a column (order, user, total amount) the payment's wins.
    """
    payment = payments.select(
        F.col("id").alias("payment_id"),
        F.col("order_id").alias("_paid_order"),
        F.col("user_id").alias("_paid_user"),
        F.col("total_amount").alias("_paid_total"),
        *_present(payments, "subject", "payment_type", "callback_time"),
        F.col("create_time").alias("payment_create_time"),
        F.col("event_time").alias("_payment_time"),
    )
    line = wide.withColumnsRenamed({"create_time": "order_create_time"})
    pairs = interval_join(
        payment,
        line,
        on=("_paid_order", "order_id"),
        times=("_payment_time", "event_time"),
        lower=lower,
        upper=upper,
        hot=hot,
    )
    merged = pairs.withColumns(
        {
            "order_id": F.col("_paid_order"),
            "user_id": F.col("_paid_user"),
            "total_amount": F.col("_paid_total"),
        }
    ).drop("event_time")
    return _shaped(merged.withColumnRenamed("_payment_time", "event_time"), PAYMENT_WIDE)


def merge_wide(left: DataFrame, right: DataFrame, on: str = "detail_id") -> DataFrame:
    """Two versions of the same wide rows, value by value the first that is not null."""
    other = right.select(*[F.col(c).alias(f"_other_{c}") for c in right.columns])
    joined = left.join(other, F.col(on) == F.col(f"_other_{on}"), "left")
    return joined.select(
        *[
            F.coalesce(F.col(c), F.col(f"_other_{c}")).alias(c) if c in right.columns else F.col(c)
            for c in left.columns
        ]
    )


def _present(df: DataFrame, *names: str) -> list[Column]:
    return [F.col(n) for n in names if n in df.columns]


def _shaped(df: DataFrame, schema) -> DataFrame:
    """The columns of a schema, null where absent, and the event time."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()})"
            f" AS {f.name}"
            for f in schema.fields
        ],
        "event_time",
    )
