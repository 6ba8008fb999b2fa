"""First or last row per key.

Both are ``row_number() = 1`` filters.  Spark cuts each key to one row inside
every input task before the shuffle (a window group limit), so a hot key sends
one row per input task, not all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    )
    return ranked.filter("_rank = 1").drop("_rank")


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order_by])
