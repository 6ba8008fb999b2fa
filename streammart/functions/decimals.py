"""Decimals on their way through a shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most digits Spark holds in eight bytes; a longer type takes twenty-four in every row, whatever the value.
SHORT = 18


def moved(df: DataFrame, move: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``move(df)``, a shuffle, with long decimals in eight bytes; the few that do not fit go as text."""
    large = lambda name: f"_large_{name}"
    long = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, T.DecimalType) and f.dataType.precision > SHORT}
    if not long:
        return move(df)
    short = {n: F.col(n).try_cast(T.DecimalType(SHORT, min(t.scale, SHORT))) for n, t in long.items()}
    exact = {n: F.when(short[n].cast(t) == F.col(n), short[n]) for n, t in long.items()}
    rest = {large(n): F.when(exact[n].isNull(), F.col(n).cast("string")) for n in long}
    there = move(df.select(*[exact[c].alias(c) if c in long else F.col(c) for c in df.columns], *[c.alias(n) for n, c in rest.items()]))
    whole = {n: F.coalesce(F.col(n).cast(t), F.col(large(n)).cast(t)) for n, t in long.items()}
    return there.select(*[whole[c].alias(c) if c in long else F.col(c) for c in df.columns])
