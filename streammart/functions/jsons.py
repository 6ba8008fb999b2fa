"""Reading and rewriting JSON text with Spark's variant type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(value: Column | str, schema: T.StructType) -> Column:
    """JSON text as a struct; null where it is not a JSON object of that shape.

    Scalars are converted as a cast would: ``"4000"`` reads as a number.
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.try_variant_get(F.try_parse_json(column), "$", schema.simpleString())


def parse_rows(
    df: DataFrame, schema: T.StructType, value: str = "value", on_error: str = "quarantine"
) -> DataFrame:
    """Add the fields of ``schema`` read from ``value``.

    ``on_error="fail"`` stops the job at the first bad row.  ``"quarantine"``
    adds a boolean ``dirty`` column to split on with :func:`split_dirty`.
    """
    row = typed(value, schema)
    if on_error == "fail":
        row = F.coalesce(
            row, F.raise_error(F.concat(F.lit("not a JSON record: "), F.col(value)))
        )
    elif on_error != "quarantine":
        raise ValueError(f"on_error is {on_error!r}")
    fields = [F.col("_row")[name].alias(name) for name in schema.fieldNames()]
    flag = [F.col("_row").isNull().alias("dirty")] if on_error == "quarantine" else []
    return once(df, row, "_row").select(*[F.col(c) for c in df.columns], *fields, *flag)


def once(df: DataFrame, expensive: Column, name: str) -> DataFrame:
    """Add a column that is computed exactly once per row.

    As the output of a generator it is not copied into the filters and columns
    that use it later, which the optimizer does with a plain column.
    """
    return df.select("*", F.explode(F.array(expensive)).alias(name))


def split_dirty(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the rows to keep aside."""
    return df.filter(~F.col("dirty")).drop("dirty"), df.filter("dirty").drop("dirty")


def keep_fields(row: Column, names: Column) -> Column:
    """The fields of an object, a map of variants, that are named in an array.

    Numbers stay numbers.
    """
    return F.map_filter(row, lambda name, _: F.array_contains(names, name))


def put_field(variant: Column, name: str, value: Column) -> Column:
    """The object, as a map, with one field added or replaced."""
    fields = F.try_variant_get(variant, "$", "map<string,variant>")
    others = F.map_filter(fields, lambda key, _: key != F.lit(name))
    return F.map_concat(others, F.create_map(F.lit(name), value.cast("variant")))


def as_value(df: DataFrame, *keep: str) -> DataFrame:
    """Encode all other columns as one JSON text column ``value``."""
    rest = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.to_json(F.struct(*rest)).alias("value"))


def camel_case(df: DataFrame) -> DataFrame:
    """Rename ``snake_case`` columns to ``camelCase``."""
    def renamed(name: str) -> str:
        head, *tail = name.split("_")
        return head + "".join(part.capitalize() for part in tail)

    return df.withColumnsRenamed({name: renamed(name) for name in df.columns})
