"""Deterministic row keys: hashes for random order, sortable text for natural order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SIGN_BIT = -(2**63)


def hash_key(columns: Sequence[str], seed: int) -> Column:
    """md5 over the id columns and a seed: a stable pseudo-random order of the rows."""
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def row_key(df: DataFrame, seed: int) -> Column:
    """md5 over the whole row, used to separate rows that share an id."""
    return F.md5(F.concat(F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns])), F.lit(f"|{seed}")))


def _sortable(name: str, dtype: T.DataType) -> Column:
    column = F.col(name)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        number = column.cast("long")
    elif isinstance(dtype, T.DateType):
        number = F.unix_date(column).cast("long")
    elif isinstance(dtype, T.TimestampType):
        number = F.unix_micros(column)
    elif isinstance(dtype, T.BooleanType):
        number = column.cast("long")
    elif isinstance(dtype, T.TimestampNTZType):
        # no zone, so no conversion to an instant: the ISO text sorts by itself
        return F.when(column.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), column.cast("string"), F.lit("!")))
    elif isinstance(dtype, T.StringType):
        # '!' sorts before every hex digit, so a shorter text sorts before its extensions.
        return F.when(column.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.hex(F.encode(column, "UTF-8")), F.lit("!")))
    else:
        raise TypeError(f"cannot order rows by column '{name}' of type {dtype.simpleString()}")
    digits = F.lpad(F.hex(number.bitwiseXOR(F.lit(_SIGN_BIT))), 16, "0")
    return F.when(column.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), digits))


def order_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """Text whose order is the order of the columns, nulls first."""
    return F.concat(*[_sortable(name, df.schema[name].dataType) for name in columns])
