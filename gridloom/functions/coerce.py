"""Cell-level coercion expressions; all are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell texts that a CSV scan reads as missing.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "n/a",
    "nan",
    "null",
)

# Accepted boolean spellings.
TRUE_SPELLINGS = ("True", "true", "1")
FALSE_SPELLINGS = ("False", "false", "0")

# Texts a numeric parse accepts. Spark's cast also takes Java suffixes ('1d', '2f'), which are not numbers here.
NUMERIC_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"

_FLOATING = (T.FloatType, T.DoubleType)


def blank_to_null(column: Column) -> Column:
    """Null tokens of a text scan become NULL."""
    return F.when(~column.isin(*NULL_TOKENS), column)


def nan_to_null(column: Column) -> Column:
    """NaN becomes NULL so that aggregates skip it."""
    return F.when(~F.isnan(column), column)


def to_category(column: Column, dtype: T.DataType) -> Column:
    """Text of the value; the literal text ``nan`` is missing."""
    if isinstance(dtype, _FLOATING):
        column = nan_to_null(column)
    if isinstance(dtype, T.BooleanType):
        return F.when(column, F.lit("True")).when(~column, F.lit("False"))
    return F.nullif(column.cast("string"), F.lit("nan"))


def to_boolean(column: Column, dtype: T.DataType, missing: str = "null") -> Column:
    """Map the accepted spellings; everything else is missing.

    ``missing='true'`` turns missing into TRUE, the other known reading of this cast.
    """
    if missing not in ("null", "true"):
        raise ValueError("missing must be 'null' or 'true'")
    if isinstance(dtype, T.BooleanType):
        mapped = column
    elif isinstance(dtype, T.NumericType):
        mapped = F.when(column == 1, F.lit(True)).when(column == 0, F.lit(False))
    else:
        text = column.cast("string")
        mapped = F.when(text.isin(*TRUE_SPELLINGS), F.lit(True)).when(text.isin(*FALSE_SPELLINGS), F.lit(False))
    return F.coalesce(mapped, F.lit(True)) if missing == "true" else mapped


def to_number(column: Column, dtype: T.DataType) -> Column:
    """DOUBLE; text that is not a number becomes NULL, and so does NaN."""
    if isinstance(dtype, T.StringType):
        return F.when(column.rlike(NUMERIC_TEXT), column.try_cast("double"))
    if isinstance(dtype, _FLOATING):
        return nan_to_null(column.cast("double"))
    return column.cast("double")


def is_unparsable(column: Column) -> Column:
    """TRUE for present text that no numeric parse accepts."""
    return column.isNotNull() & ~column.rlike(NUMERIC_TEXT)
