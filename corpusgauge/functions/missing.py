"""One meaning of "missing": NULL, or NaN in a floating column."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.FloatType, T.DoubleType)


def is_missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return c.isNull() | F.isnan(c) if isinstance(df.schema[name].dataType, FLOATING) else c.isNull()


def nan_as_null(df: DataFrame, name: str) -> Column:
    """The column with NaN turned to NULL, so that distinct counts and averages skip it."""
    c, kind = F.col(name), df.schema[name].dataType
    return F.nanvl(c, F.lit(None).cast(kind)) if isinstance(kind, FLOATING) else c
