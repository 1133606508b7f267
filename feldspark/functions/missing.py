"""One rule for missing values: NaN in a float column counts as missing, like NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL; other types pass unchanged."""
    c = F.col(f"`{name}`")
    return F.when(~F.isnan(c), c) if is_float(df, name) else c


def number(df: DataFrame, name: str) -> Column:
    """``present`` as a double, the type all statistics are computed in."""
    return present(df, name).cast("double")


def is_missing(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    return (c.isNull() | F.isnan(c)) if is_float(df, name) else c.isNull()


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = df.columns if columns is None else columns
    changed = {n: present(df, n) for n in names if is_float(df, n)}
    return df.withColumns(changed) if changed else df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
