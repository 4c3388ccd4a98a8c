"""Checks at the edges: columns, rows, tables and types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def require_rows(df: DataFrame, what: str = "frame") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def require_tables(tables, *names: tuple[str, str]) -> None:
    """Each (layer, key) must be stored."""
    missing = [tables.name(*name) for name in names if not tables.exists(*name)]
    if missing:
        raise ValueError(f"missing tables: {missing}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema` only, in its order and its types."""
    require_columns(df, schema.fieldNames())
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
