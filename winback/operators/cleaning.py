"""From raw transactions to clean lines and model inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winback.contract import BRONZE_NAMES, FEATURES
from winback.functions import lines


def rename_columns(bronze: DataFrame) -> DataFrame:
    return bronze.withColumnsRenamed(BRONZE_NAMES)


def drop_missing_customer(df: DataFrame, column: str = "customer_id") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def to_silver(bronze: DataFrame) -> DataFrame:
    return bronze.transform(rename_columns).transform(drop_missing_customer).transform(
        drop_duplicate_rows
    )


def with_line_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_cancelled": lines.is_cancelled(),
            "is_test": lines.is_test(),
            "is_discount": lines.is_discount(),
            "total_amount": lines.line_amount(),
            "is_zero_price": F.col("price") == 0,
            "is_zero_quantity": F.col("quantity") == 0,
            "purchase_date": lines.purchase_day(),
        }
    )


def valid_lines(df: DataFrame, rule: str) -> DataFrame:
    """Lines that count as purchases under a rule, with amount and day."""
    return df.filter(lines.valid_line(rule)).withColumns(
        {"total_amount": lines.line_amount(), "purchase_date": lines.purchase_day()}
    )


def lines_of_product(df: DataFrame, stock_code: str) -> DataFrame:
    return df.filter(F.col("stock_code") == stock_code)


def discount_lines(df: DataFrame) -> DataFrame:
    return df.filter(lines.is_discount())


def non_positive_quantity(df: DataFrame) -> DataFrame:
    return df.filter(F.col("quantity") <= 0)


def decimals_to_double(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def model_input(df: DataFrame, date_column: str = "scoring_date") -> DataFrame:
    """Key, dates and the ten features as doubles, in model order."""
    return df.select(
        F.col("customer_id").cast("long").alias("customer_id"),
        date_column,
        "first_purchase_date",
        "last_purchase_date",
        *[F.col(name).cast("double").alias(name) for name in FEATURES],
    )
