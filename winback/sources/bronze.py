"""Raw transactions in the two-part bronze layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The parts overlap in December 1998, so that month occurs twice.
PART_TWO_FROM = "1998-12-01"
PART_ONE_BEFORE = "1999-01-01"


# The columns read and their types; stating them saves a look into each file.
STAR_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, "
    "l_discount double, l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
}


def star_lines(
    spark: SparkSession, folder: str, pieces: int | None = None, key: str | None = None
) -> DataFrame:
    """Order lines of the star-schema tables in bronze columns.

    `pieces` deals the lines out anew, for a table that is one file with one row group;
    otherwise the files' own split holds. Join sides are left to the optimiser: it broadcasts only below the session's size
    limit, and adaptive execution splits a hot order or part. Small tables are joined one by
    one, as the size of a join among them is overrated, and orders last, so that lines that had
    to be exchanged leave by order.
    `key` names a further column, the order that the invoice is named after.
    """

    def table(name: str) -> DataFrame:
        reader = spark.read.schema(STAR_SCHEMAS[name])
        return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")

    lineitem = table("lineitem")
    if pieces:
        lineitem = lineitem.repartition(pieces)
    # Converted once a part, not once a line.
    part = table("part").withColumn("p_retailprice", F.col("p_retailprice").cast("decimal(12,2)"))
    joined = (
        lineitem
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    returned = F.col("l_returnflag") == "R"
    quantity = F.col("l_quantity").cast("int")
    net_price = F.col("p_retailprice") * (
        F.lit(1) - F.col("l_discount").cast("decimal(4,2)")
    )
    return joined.select(
        F.concat(F.when(returned, "C").otherwise(""), F.col("o_orderkey").cast("string")).alias(
            "Invoice"
        ),
        F.concat(
            F.when(F.col("p_size") == 1, "TEST").otherwise(""), F.col("l_partkey").cast("string")
        ).alias("StockCode"),
        F.when(F.col("p_size") == 2, "Discount")
        .when(F.col("p_size") == 3, F.lit(None))
        .otherwise(F.col("p_name"))
        .alias("Description"),
        F.when(returned, -quantity).otherwise(quantity).alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.when(F.col("o_orderkey") % 97 == 0, F.lit(0))
        .otherwise(net_price)
        .cast("decimal(16,4)")
        .alias("Price"),
        F.when(F.col("o_orderkey") % 20 != 0, F.col("o_custkey")).alias("Customer ID"),
        F.col("n_name").alias("Country"),
        *([F.col("o_orderkey").alias(key)] if key else []),
    )


def _parts(day: Column) -> Column:
    in_one = day < F.lit(PART_ONE_BEFORE).cast("date")
    in_two = day >= F.lit(PART_TWO_FROM).cast("date")
    return (
        F.when(in_one & in_two, F.array(F.lit(1), F.lit(2)))
        .when(in_one, F.array(F.lit(1)))
        .otherwise(F.array(F.lit(2)))
    )


def read_bronze(
    spark: SparkSession, folder: str, pieces: int | None = None, key: str | None = None
) -> DataFrame:
    """Both parts, duplicates kept.

    One pass over the lines emits each row once per part that holds it, so the joins
    run once instead of once per part.
    """
    lines = star_lines(spark, folder, pieces, key)
    return lines.withColumn("part", F.explode(_parts(F.to_date("InvoiceDate")))).drop("part")


def union_parts(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of several parts with the same columns, duplicates kept."""
    for other in others:
        first = first.unionByName(other)
    return first
