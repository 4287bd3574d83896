"""Registry of the queries over the shared test tables, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Types that compare across engines: BIGINT, DOUBLE, text times. Only for the outermost select."""
    columns = []
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType | T.FloatType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.IntegerType | T.ShortType | T.ByteType):
            value = value.cast("bigint")
        elif isinstance(field.dataType, T.TimestampType | T.TimestampNTZType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(value.alias(field.name))
    return df.select(*columns)


# How the star schema maps onto the shared tables:
#   season = year(o_orderdate), round = month(o_orderdate), driver = o_custkey, team = c_mktsegment,
#   points = l_extendedprice in whole hundredths, position = l_linenumber
# Sums of hundredths are exact and stay in long arithmetic; `money` turns them back at the end.


def hundredths(price: str):
    return F.round(F.col(price) * 100).cast("bigint")


def money(df: DataFrame, column: str = "total_points") -> DataFrame:
    return df.withColumn(column, F.col(column) / F.lit(100.0))


def line_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: points, wins (position 1) and points finishes (position 1 to 3).

    Combined before any join, so that an order with very many lines is reduced on the map side.
    """
    position = F.col("l_linenumber")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(hundredths("l_extendedprice")).alias("points"),
            F.count_if(position == 1).alias("wins"),
            F.count_if(position <= 3).alias("points_finishes"),
        )
    )


def order_results(spark: SparkSession, sf_dir: str, season: int | None = None) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    if season is not None:
        # a range of dates, unlike a year() comparison, lets the scan skip row groups
        orders = orders.filter(
            (F.col("o_orderdate") >= F.lit(f"{season}-01-01").cast("timestamp_ntz"))
            & (F.col("o_orderdate") < F.lit(f"{season + 1}-01-01").cast("timestamp_ntz"))
        )
    orders = orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("driver_id"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("round"),
    )
    return line_scores(spark, sf_dir).join(orders, "l_orderkey")


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("driver_id"),
        F.col("c_name").alias("driver_name"),
        F.col("c_mktsegment").alias("team"),
    )


TOTALS = {
    "total_points": lambda: F.sum("points"),
    "wins": lambda: F.sum("wins"),
    "points_finishes": lambda: F.sum("points_finishes"),
}


def totals(*names: str) -> dict:
    return {name: TOTALS[name]() for name in names or TOTALS}
