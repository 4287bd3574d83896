"""Relational tables over JDBC: partitioned reads, appends. The driver jar is the cluster's to provide."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def connection(url: str, user: str | None = None, password: str | None = None, driver: str | None = None) -> dict:
    options = {"url": url, "user": user, "password": password, "driver": driver}
    return {name: value for name, value in options.items() if value is not None}


def read_relation(
    spark: SparkSession,
    link: dict,
    table: str,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """Scan a table or view. With ``split_on`` and its ``bounds`` the scan runs as parallel range queries."""
    options = dict(link, dbtable=table, fetchsize=str(fetch_rows))
    if split_on and bounds:
        low, high = bounds
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**options).load()


def append_relation(df: DataFrame, link: dict, table: str, connections: int = 8, batch_rows: int = 10_000) -> None:
    """Append rows, over at most ``connections`` parallel connections.

    A retried task sends its rows again: point this at a load table with no unique key, or
    append keys that are absent (`insert_if_absent`) from a staged frame.
    """
    options = dict(link, dbtable=table, numPartitions=str(connections), batchsize=str(batch_rows))
    df.write.format("jdbc").options(**options).mode("append").save()
