"""Parquet tables laid out for the served predicates, and idempotent partition replacement."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.deltas import change_rows
from starmart.operators.facts import upsert
from starmart.sources import versions


# up to this many touched partitions are listed in a filter; beyond it they are joined
MAX_LISTED_PARTITIONS = 2_000


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None if nothing was written there yet; of a versioned table, the newest version.

    With ``schema``, partition columns keep their declared type instead of an inferred one.
    """
    table = versions.manifest(spark, path)
    if table is not None:
        return versions.read_version(spark, path, table, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        rows = reader.parquet(path)
        return rows if schema is None else rows.select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_partitioned(
    df: DataFrame, path: str, partition_by: list[str], sort_by: list[str] | None = None, mode: str = "overwrite"
) -> None:
    """Write one directory per ``partition_by`` value, rows sorted inside each file.

    The rebalance hint shuffles by the partition columns but lets adaptive execution split
    a season that holds most of the rows over many tasks, and merge small ones, so files
    have an even size. Overwrite replaces only the directories present in ``df``.
    """
    rows = df
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_table(df: DataFrame, path: str, partition_by: list[str], sort_by: list[str] | None = None) -> None:
    write_partitioned(df, path, partition_by, sort_by, mode="append")


def partition_values(rows: DataFrame, partition_by: list[str]) -> list | None:
    """The distinct partition values of ``rows``; None if there are too many to list.

    There are no more of them than directories to write, so the list is small as a rule.
    """
    values = rows.select(*partition_by).distinct().limit(MAX_LISTED_PARTITIONS + 1).collect()
    return values if len(values) <= MAX_LISTED_PARTITIONS else None


def touched_partitions(
    table: DataFrame, incoming: DataFrame, partition_by: list[str], values: list | None = None
) -> DataFrame:
    """The rows of ``table`` in the partitions that ``incoming`` has rows for.

    The partition values are listed in a filter, which prunes directories before any file is
    opened. If there are too many, the leading column's values are listed as far as that is
    possible, and a join in which NULL matches NULL picks the partitions.
    """
    if not partition_by:
        return table
    values = partition_values(incoming, partition_by) if values is None else values
    first, *others = partition_by
    if values is None:
        if others and (leading := partition_values(incoming, [first])) is not None:
            table = table.filter(reduce(lambda a, b: a | b, [F.col(first).eqNullSafe(F.lit(v[0])) for v in leading]))
        wanted = incoming.select(*[F.col(c).alias(f"__p_{c}") for c in partition_by]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__p_{c}")) for c in partition_by])
        return table.join(wanted, same, "left_semi")
    by_first: dict = {}
    for row in values:
        by_first.setdefault(row[0], []).append(row[1:])
    wanted = F.lit(False)
    for value, tails in by_first.items():
        here = F.col(first).eqNullSafe(F.lit(value))
        if others:
            here = here & reduce(lambda a, b: a | b, [_equal(others, tail) for tail in tails])
        wanted = wanted | here
    return table.filter(wanted)


def _equal(columns: list[str], values) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, values)])


def upsert_table(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: list[str],
    order_by: list[str],
    partition_by: list[str],
    sort_by: list[str] | None = None,
    values: list | None = None,
    keep_changes: bool = False,
) -> versions.Manifest:
    """Merge ``incoming`` into the versioned table at ``path``; running it twice changes nothing.

    Only the partitions that ``incoming`` touches are read, and each is written once, to a new folder; the switch to them
    is the last step, so a write that dies leaves the table as it was. The partition columns must be part of (or determined
    by) ``keys``. ``incoming`` is read twice unless its partition ``values`` are given, so pass a staged frame when it is costly. With
    ``keep_changes`` (keys of ``incoming`` being unique) the rows added and replaced are kept beside the table, with their
    images before and after, for tables that follow it.
    """
    before = versions.adopt(spark, path, partition_by)
    current = versions.read_version(spark, path, before, incoming.schema)
    touched = touched_partitions(current, incoming, partition_by, values)
    changes = change_rows(touched, incoming, keys, order_by) if keep_changes else None
    return versions.replace_partitions(upsert(touched, incoming, keys, order_by), path, partition_by, sort_by, before, changes=changes)
