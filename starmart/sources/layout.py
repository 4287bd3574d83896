"""Parquet files laid out for filters on several columns: rows in the order of interleaved bits, with bloom filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.ranges import ascending, numbered

BITS = 6
PLACE = "__z"


def interleave(numbers: list[Column], bits: int) -> Column:
    """One number whose bits are taken from ``numbers`` in turn, the highest bits first."""
    width = len(numbers)
    parts = [
        F.shiftleft(F.shiftright(number.cast("bigint"), bit).bitwiseAND(F.lit(1)), bit * width + width - 1 - i)
        for i, number in enumerate(numbers)
        for bit in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def interleaved(df: DataFrame, columns: list[str], bits: int = BITS, out: str = PLACE) -> DataFrame:
    """``df`` with ``out``, a place on a curve along which every one of ``columns`` changes slowly.

    A column counts by the number of its value's range among 2**bits ranges of its distinct values (see `ranges`), so any
    type that sorts will do, and neither long common beginnings nor very common values spoil the spread.
    """
    if not 0 < len(columns) * bits < 63:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit a place of 62 bits")
    names = [f"{out}{i}" for i in range(len(columns))]
    placed = df
    for name, column in zip(names, columns):
        placed = numbered(placed, F.struct(*[c.alias(f"v{i}") for i, c in enumerate(ascending([column]))]), 1 << bits, name)
    return placed.withColumn(out, interleave([F.col(n) for n in names], bits)).drop(*names)


def clustered(df: DataFrame, partition_by: list[str], columns: list[str], order: list[str] | None = None, files: int | None = None) -> DataFrame:
    """``df`` dealt out and sorted by (partition, place of ``columns``, ``order``), to be written as it is.

    Tasks take ranges of that order and not hashes, so a file covers a small part of the curve, and a value that holds
    a third of all rows still goes to many tasks where ``order`` tells its rows apart. ``files`` is how many ranges there
    are (as many as shuffle partitions if not given, small ones merged).
    """
    along = [*partition_by, PLACE, *[c for c in order or [] if c not in partition_by]]
    placed = interleaved(df, columns)
    dealt = placed.repartitionByRange(files, *along) if files else placed.repartitionByRange(*along)
    return dealt.sortWithinPartitions(*along).drop(PLACE)


def bloom_options(columns: list[str]) -> dict[str, str]:
    """Write options for a bloom filter on each column; Parquet leaves it out where a dictionary of the values does the same."""
    return {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}


def write_clustered(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    columns: list[str],
    order: list[str] | None = None,
    files: int | None = None,
    row_group_bytes: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Write ``df`` so that a filter on any of ``columns`` reads few row groups.

    Sorting by one column alone leaves all values of the others in every row group. ``df`` is read twice for the bounds of
    each column (that column only), once to sample the order and once to be written, and has to give the same rows each time. Overwrite replaces only the
    directories present in ``df``. Values that lie next to a very common one on the curve share its files.
    """
    options = bloom_options(columns) | ({"parquet.block.size": str(row_group_bytes)} if row_group_bytes else {})
    writer = clustered(df, partition_by, columns, order, files).write.mode(mode).options(**options)
    writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
