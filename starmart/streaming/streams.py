"""Streaming decode, replay suppression, upserts and live totals.

Each runs with ``availableNow`` by default: process what is there, in bounded batches, then
stop. Progress lives in a checkpoint folder; give the same folder again to continue.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators import clean, decode
from starmart.operators.windows import rank_within
from starmart.sources import versions
from starmart.sources.staging import cleans_up, stage
from starmart.sources.tables import read_table, upsert_table


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, names: str | None = None, max_files: int | None = None
) -> DataFrame:
    """Parquet files arriving in a folder, as a stream; ``names`` is a file-name glob."""
    reader = spark.readStream.schema(schema)
    if names:
        reader = reader.option("pathGlobFilter", names)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


def decode_stream(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Decoded, cleaned and flagged result rows; the batch functions work on a stream as they are.

    Unreadable messages and rows without driver or position are left out; `split_stream` keeps them.
    """
    return clean.clean_flags(decode.decode_messages(raw, schema)).drop(decode.CORRUPT)


def split_stream(
    raw: DataFrame,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    rules: dict[str, Column] | None = None,
    keep: list[str] | None = None,
    event_time: str | None = None,
    delay_seconds: int = 0,
) -> None:
    """Decode a stream of messages into two tables, ``path/good`` and ``path/bad`` (with ``_reason``), nothing being dropped.

    Each micro-batch is a partition ``batch`` of both, so one that is handed over again replaces what it wrote before. Batch numbers
    begin anew with a new checkpoint, so tables that another one has filled further are refused. With
    ``event_time`` (a timestamp made of the decoded columns, as text), a readable row more than ``delay_seconds`` older than the
    latest of the batches before goes to ``bad`` with the reason ``late``. ``keep`` names columns of ``raw`` to carry along.
    """
    good_path, bad_path = f"{path}/good", f"{path}/bad"

    @cleans_up
    def split(spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
        known = versions.manifest(spark, good_path)
        marks = {} if known is None else known.marks
        if marks.get("batch", 0) > batch_id:
            raise ValueError(f"{path} holds batches up to {marks['batch']} of another checkpoint; batch {batch_id} would take the place of one")
        # of a batch handed over again, the latest time before it counts
        limit = marks.get("before" if marks.get("batch") == batch_id else "latest")
        rows = decode.decode_messages(batch, schema, keep=keep, misfits=True)
        at = F.lit(None).cast("bigint") if event_time is None else F.unix_micros(F.expr(event_time).cast("timestamp"))
        own = dict(rules or {})
        if event_time is not None and limit is not None:
            own["late"] = F.coalesce(at >= limit - delay_seconds * 1_000_000, F.lit(True))
        rows = stage(decode.with_reason(rows, own).withColumns({"__at": at, "batch": F.lit(batch_id).cast("bigint")}), "split")
        good = rows.filter(F.col(decode.REASON).isNull())
        bad = rows.filter(F.col(decode.REASON).isNotNull()).drop("__at")
        # all rows are of one partition, so they are dealt out evenly and not by it
        versions.replace_partitions(bad.hint("rebalance"), bad_path, ["batch"], dealt=True)
        newest = None if event_time is None else good.agg(F.max("__at")).first()[0]
        latest = max(filter(None, [limit, newest]), default=None)
        told = {"batch": batch_id} | {k: v for k, v in (("before", limit), ("latest", latest)) if v is not None}
        good = good.drop("__at", decode.REASON, decode.CORRUPT, decode.MISFIT).hint("rebalance")
        versions.replace_partitions(good, good_path, ["batch"], marks=told, dealt=True)

    each_batch(raw, checkpoint, lambda batch, batch_id: split(batch.sparkSession, batch, batch_id))


def drop_replays(events: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of the first; rows older than the watermark are dropped.

    Keeps the first arrival, so it is for exact replays. Newest-wins is `upsert_stream`.
    """
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def write_stream(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> int:
    """Append a stream to a Parquet folder and wait until everything available is written.

    Returns how many rows came too late for the watermark and were dropped.
    """
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    run = writer.trigger(availableNow=True).start()
    dropped: dict[int, int] = {}
    done = False
    while not done:  # Spark keeps the last updates only, so they are added up as they come
        done = run.awaitTermination(0.5)
        for step in run.recentProgress:
            late = sum(state.numRowsDroppedByWatermark for state in step.stateOperators)
            dropped[step.batchId] = max(late, dropped.get(step.batchId, 0))
    return sum(dropped.values())


def each_batch(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Run ``handle`` on every micro-batch until everything available is processed.

    A batch may be handed over again after a failure, so ``handle`` must be repeatable.
    """
    writer = df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).foreachBatch(handle)
    writer.trigger(availableNow=True).start().awaitTermination()


def upsert_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    keys: list[str],
    order_by: list[str],
    partition_by: list[str],
    sort_by: list[str] | None = None,
) -> None:
    """Merge a stream into a table, newest row per key. Repeating a batch changes nothing."""

    def merge(batch: DataFrame, _batch_id: int) -> None:
        # read twice below (touched partitions, merge); lost blocks are recomputed from the source
        batch.persist()
        try:
            upsert_table(batch.sparkSession, path, batch, keys, order_by, partition_by, sort_by)
        finally:
            batch.unpersist()

    each_batch(rows, checkpoint, merge)


def totals_stream(
    rows: DataFrame, path: str, checkpoint: str, by: list[str], measures: dict[str, Column], partition_by: list[str]
) -> None:
    """Keep running totals per group in a table.

    Update mode hands over only the groups that changed; each replaces its older total, told
    apart by the batch number. Numbers begin anew with a new checkpoint, so a table that another
    checkpoint has filled further is refused.
    """
    checked = []
    running = rows.groupBy(*by).agg(*[measure.alias(name) for name, measure in measures.items()])

    def merge(batch: DataFrame, batch_id: int) -> None:
        known = None if checked else read_table(batch.sparkSession, path)
        newest = known.agg(F.max("batch_id")).first()[0] if known is not None else None
        if newest is not None and newest > batch_id:
            raise ValueError(f"{path} holds totals up to batch {newest} of another checkpoint; batch {batch_id} would be lost")
        checked.append(batch_id)
        stamped = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).persist()
        try:
            upsert_table(batch.sparkSession, path, stamped, by, ["batch_id"], partition_by, by)
        finally:
            stamped.unpersist()

    each_batch(running, checkpoint, merge, mode="update")


def live_standings(
    spark: SparkSession, path: str, season: str, score: str = "total_points", out: str = "championship_rank"
) -> DataFrame:
    """Ranks over the running totals; a rank window is not allowed on the stream itself."""
    return rank_within(read_table(spark, path).drop("batch_id"), [season], score, out)
