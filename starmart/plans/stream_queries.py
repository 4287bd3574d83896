"""Streaming queries over the shared tables; each equals its batch result."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.plans.registry import hundredths, money, plain, query, table
from starmart.plans.table_queries import UPSERT_SQL
from starmart.sources.staging import new_folder
from starmart.sources.tables import read_table
from starmart.streaming import streams


def _stream(spark, sf_dir, name):
    """The table's file, as a streaming source."""
    return streams.stream_files(spark, sf_dir, table(spark, sf_dir, name).schema, names=f"{name}.parquet")


def _in_files(spark, rows, batches=3, columns=("*",)):
    """``rows`` as a stream of so many micro-batches, each of a file per core: a file that is one row group is read by one task.

    That task only reads and deals out; ``columns`` are made of what it has dealt.
    """
    path, files = new_folder(spark, "stream_files"), spark.sparkContext.defaultParallelism
    rows = rows.repartition(batches * files).select(*columns)
    rows.write.parquet(path)
    return streams.stream_files(spark, path, rows.schema, max_files=files)


@query(
    """SELECT o_orderkey AS round, CAST(o_custkey AS VARCHAR) AS driver_id, CAST(o_orderkey % 20 AS BIGINT) AS position,
              o_totalprice AS points, o_orderkey % 20 = 1 AS is_winner, o_orderkey % 20 <= 10 AS is_points_finish,
              strftime(o_orderdate, '%Y-%m-%d') AS day
       FROM orders"""
)
def stream_decode(spark, sf_dir):
    orders = _stream(spark, sf_dir, "orders")
    message = F.struct(
        F.col("o_orderkey").alias("round"),
        F.col("o_custkey").cast("string").alias("driver_id"),
        (F.col("o_orderkey") % 20).cast("double").alias("position"),
        F.col("o_totalprice").alias("points"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("ingested_at"),
    )
    raw = orders.select(F.to_json(message).cast("binary").alias("value"))
    schema = T.StructType.fromDDL(
        "round bigint, driver_id string, position int, points double, ingested_at string"
    )
    rows = streams.decode_stream(raw, schema)
    path = new_folder(spark, "stream_decode")
    streams.write_stream(rows, path, new_folder(spark, "stream_decode_progress"))
    day = F.date_format("ingested_at", "yyyy-MM-dd").alias("day")
    return plain(read_table(spark, path).select("*", day).drop("ingested_at"))


@query(
    """SELECT CASE o_orderkey % 6 WHEN 1 THEN 'unreadable' WHEN 2 THEN 'unreadable' WHEN 3 THEN 'misfit:position'
                                  WHEN 4 THEN 'position_known' END AS reason,
              count(*) AS messages, sum(o_orderkey) AS keys
       FROM orders GROUP BY 1"""
)
def stream_quarantine(spark, sf_dir):
    # good and broken messages arrive in several batches
    key = F.col("o_orderkey").cast("string")
    kinds = [
        F.concat(F.lit('{"round": '), key, F.lit(', "position": 3}')),
        F.concat(F.lit('{"round": '), key, F.lit(', "position": 3}],[{"round": 1}')),
        F.concat(F.lit('{"round": '), key),
        F.concat(F.lit('{"round": '), key, F.lit(', "position": "third"}')),
        F.concat(F.lit('{"round": '), key, F.lit(', "position": null}')),
        F.concat(F.lit('{"position": 4.0, "round": "'), key, F.lit('"}')),
    ]
    value = F.element_at(F.array(*kinds), (F.col("o_orderkey") % 6 + 1).cast("int"))
    messages = _in_files(spark, table(spark, sf_dir, "orders").select("o_orderkey"), columns=["o_orderkey", value.alias("value")])
    path, schema = new_folder(spark, "stream_quarantine"), T.StructType.fromDDL("round bigint, position int")
    rules = {"position_known": F.col("position").isNotNull()}
    streams.split_stream(messages, schema, path, new_folder(spark, "stream_quarantine_progress"), rules, keep=["o_orderkey"])
    good = read_table(spark, f"{path}/good").withColumn("_reason", F.lit(None).cast("string"))
    rows = good.unionByName(read_table(spark, f"{path}/bad").select(*good.columns))
    counts = rows.groupBy(F.col("_reason").alias("reason"))
    return plain(counts.agg(F.count(F.lit(1)).alias("messages"), F.sum("o_orderkey").alias("keys")))


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_dedup(spark, sf_dir):
    # every event arrives twice
    events = _stream(spark, sf_dir, "events").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    events = events.withColumn("ingested_at", F.col("ts").cast("timestamp"))
    once = streams.drop_replays(events, ["event_id"], "ingested_at", "60 days")
    path = new_folder(spark, "stream_dedup")
    rows = once.select("event_id", "user_id", "event_type", "value")
    streams.write_stream(rows, path, new_folder(spark, "stream_dedup_progress"))
    return plain(read_table(spark, path))


@query(UPSERT_SQL)
def stream_upsert(spark, sf_dir):
    # each open order arrives as it was, and again with a later change
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.year("o_orderdate").alias("year"),
        F.explode(F.when(F.col("o_orderstatus") == "O", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias(
            "version"
        ),
        "o_totalprice",
    )
    orders = _in_files(spark, orders.withColumn("o_totalprice", F.col("o_totalprice") + F.col("version")))
    path = new_folder(spark, "stream_upsert")
    streams.upsert_stream(
        orders, path, new_folder(spark, "stream_upsert_progress"), ["o_orderkey"], ["version"], ["year"], ["o_orderkey"]
    )
    return plain(read_table(spark, path).drop("version"))


@query(
    """WITH t AS (
        SELECT CAST(year(o_orderdate) AS BIGINT) AS year, o_custkey AS driver_id,
               sum(CAST(o_totalprice AS DECIMAL(12,2))) AS points, count(*) AS n_orders
        FROM orders GROUP BY 1, 2)
    SELECT year, driver_id, CAST(points AS DOUBLE) AS total_points, n_orders,
           rank() OVER (PARTITION BY year ORDER BY points DESC NULLS LAST) AS championship_rank
    FROM t"""
)
def stream_standings(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"),
        F.col("o_custkey").alias("driver_id"),
        hundredths("o_totalprice").alias("points"),
    )
    orders = _in_files(spark, orders)
    path = new_folder(spark, "stream_standings")
    streams.totals_stream(
        orders,
        path,
        new_folder(spark, "stream_standings_progress"),
        ["year", "driver_id"],
        {"total_points": F.sum("points"), "n_orders": F.count(F.lit(1))},
        partition_by=["year"],
    )
    return plain(money(streams.live_standings(spark, path, "year")))
