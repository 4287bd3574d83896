"""Streams over files: late rows, replays, several batches, equality with the batch form."""

import datetime as dt

from pyspark.sql import functions as F

from starmart.operators import marts
from starmart.sources.tables import read_table
from starmart.streaming import streams

SCHEMA = "id int, year int, driver_id string, points bigint, at timestamp"


def batches(spark, path, *parts):
    """One file per batch, picked up one at a time."""
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return streams.stream_files(spark, path, spark.createDataFrame([], SCHEMA).schema, max_files=1)


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def test_replays_within_the_watermark_are_dropped_and_late_rows_too(spark, tmp_path):
    first = [(1, 2024, "A", 5, at(0)), (1, 2024, "A", 5, at(0)), (2, 2024, "B", 3, at(30))]
    second = [(1, 2024, "A", 5, at(29)), (3, 2024, "C", 1, at(40))]
    third = [(4, 2024, "D", 1, at(1))]  # 29 minutes behind a watermark of 10
    stream = batches(spark, str(tmp_path / "in"), first, second, third)
    once = streams.drop_replays(stream, ["id"], "at", "60 minutes")
    assert streams.write_stream(once, str(tmp_path / "wide"), str(tmp_path / "c1")) == 0
    assert sorted(r.id for r in read_table(spark, str(tmp_path / "wide")).collect()) == [1, 2, 3, 4]

    stream = streams.stream_files(spark, str(tmp_path / "in"), stream.schema, max_files=1)
    narrow = streams.drop_replays(stream, ["id"], "at", "10 minutes")
    late = streams.write_stream(narrow, str(tmp_path / "narrow"), str(tmp_path / "c2"))
    assert late >= 1
    assert 4 not in {r.id for r in read_table(spark, str(tmp_path / "narrow")).collect()}


def test_upsert_stream_over_several_batches(spark, tmp_path):
    first = [(1, 2024, "A", 5, at(0)), (2, 2023, "B", 3, at(0))]
    second = [(1, 2024, "A", 9, at(5)), (2, 2023, "B", 0, None)]
    path = str(tmp_path / "out")
    for run in ("c1", "c2"):  # the second run replays everything into the same table
        stream = batches(spark, str(tmp_path / "in"), *([first, second] if run == "c1" else []))
        streams.upsert_stream(stream, path, str(tmp_path / run), ["id"], ["at"], ["year"])
        assert {r.id: r.points for r in read_table(spark, path).collect()} == {1: 9, 2: 3}


def test_live_standings_equal_batch_standings(spark, tmp_path):
    parts = [
        [(i, 2020 + i % 2, f"D{i % 5}", i * 7 % 11, at(i % 60)) for i in range(start, start + 20)]
        for start in (0, 20, 40)
    ]
    stream = batches(spark, str(tmp_path / "in"), *parts)
    path = str(tmp_path / "totals")
    streams.totals_stream(
        stream, path, str(tmp_path / "c"), ["year", "driver_id"], {"total_points": F.sum("points")}, ["year"]
    )
    live = streams.live_standings(spark, path, "year")
    batch = marts.standings(
        spark.read.parquet(str(tmp_path / "in")), "year", "driver_id", {"total_points": F.sum("points")}
    )
    columns = ["year", "driver_id", "total_points", "championship_rank"]
    assert sorted(map(tuple, live.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))


def test_a_micro_batch_is_spread_over_the_cores(spark):
    rows = spark.range(1000).withColumn("value", F.lit("x"))
    sizes = []
    stream = stream_queries._in_files(spark, rows)
    streams.each_batch(stream, new_folder(spark, "spread"), lambda batch, _: sizes.append(batch.groupBy(F.input_file_name()).count().collect()))
    assert sum(r["count"] for files in sizes for r in files) == 1000
    assert [len(files) for files in sizes] == [spark.sparkContext.defaultParallelism] * 3
