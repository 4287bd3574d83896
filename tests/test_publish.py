"""Publishing up to the write, marts that follow their dimension, and loads that leave nothing staged."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from starmart.plans import load, publish, serving
from starmart.sources.staging import stage, staging_root
from tests.test_load import result, stop, topic_rows

DAY = datetime.date(2024, 3, 2)
SESSION = "EventDate date, EventName string, RoundNumber int"
CASES = {
    "race_result": ("DriverId string, Position double, Points double", ("ver", 1.0, 25.0), "race_results", "2024_1_ver"),
    "pit_stop": ("Abbreviation string, LapNumber double, PitInTime timestamp", ("VER", 7.0, datetime.datetime(2024, 3, 2)), "pit_stops", "2024_1_VER_7"),
    "telemetry": ("DriverId string, SampleNo bigint, Speed double", ("ver", 1, 300.0), "telemetry", "2024_GP 1_ver"),
    "weather": ("AirTemp double", (20.5,), "weather", "2024_GP 1"),
}


@pytest.mark.parametrize("event_type", CASES)
def test_session_messages(spark, event_type):
    columns, values, topic, key = CASES[event_type]
    rows = spark.createDataFrame([(DAY, "GP 1", 1, *values)], f"{SESSION}, {columns}")
    (message,) = publish.session_messages(rows, event_type, prefix="t_").collect()
    assert (message.topic, message.key.decode()) == ("t_" + topic, key)
    assert json.loads(message.value)["event_type"] == event_type
    assert publish.session_messages(rows.limit(0), event_type).count() == 0


def test_published_messages_load_again(spark, tmp_path):
    rows = spark.createDataFrame([(DAY, "GP 1", 1, "ver", "Max", "V", 1.0, 25.0)], f"{SESSION}, DriverId string, FirstName string, LastName string, Position double, Points double")
    raw = publish.session_messages(rows, "race_result").select("key", "value")
    assert load.load_race_results(spark, raw, str(tmp_path)) == [2024]
    assert spark.read.parquet(f"{tmp_path}/fact_race_result").select("driver_id", "points").collect()[0] == ("VER", 25)


def test_publish_command(spark, tmp_path, monkeypatch):
    from starmart import __main__ as cli

    sent = []
    monkeypatch.setattr(publish, "write_topics", lambda messages, servers: sent.append((messages.count(), servers)))
    rows = spark.createDataFrame([(DAY, "GP 1", 1, 20.5)], f"{SESSION}, AirTemp double")
    rows.write.parquet(str(tmp_path / "in"))
    cli.main(["publish", "weather", "--files", str(tmp_path / "in"), "--servers", "host:9092"])
    assert sent == [(1, "host:9092")]


def staged(spark):
    folder = f"{staging_root(spark)}/starmart/{spark.sparkContext.applicationId}"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_renamed_driver_shows_in_all_seasons(spark, tmp_path):
    path = str(tmp_path)
    before = staged(spark)
    for year, name in ((2023, "Old Name"), (2024, "New Name")):
        seasons = load.load_race_results(spark, topic_rows(spark, [result(year, 1, "ver", "Red", 1, 25.0, at=f"{year}-03-02T15:00:00", driver_name=name)]), path)
        load.refresh_marts(spark, path, seasons)
    load.load_pit_stops(spark, topic_rows(spark, [stop(1)]), path)
    assert staged(spark) == before
    serving.register_views(spark, path)
    assert {(r.year, r.driver_name) for r in spark.table("vw_driver_standings").collect()} == {(2023, "New Name"), (2024, "New Name")}


def test_failed_load_leaves_nothing_staged(spark, tmp_path, monkeypatch):
    def fail(*_):
        raise OSError("no space")

    before = staged(spark)
    monkeypatch.setattr(load, "store_drivers", fail)
    with pytest.raises(OSError):
        load.load_race_results(spark, topic_rows(spark, [result(2024, 1, "ver", "Red", 1, 25.0)]), str(tmp_path))
    assert staged(spark) == before
    stage(spark.range(1), "kept")
    assert len(staged(spark) - before) == 1


def test_team_rank_covers_the_whole_season(spark, tmp_path):
    path = str(tmp_path)
    for rows in ([result(2024, 1, "ver", "Red", 2, 18.0)], [result(2024, 2, "ham", "Red", 1, 25.0), result(2024, 2, "alo", "Green", 3, 15.0)]):
        load.refresh_marts(spark, path, load.load_race_results(spark, topic_rows(spark, rows), path))
    serving.register_views(spark, path)
    got = spark.table("vw_season_team_rank").select("driver_id", "season_team_rank").orderBy("driver_id").collect()
    assert [tuple(r) for r in got] == [("ALO", 1), ("HAM", 1), ("VER", 2)]


def test_separator_with_a_quote(spark):
    from starmart.operators.marts import pit_strategy

    stops = spark.createDataFrame([(1, 1, 2.0, "a"), (1, 2, 3.0, "b")], "k int, lap_number int, pit_duration_sec double, compound string")
    assert pit_strategy(stops, by=["k"], separator="'\\").select(F.col("tyre_strategy")).collect()[0][0] == "a'\\b"
