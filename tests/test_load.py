"""The whole load on hand-made messages: decode, quarantine, dimensions, facts, replays, marts, pages."""

import json

import pytest

from starmart.plans import load, serving
from starmart.streaming.streams import stream_files

RAW = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"


def topic_rows(spark, messages):
    rows = [
        (b"k", m if isinstance(m, bytes | type(None)) else json.dumps(m).encode(), "t", 0, i, None, 0)
        for i, m in enumerate(messages)
    ]
    return spark.createDataFrame(rows, RAW)


def result(year, rnd, driver, team, position, points, at="2024-03-02T15:00:00.000001", **other):
    return {
        "event_type": "race_result", "year": year, "gp_name": f"GP {rnd}", "round": rnd, "driver_id": driver,
        "driver_name": f"Name {driver}".title() if driver else None, "team": team, "position": position,
        "points": points, "status": "Finished", "fastest_lap": "1:30", "ingested_at": at, **other,
    }


def stop(lap, driver="ver", duration=22.5, compound="SOFT", at="2024-03-02T16:00:00", **other):
    return {
        "event_type": "pit_stop", "year": 2024, "gp_name": "GP 1", "round": 1, "driver_id": driver, "lap_number": lap,
        "pit_duration_sec": duration, "compound": compound, "tyre_life": 10, "ingested_at": at, **other,
    }


RESULTS = [
    result(2024, 1, "ver", "Red", 1.0, 25.0),
    result(2024, 1, "VER", "Red", 1, 25.0),  # replay, other spelling
    result(2024, 1, "ham", "Silver", "2", "18"),
    result(2024, 1, "alo", "Green", 11, 0),
    result(2024, 2, "ver", "Red", 2, 18.0),
    result(2024, 2, "ham", "Red", 1, 25.0),  # changes team
    result(2024, 2, "alo", "Green", 10, 1),
    result(2023, 1, "ver", "Red", 1, 25.0),
    result(2024, 1, None, "Red", 5, 10.0),  # no driver
    result(2024, 1, "bot", "Green", None, 0.0),  # no position
    result(2024, 1, "zho", "Green", 3, 12345.5),  # points do not fit
    b'{"year": 2024, "rou',
    b"",
    None,
    b'{"year": 2024, "round": 3, "gp_name": "GP 3", "driver_id": "ver", "position": 4, "points": NaN}',
]


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warehouse"))
    seasons = load.load_race_results(spark, topic_rows(spark, RESULTS), path)
    assert seasons == [2023, 2024]
    stops = [stop(10, compound=None), stop(30, compound="HARD", duration=24.0), stop(5), stop(12, driver="zzz"),
             stop(40, driver="ham", compound=None, duration=None), stop(41, driver="ham", compound="GRAVEL")]
    load.load_pit_stops(spark, topic_rows(spark, stops), path)
    load.refresh_marts(spark, path)
    return path


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_facts_and_flags(spark, warehouse):
    fact = spark.read.parquet(f"{warehouse}/fact_race_result")
    got = rows(fact.select("year", "round", "driver_id", "position", "is_winner", "is_points_finish"))
    assert got == [
        (2023, 1, "VER", 1, True, True),
        (2024, 1, "ALO", 11, False, False),
        (2024, 1, "HAM", 2, False, True),
        (2024, 1, "VER", 1, True, True),
        (2024, 2, "ALO", 10, False, True),
        (2024, 2, "HAM", 1, True, True),
        (2024, 2, "VER", 2, False, True),
        (2024, 3, "VER", 4, False, True),
    ]
    assert fact.filter("round = 3").select("points").collect()[0][0] is None
    assert fact.select("result_id").distinct().count() == 8


def test_quarantine(spark, warehouse):
    bad = spark.read.parquet(f"{warehouse}/quarantine/race_result")
    assert rows(bad.groupBy("_reason").count()) == [("type:points", 1), ("unreadable", 3)]


def test_dimensions(spark, warehouse):
    drivers = spark.read.parquet(f"{warehouse}/dim_driver")
    assert rows(drivers.select("driver_id", "current_team")) == [("ALO", "Green"), ("HAM", "Red"), ("VER", "Red")]
    circuits = spark.read.parquet(f"{warehouse}/dim_circuit")
    assert rows(circuits.select("year", "round", "gp_name")) == [
        (2023, 1, "GP 1"), (2024, 1, "GP 1"), (2024, 2, "GP 2"), (2024, 3, "GP 3"),
    ]
    assert sorted(r[0] for r in circuits.select("circuit_id").collect()) == [1, 2, 3, 4]
    assert spark.read.parquet(f"{warehouse}/dim_tyre").count() == 5
    assert rows(spark.read.parquet(f"{warehouse}/dim_team").select("team_name")) == [("Green",), ("Red",), ("Silver",)]


def test_standings_page(spark, warehouse):
    serving.register_views(spark, warehouse)
    page = serving.page(spark, "standings", year=2024)
    got = [
        (r.driver_name, float(r.total_points), r.wins, r.points_finishes, r.championship_rank) for r in page.collect()
    ]
    assert got == [("Name Ham", 43.0, 1, 2, 1), ("Name Ver", 43.0, 1, 3, 1), ("Name Alo", 1.0, 0, 1, 3)]
    assert [r.driver_id for r in serving.champion(page).collect()] == ["HAM", "VER"]
    assert [r.year for r in serving.page(spark, "seasons").collect()] == [2024, 2023]


def test_strategy_page(spark, warehouse):
    serving.register_views(spark, warehouse)
    page = serving.page(spark, "strategy", year=2024, gp="GP 1")
    got = {r.driver_id: (r.total_stops, r.tyre_strategy) for r in page.collect()}
    assert got == {"ZZZ": (1, "SOFT"), "HAM": (2, "GRAVEL"), "VER": (3, "SOFT → HARD")}
    ver = page.filter("driver_id = 'VER'").collect()[0]
    assert float(ver.avg_pit_duration_sec) == 23.0 and float(ver.fastest_pit_sec) == 22.5


def test_comparison_and_counts(spark, warehouse):
    serving.register_views(spark, warehouse)
    series = serving.page(spark, "comparison", year=2024, d1="HAM", d2="ALO").collect()
    assert [(r.round, r.driver_id) for r in series] == [(1, "ALO"), (1, "HAM"), (2, "ALO"), (2, "HAM")]
    counts = serving.run_sql(
        spark, "SELECT (SELECT count(*) FROM fact_race_result) AS a, (SELECT count(*) FROM dim_circuit) AS b"
    )
    assert tuple(counts.collect()[0]) == (8, 4)


def test_season_filter_prunes_partitions(spark, warehouse):
    serving.register_views(spark, warehouse)
    plan = serving.page(spark, "standings", year=2024)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_constraints(spark, warehouse):
    report = {(r.table, r.rule): r.n_violations for r in load.check_constraints(spark, warehouse).collect()}
    assert report[("fact_pit_stop", "reference:dim_driver")] == 1
    assert report[("fact_pit_stop", "reference:dim_tyre")] == 1
    assert report[("fact_race_result", "unique:year,round,driver_id")] == 0
    assert report[("fact_race_result", "reference:dim_driver")] == 0


def test_replay_changes_nothing(spark, warehouse):
    def tables():
        names = ["fact_race_result", "dim_driver", "dim_circuit", "dim_team", "dim_tyre", "vw_driver_standings"]
        return {n: sorted(map(repr, spark.read.parquet(f"{warehouse}/{n}").collect())) for n in names}

    before = tables()
    seasons = load.load_race_results(spark, topic_rows(spark, list(reversed(RESULTS))[4:]), warehouse)
    load.refresh_marts(spark, warehouse, seasons)
    assert tables() == before


def test_newer_message_replaces_and_keeps_key(spark, tmp_path):
    path = str(tmp_path / "w")
    load.load_race_results(spark, topic_rows(spark, [result(2024, 1, "ver", "Red", 1, 25.0)]), path)
    old = spark.read.parquet(f"{path}/fact_race_result").collect()[0]
    late = [result(2024, 1, "ver", "Red", 3, 15.0, at="2024-03-03T00:00:00"), result(2024, 1, "ham", "Silver", 1, 25.0)]
    load.load_race_results(spark, topic_rows(spark, late), path)
    fact = {r.driver_id: r for r in spark.read.parquet(f"{path}/fact_race_result").collect()}
    assert (fact["VER"].position, fact["VER"].result_id) == (3, old.result_id)
    assert fact["HAM"].result_id != old.result_id
    # an older message that arrives late changes nothing
    load.load_race_results(spark, topic_rows(spark, [result(2024, 1, "ver", "Red", 1, 25.0)]), path)
    assert spark.read.parquet(f"{path}/fact_race_result").filter("driver_id = 'VER'").collect()[0].position == 3


def test_telemetry_and_weather(spark, tmp_path):
    path = str(tmp_path / "w")
    telemetry = [
        {"event_type": "telemetry", "year": 2024, "gp_name": "GP 1", "driver_id": "ver", "speed_kmh": 300.5,
         "brake": True, "drs": 12.0, "sample_no": i, "ingested_at": "2024-03-02T15:00:00"}
        for i in range(3)
    ]
    weather = [
        {"event_type": "weather", "year": 2024, "gp_name": "GP 1", "air_temp_c": t, "rainfall": None,
         "ingested_at": f"2024-03-02T15:00:0{i}"}
        for i, t in enumerate([20.5, 20.5, 21.0])
    ]
    for _ in range(2):
        load.load_telemetry(spark, topic_rows(spark, telemetry), path)
        load.load_weather(spark, topic_rows(spark, weather), path)
    assert spark.read.parquet(f"{path}/fact_telemetry").count() == 3
    fact = spark.read.parquet(f"{path}/fact_weather")
    # equal readings at different times are two samples; reading the messages again adds none
    assert rows(fact.select("air_temp_c", "rainfall")) == [(20.5, False), (20.5, False), (21.0, False)]


def test_samples_without_a_number_are_all_kept(spark, tmp_path):
    path = str(tmp_path / "w")
    plain = {"event_type": "telemetry", "year": 2024, "gp_name": "GP 1", "driver_id": "ver", "speed_kmh": 300.5}
    messages = [plain | {"ingested_at": f"2024-03-02T15:00:00.00000{i}"} for i in range(5)]
    for _ in range(2):
        load.load_telemetry(spark, topic_rows(spark, messages + messages), path)
    assert spark.read.parquet(f"{path}/fact_telemetry").count() == 5


def test_stream_load_equals_batch_load(spark, tmp_path):
    incoming = str(tmp_path / "in")
    for part in (RESULTS[:6], RESULTS[6:]):
        topic_rows(spark, part).coalesce(1).write.mode("append").parquet(incoming)
    stream = stream_files(spark, incoming, topic_rows(spark, []).schema, max_files=1)
    load.load_stream(spark, stream, "race_result", str(tmp_path / "s"), str(tmp_path / "c"))
    load.load_race_results(spark, topic_rows(spark, RESULTS), str(tmp_path / "b"))
    load.refresh_marts(spark, str(tmp_path / "b"))
    for table, hidden in (("fact_race_result", ["result_id", "ingested_at"]), ("vw_driver_standings", []),
                          ("dim_driver", []), ("dim_team", ["team_id"])):
        one, two = (spark.read.parquet(f"{tmp_path}/{run}/{table}").drop(*hidden) for run in "sb")
        assert sorted(map(repr, one.collect())) == sorted(map(repr, two.select(one.columns).collect())), table


def test_stops_without_a_driver_are_quarantined(spark, tmp_path):
    path = str(tmp_path / "w")
    load.load_pit_stops(spark, topic_rows(spark, [stop(1, driver=" "), stop(2)]), path)
    assert spark.read.parquet(f"{path}/fact_pit_stop").count() == 1
    assert rows(spark.read.parquet(f"{path}/quarantine/pit_stop").select("_reason")) == [("not_null:driver_id",)]


def test_export_appends_only_new_keys(spark, warehouse, monkeypatch):
    sent = []
    known = spark.read.parquet(f"{warehouse}/fact_race_result").filter("year = 2024")
    monkeypatch.setattr(load, "read_relation", lambda *_: known)
    monkeypatch.setattr(load, "append_relation", lambda df, link, table: sent.append((table, rows(df.select("year")))))
    load.export_table(spark, warehouse, "fact_race_result", {"url": "jdbc:x"})
    assert sent == [("fact_race_result", [(2023,)])]


def test_export_reads_keys_in_ranges(spark, warehouse, monkeypatch):
    asked = []
    known = spark.read.parquet(f"{warehouse}/fact_race_result")
    monkeypatch.setattr(load, "read_relation", lambda spark, link, table, **split: asked.append(split) or known)
    monkeypatch.setattr(load, "append_relation", lambda df, link, table: None)
    split = {"split_on": "year", "bounds": (1950, 2030), "partitions": 16}
    load.export_table(spark, warehouse, "fact_race_result", {"url": "jdbc:x"}, **split)
    assert asked == [split]


def test_command_line(spark, warehouse, capsys, tmp_path):
    from starmart import __main__ as cli

    topic_rows(spark, RESULTS).write.parquet(str(tmp_path / "in"))
    cli.main(["load", "race_result", "--files", str(tmp_path / "in"), "--warehouse", str(tmp_path / "w")])
    cli.main(["page", "standings", "--warehouse", str(tmp_path / "w"), "--year", "2023"])
    cli.main(["check", "--warehouse", str(tmp_path / "w")])
    out = capsys.readouterr().out
    assert "Name Ver" in out and "unique:year,round,driver_id" in out


def test_standings_keep_every_point(spark, warehouse):
    facts_total = spark.read.parquet(f"{warehouse}/fact_race_result").agg({"points": "sum"}).collect()[0][0]
    for mart in ("vw_driver_standings", "vw_team_standings"):
        assert spark.read.parquet(f"{warehouse}/{mart}").agg({"total_points": "sum"}).collect()[0][0] == facts_total


def test_enriched_facts(spark, warehouse):
    results = load.enrich_results(spark, warehouse)
    assert results.count() == 8 and results.filter("driver_name is null or circuit_id is null").count() == 0
    stops = {r.driver_id + str(r.lap_number): r.colour_hex for r in load.enrich_stops(spark, warehouse).collect()}
    assert stops["VER5"] == "#FF0000" and stops["HAM41"] is None


def test_empty_load(spark, tmp_path):
    path = str(tmp_path / "w")
    assert load.load_race_results(spark, topic_rows(spark, []), path) == []
    assert load.load_pit_stops(spark, topic_rows(spark, []), path) == []


def test_pending_event(spark, warehouse):
    schedule = spark.createDataFrame(
        [("2024-03-02", 1, "GP 1"), ("2024-03-09", 2, "GP 2"), ("2024-06-01", 9, "GP 9")],
        "EventDate string, RoundNumber int, EventName string",
    ).withColumn("EventDate", __import__("pyspark.sql.functions", fromlist=["x"]).to_date("EventDate"))
    results = spark.read.parquet(f"{warehouse}/fact_race_result")
    assert load.pending_event(schedule, results, "2024-03-10").count() == 0
    assert rows(load.pending_event(schedule, results, "2024-07-01")) == [(2024, 9, "GP 9")]
    assert load.pending_event(schedule, results, "2024-01-01").count() == 0
