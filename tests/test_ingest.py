"""Lenient decoding, quarantine, cleaning, mappers and selection on hand-made edge cases."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.scalars import entity_key, seconds_between, with_defaults
from starmart.functions.text import encode_json, message_key, parse_time
from starmart.operators import clean, decode, events
from starmart.schemas import message_schema
from starmart.sources import relational, topics


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, value string")


@pytest.mark.parametrize(
    ("text", "value"),
    [("1", 1), ("1.0", 1), ('"1"', 1), ('" 1 "', 1), ("NaN", None), ("null", None), ("1.5", None), ('"x"', None),
     ("99999999999", None), ("1e1", 10), ("true", None), ("-3", -3)],
)
def test_lenient_integers(spark, text, value):
    df = decode.decode_messages(texts(spark, '{"n": %s}' % text), T.StructType.fromDDL("n int"))
    assert [tuple(r) for r in df.collect()] == [(value, None)]


@pytest.mark.parametrize(("text", "value"), [("1.5", 1.5), ('"2"', 2.0), ("NaN", None), ('"NaN"', None), ("null", None)])
def test_lenient_reals(spark, text, value):
    df = decode.decode_messages(texts(spark, '{"n": %s}' % text), T.StructType.fromDDL("n double"))
    assert df.collect()[0].n == value


def test_fields_absent_extra_and_clashing(spark):
    df = decode.decode_messages(
        texts(spark, '{"id": "7", "more": [1]}', "{}"), T.StructType.fromDDL("id int, b boolean"), keep=["value"]
    )
    assert [(r.id, r.b, r._corrupt_record) for r in df.orderBy("value").collect()] == [(7, None, None), (None, None, None)]


def test_broken_messages_are_kept_aside(spark):
    raw = texts(spark, '{"n": 1}', '{"n": 1', "", None, "[1]", "  ")
    good, bad = decode.split_quarantine(decode.decode_messages(raw, T.StructType.fromDDL("n int"), keep=["id"]))
    assert [tuple(r) for r in good.collect()] == [(0, 1)]
    kept = {r.id: (r._reason, r._corrupt_record) for r in bad.collect()}
    assert set(kept) == {1, 2, 3, 4, 5} and {reason for reason, _ in kept.values()} == {"unreadable"}
    assert kept[1][1] == '{"n": 1' and kept[4][1] == "[1]"


def test_filter_on_a_field_parses_once(spark):
    df = decode.decode_messages(texts(spark, '{"n": 1}'), T.StructType.fromDDL("n int")).filter("n = 1")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_values_are_parsed_once_for_themselves_and_for_misfits(spark):
    df = decode.decode_messages(texts(spark, '{"n": 1}'), T.StructType.fromDDL("n int"), misfits=True)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("as double) = ") == 1


def test_texts_that_are_no_number_or_no_object(spark):
    schema = T.StructType.fromDDL("n int, `value_n` double")
    fields = ["third", " 3 ", "+7", "-2.0", ".5e1", "0x1p3", "8d", "inf", "-Infinity", "NAN", "3rd", "١", "1e30", "\u00053"]
    found = decode.decode_messages(texts(spark, *[json.dumps({"n": t, "value_n": t}) for t in fields]), schema, keep=["id"], misfits=True)
    # what Spark's own cast makes of the text, without a test before it
    asked = texts(spark, *fields).select("id", F.col("value").try_cast("double").alias("r"))
    want = {r.id: None if r.r is None or r.r != r.r else r.r for r in asked.collect()}
    rows = {r.id: r for r in found.collect()}
    assert {i: rows[i].value_n for i in want} == want
    whole = {i: int(v) if v is not None and abs(v) < 2**31 and v == int(v) else None for i, v in want.items()}
    assert {i: rows[i].n for i in want} == whole
    for i, t in enumerate(fields):
        lost = [n for n, v in (("n", whole[i]), ("value_n", want[i])) if v is None and t.lower() != "nan"]
        assert rows[i]._misfit == (",".join(lost) or None)
    ends = ['{"n": 1}', ' \t\r\n{"n": 1}\n ', '\x0b{"n": 1}', '{"n": 1}\x0c', '\ufeff{"n": 1}', '{"n": 1', '"n": 1}', '{"n": 1}]', '[{"n": 1}', "}{", "{", "{}"]
    found = decode.decode_messages(texts(spark, *ends), T.StructType.fromDDL("n int"), keep=["id"])
    assert {r.id for r in found.collect() if r._corrupt_record is None} == {0, 1, len(ends) - 1}


def test_json_round_trip_keeps_nulls_and_clears_nan(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (2, "é", 2.5)], "a int, b string, c double")
    got = [json.loads(r.j) for r in df.select(encode_json(df).alias("j")).collect()]
    assert got == [{"a": 1, "b": None, "c": None}, {"a": 2, "b": "é", "c": 2.5}]


def test_message_key_spells_missing_parts(spark):
    df = spark.createDataFrame([(2024, None, "ver")], "y int, r int, d string")
    assert df.select(message_key("y", "r", "d")).collect()[0][0] == "2024_None_ver"


def test_bad_times_become_null(spark):
    df = texts(spark, "2024-03-02T15:00:00.123456", "yesterday", None)
    got = [r.t for r in df.select("id", parse_time(F.col("value")).cast("string").alias("t")).orderBy("id").collect()]
    assert got == ["2024-03-02 15:00:00.123456", None, None]


def test_entity_key(spark):
    df = texts(spark, " ver ", "VER", "", " ", None)
    assert [r.k for r in df.select("id", entity_key(F.col("value")).alias("k")).orderBy("id").collect()] == [
        "VER", "VER", None, None, None,
    ]


def test_flags_at_the_edges(spark):
    rows = [("a", p, None) for p in (1, 2, 10, 11, None)] + [(None, 1, None)]
    df = spark.createDataFrame(rows, "driver_id string, position int, ingested_at string")
    got = sorted((r.position, r.is_winner, r.is_points_finish) for r in clean.clean_flags(df).collect())
    assert got == [(1, True, True), (2, False, True), (10, False, True), (11, False, False)]


def test_newest_result_wins_whatever_the_input_order(spark):
    def row(position, at):
        return (2024, 1, "ver", position, 1.0, at)

    rows = [row(3, "2024-01-01T00:00:00"), row(1, "2024-01-02T00:00:00"), row(1, "2024-01-02T00:00:00"), row(2, "bad")]
    schema = "year int, round int, driver_id string, position int, points double, ingested_at string"
    for order in (rows, rows[::-1]):
        got = clean.clean_results(spark.createDataFrame(order, schema)).collect()
        assert [(r.driver_id, r.position) for r in got] == [("VER", 1)]


def test_defaults_fill_columns_not_nulls(spark):
    df = with_defaults(spark.createDataFrame([(None,)], "a int"), {"a": 5, "b": 6, "c": (None, "double")})
    assert tuple(df.collect()[0]) == (None, 6, None) and df.schema["c"].dataType == T.DoubleType()


def test_seconds_between(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 22, 500001)), (None, dt.datetime(2024, 1, 1))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert [r[0] for r in df.select(seconds_between("a", "b")).collect()] == [22.500001, None]
    assert df.filter("a is not null").select(seconds_between("b", "a")).collect()[0][0] == -22.500001


SESSION = "EventDate date, EventName string, RoundNumber int"
DAY = (dt.date(2024, 3, 2), "GP 1", 1)


def test_mappers_match_the_message_layouts(spark):
    session = spark.createDataFrame([DAY], SESSION)
    lap = session.withColumns({"PitInTime": F.lit(None).cast("timestamp"), "PitOutTime": F.current_timestamp()})
    now = F.lit("2024-03-02 15:00:00").cast("timestamp")
    car = session.withColumns({"DriverId": F.lit("ver"), "SampleNo": F.lit(1)})
    made = {
        "race_result": events.race_result_messages(session, now),
        "pit_stop": events.pit_stop_messages(lap, now),
        "telemetry": events.telemetry_messages(car, now),
        "weather": events.weather_messages(session, now),
    }
    for event_type, df in made.items():
        schema = message_schema(event_type)
        assert df.columns == schema.names
        assert [f.dataType for f in df.schema] == [f.dataType for f in schema]
        row = df.collect()[0]
        assert (row.event_type, row.year, row.gp_name) == (event_type, 2024, "GP 1")
        assert row.ingested_at == "2024-03-02T15:00:00.000000"
        back = decode.decode_messages(topics.to_messages(df, event_type), schema).drop(decode.CORRUPT)
        assert back.collect() == df.collect()


def test_pit_laps_keep_one_sided_stops(spark):
    t = dt.datetime(2024, 3, 2, 15)
    laps = [
        (*DAY, "VER", 10.0, t, None, "SOFT", 9.0),
        (*DAY, "VER", 11.0, None, t + dt.timedelta(seconds=22.5), "HARD", None),
        (*DAY, "VER", 12.0, None, None, "HARD", 2.0),
        (*DAY, "HAM", 5.0, t, t + dt.timedelta(seconds=3), None, float("nan")),
    ]
    schema = SESSION + ", Abbreviation string, LapNumber double, PitInTime timestamp, PitOutTime timestamp, Compound string, TyreLife double"
    df = spark.createDataFrame(laps, schema)
    got = {(r.driver_id, r.lap_number): (r.pit_duration_sec, r.tyre_life) for r in events.pit_stop_messages(df).collect()}
    assert got == {("VER", 10): (None, 9), ("VER", 11): (None, None), ("HAM", 5): (3.0, None)}
    # the stop spans two laps
    paired = events.paired_duration(events.pit_laps(df), ["Abbreviation"], ["LapNumber"], "PitInTime", "PitOutTime")
    assert {(r.Abbreviation, r.LapNumber): r.pit_duration_sec for r in paired.collect()}[("VER", 11.0)] == 22.5


def test_first_keys_in_order_of_appearance(spark):
    rows = [("s", "c", 1), ("s", "a", 2), ("s", "c", 3), ("s", "b", 4), ("s", "d", 5), ("t", "d", 1), ("s", None, 0)]
    df = spark.createDataFrame(rows, "session string, k string, at int")
    # c and d both appear at 1: the key settles the tie
    assert {r.k for r in events.first_n_keys(df, "k", "at", 1).collect()} == {"c"}
    got = events.first_n_keys(df, "k", "at", 3, within=["session"]).collect()
    assert {(r.session, r.k) for r in got} == {("s", "c"), ("s", "a"), ("s", "b"), ("t", "d")}
    assert len(got) == 5


def test_latest_before(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 3, 2), 1), (dt.date(2024, 3, 9), 2), (dt.date(2024, 3, 9), 3)], "d date, n int"
    )
    assert [r.n for r in events.latest_before(df, "d", "2024-03-10", ["n"]).collect()] == [3]
    assert [r.n for r in events.latest_before(df, "d", "2024-03-02", ["n"]).collect()] == [1]
    assert events.latest_before(df, "d", "2024-03-01", ["n"]).collect() == []


def test_missing_units(spark):
    facts = spark.createDataFrame([(2023, 1), (2023, 1), (2024, 2)], "year int, round int")
    expected = events.expected_units(spark, {2023: 2, 2024: 2})
    got = events.missing_units(facts, expected, ["year", "round"])
    assert sorted(map(tuple, got.collect())) == [(2023, 2), (2024, 1)]
    assert events.missing_units(facts.limit(0), events.expected_units(spark), ["year", "round"]).count() == 45


def test_topics(spark):
    df = spark.createDataFrame([("race_result",), ("pit_stop",), ("other",)], "event_type string")
    got = [r[0] for r in df.select(topics.topic_of(F.col("event_type"), "x.")).collect()]
    assert got == ["x.race_results", "x.pit_stops", None]
    assert topics.read_options("h:1", "t", 64)["minPartitions"] == "64"


def test_connection_leaves_out_what_is_not_given():
    assert relational.connection("jdbc:x", user="u") == {"url": "jdbc:x", "user": "u"}


@pytest.mark.parametrize("make", [
    lambda s, e: clean.clean_results(e),
    lambda s, e: clean.team_rank(clean.clean_results(e)),
    lambda s, e: events.first_n_keys(e, "driver_id", "round", 3),
    lambda s, e: events.latest_before(e.withColumn("d", F.current_date()), "d", "2024-01-01", ["round"]),
])
def test_empty_in_empty_out(spark, make):
    empty = spark.createDataFrame([], message_schema("race_result"))
    assert make(spark, empty).collect() == []


def test_latest_before_reaches_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    latest = events.latest_before(orders, "o_orderdate", "1998-06-15", ["o_orderkey"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderdate,1998-06-16T00:00)" in plan and "TakeOrderedAndProject" in plan
