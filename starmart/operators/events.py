"""Raw session tables to event messages, and choosing what to process."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.scalars import seconds_between, with_defaults
from starmart.functions.text import nan_to_null
from starmart.operators.windows import every_nth, previous_value
from starmart.schemas import SEASON_ROUNDS

# Each mapper expects the session's columns (EventDate, EventName, RoundNumber) on every row.


def _stamp(now: Column | None) -> Column:
    return F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _number(name: str) -> Column:
    return nan_to_null(F.col(name).try_cast("double"))


def _whole(name: str) -> Column:
    return F.col(name).try_cast("double").try_cast("int")


def race_result_messages(results: DataFrame, now: Column | None = None) -> DataFrame:
    # --- fixed values: what a field is when its column is absent ---
    rows = with_defaults(
        results,
        {
            "DriverId": "", "FirstName": "", "LastName": "", "TeamName": "", "Position": (None, "int"),
            "Points": 0, "Status": "", "FastestLapTime": "",
        },
    )
    return rows.select(
        F.lit("race_result").alias("event_type"),
        F.year("EventDate").alias("year"),
        F.col("EventName").alias("gp_name"),
        F.col("RoundNumber").cast("int").alias("round"),
        F.col("DriverId").alias("driver_id"),
        F.concat_ws(" ", "FirstName", "LastName").alias("driver_name"),
        F.col("TeamName").alias("team"),
        _whole("Position").alias("position"),
        _number("Points").alias("points"),
        F.col("Status").alias("status"),
        F.col("FastestLapTime").cast("string").alias("fastest_lap"),
        _stamp(now).alias("ingested_at"),
    )


def pit_laps(laps: DataFrame, in_time: str = "PitInTime", out_time: str = "PitOutTime") -> DataFrame:
    """Laps on which the pit was entered or left."""
    return laps.filter(F.col(in_time).isNotNull() | F.col(out_time).isNotNull())


def pit_stop_messages(laps: DataFrame, now: Column | None = None, driver: str = "Abbreviation") -> DataFrame:
    """One message per pit lap; the duration is that of the lap's own in and out times."""
    # --- fixed values: what a field is when its column is absent ---
    rows = with_defaults(
        laps,
        {
            driver: "", "LapNumber": 0, "PitInTime": (None, "timestamp"), "PitOutTime": (None, "timestamp"),
            "Compound": "", "TyreLife": 0,
        },
    )
    return pit_laps(rows).select(
        F.lit("pit_stop").alias("event_type"),
        F.year("EventDate").alias("year"),
        F.col("EventName").alias("gp_name"),
        F.col("RoundNumber").cast("int").alias("round"),
        F.col(driver).alias("driver_id"),
        _whole("LapNumber").alias("lap_number"),
        seconds_between("PitInTime", "PitOutTime").alias("pit_duration_sec"),
        F.col("Compound").alias("compound"),
        _whole("TyreLife").alias("tyre_life"),
        _stamp(now).alias("ingested_at"),
    )


def telemetry_messages(
    samples: DataFrame,
    now: Column | None = None,
    drivers: int | None = 3,
    sample_rate: int = 50,
    session: list[str] = ["EventDate", "EventName", "RoundNumber"],
    order_by: str = "SampleNo",
) -> DataFrame:
    """One message per ``sample_rate`` samples of the first ``drivers`` drivers of each session (all if None)."""
    rows = samples
    if drivers is not None:
        rows = first_n_keys(rows, "DriverId", order_by, drivers, within=session)
    rows = every_nth(rows, [*session, "DriverId"], [order_by], sample_rate)
    # --- fixed values: what a field is when its column is absent ---
    rows = with_defaults(
        rows,
        {"Speed": 0.0, "Throttle": 0.0, "Brake": False, "DRS": 0, "nGear": 0, "RPM": 0.0, "X": 0.0, "Y": 0.0},
    )
    return rows.select(
        F.lit("telemetry").alias("event_type"),
        F.year("EventDate").alias("year"),
        F.col("EventName").alias("gp_name"),
        F.col("DriverId").alias("driver_id"),
        _number("Speed").alias("speed_kmh"),
        _number("Throttle").alias("throttle_pct"),
        F.col("Brake").try_cast("boolean").alias("brake"),
        _whole("DRS").alias("drs"),
        _whole("nGear").alias("gear"),
        _number("RPM").alias("rpm"),
        _number("X").alias("x"),
        _number("Y").alias("y"),
        F.col(order_by).cast("bigint").alias("sample_no"),
        _stamp(now).alias("ingested_at"),
    )


def weather_messages(samples: DataFrame, now: Column | None = None) -> DataFrame:
    # --- fixed values: what a field is when its column is absent ---
    rows = with_defaults(
        samples,
        {
            "AirTemp": 0.0, "TrackTemp": 0.0, "Humidity": 0.0, "WindSpeed": 0.0, "Rainfall": False,
            "Time": (None, "timestamp"),
        },
    )
    return rows.select(
        F.lit("weather").alias("event_type"),
        F.year("EventDate").alias("year"),
        F.col("EventName").alias("gp_name"),
        _number("AirTemp").alias("air_temp_c"),
        _number("TrackTemp").alias("track_temp_c"),
        _number("Humidity").alias("humidity_pct"),
        _number("WindSpeed").alias("wind_speed_ms"),
        F.col("Rainfall").try_cast("boolean").alias("rainfall"),
        F.col("Time").cast("string").alias("sampled_at"),
        _stamp(now).alias("ingested_at"),
    )


def paired_duration(
    laps: DataFrame, keys: list[str], order_by: list[str], in_time: str, out_time: str, out: str = "pit_duration_sec"
) -> DataFrame:
    """Seconds from the previous row's ``in_time`` to this row's ``out_time`` within ``keys``.

    In and out times of one stop sit on consecutive laps; `seconds_between` is the same-lap form.
    """
    paired = previous_value(laps, keys, order_by, in_time, "__previous_in")
    return paired.withColumn(out, seconds_between("__previous_in", out_time)).drop("__previous_in")


def first_n_keys(df: DataFrame, key: str, order_by: str, n: int, within: list[str] | None = None) -> DataFrame:
    """All rows of the first ``n`` distinct keys in order of appearance (of each group of ``within``).

    Ties in the order are settled by the key itself. The kept keys are at most n per group;
    without groups that is a fixed bound, and they are broadcast.
    """
    within = within or []
    seen = df.filter(F.col(key).isNotNull()).groupBy(*within, key).agg(F.min(order_by).alias("__first"))
    order = [F.col("__first").asc_nulls_last(), F.col(key).asc()]
    if within:
        nth = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
        first = seen.withColumn("__nth", nth).filter(F.col("__nth") <= n).select(*within, key)
    else:
        first = seen.orderBy(*order).limit(n).select(key)
        if n <= 10_000:
            first = F.broadcast(first)
    return df.join(first, [*within, key], "left_semi")


def latest_before(df: DataFrame, date: str, as_of: str, tie_break: list[str], by: list[str] | None = None) -> DataFrame:
    """The last row dated on or before ``as_of`` (per group of ``by``); empty if there is none."""
    last_day = F.to_date(F.lit(as_of))
    kind = df.schema[date].dataType
    # compared in the column's own type, so that the filter reaches the scan
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        past = df.filter(F.col(date) < F.date_add(last_day, 1).cast(kind))
    else:
        past = df.filter(F.col(date).cast("date") <= last_day)
    order = [F.col(date).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_break]]
    if not by:
        return past.orderBy(*order).limit(1)
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return past.withColumn("__nth", nth).filter("__nth = 1").drop("__nth")


def expected_units(spark: SparkSession, seasons: dict[int, int] = SEASON_ROUNDS) -> DataFrame:
    """(year, round) pairs that should exist: rounds 1..n of each season."""
    plan = F.array(*[F.struct(F.lit(y).alias("year"), F.lit(n).alias("rounds")) for y, n in seasons.items()])
    season = spark.range(1).select(F.inline(plan))
    return season.select("year", F.explode(F.sequence(F.lit(1), F.col("rounds"))).alias("round"))


def missing_units(facts: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Expected units that have no fact row."""
    return expected.join(facts.select(*keys).distinct(), keys, "left_anti")


def unit_counts(facts: DataFrame, by: list[str] = ["year", "round", "event_type"], out: str = "n_rows") -> DataFrame:
    """Rows per ingested unit."""
    return facts.groupBy(*by).agg(F.count(F.lit(1)).alias(out))
