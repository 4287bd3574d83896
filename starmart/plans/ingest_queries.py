"""Decoding, messages, cleaning, sampling and selection over the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.scalars import seconds_between, with_defaults
from starmart.functions.text import encode_json, message_key
from starmart.operators import clean, decode, events, windows
from starmart.plans.registry import plain, query, table
from starmart.sources.topics import to_messages, topic_of

STAMP = "2024-05-01 12:00:00"
STAMP_TEXT = "2024-05-01T12:00:00.000000"


def _stamp():
    return F.lit(STAMP).cast("timestamp_ntz")


@query(
    """SELECT event_id, k FROM (
           SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
       WHERE k IS NOT NULL"""
)
def decode_events(spark, sf_dir):
    schema = T.StructType.fromDDL("k int")
    decoded = decode.decode_messages(table(spark, sf_dir, "events"), schema, value="props", keep=["event_id"])
    return plain(decoded.filter(F.col("k").isNotNull()).select("event_id", "k"))


@query(
    """SELECT o_custkey || '_' || o_orderkey AS key, o_orderkey, o_custkey, o_orderstatus, o_totalprice,
              strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
       FROM orders"""
)
def message_roundtrip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    messages = orders.select(
        message_key("o_custkey", "o_orderkey").cast("binary").alias("key"),
        encode_json(orders).cast("binary").alias("value"),
    )
    decoded = decode.decode_messages(messages, orders.schema, keep=["key"])
    return plain(decoded.drop(decode.CORRUPT).withColumn("key", F.col("key").cast("string")))


@query(
    f"""SELECT 'race_result' AS event_type, CAST(year(o_orderdate) AS BIGINT) AS year, o_orderpriority AS gp_name,
               CAST(month(o_orderdate) AS BIGINT) AS round, CAST(o_custkey AS VARCHAR) AS driver_id,
               c_name || ' ' || c_mktsegment AS driver_name, c_mktsegment AS team,
               CAST(o_orderkey % 20 AS BIGINT) AS position, o_totalprice AS points, o_orderstatus AS status,
               '' AS fastest_lap, '{STAMP_TEXT}' AS ingested_at
        FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def event_messages(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    results = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderdate").alias("EventDate"),
        F.col("o_orderpriority").alias("EventName"),
        F.month("o_orderdate").alias("RoundNumber"),
        F.col("o_custkey").cast("string").alias("DriverId"),
        F.col("c_name").alias("FirstName"),
        F.col("c_mktsegment").alias("LastName"),
        F.col("c_mktsegment").alias("TeamName"),
        (F.col("o_orderkey") % 20).cast("double").alias("Position"),
        F.col("o_totalprice").alias("Points"),
        F.col("o_orderstatus").alias("Status"),
    )
    return plain(events.race_result_messages(results, _stamp()))


@query(
    f"""SELECT 'pit_stop' AS event_type, CAST(year(l_shipdate) AS BIGINT) AS year, 'GP ' || l_linestatus AS gp_name,
               CAST(month(l_shipdate) AS BIGINT) AS round, CAST(l_suppkey AS VARCHAR) AS driver_id,
               CAST(l_linenumber AS BIGINT) AS lap_number,
               CASE WHEN l_linestatus = 'O' AND l_returnflag <> 'N' THEN l_quantity END AS pit_duration_sec,
               l_returnflag AS compound, CAST(l_quantity AS BIGINT) AS tyre_life, '{STAMP_TEXT}' AS ingested_at
        FROM lineitem WHERE l_linestatus = 'O' OR l_returnflag <> 'N'"""
)
def pit_messages(spark, sf_dir):
    start = F.when(F.col("l_linestatus") == "O", F.col("l_shipdate"))
    end = F.when(F.col("l_returnflag") != "N", F.timestamp_add("SECOND", F.col("l_quantity").cast("int"), "l_shipdate"))
    laps = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("EventDate"),
        F.concat_ws(" ", F.lit("GP"), "l_linestatus").alias("EventName"),
        F.month("l_shipdate").alias("RoundNumber"),
        F.col("l_suppkey").cast("string").alias("Abbreviation"),
        F.col("l_linenumber").cast("double").alias("LapNumber"),
        start.alias("PitInTime"),
        end.alias("PitOutTime"),
        F.col("l_returnflag").alias("Compound"),
        F.col("l_quantity").alias("TyreLife"),
    )
    return plain(events.pit_stop_messages(laps, _stamp()))


@query(
    f"""WITH first_users AS (
        SELECT event_type, user_id FROM (
            SELECT event_type, user_id,
                   row_number() OVER (PARTITION BY event_type ORDER BY min(event_id), user_id) AS nth
            FROM events GROUP BY event_type, user_id)
        WHERE nth <= 3),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS rn
        FROM events JOIN first_users USING (event_type, user_id))
    SELECT 'telemetry' AS event_type, CAST(year(ts) AS BIGINT) AS year, event_type AS gp_name,
           CAST(user_id AS VARCHAR) AS driver_id, value AS speed_kmh, 0.0::DOUBLE AS throttle_pct,
           value > 50 AS brake, CAST(0 AS BIGINT) AS drs, CAST(month(ts) AS BIGINT) AS gear, 0.0::DOUBLE AS rpm,
           0.0::DOUBLE AS x, 0.0::DOUBLE AS y, event_id AS sample_no, '{STAMP_TEXT}' AS ingested_at
    FROM numbered WHERE (rn - 1) % 10 = 0"""
)
def telemetry_messages(spark, sf_dir):
    samples = table(spark, sf_dir, "events").select(
        F.col("ts").alias("EventDate"),
        F.col("event_type").alias("EventName"),
        F.col("user_id").cast("string").alias("DriverId"),
        F.col("value").alias("Speed"),
        (F.col("value") > 50).alias("Brake"),
        F.month("ts").cast("double").alias("nGear"),
        F.col("event_id").alias("SampleNo"),
    )
    messages = events.telemetry_messages(samples, _stamp(), drivers=3, sample_rate=10, session=["EventName"])
    return plain(messages)


@query(
    f"""SELECT 'weather' AS event_type, CAST(year(ts) AS BIGINT) AS year, event_type AS gp_name, value AS air_temp_c,
               CASE WHEN value > 20 THEN value END AS track_temp_c, 0.0::DOUBLE AS humidity_pct,
               0.0::DOUBLE AS wind_speed_ms, event_type = 'error' AS rainfall,
               CAST(event_id AS VARCHAR) AS sampled_at, '{STAMP_TEXT}' AS ingested_at
        FROM events"""
)
def weather_messages(spark, sf_dir):
    samples = table(spark, sf_dir, "events").select(
        F.col("ts").alias("EventDate"),
        F.col("event_type").alias("EventName"),
        F.col("value").alias("AirTemp"),
        F.when(F.col("value") > 20, F.col("value")).otherwise(F.lit(float("nan"))).alias("TrackTemp"),
        (F.col("event_type") == "error").alias("Rainfall"),
        F.col("event_id").alias("Time"),
    )
    return plain(events.weather_messages(samples, _stamp()))


@query(
    """SELECT CASE event_type WHEN 'purchase' THEN 'x.sales' WHEN 'view' THEN 'x.traffic' WHEN 'click' THEN 'x.traffic'
                   WHEN 'error' THEN 'x.faults' END AS topic,
              strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_rows
       FROM events GROUP BY 1, 2"""
)
def topic_routing(spark, sf_dir):
    topics = {"purchase": "sales", "view": "traffic", "click": "traffic", "error": "faults"}
    routed = table(spark, sf_dir, "events").select(
        topic_of(F.col("event_type"), "x.", topics).alias("topic"), F.date_format("ts", "yyyy-MM-dd").alias("day")
    )
    return plain(events.unit_counts(routed, ["topic", "day"]))


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag || l_linestatus AS driver_id,
              CAST(l_linenumber AS BIGINT) AS position, l_linenumber = 1 AS is_winner,
              l_linenumber <= 3 AS is_points_finish,
              CASE WHEN l_linestatus = 'O' THEN strftime(l_shipdate, '%Y-%m-%d') END AS shipped
       FROM lineitem WHERE l_linenumber <> 7 AND l_returnflag <> 'N'"""
)
def clean_flags(spark, sf_dir):
    spelled = F.concat(F.lit(" "), F.lower("l_returnflag"), F.lower("l_linestatus"))
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.when(F.col("l_returnflag") != "N", spelled).otherwise(F.lit(" ")).alias("driver_id"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("position"),
        F.when(F.col("l_linestatus") == "O", shipped).otherwise(F.lit("not a time")).alias("ingested_at"),
    )
    flagged = clean.clean_flags(lines, last_points_position=3)
    return plain(flagged.withColumn("shipped", F.date_format("ingested_at", "yyyy-MM-dd")).drop("ingested_at"))


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, value FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
       WHERE (rn - 1) % 50 = 0"""
)
def every_nth(spark, sf_dir):
    samples = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return plain(windows.every_nth(samples, ["user_id"], ["ts", "event_id"], 50))


@query(
    """WITH first_users AS (
        SELECT user_id FROM events GROUP BY user_id ORDER BY min(ts), user_id LIMIT 3)
    SELECT event_id, user_id, event_type, value FROM events WHERE user_id IN (SELECT user_id FROM first_users)"""
)
def first_n_keys(spark, sf_dir):
    samples = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return plain(events.first_n_keys(samples, "user_id", "ts", 3).drop("ts"))


@query(
    """SELECT event_id, user_id,
              (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1e6
                  AS pit_duration_sec
       FROM events"""
)
def paired_duration(spark, sf_dir):
    laps = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    paired = events.paired_duration(laps, ["user_id"], ["ts", "event_id"], in_time="ts", out_time="ts")
    return plain(paired.drop("ts"))


@query(
    """SELECT o_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
              (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1e6 AS seconds
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def same_row_duration(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"
    )
    joined = lines.join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey")
    seconds = seconds_between("o_orderdate", "l_shipdate").alias("seconds")
    return plain(joined.select("o_orderkey", "l_partkey", "l_suppkey", "l_linenumber", seconds))


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(nullif(l_linenumber, 1) AS BIGINT) AS in_lap,
              nullif(l_returnflag, 'R') AS out_flag, CAST(0 AS BIGINT) AS tyre_life
       FROM lineitem WHERE nullif(l_linenumber, 1) IS NOT NULL OR nullif(l_returnflag, 'R') IS NOT NULL"""
)
def or_null_filter(spark, sf_dir):
    laps = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.nullif(F.col("l_linenumber"), F.lit(1)).alias("in_lap"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("out_flag"),
    )
    # in_lap exists, so its default must not fill the nulls
    return plain(with_defaults(events.pit_laps(laps, "in_lap", "out_flag"), {"tyre_life": 0, "in_lap": -1}))


@query(
    """SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
       WHERE o_orderdate <= DATE '1998-06-15' ORDER BY orders.o_orderdate DESC, o_orderkey DESC LIMIT 1"""
)
def latest_before(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    latest = events.latest_before(orders, "o_orderdate", "1998-06-15", ["o_orderkey"])
    return plain(latest.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")))


@query(
    """SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM (
           SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth
           FROM orders WHERE o_orderdate <= DATE '1998-06-15')
       WHERE nth = 1"""
)
def latest_before_each(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    latest = events.latest_before(orders, "o_orderdate", "1998-06-15", ["o_orderkey"], by=["o_custkey"])
    return plain(latest.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")))


@query(
    """SELECT y AS year, m AS round
       FROM (SELECT unnest(range(1995, 2002)) AS y) CROSS JOIN (SELECT unnest(range(1, 13)) AS m)
       EXCEPT SELECT year(o_orderdate), month(o_orderdate) FROM orders"""
)
def missing_units(spark, sf_dir):
    facts = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("round")
    )
    expected = events.expected_units(spark, {year: 12 for year in range(1995, 2002)})
    return plain(events.missing_units(facts, expected, ["year", "round"]))


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as messages; those of errors are cut off, those of signups are empty."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.expr("left(props, length(props) - 1)"))
        .when(kind == "signup", F.lit(""))
        .when(kind == "view", F.regexp_replace("props", "([0-9]+)", '"$1.0"'))
        .otherwise(F.col("props"))
    )
    return table(spark, sf_dir, "events").select("event_id", text.cast("binary").alias("value"))


@query(
    """SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE k END AS k,
              CASE WHEN event_type IN ('error', 'signup') THEN 'unreadable' WHEN k < 50 THEN 'k_at_least_50' END AS _reason
       FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""
)
def quarantine_split(spark, sf_dir):
    decoded = decode.decode_messages(mixed_messages(spark, sf_dir), T.StructType.fromDDL("k int"), keep=["event_id"])
    good, bad = decode.split_quarantine(decoded, {"k_at_least_50": F.col("k") >= 50})
    good = good.withColumn(decode.REASON, F.lit(None).cast("string"))
    return plain(good.unionByName(bad.drop(decode.CORRUPT)))


@query(
    """SELECT 'weather' AS topic, year(ts) || '_' || event_type AS key, count(*) AS n_rows FROM events GROUP BY 2"""
)
def keyed_messages(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.year("ts").alias("year"), F.col("event_type").alias("gp_name"), "value")
    messages = to_messages(rows, "weather").withColumn("key", F.col("key").cast("string"))
    return plain(events.unit_counts(messages, ["topic", "key"]))


@query(
    """
    SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) AS position_no
    FROM orders
    """
)
def string_positions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderkey")
    return plain(windows.position_within(orders, ["o_custkey"], ["o_orderpriority", "o_orderkey"]).select("o_orderkey", "position_no"))


@query(
    """
    SELECT o_orderkey, rank() OVER (PARTITION BY o_orderpriority ORDER BY CAST(o_orderdate AS DATE) DESC NULLS LAST) AS newest_rank
    FROM orders
    """
)
def date_ranks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", F.col("o_orderdate").cast("date").alias("day"), "o_orderkey")
    return plain(windows.rank_within(orders, ["o_orderpriority"], "day", "newest_rank").select("o_orderkey", "newest_rank"))


@query(
    """
    SELECT CASE o_orderkey % 7 WHEN 1 THEN 'misfit:position' WHEN 2 THEN 'misfit:position,points' WHEN 3 THEN 'unreadable'
                               WHEN 4 THEN 'unreadable' WHEN 5 THEN 'missing_points' END AS reason,
           count(*) AS messages
    FROM orders GROUP BY 1
    """
)
def quarantine_fields(spark, sf_dir):
    """Messages with a broken field, a second object or text behind the first, and what is said of them."""
    at = F.col("o_orderkey") % 7
    bad = {
        1: '{"position": 1.5, "points": 3}',
        2: '{"position": "x", "points": "abc"}',
        3: '{"position": 1, "points": 3} {"position": 2, "points": 4}',
        4: '{"position": 1, "points": 3} trailing',
        5: '{"position": 1, "points": NaN}',
        6: '{"position": "2.0", "points": 3}  ',
    }
    # closing the brackets that the decoder puts around a text must not hide what follows
    hidden = ['{"position": 1, "points": 3}] trailing', '{"position": 1, "points": 3}],[{"position": 2}', '{"position": 1, "points": 3} ] {"position": 2}']
    bad[4] = F.element_at(F.array(*[F.lit(t) for t in [bad[4], *hidden]]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    value = F.lit('{"position": 7, "points": 1.5}')
    for number, text in bad.items():
        value = F.when(at == number, text if isinstance(text, Column) else F.lit(text)).otherwise(value)
    schema = T.StructType([T.StructField("position", T.IntegerType()), T.StructField("points", T.DoubleType())])
    rows = decode.decode_messages(table(spark, sf_dir, "orders").select(value.alias("value")), schema, misfits=True)
    marked = decode.with_reason(rows, {"missing_points": F.col("points").isNotNull()})
    return plain(marked.groupBy(F.col(decode.REASON).alias("reason")).agg(F.count(F.lit(1)).alias("messages")))
