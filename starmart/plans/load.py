"""The load: topic rows to star-schema tables and marts under one warehouse folder.

Every step can be repeated: facts are upserted by natural key, dimensions merged, marts
rewritten for the seasons touched. A message is decoded once, into a staged table that all
later steps read.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.scalars import entity_key
from starmart.functions.text import parse_time
from starmart.operators import clean, decode, deltas, dims, events, facts, marts, quality
from starmart.schemas import (
    CLUSTERED_BY,
    FALSE_BY_DEFAULT,
    MAX_LENGTH,
    NATURAL_KEY,
    NOT_NULL,
    NOW_BY_DEFAULT,
    PARTITIONED_BY,
    SORTED_BY,
    SURROGATE_KEY,
    message_schema,
    table_schema,
)
from starmart.sources import layout, versions
from starmart.sources.relational import append_relation, read_relation
from starmart.sources.staging import cleans_up, stage
from starmart.sources.tables import (
    append_table,
    partition_values,
    read_table,
    touched_partitions,
    upsert_table,
)
from starmart.plans.mart_updates import seasons_in, update_marts
from starmart.streaming.streams import each_batch

log = logging.getLogger(__name__)

FACT_OF = {
    "race_result": "fact_race_result",
    "pit_stop": "fact_pit_stop",
    "telemetry": "fact_telemetry",
    "weather": "fact_weather",
}


# why a readable row is not stored
DROPPED = "_lacking"

# partitions of the driver dimension; a load rewrites those that it has drivers of
SHARD, DRIVER_SHARDS = "shard", 16

# facts that marts follow by their changes
FOLLOWED = ("fact_race_result", "fact_pit_stop")

# parts of the natural key that the tables allow to be missing, but without which rows cannot be told apart
NEEDED = {"pit_stop": ["driver_id"], "telemetry": ["driver_id"]}


# where a message came from; with them a message that is read again is known
ORIGIN = ["topic", "partition", "offset"]
MESSAGE_HASH = "_message_hash"


def decode_and_split(raw: DataFrame, event_type: str, warehouse: str, needed: dict[str, Column] | None = None) -> DataFrame:
    """Decode once, keep aside what cannot be stored, return the rest.

    Unreadable messages and values that do not fit go to ``quarantine/<event type>`` with a reason; rows that lack what
    ``needed`` asks for go to ``dropped/<event type>``. Reading the same messages again adds nothing there. Counts by reason
    are appended to the table ``loads``.
    """
    spark, fact = raw.sparkSession, FACT_OF[event_type]
    origin = [c for c in ORIGIN if c in raw.columns]
    told = raw.withColumn(MESSAGE_HASH, F.xxhash64("value"))
    rows = stage(decode.decode_messages(told, message_schema(event_type), keep=[*origin, MESSAGE_HASH], misfits=True), event_type)
    sized = {f.name: f.dataType.simpleString() for f in table_schema(fact) if f.name in rows.columns}
    sized.pop("ingested_at", None)
    sized.pop("sampled_at", None)
    broken = quality.row_rules(not_null=NOT_NULL.get(fact), types=sized)
    broken |= {f"not_null:{c}": entity_key(F.col(c)).isNull() for c in NEEDED.get(event_type, [])}
    # a race's number in a fact key has no room for a sign
    broken |= {f"range:{c}": F.col(c) < 0 for c in ("year", "round") if c in rows.columns and fact in SURROGATE_KEY}
    marked = decode.with_reason(rows, {name: ~condition for name, condition in broken.items()})
    lacking = F.concat_ws(",", *[F.when(~holds, F.lit(name)) for name, holds in (needed or {}).items()])
    marked = marked.withColumn(DROPPED, F.when(F.col(decode.REASON).isNull(), F.nullif(lacking, F.lit(""))))
    # there are as many reasons as rules
    counts = marked.groupBy(decode.REASON, DROPPED).agg(F.count(F.lit(1)).alias("messages"))
    tally = [(event_type, "quarantined" if r[0] else "dropped" if r[1] else "good", r[0] or r[1], r[2]) for r in counts.collect()]
    log.info("%s: %s", event_type, tally)
    told = spark.createDataFrame(tally, "event_type string, outcome string, reason string, messages bigint")
    append_table(told.withColumn("loaded_at", F.current_timestamp()), f"{warehouse}/loads", [])
    if any(t[1] == "quarantined" for t in tally):
        bad = marked.filter(F.col(decode.REASON).isNotNull()).drop(DROPPED)
        keep_aside(spark, bad.withColumn("_quarantined_at", F.current_timestamp()), f"{warehouse}/quarantine/{event_type}")
    if any(t[1] == "dropped" for t in tally):
        dropped = marked.filter(F.col(DROPPED).isNotNull()).drop(decode.REASON, decode.CORRUPT, decode.MISFIT)
        keep_aside(spark, dropped.withColumn("_dropped_at", F.current_timestamp()), f"{warehouse}/dropped/{event_type}")
    good = marked.filter(F.col(decode.REASON).isNull() & F.col(DROPPED).isNull())
    return good.drop(decode.REASON, decode.CORRUPT, decode.MISFIT, DROPPED, MESSAGE_HASH, *origin)


def keep_aside(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Append the messages that are not there yet. Without an offset a message cannot be told from another like it: all are kept."""
    if "offset" in rows.columns:
        key = [c for c in [*ORIGIN, MESSAGE_HASH] if c in rows.columns]
        rows = rows.dropDuplicates(key)
        known = read_table(spark, path)
        if known is not None and set(key) <= set(known.columns):
            known = known.select(*[F.col(c).alias(f"__known_{c}") for c in key])
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__known_{c}")) for c in key])
            rows = rows.join(known, same, "left_anti")
    append_table(rows, path, [])


def _to_fact(rows: DataFrame, table: str, now: Column | None) -> DataFrame:
    return facts.conform(rows, table_schema(table), now, FALSE_BY_DEFAULT.get(table), NOW_BY_DEFAULT.get(table))


def _unique(rows: DataFrame, table: str) -> DataFrame:
    return stage(facts.latest_per_key(rows, NATURAL_KEY[table], ["ingested_at"]), table)


def store_fact(spark: SparkSession, warehouse: str, table: str, rows: DataFrame) -> None:
    """Upsert rows that are unique by natural key; a row that replaces another keeps its key.

    ``rows`` is read more than once: pass a scan of a staged table.
    """
    path, keys, parts = f"{warehouse}/{table}", NATURAL_KEY[table], PARTITIONED_BY[table]
    values = partition_values(rows, parts)
    key = SURROGATE_KEY.get(table)
    if key:
        known = read_table(spark, path, table_schema(table))
        if known is None:
            known = spark.createDataFrame([], table_schema(table))
        known = touched_partitions(known, rows, parts, values)
        race = F.shiftleft(F.col("year").cast("bigint"), dims.ROUND_BITS) + F.col("round")
        rows = dims.assign_fact_keys(rows, keys, key, race, known).select(*table_schema(table).names)
    upsert_table(spark, path, rows, keys, ["ingested_at"], parts, SORTED_BY[table], values, keep_changes=table in FOLLOWED)


def store_dimension(spark: SparkSession, warehouse: str, table: str, incoming: DataFrame) -> None:
    """Insert rows whose natural key is new; rows that are there stay as they are."""
    path, schema = f"{warehouse}/{table}", table_schema(table)
    existing = read_table(spark, path, schema)
    if existing is None:
        existing = spark.createDataFrame([], schema)
    added = stage(dims.absent_rows(existing, incoming, NATURAL_KEY[table]), table)
    key = SURROGATE_KEY.get(table)
    if key:
        added = dims.assign_keys(added, NATURAL_KEY[table], key, existing)
    append_table(facts.conform(added, schema), path, [], NATURAL_KEY[table])


def store_drivers(spark: SparkSession, warehouse: str, results: DataFrame) -> None:
    """Merge drivers into the dimension. It lies in shards by a hash of the key; those without a driver of this load stay as they are."""
    path, schema = f"{warehouse}/dim_driver", table_schema("dim_driver")
    seen = results.groupBy("driver_id").agg(
        F.min("ingested_at").alias("created_at"),
        F.max("ingested_at").alias("updated_at"),
        F.max(F.struct(F.col("year").alias("last_year"), F.col("round").alias("last_round"))).alias("last"),
    )
    current = dims.driver_dimension(results).join(seen.select("*", "last.*").drop("last"), "driver_id")
    incoming = stage(in_shards(facts.conform(current, schema)), "dim_driver")
    before = versions.adopt(spark, path, [SHARD])
    known = versions.read_version(spark, path, before, incoming.schema)
    merged = dims.merge_drivers(touched_partitions(known, incoming, [SHARD]).select(*schema.names), incoming.select(*schema.names))
    versions.replace_partitions(in_shards(merged.select(*schema.names)), path, [SHARD], ["driver_id"], before)


def in_shards(drivers: DataFrame) -> DataFrame:
    return drivers.withColumn(SHARD, F.pmod(F.xxhash64("driver_id"), F.lit(DRIVER_SHARDS)).cast("int"))


@cleans_up
def load_race_results(spark: SparkSession, raw: DataFrame, warehouse: str, now: Column | None = None) -> list[int]:
    """Results into drivers, circuits, teams and the result fact; returns the seasons touched."""
    needed = {"driver_id": entity_key(F.col("driver_id")).isNotNull(), "position": F.col("position").isNotNull()}
    good = decode_and_split(raw, "race_result", warehouse, needed)
    results = stage(clean.clean_results(good), "results")
    store_drivers(spark, warehouse, results)
    store_dimension(spark, warehouse, "dim_circuit", dims.circuit_dimension(results))
    store_dimension(spark, warehouse, "dim_team", dims.team_dimension(results))
    store_fact(spark, warehouse, "fact_race_result", _to_fact(results, "fact_race_result", now))
    return seasons_in(results)


@cleans_up
def load_pit_stops(spark: SparkSession, raw: DataFrame, warehouse: str, now: Column | None = None) -> list[int]:
    good = decode_and_split(raw, "pit_stop", warehouse)
    stops = good.withColumns(
        {"driver_id": entity_key(F.col("driver_id")), "ingested_at": parse_time(F.col("ingested_at"))}
    )
    stops = _unique(_to_fact(stops, "fact_pit_stop", now), "fact_pit_stop")
    store_dimension(spark, warehouse, "dim_tyre", dims.tyre_seed(spark))
    store_fact(spark, warehouse, "fact_pit_stop", stops)
    return seasons_in(stops)


def content_id(rows: DataFrame, sample: str) -> Column:
    """Hash of a row's content, which tells rows without a key of their own apart.

    The ingest time is left out where the row says when (or as which number) it was sampled,
    so that reading the source again adds nothing. Without that it is the only thing that
    tells two equal samples apart.
    """
    content = [F.col(c).cast("string") for c in rows.columns if c != "ingested_at"]
    told_apart = F.when(F.col(sample).isNull(), F.col("ingested_at").cast("string"))
    return F.sha2(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in [*content, told_apart]]), 256)


@cleans_up
def load_telemetry(spark: SparkSession, raw: DataFrame, warehouse: str, now: Column | None = None) -> list[int]:
    good = decode_and_split(raw, "telemetry", warehouse)
    numbered = F.col("sample_no").cast("string")
    samples = good.withColumns(
        {
            "sample_id": F.coalesce(numbered, content_id(good, "sample_no")),
            "driver_id": entity_key(F.col("driver_id")),
            "ingested_at": parse_time(F.col("ingested_at")),
        }
    )
    samples = _unique(_to_fact(samples, "fact_telemetry", now), "fact_telemetry")
    store_fact(spark, warehouse, "fact_telemetry", samples)
    return seasons_in(samples)


@cleans_up
def load_weather(spark: SparkSession, raw: DataFrame, warehouse: str, now: Column | None = None) -> list[int]:
    """Weather samples have no key of their own: the hash of their content is one, so a replay adds nothing."""
    good = decode_and_split(raw, "weather", warehouse)
    samples = good.withColumns(
        {
            "weather_id": content_id(good, "sampled_at"),
            "sampled_at": parse_time(F.col("sampled_at")),
            "ingested_at": parse_time(F.col("ingested_at")),
        }
    )
    samples = _unique(_to_fact(samples, "fact_weather", now), "fact_weather")
    store_fact(spark, warehouse, "fact_weather", samples)
    return seasons_in(samples)


LOADERS = {
    "race_result": load_race_results,
    "pit_stop": load_pit_stops,
    "telemetry": load_telemetry,
    "weather": load_weather,
}


def load_stream(
    spark: SparkSession, raw: DataFrame, event_type: str, warehouse: str, checkpoint: str
) -> None:
    """The same load on a stream of topic rows, batch by batch, marts included, which take only what a batch changes.

    Batches may be handed over twice after a failure; the load is repeatable, so nothing doubles.
    """

    def handle(batch: DataFrame, _batch_id: int) -> None:
        LOADERS[event_type](batch.sparkSession, batch, warehouse)
        update_marts(batch.sparkSession, warehouse)

    each_batch(raw, checkpoint, handle)


@cleans_up
def export_table(spark: SparkSession, warehouse: str, table: str, link: dict, **split) -> None:
    """Append to a relational table the rows whose natural key it does not have yet.

    Its keys are read over one connection, or with ``split`` (split_on, bounds, partitions of `read_relation`) over several.
    """
    rows = read_table(spark, f"{warehouse}/{table}", table_schema(table))
    keys = NATURAL_KEY[table]
    known = read_relation(spark, link, table, **split).select(*[F.col(c).cast(rows.schema[c].dataType) for c in keys])
    append_relation(stage(rows.join(known, keys, "left_anti"), "export"), link, table)


def lay_out(spark: SparkSession, warehouse: str, table: str, seasons: list[int] | None = None) -> versions.Manifest | None:
    """Rewrite a fact table's partitions (of the given seasons, else all) so that filters on any of its clustering columns
    read few row groups.

    Loads sort by driver alone, which is cheap for the races they touch; this is for races that are done. The rows stay the
    same: it is a version without changes, so marts that follow the table have nothing to do. None if the table is not there.
    """
    path, parts, columns = f"{warehouse}/{table}", PARTITIONED_BY[table], CLUSTERED_BY[table]
    before = versions.manifest(spark, path)
    if before is None:
        return None
    rows = versions.read_version(spark, path, before, table_schema(table))
    none = rows.limit(0)
    changes = deltas.change_rows(none, none, NATURAL_KEY[table], ["ingested_at"]) if table in FOLLOWED else None
    if seasons is not None:
        rows = rows.filter(F.col("year").isin(seasons))
    dealt = layout.clustered(rows, parts, columns, SORTED_BY[table])
    return versions.replace_partitions(
        dealt, path, parts, before=before, changes=changes, options=layout.bloom_options(columns), dealt=True
    )


def refresh_marts(spark: SparkSession, warehouse: str, seasons: list[int] | None = None) -> None:
    """Bring the marts up to date, with those of the given seasons recomputed from the facts (of all seasons if None)."""
    if seasons is None:
        facts = [read_table(spark, f"{warehouse}/{t}", table_schema(t)) for t in ("fact_race_result", "fact_pit_stop")]
        seasons = sorted({s for rows in facts if rows is not None for s in seasons_in(rows)})
    update_marts(spark, warehouse, seasons)


def enrich_results(spark: SparkSession, warehouse: str) -> DataFrame:
    """Result rows with the attributes of their driver, circuit and team."""
    dim = {name: read_table(spark, f"{warehouse}/{name}") for name in ("dim_driver", "dim_circuit", "dim_team")}
    return marts.star_join(
        read_table(spark, f"{warehouse}/fact_race_result"),
        [
            (dim["dim_driver"], {"driver_id": "driver_id"}, ["driver_name", "current_team"]),
            (dim["dim_circuit"], {"year": "year", "round": "round"}, ["circuit_id", "circuit_name", "country"]),
            (dim["dim_team"], {"team": "team_name"}, ["team_id", "constructor_id"]),
        ],
    )


def enrich_stops(spark: SparkSession, warehouse: str) -> DataFrame:
    """Pit stops with their driver's name and tyre colour."""
    return marts.star_join(
        read_table(spark, f"{warehouse}/fact_pit_stop"),
        [
            (read_table(spark, f"{warehouse}/dim_driver"), {"driver_id": "driver_id"}, ["driver_name"]),
            (read_table(spark, f"{warehouse}/dim_tyre"), {"compound": "compound"}, ["tyre_id", "colour_hex"]),
        ],
    )


def check_constraints(spark: SparkSession, warehouse: str) -> DataFrame:
    """(table, rule, n_violations) over all written tables."""
    drivers = read_table(spark, f"{warehouse}/dim_driver")
    tyres = read_table(spark, f"{warehouse}/dim_tyre")
    report = None
    for table, keys in NATURAL_KEY.items():
        rows = read_table(spark, f"{warehouse}/{table}", table_schema(table))
        if rows is None:
            continue
        references = {}
        if table in ("fact_race_result", "fact_pit_stop") and drivers is not None:
            references["dim_driver"] = (drivers, {"driver_id": "driver_id"})
        if table == "fact_pit_stop" and tyres is not None:
            references["dim_tyre"] = (tyres, {"compound": "compound"})
        rules = quality.row_rules(not_null=NOT_NULL.get(table), max_length=MAX_LENGTH.get(table))
        part = quality.constraint_report(rows, table, rules, keys, references)
        if key := SURROGATE_KEY.get(table):
            part = part.unionByName(quality.constraint_report(rows, table, unique=[key]))
        report = part if report is None else report.unionByName(part)
    return report


def pending_event(schedule: DataFrame, results: DataFrame | None, as_of: str) -> DataFrame:
    """The latest scheduled event on or before ``as_of``, unless its results are loaded already."""
    latest = events.latest_before(schedule, "EventDate", as_of, ["RoundNumber"])
    latest = latest.select(
        F.year("EventDate").alias("year"), F.col("RoundNumber").alias("round"), F.col("EventName").alias("gp_name")
    )
    return latest if results is None else events.missing_units(results, latest, ["year", "round"])
