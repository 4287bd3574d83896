"""Dimensions: current attributes per key, surrogate keys, insert-if-absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.operators.facts import latest_per_key
from starmart.schemas import TYRES
from starmart.sources.staging import stage

# 4 hex digits of a hash: at most 65,536 buckets, so the table of bucket sizes has a fixed bound
HASH_DIGITS = 4


def current_attributes(df: DataFrame, keys: list[str], attributes: dict[str, str], order_by: list[str]) -> DataFrame:
    """One row per key with each attribute's most recent known value.

    ``attributes`` maps output name to source column. An aggregate rather than a sort-and-pick:
    each task sends one row per key. The value itself settles ties of age.
    """
    latest = []
    for out, source in attributes.items():
        age = F.struct(*order_by, source)
        latest.append(F.max_by(F.col(source), F.when(F.col(source).isNotNull(), age)).alias(out))
    return df.groupBy(*keys).agg(*latest)


def driver_dimension(results: DataFrame, order_by: list[str] = ["year", "round", "ingested_at"]) -> DataFrame:
    return current_attributes(
        results, ["driver_id"], {"driver_name": "driver_name", "current_team": "team"}, order_by
    )


def circuit_dimension(results: DataFrame, order_by: list[str] = ["ingested_at"]) -> DataFrame:
    return current_attributes(results, ["year", "round"], {"gp_name": "gp_name"}, order_by)


def team_dimension(results: DataFrame, team: str = "team") -> DataFrame:
    return results.select(F.col(team).alias("team_name")).filter(F.col("team_name").isNotNull()).distinct()


def tyre_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TYRES, "compound string, colour_hex string")


def assign_keys(
    df: DataFrame, natural_key: list[str], out: str, existing: DataFrame | None = None, hash_digits: int = HASH_DIGITS
) -> DataFrame:
    """Number the rows (unique by ``natural_key``) densely, after the largest key of ``existing``.

    Numbers follow (hash prefix, natural key): each hash bucket numbers its own rows and adds
    the size of the buckets before it, so no task sees more than one bucket. A plain 64-bit
    hash as key would collide on tables of this size.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in natural_key])
    placed = df.withColumn("__bucket", F.substring(F.md5(text), 1, hash_digits))
    sizes = placed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__size"))
    # one task, at most 16 ** hash_digits rows
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__bucket", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    in_bucket = F.row_number().over(Window.partitionBy("__bucket").orderBy(*natural_key))
    number = F.col("__offset") + in_bucket
    if existing is not None:
        number = number + F.coalesce(existing.agg(F.max(out)).scalar(), F.lit(0))
    numbered = placed.join(F.broadcast(offsets), "__bucket").withColumn(out, number.cast("bigint"))
    return numbered.select(out, *df.columns)


# a BIGINT holds 15 bits of year, 15 of round (both SMALLINT and not negative) and 33 for the row
ROUND_BITS = 15
FACT_KEY_BITS = 33


def assign_fact_keys(rows: DataFrame, natural_key: list[str], out: str, race: Column, known: DataFrame) -> DataFrame:
    """Give each fact row its key: the one ``known`` has for its natural key, or a new one.

    A key is the number of the race (``race``, an integer) and a number within it, so only
    the races that ``rows`` touch have to be in ``known``: no scan of the whole fact table.
    """
    matched = rows.drop(out).join(known.select(*natural_key, out), natural_key, "left")
    fresh = matched.filter(F.col(out).isNull()).drop(out)
    low_bits = F.lit((1 << FACT_KEY_BITS) - 1)
    used = known.select(F.col(out).bitwiseAND(low_bits).alias(out))
    numbered = assign_keys(fresh, natural_key, out, used)
    numbered = numbered.withColumn(out, F.shiftleft(race.cast("bigint"), FACT_KEY_BITS) + F.col(out))
    return matched.filter(F.col(out).isNotNull()).unionByName(numbered)


def merge_drivers(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Driver rows of both sides: most recent known attributes, earliest creation, latest update."""
    rows = incoming if existing is None else existing.unionByName(incoming)
    age = ["last_year", "last_round", "updated_at"]
    kept = ["driver_name", "nationality", "current_team", "date_of_birth"]
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*age, c))).alias(c) for c in kept]
    last = F.max(F.struct("last_year", "last_round"))
    merged = rows.groupBy("driver_id").agg(
        *latest, F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"), last.alias("last")
    )
    return merged.select("*", "last.*").drop("last")


def absent_rows(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """One row of ``incoming`` per key that ``existing`` lacks."""
    fresh = latest_per_key(incoming, keys, [])
    return fresh.join(existing.select(*keys), keys, "left_anti")


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: list[str], key_column: str | None = None) -> DataFrame:
    """``existing`` plus the rows of ``incoming`` whose key is new, numbered on if the table has a surrogate key."""
    added = absent_rows(existing, incoming, keys)
    if key_column:
        # numbering reads the new rows twice, and finding them is the costly part
        added = assign_keys(stage(added, "absent"), keys, key_column, existing)
    return existing.unionByName(added, allowMissingColumns=True)
