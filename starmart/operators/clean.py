"""Cleaning, flags and row-level ranks of result rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.scalars import entity_key
from starmart.functions.text import parse_time
from starmart.operators.facts import latest_per_key
from starmart.operators.windows import rank_within
from starmart.schemas import LAST_POINTS_POSITION, WINNING_POSITION
from starmart.sources.staging import stage


def clean_flags(
    df: DataFrame,
    key: str = "driver_id",
    position: str = "position",
    last_points_position: int = LAST_POINTS_POSITION,
    ingested_at: str | None = "ingested_at",
) -> DataFrame:
    """Drop rows without key or position, unify the key's spelling, flag winners and points finishes."""
    placed = df.withColumn(key, entity_key(F.col(key))).filter(F.col(key).isNotNull() & F.col(position).isNotNull())
    flagged = placed.withColumns(
        {
            "is_winner": F.col(position) == WINNING_POSITION,
            "is_points_finish": F.col(position) <= last_points_position,
        }
    )
    if ingested_at:
        flagged = flagged.withColumn(ingested_at, parse_time(F.col(ingested_at)))
    return flagged


def clean_results(
    df: DataFrame, unique: list[str] = ["year", "round", "driver_id"], order_by: list[str] = ["ingested_at"]
) -> DataFrame:
    """Result messages to one clean row per entry of a race, the newest message winning."""
    return latest_per_key(clean_flags(df), unique, order_by)


def team_rank(
    results: DataFrame, by: list[str] = ["year", "team"], score: str = "points", out: str = "season_team_rank"
) -> DataFrame:
    """Rank of each (deduplicated) row within its season and team."""
    return rank_within(results, by, score, out)


def team_season_rank(
    results: DataFrame,
    by: list[str] = ["year", "team"],
    entity: str = "driver_id",
    score: str = "points",
    out: str = "season_team_rank",
) -> DataFrame:
    """Rank of each entity's season total within its season and team."""
    totals = results.groupBy(*by, entity).agg(F.sum(score).alias("total_points"))
    return rank_within(stage(totals, "totals"), by, "total_points", out)
