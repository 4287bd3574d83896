"""What the dashboard asks: pages and SQL over registered views, distinct lists, top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.operators.marts import compare_entities, compare_series, table_counts, with_names
from starmart.schemas import TABLE_DDL, table_schema
from starmart.sources.tables import read_table

TABLES = [
    "dim_driver", "dim_circuit", "dim_team", "dim_tyre",
    "fact_race_result", "fact_pit_stop", "fact_weather", "fact_telemetry",
    "vw_driver_standings", "vw_team_standings", "vw_pit_stop_strategy", "vw_season_team_rank",
]

# --- fixed values: names of the counts that callers read ---
COUNTS = {
    "nb_race_results": "fact_race_result",
    "nb_pit_stops": "fact_pit_stop",
    "nb_weather": "fact_weather",
    "nb_drivers": "dim_driver",
    "nb_circuits": "dim_circuit",
}


def register_views(spark: SparkSession, warehouse: str) -> list[str]:
    """Register every written table and mart of the warehouse as a temp view; returns the names found.

    Driver standings get their names here, from the dimension as it is now.
    """
    found = []
    for name in TABLES:
        df = read_table(spark, f"{warehouse}/{name}", table_schema(name) if name in TABLE_DDL else None)
        if df is not None:
            if name == "vw_driver_standings" and "dim_driver" in found:
                measures = [c for c in df.columns if c not in ("year", "driver_id", "driver_name")]
                df = with_names(df.select("year", "driver_id", *measures), spark.table("dim_driver"))
            df.createOrReplaceTempView(name)
            found.append(name)
    return found


def run_sql(spark: SparkSession, sql: str, **params) -> DataFrame:
    """SQL over the registered views with named parameters (``:year``)."""
    return spark.sql(sql, args=params)


def distinct_values(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    order = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()
    return df.select(column).distinct().orderBy(order)


def top_standings(
    season: DataFrame, k: int = 10, score: str = "total_points", key: str = "driver_id", out: str = "championship_rank"
) -> DataFrame:
    """The first k rows of one season's totals, with their rank.

    All rows with a better score than a listed row are listed too, so ranking the k rows
    among themselves gives their rank in the season.
    """
    listed = season.orderBy(F.col(score).desc_nulls_last(), F.col(key).asc_nulls_last()).limit(k)
    return listed.withColumn(out, F.rank().over(Window.orderBy(F.col(score).desc_nulls_last())))


def champion(standings: DataFrame, rank: str = "championship_rank") -> DataFrame:
    """The leading row or rows (name, points, wins) of ranked standings."""
    return standings.filter(F.col(rank) == 1)


def top_strategies(strategy: DataFrame, k: int = 20, key: str = "driver_id") -> DataFrame:
    """The first k strategies: fewest stops, then the shortest mean stop."""
    order = [F.col(c).asc_nulls_last() for c in ("total_stops", "avg_pit_duration_sec", key)]
    return strategy.orderBy(*order).limit(k)


def _season(spark: SparkSession, view: str, year: int) -> DataFrame:
    return spark.table(view).filter(F.col("year") == year)


def _sorted(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


# The served pages, by name, over the registered views. Orders are total, so that a page does
# not change between runs; the season filter prunes directories.
PAGES = {
    "seasons": lambda spark: distinct_values(spark.table("fact_race_result"), "year", descending=True),
    "standings": lambda spark, year: _sorted(
        _season(spark, "vw_driver_standings", year), "championship_rank", "driver_id"
    ),
    "team_standings": lambda spark, year: _sorted(
        _season(spark, "vw_team_standings", year), "championship_rank", "team"
    ),
    "events_with_stops": lambda spark, year: distinct_values(_season(spark, "fact_pit_stop", year), "gp_name"),
    "strategy": lambda spark, year, gp: _sorted(
        _season(spark, "vw_pit_stop_strategy", year).filter(F.col("gp_name") == gp),
        "total_stops",
        "avg_pit_duration_sec",
        "driver_id",
    ),
    "drivers": lambda spark, year: distinct_values(_season(spark, "fact_race_result", year), "driver_id"),
    "comparison": lambda spark, year, d1, d2: compare_series(_season(spark, "fact_race_result", year), [d1, d2]),
    "comparison_stats": lambda spark, year, d1, d2: compare_entities(
        _season(spark, "fact_race_result", year), among=[d1, d2]
    ),
    "counts": lambda spark: table_counts(spark, COUNTS),
}


def page(spark: SparkSession, name: str, **params) -> DataFrame:
    """A served page, for example ``page(spark, "standings", year=2024)``."""
    return PAGES[name](spark, **params)
