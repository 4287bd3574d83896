"""Marts that follow the facts by their change rows.

Each mart remembers, in its manifest, up to which version of its fact table it has come. An update takes the changes of the
versions since, so a small batch costs what it changes and not the season; only ranks are made anew, from the totals of the
seasons touched. Repeating an update, or going on after a crash between facts and marts, counts nothing twice. Where the changes
of a version are gone or were never kept, the mart is recomputed from the facts.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators import clean, deltas, marts
from starmart.operators.windows import rank_within
from starmart.schemas import NATURAL_KEY, table_schema
from starmart.sources import versions
from starmart.sources.staging import cleans_up, stage
from starmart.sources.tables import MAX_LISTED_PARTITIONS, read_table

log = logging.getLogger(__name__)

SEASON = "year"


def _flag(column: str) -> Column:
    return F.when(F.col(column), F.lit(1)).otherwise(F.lit(0))


# view -> (what is ranked, summed expressions of a result row)
STANDINGS: dict[str, tuple[str, Callable[[], dict[str, Column]]]] = {
    "vw_driver_standings": (
        "driver_id",
        lambda: {"total_points": F.col("points"), "wins": _flag("is_winner"), "points_finishes": _flag("is_points_finish")},
    ),
    "vw_team_standings": ("team", lambda: {"total_points": F.col("points"), "wins": _flag("is_winner")}),
}
RESULT_ROWS = ["year", "round", "driver_id", "team", "points"]
STRATEGY_KEY = ["year", "gp_name", "driver_id"]


def changes_since(spark: SparkSession, path: str, table: str, version: int | None) -> DataFrame | None:
    """The change rows that lead from ``version`` of a table to its newest; None if some of them are not there."""
    newest = versions.manifest(spark, path)
    if version is None or version > newest.version:
        return None
    there = set(versions._versions(spark, path))
    steps = range(version + 1, newest.version + 1)
    if not there.issuperset(steps):
        return None
    named = [versions.manifest(spark, path, v).changes for v in steps]
    if not all(named):
        return None
    row = table_schema(table).simpleString()
    schema = f"{deltas.BEFORE} {row}, {deltas.AFTER} {row}"
    return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in named]) if named else spark.createDataFrame([], schema)


def seasons_in(rows: DataFrame) -> list[int]:
    """The seasons in ``rows``. A season is a SMALLINT, so the list is small whatever the row count."""
    return sorted(r[0] for r in rows.select(SEASON).distinct().collect() if r[0] is not None)


def _of(rows: DataFrame | None, seasons: list[int] | None) -> DataFrame | None:
    return rows if rows is None or seasons is None else rows.filter(F.col(SEASON).isin(seasons))


def _mark(spark: SparkSession, path: str, table: str) -> int | None:
    found = versions.manifest(spark, path)
    return None if found is None else found.marks.get(table)


def update_totals(spark: SparkSession, path: str, facts: DataFrame, changes: DataFrame | None, by: list[str], measures: dict[str, Column], marks: dict[str, int]) -> list[int] | None:
    """Bring kept sums up to date by ``changes``, or from all ``facts`` if there are none to go by; the seasons touched, or None for all."""
    if changes is None:
        versions.replace_partitions(deltas.sums(facts, by, measures), path, [SEASON], by, marks=marks)
        return None
    signed = deltas.signed_rows(changes)
    seasons = seasons_in(signed)
    before = versions.manifest(spark, path)
    if not seasons:
        versions.set_marks(spark, path, before, marks)
        return seasons
    difference = deltas.sums(signed, by, measures, deltas.SIGN)
    schema = deltas.sums(facts, by, measures).schema
    known = _of(versions.read_version(spark, path, before, schema), seasons)
    versions.replace_partitions(deltas.with_difference(known, difference, by), path, [SEASON], by, before, marks)
    return seasons


def _update_standings(spark: SparkSession, warehouse: str, facts: DataFrame, view: str, newest: int, again: list[int] | None) -> None:
    table, fact_path = "fact_race_result", f"{warehouse}/fact_race_result"
    entity, measures = STANDINGS[view][0], STANDINGS[view][1]()
    path, totals = f"{warehouse}/{view}", f"{warehouse}/totals_{entity.removesuffix('_id')}"
    mark, by = _mark(spark, totals, table), [SEASON, entity]
    seasons: list[int] | None = []
    if mark != newest:
        seasons = update_totals(spark, totals, facts, changes_since(spark, fact_path, table, mark), by, measures, {table: newest})
    if again and seasons is not None:
        versions.replace_partitions(deltas.sums(_of(facts, again), by, measures), totals, [SEASON], by)
        seasons = sorted({*seasons, *again})
    if _mark(spark, path, table) != mark:  # the view did not get as far as its totals
        seasons = None
    if seasons == []:
        if mark != newest:
            versions.set_marks(spark, path, versions.manifest(spark, path), {table: newest})
        return
    kept = _of(read_table(spark, totals, deltas.sums(facts, by, measures).schema), seasons)
    shown = stage(deltas.shown(kept, by, list(measures)), "totals")
    ranked = rank_within(shown, [SEASON], "total_points").select(*by, *measures, "championship_rank")
    versions.replace_partitions(ranked, path, [SEASON], ["championship_rank", entity], marks={table: newest})


def _update_entries(spark: SparkSession, warehouse: str, facts: DataFrame, newest: int, again: list[int] | None) -> None:
    """The rank of each result within its season and team: the rows of the touched seasons, as the view has them, changed and ranked anew."""
    table, path = "fact_race_result", f"{warehouse}/vw_season_team_rank"
    mark = _mark(spark, path, table)
    changes = changes_since(spark, f"{warehouse}/{table}", table, mark)
    if changes is None:
        rows = facts.select(*RESULT_ROWS)
    else:
        signed = stage(deltas.signed_rows(changes).select(*RESULT_ROWS, deltas.SIGN), "signed")
        seasons = seasons_in(signed)
        key = NATURAL_KEY[table]
        known = _of(read_table(spark, path, facts.select(*RESULT_ROWS).schema), seasons)
        rows = known.join(signed.filter(f"{deltas.SIGN} < 0").select(*key), key, "left_anti")
        rows = rows.unionByName(signed.filter(f"{deltas.SIGN} > 0").drop(deltas.SIGN))
        if again:
            rows = rows.filter(~F.col(SEASON).isin(again)).unionByName(_of(facts, again).select(*RESULT_ROWS))
        if not seasons and not again:
            versions.set_marks(spark, path, versions.manifest(spark, path), {table: newest})
            return
    ranked = clean.team_rank(stage(rows, "entries"))
    versions.replace_partitions(ranked, path, [SEASON], ["team", "season_team_rank", "driver_id"], marks={table: newest})


def touched_strategies(stops: DataFrame, groups: DataFrame) -> DataFrame:
    """The strategies of the named groups. Seasons and events are listed in a filter, which reaches the scan, while they are few."""
    wanted = groups.select(SEASON, "gp_name").distinct().limit(MAX_LISTED_PARTITIONS + 1).collect()
    if len(wanted) <= MAX_LISTED_PARTITIONS:
        stops = stops.filter(F.col(SEASON).isin([r[0] for r in wanted]) & F.col("gp_name").isin([r[1] for r in wanted]))
    return marts.pit_strategy(stops.join(groups, STRATEGY_KEY, "left_semi"))


def _update_strategies(spark: SparkSession, warehouse: str, stops: DataFrame, newest: int, again: list[int] | None) -> None:
    """Groups with changed stops are made anew from their event's rows, the other groups of the season are kept."""
    table, path = "fact_pit_stop", f"{warehouse}/vw_pit_stop_strategy"
    changes = changes_since(spark, f"{warehouse}/{table}", table, _mark(spark, path, table))
    if changes is None:
        rows = marts.pit_strategy(stops)
    else:
        groups = stage(deltas.signed_rows(changes).select(*STRATEGY_KEY).distinct(), "groups")
        seasons = seasons_in(groups)
        fresh = touched_strategies(stops, groups)
        known = _of(read_table(spark, path, fresh.schema), seasons)
        rows = known.join(groups, STRATEGY_KEY, "left_anti").unionByName(fresh)
        if again:
            rows = rows.filter(~F.col(SEASON).isin(again)).unionByName(marts.pit_strategy(_of(stops, again)))
        if not seasons and not again:
            versions.set_marks(spark, path, versions.manifest(spark, path), {table: newest})
            return
    versions.replace_partitions(rows, path, [SEASON], ["gp_name", "driver_id"], marks={table: newest})


@cleans_up
def update_marts(spark: SparkSession, warehouse: str, again: list[int] | None = None) -> None:
    """Bring all marts to the newest version of the facts; the seasons of ``again`` are recomputed from the facts as well.

    Driver standings are stored without names: `serving.register_views` joins the dimension, so a renamed driver shows in
    all seasons. `vw_season_team_rank` ranks every result among those of its season and team; as a season's later results move
    earlier ones, it is a mart of the whole season and no fact column.
    """
    for table in ("fact_race_result", "fact_pit_stop"):
        facts = versions.manifest(spark, f"{warehouse}/{table}")
        if facts is None:
            continue
        rows = versions.read_version(spark, f"{warehouse}/{table}", facts, table_schema(table))
        if table == "fact_race_result":
            for view in STANDINGS:
                _update_standings(spark, warehouse, rows, view, facts.version, again)
            _update_entries(spark, warehouse, rows, facts.version, again)
        else:
            _update_strategies(spark, warehouse, rows, facts.version, again)
