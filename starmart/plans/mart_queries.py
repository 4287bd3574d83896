"""Standings, strategy, comparison and served lists over the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators import clean, marts, windows
from starmart.plans import serving
from starmart.plans.registry import drivers, hundredths, money, order_results, plain, query, table, totals
from starmart.sources.staging import stage

RESULTS_SQL = """
    results AS (
        SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS round,
               o_custkey AS driver_id, c_name AS driver_name, c_mktsegment AS team,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS points, l_linenumber AS position
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    ),
    driver_totals AS (
        SELECT year, driver_id, max(driver_name) AS driver_name, sum(points) AS points,
               count(*) FILTER (WHERE position = 1) AS wins,
               count(*) FILTER (WHERE position <= 3) AS points_finishes
        FROM results GROUP BY year, driver_id
    ),
    driver_ranked AS (
        SELECT year, driver_id, driver_name, CAST(points AS DOUBLE) AS total_points, wins, points_finishes,
               rank() OVER (PARTITION BY year ORDER BY points DESC NULLS LAST) AS championship_rank
        FROM driver_totals
    )
"""


def _driver_totals(spark: SparkSession, sf_dir: str, season: int | None = None) -> DataFrame:
    return marts.season_totals(order_results(spark, sf_dir, season), ["year", "driver_id"], totals())


@query(f"WITH {RESULTS_SQL} SELECT * FROM driver_ranked")
def driver_standings(spark, sf_dir):
    names = drivers(spark, sf_dir)
    return plain(money(marts.driver_standings(order_results(spark, sf_dir), names, measures=totals())))


@query(
    f"""WITH {RESULTS_SQL}, t AS (
        SELECT year, team, sum(points) AS points, count(*) FILTER (WHERE position = 1) AS wins
        FROM results GROUP BY year, team)
    SELECT year, team, CAST(points AS DOUBLE) AS total_points, wins,
           rank() OVER (PARTITION BY year ORDER BY points DESC NULLS LAST) AS championship_rank
    FROM t"""
)
def team_standings(spark, sf_dir):
    # totals per driver first: far fewer rows meet the driver table than order lines
    teams = _driver_totals(spark, sf_dir).join(drivers(spark, sf_dir), "driver_id", "left")
    measures = {"total_points": F.sum("total_points"), "wins": F.sum("wins")}
    return plain(money(marts.team_standings(teams, measures=measures)))


@query(
    """SELECT l_orderkey, count(*) AS total_stops, avg(l_quantity) AS avg_pit_duration_sec,
              min(l_quantity) AS fastest_pit_sec,
              string_agg(l_returnflag, ' → ' ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS tyre_strategy
       FROM lineitem GROUP BY l_orderkey"""
)
def pit_strategy(spark, sf_dir):
    return plain(_strategy(spark, sf_dir))


def _strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.pit_strategy(
        table(spark, sf_dir, "lineitem"),
        by=["l_orderkey"],
        duration="l_quantity",
        text="l_returnflag",
        order_by=["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"],
    )


@query(
    """SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year, c_mktsegment AS team,
              CAST(o_totalprice AS DOUBLE) AS points,
              rank() OVER (PARTITION BY year(o_orderdate), c_mktsegment ORDER BY o_totalprice DESC NULLS LAST)
                  AS season_team_rank
       FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def team_rank(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("driver_id"),
        F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").alias("points"),
    )
    entries = orders.join(drivers(spark, sf_dir), "driver_id").select("o_orderkey", "year", "team", "points")
    return plain(clean.team_rank(stage(entries, "entries")))


@query(
    f"""WITH {RESULTS_SQL}, t AS (
        SELECT year, team, driver_id, sum(points) AS points FROM results GROUP BY year, team, driver_id)
    SELECT year, team, driver_id, CAST(points AS DOUBLE) AS total_points,
           rank() OVER (PARTITION BY year, team ORDER BY points DESC NULLS LAST) AS season_team_rank
    FROM t"""
)
def team_season_rank(spark, sf_dir):
    entries = _driver_totals(spark, sf_dir).join(drivers(spark, sf_dir), "driver_id", "left")
    return plain(money(clean.team_season_rank(entries, score="total_points")))


@query(f"WITH {RESULTS_SQL} SELECT * FROM driver_ranked WHERE year = 1997")
def season_standings(spark, sf_dir):
    # the season is cut out at the facts' scan; names are joined to what is ranked
    ranked = marts.ranked_drivers(order_results(spark, sf_dir, 1997), measures=totals())
    return plain(money(marts.with_names(ranked, drivers(spark, sf_dir))))


COMPARED = [7, 42]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as result rows. A filter on the driver reaches the orders scan."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linenumber").alias("position"),
        hundredths("l_extendedprice").alias("points"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("driver_id"))
    return lines.join(orders, "o_orderkey")


COMPARE_SQL = """
    SELECT driver_id, CAST(sum(position) AS DOUBLE) / count(*) AS avg_position,
           CAST(sum(points) AS DOUBLE) AS total_points,
           count(*) FILTER (WHERE position = 1) AS wins, count(*) FILTER (WHERE position <= 3) AS podiums
    FROM results {where} GROUP BY driver_id"""


@query(f"WITH {RESULTS_SQL} " + COMPARE_SQL.format(where="WHERE driver_id IN (7, 42)"))
def compare_entities(spark, sf_dir):
    return plain(money(marts.compare_entities(_lines(spark, sf_dir), among=COMPARED)))


@query(f"WITH {RESULTS_SQL} " + COMPARE_SQL.format(where=""))
def entity_stats(spark, sf_dir):
    return plain(money(marts.compare_entities(_lines(spark, sf_dir))))


SERIES_SQL = """
    months AS (
        SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS round, c_mktsegment AS team,
               CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS points, count(*) AS n_orders
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
    )"""


def _months(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("driver_id"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("round"),
        hundredths("o_totalprice").alias("price"),
    )
    joined = orders.join(drivers(spark, sf_dir).select("driver_id", "team"), "driver_id")
    months = joined.groupBy("round", "team").agg(F.sum("price").alias("points"), F.count(F.lit(1)).alias("n_orders"))
    return money(months, "points")


@query(f"WITH {SERIES_SQL} SELECT * FROM months WHERE team IN ('BUILDING', 'MACHINERY') ORDER BY round, team")
def compare_series(spark, sf_dir):
    months = _months(spark, sf_dir)
    return plain(
        marts.compare_series(months, ["BUILDING", "MACHINERY"], entity="team", columns=[*months.columns])
    )


@query(
    f"""WITH {SERIES_SQL}
    SELECT round, sum(points) FILTER (WHERE team = 'BUILDING') AS "BUILDING",
           sum(points) FILTER (WHERE team = 'MACHINERY') AS "MACHINERY"
    FROM months WHERE team IN ('BUILDING', 'MACHINERY') GROUP BY round"""
)
def compare_series_wide(spark, sf_dir):
    return plain(marts.compare_series_wide(_months(spark, sf_dir), ["BUILDING", "MACHINERY"], entity="team"))


@query(
    """SELECT (SELECT count(*) FROM lineitem) AS n_lines, (SELECT count(*) FROM orders) AS n_orders,
              (SELECT count(*) FROM events) AS n_events, (SELECT count(*) FROM customer) AS n_customers,
              (SELECT count(*) FROM nation) AS n_nations"""
)
def table_counts(spark, sf_dir):
    names = {
        "n_lines": "lineitem", "n_orders": "orders", "n_events": "events",
        "n_customers": "customer", "n_nations": "nation",
    }
    return marts.table_counts(spark, {name: f"parquet.`{sf_dir}/{t}.parquet`" for name, t in names.items()})


@query("SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS year FROM orders ORDER BY year DESC")
def distinct_seasons(spark, sf_dir):
    facts = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    return plain(serving.distinct_values(facts, "year", descending=True))


@query(
    f"""WITH {RESULTS_SQL}
    SELECT year, driver_id, total_points, wins, points_finishes, championship_rank
    FROM driver_ranked WHERE championship_rank <= 3"""
)
def season_topk(spark, sf_dir):
    season = stage(_driver_totals(spark, sf_dir), "totals")
    return plain(money(windows.top_ranked(season, ["year"], "total_points", 3)))


@query(
    f"""WITH {RESULTS_SQL}
    SELECT year, driver_id, driver_name, total_points, wins, points_finishes, championship_rank
    FROM driver_ranked WHERE year = 1997 ORDER BY championship_rank, driver_id LIMIT 10"""
)
def standings_top10(spark, sf_dir):
    season = _driver_totals(spark, sf_dir, 1997)
    top = money(serving.top_standings(season, 10)).join(drivers(spark, sf_dir), "driver_id", "left")
    return plain(
        top.select(
            "year", "driver_id", "driver_name", "total_points", "wins", "points_finishes", "championship_rank"
        ).orderBy("championship_rank", "driver_id")
    )


@query(
    f"""WITH {RESULTS_SQL}
    SELECT year, driver_id, driver_name, total_points, wins FROM driver_ranked WHERE championship_rank = 1"""
)
def champions(spark, sf_dir):
    season = stage(_driver_totals(spark, sf_dir), "totals")
    best = money(windows.top_ranked(season, ["year"], "total_points", 1))
    named = best.join(drivers(spark, sf_dir), "driver_id", "left")
    return plain(named.select("year", "driver_id", "driver_name", "total_points", "wins"))


@query(
    """WITH s AS (
        SELECT l_orderkey, count(*) AS total_stops, avg(l_quantity) AS avg_pit_duration_sec,
               min(l_quantity) AS fastest_pit_sec,
               string_agg(l_returnflag, ' → ' ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag)
                   AS tyre_strategy
        FROM lineitem GROUP BY l_orderkey)
    SELECT s.* FROM s JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT'
    ORDER BY total_stops NULLS LAST, avg_pit_duration_sec NULLS LAST, l_orderkey LIMIT 20"""
)
def strategy_top20(spark, sf_dir):
    race = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.join(race.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    strategy = marts.pit_strategy(
        lines,
        by=["l_orderkey"],
        duration="l_quantity",
        text="l_returnflag",
        order_by=["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"],
    )
    return plain(serving.top_strategies(strategy, 20, key="l_orderkey"))


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE year(o_orderdate) = 1997 AND o_orderpriority = '2-HIGH'"""
)
def param_sql(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("starmart_orders")
    return plain(
        serving.run_sql(
            spark,
            """SELECT o_orderkey, o_custkey, o_totalprice FROM starmart_orders
               WHERE year(o_orderdate) = :year AND o_orderpriority = :priority""",
            year=1997,
            priority="2-HIGH",
        )
    )


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_extendedprice,
              o_orderdate_text, c_name, n_name, r_name
       FROM (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate_text FROM lineitem
             LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
             LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""
)
def star_join(spark, sf_dir):
    # outer dimensions are folded into the customer first, so that the fact takes part in two joins, not four
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = marts.star_join(nation, [(region, {"n_regionkey": "r_regionkey"}, ["r_name"])])
    customers = marts.star_join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"),
        [(places, {"c_nationkey": "n_nationkey"}, ["n_name", "r_name"])],
    )
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate_text", F.date_format("o_orderdate", "yyyy-MM-dd"))
    fact = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    enriched = marts.star_join(
        fact,
        [
            (orders, {"l_orderkey": "o_orderkey"}, ["o_custkey", "o_orderdate_text"]),
            (customers, {"o_custkey": "c_custkey"}, ["c_name", "n_name", "r_name"]),
        ],
    )
    return plain(enriched.drop("o_custkey"))


@query(
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS round,
              o_orderstatus AS event_type, count(*) AS n_rows FROM orders GROUP BY 1, 2, 3"""
)
def ingest_counts(spark, sf_dir):
    from starmart.operators.events import unit_counts

    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("round"),
        F.col("o_orderstatus").alias("event_type"),
    )
    return plain(unit_counts(orders))
