"""Deduplication, dimensions, facts, upserts and constraint reports over the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators import deltas, dims, facts, quality
from starmart.operators.windows import rank_within
from starmart.plans.registry import hundredths, money, plain, query, table
from starmart.sources.layout import write_clustered
from starmart.sources.staging import new_folder, stage
from starmart.sources.tables import append_table, read_table, upsert_table, write_partitioned


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumns(
        {"year": F.year("o_orderdate"), "round": F.month("o_orderdate")}
    )


@query(
    """SELECT o_custkey, CAST(year AS BIGINT) AS year, CAST(round AS BIGINT) AS round, o_orderkey, o_totalprice FROM (
           SELECT *, row_number() OVER (PARTITION BY o_custkey, year, round ORDER BY o_orderdate DESC, o_orderkey DESC)
               AS nth
           FROM (SELECT *, year(o_orderdate) AS year, month(o_orderdate) AS round FROM orders))
       WHERE nth = 1"""
)
def latest_per_key(spark, sf_dir):
    latest = facts.latest_per_key(_orders(spark, sf_dir), ["o_custkey", "year", "round"], ["o_orderdate", "o_orderkey"])
    return plain(latest.select("o_custkey", "year", "round", "o_orderkey", "o_totalprice"))


@query(
    """SELECT o_custkey AS driver_id,
              arg_max(c_name || '/' || o_orderstatus, strftime(o_orderdate, '%Y%m%d') || c_name || '/' || o_orderstatus)
                  AS driver_name,
              arg_max(o_orderpriority, strftime(o_orderdate, '%Y%m%d') || o_orderpriority) AS current_team
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey"""
)
def dim_driver(spark, sf_dir):
    orders, customer = _orders(spark, sf_dir), table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    results = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_custkey").alias("driver_id"),
        F.concat_ws("/", "c_name", "o_orderstatus").alias("driver_name"),
        F.col("o_orderpriority").alias("team"),
        "year",
        "round",
        F.col("o_orderdate").alias("ingested_at"),
    )
    return plain(dims.driver_dimension(results))


@query(
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS round,
              arg_max(o_orderpriority, strftime(o_orderdate, '%Y%m%d') || o_orderpriority) AS gp_name
       FROM orders GROUP BY 1, 2"""
)
def dim_circuit(spark, sf_dir):
    results = _orders(spark, sf_dir).select(
        "year", "round", F.col("o_orderpriority").alias("gp_name"), F.col("o_orderdate").alias("ingested_at")
    )
    return plain(dims.circuit_dimension(results))


@query(
    """SELECT row_number() OVER (ORDER BY substr(md5(team_name), 1, 4), team_name) AS team_id, team_name
       FROM (SELECT DISTINCT c_mktsegment AS team_name FROM customer)"""
)
def dim_team(spark, sf_dir):
    teams = dims.team_dimension(table(spark, sf_dir, "customer"), "c_mktsegment")
    return plain(dims.assign_keys(teams, ["team_name"], "team_id"))


@query(
    """WITH old AS (
        SELECT row_number() OVER (ORDER BY substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 4), o_orderkey) AS result_id,
               o_orderkey, o_custkey
        FROM orders WHERE year(o_orderdate) < 1998),
    fresh AS (
        SELECT (SELECT max(result_id) FROM old)
               + row_number() OVER (ORDER BY substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 4), o_orderkey) AS result_id,
               o_orderkey, o_custkey
        FROM orders WHERE year(o_orderdate) >= 1998)
    SELECT * FROM old UNION ALL SELECT * FROM fresh"""
)
def surrogate_keys(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    old = orders.filter("year < 1998").select("o_orderkey", "o_custkey")
    old = stage(dims.assign_keys(old, ["o_orderkey"], "result_id"), "numbered")
    # all orders arrive again; those already numbered keep their number
    return plain(
        dims.insert_if_absent(old, orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], key_column="result_id")
    )


@query(
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS round,
              o_orderpriority AS gp_name, CAST(o_custkey AS VARCHAR) AS driver_id,
              CASE WHEN o_totalprice < 99999.95 THEN CAST(CAST(o_totalprice AS DECIMAL(9,1)) AS DOUBLE) END AS points,
              coalesce(o_orderstatus = 'F', false) AS is_winner, '2024-05-01 12:00:00.000000' AS ingested_at
       FROM orders"""
)
def fact_conform(spark, sf_dir):
    source = _orders(spark, sf_dir).select(
        "round",
        "year",
        F.col("o_orderpriority").alias("gp_name"),
        F.col("o_custkey").alias("driver_id"),
        # fits decimal(6,1) up to 99999.9: larger prices cannot be stored and become NULL
        F.col("o_totalprice").cast("decimal(12,2)").alias("points"),
        F.when(F.col("o_orderstatus") == "F", F.lit(True)).alias("is_winner"),
    )
    target = T.StructType.fromDDL(
        """year smallint, round smallint, gp_name string, driver_id string, points decimal(6,1),
           is_winner boolean, ingested_at timestamp_ntz"""
    )
    now = F.lit("2024-05-01 12:00:00").cast("timestamp_ntz")
    return plain(facts.conform(source, target, now, ["is_winner"], ["ingested_at"]))


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_name ELSE 'late ' || c_name END AS c_name FROM customer"""
)
def insert_if_absent(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    existing = customer.filter("c_acctbal > 0").select("c_custkey", "c_name")
    incoming = customer.select("c_custkey", F.concat(F.lit("late "), "c_name").alias("c_name"))
    return plain(dims.insert_if_absent(existing, incoming, ["c_custkey"]))


UPSERT_SQL = """
    SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS BIGINT) AS year,
           CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders"""


def _versions(spark, sf_dir):
    first = _orders(spark, sf_dir).select(
        "o_orderkey", "o_custkey", "year", "o_totalprice", F.col("o_orderdate").alias("ingested_at"), "o_orderstatus"
    )
    changed = first.filter("o_orderstatus = 'O'").withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1, "ingested_at": F.timestamp_add("DAY", F.lit(1), "ingested_at")}
    )
    return first.drop("o_orderstatus"), changed.drop("o_orderstatus")


@query(UPSERT_SQL)
def upsert_replay(spark, sf_dir):
    first, changed = _versions(spark, sf_dir)
    # the change arrives, then the whole first batch is replayed: the newer rows stay
    once = facts.upsert(first, changed, ["o_orderkey"], ["ingested_at"])
    again = facts.upsert(once, first, ["o_orderkey"], ["ingested_at"])
    return plain(again.drop("ingested_at"))


@query(UPSERT_SQL)
def upsert_written(spark, sf_dir):
    first, changed = _versions(spark, sf_dir)
    path = new_folder(spark, "upsert_written")
    for batch in (first, changed, first):
        upsert_table(spark, path, batch, ["o_orderkey"], ["ingested_at"], ["year"], ["o_orderkey"])
    return plain(read_table(spark, path).drop("ingested_at"))


@query(
    """WITH t AS (
        SELECT CAST(year(o_orderdate) AS BIGINT) AS year,
               CASE WHEN o_orderstatus = 'O' THEN o_custkey % 50 ELSE o_custkey END AS driver_id,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS points
        FROM orders)
    SELECT year, driver_id, CAST(sum(points) AS DOUBLE) AS total_points,
           rank() OVER (PARTITION BY year ORDER BY sum(points) DESC NULLS LAST) AS championship_rank
    FROM t GROUP BY year, driver_id"""
)
def mart_deltas(spark, sf_dir):
    # every order arrives, some change their driver and points, then all that came first is replayed
    points = hundredths("o_totalprice")
    orders = _orders(spark, sf_dir).withColumns({"driver_id": F.col("o_custkey"), "points": points, "version": F.lit(0)})
    moved = {"driver_id": F.when(F.col("o_orderstatus") == "O", F.col("o_custkey") % 50).otherwise(F.col("o_custkey"))}
    moved |= {"points": F.when(F.col("o_orderstatus") != "P", points), "version": F.lit(1)}
    columns = ["year", "round", "o_orderkey", "driver_id", "points", "version"]
    path, totals, by = new_folder(spark, "mart_deltas"), None, ["year", "driver_id"]
    for batch in (orders, orders.withColumns(moved), orders):
        after = upsert_table(spark, path, batch.select(*columns), ["year", "round", "o_orderkey"], ["version"], ["year", "round"], keep_changes=True)
        signed = deltas.signed_rows(spark.read.parquet(f"{path}/{after.changes}"))
        difference = deltas.sums(signed, by, {"points": F.col("points")}, deltas.SIGN)
        totals = stage(difference if totals is None else deltas.with_difference(totals, difference, by), "totals")
    shown = deltas.shown(totals, by, ["points"]).withColumnRenamed("points", "total_points")
    return plain(money(rank_within(stage(shown, "shown"), ["year"], "total_points")))


@query(
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS round, o_custkey,
              o_orderkey, o_totalprice
       FROM orders WHERE year(o_orderdate) = 1996"""
)
def partitioned_facts(spark, sf_dir):
    path = new_folder(spark, "partitioned_facts")
    rows = _orders(spark, sf_dir).select("year", "round", "o_custkey", "o_orderkey", "o_totalprice")
    write_partitioned(rows, path, ["year"], ["round", "o_custkey"])
    return plain(read_table(spark, path).filter("year = 1996"))


@query(
    """SELECT l_returnflag, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_extendedprice
       FROM lineitem WHERE l_suppkey = (SELECT max(l_suppkey) FROM lineitem) OR l_partkey = (SELECT min(l_partkey) FROM lineitem)"""
)
def clustered_facts(spark, sf_dir):
    path = new_folder(spark, "clustered_facts")
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    write_clustered(lines, path, ["l_returnflag"], ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"])
    ends = lines.agg(F.max("l_suppkey").alias("supplier"), F.min("l_partkey").alias("part"))
    wanted = (F.col("l_suppkey") == ends.select("supplier").scalar()) | (F.col("l_partkey") == ends.select("part").scalar())
    return plain(read_table(spark, path).filter(wanted).withColumn("l_linenumber", F.col("l_linenumber").cast("bigint")))


@query(
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n_rows FROM orders GROUP BY 1"""
)
def appended_facts(spark, sf_dir):
    path = new_folder(spark, "appended_facts")
    rows = _orders(spark, sf_dir).select("year", "round", "o_orderkey", "o_orderstatus")
    done = F.col("o_orderstatus") == "F"
    append_table(rows.filter(done), path, ["year"], ["round", "o_orderkey"])
    append_table(rows.filter(~done), path, ["year"], ["round", "o_orderkey"])
    return plain(read_table(spark, path).groupBy("year").agg(F.count(F.lit(1)).alias("n_rows")))


@query(
    """SELECT o_orderkey, o_custkey + 500 AS o_custkey FROM orders
       WHERE o_custkey + 500 NOT IN (SELECT c_custkey FROM customer)"""
)
def orphans(spark, sf_dir):
    shifted = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") + 500).alias("o_custkey"))
    return plain(quality.orphans(shifted, table(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"}))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey + 500 END AS o_custkey FROM orders
       WHERE o_orderstatus = 'P' OR o_custkey + 500 IN (SELECT c_custkey FROM customer)"""
)
def referenced_rows(spark, sf_dir):
    shifted = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey") + 500).alias("o_custkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", shifted)
    return plain(quality.referenced(orders, table(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"}))


LINE_RULES = dict(
    not_null=["l_linenumber", "l_returnflag"],
    max_length={"l_linestatus": 0},
    types={"l_extendedprice": "decimal(6,1)", "l_partkey": "smallint"},
    domain={"l_returnflag": ["A", "N"]},
)


@query(
    """SELECT * FROM (
        SELECT 'not_null:l_linenumber' AS rule, count(*) FILTER (WHERE l_linenumber IS NULL) AS n_violations FROM lineitem
        UNION ALL SELECT 'not_null:l_returnflag', count(*) FILTER (WHERE l_returnflag IS NULL) FROM lineitem
        UNION ALL SELECT 'length:l_linestatus', count(*) FILTER (WHERE length(l_linestatus) > 0) FROM lineitem
        UNION ALL SELECT 'type:l_extendedprice', count(*) FILTER (WHERE l_extendedprice >= 99999.95) FROM lineitem
        UNION ALL SELECT 'type:l_partkey', count(*) FILTER (WHERE l_partkey > 32767) FROM lineitem
        UNION ALL SELECT 'domain:l_returnflag', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
        UNION ALL SELECT 'unique:l_orderkey,l_linenumber', count(*) FROM (
            SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
        UNION ALL SELECT 'reference:part', count(*) FROM lineitem
            WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)
    ) CROSS JOIN (SELECT 'lineitem' AS "table")"""
)
def constraint_report(spark, sf_dir):
    big_parts = table(spark, sf_dir, "part").filter("p_size > 10")
    return plain(
        quality.constraint_report(
            table(spark, sf_dir, "lineitem"),
            "lineitem",
            quality.row_rules(**LINE_RULES),
            unique=["l_orderkey", "l_linenumber"],
            references={"part": (big_parts, {"l_partkey": "p_partkey"})},
        )
    )


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
              concat_ws(',', CASE WHEN l_extendedprice >= 99999.95 THEN 'type:l_extendedprice' END,
                             CASE WHEN l_partkey > 32767 THEN 'type:l_partkey' END,
                             CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'domain:l_returnflag' END) AS rules
       FROM lineitem WHERE l_extendedprice >= 99999.95 OR l_partkey > 32767 OR l_returnflag NOT IN ('A', 'N')"""
)
def constraint_violations(spark, sf_dir):
    broken = quality.violations(table(spark, sf_dir, "lineitem"), quality.row_rules(**LINE_RULES | {"max_length": {"l_linestatus": 1}}))
    return plain(
        broken.select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("_rules").alias("rules")
        )
    )


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_rows FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1"""
)
def duplicate_keys(spark, sf_dir):
    return plain(quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]))


@query(
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE substr(o_orderpriority, 1, 1) NOT IN (SELECT CAST(r_regionkey AS VARCHAR) FROM region)"""
)
def domain_misses(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.substring("o_orderpriority", 1, 1).alias("level")
    )
    levels = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("level"))
    return plain(quality.domain_misses(orders, "level", levels, "level").drop("level"))
