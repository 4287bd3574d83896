"""Dimensions, keys, upserts, conformance and constraint reports on hand-made rows."""

import decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators import dims, facts, marts, quality
from starmart.schemas import table_schema
from starmart.sources import tables
from starmart.sources.tables import read_table, touched_partitions, upsert_table, write_partitioned


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_current_team_is_the_latest_known(spark):
    rows = [
        ("ver", "Max", "A", 2023, 1), ("ver", None, "B", 2023, 5), ("ver", "Max V", None, 2023, 9),
        ("ham", "Lewis", "S", 2023, 2),
    ]
    df = spark.createDataFrame(rows, "driver_id string, driver_name string, team string, year int, round int")
    got = {r.driver_id: (r.driver_name, r.current_team) for r in dims.driver_dimension(df, ["year", "round"]).collect()}
    assert got == {"ver": ("Max V", "B"), "ham": ("Lewis", "S")}


def test_keys_are_dense_unique_and_repeatable(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k")).repartition(13)
    one = {r.k: r.key for r in dims.assign_keys(df, ["k"], "key").collect()}
    two = {r.k: r.key for r in dims.assign_keys(df.repartition(3), ["k"], "key").collect()}
    assert one == two and sorted(one.values()) == list(range(1, 5001))


def test_keys_continue_after_the_existing_ones(spark):
    seed = dims.assign_keys(dims.tyre_seed(spark), ["compound"], "tyre_id")
    more = spark.createDataFrame([("SOFT", "#123456"), ("HYPER", "#FF00FF"), ("HYPER", "#FF00FF")], "compound string, colour_hex string")
    both = dims.insert_if_absent(seed, more, ["compound"], "tyre_id")
    got = {r.compound: (r.tyre_id, r.colour_hex) for r in both.collect()}
    assert len(got) == 6 and both.count() == 6
    assert got["HYPER"] == (6, "#FF00FF") and got["SOFT"][1] == "#FF0000"
    # seeding again adds nothing
    again = dims.insert_if_absent(both, dims.tyre_seed(spark), ["compound"], "tyre_id")
    assert again.count() == 6


def test_upsert_prefers_newer_then_incoming(spark):
    old = spark.createDataFrame([(1, 5, "old"), (2, 5, "old"), (3, 5, "old")], "k int, at int, v string")
    new = spark.createDataFrame([(1, 6, "new"), (2, 4, "new"), (3, 5, "new"), (4, None, "new")], "k int, at int, v string")
    got = {r.k: r.v for r in facts.upsert(old, new, ["k"], ["at"]).collect()}
    assert got == {1: "new", 2: "old", 3: "new", 4: "new"}


def test_latest_per_key_limits_rows_before_the_shuffle(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = plan_of(facts.latest_per_key(orders, ["o_custkey"], ["o_orderdate"]))
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit") and "Partial" in plan


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, at int, year smallint, round smallint"
    first = spark.createDataFrame([(k, 1, 2020 + k % 4, k % 3) for k in range(40)], schema)
    upsert_table(spark, path, first, ["year", "round", "k"], ["at"], ["year", "round"])
    untouched = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t" / "year=2020").rglob("*.parquet")}
    second = spark.createDataFrame([(1, 2, 2021, 1), (99, 2, 2021, 1)], schema)
    for _ in range(2):
        upsert_table(spark, path, second, ["year", "round", "k"], ["at"], ["year", "round"])
    got = {(r.year, r.round, r.k): r["at"] for r in read_table(spark, path).collect()}
    assert len(got) == 41 and got[(2021, 1, 1)] == 2 and got[(2021, 1, 99)] == 2 and got[(2021, 2, 5)] == 1
    assert {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t" / "year=2020").rglob("*.parquet")} == untouched
    plan = plan_of(touched_partitions(read_table(spark, path, first.schema), second, ["year", "round"]))
    assert "PartitionFilters: [((year" in plan or "PartitionFilters: [(year" in plan


def test_partitioned_read_prunes_and_pushes(spark, sf_dir, tmp_path):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("year", F.year("o_orderdate"))
    write_partitioned(orders, str(tmp_path / "o"), ["year"], ["o_custkey"])
    plan = plan_of(read_table(spark, str(tmp_path / "o")).filter("year = 1997 and o_custkey = 5").select("o_orderkey"))
    assert "PartitionFilters: [isnotnull(year" in plan and "EqualTo(o_custkey,5)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_rebalance_splits_a_partition_that_holds_most_rows(spark, tmp_path):
    year = F.when(F.col("id") < 190_000, 2024).otherwise(2023).alias("year")
    df = spark.range(200_000).select(year, F.sha2(F.col("id").cast("string"), 256).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1000000")
    try:
        write_partitioned(df, str(tmp_path / "t"), ["year"], ["v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "year=2024").glob("*.parquet"))) > 3
    assert read_table(spark, str(tmp_path / "t")).count() == 200_000


def test_conform_casts_defaults_and_nulls(spark):
    rows = [("1", 12345.5, None, "x"), ("70000", 25.0, True, "y")]
    df = spark.createDataFrame(rows, "round string, points double, is_winner boolean, extra string")
    target = T.StructType.fromDDL(
        "year smallint, round smallint, points decimal(4,1), is_winner boolean, ingested_at timestamp"
    )
    got = facts.conform(df, target, F.lit("2024-01-01").cast("timestamp"), ["is_winner"], ["ingested_at"])
    assert got.schema == T.StructType([T.StructField(f.name, f.dataType, got.schema[f.name].nullable) for f in target])
    assert [tuple(r)[:4] for r in got.collect()] == [(None, 1, None, False), (None, None, decimal.Decimal("25.0"), True)]


def test_each_rule_counts_once(spark):
    rows = [("VER", 1, 25.0, "SOFT"), ("TOO_LONG_AN_ID", 1, 25.0, "SOFT"), (None, 2, 12345.5, "GRAVEL"), ("HAM", 40000, None, None)]
    df = spark.createDataFrame(rows, "driver_id string, round int, points double, compound string")
    rules = quality.row_rules(["driver_id"], {"driver_id": 10}, {"points": "decimal(4,1)", "round": "smallint"}, {"compound": ["SOFT"]})
    drivers = spark.createDataFrame([("VER",)], "id string")
    report = quality.constraint_report(df, "t", rules, ["round"], {"driver": (drivers, {"driver_id": "id"})})
    assert {r.rule: r.n_violations for r in report.collect()} == {
        "not_null:driver_id": 1, "length:driver_id": 1, "type:points": 1, "type:round": 1, "domain:compound": 1,
        "unique:round": 1, "reference:driver": 2,
    }
    broken = {r.driver_id: r._rules for r in quality.violations(df, rules).collect()}
    assert broken[None] == "not_null:driver_id,type:points,domain:compound" and "VER" not in broken


def test_strategy_text_skips_missing_and_keeps_all_missing_null(spark):
    rows = [("a", 30, "HARD", 2.0), ("a", 10, "SOFT", 1.0), ("a", 20, None, None), ("b", 5, None, None)]
    df = spark.createDataFrame(rows, "driver_id string, lap_number int, compound string, pit_duration_sec double")
    got = {r.driver_id: tuple(r)[1:] for r in marts.pit_strategy(df, ["driver_id"]).collect()}
    assert got == {"a": (3, 1.5, 1.0, "SOFT → HARD"), "b": (1, None, None, None)}


def test_standings_ranks_ties_missing_points_and_unknown_drivers(spark):
    rows = [(2024, "A", 10.0), (2024, "B", 10.0), (2024, "C", 1.0), (2024, "D", None), (2023, "A", 1.0)]
    df = spark.createDataFrame(rows, "year int, driver_id string, points double").withColumns(
        {"points": F.col("points").cast("decimal(4,1)"), "is_winner": F.lit(False), "is_points_finish": F.lit(None).cast("boolean")}
    )
    names = spark.createDataFrame([("A", "Ann"), ("B", "Bob"), ("D", "Dan")], "driver_id string, driver_name string")
    got = {(r.year, r.driver_id): (r.driver_name, r.championship_rank) for r in marts.driver_standings(df, names).collect()}
    assert got == {
        (2024, "A"): ("Ann", 1), (2024, "B"): ("Bob", 1), (2024, "C"): (None, 3), (2024, "D"): ("Dan", 4),
        (2023, "A"): ("Ann", 1),
    }


def test_comparison_stats(spark):
    rows = [("a", 1, 25.0), ("a", 3, 15.0), ("a", 4, None), ("b", None, None)]
    df = spark.createDataFrame(rows, "driver_id string, position int, points double")
    got = {r.driver_id: tuple(r)[1:] for r in marts.compare_entities(df).collect()}
    assert got == {"a": (8 / 3, 40.0, 1, 2), "b": (None, 0.0, 0, 0)}


def test_star_join_keeps_facts_without_dimension_rows(spark):
    fact = spark.createDataFrame([("VER", 1), (None, 2), ("ZZZ", 3)], "driver_id string, n int")
    dim = spark.createDataFrame([("VER", "Max")], "driver_id string, driver_name string")
    joined = marts.star_join(fact, [(dim, {"driver_id": "driver_id"}, ["driver_name"])])
    assert sorted((r.n, r.driver_name) for r in joined.collect()) == [(1, "Max"), (2, None), (3, None)]


def test_season_filter_reaches_the_scan(spark, sf_dir):
    from starmart.plans.mart_queries import _driver_totals

    plan = plan_of(_driver_totals(spark, sf_dir).filter("year = 1997"))
    scan = plan[plan.index("orders.parquet") - 1500 : plan.index("orders.parquet") + 600]
    assert "year(cast(o_orderdate" in scan


def test_table_schemas_parse():
    for name in ("dim_driver", "dim_circuit", "dim_team", "dim_tyre", "fact_race_result", "fact_pit_stop", "fact_weather"):
        assert table_schema(name).names


def test_filtering_a_season_before_or_after_ranking_is_the_same(spark, sf_dir):
    from starmart.plans.mart_queries import _driver_totals
    from starmart.operators.windows import rank_within, top_ranked
    from starmart.sources.staging import stage

    season = stage(_driver_totals(spark, sf_dir), "totals")
    after = rank_within(season, ["year"], "total_points").filter("year = 1998")
    before = rank_within(season.filter("year = 1998"), ["year"], "total_points")
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))
    assert "WindowGroupLimit" in plan_of(top_ranked(season, ["year"], "total_points", 3))


def test_upsert_beyond_the_listed_partitions_keeps_null_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MAX_LISTED_PARTITIONS", 1)
    path, schema = str(tmp_path / "t"), "year int, round int, k int, v int"
    first = [(2023, 1, 1, 0), (None, 1, 2, 0), (2024, None, 3, 0), (None, None, 4, 0), (2025, 1, 5, 0)]
    tables.upsert_table(spark, path, spark.createDataFrame(first, schema), ["year", "round", "k"], ["v"], ["year", "round"])
    more = [(2023, 1, 1, 9), (None, 1, 6, 9), (2024, None, 7, 9), (None, None, 8, 9)]
    tables.upsert_table(spark, path, spark.createDataFrame(more, schema), ["year", "round", "k"], ["v"], ["year", "round"])
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert got == {1: 9, 2: 0, 3: 0, 4: 0, 5: 0, 6: 9, 7: 9, 8: 9}


def test_fact_keys_of_all_races_differ(spark):
    rows = spark.createDataFrame([(y, r, "d") for y in (0, 2023, 2024, 32767) for r in (0, 1, 100, 32767)], "year int, round int, driver_id string")
    race = F.shiftleft(F.col("year").cast("bigint"), dims.ROUND_BITS) + F.col("round")
    known = spark.createDataFrame([], "year int, round int, driver_id string, result_id bigint")
    keyed = dims.assign_fact_keys(rows, ["year", "round", "driver_id"], "result_id", race, known)
    keys = [r.result_id for r in keyed.collect()]
    assert len({k >> dims.FACT_KEY_BITS for k in keys}) == 16 and min(keys) > 0
