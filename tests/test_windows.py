"""Ranks, positions and neighbours against plain Python, on skewed groups, ties and missing values."""

import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators import ranges, windows


@pytest.fixture(params=["1", "29"], ids=["one range", "many ranges"])
def mode(spark, request):
    spark.conf.set(ranges.RANGES, request.param)
    yield request.param
    spark.conf.unset(ranges.RANGES)


def skewed_rows(seed=7, n=600):
    """Two thirds of the rows in one group, a third of all rows with one score, some scores missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = "hot" if rng.random() < 0.66 else rng.choice(["a", "b", None])
        score = 10 if rng.random() < 0.33 else None if rng.random() < 0.1 else rng.randrange(200)
        rows.append((group, i, score))
    return rows


def want_ranks(rows):
    groups = defaultdict(list)
    for group, _, score in rows:
        groups[group].append(score)

    def better(a, b):
        return a is not None and (b is None or a > b)

    return {i: 1 + sum(better(other, score) for other in groups[group]) for group, i, score in rows}


def frame(spark, rows):
    return spark.createDataFrame(rows, "grp string, id int, score int").repartition(7)


def test_rank_within(spark, mode):
    rows = skewed_rows()
    got = windows.rank_within(frame(spark, rows), ["grp"], "score", "rk").collect()
    assert {r.id: r.rk for r in got} == want_ranks(rows)
    assert len(got) == len(rows)


def test_rank_of_decimals_and_all_missing(spark, mode):
    rows = [("a", i, None) for i in range(30)] + [("b", 100 + i, i % 3) for i in range(30)]
    df = frame(spark, rows).withColumn("score", F.col("score").cast("decimal(14,1)"))
    got = {r.id: r.rk for r in windows.rank_within(df, ["grp"], "score", "rk").collect()}
    assert got == want_ranks(rows)


def test_top_ranked(spark, mode):
    rows = skewed_rows()
    want = {i: rk for i, rk in want_ranks(rows).items() if rk <= 3}
    got = windows.top_ranked(frame(spark, rows), ["grp"], "score", 3, "rk").collect()
    assert {r.id: r.rk for r in got} == want


def test_top_ranked_beyond_the_group_limit(spark, mode):
    rows = [("a", i, i // 2) for i in range(2500)]
    got = windows.top_ranked(frame(spark, rows), ["grp"], "score", 1001, "rk").collect()
    assert sorted(r.id for r in got) == list(range(2500 - 1002, 2500))
    assert max(r.rk for r in got) == 1001


def test_top_ranked_with_a_common_best_score(spark):
    rows = [("a", i, 5) for i in range(50)] + [("a", 100 + i, i % 5) for i in range(50)]
    got = windows.top_ranked(frame(spark, rows), ["grp"], "score", 1, "rk").collect()
    assert sorted(r.id for r in got) == list(range(50))


def in_order(rows):
    """Rows per group in ascending (score, id) order, missing scores last."""
    groups = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[1])):
        groups[row[0]].append(row)
    return groups


def test_position_within(spark, mode):
    rows = skewed_rows()
    want = {row[1]: n for group in in_order(rows).values() for n, row in enumerate(group, 1)}
    got = windows.position_within(frame(spark, rows), ["grp"], ["score", "id"], "n").collect()
    assert {r.id: r.n for r in got} == want


def test_previous_value(spark, mode):
    rows = skewed_rows()
    want = {}
    for group in in_order(rows).values():
        for before, row in zip([None, *group], group):
            want[row[1]] = before and before[2]
    got = windows.previous_value(frame(spark, rows), ["grp"], ["score", "id"], "score", "prev").collect()
    assert {r.id: r.prev for r in got} == want


@pytest.mark.parametrize(("rows", "kept"), [(0, 0), (1, 1), (50, 1), (51, 2), (101, 3)])
def test_every_nth_sizes(spark, mode, rows, kept):
    df = spark.range(rows).select(F.lit("ver").alias("driver"), F.col("id").cast("int").alias("sample"))
    got = windows.every_nth(df, ["driver"], ["sample"], 50).collect()
    assert sorted(r["sample"] for r in got) == [50 * i for i in range(kept)]
    assert all(set(r.asDict()) == {"driver", "sample"} for r in got)


def test_ranges_follow_the_order_and_are_even(spark):
    spark.conf.set(ranges.RANGES, "30")
    df = spark.range(9000).select(
        F.when(F.col("id") < 3000, F.lit(500)).otherwise(F.col("id") % 1000).cast("int").alias("t"), F.col("id")
    )
    placed = ranges.in_ranges(df, [], [F.col("t"), F.col("id")])
    spark.conf.unset(ranges.RANGES)
    sizes = [r["count"] for r in placed.groupBy(ranges.RANGE).count().collect()]
    assert sum(sizes) == 9000 and max(sizes) < 3 * 9000 / 30
    spans = placed.groupBy(ranges.RANGE).agg(F.min(F.struct("t", "id")).alias("lo"), F.max(F.struct("t", "id")).alias("hi"))
    spans = sorted((r[ranges.RANGE], tuple(r.lo), tuple(r.hi)) for r in spans.collect())
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


ORDERS = {
    "string": [None, "", "a", "B", "ä", "zz"],
    "date": [None, "2024-01-01", "1999-12-31"],
    "decimal(20,4)": [None, "1.0001", "1.0002", "-3"],
    "timestamp": [None, "2024-03-31 01:59:59.999999", "2024-03-31 02:00:00"],
    "double": [None, "NaN", "-1.5", "0", "Infinity"],
    "bigint": [None, str(2**60), str(2**60 + 1), "-7"],
}


@pytest.mark.parametrize("kind", ORDERS)
def test_any_type_gives_the_plain_window_result(spark, mode, kind):
    rows = [("hot" if i % 3 else "b", i, ORDERS[kind][i * 7 % len(ORDERS[kind])]) for i in range(120)]
    df = spark.createDataFrame(rows, "grp string, id int, score string").withColumn("score", F.col("score").cast(kind)).repartition(5)
    along = Window.partitionBy("grp").orderBy(F.col("score").asc_nulls_last(), "id")
    best = Window.partitionBy("grp").orderBy(F.col("score").desc_nulls_last())
    want = df.select("id", F.row_number().over(along).alias("n"), F.lag("id").over(along).alias("prev"), F.rank().over(best).alias("rk"))
    want = {r.id: (r.n, r.prev, r.rk) for r in want.collect()}
    n = {r.id: r.n for r in windows.position_within(df, ["grp"], ["score", "id"], "n").collect()}
    prev = {r.id: r.prev for r in windows.previous_value(df, ["grp"], ["score", "id"], "id", "prev").collect()}
    rk = {r.id: r.rk for r in windows.rank_within(df, ["grp"], "score", "rk").collect()}
    assert {i: (n[i], prev[i], rk[i]) for i in want} == want


def test_times_order_ranges(spark, mode):
    df = spark.range(100).select(
        F.lit(1).alias("k"),
        F.col("id"),
        F.timestamp_add("MICROSECOND", F.col("id").cast("int") * 333, F.lit("2024-03-31 00:59:59.99").cast("timestamp_ntz"))
        .alias("ts"),
    )
    got = windows.position_within(df.repartition(5), ["k"], ["ts"], "n").collect()
    assert all(r.n == r.id + 1 for r in got)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["x", "y"]), st.one_of(st.none(), st.integers(-5, 5), st.integers(-(10**6), 10**6))),
        min_size=1,
        max_size=60,
    )
)
def test_ranges_agree_with_plain_windows(spark, pairs):
    rows = [(g, i, s) for i, (g, s) in enumerate(pairs)]
    spark.conf.set(ranges.RANGES, "9")
    try:
        got = windows.rank_within(frame(spark, rows), ["grp"], "score", "rk").collect()
    finally:
        spark.conf.unset(ranges.RANGES)
    assert {r.id: r.rk for r in got} == want_ranks(rows)


def test_windows_write_nothing_and_shuffle_rows_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("starmart.sources.staging.new_folder", lambda *_: pytest.fail("a staged copy"))
    path = f"{tmp_path}/rows"
    frame(spark, skewed_rows()).withColumn("note", F.lit("x")).write.parquet(path)
    df = spark.read.parquet(path)
    for made in (
        windows.every_nth(df, ["grp"], ["score", "id"], 5),
        windows.previous_value(df, ["grp"], ["score", "id"], "id", "prev"),
        windows.rank_within(df, ["grp"], "score", "rk"),
    ):
        plan = made._jdf.queryExecution().executedPlan().toString().split("\n")
        scans = [line for line in plan if "FileScan" in line and "note" in line]
        assert len(scans) == 1  # whole rows are read once; the other scans read keys and order only
        assert not any("RoundRobin" in line or "rangepartitioning" in line for line in plan)
