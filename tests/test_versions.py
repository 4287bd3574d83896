"""Tables switched by a manifest: one write a partition, dead writes without effect, old folders removed by name."""

import pytest
from pyspark.sql import functions as F

from starmart.operators import facts
from starmart.sources import tables, versions
from starmart.sources.tables import read_table, upsert_table, write_partitioned

SCHEMA = "k int, at int, v string, year smallint, round smallint"
PARTS = ["year", "round"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def first_rows(spark):
    return frame(spark, [(k, 1, f"a{k}", 2020 + k % 3, k % 2) for k in range(30)])


def put(spark, path, rows):
    upsert_table(spark, path, rows, ["year", "round", "k"], ["at"], PARTS, ["k"])


def content(df):
    return sorted(tuple(r) for r in df.select("k", "at", "v", "year", "round").collect())


def parquet_files(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet") if "_draft-" not in str(p)}


def test_each_touched_partition_is_written_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    put(spark, path, first_rows(spark))
    before = parquet_files(tmp_path / "t")
    written = []
    real = versions.write_commit
    monkeypatch.setattr(versions, "write_commit", lambda *a: written.append(real(*a)) or written[-1])
    put(spark, path, frame(spark, [(0, 2, "new", 2020, 0), (99, 2, "new", 2020, 0)]))
    after = parquet_files(tmp_path / "t")
    assert [p for _, p in written] == [["year=2020/round=0"]]
    fresh = set(after) - set(before)
    assert fresh and all("year=2020/round=0/" in str(p) for p in fresh)
    assert all(after[p] == before[p] for p in set(after) & set(before))
    assert {p for p in before if "year=2020/round=0/" not in str(p)} == set(after) & set(before)
    got = {r[0]: r[2] for r in content(read_table(spark, path))}
    assert len(got) == 31 and got[0] == got[99] == "new" and got[6] == "a6"


@pytest.mark.parametrize("dies_at", ["write_commit", "publish"])
def test_a_dead_write_leaves_the_old_version(spark, tmp_path, monkeypatch, dies_at):
    path = str(tmp_path / "t")
    put(spark, path, first_rows(spark))
    want = content(first_rows(spark))
    real = getattr(versions, dies_at)

    def die(*args):
        if dies_at == "write_commit":
            real(*args)  # the files are there, the switch is not
        raise RuntimeError("killed")

    monkeypatch.setattr(versions, dies_at, die)
    with pytest.raises(RuntimeError, match="killed"):
        put(spark, path, frame(spark, [(0, 2, "new", 2020, 0)]))
    assert content(read_table(spark, path)) == want
    monkeypatch.undo()
    assert versions.remove_old_versions(spark, path, PARTS) == 1
    put(spark, path, frame(spark, [(0, 2, "new", 2020, 0)]))
    assert content(read_table(spark, path)) == content(spark.read.schema(first_rows(spark).schema).parquet(path))


def test_a_draft_of_a_killed_job_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, first_rows(spark))
    first_rows(spark).write.partitionBy(*PARTS).parquet(f"{path}/_draft-dead")
    assert read_table(spark, path).count() == spark.read.parquet(path).count() == 30
    assert versions.remove_old_versions(spark, path, PARTS) == 1 and not (tmp_path / "t" / "_draft-dead").exists()


def test_old_versions_stay_as_long_as_asked(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set(versions.KEEP, "1")
    try:
        put(spark, path, first_rows(spark))
        old = read_table(spark, path)
        put(spark, path, frame(spark, [(0, 2, "b", 2020, 0)]))
        assert content(old) == content(first_rows(spark))  # a reader of the version before goes on
        put(spark, path, frame(spark, [(0, 3, "c", 2020, 0)]))
        assert [v for v in versions._versions(spark, path)] == [2, 3]
        back = versions.read_version(spark, path, versions.manifest(spark, path, 2), first_rows(spark).schema)
        assert {r[0]: r[2] for r in content(back)}[0] == "b"
    finally:
        spark.conf.unset(versions.KEEP)
    assert versions.remove_old_versions(spark, path, PARTS) == 1
    assert {r[0]: r[2] for r in content(read_table(spark, path))}[0] == "c"
    assert spark.read.parquet(path).count() == 30


def test_two_writers_from_one_version(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, first_rows(spark))
    before = versions.manifest(spark, path)
    put(spark, path, frame(spark, [(0, 2, "b", 2020, 0)]))
    with pytest.raises(versions.CommitConflict):
        versions.replace_partitions(frame(spark, [(1, 9, "lost", 2021, 1)]), path, PARTS, before=before)
    assert {r[0]: r[2] for r in content(read_table(spark, path))}[1] == "a1"


def test_a_plain_folder_is_adopted(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(first_rows(spark), path, PARTS)
    put(spark, path, frame(spark, [(0, 2, "b", 2020, 0), (50, 1, "c", 2031, 7)]))
    got = {r[0]: r[2] for r in content(read_table(spark, path, first_rows(spark).schema))}
    assert len(got) == 31 and got[0] == "b" and got[50] == "c" and got[7] == "a7"
    assert spark.read.parquet(path).count() == 31


def test_tables_without_partitions_and_appends(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert read_table(spark, path) is None
    versions.append_rows(rows, path, [], marks={"largest": 2})
    versions.append_rows(rows.filter("k = 1"), path, [])
    assert sorted(map(tuple, read_table(spark, path).collect())) == [(1, "a"), (1, "a"), (2, "b")]
    versions.replace_partitions(rows.filter("k = 2"), path, [])
    assert list(map(tuple, read_table(spark, path, rows.schema).collect())) == [(2, "b")]
    assert versions.manifest(spark, path).marks == {"largest": 2}
    versions.append_rows(rows.limit(0), path, [])
    assert read_table(spark, path).count() == 1


def test_odd_partition_values(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a/b c%[x]*"), (2, None), (3, "ü{1}=?"), (4, "")], "k int, p string")
    for _ in range(2):
        versions.replace_partitions(rows, path, ["p"], ["k"])
    got = sorted(tuple(r) for r in read_table(spark, path, rows.schema).collect())
    assert got == [(1, "a/b c%[x]*"), (2, None), (3, "ü{1}=?"), (4, None)]


def test_only_live_folders_are_planned(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, first_rows(spark))
    table = read_table(spark, path, first_rows(spark).schema)
    touched = tables.touched_partitions(table, frame(spark, [(0, 2, "b", 2020, 0)]), PARTS)
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((year" in plan or "PartitionFilters: [(year" in plan
    assert len(touched.inputFiles()) == len(table.inputFiles())  # the index knows live files only
    assert facts.upsert(touched, frame(spark, [(0, 2, "b", 2020, 0)]), ["k"], ["at"]).count() == 5
    assert touched.agg(F.max("k")).first()[0] == 24
