"""Nothing read is lost: stored, replaced, quarantined or dropped with a reason, however often it is read."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators import decode
from starmart.plans import load
from starmart.sources.tables import read_table
from starmart.streaming import streams
from tests.test_load import RESULTS, result, topic_rows

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("at", T.StringType())])


@pytest.mark.parametrize(
    "text, reads",
    [
        ('{"k":1}', True),
        (' {"k":1}\n', True),
        ('{"k":1, "a":[{"x":1}]}', True),
        ('{"k":1, "s":"}]"}', True),
        ('{"k":1}] trailing', False),
        ('{"k":1}]', False),
        ('{"k":1}],[{"k":2}', False),
        ('{"k":1}] {"k":2}', False),
        ('{"k":1}\t]\n,"end":1}', False),
        ('{"k":1},"end":1}', False),
        ('{"k":1},"end":1} ]', False),
        ('{"k":1},{"k":2}', False),
        ('[{"k":1}]', False),
        ("] [", False),
        ("", False),
        (None, False),
    ],
)
def test_a_message_is_one_object(spark, text, reads):
    row = decode.decode_messages(spark.createDataFrame([(text,)], "value string"), SCHEMA).collect()[0]
    assert (row[decode.CORRUPT] is None, row.k) == ((True, 1) if reads else (False, None))


HIDDEN = [b'{"k":1}] trailing', b'{"year":2024}],[{"year":2024}', b'{"year":2024}] {"year":2024}']


def test_all_that_is_read_is_accounted_for(spark, tmp_path):
    path = str(tmp_path / "w")
    messages = topic_rows(spark, RESULTS + HIDDEN)
    for turn in (1, 2):
        load.load_race_results(spark, messages, path)
        counts = {(r.outcome, r.reason): r.n for r in read_table(spark, f"{path}/loads").groupBy("outcome", "reason").agg(F.sum("messages").alias("n")).collect()}
        assert sum(counts.values()) == turn * len(RESULTS + HIDDEN)
        assert counts["quarantined", "unreadable"] == turn * 6
        assert {k: n for k, n in counts.items() if k[0] == "dropped"} == {("dropped", "driver_id"): turn, ("dropped", "position"): turn}
        # reading the messages again leaves one row each
        assert read_table(spark, f"{path}/quarantine/race_result").count() == 7
        assert read_table(spark, f"{path}/dropped/race_result").count() == 2
        assert read_table(spark, f"{path}/fact_race_result").count() == 8
    good = counts["good", None] // 2
    assert good == 8 + 1  # one is a replay of another
    assert good + 7 + 2 == len(RESULTS + HIDDEN)


def test_messages_without_an_offset_are_all_kept(spark, tmp_path):
    raw = spark.createDataFrame([(b"broken",), (b"broken",)], "value binary")
    load.load_race_results(spark, raw, str(tmp_path / "w"))
    assert read_table(spark, f"{tmp_path}/w/quarantine/race_result").count() == 2
    # another message at a known offset, as after a topic was made anew
    for value in (b"one", b"two", b"one"):
        load.load_race_results(spark, topic_rows(spark, [value]), str(tmp_path / "v"))
    assert read_table(spark, f"{tmp_path}/v/quarantine/race_result").count() == 2


def stream_of(spark, path, *parts):
    for part in parts:
        rows = [(json.dumps(m) if isinstance(m, dict) else m,) for m in part]
        spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").parquet(path)
    return streams.stream_files(spark, path, T.StructType([T.StructField("value", T.StringType())]), max_files=1)


def at(k, hour):
    return {"k": k, "at": f"2024-01-01T{hour:02d}:00:00"}


def test_late_rows_are_kept_apart(spark, tmp_path):
    stream = stream_of(spark, str(tmp_path / "in"), [at(1, 5), at(2, 1), "x"], [at(3, 3), at(4, 9), {"k": 5}], [at(6, 7), at(7, 8)])
    path = str(tmp_path / "out")
    streams.split_stream(stream, SCHEMA, path, str(tmp_path / "c1"), event_time="at", delay_seconds=3600)
    good = {r.k for r in read_table(spark, f"{path}/good").collect()}
    bad = {(r.k, r._reason) for r in read_table(spark, f"{path}/bad").collect()}
    assert good == {1, 2, 4, 5, 7} and bad == {(None, "unreadable"), (3, "late"), (6, "late")}
    with pytest.raises(Exception, match="another checkpoint"):
        streams.split_stream(stream, SCHEMA, path, str(tmp_path / "c2"), event_time="at", delay_seconds=3600)


def test_a_large_batch_is_written_by_many_tasks(spark, tmp_path):
    long = F.concat_ws("", *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 256) for i in range(16)])
    rows = spark.range(8000).select(F.when(F.col("id") % 2 == 0, F.concat(F.lit('{"k":1, "at":"'), long, F.lit('"}'))).otherwise(long).alias("value"))
    rows.write.parquet(str(tmp_path / "in"))
    path = str(tmp_path / "out")
    streams.split_stream(streams.stream_files(spark, str(tmp_path / "in"), rows.schema), SCHEMA, path, str(tmp_path / "c"))
    for kind in ("good", "bad"):
        written = read_table(spark, f"{path}/{kind}")
        assert written.count() == 4000 and written.select(F.input_file_name()).distinct().count() > 1


def test_a_batch_handed_over_again_replaces_itself(spark, tmp_path):
    stream = stream_of(spark, str(tmp_path / "in"), [at(1, 5), at(2, 1), "x"])
    for run in ("c1", "c2"):
        streams.split_stream(stream, SCHEMA, str(tmp_path / "out"), str(tmp_path / run), event_time="at", delay_seconds=60)
        assert sorted(r.k for r in read_table(spark, str(tmp_path / "out/good")).collect()) == [1, 2]
        assert read_table(spark, str(tmp_path / "out/bad")).count() == 1


def test_rows_needed_by_the_load_only(spark, tmp_path):
    messages = topic_rows(spark, [result(2024, 1, " ", "Red", None, 0.0), result(2024, 1, "ver", "Red", 1, 25)])
    load.load_race_results(spark, messages, str(tmp_path / "w"))
    (row,) = read_table(spark, f"{tmp_path}/w/dropped/race_result").collect()
    assert row["_lacking"] == "driver_id,position" and row.offset == 0
