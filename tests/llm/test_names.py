"""Every operator and stage on frames whose columns have the names of helper columns: the values come back unchanged."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import best_fit, decontaminate, line_dedup, periodic_runs, simhash, suffix_dedup, token_alignment, token_packing
from starmart.llm.common import unused

NAMES = [
    "_digests", "_drop_id", "digests", "drop_id", "_print", "_first", "_fingerprint", "_n", "_doc", "_key", "_group", "doc", "key", "group",
    "nth", "print", "first", "fingerprint", "component_id", "kept_print", "text_key", "row", "chunk", "runs", "n_words", "links", "seed", "cell",
    "marks", "spans", "digest", "keeper", "holders", "segment", "terms", "kept", "cluster_id", "_hash", "a", "b", "n", "low",
]
TEXTS = [
    "the quick brown fox jumps over the lazy dog by the river and back again",
    "the quick brown fox jumps over the lazy dog by the river and back again",
    "a line of its own\nthis very line is in three of the documents here\nend",
    "another one\nthis very line is in three of the documents here\nand so on",
    "third text\nthis very line is in three of the documents here\nwith more",
    "one two three four five six seven eight nine ten eleven twelve",
    "",
]


@pytest.fixture
def odd(spark):
    base = spark.createDataFrame([(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return base.withColumns({n: F.concat(F.lit(f"{n}:"), F.col("doc_id")) for n in NAMES})


def unchanged(df):
    for row in df.collect():
        assert all(row[n] == f"{n}:{row.doc_id}" for n in NAMES if n in df.columns and n != "n_words")
    return df.columns


def test_unused_names(spark):
    df = spark.createDataFrame([(1, 2)], "key int, _KEY int")
    assert unused(df, "key", "key", "other") == ["__key", "___key", "other"]


def test_operators_that_return_documents(spark, odd):
    bench = spark.createDataFrame([(1, TEXTS[5])], "item_id bigint, text string")
    for found, n in (
        (line_dedup.drop_repeated_lines(odd, counts=False), 7),
        (simhash.drop_near_duplicates(odd), 6),
        (decontaminate.drop_contaminated(odd, bench), 6),
    ):
        assert unchanged(found) == odd.columns and found.count() == n
    assert set(unchanged(simhash.with_components(odd, "cluster"))) == {*odd.columns, "cluster"}


def test_operators_that_return_their_own_columns(odd):
    rows = odd.count()
    for found in (
        simhash.near_duplicates(odd), suffix_dedup.drop_repeats(odd), periodic_runs.find_runs(odd), token_alignment.align(odd, chunk=50),
        decontaminate.contamination(odd, odd.select(F.col("doc_id").alias("item_id"), "text")),
    ):
        assert found.count() == rows
    assert token_packing.pack_tokens(odd).count() > 0
    assert best_fit.best_fit_bins(simhash.with_components(odd, "cluster"), cluster="cluster").count() > 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[1:])
def test_stages(spark, odd, sf_dir, name, stage):
    found = stage(spark, odd, sf_dir)
    assert found.count() > 0
    if name != "best_fit_packing":
        assert unchanged(found) == odd.columns
