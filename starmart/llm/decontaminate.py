"""Benchmark text in documents, found through a positional inverted index spread over the cluster."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import blocks, hashed_words, stage_table, unused, utf8

WINDOW = 10
SLICE_CHARS = 8 << 20  # benchmark characters searched for, and broadcast, at once

# ---- index


def _segment(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word bounds of the rows; sorted terms; where each term's postings begin; all postings, by term and position."""
    hashes, bounds = hashed_words(*utf8(texts))
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    return bounds, ordered[heads], np.r_[heads, len(order)], order


def _index_pass(batches):
    task = TaskContext.get().partitionId()
    numbers = itertools.count()
    for batch in batches:
        for block in blocks(batch, "text"):
            bounds, terms, heads, postings = _segment(block.column(1))
            gaps = np.diff(postings, prepend=0)
            gaps[heads[:-1]] = postings[heads[:-1]]  # each list begins with a position, then distances
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 32) + next(numbers)], pa.int64()),
                    pa.array([block.column(0).to_pylist()], pa.list_(block.column(0).type)),
                    pa.array([np.diff(bounds)], pa.list_(pa.int64())),
                    pa.array([terms.tobytes()], pa.binary()),
                    pa.array([heads.astype("<i4").tobytes()], pa.binary()),
                    pa.array([gaps.astype("<i4").tobytes()], pa.binary()),
                ],
                ["segment", "doc_ids", "n_words", "terms", "heads", "postings"],
            )


def build_index(docs: DataFrame, label: str = "postings") -> DataFrame:
    """The stored index: one row per segment of about 2 MB of text.

    A segment holds its documents' ids and word counts, its terms (64-bit word hashes, sorted) and for each term the
    list of all its positions. Segments are made where the documents are read, so nothing is shuffled and a term that
    a third of all words are is spread over all segments. Words: A-Z lower-cased, runs of digits, letters and
    characters outside ASCII. Null text has no words.
    """
    schema = T.StructType(
        [
            T.StructField("segment", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)),
            T.StructField("n_words", T.ArrayType(T.LongType())),
            *(T.StructField(n, T.BinaryType()) for n in ("terms", "heads", "postings")),
        ]
    )
    return stage_table(docs.select("doc_id", "text").mapInArrow(_index_pass, schema), label)


class Segment:
    """Postings of one segment, decoded list by list."""

    def __init__(self, terms: bytes, heads: bytes, postings: bytes, n_words: list[int]):
        self.terms, self.heads, self.gaps = np.frombuffer(terms, np.uint64), np.frombuffer(heads, "<i4"), np.frombuffer(postings, "<i4")
        self.bounds = np.r_[0, np.cumsum(n_words)].astype(np.int64)
        self.lists: dict[int, np.ndarray] = {}

    def find(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each term here, and how often it occurs (0 where it doesn't)."""
        if not len(self.terms):
            return np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return at, np.where(self.terms[at] == terms, np.diff(self.heads)[at], 0).astype(np.int64)

    def positions(self, term: int) -> np.ndarray:
        if term not in self.lists:
            self.lists[term] = np.cumsum(self.gaps[self.heads[term] : self.heads[term + 1]].astype(np.int64))
        return self.lists[term]

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, positions, "right") - 1


def _near(sorted_positions: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether the list has an entry from low to high."""
    return np.searchsorted(sorted_positions, low) < np.searchsorted(sorted_positions, high, "right")


def phrase_starts(segment: Segment, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Starts of the exact phrase: offset-adjusted lists, intersected from the rarest term on."""
    order = np.argsort(counts, kind="stable")
    starts = segment.positions(terms[order[0]]) - order[0]
    for k in order[1:]:
        if not len(starts):
            return starts
        starts = starts[_near(segment.positions(terms[k]), starts + k, starts + k)]
    starts = starts[starts >= 0]
    return starts[segment.row_of(starts) == segment.row_of(starts + len(terms) - 1)]


def proximity_starts(segment: Segment, terms: np.ndarray, counts: np.ndarray, within: int) -> np.ndarray:
    """Positions of the rarest term with every other term at most ``within`` words away, in the same row."""
    order = np.argsort(counts, kind="stable")
    found = segment.positions(terms[order[0]])
    for k in order[1:]:
        row = segment.row_of(found)
        low, high = np.maximum(found - within, segment.bounds[row]), np.minimum(found + within, segment.bounds[row + 1] - 1)
        found = found[_near(segment.positions(terms[k]), low, high)]
    return found


# ---- search


def item_windows(texts: list[str | None], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of all windows (rows of ``window``, zero-padded), their lengths, and the item of each; repeats left out."""
    hashes, bounds = hashed_words(*utf8(pa.array(texts, pa.string())))
    rows, lengths, items = [], [], []
    for item, (a, b) in enumerate(itertools.pairwise(bounds)):
        own = hashes[a:b]
        if len(own):
            size = min(window, len(own))
            wins = np.unique(np.lib.stride_tricks.sliding_window_view(own, size), axis=0)
            rows.append(np.pad(wins, ((0, 0), (0, window - size))))
            lengths.append(np.full(len(wins), size))
            items.append(np.full(len(wins), item))
    if not rows:
        return np.zeros((0, window), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(lengths), np.concatenate(items)


def _search_pass(tests, window: int, within: int | None):
    def run(batches):
        names, wins, lengths, items = tests.value
        terms, inverse = np.unique(wins, return_inverse=True)
        inverse = inverse.reshape(wins.shape)
        padding = np.arange(window) >= lengths[:, None]
        for batch in batches:
            for segment, n_words, *lists in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                index = Segment(*lists, n_words)
                at, counts = index.find(terms)
                per_window = np.where(padding, np.iinfo(np.int64).max, counts[inverse])
                spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
                for w in np.flatnonzero(per_window.min(1) > 0):
                    n = lengths[w]
                    own, many = at[inverse[w, :n]], per_window[w, :n]
                    starts = phrase_starts(index, own, many) if within is None else proximity_starts(index, own, many, within)
                    row = index.row_of(starts)
                    for r, s in zip(row.tolist(), (starts - index.bounds[row]).tolist(), strict=True):
                        spans.setdefault((r, int(items[w])), []).append((s, s + int(n) if within is None else s + 1))
                keys = list(spans)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([segment] * len(keys), pa.int64()),
                        pa.array([r for r, _ in keys], pa.int32()),
                        pa.array([names[i] for _, i in keys], pa.string()),
                        pa.array([[x for x, _ in _union(spans[k])] for k in keys], pa.list_(pa.int32())),
                        pa.array([[y for _, y in _union(spans[k])] for k in keys], pa.list_(pa.int32())),
                    ],
                    ["segment", "row", "item_id", "starts", "ends"],
                )

    return run


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    return merged


def _slices(items: DataFrame, slice_chars: int) -> Iterator[list]:
    """The items in parts of about ``slice_chars`` characters, so that what is broadcast has a bound."""
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = total // slice_chars + 1
    for k in range(parts):
        yield items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).collect()


def matches(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, within: int | None = None, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """Where items occur: (segment, row, item_id as text, starts, ends), word positions in the document, ends exclusive.

    Exact phrases of ``window`` consecutive item words by default (an item with fewer words is one phrase); with
    ``within``, proximity matches: the rarest word of a window with all its other words at most so many words away.
    A larger benchmark is searched for in several passes over the stored index.
    """
    spark = index.sparkSession
    found = None
    for rows in _slices(benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text"), slice_chars):
        tests = spark.sparkContext.broadcast(([r.item_id for r in rows], *item_windows([r.text for r in rows], window)))
        part = index.select("segment", "n_words", "terms", "heads", "postings").mapInArrow(
            _search_pass(tests, window, within), "segment bigint, row int, item_id string, starts array<int>, ends array<int>"
        )
        found = part if found is None else found.unionAll(part)
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit (words inside any occurrence), item_ids (sorted, as text).

    Rows that share a doc_id get a row each. A benchmark row with null text matches nothing; one without item_id
    marks words and names no item. Empty tables give no rows, or rows without hits.
    """
    index = build_index(docs)
    # spans of all items of one document, in order; each adds what lies beyond the reach of those before it
    covered = F.aggregate(
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends")))),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("reach")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["ends"] - F.greatest(x["starts"], acc["reach"]))).alias("n"),
            F.greatest(acc["reach"], x["ends"]).alias("reach"),
        ),
        lambda acc: acc["n"],
    )
    hits = matches(index, benchmark, window, slice_chars=slice_chars).groupBy("segment", "row").agg(
        covered.alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("item_ids")
    )
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("row", "doc"))
    return rows.join(hits, ["segment", "row"], "left").select(
        F.col("doc.doc_ids").alias("doc_id"),
        F.col("doc.n_words").alias("n_words"),
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without any benchmark window. Rows that share a doc_id, or have none, are judged each by its own text."""
    rows = docs.select(F.struct("doc_id", F.xxhash64("text").alias("text_key")).alias("doc_id"), "text")
    doc, key = unused(docs, "doc", "key")
    bad = contamination(rows, benchmark, window).filter("n_hit > 0").select(F.col("doc_id.doc_id").alias(doc), F.col("doc_id.text_key").alias(key)).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(key)), "left_anti").select(*docs.columns)
