"""Repeated byte strings by a sparse suffix array: suffixes are range-partitioned, sorted in buckets, compared across bounds.

Sorting every byte's suffix of a corpus moves many times its size. Here the text is cut into content-defined tokens, and
suffixes begin at tokens only: of the SEED-byte strings inside each string of ``length`` bytes, the one with the least hash
is its anchor, and a token (cell) is a run of neighbouring starts with one anchor. Equal strings have equal anchors at equal
distances, so a repeat is found among suffixes that begin with the same anchor (the leading token), and nowhere else.

A suffix is known by hashes of 64 bits: its seed, and the whole cell it begins with. Cells that agree in both are taken for
equal, and so are two strings of partly repeated cells that agree in one hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.bloom import filter_bits, suspected, twice_filter
from starmart.llm.common import blocks, prefix_sums, stage_table, stretch_hashes, unstage, utf8

LENGTH, SEED = 200, 100
MAX_FILTER_BITS = 1 << 30
CHUNK = 1 << 18  # bytes whose hashes are held at once
PLACE = np.uint64((1 << 24) - 1)

# ---- cells


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width``, in a few passes: the rest of a block before, the start of the next after."""
    n = len(values) - width + 1
    filled = np.r_[values, np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)].reshape(-1, width)
    after = np.minimum.accumulate(filled, axis=1).ravel()
    before = np.minimum.accumulate(filled[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(before[:n], after[width - 1 : width - 1 + n])


def _cells_of(data: np.ndarray, length: int, seed: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of every start in ``data``, and where a new cell begins (its first start is one)."""
    at = np.arange(len(data) - seed + 1)
    keyed = stretch_hashes(sums, at, at + seed) & ~PLACE | at.astype(np.uint64)  # of equal hashes the leftmost wins
    anchors = (_window_least(keyed, length - seed + 1) & PLACE).astype(np.int64)
    return anchors, np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])


def cells(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Row, first start (in the row), number of starts, seed hash and cell hash of every cell of the rows."""
    found = []
    row, first = 0, int(offsets[0])
    while row < len(offsets) - 1:
        # short rows are hashed together, a long row in chunks that overlap by a string less one byte
        end = int(np.searchsorted(offsets, first + CHUNK, "right")) - 1
        stop = int(offsets[end]) if end > row else min(first + CHUNK, int(offsets[row + 1]))
        part = data[first:stop]
        if len(part) >= length:
            sums = prefix_sums(part)
            anchors, heads = _cells_of(part, length, seed, sums)
            cuts = offsets[row + 1 : max(end, row) + 1] - first  # row bounds inside the part
            cuts = cuts[(cuts > 0) & (cuts < len(part))]
            inside = np.zeros(len(anchors) + 1, np.int32)  # starts whose string crosses a bound aren't any
            np.add.at(inside, np.clip(cuts - length + 1, 0, len(anchors)), 1)
            np.add.at(inside, np.clip(cuts, 0, len(anchors)), -1)
            valid = np.cumsum(inside[:-1]) == 0
            new = np.zeros(len(anchors), bool)
            new[heads] = True
            new[1:] |= valid[1:] & ~valid[:-1]
            own = np.flatnonzero(new & valid)
            ends = np.searchsorted(np.flatnonzero(new | ~valid), own, "right")
            ends = np.r_[np.flatnonzero(new | ~valid), len(anchors)][ends]
            of = np.searchsorted(offsets, own + first, "right") - 1
            found.append((of, own + first - offsets[of], ends - own, stretch_hashes(sums, anchors[own], anchors[own] + seed), stretch_hashes(sums, own, ends - 1 + length)))
        if stop == offsets[min(end, len(offsets) - 1)] and end > row:
            row, first = end, stop
        elif stop == offsets[row + 1]:
            row, first = row + 1, stop
        else:
            first = stop - length + 1
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _seed_pass(length: int, seed: int):
    def run(batches):
        for batch in batches:
            for block in blocks(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array(cells(*utf8(block.column(0)), length, seed)[3].view(np.int64))], ["seed"])

    return run


ENTRY = ["seed", "cell", "doc_id", "text_key", "low", "n"]


def _entry_pass(length: int, seed: int, packed):
    def run(batches):
        for batch in batches:
            for block in blocks(batch, "text"):
                of, low, n, seeds, own = cells(*utf8(block.column(2)), length, seed)
                keep = np.flatnonzero(suspected(packed.value, seeds))
                rows = pa.array(of[keep])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(seeds[keep].view(np.int64)),
                        pa.array(own[keep].view(np.int64)),
                        block.column(0).take(rows),
                        block.column(1).take(rows),
                        pa.array(low[keep].astype(np.int32)),
                        pa.array(n[keep].astype(np.int32)),
                    ],
                    ENTRY,
                )

    return run


# ---- the sorted array


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """Order by the first key, and where it ties by the next: only tied runs are partitioned again."""
    order = np.argsort(keys[0], kind="quicksort")
    tied = np.zeros(len(order), np.int64)
    for before, key in zip(keys, keys[1:], strict=False):
        ordered = before[order]
        tied = np.cumsum(np.r_[0, (ordered[1:] != ordered[:-1]) | (tied[1:] != tied[:-1])]) if len(order) else tied
        runs = np.bincount(tied)
        among = np.flatnonzero(runs[tied] > 1)
        if not len(among):
            break
        # tied runs stay where they are: a sort by run and key moves entries inside them only
        sub = order[among]
        order[among] = sub[np.lexsort((key[sub], tied[among]))]
    return order


def _run_sizes(new: np.ndarray) -> np.ndarray:
    """Size of the run each entry is in, where ``new`` marks first entries."""
    number = np.cumsum(new) - 1
    return np.bincount(number)[number] if len(new) else number


def _bucket_pass(batches):
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    bucket = pa.Table.from_batches(parts).combine_chunks()
    seeds, own = (np.asarray(bucket.column(k)) for k in (0, 1))
    order = multikey_order([seeds, own])
    seeds, own = seeds[order], own[order]
    new_seed = np.r_[True, seeds[1:] != seeds[:-1]]
    new_cell = new_seed | np.r_[True, own[1:] != own[:-1]]
    same = _run_sizes(new_cell)
    twice = same > 1
    number = np.cumsum(new_seed) - 1
    mixed = (np.bincount(number, new_cell)[number] > 1) & (np.bincount(number, ~twice)[number] > 0)
    edge = (seeds == seeds[0]) | (seeds == seeds[-1])
    rim = (edge & (own == own[0]) & (seeds == seeds[0])) | (edge & (own == own[-1]) & (seeds == seeds[-1]))
    keep = np.flatnonzero(twice | mixed | edge)
    made = bucket.take(pa.array(order[keep]))
    flags = [pa.array(x[keep]) for x in (twice, mixed, new_cell, edge, rim)]
    columns = [*made.columns, *flags]
    table = pa.Table.from_arrays([pa.chunked_array([c]) if isinstance(c, pa.Array) else c for c in columns], [*ENTRY, *FLAGS])
    yield from table.combine_chunks().to_batches(max_chunksize=65536)


#: the cell occurs again; another cell shares the seed and some cell of it occurs once; first entry of its cell in the bucket;
#: the bucket begins or ends with the seed; it begins or ends with the cell
FLAGS = ["twice", "mixed", "first", "edge", "rim"]


def sorted_runs(entries: DataFrame, label: str) -> DataFrame:
    """Of staged entries those that share a seed with another, with the flags twice, mixed and first.

    Splitters sampled by Spark cut the range of (seed, cell, document, start), so that a seed which a third of all entries
    have spreads over many buckets. Each bucket is sorted. The run of a cell, or of a seed, may go on beyond a bucket only
    where the bucket begins or ends with it: these at most two cells and two seeds a bucket are compared across buckets,
    and what they give is broadcast.
    """
    dealt = entries.repartitionByRange("seed", "cell", "doc_id", "text_key", "low")
    schema = T.StructType([*entries.schema, *(T.StructField(f, T.BooleanType()) for f in FLAGS)])
    runs = stage_table(dealt.mapInArrow(_bucket_pass, schema), label)
    same_cell = runs.filter("rim AND first").groupBy("seed", "cell").agg((F.count(F.lit(1)) > 1).alias("_twice")).filter("_twice")
    same_seed = runs.filter("edge AND first").groupBy("seed").agg((F.min("cell") < F.max("cell")).alias("_mixed")).filter("_mixed")
    return (
        runs.join(F.broadcast(same_cell), ["seed", "cell"], "left").join(F.broadcast(same_seed), "seed", "left")
        .select(*ENTRY, (F.col("twice") | F.coalesce("_twice", F.lit(False))).alias("twice"), (F.col("mixed") | F.coalesce("_mixed", F.lit(False))).alias("mixed"), "first")
        .filter("twice OR mixed")
    )


# ---- strings of partly repeated cells


def _string_pass(length: int):
    def run(batches):
        for batch in batches:
            for text, doc, key, marks in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                sums = prefix_sums(data)
                starts = np.concatenate([np.arange(m["low"], m["low"] + m["n"]) for m in marks])
                known = np.concatenate([np.full(m["n"], m["twice"]) for m in marks])
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(stretch_hashes(sums, starts, starts + length).view(np.int64)),
                        pa.array(np.zeros(n, np.int64)),
                        pa.array([doc] * n, batch.column(1).type),
                        pa.array([key] * n, pa.int64()),
                        pa.array(np.where(known, -1, starts).astype(np.int32)),
                        pa.array(np.ones(n, np.int32)),
                    ],
                    ENTRY,
                )

    return run


def _merge_pass(length: int):
    """Of each row the stretches of bytes (first byte, and the byte behind it) that its starts (first start, their number) cover."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = np.asarray(batch.column(2).flatten())
            of = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(batch.column(2))))
            low, n = starts >> 32, starts & 0xFFFFFFFF
            order = np.lexsort((low, of))
            of, low, n = of[order], low[order], n[order]
            reach = np.maximum.accumulate(of << 33 | low + n - 1 + length)  # no stretch reaches into the next row
            heads = np.flatnonzero(np.r_[True, (of << 33 | low)[1:] > reach[:-1]])
            ends = reach[np.r_[heads[1:], len(low)] - 1] & (1 << 33) - 1
            offsets = np.r_[0, np.cumsum(np.bincount(of[heads], minlength=batch.num_rows))].astype(np.int32)
            merged = pa.ListArray.from_arrays(pa.array(offsets), pa.array(low[heads] << 32 | ends))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), merged], batch.schema.names)

    return run


def _cover_pass(batches):
    for batch in batches:
        sizes, removed, spans, kept = [], [], [], []
        for text, marks in zip(batch.column(1), batch.column(2), strict=True):
            data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
            gone = np.zeros(len(data), bool)
            if marks.is_valid:
                marked = np.asarray(marks.values)
                steps = np.zeros(len(data) + 1, np.int64)
                np.add.at(steps, marked >> 32, 1)
                np.add.at(steps, marked & 0xFFFFFFFF, -1)
                gone = np.cumsum(steps[:-1]) > 0
            sizes.append(len(data))
            removed.append(int(gone.sum()))
            spans.append(int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0)
            kept.append(data[~gone].tobytes() if removed[-1] else data.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes"],
        )


def _only(docs: DataFrame, keys: DataFrame, max_filter_bits: int) -> DataFrame:
    """Documents that may be among ``keys``, by a Bloom filter of bounded size, so that few texts are shuffled to the join."""
    packed = docs.sparkSession.sparkContext.broadcast(
        twice_filter(keys.select(F.array("text_key", "text_key").alias("keys")), filter_bits(keys.count(), max_filter_bits))
    )

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(suspected(packed.value, np.asarray(batch.column(1)).view(np.uint64))))

    return docs.mapInArrow(run, docs.schema)


def drop_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans, kept_bytes (binary, as a cut may fall inside a character).

    Every byte goes that a string of ``length`` bytes covers which starts anywhere else too, in this document or another;
    both places lose it. Null text is empty. Rows are told apart by doc_id and a hash of the text; equal rows repeat
    each other. Texts under ``length`` bytes stay whole.

    A first pass sets the bits of all seeds in a pair of Bloom filters, a second sends on only cells whose seed is
    suspected to be there twice. A cell found again is repeated from its first start to its last; where cells with one
    seed differ, their strings are sorted one by one.
    """
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    spark = docs.sparkSession
    # a cell has (length - seed) / 2 starts on average
    n = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = filter_bits(2 * n // (length - seed), max_filter_bits)
    packed = spark.sparkContext.broadcast(twice_filter(texts.select("text").mapInArrow(_seed_pass(length, seed), "seed bigint"), bits))
    schema = T.StructType(
        [
            *(T.StructField(k, T.LongType()) for k in ("seed", "cell")),
            docs.schema["doc_id"],
            T.StructField("text_key", T.LongType()),
            *(T.StructField(k, T.IntegerType()) for k in ("low", "n")),
        ]
    )
    entries = stage_table(texts.select("doc_id", "text_key", "text").mapInArrow(_entry_pass(length, seed, packed), schema), "suffixes")
    runs = sorted_runs(entries, "suffix-runs")
    unstage(entries)  # what sorted_runs returns reads what it has written itself
    marks = (
        # equal rows have equal marks: once for all of them, as a set that tasks begin before the shuffle
        runs.filter("mixed AND first").groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("low", "n", "twice")).alias("marks"))
        .select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "marks")
    )
    marks = stage_table(marks, "suffix-partial")
    match = (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    near = _only(texts, marks.select(F.col("_key").alias("text_key")), max_filter_bits).join(marks, match)
    strings = near.select("text", "doc_id", "text_key", "marks").mapInArrow(_string_pass(length), schema)
    strings = stage_table(strings, "strings")
    again = sorted_runs(strings, "string-runs").filter("twice AND low >= 0")
    unstage(strings)
    # starts are shuffled once, to their rows, and the few stretches they make go on to the texts
    starts = (
        runs.filter("twice").unionByName(again)
        .groupBy(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"))
        .agg(F.collect_set(F.shiftleft(F.col("low").cast("bigint"), 32) + F.col("n")).alias("spans"))
    )
    spans = starts.mapInArrow(_merge_pass(length), starts.schema)
    result = T.StructType([docs.schema["doc_id"], *(T.StructField(k, T.LongType()) for k in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept_bytes", T.BinaryType())])
    return texts.join(spans, match, "left").select("doc_id", "text", "spans").mapInArrow(_cover_pass, result)


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """The result without the bytes: their SHA-256 in their place."""
    return drop_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))
