"""Documents packed into bins of fixed size that hold no two of one source or of one duplicate cluster."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import BLOCK_BYTES, as_bytes

CAPACITY = 8192
PIECES = 1 << 13  # pieces packed at once; bounds a worker's memory and the search
CARRIED = 32 << 20  # bytes in bins that stay open for the next pieces, and PIECES bins at most


def cluster_of(raw: bytes) -> bytes:
    """Texts equal but for case of A-Z and white space are one cluster."""
    return xxhash.xxh3_128_digest(b" ".join(raw.lower().split()))


def cut(raw: bytes, most: int) -> list[tuple[int, bytes]]:
    """The text in pieces of at most ``most`` bytes, cut between characters: (start, piece)."""
    pieces, start = [], 0
    while len(raw) - start > most:
        stop = start + most
        while raw[stop] & 0xC0 == 0x80:
            stop -= 1
        pieces.append((start, raw[start:stop]))
        start = stop
    return [*pieces, (start, raw[start:])]


class Bins:
    """Open bins in order of free space, with bitmaps of the sources and duplicate clusters they hold."""

    def __init__(self, capacity: int, most: int, sources: int, clusters: int):
        self.capacity, self.members = capacity, []
        self.free, self.number = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.sources = np.zeros((sources // 64 + 1, most), np.uint64)
        self.clusters = np.zeros((clusters // 64 + 1, most), np.uint64)

    def reopen(self, begun: list[tuple[int, list[int], list[int]]]) -> None:
        """The first bins: (free space, sources, clusters) each."""
        self.members = [[] for _ in begun]
        for number, (_, sources, clusters) in enumerate(begun):
            for bits, held in ((self.sources, sources), (self.clusters, clusters)):
                for x in held:
                    bits[x // 64, number] |= np.uint64(1 << x % 64)
        free = np.array([x[0] for x in begun], np.int64)
        self.number = np.argsort(free, kind="stable")
        self.free = free[self.number]

    def place(self, piece: int, need: int, source: int, cluster: int | None) -> None:
        """Into the tightest bin that fits and conflicts with neither; ``cluster`` is None for a text that is alone."""
        word, bit = self.sources[source // 64], np.uint64(1 << source % 64)
        other, mark = (self.clusters[cluster // 64], np.uint64(1 << cluster % 64)) if cluster is not None else (word, np.uint64(0))
        at, step = int(np.searchsorted(self.free, need)), 32
        number = None
        while at < len(self.free) and number is None:  # successor after successor, in longer and longer strides
            near = self.number[at : at + step]
            open_ = np.flatnonzero((word[near] & bit | other[near] & mark) == 0)
            if len(open_):
                at += int(open_[0])
                number, free = int(self.number[at]), int(self.free[at])
                self.free, self.number = np.delete(self.free, at), np.delete(self.number, at)
            else:
                at, step = at + step, step * 4
        if number is None:
            number, free = len(self.members), self.capacity
            self.members.append([])
        self.members[number].append(piece)
        word[number] |= bit
        other[number] |= mark
        if left := free - need:
            at = int(np.searchsorted(self.free, left, "right"))
            self.free, self.number = np.insert(self.free, at, left), np.insert(self.number, at, number)


def pack(needs: list[int], sources: list, clusters: list, capacity: int, begun: list[tuple[int, list, list]] | None = None) -> list[list[int]]:
    """Bins of piece numbers, filled best-fit, longest piece first.

    ``begun``: bins (bytes taken, sources, clusters) that are open already; they come first, with the pieces added to them.
    """
    begun = begun or []
    source_of = {x: i for i, x in enumerate(dict.fromkeys(sources))}
    copies: dict = {}
    for x in clusters:
        copies[x] = copies.get(x, 0) + 1
    for _, _, held in begun:
        for x in held:
            if x in copies:
                copies[x] += 1
    cluster_of_ = {x: i for i, x in enumerate(k for k, n in copies.items() if n > 1)}
    bins = Bins(capacity, len(needs) + len(begun), len(source_of), len(cluster_of_))
    bins.reopen([(capacity - n, [source_of[x] for x in own if x in source_of], [cluster_of_[x] for x in held if x in cluster_of_]) for n, own, held in begun])
    for piece in sorted(range(len(needs)), key=lambda i: -needs[i]):
        bins.place(piece, needs[piece], source_of[sources[piece]], cluster_of_.get(clusters[piece]))
    return bins.members


def still_open(bins: list[list[tuple]], capacity: int, most_bytes: int = CARRIED, most: int = PIECES) -> tuple[list[list[tuple]], list[list[tuple]]]:
    """Bins to go on with and bins to close: the full ones, and the fullest of the others beyond the bounds."""
    bins = sorted(bins, key=taken)
    kept = n_bytes = 0
    while kept < min(len(bins), most) and taken(bins[kept]) < capacity and n_bytes + taken(bins[kept]) <= most_bytes:
        n_bytes += taken(bins[kept])
        kept += 1
    return bins[:kept], bins[kept:]


def taken(group: list[tuple]) -> int:
    return sum(len(p[2]) + 1 for p in group)


COLUMNS = ["bin", "doc_ids", "piece_starts", "texts", "n_bytes"]
PIECE = ["doc_id", "piece_start", "text", "source", "cluster"]


def _cut_pass(capacity: int):
    def run(batches):
        for batch in batches:
            kind = batch.schema.field(0).type

            def made(rows, kind=kind):
                doc, start, text, source, cluster = zip(*rows, strict=True)
                kinds = [kind, pa.int32(), pa.binary(), pa.string(), pa.binary()]
                own = [pa.array(c, k) for c, k in zip((doc, start, text, source, cluster), kinds, strict=True)]
                return pa.RecordBatch.from_arrays([*own[:2], own[2].cast(pa.string()), *own[3:]], PIECE)

            rows, n_bytes = [], 0
            columns = batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for doc, raw, source, cluster in zip(*columns, strict=True):
                own = b"\0" + cluster_of(raw) if cluster is None else b"\1" + cluster.encode()
                for start, piece in cut(raw, capacity - 1):
                    rows.append((doc, start, piece, source, own))
                    n_bytes += len(piece) + 64
                    if n_bytes >= BLOCK_BYTES:
                        yield made(rows)
                        rows, n_bytes = [], 0
            if rows:
                yield made(rows)

    return run


def _pack_pass(capacity: int):
    def run(batches):
        task, numbers = TaskContext.get().partitionId(), itertools.count()

        def closed(bins, id_type):
            for s in range(0, len(bins), 1024):
                part = bins[s : s + 1024]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([(task << 32) + next(numbers) for _ in part], pa.int64()),
                        pa.array([[p[0] for p in r] for r in part], pa.list_(id_type)),
                        pa.array([[p[1] for p in r] for r in part], pa.list_(pa.int32())),
                        pa.array([[p[2] for p in r] for r in part], pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                        pa.array([taken(r) for r in part], pa.int32()),
                    ],
                    COLUMNS,
                )

        def filled(bins, pieces):
            begun = [(taken(r), [p[3] for p in r], [p[4] for p in r]) for r in bins]
            groups = pack([len(p[2]) + 1 for p in pieces], [p[3] for p in pieces], [p[4] for p in pieces], capacity, begun)
            return [[*r, *(pieces[i] for i in group)] for r, group in itertools.zip_longest(bins, groups, fillvalue=())]

        bins, pieces, id_type = [], [], pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            columns = [as_bytes(c) if name == "text" else c.to_pylist() for name, c in zip(PIECE, batch.columns, strict=True)]
            pieces += zip(*columns, strict=True)
            while len(pieces) >= PIECES:
                bins, done = still_open(filled(bins, pieces[:PIECES]), capacity)
                pieces = pieces[PIECES:]
                yield from closed(done, id_type)
        yield from closed(filled(bins, pieces), id_type)

    return run


def best_fit_bins(docs: DataFrame, capacity: int = CAPACITY, cluster: str | None = None) -> DataFrame:
    """Bins of at most ``capacity`` bytes, each piece with one byte for its end: (bin, doc_ids, piece_starts, texts, n_bytes).

    No bin holds two pieces of one source, nor of one duplicate cluster (column ``cluster``; where that is not given or
    null, texts equal but for case and white space are one). A text too long for a bin is cut between characters; its
    pieces by piece_starts give it back whole. A null source is a source; null and empty texts are empty pieces.
    Pieces are dealt out by a hash before they are packed, in that order, so every task has its share of each source and
    long text however the input is sorted. A task packs some thousand pieces at once and goes on with the bins that are
    open, up to 32 MB of text (beyond that the fullest are closed); the last ones of each task are left partly empty.
    """
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    chosen = F.col(cluster).cast("string") if cluster else F.lit(None).cast("string")
    id_type = docs.schema["doc_id"].dataType
    cut_kinds = [id_type, T.IntegerType(), T.StringType(), T.StringType(), T.BinaryType()]
    pieces = docs.select("doc_id", "text", source.alias("source"), chosen.alias("cluster")).mapInArrow(
        _cut_pass(capacity), T.StructType([T.StructField(n, k) for n, k in zip(PIECE, cut_kinds, strict=True)])
    )
    # the task that read a row is part of the hash: rows of one doc_id, however many, don't meet in one task
    mixed = pieces.withColumn("_mix", F.xxhash64("doc_id", "piece_start", F.spark_partition_id())).repartition("_mix")
    # in a fixed order, so that a task that runs again makes the same bins
    mixed = mixed.sortWithinPartitions("_mix", "text", "source", "cluster").select(*PIECE)
    kinds = [T.LongType(), T.ArrayType(id_type), T.ArrayType(T.IntegerType()), T.ArrayType(T.StringType()), T.IntegerType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(COLUMNS, kinds, strict=True)])
    return mixed.mapInArrow(_pack_pass(capacity), schema)
