"""Token ids packed into rows of fixed length: best-fit decreasing over a segment tree of free space."""

from __future__ import annotations

import base64
import functools
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

LENGTH, END, TOKENIZER = 2048, 50256, "/opt/tokenizers/byte_bpe_50k.tiktoken"
PIECES = 1 << 15  # pieces packed at once; bounds a worker's memory
# fixed value: the word pattern that belongs to the default vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.cache
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


# fixed value: the characters that the pattern takes for white space
WHITE_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def text_ids(encode, text: str) -> list[int]:
    """Ids of a text. The pattern's engine runs out of stack on long white space, so long runs are cut where the pattern would cut
    them, before their last character if more text follows, and merged here."""
    ids, at = [], 0
    for run in WHITE_RUN.finditer(text):
        ids += encode.encode_ordinary(text[at : run.start()])
        at = run.end() if run.end() == len(text) else run.end() - 1
        ids += merged_ids(encode, text[run.start() : at].encode())
    return ids + encode.encode_ordinary(text[at:])


@functools.cache
def vocabulary(encode) -> tuple[dict[bytes, int], list[int]]:
    ranks = {name: encode.encode_single_token(name) for name in encode.token_byte_values()}
    return ranks, [ranks[bytes([b])] for b in range(256)]


def merged_ids(encode, data: bytes) -> list[int]:
    """Byte-pair merges of one piece: again and again all places, from left to right, of the pair with the least rank.

    The same as one merge at a time, as a merge makes no pair of a lesser rank in a vocabulary that was made by merging. Time
    grows with the length and the number of different pairs.
    """
    ranks, single = vocabulary(encode)
    names = sorted(set(data))
    kinds = [(bytes([b]), single[b]) for b in names]  # the tokens met so far
    row = np.searchsorted(np.array(names, np.uint8), np.frombuffer(data, np.uint8))
    while len(row) > 1:
        pairs = np.flatnonzero(np.bincount(row[:-1] * len(kinds) + row[1:], minlength=len(kinds) ** 2))
        found = [(ranks.get(kinds[p // len(kinds)][0] + kinds[p % len(kinds)][0], None), int(p)) for p in pairs]
        known = [f for f in found if f[0] is not None]
        if not known:
            break
        rank, pair = min(known)
        x, y = divmod(pair, len(kinds))
        at = np.flatnonzero((row[:-1] == x) & (row[1:] == y))
        if x == y:  # overlapping places: every other one of each stretch
            begins = np.r_[True, np.diff(at) != 1]
            nth = np.arange(len(at)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]
            at = at[nth % 2 == 0]
        kinds.append((kinds[x][0] + kinds[y][0], rank))
        row[at] = len(kinds) - 1
        row = np.delete(row, at + 1)
    return np.array([k for _, k in kinds])[row].tolist()


class FreeSpace:
    """Segment tree over free space 0..length; a node counts the open bins below it."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: dict[int, list[int]] = {}

    def add(self, free: int, number: int) -> None:
        self.bins.setdefault(free, []).append(number)
        at = self.leaves + free
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The bin with the least free space of at least ``need``, removed: (free, number)."""
        at = self.leaves + need
        while not self.count[at]:
            while at & 1:  # a right child has nothing greater beside it
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at *= 2
            if not self.count[at]:
                at += 1
        free = at - self.leaves
        while at:
            self.count[at] -= 1
            at >>= 1
        return free, self.bins[free].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of piece numbers; each piece, longest first, goes where it leaves the least space."""
    space, bins = FreeSpace(capacity), []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        free, number = space.take(lengths[piece]) or (capacity, len(bins))
        if number == len(bins):
            bins.append([])
        bins[number].append(piece)
        if free > lengths[piece]:
            space.add(free - lengths[piece], number)
    return bins


def _pack_pass(length: int, tokenizer: str, end: int):
    def run(batches):
        task, numbers = TaskContext.get().partitionId(), itertools.count()
        encode = encoding(tokenizer)
        kind = "<u2" if encode.n_vocab <= 1 << 16 and end < 1 << 16 else "<u4"

        def packed(pieces):
            for group in best_fit_decreasing([len(ids) for _, _, ids in pieces], length):
                own = [pieces[i] for i in group]
                cuts = np.cumsum([0, *(len(ids) for _, _, ids in own)])
                row = np.full(length, end, kind)
                row[: cuts[-1]] = np.concatenate([ids for _, _, ids in own])
                places = np.arange(length) - np.repeat(np.r_[cuts[:-1], cuts[-1]], np.r_[np.diff(cuts), length - cuts[-1]])
                yield (task << 32) + next(numbers), row.tobytes(), places.astype("<u2" if length <= 1 << 16 else "<u4").tobytes(), cuts.tolist(), [d for d, _, _ in own], [s for _, s, _ in own]

        def batch_of(rows, id_type):
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(id_type), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], COLUMNS)

        pieces, id_type = [], pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*text_ids(encode, text.as_py() or ""), end], kind)
                pieces += [(doc, s, ids[s : s + length]) for s in range(0, len(ids), length)]
                if len(pieces) >= PIECES:
                    rows, pieces = list(packed(pieces)), []
                    for s in range(0, len(rows), 1024):
                        yield batch_of(rows[s : s + 1024], id_type)
        rows = list(packed(pieces))
        for s in range(0, len(rows), 1024):
            yield batch_of(rows[s : s + 1024], id_type)

    return run


COLUMNS = ["row", "ids", "position_ids", "cu_seqlens", "doc_ids", "piece_starts"]


def pack_tokens(docs: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER, end: int = END) -> DataFrame:
    """Rows of a packed id matrix, each ``length`` ids wide.

    - row: number of the row, unique
    - ids: ``length`` little-endian ids in 2 bytes each (4 where ids need it), filled up with ``end``
    - position_ids: as many positions, from 0 again at each segment and at the filling
    - cu_seqlens: cumulative segment lengths from 0 on; the last is the number of ids before the filling
    - doc_ids, piece_starts: document of each segment, and where in the document's ids the segment begins

    Each document's ids end with ``end``; a longer document is cut every ``length`` ids, so putting its segments in
    order of piece_starts gives the ids back whole. Null and empty texts are one ``end``; white space of any length is encoded whole. Every task packs the documents
    it reads, so nothing is shuffled; a task leaves a few rows partly empty. A row's doc_id may be null or repeated.
    """
    fields = [T.LongType(), T.BinaryType(), T.BinaryType(), T.ArrayType(T.IntegerType()), T.ArrayType(docs.schema["doc_id"].dataType), T.ArrayType(T.IntegerType())]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(COLUMNS, fields, strict=True)])
    return docs.select("doc_id", "text").mapInArrow(_pack_pass(length, tokenizer, end), schema)


def write_packed(rows: DataFrame, path: str) -> None:
    """The matrix as Parquet: one record a row, ids and positions as binary of fixed width."""
    rows.write.mode("errorifexists").parquet(path)
