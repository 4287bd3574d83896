"""Two tokenizers' ids for the same text, aligned where both end a token at the same byte.

A text is worked on in fragments: the tokens that end within a byte range, as an open head (up to the first byte where both
end), closed groups, and an open tail. Joining two neighbouring fragments closes the group between them; joining is
associative and the empty fragment is neutral, so the fragments of a very long text are made by many tasks and joined in a tree.

Both tokenizers begin anew at a single space between characters that are no white space, so the words between such spaces
have the same ids wherever they stand: a byte range is encoded from the words around it.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import blocks, field_type, stage_table
from starmart.llm.token_packing import PATTERN

BYTE_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 1 << 16  # bytes of text in a fragment
FAN_IN = 8  # fragments joined by one call
BLOCK_BYTES = 1 << 19  # text aligned at once
BROADCAST_PAIRS = 2_000_000  # distinct id pairs that are broadcast, 13 bytes each; more are joined by a shuffle
WORD_BREAK = re.compile(r"(?<=\S) (?=\S)")
SPACE_MARK = "▁"
#: texts of which every regular expression engine thinks alike: ASCII, Latin letters, common punctuation
PLAIN = re.compile("[\t\n\r -~¡-ɏ‐-‧€]*")



class Fragment(NamedTuple):
    """Tokens of both sides that end within a byte range."""

    sound: bool = True  # the tokens' bytes are the text's
    n_a: int = 0
    n_b: int = 0
    cut: bool = False  # there is a byte where both end
    head_a: tuple[int, ...] = ()
    head_b: tuple[int, ...] = ()
    closed: tuple[str, ...] = ()  # groups behind the head, joined by semicolons in each part
    tail_a: tuple[int, ...] = ()
    tail_b: tuple[int, ...] = ()


def group_text(a, b) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}"


def join(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of both byte ranges, ``y`` right behind ``x``."""
    sums = (x.sound and y.sound, x.n_a + y.n_a, x.n_b + y.n_b)
    if not x.cut:
        return Fragment(*sums, y.cut, x.head_a + y.head_a, x.head_b + y.head_b, y.closed, y.tail_a, y.tail_b)
    if not y.cut:
        return Fragment(*sums, True, x.head_a, x.head_b, x.closed, x.tail_a + y.head_a, x.tail_b + y.head_b)
    between = x.tail_a + y.head_a, x.tail_b + y.head_b
    closed = (*x.closed, group_text(*between), *y.closed) if any(between) else x.closed + y.closed
    return Fragment(*sums, True, x.head_a, x.head_b, closed, y.tail_a, y.tail_b)


def groups_of(whole: Fragment) -> str:
    """The groups of a whole text: its head is the first one, and a sound text has no tail."""
    head = (group_text(whole.head_a, whole.head_b),) if whole.head_a else ()
    return ";".join(head + whole.closed)


class Aligned(NamedTuple):
    """How many ids space + text has on either side; if sound, its groups and linked pairs."""

    sound: bool
    n_a: int
    n_b: int
    groups: str
    links: np.ndarray


NONE = Aligned(False, 0, 0, "", np.zeros(0, np.int64))


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, byte_file: str, piece_file: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        letters = _byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            known = all(c in letters for c in token)
            self.a_bytes[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.plain = _plain_words(self.a, self.a_bytes, letters)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side]) for side in (self.a_bytes, self.b_bytes))
        sides = ((len(self.a_bytes), "|"), (len(self.b_bytes), ";"))
        self.texts = pa.array([f"{i}{c}".encode() for n, end in sides for i in range(n) for c in (",", end)], pa.binary())
        # the space breaks of a text are breaks of both tokenizers only if no piece runs across one
        self.by_words = not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in pieces)
        self.names_a, self.names_b = (pa.array(side, pa.binary()) for side in (self.a_bytes, self.b_bytes))

    def ids(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of space + each text on both sides."""
        plain = [bool(self.plain and PLAIN.fullmatch(t)) for t in texts]
        others = iter(self.a.encode_batch([f" {t}" for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
        return [self.plain(f" {t}") if p else next(others).ids for t, p in zip(texts, plain, strict=True)], self.b.encode(texts, num_threads=1)

    def aligned(self, texts: list[str]) -> list[Aligned]:
        """Texts encoded and aligned together."""
        a, b = self.ids(texts)
        own = [f" {t}".encode() for t in texts]
        fits = [x == y == z for x, y, z in zip(_texts_of(self.names_a, a), own, _texts_of(self.names_b, b), strict=True)]
        done = iter(self._aligned([x for x, f in zip(a, fits, strict=True) if f], [x for x, f in zip(b, fits, strict=True) if f]))
        return [next(done) if f else NONE for f in fits]

    def _aligned(self, a: list[list[int]], b: list[list[int]]) -> list[Aligned]:
        """The same of sound texts by their ids, laid end to end."""
        if not a:
            return []
        (ids_a, cuts_a), (ids_b, cuts_b) = _end_to_end(a), _end_to_end(b)
        ends_a, ends_b = np.cumsum(self.a_sizes[ids_a]), np.cumsum(self.b_sizes[ids_b])
        ending = np.zeros(ends_a[-1] + 1, bool)
        ending[ends_a] = True
        last_b = ending[ends_b]
        ending[ends_a] = False
        ending[ends_b] = True
        last_a = ending[ends_a]
        in_a, in_b = np.flatnonzero(last_a), np.flatnonzero(last_b)
        # the ids' texts in order of group, then side: each with the separator that follows it
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        order[np.arange(len(ids_a)) + np.r_[0, in_b + 1][np.cumsum(last_a) - last_a]] = 2 * ids_a + last_a
        order[np.arange(len(ids_b)) + (in_a + 1)[np.cumsum(last_b) - last_b]] = 2 * (len(self.a_bytes) + ids_b) + last_b
        groups = _cut_bytes(self.texts.take(pa.array(order)), cuts_a + cuts_b)
        link_cuts, links = np.searchsorted(in_a, cuts_a).tolist(), self.linked(ids_a[in_a], ids_b[in_b])
        pairs = zip(a, b, groups, itertools.pairwise(link_cuts), strict=True)
        return [Aligned(True, len(x), len(y), text[:-1].decode(), links[p:q]) for x, y, text, (p, q) in pairs]

    def linked(self, a, b):
        return a * len(self.b_bytes) + b

    def breaks(self, text: str) -> list[str]:
        return WORD_BREAK.split(text) if self.by_words else [text]


def _end_to_end(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    cuts = np.cumsum([0, *map(len, rows)])
    return np.fromiter(itertools.chain.from_iterable(rows), np.int64, int(cuts[-1])), cuts


def _cut_bytes(parts: pa.Array, cuts: np.ndarray) -> list[bytes]:
    """The joined bytes of parts cuts[i] to cuts[i + 1]."""
    if not len(parts):
        return [b""] * (len(cuts) - 1)
    _, offsets, data = parts.buffers()
    at = np.frombuffer(offsets, np.int32)[parts.offset : parts.offset + len(parts) + 1][cuts].tolist()
    data = memoryview(data) if data is not None else memoryview(b"")
    return [bytes(data[s:e]) for s, e in itertools.pairwise(at)]


def _texts_of(names: pa.Array, rows: list[list[int]]) -> list[bytes]:
    ids, cuts = _end_to_end(rows)
    return _cut_bytes(names.take(pa.array(ids)), cuts)


def _plain_words(tokenizer, names: list[bytes], letters: dict[str, int]):
    """A faster encoder of the same vocabulary, if its merges come in order of their ids, else None."""
    import tiktoken

    model = json.loads(tokenizer.to_str())
    special = {t["id"] for t in model["added_tokens"]}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
    merged = [model["model"]["vocab"].get(x + y, -1) for x, y in pairs]
    byte_ids = sorted(model["model"]["vocab"][c] for c in letters)
    if model["pre_tokenizer"] is None or model["pre_tokenizer"]["type"] != "ByteLevel" or merged != sorted(set(merged)) or merged[0] <= byte_ids[-1]:
        return None
    ranks = {name: i for i, name in enumerate(names) if i not in special}
    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


@functools.cache
def tokenizers(byte_file: str, piece_file: str) -> Tokenizers:
    return Tokenizers(byte_file, piece_file)


# ---- texts of one fragment


def _whole_texts(byte_file: str, piece_file: str):
    def run(batches):
        both = tokenizers(byte_file, piece_file)
        for whole in batches:
            for batch in blocks(whole, "text", BLOCK_BYTES):
                texts = batch.column("text").to_pylist()
                found = iter(both.aligned([t for t in texts if t]))
                yield _aligned_batch(batch.column("doc_id"), [next(found)[1:] if t else NONE[1:] for t in texts])

    return run


def _aligned_batch(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (ids of a, ids of b, groups, linked pairs) beside their doc_id."""
    cuts = np.cumsum([0, *(len(r[3]) for r in rows)])
    links = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate([NONE.links, *(r[3] for r in rows)]), pa.int64()))
    counts = [pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays([ids, *counts, pa.array([r[2] for r in rows], pa.string()), links], ["doc_id", "n_a", "n_b", "groups", "links"])


# ---- texts of many fragments


def byte_ranges(text: str, chunk: int, by_words: bool = True) -> list[tuple[int, int, int, int]]:
    """(first byte, end, first and end byte of the words to encode for it) of each fragment of space + text.

    Ranges end at multiples of ``chunk`` bytes, wherever these fall; one that would hold no word break ends later, so
    that no word is encoded by more than three tasks. The words reach from the last break before a range to the first
    one behind it.
    """
    data = f" {text}".encode()
    places = [0, *(m.start() + 1 for m in WORD_BREAK.finditer(text))] if by_words else [0]
    # of the characters of " " + text, in bytes
    sizes = np.r_[0, np.cumsum(_byte_sizes(f" {text}"))]
    breaks = np.r_[sizes[places], len(data)]
    ends, last = [], 0
    for end in [*range(chunk, len(data), chunk), len(data)]:
        # at least one break within (last, end)
        if end == len(data) or np.searchsorted(breaks, end) > np.searchsorted(breaks, last, "right"):
            ends.append(end)
            last = end
    starts = [0, *ends[:-1]]
    return [(s, e, int(breaks[np.searchsorted(breaks, s, "right") - 1]), int(breaks[np.searchsorted(breaks, e, "left")])) for s, e in zip(starts, ends, strict=True)]


def _byte_sizes(text: str) -> np.ndarray:
    """Bytes of each character in UTF-8."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)


def _cut_texts(chunk: int, byte_file: str, piece_file: str):
    def run(batches):
        both = tokenizers(byte_file, piece_file)
        for batch in batches:
            for row, doc, text in zip(*(batch.column(c) for c in ("row", "doc_id", "text")), strict=True):
                data = f" {text.as_py()}".encode()
                for n, (start, end, first, last) in enumerate(byte_ranges(text.as_py(), chunk, both.by_words)):
                    columns = [[row.as_py()], [n], [start - first], [end - first], [data[first + 1 : last].decode()]]
                    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
                    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array([doc.as_py()], doc.type), *arrays], ["doc_id", "row", "chunk", "start", "end", "text"])

    return run


def fragment(both: Tokenizers, text: str, start: int, end: int) -> tuple[Fragment, np.ndarray]:
    """The fragment of bytes ``start`` to ``end`` of space + text, and the linked pairs that end there."""
    a, b = both.ids([text])
    if not _texts_of(both.names_a, a) == [f" {text}".encode()] == _texts_of(both.names_b, b):
        return Fragment(sound=False), NONE.links
    ids_a, ids_b = np.array(a[0], np.int64), np.array(b[0], np.int64)
    ends_a, ends_b = np.cumsum(both.a_sizes[ids_a]), np.cumsum(both.b_sizes[ids_b])
    own_a, own_b = (ends_a > start) & (ends_a <= end), (ends_b > start) & (ends_b <= end)
    ids_a, ends_a, ids_b, ends_b = ids_a[own_a], ends_a[own_a], ids_b[own_b], ends_b[own_b]
    _, in_a, in_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
    if not len(in_a):
        return Fragment(True, len(ids_a), len(ids_b), False, tuple(ids_a.tolist()), tuple(ids_b.tolist())), NONE.links
    (head_a, *mid_a, tail_a), (head_b, *mid_b, tail_b) = ([tuple(x.tolist()) for x in np.split(ids, at + 1)] for ids, at in ((ids_a, in_a), (ids_b, in_b)))
    closed = ";".join(map(group_text, mid_a, mid_b))
    made = Fragment(True, len(ids_a), len(ids_b), True, head_a, head_b, (closed,) if closed else (), tail_a, tail_b)
    return made, both.linked(ids_a[in_a], ids_b[in_b])


_STATE = [("sound", pa.bool_()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("cut", pa.bool_()), *((n, pa.list_(pa.int32())) for n in ("head_a", "head_b")), ("closed", pa.string()), *((n, pa.list_(pa.int32())) for n in ("tail_a", "tail_b")), ("links", pa.list_(pa.int64()))]
_STATE_DDL = "sound boolean, n_a bigint, n_b bigint, cut boolean, head_a array<int>, head_b array<int>, closed string, tail_a array<int>, tail_b array<int>, links array<bigint>"


def _state_row(made: Fragment, links) -> list:
    return [made.sound, made.n_a, made.n_b, made.cut, made.head_a, made.head_b, ";".join(made.closed), made.tail_a, made.tail_b, links]


def _fragment_batch(ids: pa.Array, rows, chunks, states: list[list]) -> pa.RecordBatch:
    arrays = [pa.array([s[i] for s in states], kind) for i, (_, kind) in enumerate(_STATE)]
    return pa.RecordBatch.from_arrays([ids, pa.array(rows, pa.int64()), pa.array(chunks, pa.int32()), *arrays], ["doc_id", "row", "chunk", *(n for n, _ in _STATE)])


def _encode_cuts(byte_file: str, piece_file: str):
    def run(batches):
        both = tokenizers(byte_file, piece_file)
        for batch in batches:
            for i in range(batch.num_rows):
                start, end, text = (batch.column(c)[i].as_py() for c in ("start", "end", "text"))
                made = _state_row(*fragment(both, text, start, end))
                yield _fragment_batch(batch.column("doc_id")[i : i + 1], [batch.column("row")[i].as_py()], [batch.column("chunk")[i].as_py()], [made])

    return run


def _read_state(table: pa.Table, i: int) -> tuple[Fragment, np.ndarray]:
    get = {n: table.column(n)[i] for n, _ in _STATE}
    closed = get["closed"].as_py()
    ids = {n: tuple(get[n].as_py()) for n in ("head_a", "head_b", "tail_a", "tail_b")}
    made = Fragment(get["sound"].as_py(), get["n_a"].as_py(), get["n_b"].as_py(), get["cut"].as_py(), closed=(closed,) if closed else (), **ids)
    return made, np.asarray(get["links"].values)


def _join_fragments(table: pa.Table) -> pa.Table:
    """Neighbouring fragments of one text, at most `FAN_IN`, joined to one."""
    order = np.argsort(np.asarray(table.column("chunk")))
    states = [_read_state(table, int(i)) for i in order]
    made = functools.reduce(join, (s for s, _ in states), Fragment())
    links = np.concatenate([own for _, own in states])
    chunk = int(np.asarray(table.column("chunk")).min()) // FAN_IN
    ids = table.column("doc_id").combine_chunks()[:1]
    return pa.Table.from_batches([_fragment_batch(ids, [table.column("row")[0].as_py()], [chunk], [_state_row(made, links)])])


def _finished(batches):
    for batch in batches:
        table, rows = pa.Table.from_batches([batch]), []
        for i in range(batch.num_rows):
            made, links = _read_state(table, i)
            rows.append((made.n_a, made.n_b, groups_of(made), links) if made.sound else (0, 0, "", []))
        yield _aligned_batch(batch.column("doc_id"), rows)


def _long_texts(docs: DataFrame, schema: T.StructType, chunk: int, files: tuple[str, str]) -> DataFrame:
    """The same of texts with several fragments: encoded by fragments, which are joined `FAN_IN` at a time."""
    kind = field_type(docs, "doc_id").simpleString()
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    cuts = rows.mapInArrow(_cut_texts(chunk, *files), f"doc_id {kind}, row bigint, chunk int, start int, end int, text string")
    parts = cuts.repartition("row", "chunk").mapInArrow(_encode_cuts(*files), f"doc_id {kind}, row bigint, chunk int, {_STATE_DDL}")
    parts = stage_table(parts, "fragments")
    most = parts.agg(F.max("chunk")).first()[0]
    while most:
        parts = parts.groupBy("row", F.expr(f"chunk div {FAN_IN}").alias("branch")).applyInArrow(_join_fragments, parts.schema)
        most //= FAN_IN
    return parts.mapInArrow(_finished, schema)


def align(docs: DataFrame, byte_file: str = BYTE_TOKENIZER, piece_file: str = PIECE_TOKENIZER, chunk: int = CHUNK) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, groups, links.

    Texts are encoded as space + text, without special tokens. A byte where a token of either side ends cuts the tokens into
    groups; ``groups`` has their ids as ``a1,a2|b1;a3|b2,b3``, ``links`` the id pair that ends each group, as a * (ids of b) + b.
    Null and empty texts, and texts whose tokens' joined bytes are not space + text, have none: 0, 0, empty, empty. Each
    row stands for itself, so ids may be null or repeated; columns other than doc_id and text are not read. Both vocabulary
    files must lie on every executor.

    Texts over ``chunk`` bytes are cut into byte ranges that many tasks encode, and their fragments joined in a tree; the
    result of a text is one row, so its groups must fit in one. A stretch without word breaks is encoded by one task.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", field_type(docs, "doc_id")),
            T.StructField("n_a", T.LongType()),
            T.StructField("n_b", T.LongType()),
            T.StructField("groups", T.StringType()),
            T.StructField("links", T.ArrayType(T.LongType())),
        ]
    )
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    short = docs.filter(size <= chunk).select("doc_id", "text").mapInArrow(_whole_texts(byte_file, piece_file), schema)
    return short.unionByName(_long_texts(docs.filter(size > chunk), schema, chunk, (byte_file, piece_file)))


# ---- counts over the corpus


def _counted(batches):
    """Links of some batches at a time, counted."""
    for batch in batches:
        pairs, n = np.unique(np.asarray(batch.column(0).flatten()), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])


def link_counts(aligned: DataFrame, pieces: int) -> DataFrame:
    """(pair, n, best): how many links of all rows hold each pair, and whether that is the most of its id of b, which has ``pieces`` ids."""
    counts = aligned.select("links").mapInArrow(_counted, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("b", F.col("pair") % pieces)
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def piece_ids(piece_file: str = PIECE_TOKENIZER) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_file).vocab_size()


def with_counts(aligned: DataFrame, counts: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``aligned`` with n_best (links whose pair is the most frequent of its id of b) and count_sum (of all links' counts).

    Both are read more than once: pass staged frames. Up to ``broadcast_pairs`` pairs go to every task; more are
    joined by a shuffle of each row's distinct pairs.
    """
    if counts.count() <= broadcast_pairs:
        known = counts.orderBy("pair").toArrow()
        sent = aligned.sparkSession.sparkContext.broadcast([np.asarray(known.column(c)) for c in ("pair", "n", "best")])

        @F.arrow_udf("struct<n_best:bigint,count_sum:bigint>")
        def looked_up(links: pa.Array) -> pa.Array:
            pair, n, best = sent.value
            at = np.searchsorted(pair, np.asarray(links.flatten()))
            cuts = np.r_[0, np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(links), 0)))]
            sums = [np.r_[0, np.cumsum(x[at].astype(np.int64))] for x in (best, n)]
            return pa.StructArray.from_arrays([pa.array(s[cuts[1:]] - s[cuts[:-1]], pa.int64()) for s in sums], ["n_best", "count_sum"])

        found = aligned.withColumn("found", looked_up("links"))
        return found.select(*aligned.columns, "found.*")
    rows = stage_table(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned_rows")
    own = rows.select("row", F.explode("links").alias("pair")).groupBy("row", "pair").agg(F.count(F.lit(1)).alias("times"))
    sums = own.join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    joined = rows.join(sums, "row", "left")
    return joined.select(*aligned.columns, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")))
