"""Near duplicates by SimHash: segments of the fingerprint retrieve, pigeonring chains prune, Hamming distance decides."""

from __future__ import annotations

import functools
import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from starmart.llm.common import as_bytes, stage_table, unused, with_fields

BITS, SEED, SHINGLE, DISTANCE = 64, 42, 4, 4
LARGEST_BUCKET = 4096

# ---- fingerprints


def fingerprint(raw: bytes, size: int = SHINGLE) -> int:
    """64 bits, each set if set in over half of the hashes of all shingles of ``size`` words; 0 without words."""
    own = raw.lower().split()
    if not own:
        return 0
    joined = b" ".join(own)
    ends = np.cumsum([len(w) + 1 for w in own]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(own) - size + 1)
    pairs = zip(starts[:n].tolist(), ends[min(size, len(own)) - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for part in range(0, n, 4096):
        chunk = hashes[part : part + 4096]
        # 255 rows at most are summed in a byte, which is far faster than summing in 64 bits
        bits = np.unpackbits(chunk.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for few in range(0, len(bits), 255):
            counts += np.add.reduce(bits[few : few + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _append(names: list[str], column: str):
    def run(batches):
        for batch in batches:
            prints = np.fromiter((fingerprint(x) for x in as_bytes(batch.column(batch.schema.get_field_index("text")))), np.uint64, batch.num_rows)
            own = [batch.column(batch.schema.get_field_index(n)) for n in names[:-1]]
            yield pa.RecordBatch.from_arrays([*own, pa.array(prints.view(np.int64))], names)

    return run


def with_fingerprints(docs: DataFrame, column: str = "fingerprint") -> DataFrame:
    schema = with_fields(docs.schema, **{column: T.LongType()})
    return docs.mapInArrow(_append(schema.names, column), schema)


# ---- candidates


def ring(bits: list[int], parts: int) -> list[int]:
    """Masks of ``parts`` nearly equal segments of the given bit positions."""
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[x:y]) for x, y in itertools.pairwise(cuts)]


def equal_segments(values: int, bits: int, distance: int) -> int:
    """How many segments a key takes, so that a key of random fingerprints is shared by about one other at most."""
    equal = 1
    while bits * equal / (distance + equal) < math.log2(max(2, values)) + 1 and equal < 8:
        equal += 1
    return equal


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _with_keys(prints: DataFrame, fixed: int, equal: int, distance: int) -> DataFrame:
    """Every key of every fingerprint: with ``distance`` + ``equal`` segments of the bits not ``fixed``, two fingerprints
    within the distance agree in at least ``equal`` of them."""
    free = [b for b in range(BITS) if not fixed >> b & 1]
    masks = [fixed | sum(c) for c in itertools.combinations(ring(free, distance + equal), equal)]
    keys = F.array(*(F.struct(F.lit(_signed(m)).alias("mask"), F.col("print").bitwiseAND(F.lit(_signed(m))).alias("value")) for m in masks))
    return prints.select("print", F.explode(keys).alias("key")).select("print", "key.mask", "key.value")


def chained(differences: np.ndarray, distance: int) -> np.ndarray:
    """Pairs with a chain: from some segment on, the first l differences round the ring add up to at most
    l * distance / segments, for every l. Every pair within the distance has one."""
    segments = differences.shape[1]
    budget = (np.arange(1, segments + 1) * distance) // segments
    found = np.zeros(len(differences), bool)
    for start in range(segments):
        found |= (np.cumsum(np.roll(differences, -start, axis=1), axis=1) <= budget).all(1)
    return found


def _linked(a: np.ndarray, b: np.ndarray, masks: np.ndarray, distance: int) -> np.ndarray:
    """Indexes of pairs within the distance: pruned by chains segment by segment, then the full Hamming check."""
    x = a ^ b
    pairs = np.arange(len(x))
    for part in range(0, len(x), 1 << 16):  # keeps the table of differences small
        own = x[part : part + (1 << 16)]
        pairs[part : part + (1 << 16)] = np.where(chained(np.bitwise_count(own[:, None] & masks), distance), pairs[part : part + (1 << 16)], -1)
    pairs = pairs[pairs >= 0]
    return pairs[np.bitwise_count(x[pairs]) <= distance]


def _bucket_pass(segments: int, distance: int):
    masks = np.array(ring(list(range(BITS)), segments), np.uint64)

    def spanning(prints: np.ndarray):
        """Links that connect whatever is linked in a larger bucket: a search from print to print, few links each."""
        rest, a, b = prints, [], []
        while len(rest):
            queue, rest = [rest[0]], rest[1:]
            while queue and len(rest):
                at = queue.pop()
                near = _linked(np.full(len(rest), at, np.uint64), rest, masks, distance)
                a += [at] * len(near)
                b += rest[near].tolist()
                queue += rest[near].tolist()
                rest = np.delete(rest, near)
        return np.array(a, np.uint64), np.array(b, np.uint64)

    def run(batches):
        for batch in batches:
            column = batch.column(0)
            offsets = np.asarray(column.offsets).astype(np.int64)
            prints = np.asarray(column.values).view(np.uint64)
            sizes = np.diff(offsets)
            a, b = [], []
            for size in np.unique(sizes):
                own = offsets[:-1][sizes == size]
                if size <= 16:
                    rows = prints[own[:, None] + np.arange(size)]
                    i, j = np.triu_indices(size, 1)
                    left, right = rows[:, i].ravel(), rows[:, j].ravel()
                    near = _linked(left, right, masks, distance)
                    a.append(left[near])
                    b.append(right[near])
                else:
                    for start in own:
                        left, right = spanning(prints[start : start + size])
                        a.append(left)
                        b.append(right)
            a, b = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (a, b))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def links(prints: DataFrame, distance: int = DISTANCE, largest_bucket: int = LARGEST_BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column print) that connect all pairs within the distance.

    Equi-joins on keys of equal segments retrieve; how many segments a key takes follows the number of fingerprints.
    A key shared by more than ``largest_bucket`` fingerprints is not compared but keyed again by segments of its
    other bits, again and again, so that no task gets an unbounded bucket and no pair is lost (each round fixes more
    bits, and under 8 free bits leave 256 values, so it ends). In buckets over 16 only links that connect are sent on,
    one for each fingerprint, never all pairs.
    """
    layouts, found = [(prints, 0, equal_segments(prints.count(), BITS, distance))], None
    while layouts:
        keyed = functools.reduce(DataFrame.unionAll, [_with_keys(rows, fixed, equal, distance) for rows, fixed, equal in layouts])
        hot = stage_table(keyed.groupBy("mask", "value").count().filter(F.col("count") > largest_bucket), "hot-buckets")
        layouts = []
        for row in hot.select("mask").distinct().collect():  # at most the key layouts of this round
            own = hot.filter(F.col("mask") == row["mask"])
            again = prints.join(own, F.col("print").bitwiseAND(F.lit(row["mask"])) == F.col("value"), "left_semi")
            free = BITS - (row["mask"] % (1 << 64)).bit_count()
            layouts.append((again, row["mask"] % (1 << 64), max(1, min(2, free // distance - 1))))
        if layouts:
            keyed = keyed.join(hot, ["mask", "value"], "left_anti")
        part = (
            keyed.groupBy("mask", "value").agg(F.collect_list("print").alias("prints")).filter(F.size("prints") > 1)
            .select("prints").mapInArrow(_bucket_pass(distance + 2, distance), "a bigint, b bigint")
        )
        found = part if found is None else found.unionAll(part)
    return found.distinct()


# ---- components


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link: each connected part by its least node.

    Alternates large and small stars, both a minimum per node and a join, until nothing changes. Every round is
    written to the shared folder; the number of rounds grows with the logarithm of the longest path.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    pairs, seen = stage_table(pairs, "links"), None
    while True:
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        large = stage_table(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        pairs = stage_table(small.unionAll(least.withColumnRenamed("m", "v")).distinct(), "small-star")
        now = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = now


def classes(prints: DataFrame, distance: int = DISTANCE, largest_bucket: int = LARGEST_BUCKET) -> DataFrame:
    """(print, component_id, kept_print) of distinct fingerprints with their least doc_id (columns print, first):
    the least doc_id of the group, and the fingerprint of that document."""
    roots = components(links(prints.select("print"), distance, largest_bucket))
    members = prints.join(roots, F.col("print") == F.col("node"), "left").select("print", "first", F.coalesce("root", "print").alias("root"))
    first = F.min_by(F.struct("first", "print"), F.struct(F.col("first").isNull(), "first", "print"))
    groups = members.groupBy("root").agg(first.alias("kept"))
    return members.join(groups, "root").select("print", F.col("kept.first").alias("component_id"), F.col("kept.print").alias("kept_print"))


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, largest_bucket: int = LARGEST_BUCKET) -> DataFrame:
    """Per document row: doc_id, fingerprint (bigint), component_id (least doc_id that links reach).

    Shingles of four words, repeats included, after lower-casing A-Z; a text without words has fingerprint zero and is
    linked like any other. Equal fingerprints are one before candidates are searched, so thousands of copies cost one
    row. Rows without doc_id take part; a group of only such rows has component_id null.
    """
    marked, found = _grouped(docs, distance, largest_bucket)
    return marked.join(found, F.col("fingerprint") == F.col("print")).select("doc_id", "fingerprint", "component_id")


def _grouped(docs: DataFrame, distance: int, largest_bucket: int) -> tuple[DataFrame, DataFrame]:
    marked = _marked(docs)
    return marked, classes(_prints(marked), distance, largest_bucket)


def _marked(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fingerprint) of each row; doc_id and text_key lead back to its text."""
    marked = with_fingerprints(docs.select("doc_id", "text"))
    return stage_table(marked.select("doc_id", F.xxhash64("text").alias("text_key"), "fingerprint"), "fingerprints")


def _prints(marked: DataFrame) -> DataFrame:
    return stage_table(marked.groupBy(F.col("fingerprint").alias("print")).agg(F.min("doc_id").alias("first")), "prints")


def with_components(docs: DataFrame, column: str = "component", distance: int = DISTANCE, largest_bucket: int = LARGEST_BUCKET) -> DataFrame:
    """Document rows with ``column``, a bigint that the rows of one group of near duplicates share and no others.

    It is the fingerprint of the group's kept document, so it is never null. Each row is judged by its own text, also
    where rows share a doc_id or have none. Fingerprints are made once and come back to the texts by doc_id and text hash.
    """
    marked = _marked(docs)
    found = classes(_prints(marked), distance, largest_bucket)
    doc, key, group = unused(docs, "doc", "key", "group")
    known = (
        marked.join(found, F.col("fingerprint") == F.col("print"))
        .groupBy(F.col("doc_id").alias(doc), F.col("text_key").alias(key)).agg(F.min("kept_print").alias(group))
    )
    rows = docs.join(known, (F.xxhash64("text") == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(doc)), "left")
    return rows.select(*(c for c in docs.columns if c != column), F.col(group).alias(column))


def drop_near_duplicates(docs: DataFrame, distance: int = DISTANCE, largest_bucket: int = LARGEST_BUCKET) -> DataFrame:
    """One document of each group of near duplicates, the one with the least doc_id (rows with doc_id before others,
    of rows that share it the one with the least text hash, repeated rows once); columns as they came."""
    marked, found = _grouped(docs, distance, largest_bucket)
    kept = found.filter("print = kept_print").select("print", "component_id")
    same = (F.col("fingerprint") == F.col("print")) & F.col("doc_id").eqNullSafe(F.col("component_id"))
    doc, key, nth = unused(docs, "doc", "key", "nth")
    rows = marked.join(kept, same).groupBy("print").agg(F.min("doc_id").alias(doc), F.min("text_key").alias(key)).select(doc, key)
    first = docs.join(rows, (F.xxhash64("text") == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(doc)))
    return first.withColumn(nth, F.row_number().over(W.partitionBy(doc, key).orderBy("text"))).filter(F.col(nth) == 1).select(*docs.columns)
