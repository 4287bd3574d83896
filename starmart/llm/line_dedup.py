"""Lines repeated over documents: two Bloom filters find suspects, an exact count confirms them."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.bloom import filter_bits, suspected, twice_filter
from starmart.llm.common import as_bytes, stage_table, unused, with_fields

SPACE = b" \t\n\x0b\x0c\r"
MAX_FILTER_BITS = 1 << 30


def _keys(raw: bytes, least: int) -> list[bytes | None]:
    """Per line its key, or None where the key is too short to count."""
    found = []
    for line in raw.lower().split(b"\n"):
        key = line.strip(SPACE)
        n = len(key)
        long = n >= least and (n >= 4 * least or len(key.decode("utf-8", "replace")) >= least)
        found.append(key if long else None)
    return found


def _hashes(keys: set[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))


def _hash_pass(least: int):
    def run(batches):
        for batch in batches:
            rows = [_hashes({k for k in _keys(raw, least) if k is not None}).view(np.int64) for raw in as_bytes(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int64()))], ["hashes"])

    return run


def _suspect_pass(least: int, packed):
    def run(batches):
        for batch in batches:
            ids, digests = [], []
            for at, raw in enumerate(as_bytes(batch.column(1))):
                keys = list({k for k in _keys(raw, least) if k is not None})
                for i in np.flatnonzero(suspected(packed.value, _hashes(keys))):
                    ids.append(at)
                    digests.append(hashlib.sha256(keys[i]).digest())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int32())), pa.array(digests, pa.binary())], ["doc_id", "digest"])

    return run


def repeated_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """Per document the digests of line keys it must lose: (doc_id, digests).

    One pass hashes the keys of every document and is written as arrays of 64-bit numbers. From it the two filters are
    built. A second pass sends on only keys that the twice-seen filter suspects, as SHA-256 with the doc_id; their
    count over documents and largest doc_id are combined before the shuffle, so a line that a third of all documents
    hold costs one row a task. Keys confirmed for ``least_docs`` documents go back to all holders but the largest.
    Rows without doc_id count as documents and lose nothing; rows that share a doc_id count one each.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")
    hashes = stage_table(texts.select("text").mapInArrow(_hash_pass(least_chars), "hashes array<bigint>"), "line-hashes")
    n = hashes.agg(F.sum(F.size("hashes"))).first()[0] or 0
    packed = spark.sparkContext.broadcast(twice_filter(hashes, filter_bits(n, max_filter_bits)))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("digest", T.BinaryType())])
    suspects = stage_table(texts.mapInArrow(_suspect_pass(least_chars, packed), schema), "line-suspects")
    confirmed = (
        suspects.groupBy("digest").agg(F.count(F.lit(1)).alias("holders"), F.max("doc_id").alias("keeper"))
        .filter(F.col("holders") >= least_docs).select("digest", "keeper")
    )
    # staged, so that the join reads both sides through its own exchanges and adaptive execution can split a hot line
    confirmed = stage_table(confirmed, "line-confirmed")
    return suspects.join(confirmed, "digest").filter("doc_id < keeper").groupBy("doc_id").agg(F.collect_set("digest").alias("digests"))


def _apply(least: int, names: list[str], counts: bool, digests: str):
    def run(batches):
        for batch in batches:
            texts, lines, dropped = [], [], []
            drops = batch.column(batch.schema.get_field_index(digests)).to_pylist()
            for raw, gone in zip(as_bytes(batch.column(batch.schema.get_field_index("text"))), drops, strict=True):
                own = raw.split(b"\n")
                lines.append(len(own))
                if gone:
                    gone = set(gone)
                    kept = [x for x, k in zip(own, _keys(raw, least), strict=True) if k is None or hashlib.sha256(k).digest() not in gone]
                    dropped.append(len(own) - len(kept))
                    raw = b"\n".join(kept)
                else:
                    dropped.append(0)
                texts.append(raw)
            made = {"text": pa.array(texts, pa.binary()).cast(pa.string())}
            made |= {"n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())} if counts else {}
            yield pa.RecordBatch.from_arrays([made[n] if n in made else batch.column(batch.schema.get_field_index(n)) for n in names], names)

    return run


def drop_repeated_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, max_filter_bits: int = MAX_FILTER_BITS, counts: bool = True) -> DataFrame:
    """Documents without their repeated lines, with n_lines (before) and n_dropped if ``counts``.

    Key of a line: white space stripped at both ends, A-Z lower-cased. A key of at least ``least_chars`` code points in
    at least ``least_docs`` documents stays only in the largest doc_id that holds it, there with all its lines. Null
    text becomes empty, one empty line. Other columns pass through; input columns called n_lines or n_dropped are
    replaced. An empty table gives an empty one.
    """
    docs = docs.drop(*(["n_lines", "n_dropped"] if counts else []))
    digests, drop_id = unused(docs, "digests", "drop_id")
    drops = repeated_lines(docs, least_chars, least_docs, max_filter_bits).select(F.col("doc_id").alias(drop_id), F.col("digests").alias(digests))
    schema = with_fields(docs.schema, n_lines=T.LongType(), n_dropped=T.LongType()) if counts else docs.schema
    joined = docs.join(drops, docs["doc_id"] == F.col(drop_id), "left").drop(drop_id)
    return joined.mapInArrow(_apply(least_chars, schema.names, counts, digests), schema)
