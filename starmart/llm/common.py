"""What the text operators share: Arrow columns as bytes, vectorised words, staged tables, schemas."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.sources.staging import new_folder

BLOCK_BYTES = 2 << 20

# a fixed odd multiplier for polynomial hashes modulo 2**64, and its inverse
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written under the shared folder, packed tightly, and read back."""
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Deletes a table made by `stage_table` once nothing reads it any more."""
    files = df.inputFiles()
    if files:
        jvm = df.sparkSession.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def with_fields(schema: T.StructType, **types: T.DataType) -> T.StructType:
    """``schema`` with these fields at its end; fields of the same name are replaced."""
    kept = [f for f in schema if f.name not in types]
    return T.StructType([*kept, *(T.StructField(k, v) for k, v in types.items())])


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column; null is empty."""
    return pc.fill_null(column, "").cast(pa.binary() if column.type == pa.string() else pa.large_binary()).to_pylist()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in one array, and the offset of each row; null is empty."""
    wide = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = wide.buffers()
    offsets = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1] if len(wide) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts take about ``limit`` bytes, so that arrays over bytes stay small."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64()))
    group = (np.cumsum(lengths) - 1) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(lengths)], strict=True):
        if end > start:
            yield batch.slice(start, end - start)


class Powers:
    """Powers of the multiplier and of its inverse, grown on demand and kept by the worker."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def reach(cls, n: int) -> None:
        while len(cls.up) < n:
            have = len(cls.up)
            for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
                step = np.uint64(pow(base, have, 1 << 64))
                setattr(cls, name, np.concatenate([getattr(cls, name), getattr(cls, name) * step]))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running sums that give the polynomial hash of any stretch of ``data`` by one subtraction."""
    Powers.reach(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * Powers.down[: len(data)], out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit hashes of data[start:end]; equal bytes of equal length give equal hashes."""
    Powers.reach(len(sums))
    h = (sums[ends] - sums[starts]) * Powers.up[starts]
    h += (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: bytes of words made of digits, letters and everything outside ASCII, after lower-casing
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[ord("0") : ord("9") + 1] = WORD_BYTES[ord("a") : ord("z") + 1] = WORD_BYTES[128:] = True
#: bytes of words made of everything but ASCII white space
SPACED_BYTES = np.ones(256, bool)
SPACED_BYTES[[32, 9, 10, 11, 12, 13]] = False


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = WORD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of the words, and the words before each row (one more entry than rows)."""
    low = _LOWER[data]
    inside = np.zeros(len(low) + 1, bool)
    inside[:-1] = member[low]
    before = np.zeros(len(low) + 1, bool)
    before[1:] = inside[:-1]
    before[offsets] = False  # no word runs across rows
    starts = np.flatnonzero(inside & ~before)
    after = inside.copy()
    after[offsets] = False
    ends = np.flatnonzero(inside[:-1] & ~after[1:]) + 1
    return low, starts, ends, np.searchsorted(starts, offsets)


def hashed_words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = WORD_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and the words before each row."""
    low, starts, ends, bounds = words(data, offsets, member)
    return stretch_hashes(prefix_sums(low), starts, ends), bounds


def one_row_each(rows: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of one row per doc_id, the one with the least hash of its text; repeats go before the shuffle."""
    first = F.min(F.struct(F.xxhash64("text").alias("_hash"), "text", *(c for c in columns if c not in ("doc_id", "text"))))
    return rows.groupBy("doc_id").agg(first.alias("_first")).select(*(c if c == "doc_id" else F.col(f"_first.{c}").alias(c) for c in columns))


def field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns like these that no column of ``df`` has."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex_of(fingerprint) -> F.Column:
    """16 lowercase hex digits of a 64-bit integer column."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


ARROW_BATCH = 4 << 20


def ready(spark) -> None:
    """Prepares a session for the operators: Arrow batches stay small, which bounds a worker's memory however long texts
    are, and Python workers on this machine can import the package where it lies (on a cluster, ship it with --py-files)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, environment.get("PYTHONPATH")]))
