"""Quality classifier: ordinal cumulative-link regression over hashed text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import SPACED_BYTES, blocks, one_row_each, prefix_sums, stretch_hashes, utf8, with_fields, words

BUCKETS = 1 << 18  # hashed words
BINS = 16  # steps of each shape figure
STEMS = (4, 6)  # bytes a word begins with, hashed besides the word: what stands for words that were not in the sample
TIMES = 4  # counts of a stem in a text that are told apart: once, twice, ... this often or more
SHAPES = ("symbols", "upper", "distinct", "word_length", "length", "lines")
SIZE = BUCKETS + BINS * len(SHAPES)
SAMPLE = 12_000

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>!@^~{}[]\\=+_"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = _LETTER[128:] = True
#: stripped from words, so that "word," and "word" are one
_EDGE = SPACED_BYTES.copy()
_EDGE[[ord(c) for c in ".,;:!?()\"'#*$%&|<>"]] = False


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the rows one after another, each once a row, and where each row begins.

    Words (A-Z lower-cased, without punctuation at their ends) and their beginnings, these by count, are hashed into
    buckets. Shape figures of the whole text
    (shares of symbols, capitals and distinct words, word length, number of words and lines) are cut into steps, one
    feature a step. A text without words has its shape only.
    """
    data, offsets = utf8(texts)
    rows = len(offsets) - 1
    low, starts, ends, bounds = words(data, offsets, _EDGE)
    sums, row = prefix_sums(low), np.repeat(np.arange(rows), np.diff(bounds)) * SIZE

    def in_buckets(stops: np.ndarray, salt: int, times: int = 1) -> np.ndarray:
        hashes = stretch_hashes(sums, starts, stops) + np.uint64(salt)
        found, many = np.unique(row + (hashes & np.uint64(BUCKETS - 1)).astype(np.int64), return_counts=True)
        more = [found[many >= k] for k in range(2, times + 1)]  # each step of a count is a feature, elsewhere in the buckets
        return np.concatenate([found, *(x - x % SIZE + (x % SIZE + 104_729 * k) % BUCKETS for k, x in enumerate(more, 1))])

    pairs = in_buckets(ends, 0)
    stems = [in_buckets(np.minimum(starts + n, ends), 7919 * n, TIMES) for n in STEMS]
    n_words, n_bytes = np.diff(bounds), np.diff(offsets)

    def share(members: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(members[data])][offsets])

    distinct = np.bincount(pairs // SIZE, minlength=rows)
    figures = [
        BINS * np.sqrt(share(_SYMBOLS) / np.maximum(n_bytes, 1)),
        BINS * share(_UPPER) / np.maximum(share(_LETTER), 1),
        BINS * distinct / np.maximum(n_words, 1) ** 0.9,
        share(_LETTER) / np.maximum(n_words, 1),
        np.log2(1 + n_words),
        np.log2(1 + np.diff(np.r_[0, np.cumsum(data == 10)][offsets])),
    ]
    steps = np.stack([BUCKETS + i * BINS + np.clip(x, 0, BINS - 1).astype(np.int64) for i, x in enumerate(figures)], 1)
    every = np.sort(np.concatenate([pairs, *stems, (np.arange(rows)[:, None] * SIZE + steps).ravel()]))
    return every % SIZE, np.searchsorted(every, np.arange(rows + 1) * SIZE)


@dataclass
class OrdinalModel:
    """Weights shared by all grades and ascending thresholds: P(grade <= k) = sigmoid(thresholds[k] - score)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, numbers: np.ndarray, heads: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0.0, np.cumsum(self.weights[numbers], dtype=np.float64)][heads])

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..., one column each; their sum is the expected grade."""
        return 1 - _sigmoid(self.thresholds - scores[:, None])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(numbers: np.ndarray, heads: np.ndarray, grades: np.ndarray, top: int, epochs: int = 12, steps: int = 1600, rate: float = 0.25, l1: float = 1e-3, least_rows: int = 5) -> OrdinalModel:
    """Cumulative-link regression by adaptive gradient steps over small batches, with an L1 penalty.

    A small sample is gone through more often, up to about ``steps`` batches. Features in fewer than ``least_rows`` rows keep weight 0. Thresholds stay ordered: the first is free, each later one
    adds a positive step. Grades run from 0 to ``top``; without rows all weights are 0.
    """
    weights, squares = np.zeros(SIZE), np.full(SIZE, 1e-6)
    known = np.bincount(numbers, minlength=SIZE) >= least_rows
    counts = np.bincount(grades, minlength=top + 1) + 1.0
    below = np.cumsum(counts)[:-1] / counts.sum()
    raw = np.log(below / (1 - below))
    raw[1:] = np.log(np.maximum(np.diff(raw), 1e-3))
    raw_squares = np.full(top, 1e-6)
    chance = np.random.default_rng(7)
    lengths = np.diff(heads)

    def thresholds() -> np.ndarray:
        return np.cumsum(np.r_[raw[0], np.exp(raw[1:])])

    batches = max(1, len(grades) // 64)
    for _ in range(min(60, max(epochs, steps // batches)) if len(grades) else 0):
        for batch in np.array_split(chance.permutation(len(grades)), batches):
            at = np.repeat(heads[batch] - np.r_[0, np.cumsum(lengths[batch])[:-1]], lengths[batch]) + np.arange(lengths[batch].sum())
            own, of = numbers[at], np.repeat(np.arange(len(batch)), lengths[batch])
            score = np.bincount(of, weights[own], len(batch))
            edge = np.r_[-np.inf, thresholds(), np.inf]
            y = grades[batch]
            upper, lower = _sigmoid(edge[y + 1] - score), _sigmoid(edge[y] - score)
            upper[y == top], lower[y == 0] = 1, 0
            used, slot = np.unique(own, return_inverse=True)
            slope = np.bincount(slot, (1 - upper - lower)[of], len(used)) / len(batch)
            slope[~known[used]] = 0
            squares[used] += slope**2
            step = rate / np.sqrt(squares[used])
            moved = weights[used] - step * slope
            weights[used] = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
            # slopes of -log(upper - lower) in both edges, in a form that stays exact where upper and lower meet
            apart = 1 - np.exp(-(edge[y + 1] - edge[y]))
            by_edge = np.bincount(y + 1, -(1 - upper) / np.maximum(1 - lower, 1e-12) / apart, top + 2) + np.bincount(y, lower / upper / apart, top + 2)
            slope = np.cumsum(by_edge[1:-1][::-1])[::-1] / len(batch)  # an edge moves with each step before it
            slope[1:] *= np.exp(raw[1:])
            raw_squares += slope**2
            raw -= rate * slope / np.sqrt(raw_squares)
    return OrdinalModel(weights.astype(np.float32), thresholds())


def _feature_pass(batches):
    for batch in batches:
        for block in blocks(batch, "text"):
            numbers, heads = features(block.column(0))
            own = [numbers[a:b].astype("<i4").tobytes() for a, b in zip(heads[:-1], heads[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([block.column(1), pa.array(own, pa.binary())], ["grade", "features"])


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from quality and toxic flags: a point for good quality and one for not being toxic, so 0 to 2.

    Of rows that share a doc_id the worst flags hold; rows with a null in any of the three columns are left out.
    """
    return labels.dropna(subset=["doc_id", "quality", "toxic"]).groupBy("doc_id").agg((F.min("quality") + 1 - F.max("toxic")).cast("int").alias("grade"))


def train(docs: DataFrame, grades: DataFrame, top: int = 2, sample: int = SAMPLE) -> OrdinalModel:
    """A model from at most ``sample`` graded documents, those whose hashed doc_id comes first; rows that share one count once."""
    chosen = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most `sample` ids and grades are broadcast, and as many documents' features collected, one row for each id
    known = one_row_each(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "text", "grade")
    rows = known.mapInArrow(_feature_pass, "grade int, features binary").collect()
    rows.sort(key=lambda r: (r.features, r.grade))  # whatever order tasks end in
    own = [np.frombuffer(r.features, "<i4") for r in rows]
    heads = np.r_[0, np.cumsum([len(x) for x in own])].astype(np.int64)
    return fit(np.concatenate(own) if own else np.zeros(0, np.int32), heads, np.array([r.grade for r in rows], np.int64), top)


def _score_pass(model, names: list[str], select: int, least: float):
    def run(batches):
        for batch in batches:
            for block in blocks(batch, "text"):
                numbers, heads = features(block.column(block.schema.get_field_index("text")))
                tails = model.value.tails(model.value.scores(numbers, heads))
                tail = tails[:, select - 1]
                made = {"expected_grade": pa.array(tails.sum(1)), "tail_probability": pa.array(tail), "kept": pa.array(tail >= least)}
                yield pa.RecordBatch.from_arrays([made[n] if n in made else block.column(block.schema.get_field_index(n)) for n in names], names)

    return run


def score(docs: DataFrame, model: OrdinalModel, select: int = 2, least: float = 0.5) -> DataFrame:
    """Documents with expected_grade, tail_probability (of grade ``select`` or better) and kept (that is at least ``least``).

    Null or empty text is scored by its shape. Input columns with these three names are replaced. The model that is
    broadcast has a fixed size of about 1 MB.
    """
    schema = with_fields(docs.schema, expected_grade=T.DoubleType(), tail_probability=T.DoubleType(), kept=T.BooleanType())
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_score_pass(shared, schema.names, select, least), schema)


def drop_rejected(docs: DataFrame, model: OrdinalModel, select: int = 2, least: float = 0.5) -> DataFrame:
    """The documents whose probability of grade ``select`` or better is at least ``least``, columns as they came."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for block in blocks(batch, "text"):
                numbers, heads = features(block.column(block.schema.get_field_index("text")))
                yield block.filter(pa.array(shared.value.tails(shared.value.scores(numbers, heads))[:, select - 1] >= least))

    return docs.mapInArrow(run, docs.schema)
