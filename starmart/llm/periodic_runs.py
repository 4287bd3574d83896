"""Stretches of words that repeat with a period, found by a sparse diagonal DP over words and lags.

The DP's cell (word i, lag d) holds how many words in a row, up to word i, equal the word d places before: the cell of word
i - 1 at the same lag plus one. A diagonal (constant lag) that stops growing ends a stretch; if it is long enough it is a run.
Only cells that can lie on such a diagonal are made. A run of smallest period d has at least 4 d words, so for lags from w to
2 w - 1 an earlier occurrence of a word counts only if the last 2 w words before both agree; and of those the nearest is at lag
d all along the run (two lags d' < d over d + d' words would give a smaller period). So each word has one cell at most for
each doubling of the lag, where words occurring by themselves would have as many as there are equal pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starmart.llm.common import SPACED_BYTES, blocks, field_type, utf8, words

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _groups(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose key is there at least twice, a number for each key, and the place of the same key before (-1: none)."""
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order]
    again = np.zeros(len(keys), bool)
    again[1:] = keys[1:] == keys[:-1]
    earlier = np.full(len(keys), -1, np.int64)
    earlier[1:][again[1:]] = places[:-1][again[1:]]
    kept = again.copy()
    kept[:-1] |= again[1:]
    return places[kept], np.cumsum(~again)[kept], earlier[kept]


def runs_of_words(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT) -> tuple[np.ndarray, ...]:
    """Starts, lengths and periods of all runs in rows of word ids, in order of start, then period.

    Row r has the words from ``bounds[r]`` to ``bounds[r + 1]``; starts are places in ``ids``. ``exponent`` is 4 or more.
    """
    sizes = np.diff(bounds)
    row = np.repeat(np.arange(len(sizes)), sizes)
    nth = np.arange(len(ids)) - np.repeat(bounds[:-1], sizes)
    room = np.repeat(sizes, sizes)  # words of the row
    context = np.full(len(ids), -1, np.int64)  # number of the last `width` words, where these come again in the row
    place, number, _ = _groups(row * (int(ids.max(initial=0)) + 1) + ids, np.arange(len(ids)))
    context[place] = number
    found, width = [], 1
    while len(place):
        at = place[(nth[place] >= 2 * width - 1) & (room[place] >= exponent * width)]
        at = np.sort(at[context[at - width] >= 0])
        place, number, earlier = _groups(context[at - width] * (len(ids) + 1) + context[at], at)
        context[:] = -1
        context[place] = number
        lag = place - earlier
        cell = (earlier >= 0) & (lag >= width) & (lag < 2 * width)
        order = np.argsort(place[cell])
        where, lag = place[cell][order], lag[cell][order]
        begins = np.flatnonzero(np.r_[True, (np.diff(where) != 1) | (np.diff(lag) != 0)]) if len(where) else where
        grown = np.diff(np.r_[begins, len(where)])  # how far each diagonal went on
        period = lag[begins]
        length = grown + period + 2 * width - 1
        start = where[begins] - period - 2 * width + 1
        long = length >= np.maximum(least, exponent * period)
        found.append((start[long], length[long], period[long]))
        width *= 2
    start, length, period = map(np.concatenate, zip(*found, strict=True)) if found else np.zeros((3, 0), np.int64)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all rows as one binary array, and the words before each row."""
    data, offsets = utf8(column)
    _, starts, ends, bounds = words(data, offsets, SPACED_BYTES)
    cuts = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    letters = np.ascontiguousarray(data[SPACED_BYTES[data]])
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(letters)]), bounds


def _joined(own: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Each row's words joined by one space."""
    rows = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), own.cast(pa.large_string()))
    return pc.binary_join(rows, pa.scalar(" ", pa.large_string())).cast(pa.string())


def _find(least: int, exponent: int):
    def run(batches):
        for whole in batches:
            for batch in blocks(whole, "text"):
                own, bounds = words_of(batch.column("text"))
                ids = np.asarray(own.dictionary_encode().indices).astype(np.int64)
                start, length, period = runs_of_words(ids, bounds, least, exponent)
                covered = np.zeros(len(ids) + 1, np.int64)
                np.add.at(covered, start + period, 1)
                np.add.at(covered, start + length, -1)
                kept = np.cumsum(covered[:-1]) == 0
                cuts = np.searchsorted(start, bounds)
                local = start - np.repeat(bounds[:-1], np.diff(cuts))
                spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (local, length, period)], RUN.names)
                left = np.r_[0, np.cumsum(kept)][bounds]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans),
                        _joined(own.filter(pa.array(kept)), left),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def find_runs(docs: DataFrame, least: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text.

    Words are what lies between ASCII white space, numbered from 0 in each text. A run is a stretch of words with smallest
    period q (words q apart are equal) of at least max(``least``, ``exponent`` * q) words, ``exponent`` being 4 or more, that
    no neighbouring word extends. ``collapsed`` keeps what no run covers beyond its first q words, joined by one space.
    Null and empty texts have no words, no runs and an empty ``collapsed``. Every row stands for itself, so ids may be null or
    repeated; columns other than doc_id and text are not read. Nothing is shuffled; a task holds a block of about 2 MB of text
    or one longer text at a time, with some 100 bytes a word.
    """
    if exponent < 4:
        raise ValueError("an exponent under 4 leaves runs in which the nearest occurrence is not one period away")
    schema = T.StructType(
        [
            T.StructField("doc_id", field_type(docs, "doc_id")),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(RUN)),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    return docs.select("doc_id", "text").mapInArrow(_find(least, exponent), schema)
