"""Periodic runs against their definition, word by word."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import periodic_runs, queries
from starmart.llm.common import table
from tests.llm.conftest import ODD


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def smallest_period(words):
    """By borders, independent of the operator."""
    border = [0] * len(words)
    for i in range(1, len(words)):
        k = border[i - 1]
        while k and words[i] != words[k]:
            k = border[k - 1]
        border[i] = k + (words[i] == words[k])
    return len(words) - border[-1]


def brute_runs(words, least=6, exponent=4):
    found = []
    for q in range(1, len(words) // exponent + 1):
        start = 0
        while start + q < len(words):
            end = start + q
            while end < len(words) and words[end] == words[end - q]:
                end += 1
            if end - start >= max(least, exponent * q) and smallest_period(words[start:end]) == q:
                found.append((start, end - start, q))
            start = max(start + 1, end - q + 1)
    return sorted(set(found), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def brute_rows(rows):
    want = []
    for doc, text in rows:
        words = split(text)
        runs = brute_runs(words)
        want.append((doc, len(words), tuple(runs), collapsed(words, runs)))
    return collections.Counter(want)


def got_rows(found):
    return collections.Counter((r.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in found.collect())


def test_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(300):
        rows = []
        for _ in range(rng.randint(1, 4)):
            words = []
            while len(words) < rng.randint(0, 60):
                block = [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 7))]
                words += block * rng.randint(1, 7)
            rows.append(words)
        bounds = np.cumsum([0, *map(len, rows)])
        got = list(zip(*(x.tolist() for x in periodic_runs.runs_of_words(np.array(sum(rows, []), np.int64), bounds)), strict=True))
        want = [(s + int(b), n, q) for words, b in zip(rows, bounds, strict=False) for s, n, q in brute_runs(words)]
        assert got == want


def test_runs_of_odd_rows(frame):
    rows = [*ODD, (9, "x " * 5), (9, "x " * 6), (None, "a b a b a b a b"), (10, "é\tÉ\né\x0bÉ é\rÉ\x0cé É z"), (11, "a a " * 8), (12, "q w e " * 40 + "q w r " * 40)]
    found = periodic_runs.find_runs(frame(rows))
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    assert got_rows(found) == brute_rows(rows)


def test_a_long_run_of_one_word(frame):
    (row,) = periodic_runs.find_runs(frame([(1, "no " * 400_000 + "end")])).collect()
    assert [tuple(r) for r in row.runs] == [(0, 400_000, 1)] and row.collapsed == "no end"


def test_runs_of_an_empty_table(frame):
    assert periodic_runs.find_runs(frame([])).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.find_runs(frame([]), exponent=3)


def planted(doc, text):
    words = split(text)
    h = zlib.crc32(str(doc).encode())
    if doc is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_against_its_definition(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    want = {}
    for doc, text in docs:
        words = planted(doc, text)
        if len(words) > 300:  # brute force is quadratic; the digests below cover the other rows
            continue
        runs = brute_runs(words)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        want[doc] = (len(runs), *best, milli, sha(lines), sha(collapsed(words, runs)))
    found = queries.QUERIES["op11_periodic_runs"](spark, sf_dir)
    kinds = {n: k for n, k in found.dtypes if n not in ("doc_id", "runs_sha256", "collapsed_sha256")}
    assert set(kinds.values()) == {"bigint"}
    rows = found.collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in docs)
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in rows if r.doc_id in want}
    assert got == want and sum(w[0] > 0 for w in want.values()) > 10


def test_planted_rows(spark):
    rows = [(d, "  " + " ".join(f"w{i}" for i in range(d % 37)) + "\n") for d in range(300)] + [(None, "a b c"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, tuple(split(r.text))) for r in queries.with_planted_runs(docs).collect()}
    assert got == {(d, tuple(planted(d, t))) for d, t in rows}
    assert queries.with_planted_runs(docs.filter(F.lit(False))).count() == 0
