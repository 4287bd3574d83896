"""Aligned token ids against a straight reading of the definition, whole and in fragments."""

import collections
import functools
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from starmart.llm import queries
from starmart.llm import token_alignment as ta
from starmart.llm.common import table
from tests.llm.conftest import ODD

MORE = [
    (20, "a▁b c"), (21, "<|endoftext|> <s> </s> <0x0A>"), (22, "don't  stop\n\n\nnow \t x"), (23, "中文没有空格" * 400),
    (24, "x" * 5000 + " y " + "z" * 3000), (25, " leading"), (26, "trailing "), (27, "\x00 \x85 　 a b"), (28, "word " * 4000 + "▁"),
]


@functools.cache
def both():
    return ta.tokenizers(ta.BYTE_TOKENIZER, ta.PIECE_TOKENIZER)


def brute(text):
    """(ids of a, ids of b, groups, links) of a whole text, encoded at once."""
    if not text:
        return [], [], "", []
    a = both().a.encode(f" {text}", add_special_tokens=False).ids
    b = both().b.encode(text)
    own = f" {text}".encode()
    sides = [(a, both().a_bytes), (b, both().b_bytes)]
    if any(b"".join(names[i] for i in ids) != own for ids, names in sides):
        return [], [], "", []
    ends = [{}, {}]
    for found, (ids, names) in zip(ends, sides, strict=True):
        at = 0
        for n, i in enumerate(ids):
            at += len(names[i])
            found[at] = n
    groups, links, p, q = [], [], 0, 0
    for at in sorted(ends[0].keys() & ends[1].keys()):
        i, j = ends[0][at] + 1, ends[1][at] + 1
        groups.append(",".join(map(str, a[p:i])) + "|" + ",".join(map(str, b[q:j])))
        links.append((a[i - 1], b[j - 1]))
        p, q = i, j
    return a, b, ";".join(groups), links


def brute_row(doc, text):
    a, b, groups, links = brute(text)
    return doc, len(a), len(b), groups, tuple(sorted(x * len(both().b_bytes) + y for x, y in links))


def got_rows(aligned):
    return collections.Counter((r.doc_id, r.n_a, r.n_b, r.groups, tuple(sorted(r.links))) for r in aligned.collect())


@pytest.mark.parametrize("chunk", [1 << 16, 4000, 64])
def test_odd_rows_whole_and_in_fragments(frame, chunk):
    rows = [(d, t and t[: 300 * chunk]) for d, t in ODD + MORE]
    got = got_rows(ta.align(frame(rows), chunk=chunk))
    assert got == collections.Counter(brute_row(d, t) for d, t in rows)


def test_empty_table(frame):
    assert ta.align(frame([])).collect() == []


def test_words_have_the_ids_they_have_in_the_text():
    rng = random.Random(1)
    bits = ["a", "b", " ", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "é", "中", "\U0001f600", "'s", "'", "ll", "12", "!!", "the", "▁", "<s>", "\x00", "ﬁ", "​", "́", "٣"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(1, 14)))
        words = both().aligned(both().breaks(text))
        a, b, groups, _ = brute(text)
        assert all(w.sound for w in words) == bool(a)
        if a:
            assert (len(a), len(b)) == (sum(w.n_a for w in words), sum(w.n_b for w in words)) and groups == ";".join(w.groups for w in words)


def test_plain_words_are_encoded_alike():
    rng = random.Random(4)
    letters = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xA1, 0x250), *range(0x2010, 0x2028), 0x20AC]]
    words = ["".join(rng.choices(letters + [" "] * 99, k=rng.randint(1, 30))) for _ in range(20_000)] + ["don't", "'s", "we'LL", "x'", "<|endoftext|>", "1½", " \n\n x \t"]
    assert both().plain is not None and ta.PLAIN.fullmatch(words[0])
    slow = [e.ids for e in both().a.encode_batch([f" {w}" for w in words], add_special_tokens=False)]
    assert [both().plain(f" {w}") for w in words] == slow


def test_joining_is_associative():
    rng = random.Random(2)
    text = "the quick  brownish föx jümps " * 8 + "中文没有空格" * 5
    size = len(f" {text}".encode())
    for _ in range(60):
        cuts = [0, *sorted(rng.sample(range(1, size), 5)), size]
        # each part from the words around it, at any bytes
        parts = [ta.fragment(both(), text, s, e) for s, e in zip(cuts, cuts[1:], strict=False)]
        frags = [f for f, _ in parts]
        left = functools.reduce(ta.join, frags)
        right = functools.reduce(lambda x, y: ta.join(y, x), reversed(frags))
        where = rng.randint(1, 5)
        mixed = ta.join(functools.reduce(ta.join, frags[:where]), functools.reduce(ta.join, frags[where:]))
        assert ta.groups_of(left) == ta.groups_of(right) == ta.groups_of(mixed) == brute(text)[2]
        assert ta.join(ta.Fragment(), left) == left == ta.join(left, ta.Fragment())
        assert sorted(x for _, own in parts for x in own) == list(brute_row(0, text)[4])


def test_ranges_end_in_words_and_cover_the_text():
    text = "some words of a text " * 50 + "x" * 900 + " and on " * 40
    ranges = ta.byte_ranges(text, 100)
    data = f" {text}".encode()
    assert ranges[0][0] == 0 and ranges[-1][1] == len(data)
    assert all(x[1] == y[0] for x, y in zip(ranges, ranges[1:], strict=False))
    assert any(data[e - 1 : e + 1].isalpha() for _, e, _, _ in ranges[:-1])
    assert sum(last - first for _, _, first, last in ranges) < 4 * len(data)


def expected(rows):
    aligned = [(d, *brute(t)) for d, t in rows]
    count = collections.Counter(x for *_, links in aligned for x in links)
    most = collections.defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = collections.Counter()
    for d, a, b, groups, links in aligned:
        best = sum(count[x] == most[x[1]] for x in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if a else ""
        out[d, len(a), len(b), len(links), len(links), best, sum(count[x] for x in links), digest] += 1
    return out


def test_query_against_whole_texts(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    found = queries.QUERIES["op12_token_alignment"](spark, sf_dir)
    assert [k for n, k in found.dtypes if n not in ("doc_id", "groups_sha256")] == ["bigint"] * 6
    assert collections.Counter(tuple(r) for r in found.collect()) == expected(rows)


@pytest.mark.parametrize("broadcast_pairs", [1_000_000, 10])
def test_counts_with_and_without_broadcast(frame, broadcast_pairs):
    rows = [r for r in ODD + MORE if r[0] not in (7, 8)]
    aligned = ta.align(frame(rows))
    found = ta.with_counts(aligned, ta.link_counts(aligned, ta.piece_ids()), broadcast_pairs)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    n = F.size("links")
    got = collections.Counter(tuple(r) for r in found.select("doc_id", "n_a", "n_b", n.alias("x"), n.alias("y"), "n_best", "count_sum", digest).collect())
    assert got == expected(rows)
