"""Text operators against brute force, on odd rows (see conftest) and on the shared tables."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import best_fit, decontaminate, license_scan, line_dedup, quality_model, quality_rules, simhash, suffix_dedup, token_packing, url_rules
from starmart.llm.bloom import filter_bits, suspected, twice_filter
from starmart.llm.common import blocks, hex_of, table
from starmart.llm.queries import QUERIES, RULES
from tests.llm.conftest import LINE, ODD


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# ---- filters and lines


def test_filter_never_misses_a_repeat(spark):
    values = spark.range(30_000).select(F.xxhash64(F.col("id") % 20_000).alias("h")).repartition(7)
    packed = twice_filter(values, filter_bits(20_000, 1 << 30))
    hashes = np.array([r.h for r in values.distinct().collect()], np.int64).view(np.uint64)
    counts = collections.Counter(r.h for r in values.collect())
    found = suspected(packed, hashes)
    twice = np.array([counts[int(h)] > 1 for h in hashes.view(np.int64)])
    assert found[twice].all() and found[~twice].mean() < 0.05


@pytest.mark.parametrize("bits", [1 << 30, 1 << 20])
def test_lines_of_odd_rows(spark, frame, bits):
    got = rows_of(line_dedup.drop_repeated_lines(frame(ODD), max_filter_bits=bits), "doc_id", "text", "n_lines", "n_dropped")
    # the line is in both rows of 4, in 5 and in the row without id; 5 is the largest
    want = []
    for doc, text in ODD:
        lines = (text or "").split("\n")
        kept = [] if doc == 4 else lines
        want.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    assert got == sorted(want, key=repr)


def test_lines_of_an_empty_table(frame):
    assert line_dedup.drop_repeated_lines(frame([])).collect() == []


# ---- decontamination


def test_contamination_of_odd_rows(spark, frame):
    words = [f"w{i}" for i in range(30)]
    docs = frame([*ODD, (20, " ".join(words)), (21, "x " + " ".join(words[3:15]) + " y"), (22, " ".join(words[:9]))])
    bench = spark.createDataFrame([(1, " ".join(words)), (1, " ".join(words)), (2, "Over the LAZY dog"), (3, None), (4, ""), (None, "w0 w1 w2")], "item_id int, text string")
    for slice_chars in (1 << 20, 10):
        got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in decontaminate.contamination(docs, bench, slice_chars=slice_chars).collect()}
        assert got[20] == (30, 30, ["1"]) and got[21] == (14, 12, ["1"]) and got[22] == (9, 3, [])
        assert got[4] == (12, 4, ["2"]) and got[1] == got[2] == got[3] == (0, 0, [])
    left = {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()}
    assert left == {1, 2, 3, 6, 7, 8}  # the row without id holds item 2
    assert decontaminate.contamination(frame([]), bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_proximity_matches(spark, frame):
    docs = frame([(1, "alpha x x beta gamma"), (2, "alpha x x x x beta gamma"), (3, "gamma beta alpha")])
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id int, text string")
    index = decontaminate.build_index(docs)
    found = decontaminate.matches(index, bench, within=4)
    docs_of = index.select("segment", F.posexplode("doc_ids").alias("row", "doc"))
    assert sorted(r.doc for r in found.join(docs_of, ["segment", "row"]).collect()) == [1, 3]
    assert decontaminate.matches(index, bench).count() == 0


# ---- token rows


WHITE = [" ", "\n", "\t", "\u3000", "\x85"]


def test_white_space_is_merged_as_the_tokenizer_does():
    encode, rng = token_packing.encoding(token_packing.TOKENIZER), random.Random(6)
    for _ in range(200):
        run = "".join(rng.choices(WHITE[: rng.randint(1, 5)], k=rng.randint(1, 300)))
        assert token_packing.merged_ids(encode, run.encode()) == encode.encode_ordinary(run)
    for kinds in (" ", "\n", "\t", " \n", "\r\n\t "):
        run = "".join(rng.choices(kinds, k=9000))
        for text in (run, f"a{run}b c", f"{run}{run[-1]}1", f"x y{run}", f"{run}\x1cz", f"a{run}b{run}c{run}"):
            assert token_packing.text_ids(encode, text) == encode.encode_ordinary(text)


@pytest.mark.parametrize("kinds", [" ", "\n", "\t", " \n\t"])
def test_very_long_white_space(frame, kinds):
    text = "a" + (kinds if len(kinds) == 1 else "".join(random.Random(1).choices(kinds, k=1000))) * (10_000_000 // (1 if len(kinds) == 1 else 1000)) + "b"
    rows = token_packing.pack_tokens(frame([(1, text)])).collect()
    pieces = sorted((s, row.ids[2 * p : 2 * q]) for row in rows for s, p, q in zip(row.piece_starts, row.cu_seqlens, row.cu_seqlens[1:], strict=False))
    ids = np.frombuffer(b"".join(x for _, x in pieces), "<u2")
    assert ids[-1] == token_packing.END
    encode = token_packing.encoding(token_packing.TOKENIZER)
    assert b"".join(map(encode.decode_single_token_bytes, ids[:-1].tolist())) == text.encode()


def test_token_query_gives_the_ids_back(spark, sf_dir):
    encode = token_packing.encoding(token_packing.TOKENIZER)
    want = collections.Counter()
    for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect():
        want[r.doc_id, tuple([*encode.encode_ordinary(r.text or ""), token_packing.END])] += 1
    found = collections.defaultdict(list)
    for row in QUERIES["op3_token_output"](spark, sf_dir).collect():
        ids, places = np.frombuffer(row.ids, "<u2"), np.frombuffer(row.position_ids, "<u2")
        assert len(ids) == len(places) == token_packing.LENGTH and row.cu_seqlens[0] == 0
        for doc, s, p, q in zip(row.doc_ids, row.piece_starts, row.cu_seqlens, row.cu_seqlens[1:], strict=False):
            assert places[p:q].tolist() == list(range(q - p))
            found[doc].append((s, ids[p:q].tolist()))
    got = collections.Counter((d, tuple(x for _, ids in sorted(parts) for x in ids)) for d, parts in found.items())
    assert got == want


def test_many_equal_rows(spark):
    text = " ".join(f"word{i % 331}" for i in range(400))
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).cast("bigint").alias("doc_id"), F.lit(text).alias("text"))
    found = suffix_dedup.repeated_bytes(rows).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()
    assert sorted(map(tuple, found), key=repr) == [(7, len(text), len(text), 1, 10_000), (None, len(text), len(text), 1, 10_000)]


# ---- SimHash


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]).encode() for i in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(prints):
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    for a in range(len(ids)):
        for b in np.flatnonzero(np.bitwise_count(values[a] ^ values[a + 1 :]) <= 4):
            x, y = find(ids[a]), find(ids[a + 1 + b])
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_query_is_brute_force(spark, sf_dir):
    docs = {r.doc_id: brute_print(r.text) for r in table(spark, sf_dir, "documents").collect()}
    component = brute_components(docs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op10_simhash_dedup"](spark, sf_dir).collect()}
    assert got == {i: (f"{p:016x}", component[i]) for i, p in docs.items()}


@pytest.mark.parametrize("largest", [4096, 256])
def test_dense_groups_lose_no_link(spark, largest):
    chance = random.Random(3)
    centres = [chance.getrandbits(64) for _ in range(3)]
    prints = {c ^ sum(1 << b for b in chance.sample(range(64), chance.randrange(6))) for c in centres for _ in range(500)}
    prints |= {chance.getrandbits(64) for _ in range(200)}
    ids = dict(enumerate(sorted(prints)))
    rows = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in ids.items()], "print bigint, first bigint")
    got = {r.print % (1 << 64): r.component_id for r in simhash.classes(rows, largest_bucket=largest).collect()}
    component = brute_components(ids)
    assert got == {p: component[i] for i, p in ids.items()}


def test_every_close_pair_has_a_chain():
    chance = np.random.default_rng(5)
    masks = np.array(simhash.ring(list(range(64)), 6), np.uint64)
    for flips in range(9):
        x = np.array([sum(1 << int(b) for b in chance.choice(64, flips, replace=False)) for _ in range(200)], np.uint64)
        found = simhash.chained(np.bitwise_count(x[:, None] & masks), 4)
        assert found.all() if flips <= 4 else True


def test_near_duplicates_of_odd_rows(frame):
    got = rows_of(simhash.near_duplicates(frame(ODD)).select("doc_id", hex_of(F.col("fingerprint")).alias("f"), "component_id"), "doc_id", "f", "component_id")
    prints = [brute_print(t) for _, t in ODD]
    assert [(i, f) for i, f, _ in got] == sorted(((i, f"{p:016x}") for (i, _), p in zip(ODD, prints, strict=True)), key=repr)
    component = brute_components({n: p for n, p in enumerate(prints)})
    groups = collections.defaultdict(list)
    for n, (doc, _) in enumerate(ODD):
        groups[component[n]].append(doc)
    least = {prints[n]: min((d for d in groups[component[n]] if d is not None), default=None) for n in component}
    assert all(c == least[int(f, 16)] for _, f, c in got)
    kept = simhash.drop_near_duplicates(frame(ODD))
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in got} and "n_words" in kept.columns
    assert simhash.near_duplicates(frame([])).count() == 0


# ---- suffixes


def brute_repeats(rows, length=200):
    counts = collections.Counter(b[p : p + length] for _, b in rows for p in range(len(b) - length + 1))
    out = []
    for doc, b in rows:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if counts[b[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(b) else 0
        out.append((doc, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=repr)


def test_repeats_of_odd_rows(frame):
    chance = random.Random(9)
    word = lambda: "".join(chance.choices("abcdé", k=chance.randrange(2, 9)))
    passage = " ".join(word() for _ in range(80))
    rows = [r for r in ODD if r[0] not in (7, 8)] + [(7, "a b " * 300)]
    rows += [(30 + i, " ".join(word() for _ in range(30)) + passage[i : 260 + 3 * i] + " ".join(word() for _ in range(30))) for i in range(12)]
    rows += [(60, passage), (61, passage), (62, passage[1:]), (63, "z" * 199), (64, "z" * 199), (65, "y" * 450)]
    got = rows_of(suffix_dedup.drop_repeats(frame(rows)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes")
    got = [(*g[:-1], bytes(g[-1])) for g in got]
    assert sorted(got, key=repr) == brute_repeats([(i, (t or "").encode()) for i, t in rows])
    assert suffix_dedup.drop_repeats(frame([])).count() == 0


def test_cells_cover_every_start_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    chance = np.random.default_rng(2)
    texts = [chance.integers(97, 100, n).astype(np.uint8) for n in (0, 199, 200, 5000, 3, 450, 699, 700, 701)]
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    of, low, n, _, _ = suffix_dedup.cells(np.concatenate(texts), offsets)
    for i, text in enumerate(texts):
        starts = np.concatenate([np.arange(a, a + k) for a, k in zip(low[of == i], n[of == i], strict=True)] or [np.zeros(0, int)])
        assert sorted(starts) == list(range(max(0, len(text) - 199)))


def test_multikey_order():
    chance = np.random.default_rng(1)
    keys = [chance.integers(0, 4, 500), chance.integers(0, 3, 500), chance.integers(0, 9, 500)]
    order = suffix_dedup.multikey_order(keys)
    assert [tuple(k[i] for k in keys) for i in order] == sorted(zip(*keys, strict=True))


def test_starts_are_shuffled_to_their_rows_only(frame):
    plan = suffix_dedup.drop_repeats(frame([(1, "ab c " * 90), (2, "ab c " * 90), (2, "ab c " * 90)]))._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\((.*)", plan)
    assert keys and not any(re.search(r"\b(low|n)#", k) for k in keys)


def test_starts_merge_into_stretches():
    chance = np.random.default_rng(5)
    rows = [[(int(a), int(k)) for a, k in zip(chance.integers(0, 3000, c), chance.integers(1, 90, c), strict=True)] for c in chance.integers(1, 40, 60)]
    rows.append([(2**31 - 400, 101), (0, 1)])
    packed = pa.RecordBatch.from_arrays([pa.array(range(61)), pa.array(range(61)), pa.array([[a << 32 | k for a, k in r] for r in rows])], ["_doc", "_key", "spans"])
    (got,) = suffix_dedup._merge_pass(200)([packed.slice(0, 0), packed.slice(3)])
    assert got.column(0).to_pylist() == list(range(3, 61))
    for row, spans in zip(rows[3:], got.column(2).to_pylist(), strict=True):
        want = []
        for a, k in sorted(row):
            if want and a <= want[-1][1]:
                want[-1][1] = max(want[-1][1], a + k + 199)
            else:
                want.append([a, a + k + 199])
        assert [[s >> 32, s & 0xFFFFFFFF] for s in spans] == want


def test_suffix_query_is_brute_force_at_the_small_size(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, (r.text or "").encode()) for r in table(spark, sf_dir, "documents").collect()]
    want = [(*w[:4], hashlib.sha256(w[4]).hexdigest()) for w in brute_repeats(rows)]
    got = rows_of(QUERIES["op8_suffix_dedup"](spark, sf_dir), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(want, key=repr)


# ---- classifier and rules


def test_classifier_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = quality_model.train(docs, quality_model.graded(labels.filter(half)))
    assert (np.diff(model.thresholds) > 0).all()
    rows = quality_model.score(docs, model).join(labels.filter(~half), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and r.toxic == 0]
    bad = [not r.kept for r in rows if r.quality == 0 or r.toxic == 1]
    assert np.mean(good) > 0.97 and np.mean(bad) > 0.85
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in rows)


def test_classifier_on_odd_rows(spark, frame):
    docs = frame(ODD)
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 1), (7, 0, 0), (8, None, 0), (None, 1, 0), (99, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert rows_of(quality_model.graded(labels), "doc_id", "grade") == [(4, 1), (7, 1), (99, 2)]
    for rows in (labels, labels.limit(0)):
        model = quality_model.train(docs, quality_model.graded(rows))
        assert quality_model.score(docs, model).count() == len(ODD)
        assert quality_model.drop_rejected(docs, model).columns == docs.columns
    assert quality_model.score(frame([]), model).count() == 0


def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_rules_query_is_brute_force(spark, sf_dir):
    want = {r.doc_id: brute_statistics(r.text) for r in table(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op9_quality_rules"](spark, sf_dir).collect()
    assert {r.doc_id: tuple(r[c] for c in STATISTICS) for r in rows} == want
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept) for r in rows)
    quality = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    judged = [r for r in rows if r.doc_id in quality and not r.base_failed]
    assert np.mean([r.kept == bool(quality[r.doc_id]) for r in judged]) > 0.95


def test_rules_on_odd_rows(spark, frame):
    got = {(r.doc_id, tuple(r[c] for c in STATISTICS)) for r in quality_rules.judge(frame(ODD), []).filter("NOT kept OR kept").collect()}
    assert got == {(i, brute_statistics(t)) for i, t in ODD}
    assert quality_rules.judge(frame([]), []).count() == 0
    assert quality_rules.train(frame(ODD), spark.createDataFrame([], "doc_id bigint, quality int")) == []


def test_rules_are_learned_and_pruned():
    chance = np.random.default_rng(4)
    values = {"a": chance.random(2000), "b": chance.random(2000), "noise": chance.random(2000)}
    bad = (values["a"] > 0.8) & (values["b"] < 0.5)
    rules = quality_rules.learn(values, bad)
    caught = np.zeros(2000, bool)
    for rule in rules:
        caught |= quality_rules._covered(rule, values, np.ones(2000, bool))
    assert rules and (caught & bad).sum() > 0.8 * bad.sum() and (caught & ~bad).sum() < 0.1 * bad.sum()


# ---- packing


def test_token_rows_give_every_document_back(spark, frame):
    encode = token_packing.encoding(token_packing.TOKENIZER)
    docs = [(i, t) for i, t in ODD if i not in (None, 4)]
    pieces = collections.defaultdict(dict)
    rows = token_packing.pack_tokens(frame(docs), length=64).collect()
    for r in rows:
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(places) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] <= 64
        for doc, start, a, b in zip(r.doc_ids, r.piece_starts, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            assert places[a:b].tolist() == list(range(b - a))
            pieces[doc][start] = ids[a:b]
        assert (ids[r.cu_seqlens[-1] :] == token_packing.END).all()
    for doc, text in docs:
        whole = np.concatenate([pieces[doc][s] for s in sorted(pieces[doc])])
        assert whole.tolist() == [*encode.encode_ordinary(text or ""), token_packing.END]
    assert len({r.row for r in rows}) == len(rows)
    assert token_packing.pack_tokens(frame([])).count() == 0


def test_segment_tree_is_best_fit():
    chance = random.Random(8)
    lengths = [chance.randrange(1, 101) for _ in range(400)]
    bins, free = [], []
    for i in sorted(range(400), key=lambda i: -lengths[i]):
        fits = [f for f in free if f >= lengths[i]]
        if fits:
            at = free.index(min(fits))
            bins[at].append(i)
            free[at] -= lengths[i]
        else:
            bins.append([i])
            free.append(100 - lengths[i])
    got = token_packing.best_fit_decreasing(lengths, 100)
    assert sorted(sum(lengths[i] for i in b) for b in got) == sorted(sum(lengths[i] for i in b) for b in bins)


def test_bins_hold_no_conflict_and_lose_nothing(spark, frame):
    docs = frame(ODD, "a").unionAll(frame([(100 + i, f"{LINE} {i % 40}") for i in range(300)], "b")).unionAll(frame([(500 + i, LINE * (i % 5 + 1)) for i in range(90)], None))
    source = {r.doc_id: r.source for r in docs.collect()}
    pieces = collections.defaultdict(list)
    for r in best_fit.best_fit_bins(docs, 400).collect():
        assert r.n_bytes == sum(len(t.encode()) + 1 for t in r.texts) <= 400
        assert len({source[d] for d in r.doc_ids}) == len(r.doc_ids)
        clusters = [best_fit.cluster_of(t.encode()) for t in r.texts if t.startswith(LINE) and len(t) < 300]
        assert len(set(clusters)) == len(clusters)
        for d, s, t in zip(r.doc_ids, r.piece_starts, r.texts, strict=True):
            pieces[d].append((s, t))
    for r in docs.collect():
        if r.doc_id not in (4, None):
            assert "".join(t for _, t in sorted(pieces[r.doc_id])) == (r.text or "")
    assert len(pieces[4]) == 2 and best_fit.best_fit_bins(frame([])).count() == 0


def test_tightest_compatible_bin_is_found():
    chance = random.Random(6)
    needs = [chance.randrange(5, 60) for _ in range(300)]
    sources, clusters = [chance.randrange(70) for _ in needs], [chance.randrange(90) for _ in needs]
    members, free = [], []
    for i in sorted(range(300), key=lambda i: -needs[i]):
        fits = [b for b in range(len(members)) if free[b] >= needs[i] and all(sources[i] != sources[j] and clusters[i] != clusters[j] for j in members[b])]
        if fits:
            best = min(free[b] for b in fits)
        got_free = best if fits else 100
        at = next(b for b in fits if free[b] == best) if fits else len(members)
        if at == len(members):
            members.append([])
            free.append(100)
        members[at].append(i)
        free[at] = got_free - needs[i]
    got = best_fit.pack(needs, sources, clusters, 100)
    for group in got:
        assert len({sources[i] for i in group}) == len({clusters[i] for i in group}) == len(group)
        assert sum(needs[i] for i in group) <= 100
    assert abs(len(got) - len(members)) <= 3


def test_sorted_sources_fill_bins_like_mixed_ones(spark):
    # whole partitions of one source, each more than is packed at once
    text = F.concat(F.lit("x" * 24), F.lpad(F.col("id").cast("string"), 6, "0"))
    docs = spark.range(0, 30_000, 1, 3).select(F.col("id").alias("doc_id"), text.alias("text"), F.floor(F.col("id") / 10_000).alias("source"))
    rows = best_fit.best_fit_bins(docs, 93).collect()
    assert all(len({d // 10_000 for d in r.doc_ids}) == len(r.doc_ids) for r in rows)
    assert sorted(d for r in rows for d in r.doc_ids) == list(range(30_000))
    assert len(rows) < 1.1 * 10_000


def test_near_copies_share_no_bin(spark, tmp_path):
    chance = random.Random(21)
    text = " ".join("".join(chance.choices("abcdefgh", k=6)) for _ in range(300))
    copies = [text, text + " end", "begin " + text]
    assert all((brute_print(a) ^ brute_print(b)).bit_count() <= 4 for a in copies for b in copies)
    other = " ".join("".join(chance.choices("stuvwxyz", k=6)) for _ in range(300))
    assert (brute_print(other) ^ brute_print(text)).bit_count() > 8
    rows = [(1, copies[0], "a"), (2, copies[1], "b"), (None, copies[2], "c"), (3, other, "d"), (3, other, "e"), (4, None, "f"), (3, copies[0], "g")]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    bins = QUERIES["op4_best_fit_packing"](spark, str(tmp_path)).collect()
    assert sorted((x for r in bins for x in zip(r.doc_ids, r.texts, strict=True)), key=repr) == sorted(((d, t or "") for d, t, _ in rows), key=repr)
    for r in bins:
        assert sum(t in copies for t in r.texts) <= 1 and r.texts.count(other) <= 1
    assert len(bins) < len(rows)


def test_bins_stay_open_within_bounds():
    chance = random.Random(12)
    bins, closed, placed = [], [], 0
    for _ in range(6):
        pieces = [(placed + i, 0, b"x" * chance.randrange(5, 60), str(chance.randrange(9)), bytes([chance.randrange(40)])) for i in range(100)]
        placed += 100
        begun = [(best_fit.taken(b), [p[3] for p in b], [p[4] for p in b]) for b in bins]
        groups = best_fit.pack([len(p[2]) + 1 for p in pieces], [p[3] for p in pieces], [p[4] for p in pieces], 100, begun)
        assert len(groups) >= len(bins) and any(groups[: len(bins)]) == bool(bins)
        bins = [*bins, *([] for _ in groups[len(bins) :])]
        bins, done = best_fit.still_open([[*b, *(pieces[i] for i in g)] for b, g in zip(bins, groups, strict=True)], 100, most_bytes=1500)
        assert sum(map(best_fit.taken, bins)) <= 1500 and max(map(best_fit.taken, bins), default=0) <= min(map(best_fit.taken, done), default=100)
        closed += done
    closed += bins
    assert sorted(p[0] for b in closed for p in b) == list(range(placed))
    for b in closed:
        assert best_fit.taken(b) <= 100 and len({p[3] for p in b}) == len({p[4] for p in b}) == len(b)


# ---- URLs and licenses


def test_url_rules_on_odd_rows(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.ORG", "http://x.example.org/es/", "http://example.org/en/12?q", "http://org/", "http://notexample.org/es/", "http://b.COM/fr/#x", "http://com/de/a/b", "x://y://org/a"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*urls, *urls])], "page_id int, url string, rule string")
    rules = spark.createDataFrame([*RULES, (None, "/", "block"), ("org", None, "block")], "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, rules).collect()}
    n = len(urls)
    assert all(got[i] == got[i + n] for i in range(n)) and len(got) == 2 * n
    none = ("", "", None, "allow")
    assert [got[i] for i in range(4)] == [none] * 4 and got[4] == ("a.org", "", None, "allow")
    assert got[5] == ("x.example.org", "/es/", "example.org/es/", "block") and got[6] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[7] == ("org", "/", "org/", "allow") and got[8][2] == "org/" and got[9][1:] == ("/fr/", "com/fr/", "allow")
    assert got[10][2:] == ("com/de/", "block") and got[11] == ("y:", "//org/a", None, "allow")
    assert url_rules.judge(pages, rules.limit(0)).filter("rule IS NOT NULL").count() == 0
    assert url_rules.judge(pages.limit(0), rules).count() == 0


def test_license_of_odd_rows(spark, frame):
    notice = license_scan.TEMPLATES["mit"]
    changed = notice.replace("any person", "every person")
    rows = [*ODD, (10, f"{LINE}\n{notice.upper()}\n{LINE}"), (11, changed), (11, changed), (12, notice[:60]), (None, "x Released under the MIT License. y")]
    got = rows_of(license_scan.scan(frame(rows), license_scan.template_table(spark)), "doc_id", "license_id")
    assert got == sorted([(10, "mit"), (11, "mit"), (11, "mit"), (None, "mit-line")], key=repr)
    assert license_scan.scan(frame([]), license_scan.template_table(spark)).count() == 0
    assert license_scan.scan(frame(rows), license_scan.template_table(spark).limit(0)).count() == 0


def test_bands_make_misses_rare():
    assert (1 - 1 / license_scan.WINDOW) ** license_scan.bands_for() <= license_scan.MISS


# ---- pipeline


def test_pipeline_is_its_stages_by_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model_kept = corpus_pipeline.classify(spark, docs, sf_dir)
    assert model_kept.columns == docs.columns
    rows = {r.doc_id: r.text or "" for r in model_kept.collect()}
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    for doc, text in rows.items():
        for line in text.split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(doc)
    gone = lambda doc, line: len(holders.get(key(line), ())) >= 3 and max(holders[key(line)]) != doc
    rows = {d: "\n".join(x for x in t.split("\n") if not gone(d, x)) for d, t in rows.items()}
    component = brute_components({d: brute_print(t) for d, t in rows.items()})
    rows = {d: t for d, t in rows.items() if component[d] == d}
    tokens = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = set()
    for r in table(spark, sf_dir, "benchmark").collect():
        w = tokens(r.text)
        windows |= {tuple(w[i : i + min(10, len(w))]) for i in range(len(w) - min(10, len(w)) + 1) if w}
    sizes = {len(w) for w in windows}
    rows = {d: t for d, t in rows.items() if not any(tuple(w[i : i + n]) in windows for w in [tokens(t)] for n in sizes for i in range(len(w) - n + 1))}
    pieces = collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        for d, s, t in zip(r.doc_ids, r.piece_starts, r.texts, strict=True):
            pieces[d].append((s, t))
    assert {d: "".join(t for _, t in sorted(p)) for d, p in pieces.items()} == rows


def test_blocks_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * n for n in (0, 5, 0, 30, 2, 0)] + [None])})
    assert [b.column(0).to_pylist() for b in blocks(batch, "text", 6)] and sum(b.num_rows for b in blocks(batch, "text", 6)) == 7
