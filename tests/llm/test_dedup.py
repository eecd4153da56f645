"""Near duplicates, repeated word passages and repeated byte strings against brute force."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import helpers as h
from evidara.graph import components
from evidara.llm import minhash, substring, suffixes
from evidara.llm.common import merge_spans, window_runs, word_line

SPECIAL = [
    (901, None), (902, ""), (903, "  \t\n "), (904, "one"), (905, "one"), (906, "One"), (907, "two words"), (None, "one"), (None, None),
    (908, "é ü ñ  x"), (908, "é ü ñ  x"), (-5, "one"), (909, h.LONG), (910, h.LONG + " tail"), (911, "x\x0by\x0cz"),
]


def _edited(seed, text, changes):
    r, w = random.Random(seed), text.split()
    for _ in range(changes):
        w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
    return " ".join(w)


def _family():
    base = h.words_text(1, 120)
    rows = [(i, _edited(i, base, i % 9)) for i in range(60)]
    rows += [(100 + i, h.words_text(50 + i, 40 + i)) for i in range(20)]
    rows += [(200 + i, h.words_text(60, 60) + " " + h.words_text(300 + i, 12)) for i in range(25)]
    return rows + [(5, h.words_text(777, 30)), (130, h.words_text(777, 30))]


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(spark, k):
    rows = _family() + SPECIAL
    got = minhash.near_duplicates(h.docs(spark, rows), k=k).collect()
    assert h.same(got, h.near_duplicates(rows, k, 80))


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(h.docs(spark, []), k=4).collect() == []
    assert minhash.near_duplicates(h.docs(spark, [(1, None)]), k=4).collect() == [(1, 0, 1, True)]


def test_pairs_that_pivots_miss(spark):
    """Chains in one bucket: the first member links to few, the others to each other."""
    base = h.words_text(9, 200).split()
    rows = []
    for i in range(40):
        w = list(base)
        for j in range(14):
            w[(i * 5 + j * 14) % 200] = f"c{i}_{j}"
        rows.append((i, " ".join(w)))
    got = minhash.near_duplicates(h.docs(spark, rows), k=1).collect()
    assert h.same(got, h.near_duplicates(rows, 1, 80))


def test_passages_are_sought_with_little_at_a_time():
    texts = [h.words_text(i, 400).encode() for i in range(1000)]
    key = pa.array(range(1000))
    for run, batch in ((substring._owners(13), pa.record_batch({"doc_id": key, "text": pa.array(texts, pa.binary())})),
                       (substring._runs(13), pa.record_batch({"doc_id": key, "key": key, "text": pa.array(texts, pa.binary())}))):
        tracemalloc.start()
        for _ in run(iter([batch])):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 30 << 20


def test_sets_do_not_travel_with_their_shingles(spark, monkeypatch):
    """What the rest join moves has a row per set and shingle, so a row must not hold a set."""
    stash, widest = minhash.stash, []

    def seen(df):
        got = stash(df)
        if "item" in got.columns:
            arrays = [c for c, t in got.dtypes if t.startswith("array")]
            widest.append(got.select(F.greatest(F.lit(0), *[F.max(F.size(c)) for c in arrays])).first()[0])
        return got

    monkeypatch.setattr(minhash, "stash", seen)
    base = h.words_text(9, 200).split()
    rows = []
    for i in range(40):
        w = list(base)
        for j in range(14):
            w[(i * 5 + j * 14) % 200] = f"c{i}_{j}"
        rows.append((i, " ".join(w)))
    got = minhash.near_duplicates(h.docs(spark, rows), k=1).collect()
    assert h.same(got, h.near_duplicates(rows, 1, 80))
    assert widest and max(widest) <= 16


def test_parity_bits_differ_in_no_more_places_than_sets():
    r = np.random.default_rng(3)
    pool = np.unique(r.integers(0, 2**63, 3000, np.uint64) * np.uint64(2) + np.uint64(1))
    sets = [np.sort(r.permutation(pool)[:n]) for n in (1, 5, 200, 300, 1200, 2500)] + [pool[:0], pool[:250], pool[5:255]]
    bits = minhash.parity_bits(sets)
    for a, p in zip(sets, bits):
        for b, q in zip(sets, bits):
            assert np.bitwise_count(p ^ q).sum() <= len(np.setxor1d(a, b))
    assert np.bitwise_count(bits[2] ^ bits[3]).sum() > 200
    assert (bits[6] == 0).all() and (minhash.parity_bits([pool[5:255]])[0] == bits[8]).all()


def test_signing_holds_little_at_a_time():
    texts = [h.words_text(i, 400).encode() for i in range(1000)]
    batch = pa.record_batch({"doc_id": pa.array(range(1000)), "text": pa.array(texts, pa.binary())})
    for run, given in ((minhash._sign(4, 28, 4), batch), (minhash._sets(4), batch.select(["text"]))):
        tracemalloc.start()
        for _ in run(iter([given])):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 30 << 20


def test_keep_first_keeps_all_columns(spark):
    d = h.docs(spark, [(3, h.words_text(1, 50)), (2, h.words_text(1, 50)), (4, "other"), (None, "x")])
    got = minhash.keep_first(d)
    assert got.columns == d.columns and sorted(r.doc_id or 0 for r in got.collect()) == [0, 2, 4]


def test_signature_estimates_similarity():
    r = np.random.default_rng(0)
    pool = r.integers(0, 2**63, 4000, np.uint64) * np.uint64(2)
    errors = []
    for i in range(60):
        some = r.permutation(pool)
        a, b = some[:300], np.r_[some[:240], some[300:360]]
        sig = minhash.signatures([np.unique(a), np.unique(b)], 128)
        errors.append(minhash.estimate(*sig) - 240 / 360)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05
    # a signature is a property of the set, whatever else is in the batch
    one = minhash.signatures([np.unique(pool[:7])], 128)
    assert (one[0] == minhash.signatures([np.unique(pool[:900]), np.unique(pool[:7])], 128)[1]).all()
    assert len(np.unique(one[0] >> np.uint64(56))) > 1


@pytest.mark.parametrize("n", [1, 6, 200])
def test_components_of_a_path(spark, n):
    edges = [(0, n)] + [(i, i - 1) for i in range(2, n + 1)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.component) for r in got) == [(i, 0) for i in range(n + 1)]


def _passages():
    shared = [h.words_text(10 + i, 10 + i * 2, 10**6) for i in range(12)]
    r = random.Random(5)
    rows = []
    for i in range(50):
        parts = [h.words_text(100 + i, r.randrange(0, 40), 10**6)]
        for _ in range(r.randrange(4)):
            parts += [r.choice(shared), h.words_text(1000 + i, r.randrange(0, 6), 10**6)]
        rows.append((r.randrange(40), " ".join(parts)))
    return rows + [(60, "a " * 60), (61, "a " * 30), (62, ("a b c " * 10))]


@pytest.mark.parametrize("length", [5, 13])
def test_word_removal(spark, length):
    rows = _passages() + SPECIAL
    got = substring.removal_digests(h.docs(spark, rows), length).collect()
    assert h.same(got, h.word_removal(rows, length))


def test_word_removal_with_hot_owners(spark, monkeypatch):
    monkeypatch.setattr(substring, "HOT_RUNS", 2)
    monkeypatch.setattr(substring, "SHARD_WORDS", 50)
    rows = _passages()
    assert h.same(substring.removal_digests(h.docs(spark, rows)).collect(), h.word_removal(rows, 13))


def test_removal_of_nothing(spark):
    assert substring.removal_digests(h.docs(spark, [])).collect() == []
    assert suffixes.removal_digests(h.docs(spark, [])).collect() == []
    assert suffixes.removal_digests(h.docs(spark, [(1, None)])).collect() == [(1, 0, 0, 0, h.sha(b""))]


def test_remove_repeats_changes_only_texts_that_lose_words(spark):
    passage = h.words_text(1, 20)
    d = h.docs(spark, [(1, "a  b " + passage), (2, "c\n\td " + passage + "  e"), (3, None), (None, passage)]).withColumnRenamed("n", "n_chars")
    got = {r.doc_id: r for r in substring.remove_repeats(d).collect()}
    assert got[1].text == "a  b " + passage and got[2].text == "c d e" and got[3].text is None and got[None].text == passage
    assert got[2].n_chars == 5 and got[1].n_chars == 3
    assert substring.remove_repeats(d).columns == d.columns


def test_suffix_automaton_marks_and_lengths():
    r = random.Random(3)
    for _ in range(200):
        strings = [([r.randrange(3) for _ in range(r.randrange(1, 12))], r.randrange(9)) for _ in range(r.randrange(1, 6))]
        a = substring.SuffixAutomaton()
        for s, m in strings:
            a.add(s, m)
        a.close()
        query = [r.randrange(3) for _ in range(15)]
        for i, (n, mark) in enumerate(a.statistics(query, 4), 1):
            found = [k for k in range(min(4, i) + 1) if k == 0 or any(query[i - k : i] == s[j : j + k] for s, _ in strings for j in range(len(s)))]
            assert n == max(found)
            if n:
                assert mark == min(m for s, m in strings if any(query[i - n : i] == s[j : j + n] for j in range(len(s))))


@pytest.mark.parametrize("length", [40, 400])
def test_byte_removal(spark, length):
    rows = _passages() + [r for r in SPECIAL if r[1] != h.LONG and r[1] != h.LONG + " tail"]
    rows += [(70, "z" * 900), (71, "z" * 500), (72, "y" * 401), (73, h.words_text(4, 200)), (74, "prefix " + h.words_text(4, 200) + "!")]
    got = suffixes.removal_digests(h.docs(spark, rows), length).collect()
    assert h.same(got, h.byte_removal(rows, length))


def test_byte_removal_of_long_texts_in_slices(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BATCH_BYTES", 700)
    monkeypatch.setattr(suffixes, "HOT_RUNS", 2)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 2000)
    text = h.words_text(4, 800)
    rows = [(1, text), (2, "x" + text), (3, text[300:2500] + "?" + text[100:900]), (4, h.words_text(8, 900))]
    assert h.same(suffixes.removal_digests(h.docs(spark, rows), 60).collect(), h.byte_removal(rows, 60))


def _noticed(n, size):
    """Documents that hold one notice in differing surroundings."""
    notice = h.words_text(42, size, 10**6)
    rows = [(i, f"{h.words_text(100 + i, 8, 10**6)} {notice} {h.words_text(500 + i, 8, 10**6)}") for i in range(n)]
    return rows + [(3, rows[5][1]), (n, h.words_text(9, 30, 10**6)), (n + 1, notice), (n + 2, f"{notice} {notice}"), (None, notice)]


def _met(real, column, most):
    """``real``, which must not meet equal strings more often than ``most`` in one group."""
    def strict(length):
        run = real(length)

        def checked(key, part):
            assert part[column].value_counts().max() <= most, "copies of one window in one group"
            return run(key, part)
        return checked
    return strict


@pytest.mark.parametrize("size", [13, 15])
def test_a_window_of_a_hot_owner_streams_once(spark, monkeypatch, size):
    monkeypatch.setattr(substring, "HOT_RUNS", 4)
    monkeypatch.setattr(substring, "_match", _met(substring._match, "words", 2))
    rows = _noticed(40, size)
    assert h.same(substring.removal_digests(h.docs(spark, rows)).collect(), h.word_removal(rows, 13))


def test_a_window_of_a_hot_owner_is_sorted_twice_at_most(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT_RUNS", 4)
    monkeypatch.setattr(suffixes, "_sort", _met(suffixes._sort, "data", 2))
    rows = _noticed(40, 12)
    assert h.same(suffixes.removal_digests(h.docs(spark, rows), 70).collect(), h.byte_removal(rows, 70))


def test_suffix_array():
    r = random.Random(1)
    for _ in range(500):
        t = np.array([r.randint(1, r.choice([1, 2, 3, 20])) for _ in range(r.randint(0, 40))], np.int64)
        assert suffixes.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_words_and_windows():
    rows = [b"", b" a  b\x0bc", b"\t", b"A b", b"a!"]
    hashes, row, begin = word_line(rows)
    assert row.tolist() == [1, 1, 1, 3, 3, 4] and begin.tolist() == [0, 0, 3, 3, 5]
    assert hashes[1] == hashes[4] and hashes[0] != hashes[3]
    folded = word_line(rows, True, b"!")[0]
    assert folded[0] == folded[3] == folded[5]
    first, n, owner = window_runs(np.arange(10, dtype=np.uint64) << np.uint64(32), np.zeros(12, int), 6, 3)
    assert first.tolist() == list(range(7)) and set(n.tolist()) == {1} and (owner == first).all()
    start, end = merge_spans(np.array([5, 1, 2]), np.array([7, 3, 5]))
    assert start.tolist() == [1] and end.tolist() == [7]
