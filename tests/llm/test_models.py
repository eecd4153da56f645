"""Language, toxicity, benchmark passages and mixing."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

import helpers as h
from evidara.llm import decontamination, language, mixing, toxicity

ALPHABETS = {"xa": ["ba", "ke", "lo", "mi"], "xb": ["str", "ung", "sch", "ei"], "xc": ["ção", "ã", "lh", "ou"]}


def _text(lang, seed, n=30):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(ALPHABETS[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


def test_language(spark):
    rows = [(i, _text(lang, i), lang) for i, lang in enumerate(list(ALPHABETS) * 40)]
    rows += [(500, None, "xa"), (501, "", "xb"), (502, "12 34 !?", "xb"), (None, _text("xc", 1), "xc"), (503, _text("xb", 9), None), (503, _text("xb", 9), None)]
    rows += [(504, _text("xa", 3, 20_000), "xa"), (505, "K" * 100_000, "xb")]
    got = language.identify(h.docs(spark, rows)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3 and by[504].lang_pred == "xa" and by[503].lang_pred == "xb"
    assert by[None].lang_pred == "xc" and by[None].held_out is False
    held = [r for r in got if r.doc_id is not None and r.doc_id < 500 and r.held_out]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert np.mean([rows[r.doc_id][2] == r.lang_pred for r in held]) == 1


def test_more_languages_than_landmarks(spark):
    """Every language is learned, the rarest too."""
    langs = [f"l{i:02}" for i in range(24)]
    letters = {lang: [chr(0x100 + 12 * i + j) for j in range(12)] for i, lang in enumerate(langs)}
    r = random.Random(8)
    rows = []
    for i, lang in enumerate(langs):
        for _ in range(9 + 6 * (i % 3)):
            rows.append((len(rows), " ".join("".join(r.choice(letters[lang]) for _ in range(5)) for _ in range(20)), lang))
    got = language.identify(h.docs(spark, rows), landmarks=6, most=60).collect()
    assert all(rows[g.doc_id][2] == g.lang_pred for g in got if g.held_out) and {g.lang_pred for g in got} == set(langs)


def test_language_by_length(spark):
    """Held-out texts of one word to 20,000 words, each length with every language."""
    rows = [(i, _text(lang, i), lang) for i, lang in enumerate(list(ALPHABETS) * 40)]
    long = [(1000 + len(ALPHABETS) * k + j, _text(lang, 7 + k, n), lang) for k, n in enumerate((3, 300, 3_000, 20_000)) for j, lang in enumerate(ALPHABETS)]
    got = {g.doc_id: g.lang_pred for g in language.identify(h.docs(spark, rows + [(i, t, None) for i, t, _ in long])).collect()}
    assert all(got[i] == lang for i, _, lang in long)


def test_blocks_stay_open_for_long_texts():
    """A real-size vocabulary at 20,000 words fills no block of the longer n-grams by half."""
    r = random.Random(1)
    syllables = ["".join(p) for p in zip("bcdfglmnprst" * 5, "aeiou" * 12)]
    words = ["".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(3_000)]
    row = language.presence([" ".join(r.choice(words) for _ in range(20_000)).encode()])[0]
    filled = [row[a:b].mean() for a, b in zip(language.OFFSETS[2:-1], language.OFFSETS[3:])]
    assert max(filled) < 0.5


def test_language_without_labels(spark):
    assert language.identify(h.docs(spark, [])).collect() == []
    assert language.identify(h.docs(spark, [(1, "abc", None)])).collect()[0].lang_pred == "und"


def test_kernel_counts_shared_grams():
    x = language.presence([b"abc", b"abc", b"xyz", b""])
    k = language.kernel(x, x)
    assert k[0, 1] == pytest.approx(1) and k[0, 2] < 0.3 and np.allclose(k, k.T)


BAD = ["grolk", "snivvit", "blarn"]


def _toxic_docs():
    r = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        w = [f"{r.choice('bdfgklmnprst')}{r.choice('aeiou')}{r.choice('bdklmnrst')}" for _ in range(40)]
        if toxic:
            for _ in range(3):
                w[r.randrange(40)] = r.choice(BAD)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = _toxic_docs()
    hidden = [(600, "you gr0lk bas"), (601, "such a s-n-i-v-v-i-t dot"), (602, "b l a r n b l a r n"), (603, "blaaaaarn snivvit"), (604, "GROLK!!! grolk")]
    clean = [(700, None), (701, ""), (702, "bas dot kel"), (None, "bas dot"), (703, "555-1234 a1b2 http://x.y/z?q=1"), (704, "$$$ !!! ###"), (705, "a b c d e f g"),
             (706, "k" * 50_000), (707, "bas dot kel " * 30_000)]
    d = h.docs(spark, rows + hidden + clean)
    marks = spark.createDataFrame(labels + [(0, None), (None, 1), (5, 1), (705, 0)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(d, marks).collect()}
    assert len(got) == len(rows) + len(hidden) + len(clean) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert all(got[i].predicted == y for i, y in labels)
    assert all(got[i].predicted == 1 for i, _ in hidden)
    assert all(got[i].predicted == 0 for i, _ in clean)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in rows) and got[None].held_out is False
    left = toxicity.drop_toxic(d, marks)
    assert left.columns == d.columns and {r.doc_id for r in left.collect()} == {i for i, r in got.items() if not r.predicted}


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity(h.docs(spark, []), none).collect() == []
    assert [r.predicted for r in toxicity.toxicity(h.docs(spark, [(1, "grolk")]), none).collect()] == [0]


def test_restorer_finds_the_best_reading(spark):
    rows, _ = _toxic_docs()
    model = toxicity.character_model(h.docs(spark, rows))
    restorer = toxicity.Restorer(model)
    r = random.Random(4)
    for _ in range(30):
        token = "".join(r.choice("gr0l1k4!.") for _ in range(r.randint(1, 6)))

        def score(reading, costs):
            x = y = 0
            total = costs
            for c in reading:
                z = toxicity._class(c)
                total += model[x, y, z]
                x, y = y, z
            return total + model[x, y, 0]

        readings = [("", 0.0)]
        for options in restorer.lattice(token, False):
            readings = [(a + b, s + t) for a, s in readings for b, t in options]
        best = max(score(a, s) for a, s in readings)
        assert max(score(a, s) for a, s in readings if a == restorer.restore(token)) == pytest.approx(best)


def _changed(text, seed, share):
    r = random.Random(seed)
    return " ".join(f"zz{r.randrange(10**6)}" if r.random() < share else w for w in text.split())


def _items():
    return [(i, h.words_text(900 + i, 20 + i % 15, 10**6)) for i in range(30)] + [(40, "only four words here"), (41, None), (42, ""), (None, h.words_text(999, 25, 10**6))]


def test_decontamination(spark):
    items = _items()
    rows, want = [], {}
    for i in range(60):
        body = h.words_text(i, 100, 10**6)
        if i % 3 == 0:
            item = items[i % 30][1]
            rows.append((i, f"{body} {_changed(item, i, 0.12)} {h.words_text(500 + i, 30, 10**6)}"))
            want[i] = [i % 30]
        else:
            rows.append((i, body))
    rows += [(100, None), (101, ""), (102, "ONLY Four words, here!"), (None, items[3][1]), (103, h.LONG + " " + items[4][1].upper()), (104, items[33][1]), (105, items[5][1] + " " + items[6][1]), (105, "x")]
    want |= {102: [40], None: [3], 103: [4], 104: []}
    got = decontamination.contamination(h.docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id == 105:
            assert r.item_ids in ([5, 6], [])
        else:
            assert r.contaminated == (r.doc_id in want) and r.item_ids == want.get(r.doc_id, []), r
    assert next(r for r in got if r.doc_id == 104).n_items == 1


def test_decontamination_is_brute_force_on_seed_hits(spark, monkeypatch):
    """Every document and item that share a seed and a stretch that counts, by trying all places; in many shards."""
    monkeypatch.setattr(decontamination, "SHARD_TOKENS", 150)
    items = [(i, t) for i, t in _items() if t and i is not None]
    rows = [(i, " ".join(_changed(items[(i + j) % 30][1], i + j, 0.1 * (i % 5)) for j in range(2))) for i in range(40)]
    got = {r.doc_id: r.item_ids for r in decontamination.contamination(h.docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for i, text in rows:
        t = decontamination.word_line([text.encode()], True, decontamination.EDGES)[0]
        found = []
        for name, item in items:
            s = decontamination.word_line([item.encode()], True, decontamination.EDGES)[0]
            for at in range(-len(s) + 1, len(t)):
                lo, hi = max(0, -at), min(len(s), len(t) - at)
                equal = s[lo:hi] == t[at + lo : at + hi]
                hit = any(all(equal[p + q] for q, b in enumerate(m) if b == "1") for m in decontamination.SEEDS for p in range(len(equal) - len(m) + 1))
                if (hit or len(s) < 5) and decontamination.judge(s, t, at):
                    found.append(name)
        assert got[i] == sorted(set(found))


def _counts(item, text):
    """The stated rule by trying all places and stretches of two lists of tokens: the most equal tokens, 0 if none counts."""
    most = 0
    for at in range(-len(item) + 1, len(text)):
        lo, hi = max(0, -at), min(len(item), len(text) - at)
        equal = [item[i] == text[at + i] for i in range(lo, hi)]
        for a in range(len(equal)):
            for b in range(a + 1, len(equal) + 1):
                same = sum(equal[a:b])
                if len(item) <= 5:
                    counts = same == len(item)
                else:
                    counts = (same >= 10 or (same >= 5 and 10 * same >= 6 * len(item))) and 10 * same >= 7 * (b - a)
                most = max(most, same if counts else 0)
    return most


def test_decontamination_is_the_stated_rule(spark):
    r = random.Random(11)
    items = [(i, h.words_text(3000 + i, 3 + i % 24, 10**6)) for i in range(72)]
    rows = []
    for i in range(360):
        words = items[i % 72][1].split()
        for p in r.sample(range(len(words)), min(len(words), round(len(words) * r.choice([0, 0.2, 0.25, 0.28, 0.3, 0.33])))):
            words[p] = f"zz{r.randrange(10**6)}"
        rows.append((i, " ".join([h.words_text(i, 4, 10**6), *words, h.words_text(7000 + i, 3, 10**6)])))
    got = {x.doc_id: x for x in decontamination.contamination(h.docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for i, text in rows:
        want = _counts(items[i % 72][1].split(), text.split())
        assert (got[i].item_ids, got[i].matched) == ([i % 72] if want else [], want), (i, text)
    assert 100 < sum(x.contaminated for x in got.values()) < 340


@pytest.mark.parametrize("least, most", [(5, 9), (10, 99)])
def test_every_stretch_that_counts_holds_a_seed(least, most):
    """All strings of equal and other tokens that avoid the masks, by their last tokens: the largest sum of
    (equal - 0.7) for each number of equal tokens stays below 0."""
    masks = decontamination.SEEDS + (decontamination.SHORT_SEEDS if least < 10 else ())
    width = max(map(len, masks))
    need = [(int(m, 2), len(m)) for m in masks]
    full = (1 << width) - 1
    step = [[(s << 1 | b) & full for b in (0, 1)] for s in range(full + 1)]
    bad = [any(s & m == m for m, _ in need) for s in range(full + 1)]
    best = {(0, 0): 0}
    seen = {}
    while best:
        then = {}
        for (state, n), total in best.items():
            for b in (0, 1):
                key, value = (step[state][b], min(n + b, least)), total + (3 if b else -7)
                if not bad[key[0]] and value > max(seen.get(key, -100), then.get(key, -100)):
                    then[key] = value
        seen |= then
        best = then
        assert all(value < 0 for (_, n), value in then.items() if n >= least)


def test_decontamination_holds_little_at_a_time():
    class Sent:
        value = decontamination.SeedTable([(i, h.words_text(i, 40).encode()) for i in range(200)]).state()

    texts = [h.words_text(i, 400).encode() for i in range(1000)]
    batch = pa.record_batch({"doc_id": pa.array(range(1000)), "key": pa.array(range(1000)), "text": pa.array(texts, pa.binary())})
    tracemalloc.start()
    found = sum(b.num_rows for b in decontamination._find(Sent)(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 200 and most < 40 << 20


def test_marks_are_found_again():
    r = np.random.default_rng(1)
    hashes = r.integers(0, 2**63, 50_000, np.uint64) * np.uint64(2)
    lead = set((hashes[:20_000] >> np.uint64(64 - decontamination.FILTER_BITS)).tolist())
    got = decontamination.occurs(decontamination.present(hashes[:20_000]), hashes)
    assert got.tolist() == [x in lead for x in (hashes >> np.uint64(64 - decontamination.FILTER_BITS)).tolist()]


def test_decontamination_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(h.docs(spark, []), none).collect() == []
    d = h.docs(spark, [(1, "a b"), (None, None)])
    assert {r.contaminated for r in decontamination.contamination(d, none).collect()} == {False}
    kept = decontamination.drop_contaminated(d, spark.createDataFrame([(1, "a b")], "item_id long, text string"))
    assert kept.columns == d.columns and [r.doc_id for r in kept.collect()] == [None]


def _mixed():
    r = random.Random(8)
    rows = [(i, h.words_text(i, r.randrange(5, 80)), r.choice(["de", "en", "fr"]), "big" if r.random() < 0.6 else f"s{r.randrange(4)}") for i in range(600)]
    return rows + [(900, None, "en", "big"), (901, "", "en", "big"), (902, "one two", None, None), (None, "x y z", "en", "big"), (903, "a b", "zz", "alone"), (5, "p q", "de", "big")]


def test_mixture_fits_every_side(spark):
    rows = _mixed()
    got = mixing.mixture(h.docs(spark, rows)).toPandas()
    assert len(got) == len(rows)
    total = got.n_tokens.sum()
    assert total == sum(len((t or "").split()) for _, t, *_ in rows) and got.weight.sum() == pytest.approx(total)
    for side, power in mixing.TEMPERING.items():
        sums = got.groupby(side)[["n_tokens", "weight"]].sum()
        want = sums.n_tokens**power / (sums.n_tokens**power).sum()
        assert np.abs(sums.weight / total - want).max() < 1e-4
    assert (got.probability * got.n_tokens).sum() / total == pytest.approx(mixing.BUDGET)
    # one constant for all cells that are not taken whole
    part = got[(got.probability < 1) & (got.weight > 0)]
    constant = part.probability * part.n_tokens / part.weight
    assert constant.max() - constant.min() < 1e-9 and 0.35 < got.selected.mean() < 0.65


def test_raking_is_iterative_proportional_fitting(spark):
    r = np.random.default_rng(1)
    table = r.integers(0, 50, (3, 4, 2))
    table[0, 0, 0] = 0
    goals = [dict(zip(n, v)) for n, v in (("abc", (0.2, 0.3, 0.5)), ("klmn", (0.4, 0.3, 0.2, 0.1)), ("xy", (0.5, 0.5)))]
    cells = [(a, b, c, int(table[i, j, k])) for i, a in enumerate("abc") for j, b in enumerate("klmn") for k, c in enumerate("xy")]
    w = table.astype(float)
    for _ in range(200):
        for axis, g in enumerate(goals):
            rest = tuple(i for i in range(3) if i != axis)
            shape = [1, 1, 1]
            shape[axis] = -1
            w *= (np.array(list(g.values())) * table.sum() / w.sum(rest)).reshape(shape)
    got = mixing.rake(spark.createDataFrame(cells, "source string, lang string, topic string, tokens long"), dict(zip(mixing.SIDES, goals))).collect()
    for x in got:
        assert x.weight == pytest.approx(w["abc".index(x.source), "klmn".index(x.lang), "xy".index(x.topic)], rel=1e-5)


CELLS = "source string, lang string, topic string, tokens long"


def test_raking_goes_on_until_it_fits(spark):
    """A table that takes well over a hundred sweeps."""
    cells = [("a", "k", "x", 300), ("a", "l", "x", 1), ("b", "k", "x", 1), ("b", "l", "x", 6)]
    goals = {"source": {"a": 0.5, "b": 0.5}, "lang": {"k": 0.5, "l": 0.5}}
    got = {(r.source, r.lang): r for r in mixing.rake(spark.createDataFrame(cells, CELLS), goals).collect()}
    diagonal = 308 * 0.5 * 1800**0.5 / (1 + 1800**0.5)
    assert got["a", "k"].weight == pytest.approx(diagonal, abs=1e-2) and got["b", "l"].weight == pytest.approx(diagonal, abs=1e-2)
    assert all(r.raking_error <= mixing.TOLERANCE for r in got.values())


def test_raking_without_a_fit_says_so(spark):
    cells = [("a", "k", "x", 30), ("b", "l", "x", 60), ("b", "l", "y", 0)]
    got = mixing.rake(spark.createDataFrame(cells, CELLS), {"source": {"a": 0.7, "b": 0.3}, "lang": {"k": 0.5, "l": 0.5}}).collect()
    assert len(got) == 2 and all(r.raking_error == pytest.approx(0.2) for r in got)
    assert {r.lang: r.weight for r in got} == {"k": pytest.approx(45), "l": pytest.approx(45)}


def test_raking_beyond_one_task(spark):
    r = random.Random(3)
    cells = [(f"h{i}", lang, topic, r.randrange(0, 90)) for i in range(40) for lang in "kl" for topic in "xyz" if r.random() < 0.8]
    key = lambda x: (x.source, x.lang, x.topic)
    one, many = (sorted(mixing.rake(spark.createDataFrame(cells, CELLS), one_task=n).collect(), key=key) for n in (10**6, 0))
    assert [key(x) for x in one] == [key(x) for x in many]
    assert all(x.weight == pytest.approx(y.weight, rel=1e-9) for x, y in zip(one, many)) and many[0].raking_error <= mixing.TOLERANCE


def test_probabilities_meet_the_budget(spark):
    cells = [("a", "x", "t", 10, 40.0), ("b", "x", "t", 100, 70.0), ("c", "x", "t", 30, 30.0), ("d", "x", "t", 5, 0.0)]
    table = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long, weight double")
    for budget in (0.0, 0.05, 0.3, 0.6, 0.9, 1.0):
        p = {r.source: r.probability for r in mixing.probabilities(table, budget).collect()}
        assert sum(p[s] * n for s, _, _, n, _ in cells) == pytest.approx(min(140, budget * 145))
        assert p["a"] >= p["c"] >= p["b"] >= p["d"] == 0 and p["a"] <= 1


def test_mixture_of_nothing(spark):
    assert mixing.mixture(h.docs(spark, [])).collect() == []
    got = mixing.mixture(h.docs(spark, [(1, None), (2, "")])).collect()
    assert [(r.n_tokens, r.weight, r.probability, r.selected) for r in got] == [(0, 0.0, 0.0, False)] * 2
    d = h.docs(spark, _mixed())
    assert mixing.sample_mixture(d, budget=1.0).columns == d.columns
    named = mixing.mixture(h.docs(spark, _mixed()), {"source": {"big": 1.0}, "lang": 1.0, "topic": 1.0}).toPandas()
    assert set(named[named.selected].source) == {"big"}
