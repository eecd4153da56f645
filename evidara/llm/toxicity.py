"""Toxicity of texts: noisy-channel restoration of disguised words, then a lexicon learned from labels.

A disguised word (leetspeak, letters set apart, letters repeated) is read as the output of a
channel.  Each character of it may stand for itself, for the letters it resembles, or for
nothing; the lattice of these readings is searched by Viterbi under a character trigram model
counted over all documents.  Plain and restored readings then meet the lexicon: words and word
beginnings with the share of toxic documents among the labelled documents that hold them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidara.session import cut

#: labelled documents that the lexicon is learned from, at most
MAX_LABELLED = 20_000
#: weight of the prior share of toxic documents, in documents
PRIOR = 10.0
#: a lexicon entry stands in so many toxic documents at least
LEAST_TOXIC = 4
LEAST_SHARE = 0.2
MEMO = 300_000

# What a character may stand for besides itself.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
CLASSES = 28
# channel: a letter stays; a lookalike is read as its letter; a repeat, a separator, a symbol at
# the edge and a lookalike inside the word are left out; a blank is put back
_KEEP, _SWAP, _REPEAT, _SEPARATOR, _EDGE, _INSIDE, _BLANK = (math.log(p) for p in (0.9, 0.3, 0.5, 0.3, 0.1, 0.0005, 0.02))
_RUN = re.compile(r"([^\W\d_])\1\1+")
_LETTERS = re.compile(r"[^\W\d_]+")


def _byte_classes() -> np.ndarray:
    """1-26 letters, 27 letters beyond ASCII, 0 all else."""
    table = np.zeros(256, np.uint8)
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = i + 1
    table[0xC0:] = 27
    return table


def _class(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 if c.isalpha() else 0


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _byte_classes()
    total = np.zeros(CLASSES**3, np.int64)
    for batch in batches:
        for value in batch.column(0):
            data = np.frombuffer(b" " + (value.as_py() or b"") + b" ", np.uint8)
            c = table[data[(data & 0xC0) != 0x80]].astype(np.int32)
            c = c[np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]]
            if len(c) > 2:
                total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
    seen = np.flatnonzero(total)
    yield pa.record_batch({"gram": pa.array(seen, pa.int64()), "n": pa.array(total[seen])})


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) for character classes, counted over every text of ``docs``; the table has
    28**3 entries whatever the corpus."""
    counts = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(_count_trigrams, "gram long, n long")
    n = np.full(CLASSES**3, 0.5)
    for row in counts.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        n[row["gram"]] += row["n"]
    n = n.reshape(CLASSES, CLASSES, CLASSES)
    return np.log(n / n.sum(2, keepdims=True))


class Restorer:
    """Viterbi search for the likeliest plain reading of a disguised word."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()

    @staticmethod
    def lattice(token: str, spaced: bool, whole: bool = False) -> list[list[tuple[str, float]]]:
        """Per character its readings with their channel costs; ``whole``: no lookalike inside is left out."""
        out = []
        for i, c in enumerate(token):
            again = bool(i) and token[i - 1] == c
            if c.isalpha():
                readings = [(c, _KEEP)]
            else:
                edge = i == 0 or not any(x.isalnum() for x in token[i:])
                readings = [(x, _SWAP) for x in LOOKALIKES.get(c, "")]
                if edge and not c.isdigit():
                    readings.append(("", _EDGE))
                elif not readings:
                    readings.append(("", _INSIDE if c.isdigit() else _SEPARATOR))
                elif not whole:
                    readings.append(("", _INSIDE))
            if again:
                readings.append(("", _REPEAT))
            if spaced and i:
                readings += [(" " + x, cost + _BLANK) for x, cost in readings if x]
            out.append(readings)
        return out

    def restore(self, token: str, spaced: bool = False, whole: bool = False) -> str:
        """The reading with the best product of channel and character model; ``spaced``: blanks
        may have stood between the characters of the token; ``whole``: no lookalike inside it is left out."""
        model = self.model
        states = {(0, 0): (0.0, None)}
        for readings in self.lattice(token, spaced, whole):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in states.items():
                for text, cost in readings:
                    x, y, s = a, b, score + cost
                    for c in text:
                        z = _class(c)
                        s += model[x][y][z]
                        x, y = y, z
                    old = after.get((x, y))
                    if old is None or s > old[0]:
                        after[x, y] = (s, (path, text) if text else path)
            states = after
        path = max(((s + model[a][b][0], p) for (a, b), (s, p) in states.items()), key=lambda e: e[0])[1]
        parts = []
        while path is not None:
            path, text = path
            parts.append(text)
        return "".join(reversed(parts)).strip()


def _entries(word: str) -> list[str]:
    """Lexicon keys of a plain word: itself and its beginnings."""
    return ["=" + word] + [word[:n] for n in (4, 5, 6) if len(word) >= n]


class Reader:
    """Lexicon keys of the tokens of a text, restored where they look disguised."""

    def __init__(self, model: np.ndarray):
        self.restorer = Restorer(model)

    def keys(self, token: str) -> list[str]:
        token = token.lower()
        plain = _LETTERS.findall(token)
        out = [e for w in plain if len(w) > 2 for e in _entries(w)]
        core = token.strip(".,;:!?\"'()[]{}%&*#~-_")
        if core and not (core.isalpha() and not _RUN.search(core)) and any(c.isalpha() for c in core):
            # a character repeated many times reads like two of it
            short = re.sub(r"(.)\1{2,}", r"\1\1", core)
            readings = {self.restorer.restore(short)}
            if any(c in LOOKALIKES for c in short[1:-1]):
                readings.add(self.restorer.restore(short, whole=True))
            for w in sorted(readings):
                out += _entries(w) if w else []
        return out

    def spaced_keys(self, letters: list[str]) -> list[str]:
        return [e for w in self.restorer.restore("".join(letters).lower(), True).split() if len(w) > 2 for e in _entries(w)]


def _spaced_runs(tokens: list[str]) -> Iterator[list[str]]:
    """Runs of four or more one-character tokens."""
    run: list[str] = []
    for t in tokens:
        core = t if len(t) == 1 else t.strip(".,;:!?-_*")
        if len(core) == 1:
            run.append(core)
        elif run:
            if len(run) > 3:
                yield run
            run = []
    if len(run) > 3:
        yield run


def _learn(model: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        memo: dict[str, list[str]] = {}
        toxic: dict[str, int] = {}
        clean: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            names = list(toxic.keys() | clean.keys())
            done = pa.record_batch({"entry": pa.array(names, pa.string()), "toxic": pa.array([toxic.get(x, 0) for x in names], pa.int64()),
                                    "clean": pa.array([clean.get(x, 0) for x in names], pa.int64())})
            toxic.clear()
            clean.clear()
            return done

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                tokens = (text.as_py() or "").split()
                seen: set[str] = set()
                for t in set(tokens):
                    got = memo.get(t)
                    if got is None:
                        if len(memo) >= MEMO:
                            memo.clear()
                        got = memo[t] = reader.keys(t)
                    seen.update(got)
                for letters in _spaced_runs(tokens):
                    seen.update(reader.spaced_keys(letters))
                into = toxic if label.as_py() else clean
                for e in seen:
                    into[e] = into.get(e, 0) + 1
            if len(toxic) + len(clean) > MEMO:
                yield flush()
        yield flush()
    return run


def _labelled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, toxic) of at most ``most`` labelled documents, those whose ids have the smallest hashes."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("__toxic"))
    known = cut(known.where(~_held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", F.col("__toxic").alias("toxic"))


class Judge:
    """Score of a text from the three most toxic of its distinct words.

    ``lexicon``: entry to (toxic, clean) documents that hold it.  The share of toxic documents
    is drawn to the general ``share`` by ``PRIOR`` documents; ``weights`` join the log-odds of the
    three shares.
    """

    def __init__(self, model: np.ndarray, lexicon: dict[str, tuple[int, int]], share: float, weights: list[float]):
        self.reader, self.lexicon, self.share, self.weights = Reader(model), lexicon, share, weights
        self.memo: dict[str, tuple[int, int] | None] = {}
        self.floor = math.log(max(share, 1e-3) / 2 / (1 - max(share, 1e-3) / 2))

    def _share(self, counts: tuple[int, int], label: int | None) -> float:
        """A document that is learned from does not count for itself."""
        t, c = counts[0] - (label == 1), counts[1] - (label == 0)
        return (t + PRIOR * self.share) / (t + c + PRIOR)

    def _strongest(self, keys: list[str]) -> tuple[int, int] | None:
        found = [self.lexicon[e] for e in keys if e in self.lexicon]
        return max(found, key=lambda x: self._share(x, None)) if found else None

    def features(self, text: str, label: int | None = None) -> list[float]:
        tokens = text.split()
        memo, found = self.memo, []
        for t in set(tokens):
            if t in memo:
                got = memo[t]
            else:
                if len(memo) >= MEMO:
                    memo.clear()
                got = memo[t] = self._strongest(self.reader.keys(t))
            if got is not None:
                found.append(got)
        for letters in _spaced_runs(tokens):
            got = self._strongest(self.reader.spaced_keys(letters))
            if got is not None:
                found.append(got)
        shares = sorted((self._share(x, label) for x in found), reverse=True)[:3]
        odds = [max(self.floor, math.log(p / (1 - p))) for p in shares]
        return odds + [self.floor] * (3 - len(odds))

    def score(self, text: str) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> list[float]:
    """Weights, the first for the constant, by Newton steps."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    pull = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull, x.T @ (y - p) - pull @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def learn(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> Judge:
    """A judge learned from the character model of all of ``docs`` and from at most ``most``
    labelled documents; documents whose crc32(doc_id) is divisible by 5 are left out."""
    model = character_model(docs)
    texts = _labelled(docs, labels, most)
    counts = texts.mapInArrow(_learn(model), "entry string, toxic long, clean long").groupBy("entry").agg(
        F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    share = texts.agg(F.avg("toxic")).first()[0] or 0.0
    known = counts.where((F.col("t") >= LEAST_TOXIC) & (F.col("t") / (F.col("t") + F.col("c")) >= max(LEAST_SHARE, share))).collect()
    judge = Judge(model, {r["entry"]: (r["t"], r["c"]) for r in known}, float(share), [0.0, 1.0, 0.0, 0.0])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge.features(t.as_py() or "", y.as_py()) for t, y in zip(batch.column(0), batch.column(1))]
            yield pa.record_batch([pa.array([r[i] for r in rows], pa.float64()) for i in range(3)] + [batch.column(1)], names=["a", "b", "c", "toxic"])

    rows = texts.mapInArrow(features, "a double, b double, c double, toxic int").toPandas()
    if len(rows) and 0 < rows["toxic"].clip(0, 1).mean() < 1:
        judge.weights = fit_logistic(rows[["a", "b", "c"]].to_numpy(), rows["toxic"].clip(0, 1).to_numpy(float))
    return judge


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs`` (doc_id, text).

    ``score`` joins the lexicon shares of the three most toxic words of the text; ``predicted`` is
    1 from 0.5.  ``labels`` (doc_id, toxic): rows with a
    null are left out, of several labels of one document the largest counts; documents whose
    crc32(doc_id as text) is divisible by 5 are held out of learning.  Null and empty texts get
    the score of a text without known words.  Without labels no word is known. Rows without
    doc_id are scored, not learned from, and not held out.  Further columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    judge = learn(docs, labels, most)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"doc_id": batch.column(0), "score": pa.array([judge.score(t.as_py() or "") for t in batch.column(1)], pa.float64())})

    scored = docs.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """``docs`` (all its columns) without the rows whose text is predicted toxic."""
    judge = learn(docs, labels, most)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([judge.score(t.as_py() or "") < 0.5 for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
