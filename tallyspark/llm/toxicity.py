"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

1. ``character_model`` counts character trigrams over all documents (one row per
   trigram of a fixed alphabet reaches the driver).
2. ``Restorer`` finds disguised spans (digits or symbols inside words, letters
   and symbols spelled with separators, doubled and repeated letters), builds the
   lattice of letters each may stand for, and takes the Viterbi path under the
   character model.  Where a span is ambiguous (a letter truly double, a sign that
   is punctuation, an e-mail address) the other readings are scored as well.
3. ``fit`` learns weights of words and word beginnings from labelled documents, as
   a lower bound of their log odds, and a logistic score over a document's
   strongest words.  It uses at most ``most_labelled`` labelled documents (those
   with the smallest id hash; one row per id, distinct texts), whose words are restored once and stored.
4. ``scored`` reads every whole text.

Defined cases: null and empty texts have no words and get the score of a text
without evidence; rows keep their other columns; without usable labels every
score is 0; null labels are skipped; null ids are never training rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, texts, written

MOST_LABELLED = 20_000
LEAST_TOXIC = 3  # documents that a feature must be in
PREFIXES = (4, 5, 6)
STRONGEST = 3
STRONG = 3.0
REJECT_AT = 0.7
#: Words and spans whose result a worker remembers, at most.
REMEMBERED = 20_000
WEAK_REMEMBERED = 100_000  # words without weight: only the words themselves
#: Characters whose trigrams are counted at a time (a longer text is taken in pieces of so many).
COUNTED = 500_000
#: Features whose numbers a worker holds before it hands them on.
COUNTED_FEATURES = 50_000

# Alphabet of the character model: 0 is any boundary, then a to z, then U+00DF to U+00FF, then other letters.
_SIZE = 64
_OTHER = 63
_codes = np.zeros(0x250, "i4")
_codes[97:123] = np.arange(1, 27)
_codes[65:91] = np.arange(1, 27)
_codes[0xDF:0x100] = np.arange(27, 27 + 33)
_codes[0xC0:0xDF] = np.arange(28, 28 + 31)
_codes[0x100:0x250] = _OTHER
_codes[[0xD7, 0xF7]] = 0

# Letters that a digit or symbol may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l"}
_SUBSTITUTED = -1.0  # log cost of writing a letter as one of these
_REPEATED = -0.5  # of writing a letter more than once
_SIGN = re.compile("[0-9@$!|+(€£]")
_EMAIL = r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+(?:[a-z]{2,}|[A-Z]{2,})(?![\w@])"
_MIXED = re.compile(r"(?<![\w@$!|+(€£.])(?!" + _EMAIL + r")(?=[^\s]{0,40}[^\W\d_])[^\W_]*"
                    r"(?:(?:[0-9@$!|+(€£][0-9@$!|+(€£]?|[@$!|€£]{3})[^\W\d_]+)+"
                    r"(?:[0-9@$!|€£]{1,2}(?![\w@$!|€£]))?")
_TAIL = re.compile(r"(?<![\w@$!|])(?:[^\W\d_]{2,}[0-9@$!|€£]{1,2}|(?:[^\W\d_]|@)[0-9@$!|€£]{2})"
                   r"(?![\w@$!|€£]|\.\w)")
_SPACED = re.compile(r"(?<!\w)(?:[\w@$!|+(€£](?<!_)[ .\-_*]{1,2}){2,}[\w@$!|+(€£](?<!_)(?!\w)")
_BETWEEN = re.compile(r"[ .\-_*]")
#: Signs that are punctuation in plain text: what they part is read on its own as well.
_PARTING = re.compile(r"[!|+(]")
_DOMAIN = re.compile(r"@[^\W_]+(?=[.-])")
_LOCAL = re.compile(r"[^\W_]{1,64}$")
_DOUBLED = re.compile(r"([^\W\d_])\1")
_RUN = re.compile(r"(.)\1+")
_WORD = re.compile(r"[^\W\d_]+")


def _coded(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _codes[np.minimum(raw, 0x24F)]


def _pieces(texts):
    """The texts with boundaries around each, joined to pieces of about ``COUNTED`` characters.

    A long text's pieces share two characters, so each of its trigrams is in one of them.
    """
    held, size = [], 0
    for text in texts:
        for a in range(0, max(1, len(text)), COUNTED):
            if size + min(len(text) - a, COUNTED) > COUNTED and held:
                yield " ".join(held) + "  "
                held, size = [], 0
            held.append(" " + text if a == 0 else text[max(0, a - 2):a + COUNTED])
            if a == 0 and len(text) > COUNTED:
                held[-1] = " " + text[:COUNTED]
            if a + COUNTED < len(text):  # broken off: no boundary after it
                yield " ".join(held)
                held, size = [], 0
            else:
                size += len(held[-1])
    if held:
        yield " ".join(held) + "  "


def character_model(docs: DataFrame) -> np.ndarray:
    """``log p(c | a, b)`` over the alphabet, from the trigrams of every document (column ``text``)."""

    def count(frames):
        total = np.zeros(_SIZE ** 3, "i8")
        for frame in frames:
            for piece in _pieces(frame["text"]):
                c = _coded(piece)
                c = c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))]
                if len(c) > 2:
                    total += np.bincount(c[:-2] * _SIZE ** 2 + c[1:-1] * _SIZE + c[2:], minlength=_SIZE ** 3)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"code": at, "n": total[at]})
        give_back()

    rows = (docs.select("text").mapInPandas(count, "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")).toPandas())  # at most 64^3 rows
    n = np.zeros(_SIZE ** 3)
    n[rows["code"].to_numpy("i8")] = rows["n"].to_numpy("f8")
    tri = n.reshape(_SIZE, _SIZE, _SIZE)
    bi, uni = tri.sum(0), tri.sum((0, 1))
    p1 = (uni + 1) / (uni.sum() + _SIZE)
    p2 = (bi + 5 * p1) / (bi.sum(1, keepdims=True) + 5)
    return np.log((tri + 5 * p2[None]) / (tri.sum(2, keepdims=True) + 5)).astype("f4")


class Restorer:
    """Replaces disguised spans by their most likely spelling."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.known: dict[str, tuple[str, ...]] = {}

    def decode(self, span: str) -> str:
        """The most likely spelling."""
        return self.readings(span)[0]

    def readings(self, span: str) -> tuple[str, ...]:
        """The most likely spelling; then that with double letters kept, and those of the parts between signs."""
        if span in self.known:
            return self.known[span]
        plain = _BETWEEN.sub("", span.lower())
        found = [self._path(plain)]
        if found[0] != plain and any(n > 1 for _, n in _runs(plain)):
            found.append(self._path(plain, double=True))
        parts = _PARTING.split(plain)
        if len(parts) > 1:
            found += [self._path(x) for x in parts if len(x) > 2]
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[span] = out = tuple(dict.fromkeys(found))
        return out

    def _path(self, plain: str, double: bool = False) -> str:
        """Viterbi over the lattice of ``plain``; states are the last two letters.  ``double``: runs are two letters."""
        best = {(0, 0): (0.0, None)}  # score, and the path as (path before, letters)
        for ch, n in _runs(plain):
            options = []
            for letter in (LEET[ch] if ch in LEET else ch):
                cost = _SUBSTITUTED if ch in LEET else 0.0
                if n == 1 or not double:
                    options.append((letter, cost + (_REPEATED if n > 1 else 0.0)))
                if n > 1:
                    options.append((letter * 2, cost + (_REPEATED if n > 2 else 0.0)))
            if not options:
                continue
            if len(options) == 1 and len(best) == 1:  # nothing to choose: one score for all paths
                ((a, b), (score, out)), = best.items()
                for c in options[0][0]:
                    a, b = b, int(_codes[min(ord(c), 0x24F)])
                best = {(a, b): (score, (out, options[0][0]))}
                continue
            step: dict = {}
            for (a, b), (score, out) in best.items():
                for letters, cost in options:
                    s, x, y = score + cost, a, b
                    for c in letters:
                        code = int(_codes[min(ord(c), 0x24F)])
                        s += float(self.model[x, y, code])
                        x, y = y, code
                    if (x, y) not in step or s > step[x, y][0]:
                        step[x, y] = (s, (out, letters))
            best = step
        path = max(((s + float(self.model[a, b, 0]), (a, b), out) for (a, b), (s, out) in best.items()),
                   key=lambda x: x[:2])[2]
        letters = []
        while path:
            path, own = path
            letters.append(own)
        return "".join(reversed(letters))

    def _spans(self, text: str, others: list[str]) -> str:
        """``text`` with its disguised spans decoded; further readings go to ``others``."""

        def read(m):
            best, *more = self.readings(m.group(0))
            others.extend(more)
            return best

        def spaced(m):
            few = len(_BETWEEN.sub("", m.group(0))) < 4
            return m.group(0) if few and not _WORD.search(m.group(0)) else read(m)  # not "1 - 2"

        text = _SPACED.sub(spaced, text)
        if _SIGN.search(text):
            for m in _DOMAIN.finditer(text):  # an address stays, "x@yz" is read as well
                local = _LOCAL.search(text[max(0, m.start() - 64):m.start()])
                if local:
                    others.extend(self.readings(local.group(0) + m.group(0)))
            text = _MIXED.sub(read, text)
            text = _TAIL.sub(read, text)
        return text

    def restore(self, text: str) -> str:
        """``text`` with each disguised span and each word of repeated letters in its most likely spelling."""

        def shorter(m):
            best = self.decode(m.group(0)) if _DOUBLED.search(m.group(0)) else m.group(0)
            return m.group(0) if best == m.group(0).lower() else best

        return _WORD.sub(shorter, self._spans(text, []))

    def words(self, text: str) -> set[str]:
        """The distinct words of the restored text, in lower case, with their other readings."""
        others: list[str] = []
        found = set(_WORD.findall(self._spans(text, others).lower()))
        return found.union(*map(_WORD.findall, others))

    def spellings(self, word: str) -> set[str]:
        """A word, and what its repeated letters may stand for."""
        return {word, *self.readings(word)} if _DOUBLED.search(word) else {word}


def _runs(s: str):
    at = 0
    while at < len(s):
        end = at + 1
        while end < len(s) and s[end] == s[at]:
            end += 1
        yield s[at], end - at
        at = end


def features_of(words: set[str]) -> set[str]:
    """The words and their beginnings."""
    return words | {word[:n] + "*" for word in words for n in PREFIXES if len(word) >= n}


@dataclass
class ToxicityModel:
    letters: np.ndarray
    weights: dict[str, float]
    coef: np.ndarray = field(default_factory=lambda: np.zeros(STRONGEST + 2))
    usable: bool = True


def _collapsed(word: str) -> str:
    return _RUN.sub(r"\1", word)


class Scorer:
    """Scores texts with a model; lives in a worker for the length of a task."""

    def __init__(self, model: ToxicityModel):
        self.model, self.restorer = model, Restorer(model.letters)
        self.weak: set[str] = set()  # words without weight
        self.strong: dict[str, float] = {}
        # a word can only be read as one of weight if they agree with each run of letters taken once
        self.whole = {_collapsed(f) for f in model.weights if f[-1] != "*"}
        self.begun = {_collapsed(f[:-1]) for f in model.weights if f[-1] == "*"}

    def weight(self, word: str) -> float:
        """The largest weight of the features of a word's spellings."""
        weights = self.model.weights
        w = max(weights.get(word, 0.0), *[weights.get(word[:n] + "*", 0.0) for n in PREFIXES if len(word) >= n], 0.0)
        if _DOUBLED.search(word):
            short = _collapsed(word)
            if short in self.whole or any(short[:n] in self.begun for n in range(1, PREFIXES[-1] + 1)):
                w = max([weights.get(f, 0.0) for f in features_of(self.restorer.spellings(word))] + [w])
        return w

    def evidence_of(self, words: set[str]) -> list[float]:
        """The weights of the strongest words, and the log of the number of strong ones."""
        if len(self.weak) > WEAK_REMEMBERED:
            self.weak.clear()
        if len(self.strong) > REMEMBERED:
            self.strong.clear()
        strong = []
        for word in words - self.weak:
            w = self.strong.get(word)
            if w is None:
                w = self.weight(word)
                if w <= 0:
                    self.weak.add(word)
                    continue
                self.strong[word] = w
            strong.append(w)
        strong.sort(reverse=True)
        top = (strong + [0.0] * STRONGEST)[:STRONGEST]
        return [*top, math.log1p(sum(w >= STRONG for w in strong))]

    def evidence(self, text: str) -> list[float]:
        return self.evidence_of(self.restorer.words(text))

    def score(self, text: str) -> float:
        if not self.model.usable:
            return 0.0
        x = np.array([*self.evidence(text), 1.0])
        return float(1 / (1 + math.exp(-float(np.clip(x @ self.model.coef, -30, 30)))))


def _weights(counts: pd.DataFrame, totals: dict, part: int | None) -> dict[str, float]:
    """Lower bound of the log odds of each feature, from the counts of both halves (or without half ``part``)."""
    used = [h for h in (0, 1) if h != part]
    t, n = sum(counts[f"t{h}"] for h in used), sum(counts[f"n{h}"] for h in used)
    t_all, n_all = totals["toxic"], totals["n"] - totals["toxic"]
    if part is not None:
        t_all, n_all = t_all / 2, n_all / 2
    c = n - t
    odds = np.log((t + 0.5) / (t_all + 1) / ((c + 0.5) / (n_all + 1)))
    bound = np.round(odds - 1.64 * np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5)), 4)
    good = (t >= LEAST_TOXIC) & (bound > 0.5)
    return dict(zip(counts["feature"][good].tolist(), bound[good].tolist()))


def _feature_counts(words: DataFrame, letters: np.ndarray) -> pd.DataFrame:
    """For each feature that enough toxic documents have: toxic ones and all, in either half.

    ``words`` holds at most ``most_labelled`` documents; of their features those of at least ``LEAST_TOXIC``
    toxic documents reach the driver.
    """

    names = ["t0", "n0", "t1", "n1"]

    def rows(found):
        return pd.DataFrame([(f, *n) for f, n in found.items()], columns=["feature", *names])

    def count(frames):
        restorer = Restorer(letters)
        found: dict[str, list[int]] = {}
        for frame in frames:
            for own, label, half in zip(frame["words"], frame["toxic"], frame["half"]):
                for f in features_of(set().union(*map(restorer.spellings, own))):
                    n = found.get(f)
                    if n is None:
                        n = found[f] = [0, 0, 0, 0]
                    n[2 * half] += label
                    n[2 * half + 1] += 1
                if len(found) > COUNTED_FEATURES:
                    yield rows(found)
                    found.clear()
        if found:
            yield rows(found)
        give_back()

    return (words.mapInPandas(count, "feature string, t0 long, n0 long, t1 long, n1 long")
            .groupBy("feature").agg(*[F.sum(c).alias(c) for c in names])
            .where(F.col("t0") + F.col("t1") >= LEAST_TOXIC).toPandas())


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most_labelled: int = MOST_LABELLED,
        id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """The model from ``docs`` (all count for the character model) and ``labels`` (id, 0 or 1)."""
    spark = docs.sparkSession
    t = texts(docs, id_col, text_col)
    letters = character_model(t)
    ids = (labels.select(labels[id_col].cast("long").alias("l_id"), labels[label].cast("int").alias("toxic"))
           .where("l_id is not null and toxic in (0, 1)").groupBy("l_id").agg(F.max("toxic").alias("toxic"))
           .orderBy(F.xxhash64("l_id"), "l_id").limit(most_labelled))
    sample = (t.join(F.broadcast(ids), t["doc_id"] == ids["l_id"])  # bounded by most_labelled
              .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
              .groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
              .select("text", "toxic", F.pmod("h", F.lit(2)).cast("int").alias("half")))

    def restored(frames):
        restorer = Restorer(letters)
        for frame in frames:
            yield pd.DataFrame({"toxic": frame["toxic"], "half": frame["half"],
                                "words": [sorted(restorer.words(t)) for t in frame["text"]]})
        give_back()

    words = written(sample.mapInPandas(restored, "toxic int, half int, words array<string>"), "toxicity-words")
    totals = words.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first().asDict()
    if not 0 < totals["toxic"] < totals["n"]:
        return ToxicityModel(letters, {}, usable=False)
    counts = _feature_counts(words, letters)
    # each half is judged by what the other one taught
    held = spark.sparkContext.broadcast([ToxicityModel(letters, _weights(counts, totals, half)) for half in (0, 1)])

    def judge(frames):
        scorers = [Scorer(m) for m in held.value]
        for frame in frames:
            x = [scorers[half].evidence_of(set(own)) for half, own in zip(frame["half"], frame["words"])]
            yield pd.DataFrame({"x": x, "y": frame["toxic"]})
        give_back()

    rows = words.mapInPandas(judge, "x array<double>, y int").collect()  # at most most_labelled rows of a few numbers
    x = np.array([[*r["x"], 1.0] for r in rows])
    return ToxicityModel(letters, _weights(counts, totals, None), logistic(x, np.array([r["y"] for r in rows], "f8")))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column is the constant."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        penalty = ridge * len(y) / 100 * np.eye(len(w))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return np.round(w, 6)


def score_column(spark, model: ToxicityModel, text: Column) -> Column:
    """The toxicity score of a text column."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(held.value)
        for batch in batches:
            yield pd.Series([scorer.score(t) for t in batch], dtype="f8")
        give_back()

    return toxicity(F.coalesce(text.cast("string"), F.lit("")))
