"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel of two words counts the letter triples they share, in order but not
necessarily next to each other, each weighted by ``DECAY`` to the power of the length it
spans; so inserted characters and gaps lower the similarity of an insult but don't hide
it.  Landmark words stand for the kernel's feature space (Nystroem): a text's features are
its best normalised kernel value with each landmark, over all its words.  Marks inside a
word are left out, and words of single characters in a row are read as one word.  A linear support vector machine is trained on
the whitened features of labelled texts, and its margin is mapped to 0..1.

Landmarks and the machine come from at most ``SAMPLE`` labelled texts, chosen by a hash of
their ids and read whole.

Null and empty texts have all features 0 and the score that belongs to them; without
labels of both kinds every score is the share of toxic labels, or 0.  Texts are read
whole.  Repeated rows are scored one by one.  A text's features are its best values, so
the more words a text has, the likelier one of them resembles an insult by chance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import blocks, code_points

SAMPLE = 6000  # labelled texts that the machine is trained on, at most
LANDMARKS = 48
SPAN = 7  # characters that a triple may span
DECAY = 0.85
FLOOR = 0.35  # share of a landmark's own kernel below which a word counts as unlike it
NEAR, FULL = 0.35, 0.65  # kernel values that count as unlike a landmark, and as that word
CODES = 64  # distinct characters; others share the last code
SINGLES = re.compile(r"(?<!\S)\S(?:[ .\-_*]\S){2,}(?!\S)")
MIN_TEXTS = 8  # texts that a landmark word must occur in

_CODE = np.zeros(0x110000, np.uint8)
_CODE[np.arange(128, 0x110000)] = CODES - 1
for _k, _c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789@$!*#%&+-_'"):
    _CODE[ord(_c)] = _k + 1
for _k, _c in enumerate("àâäáéèêëíîïñóöôúùüûçß"):
    _CODE[ord(_c)] = 27 + _k % 36
_OFFSETS = [(d1, d2) for d1 in range(1, SPAN - 1) for d2 in range(1, SPAN - d1)]


# Digits and signs written for letters.
LOOKALIKES = str.maketrans("0134578@$", "oieastbas")


def cleaned(word: str) -> str:
    """A word without marks inside it and with letters for their look-alikes."""
    if word.isalpha():
        return word
    kept = "".join(c for c in word if c.isalnum())
    return kept.translate(LOOKALIKES) if any(c.isalpha() for c in kept) else kept


def words_of(text: str) -> list[str]:
    """Lower-case words without the marks at their ends."""
    text = text.lower()
    if SINGLES.search(text):
        text = SINGLES.sub(lambda m: re.sub(r"[ .\-_*]", "", m[0]), text)
    return text.replace(".", " ").replace(",", " ").split()


def _triples(words: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, code and weight of every triple, only of the ``wanted`` codes if given."""
    points, lengths = code_points(words)
    codes = _CODE[points].astype(np.int32)
    end = np.repeat(np.cumsum(lengths), lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(codes))
    parts = []
    for d1, d2 in _OFFSETS:
        n = len(codes) - d1 - d2
        if n <= 0:
            continue
        triple = (codes[:n] * CODES + codes[d1 : n + d1]) * CODES + codes[d1 + d2 :]
        keep = place[:n] + d1 + d2 < end[:n]
        if wanted is not None:
            keep &= wanted[triple]
        at = np.flatnonzero(keep)
        parts.append((owner[at], triple[at], np.full(len(at), DECAY ** (d1 + d2 + 1))))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _own_kernel(words: list[str]) -> np.ndarray:
    """The kernel of each word with itself."""
    owner, code, weight = _triples(words)
    key, place = np.unique(owner.astype(np.int64) * CODES**3 + code, return_inverse=True)
    mass = np.bincount(place, weight, len(key))
    return np.bincount(key // CODES**3, mass**2, len(words))


class Kernel:
    """Normalised kernel values of words with the landmarks."""

    def __init__(self, landmarks: list[str]) -> None:
        self.landmarks = landmarks
        owner, code, weight = _triples(landmarks)
        self.wanted = np.zeros(CODES**3, bool)
        self.wanted[code] = True
        self.place = np.cumsum(self.wanted) - 1
        self.table = np.zeros((int(self.wanted.sum()), len(landmarks)), np.float32)
        np.add.at(self.table, (self.place[code], owner), weight)
        self.own = np.maximum((self.table**2).sum(axis=0), 1e-9)

    def values(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the words like some landmark, and their normalised kernel values."""
        owner, code, weight = _triples(words, self.wanted)
        if not len(owner):
            return np.zeros(0, np.int64), np.zeros((0, len(self.landmarks)), np.float32)
        # A bound first: all the weight of a word's known triples.
        order = np.argsort(owner, kind="stable")
        owner, code, weight = owner[order], code[order], weight[order]
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        raw = np.add.reduceat(self.table[self.place[code]] * weight[:, None].astype(np.float32), starts, axis=0)
        like = (raw >= FLOOR * self.own).any(axis=1)
        names = owner[starts][like]
        raw = raw[like]
        own = _own_kernel([words[i] for i in names]) if len(names) else np.zeros(0)
        return names, raw / np.sqrt(np.outer(np.maximum(own, 1e-9), self.own)).astype(np.float32)

    def features(self, texts: list[str]) -> np.ndarray:
        """The best value with each landmark over the words of each text."""
        parts = [words_of(t) for t in texts]
        distinct = list(set().union(*parts))
        names, values = self.values([cleaned(w) for w in distinct])
        values = np.clip((values - NEAR) / (FULL - NEAR), 0, 1)
        known = {distinct[i]: k for k, i in enumerate(names.tolist())}
        out = np.zeros((len(texts), len(self.landmarks)), np.float32)
        for i, part in enumerate(parts):
            if found := known.keys() & set(part):
                out[i] = values[[known[w] for w in found]].max(axis=0)
        return out


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray  # of the features; the whitening is folded in
    bias: float
    scale: float
    shift: float
    share: float  # of toxic labels

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.landmarks:
            return np.full(len(features), self.share)
        margin = features @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.scale * margin + self.shift, -30, 30)))


def choose_landmarks(texts: list[str], toxic: np.ndarray) -> list[str]:
    """Words that occur in many toxic texts and few others, and as many plain ones."""
    counts: dict[str, list[int]] = {}
    for text, label in zip(texts, toxic.astype(int).tolist()):
        for word in set(map(cleaned, words_of(text))):
            counts.setdefault(word, [0, 0])[label] += 1
    totals = np.bincount(toxic.astype(int), minlength=2)
    least = max(2, min(MIN_TEXTS, totals[1] // 20))
    rated = []
    for word, (clean, bad) in counts.items():
        if bad >= least and len(word) >= 3:
            rated.append((bad * np.log((bad + 0.5) / (totals[1] + 1) / ((clean + 0.5) / (totals[0] + 1))), word))
    rated.sort(key=lambda x: (-x[0], x[1]))
    bad_words = [w for r, w in rated[: 2 * LANDMARKS // 3] if r > 0]
    plain = sorted(((c, w) for w, (c, b) in counts.items() if len(w) >= 3 and w not in bad_words), reverse=True)
    return bad_words + [w for _, w in plain[: LANDMARKS - len(bad_words)]]


def train(texts: list[str], toxic: np.ndarray) -> Model:
    """Landmarks, support vector machine and calibration from labelled texts."""
    share = float(toxic.mean()) if len(toxic) else 0.0
    none = Model([], np.zeros(0), 0.0, 1.0, 0.0, share)
    if not 0 < share < 1:
        return none
    landmarks = choose_landmarks(texts, toxic)
    if not landmarks:
        return none
    kernel = Kernel(landmarks)
    x = np.concatenate([kernel.features(b) for b in blocks(texts)]).astype(float)
    gram = (kernel.table.T @ kernel.table) / np.sqrt(np.outer(kernel.own, kernel.own))
    size, axes = np.linalg.eigh(gram + 1e-3 * np.eye(len(landmarks)))
    whiten = axes / np.sqrt(np.maximum(size, 1e-3)) @ axes.T
    z = x @ whiten
    y = np.where(toxic, 1.0, -1.0)
    weight = np.where(toxic, 0.5 / share, 0.5 / (1 - share))
    w, b = _machine(z, y, weight)
    margin = z @ w + b
    scale, shift = _calibrated(margin, toxic.astype(float))
    return Model(landmarks, whiten @ w, b, scale, shift, share)


def _machine(z: np.ndarray, y: np.ndarray, weight: np.ndarray, strength: float = 1e-3) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps on the active rows."""
    rows = np.hstack([z, np.ones((len(z), 1))])
    penalty = strength * np.eye(rows.shape[1])
    penalty[-1, -1] = 1e-9
    w = np.zeros(rows.shape[1])
    for _ in range(30):
        active = y * (rows @ w) < 1
        a, c = rows[active], weight[active] / len(y)
        new = np.linalg.solve(penalty + (a * c[:, None]).T @ a, (a * c[:, None]).T @ y[active])
        if np.abs(new - w).max() < 1e-8:
            break
        w = new
    return w[:-1], float(w[-1])


def _calibrated(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve from margins to labels, by Newton steps."""
    rows = np.stack([margin, np.ones_like(margin)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, rows.T @ (p - label) + 1e-3 * w)
        w = w - np.clip(step, -5, 5)
    return float(max(w[0], 1e-6)), float(w[1])


def fit(texts: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """A model from at most SAMPLE labelled texts, the ones with the smallest hashes."""
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(toxic).cast("int").alias("toxic")).where(
        "doc_id IS NOT NULL AND toxic IS NOT NULL"
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(SAMPLE)
    rows = (
        texts.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .where("text IS NOT NULL")
        .join(F.broadcast(chosen), "doc_id")  # at most SAMPLE ids
        .sort("doc_id", F.xxhash64("text"))
        .limit(SAMPLE)
        .toArrow()
    )
    return train(rows["text"].to_pylist(), np.array(rows["toxic"].to_pylist(), int) == 1)


def score(df: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """``df`` with the score of each text, from 0 to 1; a column named ``to`` is replaced."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kernel = Kernel(model.landmarks) if model.landmarks else None
        for array in batches:
            out: list[np.ndarray] = [np.zeros(0)]
            for texts in blocks(x.as_py() for x in array):
                features = kernel.features(texts) if kernel else np.zeros((len(texts), 0))
                out.append(model.scores(features))
            yield pa.array(np.concatenate(out), pa.float64())

    return df.withColumn(to, scored(F.col(text)))
