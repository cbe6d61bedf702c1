"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  An n-gram is the product of its letters'
vectors, each rotated by its place; a text is the sum of its n-grams; a language's
prototype is the sum of its training texts, each at unit length.  A text belongs to the
language whose prototype has the largest cosine.

Null texts and texts without letters are ``und`` with score 0.  Empty tables give empty
results; with no training rows every text is ``und``.  Texts are read whole, in pieces,
so their length doesn't matter.  Ties go to the alphabetically first language.  A column
with the name asked for the result is replaced.  Prototypes take one vector for each
distinct language of the training rows, which the driver holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import BLOCK_CHARS, blocks, code_points

DIMENSIONS = 4096
# Cosines of unrelated texts scatter around zero by one over the root of the dimensions.
# From five times that a text is like its language rather than like none.
LEAST_SCORE = 5 / DIMENSIONS**0.5
UNDETERMINED = "und"
SPACE = 32
DENSE = 1 << 22  # n-gram codes up to which a table is used instead of sorting
SCALE = 1_000_000  # unit vectors are summed as whole numbers, in any order alike

_letters: dict[int, np.ndarray] = {}
_is_letter: list[np.ndarray] = []


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """A row of +1 and -1 for each code point, the same in every process."""
    for point in points:
        if int(point) not in _letters:
            bits = np.random.Generator(np.random.PCG64([7919, int(point)])).integers(0, 2, DIMENSIONS, np.int8)
            _letters[int(point)] = bits * 2 - 1
    return np.stack([_letters[int(p)] for p in points])


def letters() -> np.ndarray:
    if not _is_letter:
        _is_letter.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _is_letter[0]


def _count(codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes and, for each code, its place among them."""
    if limit > DENSE:
        return np.unique(codes, return_inverse=True)
    seen = np.zeros(limit, bool)
    seen[codes] = True
    distinct = np.flatnonzero(seen)
    place = np.zeros(limit, np.int32)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[codes]


def bundles(texts: list[str]) -> np.ndarray:
    """The sum of the trigram vectors of each text; zeros without letters."""
    points, lengths = code_points([f" {t.lower()} " for t in texts])
    owner = np.repeat(np.arange(len(texts)), lengths)
    points = np.where(letters()[points], points, SPACE)
    gap = points == SPACE
    keep = np.ones(len(points), bool)
    keep[1:] = ~(gap[1:] & gap[:-1] & (owner[1:] == owner[:-1]))
    points, owner = points[keep], owner[keep]
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    if len(points) < 3:
        return out
    alphabet, symbol = _count(points.astype(np.int64), 0x110000)
    base = len(alphabet)
    symbol = symbol.astype(np.int64)
    code = (symbol[:-2] * base + symbol[1:-1]) * base + symbol[2:]
    inside = owner[:-2] == owner[2:]
    code, owner = code[inside], owner[:-2][inside]
    if not len(code):
        return out
    grams, place = _count(code, base**3)
    vectors = letter_vectors(alphabet)
    first, second = np.roll(vectors, 2, axis=1), np.roll(vectors, 1, axis=1)
    for start in range(0, len(grams), 4096):  # n-gram vectors of a part of the grams at a time
        part = grams[start : start + 4096]
        bound = first[part // base**2] * second[part // base % base] * vectors[part % base]
        mine = (place >= start) & (place < start + len(part))
        counts = np.bincount(owner[mine] * len(part) + place[mine] - start, minlength=len(texts) * len(part))
        out += counts.reshape(len(texts), len(part)).astype(np.float32) @ bound.astype(np.float32)
    return out


def encoded(texts: list[str]) -> np.ndarray:
    """Unit vectors of the texts; long ones are bundled piece by piece."""
    pieces: list[str] = []
    owners: list[int] = []
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for i, text in enumerate(texts):
        # Neighbouring pieces share two characters, so that no trigram is lost.
        for start in range(0, max(1, len(text) - 2), BLOCK_CHARS):
            pieces.append(text[start : start + BLOCK_CHARS + 2])
            owners.append(i)
    done = 0
    for block in blocks(pieces):
        np.add.at(out, owners[done : done + len(block)], bundles(block))
        done += len(block)
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(norms, 1e-9)


def _text_blocks(batches, column: int = 0) -> Iterator[list[str]]:
    for batch in batches:
        array = batch if isinstance(batch, pa.Array) else batch.column(column)
        for start in range(0, len(array), 512):
            yield array.slice(start, 512).to_pylist()


def fit(training: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Prototype per language, from all rows with a language and a text.

    Tasks send one vector per language; what the driver gets is bounded by the number
    of languages."""

    def sums(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                names = np.array(part.column(1).to_pylist(), dtype=object)
                vectors = np.rint(encoded([t or "" for t in part.column(0).to_pylist()]) * SCALE).astype(np.int64)
                for name in set(names):
                    totals[name] = totals.get(name, 0) + vectors[names == name].sum(axis=0)
        for name, vector in totals.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "name": pa.array([name] * DIMENSIONS, pa.string()),
                    "place": pa.array(range(DIMENSIONS), pa.int32()),
                    "value": pa.array(vector, pa.int64()),
                }
            )

    rows = (
        training.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
        .where("text IS NOT NULL AND lang IS NOT NULL")
        .mapInArrow(sums, "name string, place int, value bigint")
        .groupBy("name", "place")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    out: dict[str, np.ndarray] = {}
    for row in rows:
        out.setdefault(row.name, np.zeros(DIMENSIONS))[row.place] = row.value
    return {k: v / max(np.linalg.norm(v), 1e-9) for k, v in sorted(out.items())}


def identify(df: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", to: str = "language") -> DataFrame:
    """``df`` with a struct column ``to``: lang_pred and score, the cosine between 0 and 1."""
    names = np.array(sorted(prototypes), dtype=object)
    profiles = np.stack([prototypes[n] for n in names]).astype(np.float32) if len(names) else None

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def classify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in batches:
            langs, scores = [], []
            for texts in _text_blocks([array]):
                vectors = encoded([t or "" for t in texts])
                known = vectors.any(axis=1)
                if profiles is None:
                    langs += [UNDETERMINED] * len(texts)
                    scores += [0.0] * len(texts)
                    continue
                cosine = vectors @ profiles.T
                best = cosine.argmax(axis=1)
                langs += np.where(known, names[best], UNDETERMINED).tolist()
                scores += np.where(known, np.clip(cosine.max(axis=1), 0, 1), 0).astype(float).tolist()
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
            )

    return df.withColumn(to, classify(F.col(text)))
