"""Benchmark decontamination by a BM25 index of the test items.

Items are cut into segments of at most ``HALF`` words, which an inverted index holds.
Every passage of every training text, 2 * HALF words at steps of HALF, is a query.  A
segment's score is the share of its own BM25 mass that the passage's words reach.  All
segments from ``THRESHOLD`` are retrieved by block-max WAND.  Each segment has key words:
its rare ones and, where what is left could reach the threshold, its next rarest until it
can't.  A passage is only walked if the key words it holds, with all the other words of
their segment, can lift the segment to the threshold, which is an exact bound.
A retrieved item is a leak if its question and its answer are both found near the passage.

The index holds each distinct item text once, with all its ids.  It is split into parts of
at most ``PART_WORDS`` item words, weighted by the words of all parts; texts are run against
each part, so a broadcast part has a fixed size bound.

Null and empty texts, and items without words, leak nothing.  Repeated documents each
give their own rows; repeated items are found each by its own id.  A document and item
meet in one row however many passages show them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HALF = 64
THRESHOLD = 0.6
OVERLAP = 0.6  # share of the word triples of a question, or of an answer, to be found
PART_WORDS = 2_000_000
BLOCK_HITS = 500_000  # postings of key words gathered at once
BLOCK = 32  # segments whose largest impact is kept together
K1, B = 1.2, 0.75
RARE_SHARE = 0.02  # words in at most this share of the segments are looked up first


def words_of(text: str | None) -> list[str]:
    """Lower-case words without full stops and commas around and between them."""
    if not text:
        return []
    text = text.lower().replace(".", " ").replace(",", " ")
    return text.split()


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The answer is what follows the last question mark, else the last line, else the
    last sentence; without any of them all is question."""
    text = text.strip()
    for mark in ("?", "\n", ". "):
        head, found, tail = text.rpartition(mark)
        if found and words_of(head) and words_of(tail):
            return words_of(head), words_of(tail)
    return words_of(text), []


def triples(words: list[str]) -> list[tuple[str, ...]]:
    n = min(3, len(words))
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)] if words else []


def overlap(part: list[str], found: set[tuple[str, ...]], single: set[str]) -> float:
    """Share of a part's triples that occur; parts of one or two words go by words."""
    if not part:
        return 1.0
    if len(part) < 3:
        return sum(w in single for w in part) / len(part)
    grams = triples(part)
    return sum(g in found for g in grams) / len(grams)


@dataclass
class Index:
    """Postings of the segments, by term."""

    items: list[int]  # item of each segment, by place in ``texts``
    texts: list[tuple[int, str]]
    terms: dict[str, int] = field(default_factory=dict)
    postings: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    block_max: list[dict[int, float]] = field(default_factory=list)
    keys: list[np.ndarray] = field(default_factory=list)  # of each posting, whether it is a key
    rest: np.ndarray = field(default_factory=lambda: np.zeros(0))  # mass of a segment's other words
    ids: list[list[int | None]] = field(default_factory=list)  # of each text


@dataclass
class Statistics:
    """Of the segments of all parts: number, words, and segments of each word."""

    segments: int = 0
    words: int = 0
    spread: Counter = field(default_factory=Counter)

    def add(self, counts: list[Counter]) -> None:
        self.segments += len(counts)
        for c in counts:
            self.words += sum(c.values())
            self.spread.update(c.keys())


def segments_of(text: str) -> list[Counter]:
    words = words_of(text)
    return [Counter(words[start : start + HALF]) for start in range(0, len(words), HALF)]


def build(texts: list[tuple[int, str]], over: Statistics | None = None) -> Index:
    """Index of (item id, text) pairs, weighted by the statistics of all parts, its own
    if none are given."""
    index = Index([], texts, ids=[[i] for i, _ in texts])
    counts: list[Counter] = []
    for k, (_, text) in enumerate(texts):
        mine = segments_of(text)
        counts += mine
        index.items += [k] * len(mine)
    if not counts:
        return index
    if over is None:
        over = Statistics()
        over.add(counts)
    spread, total_segments, mean = over.spread, over.segments, over.words / over.segments
    impacts: dict[str, list[tuple[int, float]]] = {}
    for s, c in enumerate(counts):
        length = sum(c.values())
        own = {
            w: math.log(1 + (total_segments - spread[w] + 0.5) / (spread[w] + 0.5))
            * n * (K1 + 1) / (n + K1 * (1 - B + B * length / mean))
            for w, n in c.items()
        }
        total = sum(own.values())
        for w, impact in own.items():
            impacts.setdefault(w, []).append((s, impact / total))
    most = max(1, int(RARE_SHARE * len(counts)))
    index.rest = np.zeros(len(counts))
    for t, (word, found) in enumerate(sorted(impacts.items())):
        index.terms[word] = t
        segments = np.array([s for s, _ in found], np.int64)
        values = np.array([v for _, v in found])
        index.postings.append((segments, values))
        tops: dict[int, float] = {}
        for s, v in found:
            tops[s // BLOCK] = max(tops.get(s // BLOCK, 0.0), v)
        index.block_max.append(tops)
        index.keys.append(np.full(len(found), len(found) <= most))
        if len(found) > most:
            index.rest[segments] += values
    _add_keys(index)
    return index


def _add_keys(index: Index) -> None:
    """Make keys of the next rarest words of segments whose other words could reach the
    threshold alone."""
    short = index.rest >= THRESHOLD - 1e-6
    others: dict[int, list[tuple[int, int, int]]] = {s: [] for s in np.flatnonzero(short).tolist()}
    for t, ((segments, _), keys) in enumerate(zip(index.postings, index.keys)):
        for place in np.flatnonzero(short[segments] & ~keys).tolist():
            others[int(segments[place])].append((len(segments), t, place))
    for s, words in others.items():
        for _, t, place in sorted(words):
            if index.rest[s] < THRESHOLD - 1e-6:
                break
            index.keys[t][place] = True
            index.rest[s] -= index.postings[t][1][place]


def block_max_wand(index: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """All segments that the distinct terms lift to the threshold, with their scores."""
    cursors = [[int(index.postings[t][0][0]), 0, t, float(index.postings[t][1].max())] for t in terms]
    out = []
    while cursors:
        cursors.sort()
        bound, pivot = 0.0, -1
        for k, (_, _, _, top) in enumerate(cursors):
            bound += top
            if bound >= threshold - 1e-9:
                pivot = k
                break
        if pivot < 0:
            break
        segment = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == segment:
            pivot += 1
        block = segment // BLOCK
        reachable = sum(index.block_max[c[2]].get(block, 0.0) for c in cursors[: pivot + 1])
        if reachable < threshold - 1e-9:
            # No segment up to the block's end, or the next cursor, can reach it.
            goal = (block + 1) * BLOCK
            if pivot + 1 < len(cursors):
                goal = min(goal, cursors[pivot + 1][0])
            goal = max(goal, segment + 1)
        elif cursors[0][0] == segment:
            score = sum(float(index.postings[c[2]][1][c[1]]) for c in cursors[: pivot + 1])
            if score >= threshold - 1e-9:
                out.append((segment, score))
            goal = segment + 1
        else:
            goal = segment
        for c in cursors[: pivot + 1]:
            if c[0] < goal:
                segments = index.postings[c[2]][0]
                c[1] = int(np.searchsorted(segments, goal))
                c[0] = int(segments[c[1]]) if c[1] < len(segments) else -1
        cursors = [c for c in cursors if c[0] >= 0]
    return out


class Searcher:
    """Runs texts against an index."""

    def __init__(self, index: Index) -> None:
        self.index = index
        self.sizes = np.array([int(k.sum()) for k in index.keys], np.int64)
        if len(self.sizes):
            self.segments = np.concatenate([p[0][k] for p, k in zip(index.postings, index.keys)])
            self.values = np.concatenate([p[1][k] for p, k in zip(index.postings, index.keys)])
            self.begins = np.cumsum(self.sizes) - self.sizes
        self.parts = [question_and_answer(text) for _, text in index.texts]

    def candidates(self, terms: np.ndarray, halves: np.ndarray) -> np.ndarray:
        """Passages that can reach the threshold for some segment, by its key words and
        all that its other words could add."""
        key = self.sizes[terms] > 0
        hits = np.unique(np.stack([np.concatenate([halves[key], halves[key] - 1]), np.concatenate([terms[key]] * 2)]), axis=1)
        passage, term = hits
        passage, term = passage[passage >= 0], term[passage >= 0]
        if not len(term):
            return np.zeros(0, np.int64)
        # Whole passages with about BLOCK_HITS postings at a time, as key words may be frequent.
        piece = np.cumsum(self.sizes[term]) // BLOCK_HITS
        begins = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
        cuts = begins[np.append(True, piece[begins][1:] != piece[begins][:-1])].tolist()
        found = [self._reaching(passage[a:b], term[a:b]) for a, b in zip(cuts, [*cuts[1:], len(term)])]
        return np.concatenate(found)

    def _reaching(self, passage: np.ndarray, term: np.ndarray) -> np.ndarray:
        sizes = self.sizes[term]
        at = np.arange(int(sizes.sum())) + np.repeat(self.begins[term] - (np.cumsum(sizes) - sizes), sizes)
        key = np.repeat(passage, sizes) * len(self.index.items) + self.segments[at]
        keys, place = np.unique(key, return_inverse=True)
        mass = np.bincount(place, self.values[at])
        reach = mass + self.index.rest[keys % len(self.index.items)]
        return np.unique(keys[reach >= THRESHOLD - 1e-9] // len(self.index.items))

    def search(self, text: str | None) -> dict[int, tuple[float, float, float]]:
        """Leaked texts of the index: best score, overlap of question and of answer."""
        words = words_of(text)
        if not words or not self.index.terms:
            return {}
        get = self.index.terms.get
        found = np.array([get(w, -1) for w in words], np.int64)
        known = np.flatnonzero(found >= 0)
        terms, halves = found[known], known // HALF
        last = max(0, (len(words) - 1) // HALF - 1)
        out: dict[int, tuple[float, float, float]] = {}
        # A passage is two neighbouring halves; the last half alone is none unless it is the only one.
        for p in self.candidates(terms, halves).tolist():
            p = min(p, last)
            inside = terms[(halves >= p) & (halves <= p + 1)]
            for segment, score in block_max_wand(self.index, np.unique(inside).tolist(), THRESHOLD):
                k = self.index.items[segment]
                question, answer = self.parts[k]
                reach = len(question) + len(answer)
                near = words[max(0, p * HALF - reach) : (p + 2) * HALF + reach]
                grams, single = set(triples(near)), set(near)
                q, a = overlap(question, grams, single), overlap(answer, grams, single)
                if q >= OVERLAP and a >= OVERLAP and score > out.get(k, (0.0,))[0]:
                    out[k] = (score, q, a)
        return out


def indexes(items: DataFrame, item_id: str = "item_id", text: str = "text") -> list[Index]:
    """The index of the distinct item texts in parts of at most about PART_WORDS words, so
    that each can be sent to every task."""
    items = (
        items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text"))
        .where("text IS NOT NULL")
        .groupBy("text")
        .agg(F.sort_array(F.collect_set(F.struct("item_id"))).alias("ids"))
    )
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // (PART_WORDS * 6)))
    rows = [
        items.where(F.pmod(F.xxhash64("text"), F.lit(count)) == part).sort("text").collect() for part in range(count)
    ]
    over = Statistics()
    for part in rows:
        for row in part:
            over.add(segments_of(row.text))
    out = []
    for part in rows:
        index = build([(place, row.text) for place, row in enumerate(part)], over)
        index.ids = [[i.item_id for i in row.ids] for row in part]
        out.append(index)
    return out


def leaks(
    df: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Leaked items per document: doc_id, item_id, score, question_overlap, answer_overlap."""
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    parts = [docs.mapInArrow(_search_with(index), SCHEMA) for index in indexes(items, item_id, item_text)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def without_leaks(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text leaks no item; nothing is shuffled."""
    for index in indexes(items, item_id, item_text):
        df = df.where(~_leaks_with(index)(F.col(text)))
    return df


def _leaks_with(index: Index):
    @F.arrow_udf("boolean")
    def leaking(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        searcher = Searcher(index)
        for array in batches:
            yield pa.array([bool(searcher.search(x.as_py())) for x in array], pa.bool_())

    return leaking


SCHEMA = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"


def _search_with(index: Index):
    def search(batches) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(index)
        for batch in batches:
            rows: list[tuple] = []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                for k, shown in sorted(searcher.search(value.as_py()).items()):
                    rows += [(name, item, *shown) for item in index.ids[k]]
            if rows:
                types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), types)],
                    ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                )

    return search
