"""Packing documents into token sequences with a grouping genetic algorithm.

Documents longer than a sequence are cut from the end, so only their first piece may be
short.  Whole-sequence pieces stand alone.  The rest is packed on islands, each a random
share of bounded size: a population of packings, in which crossover injects the well
filled sequences of one parent into the other, drops the sequences that hold a document
twice, and places displaced documents by best fit.  An island keeps its elite, the full
sequences and in any case half of its documents; all others migrate to new islands of
the next round, until one island is left.

Null and empty texts are a document of the end id alone.  Repeated rows are packed one
by one.  An empty table gives no sequences.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import blocks, stored
from shelfmark.llm.tokens import encoder

ISLAND = 4000  # pieces on an island, on average
POPULATION = 4
GENERATIONS = 8
WELL_FILLED = 0.998  # share of a sequence from which it is injected whole
SLACK = 1  # free places with which a sequence still counts as full

Packing = list[list[int]]


def pieces(df: DataFrame, tokenizer: str, end: int, capacity: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces of all documents: doc_id, piece, start, length, ids_crc32."""

    def cut(batches):
        tail = np.array([end], np.uint32)
        for batch in batches:
            names = batch.column(0).to_pylist()
            done = 0
            for texts in blocks(x.as_py() for x in batch.column(1)):
                rows: list[tuple] = []
                for name, found in zip(names[done:], encoder(tokenizer, "bytes").encode(texts)):
                    ids = np.concatenate([found, tail]).astype("<u4")
                    first = (len(ids) - 1) % capacity + 1
                    starts = [0, *range(first, len(ids), capacity)]
                    for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                        rows.append((name, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                done += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), PIECE_TYPES)], PIECE_NAMES
                )

    return df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(
        cut, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def _best_fit(packing: Packing, loose: list[int], sizes: list[int], capacity: int) -> Packing:
    """Place loose pieces, in the given order, where the least room is left over."""
    packing = [list(b) for b in packing]
    room = sorted((capacity - sum(sizes[i] for i in b), k) for k, b in enumerate(packing))
    for i in loose:
        at = bisect_left(room, (sizes[i], -1))
        if at < len(room):
            free, k = room.pop(at)
            packing[k].append(i)
        else:
            free, k = capacity, len(packing)
            packing.append([i])
        if free > sizes[i]:
            insort(room, (free - sizes[i], k))
    return packing


def _fitness(packing: Packing, sizes: list[int], capacity: int) -> float:
    """Higher is better: fewer sequences first, then unevenly filled ones."""
    fills = [sum(sizes[i] for i in b) / capacity for b in packing]
    return -len(packing) + sum(f * f for f in fills) / max(1, len(fills))


def _crossover(one: Packing, other: Packing, sizes: list[int], capacity: int, rng: np.random.Generator) -> Packing:
    """Well filled sequences of ``other``, then what they leave whole of ``one``."""
    well = [b for b in other if sum(sizes[i] for i in b) >= WELL_FILLED * capacity]
    injected = [b for b in well if rng.random() < 0.7]
    taken = {i for b in injected for i in b}
    # A sequence of the other parent that is badly filled is opened as well.
    kept = [b for b in one if taken.isdisjoint(b) and sum(sizes[i] for i in b) >= WELL_FILLED * capacity]
    held = taken.union(*kept)
    loose = sorted((i for b in one for i in b if i not in held), key=lambda i: (-sizes[i] + rng.integers(0, 3), i))
    return _best_fit(injected + kept, loose, sizes, capacity)


def evolved(sizes: list[int], capacity: int, seed: int) -> Packing:
    """The best packing that an island finds."""
    rng = np.random.default_rng(seed)
    falling = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    least = -(-sum(sizes) // capacity)
    people = [_best_fit([], falling, sizes, capacity)]
    for spread in range(1, POPULATION):
        order = sorted(range(len(sizes)), key=lambda i: (-sizes[i] + rng.integers(0, 20 * spread), i))
        people.append(_best_fit([], order, sizes, capacity))
    scored = sorted(((_fitness(p, sizes, capacity), k, p) for k, p in enumerate(people)), key=lambda x: (-x[0], x[1]))
    born = len(people)
    for _ in range(GENERATIONS):
        if len(scored[0][2]) <= least:
            break
        mother = scored[0][2]
        father = scored[1 + int(rng.integers(0, len(scored) - 1))][2]
        for one, other in ((mother, father), (father, mother)):
            child = _crossover(one, other, sizes, capacity, rng)
            scored.append((_fitness(child, sizes, capacity), born, child))
            born += 1
        scored = sorted(scored, key=lambda x: (-x[0], x[1]))[:POPULATION]
    return scored[0][2]


def _island(capacity: int, last: bool):
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key", ignore_index=True)
        sizes = frame["length"].tolist()
        best = evolved(sizes, capacity, int(frame["key"].iloc[0]) & 0xFFFFFFFF)
        fills = [sum(sizes[i] for i in b) for b in best]
        out, settled = [], 0
        for k in sorted(range(len(best)), key=lambda k: (-fills[k], k)):
            stays = last or fills[k] >= capacity - SLACK or 2 * settled < len(sizes)
            settled += len(best[k])
            name, offset = min(int(frame["key"].iat[i]) for i in best[k]), 0
            for i in best[k]:
                out.append((frame["key"].iat[i], sizes[i], name if stays else None, offset if stays else None))
                offset += sizes[i]
        return pd.DataFrame(
            {
                "key": pd.Series([x[0] for x in out], dtype="int64"),
                "length": pd.Series([x[1] for x in out], dtype="int64"),
                "sequence_id": pd.Series([x[2] for x in out], dtype="Int64"),
                "offset": pd.Series([x[3] for x in out], dtype="Int64"),
            }
        )

    return pack


def pack(items: DataFrame, capacity: int) -> DataFrame:
    """Sequence and offset of each item (key, length at most ``capacity``)."""
    settled = items.where(F.col("length") == capacity).select(
        "key", "length", F.col("key").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    left = items.where(F.col("length") < capacity)
    number = 0
    while (count := left.count()) > 0:
        islands = -(-count // ISLAND)
        dealt = left.withColumn("island", F.pmod(F.xxhash64("key", F.lit(number)), F.lit(islands)))
        packed = stored(
            dealt.groupBy("island").applyInPandas(
                _island(capacity, islands == 1), "key bigint, length bigint, sequence_id bigint, offset bigint"
            ),
            f"packing-{number}",
        )
        settled = settled.unionByName(packed.where("sequence_id IS NOT NULL"))
        left = packed.where("sequence_id IS NULL").select("key", "length")
        number += 1
    return settled


def packed_documents(
    df: DataFrame, tokenizer: str, end: int, capacity: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All pieces with the sequence and the offset that they got."""
    cut = stored(
        pieces(df, tokenizer, end, capacity, doc_id, text).withColumn("key", F.monotonically_increasing_id()), "pieces"
    )
    places = pack(cut.select("key", "length"), capacity).drop("length")
    return cut.join(places, "key").drop("key")
