"""Token files compressed by grammar (Re-Pair).

Documents are encoded in ascending order of their ids and written in shards, each a row
range of the order and as large as ``SHARD_BYTES`` of text, however many tasks there
are.  A shard is a series of segments; in a segment, repeated pairs of neighbouring
symbols, of a symbol with itself too, are replaced by new symbols again and again, as long
as a rule costs less than it saves.  A segment stores its
rules (two symbols each), the length each rule expands to, the remaining symbols, and
where each document begins among them.  No rule spans the end of a document, so any
document can be decoded alone.

Null texts count as empty and hold just the end id.  Rows with equal ids follow each
other in the order of a hash of their texts; null ids come first.  A very long text
gets a segment of its own.  Empty tables give empty files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import blocks, ragged
from shelfmark.llm.tokens import encoder

SEGMENT_IDS = 1_000_000  # a segment is closed when it holds so many ids
LEAST_COUNT = 4  # from so many occurrences a rule's three numbers cost less than they save
SHARD_BYTES = 8_000_000  # of text, some two segments
RULES_A_ROUND = 4096

SCHEMA = """shard int, segment int, n_tokens bigint, base bigint, rules binary, lengths binary,
    symbols binary, doc_ids array<bigint>, doc_starts array<bigint>"""


def _frequent_pairs(
    symbols: np.ndarray, places: np.ndarray, end: int, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs without the end that begin at ``least`` or more of these places, as ascending
    codes, how often each does, and where: the places of one pair after those of another,
    ascending."""
    if len(places) == len(symbols) - 1:
        left, right = symbols[:-1], symbols[1:]
    else:
        left, right = symbols[places], symbols[places + 1]
    wide = int(symbols.max()).bit_length()
    far = len(symbols).bit_length()
    if 2 * wide + far <= 64:
        # Both in one number, which sorts faster than an order is found.
        both = left.astype(np.uint64)
        both <<= np.uint64(wide)
        both |= right
        both <<= np.uint64(far)
        both |= places.astype(np.uint64)
        both.sort()
        places, codes = both, both >> np.uint64(far)
    else:
        wide, far = 32, 63
        codes = (left.astype(np.uint64) << np.uint64(32)) | right
        order = np.argsort(codes, kind="stable")
        places, codes = places[order].astype(np.uint64), codes[order]
    first = np.ones(len(codes), bool)
    first[1:] = codes[1:] != codes[:-1]
    starts = np.flatnonzero(first)
    counts = np.diff(starts, append=len(codes))
    pairs = codes[starts]
    pairs = ((pairs >> np.uint64(wide)) << np.uint64(32)) | (pairs & np.uint64((1 << wide) - 1))
    often = (counts >= least) & (pairs >> np.uint64(32) != end) & (pairs & np.uint64(0xFFFFFFFF) != end)
    places = places[np.repeat(often, counts)] & np.uint64((1 << far) - 1)
    return pairs[often], counts[often], places.astype(np.int64)


def _disjoint(pairs: np.ndarray) -> np.ndarray:
    """Pairs of which no two can overlap: no symbol is a left and a right part, but that a
    symbol paired with itself is in no other pair."""
    lefts: set[int] = set()
    rights: set[int] = set()
    chosen = []
    for code in pairs.tolist():
        a, b = code >> 32, code & 0xFFFFFFFF
        if a not in rights and b not in lefts and (a != b or a not in lefts):
            lefts.add(a)
            rights.add(b)
            chosen.append(code)
            if len(chosen) == RULES_A_ROUND:
                break
    return np.array(sorted(chosen), np.uint64)


def _left_to_right(places: np.ndarray, rule: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the second of every two neighbouring places in a run of one symbol, which
    is paired with itself."""
    starts = np.ones(len(places), bool)
    starts[1:] = places[1:] != places[:-1] + 1
    within = np.arange(len(places)) - np.flatnonzero(starts)[np.cumsum(starts) - 1]
    keep = within % 2 == 0
    return places[keep], rule[keep]


def compress(ids: np.ndarray, end: int, base: int, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """The remaining symbols and the rules; rule k stands for symbol base + k.

    Symbols that stay become no new neighbours of each other, so a pair that is rare in one
    round never is frequent later.  A round only looks at the places of the last round's
    frequent pairs and at new symbols with their neighbours."""
    symbols = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    made = 0
    look = np.ones(len(symbols), bool)
    while len(symbols) > 1:
        pairs, counts, places = _frequent_pairs(symbols, np.flatnonzero(look[:-1]), end, least)
        chosen = _disjoint(pairs[np.argsort(-counts, kind="stable")])
        if not len(chosen):
            break
        look[:] = False
        look[places] = True
        taken = np.isin(pairs, chosen, assume_unique=True)
        found = places[np.repeat(taken, counts)]
        rule = np.repeat(np.arange(len(chosen)), counts[taken])
        doubled = chosen >> np.uint64(32) == chosen & np.uint64(0xFFFFFFFF)
        if doubled.any():  # only these overlap themselves
            runs = doubled[rule]
            kept, their = _left_to_right(found[runs], rule[runs])
            found, rule = np.append(found[~runs], kept), np.append(rule[~runs], their)
        symbols[found] = (base + made + rule).astype(np.uint32)
        keep = np.ones(len(symbols), bool)
        keep[found + 1] = False
        symbols, look = symbols[keep], look[keep]
        new = np.flatnonzero(symbols >= base + made)
        look[new] = True
        look[np.maximum(new - 1, 0)] = True
        rules.append(np.stack([chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32))
        made += len(chosen)
    return symbols, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule stands for; rules only use earlier ones."""
    lengths = np.zeros(len(rules) + 1, np.int64)  # the last stands for plain ids
    parts = _parts(rules, base)
    while True:
        lengths[-1] = 1
        longer = lengths[parts].sum(axis=1)
        if np.array_equal(longer, lengths[:-1]):
            return longer.astype(np.uint32)
        lengths[:-1] = longer


def _parts(rules: np.ndarray, base: int) -> np.ndarray:
    """The rules that each rule's symbols stand for, and one more for plain ids."""
    return np.where(rules < base, len(rules), rules.astype(np.int64) - base)


def _levels(rules: np.ndarray, base: int) -> np.ndarray:
    """How many rules lie within each other, for each rule."""
    levels = np.zeros(len(rules) + 1, np.int64)
    parts = _parts(rules, base)
    while True:
        higher = levels[parts].max(axis=1, initial=0) + 1
        if np.array_equal(higher, levels[:-1]):
            return higher
        levels[:-1] = higher


class Decoder:
    """Random access to the ids of a segment."""

    def __init__(self, rules: np.ndarray, lengths: np.ndarray, base: int) -> None:
        self.base = base
        self.lengths = lengths.astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.zeros(int(self.lengths.sum()), np.uint32)
        levels = _levels(rules, base)
        for level in range(1, int(levels.max(initial=0)) + 1):
            here = np.flatnonzero(levels == level)
            self.flat[ragged(self.starts[here], self.lengths[here])] = self.expand(rules[here].ravel())

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        """How many ids each symbol stands for."""
        sizes = np.ones(len(symbols), np.int64)
        ruled = symbols >= self.base
        sizes[ruled] = self.lengths[symbols[ruled] - self.base]
        return sizes

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that a run of symbols stands for."""
        table = np.concatenate([self.flat, symbols])  # plain ids stand for themselves
        ruled = symbols >= self.base
        rule = np.where(ruled, symbols.astype(np.int64) - self.base, 0)
        own = np.arange(len(symbols)) + len(self.flat)
        if not len(self.lengths):
            return symbols
        return table[ragged(np.where(ruled, self.starts[rule], own), np.where(ruled, self.lengths[rule], 1))]


def write(df: DataFrame, path: str, tokenizer: str, end: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode all texts and write them as token files below ``path``."""
    def segments(batches):
        base = encoder(tokenizer, "words").tokenizer.get_vocab_size(with_added_tokens=True)
        shard = TaskContext.get().partitionId()
        names: list[int | None] = []
        parts: list[np.ndarray] = []
        held, number = 0, 0

        def segment() -> pa.RecordBatch:
            symbols, rules = compress(np.concatenate(parts), end, base)
            # Documents end with the end id, which no rule contains.
            ends = np.flatnonzero(symbols == end)
            own = np.fromiter((int((p == end).sum()) for p in parts), np.int64, len(parts))
            last = ends[np.cumsum(own) - 1]
            starts = np.concatenate([[0], last[:-1] + 1])
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "shard": shard, "segment": number, "n_tokens": held, "base": base,
                        "rules": rules.astype("<u4").tobytes(),
                        "lengths": expansion_lengths(rules, base).astype("<u4").tobytes(),
                        "symbols": symbols.astype("<u4").tobytes(),
                        "doc_ids": names, "doc_starts": starts.tolist(),
                    }
                ],
                schema=ARROW,
            )

        tail = np.array([end], np.uint32)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            done = 0
            # A shard's words are looked up together, each once.
            for texts in blocks((x.as_py() for x in batch.column(1)), SHARD_BYTES):
                for name, found in zip(ids[done:], encoder(tokenizer, "words").encode(texts)):
                    names.append(name)
                    parts.append(np.concatenate([found, tail]))
                    held += len(parts[-1])
                    if held >= SEGMENT_IDS:
                        yield segment()
                        names, parts, held, number = [], [], 0, number + 1
                done += len(texts)
        if parts:
            yield segment()

    chosen = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chosen.repartitionByRange(max(1, -(-size // SHARD_BYTES)), *order).sortWithinPartitions(*order).mapInArrow(
        segments, SCHEMA
    ).write.parquet(path)


ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("segment", pa.int32()), ("n_tokens", pa.int64()), ("base", pa.int64()),
        ("rules", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64())),
    ]
)


def decoded(row: dict) -> Iterator[tuple[int | None, np.ndarray]]:
    """The documents of one segment: id and token ids."""
    symbols = np.frombuffer(row["symbols"], "<u4")
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
    decoder = Decoder(rules, np.frombuffer(row["lengths"], "<u4"), row["base"])
    ids = decoder.expand(symbols)
    before = np.concatenate([[0], np.cumsum(decoder.sizes(symbols))])
    bounds = before[[*row["doc_starts"], len(symbols)]].tolist()
    for name, start, stop in zip(row["doc_ids"], bounds, bounds[1:]):
        yield name, ids[start:stop]


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of token files: doc_id, start (ids of all documents before it),
    n_tokens and ids_crc32 of the ids as little-endian 32-bit integers.

    Only the sizes of the segments meet: first one row per shard, then the segments
    of each shard."""
    files = spark.read.schema(SCHEMA).parquet(path)
    shards = files.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    segments = files.select(
        "shard", "segment", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("inside")
    )
    places = segments.join(shards, "shard").select("shard", "segment", (F.col("inside") + F.col("shard_start")).alias("start"))

    def documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                names, starts, sizes, sums = [], [], [], []
                start = 0
                for name, ids in decoded(row):
                    names.append(name)
                    starts.append(start)
                    sizes.append(len(ids))
                    sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    start += len(ids)
                where = [pa.array([row[k]] * len(names), pa.int32()) for k in ("shard", "segment")]
                yield pa.RecordBatch.from_arrays(
                    [*where, *(pa.array(x, pa.int64()) for x in (names, starts, sizes, sums))],
                    ["shard", "segment", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    # The decoded documents' few numbers meet the segments' places, not the files.
    found = files.mapInArrow(
        documents, "shard int, segment int, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return found.join(places, ["shard", "segment"]).select(
        "doc_id", (F.col("start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )
