"""Repeated passages found by content-defined chunks.

A gear rolling hash over the bytes of a text sets chunk ends where it is smaller than
``RADIUS`` values to both sides, moved on to the next white space.  So an end depends on the
bytes around it alone, not on the chunk before, and an insertion changes only the chunks
around it.  Chunks are deduplicated by digest: the first place of a digest, by document and
place, is kept and every later one is a repeat.  Runs of neighbouring repeated chunks are
anchors: each is extended to both sides by the equal words around the first place of its
outer chunk (the last place, where it is the first itself), up to the next run or
``CONTEXT`` bytes.  Runs that meet are one.  Those of at least ``MIN_WORDS`` words are
repeated passages.

What is shuffled is kept small.  Chunks meet by digest as compressed columns, many at a time.
Each carries a fingerprint of the words next to it, so texts are compared only at the sides
where the next words may be equal.

Null and empty texts have no chunks.  Rows are numbered and each is a document of its own,
whether ids are equal or null; the smallest id comes first, null ids before all others.
Texts are read whole and of any length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import blocks, partitions, ragged, stored

RADIUS = 16  # bytes; chunks have twice as many on average
MAX_CHUNK = 1024
MIN_WORDS = 20  # of a passage; single repeated lines such as licences are shorter
CONTEXT = 384  # bytes to each side in which an anchor is extended
WINDOW = 32  # bytes that a 32-bit gear hash looks back on
BLOCK_CHARS = 100_000  # of text cut together inside a task
PACKED_CHUNKS = 1_000_000  # sent together by a task
FREQUENT = 64  # places of a digest among these; of more, only the first and the last meet others

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
GEAR = np.random.Generator(np.random.PCG64(271828)).integers(0, 1 << 32, 256, np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def gear_hashes(data: np.ndarray, without: np.ndarray | None = None) -> np.ndarray:
    """The rolling hash after each byte: the sum of GEAR[byte] << distance over WINDOW bytes,
    to which the bytes at the places ``without`` add nothing."""
    hashes = GEAR[data]
    if without is not None:
        hashes[without] = 0
    reach = 1
    while reach < WINDOW:
        shifted = hashes.copy()
        shifted[reach:] += hashes[:-reach] << np.uint32(reach)
        hashes = shifted
        reach *= 2
    return hashes


def chunk_ends(data: np.ndarray) -> list[int]:
    """Ends of the chunks of a text's bytes; each ends behind a white space or the text."""
    return _ends_of([data])[2].tolist()


def _ends_of(texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Chunks of some texts: each one's text, start, end and number of words."""
    return _chunks_of(texts)[:4]


def _chunks_of(texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Chunks of some texts, found together: each one's text, start, end, number of words, and
    fingerprints of the last word before it and the first word behind it.

    A fingerprint is 0 where the next chunk has no word, where there is none, or where a
    chunk may have been ended inside a word.  Between the texts are WINDOW bytes that add nothing to any hash and are no minima."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes + WINDOW) - sizes - WINDOW
    lasts = begins + sizes
    gap = np.zeros(WINDOW, np.uint8)
    data = np.concatenate([x for t in texts for x in (t, gap)])
    between = ragged(lasts, np.full(len(texts), WINDOW))
    hashes = gear_hashes(data, between)
    hashes[between] = np.iinfo(hashes.dtype).max
    marks = np.flatnonzero(_local_minima(hashes)) + 1
    space = _SPACE[data]
    stop = np.append(space, False)
    stop[lasts[sizes > 0] - 1] = True
    stops = np.flatnonzero(stop) + 1
    keep = np.zeros(len(data) + 1, bool)
    keep[stops[np.searchsorted(stops, marks)]] = True
    keep[lasts[sizes > 0]] = True
    ends = np.flatnonzero(keep)
    text = np.searchsorted(lasts, ends)
    starts = np.maximum(np.append(0, ends[:-1])[: len(ends)], begins[text])
    pieces = -(-(ends - starts) // MAX_CHUNK)  # more than one in text without a boundary for long
    cut = pieces > 1
    if cut.any():
        nth = ragged(np.zeros(len(pieces), np.int64), pieces)
        text, final, cut = (np.repeat(x, pieces) for x in (text, ends, cut))
        starts = np.repeat(starts, pieces) + nth * MAX_CHUNK
        ends = np.minimum(starts + MAX_CHUNK, final)
    space[between] = True
    first = ~space
    first[1:] &= space[:-1]
    words = np.append(0, np.cumsum(first))
    n_words = words[ends] - words[starts]
    prints = _word_prints(data, space, first)
    before, behind = np.zeros((2, len(ends)), np.uint8)
    beside = (text[1:] == text[:-1]) & ~cut[1:] & ~cut[:-1]
    at = np.flatnonzero(beside & (n_words[1:] > 0))
    behind[at] = prints[words[ends[at]]]
    at = np.flatnonzero(beside & (n_words[:-1] > 0)) + 1
    before[at] = prints[words[starts[at]] - 1]
    return text, starts - begins[text], ends - begins[text], n_words, before, behind


def _word_prints(data: np.ndarray, space: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number from 1 to 255 for each word, the same for equal words."""
    values = GEAR[data].astype(np.uint64)
    values[space] = 0
    begins = np.flatnonzero(first)
    sums = np.add.reduceat(values, begins) if len(begins) else values[:0]
    return ((sums * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)


def _local_minima(hashes: np.ndarray) -> np.ndarray:
    """Where a value is below the RADIUS values before it and not above those behind."""
    least = np.pad(hashes, RADIUS, constant_values=np.iinfo(hashes.dtype).max)
    reach = 1
    while reach < RADIUS:  # least[i] is of RADIUS values from i on, a power of two
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    n = len(hashes)
    return (hashes < least[:n]) & (hashes <= least[RADIUS + 1 : RADIUS + 1 + n])


def numbered(df: DataFrame, doc_id: str, text: str, row: str | None) -> DataFrame:
    """doc_id, row and text; without a column that numbers the rows of ``df``, which has
    to be a stored table then, each gets the number that Spark gives it."""
    number = F.col(row) if row else F.monotonically_increasing_id()
    return df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), number.cast("bigint").alias("row"))


def _cut(column: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """Chunks of the texts of a column, by blocks of texts: each one's text, start, end, number
    of words, the fingerprints beside it, and 32 bits of the high half and the low half of its digest."""
    done = 0
    for texts in blocks((x.as_py() for x in column), BLOCK_CHARS):
        raws = [x.encode("utf-8", "surrogatepass") for x in texts]
        text, starts, ends, words, before, behind = _chunks_of([np.frombuffer(raw, np.uint8) for raw in raws])
        places = zip(text.tolist(), starts.tolist(), ends.tolist())
        digests = b"".join([xxhash.xxh3_128_digest(raws[k][a:b].strip()) for k, a, b in places])
        halves = (np.frombuffer(digests, ">u8").astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
        yield text + done, starts, ends, words, before, behind, halves[::2] >> 32, halves[1::2]
        done += len(texts)


def _columns(batches) -> Iterator[dict[str, np.ndarray]]:
    """The chunks of batches of numbered texts, by blocks of texts, as the columns of PACKED."""
    for batch in batches:
        known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        ids, rows = batch.column(0).fill_null(0).to_numpy(), batch.column(2).to_numpy()
        for text, starts, ends, words, before, behind, high, low in _cut(batch.column(1)):
            found = (rows[text], ids[text], known[text], starts, ends - starts, words, high, low, before, behind, np.zeros(len(text)))
            yield {name: x.astype(kind) for (name, kind), x in zip(PACKED.items(), found)}


# A chunk: its document, place and number of words, 96 bits of its digest, which any two of a billion different
# chunks share with a chance of about 1e-11, the fingerprints beside it, and which part it takes in repeated_chunks().
PACKED = {
    "row": np.int64, "doc_id": np.int64, "known": np.uint8, "start": np.int64, "length": np.int32, "n_words": np.int32,
    "high": np.int32, "low": np.int64, "before": np.uint8, "behind": np.uint8, "part": np.uint8,
}
PLAIN, FRAME, BETWEEN = range(3)  # frames are the first and last places of frequent digests; the others are between


def chunks(df: DataFrame) -> DataFrame:
    """All chunks of numbered texts, a row each: doc_id, row, start and length in bytes, n_words, and the digest."""

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for found in _columns(batches):
            ids = pa.array(found["doc_id"], mask=found["known"] == 0)
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(found[c]) for c in NAMES[1:])], NAMES)

    return df.select("doc_id", "text", "row").mapInArrow(
        cut, "doc_id bigint, row bigint, start bigint, length int, n_words int, high int, low bigint"
    )


def half_digests(df: DataFrame) -> DataFrame:
    """The low halves alone of the digests of all chunks of numbered texts."""

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in _cut(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(found[-1])], ["low"])

    return df.select("text").mapInArrow(cut, "low bigint")


NAMES = ["doc_id", "row", "start", "length", "n_words", "high", "low"]


def _packed(found: dict[str, np.ndarray], buckets: int) -> pa.RecordBatch:
    """Chunks as a row for each bucket of digests, whose columns are compressed by bytes of
    equal place.  Those between a frequent digest's frames go to any bucket."""
    part, low = found["part"], found["low"]
    order = np.argsort(low)
    edges = np.flatnonzero(np.diff(low[order], prepend=~low[order[0]], append=~low[order[-1]]))
    for k in np.flatnonzero(np.diff(edges) > FREQUENT):
        places = order[edges[k] : edges[k + 1]]
        places = places[np.lexsort([found[c][places] for c in ("start", "row", "doc_id", "known")])]
        for high in np.unique(found["high"][places]):
            same = places[found["high"][places] == high]
            if len(same) > 2:
                part[same], part[same[1:-1]] = FRAME, BETWEEN
    bucket = ((low.view(np.uint64) >> np.uint64(24)) % np.uint64(buckets)).astype(np.int32)
    bucket[part == BETWEEN] = zlib.crc32(found["row"][:1].tobytes()) % buckets
    order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets), "right")
    sizes = np.diff(ends, prepend=0)
    filled = np.flatnonzero(sizes)
    codec = pa.Codec("zstd", compression_level=1)
    out = [pa.array(filled, pa.int32()), pa.array(sizes[filled], pa.int32())]
    for name, values in found.items():
        values, packed = values[order], []
        for k in filled:
            own = values[ends[k] - sizes[k] : ends[k]]
            if name in ("row", "doc_id"):
                own = np.diff(own, prepend=own.dtype.type(0))
            packed.append(codec.compress(own.view(np.uint8).reshape(len(own), -1).T.tobytes(), asbytes=True))
        out.append(pa.array(packed, pa.binary()))
    return pa.RecordBatch.from_arrays(out, ["bucket", "n", *found])


def _unpacked(table: pa.Table) -> dict[str, np.ndarray]:
    codec, sizes, found = pa.Codec("zstd"), table.column("n").to_pylist(), {}
    for name, kind in PACKED.items():
        width, parts = np.dtype(kind).itemsize, []
        for n, packed in zip(sizes, table.column(name)):
            planes = np.frombuffer(codec.decompress(packed.as_buffer(), n * width, asbytes=True), np.uint8)
            values = np.ascontiguousarray(planes.reshape(width, n).T).view(kind)[:, 0]
            parts.append(np.cumsum(values) if name in ("row", "doc_id") else values)
        found[name] = np.concatenate(parts)
    return found


def _repeats(table: pa.Table) -> pa.Table:
    """The repeated chunks of a bucket of digests, with ``partner``, whether the words beside
    both may be equal, and ``across``.  Places between frames are without these and keep their
    digests; the first place of a frequent digest is there once more for them, as a frame."""
    found = _unpacked(table)
    between = {c: x[found["part"] == BETWEEN] for c, x in found.items()}
    own = np.flatnonzero(found["part"] != BETWEEN)
    own = own[np.argsort(found["low"][own])]
    same = np.diff(found["low"][own]) == 0
    own = own[(np.append(same, False) | np.append(False, same))[: len(own)]]
    own = own[np.lexsort([found[c][own] for c in ("start", "row", "doc_id", "known", "high", "low")])]
    found = {c: x[own] for c, x in found.items()}
    fresh = (np.diff(found["low"]) != 0) | (np.diff(found["high"]) != 0)
    group = np.append(0, np.cumsum(fresh))[: len(own)]
    sizes = np.bincount(group)
    last = np.cumsum(sizes) - 1
    first = last - sizes + 1
    across = found["row"][first] != found["row"][last]
    frequent = np.flatnonzero(np.bincount(group, found["part"] == FRAME))

    def rows(part: int, chunk: dict[str, np.ndarray], **known: np.ndarray) -> pa.Table:
        """``known`` and the places; digests and fingerprints unless the chunks are done with."""
        n = len(chunk["row"])
        columns = {c: chunk[c] for c in ("row", "start", "length", "n_words")} | known | {"part": np.full(n, part)}
        if part != PLAIN:
            columns |= {c: chunk[c] for c in ("high", "low", "before", "behind")}
        out = {c: pa.array(x) for c, x in columns.items()} | {"doc_id": pa.array(chunk["doc_id"], mask=chunk["known"] == 0)}
        return pa.table([out[f.name].cast(f.type) if f.name in out else pa.nulls(n, f.type) for f in REPEAT], REPEAT)

    is_first = np.arange(len(own)) == first[group]
    other = np.where(is_first, last[group], first[group])
    partner = {f"partner_{c}": found[c][other] for c in ("row", "start", "length")}
    meets = {
        f"meets_{side}": (found[c] == 0) | (found[c][other] == 0) | (found[c] == found[c][other])
        for side, c in (("left", "before"), ("right", "behind"))
    }
    known = {"is_first": is_first, "across": across[group], **partner, **meets}
    many = sizes[group] > 1
    frames = {c: x[first[frequent]] for c, x in found.items()}
    return pa.concat_tables([
        rows(PLAIN, {c: x[many] for c, x in found.items()}, **{c: x[many] for c, x in known.items()}),
        rows(FRAME, frames, across=across[frequent]),
        rows(BETWEEN, between),
    ])


REPEAT = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "row", "start", "partner_row", "partner_start", "low")]
    + [(c, pa.int32()) for c in ("length", "n_words", "partner_length", "high")]
    + [(c, pa.bool_()) for c in ("is_first", "across", "meets_left", "meets_right")]
    + [(c, pa.int16()) for c in ("before", "behind", "part")]
)
SQL_TYPES = {pa.int64(): "bigint", pa.int32(): "int", pa.int16(): "smallint", pa.bool_(): "boolean", pa.binary(): "binary"}


def repeated_chunks(texts: DataFrame) -> DataFrame:
    """The chunks of numbered texts whose digest occurs more than once, with ``is_first`` for the kept
    place, ``across`` where more than one document has the digest, ``partner``, the first place or,
    for that, the last, and ``meets_left`` and ``meets_right``, whether the next words may be equal.

    All places of a digest meet in one task, but of a frequent one only the first and the last place
    that a task has seen.  The places between then meet its first place, split by the skew join."""
    buckets = partitions(texts.sparkSession)

    def pack(batches) -> Iterator[pa.RecordBatch]:
        some, n = [], 0
        for found in _columns(batches):
            some.append(found)
            n += len(found["row"])
            if n >= PACKED_CHUNKS:
                yield _packed({c: np.concatenate([x[c] for x in some]) for c in PACKED}, buckets)
                some, n = [], 0
        if n:
            yield _packed({c: np.concatenate([x[c] for x in some]) for c in PACKED}, buckets)

    packed = texts.select("doc_id", "text", "row").mapInArrow(
        pack, "bucket int, n int, " + ", ".join(f"{c} binary" for c in PACKED)
    )
    schema = ", ".join(f"{f.name} {SQL_TYPES[f.type]}" for f in REPEAT)
    met = stored(packed.groupBy("bucket").applyInArrow(_repeats, schema), "repeated-chunks", tidy=True)
    partner = F.struct(*(F.col(f"partner_{c}").alias(c) for c in ("row", "start", "length"))).alias("partner")
    names = ["doc_id", "row", "start", "length", "n_words", "is_first", "across", "partner", "meets_left", "meets_right"]
    plain = met.where(F.col("part") == PLAIN).withColumn("partner", partner).select(*names)
    frames = met.where(F.col("part") == FRAME).select(
        "high", "low", "across", F.struct("row", "start", "length").alias("partner"),
        F.col("before").alias("first_before"), F.col("behind").alias("first_behind"),
    )

    def meets(own: str):
        return F.expr(f"{own} = 0 or first_{own} = 0 or {own} = first_{own}")

    between = met.where(F.col("part") == BETWEEN).drop("across").join(frames, ["high", "low"]).withColumns(
        {"is_first": F.lit(False), "meets_left": meets("before"), "meets_right": meets("behind")}
    )
    return plain.unionByName(between.select(*names))


def anchors(repeated: DataFrame) -> DataFrame:
    """Runs of neighbouring repeated chunks: doc_id, row, start, end, n_words, first_words
    (words of chunks kept as first places), across_words (words that other documents have),
    repeats (the spans of later places), the outer chunks, and the bytes free to both sides."""
    order = Window.partitionBy("row").orderBy("start")
    new = F.coalesce(F.lag(F.col("start") + F.col("length")).over(order) != F.col("start"), F.lit(True))
    runs = repeated.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(order))
    chunk = F.struct("partner", "is_first", "across", "meets_left", "meets_right")
    return (
        runs.groupBy("row", "run")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.min("start").alias("start"),
            F.max(F.col("start") + F.col("length")).alias("end"),
            F.sum("n_words").alias("n_words"),
            F.sum(F.when(F.col("is_first"), F.col("n_words")).otherwise(0)).alias("first_words"),
            F.sum(F.when(F.col("across"), F.col("n_words")).otherwise(0)).alias("across_words"),
            F.collect_list(F.when(~F.col("is_first"), F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("repeats"),
            F.min_by(chunk, "start").alias("left"),
            F.max_by(chunk, "start").alias("right"),
        )
        .withColumn("room_left", F.col("start") - F.coalesce(F.lag("end").over(order), F.lit(0)))
        .withColumn("room_right", F.coalesce(F.lead("start").over(order) - F.col("end"), F.lit(CONTEXT)))
        .drop("run")
    )


def _sides(runs: DataFrame) -> DataFrame:
    """A row for each side of a run that has room and may go on: its place and its partner's."""

    def side(name: str, at: str, other) -> DataFrame:
        return runs.where(f"room_{name} > 0 and {name}.meets_{name}").select(
            "row", "start", F.lit(name == "left").alias("left"), F.col(at).alias("at"), F.col(f"room_{name}").alias("room"),
            F.col(f"{name}.partner.row").alias("other_row"), other.alias("other_at"),
        )

    partner = F.col("right.partner.start") + F.col("right.partner.length")
    return side("left", "start", F.col("left.partner.start")).unionByName(side("right", "end", partner))


def _contexts(texts: DataFrame, sides: DataFrame) -> DataFrame:
    """row, at, left and the whole words within CONTEXT bytes to that side, as bytes."""
    wanted = sides.select("row", "at", "left").unionByName(
        sides.select(F.col("other_row").alias("row"), F.col("other_at").alias("at"), "left")
    )
    wanted = wanted.distinct().groupBy("row").agg(F.collect_list(F.struct("at", "left")).alias("places"))

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out: list[tuple] = []
                for row, text, places in zip(*(c.to_pylist() for c in part.columns)):
                    raw = text.encode("utf-8", "surrogatepass")
                    for place in places:
                        at = place["at"]
                        out.append((row, at, place["left"], context(raw, at, place["left"])))
                kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
                columns = list(zip(*out)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["row", "at", "left", "context"])

    return texts.join(wanted, "row").select("row", "text", "places").mapInArrow(
        cut, "row bigint, at bigint, left boolean, context binary"
    )


def context(raw: bytes, at: int, left: bool) -> bytes:
    """The bytes to one side of a place, without a word that CONTEXT cuts."""
    if left:
        start = max(0, at - CONTEXT)
        while 0 < start < at and not _SPACE[raw[start - 1]]:
            start += 1
        return raw[start:at]
    end = min(len(raw), at + CONTEXT)
    while at < end < len(raw) and not _SPACE[raw[end]]:
        end -= 1
    return raw[at:end]


def equal_words(own: bytes, other: bytes, left: bool) -> list[tuple[int, int]]:
    """Begins and ends in ``own`` of the words equal to those of ``other``, going on from
    the side at which both meet."""
    mine = [m.span() for m in WORD.finditer(own)]
    theirs = other.split()
    if left:
        mine, theirs = mine[::-1], theirs[::-1]
    n = 0
    while n < min(len(mine), len(theirs)) and own[slice(*mine[n])] == theirs[n]:
        n += 1
    return sorted(mine[:n])


def _extensions(texts: DataFrame, sides: DataFrame) -> DataFrame:
    """row, start, left and the equal words, begin and end, to that side of a run."""
    known = stored(_contexts(texts, sides), "contexts", tidy=True)
    both = sides.join(known.withColumnRenamed("context", "own"), ["row", "at", "left"]).join(
        known.withColumnsRenamed({"row": "other_row", "at": "other_at", "context": "other"}), ["other_row", "other_at", "left"]
    )

    def match(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row, start, left, at, room, own, other in zip(*(c.to_pylist() for c in batch.columns)):
                own = (own[-room:] if left else own[:room]) if room < len(own) else own
                begin = at - len(own) if left else at
                words = [{"begin": begin + a, "end": begin + b} for a, b in equal_words(own, other, left)]
                # An equal side reaches what lies next, over white space.
                reached = len(words) == len(own.split()) and len(own) == room
                out.append((row, start, left, words, reached))
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.bool_()]
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["row", "start", "left", "words", "reached"]
            )

    return both.select("row", "start", "left", "at", "room", "own", "other").mapInArrow(
        match, "row bigint, start bigint, left boolean, words array<struct<begin: bigint, end: bigint>>, reached boolean"
    )


def passages_of(runs: list[dict]) -> list[dict]:
    """The extended runs of one document, joined where they meet: the words of each that
    are there, shared with other documents, and kept, and the spans to remove."""
    out: list[dict] = []
    words: dict[int, tuple[bool, bool]] = {}
    reach = -1
    for run in sorted(runs, key=lambda r: r["start"]):
        left, right = run["left"], run["right"]
        begin = min([run["start"], *(w["begin"] for w in left["words"])])
        if not out or not (begin <= reach or left["reached"]):
            words = {}
            out.append({"n_words": 0, "first_words": 0, "across_words": 0, "spans": []})
        last = out[-1]
        for name in ("n_words", "first_words", "across_words"):
            last[name] += run[name]
        last["spans"] += [(x["start"], x["end"]) for x in run["repeats"]]
        for side in (left, right):
            for w in side["words"]:
                before = words.get(w["begin"])
                now = (side["is_first"], side["across"])
                if before:
                    now = (now[0] and before[0], now[1] or before[1])
                last["n_words"] += before is None
                last["first_words"] += now[0] - (before[0] if before else 0)
                last["across_words"] += now[1] - (before[1] if before else 0)
                words[w["begin"]] = now
            if side["words"] and not side["is_first"]:
                ends = [w["end"] for w in side["words"]]
                last["spans"].append(
                    (begin, run["start"]) if side is left else (run["end"], max(ends))
                )
        reach = max([run["end"], *(w["end"] for w in right["words"])])
        if right["reached"]:
            reach = run["end"] + run["room_right"]
    return out


def joined_spans(spans: list[tuple[int, int]]) -> list[dict]:
    """Spans in order, as start and length, those that meet as one."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [{"start": a, "length": b - a} for a, b in out]


def documents(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, row: str | None = None
) -> DataFrame:
    """Documents that hold repeated passages: doc_id, row, the number of passages, the most
    words of one that other documents share, all their words, the words to be removed as
    later places, and the byte spans to remove, in order."""
    texts = numbered(df, doc_id, text, row)
    runs = stored(anchors(repeated_chunks(texts)), "anchors", tidy=True)
    found = stored(_extensions(texts, _sides(runs)), "extensions", tidy=True)
    found = found.groupBy("row", "start").agg(
        *(F.max(F.when(F.col("left") == (name == "left"), F.struct("words", "reached"))).alias(f"more_{name}") for name in ("left", "right"))
    )

    def side(name: str):
        return F.struct(
            F.coalesce(f"more_{name}.words", F.array().cast("array<struct<begin: bigint, end: bigint>>")).alias("words"),
            F.coalesce(f"more_{name}.reached", F.lit(False)).alias("reached"), f"{name}.is_first", f"{name}.across",
        ).alias(name)

    run = F.struct("start", "end", "n_words", "first_words", "across_words", "repeats", "room_right", side("left"), side("right"))
    by_row = runs.join(found, ["row", "start"], "left").groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.collect_list(run).alias("runs"))

    def total(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for number, name, mine in zip(*(c.to_pylist() for c in batch.columns)):
                kept = [p for p in passages_of(mine) if p["n_words"] >= min_words]
                if kept:
                    n, first = sum(p["n_words"] for p in kept), sum(p["first_words"] for p in kept)
                    shared = max(p["across_words"] for p in kept)
                    rows.append((name, number, len(kept), shared, n, n - first, joined_spans([x for p in kept for x in p["spans"]])))
            kinds = [*[pa.int64()] * 6, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))]
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], FOUND)

    return by_row.select("row", "doc_id", "runs").mapInArrow(
        total, ", ".join(f"{c} bigint" for c in FOUND[:-1]) + ", removed_spans array<struct<start: bigint, length: bigint>>"
    )


FOUND = ["doc_id", "row", "n_passages", "longest_shared", "repeated_words", "removed_words", "removed_spans"]


def without_repeats(
    df: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None
) -> DataFrame:
    """``df`` with the later places of repeated passages cut out of its texts; ``found``
    are its documents(), numbered in the same way."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for value, removed in zip(texts.to_pylist(), spans.to_pylist()):
            if value is not None and removed:
                raw, at, kept = value.encode("utf-8", "surrogatepass"), 0, []
                for span in removed:
                    kept.append(raw[at : span["start"]])
                    at = span["start"] + span["length"]
                value = b"".join([*kept, raw[at:]]).decode("utf-8", "replace")
            out.append(value)
        return pa.array(out, pa.string())

    spans = found.select(F.col("row").alias("_row"), F.col("removed_spans").alias("_spans"))
    number = F.col(row) if row else F.monotonically_increasing_id()
    joined = df.withColumn("_number", number.cast("bigint")).join(spans, F.col("_number") == F.col("_row"), "left")
    return joined.withColumn(text, cut(F.col(text), F.col("_spans"))).select(*df.columns)
