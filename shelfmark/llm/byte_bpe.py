"""Byte-level BPE by overlapping chunks, for public rank files, and back to bytes.

A text of up to ``CHUNK`` characters is encoded where it is read.  A longer one is cut into
chunks that overlap by ``OVERLAP`` characters, and the chunks are dealt over all tasks:

* Every chunk is split into pre-tokens by itself.  It may begin inside one, but a match of
  the pattern depends only on the text from its start up to one character past its end, so
  from the first boundary that two neighbours have in common both go on alike.  Matches
  that touch the end of a chunk are not counted, as they might have gone on.
* Neighbours are stitched at such a common boundary inside their overlap, at one before
  white space if there is any: such a one is a boundary in any context.  No stitch
  follows white space, where the pattern looks ahead.  The part of a chunk between its two stitches is a piece.
* Where an overlap holds no common boundary, as inside one very long pre-token, both
  chunks' parts become one piece.  So the ids are always those of the whole text, at the
  price of larger pieces; with one pre-token the piece is the text.
* Pieces are encoded in parallel.  A text's ids are those of its pieces in order, and
  decoding gives each piece's bytes, of which those of the text are the concatenation.

Null texts count as empty and have no ids.  Rows with equal or null ids are encoded each by
itself, as rows are numbered.  An empty table gives no rows; other columns are ignored.
Nothing that looks like a special token is special.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import partitions, stored
from shelfmark.llm.tokens import PATTERN

CHUNK = 16_384  # characters from which a text is cut
OVERLAP = 512
CHUNKS = 64  # that are cut off a text at a time
BATCH_CHARS = 4_000_000  # characters of texts in one batch of results

_encodings: dict[str, object] = {}
_matcher = regex.compile(PATTERN)


def encoding(path: str):
    """This process's encoder for a rank file: one line per token, its bytes and rank."""
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encodings[path] = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def boundaries(text: str) -> list[int]:
    """Where the pre-tokens of a text begin.  The last one may go on beyond a chunk's end,
    so its end is none of them."""
    return [m.start() for m in _matcher.finditer(text)]


def stitches(text: str, at: list[int], low: int, high: int) -> tuple[list[int], list[int]]:
    """The boundaries in [low, high) that chunks may be stitched at: those before plain
    white space, which are boundaries in any context, and the others."""
    inside = [p for p in at if max(low, 1) <= p < high and not text[p - 1].isspace()]
    return [p for p in inside if text[p] in " \n\t\r"], [p for p in inside if text[p] not in " \n\t\r"]


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _chunks(numbered: DataFrame) -> DataFrame:
    """Texts as overlapping chunks: (doc_id, row, chunk, text)."""

    def cut(batches) -> Iterator[pa.RecordBatch]:
        step = CHUNK - OVERLAP
        for batch in batches:
            for i in range(batch.num_rows):
                doc, text, row = (batch.column(n)[i].as_py() for n in range(3))
                count = -(-(len(text) - OVERLAP) // step)
                for first in range(0, count, CHUNKS):
                    part = range(first, min(count, first + CHUNKS))
                    columns = [
                        pa.array([doc] * len(part), batch.schema.field(0).type),
                        pa.array([row] * len(part), pa.int64()),
                        pa.array(part, pa.int32()),
                        pa.array([text[k * step : k * step + CHUNK] for k in part], pa.string()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "chunk", "text"])

    kind = numbered.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(cut, f"doc_id {kind}, row bigint, chunk int, text string")


PLACES = ("head_spaced", "head_other", "tail_spaced", "tail_other")


def _with_stitches(chunks: DataFrame) -> DataFrame:
    """Chunks with the stitches possible in both overlaps, counted from the overlap's start."""

    def scan(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[list[int]]] = [[], [], [], []]
            for value in batch.column(batch.schema.names.index("text")):
                text = value.as_py()
                at = boundaries(text)
                for out, low in ((0, 0), (2, CHUNK - OVERLAP)):
                    for kind, places in enumerate(stitches(text, at, low, low + OVERLAP)):
                        found[out + kind].append([p - low for p in places])
            columns = [*batch.columns, *(pa.array(x, pa.list_(pa.int32())) for x in found)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *PLACES])

    return chunks.mapInArrow(scan, _ddl(chunks) + "".join(f", {n} array<int>" for n in PLACES))


def _pieces(chunks: DataFrame) -> DataFrame:
    """Parts of chunks between stitches: (doc_id, row, piece, chunk, text).  Parts of one
    piece follow each other by chunk."""
    spark = chunks.sparkSession
    marked = stored(_with_stitches(chunks.repartition(partitions(spark), "row", "chunk")), "marked")
    before = marked.select("row", (F.col("chunk") + 1).alias("chunk"), "tail_spaced", "tail_other")

    def common(kind: str) -> Column:
        return F.try_element_at(F.array_intersect(f"tail_{kind}", f"head_{kind}"), F.lit(1))

    found = marked.select("row", "chunk", "head_spaced", "head_other").join(before, ["row", "chunk"])
    found = found.select("row", "chunk", common("spaced").alias("spaced"), common("other").alias("other"))
    in_order = Window.partitionBy("row").orderBy("chunk")
    # A chunk that is not stitched to the one before it has no sure boundaries of its own,
    # so behind it only stitches before white space count until there was one.
    last_sure = F.coalesce(F.max(F.when(F.col("spaced").isNotNull(), F.col("chunk"))).over(in_order), F.lit(0))
    loose = F.col("spaced").isNull() & F.col("other").isNull()
    last_loose = F.coalesce(F.max(F.when(loose, F.col("chunk"))).over(in_order), F.lit(-1))
    cuts = found.select(
        "row", "chunk", F.coalesce("spaced", F.when(last_sure > last_loose, F.col("other"))).alias("cut")
    )
    # Everything about stitches is settled before any text is fetched.
    plan = (
        marked.select("row", "chunk")
        .join(cuts, ["row", "chunk"], "left")
        .withColumn("next_cut", F.lead("cut").over(in_order))
        .withColumn("piece", F.count("cut").over(in_order))
        .withColumn("parts", F.count("*").over(Window.partitionBy("row", "piece")))
    )
    # Without a stitch, what both chunks hold belongs to the first.
    start = F.when(F.col("chunk") == 0, 0).otherwise(F.coalesce("cut", F.lit(OVERLAP)))
    end = F.coalesce(F.col("next_cut") + (CHUNK - OVERLAP), F.length("text"))
    part = F.substring(F.col("text"), start + 1, end - start)
    dealt = marked.select("doc_id", "row", "chunk", "text").join(plan, ["row", "chunk"])
    return dealt.select("doc_id", "row", "piece", "chunk", part.alias("text"), (F.col("parts") == 1).alias("alone"))


def _parts(df: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Whole short texts, and the parts of the pieces of long ones, by row and piece."""
    numbered = df.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row")
    )
    long = F.coalesce(F.length("text") > CHUNK, F.lit(False))
    short = numbered.where(~long).select("doc_id", "row", F.lit(0).cast("bigint").alias("piece"), "text")
    pieces = _pieces(_chunks(numbered.where(long)))
    torn = (
        pieces.where("NOT alone")
        .repartition(partitions(df.sparkSession), "row", "piece")
        .sortWithinPartitions("row", "piece", "chunk")
    )
    return short, pieces.where("alone").select(*short.columns).unionByName(torn.select(*short.columns))


def encode(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The ids of whole texts, long ones in pieces: doc_id, row (a number of the text's
    row), piece, n_tokens and ids, little-endian unsigned 32-bit integers."""
    short, long = _parts(df, doc_id, text)
    return _encoded(short, path).unionByName(_encoded(long, path))


def _encoded(parts: DataFrame, path: str) -> DataFrame:
    """Consecutive parts with the same row and piece, put together and encoded."""

    def scan(batches) -> Iterator[pa.RecordBatch]:
        encoder = encoding(path)

        def made(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            ids = [np.array(encoder.encode_ordinary("".join(r[3])), "<u4") for r in rows]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((kind, pa.int64(), pa.int64()))]
            columns += [pa.array(list(map(len, ids)), pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "piece", "n_tokens", "ids"])

        ready: list[tuple] = []
        size, kind = 0, pa.null()
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, row, piece, value in zip(*(c.to_pylist() for c in batch.columns)):
                value = value or ""
                if ready and (row, piece) == ready[-1][1:3]:
                    ready[-1][3].append(value)
                else:
                    if size > BATCH_CHARS:
                        yield made(ready, kind)
                        ready, size = [], 0
                    ready.append((doc, row, piece, [value]))
                size += len(value)
        if ready:
            yield made(ready, kind)

    kind = parts.schema["doc_id"].dataType.simpleString()
    return parts.mapInArrow(scan, f"doc_id {kind}, row bigint, piece bigint, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with the bytes of each piece."""

    def scan(batches) -> Iterator[pa.RecordBatch]:
        core = encoding(path)
        for batch in batches:
            ids = batch.column(batch.schema.names.index("ids"))
            data = [core.decode_bytes(np.frombuffer(x.as_py(), "<u4").tolist()) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(data, pa.binary())], [*batch.schema.names, "decoded"]
            )

    return encoded.mapInArrow(scan, _ddl(encoded) + ", decoded binary")


def round_trip(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text encoded and decoded again: doc_id, n_tokens, and the SHA-256 of its ids
    and of its decoded bytes.

    The ids of a long text's pieces are decoded in order and pass through running hashes,
    so that it need not stand in a task again."""
    short, long = _parts(df, doc_id, text)
    whole = decode(_encoded(short, path), path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
    pieces = (
        _encoded(long, path)
        .repartition(partitions(df.sparkSession), "row")
        .sortWithinPartitions("row", "piece")
        .select("doc_id", "row", "n_tokens", "ids")
    )
    names = whole.columns

    def scan(batches) -> Iterator[pa.RecordBatch]:
        core = encoding(path)
        at, kind = None, pa.null()

        def made() -> pa.RecordBatch:
            values = (doc, n, ids.hexdigest(), data.hexdigest())
            types = (kind, pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for doc_id_, row, count, encoded in zip(*(c.to_pylist() for c in batch.columns)):
                if row != at:
                    if at is not None:
                        yield made()
                    doc, at, n, ids, data = doc_id_, row, 0, hashlib.sha256(), hashlib.sha256()
                n += count
                ids.update(encoded)
                data.update(core.decode_bytes(np.frombuffer(encoded, "<u4").tolist()))
        if at is not None:
            yield made()

    return whole.unionByName(pieces.mapInArrow(scan, _ddl(whole)))
