"""Quality by the perplexity of an interpolated modified Kneser-Ney model.

The model has character n-grams of ``ORDER`` symbols, counted over trusted texts.  Its
tables (discounted probability and back-off weight per n-gram of each order) are built by
grouping and joining counts.  Documents are scored in shards, runs of neighbouring rows:
each shard asks for the probabilities of its distinct n-grams, requests meet the tables
in joins, and the answers go to where the shard's texts are.  So what scoring gathers
grows with the corpus, and no task holds the model.  One trusted document in five is not
trained on; a document is kept if its perplexity is at most the ``QUANTILE`` of these in
its language, times ``MARGIN``.

All trusted documents are counted or held out, joined by id.  All documents are scored,
on whole texts.

Null and empty texts have no perplexity and are not kept.  Documents without a language,
or in one without held-out trusted documents, go by the quantile over all held-out ones,
or over all trusted ones where none is held out; without any trusted text there is no
model, and all documents with text are kept.  Repeated rows
are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import blocks, code_points, held_out, partitions, stored

ORDER = 4
BITS = 16  # of a symbol within an n-gram's number
START = 2  # symbol before a text
OTHER = 0xFFFE  # stands for all characters beyond the first 2 ** BITS
SHARD_ROWS = 2400
SHARD_CHARS = 8_000_000  # a shard is closed at this size, too
QUANTILE = 0.995
MARGIN = 1.1


def _numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram number that ends at each character, and each text's length."""
    points, lengths = code_points(["\x02" * (ORDER - 1) + t for t in texts])
    symbols = np.where(points > 0xFFFD, OTHER, points).astype(np.uint64)
    grams = symbols[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        grams |= symbols[ORDER - 1 - back : len(symbols) - back] << np.uint64(BITS * back)
    # Windows that reach back into the text before are those of the start symbols.
    own = np.ones(len(symbols), bool)
    starts = np.cumsum(lengths) - lengths
    for k in range(ORDER - 1):
        own[starts + k] = False
    return grams[own[ORDER - 1 :]].view(np.int64), lengths - (ORDER - 1)


def _distinct(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and their counts, block by block."""
    parts = [np.unique(_numbers(b)[0], return_counts=True) for b in blocks(texts)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return grams, np.bincount(place, np.concatenate([p[1] for p in parts]), len(grams)).astype(np.int64)


def counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """gram and n over all texts; each task sends a row per distinct n-gram."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            found = _distinct([x.as_py() or "" for x in batch.column(0)])
            grams = np.concatenate([total.get("grams", np.zeros(0, np.int64)), found[0]])
            sizes = np.concatenate([total.get("sizes", np.zeros(0, np.int64)), found[1]])
            total["grams"], place = np.unique(grams, return_inverse=True)
            total["sizes"] = np.bincount(place, sizes, len(total["grams"])).astype(np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(total["grams"]), pa.array(total["sizes"])], ["gram", "n"])

    return texts.select(text).mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def _context(gram: Column | str) -> Column:
    return F.shiftrightunsigned(gram, BITS)


def _suffix(gram: Column | str, order: int) -> Column:
    """The last ``order`` symbols of an n-gram."""
    return (F.col(gram) if isinstance(gram, str) else gram).bitwiseAND(F.lit((1 << BITS * order) - 1))


def _discounts(table: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more."""
    row = table.agg(*[F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (row[f"n{k}"] for k in (1, 2, 3, 4))
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.1), k - 0.1) for k, d in zip((1, 2, 3), raw))  # type: ignore[return-value]


def tables(top: DataFrame) -> tuple[dict[int, DataFrame], dict[int, DataFrame], float]:
    """Per order: gram and p of the seen n-grams; context and backoff; and the share
    that a symbol never seen gets."""
    by_order = {ORDER: top}
    for order in range(ORDER - 1, 0, -1):
        # How many different symbols stand before the shorter n-gram.
        by_order[order] = by_order[order + 1].groupBy(_suffix("gram", order).alias("gram")).agg(F.count("*").alias("n"))
    probabilities: dict[int, DataFrame] = {}
    backoffs: dict[int, DataFrame] = {}
    symbols = by_order[1].count()
    floor = 1.0 / (symbols + 1)
    for order in range(1, ORDER + 1):
        table = by_order[order]
        d1, d2, d3 = _discounts(table)
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        contexts = (
            table.groupBy(_context("gram").alias("context"))
            .agg(F.sum("n").alias("total"), F.sum(discount).alias("spared"))
            .select("context", "total", (F.col("spared") / F.col("total")).alias("backoff"))
        )
        backoffs[order] = stored(contexts.select("context", "backoff"), f"backoff-{order}")
        own = table.withColumn("context", _context("gram")).join(contexts, "context")
        share = (F.col("n") - discount) / F.col("total")
        if order == 1:
            p = own.select("gram", (share + F.col("backoff") * F.lit(floor)).alias("p"))
        else:
            lower = probabilities[order - 1].select(F.col("gram").alias("shorter"), F.col("p").alias("lower"))
            p = (
                own.withColumn("shorter", _suffix("gram", order - 1))
                .join(lower, "shorter")
                .select("gram", (share + F.col("backoff") * F.col("lower")).alias("p"))
            )
        probabilities[order] = stored(p, f"probabilities-{order}")
    unseen = backoffs[1].first()
    return probabilities, backoffs, (unseen.backoff if unseen else 1.0) * floor


def answered(requests: DataFrame, model: tuple[dict[int, DataFrame], dict[int, DataFrame], float]) -> DataFrame:
    """gram and log of its probability for distinct n-grams, backing off where unseen."""
    probabilities, backoffs, unseen = model
    rows = requests.select("gram")
    for order in range(ORDER, 0, -1):
        seen = probabilities[order].select(F.col("gram").alias(f"g{order}"), F.col("p").alias(f"p{order}"))
        rows = rows.join(seen, _suffix("gram", order) == F.col(f"g{order}") if order < ORDER else F.col("gram") == F.col(f"g{order}"), "left").drop(f"g{order}")
        if order > 1:
            back = backoffs[order].select(F.col("context").alias("c"), F.col("backoff").alias(f"b{order}"))
            gram = _suffix("gram", order) if order < ORDER else F.col("gram")
            rows = rows.join(back, _context(gram) == F.col("c"), "left").drop("c")
    value = F.coalesce("p1", F.lit(unseen))
    for order in range(2, ORDER + 1):
        value = F.coalesce(F.col(f"p{order}"), F.coalesce(F.col(f"b{order}"), F.lit(1.0)) * value)
    return rows.select("gram", F.log(value).cast("float").alias("logp"))


def _shards(batches) -> Iterator[tuple[int, list, list[str]]]:
    """Runs of rows: a number that is the same in every pass, the ids, the texts."""
    number, names, texts, size, rows = None, [], [], 0, 0
    for batch in batches:
        for place, name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if number is None:
                number = place
            names.append(name)
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            rows += 1
            if rows >= SHARD_ROWS or size >= SHARD_CHARS:
                yield number, names, texts
                number, names, texts, size, rows = None, [], [], 0, 0
    if number is not None:
        yield number, names, texts


def _requests(batches) -> Iterator[pa.RecordBatch]:
    for number, _, texts in _shards(batches):
        grams = _distinct(texts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), number)), pa.array(grams)], ["shard", "gram"])


def _packed(batches) -> Iterator[pa.RecordBatch]:
    for number, names, texts in _shards(batches):
        table = pa.table({"row": pa.array(names, pa.int64()), "text": pa.array(texts, pa.large_string())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        blob = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([None], pa.int64()), pa.array([None], pa.float32()), pa.array([blob], pa.binary())],
            ["shard", "gram", "logp", "texts"],
        )


def _scored(batches) -> Iterator[pa.RecordBatch]:
    """A shard's answers come first, sorted; then its texts are scored."""
    shard, grams, logs = None, [], []
    for batch in batches:
        numbers = batch.column(0).to_numpy()
        is_text = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.append(True, (numbers[1:] != numbers[:-1]) | (is_text[1:] != is_text[:-1])))
        for start, stop in zip(starts, np.append(starts[1:], len(numbers))):
            if numbers[start] != shard:
                shard, grams, logs = numbers[start], [], []
            if not is_text[start]:
                grams.append(batch.column(1).slice(start, stop - start).to_numpy())
                logs.append(batch.column(2).slice(start, stop - start).to_numpy())
                continue
            known, values = np.concatenate(grams or [np.zeros(0, np.int64)]), np.concatenate(logs or [np.zeros(0, np.float32)])
            raw = zstandard.ZstdDecompressor().decompress(batch.column(3)[start].as_py(), max_output_size=1 << 31)
            table = pa.ipc.open_stream(raw).read_all()
            means: list[float | None] = []
            sizes: list[int] = []
            for texts in blocks(x.as_py() for x in table["text"]):
                numbers_, lengths = _numbers(texts)
                sums = np.concatenate([[0.0], np.cumsum(values[np.searchsorted(known, numbers_)], dtype=np.float64)])
                ends = np.cumsum(lengths)
                total = sums[ends] - sums[ends - lengths]
                means += [float(np.exp(-t / n)) if n else None for t, n in zip(total, lengths)]
                sizes += lengths.tolist()
            yield pa.RecordBatch.from_arrays(
                [table["row"].combine_chunks(), pa.array(sizes, pa.int64()), pa.array(means, pa.float64())],
                ["row", "n_symbols", "perplexity"],
            )


def perplexities(df: DataFrame, model, text: str = "text", row: str = "row") -> DataFrame:
    """row, n_symbols and perplexity of every text of ``df``; ``row`` numbers its rows."""
    spark = df.sparkSession
    rows = df.select(F.monotonically_increasing_id().alias("place"), F.col(row).cast("bigint").alias("row"), F.col(text).alias("text"))
    requests = stored(rows.mapInArrow(_requests, "shard bigint, gram bigint"), "requests")
    known = stored(answered(requests.select("gram").distinct(), model), "answers")
    answers = requests.join(known, "gram").select("shard", "gram", "logp", F.lit(None).cast("binary").alias("texts"))
    texts = rows.mapInArrow(_packed, "shard bigint, gram bigint, logp float, texts binary")
    return (
        answers.unionByName(texts)
        .repartition(partitions(spark), "shard")
        .sortWithinPartitions("shard", F.col("texts").isNotNull(), "gram")
        .mapInArrow(_scored, "row bigint, n_symbols bigint, perplexity double")
    )


def judge(
    df: DataFrame, trusted_ids: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Per row: doc_id, lang, n_symbols, perplexity, threshold, kept.

    ``trusted_ids`` has one column with the ids of trusted documents."""
    name = trusted_ids.columns[0]
    ids = trusted_ids.select(F.col(name).cast("bigint").alias("_id")).where("_id IS NOT NULL").distinct()
    ids = stored(ids, "trusted")
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    # Joined by id at every size: what is moved then grows as the documents do.
    trusted = docs.join(ids.hint("merge"), docs["doc_id"] == ids["_id"], "left_semi")
    top = stored(counts(trusted.where("text IS NOT NULL").where(~held_out(F.col("doc_id")))), "counts")
    numbered = docs.withColumn("row", F.monotonically_increasing_id())
    scores = stored(perplexities(numbered, tables(top)), "perplexities")
    rows = numbered.select("row", "doc_id", "lang").join(scores, "row")
    rows = rows.join(ids.withColumn("trusted", F.lit(True)), F.col("doc_id") == F.col("_id"), "left").drop("_id")
    rows = stored(rows, "scored")
    marked = rows.where("trusted AND perplexity IS NOT NULL")
    limit = F.percentile_approx("perplexity", QUANTILE, 10_000) * MARGIN
    unseen = marked.where(held_out(F.col("doc_id")))
    whole = unseen.agg(limit.alias("t")).first().t
    if whole is None:
        whole = marked.agg(limit.alias("t")).first().t
    by_lang = unseen.where("lang IS NOT NULL").groupBy("lang").agg(limit.alias("threshold"))
    return (
        rows.join(by_lang, "lang", "left")
        .withColumn("threshold", F.coalesce("threshold", F.lit(whole if whole is not None else float("inf"))))
        .select(
            "doc_id", "lang", "n_symbols", "perplexity", "threshold",
            F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("kept"),
        )
    )
