"""Near duplicates by bottom-k sketches of word shingles.

A document's set is its distinct shingles of five words.  One hash function orders all
shingles; the ``SKETCH`` smallest hashes of a set are kept.  Inverted lists of the kept
values give candidates, the union sketch of two documents estimates their similarity and
filters, and the Jaccard similarity of the whole sets decides.

* Documents with the same set are one class, found by digest and represented by one row,
  so exact copies never meet.
* Values kept by at most ``COLD`` classes are cold.  The list of a cold value gives all of
  its pairs, for the ``LISTED`` smallest values of a class, and for all values of classes
  that are kept whole.
* Similar classes that share no cold value in these lists share hot ones.  Both then have
  many: three quarters of their values where sets are kept whole, and otherwise, up to 5
  standard deviations, HOT of SKETCH.  No other class enters the hot lists.  Those that do
  form large groups.  There, a class stands in the lists of HOT_LISTED of its hot values, of
  which a similar one shares three quarters or more.
* Members of a hot list are first (ROUNDS times) compared with its centres: those whose values are held
  by most classes on average, as the text is from which the others were made.  This ties most of
  a group together with a number of comparisons proportional to its size.
* What is left in several components of a list is peeled: a class can only be similar to one
  of another component if three quarters of its whole set occur in other components, which
  counts of shingles tell.  So classes that share but a passage, or were edited too much,
  drop out without being paired.  Classes dropped can give others the same end, so
  this is done PEELS times.
* The rest is compared on whole sets, those outside a list's largest component with all of
  it, in tiles of at most TILE shingles a side.  Only links come out of a tile, one for each
  class and component.  So nothing is dropped, and pairs that are connected already
  are not compared again.

Null texts, empty texts and texts of white space have an empty set and are linked with
nothing.  A document with fewer than five words has its whole sequence as one shingle.
Rows are numbered, and a class's text is that of the row with its number, so rows with
equal or null ids are each linked by their own set.  Sets are made of whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import partitions, stored
from shelfmark.llm.components import components

SHINGLE = 5
PERCENT = 75
SKETCH = 64
LISTED = 24
COLD = 32
HOT = 27
WHOLE = 48  # sets up to this size, and all that are similar to them, are kept whole
LEAST_ESTIMATE = 0.45  # 5.5 standard deviations below 0.75 for SKETCH values
HOT_LISTED = 13  # smallest hot values of a class whose lists it enters
STAR_LISTED = 4  # of these, the lists in which it is compared with centres
CENTRES = 2
ROUNDS = 1
PEELS = 2
TILE = 1 << 18  # shingles of the members on one side of a tile
CHUNK = 1024  # members and shingles that a task multiplies at once
PARTNERS = 64  # partners of one document that follow it in a task

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_remembered: dict[str, int] = {}


def _lower(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(LOWER)


def _words(text: str) -> list[str]:
    return text.split() if text.isascii() and not re.search("[\x1c-\x1f]", text) else WORD.findall(text)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    words = _words(_lower(text or ""))
    if not words:
        return np.zeros(0, np.uint64)
    if len(_remembered) > 500_000:
        _remembered.clear()
    hashes = []
    for word in words:
        value = _remembered.get(word)
        if value is None:
            value = _remembered[word] = xxhash.xxh3_64_intdigest(word)
        hashes.append(value)
    h = np.array(hashes, np.uint64)
    n = min(SHINGLE, len(words))
    out = np.full(len(words) - n + 1, 0x9E3779B97F4A7C15 + n, np.uint64)
    for k in range(n):
        out = _mixed(out * np.uint64(0x100000001B3) ^ h[k : len(words) - n + 1 + k])
    return np.unique(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def similar(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets is at least PERCENT."""
    small, large = sorted((len(one), len(other)))
    if 100 * small < PERCENT * large or not small:
        return False
    common = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * common >= PERCENT * (len(one) + len(other) - common)


def _signed(values: np.ndarray) -> np.ndarray:
    """Unsigned order as signed 64-bit integers."""
    return (values ^ np.uint64(1 << 63)).view(np.int64)


def sketches(df: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str = "row") -> DataFrame:
    """doc_id, row, n_shingles, digest of the set (two halves) and its sketch, smallest first."""

    def scan(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sets = [shingle_set(v.as_py()) for v in part.column(1)]
                digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([(d >> 64) - (1 << 63) for d in digests], pa.int64()),
                        pa.array([(d & (1 << 64) - 1) - (1 << 63) for d in digests], pa.int64()),
                        pa.array([_signed(s[:SKETCH]) for s in sets], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "row", "n_shingles", "high", "low", "sketch"],
                )

    return df.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
        F.col(row).cast("bigint").alias("row"),
    ).mapInArrow(
        scan, "doc_id bigint, row bigint, n_shingles bigint, high bigint, low bigint, sketch array<bigint>"
    )


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and union sketch allow the similarity."""
    one = classes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    other = classes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    both = pairs.join(one, "a").join(other, "b")
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, SKETCH)
    shared = F.size(F.array_intersect(F.array_intersect(union, F.col("s_a")), F.col("s_b")))
    return both.where(fits).where(shared >= F.size(union) * LEAST_ESTIMATE).select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar.

    A document's text comes first and its partners follow, PARTNERS at a time, so a task
    holds two sets at once however many partners a document has."""
    degrees = pairs.groupBy("a").agg(F.count("*").alias("degree"))
    part = F.pmod(F.xxhash64("b"), F.ceil(F.col("degree") / PARTNERS).cast("bigint"))
    dealt = pairs.join(degrees, "a").withColumn("part", part)
    heads = dealt.select("a", "part").distinct().join(texts.withColumnRenamed("node", "a"), "a")
    rows = heads.select("a", "part", F.lit(None).cast("bigint").alias("b"), "text").unionByName(
        dealt.join(texts.withColumnRenamed("node", "b"), "b").select("a", "part", "b", "text")
    )

    def compare(batches) -> Iterator[pa.RecordBatch]:
        head, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            found: list[tuple[int, int]] = []
            for a, b, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                if b is None:
                    if a != head:
                        head, own = a, shingle_set(text.as_py())
                elif similar(own, shingle_set(text.as_py())):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

    spark = pairs.sparkSession
    return (
        rows.repartition(partitions(spark), "a", "part")
        .sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
        .mapInArrow(compare, "a bigint, b bigint")
    )


def _with_components(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` (value, node, ...) with each node's component."""
    found = components(links).withColumnRenamed("component", "_component")
    return (
        members.join(found, "node", "left")
        .withColumn("component", F.coalesce("_component", "node"))
        .drop("_component")
    )


def _left_over(members: DataFrame) -> DataFrame:
    """Members of the lists that hold more than one component; ``main`` marks those in
    the component with most members of the list."""
    sizes = members.groupBy("value", "component").agg(F.count("*").alias("size"))
    top = sizes.groupBy("value").agg(
        F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("n_components")
    )
    return (
        members.join(top.where("n_components > 1"), "value")
        .withColumn("main", F.col("component") == F.col("top.component"))
        .drop("top", "n_components")
    )


def _centre_pairs(left: DataFrame, number: int) -> DataFrame:
    """Pairs of members with a few centres of their list, the same for a whole list:
    from its main component for the others, and from the others for all."""
    slot = F.pmod(F.xxhash64("node", F.lit(number)), F.lit(CENTRES))
    centres = (
        left.withColumn("slot", slot)
        .groupBy("value", "main", "slot")
        .agg(F.max_by(F.struct("node", "component"), F.struct("popularity", "node")).alias("centre"))
        .select("value", "centre.*", F.col("main").alias("centre_main"))
        .withColumnsRenamed({"node": "centre", "component": "centre_component"})
    )
    pairs = left.join(centres, "value").where("component <> centre_component AND NOT (main AND centre_main)")
    return pairs.select(F.least("node", "centre").alias("b"), F.greatest("node", "centre").alias("a")).distinct()


def _sets(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """node, component, n and the whole set, as bytes, of each node (node, component)."""

    def scan(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sets = [shingle_set(v.as_py()) for v in part.column(2)]
                columns = [
                    part.column(0),
                    part.column(1),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([x.tobytes() for x in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["node", "component", "n", "shingles"])

    return nodes.join(texts, "node").select("node", "component", "text").mapInArrow(
        scan, "node bigint, component bigint, n bigint, shingles binary"
    )


def _peeled(sets: DataFrame) -> DataFrame:
    """The sets of which PERCENT of the shingles or more occur in other components."""

    def scan(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                values = [np.frombuffer(v.as_py(), np.int64) for v in part.column(2)]
                sizes = [len(v) for v in values]
                columns = [np.repeat(part.column(i).to_numpy(), sizes) for i in (0, 1)]
                columns.append(np.concatenate(values))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "component", "shingle"])

    each = sets.select("node", "component", "shingles").mapInArrow(
        scan, "node bigint, component bigint, shingle bigint"
    )
    spread = each.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    spread = spread.where("low <> high").select("shingle")
    held = each.select("node", "shingle").join(spread, "shingle").groupBy("node").agg(F.count("*").alias("held"))
    return sets.join(held, "node").where(F.col("held") * 100 >= F.col("n") * PERCENT).drop("held")


def _joined(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All values of the sets in a row, and the set each belongs to."""
    return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])


def common_counts(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set with each other set."""
    (a, a_row), (b, b_row) = _joined(one), _joined(other)
    words = np.intersect1d(a, b)
    keep_a, keep_b = np.isin(a, words), np.isin(b, words)
    a, a_row = np.searchsorted(words, a[keep_a]), a_row[keep_a]
    b, b_row = np.searchsorted(words, b[keep_b]), b_row[keep_b]
    order_a, order_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    a, a_row, b, b_row = a[order_a], a_row[order_a], b[order_b], b_row[order_b]
    counts = np.zeros((len(one), len(other)), np.float32)
    for start in range(0, len(words), CHUNK):
        sides = []
        for value, row, n in ((a, a_row, len(one)), (b, b_row, len(other))):
            low, high = np.searchsorted(value, [start, start + CHUNK])
            side = np.zeros((n, min(CHUNK, len(words) - start)), np.float32)
            side[row[low:high], value[low:high] - start] = 1
            sides.append(side)
        counts += sides[0] @ sides[1].T
    return counts


def tile_links(visitors: list[tuple], members: list[tuple]) -> list[tuple[int, int]]:
    """For (node, component, set) on both sides: a similar member of each other component."""
    found: list[tuple[int, int]] = []
    for i in range(0, len(visitors), CHUNK):
        left = visitors[i : i + CHUNK]
        for j in range(0, len(members), CHUNK):
            right = members[j : j + CHUNK]
            common = common_counts([x[2] for x in left], [x[2] for x in right]).astype(np.int64)
            sizes = np.add.outer([len(x[2]) for x in left], [len(x[2]) for x in right])
            apart = np.not_equal.outer([x[1] for x in left], [x[1] for x in right])
            near = (100 * common >= PERCENT * (sizes - common)) & apart
            components_ = np.array([x[1] for x in right])
            for row in np.nonzero(near.any(axis=1))[0].tolist():
                at = np.nonzero(near[row])[0]
                _, first = np.unique(components_[at], return_index=True)
                found += [(left[row][0], right[k][0]) for k in at[first].tolist()]
    return found


def _residual_links(left: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between members of a list that are in different components.

    Members outside the main component visit all members, block by block on both sides."""
    spark = left.sparkSession
    sets = stored(_sets(left.select("node", "component").distinct(), texts), "sets")
    for number in range(PEELS):
        sets = stored(_peeled(sets), f"peeled-{number}")
    members = stored(_left_over(left.drop("main").join(sets.select("node", "n"), "node")), "peeled-lists")
    sizes = members.groupBy("value").agg(
        F.ceil(F.sum("n") / TILE).alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.sum(F.when(~F.col("main"), F.col("n"))) / TILE)).alias("visitor_blocks"),
    )
    sized = members.join(sizes, "value")

    def block(count: str):
        return F.pmod(F.xxhash64("node", F.lit(7)), F.col(count)).cast("bigint")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count).cast("bigint") - 1))

    standing = sized.select("value", every("visitor_blocks").alias("i"), block("blocks").alias("j"), F.lit(False).alias("visits"), "node")
    visiting = sized.where(~F.col("main")).select(
        "value", block("visitor_blocks").alias("i"), every("blocks").alias("j"), F.lit(True).alias("visits"), "node"
    )
    rows = standing.unionByName(visiting).join(sets, "node")

    def compare(batches) -> Iterator[pa.RecordBatch]:
        at, sides = None, ([], [])

        def made() -> pa.RecordBatch:
            found = tile_links(sides[1], sides[0]) if sides[1] and sides[0] else []
            return pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

        for batch in batches:
            for value, i, j, visits, node, component, data in zip(*(c.to_pylist() for c in batch.columns)):
                if (value, i, j) != at:
                    yield made()
                    at, sides = (value, i, j), ([], [])
                sides[visits].append((node, component, np.frombuffer(data, np.int64)))
        yield made()

    return (
        rows.repartition(partitions(spark), "value", "i", "j")
        .sortWithinPartitions("value", "i", "j")
        .select("value", "i", "j", "visits", "node", "component", "shingles")
        .mapInArrow(compare, "a bigint, b bigint")
    )


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """Per row of ``df``: doc_id, n_shingles, component_id (the smallest doc_id reachable
    by links, its own included) and kept (doc_id = component_id).

    With ``row``, a column that numbers the rows, that number and ``stays`` come along:
    true for one row of each component, the first by doc_id and number."""
    numbered = row is not None
    if not numbered:  # stored, as a number has to mean the same row whenever it is read
        df = stored(
            df.select(
                F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row")
            ),
            "numbered",
        )
        doc_id, text, row = "doc_id", "text", "row"
    rows = stored(sketches(df, doc_id, text, row), "sketches")
    full = rows.where("n_shingles > 0")
    # One class per set.  Nodes are numbered by class, as ids may repeat or be null.
    classes = stored(
        full.groupBy("high", "low")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"),
            F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    links = _links(df, classes, text, row)
    parts = stored(components(links), "components")
    named = classes.select("high", "low", "node", "doc_id", "first").join(parts, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min("first").alias("first"))
    named = named.drop("first").join(least, "component").select("high", "low", "component_id", "first.row")
    found = full.join(named.withColumnRenamed("row", "_first"), ["high", "low"]).select(
        "doc_id", "row", "n_shingles", "component_id", F.col("row").eqNullSafe(F.col("_first")).alias("stays")
    )
    alone = rows.where("n_shingles = 0").select(
        "doc_id", "row", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("stays")
    )
    out = found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return out if numbered else out.drop("row", "stays")


def _links(df: DataFrame, classes: DataFrame, text: str, row: str) -> DataFrame:
    """Links between classes: all that lie in cold lists, and enough in hot ones that
    every class is in its component."""
    values = classes.select("node", "n", F.posexplode("sketch").alias("place", "value"))
    counts = values.groupBy("value").agg(F.count("*").alias("size")).where("size > 1")
    lists = stored(values.join(counts, "value").select("value", "node", "n", "place", "size", (F.col("size") > COLD).alias("hot")), "lists")

    cold = lists.where(f"NOT hot AND (place < {LISTED} OR n <= {SKETCH})").select("value", "node")
    pairs = (
        cold.join(cold.withColumnRenamed("node", "b"), "value")
        .where("node > b")
        .select(F.col("node").alias("a"), "b")
        .distinct()
    )
    pairs = stored(_estimated(pairs, classes), "cold-pairs")

    # A class's values, at most SKETCH, meet in one row, so no join brings them together again.
    n_hot = F.size("hot")
    enough = F.when(F.col("n") <= WHOLE, 100 * n_hot >= PERCENT * F.col("n")).otherwise(n_hot >= HOT)
    sizes = F.aggregate("hot", F.lit(0).cast("bigint"), lambda total, x: total + x["size"])
    members = stored(
        lists.where("hot")
        .groupBy("node", "n")
        .agg(F.array_sort(F.collect_list(F.struct("place", "value", "size"))).alias("hot"))
        .where(enough)
        .select(
            "node",
            F.posexplode(F.slice("hot", 1, HOT_LISTED)).alias("rank", "member"),
            (sizes / F.least("n", F.lit(SKETCH))).alias("popularity"),
        )
        .select("member.value", "node", (F.col("rank") + 1).alias("rank"), "popularity"),
        "hot-members",
    )
    wanted = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).unionByName(
        members.select(F.col("node").alias("a"))
    ).distinct()
    # The texts of the classes that are compared, each from its first row.
    chosen = classes.join(wanted.withColumnRenamed("a", "node"), "node").select("node", F.col("first.row").alias("_row"))
    texts = _texts(df, chosen, text, row)
    links = stored(verified(pairs, texts), "cold-links")

    for number in range(ROUNDS):
        near = members.where(f"rank <= {STAR_LISTED}")
        left = stored(_left_over(_with_components(near, links)), f"left-{number}")
        if left.isEmpty():
            break
        found = verified(_estimated(_centre_pairs(left, number), classes), texts)
        links = stored(links.unionByName(found), f"links-{number}")
    left = stored(_left_over(_with_components(members, links)), "left")
    if not left.isEmpty():
        links = stored(links.unionByName(_residual_links(left, texts)), "links")
    return links


def _texts(df: DataFrame, chosen: DataFrame, text: str, row: str) -> DataFrame:
    """node and text of the chosen classes, one row each."""
    docs = df.select(F.col(row).cast("bigint").alias("_row"), F.col(text).alias("text"))
    return stored(docs.join(chosen, "_row").select("node", "text"), "texts")
