"""A trie of conversations' turns, built as a burst trie.

A turn's id is a digest of its role and text, and a conversation is the sequence of its
turns' ids.  Equal sequences are one, with the number of conversations and the smallest id.

* Under a trie head, a container holds the rest of every sequence that begins with the
  head's turns.  At first one container holds all.
* A container with more than ``LIMIT`` turns bursts: what all its sequences begin with
  becomes a chain of nodes, and the next turn id after it deals the sequences to the
  containers of new heads.  So a round at least splits each of them, and the rounds end when
  all containers are small or hold one sequence.
* The containers are dealt over tasks; each is sorted and swept once with a stack of open
  nodes, which come out as they close.  The heads' counts are then added up from the last
  round to the first.
* Sequences stand in pieces of ``PIECE`` turns.  Where one goes on, the node at which its
  piece ends is the head of the first container for what follows, so very long
  conversations never stand in one row or task either.
* The ids of the conversations that end at a node are joined in blocks of neighbouring ids
  first and run through the digest block by block.

Turns are numbered by ranges of (conversation, turn, id), not by conversation.  Turns with a
null conversation belong to none and are left out; null roles and texts are empty; null
turn numbers come first, and turns with equal numbers are in the order of their ids.
Repeated rows are turns of their own.  An empty table has no nodes, not even a root.
Conversation ids are whole numbers.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import partitions, stored

LIMIT = 1 << 16  # turns of a container that is swept as it is
PIECE = 1024  # turns of a conversation that stand in one row
ID_BITS = 12  # 2 ** ID_BITS neighbouring conversation ids are joined at a time

LEAD = 6  # a conversation takes over fewer turns than this
FAMILY = 100  # conversations that take over the turns of one

NODE = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def digest(text: Column) -> Column:
    """128 bits of a text's SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def turns(df: DataFrame) -> DataFrame:
    """conv_id, place (from 1), id and chars (code points of the text) of every turn."""
    spark = df.sparkSession
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    rows = df.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("id"),
        F.length(text).alias("chars"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("id")]
    ranged = stored(rows, "turns").repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    places = _counted(ranged.select(F.spark_partition_id().alias("part"), "conv_id", "id", "chars"))
    return _across_parts(stored(places, "places"))


def _counted(ranged: DataFrame) -> DataFrame:
    """Sorted rows with their place among those of the same conversation and part."""

    def scan(batches) -> Iterator[pa.RecordBatch]:
        at, place = None, 0
        for batch in batches:
            places = []
            for conv in batch.column(1).to_pylist():
                place = place + 1 if conv == at else 1
                at = conv
                places.append(place)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], [*batch.schema.names, "place"])

    return ranged.mapInArrow(scan, "part int, conv_id bigint, id binary, chars int, place bigint")


def _across_parts(places: DataFrame) -> DataFrame:
    """Add the turns that a conversation has in earlier parts.

    Only the last conversation of a part can go on in the next ones, so there is at most
    one row to add for each two neighbouring parts."""
    last = places.groupBy("part").agg(F.max("conv_id").alias("conv_id"))
    sizes = places.join(last, ["part", "conv_id"]).groupBy("conv_id", "part").agg(F.max("place").alias("size"))
    # Parts in which such a conversation only begins to stand are reached by id.
    found = places.where("place = 1").select("part", "conv_id").join(sizes.withColumnRenamed("part", "before"), "conv_id")
    offsets = found.where("before < part").groupBy("part", "conv_id").agg(F.sum("size").alias("offset"))
    return places.join(offsets, ["part", "conv_id"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("offset", F.lit(0))).alias("place"), "id", "chars"
    )


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id) and their turns after each took over the first h turns of
    the first conversation of its hundred and dropped its own first h ones."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % LEAD
    turn = F.struct("place", "id", "chars")
    heads = (
        own.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < LEAD))
        .groupBy(F.col("conv_id").alias("head"))
        .agg(F.sort_array(F.collect_list(turn)).alias("first"))
    )
    members = own.where("place = 1").select("conv_id")
    led = stored(
        members.withColumn("head", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .join(heads, "head", "left")
        .select("conv_id", F.slice(F.coalesce("first", F.array().cast("array<struct<place:bigint,id:binary,chars:int>>")), F.lit(1), h.cast("int")).alias("lead")),
        "led",
    )
    lead = led.select("conv_id", F.explode("lead").alias("t")).select("conv_id", "t.place", "t.id", "t.chars")
    rest = own.where(F.col("place") > h).join(led.select("conv_id", F.size("lead").alias("taken")), "conv_id")
    rest = rest.select("conv_id", (F.col("place") - h + F.col("taken")).alias("place"), "id", "chars")
    return led.select("conv_id"), lead.unionByName(rest)


def _ends(rows: DataFrame) -> DataFrame:
    """For (key, conv_id): the digest of each key's sorted ids, joined by commas."""
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string"))
    blocks = rows.groupBy("key", F.shiftright("conv_id", ID_BITS).alias("block")).agg(F.array_join(ids, ",").alias("ids"))

    def scan(batches) -> Iterator[pa.RecordBatch]:
        at, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key == at:
                    state.update(b",")
                else:
                    if at is not None:
                        done.append((at, state.hexdigest()))
                    at, state = key, hashlib.sha256()
                state.update(ids.encode())
            yield made(done)
        if at is not None:
            yield made([(at, state.hexdigest())])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["key", "ends"])

    in_order = blocks.repartition(partitions(rows.sparkSession), "key").sortWithinPartitions("key", "block")
    return in_order.select("key", "ids").mapInArrow(scan, "key binary, ends string")


def trie(members: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie over the turns (conv_id, place, id, chars) of the
    conversations ``members`` (conv_id), of which some may have no turn."""
    pieces = stored(
        turns.groupBy("conv_id", F.floor((F.col("place") - 1) / PIECE).alias("piece"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "id", "chars"))).alias("t"))
        .select("conv_id", "piece", F.col("t.id").alias("ids"), F.col("t.chars").alias("lens")),
        "pieces",
    )
    last = pieces.agg(F.max("piece")).first()[0] or 0
    levels = _levels(members, pieces, last)
    nodes, below = [], None
    for depth in range(last, -1, -1):
        items = levels[depth]
        if below is None:
            for name in ("b_children", "b_leaves", "b_saved"):
                items = items.withColumn(name, F.lit(0).cast("bigint"))
        else:
            found = below.select(
                F.col("c").alias("key"), F.col("children").alias("b_children"), F.col("leaves").alias("b_leaves"), F.col("saved").alias("b_saved")
            )
            items = items.join(found, "key", "left").fillna(0, ["b_children", "b_leaves", "b_saved"])
        found_nodes, below = _nodes(items)
        nodes.append(found_nodes)
    root = below.select(
        "depth", F.col("least").alias("conv_id"), F.lit(None).cast("bigint").alias("parent_conv_id"),
        "n", "children", "leaves", "saved", "ends",
    )
    every = reduce(DataFrame.unionByName, nodes, root)
    return every.select(
        "conv_id",
        F.col("depth").cast("bigint").alias("depth"),
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def _levels(members: DataFrame, pieces: DataFrame, last: int) -> list[DataFrame]:
    """For each piece number, the distinct pieces that follow the same turns: key (of the
    turns up to the piece's end), c (that up to its beginning), ids, lens, n, least, ends
    (digest of the conversations that end there), depth and top (the smallest conversation
    at the beginning; null for the first piece)."""
    at_start = F.lit(b"").cast("binary")
    now = pieces.where("piece = 0").drop("piece").withColumn("c", at_start)
    turnless = members.join(now.select("conv_id"), "conv_id", "left_anti")
    no_turns = (F.array().cast("array<binary>").alias("ids"), F.array().cast("array<int>").alias("lens"))
    now = now.unionByName(turnless.select("conv_id", *no_turns, at_start.alias("c")))
    levels: list[DataFrame] = []
    for number in range(last + 1):
        path = F.concat(F.hex("c"), F.lit("/"), F.array_join(F.transform("ids", F.hex), ""))
        rows = stored(now.withColumn("key", digest(path)), f"level-{number}")
        following = pieces.where(F.col("piece") == number + 1).drop("piece")
        ending = rows if number == last else rows.join(following.select("conv_id"), "conv_id", "left_anti")
        items = (
            rows.groupBy("key")
            .agg(
                *(F.first(x).alias(x) for x in ("c", "ids", "lens")),
                F.count("*").alias("n"),
                F.min("conv_id").alias("least"),
            )
            .join(_ends(ending.select("key", "conv_id")), "key", "left")
            .withColumn("depth", F.lit(number * PIECE))
        )
        if number:
            tops = levels[-1].select(F.col("key").alias("c"), F.col("least").alias("top"))
            items = items.join(tops, "c")
        else:
            items = items.withColumn("top", F.lit(None).cast("bigint"))
        levels.append(stored(items, f"items-{number}"))
        now = following.join(rows.select("conv_id", F.col("key").alias("c")), "conv_id")
    return levels


def _nodes(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes below the containers ``c`` of the items, and one row for each of these:
    c, depth, n, least, children, leaves, saved (below it) and ends."""
    now = items.select(
        "c", "ids", "lens", "n", "least", "ends", "depth", "top", "b_children", "b_leaves", "b_saved",
        F.lit(0).alias("at"), F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("len"),
    )
    small, bursts = [], []
    while True:
        now = stored(now, f"containers-{len(bursts)}")
        rest, rest_lens = (F.slice(x, F.col("at") + 1, F.size("ids")) for x in ("ids", "lens"))
        sizes = now.groupBy("c").agg(
            F.sum(F.size("ids") - F.col("at")).alias("turns"),
            F.count("*").alias("sequences"),
            F.min(rest).alias("low"),
            F.max(rest).alias("high"),
            F.min_by(rest_lens, rest).alias("lens"),
            F.sum("n").alias("n"),
            *(F.min(x).alias(x) for x in ("least", "top", "depth", "len", "parent")),
        )
        # What the first and the last one in order begin with, all in between do.
        alike = F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b))
        common = (F.array_position(alike, False) - 1).cast("int")
        big = stored(
            sizes.where((F.col("turns") > LIMIT) & (F.col("sequences") > 1))
            .withColumn("common", common)
            .withColumn("chain", F.slice("lens", F.lit(1), F.col("common")))
            .drop("low", "high", "lens", "turns", "sequences"),
            f"bursts-{len(bursts)}",
        )
        number = F.lit(len(bursts)).alias("round")
        if big.isEmpty():
            small.append(now.select("*", number))
            break
        small.append(now.join(big.select("c"), "c", "left_anti").select("*", number))
        moved = now.join(big.select("c", "common"), "c").withColumn("at", F.col("at") + F.col("common"))
        bursts.append((big, moved.where(F.size("ids") == F.col("at"))))
        onward = moved.where(F.size("ids") > F.col("at"))
        head = digest(F.concat(F.hex("c"), F.lit("/"), F.hex(F.get("ids", F.col("at")))))
        now = onward.select(
            head.alias("c"), "ids", "lens", "n", "least", "ends",
            (F.col("depth") + F.col("common") + 1).alias("depth"), F.lit(None).cast("bigint").alias("top"),
            "b_children", "b_leaves", "b_saved", (F.col("at") + 1).alias("at"),
            F.col("c").alias("parent"), F.get("lens", F.col("at")).alias("len"),
        )
    swept = stored(_swept(reduce(DataFrame.unionByName, small)), "swept")
    nodes = [swept.where("round IS NULL").select(*FOUND)]
    roots = swept.where("round IS NOT NULL").drop("conv_id", "parent_conv_id")
    heads = roots.where(F.col("round") == len(bursts))
    for number in range(len(bursts) - 1, -1, -1):
        found, own = _added_up(*bursts[number], heads)
        nodes.append(stored(found, f"head-nodes-{number}"))
        heads = roots.where(F.col("round") == number).drop("round").unionByName(stored(own, f"heads-{number}"))
    return reduce(DataFrame.unionByName, nodes), heads.drop("round")


FOUND = ["depth", "conv_id", "parent_conv_id", "n", "children", "leaves", "saved", "ends"]


def _added_up(big: DataFrame, stops: DataFrame, children: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of burst containers and of the heads of their children, and the summaries of
    the containers themselves.  ``stops`` are sequences that end where a container branches."""
    own_top = F.coalesce("top", "least")
    tops = big.select(
        F.col("c").alias("parent"), F.when(F.col("common") > 0, F.col("least")).otherwise(own_top).alias("parent_conv_id")
    )
    full = F.col("saved") + (F.col("n") - 1) * F.col("len")
    heads = children.withColumn("saved", full)
    nodes = heads.join(tops, "parent").withColumnRenamed("least", "conv_id").select(*FOUND)
    sums = heads.groupBy(F.col("parent").alias("c")).agg(
        F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    stop = stops.select("c", "ends", "b_children", "b_leaves", "b_saved")
    branch = (
        big.join(sums, "c")
        .join(stop, "c", "left")
        .fillna(0, ["b_children", "b_leaves", "b_saved"])
        .withColumn("children", F.col("children") + F.col("b_children"))
        .withColumn("leaves", F.col("leaves") + F.col("b_leaves"))
        .withColumn("saved", F.col("saved") + F.col("b_saved"))
        .drop("b_children", "b_leaves", "b_saved")
    )
    others = F.col("n") - 1

    def rest(start: Column) -> Column:
        """Code points of the chain from a place on."""
        return F.aggregate(F.slice("chain", start, F.size("chain")), F.lit(0).cast("bigint"), lambda a, x: a + x)

    place, is_last = F.col("place") + 1, F.col("place") + 1 == F.col("common")
    chain = branch.select("*", F.posexplode("chain").alias("place", "_chars")).select(
        (F.col("depth") + place).alias("depth"),
        F.col("least").alias("conv_id"),
        F.when(place == 1, own_top).otherwise(F.col("least")).alias("parent_conv_id"),
        "n",
        F.when(is_last, F.col("children")).otherwise(1).alias("children"),
        "leaves",
        (F.col("saved") + others * rest(place)).alias("saved"),
        F.when(is_last, F.col("ends")).alias("ends"),
    )
    chained = F.col("common") > 0
    summary = branch.select(
        "c", "parent", "depth", "len", "n", "least",
        F.when(chained, 1).otherwise(F.col("children")).cast("bigint").alias("children"),
        "leaves",
        (F.col("saved") + others * rest(F.lit(1))).alias("saved"),
        F.when(~chained, F.col("ends")).alias("ends"),
    )
    return nodes.unionByName(chain), summary


SWEPT = (
    "c binary, parent binary, round int, depth int, len int, least bigint, conv_id bigint, parent_conv_id bigint,"
    " n bigint, children bigint, leaves bigint, saved bigint, ends string"
)


class _Open:
    """A node whose sequences are being read."""

    __slots__ = ("chars", "children", "ends", "held", "leaves", "least", "n", "saved")

    def __init__(self, chars: int) -> None:
        self.chars, self.n, self.least, self.children, self.leaves, self.saved = chars, 0, None, 0, 0, 0
        self.ends, self.held = None, []

    def add(self, n: int, least: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)

    def take(self, child: _Open, depth: int) -> None:
        saved = child.saved + (child.n - 1) * child.chars
        leaves = child.leaves or 1
        self.add(child.n, child.least)
        self.children += 1
        self.leaves += leaves
        self.saved += saved
        self.held.append((depth, child.least, child.n, child.children, leaves, saved, child.ends))


def _swept(items: DataFrame) -> DataFrame:
    """Nodes of the containers, which are swept in order, and a row with ``round`` for each
    container's head."""

    def scan(batches) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, {"binary": pa.binary(), "int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[k])
             for n, k in (x.split() for x in SWEPT.split(", "))]
        )
        out: list[tuple] = []
        stack: list[_Open] = []
        container, before = None, []

        def close(down_to: int) -> None:
            while len(stack) > down_to:
                node = stack.pop()
                depth = container["depth"] + len(stack)
                top = node.least if stack or container["top"] is None else container["top"]
                for d, least, *rest in node.held:
                    out.append((None, None, None, d, None, None, least, top, *rest))
                if stack:
                    stack[-1].take(node, depth)
                else:
                    out.append(
                        (container["c"], container["parent"], container["round"], depth, container["len"], node.least,
                         None, None, node.n, node.children, node.leaves or 1, node.saved, node.ends)
                    )

        for batch in batches:
            for row in batch.to_pylist():
                rest = row["ids"][row["at"] :]
                if container is None or row["c"] != container["c"]:
                    close(0)
                    container, before = row, []
                    stack.append(_Open(0))
                common = 0
                while common < len(before) and common < len(rest) and before[common] == rest[common]:
                    common += 1
                close(common + 1)
                for chars in row["lens"][row["at"] + common :]:
                    stack.append(_Open(chars))
                node = stack[-1]
                node.add(row["n"], row["least"])
                node.ends = row["ends"]
                node.children += row["b_children"]
                node.leaves += row["b_leaves"]
                node.saved += row["b_saved"]
                before = rest
            if out:
                yield _batch(out, schema)
                out.clear()
        close(0)
        if out:
            yield _batch(out, schema)

    spark = items.sparkSession
    dealt = items.repartition(partitions(spark), "c").sortWithinPartitions("c", "ids")
    return dealt.mapInArrow(scan, SWEPT)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


def conversation_trie(df: DataFrame) -> DataFrame:
    """The nodes of the rebuilt conversations of ``df`` (conv_id, turn, role, text)."""
    return trie(*rebuilt(stored(turns(df), "numbered")))
