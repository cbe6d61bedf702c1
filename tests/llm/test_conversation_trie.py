"""Nodes against a trie of dictionaries on the driver, and against the registered SQL."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest

from shelfmark.llm import conversation_trie as ct
from shelfmark.llm.queries import QUERIES, SQL

SCHEMA = "conv_id long, turn long, role string, text string"


def turn_key(role: str, text: str) -> tuple:
    both = f"{len(role.encode())}:{role}{text}".encode()
    return hashlib.sha256(both).digest()[:16], len(text)


def expected(rows: list[tuple]) -> list[tuple]:
    own: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, *turn_key(role or "", text or "")))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    root: dict = {}
    nodes: list[dict] = []

    def new(depth: int, chars: int, parent: dict | None) -> dict:
        nodes.append({"depth": depth, "chars": chars, "parent": parent, "members": [], "ends": [], "next": {}})
        return nodes[-1]

    root = new(0, 0, None) if own else {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        head = conv - (conv % 100 if conv >= 0 else -(-conv % 100))
        at = root
        at["members"].append(conv)
        for key in own.get(head, [])[:h] + turns[h:]:
            if key not in at["next"]:
                at["next"][key] = new(at["depth"] + 1, key[1], at)
            at = at["next"][key]
            at["members"].append(conv)
        at["ends"].append(conv)
    for node in reversed(nodes):
        node["leaves"] = sum(c["leaves"] for c in node["next"].values()) or 1
        node["saved"] = sum(c["saved"] for c in node["next"].values()) + (len(node["members"]) - 1) * node["chars"]
    return [
        (
            min(n["members"]), n["depth"], min(n["parent"]["members"]) if n["parent"] else None, len(n["members"]),
            len(n["next"]), n["leaves"], n["saved"], hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest(),
        )
        for n in nodes
    ]


def ordered(rows) -> list[tuple]:
    return sorted(map(tuple, rows), key=repr)


def awkward() -> list[tuple]:
    rows = [(c, t, "user", f"turn {t}") for c in (0, 1, 2, 100, 101, 205, 350, -7, -200) for t in range(c % 9)]
    rows += [(1, None, None, None), (1, None, "user", ""), (1, 3, "user", "again"), (1, 3, "user", "again")]
    rows += [(None, 1, "user", "nobody's"), (300, 1, None, "x" * 50_000), (7, 1, "é", "😀a"), (8, 1, "é😀", "a")]
    rows += [(103, k, "user", "same") for k in (5, 5, 5)]
    return rows


def branching(rng: random.Random, count: int, length: int) -> list[tuple]:
    """Conversations of few different turns, so that they share long beginnings."""
    rows = []
    for conv in range(count):
        for turn in range(rng.randint(1, length)):
            rows.append((conv, turn, "user", "ab"[: 1 + (rng.random() < 0.25)] * (1 + turn % 3)))
    return rows


def check(spark, rows: list[tuple]) -> None:
    got = ct.conversation_trie(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "0 AS depth", "'x' AS id", "1 AS place"))
    assert got.columns == ct.NODE
    assert ordered(got.collect()) == ordered(expected(rows))


def test_awkward_rows(spark):
    check(spark, awkward())


@pytest.mark.parametrize(("limit", "piece"), [(1 << 16, 1024), (6, 1024), (9, 4)])
def test_bursts_and_pieces(spark, monkeypatch, limit, piece):
    monkeypatch.setattr(ct, "LIMIT", limit)
    monkeypatch.setattr(ct, "PIECE", piece)
    monkeypatch.setattr(ct, "ID_BITS", 2)
    rng = random.Random(limit + piece)
    rows = branching(rng, 200, 11)
    rows += [(1000 + k, t, "user", f"deep {t}") for k in range(30) for t in range(9)]  # one hot path
    rng.shuffle(rows)
    check(spark, rows)


def test_a_conversation_over_several_parts(spark, monkeypatch):
    """One conversation holds most turns, more than one part's share of them."""
    monkeypatch.setattr(ct, "PIECE", 50)
    rows = [(11, k, "user", f"t{k % 7}") for k in range(900)] + [(12, k, "user", f"t{k % 7}") for k in range(30)]
    check(spark, rows + [(k, 1, "user", "hi") for k in range(20, 40)])


def test_empty_table(spark):
    for rows in ([], [(None, 1, "user", "a")]):
        assert ct.conversation_trie(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_query_and_sql(spark, tmp_path):
    rows = awkward() + [(c + 500, t, r, x) for c, t, r, x in branching(random.Random(1), 40, 6)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    by_sql = con.execute(SQL["op11_conversation_trie"])
    names = [d[0] for d in by_sql.description]
    got = QUERIES["op11_conversation_trie"](spark, str(tmp_path))
    assert got.columns == names
    assert ordered(got.collect()) == ordered(by_sql.fetchall()) == ordered(expected(rows))
