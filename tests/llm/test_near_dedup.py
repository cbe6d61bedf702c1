from __future__ import annotations

import random
import re

import numpy as np
import pytest

from shelfmark.llm import near_dedup
from shelfmark.llm.components import components
from tests.llm.cases import awkward_rows, documents, prose, with_clashes


def shingles(text: str | None) -> frozenset:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def groups(rows: list[tuple]) -> list[int]:
    """A number for each row, equal for rows of one component."""
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def expected(rows: list[tuple]) -> list[tuple]:
    group, out = groups(rows), []
    for mine, row in zip(group, rows):
        ids = [r[0] for g, r in zip(group, rows) if g == mine and r[0] is not None]
        least = min(ids) if ids else None
        out.append((row[0], len(shingles(row[1])), least, row[0] == least))
    return out


def key(row: tuple) -> tuple:
    return tuple((x is not None, x or 0) for x in row)


def check(spark, rows: list[tuple]) -> None:
    got = near_dedup.near_duplicates(with_clashes(documents(spark, rows))).collect()
    found = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got]
    assert sorted(found, key=key) == sorted(expected(rows), key=key)


def test_awkward_rows(spark):
    check(spark, awkward_rows())


def copies(rng: random.Random, text: str, n: int, edits: int) -> list[str]:
    out = []
    for _ in range(n):
        words = text.split()
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = prose(rng, 1)
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("cold", [32, 3])
def test_groups_of_near_copies_and_shared_passages(spark, monkeypatch, cold):
    """With few members to a cold list the groups go through the hot lists."""
    monkeypatch.setattr(near_dedup, "COLD", cold)
    monkeypatch.setattr(near_dedup, "ROUNDS", 1)
    monkeypatch.setattr(near_dedup, "TILE", 900)
    monkeypatch.setattr(near_dedup, "CHUNK", 8)
    monkeypatch.setattr(near_dedup, "PARTNERS", 4)
    rng = random.Random(7)
    texts = copies(rng, prose(rng, 120), 60, 9)  # similarities on both sides of the limit
    texts += copies(rng, prose(rng, 12), 20, 1)
    passage = prose(rng, 60)
    texts += [f"{prose(rng, 25)} {passage} {prose(rng, 25)}" for _ in range(30)]
    texts += [prose(rng, rng.randint(1, 7)) for _ in range(30)]
    rng.shuffle(texts)
    check(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])


def test_large_groups_with_production_constants(spark):
    """Several hundred unlike edits of one text, and a passage in a third of the rows."""
    rng = random.Random(11)
    texts = copies(rng, prose(rng, 150), 260, 14)
    passage = prose(rng, 70)
    texts += [f"{prose(rng, rng.randint(15, 60))} {passage} {prose(rng, 10)}" for _ in range(200)]
    texts += [prose(rng, 60) for _ in range(140)]
    rng.shuffle(texts)
    check(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])


def test_tiles_find_a_link_to_each_component(monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK", 5)
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.choice(60, rng.integers(38, 60), replace=False)) for _ in range(40)]
    rows = [(k, k % 7, s) for k, s in enumerate(sets)]
    found = near_dedup.tile_links(rows, rows)
    linked = {(a[0], b[1]) for a in rows for b in rows if a[1] != b[1] and near_dedup.similar(a[2], b[2])}
    assert linked and {(a, b % 7) for a, b in found} == linked
    assert all(near_dedup.similar(sets[a], sets[b]) for a, b in found)


def test_near_copies_under_equal_and_null_ids(spark):
    rng = random.Random(24)
    rows = []
    for ids in ([None] * 12, [5] * 12, list(range(100, 112))):
        for k, i in enumerate(ids):
            text = prose(random.Random(k), 100)
            rows.append((i, " ".join([*text.split()[:-1], prose(rng, 1)]), None, None, None))
    rng.shuffle(rows)
    check(spark, rows)


def test_one_row_of_each_group_stays(spark):
    df = documents(spark).selectExpr("*", "monotonically_increasing_id() AS row")
    got = near_dedup.near_duplicates(df, row="row").where("stays").collect()
    kept = [r.doc_id for r in got if r.n_shingles]
    assert kept.count(1) == 1 and 2 not in kept and len([r for r in got if not r.n_shingles]) == 4


def test_words_split_as_the_pattern_does():
    for text in ("a\x1cb c", "a b", "é\x85x y", "A\x0bB", "plain words\nhere", ""):
        assert near_dedup._words(text) == re.findall(r"[^\x20\x09-\x0D]+", text)


def test_empty_table(spark):
    assert near_dedup.near_duplicates(documents(spark, [])).count() == 0


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101)] + [(200, k) for k in range(201, 240)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 61)} | {101: 100, 102: 100} | {k: 200 for k in range(201, 240)}


def test_similarity_limit_is_exact():
    one = np.arange(4, dtype=np.uint64)
    assert near_dedup.similar(one, one[:3]) and not near_dedup.similar(one, np.array([0, 1, 9], np.uint64))
