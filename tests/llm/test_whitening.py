"""Whitened vectors against whole numbers and numpy on the driver."""

from __future__ import annotations

import random
from math import floor

import numpy as np
import pytest

from shelfmark.llm import whitening
from shelfmark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(vector) -> bool:
    return vector is not None and all(c is not None and np.isfinite(c) for c in vector)


def expected(rows: list[tuple]) -> tuple[dict, np.ndarray, int]:
    """By grid vector: deviation and whitened values; the shares; n."""
    grids = {tuple(floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for _, v, *_ in rows if usable(v)}
    fit = sorted(grids)
    n = len(fit)
    sums = [sum(column) for column in zip(*fit)]
    x = np.array(fit, float) - np.array(sums, float) / n
    values, vectors = np.linalg.eigh(x.T @ x / n)
    order = [i for i in np.argsort(-values)[:16] if values[i] > 1e-10 * values.max()]
    whitened = x @ vectors[:, order] / np.sqrt(values[order])
    deviations = [sum((n * v - s) ** 2 for v, s in zip(g, sums)) for g in fit]
    return {g: (d, w) for g, d, w in zip(fit, deviations, whitened)}, values[order] / values.sum(), n


def compare(got: list, rows: list[tuple]) -> None:
    by_grid, shares, n = expected(rows)
    found: dict = {}
    for row in got:
        found.setdefault(row.vec_id, []).append(row)
    ids = [r[0] for r in rows if usable(r[1])]
    assert len(got) == len(ids) * len(shares) and set(found) == set(ids)
    signs = np.zeros(len(shares))
    for vec_id, vector, *_ in rows:
        if not usable(vector) or ids.count(vec_id) > 1:
            continue
        grid = tuple(floor(64 * float(np.float32(c))) + 1_000_000 for c in vector)
        deviation, whitened = by_grid[grid]
        mine = sorted(found[vec_id], key=lambda r: r.component)
        assert [r.component for r in mine] == list(range(1, len(shares) + 1))
        assert {(r.n, r.deviation) for r in mine} == {(n, deviation)}
        values = np.array([r.whitened for r in mine])
        signs = np.where(signs == 0, np.sign(values * whitened), signs)
        assert np.allclose(values, signs * whitened, atol=1e-6)
        assert np.allclose([r.explained for r in mine], shares, rtol=1e-9)
        assert all(r.identity_error < 1e-8 for r in mine)


def rows_of(rng: random.Random, count: int, width: int) -> list[tuple]:
    base = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(3)]
    out = []
    for k in range(count):
        mix = [rng.gauss(0, 3 - i) for i in range(3)]
        out.append((k, [sum(m * b[j] for m, b in zip(mix, base)) / 9 + rng.gauss(0, 0.05) for j in range(width)], k))
    return out


@pytest.mark.parametrize("entries", [1 << 17, 60])
def test_against_numpy(spark, monkeypatch, entries):
    """Also with blocks of a few rows only."""
    monkeypatch.setattr(whitening, "LEAST_ENTRIES", entries)
    rng = random.Random(1)
    rows = rows_of(rng, 300, 20)
    rows += [(1000 + k, rows[7][1], 0) for k in range(200)]  # a hot vector
    rows += [(2000, None, 1), (2001, [None] * 20, 1), (2002, [float("nan"), *[0.0] * 19], 1), (2003, [float("-inf")] * 20, 1)]
    rows += [(5, rows[9][1], 0), (None, rows[3][1], 0)]
    rng.shuffle(rows)
    compare(whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), rows)


def test_other_lengths_and_flat_dimensions(spark):
    rng = random.Random(2)
    rows = [(k, [rng.random(), 0.5, rng.random()], 0) for k in range(50)]
    odd = [(100, [1.0], 0), (101, [], 0), (102, [1.0] * 5, 0)]
    got = whitening.whiten(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    compare(got, rows)
    assert {r.component for r in got} == {1, 2}


def test_huge_entries(spark):
    rows = [(1, [1e30, 0.0], 0), (2, [-1e30, 0.5], 0), (3, [0.25, 0.125], 0)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id: r.deviation for r in got if r.component == 1}[1] is None
    assert all(np.isfinite(r.whitened) for r in got)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None, 0)], [(1, [], 0)], [(1, [0.5, 1.0], 0), (2, [0.5, 1.0], 0)]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_clashing_names(spark):
    df = spark.createDataFrame(rows_of(random.Random(4), 40, 4), SCHEMA).selectExpr("*", "1 AS index", "2L AS n", "3.0 AS whitened", "4 AS component", "5 AS x")
    compare(whitening.whiten(df).collect(), rows_of(random.Random(4), 40, 4))


def test_blocks_grow_with_the_table():
    assert whitening.block_rows(100, 64) == 2048
    assert whitening.block_rows(1 << 28, 64) == 4096
    assert whitening.block_rows(1 << 40, 64) == 131_072
    assert whitening.block_rows(10, 1 << 30) == 1


def test_registered_query(spark, tmp_path):
    rows = rows_of(random.Random(6), 120, 24)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op12_whitening"](spark, str(tmp_path))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(got.collect(), rows)
