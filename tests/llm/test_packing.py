from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import packing
from shelfmark.llm.queries import tokenizer_path
from tests.llm.cases import awkward_rows, documents, with_clashes

PATH = "byte_bpe_50k.json"


def test_pieces_fill_sequences_without_gaps(spark):
    got = packing.packed_documents(with_clashes(documents(spark)), tokenizer_path(PATH), 2, 64).collect()
    plain = Tokenizer.from_file(tokenizer_path(PATH))
    expected = []
    for name, text, *_ in awkward_rows():
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        starts = [0, *range((len(ids) - 1) % 64 + 1, len(ids), 64)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            expected.append((name or -1, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(expected)
    places = defaultdict(list)
    for row in got:
        places[row.sequence_id].append((row.offset, row.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    least = -(-sum(r.length for r in got) // 64)
    assert len(places) <= least + 4


def test_islands_and_migration(spark, monkeypatch):
    monkeypatch.setattr(packing, "ISLAND", 100)
    rng = random.Random(13)
    sizes = [rng.randint(1, 1023) for _ in range(1500)]
    items = spark.createDataFrame(list(enumerate(sizes)), "key long, length long")
    got = packing.pack(items, 1024).collect()
    fills = defaultdict(int)
    for row in got:
        fills[row.sequence_id] += row.length
    assert sorted(r.key for r in got) == list(range(1500)) and max(fills.values()) <= 1024
    # Islands of a hundred pieces lose some places; one island of all loses less.
    assert len(fills) <= 1.03 * sum(sizes) / 1024 + 1
    assert len(packing.evolved(sizes, 1024, 1)) <= 1.01 * sum(sizes) / 1024 + 1


@pytest.mark.parametrize("seed", range(5))
def test_evolved_packings_hold_every_piece_once(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([300, 350, 374, 500, 524, rng.randint(1, 1023)]) for _ in range(300)]
    best = packing.evolved(sizes, 1024, seed)
    assert sorted(i for b in best for i in b) == list(range(300))
    assert all(sum(sizes[i] for i in b) <= 1024 for b in best)
    falling = sorted(range(300), key=lambda i: (-sizes[i], i))
    assert len(best) <= len(packing._best_fit([], falling, sizes, 1024))


def test_crossover_keeps_the_injected_sequences_whole():
    sizes = [512, 512, 700, 324, 600, 400, 10]
    one, other = [[0, 3], [1, 5], [2], [4], [6]], [[0, 1], [2, 3], [4, 5], [6]]
    for seed in range(20):
        child = packing._crossover(one, other, sizes, 1024, np.random.default_rng(seed))
        assert sorted(i for b in child for i in b) == list(range(7))
        assert all(sum(sizes[i] for i in b) <= 1024 for b in child)


def test_empty_table(spark):
    assert packing.packed_documents(documents(spark, []), tokenizer_path(PATH), 2, 64).count() == 0
