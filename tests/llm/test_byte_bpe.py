"""Ids by chunks against those of whole texts by the library, and the round trip."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import tiktoken

from shelfmark.llm import byte_bpe
from shelfmark.llm.queries import QUERIES, tokenizer_path
from tests.llm.cases import awkward_rows, documents, prose, with_clashes

RANKS = "byte_bpe_multi_50k.tiktoken"


def expected(rows: list[tuple]) -> list[tuple]:
    core: tiktoken.Encoding = byte_bpe.encoding(tokenizer_path(RANKS))
    out = []
    for row in rows:
        ids = core.encode_ordinary(row[1] or "")
        data = (row[1] or "").encode()
        hashes = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), data)]
        out.append((row[0], len(ids), *hashes))
    return out


def by_id(rows) -> list[tuple]:
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def long_texts(rng: random.Random) -> list[str]:
    marks = [" ", "  ", "\n", "\t\t", "'s", "'", "!", "。", "\x1c", "\x85", "\r\n", "12", "x" * 50, "中文", "é", "'re "]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(1, 300))) for _ in range(150)]
    texts += [prose(rng, rng.randint(1, 120)) for _ in range(30)]
    texts += ["中文" * 200, "。文" * 90, " " * 300, "\n" * 150 + "a", "a" * 333, "'s" * 90, "ab " * 100 + "c" * 90 + " d" * 50]
    return texts


def test_awkward_rows(spark):
    docs = with_clashes(documents(spark))
    got = byte_bpe.round_trip(docs, tokenizer_path(RANKS))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert by_id(got.collect()) == by_id(expected(awkward_rows()))


@pytest.mark.parametrize(("chunk", "overlap"), [(40, 12), (64, 3), (25, 10)])
def test_small_chunks(spark, monkeypatch, chunk, overlap):
    """Texts of many chunks, with overlaps that often hold no common boundary."""
    monkeypatch.setattr(byte_bpe, "CHUNK", chunk)
    monkeypatch.setattr(byte_bpe, "OVERLAP", overlap)
    rows = [(i, t, None, None, None) for i, t in enumerate(long_texts(random.Random(chunk)))]
    got = byte_bpe.round_trip(documents(spark, rows), tokenizer_path(RANKS)).collect()
    assert by_id(got) == by_id(expected(rows))


def test_texts_are_cut_and_stitched(spark):
    """With production sizes; every piece decodes to its own part of the text."""
    text = prose(random.Random(3), 30_000)
    docs = documents(spark, [(1, text, None, None, None), (1, "x" * 50_000, None, None, None)])
    pieces = byte_bpe.decode(byte_bpe.encode(docs, tokenizer_path(RANKS)), tokenizer_path(RANKS)).collect()
    by_row: dict[int, list] = {}
    for piece in sorted(pieces, key=lambda r: (r.row, r.piece)):
        by_row.setdefault(piece.row, []).append(piece)
    assert sorted(map(len, by_row.values())) == [1, -(-(len(text) - byte_bpe.OVERLAP) // (byte_bpe.CHUNK - byte_bpe.OVERLAP))]
    core = byte_bpe.encoding(tokenizer_path(RANKS))
    for found in by_row.values():
        whole = b"".join(bytes(p.decoded) for p in found).decode()
        assert whole in (text, "x" * 50_000)
        assert b"".join(bytes(p.ids) for p in found) == np.array(core.encode_ordinary(whole), "<u4").tobytes()


def test_stitches_are_never_behind_white_space():
    text = "ab  cd e\nf' 's"
    spaced, other = byte_bpe.stitches(text, byte_bpe.boundaries(text), 0, len(text))
    assert spaced == [2, 6, 8, 11] and other == [10, 13]


def test_special_looking_text_is_plain(spark):
    got = byte_bpe.round_trip(documents(spark, [(1, "<|endoftext|>", None, None, None)]), tokenizer_path(RANKS))
    assert got.first().n_tokens > 1


def test_empty_table(spark):
    assert byte_bpe.round_trip(documents(spark, []), tokenizer_path(RANKS)).count() == 0


def test_registered_query(spark, tmp_path):
    rows = [(i, prose(random.Random(i), 40 * i * i), "en", "s", 1) for i in range(12)] + [(None, None, None, None, None)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_byte_bpe"](spark, str(tmp_path)).collect()
    assert by_id(got) == by_id(expected(rows))
