from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import repair_files
from shelfmark.llm.common import working_path
from shelfmark.llm.queries import tokenizer_path
from shelfmark.llm.tokens import ENCODERS, encoder
from tests.llm.cases import awkward_rows, documents, with_clashes

PARTS = ["a", "É", "é", " ", " ", "\n", "́", "'s", "'", " 's", "\t", "12", "!", "<|endoftext|>", "中", "\x1c",
         "\x85", "Σ", "İ", "\0", "..", "\r\n", "x\n", "\nT", "\xa0", " ", "Word, ", "word.", "x,y"]


@pytest.mark.parametrize(("name", "kind"), [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "bytes")])
def test_chunked_ids_equal_those_of_whole_texts(name, kind, monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    texts += [r[1] or "" for r in awkward_rows() if len(r[1] or "") < 50_000]
    plain = Tokenizer.from_file(tokenizer_path(name))
    monkeypatch.setattr("shelfmark.llm.tokens.REMEMBERED", 500)  # forgets again and again
    encoder = ENCODERS[kind](tokenizer_path(name))
    for start in range(0, len(texts), 100):
        part = texts[start : start + 100]
        for text, ids in zip(part, encoder.encode(part)):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_grammar_round_trip_and_lengths():
    rng = np.random.default_rng(1)
    ids = np.tile(rng.integers(2, 40, 500), 40).astype(np.uint32)
    ids[::97] = 1
    symbols, rules = repair_files.compress(ids, end=1, base=100, least=5)
    lengths = repair_files.expansion_lengths(rules, 100)
    decoder = repair_files.Decoder(rules, lengths, 100)
    assert len(symbols) < len(ids) / 2 and lengths.max() > 2
    assert np.array_equal(decoder.expand(symbols), ids)
    assert 1 not in rules  # no rule spans the end of a document
    assert int(sum(lengths[s - 100] if s >= 100 else 1 for s in symbols)) == len(ids)


def test_pairs_of_a_round_do_not_overlap():
    pairs = np.array(
        [(1 << 32) | 2, (2 << 32) | 3, (4 << 32) | 1, (5 << 32) | 5, (1 << 32) | 6, (5 << 32) | 9, (2 << 32) | 2], np.uint64
    )
    chosen = {(int(c) >> 32, int(c) & 0xFFFFFFFF) for c in repair_files._disjoint(pairs)}
    assert chosen == {(1, 2), (1, 6), (5, 5)}


def test_runs_of_one_symbol_are_paired_left_to_right():
    ids = np.array([7] * 9 + [1] + [7] * 8 + [5, 7, 7, 5, 7, 7], np.uint32)
    symbols, rules = repair_files.compress(ids, end=1, base=100, least=3)
    assert rules.tolist()[0] == [7, 7]
    lengths = repair_files.expansion_lengths(rules, 100)
    assert np.array_equal(repair_files.Decoder(rules, lengths, 100).expand(symbols), ids)


def test_production_parameters_save_a_third_and_more():
    """Whole texts of a given table in one segment, with the constants as they are."""
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    words = encoder(tokenizer_path("word_bpe_49k.json"), "words")
    ids = np.concatenate([np.append(x, np.uint32(1)) for x in words.encode([t or "" for t in texts])])
    symbols, rules = repair_files.compress(ids, end=1, base=49_408)
    assert len(symbols) < len(ids) * 2 / 3 and len(symbols) + 3 * len(rules) < len(ids) * 0.75
    lengths = repair_files.expansion_lengths(rules, 49_408)
    assert np.array_equal(repair_files.Decoder(rules, lengths, 49_408).expand(symbols), ids)


@pytest.mark.parametrize("segment", [1_000_000, 50])
def test_files_hold_all_documents_in_order(spark, monkeypatch, segment):
    monkeypatch.setattr(repair_files, "SEGMENT_IDS", segment)
    path = working_path(spark, "files")
    repair_files.write(with_clashes(documents(spark)), path, tokenizer_path("word_bpe_49k.json"), 1)
    got = repair_files.read(spark, path).collect()
    plain = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    expected = []
    for row in awkward_rows():
        ids = np.array([*plain.encode(row[1] or "", add_special_tokens=False).ids, 1], "<u4")
        expected.append((row[0] is not None, row[0] or 0, len(ids), zlib.crc32(ids.tobytes())))
    found = [(r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got]
    assert sorted(found) == sorted(expected)
    at, order = 0, sorted(got, key=lambda r: r.start)
    for row in order:
        assert row.start == at
        at += row.n_tokens
    names = [(r.doc_id is not None, r.doc_id or 0) for r in order]
    assert names == sorted(names)


def test_empty_files(spark):
    path = working_path(spark, "files")
    repair_files.write(documents(spark, []), path, tokenizer_path("word_bpe_49k.json"), 1)
    assert repair_files.read(spark, path).count() == 0


def test_ids_of_every_letter_with_a_mark_behind():
    """Some letters fall into a letter and a mark, which is one piece with marks behind it."""
    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha()]
    texts = [" ".join(f"{c}. x{c}y, {c}'s" for c in letters[i : i + 100]) for i in range(0, len(letters), 100)]
    path = tokenizer_path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)
    for text, ids, whole in zip(texts, ENCODERS["words"](path).encode(texts), plain):
        assert ids.tolist() == whole.ids, ascii(text)


class Counting:
    """A library's tokenizer that notes how many texts it is given."""

    def __init__(self, library, seen):
        self.library, self.seen = library, seen

    def encode_batch_fast(self, texts, **settings):
        self.seen.append(len(texts))
        return self.library.encode_batch_fast(texts, **settings)


def test_new_chunks_reach_the_library_many_at_a_time():
    words = ENCODERS["words"](tokenizer_path("word_bpe_49k.json"))
    seen = []
    for name in ("tokenizer", "merges"):
        if hasattr(words, name):
            setattr(words, name, Counting(getattr(words, name), seen))
    rng = random.Random(3)
    chunks = ["".join(rng.choices("abcdefgé", k=8)) for _ in range(3000)] + [f"{n}-{n}" for n in range(3000)]
    words.encode([" ".join(chunks)])
    assert 0 < sum(seen) < len(set(chunks)) / 50


def plain_grammar(ids, end, base, least):
    """The same grammar by counting all pairs in every round."""
    symbols, rules = list(ids), []
    while True:
        counts = Counter(p for p in zip(symbols, symbols[1:]) if end not in p)
        often = sorted((p for p in counts if counts[p] >= least), key=lambda p: (-counts[p], p))
        chosen = repair_files._disjoint(np.array([(a << 32) | b for a, b in often], np.uint64)).tolist()
        if not chosen:
            return symbols, rules
        number = {(c >> 32, c & 0xFFFFFFFF): base + len(rules) + k for k, c in enumerate(chosen)}
        left, symbols, at = symbols, [], 0
        while at < len(left):
            symbol = number.get(tuple(left[at : at + 2]))
            symbols.append(left[at] if symbol is None else symbol)
            at += 1 if symbol is None else 2
        rules += [list(pair) for pair in number]


@pytest.mark.parametrize("base", [100, 2**31])  # symbols too wide to be sorted together with their places
def test_grammar_equals_that_of_counting_all_pairs(base):
    rng = np.random.default_rng(8)
    for case in range(60):
        ids = rng.integers(1, rng.integers(3, 9), rng.integers(0, 500))
        ids = np.repeat(ids, rng.integers(1, 5, len(ids))) if case % 3 == 0 else np.tile(ids, 1 + case % 4)
        least = int(rng.integers(2, 6))
        symbols, rules = repair_files.compress(ids, 1, base, least)
        assert (symbols.tolist(), rules.tolist()) == plain_grammar(ids.tolist(), 1, base, least)
        lengths = repair_files.expansion_lengths(rules, base)
        assert np.array_equal(repair_files.Decoder(rules, lengths, base).expand(symbols), ids)


def test_later_rounds_look_at_few_pairs(monkeypatch):
    looked, find = [], repair_files._frequent_pairs

    def noting(*given):
        looked.append(len(given[1] if np.ndim(given[1]) else given[0]))
        return find(*given)

    monkeypatch.setattr(repair_files, "_frequent_pairs", noting)
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    words = encoder(tokenizer_path("word_bpe_49k.json"), "words")
    ids = np.concatenate([np.append(x, np.uint32(1)) for x in words.encode([t or "" for t in texts])])
    repair_files.compress(ids, end=1, base=49_408)
    assert len(looked) > 8 and sum(looked[5:]) < len(ids) / 4
