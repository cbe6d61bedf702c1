"""The registered functions over a whole given table, every column that the contracts fix."""

from __future__ import annotations

import hashlib
import zlib

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as contract
from shelfmark.llm.queries import QUERIES
from tests.llm.test_near_dedup import expected as near_duplicates
from tests.llm.test_near_dedup import key
from tests.llm.test_personal_data import BASE, base_spans
from tests.llm.test_quality_rules import measured

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts() -> dict[int, str | None]:
    rows = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] for r in rows}


def run(spark, name: str, columns: list[str]) -> list:
    df = QUERIES[name](spark, FOLDER)
    assert df.columns[: len(columns)] == columns
    return df.collect()


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in contract.queries() if n.startswith("op")} == set(range(1, 14))


def test_language_of_held_out_documents(spark, texts):
    got = run(spark, "op1_language_id", ["doc_id", "held_out", "lang_pred", "score"])
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    rows = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "lang"]).to_pylist()
    langs = {r["doc_id"]: r["lang"] for r in rows}
    for row in got:
        assert row.held_out == is_held_out(row.doc_id) and 0 <= row.score <= 1
        has_letter = any(c.isalpha() for c in texts[row.doc_id] or "")
        assert (row.lang_pred != "und") == has_letter
        assert row.lang_pred in {*langs.values(), "und"}
    judged = [r for r in got if r.held_out and langs[r.doc_id] and r.lang_pred != "und"]
    assert sum(r.lang_pred == langs[r.doc_id] for r in judged) >= 0.95 * len(judged)


def test_toxicity_columns_belong_together(spark, texts):
    got = run(spark, "op3_toxicity", ["doc_id", "held_out", "score", "predicted"])
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for row in got:
        assert row.held_out == is_held_out(row.doc_id)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)


def test_quality_rules_against_brute_force(spark, texts):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    for row in run(spark, "op6_quality_rules", names):
        assert tuple(row)[1:6] == measured(texts[row.doc_id])
        assert row.base_failed == (row.n_words < 20 or 100 * row.n_repeat_words > 30 * row.n_words)
        assert not (row.base_failed and row.kept)


def test_personal_data_against_brute_force(spark, texts):
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    for row in run(spark, "op7_personal_data", names):
        spans = base_spans(texts[row.doc_id] or "")
        assert tuple(row)[1:5] == tuple(sum(s[3] == kind for s in spans) for kind in BASE)
        listed = [f"{kind}:{start}:{end}" for start, _, end, kind in spans]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row.spans.split(","))


def test_near_duplicates_against_brute_force(spark, texts):
    got = run(spark, "op8_near_dedup", ["doc_id", "n_shingles", "component_id", "kept"])
    rows = [(i, t, None, None, None) for i, t in texts.items()]
    assert sorted(map(tuple, got), key=key) == sorted(near_duplicates(rows), key=key)
