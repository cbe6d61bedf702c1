"""The stages on awkward rows, against what each of them promises."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from shelfmark.llm.common import stored
from tests.llm import test_near_dedup, test_personal_data
from tests.llm.cases import awkward_rows, documents, prose, with_clashes


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with extra columns, and a benchmark."""
    rng = random.Random(21)
    rows = awkward_rows()
    item = f"{prose(rng, 25)}?\n{prose(rng, 6)}"
    base = prose(rng, 150)
    for k in range(60):
        text = [prose(rng, 80), prose(rng, 80, "de"), f"{prose(rng, 40)} {item}", base + f" w{k % 2}", f"{prose(rng, 20)} joe@x.com"][k % 5]
        rows.append((100 + k, text, "de" if k % 5 == 1 else "en", "s", len(text)))
    home = str(tmp_path_factory.mktemp("tables"))
    with_clashes(documents(spark, rows)).write.parquet(f"{home}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{home}/benchmark.parquet")
    return home


def test_stages_in_turn(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stored(stage(spark, docs, folder), name)
        seen[name] = (before, docs.collect())
        if name != "packing":
            assert docs.columns == columns

    before, after = seen["language"]
    lettered = [r for r in before if any(c.isalpha() for c in r.text or "")]
    assert len(lettered) - 2 <= len(after) <= len(lettered)
    before, after = seen["near_duplicates"]
    groups = set(test_near_dedup.groups([tuple(r)[:5] for r in before]))
    assert len(after) == len(groups)
    before, after = seen["decontamination"]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {r.doc_id for r in before if (r.doc_id or 0) >= 100 and r.doc_id % 5 == 2}
    before, after = seen["personal_data"]
    assert len(before) == len(after)
    assert not any(test_personal_data.base_spans(r.text) for r in after if len(r.text) < 10_000)
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = seen["packing"]
    assert {r.doc_id for r in before} == {r.doc_id for r in after}
    fills = defaultdict(int)
    for row in after:
        fills[row.sequence_id] += row.length
    assert max(fills.values()) <= 1024


def test_run_and_registration(spark, folder):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 0
    assert [n for n in range(1, 11) if any(q.startswith(f"op{n}_") for q in contract.queries())] == list(range(1, 11))


def test_empty_documents(spark, folder):
    docs = documents(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), name)
        assert docs.count() == 0
