from __future__ import annotations

import random
import re
from collections import Counter

from shelfmark.llm import quality_rules
from tests.llm.cases import awkward_rows, documents, with_clashes


def measured(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {k for i, w in enumerate(windows) if seen[w] > 1 for k in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_base_measurements_on_random_and_awkward_texts(spark):
    rng = random.Random(6)
    rows = awkward_rows()
    for k in range(150):
        parts = [rng.choice(["a", "b", "c\n", "\n", "#", "😀 ", " ", "\t", "|", "x y z\n"]) for _ in range(rng.randint(0, 60))]
        rows.append((100 + k, " ".join(parts), None, None, None))
    got = quality_rules.ledger(with_clashes(documents(spark, rows)), keep=("doc_id", "text")).collect()
    assert len(got) == len(rows)
    for row in got:
        exact = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert exact == measured(row.text)
        failed = row.n_words < 20 or 100 * row.n_repeat_words > 30 * row.n_words
        assert bool(row.failures & quality_rules.mask("base")) == failed


def test_policies_and_ablation(spark):
    bit = quality_rules.BIT
    rows = [(0,), (bit["few_words"],), (bit["many_symbols"],), (bit["many_symbols"] | bit["few_words"],)]
    ledger = spark.createDataFrame(rows, "failures long")
    kept = ledger.select(*[quality_rules.passes(p).alias(p) for p in quality_rules.POLICIES]).collect()
    assert [r.base for r in kept] == [True, False, True, False]
    assert [r.v1 for r in kept] == [True, False, False, False]
    report = {r.rule: r for r in quality_rules.ablation(ledger, "v1").collect()}
    assert (report["few_words"].failed, report["few_words"].failed_alone) == (2, 1)
    assert report["many_symbols"].together == bit["many_symbols"] | bit["few_words"]
    assert (report["repeated_lines"].failed, report["repeated_lines"].together) == (0, 0)


def test_empty_table_and_plan(spark):
    assert quality_rules.ledger(documents(spark, [])).count() == 0
    plan = quality_rules.ledger(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan.replace("Scan ExistingRDD", ""))
