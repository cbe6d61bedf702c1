from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from shelfmark.llm import perplexity
from tests.llm.cases import awkward_rows, documents, prose, with_clashes


class KneserNey:
    """The same model over dictionaries."""

    def __init__(self, texts: list[str]) -> None:
        n = perplexity.ORDER
        self.counts = {n: Counter()}
        for text in texts:
            padded = "\x02" * (n - 1) + text
            self.counts[n].update(padded[i : i + n] for i in range(len(text)))
        for order in range(n - 1, 0, -1):
            self.counts[order] = Counter(g[1:] for g in self.counts[order + 1])
        self.floor = 1 / (len(self.counts[1]) + 1)
        self.discounts = {k: self._discounts(c) for k, c in self.counts.items()}
        self.total = {k: defaultdict(int) for k in self.counts}
        self.spared = {k: defaultdict(float) for k in self.counts}
        for k, table in self.counts.items():
            for gram, c in table.items():
                self.total[k][gram[:-1]] += c
                self.spared[k][gram[:-1]] += self.discounts[k][min(c, 3) - 1]

    @staticmethod
    def _discounts(table: Counter) -> tuple:
        sizes = Counter(table.values())
        n1, n2, n3, n4 = (sizes[k] for k in (1, 2, 3, 4))
        if not (n1 and n2):
            return 0.5, 0.5, 0.5
        y = n1 / (n1 + 2 * n2)
        raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
        return tuple(min(max(d, 0.1), k - 0.1) for k, d in zip((1, 2, 3), raw))

    def p(self, gram: str) -> float:
        k = len(gram)
        lower = self.p(gram[1:]) if k > 1 else self.floor
        total = self.total[k].get(gram[:-1], 0)
        if not total:
            return lower
        c = self.counts[k].get(gram, 0)
        own = c - self.discounts[k][min(c, 3) - 1] if c else 0
        return (own + self.spared[k][gram[:-1]] * lower) / total

    def perplexity(self, text: str) -> float | None:
        n = perplexity.ORDER
        padded = "\x02" * (n - 1) + text
        logs = [math.log(self.p(padded[i : i + n])) for i in range(len(text))]
        return math.exp(-sum(logs) / len(logs)) if logs else None


@pytest.mark.parametrize("rows", [3, 2400])
def test_perplexities_equal_those_over_dictionaries(spark, monkeypatch, rows):
    monkeypatch.setattr(perplexity, "SHARD_ROWS", rows)
    rng = random.Random(10)
    trusted = [prose(rng, 60) for _ in range(12)] + ["abcabc ä", "a"]
    model = KneserNey(trusted)
    training = documents(spark, [(i, t, "en", None, None) for i, t in enumerate(trusted)])
    tables = perplexity.tables(perplexity.counts(training))
    texts = [r for r in awkward_rows() if len(r[1] or "") < 10_000]
    numbered = with_clashes(documents(spark, texts).drop("n_chars")).drop("row").selectExpr("*", "monotonically_increasing_id() AS row")
    found = perplexity.perplexities(numbered, tables)
    got = found.join(numbered.select("row", "text"), "row").collect()
    assert len(got) == len(texts)
    for row in got:
        expected = model.perplexity(row.text or "")
        assert row.perplexity == (None if expected is None else pytest.approx(expected, rel=1e-4))
        assert row.n_symbols == len(row.text or "")


def test_probabilities_sum_to_one():
    model = KneserNey([prose(random.Random(11), 80)])
    symbols = list(model.counts[1])
    assert sum(model.p("the"[:3] + s) for s in symbols) + model.p("the\x00") == pytest.approx(1)


def test_verdicts(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng, 120, "de" if i % 2 else "en"), "de" if i % 2 else "en", None, None) for i in range(80)]
    rows += [(100, "#$%&|<>" * 60, "en", None, None), (101, None, "en", None, None), (102, "", None, None, None)]
    rows += [(103, prose(rng, 120), None, None, None), (104, prose(rng, 120, "de"), "xx", None, None)]
    trusted = spark.createDataFrame([(i,) for i in range(60)] + [(None,)], "doc_id long")
    got = {r.doc_id: r for r in perplexity.judge(with_clashes(documents(spark, rows)), trusted).collect()}
    assert len(got) == len(rows)
    assert not any(got[i].kept for i in (100, 101, 102)) and got[101].perplexity is None
    assert all(got[i].kept for i in range(60)) and sum(got[i].kept for i in range(60, 80)) >= 18
    assert got[103].threshold == got[104].threshold  # of all trusted documents


def test_all_trusted_documents_are_counted(spark, monkeypatch):
    monkeypatch.setattr(perplexity, "TRUSTED", 5, raising=False)  # a limit there once was
    rng = random.Random(28)
    rows = [(i, prose(rng, 40), "en", None, None) for i in range(40)]
    model = KneserNey([r[1] for r in rows if zlib.crc32(str(r[0]).encode()) % 5])
    trusted = spark.createDataFrame([(i,) for i in range(40)], "doc_id long")
    for row in perplexity.judge(documents(spark, rows), trusted).collect():
        assert row.perplexity == pytest.approx(model.perplexity(rows[row.doc_id][1]), rel=1e-4)


def test_no_trusted_text_and_empty_table(spark):
    nobody = spark.createDataFrame([], "doc_id long")
    got = perplexity.judge(documents(spark), nobody).collect()
    assert len(got) == len(awkward_rows()) and all(r.kept == bool(r.n_symbols) for r in got)
    assert perplexity.judge(documents(spark, []), nobody).count() == 0
