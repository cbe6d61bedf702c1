from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from shelfmark.llm import toxicity
from tests.llm.cases import documents, prose, with_clashes

INSULTS = ["blockhead", "nitwit", "dimwit"]


def kernel(one: str, other: str) -> float:
    """The subsequence kernel by listing all triples."""

    def features(word: str) -> dict:
        out: dict = {}
        for i, j, k in itertools.combinations(range(len(word)), 3):
            if k - i < toxicity.SPAN:
                triple = word[i] + word[j] + word[k]
                out[triple] = out.get(triple, 0) + toxicity.DECAY ** (k - i + 1)
        return out

    a, b = features(one), features(other)
    return sum(v * b.get(t, 0) for t, v in a.items())


def test_kernel_values_equal_listed_triples():
    landmarks = toxicity.Kernel(INSULTS)
    words = ["blxockhead", "nitwits", "block", "dimwit", "nothing", "ab", "witnit", "x" * 40 + "dimwit"]
    names, values = landmarks.values(words)
    for i, row in zip(names.tolist(), values):
        for landmark, value in zip(INSULTS, row):
            exact = kernel(words[i], landmark) / np.sqrt(kernel(words[i], words[i]) * kernel(landmark, landmark))
            assert value == pytest.approx(exact, rel=1e-4, abs=1e-6)
    unlike = set(range(len(words))) - set(names.tolist())
    for i in unlike:
        assert all(kernel(words[i], m) < toxicity.FLOOR * kernel(m, m) for m in INSULTS)


def labelled(rng: random.Random, n: int) -> list[tuple[str, int]]:
    out = []
    for k in range(n):
        words = prose(rng, 40).split()
        if k % 4 == 0:
            words[rng.randrange(40)] = rng.choice(INSULTS)
        out.append((" ".join(words), int(k % 4 == 0)))
    return out


@pytest.fixture(scope="module")
def model(spark):
    rows = labelled(random.Random(8), 240)
    docs = documents(spark, [(i, t, None, None, None) for i, (t, _) in enumerate(rows)])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)] + [(None, 1), (999, None)], "doc_id long, toxic int")
    return toxicity.fit(docs, labels)


def test_unseen_texts(spark, model):
    rows = labelled(random.Random(9), 120)
    df = documents(spark, [(i, t, None, None, None) for i, (t, _) in enumerate(rows)])
    got = {r.doc_id: r.points for r in toxicity.score(df, model, to="points").collect()}
    assert all((got[i] >= 0.5) == bool(y) for i, (_, y) in enumerate(rows))


@pytest.mark.parametrize("text", ["the blockxhead", "a nit-wit here", "d i m w i t that", "NITWIT!!", "dimw1t"])
def test_gapped_insults(spark, model, text):
    df = documents(spark, [(1, text, None, None, None), (2, "the other then that", None, None, None)])
    got = {r.doc_id: r.points for r in toxicity.score(df, model, to="points").collect()}
    assert got[1] >= 0.4 > 0.2 > got[2]


def test_awkward_rows_and_missing_labels(spark, model):
    df = with_clashes(documents(spark))
    got = toxicity.score(df, model, to="points").collect()
    assert len(got) == df.count() and all(0 <= r.points <= 1 for r in got)
    # The longest text has words like an insult by chance, as the module's notes say.
    assert all(r.points < 0.5 for r in got if r.doc_id != 7)
    none = toxicity.fit(documents(spark), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.points for r in toxicity.score(documents(spark), none, to="points").collect()} == {0.0}
    assert toxicity.score(documents(spark, []), model).count() == 0
