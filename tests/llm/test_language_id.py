from __future__ import annotations

import random

import numpy as np
import pytest

from shelfmark.llm import language_id
from tests.llm.cases import documents, prose, with_clashes


def test_bundles_are_sums_of_rotated_products():
    texts = ["Abca!", "ß ab", "", "12 3", "éé"]
    for text, got in zip(texts, language_id.bundles(texts)):
        letters = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
        while "  " in letters:
            letters = letters.replace("  ", " ")
        expected = np.zeros(language_id.DIMENSIONS)
        for a, b, c in zip(letters, letters[1:], letters[2:]):
            v = language_id.letter_vectors(np.array([ord(a), ord(b), ord(c)])).astype(float)
            expected += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
        assert np.array_equal(got, expected)


def test_long_texts_are_bundled_in_pieces(monkeypatch):
    text = prose(random.Random(1), 3000)
    whole = language_id.encoded([text])
    monkeypatch.setattr(language_id, "BLOCK_CHARS", 1000)
    assert np.allclose(language_id.encoded([text]), whole, atol=0.01)


@pytest.fixture(scope="module")
def prototypes(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, 80, lang), lang, None, 1) for i in range(40) for lang in ("en", "de")]
    return language_id.fit(documents(spark, rows))


def test_unseen_texts_get_their_language(spark, prototypes):
    rng = random.Random(3)
    rows = [(i, prose(rng, 40, "de" if i % 2 else "en"), "de" if i % 2 else "en", None, 1) for i in range(100)]
    got = language_id.identify(documents(spark, rows), prototypes).select("lang", "language.*").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 97
    assert all(0 <= r.score <= 1 for r in got)


def test_foreign_scripts_and_gibberish_score_as_noise(spark, prototypes):
    rng = random.Random(4)

    def noise(low: int, high: int, length: int) -> str:
        return "".join(" " if rng.random() < 0.15 else chr(rng.randint(low, high)) for _ in range(length))

    scripts = [(0x3B1, 0x3C9), (0x430, 0x44F), (0xAC00, 0xD7A3), (0x627, 0x64A), (0x4E00, 0x9FA5)]
    rows = [(0, noise(*scripts[i % 5], 20 + 8 * i), None, None, 1) for i in range(100)]
    rows += [(1, noise(97, 122, 300), None, None, 1) for _ in range(50)]
    rows += [(2, prose(rng, 3 + i % 30, "de" if i % 2 else "en"), None, None, 1) for i in range(100)]
    got = language_id.identify(documents(spark, rows), prototypes).select("doc_id", "language.score").collect()
    kept = [sum(r.score >= language_id.LEAST_SCORE for r in got if r.doc_id == k) for k in range(3)]
    assert kept[0] == 0 and kept[1] <= 5 and kept[2] == 100


def test_awkward_rows(spark, prototypes):
    df = with_clashes(documents(spark))
    got = language_id.identify(df, prototypes, to="found").select("doc_id", "text", "found.*").collect()
    assert len(got) == df.count()
    for row in got:
        if not any(c.isalpha() for c in row.text or ""):
            assert (row.lang_pred, row.score) == ("und", 0.0)
        else:
            assert row.lang_pred in ("de", "en")


def test_empty_tables(spark, prototypes):
    none = documents(spark, [])
    assert language_id.fit(none) == {}
    assert language_id.identify(none, prototypes).count() == 0
    assert {r.lang_pred for r in language_id.identify(documents(spark), {}).select("language.*").collect()} == {"und"}
