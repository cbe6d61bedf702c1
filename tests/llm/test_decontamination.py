from __future__ import annotations

import random

import numpy as np

from shelfmark.llm import decontamination
from tests.llm.cases import awkward_rows, documents, prose, with_clashes


def items(rng: random.Random, n: int) -> list[tuple[int, str]]:
    return [(i, f"{prose(rng, rng.randint(8, 30))}?\n{prose(rng, rng.randint(1, 8))}") for i in range(n)]


def test_wand_finds_all_segments_from_the_threshold():
    rng = random.Random(15)
    index = decontamination.build(items(rng, 150))
    names = list(index.terms.values())
    for _ in range(300):
        own = index.texts[rng.randrange(150)][1]
        words = set(rng.sample(names, 15)) | {index.terms[w] for w in decontamination.words_of(own) if rng.random() < 0.7}
        for threshold in (0.1, 0.3, 0.6):
            mass = np.zeros(len(index.items))
            for t in words:
                np.add.at(mass, index.postings[t][0], index.postings[t][1])
            expected = {s: mass[s] for s in np.flatnonzero(mass >= threshold - 1e-9)}
            found = dict(decontamination.block_max_wand(index, sorted(words), threshold))
            assert found.keys() == expected.keys()
            assert all(abs(found[s] - expected[s]) < 1e-9 for s in found)


def leaked(words: list[str], text: str) -> bool:
    """Whether both parts of an item stand in some stretch of a document, by brute force."""
    question, answer = decontamination.question_and_answer(text)
    grams, single = set(decontamination.triples(words)), set(words)
    return all(decontamination.overlap(p, grams, single) >= decontamination.OVERLAP for p in (question, answer))


def test_planted_items_are_found_and_clean_documents_left(spark):
    rng = random.Random(16)
    held = items(rng, 60) + [(60, prose(rng, 150) + "?\n" + prose(rng, 90)), (61, None), (62, ""), (0, "a b c")]
    rows, planted = awkward_rows(), set()
    for k in range(120):
        words = prose(rng, rng.randint(0, 400)).split()
        if k % 3 == 0:
            item = held[rng.randrange(61)]
            at = rng.randint(0, len(words))
            words[at:at] = item[1].split()
            planted.add((100 + k, item[0]))
        rows.append((100 + k, " ".join(words), None, None, None))
    benchmark = spark.createDataFrame(held, "item_id long, text string")
    got = decontamination.leaks(with_clashes(documents(spark, rows)), benchmark)
    found = {(r.doc_id, r.item_id) for r in got.collect()}
    assert planted <= found
    text = {r[0]: r[1] for r in rows}
    for doc, item in found - planted:
        assert any(leaked(decontamination.words_of(text[doc]), t) for i, t in held if i == item)
    clean = decontamination.without_leaks(with_clashes(documents(spark, rows)), benchmark)
    assert clean.count() == len(rows) - sum(r[0] in {d for d, _ in found} for r in rows)


def test_repeated_items_are_found_each_by_its_own_id(spark):
    """A third of the items are copies of one, and every item comes in two spellings."""
    rng = random.Random(22)
    held = items(rng, 40)
    held += [(100 + i, text.upper()) for i, text in held]
    held += [(200 + k, held[0][1]) for k in range(40)] + [(None, held[0][1])]
    rows = [(i, f"{prose(rng, 30)} {held[i][1]} {prose(rng, 200)}", None, None, None) for i in range(40)]
    benchmark = spark.createDataFrame(held, "item_id long, text string")
    got = decontamination.leaks(documents(spark, rows), benchmark).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert len(got) == len(found)
    assert {(i, i) for i in range(40)} | {(i, 100 + i) for i in range(40)} <= found
    assert {(0, 200 + k) for k in range(40)} | {(0, None)} <= found
    assert decontamination.without_leaks(documents(spark, rows), benchmark).count() == 0


def test_candidates_hold_every_passage_that_reaches_the_threshold(monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_HITS", 50)
    rng = random.Random(23)
    words = [prose(rng, 1) for _ in range(40)]  # every word is in many segments
    held = [(i, " ".join(rng.choices(words, k=rng.randint(5, 150)))) for i in range(60)]
    index = decontamination.build(held)
    searcher = decontamination.Searcher(index)
    for _ in range(60):
        text = [index.terms[w] for w in decontamination.words_of(" ".join(rng.choices(words, k=rng.randint(1, 400))))]
        terms, halves = np.array(text), np.arange(len(text)) // decontamination.HALF
        expected = set()
        for p in range(int(halves[-1]) + 1):
            mass = np.zeros(len(index.items))
            for t in set(terms[(halves >= p) & (halves <= p + 1)].tolist()):
                np.add.at(mass, index.postings[t][0], index.postings[t][1])
            if (mass >= decontamination.THRESHOLD).any():
                expected.add(p)
        assert expected <= set(searcher.candidates(terms, halves).tolist())


def test_index_in_parts_finds_the_same(spark, monkeypatch):
    rng = random.Random(17)
    held = items(rng, 40)
    rows = [(i, f"{prose(rng, 30)} {held[i][1]}", None, None, None) for i in range(40)]
    benchmark = spark.createDataFrame(held, "item_id long, text string")
    monkeypatch.setattr(decontamination, "PART_WORDS", 200)
    assert len(decontamination.indexes(benchmark)) > 3
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(documents(spark, rows), benchmark).collect()}
    assert {(i, i) for i in range(40)} <= got


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.leaks(documents(spark), none).count() == 0
    assert decontamination.without_leaks(documents(spark), none).count() == len(awkward_rows())
    some = spark.createDataFrame([(1, "a b c d?\ne")], "item_id long, text string")
    assert decontamination.leaks(documents(spark, []), some).count() == 0
