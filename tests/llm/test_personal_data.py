from __future__ import annotations

import hashlib
import random
import re

from shelfmark.llm import personal_data
from tests.llm.cases import awkward_rows, documents, with_clashes

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PARTS = ["a@b.c", "+d@e.f", "@", "1.2.3.4", ".5", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111", " ", "\n",
         "+1 (017) 555-7713", "+1", "-", "é", "😀", "5", "0", "..", "a.b%", "(555) 123-4567", "joe (at) mail (dot) com",
         "call ", "0001.1.1.01", "999999999999.1.1.1"]


def luhn(digits: str) -> bool:
    worth = [int(c) for c in reversed(digits)]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(worth)) % 10 == 0


def base_spans(text: str) -> list[tuple]:
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def test_base_spans_on_random_and_awkward_texts(spark):
    rng = random.Random(14)
    rows = awkward_rows()
    rows += [(100 + k, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 9))), None, None, None) for k in range(800)]
    df = with_clashes(documents(spark, rows))
    got = personal_data.find(df).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for name, text, *_ in rows[len(awkward_rows()) :]:
        spans, row = base_spans(text), by_id[name]
        listed = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), text
        counts = [sum(s[3] == kind for s in spans) for kind in BASE]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts
        assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))


def test_long_runs_take_time_in_proportion(spark):
    texts = ["a" * 400_000, "1" * 400_000, "a.a" * 130_000 + "@x.y", "+1" + " " * 400_000, "1.2.3." * 60_000, "1 " * 150_000]
    got = personal_data.find(documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])).collect()
    assert {r.doc_id: r.n_email for r in got} == {0: 0, 1: 0, 2: 1, 3: 0, 4: 0, 5: 0}


def test_weak_labelers_find_more_and_leave_numbers_alone(spark):
    texts = [f"mail joe{k}@host{k}.com or call +1 (017) 555-77{k:02d} now" for k in range(60)]
    texts += [f"email joe{k} (at) host (dot) com" for k in range(15)] + [f"order 1234 id 98765{k} version 1.2.3" for k in range(40)]
    got = {r.doc_id: r for r in personal_data.find(documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])).collect()}
    assert all(got[i].spans.startswith("email:6:") for i in range(60, 75)) and all(got[i].n_email == 0 for i in range(60, 75))
    assert all(got[i].spans == "" for i in range(75, 115))


def test_reliabilities_favour_labelers_that_agree(spark):
    good, bad = [1, 1, 1, 1, -1], [0, 0, 0, -1, 0]
    spans = [(0, 0, 5, True, good, [0, 0, 0])] * 30 + [(0, 0, 5, False, bad, [1, 0, 0])] * 30
    df = spark.createDataFrame([(1, spans)], f"doc_id long, spans array<{personal_data.SPAN}>")
    row = personal_data.reliabilities(df).first()
    assert 0.4 < row.prior < 0.6
    assert row.labelers[0].yes > 0.9 > 0.1 > row.labelers[0].no
    assert row.shapes[0].yes < 0.1 < 0.9 < row.shapes[0].no


def test_redaction_keeps_columns_and_the_rest_of_the_text(spark):
    df = with_clashes(documents(spark, [(1, "é joe@x.com, 1.2.3.4!", "en", None, 3), (2, None, None, None, None), (3, "", None, None, 0)]))
    got = personal_data.redacted(df)
    assert got.columns == df.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "é <EMAIL>, <IP>!", 2: None, 3: ""}


def test_empty_table_and_plan(spark):
    assert personal_data.find(documents(spark, [])).count() == 0
    plan = personal_data.proposed(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)
