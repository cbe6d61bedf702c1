from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfmark.llm import queries, substring_dedup
from shelfmark.llm.common import FREE_SHUFFLES, stored
from tests.llm.cases import awkward_rows, documents, prose, with_clashes


def test_gear_hash_is_the_rolling_sum():
    data = np.frombuffer(b"some bytes that are longer than the window of the hash", np.uint8)
    value = 0
    for byte, got in zip(data, substring_dedup.gear_hashes(data)):
        value = ((value << 1) + int(substring_dedup.GEAR[byte])) % (1 << 32)
        assert value == got


def test_chunks_cover_the_text_and_resist_an_insertion():
    text = prose(random.Random(18), 3000)
    moved = text[:50] + " inserted " + text[50:]
    parts = []
    for value in (text, moved):
        raw = value.encode()
        ends = substring_dedup.chunk_ends(np.frombuffer(raw, np.uint8))
        pieces = [raw[a:b] for a, b in zip([0, *ends], ends)]
        assert b"".join(pieces) == raw and max(map(len, pieces)) <= 2 * substring_dedup.MAX_CHUNK
        parts.append(set(pieces))
    assert len(parts[0] - parts[1]) <= 4


def test_repeated_passages_of_over_fifty_words_are_found(spark):
    rng = random.Random(19)
    passage, rows, planted = prose(rng, 55), awkward_rows()[2:], set()
    for k in range(150):
        words = prose(rng, rng.randint(30, 200)).split()
        if k % 5 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = passage.split()
            planted.add(100 + k)
        rows.append((100 + k, " ".join(words) + "\nLicensed under some short line.", None, None, None))
    df = with_clashes(documents(spark, rows))
    found = substring_dedup.documents(df).where(f"longest_shared >= {substring_dedup.MIN_WORDS}").cache()
    assert {r.doc_id for r in found.collect()} == planted
    # One place stays whole, all others lose most of the passage and nothing else.
    cut = {r.doc_id: r.text for r in substring_dedup.without_repeats(df, found).collect()}
    text = {r[0]: r[1] for r in rows}
    lost = {i: len((text[i] or "").split()) - len((cut[i] or "").split()) for i in text if i}
    assert sum(lost[i] == 0 for i in planted) == 1 and all(20 <= lost[i] <= 56 for i in planted if lost[i])
    assert all(lost[i] == 0 for i in lost if i not in planted)


def test_first_places_and_within_document_repeats(spark):
    rng = random.Random(20)
    passage = prose(rng, 120)
    rows = [(1, f"{prose(rng, 30)} {passage} {prose(rng, 10)} {passage}", None, None, None), (2, prose(rng, 100), None, None, None)]
    got = substring_dedup.documents(documents(spark, rows)).collect()
    assert [r.doc_id for r in got] == [1] and got[0].longest_shared == 0 and 60 <= got[0].removed_words <= 122


def test_passages_shared_by_just_two_documents(spark):
    rng = random.Random(25)
    rows = []
    for k in range(300):
        passage = prose(rng, 51 + k % 10)
        for i in (2 * k, 2 * k + 1):
            words = prose(rng, rng.randint(0, 120)).split()
            at = rng.randint(0, len(words))
            rows.append((i, " ".join([*words[:at], passage, *words[at:]]), None, None, None))
    df = documents(spark, rows)
    found = substring_dedup.documents(df).cache()
    got = {r.doc_id: r for r in found.collect()}
    assert all(51 <= got[i].longest_shared <= 62 for i in range(600))
    # A neighbouring chunk of a word or two may stand elsewhere as well.
    assert [k for k in range(300) if got[2 * k].removed_words > 3 or got[2 * k + 1].removed_words < 51] == []
    cut = {r.doc_id: r.text for r in substring_dedup.without_repeats(df, found).collect()}
    assert all(len(r[1].split()) - len(cut[r[0]].split()) == got[r[0]].removed_words for r in rows)


def test_equal_and_null_ids_are_documents_of_their_own(spark):
    rng = random.Random(26)
    rows = []
    for i in (7, None):
        passage = prose(rng, 80)
        rows += [(i, f"{prose(rng, 30)} {passage} {prose(rng, 30)}", None, None, None) for _ in range(2)]
    df = documents(spark, rows)
    found = substring_dedup.documents(df).cache()
    got = found.collect()
    assert len(got) == 4 and all(r.longest_shared >= 80 for r in got)
    assert sorted(r.removed_words >= 80 for r in got) == [False, False, True, True]


def test_query_returns_repeats_within_a_document(spark, tmp_path):
    rng = random.Random(27)
    passage = prose(rng, 120)
    rows = [(1, f"{passage} {prose(rng, 10)} {passage}", None, None, None), (2, prose(rng, 100), None, None, None)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op10_substring_dedup(spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.longest_shared) for r in got] == [(1, 0)] and got[0].removed_words >= 100


def test_empty_table(spark):
    assert substring_dedup.documents(documents(spark, [])).count() == 0


def test_texts_cut_together_are_cut_as_alone():
    rng = np.random.default_rng(3)
    texts = [b"", b"a", b"  ", b"x" * 3000, b"word " * 40]
    texts += [bytes(rng.choice(np.frombuffer(b"abcdefgh  \n", np.uint8), n)) for n in (5, 31, 33, 1000, 4000)]
    texts += [bytes(rng.integers(97, 123, 5000, np.uint8)), b""]
    number, starts, ends, words = substring_dedup._ends_of([np.frombuffer(t, np.uint8) for t in texts])
    for k, raw in enumerate(texts):
        mine = number == k
        alone = substring_dedup.chunk_ends(np.frombuffer(raw, np.uint8))
        assert ends[mine].tolist() == alone and starts[mine].tolist() == [0, *alone][: len(alone)]
        assert b"".join(raw[a:b] for a, b in zip(starts[mine], ends[mine])) == raw
        assert words[mine].sum() == len(raw.split())
        assert all(b - a <= substring_dedup.MAX_CHUNK for a, b in zip(starts[mine], ends[mine]) if b"x" * 50 in raw)
        assert all(raw[b - 1 : b].isspace() or b == len(raw) or b - a == substring_dedup.MAX_CHUNK for a, b in zip(starts[mine], ends[mine]))


def test_half_digests_are_those_of_the_chunks(spark):
    rows = [(1, "one two three " * 30), (2, None), (3, ""), (None, "é ü " * 500), (5, "y" * 2500)]
    texts = substring_dedup.numbered(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", None)
    parts = substring_dedup.chunks(texts).collect()
    assert sorted(r.low for r in parts) == sorted(r.low for r in substring_dedup.half_digests(texts).collect())
    assert {r.doc_id for r in parts} == {1, None, 5}


def _shuffled_bytes(spark) -> int:
    """What the shuffles of this session keep on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(k) for k in range(files.size())]
    return sum(f.length() for f in files if f.getName().startswith("shuffle_"))


def test_shuffles_go_when_their_table_is_stored(spark):
    before = _shuffled_bytes(spark)
    df = spark.range(300_000).groupBy((F.col("id") % 100_003).alias("key")).count()
    assert stored(df, "tidied", tidy=True).count() == 100_003
    for _ in range(100):  # they are removed in the background
        left = _shuffled_bytes(spark) - before
        if left < 100_000:
            break
        time.sleep(0.1)
    assert left < 100_000
    assert spark.conf.get(FREE_SHUFFLES) == "false"


def test_chunks_are_packed_small_and_whole():
    rng = random.Random(32)
    texts = [prose(rng, 200) for _ in range(400)] + [None, "", "y" * 2500]
    ids = [None if i % 50 == 0 else i for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts), pa.array(range(len(texts)), pa.int64())], ["doc_id", "text", "row"])
    parts = list(substring_dedup._columns([batch]))
    found = {c: np.concatenate([x[c] for x in parts]) for c in substring_dedup.PACKED}
    packed = substring_dedup._packed({c: x.copy() for c, x in found.items()}, 5)
    n = len(found["row"])
    assert packed.num_rows == 5 and packed.nbytes < 24 * n
    back = substring_dedup._unpacked(pa.Table.from_batches([packed]))
    names = [c for c in found if c != "part"]
    assert sorted(zip(*(back[c].tolist() for c in names))) == sorted(zip(*(found[c].tolist() for c in names)))


def test_repeated_chunks_by_brute_force(spark):
    rng = random.Random(33)
    line, rows = prose(rng, 60), []  # its chunks are more frequent than FREQUENT in a task
    for i in range(700):
        words = prose(rng, 40).split()
        rows.append((None if i == 650 else i % 600, " ".join([*words[:20], *([line] * (1 + i % 2)), *words[20:]]), None, None, None))
    df = documents(spark, rows).coalesce(2)
    texts = stored(substring_dedup.numbered(df, "doc_id", "text", None), "numbered")
    places = {}
    for r in substring_dedup.chunks(texts).collect():
        places.setdefault((r.high, r.low), []).append((r.doc_id is not None, r.doc_id or 0, r.row, r.start, r.length, r.n_words))
    expected = set()
    for same in filter(lambda p: len(p) > 1, map(sorted, places.values())):
        for k, p in enumerate(same):
            partner = same[0] if k else same[-1]
            expected.add((*p, k == 0, same[0][2] != same[-1][2], *partner[2:5]))
    assert max(map(len, places.values())) > 10 * substring_dedup.FREQUENT
    got = substring_dedup.repeated_chunks(texts).collect()
    assert len(got) == len(expected) and expected == {
        (r.doc_id is not None, r.doc_id or 0, r.row, r.start, r.length, r.n_words, r.is_first, r.across, *r.partner) for r in got
    }
    text = {r.row: r.text.encode() for r in texts.collect()}
    for r in got:  # sides that are left out have different words next to them
        own, other = text[r.row], text[r.partner.row]
        ends = (r.start + r.length, r.partner.start + r.partner.length)
        assert r.meets_left or own[: r.start].split()[-1] != other[: r.partner.start].split()[-1]
        assert r.meets_right or own[ends[0] :].split()[0] != other[ends[1] :].split()[0]
    assert not all(r.meets_left for r in got) and not all(r.meets_right for r in got)
