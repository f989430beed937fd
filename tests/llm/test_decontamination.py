import random
import re
from collections import Counter

import numpy as np

from conftest import SF_DIR
from sangam.llm import decontamination


def words_of(text):
    return [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


def bag(words, size=5):
    size = min(size, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(docs, items):
    out = {}
    for i, item in ((i, words_of(t)) for i, t in items if words_of(t)):
        want = bag(item)
        for d, text in docs:
            words = words_of(text)
            for at in range(len(words) - len(item) + 1):
                have = bag(words[at : at + len(item)])
                common = sum((want & have).values())
                value = common / (sum(want.values()) + sum(have.values()) - common)
                if value >= 0.8 and value > out.get((d, i), 0):
                    out[d, i] = value
    return out


def test_equals_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 8, 20, 40, 60])))) for i in range(40)]
    docs = []
    for j in range(150):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 80))]
        part = words_of(items[rng.randrange(40)][1])
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            part[rng.randrange(len(part))] = rng.choice(vocabulary)
        at = rng.randrange(len(own) + 1)
        docs.append((j, " ".join(own[:at] + part + own[at:])))
    items += [(100, None), (101, ""), (102, items[5][1])]
    docs += [(1000, None), (1001, "")]
    left = spark.createDataFrame([(*d, 0.0) for d in docs], "doc_id long, text string, similarity double")
    right = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.contaminated(left, right).collect()}
    want = brute(docs, items)
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    clean = decontamination.clean(left, right)
    assert clean.columns == left.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert decontamination.contaminated(left.limit(0), right).collect() == []
    assert decontamination.contaminated(left, right.limit(0)).collect() == []


def test_item_blocks_change_nothing(spark, monkeypatch):
    one = {tuple(r) for r in decontamination.op4_decontamination(spark, SF_DIR).collect()}
    monkeypatch.setattr(decontamination, "ITEM_BLOCK", 9)
    assert one == {tuple(r) for r in decontamination.op4_decontamination(spark, SF_DIR).collect()} and one


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, size=300, dtype=np.uint64)
    items = decontamination.Items.of([(i, " ".join(f"x{i}y{k}" for k in range(9))) for i in range(300)], 5)
    near = decontamination._near_values()
    items.prints = prints
    blocks = prints.view(np.uint8).reshape(-1, 8)
    assert list(items.by_words) == [9]
    items.index[9] = [
        {v: np.flatnonzero([v in near[x] for x in blocks[:, b]]) for v in range(256)} for b in range(decontamination.BLOCKS)
    ]
    for _ in range(50):
        probe = prints[rng.integers(300)]
        for bit in rng.choice(64, size=rng.integers(0, 21), replace=False):
            probe ^= np.uint64(1) << np.uint64(bit)
        want = np.flatnonzero(np.bitwise_count(prints ^ probe) <= decontamination.RADIUS)
        assert items.within(9, probe).tolist() == want.tolist()


def test_texts_shorter_than_an_item(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 8, 20, 40, 60])))) for i in range(60)]
    docs = []
    for i, text in items:
        for less in (0, 1, 2, 5, 9, 12, 14):
            words = words_of(text)[less // 2 :]
            docs.append((len(docs), " ".join(words[: max(0, len(words) - (less - less // 2))])))
    want = brute(docs, items)
    for d, text in docs:  # the whole of a text that is shorter than the item
        for i, item in items:
            have, of_item = bag(words_of(text)) if text else Counter(), bag(words_of(item))
            common = sum((of_item & have).values())
            if 0 < len(words_of(text)) < len(words_of(item)) and common >= 0.8 * (sum(of_item.values()) + sum(have.values()) - common):
                want[d, i] = common / (sum(of_item.values()) + sum(have.values()) - common)
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    rows = decontamination.contaminated(left, right).collect()
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in rows} == {k: round(v, 9) for k, v in want.items()}
    of = dict(docs)
    assert all(r.first_word + r.n_words <= len(words_of(of[r.doc_id])) for r in rows)
    assert {r.doc_id for r in decontamination.clean(left, right).collect()} == set(of) - {d for d, _ in want}


def test_blocks_by_bytes_null_ids_repeated_rows_and_ties(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "ITEM_BYTES", 60)
    one, two = " ".join(f"a{i}" for i in range(12)), " ".join(f"b{i}" for i in range(12))
    items = spark.createDataFrame([(1, one), (1, one), (None, two), (2, "")], "item_id long, text string")
    docs = spark.createDataFrame([(7, f"x {one} y {one}"), (7, f"x {one} y {one}"), (None, two.upper()), (8, "a0 a1 a2")], "doc_id long, text string")
    got = decontamination.contaminated(docs, items).collect()
    # each repeated item counts, and of equal windows the first
    assert sorted((str(r.doc_id), str(r.item_id), r.first_word, r.n_words) for r in got) == [("7", "1", 1, 12)] * 4 + [("None", "None", 0, 12)]
    assert [r.doc_id for r in decontamination.clean(docs, items).collect()] == [8]
