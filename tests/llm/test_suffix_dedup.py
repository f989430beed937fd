import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from conftest import SF_DIR
from sangam.llm import suffix_dedup
from sangam.llm.suffix_array import common_prefixes, suffix_array


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for turn in range(600):
        n, kinds = rng.randrange(1, 60), rng.choice([1, 2, 3, 10])
        symbols = [rng.randrange(1, kinds + 1) for _ in range(n)] if turn % 5 else ([1, 2, 1] * 20)[:n]
        text = np.array([*symbols, 0])
        order = suffix_array(text)
        as_list = text.tolist()
        assert order.tolist() == sorted(range(len(text)), key=lambda i: as_list[i:])
        left = np.arange(len(text), 0, -1) - 1
        previous, length = common_prefixes(text, order, left)
        for before, at in zip(order, order[1:]):
            n = 0
            while n < min(left[at], left[before]) and text[at + n] == text[before + n]:
                n += 1
            assert previous[at] == before and length[at] == n


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    counts = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, data):
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if counts[b[j : j + length]] > 1:
                gone[j : j + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone) if not y)
        runs = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def random_rows():
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passages = [text(rng.randrange(30, 200)) for _ in range(6)]
    rows = []
    for i in range(150):
        more = rng.choice(passages) if rng.random() < 0.4 else ""
        rows.append((i, text(rng.randrange(0, 80)) + rng.choice(passages)[rng.randrange(0, 10) :] + text(rng.randrange(0, 60)) + more))
    again = text(70)
    rows += [(900, None), (901, ""), (902, "a" * 300), (903, "ab" * 100 + "x" * 30), (904, "xyz" * 90), (None, passages[0])]
    return rows + [(905, again), (905, again), (906, "éü" * 60), (907, "q" + "éü" * 30)]


@pytest.mark.parametrize("shard", [1 << 20, 3000, 400])
def test_equals_brute_force(spark, shard):
    rows = random_rows()
    docs = spark.createDataFrame([(*r, b"") for r in rows], "doc_id long, text string, data binary")
    got = suffix_dedup.remove_duplicates(docs, 40, 8, shard).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 40)


def test_crowded_anchor(spark):
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = text(150)
    rows = [(i, text(rng.randrange(20, 60)) + passage + text(rng.randrange(20, 60))) for i in range(120)]
    got = suffix_dedup.remove_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 40, 8, 2000).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 40)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_duplicates(docs).collect() == []


def test_blocks_of_a_long_text_agree(monkeypatch):
    rng = random.Random(7)
    data = bytes(rng.randrange(97, 103) for _ in range(5000))
    whole = list(suffix_dedup.contexts_of(data, 60, 8))
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 700)
    cut = list(suffix_dedup.contexts_of(data, 60, 8))
    windows = lambda found: {(s, key, first + place) for key, first, end, place, *_ in found for s in range(first, end - 60 + 1)}
    assert windows(whole) == windows(cut) and len({s for s, *_ in windows(cut)}) == 5000 - 60 + 1


def test_query_equals_brute_force_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = suffix_dedup.op1_suffix_array(spark, SF_DIR).collect()
    want = brute(rows, suffix_dedup.LENGTH)
    assert sorted((tuple(r)[:5] for r in got), key=str) == want and all(r.repeats == (r.n_removed > 0) for r in got)
    assert sum(r[2] > 0 for r in want) > 10


def test_order_by_doubling_equals_sorting():
    from sangam.llm import suffix_array as module

    rng = random.Random(5)
    for n in (1, 2, 5, 60, 400):
        for symbols in (1, 2, 5, 300):
            text = [rng.randrange(1, symbols + 1) for _ in range(n - 1)] + [0]
            want = sorted(range(n), key=lambda i: text[i:])
            assert module.doubled(np.array(text, dtype=np.int64)).tolist() == want


def test_keys_of_contexts_are_of_the_bytes_round_the_anchor():
    rng = random.Random(9)
    passage = bytes(rng.randrange(256) for _ in range(1500))
    seen, keys = {}, {}
    for before in (0, 7, 450):
        data = bytes(rng.randrange(256) for _ in range(before)) + passage
        for key, first, end, place, least, most in suffix_dedup.contexts_of(data):
            at = first + place
            sure = least, most, data[at - least : at + suffix_dedup.LENGTH - most]
            assert seen.setdefault(sure, key) == key and keys.setdefault(key, sure) == sure
    assert len(seen) < 3 * len(suffix_dedup._contexts(passage)[0])
