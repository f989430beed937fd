import random
import re

from conftest import SF_DIR
from sangam.llm import minhash


def brute(rows, size=4, percent=80):
    sets = {}
    for i, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        sets[i] = {tuple(words[j : j + size]) for j in range(max(1, len(words) - size + 1))} if words else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def grouped(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_equals_brute_force_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert grouped(minhash.op7_minhash(spark, SF_DIR)) == brute(rows)


def test_hot_groups_and_edges(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    base, passage = ([rng.choice(words) for _ in range(n)] for n in (200, 120))
    rows = []
    for i in range(60):
        varied = list(base)
        for _ in range(rng.randrange(0, 6)):
            varied[rng.randrange(200)] = rng.choice(words)
        rows.append((len(rows), " ".join(varied)))
        own = [rng.choice(words) for _ in range(40)]
        rows.append((len(rows), " ".join(passage + own)))
        if i % 5 == 0:
            own[3] = "zz"
            rows.append((len(rows), " ".join(passage + own)))
    rows += [(9000, None), (9001, ""), (9002, " \n"), (9003, "a b"), (9004, "A B"), (9005, "a"), (9007, "É x"), (9008, "é x")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, component_id int")
    assert grouped(minhash.near_duplicates(docs)) == brute(rows)
    assert minhash.near_duplicates(docs.limit(0)).collect() == []


def test_nulls_and_repeated_rows(spark):
    rows = [(None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (None, "x"), (None, None)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in got) == sorted(
        [("1", 2, 1, True), ("1", 2, 1, True), ("None", 2, 1, False), ("None", 1, None, True), ("None", 0, None, True)], key=lambda r: (r[0], r[1])
    )


def test_components_of_a_path(spark, monkeypatch):
    from sangam.llm.common import Scratch
    from sangam.llm.components import components

    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 60), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components(links, Scratch(spark, "path")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 60: 50}


def test_copies_of_members_of_a_crowd(spark):
    """Texts that are like one variant of a much varied text, not like its hub, and like no other."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(20000)]
    base = [rng.choice(words) for _ in range(400)]

    def edited(text, n):
        text = list(text)
        for at in rng.sample(range(len(text)), n):
            text[at] = rng.choice(words)
        return text

    variants = [edited(base, rng.randrange(1, 3)) for _ in range(300)]
    second = [edited(variants[i], 11) for i in range(60)]
    rows = [(i, " ".join(t)) for i, t in enumerate(variants + second)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert grouped(minhash.near_duplicates(docs)) == want


def test_rows_of_one_document_in_either_order(spark):
    """Document 1 has the texts of 2 and of 3, so all three are one; document 7 has two texts of its own."""
    rows = [(2, "a b c d e"), (3, "p q r s t"), (1, "a b c d e"), (1, "p q r s t"), (7, "k l m n o"), (7, "u v w x y"), (8, "u v w x y")]
    for order in (rows, rows[::-1]):
        got = minhash.near_duplicates(spark.createDataFrame(order, "doc_id long, text string").repartition(2)).collect()
        assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (2, 1, False), (3, 1, False), (7, 7, True), (8, 7, False)}
        assert len(got) == len(rows)


def test_crowds_in_many_blocks(spark, monkeypatch):
    """Variants that are like some of a crowd only, and two crowds that touch, with blocks of a few texts."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(9000)]
    base = [rng.choice(words) for _ in range(200)]

    def edited(text, n):
        text = list(text)
        for at in rng.sample(range(len(text)), n):
            text[at] = rng.choice(words)
        return text

    variants = [edited(base, rng.randrange(3, 9)) for _ in range(160)]
    rows = variants + [edited(variants[i], 5) for i in range(40)] + [edited(base, 14) for _ in range(40)]
    rows = [(i, " ".join(t)) for i, t in enumerate(rows)]
    monkeypatch.setattr(minhash, "TILE", 4000)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert grouped(minhash.near_duplicates(docs)) == brute(rows)


def test_sets_take_one_python_worker_a_task(spark, monkeypatch):
    from sangam.llm.common import Scratch

    plans, keep = {}, Scratch.keep

    def kept(scratch, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(scratch, df, name)

    monkeypatch.setattr(Scratch, "keep", kept)
    text = " ".join(f"w{i}" for i in range(100))
    docs = spark.createDataFrame([(1, text), (2, text + " x"), (2, text + " y"), (None, text), (3, None), (4, "a b c d e")], "doc_id long, text string")
    found = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert found == {(1, 1), (2, 1), (None, 1), (3, 3), (4, 4)}
    assert plans["sets"].count("MapInArrow") == 1


def test_joined_crowds_make_no_searches_of_their_own(spark, monkeypatch):
    """Of larger buckets only those whose nodes aren't all in one component go on, and no search for components is spent on crowds."""
    from sangam.llm.common import Scratch

    tables, keep = {}, Scratch.keep

    def kept(scratch, df, name):
        tables[name] = keep(scratch, df, name)
        return tables[name]

    monkeypatch.setattr(Scratch, "keep", kept)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(9000)]

    def variants(n, changes):
        base = [rng.choice(words) for _ in range(300)]
        texts = [list(base) for _ in range(n)]
        for text in texts:
            for at in rng.sample(range(300), changes):
                text[at] = rng.choice(words)
        return [" ".join(text) for text in texts]

    near, apart = variants(60, 1), variants(60, 12)
    rows = list(enumerate(near + apart))
    got = grouped(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows)
    assert not [name for name in tables if name.startswith("crowds")]
    assert {r.node for r in tables["crowd-members"].collect()} <= set(range(60, 120))
    assert not tables["crowd-members"].isEmpty()
