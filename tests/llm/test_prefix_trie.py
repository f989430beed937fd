import hashlib
import random
import re
import zlib

import numpy as np

import compare
from conftest import SF_DIR
from sangam.llm import oracle, prefix_trie


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    nodes, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - int(np.fmod(c, 20)), [])[:h] + turns[h:])
        ends.setdefault(path, []).append(c)
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    below = {p: [0, 0, 0] for p in nodes}
    for path in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        below[path][1] += below[path][0] == 0
        below[path][2] += (len(nodes[path]) - 1) * words
        if path:
            above = below[path[:-1]]
            above[0] += 1
            above[1] += below[path][1]
            above[2] += below[path][2]
    out = []
    for path, members in nodes.items():
        listed = ",".join(map(str, sorted(ends.get(path, []))))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), *below[path], hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows):
    convs = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, depth int, key string")
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(convs).collect()), key=str)


def grown(n, rng):
    """Conversations that branch off others, some equal, some prefixes of others, one very long, with odd rows."""
    said, rows = [[("user", "hello there")]], []
    for c in range(n):
        turns = list(rng.choice(said)) if rng.random() < 0.7 else [("user", "hello there")] * (rng.random() < 0.5)
        turns = turns[: rng.randrange(len(turns) + 1)] + [(rng.choice("ab"), f"t {rng.randrange(4)}") for _ in range(rng.randrange(4))]
        said.append(turns)
        rows += [(c * 3, i, *t) for i, t in enumerate(turns)]
    rows += [(c, i, "user", "same words here") for c in range(3000, 3400) for i in range(6)]
    rows += [(7000, i, "user", f"long {i % 5}") for i in range(3000)] + [(7100, i, "user", f"long {i % 5}") for i in range(2900)]
    rows += [(-41, None, None, None), (-41, 2, "x", ""), (8001, 1, "r", "q"), (8001, 1, "r", "q"), (None, 1, "a", "b"), (8001, 1, "a", "b")]
    rows += [(9001, 0, "u", "only one")]
    rng.shuffle(rows)
    return rows


def test_equals_sql_on_conversations(spark):
    con = compare.connect(SF_DIR)
    assert compare.spark_rows(prefix_trie.op12_prefix_trie(spark, SF_DIR)) == compare.duck_rows(con, oracle.OP12)


def test_equals_brute_force_in_one_shard_and_many(spark, monkeypatch):
    rows = grown(400, random.Random(2))
    want = brute(rows)
    assert trie(spark, rows) == want
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 50)
    monkeypatch.setattr(prefix_trie, "LIST_BITS", 3)
    monkeypatch.setattr(prefix_trie, "BAND_BITS", 4)
    assert trie(spark, rows) == want


def test_one_conversation_without_turns_and_none(spark):
    # 9001 borrows its first turn from 9000, which isn't there, and has no other
    rows = [(9001, 0, "u", "x")]
    assert zlib.crc32(b"9001") % 4 > 0
    assert trie(spark, rows) == brute(rows)
    assert trie(spark, rows)[0][1] == 0 and len(trie(spark, rows)) == 1
    assert trie(spark, []) == [] and trie(spark, [(None, 0, "u", "x")]) == []


def test_double_array_holds_exactly_its_paths():
    rng = random.Random(4)
    paths = sorted({"".join(hashlib.md5(str(rng.randrange(300 if i % 3 else 5)).encode()).hexdigest() for _ in range(rng.randrange(7))) for i in range(2000)})
    codes, lengths, n = prefix_trie.dense_turns(paths)
    tree = prefix_trie.packed(codes, lengths, n)
    starts, seen = np.cumsum(lengths) - lengths, {}
    prefixes = set()
    for p, start, length in zip(paths, starts, lengths):
        node = np.zeros(1, dtype=np.int64)
        for d in range(length):
            node = tree.step(node, codes[start + d : start + d + 1])
            assert node[0] > 0
            prefix = p[: 32 * (d + 1)]
            assert seen.setdefault(int(node[0]), prefix) == prefix
            prefixes.add(prefix)
    assert len(seen) == len(prefixes) == int((tree.check >= 0).sum()) - 1
    assert len(tree.check) < 3 * len(prefixes) + 2048
