import hashlib

import compare
from conftest import SF_DIR
from sangam.llm import fill_in_middle as fim, oracle


def expected(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def rows_of(spark, rows, units):
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, form string, n int")
    made = fim.fill_in_middle(fim.store_frames(docs, units))
    return made, fim.digests(made).collect()


def test_equals_sql_on_documents(spark):
    con = compare.connect(SF_DIR)
    assert compare.spark_rows(fim.op11_fill_in_middle(spark, SF_DIR)) == compare.duck_rows(con, oracle.OP11)


def test_small_frames_equal_plain_python(spark):
    texts = ["", None, "a", "<", "<P", "P>", "<P>", "ab<S>cd", "x<M>", "é😀ü" * 50, "<<P<S<M>x"[:6] * 20, "<S" * 40, "w " * 20_000]
    rows = [(i * len(texts) + j, t) for i in range(12) for j, t in enumerate(texts)] + [(None, "no id, some text"), (5, "twice"), (5, "twice")]
    for units in (1, 2, 3, 7, fim.UNITS):
        some = rows if units > 3 else [r for r in rows if len(r[1] or "") < 1000]
        made, got = rows_of(spark, some, units)
        want = []
        for doc_id, text in some:
            form, prefix, middle, output = expected(doc_id, text)
            digests = [hashlib.sha256(t.encode()).hexdigest() for t in (output, text or "")]
            want.append((doc_id, len(text or ""), form, prefix, middle, *digests))
        key = lambda r: (r[0] is None, r[0], r[1])
        assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
        assert {"psm", "spm", "plain"} <= {r[2] for r in want}
    output = {r.doc_id: r.text for r in fim.texts_of(made).collect()}
    before = {r.doc_id: r.text for r in fim.texts_of(made, restore=True).collect()}
    assert output == {i: expected(i, t)[3] for i, t in rows}
    assert before == {i: t or "" for i, t in rows}


def test_only_cut_frames_are_opened(monkeypatch):
    text = fim.Frames.of("".join(chr(97 + i % 26) for i in range(10_000)), 100)
    opened = []
    plain = fim.Frames.plain
    monkeypatch.setattr(fim.Frames, "plain", lambda self, i: opened.append(i) or plain(self, i))
    made = fim.Frames()
    made.copy(text, 150, 9_950)
    assert opened == [1, 99] and made.frames[1:-1] == text.frames[2:99] and len(made) == 9_800
    assert "".join(text.read(9_990, 10_000)) == "".join(chr(97 + i % 26) for i in range(9_990, 10_000)) and opened[2:] == [99]


def test_empty_table(spark):
    assert rows_of(spark, [], 10)[1] == []
