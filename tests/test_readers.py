import csv
import io
import random

import pyarrow as pa
import pytest
from conftest import plan_of

import sangam as S
from sangam.schema import LOAD_ORDER
from sangam.sources import array_csv, conll, lines, manifest


def brute_sentences(data: bytes):
    """What a line-by-line reading gives, written independently of the operator."""
    text = data.decode("utf-8", errors="replace").replace("\r\n", "\n").replace("\r", "\n")
    done, open_pairs = [], []
    for line in text.split("\n") + [""]:
        if not line.strip():
            done.append(open_pairs)
            open_pairs = []
        elif "\t" in line and line.split("\t")[0].strip():
            open_pairs.append(tuple(f.strip() for f in line.split("\t")[:2]))
    return [([w for w, _ in p], [t for _, t in p]) for p in done if p]


def in_order(df):
    return [(r.tokens, r.lid_tags) for r in df.orderBy(*LOAD_ORDER).collect()]


CASES = {
    "plain": b"a\tHI\nb\tEN\n\nc\tHI\n\n",
    "no_tab_line": b"a\tHI\nnoise\nb\tEN\n\n",
    "blank_is_white_space": "a\tHI\n \t\N{EM SPACE}\nb\tEN\n".encode(),
    "blank_runs": b"\n\na\tHI\n\n\n\nb\tEN\n\n\n",
    "no_final_newline": b"a\tHI\n\nb\tEN",
    "crlf": b"a\tHI\r\nb\tEN\r\n\r\nc\tHI\r\n",
    "cr": b"a\tHI\rb\tEN\r\rc\tHI\r",
    "invalid": b"a\xff\xfe\tHI\n",
    "empty_tag": b"a\t\nb\tEN\n",
    "empty_word": b" \tHI\nb\tEN\n",
    "third_column": b"a\tHI\tNOUN\n",
    "padding": b" a \t HI \n",
    "inner_blank": b"New York\tne\n",
    "empty": b"",
}


@pytest.mark.parametrize("name", CASES)
def test_conll_cases(spark, tmp_path, name):
    path = tmp_path / "f.txt"
    path.write_bytes(CASES[name])
    got = S.read_conll(spark, [S.SourceFile("s", "train", str(path))])
    assert in_order(got) == brute_sentences(CASES[name])
    assert all(r.text == " ".join(r.tokens) for r in got.collect())


def test_leading_bom_is_dropped(spark, tmp_path):
    (tmp_path / "f.txt").write_bytes(b"\xef\xbb\xbfa\tHI\n")
    got = S.read_conll(spark, [S.SourceFile("s", "train", str(tmp_path / "f.txt"))])
    assert in_order(got) == [(["a"], ["HI"])]


def test_lines_end_sentences_only_if_blank(spark):
    """Lines that begin with a visible ASCII character are told by it alone, others by all they hold."""
    cells = ["", " ", "\t", "!", "~", "~x", "}\t", "\x7f", "\x1f", "\N{EM SPACE}", "\N{EM SPACE}a", "\N{LATIN SMALL LETTER E WITH ACUTE}", None]
    df = spark.createDataFrame([(c,) for c in cells], "value string")
    tokens = conll._tokens(df)
    got = {r.value: r.ends for r in tokens.collect()}
    assert got == {c: None if c is None else not c.strip() for c in cells}
    assert "CASE WHEN" in tokens._jdf.queryExecution().optimizedPlan().toString()


def random_conll(seed, newline):
    rng = random.Random(seed)
    lines = []
    for i in range(400):
        kind = rng.random()
        if kind < 0.2:
            lines.append(rng.choice(["", " ", "\t"]))
        elif kind < 0.25:
            lines.append("noise")
        else:
            lines.append(f"w{i}{'x' * rng.randrange(12)}\t{rng.choice(['HI', 'EN', ''])}")
    return newline.join(lines).encode()


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [113, 700, 1 << 20])
def test_sentences_across_splits(spark, tmp_path, split_bytes, newline, size):
    data = random_conll(size, newline)
    (tmp_path / "f.txt").write_bytes(data)
    with split_bytes(size):
        got = in_order(S.read_conll(spark, [S.SourceFile("s", "train", str(tmp_path / "f.txt"))]))
    assert got == brute_sentences(data)


def test_sentence_longer_than_many_splits(spark, tmp_path, split_bytes):
    data = "".join(f"w{i}\tHI\n" for i in range(300)).encode() + b"\nlast\tEN\n"
    (tmp_path / "f.txt").write_bytes(data)
    with split_bytes(64):
        got = in_order(S.read_conll(spark, [S.SourceFile("s", "train", str(tmp_path / "f.txt"))]))
    assert got == brute_sentences(data) and len(got) == 2


def test_ids_follow_manifest_and_do_not_depend_on_splits(spark, tmp_path, split_bytes):
    for name in ("train", "validation", "test"):
        (tmp_path / f"{name}.txt").write_bytes(
            "".join(f"{name}{i}\tHI\n\n" for i in range(40)).encode()
        )
    manifest = S.split_files("s", str(tmp_path / "{split}.txt"))
    want = [f"{n}{i}" for n in ("train", "validation", "test") for i in range(40)]
    for size in (50, 1 << 20):
        with split_bytes(size):
            rows = S.unify(S.read_conll(spark, manifest)).orderBy("sentence_id").collect()
        assert [r.text for r in rows] == want
        assert [r.sentence_id for r in rows] == list(range(120))


def test_missing_files(spark, tmp_path):
    missing_csv = S.SourceFile("c", "train", str(tmp_path / "no.csv"), "array_csv")
    assert S.read_array_csv(spark, [missing_csv]).count() == 0
    with pytest.raises(FileNotFoundError):
        S.read_conll(spark, [S.SourceFile("s", "train", str(tmp_path / "no.txt"))])
    assert [r.path for r in S.missing_files(spark, [missing_csv]).collect()] == [missing_csv.path]


CSV = (
    'id,words,lid,other\r\n'
    '1,"[\'tok1\' \'tok2\'\r\n \'tok3\']","[\'lang1\' \'lang2\'\r\n \'other\']",x\r\n'
    '2,"[\'I\' ""don\'t"" \'know\']","[\'lang2\' \'lang2\' \'lang2\']","a ""quoted"", cell"\r\n'
    '3,,nan,\r\n'
    '4,[\'one\'],[\'lang1\'],y\r\n'
)


@pytest.mark.parametrize("newline", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("size", [40, 1 << 20])
def test_array_csv(spark, tmp_path, split_bytes, newline, size):
    (tmp_path / "f.csv").write_bytes(CSV.replace("\r\n", newline).encode())
    entry = S.SourceFile("c", "train", str(tmp_path / "f.csv"), "array_csv")
    with split_bytes(size):
        got = in_order(S.read_array_csv(spark, [entry]))
    assert got == [
        (["tok1", "tok2", "tok3"], ["lang1", "lang2", "other"]),
        (["I", 't" '], ["lang2", "lang2", "lang2"]),
        ([], []),
        (["one"], ["lang1"]),
    ]


def test_missing_column_is_empty(spark, tmp_path):
    (tmp_path / "f.csv").write_text("words\n['a' 'b']\n")
    entry = S.SourceFile("c", "train", str(tmp_path / "f.csv"), "array_csv")
    assert in_order(S.read_array_csv(spark, [entry])) == [(["a", "b"], [])]


@pytest.mark.parametrize("size", [30, 1 << 20])
def test_columns_are_found_by_name_in_each_file(spark, tmp_path, split_bytes, size):
    (tmp_path / "a.csv").write_text("words,lid\n['a'],['x']\n\n['b'],['y']\n")
    (tmp_path / "b.csv").write_text("id,lid,words\n1,['z'],['c']\n")
    (tmp_path / "c.csv").write_text("lid\n['only']\n")
    (tmp_path / "d.csv").write_text("words,lid\n")
    entry = S.SourceFile("c", "train", str(tmp_path), "array_csv")
    with split_bytes(size):
        got = sorted(in_order(S.read_array_csv(spark, [entry])))
    assert got == [([], ["only"]), (["a"], ["x"]), (["b"], ["y"]), (["c"], ["z"])]


@pytest.mark.parametrize("size", [30, 1 << 20])
def test_quote_in_an_unquoted_field(spark, tmp_path, split_bytes, size):
    rows = ["note,words,lid"]
    rows += [f"{i}\" screen,['a{i}' 'b'],['x' 'y']" for i in range(20)]
    rows += ['"two\nlines, ""quoted""","[\'c\'\n \'d\']",[\'x\' \'y\']'] * 3
    (tmp_path / "f.csv").write_text("\n".join(rows))
    entry = S.SourceFile("c", "train", str(tmp_path / "f.csv"), "array_csv")
    with split_bytes(size):
        got = in_order(S.read_array_csv(spark, [entry]))
    assert got == [([f"a{i}", "b"], ["x", "y"]) for i in range(20)] + [(["c", "d"], ["x", "y"])] * 3


def test_many_columns(spark, tmp_path):
    names = [f"c{i}" for i in range(80)] + ["words", "lid"]
    (tmp_path / "f.csv").write_text(",".join(names) + "\n" + "x," * 80 + "['a' 'b'],['p' 'q']\n")
    entry = S.SourceFile("c", "train", str(tmp_path / "f.csv"), "array_csv")
    assert in_order(S.read_array_csv(spark, [entry])) == [(["a", "b"], ["p", "q"])]


def test_hidden_files_count_and_samples_fall_through(spark, tmp_path):
    for task in ("hidden", "marker", "blank"):
        (tmp_path / task).mkdir()
    (tmp_path / "hidden" / "a.txt").write_text("1\n")
    (tmp_path / "hidden" / "_notes.txt").write_text("some text\n")
    (tmp_path / "marker" / "a b%.txt").write_text("1\n")
    (tmp_path / "marker" / "_SUCCESS").write_text("")
    (tmp_path / "blank" / "a.txt").write_text("\n\n\n4\n")
    (tmp_path / "blank" / "b.txt").write_text("\n8\n9\n7\n")
    verdicts, kinds, samples = S.inspect_id_only(spark, str(tmp_path), ["hidden", "marker", "blank"])
    got = {r.task: (r.status, r.n_files, r.n_id_files) for r in verdicts.collect()}
    assert got == {"hidden": ("has_text", 2, 1), "marker": ("has_text", 2, 1), "blank": ("id_only", 2, 2)}
    assert sorted((r.task, r.value) for r in samples.filter("task = 'blank'").collect()) == [("blank", "8"), ("blank", "9")]


def test_inspect_id_only(spark, tmp_path):
    ids, text, bare = tmp_path / "ids" / "deep", tmp_path / "text", tmp_path / "bare"
    for folder in (ids, text, bare):
        folder.mkdir(parents=True)
    (ids / "train.txt").write_text("\n12\n 7 \n99\n5\n")
    (ids / "later.txt").write_text("1\n2\n3\n4\n")
    (text / "a.txt").write_text("123\nhello 5\n")
    (text / "ids.txt").write_text("5\n")
    (text / "nothing.txt").write_text("")
    verdicts, kinds, samples = S.inspect_id_only(spark, str(tmp_path), ["ids", "text", "bare", "gone"])
    got = {r.task: (r.status, r.n_files, r.n_id_files, r.n_text_files) for r in verdicts.collect()}
    assert got == {
        "ids": ("id_only", 2, 2, 0),
        "text": ("has_text", 3, 1, 2),
        "bare": ("empty", 0, 0, 0),
        "gone": ("missing", 0, 0, 0),
    }
    assert {(r.task, r["name"], r.id_only) for r in kinds.collect()} == {
        ("ids", "train.txt", True),
        ("ids", "later.txt", True),
        ("text", "a.txt", False),
        ("text", "ids.txt", True),
        ("text", "nothing.txt", False),
    }
    assert sorted((r.task, r.value) for r in samples.collect()) == [
        ("ids", "1"),
        ("ids", "2"),
        ("ids", "3"),
        ("text", "5"),
    ]
    decision = S.skip_decision(verdicts, has_access=False).first()
    assert (decision.no_text, decision.decision) == (False, "inspect")
    assert S.skip_decision(verdicts.filter("task <> 'text'"), False).first().decision == "skip"
    assert S.skip_decision(verdicts, True).first().decision == "hydrate"


def records_of(text):
    """What one pass of the csv module gives: words and lid of every record after the header."""
    lines, last, rows = list(io.StringIO(text, newline="")), 0, []
    reader = csv.reader(lines)
    for row in reader:
        raw, last = lines[last : reader.line_num], reader.line_num
        if row and not (len(row) == 1 and not row[0].strip(" \t\r\n") and not any('"' in r for r in raw)):
            rows.append(row)
    at = [rows[0].index(n) if n in rows[0] else None for n in ("words", "lid")]
    return [tuple(r[i] if i is not None and i < len(r) else None for i in at) for r in rows[1:]]


def random_csv(rng, newline):
    def field():
        if rng.random() < 0.25:
            return rng.choice(["", "a", 'x"y', "b c", '12" screen', "\t"])
        body = "".join(rng.choice(["a", "b", ",", "\n", "\r\n", "\r", '""', " ", "'x' ", "\n\n"]) for _ in range(rng.randrange(7)))
        return f'"{body}"' + rng.choice(["", "", "", "z", 'q"'])

    names = rng.sample(["id", "words", "lid", "o1", "o2"], 5)
    rows = [",".join('"wor\nds"' if n == "id" and rng.random() < 0.3 else n for n in names)]
    for _ in range(rng.randrange(1, 25)):
        if rng.random() < 0.1:
            rows.append(rng.choice(["", " ", " \t"]))
        else:
            rows.append(",".join(field() for _ in range(rng.choice([5, 5, 5, 3, 1]))))
    return newline * rng.randrange(2) + newline.join(rows) + newline * rng.randrange(2)


class Caught:
    """Stands for lines, and keeps the function that would be run on their batches."""

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):
        self.run = function
        return self


def read_in_pieces(text, cuts, rows):
    """The two passes over splits that begin at the given lines, in batches of so many rows, and the pieces joined."""
    lines = text.split("\n")
    lines = lines[:-1] if lines[-1] == "" else lines
    splits, at = {}, 0
    for i, line in enumerate(lines):
        if not splits or i in cuts:
            splits[at] = []
        splits[max(splits)].append(line)
        at += len(line.encode()) + 1

    def batches(known=None):
        for block, values in splits.items():
            for i in range(0, len(values), rows):
                part = values[i : i + rows]
                columns = {"file": ["f"] * len(part), "block": [block] * len(part), "value": part}
                types = [pa.string(), pa.int64(), pa.string()]
                if known:
                    columns |= {n: [v] * len(part) for n, v in known[block].items()}
                    types += [pa.bool_(), pa.bool_(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns.values(), types)], names=list(columns))

    caught = array_csv._split_maps(Caught())
    quoted, started, head, known = False, False, "", {}
    for m in (m for b in caught.run(batches()) for m in b.to_pylist()):
        known[m["block"]] = {"quoted": quoted, "started": started}
        way = "quoted" if quoted else "plain"
        head += "" if started else m[f"head_{way}"]
        quoted, started = m[f"after_{way}"], started or m[f"ended_{way}"]
    header = array_csv.first_record(head)
    places = [header.index(n) if n in header else None for n in ("words", "lid")]
    for state in known.values():
        state |= {"words_at": places[0], "tags_at": places[1]}
    found, open_at, pieces = {}, None, {}
    for r in (r for b in array_csv._records(Caught()).run(batches(known)) for r in b.to_pylist()):
        place = r["block"], r["pos"]
        if r["text"] is None:
            found[place] = r["words"], r["lid"]
        elif r["begins"]:
            open_at, pieces[place] = place, r["text"]
        else:
            pieces[open_at] += r["text"]
    for place, whole in pieces.items():
        found[place] = tuple(array_csv._cell(array_csv.first_record(whole), p) for p in places)
    return [found[place] for place in sorted(found)]


def test_csv_cut_anywhere_equals_one_pass():
    rng = random.Random(11)
    for _ in range(150):
        text = random_csv(rng, rng.choice(["\n", "\r\n", "\n", "\r"]))
        want, n = records_of(text), text.count("\n") + 1
        for cuts in (set(range(n)), set(), {i for i in range(n) if rng.random() < 0.3}):
            for rows in (1, 2, 1000):
                assert read_in_pieces(text, cuts, rows) == want, (text, cuts, rows)


@pytest.mark.parametrize("size", [16, 64])
def test_csv_file_cut_small(spark, tmp_path, split_bytes, size):
    text = (
        '\n"id\n, x",words,lid\n1,"[\'a\'\n \'b\']",[\'x\' \'y\']\n \n2" wide,"[\'say ""\n"" so\']","[\'z\']"\r\n'
        '3,"\n\n[\'c\',\r\n\'d\']"tail,[\'p\' \'q\']\n4\n5,"[\'e\']","[\'r\']"'
    )
    (tmp_path / "f.csv").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        with split_bytes(size):
            found = S.locate(spark, [S.SourceFile("c", None, str(tmp_path / "f.csv"), "array_csv")], "array_csv")
            cells = array_csv.csv_cells(spark, found)[0].orderBy("block", "pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.words, r.lid) for r in cells] == records_of(text)
    assert len({r.block for r in cells}) > 1


def test_states_without_broadcast(spark, tmp_path, split_bytes, monkeypatch):
    (tmp_path / "f.csv").write_bytes(CSV.encode())
    entry = S.SourceFile("c", "train", str(tmp_path / "f.csv"), "array_csv")
    with split_bytes(20):
        want = in_order(S.read_array_csv(spark, [entry]))
        monkeypatch.setattr(array_csv, "MOST_BROADCAST", 0)
        assert in_order(S.read_array_csv(spark, [entry])) == want and len(want) == 4


def test_header_beyond_reach_is_refused(spark, tmp_path, split_bytes, monkeypatch):
    (tmp_path / "f.csv").write_text('"a\nb\nc\nd",words\n1,x\n')
    monkeypatch.setattr(array_csv, "HEADER_REACH", 3)
    entry = S.SourceFile("c", "train", str(tmp_path / "f.csv"), "array_csv")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        with split_bytes(2), pytest.raises(Exception, match="header of"):
            S.read_array_csv(spark, [entry])
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_manifest_of_files_folders_and_patterns(spark, tmp_path):
    """Files named twice are read once and count for both entries; a folder's files are its own and those in partition folders."""
    for name in ("a b%.txt", "d/x.txt", "d/k=1/y.txt", "d/deeper/z.txt", "[1].txt"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"{path.stem.replace(' ', '_')}\tHI\n")
    manifest = [
        S.SourceFile("pattern", "train", str(tmp_path / "a*.txt")),
        S.SourceFile("file", "test", str(tmp_path / "a b%.txt")),
        S.SourceFile("folder", None, str(tmp_path / "d")),
        S.SourceFile("inner", None, str(tmp_path / "d" / "x.txt")),
        S.SourceFile("gone", None, str(tmp_path / "gone.txt"), required=False),
        S.SourceFile("odd", None, str(tmp_path / "\\[1\\].txt")),
    ]
    loaded = S.read_conll(spark, manifest)
    got = sorted((r.source, r.text) for r in loaded.collect())
    assert got == [("file", "a_b%"), ("folder", "x"), ("folder", "y"), ("inner", "x"), ("odd", "[1]"), ("pattern", "a_b%")]
    report = {r.source: (r.n, r.status) for r in S.load_report(spark, manifest, loaded).collect()}
    assert report["gone"] == (0, "missing") and report["folder"] == (2, "loaded")


def test_files_are_judged_once_not_line_by_line(spark, tmp_path, monkeypatch):
    """Lines are tested against the names of files that no entry lists, if any; with too many of those, each is judged."""
    for name in ("d/x.txt", "d/k=1/y.txt", "e/z.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(f"{name[-5]}\tHI\n")
    entries = [S.SourceFile(name, None, str(tmp_path / name)) for name in ("d", "e")]

    def read():
        return sorted(r.value for r in lines.read_lines(spark, S.locate(spark, entries, "conll")).collect())

    plain = lines.read_lines(spark, S.locate(spark, entries, "conll"))
    assert "+- Filter" not in plan_of(plain) and "lambda" not in plan_of(plain) and read() == ["x\tHI", "y\tHI", "z\tHI"]
    for name in ("d/deeper", "d/deeper/more"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "w.txt").write_text("w\tHI\n")
    some = lines.read_lines(spark, S.locate(spark, entries, "conll"))
    assert "lambda" not in plan_of(some) and read() == ["x\tHI", "y\tHI", "z\tHI"]
    monkeypatch.setattr(manifest, "MOST_NAMED", 1)
    assert read() == ["x\tHI", "y\tHI", "z\tHI"]


def test_ten_thousand_entries(spark, tmp_path):
    for i in range(0, 10_000, 40):
        (tmp_path / f"{i}.csv").write_text(f"words,lid\n['w{i}'],['x']\n")
    manifest = [S.SourceFile(f"s{i}", None, str(tmp_path / f"{i}.csv"), "array_csv") for i in range(10_000)]
    got = S.read_array_csv(spark, manifest).select("rank", "source", "text").collect()
    assert len(got) == 250 and all(r.source == f"s{r.rank}" and r.text == f"w{r.rank}" for r in got)


def test_folders_are_listed_by_tasks(spark, tmp_path):
    """Hidden files are opened as others are, checksum files aren't seen, and names are written as readers write them."""
    for path, text in {
        "t/_SUCCESS": "",
        "t/a b%é.txt": "7\n",
        "t/_h/x/1.txt": "5\r\n6\r",
        "t/.h.txt": "8",
        "t/.h.txt.crc": "crc",
        "t/k=1/2.txt": "text",
        "u/_only/ids": "1\n2\n",
    }.items():
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_bytes(text.encode())
    (tmp_path / "v" / "w").mkdir(parents=True)
    verdicts, kinds, samples = S.inspect_id_only(spark, str(tmp_path), ["t", "u", "v", "z"])
    got = {(r.task, r["name"]): (r.id_only, r.length) for r in kinds.collect()}
    assert got == {
        ("t", "_SUCCESS"): (False, 0),
        ("t", "a b%é.txt"): (True, 2),
        ("t", "1.txt"): (True, 5),
        ("t", ".h.txt"): (True, 1),
        ("t", "2.txt"): (False, 4),
        ("u", "ids"): (True, 4),
    }
    assert {r.task: r.status for r in verdicts.collect()} == {"t": "has_text", "u": "id_only", "v": "empty", "z": "missing"}
    assert sorted(r.value for r in samples.filter("task = 'u'").collect()) == ["1", "2"]
