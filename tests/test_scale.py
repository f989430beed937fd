"""What reading and numbering leave on disk, and what they move."""

import pathlib
import time

import pyarrow as pa
import pytest
import sangam as S
from conftest import SF_DIR, plan_of
from pyspark.sql import Window, functions as F
from sangam.operators.ids import dense_ids, gapless, in_load_order, is_gapless
from sangam.plans import catalogue
from sangam.session import job_folder, staged
from sangam.sources import array_csv, conll
from test_readers import random_conll


def shuffle_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle")}


def test_staged_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count()
    table = staged(rows, "counts")
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert table.count() == 10 and rows.count() == 10 and staged(rows, "again").count() == 10


@pytest.mark.parametrize("name", ["conll_files", "array_csv_files", "array_csv_split_files", "manifest_loads"])
def test_files_go_when_they_are_read(spark, name):
    folder = pathlib.Path(job_folder(spark))
    before = set(folder.glob("*/**/part=*"))
    got = catalogue.QUERIES[name](spark, SF_DIR)
    assert not set(folder.glob("*/**/part=*")) - before
    assert got.count() > 0
    if name != "manifest_loads":
        assert "row_number" not in plan_of(got)


def test_readers_number_rows_without_gaps(spark, tmp_path, split_bytes):
    (tmp_path / "f.txt").write_bytes(random_conll(5, "\n"))
    (tmp_path / "f.csv").write_text("words,lid\n" + "".join(f"\"['a{i}'\n 'b']\",['x' 'y']\n\n" for i in range(60)))
    for size in (700,):
        with split_bytes(size):
            for rows in (
                S.read_conll(spark, [S.SourceFile("s", "train", str(tmp_path / "f.txt"))]),
                S.read_array_csv(spark, [S.SourceFile("s", "train", str(tmp_path / "f.csv"), "array_csv")]),
            ):
                assert is_gapless(rows)
                blocks = rows.groupBy("file", "block").agg(F.min("pos").alias("a"), F.max("pos").alias("b"), F.count(F.lit(1)).alias("n"), F.countDistinct("pos").alias("d"))
                assert not blocks.filter("b - a + 1 <> n or n <> d").collect()
                ids = {tuple(r[:2]): r.sentence_id for r in dense_ids(rows, ["file", "block"], ["pos"]).select("block", "pos", "sentence_id").collect()}
                assert [ids[k] for k in sorted(ids)] == list(range(len(ids)))


@pytest.mark.parametrize("pos", [[3, 4, 5], [0, 0, 2], [1, 1, 3, 3], [0, 7, 9], [2, 2, 2]])
def test_ids_of_marked_rows_are_those_of_a_window(spark, pos):
    """A wrong mark costs time and changes no id."""
    rows = spark.createDataFrame([(b, p) for b in (0, 4) for p in (pos if b else [5, 6])], "block long, pos long")
    order = Window.orderBy("block", "pos")
    want = sorted((r.block, r.pos, r.n - 1) for r in rows.withColumn("n", F.row_number().over(order)).collect())
    for some in (rows, gapless(rows)):
        got = dense_ids(some, ["block"], ["pos"])
        assert sorted((r.block, r.pos, r.sentence_id) for r in got.collect()) == want
    assert ("row_number" in plan_of(dense_ids(gapless(rows), ["block"], ["pos"]))) == (pos != [3, 4, 5])


def test_union_is_gapless_if_all_are(spark):
    rows = S.empty_source(spark)
    assert is_gapless(in_load_order(gapless(rows), gapless(rows)))
    assert not is_gapless(in_load_order(gapless(rows), rows)) and not is_gapless(in_load_order(rows, gapless(rows)))


def test_lines_as_arrays_are_read_as_columns_are(spark):
    cells = ["", " ", "\t", "a\t", "a\tHI", " a \t HI \tx", "\tHI", "\N{EM SPACE}\tHI", "\N{EM SPACE}", "\x1f", "noise", "~\t\t", "e\N{COMBINING ACUTE ACCENT}\N{NO-BREAK SPACE}\tEN\t"]
    want = conll._tokens(spark.createDataFrame([(c,) for c in cells], "value string")).collect()
    ends, keep, (words, tags) = conll._read(pa.array(cells))
    assert ends.tolist() == [r.ends for r in want] and keep.tolist() == [r.keep for r in want]
    assert list(zip(words.to_pylist(), tags.to_pylist())) == [(r.word, r.tag) for r in want if r.keep]
    assert [x.tolist() for x in conll._read(pa.array([], pa.string()))[:2]] == [[], []]


def test_states_held_by_workers_give_the_same_records(spark, tmp_path, split_bytes, monkeypatch):
    (tmp_path / "f.csv").write_text("lid,words\n" + "".join(f"['x' \"{i}\"],\"['a{i}'\n \"\"q\"\" 'b']\"\n" for i in range(60)))
    manifest = [S.SourceFile("s", "train", str(tmp_path / "f.csv"), "array_csv")]

    def read():
        with split_bytes(97):
            return sorted((r.block, r.pos, r.text, *r.lid_tags) for r in S.read_array_csv(spark, manifest).collect())

    held = read()
    assert len(held) == 60
    monkeypatch.setattr(array_csv, "MOST_HELD", 3)
    assert read() == held
    monkeypatch.setattr(array_csv, "MOST_BROADCAST", 3)
    assert read() == held
