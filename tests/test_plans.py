"""What the physical plans must and must not contain."""

import pathlib
import re

from pyspark.sql import functions as F

import sangam as S
from sangam import session
from conftest import SF_DIR, plan_of
from sangam.operators import cleaning, ids
from sangam.plans import catalogue, corpus as C
from sangam.schema import LOAD_ORDER
from sangam.sources.array_csv import _records
from sangam.sources.lines import read_lines


def test_no_python_and_no_cross_joins(spark):
    for name, query in catalogue.QUERIES.items():
        plan = plan_of(query(spark, SF_DIR))
        for word in ("PythonUDF", "ArrowEval", "BatchEvalPython", "CartesianProduct", "NestedLoopJoin"):
            assert word not in plan, (name, word)


def test_dedup_filters_and_limits_ahead_of_the_shuffle(spark):
    plan = plan_of(cleaning.clean_rows(C.loaded_lines(spark, SF_DIR), LOAD_ORDER))
    exchange = plan.index("Exchange hashpartitioning(text")
    above, below = plan[:exchange], plan[exchange:]
    assert "WindowGroupLimit" in above and "Partial" in below and "WindowGroupLimit" in below
    assert "Filter" in below and "(length(text" in below
    # one cleaning per row
    assert below.count("@[") == 1 and "@[" not in above


def test_one_large_shuffle_for_sentences(spark):
    plan = plan_of(S.lines_to_sentences(C.token_lines(spark, SF_DIR), stage=False))
    whole = plan[: plan.index("FileScan")]  # the branch of runs inside one block
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*file#\d+, block", whole)) == 1
    assert "lag(" not in whole


def test_lines_of_files_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a\tHI\n\nb\tEN\n")
    lines = read_lines(spark, S.locate(spark, [S.SourceFile("s", "train", str(tmp_path / "a.txt"))], "conll"))
    ready = lines.selectExpr("0L AS rank", "'s' AS source", "'train' AS split", "*")
    whole = plan_of(S.lines_to_sentences(ready, stage=False, in_order=True))
    runs = whole[whole.index("MapInArrow") :]
    assert "Exchange" not in whole[: whole.index("MapInArrow")] and "Exchange" not in runs[: runs.index("FileScan")]
    assert "Exchange" not in plan_of(_records(lines.selectExpr("*", "false AS quoted", "true AS started", "0 AS words_at", "1 AS tags_at")))


def test_plan_does_not_grow_with_the_manifest(spark, tmp_path):
    (tmp_path / "f").mkdir()
    for i in range(40):
        (tmp_path / "f" / f"{i}.txt").write_text(f"w{i}\tHI\n")
        (tmp_path / "f" / f"{i}.csv").write_text(f"words,lid\n['w{i}'],['x']\n")
    size = {}
    for n in (2, 40):
        manifest = [S.SourceFile(f"s{i}", None, str(tmp_path / "f" / f"{i}.txt")) for i in range(n)]
        csvs = [S.SourceFile(f"s{i}", None, str(tmp_path / "f" / f"{i}.csv"), "array_csv") for i in range(n)]
        read = S.read_conll(spark, manifest), S.read_array_csv(spark, csvs)
        assert all(r.source == r.text.replace("w", "s") for df in read for r in df.collect())
        size[n] = [len(df._jdf.queryExecution().logical().toString().splitlines()) for df in read]
    assert size[2] == size[40]


def test_shared_shuffle_is_reused(spark):
    df = S.lines_to_sentences(C.token_lines(spark, SF_DIR), stage=False)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_split_assignment_leaves_the_rows_where_they_are(spark):
    rows = spark.range(0, 1000, 1, 4).select(
        F.col("id").alias("sentence_id"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
        F.lit("roman_only").alias("script_type"),
        F.lit(None).cast("string").alias("split"),
    )
    plan = plan_of(S.assign_splits(rows))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_scan_reads_only_what_is_used(spark):
    plan = plan_of(catalogue.QUERIES["counts_by_source"](spark, SF_DIR))
    assert "quality" not in plan and "n_chars" not in plan.split("ReadSchema")[1]


def test_numbering_shuffles_rows_once(spark):
    plan = plan_of(S.renumber(spark.range(1000).withColumnRenamed("id", "sentence_id")))
    exchanges = re.findall(r"Exchange hashpartitioning\(_bucket", plan)
    assert len(exchanges) <= 3
    assert "Exchange SinglePartition" not in plan


def test_numbering_has_no_window_over_everything(spark):
    rows = spark.range(3000).selectExpr("id % 700 AS bucket", "id AS pos")
    got = ids.dense_ids(rows, ["bucket"], ["pos"])
    plan = plan_of(got)
    assert "Exchange SinglePartition" not in plan
    want = sorted((i % 700, i) for i in range(3000))
    assert [(r.bucket, r.pos) for r in got.orderBy("sentence_id").collect()] == want


def test_ids_of_a_numbered_table_are_not_shuffled(spark):
    numbered = spark.range(0, 200_000, 1, 8).selectExpr("id AS sentence_id", "'x' AS text")
    for checked in (S.ids_unique(numbered), S.id_null_checks(numbered)):
        exchanges = [line for line in plan_of(checked).splitlines() if "Exchange hashpartitioning" in line]
        assert exchanges and not any("sentence_id#" in line or "(id#" in line for line in exchanges) and checked.first().ids_unique
    scattered = numbered.selectExpr("xxhash64(sentence_id) AS sentence_id", "text")
    assert S.ids_unique(scattered).first().ids_unique and S.id_null_checks(scattered).first().n_ids == 200_000
    for twice in (numbered, scattered):
        assert not S.ids_unique(twice.union(twice)).first().ids_unique
        assert not S.ids_unique(twice.union(twice.limit(1))).first().ids_unique
        assert S.id_null_checks(twice.union(twice)).first().n_ids == 200_000
    nulls = numbered.union(spark.sql("SELECT cast(null AS bigint), cast(null AS string)"))
    assert tuple(S.id_null_checks(nulls).first()) == (200_001, 200_000, 1, False) and not S.ids_unique(nulls).first().ids_unique


def test_partitioned_write_makes_few_files(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id AS x", "concat('s', id % 3) AS source", "concat('p', id % 2) AS split")
    S.write_parquet(rows.repartition(32), str(tmp_path / "t"), ("source", "split"))
    assert len(list((tmp_path / "t").rglob("part-*.parquet"))) <= 12
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20_000


def test_build_leaves_no_staged_table(spark, tmp_path):
    (tmp_path / "train.txt").write_text("a\tHI\nb\tEN\nc\tHI\n\nd\tHI\ne\tEN\nf\tHI\n\n")
    before = set(pathlib.Path(session.job_folder(spark)).iterdir())
    done = S.build_dataset(spark, [S.SourceFile("s", None, str(tmp_path / "train.txt"))], str(tmp_path / "out"))
    assert done.count() == 2
    assert set(pathlib.Path(session.job_folder(spark)).iterdir()) == before
