import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import sangam as S
from conftest import plan_of
from sangam.operators import cleaning, reports
from sangam.schema import FINAL, SENTENCE

SENT = "sentence_id bigint, source string, split string, text string, tokens array<string>, lid_tags array<string>"


def sentences(spark, rows):
    """rows: (source, split, text)"""
    data = [(i, s, p, t, t.split(), ["x"] * len(t.split())) for i, (s, p, t) in enumerate(rows)]
    return spark.createDataFrame(data, SENT)


def test_renumber_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "sentence_id").filter("sentence_id % 7 <> 3")
    df = df.withColumn("old", F.col("sentence_id")).repartition(5)
    rows = S.renumber(df, bucket_rows=64).orderBy("sentence_id").collect()
    assert [r.sentence_id for r in rows] == list(range(len(rows)))
    assert [r.old for r in rows] == [i for i in range(5000) if i % 7 != 3]


def test_cleaning_keeps_first_across_sources_and_filters_after(spark):
    df = sentences(
        spark,
        [
            ("a", "train", "one two three"),
            ("b", "test", "one  two three @user"),
            ("b", "test", "too short"),
            ("b", "test", "One two three"),
            ("a", "train", " ".join(["w"] * 100)),
            ("a", "train", " ".join(["w"] * 101)),
            ("a", "train", "https://x.y/z"),
        ],
    )
    for stage in (True, False):
        rows = S.apply_cleaning(df, stage=stage).orderBy("sentence_id").collect()
        assert [(r.sentence_id, r.source, len(r.tokens)) for r in rows] == [
            (0, "a", 3),
            (1, "b", 3),
            (2, "a", 100),
        ]
    report = S.cleaning_report(df).first()
    assert (report.rows_before, report.dropped_duplicates, report.dropped_length, report.rows_after) == (7, 1, 3, 3)
    dropped = {r.source: r.dropped for r in S.dropped_by_source(df, S.apply_cleaning(df)).collect()}
    assert dropped == {"a": 2, "b": 2}


def test_tags_stay_as_read(spark):
    df = sentences(spark, [("a", "train", "@u one two three")])
    row = S.apply_cleaning(df).first()
    assert row.tokens == ["one", "two", "three"] and len(row.lid_tags) == 4


def test_source_that_lost_all_rows_still_shows(spark):
    df = sentences(spark, [("a", "train", "one two three"), ("b", "train", "x")])
    got = {r.source: (r.raw_count, r.clean_count) for r in S.dropped_by_source(df, S.apply_cleaning(df)).collect()}
    assert got == {"a": (1, 1), "b": (1, 0)}


def test_cleaning_twice_changes_nothing(spark):
    df = sentences(spark, [("a", "train", f"word{i % 30} https://a.b/c @me  and more") for i in range(60)])
    once = S.apply_cleaning(df)
    assert sorted(map(tuple, S.apply_cleaning(once).select("sentence_id", "text").collect())) == sorted(
        map(tuple, once.select("sentence_id", "text").collect())
    )


def test_hot_text_is_reduced_ahead_of_the_shuffle(spark):
    df = spark.range(0, 30_000, 1, 8).select(
        F.col("id").alias("sentence_id"),
        F.when(F.col("id") % 3 > 0, "the same hot text").otherwise(F.concat_ws(" ", F.lit("a b"), "id")).alias("text"),
    )
    got = S.dedup_first(df)
    assert got.count() == 10_001
    assert got.filter("text = 'the same hot text'").first().sentence_id == 1


def expected_split(rows, seed=42):
    """Brute force: rank each stratum by digest and cut it."""
    strata = defaultdict(list)
    for sid, source, script, split in rows:
        if not split:
            strata[f"{source}__{script}"].append(
                (hashlib.md5(f"{seed}|{sid}".encode()).hexdigest(), sid)
            )
    usable = sum(len(s) for s in strata.values() if len(s) >= 3)
    out = {sid: split for sid, _, _, split in rows if split}
    for keys in strata.values():
        n = len(keys)
        n_train = n if n < 3 or usable < 10 else (8 * n + 5) // 10
        n_validation = (n - n_train + 1) // 2
        for r, (_, sid) in enumerate(sorted(keys), 1):
            out[sid] = "train" if r <= n_train else "validation" if r <= n_train + n_validation else "test"
    return out


SPLIT_ROWS = "sentence_id bigint, source string, script_type string, split string"
SIZES = {
    "mixed": [1, 2, 3, 4, 5, 6, 7, 8, 10, 25, 100, 3000],
    "too_few": [1, 2, 3, 6],
    "only_rare": [1, 2, 2],
    "one": [1000],
}


@pytest.mark.parametrize("name", SIZES)
@pytest.mark.parametrize("broadcast", ["10m", "-1"], ids=["broadcast", "shuffle"])
def test_splits(spark, name, broadcast):
    rows, sid = [], 0
    for g, n in enumerate(SIZES[name]):
        for i in range(n):
            rows.append((sid, f"s{g}", "roman_only", None if i % 2 else ""))
            sid += 1
    for i in range(20):
        rows.append((sid, "kept", "unknown", ["train", "validation", "test"][i % 3]))
        sid += 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    got = S.assign_splits(spark.createDataFrame(rows, SPLIT_ROWS))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.sentence_id: r.split for r in got.collect()} == expected_split(rows)
    assert got.columns == ["sentence_id", "source", "script_type", "split"]


@pytest.mark.parametrize(
    "n, want", [(10, (8, 1, 1)), (25, (20, 3, 2)), (100, (80, 10, 10)), (8 + 4, (10, 1, 1))]
)
def test_split_sizes(spark, n, want):
    df = spark.createDataFrame([(i, "s", "roman_only", None) for i in range(n)], SPLIT_ROWS)
    sizes = Counter(r.split for r in S.assign_splits(df).collect())
    assert (sizes["train"], sizes["validation"], sizes["test"]) == want


def test_split_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i, "s", "roman_only", None) for i in range(500)], SPLIT_ROWS)
    a = {tuple(r) for r in S.assign_splits(df.coalesce(1)).collect()}
    b = {tuple(r) for r in S.assign_splits(df.repartition(7)).collect()}
    assert a == b
    assert a != {tuple(r) for r in S.assign_splits(df, seed=7).collect()}


def test_exact_totals(spark):
    """Sizes over all strata are exact, each stratum's are within one row, rare strata go to train."""
    sizes = [1, 2, 3, 4, 6, 7, 11, 13, 13, 13, 19, 101, 2, 27]
    rows = []
    for g, n in enumerate(sizes):
        rows += [(len(rows) + i, f"s{g:02}", "roman_only", None) for i in range(n)]
    got = S.assign_splits(spark.createDataFrame(rows, SPLIT_ROWS), exact_totals=True).collect()
    big = {f"s{g:02}": n for g, n in enumerate(sizes) if n >= 3}
    whole = sum(big.values())
    counts = Counter((r.source, r.split) for r in got)
    totals = Counter(r.split for r in got if r.source in big)
    train = (8 * whole + 5) // 10
    assert totals == {"train": train, "validation": (whole - train + 1) // 2, "test": (whole - train) // 2}
    for source, n in big.items():
        assert abs(counts[source, "train"] - 0.8 * n) < 1
        held = n - counts[source, "train"]
        assert abs(counts[source, "validation"] - held / 2) < 1
    assert all(r.split == "train" for r in got if r.source not in big)
    off = {r.split: r.off for r in S.split_totals(spark.createDataFrame([r for r in got if r.source in big])).collect()}
    assert max(map(abs, off.values())) <= 1


def test_few_rows_go_to_train_with_exact_totals_too(spark):
    df = spark.createDataFrame([(i, f"s{i % 2}", "roman_only", None) for i in range(9)], SPLIT_ROWS)
    assert {r.split for r in S.assign_splits(df, exact_totals=True).collect()} == {"train"}


def test_aligned_tags(spark):
    cases = [
        (["@u", "one", "two", "three"], ["O", "a", "b", "c"], ["one/a", "two/b", "three/c"]),
        (["New York", "https://x.y", "is", "big"], ["ne", "u", "a", "b"], ["New/ne", "York/ne", "is/a", "big/b"]),
        (["a@b.com", "x", "y"], ["m", "n", "o"], ["a.com/m", "x/n", "y/o"]),
        (["one", "two", "three"], ["a"], ["one/a", "two/None", "three/None"]),
        (["one", "two", "@x", "three"], ["a", "b", "c", "d", "e"], ["one/a", "two/b", "three/d"]),
        (["one", "two", "three"], ["a", "b", "c", "d"], ["one/a", "two/b", "three/c"]),
        (["@x", "@y"], ["a", "b"], []),
        ([], [], []),
    ]
    data = [(i, "s", "train", " ".join(t), t, g) for i, (t, g, _) in enumerate(cases)]
    df = spark.createDataFrame(data, SENT)
    got = cleaning.retokenised(cleaning.cleaned(df, align_tags=True)).orderBy("sentence_id").collect()
    assert [[f"{t}/{g}" for t, g in zip(r.tokens, r.lid_tags, strict=True)] for r in got] == [w for _, _, w in cases]
    assert S.tag_alignment(cleaning.retokenised(cleaning.cleaned(df))).first().n_misaligned == 5
    assert S.tag_alignment(cleaning.retokenised(cleaning.cleaned(df, True))).first().n_misaligned == 0
    both = cleaning.retokenised(cleaning.cleaned(df, True, as_read="read_tags"))
    found = S.tag_alignments(both, {"as_read": "read_tags", "aligned": "lid_tags"})
    assert sorted(map(tuple, found.collect())) == [("aligned", "s", 8, 0), ("as_read", "s", 8, 5)]
    kept = S.apply_cleaning(df, align_tags=True).orderBy("sentence_id").collect()
    assert [len(r.tokens) == len(r.lid_tags) for r in kept] == [True] * 3 and kept[0].lid_tags == ["a", "b", "c"]


def test_sketched_medians_are_as_near_as_stated(spark):
    rows = spark.range(60_000).selectExpr(
        "concat('s', id % 3) AS source", "cast(pow(id % 5000, 1.3) % 977 AS int) AS length", "id % 2 AS split"
    )
    df = rows.withColumn("tokens", F.array_repeat(F.lit("w"), F.col("length")))
    sketches = S.length_sketches(df, "source", "split")
    assert sketches.count() == 6
    for by in ([], ["source"], ["source", "split"]):
        for r in S.sketched_medians(sketches, *by).collect():
            lengths = sorted(x.length for x in rows.filter(" and ".join([f"{c} = '{r[c]}'" for c in by]) or "true").collect())
            below, upto = sum(x < r.median_length for x in lengths), sum(x <= r.median_length for x in lengths)
            slack = reports.SKETCH_ERROR * len(lengths)
            assert r.n == len(lengths) and below <= len(lengths) / 2 + slack and upto >= len(lengths) / 2 - slack


def test_no_open_rows(spark):
    df = spark.createDataFrame([(i, "s", "roman_only", "test") for i in range(5)], SPLIT_ROWS)
    assert {r.split for r in S.assign_splits(df).collect()} == {"test"}


def test_summary_rounds_half_to_even_and_keeps_unsplit_in_total(spark):
    rows = [("a", "train", "w " * 6)] * 3 + [("a", "train", "w " * 7)] + [("a", None, "w " * 9), ("b", "test", "w")]
    got = [tuple(r) for r in S.summary(sentences(spark, rows)).collect()]
    assert got == [
        ("a", "TOTAL", 5, 6.8),
        ("a", "train", 4, 6.2),
        ("b", "TOTAL", 1, 1.0),
        ("b", "test", 1, 1.0),
    ]


def test_reports(spark):
    df = S.with_script(sentences(spark, [("a", "train", "x y z"), ("a", "test", "<3"), ("b", "train", "p q")]))
    assert [tuple(r) for r in S.ordered_counts(df, "source").collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in S.script_pivot(df).orderBy("source").collect()] == [
        ("a", 1, 0, 0, 1),
        ("b", 1, 0, 0, 0),
    ]
    shares = {(r.source, r.split): (r.n, r.pct) for r in S.source_by_split(df).collect()}
    assert shares[("a", "validation")] == (0, 0.0) and shares[("b", "train")] == (1, 100.0)
    stats = S.length_stats(df).first()
    assert (stats.min_length, stats.max_length, stats.mean_length, stats.median_length) == (1, 3, 2.0, 2.0)
    rolled = {(r.source, r.split): r.n for r in S.load_counts(df).collect()}
    assert rolled[(None, None)] == 3 and rolled[("a", None)] == 2 and rolled[("a", "test")] == 1
    assert S.id_null_checks(df).first().ids_unique
    assert not S.id_null_checks(df.union(df)).first().ids_unique
    assert S.tag_vocab(df).collect()[0].tag == "x"
    assert [r.sentence_id for r in S.first_per_group(df, "source", 1).orderBy("source").collect()] == [0, 2]


def test_gates(spark):
    df = S.with_script(sentences(spark, [("a", "train", "x y z")] * 8 + [("a", "test", "x"), ("b", "validation", "y")]))
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "source string")

    def status(frame):
        return {r.check: r.status for r in frame.collect()}

    assert status(S.train_size(df)) == {"train_rows": "warning"}
    assert status(S.train_size(df, 8)) == {"train_rows": "passed"}
    assert status(S.sources_loaded(expected, df)) == {"sources_loaded": "partial"}
    assert status(S.sources_loaded(expected.filter("source = 'c'"), df)) == {"sources_loaded": "failed"}
    assert status(S.sources_loaded(expected.filter("source <> 'c'"), df)) == {"sources_loaded": "passed"}
    assert status(S.unified_table(expected, df)) == {
        "empty_sources": "failed",
        "repeated_ids": "passed",
        "null_texts": "passed",
    }
    assert set(status(S.split_balance(df)).values()) == {"passed"}
    assert status(S.split_balance(df.filter("split = 'train'")))["train_max_pct"] == "failed"
    assert status(S.script_types_present(df)) == {"missing_script_types": "passed"}
    assert status(S.script_types_present(df, ["mixed_script"])) == {"missing_script_types": "failed"}
    report = spark.createDataFrame([(50.0,), (50.1,), (90.0,), (90.1,)], "pct_dropped double")
    assert [r.status for r in S.share_dropped(report).collect()] == ["passed", "warning", "warning", "failed"]
    assert S.verdict(S.share_dropped(report)).first().status == "failed"


def corpus_files(folder):
    for n, split in enumerate(("train", "validation", "test")):
        body = "".join(
            f"@me\tO\nw{n}\tHI\nis\tEN\nnumber{i % 15}\tEN\n\n" for i in range(20)
        )
        (folder / f"{split}.txt").write_text(body)
        (folder / f"lid_{split}.csv").write_text(
            "words,lid\n" + "".join(f"\"['row{i}' 'of'\n 'csv{n}']\",\"['lang1' 'lang1'\n 'ne']\"\n" for i in range(10))
        )
    return S.split_files("tok", str(folder / "{split}.txt")) + S.split_files(
        "csv", str(folder / "lid_{split}.csv"), "array_csv"
    )


def test_build_dataset(spark, tmp_path):
    manifest = corpus_files(tmp_path)
    out = str(tmp_path / "out")
    built = S.build_dataset(spark, manifest, out)
    rows = built.orderBy("sentence_id").collect()
    assert built.columns == FINAL.fieldNames()
    assert [r.sentence_id for r in rows] == list(range(75))
    assert [r.source for r in rows] == ["tok"] * 45 + ["csv"] * 30
    assert rows[0].text == "w0 is number0" and rows[0].lid_tags == ["O", "HI", "EN", "EN"]
    assert sorted(map(str, S.read_csv(spark, f"{out}/dataset.csv").collect())) == sorted(map(str, rows))
    assert {r.status for r in S.outputs_check(spark, out).collect()} == {"ok"}
    summary = spark.read.option("header", True).csv(f"{out}/summary.csv").collect()
    assert [tuple(r) for r in summary][:2] == [("csv", "TOTAL", "30", "3.0"), ("csv", "test", "10", "3.0")]
    # the general route over numbered rows gives the same table
    raw = S.unify(S.read_conll(spark, manifest), S.read_array_csv(spark, manifest))
    again = S.with_script(S.apply_cleaning(raw))
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))
    assert [f.name for f in raw.schema] == SENTENCE.fieldNames()


def test_missing_output_is_reported(spark, tmp_path):
    df = S.with_script(sentences(spark, [("a", "train", "x y z")]))
    S.write_csv(df, str(tmp_path / "o" / "dataset.csv"))
    got = {r.name: r.status for r in S.outputs_check(spark, str(tmp_path / "o")).collect()}
    assert got["dataset.csv"] == "ok" and got["dataset.parquet"] == "missing_or_empty"


def test_awkward_text_survives_csv(spark, tmp_path):
    texts = ['say "hi", you', "back\\slash \\\" here", "comma, and 'single'", "tab\there x"]
    df = S.with_script(sentences(spark, [("a", "train", t) for t in texts]))
    S.write_csv(df, str(tmp_path / "c.csv"))
    back = S.read_csv(spark, str(tmp_path / "c.csv")).orderBy("sentence_id").collect()
    assert [r.text for r in back] == texts and [r.tokens for r in back] == [t.split() for t in texts]


def test_empty_input(spark, tmp_path):
    none = sentences(spark, [("a", "train", "x")]).filter("false")
    assert S.apply_cleaning(none).count() == 0
    report = S.cleaning_report(none).first()
    assert (report.rows_before, report.rows_after, report.pct_dropped) == (0, 0, 0.0)
    assert S.prepare(S.empty_source(spark)).count() == 0
    assert S.assign_splits(S.with_script(none)).count() == 0
    assert S.summary(none).count() == 0


def test_manifest_order_holds_across_kinds(spark, tmp_path):
    manifest = corpus_files(tmp_path)
    built = S.build_dataset(spark, manifest[3:] + manifest[:3], str(tmp_path / "out"))
    assert [r.source for r in built.orderBy("sentence_id").collect()] == ["csv"] * 30 + ["tok"] * 45


def test_unsplit_rows_get_a_split_in_the_whole_job(spark, tmp_path):
    body = "".join(f"w{i}\tHI\nx\tEN\ny\tEN\n\n" for i in range(50))
    (tmp_path / "all.txt").write_text(body)
    built = S.build_dataset(
        spark, [S.SourceFile("s", None, str(tmp_path / "all.txt"))], str(tmp_path / "out")
    )
    assert Counter(r.split for r in built.collect()) == {"train": 40, "validation": 5, "test": 5}


def test_many_and_hot_strata(spark):
    """20,000 strata of two rows and one with as many rows as all others take the same path."""
    many = spark.range(40_000).selectExpr("id AS sentence_id", "concat('s', id div 2) AS source")
    hot = spark.range(40_000, 80_000).selectExpr("id AS sentence_id", "'hot' AS source")
    rows = many.unionByName(hot).selectExpr(
        "sentence_id", "source", "'roman_only' AS script_type", "cast(null AS string) AS split"
    )
    got = S.assign_splits(rows)
    hot_sizes = Counter({r.split: r["count"] for r in got.filter("source = 'hot'").groupBy("split").count().collect()})
    assert hot_sizes == {"train": 32_000, "validation": 4_000, "test": 4_000}
    assert got.filter("source <> 'hot' AND split <> 'train'").count() == 0 and got.count() == 80_000


def test_report_shuffles_digests(spark):
    rows = spark.createDataFrame([("a b c",), ("a b c",), ("x",), (None,)], "text string")
    report = S.cleaning_report(rows)
    first = report.first()
    assert (first.rows_before, first.dropped_duplicates, first.dropped_length, first.rows_after) == (4, 1, 2, 1)
    exchanges = [line for line in plan_of(report).splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("text" in line for line in exchanges)
