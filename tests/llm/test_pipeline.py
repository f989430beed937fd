import __spark_entry__ as entry_points
import compare
import pytest

import corpus_pipeline
from conftest import SF_DIR
from sangam.llm import bpe, decontamination, minhash, quality_rules, secrets
from sangam.llm.common import table
from test_secrets import redacted


def test_stages_one_by_one(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(place)))
        out = spark.read.parquet(str(tmp_path / str(place)))
        after = {r.doc_id: r for r in out.collect()}
        assert len(after) == out.count() and set(after) <= set(before)
        if place < 4:
            assert out.columns == columns
        if place == 0:
            kept = {r.doc_id for r in quality_rules.quality_rules(docs).filter("quality.kept").collect()}
            assert set(after) == kept
        elif place == 1:
            groups = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 5, 80).collect()}
            assert set(after) == set(groups.values()) and 0 < len(after) < len(before)
        elif place == 2:
            held = decontamination.contaminated(docs, table(spark, SF_DIR, "benchmark"))
            assert set(after) == set(before) - {r.doc_id for r in held.collect()}
        elif place == 3:
            assert set(after) == set(before)
            for i, r in after.items():
                assert r.text == redacted(before[i].text) and r.n_chars == len(r.text)
        else:
            v = bpe.vocabulary(bpe.public_vocabulary())
            for i, r in after.items():
                assert r.n_tokens == len(r.tokens)
                decoder = bpe.Decoder(v)
                assert decoder.feed(r.tokens) + decoder.finish() == before[i].text
        docs = out


def test_edge_rows_pass_every_stage(spark):
    long = "Some words that go on and on. " * 3000
    rows = [(None, None, None, None, None), (None, long, "en", "s", 1), (1, None, "en", None, 0), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, long, None, "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        kept.append(sorted(str((r.doc_id, len(r.text or ""))) for r in stage(spark, docs, SF_DIR).collect()))
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    every = sorted(str((r[0], len(r[1] or ""))) for r in rows)
    # all texts are empty, or repeat themselves
    assert kept[0] == []
    # one row each of the documents that lead a group, and those without an id
    assert kept[1] == sorted(str(x) for x in [(None, 0), (None, len(long)), (1, 0), (2, 0), (3, len(long))])
    assert kept[2] == kept[3] == kept[4] == every


@pytest.mark.parametrize("name", ["op5_secrets", "op7_minhash", "op8_sharding", "op9_warc"])
def test_query_equals_sql(spark, name):
    sql = entry_points.oracle_sql()
    if name not in sql:
        pytest.skip("no SQL")
    con = compare.connect(SF_DIR)
    assert compare.spark_rows(entry_points.queries()[name](spark, SF_DIR)) == compare.duck_rows(con, sql[name])


def test_last_stage_makes_a_round_trip(spark):
    rows = [(1, "Hello, 世界  again"), (1, "naïve 😀 x"), (None, "a\nb"), (2, ""), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.encode_tokens(spark, docs, SF_DIR).collect()
    assert sorted(r.text for r in got) == sorted(t or "" for _, t in rows)
    assert all(r.n_tokens == len(r.tokens) for r in got)
