import math
import re
import zlib

import pytest

from conftest import SF_DIR
from sangam.llm import rule_ensemble as R
from sangam.llm.common import table


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in R.op2_rule_ensemble(spark, SF_DIR).collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    assert len(rows) == table(spark, SF_DIR, "documents").count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    tested = [(labels[i], r.predicted) for i, r in rows.items() if i in labels and r.held_out]
    assert sum(a == b for a, b in tested) >= 0.9 * len(tested)


def test_held_out_labels_teach_nothing(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    scores = [{r.doc_id: r.score for r in R.classify(docs, known).collect()} for known in (labels, turned)]
    assert scores[0] == scores[1]


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "word " * 50_000), (None, "a b c"), (2, "")]
    docs = spark.createDataFrame([(*r, 0.5, 1) for r in rows], "doc_id long, text string, score double, upper int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    got = R.classify(docs, labels).collect()
    assert len(got) == 5 and {r.score for r in got} == {0.5}
    found = {r.doc_id: r for r in R.with_statistics(docs).collect()}
    assert all(getattr(found[1], s) == 0 for s in ("upper", "digits", "doubled_words", "mean_word"))
    assert R.classify(docs.limit(0), labels).collect() == []


def test_rules_are_expressions(spark):
    model = R.RuleModel(0.0, ((2.0, (("upper", False, 0.5), ("digits", True, 0.1))),))
    rows = spark.createDataFrame([(0.6, 0.0), (0.6, 0.2), (0.4, 0.0)], "upper double, digits double")
    got = [round(r[0], 4) for r in rows.select(model.score()).collect()]
    assert got == [0.8808, 0.5, 0.5]


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, size = max(1, len(words)), max(1, len(text))
    share = lambda chars: len(re.findall(f"[{chars}]", text)) / size
    skips = {(a, b) for a, b in zip(words, [*words[2:], "", ""])}
    skips = {f"{a} {b}" for a, b in skips}
    lines = text.split("\n")
    return {
        "log_words": math.log1p(len(words)),
        "distinct_words": len(set(words)) / n,
        "distinct_skips": len(skips) / n,
        "doubled_words": sum(a == b for a, b in zip(words, words[1:])) / n,
        "distinct_lines": len(set(lines)) / len(lines),
        "mean_word": len(text) / (len(re.findall(r"[\x20\x09-\x0D]+", text)) + 1),
        "upper": share("A-Z"),
        "digits": share("0-9"),
        "marks": share(r".,;:'\"()\-"),
        "shouts": share("!?"),
        "symbols": share(r"#*$%&|<>@^~=+_\\/\[\]{}"),
    }


def test_scores_equal_rules_in_plain_python(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    model = R.learn(R.with_statistics(docs), labels)
    scores = {r.doc_id: r.score for r in R.classify(docs, labels).collect()}
    assert len(model.rules) > 5
    for r in docs.collect():
        stats = plain_statistics(r.text)
        total = model.intercept
        for weight, conditions in model.rules:
            total += weight * all((stats[n] <= t) if at_most else (stats[n] > t) for n, at_most, t in conditions)
        assert abs(scores[r.doc_id] - 1 / (1 + math.exp(-total))) < 1e-9, r.doc_id


@pytest.mark.parametrize("text", ["the same text", None])
def test_equal_texts_have_the_share_of_the_labels(spark, text):
    docs = spark.createDataFrame([(i, text) for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(20)], "doc_id long, quality int")
    learnt = [i for i in range(20) if zlib.crc32(str(i).encode()) % 4 != 2]
    share = sum(i % 4 == 0 for i in learnt) / len(learnt)
    assert {round(r.score, 9) for r in R.classify(docs, labels).collect()} == {round(share, 9)}


def test_order_of_rows_with_one_id_does_not_matter(spark):
    rows = [(i // 2, ("word " * (i % 9 + 1) + "X! " * (i % 5)) * 3) for i in range(160)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    scores = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        scores.append(sorted((r.doc_id, r.score) for r in R.classify(docs, labels).collect()))
    assert scores[0] == scores[1]
