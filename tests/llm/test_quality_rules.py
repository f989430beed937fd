import math
import random
import re
from collections import Counter

from conftest import SF_DIR
from sangam.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = text.split("\n")
    again = sum(1 for i, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line) and line in lines[:i])
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(repeated), failed)


def test_base_measures(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = Q.op10_quality_rules(spark, SF_DIR).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:7] == brute(rows[r.doc_id])
        assert r.kept <= (not r.base_failed)


def test_junk_goes_and_clean_text_stays(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    got = [(labels[r.doc_id], r.kept, r.base_failed) for r in Q.op10_quality_rules(spark, SF_DIR).collect() if r.doc_id in labels]
    clean = [kept for quality, kept, failed in got if quality == 1 and not failed]
    junk = [kept for quality, kept, _ in got if quality == 0]
    assert sum(clean) >= 0.97 * len(clean) and sum(junk) <= 0.1 * len(junk)


def test_edges(spark):
    rows = [(1, None, "en", 1), (2, "", None, 1), (3, "a b\na b\n \n \n", "xx", 1), (4, "x" * 100_000, "en", 1), (None, "### " * 60, "en", 1)]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string, lang string, quality int")
    got = Q.quality_rules(docs).collect()
    assert len(got) == 10 and {type(r.quality).__name__ for r in got} == {"Row"}
    for r in got:
        assert tuple(r.quality)[:6] == brute(r.text) and not r.quality.kept
    assert Q.quality_rules(docs.limit(0)).collect() == []


def test_distance():
    import numpy as np

    assert Q.distance(np.array([1, 0]), np.array([0, 1])) == 1
    assert Q.distance(np.array([2, 4]), np.array([1, 2])) == 0


def test_every_language_has_a_reference(spark):
    """More than 64 languages, the smaller ones with words of their own, judged as if they were alone."""
    rng = random.Random(9)
    rows = []
    for n in range(70):
        own = [f"{chr(97 + n % 26)}{chr(97 + n // 26)}{chr(97 + k)}" for k in range(26)]
        for _ in range(2 if n >= 64 else 3):
            rows.append((len(rows), " ".join(rng.choice(own) for _ in range(90)), f"l{n:02}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.quality for r in Q.quality_rules(docs).collect()}
    assert len(Q.language_references(docs)) == 70
    few = docs.filter("lang >= 'l64'")
    alone = {r.doc_id: r.quality for r in Q.quality_rules(few).collect()}
    assert len(alone) == 12 and all(q.kept and got[i].kept for i, q in alone.items())
    assert all(abs(got[i].word_distance - q.word_distance) < 1e-9 for i, q in alone.items())


CLASSES = ["a-z", "A-Z", "0-9", " \t\n\v\f\r", ".,;:'\"()\\-", "#*$%&|<>", "!?"]


def plain_classes(text):
    counts = [len(re.findall(f"[{c}]", text)) for c in CLASSES]
    high = sum(ord(c) > 127 for c in text)
    return [*counts, len(text) - sum(counts) - high, high]


def plain_of(word):
    bare = word.rstrip(".,;:")
    return bare.lower() if bare.isalpha() else None


def js(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    part = lambda a, b: sum(x * math.log2(x / ((x + y) / 2)) for x, y in zip(a, b) if x > 0)
    return math.sqrt(max(0.0, (part(p, q) + part(q, p)) / 2))


def plain_references(rows, common=40):
    found = {}
    for lang in {la for _, la in rows if la is not None}:
        texts = [t for t, la in rows if la == lang and t]
        if len(set(texts)) < 2:
            continue
        classes = [sum(plain_classes(t)[i] / len(t) for t in texts) for i in range(9)]
        words = Counter(plain_of(w) for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t))
        total, rest = sum(words.values()), words.pop(None, 0)
        top = sorted(words.items(), key=lambda x: (-x[1], x[0]))[:common]
        shares = [n / total for _, n in top]
        found[lang] = len(texts), classes, [w for w, _ in top], [*shares, max(0.0, 1 - sum(shares) - rest / total), rest / total]
    return found


def plain_verdict(text, lang, references, rows):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if brute(text)[5]:
        return False
    own = [references[lang]] if lang in references else [r for r in references.values() if 100 * r[0] >= rows]
    if own and len(text) >= 200 and min(js(plain_classes(text), r[1]) for r in own) > 0.32:
        return False
    seen = Counter(plain_of(w) for w in words)

    def by_words(reference):
        _, _, common, shares = reference
        counts = [seen[w] for w in common]
        return js([*counts, len(words) - sum(counts) - seen[None], seen[None]], shares)

    return not (own and len(words) >= 50 and min(map(by_words, own)) > 0.45)


def test_verdicts_equal_plain_python(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    references = plain_references([(t, la) for _, t, la in rows])
    want = {i: plain_verdict(t, la, references, len(rows)) for i, t, la in rows}
    assert {r.doc_id: r.kept for r in Q.op10_quality_rules(spark, SF_DIR).collect()} == want


def junk_and_english(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id")
    english = docs.filter("lang = 'en' and quality = 1").select("doc_id", "text", "lang")
    rng = random.Random(3)
    rows = [(10_000 + i, " ".join("".join(rng.choice("#$%&x9Z") for _ in range(6)) for _ in range(120)), f"own{i}") for i in range(20)]
    return english, spark.createDataFrame(rows, english.schema)


def test_no_text_is_its_own_reference(spark):
    english, junk = junk_and_english(spark)
    alone = Q.quality_rules(english.unionByName(junk)).filter("doc_id >= 10000").collect()
    assert len(alone) == 20 and not any(r.quality.kept for r in alone)
    # a second copy of the text doesn't help it
    copies = Q.quality_rules(english.unionByName(junk).unionByName(junk)).filter("doc_id >= 10000").collect()
    assert len(copies) == 40 and not any(r.quality.kept for r in copies)


def test_many_languages_are_joined(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = sorted((r.doc_id, r.kept) for r in Q.op10_quality_rules(spark, SF_DIR).collect())
    monkeypatch.setattr(Q, "MOST_HELD", 1)
    assert sorted((r.doc_id, r.kept) for r in Q.op10_quality_rules(spark, SF_DIR).collect()) == want
    assert Q.quality_rules(docs).columns == [*docs.columns, "quality"]
