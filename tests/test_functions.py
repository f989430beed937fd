import random
import re
import sys

import pytest
from pyspark.sql import functions as F

import sangam as S
from sangam.functions import text as X

DEVA_MENTION = "@\N{DEVANAGARI LETTER MA}\N{DEVANAGARI LETTER NA}\N{DEVANAGARI VOWEL SIGN II}\N{DEVANAGARI LETTER SSA}\N{DEVANAGARI VOWEL SIGN AA}"

CLEANING = [
    ("chat.co/x hi", "cha hi"),
    ("a@b.com mail", "a.com mail"),
    (DEVA_MENTION + " ok", DEVA_MENTION[3:] + " ok"),
    ("see HTTPS://x.y\N{NO-BREAK SPACE}ok", "see ok"),
    ("x\N{ZERO WIDTH SPACE}http://", "x\N{ZERO WIDTH SPACE}http://"),
    ("http:// x", "http:// x"),
    ("http\N{LATIN SMALL LETTER LONG S}://a b", "b"),
    ("@@user", "@"),
    ("@user: hi", ": hi"),
    ("t@x.co/abc hi", "t.co/abc hi"),
    ("a\x1cb\x85c\N{EM SPACE}d", "a b c d"),
    ("WWW.x.y hi", "hi"),
    ("T.CO/x hi", "hi"),
    ("www. x", "www. x"),
    ("  lead and trail\t\n", "lead and trail"),
    ("", ""),
    ("\N{EM SPACE}\x1f", ""),
    (None, None),
]


def values(spark, cells, *columns):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    rows = df.select("i", *[f(F.col("c")).alias(f"r{n}") for n, f in enumerate(columns)])
    return [tuple(r)[1:] for r in sorted(rows.collect())]


def test_clean_text(spark):
    got = values(spark, [c for c, _ in CLEANING], S.clean_text)
    assert [g[0] for g in got] == [want for _, want in CLEANING]


def test_guards_change_nothing(spark):
    plain = lambda c: S.collapse_ws(S.strip_mentions(S.strip_urls(c)))
    for guarded, without in values(spark, [c for c, _ in CLEANING], S.clean_text, plain):
        assert guarded == without


PIECES = [
    *"aZ9_@#.,:/'<- ",
    *"\t\n\x0b\x1c\x85\xa0",
    *"\N{EM SPACE}\N{IDEOGRAPHIC SPACE}\N{ZERO WIDTH SPACE}\N{LATIN SMALL LETTER LONG S}",
    *"\N{DEVANAGARI LETTER NA}\N{DEVANAGARI VOWEL SIGN E}\N{LATIN SMALL LETTER E WITH ACUTE}\N{GRINNING FACE}",
    *["http://", "HTTPS://", "www.", "WwW.", "t.co/", "T.CO/", "@user", "a@b.co", "://", "ok "],
]


def test_cleaning_of_random_text(spark):
    """Against the same rules in Python's regular expressions."""
    rng = random.Random(7)
    cells = ["".join(rng.choices(PIECES, k=rng.randrange(14))) for _ in range(4000)]

    def expected(text):
        text = re.sub(r"(?i)(?:https?://|www\.|t\.co/)\S+", "", text)
        return " ".join(re.sub(r"@\w+", "", text).split())

    got = values(spark, cells, S.clean_text, S.tokens_of, S.strip_ws)
    assert got == [(expected(c), c.split(), c.strip()) for c in cells]


def code_points():
    return [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]


@pytest.mark.parametrize(
    "pattern, python",
    [
        (f"[{X.SPACE}]", str.isspace),
        (f"[{X.WORD}]", lambda c: c == "_" or c.isalnum()),
        (f"[{X.DIGIT}]", str.isdigit),
    ],
    ids=["space", "word", "digit"],
)
def test_classes_on_all_code_points(spark, pattern, python):
    """Equal on every code point that both Unicode versions know."""
    import unicodedata

    df = spark.range(1, sys.maxunicode + 1).filter("id NOT BETWEEN 55296 AND 57343")
    as_bytes = F.unhex(F.lpad(F.hex("id"), 8, "0"))
    char = F.decode(as_bytes, "UTF-32")
    assigned = ~char.rlike(r"^\p{Cn}$")
    got = {r.id for r in df.filter(char.rlike(f"^{pattern}$")).collect()}
    known = {r.id for r in df.filter(assigned).select("id").collect()}
    want = {c for c in code_points() if python(chr(c)) and unicodedata.category(chr(c)) != "Cn"}
    assert got & known == want & known


def test_space_characters():
    assert set(X.SPACE_CHARS) == {chr(c) for c in code_points() if chr(c).isspace()}


def test_strip_and_blank(spark):
    cells = ["\N{EM SPACE} a b\x1c\t", "", " \x85", "a", "\N{DEVANAGARI LETTER KA} \N{IDEOGRAPHIC SPACE}"]
    got = values(spark, cells, S.strip_ws, S.is_blank)
    assert got == [(c.strip(), not c.strip()) for c in cells]


def test_tokens(spark):
    got = values(
        spark,
        ["a b", "", "  a\N{EM SPACE}b ", "one"],
        S.tokens_of,
        lambda c: S.tokens_of(S.clean_text(c)),
        lambda c: S.clean_tokens(S.clean_text(c)),
        lambda c: S.clean_token_count(S.clean_text(c)),
    )
    for general, after_clean, fast, count in got:
        assert general == after_clean == fast and count == len(fast)
    assert [g[0] for g in got] == [["a", "b"], [], ["a", "b"], ["one"]]


ARRAYS = [
    ("['tok1' 'tok2'\n 'tok3']", ["tok1", "tok2", "tok3"], ["tok1", "tok2", "tok3"]),
    ("['I' \"don't\" 'know']", ["I", 't" '], ["I", "don't", "know"]),
    ('["it\'s"]', [], ["it's"]),
    (r"['a\'b' 'c']", [r"a\'b", "c"], [r"a\'b", "c"]),
    ("['']", [""], [""]),
    ("['lang1', 'lang2']", ["lang1", "lang2"], ["lang1", "lang2"]),
    (None, [], []),
    ("nan", [], []),
]


def test_parse_array_repr_of_a_long_item(spark):
    """A long item is matched in a loop; a pattern that recurses overflows the stack."""
    long = "a\\'b" * 40_000
    cells = [f"['{long}' 'c']", f"['{'x' * 100_000}']"]
    got = values(spark, cells, S.parse_array_repr, lambda c: S.parse_array_repr(c, strict=True))
    assert got == [([long, "c"],) * 2, (["x" * 100_000],) * 2]


def test_parse_array_repr(spark):
    got = values(
        spark,
        [a[0] for a in ARRAYS],
        S.parse_array_repr,
        lambda c: S.parse_array_repr(c, strict=True),
    )
    assert got == [(a[1], a[2]) for a in ARRAYS]


SCRIPTS = [
    ("abc", "roman_only", (0, 3, 3, 0.0, 100.0)),
    ("\N{DEVANAGARI LETTER NA}\N{DEVANAGARI VOWEL SIGN E}", "devanagari_only", (2, 0, 2, 100.0, 0.0)),
    ("hi \N{DEVANAGARI LETTER NA}\N{DEVANAGARI LETTER MA}", "mixed_script", (2, 2, 4, 50.0, 50.0)),
    ("<3 123", "unknown", (0, 0, 0, 0.0, 0.0)),
    ("\N{LATIN SMALL LETTER E WITH ACUTE}", "unknown", (0, 0, 0, 0.0, 0.0)),
    ("\N{DEVANAGARI DANDA}", "devanagari_only", (1, 0, 1, 100.0, 0.0)),
    ("", "unknown", (0, 0, 0, 0.0, 0.0)),
]


def test_scripts(spark):
    got = values(spark, [s[0] for s in SCRIPTS], S.script_label, S.script_counts)
    assert [(label, tuple(c)) for label, c in got] == [s[1:] for s in SCRIPTS]


def test_numbers(spark):
    rows = spark.createDataFrame([(6.25,), (0.15,), (6.35,), (30.0,)], "x double")
    assert [r[0] for r in rows.select(S.round1(F.col("x"))).collect()] == [6.2, 0.2, 6.4, 30.0]
    one = spark.range(1)
    got = one.select(
        S.text_bar(F.lit(9.9)), S.thousands(F.lit(43924)), S.one_decimal(F.lit(1.0)), S.percent(F.lit(1), F.lit(0))
    ).first()
    assert tuple(got) == ("####", "43,924", "1.0", 0.0)


def test_previews(spark):
    text = "x" * 69 + "\N{DEVANAGARI LETTER NA}" * 3
    got = values(spark, [text], X.ascii_preview, lambda c: X.text_preview(c, 5))
    assert got == [("x" * 69 + "?", "xxxxx")]


def test_is_digits(spark):
    got = values(spark, ["123", "12a", "", "\N{SUPERSCRIPT TWO}", "\N{DEVANAGARI DIGIT ONE}"], S.is_digits)
    assert [g[0] for g in got] == [True, False, False, True, True]


def test_percents_round_as_python_does(spark):
    """All shares of up to 1,999 as percents, and values half-way between two decimals."""
    pairs = spark.range(1, 2000).selectExpr("id AS b").selectExpr("b", "explode(sequence(0L, b)) AS a")
    value = F.col("a") / F.col("b") * 100
    rows = pairs.select(value.alias("x"), S.round1_exact(value).alias("r")).distinct()
    wrong = [(x, r) for batch in rows.toArrow().to_batches() for x, r in zip(*(c.to_pylist() for c in batch.columns)) if round(x, 1) != r]
    assert wrong == []
    ties = [0.15, 0.25, 0.35, 6.25, 6.35, 0.05, 99.95, 33.25, 2.675, 0.0, 100.0, 0.65]
    got = spark.createDataFrame([(t,) for t in ties], "x double").select("x", S.round1_exact(F.col("x")).alias("r")).collect()
    assert [(r.x, r.r) for r in got] == [(t, round(t, 1)) for t in ties]
