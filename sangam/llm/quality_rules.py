"""Quality rules by distribution divergence.

Two histograms of a document are compared with those of its language by the
Jensen-Shannon distance (base 2, so from 0 to 1): the classes of its characters, and the
share of each of the language's commonest words, of words made of letters only, and of
the rest. The references are learnt from all rows of the input, a language at a time. A language
needs at least two different texts for a reference, as a text says nothing about itself. A document without a language, or
with one that has no reference, is held against the references of the main languages, those of at
least one row in a hundred, and the nearest counts. Histograms of short texts are noisy, so each
comparison has a minimum length, below which it says nothing.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructField, StructType

from .common import WORDS, Scratch, arrow_rows, give_back, small_slices, table

#: The symbols that are counted.
SYMBOLS = "#*$%&|<>"
#: Character classes; a code point of 128 or more is a letter or anything else.
CLASSES = ("lower", "upper", "digit", "blank", "stop", "symbol", "shout", "other", "letter_not_ascii")

_ASCII = np.full(129, CLASSES.index("other"), dtype=np.int64)
for _name, _chars in (
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("digit", "0123456789"),
    ("blank", " \t\n\v\f\r"),
    ("stop", ".,;:'\"()-"),
    ("symbol", SYMBOLS),
    ("shout", "!?"),
):
    _ASCII[[ord(c) for c in _chars]] = CLASSES.index(_name)
_ASCII[128] = CLASSES.index("letter_not_ascii")

#: Stands for a word that is not all letters; beginning of the keys of character classes; key of the number of rows.
_NO_WORD, _CLASS, _ROWS = "\x00rest", "\x00class ", "\x00rows"
#: A task hands on its word counts before they hold more than so many words.
_FLUSH = 50_000
#: Plain forms of words remembered per worker.
_REMEMBERED = 50_000
#: References of up to so many languages go with the tasks; of more they are joined to the rows.
MOST_HELD = 2_000
#: A language is a main one from this share of the rows on, so there are a hundred at most.
MAIN_PERCENT = 1
#: Shares of character classes are summed as integers, so sums don't depend on the order of tasks.
_UNIT = 1 << 24


@dataclass(frozen=True)
class Limits:
    """Guards and thresholds of the two comparisons, and the base rules."""

    min_words: int = 50
    repeat_percent: int = 50
    class_min_chars: int = 200
    class_distance: float = 0.32
    word_min_words: int = 50
    word_distance: float = 0.45
    common_words: int = 40


def class_histogram(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.bincount(_ASCII[np.minimum(codes, 128)], minlength=len(CLASSES))


#: Plain forms met so far; emptied when full.
_plain: dict[str, str] = {}


def plain_word(word: str) -> str:
    """The word in lower case without ending marks if that is all letters, else ``_NO_WORD``."""
    found = _plain.get(word)
    if found is None:
        if len(_plain) >= _REMEMBERED:
            _plain.clear()
        bare = word.rstrip(".,;:")
        found = _plain[word] = bare.lower() if bare.isalpha() else _NO_WORD
    return found


def base_measures(text: str, words: list[str]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    n_symbols = sum(map(text.count, SYMBOLS))
    duplicates = 0
    if "\n" in text:
        seen: set[str] = set()
        for line in text.split("\n"):
            if line in seen:
                duplicates += WORDS.search(line) is not None
            else:
                seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        covered = 0  # words up to here are counted
        for at, window in enumerate(windows):
            if counts[window] > 1:
                repeated += at + 3 - max(at, covered)
                covered = at + 3
    return sum(map(len, words)), n_symbols, duplicates, repeated


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms that each sum to something."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum()
        right = np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, (left + right) / 2)))


def word_histogram(words: list[str], common: dict[str, int]) -> np.ndarray:
    """Counts of the common words, then of other words of letters, then of the rest."""
    other = len(common)
    out = [0] * (other + 2)
    for word, n in Counter(words).items():
        plain = plain_word(word)
        out[common.get(plain, other + (plain == _NO_WORD))] += n
    return np.array(out, dtype=float)


def _language_sums(docs: DataFrame) -> DataFrame:
    """(lang, key, n, low, high): counts of words and of character classes; rows, and the least and largest hash of a text."""

    def counted(incoming):
        counts: Counter = Counter()
        words: dict[str, Counter] = {}
        texts: dict[str, tuple[int, int]] = {}

        def out():
            for lang, seen in words.items():
                for word, n in seen.items():
                    counts[lang, plain_word(word)] += n
            keys = [*counts, *((lang, _ROWS) for lang in texts)]
            ends = [(None, None)] * len(counts) + list(texts.values())
            columns = [*zip(*keys)], [*counts.values(), *([0] * len(texts))], [*zip(*ends)]
            made = {"lang": columns[0][0], "key": columns[0][1], "n": columns[1]}
            made |= {name: pa.array(end, pa.int64()) for name, end in zip(("low", "high"), columns[2])}
            words.clear(), counts.clear(), texts.clear()
            return pa.RecordBatch.from_pydict(made)

        for batch in (part for whole in incoming for part in small_slices(whole)):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                shares = class_histogram(text)
                for name, n in zip(CLASSES, np.rint(shares * (_UNIT / shares.sum())).astype(int).tolist()):
                    counts[lang, _CLASS + name] += n
                counts[lang, _ROWS] += 1
                digest = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)
                low, high = texts.get(lang, (digest, digest))
                texts[lang] = min(low, digest), max(high, digest)
                words.setdefault(lang, Counter()).update(WORDS.findall(text))
                if sum(map(len, words.values())) > _FLUSH:
                    yield out()
        if counts:
            yield out()
        _plain.clear()
        give_back()

    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").alias("text")).filter("lang is not null")
    sums = rows.mapInArrow(counted, "lang string, key string, n long, low long, high long").groupBy("lang", "key")
    return sums.agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def reference_table(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per language with a reference: lang, n_rows, classes, words and shares of its commonest words, share of the rest.

    Every row and every language counts; rows without language or text teach nothing. Words are counted
    per task, then summed by (language, word).
    """
    scratch = Scratch(docs.sparkSession, "languages")
    sums = scratch.keep(_language_sums(docs), "sums")
    is_word = ~F.col("key").startswith("\x00")
    # a reference needs two different texts
    known = sums.filter((F.col("key") == _ROWS) & (F.col("low") < F.col("high"))).select("lang", F.col("n").alias("n_rows"))
    known = scratch.keep(known, "known")
    totals = sums.filter(is_word | (F.col("key") == _NO_WORD)).groupBy("lang").agg(F.sum("n").alias("words"))
    totals = scratch.keep(totals, "totals")
    # the rank limit runs in every task before rows of a language meet
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
    top = sums.filter(is_word).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limits.common_words)
    others = sums.filter(F.col("key").startswith(_CLASS) | (F.col("key") == _NO_WORD)).withColumn("place", F.lit(0))
    found = top.unionByName(others).join(known, "lang").join(totals, "lang", "left")
    share = F.col("n") / F.col("words")

    def of_class(name):
        return F.coalesce(F.max(F.when(F.col("key") == _CLASS + name, F.col("n"))), F.lit(0)).cast("double")

    common = F.array_sort(F.collect_list(F.when(F.col("place") > 0, F.struct("place", "key", share.alias("share")))))
    rest = F.coalesce(F.max(F.when(F.col("key") == _NO_WORD, share)), F.lit(0.0))
    table_ = found.groupBy("lang", "n_rows").agg(F.array(*map(of_class, CLASSES)).alias("classes"), common.alias("common"), rest.alias("rest"))
    table_ = table_.select("lang", "n_rows", "classes", F.col("common.key").alias("words"), F.col("common.share").alias("shares"), "rest")
    return scratch.keep(table_, "references")


def _reference(classes, words, shares, rest) -> dict:
    histogram = np.array([*shares, max(0.0, 1 - sum(shares) - rest), rest])
    return {"classes": np.array(classes), "words": {w: i for i, w in enumerate(words)}, "histogram": histogram}


def language_references(docs: DataFrame, limits: Limits = Limits()) -> dict[str, dict]:
    """The references of all languages of ``reference_table``, for corpora with few languages."""
    return {r.lang: _reference(*r[2:]) for r in reference_table(docs, limits).collect()}


@dataclass
class References:
    """What rows are judged by: references at hand, the main ones, and a table of all if they are too many to be at hand."""

    held: dict[str, dict]
    main: list[dict]
    table: DataFrame | None = None

    @staticmethod
    def of(docs: DataFrame, limits: Limits = Limits()) -> References:
        found = reference_table(docs, limits)
        rows = docs.select(F.count(F.lit(1)).alias("n")).first()["n"]
        main = found.filter(F.col("n_rows") * 100 >= F.lit(rows) * MAIN_PERCENT).orderBy("lang").collect()
        if found.count() > MOST_HELD:
            return References({}, [_reference(*r[2:]) for r in main], found)
        return References({r.lang: _reference(*r[2:]) for r in found.collect()}, [_reference(*r[2:]) for r in main])

    def joined(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``__reference``, that of their language if it isn't at hand; large languages may be split by the join."""
        if self.table is None:
            return rows.withColumn("__reference", F.lit(None).cast("int"))
        fields = F.struct("classes", "words", "shares", "rest").alias("__reference")
        known = self.table.select(F.col("lang").alias("__lang"), fields)
        return rows.join(known, F.col("lang") == F.col("__lang"), "left").drop("__lang")

    def judging(self) -> tuple[dict[str, dict], list[dict]]:
        return self.held, self.main


def judge(text: str | None, own: list[dict], limits: Limits) -> tuple:
    """n_words, the four base measures, base_failed, kept, class and word distance to the nearest (None below the guard)."""
    text = text or ""
    words = WORDS.findall(text)
    n = len(words)
    base = base_measures(text, words)
    failed = n < limits.min_words or 100 * base[3] > limits.repeat_percent * n
    by_class = by_word = None
    if own and len(text) >= limits.class_min_chars:
        classes = class_histogram(text)
        by_class = min(distance(classes, r["classes"]) for r in own)
    if own and n >= limits.word_min_words:
        by_word = min(distance(word_histogram(words, r["words"]), r["histogram"]) for r in own)
    far = (by_class or 0) > limits.class_distance or (by_word or 0) > limits.word_distance
    return (n, *base, failed, not (failed or far), by_class, by_word)


def _judged(batch: pa.RecordBatch, held: dict[str, dict], main: list[dict], limits: Limits) -> list[tuple]:
    """Verdicts on rows with text, lang and __reference."""
    out = []
    for text, lang, joined in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "__reference"))):
        if joined is not None:
            own = [_reference(*(joined[f] for f in ("classes", "words", "shares", "rest")))]
        else:
            own = [held[lang]] if lang in held else main
        out.append(judge(text, own, limits))
    return out


VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, class_distance double, word_distance double"
)
_NAMES = [x.split()[0] for x in VERDICT.split(", ")]


def quality_rules(docs: DataFrame, limits: Limits = Limits(), references: References | None = None) -> DataFrame:
    """All rows of ``docs`` with a struct ``quality``: base measures, distances and the verdict.

    Two scans, no shuffle of texts unless there are more than ``MOST_HELD`` languages. Null and empty texts have no
    words and fail; null languages, and those with a single text, are held against the main ones; with neither only the
    base rules decide. A distance on its limit passes. Repeated rows are judged each for itself, whole texts however long; an
    empty table gives an empty result; columns named ``quality`` and ``__reference`` are replaced, others stay.
    """
    if "lang" not in docs.columns:
        return quality_rules(docs.withColumn("lang", F.lit(None).cast("string")), limits, references).drop("lang")
    references = References.of(docs, limits) if references is None else references
    names = [c for c in docs.columns if c not in ("quality", "__reference")]
    schema = StructType([*(docs.schema[c] for c in names), StructField("quality", StructType.fromDDL(VERDICT))])
    kind = pa.struct([(f, pa.bool_() if f in ("base_failed", "kept") else pa.float64() if "distance" in f else pa.int64()) for f in _NAMES])
    held, main = references.judging()

    def judged(incoming):
        for batch in (part for whole in incoming for part in small_slices(whole)):
            found = [dict(zip(_NAMES, row)) for row in _judged(batch, held, main, limits)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found, kind)], names=[*names, "quality"])
        _plain.clear()
        give_back()

    return references.joined(docs.select(*names)).mapInArrow(judged, schema)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    references = References.of(docs)
    (held, main), limits = references.judging(), Limits()

    # the text is not handed back
    def measured(batch):
        rows = _judged(batch, held, main, limits)
        return {"doc_id": batch.column("doc_id"), **dict(zip(_NAMES, zip(*rows)))} if rows else None

    return arrow_rows(references.joined(docs), measured, f"doc_id long, {VERDICT}")
