"""Quality classifier: a sparse ensemble of rules, compiled into Spark columns.

Statistics of whole texts are Spark columns. Trees grown on labelled rows give their paths as
conjunctive rules over the statistics; a logistic regression with a lasso penalty keeps the
few rules that carry weight; these become one Spark expression, the score. Trees and regression are
those of Spark ML, fitted on at most ``Fit.rows`` labelled rows, taken in the order of a hash of the
doc_id; statistics and scores cover every row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import WORD, Scratch, table

#: Marks of ordinary writing; fixed values.
MARKS = ".,;:'\"()-"


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of the fit."""

    rows: int = 20_000
    trees: int = 16
    depth: int = 4
    lasso: float = 0.002
    seed: int = 3


@dataclass(frozen=True)
class RuleModel:
    """``rules`` are (weight, conditions); a condition is (statistic, at most?, threshold)."""

    intercept: float
    rules: tuple[tuple[float, tuple[tuple[str, bool, float], ...]], ...]

    def score(self) -> Column:
        """The probability of label 1, as a column over the statistics."""
        total = F.lit(self.intercept)
        for weight, conditions in self.rules:
            holds = F.lit(True)
            for name, at_most, threshold in conditions:
                value = F.col(name)
                holds = holds & ((value <= threshold) if at_most else (value > threshold))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text; all are 0 for null and empty texts.

    Words are looked at in one array, which lambdas receive, so that it is made once.
    """
    size = F.greatest(F.char_length(text), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / size

    def of_words(words: Column) -> Column:
        n = F.size(words)
        some = F.greatest(n, F.lit(1))
        distinct = F.size(F.array_distinct(words))
        # runs of three words, each pair of neighbours compared
        same = F.zip_with(words, F.slice(words, 2, some), lambda a, b: (a == b).cast("int"))
        thirds = F.zip_with(words, F.slice(words, 3, some), lambda a, b: F.concat(a, F.lit(" "), F.coalesce(b, F.lit(""))))
        return F.struct(
            F.log1p(n.cast("double")).alias("log_words"),
            (distinct / some).alias("distinct_words"),
            (F.size(F.array_distinct(thirds)) / some).alias("distinct_skips"),
            (F.aggregate(same, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))) / some).alias("doubled_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.size(F.array_distinct(lines)) / F.size(lines)

    words = F.transform(F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), of_words)[0]
    blanks = F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]+")) + 1
    return {
        "words": words,
        "distinct_lines": F.transform(F.array(F.split(text, "\n")), of_lines)[0],
        "mean_word": F.char_length(text) / blanks,
        "upper": share(r"[A-Z]"),
        "digits": share(r"[0-9]"),
        "marks": share(r"[.,;:'\"()-]"),
        "shouts": share(r"[!?]"),
        "symbols": share(r"[#*$%&|<>@^~=+_\\/\[\]{}]"),
    }


STATISTICS = (
    "log_words", "distinct_words", "distinct_skips", "doubled_words", "distinct_lines",
    "mean_word", "upper", "digits", "marks", "shouts", "symbols",
)


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row; other columns, labels among them, play no part."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(c.alias(n) for n, c in statistics(text).items()))
    return found.select("doc_id", *(F.coalesce(F.col(f"words.{s}" if s in STATISTICS[:4] else s).cast("double"), F.lit(0.0)).alias(s) for s in STATISTICS))


def _paths(node, conditions=()):
    """Conjunctions along a tree's paths, inner nodes included, each with one bound per side and statistic."""
    if conditions:
        bounds: dict[tuple[str, bool], float] = {}
        for name, at_most, threshold in conditions:
            old = bounds.get((name, at_most), threshold)
            bounds[name, at_most] = min(old, threshold) if at_most else max(old, threshold)
        yield tuple(sorted((n, a, t) for (n, a), t in bounds.items()))
    if node.subtreeDepth() > 0:
        name, threshold = STATISTICS[node.split().featureIndex()], node.split().threshold()
        yield from _paths(node.leftChild(), (*conditions, (name, True, threshold)))
        yield from _paths(node.rightChild(), (*conditions, (name, False, threshold)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2


def fit(labelled: DataFrame, settings: Fit = Fit()) -> RuleModel:
    """Rules and weights from rows with the statistics and ``label`` (0 or 1).

    Without rows the score is 0.5. With one label only it is 1 or 0, and if the statistics part nothing, as with
    equal texts, the share of the label 1.
    """
    order = F.xxhash64(F.lit(settings.seed), "doc_id")
    rows = Scratch(labelled.sparkSession, "rules").keep(labelled.orderBy(order, "doc_id").limit(settings.rows), "sample")
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return RuleModel(0.0 if not counts else math.copysign(20.0, next(iter(counts)) - 0.5), ())
    rows = rows.withColumn("features", array_to_vector(F.array(*STATISTICS)))
    forest = RandomForestClassifier(numTrees=settings.trees, maxDepth=settings.depth, seed=settings.seed, featureSubsetStrategy="0.6", minInstancesPerNode=5)
    trees = forest.fit(rows)._java_obj.trees()
    rules = sorted({path for tree in trees for path in _paths(tree.rootNode())})
    if not rules:
        return RuleModel(math.log(counts[1.0] / counts[0.0]), ())
    held = [RuleModel(0.0, ((1.0, conditions),)) for conditions in rules]

    def indicator(model: RuleModel) -> Column:
        ((_, conditions),) = model.rules
        holds = F.lit(True)
        for name, at_most, threshold in conditions:
            holds = holds & ((F.col(name) <= threshold) if at_most else (F.col(name) > threshold))
        return holds.cast("double")

    rows = rows.select("label", array_to_vector(F.array(*map(indicator, held))).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=settings.lasso, maxIter=60, standardization=False)
    found = lasso.fit(rows)
    weights = found.coefficients.toArray().tolist()
    kept = tuple((w, conditions) for w, conditions in zip(weights, rules) if abs(w) > 1e-6)
    return RuleModel(float(found.intercept), kept)


def learn(found: DataFrame, labels: DataFrame, label: str = "quality", settings: Fit = Fit()) -> RuleModel:
    """A model from rows of ``with_statistics`` and ``labels`` (doc_id and ``label``), without held-out rows.

    Of rows with equal doc_id the one whose statistics come first is learnt from, whatever the order of the rows.
    """
    known = labels.filter(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other"))
    known = known.filter("label = other").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("double").alias("label"))
    learnt = found.join(known.filter(~held_out(F.col("doc_id"))), "doc_id")
    learnt = learnt.groupBy("doc_id", "label").agg(F.min(F.struct(*STATISTICS)).alias("first")).select("doc_id", "label", "first.*")
    return fit(learnt, settings)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Fit = Fit(), threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``; ``labels`` has doc_id and ``label``.

    Rows with held_out aren't learnt from, nor rows without doc_id or label or with a doc_id whose
    labels disagree. Null and empty texts have the score of statistics that are all 0. Repeated rows
    each get a score, and texts with equal statistics the same one; other columns don't matter; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "classify")
    found = scratch.keep(with_statistics(docs), "statistics")
    model = learn(found, labels, label, settings)
    out = found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), model.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op2_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
