"""Secret scans by a trigram inverted index, in DataFrame functions only.

Each rule's regular expression is turned into a Boolean query over trigrams that every match must
hold (in lower case). The trigrams of all queries are looked up in every text, which gives postings
(trigram, text); the postings of a text are brought together and the queries are put to them. Only
candidates are searched with the rule itself. A rule whose matches needn't hold any trigram is
searched in every text.

Postings are thin rows. Of the texts, those without any anchor (one trigram of each literal of the queries) have
no part in the join with the candidates, so they stay where they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as node, _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import Scratch, table


@dataclass(frozen=True)
class Rule:
    """``pattern`` means the same to Python and Java; ``group`` must have ``least`` characters, else the match is dropped.

    ``needs`` is a pattern that any text with a match that isn't dropped has a match of.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    needs: str = ""


#: The base kinds, in the order in which ties are listed.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, r"AKIA[A-Z0-9]{12}"),
    Rule("hex", r"[0-9a-f]+", 0, 32, r"[0-9a-f]{32}"),
)
#: Public forms of other credentials.
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE + ADDED
#: A set of alternative strings that grows beyond this is cut into two conditions.
_MOST_STRINGS = 64
#: Letters by how common they are, commonest first; anything else is rarer.
_COMMON = "etaoinshrdlucmfwygpbvkxqjz"

# A query is True, a trigram, ("and", queries) or ("or", queries).


def _both(kind: str, queries: list):
    """Conjunction or disjunction with what is decided taken out."""
    neutral = kind == "and"
    if any(q is (not neutral) for q in queries) or (not neutral and any(q is True for q in queries)):
        return not neutral
    left = list(dict.fromkeys(q for q in queries if q is not neutral))
    if kind == "or":  # an alternative that asks for more than another adds nothing
        parts = {q: set(q[1]) if q[0] == "and" else {q} for q in left}
        left = [q for q in left if not any(parts[p] < parts[q] for p in left)]
    return neutral if not left else left[0] if len(left) == 1 else (kind, tuple(left))


def _holds(strings: set[str]):
    """Some string of the set is there: the trigrams of one of them are."""
    return _both("or", [_both("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _exact(op, value) -> set[str] | None:
    """All strings that a node can match, in lower case, if they are few."""
    if op is node.LITERAL:
        return {chr(value).lower()}
    if op is node.IN:
        if all(o is node.LITERAL for o, _ in value) and len(value) <= 8:
            return {chr(v).lower() for _, v in value}
        return None
    if op is node.SUBPATTERN:
        return _exact_all(value[3])
    if op is node.BRANCH:
        found = [_exact_all(branch) for branch in value[1]]
        return None if None in found else set().union(*found)
    if op in (node.MAX_REPEAT, node.MIN_REPEAT):
        low, high, inner = value
        one = _exact_all(inner)
        if one is None or high > 8:
            return None
        out: set[str] = set()
        for times in range(low, int(high) + 1):
            found = {""}
            for _ in range(times):
                found = {a + b for a in found for b in one}
                if len(found) > _MOST_STRINGS:
                    return None
            out |= found
        return out
    return None


def _exact_all(nodes) -> set[str] | None:
    found = {""}
    for op, value in nodes:
        one = _exact(op, value)
        if one is None or len(found) * len(one) > _MOST_STRINGS:
            return None
        found = {a + b for a in found for b in one}
    return found


def _query(nodes):
    conditions, strings = [], {""}
    for op, value in nodes:
        one = _exact(op, value)
        if one is not None and len(strings) * len(one) <= _MOST_STRINGS:
            strings = {a + b for a in strings for b in one}
            continue
        conditions.append(_holds(strings))
        strings = one or {""}
        if one is None:
            if op is node.SUBPATTERN:
                conditions.append(_query(value[3]))
            elif op is node.BRANCH:
                conditions.append(_both("or", [_query(branch) for branch in value[1]]))
            elif op in (node.MAX_REPEAT, node.MIN_REPEAT) and value[0] > 0:
                conditions.append(_query(value[2]))
    return _both("and", [*conditions, _holds(strings)])


def trigram_query(pattern: str):
    """The Boolean trigram query that every text with a match satisfies; True if there is none."""
    return _query(parser.parse(pattern))


def trigrams_of(query) -> set[str]:
    if isinstance(query, bool):
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def anchors_of(query) -> set[str]:
    """Trigrams of which every text that satisfies the query holds one, rare ones by their letters."""
    rarity = lambda t: sum(_COMMON.find(c) if c in _COMMON else len(_COMMON) for c in t)
    if isinstance(query, str):
        return {query}
    found = [anchors_of(q) for q in query[1]]
    if query[0] == "or":
        return set().union(*found)
    return max(found, key=lambda s: (min(map(rarity, s)), sorted(s)))


def _satisfied(query, held: Column) -> Column:
    if isinstance(query, bool):
        return F.lit(query)
    if isinstance(query, str):
        return F.array_contains(held, query)
    parts = [_satisfied(q, held) for q in query[1]]
    out = parts[0]
    for part in parts[1:]:
        out = out & part if query[0] == "and" else out | part
    return out


_SPANS = "array<struct<start:int,place:int,end:int>>"
_STATE = f"struct<at:int,out:{_SPANS}>"
_PARTS = f"struct<at:int,out:array<{_SPANS}>>"
#: Matches of a text that are placed at a time.
_PART = 256


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """(start, place of the kind, end) in code points, leftmost matches first.

    What lies between matches, and the matches, in turn, give the places. Texts that a
    cheaper look shows to have no match long enough skip this.
    """
    literal = F.lit(rule.pattern)
    matches, groups = F.regexp_extract_all(text, literal, F.lit(0)), F.regexp_extract_all(text, literal, F.lit(rule.group))
    steps = F.transform(
        F.arrays_zip(F.split(text, rule.pattern, -1).alias("b"), matches.alias("m"), groups.alias("g")),
        lambda x: F.struct(
            F.char_length(x["b"]).alias("skip"),
            F.coalesce(F.char_length(x["m"]), F.lit(0)).alias("n"),
            F.coalesce(F.char_length(x["g"]) >= rule.least, F.lit(False)).alias("good"),
        ),
    )

    def step(seen, x):
        begin = seen["at"] + x["skip"]
        end = begin + x["n"]
        span = F.struct(begin.alias("start"), F.lit(place).alias("place"), end.alias("end"))
        out = F.when(x["good"], F.concat(seen["out"], F.array(span))).otherwise(seen["out"])
        return F.struct(end.alias("at"), out.cast(_SPANS).alias("out")).cast(_STATE)

    def part(seen, some):
        """A stretch of matches at a time: growing one array by each match would cost the square of their number."""
        begin = F.struct(seen["at"].alias("at"), F.array().cast(_SPANS).alias("out")).cast(_STATE)
        done = F.array(F.aggregate(some, begin, step))
        both = F.transform(done, lambda d: F.struct(d["at"].alias("at"), F.concat(seen["out"], F.array(d["out"])).alias("out")).cast(_PARTS))
        return both[0]

    def parts(steps):
        last = F.floor((F.size(steps) - 1) / _PART).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(steps, i * _PART + 1, F.lit(_PART)))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("out")).cast(_PARTS)
    stretches = F.transform(F.array(steps), parts)[0]
    found = F.aggregate(stretches, start, part, lambda s: F.flatten(s["out"]))
    return F.when(text.rlike(rule.needs or rule.pattern), found).otherwise(F.array().cast(_SPANS))


def _all_spans(text: Column, rules: list[tuple[int, Rule]], wanted: Column | None = None) -> Column:
    """Spans of several rules in order; with ``wanted``, of those whose places it holds."""
    parts = []
    for place, rule in rules:
        found = _spans(text, rule, place)
        parts.append(found if wanted is None else F.when(F.array_contains(wanted, place), found).otherwise(F.array().cast(_SPANS)))
    return F.array_sort(F.concat(*parts)).cast(_SPANS) if parts else F.array().cast(_SPANS)


def _held(text: Column, trigrams: list[str]) -> Column:
    """Those of the trigrams that the text holds; it is put into lower case once."""
    every = F.array(*map(F.lit, trigrams))
    return F.flatten(F.transform(F.array(F.lower(text)), lambda small: F.filter(every, lambda t: F.contains(small, t))))


def postings(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The inverted index of the rules' trigrams: ``trigram`` and the key (doc_id, text_key) of each text with it."""
    wanted = sorted(set().union(*(trigrams_of(trigram_query(r.pattern)) for r in rules)))
    held = _held(F.col("text"), wanted)
    return texts.select("doc_id", "text_key", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Keys with the places of the rules whose trigram query their postings satisfy."""
    held = index.groupBy("doc_id", "text_key").agg(F.collect_set("trigram").alias("held"))
    places = []
    for place, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        if query is not True:
            places.append(F.when(_satisfied(query, F.col("held")), F.lit(place)))
    found = held.select("doc_id", "text_key", F.array_compact(F.array(*places)).alias("places"))
    return found.filter(F.size("places") > 0)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def candidate_spans(docs: DataFrame, scratch: Scratch, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, text_key, spans) of the texts in which rules with a trigram query match."""
    texts = _keyed(docs)
    queries = {place: trigram_query(rule.pattern) for place, rule in enumerate(rules)}
    indexed = [(p, r) for p, r in enumerate(rules) if queries[p] is not True]
    found = scratch.keep(candidates(postings(texts, rules), rules), "candidates")
    anchors = sorted(set().union(*(anchors_of(queries[p]) for p, _ in indexed)))
    met = texts.filter(F.size(_held(F.col("text"), anchors)) > 0).join(found, _same(texts, found)).select(texts["doc_id"], texts["text_key"], "text", "places")
    spans = met.select("doc_id", "text_key", _all_spans(F.col("text"), indexed, F.col("places")).alias("spans"))
    return scratch.keep(spans.filter(F.size("spans") > 0).dropDuplicates(["doc_id", "text_key"]), "verified")


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, text_key and ``spans`` (start, place of the rule, end; sorted) of every row of ``docs``.

    Null and empty texts have no spans. Repeated rows each get theirs, null ids stay, other columns
    don't matter, an empty table gives an empty result. A document's spans are one array.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    verified = candidate_spans(docs, scratch, rules).withColumnRenamed("spans", "verified")
    scanned = [(p, r) for p, r in enumerate(rules) if trigram_query(r.pattern) is True]
    rows = _keyed(docs)
    rows = rows.select("doc_id", "text_key", _all_spans(F.col("text"), scanned).alias("scanned"))
    spans = F.array_sort(F.concat("scanned", F.coalesce("verified", F.array().cast(_SPANS))))
    joined = rows.join(verified, _same(rows, verified), "left")
    return joined.select(rows["doc_id"], rows["text_key"], spans.alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``mark`` in the place of every run of overlapping spans; ``n_chars``, if there, counts anew.

    Only documents with a span change. All columns stay, nulls too.
    """
    found = find_secrets(docs, rules).filter(F.size("spans") > 0).dropDuplicates(["doc_id", "text_key"])
    found = Scratch(docs.sparkSession, "redact").keep(found, "spans")
    found = found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("spans").alias("__spans"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__key"))
    state = "struct<at:int,out:string>"

    def step(seen, x):
        kept = F.when(x["start"] >= seen["at"], F.concat(F.substring(F.col("text"), seen["at"] + 1, x["start"] - seen["at"]), F.lit(mark)))
        return F.struct(F.greatest(seen["at"], x["end"]).alias("at"), F.concat(seen["out"], F.coalesce(kept, F.lit(""))).alias("out")).cast(state)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast(state)
    rest = lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.char_length("text")))
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.aggregate("__spans", start, step, rest))
    out = docs.join(found, same, "left").withColumn("text", text).drop("__id", "__key", "__spans")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def _listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["place"] + 1), s["start"], s["end"])), ",")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = find_secrets(table(spark, sf_dir, "documents"))

    def count(place: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["place"] == place)).cast("long")

    counts = [count(place).alias(f"n_{rule.kind}") for place, rule in enumerate(BASE)]
    base = F.filter("spans", lambda s: s["place"] < len(BASE))
    return spans.select("doc_id", *counts, F.sha2(_listed(base, RULES), 256).alias("base_sha256"), _listed(F.col("spans"), RULES).alias("spans"))
