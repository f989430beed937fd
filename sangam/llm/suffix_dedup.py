"""Exact substring deduplication by suffix arrays over shards.

Removed is every byte of a string of ``LENGTH`` bytes that starts at another place, too. Suffix arrays of
a whole corpus can't be built in one place, so strings that may be equal are brought together first.

Each window of LENGTH bytes has an anchor, the leftmost of its ANCHOR-byte strings with the smallest
hash; equal windows have equal anchors at the same place. A run of windows with one anchor, and with the
anchor in one of ``2 ** DEPTH`` ranges of places, is a context. All its windows hold the bytes round the anchor that
such places make sure of; their hash is the context's key, so windows can be equal under one key only.

Keys are counted first, and contexts whose key occurs once end there. The others are thin rows (key, hash of the context,
place). Contexts that are equal as a whole are duplicates as a whole, however many there are, and one of them stands for
all. Where one key has different contexts, these are fetched, and a shard takes whole keys up to
``SHARD_BYTES``: induced sorting gives its suffix array, permuted common prefixes of LENGTH or more the duplicates.
A key with too many different contexts for a shard is split by halving its range of places, until the anchor's place
in the window is fixed and the whole window is the key.

Texts without any repeated key are never shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import Scratch, arrow_rows, find_package, may_hold, membership, table
from .shingles import mix
from .suffix_array import common_prefixes, suffix_array

LENGTH, ANCHOR = 400, 32
#: Bytes of different contexts that one suffix array takes; more of one anchor are split.
SHARD_BYTES = 1 << 19
#: Shards that a task sorts, one after another, but for chance.
SHARDS_PER_TASK = 4
#: Ranges of places that contexts are dealt into from the start: so many halvings.
DEPTH = 2
#: Windows of a text that are looked at together.
_BLOCK = 1 << 18
_PLACE_BITS = 20
_FACTOR = 0x9E3779B97F4A7C15


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_FACTOR, _BLOCK + LENGTH + 1)
_DOWN = _powers(pow(_FACTOR, -1, 1 << 64), _BLOCK + LENGTH + 1)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR))


def _anchors(block: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window the place of its anchor, and the running sums that hashes of the block's strings are made from."""
    n = len(block)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTES[block] * _UP[:n], out=sums[1:])
    hashes = mix((sums[anchor:] - sums[:-anchor]) * _DOWN[: n - anchor + 1])
    width = length - anchor + 1
    # smallest hash first, then leftmost place, in one number
    ranked = (hashes & ~np.uint64((1 << _PLACE_BITS) - 1)) | np.arange(len(hashes), dtype=np.uint64)
    rows = -(-len(ranked) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(ranked)] = ranked
    padded = padded.reshape(rows, width)
    to_right = np.minimum.accumulate(padded, axis=1).reshape(-1)
    to_left = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = n - length + 1
    smallest = np.minimum(to_left[:windows], to_right[width - 1 : width - 1 + windows])
    return (smallest & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64), sums


def _ranges(width: int, depth: int) -> list[tuple[int, int]]:
    """The places 0 .. width - 1 halved ``depth`` times."""
    found = [(0, width - 1)]
    for _ in range(depth):
        halves = []
        for least, most in found:
            middle = (least + most + 1) // 2
            halves += [(least, middle - 1), (middle, most)] if middle > least else [(least, most)]
        found = halves
    return found


def _key(before: int, least: int, most: int, sure: bytes) -> int:
    return xxhash.xxh3_64_intdigest(b"%d:%d:%d:" % (before, least, most) + sure) - (1 << 63)


def _contexts(data: bytes, length: int = LENGTH, anchor: int = ANCHOR, depth: int = DEPTH) -> np.ndarray:
    """Contexts as columns: key, first byte, end, place of the anchor in the context, least and most place in a window.

    Equal bytes round an anchor have equal keys; unequal ones hardly ever do, and what a key brings together is compared.
    """
    whole = np.frombuffer(data, dtype=np.uint8)
    least, most = np.array(_ranges(length - anchor + 1, depth), dtype=np.int64).T
    salt = mix(np.uint64(_FACTOR) * (least * length + most + 1).astype(np.uint64))
    found = [np.empty((6, 0), dtype=np.int64)]
    for at in range(0, len(data) - length + 1, _BLOCK):
        places, sums = _anchors(whole[at : at + _BLOCK + length - 1], length, anchor)
        starts = np.concatenate([[0], np.flatnonzero(places[1:] != places[:-1]) + 1])
        lasts, middle = np.append(starts[1:], len(places))[:, None] - 1, places[starts][:, None]
        # a window that starts at s has the anchor at place middle - s
        first, final = np.maximum(starts[:, None], middle - most), np.minimum(lasts, middle - least)
        line, which = np.nonzero(first <= final)
        first, final, middle = first[line, which], final[line, which], middle[line, 0]
        low, high = middle - least[which], middle + length - most[which]
        keys = mix((sums[high] - sums[low]) * _DOWN[low] + salt[which])
        found.append(np.stack([keys.view(np.int64), first + at, final + at + length, middle - first, least[which], most[which]]))
    return np.concatenate(found, axis=1)


def contexts_of(data: bytes, length: int = LENGTH, anchor: int = ANCHOR, depth: int = DEPTH):
    """(key, first byte, end, place of the anchor in the context, least and most place in a window) of each context."""
    return zip(*_contexts(data, length, anchor, depth).tolist())


def _halves(content: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(content)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _found(content: DataFrame, length: int, shard: int) -> DataFrame:
    """(key, high, low, from, to): bytes of contexts (key, high, low, content), sorted by key, that others have, too."""
    schema = "key long, high long, low long, start long, end long"

    def searched(incoming):
        group, size, last = [], 0, None
        for batch in incoming:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= shard and row[0] != last:
                    yield pa.RecordBatch.from_pydict(_duplicates(group, length))
                    group, size = [], 0
                group.append(row)
                size, last = size + len(row[3]), row[0]
        if group:
            yield pa.RecordBatch.from_pydict(_duplicates(group, length))

    return content.mapInArrow(searched, schema)


def _duplicates(group: list[tuple], length: int) -> dict:
    """Covered stretches of the contexts (key, high, low, content) of one shard, by its suffix array."""
    sizes = np.array([len(row[3]) for row in group])
    n = int(sizes.sum()) + len(group)
    # a separator of its own ends each context; 0 ends the text
    ends = np.cumsum(sizes + 1) - 1
    text = np.zeros(n + 1, dtype=np.int64)
    inside = np.ones(n, dtype=bool)
    inside[ends] = False
    text[:n][inside] = np.frombuffer(b"".join(row[3] for row in group), dtype=np.uint8)
    text[:n][inside] += 1
    text[ends] = 257 + np.arange(len(group))
    left = np.append(np.repeat(ends, sizes + 1) - np.arange(n), 0)
    previous, common = common_prefixes(text, suffix_array(text), left)
    long_ = np.flatnonzero(common >= length)
    starts = np.unique(np.concatenate([long_, previous[long_]]))
    owner = np.searchsorted(ends, starts)
    # stretches go on while the next start lies within, or right after, the last string
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (starts[1:] > starts[:-1] + length)
    first = np.flatnonzero(new)
    final = np.append(first[1:], len(starts)) - 1 if len(first) else first
    base = np.append(0, ends[:-1] + 1)[owner]
    which = owner[first] if len(first) else first
    ids = [np.array([row[i] for row in group], dtype=np.int64)[which] for i in range(3)]
    columns = [*ids, (starts - base)[first], (starts - base)[final] + length if len(first) else first]
    return dict(zip(("key", "high", "low", "start", "end"), (pa.array(c, pa.int64()) for c in columns)))


def _split(crowded: DataFrame, length: int, anchor: int, level: int) -> DataFrame:
    """Parts of contexts, dealt by the bytes left of the anchor or right of it.

    At ``level`` n the places of the anchor in its window are known to within width / 2^n; the upper half
    of them makes sure of further bytes to the left, the lower half to the right.
    """
    fields = "key long, high long, low long, n long, place long, least long, most long, content binary, owner_key long, owner_high long, owner_low long, shift long"
    names = [x.split()[0] for x in fields.split(", ")]

    def parts(batch):
        out = {n: [] for n in names}
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            key, high, low, n, place, least, most, content = row
            middle = (least + most + 1) // 2
            # windows start at 0 .. len - length; a window that starts at s has the anchor at place - s
            for lower, upper in ((least, middle - 1), (middle, most)):
                first, last = max(0, place - upper), min(len(content) - length, place - lower)
                if first > last:
                    continue
                part = content[first : last + length]
                at = place - first
                sure = part[at - lower : at + length - upper]
                hashed = _key(key, lower, upper, sure)
                for name, value in zip(names, (hashed, *_halves(part), n, at, lower, upper, part, key, high, low, first)):
                    out[name].append(value)
        return out

    return arrow_rows(crowded.select(*names[:8]), parts, fields)


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def _known(docs: DataFrame, rows: DataFrame, known: bool) -> DataFrame:
    """Those of ``docs`` whose text_key may be among those of ``rows``, or those whose text_key can't; nothing is shuffled."""
    keys = membership(rows.select("text_key"))

    def chosen(incoming):
        for batch in incoming:
            held = may_hold(keys.value, batch.column(1).to_numpy())
            yield batch.filter(pa.array(held if known else ~held))

    return docs.mapInArrow(chosen, docs.schema)


def _spans(members: DataFrame, docs: DataFrame, scratch: Scratch, length: int, anchor: int, shard: int) -> DataFrame:
    """(key, high, low, start, end) of the covered stretches of contexts.

    ``members`` has every context with its place; ``docs`` (doc_id, text_key, data) the texts.
    """
    place = F.struct("doc_id", "text_key", "first", "end", "place", "least", "most")
    contexts = members.groupBy("key", "high", "low").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("at"))
    contexts = scratch.keep(contexts, "contexts")
    shared = contexts.groupBy("key").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds")).filter("all > 1")
    shared = scratch.keep(shared, "shared")
    met = scratch.keep(contexts.join(shared, "key").withColumn("length", F.expr("at.end - at.first")), "met")
    scratch.drop("contexts")
    spans = [met.filter("n > 1").select("key", "high", "low", F.lit(0).cast("long").alias("start"), F.col("length").cast("long").alias("end"))]
    # one context stands for all that are equal; its text is cut out of one document
    wanted = met.filter("kinds > 1")
    cuts = F.struct("key", "high", "low", "n", "at.first", "at.end", "at.place", "at.least", "at.most")
    places = wanted.groupBy("at.doc_id", "at.text_key").agg(F.collect_list(cuts).alias("cuts"))
    places = scratch.keep(places, "places")

    def cut(batch):
        out = {n: [] for n in ("key", "high", "low", "n", "place", "least", "most", "content")}
        for data, cuts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for c in cuts:
                row = (c["key"], c["high"], c["low"], c["n"], c["place"], c["least"], c["most"], data[c["first"] : c["end"]])
                for name, value in zip(out, row):
                    out[name].append(value)
        return out

    useful = _known(docs, places, True)
    once = useful.join(places, _same(useful, places)).select(useful["doc_id"], useful["text_key"], "data", "cuts").dropDuplicates(["doc_id", "text_key"])
    fields = "key long, high long, low long, n long, place long, least long, most long, content binary"
    level, parts, owners = 0, scratch.keep(arrow_rows(once.select("data", "cuts"), cut, fields), "parts-0"), []
    by_level = []
    while True:
        sizes = parts.groupBy("key").agg(F.sum(F.length("content")).alias("bytes"))
        crowded = scratch.keep(sizes.filter(F.col("bytes") > shard).select("key"), f"crowded-{level}")
        fitting = parts.join(crowded, "key", "left_anti").select("key", "high", "low", "content")
        # sorting suffixes costs time by the byte, far more than reading them, so bytes set the number of tasks
        total = sizes.agg(F.sum("bytes")).first()[0] or 0
        tasks = max(1, -(-total // (SHARDS_PER_TASK * shard)))
        found = _found(fitting.repartition(tasks, "key").sortWithinPartitions("key"), length, shard)
        by_level.append(scratch.keep(found, f"found-{level}"))
        if crowded.isEmpty():
            break
        split = _split(parts.join(crowded, "key"), length, anchor, level)
        # equal parts of different contexts are duplicates as a whole; one stands for all
        owned = scratch.keep(split, f"owned-{level + 1}")
        owners.append(owned.select("key", "high", "low", "owner_key", "owner_high", "owner_low", "shift"))
        kinds = owned.groupBy("key", "high", "low").agg(
            F.sum("n").alias("n"), *(F.first(c).alias(c) for c in ("place", "least", "most", "content"))
        )
        kinds = scratch.keep(kinds, f"kinds-{level + 1}")
        whole = kinds.filter("n > 1").select("key", "high", "low", F.lit(0).cast("long").alias("start"), F.length("content").cast("long").alias("end"))
        by_level.append(whole)
        several = scratch.keep(kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("key"), f"several-{level + 1}")
        parts = scratch.keep(kinds.join(several, "key"), f"parts-{level + 1}")
        level += 1
    # from parts back to the contexts they were cut from
    below = by_level[-1]
    for at in range(len(owners) - 1, -1, -1):
        whole = by_level[2 * at + 1]
        up = below.unionByName(whole).join(owners[at], ["key", "high", "low"])
        up = up.select(
            F.col("owner_key").alias("key"), F.col("owner_high").alias("high"), F.col("owner_low").alias("low"),
            (F.col("start") + F.col("shift")).alias("start"), (F.col("end") + F.col("shift")).alias("end"),
        )
        below = scratch.keep(up.distinct().unionByName(by_level[2 * at]), f"up-{at}")
    return spans[0].unionByName(below)


def _merged(spans: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def duplicate_spans(
    docs: DataFrame, scratch: Scratch, length: int = LENGTH, anchor: int = ANCHOR, shard: int = SHARD_BYTES
) -> DataFrame:
    """(doc_id, text_key, spans) of texts with bytes to remove; ``docs`` has doc_id, text_key and data.

    Spans (start, end) may overlap. Rows with equal id and text share a row.
    """

    def counted(batch):
        keys = [_contexts(data, length, anchor)[0] for data in batch.column(2).to_pylist()]
        found, n = np.unique(np.concatenate(keys), return_counts=True)
        return {"key": found, "n": n}

    repeated = arrow_rows(docs, counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")
    known = membership(scratch.keep(repeated.select("key"), "repeated"))

    def contexts(batch):
        out = {n: [] for n in ("key", "high", "low", "doc_id", "text_key", "first", "end", "place", "least", "most")}
        for doc, text_key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            found = _contexts(data, length, anchor)
            found = found[:, may_hold(known.value, found[0])]
            for key, first, end, *rest in found.T.tolist():
                for name, value in zip(out, (key, *_halves(data[first:end]), doc, text_key, first, end, *rest)):
                    out[name].append(value)
        return out if out["key"] else None

    fields = "key long, high long, low long, doc_id long, text_key long, first int, end int, place int, least int, most int"
    members = scratch.keep(arrow_rows(docs, contexts, fields), "members")
    spans = scratch.keep(_spans(members, docs, scratch, length, anchor, shard), "spans")
    placed = members.join(spans.withColumnRenamed("end", "to"), ["key", "high", "low"])
    placed = placed.select("doc_id", "text_key", (F.col("first") + F.col("start")).alias("start"), (F.col("first") + F.col("to")).alias("end"))
    placed = placed.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    placed = scratch.keep(placed, "placed")
    scratch.drop("members", "met", "shared", "places", "repeated", "parts-0", "spans")
    return placed


def _keyed(docs: DataFrame) -> DataFrame:
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(data).alias("text_key"), data.alias("data"))


def remove_duplicates(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, shard: int = SHARD_BYTES
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs`` (doc_id, text).

    Null texts are empty; texts shorter than ``length`` bytes keep all. Repeated rows are texts like others, so long
    ones lose all their bytes. Null ids stay; other columns don't matter; an empty table gives an empty
    result. ``length`` must be at least ``anchor``.
    """
    find_package(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "substrings")
    keyed = _keyed(docs)
    spans = duplicate_spans(keyed, scratch, length, anchor, shard)
    touched, others = _known(keyed, spans, True), _known(keyed, spans, False)
    rows = touched.join(spans, _same(touched, spans), "left").select(touched["doc_id"], "data", "spans")
    rows = rows.unionByName(others.select("doc_id", "data", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")))

    def kept(batch):
        out = {n: [] for n in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
        for doc, data, found in zip(*(c.to_pylist() for c in batch.columns)):
            merged, digest, at, removed = _merged(found or []), hashlib.sha256(), 0, 0
            for start, end in merged:
                digest.update(data[at:start])
                at, removed = end, removed + end - start
            digest.update(data[at:])
            for name, value in zip(out, (doc, len(data), removed, len(merged), digest.hexdigest())):
                out[name].append(value)
        return out

    return arrow_rows(rows, kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("repeats", F.col("n_removed") > 0)
