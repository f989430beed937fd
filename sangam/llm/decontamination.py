"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks.

A benchmark item of n words is compared with every window of n words, and with the whole of a text that is shorter but has
shingles enough to be similar. Items and windows are bags of
word shingles; a bag's fingerprint has, bit by bit, the sign of the sum of its shingles' hash bits. Two bags
with a weighted similarity of 0.8 differ in about 10 of 64 bits, and in more than ``RADIUS``
once in 10^4 times. Fingerprints are cut into ``BLOCKS`` blocks; within the radius at least one block
differs in at most ``RADIUS div BLOCKS`` bits, so looking up each block with that many bits
changed, among the blocks of the items with as many words, finds every one of them within the radius. The weighted similarity of the
bags themselves, sum of the smaller counts over sum of the larger ones, then decides.

Most windows need no fingerprint: a window can only be similar enough if enough of its shingles occur
in the benchmark at all, which running sums of one membership test per word show.

The benchmark is read into tasks in blocks of at most ``ITEM_BLOCK`` items and ``ITEM_BYTES``, one pass over the
documents for each block, so what a task holds doesn't grow with the benchmark. Documents aren't shuffled.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import arrow_rows, find_package, give_back, small_slices, table
from .shingles import lower_words, shingle_hashes, word_hashes

BITS, RADIUS, BLOCKS = 64, 20, 8
#: Items, and bytes of their texts, that tasks hold at a time.
ITEM_BLOCK, ITEM_BYTES = 20_000, 16 << 20
#: Windows that are fingerprinted at a time.
_WINDOWS = 2048
_WIDTH = BITS // BLOCKS


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    """One 64-bit fingerprint per row of shingle hashes."""
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(*hashes.shape, 8), axis=-1)
    ones = bits.reshape(*hashes.shape, BITS).sum(axis=1, dtype=np.int64)
    return np.packbits(2 * ones > hashes.shape[1], axis=-1).view(np.uint64).reshape(-1)


def _near_values() -> list[np.ndarray]:
    """For each value of a block, the values within RADIUS div BLOCKS bits."""
    every = np.arange(1 << _WIDTH)
    apart = np.array([bin(x).count("1") for x in every])
    return [every[apart[every ^ value] <= RADIUS // BLOCKS] for value in every]


def similarity(left: Counter, right: Counter) -> float:
    """Sum of smaller over sum of larger counts."""
    common = sum((left & right).values())
    return common / (sum(left.values()) + sum(right.values()) - common)


@dataclass
class Items:
    """A block of the benchmark, indexed by the number of words and the values of fingerprint blocks."""

    ids: list[int]
    bags: list[Counter]
    words: dict[bytes, int]  # hashes of all their words
    known: np.ndarray  # sorted shingle hashes of all items
    maybe: np.ndarray  # whether a shingle may be among them, by its low bits
    by_words: dict[int, np.ndarray]  # places of the items with so many words
    prints: np.ndarray
    index: dict[int, list[dict[int, np.ndarray]]]  # by number of words, block of the fingerprint and value: places

    def known_shingles(self, hashes: np.ndarray) -> np.ndarray:
        """Which shingles occur in some item."""
        hits = self.maybe[(hashes & np.uint64(len(self.maybe) - 1)).astype(np.int64)]
        some = np.flatnonzero(hits)
        at = np.minimum(np.searchsorted(self.known, hashes[some]), len(self.known) - 1)
        hits[some] = self.known[at] == hashes[some]
        return hits

    @staticmethod
    def of(rows: list[tuple[int, str]], size: int) -> Items:
        ids, bags, prints, lengths, spelled = [], [], [], [], {}
        for item, text in rows:
            plain = lower_words(text)
            words = word_hashes(plain)
            spelled.update(zip(plain, words.tolist()))
            if len(words):
                hashes = shingle_hashes(words, size)
                ids.append(item)
                bags.append(Counter(hashes.tolist()))
                prints.append(fingerprints(hashes[None, :])[0])
                lengths.append(len(words))
        near, blocks = _near_values(), np.array(prints, dtype=np.uint64).view(np.uint8).reshape(-1, BLOCKS)
        by_words = {n: np.flatnonzero(np.array(lengths) == n) for n in sorted(set(lengths))}
        index: dict[int, list[dict[int, np.ndarray]]] = {}
        for n, some in by_words.items():
            index[n] = []
            for block in range(BLOCKS):
                places: dict[int, list[int]] = {}
                for place in some.tolist():
                    for other in near[blocks[place, block]].tolist():
                        places.setdefault(other, []).append(place)
                index[n].append({v: np.array(p) for v, p in places.items()})
        known = np.unique(np.array([h for bag in bags for h in bag], dtype=np.uint64))
        maybe = np.zeros(1 << max(16, (8 * len(known)).bit_length()), dtype=bool)
        maybe[(known & np.uint64(len(maybe) - 1)).astype(np.int64)] = True
        return Items(ids, bags, spelled, known, maybe, by_words, np.array(prints, dtype=np.uint64), index)

    def within(self, n: int, print_: np.uint64) -> np.ndarray:
        """Places of all items of n words whose fingerprints differ in RADIUS bits at most."""
        values = np.array([print_]).view(np.uint8).tolist()
        met = [places[v] for places, v in zip(self.index[n], values) if v in places]
        if not met:
            return np.empty(0, dtype=np.int64)
        places = np.unique(np.concatenate(met))
        return places[np.bitwise_count(self.prints[places] ^ print_) <= RADIUS]


def _windows(items: Items, hits: np.ndarray, size: int, percent: int):
    """(words of the item, first shingles, number of shingles) of windows with enough known shingles.

    Of a text with fewer shingles than an item the whole is the window.
    """
    sums = np.concatenate([[0], np.cumsum(hits)])
    for n in items.by_words:
        shingles = max(1, n - size + 1)
        if shingles > len(hits):
            # even if the item holds all of a text, their similarity is no more than the share of its shingles
            if 100 * len(hits) < percent * shingles:
                break
            if (100 + percent) * sums[-1] >= percent * (shingles + len(hits)):
                yield n, np.zeros(1, dtype=np.int64), len(hits)
            continue
        # of two bags of m, common / (2 m - common) >= p / 100 needs common >= 2 p m / (100 + p)
        needed = -(-2 * percent * shingles // (100 + percent))
        yield n, np.flatnonzero(sums[shingles:] - sums[:-shingles] >= needed), shingles


def matches(text: str | None, items: Items, size: int = 5, percent: int = 80) -> dict[int, tuple[float, int, int]]:
    """Best window per item place: similarity, first word, number of words; the first of equal ones.

    A text with fewer words than an item is compared with it as a whole.
    """
    found: dict[int, tuple[float, int, int]] = {}
    plain = lower_words(text)
    if not plain or not items.ids:
        return found
    # words that no item has need no hash to tell which shingles occur in the benchmark
    words = np.array(list(map(items.words.get, plain, repeat(0))), dtype=np.uint64)
    if np.count_nonzero(words) * 100 < percent * min(min(items.by_words), len(words)):
        return found  # not even the shortest item has words enough in common
    whole = None
    for run in sorted({min(n, size) for n in items.by_words if n < size or len(words) >= size}):
        if run > len(words):
            continue
        hits = items.known_shingles(shingle_hashes(words, run))
        if not hits.any():
            continue
        for n, starts, shingles in _windows(items, hits, size, percent):
            if min(n, size) != run or not len(starts):
                continue
            if whole is None:
                whole = word_hashes(plain)
            hashes = shingle_hashes(whole, run)
            for cut in range(0, len(starts), _WINDOWS):
                some = starts[cut : cut + _WINDOWS]
                windows = hashes[some[:, None] + np.arange(shingles)]
                for start, print_, window in zip(some.tolist(), fingerprints(windows), windows):
                    places = items.within(n, print_).tolist()
                    if places:
                        bag = Counter(window.tolist())
                        for place in places:
                            value = similarity(items.bags[place], bag)
                            if 100 * value >= percent and value > found.get(place, (0.0,))[0]:
                                found[place] = (value, start, min(n, len(words)))
    return found


def _item_blocks(benchmark: DataFrame, size: int):
    """Broadcast blocks of the benchmark; a hash deals items out, so blocks keep their bound but for chance."""
    item = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).filter("text is not null")
    sizes = item.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(-(-sizes["n"] // ITEM_BLOCK), -(-(sizes["bytes"] or 0) // ITEM_BYTES))
    dealt = item.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks))))
    for block in range(blocks):
        rows = [(r.item_id, r.text) for r in dealt.filter(F.col("block") == block).orderBy("item_id", "text").collect()]
        yield benchmark.sparkSession.sparkContext.broadcast(Items.of(rows, size))


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: the best window of each document for each item it holds.

    Both sides are read in lower case (A-Z). Null and empty texts and items hold nothing and are held nowhere; items of fewer
    than ``size`` words are one shingle. Of repeated items each counts; repeated rows of ``docs`` give
    repeated rows; null ids stay. Other columns don't matter; empty tables give an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    schema = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    names = [x.split()[0] for x in schema.split(", ")]
    out = docs.sparkSession.createDataFrame([], schema)
    for items in _item_blocks(benchmark, size):

        def searched(batch, items=items):
            columns = {n: [] for n in names}
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for place, best in sorted(matches(text, items.value, size, percent).items()):
                    for name, value in zip(names, (doc, items.value.ids[place], *best)):
                        columns[name].append(value)
            return columns if columns["doc_id"] else None

        out = out.unionByName(arrow_rows(docs, searched, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` that hold no item of the benchmark; columns stay, nulls too. No shuffle.

    Rows are judged each for itself, so repeated and null ids need no care.
    """
    find_package(docs.sparkSession)
    at = docs.columns.index("text")
    for items in _item_blocks(benchmark, size):

        def kept(incoming, items=items):
            import pyarrow as pa

            for batch in (part for whole in incoming for part in small_slices(whole)):
                good = [not matches(t, items.value, size, percent) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(good, pa.bool_()))
            give_back()

        docs = docs.mapInArrow(kept, docs.schema)
    return docs


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
