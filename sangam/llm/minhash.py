"""Near-duplicates by MinHash: banding finds candidates, signatures and full sets confirm, stars join.

Texts with equal shingle sets are one node, named by the smallest doc_id, before anything else. Each
node has ``HASHES`` minima of multiply-shift hashes; nodes that agree on a band of ``ROWS`` minima
share a bucket. Two sets with a similarity of 0.8 share no bucket once in 2 * 10^7 times. In a
bucket of up to ``ALL_PAIRS`` nodes all pairs are candidates. A node of larger ones meets the hub of the largest
it is in: the node that shares most such buckets, counted with their sizes; of
variants of one text, the one that was changed least. Larger buckets whose nodes aren't all joined by then belong to the crowd of the component
that most of their nodes are in. Members of a crowd that aren't in its largest component then meet every member that isn't in their own component, joined ones
too, in blocks of about ``TILE`` shingles that are compared in one task each, signatures first and then full sets. So
two nodes of a bucket are compared or joined already, however large it is; twice only if they are in two crowds.

Candidates pass if their signatures agree well enough, five standard deviations below the
threshold, and then if their full sets, computed from whole texts, are similar enough. A node's
smallest partner is confirmed first; other pairs only if their ends aren't joined by then,
as the rest can't change a component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Scratch, arrow_rows, may_hold, membership, table
from .components import components, joined_components, links_of_documents
from .shingles import common_count, digest_of, mix, shingle_set, with_texts

HASHES, ROWS = 128, 4
#: Buckets of up to so many nodes give all their pairs.
ALL_PAIRS = 16
#: Shingles on each side of a block of a crowd, but for chance.
TILE = 1 << 20


def _universal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of n multiply-shift hashes, from a fixed seed."""
    random = np.random.Generator(np.random.PCG64(7))
    draw = random.integers(0, 1 << 63, size=(2, n), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


_FACTORS, _SUMMANDS = _universal(HASHES)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each hash over a set that isn't empty."""
    out = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        hashed = shingles[at : at + 4096, None] * _FACTORS + _SUMMANDS
        np.minimum(out, hashed.min(axis=0), out=out)
    return out >> np.uint64(32)


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One hash for the minima of each band and the band's number."""
    bands = minima.reshape(-1, ROWS)
    factors = np.array([pow(0x9E3779B97F4A7C15, r + 1, 1 << 64) for r in range(ROWS)], dtype=np.uint64)
    return mix((bands * factors).sum(axis=1, dtype=np.uint64) + np.arange(1, len(bands) + 1, dtype=np.uint64)).view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, keys of its bands and a byte of each minimum (null for empty sets)."""

    def signed(batch):
        columns = {"doc_id": batch.column(0), "n_shingles": [], "digest": [], "bands": [], "minima": []}
        for text in batch.column(1).to_pylist():
            found = shingle_set(text, size)
            minima = signature(found) if len(found) else None
            columns["n_shingles"].append(len(found))
            columns["digest"].append(digest_of(found))
            columns["bands"].append(None if minima is None else band_keys(minima))
            columns["minima"].append(None if minima is None else minima.astype(np.uint8).view(np.int8))
        return columns

    return arrow_rows(docs, signed, "doc_id long, n_shingles long, digest binary, bands array<long>, minima array<tinyint>")


def _meetings(keyed: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a < b) of rows (node, keys), and the nodes (node, keys, score) of larger buckets with the keys of these.

    Keys are counted where they are; only those that may occur twice are then sent to meet.
    """
    single = keyed.select("node", F.explode("keys").alias("key"))
    buckets = single.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    buckets = scratch.keep(buckets.filter("n > 1"), "buckets")
    shared = membership(buckets.select("key"))

    def sent(batch):
        keys = batch.column(1)
        flat = keys.flatten().to_numpy()
        nodes = np.repeat(batch.column(0).to_numpy(), np.diff(keys.offsets.to_numpy()))
        good = may_hold(shared.value, flat)
        return {"node": nodes[good], "key": flat[good]}

    met = scratch.keep(arrow_rows(keyed.select("node", "keys"), sent, "node long, key long").join(buckets, "key"), "met")
    few = met.filter(F.col("n") <= ALL_PAIRS).select("key", "node")
    pairs = few.select("key", F.col("node").alias("a")).join(few.select("key", F.col("node").alias("b")), "key").filter("a < b")

    # a node's larger buckets stay with it: a list of one key per band at most
    largest = F.max(F.struct("n", "key"))["key"].alias("home")
    crowded = met.filter(F.col("n") > ALL_PAIRS).groupBy("node")
    crowded = scratch.keep(crowded.agg(largest, F.sum("n").alias("score"), F.collect_set("key").alias("keys")), "crowded")
    hub = F.max_by("node", F.struct("score", -F.col("node"))).alias("hub")
    hubs = crowded.select("node", "score", F.explode("keys").alias("home")).groupBy("home").agg(hub)
    hub_pairs = crowded.join(hubs, "home").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).filter("a < b")
    return pairs.select("a", "b").unionByName(hub_pairs).distinct(), crowded.select("node", "keys", "score")


def _crowds(crowded: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, crowd, label) of the nodes (node, keys, score) with a bucket whose nodes aren't all in one component; label is the component.

    A bucket belongs to the crowd of the component that most of its nodes are in, or the one with the best hub of these, which as a rule is
    the same in all buckets round a text. Nodes may be in several crowds. Buckets whose nodes are joined take no part.
    """
    label = F.coalesce("root", "node").alias("label")
    single = crowded.join(roots, "node", "left").select("node", "score", "keys", label)
    single = scratch.keep(single, "labelled").select("node", "label", "score", F.explode("keys").alias("key"))
    counts = single.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("score"))
    crowd = F.max_by("label", F.struct("n", "score", -F.col("label"))).alias("crowd")
    unsettled = counts.groupBy("key").agg(crowd, F.count(F.lit(1)).alias("labels")).filter("labels > 1").select("key", "crowd")
    return single.join(scratch.keep(unsettled, "unsettled"), "key").select("node", "crowd", "label").distinct()


def _least_equal(percent: int) -> int:
    """Minima that agree for sets this similar, less five standard deviations."""
    share = percent / 100
    return int(HASHES * share - 5 * (HASHES * share * (1 - share)) ** 0.5)


def _signed_alike(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose minima agree as often as those of sets this similar do, less five standard deviations.

    A byte of each minimum is compared: equal minima always agree, others once in 256 times.
    """
    least = _least_equal(percent)
    left = nodes.select(F.col("node").alias("a"), F.col("minima").alias("left"))
    right = nodes.select(F.col("node").alias("b"), F.col("minima").alias("right"))
    equal = F.aggregate(F.zip_with("left", "right", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return pairs.join(left, "a").join(right, "b").filter(equal >= least).select("a", "b").distinct()


def _sets(docs: DataFrame, pairs: DataFrame, size: int, scratch: Scratch, name: str) -> DataFrame:
    """(node, shingles) of the documents of ``pairs``, from their whole texts.

    Texts that a map of the wanted nodes shows to be of no use stay where they are. They are left out where the sets are made:
    a step of its own would take a second Python worker in each task, and executors keep all workers they ever had at a time.
    """
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    wanted = scratch.keep(ends.distinct(), f"{name}-wanted")
    named = membership(wanted)

    def found(batch):
        ids = batch.column(0)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        batch = batch.filter(pa.array(known & may_hold(named.value, ids.fill_null(0).to_numpy())))
        if not batch.num_rows:
            return None
        sets = [shingle_set(t, size) for t in batch.column(1).to_pylist()]
        return {"node": batch.column(0), "digest": [digest_of(s) for s in sets], "shingles": [s.view(np.int64) for s in sets]}

    sets = arrow_rows(docs.select("doc_id", "text"), found, "node long, digest binary, shingles array<long>")
    # a document with several texts has several sets
    return scratch.keep(sets.join(wanted, "node", "left_semi").dropDuplicates(["node", "digest"]), name)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    joined = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("left", "right"))
    # common / (left + right - common) >= percent / 100, in integers
    return joined.filter((100 + percent) * common >= percent * (F.size("left") + F.size("right"))).select("a", "b").distinct()


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends aren't in one component yet."""
    left = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    right = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    joined = pairs.join(left, "a", "left").join(right, "b", "left")
    return joined.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def block_links(sets: list[np.ndarray], minima: np.ndarray, labels: np.ndarray, asks: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Places of similar sets that join those of different labels; of a pair one asks. ``labels`` become those joined."""
    least, found = _least_equal(percent), []
    for at in np.flatnonzero(asks):
        others = np.flatnonzero(labels != labels[at])
        equal = (minima[others] == minima[at]).sum(axis=1, dtype=np.uint8)
        others, equal = others[equal >= least], equal[equal >= least]
        for other in others[np.argsort(equal, kind="stable")[::-1]]:
            if labels[other] != labels[at]:
                both = len(sets[at]) + len(sets[other])
                if (100 + percent) * common_count(sets[at], sets[other]) >= percent * both:
                    found.append((int(at), int(other)))
                    labels[labels == labels[other]] = labels[at]
    return found


def _crowd_links(crowded: DataFrame, nodes: DataFrame, roots: DataFrame, docs: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) of members of crowds that aren't in the crowd's largest component, with any member of another one."""
    members = scratch.keep(_crowds(crowded, roots, scratch).join(nodes.select("node", "digest", "n_shingles"), "node"), "crowd-members")
    counts = members.groupBy("crowd", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("n_shingles").alias("n"))
    largest = counts.groupBy("crowd").agg(
        F.max_by("label", F.struct("c", -F.col("label"))).alias("largest"),
        F.max_by("n", F.struct("c", -F.col("label"))).alias("joined"),
        F.sum("n").alias("n"),
    )
    open_ = F.col("n") - F.col("joined")
    largest = largest.filter(open_ > 0).select("crowd", "largest", F.ceil(F.col("n") / TILE).alias("parts"), F.ceil(open_ / TILE).alias("sets"))
    asking = members.join(scratch.keep(largest, "crowd-sizes"), "crowd").withColumn("asks", F.col("label") != F.col("largest"))
    asking = scratch.keep(asking.drop("largest", "n_shingles"), "crowd-asking")
    texts = scratch.keep(with_texts(asking, docs, size), "crowd-texts")

    def dealt(rows, asks, own, tiles, other, others):
        """Rows in their own block of one side, once for each block of the other."""
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1)).alias(other)
        place = F.pmod(F.xxhash64("digest"), tiles).alias(own)
        return rows.select("crowd", place, every, "node", "label", F.lit(asks).alias("asks"), "text").select(
            "crowd", "part", "set", "node", "label", "asks", "text"
        )

    def solve(block: pa.Table) -> pa.Table:
        sets = [shingle_set(text.as_py(), size) for text in block["text"]]
        minima = np.stack([signature(s).astype(np.uint8) for s in sets])
        node, labels, asks = (block[c].to_numpy().copy() for c in ("node", "label", "asks"))
        links = block_links(sets, minima, labels, asks, percent)
        a, b = (node[[link[side] for link in links]] if links else node[:0] for side in (0, 1))
        return pa.table({"a": a, "b": b})

    both = dealt(texts.filter("asks"), True, "set", "sets", "part", "parts")
    both = both.unionByName(dealt(texts, False, "part", "parts", "set", "sets"))
    return both.groupBy("crowd", "part", "set").applyInArrow(solve, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    Documents with ``100 * intersection >= percent * union`` of their ``size``-word shingle sets
    are linked; component_id is the smallest doc_id reachable. Null and empty texts and texts without words have
    an empty set, are linked with nothing and keep their doc_id. Rows with equal doc_id are one document, linked by any
    of their texts, in whatever order they come. Rows with a null doc_id get the component of an equal set, but never name one; kept
    then means that there is none. Ties don't matter, as all links count; texts are compared whole, however long. An empty
    table gives an empty result; other columns don't matter.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = scratch.keep(signatures(docs, size), "signed")
    named = signed.filter("n_shingles > 0 and doc_id is not null")
    nodes = named.groupBy("digest").agg(F.min("doc_id").alias("node"), *(F.first(c).alias(c) for c in ("n_shingles", "bands", "minima")))
    nodes = scratch.keep(nodes, "nodes")
    pairs, crowded = _meetings(nodes.select("node", F.col("bands").alias("keys")), scratch)
    alike = scratch.keep(_signed_alike(pairs, nodes, percent), "alike")
    # each node's smallest partner first
    closest = alike.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    sets = _sets(docs, alike, size, scratch, "sets")
    first = _confirmed(closest, sets, percent).unionByName(links_of_documents(named, nodes, scratch))
    roots = components(first, scratch, "first")
    more = scratch.keep(_confirmed(_apart(alike, roots), sets, percent), "more")
    roots = joined_components(roots, more, scratch, "second")
    scratch.drop("sets", "met", "buckets")
    # members of crowds that aren't in the component of most of them
    links = scratch.keep(_crowd_links(crowded, nodes, roots, docs, size, percent, scratch), "crowd-links")
    roots = joined_components(roots, links, scratch, "third")
    classes = nodes.select("digest", "node").join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    classes = scratch.keep(classes, "classes").withColumnRenamed("digest", "__digest")
    rows = signed.select("doc_id", "n_shingles", "digest").join(classes, F.col("digest") == F.col("__digest"), "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("root"))
    rows = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
