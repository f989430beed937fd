"""Prefix tree of conversations: double-array tries per shard, shared upper nodes merged over all shards.

A turn is the digest of its role and text, a conversation the sequence of its digests. Equal
sequences are one path with a count, before anything else. Paths are sorted over all tasks and cut
into shards of ``SHARD_TURNS`` turns, so a shard is a stretch of the order and holds whole
prefixes but for those at its two ends; a first turn that very many conversations share simply spans
many shards. In a shard turns have dense ids, and its tree is packed into a double array: the child of node s
by turn c is ``BASE[s] + c``, and ``CHECK`` of it says s. Walking all paths through the arrays gives each
node's members, and sums from the deepest level upwards those of its subtree.

Only prefixes of a shard's first and last path can be in another shard. These nodes, two paths a shard
whatever the input, are merged by prefix digest; sums over their subtrees come from
doubling: after k rounds a node has the sums of all merged nodes less than 2^k levels below it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import WORD, Scratch, table

#: Turns in a shard, but for a longer path; a task holds one shard at a time.
SHARD_TURNS = 1 << 17
#: Turns are placed in bands of so many turn numbers, and members listed by so many conversation numbers, as powers of two.
BAND_BITS, LIST_BITS = 10, 12
#: Conversations take their first turns from the one whose number is the next lower multiple of this.
FAMILY, MOST_SHARED = 20, 4
_DIGITS = 32
NOBODY = hashlib.sha256(b"").hexdigest()


def shared_turns(conv_id):
    """How many first turns a conversation takes from another."""
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED


def rebuilt_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, place, turn (digest) and words of the rebuilt conversations, and a row with place 0 and no turn for each.

    Turns are ordered by their number, null first, then by digest. A conversation with very
    many turns is placed band by band; only the counts of its bands meet.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    thin = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("number"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("turn"),
        F.regexp_count(text, F.lit(WORD)).alias("words"),
    )
    band = F.coalesce(F.shiftright("number", BAND_BITS), F.lit(-(1 << 62)))
    thin = scratch.keep(thin.withColumn("band", band), "turns")
    earlier = Window.partitionBy("conv_id").orderBy("band")
    bands = thin.groupBy("conv_id", "band").agg(F.count(F.lit(1)).alias("n"))
    bands = bands.withColumn("before", F.sum("n").over(earlier) - F.col("n"))
    within = Window.partitionBy("conv_id", "band").orderBy(F.asc_nulls_first("number"), "turn")
    placed = thin.join(bands.drop("n"), ["conv_id", "band"])
    place = F.col("before") + F.row_number().over(within)
    placed = scratch.keep(placed.select("conv_id", place.alias("place"), "turn", "words"), "placed")

    every = scratch.keep(thin.select("conv_id").distinct().withColumn("shared", shared_turns(F.col("conv_id"))), "conversations")
    lender = F.col("conv_id") - F.col("conv_id") % FAMILY
    lent = placed.filter((F.col("place") < MOST_SHARED) & (lender == F.col("conv_id"))).withColumnRenamed("conv_id", "lender")
    borrowers = every.withColumn("lender", lender).filter(F.col("shared") > 0)
    first = borrowers.join(lent, "lender").filter(F.col("place") <= F.col("shared")).select("conv_id", "place", "turn", "words")
    own = placed.filter(F.col("place") > shared_turns(F.col("conv_id")))
    own = own.select("conv_id", (F.col("place") + MOST_SHARED).alias("place"), "turn", "words")
    begin = every.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(None).cast("string").alias("turn"), F.lit(0).alias("words"))
    return begin.unionByName(first).unionByName(own)


def paths_of(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """Distinct paths: digests joined in order, words of each turn, members, the smallest of them and the digest of their list.

    The rows of one conversation come together as a row of some 40 bytes a turn.
    """
    found = F.array_sort(F.collect_list(F.when(F.col("turn").isNotNull(), F.struct("place", "turn", "words"))))
    each = turns.groupBy("conv_id").agg(found.alias("found"))
    each = each.select("conv_id", F.array_join("found.turn", "").alias("path"), F.col("found.words").alias("words"))
    each = scratch.keep(each.withColumn("key", F.md5(F.col("path").cast("binary"))), "each")
    paths = each.groupBy("key").agg(F.first("path").alias("path"), F.first("words").alias("words"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    some = each.groupBy("key", F.shiftright("conv_id", LIST_BITS).alias("part"))
    listed = some.agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("members"))
    listed = listed.repartition("key").sortWithinPartitions("key", "part").select("key", "members")

    def digested(batches):
        """The parts of a list follow one another, so its digest is taken as they come."""
        key, digest = None, None
        for batch in batches:
            keys, ends = [], []
            for new, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if new != key:
                    if key is not None:
                        keys.append(key)
                        ends.append(digest.hexdigest())
                    key, digest = new, hashlib.sha256(members.encode())
                else:
                    digest.update(b"," + members.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ends, pa.string())], names=["key", "ends"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], names=["key", "ends"])

    return paths.join(listed.mapInArrow(digested, "key string, ends string"), "key").drop("key")


class DoubleArray:
    """A tree over dense turn ids: child of s by c is ``base[s] + c`` if ``check`` of that is s; slot 0 is the root."""

    def __init__(self, size: int = 1024):
        self.base = np.zeros(size, dtype=np.int64)
        self.check = np.full(size, -1, dtype=np.int64)
        self.check[0] = 0
        self._low = 1  # no free slot lies below

    def _reach(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int64)])

    def _free(self, n: int) -> np.ndarray:
        """The n lowest free slots."""
        found, at, have = [], self._low, 0
        while have < n:
            width = max(n - have, 256)
            self._reach(at + width)
            some = at + np.flatnonzero(self.check[at : at + width] < 0)[: n - have]
            found.append(some)
            have += len(some)
            at += width
        return np.concatenate(found) if found else np.empty(0, dtype=np.int64)

    def add(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """Children of nodes that have none yet; rows of a parent follow one another, with codes in order."""
        first = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]])
        count = np.diff(np.r_[first, len(parents)])
        for at, n in zip(first[count > 1], count[count > 1]):
            self._place(parents[at], codes[at : at + n])
        one = first[count == 1]
        slots = self._free(len(one))
        self.base[parents[one]] = slots - codes[one]
        self.check[slots] = parents[one]
        if len(slots):
            self._low = int(slots[-1]) + 1

    def _place(self, parent: int, codes: np.ndarray, tries: int = 32) -> None:
        """The first of some free slots from which all children fit, or else the end of what is used."""
        apart = codes - codes[0]
        end = len(self.check) - int(np.argmax(self.check[::-1] >= 0))
        for slot in [*self._free(tries), end]:
            self._reach(int(slot + apart[-1]) + 1)
            if (self.check[slot + apart] < 0).all():
                break
        self.base[parent] = slot - codes[0]
        self.check[slot + apart] = parent

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Children by one turn each; -1 where there is none."""
        children = self.base[nodes] + codes
        inside = (children > 0) & (children < len(self.check))
        return np.where(inside & (self.check[np.where(inside, children, 0)] == nodes), children, -1)


_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, key string, parent_key string, words long"
)


def _prefix_keys(path: str) -> list[str]:
    """A digest of every prefix of a path, the empty one first."""
    digest = hashlib.blake2b(digest_size=16)
    keys = [digest.hexdigest()]
    for at in range(0, len(path), _DIGITS):
        digest.update(path[at : at + _DIGITS].encode())
        keys.append(digest.copy().hexdigest())
    return keys


def dense_turns(paths: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """Dense ids of all turns in order of first sight, the length of every path, and the number of ids."""
    turns = np.frombuffer("".join(paths).encode(), dtype=f"S{_DIGITS}")
    known, first, which = np.unique(turns, return_index=True, return_inverse=True)
    order = np.empty(len(known), dtype=np.int64)
    order[np.argsort(first)] = np.arange(len(known))
    return order[which], np.array([len(p) // _DIGITS for p in paths], dtype=np.int64), len(known)


def packed(codes: np.ndarray, lengths: np.ndarray, n_codes: int) -> DoubleArray:
    """The double array of sorted paths, level by level."""
    tree = DoubleArray(n_codes + 2)
    starts = np.cumsum(lengths) - lengths
    active, nodes, depth = np.arange(len(lengths)), np.zeros(len(lengths), dtype=np.int64), 0
    while True:
        deeper = lengths[active] > depth
        active, nodes = active[deeper], nodes[deeper]
        if not len(active):
            return tree
        turns = codes[starts[active] + depth]
        new = np.r_[True, (nodes[1:] != nodes[:-1]) | (turns[1:] != turns[:-1])]
        parents, children = nodes[new], turns[new]
        order = np.lexsort((children, np.cumsum(np.r_[True, parents[1:] != parents[:-1]])))
        tree.add(parents[order], children[order])
        nodes = tree.step(nodes, turns)
        depth += 1


def shard_nodes(paths: list[str], words: list[list[int]], counts: list[int], convs: list[int], ends: list[str]) -> dict[str, list]:
    """Columns of ``_NODE`` for the nodes of some paths in order.

    Nodes that may be in other shards have their key, and sums without what lies below
    other such nodes; the rest is final but for the conversation of a parent with a key.
    """
    codes, lengths, n_codes = dense_turns(paths)
    tree = packed(codes, lengths, n_codes)
    size = len(tree.check)
    flat = np.fromiter((w for of in words for w in of), dtype=np.int64, count=int(lengths.sum()))
    starts = np.cumsum(lengths) - lengths
    members, first = np.array(counts, dtype=np.int64), np.array(convs, dtype=np.int64)
    n = np.zeros(size, dtype=np.int64)
    conv = np.full(size, np.iinfo(np.int64).max)
    own_words, levels = np.zeros(size, dtype=np.int64), []
    ended = {}
    active, nodes, depth = np.arange(len(paths)), np.zeros(len(paths), dtype=np.int64), 0
    keys = {}
    for path, row in {paths[0]: 0, paths[-1]: len(paths) - 1}.items():
        slot = np.zeros(1, dtype=np.int64)
        for d, key in enumerate(_prefix_keys(path)):
            if d:
                slot = tree.step(slot, codes[starts[row] + d - 1 : starts[row] + d])
            keys[int(slot[0])] = key
    while len(active):
        np.add.at(n, nodes, members[active])
        np.minimum.at(conv, nodes, first[active])
        levels.append(np.unique(nodes))
        over = lengths[active] == depth
        ended.update(zip(nodes[over].tolist(), active[over].tolist()))
        active, nodes = active[~over], nodes[~over]
        at = starts[active] + depth
        nodes = tree.step(nodes, codes[at])
        own_words[nodes] = flat[at]
        depth += 1
    seam = np.zeros(size, dtype=bool)
    seam[list(keys)] = True
    cost = (n - 1) * own_words
    children, leaves, saved = (np.zeros(size, dtype=np.int64) for _ in range(3))
    for level in reversed(levels):
        inner = level[~seam[level]]
        leaves[inner] += children[inner] == 0
        saved[inner] += cost[inner]
        above = tree.check[inner]
        np.add.at(children, above, 1)
        np.add.at(leaves, above, leaves[inner])
        np.add.at(saved, above, saved[inner])
    slots = np.concatenate(levels)
    depths = np.repeat(np.arange(len(levels)), [len(level) for level in levels])
    parents = np.where(slots == 0, -1, tree.check[slots])
    listed, above = slots.tolist(), parents.tolist()
    known = (parents >= 0) & ~seam[parents] & ~seam[slots]
    return {
        "conv_id": conv[slots],
        "depth": depths,
        "parent_conv_id": pa.array(conv[parents], mask=~known),
        "n_convs": n[slots],
        "n_children": children[slots],
        "n_leaves": leaves[slots],
        "saved_tokens": saved[slots],
        "ends_sha256": [ends[ended[s]] if s in ended else None for s in listed],
        "key": [keys.get(s) for s in listed],
        "parent_key": [keys.get(p) for p in above],
        "words": own_words[slots],
    }


def _all_nodes(paths: DataFrame) -> DataFrame:
    """Nodes of every shard of the sorted paths."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_NODE))
    most = 1 << 16  # nodes in a batch

    def shards(batches):
        def nodes(rows):
            columns = shard_nodes(*map(list, zip(*rows)))
            arrays = [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema]
            whole = pa.RecordBatch.from_arrays(arrays, schema=schema)
            yield from (whole.slice(at, most) for at in range(0, whole.num_rows, most))

        rows, turns = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                for row in zip(*(part.column(i).to_pylist() for i in range(5))):
                    rows.append(row)
                    turns += 1 + len(row[0]) // _DIGITS
                    if turns >= SHARD_TURNS:
                        yield from nodes(rows)
                        rows, turns = [], 0
        if rows:
            yield from nodes(rows)

    ordered = paths.select("path", "words", "n", "conv_id", "ends").repartitionByRange("path").sortWithinPartitions("path")
    return ordered.mapInArrow(shards, _NODE)


def _merged(seams: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per node that several shards may hold, with all its members and sums over its whole subtree."""
    sums = {c: F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
    nodes = seams.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), *sums.values(), *(F.max(c).alias(c) for c in ("depth", "parent_key", "words", "ends_sha256"))
    )
    nodes = scratch.keep(nodes, "merged")
    below = nodes.filter("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    n_children = F.col("n_children") + F.coalesce("more", F.lit(0))
    nodes = nodes.join(below, "key", "left").withColumn("n_children", n_children).drop("more")
    nodes = scratch.keep(nodes, "merged-children")

    parts = nodes.select(
        "key",
        F.col("parent_key").alias("up"),
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    rounds = 0
    parts = scratch.keep(parts, "sums-0")
    while not (hanging := parts.filter("up is not null")).isEmpty():
        rounds += 1
        more = hanging.groupBy(F.col("up").alias("key")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        above = hanging.select("key", F.col("up").alias("via")).join(parts.select(F.col("key").alias("via"), "up"), "via").drop("via")
        added = parts.drop("up").join(more, "key", "left").join(above, "key", "left")
        total = {c: (F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("n_leaves", "l"), ("saved_tokens", "s"))}
        parts = scratch.keep(added.select("key", "up", *total.values()), f"sums-{rounds}")
        scratch.drop(f"sums-{rounds - 1}")
    nodes = nodes.drop("n_leaves", "saved_tokens").join(parts.drop("up"), "key")
    above = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return scratch.keep(nodes.join(above, "parent_key", "left"), "merged-sums")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt ``conversations`` (conv_id, turn, role, text), the empty one included.

    conv_id (the smallest member), depth, parent_conv_id, n_convs (members), n_children, n_leaves
    (in the subtree), saved_tokens (over the subtree, words of a node's turn times its members but one) and ends_sha256 (of the
    members that end there). Null roles and texts are empty ones. Rows without conv_id belong to no conversation.
    Turns with equal numbers are ordered by digest, so repeated rows are turns of their own, next to each other.
    A conversation without turns of its own or lent ones ends at the root. Without conversations there is no node. Other
    columns don't matter. Texts are digested where they are read, however long.
    """
    scratch = Scratch(conversations.sparkSession, "trie")
    turns = rebuilt_turns(conversations.select("conv_id", "turn", "role", "text"), scratch)
    paths = scratch.keep(paths_of(turns, scratch), "paths")
    scratch.drop("turns", "placed", "conversations", "each")
    nodes = scratch.keep(_all_nodes(paths), "nodes")
    merged = _merged(nodes.filter("key is not null"), scratch)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    columns.append(F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256"))
    inner = nodes.filter("key is null")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("__conv_id"))
    hung = inner.filter("parent_key is not null").drop("parent_conv_id").join(above, "parent_key")
    hung = hung.withColumnRenamed("__conv_id", "parent_conv_id")
    whole = inner.filter("parent_key is null").select(*columns)
    return whole.unionByName(hung.select(*columns)).unionByName(merged.select(*columns))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
