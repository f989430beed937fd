from collections import Counter, defaultdict

import pytest

from sangam.llm import sharding

ROWS = [(i, "hot" if i % 3 else f"s{i % 7}", f"t{i % 50}") for i in range(3000)] + [(None, None, None)] * 40 + [(5, "hot", "x")] * 30


@pytest.mark.parametrize("bucket", [1 << 14, 64, 7])
def test_shards_are_even_and_mixed(spark, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket)
    rows = spark.createDataFrame(ROWS, "doc_id long, source string, shard string")
    got = sharding.stratified_shards(rows).collect()
    assert sorted((r.doc_id, r.source) for r in got if r.doc_id is not None) == sorted(r[:2] for r in ROWS if r[0] is not None)
    sizes, mixture = defaultdict(list), Counter()
    for r in got:
        sizes[r.shard].append(r.slot)
        mixture[r.source, r.shard] += 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in sizes.values())
    assert len(sizes) == 8 and max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1
    for source in {r[1] for r in ROWS}:
        counts = [mixture[source, shard] for shard in range(8)]
        share = sum(counts) / len(ROWS)
        assert max(counts) - min(counts) <= 1 + share * len({r[1] for r in ROWS})


def test_buckets_do_not_change_the_order(spark, monkeypatch):
    rows = spark.createDataFrame([r for r in ROWS[:3000]], "doc_id long, source string, t string")
    orders = []
    for bucket in (1 << 14, 50):
        monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket)
        orders.append(sorted((r.doc_id, r.shard, r.slot) for r in sharding.stratified_shards(rows, 5).collect()))
    assert orders[0] == orders[1]


def test_few_and_no_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, source string")
    assert sorted((r.shard, r.slot) for r in sharding.stratified_shards(rows).collect()) == [(0, 0), (4, 0)]
    assert sharding.stratified_shards(rows.limit(0)).collect() == []
    with pytest.raises(ValueError):
        sharding.stratified_shards(rows, 0)


def test_many_small_sources_and_equal_keys_fill_no_stretch(spark, monkeypatch):
    """Sources of one row all have the rank 1/2; rows without key have one hash."""
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 500)
    rows = spark.range(8000).selectExpr("IF(id % 2 = 0, id, NULL) AS doc_id", "IF(id < 6000, concat('s', id), 'one') AS source", "id AS n")
    sizes = []
    keep = sharding.Scratch.keep

    def kept(self, df, name):
        out = keep(self, df, name)
        if name in ("by-source", "by-fraction"):
            sizes.extend(r["count"] for r in out.groupBy("__part").count().collect())
        return out

    monkeypatch.setattr(sharding.Scratch, "keep", kept)
    got = sharding.stratified_shards(rows).collect()
    assert max(sizes) < 1500 and len(sizes) >= 30
    assert sorted(r.n for r in got) == list(range(8000)) and Counter(r.shard for r in got) == {s: 1000 for s in range(8)}


def test_order_of_rows_with_equal_keys_is_defined(spark):
    rows = [(1, "a", f"t{i}") for i in range(50)] + [(None, None, f"t{i}") for i in range(50)]
    found = []
    for order in (rows, rows[::-1]):
        got = sharding.stratified_shards(spark.createDataFrame(order, "doc_id long, source string, t string").repartition(3))
        found.append(sorted((str(r.doc_id), r.t, r.shard, r.slot) for r in got.collect()))
    assert found[0] == found[1]
