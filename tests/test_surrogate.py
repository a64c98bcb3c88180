from __future__ import annotations

import hashlib

from deskspark.operators import surrogate
from deskspark.operators.surrogate import (
    Ranges, bucket_starts, copy_ids, key_ids, new_key_ids, place_copies, place_copies_by_ranges, place_keys, place_keys_by_ranges,
)
from deskspark.sources.store import TableStore


def test_new_keys_are_numbered_without_gaps_and_alike_on_any_partitioning(spark):
    target = spark.createDataFrame([(41,), (7,)], "id bigint")
    names = [f"key {i}" for i in range(3000)]
    keys = spark.createDataFrame([(n,) for n in names], "k string")
    ordered = sorted(names, key=lambda n: (hashlib.md5(n.encode()).hexdigest()[:3], n))
    want = {n: 42 + i for i, n in enumerate(ordered)}
    for partitions in (1, 7):
        got = new_key_ids(keys.repartition(partitions), "k", target, "id")
        assert {r.k: r.id for r in got.collect()} == want


def test_count_and_places_share_one_shuffle(spark):
    target = spark.createDataFrame([(1,)], "id bigint")
    keys = spark.range(500).selectExpr("'k' || id AS k")
    ids = new_key_ids(keys, "k", target, "id")
    ids.collect()
    plan = ids._jdf.queryExecution().executedPlan()
    ids._jdf.queryExecution().toRdd().count()
    final = plan.toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange [k" in final


def test_copies_get_ids_of_their_own_after_the_keys(spark, monkeypatch):
    monkeypatch.setattr(surrogate, "COPIES_PER_CHUNK", 64)
    target = spark.createDataFrame([], "id bigint")
    keyed = place_keys(spark.createDataFrame([("a",), ("b",)], "k string"), "k")
    rows = [("hot", None)] * 1000 + [("x", 1)] * 3 + [("y", 2)]
    copies = place_copies(spark.createDataFrame(rows, "v string, w int"))
    starts = bucket_starts(target, "id", keyed, copies)
    got = copy_ids(copies, starts, ["v", "w"], "id").collect()
    assert sorted(r.id for r in got) == list(range(3, 3 + len(rows)))
    assert sorted(((r.v, r.w) for r in got), key=str) == sorted(rows, key=str)


def test_ranges_give_the_same_ids_at_any_number_of_parts(spark, tmp_path):
    target = spark.createDataFrame([(41,)], "id bigint")
    keys = spark.range(3000).selectExpr("'key ' || id AS k")
    rows = spark.createDataFrame([("hot", None)] * 500 + [(f"v{i % 40}", i % 3) for i in range(900)] + [(None, None)] * 7, "v string, w int")
    stage = TableStore(spark, str(tmp_path)).stage

    def numbered(keyed, copies):
        starts = bucket_starts(target, "id", keyed, copies)
        return ({r.k: r.id for r in key_ids(keyed, starts, "k", "id").collect()},
                sorted(((r.id, r.v, r.w) for r in copy_ids(copies, starts, ["v", "w"], "id").collect())))

    want = numbered(place_keys(keys, "k"), place_copies(rows))
    assert sorted([*want[0].values(), *(i for i, _, _ in want[1])]) == list(range(42, 42 + 3000 + 1407))
    for parts in (1, 2, 200):
        ranges = Ranges(parts, stage)
        assert numbered(place_keys_by_ranges(keys, "k", ranges), place_copies_by_ranges(rows, ranges)) == want


def test_ranges_of_nothing(spark, tmp_path):
    target = spark.createDataFrame([(41,)], "id bigint")
    ranges = Ranges(5, TableStore(spark, str(tmp_path)).stage)
    keyed = place_keys_by_ranges(spark.createDataFrame([], "k string"), "k", ranges)
    copies = place_copies_by_ranges(spark.createDataFrame([], "v string"), ranges)
    starts = bucket_starts(target, "id", keyed, copies)
    assert key_ids(keyed, starts, "k", "id").count() == copy_ids(copies, starts, ["v"], "id").count() == 0


def test_ranges_are_used_where_buckets_would_be_too_large():
    assert Ranges.needed(16**3 * 10, None, rows_per_part=10) is None
    assert Ranges.needed(16**3 * 10 + 1, None, rows_per_part=10).parts == 16**3 + 1
