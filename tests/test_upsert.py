import random

import pytest
from pyspark.sql import functions as F

from eventlake.operators.lookup import hot_keys, join_unique
from eventlake.operators.upsert import first_per_key, new_records
from tests.helpers import plan

SCHEMA = "record_natural_key string, event_id string, kafka_topic string, kafka_partition int, kafka_offset bigint"


def rows(spark, pairs):
    return spark.createDataFrame([(k, e, "t", i % 3, i) for i, (k, e) in enumerate(pairs)], SCHEMA)


def test_first_arrival_wins_and_same_id_under_two_keys_stays(spark):
    df = rows(spark, [("a", "1"), ("b", "1"), ("a", "2"), ("a", "3"), (None, "4"), (None, "5")])
    kept = {(r["record_natural_key"], r["event_id"]) for r in first_per_key(df.repartition(4)).collect()}
    assert kept == {("a", "1"), ("b", "1"), (None, "4")}


def test_dedup_limits_each_group_before_the_shuffle(spark):
    text = plan(first_per_key(rows(spark, [("a", "1")]).repartition(4)))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
def test_new_records_against_brute_force(spark, broadcast_rows):
    rng = random.Random(7)

    def pairs(n, keys):
        # A third of all rows carry one hot event id, some carry none.
        ids = lambda: rng.choice(["hot", None, f"e{rng.randrange(keys)}"])
        return [(f"k{rng.randrange(keys)}", ids()) for _ in range(n)]

    target_pairs = [(k, e) for k, e in pairs(400, 900) if e != "hot"]
    for known in (target_pairs, [*target_pairs, ("khot", "hot")]):
        batch = first_per_key(rows(spark, pairs(1500, 900)))
        target = rows(spark, known)
        keys, ids = {k for k, _ in known}, {e for _, e in known if e is not None}
        expected = sorted(r["record_natural_key"] for r in batch.collect() if r["record_natural_key"] not in keys and r["event_id"] not in ids)
        fresh = new_records(batch, target, batch_rows=batch.count(), broadcast_rows=broadcast_rows)
        assert sorted(r["record_natural_key"] for r in fresh.collect()) == expected
        assert set(fresh.columns) == set(batch.columns)
        assert "NestedLoop" not in plan(fresh) and "Cartesian" not in plan(fresh)


def test_small_batch_does_not_shuffle_the_target(spark, lake):
    rows(spark, [(f"k{i}", f"e{i}") for i in range(1000)]).write.parquet(f"{lake}/target")
    target = spark.read.parquet(f"{lake}/target")
    fresh = new_records(rows(spark, [("k1", "x"), ("y", "e2"), ("z", "z")]), target, batch_rows=3)
    text = plan(fresh)
    assert "SortMergeJoin" not in text
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert scans and all("ReadSchema: struct<record_natural_key:string>" in s or "ReadSchema: struct<event_id:string>" in s for s in scans)
    assert [r["event_id"] for r in fresh.collect()] == ["z"]


HOT = "CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL ELSE concat('k', id % {keys}) END"


def spread(spark, setting, keys, task_rows):
    """Rows per key and part of the shuffled join of 60,000 rows, half of one key, a tenth without any."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    facts = spark.range(60_000).selectExpr("id", f"{HOT.format(keys=keys)} AS state")
    keyed = facts.where("state IS NOT NULL").groupBy("state").agg(F.min("id").cast("double").alias("idx"))
    joined = join_unique(facts, keyed, "state", spread_by="id", broadcast_rows=0, task_rows=task_rows)
    text = plan(joined)
    assert "SortMergeJoin" in text and "_salt" in text
    hot = hot_keys(facts, "state", task_rows=task_rows)
    parts = facts.join(F.broadcast(hot), F.col("state").eqNullSafe(F.col("_hot")), "left").withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("_parts", F.lit(1))))
    return joined, {(r["state"], r["part"]): r["count"] for r in parts.groupBy("state", "part").count().collect()}


def test_a_key_with_half_of_all_rows_is_split_by_its_frequency(spark, setting):
    joined, sizes = spread(spark, setting, 500, 1000)
    assert max(sizes.values()) < 1200 and len([k for k in sizes if k[0] == "hot"]) == 30 and len([k for k in sizes if k[0] is None]) == 6
    assert joined.count() == 60_000 and joined.where("idx IS NULL AND state IS NOT NULL").isEmpty()
    assert joined.where("state = 'hot'").agg(F.min("idx"), F.max("idx")).first() == (0.0, 0.0)


def test_keys_of_any_rank_stay_below_the_row_target(spark, setting):
    # 2,400 keys of ten rows each: the one at rank 1,001 is split as the first one is.
    joined, sizes = spread(spark, setting, 6000, 8)
    split = {k for k, part in sizes if part > 0 and k not in ("hot", None)}
    assert len(split) > 1000 and max(n for (k, _), n in sizes.items() if k not in ("hot", None)) <= 10
    assert joined.count() == 60_000 and joined.where("idx IS NULL AND state IS NOT NULL").isEmpty()


def test_too_many_hot_keys_double_the_target(spark):
    facts = spark.range(1000).selectExpr("id", "id % 100 AS state")
    assert hot_keys(facts, "state", task_rows=2).count() == 100 and hot_keys(facts, "state", task_rows=2, most=50).count() == 0
    assert {r["_parts"] for r in hot_keys(facts, "state", task_rows=3).collect()} == {4}


@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
def test_join_unique_with_a_hot_key(spark, broadcast_rows):
    facts = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id % 50) END AS state")
    keyed = spark.createDataFrame([("hot", 1.0), *((f"k{i}", float(i)) for i in range(40))], "state string, idx double")
    joined = join_unique(facts, keyed, "state", keyed_rows=41, spread_by="id", broadcast_rows=broadcast_rows, task_rows=100)
    expected = {"hot": 1.0, **{f"k{i}": float(i) for i in range(40)}}
    result = joined.collect()
    assert len(result) == 3000 and all(r["idx"] == expected.get(r["state"]) for r in result)
