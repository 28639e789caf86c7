import random

import pytest
from pyspark.sql import functions as F

from eventlake.operators.upsert import first_per_key, new_records, unstored_records
from eventlake.sources import tables
from eventlake.sources.key_index import EVENT, NAMED_DAYS, NATURAL, KeyIndex, days_in, index_path
from eventlake.streaming import jobs
from tests.helpers import plan, raw

SCHEMA = "record_natural_key string, event_id string, kafka_topic string, kafka_partition int, kafka_offset bigint, event_timestamp timestamp"


def frame(spark, triples):
    """(natural key, event id, day number) each; day None is no time."""
    rows = [(k, e, "t", i % 3, i, None if d is None else d * 86400) for i, (k, e, d) in enumerate(triples)]
    df = spark.createDataFrame(rows, SCHEMA.replace("event_timestamp timestamp", "event_timestamp bigint"))
    return df.withColumn("event_timestamp", F.timestamp_seconds("event_timestamp"))


def indexed(spark, lake, *batches, buckets=4):
    """A table of the given batches and its index."""
    for n, triples in enumerate(batches):
        tables.write_batch(frame(spark, triples), f"{lake}/t", f"b-{n}")
    index = KeyIndex(spark, index_path(f"{lake}/t"), buckets)
    index.complete(f"{lake}/t")
    return index


def triples(rng, n, keys, hot=0.3):
    def one():
        key = rng.randrange(keys)
        event = "hot" if rng.random() < hot else rng.choice([None, f"e{rng.randrange(keys)}"])
        # The natural key holds the time, so a key has one day.
        return f"k{key}", event, None if key % 9 == 0 else key % 40

    return [one() for _ in range(n)]


@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
@pytest.mark.parametrize("hot_stored", [False, True])
def test_the_index_decides_as_the_whole_table(spark, lake, broadcast_rows, hot_stored):
    rng = random.Random(11)
    known = [t for t in triples(rng, 300, 700) if t[1] != "hot"] + ([("khot", "hot", 3)] if hot_stored else [])
    index = indexed(spark, lake, known[:100], known[100:])
    batch = first_per_key(frame(spark, triples(rng, 1200, 700)))
    expected = new_records(batch, frame(spark, known), batch_rows=batch.count())
    got = unstored_records(batch, index, batch_rows=batch.count(), broadcast_rows=broadcast_rows)
    key = lambda df: sorted(r["record_natural_key"] for r in df.collect())
    assert key(got) == key(expected) and set(got.columns) == set(batch.columns)


def scans(df):
    return [line for line in plan(df).splitlines() if "FileScan parquet" in line and "eventlake_" in line]


@pytest.mark.parametrize("kind, days", [(NATURAL, ["1970-01-03"]), (EVENT, None)])
@pytest.mark.parametrize("rows", [10, 10**6, 10**12])
def test_the_index_is_neither_shuffled_nor_read_whole_at_any_batch_size(spark, lake, setting, kind, days, rows):
    setting("spark.sql.adaptive.enabled", "false")
    index = indexed(spark, lake, [(f"k{i}", f"e{i}", i % 40) for i in range(400)])
    batch = spark.createDataFrame([(f"{'k' if kind == NATURAL else 'e'}{i}",) for i in range(2, 400, 40)], "key string")
    found = index.held(batch, kind, rows=rows, days=days)
    text = plan(found)
    (scan,) = scans(found)
    assert ("EqualTo(day,1970-01-03)" in scan) == (days is not None)
    assert f"ReadSchema: struct<key:string{',day:date' if days else ''}>" in scan and "Bucketed: true" in scan
    # Nothing but filters lies between the scan and the join, so no exchange moves the index.
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    above = []
    indent = len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789"))
    for line in reversed(lines[:at]):
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if depth < indent:
            indent = depth
            above.append(line.lstrip(" :+-*()0123456789").split(" ")[0])
    assert "Exchange" not in above[: next(i for i, n in enumerate(above) if "Join" in n)]
    assert {10: "BroadcastHashJoin", 10**6: "ShuffledHashJoin", 10**12: "SortMergeJoin"}[rows] in text
    assert found.count() == 10


def test_row_groups_of_other_days_are_skipped(spark, lake, setting):
    setting("spark.sql.adaptive.enabled", "false")
    index = indexed(spark, lake)
    for day in range(4):  # each batch has files of its own
        tables.write_batch(frame(spark, [(f"k{day}-{i}", f"e{day}-{i}", day) for i in range(200)]), f"{lake}/t", f"b-{day}")
        index.complete(f"{lake}/t")
    wanted = spark.createDataFrame([("k2-7",), ("k3-8",)], "key string")
    found = index.held(wanted, NATURAL, rows=2, days=["1970-01-03"])
    assert [r["key"] for r in found.collect()] == ["k2-7"]
    leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
    nodes = [leaves.apply(i) for i in range(leaves.size())]
    (read,) = [n.metrics().get("numOutputRows").get().value() for n in nodes if n.nodeName().startswith("Scan parquet")]
    assert 1 <= read <= 200


def test_batches_that_miss_in_the_index_are_entered(spark, lake):
    index = indexed(spark, lake, [("a", "1", 0)])
    tables.write_batch(frame(spark, [("b", "2", 1)]), f"{lake}/t", "x-7")  # a writer that ended before it entered the keys
    assert index.batches() == {"b-0"}
    index.complete(f"{lake}/t", but="x-7")
    assert index.batches() == {"b-0"}
    index.complete(f"{lake}/t")
    index.complete(f"{lake}/t")
    assert index.batches() == {"b-0", "x-7"} and index.keys(NATURAL).count() == 2
    keys = spark.createDataFrame([("a",), ("b",)], "key string")
    assert [r["key"] for r in index.held(keys, NATURAL, rows=2, but="x-7").collect()] == ["a"]


def test_days(spark):
    days = days_in(frame(spark, [("a", "1", 0), ("b", "2", None), ("c", "3", 1)]))
    assert sorted(days) == ["0001-01-01", "1970-01-01", "1970-01-02"]
    many = days_in(frame(spark, [(f"k{i}", "1", i) for i in range(NAMED_DAYS + 5)]))
    assert len(many) > NAMED_DAYS and many[:2] == ["1970-01-01", "1972-10-01"]


def test_a_known_event_id_is_found_on_any_day(spark, lake):
    from eventlake.operators import silver
    from eventlake.schemas import SILVER_COLUMNS

    def insert(batch, *rows):
        return jobs.upsert_batch(silver.clean(raw(spark, *rows)).select(*SILVER_COLUMNS), batch, f"{lake}/clean", buckets=4)

    assert insert("s-0", {"event_id": "a"}) == 1
    moved = {"event_id": "a", "date": "1999-05-05 00:00:00+00:00", "time": "925862400000"}
    assert insert("s-1", moved) == 0 and insert("s-2", {**moved, "event_id": "b"}) == 1
    assert insert("s-2", {**moved, "event_id": "b"}) == 1  # a replay decides as before
    assert sorted(r["event_id"] for r in tables.read_table(spark, f"{lake}/clean").collect()) == ["a", "b"]
