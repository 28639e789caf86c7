import pytest

from eventlake.operators import silver
from eventlake.schemas import SILVER_COLUMNS
from eventlake.sources import compaction, tables
from eventlake.sources.folders import Folders
from eventlake.sources.key_index import EVENT, NATURAL, KeyIndex, index_path
from eventlake.streaming import jobs
from tests.helpers import BAD, raw

BUCKETS = 4


def rows(spark, path):
    return sorted(map(tuple, tables.read_table(spark, path).select("id", "v").collect()))


def batches(spark, path, count, stream="s"):
    """One write of all batches: small ones, one folder each."""
    df = spark.range(count * 3).selectExpr("id", "id % 7 AS v", f"concat('{stream}-', id % {count}) AS batch")
    df.repartition(4).write.mode("append").partitionBy("batch").parquet(path)


def test_settled_batches_leave_the_newest_of_each_stream():
    names = ["a-0", "a-1", "a-10", "a-9", "b-c-3", "pack-ff", "other", "x-y"]
    assert compaction.settled(names) == ["a-0", "a-1"] and compaction.settled(names, 1) == ["a-0", "a-1", "a-9"]
    assert compaction.settled(names, 0) == ["a-0", "a-1", "a-9"]  # the newest may be replayed


def test_a_hundred_batches_become_a_bounded_number_of_folders_and_files(spark, lake):
    path = f"{lake}/t"
    batches(spark, path, 100)
    before = rows(spark, path)
    assert len(compaction.batches_of(spark, path)) == 100
    assert compaction.pack(spark, path, over=200) == []
    assert len(compaction.pack(spark, path, over=50)) == 98
    assert compaction.batches_of(spark, path) == ["s-98", "s-99"] and rows(spark, path) == before
    packed = [n for n in Folders(spark, tables.packed_path(path)).names() if n.startswith("batch=")]
    assert len(packed) == 1 and len(tables.read_table(spark, path).inputFiles()) <= 2 * 4 + 4
    # More of them, packed again: the first pack stays as it is.
    batches(spark, path, 20, "z")
    grown = rows(spark, path)
    assert len(compaction.pack(spark, path)) == 18 and rows(spark, path) == grown and len(grown) == 360
    # The newest batch is replaced by a replay as ever.
    tables.write_batch(spark.range(1).selectExpr("id - 1 AS id", "id AS v"), path, "s-99")
    assert len(rows(spark, path)) == 360 - 3 + 1


@pytest.mark.parametrize("fails", ["written", "removed", "renamed"])
def test_an_interrupted_pack_loses_and_repeats_nothing(spark, lake, monkeypatch, fails):
    path = f"{lake}/t"
    batches(spark, path, 10)
    before = rows(spark, path)

    def stop(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        if fails == "written":
            patch.setattr(compaction, "_log", stop)
            with pytest.raises(KeyboardInterrupt):
                compaction.pack(spark, path, before=stop)
            assert rows(spark, path) == before
        else:
            patch.setattr(Folders, "remove" if fails == "removed" else "rename", stop)
            with pytest.raises(KeyboardInterrupt):
                compaction.pack(spark, path)
    compaction.recover(spark, path)
    assert rows(spark, path) == before
    compaction.recover(spark, path)
    compaction.pack(spark, path)
    assert rows(spark, path) == before and len(compaction.batches_of(spark, path)) == 2


def test_a_stream_over_the_table_does_not_meet_packed_rows_again(spark, lake):
    path, seen = f"{lake}/t", f"{lake}/seen"

    def drain():
        stream = spark.readStream.schema("id bigint, v bigint, batch string").parquet(path)
        stream.writeStream.option("checkpointLocation", f"{lake}/c").trigger(availableNow=True).format("parquet").start(seen).awaitTermination()

    batches(spark, path, 10)
    drain()
    compaction.pack(spark, path)
    tables.write_batch(spark.range(1).selectExpr("id + 900 AS id", "id AS v"), path, "s-10")
    drain()
    assert sorted(r["id"] for r in spark.read.parquet(seen).collect()) == [*range(30), 900]


def clean(spark, *changes):
    return silver.clean(raw(spark, *changes)).select(*SILVER_COLUMNS)


def test_packed_tables_decide_as_before(spark, lake):
    path, quarantine = f"{lake}/clean", f"{lake}/quarantine"
    for i in range(5):
        jobs.upsert_batch(clean(spark, {"event_id": f"e{i}", "place": f"P{i}"}), f"s-{i}", path, buckets=BUCKETS)
        jobs.quarantine_batch(clean(spark, {**BAD, "kafka_offset": i}), f"s-{i}", quarantine)

    def enter(name, names):
        KeyIndex(spark, index_path(path), BUCKETS).note([name])

    assert len(compaction.pack(spark, path, before=enter)) == 3 and len(compaction.pack_quarantine(spark, quarantine)) == 3
    index = KeyIndex(spark, index_path(path), BUCKETS)
    index.complete(path)
    assert index.keys(NATURAL).count() == 5  # nothing was entered again
    assert jobs.upsert_batch(clean(spark, {"event_id": "e1", "place": "P1", "kafka_offset": 50}, {"event_id": "e0", "place": "moved"}), "s-5", path, buckets=BUCKETS) == 0
    assert jobs.upsert_batch(clean(spark, {"event_id": "e4", "place": "P4"}), "s-4", path, buckets=BUCKETS) == 1  # a replay
    assert jobs.quarantine_batch(clean(spark, {**BAD, "kafka_offset": 1}, {**BAD, "kafka_offset": 9}), "s-6", quarantine) == 1
    assert tables.read_table(spark, path).count() == 5 and tables.read_table(spark, quarantine).count() == 6


def test_the_index_is_compacted_to_one_file_for_each_bucket(spark, lake):
    path = f"{lake}/clean"
    for i in (0, 1, 2, 2):
        jobs.upsert_batch(clean(spark, *({"event_id": f"e{i}-{j}", "place": f"P{i}-{j}"} for j in range(12))), f"s-{i}", path, buckets=BUCKETS)
    index = KeyIndex(spark, index_path(path), BUCKETS)
    assert index.keys(EVENT).count() == 48  # the replay's are there twice
    files = len(index.keys(EVENT).inputFiles())
    index.compact()
    again = KeyIndex(spark, index_path(path), BUCKETS)
    assert again.root == index.root and again.root.endswith("generation-1") and again.batches() == {"s-0", "s-1", "s-2"}
    assert again.keys(EVENT).count() == again.keys(NATURAL).count() == 36 and len(again.keys(EVENT).inputFiles()) <= BUCKETS < files
    # An attempt that ended before its list of batches was written is not the current one.
    again.keys(EVENT).write.parquet(f"{again.folders.root}/generation-2/event_id")
    assert KeyIndex(spark, index_path(path), BUCKETS).root == again.root
    again.compact()
    assert KeyIndex(spark, index_path(path), BUCKETS).root.endswith("generation-2")
    assert jobs.upsert_batch(clean(spark, {"event_id": "e0-3", "place": "P0-3"}, {"event_id": "new", "place": "new"}), "s-3", path, buckets=BUCKETS) == 1
