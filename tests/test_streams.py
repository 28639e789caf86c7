import pytest

from eventlake.operators import bronze, silver
from eventlake.operators.events import message_value
from eventlake.operators.upsert import first_per_key
from eventlake.schemas import BRONZE_COLUMNS, SILVER_COLUMNS
from eventlake.session import shared_folder
from eventlake.sources import messages, tables
from eventlake.sources.folders import Folders
from eventlake.sources.key_index import KeyIndex
from eventlake.streaming import jobs
from tests.helpers import BAD, raw


def send(lake, rows, *more):
    """Rows as messages, ``more`` are payloads appended as they are."""
    payloads = rows.select("kafka_offset", message_value().cast("binary").alias("value"))
    extra = rows.sparkSession.createDataFrame([(900 + i, p.encode()) for i, p in enumerate(more)], "kafka_offset bigint, value binary")
    sent = payloads.unionByName(extra).selectExpr("0 AS partition", "kafka_offset AS offset", "CAST(NULL AS binary) AS key", "value")
    messages.publish_folder(sent, f"{lake}/messages", "events")


def drain(spark, lake, tag="", files=None):
    source = messages.folder_stream(spark, f"{lake}/messages", max_files_per_trigger=files)
    jobs.start_raw_stream(source, f"{lake}/raw", f"{lake}/bad", f"{lake}/cr{tag}", name=f"raw{tag}").awaitTermination()
    stream = messages.raw_layer_stream(spark, f"{lake}/raw", max_files_per_trigger=files)
    jobs.start_clean_stream(stream, f"{lake}/clean", f"{lake}/quarantine", f"{lake}/cc{tag}", name=f"clean{tag}").awaitTermination()


def load(spark, lake, table, columns=("event_id", "kafka_offset")):
    return sorted(tables.read_table(spark, f"{lake}/{table}").select(*columns).collect())


def test_streams_equal_the_batch_path_and_restart(spark, lake):
    first = raw(spark, {"event_id": "a"}, BAD, {"event_id": "c", "place": "C", "kafka_offset": 3})
    send(lake, first.repartition(3), "{bad", '{"place":"no id"}')
    drain(spark, lake, files=1)
    everything = bronze.parse_messages(spark.read.parquet(f"{lake}/messages"))
    assert load(spark, lake, "raw", BRONZE_COLUMNS[-5:-1]) == sorted(bronze.good_records(everything).select(*BRONZE_COLUMNS[-5:-1]).collect())
    assert tables.read_table(spark, f"{lake}/bad").count() == 2
    cleaned = silver.clean(bronze.good_records(everything))
    batch = sorted(first_per_key(silver.valid_records(cleaned)).select(*SILVER_COLUMNS[12:13], "record_natural_key").collect())
    assert load(spark, lake, "clean", ("event_id", "record_natural_key")) == batch
    assert [r["event_id"] for r in load(spark, lake, "quarantine")] == ["bad"]

    before = load(spark, lake, "clean")
    drain(spark, lake)  # nothing new
    assert load(spark, lake, "clean") == before and len(load(spark, lake, "raw")) == 3

    # Delivered again at later offsets, plus one new event and one known id under a new key.
    again = raw(
        spark,
        {"event_id": "a", "kafka_offset": 11},
        {"event_id": "c", "place": "moved", "kafka_offset": 13},
        {"event_id": "new", "place": "N", "kafka_offset": 14},
    )
    send(lake, again)
    drain(spark, lake)
    assert len(load(spark, lake, "raw")) == 6
    assert load(spark, lake, "clean") == sorted([*before, ("new", 14)])


def test_a_new_checkpoint_adds_and_never_replaces(spark, lake):
    send(lake, raw(spark, {"event_id": "a"}, {"event_id": "b", "place": "B", "kafka_offset": 2}))
    drain(spark, lake)
    before = load(spark, lake, "clean")
    send(lake, raw(spark, {"event_id": "c", "place": "C", "kafka_offset": 3}))
    drain(spark, lake, tag="-other")
    assert len(load(spark, lake, "raw")) == 2 + 3
    assert load(spark, lake, "clean") == sorted([*before, ("c", 3)])


def test_replayed_batches_change_nothing(spark, lake):
    batch = raw(spark, {"event_id": "a"}, {"event_id": "a", "place": "same id", "kafka_offset": 2}, BAD)
    parsed = batch.withColumn("raw_json", message_value())
    for _ in range(2):
        jobs.write_raw_batch(parsed, "s-0", f"{lake}/raw", f"{lake}/bad")
        jobs.write_clean_batch(silver.clean(batch), "s-0", f"{lake}/clean", f"{lake}/quarantine")
    assert len(load(spark, lake, "raw")) == 3 and not tables.table_exists(spark, f"{lake}/bad")
    assert load(spark, lake, "clean") == [("a", 1), ("a", 2)] and len(load(spark, lake, "quarantine")) == 1
    jobs.write_clean_batch(silver.clean(batch), "s-1", f"{lake}/clean", f"{lake}/quarantine")
    assert load(spark, lake, "clean") == [("a", 1), ("a", 2)]


def test_an_interrupted_batch_is_replaced_whole(spark, lake):
    batch = silver.clean(raw(spark, {"event_id": "a"}, {"event_id": "a", "place": "same id", "kafka_offset": 2}))
    # What a crash in the middle of a commit may leave: one of the two rows.
    tables.write_batch(batch.where("kafka_offset = 1").select(*SILVER_COLUMNS), f"{lake}/clean", "s-0")
    assert jobs.upsert_batch(batch.select(*SILVER_COLUMNS), "s-0", f"{lake}/clean") == 2
    assert load(spark, lake, "clean") == [("a", 1), ("a", 2)]


def test_streams_need_utc(spark, lake, setting):
    send(lake, raw(spark, {}))
    setting("spark.sql.session.timeZone", "Asia/Tokyo")
    with pytest.raises(ValueError):
        drain(spark, lake)


def test_processing_time_trigger(spark, lake):
    send(lake, raw(spark, {}))
    source = messages.folder_stream(spark, f"{lake}/messages")
    query = jobs.start_raw_stream(source, f"{lake}/raw", f"{lake}/bad", f"{lake}/c", available_now=False, processing_time="1 second")
    try:
        query.processAllAvailable()
        assert query.name == "messages_to_raw" and len(load(spark, lake, "raw")) == 1
    finally:
        query.stop()


def test_every_batch_is_stored_in_the_order_of_the_contract(spark, lake):
    for i in range(2):
        rows = silver.clean(raw(spark, {"event_id": f"e{i}", "place": f"p{i}"}))
        jobs.upsert_batch(rows.select(*SILVER_COLUMNS), f"s-{i}", f"{lake}/clean")
        assert spark.read.parquet(f"{lake}/clean/batch=s-{i}").columns == SILVER_COLUMNS


def test_a_raw_batch_written_anew_is_quarantined_once(spark, lake):
    send(lake, raw(spark, {"event_id": "a"}, BAD, {**BAD, "event_id": None, "place": "P", "kafka_offset": 7}, {**BAD, "event_id": "other", "kafka_offset": 9}))
    drain(spark, lake)
    before = load(spark, lake, "quarantine")
    assert len(before) == 2 and len(load(spark, lake, "raw")) == 3
    # A crash before the stream's commit: the batch is written again, to new files under its own name.
    (name,) = {r[0] for r in spark.read.parquet(f"{lake}/raw").select("batch").collect()}
    parsed = bronze.parse_messages(spark.read.parquet(f"{lake}/messages"))
    jobs.write_raw_batch(parsed, name, f"{lake}/raw", f"{lake}/bad")
    drain(spark, lake)
    assert load(spark, lake, "quarantine") == before and len(load(spark, lake, "raw")) == 3 and len(load(spark, lake, "clean")) == 1
    # Delivered again it is a message of its own; with a new checkpoint all are read again and known.
    send(lake, raw(spark, {**BAD, "kafka_offset": 21}))
    drain(spark, lake)
    assert len(load(spark, lake, "quarantine")) == 3
    drain(spark, lake, tag="-other")
    assert len(load(spark, lake, "quarantine")) == 3


def test_quarantine_compares_overlapping_batches_only(spark, lake, monkeypatch):
    def invalid(*offsets):
        return silver.quarantined_records(silver.clean(raw(spark, *({**BAD, "kafka_offset": i} for i in offsets)))).select(*SILVER_COLUMNS)

    path = f"{lake}/quarantine"
    assert [jobs.quarantine_batch(invalid(*x), f"s-{i}", path) for i, x in enumerate([(1, 2), (5, 6), (8,), (2, 7), (2, 7)])] == [2, 2, 1, 1, 0]
    assert jobs.quarantine_batch(invalid(2, 7), "s-3", path) == 1  # a replay decides as before
    assert sorted(r["kafka_offset"] for r in spark.read.parquet(path).collect()) == [1, 2, 5, 6, 7, 8]


def test_a_raw_batch_is_not_held(spark, lake, monkeypatch):
    """A cache would hold all payloads of a batch, parsed, however large it is."""
    send(lake, raw(spark, {"event_id": "a"}, {"event_id": "b", "kafka_offset": 3}), "{bad", '{"place":"no id"}')
    monkeypatch.setattr(jobs, "_kept", lambda df: pytest.fail("held"))
    parsed = bronze.parse_messages(spark.read.parquet(f"{lake}/messages"))
    jobs.write_raw_batch(parsed, "s-0", f"{lake}/raw", f"{lake}/bad")
    assert [r["event_id"] for r in load(spark, lake, "raw")] == ["a", "b"] and tables.read_table(spark, f"{lake}/bad").count() == 2


def test_a_clean_batch_takes_no_memory_and_its_copies_go(spark, lake, monkeypatch):
    """A cache would hold all rows of a batch twice, cleaned and without copies, however large it is."""
    first = silver.clean(raw(spark, {"event_id": "a"}, {"event_id": "a", "kafka_offset": 2}, BAD))
    monkeypatch.setattr(type(first), "persist", lambda *_: pytest.fail("held"))
    jobs.write_clean_batch(first, "s-0", f"{lake}/clean", f"{lake}/quarantine")
    again = silver.clean(raw(spark, {"event_id": "a", "kafka_offset": 5}, {"event_id": "b", "place": "B", "kafka_offset": 6}, {**BAD, "kafka_offset": 7}))
    jobs.write_clean_batch(again, "s-1", f"{lake}/clean", f"{lake}/quarantine")
    assert load(spark, lake, "clean") == [("a", 1), ("b", 6)] and len(load(spark, lake, "quarantine")) == 2
    nobody = silver.clean(raw(spark, BAD)).limit(0)
    jobs.write_clean_batch(nobody, "s-2", f"{lake}/clean", f"{lake}/quarantine")
    assert jobs.upsert_batch(nobody.select(*SILVER_COLUMNS), "s-3", f"{lake}/clean") == 0
    assert not [n for n in Folders(spark, shared_folder(spark)).names() if n.startswith(("cleaned-", "candidates-"))]


def test_the_first_batch_is_not_looked_up(spark, lake, monkeypatch):
    monkeypatch.setattr(KeyIndex, "held", lambda *_, **__: pytest.fail("looked up"))
    rows = silver.clean(raw(spark, {"event_id": "a"}, {"event_id": "a", "place": "same id", "kafka_offset": 2})).select(*SILVER_COLUMNS)
    for _ in range(2):  # a replay finds its own keys only
        assert jobs.upsert_batch(rows, "s-0", f"{lake}/clean") == 2
