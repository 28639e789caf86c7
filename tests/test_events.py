import csv
import json
import uuid

import pytest
from pyspark.sql import functions as F

from eventlake.operators import events
from eventlake.schemas import EVENT_COLUMNS, RAW_COLUMNS
from eventlake.sources import csv_events, messages
from tests.helpers import GOOD, raw


def write_file(path, rows, columns=RAW_COLUMNS):
    with open(path, "w", encoding="utf-8", newline="") as file:
        writer = csv.DictWriter(file, columns, extrasaction="ignore")
        writer.writeheader()
        writer.writerows(rows)


def identity(source, number, row):
    parts = [source, number] + [(row[c] or "").strip() for c in ("time", "place", "date")]
    return str(uuid.uuid5(uuid.NAMESPACE_URL, "|".join(map(str, parts))))


def test_normalise_strips_all_white_space(spark):
    df = events.normalise(raw(spark, {"place": " \t a b \n", "state": "  ", "status": "", "depth": None}))
    row = df.first()
    assert (row["place"], row["state"], row["status"], row["depth"]) == ("a b", None, None, None)


def test_white_space_is_what_python_strips(spark):
    assert sorted(events.WHITE_SPACE) == [chr(i) for i in range(0x110000) if chr(i).isspace()]
    row = events.normalise(raw(spark, {"place": "\u3000\xa0 ö \u2003", "state": "\xa0", "status": " \u200b"})).first()
    assert (row["place"], row["state"], row["status"]) == ("ö", None, "\u200b")


def test_event_has_all_fields_and_a_stable_id(spark):
    rows = raw(spark, {}, {}, {"time": None, "place": None, "date": None})
    built = events.build_events(rows, source_file=F.lit("f.csv"), row_number=F.lit(1))
    assert built.columns == EVENT_COLUMNS
    first, second, third = built.collect()
    assert first["event_id"] == second["event_id"] == identity("f.csv", 1, GOOD)
    assert third["event_id"] == str(uuid.uuid5(uuid.NAMESPACE_URL, "f.csv|1|||"))
    assert first["magnitudo"] == "2" and first["source_file"] == "f.csv"
    assert first["ingested_at"].endswith("+00:00")
    unknown = events.build_events(rows, source_file=F.lit("f.csv"), row_number=F.lit(None)).first()
    assert unknown["event_id"] == identity("f.csv", "unknown-row", GOOD)


def test_message_key_and_value(spark):
    df = raw(spark, {"state": "Muğla"}, {"state": ""}, {"state": None, "place": 'a "b"'})
    rows = events.to_messages(df).collect()
    assert [r["key"] for r in rows] == ["Muğla", "good", "good"]
    value = json.loads(rows[2]["value"])
    assert list(value) == EVENT_COLUMNS and value["state"] is None and value["place"] == 'a "b"'
    assert "Muğla" in rows[0]["value"] and ": " not in rows[0]["value"].split('"place"')[0]


def test_csv_ordinals_across_splits_and_files(spark, tmp_path, setting):
    folder = tmp_path / "csv"
    folder.mkdir()
    expected = {}
    for name, count in (("a.csv", 3000), ("b.csv", 701), ("c.csv", 0)):
        rows = [{c: f"{c}-{i}" for c in RAW_COLUMNS} | {"place": f'{name} {i}, "q"'} for i in range(1, count + 1)]
        write_file(folder / name, rows)
        expected |= {r["place"]: i for i, r in enumerate(rows, 1)}
    setting("spark.sql.files.maxPartitionBytes", "20000")
    scan = csv_events.scan_csv(spark, str(folder))
    assert scan.select("_path", "_block").distinct().count() > 10
    numbered = {r["place"]: r["row_number"] for r in csv_events.read_csv_rows(spark, str(folder)).collect()}
    assert numbered == expected
    first = csv_events.read_csv_rows(spark, str(folder), max_rows=5).collect()
    assert sorted(r["row_number"] for r in first) == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    built = events.build_events(csv_events.read_csv_rows(spark, str(folder))).where("place = 'b.csv 700, \"q\"'").first()
    assert built["source_file"] == "b.csv"
    assert built["event_id"] == identity("b.csv", 700, {"time": "time-700", "place": 'b.csv 700, "q"', "date": "date-700"})


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    write_file(tmp_path / "m.csv", [GOOD | {"place": "two\nlines"}, GOOD])
    rows = csv_events.read_csv_rows(spark, str(tmp_path / "m.csv"), multi_line=True).orderBy("row_number").collect()
    assert [r["place"] for r in rows] == ["two\nlines", " Place "]


def test_csv_needs_all_columns_and_ignores_others(spark, tmp_path):
    write_file(tmp_path / "more.csv", [GOOD | {"extra": "e"}], [*RAW_COLUMNS, "extra"])
    assert "extra" not in csv_events.read_csv_rows(spark, str(tmp_path / "more.csv")).columns
    write_file(tmp_path / "less.csv", [GOOD], RAW_COLUMNS[:-1])
    with pytest.raises(ValueError, match="date"):
        csv_events.scan_csv(spark, str(tmp_path / "less.csv"))


def test_publish_to_a_folder_topic(spark, lake):
    messages.publish_folder(events.to_messages(raw(spark, {}, {"state": "B"})), f"{lake}/topic", "events", partitions=4)
    rows = spark.read.parquet(f"{lake}/topic").collect()
    assert {r["topic"] for r in rows} == {"events"} and all(0 <= r["partition"] < 4 for r in rows)
    assert len({(r["partition"], r["offset"]) for r in rows}) == 2


def test_offsets_go_on_over_publishes(spark, lake):
    path = f"{lake}/topic"
    sent = events.to_messages(raw(spark, {}, {"state": "B"}, {"state": "C"}).repartition(3))
    for n in range(1, 4):
        messages.publish_folder(sent, path, "events")
        rows = spark.read.parquet(path).collect()
        assert len(rows) == 3 * n and len({r["offset"] for r in rows}) == 3 * n
    # A publish that ended before it left its mark: files are there that the last mark has not seen.
    given = spark.read.parquet(path).limit(1).selectExpr("topic", "partition", "CAST(1000000000000 AS bigint) AS offset", "timestamp", "key", "value")
    given.write.mode("append").parquet(path)
    messages.publish_folder(sent, path, "events")
    offsets = [r["offset"] for r in spark.read.parquet(path).collect()]
    assert len(set(offsets)) == len(offsets) == 13 and max(offsets) > 10**12
