import pytest

from eventlake.operators import bronze, silver
from eventlake.schemas import BAD_RECORD_COLUMNS, BRONZE_COLUMNS, ENVELOPE_SCHEMA, SILVER_COLUMNS
from tests.helpers import BAD, BOUNDARIES, raw


def parse(spark, *payloads):
    rows = [("t", 0, i, None, b"k", p if p is None else p.encode()) for i, p in enumerate(payloads)]
    return bronze.parse_messages(spark.createDataFrame(rows, ENVELOPE_SCHEMA))


def test_parse_and_route(spark):
    parsed = parse(
        spark,
        '{"event_id":"e","magnitudo":2.50,"place":{"a":1},"unknown":1}',
        "{bad",
        "[]",
        "null",
        "7",
        None,
        '{"place":"no id"}',
        '{"event_id":null}',
    )
    good = bronze.good_records(parsed)
    assert good.columns == BRONZE_COLUMNS
    (row,) = good.collect()
    assert (row["event_id"], row["magnitudo"], row["place"], row["kafka_offset"]) == ("e", "2.5", '{"a":1}', 0)
    bad = bronze.bad_records(parsed)
    assert bad.columns == BAD_RECORD_COLUMNS
    assert [r["raw_json"] for r in bad.orderBy("kafka_offset").collect()] == [
        "{bad", "[]", "null", "7", None, '{"place":"no id"}', '{"event_id":null}',
    ]


def test_clean_types(spark):
    cleaned = silver.clean(raw(spark, {}))
    assert cleaned.columns == SILVER_COLUMNS
    good = cleaned.first()
    assert (good["status"], good["data_type"], good["state"], good["place"]) == ("status", "type", "First", "Place")
    assert (good["year"], good["month"], good["day"], good["hour"]) == (1970, 1, 2, 0)
    assert good["is_valid_record"] and good["quality_score"] == 100


@pytest.mark.parametrize("flag", BOUNDARIES)
def test_each_flag_at_both_sides_of_its_limit(spark, flag):
    column, inside, beyond, points, valid = BOUNDARIES[flag]
    rows = silver.clean(raw(spark, *({column: v, "event_id": f"{i:02}"} for i, v in enumerate([*inside, *beyond])))).orderBy("event_id").collect()
    flags = [{f for f in BOUNDARIES if r[f]} for r in rows]
    assert flags == [set()] * len(inside) + [{flag}] * len(beyond)
    assert [r["quality_score"] for r in rows] == [100] * len(inside) + [100 - points] * len(beyond)
    assert [r["is_valid_record"] for r in rows] == [True] * len(inside) + [valid] * len(beyond)


def test_missing_values(spark):
    nothing = {c: None for c in ("time", "place", "state", "longitude", "latitude", "depth", "date", "magnitudo", "tsunami")}
    row = silver.clean(raw(spark, nothing)).first()
    assert row["state"] == "unknown" and row["negative_depth"] is None and row["event_timestamp"] is None
    assert row["quality_score"] == 5 and row["is_valid_record"] is False
    assert silver.clean(raw(spark, {"state": ""})).first()["state"] == ""


def test_nan_and_bad_text(spark):
    rows = silver.clean(raw(spark, {"latitude": "NaN"}, {"magnitudo": "NaN"}, {"tsunami": "0.0", "significance": "x"})).collect()
    assert rows[0]["invalid_latitude"] and not rows[0]["is_valid_record"]
    assert rows[1]["is_valid_record"] and rows[1]["magnitudo"] != rows[1]["magnitudo"]
    assert rows[2]["tsunami"] == 0 and rows[2]["significance"] is None and rows[2]["is_valid_record"]


def test_record_without_timestamp_is_valid(spark):
    row = silver.clean(raw(spark, {"date": None, "time": None})).first()
    assert row["event_timestamp"] is None and row["is_valid_record"]


def test_routing_is_complete(spark):
    cleaned = silver.clean(raw(spark, {}, BAD, {"depth": None}))
    assert silver.valid_records(cleaned).count() == 1 and silver.quarantined_records(cleaned).count() == 2
