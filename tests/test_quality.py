import csv
import json
from glob import glob

from eventlake.operators import quality, silver
from tests.helpers import BAD, plan, raw


UNMEASURED = {"event_id": "unmeasured", "state": "Second", "magnitudo": None}


def as_dict(report):
    return {r["metric"]: r["value"] for r in quality.by_metric(report).collect()}


def test_report_on_the_clean_layer(spark):
    df = silver.clean(raw(spark, {}, UNMEASURED, {"event_id": "third", "magnitudo": "9"}))
    got = as_dict(quality.report(df, generated_at="now"))
    assert got["generated_at"] == "now" and got["total_record_count"] == "3"
    assert (got["invalid_latitude_count"], got["null_magnitudo_count"], got["negative_depth_count"]) == ("0", "1", "0")
    assert json.loads(got["null_counts"])["magnitudo"] == 1 and len(json.loads(got["null_counts"])) == 32
    assert json.loads(got["tsunami_distribution"]) == [{"tsunami": 0, "count": 3}]
    assert json.loads(got["yearly_record_count"]) == [{"year": 1970, "count": 3}]
    assert json.loads(got["top_states_by_event_count"]) == [{"state": "First", "count": 2}, {"state": "Second", "count": 1}]
    top = json.loads(got["top_magnitudo_records"])
    assert [t["event_id"] for t in top] == ["third", "good", "unmeasured"]
    assert top[0]["event_timestamp"] == "1970-01-02T00:00:00.000000" and top[2]["magnitudo"] is None


def test_report_on_the_raw_layer_is_null_or_empty_where_it_cannot_tell(spark):
    got = as_dict(quality.report(raw(spark, {}, {"latitude": "90.01"}, {"depth": "-0.01"}, {"depth": "-1"}, {"longitude": None})))
    assert [got[f"{m}_count"] for m in ("invalid_latitude", "invalid_longitude", "null_magnitudo", "negative_depth")] == ["1", "1", "0", "2"]
    assert got["yearly_record_count"] == "[]" and got["top_magnitudo_records"] == "[]"
    assert json.loads(got["tsunami_distribution"]) == [{"tsunami": "0", "count": 5}]


def test_report_on_a_table_without_any_known_column(spark):
    got = as_dict(quality.report(spark.range(3).withColumnRenamed("id", "x")))
    assert (got.pop("total_record_count"), got.pop("null_counts")) == ("3", '{"x":0}')
    assert {m for m, v in got.items() if v is None} == {"invalid_latitude_count", "invalid_longitude_count", "null_magnitudo_count", "negative_depth_count"}
    assert {m for m, v in got.items() if v == "[]"} == set(quality.LIST_METRICS) and set(got) == set(quality.METRICS[3:])


def test_the_report_reads_its_table_three_times(spark, lake):
    silver.clean(raw(spark, {}, BAD)).write.parquet(f"{lake}/t")
    text = plan(quality.report(spark.read.parquet(f"{lake}/t"), generated_at="now"))
    assert text.count("FileScan") == 3 and text.count("WindowGroupLimit") == 2


def test_counters_need_one_pass(spark, lake):
    silver.clean(raw(spark, {}, BAD)).write.parquet(f"{lake}/t")
    assert plan(quality.counters(spark.read.parquet(f"{lake}/t"))).count("FileScan") == 1
    assert plan(quality.top_values(spark.read.parquet(f"{lake}/t"), quality.DISTRIBUTION_LIMITS)).count("FileScan") == 1


def test_distributions(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, None), ("c", None), ("c", 3)], "s string, n int")
    assert quality.value_distribution(df, "s", 2).collect() == [("a", 2), ("c", 2)]
    assert quality.value_distribution(df, "absent").count() == 0
    assert quality.top_values(df, {"absent": 3}).count() == 0
    rows = sorted(quality.top_values(df, {"s": 2, "n": 1}).collect())
    assert [(r["column"], r["value"], r["count"], r["rank"]) for r in rows] == [("n", None, 2, 1), ("s", "a", 2, 1), ("s", "c", 2, 2)]


def test_write_report(spark, lake):
    quality.write_report(quality.report(silver.clean(raw(spark, {}, UNMEASURED))), lake)
    (path,) = glob(f"{lake}/data_quality_report_csv/*.csv")
    with open(path, newline="", encoding="utf-8") as file:
        rows = {r["metric"]: r["value"] for r in csv.DictReader(file)}
    assert rows["total_record_count"] == "2" and json.loads(rows["null_counts"])["magnitudo"] == 1
    (path,) = glob(f"{lake}/data_quality_report_json/*.txt")
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    assert list(told) == [m for m in quality.METRICS if m in rows]
    assert told["total_record_count"] == 2 and told["null_counts"]["magnitudo"] == 1 and told["null_magnitudo_count"] == 1
    assert told["yearly_record_count"] == [{"year": 1970, "count": 2}]
    assert told["top_magnitudo_records"][0]["magnitudo"] == 2.0 and told["top_magnitudo_records"][1]["magnitudo"] is None
    assert told["top_states_by_event_count"] == [{"state": "First", "count": 1}, {"state": "Second", "count": 1}]


def test_the_document_quotes_text_and_keeps_null(spark):
    rows = quality.by_metric(quality.report(spark.range(1).withColumnRenamed("id", 'a"b'), generated_at='no"w \\ ü'))
    told = json.loads(quality.document(rows).first()["document"])
    assert list(told) == list(quality.METRICS) and told["generated_at"] == 'no"w \\ ü' and told["null_counts"] == {'a"b': 0}
    assert told["negative_depth_count"] is None and told["status_distribution"] == []


def test_a_record_without_timestamp_hides_no_year(spark, lake):
    df = silver.clean(raw(spark, {}, {"date": None, "time": "NaN", "event_id": "b", "kafka_offset": 3}, {"date": "1971-05-05", "event_id": "c", "kafka_offset": 4}))
    years = {r["metric"]: r["value"] for r in quality.by_metric(quality.report(df)).collect()}["yearly_record_count"]
    assert json.loads(years) == [{"year": None, "count": 1}, {"year": 1970, "count": 1}, {"year": 1971, "count": 1}]
