import json

import pytest

from eventlake.operators import gold, silver
from eventlake.plans import lakehouse
from eventlake.schemas import BRONZE_COLUMNS, FEATURE_COLUMNS, FEATURE_SCHEMA, RISK_SCHEMA, SILVER_COLUMNS, SILVER_SCHEMA
from eventlake.sources.compaction import batches_of
from eventlake.sources.messages import KafkaTopic, folder_stream, publish_folder
from eventlake.sources.tables import BATCH_COLUMN, read_table
from tests.helpers import BAD, raw
from tests.test_events import write_file


def test_from_csv_to_predictions(spark, tmp_path, monkeypatch):
    small = {"models": ["linear_regression_baseline"]}, {"models": ["logistic_regression_baseline"]}
    train = lakehouse.train
    monkeypatch.setattr(lakehouse, "train", lambda task, *a: train(task, *a, **small[task is lakehouse.CLASSIFICATION]))
    rows = [
        {
            "time": str(1704069153990 + i * 3600_000), "place": f" Place {i} ", "status": "Reviewed", "tsunami": str(int(i % 4 == 0)),
            "significance": str(i % 900), "data_type": "earthquake", "magnitudo": f"{3 + i % 5}.5", "state": f"S{i % 7}",
            "longitude": str(i % 180), "latitude": str(i % 90), "depth": "" if i % 50 == 0 else str(i % 400), "date": "",
        }
        for i in range(400)
    ]
    (tmp_path / "csv").mkdir()
    write_file(tmp_path / "csv" / "events.csv", rows)
    lake = lakehouse.Layout(str(tmp_path / "lake"))

    with pytest.raises(FileNotFoundError):
        lakehouse.refine(spark, lake)
    with pytest.raises(FileNotFoundError):
        lakehouse.report_quality(spark, lake)
    lakehouse.publish_csv(spark, str(tmp_path / "csv"), lake)
    lakehouse.ingest(spark, lake)
    assert read_table(spark, lake.raw).columns == [*BRONZE_COLUMNS, BATCH_COLUMN]
    raw_report = {r["metric"]: r["value"] for r in lakehouse.report_quality(spark, lake).where("key IS NULL").collect()}
    assert raw_report["total_record_count"] == "400" and raw_report["negative_depth_count"] == "0"

    lakehouse.refine(spark, lake)
    clean = read_table(spark, lake.clean)
    assert clean.columns == [*SILVER_COLUMNS, BATCH_COLUMN] and clean.count() == 392
    assert read_table(spark, lake.quarantine).count() == 8
    clean_report = {r["metric"]: r["value"] for r in lakehouse.report_quality(spark, lake).where("key IS NULL").collect()}
    assert clean_report["total_record_count"] == "392" and "generated_at" in clean_report

    counts = lakehouse.build_analytics(spark, lake)
    assert counts == {"features": 392, "daily_aggregates": 17, "state_aggregates": 7, "tsunami_risk": 392}
    assert sorted(read_table(spark, lake.features).columns) == sorted(FEATURE_COLUMNS)

    results = lakehouse.train_models(spark, lake)
    assert set(results) == {"magnitude_regression", "tsunami_classification"}
    assert lakehouse.score(spark, lake) == {"magnitude_regression": 392, "tsunami_classification": 392}
    lakehouse.summarise_runs(spark, lake)
    summary = spark.read.option("header", True).option("escape", '"').csv(f"{lake.reports}/run_summary")
    assert summary.count() == 2 and {"metric_rmse", "metric_f1", "param_model_name"} <= set(summary.columns)
    (document,) = [json.loads(r["value"]) for r in spark.read.text(f"{lake.reports}/data_quality_report_json").collect()]
    assert document["total_record_count"] == 392 and document["null_counts"]["event_id"] == 0 and document["yearly_record_count"]


def test_features_stay_when_nothing_is_usable(spark, lake):
    layout = lakehouse.Layout(lake)
    silver.clean(raw(spark, {})).write.parquet(layout.clean)
    assert lakehouse.build_analytics(spark, layout)["features"] == 1
    silver.clean(raw(spark, BAD)).write.mode("overwrite").parquet(layout.clean)
    with pytest.raises(ValueError, match="usable"):
        lakehouse.build_analytics(spark, layout)
    assert spark.read.parquet(layout.features).count() == 1


def test_without_runs_nothing_is_scored(spark, lake):
    layout = lakehouse.Layout(lake)
    silver.clean(raw(spark, {})).write.parquet(layout.clean)
    lakehouse.build_analytics(spark, layout)
    assert set(lakehouse.score(spark, layout).values()) == {None}
    lakehouse.summarise_runs(spark, layout)


def csv_rows(start, count):
    return [
        {
            "time": str(1704069153990 + i * 3600_000), "place": f"Place {i}", "status": "reviewed", "tsunami": str(i % 2), "significance": str(i % 900),
            "data_type": "earthquake", "magnitudo": f"{3 + i % 5}.5", "state": f"S{i % 7}", "longitude": str(i % 180), "latitude": str(i % 90),
            "depth": "" if i % 10 == 0 else "5", "date": "",
        }
        for i in range(start, start + count)
    ]


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_jobs_in_any_format_with_packed_tables(spark, tmp_path, fmt, caplog):
    lake = lakehouse.Layout(str(tmp_path / "lake"), fmt=fmt)
    for n in range(4):
        (tmp_path / f"csv{n}").mkdir()
        write_file(tmp_path / f"csv{n}" / f"events{n}.csv", csv_rows(n * 30, 40))  # ten of each file are in the next one too
        lakehouse.publish_csv(spark, str(tmp_path / f"csv{n}"), lake)
        lakehouse.ingest(spark, lake)
        lakehouse.refine(spark, lake, pack_over=1)
    assert spark.read.format(fmt).load(f"{lake.clean}_packed").count() > 0 and spark.read.format(fmt).load(f"{lake.raw}_packed").count() > 0
    assert len(batches_of(spark, lake.raw)) == len(batches_of(spark, lake.clean)) == 2
    count = lambda path: read_table(spark, path, fmt=fmt).count()
    # Of 130 events 13 have no depth; the quarantine holds each delivery of one, sixteen in all.
    assert (count(lake.raw), count(lake.clean), count(lake.quarantine)) == (160, 117, 16)
    with caplog.at_level("INFO", logger="eventlake.plans.lakehouse"):
        assert lakehouse.build_analytics(spark, lake)["features"] == 117
    assert [r.getMessage() for r in caplog.records] == ["tsunami=0: 52 rows", "tsunami=1: 65 rows"]
    features = read_table(spark, lake.features, fmt=fmt, schema=FEATURE_SCHEMA)
    assert {f.name: f.dataType for f in features.schema} == {f.name: f.dataType for f in FEATURE_SCHEMA}
    lakehouse.report_quality(spark, lake)


def test_declared_schemas_are_those_of_the_operators(spark):
    cleaned = silver.clean(raw(spark, {})).select(*SILVER_COLUMNS)
    features = gold.feature_table(cleaned)
    for made, declared in ((cleaned, SILVER_SCHEMA), (features, FEATURE_SCHEMA), (gold.tsunami_risk_set(features), RISK_SCHEMA)):
        assert [(f.name, f.dataType) for f in made.schema] == [(f.name, f.dataType) for f in declared]


def test_jobs_use_the_topic_they_are_given(spark, tmp_path, monkeypatch):
    topic = KafkaTopic("broker:9092", "quakes")
    assert topic.read_options() == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "quakes", "startingOffsets": "earliest", "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "500000000",
    }
    assert "maxOffsetsPerTrigger" not in KafkaTopic("b", "t", "latest", None).read_options() and topic.write_options()["topic"] == "quakes"
    lake = lakehouse.Layout(str(tmp_path / "lake"), kafka=topic)
    sent = []
    # No broker here: what would be sent goes to a folder, and the stream reads that folder.
    monkeypatch.setattr(lakehouse, "publish_kafka", lambda df, to: (sent.append(to), publish_folder(df, lake.messages, to.topic)))
    monkeypatch.setattr(lakehouse, "kafka_stream", lambda session, of: (sent.append(of), folder_stream(session, lake.messages))[1])
    (tmp_path / "csv").mkdir()
    write_file(tmp_path / "csv" / "events.csv", csv_rows(0, 5))
    lakehouse.publish_csv(spark, str(tmp_path / "csv"), lake)
    lakehouse.ingest(spark, lake)
    assert sent == [topic, topic] and {r[0] for r in read_table(spark, lake.raw).select("kafka_topic").collect()} == {"quakes"}
