"""The jobs in the order they run, each from tables to tables below one root folder."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime, timezone
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession

from eventlake.ml.data import classification_data, regression_data
from eventlake.ml.inference import write_predictions
from eventlake.ml.runs import read_runs, run_summary, write_csv
from eventlake.ml.training import CLASSIFICATION, REGRESSION, train
from eventlake.operators.events import build_events, to_messages
from eventlake.operators.gold import class_distribution, daily_aggregates, feature_table, state_aggregates, tsunami_risk_set, usable
from eventlake.operators.quality import report, write_report
from eventlake.schemas import BRONZE_COLUMNS, FEATURE_SCHEMA, RISK_SCHEMA, SILVER_COLUMNS, SILVER_SCHEMA
from eventlake.session import require_utc
from eventlake.sources.compaction import batches_of, pack, pack_quarantine, recover
from eventlake.sources.csv_events import read_csv_rows
from eventlake.sources.key_index import BUCKETS, KeyIndex, index_path
from eventlake.sources.messages import KafkaTopic, folder_stream, kafka_stream, publish_folder, publish_kafka, raw_layer_stream
from eventlake.sources.tables import SELF_DESCRIBED, first_existing, read_table, require_rows, table_exists, write_table
from eventlake.streaming.jobs import start_clean_stream, start_raw_stream

TABLES = (
    "messages",
    "raw",
    "bad_records",
    "clean",
    "quarantine",
    "features",
    "daily_aggregates",
    "state_aggregates",
    "tsunami_risk",
    "magnitude_predictions",
    "tsunami_predictions",
    "ml",
    "reports",
    "checkpoint_raw",
    "checkpoint_clean",
)

LOG = logging.getLogger(__name__)

#: Bounds a micro-batch, so that a backlog of any size is worked off in steps of about a terabyte.
FILES_PER_BATCH = 10_000
#: Folders of settled batches that a table may have before they are packed.
PACK_OVER = 500


class Layout(SimpleNamespace):
    """Paths of the tables of one lakehouse, e.g. ``Layout(root).features``, their format and where messages come from.

    ``fmt``: the format of all tables but the library's own books (key index, marks, run table). Without ``kafka`` messages
    are files in a folder.
    """

    def __init__(self, root: str, *, fmt: str = "parquet", kafka: KafkaTopic | None = None) -> None:
        super().__init__(root=root, fmt=fmt, kafka=kafka, **{name: f"{root}/{name}" for name in TABLES})


def publish_csv(spark: SparkSession, csv_path: str, lake: Layout, *, topic: str = "events", max_rows: int = 0) -> None:
    """CSV files to the topic."""
    sent = to_messages(build_events(read_csv_rows(spark, csv_path, max_rows=max_rows)))
    if lake.kafka is not None:
        publish_kafka(sent, lake.kafka)
    else:
        publish_folder(sent, lake.messages, topic)


def ingest(spark: SparkSession, lake: Layout, messages: DataFrame | None = None, *, files_per_batch: int = FILES_PER_BATCH) -> None:
    """Land the backlog of messages in the raw and bad-records tables."""
    if messages is not None:
        source = messages
    elif lake.kafka is not None:
        source = kafka_stream(spark, lake.kafka)
    else:
        source = folder_stream(spark, lake.messages, max_files_per_trigger=files_per_batch)
    start_raw_stream(source, lake.raw, lake.bad_records, lake.checkpoint_raw, fmt=lake.fmt).awaitTermination()


def refine(spark: SparkSession, lake: Layout, *, files_per_batch: int = FILES_PER_BATCH, pack_over: int = PACK_OVER) -> None:
    """Upsert new raw records into the clean table and quarantine invalid ones.

    Afterwards tables with more than ``pack_over`` settled batches are packed: of the raw table those that were there when the
    stream began, which it has read to the end.
    """
    if not table_exists(spark, lake.raw, lake.fmt):
        raise FileNotFoundError(f"no raw table at {lake.raw}, ingest messages first")
    folders = lake.fmt not in SELF_DESCRIBED
    if folders:
        for path in (lake.raw, lake.bad_records, lake.clean, lake.quarantine):
            recover(spark, path)
    read = batches_of(spark, lake.raw) if folders else []
    stream = raw_layer_stream(spark, lake.raw, max_files_per_trigger=files_per_batch, fmt=lake.fmt)
    start_clean_stream(stream, lake.clean, lake.quarantine, lake.checkpoint_clean, fmt=lake.fmt).awaitTermination()
    if folders:
        compact(spark, lake, over=pack_over, raw_batches=read)


def compact(spark: SparkSession, lake: Layout, *, over: int = 0, raw_batches: Sequence[str] = ()) -> None:
    """Pack the settled batches of the streams' tables, and the key index with the clean table.

    ``raw_batches``: those of the raw table that its stream has read. Formats with a log of their own compact themselves.
    """

    def enter(name: str, batches: list[str]) -> None:
        KeyIndex(spark, index_path(lake.clean), BUCKETS).note([name])

    pack(spark, lake.raw, over=over, only=raw_batches, fmt=lake.fmt)
    pack(spark, lake.bad_records, over=over, fmt=lake.fmt)
    pack_quarantine(spark, lake.quarantine, over=over, fmt=lake.fmt)
    if pack(spark, lake.clean, over=over, before=enter, fmt=lake.fmt):
        KeyIndex(spark, index_path(lake.clean), BUCKETS).compact()


def _clean_layer(spark: SparkSession, lake: Layout) -> DataFrame:
    return read_table(spark, lake.clean, fmt=lake.fmt, schema=SILVER_SCHEMA)


def _features(spark: SparkSession, lake: Layout) -> DataFrame:
    return read_table(spark, lake.features, fmt=lake.fmt, schema=FEATURE_SCHEMA)


def build_analytics(spark: SparkSession, lake: Layout) -> dict[str, int]:
    """Write the four analytic tables and return their row counts.

    The feature table is written first and the others read it back: each needs only a few of its
    columns, so that costs less than holding all features in executor memory. The distribution of the classes is logged.
    """
    require_utc(spark)
    clean_df = _clean_layer(spark, lake)
    require_rows(usable(clean_df), "clean layer, as far as usable,")  # before the stored features are replaced
    counts = {"features": write_table(feature_table(clean_df), lake.features, partition_by=["year"], fmt=lake.fmt)}
    features = _features(spark, lake)
    counts["daily_aggregates"] = write_table(daily_aggregates(features), lake.daily_aggregates, fmt=lake.fmt)
    counts["state_aggregates"] = write_table(state_aggregates(features), lake.state_aggregates, fmt=lake.fmt)
    counts["tsunami_risk"] = write_table(tsunami_risk_set(features), lake.tsunami_risk, fmt=lake.fmt)
    for row in class_distribution(features).orderBy("tsunami").collect():  # one row per class
        LOG.info("tsunami=%s: %s rows", row["tsunami"], row["count"])
    return counts


def report_quality(spark: SparkSession, lake: Layout) -> DataFrame:
    """Report on the clean layer, or on the raw layer while there is no clean one."""
    source = first_existing(spark, [lake.clean, lake.raw], lake.fmt)
    layer = [c for c in SILVER_COLUMNS if c in source.columns] or BRONZE_COLUMNS
    stamp = datetime.now(timezone.utc).replace(tzinfo=None).isoformat() + "Z"
    result = report(source.select(*layer), generated_at=stamp)
    write_report(result, lake.reports)
    return result


def train_models(spark: SparkSession, lake: Layout) -> dict[str, list[dict]]:
    """Train both families; the best model of each comes first."""
    return {
        REGRESSION.experiment: train(REGRESSION, regression_data(_features(spark, lake)), lake.ml),
        CLASSIFICATION.experiment: train(CLASSIFICATION, classification_data(read_table(spark, lake.tsunami_risk, fmt=lake.fmt, schema=RISK_SCHEMA)), lake.ml),
    }


def score(spark: SparkSession, lake: Layout) -> dict[str, int | None]:
    """Score the feature table with the best run of each family."""
    features, runs = _features(spark, lake), read_runs(spark, f"{lake.ml}/runs")
    targets = {REGRESSION: lake.magnitude_predictions, CLASSIFICATION: lake.tsunami_predictions}
    return {task.experiment: write_predictions(task, features, runs, path, lake.fmt) for task, path in targets.items()}


def summarise_runs(spark: SparkSession, lake: Layout) -> None:
    write_csv(run_summary(read_runs(spark, f"{lake.ml}/runs")), f"{lake.reports}/run_summary")
