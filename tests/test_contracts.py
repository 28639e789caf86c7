import pytest

from eventlake import schemas
from eventlake.schemas import BRONZE_COLUMNS, FEATURE_COLUMNS, RAW_COLUMNS, SILVER_COLUMNS, conform
from eventlake.session import require_utc
from eventlake.sources import tables


def test_raw_columns_in_order():
    assert RAW_COLUMNS == "time place status tsunami significance data_type magnitudo state longitude latitude depth date".split()


def test_layers_extend_each_other():
    assert BRONZE_COLUMNS[:12] == RAW_COLUMNS
    assert BRONZE_COLUMNS[12:] == "event_id ingested_at source_file kafka_topic kafka_partition kafka_offset kafka_timestamp".split()
    assert SILVER_COLUMNS[:19] == BRONZE_COLUMNS
    assert (len(BRONZE_COLUMNS), len(SILVER_COLUMNS), len(FEATURE_COLUMNS)) == (19, 32, 25)
    assert schemas.EVENT_SCHEMA.names == schemas.EVENT_COLUMNS


def test_conform_orders_and_names_what_is_missing(spark):
    df = spark.range(1).selectExpr("1 AS b", "2 AS a", "3 AS c")
    assert conform(df, ["a", "b"], "layer").columns == ["a", "b"]
    with pytest.raises(ValueError, match=r"layer.*'x'"):
        conform(df, ["a", "x"], "layer")


def test_utc_is_required(spark, setting):
    require_utc(spark)
    setting("spark.sql.session.timeZone", "Europe/Berlin")
    with pytest.raises(ValueError, match="Europe/Berlin"):
        require_utc(spark)


def test_tables(spark, lake):
    path = f"{lake}/t"
    assert not tables.table_exists(spark, path)
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path)
    with pytest.raises(FileNotFoundError):
        tables.first_existing(spark, [path])
    assert tables.write_table(spark.range(5), path) == 5
    assert tables.write_table(spark.range(3).selectExpr("id", "id AS more"), path, mode="append") == 3
    assert tables.read_table(spark, path, merge_schema=True).selectExpr("sum(more)").first()[0] == 3
    assert tables.first_existing(spark, [f"{lake}/none", path]).count() == 8
    assert tables.write_table(spark.range(2).selectExpr("id AS other"), path) == 2
    assert tables.read_table(spark, path).columns == ["other"]
    with pytest.raises(ValueError, match="empty"):
        tables.require_rows(spark.range(0), "it")


def test_counts_of_empty_writes(spark, lake):
    nothing = spark.range(5).where("false")
    assert tables.write_table(nothing, f"{lake}/a") == 0
    assert tables.write_batch(nothing, f"{lake}/b", "s-0") == 0
    assert tables.write_batch(spark.range(5), f"{lake}/b", "s-0") == 5
    emptied = spark.range(1000).repartition(3).join(spark.range(1000).repartition(3), "id", "left_anti")
    assert tables.write_batch(emptied, f"{lake}/b", "s-1") == 0
    assert tables.read_table(spark, f"{lake}/b").count() == 5


def test_a_hot_partition_is_split_and_small_ones_are_not(spark, lake, setting):
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    rows = spark.range(60000).selectExpr("CASE WHEN id % 10 = 0 THEN id % 7 ELSE 100 END AS year", "uuid() AS payload")
    tables.write_table(rows, f"{lake}/t", partition_by=["year"])
    files = tables.read_table(spark, f"{lake}/t").groupBy("year").agg({"*": "count"}).count()
    assert files == 8
    per_year = spark.read.parquet(f"{lake}/t").selectExpr("year", "_metadata.file_path AS f").distinct().groupBy("year").count()
    counts = {r["year"]: r["count"] for r in per_year.collect()}
    assert counts[100] > 4
    assert all(n <= 2 for year, n in counts.items() if year != 100)
