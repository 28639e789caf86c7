import math
import random
import statistics
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventlake.operators import gold, profile, ranking, silver
from eventlake.schemas import FEATURE_COLUMNS, RISK_COLUMNS
from tests.helpers import BAD, plan, raw


def features(spark, *rows):
    return gold.feature_table(silver.clean(raw(spark, *rows)))


def test_features_gate_flags_and_index(spark):
    rows = [
        {"event_id": "a", "state": "B", "depth": "0", "significance": "500", "tsunami": "1"},
        {"event_id": "b", "state": "B", "depth": "70", "significance": "499"},
        {"event_id": "c", "state": "A", "depth": "300", "significance": None, "tsunami": None},
        {"event_id": "d", "state": None, "depth": "-1"},
        {"event_id": "e", "date": None, "time": None},
        BAD,
    ]
    df = features(spark, *rows)
    assert df.columns == FEATURE_COLUMNS
    got = {r["event_id"]: r for r in df.collect()}
    assert set(got) == set("abcd")
    assert {k: r["state_index"] for k, r in got.items()} == {"a": 0.0, "b": 0.0, "c": 1.0, "d": 2.0}
    flags = ("is_shallow", "is_medium_depth", "is_deep", "is_high_significance", "is_tsunami")
    assert [got["a"][f] for f in flags] == [True, False, False, True, True]
    assert [got["b"][f] for f in flags] == [False, True, False, False, False]
    assert [got["c"][f] for f in flags] == [False, False, True, None, None]
    assert [got["d"][f] for f in flags] == [False, False, False, False, False]
    assert got["a"]["abs_longitude"] == 10


def test_index_matches_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    rng = random.Random(3)
    df = spark.createDataFrame([(rng.choice("aabbbcdefgg"),) for _ in range(300)], "state string")
    model = StringIndexer(inputCol="state", outputCol="i").fit(df)
    index = {r["state"]: r["i"] for r in ranking.frequency_index(df, "state", "i").collect()}
    assert index == {label: float(i) for i, label in enumerate(model.labels)}


def test_totals_before_over_many_ranges(spark, setting):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(5)
    data = [(k, rng.randrange(100)) for k in rng.sample(range(100_000), 5000)]
    df = spark.createDataFrame(data, "k bigint, n bigint").repartition(13)
    got = {r["k"]: r["n_before"] for r in ranking.totals_before(df, ["k"], ["n"]).collect()}
    before, expected = 0, {}
    for k, n in sorted(data):
        expected[k] = before
        before += n
    assert got == expected


def test_daily_and_state_aggregates(spark):
    df = features(
        spark,
        {"event_id": "a", "magnitudo": "2", "tsunami": "1", "significance": None},
        {"event_id": "b", "magnitudo": "4", "tsunami": None, "significance": "600", "state": "Z"},
    )
    day = gold.daily_aggregates(df).first()
    assert (day["event_count"], day["avg_magnitude"], day["tsunami_count"], day["high_significance_count"]) == (2, 3.0, 1, 1)
    states = gold.by_event_count(gold.state_aggregates(df)).collect()
    assert [(s["state"], s["event_count"]) for s in states] == [("First", 1), ("Z", 1)]


def test_risk_set_needs_known_values_and_keeps_nan(spark):
    df = features(spark, {"event_id": "a"}, {"event_id": "b", "tsunami": None}, {"event_id": "c", "magnitudo": "NaN"})
    risk = gold.tsunami_risk_set(df)
    assert risk.columns == RISK_COLUMNS and {r["event_id"] for r in risk.collect()} == {"a", "c"}


def test_gold_filters_reach_the_scan(spark, lake, setting):
    setting("spark.sql.maxMetadataValueLength", "1000")
    silver.clean(raw(spark, {}, BAD)).write.parquet(f"{lake}/clean")
    stored = spark.read.parquet(f"{lake}/clean")
    text = plan(gold.daily_aggregates(gold.with_feature_columns(gold.usable(stored))))
    assert "IsNotNull(event_timestamp)" in text and "EqualTo(is_valid_record,true)" in text
    assert "FileScan parquet [tsunami#" in text and text.split("FileScan parquet [")[1].split("]")[0].count("#") == 6


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(11)
    frame = pd.DataFrame(
        {
            "magnitudo": rng.normal(4, 2, 4000).round(2),
            "depth": np.where(rng.random(4000) < 0.4, 10.0, rng.random(4000) * 700),
            "significance": rng.integers(0, 900, 4000).astype("float"),
        }
    )
    frame.loc[frame.index % 17 == 0, "depth"] = np.nan
    df = spark.createDataFrame(frame).withColumn("depth", F.when(F.rand(1) < 2, F.col("depth")))
    return frame, df.repartition(7)


def test_numeric_profile_is_pandas_describe(sample):
    frame, df = sample
    got = profile.numeric_profile(df, list(frame.columns), digits=9).toPandas().set_index("column")
    expected = frame.describe()
    for column in frame.columns:
        assert np.allclose(got.loc[column].astype(float).to_numpy(), expected[column].to_numpy(), atol=1e-8)
    approximate = profile.numeric_profile(df, list(frame.columns), digits=9, accuracy=10000).toPandas().set_index("column")
    assert approximate.columns.tolist() == got.columns.tolist()
    assert np.allclose(approximate.loc["significance"].astype(float).to_numpy(), expected["significance"].to_numpy(), atol=1)


INF = float("inf")


@pytest.mark.parametrize(
    "values",
    [
        [3.0],
        [-0.0, 0.0, 0.0],
        [1.0, 2.0],
        [0.1 * i for i in range(50_000)],
        [1.0] * 5000 + [1.0 + 2**-52] * 5000 + [1e300],
        [(-1) ** i * 2.0 ** (i % 2000 - 1000) for i in range(9000)],
        [-(2.0 ** -(i % 1070)) for i in range(4001)],
        [-1.7e308, 1.7e308, 5e-324, -5e-324, 0.0],
        [-INF, -INF, 1.0, 2.0, INF],
        [INF, INF],
    ],
)
def test_quantiles_by_selection_are_those_of_the_sorted_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values + [None, float("nan")]], "x double").repartition(3)
    ranked = sorted(values)

    def at(q):
        place = q * (len(ranked) - 1)
        low, high = ranked[math.floor(place)], ranked[math.ceil(place)]
        return low if low == high else low + (high - low) * (place - math.floor(place))

    shares = {"q0": 0.0, "q25": 0.25, "q37": 0.37, "q50": 0.5, "q75": 0.75, "q100": 1.0}
    row = profile.exact_quantiles(df, ["x"], shares).first()
    got, expected = [row[name] for name in shares], [at(q) for q in shares.values()]
    assert [repr(g + 0.0) for g in got] == [repr(e + 0.0) for e in expected] and "-0.0" not in map(repr, got)


def test_selection_takes_few_passes_and_shuffles_counts_only(spark, monkeypatch, sample):
    frame, df = sample
    plans, select = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: plans.append(plan(self)) or select(self))
    profile.exact_quantiles(df, list(frame.columns), profile.QUARTILES)
    passes = [p for p in plans if "bracket" in p]
    assert 1 <= len(passes) <= 3
    for text in passes:
        moved = [line for line in text.splitlines() if "Exchange" in line and "RoundRobin" not in line and "REPARTITION" not in line]
        assert moved and all("hashpartitioning(bracket" in line for line in moved) and "rangepartitioning" not in text


def test_profile_of_an_empty_column(spark):
    row = profile.numeric_profile(spark.createDataFrame([(None,)], "x double"), ["x"]).first()
    assert row["count"] == 0 and row["q50"] is None


def test_histogram_is_numpy_histogram(sample, spark):
    frame, df = sample
    for column, group in profile.histogram(df, list(frame.columns)).toPandas().groupby("column"):
        counts, edges = np.histogram(frame[column].dropna(), bins=30)
        group = group.sort_values("bin")
        assert group["count"].tolist() == counts.tolist()
        assert np.allclose(group["low"], edges[:-1]) and np.allclose(group["high"], edges[1:])
    same = profile.histogram(spark.createDataFrame([(5.0,), (5.0,)], "x double"), ["x"]).toPandas().sort_values("bin")
    assert same["count"].tolist() == np.histogram([5.0, 5.0], bins=30)[0].tolist()
    assert profile.histogram(spark.createDataFrame([(None,)], "x double"), ["x"]).count() == 0
    with pytest.raises(ValueError, match="infinite"):
        profile.histogram(spark.createDataFrame([(1.0,), (float("inf"),)], "x double"), ["x"])


def test_missing_profile(sample):
    frame, df = sample
    rows = profile.missing_profile(df).collect()
    missing = int(frame["depth"].isna().sum())
    assert [(r["column"], r["missing_count"], r["missing_pct"], r["total_missing"]) for r in rows] == [
        ("depth", missing, round(missing / 40, 2), missing)
    ]


def test_shares_hours_grid_and_residuals(spark):
    df = spark.createDataFrame(
        [("a", 1, 0.5, -0.5, 1.0, 2.0), ("a", 1, 0.9, -0.1, 3.0, 1.0), (None, 2, -0.5, 1.5, 5.0, 9.0)],
        "depth_bucket string, hour int, longitude double, latitude double, magnitudo double, prediction double",
    )
    assert profile.category_shares(df, ["depth_bucket"]).collect() == [("depth_bucket", "a", 2, 100.0)]
    assert profile.hourly_counts(df).collect() == [(1, 2), (2, 1)]
    assert Counter(map(tuple, profile.location_grid(df).collect())) == Counter([(0, -1, 2, 2.0), (-1, 1, 1, 5.0)])
    assert [r["residual"] for r in profile.with_residual(df).collect()] == [-1.0, 2.0, -4.0]
    assert profile.ideal_line(df).first() == (1.0, 9.0)
    assert profile.preview(df, 2).count() == 2
    assert statistics.mean(r["magnitudo"] for r in profile.location_points(df).collect()) == 3.0
