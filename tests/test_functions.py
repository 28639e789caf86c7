import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventlake.functions import inside, natural_key, step_label, to_double, to_instant, to_whole, uuid5_url
from eventlake.operators.gold import DEEPEST, DEPTH_STEPS, MAGNITUDE_STEPS, STRONGEST


def evaluate(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_integers_are_lenient(spark, setting, ansi):
    setting("spark.sql.ansi.enabled", ansi)
    texts = ["7", " 7 ", "\t7", "+7", "-7", "0.0", "7.9", "-7.9", "7.", ".5", "1e3", "n/a", "", None, "99999999999", "NaN", "7 8"]
    expected = [7, 7, 7, 7, -7, 0, 7, -7, 7, 0, None, None, None, None, None, None, None]
    assert evaluate(spark, texts, to_whole(F.col("x"))) == expected
    assert evaluate(spark, ["99999999999", "1704069153990.0"], to_whole(F.col("x"), "bigint")) == [99999999999, 1704069153990]


def test_doubles(spark):
    got = evaluate(spark, ["2.5", " 2.5 ", "1e3", "n/a", "", None], to_double(F.col("x")))
    assert got == [2.5, 2.5, 1000.0, None, None, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_timestamp_cascade(spark, setting, ansi):
    setting("spark.sql.ansi.enabled", ansi)
    cases = [
        ("2024-01-01 00:32:33.990000+00:00", "0", datetime(2024, 1, 1, 0, 32, 33, 990000)),
        ("1990-01-01 02:00:00+02:00", None, datetime(1990, 1, 1)),
        ("1990-01-01", None, datetime(1990, 1, 1)),
        ("unknown", "1704069153990", datetime(2024, 1, 1, 0, 32, 33)),
        (None, "1704069153990.7", datetime(2024, 1, 1, 0, 32, 33)),
        (None, "NaN", None),
        (None, "1.5e12", None),
        (None, "1000d", None),
        (None, "9223372036854775807", None),
        (None, "1e300", None),
        (None, "Infinity", None),
        (None, "soon", None),
        (None, None, None),
    ]
    df = spark.createDataFrame([(i, d, t) for i, (d, t, _) in enumerate(cases)], "i int, d string, t string")
    got = df.orderBy("i").select(to_instant(F.col("d"), to_whole(F.col("t"), "bigint")).cast("timestamp_ntz")).collect()
    assert [r[0] for r in got] == [e for _, _, e in cases]


def test_uuid5(spark):
    names = ["", "a", "file.csv|1|x|y|z", "İzmir|ö|地震", "x" * 500] + [f"n{i}" for i in range(64)]
    assert evaluate(spark, names, uuid5_url(F.col("x"))) == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]


def test_natural_key_treats_null_as_empty(spark):
    import hashlib

    df = spark.createDataFrame([(1, "p", None), (None, None, None)], "t bigint, p string, d timestamp")
    got = [r[0] for r in df.select(natural_key(F.col("t"), F.col("p"), F.col("d"))).collect()]
    assert got == [hashlib.sha256(b"1||p||").hexdigest(), hashlib.sha256(b"||||").hexdigest()]


def test_range_ends(spark):
    values = [-90.01, -90.0, 90.0, 90.01, float("nan"), None]
    assert evaluate(spark, values, inside(F.col("x"), -90, 90), "double") == [False, True, True, False, False, False]


def test_buckets(spark):
    depth = [-0.01, 0.0, 69.99, 70.0, 299.99, 300.0, float("nan"), None]
    labels = ["negative", "shallow", "shallow", "medium", "medium", "deep", "deep", "deep"]
    assert evaluate(spark, depth, step_label(F.col("x"), DEPTH_STEPS, DEEPEST), "double") == labels
    magnitude = [2.99, 3.0, 4.99, 5.0, 6.0, 6.99, 7.0, float("nan"), None]
    labels = ["minor", "light", "light", "moderate", "strong", "strong", "major", "major", "major"]
    assert evaluate(spark, magnitude, step_label(F.col("x"), MAGNITUDE_STEPS, STRONGEST), "double") == labels
