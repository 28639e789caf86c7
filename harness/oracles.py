"""DuckDB SQL that computes each registered query independently from the test tables."""

from __future__ import annotations

from eventlake.schemas import BRONZE_COLUMNS, EVENT_COLUMNS, FEATURE_COLUMNS, RAW_COLUMNS, RISK_COLUMNS, SILVER_COLUMNS
from harness import fixtures

MESSAGE = "kafka_topic, kafka_partition, kafka_offset, kafka_timestamp"

TYPED = """
SELECT CASE WHEN regexp_full_match(r.time, '[+-]?[0-9]+') THEN TRY_CAST(r.time AS BIGINT) END AS time, trim(r.place) AS place, lower(trim(r.status)) AS status,
  TRY_CAST(r.tsunami AS INTEGER) AS tsunami, TRY_CAST(r.significance AS INTEGER) AS significance,
  lower(trim(r.data_type)) AS data_type, TRY_CAST(r.magnitudo AS DOUBLE) AS magnitudo,
  coalesce(trim(r.state), 'unknown') AS state, TRY_CAST(r.longitude AS DOUBLE) AS longitude,
  TRY_CAST(r.latitude AS DOUBLE) AS latitude, TRY_CAST(r.depth AS DOUBLE) AS depth,
  coalesce(TRY_CAST(r.date AS TIMESTAMP), make_timestamp((CASE WHEN regexp_full_match(r.time, '[+-]?[0-9]+') THEN TRY_CAST(r.time AS BIGINT) END // 1000) * 1000000)) AS date,
  r.event_id, TRY_CAST(r.ingested_at AS TIMESTAMP) AS ingested_at, r.source_file,
  r.kafka_topic, r.kafka_partition, r.kafka_offset, r.kafka_timestamp {extra}
FROM {raw} r
"""
FLAGGED = """
SELECT *, date AS event_timestamp, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  CAST(day(date) AS INTEGER) AS day, CAST(hour(date) AS INTEGER) AS hour,
  sha256(coalesce(CAST(time AS VARCHAR), '') || '||' || coalesce(place, '') || '||' || coalesce(CAST(date AS VARCHAR), '')) AS record_natural_key,
  (latitude IS NULL OR latitude NOT BETWEEN -90 AND 90) AS invalid_latitude,
  (longitude IS NULL OR longitude NOT BETWEEN -180 AND 180) AS invalid_longitude,
  magnitudo IS NULL AS missing_magnitudo, depth IS NULL AS missing_depth, depth < 0 AS negative_depth
FROM {typed}
"""
SCORED = """
SELECT *, CAST(greatest(0, 100 - CASE WHEN invalid_latitude THEN 25 ELSE 0 END
    - CASE WHEN invalid_longitude THEN 25 ELSE 0 END - CASE WHEN missing_magnitudo THEN 30 ELSE 0 END
    - CASE WHEN missing_depth THEN 15 ELSE 0 END - CASE WHEN negative_depth THEN 5 ELSE 0 END) AS INTEGER) AS quality_score,
  NOT (invalid_latitude OR invalid_longitude OR missing_magnitudo OR missing_depth) AS is_valid_record
FROM {flagged}
"""
BASE = """
SELECT *, abs(latitude) AS abs_latitude, abs(longitude) AS abs_longitude,
  CASE WHEN depth < 0 THEN 'negative' WHEN depth < 70 THEN 'shallow' WHEN depth < 300 THEN 'medium' ELSE 'deep' END AS depth_bucket,
  CASE WHEN magnitudo < 3 THEN 'minor' WHEN magnitudo < 5 THEN 'light' WHEN magnitudo < 6 THEN 'moderate'
    WHEN magnitudo < 7 THEN 'strong' ELSE 'major' END AS magnitude_bucket,
  depth >= 0 AND depth < 70 AS is_shallow, depth >= 70 AND depth < 300 AS is_medium_depth, depth >= 300 AS is_deep,
  significance >= 500 AS is_high_significance, tsunami = 1 AS is_tsunami
FROM silver WHERE is_valid_record AND event_timestamp IS NOT NULL AND magnitudo IS NOT NULL
"""
STATE_INDEX = """
SELECT state, CAST(row_number() OVER (ORDER BY n DESC, state) - 1 AS DOUBLE) AS state_index
FROM (SELECT state, count(*) AS n FROM base GROUP BY state)
"""


def _clean(raw: str, extra: str = "", prefix: str = "") -> list[tuple[str, str]]:
    return [
        (f"{prefix}typed", TYPED.format(raw=raw, extra=extra)),
        (f"{prefix}flagged", FLAGGED.format(typed=f"{prefix}typed")),
        (f"{prefix}silver", SCORED.format(flagged=f"{prefix}flagged")),
    ]


RAW = [("raw", fixtures.raw_sql("duckdb", "events"))]
IDENTIFIED = [*RAW, ("identified", "SELECT * FROM raw WHERE event_id IS NOT NULL")]
SILVER = [*IDENTIFIED, *_clean("identified")]
GOLD = [
    *SILVER,
    ("base", BASE),
    ("state_indexes", STATE_INDEX),
    ("features", f"SELECT {', '.join(FEATURE_COLUMNS)} FROM base JOIN state_indexes USING (state)"),
]
_KNOWN_RISK = " AND ".join(f"{c} IS NOT NULL" for c in RISK_COLUMNS if c not in ("event_id", "state", "state_index"))
RISK = [*GOLD, ("risk", f"SELECT {', '.join(RISK_COLUMNS)} FROM features WHERE {_KNOWN_RISK}")]
NORMAL = [
    *RAW,
    ("normal", "SELECT * REPLACE (" + ", ".join(f"nullif(trim({c}), '') AS {c}" for c in RAW_COLUMNS) + ") FROM raw"),
]
_NAME = "'events.parquet|' || CAST(kafka_offset + 1 AS VARCHAR) || '|' || coalesce(time,'') || '|' || coalesce(place,'') || '|' || coalesce(date,'')"
IDS = [
    *NORMAL,
    ("hashed", f"SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({_NAME})) AS h FROM normal"),
    (
        "uuids",
        "SELECT * EXCLUDE (event_id), substr(h,1,8) || '-' || substr(h,9,4) || '-5' || substr(h,14,3) || '-' "
        "|| substr('89ab', (instr('0123456789abcdef', substr(h,17,1)) - 1) % 4 + 1, 1) || substr(h,18,3) || '-' || substr(h,21,12) AS event_id FROM hashed",
    ),
]
_JSON = "'{' || " + " || ',' || ".join(f"""'"{c}":' || coalesce(CAST(to_json({c}) AS VARCHAR), 'null')""" for c in EVENT_COLUMNS) + " || '}'"
_IS_BROKEN = " OR ".join(f"kafka_offset % {n} = 0" for n in fixtures.BROKEN_PAYLOADS)


def _bronze(raw: str, extra: str = "") -> list[tuple[str, str]]:
    parsed = ", ".join(f"CASE WHEN {_IS_BROKEN} THEN NULL ELSE {c} END AS {c}" for c in EVENT_COLUMNS)
    broken = fixtures.broken_payload("kafka_offset", _JSON)
    return [("parsed", f"SELECT {parsed}, {MESSAGE}, {broken} AS raw_json {extra} FROM {raw}")]


BRONZE = [*RAW, *_bronze("raw")]
DELIVERED = [*RAW, ("delivered", fixtures.deliveries_sql("raw"))]
_FIRST = "row_number() OVER (PARTITION BY record_natural_key ORDER BY kafka_partition, kafka_offset)"


def _upserted(source: list[tuple[str, str]], relation: str) -> list[tuple[str, str]]:
    return [
        *source,
        *_clean(relation, ", delivery", "d_"),
        ("ranked", "SELECT *, row_number() OVER (PARTITION BY delivery, record_natural_key ORDER BY kafka_partition, kafka_offset) AS rn FROM d_silver WHERE is_valid_record"),
        ("one", "SELECT * FROM ranked WHERE rn = 1 AND delivery = 1"),
        ("two", "SELECT * FROM ranked WHERE rn = 1 AND delivery = 2"),
        (
            "upserted",
            "SELECT * FROM one UNION ALL SELECT * FROM two WHERE record_natural_key NOT IN (SELECT record_natural_key FROM one) "
            "AND event_id NOT IN (SELECT event_id FROM one)",
        ),
    ]


UPSERTED = _upserted([*DELIVERED, ("known", "SELECT * FROM delivered WHERE event_id IS NOT NULL")], "known")
STREAMED_BRONZE = [*DELIVERED, *_bronze("delivered", ", delivery")]
STREAMED = _upserted([*STREAMED_BRONZE, ("known", "SELECT * FROM parsed WHERE event_id IS NOT NULL")], "known")

REGRESSION = [*GOLD, ("predictions", fixtures.REGRESSION_PREDICTIONS.format(features="features"))]
CLASSIFICATION = [
    *GOLD,
    ("scores", fixtures.SCORES.format(features="features")),
    ("predictions", fixtures.CLASSIFICATION_PREDICTIONS.format(scores="scores")),
]
RUNS = [("runs", fixtures.runs_sql("duckdb", "events"))]
CLASSES = [*RISK, ("labels01", "SELECT CAST(tsunami AS DOUBLE) AS label, count(*) AS count FROM risk WHERE tsunami IN (0, 1) GROUP BY 1")]


def _sql(ctes: list[tuple[str, str]], select: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body.strip()})" for name, body in ctes) + "\n" + select.strip()


def _columns(names: list[str], alias: str = "") -> str:
    return ", ".join(f"{alias}{n}" for n in names)


def _r(expression: str, name: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) AS {name}"


def _nulls(relation: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS null_count FROM {relation}" for c in columns)


def _counters(relation: str) -> str:
    def number(c: str) -> str:
        return f"TRY_CAST({c} AS DOUBLE)"

    rules = {
        "total_record_count": "TRUE",
        "invalid_latitude_count": f"{number('latitude')} IS NULL OR {number('latitude')} NOT BETWEEN -90 AND 90",
        "invalid_longitude_count": f"{number('longitude')} IS NULL OR {number('longitude')} NOT BETWEEN -180 AND 180",
        "null_magnitudo_count": f"{number('magnitudo')} IS NULL",
        "negative_depth_count": f"{number('depth')} < 0",
    }
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, count(*) FILTER ({rule}) AS value FROM {relation}" for m, rule in rules.items())


def _distribution(column: str, limit: int) -> str:
    return (
        f"SELECT '{column}' AS \"column\", value, count, rank FROM (SELECT CAST({column} AS VARCHAR) AS value, count(*) AS count, "
        f"CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({column} AS VARCHAR)) AS INTEGER) AS rank FROM silver GROUP BY 1) WHERE rank <= {limit}"
    )


_LIMITS = {"tsunami": 10, "status": 30, "data_type": 30, "state": 20}
_METRIC = {"tsunami": "tsunami_distribution", "status": "status_distribution", "data_type": "data_type_distribution", "state": "top_states_by_event_count"}


def _report() -> str:
    def listed(c: str) -> str:
        value = "value" if c == "tsunami" else "'\"' || value || '\"'"
        return (
            f"SELECT '{_METRIC[c]}' AS metric, lpad(CAST(rank AS VARCHAR), 6, '0') AS key, "
            f"'{{\"{c}\":' || {value} || ',\"count\":' || CAST(count AS VARCHAR) || '}}' AS value FROM ({_distribution(c, _LIMITS[c])})"
        )

    parts = [
        f"SELECT metric, CAST(NULL AS VARCHAR) AS key, CAST(value AS VARCHAR) AS value FROM ({_counters('silver')})",
        f"SELECT 'null_counts' AS metric, \"column\" AS key, CAST(null_count AS VARCHAR) AS value FROM ({_nulls('silver', SILVER_COLUMNS)})",
        *(listed(c) for c in _LIMITS),
        "SELECT 'yearly_record_count', coalesce(lpad(CAST(year AS VARCHAR), 6, '0'), ''), '{\"year\":' || coalesce(CAST(year AS VARCHAR), 'null') || ',\"count\":' || CAST(count(*) AS VARCHAR) || '}' FROM silver GROUP BY year",
        "SELECT 'top_magnitudo_records', lpad(CAST(rn AS VARCHAR), 6, '0'), '{\"event_id\":\"' || event_id || '\",\"event_timestamp\":' "
        "|| coalesce('\"' || strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '\"', 'null') || ',\"place\":\"' || place || '\",\"state\":\"' || state || '\",\"magnitudo\":' "
        "|| CAST(magnitudo AS VARCHAR) || ',\"depth\":' || coalesce(CAST(depth AS VARCHAR), 'null') || '}' "
        "FROM (SELECT *, row_number() OVER (ORDER BY magnitudo DESC NULLS LAST, event_id) AS rn FROM silver) WHERE rn <= 20",
    ]
    return " UNION ALL ".join(parts)


def _moments(column: str) -> str:
    x = f"CAST({column} AS DOUBLE)"
    quartiles = ", ".join(_r(f"quantile_cont({x}, {q})", n) for n, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
    return (
        f"SELECT '{column}' AS \"column\", count({column}) AS count, {_r(f'avg({x})', 'mean')}, {_r(f'stddev_samp({x})', 'std')}, "
        f"{_r(f'min({x})', 'min')}, {quartiles}, {_r(f'max({x})', 'max')} FROM features"
    )


def _histogram(column: str, relation: str, name: str) -> str:
    x = f"CAST({column} AS DOUBLE)"
    return f"""
SELECT '{name}' AS "column", CAST(b AS INTEGER) AS bin, round(lo + (hi - lo) / 30 * b, 6) AS low, round(lo + (hi - lo) / 30 * (b + 1), 6) AS high, count(v) AS count
FROM (SELECT min({x}) AS lo, max({x}) AS hi FROM {relation}) m
CROSS JOIN (SELECT unnest(range(30)) AS b) g
LEFT JOIN (SELECT {x} AS v, least(CAST(floor(({x} - lo2) / (hi2 - lo2) * 30) AS BIGINT), 29) AS vb
  FROM {relation}, (SELECT min({x}) AS lo2, max({x}) AS hi2 FROM {relation}) WHERE {column} IS NOT NULL) d ON vb = b
GROUP BY b, lo, hi"""


def _shares() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS count, round(count(*) / sum(count(*)) OVER () * 100, 1) AS pct "
        f"FROM features WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in ("depth_bucket", "magnitude_bucket", "tsunami")
    )


_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing_count, count(*) AS total FROM silver" for c in SILVER_COLUMNS
)
_NUMERIC = ("latitude", "longitude", "depth", "significance", "month", "hour", "tsunami", "magnitudo")
_AS_DOUBLE = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMERIC)
_CLASS_DOUBLE = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMERIC if c != "tsunami")
_DAILY = f"""
SELECT strftime(event_timestamp, '%Y-%m-%d') AS date_day, count(*) AS event_count, {_r('avg(magnitudo)', 'avg_magnitude')}, max(magnitudo) AS max_magnitude,
  min(magnitudo) AS min_magnitude, {_r('avg(depth)', 'avg_depth')}, max(depth) AS max_depth,
  count(*) FILTER (tsunami = 1) AS tsunami_count, count(*) FILTER (is_high_significance) AS high_significance_count
FROM features GROUP BY 1"""
_STATES = f"""
SELECT state, count(*) AS event_count, {_r('avg(magnitudo)', 'avg_magnitude')}, max(magnitudo) AS max_magnitude, {_r('avg(depth)', 'avg_depth')},
  count(*) FILTER (tsunami = 1) AS tsunami_count, min(event_timestamp) AS first_event_time, max(event_timestamp) AS last_event_time
FROM features GROUP BY state"""
_CONFUSION = "SELECT label, prediction, count(*) AS count FROM predictions GROUP BY 1, 2"
_CLASS_METRICS = f"""
SELECT {_r('sum(tp) / sum(n)', 'accuracy')}, {_r('sum(n * p) / sum(n)', 'precision')}, {_r('sum(n * r) / sum(n)', 'recall')},
  {_r('sum(n * CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END) / sum(n)', 'f1')}
FROM (SELECT c.label, count(*) AS n, count(*) FILTER (c.label = c.prediction) AS tp,
    coalesce(count(*) FILTER (c.label = c.prediction) / nullif((SELECT count(*) FROM predictions x WHERE x.prediction = c.label), 0), 0) AS p,
    count(*) FILTER (c.label = c.prediction) / count(*) AS r
  FROM predictions c GROUP BY c.label)"""
_AUC = """
SELECT round((sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2)
  / (count(*) FILTER (label = 1) * count(*) FILTER (label <> 1)), 9) AS roc_auc
FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk FROM predictions)"""
_RUN_INFO = "run_id, status, start_time, end_time, artifact_uri"


_REGRESSION_INPUTS = ("latitude", "longitude", "depth", "significance", "month", "hour", "tsunami")
_CLASSIFICATION_INPUTS = ("latitude", "longitude", "depth", "magnitudo", "significance", "month", "hour")
_IN_TRAIN = "CAST('0x' || substr(md5('42:' || event_id), 1, 8) AS BIGINT) < 3435973836"
_LINEAR = {"linear_regression_baseline", "generalized_linear_regression", "logistic_regression_baseline"}
_REGRESSORS = ("linear_regression_baseline", "decision_tree_regressor", "random_forest_regressor", "gbt_regressor", "generalized_linear_regression")
_CLASSIFIERS = ("logistic_regression_baseline", "random_forest_classifier")


def _certified(name: str) -> str:
    """What a trained model must agree with: row counts, moments of inputs and label, sums of labels; rules that no node breaks."""
    classes = name in _CLASSIFIERS
    inputs = _CLASSIFICATION_INPUTS if classes else _REGRESSION_INPUTS
    source, label = ("risk", "CAST(tsunami AS DOUBLE)") if classes else ("features", "magnitudo")
    known = " AND ".join(f"{c} IS NOT NULL" for c in [*inputs, "tsunami" if classes else "magnitudo"]) + (" AND tsunami IN (0, 1)" if classes else "")
    parts = [
        ("parts", f"SELECT *, {label} AS y, {_IN_TRAIN} AS in_train FROM {source} WHERE {known}"),
        ("learned", "SELECT *, count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY y)) AS balanced FROM parts WHERE in_train"),
        ("ranked", "SELECT state, row_number() OVER (ORDER BY count(*) DESC, state) - 1 AS place FROM learned GROUP BY state"),
        ("vectors", f"SELECT l.*, r.place, {'balanced' if classes else '1.0'} AS w FROM learned l JOIN ranked r ON l.state = r.state"),
    ]

    def row(kind: str, key: str, value: str, relation: str = "") -> str:
        return f"SELECT '{kind}' AS kind, '{key}' AS name, {value} AS value, true AS holds {relation}"

    rows = [row("rows", part, "CAST(count(*) AS DOUBLE)", f"FROM parts WHERE in_train = {flag}") for part, flag in (("train", "true"), ("test", "false"))]
    rows += [row("metric", m, "CAST(NULL AS DOUBLE)") for m in (("accuracy", "precision", "recall", "f1", "roc_auc") if classes else ("rmse", "mae", "r2"))]
    if name in _LINEAR:
        moments = {**{c: c for c in inputs}, "state_index_model": "place", "intercept": "1"}
        rows += [row("moment", n, f"round(sum(w * CAST({x} AS DOUBLE) * y) / sum(w), 6)", "FROM vectors") for n, x in moments.items()]
    else:
        rows += [row("breaches", n, "CAST(0 AS DOUBLE)") for n in ("children", "predictions", "impurities", "gains")]
        rows += [row("input", n, "CAST(NULL AS DOUBLE)") for n in [*inputs, "state_index_model"]]
    if name in ("decision_tree_regressor", "gbt_regressor"):
        rows += [row("breaches", "leaves", "CAST(0 AS DOUBLE)"), row("total", "label", "round(sum(y), 6)", "FROM vectors")]
    return _sql([*(RISK if classes else GOLD), *parts], " UNION ALL ".join(rows))


def _scored(task: str, inputs: tuple[str, ...], models: int) -> str:
    known = " AND ".join(f"{c} IS NOT NULL" for c in inputs)
    return _sql(GOLD, f"SELECT event_id, '{task}' AS model_name, '2024-02-01T00:00:00Z' AS predicted_at, true AS agrees, true AS best, {models} AS n_models FROM features WHERE {known}")


def _trained() -> dict[str, str]:
    return {
        **{f"model_{n}": _certified(n) for n in [*_REGRESSORS, *_CLASSIFIERS]},
        "inference_regression": _scored("magnitude_regression", _REGRESSION_INPUTS, len(_REGRESSORS)),
        "inference_classification": _scored("tsunami_classification", _CLASSIFICATION_INPUTS, len(_CLASSIFIERS)),
    }


def oracle_sql() -> dict[str, str]:
    silver = _columns(SILVER_COLUMNS)
    return {
        # events and messages
        "csv_scan": _sql(NORMAL, f"SELECT {_columns(RAW_COLUMNS)} FROM normal"),
        "csv_row_number": "SELECT 'event-' || CAST(event_id AS VARCHAR) AS place, row_number() OVER (PARTITION BY event_id // 2000 ORDER BY event_id) AS row_number FROM events",
        "event_normalise": _sql(NORMAL, f"SELECT {_columns(RAW_COLUMNS)} FROM normal"),
        "event_id_uuid5": _sql(IDS, "SELECT kafka_offset + 1 AS row_number, event_id FROM uuids"),
        "event_build": _sql(IDS, f"SELECT {_columns(EVENT_COLUMNS)} FROM uuids"),
        "message_key": _sql(IDS, "SELECT event_id, coalesce(nullif(state, ''), event_id) AS key FROM uuids"),
        "message_json": _sql(IDS, f"SELECT coalesce(nullif(state, ''), event_id) AS key, {_JSON} AS value FROM uuids"),
        "message_publish": _sql(IDS, f"SELECT 'seismic-events' AS topic, coalesce(nullif(state, ''), event_id) AS key, {_JSON} AS value FROM uuids"),
        # raw layer
        "bronze_parse": _sql(BRONZE, f"SELECT {_columns(BRONZE_COLUMNS)} FROM parsed WHERE event_id IS NOT NULL"),
        "bronze_bad_records": _sql(BRONZE, f"SELECT raw_json, {MESSAGE} FROM parsed WHERE event_id IS NULL"),
        # clean layer
        "silver_clean": _sql(SILVER, f"SELECT {silver} FROM silver"),
        "timestamp_cascade": _sql(SILVER, "SELECT event_id, event_timestamp FROM silver"),
        "date_parts": _sql(SILVER, "SELECT event_id, year, month, day, hour FROM silver"),
        "natural_key": _sql(SILVER, "SELECT event_id, record_natural_key FROM silver"),
        "quality_flags": _sql(SILVER, "SELECT event_id, invalid_latitude, invalid_longitude, missing_magnitudo, missing_depth, negative_depth, is_valid_record FROM silver"),
        "quality_score_distribution": _sql(SILVER, "SELECT quality_score, count(*) AS count FROM silver GROUP BY 1"),
        "silver_valid": _sql(SILVER, f"SELECT {silver} FROM silver WHERE is_valid_record"),
        "silver_quarantine": _sql(SILVER, f"SELECT {silver} FROM silver WHERE NOT is_valid_record"),
        "silver_dedup": _sql(
            [*IDENTIFIED, ("again", fixtures.redelivered_sql("identified")), *_clean("again")],
            f"SELECT {silver} FROM (SELECT *, {_FIRST} AS rn FROM silver WHERE is_valid_record) WHERE rn = 1",
        ),
        "silver_upsert": _sql(UPSERTED, f"SELECT {silver} FROM upserted"),
        # analytic tables
        "gold_features": _sql(GOLD, f"SELECT {_columns(FEATURE_COLUMNS)} FROM features"),
        "gold_state_index": _sql(GOLD, "SELECT state, state_index FROM state_indexes"),
        "gold_daily_aggregates": _sql(GOLD, _DAILY),
        "gold_state_aggregates": _sql(GOLD, _STATES),
        "gold_tsunami_risk": _sql(RISK, f"SELECT {_columns(RISK_COLUMNS)} FROM risk"),
        "gold_partitioned_table": _sql(GOLD, f"SELECT {_columns(FEATURE_COLUMNS)} FROM features"),
        "class_distribution": _sql(GOLD, "SELECT tsunami, count(*) AS count FROM features GROUP BY 1"),
        "append_added_column": _sql(SILVER, "SELECT event_id, latitude, CASE WHEN is_valid_record THEN magnitudo END AS magnitudo FROM silver"),
        # quality report
        "value_distribution": _sql(SILVER, "SELECT place, count(*) AS count FROM silver GROUP BY 1 ORDER BY count(*) DESC, place LIMIT 50"),
        "value_distributions": _sql(SILVER, " UNION ALL ".join(_distribution(c, n) for c, n in _LIMITS.items())),
        "null_counts": _sql(SILVER, _nulls("silver", SILVER_COLUMNS)),
        "quality_scalars": _sql(SILVER, _counters("silver")),
        "quality_scalars_raw_layer": _sql(IDENTIFIED, _counters("identified")),
        "yearly_counts": _sql(SILVER, "SELECT year, count(*) AS count FROM silver GROUP BY 1"),
        "top_magnitude": _sql(SILVER, "SELECT event_id, event_timestamp, place, state, magnitudo, depth FROM silver ORDER BY magnitudo DESC NULLS LAST, event_id LIMIT 20"),
        "top_states": _sql(SILVER, "SELECT state, count(*) AS count FROM silver GROUP BY 1 ORDER BY count(*) DESC, state LIMIT 20"),
        "quality_report": _sql(SILVER, _report()),
        # profiles
        "numeric_profile": _sql(GOLD, " UNION ALL ".join(map(_moments, ("magnitudo", "depth", "latitude", "longitude", "significance")))),
        "missing_profile": _sql(
            SILVER,
            f"SELECT \"column\", missing_count, round(missing_count / total * 100, 2) AS missing_pct, total_missing FROM "
            f"(SELECT *, CAST(sum(missing_count) OVER () AS BIGINT) AS total_missing FROM ({_MISSING})) WHERE missing_count > 0",
        ),
        "histogram": _sql(GOLD, " UNION ALL ".join(_histogram(c, "features", c) for c in ("magnitudo", "depth", "significance"))),
        "residual_histogram": _sql(
            [*REGRESSION, ("residuals", "SELECT magnitudo - prediction AS residual FROM predictions")], _histogram("residual", "residuals", "residual")
        ),
        "category_shares": _sql(GOLD, _shares()),
        "hourly_counts": _sql(GOLD, "SELECT hour, count(*) AS count FROM features GROUP BY 1"),
        "largest_states": _sql(GOLD, "SELECT state, count(*) AS event_count FROM features GROUP BY 1 ORDER BY count(*) DESC, state LIMIT 15"),
        "daily_series": _sql(GOLD, "SELECT date_day, event_count, avg_magnitude, max_magnitude FROM (" + _DAILY + ")"),
        "location_points": _sql(GOLD, "SELECT longitude, latitude, magnitudo FROM features"),
        "location_grid": _sql(
            GOLD,
            "SELECT CAST(floor(longitude) AS BIGINT) AS longitude_cell, CAST(floor(latitude) AS BIGINT) AS latitude_cell, count(*) AS count, "
            f"{_r('avg(magnitudo)', 'avg_magnitude')} FROM features GROUP BY 1, 2",
        ),
        "residuals": _sql(REGRESSION, f"SELECT event_id, {_r('magnitudo - prediction', 'residual')} FROM predictions"),
        "ideal_line": _sql(
            REGRESSION,
            f"SELECT {_r('least(min(magnitudo), min(prediction))', 'min_value')}, {_r('greatest(max(magnitudo), max(prediction))', 'max_value')} FROM predictions",
        ),
        # models
        "regression_data": _sql(GOLD, f"SELECT event_id, state, {_AS_DOUBLE} FROM features WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _NUMERIC)),
        "classification_data": _sql(
            RISK, f"SELECT event_id, state, tsunami, {_CLASS_DOUBLE}, CAST(tsunami AS DOUBLE) AS label FROM risk WHERE tsunami IN (0, 1)"
        ),
        "class_weights": _sql(CLASSES, f"SELECT label, count, {_r('sum(count) OVER () / (count(*) OVER () * count)', 'class_weight')} FROM labels01"),
        "hash_split": _sql(
            RISK,
            "SELECT event_id, CAST('0x' || substr(md5('42:' || event_id), 1, 8) AS BIGINT) < 3435973836 AS in_train FROM risk",
        ),
        "confusion_matrix": _sql(CLASSIFICATION, _CONFUSION),
        "regression_metrics": _sql(
            REGRESSION,
            f"SELECT {_r('sqrt(avg(e * e))', 'rmse')}, {_r('avg(abs(e))', 'mae')}, {_r('1 - sum(e * e) / sum((magnitudo - m) * (magnitudo - m))', 'r2')} "
            "FROM (SELECT magnitudo, magnitudo - prediction AS e, avg(magnitudo) OVER () AS m FROM predictions)",
        ),
        "classification_metrics": _sql(CLASSIFICATION, _CLASS_METRICS),
        "roc_auc": _sql(CLASSIFICATION, _AUC),
        "best_run": _sql(
            RUNS,
            "SELECT run_id, rmse FROM runs WHERE experiment = 'magnitude_regression' ORDER BY rmse ASC NULLS LAST, start_time DESC, run_id LIMIT 1",
        ),
        "run_summary": _sql(
            RUNS,
            f"SELECT experiment AS experiment_name, {_RUN_INFO}, rmse AS metric_rmse, mae AS metric_mae, r2 AS metric_r2, "
            "max_depth AS \"param_maxDepth\", model_name AS param_model_name, model_family AS tag_model_family FROM "
            "(SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id) AS rn FROM runs) WHERE rn <= 100",
        ),
        "metric_comparison": _sql(
            RUNS,
            "SELECT rmse AS \"RMSE\", mae AS \"MAE\", r2 AS \"R2\", model_name AS \"Model\" FROM runs WHERE experiment = 'magnitude_regression' AND rmse IS NOT NULL",
        ),
        **_trained(),
        # streams
        "stream_bronze": _sql(STREAMED_BRONZE, f"SELECT {_columns(BRONZE_COLUMNS)} FROM parsed WHERE event_id IS NOT NULL"),
        "stream_bad_records": _sql(STREAMED_BRONZE, f"SELECT raw_json, {MESSAGE} FROM parsed WHERE event_id IS NULL"),
        "stream_silver": _sql(STREAMED, f"SELECT {silver} FROM upserted"),
        "stream_quarantine": _sql(STREAMED, f"SELECT {silver} FROM d_silver WHERE NOT is_valid_record"),
    }
