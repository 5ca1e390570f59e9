"""Independent DuckDB SQL for every registered query that SQL can express.

The SQL re-derives everything from the given tables with DuckDB's own JSON,
time and aggregate functions. Doubles are published through ``round(.,6)``;
2-decimal statistics go through ``::VARCHAR::DECIMAL`` so ties round the way
Spark rounds a double (half-up on its shortest decimal text).
"""

from __future__ import annotations

from fleetscope.schema import (
    DEVICE_IDS, METRIC_UNITS, METRICS, NULL_CHECK_COLUMNS,
    STALE_AFTER_MINUTES,
)
from fleetscope.sources.fixtures import DEFAULT_METRIC, EVENT_TYPE_METRIC, LOCATIONS


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _case(col: str, mapping: dict, default) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    dflt = "NULL" if default is None else f"'{default}'"
    return f"CASE {whens} ELSE {dflt} END"


def spark_round2(expr: str) -> str:
    """Half-up rounding of a double's shortest decimal text, like Spark."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def spark_round1(expr: str) -> str:
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), 1) AS DOUBLE)"


def r6(expr: str) -> str:
    return f"round({expr}, 6)"


_LOCS = "[" + ", ".join(f"'{x}'" for x in LOCATIONS) + "]"

# Messages built from `events`: same text as fleetscope.sources.fixtures.
MESSAGES_CTE = f"""
src AS (
  SELECT event_id AS sid, ts, user_id, event_type, value AS sval,
         {_case('event_type', EVENT_TYPE_METRIC, DEFAULT_METRIC)} AS base_metric
  FROM events
),
frows AS (
  SELECT CAST(sid % 4 AS INTEGER) AS "partition", sid AS "offset",
         CASE WHEN day(ts) <= 10 THEN 1 WHEN day(ts) <= 20 THEN 2 ELSE 3 END AS snapshot_id,
         CAST(CASE WHEN sid % 250 = 17 THEN sid - 1 ELSE sid END AS VARCHAR) AS event_id,
         strftime(CASE WHEN sid % 100 = 41 THEN TIMESTAMP '2099-01-01 00:00:00' ELSE ts END,
                  '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ts_text,
         CASE WHEN sid % 100 = 91 THEN 'device_999'
              ELSE 'device_' || lpad(CAST(user_id % 50 + 1 AS VARCHAR), 3, '0') END AS device_id,
         CASE WHEN sid % 100 = 83 THEN 'unknown_probe' ELSE base_metric END AS metric_name,
         CASE WHEN sid % 100 = 7 THEN NULL
              WHEN sid % 100 = 23 THEN round(sval + 1000, 2)
              WHEN sid % 100 = 59 THEN -sval
              ELSE sval END AS value,
         {_case('base_metric', METRIC_UNITS, None)} AS unit,
         CASE WHEN sid % 40 = 5 THEN NULL ELSE {_LOCS}[user_id % {len(LOCATIONS)} + 1] END AS location,
         sid % 100 = 71 AS malformed,
         ts AS src_ts
  FROM src
),
msgs AS (
  SELECT "partition", "offset", snapshot_id, src_ts,
         CASE WHEN malformed THEN 'not-json' ELSE
           '{{"event_id": ' || coalesce('"' || event_id || '"', 'null')
           || ', "timestamp": ' || coalesce('"' || ts_text || '"', 'null')
           || ', "device_id": ' || coalesce('"' || device_id || '"', 'null')
           || ', "metric_name": ' || coalesce('"' || metric_name || '"', 'null')
           || ', "value": ' || coalesce(CAST(CAST(value AS DECIMAL(20,2)) AS VARCHAR), 'null')
           || ', "unit": ' || coalesce('"' || unit || '"', 'null')
           || ', "location": ' || coalesce('"' || location || '"', 'null')
           || '}}' END AS raw
  FROM frows
),
jm AS (
  SELECT *, CASE WHEN json_valid(raw) THEN json_type(raw) = 'OBJECT' ELSE false END AS ok
  FROM msgs
),
dec AS (
  SELECT "partition", "offset", snapshot_id,
         CASE WHEN ok THEN json_extract_string(raw, '$.event_id') END AS event_id,
         CASE WHEN ok THEN json_extract_string(raw, '$.timestamp') END AS ts_text,
         CASE WHEN ok THEN TRY_CAST(json_extract_string(raw, '$.timestamp') AS TIMESTAMPTZ)
                           AT TIME ZONE 'UTC' END AS "timestamp",
         CASE WHEN ok THEN json_extract_string(raw, '$.device_id') END AS device_id,
         CASE WHEN ok THEN json_extract_string(raw, '$.metric_name') END AS metric_name,
         CASE WHEN ok AND json_type(raw, '$.value') IN ('DOUBLE', 'BIGINT', 'UBIGINT')
              THEN CAST(json_extract(raw, '$.value') AS DOUBLE) END AS value,
         CASE WHEN ok THEN json_extract_string(raw, '$.unit') END AS unit,
         CASE WHEN ok THEN json_extract_string(raw, '$.location') END AS location,
         raw AS raw_value
  FROM jm
),
val AS (
  SELECT *, nullif(concat_ws('; ',
    CASE WHEN "timestamp" IS NULL THEN 'timestamp is null'
         WHEN year("timestamp") >= 2099 THEN 'timestamp is in the future' END,
    CASE WHEN device_id IS NULL OR device_id NOT IN ({_in_list(DEVICE_IDS)})
         THEN 'unknown device_id: ' || coalesce(device_id, 'None') END,
    CASE WHEN value IS NULL THEN 'value is null'
         WHEN value < 0 THEN 'negative value: ' || CAST(value AS VARCHAR) END,
    CASE WHEN metric_name IS NULL OR metric_name NOT IN ({_in_list(METRICS)})
         THEN 'unknown metric: ' || coalesce(metric_name, 'None') END), '') AS rejection_reason
  FROM dec
),
clean AS (
  SELECT snapshot_id, event_id, "timestamp", device_id, metric_name, value, unit, location
  FROM val WHERE rejection_reason IS NULL
),
dead AS (
  SELECT snapshot_id, coalesce(nullif(event_id, ''), 'unknown') AS event_id,
         raw_value AS original_data, rejection_reason
  FROM val WHERE rejection_reason IS NOT NULL
)"""


def with_base(*ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {MESSAGES_CTE}{extra}\n"


#: The sum of the values without rounding errors, as integers in units of 2**-20 and 2**-60
#: (a value with two decimals has no binary places beyond 2**-60), then rounded once.
EXACT_SUM = ("(sum(floor(value * 1048576)::BIGINT)::DOUBLE / 1048576 + "
             "sum(((value * 1048576 - floor(value * 1048576)) * 1099511627776)::BIGINT)::DOUBLE / 1152921504606846976)")

HOURLY_CTE = f"""hourly_rows AS (
  SELECT time_bucket(INTERVAL 1 HOUR, "timestamp") AS hour_window, device_id, metric_name, value
  FROM clean WHERE "timestamp" IS NOT NULL
),
hourly_means AS (
  SELECT hour_window, device_id, metric_name, {EXACT_SUM} / count(value) AS mean,
         min(value) AS low, max(value) AS high, count(value) AS n, CAST(count(*) AS BIGINT) AS event_count
  FROM hourly_rows GROUP BY ALL
),
hourly_spread AS (
  SELECT hour_window, device_id, metric_name, fsum((value - mean) * (value - mean)) AS squares, fsum(value - mean) AS rest
  FROM hourly_rows JOIN hourly_means USING (hour_window, device_id, metric_name) GROUP BY ALL
),
hourly AS (
  SELECT hour_window, device_id, metric_name, {spark_round2('mean')} AS avg_value,
         {spark_round2('low')} AS min_value, {spark_round2('high')} AS max_value,
         {spark_round2('CASE WHEN n > 1 THEN sqrt((squares - rest * rest / n) / (n - 1)) END')} AS stddev_value, event_count
  FROM hourly_means JOIN hourly_spread USING (hour_window, device_id, metric_name)
)"""

ORACLE: dict[str, str] = {}

ORACLE["parse_events"] = with_base() + """
SELECT "partition", "offset", snapshot_id, event_id, "timestamp", device_id, metric_name,
       value, unit, location, raw_value
FROM dec"""

ORACLE["validate_route"] = with_base() + """
SELECT CASE WHEN rejection_reason IS NULL THEN event_id
            ELSE coalesce(nullif(event_id, ''), 'unknown') END AS event_id,
       CASE WHEN rejection_reason IS NULL THEN 'clean' ELSE 'dead_letter' END AS route,
       rejection_reason
FROM val"""

ORACLE["clean_events"] = with_base() + "SELECT * FROM clean"

ORACLE["dead_letter"] = with_base() + "SELECT * FROM dead"

ORACLE["rejection_summary"] = with_base() + """
SELECT regexp_replace(r.reason, ':.*$', '') AS reason, CAST(count(*) AS BIGINT) AS event_count
FROM dead, unnest(string_split(rejection_reason, '; ')) AS r(reason)
GROUP BY 1"""

_RAW_FLAG = """(value IS NULL OR (value > 1000 AND NOT isnan(value)) OR value < 0
   OR coalesce(starts_with(metric_name, 'unknown'), false)
   OR coalesce(starts_with(ts_text, '2099'), false))"""

ORACLE["raw_anomaly_flags"] = with_base() + f"""
SELECT "offset", event_id, {_RAW_FLAG} AS is_anomaly FROM dec"""

ORACLE["raw_anomaly_summary"] = with_base() + f"""
, f AS (SELECT {_RAW_FLAG} AS a FROM dec)
SELECT CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) FILTER (WHERE a) AS BIGINT) AS anomalies,
       {spark_round1('count(*) FILTER (WHERE a) * 100.0 / greatest(count(*), 1)')} AS anomaly_pct
FROM f"""

ORACLE["hourly_aggregates"] = with_base(HOURLY_CTE) + "SELECT * FROM hourly"

ORACLE["hourly_sample"] = with_base(HOURLY_CTE) + """
SELECT hour_window, device_id, metric_name, avg_value, min_value, max_value, event_count
FROM hourly ORDER BY hour_window, device_id, metric_name LIMIT 10"""


# --- quality ----------------------------------------------------------------

def _nulls() -> str:
    return ",\n".join(
        f"    CAST(count(*) FILTER (WHERE {'\"timestamp\"' if c == 'timestamp' else c} IS NULL) AS BIGINT) AS null_{c}"
        for c in NULL_CHECK_COLUMNS)


PROFILE_CTE = f"""prof AS (
  SELECT CAST(count(*) AS BIGINT) AS total,
{_nulls()},
    min(value) AS min_val, max(value) AS max_val,
    CAST(count(*) FILTER (WHERE value < 0) AS BIGINT) AS negative_count,
    CAST(count(*) FILTER (WHERE value > 1000) AS BIGINT) AS extreme_count,
    CAST(count(DISTINCT event_id) AS BIGINT) AS unique_ids
  FROM clean
)"""


def _pct(c: str) -> str:
    return (f"CASE WHEN null_{c} * 1.0 / total > 0.01 THEN '{c}: ' || "
            f"printf('%.2f', CAST(round(CAST(CAST(null_{c} * 100.0 / total AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE))"
            f" || '% null (>1%)' END")


NULL_FAILS = "concat_ws('; ', " + ", ".join(_pct(c) for c in NULL_CHECK_COLUMNS) + ")"

CHECKS_CTE = f"""checks AS (
  SELECT 1 AS check_order, 'row_count' AS "check", total >= 1 AS passed,
         'Total rows: ' || total || ' (threshold: >= 1)' AS detail FROM prof
  UNION ALL
  SELECT 2, 'null_rates', total > 0 AND {NULL_FAILS} = '',
         CASE WHEN total = 0 THEN 'No data to check'
              WHEN {NULL_FAILS} = '' THEN 'All columns within threshold'
              ELSE {NULL_FAILS} END FROM prof
  UNION ALL
  SELECT 3, 'value_ranges', total > 0 AND negative_count = 0 AND extreme_count = 0,
         CASE WHEN total = 0 THEN 'No data to check' ELSE
         'Range: [' || printf('%.2f', min_val) || ', ' || printf('%.2f', max_val)
         || '], negatives: ' || negative_count || ', extremes(>1000): ' || extreme_count END FROM prof
  UNION ALL
  SELECT 4, 'duplicates', total - unique_ids = 0,
         'Total: ' || total || ', Unique: ' || unique_ids || ', Duplicates: ' || (total - unique_ids) FROM prof
)"""

_Q = with_base(PROFILE_CTE, CHECKS_CTE)
ORACLE["check_row_count"] = _Q + 'SELECT "check", passed, detail FROM checks WHERE check_order = 1'
ORACLE["check_null_rates"] = _Q + 'SELECT "check", passed, detail FROM checks WHERE check_order = 2'
ORACLE["check_value_ranges"] = _Q + 'SELECT "check", passed, detail FROM checks WHERE check_order = 3'
ORACLE["check_duplicates"] = _Q + 'SELECT "check", passed, detail FROM checks WHERE check_order = 4'
ORACLE["check_duplicates_indexed"] = ORACLE["check_duplicates"]
ORACLE["quality_report"] = _Q + 'SELECT check_order, "check", passed, detail FROM checks'
ORACLE["quality_gate"] = _Q + """
SELECT bool_and(passed) AS all_passed,
       CASE WHEN bool_and(passed) THEN 'aggregate' ELSE 'alert' END AS action,
       coalesce(string_agg("check", ',' ORDER BY check_order) FILTER (WHERE NOT passed), '') AS failed_checks
FROM checks"""


# --- features and scoring ---------------------------------------------------

def _cols(fmt: str, sep: str = ",\n  ") -> str:
    return sep.join(fmt.format(m=m) for m in METRICS)


def feature_ctes(snapshot_filter: str = "", scaler_from: str | None = None,
                 prefix: str = "") -> list[str]:
    """piv -> feat -> sc -> norm -> lab; ``prefix`` renames the CTEs."""
    p = prefix
    where = f" AND snapshot_id <= {snapshot_filter}" if snapshot_filter else ""
    ctes = [
        f"""{p}piv AS (
  SELECT date_trunc('minute', "timestamp") AS time_window,
  {_cols("avg(value) FILTER (WHERE metric_name = '{m}') AS {m}")}
  FROM clean WHERE "timestamp" IS NOT NULL{where} GROUP BY 1
)""",
        f"""{p}feat AS (
  SELECT time_window,
  {_cols("coalesce({m}, (SELECT avg({m}) FROM " + p + "piv), 0.0) AS {m}")}
  FROM {p}piv
)""",
        f"""{p}sc AS (
  SELECT {_cols("min({m}) AS lo_{m}, max({m}) AS hi_{m}", ", ")} FROM {p}feat
)""",
    ]
    src = scaler_from or f"{p}sc"
    ctes += [
        f"""{p}norm AS (
  SELECT time_window,
  {_cols("CASE WHEN hi_{m} - lo_{m} = 0 THEN {m} - lo_{m} ELSE ({m} - lo_{m}) / (hi_{m} - lo_{m}) END AS {m}")}
  FROM {p}feat, {src}
)""",
        f"""{p}lab AS (
  SELECT *, CASE WHEN position < CAST(trunc(n * 0.7::DOUBLE) AS BIGINT) THEN 'train'
                 WHEN position < CAST(trunc(n * (0.7::DOUBLE + 0.15::DOUBLE)) AS BIGINT) THEN 'val'
                 ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY time_window) - 1 AS position,
               count(*) OVER () AS n FROM {p}norm)
)""",
    ]
    return ctes


def _pub(src: str) -> str:
    return f"SELECT time_window, {_cols('round({m}, 6) AS {m}', ', ')} FROM {src}"


_F = with_base(*feature_ctes())
ORACLE["snapshot_scan"] = with_base() + """
SELECT "timestamp", device_id, metric_name, value FROM clean WHERE snapshot_id <= 2"""
ORACLE["pivot_minutes"] = _F + _pub("piv")
ORACLE["feature_matrix"] = _F + _pub("feat")
ORACLE["normalized_features"] = _F + _pub("norm")
ORACLE["scaler_params"] = _F + " UNION ALL ".join(
    f"SELECT {i} AS feature_index, '{m}' AS feature_name, round(lo_{m}, 6) AS data_min, "
    f"round(hi_{m}, 6) AS data_max FROM sc" for i, m in enumerate(METRICS))
ORACLE["apply_scaler"] = with_base(*feature_ctes("1", prefix="old_"),
                                   *feature_ctes(scaler_from="old_sc")) + _pub("norm")
ORACLE["time_split"] = _F + "SELECT time_window, position, split FROM lab"
ORACLE["split_sizes"] = _F + "SELECT split, CAST(count(*) AS BIGINT) AS rows FROM lab GROUP BY 1"

_SQ = " + ".join(f"({m} - m_{m}) * ({m} - m_{m})" for m in METRICS)
SCORING_CTES = feature_ctes() + [
    f"""mu AS (SELECT {_cols("avg({m}) AS m_{m}", ", ")} FROM lab WHERE split = 'train')""",
    f"""err AS (SELECT time_window, split, ({_SQ}) / 5.0 AS error FROM lab, mu)""",
    """thr AS (SELECT quantile_cont(error, 0.95) AS p95, quantile_cont(error, 0.99) AS p99
             FROM err WHERE split = 'train')""",
    """nsyn AS (SELECT greatest(count(*), 5) AS n FROM lab WHERE split = 'test')""",
]


def _u(j: int) -> str:
    return (f"CAST(('0x' || substr(md5(concat_ws(':', '42', CAST(syn_id AS VARCHAR), '{j}')), 1, 8))"
            f" AS BIGINT) / 4294967296.0")


_SYN_COLS = []
for _j, _m in enumerate(METRICS):
    _SYN_COLS.append(f"0.9 + 0.1 * {_u(_j + len(METRICS))} AS {_m}" if _j in (0, 2)
                     else f"{_u(_j)} AS {_m}")
SCORING_CTES += [
    f"""syn AS (SELECT range AS syn_id, {', '.join(_SYN_COLS)} FROM nsyn, range(nsyn.n))""",
    f"""synerr AS (SELECT syn_id, {_cols('{m}', ', ')}, ({_SQ}) / 5.0 AS error FROM syn, mu)""",
    """cm AS (SELECT
        (SELECT CAST(count(*) FILTER (WHERE error > p95) AS BIGINT) FROM synerr, thr) AS true_positives,
        (SELECT CAST(count(*) FILTER (WHERE error > p95) AS BIGINT) FROM err, thr WHERE split = 'test') AS false_positives,
        (SELECT count(*) FROM synerr) AS n_syn,
        (SELECT count(*) FROM err WHERE split = 'test') AS n_test)""",
]
_S = with_base(*SCORING_CTES)
ORACLE["reconstruction_error"] = _S + "SELECT time_window, split, round(error, 6) AS error FROM err"
ORACLE["error_thresholds"] = _S + "SELECT round(p95, 6) AS p95, round(p99, 6) AS p99 FROM thr"
ORACLE["threshold_sketch"] = _S + """
SELECT count(*)::BIGINT AS n, count(DISTINCT CAST(time_window AS DATE))::BIGINT AS sketches,
       true AS p95_within, true AS p99_within FROM err WHERE split = 'train'"""
ORACLE["error_stats"] = _S + """
SELECT round(avg(error) FILTER (WHERE split = 'train'), 6) AS train_mean,
       round(stddev_pop(error) FILTER (WHERE split = 'train'), 6) AS train_std,
       round(avg(error) FILTER (WHERE split = 'test'), 6) AS test_mean,
       round(stddev_pop(error) FILTER (WHERE split = 'test'), 6) AS test_std
FROM err"""
ORACLE["anomaly_flags"] = _S + """
SELECT time_window, round(error, 6) AS error, error > p95 AS flag_p95, error > p99 AS flag_p99
FROM err, thr WHERE split = 'test'"""
ORACLE["synthetic_anomalies"] = _S + f"""
SELECT syn_id, {_cols('round({m}, 6) AS {m}', ', ')}, round(error, 6) AS error, error > p95 AS flag_p95
FROM synerr, thr"""
ORACLE["confusion_matrix"] = _S + """
SELECT true_positives, false_positives, CAST(n_syn - true_positives AS BIGINT) AS false_negatives,
       CAST(n_test - false_positives AS BIGINT) AS true_negatives FROM cm"""
ORACLE["detection_metrics"] = _S + """
, pr AS (SELECT true_positives / greatest(true_positives + false_positives, 1) AS precision,
               true_positives / greatest(n_syn, 1) AS recall FROM cm)
SELECT round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(2.0 * precision * recall / greatest(precision + recall, 1e-8), 6) AS f1 FROM pr"""


# --- catalog, health, experiments -------------------------------------------

COMMITS_CTES = [
    """cmt_b AS (
  SELECT snapshot_id,
    count(*) FILTER (WHERE rejection_reason IS NULL) AS clean_rows,
    max(CASE WHEN year("timestamp") < 2099 THEN "timestamp" END)
      FILTER (WHERE rejection_reason IS NULL) AS clean_at,
    count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS dead_rows,
    max(CASE WHEN year("timestamp") < 2099 THEN "timestamp" END)
      FILTER (WHERE rejection_reason IS NOT NULL) AS dead_at
  FROM val GROUP BY snapshot_id)""",
    """hourly_s AS (
  SELECT snapshot_id, count(*) AS hourly_rows FROM (
    SELECT DISTINCT snapshot_id, time_bucket(INTERVAL 1 HOUR, "timestamp") AS h, device_id, metric_name
    FROM clean WHERE "timestamp" IS NOT NULL) GROUP BY 1)""",
    """commits AS (
  SELECT * FROM (
    SELECT 'clean_events' AS table_name, CAST(snapshot_id AS BIGINT) AS snapshot_id,
           clean_at AS committed_at, 'append' AS operation, CAST(clean_rows AS BIGINT) AS rows FROM cmt_b
    UNION ALL
    SELECT 'dead_letter', CAST(snapshot_id AS BIGINT), dead_at, 'append', CAST(dead_rows AS BIGINT) FROM cmt_b
    UNION ALL
    SELECT 'hourly_aggregates', CAST(b.snapshot_id AS BIGINT), clean_at, 'overwrite',
           CAST(coalesce(hourly_rows, 0) AS BIGINT) FROM cmt_b b LEFT JOIN hourly_s h USING (snapshot_id))
  WHERE rows > 0)""",
    """tables AS (
  SELECT table_name, CAST(sum(rows) AS BIGINT) AS row_count, max(committed_at) AS last_updated,
         CAST(count(*) AS BIGINT) AS snapshot_count,
         CASE WHEN table_name = 'clean_events' THEN (SELECT avg(CAST(passed AS DOUBLE)) FROM checks) END
           AS quality_score
  FROM commits GROUP BY 1)""",
    f"""fresh AS (
  SELECT table_name, last_updated, row_count,
         coalesce(last_updated < (SELECT max(last_updated) FROM tables) - INTERVAL {STALE_AFTER_MINUTES} MINUTE,
                  true) AS is_stale
  FROM tables)""",
]
_C = with_base(PROFILE_CTE, CHECKS_CTE, *COMMITS_CTES)
ORACLE["dataset_list"] = _C + "SELECT * FROM tables"
ORACLE["snapshot_list"] = _C + """
SELECT table_name, CAST(snapshot_id AS VARCHAR) AS snapshot_id, committed_at, operation, rows FROM commits"""
ORACLE["table_sample"] = with_base() + """
SELECT * FROM clean WHERE snapshot_id <= 2 ORDER BY "timestamp", event_id LIMIT 10"""
ORACLE["dataset_totals"] = _C + """
SELECT CAST(count(*) AS BIGINT) AS tables, CAST(sum(row_count) AS BIGINT) AS total_rows,
       CAST(sum(snapshot_count) AS BIGINT) AS total_snapshots FROM tables"""
ORACLE["quality_band"] = _C + """
SELECT table_name, quality_score,
       CASE WHEN quality_score IS NULL THEN 'N/A' WHEN quality_score >= 0.9 THEN 'green'
            WHEN quality_score >= 0.7 THEN 'yellow' ELSE 'red' END AS band,
       CAST(round(CAST(CAST(quality_score * 100 AS VARCHAR) AS DECIMAL(38,18)), 0) AS DOUBLE) AS percent
FROM tables"""
ORACLE["freshness"] = _C + "SELECT * FROM fresh"
ORACLE["storage_status"] = _C + """
SELECT CAST(count(*) FILTER (WHERE is_stale) AS BIGINT) AS stale_tables,
       CASE WHEN coalesce(bool_or(is_stale), false) THEN 'degraded' ELSE 'healthy' END AS status
FROM fresh"""

RUNS_CTE = """runs AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'telemetry_pipeline' ELSE 'ml_training_pipeline' END AS dag_id,
         CAST(event_id AS VARCHAR) AS run_id,
         CASE WHEN event_id % 50 = 0 THEN 'failed' WHEN event_id % 50 = 1 THEN 'running'
              ELSE 'success' END AS state,
         ts AS execution_date, value AS duration_seconds
  FROM events)"""
ORACLE["run_status"] = f"WITH {RUNS_CTE}\n" + """
SELECT dag_id, date_trunc('hour', execution_date) AS run_hour, CAST(count(*) AS BIGINT) AS runs,
       CASE WHEN bool_and(state = 'success') THEN 'healthy'
            WHEN bool_or(state = 'failed') THEN 'degraded' ELSE 'running' END AS overall_status
FROM runs GROUP BY 1, 2"""
ORACLE["run_timeline"] = f"WITH {RUNS_CTE}\n" + """
SELECT dag_id, run_id, state, execution_date, duration_seconds,
       CASE WHEN state = 'success' THEN 'OK' ELSE 'FAIL' END AS badge FROM runs"""

LAG_CTE = """lagp AS (
  SELECT l."partition", l.latest_offset, c.committed_offset,
         l.latest_offset - coalesce(c.committed_offset, -1) AS lag
  FROM (SELECT "partition", max("offset") AS latest_offset FROM msgs GROUP BY 1) l
  LEFT JOIN (SELECT m."partition", max(m."offset") AS committed_offset
             FROM msgs m JOIN (SELECT "partition", max("offset") AS latest FROM msgs GROUP BY 1) x
               ON m."partition" = x."partition"
             WHERE m."offset" % 97 <> 0 AND m."offset" < x.latest - 100 GROUP BY 1) c
  ON l."partition" = c."partition")"""
ORACLE["consumer_lag"] = with_base(LAG_CTE) + "SELECT * FROM lagp"
ORACLE["ingest_health"] = with_base(LAG_CTE) + """
SELECT 'telemetry.raw' AS topic, CAST(count(*) AS BIGINT) AS partitions,
       CAST(sum(lag) AS BIGINT) AS total_lag,
       CASE WHEN count(*) > 0 THEN 'healthy' ELSE 'unhealthy' END AS status FROM lagp"""

LOGS_CTE = """logs AS (
  SELECT 'exp_' || lpad(CAST(vec_id AS VARCHAR), 6, '0') AS experiment_id,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(vec_id), '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         CAST(embedding AS DOUBLE[]) AS train,
         CAST(embedding AS DOUBLE[])[1:greatest(len(embedding) - 2, 0)] AS val
  FROM embeddings),
evals AS (
  SELECT experiment_id, p AS precision, r AS recall, 2.0 * p * r / greatest(p + r, 1e-8) AS f1
  FROM (SELECT 'exp_' || lpad(CAST(vec_id AS VARCHAR), 6, '0') AS experiment_id,
               abs(CAST(embedding[1] AS DOUBLE)) AS p, abs(CAST(embedding[2] AS DOUBLE)) AS r
        FROM embeddings WHERE vec_id % 3 <> 0)),
elist AS (
  SELECT l.experiment_id, l."timestamp", round(list_min(l.val), 6) AS best_val_loss,
         CAST(len(l.train) AS BIGINT) AS epochs_completed, 'cpu' AS device,
         round(e.precision, 6) AS precision, round(e.recall, 6) AS recall, round(e.f1, 6) AS f1
  FROM logs l LEFT JOIN evals e USING (experiment_id))"""
ORACLE["experiment_list"] = f"WITH {LOGS_CTE}\nSELECT * FROM elist"
ORACLE["experiment_detail"] = f"WITH {LOGS_CTE}\n" + """
SELECT l.experiment_id, l."timestamp", CAST(50 AS BIGINT) AS epochs_max, CAST(len(train) AS BIGINT) AS epochs_completed,
       0.001::DOUBLE AS learning_rate, CAST(32 AS BIGINT) AS batch_size, CAST(5 AS BIGINT) AS patience,
       CAST(5 AS BIGINT) AS input_dim, 0.2::DOUBLE AS dropout_rate, round(list_min(val), 6) AS best_val_loss,
       round(train[-1], 6) AS final_train_loss, round(len(train) * 0.1::DOUBLE, 6) AS training_time_seconds, 'cpu' AS device,
       round(e.precision, 6) AS precision, round(e.recall, 6) AS recall, round(e.f1, 6) AS f1,
       CAST(len(train) AS BIGINT) AS train_losses, CAST(len(val) AS BIGINT) AS val_losses,
       'cpu_usage,memory_usage,temperature,disk_io,network_latency' AS feature_names
FROM logs l JOIN evals e USING (experiment_id)
WHERE l.experiment_id = (SELECT min(experiment_id) FROM evals)"""
ORACLE["latest_model"] = f"WITH {LOGS_CTE}\n" + """
SELECT experiment_id, 'experiments/models/experiment_id=' || experiment_id AS model_path,
       best_val_loss, precision, recall, f1
FROM elist WHERE experiment_id = (SELECT max(experiment_id) FROM elist)"""
ORACLE["loss_curve"] = f"WITH {LOGS_CTE}\n" + """
SELECT experiment_id, CAST(i AS INTEGER) AS epoch, round(train[i], 6) AS train, round(val[i], 6) AS validation
FROM logs, range(1, len(train) + 1) t(i)"""

_SUMMARY = """
, st AS (SELECT avg(error) FILTER (WHERE split = 'train') AS train_mean,
               stddev_pop(error) FILTER (WHERE split = 'train') AS train_std,
               avg(error) FILTER (WHERE split = 'test') AS test_mean,
               stddev_pop(error) FILTER (WHERE split = 'test') AS test_std FROM err),
pr AS (SELECT true_positives / greatest(true_positives + false_positives, 1) AS precision,
              true_positives / greatest(n_syn, 1) AS recall FROM cm),
sz AS (SELECT CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train_size,
              CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS test_size FROM lab)
SELECT cm.true_positives, cm.false_positives,
       CAST(cm.n_syn - cm.true_positives AS BIGINT) AS false_negatives,
       CAST(cm.n_test - cm.false_positives AS BIGINT) AS true_negatives,
       round(thr.p95, 6) AS p95, round(thr.p99, 6) AS p99,
       round(st.train_mean, 6) AS train_mean, round(st.train_std, 6) AS train_std,
       round(st.test_mean, 6) AS test_mean, round(st.test_std, 6) AS test_std,
       sz.train_size, sz.test_size, CAST(greatest(sz.test_size, 5) AS BIGINT) AS synthetic_anomalies,
       round(pr.precision, 6) AS precision, round(pr.recall, 6) AS recall,
       round(2.0 * pr.precision * pr.recall / greatest(pr.precision + pr.recall, 1e-8), 6) AS f1
FROM cm, thr, st, pr, sz"""
ORACLE["evaluation_summary"] = _S + _SUMMARY


# --- the network with weights from a formula ------------------------------------

def _network_ctes() -> list[str]:
    dims = [5, 64, 32, 16, 32, 64, 5]
    theta = lambda k: f"(({k}) * 7919 % 2003) / 2003::DOUBLE - 0.5::DOUBLE"
    weights, at = [], 0
    for n, (i, o) in enumerate(zip(dims[:-1], dims[1:])):
        weights.append(f"list_transform(range({o}), lambda j: list_transform(range({i}), lambda i: "
                       f"{theta(f'{at} + i * {o} + j')})) AS w{n}")
        weights.append(f"list_transform(range({o}), lambda j: {theta(f'{at + i * o} + j')}) AS b{n}")
        at += i * o + o
    ctes = [f"net AS MATERIALIZED (SELECT {', '.join(weights)})",
            f"""x0 AS (SELECT time_window, split, [{', '.join(METRICS)}] AS x, [{', '.join(METRICS)}] AS h FROM lab
                UNION ALL SELECT NULL, 'synthetic', [{', '.join(METRICS)}], [{', '.join(METRICS)}] FROM syn)"""]
    for n, o in enumerate(dims[1:]):
        z = f"list_dot_product(h, w{n}[j + 1]) + b{n}[j + 1]"
        z = f"1 / (1 + exp(-({z})))" if n == len(dims) - 2 else f"greatest({z}, 0::DOUBLE)"
        ctes.append(f"x{n + 1} AS (SELECT time_window, split, x, list_transform(range({o}), lambda j: {z}) AS h FROM x{n}, net)")
    ctes.append("neterr AS (SELECT time_window, split, list_sum(list_transform(range(5), "
                "lambda j: (x[j + 1] - h[j + 1]) * (x[j + 1] - h[j + 1]))) / 5.0 AS error FROM x6)")
    return ctes


_NET = with_base(*[c for c in SCORING_CTES if c.split()[0] not in ("mu", "err", "thr", "synerr", "cm")],
                 *_network_ctes())
ORACLE["network_scores"] = _NET + """
SELECT time_window, split, round(error, 6) AS error FROM neterr WHERE split <> 'synthetic'"""
ORACLE["network_latent"] = _NET + """
SELECT time_window, split, CAST(unnest(range(16)) AS INTEGER) AS dim, round(unnest(h), 6) AS value
FROM x3 WHERE split <> 'synthetic'"""
ORACLE["network_report"] = _NET + """
, err AS (SELECT * FROM neterr WHERE split <> 'synthetic'),
thr AS (SELECT quantile_cont(error, 0.95) AS p95, quantile_cont(error, 0.99) AS p99 FROM err WHERE split = 'train'),
cm AS (SELECT CAST(count(*) FILTER (WHERE split = 'synthetic' AND error > p95) AS BIGINT) AS true_positives,
              CAST(count(*) FILTER (WHERE split = 'test' AND error > p95) AS BIGINT) AS false_positives,
              count(*) FILTER (WHERE split = 'synthetic') AS n_syn,
              count(*) FILTER (WHERE split = 'test') AS n_test FROM neterr, thr)""" + _SUMMARY

_CLEAN_COLUMNS = [("event_id", "STRING", False), ("timestamp", "TIMESTAMP", False),
                  ("device_id", "STRING", False), ("metric_name", "STRING", False),
                  ("value", "DOUBLE", False), ("unit", "STRING", False),
                  ("location", "STRING", False), ("processed_at", "TIMESTAMP", True)]
_DEAD_COLUMNS = [("event_id", "STRING", False), ("original_data", "STRING", False),
                 ("rejection_reason", "STRING", False), ("rejected_at", "TIMESTAMP", True)]
_HOURLY_COLUMNS = [("hour_window", "TIMESTAMP", False), ("device_id", "STRING", False),
                   ("metric_name", "STRING", False), ("avg_value", "DOUBLE", True),
                   ("min_value", "DOUBLE", True), ("max_value", "DOUBLE", True),
                   ("stddev_value", "DOUBLE", True), ("event_count", "BIGINT", False),
                   ("computed_at", "TIMESTAMP", True)]
ORACLE["table_detail"] = _C + """
SELECT t.table_name, t.row_count, t.last_updated, t.snapshot_count, t.quality_score,
       c.position, c.column_name, c.data_type, c.nullable
FROM tables t JOIN (VALUES """ + ", ".join(
    f"('{t}', {i + 1}, '{n}', '{ty}', {str(nl).lower()})"
    for t, columns in (("clean_events", _CLEAN_COLUMNS), ("dead_letter", _DEAD_COLUMNS),
                       ("hourly_aggregates", _HOURLY_COLUMNS))
    for i, (n, ty, nl) in enumerate(columns)
) + """) AS c(table_name, position, column_name, data_type, nullable) USING (table_name)"""

ORACLE["device_time_split"] = with_base() + """
, kp AS (SELECT date_trunc('minute', "timestamp") AS time_window, device_id
         FROM clean WHERE "timestamp" IS NOT NULL GROUP BY 1, 2),
kr AS (SELECT *, row_number() OVER (ORDER BY time_window, device_id) - 1 AS position,
              count(*) OVER () AS n FROM kp)
SELECT time_window, device_id, position,
       CASE WHEN position < CAST(trunc(n * 0.7::DOUBLE) AS BIGINT) THEN 'train'
            WHEN position < CAST(trunc(n * (0.7::DOUBLE + 0.15::DOUBLE)) AS BIGINT) THEN 'val'
            ELSE 'test' END AS split
FROM kr"""
