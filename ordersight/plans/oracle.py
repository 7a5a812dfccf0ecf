"""DuckDB oracle SQL for the catalogue: an independent re-statement of each query.

The feed adapter is restated in SQL from its *fields* (not by parsing raw lines),
so the Spark path (text line -> ``from_csv`` -> cascade) is checked end to end.
"""
from __future__ import annotations

# ---- shared CTEs ----

FEED = r"""
ev AS (
  SELECT event_id AS e, ts, date_trunc('hour', ts) AS bt,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value, hour(ts) AS h
  FROM events),
fd AS (
  SELECT e, ts, bt, h, strftime(bt, '%Y%m%dT%H%M%SZ') || '_0001' AS batch,
         5 + (e * 7919) % 146 AS d10, 5 + k % 26 AS prep,
         CAST(floor(value * 100 + 0.5) AS BIGINT) AS cents, (e * 104729) % 17 - 8 AS noise
  FROM ev),
fields AS (
  SELECT batch, bt AS batch_time, e AS pos,
    CASE WHEN e % 101 = 1 THEN '' WHEN e % 29 = 7 THEN 'EV-' || (e - 1)
         WHEN e % 13 = 0 THEN ' EV-' || e ELSE 'EV-' || e END AS f_order_id,
    CASE WHEN e % 53 = 9 THEN '2024-13-01T00:00:00Z'
         WHEN e % 59 = 10 THEN strftime(ts, '%Y-%m-%d %H:%M:%SZ')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS f_timestamp,
    CASE WHEN e % 31 = 2 THEN '-1.0' WHEN e % 37 = 3 THEN '999.0' WHEN e % 97 = 5 THEN 'nan'
         ELSE (d10 // 10) || '.' || (d10 % 10) END AS f_distance_km,
    CASE WHEN e % 41 = 4 THEN 'n/a' WHEN e % 83 = 6 THEN '12.5' WHEN e % 7 = 0 THEN prep || '.0'
         ELSE CAST(prep AS VARCHAR) END AS f_prep_minutes,
    CASE WHEN e % 43 = 8 THEN '' ELSE (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS f_order_value,
    CASE WHEN e % 47 = 11 THEN 'yes'
         ELSE CAST(CAST(10 * prep + 3 * d10 + 10 * noise
                        + CASE WHEN h IN (11, 12, 13, 17, 18, 19, 20) THEN 80 ELSE 0 END > 400 AS INTEGER) AS VARCHAR) END AS f_was_late,
    CASE WHEN e % 61 = 12 THEN 7 WHEN e % 67 = 13 THEN 5 ELSE 6 END AS n_fields,
    CAST(10 * prep + 3 * d10 + 10 * noise
         + CASE WHEN h IN (11, 12, 13, 17, 18, 19, 20) THEN 80 ELSE 0 END > 400 AS INTEGER) AS true_late
  FROM fd),
raw AS (
  SELECT batch, batch_time, pos, n_fields,
    CASE WHEN n_fields = 7 THEN concat_ws(',', f_order_id, f_timestamp, f_distance_km, f_prep_minutes, f_order_value, f_was_late, 'x')
         WHEN n_fields = 5 THEN concat_ws(',', f_order_id, f_timestamp, f_distance_km, f_prep_minutes, f_order_value)
         ELSE concat_ws(',', f_order_id, f_timestamp, f_distance_km, f_prep_minutes, f_order_value, f_was_late) END AS raw_line,
    f_order_id AS order_id, f_timestamp AS timestamp, f_distance_km AS distance_km,
    f_prep_minutes AS prep_minutes, f_order_value AS order_value,
    CASE WHEN n_fields = 5 THEN '' ELSE f_was_late END AS was_late
  FROM fields),
trimmed AS (
  SELECT *,
    regexp_replace(order_id, '^\s+|\s+$', '', 'g') AS t_order_id,
    regexp_replace(timestamp, '^\s+|\s+$', '', 'g') AS t_timestamp,
    regexp_replace(distance_km, '^\s+|\s+$', '', 'g') AS t_distance_km,
    regexp_replace(prep_minutes, '^\s+|\s+$', '', 'g') AS t_prep_minutes,
    regexp_replace(order_value, '^\s+|\s+$', '', 'g') AS t_order_value,
    regexp_replace(was_late, '^\s+|\s+$', '', 'g') AS t_was_late
  FROM raw),
parsed AS (
  SELECT *,
    CASE WHEN t_order_id <> '' THEN pos > min(pos) OVER (PARTITION BY batch, t_order_id) ELSE false END AS is_dup,
    CASE WHEN regexp_full_match(t_timestamp, '\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z')
         THEN try_strptime(t_timestamp, '%Y-%m-%dT%H:%M:%SZ') END AS ts_ok,
    CASE WHEN regexp_full_match(t_distance_km, '[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?')
              AND isfinite(TRY_CAST(t_distance_km AS DOUBLE)) THEN TRY_CAST(t_distance_km AS DOUBLE) END AS d_num,
    CASE WHEN regexp_full_match(t_prep_minutes, '[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?')
              AND isfinite(TRY_CAST(t_prep_minutes AS DOUBLE))
              AND TRY_CAST(t_prep_minutes AS DOUBLE) = floor(TRY_CAST(t_prep_minutes AS DOUBLE))
         THEN CAST(TRY_CAST(t_prep_minutes AS DOUBLE) AS BIGINT) END AS p_num,
    CASE WHEN regexp_full_match(t_order_value, '[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?')
              AND isfinite(TRY_CAST(t_order_value AS DOUBLE)) THEN TRY_CAST(t_order_value AS DOUBLE) END AS v_num
  FROM trimmed),
ann AS (
  SELECT *,
    CASE WHEN is_dup THEN 'duplicate_id'
         WHEN n_fields <> 6 THEN 'wrong_field_count'
         WHEN t_order_id = '' OR t_timestamp = '' OR t_distance_km = '' OR t_prep_minutes = ''
              OR t_order_value = '' OR t_was_late = '' THEN 'blank'
         WHEN ts_ok IS NULL THEN 'bad_timestamp'
         WHEN d_num IS NULL OR p_num IS NULL OR v_num IS NULL THEN 'not_a_number'
         WHEN NOT (d_num > 0 AND d_num <= 50 AND p_num > 0 AND p_num <= 120 AND v_num > 0 AND v_num <= 1000) THEN 'out_of_range'
         WHEN t_was_late NOT IN ('0', '1') THEN 'bad_label'
    END AS reason
  FROM parsed),
feat AS (
  SELECT t_order_id AS order_id, ts_ok AS ts, CAST(substr(t_timestamp, 12, 2) AS INTEGER) AS hour,
    CAST(CAST(substr(t_timestamp, 12, 2) AS INTEGER) IN (11, 12, 13, 17, 18, 19, 20) AS INTEGER) AS is_peak,
    round(d_num, 1) AS distance_km, CAST(p_num AS INTEGER) AS prep_minutes, round(v_num, 2) AS order_value,
    CAST(t_was_late AS INTEGER) AS was_late, batch, batch_time, pos
  FROM ann WHERE reason IS NULL),
rej AS (
  SELECT order_id, timestamp, distance_km, prep_minutes, order_value, was_late, reason, raw_line,
         batch, batch_time, pos
  FROM ann WHERE reason IS NOT NULL),
pred AS (
  SELECT order_id, round(1.0 / (1.0 + exp(-(-7.0 + 0.6 * distance_km + 0.25 * prep_minutes))), 3) AS late_probability,
         CAST(round(1.0 / (1.0 + exp(-(-7.0 + 0.6 * distance_km + 0.25 * prep_minutes))), 3) >= 0.5 AS INTEGER) AS predicted_late,
         'model_v0001' AS checkpoint_id, batch, pos
  FROM feat)
"""


def cte(extra_ctes: str, select: str) -> str:
    """Feed CTEs + extra CTEs (``name AS (...)`` list, may be empty) + final SELECT."""
    parts = FEED.strip()
    if extra_ctes.strip():
        parts += ",\n" + extra_ctes.strip()
    return "WITH " + parts + "\n" + select.strip()
