"""DuckDB SQL twins of the registered queries (same tables, same column names).

DuckDB's ``hour()`` is BIGINT where Spark's is INT, so hours are cast.
"""

from __future__ import annotations

from sigflow.schemas import (
    BAND_ABOVE,
    BANDS,
    CONTACT_DEFAULT,
    DEFAULT_LOCATION,
    FALLBACK_VENUE,
    LR_FEATURES,
    LR_LABEL,
    ROUTER_KEYWORDS,
    SIGNAL_MAPPING,
    VENUE_SCHEMA,
)

# Shaped readings from events (same fixed mapping rule as the Spark adapter).
_READINGS = """
readings AS (
  SELECT CAST(ts AS DATE) AS signal_date,
         ts AS signal_ts,
         DATE '2024-02-01' AS create_date,
         TIMESTAMP '2024-02-01 00:00:00' AS create_ts,
         CAST(value * 12 AS VARCHAR) AS ActivePower_kW,
         json_extract_string(props, '$.k') AS WindSpeed_m_s,
         CAST(event_id % 3600 AS VARCHAR) AS PowerCurve_kWh,
         CAST(user_id % 360 AS VARCHAR) AS WindDirection_deg
  FROM events)"""

_RAW = """
raw AS (
  SELECT event_id,
         strftime(ts, '%d %m %Y %H:%M') AS date_time,
         CAST(value * 12 AS DOUBLE) AS active_power,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS wind_speed,
         CAST(event_id % 3600 AS DOUBLE) AS power_curve,
         CAST(user_id % 360 AS DOUBLE) AS wind_direction
  FROM events)"""


def _hourly(cast: str) -> str:
    return f"""
hourly AS (
  SELECT signal_date, CAST(hour(signal_ts) AS INTEGER) AS hour,
         avg(TRY_CAST(ActivePower_kW AS {cast})) AS avg_ActivePower_kW,
         avg(TRY_CAST(WindSpeed_m_s AS {cast})) AS avg_WindSpeed_m_s,
         avg(TRY_CAST(PowerCurve_kWh AS {cast})) AS avg_PowerCurve_kWh,
         avg(TRY_CAST(WindDirection_deg AS {cast})) AS avg_WindDirection_deg
  FROM readings GROUP BY 1, 2)"""


_BAND = (
    "CASE " + " ".join(f"WHEN avg_ActivePower_kW < {below} THEN '{name}'" for below, name in BANDS)
    + f" ELSE '{BAND_ABOVE}' END"
)


def _report(cast: str) -> str:
    return f"""{_hourly(cast)},
report AS (
  SELECT signal_date, hour,
         avg_ActivePower_kW AS active_power_average,
         avg_WindSpeed_m_s AS wind_speed_average,
         avg_PowerCurve_kWh AS theo_power_curve_average,
         avg_WindDirection_deg AS wind_direction_average,
         {_BAND} AS generation_mapping
  FROM hourly)"""


_INDEXED = """,
label_counts AS (
  SELECT generation_mapping, count(*) AS c FROM report GROUP BY 1),
label_ids AS (
  SELECT generation_mapping,
         CAST(row_number() OVER (ORDER BY c DESC, generation_mapping) - 1 AS DOUBLE)
           AS generation_status_index
  FROM label_counts),
indexed AS (
  SELECT report.*, label_ids.generation_status_index
  FROM report JOIN label_ids USING (generation_mapping))"""

_REPLAYED = """,
replayed AS (
  SELECT signal_date, signal_ts, DATE '2024-02-01' AS create_date,
         TIMESTAMP '2024-02-01 00:00:00' AS create_ts,
         ActivePower_kW, WindSpeed_m_s, PowerCurve_kWh, WindDirection_deg FROM readings
  UNION ALL
  SELECT signal_date, signal_ts, DATE '2024-02-02', TIMESTAMP '2024-02-02 06:30:00',
         ActivePower_kW, WindSpeed_m_s, PowerCurve_kWh, WindDirection_deg FROM readings
  UNION ALL
  SELECT signal_date, signal_ts, DATE '2024-02-03', TIMESTAMP '2024-02-03 12:45:00',
         ActivePower_kW, WindSpeed_m_s, PowerCurve_kWh, WindDirection_deg FROM readings)"""

_BASELINE = """,
predictions AS (
  SELECT *, theo_power_curve_average AS prediction FROM report)"""

_TIME_TEXT = """
time_text AS (
  SELECT event_id,
         CASE event_id % 4
           WHEN 0 THEN strftime(ts, '%d %m %Y %H:%M')
           WHEN 1 THEN strftime(ts, '%-d %-m %Y %-H:%-M')
           WHEN 2 THEN ' ' || strftime(ts, '%d %m %Y %H:%M:%S')
           ELSE strftime(ts, '%d %m %Y') END AS raw_time
  FROM events)"""

_DATE_RE = r"'^\s*(\d{1,2} \d{1,2} \d{4})'"
_TS_RE = r"'^\s*(\d{1,2} \d{1,2} \d{4} \d{1,2}:\d{1,2})'"


def _parse_date(col: str) -> str:
    return f"CAST(try_strptime(NULLIF(regexp_extract({col}, {_DATE_RE}, 1), ''), '%d %m %Y') AS DATE)"


def _parse_ts(col: str) -> str:
    return f"try_strptime(NULLIF(regexp_extract({col}, {_TS_RE}, 1), ''), '%d %m %Y %H:%M')"


ORACLE_SQL: dict[str, str] = {
    "scan_readings": f"WITH {_READINGS} SELECT * FROM readings",
    "signal_lookup": f"""WITH {_READINGS}
SELECT signal_ts, TRY_CAST(ActivePower_kW AS DOUBLE) AS ActivePower_kW_value,
       TRY_CAST(WindSpeed_m_s AS DOUBLE) AS WindSpeed_m_s_value,
       TRY_CAST(PowerCurve_kWh AS DOUBLE) AS PowerCurve_kWh_value,
       TRY_CAST(WindDirection_deg AS DOUBLE) AS WindDirection_deg_value
FROM readings""",
    "parse_event_time": f"""WITH {_TIME_TEXT}
SELECT event_id, raw_time, {_parse_date('raw_time')} AS signal_date, {_parse_ts('raw_time')} AS signal_ts
FROM time_text""",
    "row_to_json": f"""WITH {_RAW}
SELECT event_id,
       CAST(to_json({{'Date/Time': date_time, 'LV ActivePower (kW)': active_power,
                'Wind Speed (m/s)': wind_speed, 'Theoretical_Power_Curve (KWh)': power_curve,
                'Wind Direction (°)': wind_direction}}) AS VARCHAR) AS value
FROM raw""",
    "json_parse": f"""WITH {_RAW}
SELECT date_time, CAST(active_power AS VARCHAR) AS active_power,
       CAST(wind_speed AS VARCHAR) AS wind_speed, CAST(power_curve AS VARCHAR) AS power_curve,
       CAST(wind_direction AS VARCHAR) AS wind_direction
FROM raw""",
    "shape_signals": f"""WITH {_RAW}
SELECT {_parse_date('date_time')} AS signal_date, {_parse_ts('date_time')} AS signal_ts,
       DATE '2024-02-01' AS create_date, TIMESTAMP '2024-02-01 00:00:00' AS create_ts,
       CAST(active_power AS VARCHAR) AS ActivePower_kW, CAST(wind_speed AS VARCHAR) AS WindSpeed_m_s,
       CAST(power_curve AS VARCHAR) AS PowerCurve_kWh, CAST(wind_direction AS VARCHAR) AS WindDirection_deg
FROM raw""",
    "json_flatten": "SELECT CAST(event_id AS VARCHAR) AS id, value FROM events",
    "distinct_signals_daily": f"""WITH {_READINGS}
SELECT signal_date, count(DISTINCT signal_ts) AS distinct_signal_count FROM readings GROUP BY 1""",
    "avg_signals_hourly": f"WITH {_READINGS}, {_hourly('FLOAT')} SELECT * FROM hourly",
    "avg_signals_hourly_double": f"WITH {_READINGS}, {_hourly('DOUBLE')} SELECT * FROM hourly",
    "generation_indicator": f"""WITH {_READINGS}, {_hourly('FLOAT')}
SELECT *, {_BAND} AS generation_indicator FROM hourly""",
    "rename_mapped": f"WITH {_READINGS}, {_report('FLOAT')} SELECT * FROM report",
    "mapping_join_long": f"""WITH {_READINGS}, {_hourly('FLOAT')},
mapping AS (
  SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in SIGNAL_MAPPING)}) m(sig_name, sig_mapping_name)),
long AS (
  SELECT * FROM hourly UNPIVOT INCLUDE NULLS (
    value FOR sig_name IN (avg_ActivePower_kW, avg_WindSpeed_m_s, avg_PowerCurve_kWh,
                           avg_WindDirection_deg)))
SELECT long.signal_date, long.hour, long.sig_name,
       coalesce(mapping.sig_mapping_name, long.sig_name) AS sig_mapping_name, long.value
FROM long LEFT JOIN mapping USING (sig_name)""",
    "day_filter": f"""WITH {_READINGS}, {_report('FLOAT')}
SELECT * FROM report WHERE signal_date = DATE '2024-01-19'""",
    "row_count": f"""WITH {_READINGS}, {_hourly('DOUBLE')}
SELECT count(*) AS row_count FROM hourly""",
    "dedup_latest": f"""WITH {_READINGS}{_REPLAYED}
SELECT signal_date, signal_ts, arg_max(create_date, create_ts) AS create_date,
       max(create_ts) AS create_ts,
       ActivePower_kW, WindSpeed_m_s, PowerCurve_kWh, WindDirection_deg
FROM replayed
GROUP BY signal_date, signal_ts, ActivePower_kW, WindSpeed_m_s, PowerCurve_kWh, WindDirection_deg""",
    "ingest_audit": f"""WITH {_READINGS}{_REPLAYED}
SELECT create_date, create_ts, count(*) AS num_records,
       CAST(count_if(signal_ts IS NULL) AS BIGINT) AS null_signal_ts,
       CAST(count_if(signal_date IS NULL) AS BIGINT) AS null_signal_date,
       CAST(count_if(false) AS BIGINT) AS null_signals,
       CAST(count_if(ActivePower_kW IS NULL) AS BIGINT) AS null_ActivePower_kW,
       CAST(count_if(WindSpeed_m_s IS NULL) AS BIGINT) AS null_WindSpeed_m_s,
       CAST(count_if(PowerCurve_kWh IS NULL) AS BIGINT) AS null_PowerCurve_kWh,
       CAST(count_if(WindDirection_deg IS NULL) AS BIGINT) AS null_WindDirection_deg,
       min(signal_ts) AS min_signal_ts, max(signal_ts) AS max_signal_ts,
       min(signal_date) AS min_signal_date, max(signal_date) AS max_signal_date
FROM replayed GROUP BY 1, 2""",
    "label_index": f"""WITH {_READINGS}, {_report('DOUBLE')}{_INDEXED}
SELECT signal_date, hour, generation_mapping, generation_status_index FROM indexed""",
    "drop_invalid_features": f"""WITH {_READINGS}, {_report('DOUBLE')}{_INDEXED}
SELECT signal_date, hour, active_power_average, wind_speed_average, theo_power_curve_average,
       wind_direction_average, generation_status_index
FROM indexed
WHERE wind_speed_average IS NOT NULL AND NOT isnan(wind_speed_average)
  AND theo_power_curve_average IS NOT NULL AND NOT isnan(theo_power_curve_average)
  AND wind_direction_average IS NOT NULL AND NOT isnan(wind_direction_average)
  AND generation_status_index IS NOT NULL AND NOT isnan(generation_status_index)""",
    "hash_split": f"""WITH {_READINGS}, {_report('DOUBLE')}
SELECT signal_date, hour,
       (('0x' || substr(md5(concat_ws(' ', CAST(signal_date AS VARCHAR), CAST(hour AS VARCHAR))), 1, 7))::BIGINT
         % 100) < 80 AS is_train
FROM report""",
    "regression_metrics": f"""WITH {_READINGS}, {_report('DOUBLE')}{_BASELINE},
valid AS (SELECT * FROM predictions WHERE active_power_average IS NOT NULL AND prediction IS NOT NULL)
SELECT count(*) AS n,
       sqrt(sum((active_power_average - prediction) ^ 2) / count(*)) AS rmse,
       avg(abs(active_power_average - prediction)) AS mae,
       1 - sum((active_power_average - prediction) ^ 2)
           / (var_pop(active_power_average) * count(*)) AS r2
FROM valid""",
}

# --- model fit: ordinary least squares by the normal equations ---------------------


def _solve(rows: str, features: list[str], label: str) -> str:
    """CTE ``fit`` (intercept, b0, b1, ...): Gauss-Jordan elimination on the centred Gram matrix."""
    k = range(len(features))
    mean = ", ".join([*(f"avg({f}) AS a{i}" for i, f in enumerate(features)), f"avg({label}) AS ay"])
    dev = [f"({f} - a{i})" for i, f in enumerate(features)]
    sums = [f"sum({dev[i]} * {dev[j]}) AS m{i}_{j}" for i in k for j in k]
    sums += [f"sum({dev[i]} * ({label} - ay)) AS y{i}" for i in k]
    ctes = [f"means AS (SELECT {mean} FROM {rows})", f"step0 AS (SELECT {', '.join(sums)} FROM {rows}, means)"]
    for p in k:
        out = []
        for i in k:
            factor = "1 / m{0}_{0}".format(p) if i == p else f"m{i}_{p} / m{p}_{p}"
            for j in k:
                out.append((f"m{p}_{j} * ({factor})" if i == p else f"m{i}_{j} - m{p}_{j} * ({factor})") + f" AS m{i}_{j}")
            out.append((f"y{p} * ({factor})" if i == p else f"y{i} - y{p} * ({factor})") + f" AS y{i}")
        ctes.append(f"step{p + 1} AS (SELECT {', '.join(out)} FROM step{p})")
    shift = " - ".join(["ay", *(f"y{i} * a{i}" for i in k)])
    ctes.append(f"fit AS (SELECT {shift} AS intercept, {', '.join(f'y{i} AS b{i}' for i in k)} FROM step{len(features)}, means)")
    return ",\n".join(ctes)


def _terms(features: list[str]) -> str:
    rows = ["SELECT 'intercept' AS term, round(intercept, 4) AS coefficient FROM fit"]
    rows += [f"SELECT '{f}', round(b{i}, 4) FROM fit" for i, f in enumerate(features)]
    return " UNION ALL ".join(rows)


_MODEL = f"""WITH {_READINGS}, {_report('DOUBLE')}{_INDEXED},
split AS (
  SELECT *, (('0x' || substr(md5(concat_ws(' ', CAST(signal_date AS VARCHAR), CAST(hour AS VARCHAR))), 1, 7))::BIGINT
             % 100) < 80 AS is_train
  FROM indexed WHERE {" AND ".join(f"{f} IS NOT NULL AND NOT isnan({f})" for f in LR_FEATURES)}),
train AS (SELECT * FROM split WHERE is_train),
{_solve("train", LR_FEATURES, LR_LABEL)},
scored AS (
  SELECT split.*, intercept + {" + ".join(f"b{i} * {f}" for i, f in enumerate(LR_FEATURES))} AS prediction FROM split, fit),
test AS (SELECT * FROM scored WHERE NOT is_train)
"""
_LINEITEM = ["l_quantity", "l_discount", "l_tax"]

ORACLE_SQL.update({
    "avg_signals_hourly_zone": f"""WITH {_READINGS},
moved AS (
  SELECT * REPLACE (CAST(signal_ts + INTERVAL 330 MINUTE AS DATE) AS signal_date, signal_ts + INTERVAL 330 MINUTE AS signal_ts)
  FROM readings),
{_hourly('DOUBLE').replace('FROM readings', 'FROM moved')} SELECT * FROM hourly""",
    "lr_fit": f"{_MODEL} {_terms(LR_FEATURES)}",
    "lr_predict_day": f"""{_MODEL}
SELECT signal_date, hour, round({LR_LABEL}, 4) AS {LR_LABEL}, round(prediction, 4) AS prediction
FROM scored WHERE signal_date = DATE '2024-01-19'""",
    "lr_score_saved": f"""{_MODEL}
SELECT 'batch' AS run, signal_date, hour, {LR_LABEL}, round(prediction, 4) AS prediction
FROM scored WHERE signal_date = DATE '2024-01-19'
UNION ALL
SELECT 'stream', signal_date, hour, {LR_LABEL}, round(prediction, 4) FROM scored""",
    # the sketch is exact over so few hours: the quantile at r is the value in place ceil(r * n)
    "residual_quantiles": f"""{_MODEL},
residuals AS (
  SELECT {LR_LABEL} - prediction AS r, row_number() OVER (ORDER BY {LR_LABEL} - prediction) AS place, count(*) OVER () AS n
  FROM test WHERE {LR_LABEL} - prediction IS NOT NULL),
cuts AS (
  SELECT DISTINCT r AS cut FROM residuals, range(1, 10) AS k(i) WHERE place = CAST(ceil(i / 10 * n) AS BIGINT)),
bounds AS (
  SELECT CAST(row_number() OVER (ORDER BY cut NULLS FIRST) - 1 AS INTEGER) AS bin, cut AS lo, lead(cut) OVER (ORDER BY cut NULLS FIRST) AS hi
  FROM (SELECT cut FROM cuts UNION ALL SELECT NULL))
SELECT bin, round(lo, 4) AS lo, round(hi, 4) AS hi,
       (SELECT count(*) FROM residuals WHERE (lo IS NULL OR r >= lo) AND (hi IS NULL OR r < hi)) AS n
FROM bounds""",
    "lr_evaluate": f"""{_MODEL}
SELECT count(*) AS n, round(sqrt(avg(({LR_LABEL} - prediction) ^ 2)), 4) AS rmse,
       round(avg(abs({LR_LABEL} - prediction)), 4) AS mae,
       round(1 - sum(({LR_LABEL} - prediction) ^ 2) / (var_pop({LR_LABEL}) * count(*)), 4) AS r2
FROM test""",
    "residual_histogram": f"""{_MODEL}
SELECT bin, CAST(bin AS DOUBLE) * 100.0 AS bin_lo, CAST(bin + 1 AS DOUBLE) * 100.0 AS bin_hi, count(*) AS n
FROM (SELECT CAST(floor(({LR_LABEL} - prediction) / 100.0) AS BIGINT) AS bin FROM test) GROUP BY bin""",
    "scatter_bins": f"""{_MODEL}
SELECT CAST(floor({LR_LABEL} / 100.0) AS BIGINT) AS actual_bin,
       CAST(floor(prediction / 100.0) AS BIGINT) AS predicted_bin, count(*) AS n
FROM test GROUP BY 1, 2""",
    "lr_fit_lineitem": f"""WITH {_solve("lineitem", _LINEITEM, "l_extendedprice")} {_terms(_LINEITEM)}""",
})

# --- text jobs -----------------------------------------------------------------

_WS = r"[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]"
_NOT_BLANK = f"(text IS NOT NULL AND NOT regexp_matches(text, '^{_WS}*$'))"


def _route(keywords: list[str]) -> str:
    hits = " OR ".join(f"contains(lower(last_text), '{k}')" for k in keywords)
    return f"""WITH last AS (
  SELECT conv_id, arg_max(text, turn) AS last_text FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE WHEN coalesce({hits}, false) THEN 'search_venues_node'
                     ELSE 'general_chat_node' END AS route
FROM last"""


_ARTICLES = f"""
ranked AS (
  SELECT conv_id, turn, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rk
  FROM conversations WHERE role = 'assistant'),
articles AS (
  SELECT conv_id, turn, text FROM ranked WHERE rk <= 6 AND {_NOT_BLANK})"""

# Venue records: elements of the JSON arrays in the articles, with defaults.
_SPAN = r"(?s)\[[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]*\{.*\}[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]*\]"
_VENUES = f"""
spans AS (SELECT conv_id, turn, regexp_extract(text, '{_SPAN}', 0) AS span FROM articles),
elements AS (
  SELECT conv_id, turn, CAST(i AS INTEGER) AS pos, json_extract(span, '$[' || i || ']') AS v
  FROM (SELECT conv_id, turn, span, unnest(range(CAST(json_array_length(span) AS BIGINT))) AS i
        FROM spans WHERE span <> '' AND json_valid(span))),
venues AS (
  SELECT conv_id, turn, pos, v ->> '$.name' AS name, v ->> '$.location' AS location, v ->> '$.capacity' AS capacity,
         v ->> '$.priceRange' AS priceRange, TRY_CAST(v ->> '$.rating' AS DOUBLE) AS rating,
         v ->> '$.description' AS description, coalesce(v ->> '$.image', '') AS image,
         coalesce(v ->> '$.phone', '{CONTACT_DEFAULT}') AS phone, coalesce(v ->> '$.email', '{CONTACT_DEFAULT}') AS email,
         coalesce(array_to_string(v ->> '$.amenities[*]', '|'), '{CONTACT_DEFAULT}') AS amenities,
         coalesce(array_to_string(v ->> '$.features[*]', '|'), '{CONTACT_DEFAULT}') AS features
  FROM elements)"""
_VENUE_COLUMNS = ", ".join(f.name for f in VENUE_SCHEMA.fields)


def _literal(value) -> str:
    if isinstance(value, float):
        return f"CAST({value} AS DOUBLE)"
    return "'" + ("|".join(value) if isinstance(value, list) else value) + "'"


_FALLBACK = ", ".join(
    f"{_literal({**FALLBACK_VENUE, 'location': DEFAULT_LOCATION}[f.name])} AS {f.name}" for f in VENUE_SCHEMA.fields
)

_REQUESTS = f"""
requests AS (
  SELECT conv_id,
         arg_max(text, turn) FILTER (WHERE role = 'user' AND {_NOT_BLANK}) AS query,
         CAST(count_if(role = 'user') AS VARCHAR) AS guest_count,
         CAST(NULL AS VARCHAR) AS budget_range
  FROM conversations GROUP BY conv_id)"""

ORACLE_SQL.update({
    "drop_blank_turns": f"SELECT * FROM conversations WHERE {_NOT_BLANK}",
    "last_user_turn": f"""SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text
FROM conversations WHERE role = 'user' AND {_NOT_BLANK} GROUP BY conv_id""",
    "route_intent": _route(ROUTER_KEYWORDS),
    "route_intent_keywords": _route(["with", "und", "que"]),
    "extract_json_array": r"""WITH spans AS (
  SELECT doc_id,
         regexp_extract(text, '(?s)\[[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]*\{.*\}[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]*\]', 0) AS span
  FROM documents)
SELECT doc_id,
       CAST(CASE WHEN span = '' OR NOT json_valid(span) THEN 0
                 ELSE json_array_length(span) END AS INTEGER) AS venue_count
FROM spans""",
    "json_arrays": f"""WITH items AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS part
  FROM lineitem)
SELECT l_orderkey, CAST(dense_rank() OVER (PARTITION BY l_orderkey ORDER BY part) - 1 AS INTEGER) AS list_no,
       CAST(row_number() OVER (PARTITION BY l_orderkey, part ORDER BY l_linenumber, 'part [' || l_partkey || ']',
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), CAST(l_suppkey AS VARCHAR)) - 1 AS INTEGER) AS pos,
       'part [' || l_partkey || ']' AS name, CAST(NULL AS VARCHAR) AS location, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS capacity,
       CAST(NULL AS VARCHAR) AS priceRange, CAST(l_linenumber AS DOUBLE) AS rating, CAST(NULL AS VARCHAR) AS description, '' AS image,
       CASE WHEN l_linenumber % 2 = 0 THEN 'supplier ' || l_suppkey ELSE '{CONTACT_DEFAULT}' END AS phone,
       '{CONTACT_DEFAULT}' AS email, '{CONTACT_DEFAULT}' AS amenities, '{CONTACT_DEFAULT}' AS features
FROM items""",
    "normalise_records": f"""WITH {_ARTICLES}, {_VENUES}
SELECT conv_id, turn, pos, {_VENUE_COLUMNS} FROM venues""",
    "cap_items": f"WITH {_ARTICLES} SELECT conv_id, turn FROM articles",
    "search_key": f"""WITH {_REQUESTS}
SELECT conv_id,
       regexp_replace(coalesce(query, '') || ' ' || coalesce(guest_count, '') || ' '
                      || coalesce(budget_range, ''), '^{_WS}+|{_WS}+$', '', 'g') AS search_key
FROM requests""",
    "fallback_record": f"""WITH {_ARTICLES}, {_VENUES}
SELECT conv_id, turn, pos, {_VENUE_COLUMNS} FROM venues
UNION ALL
SELECT DISTINCT conv_id, 0, 0, {_FALLBACK} FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM venues)""",
})

# --- streaming jobs (compared after the stream has run to completion) ----------

ORACLE_SQL.update({
    "stream_ingest": f"""WITH {_RAW}
SELECT {_parse_date('date_time')} AS signal_date, {_parse_ts('date_time')} AS signal_ts,
       CAST(active_power AS VARCHAR) AS ActivePower_kW, CAST(wind_speed AS VARCHAR) AS WindSpeed_m_s,
       CAST(power_curve AS VARCHAR) AS PowerCurve_kWh, CAST(wind_direction AS VARCHAR) AS WindDirection_deg
FROM raw""",
    "stream_hourly": f"""WITH {_READINGS}
SELECT date_trunc('hour', signal_ts) AS window_start,
       date_trunc('hour', signal_ts) + INTERVAL 1 HOUR AS window_end,
       avg(TRY_CAST(ActivePower_kW AS DOUBLE)) AS avg_ActivePower_kW,
       avg(TRY_CAST(WindSpeed_m_s AS DOUBLE)) AS avg_WindSpeed_m_s,
       avg(TRY_CAST(PowerCurve_kWh AS DOUBLE)) AS avg_PowerCurve_kWh,
       avg(TRY_CAST(WindDirection_deg AS DOUBLE)) AS avg_WindDirection_deg
FROM readings GROUP BY 1, 2""",
})

_SHAPED = f"""
shaped AS (
  SELECT {_parse_date('date_time')} AS signal_date, {_parse_ts('date_time')} AS signal_ts,
         CAST(active_power AS VARCHAR) AS ActivePower_kW, CAST(wind_speed AS VARCHAR) AS WindSpeed_m_s,
         CAST(power_curve AS VARCHAR) AS PowerCurve_kWh, CAST(wind_direction AS VARCHAR) AS WindDirection_deg
  FROM raw)"""

ORACLE_SQL.update({
    "stream_replay": f"WITH {_RAW}, {_SHAPED} SELECT DISTINCT * FROM shaped",
    "stream_fanout": f"""WITH {_RAW}, {_SHAPED}
SELECT 'lake' AS target, NULL AS value, * FROM shaped
UNION ALL
SELECT 'raw', CAST(to_json({{'Date/Time': date_time, 'LV ActivePower (kW)': active_power,
         'Wind Speed (m/s)': wind_speed, 'Theoretical_Power_Curve (KWh)': power_curve,
         'Wind Direction (°)': wind_direction}}) AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL
FROM raw""",
    "dedup_first": f"""WITH {_READINGS}
SELECT DISTINCT signal_date, signal_ts, ActivePower_kW, WindSpeed_m_s, PowerCurve_kWh, WindDirection_deg
FROM readings""",
    "save_processed": ORACLE_SQL["rename_mapped"],
    "stream_quarantine": f"""WITH {_TIME_TEXT}, {_RAW},
timed AS (SELECT raw.* REPLACE (raw_time AS date_time) FROM raw JOIN time_text USING (event_id)),
{_SHAPED.replace('FROM raw', 'FROM timed')}
SELECT 'lake' AS target, shaped.*, NULL AS value, NULL AS reason FROM shaped WHERE signal_ts IS NOT NULL
UNION ALL
SELECT 'rejected', NULL, NULL, NULL, NULL, NULL, NULL,
       CAST(to_json({{'Date/Time': date_time, 'LV ActivePower (kW)': active_power,
         'Wind Speed (m/s)': wind_speed, 'Theoretical_Power_Curve (KWh)': power_curve,
         'Wind Direction (°)': wind_direction}}) AS VARCHAR), 'unreadable time'
FROM timed WHERE {_parse_ts('date_time')} IS NULL
UNION ALL
SELECT 'rejected', NULL, NULL, NULL, NULL, NULL, NULL,
       CAST(to_json({{doc_id: doc_id, quality: quality, toxic: toxic}}) AS VARCHAR), 'no time' FROM labels
UNION ALL
SELECT 'rejected', NULL, NULL, NULL, NULL, NULL, NULL, role, 'not a JSON object' FROM conversations""",
    "stream_audit": f"""WITH {_READINGS}
SELECT count(*) AS num_records, CAST(count_if(signal_ts IS NULL) AS BIGINT) AS null_signal_ts,
       CAST(count_if(signal_date IS NULL) AS BIGINT) AS null_signal_date, CAST(0 AS BIGINT) AS null_signals,
       CAST(count_if(ActivePower_kW IS NULL) AS BIGINT) AS null_ActivePower_kW,
       CAST(count_if(WindSpeed_m_s IS NULL) AS BIGINT) AS null_WindSpeed_m_s,
       CAST(count_if(PowerCurve_kWh IS NULL) AS BIGINT) AS null_PowerCurve_kWh,
       CAST(count_if(WindDirection_deg IS NULL) AS BIGINT) AS null_WindDirection_deg,
       min(signal_ts) AS min_signal_ts, max(signal_ts) AS max_signal_ts,
       min(signal_date) AS min_signal_date, max(signal_date) AS max_signal_date
FROM readings""",
    "lake_compacted": f"""WITH {_READINGS}
SELECT signal_date, signal_ts, ActivePower_kW, WindSpeed_m_s, PowerCurve_kWh, WindDirection_deg FROM readings""",
    "lake_as_of": f"""WITH {_READINGS}
SELECT signal_date, signal_ts, ActivePower_kW, WindSpeed_m_s, PowerCurve_kWh, WindDirection_deg
FROM readings WHERE signal_date <= DATE '2024-01-15'""",
})
