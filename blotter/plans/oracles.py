"""The registered queries as SQL over the given tables."""

from __future__ import annotations

from blotter.plans.events import (
    EVENT_AREAS,
    EVENT_COLORS,
    EVENT_THRESHOLDS,
    EVENT_UNIVERSE,
    WINDOW_THRESHOLDS,
)


def _case(column: str, mapping: dict, default: str = "NULL") -> str:
    def literal(value: object) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value)

    whens = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE {default} END"


_AREA = _case("user_id % 6", dict(enumerate(EVENT_AREAS)))

_INC = f"""inc AS (
  SELECT event_id AS incident_id, {_AREA} AS district, event_type AS crime_type,
    substr(sha256(CAST(user_id AS VARCHAR)), 1, 16) AS cedula_hash, ts AS processing_time,
    strftime(ts, '%Y-%m-%d') AS date_partition, user_id, value, props
  FROM events)"""

_DAYS = f"""{_INC}, days AS (
  SELECT date_partition, district, crime_type, count(*) AS n, max(processing_time) AS last_time
  FROM inc GROUP BY ALL)"""

_DENSITY = f"""{_DAYS}, density AS (
  SELECT date_partition, district, CAST(sum(n) AS BIGINT) AS total_crimes,
    count(crime_type) AS crime_type_variety,
    string_agg(crime_type, ',' ORDER BY crime_type) AS crime_types_list,
    string_agg(crime_type || ':' || n, ',' ORDER BY crime_type) AS crime_type_counts,
    max(last_time) AS last_updated,
    CAST(sum(n) * count(crime_type) AS BIGINT) AS crime_density_score
  FROM days GROUP BY ALL)"""

_ALERTS = f"""{_DAYS}, alerts AS (
  SELECT date_partition, district, crime_type, n AS crime_count, last_time AS alert_time,
    TRUE AS is_critical, 'CRITICAL' AS alert_level,
    'ALERTA: ' || n || ' casos de ' || crime_type || ' en ' || district AS alert_message
  FROM days WHERE n >= {_case("crime_type", EVENT_THRESHOLDS)})"""

# A lot is the number of quantiles of the clock, in whole hours, before an event's hour.
_LOTS = """hours AS (
  SELECT date_trunc('hour', processing_time) AS h, count(*) AS n
  FROM inc WHERE processing_time IS NOT NULL GROUP BY h),
  upto AS (SELECT h, sum(n) OVER (ORDER BY h) AS c, sum(n) OVER () AS t FROM hours),
  cuts AS (
  SELECT min(h) FILTER (4 * c >= t) AS c1, min(h) FILTER (4 * c >= 2 * t) AS c2,
    min(h) FILTER (4 * c >= 3 * t) AS c3 FROM upto),
  numbered AS (
  SELECT inc.*, coalesce((date_trunc('hour', processing_time) > c1)::INT, 0)
    + coalesce((date_trunc('hour', processing_time) > c2)::INT, 0)
    + coalesce((date_trunc('hour', processing_time) > c3)::INT, 0) AS number FROM inc, cuts),
  lots AS (
  SELECT *, CAST(dense_rank() OVER (ORDER BY number) - 1 AS BIGINT) AS lot FROM numbered)"""


def _timed(ctes: str) -> str:
    """The same tables without events that have no clock, as no stored table has them."""
    return ctes.replace("FROM events)", "FROM events WHERE ts IS NOT NULL)")


_LOT_ALERTS = f"""{_INC}, {_LOTS}, counted AS (
  SELECT lot, date_partition, district, crime_type, count(*) AS n,
    max(processing_time) AS last_time FROM lots WHERE processing_time IS NOT NULL GROUP BY ALL),
  alerts AS (
  SELECT date_partition, district, crime_type, n AS crime_count, last_time AS alert_time,
    TRUE AS is_critical, 'CRITICAL' AS alert_level,
    'ALERTA: ' || n || ' casos de ' || crime_type || ' en ' || district AS alert_message
  FROM counted WHERE n >= {_case("crime_type", EVENT_THRESHOLDS)})"""

_NOW = "(SELECT max(ts) FROM events)"
_STATISTICS = (
    "date_partition, district, crime_type, n AS crime_count, last_time AS last_updated"
)

_ORDERS = """days AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS date_partition, o_orderstatus AS district,
    o_orderpriority AS crime_type, count(*) AS n, max(o_orderdate) AS last_time
  FROM orders GROUP BY ALL)"""

_DECODED = f"""WITH {_INC}
  SELECT 'INC-' || incident_id AS kafka_key, processing_time AS kafka_timestamp,
    CAST(incident_id % 3 AS INTEGER) AS kafka_partition, incident_id AS kafka_offset,
    processing_time, crime_type, district, cedula_hash, date_partition FROM inc"""

_POINTS = f"""{_INC}, points AS (
  SELECT 'INC-' || incident_id AS id,
    strftime(processing_time, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
    value AS lat, CAST(100 AS DOUBLE) - value AS lon, crime_type AS type, district,
    processing_time AS added_at
  FROM inc)"""

_WINDOWS = f"""{_INC}, days AS (
  SELECT time_bucket(INTERVAL 6 HOUR, processing_time) AS window_start, district, crime_type,
    count(*) AS n, max(processing_time) AS last_time
  FROM inc GROUP BY ALL)"""


def _live(end: str, ttl: str) -> str:
    return f"ts > {end} - INTERVAL {ttl} AND ts <= {end}"


_BEFORE = f"({_NOW} - INTERVAL 1 DAY)"
_SIX_HOURS_AGO = f"({_NOW} - INTERVAL 6 HOUR)"
_FIRST = "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1"
_CATEGORY_KEY = "replace(lower(upper(replace(event_type, 'o', 'ó'))), 'ó', 'o')"
_AGE = f"CAST(floor((epoch_us({_NOW}) - epoch_us(ts)) / 1000000) AS BIGINT)"


def _age_label(age: str) -> str:
    return (
        f"CASE WHEN {age} < 60 THEN {age} || 's' WHEN {age} < 3600 THEN ({age} // 60) || 'm'"
        f" ELSE ({age} // 3600) || 'h' END"
    )


_ALERT_AGE = f"CAST(floor((epoch_us({_NOW}) - epoch_us(alert_time)) / 1000000) AS BIGINT)"

ORACLES: dict[str, str] = {
    # envelope
    "envelope_decode": _DECODED,
    "envelope_decode_per_path": _DECODED,
    "fact_projection": f"""WITH {_INC}
        SELECT 'INC-' || incident_id AS crime_data, processing_time,
          processing_time AS kafka_timestamp, crime_type, cedula_hash, date_partition, district
        FROM inc""",
    "topic_envelope": f"""WITH {_INC}
        SELECT 'INC-' || incident_id AS key, district, value AS lat,
          date_trunc('millisecond', processing_time) AS processing_time,
          date_trunc('millisecond', processing_time) AS kafka_timestamp,
          CAST(incident_id % 3 AS INTEGER) AS kafka_partition, incident_id AS kafka_offset
        FROM inc""",
    "json_default_filter": """
        SELECT event_id, coalesce(json_extract_string(props, '$.k'), 'Unknown') AS k,
          coalesce(json_extract_string(props, '$.absent'), 'Unknown') AS absent,
          strftime(ts, '%Y-%m-%d') AS date_partition
        FROM events WHERE coalesce(json_extract_string(props, '$.k'), 'Unknown') <> ''""",
    "point_decode": f"WITH {_POINTS} SELECT * FROM points",
    "anonymize_id": f"WITH {_INC} SELECT incident_id, cedula_hash FROM inc",
    # rollups
    "statistics": f"WITH {_DAYS} SELECT {_STATISTICS} FROM days",
    "temporal_profile": f"""WITH {_INC}
        SELECT date_partition, district, crime_type,
          CAST(hour(processing_time) AS INTEGER) AS hour,
          CAST(dayofweek(processing_time) + 1 AS INTEGER) AS day_of_week,
          count(*) AS crimes_per_hour, avg(hour(processing_time)) AS avg_hour,
          max(processing_time) AS last_crime_time
        FROM inc GROUP BY date_partition, district, crime_type, 4, 5""",
    "ten_minute_bucket": """
        SELECT event_type AS crime_type,
          CAST(minute(ts) // 10 * 10 AS BIGINT) AS minute_window, count(*) AS n
        FROM events GROUP BY ALL""",
    "density_by_area": f"WITH {_DENSITY} SELECT * FROM density",
    "density_category_bag": f"""WITH {_DAYS}, chunks AS (
          SELECT date_partition, district, crime_type, n,
            unnest(range(0, CAST((n - 1) // 5 AS BIGINT) + 1)) AS chunk_no FROM days)
        SELECT date_partition, district, crime_type, CAST(chunk_no AS INTEGER) AS chunk_no,
          rtrim(repeat(crime_type || ',', least(5, n - chunk_no * 5)), ',') AS crime_types_list
        FROM chunks""",
    "correlation": f"""WITH {_DAYS}
        SELECT date_partition, district,
          string_agg(crime_type, ',' ORDER BY crime_type) AS crime_types_in_area,
          CAST(sum(n) AS BIGINT) AS total_crimes_in_area,
          count(DISTINCT crime_type) AS unique_crime_types,
          max(last_time) AS last_updated,
          count(DISTINCT crime_type) / {float(EVENT_UNIVERSE)} AS crime_diversity_index
        FROM days GROUP BY ALL""",
    "reporter_counts": f"""WITH {_INC}
        SELECT date_partition, district, crime_type,
          count(DISTINCT cedula_hash) AS reporters FROM inc GROUP BY ALL""",
    "merged_batch_cells": f"WITH {_DAYS} SELECT {_STATISTICS} FROM days",
    # density
    "density_list_normalize": f"""WITH {_DENSITY}
        SELECT district, total_crimes, CAST(crime_density_score AS DOUBLE)
          AS crime_density_score, crime_types_list, last_updated, date_partition,
          crime_type_variety FROM density""",
    "density_rank": f"""WITH {_DENSITY}
        SELECT district, total_crimes, crime_type_variety,
          CAST(crime_density_score AS DOUBLE) AS crime_density_score, crime_types_list,
          last_updated, date_partition
        FROM density ORDER BY crime_density_score DESC, district, date_partition""",
    "density_summary": f"""WITH {_DENSITY}
        SELECT CAST(sum(total_crimes) AS BIGINT) AS total_crimes,
          round(avg(crime_density_score), 2) AS avg_density,
          round(CAST(max(crime_density_score) AS DOUBLE), 2) AS max_density,
          count(*) AS districts_analyzed,
          (SELECT district FROM density
           ORDER BY crime_density_score DESC, district, date_partition LIMIT 1) AS hotspot
        FROM density""",
    "density_summary_empty": """
        SELECT CAST(count(*) AS BIGINT) AS total_crimes, CAST(0 AS DOUBLE) AS avg_density,
          CAST(0 AS DOUBLE) AS max_density, count(*) AS districts_analyzed, 'N/A' AS hotspot
        FROM events WHERE event_id < 0 AND event_id > 0""",
    "hotspot": f"""WITH {_DENSITY}
        SELECT district, date_partition, crime_density_score FROM density
        ORDER BY crime_density_score DESC, district, date_partition LIMIT 1""",
    "density_percent": f"""WITH {_DENSITY}
        SELECT date_partition, district,
          round(crime_density_score / max(crime_density_score) OVER () * 100, 4)
            AS density_percent,
          crime_type_variety || '/{EVENT_UNIVERSE}' AS variety_ratio
        FROM density""",
    # alerts
    "threshold_evaluation": f"""WITH {_DAYS}
        SELECT date_partition, district, crime_type, n AS crime_count,
          last_time AS alert_time,
          coalesce(n >= {_case("crime_type", EVENT_THRESHOLDS)}, FALSE) AS is_critical
        FROM days""",
    "critical_alerts": f"WITH {_ALERTS} SELECT * FROM alerts",
    "critical_alerts_by_table": f"""WITH {_DAYS}, limits AS (
          SELECT crime_type AS category, ceil(avg(n)) AS threshold FROM days GROUP BY ALL)
        SELECT date_partition, district, crime_type, n AS crime_count,
          last_time AS alert_time, TRUE AS is_critical, 'CRITICAL' AS alert_level,
          'ALERTA: ' || n || ' casos de ' || crime_type || ' en ' || district
            AS alert_message
        FROM days JOIN limits ON crime_type = category AND n >= threshold""",
    "windowed_alerts": f"""WITH {_WINDOWS}
        SELECT window_start, district, crime_type, n AS crime_count,
          last_time AS alert_time, TRUE AS is_critical, 'CRITICAL' AS alert_level,
          'ALERTA: ' || n || ' casos de ' || crime_type || ' en ' || district
            AS alert_message
        FROM days WHERE n >= {_case("crime_type", WINDOW_THRESHOLDS)}""",
    "alert_normalize": f"""WITH {_ALERTS}
        SELECT district, crime_type, crime_count, alert_level, alert_message, is_critical,
          alert_time AS added_at FROM alerts""",
    "alert_feed": f"""WITH {_ALERTS}
        SELECT district, crime_type, crime_count, alert_level, alert_message, is_critical,
          {_ALERT_AGE} AS time_ago, {_age_label(_ALERT_AGE)} AS time_ago_label,
          'CRÍTICA' AS severity
        FROM alerts
        WHERE alert_time > {_NOW} - INTERVAL 7 DAY AND alert_time <= {_NOW}""",
    "alert_counts": f"""WITH {_DAYS}
        SELECT count(*) AS count,
          count(*) FILTER (n >= {_case("crime_type", EVENT_THRESHOLDS)}) AS critical_count
        FROM days""",
    "alert_area_recovery": f"""WITH {_ALERTS}
        SELECT alert_message,
          trim(regexp_extract(alert_message, ' en ([A-Za-záéíóúñÑ\\s]+)$', 1)) AS district
        FROM alerts""",
    # feeds
    "active_incidents": f"""
        SELECT event_id AS id, {_AREA} AS district, event_type AS crime_type, ts AS added_at
        FROM events WHERE {_live(_NOW, "1 DAY")}""",
    "live_first_per_reporter": f"""
        SELECT user_id, event_id AS id, {_AREA} AS district, ts AS added_at
        FROM events WHERE {_live(_NOW, "10 DAY")} {_FIRST}""",
    "new_incidents": f"""
        SELECT user_id, event_id AS id, ts AS added_at FROM events
        WHERE {_live(_NOW, "1 DAY")} AND user_id NOT IN
          (SELECT user_id FROM events WHERE {_live(_BEFORE, "1 DAY")}) {_FIRST}""",
    "new_incidents_with_repeats": f"""
        SELECT user_id, event_id AS id, ts AS added_at FROM events
        WHERE {_live(_NOW, "1 DAY")} AND user_id NOT IN
          (SELECT user_id FROM events WHERE {_live(_BEFORE, "1 DAY")})""",
    "expired_incidents": f"""
        SELECT event_id AS id, ts AS added_at FROM events
        WHERE {_live(_SIX_HOURS_AGO, "1 DAY")} AND NOT ({_live(_NOW, "1 DAY")})""",
    "extended_live_set": f"""
        (SELECT user_id, event_id AS id, ts AS added_at FROM events
         WHERE {_live(_BEFORE, "1 DAY")} {_FIRST})
        UNION ALL
        (SELECT user_id, event_id AS id, ts AS added_at FROM events
         WHERE {_live(_NOW, "1 DAY")} AND user_id NOT IN
           (SELECT user_id FROM events WHERE {_live(_BEFORE, "1 DAY")}) {_FIRST})""",
    "feed_metrics": f"""
        SELECT count(*) FILTER (({_live(_SIX_HOURS_AGO, "1 DAY")})
            AND NOT ({_live(_NOW, "1 DAY")})) AS expired_count,
          count(*) FILTER (({_live(_NOW, "1 DAY")})
            AND NOT ({_live(_SIX_HOURS_AGO, "1 DAY")})) AS added_count,
          count(*) FILTER ({_live(_NOW, "1 DAY")}) AS active_count
        FROM events""",
    "incident_view": f"""WITH {_POINTS}
        SELECT id, lat, lon, type, district, timestamp FROM points
        WHERE added_at > {_NOW} - INTERVAL 1 DAY""",
    "age_labels": f"""
        SELECT event_id AS id, {_AGE} AS time_ago, {_age_label(_AGE)} AS time_ago_label
        FROM events""",
    "latest_per_area": f"""WITH {_INC}
        SELECT incident_id, district, processing_time FROM inc
        QUALIFY row_number() OVER
          (PARTITION BY district ORDER BY processing_time DESC, incident_id) <= 8""",
    "latest_per_area_deep": f"""WITH {_INC}
        SELECT incident_id, district, processing_time FROM inc
        QUALIFY row_number() OVER
          (PARTITION BY district ORDER BY processing_time DESC, incident_id) <= 1200""",
    "latest_overall": f"""WITH {_INC}
        SELECT incident_id, district, processing_time FROM inc
        ORDER BY processing_time DESC, incident_id LIMIT 10""",
    "category_lookup": f"""
        SELECT event_id AS incident_id, upper(replace(event_type, 'o', 'ó')) AS type,
          {_case(_CATEGORY_KEY, EVENT_COLORS, "'#666666'")} AS color FROM events""",
    "category_lookup_exact": f"""
        SELECT event_id AS incident_id, upper(replace(event_type, 'o', 'ó')) AS type,
          {_case("lower(upper(replace(event_type, 'o', 'ó')))", EVENT_COLORS, "'#666666'")}
            AS color FROM events""",
    # batches
    "snapshot_latest_batch": f"""WITH {_INC}
        SELECT incident_id, district, date_trunc('hour', processing_time) AS batch FROM inc
        WHERE date_trunc('hour', processing_time) = date_trunc('hour', {_NOW})""",
    "batch_volume_per_trigger": """
        SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS trigger_start,
          count(*) AS record_count FROM events GROUP BY ALL""",
    # storage
    "partition_scan": f"""WITH {_INC}
        SELECT CAST(incident_id AS VARCHAR) AS crime_data, crime_type, district,
          date_partition
        FROM inc WHERE date_partition = (SELECT max(date_partition) FROM inc)""",
    "table_scan": f"""WITH {_INC}
        SELECT CAST(incident_id AS VARCHAR) AS crime_data, processing_time, crime_type,
          cedula_hash, date_partition, district FROM inc""",
    "area_discovery": f"WITH {_INC} SELECT DISTINCT district FROM inc",
    "area_discovery_default": f"""WITH {_INC}
        SELECT DISTINCT date_partition AS day, district FROM inc
        WHERE date_partition = (SELECT max(date_partition) FROM inc)
        UNION ALL
        SELECT strftime(max(ts) + INTERVAL 1 DAY, '%Y-%m-%d'), unnest({list(EVENT_AREAS[:3])})
        FROM events""",
    "file_census_by_partition": f"""WITH {_INC}, lots AS (
          SELECT date_partition, district,
            CASE WHEN hour(processing_time) < 12 THEN 'lot-1' ELSE 'lot-2' END AS lot FROM inc)
        SELECT date_partition, district, count(DISTINCT lot) AS file_count,
          max(lot) AS newest_lot, count(*) AS rows FROM lots GROUP BY ALL""",
    "latest_files_per_area": f"""WITH {_INC}, lots AS (
          SELECT CAST(incident_id AS VARCHAR) AS crime_data, district, date_partition,
            CASE WHEN hour(processing_time) < 12 THEN 'lot-1' ELSE 'lot-2' END AS batch_key
          FROM inc)
        SELECT * FROM lots
        QUALIFY batch_key = max(batch_key) OVER (PARTITION BY date_partition, district)""",
    "latest_files_overall": f"""WITH {_INC}
        SELECT CAST(incident_id AS VARCHAR) AS crime_data, district, date_partition,
          'lot-2' AS batch_key FROM inc WHERE hour(processing_time) >= 12""",
    "sample_read_of_table": f"""WITH {_INC}
        SELECT count(*) AS row_count,
          'crime_data,processing_time,kafka_timestamp,crime_type,cedula_hash,'
            || 'date_partition,district' AS columns,
          CAST(min(incident_id) AS VARCHAR) AS crime_data,
          arg_min(crime_type, incident_id) AS crime_type,
          arg_min(district, incident_id) AS district FROM inc""",
    "replaced_table": f"WITH {_DAYS} SELECT {_STATISTICS} FROM days",
    "replaced_partitions": f"WITH {_DAYS} SELECT {_STATISTICS} FROM days",
    # streaming
    "stream_rollup": f"WITH {_timed(_DAYS)} SELECT {_STATISTICS} FROM days",
    "stream_temporal": f"""WITH {_timed(_INC)}
        SELECT crime_type, CAST(hour(processing_time) AS INT) AS hour,
          CAST(dayofweek(processing_time) + 1 AS INT) AS day_of_week,
          count(*) AS crimes_per_hour, CAST(hour(processing_time) AS DOUBLE) AS avg_hour,
          max(processing_time) AS last_crime_time, date_partition, district
        FROM inc GROUP BY ALL""",
    "stream_density": f"""WITH {_timed(_DENSITY)}
        SELECT * EXCLUDE (crime_type_counts) FROM density""",
    "stream_correlation": f"""WITH {_timed(_DAYS)}
        SELECT date_partition, district,
          string_agg(crime_type, ',' ORDER BY crime_type) AS crime_types_in_area,
          CAST(sum(n) AS BIGINT) AS total_crimes_in_area,
          count(DISTINCT crime_type) AS unique_crime_types,
          max(last_time) AS last_updated,
          count(DISTINCT crime_type) / {EVENT_UNIVERSE}.0 AS crime_diversity_index
        FROM days GROUP BY ALL""",
    "stream_alerts": f"WITH {_LOT_ALERTS} SELECT * FROM alerts",
    "stream_last_batch": f"""WITH {_INC}, {_LOTS}
        SELECT date_partition, district, crime_type, count(*) AS crime_count,
          max(processing_time) AS last_updated
        FROM lots WHERE lot = (SELECT max(lot) FROM lots) AND processing_time IS NOT NULL
        GROUP BY ALL""",
    "stream_facts": f"""WITH {_timed(_INC)}
        SELECT 'INC-' || incident_id AS crime_id, processing_time, crime_type, cedula_hash,
          date_partition, district FROM inc""",
    "stream_resumed_and_replayed": f"""WITH {_timed(_INC)}
        SELECT date_partition, 2 * count(*) AS facts FROM inc GROUP BY ALL""",
    "stream_live_feed": """
        WITH RECURSIVE kept(id, added_at) AS (
          SELECT user_id, min(ts) FROM events WHERE ts IS NOT NULL GROUP BY user_id
          UNION ALL
          SELECT k.id, min(e.ts) FROM kept k
          JOIN events e ON e.user_id = k.id AND e.ts >= k.added_at + INTERVAL 4 DAY
          GROUP BY k.id)
        SELECT id, added_at FROM kept""",
    "observed_feed": f"""WITH {_INC}, {_LOTS}
        SELECT count(*) AS added_count,
          count(*) FILTER (hour(processing_time) >= 12) AS expired_count
        FROM lots GROUP BY lot""",
    "trigger_volumes": f"""WITH {_INC}, {_LOTS}
        SELECT lot AS batch_id, count(*) AS input_rows FROM lots GROUP BY ALL""",
    "stream_dedupe": """
        SELECT DISTINCT user_id AS id FROM events WHERE ts IS NOT NULL
        UNION ALL SELECT user_id FROM events WHERE ts IS NULL""",
    "stream_replay_once": f"""WITH {_timed(_INC)}
        SELECT date_partition, count(*) AS facts, count(*) AS counted FROM inc GROUP BY ALL""",
    "stream_reporters": f"""WITH {_timed(_INC)}
        SELECT date_partition, district, crime_type,
          count(DISTINCT cedula_hash) AS reporters FROM inc GROUP BY ALL""",
    "stream_expired": """
        WITH RECURSIVE kept(id, added) AS (
          SELECT user_id, min(ts) FROM events WHERE ts IS NOT NULL GROUP BY user_id
          UNION ALL
          SELECT k.id, min(e.ts) FROM kept k
          JOIN events e ON e.user_id = k.id AND e.ts >= k.added + INTERVAL 4 DAY
          GROUP BY k.id, k.added)
        SELECT id, added, added + INTERVAL 4 DAY AS expired FROM kept
        WHERE added + INTERVAL 4 DAY <= (SELECT date_trunc('millisecond', max(ts)) FROM events)
          OR EXISTS (SELECT 1 FROM events e WHERE e.user_id = kept.id
            AND e.ts >= kept.added + INTERVAL 4 DAY)""",
    "stream_windowed_alerts": f"""WITH {_timed(_WINDOWS)}
        SELECT window_start, district, crime_type, n AS crime_count,
          last_time AS alert_time, TRUE AS is_critical, 'CRITICAL' AS alert_level,
          'ALERTA: ' || n || ' casos de ' || crime_type || ' en ' || district
            AS alert_message
        FROM days WHERE n >= {_case("crime_type", WINDOW_THRESHOLDS)}
          AND window_start + INTERVAL 6 HOUR <= {_NOW}""",
    # reports
    "report_incidents": f"""WITH {_POINTS}
        SELECT id, lat, lon, type, district, timestamp FROM points
        WHERE added_at > {_NOW} - INTERVAL 2 DAY""",
    "report_alerts": f"""WITH {_LOT_ALERTS}
        SELECT district, crime_type, crime_count, alert_level, alert_message, is_critical,
          {_ALERT_AGE} AS time_ago, {_age_label(_ALERT_AGE)} AS time_ago_label,
          'CRÍTICA' AS severity
        FROM alerts WHERE alert_time > {_NOW} - INTERVAL 7 DAY""",
    "report_density": f"""WITH {_DENSITY}, newest AS (
          SELECT * FROM density WHERE date_partition = (SELECT max(date_partition) FROM inc))
        SELECT district, total_crimes, crime_types_list,
          round(crime_density_score / (SELECT max(crime_density_score) FROM newest) * 100, 4)
            AS density_percent,
          crime_type_variety || '/{EVENT_UNIVERSE}' AS variety_ratio, last_updated
        FROM newest""",
    "rebuild_days": f"""WITH {_DAYS}, recent AS (
          SELECT DISTINCT date_partition FROM inc ORDER BY 1 DESC LIMIT 2)
        SELECT date_partition, district, crime_type,
          CASE WHEN date_partition IN (FROM recent) THEN n ELSE 2 * n END AS crime_count,
          last_time AS last_updated FROM days""",
    "quarantine": f"""WITH {_INC}
        SELECT 'INC-' || incident_id AS crime_id, crime_type, district FROM inc
        WHERE incident_id % 7 = 0""",
    # commits, compaction and versions
    "compacted_facts": f"""WITH {_timed(_INC)}, seen AS (
          SELECT date_partition, district, count(*) AS facts, sum(incident_id)::BIGINT AS ids,
            count(DISTINCT incident_id % 4) AS lots FROM inc GROUP BY ALL),
        whole AS (SELECT date_partition, max(lots) > 1 AS several FROM (
          SELECT date_partition, count(DISTINCT incident_id % 4) AS lots FROM inc GROUP BY ALL)
          GROUP BY ALL)
        SELECT phase, date_partition, district, facts, ids,
          CASE WHEN phase IN ('before', 'interrupted') OR NOT several THEN lots ELSE 1 END
            AS batch_keys
        FROM seen JOIN whole USING (date_partition),
          (VALUES ('before'), ('interrupted'), ('packed'), ('swept')) v(phase)""",
    "manifest_census": f"""WITH {_timed(_INC)}
        SELECT date_partition, district, count(DISTINCT hour(processing_time) >= 12) AS file_count,
          count(*) AS row_count,
          CASE WHEN max(hour(processing_time)) >= 12 THEN 'lot-000000000001'
            ELSE 'lot-000000000000' END AS newest_key,
          min(processing_time) AS least, max(processing_time) AS greatest
        FROM inc GROUP BY ALL""",
    "manifest_latest_files": f"""WITH {_timed(_INC)}, halves AS (
          SELECT *, hour(processing_time) >= 12 AS late,
            bool_or(hour(processing_time) >= 12) OVER (PARTITION BY date_partition, district)
              AS has_late FROM inc)
        SELECT CAST(incident_id AS VARCHAR) AS crime_data, district, date_partition,
          CASE WHEN late THEN 'lot-000000000001' ELSE 'lot-000000000000' END AS batch_key
        FROM halves WHERE late = has_late""",
    "manifest_pruned_scan": f"""WITH {_timed(_INC)}, files AS (
          SELECT date_partition, district, hour(processing_time) // 6 AS lot,
            min(processing_time) AS least, max(processing_time) AS greatest FROM inc GROUP BY ALL)
        SELECT CAST(incident_id AS VARCHAR) AS crime_data, district, processing_time,
          'lot-00000000000' || (hour(processing_time) // 6) AS batch_key,
          (SELECT count(*) FROM files WHERE greatest > {_SIX_HOURS_AGO}) AS files_opened
        FROM inc WHERE processing_time > {_SIX_HOURS_AGO}""",
    "skipped_file_ledger": f"""WITH {_timed(_INC)}, files AS (
          SELECT date_partition, district,
            'lot-00000000000' || (hour(processing_time) // 12) AS batch_key, count(*) AS row_count
          FROM inc WHERE date_partition = (SELECT max(date_partition) FROM inc) GROUP BY ALL),
        hit AS (
          SELECT *, CASE WHEN district = 'Center' THEN 'corrupt' ELSE 'vanished' END AS reason
          FROM files WHERE (district = 'Center' AND batch_key = 'lot-000000000000')
            OR (district = 'North' AND batch_key = 'lot-000000000001'))
        SELECT *, (SELECT count(*) FROM inc) - (SELECT sum(row_count) FROM hit)::BIGINT AS rows_left,
          (SELECT count(*) FROM inc) AS rows_listed FROM hit""",
    "snapshot_versions": f"""WITH {_timed(_DAYS)}, recent AS (
          SELECT DISTINCT date_partition AS d FROM inc ORDER BY 1 DESC LIMIT 2)
        SELECT phase, date_partition, district, crime_type,
          CASE WHEN phase = 'whole' OR (phase = 'two days' AND date_partition IN (FROM recent))
            THEN n ELSE 2 * n END AS crime_count
        FROM days, (VALUES ('doubled'), ('two days'), ('whole')) v(phase)""",
    "category_lookup_collated": f"""
        SELECT event_id AS incident_id, upper(translate(event_type, 'ciehuo', 'çïêĥüö')) AS type,
          {_case("strip_accents(lower(translate(event_type, 'ciehuo', 'çïêĥüö')))", EVENT_COLORS,
                 "'#666666'")} AS color FROM events""",
    "category_counts_collated": """
        WITH spelt AS (
          SELECT event_type, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN upper(event_type)
            WHEN 2 THEN translate(event_type, 'ciehuo', 'çïêĥüö')
            ELSE upper(translate(event_type, 'ciehuo', 'çïêĥüö')) END AS type FROM events)
        SELECT min(type) AS type, count(DISTINCT type) AS spellings, count(*) AS n
        FROM spelt GROUP BY event_type""",
    # orders
    "order_statistics": f"WITH {_ORDERS} SELECT {_STATISTICS} FROM days",
    "order_density": f"""WITH {_ORDERS}
        SELECT date_partition, district, CAST(sum(n) AS BIGINT) AS total_crimes,
          count(crime_type) AS crime_type_variety,
          string_agg(crime_type, ',' ORDER BY crime_type) AS crime_types_list,
          max(last_time) AS last_updated,
          CAST(sum(n) * count(crime_type) AS BIGINT) AS crime_density_score
        FROM days GROUP BY ALL""",
    "order_correlation": f"""WITH {_ORDERS}
        SELECT date_partition, district,
          string_agg(crime_type, ',' ORDER BY crime_type) AS crime_types_in_area,
          CAST(sum(n) AS BIGINT) AS total_crimes_in_area,
          count(DISTINCT crime_type) AS unique_crime_types,
          max(last_time) AS last_updated,
          count(DISTINCT crime_type) / 5.0 AS crime_diversity_index
        FROM days GROUP BY ALL""",
}
