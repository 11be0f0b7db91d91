"""The same questions in SQL for another engine, from the raw events up."""

from __future__ import annotations

from .feeds import (
    AIRCRAFT_SQL,
    ALERT_PARTITIONS,
    CORRECTED_EVERY,
    CUT_OFF_EVERY,
    FIXED_SCORE_SQL,
    LABELLED_SCORE_SQL,
    CUT_POLL_EVERY,
    MARK_SQL,
    POLL_OF,
    POLLED_SQL,
    SOURCE_SQL,
    SPOILT_EVERY,
    STATE_SQL,
    STATIONS,
    UNDATED_EVERY,
)

_ISO = "%Y-%m-%dT%H:%M:%SZ"
_ISO_MILLIS = "%Y-%m-%dT%H:%M:%S.%gZ"
_PLAIN = "%Y-%m-%d %H:%M:%S"

_RAW_COLUMNS = ", ".join(f"{sql} AS {name}" for name, sql in AIRCRAFT_SQL.items())
_STATE_COLUMNS = ", ".join(f"{sql} AS s{i}" for i, sql in STATE_SQL.items())


def _object_fields(source: str = "source") -> str:
    return f"""strftime(ts, '{_ISO}') AS event_time, {source} AS source,
      nullif(lower(trim(hex)), '') AS icao24, nullif(trim(flight), '') AS callsign,
      try_cast(lat AS DOUBLE) AS lat, try_cast(lon AS DOUBLE) AS lon,
      try_cast(alt_baro AS DOUBLE) AS baro_altitude_ft, try_cast(alt_geom AS DOUBLE) AS geo_altitude_ft,
      try_cast(gs AS DOUBLE) AS ground_speed_kt, try_cast(track AS DOUBLE) AS heading_deg,
      try_cast(baro_rate AS DOUBLE) AS vertical_rate_fpm, trim(squawk) AS squawk, category,
      coalesce(lower(alt_baro) = 'ground', false) AS on_ground"""


_STATE_FIELDS = f"""strftime(ts, '{_ISO}') AS event_time, 'opensky' AS source,
  nullif(lower(trim(s0)), '') AS icao24, CASE WHEN s1 <> '' THEN trim(s1) END AS callsign,
  try_cast(s6 AS DOUBLE) AS lat, try_cast(s5 AS DOUBLE) AS lon,
  try_cast(s7 AS DOUBLE) * CAST(3.28084 AS DOUBLE) AS baro_altitude_ft,
  try_cast(s13 AS DOUBLE) * CAST(3.28084 AS DOUBLE) AS geo_altitude_ft,
  try_cast(s9 AS DOUBLE) * CAST(1.94384 AS DOUBLE) AS ground_speed_kt,
  try_cast(s10 AS DOUBLE) AS heading_deg,
  try_cast(s11 AS DOUBLE) * CAST(196.85 AS DOUBLE) AS vertical_rate_fpm,
  trim(s14) AS squawk, CAST(NULL AS VARCHAR) AS category, s8 = 'true' AS on_ground"""

_RULES = """CASE WHEN squawk = '7500' THEN 'SQUAWK_HIJACK' WHEN squawk = '7600' THEN 'SQUAWK_RADIO_FAIL'
      WHEN squawk = '7700' THEN 'SQUAWK_EMERGENCY' WHEN baro_altitude_ft > 60000 THEN 'ALT_OUTLIER'
      WHEN ground_speed_kt > 700 THEN 'SPEED_OUTLIER' WHEN abs(vertical_rate_fpm) > 10000 THEN 'VS_OUTLIER'
      WHEN lat BETWEEN CAST(45.40 AS DOUBLE) AND CAST(45.55 AS DOUBLE)
       AND lon BETWEEN CAST(9.10 AS DOUBLE) AND CAST(9.30 AS DOUBLE) THEN 'GEOFENCE_ENTER' END"""

_HERE = "(lat IS NOT NULL AND lon IS NOT NULL)"

# Named subqueries; each may use those before it.
_STEPS = {
    "raw": f"SELECT event_id, ts, {_RAW_COLUMNS}, {SOURCE_SQL} AS source FROM events",
    "raw_states": f"SELECT event_id, ts, {_STATE_COLUMNS} FROM events",
    "own": f"SELECT event_id, ts, {_RAW_COLUMNS} FROM events",
    "other": "SELECT * REPLACE (replace(hex, 'AB', 'XY') AS hex) FROM own",
    "objects": f"SELECT event_id, ts, {_object_fields()} FROM raw WHERE trim(hex) <> ''",
    "states": f"SELECT event_id, {_STATE_FIELDS} FROM raw_states WHERE trim(s0) <> ''",
    "adsbfi": """SELECT *, 'adsbfi' AS source FROM own WHERE event_id % 4 IN (0, 3)
      UNION ALL SELECT *, 'adsbfi' FROM other WHERE event_id % 4 IN (1, 2)""",
    "airplaneslive": """SELECT *, 'airplaneslive' AS source FROM other WHERE event_id % 4 IN (0, 1, 2)
      UNION ALL SELECT *, 'airplaneslive' FROM own WHERE event_id % 4 = 3""",
    "polled_objects": f"SELECT event_id, {_object_fields()} FROM adsbfi WHERE trim(hex) <> ''",
    "polled_states": "SELECT * FROM states WHERE event_id % 4 <> 2",
    "routed": f"""SELECT * EXCLUDE (ts), 'flight_telemetry' AS event_type,
      strftime(ts, '{_ISO_MILLIS}') AS ingest_ts, replace(event_time, 'Z', '.000Z') AS "@timestamp",
      CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN 'telemetry' END AS stream,
      CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lat || ',' || lon END AS location,
      CASE WHEN lat IS NULL OR lon IS NULL THEN 'missing_position' END AS tags,
      CASE WHEN lat IS NULL OR lon IS NULL THEN 'missing_position' END AS dlq_reason,
      CASE WHEN lat IS NULL OR lon IS NULL THEN 'dlq' ELSE 'telemetry' END AS route
      FROM objects""",
    "telemetry": f"""SELECT *, strptime(event_time, '{_ISO}') AS ts FROM routed WHERE route = 'telemetry'""",
    "judged": f"SELECT *, {_RULES} AS alert_type FROM telemetry",
    "polled_judged": f"SELECT *, {_RULES} AS alert_type FROM polled_objects WHERE lat IS NOT NULL AND lon IS NOT NULL",
    "rule_alerts": f"""SELECT event_id, strftime(ts, '{_PLAIN}') AS "@timestamp", 'flight_alert' AS event_type,
      'spark_rules' AS detector, alert_type, 'Rule alert: ' || alert_type AS reason,
      CAST(CASE WHEN alert_type IN ('SQUAWK_HIJACK', 'SQUAWK_EMERGENCY') THEN 5
        WHEN alert_type = 'GEOFENCE_ENTER' THEN 3 ELSE 4 END AS INTEGER) AS severity,
      icao24, callsign, source, lat, lon, baro_altitude_ft, geo_altitude_ft, ground_speed_kt, heading_deg,
      vertical_rate_fpm, squawk, on_ground, ingest_ts
      FROM judged WHERE alert_type IS NOT NULL""",
    "archive": f"""SELECT strftime(ts, '{_PLAIN}') AS event_ts, strftime(ts, '%Y-%m-%d') AS event_date, source, icao24,
      callsign, lat, lon, baro_altitude_ft, geo_altitude_ft, ground_speed_kt, heading_deg, vertical_rate_fpm, squawk,
      category, on_ground, ingest_ts FROM telemetry""",
    "features": """SELECT *, CAST(hour(ts) AS INTEGER) AS hour FROM telemetry
      WHERE baro_altitude_ft IS NOT NULL AND ground_speed_kt IS NOT NULL AND vertical_rate_fpm IS NOT NULL
        AND heading_deg IS NOT NULL AND source IS NOT NULL""",
    "labelled": """SELECT *, CASE WHEN squawk IN ('7500', '7600', '7700') OR baro_altitude_ft > 60000
      OR ground_speed_kt > 700 OR abs(vertical_rate_fpm) > 10000
      THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label FROM features""",
    "balance": """SELECT count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg,
      count(DISTINCT label) AS n_classes,
      CAST(count(*) FILTER (label = 0) AS DOUBLE) / greatest(count(*) FILTER (label = 1), 1) AS w_pos FROM labelled""",
    "ranked_sources": """SELECT source, CAST(row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS DOUBLE) AS source_idx,
      count(*) AS events FROM features GROUP BY source""",
    "scored": f"SELECT *, {FIXED_SCORE_SQL} AS p_anom FROM features",
    "model_alerts": f"""SELECT event_id, strftime(ts, '{_PLAIN}') AS "@timestamp", 'flight_alert' AS event_type,
      'spark_ml' AS detector, 'FLIGHT_ANOMALY_ML' AS alert_type,
      'ML anomaly p=' || printf('%.3f', p_anom) AS reason,
      CAST(CASE WHEN p_anom >= CAST(0.85 AS DOUBLE) THEN 4 ELSE 3 END AS INTEGER) AS severity,
      icao24, callsign, source, lat, lon, baro_altitude_ft, ground_speed_kt, vertical_rate_fpm, heading_deg, squawk,
      p_anom, ingest_ts FROM scored WHERE p_anom >= CAST(0.6 AS DOUBLE)""",
    "alerts": """SELECT 'flights.alerts' AS topic, 'flights-alerts' AS "index", *, CAST(NULL AS DOUBLE) AS p_anom FROM rule_alerts
      UNION ALL BY NAME
      SELECT 'flights.ml-alerts' AS topic, 'flights-ml-alerts' AS "index", *, CAST(NULL AS DOUBLE) AS geo_altitude_ft,
        CAST(NULL AS BOOLEAN) AS on_ground FROM model_alerts""",
    # Alerts whose text is cut off cannot be read.
    "documents": f"""SELECT topic || '-' || (event_id % {ALERT_PARTITIONS}) || '-' || (event_id // {ALERT_PARTITIONS}) AS doc_id,
      * EXCLUDE (topic, event_id) FROM alerts WHERE event_id % {CUT_OFF_EVERY} <> 0""",
    "versions": f"""SELECT *, event_id % CASE WHEN detector = 'spark_rules' THEN {CORRECTED_EVERY} ELSE {UNDATED_EVERY} END = 0
      AS corrected FROM alerts""",
    "corrected": f"""SELECT topic || '-' || (event_id % {ALERT_PARTITIONS}) || '-' || (event_id // {ALERT_PARTITIONS}) AS doc_id,
      * EXCLUDE (topic, event_id, corrected) REPLACE (CASE WHEN corrected THEN 'corrected' ELSE reason END AS reason,
        CAST(CASE WHEN corrected THEN 1 ELSE severity END AS INTEGER) AS severity)
      FROM versions WHERE event_id % {CUT_OFF_EVERY} <> 0""",
    "ranks": f"""SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE) AS place
      FROM (SELECT label, {LABELLED_SCORE_SQL} AS score FROM labelled)""",
    "marked": f"""SELECT event_id, event_time, strftime(ts, '{_ISO_MILLIS}') AS arrived,
      CASE WHEN {_HERE} AND mark IS NULL THEN 'telemetry' ELSE mark END AS stream,
      CASE WHEN {_HERE} AND mark IS NULL OR NOT {_HERE} AND mark = 'telemetry' THEN 'telemetry'
        WHEN NOT {_HERE} THEN 'dlq' ELSE 'raw' END AS route
      FROM (SELECT *, {MARK_SQL} AS mark FROM objects)""",
    "spoilt": f"""SELECT *, event_id % {SPOILT_EVERY} AS kind FROM routed WHERE route = 'telemetry'""",
    "letters": """SELECT CASE kind WHEN 1 THEN '[]' WHEN 2 THEN '5' WHEN 3 THEN '' ELSE '{"@timestamp":"' || "@timestamp" || '","event_time":"' || event_time || '"' END AS message
      FROM spoilt WHERE kind < 4""",
    "answers": f"""SELECT * FROM own WHERE {POLLED_SQL} AND event_id // {POLL_OF} % {CUT_POLL_EVERY} <> 5""",
    "answered": f"""SELECT CASE WHEN lat IS NULL OR lon IS NULL THEN 'dlq' ELSE 'telemetry' END AS route, *
      FROM (SELECT {_object_fields("'adsbfi'")} FROM answers WHERE trim(hex) <> '')""",
    "polled_routes": """SELECT CASE WHEN lat IS NULL OR lon IS NULL THEN 'dlq' ELSE 'telemetry' END AS route, *
      FROM polled_objects""",
}

_USES = {
    "other": ("own",),
    "objects": ("raw",),
    "states": ("raw_states",),
    "adsbfi": ("own", "other"),
    "airplaneslive": ("own", "other"),
    "polled_objects": ("adsbfi",),
    "polled_states": ("states",),
    "routed": ("objects",),
    "telemetry": ("routed",),
    "judged": ("telemetry",),
    "polled_judged": ("polled_objects",),
    "rule_alerts": ("judged",),
    "archive": ("telemetry",),
    "features": ("telemetry",),
    "labelled": ("features",),
    "balance": ("labelled",),
    "ranked_sources": ("features",),
    "scored": ("features",),
    "model_alerts": ("scored",),
    "alerts": ("rule_alerts", "model_alerts"),
    "documents": ("alerts",),
    "versions": ("alerts",),
    "corrected": ("versions",),
    "ranks": ("labelled",),
    "marked": ("objects",),
    "polled_routes": ("polled_objects",),
    "spoilt": ("routed",),
    "letters": ("spoilt",),
    "answers": ("own",),
    "answered": ("answers",),
}


def _needed(steps: tuple[str, ...]) -> list[str]:
    order: list[str] = []
    for step in steps:
        for name in (*_needed(_USES.get(step, ())), step):
            if name not in order:
                order.append(name)
    return order


def _after(*steps: str, select: str) -> str:
    named = ",\n".join(f"{name} AS ({_STEPS[name]})" for name in _needed(steps))
    return f"WITH {named}\n{select}"


def _source_dispatch() -> str:
    columns = "event_id, source, icao24, callsign, on_ground"
    feeds = {"adsbfi": "adsbfi", "airplaneslive": "airplaneslive", "unheard-of": "adsbfi"}
    polls = [
        f"""SELECT '{configured}' AS configured, {columns}
          FROM (SELECT event_id, {_object_fields(f"'{configured}'")} FROM {feed}) WHERE icao24 IS NOT NULL"""
        for configured, feed in feeds.items()
    ]
    polls.append(f"SELECT 'opensky' AS configured, {columns} FROM polled_states")
    return _after("adsbfi", "airplaneslive", "polled_states", select=" UNION ALL ".join(polls))


_DISC = """2 * 3440.065 * asin(least(1.0, sqrt(pow(sin(radians(lat - 41.9) / 2), 2)
  + cos(radians(41.9)) * cos(radians(lat)) * pow(sin(radians(lon - 12.5) / 2), 2)))) <= 20"""

_POSITIONS = "(SELECT event_id, try_cast(lat AS DOUBLE) AS lat, try_cast(lon AS DOUBLE) AS lon FROM raw)"

_FLAT_ALERTS = "SELECT * EXCLUDE (event_id)"


def all_oracles() -> dict[str, str]:
    archive_day = "SELECT * FROM archive WHERE event_date = '2024-01-15'"
    return {
        "normalize_objects": _after("objects", select="SELECT * EXCLUDE (ts) FROM objects"),
        "normalize_states": _after("states", select="SELECT * FROM states"),
        "snapshot_objects": _after("polled_objects", select="SELECT * FROM polled_objects"),
        "snapshot_states": _after("polled_states", select="SELECT * FROM polled_states"),
        "source_dispatch": _source_dispatch(),
        "ingest_counters": _after(
            "adsbfi", select="SELECT count(*) AS fetched, count(*) FILTER (trim(hex) <> '') AS sent FROM adsbfi"
        ),
        "area_disc": _after("raw", select=f"SELECT event_id FROM {_POSITIONS} WHERE {_DISC}"),
        "area_box": _after(
            "raw",
            select=f"""SELECT event_id FROM {_POSITIONS} WHERE abs(lat - 41.9) <= 3 AND abs(lon - 12.5) <= 4""",
        ),
        "enrich_route": _after("routed", select="SELECT * FROM routed"),
        "route_counts": _after(
            "routed", select="SELECT route, 'flights.' || route AS topic, count(*) AS events FROM routed GROUP BY route"
        ),
        "route_marked": _after(
            "marked",
            select="""SELECT event_id, route, 'flights.' || route AS topic, stream,
              CASE WHEN event_id % 17 = 0 THEN arrived ELSE replace(event_time, 'Z', '.000Z') END AS "@timestamp",
              CAST(0 AS BIGINT) AS transport_fields FROM marked""",
        ),
        "stream_ingest_broken": _after(
            "polled_routes",
            select=f"""SELECT 'flights.' || route AS topic, CASE WHEN route = 'dlq' THEN 'missing_position' END AS dlq_reason,
                count(*) AS records FROM polled_routes WHERE event_id % {CUT_OFF_EVERY} <> 0 GROUP BY route
              UNION ALL SELECT 'flights.dlq', 'unreadable', count(*) FROM events WHERE event_id % {CUT_OFF_EVERY} = 0""",
        ),
        "telemetry_json_roundtrip": _after(
            "telemetry",
            select=f"""SELECT * EXCLUDE (event_id, event_time, location, tags, dlq_reason, route, ts),
              strftime(ts, '{_PLAIN}') AS event_ts FROM telemetry""",
        ),
        "rule_alerts": _after("rule_alerts", select=f"{_FLAT_ALERTS} FROM rule_alerts"),
        "rule_alerts_by_type": _after(
            "rule_alerts",
            select="SELECT alert_type, severity, count(*) AS alerts FROM rule_alerts GROUP BY alert_type, severity",
        ),
        "alert_payload": _after(
            "rule_alerts",
            select="""SELECT CAST(NULL AS VARCHAR) AS key, replace("@timestamp", ' ', 'T') || '.000Z' AS "@timestamp",
              alert_type, icao24, 12 + CAST(callsign IS NOT NULL AS BIGINT) AS fields,
              4 + CAST(baro_altitude_ft IS NOT NULL AS BIGINT) + CAST(ground_speed_kt IS NOT NULL AS BIGINT)
                + CAST(vertical_rate_fpm IS NOT NULL AS BIGINT) + CAST(squawk IS NOT NULL AS BIGINT) AS raw_fields
              FROM rule_alerts""",
        ),
        "archive_roundtrip": _after("archive", select="SELECT * FROM archive"),
        "archive_one_day": _after("archive", select=archive_day),
        "training_features": _after(
            "features",
            select="""SELECT event_id, source, baro_altitude_ft, ground_speed_kt, vertical_rate_fpm, heading_deg, lat, lon,
              hour FROM features""",
        ),
        "weak_labels": _after("labelled", select="SELECT event_id, label FROM labelled"),
        "label_distribution": _after(
            "labelled", select="SELECT label, count(*) AS count FROM labelled GROUP BY label ORDER BY label"
        ),
        "class_balance": _after("balance", select="SELECT * FROM balance"),
        "class_weights": _after(
            "balance",
            select="""SELECT event_id, label, CASE WHEN label = 1 THEN (SELECT w_pos FROM balance)
              ELSE CAST(1 AS DOUBLE) END AS weight FROM labelled""",
        ),
        "source_index": _after("ranked_sources", select="SELECT * FROM ranked_sources"),
        "feature_vectors": _after(
            "ranked_sources",
            select="""SELECT event_id, baro_altitude_ft, ground_speed_kt, vertical_rate_fpm, heading_deg, lat, lon,
              CAST(hour AS DOUBLE) AS hour, source_idx FROM features JOIN ranked_sources USING (source)""",
        ),
        "auc_fixed_scores": _after(
            "ranks",
            select="""SELECT round((sum(place) FILTER (label = 1) - n_pos * (n_pos + 1) / CAST(2 AS DOUBLE))
                / (n_pos * n_neg), 9) AS auc
              FROM ranks, (SELECT CAST(count(*) FILTER (label = 1) AS DOUBLE) AS n_pos,
                CAST(count(*) FILTER (label = 0) AS DOUBLE) AS n_neg FROM ranks) GROUP BY n_pos, n_neg""",
        ),
        "split_sizes": _after(
            "labelled",
            select="""SELECT CASE WHEN CAST('0x' || substr(md5('42|' || coalesce(icao24, '') || '|' || epoch_us(ts) || '|' || source), 1, 8)
                AS BIGINT) / CAST(4294967296 AS DOUBLE) < CAST(0.2 AS DOUBLE) THEN 'test' ELSE 'train' END AS side,
              label, count(*) AS "rows" FROM labelled GROUP BY ALL""",
        ),
        "train_and_score": _after(
            "features", select="SELECT event_id, true AS in_range, true AS agrees, true AS same_after_loading FROM features"
        ),
        "sample_predictions": _after("features", select="SELECT true AS labelled, true AS sums_to_one FROM features LIMIT 20"),
        "stream_scored": "SELECT CAST(0 AS BIGINT) AS only_streamed, CAST(0 AS BIGINT) AS only_batch, CAST(0 AS BIGINT) AS silent",
        "stream_start_position": _after(
            "rule_alerts",
            select="""SELECT * EXCLUDE (event_id), 'earliest' AS began_at FROM rule_alerts
              UNION ALL SELECT * EXCLUDE (event_id), 'latest' FROM rule_alerts WHERE event_id % 2 = 1""",
        ),
        "publish_counts_kept": _after(
            "alerts",
            select=f"""SELECT 'publish' AS counter, CASE WHEN event_id % {CUT_OFF_EVERY} = 0 THEN 'unreadable' ELSE 'indexed' END AS entry,
              count(*) AS total FROM alerts GROUP BY ALL""",
        ),
        "archive_open_and_closed": _after("archive", select="SELECT * FROM archive"),
        "stream_side_by_side": _after(
            "judged",
            select="""SELECT 'rules' AS job, icao24, alert_type, count(*) AS records, true AS scored_agree FROM judged
              WHERE alert_type IS NOT NULL GROUP BY icao24, alert_type
              UNION ALL SELECT 'archive', icao24, NULL, count(*), true FROM telemetry GROUP BY icao24""",
        ),
        "archive_compacted": _after("archive", select="SELECT * FROM archive"),
        "stream_ingest_area": _after(
            "polled_objects",
            select=f"SELECT icao24, callsign, lat || ',' || lon AS location, squawk FROM polled_objects WHERE {_DISC}",
        ),
        "stream_chain_to_index": _after(
            "polled_judged",
            select="""SELECT 'flights-alerts' AS "index", alert_type,
              CAST(CASE WHEN alert_type IN ('SQUAWK_HIJACK', 'SQUAWK_EMERGENCY') THEN 5
                WHEN alert_type = 'GEOFENCE_ENTER' THEN 3 ELSE 4 END AS INTEGER) AS severity,
              icao24, callsign, lat, lon FROM polled_judged WHERE alert_type IS NOT NULL""",
        ),
        "stream_chain_complete": "SELECT CAST(0 AS BIGINT) AS repeated, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS no_model_alert",
        "train_metrics": _after("balance", select="SELECT true AS auc_exact, true AS auc_in_range, * FROM balance"),
        "alerts_from_scores": _after("model_alerts", select=f"{_FLAT_ALERTS} FROM model_alerts"),
        "alert_documents": _after("documents", select="SELECT * FROM documents"),
        "publish_counters": _after(
            "alerts",
            select=f"""SELECT count(*) FILTER (event_id % {CUT_OFF_EVERY} <> 0) AS indexed,
              count(*) FILTER (event_id % {CUT_OFF_EVERY} = 0) AS unreadable FROM alerts""",
        ),
        "publish_replay": _after("documents", select="SELECT * FROM documents"),
        "documents_unmapped": _after(
            "rule_alerts",
            select=f"""SELECT 'flights.alerts-' || (event_id % {ALERT_PARTITIONS}) || '-' || (event_id // {ALERT_PARTITIONS}) AS doc_id,
              event_id % {STATIONS} AS station, CASE WHEN event_id % 2 = 0 THEN 'north' END AS station_name,
              'tag' || (event_id % 3) AS second_tag, CAST(NULL AS INTEGER) AS of_another_kind, squawk
              FROM rule_alerts WHERE event_id % {CUT_OFF_EVERY} <> 0""",
        ),
        "publish_corrected": _after("corrected", select="SELECT * FROM corrected"),
        "stream_ingest": _after(
            "polled_routes",
            select="""SELECT 'flights.' || route AS topic, icao24, callsign,
              CASE WHEN route = 'telemetry' THEN lat || ',' || lon END AS location, squawk,
              CASE WHEN route = 'telemetry' THEN 'telemetry' END AS stream,
              CASE WHEN route = 'dlq' THEN 'missing_position' END AS dlq_reason FROM polled_routes""",
        ),
        "stream_ingest_polls": _after(
            "answered",
            select=f"""SELECT 'flights.' || route AS topic, icao24, callsign,
                CASE WHEN route = 'telemetry' THEN lat || ',' || lon END AS location, squawk,
                CASE WHEN route = 'dlq' THEN 'missing_position' END AS dlq_reason, CAST(NULL AS BOOLEAN) AS kept_whole FROM answered
              UNION ALL SELECT 'flights.dlq', NULL, NULL, NULL, NULL, 'unreadable', true
              FROM (SELECT DISTINCT event_id // {POLL_OF} AS poll FROM events) WHERE poll % {CUT_POLL_EVERY} = 5""",
        ),
        "stream_rules_broken": _after(
            "judged",
            "letters",
            select=f"""SELECT 'flights.alerts' AS topic, alert_type, 'spark_rules' AS detector, CAST(NULL AS VARCHAR) AS message,
                CAST(NULL AS VARCHAR) AS dlq_reason, count(*) AS records FROM judged
              WHERE alert_type IS NOT NULL AND event_id % {SPOILT_EVERY} > 4 GROUP BY alert_type
              UNION ALL SELECT 'flights.dlq', NULL, 'spark_rules', substr(message, 1, 12), 'unreadable', count(*) FROM letters GROUP BY substr(message, 1, 12)""",
        ),
        "stream_model_broken": _after(
            "letters",
            select="SELECT substr(message, 1, 60) AS message, 'unreadable' AS dlq_reason, 'spark_ml' AS detector, true AS alerts_agree FROM letters",
        ),
        "stream_route_index": _after(
            "polled_routes",
            select="""SELECT 'flights-' || route AS "index", count(*) AS events FROM polled_routes GROUP BY route""",
        ),
        "stream_rule_alerts": _after("rule_alerts", select=f"{_FLAT_ALERTS} FROM rule_alerts"),
        "stream_archive": _after("archive", select="SELECT * FROM archive"),
        "stream_publish": _after("documents", select="SELECT * FROM documents"),
    }
