"""SQL for DuckDB, one statement per registered query, over the same tables.

Written as plain definitions (self joins, recursion), not as translations of the
Spark plans, so that the two check each other.
"""

from __future__ import annotations

from wayfold.plans import fixtures as X

_GPS = f"""
gps0 AS (
  SELECT event_id, user_id, event_type, (epoch_us(ts) - {X.BASE_S}000000) // {X.SPEED_UP}000000 AS dt FROM events
),
gps AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'bus_' || user_id END AS vehicle,
    CASE WHEN event_id % 53 = 0 THEN NULL
         WHEN user_id % 4 = 0 THEN (event_id % 25)::DOUBLE / 10
         WHEN user_id % 4 = 1 OR (user_id % 4 = 3 AND dt >= 330) THEN (30 + event_id % 80)::DOUBLE / 10
         ELSE (200 + event_id % 300)::DOUBLE / 10 END AS speed,
    CASE WHEN event_id % 454 = 227 THEN {X.FAR_FUTURE} ELSE {X.BASE_S} + dt END AS datetime,
    CASE WHEN event_id % 211 = 0 THEN {X.FAR_OFF!r}::DOUBLE WHEN event_id % 223 = 0 THEN 'Infinity'::DOUBLE
         WHEN event_id % 101 = 0 THEN NULL ELSE
      (106600000 + (user_id % 5) * 2000 + event_id % 60 + CASE user_id % 4
         WHEN 0 THEN 0 WHEN 1 THEN dt * 10 WHEN 2 THEN dt * 80
         ELSE least(dt, 330) * 80 + greatest(dt - 330, 0) * 10 END)::DOUBLE / 1000000 END AS x,
    (10760000 + (user_id % 7) * 2000 + (event_id * 7) % 60)::DOUBLE / 1000000 AS y,
    CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN FALSE WHEN event_id % 13 = 0 THEN NULL ELSE TRUE END AS ignition,
    CASE WHEN event_id % 29 = 0 THEN FALSE WHEN event_id % 11 = 0 THEN NULL ELSE TRUE END AS working,
    CASE WHEN event_type = 'signup' AND event_id % 4 = 0 THEN TRUE WHEN event_id % 17 = 0 THEN NULL ELSE FALSE END AS door_up,
    event_id % 37 = 0 AS door_down
  FROM gps0
)"""

# Epoch milliseconds where the year 10000 begins.
_YEAR_10000 = 253402300800000

_CLEAN_ALL = (
    _GPS
    + f""",
clean_all AS (
  SELECT event_id, vehicle, coalesce(speed, 0.0) AS speed, datetime, x, y,
    (floor(x / 0.001) * 1000 + floor(y / 0.001))::BIGINT AS grid_id
  FROM gps
  WHERE vehicle IS NOT NULL AND abs(x) <= 180 AND abs(y) <= 90 AND datetime < {_YEAR_10000}
    AND working IS NOT FALSE AND ignition IS NOT FALSE
    AND door_up IS NOT TRUE AND door_down IS NOT TRUE
)"""
)

_CLEAN = (
    _CLEAN_ALL
    + """,
clean AS (
  SELECT * FROM clean_all
  QUALIFY row_number() OVER (PARTITION BY vehicle, datetime ORDER BY event_id) = 1
)"""
)

_SPAN = f"span AS (SELECT min(datetime) AS min_t, max(datetime) AS max_t FROM gps WHERE datetime < {_YEAR_10000})"


def _labels(step: str, extra_cte: str = "") -> str:
    """Labelled points. `step` gives the step number of a clean row."""
    head = f"{extra_cte}, " if extra_cte else ""
    return (
        _CLEAN
        + f""",
{head}numbered AS (
  SELECT *, {step} AS step, row_number() OVER (PARTITION BY vehicle ORDER BY datetime) AS rn FROM clean
),
steps AS (
  SELECT vehicle, step, min(rn) AS first_rn, max(rn) AS last_rn FROM numbered GROUP BY vehicle, step
),
sized AS (
  SELECT *, last_rn - greatest(first_rn - 30, 1) + 1 AS buffer_size FROM steps
),
member AS (
  SELECT s.vehicle, s.step, n.rn, n.x, n.y, n.speed, n.rn >= s.first_rn AS is_new,
    (n.datetime - min(n.datetime) OVER (PARTITION BY s.vehicle, s.step))::DOUBLE / 300 * 0.001 AS ts
  FROM sized s JOIN numbered n
    ON n.vehicle = s.vehicle AND n.rn BETWEEN s.first_rn - 30 AND s.last_rn
  WHERE s.buffer_size >= 30
),
near AS (
  SELECT a.vehicle, a.step, a.rn AS i, b.rn AS j
  FROM member a JOIN member b ON a.vehicle = b.vehicle AND a.step = b.step
  WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.ts - b.ts) * (a.ts - b.ts)) <= 0.001
),
core AS (
  SELECT vehicle, step, i FROM near GROUP BY vehicle, step, i HAVING count(*) >= 5
),
link AS (
  SELECT n.vehicle, n.step, n.i, n.j
  FROM near n SEMI JOIN core c ON n.vehicle = c.vehicle AND n.step = c.step AND n.i = c.i
  WHERE n.i <> n.j AND (n.vehicle, n.step, n.j) IN (SELECT (vehicle, step, i) FROM core)
),
reached AS (
  SELECT vehicle, step, i, i AS root FROM core
  UNION
  SELECT l.vehicle, l.step, l.j, r.root
  FROM reached r JOIN link l ON l.vehicle = r.vehicle AND l.step = r.step AND l.i = r.i
  WHERE r.root < l.j
),
rooted AS (
  SELECT vehicle, step, i, min(root) AS root FROM reached GROUP BY vehicle, step, i
),
assigned AS (
  SELECT n.vehicle, n.step, n.i, min(r.root) AS root
  FROM near n JOIN rooted r ON r.vehicle = n.vehicle AND r.step = n.step AND r.i = n.j
  GROUP BY n.vehicle, n.step, n.i
),
clusters AS (
  SELECT a.vehicle, a.step, a.root,
    (row_number() OVER (PARTITION BY a.vehicle, a.step ORDER BY a.root) - 1)::INTEGER AS cluster_id,
    count(*)::INTEGER AS cluster_points,
    count(*) FILTER (WHERE m.is_new)::INTEGER AS cluster_new,
    max(m.speed) AS cluster_max_speed,
    max(m.x) - min(m.x) AS dx, max(m.y) - min(m.y) AS dy
  FROM assigned a JOIN member m ON m.vehicle = a.vehicle AND m.step = a.step AND m.rn = a.i
  GROUP BY a.vehicle, a.step, a.root
),
described AS (
  SELECT *, sqrt((dx * 111320.0::DOUBLE * 0.982287::DOUBLE) * (dx * 111320.0::DOUBLE * 0.982287::DOUBLE)
    + (dy * 111320.0::DOUBLE) * (dy * 111320.0::DOUBLE)) AS cluster_diagonal_m
  FROM clusters
),
scored AS (
  SELECT n.*, s.buffer_size::INTEGER AS buffer_size, coalesce(c.cluster_id, -1) AS cluster_id,
    c.cluster_points, c.cluster_new, c.cluster_max_speed, c.cluster_diagonal_m,
    round_even(40.0::DOUBLE / greatest(n.speed, 1.0::DOUBLE) * 1000, 0) / 1000 AS tti
  FROM numbered n
  JOIN sized s ON s.vehicle = n.vehicle AND s.step = n.step
  LEFT JOIN assigned a ON a.vehicle = n.vehicle AND a.step = n.step AND a.i = n.rn
  LEFT JOIN described c ON c.vehicle = a.vehicle AND c.step = a.step AND c.root = a.root
),
labelled AS (
  SELECT vehicle, x, y, speed, datetime AS event_ts, grid_id, cluster_id,
    CASE WHEN cluster_id >= 0 AND cluster_max_speed < 3 AND cluster_diagonal_m < 15 THEN 'Dwelling'
         WHEN cluster_id >= 0 THEN 'Congested'
         WHEN buffer_size < 30 THEN 'Warming Up' ELSE 'Smooth' END AS congestion_status,
    tti,
    CASE WHEN cluster_id >= 0 THEN round_even(
      least(greatest(cluster_new::DOUBLE / 5, 1), 5) * least(greatest(tti / 2, 0), 5) * 100, 0) / 100
      ELSE 0.0::DOUBLE END AS severity,
    buffer_size, step
  FROM scored
)"""
    )


_BY_POINT = _labels("datetime")
_START = "min_t"
_BY_SLICE = _labels(f"((datetime - (SELECT {_START} FROM span)) // 10)", _SPAN)

_LABELLED = (
    "vehicle, x, y, speed, event_ts, grid_id, cluster_id, congestion_status, tti, severity, buffer_size"
)


def _cells(*by: str) -> str:
    keys = ", ".join(("grid_id", *by))
    return f"""
  SELECT {keys},
    count(*) FILTER (WHERE congestion_status = 'Congested') AS congested_count,
    sum(round(x * 10000000)) / count(*) / 10000000 AS cx,
    sum(round(y * 10000000)) / count(*) / 10000000 AS cy,
    sum(round(speed * 1000000)) FILTER (WHERE congestion_status = 'Congested')
      / count(*) FILTER (WHERE congestion_status = 'Congested') / 1000000 AS avg_speed,
    sum(round(tti * 1000)) FILTER (WHERE congestion_status = 'Congested')
      / count(*) FILTER (WHERE congestion_status = 'Congested') / 1000 AS avg_tti,
    max(severity) FILTER (WHERE congestion_status = 'Congested') AS severity,
    count(*) AS point_count,
    count(DISTINCT vehicle) AS vehicles
  FROM labelled GROUP BY {keys}"""


_CELL_VALUES = "congested_count, cx, cy, avg_speed, avg_tti, severity, point_count, vehicles"

_BATCHES = (
    _BY_SLICE
    + f""",
batches AS (
  SELECT c.*, c.step AS batch_id, {_START} + c.step * 10 AS updated_at
  FROM ({_cells("step")}) c, span
)"""
)


def _iso(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds}) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00'"


_ROUTES = """
route_lines AS (
  SELECT n_nationkey::BIGINT AS ordinal, 'bus_' || n_nationkey AS vehicle, 'R' || n_regionkey AS route_id,
    CASE WHEN n_nationkey % 6 = 0 THEN '  ' ELSE ' ' || (n_nationkey + 1) || ' ' END AS route_no
  FROM nation
  UNION ALL
  SELECT n_nationkey + 1000, 'bus_' || n_nationkey, 'R' || n_regionkey, 'X' FROM nation WHERE n_nationkey % 8 = 0
),
routes AS (
  SELECT trim(vehicle) AS vehicle, nullif(trim(route_id), '') AS route_id, nullif(trim(route_no), '') AS route_no
  FROM route_lines WHERE trim(vehicle) <> ''
  QUALIFY row_number() OVER (PARTITION BY trim(vehicle) ORDER BY ordinal DESC) = 1
)"""

_POSITIONS = (
    _GPS
    + ","
    + _ROUTES
    + f""",
positions AS (
  SELECT event_id, g.vehicle AS bus_id, y AS lat, x AS lng, coalesce(speed, 0.0) AS speed,
    {_iso(f"CASE WHEN datetime > 0 AND datetime < {_YEAR_10000} THEN datetime ELSE {X.FALLBACK_S} END")} AS "timestamp", route_id, route_no
  FROM gps g LEFT JOIN routes r ON r.vehicle = g.vehicle
  WHERE g.vehicle IS NOT NULL AND abs(y) <= 90 AND abs(x) <= 180
)"""
)

_STREAM_BATCH = f"(event_id * {X.STREAM_BATCHES} // (1 + (SELECT max(event_id) FROM events)))"
_BY_BATCH = _labels(_STREAM_BATCH)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["gps_fixture"] = f"WITH {_GPS} SELECT * FROM gps"

    q["clean_waypoints"] = f"WITH {_CLEAN} SELECT event_id, vehicle, x, y, speed, datetime, grid_id FROM clean"

    q["frame_dedup_last"] = f"""WITH {_CLEAN_ALL}
SELECT event_id, vehicle, x, y, speed, datetime, grid_id FROM clean_all
QUALIFY row_number() OVER (PARTITION BY vehicle, datetime ORDER BY event_id DESC) = 1"""

    q["skip_reasons"] = f"""WITH {_GPS}
SELECT vehicle IS NOT NULL AND coalesce(abs(x) <= 180 AND abs(y) <= 90, FALSE) AS tracked,
  CASE WHEN vehicle IS NULL THEN 'no vehicle' WHEN x IS NULL OR y IS NULL THEN 'no position'
       WHEN abs(x) > 180 OR abs(y) > 90 THEN 'bad position' WHEN datetime >= {_YEAR_10000} THEN 'bad time'
       WHEN datetime IS NULL THEN 'no time' WHEN working = FALSE OR ignition = FALSE THEN 'out of service'
       WHEN door_up = TRUE OR door_down = TRUE THEN 'door open' ELSE 'kept' END AS reason,
  count(*) AS n
FROM gps GROUP BY ALL"""

    q["json_roundtrip"] = f"""WITH {_GPS}
SELECT event_id, vehicle, speed, datetime, x, y, ignition, working, door_up, door_down FROM gps WHERE event_id % 41 <> 0
UNION ALL
SELECT event_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM gps WHERE event_id % 41 = 0"""

    q["wrapped_records"] = f"""WITH {_GPS}
SELECT * FROM gps WHERE event_id % 43 <> 0 AND event_id % 47 <> 0 AND vehicle IS NOT NULL"""

    q["epoch_units"] = f"""WITH {_GPS},
mixed AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN datetime * 1000 ELSE datetime END AS datetime_raw FROM gps)
SELECT event_id, datetime_raw, s AS datetime,
  CASE WHEN s < {_YEAR_10000} // 1000 THEN {_iso(f"CASE WHEN s < {_YEAR_10000} // 1000 THEN s END")} END AS event_time
FROM (SELECT *, CASE WHEN datetime_raw > 20000000000 THEN datetime_raw // 1000 ELSE datetime_raw END AS s FROM mixed)"""

    q["cell_activity"] = f"""WITH {_CLEAN}
SELECT grid_id, count(*) AS point_count, count(DISTINCT vehicle) AS vehicles,
  sum(round(speed * 1000000)) / count(*) / 1000000 AS avg_speed, max(speed) AS max_speed
FROM clean GROUP BY grid_id"""

    q["route_dimension"] = f"WITH {_ROUTES} SELECT * FROM routes"

    q["vehicle_positions"] = f"WITH {_POSITIONS} SELECT * FROM positions"

    q["latest_positions"] = f"""WITH {_POSITIONS}
SELECT bus_id, lat, lng, speed, "timestamp", route_id, route_no FROM positions
QUALIFY row_number() OVER (PARTITION BY bus_id ORDER BY event_id DESC) = 1"""

    q["position_feed"] = f"""WITH {_POSITIONS}
SELECT event_id, bus_id AS key, lat, lng, speed, "timestamp", route_id, route_no, TRUE AS has_all_keys FROM positions"""

    q["stop_dwell_filtered"] = f"""WITH {_CLEAN},
stops AS (
  SELECT DISTINCT (106600000 + (s_suppkey % 5) * 2000 + 30)::DOUBLE / 1000000 AS stop_x,
    (10760000 + (s_suppkey % 7) * 2000 + 30)::DOUBLE / 1000000 AS stop_y
  FROM supplier
)
SELECT event_id, vehicle, x, y, speed, datetime, grid_id FROM clean c
WHERE NOT (speed < 5 AND EXISTS (
  SELECT 1 FROM stops WHERE sqrt(pow((y - stop_y) * 111320.0, 2) + pow((x - stop_x) * 111320.0 * cos(radians(10.8)), 2)) < 30))"""

    q["replay_windows"] = f"""WITH {_GPS}, {_SPAN},
kept AS (
  SELECT datetime, greatest(min_t, max_t - {X.REPLAY_HEAD_S}) AS start_t FROM gps, span
  WHERE datetime >= greatest(min_t, max_t - {X.REPLAY_HEAD_S}) AND datetime < {_YEAR_10000}
)
SELECT (datetime - start_t) // 10 AS window_id, start_t + (datetime - start_t) // 10 * 10 AS window_start,
  count(*) AS n, min(datetime) AS first_t, max(datetime) AS last_t
FROM kept GROUP BY ALL"""

    q["rolling_frames"] = f"""WITH {_CLEAN}
SELECT vehicle, datetime, min(datetime) OVER f AS frame_start, max(speed) OVER f AS frame_max_speed,
  (count(*) OVER f)::INTEGER AS buffer_size, count(*) OVER f < 30 AS warming_up
FROM clean WINDOW f AS (PARTITION BY vehicle ORDER BY datetime ROWS BETWEEN 30 PRECEDING AND CURRENT ROW)"""

    q["newest_points"] = f"""WITH {_CLEAN}
SELECT vehicle, datetime, x, y, speed, row_number() OVER (PARTITION BY vehicle ORDER BY datetime DESC)::INTEGER AS from_end
FROM clean QUALIFY from_end <= 30"""

    q["clustered_flag"] = f"""WITH {_CLEAN},
numbered AS (SELECT *, row_number() OVER (PARTITION BY vehicle ORDER BY datetime) AS rn FROM clean),
member AS (
  SELECT e.vehicle, e.rn AS frame, n.rn, n.x, n.y,
    (n.datetime - min(n.datetime) OVER (PARTITION BY e.vehicle, e.rn))::DOUBLE / 300 * 0.001 AS ts
  FROM numbered e JOIN numbered n ON n.vehicle = e.vehicle AND n.rn BETWEEN e.rn - 30 AND e.rn
  WHERE e.rn >= 30
),
near AS (
  SELECT a.vehicle, a.frame, a.rn AS i, b.rn AS j FROM member a JOIN member b USING (vehicle, frame)
  WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.ts - b.ts) * (a.ts - b.ts)) <= 0.001
),
core AS (SELECT vehicle, frame, i AS j FROM near GROUP BY ALL HAVING count(*) >= 5),
hit AS (SELECT DISTINCT vehicle, frame FROM near SEMI JOIN core USING (vehicle, frame, j) WHERE i = frame)
SELECT n.vehicle, n.datetime AS event_ts, h.frame IS NOT NULL AS clustered
FROM numbered n LEFT JOIN hit h ON h.vehicle = n.vehicle AND h.frame = n.rn"""

    q["labelled_points"] = f"WITH RECURSIVE {_BY_POINT} SELECT {_LABELLED} FROM labelled"

    q["labelled_points_10s"] = (
        f"WITH RECURSIVE {_BY_SLICE} SELECT {_LABELLED}, step AS window_id FROM labelled"
    )

    q["cluster_stats"] = f"""WITH RECURSIVE {_BY_SLICE}
SELECT vehicle, step AS window_id, cluster_id, cluster_points, cluster_new, cluster_max_speed, cluster_diagonal_m,
  least(greatest(cluster_new::DOUBLE / 5, 1), 5) AS density
FROM described WHERE cluster_new > 0"""

    q["cell_congestion"] = f"WITH RECURSIVE {_BY_POINT} {_cells()}"

    q["hot_cells"] = f"""WITH RECURSIVE {_BY_POINT}
SELECT row_number() OVER (ORDER BY severity DESC, grid_id::VARCHAR DESC)::INTEGER AS rank, grid_id,
  grid_id::VARCHAR AS cell_key,
  CASE WHEN severity >= 5 THEN 'heavy' WHEN severity >= 2 THEN 'moderate' ELSE 'mild' END AS band, {_CELL_VALUES}
FROM ({_cells()}) WHERE congested_count > 0 AND isfinite(cx) AND isfinite(cy)
ORDER BY severity DESC, grid_id::VARCHAR DESC LIMIT 200"""

    q["archive_by_status"] = f"""WITH RECURSIVE {_BY_POINT}
SELECT congestion_status, count(*) AS n, count(DISTINCT vehicle) AS vehicles, max(severity) AS max_severity
FROM labelled WHERE congestion_status <> 'Dwelling' GROUP BY congestion_status"""

    q["array_archive"] = f"SELECT * EXCLUDE (event_id) FROM ({q['wrapped_records']})"

    q["stream_skip_reasons"] = q["skip_reasons"]

    q["archive_compacted"] = f"""WITH RECURSIVE {_BY_POINT}
SELECT least(greatest((event_ts - {X.BASE_S}) // {X.ARCHIVE_STEP_S}, 0), 2)::BIGINT AS batch_id, congestion_status,
  count(*) AS n, count(DISTINCT vehicle) AS vehicles, max(severity) AS max_severity
FROM labelled WHERE congestion_status <> 'Dwelling' GROUP BY ALL"""

    q["cell_batches"] = f"WITH RECURSIVE {_BATCHES} SELECT grid_id, batch_id, updated_at, {_CELL_VALUES} FROM batches"

    def latest(as_of: int) -> str:
        return f"""
newest AS (SELECT * FROM batches QUALIFY row_number() OVER (PARTITION BY grid_id ORDER BY batch_id DESC) = 1),
indexed AS (
  SELECT *, row_number() OVER (ORDER BY severity DESC, grid_id::VARCHAR DESC)::INTEGER AS rank
  FROM newest WHERE congested_count > 0 AND updated_at > {as_of - X.LIVE_TTL_S}
)"""
    live_columns = f"""rank, grid_id::VARCHAR AS grid_id, 'Congested' AS status,
  round_even(avg_speed * 100, 0) / 100 AS avg_speed, round_even(avg_tti * 100, 0) / 100 AS avg_tti,
  round_even(severity * 100, 0) / 100 AS severity,
  round_even(cy * 1000000, 0) / 1000000 AS centroid_lat, round_even(cx * 1000000, 0) / 1000000 AS centroid_lon,
  point_count, vehicles,
  {_iso("updated_at")} AS updated_at, batch_id::VARCHAR AS batch_id"""
    q["live_cells"] = f"""WITH RECURSIVE {_BATCHES}, {latest(X.AS_OF)}
SELECT {live_columns} FROM indexed WHERE rank <= {X.LIVE_TOP}"""

    feed_columns = f"""b.batch_id, b.grid_id::VARCHAR AS grid_id,
  CASE WHEN congested_count = 0 THEN 'delete' ELSE 'upsert' END AS op,
  CASE WHEN congested_count > 0 THEN 'Congested' END AS status,
  CASE WHEN congested_count > 0 THEN round_even(avg_speed * 100, 0) / 100 END AS avg_speed,
  CASE WHEN congested_count > 0 THEN round_even(avg_tti * 100, 0) / 100 END AS avg_tti,
  CASE WHEN congested_count > 0 THEN round_even(severity * 100, 0) / 100 END AS severity,
  CASE WHEN congested_count > 0 THEN point_count END AS point_count,
  CASE WHEN congested_count > 0 THEN vehicles END AS vehicles,
  CASE WHEN congested_count > 0 THEN cx END AS centroid_lon,
  CASE WHEN congested_count > 0 THEN cy END AS centroid_lat,
  {_iso("updated_at")} AS updated_at"""
    q["cell_feed"] = f"""WITH RECURSIVE {_BATCHES},
prior AS (
  SELECT a.grid_id, a.batch_id, max(z.batch_id) AS prior_id
  FROM batches a JOIN batches z ON z.grid_id = a.grid_id AND z.batch_id < a.batch_id GROUP BY ALL
),
was_live AS (
  SELECT p.grid_id, p.batch_id FROM prior p
  JOIN batches z ON z.grid_id = p.grid_id AND z.batch_id = p.prior_id
  JOIN batches a ON a.grid_id = p.grid_id AND a.batch_id = p.batch_id
  WHERE z.congested_count > 0 AND z.updated_at + {X.LIVE_TTL_S} > a.updated_at
)
SELECT {feed_columns} FROM batches b
WHERE congested_count > 0 OR (b.grid_id, b.batch_id) IN (SELECT (grid_id, batch_id) FROM was_live)"""

    q["congestion_episodes"] = f"""WITH RECURSIVE {_BATCHES},
marked AS (
  SELECT grid_id, updated_at,
    CASE WHEN updated_at - lag(updated_at) OVER (PARTITION BY grid_id ORDER BY updated_at) <= 30 THEN 0 ELSE 1 END AS starts
  FROM batches WHERE congested_count > 0
),
runs AS (SELECT *, sum(starts) OVER (PARTITION BY grid_id ORDER BY updated_at) AS run FROM marked)
SELECT grid_id, min(updated_at) AS started_at, max(updated_at) AS last_update, max(updated_at) + 30 AS ends_at,
  count(*) AS updates
FROM runs GROUP BY grid_id, run"""

    q["stream_dedup"] = f"WITH {_CLEAN} SELECT vehicle, datetime FROM clean"

    q["stream_labels"] = f"WITH RECURSIVE {_BY_BATCH} SELECT {_LABELLED} FROM labelled"

    # Points arrive in the order of time, so micro-batches leave no trace.
    q["stream_point_labels"] = q["labelled_points"]

    q["stream_live_cells"] = f"""WITH RECURSIVE {_BY_BATCH},
batches AS (
  SELECT *, step AS batch_id, {X.BASE_S} + step * {X.STREAM_STEP_S} AS updated_at FROM ({_cells("step")})
), {latest(X.BASE_S + X.STREAM_BATCHES * X.STREAM_STEP_S)}
SELECT {live_columns} FROM indexed WHERE rank <= {X.LIVE_TOP}"""

    q["stream_cell_feed"] = q["cell_feed"] + f"""
UNION ALL
SELECT batch_id, grid_id::VARCHAR, 'delete', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, {_iso(f"updated_at + {X.LIVE_TTL_S}")}
FROM (
  SELECT *, lead(updated_at) OVER (PARTITION BY grid_id ORDER BY batch_id) AS next_at FROM batches
)
WHERE congested_count > 0 AND (next_at IS NULL OR next_at >= updated_at + {X.LIVE_TTL_S})"""
    q["stream_episodes"] = q["congestion_episodes"]

    q["routes_from_csv"] = q["route_dimension"]
    q["stream_positions"] = q["latest_positions"]
    q["keyed_positions"] = q["latest_positions"]

    return q
