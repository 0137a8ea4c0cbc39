"""SQL building blocks of the oracle: the derived incident tables and common expressions."""

from __future__ import annotations

INCIDENTS = """
polls AS (
  SELECT 2 * event_id AS row_id, event_id, ts, user_id, event_type FROM events
  UNION ALL
  SELECT 2 * event_id + 1 AS row_id, event_id,
         CASE WHEN event_id % 10 = 3 THEN ts + INTERVAL 7 SECOND ELSE ts END AS ts,
         user_id, event_type
  FROM events WHERE event_id % 10 IN (3, 4)),
incidents AS (
  SELECT p.row_id, p.event_id,
    CASE WHEN p.event_id % 97 = 0 THEN NULL
         WHEN p.event_type = 'error' THEN concat('HAZARD_', CAST(p.event_id % 3 AS VARCHAR))
         WHEN p.event_type = 'click' THEN 'JAM' WHEN p.event_type = 'view' THEN 'POLICE'
         WHEN p.event_type = 'purchase' THEN 'ACCIDENT' ELSE 'ROAD_CLOSED' END AS tipo,
    CASE WHEN p.event_id % 5 = 0 THEN NULL
         ELSE concat('SUB_', CAST(p.event_id % 4 AS VARCHAR)) END AS subtipo,
    CASE WHEN p.event_id % 11 = 0 THEN NULL
         ELSE concat('Street ', CAST(p.user_id % 7 AS VARCHAR)) END AS ubicacion,
    CASE WHEN p.user_id % 6 = 0 THEN NULL ELSE lower(n.n_name) END AS ciudad,
    CASE WHEN p.event_id % 53 = 0 THEN 'hora'
         ELSE strftime(p.ts, '%Y-%m-%dT%H:%M:%S.%f') END AS hora,
    CASE WHEN p.event_id % 41 = 0 THEN NULL WHEN p.event_id % 29 = 0 THEN CAST(95 AS DOUBLE)
         ELSE CAST(-33.66 AS DOUBLE) + CAST(p.event_id % 48 AS DOUBLE) / 100 END AS lat,
    CAST(-70.89 AS DOUBLE) + CAST(p.user_id % 44 AS DOUBLE) / 100 AS lon,
    -- Whole milliseconds; epoch_ms would round.
    CASE WHEN p.event_id % 53 <> 0 THEN epoch_us(p.ts) // 1000 END AS pub_millis
  FROM polls p JOIN customer c ON p.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey),
raw AS (SELECT row_id, tipo, subtipo, ubicacion, ciudad, hora, lat, lon FROM incidents),
filtered AS (
  SELECT row_id, CASE WHEN regexp_full_match(tipo, 'HAZARD.*') THEN 'HAZARD' ELSE tipo END AS tipo,
         subtipo, ubicacion, upper(ciudad) AS ciudad, hora, lat, lon
  FROM raw
  WHERE tipo IS NOT NULL AND hora IS NOT NULL
    AND regexp_full_match(hora, '\\d{4}-\\d{2}-\\d{2}.*')
    AND lat IS NOT NULL AND lon IS NOT NULL),
uniq AS (
  SELECT row_id, tipo, subtipo, ubicacion, ciudad, hora, lat, lon FROM (
    SELECT *, row_number() OVER (
      PARTITION BY tipo, ciudad,
        nullif(regexp_extract(hora, '(\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}).*', 1), ''), ubicacion
      ORDER BY hora, row_id) AS rn FROM filtered) q WHERE rn = 1),
docs AS (
  SELECT tipo, subtipo, ubicacion AS calle, ciudad AS comuna, TRY_CAST(hora AS TIMESTAMP) AS fecha,
         lat AS latitud, lon AS longitud,
         CASE WHEN lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180
              THEN concat(CAST(lat AS VARCHAR), ',', CAST(lon AS VARCHAR)) END AS location,
         coalesce(TRY_CAST(hora AS TIMESTAMP), TIMESTAMP '2024-01-31 00:00:00') AS stamp
  FROM uniq)
"""

TRACE = """
draws AS (
  SELECT event_id AS seq, ts,
         CAST((event_id * 7919 + 104729) % 100003 AS DOUBLE) / 100003.0 AS u FROM events),
population AS (SELECT count(*) AS n FROM raw),
ranked AS (SELECT row_number() OVER (ORDER BY row_id) - 1 AS rank, * FROM raw),
trace_uniform AS (
  SELECT seq, ts, u, CAST(floor(u * n) AS BIGINT) AS rank FROM draws, population),
trace_exponential AS (
  SELECT seq, ts, u,
         CAST(floor(-(n / 5.0) * ln(1.0 - u * (1.0 - exp(-5.0)))) AS BIGINT) AS rank
  FROM draws, population)
"""


def derived(body: str) -> str:
    """A statement over the derived tables raw, filtered, uniq and docs."""
    return f"WITH {INCIDENTS} {body}"


def traced(body: str) -> str:
    """A statement that also sees the access traces."""
    return f"WITH {INCIDENTS}, {TRACE} {body}"


def iso_millis(ms: str) -> str:
    """ISO text of epoch milliseconds, the fraction only when not zero."""
    stamp = f"epoch_ms(coalesce({ms}, 0))"
    return (f"CASE WHEN coalesce({ms}, 0) % 1000 = 0 THEN strftime({stamp}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({stamp}, '%Y-%m-%dT%H:%M:%S.%f') END")


def place(prefix: str = "") -> str:
    return f"round({prefix}lat, 4) AS lat, round({prefix}lon, 4) AS lon"


FEED_EVENTS = (f"tipo, subtipo, ubicacion, ciudad, {iso_millis('pub_millis')} AS hora, {place()}")

EVENTS = f"tipo, subtipo, ubicacion, ciudad, hora, {place()}"

NATURAL_KEY = ("concat(coalesce(tipo, 'None'), '_', coalesce(CAST(lat AS VARCHAR), 'None'), '_', "
               "coalesce(CAST(lon AS VARCHAR), 'None'), '_', coalesce(subtipo, 'None'))")


def content_hash(columns: tuple[str, ...]) -> str:
    texts = (f"CAST({c} AS VARCHAR)" for c in columns)
    parts = ", ".join(f"coalesce(length({t}) || ':' || {t}, '~')" for t in texts)
    return f"sha256(concat_ws('|', {parts}))"


def histogram(unit: str, step: str, source: str = "docs", field: str = "stamp") -> str:
    """Gap-filled counts per calendar unit."""
    return f"""
SELECT CAST(s.key AS TIMESTAMP) AS key, coalesce(b.n, 0) AS doc_count
FROM (SELECT unnest(generate_series(min(k), max(k), INTERVAL {step})) AS key
      FROM (SELECT CAST(date_trunc('{unit}', {field}) AS TIMESTAMP) AS k FROM {source})) s
LEFT JOIN (SELECT CAST(date_trunc('{unit}', {field}) AS TIMESTAMP) AS k, count(*) AS n
           FROM {source} GROUP BY 1) b ON b.k = s.key"""


def terms(field: str, size: int) -> str:
    return (f"SELECT {field} AS key, count(*) AS doc_count FROM docs WHERE {field} IS NOT NULL "
            f"GROUP BY 1 ORDER BY doc_count DESC, key LIMIT {size}")
