"""The same queries as plain SQL for DuckDB, to check results against.

The SQL states each result the direct way (correlated subqueries, plain range
joins, windows over whole groups); the Spark side is free to plan differently.
"""

from __future__ import annotations

import re

from crowdlane.functions.text import MONTHS
from crowdlane.sources import standins
from crowdlane.sources.standins import AS_OF, AS_OF_YEAR

NOW = f"timestamp '{AS_OF}'"
TODAY = f"date '{AS_OF[:10]}'"


def _standin(text: str) -> str:
    return text.replace("DOW(ts)", "dayofweek(ts)").format(customer="customer", orders="orders", events="events")


BASE = {
    "venue": _standin(standins.VENUE),
    "sched": _standin(standins.SCHED),
    "listing": _standin(standins.LISTING),
    "meas": _standin(standins.MEAS),
    "timed": "SELECT *, event_start_date::timestamp + to_seconds(start_sec) AS start_ts FROM sched WHERE start_sec IS NOT NULL",
    "near": """
        SELECT measurement_id, event_id, event_name FROM (
          SELECT m.measurement_id, t.event_id, t.event_name,
                 row_number() OVER (PARTITION BY m.measurement_id
                                    ORDER BY abs(epoch_us(m.measurement_time) - epoch_us(t.start_ts)), t.event_id) AS rn
          FROM meas m JOIN timed t ON t.venue_id = m.venue_id
           AND m.measurement_time BETWEEN t.start_ts - INTERVAL 2 HOUR AND t.start_ts + INTERVAL 2 HOUR
          WHERE m.is_baseline = false) WHERE rn = 1""",
    "linked": "SELECT m.*, n.event_id FROM meas m LEFT JOIN near n USING (measurement_id)",
    "ev": """
        SELECT t.event_id, t.event_name, t.event_start_date, t.start_sec, t.category, t.is_multi_day,
               v.venue_id, v.venue_name, v.latitude, v.longitude
        FROM timed t JOIN venue v ON v.venue_id = t.venue_id""",
    "hits": """
        SELECT e.event_id AS eid, e.event_start_date AS d, e.start_sec AS s, e.venue_id AS vid, m.*
        FROM ev e JOIN linked m ON m.event_id = e.event_id
        UNION ALL
        SELECT e.event_id, e.event_start_date, e.start_sec, e.venue_id, m.*
        FROM ev e JOIN linked m ON m.venue_id = e.venue_id AND m.is_baseline AND m.event_id IS DISTINCT FROM e.event_id""",
    "sums": """
        SELECT eid AS event_id,
               count(*) FILTER (event_id IS NOT NULL) AS event_measurements,
               avg(delay_minutes) FILTER (event_id IS NOT NULL) AS event_avg_delay,
               max(delay_minutes) FILTER (event_id IS NOT NULL) AS event_max_delay,
               avg(avg_speed_mph) FILTER (event_id IS NOT NULL) AS event_avg_speed,
               avg(distance_miles) FILTER (event_id IS NOT NULL) AS event_avg_distance,
               count(*) FILTER (is_baseline AND venue_id = vid
                                AND (day_of_week = dayofweek(d) OR hour_of_day = s // 3600)) AS baseline_measurements,
               avg(delay_minutes) FILTER (is_baseline AND venue_id = vid
                                AND day_of_week = dayofweek(d) AND hour_of_day = s // 3600) AS baseline_avg_delay,
               avg(avg_speed_mph) FILTER (is_baseline AND venue_id = vid
                                AND day_of_week = dayofweek(d) AND hour_of_day = s // 3600) AS baseline_avg_speed
        FROM hits GROUP BY eid""",
    "impact": """
        SELECT ev.*, coalesce(event_measurements, 0) AS event_measurements, event_avg_delay, event_max_delay,
               event_avg_speed, coalesce(baseline_measurements, 0) AS baseline_measurements, baseline_avg_delay,
               baseline_avg_speed, event_avg_delay - baseline_avg_delay AS impact_above_baseline, event_avg_distance
        FROM ev LEFT JOIN sums USING (event_id)""",
    "detail": """
        SELECT i.* EXCLUDE (event_avg_distance), t.event_end_date, t.sponsor, t.cost_description,
               CASE WHEN impact_above_baseline IS NULL THEN 'unknown' WHEN impact_above_baseline > 5 THEN 'severe'
                    WHEN impact_above_baseline > 2 THEN 'high' WHEN impact_above_baseline > 1 THEN 'moderate'
                    WHEN impact_above_baseline > 0 THEN 'low' ELSE 'none' END AS impact_level,
               CASE WHEN event_measurements = 0 THEN 'no_event_data' WHEN baseline_measurements = 0 THEN 'no_baseline_data'
                    ELSE 'complete' END AS data_quality
        FROM impact i JOIN sched t USING (event_id)""",
    "around": """
        SELECT t.event_id, t.event_name, t.category, t.start_ts, m.*
        FROM timed t JOIN meas m ON m.venue_id = t.venue_id
         AND m.measurement_time BETWEEN t.start_ts - INTERVAL 2 HOUR AND t.start_ts + INTERVAL 2 HOUR""",
    "halved": """
        SELECT *, CASE WHEN row_number() OVER (PARTITION BY event_id ORDER BY measurement_time, measurement_id)
                            <= count(*) OVER (PARTITION BY event_id) // 2 THEN 0 ELSE 1 END AS half FROM around""",
    "analysed": """
        SELECT *, CASE WHEN delay_increase IS NULL THEN 'unknown' WHEN delay_increase > 5 THEN 'severe'
                       WHEN delay_increase > 2 THEN 'high' WHEN delay_increase > 1 THEN 'moderate'
                       WHEN delay_increase > 0 THEN 'low' ELSE 'no impact' END AS impact_level
        FROM (SELECT *, during_avg_delay - before_avg_delay AS delay_increase,
                     (during_avg_delay - before_avg_delay) / (abs(before_avg_delay) + 1) * 100 AS delay_increase_pct,
                     before_avg_speed - during_avg_speed AS speed_decrease,
                     (before_avg_speed - during_avg_speed) / nullif(before_avg_speed, 0) * 100 AS speed_decrease_pct
              FROM (SELECT h.event_id, any_value(h.event_name) AS event_name, any_value(h.category) AS category,
                           any_value(v.venue_name) AS venue_name, count(*) AS total_measurements,
                           count(*) FILTER (half = 0) AS before_count, avg(delay_minutes) FILTER (half = 0) AS before_avg_delay,
                           max(delay_minutes) FILTER (half = 0) AS before_max_delay, avg(avg_speed_mph) FILTER (half = 0) AS before_avg_speed,
                           count(*) FILTER (half = 1) AS during_count, avg(delay_minutes) FILTER (half = 1) AS during_avg_delay,
                           max(delay_minutes) FILTER (half = 1) AS during_max_delay, avg(avg_speed_mph) FILTER (half = 1) AS during_avg_speed
                    FROM halved h LEFT JOIN venue v USING (venue_id) GROUP BY h.event_id))""",
    "split": """
        SELECT event_id, avg(delay_minutes) FILTER (o < -15) AS avg_delay_before,
               avg(delay_minutes) FILTER (abs(o) <= 15) AS avg_delay_during,
               avg(delay_minutes) FILTER (o > 15) AS avg_delay_after, count(*) AS measurements
        FROM (SELECT *, (epoch_us(measurement_time) - epoch_us(start_ts)) / 6e7 AS o FROM around) GROUP BY event_id""",
    "first_rows": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY event_name, event_start_date, venue_name ORDER BY event_id) AS rn
          FROM sched) WHERE rn = 1""",
    "batch": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT event_id + 1 AS input_seq, event_name, venue_name, new_date AS event_start_date, event_end_date, start_sec,
                 category, cost_min + 1 AS cost_min, coalesce(nullif(is_multi_day, false), false) AS is_multi_day,
                 row_number() OVER (PARTITION BY event_name, new_date, venue_name ORDER BY event_id) AS rn
          FROM (SELECT *, CASE WHEN category = 'Sports' THEN event_start_date + 1 ELSE event_start_date END AS new_date
                FROM sched)) WHERE rn = 1""",
    "days": """
        SELECT event_id, event_name, category, venue_id, start_sec, d AS occurrence_date, d = event_start_date AS is_primary_day
        FROM (SELECT *, unnest(generate_series(event_start_date::timestamp,
                     CASE WHEN is_multi_day THEN event_end_date ELSE event_start_date END::timestamp, INTERVAL 1 DAY))::date AS d
              FROM sched WHERE is_multi_day = false OR event_start_date = event_end_date
                            OR (is_multi_day AND event_end_date > event_start_date))""",
}

LOADED = """event_id, event_name, venue_name, venue_id, event_start_date, event_end_date, start_sec, category, cost_min,
            is_multi_day, sponsor, created_at, updated_at"""

UPSERTED = f"""
    SELECT t.event_id, t.event_name, t.venue_name, t.venue_id, t.event_start_date,
           CASE WHEN b.input_seq IS NULL THEN t.event_end_date ELSE b.event_end_date END AS event_end_date,
           CASE WHEN b.input_seq IS NULL THEN t.start_sec ELSE b.start_sec END AS start_sec,
           CASE WHEN b.input_seq IS NULL THEN t.category ELSE b.category END AS category,
           CASE WHEN b.input_seq IS NULL THEN t.cost_min ELSE b.cost_min END AS cost_min,
           CASE WHEN b.input_seq IS NULL THEN t.is_multi_day ELSE nullif(b.is_multi_day, false) END AS is_multi_day,
           t.sponsor, t.created_at,
           CASE WHEN b.input_seq IS NULL THEN t.updated_at ELSE {NOW} END AS updated_at
    FROM first_rows t LEFT JOIN batch b
      ON b.event_name = t.event_name AND b.event_start_date = t.event_start_date AND b.venue_name = t.venue_name
    UNION ALL
    SELECT (SELECT max(event_id) FROM first_rows) + input_seq, event_name, venue_name, NULL, event_start_date,
           event_end_date, start_sec, category, cost_min, is_multi_day, NULL, {NOW}, {NOW}
    FROM batch b WHERE NOT EXISTS (SELECT 1 FROM first_rows t WHERE b.event_name = t.event_name
                        AND b.event_start_date = t.event_start_date AND b.venue_name = t.venue_name)"""

HOURLY = """
    SELECT date_trunc('hour', measurement_time) AS collection_hour, data_source, count(*) AS measurements,
           count(*) FILTER (is_baseline) AS baseline_count, count({ev}) AS event_count, {distinct}
           avg(delay_minutes) AS avg_delay, min(measurement_time) AS first_measurement, max(measurement_time) AS last_measurement
    FROM {table} GROUP BY ALL"""

PLAN = """
    SELECT event_id, event_name, category, event_start_date, start_sec, start_sec IS NOT NULL AS collect,
           CASE WHEN start_sec IS NULL THEN 'No event time available' END AS reason,
           CASE WHEN start_sec IS NOT NULL THEN concat(CASE WHEN major THEN 'major' ELSE 'minor' END,
                CASE WHEN is_multi_day THEN '_multi_day' ELSE '_single_day' END) END AS plan_type,
           CASE WHEN start_sec IS NOT NULL THEN true END AS collect_before,
           CASE WHEN start_sec IS NOT NULL THEN major END AS collect_after,
           CASE WHEN start_sec IS NOT NULL THEN 1 END AS hours_before,
           CASE WHEN start_sec IS NOT NULL AND major THEN 1 END AS hours_after,
           CASE WHEN start_sec IS NOT NULL THEN CASE WHEN major THEN 4 ELSE 2 END END AS num_directions,
           CASE WHEN start_sec IS NOT NULL THEN CASE WHEN major THEN 'North,South,East,West' ELSE 'North,South' END END AS directions,
           CASE WHEN start_sec IS NULL THEN 0 WHEN major THEN 8 ELSE 2 END AS estimated_calls
    FROM (SELECT *, coalesce(regexp_matches(lower(category), 'sports|festival|music'), false) AS major FROM sched)"""

SLOTS = "[420, 720, 1020, 1140, 1260, 1380]"
SLOT_LABEL = "concat(lpad((slot // 60)::varchar, 2, '0'), ':', lpad((slot % 60)::varchar, 2, '0'))"
GROUPS = """
    SELECT venue_id, venue_name, rn AS position,
           CASE WHEN n // 4 = 0 THEN 4 ELSE least((rn - 1) // (n // 4) + 1, 4) END::int AS venue_group
    FROM (SELECT venue_id, venue_name, row_number() OVER (ORDER BY venue_id) AS rn, count(*) OVER () AS n FROM venue)"""
DAY_PLAN = f"""
    SELECT venue_id, venue_name, venue_group, {TODAY} AS plan_date, slot, {SLOT_LABEL} AS time_slot
    FROM (SELECT *, unnest({SLOTS}) AS slot FROM ({GROUPS}) WHERE venue_group = 3)"""

DAY_NAME = "CASE {d} " + " ".join(
    f"WHEN {i} THEN '{n}'"
    for i, n in enumerate(["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"])
) + " END"


def _day_name(d: str) -> str:
    return DAY_NAME.replace("{d}", d)


def _month(x: str) -> str:
    return "CASE left(lower(" + x + "), 3) " + " ".join(f"WHEN '{m[:3]}' THEN {i}" for i, m in enumerate(MONTHS, 1)) + " END"


# every text of the stand-in listings has one of four shapes, told apart by the first match
DATES = f"""
    SELECT listing_id, make_date(y1, m1, d1) AS start_date, make_date(y2, m2, d2) AS end_date,
           coalesce(make_date(y1, m1, d1) <> make_date(y2, m2, d2), false) AS is_multi_day
    FROM (SELECT listing_id, {_month('w[1]')} AS m1, {_month('w[2]')} AS m2,
                 try_cast(n[1] AS int) AS d1, try_cast(n[2] AS int) AS d2,
                 CASE WHEN w[1] IS NOT NULL THEN {AS_OF_YEAR} END AS y1, CASE WHEN w[2] IS NOT NULL THEN {AS_OF_YEAR} END AS y2
          FROM (SELECT listing_id,
                       CASE len(ws) WHEN 0 THEN [] WHEN 1 THEN [ws[1], ws[1]] ELSE ws END AS w,
                       CASE len(ns) WHEN 1 THEN [ns[1], ns[1]] ELSE ns END AS n
                FROM (SELECT listing_id, regexp_extract_all(dates_text, '([A-Za-z]+) \\d', 1) AS ws,
                             regexp_extract_all(dates_text, '[a-z] (\\d{{1,2}})', 1) AS ns FROM listing)))"""


def _clock(part: str) -> str:
    h, m, p = (f"regexp_extract({part}, '^\\s*(\\d{{1,2}}):?(\\d{{2}})?\\s*([AaPp])[Mm]', {g})" for g in (1, 2, 3))
    return (
        f"CASE WHEN {h} <> '' THEN (try_cast({h} AS int) % 12 + CASE WHEN upper({p}) = 'P' THEN 12 ELSE 0 END) * 3600"
        f" + coalesce(try_cast({m} AS int), 0) * 60 END"
    )


TIMES = f"""
    SELECT listing_id, {_clock("p[1]")} AS start_sec, {_clock("p[2]")} AS end_sec
    FROM (SELECT listing_id, string_split(time_text, ' to ') AS p FROM listing)"""
COSTS = """
    SELECT listing_id, CASE WHEN price_text LIKE 'Free%' THEN 0.0 ELSE list_min(a) END::double AS cost_min,
           CASE WHEN price_text LIKE 'Free%' THEN 0.0 ELSE list_max(a) END::double AS cost_max,
           CASE WHEN price_text LIKE 'Free%' THEN 'Free' ELSE price_text END AS cost_description
    FROM (SELECT listing_id, price_text,
                 list_transform(regexp_extract_all(price_text, '\\d+(\\.\\d{2})?'), lambda x: x::double) AS a FROM listing)"""
PHONES = """
    SELECT listing_id, CASE WHEN length(d) >= 10 THEN right(d, 10) ELSE nullif(trim(phone_text), '') END AS phone
    FROM (SELECT *, regexp_replace(phone_text, '\\D', '', 'g') AS d FROM listing)"""
EMAILS = """
    SELECT listing_id, coalesce(nullif(regexp_extract(email_text, '[\\w.-]+@[\\w.-]+\\.\\w+'), ''), nullif(trim(email_text), '')) AS email
    FROM listing"""
CATEGORIES = """
    SELECT listing_id, coalesce(nullif(url_decode(regexp_extract(gtm_vars, '"crmCatSubcat": "([^"]+)"', 1)), ''), 'General') AS category
    FROM listing"""


def _miles(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    a = (
        f"(sin(radians({lat2} - {lat1}) / 2) ** 2 + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * sin(radians({lng2} - {lng1}) / 2) ** 2)"
    )
    return f"2 * 3959 * asin(sqrt({a}))"


def _level(d: str, first: float = 0.5) -> str:
    return f"CASE WHEN {d} < {first} THEN 'light' WHEN {d} < 2 THEN 'moderate' WHEN {d} < 5 THEN 'heavy' ELSE 'severe' END"


def _matrix_level(d: str) -> str:
    return f"CASE WHEN {d} <= 0 THEN 'light' WHEN {d} <= 2 THEN 'moderate' WHEN {d} <= 5 THEN 'heavy' ELSE 'severe' END"


TIERS = """
    SELECT t.event_id, t.venue_id,
           CASE WHEN x.d IS NOT NULL THEN 'exact_match' WHEN h.d IS NOT NULL THEN 'same_hour'
                WHEN w.d IS NOT NULL THEN 'same_day' WHEN v.d IS NOT NULL THEN 'venue_average' ELSE 'none' END AS baseline_tier,
           coalesce(x.d, h.d, w.d, v.d) AS baseline_delay,
           CASE WHEN x.d IS NOT NULL THEN x.s WHEN h.d IS NOT NULL THEN h.s WHEN w.d IS NOT NULL THEN w.s ELSE v.s END AS baseline_speed
    FROM timed t
    LEFT JOIN (SELECT venue_id, day_of_week, hour_of_day, avg(delay_minutes) AS d, avg(avg_speed_mph) AS s
               FROM meas WHERE is_baseline GROUP BY ALL) x
      ON x.venue_id = t.venue_id AND x.day_of_week = dayofweek(t.event_start_date) AND x.hour_of_day = t.start_sec // 3600
    LEFT JOIN (SELECT venue_id, hour_of_day, avg(delay_minutes) AS d, avg(avg_speed_mph) AS s
               FROM meas WHERE is_baseline GROUP BY ALL) h ON h.venue_id = t.venue_id AND h.hour_of_day = t.start_sec // 3600
    LEFT JOIN (SELECT venue_id, day_of_week, avg(delay_minutes) AS d, avg(avg_speed_mph) AS s
               FROM meas WHERE is_baseline GROUP BY ALL) w ON w.venue_id = t.venue_id AND w.day_of_week = dayofweek(t.event_start_date)
    LEFT JOIN (SELECT venue_id, avg(delay_minutes) AS d, avg(avg_speed_mph) AS s
               FROM meas WHERE is_baseline GROUP BY ALL) v ON v.venue_id = t.venue_id
    WHERE t.venue_id IS NOT NULL"""

OCCURRENCES = """
    WITH occ AS (SELECT *, occurrence_date::timestamp + to_seconds(start_sec) AS start_ts FROM days),
    olinked AS (
      SELECT m.*, n.event_id, n.occurrence_date FROM meas m LEFT JOIN (
        SELECT * FROM (SELECT m.measurement_id, o.event_id, o.occurrence_date,
               row_number() OVER (PARTITION BY m.measurement_id ORDER BY
                   abs(epoch_us(m.measurement_time) - epoch_us(o.start_ts)), o.event_id, o.occurrence_date) AS rn
          FROM meas m JOIN occ o ON o.venue_id = m.venue_id
           AND m.measurement_time BETWEEN o.start_ts - INTERVAL 2 HOUR AND o.start_ts + INTERVAL 2 HOUR
          WHERE m.is_baseline = false) WHERE rn = 1) n USING (measurement_id))
    SELECT o.event_id, o.occurrence_date, o.event_name, o.start_sec, o.category, v.venue_name,
           any_value(e.d) AS event_delay, coalesce(any_value(e.n), 0) AS event_measurements,
           any_value(b.d) AS baseline_delay, coalesce(any_value(b.n), 0) AS baseline_measurements,
           any_value(e.d) - any_value(b.d) AS impact_above_baseline
    FROM occ o JOIN venue v USING (venue_id)
    LEFT JOIN (SELECT event_id, occurrence_date, avg(delay_minutes) AS d, count(*) AS n FROM olinked
               WHERE event_id IS NOT NULL GROUP BY ALL) e ON e.event_id = o.event_id AND e.occurrence_date = o.occurrence_date
    LEFT JOIN (SELECT venue_id, day_of_week, hour_of_day, avg(delay_minutes) AS d, count(*) AS n FROM olinked
               WHERE is_baseline GROUP BY ALL) b
      ON b.venue_id = o.venue_id AND b.day_of_week = dayofweek(o.occurrence_date) AND b.hour_of_day = o.start_sec // 3600
    GROUP BY ALL"""

CALLS = f"""
    SELECT plan_type, sum(estimated_calls)::bigint AS calls, count(*) AS events_processed FROM ({PLAN}) GROUP BY plan_type"""


def _forecast(now: str) -> str:
    return f"""
    SELECT 'baseline' AS collection, coalesce(sum(c) FILTER (slot // 60 < hour({now}) OR (slot // 60 = hour({now})
                AND slot % 60 <= minute({now}))), 0)::bigint AS completed_calls,
           coalesce(sum(c) FILTER (slot // 60 > hour({now})), 0)::bigint AS remaining_calls, coalesce(sum(c), 0)::bigint AS total_calls
    FROM (SELECT unnest({SLOTS}) AS slot, (SELECT count(*) // 2 * 4 FROM venue) AS c)
    WHERE day({now}) BETWEEN 8 AND 14 OR day({now}) BETWEEN 22 AND 30
    UNION ALL
    SELECT 'event', 2 * count(*) FILTER (p <= {now} - INTERVAL 30 MINUTE), 2 * count(*) FILTER (p >= {now}), 2 * count(*)
    FROM (SELECT start_ts + to_minutes(unnest([-60, -30, 0, 30, 60])) AS p FROM ev JOIN timed USING (event_id)
          WHERE timed.event_start_date = {now}::date)"""


UNESCAPE = "regexp_replace({x}, '<[^>]*>', '', 'g')"
for _name, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    UNESCAPE = f"replace({UNESCAPE}, '{_name}', '{_char}')"


def _sql(body: str, *doubles: str) -> str:
    """Prefix the views a query uses and round its doubles."""
    used: list[str] = []

    def need(text: str) -> None:
        for name in BASE:
            if name not in used and re.search(rf"\b{name}\b", text):
                need(BASE[name])
                if name not in used:
                    used.append(name)

    need(body)
    with_ = ",\n".join(f"{n} AS ({BASE[n]})" for n in used)
    if doubles:
        rounded = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in doubles)
        body = f"SELECT * REPLACE ({rounded}) FROM ({body})"
    return f"WITH {with_}\n{body}" if used else body


IMPACT_DOUBLES = [
    "latitude", "longitude", "event_avg_delay", "event_avg_speed", "baseline_avg_delay", "baseline_avg_speed", "impact_above_baseline",
]
ANALYSED_DOUBLES = [
    "before_avg_delay", "before_avg_speed", "during_avg_delay", "during_avg_speed", "delay_increase",
    "delay_increase_pct", "speed_decrease", "speed_decrease_pct",
]
SHORT = "event_id, event_name, category, event_start_date, venue_name"
MONTH = f"event_start_date >= date_trunc('month', {NOW}) AND event_start_date < date_trunc('month', {NOW}) + INTERVAL 1 MONTH"

ORACLES: dict[str, str] = {
    "load_tables": _sql(
        """SELECT 'events' AS table_name, count(*) AS row_count, max(event_start_date) AS latest FROM sched
           UNION ALL SELECT 'venue_locations', count(*), NULL FROM venue
           UNION ALL SELECT 'traffic_measurements', count(*), max(measurement_time)::date FROM meas"""
    ),
    "dedup_events": _sql("SELECT event_id, event_name, event_start_date, venue_name, category FROM first_rows"),
    "upsert_events": _sql(UPSERTED.replace("nullif(b.is_multi_day, false)", "CASE WHEN b.is_multi_day THEN true END"), "cost_min"),
    "upsert_venues": _sql(
        f"""WITH g AS (SELECT * EXCLUDE (rn) FROM (
               SELECT *, row_number() OVER (PARTITION BY venue_name ORDER BY input_seq DESC) AS rn FROM (
                 SELECT venue_id + 1 AS input_seq, CASE WHEN latitude IS NULL THEN concat('New venue ', venue_id)
                        ELSE concat('Customer#', lpad((venue_id // 2)::varchar, 9, '0')) END AS venue_name,
                        concat(address, ' (geocoded)') AS address, coalesce(latitude, 35.0) AS latitude, longitude, place_id
                 FROM venue)) WHERE rn = 1)
            SELECT v.venue_id, v.venue_name, CASE WHEN g.input_seq IS NULL THEN v.address ELSE g.address END AS address,
                   city, state, CASE WHEN g.input_seq IS NULL THEN v.latitude ELSE g.latitude END AS latitude,
                   CASE WHEN g.input_seq IS NULL THEN v.longitude ELSE g.longitude END AS longitude,
                   CASE WHEN g.input_seq IS NULL THEN v.place_id ELSE g.place_id END AS place_id
            FROM venue v LEFT JOIN g USING (venue_name)
            UNION ALL
            SELECT (SELECT max(venue_id) FROM venue) + input_seq, venue_name, address, 'Albuquerque', 'NM', latitude, longitude, place_id
            FROM g WHERE venue_name NOT IN (SELECT venue_name FROM venue)""",
        "latitude",
        "longitude",
    ),
    "append_measurements": _sql(
        """SELECT measurement_id, coalesce(is_baseline, false) AS is_baseline, CASE WHEN is_baseline THEN 'weekly' END AS baseline_type,
                  data_source, round(avg_speed_mph / 8 - 2.5)::int AS delay_minutes,
                  dayofweek(measurement_time)::int AS day_of_week, hour(measurement_time)::int AS hour_of_day FROM meas"""
    ),
    "link_events_to_venues": _sql(
        """SELECT s.event_id, s.venue_name, coalesce(CASE WHEN s.category IS NOT NULL THEN s.venue_id END, v.venue_id) AS venue_id
           FROM sched s LEFT JOIN venue v ON v.venue_name = s.venue_name"""
    ),
    "distinct_venues": _sql("SELECT DISTINCT venue_name FROM sched WHERE venue_name <> ''"),
    "venues_to_geocode": _sql(
        """SELECT DISTINCT venue_name FROM sched WHERE venue_name <> ''
           AND venue_name NOT IN (SELECT venue_name FROM venue WHERE latitude IS NOT NULL)"""
    ),
    "load_stats": _sql(
        """SELECT count(*) AS events_loaded, count(m) AS updated_events, count(*) - count(m) AS new_events,
                  (SELECT count(*) FROM first_rows) + count(*) - count(m) AS total_in_db
           FROM batch b LEFT JOIN (SELECT event_name, event_start_date, venue_name, 1 AS m FROM first_rows) t
             ON b.event_name = t.event_name AND b.event_start_date = t.event_start_date AND b.venue_name = t.venue_name"""
    ),
    "collection_log": _sql(
        """SELECT measurement_time::date AS run_date, count(*) AS log_lines, count(*) FILTER (is_baseline) AS runs,
                  coalesce(sum(venue_id * 4) FILTER (is_baseline), 0)::bigint AS measurements,
                  coalesce(sum(venue_id * 4) FILTER (is_baseline), 0)::bigint AS api_calls,
                  (max(venue_id + 2) FILTER (is_baseline))::int AS max_venues FROM meas GROUP BY ALL"""
    ),
    "source_field_mapping": _sql(
        f"""SELECT source_name, venue_name, category, latitude, count(*) AS listings, count(start_sec) AS with_time,
                  min(d) AS first_date, max(d) AS last_date, count(longitude) AS with_longitude, max(event_name) AS last_name
           FROM (SELECT 'listings' AS source_name, event_name, venue_name, event_start_date AS d, start_sec, category,
                        NULL::double AS latitude, NULL::double AS longitude FROM sched
                 UNION ALL SELECT 'ballpark', concat('Game ', o_orderkey), 'Ballpark', o_orderdate::date, NULL, 'Sports - Baseball',
                        35.0781, -106.6044 FROM orders
                 UNION ALL SELECT 'community', concat('Listing ', listing_id), NULL, start_date, start_sec, NULL, NULL, NULL
                        FROM ({DATES}) JOIN ({TIMES}) USING (listing_id)) GROUP BY ALL""",
        "latitude",
    ),
    "events_by_date_range": _sql(
        f"SELECT {SHORT} FROM sched WHERE event_start_date BETWEEN date '2024-01-10' AND date '2024-01-16'"
    ),
    "events_by_category": _sql(f"SELECT {SHORT} FROM sched WHERE category = 'Concerts & Music'"),
    "multi_day_events": _sql(f"SELECT {SHORT}, event_end_date FROM sched WHERE is_multi_day"),
    "events_multi_day": _sql(
        """SELECT event_id, event_name, venue_name, event_start_date, event_end_date, start_sec, end_sec, category, venue_id,
                  (event_end_date - event_start_date + 1)::int AS duration_days
           FROM sched WHERE is_multi_day AND event_start_date <> event_end_date"""
    ),
    "events_single_day": _sql(
        """SELECT event_id, event_name, venue_name, event_start_date AS event_date, start_sec AS event_sec, category, venue_id,
                  created_at, updated_at FROM sched WHERE NOT is_multi_day OR event_start_date = event_end_date"""
    ),
    "venue_lookup": _sql(
        """SELECT *, 'by_name' AS lookup FROM venue WHERE venue_name = 'Customer#000000042'
           UNION ALL SELECT *, 'all' FROM venue""",
        "latitude",
        "longitude",
    ),
    "events_today_with_time": _sql(
        f"""SELECT event_id, event_name, event_start_date, start_sec, category, venue_id, venue_name, latitude, longitude
            FROM ev WHERE event_start_date = {TODAY}""",
        "latitude",
        "longitude",
    ),
    "events_with_venues": _sql(
        """SELECT s.event_id, s.event_name, v.venue_id, v.venue_name, v.latitude, v.longitude
           FROM sched s JOIN venue v ON v.venue_id = s.venue_id""",
        "latitude",
        "longitude",
    ),
    "truncate_fields": _sql(
        """SELECT event_id, left(event_name, 7) AS event_name, venue_name, left(category, 10) AS category, left(sponsor, 9) AS sponsor,
                  (coalesce(length(event_name) > 7, false)::int + coalesce(length(category) > 10, false)::int
                   + coalesce(length(sponsor) > 9, false)::int)::int AS fields_cut FROM sched"""
    ),
    "validate_events": _sql(
        f"""SELECT listing_id, event_name, event_start_date, CASE WHEN coalesce(event_name, '') = '' THEN 'Missing event_name'
                   WHEN event_start_date IS NULL THEN 'Missing event_start_date' ELSE 'Valid' END AS reason
            FROM (SELECT listing_id, nullif(left('Listing', (listing_id % 8)::int), 'L') AS event_name, start_date AS event_start_date
                  FROM ({DATES}))"""
    ),
    "dashboard_filter": _sql(
        f"""SELECT event_id, category, event_start_date, impact_level, data_quality, impact_above_baseline
            FROM detail WHERE category = 'Sports' AND data_quality = 'complete' AND {MONTH}""",
        "impact_above_baseline",
    ),
    "numeric_coerce": _sql(
        """SELECT event_id, impact_above_baseline AS impact_minutes, event_measurements::double AS measurement_count,
                  greatest(coalesce(impact_above_baseline, 0), 0)::double AS impact_above_baseline FROM detail""",
        "impact_minutes",
        "measurement_count",
        "impact_above_baseline",
    ),
    "events_needing_baseline_link": _sql(
        "SELECT measurement_id, venue_id, measurement_time FROM linked WHERE event_id IS NULL AND is_baseline = false"
    ),
    "speed_comparison": _sql(
        """SELECT event_id, event_name, event_avg_speed, baseline_avg_speed FROM detail
           WHERE event_avg_speed IS NOT NULL AND baseline_avg_speed IS NOT NULL""",
        "event_avg_speed",
        "baseline_avg_speed",
    ),
    "event_traffic_with_baseline": _sql("SELECT * EXCLUDE (event_avg_distance) FROM impact", *IMPACT_DOUBLES),
    "event_traffic_data": _sql(
        """SELECT a.event_id, a.event_name, a.start_ts::date AS event_start_date, t.start_sec, a.category, v.venue_id, v.venue_name,
                  measurement_id, measurement_time, traffic_level, delay_minutes, avg_speed_mph, typical_speed_mph,
                  (epoch_us(measurement_time) - epoch_us(a.start_ts)) / 3.6e9 AS hours_from_event
           FROM around a JOIN venue v USING (venue_id) JOIN sched t ON t.event_id = a.event_id""",
        "avg_speed_mph",
        "typical_speed_mph",
        "hours_from_event",
    ),
    "nearest_event_link": _sql("SELECT measurement_id, venue_id, event_id, is_baseline FROM linked"),
    "match_rank": _sql(
        """SELECT measurement_id, event_id, event_name, t AS event_datetime, measurement_time,
                  (epoch_us(measurement_time) - epoch_us(t)) / 3600000000.0::double AS hours_from_event
           FROM (SELECT n.*, m.measurement_time, s.event_start_date::timestamp + to_seconds(s.start_sec) AS t
                 FROM (SELECT measurement_id, event_id, event_name FROM near) n JOIN meas m USING (measurement_id) JOIN sched s USING (event_id))""",
        "hours_from_event",
    ),
    "event_impact_detail": _sql("SELECT * FROM detail", *IMPACT_DOUBLES),
    "events_missing_traffic": _sql(
        f"""SELECT event_id, event_name, event_start_date, start_sec, category, venue_name, d::int AS days_until_event,
                   CASE WHEN d < 0 THEN 'past' WHEN d = 0 THEN 'today' ELSE 'future' END AS event_status, 0::bigint AS traffic_measurements,
                   CASE WHEN d > 7 THEN 'Too far in future' WHEN d < -7 THEN 'Event already passed'
                        WHEN d <= 0 AND d >= -2 THEN 'Should have data - check collector' ELSE 'Collection pending' END AS missing_reason
            FROM (SELECT *, event_start_date - {TODAY} AS d FROM ev)
            WHERE event_id NOT IN (SELECT event_id FROM linked WHERE event_id IS NOT NULL)"""
    ),
    "events_with_traffic": _sql("SELECT DISTINCT event_id, start_ts::date AS event_start_date FROM around"),
    "traffic_for_event": _sql(
        """SELECT s.event_id, s.event_name, s.category, v.venue_name, s.t AS event_datetime, measurement_id, measurement_time,
                  traffic_level, avg_speed_mph, typical_speed_mph, delay_minutes, distance_miles
           FROM (SELECT *, event_start_date::timestamp + to_seconds(coalesce(start_sec, 0)) AS t FROM sched) s
           JOIN venue v ON v.venue_id = s.venue_id JOIN meas m ON m.venue_id = s.venue_id
            AND m.measurement_time BETWEEN s.t - INTERVAL 2 HOUR AND s.t + INTERVAL 2 HOUR""",
        "avg_speed_mph",
        "typical_speed_mph",
        "distance_miles",
    ),
    "occurrence_impact": _sql(OCCURRENCES, "event_delay", "baseline_delay", "impact_above_baseline"),
    "multi_day_window_match": _sql(
        """SELECT s.event_id, m.venue_id, m.measurement_time::date AS occurrence_date, measurement_id, measurement_time, delay_minutes,
                  (epoch_us(measurement_time) - epoch_us(date_trunc('day', measurement_time)) - s.start_sec * 1000000::bigint) / 3.6e9 AS hours_from_start
           FROM sched s JOIN meas m ON m.venue_id = s.venue_id AND m.measurement_time::date BETWEEN s.event_start_date AND s.event_end_date
            AND abs((epoch_us(measurement_time) - epoch_us(date_trunc('day', measurement_time))) - s.start_sec * 1000000::bigint) <= 7200000000""",
        "hours_from_start",
    ),
    "baseline_match_tiers": _sql(TIERS, "baseline_delay", "baseline_speed"),
    "category_traffic_impact": _sql(
        """SELECT category, count(DISTINCT event_id) AS event_count,
                  count(DISTINCT CASE WHEN impact_above_baseline IS NOT NULL THEN event_id END) AS events_with_baseline,
                  avg(impact_above_baseline) AS avg_impact_minutes, max(impact_above_baseline) AS max_impact_minutes,
                  min(impact_above_baseline) AS min_impact_minutes, avg(event_avg_delay) AS avg_event_delay,
                  avg(baseline_avg_delay) AS avg_baseline_delay,
                  round(count(*) FILTER (impact_above_baseline > 2) * 100.0::double / count(DISTINCT event_id), 1) AS pct_high_impact
           FROM impact WHERE event_measurements > 0 GROUP BY category""",
        "avg_impact_minutes",
        "max_impact_minutes",
        "min_impact_minutes",
        "avg_event_delay",
        "avg_baseline_delay",
        "pct_high_impact",
    ),
    "category_speed_impact": _sql(
        """SELECT category, count(*) AS event_count, avg(event_avg_speed) AS avg_event_speed, avg(baseline_avg_speed) AS avg_baseline_speed,
                  avg(baseline_avg_speed - event_avg_speed) AS avg_speed_difference
           FROM impact WHERE event_measurements > 0 GROUP BY category""",
        "avg_event_speed",
        "avg_baseline_speed",
        "avg_speed_difference",
    ),
    "venue_baseline_patterns": _sql(
        f"""SELECT *, {_level('avg_delay', 1)} AS typical_traffic_level FROM (
              SELECT v.venue_id, v.venue_name, day_of_week, {_day_name('day_of_week')} AS day_name, hour_of_day,
                     count(*) AS measurement_count, avg(delay_minutes) AS avg_delay, avg(avg_speed_mph) AS avg_speed
              FROM venue v JOIN meas USING (venue_id) WHERE is_baseline AND baseline_type = 'weekly' GROUP BY ALL)""",
        "avg_delay",
        "avg_speed",
    ),
    "traffic_summary_by_venue": _sql(
        """SELECT v.venue_id, v.venue_name, count(measurement_id) AS measurement_count, avg(delay_minutes) AS avg_delay_minutes,
                  max(delay_minutes) AS max_delay_minutes, min(measurement_time) AS first_measurement, max(measurement_time) AS last_measurement
           FROM venue v LEFT JOIN meas m ON m.venue_id = v.venue_id GROUP BY ALL""",
        "avg_delay_minutes",
    ),
    "top_venues_by_measurements": _sql(
        """SELECT v.venue_id, v.venue_name, count(measurement_id) AS measurement_count, avg(delay_minutes) AS avg_delay_minutes
           FROM venue v LEFT JOIN meas m ON m.venue_id = v.venue_id GROUP BY ALL ORDER BY 3 DESC, 1 LIMIT 10""",
        "avg_delay_minutes",
    ),
    "venues_missing_baseline": _sql(
        f"""SELECT *, CASE WHEN total_baseline_measurements = 0 THEN 'No baseline data' WHEN days_covered < 7 THEN 'Incomplete day coverage'
                    WHEN hours_covered < 6 THEN 'Incomplete hour coverage' WHEN days_since_baseline > 30 THEN 'Baseline data outdated'
                    ELSE 'Good coverage' END AS baseline_status
            FROM (SELECT v.venue_id, v.venue_name, count(measurement_id) AS total_baseline_measurements,
                         count(DISTINCT day_of_week)::int AS days_covered, count(DISTINCT hour_of_day)::int AS hours_covered,
                         max(measurement_time) AS last_baseline_collection,
                         trunc((epoch_us({NOW}) - epoch_us(max(measurement_time))) / 8.64e10)::bigint AS days_since_baseline
                  FROM venue v LEFT JOIN meas m ON m.venue_id = v.venue_id AND is_baseline GROUP BY ALL)"""
    ),
    "api_usage_by_day": _sql(
        f"""SELECT measurement_time::date AS date, data_source, count(*) AS api_calls, count(*) FILTER (is_baseline) AS baseline_calls,
                   count(event_id) AS event_calls, count(*) FILTER (data_source = 'google_maps') AS google_maps_calls,
                   count(*) FILTER (data_source = 'tomtom') AS tomtom_calls,
                   min(measurement_time) AS first_call, max(measurement_time) AS last_call
            FROM linked WHERE measurement_time >= {TODAY} - 30 GROUP BY ALL"""
    ),
    "usage_7day_pivot": _sql(
        f"""WITH u AS (SELECT measurement_time::date AS date, count(*) FILTER (data_source = 'google_maps') AS google_maps,
                              count(*) FILTER (data_source = 'tomtom') AS tomtom, count(*) AS total_calls
                       FROM meas WHERE measurement_time >= {TODAY} - 7 GROUP BY ALL)
            SELECT date, google_maps, tomtom, total_calls - google_maps - tomtom AS other_calls, total_calls,
                   NULL::double AS avg_per_day FROM u
            UNION ALL SELECT NULL, coalesce(sum(google_maps), 0)::bigint, coalesce(sum(tomtom), 0)::bigint,
                             coalesce(sum(total_calls - google_maps - tomtom), 0)::bigint, coalesce(sum(total_calls), 0)::bigint,
                             coalesce(sum(total_calls), 0)::double / 7 FROM u""",
        "avg_per_day",
    ),
    "recent_collection_activity": _sql(
        HOURLY.format(
            ev="event_id",
            distinct="count(DISTINCT venue_id) AS venues_measured, count(DISTINCT event_id) AS events_measured,",
            table=f"(SELECT * FROM linked WHERE measurement_time > {NOW} - INTERVAL 24 HOUR)",
        ),
        "avg_delay",
    ),
    "collection_status_summary": _sql(
        f"""SELECT (SELECT count(*) FROM sched) AS total_events, (SELECT count(start_sec) FROM sched) AS events_with_time,
                   (SELECT count(*) FROM venue) AS total_venues, count(*) AS total_measurements, count(event_id) AS event_measurements,
                   count(DISTINCT event_id) AS events_with_traffic, count(*) FILTER (is_baseline) AS baseline_measurements,
                   count(DISTINCT venue_id) FILTER (is_baseline) AS venues_with_baseline, count(*) FILTER (r) AS measurements_last_24h,
                   count(*) FILTER (r AND is_baseline) AS baseline_last_24h, count(event_id) FILTER (r) AS event_traffic_last_24h,
                   count(*) FILTER (data_source = 'google_maps') AS google_maps_calls, count(*) FILTER (data_source = 'tomtom') AS tomtom_calls,
                   max(measurement_time) AS last_measurement, max(measurement_time) FILTER (is_baseline) AS last_baseline_collection,
                   max(measurement_time) FILTER (event_id IS NOT NULL) AS last_event_collection
            FROM (SELECT *, measurement_time > {NOW} - INTERVAL 24 HOUR AS r FROM linked)"""
    ),
    "collection_schedule_validation": _sql(
        f"""SELECT t.event_id, t.event_name, t.start_ts AS event_datetime, t.start_ts - INTERVAL 2 HOUR AS collection_window_start,
                   t.start_ts + INTERVAL 2 HOUR AS collection_window_end, count(measurement_id) AS actual_measurements,
                   min(measurement_time) AS first_measurement, max(measurement_time) AS last_measurement,
                   CASE WHEN count(measurement_id) = 0 THEN 'No data collected' WHEN count(measurement_id) < 9 THEN 'Incomplete collection'
                        ELSE 'Good coverage' END AS collection_status,
                   (epoch_us(t.start_ts) - epoch_us({NOW})) / 3.6e9 AS hours_until_event
            FROM timed t LEFT JOIN linked m ON m.event_id = t.event_id
            WHERE t.event_start_date BETWEEN {TODAY} - 1 AND {TODAY} + 1 GROUP BY ALL""",
        "hours_until_event",
    ),
    "event_statistics": _sql(
        """SELECT *, multi_day_events * 100 // total_events AS multi_day_events_pct, events_with_times * 100 // total_events AS events_with_times_pct,
                  events_with_cost * 100 // total_events AS events_with_cost_pct, events_with_sponsors * 100 // total_events AS events_with_sponsors_pct
           FROM (SELECT count(*) AS total_events, count(*) FILTER (is_multi_day) AS multi_day_events, count(start_sec) AS events_with_times,
                        count(cost_description) AS events_with_cost, count(*) FILTER (cost_min = 0) AS free_events,
                        count(sponsor) AS events_with_sponsors, avg(cost_min) AS avg_cost_min, avg(cost_max) AS avg_cost_max FROM sched)""",
        "avg_cost_min",
        "avg_cost_max",
    ),
    "top_event_venues": _sql(
        """SELECT venue_name, count(*) AS event_count FROM sched WHERE venue_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
    ),
    "category_counts": _sql("SELECT category, count(*) AS event_count, count(start_sec) AS with_time FROM sched GROUP BY 1"),
    "event_occurrences": _sql("SELECT event_id, occurrence_date, start_sec, is_primary_day FROM days"),
    "impact_summary": _sql(
        """SELECT 'level' AS part, impact_level AS label, count(*) AS event_count, count(*) * 100.0::double / (SELECT count(*) FROM analysed) AS value
           FROM analysed GROUP BY impact_level
           UNION ALL SELECT 'category', category, count(*), coalesce(avg(delay_increase), 0) FROM analysed GROUP BY category
           UNION ALL SELECT * FROM (SELECT 'top', event_id::varchar, 1, delay_increase FROM analysed WHERE delay_increase IS NOT NULL
                     ORDER BY delay_increase DESC, event_id LIMIT 10)""",
        "value",
    ),
    "dashboard_kpis": _sql(
        """SELECT count(*) FILTER (event_measurements > 0) AS events_analyzed, avg(impact_above_baseline) AS avg_impact,
                  count(*) FILTER (event_measurements > 0 AND baseline_measurements > 0) AS events_with_baseline,
                  count(*) FILTER (impact_level IN ('high', 'severe')) AS high_impact_events FROM detail""",
        "avg_impact",
    ),
    "quality_distribution": _sql(
        """SELECT data_quality AS label, count(*) AS event_count, 'data_quality' AS kind FROM detail
           WHERE data_quality <> 'no_event_data' GROUP BY 1
           UNION ALL SELECT impact_level, count(*), 'impact_level' FROM detail GROUP BY 1"""
    ),
    "dow_hour_distribution": _sql(
        f"""SELECT 'day_of_week' AS dimension, day_of_week::int AS value, count(*) AS measurement_count, {_day_name('day_of_week')} AS day_name
            FROM meas WHERE day_of_week IS NOT NULL GROUP BY ALL
            UNION ALL SELECT 'hour_of_day', hour_of_day, count(*), NULL FROM meas WHERE hour_of_day IS NOT NULL GROUP BY ALL"""
    ),
    "monthly_call_estimate": _sql(
        f"""SELECT plan_type, calls, events_processed, 0::bigint AS events_skipped, round(calls * 0.007::double, 2) AS estimated_cost,
                   NULL::double AS remaining_credit FROM ({CALLS}) WHERE plan_type IS NOT NULL
            UNION ALL SELECT NULL, sum(calls)::bigint, sum(events_processed)::bigint,
                   coalesce(sum(events_processed) FILTER (plan_type IS NULL), 0)::bigint,
                   round(sum(calls)::double * 0.007::double, 2), round(200 - round(sum(calls)::double * 0.007::double, 2), 2) FROM ({CALLS})""",
        "estimated_cost",
        "remaining_credit",
    ),
    "event_avg_delay_by_venue": _sql(
        """SELECT s.event_id, s.event_name, avg(delay_minutes) AS avg_delay
           FROM sched s JOIN venue v ON v.venue_id = s.venue_id JOIN meas m ON m.venue_id = v.venue_id GROUP BY ALL""",
        "avg_delay",
    ),
    "time_coverage": _sql(
        """SELECT count(*) AS total, count(start_sec) AS with_time, count(expected_attendance) AS with_attendance,
                  count(start_sec) * 100 // count(*) AS with_time_pct, count(expected_attendance) * 100 // count(*) AS with_attendance_pct
           FROM sched"""
    ),
    "daily_usage_forecast": _sql(
        " UNION ALL ".join(
            f"""SELECT collection, completed_calls::bigint AS completed_calls, remaining_calls::bigint AS remaining_calls,
                       total_calls::bigint AS total_calls, round(total_calls * 100.0::double / 2500, 1) AS limit_pct,
                       round(paid * 0.007::double, 2) AS cost, (paid * 30)::bigint AS monthly_calls
                FROM (SELECT coalesce(collection, 'total') AS collection, sum(completed_calls) AS completed_calls,
                             sum(remaining_calls) AS remaining_calls, sum(total_calls) AS total_calls,
                             coalesce(sum(total_calls) FILTER (collection = 'event'), 0) AS paid
                      FROM ({_forecast(now)}) GROUP BY ROLLUP (collection))"""
            for now in ("timestamp '2024-01-24 17:30:00'", NOW)
        ),
        "limit_pct",
        "cost",
    ),
    "map_and_timeline_points": _sql(
        f"""SELECT event_id, event_name, venue_name, category, event_start_date, latitude, longitude, impact_above_baseline AS impact_minutes,
                   greatest(coalesce(impact_above_baseline, 0), 0)::double AS marker_size, impact_level FROM detail WHERE {MONTH}""",
        "latitude",
        "longitude",
        "impact_minutes",
        "marker_size",
    ),
    "before_during_after": _sql(
        """SELECT s.event_id, s.event_name, s.event_start_date, s.category, v.venue_id, v.venue_name, v.latitude, v.longitude,
                  p.avg_delay_before, p.avg_delay_during, p.avg_delay_after, p.measurements, avg_delay_after - avg_delay_before AS impact_minutes
           FROM split p JOIN sched s USING (event_id) JOIN venue v ON v.venue_id = s.venue_id
           WHERE avg_delay_before IS NOT NULL AND avg_delay_after IS NOT NULL""",
        "latitude",
        "longitude",
        "avg_delay_before",
        "avg_delay_during",
        "avg_delay_after",
        "impact_minutes",
    ),
    "impact_bins": _sql(
        """SELECT CASE WHEN i <= 1 THEN 'Low' WHEN i <= 2 THEN 'Moderate' WHEN i <= 5 THEN 'High' ELSE 'Severe' END AS label,
                  count(*) AS event_count FROM (SELECT avg_delay_after - avg_delay_before AS i FROM split) WHERE i IS NOT NULL GROUP BY 1"""
    ),
    "impact_before_during": _sql("SELECT * FROM analysed", *ANALYSED_DOUBLES),
    "venue_groups": _sql(GROUPS),
    "top_impact_events": _sql(
        """SELECT event_id, event_name, venue_name, category, strftime(event_start_date, '%Y-%m-%d') AS event_date,
                  round(impact_above_baseline, 1) AS impact_minutes, impact_level
           FROM detail WHERE impact_above_baseline IS NOT NULL ORDER BY impact_above_baseline DESC, event_id LIMIT 10""",
        "impact_minutes",
    ),
    "recent_events": _sql(f"SELECT {SHORT}, updated_at FROM sched ORDER BY updated_at DESC, event_id LIMIT 10"),
    "recent_measurements": _sql(
        """SELECT * FROM (SELECT venue_id, measurement_id, measurement_time, traffic_level, delay_minutes, avg_speed_mph, distance_miles,
                  row_number() OVER (PARTITION BY venue_id ORDER BY measurement_time DESC, measurement_id DESC)::int AS recency FROM meas)
           WHERE recency <= 5""",
        "avg_speed_mph",
        "distance_miles",
    ),
    "top_categories": _sql(
        """SELECT category, d AS avg_delay_increase, CASE WHEN d > 5 THEN 'HIGH IMPACT - Consider traffic management'
                  WHEN d > 2 THEN 'MODERATE IMPACT - Monitor traffic' WHEN d > 1 THEN 'LOW IMPACT' ELSE 'MINIMAL IMPACT' END AS recommendation,
                  d > 2 AS high_impact
           FROM (SELECT category, coalesce(avg(delay_increase), 0) AS d FROM analysed GROUP BY category)""",
        "avg_delay_increase",
    ),
    "data_quality_check": _sql(
        """SELECT 'Events without times' AS issue, count(*) AS count, 'Events need event_start_time for collection' AS impact
           FROM sched WHERE start_sec IS NULL
           UNION ALL SELECT 'Events without venue', count(*), 'Events need venue_id for geocoding' FROM sched WHERE venue_id IS NULL
           UNION ALL SELECT 'Venues without coordinates', count(*), 'Venues need lat/lng for traffic collection' FROM venue
                     WHERE latitude IS NULL OR longitude IS NULL
           UNION ALL SELECT 'Traffic without event or baseline flag', count(*), 'Measurements should have event_id OR is_baseline=TRUE'
                     FROM linked WHERE event_id IS NULL AND is_baseline = false
           UNION ALL SELECT 'Traffic missing day_of_week', count(*), 'Should be auto-calculated' FROM meas WHERE day_of_week IS NULL
           UNION ALL SELECT 'Traffic missing hour_of_day', count(*), 'Should be auto-calculated' FROM meas WHERE hour_of_day IS NULL
           UNION ALL SELECT 'Baseline without baseline_type', count(*), 'Baseline should have type (weekly/monthly)' FROM meas
                     WHERE is_baseline AND baseline_type IS NULL"""
    ),
    "data_quality_label": _sql("SELECT event_id, data_quality FROM detail"),
    "impact_level": _sql(
        """SELECT event_id, impact_level AS level_detail,
                  CASE WHEN impact_level = 'none' THEN 'low' ELSE impact_level END AS level_summary,
                  CASE WHEN impact_level = 'none' THEN 'no impact' ELSE impact_level END AS level_halves,
                  CASE WHEN impact_above_baseline <= 1 THEN 'Low' WHEN impact_above_baseline <= 2 THEN 'Moderate'
                       WHEN impact_above_baseline <= 5 THEN 'High' WHEN impact_above_baseline > 5 THEN 'Severe' END AS level_bins FROM detail"""
    ),
    "event_impact_summary": _sql(
        """SELECT event_id, event_name, event_start_date, start_sec, category, venue_name, venue_id, event_measurements, baseline_measurements,
                  event_avg_delay, baseline_avg_delay, impact_above_baseline,
                  CASE WHEN impact_level = 'none' THEN 'low' ELSE impact_level END AS impact_level FROM detail WHERE event_measurements > 0""",
        "event_avg_delay",
        "baseline_avg_delay",
        "impact_above_baseline",
    ),
    "key_violations": _sql(
        """SELECT 'events' AS table_name, concat(event_name, ' | ', event_start_date, ' | ', venue_name) AS key_value, count(*) AS row_count
           FROM sched WHERE venue_name IS NOT NULL GROUP BY event_name, event_start_date, venue_name HAVING count(*) > 1
           UNION ALL SELECT 'venue_locations', venue_name, count(*) FROM venue GROUP BY venue_name HAVING count(*) > 1"""
    ),
    "orphan_rows": _sql(
        """SELECT 'events.venue_id' AS reference, venue_id AS missing_id, count(*) AS row_count FROM sched
           WHERE category IS NOT NULL AND venue_id NOT IN (SELECT venue_id FROM venue WHERE latitude IS NOT NULL) GROUP BY 2
           UNION ALL SELECT 'traffic_measurements.event_id', event_id, count(*) FROM linked
           WHERE event_id NOT IN (SELECT event_id FROM sched WHERE category IS NOT NULL) GROUP BY 2
           UNION ALL SELECT 'traffic_measurements.venue_id', venue_id, count(*) FROM meas
           WHERE venue_id NOT IN (SELECT venue_id FROM venue WHERE latitude IS NOT NULL) GROUP BY 2"""
    ),
    "backfill_time_metadata": _sql(
        "SELECT measurement_id, dayofweek(measurement_time)::int AS day_of_week, hour(measurement_time)::int AS hour_of_day FROM meas"
    ),
    "time_metadata_gaps": _sql(
        """SELECT count(*) FILTER (day_of_week IS NULL OR hour_of_day IS NULL) AS missing_before,
                  count(*) FILTER ((day_of_week IS NULL OR hour_of_day IS NULL) AND measurement_time IS NOT NULL) AS repaired,
                  count(*) FILTER (measurement_time IS NULL) AS missing_after FROM meas"""
    ),
    "fill_estimated_defaults": _sql(
        """SELECT event_id, category, coalesce(start_sec, CASE category WHEN 'Sports' THEN 68400 WHEN 'Arts & Culture' THEN 68400
                  WHEN 'General' THEN 64800 END) AS start_sec,
                  coalesce(expected_attendance, CASE category WHEN 'Sports' THEN 5000 WHEN 'Arts & Culture' THEN 500
                  WHEN 'General' THEN 500 END) AS expected_attendance FROM sched"""
    ),
    "baseline_type_backfill": _sql(
        """SELECT measurement_id, is_baseline, CASE WHEN is_baseline THEN 'weekly' END AS baseline_type,
                  CASE WHEN is_baseline THEN dayofweek(measurement_time) ELSE day_of_week END::int AS day_of_week,
                  CASE WHEN is_baseline THEN hour(measurement_time) ELSE hour_of_day END::int AS hour_of_day FROM meas"""
    ),
    "baseline_with_event": _sql(
        """SELECT m.venue_id, count(DISTINCT m.measurement_id) AS row_count
           FROM meas m JOIN timed t ON t.venue_id = m.venue_id
            AND m.measurement_time BETWEEN t.start_ts - INTERVAL 2 HOUR AND t.start_ts + INTERVAL 2 HOUR
           WHERE m.is_baseline GROUP BY 1"""
    ),
    "parse_dates": _sql(DATES),
    "parse_time_range": _sql(TIMES),
    "parse_cost": _sql(COSTS, "cost_min", "cost_max"),
    "clean_phone": _sql(PHONES),
    "clean_email": _sql(EMAILS),
    "extract_category": _sql(CATEGORIES),
    "page_title": "SELECT page_id, CASE WHEN regexp_matches(html, '<h1[^>]*>(?s:.*?)</h1>') THEN trim("
    + UNESCAPE.replace("{x}", "regexp_extract(html, '<h1[^>]*>((?s:.*?))</h1>', 1)")
    + ") END AS title FROM pages",
    "page_fields": _sql(
        f"""SELECT listing_id AS page_id, concat('Show & TellNo. ', listing_id) AS event_name, concat('Hall', listing_id, 'West') AS venue_name,
                   '' AS address, d.start_date AS event_start_date, d.end_date AS event_end_date, t.start_sec, t.end_sec, d.is_multi_day,
                   category, 'The Café <Inc>…' AS sponsor, c.cost_min, c.cost_max, c.cost_description, phone, email,
                   concat('https://t.example.org/', listing_id) AS ticket_url, concat('https://w.example.org/?a=1&b=', listing_id) AS website_url,
                   concat('https://listings.example.org/e/', listing_id) AS source_url
            FROM ({DATES}) d JOIN ({TIMES}) t USING (listing_id) JOIN ({COSTS}) c USING (listing_id)
            JOIN ({PHONES}) USING (listing_id) JOIN ({EMAILS}) USING (listing_id) JOIN ({CATEGORIES}) USING (listing_id)""",
        "cost_min",
        "cost_max",
    ),
    "parse_flow_json": _sql(
        f"""SELECT measurement_id, {_level('d')} AS traffic_level, round(sp, 2) AS avg_speed_mph, 45.0::double AS typical_speed_mph,
                   tt AS travel_time_seconds, ff AS typical_time_seconds, round(d, 2) AS delay_minutes,
                   CASE WHEN mi > 0 THEN round(mi, 2) END AS distance_miles, 0.9::double AS confidence, 'tomtom' AS data_source
            FROM (SELECT *, (tt - ff) / 60.0::double AS d, CASE WHEN i % 4 > 0
                    THEN {_miles('(35 + (i % 10) * 0.01::double)', '-106.5::double', '(35.05::double + (i % 5) * 0.01::double)', '-106.52::double')}
                    ELSE tt / 3600.0::double * sp END AS mi
                  FROM (SELECT measurement_id, measurement_id AS i, CASE WHEN measurement_id % 11 > 0 THEN avg_speed_mph ELSE 0 END AS sp,
                               100 + measurement_id % 400 AS tt, 100 + measurement_id % 150 AS ff FROM meas WHERE measurement_id % 13 > 0))""",
        "avg_speed_mph",
        "typical_speed_mph",
        "delay_minutes",
        "distance_miles",
        "confidence",
    ),
    "parse_route_json": _sql(
        f"""SELECT measurement_id, {_level('d')} AS traffic_level, round(sp, 2) AS avg_speed_mph,
                   round(CASE WHEN nt > 0 THEN mi / nt * 3600 ELSE sp END, 2) AS typical_speed_mph, tt AS travel_time_seconds,
                   nt AS typical_time_seconds, round(d, 2) AS delay_minutes, round(mi, 2) AS distance_miles, 'tomtom' AS data_source
            FROM (SELECT *, CASE WHEN tt > 0 THEN mi / tt * 3600 ELSE 0 END AS sp, (tt - nt) / 60.0::double AS d
                  FROM (SELECT *, CASE WHEN i % 6 > 0 THEN 60 + i % 200 ELSE tt END AS nt
                        FROM (SELECT measurement_id, measurement_id AS i, (1000 + measurement_id % 5000)::double * 0.000621371::double AS mi,
                                     CASE WHEN measurement_id % 9 > 0 THEN 60 + measurement_id % 400 ELSE 0 END AS tt
                              FROM meas WHERE measurement_id % 10 > 0)))""",
        "avg_speed_mph",
        "typical_speed_mph",
        "delay_minutes",
        "distance_miles",
    ),
    "parse_matrix_json": _sql(
        f"""SELECT measurement_id, {_matrix_level('d')} AS traffic_level, round(mi / tt * 3600, 2) AS avg_speed_mph,
                   round(mi / ty * 3600, 2) AS typical_speed_mph, tt AS travel_time_seconds, ty AS typical_time_seconds,
                   d AS delay_minutes, round(mi, 2) AS distance_miles, 'google_maps' AS data_source
            FROM (SELECT *, round((tt - ty) / 60.0::double, 1) AS d
                  FROM (SELECT measurement_id, (800 + measurement_id % 7000)::double / 1609.34::double AS mi, 90 + measurement_id % 300 AS ty,
                               CASE WHEN measurement_id % 5 > 0 THEN 80 + measurement_id % 500 ELSE 90 + measurement_id % 300 END AS tt
                        FROM meas WHERE measurement_id % 8 > 0 AND measurement_id % 12 > 0))""",
        "avg_speed_mph",
        "typical_speed_mph",
        "delay_minutes",
        "distance_miles",
    ),
    "parse_geocode_json": _sql(
        """SELECT venue_id, latitude, longitude, address AS formatted_address, place_id FROM venue WHERE latitude IS NOT NULL""",
        "latitude",
        "longitude",
    ),
    "traffic_level": _sql(
        f"""SELECT measurement_id, {_level('d')} AS level_flow, {_matrix_level('d')} AS level_matrix, {_level('d', 1)} AS level_pattern
            FROM (SELECT measurement_id, delay_minutes / 2.0 AS d FROM meas)"""
    ),
    "haversine_miles": _sql(
        f"""SELECT venue_id, round(m, 2) AS miles_asin, round(m, 2) AS miles_atan2
            FROM (SELECT venue_id, {_miles('latitude', 'longitude', '35.0781::double', '-106.6044::double')} AS m FROM venue)""",
        "miles_asin",
        "miles_atan2",
    ),
    "sample_points": _sql(
        """SELECT venue_id, n, i AS point_index, CASE n WHEN 4 THEN ['North', 'East', 'South', 'West'][i + 1]
                  ELSE ['North', 'NE', 'East', 'SE', 'South', 'SW', 'West', 'NW'][i + 1] END AS direction,
                  latitude + r / 69.0 * cos(2 * pi() * i / n) AS lat,
                  longitude + r / 69.0 * sin(2 * pi() * i / n) / cos(radians(latitude)) AS lng
           FROM (SELECT *, 4 AS n, 1.0::double AS r, unnest([0, 1, 2, 3]) AS i FROM venue
                 UNION ALL SELECT *, 8, 0.5, unnest([0, 1, 2, 3, 4, 5, 6, 7]) FROM venue)""",
        "lat",
        "lng",
    ),
    "speed_impact": _sql(
        f"""SELECT *, CASE WHEN speed_impact_minutes IS NULL THEN 'unknown' WHEN speed_impact_minutes > 5 THEN 'severe'
                    WHEN speed_impact_minutes > 2 THEN 'high' WHEN speed_impact_minutes > 1 THEN 'moderate' ELSE 'low' END AS impact_level
            FROM (SELECT event_id, event_measurements, event_avg_distance, event_avg_speed, baseline_tier, baseline_delay, baseline_speed,
                         (event_avg_distance / nullif(event_avg_speed, 0) - event_avg_distance / nullif(baseline_speed, 0)) * 60 AS speed_impact_minutes
                  FROM impact LEFT JOIN ({TIERS.replace('t.event_id, t.venue_id,', 't.event_id,')}) USING (event_id) WHERE event_measurements > 0)""",
        "event_avg_distance",
        "event_avg_speed",
        "baseline_delay",
        "baseline_speed",
        "speed_impact_minutes",
    ),
    "hours_from_event": _sql(
        """SELECT event_id, (epoch_us(event_start_date::timestamp + INTERVAL 12 HOUR) - epoch_us(start_ts)) / 3.6e9 AS hours_from_event FROM timed""",
        "hours_from_event",
    ),
    "dow_hour": _sql(
        f"""SELECT measurement_id, dayofweek(measurement_time)::int AS dow, hour(measurement_time)::int AS hour,
                   {_day_name('dayofweek(measurement_time)')} AS day_name FROM meas"""
    ),
    "event_start_ts": _sql("SELECT event_id, event_start_date::timestamp + to_seconds(start_sec) AS event_start_ts FROM sched"),
    "collection_plan": _sql(PLAN),
    "baseline_week_group": _sql(
        """SELECT measurement_id, CASE WHEN d <= 7 THEN 1 WHEN d <= 14 THEN 2 WHEN d <= 21 THEN 3 ELSE 4 END AS week_group,
                  CASE WHEN d BETWEEN 8 AND 14 THEN 1 WHEN d BETWEEN 22 AND 30 THEN 2 END AS two_group
           FROM (SELECT measurement_id, day(measurement_time) AS d FROM meas)"""
    ),
    "baseline_slot": _sql(
        f"""SELECT measurement_id, {SLOT_LABEL} AS time_slot
            FROM (SELECT measurement_id, list_filter({SLOTS}, lambda s: abs(hour(measurement_time) * 60 + minute(measurement_time) - s) <= 15)[1] AS slot
                  FROM meas)""".replace(SLOT_LABEL, f"CASE WHEN slot IS NOT NULL THEN {SLOT_LABEL} END")
    ),
    "baseline_plan": _sql(DAY_PLAN),
    "event_collection_point": _sql(
        f"""SELECT event_id, event_name, -diff AS minutes_from_start, (-p)::int AS collection_point,
                   CASE WHEN -p < -15 THEN 'before' WHEN -p > 15 THEN 'after' ELSE 'during' END AS window
            FROM (SELECT *, list_filter([-120, -90, -60, -30, 0, 30, 60, 90, 120], lambda t: abs(diff - t) <= 15)[1] AS p
                  FROM (SELECT *, (epoch_us(start_ts) - epoch_us({NOW})) / 6e7 AS diff FROM timed)) WHERE p IS NOT NULL""",
        "minutes_from_start",
    ),
    "planned_points": _sql(
        f"""SELECT event_id, venue_id, start_ts AS event_datetime, o AS offset_minutes, p AS planned_time,
                   CASE WHEN o < -15 THEN 'before' WHEN o > 15 THEN 'after' ELSE 'during' END AS window,
                   CASE WHEN p >= {NOW} THEN 'upcoming' WHEN p > {NOW} - INTERVAL 30 MINUTE THEN 'now' ELSE 'completed' END AS status
            FROM (SELECT *, start_ts + to_minutes(o) AS p
                  FROM (SELECT *, unnest([-120, -90, -60, -30, 0, 30, 60, 90, 120]) AS o FROM timed))"""
    ),
    "slot_coverage": _sql(
        f"""SELECT p.venue_id, venue_group, plan_date, time_slot, count(measurement_id) AS measurements, count(measurement_id) = 0 AS missed
            FROM ({DAY_PLAN}) p LEFT JOIN meas m ON m.venue_id = p.venue_id AND is_baseline AND measurement_time::date = {TODAY}
             AND abs(hour(measurement_time) * 60 + minute(measurement_time) - slot) <= 15 GROUP BY ALL"""
    ),
    "budget_cap": _sql(
        f"""SELECT event_id, event_start_date, start_sec, estimated_calls, c::bigint AS calls_so_far
            FROM (SELECT *, sum(estimated_calls) OVER (ORDER BY event_start_date, start_sec, event_id ROWS UNBOUNDED PRECEDING) AS c
                  FROM ({PLAN}) WHERE estimated_calls > 0) WHERE c - estimated_calls < 1000"""
    ),
    "category_pattern": _sql(
        """SELECT event_id, category, CASE WHEN category LIKE '%Sports%' THEN 'Sports' WHEN category LIKE '%Music%' THEN 'Music'
                  WHEN category LIKE '%Arts & Culture%' THEN 'Arts & Culture' ELSE 'General' END AS pattern FROM sched"""
    ),
    "stream_measurements": _sql(
        f"""SELECT measurement_id, measurement_time, {_level('d')} AS traffic_level, avg_speed_mph,
                   round(round(d, 2))::int AS delay_minutes, CASE WHEN mi > 0 THEN round(mi, 2) END AS distance_miles,
                   CASE WHEN is_baseline THEN baseline_type END AS baseline_type, coalesce(is_baseline, false) AS is_baseline,
                   dayofweek(measurement_time)::int AS day_of_week, hour(measurement_time)::int AS hour_of_day,
                   measurement_time::date AS measurement_date
            FROM (SELECT *, (i % 400 - i % 150) / 60.0::double AS d, (100 + i % 400) / 3600.0::double * avg_speed_mph AS mi
                  FROM (SELECT *, measurement_id AS i FROM meas WHERE measurement_id % 13 > 0))""",
        "avg_speed_mph",
        "distance_miles",
    ),
    "stream_hourly_activity": _sql(
        HOURLY.format(
            ev="CASE WHEN false THEN 1 END",
            distinct="count(DISTINCT venue_id) AS venues_measured, 0::bigint AS events_measured,",
            table="meas",
        ),
        "avg_delay",
    ),
}
ORACLES["report_tables"] = ORACLES["category_traffic_impact"]
ORACLES["stream_link_events"] = ORACLES["nearest_event_link"]
ORACLES["stream_upsert_events"] = ORACLES["upsert_events"]
