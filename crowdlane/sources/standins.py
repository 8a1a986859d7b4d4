"""Stand-in base tables derived from the driver's star-schema tables.

The driver has no venues or traffic, so its orders become event listings, its
customers venues and its event stream traffic measurements. The expressions are
deterministic and row-local. ``AS_OF`` is the "now" of every report run on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-01-15 12:00:00"
AS_OF_YEAR = 2026

# DOW(x) is dayofweek(x) in DuckDB and dayofweek(x) - 1 in Spark; both read 0 = Sunday.
VENUE = """
SELECT c_custkey AS venue_id, c_name AS venue_name,
       concat(cast(c_custkey AS string), ' Main St') AS address,
       'Albuquerque' AS city, 'NM' AS state,
       CASE WHEN c_custkey % 40 = 7 THEN NULL ELSE 35.0844e0 + ((c_custkey % 41) - 20) * 0.005e0 END AS latitude,
       -106.6504e0 + ((c_custkey % 37) - 18) * 0.005e0 AS longitude,
       CASE WHEN c_custkey % 9 > 0 THEN concat('place-', cast(c_custkey AS string)) END AS place_id
FROM {customer}
"""

SCHED = """
SELECT *, CASE WHEN venue_id IS NOT NULL
               THEN concat('Customer#', lpad(cast(venue_id AS string), 9, '0')) END AS venue_name,
       CASE WHEN cost_min = 0 THEN 'Free' WHEN cost_min IS NOT NULL THEN 'Ticketed' END AS cost_description
FROM (
  SELECT o_orderkey AS event_id, concat('Event ', cast(o_orderkey % 600 AS string)) AS event_name,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL
              ELSE o_custkey % (SELECT max(user_id) + 1 FROM {events}) END AS venue_id,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Sports' WHEN '2-HIGH' THEN 'Concerts & Music'
              WHEN '3-MEDIUM' THEN 'Arts & Culture' WHEN '5-LOW' THEN 'General' END AS category,
         date '2024-01-01' + cast(o_orderkey % 30 AS int) AS event_start_date,
         date '2024-01-01' + cast(o_orderkey % 30 + CASE WHEN o_orderkey % 8 = 0 THEN 1 + o_orderkey % 3 ELSE 0 END AS int) AS event_end_date,
         CASE WHEN o_orderkey % 10 = 3 THEN NULL
              ELSE cast(((o_orderkey * 7) % 24) * 3600 + (o_orderkey % 2) * 1800 AS int) END AS start_sec,
         CASE WHEN o_orderkey % 10 <> 3 AND o_orderkey % 4 = 1
              THEN cast(((o_orderkey * 7) % 24) * 3600 + 5400 AS int) END AS end_sec,
         o_orderkey % 8 = 0 AS is_multi_day,
         CASE WHEN o_orderkey % 6 = 0 THEN 0e0 WHEN o_orderkey % 6 < 4 THEN o_totalprice / 2 END AS cost_min,
         CASE WHEN o_orderkey % 6 = 0 THEN 0e0 WHEN o_orderkey % 6 < 4 THEN o_totalprice END AS cost_max,
         CASE WHEN o_orderkey % 3 = 0 THEN concat('Sponsor ', cast(o_orderkey % 50 AS string)) END AS sponsor,
         CASE WHEN o_orderkey % 4 = 0 THEN cast(o_orderkey % 5000 AS int) END AS expected_attendance,
         o_orderdate AS created_at, o_orderdate AS updated_at
  FROM {orders}) AS o
"""

LISTING = """
SELECT o_orderkey AS listing_id,
       CASE o_orderkey % 5
            WHEN 0 THEN concat('February ', cast(1 + o_orderkey % 27 AS string), ', 2026, March ', cast(1 + o_orderkey % 28 AS string), ', 2026')
            WHEN 1 THEN concat('Feb ', cast(1 + o_orderkey % 27 AS string), ' - Mar ', cast(1 + o_orderkey % 28 AS string))
            WHEN 2 THEN concat('March ', cast(1 + o_orderkey % 28 AS string))
            WHEN 3 THEN concat('Jan ', cast(1 + o_orderkey % 31 AS string), ', 2026')
            ELSE 'Ongoing' END AS dates_text,
       CASE o_orderkey % 4
            WHEN 0 THEN concat(cast(1 + o_orderkey % 12 AS string), ':30 PM to ', cast(1 + o_orderkey % 11 AS string), ' pm')
            WHEN 1 THEN concat(cast(1 + o_orderkey % 12 AS string), ' AM') WHEN 2 THEN '' ELSE 'All day' END AS time_text,
       CASE o_orderkey % 5
            WHEN 0 THEN 'Free admission' WHEN 1 THEN concat('$', cast(o_orderkey % 90 AS string), ' to $', cast(100 + o_orderkey % 90 AS string), '.50')
            WHEN 2 THEN '$1,000 table' WHEN 3 THEN 'TBD' ELSE NULL END AS price_text,
       CASE WHEN o_orderkey % 3 = 0 THEN 'ext. 12' ELSE concat('+1 (505) 555-', lpad(cast(o_orderkey % 10000 AS string), 4, '0')) END AS phone_text,
       CASE WHEN o_orderkey % 3 = 1 THEN 'see site' ELSE concat('Mail: box', cast(o_orderkey % 100 AS string), '@venue.example.org now') END AS email_text,
       CASE WHEN o_orderkey % 7 = 0 THEN '{{}}' ELSE '{{"crmCatSubcat": "Arts%20%26%20Culture"}}' END AS gtm_vars
FROM {orders}
"""

MEAS = """
SELECT event_id AS measurement_id, user_id AS venue_id, ts AS measurement_time,
       CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN NULL
            ELSE event_type IN ('view', 'click', 'purchase') END AS is_baseline,
       CASE WHEN event_type IN ('view', 'click', 'purchase') AND event_id % 20 <> 1 THEN 'weekly' END AS baseline_type,
       CASE WHEN event_id % 5 = 0 THEN 'google_maps' ELSE 'tomtom' END AS data_source,
       CASE WHEN event_id % 30 = 2 THEN NULL ELSE cast(floor(value / 20 - 1.5e0) AS int) END AS delay_minutes,
       10 + cast(cast(floor(value * 100) AS bigint) % 3000 AS double) / 100 AS avg_speed_mph,
       45e0 AS typical_speed_mph,
       1 + (event_id % 7) * 0.25e0 AS distance_miles,
       CASE WHEN event_id % 30 = 2 THEN NULL WHEN value < 40 THEN 'light' WHEN value < 70 THEN 'moderate'
            WHEN value < 130 THEN 'heavy' ELSE 'severe' END AS traffic_level,
       CASE WHEN event_id % 25 = 0 THEN NULL ELSE cast(DOW(ts) AS int) END AS day_of_week,
       CASE WHEN event_id % 25 = 0 THEN NULL ELSE cast(hour(ts) AS int) END AS hour_of_day
FROM {events}
"""


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def venue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(VENUE, customer=_read(spark, sf_dir, "customer"))


def sched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SCHED, orders=_read(spark, sf_dir, "orders"), events=_read(spark, sf_dir, "events"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LISTING, orders=_read(spark, sf_dir, "orders"))


def meas(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = MEAS.replace("DOW(ts)", "dayofweek(ts) - 1")
    return meas_from(spark, _read(spark, sf_dir, "events"), text)


def meas_from(spark: SparkSession, events: DataFrame, text: str | None = None) -> DataFrame:
    """Measurements not yet linked to an event."""
    text = text or MEAS.replace("DOW(ts)", "dayofweek(ts) - 1")
    return spark.sql(text, events=events).selectExpr("*", "cast(NULL AS bigint) AS event_id")
