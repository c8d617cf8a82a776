"""ANSI SQL for DuckDB that computes what each registered query returns."""

from __future__ import annotations

from tripmill.plans.suites import WITH_FRESHNESS

# ---------------------------------------------------------------- shared tables

TRIPS = """
lake AS (
  SELECT
    CAST(l_suppkey % 2 + 1 AS INTEGER) AS vendorid,
    CASE l_returnflag WHEN 'A' THEN 'yellow' WHEN 'N' THEN 'green' ELSE 'fhv' END AS cab_type,
    o_orderdate + to_minutes(CAST(l_orderkey % 1440 AS INTEGER)) AS pickup_datetime,
    o_orderdate + to_minutes(CAST(l_orderkey % 1440 + l_partkey % 97 - 2 AS INTEGER))
      + to_seconds(CAST(l_suppkey % 60 AS INTEGER)) AS dropoff_datetime,
    CASE WHEN l_linestatus = 'O' THEN ' N ' ELSE 'Y' END AS store_and_fwd_flag,
    CAST(l_linenumber % 6 + 1 AS BIGINT) AS ratecodeid,
    CAST(c_nationkey * 6 AS INTEGER) AS pulocationid,
    CAST(s_nationkey * 6 AS INTEGER) AS dolocationid,
    CASE WHEN l_linenumber = 5 AND l_linestatus = 'F' THEN NULL
         ELSE CAST(l_linenumber AS BIGINT) END AS passenger_count,
    l_quantity - 1 AS trip_distance,
    l_extendedprice - 2000 AS fare_amount,
    CAST(0.5 AS DOUBLE) AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    l_extendedprice * abs(l_discount) AS tip_amount,
    CAST(0.0 AS DOUBLE) AS tolls_amount,
    CAST(NULL AS DOUBLE) AS ehail_fee,
    CAST(0.3 AS DOUBLE) AS improvement_surcharge,
    l_extendedprice * (1 + abs(l_tax)) - 1000 AS total_amount,
    CAST(l_partkey % 4 + 1 AS BIGINT) AS payment_type,
    CAST(NULL AS BIGINT) AS trip_type,
    CAST(NULL AS DOUBLE) AS congestion_surcharge,
    CAST(NULL AS DOUBLE) AS airport_fee,
    TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(l_partkey % 3 AS INTEGER)) AS ingestion_ts,
    'batch_' || CAST(l_partkey % 3 AS VARCHAR) AS batch_id,
    'lineitem' AS source_file,
    'first_load' AS migration_batch_id,
    'spark' AS engine_type
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

STAGED = """
stg AS (
  SELECT vendorid AS vendor_id, lower(trim(cab_type)) AS cab_type,
    pickup_datetime, dropoff_datetime,
    lower(trim(store_and_fwd_flag)) AS store_and_fwd_flag,
    CAST(ratecodeid AS INTEGER) AS rate_code_id,
    pulocationid AS pickup_location_id, dolocationid AS dropoff_location_id,
    CAST(passenger_count AS INTEGER) AS passenger_count, trip_distance,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, ehail_fee,
    improvement_surcharge, total_amount, congestion_surcharge, airport_fee,
    CAST(payment_type AS INTEGER) AS payment_type, CAST(trip_type AS INTEGER) AS trip_type,
    ingestion_ts, batch_id, source_file, migration_batch_id, engine_type
  FROM lake
)"""

ZONES = """
zones AS (
  SELECT CAST(n_nationkey * 6 AS INTEGER) AS location_id,
    lower(trim(' ' || r_name)) AS borough, lower(trim(n_name)) AS zone,
    lower(CASE n_nationkey % 3 WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN 'Boro Zone'
          ELSE 'Airports' END) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

CLEAN_RULE = """total_amount > 0 AND trip_distance > 0 AND pickup_datetime < dropoff_datetime
    AND passenger_count BETWEEN 1 AND 6 AND fare_amount >= 0"""

BROKEN_RULE = """total_amount <= 0 OR trip_distance <= 0 OR pickup_datetime >= dropoff_datetime
    OR passenger_count NOT BETWEEN 1 AND 6"""

TRIP_KEY = "vendor_id, cab_type, pickup_datetime, pickup_location_id, dropoff_location_id"

TRIP_ID = "md5(concat_ws('-', " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')"
    for c in TRIP_KEY.split(", ")
) + "))"

# every column that may differ between two submissions of one trip
LATEST = ", ".join(
    f"{c} DESC NULLS LAST"
    for c in (
        "dropoff_datetime ingestion_ts store_and_fwd_flag rate_code_id passenger_count "
        "trip_distance fare_amount extra mta_tax tip_amount tolls_amount ehail_fee "
        "improvement_surcharge total_amount congestion_surcharge airport_fee payment_type "
        "trip_type batch_id source_file migration_batch_id engine_type"
    ).split()
)

KEYED = f"""
keyed AS (SELECT *, {TRIP_ID} AS trip_id FROM stg)"""

CORE_SELECT = """
  SELECT trip_id, vendor_id, cab_type, pickup_datetime, dropoff_datetime,
    date_diff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes,
    store_and_fwd_flag, rate_code_id,
    pickup_location_id, p.zone AS pickup_zone, p.borough AS pickup_borough,
    dropoff_location_id, d.zone AS dropoff_zone, d.borough AS dropoff_borough,
    passenger_count, trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    ehail_fee, improvement_surcharge, total_amount, congestion_surcharge, airport_fee,
    payment_type, trip_type, ingestion_ts, batch_id, source_file, migration_batch_id, engine_type
  FROM kept
  LEFT JOIN zones p ON pickup_location_id = p.location_id
  LEFT JOIN zones d ON dropoff_location_id = d.location_id"""

KEPT = f"""
kept AS (
  SELECT * FROM keyed WHERE {CLEAN_RULE}
  QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY {LATEST}) = 1
)"""

# the last arrival batch wins; within a batch the latest submission
KEPT_IN_BATCHES = f"""
kept AS (
  SELECT * FROM keyed WHERE {CLEAN_RULE}
  QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY ingestion_ts DESC, {LATEST}) = 1
)"""

CORE = f"""
core AS ({CORE_SELECT}
)"""

FACT_SELECT = """
  SELECT trip_id, vendor_id, cab_type, pickup_datetime, dropoff_datetime,
    CAST(pickup_datetime AS DATE) AS pickup_date_key,
    CAST(dropoff_datetime AS DATE) AS dropoff_date_key,
    trip_duration_minutes, pickup_location_id, dropoff_location_id,
    pickup_zone, pickup_borough, dropoff_zone, dropoff_borough,
    store_and_fwd_flag, rate_code_id, passenger_count, trip_distance, payment_type, trip_type,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, ehail_fee, improvement_surcharge,
    congestion_surcharge, airport_fee, total_amount,
    round(tip_amount / nullif(fare_amount, 0) * 100, 2) AS tip_pct,
    CASE WHEN hour(pickup_datetime) BETWEEN 6 AND 9 THEN 'morning'
         WHEN hour(pickup_datetime) BETWEEN 10 AND 15 THEN 'afternoon'
         WHEN hour(pickup_datetime) BETWEEN 16 AND 19 THEN 'evening'
         WHEN hour(pickup_datetime) BETWEEN 20 AND 23 THEN 'night'
         ELSE 'late_night' END AS time_of_day,
    (pickup_location_id IN (1, 132, 138) OR dropoff_location_id IN (1, 132, 138))
      AS is_airport_trip,
    ingestion_ts
  FROM core"""

FACT = f"""
fact AS ({FACT_SELECT}
)"""

MONTH = "CAST(date_trunc('month', pickup_datetime) AS DATE) AS pickup_month"

VENDORS = """
vendors AS (
  SELECT CAST(s_suppkey AS INTEGER) AS vendor_id, trim(' ' || s_name || ' ') AS vendor_name,
    lower(trim(CASE s_suppkey % 3 WHEN 0 THEN 'Active ' WHEN 1 THEN 'suspended'
               ELSE 'inactive' END)) AS status
  FROM supplier
),
later_vendors AS (
  SELECT vendor_id, vendor_name, CASE WHEN vendor_id % 10 = 0 THEN 'closed' ELSE status END
    AS status
  FROM vendors WHERE vendor_id % 7 <> 3
  UNION ALL
  SELECT vendor_id + 10000000, vendor_name, 'active' FROM vendors WHERE vendor_id % 9 = 0
)"""


def _version(alias: str, start: str, end: str) -> str:
    return f"""
  SELECT {alias}.vendor_id, {alias}.vendor_name, {alias}.status,
    md5(concat_ws('|', CAST({alias}.vendor_id AS VARCHAR), '{start}')) AS dbt_scd_id,
    TIMESTAMP '{start}' AS dbt_valid_from, {end} AS dbt_valid_to,
    TIMESTAMP '{start}' AS dbt_updated_at"""


FIRST, SECOND = "2024-01-01 00:00:00", "2024-06-01 00:00:00"

HISTORY = f"""
history AS ({_version('o', FIRST,
    f"CASE WHEN n.vendor_id IS NOT NULL AND (n.vendor_name, n.status) <> (o.vendor_name, o.status)"
    f" THEN TIMESTAMP '{SECOND}' END")}
  FROM vendors o LEFT JOIN later_vendors n ON n.vendor_id = o.vendor_id
  UNION ALL {_version('n', SECOND, 'CAST(NULL AS TIMESTAMP)')}
  FROM later_vendors n LEFT JOIN vendors o ON n.vendor_id = o.vendor_id
  WHERE o.vendor_id IS NULL OR (n.vendor_name, n.status) <> (o.vendor_name, o.status)
)"""

DAYS = """
trip_days AS (SELECT DISTINCT cab_type, CAST(pickup_datetime AS DATE) AS day FROM lake),
ledger AS (
  SELECT cab_type || '#' || strftime(day, '%Y_%m_%d') AS slice_id,
    CASE WHEN dayofyear(day) % 3 = 0 THEN 'batch_b' ELSE 'batch_a' END AS batch_id,
    CASE WHEN dayofyear(day) % 3 = 0 THEN 'LANDED' ELSE 'FAILED' END AS status,
    'spark' AS engine,
    CASE WHEN dayofyear(day) % 3 = 0 THEN TIMESTAMP '2024-02-02 00:00:00'
         ELSE TIMESTAMP '2024-02-01 00:00:00' END AS landed_at
  FROM trip_days WHERE dayofyear(day) % 3 <= 1
),
years AS (SELECT DISTINCT cab_type, CAST(year(day) AS INTEGER) AS y FROM trip_days),
requested AS (
  SELECT cab_type || '#' || strftime(day, '%Y_%m_%d') AS slice_id, cab_type, day
  FROM (SELECT cab_type,
          CAST(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY))
               AS DATE) AS day
        FROM years)
),
january AS (SELECT * FROM requested WHERE month(day) = 1)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_STG = _with(TRIPS, STAGED)
_STG_ZONES = _with(TRIPS, STAGED, ZONES)
_CORE = _with(TRIPS, STAGED, ZONES, KEYED, KEPT, CORE)
_FACT = _with(TRIPS, STAGED, ZONES, KEYED, KEPT, CORE, FACT)
_DAYS = _with(TRIPS, DAYS)
_HISTORY = _with(VENDORS, HISTORY)

REASONS = {
    "NON_POSITIVE_FARE": "total_amount <= 0",
    "NON_POSITIVE_DISTANCE": "trip_distance <= 0",
    "INVALID_DATETIME_ORDER": "pickup_datetime >= dropoff_datetime",
    "INVALID_PASSENGER_COUNT": "passenger_count NOT BETWEEN 1 AND 6",
}
MORE_REASONS = {
    "NEGATIVE_FARE": "fare_amount < 0",
    **{
        f"NULL_{c.upper()}": f"{c} IS NULL"
        for c in (
            "total_amount",
            "trip_distance",
            "pickup_datetime",
            "dropoff_datetime",
            "passenger_count",
            "fare_amount",
        )
    },
}


def _reason_text(reasons: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {rule} THEN '{code}' END" for code, rule in reasons.items())
    return f"concat_ws(',', {cases}) AS dq_failure_reasons"


QUARANTINED = f"SELECT *, {_reason_text(REASONS)} FROM stg WHERE {BROKEN_RULE}"

EXPLODED = " UNION ALL ".join(
    f"SELECT vendor_id, cab_type, pickup_datetime, dropoff_datetime, total_amount, ingestion_ts,"
    f" CAST(ingestion_ts AS DATE) AS load_date, '{code}' AS failure_reason"
    f" FROM stg WHERE {rule}"
    for code, rule in REASONS.items()
)

ORACLES: dict[str, str] = {}

# ---------------------------------------------------------------- staging

ORACLES["stg_trips"] = f"{_STG} SELECT * FROM stg"
ORACLES["stg_zones"] = f"{_with(ZONES)} SELECT * FROM zones"
ORACLES["stg_vendors"] = f"{_with(VENDORS)} SELECT * FROM vendors"
ORACLES["align_schema"] = f"""{_with(TRIPS)}
SELECT * REPLACE (TIMESTAMP '2024-03-01 00:00:00' AS ingestion_ts, 'b1' AS batch_id,
  'slices/all/' AS source_file, 'm1' AS migration_batch_id, 'SPARK' AS engine_type)
FROM lake"""
ORACLES["cast_failures"] = f"""{_with(TRIPS)}
SELECT CAST(0 AS BIGINT) AS vendorid,
  count(*) FILTER (WHERE try_cast(store_and_fwd_flag AS BIGINT) IS NULL) AS ratecodeid,
  CAST(0 AS BIGINT) AS total_amount
FROM lake"""
ORACLES["seed_roundtrip"] = ORACLES["stg_vendors"]
ORACLES["staged_view"] = f"""{_STG}
SELECT cab_type, payment_type, count(*) AS trip_count FROM stg WHERE total_amount > 0
GROUP BY cab_type, payment_type"""

# ---------------------------------------------------------------- quality

ORACLES["quality_filter_trips"] = f"{_STG} SELECT * FROM stg WHERE {CLEAN_RULE}"
ORACLES["quarantine_trips"] = f"{_STG} {QUARANTINED}"
ORACLES["quarantine_complete"] = f"""{_STG}
SELECT *, {_reason_text(REASONS | MORE_REASONS)} FROM stg WHERE ({CLEAN_RULE}) IS NOT TRUE"""
ORACLES["dq_reasons"] = f"{_STG} {EXPLODED}"
ORACLES["dq_summary"] = f"""{_STG}
SELECT load_date, failure_reason, count(*) AS trip_count,
  round(sum(total_amount), 2) AS total_amount_flagged,
  min(pickup_datetime) AS first_seen_issue_at, max(pickup_datetime) AS last_seen_issue_at
FROM ({EXPLODED}) GROUP BY load_date, failure_reason
ORDER BY load_date DESC, failure_reason"""

# ---------------------------------------------------------------- core, fact, dimensions

ORACLES["zone_names"] = f"""{_STG_ZONES}
SELECT {TRIP_KEY}, dropoff_datetime, total_amount,
  p.zone AS pickup_zone, p.borough AS pickup_borough,
  d.zone AS dropoff_zone, d.borough AS dropoff_borough
FROM stg
LEFT JOIN (SELECT * FROM zones WHERE location_id <> 132) p ON pickup_location_id = p.location_id
LEFT JOIN (SELECT * FROM zones WHERE location_id <> 132) d ON dropoff_location_id = d.location_id"""
ORACLES["latest_submission"] = f"""{_with(TRIPS, STAGED, KEYED)}
SELECT * FROM keyed
QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY {LATEST}) = 1"""
ORACLES["core"] = f"{_CORE} SELECT * FROM core"
ORACLES["fact"] = f"{_FACT} SELECT * FROM fact"
ORACLES["dim_date_of_trips"] = f"""{_with(TRIPS)},
bounds AS (SELECT CAST(min(pickup_datetime) AS DATE) AS a, CAST(max(pickup_datetime) AS DATE) AS b
           FROM lake),
spine AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date_key
          FROM bounds)
SELECT date_key, CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month,
  CAST(day(date_key) AS INTEGER) AS day_of_month, strftime(date_key, '%Y-%m-%d') AS date_str,
  strftime(date_key, '%a') AS day_name, CAST(dayofweek(date_key) AS INTEGER) AS day_of_week,
  CAST(week(date_key) AS INTEGER) AS week_of_year, CAST(quarter(date_key) AS INTEGER) AS quarter
FROM spine ORDER BY date_key"""
ORACLES["dim_taxi_zone"] = (
    f"{_with(ZONES)} SELECT location_id, borough, zone, service_zone FROM zones"
)
ORACLES["materialized_zone"] = ORACLES["dim_taxi_zone"]
ORACLES["duplicate_submissions"] = f"""{_STG},
groups AS (
  SELECT {TRIP_KEY}, count(*) AS submission_count,
    min(dropoff_datetime) AS earliest_dropoff, max(dropoff_datetime) AS latest_dropoff,
    min(total_amount) AS min_fare, max(total_amount) AS max_fare,
    min(trip_distance) AS min_distance, max(trip_distance) AS max_distance,
    min(ingestion_ts) AS first_seen, max(ingestion_ts) AS last_seen
  FROM stg GROUP BY {TRIP_KEY} HAVING count(*) > 1
)
SELECT stg.*, g.* EXCLUDE ({TRIP_KEY}),
  max_fare - min_fare AS fare_variance, max_distance - min_distance AS distance_variance,
  date_diff('minute', earliest_dropoff, latest_dropoff) AS dropoff_variance_minutes
FROM stg JOIN groups g ON {" AND ".join(f"stg.{c} = g.{c}" for c in TRIP_KEY.split(", "))}"""

# ---------------------------------------------------------------- slices, profiles

ORACLES["slice_one_year"] = f"""{_with(TRIPS)}
SELECT * FROM lake WHERE year(pickup_datetime) = 1997 AND cab_type IN ('yellow', 'green')"""
ORACLES["slice_one_day"] = f"""{_with(TRIPS)}
SELECT * FROM lake WHERE CAST(pickup_datetime AS DATE) = DATE '1998-06-15'"""
ORACLES["arrived_since"] = f"""{_STG}
SELECT * FROM stg WHERE ingestion_ts > (
  SELECT coalesce(max(ingestion_ts), TIMESTAMP '0001-01-01 00:00:00') FROM stg
  WHERE ingestion_ts < TIMESTAMP '2024-01-03 00:00:00' AND {CLEAN_RULE})"""
ORACLES["top_zones"] = f"""{_with(TRIPS)}
SELECT pulocationid, count(*) AS row_count FROM lake GROUP BY pulocationid
ORDER BY row_count DESC, pulocationid LIMIT 20"""
ORACLES["top_trips"] = f"""{_with(TRIPS)}
SELECT vendorid, pulocationid, total_amount, pickup_datetime FROM lake
ORDER BY total_amount DESC, vendorid, pulocationid, pickup_datetime LIMIT 10"""
ORACLES["sample_trip"] = f"""{_STG}
SELECT {TRIP_KEY}, dropoff_datetime, ingestion_ts, total_amount FROM stg
ORDER BY {TRIP_KEY}, dropoff_datetime, ingestion_ts, total_amount LIMIT 1"""
ORACLES["lineage_nulls"] = f"""{_STG}
SELECT count(*) FILTER (WHERE ingestion_ts IS NULL) AS ingestion_ts_nulls,
  count(*) FILTER (WHERE batch_id IS NULL) AS batch_id_nulls,
  count(*) FILTER (WHERE passenger_count IS NULL) AS passenger_count_nulls,
  count(*) FILTER (WHERE airport_fee IS NULL) AS airport_fee_nulls
FROM stg"""
ORACLES["load_profile_by_cab"] = f"""{_with(TRIPS)}
SELECT cab_type, count(*) AS record_count, min(pickup_datetime) AS earliest_trip,
  max(pickup_datetime) AS latest_trip, max(ingestion_ts) AS last_ingested
FROM lake GROUP BY cab_type ORDER BY cab_type"""

# ---------------------------------------------------------------- landing

ORACLES["read_slice_year"] = f"""{_with(TRIPS)}
SELECT * EXCLUDE (ingestion_ts, batch_id, source_file, migration_batch_id, engine_type),
  CAST(month(pickup_datetime) AS INTEGER) AS month
FROM lake WHERE year(pickup_datetime) = 1997 AND cab_type IN ('yellow', 'green')"""
ORACLES["read_mixed_types"] = f"""{_with(TRIPS)}
SELECT * EXCLUDE (ingestion_ts, batch_id, source_file, migration_batch_id, engine_type)
FROM lake WHERE year(pickup_datetime) = 1997 AND cab_type IN ('yellow', 'green')"""
ORACLES["backfill_relanded"] = f"""{_with(TRIPS)}
SELECT * EXCLUDE (ingestion_ts, batch_id, source_file, migration_batch_id, engine_type),
  CASE WHEN (vendorid * 3 + payment_type) % 5 % 2 = 0 THEN 'landed' ELSE 'rejected' END AS outcome
FROM lake WHERE cab_type = 'green' AND pickup_datetime >= TIMESTAMP '1997-03-01 00:00:00'
  AND pickup_datetime < TIMESTAMP '1997-03-31 00:00:00'"""
ORACLES["backfill_emptied_day"] = f"""{_with(TRIPS)},
may AS (SELECT * EXCLUDE (ingestion_ts, batch_id, source_file, migration_batch_id, engine_type)
  FROM lake WHERE cab_type = 'yellow' AND pickup_datetime >= TIMESTAMP '1997-05-01 00:00:00'
    AND pickup_datetime < TIMESTAMP '1997-06-01 00:00:00')
SELECT *, 'landed' AS outcome FROM may WHERE day(pickup_datetime) <> 6
UNION ALL SELECT *, 'rejected' AS outcome FROM may WHERE day(pickup_datetime) = 7"""
ORACLES["upsert_null_partition"] = f"""{_with(TRIPS, STAGED, KEYED)}
SELECT DISTINCT trip_id, CASE WHEN cab_type <> 'fhv' THEN cab_type END AS kind, vendor_id FROM keyed"""
ORACLES["slice_volumes"] = f"""{_with(TRIPS)}
SELECT DISTINCT cab_type, CAST(year(pickup_datetime) AS INTEGER) AS year,
  CAST(month(pickup_datetime) AS INTEGER) AS month, TRUE AS has_data FROM lake"""
ORACLES["land_roundtrip"] = f"{_with(TRIPS)} SELECT *, {MONTH} FROM lake"
ORACLES["landed_rows"] = f"""{_with(TRIPS)}
SELECT cab_type, count(*) AS reported, count(*) AS stored FROM lake GROUP BY cab_type"""
ORACLES["promote_roundtrip"] = f"""{_with(TRIPS)}
SELECT *, {MONTH} FROM lake WHERE year(pickup_datetime) <> 1997 OR ({CLEAN_RULE})"""

# ---------------------------------------------------------------- validation

ORACLES["drift_rows"] = f"""{_with(TRIPS)},
odd AS (SELECT * EXCLUDE (ingestion_ts, batch_id, source_file, migration_batch_id, engine_type) FROM lake
  WHERE cab_type = 'green' AND payment_type = 2
    AND date_trunc('month', pickup_datetime) = TIMESTAMP '1997-03-01 00:00:00')
SELECT 'source' AS side, count(*) AS copies, * FROM odd GROUP BY ALL
UNION ALL SELECT 'target' AS side, count(*) AS copies, * REPLACE ('Z' AS store_and_fwd_flag) FROM odd GROUP BY ALL"""
ORACLES["validation_count"] = f"""{_with(TRIPS)}
SELECT count(*) AS source_row_count, count(*) AS target_row_count,
  CAST(0 AS BIGINT) AS delta_row_count, TRUE AS matches FROM lake"""
ORACLES["validation_by_cab"] = f"""{_with(TRIPS)}
SELECT cab_type, count(*) AS source_row_count, count(*) AS target_row_count,
  CAST(0 AS BIGINT) AS delta_row_count,
  round(sum(total_amount), 2) AS source_total_amount,
  round(sum(total_amount), 2) AS target_total_amount,
  CAST(0 AS DOUBLE) AS delta_total_amount, TRUE AS matches
FROM lake GROUP BY cab_type"""
ORACLES["validation_by_month"] = f"""{_with(TRIPS)}
SELECT CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS source_row_count,
  count(*) AS target_row_count, CAST(0 AS BIGINT) AS delta_row_count, TRUE AS matches
FROM lake GROUP BY 1"""
ORACLES["validation_sum"] = f"""{_with(TRIPS)}
SELECT round(sum(total_amount), 2) AS source_total_amount,
  round(sum(total_amount), 2) AS target_total_amount, TRUE AS matches FROM lake"""
ORACLES["validation_range"] = f"""{_with(TRIPS)}
SELECT min(pickup_datetime) AS source_first_pickup, min(pickup_datetime) AS target_first_pickup,
  max(pickup_datetime) AS source_last_pickup, max(pickup_datetime) AS target_last_pickup,
  TRUE AS matches FROM lake"""
ORACLES["validation_day"] = f"""{_with(TRIPS)}
SELECT count(*) AS source_row_count, count(*) AS target_row_count,
  CAST(0 AS BIGINT) AS delta_row_count, TRUE AS matches
FROM lake WHERE CAST(pickup_datetime AS DATE) = DATE '1998-06-15'"""
ORACLES["validation_bundle"] = f"""{_with(TRIPS)},
s AS (SELECT *, month(pickup_datetime) AS m FROM lake WHERE year(pickup_datetime) = 1997),
t AS (SELECT * FROM s WHERE cab_type <> 'fhv' OR m <> 6),
changed AS (SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS n FROM s WHERE cab_type = 'fhv' AND m = 6),
span AS (SELECT CASE WHEN (SELECT min(pickup_datetime) FROM s) IS DISTINCT FROM (SELECT min(pickup_datetime) FROM t)
           OR (SELECT max(pickup_datetime) FROM s) IS DISTINCT FROM (SELECT max(pickup_datetime) FROM t) THEN 1 ELSE 0 END AS n),
zs AS (SELECT pulocationid, count(*) AS n FROM s GROUP BY 1 ORDER BY n DESC, pulocationid LIMIT 20),
zt AS (SELECT pulocationid, count(*) AS n FROM t GROUP BY 1 ORDER BY n DESC, pulocationid LIMIT 20),
xs AS (SELECT vendorid, pulocationid, total_amount, pickup_datetime, count(*) AS n FROM (
  SELECT * FROM s ORDER BY total_amount DESC, vendorid, pulocationid, pickup_datetime LIMIT 10) GROUP BY 1, 2, 3, 4),
xt AS (SELECT vendorid, pulocationid, total_amount, pickup_datetime, count(*) AS n FROM (
  SELECT * FROM t ORDER BY total_amount DESC, vendorid, pulocationid, pickup_datetime LIMIT 10) GROUP BY 1, 2, 3, 4)
SELECT 'count' AS comparison, 1::BIGINT AS groups, n::BIGINT AS mismatches FROM changed
UNION ALL SELECT 'sum', 1, n FROM changed
UNION ALL SELECT 'range', 1, n FROM span
UNION ALL SELECT 'count_by_cab', (SELECT count(DISTINCT cab_type) FROM s), n FROM changed
UNION ALL SELECT 'sum_by_cab', (SELECT count(DISTINCT cab_type) FROM s), n FROM changed
UNION ALL SELECT 'count_by_month', (SELECT count(DISTINCT m) FROM s), n FROM changed
UNION ALL SELECT 'day', 1, CASE WHEN count(*) FILTER (WHERE cab_type = 'fhv') > 0 THEN 1 ELSE 0 END
  FROM s WHERE CAST(pickup_datetime AS DATE) = DATE '1997-06-15'
UNION ALL SELECT 'top_zones', count(*), count(*) FILTER (WHERE zs.n IS DISTINCT FROM zt.n)
  FROM zs FULL OUTER JOIN zt ON zs.pulocationid = zt.pulocationid
UNION ALL SELECT 'top_trips', count(*), count(*) FILTER (WHERE xs.n IS DISTINCT FROM xt.n)
  FROM xs FULL OUTER JOIN xt ON xs.vendorid = xt.vendorid AND xs.pulocationid = xt.pulocationid
    AND xs.total_amount = xt.total_amount AND xs.pickup_datetime = xt.pickup_datetime"""
ORACLES["validation_drift"] = f"""{_with(TRIPS)},
s AS (SELECT cab_type, passenger_count, count(*) AS n FROM lake GROUP BY ALL),
t AS (SELECT cab_type, passenger_count, count(*) AS n FROM lake
      WHERE passenger_count <= 6 AND cab_type <> 'green' GROUP BY ALL)
SELECT s.cab_type, s.passenger_count, s.n AS source_row_count, t.n AS target_row_count,
  t.n - s.n AS delta_row_count, coalesce(t.n = s.n, FALSE) AS matches
FROM s LEFT JOIN t ON s.cab_type = t.cab_type
  AND s.passenger_count IS NOT DISTINCT FROM t.passenger_count"""

# ---------------------------------------------------------------- incremental tables

ORACLES["upsert_three_batches"] = f"""{_with(TRIPS, STAGED, ZONES, KEYED, KEPT_IN_BATCHES, CORE)}
SELECT *, {MONTH} FROM core"""
ORACLES["upsert_latest"] = f"{_CORE} SELECT *, {MONTH} FROM core"
ORACLES["fact_incremental"] = f"{_FACT} SELECT *, {MONTH} FROM fact"
ORACLES["schema_sync"] = f"""{_STG}
SELECT {TRIP_KEY}, CAST(rate_code_id AS BIGINT) AS rate_code_id, CAST(NULL AS DOUBLE) AS surcharge
FROM stg"""

# ---------------------------------------------------------------- ledger

ORACLES["expanded_slices"] = f"{_DAYS} SELECT * FROM requested"
ORACLES["pending_days"] = f"""{_DAYS}
SELECT * FROM requested
WHERE slice_id NOT IN (SELECT slice_id FROM ledger WHERE status = 'LANDED')"""
ORACLES["ledger_current"] = f"{_DAYS} SELECT * FROM ledger"


def _ledger_after(changed: str, batch: str, status: str, engine: str, at: str) -> str:
    return f"""{_DAYS},
changed AS ({changed})
SELECT * FROM ledger WHERE slice_id NOT IN (SELECT slice_id FROM changed)
UNION ALL
SELECT slice_id, '{batch}', '{status}', {engine}, TIMESTAMP '{at} 00:00:00' FROM changed"""


ORACLES["ledger_landed"] = _ledger_after(
    "SELECT slice_id FROM january"
    " WHERE slice_id NOT IN (SELECT slice_id FROM ledger WHERE status = 'LANDED')",
    "batch_c", "LANDED", "'spark'", "2024-02-03",
)
ORACLES["ledger_reset"] = _ledger_after(
    "SELECT slice_id FROM january", "reset_1", "PENDING", "CAST(NULL AS VARCHAR)", "2024-02-04"
)
STATUSES = """
statuses AS (
  SELECT slice_id, cab_type, day, coalesce(status, 'MISSING') AS status, batch_id, engine, landed_at
  FROM requested LEFT JOIN ledger USING (slice_id)
)"""
ORACLES["slice_statuses"] = f"{_DAYS},{STATUSES} SELECT * FROM statuses"
ORACLES["slice_gap_runs"] = f"""{_DAYS},{STATUSES},
runs AS (
  SELECT *, day - CAST(row_number() OVER (PARTITION BY cab_type, status ORDER BY day) AS INTEGER)
    AS run
  FROM statuses WHERE status <> 'LANDED'
)
SELECT cab_type, status, min(day) AS gap_start, max(day) AS gap_end, count(*) AS days
FROM runs GROUP BY cab_type, status, run"""
ORACLES["ledger_drift"] = f"""{_DAYS},
claimed AS (SELECT slice_id FROM ledger WHERE status = 'LANDED'),
present AS (SELECT cab_type || '#' || strftime(day, '%Y_%m_%d') AS slice_id FROM trip_days
            WHERE day(day) % 2 = 1)
SELECT slice_id, 'LANDED_WITHOUT_DATA' AS drift FROM claimed
WHERE slice_id NOT IN (SELECT slice_id FROM present)
UNION ALL
SELECT slice_id, 'DATA_WITHOUT_LEDGER' FROM present
WHERE slice_id NOT IN (SELECT slice_id FROM claimed)"""

# ---------------------------------------------------------------- history

_PLAIN = """vendor_id, vendor_name, status, dbt_valid_from AS valid_from,
  dbt_updated_at AS last_updated, dbt_valid_to IS NULL AS is_current"""
ORACLES["scd2_vendor"] = f"{_HISTORY} SELECT * FROM history"
ORACLES["scd2_stored"] = ORACLES["scd2_vendor"]
ORACLES["scd2_as_of"] = f"""{_HISTORY}
SELECT {_PLAIN} FROM history WHERE dbt_valid_from <= TIMESTAMP '2024-03-01 00:00:00'
  AND (dbt_valid_to IS NULL OR dbt_valid_to > TIMESTAMP '2024-03-01 00:00:00')"""
ORACLES["dim_vendor"] = f"{_HISTORY} SELECT {_PLAIN} FROM history WHERE dbt_valid_to IS NULL"

# observations in order of time; those that change nothing open no version
_CHANGES = """
changes AS (
  SELECT CAST(l_suppkey AS INTEGER) AS vendor_id, 'vendor ' || CAST(l_suppkey AS VARCHAR) AS vendor_name,
    o_orderdate + to_minutes(CAST(l_orderkey % 1440 AS INTEGER)) AS changed_at,
    max(CASE l_returnflag WHEN 'A' THEN 'active' WHEN 'R' THEN 'suspended' END) AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3
),
opening AS (
  SELECT vendor_id, vendor_name, status, changed_at FROM changes
  WINDOW w AS (PARTITION BY vendor_id ORDER BY changed_at)
  QUALIFY row_number() OVER w = 1 OR status IS DISTINCT FROM lag(status) OVER w
),
changed AS (
  SELECT vendor_id, vendor_name, status,
    md5(concat_ws('|', CAST(vendor_id AS VARCHAR), CAST(changed_at AS VARCHAR))) AS dbt_scd_id,
    changed_at AS dbt_valid_from,
    lead(changed_at) OVER (PARTITION BY vendor_id ORDER BY changed_at) AS dbt_valid_to,
    changed_at AS dbt_updated_at
  FROM opening
)"""
ORACLES["scd2_out_of_order"] = f"{_with(_CHANGES)} SELECT * FROM changed"
ORACLES["fact_at_version"] = f"""{_FACT},{_CHANGES}
SELECT trip_id, f.vendor_id, pickup_datetime, total_amount,
  dbt_valid_from AS version_from, v.status AS version_status
FROM fact f LEFT JOIN changed v ON v.vendor_id = f.vendor_id AND pickup_datetime >= dbt_valid_from
  AND (dbt_valid_to IS NULL OR pickup_datetime < dbt_valid_to)"""

# ---------------------------------------------------------------- checks


def _failures(model: str, check: str, column: str, table: str, condition: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{check}' AS check_name, '{column}' AS column_name,"
        f" count(*) AS failures FROM {table} WHERE {condition}"
    )


def _repeated(columns: str, table: str) -> str:
    known = " AND ".join(f"{c.strip()} IS NOT NULL" for c in columns.split(","))
    return (
        f"(SELECT {columns}, count(*) AS row_count FROM {table} WHERE {known}"
        f" GROUP BY {columns} HAVING count(*) > 1)"
    )


def _orphans(column: str, table: str, zones: str) -> str:
    return (
        f"{column} IS NOT NULL AND {column} NOT IN"
        f" (SELECT location_id FROM {zones} WHERE location_id IS NOT NULL)"
    )


_MODEL = "stg_trip_data"
ORACLES["check_not_null"] = f"{_STG} " + " UNION ALL ".join(
    _failures(_MODEL, "not_null", c, "stg", f"{c} IS NULL")
    for c in ("vendor_id", "passenger_count", "airport_fee")
)
ORACLES["check_unique"] = f"{_STG} " + _failures(
    _MODEL, "unique", TRIP_KEY, _repeated(TRIP_KEY, "stg"), "TRUE"
)
ORACLES["repeated_trip_keys"] = f"{_STG} SELECT * FROM {_repeated(TRIP_KEY, 'stg')}"
ORACLES["check_in_set"] = f"{_STG} " + _failures(
    _MODEL, "in_set", "cab_type", "stg", "cab_type NOT IN ('yellow', 'green')"
)
ORACLES["check_between"] = f"{_STG} " + " UNION ALL ".join(
    _failures(_MODEL, "between", column, "stg", condition)
    for column, condition in (
        ("passenger_count", "passenger_count NOT BETWEEN 1 AND 6"),
        ("trip_distance", "trip_distance <= 0"),
        ("fare_amount", "fare_amount > 50000"),
    )
)
GAP = "(SELECT * FROM zones WHERE location_id <> 132)"
ORACLES["check_relationship"] = f"{_STG_ZONES} " + _failures(
    "child", "relationship", "pickup_location_id", "stg", _orphans("pickup_location_id", "stg", GAP)
)
ORACLES["orphan_zones"] = f"""{_STG_ZONES}
SELECT dropoff_location_id, count(*) AS row_count FROM stg
WHERE {_orphans("dropoff_location_id", "stg", GAP)} GROUP BY dropoff_location_id"""
ORACLES["check_freshness"] = f"""{_STG}
SELECT max(ingestion_ts) AS latest_arrival,
  date_diff('minute', max(ingestion_ts), TIMESTAMP '2024-01-04 06:30:00') AS age_minutes,
  CASE WHEN date_diff('minute', max(ingestion_ts), TIMESTAMP '2024-01-04 06:30:00') > 2880
       THEN 'error'
       WHEN date_diff('minute', max(ingestion_ts), TIMESTAMP '2024-01-04 06:30:00') > 1440
       THEN 'warn' ELSE 'pass' END AS status
FROM stg"""

_MODEL_TABLES = {
    "stg_trip_data": "stg",
    "int_trip_data_core": "core",
    "fact_trip": "fact",
    "dim_taxi_zone": "zones",
    "dim_date": "dates",
    "snap_vendor": "history",
    "vendor": "vendors",
}


def _suite_sql() -> str:
    parts = []
    for model, checks in WITH_FRESHNESS.items():
        table = _MODEL_TABLES[model]
        for check in checks:
            column, source = check.column, table
            if check.kind == "not_null":
                condition = f"{column} IS NULL"
            elif check.kind == "unique":
                source, condition = _repeated(column, table), "TRUE"
            elif check.kind == "in_set":
                values = ", ".join(f"'{v}'" for v in check.values)
                condition = f"{column} NOT IN ({values})"
            elif check.kind == "relationship":
                condition = _orphans(column, table, "zones")
            elif check.kind == "freshness":
                latest = f"(SELECT max({column}) FROM {table})"
                age = f"date_diff('minute', {latest}, TIMESTAMP '2024-01-04 06:30:00')"
                minutes = int(check.max_age.total_seconds() // 60)
                source, condition = "(SELECT 1)", f"coalesce({age} > {minutes}, TRUE)"
            else:
                equal = "=" if check.strict else ""
                sides = []
                if check.minimum is not None:
                    sides.append(f"{column} <{equal} {check.minimum}")
                if check.maximum is not None:
                    sides.append(f"{column} >{equal} {check.maximum}")
                condition = " OR ".join(sides)
            parts.append(_failures(model, check.kind, column, source, condition))
    return " UNION ALL ".join(parts)


ORACLES["check_suite"] = f"""{_FACT},{VENDORS},{HISTORY},
dates AS (SELECT CAST(unnest(generate_series(CAST(min(pickup_datetime) AS DATE),
    CAST(max(pickup_datetime) AS DATE), INTERVAL 1 DAY)) AS DATE) AS date_key FROM core)
{_suite_sql()}"""

# ---------------------------------------------------------------- key figures

_KPIS = """count(*) AS trip_count, round(sum(fare_amount), 2) AS total_fare_revenue,
  round(sum(total_amount), 2) AS total_amount,
  round(avg(trip_duration_minutes), 2) AS avg_trip_minutes,
  CAST(sum(passenger_count) AS BIGINT) AS passengers_carried"""
ORACLES["kpis_by_increment"] = f"""{_FACT}
SELECT cab_type, pickup_date_key, {_KPIS.replace(", 2)", ", 6)")} FROM fact
GROUP BY cab_type, pickup_date_key"""
ORACLES["trip_kpis_total"] = f"{_FACT} SELECT {_KPIS} FROM fact"
ORACLES["trip_kpis_by_cab"] = f"""{_FACT}
SELECT cab_type, time_of_day, {_KPIS} FROM fact GROUP BY cab_type, time_of_day"""


def _hourly(year: int) -> str:
    return f"""(SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day, count(*) AS n,
      sum(fare_amount) AS fare FROM fact WHERE year(pickup_datetime) = {year} GROUP BY 1)"""


ORACLES["kpi_against_baseline"] = f"""{_FACT}
SELECT hour_of_day, c.n AS current_trip_count,
  round(c.fare, 2) AS current_total_fare_revenue, b.n AS baseline_trip_count,
  round(b.fare, 2) AS baseline_total_fare_revenue,
  coalesce(c.n, 0) - coalesce(b.n, 0) AS delta_trip_count,
  round(coalesce(c.fare, 0) - coalesce(b.fare, 0), 2) AS delta_total_fare_revenue,
  round(CAST(c.n - b.n AS DOUBLE) / nullif(b.n, 0) * 100, 2) AS trip_count_change_pct
FROM {_hourly(1998)} c FULL OUTER JOIN {_hourly(1997)} b USING (hour_of_day)"""
def _weekly(year: int) -> str:
    return f"""(SELECT CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS day_of_week, count(*) AS n,
      sum(fare_amount) AS fare, avg(trip_duration_minutes) AS minutes,
      CAST(sum(passenger_count) AS BIGINT) AS carried
      FROM fact WHERE year(pickup_datetime) = {year} GROUP BY 1)"""


ORACLES["kpi_figures_by_weekday"] = f"""{_FACT}
SELECT day_of_week, c.n AS current_trip_count, b.n AS baseline_trip_count,
  coalesce(c.n, 0) - coalesce(b.n, 0) AS delta_trip_count,
  round(c.fare, 2) AS current_total_fare_revenue, round(b.fare, 2) AS baseline_total_fare_revenue,
  round(coalesce(c.fare, 0) - coalesce(b.fare, 0), 2) AS delta_total_fare_revenue,
  round(c.minutes, 2) AS current_avg_trip_minutes, round(b.minutes, 2) AS baseline_avg_trip_minutes,
  round(c.minutes - b.minutes, 2) AS delta_avg_trip_minutes,
  c.carried AS current_passengers_carried, b.carried AS baseline_passengers_carried,
  coalesce(c.carried, 0) - coalesce(b.carried, 0) AS delta_passengers_carried,
  round(CAST(c.n - b.n AS DOUBLE) / nullif(b.n, 0) * 100, 2) AS trip_count_change_pct
FROM {_weekly(1998)} c FULL OUTER JOIN {_weekly(1997)} b USING (day_of_week)"""
ORACLES["cumulative_trips_by_day"] = f"""{_FACT},
daily AS (SELECT cab_type, date_trunc('day', pickup_datetime)::TIMESTAMP AS bucket,
            count(*) AS trips FROM fact GROUP BY 1, 2)
SELECT cab_type, bucket, trips,
  CAST(sum(trips) OVER (PARTITION BY cab_type ORDER BY bucket) AS BIGINT) AS cumulative_trips
FROM daily"""
ORACLES["trips_each_minute"] = f"""{_STG}
SELECT date_trunc('minute', pickup_datetime) AS window_start,
  date_trunc('minute', pickup_datetime) + INTERVAL 1 MINUTE AS window_end, cab_type,
  count(*) AS trips FROM stg GROUP BY ALL"""
ORACLES["events_each_minute"] = """
SELECT date_trunc('minute', ts) AS window_start,
  date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, event_type,
  count(*) AS trips FROM events GROUP BY ALL"""

ORACLES["cumulative_by_increment"] = ORACLES["cumulative_trips_by_day"]
ORACLES["core_by_marks"] = ORACLES["upsert_latest"]
ORACLES["arrival_marks"] = f"{_STG} SELECT DISTINCT ingestion_ts AS mark FROM stg"

# ---------------------------------------------------------------- streams

ORACLES["stream_clean"] = ORACLES["quality_filter_trips"]
ORACLES["stream_quarantine"] = ORACLES["quarantine_trips"]
ORACLES["stream_fact"] = ORACLES["fact"]
ORACLES["stream_keys"] = f"""{_with(TRIPS, STAGED, KEYED)}
SELECT DISTINCT trip_id, {TRIP_KEY} FROM keyed WHERE {CLEAN_RULE}"""
ORACLES["stream_windows"] = f"""{_with(TRIPS)},
hours AS (SELECT date_trunc('hour', pickup_datetime) AS window_start,
            date_trunc('hour', pickup_datetime) + INTERVAL 1 HOUR AS window_end, cab_type,
            count(*) AS trips FROM lake GROUP BY ALL)
SELECT * FROM hours
WHERE window_end <= (SELECT max(pickup_datetime) - INTERVAL 1 DAY FROM lake)"""
ORACLES["stream_in_time"] = f"""{_STG}
SELECT * FROM stg WHERE ingestion_ts <= pickup_datetime + INTERVAL 9500 DAYS"""
ORACLES["stream_late"] = f"""{_STG}
SELECT * FROM stg WHERE ingestion_ts > pickup_datetime + INTERVAL 9500 DAYS"""
ORACLES["trips_in_time"] = f"""{_STG}
SELECT * FROM stg WHERE ingestion_ts <= pickup_datetime + INTERVAL 9500 DAYS"""
ORACLES["trips_late"] = f"""{_STG}
SELECT * FROM stg WHERE ingestion_ts > pickup_datetime + INTERVAL 9500 DAYS"""
