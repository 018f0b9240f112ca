"""SQL for the correctness check, written for DuckDB and independent of the Spark plans.

The trips, the minute grid and the small dimensions are common table expressions; time
attributes come from a real left join with the grid.
"""

from __future__ import annotations

# Bucket edges with their labels, and calendar names.
DISTANCE = """CASE WHEN tripdistance <= 1 THEN '0-1 mile' WHEN tripdistance <= 3 THEN '1-3 miles'
     WHEN tripdistance <= 5 THEN '3-5 miles' WHEN tripdistance <= 10 THEN '5-10 miles'
     ELSE '10+ miles' END"""
FARE = """CASE WHEN fareamount <= 10 THEN '0-10' WHEN fareamount <= 20 THEN '10-20'
     WHEN fareamount <= 30 THEN '20-30' WHEN fareamount <= 50 THEN '30-50' ELSE '50+' END"""
TIP = """CASE WHEN tipamount = 0 THEN 'No Tip' WHEN tipamount <= 2 THEN '0-2'
     WHEN tipamount <= 5 THEN '2-5' WHEN tipamount <= 10 THEN '5-10' ELSE '10+' END"""
COARSE_TIP = """CASE WHEN tipamount = 0 THEN 'No Tip' WHEN tipamount <= 5 THEN '0-5'
     WHEN tipamount <= 10 THEN '5-10' ELSE '10+' END"""
DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December",
]

COMMON = f"""
WITH bronze AS (
  SELECT
    o_orderdate + to_minutes((l_orderkey * 7 + l_linenumber * 131) % 1440) AS pickup,
    CASE WHEN l_partkey % 97 = 0 THEN NULL
         ELSE o_orderdate
              + to_minutes((l_orderkey * 7 + l_linenumber * 131) % 1440 + l_partkey % 125 - 2)
    END AS dropoff,
    CAST(l_linenumber AS DOUBLE) AS passenger_count,
    l_quantity / 4 AS trip_distance,
    CAST(CASE l_orderkey % 8 WHEN 7 THEN 99 WHEN 0 THEN 7 ELSE l_orderkey % 8 END AS DOUBLE)
      AS rate_code,
    CAST(s_nationkey AS BIGINT) AS pu, CAST(c_nationkey AS BIGINT) AS dof,
    CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS payment,
    floor(l_extendedprice / 10) / 100 AS fare,
    floor(l_extendedprice * l_discount / 10) / 100 AS tip,
    floor(l_extendedprice * (1 + l_tax + l_discount) / 10) / 100 AS total,
    CASE WHEN l_linenumber = 1 THEN 1.75::DOUBLE ELSE 0.0::DOUBLE END AS airport,
    CAST(o_orderdate AS DATE) AS source_date
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN customer ON o_custkey = c_custkey
),
ft AS (
  SELECT
    CAST(strftime(pickup, '%Y%m%d%H%M') AS BIGINT) AS pickupdatetimeid,
    CAST(strftime(dropoff, '%Y%m%d%H%M') AS BIGINT) AS dropoffdatetimeid,
    CAST(pu AS INTEGER) AS pulocationid, CAST(dof AS INTEGER) AS dolocationid,
    CAST(rate_code AS INTEGER) AS ratecodeid, CAST(payment AS INTEGER) AS paymenttypeid,
    CAST(passenger_count AS INTEGER) AS passengercount,
    trip_distance AS tripdistance, fare AS fareamount, tip AS tipamount,
    0.0::DOUBLE AS tollsamount, airport AS airportamount, total AS totalamount,
    0.5::DOUBLE AS extra, 0.5::DOUBLE AS mtatax, 2.5::DOUBLE AS congestionsurcharge,
    CASE WHEN pickup IS NULL OR dropoff IS NULL OR pickup > dropoff
              OR pu IS NULL OR dof IS NULL THEN 'corrupted' ELSE 'good' END AS quality_issue,
    CAST(year(source_date + INTERVAL 1 YEAR) AS INTEGER) AS year,
    CAST(month(source_date + INTERVAL 1 YEAR) AS INTEGER) AS month,
    CAST(day(source_date + INTERVAL 1 YEAR) AS INTEGER) AS day,
    source_date,
    CASE WHEN fare > 0 THEN tip / fare * 100 ELSE 0 END AS tip_percentage,
    date_diff('minute', pickup, dropoff) AS true_minutes
  FROM bronze
),
good AS (
  SELECT *, (dropoffdatetimeid - pickupdatetimeid) // 100 AS duration,
    {DISTANCE} AS distance_category, {FARE} AS fare_category, {TIP} AS tip_category
  FROM ft WHERE quality_issue = 'good'
),
loc AS (
  SELECT n_nationkey AS locationid, r_name AS borough, n_name AS zone,
         CASE WHEN n_regionkey = 0 THEN 'Airports' ELSE 'Boro Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
pay(paymenttypeid, paymenttype) AS (
  VALUES (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'),
         (5, 'Unknown'), (0, 'Voided trip')
),
rate(ratecodeid, ratedescription) AS (
  VALUES (1, 'Standard rate'), (2, 'JFK'), (3, 'Newark'), (4, 'Nassau or Westchester'),
         (5, 'Negotiated fare'), (6, 'Group ride'), (7, 'Not recorded'),
         (99, 'Unknown or other')
),
span AS (
  SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders
),
minutes AS (
  SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi + INTERVAL 1 DAY AS TIMESTAMP),
                                INTERVAL 1 MINUTE)) AS ts
  FROM span
),
dimtime AS (
  SELECT CAST(strftime(ts, '%Y%m%d%H%M') AS BIGINT) AS timeid, CAST(ts AS DATE) AS trip_date,
         CAST(year(ts) AS INTEGER) AS trip_year, CAST(month(ts) AS INTEGER) AS trip_month,
         CAST(day(ts) AS INTEGER) AS trip_day, CAST(hour(ts) AS INTEGER) AS trip_hour,
         CAST((dayofyear(ts) - 1) // 7 + 1 AS INTEGER) AS trip_week,
         CAST(extract(dow FROM ts) AS INTEGER) AS day_of_week,
         ({DAYS})[extract(dow FROM ts) + 1] AS day_name
  FROM minutes
),
timed AS (
  SELECT good.*, dimtime.* EXCLUDE (timeid)
  FROM good LEFT JOIN dimtime ON pickupdatetimeid = timeid
),
joined AS (
  SELECT timed.*, p.paymenttype AS payment_type, r.ratedescription AS rate_description,
         pu.zone AS pickup_zone, pu.borough AS pickup_borough,
         pu.service_zone AS pickup_service_zone,
         dz.zone AS dropoff_zone, dz.borough AS dropoff_borough,
         dz.service_zone AS dropoff_service_zone
  FROM timed
  LEFT JOIN loc pu ON pulocationid = pu.locationid
  LEFT JOIN loc dz ON dolocationid = dz.locationid
  LEFT JOIN pay p ON timed.paymenttypeid = p.paymenttypeid
  LEFT JOIN rate r ON timed.ratecodeid = r.ratecodeid
)
"""


def _total(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(28, 6))) AS DOUBLE)"


def _avg(column: str, name: str) -> str:
    return f"{_total(column)} / COUNT({column}) AS {name}"


N = "COUNT(*) AS trip_count"
AVG_FARE = _avg("fareamount", "avg_fare")
# Percentages are added up in whole millionths.
AVG_TIP = (
    "CAST(SUM(CAST(floor(tip_percentage * 1000000 + 0.5) AS DECIMAL(28, 0))) AS DOUBLE) / 1000000 "
    "/ COUNT(tip_percentage) AS avg_tip_percentage"
)
AVG_REVENUE = _avg("totalamount", "avg_revenue_per_trip")


def _sum(name: str = "total_revenue") -> str:
    return f"{_total('totalamount')} AS {name}"


def _grouped(source: str, keys: str, *measures: str, where: str = "") -> str:
    condition = f" WHERE {where}" if where else ""
    group = ", ".join(str(i) for i in range(1, len(keys.split(",")) + 1))
    return (
        f"{COMMON} SELECT {keys}, {', '.join(measures)} FROM {source}{condition} GROUP BY {group}"
    )


def _select(columns: str, source: str = "joined", tail: str = "") -> str:
    return f"{COMMON} SELECT {columns} FROM {source} {tail}"


SEASON = (
    "CASE WHEN trip_month IN (12, 1, 2) THEN 'Winter' WHEN trip_month IN (3, 4, 5) THEN 'Spring' "
    "WHEN trip_month IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season"
)
QUARTER = (
    "CASE WHEN trip_month IN (1, 2, 3) THEN 1 WHEN trip_month IN (4, 5, 6) THEN 2 "
    "WHEN trip_month IN (7, 8, 9) THEN 3 ELSE 4 END AS quarter"
)
WEEKEND = "coalesce(day_of_week IN (0, 6), false) AS is_weekend"
MONTH_NAME = f"({MONTHS})[trip_month]"
FACT = (
    "pickupdatetimeid, dropoffdatetimeid, pulocationid, dolocationid, ratecodeid, paymenttypeid, "
    "passengercount, tripdistance, fareamount, tipamount, tollsamount, airportamount, "
    "totalamount, extra, mtatax, congestionsurcharge, quality_issue, year, month, day"
)
FACT_NAMES = (
    "pickupdatetimeid AS PickupDateTimeID, dropoffdatetimeid AS DropOffDateTimeID, "
    "pulocationid AS PULocationID, dolocationid AS DOLocationID, ratecodeid AS RateCodeID, "
    "paymenttypeid AS PaymentTypeID, passengercount AS PassengerCount, "
    "tripdistance AS TripDistance, fareamount AS FareAmount, tipamount AS TipAmount, "
    "tollsamount AS TollsAmount, airportamount AS AirportAmount, totalamount AS TotalAmount, "
    "extra AS Extra, mtatax AS MTATax, congestionsurcharge AS CongestionSurcharge, "
    "quality_issue, year, month, day"
)
CORE = (
    "pickupdatetimeid, dropoffdatetimeid, passengercount, tripdistance, fareamount, tipamount, "
    "totalamount"
)
PLACES = "pickup_zone, pickup_borough, dropoff_zone, dropoff_borough"
KINDS = "payment_type, rate_description"
HOURS = "trip_date, trip_year, trip_month, trip_hour"
BUCKETS = "distance_category, fare_category"
DERIVED = "duration AS trip_duration_minutes, tip_percentage"
DAILY = _grouped("timed", "trip_date", N, AVG_FARE, _sum("daily_revenue"))
BOROUGH = _grouped(
    "joined", "pickup_borough", N, _sum(), AVG_FARE, where="pickup_borough IS NOT NULL"
)
PER_DAY = _grouped("timed", "CAST(trip_date AS TIMESTAMP) AS trip_time", N)
SELECTION = (
    "trip_year IN (1997, 1998, 1999) AND trip_month IN (1, 2, 3, 7, 8) "
    "AND pickup_borough IN ('ASIA', 'EUROPE') "
    "AND payment_type IN ('Cash', 'Dispute', 'Unknown') "
    "AND distance_category IN ('1-3 miles', '3-5 miles', '10+ miles')"
)


def _share(grouped_key: str, source: str, where: str, measures: str, value: str, out: str) -> str:
    condition = f"WHERE {where}" if where else ""
    return f"""{COMMON}, g AS (
  SELECT {grouped_key}, COUNT(*) AS trip_count, {_sum("revenue")},
         {_avg("totalamount", "per_trip")}
  FROM {source} {condition} GROUP BY 1)
SELECT {measures}, round({value} * 100.0::DOUBLE / SUM({value}) OVER (), 2) AS {out} FROM g"""


def _histogram(column: str) -> str:
    return f"""{COMMON},
ends AS (SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM good),
filled AS (
  SELECT CAST(least(floor(({column} - lo) * 20 / (hi - lo)), 19) AS BIGINT) AS bin,
         COUNT(*) AS n
  FROM good, ends GROUP BY 1)
SELECT e.bin, lo + (hi - lo) * e.bin / 20 AS bin_start,
       lo + (hi - lo) * (e.bin + 1) / 20 AS bin_end,
       CAST(coalesce(n, 0) AS BIGINT) AS trip_count
FROM (SELECT unnest(generate_series(0, 19)) AS bin) e
CROSS JOIN ends LEFT JOIN filled ON e.bin = filled.bin"""


def _partial(sql: str) -> str:
    """The same query where the calendar lacks the first and the last year."""
    return sql.replace("CAST(lo AS TIMESTAMP)", "CAST(lo + INTERVAL 1 YEAR AS TIMESTAMP)").replace(
        "CAST(hi + INTERVAL 1 DAY AS TIMESTAMP)",
        "CAST(hi - INTERVAL 1 YEAR + INTERVAL 1 DAY AS TIMESTAMP)",
    )


CHATS = """
WITH c AS (
  SELECT conv_id AS id, COUNT(*) + 100 AS user_id,
         CAST(max(CASE WHEN role = 'system' THEN 1 ELSE 0 END) + 1001 AS INTEGER) AS team_id
  FROM conversations GROUP BY conv_id),
ch AS (
  SELECT u.conv_id * 1000000000 + u.turn AS id, u.conv_id AS conversation_id,
         u.text AS user_request, 'Explain: ' || u.text AS prompt, a.text AS response,
         TIMESTAMP '2024-10-08 12:00:00' + to_minutes(u.conv_id * 15 + u.turn) AS created_at,
         TIMESTAMP '2024-10-08 12:01:00' + to_minutes(u.conv_id * 15 + u.turn) AS updated_at
  FROM conversations u
  LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')
SELECT c.id AS conversation_id, c.user_id, c.team_id, ch.id AS chat_id, ch.user_request,
       ch.prompt, ch.response, ch.created_at AS chat_created_at, ch.updated_at AS chat_updated_at
FROM c JOIN ch ON c.id = ch.conversation_id
"""

DIMTIME = """
WITH span AS (
  SELECT date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) + INTERVAL 1 DAY AS hi
  FROM events),
grid AS (SELECT unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MINUTE)) AS t
         FROM span)
SELECT CAST(strftime(t, '%Y%m%d%H%M') AS BIGINT) AS timeid, CAST(t AS DATE) AS "Date",
       CAST(day(t) AS INTEGER) AS dayofmonth,
       CAST((dayofyear(t) - 1) // 7 + 1 AS INTEGER) AS weekofyear,
       CAST(month(t) AS SMALLINT) AS month, CAST(year(t) AS SMALLINT) AS year,
       CAST(hour(t) AS SMALLINT) AS hour, CAST(minute(t) AS SMALLINT) AS minute,
       CAST(0 AS SMALLINT) AS second
FROM grid
"""

OBJECTS = """
WITH source AS (
  SELECT source || '/' || doc_id AS rel_path, strlen(text) AS length, doc_id, n_chars
  FROM documents),
target AS (
  SELECT rel_path, n_chars AS length FROM source WHERE doc_id IN (SELECT doc_id FROM labels))
"""

VALIDATED = f"""{OBJECTS}, validated AS (
  SELECT s.rel_path, s.length, t.length AS target_length,
         CASE WHEN t.length IS NULL THEN 'missing' WHEN s.length <> t.length THEN 'size_mismatch'
              ELSE 'ok' END AS status
  FROM source s LEFT JOIN target t ON s.rel_path = t.rel_path)
"""

ORACLE: dict[str, str] = {
    "kpi_total_trips": _select("COUNT(*) AS total_trips", "good"),
    "kpi_total_revenue": _select(_sum(), "good"),
    "kpi_avg_fare": _select(AVG_FARE, "good"),
    "kpi_avg_tip_pct": _select(AVG_TIP, "good"),
    "kpi_avg_distance": _select(_avg("tripdistance", "avg_distance"), "good"),
    "kpi_avg_duration": _select(_avg("true_minutes", "avg_duration_minutes"), "good"),
    "kpi_summary": _select(
        ", ".join(
            ["COUNT(*) AS total_trips", _sum(), AVG_FARE, AVG_TIP,
             _avg("tripdistance", "avg_distance"), _avg("true_minutes", "avg_duration_minutes")]
        ),
        "good",
    ),
    "daily_trends": DAILY,
    "daily_trends_joined": DAILY,
    "hourly_distribution": _grouped("timed", "trip_hour", N, AVG_FARE),
    "monthly_trends": _grouped(
        "timed", "trip_year, trip_month", N, _sum("monthly_revenue"), AVG_FARE
    ),
    "weekly_trends": _grouped(
        "timed", "trip_year, trip_week", N, _sum("weekly_revenue"), AVG_FARE
    ),
    "year_over_year": _grouped("timed", "trip_month, trip_year", N, _sum("revenue")),
    "revenue_trends": _grouped(
        "timed", "trip_year AS \"year\", trip_month AS \"month\"", N, _sum("revenue"), AVG_FARE,
        _avg("tripdistance", "avg_distance"),
    ),
    "data_overview": _grouped(
        "timed", "trip_year AS \"year\", trip_month AS \"month\"", N, AVG_FARE
    ),
    "year_distribution": _share(
        'trip_year AS "year"', "timed", "", '"year", trip_count', "trip_count", "percentage"
    ),
    "seasonal_analysis": _select(f"{SEASON}, {N}, {AVG_FARE}, {_sum()}", "timed", "GROUP BY 1"),
    "hour_day_heatmap": _grouped("timed", "trip_hour, day_name", N),
    "peak_hours": _grouped("timed", "day_name, trip_hour", N, AVG_FARE),
    "trips_by_borough": BOROUGH,
    "pickup_vs_dropoff": f"""{COMMON}
SELECT 'Pickup' AS trip_type, pickup_borough AS borough, {N} FROM joined
WHERE pickup_borough IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'Dropoff', dropoff_borough, COUNT(*) FROM joined
WHERE dropoff_borough IS NOT NULL GROUP BY 2""",
    "top_zones": _grouped(
        "joined", "pickup_zone", N, AVG_FARE, where="pickup_zone IS NOT NULL"
    ) + " ORDER BY trip_count DESC, pickup_zone LIMIT 20",
    "dropoff_density": _grouped("joined", "dropoff_zone, dropoff_borough", N),
    "revenue_hour_borough": _grouped(
        "joined", "pickup_borough, trip_hour", N, _sum(), AVG_REVENUE,
        where="pickup_borough IS NOT NULL",
    ),
    "top_boroughs": _share(
        "pickup_borough AS borough", "joined", "pickup_borough IS NOT NULL",
        "borough, trip_count, revenue AS total_revenue, per_trip AS avg_revenue_per_trip",
        "revenue", "revenue_percentage",
    ),
    "airport_trips": _grouped(
        "joined", "pickup_zone, rate_description", N, AVG_FARE,
        _avg("tripdistance", "avg_distance"), _avg("passengercount", "avg_passengers"),
        where="pickup_service_zone = 'Airports' OR rate_description IN ('JFK', 'Newark')",
    ),
    "revenue_by_payment": _grouped(
        "joined", "payment_type", N, _sum(), AVG_FARE, where="payment_type IS NOT NULL"
    ),
    "payment_analysis": _grouped(
        "joined", "payment_type AS paymenttype", N, _sum(), AVG_REVENUE, AVG_TIP,
        where="payment_type IS NOT NULL",
    ),
    "fare_distribution": _grouped("good", "fare_category", N),
    "tip_analysis": _grouped("good", "tip_category", N, AVG_TIP, where="tipamount > 0"),
    "distance_analysis": _grouped(
        "good", "distance_category", N, AVG_FARE, _avg("duration", "avg_duration_minutes"),
        _avg("true_minutes", "avg_true_minutes"),
    ),
    "passenger_distribution": _grouped("good", "passengercount", N, AVG_FARE),
    "rate_code_analysis": _grouped(
        "joined", "rate_description", N, _sum(), AVG_FARE, where="rate_description IS NOT NULL"
    ),
    "duration_vs_fare": _select(
        "duration AS trip_duration_minutes, true_minutes AS trip_true_minutes, fareamount, "
        "pickup_borough, distance_category, tripdistance",
        tail="WHERE duration > 0 AND duration < 120 AND fareamount > 0 AND fareamount < 100",
    ),
    "gold_daily": _grouped("timed", "trip_date", N, _sum("daily_revenue"), AVG_FARE, AVG_TIP),
    "gold_borough": BOROUGH,
    "quality_report": f"""{COMMON}
SELECT 'Total Records' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM ft
UNION ALL SELECT 'Good Quality Records', COUNT(*)::DOUBLE FROM ft WHERE quality_issue = 'good'
UNION ALL SELECT 'Corrupted Records', COUNT(*)::DOUBLE FROM ft WHERE quality_issue = 'corrupted'
UNION ALL SELECT 'Data Completeness %', round(
  COUNT(CASE WHEN quality_issue = 'good' THEN 1 END) * 100.0::DOUBLE / COUNT(*), 2) FROM ft""",
    "table_inventory": f"""{COMMON}
SELECT 'fact_trip' AS table_name, COUNT(*) AS row_count, MIN(year) AS min_year,
       MAX(year) AS max_year FROM good
UNION ALL SELECT 'dimlocation', COUNT(*), NULL, NULL FROM loc
UNION ALL SELECT 'dimpayment', COUNT(*), NULL, NULL FROM pay
UNION ALL SELECT 'dimratecode', COUNT(*), NULL, NULL FROM rate
UNION ALL SELECT 'dimtime', COUNT(*), MIN(trip_year), MAX(trip_year) FROM dimtime""",
    "table_counts": f"""{COMMON}
SELECT 'fact_trip' AS table_name, COUNT(*) AS row_count FROM good
UNION ALL SELECT 'dimlocation', COUNT(*) FROM loc""",
    "trips_wide": _select(
        f"{FACT}, {PLACES}, pickup_service_zone, dropoff_service_zone, {KINDS}, {HOURS}, "
        f"trip_day, day_of_week, day_name, {MONTH_NAME} AS month_name, {QUARTER}, {WEEKEND}, "
        f"{BUCKETS}, tip_category, {DERIVED}, true_minutes AS trip_true_minutes"
    ),
    "trips_wide_min": _select(
        f"{CORE}, pickup_borough, dropoff_borough, {KINDS}, {HOURS}, {BUCKETS}"
    ),
    "trips_wide_short": _select(
        f"{CORE}, {PLACES}, pickup_service_zone, dropoff_service_zone, {KINDS}, {HOURS}, "
        f"trip_day, day_of_week, substr(day_name, 1, 3) AS day_name, "
        f"substr({MONTH_NAME}, 1, 3) AS month_name, {QUARTER}, {WEEKEND}, {BUCKETS}, "
        f"{COARSE_TIP} AS tip_category, {DERIVED}"
    ),
    "trips_wide_dates": _select(
        f"{CORE}, {PLACES}, {KINDS}, {HOURS}, {BUCKETS}, day_of_week, day_name, {DERIVED}",
    ),
    "trips_wide_buckets": _select(f"{CORE}, {PLACES}, {KINDS}, {HOURS}, {BUCKETS}"),
    "trips_wide_plain": _select(f"{CORE}, {PLACES}, {KINDS}, {HOURS}"),
    "trips_star": _select(f"{FACT_NAMES}, {PLACES}, {KINDS}, {HOURS}, trip_day"),
    "chart_total_trips": _select("COUNT(*) AS total_trips", "good"),
    "chart_total_revenue": _select(_sum(), "good"),
    "chart_daily": PER_DAY,
    "chart_hourly": PER_DAY,
    "chart_hourly_true": _grouped(
        "timed", "CAST(trip_date AS TIMESTAMP) + to_hours(trip_hour) AS trip_time", N
    ),
    "chart_borough": _grouped("joined", "pickup_borough", N),
    "chart_payment_revenue": _grouped("joined", "payment_type", _sum()),
    "hist_distance": _histogram("tripdistance"),
    "hist_fare": _histogram("fareamount"),
    "filtered_dashboard": _grouped(
        "joined", "trip_year, trip_month", N, _sum("monthly_revenue"), AVG_FARE, where=SELECTION
    ),
    "filtered_payments": _grouped(
        "joined", "payment_type AS paymenttype", N, _sum(), AVG_REVENUE, AVG_TIP, where=SELECTION
    ),
    "filtered_recent": _grouped(
        "timed", "trip_date", N, AVG_FARE, _sum("daily_revenue"),
        where="trip_date BETWEEN DATE '2001-05-31' AND DATE '2001-06-30'",
    ),
    "cross_filter_months": _grouped(
        "joined", "trip_year, trip_month", N, _sum("monthly_revenue"), AVG_FARE, where=SELECTION
    ),
    "cross_filter_payments": _grouped(
        "joined", "payment_type AS paymenttype", N, _sum(), AVG_REVENUE, AVG_TIP, where=SELECTION
    ),
    "cross_filter_distances": _grouped(
        "joined", "distance_category", N, AVG_FARE, _avg("duration", "avg_duration_minutes"),
        _avg("true_minutes", "avg_true_minutes"), where="pickup_borough = 'ASIA'",
    ),
    "rollup_boroughs": _share(
        "pickup_borough AS borough", "joined", "pickup_borough IS NOT NULL",
        "borough, trip_count, revenue AS total_revenue, per_trip AS avg_revenue_per_trip",
        "revenue", "revenue_percentage",
    ),
    "drilldown_zones": _grouped(
        "joined", "pickup_zone", N, _sum(), AVG_FARE, where="pickup_borough = 'ASIA'"
    ),
    "fact_trip": _select(f"{FACT_NAMES}, source_date", "ft"),
    "fact_plain": f"""{COMMON}
SELECT CAST(strftime(pickup, '%Y%m%d%H%M') AS BIGINT) AS PickupDateTimeID,
       CAST(strftime(dropoff, '%Y%m%d%H%M') AS BIGINT) AS DropOffDateTimeID,
       pu AS PULocationID, dof AS DOLocationID, rate_code AS RateCodeID,
       payment AS PaymentTypeID, passenger_count AS PassengerCount,
       trip_distance AS TripDistance, fare AS FareAmount, tip AS TipAmount,
       0.0::DOUBLE AS TollsAmount, airport AS AirportAmount, total AS TotalAmount,
       0.5::DOUBLE AS Extra, 0.5::DOUBLE AS MTATax, 2.5::DOUBLE AS CongestionSurcharge
FROM bronze""",
    "dimtime": DIMTIME,
    "dimlocation": _select(
        "locationid AS LocationID, borough AS Borough, zone AS Zone, service_zone", "loc"
    ),
    "dimpayment": f"""{COMMON}
SELECT CAST(paymenttypeid AS BIGINT) AS paymenttypeid, paymenttype,
       COUNT(payment) AS trip_count
FROM pay LEFT JOIN bronze ON paymenttypeid = payment GROUP BY 1, 2""",
    "dimratecode": f"""{COMMON}
SELECT ratecodeid, ratedescription, COUNT(rate_code) AS trip_count
FROM rate LEFT JOIN bronze ON ratecodeid = rate_code GROUP BY 1, 2""",
    "load_outcome": f"""{COMMON},
plan AS (
  SELECT CAST(unnest(generate_series(lo, hi + INTERVAL 7 DAY, INTERVAL 1 DAY)) AS DATE)
         AS source_date
  FROM span),
counts AS (SELECT source_date, COUNT(*) AS n FROM bronze GROUP BY 1)
SELECT plan.source_date, CAST(plan.source_date + INTERVAL 1 YEAR AS DATE) AS target_date,
       coalesce(n, 0) AS rows, coalesce(n, 0) > 0 AS success
FROM plan LEFT JOIN counts ON plan.source_date = counts.source_date""",
    "bronze_zone_join": f"""{COMMON}
SELECT CAST(1 AS BIGINT) AS "VendorID", pickup AS tpep_pickup_datetime,
       dropoff AS tpep_dropoff_datetime, passenger_count, trip_distance,
       rate_code AS "RatecodeID", 'N' AS store_and_fwd_flag, pu AS "PULocationID",
       dof AS "DOLocationID", payment AS payment_type, fare AS fare_amount,
       0.5::DOUBLE AS extra, 0.5::DOUBLE AS mta_tax, tip AS tip_amount,
       0.0::DOUBLE AS tolls_amount, 1.0::DOUBLE AS improvement_surcharge, total AS total_amount,
       2.5::DOUBLE AS congestion_surcharge, airport AS "Airport_fee",
       CAST(year(source_date) AS INTEGER) AS year, CAST(month(source_date) AS INTEGER) AS month,
       CAST(day(source_date) AS INTEGER) AS day, locationid AS "LocationID",
       borough AS "Borough", zone AS "Zone", service_zone
FROM bronze JOIN loc ON pu = locationid""",
    "bronze_count_by_payment": _select(
        'payment AS payment_type, COUNT(*) AS "count"', "bronze", "GROUP BY 1"
    ),
    "bronze_count_by_rate": _select(
        'rate_code AS "RatecodeID", COUNT(*) AS "count"', "bronze", "GROUP BY 1"
    ),
    "bronze_union_days": f"""{COMMON}
SELECT COUNT(*) AS n FROM (
  SELECT * FROM bronze WHERE year(source_date) < 1998
  UNION ALL SELECT * FROM bronze WHERE coalesce(year(source_date) >= 1998, true))""",
    "event_minute_keys": """
SELECT event_id, CAST(strftime(ts, '%Y%m%d%H%M') AS BIGINT) AS minute_key,
       CAST(((CAST(epoch(date_trunc('second', ts)) AS BIGINT) + 30) // 60) * 60 AS INTEGER)
         AS unix_minute_key
FROM events""",
    "events_by_day": "SELECT date_trunc('day', ts)::TIMESTAMP AS period, COUNT(*) AS n "
                     "FROM events GROUP BY 1",
    "events_by_hour": "SELECT date_trunc('hour', ts)::TIMESTAMP AS period, COUNT(*) AS n "
                      "FROM events GROUP BY 1",
    "range_projection": "SELECT event_id AS id, event_id + 10 AS plus_10, "
                        "event_id + 20 AS plus_20 FROM events",
    "conversation_chats": CHATS + "WHERE c.team_id = 1001",
    "conversation_chats_federated": CHATS,
    "tpch_wide": """
SELECT l_orderkey AS orderkey, l_partkey AS partkey, l_suppkey AS suppkey,
       l_linenumber AS linenumber, l_quantity AS quantity, l_extendedprice AS extendedprice,
       l_discount AS discount, l_tax AS tax, l_returnflag AS returnflag,
       l_linestatus AS linestatus, l_shipdate AS shipdate, o_custkey AS custkey,
       o_orderstatus AS orderstatus, o_totalprice AS totalprice, o_orderdate AS orderdate,
       o_orderpriority AS orderpriority, s_name AS supplier_name,
       s_acctbal AS supplier_acctbal, p_name AS part_name, p_brand AS brand, p_type AS "type",
       p_size AS size, p_retailprice AS retailprice, c_name AS customer_name,
       c_acctbal AS customer_acctbal, c_mktsegment AS mktsegment, n_name AS country,
       n_regionkey AS regionkey
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey""",
    "csv_roundtrip": "SELECT * FROM documents",
    "file_manifest": f"{OBJECTS} SELECT rel_path, length, 'bronze/' || rel_path AS key FROM source",
    "file_new": f"""{OBJECTS}
SELECT rel_path, length FROM source
WHERE rel_path NOT IN (SELECT rel_path FROM target)""",
    "file_validation": VALIDATED + "SELECT * FROM validated",
    "file_verdict": VALIDATED + """
SELECT COUNT(*) FILTER (WHERE status <> 'ok') AS errors,
       COUNT(*) FILTER (WHERE status <> 'ok') = 0 AS valid FROM validated""",
    "file_stats": f"""{OBJECTS}
SELECT CASE WHEN t.rel_path IS NULL THEN 'new' ELSE 'skipped' END AS status, COUNT(*) AS files,
       CAST(SUM(s.length) AS BIGINT) AS total_size_bytes
FROM source s LEFT JOIN target t ON s.rel_path = t.rel_path GROUP BY 1""",
    "file_md5": "SELECT source || '/' || doc_id AS rel_path, md5(text) AS md5 FROM documents",
}

for _name in (
    "daily_trends", "daily_trends_joined", "seasonal_analysis", "hour_day_heatmap",
):
    ORACLE[f"{_name}_partial"] = _partial(ORACLE[_name])
ORACLE["trips_wide_partial"] = _partial(ORACLE["trips_wide"]).replace(
    ", true_minutes AS trip_true_minutes", ""
)
ORACLE["dimtime_sample"] = (
    f"SELECT * FROM ({ORACLE['dimtime']}) "
    "WHERE CAST('0x' || substr(md5('7:' || timeid), 1, 8) AS BIGINT) < 0.25 * 4294967296 "
    "ORDER BY md5('7:' || timeid) LIMIT 100"
)
ORACLE["daily_trends_bucketed"] = ORACLE["daily_trends"]
ORACLE["file_new_by_ranges"] = ORACLE["file_new"]
ORACLE["file_validation_by_ranges"] = ORACLE["file_validation"]
ORACLE["table_footers"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, COUNT(*) AS row_count, CAST(MIN({key}) AS BIGINT) AS least, "
    f"CAST(MAX({key}) AS BIGINT) AS greatest FROM {table}"
    for table, key in (
        ("customer", "c_custkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey"),
        ("part", "p_partkey"), ("supplier", "s_suppkey"), ("events", "event_id"),
        ("documents", "doc_id"), ("pages", "page_id"), ("conversations", "conv_id"),
        ("labels", "doc_id"), ("nation", "n_nationkey"),
    )
)
ORACLE["filtered_partial"] = _partial(ORACLE["filtered_dashboard"])
