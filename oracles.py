"""DuckDB SQL that gives the same rows as each registered query.

Every statement starts from the order tables and derives the trips itself, so nothing
is shared with the Spark side.
"""

from __future__ import annotations

import re

TRIPS = """
zones AS (
  SELECT n_nationkey AS LocationID,
         CASE WHEN r_name = 'MIDDLE EAST' THEN 'Unknown' ELSE r_name END AS Borough,
         n_name AS Zone, 'none' AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
started AS (
  SELECT o_orderdate + to_years(CASE WHEN l_orderkey % 97 = 0 THEN 40 ELSE 16 END)
           + to_minutes((o_orderkey * 7919 + l_linenumber * 131) % 1440) AS pickup_datetime,
         (l_partkey * 37 + l_suppkey) % 260 - 5 AS u,
         CASE WHEN l_partkey % 3 <> 0 THEN (l_partkey * 7 + l_linenumber * 13) % 60 ELSE 0 END AS s,
         CASE WHEN c_nationkey <> 24 THEN c_nationkey::BIGINT END AS PULocationID,
         CASE WHEN s_nationkey <> 24 THEN s_nationkey::BIGINT END AS DOLocationID,
         (l_quantity - 2) * 0.5::DOUBLE AS trip_distance,
         floor(l_extendedprice * 4 / 50) / 4.0::DOUBLE AS total_amount,
         CASE WHEN (l_linenumber + l_partkey) % 8 <> 7
              THEN ((l_linenumber + l_partkey) % 8)::INTEGER END AS passenger_count,
         CASE WHEN l_tax > 0.06 THEN 1.25::DOUBLE WHEN l_tax >= 0.02 THEN 0.0::DOUBLE END AS airport_fee
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
),
trips AS (
  SELECT pickup_datetime, pickup_datetime + to_minutes(u) + to_seconds(s) AS dropoff_datetime,
         PULocationID, DOLocationID, trip_distance, total_amount, passenger_count, airport_fee
  FROM started
)"""

FILLED = TRIPS + """,
filled AS (
  SELECT * REPLACE (coalesce(passenger_count, 1) AS passenger_count,
                    coalesce(airport_fee, 0.0::DOUBLE) AS airport_fee)
  FROM trips
),
timed AS (
  SELECT *, round(date_diff('microsecond', pickup_datetime, dropoff_datetime) / 6e7::DOUBLE, 2)
            AS trip_duration_mins
  FROM filled
)"""

CLEAN = FILLED + """,
valid AS (
  SELECT * FROM timed
  WHERE trip_distance > 0 AND trip_distance <= 3000
    AND total_amount > 0 AND total_amount <= 2000
    AND trip_duration_mins > 1 AND trip_duration_mins < 240
    AND passenger_count > 0 AND passenger_count <= 5
    AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL
    AND pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
    AND year(pickup_datetime) BETWEEN 2011 AND 2024
    AND year(dropoff_datetime) BETWEEN 2011 AND 2024
),
known AS (SELECT * FROM zones WHERE Borough NOT IN ('Unknown', 'N/A')),
clean AS (
  SELECT v.*, p.Borough AS pickup_borough, d.Borough AS dropoff_borough
  FROM valid v
  JOIN known p ON v.PULocationID = p.LocationID
  JOIN known d ON v.DOLocationID = d.LocationID
)"""

ENRICHED = CLEAN + """,
enriched AS (
  SELECT *,
         hour(pickup_datetime)::INTEGER AS pickup_hour,
         (dayofweek(pickup_datetime) + 1)::INTEGER AS pickup_day_of_week,
         month(pickup_datetime)::INTEGER AS pickup_month,
         year(pickup_datetime)::INTEGER AS pickup_year,
         CASE WHEN trip_duration_mins > 0 THEN trip_distance / (trip_duration_mins / 60) END AS speed_mph
  FROM clean
),
classified AS (
  SELECT *,
         CASE WHEN trip_distance > 10 THEN 'Long Haul (>10mi)'
              WHEN trip_distance > 5 THEN 'Medium (5-10mi)'
              WHEN trip_distance > 2 THEN 'Short (2-5mi)'
              ELSE 'Very Short (<2mi)' END AS trip_category,
         CASE WHEN pickup_day_of_week IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END AS is_weekend,
         CASE WHEN trip_distance <> 0 THEN total_amount / trip_distance END AS fare_per_mile
  FROM enriched
)"""

BASIC = TRIPS + """,
known AS (SELECT * FROM zones WHERE Borough NOT IN ('Unknown', 'N/A')),
timed AS (
  SELECT *, round(date_diff('microsecond', pickup_datetime, dropoff_datetime) / 6e7::DOUBLE, 2)
            AS trip_duration_mins
  FROM trips
),
basic AS (
  SELECT t.pickup_datetime AS tpep_pickup_datetime, t.trip_duration_mins, t.trip_distance,
         t.total_amount, t.passenger_count, coalesce(t.airport_fee, 0.0::DOUBLE) AS airport_fee,
         p.Borough AS pickup_borough, d.Borough AS dropoff_borough
  FROM timed t
  JOIN known p ON t.PULocationID = p.LocationID
  JOIN known d ON t.DOLocationID = d.LocationID
  WHERE t.trip_distance > 0 AND t.total_amount > 0 AND t.passenger_count > 0
    AND t.trip_duration_mins > 1 AND t.trip_duration_mins < 240
)"""

ROWS = "count(*) AS trip_count"
FARE = "avg(total_amount) AS avg_fare"
LENGTH = "avg(trip_distance) AS avg_distance"
TIME = "round(avg(trip_duration_mins), 4) AS avg_duration_mins"
SPEED = "round(avg(speed_mph), 4) AS avg_speed_mph"

DAY = """CASE pickup_day_of_week WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday'
  WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' WHEN 7 THEN 'Saturday'
  ELSE 'Unknown' END AS day_name"""
MONTH = """CASE pickup_month WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Apr'
  WHEN 5 THEN 'May' WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul' WHEN 8 THEN 'Aug' WHEN 9 THEN 'Sep'
  WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov' WHEN 12 THEN 'Dec' ELSE 'Unknown' END AS month_name"""
HOUR = """CASE WHEN pickup_hour = 0 THEN '12 AM' WHEN pickup_hour < 12 THEN pickup_hour || ' AM'
  WHEN pickup_hour = 12 THEN '12 PM' ELSE (pickup_hour - 12) || ' PM' END AS hour_label"""

AIRPORT = "pickup_borough = 'AFRICA' OR dropoff_borough = 'AFRICA' OR airport_fee > 0"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _group(keys: str, *measures: str, where: str = "", tail: str = "") -> str:
    condition = f"WHERE {where}" if where else ""
    return _with(
        ENRICHED, f"SELECT {', '.join([keys, *measures])} FROM classified {condition} GROUP BY {keys} {tail}"
    )


def _hidden_key(key: str, label: str, *measures: str) -> str:
    return _with(
        ENRICHED,
        f"SELECT {', '.join([label, *[m.rsplit(' AS ', 1)[1] for m in measures]])} FROM "
        f"(SELECT {', '.join([key, *measures])} FROM classified GROUP BY {key})",
    )


# The means of each insight, as the reports round them.
MEANS = {
    "borough_stats": ("avg_fare", "avg_distance", "avg_duration_mins", "avg_passengers"),
    "congestion_by_hour": ("avg_speed_mph", "avg_duration_mins"),
    "yearly_trends": ("avg_fare", "avg_distance"),
    "trip_categories": ("avg_cost", "avg_distance", "avg_passengers", "avg_duration_mins"),
    "dow_patterns": ("avg_fare", "avg_speed_mph"),
    "top_routes": ("avg_fare", "avg_distance"),
    "monthly_patterns": ("avg_fare", "avg_distance", "avg_speed_mph"),
    "airport_trips": ("avg_fare", "avg_distance", "avg_duration_mins"),
    "passenger_patterns": ("avg_fare", "avg_distance", "avg_duration_mins"),
    "fare_efficiency": ("avg_fare_per_mile", "avg_fare", "avg_distance"),
    "weekend_comparison": ("avg_fare", "avg_distance", "avg_speed_mph", "avg_duration_mins"),
    "peak_hours": ("avg_fare", "avg_speed_mph"),
}


ONE_DIGIT = {"trip_categories": ("avg_passengers",)}  # rounded shorter in the reports


def _two_digits(statement: str, means: tuple[str, ...], shorter: tuple[str, ...] = ()) -> str:
    """Full means, rounded once, as decimals: halves away from zero."""
    full = re.sub(r"round\((avg\(\w+\)), 4\)", r"\1", statement)
    shown = ", ".join(f"round({c}::DECIMAL(30, 10), {1 if c in shorter else 2})::DOUBLE AS {c}" for c in means)
    return f"SELECT * REPLACE ({shown}) FROM ({full})"


def _profile(ctes: str, table: str, columns: tuple[str, ...]) -> str:
    statistics = {
        "count": "count({c})",
        "mean": "avg({c})",
        "stddev": "stddev_samp({c})",
        "min": "min({c})",
        "25%": "quantile_disc({c}, 0.25)",
        "50%": "quantile_disc({c}, 0.5)",
        "75%": "quantile_disc({c}, 0.75)",
        "max": "max({c})",
    }
    selects = [
        f"SELECT '{name}' AS summary, "
        + ", ".join(f"round(({text.format(c=c)})::DOUBLE, 4) AS {c}" for c in columns)
        + f" FROM {table}"
        for name, text in statistics.items()
    ]
    return _with(ctes, " UNION ALL ".join(selects))


def _attrition() -> str:
    rules = [
        ("distance_positive", "trip_distance > 0"),
        ("distance_cap", "trip_distance <= 3000"),
        ("amount_positive", "total_amount > 0"),
        ("amount_cap", "total_amount <= 2000"),
        ("duration_floor", "trip_duration_mins > 1"),
        ("duration_cap", "trip_duration_mins < 240"),
        ("passengers_positive", "passenger_count > 0"),
        ("passengers_cap", "passenger_count <= 5"),
        ("pickup_zone_present", "PULocationID IS NOT NULL"),
        ("dropoff_zone_present", "DOLocationID IS NOT NULL"),
        ("pickup_time_present", "pickup_datetime IS NOT NULL"),
        ("dropoff_time_present", "dropoff_datetime IS NOT NULL"),
        ("pickup_year_range", "year(pickup_datetime) BETWEEN 2011 AND 2024"),
        ("dropoff_year_range", "year(dropoff_datetime) BETWEEN 2011 AND 2024"),
    ]
    parts, earlier = [], []
    for step, (name, test) in enumerate(rules, 1):
        before = " AND ".join(earlier) or "true"
        earlier.append(f"coalesce({test}, false)")
        after = " AND ".join(earlier)
        parts.append(
            f"SELECT {step} AS step, '{name}' AS rule, "
            f"count(*) FILTER ({before}) AS rows_before, count(*) FILTER ({after}) AS rows_after, "
            f"count(*) FILTER (NOT coalesce({test}, false)) AS failing_alone, "
            f"100.0::DOUBLE * (count(*) - count(*) FILTER ({after})) / count(*) AS removed_pct FROM timed"
        )
    return _with(FILLED, " UNION ALL ".join(parts))


def _rollup() -> str:
    keys = {
        "pickup_year": ("calendar", "INTEGER"),
        "pickup_month": ("calendar", "INTEGER"),
        "pickup_day_of_week": ("clock", "INTEGER"),
        "is_weekend": ("clock", "VARCHAR"),
        "pickup_hour": ("clock", "INTEGER"),
        "has_speed": ("clock", "BOOLEAN"),
        "pickup_borough": ("route", "VARCHAR"),
        "dropoff_borough": ("route", "VARCHAR"),
        "passenger_count": ("route", "INTEGER"),
        "trip_category": ("route", "VARCHAR"),
        "has_distance": ("route", "BOOLEAN"),
        "has_airport_fee": ("route", "BOOLEAN"),
    }
    sums = {"passenger_count": "", "total_amount": "", "trip_distance": "", "trip_duration_mins": "r", "speed_mph": "r",
            "fare_per_mile": "r", "airport_fee": ""}
    measures = ["count(*) AS trip_rows", "max(trip_duration_mins) AS trip_duration_mins_max"]
    for column, inexact in sums.items():
        measures.append(f"{f'round(sum({column}), 4)' if inexact else f'sum({column})'} AS {column}_sum")
        measures.append(f"count({column}) AS {column}_n")
    selects = []
    for cells in ("calendar", "clock", "route"):
        own = [key for key, (group, _) in keys.items() if group == cells]
        shown = [key if key in own else f"NULL::{kind} AS {key}" for key, (_, kind) in keys.items()]
        selects.append(
            f"SELECT '{cells}' AS cells, {', '.join(shown + measures)} FROM flagged GROUP BY {', '.join(own)}"
        )
    flagged = """,
flagged AS (
  SELECT *, speed_mph IS NOT NULL AS has_speed, trip_distance > 0 AS has_distance,
         airport_fee > 0 AS has_airport_fee FROM classified
)"""
    return _with(ENRICHED + flagged, " UNION ALL ".join(selects))


STATS = """
ranked AS (
  SELECT {key}, value, row_number() OVER ({over} ORDER BY value) - 1 AS i,
         count(*) OVER ({over}) AS n
  FROM events
),
stats AS (
  SELECT {key}, count(*) AS samples, min(value) AS min_value, max(value) AS max_value,
         round(avg(value), 6) AS mean_value,
         max(value) FILTER (i = floor(n * 0.5::DOUBLE)) AS p50,
         max(value) FILTER (i = floor(n * 0.95::DOUBLE)) AS p95,
         max(value) FILTER (i = floor(n * 0.99::DOUBLE)) AS p99
  FROM ranked GROUP BY {key}
)"""
STATS_BY_TYPE = STATS.format(key="event_type", over="PARTITION BY event_type")
STATS_OVERALL = STATS.format(key="0 AS all_events", over="").replace("GROUP BY 0 AS all_events", "")

ZONE_JOIN = _with(
    FILLED + ", known AS (SELECT * FROM zones WHERE Borough NOT IN ('Unknown', 'N/A'))",
    """SELECT t.*, p.Borough AS pickup_borough, p.Zone AS pickup_zone, p.service_zone AS pickup_service_zone,
         d.Borough AS dropoff_borough, d.Zone AS dropoff_zone, d.service_zone AS dropoff_service_zone
       FROM filled t JOIN known p ON t.PULocationID = p.LocationID JOIN known d ON t.DOLocationID = d.LocationID""",
)
CLEAN_ROWS = _with(CLEAN, "SELECT * FROM clean")
LAID_OUT = "SELECT *, year(pickup_datetime)::INTEGER AS year, month(pickup_datetime)::INTEGER AS month FROM clean"
UNION_ROWS = _with(
    TRIPS,
    """SELECT * REPLACE (CASE WHEN year(pickup_datetime) <= 2013 THEN 0.0::DOUBLE ELSE airport_fee END
                         AS airport_fee) FROM trips""",
)
GRID = """
grid AS (SELECT y::INTEGER AS year, m::INTEGER AS month FROM range(2011, 2025) a(y), range(1, 13) b(m)),
seen AS (
  SELECT year(pickup_datetime)::INTEGER AS year, month(pickup_datetime)::INTEGER AS month, count(*) AS item_count
  FROM clean GROUP BY ALL
)"""


MONTHS = TRIPS + """,
months AS (
  SELECT strftime(pickup_datetime, '%Y-%m') AS file_month, year(pickup_datetime) AS y, month(pickup_datetime) AS m,
         count(*) AS n, (year(pickup_datetime) * 12 + month(pickup_datetime)) % 5 = 0 AS hurt
  FROM trips GROUP BY ALL
)"""


def _in_utc(moment: str) -> str:
    """A New York clock reading in UTC: summer time from the second Sunday in March to the first in November.

    A reading that the spring shift skips counts as standard time, one that the autumn shift repeats as summer time.
    """
    def sunday(month: int, day: int) -> str:
        first = f"make_date(year({moment}), {month}, {day})"
        return f"({first} + ((7 - dayofweek({first})) % 7)::INTEGER)"

    summer = f"{moment} >= {sunday(3, 8)} + INTERVAL 3 HOUR AND {moment} < {sunday(11, 1)} + INTERVAL 2 HOUR"
    return f"{moment} + CASE WHEN {summer} THEN INTERVAL 4 HOUR ELSE INTERVAL 5 HOUR END"


def statements() -> dict[str, str]:
    route = "pickup_borough, dropoff_borough"
    by_volume = f"ORDER BY trip_count DESC, {route} LIMIT"
    direct = {
        "borough_stats": _group(
            "pickup_borough", ROWS, FARE, LENGTH, TIME,
            "sum(total_amount) AS total_revenue", "avg(passenger_count) AS avg_passengers",
        ),
        "congestion_by_hour": _group("pickup_hour", SPEED, ROWS, TIME, where="speed_mph IS NOT NULL"),
        "yearly_trends": _group("pickup_year", ROWS, FARE, LENGTH, where="pickup_year BETWEEN 2011 AND 2024"),
        "trip_categories": _group(
            "trip_category", ROWS, "avg(total_amount) AS avg_cost", LENGTH,
            "avg(passenger_count) AS avg_passengers", TIME,
        ),
        "dow_patterns": _hidden_key("pickup_day_of_week", DAY, ROWS, FARE, SPEED),
        "top_routes": _group(route, ROWS, FARE, LENGTH, tail=f"{by_volume} 10"),
        "monthly_patterns": _hidden_key("pickup_month", MONTH, ROWS, FARE, LENGTH, SPEED),
        "airport_trips": _group(
            route, ROWS, FARE, LENGTH, TIME, "sum(airport_fee) AS total_airport_fees",
            where=AIRPORT, tail=f"{by_volume} 15",
        ),
        "passenger_patterns": _group("passenger_count", ROWS, FARE, LENGTH, TIME),
        "fare_efficiency": _group(
            "pickup_borough", ROWS, "round(avg(fare_per_mile), 4) AS avg_fare_per_mile", FARE, LENGTH,
            where="trip_distance > 0",
        ),
        "weekend_comparison": _group("is_weekend", ROWS, FARE, LENGTH, SPEED, TIME),
        "peak_hours": _with(
            ENRICHED,
            f"""SELECT *, {HOUR} FROM (
                  SELECT pickup_hour, {ROWS}, {FARE}, {SPEED}, sum(total_amount) AS total_revenue
                  FROM classified GROUP BY pickup_hour ORDER BY trip_count DESC, pickup_hour LIMIT 10)""",
        ),
        "baseline_borough": _with(
            BASIC,
            """SELECT pickup_borough, avg(trip_distance) AS avg_trip_distance,
                      avg(total_amount) AS avg_total_amount, max(trip_duration_mins) AS max_trip_duration,
                      count(*) AS total_trips FROM basic GROUP BY pickup_borough""",
        ),
        "one_file_standardized": _with(TRIPS, "SELECT * FROM trips"),
        "borough_counts": _with(CLEAN, "SELECT pickup_borough, count(*) AS count FROM clean GROUP BY 1"),
        "borough_means": _with(
            CLEAN,
            """SELECT pickup_borough, avg(trip_distance) AS avg_dist, avg(total_amount) AS avg_cost,
                      round(avg(trip_duration_mins), 4) AS avg_time, avg(passenger_count) AS avg_passengers,
                      avg(airport_fee) AS avg_airport_fee FROM clean GROUP BY 1""",
        ),
        "year_range": _with(
            CLEAN,
            " UNION ALL ".join(
                f"""SELECT '{stage}' AS stage,
                      min(year(pickup_datetime))::INTEGER AS min_pickup_year,
                      max(year(pickup_datetime))::INTEGER AS max_pickup_year,
                      min(year(dropoff_datetime))::INTEGER AS min_dropoff_year,
                      max(year(dropoff_datetime))::INTEGER AS max_dropoff_year FROM {table}"""
                for stage, table in (("raw", "trips"), ("clean", "clean"))
            ),
        ),
        "numeric_profile": _profile(
            CLEAN, "clean",
            ("trip_distance", "total_amount", "passenger_count", "airport_fee", "trip_duration_mins"),
        ),
        "numeric_profile_raw": _profile(
            TRIPS, "trips", ("trip_distance", "total_amount", "passenger_count", "airport_fee")
        ),
        "row_preview": _with(CLEAN, "SELECT * FROM clean ORDER BY ALL LIMIT 5"),
        "clean_basic": _with(BASIC, "SELECT * FROM basic"),
        "clean_strict": CLEAN_ROWS,
        "rule_attrition": _attrition(),
        "fill_defaults": _with(FILLED, "SELECT * FROM filled"),
        "duration_feature": _with(
            FILLED, "SELECT pickup_datetime, dropoff_datetime, trip_duration_mins FROM timed"
        ),
        "enriched": _with(ENRICHED, "SELECT * FROM enriched"),
        "zone_join_merge": ZONE_JOIN,
        "zone_join_broadcast": ZONE_JOIN,
        "standardized_union": UNION_ROWS,
        "drifting_union": UNION_ROWS,
        "partitioned_roundtrip": _with(CLEAN, LAID_OUT),
        "compact_roundtrip": _with(BASIC, "SELECT * FROM basic"),
        "coalesced_write": _with(BASIC, "SELECT * FROM basic"),
        "replaced_month": _with(CLEAN, LAID_OUT),
        "bucketed_counts": _with(CLEAN, "SELECT pickup_borough, count(*) AS trip_count FROM clean GROUP BY 1"),
        "zones_from_csv": _with(
            TRIPS, "SELECT LocationID::INTEGER AS LocationID, Borough, Zone, service_zone FROM zones"
        ),
        "pruned_year_month": _with(
            CLEAN, f"SELECT * FROM ({LAID_OUT}) WHERE year BETWEEN 2012 AND 2013 AND month IN (3, 4, 11)"
        ),
        "trip_rollup": _rollup(),
        "route_labels": _with(
            ENRICHED,
            f"""SELECT *, pickup_borough || ' → ' || dropoff_borough AS route_label,
                  CASE WHEN trip_count >= 1e6 THEN printf('%.1fM', trip_count / 1e6)
                       WHEN trip_count >= 1e3 THEN printf('%.0fK', trip_count / 1e3)
                       ELSE trip_count::VARCHAR END AS count_label
                FROM (SELECT {route}, {ROWS}, {FARE}, {LENGTH} FROM classified GROUP BY {route}
                      {by_volume} 10)""",
        ),
        "hour_labels": _with(
            ENRICHED, f"SELECT *, {HOUR} FROM (SELECT pickup_hour, {ROWS} FROM classified GROUP BY pickup_hour)"
        ),
        "weekend_share": _with(
            ENRICHED,
            """SELECT is_weekend, trip_count,
                      round(100.0::DOUBLE * trip_count / sum(trip_count) OVER (), 1) AS share_pct
               FROM (SELECT is_weekend, count(*) AS trip_count FROM classified GROUP BY is_weekend)""",
        ),
        "formatted_counts": _with(
            ENRICHED,
            """SELECT pickup_borough, format('{:,.2f}', count(*)::DOUBLE) AS trip_count,
                      format('{:,.2f}', sum(total_amount)) AS total_revenue
               FROM classified GROUP BY pickup_borough""",
        ),
        "month_coverage": _with(
            CLEAN + "," + GRID,
            """SELECT g.year, g.month, coalesce(item_count, 0) AS item_count, item_count IS NOT NULL AS present
               FROM grid g LEFT JOIN seen s ON g.year = s.year AND g.month = s.month""",
        ),
        "missing_months": _with(
            CLEAN + "," + GRID, "SELECT g.year, g.month FROM grid g ANTI JOIN seen s USING (year, month)"
        ),
        "latency_stats": _with(STATS_BY_TYPE, "SELECT * FROM stats"),
        "latency_narrowed": _with(STATS_BY_TYPE, "SELECT * FROM stats"),
        "latency_overall": _with(STATS_OVERALL, "SELECT * EXCLUDE (all_events) FROM stats"),
        "tail_class": _with(
            STATS_BY_TYPE,
            """SELECT *, CASE WHEN tail_ratio > 3 THEN 'high' WHEN tail_ratio > 2 THEN 'moderate'
                              ELSE 'good' END AS tail_class
               FROM (SELECT event_type, p50, p99, CASE WHEN p50 > 0 THEN p99 / p50 ELSE 0.0::DOUBLE END AS tail_ratio
                     FROM stats)""",
        ),
        "latency_slowest": """
            SELECT event_type, event_id, value, position::INTEGER AS position FROM (
              SELECT event_type, event_id, value,
                     row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS position
              FROM events) WHERE position <= 3""",
        "slowest_overall": "SELECT event_type, event_id, value FROM events ORDER BY value DESC, event_id LIMIT 3",
        "streamed_clean": _with(CLEAN, LAID_OUT),
        "streamed_batches": _with(CLEAN, LAID_OUT),
        "elapsed_duration": _with(
            TRIPS,
            f"""SELECT pickup_datetime, dropoff_datetime,
                       round(date_diff('microsecond', {_in_utc("pickup_datetime")}, {_in_utc("dropoff_datetime")}) / 6e7::DOUBLE, 2)
                         AS trip_duration_mins
                FROM trips""",
        ),
        "skip_damaged": _with(
            MONTHS,
            """SELECT file_month, CASE WHEN hurt THEN 'damaged' ELSE 'sound' END AS verdict,
                      CASE WHEN hurt THEN 0 ELSE n END AS trips FROM months""",
        ),
        "eras_by_name": f"SELECT * FROM ({UNION_ROWS}) WHERE year(pickup_datetime) BETWEEN 2011 AND 2036",
        "ingest_remainder": _with(
            MONTHS,
            """SELECT file_month, CASE WHEN hurt THEN 'damaged' ELSE 'a month of no era' END AS reason
               FROM months WHERE hurt OR y < 2011 OR y > 2036""",
        ),
        "schema_runs_by_month": _with(
            MONTHS,
            """SELECT run::BIGINT AS run, min(file_month) AS first_month, max(file_month) AS last_month, count(*) AS files
               FROM (SELECT *, sum(begins) OVER (ORDER BY file_month) AS run
                     FROM (SELECT *, CASE WHEN kind IS DISTINCT FROM lag(kind) OVER (ORDER BY file_month) THEN 1 ELSE 0 END AS begins
                           FROM (SELECT *, CASE WHEN y <= 2013 THEN 'text times' WHEN y > 2016 THEN 'long' WHEN m % 2 = 1 THEN 'lower' ELSE 'upper' END AS kind
                                 FROM months)))
               GROUP BY run""",
        ),
        "incremental_months": _with(
            CLEAN,
            f"""SELECT * REPLACE (CASE WHEN year <= 2013 THEN 0.0::DOUBLE ELSE airport_fee END AS airport_fee)
                FROM ({LAID_OUT}) WHERE NOT (year = 2013 AND month = 1)""",
        ),
        "streamed_hourly_counts": _with(
            CLEAN,
            """SELECT date_trunc('hour', pickup_datetime)::TIMESTAMP AS hour_start, pickup_borough,
                      count(*) AS trip_count
               FROM clean GROUP BY 1, 2""",
        ),
    }
    for key in ("pickup_year", "pickup_month", "pickup_hour", "pickup_day_of_week"):
        name = f"passengers_by_{key.removeprefix('pickup_')}_rollup"
        direct[name] = _with(
            ENRICHED, f"SELECT {key}, avg(passenger_count) AS avg_passengers FROM classified GROUP BY 1"
        )
    for name, means in MEANS.items():
        direct[f"{name}_2_digits"] = _two_digits(direct[name], means, ONE_DIGIT.get(name, ()))
    direct["written_report"] = direct["borough_stats_2_digits"]
    again = ("borough_stats", "yearly_trends", "weekend_comparison")
    return direct | {f"{name}_rollup": direct[name] for name in again}
