"""DuckDB SQL that recomputes every checked product from the test tables.

Written independently of the Spark code path: the raw feeds are rebuilt from
the pre-registered views with the rules of ``lakemart.sources.testfeeds``,
then cleaned, modelled and reported in plain SQL. Translation notes:

* day of week: DuckDB counts from 0 = Sunday, Spark from 1 = Sunday;
* whole years between two times: Spark's ``months_between`` rule written
  out (``_years_between``), then floor(months / 12), so negative ages match
  too;
* ride seconds are exact integers here (epoch microseconds // 10^6), and all
  rounding is HALF_UP on exact integers, as in ``lakemart.functions.exact``;
* money is DECIMAL(38,2) on both sides.
"""

from __future__ import annotations

TS_FMT = "%Y-%m-%d %H:%M:%S.%f"


def _half_up(num: str, den: str) -> str:
    """round(num / den) to an integer, halves away from zero; NULL when den is 0."""
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"NULLIF(CAST(({den}) AS HUGEINT), 0)"
    return f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))"


def minutes(seconds: str, count: str = "1") -> str:
    """round(seconds / 60 / count, 2) as DOUBLE."""
    return f"(CAST({_half_up(f'100 * ({seconds})', f'60 * ({count})')} AS DOUBLE) / 100.0::DOUBLE)"


def ratio(num: str, den: str) -> str:
    """round(num / den, 2) as DOUBLE."""
    return f"(CAST({_half_up(f'100 * ({num})', den)} AS DOUBLE) / 100.0::DOUBLE)"


def money(amount: str) -> str:
    return f"CAST(({amount}) AS DECIMAL(38,2))"


def money_mean(amount_sum: str, count: str) -> str:
    """round(round(sum / count, 6), 2): Spark's decimal avg, then the report's round."""
    cents = f"CAST(({amount_sum}) * 100 AS HUGEINT)"
    micro = _half_up(f"{cents} * 10000", count)
    out = _half_up(micro, "10000")
    return f"CAST(CAST({out} AS DOUBLE) / 100.0::DOUBLE AS DECIMAL(38,2))"


def money_ratio(amount_sum: str, count: str) -> str:
    cents = f"CAST(({amount_sum}) * 100 AS HUGEINT)"
    return f"CAST(CAST({_half_up(cents, count)} AS DOUBLE) / 100.0::DOUBLE AS DECIMAL(38,2))"


def _years_between(later: str, earlier: str) -> str:
    """floor(months_between(later, earlier) / 12) as Spark defines it.

    Whole months when both days of month are equal or both are month ends;
    otherwise the difference in whole seconds counts against 31-day months,
    and the month count is rounded to 8 places (half up) before the floor."""
    def day_secs(t):
        return f"(hour({t}) * 3600 + minute({t}) * 60 + second({t}))"

    months = f"((year({later}) * 12 + month({later})) - (year({earlier}) * 12 + month({earlier})))"
    same_day = (f"(day({later}) = day({earlier}) OR (day({later}) = day(last_day({later})) "
                f"AND day({earlier}) = day(last_day({earlier}))))")
    frac = (f"(((day({later}) - day({earlier})) * 86400 + {day_secs(later)} - {day_secs(earlier)})"
            f" / 2678400.0::DOUBLE)")
    exact = f"(CASE WHEN {same_day} THEN {months}::DOUBLE ELSE {months} + {frac} END)"
    rounded = f"(floor({exact} * 1e8 + 0.5::DOUBLE) / 1e8)"
    return f"CAST(floor({rounded} / 12) AS BIGINT)"


def _date_key(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS BIGINT)"


def _id(t: str) -> str:
    """An id by the stated rule: whole digits, else a decimal with its fraction cut off."""
    return (f"(CASE WHEN regexp_matches(trim({t}), '^[+-]?[0-9]+$') THEN TRY_CAST(trim({t}) AS BIGINT) "
            f"ELSE CAST(trunc(TRY_CAST(trim({t}) AS DECIMAL(38,9))) AS BIGINT) END)")


def _id_text(k: str) -> str:
    return f"CASE WHEN {k} % 30 = 7 THEN CAST({k} AS VARCHAR) || '.0' ELSE CAST({k} AS VARCHAR) END"


def _epoch_s(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000000)"


def _ts_text(ts: str) -> str:
    return f"strftime({ts}, '{TS_FMT}')"


# ----------------------------------------------------------------- the chain

RAW = f"""
raw_stations AS (
    SELECT CAST(s.s_suppkey AS VARCHAR) AS _c0, n.n_name AS _c1,
           '41.' || lpad(CAST(s.s_suppkey % 1000 AS VARCHAR), 3, '0') AS _c2,
           '-87.' || lpad(CAST((s.s_suppkey * 37) % 1000 AS VARCHAR), 3, '0') AS _c3
    FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
    UNION ALL
    SELECT CAST(s.s_suppkey AS VARCHAR), n.n_name || ' ANNEX',
           '42.' || lpad(CAST(s.s_suppkey % 1000 AS VARCHAR), 3, '0'),
           '-87.' || lpad(CAST((s.s_suppkey * 37) % 1000 AS VARCHAR), 3, '0')
    FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
    WHERE s.s_suppkey % 20 = 0
),
cust AS (
    SELECT c_custkey AS k, c_name, c_nationkey, c_mktsegment,
           CASE WHEN c_custkey % 50 = 49 THEN 'x' || CAST(c_custkey AS VARCHAR)
                ELSE {_id_text('c_custkey')} END AS id_text,
           DATE '1950-01-01' + CAST((c_custkey * 173) % 14000 AS INTEGER) AS bday,
           DATE '2013-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS acct_start
    FROM customer
),
raw_riders AS (
    SELECT id_text AS _c0, split_part(c_name, '#', 1) AS _c1, split_part(c_name, '#', 2) AS _c2,
           'Nation ' || CAST(c_nationkey AS VARCHAR) AS _c3,
           CASE WHEN k % 41 = 0 THEN 'not-a-date' ELSE CAST(bday AS VARCHAR) END AS _c4,
           CAST(acct_start AS VARCHAR) AS _c5,
           CASE WHEN k % 3 = 0 THEN CAST(acct_start + CAST(k % 700 + 1 AS INTEGER) AS VARCHAR) END AS _c6,
           CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'true'
                WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE 'false' END AS _c7
    FROM cust
    UNION ALL
    SELECT id_text, 'Ann', split_part(c_name, '#', 2), 'Elsewhere',
           CAST(bday + 1 AS VARCHAR), CAST(acct_start AS VARCHAR), NULL, 'true'
    FROM cust WHERE k % 20 = 0
),
raw_payments AS (
    SELECT CAST(o_orderkey + CASE WHEN o_orderkey % 37 = 0 THEN 3000000000 ELSE 0 END AS VARCHAR) AS _c0,
           CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS _c1,
           CASE WHEN o_orderkey % 101 = 0 THEN 'n/a'
                ELSE CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS _c2,
           CASE WHEN o_orderkey % 107 = 0 THEN 'x' ELSE {_id_text('o_custkey')} END AS _c3
    FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderkey % 109 = 0 THEN 100000000000 ELSE 0 END AS cents FROM orders)
),
line_times AS (
    SELECT l.*, o.o_custkey,
           l.l_shipdate + to_seconds(CAST((l.l_orderkey * 7919 + l.l_linenumber * 131) % 86400 AS BIGINT)) AS t0
    FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
),
line_times2 AS (
    SELECT *, t0 + to_seconds(CAST(floor(l_quantity * l_linenumber * 60) AS BIGINT)) AS t1 FROM line_times
),
raw_trips AS (
    SELECT CASE WHEN event_id % 83 = 0 THEN NULL ELSE 'E' || CAST(event_id AS VARCHAR) END AS _c0,
           event_type AS _c1,
           CASE WHEN event_id % 97 = 0 THEN 'not-a-time' ELSE {_ts_text('ts')} END AS _c2,
           {_ts_text('ts + to_seconds(CAST(floor(value * 60) AS BIGINT))')} AS _c3,
           CASE WHEN event_id % 71 = 0 THEN NULL ELSE json_extract_string(props, '$.k') END AS _c4,
           CAST((CAST(json_extract_string(props, '$.k') AS BIGINT) * 7 + event_id) % 110 AS VARCHAR) AS _c5,
           CASE WHEN event_id % 89 = 0 THEN 'x' ELSE {_id_text('user_id')} END AS _c6
    FROM events
    UNION ALL
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR),
           CASE l_returnflag WHEN 'R' THEN 'electric_bike' WHEN 'A' THEN 'docked_bike' ELSE 'classic_bike' END,
           {_ts_text('CASE WHEN l_orderkey % 61 = 0 THEN t1 ELSE t0 END')},
           {_ts_text('CASE WHEN l_orderkey % 61 = 0 THEN t0 ELSE t1 END')},
           CAST(l_suppkey AS VARCHAR), CAST(l_partkey % 110 AS VARCHAR), CAST(o_custkey AS VARCHAR)
    FROM line_times2
)
"""

# Everything after the raw feeds: reads views or CTEs named raw_stations,
# raw_riders, raw_payments, raw_trips with all-text columns _c0.._cN.
MODEL = f"""
silver_stations AS (
    SELECT _c0 AS station_id, _c1 AS name, TRY_CAST(_c2 AS DOUBLE) AS latitude,
           TRY_CAST(_c3 AS DOUBLE) AS longitude
    FROM raw_stations WHERE _c0 IS NOT NULL
),
silver_riders AS (
    SELECT * FROM (
        SELECT {_id('_c0')} AS rider_id, _c1 AS first, _c2 AS last, _c3 AS address,
               TRY_CAST(_c4 AS DATE) AS birthday, TRY_CAST(_c5 AS DATE) AS account_start_date,
               TRY_CAST(_c6 AS DATE) AS account_end_date, TRY_CAST(_c7 AS BOOLEAN) AS is_member
        FROM raw_riders)
    WHERE rider_id IS NOT NULL
),
silver_payments AS (
    SELECT * FROM (
        SELECT {_id('_c0')} AS payment_id, TRY_CAST(_c1 AS DATE) AS payment_date,
               TRY_CAST(_c2 AS DECIMAL(18,2)) AS amount, {_id('_c3')} AS rider_id
        FROM raw_payments)
    WHERE payment_id IS NOT NULL AND rider_id IS NOT NULL
),
silver_trips_x AS (
    SELECT *, {_epoch_s('ended_at')} - {_epoch_s('started_at')} AS dur_s FROM (
        SELECT _c0 AS trip_id, _c1 AS rideable_type, TRY_CAST(_c2 AS TIMESTAMP) AS started_at,
               TRY_CAST(_c3 AS TIMESTAMP) AS ended_at, _c4 AS start_station_id, _c5 AS end_station_id,
               {_id('_c6')} AS rider_id
        FROM raw_trips)
    WHERE trip_id IS NOT NULL AND started_at IS NOT NULL AND ended_at IS NOT NULL AND rider_id IS NOT NULL
),
silver_trips AS (
    SELECT trip_id, rideable_type, started_at, ended_at, start_station_id, end_station_id, rider_id,
           CAST(dur_s AS DOUBLE) / 60.0::DOUBLE AS trip_duration_minutes, dur_s
    FROM silver_trips_x
),
dim_rider AS (
    SELECT rider_id, first, last, birthday, account_start_date, account_end_date, is_member FROM (
        SELECT *, row_number() OVER (PARTITION BY rider_id ORDER BY
            first ASC NULLS FIRST, last ASC NULLS FIRST, birthday ASC NULLS FIRST,
            account_start_date ASC NULLS FIRST, account_end_date ASC NULLS FIRST,
            is_member ASC NULLS FIRST) AS rn
        FROM silver_riders)
    WHERE rn = 1
),
dim_station AS (
    SELECT station_id, name, latitude, longitude FROM (
        SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY
            name ASC NULLS FIRST, latitude ASC NULLS FIRST, longitude ASC NULLS FIRST) AS rn
        FROM silver_stations)
    WHERE rn = 1
),
all_dates AS (
    SELECT DISTINCT d AS date FROM (
        SELECT CAST(started_at AS DATE) AS d FROM silver_trips
        UNION ALL SELECT CAST(ended_at AS DATE) FROM silver_trips
        UNION ALL SELECT payment_date FROM silver_payments)
    WHERE d IS NOT NULL
),
dim_date AS (
    SELECT {_date_key('date')} AS date_key, date,
           CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
           CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
           CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week
    FROM all_dates
),
fact_trip AS (
    SELECT t.trip_id, t.rider_id, t.start_station_id, t.end_station_id,
           {_date_key('CAST(t.started_at AS DATE)')} AS start_date_key,
           {_date_key('CAST(t.ended_at AS DATE)')} AS end_date_key,
           t.rideable_type, t.trip_duration_minutes,
           {_years_between('t.started_at', 'CAST(r.birthday AS TIMESTAMP)')} AS rider_age_at_trip,
           t.dur_s
    FROM silver_trips t LEFT JOIN dim_rider r ON t.rider_id = r.rider_id
),
fact_payment AS (
    SELECT payment_id, rider_id, {_date_key('payment_date')} AS payment_date_key, amount AS payment_amount
    FROM silver_payments
),
rides_monthly_x AS (
    SELECT ft.rider_id, d.year, d.month, count(*) AS rides, sum(ft.dur_s) AS secs
    FROM fact_trip ft LEFT JOIN dim_date d ON ft.start_date_key = d.date_key
    GROUP BY ft.rider_id, d.year, d.month
),
spend_monthly_x AS (
    SELECT fp.rider_id, d.year, d.month, sum(fp.payment_amount) AS amt
    FROM fact_payment fp LEFT JOIN dim_date d ON fp.payment_date_key = d.date_key
    GROUP BY fp.rider_id, d.year, d.month
),
spend_rides_x AS (
    SELECT p.rider_id, p.year, p.month, p.amt, r.rides, r.secs
    FROM spend_monthly_x p LEFT JOIN rides_monthly_x r
      ON p.rider_id = r.rider_id AND p.year = r.year AND p.month = r.month
)
"""

RIDE_AVG = f"count(*) AS ride_count, {minutes('sum(ft.dur_s)', 'count(ft.dur_s)')} AS avg_trip_minutes"
RIDE_TOTAL = f"{minutes('sum(ft.dur_s)')} AS total_trip_minutes"
PAY = (
    "count(*) AS payment_count, "
    f"{money('sum(fp.payment_amount)')} AS total_amount, "
    f"{money_mean('sum(fp.payment_amount)', 'count(fp.payment_amount)')} AS avg_payment_amount"
)
MEMBER = "CASE WHEN r.is_member = true THEN 'member' ELSE 'casual' END"
START_AGE = _years_between("CAST(r.account_start_date AS TIMESTAMP)", "CAST(r.birthday AS TIMESTAMP)")

FINAL = {
    "clean_stations": "SELECT * FROM silver_stations",
    "clean_riders": "SELECT * FROM silver_riders",
    "clean_payments": "SELECT * FROM silver_payments",
    "clean_trips": "SELECT * EXCLUDE (dur_s) FROM silver_trips",
    "clean_trips_streamed": "SELECT * EXCLUDE (dur_s) FROM silver_trips",
    "dim_rider": "SELECT * FROM dim_rider",
    "dim_station": "SELECT * FROM dim_station",
    "dim_date": "SELECT * FROM dim_date",
    "fact_trip": "SELECT * EXCLUDE (dur_s) FROM fact_trip",
    "fact_payment": "SELECT * FROM fact_payment",
    "rides_by_year_month_dow": f"""
        SELECT d.year, d.month, d.day_of_week, {RIDE_AVG}, {RIDE_TOTAL}
        FROM fact_trip ft LEFT JOIN dim_date d ON ft.start_date_key = d.date_key
        GROUP BY d.year, d.month, d.day_of_week""",
    "rides_by_hour": f"""
        SELECT CAST(hour(ft.started_at) AS INTEGER) AS hour_of_day, {RIDE_AVG}
        FROM silver_trips ft GROUP BY 1""",
    "rides_by_hour_total": f"""
        SELECT CAST(hour(ft.started_at) AS INTEGER) AS hour_of_day, {RIDE_AVG}, {RIDE_TOTAL}
        FROM silver_trips ft GROUP BY 1""",
    "rides_by_station_pair": f"""
        SELECT ss.name AS start_station, es.name AS end_station, {RIDE_AVG}
        FROM fact_trip ft
        LEFT JOIN dim_station ss ON ft.start_station_id = ss.station_id
        LEFT JOIN dim_station es ON ft.end_station_id = es.station_id
        GROUP BY ss.name, es.name""",
    "rides_by_age_member": f"""
        SELECT {MEMBER} AS member_type, ft.rider_age_at_trip, {RIDE_AVG}
        FROM fact_trip ft LEFT JOIN dim_rider r ON ft.rider_id = r.rider_id
        GROUP BY 1, 2""",
    "payments_by_month": f"""
        SELECT d.year, d.quarter, d.month, {PAY}
        FROM fact_payment fp LEFT JOIN dim_date d ON fp.payment_date_key = d.date_key
        GROUP BY d.year, d.quarter, d.month""",
    "spend_by_rider": f"""
        SELECT fp.rider_id, {START_AGE} AS age_at_account_start,
               {money('sum(fp.payment_amount)')} AS total_amount
        FROM fact_payment fp LEFT JOIN dim_rider r ON fp.rider_id = r.rider_id
        GROUP BY 1, 2""",
    "rides_monthly": f"""
        SELECT rider_id, year, month, rides AS rides_per_month, {minutes('secs')} AS minutes_per_month
        FROM rides_monthly_x""",
    "spend_monthly": f"""
        SELECT rider_id, year, month, {money('amt')} AS spend_per_month FROM spend_monthly_x""",
    "spend_and_rides_monthly": f"""
        SELECT rider_id, year, month, {money('amt')} AS spend_per_month,
               coalesce(rides, 0) AS rides_per_month,
               coalesce({minutes('secs')}, 0.0::DOUBLE) AS minutes_per_month
        FROM spend_rides_x""",
    "rides_by_day": f"""
        SELECT d.date, {RIDE_AVG}, {RIDE_TOTAL}
        FROM fact_trip ft LEFT JOIN dim_date d ON ft.start_date_key = d.date_key
        GROUP BY d.date""",
    "rides_by_year": f"""
        SELECT d.year, {RIDE_AVG}, {RIDE_TOTAL}
        FROM fact_trip ft LEFT JOIN dim_date d ON ft.start_date_key = d.date_key
        GROUP BY d.year""",
    "rides_by_start_station": f"""
        SELECT ss.name AS start_station, {RIDE_AVG}
        FROM fact_trip ft LEFT JOIN dim_station ss ON ft.start_station_id = ss.station_id
        GROUP BY ss.name""",
    "rides_by_end_station": f"""
        SELECT es.name AS end_station, {RIDE_AVG}
        FROM fact_trip ft LEFT JOIN dim_station es ON ft.end_station_id = es.station_id
        GROUP BY es.name""",
    "rides_by_age": f"""
        SELECT ft.rider_age_at_trip, {RIDE_AVG} FROM fact_trip ft GROUP BY 1""",
    "rides_by_member": f"""
        SELECT {MEMBER} AS member_type, {RIDE_AVG}
        FROM fact_trip ft LEFT JOIN dim_rider r ON ft.rider_id = r.rider_id
        GROUP BY 1""",
    "payments_rollup": f"""
        SELECT d.year, d.quarter, d.month,
               CAST(GROUPING(d.year, d.quarter, d.month) AS INTEGER) AS grouping_level, {PAY}
        FROM fact_payment fp LEFT JOIN dim_date d ON fp.payment_date_key = d.date_key
        GROUP BY ROLLUP (d.year, d.quarter, d.month)""",
    "spend_by_start_age": f"""
        SELECT {START_AGE} AS age_at_account_start, count(DISTINCT fp.rider_id) AS rider_count, {PAY}
        FROM fact_payment fp LEFT JOIN dim_rider r ON fp.rider_id = r.rider_id
        GROUP BY 1""",
    "spend_vs_avg_rides": f"""
        SELECT rider_id, count(*) AS months_paid, {money('sum(amt)')} AS total_spend,
               {money_ratio('sum(amt)', 'count(*)')} AS avg_monthly_spend,
               {ratio('sum(coalesce(rides, 0))', 'count(*)')} AS avg_rides_per_month,
               {minutes('sum(coalesce(secs, 0))', 'count(*)')} AS avg_minutes_per_month
        FROM spend_rides_x GROUP BY rider_id""",
    "raw_csv_scan": """
        SELECT 'stations' AS feed, _c0, _c1, _c2, _c3, NULL::VARCHAR AS _c4, NULL::VARCHAR AS _c5,
               NULL::VARCHAR AS _c6, NULL::VARCHAR AS _c7 FROM raw_stations
        UNION ALL SELECT 'riders', _c0, _c1, _c2, _c3, _c4, _c5, _c6, _c7 FROM raw_riders
        UNION ALL SELECT 'payments', _c0, _c1, _c2, _c3, NULL, NULL, NULL, NULL FROM raw_payments
        UNION ALL SELECT 'trips', _c0, _c1, _c2, _c3, _c4, _c5, _c6, NULL FROM raw_trips""",
    "layer_row_counts": """
        SELECT 'bronze.stations' AS table_name, count(*) AS row_count FROM raw_stations
        UNION ALL SELECT 'bronze.riders', count(*) FROM raw_riders
        UNION ALL SELECT 'bronze.payments', count(*) FROM raw_payments
        UNION ALL SELECT 'bronze.trips', count(*) FROM raw_trips
        UNION ALL SELECT 'silver.stations', count(*) FROM silver_stations
        UNION ALL SELECT 'silver.riders', count(*) FROM silver_riders
        UNION ALL SELECT 'silver.payments', count(*) FROM silver_payments
        UNION ALL SELECT 'silver.trips', count(*) FROM silver_trips
        UNION ALL SELECT 'gold.dim_rider', count(*) FROM dim_rider
        UNION ALL SELECT 'gold.dim_station', count(*) FROM dim_station
        UNION ALL SELECT 'gold.dim_date', count(*) FROM dim_date
        UNION ALL SELECT 'gold.fact_trip', count(*) FROM fact_trip
        UNION ALL SELECT 'gold.fact_payment', count(*) FROM fact_payment""",
    "rejected_rows": f"""
        SELECT feed, missing_key, count(*) AS row_count FROM (
            SELECT 'stations' AS feed, CASE WHEN _c0 IS NULL THEN 'station_id' END AS missing_key FROM raw_stations
            UNION ALL SELECT 'riders', CASE WHEN {_id('_c0')} IS NULL THEN 'rider_id' END FROM raw_riders
            UNION ALL SELECT 'payments', CASE WHEN {_id('_c0')} IS NULL THEN 'payment_id'
                WHEN {_id('_c3')} IS NULL THEN 'rider_id' END FROM raw_payments
            UNION ALL SELECT 'trips', CASE WHEN _c0 IS NULL THEN 'trip_id' WHEN TRY_CAST(_c2 AS TIMESTAMP) IS NULL THEN 'started_at'
                WHEN TRY_CAST(_c3 AS TIMESTAMP) IS NULL THEN 'ended_at' WHEN {_id('_c6')} IS NULL THEN 'rider_id' END FROM raw_trips)
        WHERE missing_key IS NOT NULL GROUP BY 1, 2""",
    "gold_row_counts": """
        SELECT 'gold.dim_rider' AS table_name, count(*) AS row_count FROM dim_rider
        UNION ALL SELECT 'gold.dim_station', count(*) FROM dim_station
        UNION ALL SELECT 'gold.dim_date', count(*) FROM dim_date
        UNION ALL SELECT 'gold.fact_trip', count(*) FROM fact_trip
        UNION ALL SELECT 'gold.fact_payment', count(*) FROM fact_payment""",
}

_WIDTHS = {"stations": 4, "riders": 8, "payments": 4, "trips": 7}


def _damaged(feed: str) -> str:
    """Lines with two fields too many (md5 digit 0), or without their last one (1)."""
    width = _WIDTHS[feed]
    digit = "substr(md5(coalesce(_c0, '')), 1, 1)"

    def line(n: int) -> str:
        return " || ',' || ".join(f"coalesce(_c{i}, '')" for i in range(n))

    return f"""
        SELECT '{feed}' AS feed,
               CASE WHEN {digit} = '0' THEN {line(width)} || ',EXTRA,"a, b"' ELSE {line(width - 1)} END AS line,
               CAST(CASE WHEN {digit} = '0' THEN {width + 2} ELSE {width - 1} END AS INTEGER) AS n_fields,
               CAST({width} AS INTEGER) AS n_expected, _c0 AS first_field
        FROM raw_{feed} WHERE {digit} IN ('0', '1')"""


def _quarantined(feed: str, checks: list[tuple[str, str, str]]) -> str:
    """Rows with a reason: (key, raw field, typed expression) of each required key."""
    whys = ", ".join(
        f"CASE WHEN {raw} IS NULL THEN '{key} missing' WHEN ({typed}) IS NULL THEN '{key} unreadable' END" for key, raw, typed in checks
    )
    cols = ", ".join(f"_c{i}" if i < _WIDTHS[feed] else f"NULL::VARCHAR AS _c{i}" for i in range(8))
    return f"SELECT * FROM (SELECT '{feed}' AS feed, {cols}, concat_ws('; ', {whys}) AS reasons FROM raw_{feed}) WHERE reasons <> ''"


FINAL |= {
    "csv_damaged_lines": " UNION ALL ".join(_damaged(f) for f in _WIDTHS),
    "quarantined_rows": " UNION ALL ".join([
        _quarantined("stations", [("station_id", "_c0", "_c0")]),
        _quarantined("riders", [("rider_id", "_c0", _id("_c0"))]),
        _quarantined("payments", [("payment_id", "_c0", _id("_c0")), ("rider_id", "_c3", _id("_c3"))]),
        _quarantined("trips", [("trip_id", "_c0", "_c0"), ("started_at", "_c2", "TRY_CAST(_c2 AS TIMESTAMP)"),
                               ("ended_at", "_c3", "TRY_CAST(_c3 AS TIMESTAMP)"), ("rider_id", "_c6", _id("_c6"))]),
    ]),
    "write_audit": FINAL["layer_row_counts"],
    "rides_by_day_incremental": FINAL["rides_by_day"],
    "rides_by_year_month_dow_incremental": FINAL["rides_by_year_month_dow"],
    "payments_by_month_incremental": FINAL["payments_by_month"],
    "fact_trip_streamed": FINAL["fact_trip"],
    "dim_rider_streamed": FINAL["dim_rider"],
}

RAW_ONLY = {"raw_csv_scan"}


def sql_for(name: str) -> str:
    """The product's SQL over the test tables."""
    return f"WITH {RAW},\n{MODEL}\n{FINAL[name]}"


def model_sql_for(name: str) -> str:
    """The product's SQL over raw feeds already registered as views raw_*."""
    return f"WITH {MODEL}\n{FINAL[name]}"


ORACLE_SQL: dict[str, str] = {name: sql_for(name) for name in FINAL}
