"""The driver's test tables presented as the four raw feeds.

The package's input is four header-less CSV feeds (stations, riders, payments,
trips). The test data is a set of parquet tables, so this module derives raw
text rows of each feed from them, with Spark, over the whole tables. The same
rules are written in SQL in ``lakemart.testing.oracle`` for the DuckDB check;
the two must stay in step.

* stations  <- supplier LEFT JOIN nation: id = s_suppkey, name = n_name (many
  suppliers share a nation, so same-named stations exist), latitude and
  longitude text made from the key; every 20th key is sent twice, the copy
  with another name and latitude (duplicate keys for the dimension).
* riders    <- customer, every row: names from c_name; dates made from the
  key; is_member from the market segment (FURNITURE gives no value); every
  20th key is sent twice; every 41st key has an unparsable birthday; keys
  with c_custkey % 50 = 49 carry an unparsable id, so the silver step drops
  them and their trips and payments become orphans.
  Riders' ids are written as decimals (``7.0``) where k % 30 = 7, here, in
  payments and in event trips.
* payments  <- orders: id (every 37th past 2^31), date, amount text from whole
  cents (every 109th past 10^8), customer;
  every 101st has a bad amount, every 103rd no date, every 107th a bad rider.
* trips     <- events (start = ts, end = ts + floor(value * 60) s, stations
  from props.k, some dirty rows) UNION ALL lineitem JOIN orders (start =
  l_shipdate + a time of day made from the keys, end = start + quantity *
  linenumber minutes, every 61st line has start and end swapped so the ride
  time is negative; rider = o_custkey).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# --- fixed values of the mapping (mirrored in lakemart.testing.oracle).
ORPHAN_RIDER_MOD, ORPHAN_RIDER_REM = 50, 49
DUP_KEY_MOD = 20
BAD_BIRTHDAY_MOD = 41
BAD_AMOUNT_MOD, NO_PAY_DATE_MOD, BAD_PAY_RIDER_MOD = 101, 103, 107
NULL_TRIP_ID_MOD, BAD_RIDER_MOD, BAD_START_MOD, NO_START_STATION_MOD = 83, 89, 97, 71
SWAPPED_TIMES_MOD = 61
STATION_SPAN = 110
# ids written as decimals, ids past 2^31, amounts past 10^8
DECIMAL_ID_MOD, DECIMAL_ID_REM = 30, 7
WIDE_ID_MOD, WIDE_ID_SHIFT = 37, 3_000_000_000
LARGE_AMOUNT_MOD, LARGE_AMOUNT_CENTS = 109, 100_000_000_000
# first hex digit of rows that get surplus fields, and of rows that lose their last one
DAMAGE_DIGITS = ("0", "1")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _id_text(k: Column) -> Column:
    """The id as text; some ids as an export of a nullable integer column writes them."""
    return F.when(k % DECIMAL_ID_MOD == DECIMAL_ID_REM, F.concat(_text(k), F.lit(".0"))).otherwise(_text(k))


def _digits(c: Column, width: int) -> Column:
    return F.lpad(_text(c), width, "0")


def _ts_text(c: Column) -> Column:
    return F.date_format(c, TS_TEXT)


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def stations_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = s.join(n, s["s_nationkey"] == n["n_nationkey"], "left")
    k = F.col("s_suppkey")
    longitude = F.concat(F.lit("-87."), _digits((k * 37) % 1000, 3))
    first = base.select(
        _text(k).alias("_c0"),
        F.col("n_name").alias("_c1"),
        F.concat(F.lit("41."), _digits(k % 1000, 3)).alias("_c2"),
        longitude.alias("_c3"),
    )
    copy = base.where(k % DUP_KEY_MOD == 0).select(
        _text(k).alias("_c0"),
        F.concat(F.col("n_name"), F.lit(" ANNEX")).alias("_c1"),
        F.concat(F.lit("42."), _digits(k % 1000, 3)).alias("_c2"),
        longitude.alias("_c3"),
    )
    return first.unionByName(copy)


def riders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    k = F.col("c_custkey")
    rider_text = F.when(k % ORPHAN_RIDER_MOD == ORPHAN_RIDER_REM, F.concat(F.lit("x"), _text(k))).otherwise(_id_text(k))
    birthday = F.date_add(F.lit("1950-01-01").cast("date"), ((k * 173) % 14000).cast("int"))
    start = F.date_add(F.lit("2013-01-01").cast("date"), (k % 3000).cast("int"))
    end = F.when(k % 3 == 0, F.date_add(start, (k % 700 + 1).cast("int")))
    seg = F.col("c_mktsegment")
    member = (
        F.when(seg.isin("BUILDING", "HOUSEHOLD"), F.lit("true"))
        .when(seg == "FURNITURE", F.lit(None).cast("string"))
        .otherwise(F.lit("false"))
    )
    first = c.select(
        rider_text.alias("_c0"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("_c1"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("_c2"),
        F.concat(F.lit("Nation "), _text(F.col("c_nationkey"))).alias("_c3"),
        F.when(k % BAD_BIRTHDAY_MOD == 0, F.lit("not-a-date")).otherwise(_text(birthday)).alias("_c4"),
        _text(start).alias("_c5"),
        _text(end).alias("_c6"),
        member.alias("_c7"),
    )
    copy = c.where(k % DUP_KEY_MOD == 0).select(
        rider_text.alias("_c0"),
        F.lit("Ann").alias("_c1"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("_c2"),
        F.lit("Elsewhere").alias("_c3"),
        _text(F.date_add(birthday, 1)).alias("_c4"),
        _text(start).alias("_c5"),
        F.lit(None).cast("string").alias("_c6"),
        F.lit("true").alias("_c7"),
    )
    return first.unionByName(copy)


def payments_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    cents = cents + F.when(k % LARGE_AMOUNT_MOD == 0, LARGE_AMOUNT_CENTS).otherwise(0)
    payment = k + F.when(k % WIDE_ID_MOD == 0, WIDE_ID_SHIFT).otherwise(0)
    amount = F.concat(_text(F.floor(cents / 100).cast("long")), F.lit("."), _digits(cents % 100, 2))
    return o.select(
        _text(payment).alias("_c0"),
        F.when(k % NO_PAY_DATE_MOD == 0, F.lit(None).cast("string"))
        .otherwise(_text(F.to_date("o_orderdate"))).alias("_c1"),
        F.when(k % BAD_AMOUNT_MOD == 0, F.lit("n/a")).otherwise(amount).alias("_c2"),
        F.when(k % BAD_PAY_RIDER_MOD == 0, F.lit("x")).otherwise(_id_text(F.col("o_custkey"))).alias("_c3"),
    )


def _event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k")
    eid = F.col("event_id")
    end = _plus_seconds(F.col("ts"), F.floor(F.col("value") * 60).cast("long"))
    return e.select(
        F.when(eid % NULL_TRIP_ID_MOD == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("E"), _text(eid))).alias("_c0"),
        F.col("event_type").alias("_c1"),
        F.when(eid % BAD_START_MOD == 0, F.lit("not-a-time")).otherwise(_ts_text(F.col("ts"))).alias("_c2"),
        _ts_text(end).alias("_c3"),
        F.when(eid % NO_START_STATION_MOD == 0, F.lit(None).cast("string")).otherwise(k).alias("_c4"),
        _text((k.cast("long") * 7 + eid) % STATION_SPAN).alias("_c5"),
        F.when(eid % BAD_RIDER_MOD == 0, F.lit("x")).otherwise(_id_text(F.col("user_id"))).alias("_c6"),
    )


def _line_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "left")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    # start and end are computed once: a later projection that uses them twice
    # keeps them as columns instead of inlining the expressions
    start = _plus_seconds(F.col("l_shipdate"), (ok * 7919 + ln * 131) % 86400)
    timed = j.select("*", start.alias("_t0")).select(
        "*", _plus_seconds(F.col("_t0"), F.floor(F.col("l_quantity") * ln * 60).cast("long")).alias("_t1")
    )
    swapped = ok % SWAPPED_TIMES_MOD == 0
    flag = F.col("l_returnflag")
    rideable = (
        F.when(flag == "R", F.lit("electric_bike"))
        .when(flag == "A", F.lit("docked_bike"))
        .otherwise(F.lit("classic_bike"))
    )
    return timed.select(
        F.concat(_text(ok), F.lit("-"), _text(ln)).alias("_c0"),
        rideable.alias("_c1"),
        _ts_text(F.when(swapped, F.col("_t1")).otherwise(F.col("_t0"))).alias("_c2"),
        _ts_text(F.when(swapped, F.col("_t0")).otherwise(F.col("_t1"))).alias("_c3"),
        _text(F.col("l_suppkey")).alias("_c4"),
        _text(F.col("l_partkey") % STATION_SPAN).alias("_c5"),
        _text(F.col("o_custkey")).alias("_c6"),
    )


def trips_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_trips(spark, sf_dir).unionByName(_line_trips(spark, sf_dir))


def damaged_feed(raw: DataFrame) -> list[DataFrame]:
    """A raw feed in three parts that together are its rows: as they are; with two
    fields too many; without their last field. Which part a row goes to is told by
    the first hex digit of its first field's md5 (0: too many, 1: too few)."""
    digit = F.substring(F.md5(F.coalesce(F.col("_c0"), F.lit("")).cast("binary")), 1, 1)
    whole = raw.where(~digit.isin(*DAMAGE_DIGITS))
    long = raw.where(digit == DAMAGE_DIGITS[0]).select("*", F.lit("EXTRA").alias("_x0"), F.lit("a, b").alias("_x1"))
    short = raw.where(digit == DAMAGE_DIGITS[1]).select(*raw.columns[:-1])
    return [whole, long, short]


def arrivals(facts: DataFrame, day: str, key: str) -> list[DataFrame]:
    """Fact rows as three batches: two by the parity of the month, and late rows of
    any month (first hex digit 0 of the key's md5, and rows without a day)."""
    late = F.col(day).isNull() | (F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 1) == "0")
    odd = F.floor(F.col(day) / 100) % 2 == 1
    return [facts.where(~late & odd), facts.where(~late & ~odd), facts.where(late)]


FEED_BUILDERS = {
    "stations": stations_feed,
    "riders": riders_feed,
    "payments": payments_feed,
    "trips": trips_feed,
}


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four raw feeds (all-text ``_cN`` columns) derived from ``sf_dir``."""
    return {name: build(spark, sf_dir) for name, build in FEED_BUILDERS.items()}
