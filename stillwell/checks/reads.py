"""Scans, filters, station joins, grouping and mapping."""

from pyspark.sql import functions as F

from stillwell.checks import standins as S
from stillwell.checks.registry import check
from stillwell.functions import from_iso, iso_text, millis_to_seconds, odata_text
from stillwell.operators import filters, grouping, joins, mapping
from stillwell.plans.backfill import unknown_ids
from stillwell.session import settle
from stillwell.sinks.raw import append_loads
from stillwell.sources import scan
from stillwell.sources.specs import CITY_WELLS, LOGGERS

W = S.with_parts
FLAT = 'SELECT datastream_key, time_us, result'
_staged: dict = {}


def good_observations_of(spark, folder, carry=()):
    flagged = LOGGERS.flagged(S.readings(spark, folder))
    outcomes = settle(LOGGERS.outcomes(flagged))
    return LOGGERS.observations(mapping.good_rows(flagged, outcomes), carry)


def staged_loads(spark, folder):
    """The readings written once per session as a raw table of many loads."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _staged:
        root = S.scratch(spark, "raw")
        append_loads(S.readings(spark, folder).drop("file", "row"), root)
        _staged[key] = root
    return _staged[key]


@check(W("readings") + """SELECT concat('pvacd-', location_id, '-dtw') AS datastream_key,
    count(*) AS readings, min("timestamp") AS first_second, max("timestamp") AS last_second,
    max(value * CAST(3.28084 AS DOUBLE)) AS deepest
    FROM readings WHERE parameter_id = '4' AND value IS NOT NULL GROUP BY 1""")
def depth_per_datastream(spark, folder):
    rows = filters.depth_rows(S.readings(spark, folder)).where(F.col("value").isNotNull())
    return LOGGERS.observations(rows).groupBy("datastream_key").agg(
        F.count(F.lit(1)).alias("readings"),
        F.unix_seconds(F.min("phenomenon_time")).alias("first_second"),
        F.unix_seconds(F.max("phenomenon_time")).alias("last_second"),
        F.max("result").alias("deepest"),
    )


@check(W("readings") + """SELECT concat('pvacd-', location_id, '-dtw') AS datastream_key,
    "timestamp" * 1000000 AS time_us, value * CAST(3.28084 AS DOUBLE) AS result
    FROM readings WHERE parameter_id = '4'""")
def dtw_observations(spark, folder):
    return S.flat(LOGGERS.observations(filters.depth_rows(S.readings(spark, folder))))


@check(W("city") + """SELECT concat('cabq-', location_id, '-dtw') AS datastream_key,
    "timestamp" * 1000 AS time_us, value AS result FROM city""")
def city_observations(spark, folder):
    return S.flat(CITY_WELLS.observations(S.city(spark, folder)))


@check(W("readings", "stations") + """SELECT reading_id, location_id,
    CASE WHEN id IS NULL THEN '' ELSE name END AS location_name,
    CASE WHEN id IS NULL THEN '' ELSE description END AS location_description,
    latitude, longitude FROM readings LEFT JOIN stations ON location_id = id""")
def readings_with_station(spark, folder):
    joined = mapping.with_station(S.readings(spark, folder), S.stations(spark, folder))
    return joined.select("reading_id", "location_id", "location_name", "location_description",
                         "latitude", "longitude")


@check(W("readings", "stations") + """SELECT reading_id, location_id, name FROM readings
    LEFT JOIN stations ON location_id = id""")
def readings_with_station_split(spark, folder):
    """The way a station table too large to broadcast is joined: hot stations apart."""
    names = S.stations(spark, folder).select(F.col("id").alias("location_id"), "name")
    joined = joins.split_join(S.readings(spark, folder), names, ["location_id"], "left")
    return joined.select("reading_id", "location_id", "name")


# --- scans of a raw table that Spark wrote from the readings ---------------------------
@check(W("readings") + """SELECT reading_id, load_id FROM readings WHERE load_id > 1705276800""")
def incremental_new_rows(spark, folder):
    rows = scan.scan_new(spark, staged_loads(spark, folder), LOGGERS.schema, 1705276800.0)
    return rows.select("reading_id", "load_id")


@check(W("readings") + """SELECT reading_id, parameter_id, value FROM readings
    WHERE load_id > 1705276800 AND parameter_id = '4'""")
def incremental_depth_rows(spark, folder):
    rows = scan.scan_new(spark, staged_loads(spark, folder), LOGGERS.schema, 1705276800.0)
    return filters.depth_rows(rows).select("reading_id", "parameter_id", "value")


@check(W("readings") + """SELECT reading_id, load_id FROM readings WHERE load_id = 1705276800""")
def exact_load_rows(spark, folder):
    rows = scan.scan_load(spark, staged_loads(spark, folder), LOGGERS.schema, 1705276800.0)
    return rows.select("reading_id", "load_id")


@check(W("readings") + "SELECT DISTINCT load_id FROM readings")
def listed_loads(spark, folder):
    return scan.list_loads(spark, staged_loads(spark, folder)).select("load_id").distinct()


@check(W("readings") + "SELECT max(load_id) AS newest FROM readings")
def max_load_id(spark, folder):
    listed = scan.list_loads(spark, staged_loads(spark, folder))
    return listed.agg(F.max("load_id").alias("newest"))


@check(W("readings") + """SELECT concat('/raw/', load_id, '.', event_id % 7, '.parquet') AS path,
    load_id FROM readings
    UNION ALL SELECT concat('/raw/', reading_id, '.parquet'), NULL FROM readings""")
def load_ids_of_paths(spark, folder):
    rows = S.readings(spark, folder)
    file = (F.col("row") % 7).cast("string")
    whole = F.format_string("%.1f", "load_id")
    named = rows.select(F.concat(F.lit("/raw/"), whole, F.lit("."), file, F.lit(".parquet"))
                        .alias("path"))
    other = rows.select(F.concat(F.lit("/raw/"), "reading_id", F.lit(".parquet")).alias("path"))
    paths = named.unionByName(other)
    return paths.select("path", scan.load_id_of(F.col("path")).alias("load_id"))


# --- filters ---------------------------------------------------------------------------
@check(W("readings") + """SELECT reading_id, location_id FROM readings
    WHERE location_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 10)""")
def allowlist_rows(spark, folder):
    allowed = S.table(spark, folder, "supplier").where(F.col("s_nationkey") < 10)
    kept = filters.only_stations(S.readings(spark, folder), allowed.select("s_suppkey"))
    return kept.select("reading_id", "location_id")


@check(W("readings", "stations") + """SELECT DISTINCT location_id FROM readings
    WHERE location_id NOT IN (SELECT id FROM stations)""")
def unknown_stations(spark, folder):
    wanted = S.readings(spark, folder).select("location_id").distinct()
    known = S.stations(spark, folder).select(F.col("id").alias("location_id"))
    return unknown_ids(wanted, known)


@check(W("readings") + """SELECT reading_id, "timestamp" FROM readings
    WHERE "timestamp" >= 1704844800 AND "timestamp" < 1705708800""")
def window_rows(spark, folder):
    rows = filters.within(S.readings(spark, folder), 1704844800, 1705708800)
    return rows.select("reading_id", "timestamp")


@check(W("readings") + """, paged AS (
      SELECT *, (("timestamp" - 1704067200) // 86400 + location_id) % 10 AS page FROM readings),
    cuts AS (SELECT location_id, min(page) AS cut FROM paged
             WHERE "timestamp" >= 1705276800 GROUP BY 1)
    SELECT reading_id, page FROM paged LEFT JOIN cuts USING (location_id)
    WHERE "timestamp" < 1705276800 AND (cut IS NULL OR page <= cut)""")
def page_cutoff(spark, folder):
    rows = S.readings(spark, folder)
    day = F.call_function("div", F.col("timestamp") - S.EPOCH_2024, F.lit(S.DAY))
    paged = rows.withColumn("page", (day + F.col("location_id")) % 10)
    return filters.cut_pages(paged, 1705276800).select("reading_id", "page")


@check(W("readings", "cursors") + """SELECT reading_id FROM readings
    LEFT JOIN cursors USING (location_id)
    WHERE "timestamp" >= greatest(coalesce(cursor, 0), 1704326400)""")
def cursor_floor_rows(spark, folder):
    rows, marks = S.readings(spark, folder), S.cursors(spark, folder)
    return filters.from_cursor(rows, marks, 1704326400).select("reading_id")


@check(W("readings", "cursors") + """SELECT reading_id FROM readings
    LEFT JOIN cursors USING (location_id)
    WHERE "timestamp" >= greatest(coalesce(cursor, 0), 1704330000)
                         - greatest(coalesce(cursor, 0), 1704330000) % 86400""")
def day_floor_rows(spark, folder):
    rows, marks = S.readings(spark, folder), S.cursors(spark, folder)
    return filters.from_cursor(rows, marks, 1704330000, by_day=True).select("reading_id")


@check(W("readings", "stations") + """SELECT 'unit' AS flag, count(*) AS flagged FROM readings
    WHERE unit_id IS DISTINCT FROM '35'
    UNION ALL SELECT 'coordinates', count(*) FROM stations WHERE abs(latitude) > 90""")
def quality_flags(spark, folder):
    units = S.readings(spark, folder).where(filters.unexpected_unit())
    places = S.stations(spark, folder).where(filters.swapped_coordinates())
    return units.agg(F.lit("unit").alias("flag"), F.count(F.lit(1)).alias("flagged")).unionByName(
        places.agg(F.lit("coordinates").alias("flag"), F.count(F.lit(1)).alias("flagged"))
    )


# --- grouping --------------------------------------------------------------------------
@check(W("readings") + """, placed AS (
      SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY load_id, event_id) - 1 AS slot
      FROM readings)
    SELECT location_id, slot // 20 AS page, count(*) AS readings,
           string_agg(CAST("timestamp" AS VARCHAR), ',' ORDER BY slot) AS seconds
    FROM placed GROUP BY 1, 2""")
def station_pages(spark, folder):
    pages = mapping.station_pages(S.readings(spark, folder), ["load_id", "file", "row"], size=20)
    seconds = F.transform("readings", lambda r: r["timestamp"].cast("string"))
    return pages.select(
        "location_id", "page", F.size("readings").cast("bigint").alias("readings"),
        F.array_join(seconds, ",").alias("seconds"),
    )


@check(W("city") + """SELECT location_id, coalesce(location_name, location_id) AS location_name,
    latitude, longitude FROM city QUALIFY row_number() OVER (PARTITION BY location_id
      ORDER BY load_id, file, row) = 1""")
def station_first_rows(spark, folder):
    first = mapping.first_row_stations(S.city(spark, folder), ["load_id", "file", "row"])
    return first.select("location_id", "location_name", "latitude", "longitude")


@check("""SELECT o_custkey AS id, o_orderpriority AS name, o_totalprice AS latitude FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_station(spark, folder):
    rows = S.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("name"),
        F.col("o_totalprice").alias("latitude"), "o_orderdate", "o_orderkey",
    )
    last = grouping.last_per_key(rows, ["id"], ["o_orderdate", "o_orderkey"])
    return last.select("id", "name", "latitude")


@check(W("city") + """SELECT reading_id, value, l_orderkey FROM city
    QUALIFY row_number() OVER (PARTITION BY reading_id ORDER BY l_orderkey DESC,
      l_linenumber DESC, l_partkey DESC, l_extendedprice DESC, l_shipdate DESC) = 1""")
def unique_readings(spark, folder):
    last = grouping.unique_readings(S.city(spark, folder), S.CITY_ORDER)
    return last.select("reading_id", "value", "l_orderkey")


@check(W("readings") + """SELECT location_id, count(*) AS rows,
    CASE WHEN count(*) > count(value) THEN 'null value' END AS failure,
    count(*) - count(value) AS bad_rows FROM readings WHERE parameter_id = '4' GROUP BY 1""")
def station_outcomes(spark, folder):
    return LOGGERS.outcomes(LOGGERS.flagged(S.readings(spark, folder)))


@check(W("readings") + """SELECT location_id, 'null value' AS failure, count(*) AS bad_rows
    FROM readings WHERE parameter_id = '4' AND value IS NULL GROUP BY 1""")
def failed_stations(spark, folder):
    outcomes = LOGGERS.outcomes(LOGGERS.flagged(S.readings(spark, folder)))
    return mapping.failed_stations(outcomes).select("location_id", "failure", "bad_rows")


@check(W("readings", "obs") + FLAT + " FROM obs")
def good_observations(spark, folder):
    return S.flat(good_observations_of(spark, folder))


# --- scalar functions ------------------------------------------------------------------
@check("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso,
    strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS odata,
    epoch_us(ts) AS parsed_us, (-(epoch_us(ts) // 1000)) // 1000 AS truncated FROM events""")
def time_texts(spark, folder):
    events = S.table(spark, folder, "events")
    time = F.col("ts").cast("timestamp")
    return events.select(
        "event_id", iso_text(time).alias("iso"),
        odata_text(F.date_trunc("second", time)).alias("odata"),
        F.unix_micros(from_iso(iso_text(time))).alias("parsed_us"),
        millis_to_seconds(-F.unix_millis(time)).alias("truncated"),
    )
