"""Whole jobs over a scratch zone filled from the supplied tables."""

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from stillwell.checks import standins as S
from stillwell.checks.landed import reading_pages
from stillwell.checks.reads import W
from stillwell.checks.registry import check
from stillwell.functions import reading_id
from stillwell.operators.filters import within
from stillwell.operators.mapping import observations
from stillwell.plans import backfill
from stillwell.plans.backfill import run_backfill
from stillwell.plans.daily import run_daily
from stillwell.plans.ingest import run_ingest
from stillwell.plans.replay import run_replay
from stillwell.sinks.observations import read_observations
from stillwell.sinks.raw import append_loads, replace_stations
from stillwell.sinks.state import read_state, watermarks
from stillwell.sinks.zone import Zone
from stillwell.sources.scan import scan_load
from stillwell.sources.specs import CITY_WELLS, LOGGERS
from stillwell.streaming.highwater import high_watermarks, keep_watermarks
from stillwell.streaming.incremental import raw_stream, run_stream

HALF = 1705276800.0
_loaded: dict = {}

# Two runs: loads up to HALF, then the rest. A station fails per run, and the second run
# keeps only what lies behind the first run's watermark.
TWO_RUNS = """, depth AS (
      SELECT concat('pvacd-', location_id, '-dtw') AS datastream_key,
             "timestamp" * 1000000 AS time_us, value * CAST(3.28084 AS DOUBLE) AS result,
             load_id > 1705276800 AS second,
             bool_or(value IS NULL) OVER (PARTITION BY location_id, load_id > 1705276800) AS bad
      FROM readings WHERE parameter_id = '4'),
    first_run AS (SELECT * FROM depth WHERE NOT second AND NOT bad),
    marks AS (SELECT datastream_key, max(time_us) AS mark FROM first_run GROUP BY 1),
    loaded AS (
      SELECT datastream_key, time_us, result FROM first_run
      UNION ALL SELECT datastream_key, time_us, result
      FROM depth LEFT JOIN marks USING (datastream_key)
      WHERE second AND NOT bad AND (mark IS NULL OR time_us > mark))
    """


def _zone(spark, folder):
    zone = Zone(S.scratch(spark, "zone"))
    replace_stations(S.stations(spark, folder), zone.stations(LOGGERS))
    rows = S.readings(spark, folder).drop("file", "row")
    return zone, rows.where(F.col("load_id") <= HALF), rows.where(F.col("load_id") > HALF)


def _two_daily_runs(spark, folder):
    """The zone after two runs of the daily job, built once per session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _loaded:
        zone, first, second = _zone(spark, folder)
        for rows in (first, second):
            append_loads(rows, zone.raw(LOGGERS))
            run_daily(spark, LOGGERS, zone)
        _loaded[key] = zone
    return _loaded[key]


@check(W("readings") + TWO_RUNS + "SELECT datastream_key, time_us, result FROM loaded")
def daily_load(spark, folder):
    zone = _two_daily_runs(spark, folder)
    return S.flat(read_observations(spark, zone.observations))


@check(W("readings") + TWO_RUNS + """SELECT datastream_key, max(time_us) AS watermark_us
    FROM loaded GROUP BY 1""")
def daily_watermarks(spark, folder):
    zone = _two_daily_runs(spark, folder)
    marks = watermarks(read_state(spark, zone.progress(LOGGERS.dataset)), LOGGERS.dataset)
    return marks.select("datastream_key", F.unix_micros("watermark").alias("watermark_us"))


@check(W("readings") + TWO_RUNS + "SELECT datastream_key, time_us, result FROM loaded")
def stream_load(spark, folder):
    zone, first, second = _zone(spark, folder)
    for rows in (first, second):
        append_loads(rows, zone.raw(LOGGERS))
        run_stream(spark, LOGGERS, zone, f"{zone.root}/stream")
    return S.flat(read_observations(spark, zone.observations))


@check(W("city") + """SELECT concat('cabq-', location_id, '-dtw') AS datastream_key,
    "timestamp" * 1000 AS time_us, value AS result FROM city""")
def city_load(spark, folder):
    zone = Zone(S.scratch(spark, "zone"))
    year = F.year(F.timestamp_millis("timestamp"))
    rows = S.city(spark, folder).select(
        *CITY_WELLS.schema.names, (F.lit(1e9) + year).alias("load_id")
    )
    append_loads(rows, zone.raw(CITY_WELLS))
    run_daily(spark, CITY_WELLS, zone)
    return S.flat(read_observations(spark, zone.observations))


# Time stretched threefold, so that the readings fill three calendar months.
STRETCHED = """, stretched AS (
      SELECT location_id, value, parameter_id,
             1704067200 + ("timestamp" - 1704067200) * 3 AS second FROM readings),
    chunked AS (
      SELECT concat('pvacd-', location_id, '-dtw') AS datastream_key,
             CAST(second AS BIGINT) * 1000000 AS time_us,
             value * CAST(3.28084 AS DOUBLE) AS result,
             bool_or(value IS NULL) OVER (
               PARTITION BY location_id, date_trunc('month', to_timestamp(second)::TIMESTAMP))
               AS bad
      FROM stretched WHERE parameter_id = '4' AND second >= 1704412800 AND second < 1709942400
        AND location_id IN (SELECT s_suppkey FROM supplier))
    """


@check(W("readings") + STRETCHED + """SELECT datastream_key, time_us, result FROM chunked
    WHERE NOT bad""")
def backfill_load(spark, folder):
    """Three month chunks from 2024-01-05 to 2024-03-09, then again: nothing is left to do."""
    zone = Zone(S.scratch(spark, "zone"))
    slow = F.lit(S.EPOCH_2024) + (F.col("timestamp") - S.EPOCH_2024) * 3
    rows = S.readings(spark, folder).withColumn("timestamp", slow)
    rows = rows.withColumn("reading_id", reading_id(
        F.col("location_id"), F.col("parameter_id"), F.col("timestamp")
    ))

    def fetch(start, _end):
        # The vendor answers from a start time to the present; the end is cut on landing.
        asked = within(rows, int(start.timestamp()), 1 << 40)
        return reading_pages(asked), None

    for _ in range(2):
        run_backfill(
            spark, LOGGERS, zone, start=date(2024, 1, 5), end=date(2024, 3, 9),
            run_key="check", fetch=fetch, stations=S.stations(spark, folder),
        )
    return S.flat(read_observations(spark, zone.observations))


@check(W("readings") + STRETCHED.replace(
    "        AND location_id IN (SELECT s_suppkey FROM supplier))", ")") + """
    SELECT strftime(date_trunc('month', make_timestamp(time_us)), '%Y-%m') AS month,
           count(*) AS rows, count(*) FILTER (NOT bad) AS observations,
           count(DISTINCT datastream_key) FILTER (bad) AS failed_stations
    FROM chunked GROUP BY 1""")
def dry_run_counts(spark, folder):
    slow = F.lit(S.EPOCH_2024) + (F.col("timestamp") - S.EPOCH_2024) * 3
    raw = S.readings(spark, folder).withColumn("timestamp", slow)
    counts = backfill.dry_run_counts(LOGGERS, raw, date(2024, 1, 5), date(2024, 3, 9))
    return counts.select(F.date_format("chunk_start", "yyyy-MM").alias("month"), "rows",
                         "observations", "failed_stations")


@check("""SELECT strftime(greatest(m, DATE '2024-01-05'), '%Y-%m-%d') AS chunk_start,
           strftime(least(m + INTERVAL 1 MONTH, DATE '2024-03-09'), '%Y-%m-%d') AS chunk_end,
           (SELECT count(DISTINCT s_suppkey) FROM supplier) AS locations
    FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-03-01', INTERVAL 1 MONTH)) AS m)""")
def dry_run_plan(spark, folder):
    """The chunks a backfill of every station would run."""
    plan = backfill.dry_run(spark, date(2024, 1, 5), date(2024, 3, 9), [],
                            S.stations(spark, folder))
    day = "yyyy-MM-dd"
    return plan.select(F.date_format("chunk_start", day).alias("chunk_start"),
                       F.date_format("chunk_end", day).alias("chunk_end"), "locations")


def _ingested(spark, folder):
    """A zone after an ingest of the allowed stations, and its report. Refused fetches count as
    fetches without data, since a refusal fails the whole ingest."""
    zone = Zone(S.scratch(spark, "zone"))
    listed = S.stations(spark, folder).select(
        "id", "name", "description", F.struct("latitude", "longitude").alias("gps")
    )
    allowed = S.table(spark, folder, "supplier").where(F.col("s_nationkey") < 20).select(
        F.col("s_suppkey").cast("string")
    )
    log = S.fetch_log(spark, folder)
    soft = log.withColumn("status", F.when(F.col("status") == 403, 404).otherwise(F.col("status")))
    report = run_ingest(
        spark, LOGGERS, zone, station_list=listed, pages=reading_pages(S.readings(spark, folder)),
        log=soft, allowed=allowed, start_ts=S.EPOCH_2024,
    )
    return zone, report


ASKED = """SELECT {what} FROM readings
    WHERE location_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20)
      AND CAST(location_id AS VARCHAR) IN (SELECT location_id FROM outcomes WHERE outcome = 'ok')
    """


@check(W("readings", "log") + ASKED.format(
    what='reading_id, location_id, "timestamp", parameter_id, value'))
def ingest_load(spark, folder):
    """Landed pages of the allowed stations whose last fetch succeeded."""
    zone, report = _ingested(spark, folder)
    rows = scan_load(spark, zone.raw(LOGGERS), LOGGERS.schema, report["load_id"])
    return rows.select("reading_id", "location_id", "timestamp", "parameter_id", "value")


@check(W("readings", "log") + """, listed AS (
      SELECT CASE WHEN s_nationkey >= 20 THEN 'skipped' WHEN outcome = 'fatal' THEN 'no_data'
                  ELSE coalesce(outcome, 'error') END AS outcome
      FROM (SELECT DISTINCT s_suppkey, s_nationkey FROM supplier)
      LEFT JOIN outcomes ON outcomes.location_id = CAST(s_suppkey AS VARCHAR))
    SELECT (""" + ASKED.format(what="count(*)") + """) AS rows_yielded,
    count(*) FILTER (outcome = 'ok') AS locations_fetched,
    count(*) FILTER (outcome = 'skipped') AS locations_skipped,
    count(*) FILTER (outcome = 'no_data') AS locations_no_data,
    count(*) FILTER (outcome = 'error') AS locations_errored FROM listed""")
def ingest_report(spark, folder):
    """The statistics of that ingest; its rows are counted by the write itself."""
    _, report = _ingested(spark, folder)
    names = [n for n in report if n != "load_id"]
    return spark.createDataFrame([tuple(report[n] for n in names)],
                                 ", ".join(f"{n} bigint" for n in names))


@check(W("readings") + """SELECT datastream_key, time_us, result FROM (
      SELECT concat('pvacd-', location_id, '-dtw') AS datastream_key,
             "timestamp" * 1000000 AS time_us, value * CAST(3.28084 AS DOUBLE) AS result,
             bool_or(value IS NULL) OVER (PARTITION BY location_id) AS bad
      FROM readings WHERE parameter_id = '4' AND "timestamp" >= 1704844800
        AND "timestamp" < 1705708800) WHERE NOT bad""")
def replay_load(spark, folder):
    """A window of an empty target, filled from a raw table that holds everything twice."""
    zone = Zone(S.scratch(spark, "zone"))
    rows = S.readings(spark, folder).drop("file", "row")
    again = rows.withColumn("load_id", F.col("load_id") + 0.5)
    append_loads(rows.unionByName(again), zone.raw(LOGGERS))
    start, end = (datetime(2024, 1, day, tzinfo=timezone.utc) for day in (10, 20))
    run_replay(spark, LOGGERS, zone, start, end, run_key="check")
    return S.flat(read_observations(spark, zone.observations))


@check(W("readings") + """SELECT concat('pvacd-', location_id, '-dtw') AS datastream_key,
    max("timestamp") * 1000000 AS watermark_us, count(*) AS considered
    FROM readings WHERE parameter_id = '4' GROUP BY 1""")
def stream_watermarks(spark, folder):
    """Watermarks from the state store, over two arrivals of raw files."""
    zone, first, second = _zone(spark, folder)
    moved = f"{zone.root}/moved"

    def sink(changed, number):
        changed.withColumn("n", F.lit(number)).write.mode("overwrite").parquet(
            f"{moved}/batch-{number}"
        )

    for rows in (first, second):
        append_loads(rows, zone.raw(LOGGERS))
        stream = LOGGERS.keep(raw_stream(spark, zone.raw(LOGGERS), LOGGERS))
        obs = observations(stream, LOGGERS.agency, LOGGERS.time(), LOGGERS.result())
        keep_watermarks(obs, f"{zone.root}/state", sink).awaitTermination()
    updates = spark.read.option("recursiveFileLookup", "true").parquet(moved)
    return updates.groupBy("datastream_key").agg(
        F.unix_micros(F.max("watermark")).alias("watermark_us"),
        F.max("considered").alias("considered"),
    )


@check(W("readings") + """SELECT concat('pvacd-', location_id, '-dtw') AS datastream_key,
    max("timestamp") * 1000000 AS watermark_us, count(*) AS considered
    FROM readings WHERE parameter_id = '4' GROUP BY 1""")
def batch_watermarks(spark, folder):
    rows = LOGGERS.keep(S.readings(spark, folder))
    marks = high_watermarks(LOGGERS.observations(rows))
    return marks.select("datastream_key", F.unix_micros("watermark").alias("watermark_us"),
                        "considered")
