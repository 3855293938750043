"""Watermarks, ordering, window replace, entities, plans and statistics."""

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from stillwell import schemas
from stillwell.checks import standins as S
from stillwell.checks.reads import FLAT, W, good_observations_of
from stillwell.checks.registry import check
from stillwell.functions import chunk_key, datastream_key
from stillwell.operators import audit, entities, mapping, ordering, watermarks, windows
from stillwell.plans import months
from stillwell.plans.ingest import allowed_outcomes
from stillwell.plans.replay import replayed
from stillwell.session import settle
from stillwell.sinks.entities import read_entity, upsert_entities
from stillwell.sinks.observations import (
    read_observations, replace_window_in_place, write_batch,
)
from stillwell.sinks.state import commit_state, read_state, watermark_rows
from stillwell.sinks.zone import Zone
from stillwell.sources.specs import CITY_WELLS, LOGGERS

START = datetime(2024, 1, 10, tzinfo=timezone.utc)
END = datetime(2024, 1, 20, tzinfo=timezone.utc)
IN_WINDOW = "time_us >= 1704844800000000 AND time_us < 1705708800000000"
CITY_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]

SHIFTED = """, shifted AS (
      SELECT datastream_key, time_us - 1296000000000 AS time_us FROM existing),
    effective AS (
      SELECT datastream_key, watermark_us FROM stored
      WHERE datastream_key IN (SELECT datastream_key FROM obs)
      UNION ALL
      SELECT datastream_key, max(time_us) FROM shifted
      WHERE datastream_key IN (SELECT datastream_key FROM obs)
        AND datastream_key NOT IN (SELECT datastream_key FROM stored) GROUP BY 1)
    """


def effective(spark, folder, obs):
    held = S.existing(spark, folder).withColumn(
        "phenomenon_time", F.timestamp_seconds(F.unix_seconds("phenomenon_time") - 15 * S.DAY)
    )
    keys = settle(obs.select("datastream_key").distinct())
    return watermarks.effective_watermarks(
        keys, S.stored_watermarks(spark, folder), lambda: watermarks.newest_per_datastream(held))


# --- watermarks ------------------------------------------------------------------------
@check(W("readings", "obs", "stored", "existing") + SHIFTED +
       "SELECT datastream_key, watermark_us FROM effective")
def effective_watermarks(spark, folder):
    marks = effective(spark, folder, good_observations_of(spark, folder))
    return marks.select("datastream_key", F.unix_micros("watermark").alias("watermark_us"))


@check(W("readings", "obs", "stored") + FLAT + """ FROM obs LEFT JOIN stored USING (datastream_key)
    WHERE watermark_us IS NULL OR time_us > watermark_us""")
def watermark_filtered(spark, folder):
    obs = good_observations_of(spark, folder)
    return S.flat(watermarks.past_watermark(obs, S.stored_watermarks(spark, folder)))


@check(W("readings", "obs", "stored", "existing") + SHIFTED + """
    SELECT datastream_key, count(*) AS considered,
           count(*) FILTER (watermark_us IS NULL OR time_us > watermark_us) AS posted,
           count(*) FILTER (time_us <= watermark_us) AS skipped,
           coalesce(max(time_us) FILTER (watermark_us IS NULL OR time_us > watermark_us),
                    max(watermark_us)) AS new_watermark_us
    FROM obs LEFT JOIN effective USING (datastream_key) GROUP BY 1""")
def load_results(spark, folder):
    obs = good_observations_of(spark, folder)
    marked = watermarks.with_watermark(obs, effective(spark, folder, obs))
    return watermarks.load_results(marked).select(
        "datastream_key", "considered", "posted", "skipped",
        F.unix_micros("new_watermark").alias("new_watermark_us"),
    )


@check(W("readings", "obs", "stored") + """SELECT CAST(count(DISTINCT datastream_key) AS BIGINT)
      AS bundles_loaded,
    count(*) FILTER (watermark_us IS NULL OR time_us > watermark_us) AS observations_posted,
    count(*) FILTER (time_us <= watermark_us) AS observations_skipped,
    CAST(0 AS BIGINT) AS observations_deleted
    FROM obs LEFT JOIN stored USING (datastream_key)""")
def load_totals(spark, folder):
    obs = good_observations_of(spark, folder)
    marked = watermarks.with_watermark(obs, S.stored_watermarks(spark, folder))
    results = settle(watermarks.load_results(marked))
    return audit.load_totals(results, results.count())


@check(W("readings", "existing") + """SELECT datastream_key, max(time_us) AS watermark_us
    FROM existing GROUP BY 1""")
def newest_per_datastream(spark, folder):
    newest = watermarks.newest_per_datastream(S.existing(spark, folder))
    return newest.select("datastream_key", F.unix_micros("watermark").alias("watermark_us"))


@check(W("readings", "existing") + """SELECT max(time_us) AS watermark_us FROM existing
    WHERE datastream_key = 'pvacd-7-dtw'""")
def newest_observation(spark, folder):
    newest = watermarks.newest_time(S.existing(spark, folder), "pvacd-7-dtw")
    return newest.select(F.unix_micros("watermark").alias("watermark_us"))


@check(W("readings", "existing", "stored") + """SELECT datastream_key,
    max(watermark_us) AS watermark_us FROM (
      SELECT * FROM stored UNION ALL SELECT datastream_key, time_us FROM existing) GROUP BY 1""")
def raised_watermarks(spark, folder):
    newest = watermarks.newest_per_datastream(S.existing(spark, folder))
    merged = watermarks.raised(S.stored_watermarks(spark, folder), newest)
    return merged.select("datastream_key", F.unix_micros("watermark").alias("watermark_us"))


@check(W("readings", "existing", "stored") + """SELECT datastream_key AS key,
    max(watermark_us) AS position FROM (
      SELECT * FROM stored UNION ALL SELECT datastream_key, time_us FROM existing) GROUP BY 1""")
def committed_state(spark, folder):
    root = S.scratch(spark, "progress")
    newest = watermarks.newest_per_datastream(S.existing(spark, folder))
    commit_state(spark, root, watermark_rows(S.stored_watermarks(spark, folder), "x"))
    commit_state(spark, root, watermark_rows(newest, "x"))
    return read_state(spark, root).select("key", "position")


# --- ordering --------------------------------------------------------------------------
CHUNKS = """, placed AS (
      SELECT concat('cabq-', location_id, '-dtw') AS datastream_key, "timestamp" * 1000 AS time_us,
             l_orderkey, l_linenumber, l_partkey,
             row_number() OVER (PARTITION BY location_id ORDER BY "timestamp", l_orderkey,
               l_linenumber, l_partkey, l_extendedprice) AS position FROM city)
    """


def _city_chunks(spark, folder, group_limit=None):
    obs = mapping.observations(
        S.city(spark, folder), CITY_WELLS.agency, CITY_WELLS.time(), CITY_WELLS.result(),
        carry=tuple(CITY_KEYS),
    )
    return ordering.chunked(obs, ["datastream_key"], ["phenomenon_time", *CITY_KEYS], size=100,
                            group_limit=group_limit)


NUMBERS = CHUNKS + """SELECT datastream_key, time_us, l_orderkey, l_linenumber, l_partkey,
    position, (position - 1) // 100 AS chunk FROM placed"""


def _numbers(chunks):
    return chunks.select(
        "datastream_key", F.unix_micros("phenomenon_time").alias("time_us"), "l_orderkey",
        "l_linenumber", "l_partkey", "position", "chunk",
    )


@check(W("city") + NUMBERS)
def chunk_numbers(spark, folder):
    return _numbers(_city_chunks(spark, folder))


@check(W("city") + NUMBERS)
def chunk_numbers_by_range(spark, folder):
    """The way a datastream too large for one task is numbered, applied to all of them."""
    return _numbers(_city_chunks(spark, folder, group_limit=0))


@check(W("city") + CHUNKS + """SELECT datastream_key, (position - 1) // 100 AS chunk,
    count(*) AS posted, max(time_us) AS watermark_us FROM placed GROUP BY 1, 2""")
def chunk_watermarks(spark, folder):
    trail = ordering.chunk_trail(_city_chunks(spark, folder), ["datastream_key"])
    return trail.select("datastream_key", "chunk", "posted",
                        F.unix_micros("watermark").alias("watermark_us"))


# --- window replace --------------------------------------------------------------------
REPLACED = """, fresh AS (SELECT datastream_key, time_us, result FROM obs WHERE {w}),
    keys AS (SELECT DISTINCT datastream_key FROM fresh),
    replaced AS (
      SELECT * FROM existing WHERE NOT ({w}) OR datastream_key NOT IN (SELECT * FROM keys)
      UNION ALL SELECT * FROM fresh)
    """.format(w=IN_WINDOW)


def _fresh(spark, folder):
    obs = good_observations_of(spark, folder)
    return obs.where((F.col("phenomenon_time") >= START) & (F.col("phenomenon_time") < END))


@check(W("readings", "obs", "existing") + REPLACED + FLAT + " FROM replaced")
def window_replace_result(spark, folder):
    new = mapping.load_records(_fresh(spark, folder))
    keys = settle(new.select("datastream_key").distinct())
    return S.flat(windows.replace_window(S.existing(spark, folder), new, START, END, keys))


def _stored_target(spark, folder):
    root = S.scratch(spark, "observation")
    blank = S.existing(spark, folder).select(
        "*", F.lit(None).cast("map<string,string>").alias("parameters"),
        F.lit(None).cast("string").alias("result_quality"),
    )
    write_batch(blank, root, "PVACD", "first")
    return root


@check(W("readings", "obs", "existing") + REPLACED + FLAT + " FROM replaced")
def window_replace_table(spark, folder):
    root = _stored_target(spark, folder)
    marks = S.stored_watermarks(spark, folder)
    new = _fresh(spark, folder)
    settle(replace_window_in_place(spark, root, "PVACD", "again", new, START, END, marks))
    return S.flat(read_observations(spark, root))


@check(W("readings", "obs", "existing", "stored") + REPLACED + """, counts AS (
      SELECT datastream_key, count(*) AS posted, CAST(0 AS BIGINT) AS deleted,
             max(time_us) AS latest FROM fresh GROUP BY 1
      UNION ALL SELECT datastream_key, 0, count(*), NULL FROM existing
      WHERE datastream_key IN (SELECT * FROM keys) AND """ + IN_WINDOW + """ GROUP BY 1)
    SELECT datastream_key, CAST(sum(posted) AS BIGINT) AS posted,
           CAST(sum(deleted) AS BIGINT) AS deleted,
           greatest(max(latest), max(watermark_us)) AS new_watermark_us
    FROM counts LEFT JOIN stored USING (datastream_key) GROUP BY 1""")
def window_results(spark, folder):
    new = _fresh(spark, folder)
    keys = settle(new.select("datastream_key").distinct())
    gone = windows.deleted_by(S.existing(spark, folder), keys, START, END)
    results = windows.window_results(new, gone, S.stored_watermarks(spark, folder))
    return results.select("datastream_key", "posted", "deleted",
                          F.unix_micros("new_watermark").alias("new_watermark_us"))


@check(W("readings", "obs") + FLAT + " FROM obs WHERE NOT (" + IN_WINDOW + ")")
def out_of_window(spark, folder):
    return S.flat(windows.outside_window(good_observations_of(spark, folder), START, END))


@check(W("city") + """SELECT location_id, "timestamp" AS millis FROM city
    WHERE location_name IS NULL""")
def rejected_records(spark, folder):
    """Readings keyed by station name, which some rows lack: those a load must refuse."""
    rows = S.city(spark, folder)
    keyed = rows.select(
        datastream_key("CABQ", F.col("location_name")).alias("datastream_key"),
        CITY_WELLS.time().alias("phenomenon_time"), "location_id",
    )
    bad = windows.rejected(keyed)
    return bad.select("location_id", F.unix_millis("phenomenon_time").alias("millis"))


@check(W("readings", "obs") + FLAT + " FROM obs")
def normal_load_table(spark, folder):
    """A batch written twice is there once."""
    root = S.scratch(spark, "observation")
    obs = good_observations_of(spark, folder)
    for _ in range(2):
        write_batch(obs, root, "PVACD", "once")
    return S.flat(read_observations(spark, root))


@check(W("readings", "obs") + """SELECT datastream_key,
    strftime(make_timestamp(time_us), '%Y-%m') AS obs_month, count(*) AS rows,
    min(time_us) AS oldest_us, max(time_us) AS newest_us FROM obs GROUP BY 1, 2""")
def stored_summary(spark, folder):
    """What a batch keeps of each datastream and month beside its rows."""
    root = S.scratch(spark, "observation")
    written = write_batch(good_observations_of(spark, folder), root, "PVACD", "once")
    return written.select("datastream_key", "obs_month", "rows",
                          F.unix_micros("oldest").alias("oldest_us"),
                          F.unix_micros("newest").alias("newest_us"))


@check(W("readings", "obs") + """SELECT datastream_key, time_us, result FROM (
      SELECT concat('pvacd-', location_id, '-dtw') AS datastream_key,
             "timestamp" * 1000000 AS time_us, value * CAST(3.28084 AS DOUBLE) AS result,
             bool_or(value IS NULL) OVER (PARTITION BY location_id) AS bad
      FROM readings WHERE parameter_id = '4' AND "timestamp" >= 1704844800
        AND "timestamp" < 1705708800) WHERE NOT bad""")
def replay_window(spark, folder):
    rows = replayed(LOGGERS, S.readings(spark, folder), 1704844800, 1705708800)
    return S.flat(rows)


# --- entities --------------------------------------------------------------------------
PRESENT = """, present AS (
      SELECT location_id, id IS NULL AS absent, name, description, latitude, longitude
      FROM (SELECT DISTINCT location_id FROM readings) LEFT JOIN stations ON location_id = id)
    """


def _tables(spark, folder):
    present = mapping.stations_of(S.readings(spark, folder), S.stations(spark, folder))
    return LOGGERS.entities(settle(present))


@check(W("readings", "stations") + PRESENT + """SELECT concat('pvacd-', location_id) AS external_key,
    CASE WHEN absent THEN '' ELSE name END AS name,
    'Location of well where measurements are made' AS description,
    'application/geo+json' AS encoding_type, 'Point' AS geometry_type, longitude, latitude,
    CAST(location_id AS VARCHAR) AS source_id, CAST(NULL AS VARCHAR) AS agency,
    CASE WHEN absent THEN '' ELSE description END AS well FROM present""")
def geo_points(spark, folder):
    places = _tables(spark, folder)["location"]
    return places.select(
        "external_key", "name", "description", "encoding_type",
        F.col("geometry.type").alias("geometry_type"),
        F.col("geometry.coordinates")[0].alias("longitude"),
        F.col("geometry.coordinates")[1].alias("latitude"),
        "properties.source_id", "properties.agency",
        F.col("properties.source_specific")["hydrovu_description"].alias("well"),
    )


@check(W("readings", "stations") + PRESENT + """SELECT concat('pvacd-', location_id) AS external_key,
    'Water Well' AS name, 'Well drilled or set into subsurface for the purposes of pumping '
    || 'water or monitoring groundwater' AS description,
    concat('pvacd-', location_id) AS location_key, 'PVACD' AS agency,
    CAST(location_id AS VARCHAR) AS source_id FROM present""")
def thing_rows(spark, folder):
    wells = _tables(spark, folder)["thing"]
    return wells.select("external_key", "name", "description", "location_key",
                        "properties.agency", "properties.source_id")


@check(W("readings", "stations") + PRESENT + """SELECT
    concat('pvacd-', location_id, '-dtw') AS external_key, 'Groundwater Levels' AS name,
    'http://www.opengis.net/def/observationType/OGC-OM/2.0/OM_Measurement' AS observation_type,
    'Foot' AS unit_name, 'ft' AS unit_symbol,
    'http://www.qudt.org/vocab/unit/FT' AS unit_definition,
    concat('pvacd-', location_id) AS thing_key, 'sensor-hydrovu-vulink' AS sensor_key,
    'observed-property-depth-to-water-bgs' AS observed_property_key FROM present""")
def datastream_rows(spark, folder):
    streams = _tables(spark, folder)["datastream"]
    return streams.select(
        "external_key", "name", "observation_type",
        F.col("unit_of_measurement.name").alias("unit_name"),
        F.col("unit_of_measurement.symbol").alias("unit_symbol"),
        F.col("unit_of_measurement.definition").alias("unit_definition"),
        "thing_key", "sensor_key", "observed_property_key",
    )


@check(W("readings", "stations") + PRESENT + """SELECT
    concat('pvacd-', location_id, '-gwe') AS external_key,
    'Water level elevation relative to NAVD88 — PVACD Water Well' AS description,
    'observed-property-water-level-elevation-navd88' AS observed_property_key FROM present""")
def elevation_rows(spark, folder):
    wells = _tables(spark, folder)["thing"]
    streams = mapping.elevation_datastreams(wells, LOGGERS.agency, LOGGERS.sensor)
    return streams.select("external_key", "description", "observed_property_key")


@check(W("readings", "stations") + """SELECT DISTINCT concat('pvacd-', location_id) AS external_key
    FROM readings WHERE location_id NOT IN (
      SELECT s_suppkey FROM supplier WHERE s_nationkey < 12)""")
def new_entities(spark, folder):
    known = S.table(spark, folder, "supplier").where(F.col("s_nationkey") < 12)
    held = mapping.locations(
        known.select(F.col("s_suppkey").alias("location_id"), F.lit("").alias("location_name"),
                     F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude")),
        "PVACD", "",
    )
    missing = entities.new_entities(_tables(spark, folder)["location"], held)
    return missing.select("external_key")


@check(W("readings") + """, keys AS (SELECT DISTINCT location_id FROM readings)
    SELECT 'location' AS entity, concat('pvacd-', location_id) AS external_key FROM keys
    UNION ALL SELECT 'thing', concat('pvacd-', location_id) FROM keys
    UNION ALL SELECT 'datastream', concat('pvacd-', location_id, '-dtw') FROM keys
    UNION ALL SELECT 'sensor', 'sensor-hydrovu-vulink'
    UNION ALL SELECT 'observed_property', 'observed-property-depth-to-water-bgs'""")
def entity_tables(spark, folder):
    """Upserting twice, once with part of the stations, leaves each entity once."""
    zone = Zone(S.scratch(spark, "zone"))
    known = S.stations(spark, folder)
    rows = S.readings(spark, folder)
    depth = mapping.stations_of(rows.where(F.col("parameter_id") == "4"), known)
    upsert_entities(spark, zone, LOGGERS.entities(settle(depth)))
    upsert_entities(spark, zone, _tables(spark, folder))
    parts = [
        read_entity(spark, zone, name).select(F.lit(name).alias("entity"), "external_key")
        for name in schemas.ENTITIES
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@check(W("readings") + """SELECT DISTINCT concat('pvacd-', location_id, '-dtw') AS datastream_key,
    concat('pvacd-', location_id) AS thing_key, concat('pvacd-', location_id) AS location_key,
    'sensor-hydrovu-vulink' AS sensor_key,
    'observed-property-depth-to-water-bgs' AS observed_property_key FROM readings""")
def linked_datastreams(spark, folder):
    t = _tables(spark, folder)
    linked = entities.linked_datastreams(
        settle(t["datastream"]), t["thing"], t["sensor"], t["observed_property"]
    )
    return linked.drop("datastream_id", "thing_id")


EXPANDED = """SELECT concat('pvacd-', location_id) AS thing_key, 'Water Well' AS thing_name,
    CASE WHEN absent THEN '' ELSE name END AS location_name, longitude, latitude,
    concat('pvacd-', location_id, '-dtw') AS datastream_key,
    'Groundwater Levels' AS datastream_name, 'ft' AS unit_symbol, 'VuLink' AS sensor_name,
    'Depth to Water Below Ground Surface' AS observed_property_name FROM present"""


def _expanded(spark, folder):
    t = _tables(spark, folder)
    return entities.expanded(
        t["thing"], t["location"], settle(t["datastream"]), t["sensor"], t["observed_property"]
    )


@check(W("readings", "stations") + PRESENT + EXPANDED)
def things_expanded(spark, folder):
    return _expanded(spark, folder).select(
        "thing_key", "thing_name", "location_name", F.col("coordinates")[0].alias("longitude"),
        F.col("coordinates")[1].alias("latitude"), "datastream_key", "datastream_name",
        "unit_symbol", "sensor_name", "observed_property_name",
    )


@check(W("readings", "stations") + PRESENT + EXPANDED)
def things_nested(spark, folder):
    """The arrays unfolded again: every thing with all that is said of each of its datastreams."""
    rows = entities.nested(_expanded(spark, folder))
    return rows.select(
        "thing_key", "thing_name", "location_name", F.col("coordinates")[0].alias("longitude"),
        F.col("coordinates")[1].alias("latitude"), F.inline_outer("datastreams"),
    )


@check(W("readings", "obs") + """, placed AS (
      SELECT *, (row_number() OVER (PARTITION BY location_id
               ORDER BY time_us, event_id) - 1) // 5 AS page FROM obs)
    SELECT concat('pvacd-', location_id) AS thing_key, page, datastream_key,
           row_number() OVER (PARTITION BY location_id, page ORDER BY time_us, event_id) - 1
             AS place, time_us, result FROM placed
    UNION ALL SELECT DISTINCT concat('pvacd-', location_id), 0, NULL, NULL, NULL, NULL
    FROM readings WHERE location_id NOT IN (SELECT location_id FROM obs)""")
def bundle_pages(spark, folder):
    """The bundles unfolded again: each observation at its place in its page."""
    obs = good_observations_of(spark, folder, carry=("row",))
    streams = _tables(spark, folder)["datastream"]
    pages = mapping.bundles(streams, settle(obs), ["phenomenon_time", "row"], size=5)
    by_key = pages.select("thing_key", "page", F.explode_outer("observations").alias(
        "datastream_key", "held"))
    each = by_key.select("thing_key", "page", "datastream_key", F.posexplode_outer("held").alias(
        "place", "at"))
    return each.select("thing_key", "page", "datastream_key", F.col("place").cast("bigint")
                       .alias("place"), F.unix_micros("at.phenomenon_time").alias("time_us"),
                       "at.result")


@check(W("readings", "obs") + "SELECT count(*) AS observations FROM obs")
def observation_count(spark, folder):
    return entities.observation_count(good_observations_of(spark, folder))


@check(W("readings", "obs") + """SELECT datastream_key, count(*) AS observations FROM obs
    GROUP BY 1""")
def observation_counts(spark, folder):
    return entities.observation_counts(good_observations_of(spark, folder))


# --- plans -----------------------------------------------------------------------------
PLANS = """WITH ranges AS (
      SELECT l_suppkey, min(l_shipdate) AS s, max(l_shipdate) AS e FROM lineitem GROUP BY 1),
    months AS (
      SELECT l_suppkey, s, e,
             unnest(generate_series(date_trunc('month', s), e - INTERVAL 1 DAY,
                                    INTERVAL 1 MONTH)) AS m
      FROM ranges WHERE s < e),
    plan AS (
      SELECT l_suppkey, greatest(m, s) AS a, least(m + INTERVAL 1 MONTH, e) AS b FROM months)
    """


def _plans(spark, folder):
    lines = S.table(spark, folder, "lineitem")
    ranges = lines.groupBy("l_suppkey").agg(
        F.min("l_shipdate").alias("s"), F.max("l_shipdate").alias("e")
    )
    return months.month_plans(ranges, "s", "e")


@check(PLANS + """SELECT l_suppkey, strftime(a, '%Y-%m-%d') AS chunk_start,
    strftime(b, '%Y-%m-%d') AS chunk_end FROM plan""")
def month_plans(spark, folder):
    return _plans(spark, folder).select(
        "l_suppkey", F.date_format("chunk_start", "yyyy-MM-dd").alias("chunk_start"),
        F.date_format("chunk_end", "yyyy-MM-dd").alias("chunk_end"),
    )


@check(PLANS + """SELECT l_suppkey, concat(strftime(a, '%Y-%m-%dT%H:%M:%S+00:00'), '_',
    strftime(b, '%Y-%m-%dT%H:%M:%S+00:00'), '_', l_suppkey) AS chunk_key FROM plan""")
def chunk_keys(spark, folder):
    key = chunk_key(F.col("chunk_start"), F.col("chunk_end"), F.array("l_suppkey"))
    return _plans(spark, folder).select("l_suppkey", key.alias("chunk_key"))


@check(PLANS + """, finished AS (
      SELECT l_suppkey, date_trunc('month', l_shipdate) AS m FROM lineitem
      GROUP BY 1, 2 HAVING count(*) % 2 = 1)
    SELECT l_suppkey, strftime(a, '%Y-%m-%d') AS chunk_start FROM plan
    WHERE NOT EXISTS (SELECT 1 FROM finished f WHERE f.l_suppkey = plan.l_suppkey
                      AND f.m = date_trunc('month', a))""")
def open_chunks(spark, folder):
    def key(time):
        return F.concat(F.col("l_suppkey").cast("string"), F.lit("_"),
                        F.date_format(time, "yyyy-MM"))

    per_month = S.table(spark, folder, "lineitem").groupBy(
        "l_suppkey", F.date_trunc("month", "l_shipdate").alias("m")
    ).count()
    finished = per_month.where(F.col("count") % 2 == 1).select(key("m").alias("chunk_key"))
    plan = _plans(spark, folder).withColumn("chunk_key", key("chunk_start"))
    left = months.open_chunks(plan, finished)
    return left.select("l_suppkey", F.date_format("chunk_start", "yyyy-MM-dd").alias("chunk_start"))


@check("""SELECT strftime(greatest(date_trunc('month', l_shipdate), TIMESTAMP '1996-01-15'),
      '%Y-%m-%d') AS chunk_start,
    strftime(least(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH, TIMESTAMP '2000-03-10'),
      '%Y-%m-%d') AS chunk_end, count(*) AS rows
    FROM lineitem WHERE l_shipdate >= '1996-01-15' AND l_shipdate < '2000-03-10' GROUP BY 1, 2""")
def rows_per_chunk(spark, folder):
    lines = S.table(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("t")
    )
    counts = months.rows_per_chunk(lines, "t", date(1996, 1, 15), date(2000, 3, 10))
    return counts.select(
        F.date_format("chunk_start", "yyyy-MM-dd").alias("chunk_start"),
        F.date_format("chunk_end", "yyyy-MM-dd").alias("chunk_end"), "rows",
    )


# --- statistics ------------------------------------------------------------------------
@check(W("log") + "SELECT location_id, outcome FROM outcomes")
def fetch_outcomes(spark, folder):
    return audit.fetch_outcomes(S.fetch_log(spark, folder)).select("location_id", "outcome")


ALLOWED = """, listed AS (
      SELECT CAST(c_custkey AS VARCHAR) AS location_id,
             CASE WHEN c_nationkey >= 20 THEN 'skipped' ELSE coalesce(outcome, 'error') END
               AS outcome
      FROM customer LEFT JOIN outcomes ON outcomes.location_id = CAST(c_custkey AS VARCHAR))
    """


def _listed(spark, folder):
    customers = S.table(spark, folder, "customer")
    every = customers.select(F.col("c_custkey").alias("id"))
    allowed = customers.where(F.col("c_nationkey") < 20).select(F.col("c_custkey").cast("string"))
    return allowed_outcomes(every, S.fetch_log(spark, folder), allowed)


@check(W("log") + ALLOWED + """SELECT CAST(0 AS BIGINT) AS rows_yielded,
    count(*) FILTER (outcome = 'ok') AS locations_fetched,
    count(*) FILTER (outcome = 'skipped') AS locations_skipped,
    count(*) FILTER (outcome = 'no_data') AS locations_no_data,
    count(*) FILTER (outcome = 'error') AS locations_errored FROM listed""")
def ingest_stats(spark, folder):
    return audit.ingest_stats(_listed(spark, folder))


@check(W("log") + ALLOWED + """SELECT CAST(location_id AS BIGINT) // 3 AS part,
    count(*) FILTER (outcome = 'error') > 0 AND count(*) FILTER (outcome = 'ok') = 0 AS fails
    FROM listed GROUP BY 1""")
def failed_ingests(spark, folder):
    """Which parts of the stations would fail an ingest of their own."""
    part = F.floor(F.col("location_id").cast("bigint") / 3).alias("part")
    parts = _listed(spark, folder).select(part, "outcome")
    return audit.ingest_stats_by(parts, ["part"]).select(
        "part", audit.all_failed().alias("fails"))


@check(W("log") + ALLOWED + "SELECT location_id FROM listed WHERE outcome = 'error'")
def failed_fetches(spark, folder):
    return audit.failed_fetches(_listed(spark, folder))


@check(W("readings", "cursors", "log") + """, seen AS (
      SELECT CAST(location_id AS VARCHAR) AS location_id, max("timestamp") AS newest
      FROM readings GROUP BY 1)
    SELECT o.location_id, greatest(coalesce(newest, 0), coalesce(cursor, 0), 1704326400) AS cursor
    FROM outcomes o LEFT JOIN cursors c ON o.location_id = CAST(c.location_id AS VARCHAR)
      LEFT JOIN seen s ON s.location_id = o.location_id WHERE outcome = 'ok'""")
def cursor_advance(spark, folder):
    marks = S.cursors(spark, folder).withColumn("location_id", F.col("location_id").cast("string"))
    fetched = audit.fetch_outcomes(S.fetch_log(spark, folder)).join(marks, "location_id", "left")
    return audit.advanced_cursors(S.readings(spark, folder), fetched, 1704326400)


@check(W("readings", "obs") + """SELECT count(*) AS rows_read,
    count(DISTINCT location_id) AS locations_grouped,
    count(DISTINCT CASE WHEN location_id NOT IN (SELECT location_id FROM failed)
      THEN location_id END) AS bundles_produced,
    (SELECT count(*) FROM failed) AS adapter_failures,
    CAST(1704067200 AS DOUBLE) AS watermark_before, CAST(1705276800 AS DOUBLE) AS watermark_after
    FROM readings WHERE parameter_id = '4'""")
def transform_stats(spark, folder):
    outcomes = LOGGERS.outcomes(LOGGERS.flagged(S.readings(spark, folder)))
    return audit.transform_stats(outcomes, 1704067200.0, 1705276800.0)


@check("""SELECT CAST(sum(r) AS BIGINT) AS rows_ingested, CAST(sum(b) AS BIGINT) AS bundles_loaded,
    CAST(sum(p) AS BIGINT) AS observations_posted,
    CAST(sum(d) AS BIGINT) AS observations_deleted,
    CAST(sum(f) AS BIGINT) AS adapter_failures FROM (
      SELECT count(*) AS r, count(DISTINCT l_suppkey) AS b,
             count(*) FILTER (l_returnflag = 'N') AS p, count(*) FILTER (l_returnflag = 'R') AS d,
             count(*) FILTER (l_quantity = 50) AS f
      FROM lineitem GROUP BY date_trunc('month', l_shipdate))""")
def chunk_totals(spark, folder):
    lines = S.table(spark, folder, "lineitem")
    chunks = lines.groupBy(F.date_trunc("month", "l_shipdate").alias("m")).agg(
        F.count(F.lit(1)).alias("rows_ingested"),
        F.count_distinct("l_suppkey").alias("bundles_loaded"),
        F.count_if(F.col("l_returnflag") == "N").alias("observations_posted"),
        F.count_if(F.col("l_returnflag") == "R").alias("observations_deleted"),
        F.count_if(F.col("l_quantity") == 50).alias("adapter_failures"),
    )
    return audit.chunk_totals(chunks)
