"""Vendor payloads, written from the supplied tables and read back as landed files."""

from pyspark.sql import functions as F

from stillwell.checks import standins as S
from stillwell.checks.reads import W
from stillwell.checks.registry import check
from stillwell.operators import mapping
from stillwell.sources import landing
from stillwell.sources.specs import DIVERS, diver_stations

PAGE = 200


def reading_pages(rows):
    """Readings as payload pages of one station; a page spans ``PAGE`` arrivals at most."""
    page = F.call_function("div", F.col("row"), F.lit(PAGE))
    reading = F.struct("row", "timestamp", "value")
    parameters = rows.groupBy(
        "location_id", page.alias("page"), "parameter_id", "unit_id"
    ).agg(F.array_sort(F.collect_list(reading)).alias("r")).select(
        "location_id", "page",
        F.struct(
            F.col("parameter_id").alias("parameterId"), F.col("unit_id").alias("unitId"),
            F.lit(False).alias("customParameter"),
            F.transform("r", lambda x: F.struct(x["timestamp"].alias("timestamp"),
                                                x["value"].alias("value"))).alias("readings"),
        ).alias("p"),
    )
    packed = parameters.groupBy("location_id", "page").agg(
        F.array_sort(F.collect_list("p")).alias("ps")
    )
    return packed.select(
        "location_id", "page",
        F.struct(F.col("location_id").alias("locationId"), F.col("ps").alias("parameters"))
        .alias("payload"),
    )


def _landed_pages(spark, folder):
    path = S.scratch(spark, "pages")
    reading_pages(S.readings(spark, folder)).write.json(path)
    return landing.read_reading_pages(spark, path)


@check(W("readings") + """SELECT reading_id, location_id, "timestamp", parameter_id, unit_id, value
    FROM readings""")
def landed_readings(spark, folder):
    return landing.logger_readings(_landed_pages(spark, folder))


@check(W("readings") + """SELECT location_id, parameter_id, event_id // 200 AS page,
    dense_rank() OVER (PARTITION BY location_id, event_id // 200
      ORDER BY parameter_id NULLS FIRST, unit_id NULLS FIRST) - 1 AS slot,
    row_number() OVER (PARTITION BY location_id, event_id // 200, parameter_id, unit_id
      ORDER BY event_id) - 1 AS slot_position, "timestamp", value FROM readings""")
def merged_pages(spark, folder):
    merged = landing.merge_pages(_landed_pages(spark, folder))
    places = [F.col(c).cast("bigint").alias(c) for c in ("slot", "slot_position")]
    return merged.select("location_id", "parameter_id", "page", *places, "timestamp", "value")


@check(W("readings") + """, early AS (SELECT *, event_id // 200 AS page FROM readings
      WHERE "timestamp" >= 1704326400
        AND location_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20)),
    cuts AS (SELECT location_id, min(page) AS cut FROM early
             WHERE "timestamp" >= 1705276800 GROUP BY 1)
    SELECT reading_id, "timestamp" FROM early LEFT JOIN cuts USING (location_id)
    WHERE "timestamp" < 1705276800 AND (cut IS NULL OR page <= cut)""")
def landed_window(spark, folder):
    ids = S.table(spark, folder, "supplier").where(F.col("s_nationkey") < 20).select("s_suppkey")
    rows = landing.window_readings(_landed_pages(spark, folder), ids, 1704326400, 1705276800)
    return rows.select("reading_id", "timestamp")


@check(W("stations") + "SELECT id, name, description, latitude, longitude FROM stations")
def landed_stations(spark, folder):
    path = S.scratch(spark, "stations")
    S.stations(spark, folder).select(
        "id", "name", "description", F.struct("latitude", "longitude").alias("gps")
    ).write.json(path)
    return landing.flatten_stations(landing.read_stations(spark, path, lines=True))


def _features(spark, folder):
    """Each measurement as a feature collection of one."""
    path = S.scratch(spark, "features")
    rows = S.city(spark, folder).select(
        F.col("location_id").alias("sys_loc_code"), F.col("location_name").alias("loc_name"),
        "latitude", "longitude", F.col("timestamp").alias("measurement_date"),
        F.col("value").alias("water_depth"),
    )
    one = F.array(F.struct(F.struct(*rows.columns).alias("attributes")))
    rows.select(one.alias("features")).write.json(path)
    return landing.read_features(spark, path)


@check(W("city") + """SELECT location_id AS sys_loc_code, location_name AS loc_name,
    latitude, longitude, "timestamp" AS measurement_date, value AS water_depth FROM city""")
def landed_attributes(spark, folder):
    rows = landing.attributes(_features(spark, folder))
    return rows.select("sys_loc_code", "loc_name", "latitude", "longitude",
                       "measurement_date", "water_depth")


@check(W("city") + """SELECT DISTINCT location_id AS sys_loc_code, location_name AS loc_name,
    latitude, longitude FROM city""")
def distinct_stations(spark, folder):
    return landing.distinct_stations(landing.attributes(_features(spark, folder)))


@check(W("city") + """, places AS (
      SELECT concat('W', s_suppkey) AS code, s_name, s_acctbal FROM supplier
      UNION SELECT concat('W', s_suppkey), 'Relocated', s_acctbal FROM supplier
      WHERE s_nationkey = 5)
    SELECT reading_id, location_id, s_name AS location_name, s_acctbal AS latitude,
           "timestamp", value FROM city JOIN places ON code = location_id""")
def city_rows(spark, folder):
    """A code listed with two names yields its measurements twice."""
    places = S.table(spark, folder, "supplier").select(
        F.concat(F.lit("W"), F.col("s_suppkey").cast("string")).alias("sys_loc_code"),
        F.col("s_name").alias("loc_name"), F.col("s_acctbal").alias("latitude"),
        F.lit(0.0).alias("longitude"), "s_nationkey",
    )
    moved = places.where(F.col("s_nationkey") == 5).withColumn("loc_name", F.lit("Relocated"))
    stations = landing.distinct_stations(places.unionByName(moved))
    rows = landing.attributes(_features(spark, folder))
    return landing.city_readings(rows, stations).drop("longitude")


@check("""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
    CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS agency,
    CASE WHEN l_linenumber > 3 THEN l_linestatus END AS method,
    CASE WHEN l_quantity < 25 THEN 'Y' END AS dry,
    CAST((l_returnflag <> 'N')::INT + (l_linenumber > 3)::INT + (l_quantity < 25)::INT AS BIGINT)
      AS entries FROM lineitem""")
def observation_parameters(spark, folder):
    rows = S.table(spark, folder, "lineitem").withColumns({
        "facility_code": F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")),
        "measurement_method": F.when(F.col("l_linenumber") > 3, F.col("l_linestatus")),
        "dry_indicator_yn": F.when(F.col("l_quantity") < 25, F.lit("Y")),
    }).withColumn("m", landing.observation_parameters())
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.col("m")["measuring_agency"].alias("agency"),
        F.col("m")["measurement_method"].alias("method"),
        F.col("m")["water_level_status"].alias("dry"),
        F.coalesce(F.size("m"), F.lit(0)).cast("bigint").alias("entries"),
    )


@check("""SELECT concat('cabq-W', l_suppkey, '-dtw') AS datastream_key, l_orderkey,
      l_quantity AS result FROM lineitem WHERE l_quantity <> 50
    UNION ALL SELECT concat('cabq-W', l_suppkey, '-gwe'), l_orderkey, l_extendedprice
    FROM lineitem""")
def property_observations(spark, folder):
    rows = S.city(spark, folder)
    several = mapping.property_rows(
        rows.select("location_id", "timestamp", "l_orderkey", "value",
                    F.col("l_extendedprice").alias("elevation")),
        {"dtw": "value", "gwe": "elevation"},
    )
    obs = mapping.observations(
        several, "CABQ", F.timestamp_millis("timestamp"), F.col("value"), suffix=F.col("suffix"),
        carry=("l_orderkey",),
    )
    return obs.select("datastream_key", "l_orderkey", "result")


@check("""SELECT p_partkey, concat('sanacaciareach-', p_partkey) AS external_key,
    p_name AS name, CAST(p_size AS VARCHAR) AS screens, concat('["', p_brand, '"]') AS points,
    p_retailprice / CAST(30.48 AS DOUBLE) AS depth_ft FROM part""")
def diver_wells(spark, folder):
    wells = S.table(spark, folder, "part").select(
        "p_partkey", F.concat(F.lit("sanacaciareach-"), F.col("p_partkey").cast("string"))
        .alias("uid"), F.col("p_name").alias("name"), F.lit(34.0).alias("lat"),
        F.lit(-106.8).alias("lng"), F.lit(True).alias("isActive"),
        F.lit("MonitoringWell").alias("purpose"), F.col("p_retailprice").alias("drillingDepth"),
        F.col("p_size").alias("numberOfScreens"), F.lit(None).cast("string")
        .alias("installationDate"),
        F.array(F.struct(F.col("p_partkey").alias("id"), F.col("p_brand").alias("name"),
                         F.lit(True).alias("isActive"))).alias("monitoringPoints"),
    )
    things = DIVERS.entities(diver_stations(wells))["thing"]
    places = DIVERS.entities(diver_stations(wells))["location"].select(
        "external_key", "name"
    )
    facts = F.col("properties.source_specific")
    return things.drop("name").join(places, "external_key").select(
        F.regexp_extract("external_key", r"(\d+)$", 1).cast("bigint").alias("p_partkey"),
        "external_key", "name", facts["number_of_screens"].alias("screens"),
        facts["monitoring_point_names"].alias("points"),
        facts["well_depth_ft"].cast("double").alias("depth_ft"),
    )


@check("""SELECT concat('sanacaciareach-', user_id) AS location_id,
    epoch_us(ts) // 1000000 AS second, value,
    CASE event_type WHEN 'view' THEN 'approved' ELSE 'unapproved' END AS result_quality
    FROM events""")
def diver_levels(spark, folder):
    events = S.table(spark, folder, "events")
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    one = F.array(F.struct(second.alias("ts"), F.col("value").alias("gs")))
    nothing = F.array().cast("array<struct<ts:bigint,gs:double>>")
    levels = events.select(
        F.concat(F.lit("sanacaciareach-"), F.col("user_id").cast("string")).alias("uid"),
        F.when(F.col("event_type") == "view", one).otherwise(nothing)
        .alias("approvedWaterLevelsGs"),
        F.when(F.col("event_type") == "view", nothing).otherwise(one)
        .alias("unApprovedWaterLevelsGs"),
    )
    obs = DIVERS.observations(landing.flatten_levels(levels))
    return obs.select(
        F.regexp_replace("datastream_key", "-dtw$", "").alias("location_id"),
        F.unix_seconds("phenomenon_time").alias("second"), F.col("result").alias("value"),
        "result_quality",
    )


@check("""SELECT s_suppkey, n_name AS parameter_name FROM supplier
    JOIN nation ON n_nationkey = s_nationkey""")
def named_parameters(spark, folder):
    """A name table, packed like the vendor's and unpacked again, joined to its codes."""
    pairs = F.map_from_entries(F.collect_list(
        F.struct(F.col("n_nationkey").cast("string"), F.col("n_name"))
    ))
    packed = S.table(spark, folder, "nation").agg(
        pairs.alias("parameters"), F.create_map().cast("map<string,string>").alias("units")
    )
    path = S.scratch(spark, "names")
    packed.coalesce(1).write.json(path)
    names = landing.read_name_table(spark, path).where(F.col("kind") == "parameter")
    coded = S.table(spark, folder, "supplier").select(
        "s_suppkey", F.col("s_nationkey").cast("string").alias("parameter_id")
    )
    return landing.with_names(coded, names).select("s_suppkey", "parameter_name")

