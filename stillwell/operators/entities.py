"""Entity tables: what is missing, how they link, how they read back together."""

from pyspark.sql import Column, DataFrame, functions as F

from stillwell.operators.joins import lookup_join


def new_entities(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates whose key the table lacks; existing rows are never changed."""
    keys = existing.select("external_key")
    return candidates.join(keys, "external_key", "left_anti").dropDuplicates(["external_key"])


def missing_keys(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Keys of any entity table that it lacks, each once, and how often they are given."""
    by = ["entity", "external_key"]
    return candidates.groupBy(*by).agg(F.count(F.lit(1)).alias("copies")).join(
        existing, by, "left_anti")


def entity_id(key: Column) -> Column:
    """A stable integer id of an external key."""
    return F.xxhash64(key)


def linked_datastreams(
    datastreams: DataFrame, things: DataFrame, sensors: DataFrame, properties: DataFrame
) -> DataFrame:
    """Datastreams with every foreign key resolved; an unresolved one drops out."""
    thing = things.select(F.col("external_key").alias("thing_key"), "location_key")
    # Every datastream of a source shares one sensor, so these two keys are as hot as can be.
    sensor = sensors.select(F.col("external_key").alias("sensor_key"))
    prop = properties.select(F.col("external_key").alias("observed_property_key"))
    flat = datastreams.select(
        F.col("external_key").alias("datastream_key"), "thing_key", "sensor_key",
        "observed_property_key",
    ).join(thing, "thing_key")
    flat = lookup_join(flat, sensor, "sensor_key", "inner")
    flat = lookup_join(flat, prop, "observed_property_key", "inner")
    return flat.select(
        "datastream_key", "thing_key", "location_key", "sensor_key", "observed_property_key",
        entity_id(F.col("datastream_key")).alias("datastream_id"),
        entity_id(F.col("thing_key")).alias("thing_id"),
    )


def expanded(
    things: DataFrame, locations: DataFrame, datastreams: DataFrame, sensors: DataFrame,
    properties: DataFrame,
) -> DataFrame:
    """Every thing with its location and datastreams, one flat row per datastream."""
    place = locations.select(
        F.col("external_key").alias("location_key"), F.col("name").alias("location_name"),
        F.col("geometry.coordinates").alias("coordinates"),
    )
    sensor = sensors.select(
        F.col("external_key").alias("sensor_key"), F.col("name").alias("sensor_name")
    )
    prop = properties.select(
        F.col("external_key").alias("observed_property_key"),
        F.col("name").alias("observed_property_name"),
    )
    stream = datastreams.select(
        "thing_key", F.col("external_key").alias("datastream_key"),
        F.col("name").alias("datastream_name"), "sensor_key", "observed_property_key",
        F.col("unit_of_measurement.symbol").alias("unit_symbol"),
    )
    stream = lookup_join(lookup_join(stream, sensor, "sensor_key"), prop, "observed_property_key")
    base = things.select(F.col("external_key").alias("thing_key"), "location_key",
                         F.col("name").alias("thing_name"))
    return base.join(place, "location_key", "left").join(stream, "thing_key", "left")


def nested(flat: DataFrame) -> DataFrame:
    """One row per thing with its datastreams as an array.

    The array has one entry per observed property of the thing, a handful by construction
    of the datastream key.
    """
    entry = F.struct("datastream_key", "datastream_name", "unit_symbol", "sensor_name",
                     "observed_property_name")
    listed = F.collect_list(F.when(F.col("datastream_key").isNotNull(), entry))
    return flat.groupBy("thing_key", "thing_name", "location_name", "coordinates").agg(
        F.array_sort(listed).alias("datastreams")
    )


def observation_counts(target: DataFrame) -> DataFrame:
    return target.groupBy("datastream_key").agg(F.count(F.lit(1)).alias("observations"))


def observation_count(target: DataFrame) -> DataFrame:
    return target.agg(F.count(F.lit(1)).alias("observations"))
