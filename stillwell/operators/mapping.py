"""Raw readings and stations to the entity model."""

from pyspark.sql import Column, DataFrame, functions as F

from stillwell import constants as C, schemas
from stillwell.functions import datastream_key, location_key
from stillwell.operators.joins import lookup_join
from stillwell.operators.ordering import paged
from stillwell.session import settle


# --- stations --------------------------------------------------------------------------
def describe_stations(
    ids: DataFrame, table: DataFrame, small: bool | None = None
) -> DataFrame:
    """Each ``location_id`` (given once) with what the station table says about it. ``small``:
    the ids are known to fit a broadcast, and with them the rows of the table that they need.

    A station missing from the table gets empty texts and no coordinates; a null that the
    table itself holds stays null.
    """
    wanted = ids.select("location_id")
    if small:
        own = wanted.select(F.col("location_id").alias("id"))
        table = table.join(F.broadcast(own), "id", "left_semi")
    return with_station(wanted, table, small or None).select(
        "location_id", "location_name", "location_description", "latitude", "longitude"
    )


def stations_of(readings: DataFrame, table: DataFrame) -> DataFrame:
    """One described row per station present in ``readings``."""
    return describe_stations(readings.select("location_id").distinct(), table)


def with_station(
    readings: DataFrame, table: DataFrame, small: bool | None = None
) -> DataFrame:
    """Readings with the same metadata on every row."""
    known = table.select(
        F.col("id").alias("location_id"), F.col("name").alias("_name"),
        F.col("description").alias("_text"), "latitude", "longitude",
        F.lit(True).alias("_known"),
    )
    joined = lookup_join(readings, known, "location_id", small=small)
    absent = F.col("_known").isNull()
    return joined.withColumns({
        "location_name": F.when(absent, F.lit("")).otherwise(F.col("_name")),
        "location_description": F.when(absent, F.lit("")).otherwise(F.col("_text")),
    }).drop("_name", "_text", "_known")


def first_row_stations(readings: DataFrame, order: list[str]) -> DataFrame:
    """One row per station with the metadata of its first row; a null name becomes the id."""
    names = ["location_name", "latitude", "longitude"]
    unflagged = readings.withColumn("failure", F.lit(None).cast("string"))
    return name_stations(station_outcomes(unflagged, names, order))


def name_stations(outcomes: DataFrame) -> DataFrame:
    """Station rows from outcomes that carry the metadata of the first row."""
    return outcomes.select(
        "location_id",
        F.coalesce("first.location_name", F.col("location_id").cast("string"))
        .alias("location_name"),
        F.lit(None).cast("string").alias("location_description"),
        "first.latitude", "first.longitude",
    )


def station_pages(
    readings: DataFrame, order: list[str], *, size: int = C.CHUNK_SIZE,
    group_limit: int | None = None,
) -> DataFrame:
    """Readings per station in arrival order, as pages of at most ``size`` readings."""
    fields = [c for c in ("parameter_id", "unit_id", "timestamp", "value")
              if c in readings.columns]
    return paged(readings, ["location_id"], order, fields, size=size, group_limit=group_limit)


# --- entities --------------------------------------------------------------------------
def _nothing(kind: str) -> Column:
    return F.lit(None).cast(kind)


def properties(
    key: Column, source_id: Column, agency: str | None, specific: Column | None = None
) -> Column:
    """The properties struct; agency is set on things only."""
    kinds = {f.name: f.dataType.simpleString() for f in schemas.PROPERTIES.fields}
    extra = F.create_map().cast(kinds["source_specific"]) if specific is None else specific
    return F.struct(
        source_id.cast("string").alias("source_id"),
        (F.lit(agency) if agency else _nothing("string")).alias("agency"),
        _nothing("string").alias("geoconnex"),
        _nothing(kinds["alternate_id"]).alias("alternate_id"),
        extra.alias("source_specific"),
        key.alias("externalId"),
    )


def point(longitude: Column, latitude: Column) -> Column:
    return F.struct(
        F.lit("Point").alias("type"), F.array(longitude, latitude).alias("coordinates")
    )


def locations(
    stations: DataFrame, agency: str, text: str, specific: Column | None = None,
    source_id: Column | None = None, key: Column | None = None,
) -> DataFrame:
    source = F.col("location_id").cast("string") if source_id is None else source_id
    key = location_key(agency, source) if key is None else key
    return stations.select(
        key.alias("external_key"), F.col("location_name").alias("name"),
        F.lit(text).alias("description"), F.lit(C.GEOJSON_ENCODING).alias("encoding_type"),
        point(F.col("longitude"), F.col("latitude")).alias("geometry"),
        properties(key, source, None, specific).alias("properties"),
    )


def things(
    stations: DataFrame, agency: str, specific: Column | None = None,
    source_id: Column | None = None, key: Column | None = None, shown_agency: str | None = None,
) -> DataFrame:
    source = F.col("location_id").cast("string") if source_id is None else source_id
    key = location_key(agency, source) if key is None else key
    shown = shown_agency or agency.upper()
    return stations.select(
        key.alias("external_key"), F.lit(C.THING_NAME).alias("name"),
        F.lit(C.THING_DESCRIPTION).alias("description"), key.alias("location_key"),
        properties(key, source, shown, specific).alias("properties"),
    )


def unit(values: tuple[str, str, str]) -> Column:
    names = schemas.UNIT.names
    return F.struct(*[F.lit(v).alias(n) for n, v in zip(names, values)])


def _datastream(thing: DataFrame, suffix: str, sensor: tuple, prop: tuple,
                name: str, text: Column, measured: tuple) -> DataFrame:
    key = F.concat("external_key", F.lit("-" + suffix))
    bare = F.struct(
        *[_nothing(f.dataType.simpleString()).alias(f.name)
          for f in schemas.PROPERTIES.fields[:-1]],
        key.alias("externalId"),
    )
    return thing.select(
        key.alias("external_key"), F.lit(name).alias("name"), text.alias("description"),
        F.lit(C.OM_MEASUREMENT).alias("observation_type"),
        unit(measured).alias("unit_of_measurement"),
        F.col("external_key").alias("thing_key"), F.lit(sensor[0]).alias("sensor_key"),
        F.lit(prop[0]).alias("observed_property_key"), bare.alias("properties"),
    )


def level_datastreams(thing: DataFrame, sensor: tuple) -> DataFrame:
    """The depth-to-water datastream of every thing."""
    return _datastream(thing, "dtw", sensor, C.DEPTH_TO_WATER, C.LEVELS_NAME,
                       F.lit(C.LEVELS_DESCRIPTION), C.UNIT_FOOT)


def elevation_datastreams(thing: DataFrame, agency: str, sensor: tuple) -> DataFrame:
    """The elevation datastream of every thing; its text names agency and thing."""
    text = F.concat(F.lit(f"{C.ELEVATIONS_PREFIX}{agency.upper()} "), F.col("name"))
    return _datastream(thing, "gwe", sensor, C.WATER_ELEVATION, C.ELEVATIONS_NAME,
                       text, C.UNIT_FOOT)


def sensors(spark, *rows: tuple) -> DataFrame:
    blank = [(*r, {"externalId": r[0]}) for r in rows]
    return spark.createDataFrame(blank, schemas.SENSOR)


def observed_properties(spark, *rows: tuple) -> DataFrame:
    blank = [(*r, {"externalId": r[0]}) for r in rows]
    return spark.createDataFrame(blank, schemas.OBSERVED_PROPERTY)


# --- readings to observations ----------------------------------------------------------
def out_of_range(seconds: Column) -> Column:
    return (seconds < F.lit(C.EARLIEST_SECOND)) | (seconds > F.lit(C.LATEST_SECOND))


def station_outcomes(
    flagged: DataFrame, first: list[str] | None = None, order: list[str] | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Rows and failure reason per station: one bad reading fails the whole station. ``by`` may
    name columns whose values are judged apart.

    ``first`` names columns whose values on the station's first row (by ``order``) ride
    along as a struct, so no second pass is needed for them.

    The first aggregate keeps text in its keys and only numbers in its values, which is what
    Spark's hash aggregate can hold; each task so shrinks its files to a few rows per
    station before anything is shuffled.
    """
    own = [*by, "location_id"]
    keys = [*own, "failure"]
    counted = [F.count(F.lit(1)).alias("rows")]
    if first:
        keys += [c for c in (*first, *order[:-1]) if c not in keys]
        counted.append(F.min(order[-1]).alias(order[-1]))
    small = flagged.groupBy(*keys).agg(*counted)
    bad = F.when(F.col("failure").isNotNull(), F.col("rows")).otherwise(0)
    totals = [
        F.sum("rows").alias("rows"), F.min("failure").alias("failure"),
        F.sum(bad).alias("bad_rows"),
    ]
    if first:
        totals.append(F.min_by(F.struct(*first), F.struct(*order)).alias("first"))
    return small.groupBy(*own).agg(*totals)


def is_failed() -> Column:
    """A station with a bad reading; rows without a station count as one more."""
    return F.col("failure").isNotNull() | F.col("location_id").isNull()


def failed_stations(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(is_failed())


def good_rows(
    flagged: DataFrame, outcomes: DataFrame, *, small: bool | None = None
) -> DataFrame:
    """Rows of the stations without a failure."""
    failed = failed_stations(outcomes).select("location_id")
    kept = lookup_join(flagged, failed, "location_id", "left_anti", small=small)
    return kept.where(F.col("location_id").isNotNull())


def observations(
    rows: DataFrame, agency: str, time: Column, result: Column, *, suffix: str = "dtw",
    source_id: Column | None = None, key: Column | None = None, parameters: Column | None = None,
    quality: Column | None = None, carry: tuple[str, ...] = (),
) -> DataFrame:
    """A narrow projection: one observation per reading."""
    source = F.col("location_id").cast("string") if source_id is None else source_id
    key = datastream_key(agency, source, suffix) if key is None else key
    return rows.select(
        key.alias("datastream_key"), time.alias("phenomenon_time"), result.alias("result"),
        (_nothing("map<string,string>") if parameters is None else parameters)
        .alias("parameters"),
        (_nothing("string") if quality is None else quality).alias("result_quality"),
        *carry,
    )


def property_rows(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Several datastreams per station: one row per (reading, suffix) with a value."""
    pairs = F.array(*[
        F.struct(F.lit(suffix).alias("suffix"), F.col(name).cast("double").alias("value"))
        for suffix, name in columns.items()
    ])
    kept = [c for c in rows.columns if c not in columns.values()]
    flat = rows.select(*kept, F.explode(pairs).alias("_p"))
    return flat.select(*kept, "_p.suffix", "_p.value").where(F.col("value").isNotNull())


def load_records(obs: DataFrame) -> DataFrame:
    """What a load needs of an observation: its time and its result, per datastream."""
    return obs.select("datastream_key", "phenomenon_time", "result")


def bundles(
    datastreams: DataFrame, obs: DataFrame, order: list[str], *, size: int = C.CHUNK_SIZE,
    group_limit: int | None = None,
) -> DataFrame:
    """Per thing and page: its datastreams, and a map of datastream key to observations.

    A thing has one datastream per observed property, so both collections stay small;
    observations are paged, at most ``size`` per datastream and page. A thing without
    observations keeps one page with an empty map.
    """
    fields = ["phenomenon_time", "result"]
    pages = paged(obs, ["datastream_key"], order, fields, size=size, into="observations",
                  group_limit=group_limit)
    owner = datastreams.select(F.col("external_key").alias("datastream_key"), "thing_key")
    packed = lookup_join(pages, owner, "datastream_key", "inner").groupBy(
        "thing_key", "page"
    ).agg(
        F.map_from_entries(F.collect_list(F.struct("datastream_key", "observations")))
        .alias("observations")
    )
    listed = settle(datastreams.groupBy("thing_key").agg(
        F.array_sort(F.collect_list("external_key")).alias("datastreams")
    ))
    filled = lookup_join(packed, listed, "thing_key", "inner")
    keys = obs.select("datastream_key").distinct()
    observed = keys.join(owner, "datastream_key").select("thing_key").distinct()
    shape = packed.schema["observations"].dataType.simpleString()
    bare = lookup_join(listed, observed, "thing_key", "left_anti", derived=True).select(
        "thing_key", "datastreams", F.lit(0).cast("bigint").alias("page"),
        F.create_map().cast(shape).alias("observations"),
    )
    columns = ["thing_key", "page", "datastreams", "observations"]
    return filled.select(*columns).unionByName(bare.select(*columns))
