"""Landed vendor payloads to flat raw rows.

Payload files are read with explicit schemas. A page of readings arrives as one JSON line
``{"location_id": …, "page": …, "payload": {…}}``, since a payload alone does not always
name its station; one JSON line is one bounded page, so the files split freely.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stillwell import schemas
from stillwell.functions import reading_id
from stillwell.operators.filters import cut_pages, only_stations
from stillwell.operators.joins import fits_broadcast, lookup_join


DAMAGED = "_corrupt_record"


def _with_damaged(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DAMAGED, T.StringType())])


def read_reading_pages(spark: SparkSession, path: str) -> DataFrame:
    """One page per line; a line that is no whole page keeps its text in ``DAMAGED``."""
    return spark.read.schema(_with_damaged(schemas.READING_PAGE)).json(path)


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole payload files under ``location_id=…/page=…`` folders, as reading pages."""
    located = schemas.READING_PAYLOAD
    files = spark.read.schema(_with_damaged(located)).option("multiLine", "true").json(path)
    return files.select(
        F.col("location_id").cast("bigint"), F.col("page").cast("bigint"),
        F.struct(*located.names).alias("payload"), DAMAGED,
    )


def damaged_pages(pages: DataFrame) -> DataFrame:
    """Damaged pages per station; a null station where the line does not tell it."""
    if DAMAGED not in pages.columns:
        return pages.select("location_id", F.lit(0).cast("bigint").alias("pages")).limit(0)
    named = F.regexp_extract(DAMAGED, r'"location_id"\s*:\s*(\d+)', 1).try_cast("bigint")
    return (
        pages.select(F.coalesce("location_id", named).alias("location_id"), DAMAGED)
        .where(F.col(DAMAGED).isNotNull())
        .groupBy("location_id").agg(F.count(F.lit(1)).alias("pages"))
    )


def require_intact(rows: DataFrame, what: str) -> DataFrame:
    """``rows`` without ``DAMAGED``; reading a damaged record fails instead of losing it."""
    whole = F.when(F.col(DAMAGED).isNull(), F.lit(True)).otherwise(
        F.raise_error(F.lit(f"damaged record in {what}")).cast("boolean")
    )
    return rows.where(whole).drop(DAMAGED)


def flatten_pages(pages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per (station, parameter, reading), still carrying its page."""
    parameters = pages.select(
        "location_id", "page", F.explode("payload.parameters").alias("p"), *carry
    )
    readings = parameters.select(
        *carry, "location_id", "page", F.col("p.parameterId").alias("parameter_id"),
        F.col("p.unitId").alias("unit_id"), F.explode("p.readings").alias("r"),
    )
    return readings.select(
        *carry, reading_id(F.col("location_id"), F.col("parameter_id"), F.col("r.timestamp"))
        .alias("reading_id"),
        "location_id", F.col("r.timestamp").alias("timestamp"), "parameter_id", "unit_id",
        F.col("r.value").alias("value"), "page",
    )


def logger_readings(pages: DataFrame, ids=None) -> DataFrame:
    """Raw logger rows of the allowed stations; the allowlist applies before the explode."""
    kept = pages if ids is None else only_stations(pages, ids)
    return flatten_pages(kept).select(*schemas.LOGGER_READINGS.names)


def window_readings(pages: DataFrame, ids, start: int, end: int) -> DataFrame:
    """Raw rows of a backfill window ``[start, end)`` in seconds, with the page cut-off.
    Readings without a time stay in, since nothing says that they lie outside."""
    rows = flatten_pages(only_stations(pages, ids))
    timeless = F.col("timestamp").isNull()  # these fail their station in the quarantine
    rows = cut_pages(rows.where(timeless | (F.col("timestamp") >= start)), end)
    return rows.select(*schemas.LOGGER_READINGS.names)


def windows_readings(pages: DataFrame, ids, windows: str) -> DataFrame:
    """The same for many windows at once: ``windows`` names a struct of ``start`` and ``end`` that
    says which window a page was fetched for. Rows keep that struct."""
    rows = flatten_pages(only_stations(pages, ids), (windows,))
    start, end = F.col(f"{windows}.start"), F.col(f"{windows}.end")
    rows = rows.where(F.col("timestamp").isNull() | (F.col("timestamp") >= start))
    rows = cut_pages(rows, end, station=[windows, "location_id"])
    return rows.select(*schemas.LOGGER_READINGS.names, windows)


def merge_pages(pages: DataFrame) -> DataFrame:
    """Readings of one station and parameter in page order, numbered; nothing is regrouped.

    The position inside the payload orders readings of one page.
    """
    parameters = pages.select(
        "location_id", "page", F.posexplode("payload.parameters").alias("slot", "p")
    )
    return parameters.select(
        "location_id", F.col("p.parameterId").alias("parameter_id"), "page", "slot",
        F.posexplode("p.readings").alias("slot_position", "r"),
    ).select(
        "location_id", "parameter_id", "page", "slot", "slot_position",
        F.col("r.timestamp").alias("timestamp"), F.col("r.value").alias("value"),
    )


def read_stations(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """The station list payload: JSON array files, or one station per line."""
    reader = spark.read.schema(_with_damaged(schemas.STATION_PAYLOAD))
    stations = reader.option("multiLine", str(not lines).lower()).json(path)
    return require_intact(stations, "the station list")


def flatten_stations(stations: DataFrame) -> DataFrame:
    return stations.select(
        "id", "name", "description",
        F.col("gps.latitude").alias("latitude"), F.col("gps.longitude").alias("longitude"),
    )


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Feature collections, one per line."""
    features = spark.read.schema(_with_damaged(schemas.FEATURE_PAYLOAD)).json(path)
    return require_intact(features, "a feature collection")


def attributes(features: DataFrame) -> DataFrame:
    """One row per feature: its attributes."""
    return features.select(F.explode("features").alias("f")).select("f.attributes.*")


def distinct_stations(rows: DataFrame) -> DataFrame:
    """Distinct (code, name, latitude, longitude); a code may keep several rows."""
    return rows.select("sys_loc_code", "loc_name", "latitude", "longitude").distinct()


def city_readings(measurements: DataFrame, stations: DataFrame) -> DataFrame:
    """Measurements with the metadata of their station, as flat raw rows.

    A station listed twice yields its measurements twice. ``stations`` is not unique by
    code, so beyond the broadcast limit this stays a shuffle join of two plain inputs, whose
    hot partitions adaptive execution splits.
    """
    lookup = stations.select("sys_loc_code", "loc_name", "latitude", "longitude")
    if fits_broadcast(lookup):
        lookup = F.broadcast(lookup)
    facts = measurements.select("sys_loc_code", "measurement_date", "water_depth")
    return facts.join(lookup, "sys_loc_code").select(
        reading_id(F.col("sys_loc_code"), F.col("measurement_date")).alias("reading_id"),
        F.col("sys_loc_code").alias("location_id"), F.col("loc_name").alias("location_name"),
        "latitude", "longitude", F.col("measurement_date").alias("timestamp"),
        F.col("water_depth").alias("value"),
    )


def read_name_table(spark: SparkSession, path: str) -> DataFrame:
    """The vendor's parameter and unit names as rows (kind, code, name)."""
    shape = "parameters map<string,string>, units map<string,string>"
    names = spark.read.schema(f"{shape}, {DAMAGED} string").option("multiLine", "true").json(path)
    return name_rows(require_intact(names, "the name table"))


def name_rows(names: DataFrame) -> DataFrame:
    kinds = F.map_from_arrays(
        F.array(F.lit("parameter"), F.lit("unit")), F.array("parameters", "units")
    )
    return names.select(F.explode(kinds).alias("kind", "m")).select(
        "kind", F.explode("m").alias("code", "name")
    )


def with_names(readings: DataFrame, names: DataFrame) -> DataFrame:
    """Readings with the vendor's name of their parameter; null where it has none."""
    lookup = names.where(F.col("kind") == "parameter").select(
        F.col("code").alias("parameter_id"), F.col("name").alias("parameter_name")
    )
    return lookup_join(readings, lookup, "parameter_id")


def observation_parameters() -> Column:
    """Per-observation metadata from feature attributes; absent entries leave no key.

    Fixed names on the left are the standard keys of the entity model.
    """
    entries = F.create_map(
        F.lit("measuring_agency"), F.col("facility_code"),
        F.lit("measurement_method"), F.col("measurement_method"),
        F.lit("water_level_status"), F.col("dry_indicator_yn"),
    )
    kept = F.map_filter(entries, lambda _, value: value.isNotNull())
    return F.when(F.size(kept) > 0, kept)


def read_wells(spark: SparkSession, path: str) -> DataFrame:
    """Wells of the third source, one per line."""
    wells = spark.read.schema(_with_damaged(schemas.WELL_PAYLOAD)).json(path)
    return require_intact(wells, "the well list")


def read_levels(spark: SparkSession, path: str) -> DataFrame:
    """Levels of the third source, one well's arrays per line."""
    levels = spark.read.schema(_with_damaged(schemas.LEVEL_PAYLOAD)).json(path)
    return require_intact(levels, "a level payload")


def flatten_levels(levels: DataFrame) -> DataFrame:
    """Depth readings of the third source; the array a reading sits in is its quality."""
    def side(column: str, quality: str) -> DataFrame:
        return levels.select("uid", F.explode(column).alias("r")).select(
            F.col("uid").alias("location_id"), F.col("r.ts").alias("timestamp"),
            F.col("r.gs").alias("value"), F.lit(quality).alias("result_quality"),
        )

    return side("approvedWaterLevelsGs", "approved").unionByName(
        side("unApprovedWaterLevelsGs", "unapproved")
    )
