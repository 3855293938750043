"""Sources as data: what to keep, what fails a station, and how rows map."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stillwell import constants as C, schemas
from stillwell.functions import (
    centimetres_to_feet, location_key, metres_to_feet, time_from_millis, time_from_seconds,
)
from stillwell.operators import mapping
from stillwell.operators.filters import depth_rows

ARRIVAL = ["load_id", "file", "row"]


@dataclass(frozen=True)
class SourceSpec:
    """One source, as pure functions over DataFrames and columns."""

    name: str
    agency: str
    dataset: str
    schema: T.StructType
    readings_table: str
    stations_table: str | None
    backfill_table: str
    sensor: tuple
    location_text: str
    keep: Callable[[DataFrame], DataFrame]
    failure: Callable[[], Column]
    time: Callable[[], Column]
    result: Callable[[], Column]
    stations: Callable[..., DataFrame]  # of outcomes, station table, whether outcomes are few
    first_columns: tuple[str, ...] = ()
    specific: Callable[[], Column | None] = lambda: None
    location_specific: Callable[[], Column | None] | None = None
    quality: Callable[[], Column | None] = lambda: None
    parameters: Callable[[], Column | None] = lambda: None
    shown_agency: str | None = None
    ids_carry_agency: bool = False
    default_ids: tuple = ()

    # -- steps ---------------------------------------------------------------------------
    def flagged(self, raw: DataFrame) -> DataFrame:
        """Kept rows with the reason, if any, that fails their station."""
        return self.keep(raw).withColumn("failure", self.failure())

    def outcomes(self, flagged: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
        first = list(self.first_columns)
        return mapping.station_outcomes(flagged, first or None, ARRIVAL if first else None, by)

    def source_id(self) -> Column:
        return F.col("location_id").cast("string")

    def key(self) -> Column:
        """Thing key; ids that already carry the agency are not prefixed twice."""
        source = self.source_id()
        return source if self.ids_carry_agency else location_key(self.agency, source)

    def stream_key(self, suffix: str = "dtw") -> Column:
        return F.concat(self.key(), F.lit(f"-{suffix}"))

    def observations(self, rows: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
        return mapping.observations(
            rows, self.agency, self.time(), self.result(), key=self.stream_key(),
            parameters=self.parameters(), quality=self.quality(), carry=carry,
        )

    def entities(self, stations: DataFrame) -> dict[str, DataFrame]:
        """The five entity tables of these stations, in foreign-key order."""
        spark = stations.sparkSession
        on_location = (self.location_specific or self.specific)()
        place = mapping.locations(
            stations, self.agency, self.location_text, on_location, self.source_id(), self.key()
        )
        thing = mapping.things(
            stations, self.agency, self.specific(), self.source_id(), self.key(),
            self.shown_agency,
        )
        return {
            "location": place,
            "thing": thing,
            "sensor": mapping.sensors(spark, self.sensor),
            "observed_property": mapping.observed_properties(spark, C.DEPTH_TO_WATER),
            "datastream": mapping.level_datastreams(thing, self.sensor),
        }


def _bad_time(seconds: Column) -> Column:
    return (
        F.when(seconds.isNull(), F.lit("null timestamp"))
        .when(mapping.out_of_range(seconds), F.lit("timestamp out of range"))
    )


# --- logger network --------------------------------------------------------------------
def _logger_failure() -> Column:
    missing_value = F.when(F.col("value").isNull(), F.lit("null value"))
    return F.coalesce(missing_value, _bad_time(F.col("timestamp")))


def _logger_time() -> Column:
    seconds = F.col("timestamp")
    return F.when(~mapping.out_of_range(seconds), time_from_seconds(seconds))


def _description() -> Column:
    return F.create_map(F.lit("hydrovu_description"), F.col("location_description"))


LOGGERS = SourceSpec(
    **C.LOGGER_SOURCE, schema=schemas.LOGGER_READINGS, sensor=C.LOGGER_SENSOR,
    location_text=C.LOCATION_MADE, keep=depth_rows, failure=_logger_failure, time=_logger_time,
    result=lambda: metres_to_feet(F.col("value")),
    stations=mapping.describe_stations, specific=_description,
)


# --- city wells ------------------------------------------------------------------------
def _city_time() -> Column:
    millis = F.col("timestamp")
    return F.when(~mapping.out_of_range(millis / 1000), time_from_millis(millis))


CITY_WELLS = SourceSpec(
    **C.CITY_SOURCE, schema=schemas.CITY_READINGS, sensor=C.MANUAL_SENSOR,
    location_text=C.LOCATION_COLLECTED, keep=lambda raw: raw,
    failure=lambda: _bad_time(F.col("timestamp") / 1000), time=_city_time,
    result=lambda: F.col("value"),
    stations=lambda outcomes, _table, small=None: mapping.name_stations(outcomes),
    first_columns=("location_name", "latitude", "longitude"),
)


# --- diver wells (mapped in documents only, so not scheduled) --------------------------
def diver_stations(wells: DataFrame) -> DataFrame:
    """Wells of the third source as a station table with its source-specific facts."""
    specific = F.create_map(
        F.lit("well_depth_ft"), centimetres_to_feet(F.col("drillingDepth")).cast("string"),
        F.lit("number_of_screens"), F.col("numberOfScreens").cast("string"),
        F.lit("purpose"), F.col("purpose"),
        F.lit("is_active"), F.col("isActive").cast("string"),
        F.lit("installation_date"), F.col("installationDate"),
        F.lit("monitoring_point_names"),
        F.to_json(F.transform("monitoringPoints", lambda p: p["name"])),
    )
    return wells.select(
        F.col("uid").alias("location_id"), F.col("name").alias("location_name"),
        F.col("lat").alias("latitude"), F.col("lng").alias("longitude"),
        F.map_filter(specific, lambda _, v: v.isNotNull()).alias("specific"),
    )


DIVERS = SourceSpec(
    **C.DIVER_SOURCE, schema=schemas.DIVER_READINGS, sensor=C.DIVER_SENSOR, location_text=C.LOCATION_MADE, keep=lambda raw: raw,
    failure=_logger_failure, time=_logger_time, result=lambda: F.col("value"),
    stations=lambda outcomes, table, small=None: outcomes.select("location_id").join(
        table, "location_id"),
    specific=lambda: F.col("specific"),
    location_specific=lambda: F.create_map().cast("map<string,string>"),
    quality=lambda: F.col("result_quality"), shown_agency="SanAcaciaReach",
    ids_carry_agency=True,
)
