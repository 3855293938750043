"""Explicit schemas; nothing in this package infers one."""

from pyspark.sql import types as T


def _fields(*pairs):
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
TIME, BOOL, INT = T.TimestampType(), T.BooleanType(), T.IntegerType()

# --- vendor payloads -------------------------------------------------------------------
READING_PAYLOAD = _fields(
    ("locationId", LONG),
    ("parameters", T.ArrayType(_fields(
        ("parameterId", STRING),
        ("unitId", STRING),
        ("customParameter", BOOL),
        ("readings", T.ArrayType(_fields(("timestamp", LONG), ("value", DOUBLE)))),
    ))),
)
READING_PAGE = _fields(("location_id", LONG), ("page", LONG), ("payload", READING_PAYLOAD))

STATION_PAYLOAD = _fields(
    ("id", LONG), ("name", STRING), ("description", STRING),
    ("gps", _fields(("latitude", DOUBLE), ("longitude", DOUBLE))),
)

FEATURE_ATTRIBUTES = _fields(
    ("sys_loc_code", STRING), ("loc_name", STRING),
    ("latitude", DOUBLE), ("longitude", DOUBLE),
    ("measurement_date", LONG), ("water_depth", DOUBLE), ("depth_unit", STRING),
    ("facility_code", STRING), ("measurement_method", STRING), ("dry_indicator_yn", STRING),
    ("reference_elev", DOUBLE), ("water_level", STRING), ("exact_elev", DOUBLE),
    ("measured_depth_of_well", DOUBLE),
)
FEATURE_PAYLOAD = _fields(
    ("features", T.ArrayType(_fields(("attributes", FEATURE_ATTRIBUTES)))),
)

WELL_PAYLOAD = _fields(
    ("uid", STRING), ("name", STRING), ("lat", DOUBLE), ("lng", DOUBLE), ("isActive", BOOL),
    ("purpose", STRING), ("drillingDepth", DOUBLE), ("numberOfScreens", INT),
    ("installationDate", STRING),
    ("monitoringPoints", T.ArrayType(_fields(("id", LONG), ("name", STRING), ("isActive", BOOL)))),
)
LEVEL_PAYLOAD = _fields(
    ("uid", STRING),
    ("approvedWaterLevelsGs", T.ArrayType(_fields(("ts", LONG), ("gs", DOUBLE)))),
    ("unApprovedWaterLevelsGs", T.ArrayType(_fields(("ts", LONG), ("gs", DOUBLE)))),
    ("approvedWaterLevelsVrd", T.ArrayType(_fields(("ts", LONG), ("vrd", DOUBLE)))),
    ("unApprovedWaterLevelsVrd", T.ArrayType(_fields(("ts", LONG), ("vrd", DOUBLE)))),
)

# --- raw zone --------------------------------------------------------------------------
LOGGER_READINGS = _fields(
    ("reading_id", STRING), ("location_id", LONG), ("timestamp", LONG),
    ("parameter_id", STRING), ("unit_id", STRING), ("value", DOUBLE),
)
LOGGER_STATIONS = _fields(
    ("id", LONG), ("name", STRING), ("description", STRING),
    ("latitude", DOUBLE), ("longitude", DOUBLE),
)
CITY_READINGS = _fields(
    ("reading_id", STRING), ("location_id", STRING), ("location_name", STRING),
    ("latitude", DOUBLE), ("longitude", DOUBLE), ("timestamp", LONG), ("value", DOUBLE),
)
DIVER_READINGS = _fields(
    ("location_id", STRING), ("timestamp", LONG), ("value", DOUBLE), ("result_quality", STRING),
)
FETCH_LOG = _fields(
    ("location_id", STRING), ("attempt", LONG), ("status", INT), ("error", STRING),
)

# --- target ----------------------------------------------------------------------------
GEOMETRY = _fields(("type", STRING), ("coordinates", T.ArrayType(DOUBLE)))
PROPERTIES = _fields(
    ("source_id", STRING), ("agency", STRING), ("geoconnex", STRING),
    ("alternate_id", T.ArrayType(_fields(("id", STRING), ("agency", STRING)))),
    ("source_specific", T.MapType(STRING, STRING)),
    ("externalId", STRING),
)
UNIT = _fields(("name", STRING), ("symbol", STRING), ("definition", STRING))

LOCATION = _fields(
    ("external_key", STRING), ("name", STRING), ("description", STRING),
    ("encoding_type", STRING), ("geometry", GEOMETRY), ("properties", PROPERTIES),
)
THING = _fields(
    ("external_key", STRING), ("name", STRING), ("description", STRING),
    ("location_key", STRING), ("properties", PROPERTIES),
)
SENSOR = _fields(
    ("external_key", STRING), ("name", STRING), ("description", STRING),
    ("encoding_type", STRING), ("metadata", STRING), ("properties", PROPERTIES),
)
OBSERVED_PROPERTY = _fields(
    ("external_key", STRING), ("name", STRING), ("definition", STRING),
    ("description", STRING), ("properties", PROPERTIES),
)
DATASTREAM = _fields(
    ("external_key", STRING), ("name", STRING), ("description", STRING),
    ("observation_type", STRING), ("unit_of_measurement", UNIT),
    ("thing_key", STRING), ("sensor_key", STRING), ("observed_property_key", STRING),
    ("properties", PROPERTIES),
)
# Entity tables in the order their foreign keys need.
ENTITIES = {
    "location": LOCATION, "thing": THING, "sensor": SENSOR,
    "observed_property": OBSERVED_PROPERTY, "datastream": DATASTREAM,
}

OBSERVATION = _fields(
    ("datastream_key", STRING), ("phenomenon_time", TIME), ("result", DOUBLE),
    ("parameters", T.MapType(STRING, STRING)), ("result_quality", STRING),
)
STORED_OBSERVATION = T.StructType(
    OBSERVATION.fields
    + _fields(("agency", STRING), ("obs_month", STRING), ("batch", STRING)).fields
)

# Rows and times of each datastream in a month of a batch.
SUMMARY = _fields(
    ("obs_month", STRING), ("batch", STRING), ("datastream_key", STRING),
    ("rows", LONG), ("oldest", TIME), ("newest", TIME),
)
STORED_SUMMARY = T.StructType(SUMMARY.fields + _fields(("agency", STRING), ("generation", LONG)).fields)

# --- progress --------------------------------------------------------------------------
# position: microseconds for load ids and datastream watermarks, seconds for ingest
# cursors, 1 for a finished chunk, a generation for a folder. Every kind only ever grows, so merging is a max.
STATE = _fields(("scope", STRING), ("kind", STRING), ("key", STRING), ("position", LONG))

CHUNK_TOTALS = _fields(
    ("rows_ingested", LONG), ("bundles_loaded", LONG), ("observations_posted", LONG),
    ("observations_deleted", LONG), ("adapter_failures", LONG),
)
