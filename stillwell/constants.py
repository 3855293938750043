"""Fixed values of the entity model. They must equal the published vocabulary exactly."""

NO_DEFINITION = "No Definition"
NO_METADATA = "No Metadata"

OM_MEASUREMENT = "http://www.opengis.net/def/observationType/OGC-OM/2.0/OM_Measurement"
GEOJSON_ENCODING = "application/geo+json"

# Units as (name, symbol, definition).
UNIT_FOOT = ("Foot", "ft", "http://www.qudt.org/vocab/unit/FT")

# Sensors as (external_key, name, description, encoding_type, metadata).
MANUAL_SENSOR = (
    "sensor-manual-measurement", "Manual", NO_DEFINITION, "application/pdf", NO_METADATA,
)
LOGGER_SENSOR = (
    "sensor-hydrovu-vulink", "VuLink", NO_DEFINITION, "application/pdf", NO_METADATA,
)
DIVER_SENSOR = (
    "sensor-vanessen-diver", "VanEssenDiver", NO_DEFINITION, "application/pdf", NO_METADATA,
)

# Observed properties as (external_key, name, definition, description).
DEPTH_TO_WATER = (
    "observed-property-depth-to-water-bgs",
    "Depth to Water Below Ground Surface",
    NO_DEFINITION,
    "depth to water below ground surface",
)
WATER_ELEVATION = (
    "observed-property-water-level-elevation-navd88",
    "Water Level Elevation (NAVD88)",
    NO_DEFINITION,
    "Groundwater elevation relative to NAVD88, in feet",
)

# Texts of things, locations and datastreams.
THING_NAME = "Water Well"
THING_DESCRIPTION = (
    "Well drilled or set into subsurface for the purposes of pumping water or "
    "monitoring groundwater"
)
LOCATION_MADE = "Location of well where measurements are made"
LOCATION_COLLECTED = "Location of well where measurements were collected"
LEVELS_NAME = "Groundwater Levels"
LEVELS_DESCRIPTION = (
    "Measurement of groundwater depth in a water well, as measured below ground surface"
)
ELEVATIONS_NAME = "Groundwater Elevations"
ELEVATIONS_PREFIX = "Water level elevation relative to NAVD88 — "

# Names of the sources, their agencies, datasets and tables.
LOGGER_SOURCE = {
    "name": "hydrovu", "agency": "PVACD", "dataset": "raw_pvacd",
    "readings_table": "hydrovu_readings", "stations_table": "hydrovu_locations",
    "backfill_table": "hydrovu_backfill_readings",
}
CITY_SOURCE = {
    "name": "cabq", "agency": "CABQ", "dataset": "raw_cabq",
    "readings_table": "cabq_readings", "stations_table": None,
    "backfill_table": "cabq_backfill_readings",
}
DIVER_SOURCE = {
    "name": "san_acacia", "agency": "SanAcaciaReach", "dataset": "raw_sanacaciareach",
    "readings_table": "san_acacia_readings", "stations_table": "san_acacia_locations",
    "backfill_table": "san_acacia_backfill_readings",
}

# Codes and factors.
DTW_PARAMETER = "4"
METRE_UNIT = "35"
FEET_PER_METRE = 3.28084
CENTIMETRES_PER_FOOT = 30.48
CHUNK_SIZE = 1000

# Seconds of 0001-01-01 and 9999-12-31T23:59:59, the range a reading's time may take.
EARLIEST_SECOND = -62135596800
LATEST_SECOND = 253402300799
