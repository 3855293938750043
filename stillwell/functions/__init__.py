from stillwell.functions.keys import chunk_key, datastream_key, location_key, reading_id
from stillwell.functions.times import (
    day_floor, from_iso, iso_text, millis_to_seconds, odata_text, seconds_of_date,
    time_from_millis, time_from_seconds,
)
from stillwell.functions.units import centimetres_to_feet, metres_to_feet

__all__ = [
    "centimetres_to_feet", "chunk_key", "datastream_key", "day_floor", "from_iso", "iso_text",
    "location_key", "metres_to_feet", "millis_to_seconds", "odata_text", "reading_id",
    "seconds_of_date", "time_from_millis", "time_from_seconds",
]
