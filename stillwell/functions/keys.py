"""External keys as column expressions. ``concat`` (not ``concat_ws``) keeps nulls null."""

from pyspark.sql import Column, functions as F

from stillwell.functions.times import iso_text


def location_key(agency: str, source_id: Column) -> Column:
    """Key of a location and of its thing: ``<agency>-<source id>``."""
    return F.concat(F.lit(agency.lower() + "-"), source_id.cast("string"))


def datastream_key(agency: str, source_id: Column, suffix: Column | str = "dtw") -> Column:
    suffix = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.concat(location_key(agency, source_id), F.lit("-"), suffix)


def reading_id(*parts: Column) -> Column:
    """``<station>_<parameter>_<time>`` or ``<station>_<time>``, as the parts given."""
    pieces = [parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit("_"), part.cast("string")]
    return F.concat(*pieces)


def chunk_key(start: Column, end: Column, ids: Column) -> Column:
    """``<start>_<end>_<ids>``; ``ids`` is an array, so another list is another chunk."""
    listed = F.array_join(F.array_sort(ids).cast("array<string>"), ",")
    return F.concat(iso_text(start), F.lit("_"), iso_text(end), F.lit("_"), listed)
