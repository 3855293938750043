"""Row predicates on readings. Each stays a narrow filter wherever the data allows it."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from stillwell.constants import DTW_PARAMETER, METRE_UNIT
from stillwell.operators.joins import lookup_join

LITERAL_LIST = 1000


def depth_rows(readings: DataFrame, parameter: str = DTW_PARAMETER) -> DataFrame:
    """Depth-to-water rows; the code is text, so the compare pushes into parquet."""
    return readings.where(F.col("parameter_id") == F.lit(parameter))


def only_stations(
    readings: DataFrame, ids: Iterable | DataFrame, column: str = "location_id"
) -> DataFrame:
    """Rows of the listed stations. An empty list keeps nothing.

    Ids take the type of the column, whatever they come as; one that has no such value
    matches nothing. That holds for lists of any length and for tables.
    """
    kind = readings.schema[column].dataType
    if isinstance(ids, DataFrame):
        allowed = ids.select(F.col(ids.columns[0]).try_cast(kind).alias(column)).distinct()
        return lookup_join(readings, allowed, column, "left_semi", derived=True)
    ids = list(dict.fromkeys(str(i) for i in ids if i is not None))
    if not ids:
        return readings.where(F.lit(False))
    if len(ids) <= LITERAL_LIST:
        return readings.where(F.col(column).isin(*[F.lit(i).try_cast(kind) for i in ids]))
    listed = readings.sparkSession.createDataFrame([(i,) for i in ids], f"{column} string")
    listed = listed.select(F.col(column).try_cast(kind).alias(column)).distinct()
    return lookup_join(readings, listed, column, "left_semi")


def in_window(time: Column, start, end) -> Column:
    """Half-open: start kept, end not."""
    return (time >= start) & (time < end)


def within(readings: DataFrame, start, end, column: str = "timestamp") -> DataFrame:
    return readings.where(in_window(F.col(column), F.lit(start), F.lit(end)))


def cut_pages(
    readings: DataFrame, end: int | Column, *, station: str | list[str] = "location_id"
) -> DataFrame:
    """Rows before ``end``, from pages up to the first one that reaches ``end``.

    Later pages count as unread even where they hold earlier readings. Rows without a time
    stay with their page, so that they reach the quarantine. ``end`` may be a column that is
    the same for all rows of a ``station``, which may be several columns.
    """
    by = [station] if isinstance(station, str) else station
    cuts = (
        readings.where(F.col("timestamp") >= end)
        .groupBy(*by).agg(F.min("page").alias("_cut"))
    )
    early = readings.where(F.col("timestamp").isNull() | (F.col("timestamp") < end))
    marked = lookup_join(early, cuts, by, derived=True)
    return marked.where(F.col("_cut").isNull() | (F.col("page") <= F.col("_cut"))).drop("_cut")


def start_floor(start_ts: int, cursor: Column) -> Column:
    """First second to fetch for a station: its cursor, never before the configured start."""
    return F.greatest(F.coalesce(cursor, F.lit(0).cast("bigint")), F.lit(start_ts).cast("bigint"))


def from_cursor(
    readings: DataFrame, cursors: DataFrame, start_ts: int,
    *, station: str = "location_id", seconds: Column | None = None, by_day: bool = False,
) -> DataFrame:
    """Rows at or after each station's floor; ``by_day`` lowers the floor to its midnight.
    Rows without a time stay: they fail their station later on.

    ``cursors`` has the station column and ``cursor`` in seconds.
    """
    time = F.col("timestamp") if seconds is None else seconds
    joined = lookup_join(readings, cursors.select(station, "cursor"), station)
    floor = start_floor(start_ts, F.col("cursor"))
    if by_day:
        floor = F.unix_seconds(F.date_trunc("day", F.timestamp_seconds(floor)))
    return joined.where(time.isNull() | (time >= floor)).drop("cursor")


# --- quality flags (reported, never used to drop rows) ---------------------------------
def unexpected_unit() -> Column:
    """The conversion assumes metres whatever the row says; this flags rows that differ."""
    return ~F.col("unit_id").eqNullSafe(F.lit(METRE_UNIT))


def swapped_coordinates() -> Column:
    """A latitude outside ±90 means the source mislabelled its coordinates."""
    return F.abs(F.col("latitude")) > 90
