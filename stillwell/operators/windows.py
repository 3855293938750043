"""Replace all observations of a half-open time window, per datastream."""

from pyspark.sql import DataFrame, functions as F

from stillwell.operators.filters import in_window
from stillwell.operators.joins import fits_broadcast, lookup_join
from stillwell.session import settle


def _inside(start, end):
    return in_window(F.col("phenomenon_time"), F.lit(start), F.lit(end))


def outside_window(records: DataFrame, start, end) -> DataFrame:
    """Records that do not belong to the window."""
    inside = _inside(start, end)
    return records.where(~inside | F.col("phenomenon_time").isNull())


def require_inside(records: DataFrame, start, end) -> None:
    """Refuse a window load before any effect if a record lies outside."""
    found = outside_window(records, start, end).agg(
        F.count(F.lit(1)).alias("n"), F.min("phenomenon_time").alias("first")
    ).first()
    if found["n"]:
        raise ValueError(
            f"{found['n']} record(s) outside [{start}, {end}), first at {found['first']}; "
            "nothing was deleted or written"
        )


def outside_span(start, end) -> list:
    """Aggregates over ``oldest`` and ``newest`` that ``require_span`` judges."""
    times = [in_window(F.col(c), F.lit(start), F.lit(end)) for c in ("oldest", "newest")]
    return [F.min("oldest").alias("first"), F.max("newest").alias("last"),
            F.count_if(~(times[0] & times[1])).alias("outside")]


def require_span(span: dict, start, end) -> None:
    """The same refusal from the first and last times of what is to be posted."""
    if span["outside"]:
        raise ValueError(
            f"record(s) from {span['first']} to {span['last']}, outside [{start}, {end}); "
            "nothing was deleted or posted"
        )


def rejected(records: DataFrame) -> DataFrame:
    """Records no target may accept: without a datastream or a time."""
    return records.where(F.col("datastream_key").isNull() | F.col("phenomenon_time").isNull())


def accepted(records: DataFrame) -> DataFrame:
    """The records, failing the job that writes them at the first unacceptable one.

    The check rides along in the write, whose commit is all or nothing, so it costs no pass
    of its own.
    """
    bad = F.col("datastream_key").isNull() | F.col("phenomenon_time").isNull()
    message = F.lit("record without datastream or time; batch not written")
    return records.withColumn(
        "datastream_key", F.when(bad, F.raise_error(message)).otherwise(F.col("datastream_key"))
    )


def deleted_by(
    existing: DataFrame, keys: DataFrame, start, end, *, small: bool | None = None
) -> DataFrame:
    """Existing rows of the given datastreams inside the window."""
    held = existing.where(_inside(start, end))
    return lookup_join(held, keys, "datastream_key", "left_semi", small=small)


def kept_by(
    existing: DataFrame, keys: DataFrame, start, end, *, small: bool | None = None
) -> DataFrame:
    """Existing rows that survive: outside the window, or of another datastream.

    With few keys this is one pass that marks rows; otherwise only rows of the window take
    part in a join.
    """
    if fits_broadcast(keys) if small is None else small:
        named = keys.select("datastream_key", F.lit(True).alias("_named"))
        marked = existing.join(F.broadcast(named), "datastream_key", "left")
        kept = marked.where(~_inside(start, end) | F.col("_named").isNull())
        return kept.select(*existing.columns)
    held = existing.where(_inside(start, end))
    others = lookup_join(held, keys, "datastream_key", "left_anti", small=False)
    return existing.where(~_inside(start, end)).unionByName(others)


def replace_window(
    existing: DataFrame, new: DataFrame, start, end, keys: DataFrame | None = None
) -> DataFrame:
    """``existing`` with the window of every datastream in ``keys`` replaced by ``new``.

    ``keys`` defaults to the datastreams of ``new``; naming more also clears those that the
    new rows no longer mention.
    """
    if keys is None:
        keys = settle(new.select("datastream_key").distinct())
    return kept_by(existing, keys, start, end).unionByName(new)


def window_results(new: DataFrame, deleted: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Counts per datastream of a window load; the watermark only moves forward."""
    posted = new.groupBy("datastream_key").agg(
        F.count(F.lit(1)).alias("rows"), F.max("phenomenon_time").alias("newest"))
    gone = deleted.groupBy("datastream_key").agg(F.count(F.lit(1)).alias("n"))
    return summed_results(posted, gone, watermarks)


def summed_results(
    posted: DataFrame, gone: DataFrame | None, watermarks: DataFrame, *, small: bool | None = None
) -> DataFrame:
    """The same from counts: ``rows`` and ``newest`` of what was posted, ``n`` of what has gone."""
    nothing = F.lit(0).cast("bigint")
    touched = posted.select("datastream_key", F.col("rows").alias("posted"),
                            nothing.alias("deleted"), F.col("newest").alias("latest"))
    if gone is not None:
        touched = touched.unionByName(gone.select(
            "datastream_key", nothing.alias("posted"), F.col("n").alias("deleted"),
            F.lit(None).cast("timestamp").alias("latest")))
    touched = touched.groupBy("datastream_key").agg(
        F.sum("posted").alias("posted"), F.sum("deleted").alias("deleted"),
        F.max("latest").alias("latest"),
    )
    marked = lookup_join(
        touched, watermarks.select("datastream_key", "watermark"), "datastream_key", small=small
    )
    return marked.select(
        "datastream_key", F.col("posted").alias("considered"), "posted",
        nothing.alias("skipped"), "deleted",
        F.greatest("watermark", "latest").alias("new_watermark"),
    )
