"""Joins of a large fact side to a keyed lookup side.

A lookup is broadcast only after it has been measured. Beyond the limit the join
shuffles, and the fact rows of the hottest keys are joined apart: a key outside the
``HOT_KEYS`` most frequent ones holds at most ``1 / HOT_KEYS`` of all rows, and the lookup
rows of the hot ones number at most ``HOT_KEYS`` (the lookup has one row per key).
"""

from pyspark.sql import DataFrame, functions as F, types as T

from stillwell.session import settle, settle_observed

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 128 * 1024 * 1024
HOT_KEYS = 1000


def _width(field: T.StructField):
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(field.name), F.lit(0)).cast("bigint") + 16
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        wrapped = F.to_json(F.struct(field.name))
        return F.coalesce(F.octet_length(wrapped), F.lit(0)).cast("bigint") + 32
    return F.lit(16).cast("bigint")


def _measures(df: DataFrame) -> list:
    width = sum((_width(field) for field in df.schema.fields), F.lit(16).cast("bigint"))
    return [F.count(F.lit(1)).alias("_n"), F.sum(width).alias("_size")]


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate in-memory bytes of ``df``, by one aggregate."""
    row = df.agg(*_measures(df)).first()
    return row["_n"], row["_size"] or 0


def fits_broadcast(df: DataFrame) -> bool:
    rows, size = measure(df)
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def settle_measured(df: DataFrame, *metrics) -> tuple[DataFrame, bool, dict]:
    """``df`` settled, whether it fits a broadcast, and other aggregates: no job of their own."""
    kept, seen = settle_observed(df, *_measures(df), *metrics)
    return kept, seen["_n"] <= BROADCAST_ROWS and (seen["_size"] or 0) <= BROADCAST_BYTES, seen


def hottest_keys(facts: DataFrame, on: list[str], top: int | None = None) -> DataFrame:
    """The most frequent keys, at most ``top`` of them; counts combine before the shuffle."""
    present = facts.select(*on).dropna()
    counts = present.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.desc("_n"), *on).limit(top or HOT_KEYS).select(*on)


def split_join(facts: DataFrame, lookup: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join with the hottest keys apart. ``lookup`` must have one row per key."""
    hot = settle(hottest_keys(facts, on))
    tagged = facts.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), on, "left")
    keyless = F.lit(False)
    for name in on:
        keyless = keyless | F.col(name).isNull()
    apart = F.col("_hot").isNotNull() | keyless
    hot_lookup = lookup.join(F.broadcast(hot), on, "left_semi")
    hot_side = tagged.where(apart).drop("_hot").join(F.broadcast(hot_lookup), on, how)
    cold_side = tagged.where(~apart).drop("_hot").join(lookup, on, how)
    return hot_side.unionByName(cold_side)


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: str | list[str], how: str = "left",
    *, derived: bool = False, small: bool | None = None,
) -> DataFrame:
    """Join ``facts`` to a lookup with one row per key.

    ``derived`` marks a lookup that is itself computed from a large table: it is written
    once first, so measuring it does not compute it twice. ``small`` passes on an earlier
    answer of ``fits_broadcast`` for the same lookup.
    """
    on = [on] if isinstance(on, str) else list(on)
    if derived:
        lookup, small, _ = settle_measured(lookup)
    if fits_broadcast(lookup) if small is None else small:
        return facts.join(F.broadcast(lookup), on, how)
    return split_join(facts, lookup, on, how)
