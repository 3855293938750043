"""Unit conversions to the canonical foot."""

from pyspark.sql import Column, functions as F

from stillwell.constants import CENTIMETRES_PER_FOOT, FEET_PER_METRE


def metres_to_feet(value: Column) -> Column:
    return value * F.lit(FEET_PER_METRE)


def centimetres_to_feet(value: Column) -> Column:
    return value / F.lit(CENTIMETRES_PER_FOOT)
