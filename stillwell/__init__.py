"""Sensor time-series jobs on Spark: land, scan, map, load, replace."""
