"""Every registered query against its SQL, on the smallest supplied tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


# Whole jobs, covered by test_loads and test_backfill; check_all.py and -m slow run them too.
JOBS = {"daily_load", "daily_watermarks", "stream_load", "city_load", "backfill_load",
        "ingest_load", "ingest_report", "replay_load"}


@pytest.mark.parametrize("name", [
    pytest.param(name, marks=pytest.mark.slow) if name in JOBS else name
    for name in sorted(entry.oracle_sql())  # the others meet brute force beside their operators
])
def test_query_equals_its_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["good_observations", "unique_readings", "station_outcomes"])
def test_queries_run_as_compiled_code_too(spark, con, name):
    """The session of the tests interprets plans; a deployment compiles them."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.codegen.wholeStage",
                                             "spark.sql.codegen.factoryMode")}
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
    try:
        made = differences(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert made is None


def test_a_missing_library_of_the_subpackage_takes_no_other_query_along():
    import subprocess
    import sys

    code = ("import sys; sys.modules['public_tokenizers'] = None\n"
            "import __spark_entry__ as e; assert 'daily_load' in e.queries()")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry.__file__.rsplit("/", 1)[0])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
