"""Queries over the supplied tables, each beside the SQL that must give the same rows."""

QUERIES: dict = {}
ORACLES: dict = {}


def check(sql: str | None = None):
    """Register a query under its function name, with its SQL if there is one."""
    def register(function):
        name = function.__name__
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register
