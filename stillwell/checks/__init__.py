from stillwell.checks import reads, loads, landed, jobs  # noqa: I001 (registration order)
from stillwell.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "jobs", "landed", "loads", "reads"]
