"""Named queries over the test tables, each with the SQL that must give the same rows."""

from .registry import ORACLES, QUERIES

from . import aggregation, cleaning, files, graph, profiling, quality, sql, whole  # noqa: F401, E402

__all__ = ["ORACLES", "QUERIES"]
