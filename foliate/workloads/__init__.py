"""Named queries over the given tables, each with the SQL it must agree with."""

from foliate.workloads import joining, merging, nested, tables, text, wide  # noqa: F401  (they register)
from foliate.workloads.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
