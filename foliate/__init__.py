"""foliate: nested and wide editorial records to typed tables, on Spark.

The package is organised by what a caller does with it:

* ``functions``  column expressions (HTML, multilingual values, dates, arrays)
* ``operators``  DataFrame-to-DataFrame steps (reshape, join, merge, numbering)
* ``sources``    readers, the versioned dataset store and the table sinks
* ``plans``      the table specs, the fifteen table pipelines and the jobs
* ``streaming``  the same merges driven by Structured Streaming
* ``workloads``  the named queries of ``__spark_entry__`` with their SQL oracles
"""

from foliate.errors import DataError, MissingDataError, OptionError
from foliate.schema import ColumnSpec, TableSpec, conform
from foliate.session import build_session

__all__ = [
    "ColumnSpec",
    "DataError",
    "MissingDataError",
    "OptionError",
    "TableSpec",
    "build_session",
    "conform",
]
