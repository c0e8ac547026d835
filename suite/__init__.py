"""Named queries: operators bound to the given tables, with the SQL that must agree.

Importing the package registers all of them.
"""

from suite import (  # noqa: F401
    aggregates,
    dates,
    joins,
    learning,
    parsing,
    sinks,
    sources,
    streams,
    topn,
    windows,
)
from suite.registry import ORACLES, QUERIES  # noqa: F401
