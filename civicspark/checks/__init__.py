"""The operators over the shared test tables, each beside the SQL that gives its result."""

from civicspark.checks.registry import ORACLES, QUERIES
from civicspark.checks import (  # noqa: F401  (each module registers its checks)
    files, filters, joins, quality, refresh, scalars, shapes, views,
)
from civicspark.checks import whole_runs  # noqa: E402, F401  (reads what views has registered)

__all__ = ["ORACLES", "QUERIES"]
