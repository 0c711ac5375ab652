"""Every registered query. Importing a family module registers its queries."""

from tallyweave.suite import (  # noqa: F401
    aggregation,
    filters,
    flows,
    joining,
    learning,
    ordering,
    projection,
    scalars,
    shop,
    storage,
    streams,
)
from tallyweave.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
