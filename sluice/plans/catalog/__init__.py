"""All registered queries."""

from sluice.plans.catalog import (  # noqa: F401
    documents,
    elements,
    flows,
    graph_acl,
    records,
    scalars,
    sinks,
    staging,
    streams,
)
from sluice.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
