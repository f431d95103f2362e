"""Registered queries with their reference SQL, one module per part of the engine."""

from cubeweave.suite import (  # noqa: F401
    scans,
    aggregation,
    edits,
    selection,
    scalars,
    catalog,
    documents,
    indexes,
    forecast,
    compare,
    families,
    streams,
)
