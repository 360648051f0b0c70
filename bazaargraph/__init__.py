"""Weighted user-product graphs from marketplace events, as Spark jobs.

Every function takes and returns DataFrames. The caller brings the
SparkSession; ``bazaargraph.session.SPARK_CONF`` lists the settings the library
was written for.
"""

from bazaargraph.schemas import (
    ROLES,
    WEIGHTS,
    edges_schema,
    event_schema,
    raw_edges_schema,
    raw_vertices_schema,
    vertices_schema,
)

__all__ = [
    "ROLES",
    "WEIGHTS",
    "edges_schema",
    "event_schema",
    "raw_edges_schema",
    "raw_vertices_schema",
    "vertices_schema",
]
