"""All registered queries of the engine and their SQL."""

from __future__ import annotations

from . import binding_queries, facility_queries, fan_queries, pen_queries, procedure_queries, queries, route_queries, section_queries, shape_queries  # noqa: F401

QUERIES, ORACLES = queries.QUERIES, queries.ORACLES
FLAGSHIP = "findings_report"
