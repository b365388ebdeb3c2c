"""Names of the queries, and their SQL."""

from __future__ import annotations

from cartolith.plans import growth, layers, places, reports, rules, shapes, spatial, surfaces

QUERIES = reports.QUERIES | rules.QUERIES | spatial.QUERIES | growth.QUERIES | places.QUERIES | surfaces.QUERIES | layers.QUERIES | shapes.QUERIES
SQL = reports.SQL | rules.SQL | spatial.SQL | growth.SQL | places.SQL | surfaces.SQL | layers.SQL | shapes.SQL
