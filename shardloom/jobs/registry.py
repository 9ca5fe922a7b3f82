"""All queries over the catalog's tables and the SQL that gives the same rows."""

from __future__ import annotations

from . import catalog, images, shipping

QUERIES = catalog.QUERIES | shipping.QUERIES | images.QUERIES
ORACLES = catalog.ORACLES | shipping.ORACLES | images.ORACLES
