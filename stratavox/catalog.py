"""All queries over the driver's tables and the SQL that each is compared with."""

from __future__ import annotations

from stratavox.plans import centerlines, elastic, finalization, geometry, images, interpolation, kernels, ledgers, masks, planning, polygons, temporal, tracks, views

_MODULES = (planning, temporal, masks, geometry, kernels, tracks, polygons, views, ledgers, centerlines, interpolation, finalization, images, elastic)

QUERIES: dict = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLES: dict = {k: v for m in _MODULES for k, v in m.ORACLES.items()}
