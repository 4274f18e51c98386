"""Interpolation of the tubes of the centre-line view, with slices taken out."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratavox.operators import interpolation as ops
from stratavox.plans.centerlines import TUBE, _tubes

HOW = {"distance": 9, "angle": 20.0, "most": 2, "back": 2, "threshold": 1.5}


def _gapped(spark, sf):
    return _tubes(spark, sf).where("t % 25 NOT BETWEEN 10 AND 14 AND NOT (t % 25 = 4 AND x % 2 = 0)")


def _parts(spark, sf):
    rows = ops.checkpointed(ops.pieces(_gapped(spark, sf), TUBE))
    found = ops.checkpointed(ops.anchors(rows))
    return rows, found, ops.checkpointed(ops.seeds(rows, found))


def interpolation_seeds(spark, sf):
    return _parts(spark, sf)[2]


def cone_candidates(spark, sf):
    rows, _, starts = _parts(spark, sf)
    return ops.candidates(rows, starts, TUBE, HOW["distance"], HOW["angle"], HOW["most"])


def walk_back(spark, sf):
    return ops.walk_back(*_parts(spark, sf), HOW["back"])


def bridge_radii(spark, sf):
    """Every planned bridge of all tubes: whether it is accepted, and its radius."""
    rows, found, starts = _parts(spark, sf)
    plans = ops.planned(rows, found, starts, TUBE, HOW["distance"], HOW["angle"], HOW["most"], HOW["back"])
    return ops.bridges(rows, plans, TUBE, HOW["threshold"]).withColumn("n", F.size("pixels")).drop("pixels").withColumn("radius", F.round("radius", 6))


def interpolation_pass(spark, sf):
    """The voxels that each layer of bridges adds."""
    return ops.interpolate(_gapped(spark, sf), TUBE, **HOW)[0]


QUERIES = {f.__name__: f for f in (interpolation_seeds, cone_candidates, walk_back, bridge_radii, interpolation_pass)}
ORACLES: dict = {}
