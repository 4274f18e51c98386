"""Elastic policies on a raster of 24 by 40, one for each size of part."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratavox.operators import elastic as ops
from stratavox.plans.masks import _cells
from stratavox.session import checkpointed
from stratavox.sources.tables import table

H, W, STEP = 24, 40, 8


def _policies(spark, sf):
    rows = table(spark, sf, "part").select(F.col("p_size").cast("bigint").alias("policy")).distinct()
    turn, scale = F.radians((F.col("policy") * 7 % 31 - 15).cast("double")), 1 + F.col("policy") % 5 / 20
    c, s = F.cos(turn) * scale, F.sin(turn) * scale
    at = {"m00": c, "m01": -s, "m10": s, "m11": c}
    rows = rows.withColumns({**at, "seed": F.col("policy") * 1009, "magnitude": (F.col("policy") % 4).cast("double")})
    return rows.withColumns({"m02": (W - 1) / 2 * (1 - F.col("m00")) - (H - 1) / 2 * F.col("m01"), "m12": (H - 1) / 2 * (1 - F.col("m11")) - (W - 1) / 2 * F.col("m10")})


def _field(spark, sf):
    return ops.field(ops.lattice(_policies(spark, sf), H, W, STEP), H, W, STEP)


def elastic_field(spark, sf):
    return _field(spark, sf).withColumns({c: F.round(c, 9) + 0.0 for c in ("dy", "dx")})  # no negative zero


def elastic_inverse(spark, sf):
    """Where each pixel of the source shows in the output of each policy."""
    return ops.inverse(_policies(spark, sf), checkpointed(_field(spark, sf)), H, W).withColumns({c: F.round(c, 3) for c in ("oy", "ox")})


def elastic_restore(spark, sf):
    """A mask of every policy's output, brought back."""
    policies = _policies(spark, sf)
    mask = _cells(spark, sf, 0.0).select((F.col("t") % 50 + 1).alias("policy"), (F.col("y") * 3).alias("y"), (F.col("x") * 5).alias("x")).distinct()
    back = ops.restored(mask, ops.inverse(policies, checkpointed(_field(spark, sf)), H, W))
    return back.groupBy("policy").agg(F.count_if("known").alias("known"), F.count_if("set").alias("set"))


QUERIES = {f.__name__: f for f in (elastic_field, elastic_inverse, elastic_restore)}

_UNIT = lambda axis: f"(('0x' || substr(sha256(concat_ws(chr(0), '{ops.DOMAIN}', (policy * 1009)::VARCHAR, ly::VARCHAR, lx::VARCHAR, '{axis}')), 1, 8))::BIGINT / 2147483648.0::DOUBLE - 1) * (policy % 4)"
ORACLES = {
    "elastic_field": f"""WITH p AS (SELECT DISTINCT p_size::BIGINT AS policy FROM part), l AS (SELECT policy, ly, lx FROM p, (SELECT unnest(range({-(-(H - 1) // STEP) + 1})) AS ly), (SELECT unnest(range({-(-(W - 1) // STEP) + 1})) AS lx)),
v AS (SELECT policy, ly, lx, {_UNIT('y')} AS dy, {_UNIT('x')} AS dx FROM l), g AS (SELECT policy, y, x, y // {STEP} AS ly, x // {STEP} AS lx, (y % {STEP}) / {STEP}.0::DOUBLE AS v, (x % {STEP}) / {STEP}.0::DOUBLE AS u FROM p, (SELECT unnest(range({H})) AS y), (SELECT unnest(range({W})) AS x))
SELECT g.policy, y, x, {", ".join(f"round((a.{c} * (1 - u) + coalesce(b.{c}, 0) * u) * (1 - v) + (coalesce(d.{c}, 0) * (1 - u) + coalesce(e.{c}, 0) * u) * v, 9) + 0.0::DOUBLE AS {c}" for c in ("dy", "dx"))}
FROM g JOIN v a ON a.policy = g.policy AND a.ly = g.ly AND a.lx = g.lx LEFT JOIN v b ON b.policy = g.policy AND b.ly = g.ly AND b.lx = g.lx + 1 LEFT JOIN v d ON d.policy = g.policy AND d.ly = g.ly + 1 AND d.lx = g.lx LEFT JOIN v e ON e.policy = g.policy AND e.ly = g.ly + 1 AND e.lx = g.lx + 1""",
}
