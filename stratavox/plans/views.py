"""View operators over shapes from part, directions from customer, and gray and mask volumes of eight slices from embeddings."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from stratavox.operators import geometry, views
from stratavox.plans.geometry import _directions
from stratavox.plans.masks import V, _cells
from stratavox.sources.tables import table

SIZE = (8, 8, 8)
RADII, INTERVALS, TILT = [1.0, 1.9, 2.8, 3.7], 12, 25.0
ANGLES = [180.0 / 7 * k for k in range(7)]
TURN = views.cube_rotation("vertical", 20.0)


def _shapes(spark, sf):
    s = F.col("p_size").cast("bigint")
    rows = table(spark, sf, "part").select(s.alias("volume")).distinct()
    v = F.col("volume")
    return rows.select("volume", (90 + v * 7).alias("n_t"), (120 + v * 5).alias("n_h"), (75 + v * 9).alias("n_w"))


def _placed(spark, sf, padded):
    rows = _shapes(spark, sf).select("volume", F.col("n_w").alias("src_w"), F.col("n_h").alias("src_h"), F.lit(64).cast("bigint").alias("out"), (F.col("volume") * 13 % 360).cast("double").alias("angle"))
    return views.placed(rows, padded)


def _rounded(rows, *keys):
    return rows.select(*keys, *(F.round(F.col(m) + 0.0, 6).alias(m) for m in views.AXES))


def _masks(spark, sf, threshold):
    return _cells(spark, sf, threshold).select(F.floor(F.col("t") / 8).alias("volume"), (F.col("t") % 8).alias("t"), "y", "x")


def _grays(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.col("vec_id"), F.posexplode("embedding").alias("pos", "v"))
    g = (F.floor(F.abs(F.col("v").cast("double")) * 1000) % 256).cast("bigint")
    return rows.select(F.floor(F.col("vec_id") / 8).alias("volume"), (F.col("vec_id") % 8).alias("t"), F.floor(F.col("pos") / 8).alias("y"), (F.col("pos") % 8).cast("bigint").alias("x"), g.alias("g"))


def axis_specs(spark, sf):
    return views.axis_specs(_shapes(spark, sf))


def affine_columns(spark, sf):
    parts = [_rounded(_placed(spark, sf, p), "volume").withColumn("padded", F.lit(p)) for p in (False, True)]
    return parts[0].unionByName(parts[1])


def processing_affine(spark, sf):
    """Output-to-source of a turned raster, composed with the unturned raster's source-to-output."""
    rows = views.inverse(_placed(spark, sf, False))
    flat = {m: f"f_{m}" for m in views.AXES}
    plain = views.placed(_placed(spark, sf, False).select("volume", "src_w", "src_h", "out", F.lit(0.0).alias("angle")), False).select("volume", *(F.col(m).alias(n) for m, n in flat.items()))
    out = views.composed(rows.join(plain, "volume"), [F.col(n) for n in flat.values()])
    return _rounded(out.withColumn("same", views.identity()), "volume", "same")


def mirrored_affine(spark, sf):
    return _rounded(views.mirrored(views.inverse(_placed(spark, sf, False)), F.col("src_w")), "volume")


def crop_windows(spark, sf):
    rows = views.inverse(_placed(spark, sf, True)).withColumns({"plane_h": F.col("src_h"), "plane_w": F.col("src_w"), "out": F.lit(40).cast("bigint")})
    out = views.crop_windows(rows)
    return out.select("volume", *(F.col(c).cast("bigint").alias(c) for c in ("py0", "py1", "px0", "px1")), F.round("m02", 6).alias("m02"), F.round("m12", 6).alias("m12"))


def azimuth_lists(spark, sf):
    rows = _shapes(spark, sf).withColumn("a", F.explode(views.azimuths((F.col("volume") % 11 + 1) * 3.7)))
    return rows.select("volume", F.round("a", 6).alias("angle"))


def azimuthal_plan(spark, sf):
    rows = _shapes(spark, sf).withColumns({"diameter": F.least("n_h", "n_w"), "src_w": F.col("n_w") - F.when(F.col("volume") % 5 == 0, 60).otherwise(0), "src_h": F.col("n_t"), "stack": F.col("n_t")})
    rows = rows.withColumn("num_slices", F.ceil(180.0 / views.full_coverage_spacing(F.col("diameter"))).cast("bigint"))
    return views.azimuthal_plan(rows).select("volume", F.round("spacing", 9).alias("spacing"), F.col("frames").cast("bigint").alias("frames"), "optimised")


def sampling_scalars(spark, sf):
    r = (F.col("volume") * 2.5 + 0.5).cast("double")
    gap = views.certified_radial_gap(r)
    return _shapes(spark, sf).select(
        "volume", F.round(views.full_coverage_spacing(F.col("n_w")), 9).alias("spacing"), F.round(gap, 9).alias("gap"), F.round(views.radial_error(gap, r), 9).alias("error"), views.face_intervals(r).alias("intervals"),
        F.round(views.raster_scale(F.lit(64), F.lit(80), F.col("n_h"), F.col("n_w")), 9).alias("scale"), F.round(views.raster_angle(F.lit(30.0), views.raster_scale(F.lit(64), F.lit(80), F.col("n_h"), F.col("n_w"))), 9).alias("cone"),
    )


def spherical_plan(spark, sf):
    rows = _shapes(spark, sf).select("volume", (F.col("volume") + 5.0).alias("minimum"), (F.col("volume") * 11 + 40.0).alias("maximum"), (F.col("volume") % 7 * 64 + 64).alias("patch"))
    return views.spherical_plan(rows).drop("minimum", "maximum", "patch")


def qsc_members(spark, sf):
    rows = views.face_members(_directions(spark, sf), "a", "b", "c")
    return rows.select("c_custkey", F.col("face").cast("bigint").alias("face"), F.floor((F.col("u") + 1) * 512 + 1e-6).cast("bigint").alias("ku"), F.floor((F.col("v") + 1) * 512 + 1e-6).cast("bigint").alias("kv"))


def qsc_inverse(spark, sf):
    rows = _shapes(spark, sf).select("volume", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("face"), ((F.col("volume") * 7 % 21) / 10.0 - 1).alias("u"), ((F.col("volume") * 3 % 17) / 8.0 - 1).alias("v"))
    out = views.cube_direction(rows, "face", "u", "v")
    return out.select("volume", F.col("face").cast("bigint").alias("face"), *(F.round(F.col(f"d{c}") + 0.0, 7).alias(c) for c in "xyz"))


def low_quality_specs(spark, sf):
    asked = F.array(*(F.struct(F.lit(k).alias("nth"), F.lit(v).alias("token")) for k, v in enumerate(("0.5", "64", "0.25", "62", "33"))))
    rows = _shapes(spark, sf).withColumn("q", asked)
    return views.low_quality_specs(rows.select("volume", "n_t", "n_h", "n_w", F.explode("q").alias("q")).select("volume", "n_t", "n_h", "n_w", "q.*"))


def _spherical(spark):
    return views.spherical_samples(spark, SIZE, RADII, INTERVALS, TURN)


def spherical_frames(spark, sf):
    return views.nearest_frames(_masks(spark, sf, 0.15), _spherical(spark), "face", "shell", "row", "col")


def spherical_linear(spark, sf):
    return views.linear_frames(_grays(spark, sf), _spherical(spark), "face", "shell", "row", "col")


def spherical_projection(spark, sf):
    return views.spherical_project(spherical_frames(spark, sf), SIZE, RADII, INTERVALS, TURN)


def radial_frames(spark, sf):
    return views.nearest_frames(_masks(spark, sf, 0.15), views.radial_samples(spark, SIZE, RADII), "shell", "height", "arc")


def radial_linear(spark, sf):
    return views.linear_frames(_grays(spark, sf), views.radial_samples(spark, SIZE, RADII), "shell", "height", "arc")


def radial_projection(spark, sf):
    return views.radial_project(radial_frames(spark, sf), SIZE, RADII)


def tilted_frames(spark, sf):
    return views.tilted_frames(_grays(spark, sf), SIZE, TILT)


def tilted_projection(spark, sf):
    return views.tilted_project(_masks(spark, sf, 0.1).withColumnRenamed("t", "frame"), SIZE, TILT)


def azimuthal_frames(spark, sf):
    return views.azimuthal_frames(_grays(spark, sf), SIZE, ANGLES, 9, 3.5)


def cube_resize_gray(spark, sf):
    return views.resize_gray(_grays(spark, sf), SIZE, (5, 11, 6))


def warp_gray(spark, sf):
    return views.warp_gray(_grays(spark, sf), geometry.invert(geometry.affine(8, 8, 12, 30.0)), 12)


def gray_downbin(spark, sf):
    return views.downbin_gray(_grays(spark, sf), (8, 8), 3)


QUERIES = {
    f.__name__: f
    for f in (
        axis_specs, affine_columns, processing_affine, mirrored_affine, crop_windows, azimuth_lists, azimuthal_plan, sampling_scalars, spherical_plan, qsc_members, qsc_inverse, low_quality_specs,
        spherical_frames, spherical_linear, spherical_projection, radial_frames, radial_linear, radial_projection, tilted_frames, tilted_projection, azimuthal_frames, cube_resize_gray, warp_gray, gray_downbin,
    )
}

SHAPES = "shapes AS (SELECT DISTINCT p_size::BIGINT AS volume, 90 + p_size::BIGINT * 7 AS n_t, 120 + p_size::BIGINT * 5 AS n_h, 75 + p_size::BIGINT * 9 AS n_w FROM part)"
GRAYS = """cells AS (SELECT vec_id, unnest(range(0, len(embedding)::BIGINT)) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings),
grays AS (SELECT vec_id // 8 AS volume, vec_id % 8 AS t, pos // 8 AS y, pos % 8 AS x, floor(abs(v) * 1000)::BIGINT % 256 AS g FROM cells)"""


def _placed_sql(name: str, padded: bool, angle: str = "(volume * 13 % 360)::DOUBLE") -> str:
    side = "greatest(ceil(round(greatest(w * abs(c) + h * abs(s), w * abs(s) + h * abs(c)), 9)), w, h)"
    cw, ch = (side, side) if padded else ("w", "h")
    return f"""{name} AS (SELECT volume, w, h, sx * c AS m00, sx * s AS m01, sx * mx + 31.5 - sx * cx AS m02, -sy * s AS m10, sy * c AS m11, sy * my + 31.5 - sy * cy AS m12 FROM
 (SELECT *, (1 - c) * cx - s * cy + c * ox + s * oy AS mx, s * cx + (1 - c) * cy - s * ox + c * oy AS my FROM
  (SELECT *, (cw - 1) / 2 AS cx, (ch - 1) / 2 AS cy, 64 / cw AS sx, 64 / ch AS sy, (cw - w) / 2 AS ox, (ch - h) / 2 AS oy FROM
   (SELECT *, {cw} AS cw, {ch} AS ch FROM (SELECT volume, n_w::DOUBLE AS w, n_h::DOUBLE AS h, cos(radians({angle})) AS c, sin(radians({angle})) AS s FROM shapes)))))"""


def _inverse_sql(name: str, src: str) -> str:
    return f"""{name} AS (SELECT volume, w, h, m11 / det AS m00, -m01 / det AS m01, (m01 * m12 - m02 * m11) / det AS m02, -m10 / det AS m10, m00 / det AS m11, (m02 * m10 - m00 * m12) / det AS m12 FROM (SELECT *, m00 * m11 - m01 * m10 AS det FROM {src}))"""


ROUNDED = ", ".join(f"round({m} + 0.0::DOUBLE, 6) AS {m}" for m in views.AXES)
COMPOSED = ", ".join(f"{e} AS {m}" for m, e in zip(views.AXES, ("f.m00 * i.m00 + f.m01 * i.m10", "f.m00 * i.m01 + f.m01 * i.m11", "f.m00 * i.m02 + f.m01 * i.m12 + f.m02", "f.m10 * i.m00 + f.m11 * i.m10", "f.m10 * i.m01 + f.m11 * i.m11", "f.m10 * i.m02 + f.m11 * i.m12 + f.m12")))
SAME = "greatest(abs(m00 - 1), abs(m01), abs(m02), abs(m10), abs(m11 - 1), abs(m12)) <= 2e-5"
ONES = dict(zip(views.AXES, (1, 0, 0, 0, 1, 0)))


def _crop_sql() -> str:
    axis = lambda a, m, plane: (
        f"floor(least({', '.join(hull(m))})) - 2 AS lo_{a}, ceil(greatest({', '.join(hull(m))})) + 3 AS hi_{a}, {plane} AS plane_{a}"
    )
    hull = lambda m: [f"round({m}0 * {x} + {m}1 * {y} + {m}2, 9)" for x, y in (("-0.5::DOUBLE", "-0.5::DOUBLE"), ("39.5::DOUBLE", "-0.5::DOUBLE"), ("-0.5::DOUBLE", "39.5::DOUBLE"), ("39.5::DOUBLE", "39.5::DOUBLE"))]
    return f"""WITH {SHAPES}, {_placed_sql('p', True)}, {_inverse_sql('i', 'p')}, b AS (SELECT *, {axis('x', 'm0', 'w')}, {axis('y', 'm1', 'h')} FROM i),
n AS (SELECT *, greatest(1, least(plane_x, hi_x - lo_x)) AS nx, greatest(1, least(plane_y, hi_y - lo_y)) AS ny FROM b), q AS (SELECT *, greatest(0, least(lo_x, plane_x - nx)) AS px0, greatest(0, least(lo_y, plane_y - ny)) AS py0 FROM n)
SELECT volume, py0::BIGINT AS py0, (py0 + ny)::BIGINT AS py1, px0::BIGINT AS px0, (px0 + nx)::BIGINT AS px1, round(m02 - px0, 6) AS m02, round(m12 - py0, 6) AS m12 FROM q"""


def _members_sql() -> str:
    dot = lambda n: f"({n[0]} * a + {n[1]} * b + {n[2]} * c)"
    pick = lambda axis: "CASE face " + " ".join(f"WHEN {i} THEN {dot(f[axis])}" for i, f in enumerate(geometry.FACES)) + " END"
    return f"""WITH p AS (SELECT c_custkey, (c_custkey % 41 - 20)::DOUBLE AS a, (c_custkey // 41 % 37 - 18)::DOUBLE AS b, (c_nationkey - 12)::DOUBLE AS c FROM customer),
f AS (SELECT *, sqrt(a * a + b * b + c * c) AS norm, greatest(abs(a), abs(b), abs(c)) AS top FROM p, (SELECT unnest(range(6)) AS face) WHERE a <> 0 OR b <> 0 OR c <> 0),
l AS (SELECT c_custkey, face, ({pick(0)}) / norm AS n, ({pick(1)}) / norm AS r, ({pick(2)}) / norm AS u FROM f WHERE ({pick(0)}) > 0 AND ({pick(0)}) / top + {views.TOLERANCE!r} >= greatest(abs({pick(1)}), abs({pick(2)})) / top),
{_face_uv_sql()} SELECT c_custkey, face, floor((uu + 1) * 512 + 1e-6)::BIGINT AS ku, floor((vv + 1) * 512 + 1e-6)::BIGINT AS kv FROM uv"""


def _face_uv_sql() -> str:
    """From l (n, r, u of unit directions) to uv (uu, vv), other columns kept."""
    return f"""s AS (SELECT *, CASE WHEN abs(r) >= abs(u) THEN CASE WHEN r >= 0 THEN 0 ELSE 2 END ELSE CASE WHEN u >= 0 THEN 1 ELSE 3 END END AS area, greatest(abs(r), abs(u)) AS major FROM l),
m AS (SELECT *, CASE area WHEN 0 THEN u WHEN 1 THEN -r WHEN 2 THEN -u ELSE r END AS minor FROM s),
th AS (SELECT *, atan2(minor, major) AS theta FROM m),
q AS (SELECT *, CASE WHEN abs(minor) = major THEN sign(minor)::DOUBLE ELSE {12 / math.pi!r}::DOUBLE * (theta - asin(sin(theta) * {1 / math.sqrt(2)!r}::DOUBLE)) END AS ratio,
  CASE WHEN major = n THEN 1.0::DOUBLE ELSE sqrt(r * r + u * u) / sqrt((1 + n) * (1 - cos(theta) / sqrt(1 + cos(theta) * cos(theta)))) END AS pp FROM th),
uv AS (SELECT *, greatest(-1, least(1, CASE area WHEN 0 THEN pp WHEN 1 THEN -pp * ratio WHEN 2 THEN -pp ELSE pp * ratio END)) AS uu, greatest(-1, least(1, CASE area WHEN 0 THEN pp * ratio WHEN 1 THEN pp WHEN 2 THEN -pp * ratio ELSE -pp END)) AS vv FROM q)"""


def _direction_sql(src: str) -> str:
    """Tables up to ``dir`` (dx, dy, dz) from ``src`` (face, u, v), other columns kept."""
    root = repr(1 / math.sqrt(2))
    basis = lambda k: "normal * " + _face_case(0, k) + " + right_ * " + _face_case(1, k) + " + rise * " + _face_case(2, k)
    return f"""d1 AS (SELECT *, CASE WHEN abs(u) >= abs(v) THEN CASE WHEN u >= 0 THEN 0 ELSE 2 END ELSE CASE WHEN v >= 0 THEN 1 ELSE 3 END END AS area, greatest(abs(u), abs(v)) AS p FROM {src}),
d2 AS (SELECT *, CASE WHEN p = 0 THEN 0 ELSE CASE area WHEN 0 THEN v WHEN 1 THEN -u WHEN 2 THEN -v ELSE u END / p END AS ratio FROM d1),
d3 AS (SELECT *, sin(ratio * {math.pi / 12!r}::DOUBLE) AS up, cos(ratio * {math.pi / 12!r}::DOUBLE) - {root}::DOUBLE AS on_ FROM d2),
d4 AS (SELECT *, CASE WHEN abs(ratio) = 1 THEN {root}::DOUBLE ELSE on_ / sqrt(up * up + on_ * on_) END AS co, CASE WHEN abs(ratio) = 1 THEN sign(ratio) * {root}::DOUBLE ELSE up / sqrt(up * up + on_ * on_) END AS si FROM d3),
d5 AS (SELECT *, 1 - co / sqrt(1 + co * co) AS d FROM d4), d6 AS (SELECT *, 1 - p * p * d AS normal, p * sqrt(d * (2 - p * p * d)) AS far FROM d5),
d7 AS (SELECT *, CASE WHEN p = 1 THEN normal ELSE far * co END AS major, CASE WHEN p = 1 AND abs(ratio) = 1 THEN sign(ratio) * normal ELSE far * si END AS minor FROM d6),
d8 AS (SELECT *, CASE area WHEN 0 THEN major WHEN 1 THEN -minor WHEN 2 THEN -major ELSE minor END AS right_, CASE area WHEN 0 THEN minor WHEN 1 THEN major WHEN 2 THEN -minor ELSE -major END AS rise FROM d7),
dir AS (SELECT *, {basis(0)} AS dx, {basis(1)} AS dy, {basis(2)} AS dz FROM d8)"""


def _face_case(axis: int, k: int) -> str:
    return "(CASE face " + " ".join(f"WHEN {i} THEN {f[axis][k]}" for i, f in enumerate(geometry.FACES)) + " END)::DOUBLE"


def _samples_sql() -> str:
    at = lambda k: f"round(3.5::DOUBLE + r * ({' + '.join(f'{TURN[k][j]!r}::DOUBLE * d{c}' for j, c in enumerate('xyz'))}), 9)"
    return f"""grid AS (SELECT face, shell, row, col, 2.0::DOUBLE * col / {INTERVALS} - 1 AS u, 1 - 2.0::DOUBLE * row / {INTERVALS} AS v, {RADII!r}[shell + 1]::DOUBLE AS r
 FROM (SELECT unnest(range(6)) AS face), (SELECT unnest(range({len(RADII)})) AS shell), (SELECT unnest(range({INTERVALS + 1})) AS row), (SELECT unnest(range({INTERVALS + 1})) AS col)),
{_direction_sql('grid')}, samples AS (SELECT * FROM (SELECT face, shell, row, col, {at(2)} AS t, {at(1)} AS y, {at(0)} AS x FROM dir) WHERE t > -1 AND t < 8 AND y > -1 AND y < 8 AND x > -1 AND x < 8)"""


RADIAL = f"""shells AS (SELECT unnest(range({len(RADII)})) AS shell, unnest({RADII!r})::DOUBLE AS r), arcs AS (SELECT shell, r, unnest(range(greatest(1, ceil(round({2 * math.pi!r}::DOUBLE * r, 9)))::BIGINT)) AS arc FROM shells),
samples AS (SELECT * FROM (SELECT shell, height, arc, height::DOUBLE AS t, round(3.5::DOUBLE + r * sin(arc / r), 9) AS y, round(3.5::DOUBLE + r * cos(arc / r), 9) AS x FROM arcs, (SELECT unnest(range(8)) AS height)) WHERE y > -1 AND y < 8 AND x > -1 AND x < 8)"""
MASK = "masks AS (SELECT t // 8 AS volume, t % 8 AS t, y, x FROM voxels)"


def _nearest_sql(samples: str, keys: str) -> str:
    return f"{V(0.15)}, {MASK}, {samples}, frames AS (SELECT m.volume, {keys} FROM samples s JOIN masks m ON m.t = floor(s.t + 0.5) AND m.y = floor(s.y + 0.5) AND m.x = floor(s.x + 0.5))"


def _linear_sql(samples: str, keys: str) -> str:
    return f"""WITH {GRAYS}, {samples}, w AS (SELECT volume, {keys}, sum(g.g * (1 - abs(g.t - s.t)) * (1 - abs(g.y - s.y)) * (1 - abs(g.x - s.x))) AS v FROM samples s JOIN grays g
 ON abs(g.t - s.t) < 1 AND abs(g.y - s.y) < 1 AND abs(g.x - s.x) < 1 GROUP BY ALL) SELECT volume, {keys}, least(255, round_even(round(v, 6), 0))::BIGINT AS g FROM w"""


def _spherical_projection_sql() -> str:
    world = ("dx0", "dy0", "dz0")
    local = lambda j: "round(" + " + ".join(f"{TURN[k][j]!r}::DOUBLE * {world[k]}" for k in range(3)) + ", 12)"
    dot = lambda f: f"({f[0]} * a + {f[1]} * b + {f[2]} * c)"
    pick = lambda axis: "(CASE fc " + " ".join(f"WHEN {i} THEN {dot(f[axis])}" for i, f in enumerate(geometry.FACES)) + " END)"
    return f"""{_nearest_sql(_samples_sql(), 'face, shell, row, col')},
g0 AS (SELECT t, y, x, x - 3.5::DOUBLE AS dx0, y - 3.5::DOUBLE AS dy0, t - 3.5::DOUBLE AS dz0 FROM (SELECT unnest(range(8)) AS t), (SELECT unnest(range(8)) AS y), (SELECT unnest(range(8)) AS x)),
g1 AS (SELECT *, sqrt(dx0 * dx0 + dy0 * dy0 + dz0 * dz0) AS rad, {local(0)} AS a, {local(1)} AS b, {local(2)} AS c FROM g0),
g2 AS (SELECT *, sqrt(a * a + b * b + c * c) AS norm, greatest(abs(a), abs(b), abs(c)) AS top FROM g1, (SELECT unnest(range(6)) AS fc) WHERE rad BETWEEN {RADII[0] - 1e-9!r} AND {RADII[-1] + 1e-9!r}),
l AS (SELECT t AS vt, y AS vy, x AS vx, rad, fc, {pick(0)} / norm AS n, {pick(1)} / norm AS r, {pick(2)} / norm AS u FROM g2 WHERE {pick(0)} > 0 AND {pick(0)} / top + {views.TOLERANCE!r} >= greatest(abs({pick(1)}), abs({pick(2)})) / top),
{_face_uv_sql()}, near AS (SELECT *, (SELECT arg_min(k, (round(abs(rad - rr), 9), k)) FROM (SELECT unnest(range({len(RADII)})) AS k, unnest({RADII!r})::DOUBLE AS rr)) AS sh,
 round_even(round((1 - vv) * {INTERVALS} / 2, 9), 0)::BIGINT AS rw, round_even(round((uu + 1) * {INTERVALS} / 2, 9), 0)::BIGINT AS cl FROM uv)
SELECT DISTINCT f.volume, n.vt AS t, n.vy AS y, n.vx AS x FROM near n JOIN frames f ON f.face = n.fc AND f.shell = n.sh AND f.row = n.rw AND f.col = n.cl"""


TAN = repr(math.tan(math.radians(TILT)))
MATRIX = geometry.invert(geometry.affine(8, 8, 12, 30.0))


def _tap_sql(name: str, n_in: int, n_out: int, aligned: bool) -> str:
    at = f"o * {(n_in - 1) / max(1, n_out - 1)!r}::DOUBLE" if aligned else f"(o + 0.5::DOUBLE) * {n_in / n_out!r}::DOUBLE - 0.5::DOUBLE"
    return f"{name} AS (SELECT o, i, 1 - abs(i - p) AS w FROM (SELECT o, greatest(0, least({n_in - 1}, round({at}, 9))) AS p FROM (SELECT unnest(range({n_out})) AS o)), (SELECT unnest(range({n_in})) AS i) WHERE abs(i - p) < 1)"


ORACLES = {
    "axis_specs": f"""WITH {SHAPES} SELECT volume, 'transverse' AS view, n_t AS num_slices, n_h AS src_h, n_w AS src_w, 't' AS stack_axis, 'y' AS vertical_axis, 'x' AS horizontal_axis FROM shapes
UNION ALL SELECT volume, 'sagittal', n_h, n_t, n_w, 'y', 't', 'x' FROM shapes UNION ALL SELECT volume, 'coronal', n_w, n_t, n_h, 'x', 't', 'y' FROM shapes""",
    "affine_columns": f"WITH {SHAPES}, {_placed_sql('p', False)}, {_placed_sql('q', True)} SELECT volume, false AS padded, {ROUNDED} FROM p UNION ALL SELECT volume, true, {ROUNDED} FROM q",
    "processing_affine": f"""WITH {SHAPES}, {_placed_sql('p', False)}, {_inverse_sql('i', 'p')}, {_placed_sql('f', False, '0.0::DOUBLE')}, c AS (SELECT i.volume, {COMPOSED} FROM i JOIN f USING (volume)),
e AS (SELECT volume, {SAME} AS same, {", ".join(f"CASE WHEN {SAME} THEN {v} ELSE {m} END AS {m}" for m, v in ONES.items())} FROM c) SELECT volume, same, {ROUNDED} FROM e""",
    "mirrored_affine": f"WITH {SHAPES}, {_placed_sql('p', False)}, {_inverse_sql('i', 'p')}, k AS (SELECT volume, -m00 AS m00, -m01 AS m01, greatest(w - 1, 0) - m02 AS m02, m10, m11, m12 FROM i) SELECT volume, {ROUNDED} FROM k",
    "crop_windows": _crop_sql(),
    "azimuth_lists": f"""WITH RECURSIVE {SHAPES}, r AS (SELECT volume, (volume % 11 + 1) * 3.7::DOUBLE AS step, 0.0::DOUBLE AS a FROM shapes UNION ALL SELECT volume, step, a + step FROM r WHERE a + step < 180.0 - 1e-9) SELECT volume, round(a, 6) AS angle FROM r""",
    "azimuthal_plan": f"""WITH {SHAPES}, v AS (SELECT volume, least(n_h, n_w) AS diameter, n_w - CASE WHEN volume % 5 = 0 THEN 60 ELSE 0 END AS src_w FROM shapes),
p AS (SELECT *, 360.0::DOUBLE / ({math.pi!r}::DOUBLE * diameter) AS full_ FROM v), q AS (SELECT *, full_ * {math.sqrt(4 * views.BUDGET - 1)!r}::DOUBLE AS spacing, ceil(180.0::DOUBLE / full_)::BIGINT AS num FROM p),
n AS (SELECT *, ceil((180.0::DOUBLE - 1e-9) / spacing)::BIGINT AS k FROM q) SELECT volume, round(spacing, 9) AS spacing, CASE WHEN src_w >= diameter AND k < num THEN k ELSE num END AS frames, src_w >= diameter AND k < num AS optimised FROM n""",
    "sampling_scalars": f"""WITH {SHAPES}, r AS (SELECT *, volume * 2.5::DOUBLE + 0.5::DOUBLE AS r, 0.25::DOUBLE / (volume * 2.5::DOUBLE + 0.5::DOUBLE) AS sl, least(64::DOUBLE / n_h, 80::DOUBLE / n_w) AS scale FROM shapes),
g AS (SELECT *, {4 * views.BUDGET - 1!r}::DOUBLE / (sqrt({4 * views.BUDGET - 1!r}::DOUBLE + sl * sl) + sl) AS gap FROM r)
SELECT volume, round(360.0::DOUBLE / ({math.pi!r}::DOUBLE * n_w), 9) AS spacing, round(gap, 9) AS gap, round(gap * gap / 4 + 0.25::DOUBLE + gap / (8 * r), 9) AS error, (2 * greatest(1, ceil(1.5::DOUBLE * sqrt(r) * sqrt(r + 0.5::DOUBLE))))::BIGINT AS intervals,
 round(scale, 9) AS scale, round(CASE WHEN scale = 1 THEN 30.0::DOUBLE ELSE degrees(atan(tan(radians(30.0::DOUBLE)) * scale)) END, 9) AS cone FROM g""",
    "spherical_plan": f"""WITH {SHAPES}, r AS (SELECT volume, volume + 5.0::DOUBLE AS lo, volume * 11 + 40.0::DOUBLE AS hi, volume % 7 * 64 + 64 AS patch FROM shapes),
d AS (SELECT *, (2 * greatest(1, ceil(1.5::DOUBLE * sqrt(hi) * sqrt(hi + 0.5::DOUBLE))))::BIGINT AS dn, greatest(1, ceil(hi - lo) + 1)::BIGINT AS ds FROM r), e AS (SELECT *, (dn + patch) // patch AS dk FROM d),
k AS (SELECT volume, lo, hi, k, 2 * ((k * patch - 1) // 2) AS n FROM (SELECT *, unnest(range(1, dk + 1)) AS k FROM e)), l AS (SELECT *, {views.SPHERE_BUDGET!r}::DOUBLE - 2 * (hi / n) * (hi / n) AS spare FROM k WHERE n > 0),
c AS (SELECT *, greatest(CASE WHEN hi > lo THEN 2 ELSE 1 END, ceil((hi - lo) / (2 * sqrt(spare) * (1 - 1e-13::DOUBLE))) + 1)::BIGINT AS s FROM l WHERE spare > 1e-12),
b AS (SELECT volume, min(6 * k * k * s) AS frames, arg_min(k, (6 * k * k * s, k)) AS k, arg_min(s, (6 * k * k * s, k)) AS s, arg_min(n, (6 * k * k * s, k)) AS n FROM c GROUP BY volume)
SELECT e.volume, 6 * dk * dk * ds AS dense_frames, coalesce(b.frames < 6 * dk * dk * ds, false) AS optimised, CASE WHEN b.frames < 6 * dk * dk * ds THEN b.frames ELSE 6 * dk * dk * ds END AS frames, CASE WHEN b.frames < 6 * dk * dk * ds THEN b.k ELSE dk END AS patches,
 CASE WHEN b.frames < 6 * dk * dk * ds THEN b.s ELSE ds END AS shells, CASE WHEN b.frames < 6 * dk * dk * ds THEN b.n ELSE dn END AS intervals FROM e LEFT JOIN b USING (volume)""",
    "qsc_members": _members_sql(),
    "qsc_inverse": f"WITH {SHAPES}, src AS (SELECT volume, face, (volume * 7 % 21) / 10.0::DOUBLE - 1 AS u, (volume * 3 % 17) / 8.0::DOUBLE - 1 AS v FROM shapes, (SELECT unnest(range(6)) AS face)), {_direction_sql('src')} SELECT volume, face, round(dx + 0.0::DOUBLE, 7) AS x, round(dy + 0.0::DOUBLE, 7) AS y, round(dz + 0.0::DOUBLE, 7) AS z FROM dir",
    "low_quality_specs": f"""WITH {SHAPES}, q AS (SELECT *, unnest(range(5)) AS nth, unnest(['0.5', '64', '0.25', '62', '33']) AS token FROM shapes),
s AS (SELECT *, CASE WHEN token LIKE '%.%' THEN token::DOUBLE ELSE greatest(4, floor(token::DOUBLE / 4 + 0.5) * 4) / greatest(n_t, n_h, n_w) END AS sc FROM q),
o AS (SELECT volume, nth, token, {", ".join(f"greatest(4, floor(round(n_{c} * sc, 9) / 4 + 0.5) * 4)::BIGINT AS out_{c}" for c in "thw")} FROM s) SELECT volume, out_t, out_h, out_w, arg_min(token, nth) AS token FROM o GROUP BY volume, out_t, out_h, out_w""",
    "spherical_frames": f"{_nearest_sql(_samples_sql(), 'face, shell, row, col')} SELECT * FROM frames",
    "spherical_linear": _linear_sql(_samples_sql(), "face, shell, row, col"),
    "spherical_projection": _spherical_projection_sql(),
    "radial_frames": f"{_nearest_sql(RADIAL, 'shell, height, arc')} SELECT * FROM frames",
    "radial_linear": _linear_sql(RADIAL, "shell, height, arc"),
    "radial_projection": f"""{_nearest_sql(RADIAL, 'shell, height, arc')}, g AS (SELECT y, x, sqrt((y - 3.5::DOUBLE) * (y - 3.5) + (x - 3.5::DOUBLE) * (x - 3.5)) AS rad, atan2(y - 3.5::DOUBLE, x - 3.5::DOUBLE) AS a FROM (SELECT unnest(range(8)) AS y), (SELECT unnest(range(8)) AS x)),
n AS (SELECT *, (SELECT arg_min(k, (round(abs(rad - rr), 9), k)) FROM (SELECT unnest(range({len(RADII)})) AS k, unnest({RADII!r})::DOUBLE AS rr)) AS sh FROM g WHERE rad BETWEEN {RADII[0] - 1e-9!r} AND {RADII[-1] + 1e-9!r}),
o AS (SELECT y, x, sh, round_even(round((CASE WHEN a < 0 THEN a + {2 * math.pi!r}::DOUBLE ELSE a END + turn * {2 * math.pi!r}::DOUBLE) * {RADII!r}[sh + 1]::DOUBLE, 9), 0)::BIGINT AS ar FROM n, (SELECT unnest([-1, 0, 1]) AS turn))
SELECT DISTINCT f.volume, f.height AS t, o.y, o.x FROM o JOIN frames f ON f.shell = o.sh AND f.arc = o.ar""",
    "tilted_frames": f"""WITH {GRAYS}, f AS (SELECT volume, c, y, x, c + round((y - 3.5::DOUBLE) * {TAN}::DOUBLE, 9) AS p FROM (SELECT DISTINCT volume, y, x FROM grays), (SELECT unnest(range(8)) AS c)),
w AS (SELECT f.volume, c, f.y, f.x, p, sum(g.g * (1 - abs(g.t - p))) AS v, count(*) AS n FROM f JOIN grays g ON g.volume = f.volume AND g.y = f.y AND g.x = f.x AND abs(g.t - p) < 1 GROUP BY ALL)
SELECT volume, c AS frame, y, x, least(255, round_even(round(v, 6), 0))::BIGINT AS g FROM w WHERE p >= 0 AND p <= 7""",
    "tilted_projection": f"{V(0.1)}, {MASK} SELECT DISTINCT volume, round_even(round(t + (y - 3.5::DOUBLE) * {TAN}::DOUBLE, 9), 0)::BIGINT AS t, y::BIGINT AS y, x::BIGINT AS x FROM masks WHERE round_even(round(t + (y - 3.5::DOUBLE) * {TAN}::DOUBLE, 9), 0) BETWEEN 0 AND 7",
    "azimuthal_frames": f"""WITH {GRAYS}, l AS (SELECT unnest(range(7)) AS frame, unnest({ANGLES!r})::DOUBLE AS a), p AS (SELECT frame, u, round(3.5::DOUBLE + (u * 0.875::DOUBLE - 3.5) * sin(radians(a)), 9) AS py, round(3.5::DOUBLE + (u * 0.875::DOUBLE - 3.5) * cos(radians(a)), 9) AS px FROM l, (SELECT unnest(range(9)) AS u)),
k AS (SELECT unnest(range(8)) AS i), ty AS (SELECT frame, u, i AS y, (1 - abs(i - py)) / sum(1 - abs(i - py)) OVER (PARTITION BY frame, u) AS w FROM p, k WHERE abs(i - py) < 1), tx AS (SELECT frame, u, i AS x, (1 - abs(i - px)) / sum(1 - abs(i - px)) OVER (PARTITION BY frame, u) AS w FROM p, k WHERE abs(i - px) < 1)
SELECT volume, frame, t AS row, u, least(255, round_even(round(sum(g * ty.w * tx.w), 6), 0))::BIGINT AS g FROM ty JOIN tx USING (frame, u) JOIN grays USING (y, x) GROUP BY volume, frame, t, u""",
    "cube_resize_gray": f"""WITH {GRAYS}, {_tap_sql('ta', 8, 5, True)}, {_tap_sql('ya', 8, 11, False)}, {_tap_sql('xa', 8, 6, False)},
s AS (SELECT volume, t, ya.o AS y, xa.o AS x, round_even(round(sum(g * ya.w * xa.w), 6), 0) AS g FROM grays JOIN ya ON ya.i = y JOIN xa ON xa.i = x GROUP BY ALL)
SELECT volume, ta.o AS t, y, x, round_even(round(sum(g * ta.w), 6), 0)::BIGINT AS g FROM s JOIN ta ON ta.i = t GROUP BY volume, ta.o, y, x""",
    "warp_gray": f"""WITH {GRAYS}, p AS (SELECT oy, ox, round({MATRIX[3]!r}::DOUBLE * ox + {MATRIX[4]!r}::DOUBLE * oy + {MATRIX[5]!r}::DOUBLE, 9) AS py, round({MATRIX[0]!r}::DOUBLE * ox + {MATRIX[1]!r}::DOUBLE * oy + {MATRIX[2]!r}::DOUBLE, 9) AS px FROM (SELECT unnest(range(12)) AS oy), (SELECT unnest(range(12)) AS ox))
SELECT volume, t, oy AS y, ox AS x, round_even(round(sum(g * (1 - abs(y - py)) * (1 - abs(x - px))), 6), 0)::BIGINT AS g FROM p JOIN grays ON abs(y - py) < 1 AND abs(x - px) < 1 GROUP BY volume, t, oy, ox""",
    "gray_downbin": f"WITH {GRAYS} SELECT volume, t, y // 3 AS y, x // 3 AS x, round_even(round(sum(g) / (least(3, 8 - y // 3 * 3) * least(3, 8 - x // 3 * 3)), 9), 0)::BIGINT AS g FROM grays GROUP BY volume, t, y // 3, x // 3",
}
