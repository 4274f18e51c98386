"""Centroid clustering (Lloyd's rounds) by kd-tree filtering, exact in whole numbers.

Components become integers, floor(scale * x). Each partition builds kd-trees over runs of at most ``TREE`` vectors and writes
them, once, to the shared folder: points in tree order and, for every node, box, count, integer sums and sum of squares. A
round walks the trees level by level. Of a node's candidates the one nearest to the middle of its box is taken, and every
candidate that this one strictly dominates over the whole box is pruned; so are those that are never nearer and come later,
since ties go to the smaller number. A node with one candidate left is assigned as a whole from its count and sums; leaves
with several are resolved point by point among those left. A task returns one row of sums for each centroid, Spark adds them
up, and the driver holds k centroids and nothing else.

Distances are exact: products stay below 2^53 in doubles, or are taken in 64-bit integers. A component of 2^21 or more in size
(after scaling: ``LARGEST``) would make a squared distance that no long holds, and raises an error.

Nulls: a vector that is null, of other length, or has a null or non-finite component is not kept and gives no row; a null id
is kept, and hashes as an empty one. The first centroids are the kept vectors with the smallest hashes of ``seed:id``; rows of
equal hash (repeated ids) count each, in the order of their components. Fewer vectors than k are as many centroids. Equal
centroids: the smaller number takes all, the other keeps its place. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavox.llm import common

#: Vectors of a tree, points of a leaf.
TREE, LEAF = 1 << 15, 48
#: Largest integer component for which squared distances of vectors of 64 components fit a long.
LARGEST = 1 << 27
_TREE = "ids binary, known binary, points binary, nodes binary, shape array<int>"


def kept(vectors: DataFrame, dim: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the vectors that have ``dim`` finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.where(F.coalesce(F.size("vector") == dim, F.lit(False)) & F.forall("vector", finite))


def scaled(vectors: np.ndarray, scale: int) -> np.ndarray:
    x = np.floor(vectors * scale)
    if x.size and np.abs(x).max() >= LARGEST:
        raise ValueError(f"a component times {scale} is {LARGEST} or more: squared distances would not fit a long")
    return x.astype(np.int64)


def build(points: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(order, nodes): points in tree order, and arrays with one entry a node, parents before children.

    A node is split at the median of its widest side until it has ``LEAF`` points or no extent. ``left`` is the number of the
    first child (the second is next to it), 0 for leaves.
    """
    order = np.arange(len(points))
    spans, left, lows, highs = [(0, len(points))], [], [], []
    for a, b in spans:
        here = points[order[a:b]]
        low, high = here.min(0), here.max(0)
        lows.append(low)
        highs.append(high)
        axis = int((high - low).argmax())
        if b - a <= LEAF or low[axis] == high[axis]:
            left.append(0)
            continue
        left.append(len(spans))
        half = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(here[:, axis], half, kind="introselect")]
        spans += [(a, a + half), (a + half, b)]
    start, stop = np.array(spans).T
    placed = points[order]
    totals = np.vstack([np.zeros((1, points.shape[1]), np.int64), placed.cumsum(0)])
    squares = np.concatenate([[0], (placed * placed).sum(1).cumsum()])
    return order, {"start": start, "stop": stop, "left": np.array(left), "low": np.array(lows), "high": np.array(highs), "sums": totals[stop] - totals[start], "squares": squares[stop] - squares[start]}


def _exact(*arrays: np.ndarray) -> type:
    """Doubles where every sum of products below is an integer under 2^53, else 64-bit integers."""
    largest = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    return np.float64 if 4 * arrays[0].shape[-1] * largest * largest < 1 << 53 else np.int64


def prune(low: np.ndarray, high: np.ndarray, open_: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which of the candidates ``open_`` (nodes x k) of boxes stay: a candidate goes if another is nearer to every point of the box."""
    kind = _exact(low, high, centroids)
    lo, hi, z = low.astype(kind), high.astype(kind), centroids.astype(kind)
    size = (z * z).sum(1)
    middle = (size - (lo + hi) @ z.T).astype(np.float64)  # distance from the middle of the box, less what all have in common
    best = np.where(open_, middle, np.inf).argmin(1)
    out = open_.copy()
    for b in np.unique(best):
        nodes = np.flatnonzero(best == b)
        away = z - z[b]
        # the least of |x - z|^2 - |x - z_b|^2 over the box is at a corner
        least = size - size[b] - 2 * (hi[nodes] @ np.maximum(away, 0).T + lo[nodes] @ np.minimum(away, 0).T)
        later = np.arange(len(z)) > b
        out[nodes] &= ~((least > 0) | ((least == 0) & later))
    return out


def filtered(nodes: dict[str, np.ndarray], centroids: np.ndarray) -> tuple[list[tuple[int, int]], list[tuple[int, np.ndarray]]]:
    """([(node, centroid)] of nodes that one centroid takes whole, [(leaf, candidates)] of leaves to resolve)."""
    whole, leaves = [], []
    at, open_ = np.zeros(1, np.int64), np.ones((1, len(centroids)), bool)
    while len(at):
        open_ = prune(nodes["low"][at], nodes["high"][at], open_, centroids)
        single = open_.sum(1) == 1
        leaf = nodes["left"][at] == 0
        whole += zip(at[single].tolist(), open_[single].argmax(1).tolist())
        leaves += [(int(n), np.flatnonzero(o)) for n, o in zip(at[~single & leaf], open_[~single & leaf])]
        down = ~single & ~leaf
        first = nodes["left"][at[down]]
        at, open_ = np.concatenate([first, first + 1]), np.concatenate([open_[down], open_[down]])
    return whole, leaves


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest row of ``centroids``, the first of equals; squared distance) of each point."""
    kind = _exact(points, centroids)
    p, z = points.astype(kind), centroids.astype(kind)
    far = (p * p).sum(1)[:, None] - 2 * (p @ z.T) + (z * z).sum(1)
    got = far.argmin(1)
    return got, far[np.arange(len(p)), got].astype(np.int64)


def _pack(ids: pa.Array, points: np.ndarray) -> dict:
    order, nodes = build(points)
    largest = int(np.abs(points).max()) if points.size else 0
    kind = next(t for t in (np.int8, np.int16, np.int32) if largest < np.iinfo(t).max)
    blob = lambda a: zlib.compress(np.ascontiguousarray(a).tobytes(), 1)
    known = np.asarray(ids.is_valid())[order]
    table = np.column_stack([nodes[c] for c in ("start", "stop", "left", "squares", "low", "high", "sums")]).astype(np.int64)
    return {"ids": blob(np.asarray(ids.fill_null(0))[order]), "known": blob(known), "points": blob(points[order].astype(kind)), "nodes": blob(table), "shape": [len(points), points.shape[1], len(table), np.dtype(kind).itemsize]}


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    n, d, m, width = row["shape"]
    read = lambda c, kind: np.frombuffer(zlib.decompress(row[c]), kind)
    table = read("nodes", np.int64).reshape(m, 4 + 3 * d)
    nodes = dict(zip(("start", "stop", "left", "squares"), table[:, :4].T)) | {"low": table[:, 4 : 4 + d], "high": table[:, 4 + d : 4 + 2 * d], "sums": table[:, 4 + 2 * d :]}
    return read("ids", np.int64), read("known", bool), read("points", f"i{width}").reshape(n, d).astype(np.int64), nodes


def trees(vectors: DataFrame, dim: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """One row a kd-tree, several trees a partition if it has more than ``TREE`` vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, points, held = [], [], 0

        def tree():
            row = _pack(pa.concat_arrays(ids), np.concatenate(points))
            return pa.RecordBatch.from_pylist([row], pa.schema([(c, pa.binary()) for c in ("ids", "known", "points", "nodes")] + [("shape", pa.list_(pa.int32()))]))

        for batch in batches:
            for i in range(0, batch.num_rows, TREE):
                part = batch.slice(i, TREE)
                flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                if held and held + part.num_rows > TREE:
                    yield tree()
                    ids, points, held = [], [], 0
                ids.append(part.column("id"))
                points.append(scaled(flat.reshape(-1, dim), scale))
                held += part.num_rows
        if held:
            yield tree()

    return kept(vectors, dim, id_col, vector_col).mapInArrow(run, _TREE)


def _sums(forest: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, n, far, s0, s1, ...): count, sum of squared distances and sums of the vectors nearest to each centroid."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, far, sums = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                _, _, points, nodes = _unpack(row)
                whole, leaves = filtered(nodes, centroids)
                for node, c in whole:
                    count = nodes["stop"][node] - nodes["start"][node]
                    n[c] += count
                    sums[c] += nodes["sums"][node]
                    far[c] += nodes["squares"][node] - 2 * (nodes["sums"][node] @ centroids[c]) + count * (centroids[c] @ centroids[c])
                for leaf, open_ in leaves:
                    here = points[nodes["start"][leaf] : nodes["stop"][leaf]]
                    got, distance = nearest(here, centroids[open_])
                    for i, c in enumerate(open_):
                        mine = got == i
                        n[c] += mine.sum()
                        sums[c] += here[mine].sum(0)
                        far[c] += distance[mine].sum()
        columns = [np.arange(k), n, far, *sums.T]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cluster", "n", "far", *(f"s{d}" for d in range(dim))])

    parts = forest.mapInArrow(run, "cluster bigint, n bigint, far bigint, " + ", ".join(f"s{d} bigint" for d in range(dim)))
    return parts.groupBy("cluster").agg(*(F.sum(c).alias(c) for c in parts.columns[1:]))


def first_centroids(vectors: DataFrame, k: int, dim: int, scale: int, seed: str, id_col: str, vector_col: str) -> np.ndarray:
    """The k kept vectors with the smallest SHA-256 of ``seed:id``, as integers."""
    rows = kept(vectors, dim, id_col, vector_col)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    found = rows.select(name.alias("hash"), "vector").orderBy("hash", "vector").limit(k).collect()
    return scaled(np.array([r.vector for r in found]).reshape(-1, dim), scale)


def fit(forest: DataFrame, centroids: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, sum of squared distances to each) after so many rounds of assignment and means, rounded down."""
    spent = np.zeros(len(centroids), np.int64)
    for r in range(rounds + 1):
        spent = np.zeros(len(centroids), np.int64)
        moved = centroids.copy()
        for row in _sums(forest, centroids).collect():  # one row a centroid
            spent[row.cluster] = row.far
            if row.n:
                moved[row.cluster] = [row[f"s{d}"] // row.n for d in range(centroids.shape[1])]
        if r < rounds:
            centroids = moved
    return centroids, spent


def assigned(forest: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, known, points, nodes = _unpack(row)
                whole, leaves = filtered(nodes, centroids)
                cluster, distance = np.zeros(len(ids), np.int32), np.zeros(len(ids), np.int64)
                for node, open_ in [(node, np.array([c])) for node, c in whole] + leaves:
                    span = slice(nodes["start"][node], nodes["stop"][node])
                    got, distance[span] = nearest(points[span], centroids[open_])
                    cluster[span] = open_[got]
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=~known), pa.array(cluster), pa.array(distance)], ["id", "cluster", "distance"])

    return forest.mapInArrow(run, "id bigint, cluster int, distance bigint")


def _each(values: list) -> Column:
    """The value of a row's cluster."""
    return F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: str = "1", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid) of every kept vector."""
    spark = vectors.sparkSession
    path = common.shared_dir(spark, "kd-trees")
    trees(vectors, dim, scale, id_col, vector_col).write.parquet(path)
    forest = spark.read.parquet(path)
    centroids, spent = fit(forest, first_centroids(vectors, k, dim, scale, seed, id_col, vector_col), rounds)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string, centroid array<bigint>")
    rows = assigned(forest, centroids)
    named = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    total = F.lit(int(spent.sum())).cast("bigint")
    out = rows.select(F.col("id").alias("vec_id"), "cluster", "distance", _each(spent.tolist()).cast("bigint").alias("cluster_inertia"), total.alias("inertia"), _each(named).alias("centroid_sha256"))
    where = F.element_at(F.array(*(F.array(*map(F.lit, c)) for c in centroids.tolist())), F.col("cluster") + 1).cast("array<bigint>")
    return out.withColumn("centroid", where)


def op11_centroids(spark, sf_dir: str) -> DataFrame:
    """All ``embeddings`` in 16 clusters after three rounds."""
    return cluster(common.table(spark, sf_dir, "embeddings")).drop("centroid")


def _round_sql(i: int, k: int = 16) -> str:
    return f"""far{i} AS MATERIALIZED (
  SELECT v.r, c.c, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d FROM cells v JOIN z{i} c ON v.i = c.i GROUP BY v.r, c.c
), near{i} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM far{i} GROUP BY r
)"""


def _move_sql(i: int) -> str:
    return f"""z{i + 1} AS MATERIALIZED (
  SELECT z.c, z.i, CASE WHEN m.n IS NULL THEN z.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
  FROM z{i} z LEFT JOIN (SELECT n.c, v.i, sum(v.x)::BIGINT AS s, count(*) AS n FROM near{i} n JOIN cells v ON n.r = v.r GROUP BY n.c, v.i) m ON z.c = m.c AND z.i = m.i
)"""


OP11_SQL = f"""
WITH good AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v, sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, embedding
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), cells AS MATERIALIZED (
  SELECT r, unnest(range(0, 64)) AS i, unnest(v) AS x FROM good
), z0 AS MATERIALIZED (
  SELECT c - 1 AS c, i, x FROM cells JOIN (SELECT r, row_number() OVER (ORDER BY h, embedding) AS c FROM good) USING (r) WHERE c <= 16
), {_round_sql(0)}, {_move_sql(0)}, {_round_sql(1)}, {_move_sql(1)}, {_round_sql(2)}, {_move_sql(2)}, {_round_sql(3)},
names AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM z3 GROUP BY c)
SELECT g.vec_id, n.c::INT AS cluster, n.d AS distance, sum(n.d) OVER (PARTITION BY n.c)::BIGINT AS cluster_inertia, sum(n.d) OVER ()::BIGINT AS inertia, centroid_sha256
FROM near3 n JOIN good g USING (r) JOIN names USING (c)
"""

QUERIES = {"op11_centroids": op11_centroids}
ORACLES = {"op11_centroids": OP11_SQL}
