"""The native union of a volume: layers folded in order, filtered in a fixed sequence, protected foreground put back last."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from stratavox.operators import geometry, masks
from stratavox.session import checkpointed


@dataclass(frozen=True)
class Filters:
    """What is asked for; the order is fixed: voids are filled, the mask is smoothed, the largest objects are kept."""

    voids: int | None = None  # connectivity of the background
    sigma: float | None = None
    keep: int | None = None  # number of objects
    connectivity: int = 26


def check_layers(layers: DataFrame) -> None:
    """Raises where two operations share a place in the order, none is composable, or the first composable one subtracts."""
    ops = layers.select("ord", "op").distinct().orderBy("ord").collect()  # a row a layer
    if len({r.ord for r in ops}) < len(ops):
        raise ValueError("a layer has more than one operation")
    known = [r.op for r in ops if r.op != "none"]
    if not known:
        raise ValueError("at least one layer must be composable")
    if known[0] == "subtract":
        raise ValueError("the first composable layer cannot subtract")


def finalize(layers: DataFrame, size: int, depth: int, filters: Filters, protected: DataFrame | None = None, stage: Callable[[str, DataFrame], None] | None = None) -> DataFrame:
    """(t, y, x): the terminal union of layers (ord, op, t, y, x).

    Every stage is written to the shared folder before the next starts, so a lost executor costs one stage. ``stage`` is given
    each by name (union, void_fill, gaussian, keep_objects), without the protected foreground, which comes back after the last.
    """
    check_layers(layers)
    say = stage or (lambda name, mask: None)
    now = checkpointed(masks.compose(layers))
    say("union", now)
    if filters.voids is not None:
        now = checkpointed(now.unionByName(masks.voids(now, filters.voids, size)))
        say("void_fill", now)
    if filters.sigma is not None:
        now = checkpointed(geometry.smooth(now, filters.sigma, size, depth).select(*masks.AT))
        say("gaussian", now)
    if filters.keep is not None:
        now = checkpointed(masks.keep_largest(masks.components(now, filters.connectivity, size), filters.keep).select(*masks.AT))
        say("keep_objects", now)
    return now if protected is None else masks.union(now, protected)
