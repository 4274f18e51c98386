"""Integer grids, roundings and circular coordinates used by the geometry operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column) -> Column:
    return F.floor(x + 0.5)


def nearest_index(out: Column, n_out: Column, n_in: Column) -> Column:
    """Endpoint-aligned nearest source index of an output index; ties to even."""
    ratio = out * (n_in - 1) / F.greatest(n_out - 1, F.lit(1))
    return F.greatest(F.lit(0), F.least(n_in - 1, F.rint(ratio))).cast("bigint")


def containing_pixel(native: Column, processed: Column, n: Column) -> Column:
    """Index of the processing pixel that contains the centre of native pixel ``n``."""
    return F.least(processed - 1, F.floor((n + 0.5) * processed / native)).cast("bigint")


def quantize_confidence(x: Column) -> Column:
    return F.bround(x * 255).cast("int")


def confidence_threshold(x: Column) -> Column:
    """Least byte value that is at or above a confidence."""
    return F.greatest(F.lit(0), F.ceil(x * 255 - 1e-9)).cast("int")


def multiple_of_four(x: Column) -> Column:
    return (F.greatest(F.lit(4), F.floor(x / 4 + 0.5) * 4)).cast("bigint")


def cube_side(dim: Column, longest: Column) -> Column:
    """A dimension widened to at least 95 % of the longest axis."""
    return F.greatest(dim, F.ceil(longest * 0.95)).cast("bigint")


def background_limit(foreground: Column, share: Column) -> Column:
    """Most background rows beside so many foreground rows; null means no limit."""
    return F.when(share <= 0, F.lit(0)).when(share < 1, F.floor(share / (1 - share) * foreground)).cast("bigint")


def context_index(center: Column, offset: Column, n: Column) -> tuple[Column, Column]:
    """(index, mirrored) of a circular neighbour over half a turn: crossing the seam an odd number of times mirrors."""
    at = center + offset
    return F.pmod(at, n), F.pmod(F.floor(at / n), F.lit(2)) == 1


def clamped_index(center: Column, offset: Column, n: Column) -> Column:
    return F.greatest(F.lit(0), F.least(n - 1, center + offset))


def channel_offsets(width: int, stride: int) -> list[int]:
    """Offsets of a stack of an odd number of frames ``stride`` apart."""
    if width % 2 == 0 or width < 1 or stride < 1:
        raise ValueError("a stack needs an odd width and a positive stride")
    return [(k - width // 2) * stride for k in range(width)]
