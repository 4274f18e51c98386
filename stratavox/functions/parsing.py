"""Text parameters as columns: lists, ranges, angles, channel formats and sort keys; and tags from digests."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Alphabet and length of tags.
TAG_ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
TAG_LENGTH = 16


def tokens(text: Column) -> Column:
    """Items between commas and blanks, in order, each once."""
    return F.array_distinct(F.filter(F.split(text, r"[,\s]+"), lambda s: s != ""))


def angles(text: Column) -> Column:
    """Angles in [0, 360), in the order asked for, each once."""
    return F.array_distinct(F.transform(F.filter(F.split(text, r"[,\s]+"), lambda s: s != ""), lambda s: F.pmod(s.cast("double"), F.lit(360.0))))


def index_ranges(text: Column) -> Column:
    """Indices of a list like ``0-3,8``, ascending, each once."""
    part = lambda s: F.sequence(F.element_at(F.split(s, "-"), 1).cast("int"), F.element_at(F.split(s, "-"), -1).cast("int"))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(F.split(text, r"[,\s]+"), lambda s: s != ""), part))))


def channel_format(text: Column) -> Column:
    """Frame offsets of ``gray``, ``RGB`` or ``C<odd>S<stride>``; null for anything else."""
    low = F.lower(F.trim(text))
    width = F.regexp_extract(low, r"^c(\d+)s(\d+)$", 1).try_cast("int")
    stride = F.regexp_extract(low, r"^c(\d+)s(\d+)$", 2).try_cast("int")
    half = F.floor(width / 2).cast("int")
    stack = F.transform(F.sequence(-half, half), lambda k: k * stride)
    return F.when(low == "gray", F.array(F.lit(0))).when(low == "rgb", F.array(F.lit(-1), F.lit(0), F.lit(1))).when((width % 2 == 1) & (stride >= 1), stack)


def natural_key(text: Column) -> Column:
    """A text that sorts by its numbers: every run of digits padded to twenty."""
    parts = F.regexp_extract_all(text, F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d+$"), F.lpad(p, 20, "0")).otherwise(F.lower(p))), "")


@F.pandas_udf(StringType())
def base62(digest: pd.Series) -> pd.Series:
    """The last digits of a hex number in base 62."""

    def tag(h: str) -> str:
        value, out = int(h, 16), []
        for _ in range(TAG_LENGTH):
            value, rest = divmod(value, len(TAG_ALPHABET))
            out.append(TAG_ALPHABET[rest])
        return "".join(reversed(out))

    return digest.map(tag, na_action="ignore")
