"""Sparse slice store: one row a non-empty slice with its bounding box and the bits of the crop, rows padded to bytes."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "layer long, t long, y0 long, x0 long, y1 long, x1 long, foreground long, bits binary"


def pack(masks: DataFrame) -> DataFrame:
    """(layer, t, y, x) as packed slices; a group is one slice of one layer."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y, x = pdf["y"].to_numpy(), pdf["x"].to_numpy()
        y0, x0, y1, x1 = int(y.min()), int(x.min()), int(y.max()) + 1, int(x.max()) + 1
        crop = np.zeros((y1 - y0, x1 - x0), bool)
        crop[y - y0, x - x0] = True
        bits = np.packbits(crop, axis=1, bitorder="little").tobytes()
        return pd.DataFrame({"layer": [pdf["layer"].iloc[0]], "t": [pdf["t"].iloc[0]], "y0": [y0], "x0": [x0], "y1": [y1], "x1": [x1], "foreground": [int(crop.sum())], "bits": [bits]})

    return masks.select("layer", "t", "y", "x").groupBy("layer", "t").applyInPandas(run, SCHEMA)


def unpack(slices: DataFrame) -> DataFrame:
    """The voxels of packed slices; a slice whose count differs from its bits stops the query."""

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                h, w = r["y1"] - r["y0"], r["x1"] - r["x0"]
                crop = np.unpackbits(np.frombuffer(r["bits"], np.uint8).reshape(h, -1), axis=1, count=w, bitorder="little")
                y, x = np.nonzero(crop)
                if len(y) != r["foreground"]:
                    raise ValueError(f"slice {r['t']} of layer {r['layer']} doesn't have the foreground it states")
                out.append((np.full(len(y), r["layer"]), np.full(len(y), r["t"]), y + r["y0"], x + r["x0"]))
            if out:
                yield pa.record_batch([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], ["layer", "t", "y", "x"])

    return slices.mapInArrow(run, "layer long, t long, y long, x long")
