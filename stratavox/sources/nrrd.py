"""NRRD volumes of mask layers: one gzip-encoded file a layer, published by a manifest that is written last."""

from __future__ import annotations

import gzip
import hashlib
import json

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

_VOXELS = "layer long, t long, y long, x long"


def encode(volume: np.ndarray, name: str) -> bytes:
    """A (t, y, x) volume of bytes; NRRD lists the fastest axis first."""
    t, y, x = volume.shape
    head = f"NRRD0004\ntype: uint8\ndimension: 3\nsizes: {x} {y} {t}\nencoding: gzip\ncontent: {name}\n\n"
    return head.encode() + gzip.compress(np.ascontiguousarray(volume, np.uint8).tobytes(), 6, mtime=0)


def decode(raw: bytes) -> np.ndarray:
    head, _, body = raw.partition(b"\n\n")
    lines = head.decode().split("\n")
    if not lines[0].startswith("NRRD"):
        raise ValueError("not an NRRD file")
    fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line and not line.startswith("#"))
    if fields.get("type") not in ("uint8", "uchar", "unsigned char") or fields.get("dimension") != "3":
        raise ValueError("only three-dimensional volumes of bytes are read")
    x, y, t = map(int, fields["sizes"].split())
    data = {"gzip": gzip.decompress, "gz": gzip.decompress, "raw": bytes}[fields["encoding"]](body)
    return np.frombuffer(data, np.uint8, t * y * x).reshape(t, y, x)


def write(masks: DataFrame, folder: str, shape: tuple[int, int, int]) -> DataFrame:
    """Writes (layer, t, y, x) as one file a layer and then manifest.json; returns (layer, file, voxels, sha256).

    A group is a layer, which the file format needs as a whole; ``shape`` bounds it.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        layer = int(pdf["layer"].iloc[0])
        volume = np.zeros(shape, np.uint8)
        volume[pdf["t"], pdf["y"], pdf["x"]] = 1
        raw = encode(volume, f"layer {layer}")
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        name = f"layer-{layer:06d}.nrrd"
        draft = f"{root}/.{name}-{hashlib.sha256(raw).hexdigest()[:12]}"
        with fs.open_output_stream(draft) as out:
            out.write(raw)
        fs.move(draft, f"{root}/{name}")
        return pd.DataFrame({"layer": [layer], "file": [name], "voxels": [int(volume.sum())], "sha256": [hashlib.sha256(raw).hexdigest()]})

    spark = masks.sparkSession
    done = masks.select("layer", "t", "y", "x").groupBy("layer").applyInPandas(run, "layer long, file string, voxels long, sha256 string")
    entries = sorted((r.asDict() for r in done.collect()), key=lambda r: r["layer"])  # one row a layer
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/.manifest") as out:
        out.write(json.dumps({"shape": list(shape), "layers": entries}, sort_keys=True, separators=(",", ":")).encode())
    fs.move(f"{root}/.manifest", f"{root}/manifest.json")
    return spark.createDataFrame(entries or [], "layer long, file string, voxels long, sha256 string")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Foreground voxels (layer, t, y, x) of all layers in the manifest; a file that differs from it stops the query."""
    fs, root = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{root}/manifest.json") as f:
        entries = json.loads(f.read())["layers"]

    def run(batches):
        store, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for layer, name, digest in zip(*(batch.column(c).to_pylist() for c in ("layer", "file", "sha256"))):
                with store.open_input_file(f"{base}/{name}") as f:
                    raw = f.read()
                if hashlib.sha256(raw).hexdigest() != digest:
                    raise ValueError(f"{name} is not the file of the manifest")
                t, y, x = np.nonzero(decode(raw))
                yield pa.record_batch([pa.array(np.full(len(t), layer)), pa.array(t), pa.array(y), pa.array(x)], ["layer", "t", "y", "x"])

    files = spark.createDataFrame([(e["layer"], e["file"], e["sha256"]) for e in entries], "layer long, file string, sha256 string")
    return files.repartition(max(1, len(entries)), "layer").mapInArrow(run, _VOXELS)
