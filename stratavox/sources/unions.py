"""Content-addressed store of binary masks: append-only chunks of up to thirty frames, an index of their frames, verified scans.

A chunk is a file named by the SHA-256 of its bytes, which are the packed crops of its non-empty frames one after the other.
Tasks write chunks; that a task is tried again changes nothing, since equal bytes have one name. An append is told by a name
of its caller and takes effect when its part of the index is finished; the same append again adds nothing. Frames that an
artifact already has cannot be appended again. A scan reads only chunks whose frames are asked for, and stops at one whose
bytes, sizes or counts are not those of the index.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.session import checkpointed

#: Frames of a chunk at most.
CHUNK = 30
INDEX = "artifact string, chunk long, frame long, sha256 string, total long, offset long, length long, top long, left long, height long, width long, foreground long"


def _there(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _writer(folder: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fs, root = pafs.FileSystem.from_uri(folder)
        rows, data = [], b""
        for frame, own in pdf.sort_values("frame").groupby("frame"):
            y, x = own["y"].to_numpy(), own["x"].to_numpy()
            top, left, height, width = int(y.min()), int(x.min()), int(y.max() - y.min()) + 1, int(x.max() - x.min()) + 1
            crop = np.zeros((height, width), bool)
            crop[y - top, x - left] = True
            bits = np.packbits(crop, axis=1, bitorder="little").tobytes()
            rows.append([int(frame), len(data), len(bits), top, left, height, width, int(crop.sum())])
            data += bits
        digest = hashlib.sha256(data).hexdigest()
        fs.create_dir(f"{root}/chunks/{digest[:2]}", recursive=True)
        with fs.open_output_stream(f"{root}/chunks/{digest[:2]}/{digest}", compression=None) as out:
            out.write(data)
        first = pdf.iloc[0]
        return pd.DataFrame([[first["artifact"], first["chunk"], r[0], digest, len(data), *r[1:]] for r in rows], columns=[c.split()[0] for c in INDEX.split(", ")])

    return run


def append(masks: DataFrame, folder: str, name: str) -> bool:
    """Appends (artifact, frame, y, x) as the append ``name``; False if that was done before."""
    spark = masks.sparkSession
    place = f"{folder}/index/append={name}"
    if _there(spark, f"{place}/_SUCCESS"):
        return False
    rows = masks.select(F.col("artifact").cast("string").alias("artifact"), *(F.col(c).cast("bigint").alias(c) for c in ("frame", "y", "x"))).distinct()
    rows = rows.withColumn("chunk", F.floor(F.col("frame") / CHUNK))
    index = checkpointed(rows.groupBy("artifact", "chunk").applyInPandas(_writer(folder), INDEX))
    old = frames(spark, folder)
    if old is not None:
        twice = index.join(old.select("artifact", "frame"), ["artifact", "frame"], "left_semi").limit(1).collect()
        if twice:
            raise ValueError(f"artifact {twice[0].artifact} has frame {twice[0].frame} already")
    index.write.mode("overwrite").parquet(place)
    return True


def frames(spark: SparkSession, folder: str) -> DataFrame | None:
    """The index of all finished appends, one row a non-empty frame; None if there is none."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/index")
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return None
    done = [f"{folder}/index/{s.getPath().getName()}" for s in fs.listStatus(where) if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return spark.read.schema(INDEX).parquet(*done) if done else None


def _decoder(folder: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fs, root = pafs.FileSystem.from_uri(folder)
        digest = pdf["sha256"].iloc[0]
        with fs.open_input_stream(f"{root}/chunks/{digest[:2]}/{digest}", compression=None) as source:
            data = source.read()
        if len(data) != pdf["total"].iloc[0] or hashlib.sha256(data).hexdigest() != digest:
            raise ValueError(f"chunk {digest} is not what its name says")
        out = []
        for r in pdf.itertuples():
            bits = np.frombuffer(data, np.uint8, r.length, r.offset)
            stride = (r.width + 7) // 8
            if r.length != r.height * stride:
                raise ValueError(f"frame {r.frame} of {r.artifact} has other dimensions than bytes")
            y, x = np.nonzero(np.unpackbits(bits.reshape(r.height, stride), axis=1, count=r.width, bitorder="little"))
            if len(y) != r.foreground:
                raise ValueError(f"frame {r.frame} of {r.artifact} doesn't have the foreground it states")
            out.append(pd.DataFrame({"artifact": r.artifact, "frame": r.frame, "y": y + r.top, "x": x + r.left}))
        return pd.concat(out)

    return run


def scan(spark: SparkSession, folder: str, artifact: str | None = None, start: int | None = None, stop: int | None = None) -> DataFrame:
    """(artifact, frame, y, x) of an artifact (of all) in the frames [start, stop); other chunks are not opened."""
    index = frames(spark, folder)
    if index is None:
        return spark.createDataFrame([], "artifact string, frame long, y long, x long")
    if artifact is not None:
        index = index.where(F.col("artifact") == artifact)
    if start is not None:
        index = index.where(F.col("frame") >= start)
    if stop is not None:
        index = index.where(F.col("frame") < stop)
    return index.groupBy("artifact", "sha256").applyInPandas(_decoder(folder), "artifact string, frame long, y long, x long")
