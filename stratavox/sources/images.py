"""Trees of gray or colour images as a Spark data source: partitioned reads, writes in two phases, and a check of what was published.

An image is a row (volume, frame, height, width, channels, pixels): eight bits a sample, row by row, channels interleaved. Files
are ``<volume>/<volume>_<frame, five digits>.png`` or ``.tif``. Tasks write below ``_staging`` under names of their own attempt;
only when all have finished does the driver move their files into place, and last of all write the manifest, which lists every
file with its size, dimensions and SHA-256. A job that fails leaves no manifest and takes its staging away. What is not in the
manifest is not part of the tree, and ``verify`` says so.

    images.register(spark)
    rows.write.format("image_tree").option("path", folder).option("kind", "png").mode("append").save()
    spark.read.format("image_tree").option("path", folder).load()
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "volume string, frame long, height int, width int, channels int, pixels binary"
MANIFEST, STAGING = "manifest.json", "_staging"
PNG = b"\x89PNG\r\n\x1a\n"
#: PNG colour types by channels, and shares of red, green and blue in a gray value, of 2^14.
COLOUR = {1: 0, 2: 4, 3: 2, 4: 6}
GRAY = (4899, 9617, 1868)
#: Files of a partition.
FILES = 64


# --- formats


def png(height: int, width: int, channels: int, pixels: bytes) -> bytes:
    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = np.frombuffer(pixels, np.uint8).reshape(height, width * channels)
    raw = np.concatenate([np.zeros((height, 1), np.uint8), rows], axis=1).tobytes()  # no row is filtered
    head = struct.pack(">IIBBBBB", width, height, 8, COLOUR[channels], 0, 0, 0)
    return PNG + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def _unfiltered(raw: bytes, height: int, stride: int, step: int) -> bytes:
    """Rows of a PNG with their filters undone."""
    out = np.zeros((height + 1, stride + step), np.int64)  # a row above and a pixel before, of zeros
    lines = np.frombuffer(raw, np.uint8).reshape(height, stride + 1)
    for y in range(height):
        kind, line, up = int(lines[y, 0]), lines[y, 1:].astype(np.int64), out[y]
        now = out[y + 1]
        if kind == 0:
            now[step:] = line
        elif kind == 2:
            now[step:] = (line + up[step:]) & 255
        elif kind in (1, 3, 4):
            for x in range(stride):
                a, b, c = int(now[x]), int(up[x + step]), int(up[x])
                if kind == 4:
                    p = a + b - c
                    near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                now[x + step] = (int(line[x]) + (a if kind == 1 else (a + b) // 2 if kind == 3 else near)) & 255
        else:
            raise ValueError(f"PNG filter {kind} is not known")
    return out[1:, step:].astype(np.uint8).tobytes()


def from_png(data: bytes) -> tuple[int, int, int, bytes]:
    """(height, width, channels, pixels) of a PNG of eight bits without interlacing."""
    if not data.startswith(PNG):
        raise ValueError("no PNG")
    at, head, body = len(PNG), None, b""
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        part, crc = data[at + 8 : at + 8 + n], data[at + 8 + n : at + 12 + n]
        if len(crc) < 4 or struct.unpack(">I", crc)[0] != zlib.crc32(kind + part):
            raise ValueError(f"chunk {kind!r} of a PNG is damaged")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body += part
        at += 12 + n
    width, height, depth, colour, _, _, interlaced = head or (0, 0, 0, 0, 0, 0, 1)
    channels = {v: k for k, v in COLOUR.items()}.get(colour)
    if depth != 8 or channels is None or interlaced:
        raise ValueError("only PNGs of eight bits a sample without palette and interlacing are read")
    return height, width, channels, _unfiltered(zlib.decompress(body), height, width * channels, channels)


def tiff(height: int, width: int, channels: int, pixels: bytes) -> bytes:
    """A little-endian baseline TIFF of one deflated strip."""
    body = zlib.compress(pixels, 6)
    tags = [(256, 4, [width]), (257, 4, [height]), (258, 3, [8] * channels), (259, 3, [8]), (262, 3, [2 if channels >= 3 else 1]), (273, 4, [8]), (277, 3, [channels]), (278, 4, [height]), (279, 4, [len(body)]), (284, 3, [1])]
    if channels not in (1, 3):
        tags.append((338, 3, [0] * (channels - (3 if channels > 3 else 1))))
    start = 8 + len(body) + len(body) % 2
    more, entries, at = b"", b"", start + 2 + 12 * len(tags) + 4
    for tag, kind, values in tags:
        packed = struct.pack(f"<{len(values)}{'H' if kind == 3 else 'I'}", *values)
        if len(packed) > 4:
            entries += struct.pack("<HHII", tag, kind, len(values), at + len(more))
            more += packed
        else:
            entries += struct.pack("<HHI", tag, kind, len(values)) + packed.ljust(4, b"\0")
    return b"II*\0" + struct.pack("<I", start) + body + b"\0" * (len(body) % 2) + struct.pack("<H", len(tags)) + entries + b"\0\0\0\0" + more


def from_tiff(data: bytes) -> tuple[int, int, int, bytes]:
    """(height, width, channels, pixels) of a TIFF of eight bits a sample, interleaved, stored plain or deflated."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
    if order is None:
        raise ValueError("no TIFF")
    at = struct.unpack(f"{order}I", data[4:8])[0]
    tags = {}
    for k in range(struct.unpack(f"{order}H", data[at : at + 2])[0]):
        e = at + 2 + 12 * k
        tag, kind, n = struct.unpack(f"{order}HHI", data[e : e + 8])
        size, code = {1: (1, "B"), 3: (2, "H"), 4: (4, "I")}.get(kind, (0, ""))
        if size:
            where = e + 8 if size * n <= 4 else struct.unpack(f"{order}I", data[e + 8 : e + 12])[0]
            tags[tag] = struct.unpack(f"{order}{n}{code}", data[where : where + size * n])
    height, width, channels = tags[257][0], tags[256][0], tags.get(277, (1,))[0]
    if set(tags.get(258, (1,))) != {8} or tags.get(284, (1,))[0] != 1 or tags.get(259, (1,))[0] not in (1, 8, 32946):
        raise ValueError("only TIFFs of eight bits a sample, interleaved, plain or deflated are read")
    strips = (data[a : a + n] for a, n in zip(tags[273], tags[279]))
    pixels = b"".join(strips if tags.get(259, (1,))[0] == 1 else map(zlib.decompress, strips))
    if len(pixels) != height * width * channels:
        raise ValueError("a TIFF has fewer samples than it says")
    return height, width, channels, pixels


WRITE = {"png": png, "tif": tiff}
READ = {"png": from_png, "tif": from_tiff, "tiff": from_tiff}


def gray(height: int, width: int, channels: int, pixels: bytes) -> bytes:
    """Gray values of an image: the first channel of one or two, else the weighted colours, rounded."""
    a = np.frombuffer(pixels, np.uint8).reshape(height * width, channels).astype(np.int64)
    return (a[:, 0] if channels < 3 else (a[:, :3] @ np.array(GRAY) + (1 << 13)) >> 14).astype(np.uint8).tobytes()


# --- the data source

_NAME = re.compile(r"(?P<volume>.+)_(?P<frame>\d+)\.(?P<kind>png|tiff?)$", re.I)


def _listed(folder: str) -> list[str]:
    """Relative paths of the images below a folder, staging left out."""
    fs, root = pafs.FileSystem.from_uri(folder)
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    paths = [f.path[len(root) :].lstrip("/") for f in found if f.type == pafs.FileType.File]
    return sorted(p for p in paths if _NAME.search(p.rsplit("/", 1)[-1]) and not p.startswith(STAGING))


def manifest(folder: str) -> list[dict] | None:
    """The files of a published tree, or None."""
    fs, root = pafs.FileSystem.from_uri(folder)
    if fs.get_file_info(f"{root}/{MANIFEST}").type != pafs.FileType.File:
        return None
    with fs.open_input_stream(f"{root}/{MANIFEST}") as source:
        return json.loads(source.read())["files"]


@dataclass
class Files(InputPartition):
    names: list[str]


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.gray = options["path"], options.get("gray", "false").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        """Files of the manifest, or of the folder where there is none, a few to a partition."""
        told = manifest(self.folder)
        names = sorted(f["path"] for f in told) if told is not None else _listed(self.folder)
        return [Files(names[k : k + FILES]) for k in range(0, len(names), FILES)] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        fs, root = pafs.FileSystem.from_uri(self.folder)
        for name in partition.names:
            m = _NAME.search(name.rsplit("/", 1)[-1])
            with fs.open_input_stream(f"{root}/{name}") as source:
                height, width, channels, pixels = READ[m["kind"].lower()](source.read())
            if self.gray and channels != 1:
                channels, pixels = 1, gray(height, width, channels, pixels)
            yield m["volume"], int(m["frame"]), height, width, channels, pixels


@dataclass
class Written(WriterCommitMessage):
    staged: str
    files: list[dict]


class Writer(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.folder, self.kind, self.overwrite = options["path"], options.get("kind", "png"), overwrite
        if self.kind not in WRITE:
            raise ValueError(f"images are written as one of {', '.join(WRITE)}")

    def write(self, rows: Iterator) -> Written:
        fs, root = pafs.FileSystem.from_uri(self.folder)
        task = TaskContext.get()
        staged = f"{STAGING}/{task.partitionId()}-{task.taskAttemptId()}"
        files = []
        for row in rows:
            if len(row.pixels) != row.height * row.width * row.channels:
                raise ValueError(f"frame {row.frame} of {row.volume} has other dimensions than samples")
            data = WRITE[self.kind](row.height, row.width, row.channels, bytes(row.pixels))
            path = f"{row.volume}/{row.volume}_{row.frame:05d}.{self.kind}"
            fs.create_dir(f"{root}/{staged}/{row.volume}", recursive=True)
            with fs.open_output_stream(f"{root}/{staged}/{path}", compression=None) as out:
                out.write(data)
            files.append({"path": path, "bytes": len(data), "sha256": hashlib.sha256(data).hexdigest(), "height": row.height, "width": row.width, "channels": row.channels})
        return Written(staged, files)

    def commit(self, messages: list[Written | None]) -> None:
        """Moves the files of all tasks into place, then writes the manifest; no row of an image passes here."""
        fs, root = pafs.FileSystem.from_uri(self.folder)
        before = [] if self.overwrite else manifest(self.folder) or []
        known = {f["path"] for f in before}
        for f in (f for m in messages if m is not None for f in m.files):
            if f["path"] in known:
                self.abort(messages)
                raise ValueError(f"{f['path']} is written twice")
            known.add(f["path"])
        new = [f for m in messages if m is not None for f in m.files]
        for m in (m for m in messages if m is not None):
            for f in m.files:
                fs.create_dir(f"{root}/{f['path'].rsplit('/', 1)[0]}", recursive=True)
                fs.move(f"{root}/{m.staged}/{f['path']}", f"{root}/{f['path']}")
        body = json.dumps({"files": sorted([*before, *new], key=lambda f: f["path"])}).encode()
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{MANIFEST}", compression=None) as out:
            out.write(body)
        self._clear(fs, root)

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.folder)
        self._clear(fs, root)

    @staticmethod
    def _clear(fs, root: str) -> None:
        if fs.get_file_info(f"{root}/{STAGING}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{STAGING}")


class ImageTree(DataSource):
    @classmethod
    def name(cls) -> str:
        return "image_tree"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ImageTree)


def verify(spark: SparkSession, folder: str) -> DataFrame:
    """(path, fault) of every file that is missing, not of the manifest, or not what the manifest says; no rows for a sound tree.

    The lists are compared by a join and the files are read by tasks.
    """
    told = manifest(folder)
    if told is None:
        return spark.createDataFrame([(MANIFEST, "missing")], "path string, fault string")
    schema = "path string, bytes long, sha256 string, height int, width int, channels int"
    listed = spark.createDataFrame(told, schema) if told else spark.createDataFrame([], schema)
    there = spark.createDataFrame([(p,) for p in _listed(folder)], "there string")
    both = listed.join(there, F.col("path") == F.col("there"), "full_outer")
    lost = both.where("there IS NULL").select("path", F.lit("missing").alias("fault"))
    extra = both.where("path IS NULL").select(F.col("there").alias("path"), F.lit("not in the manifest").alias("fault"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for pdf in batches:
            faults = []
            for r in pdf.itertuples():
                with fs.open_input_stream(f"{root}/{r.path}") as source:
                    data = source.read()
                fault = None
                if len(data) != r.bytes or hashlib.sha256(data).hexdigest() != r.sha256:
                    fault = "other bytes"
                else:
                    try:
                        if READ[r.path.rsplit(".", 1)[-1].lower()](data)[:3] != (r.height, r.width, r.channels):
                            fault = "other dimensions"
                    except (ValueError, KeyError, zlib.error, struct.error) as e:
                        fault = str(e)
                faults.append(fault)
            yield pd.DataFrame({"path": pdf["path"], "fault": faults})

    read = both.where("path IS NOT NULL AND there IS NOT NULL").select(*listed.columns).mapInPandas(run, "path string, fault string").where("fault IS NOT NULL")
    return lost.unionByName(extra).unionByName(read)
