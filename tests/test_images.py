"""Image formats, the image tree as a data source, and what happens when a write fails."""

import json
import os
import struct
import zlib

import numpy as np
import pytest

from stratavox.sources import images


@pytest.mark.parametrize("channels", [1, 2, 3, 4])
@pytest.mark.parametrize("kind", ["png", "tif"])
def test_formats_round_trip(kind, channels):
    rng = np.random.default_rng(channels)
    for h, w in [(1, 1), (3, 7), (16, 5)]:
        px = rng.integers(0, 256, h * w * channels, dtype=np.uint8).tobytes()
        data = images.WRITE[kind](h, w, channels, px)
        assert images.READ[kind](data) == (h, w, channels, px)
        with pytest.raises((ValueError, zlib.error, struct.error, KeyError)):
            images.READ[kind](data[:-9] if kind == "png" else data[:12])


def test_png_filters_and_other_byte_order():
    rng = np.random.default_rng(0)
    h, w, step = 6, 5, 3
    px = rng.integers(0, 256, (h, w * step))
    lines = b""
    for y in range(h):
        kind = y % 5
        up = px[y - 1] if y else np.zeros(w * step, int)
        left = np.concatenate([np.zeros(step, int), px[y][:-step]])
        corner = np.concatenate([np.zeros(step, int), up[:-step]])
        p = left + up - corner
        near = np.where((abs(p - left) <= abs(p - up)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - up) <= abs(p - corner), up, corner))
        lines += bytes([kind]) + ((px[y] - [0, left, up, (left + up) // 2, near][kind]) % 256).astype(np.uint8).tobytes()
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    body = zlib.compress(lines)
    data = images.PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"tEXt", b"x") + chunk(b"IDAT", body[:9]) + chunk(b"IDAT", body[9:]) + chunk(b"IEND", b"")
    assert images.from_png(data) == (h, w, 3, px.astype(np.uint8).tobytes())
    strips = [b"abcd", b"ef"]
    tags = [(256, 3, 1, 2), (257, 3, 1, 3), (258, 3, 1, 8), (259, 3, 1, 1), (262, 3, 1, 1), (277, 3, 1, 1), (278, 3, 1, 2)]
    entries = b"".join(struct.pack(">HHIHH", t, k, n, v, 0) for t, k, n, v in tags) + struct.pack(">HHII", 273, 4, 2, 200) + struct.pack(">HHII", 279, 4, 2, 208)
    big = (b"MM\0*" + struct.pack(">I", 8) + struct.pack(">H", 9) + entries).ljust(200, b"\0") + struct.pack(">IIII", 216, 220, 4, 2) + b"".join(strips)
    assert images.from_tiff(big) == (3, 2, 1, b"abcdef")


def test_gray_of_colours():
    assert images.gray(1, 4, 3, bytes([255, 0, 0, 0, 255, 0, 0, 0, 255, 10, 10, 10])) == bytes([76, 150, 29, 10])
    assert images.gray(1, 2, 2, bytes([9, 1, 8, 2])) == bytes([9, 8])


def rows(n, channels=1):
    rng = np.random.default_rng(n)
    return [(f"v{k % 3}", k // 3, 4, 5, channels, rng.integers(0, 256, 20 * channels, dtype=np.uint8).tobytes()) for k in range(n)]


def put(spark, folder, data, mode="append", kind="png"):
    spark.createDataFrame(data, images.SCHEMA).repartition(3).write.format("image_tree").option("path", folder).option("kind", kind).mode(mode).save()


def got(spark, folder, **options):
    return sorted(map(tuple, spark.read.format("image_tree").options(path=folder, **options).load().collect()))


@pytest.mark.parametrize("kind", ["png", "tif"])
def test_tree_round_trip_and_verification(spark, tmp_path, kind, monkeypatch):
    images.register(spark)
    folder, data = f"file://{tmp_path}/tree", rows(20, 3)
    put(spark, folder, data[:12], kind=kind)
    put(spark, folder, data[12:], kind=kind)
    assert got(spark, folder) == sorted(data) and images.verify(spark, folder).collect() == []
    assert got(spark, folder, gray="true") == sorted((*r[:4], 1, images.gray(4, 5, 3, r[5])) for r in data)
    assert not os.path.exists(f"{tmp_path}/tree/_staging")
    one, two = f"{tmp_path}/tree/v0/v0_00000.{kind}", f"{tmp_path}/tree/v1/v1_00002.{kind}"
    blob = bytearray(open(one, "rb").read())
    blob[-20] ^= 1
    open(one, "wb").write(blob)
    os.remove(two)
    open(f"{tmp_path}/tree/v2/v2_00099.{kind}", "wb").write(b"x")
    assert {(r.path, r.fault) for r in images.verify(spark, folder).collect()} == {(f"v0/v0_00000.{kind}", "other bytes"), (f"v1/v1_00002.{kind}", "missing"), (f"v2/v2_00099.{kind}", "not in the manifest")}
    told = json.load(open(f"{tmp_path}/tree/manifest.json"))
    assert len(told["files"]) == 20
    assert [r.path for r in images.verify(spark, f"file://{tmp_path}/none").collect()] == ["manifest.json"]


def test_a_failed_write_publishes_nothing(spark, tmp_path):
    images.register(spark)
    folder, data = f"file://{tmp_path}/tree", rows(9)
    put(spark, folder, data[:3])
    with pytest.raises(Exception, match="other dimensions than samples"):
        put(spark, folder, [*data[3:], ("v9", 1, 4, 5, 1, b"short")])
    with pytest.raises(Exception, match="written twice"):
        put(spark, folder, data[2:6])
    assert got(spark, folder) == sorted(data[:3]) and images.verify(spark, folder).collect() == [] and not os.path.exists(f"{tmp_path}/tree/_staging")
    put(spark, folder, data[3:])
    assert got(spark, folder) == sorted(data)
    put(spark, f"file://{tmp_path}/empty", [])
    assert got(spark, f"file://{tmp_path}/empty") == []
