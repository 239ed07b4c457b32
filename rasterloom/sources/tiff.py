"""GeoTIFF scenes: a reader of windows and of metadata from binary files, and a writer, without other libraries.

Files come through Spark's binaryFile reader, so they may be in any store that Spark reads. Strips and tiles,
uncompressed or deflate, with or without the horizontal predictor, chunky or planar, 8 to 64 bits, are understood.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of TIFF 6.0 and GeoTIFF 1.1.
_KINDS = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d"}
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, STRIP_ROWS, STRIP_SIZES, PLANAR, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_SIZES, FORMAT = 322, 323, 324, 325, 339
PIXEL_SCALE, TIE_POINT, AFFINE, GEO_KEYS, METADATA = 33550, 33922, 34264, 34735, 42112
PROJECTED, GEOGRAPHIC = 3072, 2048
SCENE = (
    "scene_id string, path string, crs_epsg int, width int, height int, band_count int, dtype string, "
    "transform struct<a:double,b:double,c:double,d:double,e:double,f:double>, tags map<string,string>"
)


class Tiff:
    """The first image of a TIFF's bytes."""

    def __init__(self, data: bytes):
        self.data, self.order = data, {b"II": "<", b"MM": ">"}.get(data[:2], "")
        if not self.order or struct.unpack(f"{self.order}H", data[2:4])[0] != 42:
            raise ValueError("not a TIFF file")
        at = struct.unpack(f"{self.order}I", data[4:8])[0]
        count = struct.unpack(f"{self.order}H", data[at : at + 2])[0]
        self.tags: dict[int, tuple] = {}
        for k in range(count):
            self._read_tag(at + 2 + 12 * k)
        self.width, self.height = self.tags[WIDTH][0], self.tags[HEIGHT][0]
        self.bands, self.planar = self.tags.get(SAMPLES, (1,))[0], self.tags.get(PLANAR, (1,))[0] == 2
        letter = {1: "u", 2: "i", 3: "f"}[self.tags.get(FORMAT, (1,))[0]]
        self.dtype = np.dtype(f"{self.order}{letter}{self.tags.get(BITS, (8,))[0] // 8}")

    def _read_tag(self, at: int) -> None:
        tag, kind, n = struct.unpack(f"{self.order}HHI", self.data[at : at + 8])
        if kind not in _KINDS:
            return
        shape = f"{self.order}{n}s" if kind == 2 else f"{self.order}{_KINDS[kind] * n}"
        size, where = struct.calcsize(shape), at + 8
        if size > 4:
            where = struct.unpack(f"{self.order}I", self.data[where : where + 4])[0]
        self.tags[tag] = struct.unpack(shape, self.data[where : where + size])

    @property
    def transform(self) -> tuple[float, ...]:
        if AFFINE in self.tags:
            m = self.tags[AFFINE]
            return m[0], m[1], m[3], m[4], m[5], m[7]
        if PIXEL_SCALE in self.tags:
            (sx, sy, *_), (i, j, _, x, y, *_) = self.tags[PIXEL_SCALE], self.tags[TIE_POINT]
            return sx, 0.0, x - i * sx, 0.0, -sy, y + j * sy
        return 1.0, 0.0, 0.0, 0.0, 1.0, 0.0

    @property
    def epsg(self) -> int | None:
        keys = self.tags.get(GEO_KEYS, ())
        found = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4)}
        return found.get(PROJECTED, found.get(GEOGRAPHIC))

    @property
    def items(self) -> dict[str, str]:
        """The named text items of the metadata tag."""
        text = self.tags.get(METADATA, (b"",))[0].rstrip(b"\0").decode()
        plain = lambda x: x.replace("&lt;", "<").replace("&gt;", ">").replace("&quot;", '"').replace("&amp;", "&")
        return {plain(k): plain(v) for k, v in re.findall(r'<Item name="([^"]*)"[^>]*>([^<]*)</Item>', text)}

    def read(self, x: int = 0, y: int = 0, width: int | None = None, height: int | None = None) -> np.ndarray:
        """(bands, height, width) of a window; only the blocks that it meets are unpacked."""
        width, height = width or self.width - x, height or self.height - y
        tiled = TILES in self.tags
        bw, bh = (self.tags[TILE_WIDTH][0], self.tags[TILE_HEIGHT][0]) if tiled else (self.width, min(self.tags.get(STRIP_ROWS, (self.height,))[0], self.height))
        places, sizes = (self.tags[TILES], self.tags[TILE_SIZES]) if tiled else (self.tags[STRIPS], self.tags[STRIP_SIZES])
        across, down = -(-self.width // bw), -(-self.height // bh)
        out = np.zeros((self.bands, height, width), self.dtype.newbyteorder("="))
        for plane in range(self.bands if self.planar else 1):
            for by in range(y // bh, -(-(y + height) // bh)):
                for bx in range(x // bw, -(-(x + width) // bw)):
                    k = (plane * down + by) * across + bx
                    block = self._block(self.data[places[k] : places[k] + sizes[k]], bw, bh if tiled else min(bh, self.height - by * bh))
                    x0, y0 = max(x, bx * bw), max(y, by * bh)
                    x1, y1 = min(x + width, bx * bw + bw), min(y + height, by * bh + block.shape[0])
                    part = block[y0 - by * bh : y1 - by * bh, x0 - bx * bw : x1 - bx * bw]
                    to = slice(plane, plane + 1) if self.planar else slice(None)
                    out[to, y0 - y : y1 - y, x0 - x : x1 - x] = part.transpose(2, 0, 1)
        return out

    def _block(self, raw: bytes, width: int, height: int) -> np.ndarray:
        kind = self.tags.get(COMPRESSION, (1,))[0]
        if kind in (8, 32946):
            raw = zlib.decompress(raw)
        elif kind != 1:
            raise ValueError(f"compression {kind} isn't supported")
        each = 1 if self.planar else self.bands
        block = np.frombuffer(raw, self.dtype, width * height * each).reshape(height, width, each)
        predictor = self.tags.get(PREDICTOR, (1,))[0]
        if predictor == 2:
            return np.cumsum(block, axis=1, dtype=block.dtype.newbyteorder("="))
        if predictor != 1:
            raise ValueError(f"predictor {predictor} isn't supported")
        return block


def encode(image: np.ndarray, transform: tuple[float, ...], epsg: int | None = None, items: dict[str, str] | None = None) -> bytes:
    """A deflate GeoTIFF, little-endian, of one strip for each 64 rows, of an image (bands, height, width)."""
    bands, height, width = image.shape
    kind = image.dtype.newbyteorder("<")
    rows = np.ascontiguousarray(image.transpose(1, 2, 0)).astype(kind)
    strips = [zlib.compress(rows[y : y + 64].tobytes()) for y in range(0, height, 64)]
    a, b, c, d, e, f = transform
    fields: list[tuple[int, int, tuple | bytes]] = [
        (WIDTH, 4, (width,)), (HEIGHT, 4, (height,)), (BITS, 3, (kind.itemsize * 8,) * bands), (COMPRESSION, 3, (8,)), (262, 3, (1,)),
        (STRIPS, 4, tuple(np.cumsum([8, *map(len, strips)])[:-1].tolist())), (SAMPLES, 3, (bands,)), (STRIP_ROWS, 4, (64,)),
        (STRIP_SIZES, 4, tuple(map(len, strips))), (PLANAR, 3, (1,)), (FORMAT, 3, ({"u": 1, "i": 2, "f": 3}[kind.kind],) * bands),
        (AFFINE, 12, (a, b, 0.0, c, d, e, 0.0, f, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)),
    ]
    if epsg:
        model, key = (2, GEOGRAPHIC) if epsg == 4326 else (1, PROJECTED)
        fields.append((GEO_KEYS, 3, (1, 1, 0, 3, 1024, 0, 1, model, 1025, 0, 1, 1, key, 0, 1, epsg)))
    if items:
        safe = lambda x: x.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")
        text = "".join(f'<Item name="{safe(k)}">{safe(v)}</Item>' for k, v in items.items())
        fields.append((METADATA, 2, f"<GDALMetadata>{text}</GDALMetadata>".encode() + b"\0"))
    body = b"".join(strips)
    start = 8 + len(body) + len(body) % 2
    extra_at, entries, extra = start + 2 + 12 * len(fields) + 4, b"", b""
    for tag, t, value in sorted(fields, key=lambda x: x[0]):
        packed = value if isinstance(value, bytes) else struct.pack(f"<{_KINDS[t] * len(value)}", *value)
        entry = struct.pack("<HHI", tag, t, len(value))
        if len(packed) <= 4:
            entries += entry + packed.ljust(4, b"\0")
        else:
            entries += entry + struct.pack("<I", extra_at + len(extra))
            extra += packed + b"\0" * (len(packed) % 2)
    return b"II*\0" + struct.pack("<I", start) + body + b"\0" * (len(body) % 2) + struct.pack("<H", len(fields)) + entries + b"\0" * 4 + extra


def _files(spark: SparkSession, folder: str, patterns: tuple[str, ...]) -> DataFrame:
    found = [spark.read.format("binaryFile").option("pathGlobFilter", p).load(folder) for p in patterns]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("path", "content")


def scene_facts(files: DataFrame) -> DataFrame:
    """The metadata of images in files(path, content), no pixels unpacked."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                t = Tiff(bytes(content))
                stem = re.sub(r"\.[^.]*$", "", path.rsplit("/", 1)[-1])
                rows.append((stem, path, t.epsg, t.width, t.height, t.bands, t.dtype.newbyteorder("=").name, dict(zip("abcdef", t.transform, strict=True)), t.items))
            yield pd.DataFrame(rows, columns=["scene_id", "path", "crs_epsg", "width", "height", "band_count", "dtype", "transform", "tags"]).astype({"crs_epsg": "Int32"})

    return files.select("path", "content").mapInPandas(of, SCENE)


def scan_scenes(spark: SparkSession, folder: str, patterns: tuple[str, ...] = ("*.tif", "*.tiff")) -> DataFrame:
    """The metadata of every image of a folder."""
    return scene_facts(_files(spark, folder, patterns))


def cut_windows(files: DataFrame, windows: DataFrame, bands: list[int] | None = None, group: int = 64) -> DataFrame:
    """tile_id, scene_id, height, width and bands of windows(scene_id, tile_idx, col_off, row_off, win_width, win_height)
    of the images in files(path, content); ``bands`` are counted from 1.

    A file's windows are numbered row by row and listed ``group`` at a time, so a task unpacks only the blocks of one
    group and gives its tiles on before the next. Files themselves don't move: the lists are small and go to them.
    A row of Spark's binary reader holds a whole file, 2 GB at most; larger scenes come as several files.
    """
    struct_of = F.struct("tile_idx", "col_off", "row_off", "win_width", "win_height")
    wanted = windows.groupBy("scene_id").agg(F.sort_array(F.collect_list(F.struct("row_off", struct_of.alias("w")))).alias("wins"))
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    listed = wanted.select(F.col("scene_id").alias("_of"), F.transform("wins", lambda x: x["w"]).alias("wins"))
    joined = files.select("path", "content").withColumn("scene_id", stem).join(listed, F.col("scene_id") == F.col("_of"))

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for scene, content, wins in zip(batch["scene_id"], batch["content"], batch["wins"], strict=True):
                t = Tiff(bytes(content))
                for at in range(0, len(wins), group):
                    rows = []
                    for w in wins[at : at + group]:
                        image = t.read(w["col_off"], w["row_off"], w["win_width"], w["win_height"]).astype(np.float32)
                        chosen = image if bands is None else image[[b - 1 for b in bands]]
                        rows.append((f"{scene}_tile_{w['tile_idx']:06d}", scene, w["win_height"], w["win_width"], [b.ravel() for b in chosen]))
                    yield pd.DataFrame(rows, columns=["tile_id", "scene_id", "height", "width", "bands"])

    return joined.select("scene_id", "content", "wins").mapInPandas(of, "tile_id string, scene_id string, height int, width int, bands array<array<float>>")


def read_windows(spark: SparkSession, folder: str, windows: DataFrame, bands: list[int] | None = None) -> DataFrame:
    """Windows of a folder's images, as cut_windows gives them."""
    return cut_windows(_files(spark, folder, ("*.tif", "*.tiff")), windows, bands)
