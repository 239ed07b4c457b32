"""GeoTIFF as a Spark data source: windows of images by byte ranges, and images written in two phases.

    geotiff.register(spark)
    spark.read.format("geotiff").option("tileSize", 512).option("overlap", 64).option("bands", "3,1").load(folder)
    images.write.format("geotiff").mode("append").save(folder)

A read plans from names and sizes alone. A file is cut into parts of about ``partitionBytes``, each a range of its
windows; a task reads the header, then the strips or tiles that its windows meet, one row of windows at a time. Filters on
scene_id, places and bounds, and the bands asked for, are settled before pixels are read. So no task holds a file, and a
file may have any size. Files are opened by Arrow's file systems, so a folder is any that they and every executor open.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
    WriterCommitMessage,
)

from rasterloom.sources import tiff
from rasterloom.sources.tiff import Tiff

PAGE = 1 << 16
PLACE = "struct<a:double,b:double,c:double,d:double,e:double,f:double>"
SCHEMA = (
    "scene_id string, path string, tile_idx int, col_off int, row_off int, win_width int, win_height int, west double, south double, "
    f"east double, north double, crs_epsg int, transform {PLACE}, height int, width int, bands array<array<float>>"
)
WRITTEN = f"name string, height int, width int, bands array<array<double>>, transform {PLACE}, crs_epsg int, tags map<string,string>"
_NUMBERS = ("tile_idx", "col_off", "row_off", "win_width", "win_height", "west", "south", "east", "north")
_TESTS = {
    GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b,
    EqualTo: lambda a, b: a == b,
}
SUBFILE, REDUCED = 254, 1


# --- images by byte ranges ---


class Ranges:
    """A file's bytes as slices; small ones come from pages that are kept, large ones straight. Counts what it reads."""

    def __init__(self, file, size: int, pages: int = 64):
        self.file, self.size, self.most, self.read_bytes = file, size, pages, 0
        self.pages: OrderedDict[int, bytes] = OrderedDict()

    def _fetch(self, at: int, n: int) -> bytes:
        self.read_bytes += n
        return self.file.read_at(n, at)

    def __getitem__(self, part: slice) -> bytes:
        begin, end = part.start or 0, self.size if part.stop is None else min(part.stop, self.size)
        if end <= begin:
            return b""
        if end - begin > PAGE:
            return self._fetch(begin, end - begin)
        out = b""
        for page in range(begin // PAGE, (end - 1) // PAGE + 1):
            if page not in self.pages:
                self.pages[page] = self._fetch(page * PAGE, min(PAGE, self.size - page * PAGE))
                if len(self.pages) > self.most:
                    self.pages.popitem(last=False)
            self.pages.move_to_end(page)
            lo = page * PAGE
            out += self.pages[page][max(begin - lo, 0) : end - lo]
        return out


class Image(Tiff):
    """An image of a TIFF, classic or of 64-bit offsets, with its overviews: smaller versions, the largest first."""

    def __init__(self, data, at: int | None = None):
        self.data, self.order = data, {b"II": "<", b"MM": ">"}.get(bytes(data[0:2]), "")
        version = struct.unpack(f"{self.order}H", data[2:4])[0] if self.order else 0
        if version not in (42, 43):
            raise ValueError("not a TIFF file")
        self.big, whole = version == 43, at is None
        self._word = "Q" if self.big else "I"
        head = 8 if self.big else 4
        if whole:
            at = struct.unpack(f"{self.order}{self._word}", data[head : 2 * head])[0]
        count_size, entry = (8, 20) if self.big else (2, 12)
        count = struct.unpack(f"{self.order}{'Q' if self.big else 'H'}", data[at : at + count_size])[0]
        self.tags = {}
        for k in range(count):
            self._read_tag(at + count_size + entry * k)
        end = at + count_size + entry * count
        following = struct.unpack(f"{self.order}{self._word}", data[end : end + head])[0]
        self.width, self.height = self.tags[tiff.WIDTH][0], self.tags[tiff.HEIGHT][0]
        self.bands, self.planar = self.tags.get(tiff.SAMPLES, (1,))[0], self.tags.get(tiff.PLANAR, (1,))[0] == 2
        letter = {1: "u", 2: "i", 3: "f"}[self.tags.get(tiff.FORMAT, (1,))[0]]
        self.dtype = np.dtype(f"{self.order}{letter}{self.tags.get(tiff.BITS, (8,))[0] // 8}")
        self.overviews: list[Image] = []
        seen = {at}
        while whole and following and following not in seen:
            seen.add(following)
            image = Image(data, following)
            if image.tags.get(SUBFILE, (0,))[0] & REDUCED:
                self.overviews.append(image)
            following = image.following
        self.following = following

    def _read_tag(self, at: int) -> None:
        kinds = tiff._KINDS | {16: "Q"}
        head, inline = (12, 8) if self.big else (8, 4)
        tag, kind, n = struct.unpack(f"{self.order}HH{self._word}", self.data[at : at + head])
        if kind not in kinds:
            return
        shape = f"{self.order}{n}s" if kind == 2 else f"{self.order}{kinds[kind] * n}"
        size, where = struct.calcsize(shape), at + head
        if size > inline:
            where = struct.unpack(f"{self.order}{self._word}", self.data[where : where + inline])[0]
        self.tags[tag] = struct.unpack(shape, self.data[where : where + size])

    def resized(self, x: int, y: int, width: int, height: int, to_width: int, to_height: int) -> np.ndarray:
        """(bands, to_height, to_width) of a window, each pixel the nearest of the coarsest version that is fine enough."""
        fine = [o for o in self.overviews if o.width * width >= self.width * to_width and o.height * height >= self.height * to_height]
        source = min(fine, key=lambda o: o.width, default=self)
        sx, sy = source.width / self.width, source.height / self.height
        cols = np.minimum(((x + (np.arange(to_width) + 0.5) * width / to_width) * sx).astype(np.int64), source.width - 1)
        rows = np.minimum(((y + (np.arange(to_height) + 0.5) * height / to_height) * sy).astype(np.int64), source.height - 1)
        part = source.read(int(cols[0]), int(rows[0]), int(cols[-1] - cols[0]) + 1, int(rows[-1] - rows[0]) + 1)
        return part[:, (rows - rows[0])[:, None], (cols - cols[0])[None, :]]


def window_transform(place: tuple[float, ...], x: int, y: int, scale_x: float = 1.0, scale_y: float = 1.0) -> tuple[float, ...]:
    """The transform of a window that begins at (x, y), whose pixels are that many of the image's pixels wide and high."""
    a, b, c, d, e, f = place
    return a * scale_x, b * scale_y, c + a * x + b * y, d * scale_x, e * scale_y, f + d * x + e * y


def offsets(length: int, size: int, overlap: int, cut: bool = False) -> list[int]:
    """Starts of windows along an axis, the last moved back to end at the edge; with ``cut`` it stays and is smaller."""
    if cut:
        return list(range(0, max(length - overlap, 1), size - overlap))
    last = max(length - size, 0)
    return list(dict.fromkeys([*range(0, last + 1, size - overlap), last]))


def _system(path: str) -> tuple[fs.FileSystem, str]:
    path = re.sub(r"^file:(//(?=/))?", "", path)
    return fs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", path) else (fs.LocalFileSystem(), os.path.abspath(path))


def opened(path: str) -> Image:
    system, name = _system(path)
    return Image(Ranges(system.open_input_file(name), system.get_file_info(name).size))


# --- reading ---


@dataclass
class WindowRange(InputPartition):
    """The windows of a file that part ``part`` of ``parts`` has."""

    path: str
    part: int
    parts: int


@dataclass
class _Settings:
    size: int
    overlap: int
    bands: list[int] | None
    output: int | None
    part_bytes: int
    cut: bool = False
    tests: list[tuple[str, type, object]] = field(default_factory=list)

    @classmethod
    def of(cls, options: dict[str, str]) -> _Settings:
        bands = [int(b) for b in options["bands"].split(",")] if options.get("bands") else None
        output = int(options["outputsize"]) if options.get("outputsize") else None
        out = cls(int(options.get("tilesize", 512)), int(options.get("overlap", 0)), bands, output, int(options.get("partitionbytes", 128 << 20)), options.get("edge", "move") == "cut")
        if options.get("edge", "move") not in ("move", "cut"):
            raise ValueError("edge must be move or cut")
        if out.size <= 0 or not 0 <= out.overlap < out.size or (output is not None and output <= 0) or out.part_bytes <= 0:
            raise ValueError("tileSize, outputSize and partitionBytes must be positive and overlap from 0 to below tileSize")
        return out


class GeoTiffReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.settings = _Settings.of(options)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else ""
            if type(f) in _TESTS and (name in _NUMBERS or (name == "scene_id" and isinstance(f, EqualTo))) and f.value is not None:
                self.settings.tests.append((name, type(f), f.value))
            elif isinstance(f, In) and name == "scene_id":
                self.settings.tests.append((name, In, tuple(f.value)))
            else:
                yield f

    def _scene_passes(self, scene: str) -> bool:
        return all(scene in v if t is In else scene == v for n, t, v in self.settings.tests if n == "scene_id")

    def partitions(self) -> list[WindowRange]:
        """A partition for each range of windows, from names and sizes; files of scenes that a filter leaves out have none."""
        system, name = _system(self.options["path"])
        prefix = self.options["path"][: -len(name)] if self.options["path"].endswith(name) and "://" in self.options["path"] else ""
        info = system.get_file_info(name)
        infos = [info] if info.is_file else system.get_file_info(fs.FileSelector(name, recursive=False))
        out = []
        for f in sorted(infos, key=lambda f: f.path):
            if f.is_file and re.search(r"\.tiff?$", f.path, re.I) and self._scene_passes(scene_of(f.path)):
                parts = max(1, -(-f.size // self.settings.part_bytes))
                out += [WindowRange(prefix + f.path, k, parts) for k in range(parts)]
        return out

    def read(self, partition: WindowRange) -> Iterator[pa.RecordBatch]:
        s, image, scene = self.settings, opened(partition.path), scene_of(partition.path)
        xs, ys = offsets(image.width, s.size, s.overlap, s.cut), offsets(image.height, s.size, s.overlap, s.cut)
        n = len(xs) * len(ys)
        chosen = None if s.bands is None else [b - 1 for b in s.bands]
        if chosen and not all(0 <= b < image.bands for b in chosen):
            raise ValueError(f"{partition.path} has {image.bands} bands")
        rows: list[tuple] = []
        for k in range(n * partition.part // partition.parts, n * (partition.part + 1) // partition.parts):
            y, x = ys[k // len(xs)], xs[k % len(xs)]
            width, height = min(s.size, image.width - x), min(s.size, image.height - y)
            place = image.transform
            ends = [window_transform(place, x + i, y + j) for i, j in ((0, 0), (width, 0), (0, height), (width, height))]
            east, north = [t[2] for t in ends], [t[5] for t in ends]
            facts = dict(zip(_NUMBERS, (k, x, y, width, height, min(east), min(north), max(east), max(north)), strict=True))
            if not all(_TESTS[t](facts[name], v) for name, t, v in s.tests if name != "scene_id"):
                continue
            to_width, to_height = (width, height) if s.output is None else (s.output, s.output)
            pixels = image.read(x, y, width, height) if s.output is None else image.resized(x, y, width, height, to_width, to_height)
            pixels = pixels if chosen is None else pixels[chosen]
            moved = window_transform(place, x, y, width / to_width, height / to_height)
            bands = [b.ravel().astype(np.float32) for b in pixels]
            rows.append((scene, partition.path, *facts.values(), image.epsg, dict(zip("abcdef", moved, strict=True)), to_height, to_width, bands))
            if len(rows) >= 16:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


def scene_of(path: str) -> str:
    return re.sub(r"\.[^.]*$", "", path.rsplit("/", 1)[-1])


_PLACE = pa.struct([(k, pa.float64()) for k in "abcdef"])
_ARROW = pa.schema(
    [("scene_id", pa.string()), ("path", pa.string())] + [(n, pa.int32()) for n in _NUMBERS[:5]] + [(n, pa.float64()) for n in _NUMBERS[5:]]
    + [("crs_epsg", pa.int32()), ("transform", _PLACE), ("height", pa.int32()), ("width", pa.int32()), ("bands", pa.list_(pa.list_(pa.float32())))]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


# --- writing ---


def _directory(fields: list[tuple[int, int, tuple | bytes]], at: int, following: int) -> bytes:
    """An image file directory at a place, and behind it the values that don't fit into its entries."""
    extra_at, entries, extra = at + 2 + 12 * len(fields) + 4, b"", b""
    for tag, kind, value in sorted(fields, key=lambda f: f[0]):
        packed = value if isinstance(value, bytes) else struct.pack(f"<{tiff._KINDS[kind] * len(value)}", *value)
        entries += struct.pack("<HHI", tag, kind, len(value))
        if len(packed) > 4:
            entries += struct.pack("<I", extra_at + len(extra))
            extra += packed + b"\0" * (len(packed) % 2)
        else:
            entries += packed.ljust(4, b"\0")
    return struct.pack("<H", len(fields)) + entries + struct.pack("<I", following) + extra


def encode_tiled(
    image: np.ndarray, place: tuple[float, ...], epsg: int | None = None, items: dict[str, str] | None = None, tile: int = 256, overviews: bool = True
) -> bytes:
    """A deflate GeoTIFF of square tiles of (bands, height, width), with nearest overviews at halves while they exceed a tile."""
    if tile % 16:
        raise ValueError("tiles are multiples of 16 pixels")
    levels = [image]
    while overviews and max(levels[-1].shape[1:]) > tile:
        levels.append(levels[-1][:, ::2, ::2])
    geo: list[tuple[int, int, tuple | bytes]] = [(tiff.AFFINE, 12, (place[0], place[1], 0.0, place[2], place[3], place[4], 0.0, place[5], *(0.0,) * 7, 1.0))]
    if epsg:
        model, key = (2, tiff.GEOGRAPHIC) if epsg == 4326 else (1, tiff.PROJECTED)
        geo.append((tiff.GEO_KEYS, 3, (1, 1, 0, 3, 1024, 0, 1, model, 1025, 0, 1, 1, key, 0, 1, epsg)))
    if items:
        safe = lambda x: x.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")
        text = "".join(f'<Item name="{safe(k)}">{safe(v)}</Item>' for k, v in items.items())
        geo.append((tiff.METADATA, 2, f"<GDALMetadata>{text}</GDALMetadata>".encode() + b"\0"))
    body, directories = b"", []
    for n, level in enumerate(levels):
        bands, height, width = level.shape
        kind = level.dtype.newbyteorder("<")
        places, sizes = [], []
        for y in range(0, height, tile):
            for x in range(0, width, tile):
                block = np.zeros((tile, tile, bands), kind)
                part = level[:, y : y + tile, x : x + tile].transpose(1, 2, 0)
                block[: part.shape[0], : part.shape[1]] = part
                packed = zlib.compress(block.tobytes())
                places.append(8 + len(body))
                sizes.append(len(packed))
                body += packed + b"\0" * (len(packed) % 2)
        fields = [
            (SUBFILE, 4, (REDUCED if n else 0,)), (tiff.WIDTH, 4, (width,)), (tiff.HEIGHT, 4, (height,)), (tiff.BITS, 3, (kind.itemsize * 8,) * bands),
            (tiff.COMPRESSION, 3, (8,)), (262, 3, (1,)), (tiff.SAMPLES, 3, (bands,)), (tiff.PLANAR, 3, (1,)), (tiff.TILE_WIDTH, 3, (tile,)), (tiff.TILE_HEIGHT, 3, (tile,)),
            (tiff.TILES, 4, tuple(places)), (tiff.TILE_SIZES, 4, tuple(sizes)), (tiff.FORMAT, 3, ({"u": 1, "i": 2, "f": 3}[kind.kind],) * bands),
        ]
        directories.append(fields + ([] if n else geo))
    at, tail = 8 + len(body), b""
    starts = [at]
    for fields in directories[:-1]:
        starts.append(starts[-1] + len(_directory(fields, 0, 0)))
    for fields, start, following in zip(directories, starts, [*starts[1:], 0], strict=True):
        tail += _directory(fields, start, following)
    return b"II*\0" + struct.pack("<I", at) + body + tail


@dataclass
class Written(WriterCommitMessage):
    """Files that a task has written beside their places."""

    names: list[str]
    folder: str


class GeoTiffWriter(DataSourceWriter):
    """Tasks write to a folder of the job's own; only when all of them are done, files take their places.

    A failed or repeated task leaves nothing, as its files are never moved. Names must be unique in a job.
    """

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite, self.job = options["path"].rstrip("/"), overwrite, uuid.uuid4().hex
        self.kind, self.tile = options.get("dtype", "float32"), int(options.get("tilesize", 256))
        self.overviews = options.get("overviews", "true").lower() == "true"

    @property
    def _staging(self) -> str:
        return f"{self.path}/_temporary-{self.job}"

    def write(self, iterator) -> Written:
        task = f"{self._staging}/{uuid.uuid4().hex}"
        system, folder = _system(task)
        system.create_dir(folder, recursive=True)
        names = []
        for r in iterator:
            if not r["name"] or "/" in r["name"]:
                raise ValueError(f"not a file's name: {r['name']!r}")
            image = np.stack([np.asarray(b, np.float64) for b in r["bands"]]).reshape(-1, r["height"], r["width"]).astype(self.kind)
            place = tuple(r["transform"][k] for k in "abcdef") if r["transform"] is not None else (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)
            data = encode_tiled(image, place, r["crs_epsg"], dict(r["tags"]) if r["tags"] else None, self.tile, self.overviews)
            name = r["name"] if re.search(r"\.tiff?$", r["name"], re.I) else r["name"] + ".tif"
            with system.open_output_stream(f"{folder}/{name}") as f:
                f.write(data)
            names.append(name)
        return Written(names, task)

    def commit(self, messages: list[Written | None]) -> None:
        done = [m for m in messages if m is not None]
        names = [n for m in done for n in m.names]
        if len(set(names)) != len(names):
            self.abort(messages)
            raise ValueError("two images of a job have one name")
        system, folder = _system(self.path)
        if self.overwrite:
            for f in system.get_file_info(fs.FileSelector(folder, recursive=False)):
                if f.is_file and re.search(r"\.tiff?$", f.path, re.I):
                    system.delete_file(f.path)
        for m in done:
            for n in m.names:
                system.move(f"{_system(m.folder)[1]}/{n}", f"{folder}/{n}")
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        system, folder = _system(self._staging)
        if system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir(folder)


class GeoTiffSource(DataSource):
    """Options of reads: tileSize, overlap, bands (from 1), outputSize (each window at that many pixels a side), partitionBytes,
    edge (move: the last window of an axis is moved back to end at the image's edge; cut: it stays in the grid and is smaller).
    Options of writes: dtype, tileSize, overviews."""

    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> GeoTiffReader:
        return GeoTiffReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> GeoTiffWriter:
        return GeoTiffWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets filters reach Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(GeoTiffSource)
