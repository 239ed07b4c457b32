"""Rasters of any size as blocks: a row is a square of pixels, packed, and neighbours send each other their borders.

blocks(scene, by, bx, height, width, data): the pixels of rows by * size .. and columns bx * size .. as bytes, row by
row. A block is whole but at the mosaic's right and lower edges. What no block has lies outside of the mosaic. An operator
with a reach of h pixels deals each block once, with strips of h pixels to its eight neighbours, so a pixel moves as one
or four bytes and not as a row; nothing is sent for each place of a kernel's square.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.operators.batches import map_slices
from rasterloom.operators.graph import components, stored
from rasterloom.operators.morphology import label_grid

SIZE = 512
BLOCKS = "scene string, by long, bx long, height int, width int, data binary"
_DEALT = "scene string, by long, bx long, dy int, dx int, height int, width int, data binary"


def _packed(a: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(a).astype(kind).tobytes()


def _grid(data: bytes, kind: str, height: int, width: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(height, width)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


# --- from and to pixels and tiles ---


def mosaic_mean(tiles: DataFrame, size: int = SIZE) -> DataFrame:
    """Blocks of single-precision means of overlapping tiles(scene, row_off, col_off, height, width, values).

    A tile is cut where blocks end, and a block takes in the pieces one after the other. A null value counts for nothing;
    a place that no tile covers is null, which is NaN in the data. Null scenes are a scene, null values no tile.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t in batch.itertuples(index=False):
                grid, out = np.asarray(t.values, np.float64).reshape(t.height, t.width), []
                for by in range(t.row_off // size, (t.row_off + t.height - 1) // size + 1):
                    for bx in range(t.col_off // size, (t.col_off + t.width - 1) // size + 1):
                        y0, x0 = max(by * size, t.row_off), max(bx * size, t.col_off)
                        part = grid[y0 - t.row_off : (by + 1) * size - t.row_off, x0 - t.col_off : (bx + 1) * size - t.col_off]
                        out.append((t.scene, by, bx, y0 - by * size, x0 - bx * size, *part.shape, _packed(part, "<f4")))
                yield _frame(out, _DEALT)

    def averaged(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        height, width = int((frame["dy"] + frame["height"]).max()), int((frame["dx"] + frame["width"]).max())
        total, count = np.zeros((height, width)), np.zeros((height, width))
        for p in frame.itertuples(index=False):
            part = _grid(p.data, "<f4", p.height, p.width)
            known = ~np.isnan(part)
            at = (slice(p.dy, p.dy + p.height), slice(p.dx, p.dx + p.width))
            total[at] += np.where(known, part, 0)
            count[at] += known
        with np.errstate(invalid="ignore"):
            mean = total / count
        return _frame([(*key, height, width, _packed(mean, "<f4"))], BLOCKS)

    known = tiles.select("scene", "row_off", "col_off", "height", "width", "values").filter("values IS NOT NULL")
    pieces = map_slices(known, cut, _DEALT)
    return _squared(pieces.groupBy("scene", "by", "bx").applyInPandas(averaged, BLOCKS), size, "<f4", float("nan"))


def extents(blocks: DataFrame, size: int = SIZE) -> DataFrame:
    """(scene, rows, cols) of each mosaic, as far as its blocks reach."""
    return blocks.groupBy("scene").agg(F.max(F.col("by") * size + F.col("height")).alias("rows"), F.max(F.col("bx") * size + F.col("width")).alias("cols"))


def _squared(blocks: DataFrame, size: int, kind: str, empty: float) -> DataFrame:
    """Blocks made as large as their place in the mosaic asks for, and rows for places without any, filled with ``empty``."""
    blocks = stored(blocks, "blocks")
    ends = stored(extents(blocks, size), "extents")
    last = lambda c: F.floor((F.col(c) - 1) / size)
    places = ends.select("scene", "rows", "cols", F.explode(F.sequence(F.lit(0).cast("long"), last("rows"))).alias("by"))
    places = places.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last("cols"))).alias("bx"))

    def of(key: tuple, place: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(place):
            return _frame([], BLOCKS)
        p = place.iloc[0]
        height, width = int(min(size, p["rows"] - p["by"] * size)), int(min(size, p["cols"] - p["bx"] * size))
        grid = np.full((height, width), empty, kind)
        for b in own.itertuples(index=False):
            grid[: b.height, : b.width] = _grid(b.data, kind, b.height, b.width)
        return _frame([(p["scene"], p["by"], p["bx"], height, width, _packed(grid, kind))], BLOCKS)

    name = F.coalesce(F.concat(F.lit("="), F.col("scene")), F.lit("-"))
    dealt = [x.withColumn("of", name).groupBy("of", "by", "bx") for x in (places, blocks)]
    return dealt[0].cogroup(dealt[1]).applyInPandas(of, BLOCKS)


def mapped(blocks: DataFrame, kernel: Callable[[np.ndarray], np.ndarray], kind: str, out: str) -> DataFrame:
    """Blocks under a function of one pixel, of numpy's ``kind`` before and ``out`` after it."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(data=[_packed(kernel(_grid(b.data, kind, b.height, b.width)), out) for b in batch.itertuples(index=False)])

    return map_slices(blocks.select(*[c.split()[0] for c in BLOCKS.split(", ")]), of, BLOCKS)


def thresholded(blocks: DataFrame, threshold: float) -> DataFrame:
    """Masks of single-precision blocks: 1 where the value is at least the threshold; unknown places are 0."""
    return mapped(blocks, lambda v: v >= np.float32(threshold), "<f4", "u1")


def to_pixels(blocks: DataFrame, kind: str = "u1", size: int = SIZE) -> DataFrame:
    """(scene, gr, gc, v) of each pixel; NaN becomes null."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples(index=False):
                grid = _grid(b.data, kind, b.height, b.width).astype(np.float64)
                r, c = np.divmod(np.arange(grid.size), b.width)
                v = pd.Series(grid.ravel(), dtype=object).where(~np.isnan(grid.ravel()), None)
                yield pd.DataFrame({"scene": b.scene, "gr": r + b.by * size, "gc": c + b.bx * size, "v": v})

    return map_slices(blocks, of, "scene string, gr long, gc long, v double")


# --- neighbours' borders ---


def _strips(row: tuple, grid: np.ndarray, reach: int, size: int, kind: str) -> Iterator[tuple]:
    """What a block sends: itself to its own place, and to each neighbour the border that reaches into its surroundings.

    dy and dx say where, in pixels from the receiver's first one, the piece begins; the last rows and columns count too.
    """
    scene, by, bx = row
    for dy in (-1, 0, 1):
        for dx in (-1, 0, 1):
            rows = slice(None) if dy == 0 else slice(0, reach) if dy < 0 else slice(max(size - reach, 0), None)
            cols = slice(None) if dx == 0 else slice(0, reach) if dx < 0 else slice(max(size - reach, 0), None)
            part = grid[rows, cols]
            if part.size and by + dy >= 0 and bx + dx >= 0:
                top, left = (rows.start or 0) - dy * size, (cols.start or 0) - dx * size
                yield scene, by + dy, bx + dx, top, left, *part.shape, _packed(part, kind)


def with_borders(
    blocks: DataFrame, reach: int, kernel: Callable[[np.ndarray, np.ndarray, slice, slice], np.ndarray], kind: str = "u1", out: str = "u1", size: int = SIZE
) -> DataFrame:
    """Blocks under a kernel that reaches over ``reach`` pixels.

    The kernel takes the block with that many pixels around it, what of it lies inside of the mosaic, and the block's
    place in it; it returns the block. Outside of the mosaic pixels are 0. reach is at most the blocks' size.
    """
    if not 0 <= reach <= size:
        raise ValueError("a kernel may reach over one block at most")

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples(index=False):
                yield _frame(list(_strips((b.scene, b.by, b.bx), _grid(b.data, kind, b.height, b.width), reach, size, kind)), _DEALT)

    def gather(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        wide = np.zeros((size + 2 * reach, size + 2 * reach), kind)
        known = np.zeros(wide.shape, bool)
        own = None
        for p in frame.itertuples(index=False):
            part = _grid(p.data, kind, p.height, p.width)
            if (p.dy, p.dx) == (0, 0) and own is None:
                own = p.height, p.width
            at = (slice(p.dy + reach, p.dy + reach + p.height), slice(p.dx + reach, p.dx + reach + p.width))
            wide[at], known[at] = part, True
        if own is None or not (frame["dy"].eq(0) & frame["dx"].eq(0)).any():
            return _frame([], BLOCKS)
        height, width = own
        rows, cols = slice(reach, reach + height), slice(reach, reach + width)
        wide, known = wide[: height + 2 * reach, : width + 2 * reach], known[: height + 2 * reach, : width + 2 * reach]
        return _frame([(*key, height, width, _packed(kernel(wide, known, rows, cols), out))], BLOCKS)

    dealt = map_slices(blocks.select(*[c.split()[0] for c in BLOCKS.split(", ")]), deal, _DEALT)
    return dealt.groupBy("scene", "by", "bx").applyInPandas(gather, BLOCKS)


def _spread(mask: np.ndarray, grow: bool) -> np.ndarray:
    """A mask grown by the 3x3 square, or shrunk by it; beyond the edge nothing is set."""
    wide = np.pad(mask, 1)
    rows = [wide[1 + d : wide.shape[0] - 1 + d] for d in (-1, 0, 1)]
    tall = rows[0] | rows[1] | rows[2] if grow else rows[0] & rows[1] & rows[2]
    cols = [tall[:, 1 + d : tall.shape[1] - 1 + d] for d in (-1, 0, 1)]
    return cols[0] | cols[1] | cols[2] if grow else cols[0] & cols[1] & cols[2]


def closed(blocks: DataFrame, pixels: int, size: int = SIZE) -> DataFrame:
    """Masks after ``pixels`` dilations by the 3x3 square, within the mosaic, and as many erosions."""
    def kernel(wide: np.ndarray, known: np.ndarray, rows: slice, cols: slice) -> np.ndarray:
        mask = wide.astype(bool)
        for _ in range(pixels):
            mask = _spread(mask, True) & known
        for _ in range(pixels):
            mask = _spread(mask, False)
        return mask[rows, cols]

    return with_borders(blocks, 2 * pixels, kernel, size=size) if pixels > 0 else blocks


def dilated(blocks: DataFrame, pixels: int, size: int = SIZE) -> DataFrame:
    def kernel(wide: np.ndarray, known: np.ndarray, rows: slice, cols: slice) -> np.ndarray:
        mask = wide.astype(bool)
        for _ in range(pixels):
            mask = _spread(mask, True) & known
        return mask[rows, cols]

    return with_borders(blocks, pixels, kernel, size=size) if pixels > 0 else blocks


def eroded(blocks: DataFrame, pixels: int, size: int = SIZE) -> DataFrame:
    def kernel(wide: np.ndarray, _known: np.ndarray, rows: slice, cols: slice) -> np.ndarray:
        mask = wide.astype(bool)
        for _ in range(pixels):
            mask = _spread(mask, False)
        return mask[rows, cols]

    return with_borders(blocks, pixels, kernel, size=size) if pixels > 0 else blocks


def resized(blocks: DataFrame, sizes: DataFrame, size: int = SIZE, kind: str = "<f4", out: str = "<f4") -> DataFrame:
    """Corner-aligned bilinear resize of whole mosaics to sizes(scene, to_rows, to_cols), from pixels of numpy's ``kind`` to ``out``.

    A block goes to each block of the result that lies between its pixels; the result's block finds the two rows and two
    columns around each of its places. Scenes that sizes doesn't have go.
    """
    facts = stored(extents(blocks, size).join(sizes, "scene"), "sizes")

    def position(n: int, m: int, at: np.ndarray) -> np.ndarray:
        return at * ((n - 1) / (m - 1)) if m > 1 else np.zeros(len(at))

    def targets(begin: int, end: int, n: int, m: int) -> tuple[int, int]:
        """The first and last block of the result whose places have a neighbour in rows begin .. end - 1."""
        at = position(n, m, np.arange(m))
        low = np.floor(at).astype(np.int64)
        hit = np.flatnonzero((low < end) & (np.minimum(low + 1, n - 1) >= begin))
        return (int(hit[0]) // size, int(hit[-1]) // size) if len(hit) else (0, -1)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples(index=False):
                y0, y1 = targets(b.by * size, b.by * size + b.height, b.rows, b.to_rows)
                x0, x1 = targets(b.bx * size, b.bx * size + b.width, b.cols, b.to_cols)
                rows = [
                    (b.scene, y, x, b.by * size, b.bx * size, b.height, b.width, b.data, b.rows, b.cols, b.to_rows, b.to_cols)
                    for y in range(y0, y1 + 1) for x in range(x0, x1 + 1)
                ]
                if rows:
                    yield _frame(rows, with_sizes)

    def gather(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        _, by, bx = key
        n, w, m, v = (int(frame[c].iloc[0]) for c in ("rows", "cols", "to_rows", "to_cols"))
        ys, xs = position(n, m, np.arange(by * size, min((by + 1) * size, m))), position(w, v, np.arange(bx * size, min((bx + 1) * size, v)))
        top, left = int(np.floor(ys[0])), int(np.floor(xs[0]))
        wide = np.zeros((int(min(np.floor(ys[-1]) + 1, n - 1)) - top + 1, int(min(np.floor(xs[-1]) + 1, w - 1)) - left + 1))
        for p in frame.itertuples(index=False):
            part = _grid(p.data, kind, p.height, p.width)
            y0, x0 = max(p.dy, top), max(p.dx, left)
            y1, x1 = min(p.dy + p.height, top + wide.shape[0]), min(p.dx + p.width, left + wide.shape[1])
            if y0 < y1 and x0 < x1:
                wide[y0 - top : y1 - top, x0 - left : x1 - left] = part[y0 - p.dy : y1 - p.dy, x0 - p.dx : x1 - p.dx]
        r, c = np.floor(ys).astype(int) - top, np.floor(xs).astype(int) - left
        r1, c1 = np.minimum(r + 1, wide.shape[0] - 1), np.minimum(c + 1, wide.shape[1] - 1)
        part_x, part_y = (xs - np.floor(xs))[None, :], (ys - np.floor(ys))[:, None]
        upper = wide[r][:, c] + (wide[r][:, c1] - wide[r][:, c]) * part_x
        lower = wide[r1][:, c] + (wide[r1][:, c1] - wide[r1][:, c]) * part_x
        mixed = upper + (lower - upper) * part_y
        return _frame([(*key, *mixed.shape, _packed(mixed, out))], BLOCKS)

    with_sizes = _DEALT + ", rows long, cols long, to_rows long, to_cols long"
    dealt = map_slices(blocks.join(facts, "scene"), deal, with_sizes)
    return dealt.groupBy("scene", "by", "bx").applyInPandas(gather, BLOCKS)


# --- regions ---

_REGIONS = "scene string, by long, bx long, height int, width int, data binary, labels binary, node string, value int, pixels long, kind string, other string"


def _labelled(blocks: DataFrame, size: int) -> DataFrame:
    """For each block: itself with labels (kind block), its parts of regions (part), and the pairs of parts that are one
    region (link) or touch (near), those across the block's borders too. Parts are named by block and first pixel.

    A block sees the pixel around it, so it names its neighbours' parts only if it knows their labels: labels go with the
    blocks' borders, in a first step, which labels each block alone.
    """
    def alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            both = []
            for b in batch.itertuples(index=False):
                mask = _grid(b.data, "u1", b.height, b.width).astype(np.int64)
                #: The label is the first pixel's place in a whole block; with the value in its last bit.
                label = label_grid(mask, 8)
                label = (label // b.width * size + label % b.width) * 2 + mask
                both.append(_packed(label, "<i4"))
            yield batch.assign(data=both)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples(index=False):
                yield _frame(list(_strips((b.scene, b.by, b.bx), _grid(b.data, "<i4", b.height, b.width), 1, size, "<i4")), _DEALT)

    def gather(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        scene, by, bx = key
        own = frame[(frame["dy"] == 0) & (frame["dx"] == 0) & ((frame["height"] > 1) | (frame["width"] > 1) | (size == 1))]
        own = own if len(own) else frame[(frame["dy"] == 0) & (frame["dx"] == 0)]
        if not len(own):
            return _frame([], _REGIONS)
        height, width = int(own["height"].iloc[0]), int(own["width"].iloc[0])
        label = np.full((height + 2, width + 2), -1, np.int64)
        home = np.zeros(label.shape, np.int64)  # which of the nine blocks a pixel is of
        for p in frame.itertuples(index=False):
            y, x = p.dy + 1, p.dx + 1
            part = _grid(p.data, "<i4", p.height, p.width)[: max(0, height + 2 - y), : max(0, width + 2 - x)]
            label[y : y + part.shape[0], x : x + part.shape[1]] = part
            home[y : y + part.shape[0], x : x + part.shape[1]] = (np.sign(p.dy) + 1) * 3 + np.sign(p.dx) + 1
        names = lambda h, v: f"{'-' if scene is None else '=' + scene}|{by + h // 3 - 1}|{bx + h % 3 - 1}|{v // 2}"
        code, seen = home * (4 * size * size) + label, set()
        for dr, dc in ((0, 1), (1, 0), (1, 1), (1, -1)):
            here = (slice(0, height + 2 - dr), slice(max(0, -dc), width + 2 - max(0, dc)))
            there = (slice(dr, None), slice(max(0, dc), width + 2 - max(0, -dc)))
            a, b = code[here].ravel(), code[there].ravel()
            ok = (label[here].ravel() >= 0) & (label[there].ravel() >= 0) & (a != b) & ((home[here].ravel() == 4) | (home[there].ravel() == 4))
            seen |= set(map(tuple, np.unique(np.stack([a[ok], b[ok]], 1), axis=0).tolist()))
        rows = [(scene, by, bx, height, width, _packed(label[1:-1, 1:-1] & 1, "u1"), _packed(label[1:-1, 1:-1] >> 1, "<i4"), None, None, None, "block", None)]
        for v, n in zip(*np.unique(label[1:-1, 1:-1], return_counts=True), strict=True):
            rows.append((scene, by, bx, None, None, None, None, names(4, v), int(v & 1), int(n), "part", None))
        unit = 4 * size * size
        for a, b in seen:
            left, right = names(a // unit, a % unit), names(b // unit, b % unit)
            if (a & 1) == (b & 1):
                rows.append((scene, by, bx, None, None, None, None, left, None, None, "link", right))
            else:
                rows += [(scene, by, bx, None, None, None, None, x, None, None, "near", y) for x, y in ((left, right), (right, left))]
        out = _frame(rows, _REGIONS)
        return out.astype({"height": "Int32", "width": "Int32", "value": "Int32", "pixels": "Int64"})

    labelled = map_slices(blocks.select(*[c.split()[0] for c in BLOCKS.split(", ")]), alone, BLOCKS)
    return map_slices(labelled, deal, _DEALT).groupBy("scene", "by", "bx").applyInPandas(gather, _REGIONS)


def sieved(blocks: DataFrame, pixels: int, value: int, size: int = SIZE) -> DataFrame:
    """Masks whose 8-connected regions of ``value`` with fewer than ``pixels`` pixels are given to their largest neighbour.

    A region may lie over any number of blocks. One whose largest neighbour is under ``pixels`` itself stays; all are
    judged on the input, at once. Regions are components of blocks' parts, so no task holds more than a block.
    """
    if pixels <= 0:
        return blocks
    if size > 16_384:
        raise ValueError("blocks of at most 16,384 pixels a side")
    found = stored(_labelled(blocks, size), "regions")
    parts = found.filter("kind = 'part'").select("scene", "by", "bx", "node", "value", "pixels")
    links = found.filter("kind = 'link'").select(F.col("node").alias("a"), F.col("other").alias("b"))
    roots = stored(components(links).withColumnRenamed("node", "_node"), "roots")
    rooted = stored(parts.join(roots, F.col("node") == F.col("_node"), "left").withColumn("region", F.coalesce("root", "node")).drop("_node", "root"), "parts")
    counts = stored(rooted.groupBy("region").agg(F.sum("pixels").alias("whole")), "counts")
    sized = stored(rooted.join(counts, "region").select("scene", "by", "bx", "node", "value", "region", "whole"), "sizes")
    near = found.filter("kind = 'near'").select("node", "other").distinct()
    small = sized.filter((F.col("whole") < pixels) & (F.col("value") == value))
    large = sized.filter(F.col("whole") >= pixels).select(F.col("node").alias("other"))
    flipped = small.select("node", "region").join(near, "node").join(large, "other", "left_semi").select("region").distinct()
    gone = small.join(flipped, "region", "left_semi").withColumn("label", F.element_at(F.split("node", r"\|"), -1).cast("int"))
    lists = gone.groupBy("scene", "by", "bx").agg(F.collect_list("label").alias("flip"))  # at most the block's own parts
    same = ["scene", "by", "bx"]
    whole = found.filter("kind = 'block'").select(*same, "height", "width", "data", "labels")
    lists = stored(lists.select(*[F.col(c).alias(f"_{c}") for c in same], "flip"), "flips")
    meet = F.col("scene").eqNullSafe(F.col("_scene")) & (F.col("by") == F.col("_by")) & (F.col("bx") == F.col("_bx"))

    def turn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for b in batch.itertuples(index=False):
                mask = _grid(b.data, "u1", b.height, b.width)
                if b.flip is not None:
                    mask = np.where(np.isin(_grid(b.labels, "<i4", b.height, b.width), b.flip), 1 - mask, mask)
                out.append(_packed(mask, "u1"))
            yield batch[same + ["height", "width"]].assign(data=out)

    return map_slices(whole.join(lists, meet, "left").select(*same, "height", "width", "data", "labels", "flip"), turn, BLOCKS)


def cleanup(blocks: DataFrame, close_pixels: int = 0, fill_holes: int = 0, remove_objects: int = 0, size: int = SIZE) -> DataFrame:
    """Masks of a whole mosaic: closing, then small holes, then small objects; a step of 0 is left out."""
    out = closed(blocks, close_pixels, size)
    return sieved(sieved(out, fill_holes, 0, size), remove_objects, 1, size)
