"""Morphology and components of masks, as sets of foreground pixels mask(tile_id, r, c) or kernels of whole tiles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.operators.graph import components


def _spread(mask: DataFrame, column: str) -> DataFrame:
    """Each pixel at its place and one to either side along ``column``."""
    return mask.withColumn(column, F.explode(F.array(F.col(column) - 1, F.col(column), F.col(column) + 1)))


def dilate(mask: DataFrame, sizes: DataFrame) -> DataFrame:
    """mask grown by the 3x3 square, clipped to sizes(tile_id, height, width).

    The square is a row and then a column of three, which makes 3 + 3 copies of a pixel and not 9.
    """
    wide = _spread(mask, "c").distinct()
    tall = _spread(wide, "r").distinct()
    inside = (F.col("r") >= 0) & (F.col("c") >= 0) & (F.col("r") < F.col("height")) & (F.col("c") < F.col("width"))
    return tall.join(sizes, "tile_id").filter(inside).select("tile_id", "r", "c")


def erode(mask: DataFrame) -> DataFrame:
    """Pixels of mask whose 3x3 neighbours are all in it; outside of the tile nothing is, so its border always goes."""
    wide = _spread(mask, "c").groupBy("tile_id", "r", "c").count().filter("count = 3").drop("count")
    return _spread(wide, "r").groupBy("tile_id", "r", "c").count().filter("count = 3").drop("count")


def close(mask: DataFrame, sizes: DataFrame, pixels: int) -> DataFrame:
    """``pixels`` dilations and as many erosions; the outer ring of that width of each tile becomes empty."""
    for _ in range(pixels):
        mask = dilate(mask, sizes)
    for _ in range(pixels):
        mask = erode(mask)
    return mask


def label_grid(grid: np.ndarray, connectivity: int) -> np.ndarray:
    """Labels of the components of equal values: the smallest flat index of each."""
    n = grid.size
    at = np.arange(n).reshape(grid.shape)
    links = [(at[:, :-1], at[:, 1:], grid[:, :-1] == grid[:, 1:]), (at[:-1], at[1:], grid[:-1] == grid[1:])]
    if connectivity == 8:
        links += [(at[:-1, :-1], at[1:, 1:], grid[:-1, :-1] == grid[1:, 1:]), (at[:-1, 1:], at[1:, :-1], grid[:-1, 1:] == grid[1:, :-1])]
    a = np.concatenate([x[ok] for x, _, ok in links])
    b = np.concatenate([y[ok] for _, y, ok in links])
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root.reshape(grid.shape)


def _grid(part: pd.DataFrame, value: str) -> np.ndarray:
    grid = np.full((int(part["r"].max()) + 1, int(part["c"].max()) + 1), -1, np.int64)
    grid[part["r"], part["c"]] = part[value]
    return grid


def tile_components(pixels: DataFrame, connectivity: int = 4) -> DataFrame:
    """(tile_id, r, c, label) of the foreground of pixels(tile_id, r, c, mask): one task labels a whole tile.

    label is the smallest r * width + c of the component. Tiles are bounded, so a task holds one tile at a time.
    """

    def of(part: pd.DataFrame) -> pd.DataFrame:
        grid = _grid(part, "mask")
        label = label_grid(grid, connectivity)
        r, c = np.nonzero(grid == 1)
        return pd.DataFrame({"tile_id": part["tile_id"].iloc[0], "r": r, "c": c, "label": label[r, c]})

    kind = dict(pixels.dtypes)["tile_id"]
    return pixels.select("tile_id", "r", "c", "mask").groupBy("tile_id").applyInPandas(of, f"tile_id {kind}, r int, c int, label long")


def sieve_grid(grid: np.ndarray, size: int, values: tuple[int, ...]) -> np.ndarray:
    """grid with components of ``values`` of fewer than ``size`` pixels given to their largest neighbour.

    Components are 8-connected. One whose largest neighbour is itself under ``size`` stays as it is; all are judged
    on the input, at once.
    """
    label = label_grid(grid, 8)
    roots, inverse, count = np.unique(label, return_inverse=True, return_counts=True)
    inverse = inverse.reshape(grid.shape)
    best = np.zeros(len(roots), np.int64)
    h, w = grid.shape
    for dr, dc in ((0, 1), (1, 0), (1, 1), (1, -1)):
        here = inverse[: h - dr, max(0, -dc) : w - max(0, dc)]
        there = inverse[dr:, max(0, dc) : w - max(0, -dc)]
        for x, y in ((here, there), (there, here)):
            apart = x != y
            np.maximum.at(best, x[apart], count[y[apart]])
    flips = (count < size) & (best >= size) & np.isin(grid.reshape(-1)[roots], values)
    return np.where(flips[inverse], 1 - grid, grid)


def _sieved(pixels: DataFrame, steps: list[tuple[int, tuple[int, ...]]]) -> DataFrame:
    def of(part: pd.DataFrame) -> pd.DataFrame:
        grid = _grid(part, "mask")
        for size, values in steps:
            if size > 0:
                grid = sieve_grid(grid, size, values)
        return part.assign(mask=grid[part["r"], part["c"]])

    kind = dict(pixels.dtypes)["tile_id"]
    return pixels.select("tile_id", "r", "c", "mask").groupBy("tile_id").applyInPandas(of, f"tile_id {kind}, r int, c int, mask int")


def remove_small_objects(pixels: DataFrame, size: int) -> DataFrame:
    """Foreground components of fewer than ``size`` pixels become background."""
    return _sieved(pixels, [(size, (1,))])


def fill_small_holes(pixels: DataFrame, size: int) -> DataFrame:
    """Background components of fewer than ``size`` pixels, those at the edge too, become foreground."""
    return _sieved(pixels, [(size, (0,))])


def cleanup(pixels: DataFrame, close_pixels: int = 0, fill_holes: int = 0, remove_objects: int = 0) -> DataFrame:
    """Closing, then small holes, then small objects; a step of 0 is left out. pixels(tile_id, r, c, mask) is dense."""
    if close_pixels > 0:
        sizes = pixels.groupBy("tile_id").agg((F.max("r") + 1).alias("height"), (F.max("c") + 1).alias("width"))
        closed = close(pixels.filter("mask = 1").select("tile_id", "r", "c"), sizes, close_pixels).withColumn("_one", F.lit(1))
        pixels = pixels.join(closed, ["tile_id", "r", "c"], "left").withColumn("mask", F.coalesce("_one", F.lit(0))).drop("_one")
    if fill_holes > 0 or remove_objects > 0:
        pixels = _sieved(pixels, [(fill_holes, (0,)), (remove_objects, (1,))])
    return pixels.select("tile_id", "r", "c", "mask")


def smoothed(pixels: DataFrame, radius: int) -> DataFrame:
    """pixels(tile_id, r, c, mask) closed by a disc: gaps and notches narrower than twice the radius fill up, borders stay."""
    from rasterloom.operators.shapes import smooth

    def of(part: pd.DataFrame) -> pd.DataFrame:
        return part.assign(mask=smooth(_grid(part, "mask"), radius)[part["r"], part["c"]])

    kind = dict(pixels.dtypes)["tile_id"]
    return pixels.select("tile_id", "r", "c", "mask").groupBy("tile_id").applyInPandas(of, f"tile_id {kind}, r int, c int, mask int") if radius > 0 else pixels


def mosaic_components(mask: DataFrame, block: int = 512, keys: list[str] | None = None) -> DataFrame:
    """(keys, gr, gc, label) of the 4-connected components of a mosaic of any size, mask(keys, gr, gc); repeats of a pixel are one.

    Pixels of different keys, such as classes, are apart. label is gr * 2^31 + gc of the component's first pixel, so
    it is the same for any size of block, and unique within its keys. Blocks are labelled each in a task; only pixels
    at block borders become edges, and the components of those few labels are found by joins, so no task ever holds
    the mosaic.
    """
    keys, width = keys or [], F.lit(1 << 31)
    number = F.concat_ws(":", F.floor(F.col("gr") / block), F.floor(F.col("gc") / block), *[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys])
    blocks = mask.distinct().select(
        number.alias("tile_id"),
        F.pmod("gr", F.lit(block)).cast("int").alias("r"), F.pmod("gc", F.lit(block)).cast("int").alias("c"), F.lit(1).alias("mask"),
        F.col("gr").cast("long").alias("gr"), F.col("gc").cast("long").alias("gc"), *keys,
    )
    own = tile_components(blocks).withColumn("label", F.concat_ws("/", "tile_id", "label"))
    own = own.join(blocks.drop("mask"), ["tile_id", "r", "c"])
    low = own.groupBy("label").agg(F.min(F.col("gr") * width + F.col("gc")).alias("key"))
    node = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col("key").alias("key")) if keys else F.col("key")
    keyed = own.join(low, "label").select(*keys, "gr", "gc", "r", "c", node.alias("key"))
    right = keyed.filter(F.col("c") == block - 1).select(*keys, "gr", (F.col("gc") + 1).alias("gc"), F.col("key").alias("a"))
    below = keyed.filter(F.col("r") == block - 1).select(*keys, (F.col("gr") + 1).alias("gr"), "gc", F.col("key").alias("a"))
    starts = keyed.filter("c = 0 OR r = 0").select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("gr").alias("_gr"), F.col("gc").alias("_gc"), F.col("key").alias("b"))
    meet = (F.col("gr") == F.col("_gr")) & (F.col("gc") == F.col("_gc"))
    for k in keys:
        meet &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    edges = right.unionByName(below).join(starts, meet).select("a", "b")
    roots = components(edges)
    out = keyed.join(roots, keyed["key"] == roots["node"], "left").withColumn("label", F.coalesce("root", "key"))
    return out.select(*keys, "gr", "gc", (F.col("label.key") if keys else F.col("label")).alias("label"))
