"""Pixel algebra on the long form pixels(tile_id, r, c, v): scaling, gates, flips, resizing, thresholds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FLIPS = {"none": (False, False), "hflip": (False, True), "vflip": (True, False), "hvflip": (True, True)}


def by_tile(value: Column, *keys: str) -> Callable[[Callable[[Column], Column]], Column]:
    """A window aggregate of value over each tile (and keys)."""
    return lambda agg: agg(value).over(Window.partitionBy("tile_id", *keys))


def imagery_scale(v: Column) -> Column:
    """Values as 0 to 1: a tile whose largest value (NaN left out) is at most 1 stays, up to 255 is divided by 255, else by it."""
    v = v.cast("double")
    top = by_tile(F.when(~F.isnan(v), v))(F.max)
    return F.when(top <= 1, v).when(top <= 255, v / 255.0).otherwise(v / top)


def normalised(v: Column, mean: float, std: float) -> Column:
    return (v - mean) / std


def sigmoid(v: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-v))


def probability_gate(v: Column, *keys: str) -> Column:
    """A prediction that holds any value outside 0 to 1 goes through the sigmoid as a whole; others stay."""
    over = by_tile(v, *keys)
    return F.when((over(F.min) < 0) | (over(F.max) > 1), sigmoid(v)).otherwise(v)


def foreground_probability(z0: Column, z1: Column) -> Column:
    """The probability of the second of two classes: as it is where a tile holds probabilities already, else softmax."""
    low, high = by_tile(F.least(z0, z1))(F.min), by_tile(F.greatest(z0, z1))(F.max)
    sums = by_tile(F.abs(z0 + z1 - 1) <= 1e-3 + 1e-5)(F.bool_and)
    top = F.greatest(z0, z1)
    return F.when((low >= 0) & (high <= 1) & sums, z1).otherwise(F.exp(z1 - top) / (F.exp(z0 - top) + F.exp(z1 - top)))


def augmentations(names: list[str] | str | None) -> list[str]:
    """The flips asked for, trimmed and in lower case; none where nothing is. Repeats stay, as they weight the mean."""
    given = [names] if isinstance(names, str) else list(names or [])
    out = [x.strip().lower() for x in given] or ["none"]
    if unknown := sorted(set(out) - set(FLIPS)):
        raise ValueError(f"unknown augmentations: {', '.join(unknown)}")
    return out


def with_size(pixels: DataFrame) -> DataFrame:
    """pixels with the height and width of their tile."""
    return pixels.withColumns({"height": by_tile(F.col("r") + 1)(F.max), "width": by_tile(F.col("c") + 1)(F.max)})


def flip_mean(pixels: DataFrame, predict: Callable[[DataFrame], DataFrame], names: list[str] | str | None = None) -> DataFrame:
    """The mean over flips of predict(flipped), flipped back. predict keeps tile_id, aug, r, c and gives p.

    Every flip is an exploded copy with mirrored coordinates, so all run in one plan; flipping is its own inverse.
    """
    flips = F.array(*[
        F.struct(F.lit(k).alias("aug"), F.lit(FLIPS[x][0]).alias("v"), F.lit(FLIPS[x][1]).alias("h"))
        for k, x in enumerate(augmentations(names))
    ])

    def mirrored(df: DataFrame) -> DataFrame:
        return df.withColumns({
            "r": F.when(F.col("_flip.v"), F.col("height") - 1 - F.col("r")).otherwise(F.col("r")),
            "c": F.when(F.col("_flip.h"), F.col("width") - 1 - F.col("c")).otherwise(F.col("c")),
        })

    copies = mirrored(with_size(pixels).withColumn("_flip", F.explode(flips)).withColumn("aug", F.col("_flip.aug")))
    return mirrored(predict(copies)).groupBy("tile_id", "r", "c").agg(F.avg("p").alias("p"))


def _positions(target: int | Column, source: Column) -> Column:
    """The places 0 to source - 1 that ``target`` even steps fall on, first and last on the ends."""
    last = target - 1 if isinstance(target, Column) else F.lit(target - 1)
    step = F.when(last == 0, 0.0).otherwise((source - 1) / last.cast("double"))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(i.alias("i"), (i * step).alias("at")))


def resize_nearest(pixels: DataFrame, height: int, width: int) -> DataFrame:
    """Each target pixel takes the source pixel at the even step rounded half to even."""
    sizes = pixels.groupBy("tile_id").agg((F.max("r") + 1).alias("h"), (F.max("c") + 1).alias("w"))
    grid = (
        sizes.withColumn("y", F.explode(_positions(height, F.col("h"))))
        .withColumn("x", F.explode(_positions(width, F.col("w"))))
        .select(
            "tile_id", F.col("y.i").alias("tr"), F.col("x.i").alias("tc"),
            F.rint("y.at").cast("int").alias("r"), F.rint("x.at").cast("int").alias("c"),
        )
    )
    return grid.join(pixels, ["tile_id", "r", "c"]).select("tile_id", F.col("tr").alias("r"), F.col("tc").alias("c"), "v")


def resize_bilinear(pixels: DataFrame, height: int = 0, width: int = 0, sizes: DataFrame | None = None) -> DataFrame:
    """Corner-aligned bilinear resize, to one height and width or to those of each tile in sizes(tile_id, height, width).

    Along rows of pixels first, then across them. Every source row is one array, so a target row needs its two
    neighbour rows and no per-pixel join. Tiles that sizes doesn't have go.
    """
    rows = pixels.groupBy("tile_id", "r").agg(F.transform(F.sort_array(F.collect_list(F.struct("c", "v"))), lambda x: x["v"].cast("double")).alias("vs"))

    def lerp(values: Column, at: Column) -> Column:
        low = F.floor(at).cast("int")
        a = F.get(values, low)
        return a + (F.get(values, F.least(low + 1, F.size(values) - 1)) - a) * (at - low)

    if sizes is None:
        rows = rows.withColumns({"height": F.lit(height), "width": F.lit(width)})
    else:
        rows = rows.join(sizes.select("tile_id", "height", "width"), "tile_id")
    wide = rows.select("tile_id", "r", "height", F.transform(_positions(F.col("width"), F.size("vs")), lambda p: lerp(F.col("vs"), p["at"])).alias("vs"))
    tiles = wide.groupBy("tile_id").agg(F.first("height").alias("height"), F.transform(F.sort_array(F.collect_list(F.struct("r", "vs"))), lambda x: x["vs"]).alias("rows"))
    tall = tiles.select("tile_id", "rows", F.explode(_positions(F.col("height"), F.size("rows"))).alias("y")).select(
        "tile_id", F.col("y.i").alias("r"), (F.col("y.at") - F.floor("y.at")).alias("part"),
        F.get("rows", F.floor("y.at").cast("int")).alias("top"),
        F.get("rows", F.least(F.floor("y.at").cast("int") + 1, F.size("rows") - 1)).alias("low"),
    )
    mixed = F.zip_with("top", "low", lambda a, b: a + (b - a) * F.col("part"))
    return tall.select("tile_id", "r", F.posexplode(mixed).alias("c", "v"))


def scale_mean(predictions: list[DataFrame]) -> DataFrame:
    """The mean of predictions(tile_id, r, c, v) of several input sizes, each tile resized to its size in the first.

    The first holds the largest. A prediction whose tile has that size already goes in as it is.
    """
    first, *rest = predictions
    sizes = first.groupBy("tile_id").agg((F.max("r") + 1).alias("height"), (F.max("c") + 1).alias("width"))
    every = first.select("tile_id", "r", "c", F.col("v").cast("double").alias("v"))
    for x in rest:
        every = every.unionByName(resize_bilinear(x, sizes=sizes))
    return every.groupBy("tile_id", "r", "c").agg(F.avg("v").alias("v"))


def thresholded(p: Column, threshold: float, kind: str = "float") -> Column:
    """1 where p is at least the threshold, both compared as ``kind`` (single precision, as the rasters hold)."""
    return (p.cast(kind) >= F.lit(threshold).cast(kind)).cast("int")


def threshold_tag(threshold: Column) -> Column:
    """t and the hundredths of a threshold in three digits, rounded half to even."""
    return F.format_string("t%03d", F.rint(threshold * 100).cast("int"))


def sweep(probabilities: DataFrame, thresholds: list[float]) -> DataFrame:
    """probabilities(..., p) under each threshold: threshold, tag and mask. Thresholds that share a tag are an error."""
    tags = [f"t{round(t * 100):03d}" for t in thresholds]
    if len(set(tags)) < len(tags):
        raise ValueError(f"thresholds share tags: {', '.join(tags)}")
    return probabilities.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds)))).withColumns(
        {"tag": threshold_tag(F.col("threshold")), "mask": (F.col("p").cast("float") >= F.col("threshold").cast("float")).cast("int")}
    )


def coverage(masks: DataFrame, most: float = 0.0) -> DataFrame:
    """Each tile's pixels, ones and their share, and whether the share is over ``most`` (0: never)."""
    share = F.sum("mask") / F.count(F.lit(1))
    return masks.groupBy("tile_id").agg(
        F.count(F.lit(1)).alias("pixels"), F.sum("mask").alias("ones"), share.alias("share"), ((share > most) & F.lit(most > 0)).alias("skipped")
    )


def overlap_mean(probabilities: DataFrame) -> DataFrame:
    """The mean of all tiles' p at each place (gr, gc) of the mosaic, and how many there were.

    Partial sums leave each task before the shuffle, so overlapping tiles cost a row per place and task at most.
    """
    return probabilities.groupBy("gr", "gc").agg((F.sum("p") / F.count("p")).alias("p"), F.count("p").alias("n"))
