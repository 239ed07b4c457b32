"""Labels against tiles and pixels: grid-bucket joins, rasterising, chips."""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.operators.graph import stored


def _cells(low: Column, high: Column, size: int) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def _in_cells(left: DataFrame, right: DataFrame, cell: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Boxes of both sides, (_l0, _t0, _l1, _t1), once in each part of each grid cell that they touch: _cx, _cy, _i, _j.

    A cell with over ``most`` boxes of a side is cut into parts of that side by a hash, and the other side's boxes of the
    cell go to each of them, so any two boxes of a cell meet in one part, however many lie in one place.
    """
    def cells(df: DataFrame) -> DataFrame:
        return df.withColumn("_cx", F.explode(_cells(F.col("_l0"), F.col("_l1"), cell))).withColumn("_cy", F.explode(_cells(F.col("_t0"), F.col("_t1"), cell)))

    sides, crowded = [cells(left), cells(right)], []
    for df, part in zip(sides, ("_gi", "_gj"), strict=True):
        full = df.groupBy("_cx", "_cy").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
        crowded.append(stored(full.select("_cx", "_cy", F.ceil(F.col("_n") / most).cast("int").alias(part)), "crowded-cells"))
    out = []
    for df, own, other, mine, theirs in ((sides[0], "_gi", "_gj", "_i", "_j"), (sides[1], "_gj", "_gi", "_j", "_i")):
        for table in crowded:  # at most a row for each ``most`` boxes
            df = df.join(table, ["_cx", "_cy"], "left")
        parts = F.coalesce(F.col(own), F.lit(1))
        every = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        df = df.withColumn(mine, F.pmod(F.xxhash64("_salt"), parts).cast("int")).withColumn(theirs, F.explode(every))
        out.append(df.drop("_gi", "_gj", "_salt"))
    return out[0], out[1]


def tile_label_join(windows: DataFrame, labels: DataFrame, cell: int = 256, most: int = 20_000) -> DataFrame:
    """windows with each of labels(label_id, x0, y0, x1, y1) that meets them; a shared edge counts.

    Both sides are dealt to the grid cells that they touch and joined on the cell, so no side is compared as a whole;
    a pair that meets in several cells counts in the first one only. Cells with over ``most`` boxes of a side are cut up.
    """
    left = windows.withColumns({
        "_l0": F.col("col_off"), "_t0": F.col("row_off"), "_l1": F.col("col_off") + F.col("win_width"), "_t1": F.col("row_off") + F.col("win_height"),
        "_salt": F.monotonically_increasing_id(),
    })
    right = labels.withColumns({"_l0": F.col("x0"), "_t0": F.col("y0"), "_l1": F.col("x1"), "_t1": F.col("y1"), "_salt": F.monotonically_increasing_id()})
    left, right = _in_cells(left, right, cell, most)
    right = right.drop("_l0", "_t0", "_l1", "_t1")
    meet = (F.col("x0") <= F.col("_l1")) & (F.col("x1") >= F.col("_l0")) & (F.col("y0") <= F.col("_t1")) & (F.col("y1") >= F.col("_t0"))
    first = (F.col("_cx") == F.floor(F.greatest("x0", "_l0") / cell)) & (F.col("_cy") == F.floor(F.greatest("y0", "_t0") / cell))
    found = left.join(right, ["_cx", "_cy", "_i", "_j"]).filter(meet & first)
    return found.drop("_cx", "_cy", "_i", "_j", "_l0", "_t0", "_l1", "_t1")


def rasterize(labels: DataFrame, width: int, height: int, all_touched: bool = False) -> DataFrame:
    """(r, c) of the pixels that a label box covers: by their centre, or with all_touched by any part.

    Each label makes only the pixels of its own box, so work follows the labels' areas and not the scene.
    """
    def span(low: Column, high: Column, most: int) -> Column:
        if all_touched:
            first, last = F.floor(low), F.ceil(high) - 1
        else:
            first, last = F.ceil(low - 0.5), F.ceil(high - 0.5) - 1
        first, last = F.greatest(first, F.lit(0)), F.least(last, F.lit(most - 1))
        return F.when(last >= first, F.sequence(first.cast("int"), last.cast("int"))).otherwise(F.array().cast("array<int>"))

    rows = labels.select(F.explode(span(F.col("y0"), F.col("y1"), height)).alias("r"), "x0", "x1")
    return rows.select("r", F.explode(span(F.col("x0"), F.col("x1"), width)).alias("c")).distinct()


_RUN = pa.struct([("r", pa.int64()), ("c0", pa.int64()), ("c1", pa.int64())])


def _expanded(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers first .. last of each row, one after the other, and the row of each."""
    n = np.maximum(last - first + 1, 0)
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[of], of


def scanline_runs(rings: pa.ListArray, width: int | None, height: int | None, all_touched: bool) -> pa.ListArray:
    """For each polygon of a column the runs (r, c0, c1) of unit cells that it covers, by an edge table of all polygons.

    Each edge gives its crossing with the middle of each row that it passes; crossings of a row, sorted, begin and end
    runs in turn. With all_touched each edge also gives the columns that it passes or touches in a row. So the work
    follows the vertices and the runs; a run may meet another one of its polygon.
    """
    parts = pc.fill_null(pc.list_value_length(rings), 0).to_numpy()
    flat = rings.flatten()
    lengths = pc.fill_null(pc.list_value_length(flat), 0).to_numpy()
    points = flat.flatten()
    x, y = (points.field(k).to_numpy(zero_copy_only=False).astype(float) for k in ("x", "y"))
    ring = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.flatnonzero(ring[1:] == ring[:-1]) if len(ring) else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(parts)), parts)[ring[begin]]
    px, py, qx, qy = x[begin], y[begin], x[begin + 1], y[begin + 1]
    low, high = np.minimum(py, qy), np.maximum(py, qy)

    def rows(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, last = first.astype(np.int64), last.astype(np.int64)
        return _expanded(first if height is None else np.maximum(first, 0), last if height is None else np.minimum(last, height - 1))

    r, e = rows(np.ceil(low - 0.5), np.ceil(high - 0.5) - 1)
    at = (qx[e] - px[e]) * (r + 0.5 - py[e]) / (qy[e] - py[e]) + px[e]
    order = np.lexsort((at, r, of[e]))
    polygon, r, at = of[e][order], r[order], at[order]
    last = np.append((polygon[1:] != polygon[:-1]) | (r[1:] != r[:-1]), True) if len(r) else np.zeros(0, bool)
    ends = np.flatnonzero(last)
    from_right = np.repeat(ends, np.diff(np.append(-1, ends))) - np.arange(len(r))
    left = np.flatnonzero(from_right % 2 == 1)
    runs = [(polygon[left], r[left], np.ceil(at[left] - 0.5), np.ceil(at[left + 1] - 0.5) - 1)]
    if all_touched:
        r, e = rows(np.ceil(low) - 1, np.floor(high))
        level = qy[e] == py[e]
        rise = np.where(level, 1.0, qy[e] - py[e])
        t0, t1 = (np.where(level, k, (edge - py[e]) / rise) for k, edge in ((0.0, np.clip(r, low[e], high[e])), (1.0, np.clip(r + 1, low[e], high[e]))))
        x0, x1 = px[e] + t0 * (qx[e] - px[e]), px[e] + t1 * (qx[e] - px[e])
        runs.append((of[e], r, np.ceil(np.minimum(x0, x1)) - 1, np.floor(np.maximum(x0, x1))))
    polygon, r, c0, c1 = (np.concatenate(c).astype(np.int64) for c in zip(*runs, strict=True))
    if width is not None:
        c0, c1 = np.maximum(c0, 0), np.minimum(c1, width - 1)
    some = np.flatnonzero(c1 >= c0)
    some = some[np.argsort(polygon[some], kind="stable")]
    offsets = np.append(0, np.cumsum(np.bincount(polygon[some], minlength=len(parts))))
    values = pa.StructArray.from_arrays([pa.array(v[some]) for v in (r, c0, c1)], fields=list(_RUN))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def covered_cells(shapes: DataFrame, keys: list[str] | None = None, width: int | None = None, height: int | None = None, all_touched: bool = False) -> DataFrame:
    """(keys, r, c), each once, of the unit cells that polygons(keys, rings) cover: by their centre, or all they touch.

    A centre is covered by the even-odd rule over all rings of its polygon, so holes are cut; rings are closed. Runs of
    cells come from scanlines over Arrow arrays of many polygons at once, clipped to the scene where that has a size.
    """
    keys = keys or []

    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield scanline_runs(batch, width, height, all_touched)

    udf = F.arrow_udf(of, "array<struct<r:bigint,c0:bigint,c1:bigint>>")
    runs = shapes.select(*keys, F.explode(udf(F.col("rings"))).alias("run"))
    return runs.select(*keys, F.col("run.r").alias("r"), F.explode(F.sequence("run.c0", "run.c1")).alias("c")).distinct()


def rasterize_rings(shapes: DataFrame, width: int, height: int, all_touched: bool = False) -> DataFrame:
    """(r, c) of the scene's pixels that shapes cover, by their centre or with all_touched by any part, edges included.

    A shape is a row of ``rings``, the outer one and its holes, or of one closed ``ring``.
    """
    if "rings" not in shapes.columns:
        shapes = shapes.withColumn("rings", F.array("ring"))
    return covered_cells(shapes, [], width, height, all_touched).select(F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"))


def positive_pixels(windows: DataFrame, pixels: DataFrame, cell: int = 64) -> DataFrame:
    """windows with the number of label pixels (r, c) in each; pixels are summed per cell row before they meet windows."""
    runs = pixels.groupBy("r", F.floor(F.col("c") / cell).alias("_cx")).agg(F.collect_list("c").alias("_cs"))
    spread = windows.withColumn("r", F.explode(F.sequence(F.col("row_off"), F.col("row_off") + F.col("win_height") - 1))).withColumn(
        "_cx", F.explode(_cells(F.col("col_off"), F.col("col_off") + F.col("win_width") - 1, cell))
    )
    inside = F.size(F.filter("_cs", lambda c: (c >= F.col("col_off")) & (c < F.col("col_off") + F.col("win_width"))))
    return (
        spread.join(runs, ["r", "_cx"], "left").groupBy(*windows.columns)
        .agg(F.coalesce(F.sum(F.when(F.col("_cs").isNotNull(), inside)), F.lit(0)).alias("positive_pixels"))
    )


def chip_summary(counted: DataFrame, tile_size: int, min_positive: int, keep_empty: bool) -> DataFrame:
    """Counters of an export: windows, partial, kept, positive and empty chips. keep_empty: all or none of the empty."""
    partial = (F.col("win_width") < tile_size) | (F.col("win_height") < tile_size)
    enough = F.col("positive_pixels") >= min_positive
    return counted.groupBy().agg(
        F.count(F.lit(1)).alias("windows"), F.count_if(partial).alias("partial"), F.count_if(~partial & (enough | F.lit(keep_empty))).alias("chips"),
        F.count_if(~partial & enough).alias("positive"), F.count_if(~partial & ~enough & F.lit(keep_empty)).alias("empty"),
    )


def chip_split(counted: DataFrame, min_positive: int, empty_fraction: float, val_fraction: float, seed: int, scene: str | None = None) -> DataFrame:
    """counted(chip_idx, positive_pixels) with split: train, val, or dropped.

    The draws of a scene follow its chips' order from one generator of the seed: chips under ``min_positive`` draw
    first whether they stay, then each that stays draws its split. A task decides a scene, from two numbers a chip;
    ``scene`` names the column that tells scenes apart, without it all chips are one scene's.
    """
    keys = [scene] if scene else []

    def of(part: pd.DataFrame) -> pd.DataFrame:
        rng, splits = random.Random(seed), []
        part = part.sort_values("chip_idx")
        for positive in part["positive_pixels"]:
            kept = positive >= min_positive or rng.random() <= empty_fraction
            splits.append(("val" if rng.random() < val_fraction else "train") if kept else "dropped")
        return part[[*keys, "chip_idx"]].assign(split=splits)

    kinds = dict(counted.dtypes)
    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keys], f"chip_idx {kinds['chip_idx']}", "split string"])
    decided = counted.select(*keys, "chip_idx", "positive_pixels").groupBy(*keys).applyInPandas(of, schema)
    return counted.join(decided, [*keys, "chip_idx"])


def paired_chips(images: DataFrame, masks: DataFrame) -> DataFrame:
    """images(stem, ...) with the masks(stem, ...) of the same stem; an image without a mask is an error, told by name."""
    pairs = images.join(masks.withColumn("_has", F.lit(True)), "stem", "left")
    missing = F.raise_error(F.concat(F.lit("no mask for "), F.col("stem"))).cast("boolean")
    return pairs.filter(F.coalesce(F.col("_has"), missing)).drop("_has")
