import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rasterloom.operators import batches, morphology, pixels
from rasterloom.operators import blocks as B


def blocks_of(spark, grids, size, kind="u1"):
    rows = []
    for scene, grid in grids.items():
        for by in range(-(-grid.shape[0] // size)):
            for bx in range(-(-grid.shape[1] // size)):
                part = grid[by * size : (by + 1) * size, bx * size : (bx + 1) * size]
                rows.append((scene, by, bx, *part.shape, np.ascontiguousarray(part).astype(kind).tobytes()))
    return spark.createDataFrame(rows, B.BLOCKS)


def grids_of(blocks, shapes, size, kind="u1"):
    out = {k: np.full(s, 99, np.float64) for k, s in shapes.items()}
    for b in blocks.collect():
        part = np.frombuffer(bytes(b.data), kind).reshape(b.height, b.width)
        out[b.scene][b.by * size : b.by * size + b.height, b.bx * size : b.bx * size + b.width] = part
    return out


def slow_spread(mask, grow):
    wide = np.pad(mask.astype(bool), 1)
    near = [wide[1 + r : wide.shape[0] - 1 + r, 1 + c : wide.shape[1] - 1 + c] for r in (-1, 0, 1) for c in (-1, 0, 1)]
    return np.any(near, axis=0) if grow else np.all(near, axis=0)


def masks(share=0.4):
    rng = np.random.default_rng(3)
    return {k: (rng.random(s) < share).astype(np.uint8) for k, s in {"a": (37, 53), "b": (16, 16), None: (5, 70), "one": (1, 1)}.items()}


@pytest.mark.parametrize("size", [8, 16, 64])
def test_kernels_over_blocks_equal_whole_grids(spark, size):
    grids = masks(0.15)
    shapes = {k: g.shape for k, g in grids.items()}
    made = blocks_of(spark, grids, size)
    for name, steps in (("dilated", "gg"), ("eroded", "ss"), ("closed", "ggss")):
        start = masks(0.9) if name == "eroded" else grids
        made = blocks_of(spark, start, size)
        got = grids_of(getattr(B, name)(made, 2, size=size), shapes, size)
        for k, g in start.items():
            for step in steps:
                g = slow_spread(g, step == "g")
            assert np.array_equal(got[k], g), (name, k)
    with pytest.raises(ValueError):
        B.closed(made, size, size=size)


@pytest.mark.parametrize(("size", "limit"), [(8, 5), (16, 40), (64, 12)])
def test_sieve_over_blocks_equals_one_grid(spark, size, limit):
    grids = masks(0.45)
    snake = np.zeros((40, 40), np.uint8)  # one region through many blocks, and a small one over four
    snake[::4], snake[2::4] = 1, 0
    snake[:, 39] = 1
    snake[14:18, 20:22] = 1 - snake[14:18, 20:22]
    grids["snake"], grids["full"] = snake, np.ones((20, 20), np.uint8)
    shapes = {k: g.shape for k, g in grids.items()}
    for value in (0, 1):
        got = grids_of(B.sieved(blocks_of(spark, grids, size), limit, value, size=size), shapes, size)
        for k, g in grids.items():
            assert np.array_equal(got[k], morphology.sieve_grid(g.astype(np.int64), limit, (value,))), (k, value)
    got = grids_of(B.cleanup(blocks_of(spark, {"a": grids["a"]}, size), 1, 6, 9, size=size), shapes, size)["a"]
    g = grids["a"]
    for step in "gs":
        g = slow_spread(g, step == "g")
    assert np.array_equal(got, morphology.sieve_grid(morphology.sieve_grid(g.astype(np.int64), 6, (0,)), 9, (1,)))


def test_a_region_over_four_blocks_is_one(spark):
    grid = np.zeros((16, 16), np.uint8)
    grid[6:10, 6:10] = 1  # four pixels in each of four blocks, 16 in all
    grid[2, 2] = 1
    for limit, left in ((16, 16), (17, 0)):
        assert grids_of(B.sieved(blocks_of(spark, {"s": grid}, 8), limit, 1, size=8), {"s": (16, 16)}, 8)["s"].sum() == left


def test_mosaic_mean_equals_the_long_form_and_moves_less(spark):
    rng = np.random.default_rng(5)
    tiles, total, count = [], np.zeros((94, 130)), np.zeros((94, 130))
    for y, x in ((0, 0), (0, 40), (30, 10), (26, 66), (20, 80)):
        v = rng.random((64, 50)).astype(np.float32)
        tiles.append(("s", y, x, 64, 50, v.ravel().tolist()))
        total[y : y + 64, x : x + 50] += v
        count[y : y + 64, x : x + 50] += 1
    df = spark.createDataFrame(tiles + [("s", 0, 0, 1, 1, None)], "scene string, row_off int, col_off int, height int, width int, values array<float>")
    got = grids_of(B.mosaic_mean(df, size=32), {"s": (94, 130)}, 32, "<f4")["s"]
    with np.errstate(invalid="ignore"):
        want = total / count
    assert np.array_equal(np.isnan(got), np.isnan(want)) and np.nanmax(np.abs(got - want)) < 1e-6
    long = B.to_pixels(B.thresholded(B.mosaic_mean(df, size=32), 0.5), size=32)
    assert long.filter("v = 1").count() == int((np.nan_to_num(got, nan=-1) >= np.float32(0.5)).sum())


def shuffled(spark, df):
    """Bytes that a job's stages write for shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    before = store.executorSummary("driver").totalShuffleWrite()
    df.write.format("noop").mode("overwrite").save()
    return store.executorSummary("driver").totalShuffleWrite() - before


def test_closing_moves_a_tenth_of_the_bytes_of_the_long_form(spark):
    grid = (np.random.default_rng(8).random((512, 512)) < 0.3).astype(np.uint8)
    made = blocks_of(spark, {"s": grid}, 128)
    r, c = np.nonzero(grid)
    long = spark.createDataFrame(pd.DataFrame({"tile_id": "s", "r": r, "c": c}))
    sizes = spark.createDataFrame([("s", 512, 512)], "tile_id string, height int, width int")
    few, many = shuffled(spark, B.closed(made, 1, size=128)), shuffled(spark, morphology.close(long, sizes, 1))
    assert 0 < 10 * few < many, (few, many)


@pytest.mark.parametrize(("rows", "cols"), [(80, 41), (20, 20), (1, 7), (33, 150)])
def test_resize_over_blocks_equals_the_long_form(spark, rows, cols):
    rng = np.random.default_rng(6)
    grid = rng.random((37, 53)).astype(np.float32)
    made = blocks_of(spark, {"s": grid, "gone": grid[:3]}, 16, "<f4")
    sizes = spark.createDataFrame([("s", rows, cols)], "scene string, to_rows long, to_cols long")
    got = grids_of(B.resized(made, sizes, size=16), {"s": (rows, cols), "gone": (1, 1)}, 16, "<f4")["s"]
    long = spark.createDataFrame([("s", r, c, float(grid[r, c])) for r in range(37) for c in range(53)], "tile_id string, r int, c int, v double")
    want = np.zeros((rows, cols))
    for p in pixels.resize_bilinear(long, rows, cols).collect():
        want[p.r, p.c] = p.v
    assert np.abs(got - want).max() < 1e-6


def test_empty_tables(spark):
    none = spark.createDataFrame([], B.BLOCKS)
    assert B.closed(none, 1).count() == B.sieved(none, 5, 1).count() == B.thresholded(none, 0.5).count() == 0
    assert B.to_pixels(none).filter(F.col("v") == 1).count() == 0


def test_tasks_hold_few_blocks_at_a_time(spark):
    def of(frames):
        for f in frames:
            yield pd.DataFrame({"n": [len(f)], "data": [None if f["data"].isna().all() else f["data"].iloc[0]]})

    rows = spark.range(2000).selectExpr("id", "cast(repeat('x', 100) as binary) AS data").coalesce(1)
    got = batches.map_slices(rows, of, "n long, data binary", 300).collect()
    assert sum(r["n"] for r in got) == 2000 and max(r["n"] for r in got) == 300 and bytes(got[0]["data"]) == b"x" * 100
    tiles = spark.createDataFrame([("s", 0, 0, 2, 2, [1.0, None, 0.0, 1.0]), (None, 0, 0, 1, 1, [1.0])], "scene string, row_off int, col_off int, height int, width int, values array<float>")
    mask = B.cleanup(B.thresholded(B.mosaic_mean(tiles, 4), 1), 1, 0, 2, 4)
    plan = B.to_pixels(mask, size=4)
    assert "MapInPandas" not in plan._jdf.queryExecution().toString()
    assert plan.count() == 5
