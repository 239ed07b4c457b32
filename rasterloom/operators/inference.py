"""Model inference over tiles: preprocessing, any predict function in Arrow batches, ONNX models, mean of flips."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import PurePosixPath

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from rasterloom.operators.pixels import FLIPS, augmentations

TILES = "tile_id, height, width and bands: float arrays, row by row, one for each band"


def backend(name: str | None, model_path: str) -> str:
    """The named backend, or the one of the model's suffix: Keras files keras, all others onnx."""
    kinds = ("onnx", "keras", "pytorch")
    chosen = (name or "").strip().lower() or ("keras" if PurePosixPath(model_path).suffix.lower() in (".keras", ".h5", ".hdf5") else "onnx")
    if chosen not in kinds:
        raise ValueError(f"backend must be one of {', '.join(kinds)}")
    return chosen


def input_sizes(sizes: list[int] | int | str) -> list[int]:
    """The sizes, each once, in their order; sizes of 0 or less are an error."""
    given = [int(x) for x in sizes.split(",")] if isinstance(sizes, str) else [sizes] if isinstance(sizes, int) else [int(x) for x in sizes]
    if not given or min(given) <= 0:
        raise ValueError("input sizes must be positive")
    return list(dict.fromkeys(given))


def scaled(image: np.ndarray) -> np.ndarray:
    """A float image (bands, height, width) from 0 to 1, by its largest value that is a number."""
    image = image.astype(np.float32)
    top = float(np.nanmax(image)) if image.size else 0.0
    return image if top <= 1 else image / np.float32(255.0 if top <= 255 else top)


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Corner-aligned bilinear resize of the last two axes: along rows first."""
    def along(x: np.ndarray, n: int) -> np.ndarray:
        at = np.linspace(0, x.shape[-1] - 1, n)
        low = np.floor(at).astype(int)
        part = (at - low).astype(x.dtype)
        return x[..., low] * (1 - part) + x[..., np.minimum(low + 1, x.shape[-1] - 1)] * part

    if image.shape[-2:] == (height, width):
        return image
    return along(along(image, width).swapaxes(-1, -2), height).swapaxes(-1, -2)


def chip_resized(image: np.ndarray, mask: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A training chip at another size: the image bilinear between pixel centres, the mask by its nearest pixel."""
    def along(x: np.ndarray, n: int) -> np.ndarray:
        at = np.clip((np.arange(n) + 0.5) * x.shape[-1] / n - 0.5, 0, x.shape[-1] - 1)
        low = np.floor(at).astype(int)
        part = (at - low).astype(x.dtype)
        return x[..., low] * (1 - part) + x[..., np.minimum(low + 1, x.shape[-1] - 1)] * part

    rows, cols = (np.floor(np.arange(size) * n / size).astype(int) for n in mask.shape)
    return along(along(image, size).swapaxes(-1, -2), size).swapaxes(-1, -2), mask[np.ix_(rows, cols)]


def plane(output: np.ndarray) -> np.ndarray:
    """One probability plane of a model's output: a plane as it is, of two classes the softmax of the second.

    The class axis is the first if it has one or two entries, else the last. Values outside 0 to 1 put the whole plane
    through the sigmoid.
    """
    x = np.squeeze(np.asarray(output, np.float32))
    if x.ndim == 3:
        x = x if x.shape[0] in (1, 2) else np.moveaxis(x, -1, 0)
        if x.shape[0] > 2:
            raise ValueError(f"expected one or two classes, not {x.shape[0]}")
        if x.shape[0] == 2:
            ready = x.min() >= 0 and x.max() <= 1 and np.allclose(x.sum(0), 1, atol=1e-3)
            e = np.exp(x - x.max(0))
            x = x[1] if ready else (e / e.sum(0))[1]
        else:
            x = x[0]
    if x.ndim != 2:
        raise ValueError(f"unsupported output shape {np.shape(output)}")
    return 1 / (1 + np.exp(-x)) if x.size and (x.min() < 0 or x.max() > 1) else x


def infer(
    tiles: DataFrame, predict: Callable[[np.ndarray], np.ndarray] | Callable[[], Callable], sizes: list[int] | int | str | None = None,
    flips: list[str] | str | None = None, mean: float = 0.0, std: float = 1.0, channels_last: bool = False, lazy: bool = False,
) -> DataFrame:
    """tiles' probability planes as (tile_id, height, width, p), by predict(batch of one, NCHW or NHWC) -> output.

    The planes of all flips of an input size are averaged, resized to the largest size, averaged again over the sizes
    and resized to the tile. With ``lazy``, predict is a function that makes the predictor, called once per worker.
    """
    names, wanted = augmentations(flips), sorted(input_sizes(sizes), reverse=True) if sizes else [None]
    kind = dict(tiles.dtypes)["tile_id"]

    def one(run: Callable, image: np.ndarray, size: int | None) -> np.ndarray:
        x = (resized(scaled(image), size, size) if size else scaled(image)) - np.float32(mean)
        x, out = (x / np.float32(std)).astype(np.float32), []
        for name in names:
            axes = tuple(a for a, on in zip((-2, -1), FLIPS[name], strict=True) if on)
            turned = np.ascontiguousarray(np.flip(x, axes))[None]
            out.append(np.flip(plane(run(np.moveaxis(turned, 1, -1) if channels_last else turned)), axes))
        return np.mean(np.stack(out), axis=0, dtype=np.float32)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run = predict() if lazy else predict
        for batch in batches:
            rows = []
            for t in batch.itertuples(index=False):
                image = np.stack([np.asarray(b, np.float32) for b in t.bands]).reshape(len(t.bands), t.height, t.width)
                planes = [one(run, image, s) for s in wanted]
                p = np.mean(np.stack([resized(x, *planes[0].shape) for x in planes]), axis=0, dtype=np.float32)
                rows.append((t.tile_id, t.height, t.width, resized(p, t.height, t.width).ravel()))
            yield pd.DataFrame(rows, columns=["tile_id", "height", "width", "p"])

    return tiles.select("tile_id", "height", "width", "bands").mapInPandas(work, f"tile_id {kind}, height int, width int, p array<float>")


@lru_cache(4)
def _session(path: str):
    import onnxruntime

    return onnxruntime.InferenceSession(path, providers=["CPUExecutionProvider"])


def onnx_predictor(path: str, output: str | None = None) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """For infer(..., lazy=True): a model that each worker loads once, its first or a named output."""
    def make() -> Callable[[np.ndarray], np.ndarray]:
        session = _session(path)
        name = session.get_inputs()[0].name
        return lambda x: session.run([output] if output else None, {name: x})[0]

    return make


def long_form(planes: DataFrame) -> DataFrame:
    """Planes (tile_id, height, width, p) as pixels (tile_id, r, c, p)."""
    return planes.selectExpr("tile_id", "width", "posexplode(p) AS (i, p)").selectExpr("tile_id", "i DIV width AS r", "i % width AS c", "p")


def blocked_form(pixels: DataFrame) -> DataFrame:
    """Dense pixels (tile_id, band, r, c, v) as tiles with one float array for each band."""
    bands = pixels.groupBy("tile_id", "band").agg(
        *[e for e in _exprs("max(r) + 1 AS height", "max(c) + 1 AS width", "transform(array_sort(collect_list(struct(r, c, v))), x -> cast(x.v AS float)) AS vs")]
    )
    return bands.groupBy("tile_id").agg(*_exprs("max(height) AS height", "max(width) AS width", "transform(array_sort(collect_list(struct(band, vs))), x -> x.vs) AS bands"))


def _exprs(*text: str):
    from pyspark.sql import functions as F

    return [F.expr(x) for x in text]
