"""Embedding near-dedup by cross-polytope hashing: fast Hadamard rotations, multiprobe buckets, verified pairs.

Buckets hold hashes of vectors and short sign codes, not the vectors. Rows of a bucket with near codes are candidates;
what candidates join is a cluster, to which each vector goes once, to be compared in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.common import components, needs, pair_blocks, runs_of, stored
from rasterloom.llm.simhash import _expand, spanning
from rasterloom.llm.vectors import matrix, unit, usable

TABLES, PROBES = 6, 2
#: Of the sign codes: at a cosine of 0.95 two differ in 13 of 128 bits, with a deviation of 3.4; independent ones in 64.
CODE_BITS, CODE_NEAR = 128, 30
PAIRS = 200_000  # looked at together


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        pairs = x.reshape(n, -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def buckets(x: np.ndarray, tables: int = TABLES, probes: int = PROBES, seed: int = 5) -> np.ndarray:
    """The buckets, shape (rows, tables, 1 + probes), of unit vectors: their own and then the likeliest others.

    A hash is the nearest signed axis after three rounds of random signs and a Hadamard transform; a bucket joins two
    hashes. Each probe takes the second nearest axis in one of them, the probe with the smaller loss first.
    """
    n, d = x.shape
    width = 1 << max(1, (d - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - d)))
    out = np.zeros((n, tables, 1 + probes), np.int32)
    rng = np.random.default_rng(seed)
    for t in range(tables):
        best, loss = [], []
        for _ in range(2):
            y = x
            for signs in rng.choice([-1.0, 1.0], (3, width)):
                y = hadamard(y * signs)
            size = np.abs(y)
            near = np.argsort(-size, axis=1, kind="stable")[:, : 1 + probes]
            best.append(2 * near + (np.take_along_axis(y, near, 1) < 0))
            top = np.take_along_axis(size, near, 1)
            loss.append(top[:, :1] - top)
        a, b = best
        out[:, t, 0] = a[:, 0] * 2 * width + b[:, 0]
        others = np.concatenate([a[:, 1:] * 2 * width + b[:, :1], a[:, :1] * 2 * width + b[:, 1:]], axis=1)
        order = np.argsort(np.concatenate([loss[0][:, 1:], loss[1][:, 1:]], axis=1), axis=1, kind="stable")[:, :probes]
        out[:, t, 1:] = np.take_along_axis(others, order, 1)
    return out


def _verified(x: np.ndarray, ranges: np.ndarray, least: float, chunk: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, range number) of the pairs in ranges (lo_a, hi_a, lo_b, hi_b) with a cosine of ``least`` or more."""
    size = (ranges[:, 1] - ranges[:, 0]) * (ranges[:, 3] - ranges[:, 2])
    large = size > 4096
    for k in np.flatnonzero(large):
        lo_a, hi_a, lo_b, hi_b = ranges[k]
        for at in range(lo_a, hi_a, 512):
            near = x[at : min(at + 512, hi_a)] @ x[lo_b:hi_b].T >= least
            a, b = np.nonzero(near)
            a, b = a + at, b + lo_b
            keep = (a < b) if lo_a == lo_b else np.ones(len(a), bool)
            yield a[keep], b[keep], np.full(int(keep.sum()), k)
    small = np.flatnonzero(~large)
    for part in np.array_split(small, 1 + int(size[small].sum()) // chunk):
        if not len(part):
            continue
        lo_a, hi_a, lo_b, hi_b = ranges[part].T
        a, b = _expand(lo_a, hi_a - lo_a, lo_b, hi_b - lo_b)
        which = np.repeat(part, size[part])
        keep = (np.repeat(lo_a != lo_b, size[part]) | (a < b))
        a, b, which = a[keep], b[keep], which[keep]
        near = np.einsum("ij,ij->i", x[a], x[b]) >= least
        yield a[near], b[near], which[near]


def sign_codes(x: np.ndarray, seed: int = 6) -> np.ndarray:
    """(rows, 2) words: on which side of CODE_BITS random planes each vector lies."""
    planes = np.random.default_rng(seed).normal(size=(x.shape[1], CODE_BITS))
    return np.packbits(x @ planes > 0, axis=1).view(np.int64)


def near_roots(codes: np.ndarray, run: np.ndarray, end: np.ndarray, budget: int) -> np.ndarray:
    """For each code the smallest number of those that near codes of its run (run to end) connect it to."""
    root, words = np.arange(len(codes)), codes.view(np.uint64)

    def fold(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal root
        near = np.bitwise_count(words[a] ^ words[b]).sum(axis=1) <= budget
        if near.any():
            root = spanning(root[a[near]], root[b[near]], len(root))[root]

    long = end - run > 64
    for lo, hi in zip(run[long].tolist(), end[long].tolist(), strict=True):
        for at in range(lo, hi):  # rows that are joined to this one already need no look
            rest = np.arange(at + 1, hi)
            rest = rest[root[rest] != root[at]]
            if len(rest):
                fold(np.full(len(rest), at), rest)
    lo = np.concatenate([np.arange(a, b) for a, b in zip(run[~long], end[~long], strict=True)] or [np.zeros(0, np.int64)])
    after = np.repeat(end[~long], (end - run)[~long]) - lo - 1
    size = np.cumsum(after)
    for part in np.split(np.arange(len(lo)), np.searchsorted(size, np.arange(PAIRS, size[-1] if len(size) else 0, PAIRS))):
        if len(part):
            fold(*_expand(lo[part], np.ones(len(part), np.int64), lo[part] + 1, after[part]))
    return root


def embedding_links(
    vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = 1024, bucket_rows: int = 8192
) -> DataFrame:
    """One row per row of vectors: its id, n_links, component_id and kept.

    Two vectors that share a bucket, their own or a probed one, in a table and whose sign codes differ in at most
    CODE_NEAR bits are candidates; candidates that reach each other are a cluster, whose vectors are compared in double
    precision and linked at a cosine of ``least`` or more. n_links counts the other rows linked directly;
    component_id is the smallest id that links reach; kept is whether that is the row's own. Equal vectors are one
    representative with a weight, so copies never meet pair by pair; a bucket of over ``bucket_rows`` and a cluster of
    over ``block_rows`` rows are cut into block pairs.

    Nulls: rows with a null id, and vectors that are null, zero or hold null or non-finite components, link with
    nothing (n_links 0, their own component). Vectors of different lengths link with nothing of another length. Rows
    that repeat an id are one node of the components; rows that repeat a vector are linked copies. An empty table
    gives no rows. Other columns are not read.
    """
    needs(vectors, id_col, vector_col)
    if not 0.9 <= least <= 1:
        raise ValueError("least is from 0.9 to 1; the hashes and codes are made for it")
    kind = dict(vectors.dtypes)[id_col]
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).withColumn("ok", usable(F.col("v")) & F.col("id").isNotNull())
    good = rows.filter("ok")
    distinct = stored(good.groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m")).withColumn("h", F.xxhash64("v")), "vectors")
    in_bucket, in_cluster = ["dim", "bucket", "block_i", "block_j"], ["dim", "cluster", "block_i", "block_j"]

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["v"].map(len)):
                x = unit(matrix(part["v"]))
                at, code = buckets(x), sign_codes(x)
                n, tables, each = at.shape
                at = at.astype(np.int64) + (np.arange(tables, dtype=np.int64) << 32)[:, None]
                yield pd.DataFrame({
                    "dim": int(dim), "bucket": at.reshape(-1), "h": np.repeat(part["h"].to_numpy(), tables * each),
                    "c1": np.repeat(code[:, 0], tables * each), "c2": np.repeat(code[:, 1], tables * each),
                })

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in runs_of(batches, in_bucket, 25_000):
            key, h = part[in_bucket].to_numpy(), part["h"].to_numpy()
            run = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
            end = np.append(run[1:], len(key))
            some = end - run > 1
            root = near_roots(part[["c1", "c2"]].to_numpy(), run[some], end[some], CODE_NEAR)
            at = np.flatnonzero(root != np.arange(len(root)))
            if len(at):
                yield pd.DataFrame({"a": h[at], "b": h[root[at]]})

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in runs_of(batches, in_cluster, 4096):
            part = part.sort_values([*in_cluster, "block"], ignore_index=True)
            key = part[[*in_cluster, "block"]].to_numpy()
            run = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
            end = np.append(run[1:], len(key))
            inner = key[run, 2] == key[run, 3]
            cross = np.flatnonzero(~inner[:-1] & (key[run[:-1], :4] == key[run[1:], :4]).all(axis=1)) if len(run) > 1 else np.array([], int)
            own = inner & (end - run > 1)
            ranges = np.concatenate([np.stack([run, end, run, end], 1)[own], np.stack([run[cross], end[cross], run[cross + 1], end[cross + 1]], 1)])
            weight, counted = part["m"].to_numpy().astype(np.float64), np.zeros(len(part))
            ids, back = np.unique(part["rep"].to_numpy(), return_inverse=True)
            root = np.arange(len(ids))
            for dim in np.unique(key[:, 0]):
                mine = np.flatnonzero(key[:, 0] == dim)  # sorted first by it, so one stretch
                x, first = unit(matrix(part["v"].iloc[mine])), mine[0]
                here = ranges[(ranges[:, 0] >= first) & (ranges[:, 0] <= mine[-1])] - first
                if not len(here):
                    continue
                for a, b, _ in _verified(x, here, least):
                    a, b = a + first, b + first
                    counted += np.bincount(a, weights=weight[b], minlength=len(part)) + np.bincount(b, weights=weight[a], minlength=len(part))
                    root = spanning(root[back[a]], root[back[b]], len(ids))[root]
            tied, some = np.flatnonzero(root != np.arange(len(ids))), np.flatnonzero(counted)
            yield pd.DataFrame({"row": part["rep"].to_numpy()[some], "h": part["h"].to_numpy()[some], "add": counted[some].astype(np.int64), "root": None})
            yield pd.DataFrame({"row": ids[tied], "h": 0, "add": 0, "root": ids[root[tied]]})

    placed = distinct.select("v", "h").mapInPandas(hashed, "dim int, bucket long, h long, c1 long, c2 long")
    dealt = pair_blocks(placed, ["dim", "bucket"], "h", bucket_rows).drop("block").repartition(*in_bucket).sortWithinPartitions(*in_bucket)
    clusters = components(dealt.mapInPandas(joined, "a long, b long"))
    of_cluster = stored(distinct.join(clusters.withColumnsRenamed({"node": "h", "root": "cluster"}), "h").withColumn("dim", F.size("v")), "clusters")
    crowded = pair_blocks(of_cluster, ["dim", "cluster"], "h", block_rows).repartition(*in_cluster).sortWithinPartitions(*in_cluster)
    found = stored(crowded.mapInPandas(linked, f"row {kind}, h long, add long, root {kind}"), "links")

    counts = stored(found.filter("root IS NULL").groupBy(F.col("row").alias("rep"), "h").agg(F.sum("add").alias("n")), "link-counts")
    copies = good.join(distinct.filter("m > 1").select("v", "rep"), "v").select(F.col("id").alias("a"), F.col("rep").alias("b")).filter("a <> b")
    roots = components(found.filter("root IS NOT NULL").select(F.col("row").alias("a"), F.col("root").alias("b")).unionByName(copies))
    totals = stored(distinct.join(counts, ["rep", "h"], "left").filter("n IS NOT NULL OR m > 1").select("v", "h", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n")), "totals")
    hashed_rows = rows.withColumn("h", F.when(F.col("ok"), F.xxhash64("v")))
    counted_rows = hashed_rows.join(totals.withColumnsRenamed({"v": "_v", "h": "_h"}), (F.col("h") == F.col("_h")) & (F.col("v") == F.col("_v")), "left")
    joined_rows = counted_rows.join(roots, F.when(F.col("ok"), F.col("id")) == F.col("node"), "left")
    component = F.coalesce("root", "id")
    return joined_rows.select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def op3_query(spark, sf_dir: str) -> DataFrame:
    return embedding_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
