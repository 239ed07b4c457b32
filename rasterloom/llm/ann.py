"""Approximate nearest neighbours by multi-index hashing over learned rotated binary codes, reranked by floats."""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm.common import needs
from rasterloom.llm.vectors import matrix, usable

BITS, PART = 256, 8  # of a code, and of each of its substrings


def learn_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = 25, seed: int = 3) -> np.ndarray:
    """A matrix (dim, bits) whose signs of x @ matrix are the code: stacked rotations, each fitted to the sample.

    Each starts from a random rotation of the principal axes and then alternates between the signs and the rotation
    that brings the sample closest to them (orthogonal Procrustes), which lessens the loss of taking signs.
    """
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    axes = np.linalg.eigh(sample.T @ sample)[1][:, ::-1] if len(sample) else np.eye(dim)
    keep = min(dim, bits)
    x, parts = sample @ axes[:, :keep], []
    for _ in range(math.ceil(bits / keep)):
        r = np.linalg.qr(rng.normal(size=(keep, keep)))[0]
        for _ in range(rounds if len(sample) else 0):
            u, _, vt = np.linalg.svd(x.T @ np.where(x @ r > 0, 1.0, -1.0))
            r = u @ vt
        parts.append(axes[:, :keep] @ r)
    return np.concatenate(parts, axis=1)[:, :bits]


def codes(x: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """The code of each row as bytes, one substring each."""
    return np.packbits(x @ rotation > 0, axis=1)


class MultiIndex:
    """The rows of each value of each substring; finds every code within a Hamming radius by the pigeonhole rule.

    A code within radius r of the query is within floor(r / m) of it in at least one of the m substrings, so the
    values that near are probed in each substring and what they hold is compared in full.
    """

    def __init__(self, rows: np.ndarray):
        self.rows, (self.n, self.m) = np.ascontiguousarray(rows), rows.shape
        self.words = np.pad(self.rows, ((0, 0), (0, -self.m % 8))).view(np.uint64)
        self.order = np.argsort(rows, axis=0, kind="stable").T
        self.start = np.stack([np.searchsorted(rows[self.order[k], k], np.arange(257)) for k in range(self.m)])
        self.masks = [
            np.array([sum(1 << b for b in at) for r in range(near + 1) for at in combinations(range(8), r)], np.int64) for near in range(9)
        ]

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """The numbers of the rows within the radius."""
        near = min(8, radius // self.m)
        values = query[:, None].astype(np.int64) ^ self.masks[near]
        table = np.arange(self.m)[:, None]
        lo, hi = self.start[table, values], self.start[table, values + 1]
        length = (hi - lo).ravel()
        base = (lo + table * self.n).ravel()
        at = np.repeat(base - np.cumsum(length) + length, length) + np.arange(length.sum())
        candidate = np.zeros(self.n, bool)
        candidate[self.order.ravel()[at]] = True
        rows = np.flatnonzero(candidate)
        q = np.pad(query, (0, -self.m % 8)).view(np.uint64)
        return rows[np.bitwise_count(self.words[rows] ^ q).sum(axis=1) <= radius]


@dataclass(frozen=True)
class CodeModel:
    rotation: np.ndarray
    longest: float  # the largest norm of all rows

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Unit vectors whose angles order by inner product: rows get what their norm lacks as one more component."""
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest**2 - (x * x).sum(axis=1), 0))
        return np.concatenate([x, rest[:, None]], axis=1)


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The inner product of each row of x with that of q, summed in the order of the components.

    A matrix product's last bits depend on where a row stands; here equal rows have equal scores, wherever they are.
    """
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += x[:, k] * q[:, k]
    return total


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    sample_rows: int = 8000, block_rows: int = 4096, query_rows: int = 16_384, rerank: int | None = 256,
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` rows found with the largest inner product.

    Every row is indexed; the rotation is learned on at most ``sample_rows`` rows (the first by a hash of the id).
    Rows and queries are dealt to blocks; in each, the Hamming radius grows until it holds ``rerank`` codes (more than
    ``k`` at least), all codes within it are retrieved and their inner products taken in double precision on the
    original vectors. With ``rerank=None`` the radius takes in the whole block, which makes the search exact.

    Nulls: rows with a null id and vectors that are null, zero or hold null or non-finite components take no part.
    Vectors of each length have a rotation and blocks of their own and are searched among themselves. A query isn't
    its own neighbour, and rows that repeat its id aren't either. Ties, to the last bit of a sum taken in the order
    of the components, go to the smaller id; rows that repeat an id count as separate candidates. No queries or no
    candidates: no rows. Other columns are not read.
    """
    needs(vectors, id_col, vector_col)
    kind = dict(vectors.dtypes)[id_col]
    rows = (
        vectors.withColumn("_is_query", F.coalesce(is_query, F.lit(False)))
        .select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), "_is_query")
        .filter(F.col("id").isNotNull() & usable(F.col("v")))
    )
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    facts = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.count_if("_is_query").alias("q"), F.max(norm2).alias("top"))
    found = None
    for dim, n, n_queries, top in facts.filter("q > 0").orderBy("dim").collect():  # a row for each length of vectors
        one = _of_one_length(rows.filter(F.size("v") == dim), kind, n, n_queries, top, k, sample_rows, block_rows, query_rows, rerank)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return vectors.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _of_one_length(
    rows: DataFrame, kind: str, n: int, n_queries: int, top: float, k: int, sample_rows: int, block_rows: int, query_rows: int, rerank: int | None
) -> DataFrame:
    """(query_id, vec_id, score): the ``k`` best rows of every block for each query."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toPandas()
    longest = math.sqrt(top) * (1 + 1e-12)
    base = CodeModel(np.zeros((0, 0)), longest)
    model = CodeModel(learn_rotation(base.lifted(matrix(sample["v"]), False) / longest), longest)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # as many numbers as a vector's length times BITS
    n_row, n_query = max(1, math.ceil(n / block_rows)), max(1, math.ceil(n_queries / query_rows))
    block = lambda count: F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    kept = rows.select("id", "v", block(n_row).alias("rb"), every(n_query).alias("qb"))
    asked = rows.filter("_is_query").select("id", "v", block(n_query).alias("qb"), every(n_row).alias("rb"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        m = shared.value
        x, q = matrix(left["v"]), matrix(right["v"])
        ids, asked_ids = left["id"].to_numpy(), right["id"].to_numpy()
        index = MultiIndex(codes(m.lifted(x, False), m.rotation))
        wanted = len(x) if rerank is None else min(max(rerank, k + 1), len(x))
        query_codes = codes(m.lifted(q, True), m.rotation)
        radius, who, hit = BITS // 2 - 16, [], []
        size = np.linalg.norm(q, axis=1) * m.longest
        for at in range(len(q)):
            near = index.within(query_codes[at], BITS if wanted == len(x) else radius)
            while len(near) < wanted:
                radius += 3
                near = index.within(query_codes[at], radius)
            if len(near) > 2 * wanted:
                radius -= 1  # for the next query
            near = near[ids[near] != asked_ids[at]]
            score = x[near] @ q[at]
            if len(near) > k:  # all that may be among the k best, whatever the rounding of this product
                near = near[score >= np.partition(score, len(score) - k)[len(score) - k] - 1e-10 * size[at]]
            if len(near) > 4 * k:  # ties in great number
                near = near[np.lexsort((ids[near], -exact_scores(x[near], q[at : at + 1])))[:k]]
            who.append(np.full(len(near), at))
            hit.append(near)
        who, hit = np.concatenate(who), np.concatenate(hit)
        score = np.concatenate([exact_scores(x[hit[s : s + 65_536]], q[who[s : s + 65_536]]) for s in range(0, len(hit), 65_536)] or [np.zeros(0)])
        order = np.lexsort((ids[hit], -score, who))
        who, hit, score = who[order], hit[order], score[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        best = place < k
        return pd.DataFrame({"query_id": asked_ids[who[best]], "vec_id": ids[hit[best]], "score": score[best]})

    schema = f"query_id {kind}, vec_id {kind}, score double"
    return kept.groupBy("qb", "rb").cogroup(asked.groupBy("qb", "rb")).applyInPandas(search, schema)


def op6_query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 20 == 0)
