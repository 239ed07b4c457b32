from functools import reduce

import numpy as np
from pyspark.sql import functions as F

from rasterloom.llm import ann, embedding_dedup


def reached(near):
    """The smallest number that each row reaches over near pairs, by walking them."""
    low = [-1] * len(near)
    for start in range(len(near)):
        todo = [start] if low[start] < 0 else []
        while todo:
            at = todo.pop()
            if low[at] < 0:
                low[at] = start
                todo += np.flatnonzero(near[at]).tolist()
    return np.array(low)


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def clustered(n=400, d=24, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 8, d))
    return np.concatenate([rng.normal(size=(n, d)), centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, d)) * rng.uniform(0.02, 0.12, (n, 1))])


def test_links_equal_brute_force(spark):
    x = clustered()
    x[5] = x[6] = x[7]
    ids = np.random.default_rng(2).permutation(len(x)) * 3
    rows = [(int(i), v.tolist(), None) for i, v in zip(ids, x, strict=True)]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    order = np.argsort(ids)
    root = ids[order][reached(near[order][:, order])]
    for limit in (1024, 8):
        got = embedding_dedup.embedding_links(table(spark, rows, "double"), block_rows=limit, bucket_rows=8 * limit).orderBy("vec_id").collect()
        assert [r.vec_id for r in got] == sorted(ids.tolist())
        missed = near.sum() - sum(r.n_links for r in got)
        assert 0 <= missed <= 0.002 * near.sum()  # hashing finds nearly all, and nothing twice
        if not missed:
            assert [r.component_id for r in got] == root.tolist()
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_odd_vectors_link_with_nothing(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, one, 1), (2, one, 2), (2, one, 2), (3, None, 1), (4, [0.0, 0.0, 0.0], 1), (5, [1.0, None, 3.0], 1), (6, [1.0, float("nan"), 3.0], 1),
            (7, [1.0, float("inf"), 3.0], 1), (8, [], 1), (9, [1.0, 2.0], 1), (None, one, 1), (10, [2.0, 4.0, 6.0], None)]
    got = embedding_dedup.embedding_links(table(spark, rows).withColumn("n_links", F.lit(0))).collect()
    at = {r.vec_id: r for r in got}
    assert len(got) == len(rows) and at[1].n_links == 3 and at[10].n_links == 3 and at[2].component_id == 1 and at[10].component_id == 1
    assert all(at[k].n_links == 0 and at[k].component_id == k and at[k].kept for k in (3, 4, 5, 6, 7, 8, 9)) and at[None].n_links == 0
    assert embedding_dedup.embedding_links(table(spark, [])).count() == 0


def test_nearest_finds_nine_of_ten(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 64)) * rng.uniform(0.5, 2, (3000, 1))
    rows = [(k, v.tolist(), None) for k, v in enumerate(x)]
    got = ann.nearest(table(spark, rows, "double"), F.col("vec_id") % 20 == 0, block_rows=1000).collect()
    score = x[::20] @ x.T
    score[np.arange(150), np.arange(0, 3000, 20)] = -np.inf
    want = np.argsort(-score, axis=1)[:, :20]
    hits = {q: set() for q in range(0, 3000, 20)}
    for r in got:
        hits[r.query_id].add(r.vec_id)
        assert abs(r.score - x[r.query_id] @ x[r.vec_id]) < 1e-9
    assert len(got) == 150 * 20 and np.mean([len(hits[20 * k] & set(w)) for k, w in enumerate(want.tolist())]) >= 18
    for q in (0, 20):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21)) and all(a.score >= b.score for a, b in zip(mine, mine[1:], strict=False))


def test_nearest_orders_repeated_vectors_by_id_at_odd_sizes(spark):
    rng = np.random.default_rng(8)
    for n in (63, 131, 333):
        few = rng.normal(size=(9, 64)).astype(np.float32).astype(float)
        x = few[rng.integers(0, 9, n)]
        ids = rng.permutation(n)
        got = ann.nearest(table(spark, [(int(i), v.tolist(), None) for i, v in zip(ids, x, strict=True)]), F.col("vec_id") % 20 == 0, block_rows=64)
        found = {}
        for r in got.collect():
            found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        for at in np.flatnonzero(ids % 20 == 0):
            score = [reduce(lambda s, p: s + p[0] * p[1], zip(v.tolist(), x[at].tolist(), strict=True), 0.0) for v in x]
            want = sorted(((-s, int(i)) for s, i in zip(score, ids, strict=True) if i != ids[at]))[:20]
            assert [(i, s) for _, i, s in sorted(found[int(ids[at])])] == [(i, -s) for s, i in want]


def test_nearest_searches_each_length_and_the_whole_block_if_asked(spark):
    rng = np.random.default_rng(9)
    rows = [(k, rng.normal(size=7 if k % 3 else 5).tolist(), None) for k in range(400)]
    got = ann.nearest(table(spark, rows, "double"), F.col("vec_id") % 20 == 0, k=300, rerank=None).collect()
    size = {k: len(v) for k, v, _ in rows}
    count = {n: sum(m == n for m in size.values()) for n in (5, 7)}
    assert all(size[r.query_id] == size[r.vec_id] for r in got)
    assert len(got) == sum(min(300, count[size[q]] - 1) for q in range(0, 400, 20))


def test_nearest_ties_few_rows_and_odd_vectors(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (3, [1.0, 1.0], 1), (2, [1.0, 5.0], 1), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, float("nan")], 1), (None, [1.0, 1.0], 1), (7, [1.0, 1.0, 1.0], 1)]
    got = ann.nearest(table(spark, rows), F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 2.0), (0, 2, 2, 1.0), (0, 3, 3, 1.0)]
    assert ann.nearest(table(spark, []), F.col("vec_id") == 0).count() == 0
    assert ann.nearest(table(spark, [(1, [1.0], 1)]), F.col("vec_id") == 0).count() == 0


def test_pigeonhole_probing_is_exact():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 256, (500, 8), dtype=np.uint8)
    rows[:40] = rows[0] ^ (1 << rng.integers(0, 8, (40, 8))).astype(np.uint8)
    index = ann.MultiIndex(rows)
    for radius in (0, 5, 9, 20, 30, 64):
        want = np.flatnonzero(np.bitwise_count(rows ^ rows[0]).sum(axis=1) <= radius)
        assert index.within(rows[0], radius).tolist() == want.tolist()
