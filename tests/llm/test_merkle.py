import hashlib
import zlib

import duckdb
import pytest

from rasterloom.llm import merkle


def sha(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def text_of(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def slow_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def slow_path(levels, k):
    out = []
    for level in levels[:-1]:
        out.append((bool(k & 1), level[k ^ 1] if k ^ 1 < len(level) else ""))
        k >>= 1
    return out


def slow(rows):
    """op12's rows by plain trees in memory; rows are dicts."""
    def leaf(r, more=0):
        return sha("".join(text_of(r[c] + more if c == "n_chars" and r[c] is not None else r[c]) for c in merkle.FIELDS))

    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        by[x].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[x] = slow_levels([leaf(r) for r in by[x]])
    top, out = slow_levels([trees[x][-1][0] for x in langs]), []
    for j, x in enumerate(langs):
        for k, r in enumerate(by[x]):
            path = slow_path(trees[x], k) + slow_path(top, j)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node = leaf(r, int(hit))
            for left, other in path:
                node = sha(other, node) if left else sha(node, other)
            out.append((r["doc_id"], leaf(r), trees[x][-1][0], top[-1][0], sha(*[d for _, d in path]), node, node == top[-1][0]))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 31, 64, 65, 1000])
def test_traversal_emits_each_path(n):
    leaves = [sha(str(i)) for i in range(n)]
    for height in {merkle.height_of(n), merkle.height_of(n) + 3}:
        levels = slow_levels(leaves)
        while len(levels) <= height:  # a block of a larger tree: its root is hashed alone up to the block's height
            levels.append([sha(*levels[-1])])
        assert merkle.block_root(leaves, height) == levels[height][0]
        assert list(merkle.fractal_paths(leaves, height)) == [slow_path(levels[: height + 1], k) for k in range(n)]


def test_memory_of_the_traversal_does_not_follow_the_block():
    leaves, most = [sha(str(i)) for i in range(1 << 11)], 0
    seen = []
    real = merkle._Grower.__init__

    def noted(self, *a):
        real(self, *a)
        seen.append(self)

    merkle._Grower.__init__ = noted
    try:
        for _ in merkle.fractal_paths(leaves, 11):
            most = max(most, max(len(g.nodes) + len(g.waiting) for g in seen[-8:]))
    finally:
        merkle._Grower.__init__ = real
    assert most <= (2 << merkle.STACKED) + 11


TRICKY = [
    (1, "a", "en", "s", 1), (2, None, "en", None, 3), (2, "b", "en", "s", 9), (2, "b", "en", "s", 9), (None, "c", "en", "s", 1), (3, "", None, "s", None),
    (4, "naïve 漢字", "", "s", 8), (5, "x" * 200_000, "ü", "s", 200_000), (7, "-", "-", "-", 1), (6, "1:a", "zz", "2:b", 0),
    *[(k, f"text {k}", "fr", f"s{k % 3}", None if k % 5 == 0 else k) for k in range(10, 60)],
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("height", [12, 2])  # 2: blocks of four, so trees of several rounds of blocks
def test_query_on_nulls_ties_repeats_and_long_texts(spark, tmp_path, height):
    spark.createDataFrame(TRICKY, SCHEMA).withColumn("root", merkle.F.lit("mine")).write.parquet(f"{tmp_path}/documents.parquet")
    got = ordered(merkle.proven(spark.read.parquet(f"{tmp_path}/documents.parquet"), height).collect())
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    want = ordered(slow([dict(zip(names, r, strict=True)) for r in TRICKY]))
    assert not [(a[0], [x == y for x, y in zip(a, b, strict=True)]) for a, b in zip(got, want, strict=True) if a != b]
    assert {r[0] for r in got if not r[-1]} == {r[0] for r in TRICKY if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert ordered(con.execute(merkle.op12_sql()).fetchall()) == got


def test_no_rows_and_one_row(spark, docs_of):
    assert merkle.merkle_manifest(docs_of([]), merkle.FIELDS).count() == 0
    (only,) = merkle.merkle_manifest(docs_of([(7, "a")], "path root"), merkle.FIELDS).collect()
    assert only.leaf == only.subroot == only.root and only.path == [] and only.position == 0
