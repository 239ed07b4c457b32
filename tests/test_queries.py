import os
import random

import duckdb
import pytest

from rasterloom.plans.registry import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if v is None or isinstance(v, (str, bool, int)):
        return v
    try:
        return round(float(v), 6) + 0.0
    except TypeError:
        return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    run = duck.execute(ORACLE_SQL[name])
    names = [x[0] for x in run.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in run.fetchall()), key=repr)
    assert got == want


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_gives_rows(spark, name):
    rows = QUERIES[name](spark, DATA).collect()  # every column: a count would let Spark leave out the ones that fail
    assert rows


def test_mosaic_components_whole_floods_every_tile(spark, tmp_path):
    rng = random.Random(4)
    rows = [(k, [rng.choice((0.0, 0.2)) for _ in range(64)]) for k in range(64 * 26)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    ones = {(k % 64, k // 64 * 48 + c) for k, v in rows for c, e in enumerate(v) if e > 0.1}
    want, left = {}, set(ones)
    for at in sorted(ones):
        if at in left:
            left.remove(at)
            todo = [at]
            while todo:
                r, c = todo.pop()
                want[r, c] = at[0] * (1 << 31) + at[1]
                near = left & {(r, c + 1), (r + 1, c), (r, c - 1), (r - 1, c)}
                left -= near
                todo += near
    got = QUERIES["mosaic_components"](spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {(x.gr, x.gc): x.label for x in got} == want
    assert max(c for _, c in want) >= 1024  # more tiles than the first 12, and more than two blocks


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_append_whole_keeps_every_row_of_both_tables(spark):
    rows = sum(spark.read.parquet(f"{DATA}/{t}.parquet").count() for t in ("lineitem", "orders"))
    assert QUERIES["append_schema_evolution"](spark, DATA).count() == rows
