import duckdb
import pytest
from pyspark.sql import functions as F

from rasterloom.llm.mixing import in_mixed_order, mix_sources, op9_sql


def table(docs_of, sizes):
    rows, k = [], 0
    for source, n in sizes.items():
        rows += [(k + i, "t", source) for i in range(n)]
        k += n
    return docs_of(rows)


@pytest.mark.parametrize("sizes", [{"a": 400, "b": 90, "c": 33, None: 20}, {"a": 7, "b": 7, "x": 1, "y": 3}])
def test_equals_sql_and_stays_within_a_block(docs_of, sizes):
    weights, block = {"a": 5, "b": 3, "c": 1}, 4
    df = mix_sources(table(docs_of, sizes), weights, 2, block)
    got = df.toPandas()
    documents = got[["doc_id", "source"]]  # noqa: F841
    con = duckdb.connect()
    con.register("documents", documents)
    names = ["doc_id", "mix_position", "mix_slot", "mix_release", "mix_deadline"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({op9_sql(weights, 2, block)}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in got.sort_values("doc_id")[names].itertuples(index=False)] == [tuple(r) for r in want]
    assert got.mix_position.is_unique and (got.mix_release <= got.mix_slot).all() and (got.mix_slot < got.mix_deadline).all()


def test_deviation_under_one_block(docs_of):
    weights = {"a": 5, "b": 3, "c": 2}
    got = mix_sources(table(docs_of, {"a": 500, "b": 300, "c": 200}), weights, 1, 1).select("source", "mix_slot").toPandas().sort_values("mix_slot")
    assert got.mix_slot.tolist() == list(range(1000))
    for s, w in weights.items():
        ahead = (got.source == s).cumsum().to_numpy() - (got.mix_slot.to_numpy() + 1) * w / 10
        assert abs(ahead).max() < 1


def test_nulls_repeats_clashes_and_bad_weights(docs_of):
    rows = [(None, "a", "a"), (1, None, None), (1, "b", "a"), (1, "b", "a"), (2, "c", "zz")]
    out = mix_sources(docs_of(rows, "mix_slot cls _cls _offset n _rank rows"), {"a": 2})
    assert out.count() == 5 and "_mix_slot" in out.columns and out.select("mix_position").distinct().count() == 5
    assert mix_sources(docs_of([]), {"a": 1}).count() == 0
    assert mix_sources(docs_of(rows), {}).filter(F.col("mix_slot") >= 0).count() == 5
    for bad in ({"a": 0}, {"a": 1.5}, {"a": 10_000_000}):
        with pytest.raises(ValueError):
            mix_sources(docs_of(rows), bad)


@pytest.mark.parametrize("rows", [
    [(k, "t", f"s{k % 3}") for k in range(2500)] + [(None, f"u{k % 40}", "s1") for k in range(120)] + [(7, "again", "s1")] * 700,
    [],
    [(None, None, None)],
])
def test_order_is_that_of_positions_with_one_shuffle_of_whole_rows(spark, docs_of, tmp_path, rows):
    docs_of(rows).write.parquet(str(tmp_path / "docs"))
    docs, weights = spark.read.parquet(str(tmp_path / "docs")), {"s0": 5, "s1": 3}
    out = in_mixed_order(docs, weights)
    want = [tuple(r) for r in mix_sources(docs, weights).orderBy("mix_position").select(*docs.columns).collect()]
    assert [tuple(r) for r in out.collect()] == want and out.columns == docs.columns
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange rangepartitioning" in x or "Exchange hashpartitioning" in x for x in plan.split("Initial Plan")[-1].splitlines()) == bool(rows)
