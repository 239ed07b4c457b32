import os
import subprocess
import sys

import pytest
import sentencepiece

import corpus_pipeline
from rasterloom.llm import toxicity
from rasterloom.llm.sentencepiece_codec import default_model
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_simhash import slow_similar

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    clean = {k: t for k, t in rows.items() if model.score(t) < 0.5}
    lines = brute_lines(list(clean.items()))
    listed = sorted(lines.items())
    kept = set(slow_similar(listed)[1])
    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    out = corpus_pipeline.run(spark, DATA)
    got = {r.doc_id: list(r.ids) for r in out.collect()}
    assert got == {k: [*library.encode(lines[k]), 2] for k in kept}
    assert 0 < len(got) < len(rows) and len(corpus_pipeline.STAGES) == 5


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_near_copies_of_the_table_equal_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    seen, want = slow_similar([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id for r in corpus_pipeline.dedup_near_copies(spark, docs, DATA).collect()}
    assert got == set(want) and any(0.8 <= x < 0.9 for x in seen)


def test_stages_keep_the_columns_and_clean_documents(spark, docs_of):
    docs = docs_of([(1, "a\nb\nc\nd", "src1"), (2, "q\na\nb\nc", "src2"), (3, None, None), (None, "z", "src1")])
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns and out.count() == 4
    changed = corpus_pipeline.dedup_lines(spark, docs, DATA).filter("doc_id = 2").first()
    assert (changed.text, changed.n_chars) == ("q", 1)


def test_the_last_stage_carries_the_order_of_the_mix(spark, docs_of, tmp_path):
    docs = docs_of([(k, f"text {k}", f"src{k % 7}") for k in range(400)])
    mixed = corpus_pipeline.mix(spark, docs, DATA)
    order = [r.doc_id for r in mixed.collect()]
    assert order != sorted(order)
    mixed.repartition(5).write.parquet(f"{tmp_path}/mixed")
    out = corpus_pipeline.encode(spark, spark.read.parquet(f"{tmp_path}/mixed"), DATA)
    assert [r.doc_id for r in out.orderBy("mix_position").collect()] == order


def test_encoding_keeps_the_whole_mix(spark, docs_of, tmp_path):
    rows = [(k, f"text {k}", f"src{k % 7}") for k in range(90)] + [(None, f"no id {k}", f"src{k % 3}") for k in range(200)]
    docs = docs_of(rows, "cls")
    want = [r.text for r in corpus_pipeline.mix(spark, docs, DATA).collect()]
    corpus_pipeline.mix(spark, docs, DATA).repartition(5).write.parquet(f"{tmp_path}/mixed")
    out = corpus_pipeline.encode(spark, spark.read.parquet(f"{tmp_path}/mixed"), DATA)
    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    got = out.orderBy("mix_position").collect()
    assert [list(r.ids) for r in got] == [[*library.encode(t), 2] for t in want]  # rows without an id have their places too
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline and r.mix_position // 16 == r.mix_slot for r in got)
    assert {(r.source, r.n_chars, r.cls) for r in got} == {(s, len(t), "mine") for _, t, s in rows}


def test_the_rest_works_without_this_subpackage():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('rasterloom.llm', 'corpus_pipeline')): raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "q = e.queries()\n"
        "assert q and not any(n.startswith('op') and n[2].isdigit() for n in q) and 'pipeline' not in q and e.oracle_sql()\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.abspath(corpus_pipeline.__file__)))


@pytest.mark.parametrize("rows", [[], [(None, None), (None, None), (None, "some text"), (1, None), (2, "")]])
def test_the_whole_pipeline_takes_empty_tables_and_nulls(spark, docs_of, tmp_path, rows):
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    known = {k for k, _ in rows if k is not None}
    #: Texts 1 and 2 have the same words, none; rows without an id stay, as nothing tells them apart.
    assert {r.doc_id for r in out if r.doc_id is not None} == ({min(known)} if known else set())
    assert sum(r.doc_id is None for r in out) == sum(k is None for k, _ in rows)
