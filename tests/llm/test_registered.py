"""Each registered query over the whole small table, with the columns that it promises, against a plain version."""

import base64
import hashlib
import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece

from rasterloom.llm.queries import ORACLE_SQL, QUERIES
from rasterloom.llm.sentencepiece_codec import default_model
from tests.llm.test_embeddings import reached
from tests.llm.test_simhash import slow_groups

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


def read(name):
    return pq.read_table(f"{DATA}/{name}.parquet").to_pylist()


def run(spark, name, folder=DATA):
    return [r.asDict(recursive=True) for r in QUERIES[name](spark, folder).collect()]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{DATA}/documents.parquet')")
    found = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    want = sorted(tuple(r[names.index(c)] for c in sorted(names)) for r in found.fetchall())
    assert sorted(tuple(r[c] for c in sorted(names)) for r in run(spark, name)) == want


def test_op2(spark):
    rows = [(r["doc_id"], r["text"]) for r in read("documents")]
    fps, groups = slow_groups(rows)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in run(spark, "op2_simhash_near_dedup")}
    assert got == {k: (f"{fp:016x}", g) for (k, _), fp, g in zip(rows, fps, groups, strict=True)}


def test_op3(spark):
    rows = sorted(read("embeddings"), key=lambda r: r["vec_id"])
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    low = [rows[k]["vec_id"] for k in reached(near)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in run(spark, "op3_embedding_near_dedup")}
    assert got == {r["vec_id"]: (int(n), c, r["vec_id"] == c) for r, n, c in zip(rows, near.sum(axis=1), low, strict=True)}


@pytest.mark.parametrize(("name", "label", "least"), [("op4_toxicity", "toxic", 0.5), ("op8_quality_classifier", "quality", 0.3)])
def test_op4_and_op8_take_no_label_of_the_held_out_fifth(spark, tmp_path, name, label, least):
    documents, labels = read("documents"), read("labels")
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in documents}
    got = {r["doc_id"]: r for r in run(spark, name)}
    assert {k: r["held_out"] for k, r in got.items()} == held and len(got) == len(documents)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= least) for r in got.values())
    other = [{**r, label: 1 - r[label]} if held.get(r["doc_id"]) else r for r in labels]
    kinds = "doc_id long, quality int, toxic int"
    spark.createDataFrame([(r["doc_id"], r["quality"], r["toxic"]) for r in other], kinds).write.parquet(f"{tmp_path}/labels.parquet")
    changed = spark.read.parquet(f"{DATA}/documents.parquet").selectExpr("doc_id", "text", "'x' AS lang", "'y' AS source", "n_chars")
    changed.write.parquet(f"{tmp_path}/documents.parquet")
    again = {r["doc_id"]: r["score"] for r in run(spark, name, str(tmp_path))}
    assert again == pytest.approx({k: r["score"] for k, r in got.items()}, abs=1e-9)


def test_op4_scores_are_a_noisy_or_of_sentences_and_located(spark):
    from rasterloom.llm import toxicity

    documents = {r["doc_id"]: r["text"] for r in read("documents")}
    model = toxicity.fit(spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet"))
    for r in run(spark, "op4_toxicity"):
        none = 1.0
        for p in model.sentence_scores(documents[r["doc_id"]]):
            none *= 1 - min(p, 1 - 1e-12)
        assert r["score"] == pytest.approx(1 - none, abs=1e-9)
        assert len(r["offending"]) == r["n_offending"]


def test_op5(spark):
    documents = {r["doc_id"]: (r["text"] or "").encode() for r in read("documents")}
    count = Counter(hash(t[i : i + 400]) for t in documents.values() for i in range(len(t) - 399))
    for r in run(spark, "op5_suffix_array_dedup"):
        t = documents[r["doc_id"]]
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - 399):
            if count[hash(t[i : i + 400])] > 1:
                gone[i] += 1
                gone[i + 400] -= 1
        gone = np.cumsum(gone)[: len(t)] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        runs = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(t) else 0
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())


def test_op6(spark):
    rows = read("embeddings")
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    found: dict[int, list] = {}
    for r in run(spark, "op6_nearest_neighbours"):
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, mine in found.items():
        mine.sort()
        score = x @ x[ids == q][0]
        assert [r for r, _, _ in mine] == list(range(1, 21)) and all(v != q for _, v, _ in mine)
        assert all(abs(s - score[ids == v][0]) < 1e-12 for _, v, s in mine)
        assert all((-a[2], a[1]) < (-b[2], b[1]) for a, b in zip(mine, mine[1:], strict=False))
        others = np.flatnonzero(ids != q)
        hits += len({v for _, v, _ in mine} & set(ids[others[np.lexsort((ids[others], -score[others]))[:20]]].tolist()))
    assert hits >= 0.9 * 20 * len(found)


def test_op7(spark):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in read("pages")}
    first: dict[bytes, int] = {}
    for k in sorted(pages):
        first.setdefault(pages[k], k)
    digest = lambda x: base64.b32encode(hashlib.sha1(x).digest()).decode()
    want = {k: (len(x), digest(x), "response" if first[x] == k else "revisit", None if first[x] == k else first[x]) for k, x in pages.items()}
    names = ("payload_bytes", "payload_digest", "record_type", "refers_to")
    assert {r["page_id"]: tuple(r[c] for c in names) for r in run(spark, "op7_warc")} == want


def test_op10(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {}
    for r in read("documents"):
        ids = [*library.encode(r["text"] or ""), library.eos_id()]
        want[r["doc_id"]] = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in run(spark, "op10_sentencepiece")} == want


@pytest.mark.parametrize("name", ["op11_packing", "op12_merkle_manifest", "op13_embedding_whitening"])
def test_new_queries_have_the_columns_promised(spark, name):
    want = {
        "op11_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
        "op12_merkle_manifest": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
        "op13_embedding_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    }[name]
    assert ", ".join(f"{c} {t}" for c, t in QUERIES[name](spark, DATA).dtypes) == want


def test_op11_and_op13_on_the_small_table(spark):
    from tests.llm import test_packing, test_whitening

    pieces = test_packing.p.pack(spark.read.parquet(f"{DATA}/documents.parquet"))
    test_packing.check([r.asDict() for r in pieces.collect()], [(r["doc_id"], r["text"]) for r in read("documents")], 2048)
    test_whitening.check(run(spark, "op13_embedding_whitening"), [(r["vec_id"], r["embedding"]) for r in read("embeddings")])
