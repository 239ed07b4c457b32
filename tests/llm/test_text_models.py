import os
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rasterloom.llm import quality, toxicity

DATA = "/root/testdata/sf0.1"
have = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


def made(n=300, seed=1):
    rng = random.Random(seed)
    plain = [f"w{k}" for k in range(200)]
    texts, labels = [], []
    for _ in range(n):
        bad = rng.random() < 0.3
        parts = [[rng.choice(plain) for _ in range(8)] for _ in range(rng.randint(2, 6))]
        if bad:
            rng.choice(parts)[3] = rng.choice(["vileness", "vilest", "rot"])
        texts.append(" ".join(" ".join(p) + "." for p in parts))
        labels.append(int(bad))
    return texts, labels


def test_toxic_words_are_learned_and_located():
    model = toxicity.train(*made())
    assert model.score("w1 w2 vilest w3.") > 0.5 and model.score("w1 w2 w3. " * 50) < 0.5
    text = "w1 w2. w4 rot w9! w5"
    assert [text[s:e] for s, e, _ in model.locate(text)] == [" w4 rot w9!"]
    assert 0 <= model.score("") < 0.5 and model.score(None) == model.score("")
    assert toxicity.train([], []).score("x") < 0.5 and toxicity.train(["a"], [1]).weights == {}


def test_toxicity_rows(docs_of):
    model = toxicity.train(*made())
    rows = [(1, "w1 rot. w2"), (1, "w1 rot. w2"), (2, None), (None, "w1"), (3, "w1 " * 100_000 + "rot")]
    out = toxicity.toxicity_scores(docs_of(rows, "toxicity"), model).collect()
    assert len(out) == 5 and sum(r["_toxicity"] > 0.5 for r in out) == 3 and all(r.toxicity == "mine" for r in out)
    assert out[0].offending[0].start == 0 and out[0].offending[0].end == 7
    assert toxicity.toxicity_scores(docs_of([]), model).count() == 0


def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def test_nothing_held_out_is_learned(spark, docs_of):
    docs = docs_of([(k, f"text {k}") for k in range(200)])
    labels = spark.createDataFrame([(k, 1, k % 2) for k in [*range(200), *range(50)]], "doc_id long, quality int, toxic int")
    sample = toxicity.labelled_sample(docs, labels, "toxic", 60)
    held = {k for k in range(200) if zlib.crc32(str(k).encode()) % 5 == 0}
    assert len(sample) == 60 and not {int(t.split()[1]) for t in sample["text"]} & held
    flags = {r.doc_id: r.h for r in docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).collect()}
    assert {k for k, h in flags.items() if h} == held


def held_out_rows(label):
    docs = pq.read_table(f"{DATA}/documents.parquet", columns=["doc_id", "text"]).to_pandas()
    rows = docs.merge(pq.read_table(f"{DATA}/labels.parquet").to_pandas(), on="doc_id")
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id])
    return rows[~held], rows[held], label


@have
def test_held_out_toxicity():
    learn, held, label = held_out_rows("toxic")
    model = toxicity.train(learn.text.tolist(), learn[label])
    told = np.array([model.score(t) >= 0.5 for t in held.text])
    assert (told == held[label]).mean() >= 0.97 and told[held[label] == 0].mean() <= 0.01


@have
def test_held_out_quality():
    learn, held, label = held_out_rows("quality")
    model = quality.train(learn.text.tolist(), learn[label].to_numpy())
    p = model.probability(np.stack([model.pooled(t) for t in held.text]))
    good = held[label].to_numpy() == 1
    assert ((p >= 0.3) == good).mean() >= 0.97 and (p[good] < 0.3).mean() <= 0.01
    order = np.argsort(p)
    rank = np.empty(len(p))
    rank[order] = np.arange(1, len(p) + 1)
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc >= 0.99


def test_quality_rows(docs_of):
    texts = [" ".join(random.Random(k).choices("one two three four five".split(), k=20)) for k in range(100)]
    junk = [" ".join(w.upper() + "!!" for w in t.split()) for t in texts[:40]]
    model = quality.train(texts + junk, np.array([1] * 100 + [0] * 40))
    rows = [(1, texts[0]), (2, junk[0]), (2, junk[0]), (3, None), (4, ""), (None, "one " * 200_000)]
    out = quality.quality_scores(docs_of(rows, "quality"), model).collect()
    score = [r["_quality"] for r in out]
    assert score[0] > 0.5 > score[1] == score[2] and score[3] == score[4] and all(0 <= s <= 1 for s in score)
    assert quality.quality_scores(docs_of([]), model).count() == 0
    assert quality.train([], np.array([])).probability(np.zeros((1, quality.POOLED)))[0] == 0.5
