"""Quality classifier: random-indexing word vectors pooled per document, then a small calibrated network."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.common import fresh_name, let_go, needs
from rasterloom.llm.toxicity import held_out, labelled_sample

_TOKENS = re.compile(r"[^\W_]+|_+|[^\w\s]+|\n")
DIM = 64
POOLED = 2 * DIM + 2


def shape(token: str) -> str:
    """The class that a token without a vector of its own counts as: letter case, digits, or its marks and their number."""
    if token.isalpha():
        case = "up" if len(token) > 1 and token.isupper() else "first" if token[:1].isupper() else "low"
        return f"<{case} {min(len(token), 24) // 4}>"
    if token.isalnum():
        return "<digits>" if token.isdigit() else "<mixed>"
    return f"<mark {token[0]} {min(len(token), 4)}>"


@dataclass
class QualityModel:
    """ids: rows of ``vectors`` by word or shape; the network's weights; the temperature of its probabilities."""

    ids: dict[str, int]
    vectors: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float]
    centre: np.ndarray
    scale: np.ndarray
    temperature: float = 1.0

    def __post_init__(self) -> None:
        self.cache: dict[str, int] = {}

    def _other(self, token: str) -> int:
        at = self.ids.get(shape(token), 0)
        if len(self.cache) >= 300_000:
            self.cache.clear()
        self.cache[token] = at
        return at

    def pooled(self, text: str | None) -> np.ndarray:
        """The mean and spread of the vectors of a text's tokens, the log of their number and the share of different ones."""
        get, cached, other = self.ids.get, self.cache.get, self._other
        at: list[int] = []
        tokens = _TOKENS.findall(text or "")
        for x in tokens:
            k = get(x)
            if k is None:
                k = cached(x)
                if k is None:
                    k = other(x)
            at.append(k)
        if not at:
            return np.zeros(POOLED)
        counts = np.bincount(np.array(at, np.int64), minlength=len(self.vectors)).astype(np.float32)
        used = np.flatnonzero(counts)
        share = counts[used] / len(at)
        mean = share @ self.vectors[used]
        spread = np.sqrt(np.maximum(share @ self.vectors[used] ** 2 - mean**2, 0))
        return np.concatenate([mean, spread, [np.log1p(len(at)), len(set(tokens)) / len(at)]])

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.centre) / self.scale @ w1 + b1) @ w2 + b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def word_vectors(texts: list[str], min_docs: int, most_words: int, window: int = 2, seed: int = 7) -> tuple[dict[str, int], np.ndarray]:
    """Random indexing: each word gets a sparse random ternary index vector; a word's vector sums its neighbours'.

    Words in fewer than ``min_docs`` texts, or beyond the ``most_words`` commonest, count as their shape, which is a
    word like others.
    """
    each = [_TOKENS.findall(x) for x in texts]
    df: Counter[str] = Counter()
    for tokens in each:
        df.update(set(tokens))
    words = [w for w, n in sorted(df.items(), key=lambda x: (-x[1], x[0]))[:most_words] if n >= min_docs]
    shapes = sorted({shape(w) for w in df})
    ids = {w: k + 1 for k, w in enumerate(words + [s for s in shapes if s not in df])}
    n = len(ids) + 1
    rng = np.random.default_rng(seed)
    index = np.zeros((n, DIM), np.float32)
    places = rng.integers(0, DIM, (n, 6))
    np.put_along_axis(index, places, rng.choice([-1.0, 1.0], (n, 6)).astype(np.float32), axis=1)
    codes: list[np.ndarray] = []
    for tokens in each:
        at = np.array([ids.get(t) or ids.get(shape(t), 0) for t in tokens], np.int64)
        codes += [at[:-step] * n + at[step:] for step in range(1, window + 1)]
    pair, count = np.unique(np.concatenate(codes), return_counts=True)
    a, b = pair // n, pair % n
    vectors = np.zeros(n * DIM)
    for word, other in ((a, b), (b, a)):
        for k in range(places.shape[1]):
            at = places[other, k]
            vectors += np.bincount(word * DIM + at, weights=index[other, at] * count, minlength=n * DIM)
    vectors = vectors.reshape(n, DIM)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return ids, (vectors / np.maximum(norm, 1e-9) + index / np.sqrt(6)).astype(np.float32)


def network(x: np.ndarray, y: np.ndarray, hidden: int = 32, rounds: int = 250, seed: int = 11) -> tuple:
    """Two layers, fitted by Adam on the cross-entropy with a little weight decay."""
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, rounds + 1):
        h = np.tanh(x @ params[0] + params[1])
        p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -40, 40)))
        d = (p - y) / len(y)
        dh = np.outer(d, params[2]) * (1 - h * h)
        grads = [x.T @ dh + 3e-4 * params[0], dh.sum(0), h.T @ d + 3e-4 * params[2], np.array([d.sum()])]
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            params[k] -= 0.02 * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return params[0], params[1], params[2], float(params[3][0])


def train(texts: list[str | None], labels: np.ndarray, min_docs: int = 4, most_words: int = 20_000) -> QualityModel:
    """Word vectors and network from labelled texts; every fifth of them only sets the temperature."""
    texts = [x or "" for x in texts]
    y = np.asarray(labels, float)
    if not len(texts) or y.min() == y.max():
        flat = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        zero = np.zeros((POOLED, 1)), np.zeros(1), np.zeros(1), flat
        return QualityModel({}, np.zeros((1, DIM), np.float32), zero, np.zeros(POOLED), np.ones(POOLED))
    ids, vectors = word_vectors(texts, min_docs, most_words)
    model = QualityModel(ids, vectors, (), np.zeros(POOLED), np.ones(POOLED))
    x = np.stack([model.pooled(t) for t in texts])
    check = np.arange(len(y)) % 5 == 4 if len(y) >= 50 else np.zeros(len(y), bool)
    model.centre, model.scale = x[~check].mean(0), x[~check].std(0) + 1e-3
    model.layers = network((x[~check] - model.centre) / model.scale, y[~check])
    if check.any():
        z = model.logits(x[check])
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.logaddexp(0, np.where(y[check] > 0, -z, z) / t).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def fit(docs: DataFrame, labels: DataFrame, max_train_docs: int = 5000) -> QualityModel:
    """The model learned from at most ``max_train_docs`` labelled documents (the documented bound of the sample)."""
    sample = labelled_sample(docs, labels, "quality", max_train_docs)
    return train(sample["text"].tolist(), sample["label"].to_numpy())


def quality_scores(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """docs with quality, the calibrated probability (0 to 1) that a text is good.

    Nulls: a null text is an empty one, which scores as the network does a text without tokens. Long texts are pooled
    whole. Repeated rows: each is returned. A column already named quality keeps its name; the new one gets a leading
    underscore.
    """
    needs(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by most_words and the bounded sample

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        m.cache = {}
        for texts in batches:
            x = np.stack([m.pooled(t) for t in texts]) if len(texts) else np.zeros((0, POOLED))
            yield pd.Series(m.probability(x))
        m.cache = {}
        let_go()

    return docs.withColumn(fresh_name(docs.columns, "quality"), F.pandas_udf(of, "double")(F.col(text_col)))


def op8_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_scores(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality").alias("score"),
        (F.col("quality") >= 0.3).cast("int").alias("predicted"),
    )
