"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learned from document labels."""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.common import fresh_name, let_go, needs

_TOKENS = re.compile(r"[^\W_]+|[.!?\n]+")
_SENTENCES = re.compile(r"[^.!?\n]*(?:[.!?\n]+|$)")
_ENDS = ".!?\n"


PREFIXES = (3, 4, 5, 6)  # a word counts as itself and as its beginnings of these lengths


def features(word: str) -> list[str]:
    """A word and its beginnings; a beginning ends with a dash, so it isn't the word of the same letters."""
    return [word, *[f"{word[:n]}-" for n in PREFIXES if len(word) > n]]


@dataclass
class ToxicityModel:
    """Log-odds weights of words and word beginnings; a sentence scores the logistic of the sum of those it has."""

    weights: dict[str, float]
    bias: float

    def __post_init__(self) -> None:
        self.known: dict[str, tuple[str, ...]] = {}

    def _found(self, word: str) -> tuple[str, ...]:
        found = tuple(f for f in features(word) if f in self.weights)
        if len(self.known) >= 300_000:
            self.known.clear()
        self.known[word] = found
        return found

    def sentence_scores(self, text: str | None) -> np.ndarray:
        """The score of each sentence that has a word; of one empty sentence where there is none."""
        known, new = self.known.get, self._found
        sums: list[float] = []
        hits: set[str] = set()
        any_word = False
        for token in _TOKENS.findall((text or "").lower()):
            if token[0] in _ENDS:
                if any_word:
                    sums.append(self.bias + sum(self.weights[f] for f in hits) if hits else self.bias)
                    any_word = False
                    if hits:
                        hits = set()
                continue
            any_word = True
            found = known(token)
            if found is None:
                found = new(token)
            if found:
                hits.update(found)
        if any_word or not sums:
            sums.append(self.bias + sum(self.weights[f] for f in hits))
        return 1 / (1 + np.exp(-np.clip(np.array(sums), -40, 40)))

    def score(self, text: str | None) -> float:
        return float(-np.expm1(np.log1p(-np.minimum(self.sentence_scores(text), 1 - 1e-12)).sum()))

    def locate(self, text: str | None, least: float = 0.5) -> list[tuple[int, int, float]]:
        """(start, end, score) in characters of each sentence that scores ``least`` or more."""
        found = []
        for m in _SENTENCES.finditer(text or ""):
            if m[0]:
                p = float(self.sentence_scores(m[0])[0])
                if p >= least:
                    found.append((m.start(), m.end(), p))
        return found


def _telling(n_toxic: np.ndarray, n_clean: np.ndarray, toxic: int, clean: int, least: float) -> np.ndarray:
    """Which features are in toxic documents so much oftener that the log-likelihood ratio is ``least`` or more."""
    a, b = n_toxic.astype(float), n_clean.astype(float)
    expect = (a + b) * toxic / (toxic + clean)
    rest = a + b - expect
    ratio = 2 * (a * np.log(np.maximum(a, 1e-12) / np.maximum(expect, 1e-12)) + b * np.log(np.maximum(b, 1e-12) / np.maximum(rest, 1e-12)))
    return (ratio >= least) & (a > 2 * expect)


def train(
    texts: Sequence[str | None], labels: Iterable[int], least: float = 12.0, rounds: int = 300, rate: float = 0.05, decay: float = 1e-5
) -> ToxicityModel:
    """Fits the weights to document labels by gradient steps on the noisy-or likelihood.

    The gradient reaches a toxic document's sentences in proportion to how far each explains the label, so words of
    harmless sentences in toxic documents get none. Features that don't tell toxic documents apart are left out.
    """
    y = np.array(list(labels), dtype=np.float64)
    toxic, clean = int(y.sum()), int(len(y) - y.sum())
    if not toxic or not clean:
        return ToxicityModel({}, float(np.log((toxic + 0.5) / (clean + 0.5))) if len(y) else -4.0)
    lowered = [(x or "").lower() for x in texts]
    seen: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
    for text, label in zip(lowered, y, strict=True):
        seen[int(label)].update({f for w in set(_TOKENS.findall(text)) if w[0] not in _ENDS for f in features(w)})
    names = [f for f, n in seen[1].items() if n >= 3]
    told = _telling(np.array([seen[1][f] for f in names]), np.array([seen[0][f] for f in names]), toxic, clean, least)
    names = [f for f, ok in zip(names, told, strict=True) if ok]
    ids = {f: k for k, f in enumerate(names)}
    word, sentence, doc_of = array("i"), array("i"), array("i")
    plain = np.zeros(len(y))  # sentences without a feature, by document
    for d, text in enumerate(lowered):
        for part in _SENTENCES.findall(text):
            if words := [w for w in _TOKENS.findall(part) if w[0] not in _ENDS]:
                if mine := {ids[f] for w in words for f in features(w) if f in ids}:
                    word.extend(mine)
                    sentence.extend([len(doc_of)] * len(mine))
                    doc_of.append(d)
                else:
                    plain[d] += 1
    w_at, s_at, doc_at = (np.frombuffer(x, dtype=np.int32).astype(np.int64) if len(x) else np.zeros(0, np.int64) for x in (word, sentence, doc_of))
    n, n_s, n_d = len(names), len(doc_at), len(y)
    weights, bias = np.ones(n), -6.0
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, rounds + 1):
        z = np.append(bias + np.bincount(s_at, weights=weights[w_at], minlength=n_s), bias)
        p = np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), 1e-12, 1 - 1e-12)
        none = np.bincount(doc_at, weights=np.log1p(-p[:-1]), minlength=n_d) + plain * np.log1p(-p[-1])
        pull = np.where(y > 0, -np.exp(none) / np.maximum(-np.expm1(none), 1e-9), 1.0)
        slope = pull[doc_at] * p[:-1]
        gradient = np.append(
            np.bincount(w_at, weights=slope[s_at], minlength=n) / n_d + decay * weights, (slope.sum() + (pull * plain).sum() * p[-1]) / n_d
        )
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        weights, bias = np.maximum(weights - step[:-1], 0.0), bias - step[-1]
    return ToxicityModel(dict(zip(names, weights.tolist(), strict=True)), float(bias))


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learned from: crc32 of the id as text leaves 0 modulo 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> pd.DataFrame:
    """Up to ``most`` labelled (text, label) rows that aren't held out, the first by a hash of doc_id.

    Only their ids, at most ``most`` of them, are broadcast; texts of the others never leave the scan. An id that
    documents repeat gives one row, with the text that sorts first, so the bound holds for any table.
    """
    learn = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    picked = (
        learn.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(most)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return rows.select(F.xxhash64(F.col("doc_id").cast("string")).alias("at"), "text", "label").toPandas().sort_values(
        ["at", "text"], ignore_index=True
    )


def fit(docs: DataFrame, labels: DataFrame, max_train_docs: int = 6000) -> ToxicityModel:
    """The model learned from at most ``max_train_docs`` labelled documents (the documented bound of the sample)."""
    sample = labelled_sample(docs, labels, "toxic", max_train_docs)
    return train(sample["text"].tolist(), sample["label"])


def toxicity_scores(docs: DataFrame, model: ToxicityModel, text_col: str = "text", locate: bool = True) -> DataFrame:
    """docs with toxicity (0 to 1), n_offending sentences and, with ``locate``, their spans.

    offending is an array of (start, end, score) in characters of the text, of each sentence that scores 0.5 or more.
    Nulls: a null text is an empty one, which scores as one sentence without known words. Long texts are scored whole.
    Repeated rows: each is returned. Clashing column names: the new column gets a leading underscore.
    """
    needs(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary of the bounded sample

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            rows = []
            for x in texts:
                each = m.sentence_scores(x)
                score = float(-np.expm1(np.log1p(-np.minimum(each, 1 - 1e-12)).sum()))
                hits = int((each >= 0.5).sum())
                rows.append((score, hits, [{"start": s, "end": e, "score": p} for s, e, p in m.locate(x)] if locate and hits else []))
            yield pd.DataFrame(rows, columns=["toxicity", "n_offending", "offending"])
        m.known.clear()
        let_go()

    kind = "toxicity double, n_offending int, offending array<struct<start int, end int, score double>>"
    udf, at = F.pandas_udf(of, kind), fresh_name(docs.columns, "scored")
    new = ["toxicity", "n_offending"] + ["offending"] * locate
    return docs.withColumn(at, udf(F.col(text_col))).select(
        *docs.columns, *[F.col(f"{at}.{c}").alias(fresh_name(docs.columns, c)) for c in new]
    )


def op4_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity_scores(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        "n_offending",
        "offending",
    )
