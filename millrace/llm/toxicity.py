"""Toxicity by multiple-instance learning.

A document is a bag of sentences of which only the bag is labelled. Each
sentence gets a probability from a logistic model over its hashed words; the
document's is their noisy-or, 1 - prod(1 - p). The model is trained on the
document labels through the noisy-or, and the sentence probabilities then say
where the offence is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import text_blocks
from millrace.llm.shingles import mix
from millrace.operators.sizing import broadcast_if_small

FEATURE_BITS = 20
#: Letters of a word's beginning that count as a feature beside the word.
PREFIX = 4
#: About so many labelled texts at most fit the model; they are chosen by a hash of the id.
TRAIN_TEXTS = 8000
#: A feature has to occur in so many training texts.
LEAST_TEXTS = 8
EPOCHS = 60
DECAY = 4.0
FIRST_BIAS = -5.0
STEP = 0.5
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*|[.!?]+")
_WORD = re.compile(r"[^\W_]+")


class Words:
    """Feature numbers of words and of their first letters, remembered up to a fixed number of words."""

    def __init__(self, most: int = 300_000) -> None:
        self.known: dict[str, tuple[int, int]] = {}
        self.most = most

    def features(self, words: list[str]) -> np.ndarray:
        """Two rows: the feature of each word, and that of its beginning."""
        fresh = set(words).difference(self.known)
        if fresh:
            if len(self.known) + len(fresh) > self.most:
                self.known, fresh = {}, set(words)
            fresh = list(fresh)
            both = zip(_hash_all(fresh), _hash_all([f"{w[:PREFIX]}*" for w in fresh]), strict=True)
            self.known.update(zip(fresh, both, strict=True))
        found = np.array([self.known[w] for w in words], np.int64)
        return found.reshape(-1, 2).T


def _hash_all(words: list[str]) -> list[int]:
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    out = np.full(len(raw), 1469598103934665603, np.uint64)
    size = np.array([len(r) for r in raw])
    order = np.argsort(-size, kind="stable")
    buffer = np.frombuffer(b"".join(raw), np.uint8)
    begins = np.concatenate([[0], np.cumsum(size)])[:-1]
    alive = len(raw)
    for place in range(size.max(initial=0)):
        while alive and size[order[alive - 1]] <= place:
            alive -= 1
        rows = order[:alive]
        out[rows] = (out[rows] ^ buffer[begins[rows] + place]) * np.uint64(1099511628211)
    return (mix(out) >> np.uint64(64 - FEATURE_BITS)).tolist()


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences, which end at . ! ? or a line break."""
    return [m.span() for m in _SENTENCE.finditer(text) if not m.group().isspace()]


def bags(texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all words, the sentence of each feature, and the text of each sentence."""
    flat, counts, owner = [], [], []
    for i, text in enumerate(texts):
        lowered = text.lower()
        if len(lowered) != len(text):
            lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        for start, end in sentences(text):
            found = _WORD.findall(lowered, start, end)
            flat += found
            counts.append(len(found))
            owner.append(i)
    sentence = np.repeat(np.arange(len(counts)), counts)
    return words.features(flat).reshape(-1), np.tile(sentence, 2), np.array(owner, np.int64)


class Model:
    """Weights of features; sentence probability and noisy-or."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights, bias

    def sentence_scores(self, features, sentence, n: int) -> np.ndarray:
        z = self.bias + np.bincount(sentence, self.weights[features], n)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def text_scores(self, scores: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        return 1 - np.exp(np.bincount(owner, np.log1p(-np.minimum(scores, 1 - 1e-12)), n))


def fit(texts: list[str], toxic: np.ndarray, epochs: int = EPOCHS, decay: float = DECAY) -> Model:
    """Weights from whole texts and their labels.

    Maximum likelihood through the noisy-or under an absolute penalty, which leaves most
    words without a weight: proximal steps over all texts at once, each scaled with an
    estimate of the weight's second derivative."""
    size = 1 << FEATURE_BITS
    words, parts, n_sentences, n_texts = Words(), [], 0, 0
    for _, block in text_blocks(iter([pd.DataFrame({"text": texts})]), "text"):
        found, of, whose = bags(block, words)
        parts.append((found.astype(np.int32), (of + n_sentences).astype(np.int32), whose + n_texts))
        n_sentences, n_texts = n_sentences + len(whose), n_texts + len(block)
    features, sentence, owner = map(np.concatenate, zip(*parts, strict=True)) if parts else (np.zeros(0, int),) * 3
    in_text = np.unique(owner[sentence].astype(np.int64) * size + features) % size if len(features) else features
    keep = (np.bincount(in_text, minlength=size) >= LEAST_TEXTS)[features]
    features, sentence = features[keep], sentence[keep]
    model = Model(np.zeros(size), FIRST_BIAS)
    for _ in range(epochs):
        p = model.sentence_scores(features, sentence, len(owner))
        whole = np.clip(model.text_scores(p, owner, len(texts)), 1e-9, 1 - 1e-9)
        # d loss / d z of a sentence: p for a clean text; -p (1 - P) / P for a toxic one.
        slope = np.where(toxic, -(1 - whole) / whole, 1.0)[owner] * p
        gradient = np.bincount(features, slope[sentence], size)
        curve = np.bincount(features, (np.abs(slope) + p * (1 - p))[sentence], size) + 1.0
        moved = model.weights - gradient / curve
        moved = np.sign(moved) * np.maximum(np.abs(moved) - decay / curve, 0)
        model.weights += np.clip(moved - model.weights, -STEP, STEP)
        model.bias -= np.clip(slope.sum() / (np.abs(slope) + p * (1 - p)).sum(), -STEP, STEP) if len(p) else 0.0
    return model


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
    texts: int = TRAIN_TEXTS,
) -> Model:
    """A model from at most about ``texts`` labelled documents.

    Rows without a text or label teach nothing; a document with several labels
    counts once for each. Without any label every score is low.
    """
    marked = labels.where(F.col(toxic).isin(0, 1)).select(F.col(doc_id).alias("_id"), F.col(toxic).alias("_y")).distinct()
    place = F.pmod(F.xxhash64("_id"), F.lit(1_000_000))
    chosen = marked.where(place * marked.count() < texts * 1_000_000)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).where("_text IS NOT NULL")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = pd.concat([pd.DataFrame({"_text": [], "_y": []}), *frames], ignore_index=True)
        model = fit(sample["_text"].tolist(), sample["_y"].to_numpy() == 1)
        used = np.flatnonzero(model.weights)
        yield pd.DataFrame({"feature": [-1, *used], "weight": [model.bias, *model.weights[used]]})

    # One task, for a sample whose size ``texts`` bounds.
    sample = rows.join(broadcast_if_small(chosen), "_id").select("_text", "_y").repartition(1)
    found = sample.mapInPandas(run, "feature bigint, weight double").toPandas()
    weights, bias = np.zeros(1 << FEATURE_BITS), FIRST_BIAS
    for feature, weight in found.itertuples(index=False):
        if feature < 0:
            bias = weight
        else:
            weights[feature] = weight
    return Model(weights, bias)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 from 0.5 on), ``worst_score`` of the
    likeliest sentence and, where 1 is predicted, its ``worst_start`` and ``worst_end`` in code points.

    Null and empty texts have no sentence: score 0 and a null place. Of equally
    likely sentences the first is told. Columns of ``docs`` with these names are replaced.
    """
    names = ("score", "predicted", "worst_start", "worst_end", "worst_score")
    used = np.flatnonzero(model.weights)
    values, bias = model.weights[used], model.bias

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights = np.zeros(1 << FEATURE_BITS)
        weights[used] = values
        local, words = Model(weights, bias), Words()
        for batch in batches:
            out = []
            for _, texts in text_blocks(iter([batch.to_frame("text")]), "text", 1 << 19):
                features, sentence, owner = bags(texts, words)
                p = local.sentence_scores(features, sentence, len(owner))
                whole = local.text_scores(p, owner, len(texts))
                first = np.searchsorted(owner, np.arange(len(texts) + 1))
                for i, text in enumerate(texts):
                    mine = p[first[i] : first[i + 1]]
                    if len(mine):
                        at = int(mine.argmax())
                        start, end = sentences(text)[at] if whole[i] >= 0.5 else (None, None)
                        out.append((whole[i], int(whole[i] >= 0.5), start, end, mine[at]))
                    else:
                        out.append((0.0, 0, None, None, None))
            frame = pd.DataFrame(out, columns=list(names))
            yield frame.astype({"worst_start": "Int64", "worst_end": "Int64"})

    found = F.pandas_udf(
        run, "score double, predicted int, worst_start bigint, worst_end bigint, worst_score double"
    )(F.col(text))
    kept = [c for c in docs.columns if c.lower() not in (*names, "_found")]
    return docs.select(*kept, found.alias("_found")).select(*kept, "_found.*")
