"""Language identification with hyperdimensional profiles.

Every letter is a random vector of +1 and -1. An n-gram is bound by multiplying
its letters' vectors, each rotated by its place; a text is the bundle (sum) of
its n-grams; a language's prototype is the bundle of its training texts, each at
unit length. A text gets the language whose prototype has the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import give_back, text_blocks

DIMENSIONS = 1024
GRAM = 3
UNKNOWN = "und"
#: Below this ``variety``, scores of own and foreign texts overlap: such texts cannot be judged.
LEAST_VARIETY = 64
#: A text is foreign below this share of the score that 1 per cent of its own language's texts stay under.
OWN_SHARE, OWN_QUANTILE = 0.75, 0.01
#: How many labelled texts of one variety scores are learned from at least.
SCORED_LEAST = 10
_SPACE = 0
_KNOWN_GRAMS = 40_000
_SLICE = 2_048


@cache
def _letter(code: int) -> np.ndarray:
    rng = np.random.default_rng([11, code])
    return rng.integers(0, 2, DIMENSIONS, dtype=np.int8) * np.int8(2) - np.int8(1)


def letter_codes(text: str) -> np.ndarray:
    """Code points of lower-cased letters, every run of anything else being one space, with
    a space at both ends; empty if there is no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters(codes), codes, _SPACE)
    codes = np.concatenate([[_SPACE], codes, [_SPACE]]).astype(np.int64)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)
    codes = codes[keep]
    return codes if len(codes) > 1 else codes[:0]


@cache
def _plain_letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def _letters(codes: np.ndarray) -> np.ndarray:
    out = _plain_letters()[np.minimum(codes, 0xFFFF)]
    for at in np.flatnonzero(codes > 0xFFFF):
        out[at] = chr(codes[at]).isalpha()
    return out


class Bundler:
    """Text vectors; remembers the n-grams that it has bound, up to a fixed number."""

    def __init__(self) -> None:
        self.rows: dict[int, int] = {}
        self.bound = np.empty((4096, DIMENSIONS), np.int8)
        #: Per text of the last call: how many equally frequent n-grams would be as varied.
        self.variety = np.zeros(0)

    def _bind(self, grams: list[int]) -> list[int]:
        """Row numbers of ``grams`` in ``bound``."""
        fresh = [g for g in grams if g not in self.rows]
        if len(self.rows) + len(fresh) > max(_KNOWN_GRAMS, len(grams)):
            self.rows, fresh = {}, grams
        need = len(self.rows) + len(fresh)
        if need > len(self.bound):
            grown = np.empty((max(need, 2 * len(self.bound)), DIMENSIONS), np.int8)
            grown[: len(self.rows)] = self.bound[: len(self.rows)]
            self.bound = grown
        for gram in fresh:
            vector = np.ones(DIMENSIONS, np.int8)
            for place in range(GRAM):
                vector = vector * np.roll(_letter(gram >> (21 * place) & 0x1FFFFF), place)
            self.bound[len(self.rows)] = vector
            self.rows[gram] = len(self.rows)
        return [self.rows[g] for g in grams]

    def bundle(self, texts: list[str]) -> np.ndarray:
        """A unit vector per text; zeros where there is no letter."""
        counted = []
        for text in texts:
            codes = letter_codes(text)
            grams = np.zeros(max(len(codes) - GRAM + 1, 0), np.int64)
            for place in range(GRAM):
                grams += codes[place : place + len(grams)] << (21 * place)
            counted.append(np.unique(grams, return_counts=True))
        known = np.unique(np.concatenate([g for g, _ in counted]))
        rows = self._bind(known.tolist())  # first, as it may replace ``bound``
        counts = np.zeros((len(texts), len(known)), np.float32)
        for row, (grams, n) in enumerate(counted):
            counts[row, np.searchsorted(known, grams)] = n
        squares = np.array([float((n.astype(np.float64) ** 2).sum()) for _, n in counted])
        totals = np.array([float(n.sum()) for _, n in counted])
        self.variety = np.divide(totals**2, squares, out=np.zeros_like(totals), where=squares > 0)
        # A few n-grams at a time: all their vectors as floats would be larger than the texts. Sums are
        # of whole numbers, so their order does not matter.
        out = np.zeros((len(texts), DIMENSIONS), np.float32)
        for at in range(0, len(rows), _SLICE):
            out += counts[:, at : at + _SLICE] @ self.bound[rows[at : at + _SLICE]].astype(np.float32)
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, length, out=np.zeros_like(out), where=length > 0)


def train(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Unit prototypes from all labelled texts.

    Null labels and texts teach nothing. What is collected is one vector a language.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundler, sums = Bundler(), {}
        for frame, block in text_blocks(frames, "text", 1 << 18, 256):
            vectors = bundler.bundle(block)
            for name in frame["lang"].unique():
                part = vectors[(frame["lang"] == name).to_numpy()].sum(axis=0, dtype=np.float64)
                sums[name] = sums.get(name, 0) + part
        del bundler
        give_back()
        for name, vector in sums.items():
            yield pd.DataFrame({"lang": name, "place": np.arange(DIMENSIONS), "value": vector})

    parts = rows.mapInPandas(run, "lang string, place int, value double")
    summed = parts.groupBy("lang", "place").agg(F.sum("value").alias("value")).toPandas()
    prototypes = {}
    for name, part in summed.groupby("lang"):
        vector = part.sort_values("place")["value"].to_numpy()
        if (length := np.linalg.norm(vector)) > 0:
            prototypes[str(name)] = (vector / length).astype(np.float32)
    return dict(sorted(prototypes.items()))


def predict(
    docs: DataFrame, prototypes: dict[str, np.ndarray], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, the cosine with the prototype, from 0 to 1, and
    ``variety``, the effective number of n-grams.

    A text that is null, or has no letter, gets ``und`` and 0; so does every text
    if no language was learned. Equal cosines go to the name that sorts first.
    Columns of ``docs`` that bear these names are replaced.
    """
    names = list(prototypes)
    matrix = np.stack(list(prototypes.values())) if names else np.zeros((0, DIMENSIONS), np.float32)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bundler = Bundler()
        for batch in batches:
            parts = [
                (lambda v: (v @ matrix.T, np.abs(v).sum(axis=1) > 0, bundler.variety))(bundler.bundle(block))
                for _, block in text_blocks(iter([batch.to_frame("text")]), "text", 1 << 18, 256)
            ]
            cosine = np.concatenate([p for p, _, _ in parts]) if parts else np.zeros((0, len(names)))
            known = np.concatenate([k for _, k, _ in parts]) if parts else np.zeros(0, bool)
            variety = np.concatenate([n for _, _, n in parts]) if parts else np.zeros(0)
            if not names:
                yield pd.DataFrame({"lang_pred": [UNKNOWN] * len(batch), "score": 0.0, "variety": variety})
                continue
            best = cosine.argmax(axis=1)
            yield pd.DataFrame(
                {
                    "lang_pred": np.where(known, np.array(names, object)[best], UNKNOWN),
                    "score": np.where(known, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0).astype(float),
                    "variety": variety,
                }
            )
        del bundler
        give_back()

    found = F.pandas_udf(score, "lang_pred string, score double, variety double")(F.col(text))
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "variety", "_found")]
    # One evaluation for all fields.
    return docs.select(*kept, found.alias("_found")).select(*kept, "_found.lang_pred", "_found.score", "_found.variety")


def _band(variety: Column) -> Column:
    return F.floor(2 * F.log2(variety)).cast("int")


def least_scores(labelled: DataFrame, prototypes: dict[str, np.ndarray]) -> dict[int, float]:
    """Per band of variety the least score of a text in a known language, from all texts that taught
    nothing: scores grow with the variety, so a band asks at least what the one below does."""
    rows = labelled.where(F.col("lang").isin(list(prototypes)) & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    own = predict(rows, prototypes).where((F.col("variety") >= LEAST_VARIETY) & (F.col("lang") == F.col("lang_pred")))
    found = own.groupBy(_band(F.col("variety")).alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("score", OWN_QUANTILE).alias("least")
    )
    out, least = {}, 0.0
    for row in sorted(found.where(F.col("n") >= SCORED_LEAST).collect(), key=lambda r: r.band):
        out[row.band] = least = max(least, OWN_SHARE * row.least)
    return out


def is_known(least: dict[int, float]) -> Column:
    """Whether a predicted row is in a language that was learned, or too short or repetitive to judge."""
    bound = F.lit(0.0)
    for band, score in sorted(least.items()):
        bound = F.when(_band(F.col("variety")) >= band, F.lit(score)).otherwise(bound)
    return (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= bound)
