"""Language identification: add-one-smoothed counts of character n-grams per label.

Scores are whole micro-nats, so sums do not depend on the order of addition
and a prediction is the same on every cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.sizing import store


NGRAM = 3
# Profiles up to this many rows, and bytes as a table of n-grams by labels, are scored from such a table
# in each task; larger ones by a join.
PROFILE_ROWS = 2_000_000
PROFILE_BYTES = 64 << 20
_SCALE = 1_000_000
# An empty match before each character; the class keeps a match from starting inside a surrogate pair.
_OVERLAPPING = r"(?s)(?=([^\x{dc00}-\x{dfff}]" + "." * (NGRAM - 1) + "))"
_CHUNK = 4 << 20  # characters
_BITS = 21  # enough for a code point; three fit a signed 64-bit key


def _explode_ngrams(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """One row per overlapping n-gram: ``keep`` and ``gram``."""
    grams = F.regexp_extract_all(F.col(text), F.lit(_OVERLAPPING), F.lit(1))
    return df.select(*keep, F.explode(grams).alias("gram"))


def fit(df: DataFrame, text: str = "text", label: str = "lang") -> DataFrame:
    """``(label, gram, n)``: how often each n-gram occurs under each label."""
    labelled = df.select(F.col(label).alias("label"), F.col(text).alias("_text")).where(
        "label is not null"
    )
    return _explode_ngrams(labelled, "_text", ["label"]).groupBy("label", "gram").agg(
        F.count(F.lit(1)).alias("n")
    )


def profile(counts: DataFrame) -> DataFrame:
    """``(label, gram, score)`` from :func:`fit`; the row with ``gram = ''`` holds the
    score of an n-gram the label has not seen.

    The counts are stored, being used three times. Only one total per label
    comes to the driver.
    """
    counts = store(counts)
    totals = {r.label: r.n for r in counts.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        raise ValueError("no labelled text to make a profile of")
    size = counts.select("gram").distinct().count()
    mass = F.create_map(*[F.lit(x) for label, n in totals.items() for x in (label, n + size)])

    def score(n: Column) -> Column:
        share = n / F.element_at(mass, F.col("label"))
        return F.round(F.log(share) * F.lit(_SCALE)).cast("bigint").alias("score")

    unseen = counts.sparkSession.createDataFrame([(label, "") for label in totals], "label string, gram string")
    return counts.select("label", "gram", score(F.col("n") + 1)).unionByName(
        unseen.select("label", "gram", score(F.lit(1)))
    )


def _scorer(rows: pd.DataFrame, spark):
    """pandas UDF that scores a text against a profile held in sorted arrays."""
    labels = sorted(rows.loc[rows.gram == "", "label"])
    if not labels:
        raise ValueError("the profile has no label")
    floor = rows[rows.gram == ""].set_index("label").score.reindex(labels).to_numpy(np.int64)
    wide = rows[rows.gram != ""].pivot(index="gram", columns="label", values="score").reindex(columns=labels)
    keys = _codes("".join(wide.index), spaced=True)
    gain = (wide.fillna(dict(zip(labels, floor))).to_numpy(np.int64)) - floor
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((keys[order], gain[order], floor, np.array(labels, dtype=object)))

    @F.pandas_udf("lang string, score bigint")
    def score(texts: pd.Series) -> pd.DataFrame:
        texts = texts.fillna("")
        sizes = texts.str.len().to_numpy()
        counts = np.maximum(sizes - (NGRAM - 1), 0)
        totals = counts[:, None] * shared.value[2]
        # Texts are scored in groups of about _CHUNK characters to bound the arrays.
        group = np.cumsum(sizes) // _CHUNK
        for begin, end in _runs(group):
            _add_gains(texts.iloc[begin:end], sizes[begin:end], totals[begin:end], *shared.value[:2])
        best = totals.argmax(axis=1)  # the first of equals, labels being sorted
        some = counts > 0
        return pd.DataFrame(
            {
                "lang": np.where(some, shared.value[3][best], None),
                "score": pd.Series(totals.max(axis=1)).astype("Int64").where(some),
            }
        )

    # So that a test on the language is not pushed below a deduplication that left fewer texts.
    return score.asNondeterministic()


def _runs(group: np.ndarray) -> list[tuple[int, int]]:
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
    return [(b, e) for b, e in zip(edges, edges[1:]) if b < e]


def _add_gains(texts: pd.Series, sizes: np.ndarray, totals: np.ndarray, keys: np.ndarray, gain: np.ndarray) -> None:
    """Add to ``totals`` what each known n-gram gains over an unseen one."""
    codes = _codes("".join(texts))
    if not len(codes) or not len(keys):
        return
    owner = np.repeat(np.arange(len(texts)), sizes)
    inside = owner[: len(codes)] == owner[NGRAM - 1 :]
    owner, codes = owner[: len(codes)][inside], codes[inside]
    at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
    known = keys[at] == codes
    owner, at = owner[known], at[known]
    for k in range(totals.shape[1]):  # weights stay below 2**53, so the sums are exact
        totals[:, k] += np.bincount(owner, gain[at, k], len(texts)).astype(np.int64)


def _codes(text: str, spaced: bool = False) -> np.ndarray:
    """One integer per n-gram of ``text``; ``spaced`` takes every third position only."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if spaced:
        points = points.reshape(-1, NGRAM)
        return sum(points[:, k] << (_BITS * (NGRAM - 1 - k)) for k in range(NGRAM))
    count = max(len(points) - NGRAM + 1, 0)
    return sum(points[k : k + count] << (_BITS * (NGRAM - 1 - k)) for k in range(NGRAM))


def predict(
    df: DataFrame,
    model: DataFrame,
    keys: Sequence[str],
    text: str = "text",
    max_rows: int = PROFILE_ROWS,
    max_bytes: int = PROFILE_BYTES,
) -> DataFrame:
    """``df`` with ``lang`` and ``score``; null where the text has no n-gram.

    ``keys`` identify a row. A profile of at most ``max_rows`` rows and ``max_bytes`` goes to the
    tasks and the data is not shuffled; a larger one is joined. Its size is counted before any of
    it comes to the driver.
    """
    model = model.select("label", "gram", "score")
    size = model.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("gram").alias("grams"), F.count_if(F.col("gram") == "").alias("labels")
    ).head()
    if size.rows <= max_rows and 8 * size.grams * (size.labels + 1) <= max_bytes:
        rows = model.toPandas()
        scored = df.withColumn("_best", _scorer(rows, df.sparkSession)(F.col(text)))
        return scored.select(*df.columns, "_best.lang", "_best.score")
    return df.join(_predict_by_join(df, model, keys, text), list(keys), "left")


def _predict_by_join(df: DataFrame, model: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """The same by joins. N-grams are counted per text first, so a frequent one
    meets the profile once per text and the profile has one row per n-gram."""
    floors = {r.label: r.score for r in model.where("gram = ''").collect()}  # one row per label
    labels = sorted(floors)
    gains = (
        model.where("gram <> ''")
        .groupBy("gram")
        .pivot("label", labels)
        .agg(F.first("score"))
        .select("gram", *[(F.col(f"`{n}`") - F.lit(floors[n])).alias(f"_g{i}") for i, n in enumerate(labels)])
    )
    counts = _explode_ngrams(df, text, keys).groupBy(*keys, "gram").agg(F.count(F.lit(1)).alias("_n"))
    totals = [
        F.sum(F.col("_n") * (F.coalesce(f"_g{i}", F.lit(0)) + F.lit(floors[n])))
        for i, n in enumerate(labels)
    ]
    scored = counts.join(gains, "gram", "left").groupBy(*keys).agg(F.array(*totals).alias("_totals"))
    best = F.array_max("_totals")
    place = F.array_position("_totals", best).cast("int")  # the first of equals, labels being sorted
    return scored.select(
        *keys, F.element_at(F.lit(labels), place).alias("lang"), best.alias("score")
    )
