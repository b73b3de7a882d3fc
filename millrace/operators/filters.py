"""The sentence filter: length, then script, then language."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import langid


def target_sentences(
    df: DataFrame,
    keys: Sequence[str],
    target: str | None,
    model: DataFrame | None = None,
    text: str = "sentence",
    min_chars: int = T.MIN_CHARS,
    script: str = T.ETHIOPIC,
    min_ratio: float = T.MIN_SCRIPT_RATIO,
) -> DataFrame:
    """Rows of at least ``min_chars``, mostly in ``script``, predicted to be ``target``.

    The two built-in tests come first, so the language is looked up only for
    what they leave. With ``target=None`` there is no language test.
    """
    c = F.col(text)
    kept = df.where(T.long_enough(c, min_chars)).where(T.in_script(c, script, min_ratio))
    return in_language(kept, keys, target, model, text)


def in_language(df: DataFrame, keys: Sequence[str], target: str | None, model: DataFrame | None, text: str) -> DataFrame:
    """Rows whose ``text`` is predicted to be ``target``; all of them with ``target=None``."""
    if target is None:
        return df
    if model is None:
        raise ValueError("a target language needs a model (see langid.fit and langid.profile)")
    scored = langid.predict(df.select(*df.columns), model, keys, text)
    return scored.where(F.col("lang") == target).select(df.columns)
