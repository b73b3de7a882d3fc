"""Stored pages to the sentence corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import html as H
from millrace.functions import text as T
from millrace.operators.dedup import first_sentences
from millrace.operators.filters import in_language, target_sentences
from millrace.operators.history import History
from millrace.operators.packed import can_pack
from millrace.operators.pages import explode_sentences, extract
from millrace.sources.pages import accepted_pages


def page_time(pages: DataFrame, timestamp: Column | None = None) -> Column:
    """When a page was fetched: as given, else as its table says, else now."""
    if timestamp is not None:
        return timestamp
    return F.col("fetched_at") if "fetched_at" in pages.columns else F.current_timestamp()


def page_sentences(
    pages: DataFrame,
    order: Sequence[str],
    target: str | None,
    model: DataFrame | None = None,
    timestamp: Column | None = None,
    min_chars: int = T.MIN_CHARS,
    script: str = T.ETHIOPIC,
    min_ratio: float = T.MIN_SCRIPT_RATIO,
    drop_tags: Sequence[str] = H.DROP_TAGS,
    native: bool = False,
) -> DataFrame:
    """``(order..., pos, text, url, timestamp)`` of all target sentences, copies included.

    ``order`` names the columns that give the crawl order of pages. Response
    tests and the choice of columns come before the HTML is parsed.
    """
    keep = dict.fromkeys([*order, "url"])
    usable = accepted_pages(pages).select(*keep, page_time(pages, timestamp).alias("timestamp"), "html")
    found = explode_sentences(extract(usable, drop_tags, native))
    kept = target_sentences(
        found, [*order, "pos"], target, model,
        min_chars=min_chars, script=script, min_ratio=min_ratio,
    )
    return kept.withColumnRenamed("sentence", "text")


def gather(
    pages: DataFrame,
    order: Sequence[str],
    target: str | None,
    model: DataFrame | None = None,
    seen: DataFrame | History | None = None,
    timestamp: Column | None = None,
    **options,
) -> DataFrame:
    """New sentences of ``pages``, each at its first place in crawl order and not in ``seen``.

    The language is looked up for what deduplication leaves, once a text. Where the order is of whole
    numbers, sentences go through deduplication with their place alone, and URL and time of the
    first page are joined to what is left.
    """
    if target is not None and model is None:
        raise ValueError("a target language needs a model (see langid.fit and langid.profile)")
    found = page_sentences(pages, order, None, None, timestamp, **options)
    places = [*order, "pos"]
    carried = [c for c in ("url", "timestamp") if c not in order]
    if not carried or not can_pack(found, places):
        return in_language(first_sentences(found, places, seen), ["hash"], target, model, "text")
    first = in_language(first_sentences(found.select(*places, "text"), places, seen), ["hash"], target, model, "text")
    source = accepted_pages(pages).select(
        *(F.col(c).alias(f"_{n}") for n, c in enumerate(order)), "url", page_time(pages, timestamp).alias("timestamp")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{n}")) for n, c in enumerate(order)]
    joined = first.join(source.select(*(f"_{n}" for n in range(len(order))), *carried), same)
    return joined.select(*found.columns, "hash")
