"""From stored pages to sentences and links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import html as H
from millrace.functions import text as T
from millrace.functions import urls as U


def extract(
    pages: DataFrame,
    drop_tags: Sequence[str] = H.DROP_TAGS,
    native: bool = False,
) -> DataFrame:
    """``html`` replaced by ``text`` (normalized) and ``hrefs`` (absolute, page order)."""
    html, url = F.col("html"), F.col("url")
    rest = [c for c in pages.columns if c != "html"]
    if native:
        return pages.select(
            *rest,
            H.native_text(html, drop_tags).alias("text"),
            F.transform(
                H.native_hrefs(html, drop_tags), lambda h: U.resolve_url(url, h)
            ).alias("hrefs"),
        )
    parsed = pages.select(*rest, H.parsed_page(drop_tags)(html, url).alias("_page"))
    return parsed.select(
        *rest,
        T.normalize_text(F.col("_page.text")).alias("text"),
        F.col("_page.links").alias("hrefs"),
    )


def explode_sentences(df: DataFrame, text: Column | str = "text") -> DataFrame:
    """One row per sentence: the other columns, ``pos`` and ``sentence``."""
    text = F.col(text) if isinstance(text, str) else text
    rest = [c for c in df.columns if c not in ("text", "hrefs", "html")]
    return df.select(*rest, F.posexplode(T.split_sentences(text)).alias("pos", "sentence"))


def explode_links(df: DataFrame) -> DataFrame:
    """One row per kept link: the other columns, ``pos`` (0-based, gaps where a link
    was dropped) and canonical ``link``."""
    rest = [c for c in df.columns if c not in ("text", "hrefs", "html")]
    # Made canonical before the rows are split: a test on a generated column is not
    # pushed below it, so no later filter or join key computes the URL again.
    links = F.transform("hrefs", lambda h: U.canonical_url(h))
    return df.select(*rest, F.posexplode(links).alias("pos", "link")).where("link <> ''")
