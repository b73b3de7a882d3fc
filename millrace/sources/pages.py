"""Seeds and stored pages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.text import WHITESPACE
from millrace.functions.urls import canonical_url

PAGE_SCHEMA = "url STRING, status INT, content_type STRING, html STRING, fetched_at TIMESTAMP"


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """``(seed, ord)`` from a file with one URL per line; ``#`` lines and blank ones are skipped."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"no file or folder of seeds at {path}") from e
    seed = F.regexp_replace("value", rf"^[{WHITESPACE}]+|[{WHITESPACE}]+\z", "")
    kept = lines.select(seed.alias("seed"), F.monotonically_increasing_id().alias("ord"))
    kept = kept.where("seed <> '' and not startswith(seed, '#')")
    if kept.isEmpty():
        raise ValueError(f"{path} holds no seed, only comments and blank lines")
    return kept


def seed_frontier(seeds: DataFrame) -> DataFrame:
    """``(url, depth, ord)`` of canonical seeds; those without a canonical form are left out."""
    return seeds.select(
        canonical_url(F.col("seed")).alias("url"), F.lit(0).alias("depth"), F.col("ord").cast("bigint")
    ).where("url <> ''")


def with_response(pages: DataFrame) -> DataFrame:
    """Pages with ``status`` and ``content_type``; a table without them holds good HTML pages."""
    for name, value in (("status", F.lit(200)), ("content_type", F.lit("text/html"))):
        if name not in pages.columns:
            pages = pages.withColumn(name, value)
    return pages


def accepted_pages(pages: DataFrame) -> DataFrame:
    """Pages whose response is usable: status below 400 and an HTML content type."""
    html = F.lower(F.coalesce("content_type", F.lit(""))).contains("text/html")
    return with_response(pages).where((F.col("status") < 400) & html)


def save_pages(pages: DataFrame, table: str, buckets: int) -> None:
    """Store pages in a table bucketed by ``url``.

    A crawl cycle over ``spark.table(table)`` with as many buckets as shuffle partitions joins the
    admitted URLs to the pages where these lie: HTML is never shuffled, however many are admitted.
    """
    pages.write.mode("overwrite").bucketBy(buckets, "url").sortBy("url").saveAsTable(table)


def stream_pages(
    spark: SparkSession,
    path: str,
    schema: StructType | str = PAGE_SCHEMA,
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Page files as they arrive; ``max_files_per_trigger`` limits one cycle."""
    reader = spark.readStream.schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
