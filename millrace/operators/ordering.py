"""Row numbers over a whole table without putting it through one task.

A window ordered over everything would run in a single task. Here a row's
number is its position inside its file plus the rows in the files before it,
and both come from Parquet metadata. Only one count per file is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.sizing import broadcast_if_small, spread, workspace
from millrace.sources.files import decoded


def _number(df: DataFrame, file_key: Column, name: str) -> DataFrame:
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    per_file = df.groupBy(path.alias("_file")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy(file_key).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_file.select(
        F.col("_file"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    placed = spread(df.select("*", path.alias("_file"), row.alias("_row")))
    return (
        placed.join(broadcast_if_small(starts), "_file")
        .withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_file", "_row", "_start")
    )


def index_by_file(spark: SparkSession, path: str, *columns: str, name: str = "row_idx", **options: str) -> DataFrame:
    """Parquet under ``path`` with a dense row number: files by path part, then file order.

    No shuffle of the data. ``options`` go to the reader.
    """
    df = spark.read.options(**options).parquet(path)
    df = df.select(*columns) if columns else df
    return index_read(df, name)


def index_read(df: DataFrame, name: str = "row_idx") -> DataFrame:
    """A Parquet read with a dense row number, as :func:`index_by_file` gives it."""
    return _number(df, F.split(decoded(F.col("_file")), "/"), name)


def index_lines(df: DataFrame, order: str, name: str = "row_idx") -> DataFrame:
    """A read of text files with a dense row number instead of ``order``, as
    :func:`read_text_files` gives it: (path, start of the split, place).

    Rows stay where they are. A first pass counts the rows of each split, and where its places begin;
    one row a split is gathered. Both passes cut the files into the same splits.
    """
    place = F.col(f"{order}.row")
    splits = df.groupBy(F.col(f"{order}.path").alias("_path"), F.col(f"{order}.start").alias("_from")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(place).alias("_first")
    )
    before = Window.orderBy("_path", "_from").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("_path", "_from", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    same = (F.col(f"{order}.path") == F.col("_path")) & (F.col(f"{order}.start") == F.col("_from"))
    placed = df.join(broadcast_if_small(starts), same).withColumn(name, F.col("_shift") + place)
    return placed.select(name, *[c for c in df.columns if c != order])


def index_by_key(df: DataFrame, *order: Column | str, name: str = "row_idx") -> DataFrame:
    """``df`` with a dense row number in ``order``, which has to be a total order.

    One range shuffle, and one table written to the shared workspace so that
    counting and numbering see the same rows in the same places.
    """
    spark, path = df.sparkSession, workspace(df.sparkSession)
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    base = F.substring_index("_file", "/", -1)
    part = F.regexp_extract(base, r"part-(\d+)-", 1).cast("bigint")
    chunk = F.regexp_extract(base, r"-c(\d+)\.", 1).cast("bigint")
    written = spark.read.schema(df.schema).parquet(path)
    return _number(written, F.struct(part, chunk), name)
