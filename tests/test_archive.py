import gzip
import io
import os

import pytest
from pyspark.sql import functions as F

from millrace.sources import archive
from millrace.streaming import runs

SCHEMA = "page_id int, url string, status int, content_type string, html string, fetched_at timestamp"


def pages(spark, low, high):
    rows = [
        (n, f"http://h/{n}?a b\r\n", 404 if n % 5 == 0 else 200, "Text/HTML; charset=utf-8", f"<p>é{n}</p>\r\n\r\nWARC/1.1\r\n" * (n % 4))
        for n in range(low, high)
    ]
    df = spark.createDataFrame(rows, "page_id int, url string, status int, content_type string, html string")
    return df.withColumn("fetched_at", F.timestamp_seconds(F.col("page_id") + 1_000_000))


def rows_of(df):
    return sorted((r.url, r.status, r.content_type, r.html, r.fetched_at and r.fetched_at.timestamp()) for r in df.collect())


def plain(df):
    return sorted(
        (r.url.replace("\r", " ").replace("\n", " ").strip(), r.status, r.content_type, r.html, r.fetched_at.timestamp()) for r in df.collect()
    )


def test_archives_round_trip_in_batch_and_as_a_stream(spark, folder):
    archive.register(spark)
    given = pages(spark, 0, 40)
    archive.write_archives(given.repartition(3), f"{folder}/in")
    read = spark.read.format("page_archive").load(f"{folder}/in")
    assert rows_of(read) == plain(given) and read.rdd.getNumPartitions() == 3

    def once():
        found = spark.readStream.format("page_archive").load(f"{folder}/in")
        runs.start_files(found, f"{folder}/out", f"{folder}/check", once=True).awaitTermination()
        return rows_of(spark.read.schema(found.schema).parquet(f"{folder}/out"))

    assert once() == plain(given)
    assert once() == plain(given)  # nothing new
    archive.write_archives(pages(spark, 40, 50), f"{folder}/in")
    assert once() == plain(pages(spark, 0, 50)) == rows_of(spark.read.format("page_archive").load(f"{folder}/in"))


def test_pages_without_responses_and_empty_folders(spark, folder):
    archive.register(spark)
    few = spark.createDataFrame([(1, "http://a/", None), (2, None, "<p>x</p>")], "page_id int, url string, html string")
    archive.write_archives(few, f"{folder}/in")
    found = spark.read.format("page_archive").load(f"{folder}/in")
    assert rows_of(found) == [("", 200, "text/html", "<p>x</p>", None), ("http://a/", 200, "text/html", "", None)]
    os.makedirs(f"{folder}/none")
    assert spark.read.format("page_archive").load(f"{folder}/none").count() == 0


@pytest.mark.parametrize("damage", ["cut", "length", "noise", "empty"])
def test_damaged_archives(damage):
    good = archive.record("http://a/", 200, "text/html", "<p>a</p>", None)
    data = {
        "cut": good + good[:-9],
        "length": good + good.replace(b"WARC-Target-URI: http://a/\r\nContent-Length: ", b"WARC-Target-URI: http://a/\r\nContent-Length: x") + good,
        "noise": good + b"no record\r\n" + good,
        "empty": b"",
    }[damage]
    want = [] if damage == "empty" else [("http://a/", 200, "text/html", "<p>a</p>", None)]
    assert list(archive.parse(io.BytesIO(data))) == want
    other = b"WARC/1.1\r\nWARC-Type: request\r\nContent-Length: 3\r\n\r\nGET\r\n\r\n"
    assert len(list(archive.parse(io.BytesIO(other + good + other + good)))) == 2


def test_members_by_record_are_read_too(folder):
    """Archives of others are compressed record by record."""
    os.makedirs(f"{folder}/in/_hidden")
    with open(f"{folder}/in/a.warc.gz", "wb") as file:
        for n in range(5):
            file.write(gzip.compress(archive.record(f"http://a/{n}", 200, "text/html", "x" * n, None)))
    with open(f"{folder}/in/_hidden/b.warc", "wb") as file:
        file.write(b"junk")
    reader = archive._Reader(f"{folder}/in")
    parts = reader.partitions()
    assert len(parts) == 1 and [len(row[3]) for row in reader.read(parts[0])] == [0, 1, 2, 3, 4]
