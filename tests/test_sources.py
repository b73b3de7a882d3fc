import json
import os

import pytest
from pyspark.sql import functions as F

from millrace.sources import files
from millrace.sources.output import CrawlState, write_sentences
from millrace.sources.pages import accepted_pages, read_seeds, seed_frontier, with_response


def write(folder, name, content):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(content)
    return path


@pytest.fixture
def tree(folder):
    write(folder, "b/z.JSONL", '{"text": "one", "n": 1}\n{"text": "two", "n": 2}\n')
    write(folder, "b.c/a.json", '{"text": "three", "n": 3}\n')
    write(folder, "a/q.csv", 'text,n\n"x\ny",1\n"say ""hi""",2\n')
    write(folder, "t.txt", "hello\n\nworld\n")
    write(folder, "deep/er/u.TXT", "again\n")
    write(folder, "readme.md", "not data\n")
    os.makedirs(os.path.join(folder, "empty"))
    return folder


def test_listing(spark, tree):
    names = [os.path.relpath(f.removeprefix("file:"), tree) for f in files.list_text_files(spark, tree, "jsonl")]
    assert names == ["b/z.JSONL", "b.c/a.json"]  # part by part: "b" before "b.c"
    own = os.path.join(tree, "readme.md")
    assert len(files.list_text_files(spark, own, "txt")) == 1
    for path, kind in ((os.path.join(tree, "empty"), "txt"), (os.path.join(tree, "none"), "txt"), (tree, "parquet")):
        with pytest.raises(ValueError):
            files.list_text_files(spark, path, kind)
    with pytest.raises(ValueError):
        files.list_text_files(spark, tree, "docx")


def test_read_each_type(spark, tree):
    rows = files.read_text_files(spark, tree, "jsonl", order="o").orderBy("o").collect()
    assert [(r.text, r.n) for r in rows] == [("one", 1), ("two", 2), ("three", 3)]
    rows = files.read_text_files(spark, tree, "csv").orderBy("n").collect()
    assert [(r.text, r.n) for r in rows] == [("x\ny", 1), ('say "hi"', 2)]
    rows = files.read_text_files(spark, tree, "txt", order="o").orderBy("o").collect()
    assert [r.text for r in rows] == ["again", "hello", "", "world"]
    spark.range(3).selectExpr("cast(id as string) text").coalesce(1).write.parquet(os.path.join(tree, "pq"))
    rows = files.read_text_files(spark, os.path.join(tree, "pq"), "parquet", order="o").orderBy("o").collect()
    assert [r.text for r in rows] == ["0", "1", "2"]


def test_single_two_line_file(spark, folder):
    path = write(folder, "a.txt", "hello\nworld\n")
    df = files.text_column(files.read_text_files(spark, path, "txt"), "text")
    assert df.columns == ["text"] and df.count() == 2


def test_malformed_json_fails(spark, folder):
    path = write(folder, "bad.jsonl", '{"text": "ok"}\n{"text": \n')
    for schema in (None, "text string"):
        with pytest.raises(Exception, match="(?i)malformed"):
            files.read_text_files(spark, path, "jsonl", schema).collect()


def test_text_column(spark):
    df = spark.createDataFrame([("a", "b", 1)], "text string, body string, n int")
    assert files.text_column(df, "body").collect() == [("b",)]
    with pytest.raises(ValueError, match="text.*body.*n"):
        files.text_column(df, "missing")


def test_text_column_without_inference(spark, tree, folder):
    rows = files.read_text_column(spark, tree, "jsonl", "text", order="o").orderBy("o").collect()
    assert [r.text for r in rows] == ["one", "two", "three"]
    assert sorted(r.text for r in files.read_text_column(spark, tree, "csv").collect()) == ['say "hi"', "x\ny"]
    # Numbers are taken as written; a column that starts late is still found.
    late = write(folder, "late.jsonl", '{"a": 1}\n' * 1500 + '{"a": 2, "b": "x"}\n')
    assert files.read_text_column(spark, late, "jsonl", "a").where("text = '2'").count() == 1
    assert files.read_text_column(spark, late, "jsonl", "b").where("text = 'x'").count() == 1
    for path in (late, write(folder, "early.jsonl", '{"a": 2, "b": "x"}\n')):
        assert files.read_text_column(spark, path, "jsonl", "a").schema["text"].dataType.simpleString() == "string"
    with pytest.raises(ValueError, match="'a', 'b'"):
        files.read_text_column(spark, late, "jsonl", "c")


def test_named_dataset(spark, folder):
    spark.range(3).selectExpr("cast(id as string) text").coalesce(1).write.parquet(f"{folder}/raw")
    for subset, split in (("", "train"), ("sub", "test")):
        target = os.path.join(folder, "name", subset)
        os.makedirs(target, exist_ok=True)
        source = next(f for f in os.listdir(f"{folder}/raw") if f.endswith(".parquet"))
        with open(f"{folder}/raw/{source}", "rb") as f, open(os.path.join(target, f"{split}-0.parquet"), "wb") as g:
            g.write(f.read())
    assert files.read_dataset(spark, folder, "name").count() == 3
    assert files.read_dataset(spark, folder, "name", " ").count() == 3
    assert files.read_dataset(spark, folder, "name", "sub", "test").count() == 3
    assert files.read_dataset(spark, folder, "name", streaming=True).isStreaming
    # Another split with the same beginning is another split.
    spark.range(5).write.parquet(f"{folder}/other/validation")
    spark.range(2).write.parquet(f"{folder}/other/val")
    assert files.read_dataset(spark, folder, "other", split="val").count() == 2
    with pytest.raises(ValueError):
        files.read_dataset(spark, folder, "name", split="trai")
    with pytest.raises(ValueError):
        files.read_dataset(spark, folder, "name", "other")


def test_seeds(spark, folder):
    path = write(folder, "seeds.txt", "# c\n\n  HTTP://A.b/x/ \nmailto:no\nhttp://c\n#http://d\n")
    seeds = read_seeds(spark, path)
    assert [r.seed for r in seeds.orderBy("ord").collect()] == ["HTTP://A.b/x/", "mailto:no", "http://c"]
    assert [(r.url, r.depth) for r in seed_frontier(seeds).orderBy("ord").collect()] == [
        ("http://a.b/x", 0), ("http://c/", 0),
    ]
    with pytest.raises(ValueError):
        read_seeds(spark, write(folder, "none.txt", "# only\n\n"))
    with pytest.raises(FileNotFoundError):
        read_seeds(spark, os.path.join(folder, "absent.txt"))


def test_accepted_pages(spark):
    rows = [("a", 200, "Text/HTML; charset=x"), ("b", 399, "text/html"), ("c", 400, "text/html"),
            ("d", 200, "application/pdf"), ("e", 200, None)]
    df = spark.createDataFrame(rows, "url string, status int, content_type string")
    assert [r.url for r in accepted_pages(df).orderBy("url").collect()] == ["a", "b"]
    assert with_response(df.select("url")).columns == ["url", "status", "content_type"]


def test_sentence_output_appends_readable_lines(spark, folder):
    path = os.path.join(folder, "new", "out")
    df = spark.createDataFrame([("ሰላም", "http://h/", 1.5)], "text string, url string, s double").select(
        "text", "url", F.timestamp_seconds("s").alias("timestamp")
    )
    write_sentences(df, path)
    write_sentences(df, path)
    lines = [l for n in os.listdir(path) if n.endswith(".json") for l in open(f"{path}/{n}", encoding="utf-8")]
    assert len(lines) == 2 and "ሰላም" in lines[0]
    assert json.loads(lines[0]) == {"text": "ሰላም", "url": "http://h/", "timestamp": "1970-01-01T00:00:01.500000+00:00"}


def test_crawl_state(spark, folder):
    state = CrawlState(spark, f"{folder}/state")
    visits = lambda *rows: spark.createDataFrame(rows, "url string, last_visited bigint")
    hashes = lambda *rows: spark.createDataFrame([(r,) for r in rows], "hash string")
    assert state.last_cycle() == -1 and state.visited().count() == 0
    queue = spark.createDataFrame([("q", 1, 0)], "url string, depth int, ord bigint")
    state.commit(0, visits(("a", 10), ("b", 10)), hashes("x"), queue)
    state.commit(1, visits(("a", 20)), hashes("y"))
    # A cycle that wrote its tables and stopped before the commit is not seen.
    visits(("c", 30)).write.parquet(f"{folder}/state/visited/cycle=2")
    assert sorted(map(tuple, state.visited().collect())) == [("a", 20), ("b", 10)]
    assert sorted(r.hash for r in state.hashes().collect()) == ["x", "y"]
    assert state.frontier().count() == 0  # cycle 1 left nothing queued
    state.commit(1, visits(("z", 99)))  # already committed
    assert state.visited().where("url = 'z'").isEmpty()
    # Tables without their commits are damage, not a new state.
    visits(("a", 1)).write.parquet(f"{folder}/damaged/visited/cycle=0")
    with pytest.raises(ValueError, match="without its commits"):
        CrawlState(spark, f"{folder}/damaged").last_cycle()
    merged = state.compact(f"{folder}/merged")
    assert sorted(map(tuple, merged.visited().collect())) == [("a", 20), ("b", 10)]
    assert merged.last_cycle() == 1
