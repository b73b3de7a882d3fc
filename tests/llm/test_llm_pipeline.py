"""Stages of the pipeline on nulls, empty tables, repeated ids and columns with names that operators use."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"
_RNG = random.Random(3)
LINES = " ".join("".join(_RNG.choices("abcdeilmnorstu", k=_RNG.randrange(2, 9))) for _ in range(120)) + " "


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, f"{LINES}Own words {n} of this text {n * 7}.", "en" if n % 3 else None, "web", 10) for n in range(40)]
    rows += [(None, "no id at all", "en", None, None), (50, None, "en", "web", None), (51, "", None, "web", 0), (52, " \n ", "en", "web", 3)]
    rows += [(53, "word " * 40_000, "en", "web", 200_000), (7, LINES, "en", "web", 1), (7, LINES, "en", "web", 1), (54, "mail a@b.org now", "en", "web", 16)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.selectExpr("*", "1 AS node", "'x' AS key", "2.5 AS score", "'s' AS span", "doc_id AS id", "0 AS row_idx")


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stage_on_odd_rows(spark, docs, name, stage):
    found = stage(spark, docs, SF_DIR)
    rows = found.collect()
    if name == "packing":
        assert {r.doc_id for r in rows} == {r.doc_id for r in docs.select("doc_id").collect()}
        assert [r.doc_tokens for r in rows if r.doc_id == 50] == [1]
        return
    assert found.columns == docs.columns and [f.dataType for f in found.schema] == [f.dataType for f in docs.schema]
    ids = [r.doc_id for r in rows]
    if name == "language ID":
        assert not {50, 51, 52} & set(ids) and {0, 1, 2, 7, 53} <= set(ids)
    elif name == "MinHash near-dedup":
        assert {50, 51, 52, None} <= set(ids) and ids.count(7) in (0, 3) and len(ids) < docs.count()
    elif name == "PII":
        assert len(rows) == docs.count()
        hidden = {r.doc_id: (r.text, r.n_chars) for r in rows}
        assert hidden[54] == ("mail [EMAIL] now", 16) and hidden[50] == (None, None) and hidden[51] == ("", 0)
    else:
        assert {50, 51, 52, None} <= set(ids)


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stage_without_rows(spark, docs, name, stage):
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def test_stages_without_labels(spark, docs):
    """No language is known: nothing can be judged to be in one."""
    nameless = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language(spark, nameless, SF_DIR).count() == 0
