"""The registered queries of this package, and the pipeline, on the smallest test tables."""

import importlib.util
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from millrace.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    yield con
    con.close()


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    places = [want.columns.index(c) for c in columns]
    expected = sorted(repr(tuple(row[p] for p in places)) for row in want.fetchall())
    assert sorted(repr(tuple(r)) for r in got.select(columns).collect()) == expected


def test_every_query_is_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize(("name", "part", "of"), [("op3_hyperlang", 2, 4), ("op7_noisy_or", 0, 5)])
def test_held_out(spark, name, part, of):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % of == part) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == 200


def test_languages_of_held_out_texts(spark):
    found = {r.doc_id: r for r in QUERIES["op3_hyperlang"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    held = [d for d in docs if found[d.doc_id].held_out and d.lang]
    assert np.mean([found[d.doc_id].lang_pred == d.lang for d in held]) >= 0.95


@pytest.mark.skipif(importlib.util.find_spec("tokenizers") is None, reason="no tokenizers")
def test_packing_holds_every_id_once(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    check_pieces(QUERIES["op4_nnls_packing"](spark, SF_DIR).collect(), docs)


def check_pieces(rows, docs, window=2048):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for doc, text in docs.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0 and at < window


def test_neighbours_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    matrix = np.array([r.embedding for r in rows], float)
    found = defaultdict(list)
    for r in QUERIES["op6_kmeans_tree"](spark, SF_DIR).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    hits = 0
    assert set(found) == {i for i in ids.tolist() if i % 20 == 0}
    for query, listed in found.items():
        scores = matrix @ matrix[ids == query][0]
        scores[ids == query] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        listed.sort()
        assert [n for n, _, _ in listed] == list(range(1, 21))
        assert all(abs(scores[ids == v][0] - s) < 1e-9 for _, v, s in listed)
        assert [(-s, v) for _, v, s in listed] == sorted((-s, v) for _, v, s in listed)
        hits += len({v for _, v, _ in listed} & set(best.tolist()))
    assert hits >= 0.9 * 20 * len(found)


def test_rules_and_verdicts(spark):
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    rows = QUERIES["op9_url_filter"](spark, SF_DIR).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in rows:
        rest = urls[r.page_id].partition("://")[2].split("#")[0].split("?")[0]
        host, slash, path = rest.partition("/")
        path = slash + path
        fitting = []
        for rule in rules:
            name, _, start = rule.partition("/")
            if f".{host.lower()}".endswith(f".{name}") and path.startswith(f"/{start}"):
                fitting.append(rule)
        rule = max(fitting, key=len, default=None)
        assert (r.host, r.path, r.rule) == (host.lower(), path, rule)
        assert r.verdict == (rules[rule] if rule else "block" if r.probability >= 0.5 else "allow")


def test_pages_without_their_furniture(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in QUERIES["op2_wrapper"](spark, SF_DIR).collect():
        assert r.n_chars == len(r.text)
        title = pages[r.page_id].partition("<h1>")[2].partition("</h1>")[0]
        assert r.text.startswith(title.split("&")[0].strip()[:20])
        assert "track(" not in r.text and "<" not in r.text.replace("< ", "")


def test_pipeline_stages_against_plain_versions(spark):
    """Each stage on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.store(stage(spark, docs, SF_DIR))
        kept[name] = docs
        if name != "packing":
            assert docs.columns == before.columns

    def texts(df):
        return {r.doc_id: r.text for r in df.collect()}

    languages, unique, clean, private = (texts(kept[n]) for n, _ in corpus_pipeline.STAGES[:4])
    sets = {}
    for i, text in languages.items():
        words = text.encode().lower().split()
        sets[i] = {tuple(words[j : j + 5]) for j in range(len(words) - 4)} or {tuple(words)} - {()}
    groups = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(groups[a], groups[b]), min(groups[a], groups[b])
                groups = {k: new if g == old else g for k, g in groups.items()}
    assert set(unique) == {i for i, g in groups.items() if i == g}
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    windows = {w for t in items for w in windows_of(t, True)}
    assert set(clean) == {i for i, t in unique.items() if not windows & windows_of(t, False)}
    assert set(private) == set(clean) and not any("@mail" in t for t in private.values())
    check_pieces(kept["packing"].collect(), private)


def variety(text):
    grams = Counter(text.lower()[i : i + 3] for i in range(len(text) - 2))
    return sum(grams.values()) ** 2 / max(1, sum(n * n for n in grams.values()))


def test_language_stage_with_a_language_left_out(spark):
    """Its texts go; short and repetitive texts stay, and so do all of the known languages."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    short = spark.createDataFrame(
        [(-n, t, None, "x", len(t)) for n, t in enumerate(["Von.", "Avec.", "A.", "Osrañ.", "A.\nAll rights reserved.", "12 !"], 1)],
        docs.schema,
    )
    out = "fr"
    taught = docs.withColumn("lang", F.when(F.col("lang") != out, F.col("lang"))).unionByName(short)
    kept = {r.doc_id for r in corpus_pipeline.language(spark, taught, SF_DIR).select("doc_id").collect()}
    rows = docs.where("text RLIKE '[A-Za-z]'").collect()
    foreign = [r.doc_id for r in rows if r.lang == out and variety(r.text) >= 150]
    assert len(foreign) > 10 and sum(i in kept for i in foreign) <= 0.1 * len(foreign)
    assert {r.doc_id for r in rows if r.lang and r.lang != out} <= kept
    assert {-n for n in range(1, 6)} <= kept and -6 not in kept


def windows_of(text, item):
    import re

    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().lower())
    found = {tuple(words[i : i + 10]) for i in range(len(words) - 9)}
    return found or ({tuple(words)} if item and words else set())
