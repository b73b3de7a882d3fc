"""Nulls, empty and long texts, repeated rows, ties, empty tables, clashing columns; and plain models."""

import random
import re
import string
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.llm import anntree, crf, decontaminate, hyperlang, minhash, packing, toxicity, urlfilter, warc, wrapper
from millrace.llm.queries import URL_RULES

LONG = "word " * 30_000 + "end"
TEXTS = [
    (1, None), (2, ""), (3, " \n "), (4, "one"), (5, "One"), (6, LONG), (6, LONG), (7, "a b c d e f g h i j k l"),
    (8, "a b c d e f g h i j k l m"), (None, "a b c d e f g h i j k l"), (9, "été ÉTÉ 12.5 x@y.zz"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", "y", 1.5, None) for i, t in TEXTS]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, score string, leaf string, key double, id string"
    )


def test_minhash_cases(docs):
    rows = minhash.near_duplicates(docs, words=2).collect()
    assert len(rows) == len(TEXTS)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert found[1] == found[1][:0] + (0, 1, True) and found[2][0] == found[3][0] == 0
    assert found[4] == (1, 4, True) and found[5] == (1, 4, False)
    assert found[6] == (2, 6, True)
    assert found[7][1] == found[8][1] == 7  # 11 of 12 shingles
    assert found[None] == (11, None, True)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [minhash.BLOCK_TEXTS, 5])
def test_minhash_against_all_pairs(spark, monkeypatch, block):
    """Families of copies of copies, so that links form chains and buckets hold several components; and
    a large group most of whose pairs are a little below the bound."""
    monkeypatch.setattr(minhash, "BLOCK_TEXTS", block)
    rng = random.Random(4)
    words = ["".join(rng.choices(string.ascii_lowercase, k=4)) for _ in range(400)]
    texts = []
    for _ in range(12):
        base = rng.choices(words, k=60)
        for _ in range(14):
            copy = list(base)
            for at in rng.sample(range(60), rng.choice([1, 2, 3, 4, 6])):
                copy[at] = rng.choice(words)
            texts.append(" ".join(copy))
            if rng.random() < 0.3:
                base = copy
    base = rng.choices(words, k=100)
    for _ in range(120):
        copy = list(base)
        for at in rng.sample(range(100), rng.choice([5, 6, 7])):
            copy[at] = rng.choice(words[:30])
        texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words=2).collect()}
    sets = [set(zip(w, w[1:], strict=False)) for w in (t.split() for t in texts)]
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    assert found == dict(enumerate(label))
    assert 60 < len(set(label)) < len(texts) - 60


def test_wide_signatures_pass_over_texts_without_words():
    rows = pd.DataFrame({"id": [1, 1, 2, 3, 3], "text": ["a b c d", None, " ", "a b c d", ""]})
    for words in (2, 5):
        found = pd.concat(minhash._wide(words)(iter([rows, rows[1:3]])))
        assert found["node"].tolist() == [1, 3] and found["bits"].iloc[0].tolist() == found["bits"].iloc[1].tolist()


def test_circulant_signature_is_a_shifted_permutation():
    hashes = np.arange(5, dtype=np.uint64) * np.uint64(977)
    low = minhash.signature(hashes, 8)
    circle = minhash._circle(8)
    places = (minhash.mix(hashes) >> np.uint64(64 - minhash.SPACE_BITS)).astype(int)
    assert low.tolist() == [min(circle[(p + i) % (1 << minhash.SPACE_BITS)] for p in places) for i in range(8)]


def test_decontamination_cases(spark, docs):
    items = spark.createDataFrame(
        [(10, "c d e f g h i j k l"), (11, "ONE"), (12, None), (None, "été"), (13, "..."), (14, "c d e f g h i j k l")],
        "item_id bigint, text string",
    )
    found = {r.doc_id: r for r in decontaminate.decontaminate(docs, items).collect()}
    assert found[7].n_hit == 10 and found[7]["items"] == ["10", "14"] and found[7].n_words == 12
    assert found[4]["items"] == found[5]["items"] == ["11"] and found[4].n_hit == 1
    assert found[9].n_hit == 1 and found[9]["items"] == [] and found[9].contaminated  # ÉTÉ is another word
    assert found[None].contaminated and not found[1].contaminated and found[1].n_words == 0
    assert found[6].n_words == 30_001 and not found[6].contaminated
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 6}
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).where("contaminated").count() == 0


def test_every_shared_window_is_found(spark):
    rng = random.Random(2)
    words = list("abcdefg")
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(30)]
    texts = [(i, " ".join(rng.choices(words, k=40) + items[i % 30][1].split() + rng.choices(words, k=20))) for i in range(60)]
    windows = {}
    for i, t in items:
        w = t.split()
        for j in range(max(1, len(w) - 9)):
            windows.setdefault(tuple(w[j : j + 10]), set()).add(str(i))
    want = {}
    for i, t in texts:
        w, hit, named = t.split(), set(), set()
        for n in range(1, 11):
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit |= set(range(j, j + n))
                    named |= windows[tuple(w[j : j + n])]
        want[i] = (len(hit), sorted(named))
    found = decontaminate.decontaminate(
        spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    assert {r.doc_id: (r.n_hit, r["items"]) for r in found.collect()} == want


def test_language_cases(docs, spark):
    taught = spark.createDataFrame(
        [(1, "the of and this that", "en"), (2, "der die das und nicht", "de"), (3, None, "fr"), (4, "x", None)],
        "doc_id bigint, text string, lang string",
    )
    known = hyperlang.train(taught)
    assert list(known) == ["de", "en"]
    rows = hyperlang.predict(docs, known).collect()
    assert len(rows) == len(TEXTS) and rows[0].lang_pred == "und" and rows[0].score == 0.0
    assert all(0 <= r.score <= 1 for r in rows) and rows[6].lang_pred in ("de", "en")
    assert hyperlang.predict(docs, {}).select("lang_pred").distinct().collect()[0][0] == "und"
    assert hyperlang.predict(docs.limit(0), known).count() == 0
    ask = spark.createDataFrame([(1, "THAT and THIS 12!"), (2, "nicht das"), (3, "12 !")], "doc_id bigint, text string")
    assert [r.lang_pred for r in hyperlang.predict(ask, known).orderBy("doc_id").collect()] == ["en", "de", "und"]


def test_bundles_are_sums_of_bound_vectors():
    text = "abca"
    codes = hyperlang.letter_codes(text)
    want = sum(
        np.prod([np.roll(hyperlang._letter(codes[i + p]), p).astype(int) for p in range(3)], axis=0) for i in range(len(codes) - 2)
    )
    assert np.allclose(hyperlang.Bundler().bundle([text])[0], want / np.linalg.norm(want), atol=1e-6)


def test_every_labelled_text_teaches_and_bounds(spark):
    common, rare = (" ".join("".join(random.Random(seed).choices("abcdeilmnorstu", k=6 * n))[i * 6 : i * 6 + 6] for i in range(n)) for seed, n in ((1, 15), (2, 60)))
    copies = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit(common).alias("text"))
    few = spark.range(10).select((F.col("id") + 30_000).alias("doc_id"), F.lit("en").alias("lang"), F.lit(rare).alias("text"))
    rows = copies.unionByName(few)
    known = hyperlang.train(rows)
    one, other = hyperlang.Bundler().bundle([common, rare]).astype(float)
    want = 30_000 * one + 10 * other
    assert np.allclose(known["en"], want / np.linalg.norm(want), atol=1e-6)
    bundler = hyperlang.Bundler()
    bundler.bundle([common, rare])
    bands = [int(np.floor(2 * np.log2(v))) for v in bundler.variety]
    # Ten texts give a band its bound, if each of them counts.
    assert sorted(hyperlang.least_scores(rows, known)) == sorted(bands) and len(set(bands)) == 2


def test_encoder_equals_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    encoder = packing.Encoder(packing.vocabulary(packing.TOKENIZER), packing.vocabulary(packing.RANKS))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokenizer.encode("a<|endoftext|>b c", add_special_tokens=False).ids[1] == 50256
    rng = random.Random(1)
    texts = ["", " ", "a  b", "a\n\n b \n c", "  x", "x  ", "\n", "it's 12 3.4 <|endoftext|> z", "<|endoftext|>", "a<|endoftext|>b c <|endoftext|>", "<|endoftext", "x <| endoftext|>", "x\x1c y", "a\0 b", "\u00e9 \u4f60\u597d  \U0001f600"]
    texts += ["".join(rng.choice("ab' \n\t1.é\u3000") for _ in range(30)) for _ in range(300)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing_cases(docs):
    rows = packing.pack(docs).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == {i for i, _ in TEXTS}
    assert [r.doc_tokens for r in by_doc[1]] == [1] and by_doc[1][0].ids_crc32 == zlib.crc32(b"\1\0\0\0")
    assert sum(r.length for r in by_doc[6]) == 2 * by_doc[6][0].doc_tokens
    assert packing.pack(docs.limit(0)).count() == 0


def test_plan_places_every_piece_without_a_gap():
    histogram = np.random.default_rng(0).integers(0, 9, 65)
    histogram[0] = 0
    plan = packing.Plan(histogram)
    sequences = {}
    for n in range(1, 65):
        for rank in range(histogram[n]):
            parts = plan.place(n, rank)
            assert sum(size for _, size, _, _ in parts) == n
            for _, size, sequence, offset in parts:
                sequences.setdefault(sequence, []).append((offset, size))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == 64 or at & (at - 1) == 0 and at < 64


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(spark, folder, version):
    rows = [
        ("http://a b/c", "1.2.3.4", "20010203", "text/html", b"HTTP/1.0 200 OK\r\nX-Page-Id: 3\r\n\r\n" + bytes(range(256)) * 4),
        ("http://x/", "1.2.3.4", "20010203040506", "text/html", b"HTTP/1.0 200 OK\nX-Page-Id: 2\n\n" + bytes(range(256)) * 4),
        ("http://y/", None, None, None, b""),
        ("http://z/", "1.2.3.4", "20010203", "image/gif", b"\n\nWARC/1.1\r\nraw 1 2 3\r\n\r\n" * 9),
    ]
    given = spark.createDataFrame(rows, "url string, ip string, date string, mime string, block binary")
    warc.write_arc(given, f"{folder}/arc", version)
    read = {r.url: bytes(r.block) for r in warc.read_arc(spark, f"{folder}/arc").collect()}
    assert read == {r[0]: r[4] for r in rows}
    warc.arc_to_warc(warc.read_arc(spark, f"{folder}/arc"), "X-Page-Id", f"{folder}/warc")
    found = {r.url: r for r in warc.read_warc(spark, f"{folder}/warc", "X-Page-Id").collect()}
    assert found["http://x/"].type == "response" and found["http://a b/c"].type == "revisit"
    assert found["http://a b/c"].refers_to == "2" and found["http://a b/c"].payload_digest == found["http://x/"].payload_digest
    assert found["http://a b/c"].date == "2001-02-03T00:00:00Z" and found["http://x/"].date == "2001-02-03T04:05:06Z"
    assert bytes(found["http://z/"].block) == rows[3][4] and found["http://y/"].payload_bytes == 0
    assert len({r.record_id for r in found.values()}) == 4
    heads = {}
    for data in warc._archives(spark, f"{folder}/warc").collect():
        for head, _ in warc.parse_warc(warc.unzip(bytes(data.content))):
            heads.setdefault(warc.header(head, "WARC-Type"), []).append(head)
    assert heads["warcinfo"] and len(heads["revisit"]) == 1
    refers = {n: warc.header(heads["revisit"][0], f"WARC-Refers-To{n}") for n in ("", "-Target-URI", "-Date")}
    assert refers == {"": found["http://x/"].record_id, "-Target-URI": "http://x/", "-Date": "2001-02-03T04:05:06Z"}


def test_broken_archives(spark, folder):
    """No file ends the job: what can be told apart is read, and a cut block is marked."""
    head = warc.arc_head(1)
    good = warc.arc_record(1, "http://a/", "1.1.1.1", "2001", "text/plain", b"0123456789")
    cases = {
        "empty": (b"", []), "no line break": (b"filedesc://x 0.0.0.0 2001 text/plain 12", []),
        "no version block": (b"hello\nworld\n", []), "no length": (b"filedesc://x 0 1 text/plain many\n1 0 x\n", []),
        "short version block": (head[:-20], []), "only a version block": (head, []),
        "header cut off": (head + good + b"\nhttp://b/ 1.1.1.1 20", [("http://a/", 10, True)]),
        "fields missing": (head + good + b"\nhttp://b/ 5\nabcde" + good, [("http://a/", 10, True)]),
        "length no number": (head + good + b"\nhttp://b/ 1.1.1.1 2001 text/plain five\nabcde" + good, [("http://a/", 10, True)]),
        "negative length": (head + b"\nhttp://b/ 1.1.1.1 2001 text/plain -5\nabcde", []),
        "block cut off": (head + good + good[:-4], [("http://a/", 10, True), ("http://a/", 6, False)]),
        "bytes that are no text": (head + b"\nhttp://\xff/ 1.1.1.1 2001 text/plain 1\nx" + good, [("http://\ufffd/", 1, True), ("http://a/", 10, True)]),
    }
    import os

    os.makedirs(f"{folder}/arc")
    for n, (data, want) in enumerate(cases.values()):
        assert [(r[0], len(r[4]), r[5]) for r in warc.parse_arc(data)] == want
        with open(f"{folder}/arc/{n}.arc", "wb") as file:
            file.write(data)
    read = warc.read_arc(spark, f"{folder}/arc")
    assert read.count() == sum(len(want) for _, want in cases.values())
    warc.arc_to_warc(read, "X-Page-Id", f"{folder}/warc")
    heads = [h for d in warc._archives(spark, f"{folder}/warc").collect() for h, _ in warc.parse_warc(warc.unzip(bytes(d.content)))]
    assert sum(warc.header(h, "WARC-Truncated") is not None for h in heads) == 1


def test_page_archive_cases(spark, folder):
    page = "<p>é</p>" * 40
    rows = [(1, "u", page), (2, None, page), (3, "v", None), (4, "w", ""), (5, "x", "short"), (6, "y", "short"), (1, "u", page), (None, "z", page)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id bigint, url string, html string, block string")
    warc.write_arc(warc.page_records(pages, "X-Page-Id"), f"{folder}/a")
    warc.arc_to_warc(warc.read_arc(spark, f"{folder}/a"), "X-Page-Id", f"{folder}/w")
    found = [(r.key, r.type, r.payload_bytes, r.refers_to) for r in warc.read_warc(spark, f"{folder}/w", "X-Page-Id").collect()]
    size = len(page.encode())
    assert sorted(found, key=str) == sorted(
        [("1", "response", size, None)] * 2 + [("2", "revisit", size, "1"), ("3", "response", 0, None), ("4", "response", 0, None),
         ("5", "response", 5, None), ("6", "response", 5, None), (None, "response", size, None)], key=str)


def test_unusable_vectors_take_no_part(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 6)] + [
        (6, None), (7, [0.0, 0.0]), (8, [1.0, None]), (9, [float("nan"), 1.0]), (10, [float("inf"), 1.0]), (None, [1.0, 1.0]),
        (12, [1.0]), (20, [5.0, 1.0]), (21, [5.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("leaf", F.lit("clash"))
    usable = anntree.usable(df)
    assert {r.id for r in usable.collect()} == {1, 2, 3, 4, 5, 20, 21}
    found = anntree.neighbours(usable, usable.where("id % 20 = 0"), 20).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [5, 21, 4, 3, 2, 1]  # ties to the smaller id
    assert [r.score for r in found][:3] == [26.0, 26.0, 21.0]
    empty = anntree.usable(df.limit(0))
    assert anntree.neighbours(empty, empty, 20).count() == 0


def test_search_through_many_leaves(spark, monkeypatch):
    """Recall against brute force where a query visits a part of the leaves, in random and in skewed layouts."""
    monkeypatch.setattr(anntree, "LEAF_SAMPLE", 60)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((25, 12)) * 3
    vectors = centres[rng.integers(0, 25, 2000)] + rng.standard_normal((2000, 12))
    rows = anntree.usable(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>"))
    index = anntree.Index(rows)
    leaves = index.calibrate(20)
    assert index.tree.leaves > 30 and leaves < index.tree.leaves / 2
    found = {}
    for r in index.search(rows.where("id % 20 = 0"), 20, leaves).collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    hits = 0
    for q, listed in found.items():
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hits += len(set(listed) & set(np.argsort(-scores)[:20].tolist()))
    assert len(found) == 100 and all(len(x) == 20 for x in found.values())
    assert hits / 2000 >= 0.93


@pytest.mark.parametrize("seed", range(3))
def test_lists_are_full_beside_dense_clusters(spark, monkeypatch, seed):
    """A few dense clusters set the calibration; eight outliers lie in leaves of their own."""
    monkeypatch.setattr(anntree, "LEAF_SAMPLE", 40)
    rng = np.random.default_rng(seed)
    dense = rng.standard_normal((4, 6))[rng.integers(0, 4, 800)] + 0.001 * rng.standard_normal((800, 6))
    vectors = np.concatenate([dense, 50 * rng.standard_normal((8, 6))])
    ids = [*range(1, 801), *range(820, 980, 20)]
    rows = anntree.usable(spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id bigint, embedding array<double>"))
    many = anntree.neighbours(rows, rows.where("id % 20 = 0"), 20).groupBy("query_id").count().collect()
    assert len(many) == 48 and all(r["count"] == 20 for r in many)


def test_toxicity_finds_the_sentence(spark):
    rng = random.Random(0)
    words = ["".join(rng.choices(string.ascii_lowercase, k=3)) for _ in range(80)]
    texts, marks = [], []
    for i in range(300):
        sentences = [" ".join(rng.choices(words, k=6)) for _ in range(5)]
        if i % 4 == 0:
            sentences[i % 5] += " dreadful"
        texts.append(". ".join(sentences) + ".")
        marks.append(int(i % 4 == 0))
    docs = spark.createDataFrame(list(enumerate(texts)) + [(900, None), (901, ""), (None, texts[0])], "doc_id bigint, text string")
    labels = spark.createDataFrame(list(enumerate(marks)) + [(900, 1), (5, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs.withColumn("score", F.lit("old")), model).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == 303 and [found[i].predicted for i in range(300)] == marks
    assert all("dreadful" in texts[i][found[i].worst_start : found[i].worst_end] for i in range(0, 300, 4))
    assert found[900].score == found[901].score == 0.0 and found[900].worst_start is None
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.score(docs, toxicity.train(docs, labels.limit(0))).where("predicted = 1").count() == 0


def test_url_cases(spark):
    urls = [None, "", "nothing", "HTTP://WWW.Example.COM/en/1?x#y", "https://example.com/en/", "https://a.example.com/fr", "ftp://b.net/es/?q",
            "http://com", "http://net/fr/x", "http://subnet/fr/", "http://x.org/casino/porn", "a://b://c/d"]
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    model = urlfilter.train(urlfilter.labelled_urls())
    rows = {r.page_id: r for r in urlfilter.judge(pages, URL_RULES, model).collect()}
    assert [(r.host, r.path) for r in (rows[0], rows[1], rows[2])] == [("", "")] * 3
    assert (rows[3].host, rows[3].path, rows[3].rule, rows[3].verdict) == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert rows[4].rule == "example.com/en/" and rows[4].verdict == "block" and rows[5].rule == "com/"
    assert rows[6].rule == "net/es/" and rows[7].rule is None and rows[8].rule == "net/fr/" and rows[9].rule is None
    assert rows[10].verdict == "block" and (rows[11].host, rows[11].path) == ("b:", "//c/d")
    assert urlfilter.judge(pages.limit(0), URL_RULES, model).count() == 0


def test_url_model_on_its_table():
    model = urlfilter.train(urlfilter.labelled_urls())
    parts = [urlfilter._parts(u) for u, _ in urlfilter.labelled_urls()]
    said = model.probability([h for h, _ in parts], [p for _, p in parts]) >= 0.5
    assert np.mean(said == [b == 1 for _, b in urlfilter.labelled_urls()]) > 0.97


def test_patterns_equal_plain_expressions():
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def fits(kind, match):
        digits = re.sub(r"\D", "", match)
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
            return 13 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    rng = random.Random(3)
    texts = ["".join(rng.choice("ab1.@ -2+(04") for _ in range(80)) for _ in range(2000)] + ["4" * 16 + " 4111 1111 1111 1111", "1" * 50_000, "a" * 50_000 + "@"]
    for text in texts:
        want = [(k, *m.span()) for k, p in plain.items() for m in re.finditer(p, text if len(text) < 1000 or k != "email" else "") if fits(k, m.group())] if len(text) < 1000 else []
        assert crf.pattern_spans(text) == want, text[:80]


def test_viterbi_against_all_paths():
    import itertools

    field = crf.default_field()
    rng = np.random.default_rng(0)
    chains = [rng.integers(1, crf.N_SHAPES, n) for n in (1, 3, 5, 4)]
    for chain, labels in zip(chains, field.viterbi(chains), strict=True):
        e = crf.emissions(chain, field.weights)

        def value(path, e=e):
            start = 0 if crf._START[path[0]] else -1e9
            return start + sum(e[t, x] for t, x in enumerate(path)) + sum(field.moves[a, b] for a, b in itertools.pairwise(path))

        best = max(itertools.product(range(len(crf.LABELS)), repeat=len(chain)), key=value)
        assert value(labels.tolist()) == pytest.approx(value(best))
    plain = crf.shapes(["word"] * 20 + [","] + ["Word"] * 9)
    assert not field.viterbi([plain])[0].any()


def test_long_chains_are_cut_where_nothing_changes(monkeypatch):
    """Chains of every shape, odd ones in clusters, decoded in pieces and whole."""
    field, rng = crf.default_field(), np.random.default_rng(1)
    chains = [np.where(rng.random(n) < 0.85, rng.choice([13, 13, 13, 6, 12], n), rng.integers(1, crf.N_SHAPES, n)) for n in (0, 1, 40, 700, 2500, 6000)]
    chains += [rng.integers(1, crf.N_SHAPES, 3000), np.full(2000, 13)]
    monkeypatch.setattr(crf, "LONG", 1 << 30)
    whole = field.viterbi(chains)
    for long in (64, 300):
        monkeypatch.setattr(crf, "LONG", long)
        cuts = field.cuts(crf.emissions(chains[5], field.weights), np.zeros(1, int), np.array([6000]))
        assert len(cuts[0]) > 3000 / long and cuts[0] == sorted(set(cuts[0]))
        for a, b in zip(whole, field.viterbi(chains), strict=True):
            assert a.tolist() == b.tolist()
    assert [len(x) for x in whole] == [len(c) for c in chains] and whole[5].any()


@pytest.mark.parametrize(("text", "span"), [
    ('a token "QWERTYUIOP" here', "QWERTYUIOP"), ("tel ５５５-８６７-５３０９ now", "５５５-８６７-５３０９"), ("my secret key is QWERTY-ASDF and", "QWERTY-ASDF"),
])
def test_whole_texts_are_decoded(text, span):
    """Also where no ASCII digit or mark of assignment stands near: as the field labels all tokens."""
    field = crf.default_field()
    marks = crf.shapes(crf._TOKEN.findall(text))
    tokens = [m.span() for m in crf._TOKEN.finditer(text)]
    inside = [t for t, label in zip(tokens, field.viterbi([marks])[0], strict=True) if label]
    spans = crf.added_spans([text, "plain words"], [[], []], field)
    assert spans[1] == [] and (spans[0] != []) == bool(inside)
    assert [(a, b) for _, a, b in spans[0]] == ([(inside[0][0], inside[-1][1])] if inside else [])
    if inside:
        assert text[inside[0][0] : inside[-1][1]] in span or span in text[inside[0][0] : inside[-1][1]]


def test_personal_data_cases(spark, docs):
    texts = [(1, "mail a.b@c.org, +1 (288) 555-5549; password=b7db7aa4a5fcc78305 ok"), (2, None), (3, ""), (1, "x" * 100_000 + " 10.0.0.1")]
    df = spark.createDataFrame([(*t, "z") for t in texts], "doc_id bigint, text string, base string")
    rows = crf.find(df).collect()
    assert len(rows) == 4
    first = next(r for r in rows if len(r.base) == 2)
    assert [(s.kind, texts[0][1][s.start : s.end]) for s in first.base] == [("email", "a.b@c.org"), ("phone", "+1 (288) 555-5549")]
    assert [(s.kind, texts[0][1][s.start : s.end]) for s in first.added] == [("secret", "b7db7aa4a5fcc78305")]
    hidden = [r.text for r in crf.redact(df).collect()]
    assert hidden[0] == "mail [EMAIL], [PHONE]; password=[SECRET] ok" and hidden[1] is None and hidden[3].endswith(" [IP]")
    assert crf.find(docs.limit(0)).count() == 0


def test_wrapper_cases(spark):
    head = "<nav><a href=/>Home</a></nav><div class='cookie-notice'>Agree</div>"
    pages = [
        (1, "http://h/a", f"<html><body>{head}<div><p>Welcome to h</p></div><div><p>First&nbsp;story <b>here</b><p>more</div><footer>f</footer>"),
        (2, "http://h/b", f"<html><body>{head}<div><p>Welcome to h</p></div><div><p>Second one</div><footer>f</footer>"),
        (3, "http://h/c", f"<html><body>{head}<div><p>Welcome to h</p></div><div><p>Third &lt;3</div><footer>f</footer>"),
        (4, "http://h/c", None), (5, None, ""), (None, "http://k/", "<article><header><h1>T</h1></header><p>x</p><aside>no</aside></article><p>out"),
        (6, "http://deep/", "<div>" * 3000 + "deep" + "</div>" * 3000), (6, "http://deep/", "<div>" * 3000 + "deep"),
    ]
    df = spark.createDataFrame([(*p, "t") for p in pages], "page_id bigint, url string, html string, text string")
    rows = [(r.page_id, r.text) for r in wrapper.extract(df).collect()]
    found = dict(rows)
    assert len(rows) == len(pages)
    assert found[1] == "First story here\nmore" and found[2] == "Second one" and found[3] == "Third <3"
    assert found[4] == found[5] == "" and found[None] == "T\nx" and found[6] == "deep"
    assert wrapper.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("part", [
    "<svg viewBox='0 0 1 1'/>", "<svg><path d='M0'/><title>no</title><style/><g/></svg>", "<svg><path d='M0'/>",
    "<datalist id=d><option value=a><option value=b>no</datalist>", "<select><optgroup label=g><option>no<option>no</select>",
    "<object data=x>no</object>", "<object data=x>", "<title>no</title>", "<title>", "<iframe src=x>", "<noscript>no</noscript>",
    "<svg><path><div></div><script>no()</script>", "<textarea><p>no</textarea>", "<script>if (a</b/.c) '</p>'</script>", "<template><p>no</template>",
])
def test_text_after_elements_that_are_not_read(part):
    page = f"<html><body><article><p>before</p>{part}<p>after</p></article></body></html>"
    assert wrapper.main_text(*wrapper.observe(page, None)[:2]) == "before\nafter"


def test_alignment_decides_on_marked_pages_too(spark):
    quote = "<blockquote>To be or not</blockquote>"
    story = "<html><body><div>Site</div><article id=post-{0}><h1>Title {0}</h1><p>Story {0}.</p>{1}<p>Mail us</p></article>"
    pages = [
        (n, "http://h/", story.format(n, quote * (n < 8)) + f"<div><p>Varies {n}</p></div><div>Bottom</div>{'<footer>no' * (n > 4)}")
        for n in range(12)
    ]
    # Copies of one page, a page of another build, and a host too small to align.
    pages += [(40 + n, "http://copies/", f"<script>{n}</script><div>Site</div><article>All the same</article>") for n in range(4)]
    pages.append((20, "http://h/", "<section>Menu of the other build</section><article><p>Other</p></article>"))
    pages += [(30 + n, "http://small/", f"<article>Text {n}</article><div>Beside {n}</div>") for n in range(2)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in wrapper.extract(df).collect()}
    for n in range(12):
        quoted = "To be or not\n" * (n < 8)
        assert found[n] == f"Title {n}\nStory {n}.\n{quoted}Varies {n}"
    assert all(found[40 + n] == "All the same" for n in range(4))
    assert found[20] == "Other" and found[30] == "Text 0" and found[31] == "Text 1"


@pytest.mark.parametrize(("page", "text"), [
    ("<article><section id='related-work'><p>a</section><h2 id=search>b</h2><h2 class='share' id='ad-400'>c</h2><p>d</article>", "a b c d"),
    ("<article><div class='share-price'>a</div><div class='box share'>no</div><p class=lead>b<div role=search>no</div></article>", "a b"),
    ("<article><header class=header><h1>a</h1></header><p>b</article>", "a b"),
    ("<div class='main-image'>a</div><div><p>the body of the page</div>", "a|the body of the page"),
    ("<div class='post-meta'></div><div>body</div>", "body"),
    ("<article></article><div>body</div>", "body"),
    ("<div class='post-body'>a long text here</div><div>note</div>", "a long text here"),
    ("<div class='site-header'>no</div><div class='ad-300x250'>no</div><div class='share-price'>a</div>", "a"),
])
def test_names_of_content_are_not_furniture(page, text):
    found = wrapper.main_text(*wrapper.observe(page, None)[:2])
    assert found == text.replace("|", "\n") if "|" in text else found.replace("\n", " ") == text


def test_alignment_keeps_order():
    a, b = wrapper.parse("<ul><li>1<li>2</ul><p>x"), wrapper.parse("<ul><li>1</ul><div>new</div><p>x")
    matched = wrapper.align(a, b)
    same = wrapper.observe("<ul><li>1</ul><div>new</div><p>x", a)[2]
    assert len(same) == 2 and len(matched) == 6


def plain_weight(a, b):
    """Simple tree matching by its definition; equal texts count twice."""
    if a.tag != b.tag or a.label != b.label:
        return 0
    table = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children, 1):
        for j, y in enumerate(b.children, 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + plain_weight(x, y))
    return 1 + (a.tag == "#" and a.text == b.text) + table[-1][-1]


def test_alignment_against_plain_tree_matching():
    rng = random.Random(31)

    def some(depth):
        parts = []
        for _ in range(rng.randrange(0, 5)):
            if depth == 0 or rng.random() < 0.3:
                parts.append(rng.choice(["one ", "two ", "three "]))
            else:
                tag = rng.choice(["div", "span", "b"])
                parts.append(f"<{tag}>{some(depth - 1)}</{tag}>")
        return "".join(parts)

    for _ in range(300):
        a, b = wrapper.parse(some(3)), wrapper.parse(some(3))
        matched = wrapper.align(a, b)
        nodes, todo = {}, [a]
        while todo:
            node = todo.pop()
            nodes[node.number] = node
            todo += node.children
        weight = sum(1 + (n.tag == "#" and n.text == matched[k].text) for k, n in nodes.items() if k in matched)
        assert weight == plain_weight(a, b)
        assert all(nodes[k].tag == m.tag and nodes[k].label == m.label for k, m in matched.items())
        assert len({m.number for m in matched.values()}) == len(matched)


def test_long_lists_and_deep_notices(spark):
    items = lambda n: "".join(f"<li><a>item {i} of {n}</a> text</li>" for i in range(n))
    import time

    began = time.perf_counter()
    a, b = wrapper.parse(f"<p>top</p><ul>{items(20_000)}</ul><p>end</p>"), wrapper.parse(f"<p>top</p><ul>{items(17_000)}</ul><p>end</p>")
    matched = wrapper.align(a, b)
    assert len(matched) > 4 * 17_000 and time.perf_counter() - began < 60
    deep = lambda n: "<div>" * 70 + "<p>Site-wide notice</p>" + "</div>" * 70 + f"<div><p>Own story {n} of many words</p></div>"
    pages = spark.createDataFrame([(n, f"http://h/{n}", f"<body>{deep(n)}</body>") for n in range(5)], "page_id bigint, url string, html string")
    assert sorted(r.text for r in wrapper.extract(pages).collect()) == [f"Own story {n} of many words" for n in range(5)]


def _page_of(rng, depth):
    if depth == 0 or rng.random() < 0.2:
        return rng.choice("abc")
    inside = "".join(_page_of(rng, depth - 1) for _ in range(rng.randrange(5)))
    tag = rng.choice(["div", "b", "ul"])
    return f"<{tag}>{inside}</{tag}>"


def test_large_tables_align_as_small_ones_do(monkeypatch):
    rng = random.Random(8)
    for _ in range(150):
        one, other = (wrapper.parse("".join(_page_of(rng, 5) for _ in range(rng.randrange(7)))) for _ in range(2))
        found = []
        for cells in (10**9, 0, 6):
            monkeypatch.setattr(wrapper, "CELLS", cells)
            found.append({n: node.number for n, node in wrapper.align(one, other).items()})
        assert found[0] == found[1] == found[2]


def test_long_lists_match_far_from_their_diagonal():
    shared = "".join(f"<p>kept {n}</p>" for n in range(300))
    one, other = ("".join(f"<{tag}>{tag} {n}<b>{n}</b></{tag}>" for n in range(500)) for tag in ("div", "ul"))
    reference = wrapper.parse(f"{shared}{one}")
    assert len(wrapper.constant_nodes(reference, wrapper.parse(f"{other}{shared}"))) == 300
    # Rows of the same kind, whose own children have to be aligned, too.
    row = "<div><i>row</i><b>{}</b>{}</div>"
    rows = wrapper.parse("".join(row.format(n, "x") for n in range(520)))
    moved = wrapper.parse("<hr>" + "".join(row.format(n, "y") for n in range(490, 1010)) + "<br>")
    assert len(wrapper.constant_nodes(rows, moved)) >= 520
