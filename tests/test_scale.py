"""Operators whose plans matter: packed order, history behind a filter, permutation, selection, one lookup."""

import random

import pytest
from pyspark.sql import functions as F

from millrace import catalog
from millrace.functions.text import LATIN
from millrace.operators import admission, history, sizing
from millrace.operators.dedup import first_by_key, first_sentences, with_hash
from millrace.operators.packed import can_pack, pack, unpack
from millrace.operators.packing import training_order
from millrace.operators.permute import permuted
from millrace.plans.frontier import MAX_QUEUE
from millrace.plans.gather import gather
from millrace.sources import files
from millrace.sources.output import CrawlState


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- packed order ---------------------------------------------------------------


def test_packed_order_sorts_as_its_columns(spark):
    edge = [-(2**63), -(2**31), -1, 0, 1, 2**31 - 1, 2**63 - 1, None]
    rows = [(a, b) for a in edge for b in (-(2**31), 0, 7, 2**31 - 1, None)]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "a bigint, b int")
    packed = df.withColumn("p", pack(df, ["a", "b"]))
    by_number = [(r.a, r.b) for r in packed.orderBy("p").collect()]
    assert by_number == [(r.a, r.b) for r in df.orderBy("a", "b").collect()]
    back = packed.select("a", "b", F.struct(*unpack("p", df, ["a", "b"])).alias("again")).collect()
    assert all((r.a, r.b) == tuple(r.again) for r in back)


def test_what_can_be_packed(spark):
    df = spark.createDataFrame([], "a bigint, b int, c string, d smallint, e bigint")
    assert can_pack(df, ["a", "b"]) and can_pack(df, ["b", "d", "b"]) and can_pack(df, ["a"])
    assert not can_pack(df, ["a", "c"]) and not can_pack(df, ["a", "e"]) and not can_pack(df, ["a", "b", "b"])


def test_first_wins_without_a_sort(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aaaabcdefg"), rng.choice([None, *range(-50, 50)]), n) for n in range(2000)]
    df = sizing.store(spark.createDataFrame(rows, "text string, page bigint, pos int").repartition(5))
    found = first_by_key(df, ["text"], ["page", "pos"])
    text = plan(found)
    assert text.count("Exchange") == 1 and "Sort" not in text
    want = {}
    for row in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        want.setdefault(row[0], row)
    assert sorted(map(tuple, found.collect())) == sorted(want.values())
    assert found.columns == df.columns


def test_gathering_carries_only_places_through_the_shuffle(spark):
    rng = random.Random(3)
    texts = [" ".join(f"Sentence number {rng.randrange(30)} stands here." for _ in range(6)) for _ in range(40)]
    rows = [(n, f"http://h/{n}", f"<p>{t}</p>") for n, t in enumerate(texts)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(6)
    stamp = F.timestamp_seconds(F.col("page_id"))
    found = gather(pages, ["page_id"], None, timestamp=stamp, script=LATIN)
    aggregate = plan(found)
    assert "SortAggregate" not in aggregate and "min_by" not in aggregate
    want = {}
    for n, t in enumerate(texts):
        for pos, sentence in enumerate(t.replace(". ", ".\n").split("\n")):
            want.setdefault(sentence, (n, pos))
    got = {r.text: (r.page_id, r.pos) for r in found.collect()}
    assert got == want
    assert all(r.url == f"http://h/{r.page_id}" and r.timestamp.timestamp() == r.page_id for r in found.collect())
    named = gather(pages.withColumn("name", F.col("url")), ["name"], None, timestamp=stamp, script=LATIN)
    assert {r.text for r in named.collect()} == set(want)  # an order that is no number is carried


# --- history --------------------------------------------------------------------


def hashes(spark, low, high):
    return with_hash(spark.range(low, high).selectExpr("concat('sentence ', id) AS text")).select("hash")


@pytest.mark.parametrize("slice_rows", [100_000, 2000, 40])
def test_unseen_rows_of_a_history(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(history, "SLICE_ROWS", slice_rows)
    known = history.history(sizing.store(history.in_ranges(hashes(spark, 0, 3000))))
    new = spark.range(2900, 3400).selectExpr("id", "concat('sentence ', id) AS text")
    left = first_sentences(new, ["id"], known)
    assert sorted(r.id for r in left.collect()) == list(range(3000, 3400))
    assert left.columns == ["id", "text", "hash"]


def test_filter_lets_few_new_rows_through_and_every_known_one(spark):
    stored = hashes(spark, 0, 20_000)
    blocks = 20_000 // history.FULL  # as full as blocks may be
    bits = history.bloom(stored, blocks)
    assert bits.count() == blocks
    told = history.perhaps_seen(hashes(spark, 0, 40_000), bits, blocks).join(stored.withColumn("known", F.lit(True)), "hash", "left")
    counts = {(r.known, r._perhaps): r["count"] for r in told.groupBy("known", "_perhaps").count().collect()}
    assert counts[True, True] == 20_000 and (True, False) not in counts
    assert counts[None, True] < 1_000
    halves = [history.bloom(stored.where(f"hash {side} '8'"), blocks) for side in ("<", ">=")]
    merged = history.merged(halves[0].unionByName(halves[1]))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, bits.collect()))


def test_history_is_not_shuffled(spark):
    stored = sizing.store(history.in_ranges(hashes(spark, 0, 500)))
    known = history.History(stored, 500, history.bloom(stored, 16), 16)
    wanted = sizing.store(hashes(spark, 400, 600))
    text = plan(known.known(wanted, 200))
    assert "BroadcastHashJoin" in text and text.replace("BroadcastExchange", "").count("Exchange") == 0
    none = history.history(sizing.store(hashes(spark, 0, 0)))
    assert first_sentences(spark.range(3).selectExpr("id", "string(id) AS text"), ["id"], none).count() == 3


def test_state_keeps_a_filter_that_grows(spark, folder, monkeypatch):
    monkeypatch.setattr(history, "FULL", 2)
    monkeypatch.setattr(history, "SLICE_ROWS", 5)
    monkeypatch.setattr(history, "LEAST_BLOCKS", 4)
    state = CrawlState(spark, f"{folder}/state")
    sizes = []
    for cycle, (low, high) in enumerate([(0, 3), (3, 30), (30, 31), (31, 31), (31, 400)]):
        state.commit(cycle, hashes=hashes(spark, low, high))
        known = CrawlState(spark, f"{folder}/state").history()
        sizes.append(known.blocks)
        probe = with_hash(spark.range(0, high + 20).selectExpr("id", "concat('sentence ', id) AS text"))
        assert sorted(r.id for r in known.unseen(probe).collect()) == list(range(high, high + 20))
    assert sizes[0] == 0 and 0 < sizes[1] < sizes[-1] and sizes == sorted(sizes)


# --- permutation ------------------------------------------------------------------


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 16, 97, 100, 1000, 4099])
def test_each_epoch_is_a_permutation(spark, rows):
    df = spark.range(rows).crossJoin(spark.createDataFrame([(e,) for e in (0, 1, 5)], "epoch int"))
    places = df.select("id", "epoch", permuted(F.col("id"), rows, 42, F.col("epoch")).alias("at")).collect()
    orders = {}
    for r in places:
        orders.setdefault(r.epoch, {})[r.at] = r.id
    for order in orders.values():
        assert sorted(order) == list(range(rows))
    if rows > 50:
        lists = [[order[i] for i in range(rows)] for order in orders.values()]
        assert lists[0] != lists[1] != lists[2]
        moved = sum(abs(i - k) for i, k in enumerate(lists[0])) / rows
        assert 0.25 < moved / rows < 0.42  # a third for random orders
        steps = sum(b - a == lists[0][1] - lists[0][0] for a, b in zip(lists[0], lists[0][1:]))
        assert steps < rows / 5  # no straight runs


def test_training_order_neither_sorts_nor_shuffles(spark):
    df = spark.range(1000).withColumnRenamed("id", "row_idx")
    feed = training_order(df, "row_idx", 7, 1500, 1000)
    text = plan(feed)
    assert "Sort" not in text and "Exchange" not in text and "Limit" not in text
    rows = feed.collect()
    assert len(rows) == 1500 and sorted(r.feed_key for r in rows if r.epoch == 1) == list(range(500))
    assert len({r.row_idx for r in rows if r.epoch == 1}) == 500


# --- selection --------------------------------------------------------------------


@pytest.mark.parametrize(("slice_rows", "sample"), [(50_000, 4_000), (30, 20), (3, 9)])
def test_first_rows_against_a_sort(spark, monkeypatch, slice_rows, sample):
    monkeypatch.setattr(sizing, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(sizing, "SAMPLE_ROWS", sample)
    rng = random.Random(slice_rows)
    rows = [(rng.choice([None, *range(20)]), [rng.randrange(5) for _ in range(rng.randrange(4))], n) for n in range(400)]
    df = sizing.store(spark.createDataFrame(rows, "depth int, ord array<int>, n bigint").repartition(4))
    want = [r.n for r in df.orderBy("depth", "ord", "n").collect()]
    for n in (0, 1, 37, 399, 400, 1000):
        got = sizing.first_rows(df, n, F.col("depth"), "ord", "n")
        assert sorted(r.n for r in got.collect()) == sorted(want[:n])
    text = plan(sizing.first_rows(df, 37, "depth", "ord", "n"))
    assert "TakeOrdered" not in text and "Sort" not in text and "Exchange" not in text


def test_equal_keys_end_the_selection(spark, monkeypatch):
    monkeypatch.setattr(sizing, "SLICE_ROWS", 5)
    df = sizing.store(spark.range(40).selectExpr("id", "1 AS k"))
    assert sizing.first_rows(df, 10, "k").count() == 40  # no total order: all that are equal to the tenth


def test_queue_cap_is_the_crawl_s(spark, folder):
    pages = [(n, f"http://h/{n}", "".join(f"<a href='/{n}/{i}'>to</a>" for i in range(400))) for n in range(9)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{folder}/pages.parquet")
    got = sorted((r.page_id, r.pos) for r in catalog.queue_cap(spark, folder).collect())
    assert got == [(n, i) for n in range(9) for i in range(400)][:MAX_QUEUE]


# --- folders -----------------------------------------------------------------------


def test_no_task_writes_all_texts_of_a_language(spark, folder, monkeypatch):
    rows = [(n, f"text {n}", "en" if n % 8 else None) for n in range(80)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    documents.repartition(4).write.parquet(f"{folder}/documents.parquet")
    listed = []
    names = files.list_text_files
    monkeypatch.setattr(files, "list_text_files", lambda *a: listed.append(names(*a)) or listed[-1])
    found = sorted(r.lang for r in catalog.list_files(spark, folder).collect())
    assert found == ["__HIVE_DEFAULT_PARTITION__", "en"]
    assert sum("lang=en/" in f for f in listed[0]) > 1


# --- suffixes ---------------------------------------------------------------------


@pytest.mark.parametrize("small", [True, False])
def test_suffix_allowlist_is_one_lookup(spark, monkeypatch, small):
    monkeypatch.setattr(admission, "fits_broadcast", lambda df, *_: small)
    names = ["com", "a.org", "x.a.org", "b.c.d.net", "q.b.c.d.net", "f.e.d.c.b.io", "h:80", " UP.Case ", "", None]
    rng = random.Random(4)
    domains = ["com", "x.com", "a.b.com", "xcom", "a.org", "org", "y.x.a.org", "aa.org", "c.d.net", "b.c.d.net", "1.b.c.d.net",
               "z.f.e.d.c.b.io", "e.d.c.b.io", "h:80", "g.h:80", "h:8", "up.case", "v.up.case", "case"]
    domains += [".".join(rng.choices(["a", "b", "c", "d", "org", "com", "net"], k=rng.randrange(1, 7))) for _ in range(60)]
    urls = spark.createDataFrame([(n, f"http://{d}/p") for n, d in enumerate(domains)], "n int, url string")
    listed = spark.createDataFrame([(n,) for n in names], "domain string")
    rule = admission.subdomain_rule(listed)
    clean = [n.strip().lower() for n in names if n and n.strip()]
    want = [n for n, d in enumerate(domains) if any(d == c or d.endswith("." + c) for c in clean)]
    found = rule(urls)
    assert plan(found).count("Join ") <= (1 if small else 2)
    assert sorted(r.n for r in found.collect()) == want and found.columns == ["n", "url"]


# --- bytes, lines and language ------------------------------------------------------


def test_text_is_cut_before_it_is_tokenized(spark):
    from millrace.functions.tokens import byte_tokens, byte_tokens_native
    from millrace.plans.corpus import tokenize, truncated

    rows = [("",), ("abc",), ("é" * 40,), ("𝒳y" * 20,), ("x" * 1000,)]
    df = spark.createDataFrame(rows, "text string")
    for tokenizer in (byte_tokens, byte_tokens_native):
        short = [r.input_ids for r in truncated(df, 16, tokenizer).collect()]
        assert short == [r.input_ids[:16] for r in tokenize(df, tokenizer).collect()]
        assert "substring" in plan(truncated(df, 16, tokenizer))


def test_packing_shuffles_bytes(spark):
    from millrace.plans.corpus import tokenize, tokenize_dataset
    from millrace.operators.packing import pack_blocks

    df = spark.range(60).selectExpr("id AS row_idx", "repeat(concat('ü', id, ' '), int(id % 9)) AS text")
    blocks = tokenize_dataset(df, 16, True, batch_rows=7)
    whole = pack_blocks(tokenize(df), 16, 7)
    order = ["batch_id", "block_id"]
    assert blocks.orderBy(order).collect() == whole.orderBy(order).collect() and blocks.columns == whole.columns
    text = plan(blocks)
    assert text.index("ArrowEvalPython") < text.index("Exchange")  # above it: ids are made after the shuffle


@pytest.mark.parametrize("kind", ["json", "csv", "text"])
def test_lines_are_numbered_where_they_lie(spark, folder, kind):
    from millrace.operators.ordering import index_lines
    from millrace.sources.files import read_text_column

    values = [f"line {n}" + " x" * (n % 25) for n in range(3000)]
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, text string")
    for part in range(3):
        chosen = df.where((F.col("n") >= 1000 * part) & (F.col("n") < 1000 * part + 1000)).coalesce(1).sortWithinPartitions("n")
        chosen = chosen.select("text")
        writer = chosen.write.option("header", "true") if kind == "csv" else chosen.write
        writer.format(kind).save(f"{folder}/in/{part}")
    file_type = {"json": "jsonl", "text": "txt"}.get(kind, kind)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")  # several splits a file
    try:
        rows = index_lines(read_text_column(spark, f"{folder}/in", file_type, order="_order"), "_order")
        text = plan(rows)
        assert "RangePartitioning" not in text.replace(" ", "").replace("rangepartitioning", "RangePartitioning")
        got = {r.row_idx: r.text for r in rows.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == dict(enumerate(values))


def test_dropped_nulls_leave_no_gap(spark, folder):
    from millrace.plans.corpus import build_corpus

    texts = [None if n % 3 == 0 else f"words of line {n}" for n in range(90)]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, text string").coalesce(1).sortWithinPartitions("n")
    df.select("text").write.option("ignoreNullFields", "false").json(f"{folder}/in")
    blocks = build_corpus(spark, f"{folder}/in", "jsonl", seq_len=16, batch_rows=10, on_null="drop").orderBy("batch_id", "block_id").collect()
    kept = [t for t in texts if t]
    want = []
    for batch in range(6):
        joined = "".join(kept[10 * batch : 10 * batch + 10]).encode()
        want += [(batch, i, list(joined[16 * i : 16 * i + 16])) for i in range(len(joined) // 16)]
    assert [(r.batch_id, r.block_id, r.input_ids) for r in blocks] == want


def test_language_profile_is_bounded_in_bytes(spark):
    from millrace.operators import langid

    labelled = spark.createDataFrame([("the cat sat there", "a"), ("le chat est la", "b")] * 3, "text string, lang string")
    model = langid.profile(langid.fit(labelled))
    docs = spark.createDataFrame([(0, "the cat"), (1, "le chat"), (2, "")], "k int, text string")
    dense, joined = (langid.predict(docs, model, ["k"], max_bytes=most) for most in (1 << 20, 100))
    assert "ArrowEvalPython" in plan(dense) and "ArrowEvalPython" not in plan(joined)
    assert sorted(map(tuple, dense.collect())) == sorted(map(tuple, joined.select(dense.columns).collect()))


def test_language_is_looked_up_after_deduplication(spark):
    from millrace.operators import langid

    labelled = spark.createDataFrame([("the cat sat there", "a"), ("le chat est la", "b")] * 3, "text string, lang string")
    model = langid.profile(langid.fit(labelled))
    rows = [(n, f"http://h/{n}", "<p>The cat sat there today again. Le chat est la encore ici.</p>") for n in range(8)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = gather(pages, ["page_id"], "a", model, timestamp=F.timestamp_seconds(F.lit(0)), script=LATIN)
    text = plan(found)
    assert text.index("score(") < text.index("HashAggregate")  # above the aggregate
    assert [(r.page_id, r.text) for r in found.collect()] == [(0, "The cat sat there today again.")]


# --- buckets ------------------------------------------------------------------------


def test_an_upsert_rewrites_the_buckets_it_touches(spark, folder):
    import os

    from millrace.operators.visits import VisitTable

    table = VisitTable(spark, f"{folder}/visits", 8)
    table.upsert(spark.range(200).selectExpr("concat('u', id) AS url", "id AS last_visited"))
    files = lambda: {n: sorted(os.listdir(f"{folder}/visits/{n}")) for n in os.listdir(f"{folder}/visits") if n.startswith("bucket=")}
    before = files()
    assert len(before) == 8
    table.upsert(spark.createDataFrame([("u3", 900), ("u3", 1), ("new", 5), ("u7", 2)], "url string, last_visited bigint"))
    after = files()
    changed = {n for n in before if before[n] != after[n]}
    assert 1 <= len(changed) <= 3
    want = {f"u{n}": n for n in range(200)} | {"u3": 900, "new": 5}
    assert {r.url: r.last_visited for r in table.read().collect()} == want
    few = table.of(sizing.store(spark.createDataFrame([("u3",)], "url string")))
    assert ("u3", 900) in [tuple(r) for r in few.collect()] and "PartitionFilters: [isnotnull(bucket" in plan(few)
    assert few.count() < 60 and VisitTable(spark, f"{folder}/none").read().count() == 0


def test_no_html_is_shuffled_from_bucketed_pages(spark, monkeypatch):
    from millrace.plans import frontier
    from millrace.sources.pages import save_pages

    rows = [(f"http://h/{n}", f"<p>Words of page {n} stand here.</p>") for n in range(40)]
    pages = spark.createDataFrame(rows, "url string, html string").withColumn("fetched_at", F.timestamp_seconds(F.lit(0)))
    save_pages(pages, "bucketed_pages", 4)
    admitted = sizing.store(pages.select("url", F.lit(0).alias("depth"), F.array(F.lit(1).cast("bigint")).alias("ord")))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        parsed = frontier._parse(spark.table("bucketed_pages"), admitted, ())
        text = plan(parsed)
        assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in text  # of the admitted URLs
        assert parsed.count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table bucketed_pages")
