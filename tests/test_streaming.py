import os
import random
import time

import pytest
from pyspark.sql import functions as F

from millrace import catalog
from millrace.functions.text import LATIN
from millrace.operators.pages import explode_sentences
from millrace.plans.corpus import tokenize_dataset
from millrace.plans.gather import gather
from millrace.sources.files import stream_text_files, text_column
from millrace.sources.output import CrawlState
from millrace.sources.pages import stream_pages
from millrace.streaming import runs
from millrace.streaming.gate import revisit_gate_stream
from tests.test_visits import brute_gate

STAMP = F.timestamp_seconds


def pages_of(spark, low, high):
    rows = [(n, f"http://h/{n}", f"<p>Shared sentence of page {n % 3} here. Own sentence of page {n} here.</p>")
            for n in range(low, high)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


@pytest.fixture
def arriving(spark, folder):
    for n, (low, high) in enumerate([(0, 4), (4, 8), (8, 12)]):
        pages_of(spark, low, high).coalesce(1).write.parquet(f"{folder}/in/batch={n}")
    return f"{folder}/in"


def stream(spark, path):
    return stream_pages(
        spark, path, "page_id bigint, url string, html string", 1, recursiveFileLookup="true"
    )


def test_gather_once_then_restart_equals_batch(spark, folder, arriving):
    state = CrawlState(spark, f"{folder}/state")

    def once():
        runs.start_gather(
            stream(spark, arriving), ["page_id"], f"{folder}/out", state, f"{folder}/check", None,
            once=True, script=LATIN, timestamp=STAMP(F.lit(0)),
        ).awaitTermination()
        return sorted((r.text, r.url) for r in spark.read.json(f"{folder}/out").collect())

    def batch(high):
        rows = gather(pages_of(spark, 0, high), ["page_id"], None, script=LATIN, timestamp=STAMP(F.lit(0)))
        return sorted((r.text, r.url) for r in rows.collect())

    assert once() == batch(12)
    assert state.last_cycle() == 2  # one file per trigger
    pages_of(spark, 10, 14).coalesce(1).write.parquet(f"{arriving}/batch=3")
    assert once() == batch(14)
    assert once() == batch(14)  # nothing new


def test_repeated_batch_is_not_written_twice(spark, folder):
    state = CrawlState(spark, f"{folder}/state")
    seen = []
    step = {}

    def capture(df, fn, *args):
        step["fn"] = fn

    checkpoint = f"{folder}/checkpoint"
    os.makedirs(checkpoint)
    with open(f"{checkpoint}/metadata", "w") as file:
        file.write('{"id": "one"}')
    original = runs.start_batches
    runs.start_batches = capture
    try:
        runs.start_gather(pages_of(spark, 0, 3), ["page_id"], f"{folder}/out", state, checkpoint, None, script=LATIN,
                          timestamp=STAMP(F.lit(0)))
    finally:
        runs.start_batches = original
    for _ in range(2):
        step["fn"](pages_of(spark, 0, 3), 0)
        seen.append(spark.read.json(f"{folder}/out").count())
    assert seen == [6, 6] and state.hashes().count() == 6
    # Batch 0 of another stream is another batch, though the state is the same.
    with open(f"{checkpoint}/metadata", "w") as file:
        file.write('{"id": "two"}')
    step["fn"](pages_of(spark, 0, 5), 0)
    assert state.hashes().count() == spark.read.json(f"{folder}/out").count() > 6 and state.last_cycle() == 1


def test_stateful_distinct_survives_restart(spark, folder, arriving):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", runs.ROCKSDB)
    try:
        for high in (12, 14):
            if high == 14:
                pages_of(spark, 10, 14).coalesce(1).write.parquet(f"{arriving}/batch=3")
            runs.start_distinct(
                stream(spark, arriving), ["page_id"], f"{folder}/out", f"{folder}/check", None,
                once=True, script=LATIN, timestamp=STAMP(F.lit(0)),
            ).awaitTermination()
            got = sorted(r.text for r in spark.read.json(f"{folder}/out").collect())
            want = gather(pages_of(spark, 0, high), ["page_id"], None, script=LATIN, timestamp=STAMP(F.lit(0)))
            assert got == sorted(r.text for r in want.collect())
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_continuous_trigger_interval(spark, folder, arriving):
    query = runs.start_gather(
        stream(spark, arriving), ["page_id"], f"{folder}/out", CrawlState(spark, f"{folder}/state"),
        f"{folder}/check", None, interval="1 seconds", script=LATIN, timestamp=STAMP(F.lit(0)),
    )
    try:
        query.processAllAvailable()
        assert query.isActive and spark.read.json(f"{folder}/out").count() > 0
    finally:
        query.stop()


def test_tokens_stream_equals_batch(spark, folder):
    spark.createDataFrame([("ab" * 20,), ("c",)], "text string").write.text(f"{folder}/in")
    rows = tokenize_dataset(text_column(stream_text_files(spark, f"{folder}/in", "txt")), 16, pack=False)
    runs.start_files(rows, f"{folder}/out", f"{folder}/check", once=True).awaitTermination()
    assert sorted(len(r.input_ids) for r in spark.read.parquet(f"{folder}/out").collect()) == [1, 16]


@pytest.mark.parametrize("by_table", [True, False])
def test_gate_stream_equals_brute_force(spark, folder, by_table):
    rng = random.Random(5)
    rows = sorted((rng.choice(["hot", "hot", "x", "y"]), sec, 0) for sec in range(200) for _ in range(3))
    rows = [(k, s, n) for n, (k, s, _) in enumerate(sorted(rows, key=lambda r: r[1]))]
    for part in range(4):
        chosen = [r for r in rows if r[1] // 50 == part]
        spark.createDataFrame(chosen, "key string, sec bigint, event bigint").repartition(1).write.parquet(
            f"{folder}/in/part{part}"
        )
    events = (
        spark.readStream.schema("key string, sec bigint, event bigint")
        .options(recursiveFileLookup="true", maxFilesPerTrigger="1").parquet(f"{folder}/in")
    )
    if by_table:
        state = CrawlState(spark, f"{folder}/state")
        query = runs.start_revisit_gate(
            events, "key", "sec", ["event"], 17, f"{folder}/out", state, f"{folder}/check", once=True
        )
    else:
        admitted = revisit_gate_stream(events, "key", "sec", "event", 17)
        query = runs.start_files(admitted, f"{folder}/out", f"{folder}/check", once=True)
    query.awaitTermination()
    got = sorted(r.event for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == brute_gate(rows, 17)


def test_distinct_stream_hashes_equal_batch(spark, folder):
    texts = [(n, f"A sentence. Another {n % 3}.") for n in range(9)]
    df = spark.createDataFrame(texts, "doc_id int, text string")
    df.write.parquet(f"{folder}/in")
    live = explode_sentences(spark.readStream.schema(df.schema).parquet(f"{folder}/in"))
    found = runs.distinct_stream(live.select("sentence"), "sentence")
    runs.start_files(found, f"{folder}/out", f"{folder}/check", once=True).awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 4


def test_gate_reduces_a_hot_key_before_the_shuffle(spark):
    """Most events are of one key and a few seconds: one row a second leaves a batch."""
    import pyarrow as pa

    from millrace.streaming.gate import earliest_a_second

    rng = random.Random(21)
    rows = [("hot" if rng.random() < 0.9 else f"k{n % 5}", rng.randrange(6), n) for n in range(5000)]
    rng.shuffle(rows)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows])], ["k", "t", "n"]
    )
    out = list(earliest_a_second("k", "t", "n")(iter([batch, batch.slice(0, 0)])))
    got = sorted((r["k"], r["t"], r["n"]) for b in out for r in b.to_pylist())
    assert got == sorted(min(r for r in rows if r[:2] == key) for key in {r[:2] for r in rows})


def test_gate_stream_with_a_hot_key(spark, folder):
    rng = random.Random(22)
    batches = []
    for n in range(3):
        rows = [("hot" if rng.random() < 0.8 else rng.choice(["a", "b", None]), 100 * n + rng.randrange(100), 1000 * n + i) for i in range(600)]
        batches.append(rows)
        spark.createDataFrame(rows, "k string, t bigint, n bigint").repartition(4).write.parquet(f"{folder}/in/batch={n}")
    events = spark.readStream.schema("k string, t bigint, n bigint").option("recursiveFileLookup", "true").parquet(f"{folder}/in")
    gate = revisit_gate_stream(events, "k", "t", "n", 7)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    query = runs.start_files(gate, f"{folder}/out", f"{folder}/check", once=True)
    query.awaitTermination()
    assert spark.conf.get(provider) == before  # the session's own choice is left as it was
    got = sorted(r.n for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == brute_gate([r for rows in batches for r in rows if r[0]], 7)


def test_distinct_stream_restarts_and_keeps_its_state_in_rocksdb(spark, folder, arriving):
    def once():
        query = runs.start_distinct(
            stream(spark, arriving), ["page_id"], f"{folder}/out", f"{folder}/check", None, once=True,
            script=LATIN, timestamp=STAMP(F.lit(0)),
        )
        query.awaitTermination()
        return sorted(r.text for r in spark.read.json(f"{folder}/out").collect())

    first = once()
    assert len(first) == len(set(first)) == 15  # 12 of their own and 3 shared
    pages_of(spark, 10, 14).coalesce(1).write.parquet(f"{arriving}/batch=3")
    assert len(once()) == len(set(once())) == 17
    states = [f for _, _, files in os.walk(f"{folder}/check/state") for f in files]
    assert any(f.endswith(".changelog") for f in states)
    with open(f"{folder}/check/offsets/0") as offsets:
        assert "RocksDBStateStoreProvider" in offsets.read()


def test_distinct_stream_forgets(spark, folder):
    """A copy is dropped for as long as its sentence is remembered, and new again after that: here the
    third is what moves the time on, and the fourth is new."""
    given = spark.readStream.schema("text string, timestamp timestamp").option("recursiveFileLookup", "true")
    os.makedirs(f"{folder}/in")
    sentences = given.parquet(f"{folder}/in")
    for n, second in enumerate([1_000_000, 1_000_030, 1_010_000, 1_020_000, 1_020_030]):
        rows = [("same words", second), (f"own {n}", second)]
        df = spark.createDataFrame(rows, "text string, s bigint").selectExpr("text", "timestamp_seconds(s) AS timestamp")
        df.coalesce(1).write.parquet(f"{folder}/in/batch={n}")
        found = runs.distinct_stream(sentences, time="timestamp", forget_after="60 seconds")
        runs.start_files(found, f"{folder}/out", f"{folder}/check", once=True).awaitTermination()
    texts = [r.text for r in spark.read.parquet(f"{folder}/out").collect()]
    assert sorted(texts) == sorted([*(f"own {n}" for n in range(5)), *["same words"] * 2])
    with pytest.raises(ValueError):
        runs.distinct_stream(sentences, forget_after="60 seconds")


def test_streams_read_tables_of_one_file_and_of_many(spark, folder):
    texts = [(n, f"First sentence of document {n} here. Shared sentence of {n % 3} here.", n) for n in range(9)]
    documents = spark.createDataFrame(texts, "doc_id bigint, text string, n_chars bigint")
    events = spark.createDataFrame([(n, n % 2, n * catalog.DAY // 2) for n in range(12)], "event_id bigint, user_id bigint, sec bigint")
    events = events.select("event_id", "user_id", F.timestamp_seconds("sec").cast("timestamp_ntz").alias("ts"))
    tables = {"documents": documents, "events": events, "pages": pages_of(spark, 0, 9)}
    for name, table in tables.items():
        table.repartition(3).write.parquet(f"{folder}/many/{name}.parquet")
        table.coalesce(1).write.parquet(f"{folder}/written/{name}")
        part = next(f for f in os.listdir(f"{folder}/written/{name}") if f.endswith(".parquet"))
        os.makedirs(f"{folder}/one", exist_ok=True)
        os.rename(f"{folder}/written/{name}/{part}", f"{folder}/one/{name}.parquet")
    for query in (
        catalog.stream_gather, catalog.state_resume, catalog.stream_distinct, catalog.stream_tokens,
        catalog.stream_gate, catalog.stream_gate_table,
    ):
        one, many = (sorted(map(tuple, query(spark, f"{folder}/{kind}").collect())) for kind in ("one", "many"))
        assert one == many and one


def test_stream_gather_reads_a_table_of_one_file_whatever_the_slashes(spark, folder):
    pages_of(spark, 0, 5).coalesce(1).write.parquet(f"{folder}/written")
    part = next(f for f in os.listdir(f"{folder}/written") if f.endswith(".parquet"))
    os.makedirs(f"{folder}/one")
    os.rename(f"{folder}/written/{part}", f"{folder}/one/pages.parquet")
    want = sorted(map(tuple, catalog.stream_gather(spark, f"{folder}/one").collect()))
    for same in (f"{folder}/one/", f"{folder}//one", os.path.relpath(f"{folder}/one")):
        assert sorted(map(tuple, catalog.stream_gather(spark, same).collect())) == want and want


def shuffled_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return sum(os.path.getsize(f) for f in files.split("\n") if "/shuffle_" in f and os.path.exists(f))


def test_gather_frees_shuffled_texts_before_it_writes_hashes(spark, folder):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12))
    rows = [(n, f"http://h/{n}", f"<p>{' '.join(word() for _ in range(300))}.</p>") for n in range(400)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    pages.write.parquet(f"{folder}/in")
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, kept, left = shuffled_bytes(spark), spark.conf.get(setting, None), []

    class State(CrawlState):
        def commit(self, *args, **changes):
            for _ in range(50):  # files go in the background
                if shuffled_bytes(spark) - before < 500_000:
                    break
                time.sleep(0.2)
            left.append(shuffled_bytes(spark) - before)
            super().commit(*args, **changes)

    runs.start_gather(
        spark.readStream.schema(pages.schema).parquet(f"{folder}/in"), ["page_id"], f"{folder}/out",
        State(spark, f"{folder}/state"), f"{folder}/check", None, once=True, script=LATIN, timestamp=STAMP(F.lit(0)),
    ).awaitTermination()
    assert spark.read.json(f"{folder}/out").count() == 400  # 1.5 MB of texts
    assert len(left) == 1 and left[0] < 500_000
    assert spark.conf.get(setting, None) == kept
