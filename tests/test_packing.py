import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import tokens as K
from millrace.operators.ordering import index_by_file, index_by_key
from millrace.operators.packing import collate, pack_blocks, training_order
from millrace.plans.corpus import build_corpus, tokenize, tokenize_dataset, truncated


def brute_pack(lists, seq_len, batch_rows, shards):
    blocks, n = [], len(lists)
    sizes = [n // shards + (s < n % shards) for s in range(shards)]
    for shard, size in enumerate(sizes):
        start = sum(sizes[:shard])
        for batch, begin in enumerate(range(start, start + size, batch_rows)):
            tokens = [t for ids in lists[begin : min(begin + batch_rows, start + size)] for t in ids]
            for block in range(len(tokens) // seq_len):
                blocks.append((shard, batch, block, tokens[block * seq_len : (block + 1) * seq_len]))
    return blocks


def run_pack(spark, lists, seq_len, batch_rows, shards):
    df = spark.createDataFrame(list(enumerate(lists)), "row_idx bigint, input_ids array<int>").repartition(3)
    got = pack_blocks(df, seq_len, batch_rows, shards, len(lists)).orderBy("shard", "batch_id", "block_id").collect()
    assert all(r.attention_mask == [1] * seq_len for r in got)
    return [(r.shard, r.batch_id, r.block_id, r.input_ids) for r in got]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.lists(st.integers(0, 9), max_size=40), min_size=1, max_size=25),
    st.integers(2, 9), st.integers(1, 8), st.integers(1, 3),
)
def test_pack_equals_brute_force(spark, lists, seq_len, batch_rows, shards):
    shards = min(shards, len(lists))
    assert run_pack(spark, lists, seq_len, batch_rows, shards) == brute_pack(lists, seq_len, batch_rows, shards)


def test_pack_corner_cases(spark):
    lists = [[1] * 4, [2] * 4, [], [3] * 100, [4] * 3, [5]]
    # exact multiple | empty row and one longer than three blocks | short batch
    assert run_pack(spark, lists, 8, 2, 1) == brute_pack(lists, 8, 2, 1)
    assert [b[1] for b in run_pack(spark, lists, 8, 2, 1)] == [0] + [1] * 12
    assert run_pack(spark, [[], []], 8, 2, 1) == []


def test_pack_shuffles_once(spark):
    df = spark.createDataFrame([(0, [1])], "row_idx bigint, input_ids array<int>")
    plan = pack_blocks(df, 16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_index_by_key_is_dense_and_ordered(spark):
    values = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(v, f"s{v}") for v in values], "k int, s string").repartition(6)
    got = index_by_key(df, "k").orderBy("row_idx").collect()
    assert [(r.row_idx, r.k) for r in got] == list(enumerate(sorted(values)))


def test_index_by_file(spark, folder):
    for name, start in (("b", 10), ("a/z", 0), ("c", 20)):
        spark.range(start, start + 5).coalesce(1).write.parquet(f"{folder}/{name}")
    got = index_by_file(spark, folder, recursiveFileLookup="true").orderBy("row_idx").collect()
    assert [(r.row_idx, r.id) for r in got] == list(enumerate([*range(5), *range(10, 15), *range(20, 25)]))


TEXTS = ["", "abc", "ሰላም", "\U0001f600x", "a" * 1000, "é\n"]


@pytest.mark.parametrize("tokens", [K.byte_tokens, K.byte_tokens_native])
def test_byte_tokens(spark, column, tokens):
    got = column([*TEXTS, None, "end"], tokens(F.col("c")))
    assert got == [*[list(t.encode()) for t in TEXTS], None, list(b"end")]
    many = [f"row {n} ሰ" for n in range(3000)]
    df = spark.createDataFrame([(t,) for t in many], "c string").where("c like '%7%'")
    assert all(r.o == list(r.c.encode()) for r in df.select("c", tokens(F.col("c")).alias("o")).collect())


def test_tokenize_modes(spark):
    df = spark.createDataFrame([("x" * 40,), ("yy",), ("",)], "text string")
    rows = tokenize_dataset(df, 16, pack=False).collect()
    assert [(len(r.input_ids), len(r.attention_mask)) for r in rows] == [(16, 16), (2, 2), (0, 0)]
    with pytest.raises(ValueError):
        tokenize_dataset(df, 15, pack=False)
    stream = spark.readStream.format("rate").load().select(F.lit("a").alias("text"))
    with pytest.raises(ValueError, match="stream"):
        tokenize_dataset(stream, 16, pack=True)
    assert tokenize_dataset(stream, 16, pack=False).isStreaming


def test_null_text(spark):
    df = spark.createDataFrame([("a",), (None,)], "text string")
    with pytest.raises(Exception, match="null text"):
        tokenize(df).collect()
    assert tokenize(df, on_null="drop").count() == 1
    with pytest.raises(ValueError):
        tokenize(df, on_null="keep")


def test_tokenizer_file(spark, folder):
    from tokenizers import Tokenizer, models, pre_tokenizers, processors

    model = Tokenizer(models.WordLevel({"[U]": 0, "the": 1, "cat": 2, "[E]": 3}, unk_token="[U]"))
    model.pre_tokenizer = pre_tokenizers.Whitespace()
    model.post_processor = processors.TemplateProcessing(single="$A [E]", special_tokens=[("[E]", 3)])
    model.save(f"{folder}/tok.json")
    content = K.read_tokenizer_file(spark, f"{folder}/tok.json")
    df = spark.createDataFrame([("the cat the",), ("dog",), ("",)], "text string")
    whole = [r.input_ids for r in tokenize(df, K.file_tokens(spark, content)).collect()]
    assert whole == [[1, 2, 1, 3], [0, 3], [3]]
    short = truncated(df, 2, K.file_tokens(spark, content, max_length=2)).collect()
    assert [r.input_ids for r in short] == [[1, 3], [0, 3], [3]]


@pytest.mark.parametrize("kind", ["parquet", "jsonl"])
def test_build_corpus_follows_file_order(spark, folder, kind):
    texts = [f"document {n} " * (n % 7) for n in range(40)]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, body string")
    for part, low in (("a", 0), ("b", 20)):
        chosen = df.where((F.col("n") >= low) & (F.col("n") < low + 20)).coalesce(1).sortWithinPartitions("n")
        chosen.write.format("json" if kind == "jsonl" else kind).save(f"{folder}/in/{part}")
    got = build_corpus(spark, f"{folder}/in", kind, "body", 16, batch_rows=7).orderBy("batch_id", "block_id")
    want = brute_pack([list(t.encode()) for t in texts], 16, 7, 1)
    assert [(0, r.batch_id, r.block_id, r.input_ids) for r in got.collect()] == want
    rows = build_corpus(spark, f"{folder}/in", kind, "body", 16, pack=False)
    assert rows.columns == ["input_ids", "attention_mask"] and rows.count() == 40


def test_collate(spark):
    rows = [(0, [1, 9]), (1, [1, 2, 3]), (2, [5]), (3, []), (4, [9])]
    df = spark.createDataFrame(rows, "row_idx bigint, input_ids array<int>")
    got = [(r.batch_id, r.input_ids, r.attention_mask, r.labels) for r in collate(df, 2, 9).orderBy("row_idx").collect()]
    assert got == [
        (0, [1, 9, 9], [1, 1, 0], [1, -100, -100]),
        (0, [1, 2, 3], [1, 1, 1], [1, 2, 3]),
        (1, [5], [1], [5]),
        (1, [9], [0], [-100]),
        (2, [9], [1], [-100]),
    ]


def test_training_order(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    read = lambda n, seed=1: [
        (r.epoch, r.k) for r in training_order(df, "k", seed, n).orderBy("epoch", "feed_key", "k").collect()
    ]
    first, longer = read(30), read(250)
    assert longer[:30] == first and len(longer) == 250
    assert sorted(k for e, k in longer if e == 0) == list(range(100))
    assert [k for e, k in longer if e == 0] != [k for e, k in longer if e == 1]
    assert read(30, seed=2) != first
    assert training_order(df.limit(0), "k", 1, 5).count() == 0


def test_row_numbers_whatever_the_folder_is_called(spark, folder, monkeypatch):
    from millrace.operators import ordering

    monkeypatch.setattr(ordering, "workspace", lambda spark: f"{folder}/part-00009-z")
    df = spark.range(1000).selectExpr("id", "-id AS k")
    rows = ordering.index_by_key(df, "k").collect()
    assert all(r.row_idx == 999 - r.id for r in rows)


def test_files_in_the_order_of_their_decoded_names(spark, folder):
    from millrace.operators.ordering import index_by_file

    for n, name in enumerate(["a b", "a!b", "a%b", "a+b"]):
        spark.range(n, n + 1).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    rows = index_by_file(spark, folder, recursiveFileLookup="true").orderBy("row_idx").collect()
    assert [r.id for r in rows] == [0, 1, 2, 3]
