import random

import pytest

from millrace.operators.dedup import first_by_key, first_sentences, not_seen, save_hashes, with_hash
from millrace.operators.visits import revisit_gate, upsert_visits


def brute_gate(rows, every, last=None):
    """Events in order, one at a time."""
    last, kept = dict(last or {}), []
    for key, sec, event in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or sec - last[key] >= every:
            last[key] = sec
            kept.append(event)
    return sorted(kept)


@pytest.mark.parametrize("every", [1, 7, 50])
@pytest.mark.parametrize("earlier", [None, {"hot": -3, "k2": 40}])
def test_gate_equals_brute_force(spark, every, earlier):
    rng = random.Random(every)
    # One key holds more than a third of the rows, many of them in the same second.
    rows = [(rng.choice(["hot", "hot", f"k{n % 9}"]), rng.randrange(120), n) for n in range(1500)]
    df = spark.createDataFrame(rows, "key string, sec bigint, event bigint").repartition(5)
    visited = None
    if earlier:
        visited = spark.createDataFrame(list(earlier.items()), "url string, last_visited bigint")
    got = revisit_gate(df, "key", "sec", ["event"], every, visited)
    assert got.columns == ["key", "sec", "event"]
    assert sorted(r.event for r in got.collect()) == brute_gate(rows, every, earlier)


def test_gate_without_interval_admits_all(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2)], "key string, sec bigint, event bigint")
    assert revisit_gate(df, "key", "sec", ["event"], 0).count() == 2


@pytest.mark.parametrize("every", [0, 5])
def test_rows_without_key_never_pass(spark, every):
    df = spark.createDataFrame([(None, 1, 0), ("a", 1, 1)], "k string, t bigint, n bigint")
    assert [r.k for r in revisit_gate(df, "k", "t", ["n"], every).collect()] == ["a"]


def test_upsert(spark):
    visited = spark.createDataFrame([("a", 50), ("b", 50)], "url string, last_visited bigint")
    new = spark.createDataFrame([("a", 40, 2), ("a", 60, 1), ("c", 1, 1)], "url string, last_visited bigint, seq int")
    assert sorted(map(tuple, upsert_visits(visited, new, "seq").collect())) == [("a", 40), ("b", 50), ("c", 1)]
    assert sorted(map(tuple, upsert_visits(visited, new).collect())) == [("a", 60), ("b", 50), ("c", 1)]


def test_first_occurrence_wins(spark):
    rng = random.Random(3)
    rows = [(p, s, rng.choice("aaaabcdef"), f"u{p}") for p in range(60) for s in range(10)]
    df = spark.createDataFrame(rows, "page int, pos int, text string, url string").repartition(7)
    want = {}
    for row in rows:
        want.setdefault(row[2], row)
    assert sorted(map(tuple, first_by_key(df, ["text"], ["page", "pos"]).collect())) == sorted(want.values())
    whole = first_sentences(df, ["page", "pos"])
    assert sorted((r.page, r.pos, r.text, r.url) for r in whole.collect()) == sorted(want.values())
    seen = with_hash(spark.createDataFrame([("a",), ("a",), ("zz",)], "text string"))
    left = first_sentences(df, ["page", "pos"], seen)
    assert sorted(map(tuple, left.select(whole.columns).collect())) == sorted(
        map(tuple, whole.where("text <> 'a'").collect())
    )
    assert not_seen(seen, seen).isEmpty()


def test_first_by_key_with_every_column_in_the_order(spark):
    rows = [("a", 2, 0, "u2"), ("a", 1, 1, "u1"), ("a", 1, 1, "u0"), ("b", None, 3, None), ("b", 0, 0, "u"), (None, 5, 5, "v")]
    df = spark.createDataFrame(rows, "text string, page bigint, pos int, url string")
    first = first_by_key(df, ["text"], ["page", "pos", "url"])
    assert set(map(tuple, first.collect())) == {("a", 1, 1, "u0"), ("b", None, 3, None), (None, 5, 5, "v")}
    # The place is carried once through the shuffle.
    assert "min_by" not in first._jdf.queryExecution().optimizedPlan().toString()


def test_dedup_combines_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id", "cast(id % 2 as string) hash")
    plan = first_by_key(df, ["hash"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_" in plan
    seen = with_hash(df.selectExpr("cast(id as string) text"))
    plan = first_sentences(df.withColumnRenamed("hash", "text"), ["id"], seen.hint("merge"))
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2  # one for each side


def test_bucketed_history_is_not_shuffled(spark):
    history = with_hash(spark.range(50).selectExpr("cast(id as string) text"))
    save_hashes(history.where("cast(text as int) < 20"), "seen_hashes", 4)
    save_hashes(history.where("cast(text as int) >= 20"), "seen_hashes", 4)
    try:
        new = spark.range(40, 60).selectExpr("id", "cast(id as string) text")
        left = first_sentences(new, ["id"], spark.table("seen_hashes").hint("merge"))
        assert left._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        assert sorted(int(r.text) for r in left.collect()) == list(range(50, 60))
    finally:
        spark.sql("drop table seen_hashes")
