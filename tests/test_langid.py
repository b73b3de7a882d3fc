import math
from collections import Counter

import pytest

from millrace.functions.text import LATIN
from millrace.operators import langid
from millrace.operators.filters import target_sentences

TRAIN = [("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("ሰላም ለዓለም ሰላም", "am"), ("a\U0001f600b\U0001f600", "en")]
TEXTS = ["the dog", "le chien", "ሰላም ነው", "zz", "", "qqqq", "a\U0001f600b", "the le the", None]


def grams(text):
    return [text[i : i + 3] for i in range(len(text) - 2)]


def brute(text):
    counts = {}
    for t, label in TRAIN:
        counts.setdefault(label, Counter()).update(grams(t))
    size = len(set().union(*counts.values()))
    best = None
    for label in sorted(counts):
        total = sum(counts[label].values())
        score = sum(round(math.log((counts[label][g] + 1) / (total + size)) * 1_000_000) for g in grams(text or ""))
        if best is None or score > best[1]:
            best = (label, score)
    return best if grams(text or "") else (None, None)


@pytest.fixture
def model(spark):
    return langid.profile(langid.fit(spark.createDataFrame(TRAIN, "text string, lang string")))


@pytest.mark.parametrize("max_rows", [langid.PROFILE_ROWS, 0])
def test_both_ways_equal_brute_force(spark, model, max_rows):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    got = langid.predict(df, model, ["id"], max_rows=max_rows).orderBy("id").collect()
    assert [(r.lang, r.score) for r in got] == [brute(t) for t in TEXTS]


def test_fit_counts(spark):
    df = spark.createDataFrame([("aaaa", "x"), ("ab", "x")], "text string, lang string")
    assert langid.fit(df).collect() == [("x", "aaa", 2)]


def test_target_filter(spark, model):
    rows = ["ሰላም ለዓለም ሰላም ሰላም ለዓለም።", "ሰላም", "the cat and the dog ran", "the cat and the dog ሰላም"]
    df = spark.createDataFrame(list(enumerate(rows)), "id int, sentence string")
    assert [r.id for r in target_sentences(df, ["id"], "am", model).collect()] == [0]
    assert [r.id for r in target_sentences(df, ["id"], None).collect()] == [0]
    kept = target_sentences(df, ["id"], "en", model, script=LATIN, min_ratio=0.9)
    assert [r.id for r in kept.collect()] == [2]
    with pytest.raises(ValueError):
        target_sentences(df, ["id"], "am")
