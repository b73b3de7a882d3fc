import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import text as T

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
# No surrogates: they are not text that a column can hold.
CHARS = st.characters(codec="utf-8")
PIECES = st.sampled_from([" ", "\n", ". ", "! ", "? ", "። ", "፧ ", "፡ ", "a", "Zé", "ሰላም", "\x1c", "\x85", " ", "　", "."])


def model_norm(s):
    return " ".join(s.split())


def model_sentences(s):
    out, word_list = [], []
    for word in model_norm(s).split(" "):
        word_list.append(word)
        if word and word[-1] in "።.!?፧":
            out.append(" ".join(word_list))
            word_list = []
    if word_list:
        out.append(" ".join(word_list))
    return [x for x in out if x]


@FEW
@given(st.lists(st.one_of(st.text(CHARS, max_size=30), st.lists(PIECES, max_size=20).map("".join)), min_size=30, max_size=80))
def test_normalize_and_split_match_model(column, texts):
    assert column(texts, T.normalize_text(F.col("c"))) == [model_norm(t) for t in texts]
    assert column(texts, T.split_sentences(F.col("c"))) == [model_sentences(t) for t in texts]


def test_every_white_space_character(column):
    points = [p for p in range(0x3100) if chr(p).isspace()]
    assert {0x1C, 0x1F, 0x85, 0xA0, 0x2028, 0x3000} <= set(points)
    assert column([f"{chr(p)}a{chr(p)}b{chr(p)}" for p in points], T.normalize_text(F.col("c"))) == ["a b"] * len(points)


def test_ethiopic_sentence_marks(column):
    text = "ሰላም። ጤና፧ abc. what? yes! ፡ ሀ፣ ለ፤ መ: end"
    assert column([text], T.split_sentences(F.col("c"))) == [
        ["ሰላም።", "ጤና፧", "abc.", "what?", "yes!", "፡ ሀ፣ ለ፤ መ: end"]
    ]
    assert column(["", " \n", None], T.split_sentences(F.col("c"))) == [[], [], None]


def test_script_ratio(column):
    got = column(["ሰላም።", "ሰላ ab", "123 !", "", "  ", "abc", "ᎀⶀꬁ"], T.script_ratio(F.col("c")))
    assert got == [4 / 3, 0.5, 0.0, 0.0, 0.0, 0.0, 1.0]
    assert column(["ሰላም abcdef"], T.in_script(F.col("c"), min_ratio=0.34)) == [False]
    assert column(["ሰላም abcdef"], T.in_script(F.col("c"), min_ratio=1 / 3)) == [True]


def test_minimum_length_counts_code_points(column):
    assert column(["ሰ" * 19, "ሰ" * 20, "\U0001f600" * 19, "\U0001f600" * 20], T.long_enough(F.col("c"))) == [
        False, True, False, True,
    ]


def test_hash_is_of_utf8_bytes_and_case_sensitive(column):
    texts = ["ሰላም", "a", "A", ""]
    assert column(texts, T.sentence_hash(F.col("c"))) == [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def test_white_space_class_equals_regex_class(column):
    pattern = re.compile(r"\s")
    odd = [chr(p) for p in range(0x2100) if bool(pattern.match(chr(p))) and not chr(p).isspace()]
    assert odd == []


def test_long_runs_do_not_overflow(column):
    run = "\n \x85" * 200_000 + chr(0x3000) * 200_000
    assert column([f"a{run}b. {run}", run], T.normalize_text(F.col("c"))) == ["a b.", ""]
