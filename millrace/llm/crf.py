"""Personal data: fixed patterns, and a linear-chain conditional random field that adds spans.

The field labels tokens by what they look like (word shapes in a window of two
tokens), is trained from a small labelled table of sentences, and is decoded by
Viterbi over many chains at once in numpy. It finds what the patterns cannot
name: secrets behind a key word, and numbers written in other ways.

Every token of a text is decoded. Long texts are cut only where the best path is sure to
pass through O whatever stands on either side, which is worked out from the scores
around the cut, so the labels are those of the whole chain.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import give_back, text_blocks

KINDS = ("email", "ip", "card", "phone")
ADDED = ("secret", "number")
LABELS = ("O", "B-secret", "I-secret", "B-number", "I-number")

# --- patterns -------------------------------------------------------------

_MAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_MAIL_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match cannot begin inside a run of digits: if it could, it would begin where the run does.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Each match holds one @; going back from there keeps long runs of letters cheap."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _MAIL_NAME:
            start -= 1
        host = _MAIL_HOST.match(text, at + 1) if start < at else None
        if host:
            free = host.end()
            out.append((start, free))
        at = text.find("@", max(at + 1, free))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns, by kind and then start; a failing match is dropped."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out += [
            ("ip", *m.span()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))
        ]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m.group())) <= 15]
    return out


# --- features -------------------------------------------------------------

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
#: Words that announce a secret.
KEY_WORDS = frozenset("password passwd pwd token secret key apikey api auth bearer credential passphrase pin".split())
WINDOW = 2
N_SHAPES = 24


def shape(token: str) -> int:
    """A small number for what a token looks like."""
    lower = token.lower()
    if lower in KEY_WORDS:
        return 1
    if not token[0].isalnum():
        return {"=": 2, ":": 3, '"': 4, "'": 4, "-": 5, ".": 6, "@": 7, "/": 8, "(": 9, ")": 9, "+": 10, "_": 11}.get(token, 12)
    digits = sum(c.isdigit() for c in token)
    if digits == 0:
        return 13 if token.islower() or token.istitle() else 14
    if digits == len(token):
        return 15 + (len(token) > 2) + (len(token) > 4) + (len(token) > 8)
    return 19 + (len(token) > 6) + (len(token) > 12) + 2 * (digits * 8 > len(token) * 2)


class _Shapes(dict):
    """Shapes of tokens met before, up to a fixed number."""

    def __missing__(self, token: str) -> int:
        value = shape(token)
        if len(self) < 200_000:
            self[token] = value
        return value


_shapes = _Shapes()


def shapes(tokens: list[str]) -> np.ndarray:
    return np.fromiter(map(_shapes.__getitem__, tokens), np.int64, len(tokens))


def emissions(marks: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores (token, label) from the shapes in a window; 0 stands for what is beyond an end."""
    padded = np.concatenate([np.zeros(WINDOW, np.int64), marks, np.zeros(WINDOW, np.int64)])
    n = len(marks)
    return sum(weights[d, padded[d : d + n]] for d in range(2 * WINDOW + 1))


#: Tokens, with padding, that are decoded at once.
_CELLS = 1 << 17
#: Chains are cut about every so many tokens, where ``_AROUND`` tokens on each side settle the label.
LONG, _AROUND = 256, 8
_TRIES, _STRIDE = 4, 9

# --- the field ------------------------------------------------------------

#: A span's first token follows no other label, and its next ones only its own kind.
_ALLOWED = np.array(
    [[not (b.startswith("I-") and a[1:] != b[1:]) for b in LABELS] for a in LABELS]
)
_START = np.array([not b.startswith("I-") for b in LABELS])


class Field:
    """Weights of window shapes and of label changes."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray) -> None:
        self.weights = weights
        self.moves = np.where(_ALLOWED, moves, -1e9)

    def viterbi(self, chains: list[np.ndarray]) -> list[np.ndarray]:
        """The likeliest labels of each chain of shapes. Pieces of like lengths are decoded side by side."""
        # All chains in a row, with so many marks beyond an end between them that windows never meet.
        lengths = np.array([len(c) for c in chains], np.int64)
        starts = np.cumsum(lengths + WINDOW) - lengths - WINDOW
        edge = np.zeros(WINDOW, np.int64)
        row = np.concatenate([part for c in chains for part in (c, edge)]) if len(chains) else edge
        scores = emissions(row, self.weights)
        pieces, owner = [], []
        for number, (start, length, inner) in enumerate(zip(starts.tolist(), lengths.tolist(), self.cuts(scores, starts, lengths), strict=True)):
            cuts = [0, *inner, length]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                # A piece before a cut ends in O, and the next one begins after an O.
                pieces.append((scores[start + a : start + b], a > 0, b < length))
                owner.append(number)
        labels: list[np.ndarray] = [np.zeros(0, np.int8)] * len(pieces)
        order = np.argsort([-len(p[0]) for p in pieces], kind="stable")
        at = 0
        while at < len(order):
            some = order[at : at + max(1, _CELLS // max(len(pieces[order[at]][0]), 1))]
            for i, found in zip(some, self._decode([pieces[i] for i in some]), strict=True):
                labels[i] = found
            at += len(some)
        out: list[list[np.ndarray]] = [[] for _ in chains]
        for number, found in zip(owner, labels, strict=True):
            out[number].append(found)
        return [np.concatenate(parts) for parts in out]

    def cuts(self, scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[list[int]]:
        """Places in each long chain behind a token that is O on the best path, whatever the labels are
        some tokens before and after it. The chains lie at ``starts`` in ``scores``."""
        aims = [np.arange(LONG, n - LONG // 2, LONG) for n in lengths.tolist()]
        owner = np.repeat(np.arange(len(aims)), [len(a) for a in aims])
        aim = np.concatenate([*aims, np.zeros(0, np.int64)]).astype(np.int64)
        tried = aim[:, None] + _STRIDE * np.arange(_TRIES)
        inside = tried < lengths[owner][:, None] - _AROUND
        sure = np.zeros(tried.shape, bool)
        sure[inside] = self._settled(scores, (tried + starts[owner][:, None])[inside])
        out: list[list[int]] = [[] for _ in aims]
        for number, place in zip(owner[sure.any(axis=1)].tolist(), tried[np.arange(len(aim)), sure.argmax(axis=1)][sure.any(axis=1)].tolist(), strict=True):
            out[number].append(place + 1)
        return out

    def _settled(self, scores: np.ndarray, centres: np.ndarray) -> np.ndarray:
        def through(first: int, last: int) -> np.ndarray:
            """The best way from each label before the first token to each of the last token's."""
            ways = self.moves + scores[centres + first][:, None, :]
            for t in range(first + 1, last + 1):
                ways = (ways[:, :, :, None] + self.moves).max(axis=2) + scores[centres + t][:, None, :]
            return ways

        before, after = through(1 - _AROUND, 0), through(1, _AROUND)
        plain = before[:, :, :1] + after[:, :1, :]
        other = (before[:, :, 1:, None] + after[:, None, 1:, :]).max(axis=2)
        return (plain > other + 1e-6).all(axis=(1, 2))

    def _decode(self, pieces: list[tuple[np.ndarray, bool, bool]]) -> list[np.ndarray]:
        """Labels of pieces (scores, after an O, ends in O), from the longest to the shortest."""
        lengths = np.array([len(p[0]) for p in pieces])
        longest, many = int(lengths[0]), int((lengths > 0).sum())
        scores = np.zeros((many, longest, len(LABELS)))
        for i in range(many):
            scores[i, : lengths[i]] = pieces[i][0]
        follows = np.array([p[1] for p in pieces[:many]], bool)
        back = np.zeros((longest, many, len(LABELS)), np.int8)
        ends = np.zeros((many, len(LABELS)))
        best = np.where(follows[:, None], self.moves[0], np.where(_START, 0, -1e9)) + scores[:, :1].sum(axis=1)
        alive = many
        for t in range(1, longest):
            left = int(np.searchsorted(-lengths[:many], -t, side="left"))
            ends[left:alive], alive = best[left:alive], left
            step = best[:alive, :, None] + self.moves
            back[t, :alive] = step.argmax(axis=1)
            best = step.max(axis=1) + scores[:alive, t]
        ends[:alive] = best[:alive]
        labels = np.zeros((many, longest), np.int8)
        last = np.where([p[2] for p in pieces[:many]], 0, ends.argmax(axis=1)) if many else np.zeros(0, int)
        labels[np.arange(many), lengths[:many] - 1] = last
        for t in range(longest - 1, 0, -1):
            alive = int(np.searchsorted(-lengths[:many], -t, side="left"))
            labels[:alive, t - 1] = back[t, np.arange(alive), labels[:alive, t]]
        return [labels[i, : lengths[i]] if i < many else np.zeros(0, np.int8) for i in range(len(pieces))]


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis)
    return top + np.log(np.exp(a - np.expand_dims(top, axis)).sum(axis=axis))


def train(chains: list[tuple[np.ndarray, np.ndarray]], epochs: int = 150, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """Maximum likelihood by gradient ascent, with forward-backward for the expectations."""
    size, n = len(LABELS), sum(len(m) for m, _ in chains)
    weights, moves = np.zeros((2 * WINDOW + 1, N_SHAPES, size)), np.zeros((size, size))
    seen_w, seen_m = np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)
    for _ in range(epochs):
        slope_w, slope_m = -decay * weights, -decay * moves
        blocked = np.where(_ALLOWED, moves, -1e9)
        for marks, labels in chains:
            e = emissions(marks, weights)
            length = len(marks)
            ahead, behind = np.zeros_like(e), np.zeros_like(e)
            ahead[0] = e[0] + np.where(_START, 0, -1e9)
            for t in range(1, length):
                ahead[t] = e[t] + _log_sum(ahead[t - 1][:, None] + blocked, 0)
            for t in range(length - 2, -1, -1):
                behind[t] = _log_sum(blocked + e[t + 1] + behind[t + 1], 1)
            whole = _log_sum(ahead[-1], 0)
            residual = -np.exp(ahead + behind - whole)
            residual[np.arange(length), labels] += 1
            padded = np.concatenate([np.zeros(WINDOW, np.int64), marks, np.zeros(WINDOW, np.int64)])
            for d in range(2 * WINDOW + 1):
                np.add.at(slope_w[d], padded[d : d + length], residual / n)
            for t in range(1, length):
                pair = np.exp(ahead[t - 1][:, None] + blocked + e[t] + behind[t] - whole)
                slope_m -= pair / n
                slope_m[labels[t - 1], labels[t]] += 1 / n
        seen_w += slope_w**2
        seen_m += slope_m**2
        weights += rate * slope_w / np.sqrt(seen_w)
        moves += rate * slope_m / np.sqrt(seen_m)
    return Field(weights, moves)


#: The small labelled table: [kind|span] marks a span.
LABELLED = (
    "and the [secret|password=a81f00c362] of the", "th password = [secret|x9K2mm41Qz77] and", "my password: [secret|hunter22b]",
    'a token = "[secret|b88d04a6ebdf3c204f17cc95a6be0f1f2d56dec5]" here', "token=[secret|Zk81mQ0pLw22aa] was",
    'set api key = "[secret|4f9a0c77e21b]" now', "secret: [secret|00ffab12cd34ef56] and", "key=[secret|9c1185a5c5e9fc54] the",
    "auth token [secret|e3b0c44298fc1c149afb] is", "the token was lost", "a password is needed", "key words of the",
    "call [number|555-867-5309] now", "tel [number|(212) 555-0147] or", "ssn [number|078-05-1120] of", "phone: [number|020 7946 0958].",
    "fax [number|415 555 2671] and", "id [number|219-09-9999] was", "number [number|555.010.9988] the", "at [number|800-555-0199] th.",
    "in 1998 the", "of 12 and 34 were", "page 40451 of", "3.5 per cent of 1,200", "on 2024-01-05 it", "version 2.0.1 is", "at 10:30 the",
    "room 12b or flat 7", "the year 2001, the day 5.", "a + b = c and d", "it was. The end: no", "(see 4) and 17-20 of", "US 66 and A4",
    "the and of it", "One. Two, three", "x=1 and y = 22 are", "section 4.2.1 of part 3", "100 200 300 400 of", "key figures: 12, 13",
    "+1 (288) 555-5549 is", "from 29.217.126.147 of", "imf.14@mail9.example.com on", "hearing 4429526289707589 for", "it 4929 4855 1234 5678 is",
)


def labelled_chains() -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for line in LABELLED:
        text, spans = "", []
        for part in re.split(r"(\[\w+\|[^\]]*\])", line):
            if part.startswith("[") and "|" in part:
                kind, value = part[1:-1].split("|", 1)
                if kind == "secret" and "=" in value:
                    head, value = value.split("=", 1)
                    text += head + "="
                spans.append((kind, len(text), len(text) + len(value)))
                text += value
            else:
                text += part
        tokens = [(m.group(), m.start()) for m in _TOKEN.finditer(text)]
        labels = []
        for _, start in tokens:
            inside = next((s for s in spans if s[1] <= start < s[2]), None)
            labels.append("O" if inside is None else ("B-" if start == inside[1] else "I-") + inside[0])
        out.append((shapes([t for t, _ in tokens]), np.array([LABELS.index(x) for x in labels])))
    return out


@cache
def default_field() -> Field:
    return train(labelled_chains())


# --- finding --------------------------------------------------------------


def added_spans(texts: list[str], found: list[list[tuple[str, int, int]]], field: Field) -> list[list[tuple[str, int, int]]]:
    """Spans of the field that touch none of the ``found`` ones."""
    out: list[list[tuple[str, int, int]]] = []
    for text, known, labels in zip(texts, found, field.viterbi([shapes(_TOKEN.findall(t)) for t in texts]), strict=True):
        spans: list[list] = []
        if labels.any():
            for token, label in zip(_TOKEN.finditer(text), labels.tolist(), strict=True):
                name = LABELS[label]
                if name[0] == "B":
                    spans.append([name[2:], *token.span()])
                elif name[0] == "I":
                    spans[-1][2] = token.end()
        out.append([(k, a, b) for k, a, b in spans if not any(a < y and x < b for _, x, y in known)])
    return out


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """Per row: (doc_id, base, added), each an array of structs (kind, start, end).

    ``base`` holds the matches of the patterns by kind (email, ip, card, phone) and start;
    ``added`` what the field finds besides, by kind (secret, number) and start, clear of
    ``base``. Places are code points, the end exclusive. Null and empty texts have
    none. Repeated rows and rows without an id are searched alike; other columns are
    ignored.
    """
    field = field or default_field()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, texts in text_blocks(frames, "text"):
            base = [pattern_spans(t) for t in texts]
            more = [sorted(s, key=lambda x: (ADDED.index(x[0]), x[1])) for s in added_spans(texts, base, field)]
            named = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"].to_numpy(), "base": list(map(named, base)), "added": list(map(named, more))}
            )
        _shapes.clear()
        give_back()

    span = "array<struct<kind: string, start: bigint, end: bigint>>"
    given = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    found = given.mapInPandas(run, f"doc_id string, base {span}, added {span}")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def redact(docs: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets, as ``[EMAIL]``.

    Of overlapping spans the one that starts first is replaced, and the rest of
    another from its end on. A null text stays null.
    """
    field = field or default_field()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for block, texts in text_blocks(iter([batch.to_frame("text")]), "text"):
                base = [pattern_spans(t) for t in texts]
                for given, t, a, b in zip(block["text"], texts, base, added_spans(texts, base, field), strict=True):
                    out.append(None if given is None else _replaced(t, a + b))
            yield pd.Series(out, dtype=object)
        _shapes.clear()
        give_back()

    return docs.withColumn(text, F.pandas_udf(run, "string")(F.col(text)))


def _replaced(text: str, spans: list[tuple[str, int, int]]) -> str:
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if end > at:
            parts += [text[at : max(start, at)], f"[{kind.upper()}]"]
            at = end
    return "".join([*parts, text[at:]])
