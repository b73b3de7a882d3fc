"""Packing by non-negative least squares.

Documents are cut into windows; what is left of each is a remainder. A histogram
of the remainders is matched by combinations of one to three lengths that fill a
window exactly: repeat counts solve a non-negative least-squares problem (by
coordinate descent, so that few are above zero), are rounded, and place whole
remainders. What no combination takes is cut into powers of two, which fill
windows greedily, longest first, without a gap; the last ones stand alone, as a
sequence whose length is a power of two needs no padding.

Only the histogram, as many numbers as a window has tokens, reaches the driver.
Ranks among equal lengths come from one range shuffle of (length, doc, start).
"""

from __future__ import annotations

import base64
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import give_back, text_blocks
from millrace.operators.ordering import index_by_key
from millrace.operators.sizing import store

WINDOW = 2048
END_ID = 1
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Fixed value: the pattern by which this vocabulary splits a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that a task remembers the ids of, and where memory is scarce.
KNOWN_WORDS, FEW_WORDS = 500_000, 100_000
#: A run of white space that goes on over the space at which a text is split.
_LONG_GAP = re.compile(r"\s (?:\s|$)")


def vocabulary(name: str, folder: str | None = None) -> str:
    """The place of a vocabulary file, on the machine that asks: in the installed package of public
    tokenizers, or in ``folder``."""
    if folder is not None:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _ranked(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers.

    The tokenizer never joins a word with what stands before its leading space, so
    texts are split there and equal words are encoded once, while they fit into
    dictionaries of fixed size. Texts with longer gaps, and those that hold the string of one of
    the tokenizer's added tokens, are encoded whole. Single words go through the same vocabulary in its other form, which starts up faster on
    short strings; the ids are the same.
    """

    def __init__(self, path: str, ranks: str, words: int = KNOWN_WORDS) -> None:
        self.words = words
        self.tokenizer = _tokenizer(path)
        self.ranked = _ranked(ranks, PATTERN)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}  # words after a space
        self.first: dict[str, bytes] = {}  # words at the start of a text

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        encode = self.ranked.encode_ordinary
        for w in words:
            ids = encode(" " + w)
            self.known[w] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.words:
            self.known = {}
        if len(self.first) > self.words:
            self.first = {}
        split, fresh = [], set()
        for text in texts:
            whole = any(token in text for token in self.added) or _LONG_GAP.search(text)
            words = None if whole else text.split(" ")
            split.append(words)
            if words:
                if words[0] not in self.first:
                    self.first[words[0]] = self._encode(words[0])
                fresh.update(set(words[1:]).difference(self.known))
        self._learn(fresh)
        return [
            self._encode(text)
            if words is None
            else self.first[words[0]] + b"".join(map(self.known.__getitem__, words[1:]))
            for text, words in zip(texts, split, strict=True)
        ]


def _powers(length: int) -> list[int]:
    """``length`` as powers of two, largest first."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


def _pieces(folder: str | None, window: int, end_id: int, lean: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(vocabulary(TOKENIZER, folder), vocabulary(RANKS, folder), FEW_WORDS if lean else KNOWN_WORDS)
        for frame, texts in text_blocks(frames, "text", 1 << 19):
            out = []
            for row, ids in zip(frame["row"], encoder.encode(texts), strict=True):
                ids = memoryview(ids + end)
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    part = ids[4 * start : 4 * (start + length)]
                    crcs, at = [], 0
                    for size in _powers(length):
                        crcs.append(zlib.crc32(part[4 * at : 4 * (at + size)]))
                        at += size
                    out.append((row, start, length, zlib.crc32(part), total, crcs))
            yield pd.DataFrame(out, columns=["row", "start", "length", "crc", "total", "crcs"])
        del encoder
        if lean:
            _tokenizer.cache_clear()
            _ranked.cache_clear()
        give_back()

    return run


def combinations(histogram: np.ndarray, sweeps: int = 8) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) of combinations that fill ``len(histogram) - 1`` exactly and never
    use more of a length than there is.

    ``histogram[n]`` is the number of pieces of length n. Coordinate descent solves
    min |A x - histogram| for x >= 0 over the single window, all pairs and all triples.
    """
    window = len(histogram) - 1
    left = histogram.astype(np.float64).copy()
    solved: dict[tuple[int, ...], float] = {}

    def descend(lengths: tuple[int, ...]) -> None:
        uses = {n: lengths.count(n) for n in lengths}
        step = sum(left[n] * u for n, u in uses.items()) / sum(u * u for u in uses.values())
        now = solved.get(lengths, 0.0)
        step = max(step, -now)
        if abs(step) > 1e-9:
            solved[lengths] = now + step
            for n, u in uses.items():
                left[n] -= u * step

    for sweep in range(sweeps):
        before = left.copy()
        descend((window,))
        for a in range(1, window // 2 + 1):
            descend((a, window - a))
        for a in range(1, window // 3 + 1):
            b = np.arange(a, (window - a) // 2 + 1)
            c = window - a - b
            gain = left[a] * (1 + (b == a)) + left[b] + left[c]
            # New triples only where all three are in supply; later sweeps adjust those in use.
            for other in b[(gain > 0.5) & (left[a] > 0) & (left[b] > 0) & (left[c] > 0)].tolist():
                if min(left[a], left[other], left[window - a - other]) > 0.25:
                    descend((a, other, window - a - other))
        for lengths in [k for k, x in solved.items() if len(k) == 3 and x > 0]:
            descend(lengths)
        if np.abs(left - before).max(initial=0) < 0.01:
            break
    supply = histogram.astype(np.int64).copy()
    chosen = []
    for lengths, x in sorted(solved.items(), key=lambda s: (-s[1], s[0])):
        repeats = min(int(x + 0.5), *(int(supply[n]) // lengths.count(n) for n in lengths))
        if repeats > 0:
            chosen.append((lengths, repeats))
            for n in lengths:
                supply[n] -= repeats
    return chosen


class Plan:
    """Where a piece goes, from its length and its rank among the pieces of that length."""

    def __init__(self, histogram: np.ndarray) -> None:
        self.window = len(histogram) - 1
        taken = np.zeros_like(histogram)
        #: For each length: ranks from here on, first sequence, uses in a sequence, first offset.
        self.slots: dict[int, list[tuple[int, int, int, int]]] = {}
        sequence = 0
        for lengths, repeats in combinations(histogram):
            for n in sorted(set(lengths)):
                uses, offset = lengths.count(n), sum(m for m in lengths if m < n)
                self.slots.setdefault(n, []).append((int(taken[n]), sequence, uses, offset))
                taken[n] += uses * repeats
            sequence += repeats
        self.taken, self.first_residual = taken, sequence
        rest = histogram - taken
        bits = max(self.window.bit_length(), 1)
        #: Parts of each power of two in shorter residual pieces, and how many in all.
        has = np.array([[n >> b & 1 for b in range(bits)] for n in range(self.window + 1)], np.int64)
        parts = has * rest[:, None]
        self.before = np.vstack([np.zeros((1, bits), np.int64), np.cumsum(parts, axis=0)])[:-1]
        totals = parts.sum(axis=0)
        larger = np.append(np.cumsum((totals << np.arange(bits))[::-1])[::-1][1:], 0)
        self.start = larger  # tokens of the residual stream before the parts of this power
        self.stream = int((totals << np.arange(bits)).sum())

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the piece, length, sequence, offset) of each part of the piece."""
        if rank < self.taken[length]:
            slots = self.slots[length]
            at = int(np.searchsorted([s[0] for s in slots], rank, side="right")) - 1
            base, sequence, uses, offset = slots[at]
            repeat, use = divmod(rank - base, uses)
            return [(0, length, sequence + repeat, offset + use * length)]
        out, begin = [], 0
        whole = self.stream - self.stream % self.window
        for size in _powers(length):
            bit = size.bit_length() - 1
            number = int(self.before[length, bit]) + rank - int(self.taken[length])
            at = int(self.start[bit]) + number * size
            if at < whole:
                found = (self.first_residual + at // self.window, at % self.window)
            else:  # the end of the stream: one sequence a part
                found = (self.first_residual + whole // self.window + at - whole, 0)
            out.append((begin, size, *found))
            begin += size
        return out


def pack(
    docs: DataFrame,
    folder: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    lean: bool = False,
) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) that hold every
    id of every document once, in sequences of at most ``window`` (a power of two) tokens.

    A document is the ids of its text, then ``end_id``; null and empty texts are
    that id alone. ``folder`` holds the vocabulary files, if not the installed package. A special
    token's string in a text is that token, as the tokenizer has it. Every sequence has ``window`` tokens or, at the end, a power of two, so
    none needs padding. Rows that share a doc_id, or have none, are documents of
    their own. Other columns are ignored; no rows give no rows.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    given = docs.select(F.col(doc_id).cast("string").alias("row"), F.col(text).alias("text"))
    pieces = store(
        given.mapInPandas(
            _pieces(folder, window, end_id, lean),
            "row string, start bigint, length bigint, crc bigint, total bigint, crcs array<bigint>",
        )
    )
    histogram = np.zeros(window + 1, np.int64)
    for n, many in pieces.groupBy("length").count().collect():  # at most one row a length
        histogram[n] = many
    firsts = np.concatenate([[0], np.cumsum(histogram)])
    plan = Plan(histogram)
    # The lengths need not keep the copies of a piece apart: equal rows take any rank.
    ranked = index_by_key(pieces, "length", "row", "start", "crc", name="place")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row, start, length, crc, total, crcs, place in frame.itertuples(index=False):
                parts = plan.place(length, place - int(firsts[length]))
                for number, (begin, size, sequence, offset) in enumerate(parts):
                    out.append((row, start + begin, size, crc if size == length else crcs[number], total, sequence, offset))
            yield pd.DataFrame(
                out, columns=["row", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            )

    placed = ranked.select("row", "start", "length", "crc", "total", "crcs", "place").mapInPandas(
        run, "row string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
    kind = docs.schema[doc_id].dataType
    return placed.select(F.col("row").cast(kind).alias("doc_id"), *[c for c in placed.columns if c != "row"])
