"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases, the phrases' names into longer phrases, and so on until one name is
left. Where a phrase begins depends on a few symbols around the place only, so equal substrings get
the same phrases, except for a few at their ends, whatever stands before them:

* a run of one symbol becomes one symbol, named by symbol and length;
* deterministic coin tossing: four times, a symbol's label becomes the lowest bit in which it
  differs from its left neighbour (place and value), which leaves six labels, neighbours differing;
* a local maximum of the labels begins a phrase, so phrases have two to about ten symbols;
* a phrase's name is a 64-bit hash of its symbols.

A fingerprint is the bottom-k sketch (:data:`SKETCH` least of 32 bits, as hexadecimal digits) of the
distinct names of phrases of all levels: first of those that span :data:`WIDE` code points or more,
and the last name of all; texts too short to fill the sketch with these add names of phrases from
:data:`NARROW` code points on, which rank behind (highest bit). Likeness is the sketches' estimate
of shared names over all names of both.

Defined cases: a null text is empty, an empty text has the empty fingerprint; equal texts have equal
fingerprints; two equal fingerprints have the likeness 1, an empty one and another 0. Texts are
parsed whole, in pieces of bounded working memory. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import BLOCK_CHARS

SKETCH = 64
WIDE, NARROW = 12, 4
CHUNK = 1 << 15

_SEP = 255  # label between texts; other labels are below 128
_CONTEXT = 6  # symbols to the left on which the start of a phrase depends


def _tossed() -> np.ndarray:
    """Labels from the labels of a symbol's left neighbour (high byte) and its own (low byte)."""
    pair = np.arange(1 << 16, dtype=np.uint32)
    left, own = pair >> 8, pair & 255
    differ = left ^ own
    low = differ & -differ
    return np.where(differ == 0, 0, 2 * np.bitwise_count(low - 1) + ((own & low) != 0)).astype(np.uint8)


_TOSSED = _tossed()
_WEIGHTS = np.random.default_rng(11).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(names: np.ndarray) -> np.ndarray:
    """Names with every bit stirred, none of them 0."""
    names = (names ^ (names >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    names = (names ^ (names >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    names ^= names >> np.uint64(31)
    names[names == 0] = 1
    return names


def _run(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Names of runs."""
    return _mix(symbols * _WEIGHTS[0] + lengths.astype(np.uint64) * _WEIGHTS[1])


def _collapsed(symbols: np.ndarray, spans: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """Runs of a symbol as one symbol; separators stay apart. And the runs inside runs, which texts
    share whose runs differ in length: places, names and spans of those of 2, 4, 8, ... symbols."""
    differ = (symbols[1:] != symbols[:-1]) | (symbols[1:] == 0)
    if differ.all():
        return symbols, np.ones(len(symbols), np.int64) if spans is None else spans, []
    starts = np.append(0, np.flatnonzero(differ) + 1)
    lengths = np.diff(np.append(starts, len(symbols)))
    kept = symbols[starts]
    total = lengths if spans is None else np.add.reduceat(spans, starts)
    runs = np.flatnonzero((lengths > 1) & (total >= NARROW))
    inside, length = [], 2
    while len(runs):
        inside.append((runs, _run(kept[runs], np.full(len(runs), length)), total[runs] // lengths[runs] * length))
        length *= 2
        runs = runs[lengths[runs] >= length]
    runs = np.flatnonzero(lengths > 1)
    kept[runs] = _run(kept[runs], lengths[runs])
    return kept, total, inside


def _labels(symbols: np.ndarray) -> np.ndarray:
    between = symbols == 0
    labels = np.empty(len(symbols), np.uint8)
    labels[0] = _SEP
    differ = symbols[1:] ^ symbols[:-1]
    low = differ & (~differ + np.uint64(1))
    place = np.bitwise_count(low - np.uint64(1))
    labels[1:] = (place << 1) + ((symbols[1:] & low) != 0)
    labels[between] = _SEP
    for _ in range(3):
        labels[1:] = _TOSSED[(labels[:-1].astype(np.uint16) << 8) | labels[1:]]
        labels[between] = _SEP
    return labels


def phrase_starts(symbols: np.ndarray) -> np.ndarray:
    """Where phrases begin. A separator (0, after each text) is a phrase of its own."""
    found = []
    for begin in range(0, len(symbols), CHUNK):
        left = max(-1, begin - _CONTEXT)
        part = symbols[max(left, 0) : begin + CHUNK + 1]
        if left < 0:
            part = np.insert(part, 0, 0)
        labels = _labels(part)
        starts = np.zeros(len(part), bool)
        starts[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
        between = part == 0
        starts |= between
        starts[1:] |= between[:-1]
        found.append(np.flatnonzero(starts[begin - left : begin - left + CHUNK]) + begin)
    return np.concatenate(found)


def phrase_names(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each phrase's symbols and their number; 0 for a separator."""
    found = []
    ends = np.append(starts[1:], len(symbols))
    for begin in range(0, len(starts), CHUNK):
        first, lengths = starts[begin : begin + CHUNK], ends[begin : begin + CHUNK] - starts[begin : begin + CHUNK]
        base = first[0]
        part = symbols[base : base + lengths.sum()]
        place = np.arange(len(part)) - np.repeat(first - base, lengths)
        sums = np.add.reduceat(part * _WEIGHTS[place & 31], first - base)
        names = _mix(sums + lengths.astype(np.uint64) * _WEIGHTS[32])
        names[symbols[first] == 0] = 0
        found.append(names)
    return np.concatenate(found)


def sketches(texts: list[str], size: int = SKETCH) -> list[np.ndarray]:
    """The sketch of each text: its least names, rising. The texts are parsed side by side."""
    if not texts:
        return []
    joined = ("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass")
    symbols = np.frombuffer(joined, np.uint32).astype(np.uint64) + np.uint64(1)
    symbols[np.cumsum([len(t) + 1 for t in texts]) - 1] = 0
    docs, spans, wides, narrows = np.arange(len(texts)), None, [], []

    def named(names, of, narrow=0):
        return (of.astype(np.uint64) << np.uint64(32)) | np.uint64(narrow << 31) | (names >> np.uint64(33))

    def note(names, widths, of):
        wide = widths >= WIDE
        wides.append(named(names[wide], of[wide]))
        narrow = (widths >= NARROW) & ~wide
        narrows.append(named(names[narrow], of[narrow], 1))

    while len(docs):
        symbols, spans, inside = _collapsed(symbols, spans)
        if inside:
            of = docs[np.minimum(np.cumsum(symbols == 0), len(docs) - 1)]
            for places, names, widths in inside:
                note(names, widths, of[places])
        # Texts of one symbol, or none, are done.
        ends = np.flatnonzero(symbols == 0)
        lengths = np.diff(np.append(-1, ends)) - 1
        single = lengths == 1
        if single.any():
            wides.append(named(_mix(symbols[ends[single] - 1]), docs[single]))
        done = lengths <= 1
        if done.any():
            stays = np.repeat(~done, lengths + 1)
            symbols, spans, docs = symbols[stays], spans[stays], docs[~done]
            if not len(docs):
                break
        starts = phrase_starts(symbols)
        symbols, spans = phrase_names(symbols, starts), np.add.reduceat(spans, starts)
        of = docs[np.minimum(np.cumsum(symbols == 0), len(docs) - 1)]
        note(symbols, np.where(symbols == 0, 0, spans), of)
    least = [np.unique(np.concatenate(wides))] if wides else []
    if least and narrows:
        lacks = np.bincount((least[0] >> np.uint64(32)).astype(np.int64), minlength=len(texts)) < size
        more = np.concatenate(narrows)
        least.append(np.unique(more[lacks[(more >> np.uint64(32)).astype(np.int64)]]))
    distinct = np.sort(np.concatenate(least)) if least else np.zeros(0, np.uint64)
    cuts = np.searchsorted(distinct, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    names = distinct.astype(np.uint32)
    return [names[a : min(a + size, b)] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    """Of the least names of both texts together, the share that both have."""
    if np.array_equal(a, b):
        return 1.0
    first, second = set(a.tolist()), set(b.tolist())
    least = sorted(first | second)[:size]
    return sum(n in first and n in second for n in least) / len(least)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_chars`` (code points) and ``fingerprint`` of each document, without a shuffle."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for part in _runs(range(len(texts)), lambda i, texts=texts: len(texts[i])):
                found = sketches([texts[i] for i in part])
                columns = [
                    ids.slice(part[0], len(part)),
                    pa.array([len(texts[i]) for i in part], pa.int64()),
                    pa.array(map(as_text, found), pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "fingerprint"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(rows, f"doc_id {kind}, n_chars bigint, fingerprint string")


def _runs(items: Iterable, size, most: int = BLOCK_CHARS) -> Iterator[list]:
    """Items in runs of about ``most`` characters."""
    run, total = [], 0
    for item in items:
        run.append(item)
        total += size(item)
        if total >= most or len(run) >= 4096:
            yield run
            run, total = [], 0
    if run:
        yield run


# --- each document and the next -------------------------------------------------


def beside_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents in partitions such that each is followed by the next in falling order of id: rows
    ``(_doc_id, _text, _guest)``, the guests being the first rows of the partition that comes next
    (after the last, of the first).

    Null ids come last; documents of one id fall by the text's checksum, then rise by the text. The
    texts are shuffled once: slices of the order are cut at quantiles, and the heads of slices, of
    which there are a few a shuffle partition, are looked up beforehand.
    """
    spark = docs.sparkSession
    number = F.coalesce(F.col(doc_id).cast("decimal(28,0)"), F.lit(str(-(2**63) - 1)).cast("decimal(28,0)"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    place = (number * F.lit(2**32).cast("decimal(10,0)") + F.crc32(body.cast("binary")).cast("decimal(10,0)")).cast("decimal(38,0)")
    rows = docs.select(F.col(doc_id).alias("_doc_id"), body.alias("_text"), place.alias("_place"))
    rows = rows.withColumn("_rough", F.col("_place").cast("double"))
    slices = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("_rough", [i / slices for i in range(1, slices)], 20 * slices).alias("c")).head().c
    splits = [-float("inf"), *sorted({0.0, *(cuts or ())}), float("inf")]  # three at least
    sliced = Bucketizer(splits=splits, inputCol="_rough", outputCol="_slice").transform(rows).drop("_rough")
    heads = sliced.groupBy("_slice").agg(F.max("_place").alias("_place")).orderBy(F.desc("_slice")).collect()
    # A head is also a guest of the slice before its own; of the last slice, if it is the first.
    guests = [(h._place, heads[i - 1]._slice) for i, h in enumerate(heads)]
    lookup = F.broadcast(spark.createDataFrame(guests, "_place decimal(38,0), _host double"))
    own = F.struct(F.col("_slice").alias("slice"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("_host").alias("slice"), F.lit(True).alias("guest"))
    seats = F.when(F.col("_host").isNull(), F.array(own)).otherwise(F.array(own, guest))
    seated = sliced.join(lookup, "_place", "left").select("_doc_id", "_text", "_place", F.explode(seats).alias("_seat"))
    dealt = seated.select("_doc_id", "_text", "_place", "_seat.slice", "_seat.guest")
    ordered = dealt.repartition("slice").sortWithinPartitions("slice", "guest", F.desc("_place"), "_text")
    return ordered.select("_doc_id", "_text", F.col("guest").alias("_guest"))


_COMPARED = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of :func:`beside_next` to comparisons with the edited text and with the next text."""
    def lines():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    last, sketch, kind, fields = None, None, None, None
    for run in _runs(lines(), lambda line: len(line[1])):
        if last is not None:
            run.insert(0, last)
        pairs = [(a, b) for a, b in zip(run[:-1], run[1:], strict=True) if not a[2]]
        edited = [_edited(a[1], b[1]) for a, b in pairs]
        fresh = [line[1] for line in run[last is not None :]]
        found = sketches([*fresh, *edited])
        own = ([] if last is None else [sketch]) + found[: len(fresh)]
        own_of = [(x, y) for x, y, line in zip(own[:-1], own[1:], run[:-1], strict=True) if not line[2]]
        last, sketch = run[-1], own[-1]
        if pairs:
            changed = found[len(fresh) :]
            yield {
                "doc_id": [a[0] for a, _ in pairs],
                "n_chars": [len(a[1]) for a, _ in pairs],
                "edited_sha256": [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
                "fingerprint": [as_text(x) for x, _ in own_of],
                "edited_fingerprint": [as_text(e) for e in changed],
                "near_edited": [likeness(x, e) for (x, _), e in zip(own_of, changed, strict=True)],
                "near_next": [likeness(x, y) for x, y in own_of],
            }


def _edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text (the last half replaced by as many code
    points of the next document, in falling order of id), and its likeness to that and to the next."""
    kind = docs.schema[doc_id].dataType
    schema = f"doc_id {kind.simpleString()}, {_COMPARED}"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        shape = pa.schema([
            ("doc_id", first.schema.field(0).type), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
            ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
            ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ])

        def again():
            yield first
            yield from batches

        for columns in _compared(again()):
            yield pa.RecordBatch.from_pydict(columns, schema=shape)

    return beside_next(docs, doc_id, text).mapInArrow(rows, schema)
