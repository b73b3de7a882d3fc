"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

The rows of a conversation, in the order of their turns (nulls first; rows of one turn by a hash of
role and text), are a sequence over a small alphabet: the role's initial (system, user, assistant,
other) and the row's first fault (blank, duplicate, truncated). The edits keep a row (0), give it
the role user or assistant (2), delete it (3; blank rows and duplicates have to go), or insert an
empty row (2); an undeleted truncated row adds 1. The kept roles have to read ``(s?(ua)+)?``, which
an automaton of four states accepts, so a row is a matrix over (min, +): the cheapest way from each
state to each, with the initials of its edits as a rope. Of equally cheap ways the one with the
least initials is taken; equal costs never leave one rope a prefix of another, so this order
survives concatenation and the product of matrices is associative.

The sequences of many conversations are compressed together by Re-Pair: the commonest adjacent pair
becomes a rule until none is left that pays. Each rule's matrix is the product of its two parts',
worked out once, bottom-up, and serves all conversations that hold it; what remains of a
conversation is folded through the matrices from the start state.

At scale: three shuffles by conversation, two of them without texts. A task streams over sorted
rows; of one conversation it holds one byte a row, as the audit itself has, never its texts.

Defined cases: null ids, roles and texts are one space; a null ``conv_id`` is a conversation, too.
An empty table gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.sizing import store

WHITE = " \t\n\x0b\x0c\r"
INITIALS = "sua"  # any other initial has the code 3
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
ROLES = {"u": "user", "a": "assistant"}

#: Symbols that are compressed together. More of them share more rules; results do not depend on it.
BLOCK = 1 << 16
#: A pair that occurs less often does not pay for its matrix.
LEAST_PAIRS = 4
RULES = 400

START, SYSTEM, USER, ASSISTANT = STATES = range(4)
_ACCEPTED = (START, ASSISTANT)
_AFTER = {  # state and initial of a row that stays: the next state
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
_DELETE = 1  # symbol of a row that has to go; 2 to 9: initial code, plain or truncated


# --- the rows ---------------------------------------------------------------


def plain(conversations: DataFrame) -> DataFrame:
    """The four columns that count, without null roles or texts; each row once (``copies``)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), text("role"), text("text"), F.lit(1).alias("copies"))


def damage(conversations: DataFrame) -> DataFrame:
    """:func:`plain` rows with faults planted by a checksum of their key: ``copies`` 0 is a lost
    row, 2 a repeated one; texts emptied or without their marks; a role replaced by user."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.crc32(key.cast("binary")) % 20
    keyed = plain(conversations).withColumn("fault", fault)
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return keyed.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1).alias("copies"),
    )


def _content() -> Column:
    """A hash that tells pairs of role and text apart."""
    return F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256))


def _coded(rows: DataFrame) -> DataFrame:
    """Narrow rows: key, ``code`` (initial and fault of the first copy) and ``copies``."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.lit(len(INITIALS))
    for code, letter in enumerate(INITIALS):
        initial = F.when(F.substring("role", 1, 1) == letter, code).otherwise(initial)
    fault = F.when(bare == "", BLANK).when(F.substring(bare, -1, 1).isin(".", "!", "?"), OK).otherwise(TRUNCATED)
    narrow = rows.select("conv_id", "turn", _content().alias("content"), initial.alias("initial"), fault.alias("fault"), "copies")
    # Lost rows stay only to show that their conversation exists.
    seen = Window.partitionBy("conv_id", "content", F.col("copies") > 0).orderBy(F.col("turn").asc_nulls_first())
    again = (F.row_number().over(seen) > 1) & (F.col("fault") != BLANK)
    fault = F.when(again, DUPLICATE).otherwise(F.col("fault"))
    return narrow.select("conv_id", "turn", "content", (F.col("initial") * 4 + fault).cast("tinyint").alias("code"), F.col("copies").cast("tinyint").alias("copies"))


# --- matrices over (min, +) with ropes ----------------------------------------
# A rope is a string or a pair of ropes. A matrix is a list of 16 entries, (cost, rope) or None.


def before(a, b) -> bool:
    """Whether rope ``a`` spells less than rope ``b``. Parts that both share are passed over."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if isinstance(x, tuple):
            left += (x[1], x[0])
            right.append(y)
        elif isinstance(y, tuple):
            right += (y[1], y[0])
            left.append(x)
        else:
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x[:n] < y[:n]
            if len(x) > n:
                left.append(x[n:])
            if len(y) > n:
                right.append(y[n:])
    return any(part != "" for part in right) and not left


def spelled(rope) -> str:
    found, todo = [], [rope]
    while todo:
        part = todo.pop()
        if isinstance(part, tuple):
            todo += (part[1], part[0])
        else:
            found.append(part)
    return "".join(found)


def _better(new, old):
    if old is None or new[0] < old[0] or (new[0] == old[0] and before(new[1], old[1])):
        return new
    return old


def times(a: list, b: list, rows=STATES) -> list:
    """The product: the cheapest way through ``a`` and then ``b``."""
    out = [None] * 16
    for i in rows:
        for k in STATES:
            first = a[4 * i + k]
            if first is None:
                continue
            for j in STATES:
                second = b[4 * k + j]
                if second is not None:
                    rope = (first[1], second[1]) if first[1] != "" and second[1] != "" else first[1] or second[1]
                    out[4 * i + j] = _better((first[0] + second[0], rope), out[4 * i + j])
    return out


def _inserts() -> list:
    """Any number of inserted rows; more than two lead nowhere new."""
    out = [None] * 16
    for i in STATES:
        state, letters = i, ""
        for _ in range(3):
            out[4 * i + state] = _better((2 * len(letters), letters), out[4 * i + state])
            state, letters = (ASSISTANT if state == USER else USER), letters + "I"
    return out


def _row(symbol: int) -> list:
    """One row: deleted, kept or given a role."""
    out = [None] * 16
    for i in STATES:
        out[5 * i] = (3, "D")
    if symbol != _DELETE:
        code, truncated = divmod(symbol - 2, 2)
        ways = [("u", 2, "R"), ("a", 2, "R")]
        if code < 3:
            ways.append((INITIALS[code], 0, "K"))
        for initial, cost, letter in ways:
            for i in STATES:
                j = _AFTER.get((i, initial))
                if j is not None:
                    out[4 * i + j] = _better((cost + truncated, letter), out[4 * i + j])
    return out


_CLOSE = _inserts()
#: A symbol's matrix: inserted rows, then the row. Rows inserted at the end come with the last step.
_BASE = [None, *(times(_CLOSE, _row(s)) for s in range(1, 10))]


# --- Re-Pair ------------------------------------------------------------------


def _apart(at: np.ndarray) -> np.ndarray:
    """Of places of a pair of equal symbols, every other one of each run: those that do not overlap."""
    starts = np.append(True, np.diff(at) > 1)
    run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - run) % 2 == 0]


def compress(joined: np.ndarray, least: int = LEAST_PAIRS, most: int = RULES) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Re-Pair over symbols 1 to 9, with 0 between sequences: the sequences in what is left of them,
    and the rules, of which the n-th is symbol ``10 + n``."""
    joined, rules = joined.astype(np.int64), []
    while len(joined) > 1 and len(rules) < most:
        size = 10 + len(rules)
        left, right = joined[:-1], joined[1:]
        equal = np.flatnonzero(left == right)
        counts = np.bincount(left * size + right, minlength=size * size)
        counts[:: size + 1] = 0
        if len(equal):
            counts += np.bincount(left[_apart(equal)] * (size + 1), minlength=size * size)
        counts[:size] = counts[::size] = 0  # pairs across two sequences
        best = int(counts.argmax())
        if counts[best] < least:
            break
        a, b = divmod(best, size)
        at = np.flatnonzero((left == a) & (right == b))
        at = _apart(at) if a == b else at
        joined[at] = size
        joined = np.delete(joined, at + 1)
        rules.append((a, b))
    return joined, rules


def cheapest(sequences: list[bytes]) -> list[tuple[int, str]]:
    """Cost and audit of each sequence of symbols, its rules shared with the others."""
    joined = np.frombuffer(b"\0".join([*sequences, b""]), np.uint8)
    left, rules = compress(joined)
    matrices = list(_BASE)
    for a, b in rules:
        matrices.append(times(matrices[a], matrices[b]))
    known: dict[bytes, tuple[int, str]] = {}
    found = []
    for rest in np.split(left, np.flatnonzero(left == 0) + 1)[: len(sequences)]:
        symbols = rest[rest > 0]
        key = symbols.tobytes()
        if key not in known:
            known[key] = _folded(symbols.tolist(), matrices)
        found.append(known[key])
    return found


def _folded(symbols: list[int], matrices: list) -> tuple[int, str]:
    way, done = [(0, ""), *[None] * 15], []
    for n, symbol in enumerate(symbols):
        way = times(way, matrices[symbol], (START,))
        if n % 64 == 63:
            # Ropes stay short: what all ways have in common is settled.
            texts = [w and (w[0], spelled(w[1])) for w in way]
            common = os.path.commonprefix([w[1] for w in texts if w])
            done.append(common)
            way = [w and (w[0], w[1][len(common) :]) for w in texts]
    way = times(way, _CLOSE, (START,))
    best = None
    for state in _ACCEPTED:
        if way[state] is not None:
            best = _better(way[state], best)
    return best[0], "".join(done) + spelled(best[1])


# --- Spark --------------------------------------------------------------------

_SUMMARY = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
)
_EDITED = "place bigint, edit string, role string, text string"


class _Conversation:
    """Counts and symbols of one conversation while its rows pass by."""

    def __init__(self, conv_id):
        self.conv_id, self.symbols, self.faults = conv_id, bytearray(), [0, 0, 0, 0]
        self.low = self.high = self.last = None
        self.turns = self.illegal = 0

    def add(self, turn, code: int, copies: int) -> None:
        if copies and turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        initial, fault = divmod(code, 4)
        letter = (INITIALS + "-")[initial]
        for copy in range(copies):
            if copy and fault != BLANK:
                fault = DUPLICATE
            self.faults[fault] += 1
            self.illegal += self.last is not None and self.last + letter not in ("su", "ua", "au")
            self.last = letter
            self.symbols.append(_DELETE if fault in (BLANK, DUPLICATE) else 2 + 2 * initial + (fault == TRUNCATED))

    def row(self, cost: int, audit: str) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, *self.faults[BLANK:], self.illegal, cost, audit


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _schema(conv_id: pa.DataType, *fields: tuple[str, pa.DataType]) -> pa.Schema:
    return pa.schema([("conv_id", conv_id), *fields])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from narrow rows that come conversation by conversation, in order."""
    schema, block, size = None, [], 0

    def solved():
        answers = cheapest([bytes(c.symbols) for c in block])
        return _batch([c.row(*a) for c, a in zip(block, answers, strict=True)], schema)

    for batch in batches:
        if schema is None:
            numbers = ((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
            schema = _schema(batch.schema.field("conv_id").type, *numbers, ("audit", pa.string()))
        for conv_id, turn, code, copies in _rows([batch]):
            if not block or block[-1].conv_id != conv_id:
                if size >= BLOCK:
                    yield solved()
                    block, size = [], 0
                block.append(_Conversation(conv_id))
            block[-1].add(turn, code, copies)
            size += copies
    if block:
        yield solved()


def summarize(rows: DataFrame) -> DataFrame:
    """``conv_id``, the numbers of gaps, faults and illegal neighbours, ``cost`` and ``audit`` of each
    conversation of ``rows`` (as :func:`plain` and :func:`damage` give them), a stored table."""
    coded = _coded(rows).repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "content")
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {_SUMMARY}"
    return store(coded.select("conv_id", "turn", "code", "copies").mapInArrow(_summaries, schema))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows after the edits of their conversation's audit, which comes before them."""
    conv_id = audit = last = None
    at = place = 0

    def inserted(out):
        nonlocal at, place, last
        while audit is not None and at < len(audit) and audit[at] == "I":
            last = "a" if last == "u" else "u"
            out.append((conv_id, place, "I", ROLES[last], ""))
            at, place = at + 1, place + 1

    for batch in batches:
        fields = (("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()))
        schema, out = _schema(batch.schema.field("conv_id").type, *fields), []
        for key, edits, role, text, copies in _rows([batch]):
            if edits is not None:  # the next conversation
                inserted(out)
                conv_id, audit, at, place, last = key, edits, 0, 0, None
                continue
            for _ in range(copies):
                inserted(out)
                edit = audit[at]
                at += 1
                if edit == "D":
                    continue
                if edit == "R":
                    last = "a" if last == "u" else "u"
                    role = ROLES[last]
                else:
                    last = role[:1]
                out.append((conv_id, place, edit, role, text))
                place += 1
        yield _batch(out, schema)
    out = []
    inserted(out)
    if out:
        yield _batch(out, schema)


def repair(rows: DataFrame, summaries: DataFrame) -> DataFrame:
    """The repaired rows: ``conv_id``, ``place`` from 0, ``edit`` (K, R or I), ``role``, ``text``. The
    rows of a conversation come together and in order. Texts are shuffled once, and streamed."""
    order = ["conv_id", "_row", "turn", "_content"]
    nothing = lambda kind: F.lit(None).cast(kind)
    heads = summaries.select(
        "conv_id", F.lit(False).alias("_row"), nothing("bigint").alias("turn"), nothing("binary").alias("_content"),
        "audit", nothing("string").alias("role"), nothing("string").alias("text"), F.lit(1).alias("copies"),
    )
    lines = rows.where("copies > 0").select(
        "conv_id", F.lit(True).alias("_row"), "turn", _content().alias("_content"),
        nothing("string").alias("audit"), "role", "text", "copies",
    )
    dealt = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions(*order)
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {_EDITED}"
    return dealt.select("conv_id", "audit", "role", "text", "copies").mapInArrow(_edited, schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv_id, digest, schema = None, None, None
    for batch in batches:
        schema, out = _schema(batch.schema.field("conv_id").type, ("repaired_sha256", pa.string())), []
        for key, lines in itertools.groupby(_rows([batch]), key=lambda r: r[0]):
            if digest is None or key != conv_id:
                if digest is not None:
                    out.append((conv_id, digest.hexdigest()))
                conv_id, digest, first = key, hashlib.sha256(), True
            for _, role, text in lines:
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        yield _batch(out, schema)
    if digest is not None:
        yield _batch([(conv_id, digest.hexdigest())], schema)


def digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's lines ``role:text``, from the rows of :func:`repair`, streamed."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    return repaired.select("conv_id", "role", "text").mapInArrow(_hashed, f"conv_id {kind}, repaired_sha256 string")
