"""Near-duplicates by circulant MinHash.

One permutation of the shingle space spreads the shingles; a second one, shifted
circularly by 0, 1, 2, ..., gives every coordinate of the signature. Texts with
equal sets are one node from the start. Bands of coordinates form buckets, and
candidate pairs are confirmed on the full sets before they link.

A bucket never emits its pairs. First every text meets one other, the one of its buckets that shares
most buckets with others, as a text does from which others were copied; that connects most
near-copies. Then only those members of a bucket matter that are outside its commonest component.
All buckets with the same commonest component make one cluster, and the cluster's outer members
meet all of its members in blocks of bounded size, inside tasks: a row stands for a text in a block,
never for a pair, and only links leave a task. There a pair is first compared by two bits each of
many more coordinates; what lies 4.5 standard deviations below the bound (a chance of 3e-6 for a
pair at the bound) is no link, and the rest are compared by their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components, relabel
from millrace.llm.shared import text_blocks
from millrace.llm.shingles import mix, shingles
from millrace.operators.sizing import store

SHINGLE_WORDS = 5
SIMILARITY = 80  # per cent
BANDS, ROWS = 32, 5
SPACE_BITS = 20
#: Coordinates that members of a cluster compare, two bits of each.
WIDE = 1024
#: Texts, and shingles of texts, in a block of a cluster.
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 2_000_000
SALT_ROWS = 64


@cache
def _circle(coordinates: int) -> np.ndarray:
    """The second permutation, long enough to be read from any place on."""
    circle = np.random.default_rng(7).permutation(1 << SPACE_BITS).astype(np.int32)
    return np.concatenate([circle, circle[:coordinates]])


def signature(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """Coordinate i is the minimum, over the shingles, of the second permutation shifted by i."""
    shifts = np.lib.stride_tricks.sliding_window_view(_circle(coordinates), coordinates)
    places = (mix(hashes) >> np.uint64(64 - SPACE_BITS)).astype(np.int64)
    step = max(1, (1 << 19) // coordinates)
    lowest = shifts[places[:step]].min(axis=0)
    for at in range(step, len(places), step):
        lowest = np.minimum(lowest, shifts[places[at : at + step]].min(axis=0))
    return lowest


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band and row of ``signatures``."""
    rows = signatures.shape[1] // bands
    parts = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for row in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, row])
    return keys.view(np.int64)


def _sketch(words: int, bands: int, rows: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, texts in text_blocks(frames, "text"):
            hashes, bounds = shingles(texts, words)
            sets = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            low = np.zeros((len(sets), bands * rows), np.int32)
            for i, s in enumerate(sets):
                if len(s):
                    low[i] = signature(s, bands * rows)
            keys = band_keys(low, bands)
            yield pd.DataFrame(
                {
                    "id": frame["id"].to_numpy(),
                    # Two sums of mixed hashes stand for the set.
                    "set": [
                        mix(s).sum(dtype=np.uint64).tobytes() + mix(~s).sum(dtype=np.uint64).tobytes() for s in sets
                    ],
                    "n_shingles": [len(s) for s in sets],
                    "keys": [k if len(s) else k[:0] for k, s in zip(keys, sets, strict=True)],
                }
            )

    return run


def _wide(words: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shifts = 2 * np.arange(32, dtype=np.uint64)
        for frame, texts in text_blocks(frames, "text"):
            hashes, bounds = shingles(texts, words)
            # A text without shingles, beside another of its id, links with nothing.
            filled = np.flatnonzero(np.diff(bounds))
            if not len(filled):
                continue
            sets = [np.unique(hashes[bounds[i] : bounds[i + 1]]) for i in filled]
            low = np.stack([signature(s, WIDE) for s in sets])
            two = mix(low.astype(np.uint64)) & np.uint64(3)
            packed = (two.reshape(len(low), -1, 32) << shifts).sum(axis=2, dtype=np.uint64).view(np.int64)
            ids = frame["id"].to_numpy()[filled]
            yield pd.DataFrame({"node": ids, "bits": list(packed), "set": [s.view(np.int64) for s in sets]})

    return run


def _most_apart(similarity: int) -> int:
    """In how many coordinates the bits of a link can differ."""
    equal = similarity / 100 + (1 - similarity / 100) / 4
    return int(WIDE * (1 - equal) + 4.5 * (WIDE * equal * (1 - equal)) ** 0.5)


def similar(one: np.ndarray, other: np.ndarray, similarity: int) -> bool:
    """Whether two sets, sorted, have a Jaccard similarity of that many per cent."""
    common = len(np.intersect1d(one, other, assume_unique=True))
    return common > 0 and 100 * common >= similarity * (len(one) + len(other) - common)


def _met(similarity: int):
    """Links (a, b) between the outer members and all members of a block of a cluster."""
    odd, most = np.uint64(0x5555555555555555), _most_apart(similarity)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        ours, theirs = block[block["outer"]], block[~block["outer"]]
        links, above = [], {}

        def top(root: int) -> int:
            while root in above:
                root = above[root]
            return root

        if len(ours) and len(theirs):
            nodes, roots, mains = (theirs[c].to_numpy() for c in ("node", "root", "main"))
            bits = np.stack(theirs["bits"].to_list()).view(np.uint64)
            sets = theirs["set"].to_list()
            sizes = np.array([len(x) for x in sets])
            for node, root, own, mine in zip(ours["node"], ours["root"], ours["bits"], ours["set"], strict=True):
                near = (roots != root) & (100 * np.minimum(sizes, len(mine)) >= similarity * np.maximum(sizes, len(mine)))
                near &= (roots == mains) | (nodes < node)  # two outer members meet once
                at = np.flatnonzero(near)
                z = bits[at] ^ own.view(np.uint64)
                apart = np.bitwise_count((z | (z >> np.uint64(1))) & odd).sum(axis=1, dtype=np.int64)
                for i in at[np.argsort(apart, kind="stable")][: int((apart <= most).sum())].tolist():
                    if top(root) != top(int(roots[i])) and similar(mine, sets[i], similarity):
                        links.append((node, int(nodes[i])))
                        above[top(root)] = top(int(roots[i]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def _confirm(words: int, similarity: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, last_set = None, None
        for frame in frames:
            keep = np.zeros(len(frame), bool)
            for i, (one, other) in enumerate(zip(frame["text_a"], frame["text_b"], strict=True)):
                if other != last:
                    last, last_set = other, np.unique(shingles([other], words)[0])
                keep[i] = similar(np.unique(shingles([one], words)[0]), last_set, similarity)
            yield frame.loc[keep, ["a", "b"]]

    return run


def _verified(pairs: DataFrame, texts: DataFrame, words: int, similarity: int) -> DataFrame:
    """The (a, b) of ``pairs`` that are similar. Many pairs may share b, so b is salted."""
    often = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("int").alias("salts"))
    ours = (
        pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(store(often), "b")
        .withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int"))
        .drop("salts")
    )
    theirs = (
        texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
        .join(store(often), "b")
        .select("b", "text_b", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    )
    joined = ours.join(theirs, ["b", "salt"]).select("a", "b", "text_a", "text_b")
    return joined.mapInPandas(_confirm(words, similarity), "a bigint, b bigint").distinct()


def _links(buckets: DataFrame, texts: DataFrame, words: int, similarity: int) -> DataFrame:
    """(node, root) of the linked nodes, from ``buckets`` (key, node, size, mass)."""
    heads = buckets.groupBy("key").agg(F.max_by("node", "mass").alias("b"), F.max("mass").alias("mass_b"))
    meetings = buckets.join(store(heads), "key").where("node != b")
    pairs = store(meetings.groupBy(F.col("node").alias("a")).agg(F.max_by("b", "mass_b").alias("b")))
    labels = components(store(_verified(pairs, texts, words, similarity)))
    members = store(relabel(buckets.select("key", "node", "size", F.col("node").alias("root")), "root", labels))
    shares = store(members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")))
    mixed = shares.groupBy("key").agg(F.max_by("root", "n").alias("main"), F.count(F.lit(1)).alias("roots"))
    open_keys = store(mixed.where("roots > 1").select("key", "main"))
    clusters = store(members.join(open_keys, "key").select("main", "node", "root", "size").distinct())
    if clusters.isEmpty():
        return labels
    between = store(_clustered(clusters, texts, words, similarity))
    if between.isEmpty():
        return labels
    merged = components(store(relabel(relabel(between, "a", labels), "b", labels)))
    return store(relabel(labels, "root", merged).unionByName(merged))


def _clustered(clusters: DataFrame, texts: DataFrame, words: int, similarity: int) -> DataFrame:
    """Links (a, b) between the members of ``clusters`` (main, node, root, size) that are outside the
    main component and all members, each pair of a block of one with a block of the other in a task."""
    asked = store(clusters.select(F.col("node").alias("id")).distinct())
    wide = texts.join(asked, "id").mapInPandas(_wide(words), "node bigint, bits array<bigint>, set array<bigint>")
    outer = F.col("root") != F.col("main")

    def blocks(chosen: Column, name: str) -> Column:
        """Enough blocks that none holds too many texts or shingles."""
        texts, sizes = F.count_if(chosen), F.sum(F.when(chosen, F.col("size")).otherwise(0))
        most = F.greatest(texts / BLOCK_TEXTS, sizes / BLOCK_SHINGLES, F.lit(1.0))
        return F.ceil(most).cast("int").alias(name)

    many = store(clusters.groupBy("main").agg(blocks(outer, "outers"), blocks(F.lit(True), "alls")))
    placed = clusters.join(many, "main").join(store(wide), "node")
    seat = lambda count: F.pmod(F.xxhash64("node"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    columns = ["main", "node", "root", "bits", "set"]
    ours = placed.where(outer).select(*columns, F.lit(True).alias("outer"), seat("outers").alias("i"), every("alls").alias("j"))
    theirs = placed.select(*columns, F.lit(False).alias("outer"), seat("alls").alias("j"), every("outers").alias("i"))
    return ours.unionByName(theirs).groupBy("main", "i", "j").applyInPandas(_met(similarity), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    similarity: int = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_shingles, component_id, kept).

    Two rows link when their sets of ``words``-word shingles have a Jaccard
    similarity of at least ``similarity`` per cent; ``component_id`` is the smallest
    doc_id that links reach, and ``kept`` marks the row that bears it. With the
    default bands a pair at the bound escapes all buckets with a chance of 3e-6.

    Null texts and texts without words have an empty set and link with nothing.
    Rows that share a doc_id count as one document that links by any of its texts.
    A row without doc_id cannot be named by a link: it keeps a null component and
    is kept. Other columns are ignored; no rows give no rows.
    """
    given = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    sketch = store(
        given.where("id IS NOT NULL").mapInPandas(
            _sketch(words, bands, rows), "id bigint, set binary, n_shingles bigint, keys array<bigint>"
        )
    )
    filled = sketch.where("n_shingles > 0")
    nodes = store(filled.groupBy("set").agg(F.min("id").alias("node")))
    placed = filled.select("id", "set", "n_shingles", "keys").join(nodes, "set")
    banded = store(
        placed.where("id = node").select("node", F.col("n_shingles").alias("size"), F.explode("keys").alias("key"))
    )
    many = banded.groupBy("key").agg(
        F.min("node").alias("_first"), F.max("node").alias("_last"), F.count(F.lit(1)).alias("many")
    )
    shared = store(banded.join(store(many.where("_first < _last").select("key", "many")), "key"))
    mass = shared.groupBy("node").agg(F.sum("many").alias("mass"))
    buckets = store(shared.join(store(mass), "node").select("key", "node", "size", "mass").distinct())
    own = store(filled.select("id", "set").join(nodes, "set").select(F.col("id").alias("node"), F.col("node").alias("root")).where("node != root"))
    if buckets.isEmpty():
        links = own.limit(0)
    else:
        needed = store(buckets.select(F.col("node").alias("id")).distinct())
        texts = store(given.join(needed, "id"))
        links = _links(buckets, texts, words, similarity)
    # Rows of one id and several texts tie the sets of those texts.
    both = links.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(
        own.select(F.col("node").alias("a"), F.col("root").alias("b"))
    )
    labels = components(both)
    found = relabel(
        sketch.select(F.col("id").alias("doc_id"), "n_shingles").withColumn("component_id", F.col("doc_id")),
        "component_id",
        labels,
    ).withColumn("kept", F.col("doc_id") == F.col("component_id"))
    nameless = given.where("id IS NULL").mapInPandas(
        _sketch(words, bands, rows), "id bigint, set binary, n_shingles bigint, keys array<bigint>"
    )
    return found.unionByName(
        nameless.select(
            F.col("id").alias("doc_id"), "n_shingles",
            F.lit(None).cast("bigint").alias("component_id"), F.lit(True).alias("kept"),
        )
    )
