"""Nearest neighbours by inner product with a hierarchical k-means tree.

Vectors get one more component that brings them all to the same length, so the
largest inner product is the smallest distance. A tree of cluster centres is
fitted on a bounded sample; every vector is then filed under one leaf. A query
visits leaves best bin first, through a priority queue of the branches it has
passed by. How many leaves are enough is calibrated: the number is widened until
sample queries find the wanted share of their true neighbours.

Leaves are cut into blocks of bounded size, and so are the queries that visit
one, so a leaf that holds a third of all rows is many small tasks. What is left
per block is a short list, and the lists of a query are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.sizing import store

#: Upper bound of the vectors that the tree is fitted on, chosen by a hash of the id.
SAMPLE = 40_000
BRANCHES = 8
#: A node with fewer sample vectors is a leaf.
LEAF_SAMPLE = 800
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 2048
RECALL = 0.95
CALIBRATION = 200
#: What the calibration asks of its sample above the recall wanted.
MARGIN = 0.01


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(id, v): the vectors that take part.

    Left out are those that are null, empty, all zero, or hold a null or a
    component that is not finite; those without an id; and those whose number of
    components is not the commonest (of equally common ones, the largest).
    """
    given = vectors.select(F.col(vec_id).alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fine = given.where(
        "id IS NOT NULL AND v IS NOT NULL AND size(v) > 0"
    ).where(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    sizes = fine.groupBy(F.size("v").alias("n")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return fine.where(F.size("v") == (common[0].n if common else 0))


class Tree:
    """Centres of a hierarchical k-means, and the path of a vector through them."""

    def __init__(self, points: np.ndarray, branches: int = BRANCHES, leaf: int | None = None) -> None:
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []  # below 0: -1 - leaf number
        self.leaves = 0
        self.rng = np.random.default_rng(3)
        self.root = self._grow(points, branches, leaf or LEAF_SAMPLE)

    def _grow(self, points: np.ndarray, branches: int, leaf: int) -> int:
        centres, label = (None, None) if len(points) < leaf else self._means(points, branches)
        if centres is None or len(centres) < 2:
            self.leaves += 1
            return -self.leaves
        node = len(self.centres)
        self.centres.append(centres)
        self.children.append([])
        self.children[node] = [self._grow(points[label == c], branches, leaf) for c in range(len(centres))]
        return node

    def _means(self, points: np.ndarray, k: int, steps: int = 12):
        centres = np.unique(points[self.rng.choice(len(points), min(k, len(points)), replace=False)], axis=0)
        label = None
        for _ in range(steps):
            label = nearest(points, centres).argmin(axis=1)
            used = np.unique(label)
            centres = np.stack([points[label == c].mean(axis=0) for c in used])
        label = nearest(points, centres).argmin(axis=1)
        used, label = np.unique(label, return_inverse=True)
        return centres[used], label

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point is filed under."""
        out = np.zeros(len(points), np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                label = nearest(points[rows], self.centres[node]).argmin(axis=1)
                todo += [(c, rows[label == i]) for i, c in enumerate(self.children[node])]
        return out

    def visits(self, point: np.ndarray, enough: int, held: dict[int, int] | None = None, least: int = 0) -> list[int]:
        """Leaves in best-bin-first order: ``enough`` of them, and more until those visited hold
        ``least`` vectors, by the counts ``held``."""
        queue, order, out, many = [(0.0, 0, self.root)], 1, [], 0
        while queue and (len(out) < enough or many < least):
            _, _, node = heapq.heappop(queue)
            while node >= 0:
                distance = nearest(point[None], self.centres[node])[0]
                best = int(distance.argmin())
                for i, child in enumerate(self.children[node]):
                    if i != best:
                        heapq.heappush(queue, (float(distance[i]), order, child))
                        order += 1
                node = self.children[node][best]
            out.append(-1 - node)
            many += (held or {}).get(out[-1], 0)
        return out


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances but for the points' own squares."""
    return (centres**2).sum(axis=1) - 2 * points @ centres.T


def lifted(vectors: np.ndarray, bound: float) -> np.ndarray:
    """All at the same length; queries get a last component of 0 instead."""
    rest = np.sqrt(np.maximum(bound - (vectors**2).sum(axis=1), 0))
    return np.column_stack([vectors, rest])


def _asking(queries: np.ndarray) -> np.ndarray:
    """Queries beside :func:`lifted` vectors; their own length does not change an order."""
    return np.column_stack([queries, np.zeros(len(queries))])


def best(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """(query row, id, score) of the k largest inner products of each query but with itself.

    A matrix product finds the candidates; their scores are then summed one by one,
    in the same order wherever a vector lies, so that equal vectors tie.
    """
    out = []
    spare = k + 8
    for at in range(0, len(queries), 256):
        asked, own = queries[at : at + 256], query_ids[at : at + 256]
        rough = asked @ vectors.T
        slack = 1e-9 * (1 + np.abs(rough).max(initial=0))
        for row in np.flatnonzero(np.isin(own, ids)):
            rough[row, ids == own[row]] = -np.inf
        tied = np.arange(len(asked))
        if len(ids) > spare:
            chosen = np.argpartition(-rough, spare - 1, axis=1)[:, :spare]
            near = np.take_along_axis(rough, chosen, axis=1)
            # All but the spare ones are safe, if the last of the spare is clearly behind the k-th.
            floor = -np.partition(-near, k - 1, axis=1)[:, k - 1] - slack
            clear = near.min(axis=1) < floor
            exact = (vectors[chosen[clear]] * asked[clear][:, None, :]).sum(axis=2)
            exact[near[clear] == -np.inf] = -np.inf
            order = np.lexsort((ids[chosen[clear]], -exact), axis=1)[:, :k]
            found = np.take_along_axis(exact, order, axis=1)
            named = np.take_along_axis(ids[chosen[clear]], order, axis=1)
            kept = found > -np.inf
            rows = np.repeat(at + np.flatnonzero(clear), kept.sum(axis=1))
            out.append((rows, named[kept], found[kept]))
            tied = np.flatnonzero(~clear)
        for row in tied:
            scores = rough[row]
            floor = np.partition(scores, len(scores) - k)[len(scores) - k] - slack if len(scores) > k else -np.inf
            chosen = np.flatnonzero((scores >= floor) & (scores > -np.inf))
            exact = (vectors[chosen] * asked[row]).sum(axis=1)
            order = np.lexsort((ids[chosen], -exact))[:k]
            out.append((np.full(len(order), at + row), ids[chosen][order], exact[order]))
    if not out:
        return np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0)
    rows, named, found = (np.concatenate(c) for c in zip(*out, strict=True))
    order = np.argsort(rows, kind="stable")
    return rows[order], named[order], found[order]


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The k best of each query from lists (query_id, minus, ids), each sorted and at most k long."""
    pairs = lists.select("query_id", F.explode(F.arrays_zip("minus", "ids")).alias("f"))
    found = (
        pairs.select("query_id", F.col("f.ids").alias("vec_id"), F.col("f.minus").alias("minus"))
        .repartition("query_id")  # once, for both steps below
        .groupBy("query_id", "vec_id")
        .agg(F.min("minus").alias("minus"))
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("minus", "vec_id"))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", (-F.col("minus")).alias("score"))


_LIST = "query_id bigint, minus array<double>, ids array<bigint>"


def _lists(query_ids: np.ndarray, row: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pd.DataFrame:
    bounds = np.searchsorted(row, np.arange(len(query_ids) + 1))
    return pd.DataFrame(
        {"query_id": query_ids, "minus": np.split(-scores, bounds[1:-1]), "ids": np.split(ids, bounds[1:-1])}
    )


def _stack(column: pd.Series) -> np.ndarray:
    """Rows from vectors as arrays, or as the bytes of :func:`_packed`."""
    values = column.tolist()
    if values and isinstance(values[0], bytes):
        return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)
    return np.stack(values).astype(np.float64)


def _packed(vectors: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(vectors)]


class Index:
    """A fitted tree and the vectors filed under its leaves."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows = rows = store(rows.distinct())
        seen = rows.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("id").alias("ids"),
            F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("bound"),
        ).head()
        self.n, self.bound = seen.n, seen.bound or 0.0
        self.again = seen.n - seen.ids  # rows that bear the id of another
        place = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
        sample = rows.where(place * self.n < SAMPLE * 1_000_000).select("v").toPandas()  # bounded by SAMPLE
        points = _stack(sample["v"]) if len(sample) else np.zeros((0, 1))
        self.tree = tree = Tree(lifted(points, self.bound))
        bound = self.bound

        def file(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                if len(frame):
                    points = _stack(frame["v"])
                    leaf = tree.leaf_of(lifted(points, bound))
                    yield pd.DataFrame({"id": frame["id"], "v": _packed(points), "leaf": leaf})

        self.filed = store(rows.mapInPandas(file, "id bigint, v binary, leaf bigint"))
        many = self.filed.groupBy("leaf").count().collect()  # a row a leaf, whose number SAMPLE bounds
        self.held = {r.leaf: r["count"] for r in many}
        self.blocks = {r.leaf: -(-r["count"] // BLOCK_VECTORS) for r in many}

    def exact(self, queries: DataFrame, k: int) -> DataFrame:
        """Every vector against a bounded set of queries, block by block."""
        asked = queries.toPandas()
        ids, matrix = asked["id"].to_numpy(), _stack(asked["v"]) if len(asked) else np.zeros((0, 1))

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                if len(frame) and len(ids):
                    yield _lists(ids, *best(matrix, ids, _stack(frame["v"]), frame["id"].to_numpy(), k))

        return _merged(self.rows.mapInPandas(run, _LIST), k)

    def search(self, queries: DataFrame, k: int, leaves: int) -> DataFrame:
        """(query_id, rank, vec_id, score) from the first ``leaves`` leaves of each query, and more where
        those hold too few vectors for ``k`` besides its own."""
        tree, blocks, held, least = self.tree, self.blocks, self.held, k + 1 + self.again

        def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                if len(frame):
                    points = _stack(frame["v"])
                    order = [tree.visits(p, leaves, held, least) for p in _asking(points)]
                    yield pd.DataFrame({"id": frame["id"], "v": _packed(points), "leaf": order})

        routed = queries.select("id", "v").mapInPandas(route, "id bigint, v binary, leaf array<bigint>")
        routed = store(routed.select("id", "v", F.explode("leaf").alias("leaf")))
        asked = {r.leaf: -(-r["count"] // BLOCK_QUERIES) for r in routed.groupBy("leaf").count().collect()}
        leaf_blocks = F.create_map(*[F.lit(x) for p in (blocks or {0: 1}).items() for x in p])
        leaf_asks = F.create_map(*[F.lit(x) for p in (asked or {0: 1}).items() for x in p])

        def numbered(of: Column, salt: str) -> Column:
            return F.pmod(F.xxhash64("id", F.lit(salt)), of).cast("int")

        def copies(of: Column) -> Column:
            return F.explode(F.sequence(F.lit(0), of - 1))

        theirs = self.filed.withColumn("_asks", leaf_asks[F.col("leaf")]).where("_asks IS NOT NULL").select(
            "id", "v", "leaf", numbered(leaf_blocks[F.col("leaf")], "v").alias("block"), copies(F.col("_asks")).alias("ask")
        )
        ours = routed.withColumn("_blocks", leaf_blocks[F.col("leaf")]).where("_blocks IS NOT NULL").select(
            "id", "v", "leaf", copies(F.col("_blocks")).alias("block"), numbered(leaf_asks[F.col("leaf")], "q").alias("ask")
        )

        def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({"query_id": np.zeros(0, np.int64), "minus": [], "ids": []})
            ids = left["id"].to_numpy()
            return _lists(ids, *best(_stack(left["v"]), ids, _stack(right["v"]), right["id"].to_numpy(), k))

        key = ["leaf", "block", "ask"]
        return _merged(ours.groupBy(*key).cogroup(theirs.groupBy(*key)).applyInPandas(meet, _LIST), k)

    def calibrate(self, k: int, recall: float = RECALL, queries: int = CALIBRATION) -> int:
        """The number of leaves, widened one by one until a bounded sample of rows, asked as
        queries, finds ``recall`` of its true neighbours and a margin, as it is only a sample."""
        place = F.pmod(F.xxhash64("id", F.lit("calibrate")), F.lit(1_000_000))
        asked = store(self.rows.where(place * self.n < queries * 1_000_000))
        truth = self.exact(asked, k).select("query_id", F.col("vec_id").alias("id"))
        found = self.filed.join(store(truth), "id").select("query_id", "leaf").toPandas()  # k rows a query
        sample = asked.toPandas()
        visit = {
            q: {leaf: i + 1 for i, leaf in enumerate(self.tree.visits(p, self.tree.leaves))}
            for q, p in zip(sample["id"], _asking(_stack(sample["v"])), strict=True)
        } if len(sample) else {}
        needed = np.sort([visit[q][leaf] for q, leaf in zip(found["query_id"], found["leaf"], strict=True)])
        # Without a sample every leaf is visited.
        return int(needed[int(np.ceil(min(1, recall + MARGIN) * len(needed))) - 1]) if len(needed) else self.tree.leaves


def neighbours(rows: DataFrame, queries: DataFrame, k: int, recall: float = RECALL) -> DataFrame:
    """The ``k`` nearest found for each of ``queries``, which are some of the ``rows`` (see
    :func:`usable`): (query_id, rank, vec_id, score), ties to the smaller id.

    A query's own id is no candidate. Rows that share an id count once, by the nearest. Fewer than ``k``
    are returned only if there are fewer candidates; no rows give no rows.
    """
    index = Index(rows)
    return index.search(queries, k, index.calibrate(k, recall))
