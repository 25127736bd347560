"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Vectors are scaled to length 1, so the largest cosine is the least Euclidean distance, and projected
to ``DIMENSIONS`` coordinates by Gaussian directions.  For two points at distance d the squared
distance of their projections is d^2 times a chi-square variable, so with the k-th best distance
d_k found so far, a point that is nearer has its projection within t * d_k^2 with probability
``CONFIDENCE``, t being that quantile.  The search takes the leaves of a kd-tree by increasing
distance in the projection, verifies their points on the original vectors, and stops at the first
leaf beyond t * d_k^2.

Distribution.  The top of the kd-tree is fitted on a bounded sample (``SAMPLE`` points) and cuts all
points into cells of about ``CELL_ROWS``; each cell builds the rest of its tree.  A query first
searches its own cell, then those other cells that the test does not exclude at its d_k.  A cell with more than
twice ``CELL_ROWS`` points, as there are where the sample cannot place enough cuts, is dealt over parts that are searched
each; a cell that many queries reach takes them in blocks and is copied for those blocks only.  So a task holds
one part and one block of queries at most.

Copies.  Of points with equal vectors only the k + 1 least ids can be among any k nearest with ties to
the least id (one of them may be the query itself); the others are set aside before the search.

Edge cases: vectors that are null, zero or hold null or non-finite components take no part; vectors
of different lengths are no candidates of each other, those of another length than most have are one cell; fewer candidates than k give fewer rows; every row but those
of the query's own id is a candidate; rows of equal id and vector count once; an empty table gives no
rows.  The top cuts (16 bytes per cell) and the directions are what the driver holds.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

DIMENSIONS = 8
CONFIDENCE = 0.98
LEAF = 256
CELL_ROWS = 20_000
QUERY_BLOCK = 5_000
SAMPLE = 20_000
ROUNDING = 1e-9


def chi_square_quantile(p: float, freedom: int) -> float:
    """Of an even number of degrees of freedom, by bisection of the closed form."""
    def below(x):
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(freedom // 2))

    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


@functools.lru_cache(maxsize=16)
def directions(length: int, dimensions: int = DIMENSIONS, seed: int = 5) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((length, dimensions))


def top_cuts(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Coordinate and value at each inner node of a complete tree: children of node i are 2i+1 and 2i+2."""
    axis, value = np.zeros(2**depth - 1, dtype=np.int64), np.zeros(2**depth - 1)
    held = {0: points}
    for node in range(2**depth - 1):
        own = held.pop(node)
        spread = own.max(axis=0) - own.min(axis=0) if len(own) else np.zeros(points.shape[1])
        axis[node] = int(np.argmax(spread))
        value[node] = np.median(own[:, axis[node]]) if len(own) else 0.0
        left = own[:, axis[node]] < value[node]
        held[2 * node + 1], held[2 * node + 2] = own[left], own[~left]
    return axis, value


def cell_of(points: np.ndarray, axis: np.ndarray, value: np.ndarray) -> np.ndarray:
    node = np.zeros(len(points), dtype=np.int64)
    rows = np.arange(len(points))
    for _ in range((len(axis) + 1).bit_length() - 1):
        node = 2 * node + 1 + (points[rows, axis[node]] >= value[node])
    return node - len(axis)


def cell_boxes(axis: np.ndarray, value: np.ndarray, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    low, high = np.full((2 * len(axis) + 1, dimensions), -np.inf), np.full((2 * len(axis) + 1, dimensions), np.inf)
    for node in range(len(axis)):
        for child in (2 * node + 1, 2 * node + 2):
            low[child], high[child] = low[node], high[node]
        high[2 * node + 1, axis[node]] = value[node]
        low[2 * node + 2, axis[node]] = value[node]
    return low[len(axis):], high[len(axis):]


def project(vectors: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """Projections of the vectors scaled to length 1; vectors of another length have other directions."""
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ directions(vectors.shape[1], dimensions, seed)


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return (vectors @ query) / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(query))


class ProjectedTree:
    """kd-tree over the projections of some points.  Leaves are runs of the points' order, each with its box."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projected: np.ndarray, leaf: int = LEAF):
        runs, todo = [], [np.arange(len(ids))]
        while todo:
            rows = todo.pop()
            low, high = projected[rows].min(axis=0), projected[rows].max(axis=0)
            axis = int(np.argmax(high - low))
            if len(rows) <= leaf or high[axis] == low[axis]:
                runs.append((rows, low, high))
                continue
            order = rows[np.argsort(projected[rows, axis], kind="stable")]
            todo += [order[:len(order) // 2], order[len(order) // 2:]]
        order = np.concatenate([r[0] for r in runs])
        self.low, self.high = np.stack([r[1] for r in runs]), np.stack([r[2] for r in runs])
        self.start = np.concatenate(([0], np.cumsum([len(r[0]) for r in runs])))
        self.ids, self.vectors = ids[order], vectors[order]
        self.unit = self.vectors / np.linalg.norm(self.vectors, axis=1, keepdims=True)

    def nearest(self, query_id: int, query: np.ndarray, at: np.ndarray, k: int, threshold: float, bound: float = math.inf) -> list[tuple[float, int]]:
        """The k best (cosine, id) found, best first; ``bound`` is a squared distance known to be reached by k others.

        Leaves are verified by increasing distance of their boxes, some more at a time, until the next is beyond ``threshold`` times the bound.
        """
        unit = query / np.linalg.norm(query)
        gap = np.maximum(0.0, np.maximum(self.low - at, at - self.high))
        far = (gap * gap).sum(axis=1)
        leaves = np.argsort(far, kind="stable")
        far, rows, scores, first, step = far[leaves], np.zeros(0, dtype=np.int64), np.zeros(0), 0, 1
        while first < len(leaves) and far[first] <= threshold * bound:
            last = first + int(np.searchsorted(far[first:first + step], threshold * bound, side="right"))
            for leaf in leaves[first:last]:
                part = slice(self.start[leaf], self.start[leaf + 1])
                score = self.unit[part] @ unit
                keep = np.flatnonzero((score >= 1 - bound / 2 - ROUNDING) & (self.ids[part] != query_id))
                rows, scores = np.concatenate((rows, keep + part.start)), np.concatenate((scores, score[keep]))
            if len(rows) >= k:
                worst = np.partition(scores, len(scores) - k)[len(scores) - k]
                rows, scores = rows[scores >= worst - ROUNDING], scores[scores >= worst - ROUNDING]
                bound = min(bound, max(2 - 2 * worst, 0.0))
            first, step = last, 2 * step
        exact = cosines(query, self.vectors[rows])
        best = np.lexsort((self.ids[rows], -exact))[:k]
        return list(zip(exact[best].tolist(), self.ids[rows[best]].tolist()))


def usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def nearest_neighbours(points: DataFrame, queries: DataFrame, k: int = 5, dimensions: int = DIMENSIONS, confidence: float = CONFIDENCE,
                       cell_rows: int = CELL_ROWS, query_block: int = QUERY_BLOCK, sample: int = SAMPLE, seed: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` from (vec_id, embedding) of points and queries."""
    spark = points.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    clean = points.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    common = clean.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    if common is None:
        return spark.createDataFrame([], schema)
    length = common["length"]
    least_ids = Window.partitionBy("vector").orderBy("vec_id")
    kept = materialize(clean.withColumn("copy", F.row_number().over(least_ids)).filter(F.col("copy") <= k + 1).drop("copy"), "ann-points")
    asked = queries.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector")).distinct()

    threshold = chi_square_quantile(confidence, dimensions)
    usual = kept.filter(F.size("vector") == length)
    n = usual.count()
    fitted = np.array([r["vector"] for r in usual.orderBy(F.xxhash64("vec_id")).limit(sample).collect()])
    projected = project(fitted, dimensions, seed)
    # Cuts finer than the sample can place are not made: a leaf of the top keeps 16 sample points.
    depth = min(max(0, math.ceil(math.log2(n / cell_rows))), int(math.log2(max(1, len(fitted) / 16))))
    axis, value = top_cuts(projected, depth)
    model = spark.sparkContext.broadcast((axis, value, *cell_boxes(axis, value, dimensions)))

    def with_cell(batches):
        axis, value, _, _ = model.value
        for batch in batches:
            if len(batch):
                lengths = batch["vector"].map(len).to_numpy()
                cell = -lengths.astype(np.int64)
                at = np.flatnonzero(lengths == length)
                if len(at):
                    cell[at] = cell_of(project(np.stack(batch["vector"].to_numpy()[at]), dimensions, seed), axis, value)
                yield batch.assign(cell=cell)

    placed = materialize(kept.mapInPandas(with_cell, "vec_id long, vector array<double>, cell long"), "ann-placed")
    own = materialize(asked.mapInPandas(with_cell, "vec_id long, vector array<double>, cell long"), "ann-queries")
    parts = materialize(placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / (2 * cell_rows)).cast("int").alias("parts")), "ann-parts")

    def search(theirs: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(theirs) and len(mine):
            vectors = np.stack(theirs["vector"].to_numpy())
            tree = ProjectedTree(theirs["vec_id"].to_numpy(), vectors, project(vectors, dimensions, seed))
            bounds = mine["bound"].to_numpy() if "bound" in mine else np.full(len(mine), math.inf)
            asked = np.stack(mine["vector"].to_numpy())
            for query_id, query, at, bound in zip(mine["vec_id"], asked, project(asked, dimensions, seed), bounds):
                out += [(query_id, i, s) for s, i in tree.nearest(query_id, query, at, k, threshold, bound)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = "query_id long, vec_id long, score double"

    def searched(sent: DataFrame) -> DataFrame:
        """Each query in its cell.  A cell's points go to as many blocks as its queries make, its queries to all its parts."""
        blocks = sent.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("blocks"))
        theirs = placed.join(parts, "cell").join(blocks, "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts").cast("int")).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("parts", "blocks")
        mine = sent.join(parts, "cell").join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")).withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "blocks")
        keys = ["cell", "part", "block"]
        return theirs.groupBy(*keys).cogroup(mine.groupBy(*keys)).applyInPandas(search, found)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    near = materialize(searched(own).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank"), "ann-near")
    reached = near.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).select(
        F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.greatest(2 - 2 * F.col("s"), F.lit(0.0))).alias("bound"))

    def other_cells(batches):
        _, _, low, high = model.value
        for batch in batches:
            rows = []
            for i, (query, cell, bound) in enumerate(zip(batch["vector"], batch["cell"], batch["bound"].fillna(math.inf))):
                if cell >= 0:  # a vector of another length has its only cell
                    at = project(query[None], dimensions, seed)[0]
                    gap = np.maximum(0.0, np.maximum(low - at, at - high))
                    rows += [(i, c) for c in np.flatnonzero((gap * gap).sum(axis=1) <= threshold * bound) if c != cell]
            yield batch.iloc[[r[0] for r in rows]].assign(cell=[r[1] for r in rows])

    sent = materialize(own.join(reached, "vec_id", "left").select("vec_id", "vector", "cell", "bound").mapInPandas(
        other_cells, "vec_id long, vector array<double>, cell long, bound double").fillna(math.inf, ["bound"]), "ann-sent")
    ranked = near.union(searched(sent)).distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
