"""Nearest neighbours by inner product: a vantage-point tree per shard.

With one coordinate added, sqrt(M^2 - |x|^2) for M the largest length, all vectors have length M and the largest inner
product is the smallest Euclidean distance, so the triangle inequality holds. A node keeps the range of distances from
its vantage point to each half of its points. A query leaves out a half whose least possible distance is above
factor * (distance of its k-th best so far): factor 1 is exact, smaller factors prune more and may miss some. Queries go
down the tree in batches, each to its nearer half first.

Leaves compare products, not lifted distances, whose differences a single long vector would round away. A product is trusted
within a bound on its rounding only: every point that may be among the k best by exact products is found and ranked by them,
so ties go to the smaller id however many there are.

Shards are places: a vantage-point tree of a bounded sample parts all points into at most SHARDS leaves, and every point is
routed to its leaf. A leaf of more than SHARD_ROWS points is dealt by hash to several trees, so no place or label is hot.
Each tree is built once and saved. A query first searches the trees of its own leaf; the k-th best score there is its bound.
Then it visits the other leaves whose range of distances, on any node of their path, lies within factor * (distance of that
bound), and starts there with the bound that it has. Queries of a leaf are dealt in blocks of about BLOCK_ROWS, and a
tree meets each block once. Points that lie alike in all directions can't be pruned at factor 1, and then all trees meet all
blocks: that is the exact search's price, and a smaller factor's gain.

Equal vectors are one point with its k + 1 smallest ids, as no more of them can be among k nearest.

Cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an id;
vectors are compared with those of their own length only; an id's repeated rows count once (of different vectors of an id
that is a query, the one that comes first in bytes is the query); ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, small_batches, table
from .vectors import usable

K = 20
FACTOR = 1.0
SHARD_ROWS, BLOCK_ROWS = 8192, 4096
#: Points that the shards' places are found on, and shards, at most.
SAMPLE, SHARDS = 8192, 2048
LEAF = 256
#: Queries whose candidates are held at once.
AT_ONCE = 512
#: Rounding of a sum of n products, as a share of both lengths' product and n.
ROUNDING = 4 * 2.0**-53


class VPTree:
    """points: rows of equal length M."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.points, self.leaf = points, leaf
        self.root = self._build(np.arange(len(points)), 0)

    def _build(self, rows: np.ndarray, depth: int):
        if len(rows) <= self.leaf:
            return rows
        rough = self.points[rows] - self.points[rows].mean(0)
        vantage = self.points[rows[int(np.argmax((rough * rough).sum(1)))]]  # at the rim, distances differ most
        d = np.sqrt(np.maximum(((self.points[rows] - vantage) ** 2).sum(1), 0))
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        if d[order[0]] == d[order[-1]]:
            return rows
        sides = []
        for part in (order[:half], order[half:]):
            sides.append((d[part].min(), d[part].max(), self._build(rows[part], depth + 1)))
        return vantage, sides

    def search(self, queries: np.ndarray, keep: int, factor: float = FACTOR) -> tuple[np.ndarray, np.ndarray, int]:
        """For each query the keep nearest points (-1: none) and their squared distances; the number of distances to points."""
        self._start(queries, keep, factor)
        self._visit(self.root, np.arange(len(queries)))
        best = self._qq[:, None] + self._rim2 - 2 * self._best
        return self._at, np.where(self._at >= 0, best, np.inf), self._done

    def candidates(self, queries: np.ndarray, keep: int, factor: float = FACTOR, floor: np.ndarray | None = None) -> list[np.ndarray]:
        """For each query all points whose product isn't below the keep-th best (nor floor) by more than rounding, and some that were better than the best known when they were met."""
        self._start(queries, keep, factor, floor)
        self._found = ([], [])
        self._visit(self.root, np.arange(len(queries)))
        rows, at = (np.concatenate([np.array([], dtype=np.int64), *x]) for x in self._found)
        order = np.argsort(rows, kind="stable")
        return np.split(at[order], np.searchsorted(rows[order], np.arange(1, len(queries))))

    def _start(self, queries: np.ndarray, keep: int, factor: float, floor: np.ndarray | None = None) -> None:
        """queries have 0 as added coordinate. error times a point's own length bounds how far two sums of the same products lie apart."""
        self._q, self._qq = queries, (queries * queries).sum(1)
        self._rim2 = float((self.points * self.points).sum(1).max(initial=0))
        self._own = np.sqrt((self.points[:, :-1] ** 2).sum(1))
        self._error = self.points.shape[1] * ROUNDING * np.sqrt(self._qq)
        # of squared distances and of distances
        self._slack2, self._slack = (64 * self.points.shape[1] * ROUNDING * x for x in (self._qq + self._rim2, np.sqrt(self._qq) + np.sqrt(self._rim2)))
        self._best, self._at = np.full((len(queries), keep), -np.inf), np.full((len(queries), keep), -1, dtype=np.int64)
        self._factor, self._done, self._found = factor, 0, None
        self._floor = np.full(len(queries), -np.inf) if floor is None else floor - self._error * self._own.max(initial=0)

    def _least(self, asked: np.ndarray) -> np.ndarray:
        """Products below this can't be wanted."""
        return np.maximum(self._best[asked].min(1), self._floor[asked])

    def _visit(self, node, asked: np.ndarray) -> None:
        if not len(asked):
            return
        if isinstance(node, np.ndarray):
            p = self._q[asked] @ self.points[node].T
            off = self._error[asked][:, None] * self._own[node][None, :]
            self._done += p.size
            both = np.concatenate([self._best[asked], p - off], axis=1)  # what the exact product is at least
            ids = np.concatenate([self._at[asked], np.broadcast_to(node, p.shape)], axis=1)
            keep = self._best.shape[1]
            first = np.argpartition(-both, keep - 1, axis=1)[:, :keep]
            self._best[asked], self._at[asked] = np.take_along_axis(both, first, 1), np.take_along_axis(ids, first, 1)
            if self._found is not None:  # the bound only rises, so what is below it now is below it at the end
                row, column = np.nonzero(p + off >= self._least(asked)[:, None])
                self._found[0].append(asked[row])
                self._found[1].append(node[column])
            return
        vantage, sides = node
        d = np.sqrt(np.maximum(((self._q[asked] - vantage) ** 2).sum(1), 0))
        bounds = [np.maximum(np.maximum(lo - d, d - hi), 0) for lo, hi, _ in sides]
        first_inner = bounds[0] <= bounds[1]
        for wave in (0, 1):
            for side in (0, 1):
                mine = np.flatnonzero(first_inner if side == wave else ~first_inner)
                if len(mine):
                    rows = asked[mine]
                    far = np.sqrt(np.maximum(self._qq[rows] + self._rim2 - 2 * self._least(rows) + self._slack2[rows], 0))
                    self._visit(sides[side][2], rows[bounds[side][mine] <= self._factor * far + self._slack[rows]])


@dataclass
class Places:
    """The tree that parts space into shards. nodes: vantage points; below: for each node its cut and both children (a shard as -1 - number)."""

    nodes: np.ndarray
    below: list[tuple[float, int, int]]
    paths: list[list[int]]

    @staticmethod
    def of(sample: np.ndarray, shards: int) -> Places:
        nodes, below, paths = [], [], []

        def part(rows: np.ndarray, wanted: int, path: list[int]) -> int:
            if wanted > 1 and len(rows) > 1:
                rough = sample[rows] - sample[rows].mean(0)
                vantage = sample[rows[int(np.argmax((rough * rough).sum(1)))]]
                d = np.sqrt(((sample[rows] - vantage) ** 2).sum(1))
                cut = float(np.median(d))
                near = d <= cut
                if not near.all():
                    at = len(nodes)
                    nodes.append(vantage)
                    below.append((cut, 0, 0))
                    below[at] = (cut, part(rows[near], wanted // 2, [*path, at]), part(rows[~near], wanted - wanted // 2, [*path, at]))
                    return at
            paths.append(path)
            return -len(paths)

        part(np.arange(len(sample)), shards, [])
        return Places(np.array(nodes).reshape(len(nodes), sample.shape[1]), below, paths)

    def distances(self, points: np.ndarray, node: int) -> np.ndarray:
        return np.sqrt(((points - self.nodes[node]) ** 2).sum(1))

    def shard_of(self, points: np.ndarray) -> np.ndarray:
        out, todo = np.zeros(len(points), dtype=np.int64), [(0, np.arange(len(points)))] if self.below else []
        while todo:
            node, rows = todo.pop()
            cut, left, right = self.below[node]
            near = self.distances(points[rows], node) <= cut
            for child, mine in ((left, rows[near]), (right, rows[~near])):
                if child < 0:
                    out[mine] = -1 - child
                elif len(mine):
                    todo.append((child, mine))
        return out

    def within(self, queries: np.ndarray, radius: np.ndarray, ranges: dict[int, tuple[list[float], list[float]]]) -> list[np.ndarray]:
        """For each query the shards that may hold a point nearer than its radius. ranges: for each shard least and largest distance to the nodes of its path."""
        d = np.stack([self.distances(queries, node) for node in range(len(self.nodes))], axis=1) if len(self.nodes) else np.zeros((len(queries), 0))
        open_ = np.zeros((len(queries), len(self.paths)), dtype=bool)
        for shard, (low, high) in ranges.items():
            on = np.ones(len(queries), dtype=bool)
            for node, lo, hi in zip(self.paths[shard], low, high, strict=True):
                on &= np.maximum(lo - d[:, node], d[:, node] - hi) <= radius
            open_[:, shard] = on
        return [np.flatnonzero(row) for row in open_]


def _doubles(vectors) -> np.ndarray:
    return np.array([np.frombuffer(v, dtype="<f8") for v in vectors])


def _lifted(points: np.ndarray, longest: float) -> np.ndarray:
    return np.column_stack([points, np.sqrt(np.maximum(longest - (points * points).sum(1), 0))])


def tree_search(tree: VPTree, ids: list[list[int]], queries: pd.DataFrame, k: int, factor: float) -> pd.DataFrame:
    """The k nearest of a tree's points for each query: query_id, vector and floor (a score that k points are known to reach, or null) are its columns."""
    found: tuple[list, list, list] = ([], [], [])
    asked, names = _doubles(queries["vector"]), queries["query_id"].tolist()
    floor = queries["floor"].to_numpy(dtype=float)
    floor = np.where(np.isnan(floor), -np.inf, floor)
    lifted, keep = np.column_stack([asked, np.zeros(len(asked))]), min(len(tree.points), k + 1)
    for a in range(0, len(asked), AT_ONCE):
        near = tree.candidates(lifted[a : a + AT_ONCE], keep, factor, floor[a : a + AT_ONCE])
        for own, vector, least, hits in zip(names[a:], asked[a:], floor[a:], near, strict=False):
            scores = np.cumsum(tree.points[hits, :-1] * vector, axis=1)[:, -1] if len(hits) else np.array([])  # component after component, as a plain loop adds
            best = sorted((-s, i) for h, s in zip(hits, scores.tolist(), strict=True) if s >= least for i in ids[h] if i != own)[:k]
            found[0].extend([own] * len(best))
            found[1].extend(i for _, i in best)
            found[2].extend(-s for s, _ in best)
    return pd.DataFrame({"query_id": np.array(found[0], dtype=np.int64), "vec_id": np.array(found[1], dtype=np.int64), "score": np.array(found[2], dtype=float)})


def nearest(rows: DataFrame, is_query, k: int = K, factor: float = FACTOR, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k rows nearest to each row that meets is_query, a condition on its id."""
    small_batches(rows.sparkSession)

    def doubles(parts):
        for pdf in parts:
            arrays = [np.asarray(v, dtype="<f8") + 0.0 for v in pdf["v"]]  # -0.0 becomes 0.0
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "dim": [len(a) for a in arrays], "norm2": [float((a * a).sum()) for a in arrays], "vector": [a.tobytes() for a in arrays]})

    good = rows.where(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    good = saved(good.mapInPandas(doubles, "vec_id long, dim int, norm2 double, vector binary"))
    # of equal vectors the k + 1 smallest ids; the limit works before the shuffle too, so a hot vector sends few rows a task
    first = good.select("vec_id", "dim", "norm2", "vector", F.xxhash64("vector").alias("hash")).distinct()
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("hash", "vector").orderBy("vec_id"))).where(F.col("rank") <= k + 1)
    points = saved(first.groupBy("hash", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("dim").alias("dim"), F.first("norm2").alias("norm2")))
    facts = points.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("longest")).orderBy(F.desc("n"), "dim").limit(1).first()
    if facts is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    main, longest = facts["dim"], points.agg(F.max("norm2")).first()[0]
    sample = points.where(F.col("dim") == main).orderBy("hash", "vector").limit(SAMPLE).select("vector").toPandas()["vector"]
    places = Places.of(_lifted(_doubles(sample), longest), min(SHARDS, -(-facts["n"] // SHARD_ROWS)))

    def routed(parts):
        """The shard of each vector; vectors of rare lengths have one of their own, -1."""
        for pdf in parts:
            shard = np.full(len(pdf), -1, dtype=np.int64)
            if len(mine := np.flatnonzero(pdf["dim"].to_numpy() == main)):
                shard[mine] = places.shard_of(_lifted(_doubles(pdf["vector"].iloc[mine]), longest))
            yield pdf.assign(shard=shard)

    placed = saved(points.select("hash", "vector", "ids", "dim").mapInPandas(routed, "hash long, vector binary, ids array<long>, dim int, shard int"))
    deal = lambda df, most, out: df.join(df.groupBy("dim", "shard").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("parts")), ["dim", "shard"]).withColumn(out, F.pmod(F.xxhash64("hash", F.lit(out)), "parts").cast("int"))

    def planted(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        """A tree as bytes, and its points' least and largest distances to the nodes of its shard's path."""
        lifted = _lifted(_doubles(pdf["vector"]), longest)
        path = places.paths[key[1]] if key[1] >= 0 else []
        d = [places.distances(lifted, node) for node in path]
        tree = pickle.dumps((VPTree(lifted), [[int(i) for i in x] for x in pdf["ids"]]), protocol=5)
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "tree": [key[2]], "bytes": [tree], "low": [[x.min() for x in d]], "high": [[x.max() for x in d]]})

    trees = saved(deal(placed, SHARD_ROWS, "tree").groupBy("dim", "shard", "tree").applyInPandas(planted, "dim int, shard int, tree int, bytes binary, low array<double>, high array<double>"))
    ends = trees.select("shard", F.posexplode(F.arrays_zip("low", "high")).alias("at", "x")).groupBy("shard", "at").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    ranges: dict[int, tuple[list[float], list[float]]] = {r["shard"]: ([], []) for r in trees.select("shard").distinct().where("shard >= 0").collect()}  # at most SHARDS
    for r in ends.orderBy("shard", "at").collect():
        ranges[r["shard"]][0].append(r["low"])
        ranges[r["shard"]][1].append(r["high"])

    def found(asked: DataFrame) -> DataFrame:
        """asked: dim, shard, query_id, vector, floor."""

        def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({"query_id": np.array([], dtype=np.int64), "vec_id": np.array([], dtype=np.int64), "score": np.array([], dtype=float)})
            return tree_search(*pickle.loads(right["bytes"].iloc[0]), left, k, factor)

        blocks = deal(asked.withColumn("hash", F.col("query_id")), BLOCK_ROWS, "block")
        of_tree = trees.select("dim", "shard", "tree", "bytes")
        dealt = blocks.select("dim", "shard", "block").distinct().join(of_tree, ["dim", "shard"]).select("dim", "shard", "tree", "block", "bytes").toDF("its_dim", "its_shard", "its_tree", "its_block", "bytes")
        queries = blocks.join(trees.select("dim", "shard", "tree"), ["dim", "shard"]).select("dim", "shard", "tree", "block", "query_id", "vector", "floor")
        keys = ["dim", "shard", "tree", "block"]
        return saved(queries.groupBy(*keys).cogroup(dealt.groupBy(*[f"its_{x}" for x in keys])).applyInPandas(one, "query_id long, vec_id long, score double"))

    # an id's vector: of several the one that comes first in bytes
    queries = good.where(is_query(F.col("vec_id"))).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    queries = saved(queries.withColumn("dim", (F.length("vector") / 8).cast("int")).mapInPandas(routed, "query_id long, vector binary, dim int, shard int"))
    at_home = found(queries.withColumn("floor", F.lit(None).cast("double")))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = at_home.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    floors = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))

    ranked = lambda df: df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    if len(places.paths) == 1:
        return ranked(at_home)

    def onward(parts):
        """The other shards that a query must visit."""
        for pdf in parts:
            pdf = pdf[pdf["dim"] == main]
            if len(pdf):
                vectors = _doubles(pdf["vector"])
                square, floor = (vectors * vectors).sum(1), pdf["floor"].to_numpy(dtype=float)
                slack = 1e-7 * (square + longest)  # far above rounding
                radius = np.where(np.isnan(floor), np.inf, factor * np.sqrt(np.maximum(square + longest - 2 * np.where(np.isnan(floor), 0, floor) + slack, 0)) + np.sqrt(slack) * 1e-3)
                others = [x[x != own] for x, own in zip(places.within(np.column_stack([vectors, np.zeros(len(vectors))]), radius, ranges), pdf["shard"], strict=True)]
                for at in range(0, len(pdf), 64):  # a query's vector is repeated for each shard that it visits
                    part = pdf.iloc[at : at + 64].iloc[np.repeat(np.arange(len(others[at : at + 64])), [len(x) for x in others[at : at + 64]])]
                    yield part.assign(shard=np.concatenate(others[at : at + 64]))[["dim", "shard", "query_id", "vector", "floor"]]

    away = found(queries.join(floors, "query_id", "left").mapInPandas(onward, "dim int, shard int, query_id long, vector binary, floor double"))
    return ranked(best.select("query_id", "vec_id", "score").union(away))


def op7_vp_search(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)
