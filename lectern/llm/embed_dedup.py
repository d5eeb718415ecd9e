"""Near-duplicate vectors by an inverted multi-index.

Each half of a normalised vector has a codebook of its own; the pair of nearest codes is the cell of a product grid that
the vector is listed in. A vector then visits cells in the order of the least distance that their vectors can have: the
sum, over halves, of the squared distance to the bisector between its own code and the cell's. This multi-sequence
traversal stops at reach * (squared distance that the threshold allows). At a reach of 1 no cell that could hold a link is
left out, so recall is whole; for a lower target the reach is the one at which a sample's links, found by brute force, have
that recall.

Vectors aren't copied to the cells they visit: the vectors of a label, in the order of their cells, are cut into blocks of
about BLOCK, a block walks the cells that any of its vectors visits, and blocks meet once for each two of them. There two
cells' vectors are multiplied only if each visits the cell of the other, which is a small part of a block's pairs. Pairs met are verified in
double precision.

Equal vectors with one label are one class; links are counted with the classes' sizes, and two blocks that meet give each of
their vectors a count and the smallest class that it meets there through links, never the pairs. A cell with a third of all
rows is many blocks.

Cases: vectors that are null, zero, or hold null or non-finite components, and those with a null label or id, link with
nothing and are kept; vectors of different length don't link; repeated rows of an id count once as links and give a
result row each; an empty table gives an empty result. The codebooks come from the SAMPLE classes with the least hash of
their id; every row is indexed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, small_batches, table
from .graph import components
from .vectors import usable

THRESHOLD = 0.98
#: The recall of links that the traversal must reach, and vectors of the sample that it is measured with, where it is below 1.
RECALL, MEASURED = 1.0, 2_000
#: Rows that the codebooks are fitted on, vectors in a block, and vectors a cell should hold when codes are even.
SAMPLE, BLOCK, CELL = 20_000, 2048, 256
#: Components in a block, so that long vectors make small blocks.
COMPONENTS = 1 << 18
#: Codes of a half, at most (so up to 268 million vectors a cell holds CELL; beyond, cells grow); fits of k-means.
MOST_CODES, FITS = 1024, 12


def fit_codes(points: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """k-means, started at random points."""
    rng = np.random.default_rng(seed)
    codes = points[np.sort(rng.choice(len(points), min(k, len(points)), replace=False))]
    for _ in range(FITS):
        at = np.argmin((codes * codes).sum(1) - 2 * points @ codes.T, axis=1)
        sums, counts = np.zeros_like(codes), np.bincount(at, minlength=len(codes))
        np.add.at(sums, at, points)
        codes = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], codes)
    return np.unique(codes, axis=0)


def half_bounds(points: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest code of each point, and for each code the least squared distance from the point to what is nearest to that code."""
    d = (points * points).sum(1)[:, None] + (codes * codes).sum(1) - 2 * points @ codes.T
    own = np.argmin(d, axis=1)
    gap = np.sqrt(np.maximum((codes * codes).sum(1)[:, None] + (codes * codes).sum(1) - 2 * codes @ codes.T, 0))[own]
    over = np.maximum(d - d[np.arange(len(points)), own][:, None], 0)
    return own, np.where(gap > 1e-6, over / np.maximum(2 * gap, 1e-6), 0) ** 2


def traverse(bounds1: np.ndarray, bounds2: np.ndarray, most: float) -> Iterator[tuple[int, int]]:
    """Cells (i, j) of one vector by rising bound, up to most: a walk along two sorted sequences."""
    first, second = np.argsort(bounds1, kind="stable"), np.argsort(bounds2, kind="stable")
    sorted2 = bounds2[second]
    for i in first:
        if bounds1[i] > most:
            return
        for j in second[: np.searchsorted(sorted2, most - bounds1[i], "right")]:
            yield int(i), int(j)


def cells_of(points: np.ndarray, books: tuple[np.ndarray, np.ndarray], most: float) -> list[int]:
    """The cells that any of the points visits."""
    cut = books[0].shape[1]
    (_, low1), (_, low2) = half_bounds(points[:, :cut], books[0]), half_bounds(points[:, cut:], books[1])
    return [i * MOST_CODES + j for i, j in traverse(low1.min(0), low2.min(0), most) if (low1[:, i] + low2[:, j]).min() <= most]


def visits(points: np.ndarray, cells: np.ndarray, books: tuple[np.ndarray, np.ndarray] | None, most: float) -> np.ndarray:
    """Whether each point visits each cell."""
    if books is None:
        return np.ones((len(points), len(cells)), dtype=bool)
    cut = books[0].shape[1]
    (_, low1), (_, low2) = half_bounds(points[:, :cut], books[0]), half_bounds(points[:, cut:], books[1])
    return low1[:, cells // MOST_CODES] + low2[:, cells % MOST_CODES] <= most


def reach_for(points: np.ndarray, labels: np.ndarray, books: tuple[np.ndarray, np.ndarray], threshold: float, recall: float) -> float:
    """The reach at which links of the first MEASURED points are found with a recall, by brute force over the sample."""
    if recall >= 1:
        return 1.0
    few, cut = points[:MEASURED], books[0].shape[1]
    (own1, low1), (own2, low2) = (half_bounds(points[:, part], book) for part, book in ((slice(None, cut), books[0]), (slice(cut, None), books[1])))
    i, j = np.nonzero((few @ points.T >= threshold) & (labels[: len(few), None] == labels))
    i, j = i[i != j], j[i != j]
    needed = np.maximum(low1[i, own1[j]] + low2[i, own2[j]], low1[j, own1[i]] + low2[j, own2[i]]) / (2 - 2 * threshold)
    return float(min(np.quantile(needed, recall), 1.0)) if len(needed) else 1.0


class Block:
    """Vectors in the order of their cells."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, cells: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.copies, self.vectors = ids, copies, vectors
        self.norms = np.sqrt((vectors * vectors).sum(1))
        self.cells, first = np.unique(cells, return_index=True)
        self.runs = list(zip(first, [*first[1:], len(ids)], strict=True))


def met_pairs(left: Block, right: Block, threshold: float, books: tuple[np.ndarray, np.ndarray] | None, most: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of linked vectors (left, right), both ways round in one block, and the number of products computed."""
    unit = lambda b: b.vectors / b.norms[:, None]
    of_left = visits(unit(left), right.cells, books, most)
    of_right = of_left if left is right else visits(unit(right), left.cells, books, most)
    out_i, out_j, products = [], [], 0
    for p, (a, b) in enumerate(left.runs):
        for q in range(p if left is right else 0, len(right.runs)):
            c, d = right.runs[q]
            i, j = a + np.flatnonzero(of_left[a:b, q]), c + np.flatnonzero(of_right[c:d, p])
            if not len(i) or not len(j):
                continue
            same = left is right and p == q
            products += len(i) * (len(i) - 1) // 2 if same else len(i) * len(j)
            cos = (left.vectors[i] @ right.vectors[j].T) / left.norms[i][:, None] / right.norms[j]
            x, y = np.nonzero(cos >= threshold)
            out_i.append(i[x])
            out_j.append(j[y])
            if left is right and not same:
                out_i.append(j[y])
                out_j.append(i[x])
    none = np.array([], dtype=np.int64)
    return np.concatenate([none, *out_i]), np.concatenate([none, *out_j]), products


def block_links(left: Block, right: Block, threshold: float, books: tuple[np.ndarray, np.ndarray] | None = None, most: float = 0.0) -> pd.DataFrame:
    """class_id, root, links of two blocks, or of one given twice: for each class that links here, the smallest class joined to it by links here, and the links found. One more row, without a class, has the products that were computed."""
    i, j, products = met_pairs(left, right, threshold, books, most)
    apart = left.ids[i] != right.ids[j]
    i, j = i[apart], j[apart]
    links_a = np.bincount(i, weights=right.copies[j].astype(float), minlength=len(left.ids)).astype(np.int64)
    links_b = np.bincount(j, weights=left.copies[i].astype(float), minlength=len(right.ids)).astype(np.int64)
    if left is right:
        links_b[:] = 0  # counted as links_a
    la, lb = left.ids.copy(), right.ids.copy()
    while len(i):
        before = la.copy(), lb.copy()
        np.minimum.at(la, i, lb[j])
        np.minimum.at(lb, j, la[i])
        if np.array_equal(before[0], la) and np.array_equal(before[1], lb):
            break
    u, v = np.unique(i), np.unique(j)
    found = {"class_id": np.concatenate([left.ids[u], right.ids[v]]), "root": np.concatenate([la[u], lb[v]]), "links": np.concatenate([links_a[u], links_b[v]])}
    return pd.concat([pd.DataFrame(found).astype("Int64"), pd.DataFrame({"class_id": [None], "root": [None], "links": [products]}, dtype="Int64")])


def _packed(vector: np.ndarray) -> bytes:
    """Single precision where that is exact; the first byte tells."""
    single = vector.astype("<f4")
    return b"s" + single.tobytes() if np.array_equal(single.astype("<f8"), vector) else b"d" + vector.tobytes()


def _doubles(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<f4" if data[:1] == b"s" else "<f8", offset=1).astype("<f8")


def _classes(rows: DataFrame) -> DataFrame:
    def coded(parts):
        for pdf in parts:
            vectors = [np.asarray(v, dtype="<f8") + 0.0 for v in pdf["v"]]  # -0.0 becomes 0.0
            yield pd.DataFrame({
                "vec_id": pdf["vec_id"], "label": pdf["label"], "dim": [len(v) for v in vectors], "vector": [_packed(v) for v in vectors],
                "class_key": [hashlib.blake2b(v.tobytes() + str(x).encode(), digest_size=16).digest() for v, x in zip(vectors, pdf["label"], strict=True)],
            })

    return rows.mapInPandas(coded, "vec_id long, label string, dim int, vector binary, class_key binary")


def _found(classes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """What all meetings of blocks give, as block_links does."""
    n = classes.count()
    dim = (classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first() or {"dim": 0})["dim"]
    sample = classes.where(F.col("dim") == dim).orderBy(F.xxhash64("class_id"), "class_id").limit(SAMPLE).select("vector", "label").toPandas()
    codes = int(np.clip(np.sqrt(n / CELL), 2, MOST_CODES))
    cut = dim // 2
    most, books = 2 - 2 * threshold + 1e-9, None
    if len(sample) and cut:
        points = np.stack([_doubles(v) for v in sample["vector"]])
        points = points / np.sqrt((points * points).sum(1))[:, None]
        books = tuple(fit_codes(half, codes) for half in (points[:, :cut], points[:, cut:]))
        most = reach_for(points, sample["label"].to_numpy(), books, threshold, recall) * (2 - 2 * threshold) + 1e-9

    def unit(vectors) -> np.ndarray:
        points = np.stack([_doubles(v) for v in vectors])
        return points / np.sqrt((points * points).sum(1))[:, None]

    def homes(parts):
        """The cell that lists each class. Rare lengths have one cell."""
        for pdf in parts:
            cells = np.zeros(len(pdf), dtype=np.int64)
            if books is not None and len(mine := np.flatnonzero(pdf["dim"].to_numpy() == dim)):
                points = unit(pdf["vector"].iloc[mine])
                cells[mine] = half_bounds(points[:, :cut], books[0])[0] * MOST_CODES + half_bounds(points[:, cut:], books[1])[0]
            yield pdf.assign(cell=cells)

    group, cell = ["label", "dim"], ["label", "dim", "cell"]
    placed = saved(classes.select("class_id", "copies", "label", "dim", "vector").mapInPandas(homes, "class_id long, copies long, label string, dim int, vector binary, cell int"))
    before = Window.partitionBy(*group).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # over cells, not rows
    cells = saved(placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).withColumns({"first": F.coalesce(F.sum("n").over(before), F.lit(0)), "all_": F.sum("n").over(Window.partitionBy(*group))}))
    size = F.least(F.lit(BLOCK), F.greatest(F.lit(16), (F.lit(COMPONENTS) / F.col("dim")).cast("int")), F.greatest(F.lit(16), F.ceil(F.col("all_") / 3)))
    block = lambda place: F.floor(place / size).cast("int")

    def gathered(key, pdf: pd.DataFrame) -> pd.DataFrame:
        """A block as one row, in the order of cells, with the cells that it visits."""
        pdf = pdf.sort_values(["cell", "class_id"])
        vectors = np.stack([_doubles(v) for v in pdf["vector"]])
        found = [0] if books is None or key[1] != dim else cells_of(unit(pdf["vector"]), books, most)
        ids, copies, homes = (pdf[c].to_numpy("<i8").tobytes() for c in ("class_id", "copies", "cell"))
        return pd.DataFrame({"label": [key[0]], "dim": [key[1]], "block": [key[2]], "ids": [ids], "copies": [copies], "homes": [homes], "vectors": [_packed(vectors.ravel())], "cells": [found]})

    rows_at = placed.join(cells, cell).withColumn("block", block(F.col("first") + F.pmod(F.xxhash64("class_id"), "n")))
    blocks = saved(rows_at.groupBy(*group, "block").applyInPandas(gathered, "label string, dim int, block int, ids binary, copies binary, homes binary, vectors binary, cells array<int>"))
    seen = blocks.select(*group, "block", F.explode("cells").alias("cell")).join(cells, cell)
    seen = seen.select(*group, "block", F.explode(F.sequence(block(F.col("first")), block(F.col("first") + F.col("n") - 1))).alias("other"))
    pairs = seen.select(*group, F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b")).distinct()
    side = lambda x: blocks.select(*group, F.col("block").alias(x), F.struct("ids", "copies", "homes", "vectors").alias(f"{x}_"))
    met = pairs.join(side("a"), [*group, "a"]).join(side("b"), [*group, "b"])
    met = met.select("dim", "a", "b", *[F.col(f"{x}_")[c].alias(f"{x}_{c}") for x in "ab" for c in ("ids", "copies", "homes", "vectors")])

    def one(parts):
        whole = lambda x: np.frombuffer(x, "<i8")
        for pdf in parts:
            for r in pdf.itertuples():
                left = Block(whole(r.a_ids), whole(r.a_copies), whole(r.a_homes), _doubles(r.a_vectors).reshape(-1, r.dim))
                right = left if r.a == r.b else Block(whole(r.b_ids), whole(r.b_copies), whole(r.b_homes), _doubles(r.b_vectors).reshape(-1, r.dim))
                yield block_links(left, right, threshold, books if r.dim == dim else None, most)

    return saved(met.mapInPandas(one, "class_id long, root long, links long"))


def _prepared(rows: DataFrame, vec_id: str, vector: str, label: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """vec_id and class of usable vectors, the classes, and the rest's vec_id."""
    small_batches(rows.sparkSession)  # two blocks make a large row
    ids = F.col(vec_id).cast("long")
    valid = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & usable(F.col(vector))
    coded = saved(_classes(rows.where(valid).select(ids.alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))))
    classes = coded.groupBy("class_key").agg(F.min("vec_id").alias("class_id"), F.countDistinct("vec_id").alias("copies"), *[F.first(c).alias(c) for c in ("label", "dim", "vector")])
    return coded, saved(classes), rows.where(~valid).select(ids.alias("vec_id"))


def products_computed(rows: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> float:
    """Inner products that are computed, as a share of all pairs of different vectors with one label."""
    _, classes, _ = _prepared(rows, vec_id, vector, label)
    n = F.col("count").cast("double")
    pairs = classes.groupBy("label", "dim").count().agg(F.sum(n * (n - 1) / 2)).first()[0] or 1.0
    return _found(classes, threshold, recall).where("class_id IS NULL").agg(F.sum("links")).first()[0] / pairs


def linked(rows: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    coded, classes, rest = _prepared(rows, vec_id, vector, label)
    found = _found(classes, threshold, recall).where("class_id IS NOT NULL")
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    joined = components(found, "class_id", "root").withColumnRenamed("node", "class_id")
    about = classes.join(links, "class_id", "left").join(joined, "class_id", "left")
    about = about.select("class_key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "class_id").alias("component_id"))
    of_rows = coded.select("vec_id", "class_key").join(about, "class_key").select("vec_id", "n_links", "component_id")
    rest = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return of_rows.union(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op6_imi_dedup(spark, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "embeddings"))
