"""Sharding by a k-d tree over metadata.

A node with k leaves is cut along its widest dimension where k // 2 of its k shares of the bytes lie before the cut: a
weighted median, found exactly by histograms that executors count over all rows and that the driver sums and refines, a
bounded number of bins a node; the last few rows around a cut (FETCHED at most) come to the driver. Every row is a point of a grid: the dimension's code, then bits of the text's hash, then
bits of the id's hash, so a cut exists at any weight even if all rows share one code. Equal texts stay together in one
shard unless keeping a group whole would miss the share by more than GROUP_SLACK of a shard's bytes; then the ids' bits
divide it.

Cases: a null text has size 16 and crc32 0, the values of an empty one, and goes with empty texts; null ids rank first
within a shard; repeated rows take slots of their own; an empty table gives an empty result, and with fewer groups than
shards some shards stay empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import positions, salt_of, saved, table

SHARDS = 40
#: Bins of a histogram, and rows of a bin that are few enough for the driver to find the cut among them.
BINS, FETCHED = 4096, 2000
#: A cut is good enough if it misses its share by so much of a shard's bytes.
SLACK, GROUP_SLACK = 0.002, 0.02
#: Bits of a point: dimension, text, id.
TEXT_BITS, ID_BITS = 23, 16
LOW = TEXT_BITS + ID_BITS
CODE_BITS = 24


class Tree:
    """Nodes as arrays: dimension (-1: leaf), cut, left child (the right one follows it), leaves below, first leaf."""

    def __init__(self, shards: int) -> None:
        self.dim, self.cut, self.left, self.leaves, self.first = [-1], [0], [-1], [shards], [0]

    def split(self, node: int, dim: int, cut: int) -> None:
        k = self.leaves[node]
        self.dim[node], self.cut[node], self.left[node] = dim, cut, len(self.dim)
        for leaves, first in ((k // 2, self.first[node]), (k - k // 2, self.first[node] + k // 2)):
            for column, value in ((self.dim, -1), (self.cut, 0), (self.left, -1), (self.leaves, leaves), (self.first, first)):
                column.append(value)

    def node_of(self, codes: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The lowest node for each row; codes has a row for each dimension."""
        dim, cut, left = (np.array(x, dtype=np.int64) for x in (self.dim, self.cut, self.left))
        node = np.zeros(len(low), dtype=np.int64)
        while len(on := np.flatnonzero(dim[node] >= 0)):
            at = node[on]
            node[on] = left[at] + ((codes[dim[at], on] << LOW | low[on]) >= cut[at])
        return node


def _arrays(pdf: pd.DataFrame, dims: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.stack([pdf[d].to_numpy(np.int64) for d in dims]), pdf["low"].to_numpy(np.int64)


def _spreads(points: DataFrame, dims: list[str], tree: Tree) -> dict[int, list]:
    """For each undivided node: bytes, then the least and the largest code along each dimension."""

    def partial(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            codes, low = _arrays(pdf, dims)
            frame = pd.DataFrame({"node": tree.node_of(codes, low), "size": pdf["size"].to_numpy()} | {f"lo{i}": c for i, c in enumerate(codes)} | {f"hi{i}": c for i, c in enumerate(codes)})
            yield frame.groupby("node", as_index=False).agg({"size": "sum"} | {f"lo{i}": "min" for i in range(len(dims))} | {f"hi{i}": "max" for i in range(len(dims))})

    names = [f"{x}{i}" for i in range(len(dims)) for x in ("lo", "hi")]
    found = points.mapInPandas(partial, "node long, size long, " + ", ".join(f"{n} long" for n in names))
    rows = found.groupBy("node").agg(F.sum("size").alias("size"), *[(F.min if n[0] == "l" else F.max)(n).alias(n) for n in names]).collect()
    return {r["node"]: [r["size"], *[(r[f"lo{i}"], r[f"hi{i}"]) for i in range(len(dims))]] for r in rows}


def _histograms(points: DataFrame, dims: list[str], tree: Tree, asked: dict[int, tuple[int, int, int]]) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """Bytes and rows by bin for each asked node: (dimension, first point, width of a bin); BINS rows a node at most."""

    def partial(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, rows = ({n: np.zeros(BINS, dtype=np.int64) for n in asked} for _ in range(2))
        for pdf in parts:
            codes, low = _arrays(pdf, dims)
            node, size = tree.node_of(codes, low), pdf["size"].to_numpy(np.int64)
            for n, (dim, start, width) in asked.items():
                on = np.flatnonzero(node == n)
                at = ((codes[dim, on] << LOW | low[on]) - start) // width
                inside = (at >= 0) & (at < BINS)
                np.add.at(sums[n], at[inside], size[on][inside])
                np.add.at(rows[n], at[inside], 1)
        for n, s in sums.items():
            bins = np.flatnonzero(rows[n])
            yield pd.DataFrame({"node": np.full(len(bins), n), "bin": bins, "size": s[bins], "rows": rows[n][bins]})

    out, number = ({n: np.zeros(BINS, dtype=np.int64) for n in asked} for _ in range(2))
    found = points.mapInPandas(partial, "node long, bin long, size long, rows long").groupBy("node", "bin").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows"))
    for r in found.collect():
        out[r["node"]][r["bin"]], number[r["node"]][r["bin"]] = r["size"], r["rows"]
    return out, number


def _points_in(points: DataFrame, dims: list[str], tree: Tree, asked: dict[int, tuple[int, int, int]]) -> dict[int, list[tuple[int, int]]]:
    """(point, bytes) of the rows of each asked node in a range: (dimension, start, end). Ranges are known to hold FETCHED rows at most."""

    def partial(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            codes, low = _arrays(pdf, dims)
            node, size = tree.node_of(codes, low), pdf["size"].to_numpy(np.int64)
            for n, (dim, start, end) in asked.items():
                at = codes[dim] << LOW | low
                on = np.flatnonzero((node == n) & (at >= start) & (at < end))
                yield pd.DataFrame({"node": np.full(len(on), n), "point": at[on], "size": size[on]})

    out: dict[int, list[tuple[int, int]]] = {n: [] for n in asked}
    for r in points.mapInPandas(partial, "node long, point long, size long").collect():
        out[r["node"]].append((r["point"], r["size"]))
    return out


def _exact_cut(found: list[tuple[int, int]], before: int, need: float, slack: float, end: int) -> int:
    """The cut among a few rows that comes nearest; between two groups if that misses by no more than slack."""
    at, upto = before, []
    for point, size in sorted(found):
        if not upto or point != upto[-1][0]:
            upto.append((point, at))
        at += size
    upto.append((end, at))
    whole = [(abs(v - need), p) for i, (p, v) in enumerate(upto) if i == 0 or i == len(upto) - 1 or p >> ID_BITS != upto[i - 1][0] >> ID_BITS]
    best = min(whole)
    return best[1] if best[0] <= slack else min((abs(v - need), p) for p, v in upto)[1]


def build_tree(points: DataFrame, dims: list[str], shards: int) -> Tree:
    """points: the dimensions' codes, low (bits below them) and size. All nodes of a level are cut together."""
    tree, share = Tree(shards), None
    while open_ := [n for n, d in enumerate(tree.dim) if d < 0 and tree.leaves[n] > 1]:
        spreads = _spreads(points, dims, tree)
        if share is None:
            share = sum(x[0] for x in spreads.values()) / shards
        searches = {}
        for n in open_:
            whole, *ranges = spreads.get(n, [0, *[(0, 0)] * len(dims)])
            if not whole:
                tree.split(n, 0, 0)
                continue
            dim = max(range(len(dims)), key=lambda i: (ranges[i][1] - ranges[i][0], -i))
            start, end = ranges[dim][0] << LOW, (ranges[dim][1] + 1) << LOW
            searches[n] = {"dim": dim, "start": start, "end": end, "need": whole * (tree.leaves[n] // 2) / tree.leaves[n], "before": 0}
        cuts: dict[int, tuple[int, int]] = {}
        while searches:
            asked = {}
            for n, s in searches.items():
                width = -(-(s["end"] - s["start"]) // BINS)
                group = 1 << ID_BITS
                asked[n] = (s["dim"], s["start"], width if s.get("divide") else -(-width // group) * group)
            few = {}
            sums_of, rows_of = _histograms(points, dims, tree, asked)
            for n, sums in sums_of.items():
                s, (dim, start, width) = searches[n], asked[n]
                upto = s["before"] + np.concatenate([[0], np.cumsum(sums)])
                best = int(np.argmin(np.abs(upto - s["need"])))
                miss, whole_groups = abs(upto[best] - s["need"]), width % (1 << ID_BITS) == 0
                if miss <= share * SLACK or width == 1 or (width == 1 << ID_BITS and miss <= share * GROUP_SLACK and whole_groups):
                    cuts[n] = (dim, start + best * width)
                    del searches[n]
                    continue
                hit = min(int(np.searchsorted(upto, s["need"], "right")) - 1, BINS - 1)
                if rows_of[n][hit] <= FETCHED:
                    few[n] = (dim, start + hit * width, start + (hit + 1) * width)
                    s["before"] = int(upto[hit])
                    continue
                s.update(start=start + hit * width, end=start + (hit + 1) * width, before=int(upto[hit]), divide=width == 1 << ID_BITS or s.get("divide", False))
            for n, found in (_points_in(points, dims, tree, few) if few else {}).items():
                s = searches.pop(n)
                cuts[n] = (s["dim"], _exact_cut(found, s["before"], s["need"], share * GROUP_SLACK, few[n][2]))
        for n, (dim, cut) in cuts.items():
            tree.split(n, dim, cut)
    return tree


def with_points(rows: DataFrame, dims: list[str]) -> DataFrame:
    """Replaces dimensions (numbers, null: the least) by codes of 0 to 2**CODE_BITS - 1 over their range."""
    ends = rows.agg(*[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max))]).first()
    codes = {}
    for d in dims:
        lo, hi = ends[f"lo_{d}"] or 0.0, ends[f"hi_{d}"] or 0.0
        codes[d] = F.coalesce(((F.col(d) - lo) * (((1 << CODE_BITS) - 1) / ((hi - lo) or 1.0))).cast("long"), F.lit(0).cast("long"))
    return rows.withColumns(codes)


def shard(rows: DataFrame, dims: list[str], shards: int = SHARDS) -> DataFrame:
    """rows with shard and slot. rows: doc_id, size, text_hash (long) and the dimensions, as numbers; it should be saved."""
    points = with_points(rows, dims).withColumn(
        "low",
        F.shiftleft(F.pmod(F.col("text_hash"), F.lit(1 << TEXT_BITS)), ID_BITS) + F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << ID_BITS)),
    )
    tree = build_tree(points.select(*dims, "low", "size"), dims, shards)
    first = np.array(tree.first)

    @F.pandas_udf("int")
    def leaf(low: pd.Series, *codes: pd.Series) -> pd.Series:
        return pd.Series(first[tree.node_of(np.stack([c.to_numpy(np.int64) for c in codes]), low.to_numpy(np.int64))].astype(np.int32))

    placed = points.withColumn("shard", leaf("low", *dims)).withColumn("salt", salt_of(F.col("doc_id"))).drop("low", *dims)
    return positions(placed, ["shard"], ["salt"], ["doc_id", "text_hash"], "slot").drop("salt")


def op4_kd_shards(spark, sf_dir: str) -> DataFrame:
    """Dimensions: magnitude of the size, bytes a character (the script) and line length, all set by the text alone."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size, chars = F.octet_length(text).cast("long"), F.length(text)
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (size + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        F.log2(size + 16.0).alias("magnitude"),
        (size / F.greatest(chars, F.lit(1))).alias("bytes_a_char"),
        F.log2(chars / (chars - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1) + 1).alias("line_length"),
    )
    placed = shard(saved(rows), ["magnitude", "bytes_a_char", "line_length"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
