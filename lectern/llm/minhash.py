"""Near-duplicate documents by min-max hashing.

Under each of PERMUTATIONS hash functions a document keeps the least and the largest value of its shingles: two unbiased
components for one evaluation, of lower variance than two independent minima. BANDS bands of ROWS components each make
buckets; a pair at the threshold of 0.8 shares none with a probability of (1 - 0.8**5)**26, about 3 in 100,000.

Texts with one sequence of words are one class, and only one of them goes on. The least id of a bucket is its pivot, and
all others are compared with it on full sets. Documents of buckets with one pivot are a group. Where a group then holds
several components, all that is outside its largest one meets the whole group, block by block, in matrix products that
give links and no pairs. So no link that a bucket holds is lost, and nothing is compared within one component.

Cases: null and empty texts have an empty set, link with nothing and are kept; so do rows with a null id, whose
component is null; with fewer words than a shingle, the whole sequence is the one shingle; rows of one id are one
document, linked by any of its texts, and each gets a result row; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches, table
from .graph import components
from .words import mixed, sequence_keys, shingle_hashes, word_hashes

PERMUTATIONS, BANDS, ROWS = 65, 26, 5
#: Documents in a block and their shingles together, and columns of a block's matrices.
BLOCK, BLOCK_SHINGLES, COLUMNS = 512, 1_000_000, 8192
#: So many ids of documents in shared buckets are sent to all executors, 8 bytes each; more are joined by a shuffle.
SENT = 1_000_000
_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)


def signatures(shingles: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """2 * PERMUTATIONS components for each text that has shingles: least values, then largest ones."""
    starts = (np.cumsum(runs) - runs)[runs > 0]
    out = np.empty((2 * PERMUTATIONS, len(starts)), dtype=np.uint64)
    for p in range(PERMUTATIONS) if len(starts) else ():
        hashed = (shingles ^ _SHIFTS[p]) * _FACTORS[p]
        np.minimum.reduceat(hashed, starts, out=out[p])
        np.maximum.reduceat(hashed, starts, out=out[PERMUTATIONS + p])
    return out.T


def band_keys(signature: np.ndarray) -> np.ndarray:
    """BANDS bucket numbers for each row of components."""
    out = np.empty((len(signature), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(signature), band + 1, dtype=np.uint64)
        for c in range(ROWS):
            key = mixed(key * np.uint64(0x9FB21C651E98DF25) + signature[:, band * ROWS + c])
        out[:, band] = key
    return out.view(np.int64)


def _signed(docs: DataFrame, width: int) -> DataFrame:
    def run(parts):
        for pdf in parts:
            at = 0
            for words, counts in word_hashes(pdf["text"].tolist()):
                shingles, runs = shingle_hashes(words, counts, width)
                ends = np.cumsum(runs)
                distinct = [len(np.unique(shingles[e - r : e])) for r, e in zip(runs, ends, strict=True)]
                k1, k2 = (k.view(np.int64) for k in sequence_keys(words, counts))
                bands = iter(band_keys(signatures(shingles, runs)))
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[at : at + len(counts)].to_numpy(), "n_shingles": distinct, "k1": k1, "k2": k2, "bands": [next(bands) if r else np.array([], dtype=np.int64) for r in runs]})
                at += len(counts)

    return docs.mapInPandas(run, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, k1, n and the sorted distinct shingles, as little-endian bytes."""

    def run(parts):
        for pdf in parts:
            at = 0
            for words, counts in word_hashes(pdf["text"].tolist()):
                shingles, runs = shingle_hashes(words, counts, width)
                sets = [np.unique(shingles[e - r : e]).astype("<u8").tobytes() for r, e in zip(runs, np.cumsum(runs), strict=True)]
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[at : at + len(counts)].to_numpy(), "k1": sequence_keys(words, counts)[0].view(np.int64), "shingles": sets})
                at += len(counts)

    return docs.mapInPandas(run, "doc_id long, k1 long, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b of the pairs that are linked. Sets travel with pairs once: those of b join those of a where they lie."""
    of = lambda c: sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"s{c}"))

    def run(parts):
        for pdf in parts:
            keep = []
            for x, y in zip(pdf["sa"], pdf["sb"], strict=True):
                u, v = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
                both = len(u) + len(v) - len(np.unique(np.concatenate([u, v])))
                keep.append(100 * both >= percent * (len(u) + len(v) - both))
            yield pdf.loc[keep, ["a", "b"]]

    return pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "sa", "sb").mapInPandas(run, "a long, b long")


def block_pairs(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (in left, in right) of the linked pairs. Intersections are products of 0/1 matrices over the shared shingles, some columns at a time."""
    n, m = (np.array([len(x) for x in side]) for side in (left, right))
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    both = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, len(shared), COLUMNS):
        columns = shared[at : at + COLUMNS]
        sides = []
        for side in (left, right):
            dense = np.zeros((len(side), len(columns)), dtype=np.float32)
            for row, shingles in enumerate(side):
                part = shingles[np.searchsorted(shingles, columns[0]) : np.searchsorted(shingles, columns[-1], "right")]
                place = np.minimum(np.searchsorted(columns, part), len(columns) - 1)
                dense[row, place[columns[place] == part]] = 1
            sides.append(dense)
        both += sides[0] @ sides[1].T
    both = np.rint(both).astype(np.int64)
    return np.nonzero(100 * both >= percent * (n[:, None] + m[None, :] - both))


def _linked_in_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """a, b: links between components that lie in one group. rows: pivot, lb, rb, is_left, rep, component, shingles.

    A task reads its rows in the order of blocks and holds one block of either side at a time. Of a row's links to one
    component one is given: for components no more are needed.
    """

    def run(parts):
        key, sides = None, ([], [])

        def found() -> pd.DataFrame:
            (left, right), out = sides, ([], [])
            if left and right:
                i, j = block_pairs([x[2] for x in left], [x[2] for x in right], percent)
                seen = set()
                for x, y in zip(i.tolist(), j.tolist(), strict=True):
                    (a, ca, _), (b, cb, _) = left[x], right[y]
                    if ca != cb and (a, cb) not in seen:
                        seen.add((a, cb))
                        out[0].append(a)
                        out[1].append(b)
            return pd.DataFrame({"a": np.array(out[0], dtype=np.int64), "b": np.array(out[1], dtype=np.int64)})

        for pdf in parts:
            for pivot, lb, rb, is_left, rep, component, data in zip(*[pdf[c] for c in ("pivot", "lb", "rb", "is_left", "rep", "component", "shingles")], strict=True):
                if (pivot, lb, rb) != key:
                    if sides[0] and sides[1]:
                        yield found()
                    key, sides = (pivot, lb, rb), ([], [])
                sides[0 if is_left else 1].append((rep, component, np.frombuffer(data, dtype="<u8")))
        yield found()

    keys = ["pivot", "lb", "rb"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "is_left", "rep").mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    named = slim.where("doc_id is not null")
    signed = saved(_signed(named, width))
    full = signed.where("n_shingles > 0")
    classes = saved(full.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n")))
    # an id with several texts joins their classes
    torn = full.groupBy("doc_id").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).where("low < high").select("doc_id")
    same_id = full.select("doc_id", "k1", "k2").join(torn, "doc_id", "left_semi").join(classes, ["k1", "k2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    # one row of each class goes to the buckets (a rep with two texts, of a repeated id, with each); the least is the pivot
    one = full.join(classes.select("k1", "k2", F.col("rep").alias("doc_id")), ["k1", "k2", "doc_id"], "left_semi").select("doc_id", "n_shingles", "bands")
    banded = one.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    pivots = banded.groupBy("bucket").agg(F.min(F.struct("rep", "n")).alias("p"), F.max("rep").alias("last")).where("p.rep < last")
    pivots = pivots.select("bucket", F.col("p.rep").alias("pivot"), F.col("p.n").alias("m"))
    near = saved(banded.join(pivots, "bucket").groupBy("pivot", "rep", "n", "m").agg(F.lit(0).alias("in_bucket")).drop("in_bucket"))
    reps = saved(near.select("rep").distinct())
    few = reps.count() <= SENT
    keyed = reps.join(classes.select("rep", "k1"), "rep").select(F.col("rep").alias("doc_id"), "k1")
    wanted = reps.withColumnRenamed("rep", "doc_id")
    texts = named.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi")
    sets = _sets(texts, width).join(keyed, ["doc_id", "k1"], "left_semi").dropDuplicates(["doc_id", "k1"])
    sets = saved(sets.select(F.col("doc_id").alias("rep"), "shingles"))

    star = near.where(f"rep > pivot AND 100 * least(n, m) >= {percent} * greatest(n, m)").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    edges = saved(_confirmed(star, sets, percent).union(same_id))
    joined = components(edges, "a", "b")

    # groups of a pivot that are not one component: who is outside of the main one meets all others, in blocks
    lying = near.select("pivot", "rep", "n").distinct().join(joined.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    parts = lying.groupBy("pivot", "component").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n"))
    groups = parts.groupBy("pivot").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.max(F.struct("size", "component")).alias("most"))
    groups = groups.where("size > 2 AND most.size < size").select("pivot", F.col("most.component").alias("main"), F.ceil(F.greatest(F.col("size") / BLOCK, F.col("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = saved(lying.join(groups, "pivot").join(sets, "rep"))
    mine, every = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["rep", "component", "shingles"]
    left = placed.where("component <> main").select("pivot", mine.alias("lb"), every.alias("rb"), F.lit(True).alias("is_left"), *columns)
    right = placed.select("pivot", every.alias("lb"), mine.alias("rb"), F.lit(False).alias("is_left"), *columns)
    found = saved(_linked_in_blocks(left.unionByName(right), percent))
    # the graph of components that the new links join
    if not found.isEmpty():
        ends = found.join(joined.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").withColumn("ca", F.coalesce("ca", "a")).join(joined.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left").select("ca", F.coalesce("cb", "b").alias("cb"))
        lower = components(ends, "ca", "cb").select(F.col("node").alias("top"), F.col("component").alias("lower"))
        nodes = joined.union(found.select("a", "a").union(found.select("b", "b")).distinct().join(joined, F.col("a") == F.col("node"), "left_anti"))
        joined = saved(nodes.join(lower, F.col("component") == F.col("top"), "left").select("node", F.least("component", F.coalesce("lower", "component")).alias("component")))

    about = classes.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("component_id"))
    of_rows = signed.select("doc_id", "n_shingles", "k1", "k2").join(about, ["k1", "k2"], "left")
    rows = of_rows.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    rest = _signed(slim.where("doc_id is null"), width).select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return rows.union(rest).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op3_minmax_dedup(spark, sf_dir: str) -> DataFrame:
    """Shingles of two words, linked at 80 % of their union."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)
