"""Manifest of a dataset as Merkle trees, in an external store of nodes.

A row is a leaf: the hash of its columns. The leaves of a tree stand in the order of a key and are written as sorted runs
to Parquet. Nodes are written to Parquet too, partitioned by level: every FAN consecutive nodes of a level become one of
the next. A pass reads one level in sorted blocks of FAN ** STRIDE nodes, which are whole subtrees, and streams each block
through STRIDE levels; the next pass starts from the last level written. The trees' roots are leaves of one more tree, the
forest. Proofs are read the other way: a merge scan meets each block's leaves with the nodes above them, by their
coordinates (tree, level, position), below the path of the block's top, which the pass above has found. No task sees more than
a block, and the driver sees one root and one largest size.

Cases: null columns count as `-`; a null tree is a tree of its own, the first one; null keys come first; rows alike are
leaves of their own; an empty table has no root and gives an empty result; further columns stay out of the hashes. Very long texts are hashed whole.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.ids import with_dense_ids
from lectern.saving import shared_folder

from .common import saved, table, with_facts

#: Nodes that become one, and levels of a block.
FAN, STRIDE = 8, 3
BLOCK = FAN**STRIDE
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The forest's tree number.
FOREST = -1


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(*fields: Column) -> Column:
    """Of the fields' lengths and values, so that neighbours can't be mistaken for each other."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[part(f.cast("string")) for f in fields]), 256)


def levels_above(nodes: list[str], n: int, most: int = STRIDE) -> list[list[str]]:
    """The levels over a block's nodes, while the tree (n nodes at this level) has several."""
    out = []
    while n > 1 and len(out) < most:
        nodes, n = [digest("".join(nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)], -(-n // FAN)
        out.append(nodes)
    return out


def siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """What stands left and right of the node at a place of the first level, and of its ancestors, in their runs."""
    out = []
    for nodes in levels:
        run = at // FAN * FAN
        out.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + FAN])))
        at //= FAN
    return out


def fold(node: str, path: list[tuple[str, str]]) -> str:
    """The root that a node and its path lead to."""
    return reduce(lambda h, x: digest(x[0] + h + x[1]), path, node)


@dataclass
class Store:
    """Leaves (tree, n, pos, hash and what was kept of the rows) and nodes (level, tree, pos, hash, top), as Parquet; n is the tree's number of leaves, top marks a tree's root."""

    spark: object
    folder: str
    largest: int

    def leaves(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/leaves")

    def nodes(self) -> DataFrame:
        return self.spark.read.schema("tree long, n long, pos long, hash string, top boolean, level int").parquet(f"{self.folder}/nodes")

    def base(self, level: int) -> DataFrame:
        """The nodes that a pass starts from."""
        return self.leaves() if level == 0 else self.nodes().where(F.col("level") == level).where(f"n > {FAN**level}").select("tree", "n", "pos", "hash")

    def passes(self) -> list[int]:
        """First levels of the passes."""
        out = [0]
        while self.largest > FAN ** (out[-1] + STRIDE):
            out.append(out[-1] + STRIDE)
        return out

    def roots(self) -> DataFrame:
        """tree and hash."""
        return self.nodes().where("top").select("tree", "hash").union(self.leaves().where("n = 1").select("tree", "hash"))


def _climb(store: Store, level: int) -> None:
    """One pass: the STRIDE levels above a level, written next to it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos", ignore_index=True)
        tree, n, first = (int(pdf[c].iloc[0]) for c in ("tree", "n", "pos"))
        here = -(-n // FAN**level)
        out = [(tree, n, first // FAN ** (k + 1) + i, h, -(-here // FAN ** (k + 1)) == 1, level + k + 1) for k, nodes in enumerate(levels_above(pdf["hash"].tolist(), here)) for i, h in enumerate(nodes)]
        return pd.DataFrame(out, columns=["tree", "n", "pos", "hash", "top", "level"])

    blocks = store.base(level).select("tree", "n", "pos", "hash", F.floor(F.col("pos") / BLOCK).alias("block")).groupBy("tree", "block")
    made = blocks.applyInPandas(lambda pdf: run(pdf.drop(columns="block")), "tree long, n long, pos long, hash string, top boolean, level int")
    made.write.mode("append").partitionBy("level").parquet(f"{store.folder}/nodes")


def store_leaves(leaves: DataFrame, folder: str) -> Store:
    """Writes the leaves (tree, n, pos, hash, ...) in their order, and all levels above."""
    leaves.write.parquet(f"{folder}/leaves")
    spark = leaves.sparkSession
    store = Store(spark, folder, spark.read.parquet(f"{folder}/leaves").agg(F.max("n")).first()[0] or 0)
    for level in store.passes():
        _climb(store, level)
    return store


def _with_paths(base: DataFrame, level: int, store: Store, upper: DataFrame, emit, schema: str) -> DataFrame:
    """What emit gives for each node of base, with its path up to the root.

    upper: tree, block, left, right (a text a level) and subroot of the top of each block. A block's nodes and those above
    them are both dealt by (tree, block) and merged in the order of their coordinates.
    """

    def run(mine: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if not len(mine):
            return pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])
        mine, above = mine.sort_values("pos", ignore_index=True), above.sort_values(["k", "pos"])
        top = above.loc[above["k"] == STRIDE].iloc[0]
        here = -(-int(mine["n"].iloc[0]) // FAN**level)
        levels = [mine["hash"].tolist(), *[g["hash"].tolist() for _, g in above.loc[above["k"] < STRIDE].groupby("k")]] if here > 1 else []
        rest = list(zip(top["left"], top["right"], strict=True))
        return emit(mine, [siblings(levels, at) + rest for at in range(len(mine))], top["subroot"])

    inner = store.nodes().where(F.col("level").between(level + 1, level + STRIDE - 1)).where("NOT top").withColumn("k", F.col("level") - level)
    none = F.lit(None)
    nodes = inner.select("tree", F.floor(F.col("pos") * F.pow(F.lit(FAN), F.col("k")) / BLOCK).cast("long").alias("block"), "k", "pos", "hash", none.cast("array<string>").alias("left"), none.cast("array<string>").alias("right"), none.cast("string").alias("subroot"))
    tops = upper.select("tree", "block", F.lit(STRIDE).alias("k"), F.lit(0).cast("long").alias("pos"), none.cast("string").alias("hash"), "left", "right", "subroot")
    blocks = base.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long")).groupBy("tree", "block")
    return blocks.cogroup(nodes.union(tops).groupBy("tree", "block")).applyInPandas(run, schema)


def _paths(mine: pd.DataFrame, paths: list, subroot: str | None) -> pd.DataFrame:
    left, right = [[x for x, _ in p] for p in paths], [[y for _, y in p] for p in paths]
    return pd.DataFrame({"tree": mine["tree"], "pos": mine["pos"], "left": left, "right": right, "subroot": subroot})


PATHS = "tree long, pos long, left array<string>, right array<string>, subroot string"


def _down(store: Store, tops: DataFrame, emit=_paths, schema: str = PATHS) -> DataFrame:
    """Paths of all leaves. tops: tree, left, right, subroot of the trees' roots. Each pass gives the tops of the pass below."""
    above, sizes = None, store.leaves().where("pos = 0").select("tree", "n")
    tops = saved(tops.join(sizes, "tree").select("tree", F.lit(0).cast("long").alias("block"), "left", "right", "subroot", "n"))
    for level in reversed(store.passes()):
        ending = tops.where((F.col("n") <= FAN ** (level + STRIDE)) & ((F.col("n") > FAN**level) | F.lit(level == 0))).drop("n")
        upper = ending if above is None else ending.union(above.withColumnRenamed("pos", "block").select(*ending.columns))
        if level == 0:
            return _with_paths(store.leaves(), 0, store, upper, emit, schema)
        above = saved(_with_paths(store.base(level), level, store, upper, _paths, PATHS))
    raise AssertionError


@dataclass
class Manifest:
    """Trees by tree column, the forest over their roots, and the one root."""

    trees: Store
    forest: Store
    root: str | None

    def _tops(self) -> DataFrame:
        none = F.array().cast("array<string>")
        whole = self.trees.spark.range(1).select(F.lit(FOREST).cast("long").alias("tree"), none.alias("left"), none.alias("right"), F.lit(None).cast("string").alias("subroot"))

        def one(mine, paths, _):
            return _paths(mine, paths, None).assign(tree=mine["pos"], pos=0, subroot=mine["hash"])

        return _down(self.forest, whole, one, PATHS).drop("pos")

    def proofs(self) -> DataFrame:
        """tree, pos, left, right and subroot of each leaf: folding left[k] + hash + right[k] from level to level gives the root."""
        return _down(self.trees, self._tops())

    def checked(self, key: str, changed: str) -> DataFrame:
        """key, leaf, subroot, proof_sha256 (of the path's siblings) and folded_root, from the leaf or, where it isn't null, what it has changed to."""

        def emit(mine: pd.DataFrame, paths: list, subroot: str) -> pd.DataFrame:
            start = mine[changed].where(mine[changed].notna(), mine["hash"])
            proofs = [digest("".join(x + y for x, y in p)) for p in paths]
            return pd.DataFrame({key: mine[key], "leaf": mine["hash"], "subroot": subroot, "proof_sha256": proofs, "folded_root": [fold(h, p) for h, p in zip(start, paths, strict=True)]})

        kind = self.trees.leaves().schema[key].dataType.simpleString()
        return _down(self.trees, self._tops(), emit, f"{key} {kind.replace('bigint', 'long')}, leaf string, subroot string, proof_sha256 string, folded_root string")


def manifest(rows: DataFrame, tree: str, key: str, leaf: str, keep: list[str] = (), folder: str | None = None) -> Manifest:
    """Builds the store of rows that have their hash in the column leaf; the columns of keep stay beside the leaves."""
    spark = rows.sparkSession
    folder = folder or f"{shared_folder(spark)}/merkle-{uuid.uuid4().hex}"
    slim = rows.select(F.col(tree).alias("tree_"), F.col(key).alias("key_"), F.col(leaf).alias("hash"), *keep)
    numbered = saved(slim.withColumn("row_", F.monotonically_increasing_id()))  # saved first: sorting reads twice, and rows alike are told apart
    placed = with_dense_ids(numbered, ["tree_", "key_", "hash", "row_"], "id_")
    sizes = placed.groupBy("tree_").agg(F.count(F.lit(1)).alias("n"), F.min("id_").alias("first_"))
    trees = saved(with_dense_ids(sizes, ["tree_"], "tree"))
    leaves = with_facts(placed, trees, ["tree_"], "id_").select("tree", "n", (F.col("id_") - F.col("first_")).alias("pos"), "hash", *keep)
    store = store_leaves(leaves, f"{folder}/trees")
    subroots = saved(store.roots())
    forest = subroots.select(F.lit(FOREST).cast("long").alias("tree"), F.lit(subroots.count()).alias("n").cast("long"), F.col("tree").alias("pos"), "hash")
    forest = store_leaves(forest, f"{folder}/forest")
    root = forest.roots().first()
    return Manifest(store, forest, root["hash"] if root else None)


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Trees by lang, leaves by doc_id. In a third of the rows the text was tampered with: its letters A-Z are small ones."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    others = [F.col(f) for f in FIELDS[:-1]]
    hashed = docs.select("doc_id", "lang", leaf_hash(*others, F.col("text")).alias("leaf"), F.when(tampered, leaf_hash(*others, small)).alias("changed"))
    made = manifest(hashed, "lang", "doc_id", "leaf", ["doc_id", "changed"])
    root = F.lit(made.root).cast("string")
    return made.checked("doc_id", "changed").withColumn("root", root).withColumn("verified", F.col("folded_root") == root)


def _level(source: str, name: str) -> str:
    """One level's runs, and the next level; a tree of one node goes up as it is."""
    return f"""{name}_runs AS (
  SELECT tree, pos // {FAN} AS run, any_value(n) AS n, string_agg(h, '' ORDER BY pos) AS s FROM {source} GROUP BY 1, 2
), {name} AS (
  SELECT tree, run AS pos, (n + {FAN - 1}) // {FAN} AS n, CASE WHEN n = 1 THEN s ELSE sha256(s) END AS h FROM {name}_runs
)"""


def _step(before: str, name: str, runs: str, tree: str, pos: str, k: int) -> str:
    """Path and folded value after one more level."""
    at = f"({pos} // {FAN**k}) % {FAN}"
    left, right = f"CASE WHEN r.n = 1 THEN '' ELSE substr(s, 1, 64 * ({at})) END", f"CASE WHEN r.n = 1 THEN '' ELSE substr(s, 64 * ({at}) + 65) END"
    return f"""{name} AS (
  SELECT p.* EXCLUDE (proof, folded), proof || {left} || {right} AS proof, CASE WHEN r.n = 1 THEN folded ELSE sha256({left} || folded || {right}) END AS folded
  FROM {before} p JOIN {runs} r ON r.tree = {tree} AND r.run = {pos} // {FAN ** (k + 1)}
)"""


def _sql(levels: int = 6, above: int = 4) -> str:
    """For trees of at most FAN ** levels leaves, and FAN ** above trees."""
    value = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(value(c) for c in (*FIELDS[:-1], text)) + ")"
    crc = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, i: xor(y >> 1, 3988292384 * (y & 1))))"
    parts = [
        f"""leaves AS (
  SELECT doc_id, {leaf("text")} AS h, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, lang,
         CASE WHEN xor({crc}, 4294967295) % 3 = 0 THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed FROM documents
), t0 AS (
  SELECT doc_id, tree, h, changed, count(*) OVER (PARTITION BY tree) AS n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaves
)""",
        *[_level(f"t{k}", f"t{k + 1}") for k in range(levels)],
        f"f0 AS (SELECT {FOREST} AS tree, tree AS pos, h, count(*) OVER () AS n FROM t{levels})",
        *[_level(f"f{k}", f"f{k + 1}") for k in range(above)],
        f"p0 AS (SELECT t0.doc_id, t0.tree, t0.pos, t0.h AS leaf, f0.h AS subroot, (SELECT h FROM f{above}) AS root, '' AS proof, coalesce(t0.changed, t0.h) AS folded FROM t0 JOIN f0 ON f0.pos = t0.tree)",
        *[_step(f"p{k}", f"p{k + 1}", f"t{k + 1}_runs", "p.tree", "p.pos", k) for k in range(levels)],
        *[_step(f"p{levels + k}", f"p{levels + k + 1}", f"f{k + 1}_runs", str(FOREST), "p.tree", k) for k in range(above)],
    ]
    return "WITH " + ", ".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM p{levels + above}"


#: The same in DuckDB's SQL, level by level.
OP13_SQL = _sql()
