"""How far sources differ in their words, by joint count histograms.

Of every two sources of a language the terms are tallied by (count in one, count in the other). The terms that both have are
met in blocks of terms, each block in one task, which gives distinct combinations and their numbers only; cells where one
count or both are zero are never listed but follow from each source's own counts: what a source's histogram holds beyond
the joint cells lies at zero of the other. The difference of smoothed shares is then evaluated once for each combination,
times its number. Shares are whole billionths, so all results are exact.

Texts are counted in Arrow batches, so a term is shuffled with counts and not by occurrence. Counts are dealt by (lang,
term); a source or a language with most of the rows is many terms. Blocks hold about CELLS counts and are read by as many
tiles of sources as TILE asks for; the numbers of pairs of sources is the result's own size.

Cases: null text, lang and source count as empty ones; a source without kept terms has counts of zero; a language without
kept terms has differences of zero; rows alike are counted each; an empty table gives an empty result; very long texts are
counted in pieces, cut between words; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.ids import with_dense_ids

from .common import saved, small_batches, table, with_facts

#: Documents of a language that must have a term; the smoothing count; shares are in parts of SCALE; terms reported a source.
LEAST, SMOOTH, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Counts and pairs of sources in a block; sources of a tile; pairs at once; entries that a task gathers before it hands them on; bytes of a piece.
CELLS, PAIRS, TILE, AT_ONCE, FLUSH, PIECE = 50_000, 2_000_000, 2_000, 1_000_000, 200_000, 1 << 20

#: In UTF-8, where all of [^\\x00-\\x7F] are bytes from 0x80, and small letters only.
_TERM, _BREAK = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[^a-z\x80-\xff]")
_COUNTS = "lang string, source string, term string, n long, docs long"


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text in pieces of about a size, none cut inside a term."""
    at = 0
    while len(text) - at > size and (cut := _BREAK.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents), in parts that add up."""
    small_batches(docs.sparkSession)

    def given(tally: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (a, b), (n, docs) in tally.items():
            terms = pa.array(list(n), pa.binary()).cast(pa.string())
            whole = pa.RecordBatch.from_arrays([pa.array([a] * len(n)), pa.array([b] * len(n)), terms, pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())], names=["lang", "source", "term", "n", "docs"])
            yield from (whole.slice(i, 20_000) for i in range(0, len(n), 20_000))
        tally.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, load = {}, 0
        for batch in batches:
            for a, b, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n, docs = tally.setdefault((a, b), (Counter(), Counter()))
                load -= len(n)
                seen = set()
                for piece in pieces(t.lower()):
                    found = _TERM.findall(piece)
                    n.update(found)
                    seen.update(found)
                docs.update(seen)
                load += len(n)
            if load > FLUSH:
                yield from given(tally)
                load = 0
        yield from given(tally)

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(empty(lang).alias("a"), empty(source).alias("b"), empty(text).cast("binary").alias("t")).mapInArrow(run, _COUNTS)


def kept_cells(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, source, term, n, total (n of the whole lang) and place (0-based, of the source among the term's) of terms in at least so many documents of their lang. One shuffle."""
    of_term = Window.partitionBy("lang", "term")
    added = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = added.withColumns({"all_docs": F.sum("docs").over(of_term), "total": F.sum("n").over(of_term), "place": F.row_number().over(of_term.orderBy("source")) - 1})
    return kept.where(F.col("all_docs") >= least).select("lang", "source", "term", "n", "total", "place")


def group_facts(docs: DataFrame, cells: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """A row for each (lang, source) that occurs: number_ (in their order), size (occurrences of kept terms) and terms of its own; of the lang: lang_size, v (kept terms), sources, blocks."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias
    there = docs.select(empty(lang)("lang"), empty(source)("source")).distinct()
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("terms"), F.sum((F.col("place") == 0).cast("long")).alias("v"), F.sum("place").alias("pairs"))
    whole = Window.partitionBy("lang")
    sums = {c: F.sum(c).over(whole) for c in ("v", "pairs")} | {"lang_size": F.sum("size").over(whole), "cells": F.sum("terms").over(whole), "sources": F.count(F.lit(1)).over(whole)}
    facts = there.join(own, ["lang", "source"], "left").na.fill(0).withColumns(sums)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("cells") / CELLS), F.ceil(F.col("pairs") / PAIRS))
    return saved(with_dense_ids(facts.withColumn("blocks", blocks), ["lang", "source"], "number_"))


def share(count: Column, size: Column, v: Column) -> Column:
    """The smoothed share in parts of SCALE, from 1 on; null where there are no terms. Decimals, as counts times SCALE may exceed a long."""
    bottom = F.nullif(size + SMOOTH * v, F.lit(0)).cast("decimal(20,0)")
    return F.call_function("div", (count.cast("decimal(20,0)") + SMOOTH) * SCALE, bottom) + 1


def joint_counts(cells: DataFrame) -> DataFrame:
    """a, b (numbers of sources, a < b), x, y, m: how many terms a has x times and b y times, neither zero; a pair of counts may come in several rows.

    cells: lang, number_, term, n, blocks and sources.
    """

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, _, tile, tiles = key
        pdf = pdf.sort_values(["term", "number_"], ignore_index=True)
        number, n = pdf["number_"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        first = np.flatnonzero(np.append(True, (pdf["term"].to_numpy()[1:] != pdf["term"].to_numpy()[:-1]))) if len(pdf) else np.array([], dtype=np.int64)
        start = np.repeat(first, np.diff(np.append(first, len(pdf))))
        states, state = np.unique(np.stack([number, n]), axis=1, return_inverse=True)  # a source with a count
        state = state.ravel()
        later = np.flatnonzero((number % tiles == tile) & (np.arange(len(pdf)) > start))
        before = later - start[later]  # earlier sources of the term
        upto = np.cumsum(before)
        codes, times = [np.array([], dtype=np.int64)], [np.array([], dtype=np.int64)]
        at = 0
        while at < len(later):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + AT_ONCE, "right")))
            r = before[at:end]
            i = np.repeat(later[at:end], r)
            j = np.arange(len(i)) - np.repeat(np.cumsum(r) - r, r) + start[i]
            code, m = np.unique(state[j] * states.shape[1] + state[i], return_counts=True)
            codes.append(code)
            times.append(m)
            at = end
        code, where = np.unique(np.concatenate(codes), return_inverse=True)
        m = np.bincount(where.ravel(), np.concatenate(times), len(code)).astype(np.int64)
        p, q = code // max(states.shape[1], 1), code % max(states.shape[1], 1)
        return pd.DataFrame({"a": states[0][p], "b": states[0][q], "x": states[1][p], "y": states[1][q], "m": m})

    tiles = F.ceil(F.col("sources") / TILE).cast("int")
    dealt = cells.select("lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), tiles.alias("tiles"), "term", "number_", "n")
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    return dealt.groupBy("lang", "block", "tile", "tiles").applyInPandas(run, "a long, b long, x long, y long, m long")


def pair_histograms(cells: DataFrame, facts: DataFrame) -> DataFrame:
    """a, b, x, y, m of all pairs of sources of a lang, with the cells at zero; m adds up to the lang's kept terms."""
    zero = F.lit(0).cast("long")
    cell = lambda x, y, m: F.struct(x.alias("x"), y.alias("y"), m.alias("m"))
    m, n, times = F.col("m"), F.col("n"), F.col("times")
    # a term at (x, y) is neither at (x, 0) nor at (0, y), where the sources' own histograms put it, and stands for two terms there
    joint = joint_counts(cells).select("a", "b", F.explode(F.array(cell(F.col("x"), F.col("y"), m), cell(F.col("x"), zero, -m), cell(zero, F.col("y"), -m), cell(zero, zero, m))).alias("c"))
    own = cells.groupBy("lang", "number_", "n").agg(F.count(F.lit(1)).alias("times"))
    one, two = (facts.select("lang", F.col("number_").alias(c), F.col("terms").alias(f"{c}_terms"), *(["v"] if c == "a" else [])) for c in "ab")
    pairs = one.join(two, "lang").where("a < b")
    empty = pairs.select("a", "b", cell(zero, zero, F.col("v") - F.col("a_terms") - F.col("b_terms")).alias("c"))
    at_zero_b = pairs.select("lang", "a", "b").join(own.withColumnRenamed("number_", "a"), ["lang", "a"]).select("a", "b", cell(n, zero, times).alias("c"))
    at_zero_a = pairs.select("lang", "a", "b").join(own.withColumnRenamed("number_", "b"), ["lang", "b"]).select("a", "b", cell(zero, n, times).alias("c"))
    every = joint.union(empty).union(at_zero_b).union(at_zero_a)
    return every.groupBy("a", "b", "c.x", "c.y").agg(F.sum("c.m").alias("m")).where("m <> 0 OR (x = 0 AND y = 0)")


def divergences(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: how far each other source of the lang is away (pair), and the terms that the source has more of than its lang (term)."""
    cells = saved(kept_cells(term_counts(docs, text, lang, source), least))
    facts = group_facts(docs, cells, lang, source)
    known = with_facts(cells, facts.select("lang", "source", "number_", "size", "lang_size", "v", "sources", "blocks"), ["lang", "source"], "term")
    known = saved(known)

    of = lambda side: facts.select(F.col("number_").alias(side), F.col("size").alias(f"{side}_size"), *([F.col("v")] if side == "a" else []))
    met = with_facts(with_facts(pair_histograms(known, facts), of("a"), ["a"], "x"), of("b"), ["b"], "x")
    apart = F.col("m") * F.abs(share(F.col("x"), F.col("a_size"), F.col("v")) - share(F.col("y"), F.col("b_size"), F.col("v")))
    values = saved(met.groupBy("a", "b").agg(F.coalesce(F.sum(apart), F.lit(0)).alias("value")))
    both = values.select("a", "b", "value").union(values.select("b", "a", "value"))
    named = with_facts(both, facts.select(F.col("number_").alias("a"), "lang", "source"), ["a"], "b")
    named = with_facts(named, facts.select(F.col("number_").alias("b"), F.col("source").alias("item")), ["b"], "a")
    order = lambda *group: Window.partitionBy(*group).orderBy(F.desc("value"), "item")
    pairs = named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order("lang", "source")).alias("rank"))

    more = share(F.col("n"), F.col("size"), F.col("v")) - share(F.col("total"), F.col("lang_size"), F.col("v"))
    terms = known.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), more.alias("value")).where("value > 0")
    terms = terms.withColumn("rank", F.row_number().over(order("lang", "source"))).where(F.col("rank") <= top)
    return pairs.union(terms)


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergences(table(spark, sf_dir, "documents"))


#: The same in DuckDB's SQL, term by term.
OP11_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
), words AS (
  SELECT id, lang, source, unnest(words) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY ALL HAVING count(DISTINCT id) >= {LEAST}
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL
), grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.total, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS size,
         sum(k.total) OVER (PARTITION BY g.lang, g.source) AS lang_size, count(*) OVER (PARTITION BY g.lang, g.source) AS v
  FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT *, 1 + ({SCALE}::HUGEINT * (n + {SMOOTH})) // (size + {SMOOTH} * v) AS p, 1 + ({SCALE}::HUGEINT * (total + {SMOOTH})) // (lang_size + {SMOOTH} * v) AS q FROM grid
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS xs, y.source AS ys, sum(abs(x.p - y.p)) AS value FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) d
  ON d.lang = a.lang AND xs = a.source AND ys = b.source
), terms AS (
  SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM terms) WHERE rank <= {TOP}
"""
