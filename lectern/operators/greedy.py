"""Greedy selection of utterances by their symbol n-grams, within a budget of speaking time.

Kullback-Leibler: the distribution of all selected n-grams comes as near as it can to a uniform one. With counts x, their
sum N and V kinds of n-grams, the divergence is ln V - ln N + (sum of x ln x) / N, so a candidate needs only its own
counts. Coverage: the candidate with most n-grams not yet covered; when no candidate adds one, all count as uncovered
again. Ties go to the smallest id; the loop ends when the best candidate does not fit the budget any more.

Candidates are rows of (id, symbols, n-grams as 64-bit numbers, counts), made without a shuffle and saved once; which rows are selected
already is found where they lie (members.py). A pass scores
them where they lie; a partition answers with its best rows and with what the others can reach at best. The driver picks
among the answers, with exact new scores after each pick, as long as the best one beats what any other row may have become:
n-grams that are covered stay so, and with the counts of what is selected the sum that a row adds to x ln x only
grows, so its least value for each number of n-grams bounds the divergence from below. So a pass yields many picks, and only where rows come too
close a new one is needed. The driver keeps POOL rows and the counts of the n-grams that are selected, which grow with the selection
and not with the corpus. No task or group holds all candidates; callers may have few of them (one_task, a checked size) run through in one.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators.grams import counted_grams, gram_texts
from lectern.operators.members import Members, hashed
from lectern.saving import saved_table

#: n-gram numbers up to which one task may run the whole loop; 0: passes at every size.
ONE_TASK = 0
#: Rows that all partitions answer with in a pass, and of one partition at least.
POOL, LEAST = 4096, 8
#: What rounding may change in a score.
CLOSE = 1e-11


def gains(kind: str, grams: np.ndarray, counts: np.ndarray, rows: np.ndarray, size: int, have: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each row adds to the sum of x ln x (coverage: minus its new n-grams), and its number of n-grams. grams, counts: of all rows; rows: the row of each."""
    x = have[grams]
    if kind == "coverage":
        return -np.bincount(rows, x == 0, size), np.bincount(rows, counts, size)
    return np.bincount(rows, (x + counts) * np.log(x + counts) - np.where(x > 0, x * np.log(np.maximum(x, 1)), 0), size), np.bincount(rows, counts, size)


def scores(kind: str, gain: np.ndarray, n: np.ndarray, have: np.ndarray) -> np.ndarray:
    """Less is better: the divergence, less ln V, after adding a row; or minus the number of its new n-grams."""
    if kind == "coverage":
        return gain
    base, total = float((have[have > 0] * np.log(have[have > 0])).sum()), have.sum() + n
    return (base + gain) / total - np.log(total)


def _scored(kind: str, grams, counts, rows, size: int, have: np.ndarray) -> np.ndarray:
    return np.round(scores(kind, *gains(kind, grams, counts, rows, size, have), have), 12)


def _flat(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(x) for x in pdf["grams"]]
    join = lambda c: np.concatenate([np.asarray(x, dtype=np.int64) for x in pdf[c]] or [np.array([], dtype=np.int64)])
    return join("grams"), join("counts"), np.repeat(np.arange(len(pdf)), sizes)


def _known(names: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """The place of each n-gram in the sorted names; len(names) where it is missing."""
    at = np.minimum(np.searchsorted(names, grams), max(len(names) - 1, 0))
    return np.where(names[at] == grams, at, len(names)) if len(names) else np.zeros(len(grams), dtype=np.int64)


def _offers(parts, state, kind: str, many: int):
    """A partition's best rows, with their n-grams, and a row without id for the others by their number of n-grams: their least gain, and the least id that has it."""
    names, have, taken = state
    have = np.append(have, 0)
    top, others = None, {}
    for pdf in parts:
        pdf = pdf[~np.isin(pdf["utt_id"].to_numpy(np.int64), taken)].reset_index(drop=True)
        if not len(pdf):
            continue
        grams, counts, rows = _flat(pdf)
        gain, n = gains(kind, _known(names, grams), counts, rows, len(pdf), have)
        pdf = pdf.assign(gain=gain.astype(float), n=n.astype(np.int64), score=np.round(scores(kind, gain, n, have), 12))
        top = (pdf if top is None else pd.concat([top, pdf])).sort_values(["score", "utt_id"], ignore_index=True)
        for g, m, i in top.loc[top.index >= many, ["gain", "n", "utt_id"]].itertuples(index=False):
            key = 0 if kind == "coverage" else m
            others[key] = min(others.get(key, (g, i)), (g, i))
        top = top.iloc[:many]
    if top is not None:
        yield top[["utt_id", "symbols", "grams", "counts", "gain", "n"]].assign(least=0)
        if others:
            bound = pd.DataFrame([(g, m, i) for m, (g, i) in others.items()], columns=["gain", "n", "least"])
            yield bound.assign(utt_id=None, symbols=0, grams=None, counts=None)[["utt_id", "symbols", "grams", "counts", "gain", "n", "least"]].astype({"utt_id": "Int64"})


def _picks(offers: list, loop: _Loop) -> bool:
    """Picks among a pass's answers while no other row can be better. Whether another pass may find more."""
    rows = sorted((r for r in offers if r["utt_id"] is not None), key=lambda r: r["utt_id"])
    if not rows:
        return False
    others = [r for r in offers if r["utt_id"] is None]
    flat = np.array([g for r in rows for g in r["grams"]], dtype=np.int64)
    counts = np.array([c for r in rows for c in r["counts"]], dtype=np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r["grams"]) for r in rows])
    names, place = np.unique(np.concatenate([flat, np.array(list(loop.have), dtype=np.int64)]), return_inverse=True)
    grams, have = place[: len(flat)], np.array([loop.have.get(g, 0) for g in names.tolist()], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(rows)))])
    far, far_n = np.array([r["gain"] for r in others]), np.array([r["n"] for r in others], dtype=np.int64)
    best_other = min(((r["gain"], r["least"]) for r in others), default=None)
    open_, first = np.ones(len(rows), dtype=bool), True
    while open_.any():
        score = np.where(open_, _scored(loop.kind, grams, counts, owner, len(rows), have), np.inf)
        at = int(np.argmin(score))  # the smallest id of the best
        if not first and others:
            if loop.kind == "coverage":
                if (score[at] == 0 and best_other[0] < 0) or (score[at] < 0 and (score[at], rows[at]["utt_id"]) > best_other):
                    return True
            elif score[at] >= scores("kld", far, far_n, have).min() - CLOSE:
                return True
        if loop.restart(score[at]):
            return True
        if not loop.take(rows[at]):
            return False
        np.add.at(have, grams[starts[at] : starts[at + 1]], counts[starts[at] : starts[at + 1]])
        open_[at], first = False, False
    return bool(others)


class _Loop:
    """What a step needs to know, and what it decides."""

    def __init__(self, have: dict[int, int], kind: str, seconds: float, speed: float) -> None:
        self.have, self.kind, self.left, self.speed, self.taken = have, kind, seconds, speed, []

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        names = np.array(sorted(self.have), dtype=np.int64)
        return names, np.array([self.have[g] for g in names.tolist()], dtype=np.int64)

    def take(self, row) -> bool:
        if (row["symbols"] / self.speed) > self.left + 1e-9:
            return False
        self.left -= row["symbols"] / self.speed
        self.taken.append(int(row["utt_id"]))
        for g, c in zip(row["grams"], row["counts"], strict=True):
            self.have[g] = self.have.get(g, 0) + c
        return True

    def restart(self, score: float) -> bool:
        """Coverage starts anew when nothing is new."""
        if self.kind == "coverage" and score == 0 and self.have:
            self.have.clear()
            return True
        return False


def _counted(texts: DataFrame, n: int, members: Members, inside: bool) -> DataFrame:
    """The counted n-grams of members, or of the other rows; a batch is asked and counted at once."""
    if members.passes is None:
        return counted_grams(texts.limit(0) if inside else texts, n)
    return members.kept(counted_grams(hashed(texts), n, members.passes, inside), inside)


def greedy(utterances: DataFrame, selection: DataFrame, kind: str, n: int, seconds: float = math.inf, ignore: set[str] = frozenset(), band: tuple[float, float] = (0.0, math.inf), speed: float = tx.READING_SPEED, one_task: int = ONE_TASK, within: DataFrame | None = None) -> DataFrame:
    """utt_id and sel_rank (0-based) of the newly selected utterances, in the order they were taken.

    Durations are those of the reading passage, n-grams those of the representation. Utterances without n-grams are no
    candidates. Budgets hold for what is newly selected. within: ids that alone are candidates.
    """
    spark = utterances.sparkSession
    seconds_of = F.col("symbols") / F.lit(speed)
    fits = (seconds_of >= band[0]) & (seconds_of < band[1]) if band[1] != math.inf else seconds_of >= band[0]
    texts, selected = gram_texts(utterances, set(ignore)), Members(utterances, selection)
    rest = _counted(texts.where(fits), n, selected, False) if within is None else _counted(texts.where(fits), n, Members(utterances, within.join(selection, "utt_id", "left_anti")), True)
    rows = saved_table(rest.where(F.size("grams") > 0))
    before = _counted(texts, n, selected, True).select(F.explode(F.arrays_zip("grams", "counts")).alias("x")).groupBy("x.grams").agg(F.sum("x.counts").alias("have"))
    have = {r["grams"]: r["have"] for r in before.collect()}  # kinds of n-grams of the selection
    load = rows.agg(F.sum(F.size("grams")).alias("s")).first()["s"] or 0
    if not load:
        return spark.createDataFrame([], "utt_id long, sel_rank long")

    if load <= one_task:

        def alone(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("utt_id", ignore_index=True)
            ids, symbols = pdf["utt_id"].to_numpy(np.int64), pdf["symbols"].to_numpy(np.int64)
            flat, c, r = _flat(pdf)
            names, g = np.unique(np.concatenate([flat, np.array(list(have), dtype=np.int64)]), return_inverse=True)
            g, counts = g[: len(flat)], np.array([have.get(x, 0) for x in names.tolist()], dtype=np.int64)
            starts = np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(pdf)))])
            open_, left, taken = np.ones(len(pdf), dtype=bool), seconds, []
            while open_.any():
                score = np.where(open_, _scored(kind, g, c, r, len(pdf), counts), np.inf)
                at = int(np.argmin(score))
                if kind == "coverage" and score[at] == 0 and counts.any():
                    counts[:] = 0
                    continue
                if symbols[at] / speed > left + 1e-9:
                    break
                left -= symbols[at] / speed
                taken.append(int(ids[at]))
                np.add.at(counts, g[starts[at] : starts[at + 1]], c[starts[at] : starts[at + 1]])
                open_[at] = False
            return pd.DataFrame({"utt_id": np.array(taken, dtype=np.int64), "sel_rank": np.arange(len(taken))})

        return rows.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(lambda pdf: alone(pdf.drop(columns="one")), "utt_id long, sel_rank long")

    loop, many = _Loop(have, kind, seconds, speed), max(LEAST, -(-POOL // max(rows.rdd.getNumPartitions(), 1)))
    more = True
    while more:
        state = spark.sparkContext.broadcast((*loop.arrays(), np.array(loop.taken, dtype=np.int64)))
        asked = rows.mapInPandas(lambda parts: _offers(parts, state.value, kind, many), "utt_id long, symbols long, grams array<long>, counts array<long>, gain double, n long, least long")  # noqa: B023
        more = _picks(asked.collect(), loop)
        state.destroy()
    return spark.createDataFrame([(u, i) for i, u in enumerate(loop.taken)], "utt_id long, sel_rank long")


def kld_scores(utterances: DataFrame, selection: DataFrame, n: int, ignore: set[str] = frozenset()) -> DataFrame:
    """utt_id and kld: the divergence that each row would lead to that isn't selected; rows without n-grams are left out, and null where nothing is selected. Scored where the rows lie; the driver holds the kinds of n-grams with their counts."""
    spark = utterances.sparkSession
    marks = selection.select("utt_id", F.lit(True).alias("sel_"))
    rows = saved_table(counted_grams(gram_texts(utterances, set(ignore)), n).join(marks, "utt_id", "left"))
    every = rows.select("sel_", F.explode(F.arrays_zip("grams", "counts")).alias("x")).groupBy("x.grams").agg(F.coalesce(F.sum(F.when(F.col("sel_"), F.col("x.counts"))), F.lit(0)).alias("have"))
    names, have = np.array(sorted((r["grams"], r["have"]) for r in every.collect()), dtype=np.int64).reshape(-1, 2).T
    state = spark.sparkContext.broadcast((names, np.append(have, 0), math.log(max(len(names), 1))))

    def scored(parts):
        names, have, kinds = state.value
        for pdf in parts:
            grams, counts, at = _flat(pdf)
            gain, size = gains("kld", _known(names, grams), counts, at, len(pdf), have)
            yield pd.DataFrame({"utt_id": pdf["utt_id"], "kld": kinds + scores("kld", gain, size, have) if have.any() else np.nan})

    rest = rows.where(F.col("sel_").isNull() & (F.size("grams") > 0)).select("utt_id", "grams", "counts")
    return rest.mapInPandas(scored, "utt_id long, kld double")


def select_greedy(corpus, kind: str, n: int, minutes: float, **options):
    """The corpus with the newly selected ids after those it had."""
    from lectern.operators.selection import add

    new = greedy(corpus.utterances, corpus.selection, kind, n, minutes * 60, **options)
    return corpus.with_(selection=add(corpus.selection, new))


def kld_order(utterances: DataFrame, selection: DataFrame, ignore: set[str], parts: int = 1, take: int = 1) -> DataFrame:
    """The selection in greedy order of its 1-grams; with parts, that order is cut into equal runs, dealt in turns of take."""
    none = selection.limit(0)
    order = greedy(utterances, none, "kld", 1, ignore=ignore, within=selection)
    silent = selection.join(order, "utt_id", "left_anti").select("utt_id", (F.col("sel_rank") + (1 << 40)).alias("sel_rank"))
    from lectern.operators.selection import ranked

    order = ranked(order.union(silent), ["sel_rank"])
    if parts <= 1:
        return order
    length = max(-(-order.count() // parts), 1)
    part, place = F.floor(F.col("sel_rank") / length), F.col("sel_rank") % length
    return ranked(order.select("utt_id", F.floor(place / take).alias("turn"), part.alias("part"), place.alias("place")), ["turn", "part", "place"])
