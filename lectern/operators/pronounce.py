"""Pronunciations of words that no lexicon has, by a joint model of letters and phones learned from one.

A word and its phones are cut into units, each a few letters with the phones that they stand for; silent letters have none.
Alignment: expectation maximisation over all ways to cut (forward and backward sums, word by word), then each word's
likeliest cut. Model: n-grams of units, each order mixed with the next lower one by the number of different units seen behind
a history (Witten and Bell). Decoding: the likeliest units over a word's letters, exact (Viterbi over histories).

Everything that is added up is a whole number (expected counts and costs in millionths), so the model and the phones are
the same however rows are dealt. The driver holds the units (a few letters and phones, so some thousand) and the n-grams,
which MOST_GRAMS bounds: an order with more of them is left out. Lexicon and words stay on executors.

Cases: words without letters or phones, null ones, and those whose phones don't fit their letters teach nothing; a word's repeated rows
count each; letters that no unit has are skipped; an empty word has no phones; of units equally likely the first in the alphabet wins.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.saving import saved

#: Letters and phones of a unit: one of the two is single.
SHAPES = ((1, 0), (1, 1), (1, 2), (2, 1))
#: Units of an n-gram, rounds of alignment, and n-grams that the model may hold.
ORDER, ROUNDS, MOST_GRAMS = 3, 8, 2_000_000
#: Counts and costs are whole numbers of this part; the cost of skipping a letter.
PART, SKIP = 1_000_000, 20_000_000
START, END = -1, -2
#: Letters of a word that teaches; longer ones are no words, and aligning takes the product of letters and phones.
LONGEST = 64

Unit = tuple[str, tuple[str, ...]]


def _cuts(letters: str, phones: list[str], shapes) -> Iterator[tuple[int, int, int, int, Unit]]:
    """Every unit that fits, by where it begins and ends."""
    for i in range(len(letters)):
        for j in range(len(phones) + 1):
            for a, b in shapes:
                if i + a <= len(letters) and j + b <= len(phones):
                    yield i, j, i + a, j + b, (letters[i : i + a], tuple(phones[j : j + b]))


def expected(letters: str, phones: list[str], weight: dict[Unit, float] | None, shapes=SHAPES) -> dict[Unit, float]:
    """How often each unit is expected in the word's cut. weight None: all units alike."""
    cuts = [(i, j, k, m, u, 1.0 if weight is None else weight.get(u, 0.0)) for i, j, k, m, u in _cuts(letters, phones, shapes)]
    ahead, behind = Counter({(0, 0): 1.0}), Counter({(len(letters), len(phones)): 1.0})
    for i, j, k, m, _, w in cuts:
        if w and (at := ahead[i, j]):
            ahead[k, m] += at * w
    for i, j, k, m, _, w in reversed(cuts):
        if w and (at := behind[k, m]):
            behind[i, j] += at * w
    whole, out = ahead[len(letters), len(phones)], Counter()
    if whole > 0:
        for i, j, k, m, u, w in cuts:
            if w and (share := ahead[i, j] * w * behind[k, m] / whole):
                out[u] += share
    return out


def best_cut(letters: str, phones: list[str], cost: dict[Unit, int], shapes=SHAPES) -> tuple[Unit, ...] | None:
    """The cheapest cut, the first in the alphabet of several."""
    best: dict[tuple[int, int], tuple[int, tuple]] = {(0, 0): (0, ())}
    for i, j, k, m, u in _cuts(letters, phones, shapes):
        if u in cost and (i, j) in best:
            c, units = best[i, j]
            here = (c + cost[u], (*units, u))
            if (k, m) not in best or here < best[k, m]:
                best[k, m] = here
    found = best.get((len(letters), len(phones)))
    return found and found[1]


def _cost(p: float) -> int:
    return round(-math.log(p) * PART)


class Pronouncer:
    """Units and n-gram counts. grams: (history, unit) -> count, of all orders; units by number."""

    def __init__(self, units: list[Unit], grams: dict[tuple[int, ...], int], order: int) -> None:
        self.units, self.order = units, order
        self.grams = grams
        self.sums: dict[tuple[int, ...], tuple[int, int]] = {}
        for gram, n in grams.items():
            total, kinds = self.sums.get(gram[:-1], (0, 0))
            self.sums[gram[:-1]] = (total + n, kinds + 1)
        self.of: dict[str, list[int]] = {}
        for number, (letters, _) in enumerate(units):
            self.of.setdefault(letters, []).append(number)
        self.longest = max(map(len, self.of), default=0)
        self._known: dict[tuple[int, ...], int] = {}
        self._lower: dict[tuple[int, ...], float] = {}
        self._names: list[tuple[int, ...]] = []
        self._numbers: dict[tuple[int, ...], int] = {}
        self._moves: dict[str, dict[int, list]] = {}

    def share(self, history: tuple[int, ...], unit: int) -> float:
        if not history:
            return self.grams.get((unit,), 0) / self.sums[()][0]
        if (key := (*history[1:], unit)) not in self._lower:  # many histories share it
            if len(self._lower) > 1_000_000:
                self._lower.clear()
            self._lower[key] = self.share(history[1:], unit)
        lower = self._lower[key]
        total, kinds = self.sums.get(history, (0, 0))
        return (self.grams.get((*history, unit), 0) + kinds * lower) / (total + kinds) if total else lower

    def cost(self, history: tuple[int, ...], unit: int) -> int:
        key = (*history, unit)
        if key not in self._known:
            if len(self._known) > 1_000_000:
                self._known.clear()
            self._known[key] = _cost(self.share(history, unit))
        return self._known[key]

    def start(self) -> tuple[int, ...]:
        return (START,) * (self.order - 1)

    def after(self, history: tuple[int, ...], unit: int) -> tuple[int, ...]:
        return (*history, unit)[1:] if self.order > 1 else ()

    def moves(self, history: int, letters: str) -> list[tuple[int, int, int]]:
        """Where units with these letters lead: the next history, the cost, the unit. Histories by number."""
        held, name = self._moves.setdefault(letters, {}), self._names[history]
        held[history] = [(self._number(self.after(name, u)), self.cost(name, u), u) for u in self.of.get(letters, ())]
        return held[history]

    def _number(self, history: tuple[int, ...]) -> int:
        if history not in self._numbers:
            self._numbers[history] = len(self._names)
            self._names.append(history)
        return self._numbers[history]

    def decode(self, word: str) -> list[str]:
        """Phones of a word in small letters."""
        return self.decode_all([word])[0]

    def decode_all(self, words: list[str | None]) -> list[list[str] | None]:
        """Phones of words in small letters. They are gone through by the alphabet, so that what words begin with in common is decoded once."""
        out: list[list[str] | None] = [None if w is None else [] for w in words]
        if not self.units:
            return out
        if len(self._names) > 200_000:
            self._names, self._numbers, self._moves = [], {}, {}
        ends: list[dict[int, tuple[int, tuple]]] = [{self._number(self.start()): (0, ())}]  # by history: cost and units of the cheapest way
        last = ""
        for w in sorted((k for k, x in enumerate(words) if x is not None), key=words.__getitem__):
            word, same = words[w], 0
            for a, b in zip(word, last, strict=False):
                if a != b:
                    break
                same += 1
            done = max(same - self.longest + 1, 0)  # a letter is skipped by what the next ones are, so the states behind it hang on those
            del ends[done + 1 :]
            ends += [{} for _ in range(len(word) - done)]
            for i in range(max(done - self.longest + 1, 0), len(word)):
                pieces = [p for p in (word[i : i + a] for a in range(1, min(self.longest, len(word) - i) + 1)) if p in self.of]
                for piece in pieces:
                    if i + len(piece) > done:
                        states, known = ends[i + len(piece)], self._moves.setdefault(piece, {})
                        for history, (cost, path) in ends[i].items():
                            for state, more, unit in known.get(history) or self.moves(history, piece):
                                old, c = states.get(state), cost + more
                                if old is None or c < old[0] or (c == old[0] and (*path, unit) < old[1]):
                                    states[state] = (c, (*path, unit))
                if not pieces and i + 1 > done:
                    states = ends[i + 1]
                    for history, (cost, path) in ends[i].items():
                        here = (cost + SKIP, path)
                        if history not in states or here < states[history]:
                            states[history] = here
            _, path = min((cost + self.cost(self._names[history], END), path) for history, (cost, path) in ends[-1].items())
            out[w], last = [p for unit in path for p in self.units[unit][1]], word
        return out

    def phones(self, word: Column) -> Column:
        """Of words in small letters, in Arrow batches; null for null. Rows in the words' order are decoded in a part of the time."""
        return F.pandas_udf(lambda words: pd.Series(self.decode_all(words.tolist()), dtype=object), "array<string>")(word)


def _numbered(lexicon: DataFrame) -> DataFrame:
    """Rows that can teach."""
    there = F.col("word").isNotNull() & F.col("phones").isNotNull() & ~F.exists("phones", lambda p: p.isNull())
    return lexicon.select("word", "phones").where(there & (F.length("word").between(1, LONGEST)) & (F.size("phones").between(1, LONGEST)))


def learn(lexicon: DataFrame, order: int = ORDER, shapes=SHAPES, rounds: int = ROUNDS, most_grams: int = MOST_GRAMS) -> Pronouncer:
    """lexicon: word (small letters), phones."""
    rows = saved(_numbered(lexicon))
    weight: dict[Unit, float] | None = None
    letters_and_phones = "letters string, phones array<string>, n long"
    for _ in range(rounds):
        now = weight

        def counted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in parts:
                total: Counter = Counter()
                for word, phones in zip(pdf["word"], pdf["phones"], strict=True):
                    total.update({u: round(x * PART) for u, x in expected(word, list(phones), now, shapes).items()})  # noqa: B023
                yield pd.DataFrame([(u[0], list(u[1]), n) for u, n in total.items() if n], columns=["letters", "phones", "n"])

        counts = rows.mapInPandas(counted, letters_and_phones).groupBy("letters", "phones").agg(F.sum("n").alias("n")).collect()  # units, by the alphabets
        whole = sum(r["n"] for r in counts)
        weight = {(r["letters"], tuple(r["phones"])): r["n"] / whole for r in counts}
    cost = {u: _cost(w) for u, w in (weight or {}).items()}
    units = sorted(cost)
    number = {u: k for k, u in enumerate(units)}

    def grams(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            total: Counter = Counter()
            for word, phones in zip(pdf["word"], pdf["phones"], strict=True):
                if (cut := best_cut(word, list(phones), cost, shapes)) is not None:
                    line = [START] * (order - 1) + [number[u] for u in cut] + [END]
                    total.update(tuple(line[at - k : at + 1]) for at in range(order - 1, len(line)) for k in range(order))
            yield pd.DataFrame([(list(g), n) for g, n in total.items()], columns=["gram", "n"])

    seen = saved(rows.mapInPandas(grams, "gram array<int>, n long").groupBy("gram").agg(F.sum("n").alias("n")))
    sizes = {r["k"]: r["count"] for r in seen.groupBy(F.size("gram").alias("k")).count().collect()}
    kept = 0
    while kept < order and sum(sizes.get(k, 0) for k in range(1, kept + 2)) <= most_grams:
        kept += 1
    held = {tuple(r["gram"]): r["n"] for r in seen.where(F.size("gram") <= kept).collect()}
    used = sorted({g[-1] for g in held if g[-1] >= 0})  # units that no cut has are gone
    again = {old: new for new, old in enumerate(used)} | {START: START, END: END}
    return Pronouncer([units[u] for u in used], {tuple(again[u] for u in g): n for g, n in held.items()}, max(kept, 1))


def edits(a: list[str], b: list[str]) -> int:
    """Phones to insert, leave out or change."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def phone_errors(lexicon: DataFrame, model: Pronouncer) -> DataFrame:
    """words, right (words without an error), phones and errors (edits) of a lexicon that the model has not learned from."""
    rows = _numbered(lexicon).select("phones", model.phones(F.col("word")).alias("said"))
    errors = F.pandas_udf(lambda a, b: pd.Series([edits(list(x), list(y)) for x, y in zip(a, b, strict=True)], dtype="int64"), "long")(F.col("phones"), F.col("said"))
    rows = rows.select(F.size("phones").alias("n"), errors.alias("e"))
    return rows.agg(F.count(F.lit(1)).alias("words"), F.sum((F.col("e") == 0).cast("long")).alias("right"), F.sum("n").alias("phones"), F.sum("e").alias("errors"))
