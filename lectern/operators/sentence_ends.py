"""Sentence ends that are learned from the corpus itself.

A full stop ends a sentence or belongs to an abbreviation, an ordinal number or an initial. What is an abbreviation shows in
counts (Kiss and Strunk): it nearly always has its stop, and it is short; a log-likelihood ratio against the stops of all
words is weighed by the word's letters, its inner stops and how often it stands without one. Words that follow an
abbreviation more often than chance are collocations with it. One pass counts words, stops and what follows them; from that
table all pairs that may be met are decided, and a second pass cuts the texts where no pair holds them together.

Behind an abbreviation, a number or an initial a sentence goes on if the next word has no capital letter, or has one and is
never written small (a name, a German noun), or the stop is an initial's, or both are a collocation. Otherwise, and behind any other word
and behind ! and ?, it ends.

Cases: null texts count nothing and have no sentences; empty ones have one empty sentence; a text without words is one sentence; repeated rows count each;
very long texts are cut whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.saving import few_joined, saved

#: Fixed values of the published method: the least score of an abbreviation, the chance of a stop behind one, the least ratio of a collocation.
LEAST_SCORE, STOP, LEAST_RATIO = 0.3, 0.99, 7.88
WHITE = r" \t\n\x0B\f\r"
#: In place of a number.
NUMBER = "#"
#: Pairs that every task may hold.
IN_PLACE = 200_000
_CUT, _IN = "\u0001", "\u0002"


def kind_of(token: Column) -> Column:
    """The word of a token: in small letters, without signs at its ends; numbers are all one."""
    return _kind(tx.strip_punctuation(token))


def _kind(bare: Column) -> Column:
    return F.when(bare.rlike("^[0-9]+$"), F.lit(NUMBER)).otherwise(F.lower(bare))


def has_stop(token: Column) -> Column:
    return F.endswith(token, F.lit("."))


def has_capital(token: Column) -> Column:
    return tx.strip_punctuation(token).rlike(r"^\p{Lu}")


def token_counts(texts: Column, df: DataFrame) -> DataFrame:
    """kind, stop, small (written with a small first letter), next (kind behind a stop, else null), capital (of that one), n. Only counts are shuffled."""
    tokens = F.regexp_extract_all(texts, F.lit(f"[^{WHITE}]+"), F.lit(0))
    rows = df.select(tokens.alias("t")).select(F.explode(F.arrays_zip("t", F.concat(F.slice("t", 2, F.greatest(F.size("t"), F.lit(1))), F.array(F.lit(None).cast("string"))).alias("u"))).alias("x"))
    rows = rows.select(F.col("x.t").alias("t"), F.when(has_stop(F.col("x.t")), F.col("x.u")).alias("u")).groupBy("t", "u").agg(F.count(F.lit(1)).alias("n"))  # what a token is, is found once for each that differs
    kinds = rows.select(kind_of(F.col("t")).alias("kind"), has_stop(F.col("t")).alias("stop"), tx.strip_punctuation(F.col("t")).rlike(r"^\p{Ll}").alias("small"), kind_of(F.col("u")).alias("next"), has_capital(F.col("u")).alias("capital"), "n")
    return kinds.groupBy("kind", "stop", "small", "next", "capital").agg(F.sum("n").alias("n"))


def abbreviation_score(with_stop: Column, without: Column, kind: Column, tokens: Column, stops: Column) -> Column:
    p = stops / tokens
    ratio = -2 * (with_stop * F.ln(p) + without * F.ln(1 - p) - with_stop * F.ln(F.lit(STOP)) - without * F.ln(F.lit(1 - STOP)))
    letters = F.length(F.replace(kind, F.lit("."), F.lit("")))
    inner = F.length(kind) - letters
    return ratio * F.exp(-letters) * (inner + 1) * F.pow(letters, -without)


def collocation_ratio(both: Column, first: Column, second: Column, tokens: Column) -> Column:
    """Twice the gain in log-likelihood of a second word whose chance depends on the first one."""
    part = lambda k, n, x: F.when(k > 0, k * F.ln(x)).otherwise(0.0) + F.when(n - k > 0, (n - k) * F.ln(1 - x)).otherwise(0.0)
    rest, others = second - both, tokens - first
    p, p1, p2 = second / tokens, both / first, rest / others
    return 2 * (part(both, first, p1) + part(rest, others, p2) - part(both, first, p) - part(rest, others, p))


@dataclass
class Ends:
    """abbreviations: kind and score. held: pair (as `pair` writes it) of what belongs together."""

    abbreviations: DataFrame
    held: DataFrame


def pair(token: Column, follower: Column) -> Column:
    bare = F.transform(F.array(token, follower), tx.strip_punctuation)  # bound, so that each is stripped once
    made = F.transform(F.array(bare), lambda b: F.concat(_kind(b[0]), F.lit(_IN), _kind(b[1]), F.lit(_IN), F.when(b[1].rlike(r"^\p{Lu}"), "A").otherwise("a")))
    return made[0]


def learn(df: DataFrame, column: str) -> Ends:
    counts = saved(token_counts(F.col(column), df))
    when = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    kinds = saved(counts.groupBy("kind").agg(when(F.col("stop")).alias("with_stop"), when(~F.col("stop")).alias("without"), when(F.col("small")).alias("small"), F.sum("n").alias("all_")))
    whole = kinds.agg(F.coalesce(F.sum("all_"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("with_stop"), F.lit(0)).alias("stops")).first()
    tokens, stops = (F.lit(float(max(whole[c], 1))) for c in ("tokens", "stops"))
    score = abbreviation_score(F.col("with_stop"), F.col("without"), F.col("kind"), tokens, stops)
    short = saved(kinds.where((F.col("with_stop") > 0) & F.col("kind").rlike(r"\p{L}")).withColumn("score", score).where(F.col("score") >= LEAST_SCORE).select("kind", "score"))

    pairs = counts.where("stop AND next IS NOT NULL").groupBy("kind", "next", "capital").agg(F.sum("n").alias("n"))
    together = pairs.groupBy("kind", "next").agg(F.sum("n").alias("both"))
    unsure = (F.col("kind") == NUMBER) | F.col("kind").rlike(r"^\p{L}$")
    met = few_joined(pairs, short.withColumn("short", F.lit(True)), ["kind"], "left").where(unsure | F.col("short"))
    met = met.join(together, ["kind", "next"]).join(kinds.select("kind", F.col("with_stop").alias("first")), "kind")
    met = met.join(kinds.select(F.col("kind").alias("next"), F.col("all_").alias("second"), "small"), "next")
    likely = (F.col("both") > 1) & (F.col("both") / F.col("first") > F.col("second") / tokens) & (collocation_ratio(F.col("both"), F.col("first"), F.col("second"), tokens) >= LEAST_RATIO)
    goes_on = ~F.col("capital") | (F.col("small") == 0) | F.col("kind").rlike(r"^\p{L}$") | (F.coalesce("short", F.lit(False)) & likely)
    held = met.where(goes_on).select(F.concat("kind", F.lit(_IN), "next", F.lit(_IN), F.when(F.col("capital"), "A").otherwise("a")).alias("pair"))
    return Ends(short, saved(held))


def _cut(parts: list, pairs: list, held) -> list[str]:
    """Parts and the white space between them, in turn, as sentences."""
    out = [parts[0]]
    for k, p in enumerate(pairs):
        if p in held:
            out[-1] += parts[2 * k + 1] + parts[2 * k + 2]
        else:
            out.append(parts[2 * k + 2])
    return out


def split(df: DataFrame, column: str, ends: Ends, out: str = "sentences", key: str = "utt_id", in_place: int = IN_PLACE) -> DataFrame:
    """df with the array of a text's sentences. Held pairs of a counted number are looked up where the rows lie; more of them come by a join on the pairs that rows have, and key tells rows apart then."""
    met = rf"(?<![^{WHITE}])([^{WHITE}]++)(?<=[.!?])([{WHITE}]+)(?=([^{WHITE}]*))"  # words before and behind each place where a text may be cut
    marked = F.split(F.regexp_replace(F.col(column), met, f"$1{_CUT}$2{_CUT}$1{_CUT}$3{_CUT}"), _CUT)  # in turn a part, the white space behind it, its last word and the next one
    parts = F.filter(marked, lambda x, i: i % 4 < 2)
    last, first = (F.filter(marked, lambda x, i: i % 4 == k) for k in (2, 3))  # noqa: B023
    pairs = F.transform(F.arrays_zip(last.alias("t"), first.alias("u")), lambda x: F.when(has_stop(x["t"]), pair(x["t"], x["u"])))
    if ends.held.count() <= in_place:
        held = df.sparkSession.sparkContext.broadcast({r["pair"] for r in ends.held.collect()})
        cut = F.pandas_udf(lambda a, b: pd.Series([None if x is None else _cut(list(x), list(y), held.value) for x, y in zip(a, b, strict=True)]), "array<string>")
        return df.withColumn(out, cut(parts, pairs))
    from lectern.operators.filters import occurrences

    found = occurrences(df, F.filter(F.array_distinct(pairs), lambda p: p.isNotNull()), ends.held.withColumnRenamed("pair", "word"), key, in_place)
    held_by = saved(found.groupBy(key).agg(F.collect_set("word").alias("held_")))
    cut = F.pandas_udf(lambda a, b, h: pd.Series([None if x is None else _cut(list(x), list(y), set(z) if z is not None else ()) for x, y, z in zip(a, b, h, strict=True)]), "array<string>")
    return few_joined(df, held_by, [key], "left").withColumn(out, cut(parts, pairs, F.col("held_"))).drop("held_")
