"""What is unsuitable for recording: conditions that are true for rows to remove, and the filters that need the whole corpus."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators.affixes import accepted
from lectern.saving import saved


def has_acronym(text: Column, min_length: int = 3) -> Column:
    return F.exists(tx.stripped_words(text), lambda w: (F.length(w) >= min_length) & tx.is_upper(w))


def has_proper_name(text: Column, language: str = "eng") -> Column:
    """A word after the first one that starts with an ASCII capital other than I. English only."""
    if language != "eng":
        raise ValueError("proper names are found in English texts only")
    return tx.stripped_text(text).rlike(" [A-HJ-Z]")


def has_undesired(text: Column, undesired: Iterable[str]) -> Column:
    """One of the strings, in any case, anywhere in the text."""
    low = F.lower(text)
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(u.lower())) for u in sorted(set(undesired))], F.lit(False))


def word_count_outside(text: Column, least: int | None = None, most: int | None = None) -> Column:
    n = F.size(tx.split_words(text))
    low = n < least if least is not None else F.lit(False)
    return low | (n > most) if most is not None else low


def is_sentence(text: Column, language: str = "eng", symbols: str = "graphemes") -> Column:
    """Starts with a capital (written texts) and ends with one of . ! ?; of IPA only the end counts."""
    ends = F.coalesce(F.right(text, F.lit(1)).isin(".", "!", "?"), F.lit(False))
    if symbols == "ipa":
        return ends
    if symbols != "graphemes" or language not in ("eng", "ger"):
        raise ValueError("sentences are known in English, German and IPA")
    return ends & F.substring(text, 1, 1).rlike(r"\p{IsUppercase}")


def in_duration_band(symbols: Column, low: float = 0.0, high: float = float("inf"), speed: float = tx.READING_SPEED) -> Column:
    """low <= seconds < high."""
    seconds = tx.duration_s(symbols, speed)
    return (seconds >= low) & (seconds < high) if high != float("inf") else seconds >= low


def first_of_duplicates(df: DataFrame, column: str, order: str = "utt_id") -> DataFrame:
    """Of rows with one value the first in order stays. The rank limit works before the shuffle too, so a hot value sends one row a task."""
    rank = F.row_number().over(Window.partitionBy(column).orderBy(order))
    return df.withColumn("rank_", rank).where("rank_ = 1").drop("rank_")


#: Words that every task may hold when rows' words are looked up.
IN_PLACE = 200_000


def most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """Of rows with a number n, those of the largest n, at most so many. Rows with one n stay or go together, so nothing is sorted: how often each n is there tells the least that fits."""
    spread = counted.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).collect()
    least, rows = None, 0
    for r in sorted(spread, key=lambda r: -r["n"]):
        rows += r["rows"]
        if rows > most:
            break
        least = r["n"]
    return counted.where(F.col("n") >= least) if least is not None else counted.limit(0)


def occurrences(df: DataFrame, words: Column, sought: DataFrame, key: str = "utt_id", in_place: int = IN_PLACE) -> DataFrame:
    """key and word of each occurrence of a sought word. sought: word, distinct.

    Few sought words (by a count) are looked up where the rows lie. Of many, the most frequent words of all rows are answered
    there, be they sought or not; only the others are dealt by word, and none of them is frequent.
    """
    every = df.select(key, F.explode(words).alias("word"))
    sought = saved(sought.select("word"))
    if sought.count() <= in_place:
        return every.join(F.broadcast(sought), "word", "left_semi").select(key, "word")
    frequent = most_frequent(saved(every.groupBy("word").agg(F.count(F.lit(1)).alias("n"))), in_place).select("word")
    known = saved(frequent.join(sought.withColumn("sought_", F.lit(True)), "word", "left").select("word", F.coalesce("sought_", F.lit(False)).alias("sought_")))
    marked = every.join(F.broadcast(known), "word", "left")
    rest = marked.where(F.col("sought_").isNull()).join(sought, "word", "left_semi")
    return marked.where("sought_").select(key, "word").union(rest.select(key, "word"))


def unknown_words(df: DataFrame, column: str, lexicon: DataFrame, rules: list | None = None) -> DataFrame:
    """The corpus's distinct words that the lexicon has neither as written nor in lower case; with rules (affixes.Rule), those that it doesn't accept. lexicon: word, with rules also flags."""
    words = df.select(F.explode(tx.stripped_words(F.col(column))).alias("word")).distinct()
    if rules is not None:
        words = saved(words)
        return words.join(accepted(words, lexicon, rules), "word", "left_anti")
    known = lexicon.select(F.col("word").alias("known")).distinct()
    missing = words.join(known, words["word"] == known["known"], "left_anti")
    return missing.join(known, F.lower("word") == F.col("known"), "left_anti")


def unknown_word_counts(df: DataFrame, column: str, lexicon: DataFrame, key: str = "utt_id", rules: list | None = None, in_place: int = IN_PLACE) -> DataFrame:
    """key and n_unknown: words, with repeats, that the lexicon lacks. Only distinct words meet the lexicon."""
    found = occurrences(df, tx.stripped_words(F.col(column)), unknown_words(df, column, lexicon, rules), key, in_place)
    return found.groupBy(key).agg(F.count(F.lit(1)).alias("n_unknown"))


def without_unknown_words(df: DataFrame, column: str, lexicon: DataFrame, most: int, language: str = "eng", key: str = "utt_id", rules: list | None = None) -> DataFrame:
    """Rows with at most so many unknown words stay. English only."""
    if language != "eng":
        raise ValueError("unknown words are found in English texts only")
    bad = unknown_word_counts(df, column, lexicon, key, rules).where(F.col("n_unknown") > most).select(key)
    return df.join(bad, key, "left_anti")


def frequency_words(text: Column) -> Column:
    """Words whose frequency counts: of the stripped lower-case text, so a text of signs only has one empty word."""
    return tx.split_words(tx.stripped_text(F.lower(text)))


def word_frequencies(df: DataFrame, column: str) -> DataFrame:
    """word, frequency: occurrences in the corpus."""
    return df.select(F.explode(frequency_words(F.col(column))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))


def without_rare_words(df: DataFrame, column: str, least: int, key: str = "utt_id", in_place: int = IN_PLACE) -> DataFrame:
    """Rows whose every word occurs so often in the corpus stay. Frequent words are never dealt by word."""
    rare = word_frequencies(df, column).where(F.col("frequency") < least).select("word")
    found = occurrences(df, F.array_distinct(frequency_words(F.col(column))), rare, key, in_place)
    return df.join(found.select(key).distinct(), key, "left_anti")
