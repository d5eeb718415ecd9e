"""Statistics of a corpus and its selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators.grams import gram_counts, symbols_of_gram
from lectern.operators.ids import with_dense_ids
from lectern.saving import saved
from lectern.sources.one_file import table_line, write_file


def flagged(utterances: DataFrame, selection: DataFrame) -> DataFrame:
    """utterances with selected (boolean)."""
    marks = selection.select("utt_id", F.lit(True).alias("selected"))
    return utterances.join(marks, "utt_id", "left").withColumn("selected", F.coalesce("selected", F.lit(False)))


def ngram_stats(rows: DataFrame, n: int, column: str = "repr_syms") -> DataFrame:
    """ngram, counts and percentages of selected, other and all rows; a class without n-grams has NaN percentages. rows: with selected."""
    counted = gram_counts(rows, n, column, "selected").select("gram", F.col("yes").alias("selected"), F.col("no").alias("not_selected"), (F.col("yes") + F.col("no")).alias("total"))
    counted = saved(counted)  # kinds of n-grams, used twice
    totals = counted.agg(*[F.sum(c).alias(f"all_{c}") for c in ("selected", "not_selected", "total")])
    percent = lambda c: F.when(F.col(f"all_{c}") == 0, F.lit(float("nan"))).otherwise(100 * F.col(c) / F.col(f"all_{c}")).alias(f"{c}_pct")
    return counted.crossJoin(F.broadcast(totals)).select(symbols_of_gram(F.col("gram")).alias("ngram"), "selected", "not_selected", "total", *[percent(c) for c in ("selected", "not_selected", "total")])


def general_stats(rows: DataFrame, speed: float = tx.READING_SPEED) -> DataFrame:
    """A row for selected and for other rows: entries, symbols, time, and least, mean, median and most of words and seconds."""
    words, symbols = F.size(tx.split_words(F.col("reading"))), F.size("reading_syms")
    counted = rows.select("selected", words.alias("words"), symbols.cast("long").alias("symbols"))
    four = lambda c, to: [F.min(c).alias(f"{to}_min"), F.avg(c).alias(f"{to}_mean"), F.median(c).alias(f"{to}_median"), F.max(c).alias(f"{to}_max")]
    out = counted.groupBy("selected").agg(F.count(F.lit(1)).alias("entries"), F.sum("symbols").alias("symbols"), *four("words", "words"), *four("symbols", "seconds"))
    seconds = {f"seconds_{k}": F.round(F.col(f"seconds_{k}") / speed, 6) for k in ("min", "mean", "median", "max")}
    return out.withColumns(seconds | {"words_mean": F.round("words_mean", 6), "minutes": F.round(F.col("symbols") / speed / 60, 6), "hours": F.round(F.col("symbols") / speed / 3600, 6)})


def duration_histogram(rows: DataFrame, speed: float = tx.READING_SPEED) -> DataFrame:
    """By rounded second (halves to the even one): utterances, their seconds, share of all seconds and running share."""
    second = F.bround(tx.duration_s(F.col("reading_syms"), speed), 0).cast("long")
    by = rows.groupBy(second.alias("second")).agg(F.count(F.lit(1)).alias("utterances")).withColumn("seconds", F.col("second") * F.col("utterances"))
    upto = Window.orderBy("second").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row for each second
    every = Window.partitionBy()
    share = lambda part: F.when(F.sum("seconds").over(every) == 0, F.lit(0.0)).otherwise(F.round(100 * part / F.sum("seconds").over(every), 6))
    return by.select("second", "utterances", "seconds", share(F.col("seconds")).alias("pct"), share(F.sum("seconds").over(upto)).alias("running_pct"))


def symbol_inventory(rows: DataFrame, column: str = "repr_syms") -> DataFrame:
    """selected and its distinct symbols, sorted."""
    pairs = rows.select("selected", F.explode(column).alias("symbol")).distinct()
    return pairs.groupBy("selected").agg(F.array_sort(F.collect_list("symbol")).alias("symbols"))


def selected_seconds(rows: DataFrame, speed: float = tx.READING_SPEED) -> Column:
    return F.sum(F.size("reading_syms")) / speed


def durations_of(rows: DataFrame, ids: DataFrame, speed: float = tx.READING_SPEED) -> DataFrame:
    """utt_id and seconds of the rows with the ids."""
    return rows.join(ids.select("utt_id").distinct(), "utt_id", "left_semi").select("utt_id", tx.duration_s(F.col("reading_syms"), speed).alias("seconds"))


def write_ngram_csv(rows: DataFrame, n: int, directory: str, column: str = "repr_syms") -> None:
    """n_gram_stats.csv, parted by tabs, in the order of n-grams: one file, whose parts executors write. The column names are fixed values."""
    names = [f"{n}-gram", "Selected #", "Not selected #", "Total #", "Selected %", "Not selected %", "Total %"]
    table = with_dense_ids(ngram_stats(rows, n, column), ["ngram"], "place").withColumn("ngram", F.array_join("ngram", ""))
    write_file(table.select("place", table_line([c for c in table.columns if c != "place"]).alias("line")), f"{directory}/{n}_gram_stats.csv", head="\t".join(names) + "\n", after="\n")


def removal_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """removed, kept and removed_pct of an operator."""
    counts = before.agg(F.count(F.lit(1)).alias("n")).crossJoin(after.agg(F.count(F.lit(1)).alias("kept")))
    return counts.select((F.col("n") - F.col("kept")).alias("removed"), "kept", F.when(F.col("n") > 0, F.round(100 * (F.col("n") - F.col("kept")) / F.col("n"), 6)).otherwise(0.0).alias("removed_pct"))


def selection_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """added, removed and kept ids of a selection."""
    sides = before.select("utt_id", F.lit(1).alias("was"), F.lit(0).alias("is_")).union(after.select("utt_id", F.lit(0), F.lit(1)))
    each = sides.groupBy("utt_id").agg(F.max("was").alias("was"), F.max("is_").alias("is_"))
    return each.agg(F.count_if(F.col("was") < F.col("is_")).alias("added"), F.count_if(F.col("was") > F.col("is_")).alias("removed"), F.count_if(F.col("was") == F.col("is_")).alias("kept"))


def distinct_counts(rows: DataFrame, column: str = "repr") -> DataFrame:
    """Different texts, and different words in them, case folded."""
    texts = rows.agg(F.count_distinct(column).alias("texts"))
    words = rows.select(F.explode(tx.stripped_words(F.lower(column))).alias("word")).agg(F.count_distinct("word").alias("words"))
    return texts.crossJoin(words)


def preview(rows: DataFrame, n: int = 10) -> DataFrame:
    """The rows with the smallest ids, and how many more there are."""
    return rows.orderBy("utt_id").limit(n).select("utt_id", "repr").crossJoin(rows.agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).alias("further")))
