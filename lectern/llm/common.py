"""What several operators of this subpackage share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.saving import saved
from lectern.shipping import small_batches

__all__ = ["WORD", "any_of", "fresh", "positions", "salt_of", "saved", "size_band", "small_batches", "table", "with_facts", "word_count"]

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names as given, with underscores added where the frame has such a column already."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def salt_of(key: Column) -> Column:
    """Two hexadecimal digits (256 values) that spread rows by a key; the same in any SQL dialect with md5."""
    return F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 2)


def size_band(size: Column) -> Column:
    """A coarse, monotone class of a whole number >= 0: its number of digits and the first two of them (at most 90 a decade)."""
    text = size.cast("string")
    return F.length(text) * 100 + F.substring(F.rpad(text, 2, "0"), 1, 2).cast("int")


def positions(df: DataFrame, group: list[str], coarse: list[str], fine: list[str], out: str, facts: DataFrame | None = None) -> DataFrame:
    """Adds each row's 0-based gapless position within its group, in the order coarse + fine, and the facts known of its group.

    No window runs over a whole group: rows are ranked within (group, coarse), and the small table of counts by
    (group, coarse) gives each such bucket its first position. A good coarse order ends in salt_of(), so that a hot group
    is spread over many tasks. Facts (a row a group) come by way of the buckets' table, so they are neither broadcast nor
    joined to a hot group's rows by the group alone. Columns in group and coarse must not be null. The buckets' join needs no second shuffle
    of the rows, as they are already dealt by its key.
    """
    keys = [*group, *coarse]
    n, first, rank = fresh(df, "n_rows", "first_position", "rank_in_bucket")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(*group).orderBy(*coarse).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(first))
    if facts is not None:
        starts = starts.join(facts, group)
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*fine)) - 1)
    return ranked.join(starts, keys).withColumn(out, F.col(first) + F.col(rank)).drop(first, rank)


#: Facts of at most so many keys are broadcast; beyond, rows are salted in so many ways.
FEW, SALTS = 20_000, 32


def with_facts(rows: DataFrame, facts: DataFrame, keys: list[str], by: str, few: int = FEW) -> DataFrame:
    """rows with what facts says of their keys (one row a key; nulls meet nulls; rows without facts go).

    Facts of few keys are broadcast, by a count. More of them are repeated for every salt and rows are salted by a hash of the
    column `by`, so that a hot key is spread over tasks.
    """
    salt, *names = fresh(rows, "salt", *[f"its_{k}" for k in keys])
    facts = facts.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], *[c for c in facts.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)]
    if facts.count() <= few:
        return rows.join(F.broadcast(facts), reduce(lambda a, b: a & b, same)).drop(*names)
    spread = facts.withColumn(f"its_{salt}", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn(salt, F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    return salted.join(spread, reduce(lambda a, b: a & b, [*same, F.col(salt) == F.col(f"its_{salt}")])).drop(*names, salt, f"its_{salt}")


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
