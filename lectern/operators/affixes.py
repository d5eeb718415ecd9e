"""Words that a dictionary of stems and affixes accepts.

A dictionary lists stems with flags; a flag names rules, each of which takes letters off a stem's end (or beginning) that
must look a certain way, and puts others there. Forms are never listed: every distinct word is taken apart instead. Each of
its endings and beginnings meets the rules that make it (a table of counted size), what remains is a candidate stem with the
flags it would need, and the candidates meet the dictionary once. So the work grows with the distinct words, and the
dictionary may be as large as it likes.

A word may have one ending and one beginning, if both rules may be crossed. It counts as written, and with a
capital first letter also in small letters; all in capitals, with a capital first letter too. Rules that lead to further rules aren't followed.

Cases: null and empty words are unknown; stems listed twice count with the flags of both; a rule for a flag that no stem has accepts nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.saving import few_joined, saved


@dataclass(frozen=True)
class Rule:
    """take off `strip`, put on `add`, where the stem's end (suffix) or beginning matches the condition, a regular expression."""

    flag: str
    strip: str
    add: str
    condition: str = "."
    suffix: bool = True
    cross: bool = True


def rules_of(lines: Iterable[str]) -> tuple[list[Rule], str]:
    """The rules of an .aff file, and how it writes flags: short, long, num or UTF-8."""
    kind, cross, out = "short", {}, []
    for line in lines:
        parts = line.split()
        if parts[:1] == ["FLAG"] and len(parts) > 1:
            kind = parts[1]
        elif parts[:1] in (["SFX"], ["PFX"]) and len(parts) == 4 and (parts[0], parts[1]) not in cross:
            cross[parts[0], parts[1]] = parts[2] == "Y"
        elif parts[:1] in (["SFX"], ["PFX"]) and len(parts) >= 4:
            none = lambda x: "" if x == "0" else x
            out.append(Rule(parts[1], none(parts[2]), none(parts[3].partition("/")[0]), parts[4] if len(parts) > 4 else ".", parts[0] == "SFX", cross[parts[0], parts[1]]))
    return out, kind


def flags_of(text: Column, kind: str = "short") -> Column:
    """The flags of a stem, of their text in a .dic file."""
    if kind == "num":
        return F.filter(F.split(text, ","), lambda f: f != "")
    return F.regexp_extract_all(text, F.lit(r"(?s).." if kind == "long" else r"(?s)."), F.lit(0))


def read_dictionary(spark, dic: str, aff: str) -> tuple[DataFrame, list[Rule]]:
    """Stems (word, flags) of a .dic file, read by executors, and the rules of its .aff file, which are some thousand lines at most."""
    rules, kind = rules_of(r["value"] for r in spark.read.text(aff).toLocalIterator())
    lines = spark.read.text(dic).where(~F.col("value").rlike(r"^\d+\s*$") & ~tx.is_blank(F.col("value")))
    entry = F.split(F.regexp_replace("value", r"\\/", "\u0001"), r"[ \t]", 2)[0]  # a slash that belongs to the word is escaped
    word = F.replace(F.split(entry, "/", 2)[0], F.lit("\u0001"), F.lit("/"))
    flags = F.coalesce(F.try_element_at(F.split(entry, "/", 2), F.lit(2)), F.lit(""))
    return lines.select(word.alias("word"), flags_of(flags, kind).alias("flags")), rules


def _rule_table(spark, rules: list[Rule]) -> DataFrame:
    rows = [(r.flag, r.strip, r.add, f"(?:{r.condition})$" if r.suffix else f"^(?:{r.condition})", r.suffix, r.cross, len(r.add)) for r in rules]
    return spark.createDataFrame(rows, "flag string, strip string, add string, condition string, suffix boolean, crossing boolean, size int")


def spellings(word: Column) -> Column:
    """How a word may be listed."""
    low = F.lower(word)
    title = F.concat(F.upper(F.substring(word, 1, 1)), F.substring(low, F.lit(2), F.length(word)))
    capital = tx.is_upper(F.substring(word, 1, 1))
    return F.array_distinct(F.filter(F.array(word, F.when(tx.is_upper(word) | (capital & (word == title)), low), F.when(tx.is_upper(word), title)), lambda w: w.isNotNull()))


def _taken_off(forms: DataFrame, rules: DataFrame, suffix: bool, sizes: list[int]) -> DataFrame:
    """forms (word, form, needs, crossed) with one affix less: each that a rule makes."""
    form = F.col("form")
    end = lambda k: (F.substring(form, F.length(form) - k + 1, F.lit(k)) if k else F.lit("")) if suffix else F.substring(form, 1, k)
    ends = F.array_distinct(F.array(*[F.when(F.length(form) >= k, end(k)) for k in sizes]))
    parted = forms.select("*", F.explode(F.filter(ends, lambda x: x.isNotNull())).alias("add"))
    met = parted.join(F.broadcast(rules.where(F.col("suffix") == suffix)), "add")
    rest = F.substring(form, F.lit(1), F.length(form) - F.col("size")) if suffix else F.substring(form, F.col("size") + 1, F.length(form))
    stem = F.concat(rest, F.col("strip")) if suffix else F.concat(F.col("strip"), rest)
    return met.withColumn("stem", stem).where(F.rlike("stem", F.col("condition")) & (F.col("stem") != "")).select("word", F.col("stem").alias("form"), F.array_append("needs", F.col("flag")).alias("needs"), F.col("crossing").alias("cross"))


def candidates(words: DataFrame, rules: list[Rule]) -> DataFrame:
    """word, stem and needs (flags) of all that distinct words may come from."""
    spark = words.sparkSession
    plain = words.where(F.col("word").isNotNull() & (F.col("word") != ""))
    plain = plain.select("word", F.explode(spellings(F.col("word"))).alias("form"), F.array().cast("array<string>").alias("needs"), F.lit(True).alias("cross"))
    table = _rule_table(spark, rules)
    sizes = {s: sorted({len(r.add) for r in rules if r.suffix == s}) for s in (True, False)}
    out = plain
    ends = _taken_off(plain, table, True, sizes[True]) if sizes[True] else plain.limit(0)
    out = out.union(ends)
    if sizes[False]:
        out = out.union(_taken_off(plain, table, False, sizes[False]))
        crossed = _taken_off(ends.where("cross"), table.where("crossing"), False, sizes[False])
        out = out.union(crossed)
    return out.select("word", F.col("form").alias("stem"), "needs")


def accepted(words: DataFrame, stems: DataFrame, rules: list[Rule]) -> DataFrame:
    """The words (distinct, column word) that a dictionary of stems (word, flags) accepts."""
    listed = stems.groupBy(F.col("word").alias("stem")).agg(F.array_distinct(F.flatten(F.collect_list(F.coalesce("flags", F.array().cast("array<string>"))))).alias("flags"))
    met = few_joined(candidates(words, rules), saved(listed), ["stem"])
    return met.where(F.size(F.array_except("needs", "flags")) == 0).select("word").distinct()
