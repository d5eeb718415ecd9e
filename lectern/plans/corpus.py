"""A corpus as four tables that operators take and return."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as tx

CORPUS_SCHEMA = "utt_id long, path_id long, line_nr int, reading string, reading_syms array<string>, repr string, repr_syms array<string>"
SELECTION_SCHEMA = "utt_id long, sel_rank long"
PATHS_SCHEMA = "path_id long, path string"
TARGETS = ("reading", "repr")


@dataclass(frozen=True)
class Corpus:
    """utterances, ordered selection of ids, paths, and what holds for whole columns."""

    utterances: DataFrame
    selection: DataFrame
    paths: DataFrame
    language: str = "eng"
    reading_format: str = "graphemes"
    repr_format: str = "graphemes"
    #: The selection before rows were removed: it meets what is left once, however many steps removed rows.
    whole: DataFrame | None = None

    def with_(self, **changes) -> Corpus:
        return replace(self, **({"whole": None} if "selection" in changes or "utterances" in changes else {}), **changes)

    def format_of(self, target: str) -> str:
        return self.reading_format if target == "reading" else self.repr_format

    def map(self, target: str, text: Callable[[Column], Column]) -> Corpus:
        """A change of one column's texts; its symbols follow. target both: of reading and repr."""
        if target == "both":
            return self.map("reading", text).map("repr", text)
        if target not in TARGETS:
            raise ValueError(f"no such target: {target}")
        changed = self.utterances.withColumn(target, text(F.col(target)))
        symbols = tx.phones(F.col(target)) if self.format_of(target) != "graphemes" else tx.graphemes(F.col(target))
        return self.changed(changed.withColumn(f"{target}_syms", symbols))

    def map_symbols(self, target: str, symbols: Callable[[Column], Column], to: str | None = None) -> Corpus:
        """A change of one column's symbols; its texts follow. to: the format from then on."""
        kind = to or self.format_of(target)
        changed = self.utterances.withColumn(f"{target}_syms", symbols(F.col(f"{target}_syms")))
        changed = changed.withColumn(target, F.array_join(f"{target}_syms", "" if kind == "graphemes" else " "))
        return self.changed(changed, **{f"{target}_format": kind})

    def remove(self, condition: Column) -> Corpus:
        """Without the rows for which the condition is true; they leave the selection too."""
        return self.keep(self.utterances.where(~F.coalesce(condition, F.lit(False))))

    def keep(self, utterances: DataFrame) -> Corpus:
        """With these of its rows."""
        whole = self.selection if self.whole is None else self.whole
        return replace(self, utterances=utterances, selection=whole.join(utterances.select("utt_id"), "utt_id", "left_semi"), whole=whole)

    def changed(self, utterances: DataFrame, **changes) -> Corpus:
        """The same rows with other columns."""
        return replace(self, utterances=utterances, **changes)

    def without_symbols(self) -> Corpus:
        """For steps that need texts alone, and rows that are shuffled or saved: symbols take many times the place."""
        return self.changed(self.utterances.drop("reading_syms", "repr_syms"))

    def with_symbols(self) -> Corpus:
        """The symbols that the texts have by their formats."""
        symbols = {f"{t}_syms": tx.graphemes(F.col(t)) if self.format_of(t) == "graphemes" else tx.phones(F.col(t)) for t in TARGETS}
        return self.changed(self.utterances.withColumns(symbols))

    def selected(self) -> DataFrame:
        return self.utterances.join(self.selection, "utt_id")

    def deselected(self) -> DataFrame:
        return self.utterances.join(self.selection, "utt_id", "left_anti")

    def then(self, *steps: Callable[[Corpus], Corpus]) -> Corpus:
        out = self
        for step in steps:
            out = step(out)
        return out


def empty_selection(spark) -> DataFrame:
    return spark.createDataFrame([], SELECTION_SCHEMA)
