"""Row operators on streams.

Changes of texts, the filters by row and the splitting of sentences keep no state, so they run on a stream as they are.
What needs the whole corpus (duplicates, rare words, selection, statistics) does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators import filters, transforms


def utterance_stream(lines: DataFrame, column: str = "value", remove: list[Column] | None = None) -> DataFrame:
    """Sentences of a stream of lines, normalised, without those that a condition on `text` is true for."""
    rows = lines.select(F.explode(transforms.split_sentences(transforms.normalize(F.col(column)))).alias("text")).where(~tx.is_blank(F.col("text")))
    for condition in remove or [filters.has_acronym(F.col("text"))]:
        rows = rows.where(~condition)
    return rows
