"""Utterances as sentences."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators.filters import is_sentence
from lectern.operators.ids import with_dense_ids
from lectern.operators.selection import ranked
from lectern.operators.sentence_ends import Ends, split
from lectern.operators.transforms import split_sentences
from lectern.plans.corpus import Corpus
from lectern.saving import saved


def split_corpus(corpus: Corpus, strict: bool = False, ends: Ends | None = None) -> Corpus:
    """A row for each sentence of the reading, with new ids; path and being selected are inherited, the representation is the reading anew.

    strict leaves out what is no sentence. ends: where sentences end, as learned from a corpus; else behind every . ! and ?.
    """
    marks = corpus.selection.select("utt_id", F.lit(True).alias("selected_"))
    rows = corpus.utterances.join(marks, "utt_id", "left")
    rows = saved(split(rows, "reading", ends, "sentences_").select("utt_id", "path_id", "line_nr", "selected_", "sentences_")) if ends else rows.withColumn("sentences_", split_sentences(F.col("reading")))
    rows = rows.select(F.col("utt_id").alias("old_"), "path_id", "line_nr", "selected_", F.posexplode("sentences_").alias("at_", "reading"))
    rows = rows.where(~tx.is_blank(F.col("reading")))
    if strict:
        rows = rows.where(is_sentence(F.col("reading"), corpus.language, corpus.reading_format))
    rows = with_dense_ids(rows, ["old_", "at_"])
    symbols = tx.graphemes(F.col("reading")) if corpus.reading_format == "graphemes" else tx.phones(F.col("reading"))
    rows = rows.withColumn("reading_syms", symbols)
    selection = ranked(rows.where("selected_").select("utt_id"), ["utt_id"])
    made = rows.select("utt_id", "path_id", "line_nr", "reading", "reading_syms", F.col("reading").alias("repr"), F.col("reading_syms").alias("repr_syms"))
    return corpus.with_(utterances=made, selection=selection, repr_format=corpus.reading_format)
