"""Set operations on the ordered selection, and on rows of corpora."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.ids import with_dense_ids
from lectern.plans.corpus import Corpus

#: The id that a script line ends with.
TEX_ID = r" % ([0-9]+)\n"


def ranked(ids: DataFrame, order: list[str]) -> DataFrame:
    """utt_id and dense sel_rank, of ids in an order without ties."""
    return with_dense_ids(ids, order, "sel_rank").select("utt_id", "sel_rank")


def add(selection: DataFrame, new: DataFrame) -> DataFrame:
    """Ordered union: new ids (utt_id, sel_rank) follow in their order."""
    fresh = new.join(selection, "utt_id", "left_anti").groupBy("utt_id").agg(F.min("sel_rank").alias("sel_rank"))
    both = selection.select("utt_id", F.lit(0).alias("part"), "sel_rank").union(fresh.select("utt_id", F.lit(1), "sel_rank"))
    return ranked(both, ["part", "sel_rank", "utt_id"])


def remove(selection: DataFrame, gone: DataFrame) -> DataFrame:
    """Difference; the rest keeps its order."""
    return ranked(selection.join(gone.select("utt_id"), "utt_id", "left_anti"), ["sel_rank"])


def select(selection: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted ids and no others: those that were selected first, in their old order, then the new ones in theirs."""
    return add(selection.join(wanted.select("utt_id"), "utt_id", "left_semi"), wanted)


def select_all(corpus: Corpus) -> Corpus:
    return corpus.with_(selection=select(corpus.selection, corpus.utterances.select("utt_id", F.col("utt_id").alias("sel_rank"))))


def deselect_all(corpus: Corpus) -> Corpus:
    return corpus.with_(selection=corpus.selection.limit(0))


def remove_deselected(corpus: Corpus) -> Corpus:
    return corpus.with_(utterances=corpus.utterances.join(corpus.selection, "utt_id", "left_semi"))


def is_known(ids: DataFrame, utterances: DataFrame) -> bool:
    """Whether all ids are of the corpus."""
    return ids.join(utterances, "utt_id", "left_anti").isEmpty()


def tex_ids(tex: DataFrame, column: str = "value", part: str | None = None) -> DataFrame:
    """utt_id and sel_rank of a script's lines, at their first place. Whole scripts, a row each (one as a rule), or with part the rows of one script, in the order of that column; places run on across rows."""
    found = tex.select(*[F.col(c).alias("part") for c in (part,) if c], F.posexplode(F.regexp_extract_all(column, F.lit(TEX_ID), F.lit(1))).alias("place", "id"))
    if part:
        found = with_dense_ids(found, ["part", "place"], "at").withColumn("place", F.col("at"))
    return found.groupBy(F.col("id").cast("long").alias("utt_id")).agg(F.min("place").cast("long").alias("sel_rank"))


def unknown_tex_ids(corpus: Corpus, tex: DataFrame, column: str = "value", part: str | None = None) -> DataFrame:
    """utt_id of the script's lines that the corpus lacks."""
    return tex_ids(tex, column, part).join(corpus.utterances.select("utt_id"), "utt_id", "left_anti").select("utt_id")


def select_from_tex(corpus: Corpus, tex: DataFrame, column: str = "value", part: str | None = None) -> Corpus:
    """The script's ids replace the selection; ids that the corpus lacks are left out, with a warning."""
    unknown = unknown_tex_ids(corpus, tex, column, part).count()
    if unknown:
        warnings.warn(f"{unknown} ids of the script are not in the corpus", stacklevel=2)
    wanted = tex_ids(tex, column, part).join(corpus.utterances.select("utt_id"), "utt_id", "left_semi")
    return corpus.with_(selection=select(corpus.selection, wanted))


def move_rows(rows: DataFrame, ids: DataFrame, source: DataFrame) -> DataFrame:
    """rows and those of source with the ids, none of which is in rows."""
    return rows.unionByName(source.join(ids.select("utt_id"), "utt_id", "left_semi"))


def merge(corpora: list[Corpus]) -> Corpus:
    """All rows of all corpora in their order, with new ids; selected ones stay selected, in corpus order. Nothing is deduplicated."""
    first = corpora[0]
    kinds = {(c.language, c.reading_format, c.repr_format) for c in corpora}
    if len(kinds) > 1:
        raise ValueError(f"corpora of different languages or formats: {sorted(kinds)}")
    rows = paths = None
    for number, c in enumerate(corpora):
        part = c.utterances.join(c.selection.withColumn("selected_", F.lit(True)), "utt_id", "left").drop("sel_rank").withColumn("corpus_", F.lit(number))
        path = c.paths.withColumn("corpus_", F.lit(number))
        rows, paths = (part, path) if rows is None else (rows.unionByName(part), paths.unionByName(path))
    paths = paths.withColumn("new_path_", F.row_number().over(Window.orderBy("corpus_", "path_id")).cast("long") - 1)
    rows = rows.withColumnRenamed("utt_id", "old_id_")
    numbers = with_dense_ids(rows.select("corpus_", "old_id_"), ["corpus_", "old_id_"])  # of slim rows: texts and symbols are neither sorted nor saved
    rows = rows.join(numbers, ["corpus_", "old_id_"]).join(paths.select("corpus_", "path_id", "new_path_"), ["corpus_", "path_id"], "left").withColumn("path_id", F.col("new_path_"))
    chosen = numbers.join(rows.where("selected_").select("corpus_", "old_id_"), ["corpus_", "old_id_"], "left_semi")
    selection = ranked(chosen.select("utt_id"), ["utt_id"])
    return first.with_(utterances=rows.select(*first.utterances.columns), selection=selection, paths=paths.select(F.col("new_path_").alias("path_id"), "path"))
