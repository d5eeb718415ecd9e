"""Steps of a corpus as Parquet tables, and the exchange with other selectors.

A step is a folder. Each write puts the tables in a new folder inside it, and then moves a small file, which names that
folder, to its place at once. So a step that is read or replaced while it is being read is whole at any time: a writer that is
lost before the move leaves the step as it was. The tables that were replaced last stay for those who still read them; those
before go. (On a store whose renames aren't atomic, the move is a delete and a rename.)

The file also holds what the step counts: rows, selected rows and seconds of reading, observed as the rows were written,
so what an operator removed is known without another pass over the rows before and after it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators.selection import is_known, select
from lectern.plans.corpus import TARGETS, Corpus

SUBSETS = ("Available", "Ignored", "Selected")
#: The file of a step that names its tables.
CURRENT = "current.json"


class _Store:
    """Small files of the store that Spark writes a folder to."""

    def __init__(self, spark, directory: str) -> None:
        self.jvm, self.gateway, self.directory = spark._jvm, spark.sparkContext._gateway, directory
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self.conf = spark._jsc.hadoopConfiguration()

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.directory}/{name}" if name else self.directory)

    def read(self) -> dict | None:
        if not self.fs.exists(self.path(CURRENT)):
            return None
        data = self.fs.open(self.path(CURRENT))
        try:
            return json.loads(bytes(data.readAllBytes()))
        finally:
            data.close()

    def replace(self, facts: dict) -> None:
        fresh = self.path(f".{uuid.uuid4().hex}")
        out = self.fs.create(fresh)
        out.write(bytearray(json.dumps(facts).encode()))
        out.close()
        kind = getattr(self.jvm, "org.apache.hadoop.fs.Options$Rename")
        how = self.gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE
        at = self.fs.makeQualified(self.path(CURRENT))
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), self.conf).rename(self.fs.makeQualified(fresh), at, how)

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _slim(utterances: DataFrame) -> DataFrame:
    """Symbols that are just the characters of their text aren't written, as they take many times its place; NAME_plain says so."""
    for target in TARGETS:
        name = f"{target}_syms"
        if name in utterances.columns and target in utterances.columns:
            symbols, text = F.col(name), F.col(target)
            plain = (F.size(name) == F.length(text)) & (F.array_join(name, "") == text) & ~F.array_contains(name, "")
            utterances = utterances.withColumn(f"{name}_plain", F.coalesce(plain, F.lit(False)))
            utterances = utterances.withColumn(name, F.when(~F.col(f"{name}_plain"), symbols))
    return utterances


def _full(utterances: DataFrame) -> DataFrame:
    """With all symbols, and the columns as they were given."""
    plain = {f"{t}_syms": f"{t}_syms_plain" for t in TARGETS if f"{t}_syms_plain" in utterances.columns}
    return utterances.withColumns({name: F.when(F.col(mark), tx.graphemes(F.col(name.removesuffix("_syms")))).otherwise(F.col(name)) for name, mark in plain.items()}).drop(*plain.values())


def write_step(corpus: Corpus, directory: str, overwrite: bool = False) -> dict:
    """All tables of a step, and what they count: rows, selected, seconds. An existing step is an error unless overwrite, and is whole until the new one is."""
    store = _Store(corpus.utterances.sparkSession, directory)
    old = store.read()
    if old and not overwrite:
        raise FileExistsError(f"{directory} is a step already")
    tables = f"tables-{uuid.uuid4().hex}"
    rows, chosen = Observation(), Observation()
    one = F.count(F.lit(1)).alias("n")
    observed = {
        "utterances": _slim(corpus.utterances.observe(rows, one, F.sum(F.size("reading_syms")).alias("symbols"))),
        "selection": corpus.selection.observe(chosen, one),
        "paths": corpus.paths,
    }
    for name, table in observed.items():
        table.write.parquet(f"{directory}/{tables}/{name}")
    facts = {"rows": rows.get["n"], "selected": chosen.get["n"], "seconds": (rows.get["symbols"] or 0) / tx.READING_SPEED}
    formats = {"language": corpus.language, "reading_format": corpus.reading_format, "repr_format": corpus.repr_format}
    store.replace({"tables": tables, "replaced": old and old["tables"], **formats, **facts})
    if old and old["replaced"]:
        store.delete(old["replaced"])
    return facts


def _current(spark, directory: str) -> dict:
    found = _Store(spark, directory).read()
    if found is None:
        raise FileNotFoundError(f"{directory} is no step")
    return found


def read_step(spark, directory: str) -> Corpus:
    """The step as it is now: what replaces it later changes nothing here."""
    now = _current(spark, directory)
    tables = [spark.read.parquet(f"{directory}/{now['tables']}/{t}") for t in ("utterances", "selection", "paths")]
    return Corpus(_full(tables[0]), *tables[1:], now["language"], now["reading_format"], now["repr_format"])


def read_columns(spark, directory: str, *columns: str) -> DataFrame:
    """Some columns of a step's utterances; no others are read."""
    return _full(spark.read.parquet(f"{directory}/{_current(spark, directory)['tables']}/utterances")).select(*columns)


def step_counts(spark, directory: str) -> dict:
    """rows, selected and seconds of a step, without a read of its tables."""
    now = _current(spark, directory)
    return {k: now[k] for k in ("rows", "selected", "seconds")}


def removed_between(before: dict, after: dict) -> dict:
    """removed, kept and removed_pct of what lies between two steps' counts, as removal_stats has them."""
    removed = before["rows"] - after["rows"]
    return {"removed": removed, "kept": after["rows"], "removed_pct": round(100 * removed / before["rows"], 6) if before["rows"] else 0.0}


def selection_dataset(corpus: Corpus) -> DataFrame:
    """utt_id, subset and weight of all utterances; nothing is ignored and all weigh the same."""
    marks = corpus.selection.select("utt_id", F.lit(SUBSETS[2]).alias("mark"))
    rows = corpus.utterances.select("utt_id").join(marks, "utt_id", "left")
    return rows.select("utt_id", F.coalesce("mark", F.lit(SUBSETS[0])).alias("subset"), F.lit(1.0).alias("weight"))


def load_selection(corpus: Corpus, dataset: DataFrame) -> Corpus:
    """The dataset's selected ids replace the selection; unknown ids are an error."""
    wanted = dataset.where(F.col("subset") == SUBSETS[2]).select("utt_id", F.col("utt_id").alias("sel_rank"))
    if not is_known(wanted, corpus.utterances):
        raise ValueError("the dataset selects ids that the corpus lacks")
    return corpus.with_(selection=select(corpus.selection, wanted))
