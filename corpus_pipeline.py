"""Training sequences from raw documents, in stages that are each written and read again.

Every stage takes all that the one before kept. The first four return the columns of documents:

- toxicity: documents scored as toxic go (5).
- near-duplicates: one document of each group stays, the one with the smallest id (3).
- secrets: what the scan finds is replaced by a mark, and n_chars follows (2).
- mixing: documents are taken as often as their source's share of the words asks, so ids may repeat or go (1).
- packing: texts become pieces in sequences of permitted lengths (10).

Null texts go through as the operators' own rules say. Rows that repeat an id, or have none, are documents of their own
where their texts differ; of rows alike in id and text one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import saved, small_batches, table, word_count
from lectern.llm.minhash import near_duplicates
from lectern.llm.mixing import mix
from lectern.llm.packing import pack
from lectern.llm.secret_scan import redacted
from lectern.llm.toxicity import CUT, learn, scored
from lectern.operators.ids import with_dense_ids
from lectern.shipping import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of the table's own documents; documents without a text are not toxic."""
    ship(spark)
    model = learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored(docs.select(*COLUMNS), model, out="toxic_score").where(F.col("toxic_score") < CUT).select(*COLUMNS)


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with a key of their own: the id, or a number beyond all ids for each text of an id that is repeated or null."""
    again = saved(docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("its_id")))
    if again.isEmpty():
        return docs.select(F.col("doc_id").alias("key"), *COLUMNS)
    same = F.col("doc_id").eqNullSafe(F.col("its_id"))
    mark = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))
    repeated = docs.join(again, same, "left_semi").withColumn("mark", mark)
    order = [F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark"]  # a row with an id stays before one without
    numbers = with_dense_ids(repeated.select(*order).distinct(), ["nameless", "doc_id", "mark"], "number").drop("nameless").toDF("its_id", "its_mark", "number")
    top = docs.agg(F.max("doc_id")).first()[0] or 0
    numbered = repeated.join(numbers, same & (F.col("mark") == F.col("its_mark"))).withColumn("key", F.col("number") + F.lit(top + 1))
    one = numbered.groupBy("key").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("key", "row.*")
    return saved(docs.join(again, same, "left_anti").select(F.col("doc_id").alias("key"), *COLUMNS).union(one))


def drop_near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shingles of five words, linked at a similarity of 0.8."""
    ship(spark)
    keyed = _keyed(docs.select(*COLUMNS))
    gone = near_duplicates(keyed, key="key").where(~F.col("kept")).select(F.col("doc_id").alias("key"))
    return keyed.join(gone, "key", "left_anti").select(*COLUMNS)


def redact_secrets(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    small_batches(spark)
    clean = docs.select(*COLUMNS).withColumn("clean", redacted(F.col("text")))
    length = F.when(F.col("clean.secrets") > 0, F.length("clean.text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumns({"text": F.col("clean.text"), "n_chars": length}).select(*COLUMNS)


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sizes are counted once, and only slim rows are sampled; texts meet their copies by id. Rows alike in all are taken together."""
    mark = F.xxhash64("text", "lang", "source", "n_chars")
    sizes = saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mark.alias("mark")))
    copies = mix(sizes, "size").select("doc_id", "mark", "copies").groupBy("doc_id", "mark").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    copies = copies.toDF("its_id", "its_mark", "copies", "rows").where("copies > 0")
    marked = docs.select(*COLUMNS).withColumn("mark", mark)
    joined = marked.join(copies, F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("mark") == F.col("its_mark"))).select(*COLUMNS, "copies", "rows")
    single = joined.where("rows = 1").select(*COLUMNS, "copies")
    alike = joined.where("rows > 1").groupBy(*COLUMNS).agg(F.first("copies").alias("copies"))
    return single.union(alike).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


def pack_sequences(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece, with its text and its place in its sequence."""
    ship(spark)
    return pack(docs, with_text=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the trained stages nor the near-duplicates.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
