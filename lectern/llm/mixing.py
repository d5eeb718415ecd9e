"""Mixing sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, target / size of the source. The prefix sums of these
expected copies, shifted by one random offset a source, cross integers; a document is emitted once for each integer that
its stretch crosses. Documents stand in the order of their size, so each stretch of a source gives its share at every
size and the words taken come near the target.

Cases: null text has size 0; null doc_id is a value like others; a null source is a source of its own, the last one; a
source without words gets target 0 and nothing is taken of it; repeated rows are sampled as rows of their own; an empty
table gives an empty result. Columns that the caller has under this operator's names keep their values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, positions, salt_of, saved, size_band, table, word_count

#: No source is taken more often than this.
CAP = 3
#: The weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
SEED = 17


def source_targets(sizes: DataFrame, source: str, size: str, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """source_key, source, source_size, target: a row for each source.

    Targets are weight * level up to cap * size, with the one level at which they sum to the whole: what capped sources
    leave is reshared by weight. Over sources by rising cap * size / weight, that level is the largest of (whole - caps
    before) / (weights from here on). The windows run over one row a source.
    """
    by_source = sizes.groupBy(source).agg(F.sum(size).alias("source_size"))
    order = F.row_number().over(Window.orderBy(F.col(source).isNull(), F.col(source))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (order % len(weights) + 1).cast("int"))
    whole = Window.partitionBy()
    filled = Window.orderBy(cap * F.col("source_size") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    share = (
        by_source.select(F.col(source), "source_size", order.alias("place"), weight.alias("weight"))
        .withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum(cap * F.col("source_size")).over(filled), F.lit(0)))
        .withColumn("right", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0)))
        .withColumn("level", F.max(F.col("left") / F.col("right")).over(whole))
    )
    target = F.least(cap * F.col("source_size").cast("double"), F.col("level") * F.col("weight"))
    return share.select(source_key(F.col(source)).alias("source_key"), F.col("source_size"), target.alias("target"))


def source_key(source: Column) -> Column:
    """A text that is never null: a null source is apart from every name."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def offset_of(key: Column, seed: int) -> Column:
    """One number in [0, 1) for each source."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def mix(docs: DataFrame, size: str, key: str = "doc_id", source: str = "source", weights=WEIGHTS, cap: int = CAP, seed: int = SEED, extra: tuple[str, str, str] = ("source_size", "target", "copies")) -> DataFrame:
    """docs with source_size, target and copies (how often the mix takes the row).

    The sampled frame is read twice (sizes of sources and buckets, then rows); a costly size is best saved before.
    """
    source_size, target, copies = extra
    s_key, band, salt, place = fresh(docs, "source_key", "size_band", "salt", "place")
    rows = docs.withColumns({s_key: source_key(F.col(source)), band: size_band(F.col(size)), salt: salt_of(F.col(key))})
    targets = source_targets(docs.select(F.col(source).alias("source"), F.col(size).alias("size")), "source", "size", weights, cap)
    targets = targets.select(F.col("source_key").alias(s_key), F.col("source_size").alias(source_size), F.col("target").alias(target))
    placed = positions(rows, [s_key], [band, salt], [size, key], place, targets)
    rate = F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)).otherwise(0.0)
    crossed = lambda at: F.floor(offset_of(F.col(s_key), seed) + rate * at)
    return placed.withColumn(copies, (crossed(F.col(place) + 1) - crossed(F.col(place))).cast("long")).drop(s_key, band, salt, place)


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    mixed = mix(sizes, "size")
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


#: The same in DuckDB's SQL.
OP1_SQL = f"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place,
         ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::DOUBLE AS weight FROM by_source
), shares AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum({CAP} * source_size) OVER w, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM weighed WINDOW w AS (ORDER BY {CAP} * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT coalesce('s' || source, 'n') AS source_key, source_size,
         least({CAP} * source_size::DOUBLE, max(level) OVER () * weight) AS target FROM shares
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         ('0x' || substr(md5('{SEED}:' || t.source_key), 1, 12))::BIGINT::DOUBLE / {16**12}.0::DOUBLE AS u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY t.source_key ORDER BY
           length(d.size::VARCHAR) * 100 + substr(rpad(d.size::VARCHAR, 2, '0'), 1, 2)::INT,
           substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 2), d.size, d.doc_id NULLS FIRST) - 1 AS place
  FROM docs d JOIN targets t ON t.source_key = coalesce('s' || d.source, 'n')
)
SELECT doc_id, size, source_size, target,
       ((floor(u + rate * (place + 1)) - floor(u + rate * place))::BIGINT * size)::BIGINT AS taken
FROM placed
"""
