"""Dense ids in a global order."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.saving import saved


def with_dense_ids(df: DataFrame, order: list[str], out: str = "utt_id") -> DataFrame:
    """Adds 0-based gapless ids in an order without ties.

    One range shuffle sorts the rows, which are saved; ids are then a row's place in its partition after the sizes of the
    partitions before it. The driver sees one count a partition.
    """
    return in_place_ids(df.repartitionByRange(*order).sortWithinPartitions(*order), out)


def in_place_ids(df: DataFrame, out: str = "utt_id") -> DataFrame:
    """The same for rows that are in their order already, from partition to partition: they are saved, not shuffled."""
    ranged = saved(df)
    row = F.monotonically_increasing_id()
    counts = {r["part"]: r["count"] for r in ranged.groupBy(F.spark_partition_id().alias("part")).count().collect()}
    parts = range(max(counts, default=0) + 1)
    starts = [0, *accumulate(counts.get(p, 0) for p in parts)][:-1]
    first = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), F.shiftright(row, 33).cast("int") + 1)
    return ranged.withColumn(out, first + row.bitwiseAND(F.lit((1 << 33) - 1)))
