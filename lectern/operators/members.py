"""Which rows have an id of a set, found where the rows lie: ids are shuffled, and nothing else of a row."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.saving import FEW, saved_table

#: Bits of a slice of the filter, as a power of two; slices at most (16 MB in all); bits for an id as long as there are fewer.
SLICE, MOST, EACH = 20, 128, 32


def _bits(hashes: np.ndarray, slices: int, power: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slice of each hash, and its two bits there."""
    h = hashes.astype(np.int64).view(np.uint64)
    in_slice = np.uint64((1 << power) - 1)
    return ((h >> np.uint64(40)) % np.uint64(slices)).astype(np.int64), (h & in_slice).astype(np.int64), ((h >> np.uint64(power)) & in_slice).astype(np.int64)


def _hash() -> Column:
    return F.xxhash64(F.col("utt_id").cast("long"))


def hashed(rows: DataFrame) -> DataFrame:
    """rows and what Members.passes asks for: hash_."""
    return rows.withColumn("hash_", _hash())


def _filter(ids: DataFrame, slices: int, power: int) -> np.ndarray:
    """A Bloom filter of the ids, a row of bytes for each slice. A slice is made in one task; the driver gets the finished ones."""

    def made(parts):
        found: dict[int, np.ndarray] = {}
        for pdf in parts:
            at, *both = _bits(pdf["h"].to_numpy(), slices, power)
            for one in np.unique(at).tolist():
                own = found.setdefault(one, np.zeros(1 << power >> 3, dtype=np.uint8))
                for b in both:
                    np.bitwise_or.at(own, b[at == one] >> 3, (1 << (b[at == one] & 7)).astype(np.uint8))
        for one, own in found.items():
            yield pd.DataFrame({"slice": [one], "bits": [own.tobytes()]})

    dealt = ids.select(_hash().alias("h")).repartition((F.shiftrightunsigned("h", 40) % slices).alias("slice"))
    out = np.zeros((slices, 1 << power >> 3), dtype=np.uint8)
    for r in dealt.mapInPandas(made, "slice long, bits binary").collect():
        out[r["slice"]] |= np.frombuffer(r["bits"], dtype=np.uint8)
    return out


class Members:
    """Tells rows with an id of members from the others, where the rows lie.

    A Bloom filter, of at most 16 MB at any number of members, lets members pass and few others. Ids that pass it wrongly are found by a
    join of ids; they are few as a rule (4 in 1,000 of the others up to 4 million members) and are looked up in place too. Where they
    aren't, the rows that pass meet them by a shuffle, and the others stay. rows: utt_id of all rows that are asked for.
    """

    def __init__(self, rows: DataFrame, members: DataFrame, few: int = FEW) -> None:
        ids = saved_table(members.select(F.col("utt_id").cast("long").alias("utt_id")).where("utt_id IS NOT NULL"))
        n = ids.count()
        self.passes, self.wrong, self.few = None, None, True
        if not n:
            return
        power, slices = SLICE, min(max(-(-n * EACH >> SLICE), 1), MOST)
        state = rows.sparkSession.sparkContext.broadcast(_filter(ids, slices, power))

        def passes(hashes: pd.Series) -> np.ndarray:
            at, a, b = _bits(hashes.to_numpy(), slices, power)
            bits = state.value
            return ((bits[at, a >> 3] >> (a & 7)) & (bits[at, b >> 3] >> (b & 7)) & 1).astype(bool)

        def passing(parts):
            for pdf in parts:
                yield pdf.loc[passes(pdf["hash_"]), ["utt_id"]]

        passed = hashed(rows.select("utt_id").where("utt_id IS NOT NULL")).mapInPandas(passing, "utt_id long")
        wrong = saved_table(passed.join(ids.hint("merge"), "utt_id", "left_anti").distinct())  # no executor holds all ids
        self.passes, self.wrong, self.few = passes, wrong, wrong.count() <= few

    def kept(self, rows: DataFrame, inside: bool) -> DataFrame:
        """Of rows with passed, which says what passes gave of their hash_: the members (inside), or the others."""
        passed, wrong = F.col("passed") & F.col("utt_id").isNotNull(), F.broadcast(self.wrong) if self.few else self.wrong
        if inside:
            return rows.where(passed).join(wrong, "utt_id", "left_anti").drop("passed")
        if self.few:
            return rows.join(wrong.withColumn("wrong_", F.lit(True)), "utt_id", "left").where(~passed | F.col("wrong_").isNotNull()).drop("passed", "wrong_")
        return rows.where(~passed).unionByName(rows.where(passed).join(wrong, "utt_id", "left_semi")).drop("passed")
