"""Variable-capacity best-fit packing of documents into training sequences.

Texts are measured in words and one separator each; texts longer than the largest capacity are cut into consecutive
pieces between words, and the pieces' texts joined give the text back. Pieces are placed by falling length into the open
bin that they leave fullest. If none has room, a bin of the permitted capacity with the least cost a word is opened: the
cost of a sequence is overhead + c + c * c / quadratic, over the words that the bin can still get (its capacity, or all
that is left to place). At the end each bin is downsized to the least permitted capacity that holds its contents, so
opening large costs nothing where the contents stay small.

Packing isn't bound to the files' partitions: pieces (numbers, no texts) are dealt by hash to groups of about WINDOW, each of
which is packed for itself, so every group has the table's mix of lengths and its bins are as full however the files were
split. No key can be hot, as a row's number decides, not its id; a lost task packs its groups again. Bins are named by group
and bin. With texts, rows are saved with their numbers and meet their pieces' places by a join.

Cases: a null text is packed as an empty one; an empty text takes its separator's place; null ids and repeated rows are
packed as rows of their own; an empty table gives no bins. The result holds the operator's columns only.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, saved, small_batches, table

CAPACITIES = (256, 512, 1024, 2048, 4096, 8192)
#: Cost of a sequence besides its length: a fixed part, and attention as length squared over this.
OVERHEAD, QUADRATIC = 64, 16384
#: Pieces packed together, about.
WINDOW = 2_000

_WORD = re.compile(WORD)
#: Stands for a null id on the way through pandas, which would turn a column with nulls into floats.
_NULL = -(2**63)
_PIECE = "row long, doc_id long, piece int, start long, length int, first long, end long"
_PLACE = "bin_id long, capacity int, bin_used int, bin_offset int"


def pieces_of(text: str, most: int) -> list[tuple[int, int, int, int]]:
    """(first word, words, first character, end) of each piece of at most so many words; one piece at least."""
    n = len(text.encode("utf-8", "surrogatepass").split())
    if n <= most:
        return [(0, n, 0, len(text))]
    starts = [m.start() for i, m in enumerate(_WORD.finditer(text)) if i % most == 0]
    ends = [*starts[1:], len(text)]
    return [(i * most, min(most, n - i * most), 0 if i == 0 else s, e) for i, (s, e) in enumerate(zip(starts, ends, strict=True))]


def cheapest(length: int, left: int, capacities=CAPACITIES) -> int:
    """The capacity to open for a piece: least cost a word, as so many words (its own included) are left to place."""
    fit = [c for c in capacities if c >= length]
    return min(fit, key=lambda c: ((OVERHEAD + c + c * c / QUADRATIC) / min(c, left), c))


def best_fit(lengths: list[int], capacities=CAPACITIES) -> tuple[list[int], list[int], list[int], list[int]]:
    """For each piece its bin and offset; for each bin its final capacity and the words in it. No length is above all capacities."""
    capacities = sorted(capacities)
    bin_of, offset, used, size = [0] * len(lengths), [0] * len(lengths), [], []
    room: dict[int, list[int]] = {}
    rooms: list[int] = []  # sorted keys of room
    left = sum(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        at = bisect_left(rooms, n)
        if at < len(rooms):
            free = rooms[at]
            b = room[free].pop()
            if not room[free]:
                del room[free], rooms[at]
        else:
            free, b = cheapest(n, left, capacities), len(used)
            used.append(0)
            size.append(free)
        bin_of[i], offset[i] = b, used[b]
        used[b] += n
        left -= n
        if free := free - n:
            if free not in room:
                room[free] = []
                insort(rooms, free)
            room[free].append(b)
    return bin_of, offset, [next(c for c in capacities if c >= u) for u in used], used


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacities=CAPACITIES, with_text: bool = False, window: int = WINDOW) -> DataFrame:
    """A row for each piece: doc_id, piece, start (first word), length (words and separator), bin_id, capacity of its bin, bin_used, bin_offset; with_text adds the piece's text."""
    most = max(capacities) - 1

    def measured(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = [(row, doc, i, start, n + 1, a, e) for row, doc, body in zip(pdf["row"], pdf["doc_id"], pdf["text"], strict=True) for i, (start, n, a, e) in enumerate(pieces_of(body, most))]
            yield pd.DataFrame(rows, columns=["row", "doc_id", "piece", "start", "length", "first", "end"])

    def packed(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row", "piece"], ascending=[False, True, True], ignore_index=True)
        bin_of, offset, size, used = best_fit(pdf["length"].tolist(), capacities)
        places = {"bin_id": [(group[0] << 24) + b for b in bin_of], "capacity": [size[b] for b in bin_of], "bin_used": [used[b] for b in bin_of], "bin_offset": offset}
        return pdf.drop(columns="group").assign(**places)

    small_batches(docs.sparkSession)
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(key).cast("long"), F.lit(_NULL)).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if with_text:
        numbered = saved(numbered)  # the numbers must not change between the two uses
    pieces = saved(numbered.mapInPandas(measured, _PIECE))
    groups = -(-pieces.count() // window) or 1
    placed = pieces.withColumn("group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups))).groupBy("group").applyInPandas(packed, f"{_PIECE}, {_PLACE}")
    columns = [F.nullif("doc_id", F.lit(_NULL)).alias("doc_id"), "piece", "start", "length", "bin_id", "capacity", "bin_used", "bin_offset"]
    if not with_text:
        return placed.select(*columns)
    return placed.join(numbered.select("row", "text"), "row").select(*columns, F.expr("substring(text, CAST(first AS INT) + 1, CAST(end - first AS INT))").alias("text"))


def op10_pack(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
