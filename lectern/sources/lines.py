"""Lines of text files by ranges of bytes: one large file is read by many tasks, many small ones by one.

A line belongs to the range that its first byte is in; whoever reads a range begins one sign before it and drops what it
finds there, so no line is lost or read twice, wherever the cut lies: inside a line, between \\r and \\n, in the middle of a
character. Line ends are \\n, \\r\\n and \\r. A line's number is its place in its range after the lines of the file's ranges before.

Encodings whose line ends are known bytes can be cut: those that hold ASCII, UTF-16 and UTF-32 (with the file's own order of
bytes). Others (ISO-2022, UTF-7, EBCDIC, ...) are read a file at a time. What can't be decoded is an error.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lectern.saving import FEW, saved
from lectern.sources import files

#: Bytes of a range, of one read, and that opening a file is worth when small files are put together.
SPLIT, READ, OPEN = 128 << 20, 8 << 20, 4 << 20
#: Bytes of the first read behind a range's end, where its last line goes on; tasks that the ranges of a folder are dealt to, if that takes no more than SPLIT bytes a task.
BEHIND, TASKS = 4096, 64
#: Ranges of a file, if that takes no more than SPLIT bytes a range; rows of a batch.
RANGES, ROWS = 4096, 16_384
#: Encodings in which a byte of 10 needn't be a line's end.
STATEFUL = ("utf-7", "hz", "iso2022")
MARKS = {"utf-16": {b"\xff\xfe": "utf-16-le", b"\xfe\xff": "utf-16-be"}, "utf-32": {b"\xff\xfe\0\0": "utf-32-le", b"\0\0\xfe\xff": "utf-32-be"}, "utf-8-sig": {b"\xef\xbb\xbf": "utf-8"}}
#: What files without a mark are in.
PLAIN = {"utf-16": "utf-16-le", "utf-32": "utf-32-le", "utf-8-sig": "utf-8"}


@dataclass(frozen=True)
class Coding:
    """How bytes are read: name, width of a sign that can end a line (0: can't be cut), numpy's type, bytes of the mark."""

    name: str
    width: int
    kind: str
    mark: int = 0


def coding(encoding: str, head: bytes = b"") -> Coding:
    name = codecs.lookup(encoding).name
    mark = next((m for m in MARKS.get(name, ()) if head.startswith(m)), b"")
    name = MARKS[name][mark] if mark else PLAIN.get(name, name)
    for wide, bits in (("utf-16", "u2"), ("utf-32", "u4")):
        if name.startswith(wide):
            return Coding(name, int(bits[1]), ("<" if name.endswith("le") else ">") + bits, len(mark))
    plain = not name.startswith(STATEFUL) and "\r\n".encode(name) == b"\r\n"
    return Coding(name, 1 if plain else 0, "u1", len(mark))


def _ends(signs: np.ndarray, last: bool, sign: str = "") -> np.ndarray:
    """Where lines begin behind an end of line, or behind a sign; without last, an \\r at the very end may still become \\r\\n."""
    if sign:
        return np.flatnonzero(signs == ord(sign)) + 1
    feeds, returns = np.flatnonzero(signs == 10), np.flatnonzero(signs == 13)
    if not last:
        returns = returns[returns + 1 < len(signs)]
    alone = returns[(returns + 1 >= len(signs)) | (signs[np.minimum(returns + 1, len(signs) - 1)] != 10)] if len(returns) else returns
    return np.sort(np.concatenate([feeds, alone])) + 1


def blocks(file, size: int, start: int, end: int, how: Coding, sign: str = "") -> Iterator[tuple[int, bytes, bool]]:
    """Lines whose first byte is from start to before end, several at once: their number, their bytes, whether the last of them has an end. file: read_at(bytes, offset); sign: what ends a line instead."""
    w = how.width
    place = start - w if start > how.mark else how.mark
    skip, data, read = start > how.mark, b"", place
    while True:
        piece = file.read_at(min(READ, size - read, max(end + w - read, BEHIND, len(data))), read) if read < size else b""
        read += len(piece)
        data += piece
        last = read >= size
        starts = np.concatenate([[0], _ends(np.frombuffer(data, how.kind, len(data) // w), last, sign)]) * w
        first = 1 if skip else 0  # lines from here on
        mine = int(np.searchsorted(starts[:-1] + place, end))  # whole lines that begin before end
        if mine > first:
            yield mine - first, data[starts[first] : starts[mine]], True
        done = starts[-1] + place >= end
        if not done and last:
            if len(starts) > first and starts[-1] + place < end:
                yield 1, data[starts[-1] :], False
            return
        if done or (skip and len(starts) == 1 and place + len(data) >= end):  # no line begins in a range that one line covers
            return
        skip = skip and len(starts) == 1
        data, place = data[starts[-1] :], place + int(starts[-1])


def texts_of(data: bytes, ended: bool, how: Coding, sign: str = "") -> list[str]:
    text = data.decode(how.name)
    lines = text.split(sign) if sign else text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    return lines[:-1] if ended else lines


@dataclass
class Range:
    path: str
    stem: str
    size: int
    part: int
    start: int
    end: int


@dataclass
class _Ranges(InputPartition):
    ranges: list


class _LinesReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.folder, self.encoding, self.suffix = options["path"].rstrip("/"), options.get("encoding", "utf-8"), options.get("suffix", ".txt")
        self.split, self.limit = int(options.get("split", SPLIT)), int(options.get("limit", -1))
        self.sign = options.get("sign", "")
        self.counts, self.cut_only = (options.get(x, "false").lower() == "true" for x in ("counts", "cutonly"))

    def _all(self) -> Iterator[Range]:
        store, root = files.at(self.folder)
        root = store.normalize_path(root).rstrip("/")
        found = sorted((f.path[len(root) + 1 : -len(self.suffix)], f.path, f.size) for f in files.listed(self.folder, self.suffix))
        if self.limit >= 0:
            found = found[: self.limit]
        width = coding(self.encoding).width
        for stem, path, size in found:
            parts = max(-(-size // max(self.split, min(SPLIT, size // RANGES))), 1) if width else 1
            if self.cut_only and parts == 1:
                continue
            cuts = [size * k // parts // max(width, 1) * max(width, 1) for k in range(parts)] + [size + 1]
            for k in range(parts):
                yield Range(path, stem, size, k, cuts[k], cuts[k + 1])

    def partitions(self) -> list[_Ranges]:
        """Small files, and ranges of files that are cut very often, are put together, so that the number of tasks doesn't grow with that of ranges."""
        every, out, load = list(self._all()), [[]], 0
        most = max(self.split, min(SPLIT, sum(r.end - r.start for r in every) // TASKS)) + OPEN
        for r in every:
            cost = r.end - r.start
            if out[-1] and (load + cost > most if out[-1][-1].path == r.path else load + cost + OPEN > most):
                out.append([])
                load = 0
            load += cost if out[-1] and out[-1][-1].path == r.path else cost + OPEN
            out[-1].append(r)
        return [_Ranges(r) for r in out]

    def read(self, partition: _Ranges) -> Iterator[pa.RecordBatch]:
        store, _ = files.at(self.folder)
        if not partition.ranges:
            yield self._batch(None, [], 0)
        for path, ranges in groupby(partition.ranges, key=lambda r: r.path):  # a file is opened once
            with store.open_input_file(path) as file:
                how = None
                for r in ranges:
                    how, nth = how or coding(self.encoding, file.read_at(min(4, r.size), 0)), 0
                    if not how.width:
                        data = file.read_at(r.size, 0)
                        found = iter([(1, data, False)])
                    else:
                        found = blocks(file, r.size, r.start, r.end, how, self.sign)
                    for n, data, ended in found:
                        if self.counts and how.width:
                            nth += n
                            continue
                        lines = texts_of(data, ended, how, self.sign)
                        if not self.counts:
                            for at in range(0, len(lines), ROWS):
                                yield self._batch(r, lines[at : at + ROWS], nth + at)
                        nth += len(lines)
                    if self.counts:
                        yield self._batch(r, [None], nth)

    def _batch(self, r: Range | None, lines: list, nth: int) -> pa.RecordBatch:
        n = len(lines)
        numbers = pa.array([nth] if self.counts and n else range(nth, nth + n), pa.int64())
        same = lambda x, kind: pa.repeat(pa.scalar(x, kind), n)
        columns = [same(r and r.stem, pa.string()), same(r and r.path, pa.string()), same(r.part if r else 0, pa.int32()), numbers, pa.array(lines, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["stem", "path", "part", "nth", "line"])


class TextLines(DataSource):
    """All files of a suffix below a folder: stem (path below the folder, without suffix), path, part (the range), nth (of the range's lines, from 0) and line.

    Options: suffix (.txt); encoding; split (bytes of a range); limit (files, in the order of stems); counts (a row a range, nth the number of
    its lines); sign (one of ASCII that ends a line instead of line ends); cutonly (only files of several ranges).
    """

    @classmethod
    def name(cls) -> str:
        return "lectern_lines"

    def schema(self) -> str:
        return "stem string, path string, part int, nth long, line string"

    def reader(self, schema) -> _LinesReader:
        return _LinesReader(dict(self.options))


def read_lines(spark, folder: str, encoding: str = "utf-8", limit: int | None = None, split: int = SPLIT, suffix: str = ".txt", sign: str = "") -> DataFrame:
    """stem, path, line_nr (from 0) and line of the text files below a folder. sign: what ends a line instead of line ends. Lines are not shuffled; a table of the ranges of large files tells their first numbers."""
    return ordered_lines(spark, folder, encoding, limit, split, suffix, sign)[0]


def ordered_lines(spark, folder: str, encoding: str = "utf-8", limit: int | None = None, split: int = SPLIT, suffix: str = ".txt", sign: str = "") -> tuple[DataFrame, bool]:
    """read_lines, and whether its rows are in the order of stems and lines: they are read so, and stay so where the table of ranges is broadcast."""
    spark.dataSource.register(TextLines)
    options = {"encoding": encoding, "split": split, "suffix": suffix} | ({"sign": sign} if sign else {}) | ({} if limit is None else {"limit": limit})
    read = lambda **more: spark.read.format("lectern_lines").options(**options, **more).load(folder)
    before = Window.partitionBy("stem").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = saved(read(counts=True, cutonly=True).select("stem", "part", F.coalesce(F.sum("nth").over(before), F.lit(0)).alias("first_")))
    few = firsts.count() <= FEW
    rows = read().join(F.broadcast(firsts) if few else firsts, ["stem", "part"], "left")
    return rows.select("stem", "path", (F.coalesce("first_", F.lit(0)) + F.col("nth")).cast("int").alias("line_nr"), "line"), few


def line_counts(spark, folder: str, encoding: str = "utf-8", limit: int | None = None, split: int = SPLIT) -> DataFrame:
    """stem, path and n_lines of each file; nothing is decoded where lines can be counted without."""
    spark.dataSource.register(TextLines)
    options = {"encoding": encoding, "split": split, "counts": True} | ({} if limit is None else {"limit": limit})
    return spark.read.format("lectern_lines").options(**options).load(folder).groupBy("stem", "path").agg(F.sum("nth").alias("n_lines"))
