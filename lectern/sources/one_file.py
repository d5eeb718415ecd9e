"""One text file, in order, from rows that lie on many executors.

Tasks write their lines to parts, as their bytes will be; a commit joins the parts in the order of their places, between a
head and a foot, and then moves the file to its name at once. Rows never come to the driver: the commit copies bytes, READ
at a time. Attempts that failed leave parts that no commit joins.

For files that one program or person reads. What need not be one file is better written as a folder of parts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from lectern.sources import files

READ = 8 << 20


@dataclass
class Part(WriterCommitMessage):
    name: str
    first: int
    last: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.encoding = options.get("encoding", "utf-8")
        self.head, self.foot, self.after, self.between = (options.get(x, "").encode(self.encoding) for x in ("head", "foot", "after", "between"))
        self.parts = f"{self.path}.parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        store, folder = files.at(self.parts)
        out, name, first, last = None, f"{folder}/{uuid.uuid4().hex}", None, None
        try:
            for batch in iterator:
                lines, places = batch.column("line").to_pylist(), batch.column("place").to_pylist()
                if not lines:
                    continue
                if sorted(places) != places or (last is not None and places[0] < last):
                    raise ValueError("rows of a task are not in the order of their places")
                if out is None:
                    store.create_dir(folder, recursive=True)
                    out, first = store.open_output_stream(name), places[0]
                else:
                    out.write(self.between)
                last = places[-1]
                out.write(self.between.join((x or "").encode(self.encoding) + self.after for x in lines))
        finally:
            if out is not None:
                out.close()
        return Part(name, first, last) if out is not None else Part("", 0, 0)

    def commit(self, messages: list) -> None:
        store, path = files.at(self.path)
        parts = sorted((m for m in messages if m and m.name), key=lambda m: (m.first, m.last))
        if any(a.last > b.first for a, b in zip(parts, parts[1:], strict=False)):
            self.abort(messages)
            raise ValueError("parts overlap: rows must be dealt by ranges of their places")
        store.create_dir(path.rpartition("/")[0], recursive=True)
        whole = f"{path}.{uuid.uuid4().hex}"
        with store.open_output_stream(whole) as out:
            out.write(self.head)
            for k, part in enumerate(parts):
                if k:
                    out.write(self.between)
                with store.open_input_stream(part.name) as data:
                    while piece := data.read(READ):
                        out.write(piece)
            out.write(self.foot)
        store.move(whole, path)
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        store, folder = files.at(self.parts)
        store.delete_dir_contents(folder, missing_dir_ok=True)
        if store.get_file_info(folder).type.name == "Directory":
            store.delete_dir(folder)


class OneFile(DataSource):
    """Rows of place and line. Options, all texts: head and foot of the file, after each line, between two lines; encoding, one that marks no order of bytes."""

    @classmethod
    def name(cls) -> str:
        return "lectern_file"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options))


def table_line(columns: Iterable[str]) -> Column:
    """A line of a table with tabs: values with a tab, a quote or a line's end are quoted."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    quoted = [F.when(v.rlike('[\\t"\\n\\r]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v) for v in values]
    return F.concat_ws("\t", *quoted)


def write_file(rows: DataFrame, path: str, head: str = "", foot: str = "", after: str = "", between: str = "", ordered: bool = False, encoding: str = "utf-8") -> None:
    """rows: place (long, its order) and line; a null line is empty. ordered: they are dealt by ranges of place and sorted already. A file of that name is replaced."""
    rows.sparkSession.dataSource.register(OneFile)
    rows = rows.select("place", "line")
    rows = rows if ordered else rows.repartitionByRange("place").sortWithinPartitions("place")
    rows.write.format("lectern_file").mode("overwrite").options(head=head, foot=foot, after=after, between=between, encoding=encoding).save(path)
