"""What the reviewer's third round found, of files and of tables at size."""

from __future__ import annotations

import pytest

from lectern.operators import export
from lectern.sources import lines


class Counted:
    def __init__(self, data: bytes):
        self.data, self.read = data, 0

    def read_at(self, n, at):
        self.read += n
        return self.data[at : at + n]


def by_ranges(data: bytes, step: int, sign: str = "") -> tuple[list[str], int]:
    file, how, out = Counted(data), lines.coding("utf-8"), []
    for start in range(0, len(data), step):
        end = start + step if start + step < len(data) else len(data) + 1
        for n, piece, ended in lines.blocks(file, len(data), start, end, how, sign):
            got = lines.texts_of(piece, ended, how, sign)
            assert n == len(got)
            out += got
    return out, file.read


@pytest.mark.parametrize("end", ["\n", "\r", "\r\n"])
def test_a_line_over_many_ranges_is_read_by_one(end):
    """each range inside one long line read on to its end."""
    texts = ["first", "word " * 40_000, "", "last"]
    for step in (997, 16_384):
        got, read = by_ranges(end.join(texts).encode(), step)
        assert got == texts and read < (12 if step < lines.BEHIND else 4) * 200_000


def test_lines_end_at_a_sign(spark, tmp_path):
    """the words of a script in one line were one value."""
    text = "a bb  c\nd\r\né 😀 " + "x" * 300
    assert by_ranges(text.encode(), 7, " ")[0] == text.split(" ")
    (tmp_path / "w.txt").write_bytes(text.encode())
    rows = lines.read_lines(spark, str(tmp_path), split=5, sign=" ").collect()
    assert [r["line"] for r in sorted(rows, key=lambda r: r["line_nr"])] == text.split(" ")


def test_ranges_of_a_file_do_not_grow_with_it(tmp_path, monkeypatch):
    """a file of 1 GB was 65,536 ranges, each opened and answered by itself."""
    monkeypatch.setattr(lines, "RANGES", 10)
    (tmp_path / "a.txt").write_bytes(b"x\n" * 500)
    ranges = list(lines._LinesReader({"path": str(tmp_path), "split": "8"})._all())
    assert len(ranges) == 10 and [r.start for r in ranges[1:]] == [r.end for r in ranges[:-1]]


@pytest.mark.parametrize("odd", ["plain", 'a "quote"', "cr\rin", "two\nlines", "tab\t\"\n\""])
def test_tables_are_read_by_ranges_where_they_can_be(spark, tmp_path, odd):
    """a script's table was read in one task."""
    rows = [(i, i, f"{i + 1}", odd if i == 5 else f"t{i}", "r", "p") for i in range(50)]
    frame = spark.createDataFrame(rows, "place long, Id long, Nr string, Utterance string, Representation string, Path string")
    export.write_scripts(frame, str(tmp_path), "s")
    got = export.read_table(spark, str(tmp_path), "s")
    assert sorted((int(r["Id"]), r["Utterance"]) for r in got.collect()) == [(i, t) for _, i, _, t, _, _ in rows]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        assert (export.read_table(spark, str(tmp_path), "s").rdd.getNumPartitions() > 1) == ("\n" not in odd)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_texts_of_scripts_are_shuffled_once(spark, tmp_path):
    """The order's join shuffled all texts for their lengths, and the paths' join shuffled them again, by few keys."""
    from pyspark.sql import functions as F

    from lectern.plans import flows

    rows = [(i, f"line {i}\nand more", "en", f"s{i % 2}", 1) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    joined = []
    real, flows.ranked = flows.ranked, lambda ids, order: joined.append(ids) or real(ids, order)
    try:
        c = flows.ranked_corpus(spark, str(tmp_path))
    finally:
        flows.ranked = real
    below = joined[0]._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[0]
    assert "length(" not in below  # lengths are made below the join
    made = export.script(c, export.in_order(c, "by_selection"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(path_id" not in plan and made.where(F.col("Path").isNull()).count() == 0
