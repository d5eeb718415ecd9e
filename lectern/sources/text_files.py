"""Line-aligned text files as a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators.ids import in_place_ids, with_dense_ids
from lectern.plans.corpus import Corpus, empty_selection
from lectern.saving import few_joined, saved
from lectern.sources.files import known
from lectern.sources.lines import SPLIT, line_counts, ordered_lines, read_lines

#: Encodings that Spark reads itself; others go through Python.
NATIVE = ("utf-8", "utf-16", "utf-16be", "utf-16le", "utf-32", "us-ascii", "iso-8859-1")


def text_files(spark, directory: str) -> DataFrame:
    """stem (path below the directory, without suffix) and path of all .txt files below it; no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").load(directory)
    root = spark._jvm.org.apache.hadoop.fs.Path(directory)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri().getPath().rstrip("/")
    stem = F.regexp_replace(F.expr(f"substring(regexp_replace(path, '^[a-z0-9]+:(//[^/]*)?(?=/)', ''), {len(root) + 2})"), r"\.txt$", "")
    return files.select(stem.alias("stem"), "path", "content")


def _lines(files: DataFrame, encoding: str, out: str) -> DataFrame:
    """stem, line_nr, n_lines and the line; line ends are \\n, \\r\\n or \\r."""
    if encoding.lower() in NATIVE:
        content = F.decode("content", encoding)
    else:

        @F.pandas_udf("string")
        def decoded(c):
            return c.map(lambda b: bytes(b).decode(encoding))

        content = decoded(F.col("content"))
    lines = F.split(F.regexp_replace(content, "\r\n?", "\n"), "\n")
    counted = files.select("stem", lines.alias("lines")).select("stem", "lines", F.size("lines").alias(f"n_{out}"))  # counted first, else each line's row would hold all lines
    return counted.select("stem", f"n_{out}", F.posexplode("lines").alias("line_nr", out))


def symbols_of(text, kind: str):
    return tx.graphemes(text) if kind == "graphemes" else tx.phones(text)


def parsable(text, kind: str):
    """Whether a line can be read as symbols: of graphemes any, of phones those with single spaces between symbols only."""
    return F.lit(True) if kind == "graphemes" else ~text.rlike("^ | $|  ")


def _whole_files(spark, directory: str, encoding: str, limit: int | None) -> DataFrame:
    """stem, path, line_nr, line and n_lines, of stores that only Spark opens: a file is a row."""
    files = text_files(spark, directory)
    if limit is not None:
        files = files.join(files.select("stem").orderBy("stem").limit(limit), "stem", "left_semi")
    return _lines(files, encoding, "line").join(files.select("stem", "path"), "stem").withColumnRenamed("n_line", "n_lines")


def ingest(spark, reading_dir: str, repr_dir: str | None = None, language: str = "eng", reading_format: str = "graphemes", repr_format: str | None = None, encoding: str = "utf-8", limit: int | None = None, split: int = SPLIT) -> Corpus:
    """A corpus of pairs of files with one stem, in the order of stems and lines.

    limit counts files. A pair of files with different numbers of lines is left out whole; a pair of lines is left out if
    either is blank or, in a format of symbols, has none. Paths are of the reading's files that give a row. Files are read by
    ranges of split bytes, in their order, so ids need a shuffle of the texts only for pairs; symbols are made behind it.
    """
    repr_format = repr_format or reading_format
    alone = repr_dir is None or repr_dir == reading_dir
    by_range = all(known(d) for d in (reading_dir, repr_dir or reading_dir))
    if by_range:
        rows, in_order = ordered_lines(spark, reading_dir, encoding, limit, split)
    else:
        rows, in_order = _whole_files(spark, reading_dir, encoding, limit), False
    rows = rows.withColumnRenamed("line", "reading")
    if alone:
        rows = rows.withColumn("repr", F.col("reading"))
    elif by_range:
        n_lines = [line_counts(spark, d, encoding, x, split).select("stem", "n_lines") for d, x in ((reading_dir, limit), (repr_dir, None))]
        paired = saved(n_lines[0].join(n_lines[1], ["stem", "n_lines"]).select("stem"))
        other = read_lines(spark, repr_dir, encoding, None, split).select("stem", "line_nr", F.col("line").alias("repr"))
        rows = few_joined(rows, paired, ["stem"], "left_semi").join(other, ["stem", "line_nr"])
    else:
        other = _whole_files(spark, repr_dir, encoding, None).select("stem", "line_nr", F.col("line").alias("repr"), F.col("n_lines").alias("n_repr"))
        rows = rows.join(other, ["stem", "line_nr"]).where("n_lines = n_repr")
    rows = rows.where(~tx.is_blank(F.col("reading")) & ~tx.is_blank(F.col("repr")))
    rows = rows.where(parsable(F.col("reading"), reading_format) & parsable(F.col("repr"), repr_format))  # what isn't blank has symbols
    symbols = {"reading_syms": symbols_of(F.col("reading"), reading_format), "repr_syms": symbols_of(F.col("repr"), repr_format)}
    rows = rows.select("stem", "path", "line_nr", "reading", *([] if alone else ["repr"]))
    rows = in_place_ids(rows) if alone and in_order else with_dense_ids(rows, ["stem", "line_nr"])
    rows = rows.withColumn("repr", F.col("reading")) if alone else rows
    paths = saved(with_dense_ids(rows.select("stem", "path").distinct(), ["stem"], "path_id"))
    rows = few_joined(rows, paths.select("stem", "path_id"), ["stem"]).withColumns(symbols)
    rows = rows.select("utt_id", "path_id", "line_nr", "reading", "reading_syms", "repr", "repr_syms")
    return Corpus(rows, empty_selection(spark), paths.select("path_id", "path"), language, reading_format, repr_format)


def read_tex(spark, path: str) -> DataFrame:
    """A script as one row, value."""
    return spark.read.text(path, wholetext=True)
