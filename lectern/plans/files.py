"""Named queries that go by way of files: large ones read by ranges, other encodings, scripts and TextGrids as single files; and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators import export
from lectern.operators.ids import in_place_ids
from lectern.plans import catalog as base
from lectern.plans import flows
from lectern.sources.lines import read_lines
from lectern.sources.one_file import write_file
from lectern.sources.text_files import ingest

#: Bytes of a range, so small that the test tables' files are cut many times.
SPLIT = 16_384


def q_large_pairs(spark, sf_dir):
    """Two pairs of single large files, read by ranges. The second pair's files differ by a line, so it is left out."""
    at, rows = flows.folder(spark, "large"), flows.one_line(base.utterances(spark, sf_dir, ordered=True))
    placed = in_place_ids(rows.select("doc_id", "line_nr", "reading"), "place")
    for side, line in (("reading", F.col("reading")), ("repr", F.concat(F.lit("="), F.translate("reading", "aeiou", "AEIOU")))):
        for name, odd, foot in (("a", 0, ""), ("b", 1, "\nmore" if side == "repr" else "")):
            write_file(placed.where(F.col("doc_id") % 2 == odd).select("place", line.alias("line")), f"{at}/{side}/{name}.txt", between="\n", foot=foot, ordered=True)
    c = ingest(spark, f"{at}/reading", f"{at}/repr", split=SPLIT)
    return c.utterances.select("utt_id", "line_nr", "reading", "repr")


def q_wide(spark, sf_dir):
    """Files in UTF-16, by ranges."""
    at, rows = flows.folder(spark, "wide"), flows.one_line(base.utterances(spark, sf_dir, ordered=True))
    placed = in_place_ids(rows.select("doc_id", "line_nr", "reading"), "place")
    for name, part in (("a", F.col("doc_id") < 100), ("b", F.col("doc_id") >= 100)):
        write_file(placed.where(part).select("place", F.col("reading").alias("line")), f"{at}/{name}.txt", between="\r\n", ordered=True, encoding="utf-16-be")
    c = ingest(spark, at, encoding="utf-16-be", split=SPLIT)
    return c.utterances.select("utt_id", "reading", F.size("reading_syms").cast("long").alias("symbols"))


def _written(spark, sf_dir: str) -> str:
    c, at = flows.ranked_corpus(spark, sf_dir), flows.folder(spark, "files")
    export.write_scripts(export.script(c, export.in_order(c, "by_selection")), at)
    return at


def q_script_files(spark, sf_dir):
    """The five files of a script, read again."""
    at = _written(spark, sf_dir)

    def of(end: str, file: str, sign: str = "") -> DataFrame:
        return read_lines(spark, at, split=SPLIT, suffix=end, sign=sign).select(F.lit(file).alias("file"), F.col("line_nr").cast("long").alias("place"), "line")

    words = of("_consecutive.txt", "consecutive", " ")
    items = read_lines(spark, at, split=SPLIT, suffix=".tex").where(~F.col("line").isin(export.TEX_BEGIN, export.TEX_END))
    items = items.select(F.lit("tex").alias("file"), (F.col("line_nr") - 1).cast("long").alias("place"), "line")
    table = export.read_table(spark, at, "selected")
    table = table.select(F.lit("csv").alias("file"), (F.col("Nr").cast("long") - 1).alias("place"), F.concat_ws("\t", *export.COLUMNS).alias("line"))
    return of("selected.txt", "txt").union(words).union(of("_paths.txt", "paths")).union(items).union(table)


def read_textgrid(spark, folder: str, split: int = SPLIT) -> DataFrame:
    """tier, idx, min_t, max_t and mark of the TextGrid files in a folder: lines of an interval stand at fixed distances below its first one."""
    rows = read_lines(spark, folder, split=split, suffix=".TextGrid").where(~tx.is_blank(F.col("line")))
    named = rows.where("line LIKE '        name = %'").select(F.regexp_extract("line", '"(.*)"', 1).alias("tier"), F.col("line_nr").alias("from_"))
    tiers = named.groupBy().agg(F.array_sort(F.collect_list(F.struct("from_", "tier"))).alias("tiers"))  # two lines a file
    number = lambda name: F.regexp_extract("line", rf"^ {{12}}{name} = (\S+)$", 1)
    cells = rows.select(
        (F.col("line_nr") - F.when(F.col("line").startswith(" " * 12 + "xmin"), 1).when(F.col("line").startswith(" " * 12 + "xmax"), 2).when(F.col("line").startswith(" " * 12 + "text"), 3).otherwise(0)).alias("at"),
        F.regexp_extract("line", r"^ {8}intervals \[(\d+)\]:$", 1).alias("n"), number("xmin").alias("a"), number("xmax").alias("b"), F.regexp_extract("line", '^ {12}text = "(.*)"$', 1).alias("mark"),
    )
    whole = cells.groupBy("at").agg(*[F.max(c).alias(c) for c in ("n", "a", "b", "mark")]).where("n <> ''").crossJoin(F.broadcast(tiers))
    tier = F.element_at(F.filter("tiers", lambda x: x["from_"] < F.col("at")), -1)["tier"]
    return whole.select(tier.alias("tier"), (F.col("n").cast("long") - 1).alias("idx"), F.col("a").cast("double").alias("min_t"), F.col("b").cast("double").alias("max_t"), F.replace("mark", F.lit('""'), F.lit('"')).alias("mark"))


def q_textgrid_file(spark, sf_dir):
    c, at = base.corpus(spark, sf_dir), flows.folder(spark, "grid")
    slim = c.with_(utterances=c.utterances.where("doc_id % 5 = 0"))
    export.write_textgrid(export.textgrid(slim, base.rendered(spark, sf_dir), part="part"), f"{at}/script.TextGrid")
    return base._intervals(read_textgrid(spark, at))


def q_by_reading(spark, sf_dir):
    """The representation has other lengths than the reading: lines without most letters, twice where the line is of even length."""
    c = flows.ranked_corpus(spark, sf_dir)
    short = F.regexp_replace("reading", "[a-y]", "")
    text = F.when(F.length("reading") % 2 == 0, F.concat(F.lit("="), short, short)).otherwise(F.concat(F.lit("="), short))
    c = c.with_(utterances=c.utterances.withColumns({"repr": text, "repr_syms": tx.graphemes(text)}))
    return export.script(c, export.in_order(c, "symbol_count_asc")).select("Id", "Nr", "Utterance", "Representation")


_ODD = "'=' || CASE WHEN length(reading) % 2 = 0 THEN repeat(regexp_replace(reading, '[a-y]', '', 'g'), 2) ELSE regexp_replace(reading, '[a-y]', '', 'g') END"

FILES = {
    "ingest_large_pairs": (q_large_pairs, f"WITH {flows.ONE_LINE}, x AS (SELECT doc_id, line_nr AS l, reading FROM ol WHERE doc_id % 2 = 0) SELECT row_number() OVER (ORDER BY doc_id, l) - 1 AS utt_id, (row_number() OVER (ORDER BY doc_id, l) - 1)::INT AS line_nr, reading, '=' || translate(reading, 'aeiou', 'AEIOU') AS repr FROM x"),
    "ingest_utf16": (q_wide, f"WITH {flows.ONE_LINE} SELECT row_number() OVER (ORDER BY doc_id, line_nr) - 1 AS utt_id, reading, length(reading)::BIGINT AS symbols FROM ol"),
    "script_files": (q_script_files, flows.FLOWS["scripts_in_files"][1]),
    "textgrid_file": (q_textgrid_file, base.CATALOG["textgrid_intervals"][1]),
    "export_by_reading_length": (q_by_reading, f"{flows.ORDERED}, x AS (SELECT *, row_number() OVER (ORDER BY length(reading), rank) AS nr, count(*) OVER () AS n FROM s) SELECT utt_id AS Id, lpad(nr::VARCHAR, length(n::VARCHAR)::INT, '0') AS Nr, reading AS Utterance, {_ODD} AS Representation FROM x"),
}
