"""Scripts for reading, and their time-aligned annotation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators.greedy import kld_order
from lectern.operators.ids import with_dense_ids
from lectern.operators.selection import ranked, tex_ids
from lectern.plans.corpus import Corpus
from lectern.saving import few_joined, saved
from lectern.sources.lines import SPLIT, read_lines
from lectern.sources.one_file import table_line, write_file

SEED = 1111
ORDERS = ("by_index", "by_selection", "symbol_count_asc", "random", "kld", "kld_parts")


def in_order(corpus: Corpus, order: str = "by_index", seed: int = SEED, ignore: Iterable[str] = (), parts: int = 1, take: int = 1) -> DataFrame:
    """utt_id and place (0-based) of the selection."""
    selection = corpus.selection
    if order == "by_selection":
        keys = selection.select("utt_id", F.col("sel_rank").alias("a"))
    elif order == "by_index":
        keys = selection.select("utt_id", F.col("utt_id").alias("a"))
    elif order == "random":
        keys = selection.select("utt_id", F.md5(F.concat_ws(":", F.lit(seed), "utt_id").cast("binary")).alias("a"))
    elif order == "symbol_count_asc":
        lengths = corpus.utterances.select("utt_id", F.size("reading_syms").alias("a"))  # before the join: symbols aren't shuffled
        keys = lengths.join(selection, "utt_id").select("utt_id", "a", F.col("sel_rank").alias("b"))
    elif order in ("kld", "kld_parts"):
        keys = kld_order(corpus.utterances, selection, set(ignore), parts if order == "kld_parts" else 1, take).select("utt_id", F.col("sel_rank").alias("a"))
    else:
        raise ValueError(f"no such order: {order}")
    return ranked(keys, [*keys.columns[1:], "utt_id"]).withColumnRenamed("sel_rank", "place")


def script(corpus: Corpus, order: DataFrame) -> DataFrame:
    """place, Id, Nr, Utterance, Representation, Path of the ordered ids. Nr counts from 1, with zeros as the largest needs."""
    rows = few_joined(corpus.utterances.join(order, "utt_id"), corpus.paths, ["path_id"], "left")
    most = order.agg(F.count(F.lit(1)).alias("n"))
    return rows.crossJoin(F.broadcast(most)).select("place", F.col("utt_id").alias("Id"), tx.zero_filled(F.col("place") + 1, F.col("n")).alias("Nr"), F.col("reading").alias("Utterance"), F.col("repr").alias("Representation"), F.col("path").alias("Path"))


def deselected_order(corpus: Corpus) -> DataFrame:
    """The rest of the corpus, by id."""
    return ranked(corpus.deselected().select("utt_id"), ["utt_id"]).withColumnRenamed("sel_rank", "place")


def numbered_line() -> Column:
    return F.concat_ws(": ", "Nr", "Utterance")


def tex_item(use_hint: bool = True) -> Column:
    """An item ends with its id; a hint shows ! or ? before it is read."""
    end = F.right(F.col("Utterance"), F.lit(1))
    hint = F.when(end.isin("!", "?"), F.concat(end, F.lit(" "))).otherwise("") if use_hint else F.lit("")
    return F.concat(F.lit("  \\item "), hint, "Utterance", F.lit(" % "), F.col("Id").cast("string"))


#: The columns of a script's table, and the frame of its TeX file.
COLUMNS = ["Id", "Nr", "Utterance", "Representation", "Path"]
TEX_BEGIN, TEX_END = "\\begin{enumerate}[label={\\protect\\threedigits{\\theenumi}:}]", "\\end{enumerate}"


def _ordered(rows: DataFrame, *columns: Column | str) -> DataFrame:
    return saved(rows.repartitionByRange("place").sortWithinPartitions("place").select("place", *columns))


def write_scripts(rows: DataFrame, directory: str, name: str = "selected", only_txt: bool = False) -> None:
    """NAME.txt and unless only_txt NAME.csv, _consecutive.txt, .tex and _paths.txt, as single files whose parts executors write."""
    kinds = {".txt": (numbered_line(), {"between": "\n"})}
    if not only_txt:
        kinds |= {
            "_consecutive.txt": (F.col("Utterance"), {"between": " "}), "_paths.txt": (F.col("Path"), {"between": "\n"}),
            ".tex": (tex_item(), {"head": f"{TEX_BEGIN}\n", "after": "\n", "foot": TEX_END}), ".csv": (table_line(COLUMNS), {"head": "\t".join(COLUMNS) + "\n", "after": "\n"}),
        }
    ordered = _ordered(rows, *COLUMNS)
    for end, (line, how) in kinds.items():
        write_file(ordered.select("place", line.alias("line")), f"{directory}/{name}{end}", ordered=True, **how)


def read_table(spark, directory: str, name: str = "selected", split: int = SPLIT) -> DataFrame:
    """The rows of NAME.csv. A line with an odd number of quotes ends inside a value; without one the file is read by ranges, else as a whole."""
    lines = read_lines(spark, directory, split=split, suffix=f"{name}.csv", sign="\n")
    across = not lines.where(F.length(F.regexp_replace("line", '[^"]', "")) % 2 == 1).isEmpty()
    how = {"multiLine": True} if across else {"lineSep": "\n"}
    return spark.read.csv(f"{directory}/{name}.csv", sep="\t", header=True, quote='"', escape='"', schema=", ".join(f"{c} string" for c in COLUMNS), **how)


#: Rows in a part of a file.
PART = 100_000


def write_script_tables(rows: DataFrame, directory: str) -> None:
    """The same five files as folders of parts in order, written by executors: txt, consecutive, paths, tex (items without their frame) and csv."""
    ordered = saved(rows.repartitionByRange("place").sortWithinPartitions("place").withColumns({"line": numbered_line(), "item": tex_item()}))
    for file, column, end in (("txt", "line", "\n"), ("consecutive", "Utterance", " "), ("paths", "Path", "\n"), ("tex", "item", "\n")):
        ordered.select(F.coalesce(column, F.lit(""))).write.option("lineSep", end).option("maxRecordsPerFile", PART).text(f"{directory}/{file}")
    ordered.select(*COLUMNS).write.option("maxRecordsPerFile", PART).csv(f"{directory}/csv", sep="\t", header=True, quote='"', escape='"', emptyValue="")


def read_script_tables(spark, directory: str) -> DataFrame:
    """file, place, line of what write_script_tables wrote; of consecutive, the words. Table rows are joined by tabs, in the order of Nr."""
    texts = None
    for file in ("txt", "consecutive", "paths", "tex"):
        end = " " if file == "consecutive" else "\n"
        lines = spark.read.text(f"{directory}/{file}", lineSep=end)  # in the order of parts, of the blocks that a part is read by, and of a block's lines
        lines = lines.select(F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
        placed = with_dense_ids(lines, ["part", "block", "at"], "place")
        placed = placed.select(F.lit(file).alias("file"), "place", "line")
        texts = placed if texts is None else texts.union(placed)
    table = spark.read.csv(f"{directory}/csv", sep="\t", header=True, quote='"', escape='"', multiLine=True, schema="Id string, Nr string, Utterance string, Representation string, Path string")
    return texts.union(table.select(F.lit("csv"), F.col("Nr").cast("long") - 1, F.concat_ws("\t", *COLUMNS)))


#: The tiers' names.
GRAPHEME_TIER, PHONEME_TIER = "sentences (graphemes)", "sentences (phonemes)"


#: Lines of a script whose durations one window sums.
BUCKET = 4096


def textgrid(corpus: Corpus, tex: DataFrame, column: str = "value", speed: float = tx.READING_SPEED, part: str | None = None) -> DataFrame:
    """tier, idx, min_t, max_t, mark: the script's utterances, one after the other, each as long as its reading takes. part as in tex_ids."""
    placed = ranked(tex_ids(tex, column, part).join(corpus.utterances.select("utt_id"), "utt_id", "left_semi"), ["sel_rank"])
    lengths = corpus.utterances.select("utt_id", F.size("reading_syms").cast("long").alias("n"))  # texts and symbols are large, so they join at the end or not at all
    rows = saved(lengths.join(placed, "utt_id").withColumn("bucket", F.floor(F.col("sel_rank") / BUCKET)))
    sums = rows.groupBy("bucket").agg(F.sum("n").alias("sum_n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row for BUCKET lines
    starts = sums.select("bucket", F.coalesce(F.sum("sum_n").over(before), F.lit(0)).alias("start"))
    upto = Window.partitionBy("bucket").orderBy("sel_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    timed = rows.withColumn("upto", F.sum("n").over(upto)).join(starts, "bucket").select("utt_id", "sel_rank", "n", (F.col("start") + F.col("upto")).alias("upto"))
    timed = corpus.utterances.select("utt_id", "reading", "repr").join(timed, "utt_id")
    tier = lambda name, mark: F.struct(F.lit(name).alias("tier"), F.col(mark).alias("mark"))
    timed = timed.withColumn("t", F.explode(F.array(tier(GRAPHEME_TIER, "reading"), tier(PHONEME_TIER, "repr"))))
    return timed.select("t.tier", F.col("sel_rank").alias("idx"), ((F.col("upto") - F.col("n")) / speed).alias("min_t"), (F.col("upto") / speed).alias("max_t"), "t.mark")


def write_textgrid(grid: DataFrame, path: str) -> None:
    """The long text form of TextGrid files: both tiers one after the other, each with its intervals. One file, whose parts executors write."""
    names, far = (GRAPHEME_TIER, PHONEME_TIER), 1 << 40
    number = F.pandas_udf(lambda x: x.map(repr), "string")  # as short as it can be
    grid = saved(grid.withColumns({"from_": number("min_t"), "to_": number("max_t")}))  # before rows are dealt by place: that reads them twice
    known = {r["tier"]: r for r in grid.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.max("max_t").alias("end")).collect()}
    end = max((r["end"] for r in known.values()), default=0.0)
    mark = F.replace("mark", F.lit('"'), F.lit('""'))
    pad, j = " " * 12, (F.col("idx") + 1).cast("string")
    line = F.concat(F.lit("        intervals ["), j, F.lit(f"]:\n{pad}xmin = "), F.col("from_"), F.lit(f"\n{pad}xmax = "), F.col("to_"), F.lit(f'\n{pad}text = "'), mark, F.lit('"'))
    rows = grid.select((F.when(F.col("tier") == names[0], 0).otherwise(1) * F.lit(far) + F.col("idx") + 1).cast("long").alias("place"), line.alias("line"))
    tops = [(i * far, f'    item [{i + 1}]:\n        class = "IntervalTier"\n        name = "{name}"\n        xmin = 0\n        xmax = {end}\n        intervals: size = {known[name]["n"] if name in known else 0}') for i, name in enumerate(names)]
    head = ['File type = "ooTextFile"', 'Object class = "TextGrid"', "", "xmin = 0", f"xmax = {end}", "tiers? <exists>", f"size = {len(names)}", "item []:", ""]
    write_file(rows.union(grid.sparkSession.createDataFrame(tops, "place long, line string")), path, head="\n".join(head), after="\n")
