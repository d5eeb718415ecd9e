"""What the reviewer's third round found: order, capitals, pairs of files, and what is read, shuffled and held."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import phonetics as ph
from lectern.functions import text as tx
from lectern.operators import export, filters, grams, transforms
from lectern.plans import catalog, flows
from lectern.plans.corpus import Corpus
from lectern.sources import lines


def corpus(spark, rows) -> Corpus:
    frame = catalog.with_symbols(spark.createDataFrame(rows, "utt_id long, reading string").withColumns({"path_id": F.lit(0).cast("long"), "line_nr": F.lit(0)}))
    return Corpus(frame, frame.select("utt_id", F.col("utt_id").alias("sel_rank")), spark.createDataFrame([(0, "p")], "path_id long, path string"))


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ranges_read_little_more_than_they_hold():
    """A range of few bytes read 8 MB."""

    class Counted:
        read = 0

        def read_at(self, n, at):
            self.read += n
            return data[at : at + n]

    data = b"".join(b"line %d\r\n" % i for i in range(60_000))
    file, how, n, step = Counted(), lines.coding("utf-8"), 0, 16_384
    for start in range(0, len(data), step):
        end = start + step if start + step < len(data) else len(data) + 1
        n += sum(m for m, _, _ in lines.blocks(file, len(data), start, end, how))
    assert n == 60_001 and file.read < 2 * len(data)


def test_ranges_share_tasks(tmp_path):
    """Every range was a task."""
    (tmp_path / "a.txt").write_bytes(b"x" * 99 + b"\n")
    reader = lines._LinesReader({"path": str(tmp_path), "split": "1"})
    real, lines.OPEN = lines.OPEN, 0
    try:
        found = reader.partitions()
    finally:
        lines.OPEN = real
    assert [len(list(reader._all())), sum(len(p.ranges) for p in found)] == [100, 100] and len(found) == 100
    reader.split = 1 << 20
    assert len(reader.partitions()) == 1


def test_order_by_symbols_with_large_ranks(spark):
    """F8: ranks of 2 ** 40 and more ran into the number of symbols."""
    c = corpus(spark, [(1 << 41, "a"), (5, "bb"), (1 << 42, "c"), (7, "dd")])
    order = export.in_order(c, "symbol_count_asc")
    assert [r["utt_id"] for r in order.orderBy("place").collect()] == [1 << 41, 1 << 42, 5, 7]


def test_capitals_sign_by_sign(spark):
    """upper() makes two signs of one."""
    df = spark.createDataFrame([("weißt",), ("ﬁx",), ("ᾳß",), ("plain",), (None,)], "w string")
    assert [r["u"] for r in df.select(tx.upper_signs(F.col("w")).alias("u")).collect()] == ["WEIẞT", "ﬁX", "ᾼẞ", "PLAIN", None]


def test_pairs_of_files_are_cut_alike(spark, tmp_path):
    """the two folders' ranges were cut by samples of their own, so files of one name had other lines."""
    rows = [(i, "\n".join(f"word{i} of{k} {'x' * (i % 50)}" for k in range(20)), "en", "s", 1) for i in range(4000)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    assert flows.q_ingest_pairs(spark, str(tmp_path)).count() == sum(i % 50 > 0 for i in range(4000)) * 20


def test_changes_of_ipa_call_nothing_a_symbol(spark):
    """functions were called for each symbol, of all seven changes."""
    df = spark.createDataFrame([(["ˈaʊ", "t͡ʃ", "a˥", "ʊ", "", "x", "aʊˈ", "\u0001"],), ([],), (None,)], "s array<string>")
    changed = lambda **how: df.select(ph.change_ipa(F.col("s"), **how).alias("x"))
    assert "lambda" not in plan(changed(ignore_tones=True, ignore_stress=True, ignore_arcs=True, break_n_thongs=True))
    of = lambda **how: [r["x"] for r in changed(**how).collect()]
    assert of(break_n_thongs=True) == [["ˈa", "ʊ", "t", "ʃ", "a˥", "ʊ", "x", "aʊ", "ˈ"], [], None]
    assert of(ignore_tones=True) == [["ˈaʊ", "t͡ʃ", "a", "ʊ", "x", "aʊˈ", "\u0001"], [], None]
    assert of(build_n_thongs=True)[0] == ["ˈaʊ", "t͡ʃ", "a˥", "ʊ", "x", "aʊˈ"]


def test_rare_words_come_to_their_rows(spark):
    """the same phones whatever the table in Python holds; words with U+FFFF inside are one word."""
    df = spark.createDataFrame([(1, "the cat, the o''dog"), (2, "the ra￿re cat"), (3, None), (4, "")], "utt_id long, t string")
    lexicon = spark.createDataFrame([("the", ["DH", "AH0"])], "word string, phones array<string>")
    said = lambda n: {r["utt_id"]: r["p"] for r in transforms.eng_to_arpa(df, "t", lexicon, "p", in_place=n).collect()}
    want = said(1000)
    assert want[3] == want[4] == [] and want[2][:3] == ["DH", "AH0", " "] and "\0" not in "".join(want[2])
    assert said(1) == said(2) == said(0) == want


def test_most_frequent_takes_ties_whole(spark):
    """the most frequent words were sorted, whole tables of them sent by every task."""
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 1)], "word string, n long")
    of = lambda k: sorted(r["word"] for r in filters.most_frequent(df, k).collect())
    assert [of(0), of(1), of(2), of(3), of(9)] == [[], ["a"], ["a"], ["a", "b", "c"], ["a", "b", "c", "d"]]


def test_removals_meet_the_selection_once(spark):
    """each removal joined what all the ones before it had joined."""
    c = corpus(spark, [(1, "a b"), (2, "b"), (3, "cc c")])
    for _ in range(6):
        c = c.remove(F.length("reading") < 2)
    assert plan(c.selection).count("Join") == 1 and sorted(r["utt_id"] for r in c.selection.collect()) == [1, 3]


def test_symbols_are_not_shuffled(spark):
    """What is joined holds texts and numbers."""
    c = corpus(spark, [(1, "a b"), (2, "b")])
    assert [t for _, t in grams.gram_texts(c.utterances, {" "}).dtypes] == ["bigint", "bigint", "string", "boolean"]
    assert [r["text_"] for r in grams.gram_texts(c.utterances, {" "}).orderBy("utt_id").collect()] == ["ab", "b"]
    odd = spark.createDataFrame([(1, ["a", "bc", "", " "], ["x"])], "utt_id long, repr_syms array<string>, reading_syms array<string>")
    assert tuple(grams.gram_texts(odd, {" "}).first())[2:] == ("a\u0001bc\u0001", False)


def test_script_tables_are_read_by_lines(spark, tmp_path):
    """a part of a file was one value."""
    c = corpus(spark, [(i, f"line {i}" if i % 3 else "") for i in range(40)])
    export.write_script_tables(export.script(c, export.in_order(c, "by_index")), str(tmp_path))
    rows = export.read_script_tables(spark, str(tmp_path))
    assert "posexplode" not in plan(rows).lower()
    got = [r["line"] for r in rows.where("file = 'txt'").orderBy("place").collect()]
    assert got == [f"{i + 1:02}: " + (f"line {i}" if i % 3 else "") for i in range(40)]
