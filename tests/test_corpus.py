"""Operators on whole corpora."""

import pytest
from pyspark.sql import functions as F

from lectern import cli
from lectern.functions import text as tx
from lectern.operators import export, filters, greedy, stats
from lectern.operators import selection as sel
from lectern.operators.ids import with_dense_ids
from lectern.operators.sentences import split_corpus
from lectern.plans import pipelines
from lectern.plans.corpus import Corpus
from lectern.sources import steps
from lectern.sources.text_files import ingest
from lectern.streaming.rows import utterance_stream


def made(spark, texts, selected=()):
    rows = spark.createDataFrame([(i, 0, i, t) for i, t in enumerate(texts)], "utt_id long, path_id long, line_nr int, reading string")
    rows = rows.withColumns({"reading_syms": tx.graphemes(F.col("reading")), "repr": F.col("reading"), "repr_syms": tx.graphemes(F.col("reading"))})
    ids = spark.createDataFrame([(u, i) for i, u in enumerate(selected)], "utt_id long, sel_rank long")
    return Corpus(rows, ids, spark.createDataFrame([(0, "/x.txt")], "path_id long, path string"))


def ids(df, by="utt_id"):
    return [r["utt_id"] for r in df.orderBy(by).collect()]


def test_dense_ids(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = {r["k"]: r["utt_id"] for r in with_dense_ids(rows, ["k"]).collect()}
    assert got == {k: k for k in range(1000)}
    assert with_dense_ids(rows.limit(0), ["k"]).count() == 0


def test_filters_on_corpus(spark):
    c = made(spark, ["a b", "c d", "a b", "e"], [3, 0])
    assert ids(filters.first_of_duplicates(c.utterances, "repr")) == [0, 1, 3]
    assert ids(filters.without_rare_words(c.utterances, "repr", 2)) == [0, 2]
    lexicon = spark.createDataFrame([("a",), ("b",)], "word string")
    assert ids(filters.without_unknown_words(c.utterances, "repr", lexicon, 1)) == [0, 2, 3]
    left = c.remove(F.col("repr") == "e")
    assert ids(left.utterances) == [0, 1, 2] and ids(left.selection) == [0]
    assert ids(filters.without_rare_words(made(spark, ["...", "a a"]).utterances, "repr", 2)) == [1]


def test_selection_order(spark):
    c = made(spark, list("abcdef"), [4, 2])
    new = spark.createDataFrame([(5, 0), (2, 1), (0, 2)], "utt_id long, sel_rank long")
    assert ids(sel.add(c.selection, new), "sel_rank") == [4, 2, 5, 0]
    assert ids(sel.select(c.selection, new), "sel_rank") == [2, 5, 0]
    assert ids(sel.remove(c.selection, new), "sel_rank") == [4]
    assert ids(sel.select_all(c).selection, "sel_rank") == [4, 2, 0, 1, 3, 5]
    assert sel.deselect_all(c).selection.count() == 0
    tex = spark.createDataFrame([("  \\item b % 1\n  \\item x % 99\n  \\item c % 2\n % \n",)], "value string")
    assert ids(sel.tex_ids(tex), "sel_rank") == [1, 99, 2]
    assert ids(sel.select_from_tex(c, tex).selection, "sel_rank") == [2, 1]


def test_merge(spark):
    c = made(spark, list("abc"), [0])
    merged = sel.merge([c, c])
    assert ids(merged.utterances) == list(range(6)) and ids(merged.selection) == [0, 3]
    assert merged.paths.count() == 2
    with pytest.raises(ValueError):
        sel.merge([c, c.with_(language="ger")])


def test_greedy_takes_what_is_new(spark):
    c = made(spark, ["a", "b", "a"])
    got = ids(greedy.greedy(c.utterances, c.selection, "coverage", 1, 2.0, speed=1.0), "sel_rank")
    assert got == [0, 1]
    assert ids(greedy.greedy(c.utterances, c.selection, "coverage", 1, speed=1.0), "sel_rank") == [0, 1, 2]


@pytest.mark.parametrize("kind", ["kld", "coverage"])
def test_greedy_alone_and_distributed_agree(spark, kind):
    c = made(spark, ["abab", "abc", "ccc", "xyz", "aaa", "", "yx", "bcbc"], [4])
    alone = greedy.greedy(c.utterances, c.selection, kind, 1, 12.0, {"z"}, speed=1.0, one_task=10**6)
    spread = greedy.greedy(c.utterances, c.selection, kind, 1, 12.0, {"z"}, speed=1.0, one_task=0)
    got = ids(alone, "sel_rank")
    assert got == ids(spread, "sel_rank") and got and 4 not in got and 5 not in got
    assert sum(len(["abab", "abc", "ccc", "xyz", "aaa", "", "yx", "bcbc"][i]) for i in got) <= 12


def test_stats(spark):
    rows = stats.flagged(made(spark, ["ab", "b c d", "xx"], [1]).utterances, made(spark, [], [1]).selection)
    grams = {"".join(r["ngram"]): (r["selected"], r["not_selected"], r["total"]) for r in stats.ngram_stats(rows, 1).collect()}
    assert grams["b"] == (1, 1, 2) and grams["x"] == (0, 2, 2)
    assert stats.ngram_stats(rows.limit(0), 1).columns == ["ngram", "selected", "not_selected", "total", "selected_pct", "not_selected_pct", "total_pct"]
    none = stats.ngram_stats(rows.withColumn("selected", F.lit(False)), 1).first()
    assert none["selected_pct"] != none["selected_pct"]
    half = stats.duration_histogram(made(spark, ["abcde", "abc"]).utterances, 2.0).orderBy("second").collect()
    assert [(r["second"], r["utterances"]) for r in half] == [(2, 2)]  # 2.5 and 1.5 round to the even second


def test_script(spark, tmp_path):
    c = made(spark, ["Hi!", "b", "cc"], [2, 0])
    got = lambda order: [r["Id"] for r in export.script(c, export.in_order(c, order)).orderBy("place").collect()]
    assert got("by_index") == [0, 2] and got("by_selection") == [2, 0] and got("symbol_count_asc") == [2, 0]
    assert sorted(got("random")) == [0, 2] and sorted(got("kld")) == [0, 2] and sorted(got("kld_parts")) == [0, 2]
    with pytest.raises(ValueError):
        export.in_order(c, "other")
    export.write_scripts(export.script(c, export.in_order(c)), str(tmp_path / "s"))
    assert (tmp_path / "s/selected.txt").read_text() == "1: Hi!\n2: cc"
    assert (tmp_path / "s/selected_consecutive.txt").read_text() == "Hi! cc"
    tex = (tmp_path / "s/selected.tex").read_text()
    assert "  \\item ! Hi! % 0\n  \\item cc % 2\n" in tex
    grid = export.textgrid(c, spark.createDataFrame([(tex,)], "value string"), speed=1.0)
    times = [(r["min_t"], r["max_t"], r["mark"]) for r in grid.where("tier like '%graphemes%'").orderBy("idx").collect()]
    assert times == [(0.0, 3.0, "Hi!"), (3.0, 5.0, "cc")]
    export.write_textgrid(grid, str(tmp_path / "x.TextGrid"))
    assert 'text = "Hi!"' in (tmp_path / "x.TextGrid").read_text()


def test_split_corpus(spark):
    c = split_corpus(made(spark, ["One. Two.", "three"], [0]))
    assert [r["reading"] for r in c.utterances.orderBy("utt_id").collect()] == ["One.", "Two.", "three"]
    assert ids(c.selection) == [0, 1]
    assert split_corpus(made(spark, ["One. two.", "three"]), strict=True).utterances.count() == 1


def test_ingest_and_commands(spark, tmp_path):
    texts, base = tmp_path / "texts", str(tmp_path / "base")
    (texts / "sub").mkdir(parents=True)
    (texts / "a.txt").write_bytes(b"line1 NASA\r\nline2 ok ok\r\n\r\n")
    (texts / "sub/b.txt").write_text("line3\nline2 ok ok")
    (texts / "skip.md").write_text("no")
    run = lambda *args: cli.main(list(args), spark)
    run("create", base, "c", "s1", "--text_dir", str(texts))
    c = steps.read_step(spark, f"{base}/c/s1")
    rows = c.utterances.orderBy("utt_id").collect()
    assert [r["reading"] for r in rows] == ["line1 NASA", "line2 ok ok", "line3", "line2 ok ok"]
    assert [r["path_id"] for r in rows] == [0, 0, 1, 1] and c.paths.count() == 2
    run("remove-acronyms", base, "c", "s1", "s2")
    run("remove-duplicates", base, "c", "s2")
    assert ids(steps.read_step(spark, f"{base}/c/s2").utterances) == [1, 2]
    run("select-greedy-duration", base, "c", "s2", "--minutes", "1")
    run("gen-selected-script", base, "c", "s2", "--out_dir", str(tmp_path / "out"))
    assert (tmp_path / "out/selected.csv").read_text().startswith("Id\tNr\tUtterance\tRepresentation\tPath\n1\t1\tline2 ok ok")
    run("save-selection", base, "c", "s2", "--dataset", str(tmp_path / "d"))
    run("deselect-all", base, "c", "s2")
    run("load-selection", base, "c", "s2", "--dataset", str(tmp_path / "d"))
    assert ids(steps.read_step(spark, f"{base}/c/s2").selection) == [1, 2]


def test_step_is_whole_at_any_time(spark, tmp_path, monkeypatch):
    at = str(tmp_path / "s")
    c = made(spark, ["a b", "c", "NASA d"])
    counts = steps.write_step(c, at)
    assert counts["rows"] == 3 and counts["selected"] == c.selection.count() and abs(counts["seconds"] - 10 / 13.7) < 1e-9
    with pytest.raises(FileExistsError):
        steps.write_step(c, at)
    with pytest.raises(FileNotFoundError):
        steps.read_step(spark, str(tmp_path / "none"))

    def lost(*_):
        raise KeyboardInterrupt  # killed when all tables are written and the step does not name them yet

    old = steps.read_step(spark, at)
    fewer = old.with_(utterances=old.utterances.where("utt_id = 1"))
    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(steps._Store, "replace", lost)
        steps.write_step(fewer, at, overwrite=True)
    assert ids(steps.read_step(spark, at).utterances) == [0, 1, 2]
    steps.write_step(fewer, at, overwrite=True)
    assert ids(old.utterances) == [0, 1, 2], "who read the old step still can"
    now = steps.read_step(spark, at)
    assert ids(now.utterances) == [1] and steps.step_counts(spark, at)["rows"] == 1
    assert steps.removed_between(counts, steps.step_counts(spark, at)) == {"removed": 2, "kept": 1, "removed_pct": 66.666667}
    steps.write_step(now, at, overwrite=True)
    assert sorted(p.name[:6] for p in (tmp_path / "s").iterdir() if p.name[0] != ".").count("tables") == 3, "the new one, the one before, and the lost writer's"


def test_counts_of_an_empty_step(spark, tmp_path):
    c = made(spark, ["a b", "c"])
    empty = c.keep(c.utterances.where("utt_id < 0").distinct())
    for k, e in enumerate((empty, c.keep(c.utterances.limit(0)))):
        assert steps.write_step(e, str(tmp_path / f"s{k}")) == {"rows": 0, "selected": 0, "seconds": 0.0}
        assert steps.read_step(spark, str(tmp_path / f"s{k}")).utterances.count() == 0
    assert steps.removed_between({"rows": 0}, {"rows": 0})["removed_pct"] == 0.0


def test_files_of_different_length_are_left_out(spark, tmp_path):
    for d, lines in (("r", {"a": "x\ny", "b": "z"}), ("p", {"a": "1\n2", "b": "3\n4"})):
        (tmp_path / d).mkdir()
        for stem, text in lines.items():
            (tmp_path / d / f"{stem}.txt").write_text(text)
    c = ingest(spark, str(tmp_path / "r"), str(tmp_path / "p"))
    assert [(r["reading"], r["repr"]) for r in c.utterances.orderBy("utt_id").collect()] == [("x", "1"), ("y", "2")]


def test_pipelines(spark):
    words = spark.createDataFrame([(w,) for w in "this is a good test of it".split()], "word string")
    said = spark.createDataFrame([("test", ["T", "EH1", "S", "T"])], "word string, phones array<string>")
    c = made(spark, ["This is a  test.", "this is a test.", "A NASA test of it", "This is a good test of it", "is this (a) test"])
    out = pipelines.prepare(c, words, said)
    assert out.repr_format == "ipa"
    assert [r["reading"] for r in out.utterances.orderBy("utt_id").collect()] == ["This is a test.", "this is a test."]
    bands = pipelines.select_bands(made(spark, ["a" * 30, "b" * 60, "c" * 120]), minutes=1.0)
    assert ids(bands.utterances) == [0, 1, 2]


def test_empty_corpus(spark):
    c = made(spark, [])
    assert filters.without_rare_words(c.utterances, "repr", 2).count() == 0
    assert greedy.greedy(c.utterances, c.selection, "kld", 1).count() == 0
    assert split_corpus(c).utterances.count() == 0


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("One  two. NASA here.\nThree.")
    query = utterance_stream(spark.readStream.text(str(tmp_path / "in"))).writeStream.format("memory").queryName("rows").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r["text"] for r in spark.table("rows").collect()) == ["One two.", "Three."]


@pytest.mark.parametrize("kind, n", [("kld", 1), ("coverage", 1), ("coverage", 2), ("kld", 2)])
@pytest.mark.parametrize("pool", [8, 160])
def test_many_picks_a_pass_are_the_same_picks(spark, monkeypatch, kind, n, pool):
    """Ties, repeated rows and restarts of the coverage, in passes over 8 partitions."""
    import random

    monkeypatch.setattr(greedy, "POOL", pool)
    monkeypatch.setattr(greedy, "LEAST", 1)
    rng = random.Random(n)
    texts = ["".join(rng.choices("abcdefghij klmno", weights=range(16, 0, -1), k=rng.randint(1, 14))) for _ in range(240)]
    c = made(spark, texts + texts[:20], [3, 9])
    want = ids(greedy.greedy(c.utterances, c.selection, kind, n, 500.0, speed=1.0, one_task=10**6), "sel_rank")
    passes, picks = [], greedy._picks
    monkeypatch.setattr(greedy, "_picks", lambda *a: (passes.append(1), picks(*a))[1])
    rows = c.utterances.repartition(8)
    assert ids(greedy.greedy(rows, c.selection, kind, n, 500.0, speed=1.0, one_task=0), "sel_rank") == want and len(want) > 40
    if pool > 8:  # coverage of few kinds starts anew every pick or two, and a new start needs a pass
        assert len(passes) < len(want) * (1 if (kind, n) == ("coverage", 1) else 0.5), (len(passes), len(want))
