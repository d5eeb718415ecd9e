"""What the reviewer's third round left open: work and space that grow no faster than the input."""

from __future__ import annotations

import random

from lectern.operators.pronounce import END, START, Pronouncer


def made_model(units) -> Pronouncer:
    rng, grams = random.Random(5), {}
    for _ in range(400):
        line = [START, START, *(rng.randrange(len(units)) for _ in range(rng.randrange(1, 8))), END]
        for at in range(2, len(line)):
            for k in range(3):
                gram = tuple(line[at - k : at + 1])
                grams[gram] = grams.get(gram, 0) + 1
    return Pronouncer(units, grams, 3)


def test_words_that_begin_alike_are_decoded_once():
    """each word was decoded from its first letter, whatever the word before it was."""
    units = sorted([*((c, (c.upper() + k,)) for c in "abdestz" for k in "01"), ("th", ("TH",)), ("e", ()), ("zzz", ("Z",)), ("xyz", ("X", "Z"))])
    rng = random.Random(7)
    words = ["".join(rng.choice("abdesthxyzé") for _ in range(rng.randrange(9))) for _ in range(300)]
    words += [w[: rng.randrange(len(w) + 1)] + rng.choice(["", "th", "z", "zzz", "xy", "xyz"]) for w in words] + ["x", "xy", "xyz", "xyx", "", None, "t", "th"]
    alone = [None if w is None else made_model(units).decode(w) for w in words[-60:]]
    model = made_model(units)
    assert model.decode_all(words)[-60:] == alone
    steps, real = [], model.moves
    model.moves = lambda history, letters: steps.append(letters) or real(history, letters)
    model._moves.clear()
    model.decode_all(["stets" + "a" * k for k in range(40)])
    assert len(steps) < 60  # histories of the letters that all share are gone through once


def test_tokens_are_grouped_before_their_kinds_are_found(spark):
    """regular expressions ran on every token, and three times on every text that is cut."""
    from pyspark.sql import functions as F

    from lectern.operators import sentence_ends

    rows = spark.createDataFrame([(1, "Dr. No met Dr. No. He left at 5. p.m. Yes! Été.  x y. "), (2, ""), (3, None), (4, "...  . a.")], "utt_id long, reading string")
    counts = sentence_ends.token_counts(F.col("reading"), rows)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("Aggregate")[-1].split("\n", 1)[1]
    assert plan.count("Aggregate") == 2 and "RLIKE" not in below and "btrim" not in below
    got = {(r["kind"], r["stop"], r["next"], r["capital"]): r["n"] for r in counts.collect()}
    assert got["dr", True, "no", True] == 2 and got["#", True, "p.m", False] == 1 and got["été", True, "x", False] == 1
    ends = sentence_ends.Ends(None, spark.createDataFrame([("dr\u0002no\u0002A",), ("été\u0002x\u0002a",), ("a\u0002\u0002a",)], "pair string"))
    for most in (10, 0):
        cut = {r["utt_id"]: r["sentences"] for r in sentence_ends.split(rows, "reading", ends, in_place=most).collect()}
        assert cut == {1: ["Dr. No met Dr. No.", "He left at 5.", "p.m.", "Yes!", "Été.  x y.", ""], 2: [""], 3: None, 4: ["...", ".", "a."]}
    assert sentence_ends.split(rows, "reading", ends)._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 0


def test_divergences_are_scored_where_rows_lie(spark):
    """each n-gram of each row was a row of a join and of a grouping by utterance."""
    import math

    from pyspark.sql import functions as F

    from lectern.functions import text as tx
    from lectern.operators import greedy

    rows = spark.createDataFrame([(1, "abca"), (2, "bb"), (3, "xy"), (4, "")], "utt_id long, reading string").withColumn("reading_syms", tx.graphemes(F.col("reading"))).withColumn("repr_syms", F.col("reading_syms"))
    scored = greedy.kld_scores(rows, spark.createDataFrame([(1,)], "utt_id long"), 1)
    assert "Aggregate" not in scored._jdf.queryExecution().executedPlan().toString()
    of = lambda *n: math.log(5) - math.log(sum(n)) + sum(x * math.log(x) for x in n) / sum(n)
    got = {r["utt_id"]: round(r["kld"], 9) for r in scored.collect()}
    assert got == {2: round(of(2, 3, 1), 9), 3: round(of(2, 1, 1, 1, 1), 9)}
    assert {r["kld"] for r in greedy.kld_scores(rows, rows.select("utt_id").limit(0), 1).collect()} == {None}


def test_ingest_of_readings_shuffles_no_text(spark, tmp_path):
    """texts were dealt by ranges though files are read in their order; F3, F5: a file was opened for each of its ranges."""
    from lectern.sources import lines, text_files

    texts = {f"f{k:02}": [f"{k} line {i}" if i % 7 else " " for i in range(k * 30)] for k in (3, 1, 10, 2)}
    for name, rows in texts.items():
        (tmp_path / f"{name}.txt").write_text("\n".join(rows))
    want = [(name, i, t) for name in sorted(texts) for i, t in enumerate(texts[name]) if t.strip()]
    shuffled, real = [], text_files.with_dense_ids
    text_files.with_dense_ids = lambda df, *how: shuffled.append(df.columns) or real(df, *how)
    try:
        got = text_files.ingest(spark, str(tmp_path), split=64).utterances.orderBy("utt_id").collect()
    finally:
        text_files.with_dense_ids = real
    assert [(r["utt_id"], r["line_nr"], r["reading"]) for r in got] == [(k, i, t) for k, (_, i, t) in enumerate(want)]
    assert shuffled == [["stem", "path"]]
    reader, opened = lines._LinesReader({"path": str(tmp_path), "split": "64"}), []

    class Store:
        def open_input_file(self, path):
            opened.append(path)
            return at(path)[0].open_input_file(path)

    at, lines.files.at = lines.files.at, lambda x: (Store(), x)
    part = lines._Ranges(ranges_of(tmp_path, lines))
    try:
        assert sum(len(b) for b in reader.read(part)) == sum(map(len, texts.values()))
    finally:
        lines.files.at = at
    assert len(opened) == 4 and len(part.ranges) > 40


def ranges_of(folder, lines):
    out = []
    for file in sorted(folder.glob("*.txt")):
        size = file.stat().st_size
        cuts = [*range(0, size, 64), size + 1]
        out += [lines.Range(str(file), file.stem, size, k, a, b) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    return out


def test_steps_write_no_symbols_that_are_characters(spark, tmp_path):
    """F16: a step held every character of its texts as a value of an array, twice."""
    from lectern.plans.corpus import CORPUS_SCHEMA, Corpus
    from lectern.sources import steps

    odd = [("ab", ["a", "b"]), ("ab", ["ab"]), ("", []), ("a b", ["a", "b"]), ("ab", ["ab", ""]), (None, None), ("ab", None), (None, ["a"]), ("é😀", ["é", "😀"]), ("ab", ["a", None, "b"]), ("ab", ["b", "a"])]
    rows = [(k, 0, k, t, s, "xy", ["x", "y"]) for k, (t, s) in enumerate(odd)]
    c = Corpus(spark.createDataFrame(rows, CORPUS_SCHEMA), spark.createDataFrame([(0, 0)], "utt_id long, sel_rank long"), spark.createDataFrame([(0, "p")], "path_id long, path string"))
    steps.write_step(c, f"{tmp_path}/s")
    again = steps.read_step(spark, f"{tmp_path}/s").utterances
    assert again.columns == c.utterances.columns and [tuple(r) for r in again.orderBy("utt_id").collect()] == rows
    alone = steps.read_columns(spark, f"{tmp_path}/s", "utt_id", "reading_syms").orderBy("utt_id").collect()
    assert [r["reading_syms"] for r in alone] == [s for _, s in odd]
    written = spark.read.parquet(*[str(p) for p in (tmp_path / "s").glob("tables-*/utterances")])
    assert written.where("repr_syms IS NOT NULL").count() == 0
    assert {r["utt_id"] for r in written.where("reading_syms IS NULL").collect()} == {0, 2, 5, 6, 8}
