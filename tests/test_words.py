"""Inflections, words of many rows, and sentence ends, against brute force."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lectern.operators import affixes, filters, sentence_ends
from lectern.operators.affixes import Rule
from lectern.operators.sentences import split_corpus
from lectern.plans.corpus import Corpus, empty_selection

RULES = [
    Rule("S", "y", "ies", "[^aeiou]y"), Rule("S", "", "s", "[^sxzhy]"), Rule("D", "", "d", "e"), Rule("D", "", "ed", "[^ey]"), Rule("G", "e", "ing", "e", cross=False), Rule("N", "e", "", "e"),
    Rule("U", "", "un", ".", suffix=False), Rule("I", "l", "ill", "l", suffix=False), Rule("X", "", "ex", "[^e]", suffix=False, cross=False),
]
STEMS = [("try", "SD"), ("cry", "S"), ("tie", "SDGUN"), ("legal", "I"), ("London", "S"), ("NASA", ""), ("port", "SDXU"), ("tie", "X"), ("a", "S"), ("é", "S"), (None, "S"), ("void", None)]


def forms():
    """Every form of every stem, and whether it takes a prefix of another rule."""
    import re

    flags = {}
    for w, f in STEMS:
        if w is not None:
            flags.setdefault(w, set()).update(f or "")
    out = set()
    for w, own in flags.items():
        ends = [(w, True)] + [(w[: len(w) - len(r.strip)] + r.add, r.cross) for r in RULES if r.suffix and r.flag in own and re.search(f"({r.condition})$", w) and w.endswith(r.strip)]
        out |= {x for x, _ in ends}
        for x, crossed in ends:
            out |= {r.add + x[len(r.strip) :] for r in RULES if not r.suffix and r.flag in own and re.search(f"^({r.condition})", w) and w.startswith(r.strip) and (x == w or (crossed and r.cross))}
    return out


def accepts(word, every):
    title = word[:1].upper() + word[1:].lower()
    caps = word.upper() == word and word.lower() != word
    return word in every or ((caps or (word == title and word.lower() != word)) and word.lower() in every) or (caps and title in every)


def test_words_that_a_dictionary_accepts(spark):
    every = forms()
    assert {"tries", "untied", "illegal", "tying"} - every == {"tying"} and "unports" in every and "exports" not in every
    words = {w2 for w in every | {"tis", "untries", "exports", "uns", "s", "ies", "ed", "unlegal", "nasa", "Nasa", "LONDON", "lONDON", "london", "untiing", "ti", "vois"} for w2 in (w, w.upper(), w.title(), w + "s", "un" + w)} | {"", "?"}
    frame = spark.createDataFrame([(w,) for w in words] + [(None,)], "word string")
    stems = spark.createDataFrame([(w, None if f is None else list(f)) for w, f in STEMS], "word string, flags array<string>")
    got = [r["word"] for r in affixes.accepted(frame, stems, RULES).collect()]
    assert sorted(got) == sorted(w for w in words if w and accepts(w, every))
    assert affixes.accepted(frame, stems.limit(0), RULES).count() == 0 and affixes.accepted(frame.limit(0), stems, []).count() == 0
    plain = {r["word"] for r in affixes.accepted(frame, stems, []).collect()}
    assert plain == {w for w in words if w and accepts(w, {s for s, _ in STEMS if s})}


def test_dictionary_files(spark, tmp_path):
    (tmp_path / "x.aff").write_text("SET UTF-8\nFLAG long\n# comment\nSFX S1 Y 2\nSFX S1 y ies [^aeiou]y\nSFX S1 0 s/ab [^y] po:x\nPFX U1 N 1\nPFX U1 0 un .\nREP 1\n")
    (tmp_path / "x.dic").write_text("3\ntry/S1\nkm\\/h/S1U1 st:x\nplain\n\ntwo\tmore\n")
    stems, rules = affixes.read_dictionary(spark, str(tmp_path / "x.dic"), str(tmp_path / "x.aff"))
    assert rules == [Rule("S1", "y", "ies", "[^aeiou]y", True, True), Rule("S1", "", "s", "[^y]", True, True), Rule("U1", "", "un", ".", False, False)]
    assert {(r["word"], tuple(r["flags"])) for r in stems.collect()} == {("try", ("S1",)), ("km/h", ("S1", "U1")), ("plain", ()), ("two", ())}
    assert affixes.rules_of(["FLAG num", "SFX 12 Y 1", "SFX 12 0 s ."]) == ([Rule("12", "", "s", ".")], "num")


@pytest.mark.parametrize("in_place", [0, 2, 1000])
def test_unknown_and_rare_words_in_place_or_by_join(spark, in_place):
    texts = ["the cat the dog", "The zebra, the the", "zebra zebra", "", "the", None, "dog cat zebra xyz"] * 3 + ["once"]
    rows = spark.createDataFrame(list(enumerate(texts)), "utt_id long, text string")
    lexicon = spark.createDataFrame([("the",), ("dog",)], "word string")
    got = {r["utt_id"]: r["n_unknown"] for r in filters.unknown_word_counts(rows, "text", lexicon, in_place=in_place).collect()}
    words = [[w.strip(",") for w in (t or "").split(" ") if w] for t in texts]
    assert got == {i: n for i, ws in enumerate(words) if (n := sum(w.lower() not in ("the", "dog") for w in ws))}
    left = {r["utt_id"] for r in filters.without_rare_words(rows, "text", 4, in_place=in_place).collect()}
    counts = Counter(w for t in texts if t is not None for w in (" ".join(x.strip(",") for x in t.lower().split(" ") if x)).split(" "))
    assert left == {i for i, t in enumerate(texts) if t is None or all(counts[w.strip(",")] >= 4 for w in t.lower().split(" "))}


# sentence ends

GERMAN = ["Das ist z. B. ein Haus. Es steht am 3. Oktober leer.", "Dr. Schmidt kam am 12. Mai. Das war gut.", "Prof. Meier und Dr. Braun sind hier. Es ist gut! Das ist es? Ja.", "Im Jahr 1990. Das war es."]
OTHERS = ["das Haus ist gut und es war hier", "ja es ist das", "im Haus", "ein Haus"] * 30
MANY = [f"Dr. {n} sagt das. Es ist so." for n in ("Schmidt", "Meier", "Braun", "Weber")] * 12


def test_abbreviations_ordinals_and_initials_stay_whole(spark):
    rows = spark.createDataFrame(list(enumerate(GERMAN + OTHERS + MANY)), "utt_id long, text string")
    ends = sentence_ends.learn(rows, "text")
    assert "dr" in {r["kind"] for r in ends.abbreviations.collect()}
    want = [
        ["Das ist z. B. ein Haus.", "Es steht am 3. Oktober leer."], ["Dr. Schmidt kam am 12. Mai.", "Das war gut."],
        ["Prof. Meier und Dr. Braun sind hier.", "Es ist gut!", "Das ist es?", "Ja."], ["Im Jahr 1990.", "Das war es."],
    ]
    for in_place in (0, 3, 1000):  # pairs by a join, in part, in place
        cut = sentence_ends.split(rows, "text", ends, in_place=in_place).orderBy("utt_id").collect()
        assert [r["sentences"] for r in cut[:2] + cut[3:4]] == want[:2] + want[3:]
        assert all(s == ["Dr. " + t[4:].split(". ")[0] + ".", "Es ist so."] for s, t in ((r["sentences"], r["text"]) for r in cut[-48:]))


def test_scores_by_hand(spark):
    rows = [("etc. ok ok etc. a.b. ok. end",)] * 5 + [("etc and etc. so",)]
    frame = spark.createDataFrame(rows, "text string")
    tokens = [t for (x,) in rows for t in x.split(" ")]
    kind = lambda t: t.strip(".")
    n, stops = len(tokens), sum(t.endswith(".") for t in tokens)
    want = {}
    for k in {kind(t) for t in tokens}:
        a = sum(t.endswith(".") for t in tokens if kind(t) == k)
        b = sum(kind(t) == k for t in tokens) - a
        letters = len(k.replace(".", ""))
        ratio = -2 * (a * math.log(stops / n) + b * math.log(1 - stops / n) - a * math.log(0.99) - b * math.log(0.01))
        score = ratio * math.exp(-letters) * (k.count(".") + 1) * letters ** (-b)
        if a and score >= 0.3:
            want[k] = score
    got = {r["kind"]: r["score"] for r in sentence_ends.learn(frame, "text").abbreviations.collect()}
    assert got == pytest.approx(want) and want


def test_odd_texts(spark):
    odd = [(1, None), (2, ""), (3, "no end"), (4, "Hi.  \n There. "), (5, "." * 40), (6, "a. " * 20_000)]
    rows = spark.createDataFrame(odd, "utt_id long, text string")
    got = {r["utt_id"]: r["sentences"] for r in sentence_ends.split(rows, "text", sentence_ends.learn(rows, "text")).collect()}
    assert got[1] is None and got[2] == [""] and got[3] == ["no end"] and got[4] == ["Hi.", "There.", ""] and got[5] == ["." * 40] and len(got[6]) <= 2
    none = sentence_ends.learn(rows.limit(0), "text")
    assert none.abbreviations.count() == 0 and sentence_ends.split(rows.limit(0), "text", none).count() == 0


def test_corpus_by_learned_ends(spark):
    texts = GERMAN + OTHERS + MANY
    symbols = F.split("reading", "")
    rows = spark.createDataFrame(list(enumerate(texts)), "utt_id long, reading string").withColumns({"path_id": F.lit(0).cast("long"), "line_nr": F.lit(0), "reading_syms": symbols, "repr": F.col("reading"), "repr_syms": symbols})
    c = Corpus(rows, empty_selection(spark), spark.createDataFrame([(0, "x")], "path_id long, path string"))
    whole = split_corpus(c, ends=sentence_ends.learn(rows, "reading"))
    assert [r["reading"] for r in whole.utterances.orderBy("utt_id").limit(2).collect()] == ["Das ist z. B. ein Haus.", "Es steht am 3. Oktober leer."]
    assert split_corpus(c).utterances.count() > whole.utterances.count()
