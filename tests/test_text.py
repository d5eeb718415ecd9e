"""Column functions against plain Python."""

import string

import pytest
from pyspark.sql import functions as F

from lectern.functions import phonetics as ph
from lectern.functions import text as tx
from lectern.operators import filters, transforms

TEXTS = ["", " ", "a  b", "U.S.A. is", "A1B ok", "123 USA", "India and London", "(Hello), World!", "...", "über ÜBER", "x y", "\x1c", "This is NASA; a test.", "ye yes", None]


def column(spark, texts, expression):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", expression(F.col("t")).alias("x")).collect()
    return [r["x"] for r in sorted(rows, key=lambda r: r["i"])]


def python_words(t):
    return [w for w in (x.strip(tx.PUNCTUATION) for x in t.split(" ")) if w]


def test_words_like_python(spark):
    assert column(spark, TEXTS[:-1], tx.stripped_words) == [python_words(t) for t in TEXTS[:-1]]
    assert column(spark, TEXTS[:-1], tx.stripped_text) == [" ".join(python_words(t)) for t in TEXTS[:-1]]


def test_acronyms_like_python(spark):
    assert column(spark, TEXTS[:-1], filters.has_acronym) == [any(len(w) >= 3 and w.isupper() for w in python_words(t)) for t in TEXTS[:-1]]


def test_blank_like_python(spark):
    assert column(spark, TEXTS[:-1], tx.is_blank) == [not t.strip() for t in TEXTS[:-1]]


def test_proper_names(spark):
    assert column(spark, ["India and London", "the India", "a Zoo", "Zoo", "x Été"], filters.has_proper_name) == [True, False, True, False, False]
    with pytest.raises(ValueError):
        filters.has_proper_name(F.col("t"), "ger")


def test_undesired(spark):
    assert column(spark, ["a ... b", "yes", "no", ""], lambda c: filters.has_undesired(c, {"...", "YE"})) == [True, True, False, False]
    assert column(spark, ["a"], lambda c: filters.has_undesired(c, set())) == [False]


def test_word_counts(spark):
    assert column(spark, ["", "a b", "a  b", "a b c d"], lambda c: filters.word_count_outside(c, 2, 3)) == [True, False, False, True]


def test_sentences(spark):
    assert column(spark, ["A b.", "a b.", "A b", "", "Ä!"], filters.is_sentence) == [True, False, False, False, True]
    assert column(spark, ["a b.", "a"], lambda c: filters.is_sentence(c, symbols="ipa")) == [True, False]
    assert column(spark, ["One. Two!  Three? four"], transforms.split_sentences) == [["One.", "Two!", "Three?", "four"]]


def test_ngrams(spark):
    assert column(spark, ["abc", "ab", "a", ""], lambda c: tx.ngrams(tx.graphemes(c), 2)) == [[["a", "b"], ["b", "c"]], [["a", "b"]], [], []]


def test_band_is_half_open(spark):
    seconds = lambda c: filters.in_duration_band(tx.graphemes(c), 3.0, 5.0, speed=1.0)
    assert column(spark, ["ab", "abc", "abcd", "abcde"], seconds) == [False, True, True, False]


def test_zero_filled(spark):
    rows = spark.createDataFrame([(0, 0, "0"), (5, 6, "5"), (5, 10, "05"), (5, 100, "005")], "n int, m int, want string")
    assert all(r["got"] == r["want"] for r in rows.select("want", tx.zero_filled(F.col("n"), F.col("m")).alias("got")).collect())


def test_normalize(spark):
    assert column(spark, ["t  t", " “a” – b… ", "\x00x\ty"], transforms.normalize) == ["t t", '"a" - b...', "x y"]
    assert column(spark, ["a , b . c"], transforms.tighten_punctuation) == ["a,b.c"]


def test_phones(spark):
    assert column(spark, ["T EH1 S T", "X9 AH0"], lambda c: ph.arpa_to_ipa(tx.phones(c))) == [["t", "ˈɛ", "s", "t"], ["X9", "ʌ"]]
    assert column(spark, ["a˥ ˈɛ t͡ʃ"], lambda c: ph.change_ipa(tx.phones(c), ignore_tones=True, ignore_stress=True, ignore_arcs=True)) == [["a", "ɛ", "tʃ"]]
    assert column(spark, ["aɪ t"], lambda c: ph.change_ipa(tx.phones(c), break_n_thongs=True)) == [["a", "ɪ", "t"]]
    assert column(spark, ["a ɪ t"], lambda c: ph.change_ipa(tx.phones(c), build_n_thongs=True)) == [["aɪ", "t"]]
    assert column(spark, ["ship"], ph.spelled_phones) == [["SH", "IH1", "P"]]


def test_arpa_keeps_signs_and_rows(spark):
    words = spark.createDataFrame([("test", ["T", "EH1", "S", "T"])], "word string, phones array<string>")
    rows = spark.createDataFrame([(0, "A Test."), (1, ""), (2, None)], "utt_id long, t string")
    got = {r["utt_id"]: r["p"] for r in transforms.eng_to_arpa(rows, "t", words, "p").collect()}
    assert got == {0: ["AE1", " ", "T", "EH1", "S", "T", "."], 1: [], 2: []}


def test_python_punctuation_is_stripped_from_ends_only(spark):
    texts = [f"{p}a{p}b{p}" for p in string.punctuation + "—"]
    assert column(spark, texts, tx.stripped_text) == [t.strip(tx.PUNCTUATION) for t in texts]
