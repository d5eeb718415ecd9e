"""The joint model of letters and phones against brute force."""

import itertools

import pytest
from pyspark.sql import functions as F

from lectern.functions import phonetics as ph
from lectern.operators import pronounce as p
from lectern.operators import transforms

WORDS = ["ship", "chip", "phone", "quick", "night", "cheese", "thing", "box", "rain", "boy", "day", "out", "ox", "shy", "kick", "sing", "a", "oo", "tch", "through", "aisle", "choir", "knee", "be", "bee", "ee"]
SILENT = [("knee", "N IY1"), ("knob", "N AA1 B"), ("know", "N OW1"), ("lamb", "L AE1 M"), ("comb", "K OW1 M"), ("name", "N EY1 M"), ("fame", "F EY1 M"), ("box", "B AA1 K S"), ("fox", "F AA1 K S")]


def lexicon(spark, words=WORDS):
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    return frame.select("word", ph.spelled_phones(F.col("word")).alias("phones")).union(spark.createDataFrame([(w, x.split()) for w, x in SILENT], "word string, phones array<string>"))


def all_cuts(letters, phones):
    if not letters:
        return [()] if not phones else []
    return [((letters[:a], tuple(phones[:b])), *rest) for a, b in p.SHAPES if a <= len(letters) and b <= len(phones) for rest in all_cuts(letters[a:], phones[b:])]


def test_expected_counts_are_those_of_all_cuts():
    weight = {}
    for w, phones in [(w, x.split()) for w, x in SILENT]:
        for k, u in enumerate(sorted({u for c in all_cuts(w, phones) for u in c})):
            weight.setdefault(u, 1 + k % 5)
    for w, phones in [(w, x.split()) for w, x in SILENT]:
        cuts = all_cuts(w, phones)
        score = {c: 1.0 for c in cuts}
        for c in cuts:
            for u in c:
                score[c] *= weight[u]
        want = {}
        for c in cuts:
            for u in c:
                want[u] = want.get(u, 0) + score[c] / sum(score.values())
        got = p.expected(w, phones, weight)
        assert got.keys() == want.keys() and all(got[u] == pytest.approx(want[u]) for u in want)
        cost = {u: p._cost(x / 100) for u, x in weight.items()}
        assert p.best_cut(w, phones, cost) == min(cuts, key=lambda c: (sum(cost[u] for u in c), c))


def test_decoding_is_that_of_all_sequences_of_units(spark):
    model = p.learn(lexicon(spark))
    assert model.order == 3 and len(model.units) > 30

    def sequences(word):
        """Units, and the letters skipped as no unit begins there."""
        if not word:
            return [((), 0)]
        here = [(u, a) for a in (1, 2) if a <= len(word) for u in model.of.get(word[:a], ())]
        return [((u, *rest), n) for u, a in here for rest, n in sequences(word[a:])] or [(rest, n + 1) for rest, n in sequences(word[1:])]

    def cost(units, skipped):
        line = [*model.start(), *units, p.END]
        return sum(p._cost(model.share(tuple(line[k - 2 : k]), line[k])) for k in range(2, len(line))) + skipped * p.SKIP

    for word in ["knox", "shee", "comb", "ough", "q", "nigh", "tchai", "?k?", *map("".join, itertools.product("ehp", repeat=3))]:
        best = min((cost(*s), s[0]) for s in sequences(word))[1]
        assert model.decode(word) == [x for u in best for x in model.units[u][1]], word
    for history in {g[:-1] for g in model.grams}:  # shares of what may follow add up
        assert sum(model.share(history, u) for u in [*range(len(model.units)), p.END]) == pytest.approx(1)


def test_the_same_model_in_any_partitioning(spark):
    one, other = (p.learn(lexicon(spark).repartition(n)) for n in (1, 7))
    assert one.units == other.units and one.grams == other.grams


def test_words_left_out_are_said_right(spark):
    """Rules with digraphs and silent letters are learned from one half and hold in the other."""
    parts = ["sh", "ch", "ee", "a", "n", "ph", "o", "t", "ck", "i", "ng", "ai", "b"]
    words = sorted({"".join(x) for n in (3, 4) for x in itertools.product(parts, repeat=n)})[::17]
    half = lambda k: lexicon(spark, words[k::2]).limit(len(words[k::2]))
    model = p.learn(half(0))
    r = p.phone_errors(half(1), model).first()
    assert r["words"] > 500 and r["errors"] <= 0.02 * r["phones"]


def test_odd_rows_teach_nothing_and_odd_words_have_phones(spark):
    odd = [(None, ["A"]), ("x", None), ("", ["A"]), ("x", []), ("x", [None]), ("ab", ["A"] * 9), ("y" * 200, ["Y"] * 200)]
    none = p.learn(spark.createDataFrame(odd, "word string, phones array<string>"))
    assert none.units == [] and none.decode("abc") == []
    model = p.learn(lexicon(spark).union(spark.createDataFrame(odd, "word string, phones array<string>")))
    assert model.grams == p.learn(lexicon(spark)).grams
    rows = spark.createDataFrame([("",), (None,), ("ß7",), ("a" * 3000,)], "w string").select("w", model.phones(F.col("w")).alias("x")).collect()
    assert [r["x"] if r["w"] is None or len(r["w"]) < 9 else len(r["x"]) for r in rows] == [[], None, [], 3000]


def test_an_order_with_too_many_ngrams_is_left_out(spark):
    whole = p.learn(lexicon(spark))
    pairs = sum(len(g) <= 2 for g in whole.grams)
    less = p.learn(lexicon(spark), most_grams=pairs)
    assert less.order == 2 and less.grams == {g: n for g, n in whole.grams.items() if len(g) <= 2}


@pytest.mark.parametrize("in_place", [0, 3, 100])
def test_phones_in_place_or_by_join(spark, in_place):
    """The same whether all, some or no words are looked up where the rows lie."""
    rows = spark.createDataFrame([(1, "The ship's (big) ship\0 ''"), (2, None), (3, ""), (4, "ship the, zebra-ship the"), (5, "?!"), (5, "the")], "utt_id long, text string")
    words = spark.createDataFrame([("the", ["DH", "AH0"]), ("ship", ["SH", "IH1", "P"]), ("ship", ["SH", "IH1", "P"])], "word string, phones array<string>")
    got = transforms.eng_to_arpa(rows, "text", words, "phones", spelled=lambda w: F.array(F.upper(w)), in_place=in_place).collect()
    want = {
        (1, "The ship's (big) ship\0 ''"): ["DH", "AH0", " ", "SHIP'S", " ", "(", "BIG", ")", " ", "SH", "IH1", "P", "\0", " ", "''"], (2, None): [], (3, ""): [],
        (4, "ship the, zebra-ship the"): ["SH", "IH1", "P", " ", "DH", "AH0", ",", " ", "ZEBRA", "-", "SH", "IH1", "P", " ", "DH", "AH0"], (5, "?!"): ["?", "!"], (5, "the"): ["DH", "AH0"],
    }
    assert {(r["utt_id"], r["text"]): r["phones"] for r in got} == want
