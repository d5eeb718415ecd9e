"""What the reviewer's fourth round found: batches of seven texts a row on their way from Python."""

from __future__ import annotations

import itertools
import re

from pyspark.sql import functions as F

from lectern.functions import phonetics as ph
from lectern.operators import transforms
from lectern.plans import flows


def one_by_one(symbols, tones, arcs, stress, breaks, builds):
    """The changes, symbol by symbol."""
    drop = lambda s, signs: "".join(x for x in s if x not in signs)
    out = [drop(s, ph.TONES * tones + "ˈˌ" * stress) for s in symbols]
    if breaks:
        out = [p for s in out for p in re.split(f"[{ph.ARCS}\u0001]", s)]
        out = [x for p in out for x in ((p[:-1], p[-1]) if drop(p, "ˈˌ") in ph.DIPHTHONGS else (p,))]
    if builds:
        out = [p for s in out for p in s.split("\u0001")]
    out = [drop(s, ph.ARCS * arcs) for s in out]
    if builds:
        met = []
        for a, s in itertools.zip_longest(out, out[1:]):
            joined = bool(a and s) and a[-1] + s[0] in ph.DIPHTHONGS
            met.append(a + ("" if joined else "￿"))
        out = "".join(met).split("￿")
    return [s for s in out if s]


def test_changed_rows_wait_in_no_batch(spark, tmp_path):
    """a row's seven changes came from Python, 10,000 rows in a batch, and its phones were arrays mapped symbol by symbol."""
    rows = [(1, "Now; the church, a ˥ choice|joy\nwow'' out-now\u0001 ˈa", "en", "s", 1), (2, "ein Tag", "de", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("i", "Church now out joys")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    changed = flows.q_change_ipa(spark, str(tmp_path))
    plan = changed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("MapInArrow") == 1 and "lambda" not in plan
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    symbols = flows.marked_ipa(F.col("phones"))
    for r, before in zip(changed.orderBy("utt_id").collect(), flows.spoken(spark, str(tmp_path)).orderBy("utt_id").select(symbols.alias("x")).collect(), strict=True):
        for name, how in flows.CHANGES.items():
            flags = [how.get(k, False) for k in ("ignore_tones", "ignore_arcs", "ignore_stress", "break_n_thongs", "build_n_thongs")]
            assert r[name] == "|".join(one_by_one(before["x"], *flags))


def test_changes_of_texts_are_those_of_symbols(spark):
    """of every set of changes, also of symbols side by side, with marks and signs beyond 16 bits."""
    signs = ["a", "ʊ", "aʊ", "ˈaʊ", "aˌɪ", "eɪˈ", "ˈ", "", "˥", "a˥", "ʊ˩", "t͡ʃ", "t", "ʃ", "͜", "d͜ʒ", "\u0001", "a\u0001ɪ", "o", "ɔ", "ɪ", "|", " ", "aʊʊ", "xaʊ", "😀", "😀aʊ", "aʊ😀", "tʃ"]
    rows = [(list(x),) for x in itertools.product(signs, repeat=2)] + [(signs,), (signs[::-1],), ([],), ([""],), (["aʊ"] * 5,)]
    df = spark.createDataFrame(rows, "s array<string>")
    ways = [w for w in itertools.product((False, True), repeat=5) if not (w[3] and w[4])]
    got = df.select("s", *[ph.change_ipa(F.col("s"), *w).alias(f"c{i}") for i, w in enumerate(ways)]).collect()
    for r in got:
        for i, w in enumerate(ways):
            assert r[f"c{i}"] == one_by_one(r["s"], *w), (r["s"], w)


def test_changed_rows_go_back_in_parts(spark):
    """the same rows however few signs are sent at once, changes are kept and words are looked up in place."""
    df = spark.createDataFrame([(1, "now, the church"), (2, None), (3, ""), (4, "˥ now˥out ''"), (5, "joy " * 300)], "utt_id long, t string").coalesce(1)
    lexicon = spark.createDataFrame([("the", ["ð", "ˈa", "ʊ"])], "word string, phones array<string>")
    spelled = lambda w: flows.marked_ipa(ph.spelled_phones(w))
    made = lambda **how: sorted(transforms.eng_to_changed_ipa(df, "t", lexicon, flows.CHANGES, "|", spelled=spelled, **how).collect())
    want = made()
    assert [r["utt_id"] for r in want] == [1, 2, 3, 4, 5] and set(want[1][1:]) == set(want[2][1:]) == {""}
    assert want[0]["built"] == "n|ˈoʊ|,| |ð|ˈaʊ| |t͡ʃ|ˈʌ|ɹ|t͡ʃ" and want[3]["no_tones"] == " |n|ˈoʊ|ˈaʊ|t| |''" and want[4]["plain_broken"].count("ɔ|ɪ") == 300
    assert made(sent=1, kept=0) == made(in_place=1) == want
