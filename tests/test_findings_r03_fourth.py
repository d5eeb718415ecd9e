"""What the reviewer's third round left open, fourth turn: no text is shuffled to find which rows are selected."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators import greedy, members


@pytest.fixture
def no_small_sides(spark):
    """As at size: nothing is broadcast for being small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def corpus(spark, n: int):
    word = F.expr("array_join(transform(sequence(1, 40 + pmod(utt_id, 30)), i -> substring('abcdefghij klmnop', 1 + pmod(xxhash64(utt_id, i), 17), 1)), '')")
    rows = spark.range(n).select(F.col("id").alias("utt_id")).withColumn("reading", word).withColumn("reading_syms", tx.graphemes(F.col("reading"))).withColumn("repr_syms", F.col("reading_syms"))
    return rows, rows.where("utt_id % 5 = 0").select("utt_id", F.col("utt_id").alias("sel_rank"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("kind", "n"), [("coverage", 2), ("kld", 2), ("coverage", 1)])
def test_greedy_shuffles_no_text(spark, no_small_sides, monkeypatch, kind, n):
    """all texts were dealt by id and sorted to find the selected ones, so they were shuffled and spilled."""
    rows, chosen = corpus(spark, 400)
    plans, counted, saved = [], greedy.counted_grams, greedy.saved_table
    monkeypatch.setattr(greedy, "counted_grams", lambda texts, *how: plans.append(plan_of(texts)) or counted(texts, *how))
    monkeypatch.setattr(greedy, "saved_table", lambda df: plans.append(plan_of(df)) or saved(df))
    got = greedy.greedy(rows, chosen, kind, n, 30.0, ignore={" "}, band=(3.0, 5.0)).orderBy("sel_rank").collect()
    assert len(plans) == 3
    for plan in plans:
        assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and "ArrowEvalPython" not in plan and plan.count("MapInPandas") <= 1
    want = greedy.greedy(rows, chosen, kind, n, 30.0, ignore={" "}, band=(3.0, 5.0), one_task=1 << 40).orderBy("sel_rank").collect()
    assert got == want and len(got) > 5


def test_order_by_divergence_shuffles_no_text(spark, no_small_sides, monkeypatch):
    """the same step in the order of a selection; rows were shuffled with their symbols."""
    rows, chosen = corpus(spark, 100)
    plans, saved = [], greedy.saved_table
    monkeypatch.setattr(greedy, "saved_table", lambda df: plans.append(plan_of(df)) or saved(df))
    order = greedy.kld_order(rows, chosen, {" "}).collect()
    assert "hashpartitioning" not in plans[0]
    assert {r["utt_id"] for r in order} == set(range(0, 100, 5)) and sorted(r["sel_rank"] for r in order) == list(range(20))


@pytest.mark.parametrize("few", [10**6, 0])
@pytest.mark.parametrize("power", [20, 6])
def test_members_are_exact_at_any_size_of_the_filter(spark, no_small_sides, monkeypatch, few, power):
    """a filter of 128 bits lets most others pass; they are found by their ids, looked up or shuffled."""
    monkeypatch.setattr(members, "SLICE", power)
    monkeypatch.setattr(members, "MOST", 2)
    rows = spark.createDataFrame([(k % 900 if k != 5 else None, f"t{k}") for k in range(1000)], "utt_id long, text string")
    ids = spark.createDataFrame([(k,) for k in [*range(0, 900, 9), 0, 5000, None]], "utt_id int")
    own = members.Members(rows, ids, few=few)
    assert own.few == (few > 0) or not own.wrong.count()
    passes = own.passes
    asked = members.hashed(rows).mapInPandas(lambda parts: (p.assign(passed=passes(p["hash_"])).drop(columns="hash_") for p in parts), "utt_id long, text string, passed boolean")
    inside, outside = (sorted(r["text"] for r in own.kept(asked, i).collect()) for i in (True, False))
    is_member = lambda k: k != 5 and k % 900 % 9 == 0
    assert inside == sorted(f"t{k}" for k in range(1000) if is_member(k)) and outside == sorted(f"t{k}" for k in range(1000) if not is_member(k))
    assert own.kept(asked, True).columns == ["utt_id", "text"] == own.kept(asked, False).columns
    assert members.Members(rows, ids.limit(0)).passes is None


def test_batches_without_members_are_left_out(spark):
    """a batch of which no row passed had no lists to write."""
    rows, _ = corpus(spark, 40)
    got = greedy.greedy(rows, spark.createDataFrame([(3,)], "utt_id long"), "kld", 1, 10.0, ignore={" "}).collect()
    assert got and 3 not in {r["utt_id"] for r in got}
