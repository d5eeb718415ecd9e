"""The pipeline's stages on a small corpus with known copies, secrets and insults."""

import random

import corpus_pipeline as cp


def test_stages(spark, tmp_path):
    rng = random.Random(2)
    parts = ["an", "the", "ti", "on", "er", "ou", "re", "st", "la", "do"]
    body = lambda: [" ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(80))]
    rows, labels = [], []
    for i in range(300):
        text = body()[0]
        if i % 5 == 0:
            text += " dunderhead numskull blockhead"
        if i % 7 == 1 and i % 5:
            text += " token=abcdefgh12345"
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, int(i % 5 == 0)))
    rows += [(1000 + i, rows[i][1], "en", "s9", rows[i][4]) for i in range(1, 40)]  # copies
    rows += [(2000, None, None, None, None), (2001, "", "en", "s0", 0), (2002, "few", None, None, 3), (2002, "few", None, None, 3)]
    one, other = body()[0], body()[0]
    rows += [(2003, one, "en", "s0", len(one)), (2003, other, "en", "s0", len(other)), (None, body()[0], "en", "s1", 9), (None, other + " tail", "en", "s1", 9)]  # unlike texts of one id; and a near copy without id
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        seen[name] = docs.toPandas()
        if k < 4:
            assert tuple(docs.columns) == cp.COLUMNS
    toxic, near, secret, mixed, packed = seen.values()
    clean = {r[0] for r in rows if r[0] is not None and r[0] != 2003 and not (r[0] % 5 == 0 and r[0] < 300 or r[0] in range(1000, 1040) and (r[0] - 1000) % 5 == 0)}
    assert len(set(toxic.doc_id.dropna()) ^ clean - {2003}) <= 3
    assert set(near.doc_id.dropna()) == set(toxic.doc_id.dropna()) - set(range(1001, 1040))
    assert sorted(near[near.doc_id == 2003].text) == sorted([one, other]) and near.doc_id.isna().sum() == 1
    assert len(near) == near.doc_id.nunique() + 2
    assert len(secret) == len(near) and not secret.text.fillna("").str.contains("abcdefgh12345").any() and secret.text.fillna("").str.contains(r"\[SECRET\]").sum() > 30
    assert set(mixed.doc_id.dropna()) <= set(secret.doc_id.dropna()) and mixed.groupby("text").size().max() <= 3
    assert sorted(packed[packed.piece == 0].doc_id.fillna(-1)) == sorted(mixed.doc_id.fillna(-1))
    assert cp.run(spark, str(tmp_path)).count() == len(packed)


def test_stages_of_empty_tables_and_clashing_columns(spark, tmp_path):
    documents = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], documents).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
    rows = [(i, f"some words of text {i}", "en", "s", 9) for i in range(6)]
    clashing = "key long, row long, mark string, clean string, copies long, size long, toxic_score double, group long, bin_id long, its_id long"
    docs = spark.createDataFrame([(*r, 1, 1, "m", "c", 1, 1, 0.5, 1, 1, 1) for r in rows], f"{documents}, {clashing}")
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/clash{k}")
        assert spark.read.parquet(f"{tmp_path}/clash{k}").where("text like 'some words of text%'").count() >= 5
