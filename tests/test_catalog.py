"""Queries against their SQL in DuckDB, on a small table of documents with odd lines."""

import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from lectern.operators import export
from lectern.plans.queries import CATALOG

TEXTS = [
    "Hello London town.\nA NASA test (x) of it!\n\nthe end", "ab", "x y  z\tq", "One. Two! Three? four\nOne. Two! Three? four", "“Quoted” – text… and ‘more’", "...", "the the the cat", "É à la carte, India. B",
    "password @ 50% * \"q\"", "a" * 60 + " b", "U.S.A. is A1B 123", "last one here\nlast one here",
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("sf")
    docs = [(i, t, "en" if i % 4 else "fr", f"s{i % 3}", len(t)) for i, t in enumerate(TEXTS * 3)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, "the end of one test"), (2, "cat")], "item_id long, text string").coalesce(1).write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 0, "user", "x")], "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{at}/conversations.parquet")
    return str(at)


def rows_of(columns, rows):
    plain = lambda v: "null" if v is None else f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else str(v)
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", [n for n, (_, sql) in CATALOG.items() if sql])
def test_query_equals_sql(spark, tables, name):
    got = CATALOG[name][0](spark, tables)
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet/*.parquet'")
    want = con.sql(CATALOG[name][1])
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(want.columns, want.fetchall())


def test_every_query_has_its_sql():
    assert all(sql for _, sql in CATALOG.values())


def test_whole_script_in_parts(spark, tables, monkeypatch):
    monkeypatch.setattr(export, "BUCKET", 2)
    lines = sorted(((i << 24) + k, len(x)) for i, t in enumerate(TEXTS * 3) if i % 5 == 0 for k, x in enumerate(t.split("\n")) if x.strip())[::-1]
    ids = CATALOG["tex_ids"][0](spark, tables).orderBy("sel_rank").collect()
    assert [(r["utt_id"], r["sel_rank"]) for r in ids] == [(u, k) for k, (u, _) in enumerate(lines)] and len(lines) > 8
    grid = CATALOG["textgrid_intervals"][0](spark, tables).where("tier like '%graph%'").orderBy("idx").collect()
    ends = [sum(n for _, n in lines[: k + 1]) / 13.7 for k in range(len(lines))]
    assert [r["max_t"] for r in grid] == pytest.approx(ends, abs=1e-5)


def test_contract():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_the_other_operators(tmp_path):
    """The library without its folder llm, corpus_pipeline.py there or not, still answers the driver."""
    root = Path(__spark_entry__.__file__).parent
    shutil.copytree(root / "lectern", tmp_path / "lectern", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "__spark_entry__.py").write_text((root / "__spark_entry__.py").read_text())
    (tmp_path / "corpus_pipeline.py").write_text("from lectern.llm.common import table\n")
    script = "import __spark_entry__ as e; assert set(e.queries()) == set(__import__('lectern.plans.queries', fromlist=['x']).QUERIES) and e.oracle_sql(); print('fine')"
    for there in (True, False):
        if not there:
            (tmp_path / "corpus_pipeline.py").unlink()
        assert subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""}).stdout.strip() == "fine"
