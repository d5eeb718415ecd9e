"""Source divergence, ZIP-packaged WARC and the Merkle manifest, against SQL and brute force, on odd rows."""

import hashlib
import io
import json
import struct
import zipfile
import zlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectern.llm import divergence, merkle, warc_zip
from lectern.llm.common import with_facts
from lectern.llm.queries import QUERIES, SQL

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, tree string, value long"


def plain(rows):
    return sorted(tuple("null" if v is None else str(v) for v in r) for r in rows)


def documents():
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["É", "été", "naïve", "ß", "Ωmega", "日本"]
    rows = []
    for i in range(400):
        k = int(rng.integers(0, 30))
        text = " ".join(np.array(words)[np.minimum(rng.geometric(0.06, k), len(words)) - 1].tolist()) + ("!X-Y 1a2b" if i % 3 else "")
        rows.append((i, text, ["en", "de", None, ""][i % 4 if i % 3 else 0], [f"s{i % 5}", None, ""][0 if i % 7 else i % 3], len(text), 1, "t", i))
    rows += [rows[5], rows[5], (None, None, None, None, None, 1, "t", 0), (None, None, "xx", "lonely", None, 1, "t", 0), (3, "", "en", "empty", 0, 1, "t", 0), (9, "Ab " * 60_000, "en", "long", 180_000, 1, "t", 0)]
    return rows


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(documents(), DOCS).repartition(3).write.parquet(f"{at}/documents.parquet")
    html = ["<p>" + "x" * 200 + "</p>", "<p>short</p>", None, "é" * 60, "é" * 40, "<b>" + "z" * 500 + "</b>"]
    pages = [(i * 7 % 101, f"https://h{i % 3}.org/a b?q={i}\r\nX: é" if i % 5 else None, html[i % 6], 1, "salt") for i in range(90)]
    pages += [pages[0], pages[0], (None, None, html[0], 1, "salt"), (None, "u", html[5], 1, "salt"), (1000, "u", "y" * 3_000_000, 1, "salt"), (1001, "v", "y" * 3_000_000, 1, "salt")]
    spark.createDataFrame(pages, "page_id long, url string, html string, place int, salt string").repartition(3).write.parquet(f"{at}/pages.parquet")
    return str(at)


def sql_rows(name, tables):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet/*.parquet'")
    want = con.sql(SQL[name])
    order = sorted(want.columns)
    return order, plain(con.sql(f"SELECT {', '.join(order)} FROM ({SQL[name]})").fetchall())


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_warc_zip", "op13_merkle_manifest"])
def test_query_equals_sql(spark, tables, name):
    order, want = sql_rows(name, tables)
    got = QUERIES[name](spark, tables)
    assert sorted(got.columns) == order
    assert plain(got.select(*order).collect()) == want and len(want) > 50


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_warc_zip", "op13_merkle_manifest"])
def test_empty_table(spark, tables, tmp_path, name):
    for t in ("documents", "pages"):
        spark.read.parquet(f"{tables}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []


# divergence


def naive_divergence(rows, least):
    """Every pair of sources, every term."""
    words = lambda t: divergence._TERM.findall((t or "").encode().lower())
    docs = [(lang or "", source or "", words(text)) for _, text, lang, source, *_ in rows]
    out = {}
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        kept = {t for t in {t for d in mine for t in d[2]} if sum(t in d[2] for d in mine) >= least}
        counts = {s: {t: sum(d[2].count(t) for d in mine if d[1] == s) for t in kept} for s in {d[1] for d in mine}}
        share = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        shares = {s: share(c) for s, c in counts.items()}
        out |= {(lang, a, b): sum(abs(shares[a][t] - shares[b][t]) for t in kept) for a in counts for b in counts if a != b}
    return out


@pytest.mark.parametrize("few", [0, 1000])
def test_pairs_by_brute_force(spark, monkeypatch, few):
    """Also with facts of more keys than may be broadcast."""
    monkeypatch.setattr(divergence, "with_facts", lambda *a: with_facts(*a, few=few))
    rows = documents()[:-1]
    got = divergence.divergences(spark.createDataFrame(rows, DOCS), least=5).where("part = 'pair'").collect()
    assert {(r["lang"], r["source"], r["item"]): r["value"] for r in got} == naive_divergence(rows, 5)


def test_tiles_blocks_and_zero_cells(spark, monkeypatch):
    for name, value in (("CELLS", 7), ("TILE", 2)):
        monkeypatch.setattr(divergence, name, value)
    rows = documents()[:-1]
    frame = spark.createDataFrame(rows, DOCS)
    cells = divergence.kept_cells(divergence.term_counts(frame), 5)
    facts = divergence.group_facts(frame, cells)
    assert facts.agg(F.max("blocks")).first()[0] > 5 and facts.agg(F.max("sources")).first()[0] > 4
    known = with_facts(cells, facts.select("lang", "source", "number_", "size", "lang_size", "v", "sources", "blocks"), ["lang", "source"], "term")
    tally = divergence.pair_histograms(known, facts).collect()
    kept = {r["number_"]: r["v"] for r in facts.collect()}
    whole = {}
    for r in tally:
        assert r["m"] > 0 or (r["x"], r["y"]) == (0, 0)
        whole[r["a"], r["b"]] = whole.get((r["a"], r["b"]), 0) + r["m"]
    assert all(m == kept[a] for (a, _), m in whole.items())
    got = divergence.divergences(frame, least=5).where("part = 'pair'").collect()
    assert {(r["lang"], r["source"], r["item"]): r["value"] for r in got} == naive_divergence(rows, 5)


def test_pieces_never_cut_a_term():
    text = b"abc de\xc3\xa9f, g " * 500 + b"x" * 300
    for size in (1, 7, 64):
        parts = list(divergence.pieces(text, size))
        assert [t for p in parts for t in divergence._TERM.findall(p)] == divergence._TERM.findall(text)
        assert all(len(p) <= size + 301 for p in parts)


def test_shares_beyond_a_long(spark):
    n = 40_000_000_000
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(3 * n), F.lit(7)).alias("p")).first()
    assert row["p"] == 1 + 1_000_000_000 * (n + 5) // (3 * n + 35)


# WARC in ZIP


class Bytes:
    """A file that counts what is read of it."""

    def __init__(self, data):
        self.data, self.read = data, 0

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        self.read += n
        return self.data[at : at + n]


def row(i, payload=b"<p>x</p>", **more):
    return {"page_id": i, "url": f"https://e.org/{i}", "payload": payload, "payload_bytes": len(payload or b""), "payload_digest": hashlib.sha256(payload or b"").hexdigest(), "record_type": "response", "refers_to": None} | more


def test_records_round_trip():
    for r in (row(5), row(None, b""), row(7, b"\r\n\r\nWARC/1.1\r\n" * 3), row(8, url=None), row(9, url="http://x/ä\r\nb %41"), row(-3)):
        assert warc_zip.parsed(warc_zip.record(r)) == r
    again = row(6, record_type="revisit", refers_to=5)
    assert warc_zip.parsed(warc_zip.record(again)) == again | {"payload": None}
    assert warc_zip.parsed(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n\r\n\r\n") is None


def test_directories_of_other_writers():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for i in range(66_000):  # more members than the old directory can count
            z.writestr(f"m{i}", b"")
        z.writestr("archive/ä.warc", b"data", zipfile.ZIP_STORED)
        z.writestr("archive/small", b"data" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 is no end"
    data = Bytes(out.getvalue())
    members = warc_zip.directory(data)
    assert len(members) == 66_002
    at = warc_zip.start_of(data, members["archive/ä.warc"])
    assert data.read_at(4, at) == b"data"
    with pytest.raises(ValueError, match="compressed"):
        warc_zip.start_of(data, members["archive/small"])
    with pytest.raises(ValueError, match="no ZIP"):
        warc_zip.directory(Bytes(b"x" * 100))


def test_zip64_sizes_and_offsets():
    """A central directory whose sizes and offset are beyond 32 bits, before a hole of 5 GB that is never read."""
    hole, name = 5 << 30, b"archive/big.warc"
    extra = struct.pack("<HHQQQ", 1, 24, hole + 1, hole, 7)
    entry = b"PK\x01\x02" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), hole)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, hole + len(entry), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    tail = entry + end64 + locator + end

    class Far(Bytes):
        def size(self):
            return hole + len(tail)

        def read_at(self, n, at):
            if at >= hole:
                return tail[at - hole : at - hole + n]
            return b"\0" * (hole - at) + tail[: n - (hole - at)] if hole - at < 70_000 else pytest.fail("read far from the end")

    member = warc_zip.directory(Far(b""))["archive/big.warc"]
    assert (member.size, member.header) == (hole + 1, 7)


def package(rows, folder, index=True):
    p = warc_zip._Package(str(folder))
    for r in rows:
        p.add(r)
    if not index:
        p.index = []
    return p.close()


def test_every_line_of_an_index_is_in_one_range(monkeypatch):
    lines = [b"x" * k for k in (1, 9, 0, 30, 2, 2, 70)]
    for end in (b"", b"\n"):
        data = b"\n".join(lines) + end
        for read in (3, 1000):
            monkeypatch.setattr(warc_zip, "READ", read)
            for parts in range(1, len(data) + 2):
                cuts = [len(data) * k // parts for k in range(parts + 1)]
                got = [x for a, b in zip(cuts, cuts[1:], strict=False) for x in warc_zip.index_lines(Bytes(data), 0, len(data), a, b)]
                assert got == [x for x in lines if x]


def test_ranges_are_read_and_nothing_else(tmp_path):
    rows = [row(i, bytes(np.random.default_rng(i).integers(0, 256, 50_000, dtype=np.uint8))) for i in range(40)]
    made = package(rows, tmp_path)
    data = Bytes((tmp_path / made["name"]).read_bytes())
    assert [warc_zip.parsed(x) for x in warc_zip.records(data)] == rows
    data.read = 0
    part = [warc_zip.parsed(x)["page_id"] for x in warc_zip.records(data, 3, 10)]
    assert part and len(part) < 8 and data.read < 0.3 * len(data.data)
    assert sorted(warc_zip.parsed(x)["page_id"] for k in range(10) for x in warc_zip.records(data, k, 10)) == list(range(40))
    with zipfile.ZipFile(tmp_path / made["name"]) as z:  # others can read it
        assert z.testzip() is None and zlib.decompress(z.read("archive/data.warc.gz"), 31) == warc_zip.record(rows[0])


@pytest.mark.parametrize("zipped", [True, False])
def test_packages_without_an_index_are_scanned(tmp_path, monkeypatch, zipped):
    monkeypatch.setattr(warc_zip, "READ", 37)
    rows = [row(i, b"<p>%d</p>\r\n\r\n" % i * (i * 9)) for i in range(20)]
    data = io.BytesIO()
    pack = (lambda x: __import__("gzip").compress(x)) if zipped else (lambda x: x)
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("archive/a.warc" + ".gz" * zipped, b"".join(pack(warc_zip.record(r)) for r in rows))
        z.writestr("datapackage.json", json.dumps({}))
    assert [warc_zip.parsed(x) for x in warc_zip.records(Bytes(data.getvalue()))] == rows


def test_only_what_was_committed_is_read(spark, tmp_path, monkeypatch):
    frame = spark.createDataFrame([tuple(row(i).values()) for i in range(50)], warc_zip.COLUMNS)
    spark.dataSource.register(warc_zip.WarcZip)
    frame.write.format("warczip").mode("append").save(str(tmp_path))
    package([row(999)], tmp_path)  # an attempt that no manifest names
    read = warc_zip.read_packages(spark, str(tmp_path))
    assert sorted(r["page_id"] for r in read.collect()) == list(range(50)) and read.where("payload IS NULL").isEmpty()
    frame.limit(3).write.format("warczip").mode("append").save(str(tmp_path))
    assert warc_zip.read_packages(spark, str(tmp_path)).count() == 53
    frame.limit(2).write.format("warczip").mode("overwrite").save(str(tmp_path))
    assert warc_zip.read_packages(spark, str(tmp_path)).count() == 2


def test_a_failed_task_leaves_no_package(tmp_path):
    bad = pa.RecordBatch.from_pylist([row(1), row(2) | {"payload_digest": None}], warc_zip._ARROW)
    writer = warc_zip._Writer(str(tmp_path), False)

    def batches():
        yield bad
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        writer.write(batches())
    assert not list(tmp_path.glob("*.wacz"))


# Merkle


def naive_levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([merkle.digest("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def test_three_passes_and_many_trees(spark):
    """A tree of more than 8 ** 6 leaves and 600 small trees: every proof folds to the root, levels are the naive ones."""
    big = 270_000
    rows = spark.range(big + 1500).select("id", F.when(F.col("id") < big, F.lit("b")).otherwise(F.concat(F.lit("t"), F.col("id") % 600)).alias("tree"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    made = merkle.manifest(rows, "tree", "id", "leaf", ["id"])
    assert made.trees.passes() == [0, 3, 6] and made.forest.passes() == [0, 3]
    leaf = lambda i: merkle.digest(str(i))
    names = ["b", *sorted({f"t{i % 600}" for i in range(big, big + 1500)})]
    trees = {"b": naive_levels([leaf(i) for i in range(big)])} | {n: naive_levels([leaf(i) for i in range(big, big + 1500) if i % 600 == int(n[1:])]) for n in names[1:]}
    forest = naive_levels([trees[n][-1][0] for n in names])
    assert made.root == forest[-1][0]
    tops = made.trees.nodes().groupBy("level").count().orderBy("level").collect()
    assert [r["count"] for r in tops] == [sum(len(t[k]) for t in trees.values() if len(t) > k) for k in range(1, len(trees["b"]))]
    proofs = made.proofs().where("pos % 9973 = 5 OR tree > 590").collect()
    assert len(proofs) > 30
    for r in proofs:
        levels, want, at = [*trees[names[r["tree"]]]], [], r["pos"]
        start = levels[0][at]
        for chain, place in ((levels, at), (forest, r["tree"])):
            for nodes in chain[:-1]:
                run = place // 8 * 8
                want.append(("".join(nodes[run:place]), "".join(nodes[place + 1 : run + 8])))
                place //= 8
        assert list(zip(r["left"], r["right"], strict=True)) == want and r["subroot"] == levels[-1][0]
        assert merkle.fold(start, want) == made.root


def test_one_changed_letter_shows(spark):
    rows = [(i, f"text {i}", "en") for i in range(30)]
    frame = spark.createDataFrame(rows, "id long, text string, lang string")
    leaf = merkle.leaf_hash(F.col("id"), F.col("lang"), F.col("text"))
    other = merkle.leaf_hash(F.col("id"), F.col("lang"), F.concat("text", F.lit("!")))
    made = merkle.manifest(frame.select("id", "lang", leaf.alias("leaf"), F.when(F.col("id") == 17, other).alias("changed")), "lang", "id", "leaf", ["id", "changed"])
    assert [r["id"] for r in made.checked("id", "changed").where(F.col("folded_root") != made.root).collect()] == [17]
    again = merkle.manifest(frame.repartition(5).select("id", "lang", leaf.alias("leaf")), "lang", "id", "leaf")
    assert again.root == made.root


def test_neighbouring_fields_are_told_apart(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "c"), ("", "c"), ("-", "c")], "x string, y string")
    assert rows.select(merkle.leaf_hash(F.col("x"), F.col("y")).alias("h")).distinct().count() == 5


def test_merge_scan_of_a_block():
    levels = naive_levels([merkle.digest(str(i)) for i in range(77)])
    assert merkle.levels_above(levels[0], 77) == levels[1:]
    for at in (0, 7, 8, 63, 64, 76):
        assert merkle.fold(levels[0][at], merkle.siblings(levels[:-1], at)) == levels[-1][0]
    assert pd.Series(levels[0]).is_unique
