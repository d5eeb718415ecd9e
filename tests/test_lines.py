"""Text files by ranges, against reading them whole."""

import codecs
import random

import pytest

from lectern.operators import export
from lectern.sources import lines, one_file
from lectern.sources.text_files import ingest


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at : at + n]


def whole(text):
    return text.replace("\r\n", "\n").replace("\r", "\n").split("\n")


TEXTS = ["", "a", "\n", "\r", "\r\n", "a\nb\r\nc\rd", "a\n", "\n\n\r\r\n\n", "ab\r\n\r\n\r", "été\r\n日本\n😀😀\r\nz", "਍ഊ\nਊ\r഍"]


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "utf-16", "utf-16-le", "utf-16-be", "utf-32", "utf-32-be"])
@pytest.mark.parametrize("read", [4, 12, 1 << 20])
def test_every_cut_gives_every_line_once(monkeypatch, encoding, read):
    monkeypatch.setattr(lines, "READ", read)
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice(["\r", "\n", "a", "é", "😀"]) for _ in range(20)) for _ in range(30)]
    for text in texts:
        data = text.encode(encoding)
        how = lines.coding(encoding, data[:4])
        w = how.width
        for parts in range(1, len(data) // w + 2):
            cuts = [len(data) * k // parts // w * w for k in range(parts)] + [len(data) + 1]
            got = [(n, lines.texts_of(x, ended, how)) for a, b in zip(cuts, cuts[1:], strict=False) for n, x, ended in lines.blocks(Bytes(data), len(data), a, b, how)]
            assert [x for _, xs in got for x in xs] == whole(text), (text, parts)
            assert all(n == len(xs) for n, xs in got)


def test_encodings():
    assert lines.coding("UTF-16", b"\xfe\xffab") == lines.Coding("utf-16-be", 2, ">u2", 2)
    assert lines.coding("utf-16", b"a\0b\0").name == "utf-16-le"
    assert [lines.coding(e).width for e in ("latin-1", "cp1252", "shift_jis", "gb18030", "utf-7", "iso2022_jp", "cp037", "hz")] == [1, 1, 1, 1, 0, 0, 0, 0]


@pytest.mark.parametrize("encoding", ["utf-8", "utf-16", "cp1252", "utf-7", "cp037"])
def test_files_are_read_by_ranges(spark, tmp_path, encoding):
    end = {"cp037": "\n"}.get(encoding, "\r\n")
    text = {f"d{k % 3}/f{k}": end.join(f"line {i} of {k} é" for i in range(k * 40 + 1)) + end * (k % 2) for k in range(6)} | {"empty": ""}
    for stem, t in text.items():
        (tmp_path / stem).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / f"{stem}.txt").write_bytes(t.encode(encoding))
    (tmp_path / "no.text").write_text("other")
    got = lines.read_lines(spark, str(tmp_path), encoding, split=100)
    if lines.coding(encoding).width:
        assert got.rdd.getNumPartitions() > 10
    rows = {(r["stem"], r["line_nr"]): r["line"] for r in got.collect()}
    assert rows == {(stem, i): x for stem, t in text.items() for i, x in enumerate(whole(t))}
    counts = {r["stem"]: r["n_lines"] for r in lines.line_counts(spark, str(tmp_path), encoding, split=100).collect()}
    assert counts == {stem: len(whole(t)) for stem, t in text.items()}
    few = {r["stem"] for r in lines.read_lines(spark, str(tmp_path), encoding, limit=2).collect()}
    assert few == set(sorted(text)[:2])
    assert lines.read_lines(spark, f"{tmp_path}/nothing").count() == 0


def test_broken_bytes_are_an_error(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"fine\n\xff\xfe\n")
    with pytest.raises(Exception, match="codec can't decode"):
        lines.read_lines(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("encoding", ["utf-8", "utf-16"])
def test_pairs_of_large_files(spark, tmp_path, encoding):
    for side, word in (("reading", "w"), ("repr", "R")):
        (tmp_path / side).mkdir()
        text = "\r\n".join(f"{word} {i}" if i % 9 else "" for i in range(300))
        for stem, more in (("a", ""), ("b", "\n" if side == "repr" else "")):
            with codecs.open(str(tmp_path / side / f"{stem}.txt"), "w", encoding) as f:
                f.write(text + more)
    c = ingest(spark, f"{tmp_path}/reading", f"{tmp_path}/repr", encoding=encoding, split=128)
    rows = c.utterances.orderBy("utt_id").collect()
    assert [(r["line_nr"], r["reading"], r["repr"]) for r in rows] == [(i, f"w {i}", f"R {i}") for i in range(300) if i % 9]
    assert [r["utt_id"] for r in rows] == list(range(len(rows))) and [p["path"].endswith("/reading/a.txt") for p in c.paths.collect()] == [True]


def naive_scripts(rows, grid):
    """The files as one process writes them."""
    import csv
    import io

    out, table = {}, io.StringIO()
    out[".txt"] = "\n".join(f"{r['Nr']}: {r['Utterance']}" for r in rows)
    out["_consecutive.txt"] = " ".join(r["Utterance"] for r in rows)
    out["_paths.txt"] = "\n".join(r["Path"] or "" for r in rows)
    hint = lambda u: f"{u[-1]} " if u[-1:] in ("!", "?") else ""
    out[".tex"] = "\\begin{enumerate}[label={\\protect\\threedigits{\\theenumi}:}]\n" + "".join(f"  \\item {hint(r['Utterance'])}{r['Utterance']} % {r['Id']}\n" for r in rows) + "\\end{enumerate}"
    w = csv.writer(table, delimiter="\t", lineterminator="\n")
    w.writerow(["Id", "Nr", "Utterance", "Representation", "Path"])
    w.writerows([r["Id"], r["Nr"], r["Utterance"], r["Representation"], r["Path"]] for r in rows)
    out[".csv"] = table.getvalue()
    end = max((r["max_t"] for r in grid), default=0.0)
    lines = ['File type = "ooTextFile"', 'Object class = "TextGrid"', "", "xmin = 0", f"xmax = {end}", "tiers? <exists>", "size = 2", "item []:"]
    for i, name in enumerate(("sentences (graphemes)", "sentences (phonemes)"), 1):
        mine = [r for r in grid if r["tier"] == name]
        lines += [f"    item [{i}]:", '        class = "IntervalTier"', f'        name = "{name}"', "        xmin = 0", f"        xmax = {end}", f"        intervals: size = {len(mine)}"]
        for j, r in enumerate(mine, 1):
            lines += [f"        intervals [{j}]:", f"            xmin = {r['min_t']}", f"            xmax = {r['max_t']}", '            text = "' + r["mark"].replace('"', '""') + '"']
    return out, "".join(x + "\n" for x in lines)


@pytest.mark.parametrize("n", [0, 1, 700])
def test_files_equal_those_of_one_process(spark, tmp_path, n):
    texts = ["Hi!", 'a "quoted" one?', "tab\there", "two\nlines", "é 😀", "cr\rx", " ", '"'] * 100
    rows = [(i, i * 3, f"{i + 1:03}", texts[i % 800], texts[(i + 3) % 800], None if i % 5 == 0 else f"p/{i}") for i in range(n)]
    frame = spark.createDataFrame(rows, "place long, Id long, Nr string, Utterance string, Representation string, Path string").repartition(7)
    grid = [(t, i, i / 7, (i + 1) / 7 if i else 1e-5, x) for i, (_, _, _, x, _, _) in enumerate(rows) for t in ("sentences (graphemes)", "sentences (phonemes)")]
    grid = spark.createDataFrame(grid, "tier string, idx long, min_t double, max_t double, mark string")
    export.write_scripts(frame, str(tmp_path), "s")
    export.write_textgrid(grid.repartition(5), str(tmp_path / "s.TextGrid"))
    files, text = naive_scripts(frame.orderBy("place").collect(), grid.orderBy("tier", "idx").collect())
    for end, want in files.items():
        assert (tmp_path / f"s{end}").read_bytes() == want.encode(), end
    assert (tmp_path / "s.TextGrid").read_bytes() == text.encode()
    assert len(list(tmp_path.iterdir())) == 6  # no parts are left


def test_a_file_is_replaced_at_once_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "x.txt")
    rows = spark.createDataFrame([(i, f"{i}") for i in range(20)], "place long, line string")
    one_file.write_file(rows, path, between=",")
    with pytest.raises(Exception, match="overlap|order"):
        one_file.write_file(rows.repartition(3, "line"), path, ordered=True)
    assert (tmp_path / "x.txt").read_text() == ",".join(map(str, range(20))) and len(list(tmp_path.iterdir())) == 1
    one_file.write_file(rows.where("place < 2"), path, head="<", foot=">", after=";")
    assert (tmp_path / "x.txt").read_text() == "<0;1;>"
