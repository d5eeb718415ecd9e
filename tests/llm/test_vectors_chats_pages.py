"""Vector, chat and page operators against brute force, and on odd rows."""

import hashlib
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import chat, embed_dedup, html_text, vptree
from lectern.llm.html_text import main_text, op9_main_text

VECTORS = "vec_id long, embedding array<float>, label int"


def vector_rows(n, seed=1, dim=16):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = centers[i % 6] + rng.normal(size=dim) * (0.04 if i % 4 else 1.0)
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 6 % 3))
    rows += [(n, rows[1][1], rows[1][2]), (n + 1, [2 * x for x in rows[1][1]], rows[1][2])]
    return rows


ODD = [(9001, None, 1), (9002, [0.0] * 16, 1), (9003, [float("nan")] + [1.0] * 15, 1), (9004, [None] + [1.0] * 15, 1), (9005, [1.0] * 16, None), (9006, [math.inf] + [1.0] * 15, 1), (9007, [1.0, 2.0], 1), (9008, [], 1), (None, [1.0] * 16, 1)]


def double(rows):
    return {i: np.array(v, dtype=np.float64) for i, v, _ in rows}


def test_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 150)
    monkeypatch.setattr(vptree, "BLOCK_ROWS", 10)
    rows = vector_rows(600)
    frame = spark.createDataFrame([*rows, *ODD, rows[0], rows[1]], VECTORS).withColumns({"rank": F.lit(1), "shard": F.lit("mine")})
    got = vptree.nearest(frame, lambda i: i % 20 == 0).orderBy("query_id", "rank").collect()
    vectors = {i: v for i, v in double(rows).items()} | {9005: np.ones(16), 9007: np.array([1.0, 2.0])}
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    asked = [i for i in vectors if i % 20 == 0]
    assert sorted(by) == sorted(asked)
    for q in asked:
        scores = sorted((-float((vectors[q] * v).sum()), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))[:20]
        assert [(k, i) for k, i, _ in by[q]] == [(k + 1, i) for k, (_, i) in enumerate(scores)]
        assert np.allclose([s for *_, s in by[q]], [-s for s, _ in scores], rtol=1e-12)


@pytest.mark.parametrize("kind", ["ties", "one long vector"])
def test_search_is_exact_with(kind):
    rng = np.random.default_rng(4)
    x = np.unique(rng.choice([-1.0, 1.0], size=(1500, 12)), axis=0) if kind == "ties" else rng.normal(size=(1500, 12))
    if kind != "ties":
        x /= np.linalg.norm(x, axis=1)[:, None]
        x[7] *= 1e8
    x = x[rng.permutation(len(x))]
    asked = range(0, len(x), 20)
    tree = vptree.VPTree(vptree._lifted(x, float((x * x).sum(1).max())))
    known = [np.sort(np.cumsum(np.delete(x, i, 0) * x[i], axis=1)[:, -1])[-20] if i % 40 else float("nan") for i in asked]  # half of the queries know their bound
    queries = vptree.pd.DataFrame({"query_id": list(asked), "vector": [x[i].astype("<f8").tobytes() for i in asked], "floor": known})
    got = vptree.tree_search(tree, [[i] for i in range(len(x))], queries, 20, 1.0)
    for q, part in got.groupby("query_id"):
        scores = np.cumsum(x * x[q], axis=1)[:, -1]
        assert part["vec_id"].tolist() == sorted((i for i in range(len(x)) if i != q), key=lambda i: (-scores[i], i))[:20]


def test_shards_are_places_that_queries_leave_out():
    rng = np.random.default_rng(3)
    points = np.repeat(rng.normal(size=(16, 8)), 100, axis=0) + rng.normal(size=(1600, 8)) * 0.02
    lifted = vptree._lifted(points, float((points * points).sum(1).max()))
    places = vptree.Places.of(lifted[::3], 16)
    shard = places.shard_of(lifted)
    assert len(places.paths) == 16 and np.bincount(shard, minlength=16).max() < 400
    ranges = {s: ([places.distances(lifted[shard == s], n).min() for n in places.paths[s]], [places.distances(lifted[shard == s], n).max() for n in places.paths[s]]) for s in range(16) if (shard == s).any()}
    queries = np.column_stack([points[::50], np.zeros(32)])
    d = np.sqrt(((queries[:, None] - lifted[None]) ** 2).sum(2))
    radius = np.sort(d, axis=1)[:, 10] + 1e-9
    seen = places.within(queries, radius, ranges)
    for q, shards in enumerate(seen):
        assert set(shard[d[q] <= radius[q]]) <= set(shards.tolist())
    assert np.mean([len(s) for s in seen]) < 12


def test_search_with_a_hot_vector_and_clusters(spark, monkeypatch):
    """A third of the rows are one vector; shards are small; all as by brute force."""
    monkeypatch.setattr(vptree, "SHARD_ROWS", 60)
    monkeypatch.setattr(vptree, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(8)
    x = np.repeat(rng.normal(size=(10, 6)), 60, axis=0) + rng.normal(size=(600, 6)) * 0.05
    x[rng.permutation(600)[:200]] = x[0]
    frame = spark.createDataFrame([(i, [float(a) for a in v], 1) for i, v in enumerate(x)], VECTORS)
    got = {}
    for r in vptree.nearest(frame, lambda i: i % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert len(got) == 30
    for q, ids in got.items():
        scores = np.cumsum(x * x[q], axis=1)[:, -1]
        assert ids == sorted((i for i in range(600) if i != q), key=lambda i: (-scores[i], i))[:20]


def test_relaxed_search_prunes_more():
    rng = np.random.default_rng(0)
    points = np.repeat(rng.normal(size=(40, 8)), 50, axis=0) + rng.normal(size=(2000, 8)) * 0.1
    lifted = np.column_stack([points, np.sqrt((points**2).sum(1).max() - (points**2).sum(1))])
    queries = np.column_stack([points[::40], np.zeros(50)])
    exact_at, _, exact = vptree.VPTree(lifted, 32).search(queries, 5, 1.0)
    rough_at, _, rough = vptree.VPTree(lifted, 32).search(queries, 5, 0.7)
    assert rough < exact < 50 * 2000
    brute = np.argsort(-(queries[:, :8] @ points.T), axis=1, kind="stable")[:, :5]
    assert all(set(a) == set(b) for a, b in zip(exact_at, brute, strict=True))
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(rough_at, brute, strict=True)]) > 0.5


@pytest.mark.parametrize("dim", [8, 16, 64])
def test_links_of_pairs_at_the_threshold(spark, monkeypatch, dim):
    """Pairs planted just above it, with the reach and index that the query has: all are counted for both of their ends."""
    monkeypatch.setattr(embed_dedup, "CELL", 4)
    monkeypatch.setattr(embed_dedup, "BLOCK", 32)
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(400, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    both = np.concatenate([x, 0.981 * x + math.sqrt(1 - 0.981**2) * side])
    got = {r["vec_id"]: r["n_links"] for r in embed_dedup.linked(spark.createDataFrame([(i, [float(a) for a in v], 1) for i, v in enumerate(both)], VECTORS)).collect()}
    unit = both / np.linalg.norm(both, axis=1)[:, None]
    want = ((unit @ unit.T >= 0.98).sum(1) - 1).tolist()
    assert [got[i] for i in range(800)] == want and min(want) >= 1


def test_search_odd_tables(spark):
    frame = spark.createDataFrame(ODD, VECTORS)
    assert vptree.nearest(frame, lambda i: i % 20 == 0).count() == 0
    assert vptree.nearest(frame.limit(0), lambda i: i % 20 == 0).count() == 0


def test_links_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CELL", 8)
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)
    rows = vector_rows(500)
    got = embed_dedup.linked(spark.createDataFrame([*rows, *ODD], VECTORS).withColumn("cell", F.lit(1))).toPandas().set_index("vec_id")
    x = np.stack([v / np.linalg.norm(v) for v in double(rows).values()])
    label = np.array([r[2] for r in rows])
    linked = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    component = np.arange(len(rows))
    while True:
        low = np.minimum(component, np.where(linked, component, len(rows)).min(1))
        if (low == component).all():
            break
        component = low
    assert got.loc[range(len(rows)), "n_links"].tolist() == linked.sum(1).tolist() and linked.any()
    assert got.loc[range(len(rows)), "component_id"].tolist() == component.tolist()
    odd = got.loc[[i for i, *_ in ODD if i]]
    assert (odd.n_links == 0).all() and (odd.component_id == odd.index).all() and got.kept.sum() == (component == np.arange(len(rows))).sum() + len(ODD)


def test_links_of_few_effective_dimensions(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CELL", 4)
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(1500, 4)) @ rng.normal(size=(4, 32))).astype(np.float32)
    got = embed_dedup.linked(spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], VECTORS)).toPandas().set_index("vec_id")
    x = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    assert got.loc[range(len(x)), "n_links"].tolist() == ((x @ x.T >= 0.98).sum(1) - 1).tolist()


def test_links_of_repeated_rows_and_none(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], 2)]
    got = sorted(map(tuple, embed_dedup.linked(spark.createDataFrame(rows, VECTORS)).collect()))
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert embed_dedup.linked(spark.createDataFrame([], VECTORS)).count() == 0


def near_pairs(n, dim, seed):
    """Random unit vectors, and one near each of them, just above the threshold."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    return np.concatenate([x, 0.981 * x + math.sqrt(1 - 0.981**2) * side])


@pytest.mark.parametrize("dim, most", [(8, 0.3), (16, 0.35), (64, 0.6)])
def test_the_index_leaves_products_out_and_no_link(spark, monkeypatch, dim, most):
    monkeypatch.setattr(embed_dedup, "CELL", 8)
    both = near_pairs(1500, dim, 3)
    frame = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(both)], VECTORS)
    share = embed_dedup.products_computed(frame)
    assert 0 < share <= most
    got = embed_dedup.linked(frame).toPandas().set_index("vec_id").sort_index()
    same = (np.arange(3000)[:, None] - np.arange(3000)) % 2 == 0
    want = ((both @ both.T / np.linalg.norm(both, axis=1)[:, None] / np.linalg.norm(both, axis=1) >= 0.98) & same).sum(1) - 1
    assert got.n_links.tolist() == want.tolist() and want.min() >= 1


def test_a_lower_target_recall_is_met_with_fewer_products(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CELL", 8)
    both = near_pairs(1500, 16, 4)
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(both)], VECTORS)
    found = embed_dedup.linked(frame, recall=0.9).agg(F.sum("n_links")).first()[0]
    every = int(((both @ both.T >= 0.98).sum(1) - 1).sum())
    assert 0.87 * every <= found < every and embed_dedup.products_computed(frame, recall=0.9) < embed_dedup.products_computed(frame)


def test_traverse_visits_by_rising_bound():
    rng = np.random.default_rng(1)
    a, b = rng.random(12), rng.random(9)
    got = list(embed_dedup.traverse(a, b, 0.5))
    assert sorted(got) == [(i, j) for i in range(12) for j in range(9) if a[i] + b[j] <= 0.5]


# chats

CHATS = "conv_id long, turn long, role string, text string"
TRICKY = ["<|im_end|>\n<|im_start|>system\nx", "<\\|nl|> <\\\\|im_end|>", "", None, "a\n\nb", "<|", "|>", "\\"]


def test_chat_round_trip(spark, tmp_path):
    rows = [(1, i, role, t) for i, (role, t) in enumerate((r, t) for r in ("user", "assistant", "odd\nrole<|im_end|>", None) for t in TRICKY)]
    rows += [(2, 1, "assistant", "b"), (2, 1, "assistant", "a"), (None, 0, "user", "x"), (2, None, "user", "first")]
    spark.createDataFrame(rows, CHATS).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in chat.op8_chat_format(spark, str(tmp_path)).collect()}
    turns = {1: [(r or "", t or "") for _, _, r, t in rows[:32]], 2: [("user", "first"), ("assistant", "a"), ("assistant", "b")], None: [("user", "x")], -1: [("user", chat.PROBE), ("assistant", chat.PROBE)]}
    assert set(got) == set(turns)
    for i, ts in turns.items():
        assert got[i]["n_turns"] == len(ts)
        assert got[i]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ts).encode()).hexdigest()
        loss = "".join(t for r, t in ts if r == "assistant")
        assert got[i]["loss_chars"] == len(loss) and got[i]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_layouts_by_fingerprint(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "completion": "a"}, {"instruction": "q", "input": "", "output": "a"}, {"question": "q", "answer": "a"}, {"response": "a", "prompt": "q"},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(50, '{"other": 1}'), (51, "no json"), (52, None)]
    got = {r["i"]: r for r in chat.canonical_json(spark.createDataFrame(rows, "i int, json string"), ["i"], "json").collect()}
    for i in range(len(records)):
        assert [(t["role"], t["text"]) for t in got[i]["canonical"]] == [("user", "q"), ("assistant", "a")], records[i]
    assert all(got[i]["layout"] is None and got[i]["canonical"] is None for i in (50, 51, 52))
    typed = spark.createDataFrame([(1, "q", "a")], "id int, prompt string, completion string")
    assert chat.format_chats(typed, ["id"]).first()["formatted"] == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    with pytest.raises(ValueError):
        chat.format_chats(spark.createDataFrame([(1, "q")], "id int, what string"), ["id"])


def test_no_chats(spark, tmp_path):
    spark.createDataFrame([], CHATS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r["conv_id"] for r in chat.op8_chat_format(spark, str(tmp_path)).collect()] == [-1]


# pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site of all sites</h2></header><nav><ul><li><a href="/a">Home and more of it</a></li></ul></nav>
<div class="cookie-notice">We use cookies, and a long text says so, which nobody reads at all.</div>
<div id="main"><h1>Title &amp; more</h1><p>First   paragraph with <a href="x">a link</a> and <b>bold</b> text&nbsp;here.<p>Second &lt;one&gt;, longer than the first, with words.</p>
<form><label>Mail</label><input name="m"><button>Go</button></form><ul><li>item one<li>item two</ul><p>End.</div>
<div class="comments"><p>First! I have much to say about this, and I say it at length, every day.</p></div>
<aside>More to read</aside><footer>&copy; someone, somewhere, and more text in the footer than it needs</footer></body></html>"""


def test_page():
    assert main_text(PAGE) == "Title & more\nFirst paragraph with a link and bold text here.\nSecond <one>, longer than the first, with words.\nitem one\nitem two\nEnd."


def test_short_and_broken_pages():
    page = '<body><nav><a href="/">Menu</a></nav><div class="ad">An advert that is longer than the text.</div><article><h1>Hi.</h1><p><b>Hi.<br></article><footer>f' + " word" * 50
    assert main_text(page) == "Hi.\nHi."
    assert main_text("<p>a &am") == "a &am" and main_text("1 < 2 and 3 > 2") == "1 < 2 and 3 > 2"
    assert main_text("<script>x") == main_text("<!-- x") == main_text("") == main_text(None) == ""
    assert main_text("<div " * 2000 + "x") is not None
    deep = "<div>" * 3000 + "<p>inside</p>" + "</div>" * 3000
    assert main_text(deep) == "inside"


LONG = "".join(f"<p>Paragraph {i} of the body, which is long enough to be read as one.</p>" for i in range(12))
BODY = "\n".join(f"Paragraph {i} of the body, which is long enough to be read as one." for i in range(12))


@pytest.mark.parametrize("start, end", [(f"<div class='{x}'>", "</div>") for x in ("entry no-sidebar", "post has-comments", "social-share-enabled", "related-work", "promo", "post related-story", "content alert-article", "entry share-count", "story-search", "comment-free", "blog-newsletter", "alert-history", "search-results-of-study")] + [("<form action='/'><div>", "</div></form>")])
def test_names_and_forms_do_not_drop_the_body(start, end):
    menu = "<nav>" + "".join(f"<a href='/{i}'>Entry {i} of a long menu</a> " for i in range(60)) + "</nav>"
    for before in ("", menu):
        got = main_text(f"<body>{before}<h1>Title</h1>{start}{LONG}{end}<div class='comments-area'><p>First! And more.</p></div><footer>f</footer></body>")
        assert BODY in got and "First!" not in got and "menu" not in got


def test_densities_by_brute_force():
    """Each node's density from its whole subtree, counted anew; the sum of its children's."""
    page = f"<body><div id='a'><h1>T <a href='x'>link</a></h1>{LONG}<ul><li>one<li><a href='y'>two words</a></ul></div><div><p><a href='z'>only links here</a> <a href='w'>and here</a></p></div><p>short</p></body>"
    body, _ = html_text._tree(page)

    def nodes(n):
        return [n, *(x for c in n.children for x in nodes(c))]

    def counts(n):
        own = raw[id(n)]
        below = [counts(c) for c in n.children]
        return [own[k] + sum(b[k] for b in below) + (len(below) if k == 1 else 0) for k in range(4)]

    raw = {id(n): (n.chars, n.tags, n.link_chars, n.link_tags) for n in nodes(body)}
    tree = nodes(body)
    c, _, links, _ = counts(body)
    want = {}
    for n in tree:
        chars, tags, linked, link_tags = counts(n)
        linked = min(linked, chars)
        if not chars:
            want[id(n)] = 0.0
            continue
        inner = math.log(max(chars / max(linked, 1) * max(tags, 1) / max(link_tags, 1), 1.0) + 1e-9)
        outer = math.log(chars * linked / max(chars - linked, 1) + links / max(c, 1) * chars + math.e)
        want[id(n)] = chars / max(tags, 1) * inner / max(math.log(outer + 1e-9), 1.0)
    order = html_text._score(body)
    assert len(order) == len(tree) > 15
    for n in order:
        assert math.isclose(n.density, want[id(n)], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(n.summed, sum(want[id(x)] for x in n.children), rel_tol=1e-9, abs_tol=1e-9)
    text = main_text(page)
    assert BODY in text and "only links" not in text


def test_no_pages_and_a_very_long_one(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/a/pages.parquet")
    assert op9_main_text(spark, f"{tmp_path}/a").count() == 0
    spark.createDataFrame([(1, "u", f"<body><div>{LONG * 3000}</div></body>")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/b/pages.parquet")
    assert op9_main_text(spark, f"{tmp_path}/b").first()["n_chars"] == len("\n".join([BODY] * 3000))


def test_pages(spark, tmp_path):
    rows = [(1, "u", PAGE), (2, "u", None), (2, "u", ""), (None, None, "<p>x</p>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).write.parquet(f"{tmp_path}/pages.parquet")
    got = op9_main_text(spark, str(tmp_path)).toPandas()
    assert len(got) == 4 and got.n_chars.tolist() == got.text.str.len().tolist() and sorted(got.text.str[:1]) == ["", "", "T", "x"]


NAMED = ["main-nav", "primary-menu", "related-articles", "share-this", "ad-slot-1", "site-header", "page-footer", "user-comments", "responses", "userComments", "commentSection"]


@pytest.mark.parametrize("name", NAMED)
@pytest.mark.parametrize("n", [1, 2, 5, 30])
def test_named_parts_go_at_any_length(name, n):
    """Inside of the article, beside it, and where no element names the article."""
    piece = "".join(f"<div class='item'><article><h2>Reader {i}</h2><p>I think that this is number {i}, and I say why at some length.</p></article></div>" for i in range(n))
    for attribute in ("class", "id"):
        part, body = f"<div {attribute}='{name}'>{piece}</div>", "<h1>Title</h1><p>A short text of the page itself, with a few words.</p><p>Ok.</p>"
        want = "Title\nA short text of the page itself, with a few words.\nOk."
        for page in (f"<article>{body}{part}</article>", f"<article>{body}</article>{part}", f"{part}<main>{body}</main>", f"<main>{body}{part}</main>"):
            assert main_text(f"<body>{page}</body>") == want, page
        if "omment" in name or name == "responses":
            assert main_text(f"<body><div class='post'>{body}</div>{part}</body>") == want


def test_nothing_of_an_article_is_lost():
    long = "<p>" + "Words that make a long paragraph, one after the other. " * 6 + "</p>"
    sections = "".join(f"<section><h2>Section {k}</h2>{long * (9 if k == 'A' else 1)}</section>" for k in "ABC")
    text = " ".join(["Words that make a long paragraph, one after the other."] * 6)
    want = "\n".join(["Title", "Section A", *[text] * 9, "Section B", text, "Section C", text])
    assert main_text(f"<body><article><h1>Title</h1>{sections}</article><div>other</div></body>") == want
    assert main_text(f"<body><main><h1>Title</h1><article>{sections}</article></main><div>other</div></body>") == want
    assert main_text(f"<body><div class='post'><h1>Title</h1>{sections}</div></body>") == want
    mixed = f"<h1>T</h1><p>Short lead.</p><div>{long * 2}</div><ul><li>a<li>b</ul><table><tr><td>1<td>2</table><p>ok.</p>"
    want = "\n".join(["T", "Short lead.", text, text, "a", "b", "1", "2", "ok."])
    for start, end in (("<main>", "</main>"), ("<article>", "</article>"), ("<div id='story'>", "</div>")):
        assert main_text(f"<body><nav><a href='/'>Home</a></nav>{start}{mixed}{end}<footer>f</footer></body>") == want


def test_selection_by_brute_force():
    """On pages without names: the subtree of the highest sum, found anew, is inside of what is chosen, and all of what is chosen is kept."""
    rng = np.random.default_rng(8)

    def make(depth):
        tag = ["div", "section", "p", "ul", "article", "main", "h1"][int(rng.integers(0, 7))]
        inner = "".join(make(depth - 1) for _ in range(rng.integers(1, 4))) if depth and tag != "p" else ""
        return f"<{tag}>w{rng.integers(0, 10**6)} {'long text ' * int(rng.integers(0, 9))}{inner}</{tag}>"

    for _ in range(150):
        page = f"<body>{''.join(make(3) for _ in range(3))}</body>"
        body, blocks = html_text._tree(page)
        order = html_text._score(body)
        chosen = html_text._chosen(body, order)
        named = html_text._elements(body)
        below = lambda n: [n, *(x for c in n.children for x in below(c))]
        pool = below(named[0]) if len(named) == 1 else order
        best = max(sum(c.density for c in n.children) for n in pool)
        tops = [n for n in pool if sum(c.density for c in n.children) == best]
        kept = {id(x) for n in order if id(n) in chosen for x in below(n)}
        assert any(id(n) in kept for n in tops)
        assert main_text(page).split("\n") == [t for n, t in blocks if id(n) in kept]
        around = [x for x in html_text._up(tops[0]) if x.tag in ("article", "main")]
        if around and len(tops) == 1:
            assert {id(x) for x in below(around[0])} <= kept and len(chosen) == 1
