"""Shards, pages, neighbours and near copies against plain forms."""

import random
import re
import string
import time
import zlib
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import functions as F

from tabsync.llm import forest, hilbert, hyperminhash, style_tree


def test_hilbert_curve_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 3), (3, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        index = hilbert.curve_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1) == 1).all()


def test_shards(result, docs, odd, none):
    got = result("op1_hilbert_shards")
    assert sorted(got.doc_id) == sorted(docs.doc_id) and set(got.shard) == set(range(40))
    sizes = got.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1
    assert all(sorted(s) == list(range(len(s))) for _, s in got.groupby("shard")["slot"])
    by_id = docs.set_index("doc_id").text
    for r in got.itertuples():
        raw = (by_id[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    dims = {"lang": F.col("lang"), "chars": F.length("text")}
    placed = hilbert.shard(odd, dims, 3, ("doc_id",)).toPandas()
    assert sorted(placed.groupby("shard").size()) == [3, 3, 4] and hilbert.shard(none, dims, 3, ("doc_id",)).count() == 0


class PlainArticle(HTMLParser):
    """Blocks of a page's article, without elements that are noise by tag or by the one noisy class of the given pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.noise, self.out, self.stack = 0, 0, [[]], []

    def handle_starttag(self, tag, attrs):
        if tag in style_tree.VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        noise = tag in style_tree.NOISE or dict(attrs).get("class") == "ad"
        self.stack.append((tag, noise))
        self.noise += noise
        self.inside += tag == "article"
        if tag in style_tree.BLOCKS:
            self.out.append([])

    def handle_endtag(self, tag):
        if tag not in [t for t, _ in self.stack]:
            return
        while True:
            top, noise = self.stack.pop()
            self.noise -= noise
            self.inside -= top == "article"
            if top in style_tree.BLOCKS:
                self.out.append([])
            if top == tag:
                return

    def handle_data(self, data):
        if self.inside and not self.noise:
            self.out[-1].append(data)


def test_pages_query(result, spark):
    """The article of every page, by another parser; the tree finds nothing dull in these."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").toPandas().set_index("page_id")
    got = result("op2_site_style_tree")
    assert sorted(got.page_id) == sorted(pages.index)
    for r in got.itertuples():
        plain = PlainArticle()
        plain.feed(pages.html[r.page_id] or "")
        want = "\n\n".join(t for t in (" ".join("".join(b).split()) for b in plain.out) if t)
        assert (r.text, r.n_chars, r.url) == (want, len(want), pages.url[r.page_id])


def test_pages_lose_repeated_texts_only(spark):
    """Headings stay, and so does what one page alone says in an element that elsewhere holds a notice."""
    heads = ["Introduction", "Method", "Results", "References"]
    rows, want = [], {}
    for i in range(12):
        own = "<blockquote>my own quotation</blockquote><h2>Own section 3</h2>" if i == 3 else ""
        parts = "".join(f"<section><h2>{h}</h2><p>{h} of page {i}</p></section>" for h in heads)
        rows.append((i, f"http://h.example/{i}", f"<article>{parts}{own}<blockquote>all readers note this</blockquote></article>"))
        want[i] = [t for h in heads for t in (h, f"{h} of page {i}")] + (["my own quotation", "Own section 3"] if own else [])
    got = {r.page_id: r.text for r in style_tree.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: "\n\n".join(t) for i, t in want.items()}


def test_noise_inside_articles():
    for noise in ("<header>x</header>", "<div class='ad-300x250'>x</div>", "<div id=user-comments>x</div>", "<p class='advert-inline'>x</p>"):
        assert style_tree.main_text(f"<article><p>a</p>{noise}<p class='no-sidebar social-policy'>b</p></article>", set()) == "a\n\nb"


def test_pages_bear_odd_rows(spark):
    page = "<article><p>text"
    rows = [(1, "http://h/1", page, "x", 1), (1, "http://h/1", page, "x", 1), (2, None, None, None, None), (3, "not a url", "", "", 0),
            (4, "http://h/4", "<p>" + "long words " * 100_000, "y", 2), (5, "http://h/5", "a < b <!-- open", "z", 3), (6, "http://h/6", "<a href='x>y", "z", 3)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, low int").withColumn("text", F.lit(5)).withColumn("row", F.lit(6))
    got = style_tree.extract(df).collect()
    texts = sorted((r.page_id, r.text) for r in got)
    assert texts == [(1, "text"), (1, "text"), (2, ""), (3, ""), (4, ("long words " * 100_000).strip()), (5, "a < b"), (6, "<a href='x>y")] or texts[-1] == (6, "y")
    assert {(r.host, r.low, r.row) for r in got if r.page_id == 1} == {("x", 1, 6)} and style_tree.extract(df.limit(0)).count() == 0


def test_pages_take_time_in_proportion():
    for html in ("<a " * 350_000, "<a \">" * 100_000, "<a ='" * 100_000, "<!" * 200_000, "<!-- " * 100_000):
        start = time.time()
        style_tree.main_text(html, set())
        assert time.time() - start < 10
    deep = "<div class=ad>" * 20_000 + "<p>x"
    assert style_tree.main_text(deep, set()) == "x"


def test_pages(spark):
    menu, note = "<div><ul><li>one of the links</ul></div>", "<div class='x'><p>the same words on every page</div>"
    rows = [(i, f"http://h.example/{i}", f"<body>{menu}<p>own text &amp; {i}<br>more{note}<nav>n</nav></body>") for i in range(5)]
    rows += [(6, "http://h.example/6", "<nav>m</nav><article><h1>A</h1><p>b <b>c<p>the same words on every page</article><footer>f</footer>"),
             (7, None, "<p>no host"), (8, "http://h.example/8", None), (9, "http://o.example/", "")]
    got = {r.page_id: r.text for r in style_tree.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {**{i: f"own text & {i} more" for i in range(5)}, 6: "A\n\nb c\n\nthe same words on every page", 7: "no host", 8: "", 9: ""}


def test_pages_tree_inside_articles(spark):
    """What a host repeats inside its articles under a name of no list goes; own text, whole articles and copied pages stay."""
    strip, tail = "<div class='zz-strip'><p>Join our club today</p></div>", "<p class='qq'>The same last words</p>"
    rows = [(i, f"http://a.example/{i}", f"<div>menu</div><article><h1>Title {i}</h1>{strip}<p>own text {i}<p>more {i}</p>{tail}</article>") for i in range(6)]
    rows += [(10 + i, f"http://m.example/{i}", f"<main><div><p>own text {i}</p></div>{strip}</main>") for i in range(3)]
    rows += [(20 + i, f"http://f.example/{i}", f"<p>{i}</p><article><p>the same article</p></article>") for i in range(4)]
    rows += [(30 + i, f"http://c.example/{i}", "<article><h1>A</h1><p>one page many times</p></article>") for i in range(9)]
    rows += [(39, "http://c.example/9", "<article><h1>B</h1><p>another page</p><ul><li>x</ul></article>")]
    got = {r.page_id: r.text for r in style_tree.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {**{i: f"Title {i}\n\nown text {i}\n\nmore {i}" for i in range(6)}, **{10 + i: f"own text {i}" for i in range(3)},
                   **{20 + i: "the same article" for i in range(4)}, **{30 + i: "A\n\none page many times" for i in range(9)}, 39: "B\n\nanother page\n\nx"}


def test_pages_names_around_articles():
    """A name alone takes neither an article nor a part of it that is only similar in name; what names itself noise still goes."""
    article = "<article><h1>Title</h1><p>own text</p><section class='social-policy'><p>on social policy</p></section><div class='share-buttons'>share</div></article>"
    want = "Title\n\nown text\n\non social policy"
    for wrapper in ("class='content has-sidebar'", "class='no-sidebar'", "id='page' class='site with-nav'", "class='layout-notice'", "class='widget'", "id=social"):
        page = f"<body><div class='cookie-bar'>cookies</div><div {wrapper}><div class='ad'>buy</div>{article}<section id='comments'><article><p>a comment</p></article></section></div></body>"
        assert style_tree.main_text(page, set()) == want, wrapper
    beside = "<div id='comments'><article><p>" + "a long comment " * 9 + "</p></article></div>"
    assert style_tree.main_text(f"<div class='content'>{article}</div>{beside}", set()) == want
    assert style_tree.main_text(f"<article><p>short</p><div class='comments'><p>{'long ' * 99}</p></div></article>", set()) == "short"
    assert style_tree.main_text("<div class='social'><p>one</p><p>two</p></div><div class='ad'>buy</div>", set()) == "one\n\ntwo"
    assert style_tree.main_text("<div class='ad'>buy</div>", set()) == ""


def test_neighbours(spark, result):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").toPandas()
    x, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    got, found = result("op3_projection_forest"), 0
    for q, group in got.groupby("query_id"):
        own = x[ids == q][0]
        scores = np.where(ids == q, -np.inf, x @ own)
        best = {int(i) for i in ids[np.lexsort((ids, -scores))[:20]]}
        group = group.sort_values("rank")
        assert list(group["rank"]) == list(range(1, 21))
        assert np.allclose(group.score, [x[ids == v][0] @ own for v in group.vec_id], atol=1e-12)
        found += len(best & set(group.vec_id))
    assert found >= 0.9 * len(got)


def test_neighbours_odd(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(50, None), (51, [0.0, 0.0]), (52, [1.0, None]), (53, [float("nan"), 1.0]), (54, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows + rows[:3], "vec_id bigint, embedding array<double>")
    got = forest.nearest(df, 3, F.col("id") == 1).orderBy("rank").collect()
    assert [(r.vec, r.score) for r in got] == [(0, 1.0), (2, 1.0), (3, 1.0)]
    assert forest.nearest(df.limit(0), 3, F.col("id") == 1).count() == 0


def test_near_copies(spark, odd, none):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.permutation(base))) for i in range(10)]
    for i in range(10, 40):  # near copies of text 3, each with a word of its own
        words = rows[3][1].split()
        words[i * 7] = f"new{i}"
        rows.append((i, " ".join(words)))
    rows.append((41, rows[5][1].upper().replace("W", "w")))
    got = {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 85).collect()}
    assert got == {**{i: i for i in range(10)}, **{i: 3 for i in range(10, 40)}, 41: 5}
    odd_rows = hyperminhash.near_duplicates(odd, 85).collect()
    assert len(odd_rows) == odd.count() and all(r.component_id == r.doc_id for r in odd_rows)
    assert {r.doc_id: r.n_shingles for r in odd_rows if r.doc_id in (1, 2, 3, 4, 5)} == {1: 0, 2: 0, 3: 1, 4: 0, 5: 1}
    assert hyperminhash.near_duplicates(none, 85).count() == 0


def test_near_copies_of_every_text_of_an_id(spark):
    """An id with several texts of equal length is linked to the near copies of each of them."""
    rng, rows, want = np.random.default_rng(2), [], {}
    for i in range(0, 400, 40):
        for k in range(4):
            words = [f"w{i}.{k}.{j}" for j in rng.permutation(300)]
            rows.append((i, " ".join(words)))
            rows.append((i + 10 + k, " ".join([*words[:-1], f"new{k}"])))
        want.update({i: i, **{i + 10 + k: i for k in range(4)}})
    rows.append((399, "own words that nobody else has here"))
    got = hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 85).collect()
    assert len(got) == len(rows) and {(r.doc_id, r.component_id) for r in got} == {*want.items(), (399, 399)}


def lower_ascii(text):
    """Lower case of A-Z only."""
    return text.translate({ord(c): c.lower() for c in string.ascii_uppercase})


def plain_components(texts, threshold):
    """(size of the shingle set, smallest id reachable) of every id, all pairs compared."""
    sets = {}
    for i, text in texts.items():
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower_ascii(text or "")) if w]
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= threshold * max(len(sets[a]), len(sets[b])):
                if 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                    x, y = sorted((top(a), top(b)))
                    root[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_near_duplicates_query_is_that_of_all_pairs(result, docs):
    got = result("op10_hyperminhash")
    want = plain_components(dict(zip(docs.doc_id, docs.text, strict=True)), 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want
    assert (got.kept == (got.doc_id == got.component_id)).all()


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    """Members of a few crowded buckets, most pairs right below the threshold, dealt into many small blocks."""
    monkeypatch.setattr(hyperminhash, "BLOCK", 8)
    rnd, base = random.Random(3), [f"w{i}" for i in range(300)]
    texts = {}
    for i in range(90):
        words = list(base)
        for at in rnd.sample(range(300), rnd.choice([2, 4, 5, 6])):
            words[at] = f"x{i}-{at}" if rnd.random() < 0.7 else f"y{at}"
        texts[i] = " ".join(words)
    got = hyperminhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), threshold=85).collect()
    want = plain_components(texts, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert 1 < len({c for _, c in want.values()}) < 90


def test_a_pair_is_confirmed_in_one_of_its_buckets(spark, monkeypatch):
    """Texts that share many buckets, most pairs right below the threshold: a text moves for fewer of them than it shares."""
    written, write = {}, hyperminhash.materialise
    monkeypatch.setattr(hyperminhash, "materialise", lambda df, label="frame", **k: written.setdefault(label, write(df, label, **k)) if label in ("mixed", "flagged") else write(df, label, **k))
    rnd, base = random.Random(5), [f"w{i}" for i in range(300)]
    texts = {i: " ".join(f"x{i}-{k}" if k in places else w for k, w in enumerate(base)) for i in range(12) for places in [rnd.sample(range(300), 6)]}
    rows = [*texts.items(), (3, texts[3]), (11, texts[11])]
    got = hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), threshold=85).collect()
    want = plain_components(texts, 85)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((i, *want[i]) for i, _ in rows)
    assert 0 < 2 * written["flagged"].count() < written["mixed"].count()
