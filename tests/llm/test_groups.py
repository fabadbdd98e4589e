"""Near copies of documents and embeddings, HTML extraction and the pipeline against brute force."""

import random
import re
import time

import numpy as np
import pytest

pytest.importorskip("prismcube.llm")
from pyspark.sql import functions as F  # noqa: E402

from prismcube.llm import embedding_dup, html_text, near_dup  # noqa: E402
from prismcube.llm.common import Scratch, connected_components, read  # noqa: E402


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_connected_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(1000, x) for x in range(500, 560)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)] + [(7, 7)]
    got = {r.id: r.component for r in connected_components(Scratch(spark), spark.createDataFrame(links, "a long, b long")).collect()}
    want = components({x for ab in links for x in ab}, links)
    assert got == {i: want[i] for i in got} and {x for a, b in links if a != b for x in (a, b)} == set(got)


def brute(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        k = min(words, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, components(ids, links)


@pytest.mark.parametrize("params", [near_dup.OP3, near_dup.Params()])
def test_near_duplicates(spark, sf, params):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(500)]
    rows, base = [], [rng.choice(vocabulary) for _ in range(150)]
    for i in range(80):  # a family whose members are near the threshold of one another
        t = list(base)
        for _ in range(rng.randrange(1, 6)):
            t[rng.randrange(len(t))] = rng.choice(vocabulary)
        rows.append((10_000 + i, " ".join(t)))
    for i in range(30):  # documents that share half with one another
        rows.append((20_000 + i, " ".join(base[:70] + [rng.choice(vocabulary) for _ in range(70)])))
    rows += [(30_000, ""), (30_001, None), (30_002, "A b"), (30_003, "a\tB "), (30_004, "a"), (30_005, " "), (30_006, "b a")]
    docs = read(spark, sf, "documents").unionByName(spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit(1)), allowMissingColumns=True)
    every = [(r.doc_id, r.text) for r in docs.collect()]
    sets, want = brute(every, params.words, params.percent)
    extra = docs.unionByName(docs.filter("doc_id = 10000")).unionByName(docs.filter("doc_id = 10001").withColumn("doc_id", F.lit(None).cast("long")))
    got = near_dup.near_duplicates(extra, params).collect()
    assert len(got) == len(every) + 2
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], r.doc_id == want[r.doc_id])
    kept = near_dup.deduplicate(extra, params)
    assert kept.columns == extra.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([*(str(i) for i in want if want[i] == i), "None"])
    assert near_dup.near_duplicates(docs.limit(0), params).collect() == []


@pytest.mark.parametrize(("params", "n"), [(near_dup.OP3, 8), (near_dup.Params(), 8)])
def test_short_pairs_at_the_threshold(spark, params, n):
    # one word more: 6 of 7 and 4 of 5 shingles are shared
    rows = []
    for i in range(1500):
        words = [f"v{i}x{k}" for k in range(n + 1)]
        rows += [(2 * i, " ".join(words[:n])), (2 * i + 1, " ".join(words))]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), params).collect()
    assert [r.doc_id for r in got if r.component_id != r.doc_id // 2 * 2] == []


@pytest.mark.parametrize(("params", "shared", "own"), [(near_dup.OP3, 6, 1), (near_dup.Params(), 4, 1), (near_dup.Params(), 32, 8)])
def test_bits_of_minima_are_independent(params, shared, own):
    rng, lost = np.random.default_rng(9), 0
    for _ in range(10):
        x = rng.integers(0, 2**64, (300, shared + own), np.uint64)
        a, b = (np.concatenate(near_dup.planes(np.stack([near_dup.minima(r[:k]) for r in x])), axis=1) for k in (shared, shared + own))
        differ = np.bitwise_count(((a ^ b)[:, :4] | (a ^ b)[:, 4:]).view(np.uint64)).sum(axis=1)
        lost += int((((1 - differ / near_dup.HASHES) - 0.25) / 0.75 < params.least_estimate).sum())
    assert lost == 0


def test_shuffled_ids_way(spark, sf, monkeypatch):
    docs = read(spark, sf, "documents")
    want = sorted(map(tuple, near_dup.near_duplicates(docs).collect()))
    monkeypatch.setattr(near_dup, "BROADCAST_IDS", 0)
    assert sorted(map(tuple, near_dup.near_duplicates(docs).collect())) == want


@pytest.mark.parametrize("tile", [1024, 16])
def test_embedding_duplicates(spark, sf, tile):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 8))
    rows = [(i, (base[i % 6] + rng.normal(size=8) * 0.2).tolist(), i % 3) for i in range(200)]
    rows += [(200 + i, rows[0][1], 0) for i in range(40)] + [(300, [0.0] * 8, 0), (301, None, 0), (302, [1.0, None, *[0.0] * 6], 0), (303, [float("nan")] * 8, 0), (304, [float("inf")] * 8, 0), (305, rows[0][1], None)]
    rows += [(306, [1e300] * 8, 1), (307, [1e-300] * 8, 1), (308, [1.0, 2.0], 1), (309, [2.0, 4.0], 1), (310, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("links", F.lit(9)).withColumn("id", F.lit("x"))
    good = [(i, np.array(v), y) for i, v, y in rows if v and y is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = []
    for n, (i, v, y) in enumerate(good):
        for j, u, z in good[n + 1 :]:
            if y == z and len(u) == len(v):
                a, b = u / np.abs(u).max(), v / np.abs(v).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93:
                    links.append((i, j))
    want, n = components([r[0] for r in rows], links), {}
    for ab in links:
        for x in ab:
            n[x] = n.get(x, 0) + 1
    assert links
    got = embedding_dup.embedding_duplicates(df, tile=tile).collect()
    assert sorted(map(tuple, got)) == sorted((i, n.get(i, 0), want[i], want[i] == i) for i in want)
    assert embedding_dup.embedding_duplicates(df.limit(0)).collect() == []
    (r,) = embedding_dup.embedding_duplicates(df.limit(1).withColumn("vec_id", F.lit(None).cast("long"))).collect()
    assert (r.vec_id, r.n_links, r.component_id, r.kept) == (None, 0, None, True)


def test_every_vector_length_is_compared(spark, monkeypatch):
    df = spark.createDataFrame([(i, [1.0, 1.0 + i / 100][: 1 + i % 2], 0) for i in range(6)], "vec_id long, embedding array<double>, label int")
    limit = type(df).limit
    monkeypatch.setattr(type(df), "limit", lambda self, n: limit(self, min(n, 1) if n >= 1000 else n))  # a cap on lengths would bite here
    assert {r.vec_id: r.n_links for r in embedding_dup.embedding_duplicates(df).collect()} == dict.fromkeys(range(6), 2)


def page(article, extra=""):
    return f"<html><head><title>t</title><script>var a='<p>no</p>';</script></head><body><nav><ul><li>m</ul></nav><div class='site-box'><span>Follow us</span> now</div>{extra}<article>{article}</article><footer>f</footer></body></html>"


def texts(spark, rows, **kw):
    return {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)), **kw).collect()}


def test_html_cases(spark):
    rows = [
        (1, "http://a.b/x", page("<h1>T &amp; &lt;x&gt;</h1><p>One\n two <b>bold</b>ly<p>three<br>four<ul><li>a<li>b</ul>")),
        (2, None, None),
        (3, "http://a.b/y", ""),
        (4, "http://a.b/z", "plain &copy; text"),
        (5, "http://a.b/z", "<body><div>only <i>div</i></div><div class=ad>buy</div><form>f</form><aside>s</aside><p>cut <b>of"),
        (6, "http://a.b/z", page("<p>x</p><div class='comments'><p>reader</p></div><div id=share>s</div><p>y &am")),
        (7, "http://a.b/z", "<div>" * 5000 + "deep" + "</div>" * 5000),
        (8, "x", "<article><p>a</p><!-- <p>no</p> --><style>p{}</style><p>b < c &amp; 1<2</p></article>"),
        (9, "http://a.b/q", "<article><p>long " + "word " * 40_000 + "</p></article>"),
    ]
    got = texts(spark, rows)
    assert got[1] == "T & <x> One two boldly three four a b" and got[2] == got[3] == "" and got[4] == "plain © text"
    assert got[5] == "only div cut of" and got[6] == "x y &am" and got[7] == "deep" and got[8] == "a b < c & 1<2" and len(got[9]) == 4 + 40_000 * 5


@pytest.mark.parametrize("limit", [1000, 0])
def test_html_templates(spark, limit):
    # no article element: the recurring block goes, the recurring passage of copies stays
    body = lambda i: f"<body><div><p>About this site and its makers</p></div><div><p>Story {i} is told here.</p></div></body>"
    rows = [(i, f"https://h.org/{i}", body(i)) for i in range(20)] + [(100 + i, "https://copies.org/", body(1)) for i in range(20)]
    rows += [(200 + i, f"http://art.org/{i}", page(f"<p>The same opening passage.</p><p>Story {i}.</p><div class=x>Follow</div>")) for i in range(20)]
    got = texts(spark, rows, broadcast_limit=limit)
    assert got[3] == "Story 3 is told here." and got[103] == "About this site and its makers Story 1 is told here."
    assert got[207] == "The same opening passage. Story 7."


def test_html_recurring_content_stays(spark):
    # neither article nor main: what recurs on some pages, or inside a sentence, a table or as a heading, is content
    def body(i):
        some = "<p>Said on some pages.</p>" if i < 8 else ""
        return f"<body><div><p>Site notice</p></div><div><h2>Introduction</h2><p>Do <em>not</em> take {i}. <b>Note</b></p>{some}<table><tr><td>0</td><td>{i}</td></tr></table></div></body>"

    rows = [(i, f"https://h.org/{i}", body(i)) for i in range(20)]
    rows += [(100 + i, f"https://a.org/{i}", f"<article><p>Story {i} <b>Note</b></p><div class=x><p>Buy <a href=/>this</a></p></div><p>Same end.</p></article>") for i in range(20)]
    got = texts(spark, rows)
    assert got[3] == "Introduction Do not take 3. Note Said on some pages. 0 3" and got[12] == "Introduction Do not take 12. Note 0 12"
    assert got[107] == "Story 7 Note Same end."


def test_html_class_names(spark):
    story = "<article><div class='entry-header'><h1>T</h1></div><div class='header'><p>H</p></div><p>Story</p><div class='comments'><article class=comment>c</article></div></article>"
    around = ["class='has-sidebar'", "class='page no-sidebar'", "id='content-sidebar-wrap'", "class=sidebar", "class='site-header'", "id=social"]
    rows = [(i, f"http://a{i}.b/", f"<body><div {a}>{story}</div></body>") for i, a in enumerate(around)]
    rows += [(50, "http://m.b/", "<div class='banner'><main><p>Main</p></main></div><div class='widget'>w</div>")]
    gone = ["ad", "x ad-300x250", "site-footer", "cookie-notice", "widget-area", "share-buttons", "sidebar--left", "related_posts", "comment-list", "site-header", "page-header", "main-menu", "comments-area", "sidebar"]
    rows += [(100 + i, f"http://g{i}.b/", f"<body><div class='{a}'>no <article>teaser</article></div><article><p>yes</p></article></body>") for i, a in enumerate(gone)]
    rows += [(200, "http://p.b/", "<div class='entry-header'><h1>Title</h1></div><div class='layout--has-sidebar'>text</div>")]
    got = texts(spark, rows)
    assert [got[i] for i in range(len(around))] == ["T H Story"] * len(around) and got[50] == "Main"
    assert [got[100 + i] for i in range(len(gone))] == ["yes"] * len(gone) and got[200] == "Title text"


def test_html_whole_pages_and_names():
    one = lambda page: html_text.text_of(page, "http://a.b/", np.zeros(0, np.int64))
    story = "".join(f"<p>This is paragraph {i} of the whole page here.</p>" for i in range(5))
    assert one(f"<body><form action=/><h1>T</h1>{story}<label>mail</label><input></form></body>").startswith("T This is paragraph 0")
    assert one("<body><form><p>Please log in</p><input></form><p>Hello you.</p></body>") == "Hello you."
    assert one("<form><article>Story</article><button>b</button></form>") == "Story"
    assert one("<article><p>a</p><div class='related-work'><p>Prior work text.</p></div><div class=related><ul><li><a href=/x>Other</a></ul></div></article>") == "a Prior work text."
    assert one("<div class=related><p>Twelve words of running text make a block that no name deletes here at all.</p></div>").startswith("Twelve")
    assert one("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> be.</p>") == "Let x=1 be."
    assert one("<article><div class='entry-header'><h1>Title</h1></div><p>Story</p></article>") == "Title Story"
    assert one("<article class=comment><p>A reader.</p></article><p>Main</p>") == "Main"
    assert one("<article class='post has-comments'><p>Main</p></article><article class='comment-body'>A reader.</article>") == "Main"


def test_html_menus_by_skeleton(spark):
    # link lists that change from page to page, without any name; on a host of one page they stay
    body = lambda i: f"<body><div><ul>{''.join(f'<li><a href=/{k}>link {k}</a></li>' for k in range(i, i + 2 + i % 4))}</ul></div><p>Story {i} of <a href=/s>this</a> site.</p></body>"
    got = texts(spark, [(i, f"http://h.org/{i}", body(i)) for i in range(12)] + [(100, "http://single.org/", body(5))])
    assert got[7] == "Story 7 of this site." and got[100].startswith("link 5 link 6") and got[100].endswith("Story 5 of this site.")


def test_html_rows_without_id(spark):
    body = lambda i: f"<body><div>Notice of <i>all</i> pages</div><p>Story {i} is here.</p></body>"
    df = spark.createDataFrame([(None, f"http://h.org/{i}", body(i)) for i in range(9)] + [(1, "http://h.org/1", body(1))] * 2, "page_id long, url string, html string").withColumn("key", F.lit("x")).withColumn("h0", F.lit("y"))
    small, large = (sorted(map(str, html_text.extract(df, broadcast_limit=n).collect())) for n in (1000, 0))
    assert small == large and all("Notice" not in r for r in small) and len(small) == 11
    assert html_text.extract(df.limit(0)).collect() == []


def test_html_templates_of_the_pages(spark, monkeypatch, capsys):
    # counted subtrees are deleted before anything is dropped by name; without names the articles stay as they are
    pages = read(spark, "/root/testdata/sf0.1", "pages")
    want = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    keys = np.sort(html_text.templates(html_text.subtrees(pages)).toArrow().column("key").to_numpy())
    rows = pages.collect()
    deleted = sum(html_text.delete(html_text.parse(r.html), html_text.host_of(r.url), keys) for r in rows)
    with capsys.disabled():
        print(f"\n{len(keys)} templates, {deleted} subtrees deleted from {len(rows)} pages")
    assert deleted > len(rows)
    for name in ("NOISE", "WEAK", "HEADER", "COMMENT"):
        monkeypatch.setattr(html_text, name, re.compile("(?!)"))
    monkeypatch.setattr(html_text, "DROPPED", frozenset())
    assert all(html_text.text_of(r.html, r.url, keys) == want[r.page_id] for r in rows)


def test_pages_equal_articles(spark, sf):
    import html as entities

    got = {r.page_id: r.text for r in html_text.extract(read(spark, sf, "pages")).collect()}
    for r in read(spark, sf, "pages").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " ")))).strip() for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id] == " ".join(filter(None, parts))


def test_decontamination_of_rows_without_id(spark, sf):
    pipeline = pytest.importorskip("corpus_pipeline")
    item = max((r.text or "" for r in read(spark, sf, "benchmark").collect()), key=len)
    rows = [(None, f"a {item} b", "x"), (None, "quite clean", "y"), (1, item, "z"), (2, "clean", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = pipeline.stage_decontaminate(spark, docs, sf)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=str) == sorted([rows[1], rows[3]], key=str)


def test_pipeline(spark, sf):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = read(spark, sf, "documents")
    out = docs
    for _, stage in pipeline.STAGES[:-1]:
        out = Scratch(spark).save(stage(spark, out, sf), "stage")
        assert out.columns == docs.columns and out.count() > 0
    kept = [(r.doc_id, r.text) for r in out.dropDuplicates(["doc_id"]).collect()]
    _, want = brute(kept, 5, 80)
    assert all(want[i] == i for i in want)
    final = pipeline.run(spark, sf).collect()
    assert sorted(r.doc_id for r in final) == sorted(r.doc_id for r in out.collect())
    assert max(r.start + r.n_tokens for r in final) == sum(r.n_tokens for r in final)


def one_page(page):
    return html_text.text_of(page, "http://a.b/", np.zeros(0, np.int64))


def test_html_stray_quotes():
    assert one_page('<p>See <a href="x>the page</a> and more.</p><p class="b">Second.</p>') == "See the page and more. Second."
    assert one_page("<a title='it's fine'>yes</a>") == "yes" and one_page('<img alt="5" tall"> text <a href="x">y</a>') == "text y"
    assert one_page('<a title="a > b">q</a>') == "q" and one_page('<p>x</p><a href="un') == "x" and one_page('<p class="b"id=c>d</p>') == "d"


@pytest.mark.parametrize(
    "markup",
    ["<div>{}</b>", "<span>{}<p>x", "<b><table><td><div>{}</b>", '<a href="x>t</a>{}', "<a b='>{}\"", "<p><b>{}", "<div class=related>{}" + "one two three four five six seven eight nine ten eleven twelve", "<article>{}", "<div class=ad>{}<main></main>"],
)
def test_html_odd_markup_takes_linear_time(markup):
    first, last = markup.split("{}")
    n = 1_000_000 // max(len(first), 1)
    page = first * n + (last * n if last.startswith("<") else last)
    began = time.process_time()
    one_page(page)
    html_text.candidates(page, "http://a.b/")
    assert time.process_time() - began < 40  # quadratic: hours


def test_html_recurring_lines_of_div_articles_stay(spark):
    body = lambda i: f"<body><article><div>Story {i}.</div>{'<div>See also the manual.</div>' if i < 5 else ''}<div class=x>Read on</div></article></body>"
    got = texts(spark, [(i, f"http://h.org/{i}", body(i)) for i in range(100)])
    assert got[3] == "Story 3. See also the manual." and got[50] == "Story 50."  # what is on most pages goes


def test_html_running_text_of_named_elements():
    twelve = "one two three four five six seven eight nine ten eleven twelve"
    for inner, stays in [
        (twelve, True), (f"<i>{twelve}</i>", True), ("one two three <b>four five six</b> seven eight nine <i>ten <b>eleven</b></i> twelve", True), ("one two three<p>four five six seven eight nine ten eleven twelve", False),
        ("<span>one two three<p>four</p>five six</span> seven eight nine ten eleven twelve", False), (f"<span>x<p>y</p>five six seven</span> eight nine ten {'w ' * 6}", True), (f"<a href=/>{twelve}</a>", False), ("<h1>t</h1>", True), (f"<div><p>{twelve}</div>", True),
    ]:
        assert bool(one_page(f"<p>a</p><div class=related>{inner}</div>") != "a") == stays, inner
