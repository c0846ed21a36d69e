"""URL rules, neighbours, HTML and decontamination against brute force, and their edge cases."""

import hashlib
import html as html_lib
import random
import re
import time

import numpy as np
import pytest

from papersieve.llm import decontamination, html_text, neighbours, queries, url_filter

RULES = "action string, host string, path string"


def judged(spark, urls, rules=queries.URL_RULES):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    rules = spark.createDataFrame(list(rules), RULES)
    return {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(pages, rules).collect()}


def test_urls_edge_cases(spark):
    urls = [
        None, "", "no scheme", "http://", "https://A.Example.NET/en/x?y#z", "http://net/", "http://net", "ftp://xnet/",
        "http://example.com/de/1", "http://notexample.com/de/1", "http://a.b.org/fr/", "http://a.org/FR/", "http://h.net?/en/",
    ]
    got = judged(spark, urls)
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("", "", None, "allow")
    assert got[4] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[5] == ("net", "/", "net/", "block")
    assert got[6] == ("net", "", None, "allow")
    assert got[7][2:] == (None, "allow")
    assert got[8][2:] == ("example.com/de/", "block")
    assert got[9][2:] == (None, "allow")
    assert got[10][2:] == ("org/fr/", "allow")
    assert got[11] == ("a.org", "/FR/", None, "allow")
    assert got[12] == ("h.net", "", None, "allow")
    assert judged(spark, urls, [("block", "zzz", "/")])[8][2] is None
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty, spark.createDataFrame(list(queries.URL_RULES), RULES)).count() == 0
    none = url_filter.judge(spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string"), spark.createDataFrame([], RULES))
    assert none.first()["verdict"] == "allow"


def test_many_rules_equal_brute_force(spark):
    rng = random.Random(3)
    names = ["a", "b", "c", "dd"]
    host = lambda: ".".join(rng.choice(names) for _ in range(rng.randint(1, 3)))
    path = lambda: "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 4)))
    keys = list({(host(), path()) for _ in range(60)})
    rules = [(rng.choice(["block", "allow"]), h, p) for h, p in keys]
    urls = [f"http://{host()}{path()}" for _ in range(400)]
    got = judged(spark, urls, rules)
    for i, url in enumerate(urls):
        h, _, p = url[7:].partition("/")
        p = "/" + p
        fits = [(len(rh + rp), rh.count("."), rh + rp, a) for a, rh, rp in rules if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
        best = max(fits, default=(0, 0, None, "allow"))
        assert got[i][2:] == (best[2], best[3]), url


@pytest.mark.parametrize("n", [1, 3, 5000])
def test_few_and_thousands_of_rules(spark, n):
    rules = [("block" if i % 3 else "allow", f"h{i}", "/" if i % 2 else "/a/") for i in range(n)]
    urls = [f"http://x.h{i}/a/{i}" for i in range(0, 7000, 5)]
    got = judged(spark, urls, rules)
    for k, i in enumerate(range(0, 7000, 5)):
        rule = f"h{i}" + ("/" if i % 2 else "/a/") if i < n else None
        assert got[k][2:] == (rule, "block" if i < n and i % 3 else "allow")


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(3000).selectExpr("concat('k', id) AS key")
    listed = spark.range(0, 3000, 7).selectExpr("concat('k', id) AS key")
    cascade = url_filter.build_cascade(listed, universe)
    found = {r["key"] for r in universe.filter(cascade.holds(universe["key"])).collect()}
    assert found == {f"k{i}" for i in range(0, 3000, 7)} and len(cascade.levels) > 1
    assert sum(level.bits for level in cascade.levels) < 16 * 429


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(900, 12)).astype(np.float32)
    vectors[100:140] = vectors[7]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(2000, None), (2020, []), (2040, [0.0] * 12), (2060, [float("nan")] * 12), (2080, [None] + [1.0] * 11), (2100, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, rank int, score string")
    found = neighbours.nearest(table.filter("vec_id % 20 = 0"), table, 20).collect()
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found}
    exact = vectors.astype(np.float64)
    queries_ = range(0, 900, 20)
    assert len(got) == 20 * len(queries_)
    for q in queries_:
        scores = neighbours.exact_products(np.repeat(exact[q : q + 1], 900, axis=0), exact)
        order = sorted((i for i in range(900) if i != q), key=lambda i: (-scores[i], i))[:20]
        assert [got[q, r + 1] for r in range(20)] == [(i, scores[i]) for i in order]


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0]), (2, [-1.0, 0.0])], schema)
    got = [tuple(r) for r in neighbours.nearest(few.filter("vec_id = 0"), few, 20).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 2, -1.0), (0, 3, 2, -1.0)]
    none = spark.createDataFrame([], schema)
    assert neighbours.nearest(none, few, 5).count() == 0 and neighbours.nearest(few, none, 5).count() == 0


def test_int8_bounds_hold():
    rng = np.random.default_rng(2)
    q, c = rng.normal(size=(50, 33)), rng.normal(size=(70, 33)) * 5
    codes_q, scale_q, norm_q, _, rest_q = neighbours.quantise(q)
    codes_c, scale_c, _, stands_c, rest_c = neighbours.quantise(c)
    near = (codes_q.astype(float) @ codes_c.T.astype(float)) * scale_q[:, None] * scale_c[None, :]
    assert (np.abs(near - q @ c.T) <= norm_q[:, None] * rest_c[None, :] + rest_q[:, None] * stands_c[None, :] + 1e-9).all()


PAGE = (
    '<html><head><title>T</title></head><body><header>Top</header><div class="cookie-notice">We</div><div class="post post-77">'
    "<h1>Head &amp; <i>er</i></h1><p>One\n two<p>Three&nbsp;x<ul><li>a<li>b</ul><div class=ad>buy</div><form>q<input></form>"
    '<section id="comments"><p>nice</p></section><script>var t="</p>";</script></div><aside>side</aside><footer>f</footer>'
)


def extracted(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    return {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.extract(table).collect()}


def test_html_edge_cases(spark):
    other = PAGE.replace("post-77", "post-5").replace("One", "More")
    got = extracted(spark, [
        (1, "http://h/1", PAGE), (2, "http://h/2", other), (3, None, None), (4, "http://x/", ""), (5, "http://y/", "a &lt; b <b>c</b>d"),
        (6, "http://h/3", "<body><p>no post here"), (7, "http://z/", '<a title="open>broken'), (7, "http://z/", '<a title="open>broken'),
    ])
    assert got[1] == ("Head & er\nOne two\nThree x\na\nb", 29)
    assert got[2][0].startswith("Head & er\nMore two")
    assert got[3] == got[4] == ("", 0)
    assert got[5] == ("a < b cd", 8)
    assert got[6] == ("no post here", 12)
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_attribute_values_are_not_attributes():
    read = lambda html: html_text.Page(html).text_below(None)
    assert read('<div style="overflow:hidden">kept</div>') == read("<div data-id='comments-x y'>kept</div>") == "kept"
    assert read("<div hidden>gone</div>") == read('<p aria-hidden="true">gone</p>') == read("<div class='x' id=side-bar-ad>gone</div>") == ""


def test_wrappers_named_after_furniture_are_read():
    read = lambda html: html_text.Page(html).text_below(None)
    text, side = "article text " * 30, "<div class='sidebar'><p>beside it</p></div><section id='comments'><p>nice</p></section>"
    want = text.strip()
    for wrapper in ("div class='content has-sidebar'", "main class='article-with-comments'", "form action='/x'", "div class='newsletter'"):
        tag = wrapper.split()[0]
        assert read(f"<body><header>Top</header><{wrapper}><p>{text}</p>{side}</{tag}></body>") == want, wrapper
    widget = "<div class='elementor-widget elementor-widget-%s'><div class='elementor-widget-container'>%s</div></div>"
    parts = widget % ("heading", "<h1>Head</h1>") + (widget % ("text-editor", f"<p>{text}</p>")) * 2
    assert read(f"<body>{parts}{side}</body>") == f"Head\n{want}\n{want}"
    assert read("<body><div class='sidebar-wrap'><article><p>short</p></article></div><div><a href='/'>x</a></div></body>") == "short"
    long = f"<section id='comments'><article class='comment'><p>{text * 9}</p></article></section>"
    assert read(f"<body><article><p>{text}</p></article>{long}</body>") == want
    assert read(f"<body><div class='post'><p>{text}</p></div><div class='cookie-consent'><p>{text * 3}</p></div></body>") == want


def test_host_consensus_wins_over_a_page_of_its_own(spark):
    usual = "<body><div class='story'><p>%s</p></div><div class='box'><p>short</p></div></body>"
    odd = "<body><div class='story'><p>brief</p></div><div class='box'><p>a long box that beats the story of this very page by far</p></div></body>"
    rows = [(i, f"http://h/{i}", usual % (f"long story {i} " * 9)) for i in range(5)] + [(9, "http://h/9", odd)]
    assert extracted(spark, rows)[9] == ("brief", 5)


def test_copies_of_a_page_do_not_change_its_text(spark):
    page = "<main><h1>Title %s</h1><p>lead</p><div class=body>" + "<p>body text of the article</p>" * 20 + "</div><p>closing</p></main>"
    want = "\n".join(["Title x", "lead", *["body text of the article"] * 20, "closing"])
    for copies in range(1, 6):
        got = extracted(spark, [(i, f"http://h/{i}", page % "x") for i in range(copies)])
        assert {text for text, _ in got.values()} == {want}
    headed = "<article><header><h1>Title</h1></header><p>text of an article</p></article>"
    assert extracted(spark, [(1, "http://h/", headed)])[1][0] == "text of an article"


def test_deep_and_unclosed_pages_take_little(spark):
    texts = ["<div>" * 50_000 + "text here", "<div>a b" * 50_000, "<p>t<svg>" * 50_000, "<button>x" * 50_000, "<div>" * 20_000 + "</td>" * 50_000]
    begun = time.time()
    got = [html_text.Page(t).text_below(None) for t in texts]
    assert got[0] == "text here" and got[1].split("\n") == ["a b"] * 50_000 and time.time() - begun < 20
    assert max(map(len, html_text.Page(texts[1]).paths)) < 2 * html_text.LONG_PATH


def test_article_text_beside_the_winning_container_is_kept(spark):
    body = "".join(f"<p>{'body text %d ' % i * 9}</p>" for i in range(20))
    lead = "<h1>Heading %d</h1><div class='body'>BODY</div><p>Closing %d</p>".replace("BODY", body)
    sections = "<section class='a'>BODY</section><section class='b'><div><p>Second part %d</p></div></section>".replace("BODY", body)
    rows = []
    for i in range(4):
        rows += [(i, f"http://h/{i}", f"<body><div class='x'>Site motto</div><article>{lead % (i, i)}</article></body>")]
        rows += [(10 + i, f"http://s/{i}", f"<body><main><article>{sections % i}</article></main></body>")]
        rows += [(20 + i, f"http://d/{i}", f"<body><div class='motto'>Site motto</div><div class='post'>{lead % (i, i)}</div><div class='links'><a href='/'>Text {i}</a></div></body>")]
        rows += [(30 + i, f"http://e/{i}", f"<body><div class='motto'>Site motto</div><div class='post'>{sections % i}</div></body>")]
    got = extracted(spark, rows)
    for i in range(4):
        for page in (i, 20 + i):
            lines = got[page][0].split("\n")
            assert (lines[0], len(lines), lines[-1]) == (f"Heading {i}", 22, f"Closing {i}")
        for page in (10 + i, 30 + i):
            lines = got[page][0].split("\n")
            assert (len(lines), lines[-1]) == (21, f"Second part {i}")


def test_repeated_hot_id_and_grid(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(5, rng.normal(size=4).tolist()) for _ in range(150)] + [(i, rng.normal(size=4).tolist()) for i in range(300)] + [(5, [1.0, 2.0, 3.0, 4.0])] * 50
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(neighbours, "MOST_QUERIES", 16)
    monkeypatch.setattr(neighbours, "ROWS_PER_BLOCK", 64)
    assert neighbours.grid(8, 100) == (7, 4)
    found = neighbours.nearest(table.filter("vec_id % 20 = 0 or vec_id = 5"), table, k=6)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    for q in {i for i, _ in rows if i % 20 == 0 or i == 5}:
        pairs = [(sum(a * b for a, b in zip(v, w)), i) for qq, v in rows if qq == q for i, w in rows if i != q]
        want = sorted(pairs, key=lambda p: (-p[0], p[1]))[:6]
        assert [i for _, i in got[q]] == [i for _, i in want] and np.allclose([s for s, _ in got[q]], [s for s, _ in want])


def test_articles_equal_a_plain_pattern(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*)</article>", row["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1|h2|h3|li|ul|ol|div)(?:\s[^>]*)?>", article)
        texts = [" ".join(html_lib.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
        assert got[row["page_id"]] == "\n".join(t for t in texts if t)


def windows_by_hand(text, items, size=10):
    cut = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, ids = cut(text), set(), set()
    for item, body in items:
        own = cut(body)
        if item is None or body is None or not own:
            continue
        n = min(size, len(own))
        for i in range(len(own) - n + 1):
            for at in range(len(words) - n + 1):
                if words[at : at + n] == own[i : i + n]:
                    hit.update(range(at, at + n))
                    ids.add(str(item))
    return len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("limit", [decontamination.BROADCAST_BYTES, -1])
def test_decontamination_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", limit)
    rng = random.Random(4)
    word = lambda: rng.choice(["a", "b", "É", "c9", "the"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 3, 9, 10, 14, 30])))) for i in range(25)]
    items += [(None, "a b"), (30, None), (31, "..."), (5, "z z z z")]
    texts = [None, "", "...", "Z z-Z z", "a"] + [" ".join(word() for _ in range(rng.randint(1, 80))) for _ in range(30)]
    for item in (7, 9, 11):
        texts.append("x " * 40 + items[item][1].upper() + " y" * 300)
    rows = [(i, t, "en", True) for i, t in enumerate(texts)] + [(3, texts[3], "en", True), (3, "other", "en", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, contaminated boolean")
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, n_words int")
    found = decontamination.decontaminate(docs, bench).drop("mark").collect()
    want = sorted((i, *windows_by_hand(t, items)) for i, t, _, _ in rows)
    assert sorted(tuple(r) for r in found) == want
    kept = decontamination.keep_clean(docs, bench)
    dirty = {w[0] for w in want if w[5]}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {w[0] for w in want} - dirty


@pytest.mark.parametrize("limit", [decontamination.LISTED_BYTES, -1])
def test_contaminated_rows_without_id_go(spark, monkeypatch, limit):
    monkeypatch.setattr(decontamination, "LISTED_BYTES", limit)
    rows = [(None, "x a b c y"), (None, "clean"), (None, None), (1, "A b c"), (1, "same id"), (2, "a c b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    kept = [tuple(r) for r in decontamination.keep_clean(docs, bench).collect()]
    assert sorted(kept, key=str) == sorted([rows[1], rows[2], rows[5]], key=str)


def test_decontamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.decontaminate(docs, bench).first()["contaminated"] is False
    none = spark.createDataFrame([], "doc_id long, text string")
    assert decontamination.decontaminate(none, bench).count() == 0
