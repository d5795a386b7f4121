"""Operator 3: extraction against a plain reading of the test pages, and wrappers
that match every page they were inferred from."""

import html
import random
import re
import time

import pyarrow.parquet as pq
import pytest

from tillroll.llm import html_wrappers as hw

SF = "/root/testdata/sf0.01"


def plain(page):
    """The test pages have one form: an article of a heading and paragraphs."""
    body = (page or "").partition("<article>")[2].partition("</article>")[0].partition("<footer>")[0]
    blocks = re.split(r"</?(?:p|h1)>", body)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*(?:>|$)", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_query(spark):
    want = {r["page_id"]: (r["url"], plain(r["html"])) for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    got = {r.page_id: (r.url, r.text) for r in hw.query(spark, SF).collect()}
    assert got == want
    assert all(r.n_chars == len(r.text) for r in hw.query(spark, SF).collect())


CASES = [
    ("", ""),
    ("just text &amp; more&nbsp;here &#233; &am", "just text & more here é &am"),
    ("<p>a<p>b\n c<br>d</p>e", "a\nb c d\ne"),
    ("<body><div class='Cookie-notice'>x</div><div id=content><h1>T</h1><p>one <b>two</b>three</p></div><div>more</div>", "T\none twothree"),
    ("<nav>n</nav><article><header><h1>T</h1><p>by me</p></header><p>x</p><aside>s</aside><form>f<p>g</form>y</article>z", "T\nx\ny"),
    ("<main>a<article>b</article></main><article class='comment'>c</article>", "b"),
    ("<div role=main>m</div><div role='navigation'>n</div>", "m"),
    ("<article><ul><li>a<li>b<ul><li>c</ul></ul><script>var x='<p>no</p>'</script><!-- <p>no --> d<!-- open", "a\nb\nc\nd"),
    ("<article><p>open quote <a href='x>y", "open quote y"),
    ("<article><p>cut off <a href='x", "cut off"),
    ("<article>a</p>b</div></article>c<article>d", "a\nb\nd"),
    ("<header>h</header><p>x</p><footer>f</footer><style>s", "x"),
    ("<article><p>a</p><section class='comments'><article>c</article></section><div class='ad'>b</div></article>", "a"),
    ("<body class='has-sidebar'><div class='main-menu'>m</div><table><tr><td>1<td>2<tr><td>3</table></body>", "1\n2\n3"),
    ("<article>x<p>1 < 2 and 3 > 2</p>", "x\n1 < 2 and 3 > 2"),
    ("<textarea><p>t</textarea><title>t</title><noscript>n</noscript><p hidden>x", "x"),
    ("<ARTICLE><P>A</P></ARTICLE>", "A"),
    ("<article>" + "<div>" * 3000 + "deep" + "<b>" * 2000, "deep"),
    ("<article>" + "<p>w " * 5000, "\n".join(["w"] * 5000)),
]


@pytest.mark.parametrize("page,want", CASES)
def test_rules(page, want):
    assert hw.main_text(page) == want


def test_deep_pages_are_read_in_linear_time():
    deep = 20_000
    nested = "<article>" + "<div>" * deep + "x" + "</div>" * deep + "<p>end"
    cells = "<article>" + "<div>" * deep + "<tr><td>y" * deep
    start = time.process_time()
    assert hw.main_text(nested) == "x\nend"
    assert hw.main_text(cells) == "\n".join(["y"] * deep)
    assert time.process_time() - start < 8


def pages_of(n, seed=1):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        menu = "".join(f"<li><a href=/{j}>m{rnd.random()}</a></li>" for j in range(rnd.randrange(1, 5)))
        extra = f"<div class='teaser'>t{k}</div>" if rnd.random() < 0.4 else ""
        body = "".join(rnd.choice([f"<p>p{rnd.random()}</p>", f"<p><b>b{rnd.random()}</b></p>"]) for _ in range(rnd.randrange(1, 7)))
        out.append(f"<html><body><ul>{menu}</ul><h4>Our paper</h4>{extra}<div><h1>t{k}</h1>{body}</div><p>All rights kept</p></body></html>")
    return out


@pytest.mark.parametrize("seed", range(8))
def test_wrapper_matches_its_pages(seed):
    pages = pages_of(12, seed)
    wrapper = hw.page_expression(pages[0])
    for p in pages[1:]:
        wrapper = hw.align(wrapper, hw.page_expression(p))
    pattern = re.compile(hw.as_regex(wrapper))
    assert all(pattern.fullmatch("".join(hw.read_page(p)[0])) for p in pages)
    assert hw.fingerprint("Our paper") in hw.constants(wrapper) and "|" not in hw.as_regex(wrapper)


def test_repeats_and_options():
    a, b = hw.page_expression("<ul><li>a<li>b</ul>"), hw.page_expression("<ul><li>c</ul><p>x")
    assert a == ["<ul>", ("+", ("<li>", ("#", None), "</li>")), "</ul>"]
    assert hw.as_regex(hw.align(a, b)) == r"<ul>(?:<li>\#</li>)+</ul>(?:<p>\#</p>)?"


def test_constant_texts_are_template(spark):
    data = [(k, f"http://one.example/{k}", p) for k, p in enumerate(pages_of(30))]
    data += [(100 + k, f"//two.example/{k}", p) for k, p in enumerate(pages_of(2))] + [(200, None, None), (201, "no url", "<p>x"), (201, "no url", "<p>x")]
    df = spark.createDataFrame([(*r, "c") for r in data], "page_id long, url string, html string, text string").repartition(4)
    out = {r.row.page_id: r.text for r in hw.extract(df).collect()}
    assert len(out) == 34 and out[200] == "" and out[201] == "x"
    for k in range(30):
        assert "Our paper" not in out[k] and "All rights kept" not in out[k] and f"t{k}" in out[k].split("\n")
    assert "Our paper" in out[100]
    copies = spark.createDataFrame([(k, "//c/", "<h1>t</h1><p>x") for k in range(4)], "page_id long, url string, html string")
    assert {r.text for r in hw.extract(copies).collect()} == {"t\nx"}
    hosts = {r.host: r.pages for r in hw.host_wrappers(df).collect()}
    assert hosts == {"one.example": 30, "two.example": 2, "": 3}


def test_heterogeneous_host_and_empty(spark, monkeypatch):
    monkeypatch.setattr(hw, "MOST_ITEMS", 5)
    assert hw._merge('["<p>", "</p>"]', '["<ul>", "<li>", "</li>", "</ul>"]') is None and hw._merge(None, "[]") is None
    df = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    assert hw.extract(df.limit(0)).collect() == [] and hw.extract(df).collect()[0].text == "x"


def test_large_pages_take_part(spark, monkeypatch):
    """A text that pages too large for the wrapper contradict is no template; one they hold is."""
    monkeypatch.setattr(hw, "MOST_ITEMS", 40)
    page = "<body><div class=a><p>{}</p></div><div class=b><p>Same line</p></div><div class=c><p>own {}</p></div>{}</body>"
    rest = "".join(f"<i class=x{chr(97 + k)}>r{k}</i>" for k in range(20))
    rows = [(k, "//h/", page.format("Old line", k, "")) for k in range(6)]
    rows += [(k, "//h/", page.format(f"Other {k}", k, rest)) for k in range(6, 9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    out = {r["row"].page_id: r.text.split("\n") for r in hw.extract(df).collect()}
    assert all(out[k] == ["Old line", f"own {k}"] for k in range(6))
    assert all(out[k][:2] == [f"Other {k}", f"own {k}"] for k in range(6, 9))


LAYOUTS = [
    ("<body><div id='page' class='has-sidebar'><article><p>x</p></article><aside>s</aside></div>", "x"),
    ("<body><div class='layout sidebar-right'><article><p>x</p></article><aside>s</aside></div>", "x"),
    ("<body><div class='layout sidebar'><div role=main>long text</div><div class='sidebar'>s</div></div>", "long text"),
    ("<div role=main class='widget'>m</div><p>z", "m"),
    ("<article><div class='post-header'><h1>T</h1><p>by me</p></div><p>x</p></article>", "T\nx"),
    ("<div class='post'><div class='post-header'><h1>T</h1><p>by me</p></div><p>x</p></div>", "T\nx"),
    ("<form id=f><div class='sidebar'>s</div><article>x<div class='share'>much longer than x</div></article></form>", "x"),
    ("<article>the text of the page</article><div class='sidebar'><article>teaser</article></div>", "the text of the page"),
    ("<article>x</article><section class='comments'><article>a comment longer than x</article></section>", "x"),
    ("<article class='has-comments'>x</article>", "x"),
    ("<div class='sidebar'>a long list of things</div><div id=content>x</div>", "x"),
]


@pytest.mark.parametrize("page,want", LAYOUTS)
def test_layouts_are_not_muted(page, want):
    assert hw.main_text(page) == want


def test_texts_of_single_pages_stay(spark):
    page = "<body><h1>T{0}</h1><p>a{0}</p><p>b{0}</p>{1}<h4>Our paper</h4></body>"
    own = {2: "<blockquote>own text</blockquote>", 4: "<pre>mine</pre><h3>alone</h3>", 5: "<pre>mine</pre>"}
    df = spark.createDataFrame([(k, "//h/", page.format(k, own.get(k, ""))) for k in range(6)], "page_id long, url string, html string")
    out = {r.row.page_id: r.text.split("\n") for r in hw.extract(df).collect()}
    more = {2: ["own text"], 4: ["mine", "alone"], 5: ["mine"]}
    assert out == {k: [f"T{k}", f"a{k}", f"b{k}", *more.get(k, [])] for k in range(6)}


def test_large_pages_and_hosts_keep_their_template(spark):
    rnd = random.Random(5)

    def mixed(n):
        return "".join(rnd.choice(["<p>{0}</p>", "<p><b>{0}</b></p>", "<ul><li>{0}</li></ul>", "<p><i>{0}</i>x</p>"]).format(rnd.random()) for _ in range(n))

    def layout(k):
        return "".join(f"<x{k}-{i}><b>{rnd.random()}</b></x{k}-{i}>" for i in range(60))

    page = "<body><h6>Home</h6><h4>Our paper</h4><div><h1>T{0}</h1>{1}</div><h5>All rights kept</h5></body>"
    data = [(k, "//long/", page.format(k, mixed(1500 if k == 3 else 3))) for k in range(8)]
    data += [(100 + k, "//many/", page.format(100 + k, layout(k))) for k in range(24)]
    data += [(200 + k, "//all/", page.format(200 + k, mixed(1500))) for k in range(3)]
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    wrappers = {r.host: (r.pages, r.wrapper is None) for r in hw.host_wrappers(df).collect()}
    assert wrappers == {"long": (8, False), "many": (24, True), "all": (3, True)}
    out = {r.row.page_id: r.text.split("\n") for r in hw.extract(df).collect()}
    assert len(out) == 35
    for k, lines in out.items():
        assert f"T{k}" in lines and len(lines) > 1 and not {"Home", "Our paper", "All rights kept"} & set(lines)


def test_long_lists_are_compared_whole(monkeypatch):
    """Cut at equal ends and single spans, the opcodes rebuild both lists and find what is common."""
    import random

    rng = random.Random(4)
    for n in (0, 3, 40, 300):
        a = [rng.choice("abcdefgh") + str(rng.randrange(n + 1) if rng.random() < 0.3 else "") for _ in range(n)]
        b = [x for x in a if rng.random() < 0.9]
        b[n // 2 : n // 2] = ["new", "b", "a"]
        with monkeypatch.context() as m:
            m.setattr(hw, "MOST_ITEMS", -1)
            codes = hw._opcodes(a, b)
        assert [x for _, i, j, _, _ in codes for x in a[i:j]] == a and [x for *_, s, e in codes for x in b[s:e]] == b
        assert all((a[i:j] == b[s:e]) == (op == "equal") for op, i, j, s, e in codes)
        assert sum(j - i for op, i, j, _, _ in codes if op == "equal") >= 0.8 * (len(b) - 3)


def test_longest_common_subsequence():
    import random

    import numpy as np

    rng = random.Random(1)
    for _ in range(100):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(20))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = hw._longest_common(np.array(a, int), np.array(b, int))
        assert len(got) == best[-1][-1] and all(a[i] == b[j] for i, j in got)
        assert all(x < u and y < v for (x, y), (u, v) in zip(got, got[1:], strict=False))


def test_pages_of_any_size_are_aligned(spark):
    """Pages of more than MOST_ITEMS items have slots and constants like others, in a wrapper of all pages."""
    part = "<{0} class=c{1}>{2}</{0}>"
    names = ["".join(chr(97 + int(d)) for d in f"{k:04d}") for k in range(1300)]
    pages = ["<body><p>Same line</p>" + "".join(part.format("div" if k % 2 else "section", x, f"t{k} {n}" if k % 3 else f"always {k}") for k, x in enumerate(names)) for n in range(4)]
    assert min(hw._size(hw.page_expression(p)) for p in pages) > hw.MOST_ITEMS
    rows = [(n, "//h/", p) for n, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    got = hw.host_wrappers(df).collect()
    assert [(r.host, r.pages) for r in got] == [("h", 4)]
    wrapper = hw._load(got[0].wrapper)
    assert hw.slots(wrapper) == sum(k % 3 > 0 for k in range(1300))
    assert set(hw.constants(wrapper)) == {hw.fingerprint(x) for x in ["Same line", *(f"always {k}" for k in range(0, 1300, 3))]}
    out = hw.extract(df).collect()
    assert all(r.text.split("\n") == [f"t{k} {r.row.page_id}" for k in range(1300) if k % 3] for r in out)


def test_layouts_that_share_nothing_are_kept(monkeypatch):
    """What outgrows the limit is a wrapper of its own, not none; all pages are counted."""
    monkeypatch.setattr(hw, "MOST_ITEMS", 5)
    one, two = ('["<p>", ["#", "x"], "</p>"]', '["<ul>", "<li>", ["#", "y"], "</li>", "</ul>"]')
    assert hw._merge(one, two) is None
    assert hw._merge(one, '["<p>", ["#", "z"], "</p>"]') == '["<p>", ["#", null], "</p>"]'


def test_layouts_share_a_template(spark):
    """Three pages of nothing in common but a line: three layouts, one template; own texts stay."""
    names = lambda k: "".join(f"<x{k}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + i // 676)}>own {k} {i}</x{k}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + i // 676)}>" for i in range(1100))
    rows = [(k, "//h/", f"<body><h6>Home</h6>{names(k)}</body>") for k in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert [(r.pages, r.wrapper) for r in hw.host_wrappers(df).collect()] == [(3, None)]
    for r in hw.extract(df).collect():
        assert "Home" not in r.text and all(f"own {r.row.page_id} {i}" in r.text for i in (0, 500, 1099))
