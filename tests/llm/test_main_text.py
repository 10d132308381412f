"""The page model against enumeration, its reader, held-out layouts and defined cases."""

import itertools

import numpy as np
import pytest

SCHEMA = "page_id long, url string, html string, text string, n_chars long"


@pytest.fixture(scope="module")
def model():
    from panelcast.llm.main_text import fit
    from panelcast.llm.page_layouts import labelled_pages
    return fit(labelled_pages(600))


def small_forest():
    from panelcast.llm.main_text import Forest
    return Forest(["<body><nav><ul><li>a<li>b</ul></nav><p>one two three, four.", "<div>x<p>y</div>"])


def scores(forest, seed=3):
    from panelcast.llm.main_text import N_EDGES
    r = np.random.default_rng(seed)
    return r.normal(size=len(forest.text)), r.normal(size=(N_EDGES, 2, 2))


def test_messages_against_all_labellings():
    from panelcast.llm.main_text import _partition, messages
    f = small_forest()
    unary, edges = scores(f)
    n = len(unary)
    total, node, joint = 0.0, np.zeros(n), np.zeros((n, 2, 2))
    for y in itertools.product((0, 1), repeat=n):
        s = sum(unary[i] * y[i] for i in range(n)) + sum(edges[f.edge[i], y[f.parent[i]], y[i]] for i in range(n) if f.parent[i] >= 0)
        total += np.exp(s)
        node += np.exp(s) * np.array(y)
        for i in range(n):
            if f.parent[i] >= 0:
                joint[i, y[f.parent[i]], y[i]] += np.exp(s)
    p, j = messages(f, unary, edges, pairs=True)
    assert np.allclose(p, node / total) and np.allclose(j, joint / total)
    assert np.isclose(_partition(f, unary, edges), np.log(total))


def test_gradients_against_differences():
    from panelcast.llm.main_text import Forest, N_FEATURES, likelihood
    from panelcast.llm.page_layouts import labelled_pages
    f = Forest(labelled_pages(2, seed=5))
    y = f.labels()
    r = np.random.default_rng(1)
    w, (_, edges) = r.normal(size=N_FEATURES) * .3, scores(f)
    _, gw, ge = likelihood(f, y, w, edges)
    h = 1e-5
    for k in [*np.flatnonzero(np.bincount(f.cols))[:12]]:
        d = np.zeros_like(w)
        d[k] = h
        assert np.isclose((likelihood(f, y, w + d, edges)[0] - likelihood(f, y, w - d, edges)[0]) / (2 * h), gw[k], atol=1e-4)
    for k in ((0, 1, 1), (0, 0, 1), (int(f.edge[3]), 1, 0)):
        d = np.zeros_like(edges)
        d[k] = h
        assert np.isclose((likelihood(f, y, w, edges + d)[0] - likelihood(f, y, w, edges - d)[0]) / (2 * h), ge[k], atol=1e-4)


def test_reader():
    from panelcast.llm.dom import TEXT, Page

    def texts(s):
        p = Page(s)
        return [t for t, n in zip(p.text, p.name) if n == TEXT]

    assert texts('<p>a &amp b<br>c<p><b>d</p>e<script>var t="</p>";</script>f') == ["a & b c", "d", "ef"]
    assert texts('<div title="x > y">one<!-- <p>no --> two</div>three <unclosed') == ["one two", "three"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("1 < 2 &lt; 3 &#233;&nbsp;x") == ["1 < 2 < 3 é x"]
    assert texts("</div></p>a<style>p{}") == ["a"] and texts("") == []
    p = Page("<p>see <a href=x>this link</a> now")
    assert p.linked[-1] == 9
    assert len(texts("<div>" * 3000 + "deep" + "</div>" * 3000)) == 1


def test_held_out_layouts(model):
    from panelcast.llm.main_text import Forest, messages
    from panelcast.llm.page_layouts import labelled_pages
    f = Forest(labelled_pages(200, seed=9))
    y, (w, edges) = f.labels(), model
    p, _ = messages(f, np.bincount(f.rows, w[f.cols], minlength=len(y)), edges)
    right = ((p >= .5) == y)[f.is_text]
    assert right.mean() > .95 and max(y[f.is_text].mean(), 1 - y[f.is_text].mean()) < .75


def test_pages_by_hand(model):
    from panelcast.llm.main_text import extract
    page = ("<html><head><title>No</title></head><body><header><div class=logo>Site</div></header><div id='cookie-notice'><p>We use "
            "cookies, accept them?</p></div><div class='post-content'><h1>Title of it</h1><p>First paragraph of the story.</p>"
            "<div class='ad-slot'><p>Buy now, great offers!</p></div><p>Second &amp; last.</p></div><aside><p>Some teaser text.</p>"
            "</aside><section id='comments'><p>Nice article, thanks a lot.</p></section><footer>&copy; All rights</footer>")
    assert extract([page, ""], model) == ["Title of it\nFirst paragraph of the story.\nSecond & last.", ""]


def test_real_pages_have_their_article(spark):
    """Every page of the table: the blocks of its article element, and nothing else."""
    import html
    import re
    from panelcast.llm.queries import op13_main_text
    sf = "/root/testdata/sf0.001"
    got = {r.page_id: r for r in op13_main_text(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        inside = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("</?b>|<br>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
        want = "\n".join(b for b in blocks if b)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def test_defined_cases(spark):
    from panelcast.llm.main_text import main_text
    long_page = "<article><p>" + "many words here. " * 60_000 + "</article>"
    rows = [(None, None, None), (1, "u", ""), (2, "u", long_page), (2, "u", long_page), (3, None, "<article><p>Some text here, and more.")]
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], SCHEMA)
    got = sorted(((r.page_id or 0, r.url, len(r.text), r.n_chars) for r in main_text(df).collect()), key=str)
    n = len(("many words here. " * 60_000).strip())
    assert got == sorted([(0, None, 0, 0), (1, "u", 0, 0), (2, "u", n, n), (2, "u", n, n), (3, None, 25, 25)], key=str)
    assert main_text(df.limit(0)).count() == 0
