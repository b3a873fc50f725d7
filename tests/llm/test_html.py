import random

import pytest
from texts import prose

from tidewatch.llm import html as H


def text(page):
    return "\n".join(t for t in H.flatten(H.parse(page))[2] if t)


@pytest.mark.parametrize(
    "page,want",
    [
        ("", ""), ("plain &lt;text&gt; &#233;&nbsp; x", "plain <text> é x"), ("<p>a<b>b</b>c<br>d</p>\n<p> e\n\tf </p>", "abc d\ne f"),
        ("<ul><li>one<li>two</ul>tail", "one\ntwo\ntail"), ("<p>a<p title='x > y'>b<!-- <p>no --><script>'</p><p>'</script>c", "a\nbc"),
        ("<nav>m</nav><header>h</header><article><header><h1>T</h1></header><p>x</article><footer>f</footer>", "T\nx"),
        ("<main><p>in</p><div class='side-bar sidebar'>s</div></main><p>out", "in"), ("<div hidden>h</div><div style='display: none'>n</div>v", "v"),
        ("<body class='page comments-open'><p>kept</p><section id=comments><p>gone</section>", "kept"),
        ("<article><p>a</p><aside>b</aside><form>c<input value='d'></form><div class='ad'>e</div><p>f", "a\nf"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("<p>unclosed <b>bold <br><p>next", "unclosed bold\nnext"), ("a < b & c > d", "a < b & c > d"),
        ("<style>p{}</style><title>t</title><textarea>x</textarea>y", "y"), ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("<p>1</p></p></div>2", "1\n2"),
    ],
)
def test_content_of_one_page(page, want):
    assert text(page) == want


def tree(page):
    return H.Tree(H.pack_tree(*H.flatten(H.parse(page))))


def test_simple_tree_matching():
    a, b = tree("<div><p>1<h2>2</h2><p>3</div>"), tree("<div><h2>2</h2><p>4<p>5</div>")
    assert H.match(a, b)[0] == 4 and H.match(a, a)[0] == len(a.labels)
    nested = tree("<div><div><p>x<p>y</div><div><p>z</div></div>"), tree("<div><div><p>z</div></div>")
    size, pairs = H.match(*nested)
    assert size == 4 and len({x for x, _ in pairs}) == len({y for _, y in pairs}) == 4


def page(body, k):
    return f"<html><body><div class=top>Our Site</div><div><p>{body}</p><p>More by our staff</p></div><p>All rights {k % 2}</p></body></html>"


def test_constant_nodes_of_a_host_are_template(spark):
    rows = [(k, f"https://A.example.org/{k}", page(prose(k, 60), k)) for k in range(12)]
    rows += [(100, "https://b.example.org/", page("alone", 0)), (101, None, page("no host", 0)), (102, "odd", None)]
    rows += [(200 + k, "http://c.example.org/x", page("copy", 0)) for k in range(9)]  # copies are one page
    near = prose(5, 200)
    rows += [(300 + k, "http://d.example.org/x", page(near + f" {k}", 0)) for k in range(9)]
    got = {r["page_id"]: r for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    for k in range(12):
        assert got[k]["text"] == f"{prose(k, 60)}\nAll rights {k % 2}"
    assert got[100]["text"] == "Our Site\nalone\nMore by our staff\nAll rights 0" and got[101]["text"].startswith("Our Site\nno host")
    assert (got[102]["text"], got[102]["n_chars"]) == ("", 0) and len(got) == len(rows)
    assert got[204]["text"].split("\n") == ["Our Site", "copy", "More by our staff", "All rights 0"]
    assert all(near in got[300 + k]["text"] for k in range(9))
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_edges(spark):
    schema = "page_id long, url string, html string, tree string, host string, blocks string, id string"
    rows = [(1, "u://h/1", "<p>x", *"abcd"), (1, "u://h/1", "<p>x", *"abcd"), (None, None, None, *"abcd"), (2, "", "<p>" + "word " * 200_000, *"abcd")]
    df = spark.createDataFrame(rows, schema)
    got = H.extract(df).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 1, 1, 999_999] and H.extract(df.limit(0)).collect() == []


def test_pages_of_the_table(spark, sf):
    """The article of every page: its heading and paragraphs."""
    import html
    import re

    got = {r["page_id"]: r["text"] for r in H.extract(spark.read.parquet(f"{sf}/pages.parquet")).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        body = re.search("<article>(.*)</article>", r["html"], re.S)[1].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body))
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


def test_names_of_one_page_are_whole_and_spare_articles():
    assert text("<div class='has-sidebar menu-open'><article class='post tag-search promo'><p>a</article></div>") == "a"
    assert text("<form id=page><header>h</header><div class=menu>m</div><section><p>b</section></form>") == "b"
    assert text("<div class=widget><article>c</article></div><section id=comments><article class=comment>d</article></section>") == "c"
    long = prose(1, 40)
    assert text(f"<div><p>{long}</div><article>teaser</article>") == f"{long}\nteaser"


def test_votes_decide_before_names(spark):
    """The main text stands in a plain element, beside teasers in articles; the menu has no name that is known."""

    def page(k):
        teasers = "".join(f"<article><p>Teaser {j}</article>" for j in range(2))
        return (f"<body class='postid-{k}'><div class=strip><p>Home<p>News</div><div class='text has-sidebar'><p>{prose(k, 60)}</div>"
                f"{teasers}<div class='related'><p>see {k}</div></body>")  # fmt: skip

    rows = [(k, f"http://e.example.org/{k}", page(k)) for k in range(8)]
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {k: prose(k, 60) for k in range(8)}


def test_open_ends_do_not_cut_a_page():
    assert text("<p>a<svg class='icon'/>b</p><svg><text>no</text></svg><p>c") == "ab\nc"
    assert text("<p>a<svg class=x>b<p>c") == "ab\nc" and text("<noscript><p>d<template><p>e") == "d\ne"
    assert text("<p>f<noscript>no</noscript>g<script>no") == "fg"


def test_template_of_short_articles_and_of_each_layout(spark):
    """Unmarked menus outweigh the articles, and pages have two layouts, of which an odd page comes first."""
    menu = "<div class=strip>" + "".join(f"<p>{prose(900 + j, 30)}" for j in range(5)) + "</div>"
    one = lambda k: f"<body>{menu}<div><p>{prose(k, 12)}</div></body>"
    two = lambda k: f"<body><table><tr><td>Archive<td>{prose(k, 12)}</table>{menu}</body>"
    rows = [(k, "http://s.example.org/", one(k)) for k in range(8)] + [(20 + k, "http://s.example.org/", two(20 + k)) for k in range(8)]
    rows += [(-1, "http://s.example.org/", "<body><h2>Not found</h2></body>")]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{k: prose(k, 12) for k in [*range(8), *range(20, 28)]}, -1: "Not found"}


def plain_matching(a, b, x=0, y=0):
    """Simple tree matching as it is stated, size alone."""
    if a.labels[x] != b.labels[y]:
        return 0
    m, n = a.children[x], b.children[y]
    table = [[0] * (len(n) + 1) for _ in range(len(m) + 1)]
    for i, p in enumerate(m, 1):
        for j, q in enumerate(n, 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + plain_matching(a, b, p, q))
    return 1 + table[-1][-1]


def random_tree(draw, n, labels):
    """Nodes are added to the last ones' parents, so that children come in order of the page."""
    parents, path = [-1], [0]
    for node in range(1, n):
        path = path[: draw.randint(1, len(path))]
        parents.append(path[-1])
        path.append(node)
    return H.Tree(H.pack_tree(parents, ["r", *(draw.choice(labels) for _ in range(n - 1))], [""] * n))


@pytest.mark.parametrize("table", [1, H.TABLE])
def test_matchings_are_as_large_as_plain_ones(monkeypatch, table):
    monkeypatch.setattr(H, "TABLE", table)
    draw = random.Random(4)
    for _ in range(400):
        labels = draw.choice(["a", "ab", "abc"])
        a, b = random_tree(draw, draw.randint(1, 14), labels), random_tree(draw, draw.randint(1, 14), labels)
        size, pairs = H.match(a, b)
        assert size == plain_matching(a, b) == len(pairs) == len({x for x, _ in pairs}) == len({y for _, y in pairs})
        found, up_a, up_b = dict(pairs), parents_of(a), parents_of(b)
        assert all(a.labels[x] == b.labels[y] and (x == 0 or found[up_a[x]] == up_b[y]) for x, y in pairs)
        assert all(found[x] < found[z] for x in found for z in found if 0 < x < z and up_a[x] == up_a[z])


def parents_of(tree):
    return {k: node for node, kids in enumerate(tree.children) for k in kids}


def flat(root, labels):
    return H.Tree(H.pack_tree([-1, *[0] * len(labels)], [root, *labels], [""] * (len(labels) + 1)))


def test_deep_and_long_trees_are_matched_in_seconds():
    draw = random.Random(6)
    deep = [H.Tree(H.pack_tree(list(range(-1, n - 1)), ["d"] * (n - 1) + [last], [""] * n)) for n, last in ((5_000, "p"), (5_000, "q"), (4_000, "p"))]
    assert H.match(deep[0], deep[1])[0] == 4_999 and H.match(deep[0], deep[2])[0] == 3_999
    rows = [-1, *(p for k in range(20_000) for p in (0, 1 + 3 * k, 1 + 3 * k))]
    labels = ["table", *["tr", "td", "td"] * 20_000]
    table = H.Tree(H.pack_tree(rows, labels, [""] * len(rows)))
    other = labels.copy()
    other[30_002], other[50_003] = "th", "th"
    assert H.match(table, H.Tree(H.pack_tree(rows, other, [""] * len(rows))))[0] == len(rows) - 2
    mixed = [flat("div", [draw.choice("pqr") for _ in range(n)]) for n in (20_000, 20_000)]
    size, pairs = H.match(*mixed)
    assert 12_000 < size == len(pairs) < 18_000


def test_a_deep_page_does_not_end_the_job(spark):
    depth = 2_000
    pages = [(k, f"http://h/{k}", page(prose(k, 40), k)) for k in range(6)]
    pages.append((7, "http://h/deep", "<div>" * depth + "<p>far down</p>" + "</div>" * depth))
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert len(got) == 7 and "far down" in got[7]
