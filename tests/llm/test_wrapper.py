"""Main text of hand-made pages, template nodes and tree matching."""

from hypothesis import given, settings
from hypothesis import strategies as st

from loadwright.llm import op4_wrapper as w


def texts(html):
    return [t for _, t in w.Page(html).content()]


def test_article_without_the_rest():
    html = """<body><header class="site-header"><h1>Site</h1></header><div class="cookie-notice">We use cookies</div>
    <nav><a href=x>Menu</a></nav><main><article><h1>Title &amp; more</h1><p>One <b>bold</b>\n word.<br>Next&nbsp;line
    <p>Two<script>var a = "<p>no</p>";</script></p><form><p>Your mail</p><input></form><div class="ad-box">Buy</div>
    <section id="comments"><p>First!</p></section><ul><li>item</li><li>second</ul></article></main>
    <aside>Side</aside><div class="related-posts">More</div><footer>&copy;</footer></body>"""
    assert texts(html) == ["Title & more", "One bold word.", "Next line", "Two", "item", "second"]


def test_without_article_links_go():
    html = "<div><a href=1>One</a> <a href=2>Two</a></div><p>Real text with <a href=3>a link</a> in it.</p><!-- <p>no</p> -->"
    assert texts(html) == ["Real text with a link in it."]


def test_attribute_values_are_no_attributes():
    for attr in ('style="overflow:hidden"', 'title="hidden gems"', 'data-hidden="false"', "alt='a class=ad here'"):
        assert texts(f"<article {attr}><p>Kept text</p></article>") == ["Kept text"]
    for attr in ("hidden", 'class="x" hidden=""', "aria-hidden='true'"):
        assert texts(f"<div {attr}><p>Gone</p></div><p>Kept text</p>") == ["Kept text"]


def test_names_around_or_in_an_article():
    article = "<article><h1>Title</h1><p>The text of this page is here.</p></article>"
    more = "<div class='comments'><p>" + "a long comment " * 40 + "</p></div>"
    for name in ('class="layout has-sidebar"', 'id="content-with-ad"', 'class="page-widget"', 'class="share"'):
        assert texts(f"<div {name}>{article}</div>{more}") == ["Title", "The text of this page is here."]
    assert texts(f"<form action=x><div>Login</div>{article}</form>") == ["Title", "The text of this page is here."]
    assert texts("<div class='widget-text'><p>All of a page's text.</p></div>") == ["All of a page's text."]
    inside = "<article><p>One</p><section id='discussion'><p>Two</p></section><h2 id='related-work'>Three</h2><div class='ad'>No</div></article>"
    assert texts(inside) == ["One", "Two", "Three"]


def test_names_that_mean_the_text_itself():
    inside = """<article><p class="social">A social text.</p><div class="share price"><p>Shares fell by a tenth.</p></div>
    <div class="share"><a href=1>Post</a> <a href=2>Send</a></div><div class="cookie-notice">We use cookies</div>
    <p class="comment">First!</p><blockquote class="notice">Notice this.</blockquote></article>"""
    assert texts(inside) == ["A social text.", "Shares fell by a tenth.", "Notice this."]


def test_controls_end_with_their_parent_or_block():
    article = "<article><h1>Title</h1><p>The text.</p></article>"
    assert texts("<datalist><option value=a><option value=b></datalist>" + article) == ["Title", "The text."]
    assert texts("<select><option>a<option>b</select>" + article) == ["Title", "The text."]
    for tag in ("button", "label", "option", "select", "svg"):
        assert texts(f"<div><{tag}>Press</div>{article}") == ["Title", "The text."], tag
        assert texts(f"<div><{tag}>Press {article}<div><{tag}>x</{tag}></div>") == ["Title", "The text."], tag
    assert texts("<p>One <label>Name: <input></label>two <button>Go</button>three</p>") == ["One two three"]
    assert texts("<div><button><div>Menu</div><p>more</p></button>Text</div><p>More text</p>") == ["Text", "More text"]
    assert texts("<title>never closed<article><p>Text</p></article>") == ["Text"]


def test_quotes():
    assert texts("<p title=it's>One</p><p title='a > b'>Two</p><p data-x=\"a>Three</p>") == ["One", "Two", "Three"]
    assert texts('<p class="x>One</p><p>Two</p>') == ["One", "Two"]


def test_hostile_pages_take_linear_time():
    import time

    for html in (
        "<p a='x\" b=\"y>" * 70_000, "<p a=\"x>" * 120_000, "<button>" * 100_000, "<label><p>" * 100_000,
        "<p " + "a " * 400_000, "<!--" * 200_000, "<title>" * 100_000, "<a b='" * 100_000, "<div =\"" * 100_000,
    ):
        start = time.process_time()
        w.Page(html)
        assert time.process_time() - start < 4, html[:20]


def test_alignment_of_wide_trees_is_fast():
    import time

    one = "(#" + "(a)(b)" * 2500 + ")"
    two = "(#(c)" + "(b)(a)" * 2500 + "(c))"
    three = "(#" + "".join(f"(a(x{i}))" for i in range(3000)) + ")"
    four = "(#" + "".join(f"(a(y{i}))" for i in range(3000)) + ")"
    start = time.process_time()
    assert sum(j >= 0 for j in w.align(one, two)) >= 4500
    assert sum(j >= 0 for j in w.align(three, four)) >= 2900
    assert time.process_time() - start < 8


def test_alignment_does_not_depend_on_size(monkeypatch):
    import random

    # The longest common subsequence of ab.. and ba.. of 2,500 each has 4,999 nodes; the root is one more.
    one, two = "(#" + "(a)(b)" * 2500 + ")", "(#(c)" + "(b)(a)" * 2500 + "(c))"
    assert sum(j >= 0 for j in w.align(one, two)) == 5000
    # 800 children that all differ, each with its best partner at another place.
    three = "(#(z)" + "".join(f"(a(x{i})(y{i}))" for i in range(800)) + ")"
    four = "(#" + "".join(f"(a(y{i})(x{i})(w))" for i in range(-5, 795)) + ")"
    assert sum(j >= 0 for j in w.align(three, four)) == 1 + 2 * 795
    rng = random.Random(2)

    def tree(depth):
        return f"({rng.choice('abc')}{''.join(tree(depth - 1) for _ in range(rng.randint(0, 4 if depth else 0)))})"

    pairs = [(f"(#{tree(4)}{tree(4)})", f"(#{tree(4)}{tree(4)})") for _ in range(60)]
    whole = [w.align(x, y) for x, y in pairs]
    for cells in (0, 7, 50):
        monkeypatch.setattr(w, "CELLS", cells)
        assert [w.align(x, y) for x, y in pairs] == whole


def test_broken_markup():
    assert texts("<p>cut off <b>here</b> and <a hre") == ["cut off here and"]
    assert texts("</div></p>text</span> a < b &lt; &am") == ["text a < b < &am"]
    assert texts("<div>" * 300 + "deep" + "</div>" * 300) == ["deep"]
    assert texts("<script>never closed <p>x") == [] and texts(None) == [] and texts("") == []


def test_folding_and_alignment():
    tree, number = w.Page("<ul><li>a<li>b<li>c</ul><p>x<p>y").folded()
    assert tree == "(#(ul(li))(p))" and number == [0, 1, 2, 2, 2, 3, 3]
    assert w.align("(#(ul(li))(p))", "(#(div)(ul(li))(h1)(p))") == [0, 2, 3, 5]
    assert w.align("(#(a))", "(b)") == [-1, -1]


@st.composite
def trees(draw, depth=3):
    kids = draw(st.lists(trees(depth=depth - 1), max_size=3)) if depth else []
    return f"({draw(st.sampled_from('abc'))}{''.join(kids)})"


@settings(max_examples=150, deadline=None)
@given(trees(), trees())
def test_matching_keeps_labels_parents_and_order(x, y):
    a, b, m = w.tree_of(x), w.tree_of(y), w.align(x, y)
    hit = [(i, j) for i, j in enumerate(m) if j >= 0]
    assert all(a[i][0] == b[j][0] for i, j in hit)
    assert [j for _, j in hit] == sorted(j for _, j in hit) and len({j for _, j in hit}) == len(hit)
    up = lambda t: {k: i for i, (_, ks) in enumerate(t) for k in ks}
    assert all(m[up(a)[i]] == up(b)[j] for i, j in hit if i)


def most_matches(a, b, i=0, j=0):
    """The most nodes an order-keeping matching of two trees can pair, by trying all."""
    if a[i][0] != b[j][0]:
        return 0

    def lists(x, y):
        if not x or not y:
            return 0
        return max(lists(x[1:], y), lists(x, y[1:]), most_matches(a, b, x[0], y[0]) + lists(x[1:], y[1:]))

    return 1 + lists(tuple(a[i][1]), tuple(b[j][1]))


@settings(max_examples=150, deadline=None)
@given(trees(depth=2), trees(depth=2))
def test_matching_is_the_largest(x, y):
    assert sum(j >= 0 for j in w.align(x, y)) == most_matches(w.tree_of(x), w.tree_of(y))


def test_template_of_a_host(spark, edge_dir):
    got = {(r["page_id"], r["url"]): r["text"] for r in w.op4_wrapper_text(spark, edge_dir).collect()}
    one = [t for (_, u), t in got.items() if u and "one.example" in u]
    assert len(one) == 12 and not any("Subscribe" in t for t in one) and all(t.count("\n") >= 1 for t in one)
    assert got[30, "https://same.example/"] == "Same\nAll pages of this host are alike."
    assert got[20, "https://two.example/a"] == "" and got[21, "https://two.example/b"] == ""
    assert got[22, None] == "No host & no article\nSecond"
    assert got[None, "https://two.example/c"] == "plain text"
    assert got[41, "https://cut.example/"] == "cut off here and"
    assert len(got[40, "https://big.example/"]) == len("Big\n") + len("lorem <ipsum> " * 20_000) - 1


def test_layouts_of_a_host_and_boxes_in_articles(spark):
    def body(k, i):
        return f"own words of page {k} {i} " * 3

    def one(i):
        teaser = f"<article><p>Teaser {i}</p></article>"
        return f"<body><div class=top>Welcome to this site</div><div class=text><p>{body('one', i)}</p></div><div class=box>{teaser}</div></body>"

    def two(i):
        note = "<div class=note>Only some pages say so</div>" if i % 2 else ""
        return f"<body><section><h1>Shop {i}</h1><p>{body('two', i)}</p>{note}</section><section class=end>Call the shop</section></body>"

    pages = [(i, f"https://h.example/{i}", one(i)) for i in range(12)] + [(100 + i, f"https://h.example/s{i}", two(i)) for i in range(10)]
    pages += [(200, "https://lone.example/", one(0))]
    rows = w.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    got = {r["page"]["page_id"]: r["text"] for r in rows}
    assert all(got[i] == f"{body('one', i).strip()}\nTeaser {i}" for i in range(12))
    assert all(got[100 + i] == f"Shop {i}\n{body('two', i).strip()}" for i in range(10))
    assert body("one", 0).strip() in got[200]


def test_mirrors_of_an_article_keep_it(spark):
    article = "<article><h1>News</h1><p>An article that many pages of this host show alike, of some length.</p></article>"
    full = "News\nAn article that many pages of this host show alike, of some length."
    top = "<div class=top>Welcome to this site</div>"
    rows = [(i, f"https://m.example/{i}", f"<body>{article}<p>Seen at 12:0{i}</p></body>") for i in range(10)]
    # A host with pages of its own, and mirrors among them: its template still goes.
    rows += [(100 + i, f"https://n.example/{i}", f"<body>{top}{article}</body>") for i in range(6)]
    rows += [(200 + i, f"https://n.example/o{i}", f"<body>{top}<article><h1>T{i}</h1><p>{f'text {i} ' * 9}</p></article></body>") for i in range(20)]
    out = w.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    got = {r["page"]["page_id"]: r["text"] for r in out}
    assert all(full in got[i] for i in range(10))
    assert all(got[100 + i] == full for i in range(6))
    assert all(got[200 + i] == f"T{i}\n{(f'text {i} ' * 9).strip()}" for i in range(20))
