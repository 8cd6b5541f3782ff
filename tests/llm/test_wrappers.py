"""Main text of pages: parsing, alignment of trees, extraction by host."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from obslayers.llm import wrappers as w

PAGE = (
    '<!DOCTYPE html><html lang="en"><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p>";</script></head>'
    '<body><nav><ul><li><a href="/x">x{n}</a></li><li>y</li></ul></nav><!-- ad {n} --><div class="ad">buy {n}</div>'
    "<article><h1>Title {n}</h1><p><b>First {n}<br><p>Second &lt;{n}&gt;\n  caf&eacute;</p>{more}<p>Share this page.</p></article>"
    '<div class="comments"><p>I disagree {n}</p></div><footer>&copy; host {n}</footer></body></html>'
)


LETTERS = "abcdefghijklmn"


def page(n, more=""):
    return PAGE.format(n=n, more=more)


def text(n, more=(), shared=True):
    return "\n".join([f"Title {n}", f"First {n}", f"Second <{n}> café", *more, *(["Share this page."] if shared else [])])


def test_page_alone():
    assert w.main_text(page(3)) == text(3)
    assert w.main_text(page(3, "<ul><li>one<li>two</ul><form>no</form><aside>no</aside>")) == text(3, ["one", "two"])


@pytest.mark.parametrize(
    "given, expected",
    [
        ("", ""),
        ("just text &amp; more", "just text & more"),
        ("<p>a<p>b", "a\nb"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"),
        ("<p>a <b>b</b>\n\tc&nbsp;d</p>", "a b c d"),
        ("</p></div>x<", "x<"),
        ("<script>var a = '<p>x</p>'", ""),
        ("<p title='a > b'>x</p><p title=\"unclosed>y</p>", "x\ny"),
        ("<body><header>h</header><main><p>m</p></main><aside>s</aside></body>", "m"),
        ("<article><header><h1>h</h1></header><p>p</p><nav>n</nav></article>", "h\np"),
        ("<div class='cookie-notice'>c</div><div id='sidebar'>s</div><p>p</p><p hidden>q</p>", "p"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<!-- never closed <p>a</p>", ""),
        ("a<p>b</p>c<!-- never <p>closed</p> d", "a\nb\nc"),
        ("a<p>b</p>c<!-- never closed", "a\nb\nc"),
        ("<p>a</p><!-- b > c --> d", "a\nd"),
        ("a<![CDATA[b <p>c</p> d", "ab <p>c</p> d"),
        ("<p>a<![CDATA[b", "ab"),
        ("<main><h2>t</h2><article><p>a</p></article><article><p>b</p></article></main>", "a\nb"),
    ],
)
def test_odd_markup(given, expected):
    assert w.main_text(given) == expected


def test_very_long_pages():
    for tag in ("div", "b", "main", "blockquote"):
        assert w.main_text(f"<{tag}>" * 20000 + "deep" + f"</{tag}>" * 20000) == "deep"
    wide = "<article>" + "".join(f"<p>p{i}</p>" for i in range(30000)) + "</article>"
    assert w.main_text(wide).count("\n") == 29999
    assert w.main_text("<p " * 50000) == " ".join(["<p"] * 50000)


def brute_match(a, b):
    """Most nodes of an order-keeping match, over all ways to pair the kids."""
    if a.label != b.label:
        return 0
    best = 0
    for n in range(min(len(a.kids), len(b.kids)) + 1):
        for p in itertools.combinations(range(len(a.kids)), n):
            for q in itertools.combinations(range(len(b.kids)), n):
                parts = [brute_match(a.kids[i], b.kids[j]) for i, j in zip(p, q)]
                if all(parts):
                    best = max(best, sum(parts))
    return 1 + best


def test_matching_equals_brute_force():
    markups = [
        "<div><p>a</p><ul><li>b</li></ul><p>c</p></div>",
        "<div><ul><li>b</li></ul><p>c</p><h2>x</h2></div><p>z</p>",
        "<p>a</p><div><h2>x</h2><p>d</p></div>",
        "<section><p>a</p></section>",
    ]
    markups += ["<div><h2>x</h2></div><div><p>a</p><ul><li>b</li></ul></div><div></div>", "<div></div><div><ul><li>c</li></ul></div>"]
    trees = [w.skeleton(w.parse(m)) for m in markups]
    for a, b in itertools.product(trees, trees):
        assert w.Matching(a, b).nodes(a, b) == brute_match(a, b)
        assert w.merged(a, b).pages == 2
        assert len(list(w.merged(a, b).walk())) == len(list(a.walk())) + len(list(b.walk())) - brute_match(a, b)


def test_trees_come_back_as_they_were_packed():
    tree = w.skeleton(w.parse("<div><p>a</p><ul><li>b</li></ul></div><div><div><h2>x</h2></div></div>"))
    again = w.Node.unpacked(tree.packed())
    assert again.packed() == tree.packed() and [n.label for n in again.walk()] == [n.label for n in tree.walk()]


def test_common_nodes_survive_rare_ones():
    """Every page has 40 nodes of its own; the tree stays small and keeps what all pages have."""
    def made(n):
        name = "".join(LETTERS[int(d)] for d in str(n))
        own = "".join(f"<section class='x{name}{a}{b}'>{n}</section>" for a in LETTERS[:5] for b in LETTERS[:8])
        shared = "<section class='shared'>the same</section>" if n % 2 else ""
        return w.skeleton(w.parse(f"<div>{own}{shared}<section class='all'>the same</section></div>"))

    tree = made(0)
    sizes = []
    for n in range(1, 400):
        tree = w.merged(tree, made(n))
        sizes.append(len(list(tree.walk())))
    assert max(sizes) < 40 * 60 and sizes[-1] < 40 * 40
    kept = {n.label: n for n in tree.walk()}
    assert kept["section all"].pages == 400 and kept["section shared"].pages + kept["section shared"].missed >= 200
    assert kept["section all"].text and sum(n.chars for n in tree.walk()) == sum(
        sum(k.chars for k in made(n).walk()) for n in range(400)
    )


def test_constant_slots_become_template(spark):
    rows = [(i, f"https://Example.org/{i}", page(i, f"<p>more {i}</p>" if i % 2 else "")) for i in range(40)]
    rows += [(100 + i, f"http://few.org/{i}", page(i)) for i in range(2)]
    rows += [(200, "no url", page(1)), (201, None, page(2)), (202, "https://example.org/n", None), (None, "https://example.org/0", page(0)), (0, "https://Example.org/0", page(0))]
    rows += [(300 + i, f"http://same.org/{i}", page(7)) for i in range(9)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string").repartition(6)
    got = w.extract_text(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_chars == len(r.text)
        if r.page_id == 202:
            assert r.text == ""
        elif r.page_id is None or r.page_id < 100:
            n = r.page_id or 0
            # The last paragraph is one run with the others here, and so no slot of its own.
            assert r.text == text(n, [f"more {n}"] if n % 2 else [])
        elif r.page_id >= 300:
            assert r.text == text(7)  # all is constant: nothing is taken
    assert w.extract_text(pages.limit(0)).count() == 0


def test_constant_block_is_left_out(spark):
    made = "<html><body><article><h1>T{n}</h1><p>text {n}</p><blockquote>Read more on this site.</blockquote></article></body></html>"
    pages = spark.createDataFrame([(i, f"http://a.org/{i}", made.format(n=i)) for i in range(12)], "page_id bigint, url string, html string")
    assert {r.text for r in w.extract_text(pages).collect()} == {f"T{i}\ntext {i}" for i in range(12)}


@pytest.mark.parametrize(
    "given, expected",
    [
        ("<main><h1>t</h1><p>story</p><section class='comments'><article class='comment'>c</article></section></main>", "t\nstory"),
        ("<main><h1>t</h1><p>story</p><article><p>part</p></article><p>end</p></main>", "t\nstory\npart\nend"),
        ("<main><div>loose text <article>a</article></div></main>", "loose text\na"),
        ("<main><section class='related'><article>r</article></section><article><p>a</p></article></main>", "a"),
        ("<body class='has-sidebar menu'><div class='comments'><article>c</article></div><p>story</p></body>", "story"),
        ("<main><h1>t</h1><article class='comment'>c</article></main>", "t"),
    ],
)
def test_main_keeps_its_own_text(given, expected):
    assert w.main_text(given) == expected


def texts_of(spark, htmls, parts=3):
    rows = [(i, f"http://a.org/{i}", h) for i, h in enumerate(htmls)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(parts)
    return [r.text for r in w.extract_text(pages).orderBy("page_id").collect()]


def test_near_copies_make_no_template(spark):
    made = "<article><h1>The same title</h1><p>{}</p><ul><li>a list</li></ul><table><tr><td>a cell</td></tr></table></article>"
    got = texts_of(spark, [made.format(f"para {n} differs") for n in range(6)])
    assert got == [f"The same title\npara {n} differs\na list\na cell" for n in range(6)]
    # Neither do copies beside other articles.
    other = "<article><h1>Title {0}</h1><p>other {0}</p></article>"
    got = texts_of(spark, [made.format(n) for n in range(8)] + [other.format(n) for n in range(6)])
    assert got == [f"The same title\n{n}\na list\na cell" for n in range(8)] + [f"Title {n}\nother {n}" for n in range(6)]


def test_large_layouts(spark):
    common = "".join(f"<section class='{a}{b[0]}{b[1]}'><span>fixed {a}{b}</span></section>" for a in LETTERS for b in itertools.product(LETTERS, LETTERS))
    got = texts_of(spark, [f"<body>{common}<div><h1>t {n}</h1><p>story {n} {'word ' * 9}</p></div></body>" for n in range(6)])
    assert got == [f"t {n}\nstory {n} {'word ' * 9}".strip() for n in range(6)]


def test_deep_pages_of_a_host(spark):
    got = texts_of(spark, ["<div>" * 5000 + f"deep {n}" for n in range(6)])
    assert got == [f"deep {n}" for n in range(6)]


LAYOUT = (
    "<body><div><ul><li>home {n}</li><li>news</li></ul></div><div><div><h1>Title {n}</h1></div><div>"
    "<p>Story {n} goes on and on, with words of its own.</p><p>It has more to say than any part around it, on page {n} too.</p><h2>Part {n}</h2><p>More of story {n}.</p></div>"
    "<div>Read more on this site.</div></div><div><p>Buy {n} now</p></div><div>(c) host {n}</div></body>"
)


def test_slot_is_found_without_names(spark):
    assert w.main_text(LAYOUT.format(n=1)).startswith("home 1")  # alone, the page has no article
    got = texts_of(spark, [LAYOUT.format(n=n) for n in range(7)])
    want = "Title {0}\nStory {0} goes on and on, with words of its own.\nIt has more to say than any part around it, on page {0} too.\nPart {0}\nMore of story {0}."
    assert got == [want.format(n) for n in range(7)]


def test_short_articles_beside_varying_parts_get_no_slot(spark):
    """Below ``MOST_TEXT`` of the varying text (77 % here) no container is the slot, and nothing of the article goes."""
    short = LAYOUT.replace("<p>It has more to say than any part around it, on page {n} too.</p>", "")
    want = (
        "home {0}\nnews\nTitle {0}\nStory {0} goes on and on, with words of its own.\n"
        "Part {0}\nMore of story {0}.\nBuy {0} now\n(c) host {0}"
    )
    assert texts_of(spark, [short.format(n=n) for n in range(7)]) == [want.format(n) for n in range(7)]


def test_partitions_change_nothing(spark):
    htmls = [LAYOUT.format(n=n) if n % 3 else page(n) for n in range(60)]
    assert texts_of(spark, htmls, 1) == texts_of(spark, htmls, 40)


def test_whole_hosts_against_their_articles(spark):
    """The table's pages with all tag names, classes, ids and roles of regions taken away, and as they are.

    The expected text is cut out of the page by its article tags; without them only the wrapper can find it.
    """
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    as_given = {r.page_id: r.text for r in w.extract_text(table).collect()}
    rows = table.withColumn("host", w.host_of(F.col("url"))).collect()
    inside = re.compile(r"<article[^>]*>(.*?)</article>", re.S)
    named = re.compile(r"<(/?)(?:article|nav|footer|header|aside|main|section)\b[^>]*>")
    blind = [(r.page_id, r.url, re.sub(r"<(/?)div\b[^>]*>", r"<\1div>", named.sub(r"<\1div>", r.html or ""))) for r in rows]
    found = {r.page_id: r.text for r in w.extract_text(spark.createDataFrame(blind, "page_id bigint, url string, html string")).collect()}
    articles, right, large = {}, 0, 0
    for r in rows:
        if (m := inside.search(r.html or "")) and len(inside.findall(r.html)) == 1:
            want = w.main_text(f"<article>{m[1]}</article>")
            articles.setdefault(r.host, {})[r.page_id] = want
            assert as_given[r.page_id] == want
    for of_host in articles.values():
        if len({t.split("\n")[0] for t in of_host.values()}) >= w.LEAST_PAGES:
            large += len(of_host)
            right += sum(found[i] == t for i, t in of_host.items())
    assert large > 50 and right >= 0.95 * large
