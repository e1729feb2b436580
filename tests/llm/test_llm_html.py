"""Main text of pages: parsing, entropies and whole tables."""

from __future__ import annotations

import html
import math
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import site_trees
from tidemark.llm.page_tree import MAIN, NEUTRAL, NOISE, Page
from tidemark.llm.plans import QUERIES
from tidemark.llm.site_trees import kept_blocks, main_texts, site_of
from tidemark.sources.tables import table

ALL = lambda key: (1.0, 1.0)
NONE = lambda key: (0.0, 0.0)


def blocks(source):
    page = Page(source, "s")
    return [(page.nodes[b.node].tag, page.nodes[b.node].state, b.text) for b in page.blocks]


def texts(source, importance=ALL):
    return kept_blocks(Page(source, "s"), importance)


@pytest.fixture(scope="module")
def pages_of(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
        names = ("node", "n", "kind", "text", "n_chars", "row", "tree", "content")
        return df.withColumns({name: F.lit(name) for name in names})

    return make


def test_given_pages(spark):
    """The tables' pages are regular enough to be cut by patterns."""
    folder = "/root/testdata/sf0.01"
    rows = table(spark, folder, "pages").collect()
    expected = {}
    for row in rows:
        article = re.search(r"<article>(.*)</article>", row["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        parts = [html.unescape(re.sub(r"</?b>", "", p)) for p in parts]
        expected[row["page_id"]] = "\n\n".join(" ".join(p.split()) for p in parts if p.strip())
    out = QUERIES["op13_html"](spark, folder)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert {r["page_id"]: r["text"] for r in got} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in got) and len(got) == len(rows)


def test_blocks_and_implied_ends():
    source = "<p>a<b>b</i> c<br>d<p>e&nbsp;&amp;amp;&lt;p&gt;<ul><li>1<li>2<ul><li>x</ul><li>3</ul>f"
    assert [x[2] for x in blocks(source)] == ["ab c d", "e &amp;<p>", "1", "2", "x", "3", "f"]
    cells = "<table><tr><td>x<td>y<tr><th>z</table><dl><dt>t<dd>d<dt>u</dl><h2>h</h3>i<hr>j"
    assert [x[2] for x in blocks(cells)] == list("xyztduhij")
    assert blocks("a<!-- <p>no --> b<!x><?y?> c<!-- open <p>no")[0][2] == "a b c"
    assert texts("<script>if (a</b) '</p>'</script>a<style>p{}</STYLE >b<title>t</title>c") == ["abc"]
    assert texts("a<script>never closed <p>b") == ["a"]
    assert texts("1 < 2 and <3 &copy; &bogus; &#x41;&#66") == ["1 < 2 and <3 © &bogus; AB"]
    assert texts('<p title="a > b" class=\'c\'>x<p class="open>y</p>z') == ["x", "y", "z"]


@pytest.mark.parametrize(
    "noise",
    [
        "<nav>N</nav>", "<header><h1>N</h1></header>", "<footer>N</footer>", "<aside>N</aside>",
        "<form>N<input><button>N</button></form>", "<div class='ad'>N</div>",
        "<div id='cookie-notice'><p>N</p></div>", "<section class='comments'><p>N<p>N</section>",
        "<div role='navigation'>N</div>", "<p hidden>N</p>", "<div style='display: none'>N</div>",
        "<ul class='siteMenu'><li>N</ul>", "<noscript>N</noscript>", "<select><option>N</select>",
        "<article class='comment'>N</article>", "<div class='newsletter-signup'>N</div>", "<dialog open>N</dialog>",
    ],
)
def test_roles_that_go(noise):
    page = f"<body>{noise}<article><h1>T</h1><p>a b</p>{{}}<p>c</p></article>{noise}rest</body>"
    for inside in ("", noise if "header" not in noise else ""):
        assert texts(page.replace("{}", inside), NONE) == ["T", "a b", "c"]
    assert texts(f"<div>{noise}<p>a b</p></div>") == ["a b"]


def test_names_on_what_surrounds_the_main_text():
    source = "<div class='widget menu'><div class='has-sidebar'><main><header><h1>T</h1></header><p>a"
    assert texts(source + "</main></div></div>", NONE) == ["T", "a"]
    assert texts("<div class='col with-sidebar'><p>a</div>") == ["a"]
    assert [s for _, s, _ in blocks("<article>a<footer>b</footer>c</article>d")] == [
        MAIN, NOISE, MAIN, NEUTRAL,
    ]


def test_links_weigh_nothing():
    assert texts("<ul><li><a href=x>m</a><li><a href=y>n</a></ul><p>see <a href=z>this</a> text") == [
        "see this text"
    ]
    assert texts("<p><a href=x>all</a></p>") == []


def site(n, share):
    """Pages without marks: the same box and varying text, and two pages that are copies."""
    rows = []
    for k in range(n):
        body = " ".join(f"w{k}x{j} of the" for j in range(20))
        box = "Join our club today and save on every order you place"
        rows.append((k, "https://A.example/x" if share else None,
                     f"<div class=c{k}><p>{body}</p></div><div class=box><p>{box}</p></div>"))
    rows.append((n, rows[0][1], rows[0][2]))
    return rows


@pytest.mark.parametrize("shipped", [10**6, 0])
@pytest.mark.parametrize("share", [True, False])
def test_repeated_branches_go(pages_of, shipped, share):
    rows = site(12, share) + [(99, "http://b.example/", "<p>Join our club today</p>"),
                              (None, None, None), (98, "", ""), (98, "", "")]
    got = main_texts(pages_of(rows), most_shipped=shipped).collect()
    found = defaultdict(list)
    for row in got:
        found[row["page_id"]].append(row["text"])
    for k in range(13):
        assert found[k] == [" ".join(f"w{k % 12}x{j} of the" for j in range(20))]
    assert found[99] == ["Join our club today"], "one page says nothing of its site"
    assert found[None] == [""] and found[98] == ["", ""]


def test_a_site_of_copies_keeps_its_text(pages_of):
    same = "<nav>n</nav><div><p>All pages say this</p></div><footer>f</footer>"
    got = main_texts(pages_of([(k, "http://x/", same) for k in range(5)])).collect()
    assert {r["text"] for r in got} == {"All pages say this"}


def plain_tree(rows):
    """Entropies from their definition."""
    pages = [Page(h, site_of(u)) for _, u, h in rows]
    words, forms, n_pages = defaultdict(dict), defaultdict(Counter), Counter()
    for number, page in enumerate(pages):
        for b in page.blocks:
            for w in b.text.split():
                counts = words[page.nodes[b.node].key].setdefault(w, Counter())
                counts[number] += 1
        for node in page.nodes:
            if node.children:
                forms[node.key][tuple(node.children)] += 1
        n_pages.update({node.key for node in page.nodes if node.children})

    def entropy(counts, base):
        total = sum(counts)
        return -sum(c / total * math.log(c / total) for c in counts) / math.log(base)

    out = {}
    for key, m in n_pages.items():
        seen = sum(forms[key].values())
        content = presentation = 1.0
        if m > 1:
            held = [entropy(c.values(), m) for c in words[key].values()]
            content = 1 - sum(held) / len(held) if held else 0.0
            presentation = (1 - 0.9 ** len(forms[key])) * entropy(forms[key].values(), seen)
        elif not words[key]:
            content = 0.0
        out[key] = (m, content, presentation)
    return out


def test_importances_follow_their_definition(spark, pages_of, monkeypatch):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "pages").collect()]
    rows += site(6, True)
    got = site_trees.site_tree(pages_of(rows)).collect()
    expected = plain_tree(rows)
    assert len(got) == len(expected)
    for r in got:
        m, content, presentation = expected[r["node"] % (1 << 64)]
        assert r["n_pages"] == m
        assert r["content"] == pytest.approx(content, abs=1e-9)
        assert r["presentation"] == pytest.approx(presentation, abs=1e-9)


def test_no_pages(pages_of):
    assert main_texts(pages_of([])).collect() == []


@pytest.mark.parametrize("source", ["<div>a", "</b>x", "<p><b>x", "<a '", "<div></section>", "<!--",
                                    "<li>x", "<h1>a</h2>", "<span class=ad>x", "<", "&", "<td>x"])
def test_long_odd_pages_take_time_in_proportion(source):
    times = []
    for n in (20_000, 80_000):
        begin = time.process_time()
        Page(source * n, "s")
        times.append(time.process_time() - begin)
    assert times[1] < 12 * times[0] + 0.5


def test_sites():
    assert [site_of(u) for u in ("HTTP://u@A.Example:80/x", " https://b/ ", None, "", "x", "http://[")] == [
        "a.example", "b", "", "", "", "",
    ]
