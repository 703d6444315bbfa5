"""Operator 11 against a reader of the given template, a plain style tree, and pages
written by hand."""

import html
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from ledgerlens.llm import op11_html as H
from ledgerlens.llm.markup import NOISE, host, parse
from tests.llm.conftest import SF0001


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def got(spark, rows):
    out = H.extract(pages(spark, rows)).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    return {r["page_id"]: r["text"] for r in out}


def one(spark, body, head=""):
    return got(spark, [(1, "http://a.example/1", f"<html><head>{head}</head><body>{body}")])[1]


def test_whole_table_of_the_given_template(spark):
    rows = spark.read.parquet(f"{SF0001}/pages.parquet").collect()
    want = {}
    for r in rows:
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<br>|</?b>", " ", part)).split())
                  for part in re.split(r"</?p>|</?h1>", article)]
        want[r["page_id"]] = (r["url"], "\n".join(b for b in blocks if b))
    out = {r["page_id"]: (r["url"], r["text"]) for r in H.op11_html(spark, SF0001).collect()}
    assert out == want


def plain_importance(rows):
    """node -> (pages, importance) by the definitions, page by page."""
    shapes, texts, kinds = defaultdict(list), defaultdict(lambda: defaultdict(set)), {}
    sizes = {}
    for i, (url, page) in enumerate(rows):
        p = parse(page, host(url))
        for node, (shape, k) in p.tree.items():
            shapes[node].append(shape)
            kinds[node] = max(k, kinds.get(node, 0))
        for b in p.blocks:
            for n in b.judged:
                texts[n][b.text].add(i)
            sizes[b.text] = len(b.text)
    out = {}
    for node, blocks in texts.items():
        m = len(shapes[node])
        if m == 1:
            out[node] = (1, 1.0)
            continue
        presentation = -sum(n / m * math.log(n / m, m) for n in Counter(shapes[node]).values())
        whole = sum(sizes[t] for t in blocks)
        content = sum(sizes[t] * (1 - math.log(len(held), m)) for t, held in blocks.items()) / whole
        share = 0.9 ** kinds[node]
        out[node] = (m, (1 - share) * presentation + share * content)
    return out


def random_site(seed, n=40):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3)
    rows = []
    for i in range(n):
        parts = [f"<div class='c{rng.randint(0, 2)}'>" + "".join(
            f"<{t}>{word()}</{t}>" for t in rng.choices(["p", "div", "h2"], k=rng.randint(1, 3)))
            + "</div>" for _ in range(rng.randint(1, 4))]
        fixed = "<div class='f'><p>always here</p></div>"
        rows.append((f"https://{rng.choice('xy')}.example/{i}", "".join(parts) + fixed))
    return rows


def test_importance_by_the_definitions(spark):
    rows = random_site(1)
    found = H.parsed(pages(spark, [(i, *r) for i, r in enumerate(rows)]).repartition(5))
    want = plain_importance(rows)
    out = {r["node"]: (r["pages"], r["importance"]) for r in H.importance(found).collect()}
    assert out.keys() == want.keys()
    for node, (m, value) in want.items():
        assert out[node][0] == m and out[node][1] == pytest.approx(value, abs=1e-9)
    assert any(v < H.LEAST for _, v in want.values()) and any(v > .5 for _, v in want.values())


def test_unnamed_template_is_found_by_entropy(spark):
    """No landmark and no telling name: what every page of the host repeats goes."""
    def page(i):
        return (f"<div class=q1><ul><li>Start</li><li>Shop</li><li>Contact us</li></ul></div>"
                f"<div class=q2><h1>Title {i}</h1><p>Story {i} begins.</p><p>And {i} ends.</p></div>"
                "<div class=q3><p>We care about your privacy and more.</p></div>"
                "<div><p>All rights reserved by the house.</p></div>")
    rows = [(i, f"https://site.example/{i}", page(i)) for i in range(12)]
    rows.append((99, "https://other.example/1", page(99)))  # a host of one page tells nothing
    out = got(spark, rows)
    for i in range(12):
        assert out[i] == f"Title {i}\nStory {i} begins.\nAnd {i} ends."
    assert out[99].startswith("Start\nShop") and "Story 99 begins." in out[99]


def test_article_of_a_host_that_repeats_it_stays(spark):
    same = "<article><h1>Head</h1><div class=x><p>One text.</p><p>Two text.</p></div></article>"
    rows = [(i, "https://copy.example/", f"<div>Top</div>{same}<div>{i}</div>") for i in range(30)]
    assert set(got(spark, rows).values()) == {"Head\nOne text.\nTwo text."}
    bare = [(i, "https://bare.example/", "<div><p>One text.</p></div>") for i in range(30)]
    assert set(got(spark, bare).values()) == {"One text."}


def test_repeated_branch_inside_an_article_goes(spark):
    rows = [(i, "https://s.example/", f"<article><h1>Head {i}</h1><p>Text {i} is long enough.</p>"
             "<div class='k7'>Read it in our app</div></article>") for i in range(20)]
    assert got(spark, rows)[3] == "Head 3\nText 3 is long enough."


NOISE_PARTS = [
    "<nav><a href=/>Menu</a></nav>", "<header><h1>Site</h1></header>", "<footer>&copy; me</footer>",
    "<aside><p>Side</p></aside>", "<div class='sidebar left'>Side</div>", "<div id=cookie-notice>Ok?</div>",
    "<div class=ad>Buy</div>", "<div class='adBox'>Buy</div>", "<form><p>Name <input></p></form>",
    "<script>var t='<p>x</p>';</script>", "<style>p{}</style>", "<!-- <p>gone</p> -->",
    "<section class=comments><article><p>First!</p></article></section>",
    "<div role=navigation>Go</div>", "<ul class='site-menu'><li>A<li>B</ul>", "<div hidden>h</div>",
    "<div style='display: none'>h</div>", "<noscript>On</noscript>", "<div class=newsletter>Join</div>",
    "<div aria-hidden=true>x</div>", "<select><option>a<option>b</select>", "<button>Go</button>",
    "<div class='related-posts'><p>More</p></div>", "<p class=advertisement>Buy</p>"]


@pytest.mark.parametrize("named", ["<article>{}</article>", "<main>{}</main>", "{}",
                                   "<div role=main>{}</div>", "<div class='post-content'>{}</div>"])
def test_parts_that_are_never_the_article(spark, named):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        inside = ["<h1>Real title</h1>", "<p>First &amp; <b>only</b> text.</p>"]
        for part in rng.sample(NOISE_PARTS, 3):
            inside.insert(rng.randint(0, len(inside)), part)
        around = rng.sample(NOISE_PARTS, 4)
        if "header" in "".join(inside):  # an article's own header is its title
            inside = [p for p in inside if "<header>" not in p]
        rows.append((i, f"https://h{i}.example/", "<!DOCTYPE html><html><head><title>T</title></head>"
                     "<body class='has-sidebar'>" + "".join(around[:2])
                     + named.format("".join(inside)) + "".join(around[2:]) + "</body></html>"))
    for i, text in got(spark, rows).items():
        assert text == "Real title\nFirst & only text.", rows[i][2]


def test_blocks_white_space_and_references(spark):
    assert one(spark, "<article><p> a\n\tb&nbsp;<i>c</i>d<br>e </p>f &lt;g&gt; &#233;&#x4e2d; &amp;amp;"
                      "<ul><li>x<li> y </ul><table><tr><td>1<td>2<tr><td>3</table>"
                      "<pre>p  q\nr</pre></article>") == (
        "a b cd e\nf <g> é中 &amp;\nx\ny\n1\n2\n3\np q r")


def test_article_header_is_its_title(spark):
    assert one(spark, "<header><p>Site</p></header><article><header><h1>T</h1></header><p>x</p>"
                      "<footer>tags</footer></article>") == "T\nx"


def test_broken_markup(spark):
    assert one(spark, "<article><p><b>One<p>Two</i></p></p><div>Three</article><footer>f") == \
        "One\nTwo\nThree"
    assert one(spark, "<article><p>a < b and 3 > 2 <3</p><p title='x > y\"'>c</p>") == \
        "a < b and 3 > 2 <3\nc"
    assert one(spark, "<article>cut &am") == "cut &am"
    assert one(spark, "<article>cut <a href=\"x") == "cut"
    assert one(spark, "<article>kept<script>never closed <p>x") == "kept"
    assert one(spark, "<p>keep <span class=ad>buy</span> me</p>") == "keep me"


def test_nulls_empties_repeats_and_clashes(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no url", "plain text"), (4, "http://[bad", "<p></p>"),
            (5, "http://x.example", "<nav>only</nav>"), (None, "http://x.example", "<p>t</p>"),
            (3, "no url", "plain text")]
    df = pages(spark, rows).selectExpr("*", "1 AS row", "2 AS blocks", "3 AS low", "'x' AS text",
                                       "4 AS rank", "5 AS node")
    out = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in H.extract(df).collect()), key=str)
    assert out == sorted([(1, "", 0), (2, "", 0), (3, "plain text", 10), (3, "plain text", 10),
                          (4, "", 0), (5, "", 0), (None, "t", 1)], key=str)
    assert H.extract(pages(spark, [])).collect() == []


def test_very_long_and_very_deep_pages(spark):
    many = "".join(f"<p>word {i}</p>" for i in range(60_000))
    deep = "<div class=a><div class=b>" * 20_000 + "core"
    out = got(spark, [(1, "http://l.example", f"<article>{many}</article>"),
                      (2, "http://d.example", deep), (3, "http://q.example", "<a \"" * 50_000)])
    assert out[1].count("\n") == 59_999 and out[2] == "core" and out[3] == ""


def test_parse_is_one_tree_per_host():
    a, b = (parse("<div class=k><p>x</p></div>", h) for h in ("a", "b"))
    assert a.blocks[0].judged != b.blocks[0].judged
    assert parse("<nav>x</nav>", "a").blocks[0].rank == NOISE
