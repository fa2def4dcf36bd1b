"""op8: pages with known articles, edge cases."""

import html
import math
import random
import re
import time

from quarry.llm import html_text as H
from quarry.llm.html_text import extract, main_text
from quarry.llm.q_html import op8_html_text
from quarry.session import read_table


def plain(page):
    """The article element's blocks, by a plain search: enough for the given pages."""
    blocks = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*)</article>", page, re.S)[1])
    return "\n".join(t for b in blocks if (t := " ".join(html.unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split())))


def test_query_against_plain_search(spark, sf):
    got = {r["page_id"]: r for r in op8_html_text(spark, sf).collect()}
    pages = read_table(spark, sf, "pages", "page_id", "url", "html").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p["page_id"]]["text"] == plain(p["html"]) and got[p["page_id"]]["n_chars"] == len(plain(p["html"]))
        assert got[p["page_id"]]["url"] == p["url"]


TEXT = "A sentence that belongs to the article, with a comma and enough words in it. " * 3


def test_without_article_element():
    p = TEXT.strip()
    page = (f"<html><body><div id=top><a href=/>Home</a> <a href=/b>News</a></div><div class=x><h2>Title &amp; more</h2><p>{p}<p>{p}"
            f"<p>Short.</p><p>{p}</p></div><div><a href=1>One link</a><a href=2>Another link</a><a href=3>Third</a></div></body></html>")
    assert main_text(page) == f"Title & more\n{p}\n{p}\nShort.\n{p}"


def test_junk_inside_and_around():
    p = TEXT.strip()
    page = (f"<body><header>Site</header><nav>Menu</nav><div class='cookie-notice'>We use cookies {TEXT}</div><main><article>"
            f"<header><h1>Head</h1></header><p>{p}</p><aside>Side</aside><form>Sign up<input></form><script>if (a<b) x('</p>')</script>"
            f"<style>p{{}}</style><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>"
            f"<section class=comments><p>{TEXT}{TEXT}</p></section></main><footer>Foot {TEXT}</footer></body>")
    assert main_text(page) == f"Head\n{p}\none\ntwo\na\nb"


def test_short_article_beside_long_text():
    """Density decides: the only article element is a teaser."""
    p = TEXT.strip()
    page = f"<body><div><p>{TEXT}</p><p>{TEXT}</p></div><article><p>Tiny.</p></article></body>"
    assert main_text(page) == f"{p}\n{p}"
    six = "".join(f"<p>{TEXT}</p>" for _ in range(6))
    assert main_text(f"<body><div class=x>{six}</div><article><h2>More</h2><p>Read more soon.</p></article></body>") == "\n".join([p] * 6)


def composite(tree, whole):
    """Density of (tag, children) by the published formula, written from its definition."""
    def counts(x):
        if isinstance(x, str):
            return len("".join(x.split())), 0, 0, 0
        c = lc = t = lt = 0
        for y in x[1]:
            a, b, d, e = counts(y)
            link = not isinstance(y, str) and y[0] == "a"
            c, lc, t, lt = c + a, lc + (a if link else b), t + d + (not isinstance(y, str)), lt + e + link
        return c, lc, t, lt

    c, lc, t, lt = counts(tree)
    if not c:
        return 0.0
    all_c, all_lc = counts(whole)[:2]
    lc, lt, t = max(lc, 1), max(lt, 1), max(t, 1)
    base = math.log(c / max(1, c - counts(tree)[1]) * lc + max(1, all_lc) / max(1, all_c) * c + math.e)
    return max(0.0, c / t * (math.log(c * t / (lc * lt)) / math.log(base)))


def test_densities_and_choice_against_the_formula():
    r = random.Random(8)
    word = lambda: " ".join(r.choice(["one", "three", "a", "sentence"]) for _ in range(r.randrange(1, 30)))

    def tree(depth):
        kids = [tree(depth - 1) if depth and r.random() < 0.7 else r.choice([("p", [word()]), ("p", [word(), ("a", [word()])]), ("a", [word()])])
                for _ in range(r.randrange(1, 5))]
        return "div", kids

    show = lambda x: x if isinstance(x, str) else f"<{x[0]}>{''.join(map(show, x[1]))}</{x[0]}>"
    for _ in range(60):
        body = ("body", [tree(3), tree(2)])
        blocks, stack = [], [body]
        while stack:
            x = stack.pop()
            if not isinstance(x, str):
                blocks += [x] * (x[0] != "a")
                stack += x[1]
        sums = {id(x): sum(composite(y, body) for y in x[1] if not isinstance(y, str) and y[0] != "a") for x in blocks}
        root = H.parse(show(body))
        mine = [n for n in H._measure(next(n for n in H._order(root) if n.tag == "body")) if n.tag in H.BLOCK]
        key = lambda rows: sorted((round(a, 6), round(b, 6)) for a, b in rows)
        assert key((n.density, n.sum) for n in mine) == key((composite(x, body), sums[id(x)]) for x in blocks)
        best = max(sums.values())
        nodes, _ = H._choose(H.parse(show(body)))
        assert any(abs(n.sum - best) < 1e-9 for n in nodes) or best == 0


def test_broken_pages_take_linear_time():
    """Twice the page, about twice the time; 100,000 broken tags in a second or so."""
    for one in ("<div>", "<p><div>", "<a ", "</b>", "<a '", "<a \"'>", "<p><ul><div>", "<li>", "</p>", "<!", "<b x='", "<table><td>", "<a =\">=\"",
                "<script>", "<article><div>", "</div", "<body>", "<option><button>"):
        took = []
        for n in (12_500, 100_000):
            at = time.process_time()
            main_text(one * n + "text")
            took.append(time.process_time() - at)
        assert took[1] < 20 * max(took[0], 0.1), (one, took)


def test_case_changes_of_other_lengths_do_not_shift_raw_text():
    assert main_text("<article>" + "İ" * 50 + "<SCRIPT>x</p></Script><p>after</p></article>").endswith("\nafter")


def test_references_white_space_and_broken_markup():
    assert main_text("<article><p>a&nbsp;&lt;b&gt;\n\t c&#233;<br>d <i>e</i>f</p>") == "a <b> cé d ef"
    assert main_text("<article><p>open <b>bold <p>next</article></div></b>") == "open bold\nnext"
    assert main_text("plain text only") == "plain text only"
    assert main_text("<p>less < than <3 and <a href='x>y") != ""


def test_edges(spark):
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    inline = "<article>" + "<i>" * 20_000 + "in" + "</article>"
    rows = [(1, "u", None), (2, "u", ""), (3, None, " \n "), (4, "u", "<html></html>"), (None, None, "<article><p>x</p></article>"),
            (5, "u", deep), (6, "u", inline), (7, "u", "<article><p>" + "word " * 200_000 + "</p></article>"), (7, "u", "<p>twice"), (7, "u", "<p>twice")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS text", "2 AS _page")
    got = [(r["page_id"], r["text"]) for r in extract(df).collect()]
    one = dict(got)
    assert len(got) == len(rows) and [one[i] for i in (1, 2, 3, 4)] == [""] * 4
    assert one[None] == "x" and one[5] == "deep" and one[6] == "in" and got.count((7, "twice")) == 2
    assert (7, " ".join(["word"] * 200_000)) in got
    assert extract(df.where("false")).count() == 0


def test_names_cut_no_text_of_the_article():
    """Slugs of headings and sections, notices and the like are the article's own text."""
    p = TEXT.strip()
    inner = (f"<h1>Head</h1><p>{p}</p><h2 id='search-algorithms'>Search algorithms</h2><p class='notice'>{p}</p>"
             f"<section id='related-work'><h2>Related</h2><p>{p}</p></section><h3 id=form-factors>Form</h3>"
             f"<div class='social-history'><p>{p}</p></div><pre>x <span class='hljs comment'># why</span></pre>"
             "<div class='share'><a href=1>Post it</a> <a href=2>Send it</a></div>")
    want = f"Head\n{p}\nSearch algorithms\n{p}\nRelated\n{p}\nForm\n{p}\nx # why"
    for tag in ("article", "div"):
        page = f"<body><div class='sidebar-left'><p>{TEXT}</p></div><{tag}>{inner}</{tag}><div class=related-posts>{TEXT}</div></body>"
        assert main_text(page) == want


def test_reader_comments_go():
    p = TEXT.strip()
    remark = f"<article class='comment'><p>{TEXT}{TEXT}</p></article>"
    for page in (f"<nav><div class=menu>Menu</div></nav><article><p>{p}</p></article>",
                 f"<article><p>{p}</p><section class='comments'>{remark}{remark}</section></article>",
                 f"<main><article><p>{p}</p></article><section id=comments>{remark}{remark}</section></main>",
                 f"<div class='widget'><article><p>{p}</p></article></div><div class='comment-list'>{remark}</div>",
                 f"<article><p>{p}</p></article>{remark}{remark}"):
        assert main_text(f"<body>{page}</body>") == p
    assert main_text(f"<body><div class=comments>{remark}</div></body>") == f"{p} {p}"       # nothing but comments
