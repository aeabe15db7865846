"""Layouts with known main text; consensus of a host; odd pages."""

import os

import pytest

from litsearch.llm import op2_html_text as op2

MENU = "<nav><ul><li><a href='/a'>Home</a></li></ul></nav>"
LONG = "This is a paragraph of the article that is long enough to be text. " * 3


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def news(text, more=""):
    return page(f"{MENU}<div class='cookie-notice'>We use cookies, please agree. {LONG}</div>"
                f"<div class='post-17 entry'><h1>Head&amp;line</h1><p>{text}</p><div class=\"ad\">Buy {LONG}</div>"
                f"<p>Second &eacute;\n  part<br>goes on</p>{more}</div>"
                f"<div id='comments'><p>{LONG}</p><p>{LONG}</p></div><footer>&copy; me</footer>")


WANT = "Head&line\n{}\nSecond é part goes on"
ODD = [
    (1, "http://a.org/1", None, ""), (2, "http://a.org/2", "", ""), (3, None, "just text & more", "just text & more"),
    (4, "x", "<p>a<p>b<script>var t='</p>';", "a\nb"), (5, "x", "<div>open <b>bold <!-- never closed <p>x", "open bold"),
    (6, "x", page(MENU + "<footer>all boilerplate</footer>"), ""), (7, "x", "a < b and c > d", "a < b and c > d"),
    (8, "x", "<p>" + "y" * 300_000 + "</p>", "y" * 300_000), (9, "x", "<div>" * 3000 + "deep", "deep"),
    (10, "x", "<p title='a>b'>q</p><p>&#x41;&nbsp;&lt;b&gt;</p><form>name <input></form>", "q\nA <b>"),
    (11, "x", "<p>cut in a tag <a href=", "cut in a tag"), (12, "x", "<a\"" * 20_000 + "<p>z</p>", None),
]


def test_text_of_pages(spark):
    rows = [(100 + i, f"https://news.example.com/{i}", news(LONG + str(i)), WANT.format((LONG + str(i)).strip()))
            for i in range(6)]
    # a short article loses to nothing: the host's path is known from the other pages
    rows.append((110, "https://NEWS.example.com/s", news("Short."), WANT.format("Short.")))
    # another layout of that host: its own best container
    rows.append((111, "https://news.example.com/o",
                 page(f"{MENU}<main><section><h2>S</h2><p>{LONG}</p></section><section><p>{LONG}</p></section></main>"),
                 "\n".join(["S", LONG.strip(), LONG.strip()])))
    rows.append((112, "https://news.example.com/a",
                 page(f"<article><header><h1>H</h1></header><p>{LONG}</p><footer>by me</footer></article>"),
                 f"H\n{LONG.strip()}"))
    rows += ODD + [rows[0]]
    pages = spark.createDataFrame([(*r[:3], "clash") for r in rows],
                                  "page_id long, url string, html string, text string")
    got = op2.extract(pages).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r for r in got}
    for i, url, _, want in rows:
        assert text[i].url == url and text[i].n_chars == len(text[i].text)
        if want is not None:
            assert text[i].text == want, i
    assert op2.extract(pages.limit(0)).count() == 0


def test_several_winning_paths():
    """A lead longer than the body beside it keeps neither the body nor the heading away."""
    html = page(f"<div class='post'><h1>Head</h1><div class='lead'><p>{LONG * 3}</p></div><h2>Between</h2>"
                f"<div class='text'><p>{LONG}</p><p>End.</p></div></div><div class='side-box'><p>Small.</p></div>")
    assert op2.main_text(html, None) == "\n".join(["Head", (LONG * 3).strip(), "Between", LONG.strip(), "End."])
    apart = page(f"<div class='lead'><p>{LONG * 3}</p></div><div class='odd'>Clutter.</div><div class='text'><p>{LONG}</p></div>")
    assert op2.main_text(apart, None) == f"{(LONG * 3).strip()}\n{LONG.strip()}"
    # paths elected by the host, on a page where the second holds next to nothing
    short = apart.replace(f"<p>{LONG}</p></div>", "<p>Short end.</p></div>")
    assert op2.main_text(short, ["html/body/div.lead", "html/body/div.text"]).endswith("\nShort end.")


@pytest.mark.parametrize("depth", [39, 40, 41, 60, 200, 20_000])
def test_any_depth(depth):
    html = page("<div>" * depth + f"{MENU}<div class='post'><p>{LONG}</p><ul><li>item</li></ul></div>"
                + f"<div class='sidebar'>{LONG}</div>" + "</div>" * depth + "<footer>f</footer>")
    want = f"{LONG.strip()}\nitem"
    assert op2.main_text(html, None) == want
    counted = op2.votes(op2.read_page(html))
    assert op2.main_text(html, sorted(op2.elect(counted))) == want
    assert max(p.count("/") for p in counted) <= op2.WRITTEN_STEPS


def test_words_of_a_wrapper_do_not_strike_it():
    inner = f"<h1>H</h1><p>{LONG}</p><div class='sidebar'><p>{LONG}</p></div><div id='comments'><p>{LONG}</p><p>{LONG}</p></div>"
    for wrapper in ("page no-sidebar", "has-menu", "search-results"):
        assert op2.main_text(page(f"<div class='{wrapper}'>{inner}</div>"), None) == f"H\n{LONG.strip()}"
    plain = page(f"<div class='no-sidebar'><div class='post'><p>{LONG}</p><p>x</p></div></div>")
    assert op2.main_text(plain, None) == f"{LONG.strip()}\nx"
    # comments stay out, however long beside a short article
    assert op2.main_text(page(f"<div class='post'><p>Short.</p></div><div id='comments'><p>{LONG * 9}</p><p>y</p></div>"),
                         None) == "Short."


def test_votes_of_hosts_against_a_plain_count(spark):
    from collections import Counter

    texts = [news(LONG * (1 + i % 3)) if i % 4 else page(f"<main><p>{LONG}</p></main><div class='b'><p>{LONG * i}</p></div>")
             for i in range(23)]
    rows = [("h" if i % 3 else "g", t) for i, t in enumerate(texts)]
    got = {r.host: set(r.winners) for r in op2.host_winners(spark.createDataFrame(rows, "host string, html string")).collect()}
    for host in ("g", "h"):
        every, own = Counter(), Counter()
        for h, t in rows:
            if h == host:
                for p, (a, b) in op2.votes(op2.read_page(t)).items():
                    every[p] += a
                    own[p] += b
        assert got[host] == op2.elect({p: (every[p], own[p]) for p in every})


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")
def test_pages_of_the_test_tables(spark):
    """There the article element holds the main text; cut it out by string search."""
    import html as library
    import re

    for r in op2.op2_html_text(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet"), "page_id").collect():
        inner = re.split("</article>|<footer", r.html.split("<article>")[1])[0]
        parts = [" ".join(library.unescape(re.sub("<[^>]*>?", " ", p)).split())
                 for p in re.split("</?(?:p|h1)>", inner.replace("<b>", "").replace("</b>", ""))]
        assert r.text == "\n".join(p for p in parts if p)
