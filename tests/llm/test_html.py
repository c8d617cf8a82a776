from __future__ import annotations

import html
import random
import re

from pyspark.sql import functions as F

from support import SF_DIR  # noqa: F401
from tripmill.llm.html_extract import best_path, extract, main_text, parse

PAGE = """<!DOCTYPE html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li>menu<li>more</ul></nav><div id=cookie-notice>we use cookies</div><div class="content row-2">
<article class="post-123"><h1>Head &amp; line</h1><p>Hello <b>wor</b>ld<br>again<p>two<ul><li>a<li>b</ul>
<aside>side</aside><div class="advert-box">buy</div><form><p>subscribe</p></form><script>var x="</p>";</script>
<blockquote><p>quoted</p></blockquote><table><tr><td>1<td>2</table><!-- <p>no</p> --></article></div>
<section class=comments><p>a very long comment by a reader of this page</p></section><footer>foot</footer>"""
TEXT = "Head & line\n\nHello world again\n\ntwo\n\na\n\nb\n\nquoted\n\n1\n\n2"


def test_main_text():
    page = parse(PAGE)
    assert main_text(page, best_path(page)) == TEXT
    assert main_text(page, "/no/such") == TEXT
    assert best_path(page) == "/body/div.content/article.post"


def test_odd_markup():
    for text in (None, "", "   ", "<p", "<p class='x", "</p></div>", "<!--", "<script>", "<p hidden>x</p>", "<nav>x</nav>"):
        assert main_text(parse(text), "") == ""
    assert main_text(parse("plain &lt;text&gt; < 5"), "") == "plain <text> < 5"
    assert main_text(parse("<p title=it's>one</p><p title='a>b'>two</p>"), "") == "one\n\ntwo"
    assert main_text(parse("<div>" * 3000 + "<p>deep</p>"), "") == "deep"


def test_marks_do_not_take_the_article():
    text = "<p>all the words of the article</p>"
    for around in (
        '<body style="overflow:hidden">{}', '<body data-state="hidden"><div>{}</div>', '<div style="overflow-x:hidden">{}</div>',
        "<div class=has-sidebar>{}</div>", '<div class="page no-sidebar">{}</div>', "<div class=content-with-ads>{}</div>",
        "<div class=overflow-hidden>{}</div>", "<div class=no-banner>{}</div>", "<div class=widget>{}</div>",
        "<div class=form-page><article>{}</article></div>", '<div title="a hidden class=nav b">{}</div>',
    ):
        page = parse(around.format(text) + "<div class=site-footer>foot</div>")
        assert main_text(page, best_path(page)) == "all the words of the article", around
    for part in ("<div hidden>x y</div>", "<div class=hidden>x y</div>", "<div class='main-nav'>x y</div>", "<div aria-hidden=true>x y</div>",
                 "<section id=comments>" + "<p>one more long comment</p>" * 9 + "</section>", "<span class=ad-7>x y</span>"):
        page = parse(f"<div class=page>{text}{part}</div>")
        assert main_text(page, best_path(page)) == "all the words of the article", part


def test_article_over_siblings_of_different_class(spark):
    lead, body, end = (" ".join(f"{w}{k}" for k in range(n)) for w, n in (("lead", 40), ("body", 60), ("end", 5)))
    text = f"\n\n".join((lead, body, end))
    html_of = (
        f"<body><div class=menu-top>x</div><div class=page><div class=post><div class=lead><p>{lead}</p></div>"
        f"<div class=body><p>{body}</p></div><div class=conclusion>{end}</div></div><ul><li><a href=y>other page</a></ul></div></body>"
    )
    page = parse(html_of)
    assert best_path(page) == "/body/div.page/div.post" and main_text(page, best_path(page)) == text
    rows = spark.createDataFrame([(k, "http://a.example/", html_of) for k in range(2)], "page_id long, url string, html string")
    assert [r.text for r in extract(rows).collect()] == [text] * 2


def test_host_path_wins(spark):
    good = "<body><div class=main-1><p>{0}</p></div><div class=extra><p>{1}</p></div>"
    long, short = "many words stand in this paragraph of text", "few words"
    pages = [(k, "http://User@Host.example:80/x", good.format(f"{long} {k}", short)) for k in range(3)]
    pages += [(3, "http://host.example/y", good.format(short, f"{long} {long}")), (4, None, f"<p>{long}</p>"), (5, "http://host.example", None)]
    pages += [(1, pages[1][1], pages[1][2])]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("a clash"))
    got = sorted((r.page_id, r.text, r.n_chars) for r in extract(rows).collect())
    both = f"{short}\n\n{long} {long}"
    assert got[4] == (3, both, len(both))  # the host's place holds few words, so the page's own is taken as well
    assert got[1][1] == got[2][1] == f"{long} 1" and got[5][1] == long and got[6] == (5, "", 0)
    assert extract(rows.limit(0)).count() == 0


def test_whole_small_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    got = {r.page_id: r.text for r in extract(pages).collect()}
    for row in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inside.replace("<br>", " "))
        plain = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", b))).strip() for b in blocks)
        assert got[row.page_id] == "\n\n".join(filter(None, plain))


def test_article_outside_the_host_path_is_not_lost(spark):
    """A teaser on the host's path does not replace the article that stands elsewhere."""
    article = [f"paragraph {k} " + " ".join(f"word{j}" for j in range(60)) for k in range(6)]
    usual = "<body><div class=content>" + "".join(f"<p>{p}</p>" for p in article) + "</div><div class=sidebar>x y z</div></body>"
    odd = "<body><div class=content><p>six words stand in this teaser</p></div><div class=story>" + "".join(f"<p>{p}</p>" for p in article) + "</div></body>"
    nearly = "<body><div class=content><p>" + " ".join(article[:4]) + "</p></div><div class=story><p>" + " ".join(article) + "</p></div></body>"
    rows = [(k, "http://a.example/", usual) for k in range(4)] + [(4, "http://a.example/", odd), (5, "http://a.example/", nearly)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    whole = "\n\n".join(article)
    assert got[0] == whole
    assert got[4] == "six words stand in this teaser\n\n" + whole
    assert got[5] == " ".join(article[:4])  # the host's place holds most of the words


def test_ties_of_votes(spark):
    """Of two paths with as many votes the longer one wins, then the first."""
    long, short = " ".join("abcdefghijkl"), "seven words are in this short text"
    two = "<div class={}><p>{}</p></div><div class={}><p>{}</p></div>"
    for one, other, wins in (("aa", "bbb", "bbb"), ("zz", "yy", "yy")):
        pages = [two.format(one, long, other, short), two.format(other, long, one, short)]
        rows = [(k, "http://t.example/", p) for k, p in enumerate(pages)]
        got = [r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]
        assert got == ([long, short] if wins == one else [short, long])


def test_generated_pages_equal_what_they_were_made_of(spark):
    """Pages of random templates around a known article, with every kind of part that is to go."""
    rng = random.Random(6)
    junk = ("<nav><a href=x>{}</a></nav>", "<div class='sidebar-left'><p>{}</p></div>", "<form>{}<input></form>", "<script>{}</script>",
            "<section id=comments><p>{}</p></section>", "<div class=cookie-notice>{}</div>", "<aside>{}</aside>", "<!-- {} -->", "<div class='ad'>{}</div>")
    said = "alpha beta gamma delta epsilon zeta eta theta".split()
    hosts = {h: (rng.choice(["article", "main", "div class=post", "div class='text-body'"]), rng.randint(0, 3)) for h in range(6)}
    pages, want = [], {}
    for k in range(240):
        h = rng.choice([0, 0, 0, *hosts])
        around, deep = hosts[h]
        paragraphs = [" ".join(rng.choices(said, k=rng.randint(8, 40))) + f" {k}" for _ in range(rng.randint(2, 6))]
        body = []
        for p in paragraphs:
            words = p.replace("beta", "b&eacute;ta &amp; co").replace(" gamma", "\n <b>gamma</b>")
            body.append(rng.choice(["<p>{}</p>", "<p class=lead>{}</p>", "<h2>{}</h2>"]).format(words))
            if rng.random() < 0.4:
                body.append(rng.choice(junk).format("go away"))
        want[k] = "\n\n".join(p.replace("beta", "b\u00e9ta & co") for p in paragraphs)
        tag = around.split()[0]
        inner = f"<{around}>" + "".join(body) + f"</{tag}>"
        for d in range(deep):
            inner = f"<div class=wrap{d}-{rng.randint(1, 99)}>{inner}</div>"
        pages.append((k, f"http://h{h}.example/{k}", f"<html><body>{rng.choice(junk).format('menu')}{inner}<footer>foot</footer></body></html>"))
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)).collect()}
    assert got == want
