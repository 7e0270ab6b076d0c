import html as entities
import random
import re

import pytest
from almanac.llm import extract, markup, queries

SCHEMA = "page_id long, url string, html string, note string"


def prose(rnd, words):
    return " ".join(rnd.choice("river stone the old bridge under light walks every morning and again with bread over hills until it rains".split()) for _ in range(words)).capitalize() + "."


def own(html):
    page = markup.read(html)
    return markup.text_of(page, [markup.scored(page)])


def head(rnd):
    return "<!DOCTYPE html><html><head><title>T</title><style>.a>p{x:1}</style><script>if(a<b){document.write('<p>no</p>')}</script></head>"


def menus(rnd):
    return "".join(f'<li><a href="/{k}">{prose(rnd, 2)}</a></li>' for k in range(6))


def classed(rnd, paragraphs, title):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (f'{head(rnd)}<body class="has-sidebar"><div id="page"><div class="site-header"><ul>{menus(rnd)}</ul></div><div class="cookie-notice">We use cookies, {prose(rnd, 30)}</div>'
            f'<div class="post-{rnd.randrange(999)} post"><h1>{title}</h1>{body}<div class="share-buttons"><a href=x>Share</a></div></div>'
            f'<div id="comments"><div class="comment"><p>{prose(rnd, 60)}</p></div></div><div class="sidebar"><p>{prose(rnd, 50)}</p></div><form><p>{prose(rnd, 9)}</p><input name=q></form><div class="footer-bar">(c)</div></div></body></html>')


def nameless(rnd, paragraphs, title):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (f'{head(rnd)}<body><div class="x1"><ul>{menus(rnd)}</ul></div><div class="x2"><div class="q7"><h1>{title}</h1>{body}</div><div class="q8"><p>{prose(rnd, 25)}</p></div></div><div class="x3"><a href="/">{prose(rnd, 12)}</a></div></body>')


def sections(rnd, paragraphs, title):
    body = "".join(f"<section><h2>{prose(rnd, 3)}</h2><p>{p}</section>" for p in paragraphs)
    inner = re.findall(r"<h2>(.*?)</h2><p>(.*?)</section>", body)
    page = f'{head(rnd)}<body><header><h1>Site</h1></header><main role="main"><article itemscope><header><h1>{title}</h1></header>{body}<footer><p>tags</p></footer><aside><p>{prose(rnd, 40)}</p></aside></article><article class="comment"><p>{prose(rnd, 30)}</p></article></main></body></html>'
    return page, " ".join([title, *(x for pair in inner for x in pair)])


def test_one_page_of_each_kind():
    rnd = random.Random(1)
    paragraphs, title = [prose(rnd, n) for n in (40, 70, 55)], "A title"
    want = " ".join([title, *paragraphs])
    assert own(classed(rnd, paragraphs, title)) == want
    assert own(nameless(rnd, paragraphs, title)) == want
    page, text = sections(rnd, paragraphs, title)
    assert own(page) == text


@pytest.mark.parametrize("html, text", [
    ("", ""), ("   \n ", ""), ("plain & simple", "plain & simple"), ("a < b and c", "a < b and c"), ("<p>one<p>two <b>bo<i>ld</b>er</i>", "one two bolder"),
    ("<article><p>x&nbsp;&amp;&#233;&lt;p&gt;</p><!-- <p>no</p> --><p>y</p></article", "x &é<p> y"), ("<article>a<br>b<br/>c<hr>d</article>", "a b c d"),
    ("<div title='a > b'>in</div>", "in"), ("<p>cut off <a href=\"x", "cut off"), ("<p>text<!-- never closed <p>no", "text"), ("<script>var t='</p>';<p>no", ""),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a b c d"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"), ("<p>un\n\t balanced</div></section></p>tail", "un balanced tail"),
    ("<div class='sidebar'>everything is in a box of that name</div>", "everything is in a box of that name"), ("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
    ("<p>i<sup>2</sup> and<span class='ad'>buy</span> more</p>", "i2 and more"), ('<p class="broken>a</p><p>b</p>', "a b"),
])
def test_small_pages(html, text):
    assert own(html) == text


BODY = "<p>The first paragraph of the text, long enough to be one, with a comma.</p><p>And a second one that goes on for a while longer than the first.</p>"
TEXT = "The first paragraph of the text, long enough to be one, with a comma. And a second one that goes on for a while longer than the first."


@pytest.mark.parametrize("html, text", [
    # a byline and what stands behind the body belong to the article
    (f"<article><h1>T</h1><div class=meta>By A</div><div class='article-body'>{BODY}</div><div class=bio>About A</div></article><div class=x><p>{'other words ' * 40}</p></div>", f"T By A {TEXT} About A"),
    (f"<div id=content><div class='post'><header><h1>T</h1></header><span>By A</span><div class='post-content'>{BODY}</div></div><div id=disqus_thread><p>{'c ' * 90}</p></div></div>", f"T By A {TEXT}"),
    (f"<div class=wrap><header class=pageheader><h1>Site</h1></header><div class=sitenav><a>x</a> y</div><div class=entry-content>{BODY}</div><div class=cookiebar>We</div><div class=readercomments><p>no</p></div><div class=relatedposts>no</div><div class=siteFooter>no</div></div>", TEXT),
    (f"<BODY CLASS='no-sidebar'><FORM id=aspnetForm><H1>T</H1><DIV CLASS=StoryBody>{BODY}</DIV><DIV CLASS=Advertisement>no</DIV></FORM><P>", f"T {TEXT}"),
    (f"<main><h1>T</h1>{BODY}<ins class=adsbygoogle>no</ins><div role=search>no</div><section aria-label=c class='article-comments'><h2>3 comments</h2><article class=comment><p>no</p></article></section></main><aside>no</aside>", f"T {TEXT}"),
    (f"<table><tr><td class=menu>no</td><td class=text>{BODY}</td></tr></table><div class='with-sidebar'></div>", TEXT),
    (f"<article>{BODY}<div class='comment-form'><textarea>no</textarea></div><blockquote><p>quoted</p></blockquote><pre>a  b\n c</pre><figure><img alt=no><figcaption>cap</figcaption></figure></article>", f"{TEXT} quoted a b c cap"),
    (f"<article>{BODY.replace('<p>', '<div>').replace('</p>', '</div>')}</article>", TEXT), (f"<div>{BODY.replace('<p>', '').replace('</p>', '<br><br>')}</div><div><ul><li><a>menu</a></ul></div>", TEXT),
])
def test_templates(html, text):
    assert own(html) == text


def test_consensus_helps_pages_with_little_text(spark):
    """Where the article is short and its neighbour long, a page alone takes the neighbour; its host knows better."""
    rnd = random.Random(4)
    rows, want = [], {}
    for k in range(30):
        short = k % 5 == 0
        paragraphs = [prose(rnd, 4)] if short else [prose(rnd, 60), prose(rnd, 80)]
        rows.append((k, f"http://www.one.example:80/a/{k}", nameless(rnd, paragraphs, f"Title {k}"), "x"))
        want[k] = " ".join([f"Title {k}", *paragraphs])
    assert sum(own(r[2]) != want[r[0]] for r in rows) >= 5
    df = spark.createDataFrame(rows, SCHEMA)
    for most in (extract.BROADCAST_HOSTS, 0):
        got = {r.page_id: r.text for r in extract.main_texts(df, broadcast_hosts=most).collect()}
        assert got == want
    w = extract.winners(extract.votes(df)).collect()
    assert [(r.host, r.n) for r in w] == [("one.example", 30)] and extract.votes(df).where("n > 20").first().steps == "html/body/div.x2/div.q7"
    assert [markup._general("div", {"class": c}) for c in ("post-12 post", "p1234x", "col-md-8", "q7", "widget_3")] == ["div.post.post-#", "div.p#x", "div.col-md-8", "div.q7", "div.widget_#"]


def test_winners_are_ranked_by_votes_and_by_steps(spark):
    counted = spark.createDataFrame([("a", 1, "y", 45), ("a", 2, "x", 45), ("a", 3, "z", 9), ("b", 4, "q", 1), ("", 5, "r", 2)], "host string, path long, steps string, n long")
    assert {r.host: (r.n, r.paths) for r in extract.winners(counted).collect()} == {"a": (99, [2, 1]), "b": (1, [4]), "": (2, [5])}


def test_odd_rows(spark):
    long = "<article>" + "<p>" + "word " * 300_000 + "</article>"
    deep = "<div>" * 3000 + "<b>" * 3000 + "text" + "</i>" * 3000
    rows = [(1, None, None, None), (None, "nonsense", "<p>a b</p>", None), (2, "http://h/x", "", None), (3, "http://h/x", "<p>same</p>", None), (3, "http://h/x", "<p>same</p>", None), (4, None, long, None), (5, None, deep, None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS host", "'clash' AS paths", "'clash' AS of", "'clash' AS text")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in extract.digest(extract.main_texts(df)).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (None, "nonsense", "a b", 3), (2, "http://h/x", "", 0), (3, "http://h/x", "same", 4), (3, "http://h/x", "same", 4), (4, None, ("word " * 300_000).strip(), 1_499_999), (5, None, "text", 4)], key=str)
    assert extract.main_texts(df.limit(0)).count() == 0


def test_given_pages(spark, sf):
    def plain(s):
        inner = re.search(r"<article>(.*)</article>", s, re.S)[1]
        return " ".join(entities.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", inner))).split())

    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r.page_id: r.text for r in queries.queries()["op13_html_extraction"](spark, sf).collect()}
    assert got == {r.page_id: plain(r.html) for r in rows}
