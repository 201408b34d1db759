import random

import pytest

from logtally.llm import html_text as h
from tests.llm.cases import plain

PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><div class="top menu-1"><a href=x>M</a></div>
<div class="main post-%d"><h1>Head &amp; more</h1><p>First  <b>bold</b>
line<br>here<p>Second &lt;p&gt; &copy;<ul><li>one<li>two</ul><div class="ad">buy</div><form><p>in</form></div>
<div id="comments"><p>reader says a lot of things here, more than the article does, really a lot of things, and then some more of it</div>
<script>if (a < b) { x("</p>") }</script><!-- <p>no</p> --><footer>F</footer></body></html>"""
TEXT = "Head & more\nFirst bold line here\nSecond <p> ©\none\ntwo"


@pytest.mark.parametrize(("html", "text"), [
    (PAGE % 3, TEXT), ("", ""), ("just words", "just words"), ("<p>a<p>b", "a\nb"), ("<div><p>a</div></p>b", "a\nb"), ("a < b &amp; c", "a < b & c"), ("<p>x<!-- open", "x"),
    ("<script>var a", ""), ("<nav>a</nav>", ""), ("<p title='a>b'>c</p>", "c"), ("<p title=don't>c</p><p>d</p>", "c\nd"), ("&nbsp;&#65;&#x42;&bogus;", "AB&bogus;"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<span class=ad>no</span>yes", "yes"), ("<div hidden>no</div>yes", "yes"), ("</div></p>t", "t"), ("<article class=comment-page><p>a</article>", "a"),
])
def test_pages(html, text):
    assert h.article(html, None) == text


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string, text string, score double")


def test_the_hosts_pages_decide(spark):
    """On one page a list is longer than the article; the host's other pages say where the article is."""
    body = '<html><body><div class="box">{}</div><div class="story">{}</div></body></html>'
    story = "story number {} is a long one. " * 20
    rows = [(i, f"https://Site.example/{i}", body.format("<p>latest", "<p>" + story.format(*[i] * 20)), *[None] * 4) for i in range(5)]
    rows.append((9, "https://site.example:80/9", body.format("<p>" + "latest news " * 6, "<p>story number 9 is shorter than its box is"), *[None] * 4))
    rows += [(10, None, None, *[None] * 4), (11, "not a url", "<p>x", *[None] * 4), (9, "https://site.example/9", "", *[None] * 4)]
    got = sorted(plain(h.extract(pages(spark, rows))), key=lambda r: (r[0], r[2]))
    assert [r[2] for r in got][:5] == [story.format(*[i] * 20).strip() for i in range(5)]
    assert [r[2] for r in got[5:]] == ["", "story number 9 is shorter than its box is", "", "x"]
    assert all(r[3] == len(r[2]) for r in got)


def one(spark, rows):
    """Texts by page of (id, url, html) rows."""
    return {r["page_id"]: r["text"] for r in h.extract(pages(spark, [(*r, *[None] * 4) for r in rows])).collect()}


def test_an_article_that_goes_beyond_the_hosts_path_is_whole(spark):
    usual = [(i, "http://a.example/", f'<body><div class="content"><p>{f"usual text number {i} " * 9}</div></body>') for i in range(5)]
    body = f'<body><div class="content"><p>{"lead " * 30}</div><div class="story"><p>{"story " * 70}</div></body>'
    got = one(spark, [*usual, (7, "http://a.example/7", body)])
    assert got[7] == ("lead " * 30).strip() + "\n" + ("story " * 70).strip()
    assert got[3] == ("usual text number 3 " * 9).strip()


def test_a_headline_outside_of_a_deep_body_stays(spark):
    deep = f"<body><h1>Headline</h1><p>Opening paragraph</p>{'<div>' * 5}<p>{'text ' * 200}</p>{'</div>' * 5}</body>"
    want = "Headline\nOpening paragraph\n" + ("text " * 200).strip()
    assert one(spark, [(1, "http://b.example/", deep)])[1] == want
    # On a host whose pages all have their own headline there, too; what they repeat there goes.
    many = [(i, "http://c.example/", deep.replace("Headline", f"Headline {i}").replace("Opening paragraph", "Our paper").replace("text", f"text{i}")) for i in range(4)]
    # Copies of a page don't speak against it.
    many += [(10, *many[0][1:])]
    got = one(spark, many)
    assert got.pop(10) == got[0]
    assert got == {i: f"Headline {i}\n" + (f"text{i} " * 200).strip() for i in range(4)}


@pytest.mark.parametrize(("html", "text"), [
    ("<article><header><h1>Title</h1></header><p>a</article><header>no</header>", "Title\na"),
    ('<main><div class="related-work">a</div><p class="social-science">b</main>', "a\nb"),
    ('<div class="site-header">no</div><div class="comment-list">no</div><div class="sidebar-2 left">no</div><ul class="main-nav-0"><li>no</ul><p>a', "a"),
    ('<article><p>a<div class="related-posts">no</div><footer>by b</footer></article>', "a\nby b"),
])
def test_names_count_as_a_whole(html, text):
    assert h.article(html, None) == text


def by_hand(rows):
    """The consensus in plain Python."""
    host = lambda url: (url or "").lower().split("//")[-1].split("/")[0].split(":")[0] if "//" in (url or "") else ""
    votes = {}
    for _, url, html in rows:
        _, plain_, nodes = h.parse(html or "")
        if own := h.own_path(plain_, nodes):
            path = h._signed(own[0])
            n, s = votes.setdefault(host(url), {}).get(path, (0, 0.0))
            votes[host(url)][path] = (n + 1, s + round(own[1], 9))
    best = {k: max((n, round(s, 9), p) for p, (n, s) in v.items())[2] for k, v in votes.items()}
    cut = [(host(url), h.cut(html or "", best.get(host(url)))) for _, url, html in rows]
    beside = {}
    for (_, _, html), (k, page) in zip(rows, cut, strict=True):
        for piece in page:
            if piece.path is not None:
                beside.setdefault((k, piece.path), {})[html, piece.mark] = piece
    beside = {k: list(v.values()) for k, v in beside.items()}
    gone = {k for k, v in beside.items() if len(v) >= 2 and (2 * len({x.mark for x in v}) <= len(v) or 2 * sum(x.links for x in v) > len(v))}
    return ["\n".join(x.text for x in page if (k, x.path) not in gone) for k, page in cut]


def test_against_the_consensus_by_hand(spark):
    rng = random.Random(8)
    word = lambda n: " ".join(rng.choice(["one", "two", "three", "four"]) + str(rng.randrange(50)) for _ in range(n))
    parts = [
        lambda: f'<div class="story-{rng.randrange(9)}"><p>{word(30)}<p>{word(20)}</div>',
        lambda: f'<div class="body"><section><p>{word(40)}</section></div>',
        lambda: '<div class="box"><p>always the same</div>',
        lambda: f'<div class="latest"><p><a href=x>{word(5)}</a></div>',
        lambda: f"<h1>{word(3)}</h1>",
        lambda: "<p>All rights kept",
        lambda: f'<div class="extra"><p>{word(4)}</div>',
        lambda: "<nav>menu</nav>",
    ]
    rows = []
    for i in range(120):
        picked = [rng.choice(parts)() for _ in range(rng.randrange(1, 6))]
        rows.append((i, f"http://h{rng.randrange(5)}.example/{i}", "<body>" + "".join(picked) + "</body>"))
    rows += [(200, None, "<p>x"), (201, None, None), (202, "", "<p>x"), (203, "http://t.example/", ""), *rows[:10]]
    got = h.extract(pages(spark, [(i, u, x, *[None] * 4) for i, u, x in rows]).repartition(3))
    assert sorted((r["page_id"], r["text"]) for r in got.collect()) == sorted((i, text) for (i, *_), text in zip(rows, by_hand(rows), strict=True))


def test_even_votes_go_by_text_held_and_then_by_path(spark):
    """Two pages, two containers: both have one vote, and the one that holds more of its page wins, in any order of rows."""
    first = f'<div class="a"><p>{"word " * 60}</div><div class="b"><p>{"other " * 10}</div>'
    second = f'<div class="b"><p>{"word " * 60}</div><div class="a"><p>{"other " * 30}</div>'
    rows = [(1, "http://v.example/", first), (2, "http://v.example/", second)]
    df = lambda given: pages(spark, [(*r, "v.example", *[None] * 3) for r in given])
    _, plain_, nodes = h.parse(first)
    want = h._signed(h.own_path(plain_, nodes)[0])
    for given in (rows, rows[::-1]):
        assert [r["path"] for r in h.winning_paths(df(given)).collect()] == [want]


def test_long_and_deep_pages():
    assert h.article("<div>" * 20_000 + "deep" + "</div>" * 20_000, None) == "deep"
    assert len(h.article("<p>word</p>" * 50_000, None)) == 5 * 50_000 - 1
    assert h.article("<p " + "a=" * 50_000, None) == "<p " + "a=" * 50_000


def test_empty(spark):
    assert plain(h.extract(pages(spark, []))) == []
