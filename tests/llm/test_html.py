import random
import time

import pytest

from gridloom.llm import html as H
from gridloom.llm.html import extract_main_text, main_text

LONG = "This is a paragraph with some words, commas, and enough text to count as a part of the story."


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("plain words only", "plain words only"),
        ("<p>a<p>b", "a b"),
        ("<", "<"),
        ("a < b and c > d", "a < b and c > d"),
        ("<a href='x", ""),
        ("<div>Just <!-- c --> text<br>here<script>if(a<b){}</script> end</div>", "Just text here end"),
        ("<article><p>fish &amp; chips&nbsp;&eacute;&#233;&#xe9;</p></article>", "fish & chips ééé"),
        ("<article><p>one\n\t two</p><p>th<b>re</b>e</p></article>", "one two three"),
        ("<title>t</title><style>p{}</style><article>x<noscript>y</noscript></article>", "x"),
        ("<p title=it's>yes <i title=\"a>b\">no</i></p>", "yes no"),
        ("<p>x</p><div hidden>y</div><p aria-hidden=true>z</p>", "x"),
        ("<ul><li>one<li>two</ul>", "one two"),
    ],
)
def test_small_pages(page, want):
    assert main_text(page) == want


def furniture():
    return [
        "<nav><ul><li><a href=/>Home</a></li></ul></nav>",
        "<header>Site name and slogan</header>",
        "<footer>Copyright of somebody</footer>",
        "<aside>Other things to read here</aside>",
        "<div class='sidebar-left'>Links and more links</div>",
        "<div id=cookieNotice>We use cookies</div>",
        "<div class='ad'>Buy this now</div>",
        "<form><label>Name</label><button>Go</button></form>",
        "<script>var p = '<p>no</p>';</script>",
        "<section id='comments'><p>I liked this, really, a lot, thanks, all.</p></section>",
        "<div class='comment-list'><p>Me too, me too, me too, me too.</p></div>",
        "<div role=navigation>Go there</div>",
    ]


def test_furniture_goes_wherever_it_stands():
    body = f"<h1>Head line</h1><p>{LONG}</p><blockquote>{LONG}</blockquote><ul><li>point one</li></ul>"
    want = f"Head line {LONG} {LONG} point one"
    for f in furniture():
        assert main_text(f"<html><body>{f}<article>{body}</article>{f}</body></html>") == want, f
        assert main_text(f"<html><body><article>{body}{f}</article></body></html>") == want, f
        assert main_text(f"<html><body>{f}<div class=content>{body}</div>{f}</body></html>") == want, f


def test_best_container_wins_by_links():
    links = "".join(f"<p><a href={i}>A link of some length, with commas, number {i}</a></p>" for i in range(30))
    assert main_text(f"<body><div>{links}</div><div><p>{LONG}</p><p>{LONG}</p></div></body>") == f"{LONG} {LONG}"


def test_sections_of_one_text_stay():
    parts = "".join(f"<section><p>{LONG} {i}</p><p>{LONG}</p></section>" for i in range(3))
    assert main_text(f"<body><article>{parts}</article></body>") == " ".join(f"{LONG} {i} {LONG}" for i in range(3))


def test_broken_and_deep_pages():
    assert main_text("<b>" * 3000 + "deep" + "</i>" * 3000) == "deep"
    assert main_text("<div>" * 2000 + f"<p>{LONG}") == LONG
    assert main_text("<p x='" * 2000) == ""
    assert len(main_text("<article>" + f"<p>{LONG}</p>" * 3000)) == 3000 * (len(LONG) + 1) - 1


def test_frames(spark):
    df = spark.createDataFrame([(1, "u", "<p>a"), (2, None, None), (1, "u", "<p>a")], "page_id long, url string, html string")
    assert sorted(r["main_text"] for r in extract_main_text(df).collect()) == ["", "a", "a"]
    assert extract_main_text(df.limit(0)).count() == 0
    assert extract_main_text(df, out="url").columns == ["page_id", "url", "html"]


def test_names_that_only_look_like_furniture():
    body = f"<p>{LONG}</p><div class='share-price'>Shares rose, by three, in a day.</div><p>{LONG}</p>"
    want = f"{LONG} Shares rose, by three, in a day. {LONG}"
    assert main_text(f"<body><article>{body}</article></body>") == want
    assert main_text(f"<body><div class='ad-hoc'>{body}</div><p>short</p></body>") == want + " short"
    for name in ("share-buttons", "post-comments", "siteFooter", "left_sidebar2", "ad"):
        assert main_text(f"<body><article><p>{LONG}</p><div class='{name}'>{LONG}</div></article></body>") == LONG
    for name in ("no-sidebar", "related-work-of-art", "promotion-rules", "adverse"):
        assert main_text(f"<body><article><p>{LONG}</p><div class='{name}'>{LONG}</div></article></body>") == f"{LONG} {LONG}"


def test_furniture_by_name_is_kept_where_there_is_nothing_else():
    assert main_text(f"<body><nav><a href=/>Home</a></nav><div class=widget><p>{LONG}</p></div></body>") == LONG
    # a fifth of the points: a little more text outside wins
    ads = f"<div class=ads><p>{LONG}</p><p>{LONG}</p></div>"
    assert main_text(f"<body>{ads}<div><p>The story, told in short words.</p></div>{ads}</body>") == "The story, told in short words."


def test_pages_without_article_or_main():
    menu = "<div>" + "".join(f"<a href={i}>Part number {i}</a> " for i in range(40)) + "</div>"
    body = f"<h1>Head</h1><p>Lead.</p><p>{LONG}</p><h2>Next</h2><p>Short.</p><p>{LONG}</p><p>End.</p>"
    want = f"Head Lead. {LONG} Next Short. {LONG} End."
    assert main_text(f"<body>{menu}<div>{body}</div>{menu}</body>") == want
    # headings, short paragraphs and sections beside the best container
    parts = f"<h1>Head</h1><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><h2>Next</h2><p>Short.</p><div><p>Small part.</p></div><div><p>{LONG}</p></div><h3>Last</h3>"
    want = f"Head {LONG} {LONG} {LONG} Next Short. Small part. {LONG} Last"
    assert main_text(f"<body>{menu}<div>{parts}</div>{menu}</body>") == want
    loose = f"<div><p>{LONG}</p><p>{LONG}</p></div> in between <div><p>{LONG}</p></div>"
    assert main_text(f"<body>{menu}<div>{loose}</div>{menu}</body>") == f"{LONG} {LONG} in between {LONG}"
    # wrappers around one container change nothing
    assert main_text(f"<body>{menu}<div>{parts.replace('<div>', '<div><div><section>').replace('</div>', '</section></div></div>')}</div></body>") == want


def test_an_article_does_not_win_by_its_name():
    teaser = "<article><a href=/1>Another story, to be read, some day</a></article>"
    assert main_text(f"<body>{teaser * 6}<div><p>{LONG}</p><p>{LONG}</p></div></body>") == f"{LONG} {LONG}"


def slow_points(tree):
    """Points by their definition: every pair of a paragraph and an ancestor."""
    n = len(tree.tag)

    def chain(i):
        while i >= 0:
            yield i
            i = tree.parent[i]

    def block(i):
        return next(k for k in chain(i) if tree.tag[k] not in H.INLINE)

    texts = [(block(i), i, t) for i, t in tree.items if t.strip()]
    points, size, links = [0.0] * n, [0] * n, [0] * n
    for k in {b for b, _, _ in texts}:
        own = [t for b, _, t in texts if b == k]
        worth = 1 + sum(t.count(c) for t in own for c in ",،、，") + sum(len(t.strip()) for t in own) / 100
        if any(tree.soft[j] == j for j in chain(k)):
            worth *= H.SOFT
        above = list(chain(k))[1 if tree.tag[k] in H.PARAGRAPHS and tree.parent[k] >= 0 else 0 :]
        for level, up in enumerate(above[: H.LEVELS], 1):
            points[up] += worth / [1, 1, 2, *[3 * (m - 1) for m in range(3, H.LEVELS + 1)]][level]
    for b, i, t in texts:
        for k in chain(b):
            size[k] += len(t.strip())
            links[k] += len(t.strip()) if any(tree.tag[j] == "a" for j in chain(i)) else 0
    return [p * (1 - links[i] / size[i]) if size[i] else 0.0 for i, p in enumerate(points)]


def random_page(rnd, depth=0):
    out = []
    for _ in range(rnd.randint(1, 5)):
        kind = rnd.choice(["text", "p", "div", "section", "a", "b", "li", "h2", "div class=ad", "div class='post-content'", "nav", "br"])
        text = " ".join(rnd.choice(["word", "other,", "more", "x, y"]) for _ in range(rnd.randint(0, 30)))
        if kind == "text" or depth > 5:
            out.append(text)
        elif kind == "br":
            out.append("<br>")
        else:
            out.append(f"<{kind}>{text}{random_page(rnd, depth + 1) if rnd.random() < 0.7 else ''}</{kind.split()[0]}>")
    return "".join(out)


def test_points_equal_the_slow_ones():
    rnd = random.Random(4)
    for _ in range(150):
        tree = H.parse(random_page(rnd))
        assert H.score(tree)[0] == pytest.approx(slow_points(tree))


def test_very_deep_pages_take_seconds():
    start = time.perf_counter()
    assert main_text("<div>x," * 100_000).startswith("x, x,")
    assert main_text("<b>x," * 100_000) == "x," * 100_000
    assert main_text("<div>" * 100_000 + f"<p>{LONG}" * 500) == " ".join([LONG] * 500)
    assert time.perf_counter() - start < 20


def test_every_page_of_the_table_has_its_paragraphs(spark, sf_dir):
    import re

    from gridloom.llm.queries import QUERIES

    found = {r["page_id"]: r for r in QUERIES["op8_main_text"](spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").where("html is not null").collect()
    for r in pages:
        for article in re.findall("<article>(.*?)</article>", r["html"], re.S):
            want = " ".join(H.entities.unescape(re.sub("<script.*?</script>|<style.*?</style>|<!--.*?-->", " ", article, flags=re.S) and re.sub("<(?!/?(b|i|em|strong|a|span)[ >])[^>]*>", " ", re.sub("<script.*?</script>|<style.*?</style>|<!--.*?-->", " ", article, flags=re.S))).split())
            assert re.sub("<[^>]*>", "", want) in found[r["page_id"]]["text"]
