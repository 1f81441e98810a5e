import pytest

from airlens.llm.html_text import extract_pages, main_text

LONG = "A sentence of the article, long enough to count. Another one follows it; and a third."

CASES = [
    (None, ""), ("", ""), ("   ", ""), ("plain text &amp; more", "plain text & more"),
    (f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/x'>Menu"
     f"</a></li></ul></nav><!-- no --><div class=\"ad\">Buy now, now!</div><article><h1>Head &lt;1&gt;</h1><p><b>{LONG}<br><p>"
     f"Be.</p><p>{LONG}&nbsp;x</p></article><footer>&copy; 2020 All rights, reserved.</footer></body></html>",
     f"Head <1>\n{LONG}\nBe.\n{LONG} x"),
    (f"<body><header>Site, name</header><div id=main><h2>Title</h2><p>{LONG}</p><ul><li>one<li>two</ul><p>{LONG}"
     f"<form><input><label>Mail, please</label></form><section class='comments'><p>{LONG}</p></section></div>"
     f"<aside><p>{LONG}</p></aside><div class='cookie-notice'>We use cookies, sorry.</div>",
     f"Title\n{LONG}\none\ntwo\n{LONG}"),
    (f"<article><p>{LONG} <em>inline</em> x<b>y</b></p>\n<p>  a\n\t b </p></article>", f"{LONG} inline xy\na b"),
    (f"<article><h1>Only head</h1><p>{LONG}", f"Only head\n{LONG}"),
    (f"<article><p>{LONG}</p></span></b><p>end &unknown; &#233; &am</article>", f"{LONG}\nend &unknown; é &am"),
    (f"<article><p>{LONG}</p><p>cut <", f"{LONG}\ncut <"),
    (f"<article><p>{LONG}</p><!-- never closed <p>x</p>", LONG),
    (f"<div><p>{LONG}</p><script>never closed <p>x", LONG),
    (f"<body class='has-sidebar'><main class='with menu'><p>{LONG}</p></main><div class='sidebar'><p>{LONG}</p></div></body>", LONG),
    (f"<article><p>{LONG}</p><div id=\"comments\"><h2>2 comments</h2><p>{LONG}</p></div><p>End.</p></article>", f"{LONG}\nEnd."),
    (f"<div><article><h1>H</h1><p>{LONG}</p></article><section class=related><p>{LONG}</p></section></div>", f"H\n{LONG}"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_main_text(page, text):
    assert main_text(page) == text


TEN = "".join(f"<li>{LONG}</li>" for _ in range(10))
LINES = "\n".join([LONG] * 10)
AROUND = "<div><a href='/'>Home</a></div>"

WHOLE_ARTICLES = [
    (f"<body>{AROUND}<div><h1>Head</h1><p>Intro, short.</p><ul>{TEN}</ul><p>{LONG}</p><p>End.</p></div></body>",
     f"Head\nIntro, short.\n{LINES}\n{LONG}\nEnd."),
    (f"<body>{AROUND}<div><h1>Head</h1><p>{LONG}</p><table>{TEN.replace('li>', 'td>').replace('<td>', '<tr><td>')}</table><p>End.</p></div>",
     f"Head\n{LONG}\n{LINES}\nEnd."),
    (f"<body>{AROUND}<div><h1>Head</h1><p>{LONG}</p><blockquote>{TEN.replace('li>', 'p>')}</blockquote><p>End.</p></div>",
     f"Head\n{LONG}\n{LINES}\nEnd."),
    (f"<body>{AROUND}<div><h1>Head</h1><section><p>{LONG}</p></section><section><h2>Two</h2>{TEN.replace('li>', 'p>')}</section>"
     f"<section><p>Last, short.</p></section></div>", f"Head\n{LONG}\nTwo\n{LINES}\nLast, short."),
    (f"<body>{AROUND}<div><h1>Head</h1><p>Be.</p><p>{LONG}<span class='ad'>Buy now!</span>{LONG}</p><p>End.</p></div>",
     f"Head\nBe.\n{LONG}\n{LONG}\nEnd."),
    (f"<body>{AROUND}<div><h1>Head</h1><div>{TEN.replace('li>', 'p>')}</div><p>End.</p></div>", f"Head\n{LINES}\nEnd."),
    (f"<body>{AROUND}<article><h1>Head</h1><ul>{TEN}</ul><p>End.</p></article><div>Imprint</div>", f"Head\n{LINES}\nEnd."),
]


@pytest.mark.parametrize("page, text", WHOLE_ARTICLES)
def test_an_article_is_more_than_its_largest_part(page, text):
    assert main_text(page) == text


OWN_PARTS = [
    (f"<article><h1 class='post-header'>Head</h1><p>{LONG}</p><h2 class=section-header>Two</h2><p data-id='x menu'>{LONG}</p></article>",
     f"Head\n{LONG}\nTwo\n{LONG}"),
    (f"<article><header><h1>Head</h1></header><p>{LONG}</p><section id='related-work'><h2>Related work</h2><p>{LONG}</p></section>"
     f"<p class='notice'>{LONG}</p></article>", f"Head\n{LONG}\nRelated work\n{LONG}\n{LONG}"),
    (f"<article><div class='section-header'><h2>Head</h2></div><p>{LONG}</p><div class='share-buttons'><i>Share</i> Post</div>"
     f"<p>{LONG} <span class='search-term'>found</span> on.</p></article>", f"Head\n{LONG}\n{LONG} found on."),
    (f"<article><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p><p><object data='a'>{LONG}</object></p></article>",
     f"{LONG} x=2 holds.\n{LONG}"),
    (f"<body><div class='page-with-menu'><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></div><p>Imprint</p></body>", f"Head\n{LONG}\n{LONG}"),
    (f"<article><p>{LONG}</p><div class='ad-slot'><p>{LONG}</p></div><ul class='comment-list'><li>{LONG}</ul><p>{LONG}</p></article>",
     f"{LONG}\n{LONG}"),
]


@pytest.mark.parametrize("page, text", OWN_PARTS)
def test_names_alone_do_not_drop_parts_of_an_article(page, text):
    assert main_text(page) == text


def test_pages(spark):
    rows = [(k, None if k % 2 else f"u{k}", p, "clash") for k, (p, _) in enumerate(CASES)] + [(None, None, None, None)]
    rows += [rows[4], rows[4]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = extract_pages(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    want = [(r[0], r[1], main_text(r[2]), len(main_text(r[2]))) for r in rows]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    assert extract_pages(pages.limit(0)).count() == 0


def test_very_long_page():
    page = "<article>" + f"<p>{LONG}</p>" * 20000 + "<p " + "x" * 100000
    assert main_text(page) == "\n".join([LONG] * 20000)


def test_pages_of_the_driver_table(spark):
    """All its articles stand in one element: a plain parse of that element must agree."""
    import html
    import re
    from airlens.llm.queries import op10_html_text, table
    from tests.conftest import SF_CHECK
    raw = {r.page_id: r.html for r in table(spark, SF_CHECK, "pages").collect()}
    for r in op10_html_text(spark, SF_CHECK).collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", raw[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split())
                  for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
