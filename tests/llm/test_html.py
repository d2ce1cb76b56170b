import time

from lawloom.llm import html

LONG = "These are the many words of a paragraph that the page is read for, and more of them."


def test_parts_that_are_no_text():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="comments-on">
    <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad --><div class="ad-box">{LONG}</div>
    <article><h1>Title &amp; more</h1><p><b>{LONG}<br><p>Short.</p><form><input><label>Mail</label></form><aside>{LONG}</aside>
    <ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table><p>a&nbsp;b \n\t c&#x41;</p><div hidden>no</div></article>
    <section id="comments"><article><p>{LONG}</p></article></section><div role="complementary">{LONG}</div><div class="cookieNotice">{LONG}</div><footer>&copy; x</footer></body></html>"""
    assert html.main_text(page) == f"Title & more\n{LONG}\nShort.\none\ntwo\nc1\nc2\na b cA"


def test_without_an_article():
    page = f"<body><div id=top><a href=1>a</a> <a href=2>b</a></div><div class=content><h2>Head</h2><p>{LONG}</p><p>x</p><p>{LONG}</p></div><div class=sidebar>{LONG}</div></body>"
    assert html.main_text(page) == f"Head\n{LONG}\nx\n{LONG}"


def everything(lines):
    return {c for t, _, c, w in lines if t and w}


def test_ratios_decide():
    links = "".join(f"<div><a href={i}>{i}</a> <b>x</b> <i>y</i></div>" for i in range(9))
    page = f"<body><div>{links}</div><div>{f'<p>{LONG}</p>' * 5}<p>end</p></div></body>"
    assert html.main_text(page) == "\n".join([*[LONG] * 5, "end"])
    assert html.main_text(page, everything) != html.main_text(page)
    cards = "".join(f"<article><a href={i}>card {i}</a></article>" for i in range(4))
    page = f"<body>{cards}<div>{f'<p>{LONG}</p>' * 5}</div></body>"
    assert html.main_text(page) == "\n".join([LONG] * 5) != html.main_text(page, everything)


def test_a_short_section_between_long_ones_stays():
    part = "<section>" + f"<p>{LONG}</p>" * 5 + "</section>"
    short = "<section><ul>" + "<li>twenty letters or so</li>" * 6 + "</ul></section>"
    page = f"<body><nav>x</nav><div>{part}{short}{part}</div></body>"
    assert html.main_text(page) == "\n".join([*[LONG] * 5, *["twenty letters or so"] * 6, *[LONG] * 5])


def test_names_that_say_nothing_delete_nothing():
    for page in (f'<article class="post has-sidebar"><p>{LONG}</p></article>', f'<div class="content comments-open"><p>{LONG}</p></div>', f'<main><div class="related-work"><p>{LONG}</p></div></main>', f'<div class="comments"><p>{LONG}</p></div>'):
        assert html.main_text(f"<body><nav>x</nav>{page}</body>") == LONG
    page = f'<article><header><h1>H</h1></header><p>{LONG}</p><p><math>x = 1</math><svg><text>s</text></svg></p><section class="comment-list"><p>{LONG}</p></section></article>'
    assert html.main_text(f"<body><header>site</header>{page}</body>") == f"H\n{LONG}\nx = 1s"
    for name in ("comment-list", "adContainer", "top ad-banner", "site-footer", "cookieNotice", "ad"):
        assert html.named(name)
    for name in ("has-sidebar", "comments-open", "related-work", "content", "article", "", "adobe", "header2x-no menuett"):
        assert not html.named(name), name


def test_deep_pages_take_linear_time():
    n = 100_000
    began = time.time()
    assert html.main_text("<div>" + "<b>" * n + "</i>" * n + "x") == "x"
    assert html.main_text("<p><td>" + "<b>" * n + "<div>" * n + "x") == "x"
    assert html.main_text("<li>" * n + "x") == "x"
    assert html.main_text("<div>x" * n) == "\n".join("x" * n)
    assert time.time() - began < 20


def test_broken_and_empty_pages():
    assert html.main_text(None) == html.main_text("") == html.main_text("<nav>x</nav>") == html.main_text("<div></div>") == ""
    assert html.main_text("just text") == "just text"
    assert html.main_text("<p>a</p><![if x]><p>b</p><![<!x>c") == "a\nb\nc"
    assert html.main_text("<p>a < b</p>" + "<a " * 20000) == "a < b"
    assert html.main_text("<p>a<p>b</div></p><b>c") == "a\nb\nc"
    assert html.main_text("<article>" + "<p>w</p>" * 5000) == "\n".join(["w"] * 5000)
    assert html.main_text("<p>" + "<b>" * 3000 + "x") == "x"


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>é</p>", "t"), (1, "u", "<p>é</p>", "t"), (None, None, None, "t")], "page_id long, url string, html string, text string")
    assert sorted(((r.page_id, r.url, r.text) for r in html.extract(df).collect()), key=str) == [(1, "u", "é"), (1, "u", "é"), (None, None, "")]
    assert html.extract(df.limit(0)).count() == 0
