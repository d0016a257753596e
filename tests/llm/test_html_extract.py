import html
import random
import tracemalloc
from functools import reduce

from wayglint.llm.html_extract import best_path, extract, parse, path_hash, text_under

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div><div class="ad">Buy</div>
<div id="wrap-%d"><article class="post c%d"><h1>Title &amp; more</h1><p><b>First &lt;b&gt;
  line.<br><p>Second <a href="x">link</a> text &eacute;.</p><aside>Side</aside><div class="share-bar">Share</div><form><input>Send</form>
<ul><li>one<li>two</ul></article><div class="comments"><p>A long reader comment that goes on and on.</p></div></div><footer>&copy; F</footer></body></html>"""
MAIN = "Title & more\nFirst <b> line.\nSecond link text é.\none\ntwo"


def test_main_text_of_a_page():
    p = parse(PAGE % (1, 2))
    path = reduce(path_hash, ["html", "body", "div", "article.c.post"], 0)
    assert best_path(p) == path
    assert text_under(p, path) == MAIN
    assert text_under(p, path_hash(0, "section")) == MAIN


def test_odd_markup():
    own = lambda s: text_under(parse(s), None)
    assert own("") == own("<p") == own("<!-- x") == own("<script>x") == ""
    assert own("<") == "<"
    assert own("plain text &am") == "plain text &am"
    assert own("<body><p>a<p>b</body>") == "a\nb"
    assert own('<body><p title="x > y">a</p><p title="open>b</p><div>c') == "a\nb\nc"
    assert own("<BODY><MAIN><P>Up&nbsp;per &#233;&#x41;</MAIN>") == "Up per éA"
    assert own("<article>1 < 2 and 3 > 2</article>") == "1 < 2 and 3 > 2"
    assert own("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def test_hosts_vote(spark):
    rows = [(i, f"http://a.example/{i}", PAGE % (i, i)) for i in range(5)]
    odd = "<html><body><div class='comments-x'><article class='post c'><p>short</p></article></div><div><article class='c9 post'><p>tiny</p></article></div><section><p>" + "loud extra " * 30 + "</p></section></body></html>"
    rows += [(10, "http://a.example/odd", odd), (11, "http://b.example/", None), (12, None, "<p>x</p>"), (13, "", ""), (14, "http://a.example:80/q", PAGE % (7, 7))]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows] + [(None, "http://c/", "<p>x", "x", "y")], "page_id long, url string, html string, path string, host string")
    got = {x.page_id: x.text for x in extract(pages).collect()}
    assert len(got) == len(rows) + 1
    assert all(got[i] == MAIN for i in (0, 1, 2, 3, 4, 14))
    assert (got[10], got[11], got[12], got[13], got[None]) == ("tiny", "", "x", "", "x")
    assert extract(pages.limit(0)).collect() == []


def test_words_of_a_whole_page_do_not_empty_it():
    own = lambda s: text_under(parse(s), None)
    for words in ("has-sidebar", "navbar-fixed", "cookies-not-set", "comments-open"):
        page = f"<html class='{words}'><body class='{words}'><div class='sidebar'>Side</div><main id='{words}'><p>Whole text.</p></main></body></html>"
        assert own(page) == "Whole text."
    skip, ad, share = "<a href='#x'>Skip to content</a>", "<div class='ad'>Buy now</div>", "<div class='share'>Share</div>"
    assert own(f"<body>{ad}<article class='post ad-free'><p>The only text of the page.</p>{share}</article></body>") == "The only text of the page."
    assert own(f"<body>{skip}<div class='with-ads has-sidebar sidebar'><nav>Menu</nav>{ad}<div id='comments-open comments'><p>Deep text here.</p>{share}</div></div>").endswith("Deep text here.")
    assert own("<body><nav>Menu</nav><div class='ad'><form>Send</form></div></body>") == ""
    assert own("<div class='menu'>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def own(s):
    return text_under(parse(s), None)


def test_names_that_only_sound_like_boilerplate():
    text = "<p>First paragraph of the story.</p><p>Second one.</p>"
    want = "First paragraph of the story.\nSecond one."
    assert own(f"<body><nav>Menu</nav><article class='post legal-news'>{text}</article></body>") == want
    assert own(f"<body><div class='search-result-article'>{text}</div><div class='x'><p>Little.</p></div></body>") == f"{want}\nLittle."
    assert own(f"<body><div class='search-result-article'>{text * 9}</div><div class='x'><p>Little.</p></div></body>") == "\n".join([want] * 9)
    assert own(f"<body><article>{text}<section class='related-work'><p>Others did.</p></section></article></body>") == f"{want}\nOthers did."
    assert own(f"<body><header><h1>Site</h1></header><article><header><h1>Headline</h1></header>{text}</article></body>") == f"Headline\n{want}"
    assert own(f"<body><article><div class='post-header'><h1>Headline</h1></div>{text}<div class='post-footer'>By A.</div></article></body>") == f"Headline\n{want}"
    assert own(f"<body><div class='legalNotice'>Mind this.</div><div>{text}</div></body>") == want


def test_places_without_names():
    menu = "<a href='/1'>Home</a> <a href='/2'>About us</a> <a href='/3'>Contact</a>"
    text = "<p>" + "A sentence of the main text, with some length. " * 6 + "</p>"
    want = "\n".join([("A sentence of the main text, with some length. " * 6).strip()] * 3)
    for a, b, c in (("", "", ""), (" class='x1'", " class='x2'", " class='x3'")):
        assert own(f"<body><div{a}>{menu}</div><div{b}>{text * 3}</div><div{c}>Imprint: A Street 1, B Town</div></body>") == want
    assert own(f"<body><div><div>{menu}</div><div><h1>Title</h1>{text * 3}</div></div></body>") == f"Title\n{want}"
    assert own(f"<html><head><title>x</title><body><div><div>{text}</div><div>{text}</div><div>{text}</div></div></body>") == want
    assert own(f"<body><div class='ad'>Longer than the story.</div><article>Hi.</article></body>") == "Hi."
    assert own("<body><div class='ad'>Only an advert.</div><article></article></body>") == ""


def test_generated_pages(spark):
    """The text that a page was made of comes back, whatever boilerplate, nesting and host style is put round it."""
    r = random.Random(5)
    words = "alpha Béta gamma, delta. epsilon & zeta <eta> theta \"iota\" kappa; lambda".split(" ")
    say = lambda n: " ".join(r.choices(words, k=n))
    junk = [
        lambda: "<nav><ul>" + "".join(f"<li><a href='/{i}'>{say(1)}</a></li>" for i in range(5)) + "</ul></nav>".replace("&", "&amp;"),
        lambda: f"<div class='{r.choice(['ad', 'ads', 'cookie-notice', 'side-bar', 'shareBar', 'related-posts', 'ad-container'])}'>Some boilerplate</div>",
        lambda: "<footer>The end</footer>", lambda: "<aside><p>Aside text</p></aside>", lambda: "<form><p>Mail</p><input name=q></form>",
        lambda: "<script>var a = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> -->",
        lambda: f"<section id='comments'>{'<p>A reader says so.</p>' * r.randint(1, 40)}</section>",
        lambda: "<div><a href='/a'>Home</a> <a href='/b'>Away</a></div>",
    ]
    rows, want = [], {}
    for host in range(6):
        outer = r.choice([("<article class='c%d'>", "</article>"), ("<main>", "</main>"), ("<div class='story-%d'>", "</div>"), ("<div><div class='txt'>", "</div></div>")])
        for _ in range(8):
            blocks = [say(r.randint(25, 40)) for _ in range(r.randint(3, 7))]
            body = ""
            for b in blocks:
                body += r.choice(["<p>%s</p>", "<p><b>%s</b>", "<section><p>%s</p></section>", "<ul><li>%s</ul>"]) % html.escape(b).replace(" ", r.choice([" ", "\n  "]))
            body = "<h2>Head</h2>" + body + r.choice(junk[1:5])()
            some = lambda: "".join(j() for j in r.sample(junk, 3))
            n = len(rows)
            page = f"<!DOCTYPE html><html><head><title>t</title></head><body class='has-sidebar'>{some()}{outer[0].replace('%d', str(n))}{body}{outer[1]}{some()}</body></html>"
            want[n] = "\n".join(["Head", *blocks])
            rows.append((n, f"http://h{host}.example/{n}", page))
    got = {x.page_id: x.text for x in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {n: got[n] for n in want} == want


def test_deep_and_long_pages_take_room_in_proportion():
    def peak(n):
        tracemalloc.start()
        assert own("<div class='a b'>" * n + "deep" + "</div>" * n) == "deep"
        found = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return found

    assert peak(8000) < 6 * peak(2000)
    assert len(own("<article>" + "<p>One of many paragraphs.</p>" * 20_000 + "</article>").split("\n")) == 20_000
