import pytest

from tests.llm.cases import CLASHING, _EXTRA, prose, written
from tidemark.llm.templates import Template, events, extract, main_text, page_tokens, tidy

PAGES = f"page_id long, url string, html string, {CLASHING}"


def article(k: int) -> str:
    return f"""<!DOCTYPE html><html><head><title>T {k}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head>
<body><header class="site"><a href="/">Home</a></header><nav><ul><li><a href="/a">{prose(k, 2)}</a></li><li>x</li></ul></nav>
<!-- ad --><div class="ad">Buy {prose(k + 9, 3)}</div><div id="cookie-notice">We use cookies</div>
<article><header><h1>Head {k} &amp; more</h1></header><p>First <b>bo</b>ld {prose(k + 50, 8)}<br>next&nbsp;line
<p>Second   p &lt;3 é<form><input value="q">Search</form></article><section class="comments"><article>Reader {k}</article></section>
<aside>Side</aside><footer>&copy; site {k}"""


def expected(k: int) -> str:
    return f"Head {k} & more First bold {prose(k + 50, 8)} next line Second p <3 é"


def plain(k: int) -> str:
    return (f"<html><body><div class=menu><a href=1>One</a> <a href=2>Two</a></div><div class=b1><p>{prose(k, 30)}</p></div>"
            f"<div class=b2>All texts of this site are the same below</div><div class=x9><a href=z>{prose(k, 3)}</a></div></body></html>")


def table(spark, folder, rows):
    return written(spark, folder, [(*r, *_EXTRA) for r in rows], PAGES)


@pytest.mark.parametrize("limit", [1 << 24, 0])
def test_main_text(spark, folder, limit):
    rows = [(k, f"http://News.example.org:80/{k}", article(k)) for k in range(8)]
    rows += [(100 + k, f"https://u@plain.example.net/{k}?a", plain(k)) for k in range(8)]
    rows += [(200, None, None), (201, "", ""), (202, "http://one.example.com", "no markup a < b &amp; c"),
             (203, "http://one.example.com/cut", "<html><body><article><p>kept <b>text</b> &mid <di"),
             (204, "http://long.example.com", "<main>" + "<p>word " * 50_000 + "</main>"), (None, "http://x.example.com", article(3)),
             (0, "http://News.example.org:80/0", article(0))]
    found = {}
    for r in main_text(table(spark, folder, rows), broadcast_bytes=limit).collect():
        found.setdefault(r.page_id, []).append(r.text)
    assert all(found[k] == [expected(k)] * (2 if k == 0 else 1) for k in range(8))
    assert all(found[100 + k] == [prose(k, 30)] for k in range(8))
    assert found[200] == found[201] == [""] and found[202] == ["no markup a < b & c"]
    assert found[203] == ["kept text &mid"] and found[204] == [" ".join(["word"] * 50_000)] and found[None] == [expected(3)]


def test_empty_table(spark, folder):
    assert main_text(table(spark, folder, [])).count() == 0


def test_tokens_are_told_apart_by_their_path():
    counts = page_tokens("<body><nav><ul><li>a<li>b</ul></nav><ul><li>c</li></ul></body>")
    assert counts["/body/nav/ul/li"] == 2 and counts["/body/ul/li"] == 1
    assert counts["/body/nav/ul>"] == 1


def test_text_of_the_template_is_left_out_only_outside_articles():
    page = "<body><div>Same</div><div>own words</div><article>Same</article></body>"
    constant = next(t for t in page_tokens("<body><div>Same</div></body>") if "#" in t)
    known = Template({constant: 1, "/body/article": 2, "/body/div": 3}, {"/body/div", "/body/article"})
    assert extract(page, known) == "own words Same"


def test_odd_markup():
    assert [tidy(e.text) for e in events("<p title=\"a>b\">x</p><script>if (a<b) '</p>'</script>y<!-- <p>z --> w") if e.text] == ["x", "y", "w"]
    assert [tidy(e.text) for e in events("a < b <3 &#65;&eacute;") if e.text] == ["a < b <3 Aé"]


@pytest.mark.parametrize("page", [
    "<body class='single-post has-sidebar'><p>Own words", "<html class='has-banner'><body><article><p>Own words",
    "<div class='content-sidebar-wrap'><div><article><p>Own words</article></div><div class='sidebar'>Side</div></div>",
    "<div class='sidebar-layout'><main class='with-sidebar'><p>Own words</main></div>", "<article class='post no-comments'><p>Own words</article>",
    "<div class='widget'><p>Own words</p></div><nav>Menu</nav>", "<body class='header-fixed'><div class='related-posts'><article>Other"
    "</article></div><div class='with-alert'><article><p>Own words</article></div><section class='comments'><article>Reader"])
def test_names_of_the_layout_are_no_asides(page):
    assert extract(page, Template({}, {""})) == "Own words"
    assert extract(page, Template({})) == "Own words"


def texts_of(spark, folder, pages: list[str], **options) -> list[str]:
    rows = [(k, f"http://host.example.org/{k}", page) for k, page in enumerate(pages)]
    return [r.text for r in main_text(table(spark, folder, rows), **options).orderBy("page_id").collect()]


@pytest.mark.parametrize("limit", [1 << 24, 0])
def test_text_behind_tokens_of_varying_order_stays(spark, folder, limit):
    figure, quote = "<figure><div>Fig {0}</div></figure>", "<blockquote>Said {0}</blockquote>"
    pages = [f"<body><article><h1>Head {k}</h1><div>Lead {k}</div>{(figure + quote if k % 2 else quote + figure).format(k)}"
             f"{'<p>More</p>' * (k + 1)}</article>" for k in range(6)]
    assert texts_of(spark, folder, pages, broadcast_bytes=limit) == [
        " ".join([f"Head {k} Lead {k}", *([f"Fig {k}", f"Said {k}"] if k % 2 else [f"Said {k}", f"Fig {k}"]), *["More"] * (k + 1)])
        for k in range(6)]


@pytest.mark.parametrize("limit", [1 << 24, 0])
def test_pages_of_several_templates_on_a_host(spark, folder, limit):
    page = "<body>{2}<div class='page'><p>See <a href=r>the full report {0}</a> today, {1}</p><ul><li><a href=x>Links {0}</a></li></ul></div>"
    pages = [f"<body><article><p>Own {k} {prose(k, 9)}</p></article><div class=x>Not it {k}</div>" for k in range(6)]
    pages += [page.format(k, prose(k, 20), "") for k in range(6, 9)]
    pages += [page.format(k, prose(k, 20), f"<div class='post-meta'>By X{k}</div>") for k in range(9, 12)]
    found = texts_of(spark, folder, pages, broadcast_bytes=limit)
    assert found[:6] == [f"Own {k} {prose(k, 9)}" for k in range(6)]
    for k in range(6, 12):
        assert found[k].startswith(f"By X{k} " * (k > 8) + f"See the full report {k} today, {prose(k, 20)}")


def test_words_in_links_stay_in_the_fallback():
    assert extract("<p>See <a>the full report</a> today<p><a>Home</a> x", Template({})) == "See the full report today"


def test_copies_and_pages_without_other_text_keep_it(spark, folder):
    body = "<body><div>The same <b>te</b>xt</div><p>Another passage</p>{}"
    copies = texts_of(spark, folder, [body.format("")] * 7)
    assert copies == ["The same text Another passage"] * 7
    stamped = [body.format(f"<nav>{k}</nav>") for k in range(7)]
    assert texts_of(spark, folder, stamped) == ["The same text Another passage"] * 7
    assert texts_of(spark, folder, [body.format(f"<p>Own {k}</p>") for k in range(7)]) == [f"Own {k}" for k in range(7)]


@pytest.mark.parametrize("page, text", [
    ("<p>a</p><svg class='icon' d='>'/><p>b</p><svg><text>no</text></svg>c", "a b c"), ("<SVG/>a<svg>no</svg>", "a"),
    ("<title-bar>a</title-bar><select-box>b</select-box><object-view>c</object-view><title>no</title>", "a b c"),
    ("<p>so <math><mi>x</mi><mo>=</mo><semantics><mn>1</mn><annotation encoding='tex'>no</annotation></semantics></math> holds", "so x=1 holds"),
    ("a<math/>b<p>c", "ab c")])
def test_raw_elements_end_where_they_do(page, text):
    assert extract(page, Template({})) == text


@pytest.mark.parametrize("page, text", [
    ("<article><p title=it's>Hello world</p><p>we don't stop</p></article>", "Hello world we don't stop"),
    ("<article><p title=\"a > b\" x='c > d' y = \"e>f\">One</p><p data-q=\"it's\">two's</p></article>", "One two's"),
    ("<article><p ' \">One</p><a href=x'y>two</a> three</article>", "One two three"),
    ("<article>A<!-- x --!> B<!--> C<!---> D<!-- <p>no</p> -->E<!-- open <p>no", "A B C DE"),
    ("<article>A<script src='a>b'>x</script >B<style>p</style\n>C<script>no</script x=y>D</article>", "A B C D"),
    ("<article>A<svg width=\"1\" title='>'/>B<svg><path d='x'/>no</svg>C</article>", "A B C"),
    ("<article>A <b class=\"x\" unclosed=\"q>B</b></article>", "A B"),
    ("<article><p =a='b>c' d>Hello</p></article>", "Hello"),
])
def test_quotes_count_only_behind_an_equals_sign(page, text):
    assert extract(page, Template({})) == text


def test_long_broken_tags_take_linear_time():
    for page in ("<p " + "a " * 200_000, "<p " + "=" * 200_000, "<p " + "='" * 100_001, "<svg " + "a='b' " * 50_000, "<!--" * 50_000):
        extract(f"<article>x{page}", Template({}))


@pytest.mark.parametrize("name", ["side-effects", "social-science", "related-work", "menu-items", "share-of-voice", "login-howto", "alert-systems"])
@pytest.mark.parametrize("tag", ["div", "section", "ul"])
def test_a_part_of_a_name_drops_no_article_text(name, tag):
    page = f"<body><article><p>Before.</p><{tag} class='{name}'><p>Inside <a href=x>with link</a> of it.</p></{tag}><p>After.</p></article></body>"
    assert extract(page, Template({})) == "Before. Inside with link of it. After."


@pytest.mark.parametrize("name", ["ad", "ad-slot", "share-buttons", "newsletter-signup", "socialShare", "comment-list", "user_comments", "x sidebar"])
def test_a_whole_name_is_an_aside_in_an_article_too(name):
    page = f"<body><article><p>Before.</p><div class='{name}'><p>Buy this now.</p></div><p>After.</p></article></body>"
    assert extract(page, Template({})) == "Before. After."


def test_what_is_in_doubt_needs_links_or_the_template(spark, folder):
    page = "<body><article><p>Before.</p><div class='related-reads'><a href=1>One</a> <a href=2>Two</a></div><p>After.</p></article></body>"
    assert extract(page, Template({})) == "Before. After."
    rows = [(k, f"http://doubt.example.org/{k}", f"<body><article><p>{prose(k, 20)}</p><div class='promo-of-week'><p>Buy this now</p></div>"
             f"<div class='side-effects'><p>{prose(k + 50, 9)}</p></div></article></body>") for k in range(6)]
    found = {r.page_id: r.text for r in main_text(table(spark, folder, rows)).collect()}
    assert found == {k: f"{prose(k, 20)} {prose(k + 50, 9)}" for k in range(6)}
