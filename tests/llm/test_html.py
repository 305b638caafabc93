import html
import random
import re
import tracemalloc

import pyarrow.parquet as pq
import pytest

from tidemark.llm.html_text import extract_main_text, host_of, main_text, parse, path_of, templates

PAGES = "page_id long, url string, html string"


def alone(page):
    return main_text(page, [], set(), None)


def test_boilerplate_goes_and_the_rest_stays():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="with-sidebar"><div class="cookie-notice">We use</div>
    <header><h1>Site</h1></header><div id=nav>menu</div><div class="page has-sidebar"><main><article><header><h1 class="post-header">Title &amp; more</h1></header>
    <p>One <span class=ad>BUY</span> two<br>three&nbsp;<b>bold</b>ly<aside>side</aside><p>Four<form>f <input value="x"></form><ul><li>a<li>b</ul>
    <table><tr><td>x<td>y</table><section class="comments"><article class="comment"><p>c1</article></section><footer>foot</footer></article></main></div>
    <aside>s</aside><script>if (a<b) "</p>"</script><!-- c --><p>after</body>"""
    assert alone(page) == "Title & more\n\nOne two three boldly\n\nFour\n\na\n\nb\n\nx y\n\nafter"


def test_broken_markup():
    assert alone("") == "" and alone("   ") == "" and alone("plain  words\n") == "plain words"
    assert alone("<p>a</div></b><p>b<") == "a\n\nb<"
    assert alone("<p>a < b and c > d <a href='x") == "a < b and c > d"
    assert alone("<article><p>kept<!-- open") == "kept"
    assert alone('<p title="a > b">q</p><p class=\'ad">x</p><p>r') .startswith("q")
    assert alone("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert alone("&amp;lt; &#233; &unknown;") == "&lt; é &unknown;"


@pytest.mark.parametrize("attributes", [
    'style="overflow:hidden"', 'aria-hidden="false"', 'data-x="a" style=\'x: hidden\'', "data-class=comments", 'title="class=ad"', "href=/p?id=comments", 'href="/hidden-gems"',
])
def test_values_are_no_attributes(attributes):
    assert alone(f"<div {attributes}><p>One <a {attributes}>two</a> three</p></div>") == "One two three"
    assert alone(f"<article {attributes}><p>One <a {attributes}>two</a> three</p></article>") == "One two three"


def test_names_are_whole_inside_an_article_and_slugs_are_titles():
    for tag in ("article", "div"):
        body = '<h2 id="related-work">Related</h2><p>r</p><h2 id="market-share">Market</h2><section id="social-impact"><p>s</p></section><h3 id=comments>C</h3>'
        assert alone(f"<{tag}>{body}</{tag}>") == "Related\n\nr\n\nMarket\n\ns\n\nC"
    assert alone('<article><p class="share-price">p</p><p class="x ad">a</p><p id=comments>c</p><p role=search>s</p><p HIDDEN>h</p></article>') == "p"
    assert alone('<div id="site-header">h</div><div id="cookie-notice-2">c</div><div class="top-menu">m</div><div hidden="">x</div><p>t</p>') == "t"


def test_articles_in_comments_and_teasers_are_not_the_page():
    body = "The body of the page goes on for some time."
    assert alone(f"<div class=post>{body}</div><div id=comments><article>nice</article></div>") == body
    assert alone(f"<div class=post>{body}</div><div id=comments><article>{body * 3}</article></div>") == body
    assert alone(f"<div class=post>{body}</div><div class='related'><article>a</article><article>b</article></div>") == body
    assert alone(f"<div class=post>{body}</div><div class='has-promo'><article>a</article></div>") == body
    assert alone(f"<div class=post>{body}</div><div class=more><article>a</article></div>") == f"{body}\n\na"
    assert alone(f"<div class='page has-sidebar'><article>{body}</article><div class=related><article>a</article></div></div><p>after</p>") == f"{body}\n\nafter"


def test_forms_around_a_page_are_wrappers():
    body = "The body of the page goes on for some time."
    for page in (f"<article><h1>T</h1><p>{body}</p></article>", f"<div><h1>T</h1><p>{body}</p></div>", f"<main class='with-sidebar'><h1>T</h1><p>{body}</p></main>"):
        assert alone(f"<body><form method=post id=form1 class=form>{page}<form class=search>find</form></form><p>x</p></body>").startswith(f"T\n\n{body}")
    assert alone(f"<p>{body}</p><form>Name <input></form>") == body
    assert alone("<form>" * 3000 + "<article>deep</article>") == "deep"


def test_given_pages_against_a_plain_reading():
    for row in pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist():
        inner = re.search(r"<article>(.*?)(</article>|$)", row["html"], re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", p))).strip() for p in re.split(r"</?(?:p|h1)>|<br>", inner)]
        assert alone(row["html"]) == "\n\n".join(p for p in parts if p)


def site(n, body, extra=""):
    return f"<html><body><div class=top><p>All about sites</p></div>{extra}<div class=story>{body}</div><div class=bottom><p>Call us</p><p>page {n}</p></div></body></html>"


def test_template_of_a_host_without_articles(spark):
    rows = [(n, f"http://one.example.com/{n}", site(n, f"<h1>Head {n}</h1><p>Story {n} is long enough to be the free text here.</p>" * (1 + n % 2))) for n in range(8)]
    rows += [(50, "http://two.example.com/", site(50, "<p>Lone page</p>")), (51, None, None), (52, "http://one.example.com/x", "<p>Off the template</p>"), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' as host", "'y' as page", "1 as token", "2 as once")
    got = {r.page_id: r for r in extract_main_text(pages).collect()}
    for n in range(8):
        assert got[n].text == "\n\n".join([f"Head {n}", f"Story {n} is long enough to be the free text here."] * (1 + n % 2))
    assert got[50].text == "All about sites\n\nLone page\n\nCall us\n\npage 50"  # a single page has no template
    assert (got[51].text, got[51].n_chars, got[51].url) == ("", 0, None)
    assert got[52].text == "Off the template"
    assert extract_main_text(pages).count() == len(rows)
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert extract_main_text(pages.where("false")).count() == 0


def test_title_and_lead_beside_the_text_stay(spark):
    told = lambda n: f"<h1>Title {n}</h1><p>Lead of {'abcdefgh'[n]}</p><div class=text><p>{f'The long text {n * 7} of the story. ' * 9}</p></div>"
    single = lambda n: f"<h1>Chapter {n}</h1><div class=text><p>{f'A text {n * 7} and no more. ' * 9}</p></div>"
    rows = [(n, f"http://a.example.com/{n}", site(n, told(n))) for n in range(8)] + [(10 + n, f"http://b.example.com/{n}", site(n, single(n))) for n in range(8)]
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, PAGES)).collect()}
    for n in range(8):
        assert got[n].split("\n\n") == [f"Title {n}", f"Lead of {'abcdefgh'[n]}", (f"The long text {n * 7} of the story. " * 9).strip()]
        assert got[10 + n].split("\n\n") == [f"Chapter {n}", (f"A text {n * 7} and no more. " * 9).strip()]


def test_copies_of_an_article_are_not_taken_for_the_template(spark):
    page = "<body><nav>n</nav><article><p>The same story on every page.</p></article></body>"
    pages = spark.createDataFrame([(n, f"http://x.example.com/{n}", page) for n in range(10)], PAGES)
    assert {r.text for r in extract_main_text(pages).collect()} == {"The same story on every page."}


def test_no_window_over_a_host(spark):
    rows = [("h", f"<div class=a{n % 4}><p>shared {n % 4}</p></div><p>all</p>") for n in range(16)]
    hosted = spark.createDataFrame(rows, "host string, page string")
    made = templates(hosted)
    assert "Window" not in made._jdf.queryExecution().toString()
    p = path_of("", "p")
    assert [(r.once, [t.split("=")[0] for t in r.texts]) for r in made.collect()] == [([p], [p])]


def test_hosts_and_paths():
    assert host_of("http://A.Example.com:80/x") == "a.example.com"
    assert host_of(None) == host_of("::") == host_of("http://[") == ""
    elements, blocks = parse("<div class='a b'><p>x")
    outer = path_of("", "div.a-b")
    assert [p for p, _ in elements] == [outer, path_of(outer, "p")] and blocks[0].path == path_of(outer, "p")


def test_title_and_lead_before_an_article_stay():
    assert alone("<h1>Title</h1><p>lead</p><article><p>The text of the article, which is the longest part.</p></article>") == (
        "Title\n\nlead\n\nThe text of the article, which is the longest part.")


def words(pick, n):
    return " ".join("".join(pick.choice("abcdefghijklmnop") for _ in range(pick.randint(2, 9))) for _ in range(n))


def test_site_text_goes_from_anywhere_by_its_template_alone(spark):
    """Hosts whose classes tell nothing: site text before, inside and after the main element, articles of any shape."""
    pick, rows, kept, site_texts = random.Random(11), [], {}, {}
    for host in range(12):
        own = [words(pick, pick.randint(3, 12)) for _ in range(7)]
        tag, inner = pick.choice(["main", "article", "div"]), f"k{host}"
        for n in range(pick.choice([5, 9, 30])):
            blocks = [f"Head {words(pick, 3)}", *[words(pick, pick.randint(5, 60)) for _ in range(pick.randint(2, 8))]]
            body = "".join(f"<p>{b}</p>" for b in blocks[1:])
            page = (f"<body><div class=a><p>{own[0]}</p><ul><li>{own[1]}<li>{own[2]}</ul></div><{tag} class={inner}><div class=b><p>{own[3]}</p></div>"
                    f"<h1>{blocks[0]}</h1>{body}<div class=c><p>{own[4]}</p><p>{own[5]}</p></div></{tag}><div class=d><p>{own[6]}</p></div></body>")
            key = host * 100 + n
            rows.append((key, f"http://h{host}.example.com/{n}", page))
            kept[key], site_texts[key] = blocks, own
    got = {r.page_id: r.text.split("\n\n") for r in extract_main_text(spark.createDataFrame(rows, PAGES)).collect()}
    right = sum(len(set(got[k]) & set(kept[k])) for k in kept)
    assert right / sum(map(len, kept.values())) >= 0.95 and right / sum(len(got[k]) for k in kept) >= 0.95
    without = {k: alone(page).split("\n\n") for k, _, page in rows}
    assert all(set(site_texts[k]) <= set(without[k]) for k in kept)  # so it is the template that takes them out


def test_near_copies_of_an_article_stay_whole(spark):
    story = [f"The paragraph {n} that all copies share, word for word." for n in "abcdef"]
    rows = [(n, f"http://x.example.com/{n}", f"<nav>n</nav><article>{''.join(f'<p>{t}</p>' for t in story)}<p>Copy {'abcdefghij'[n]} ends so.</p></article>") for n in range(10)]
    for r in extract_main_text(spark.createDataFrame(rows, PAGES)).collect():
        assert r.text.split("\n\n") == [*story, f"Copy {'abcdefghij'[r.page_id]} ends so."]


def test_deep_and_long_pages_stay_small():
    tracemalloc.start()
    assert alone("<div class=x>" * 100_000 + "deep" + "</div>" * 100_000) == "deep"
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()
    long = "word " * 2_000_000
    assert alone(f"<article><p>{long}</p></article>") == long.strip()
