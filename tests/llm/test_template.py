"""Main text of small pages, and of the given pages against a plain reading of their articles."""

import html
import re

import pytest
from pyspark.sql import functions as F

from shiftlode.llm.template import extract, read_page


def text(source):
    texts, content = read_page(source)[:2]
    return "\n".join(t for t, c in zip(texts, content) if c)


@pytest.mark.parametrize(
    "source, expected",
    [
        (None, ""),
        ("", ""),
        ("plain  text\n here", "plain text here"),
        ("<p>a<b>b</b>c &amp; d&nbsp;e &lt;p&gt;<p>f<br>g", "abc & d e <p>\nf g"),
        ("<p><b>x<br><p>y</p></b>z", "x\ny\nz"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"),
        ("<table><tr><td>a<td>b<tr><th>c</table>", "a\nb\nc"),
        ("<title>t</title><script>if (a < b) '<p>x</p>'</script><style>p{}</style><p>y<!-- <p>z -->", "y"),
        ("<p>a<script>never ends <p>b", "a"),
        ("<p>a<!-- never ends <p>b", "a"),
        ("a < b and c > d <3 &am &copy &#x41; &bogus;", "a < b and c > d <3 &am © A &bogus;"),
        ('<p title="a > b" data-x=\'<p>\'>q</p>', "q"),
        ("<nav><p>m</p></nav><header>h</header><main><h1>T</h1><p>x</p><aside>s</aside></main><footer>f</footer>", "T\nx"),
        ("<div>promo text</div><article class='comment-open'><header><h1>T</h1></header><p>x</p><footer>by me</footer></article><p>later</p>", "T\nx"),
        ("<article><p>x</p><section id='comments'><article><p>first!</p></article></section></article>", "x"),
        ("<div class='post'><p>x <span class='ad'>buy</span> y</p></div><div class='cookie-notice'><p>We</p></div><div class='sideBar'>s</div>", "x\ny\ns"),
        ("<form><p>n</p></form><div hidden>h</div><div style='display: none'>d</div><div role='banner'>b</div><p>x</p>", "x"),
        ("</p></div>a</article>b</nope><p/>c<1>", "ab\nc<1>"),
        ("<div class='main has-sidebar'><p>x</p><div id='sidebar-2'>s</div></div>", "x"),
        ("<DIV>Up<P CLASS=AD>gone</P></DIV>", "Up"),
    ],
)
def test_reading(source, expected):
    assert text(source) == expected


def test_deep_and_long_pages():
    assert text("<div>" * 3000 + "x" + "</div>" * 3000) == "x"
    assert len(text("<p>" + "word " * 400_000)) == 1_999_999


MENU = "<div class='x'><div><span>Home</span></div><div>News</div></div>"


def test_templates_are_deleted_where_they_recur(spark):
    pages = [(i, f"http://a.example/{i}", f"<body>{MENU}<div><p>own {i}</p><p>quoted</p></div></body>") for i in range(9)]
    pages += [(100 + i, f"http://b.example/{i}", f"<body>{MENU}<p>other {i}</p></body>") for i in range(2)]  # too few pages
    pages += [(200 + i, "http://c.example/", "<body><p>copy</p><p>of one</p></body>") for i in range(5)]  # one content
    pages += [(300 + i, f"//d.example:80/{i}", f"<body>{MENU}<article><p>said {i}</p><p>often</p></article></body>") for i in range(4)]
    pages += [(400, None, f"{MENU}<p>x</p>"), (401, "no host", MENU), (None, "http://e.example", None), (402, "http://e.example", "")]
    df = spark.createDataFrame([(*page, "t") for page in pages], "page_id long, url string, html string, text string")
    got = {(row["page_id"], row["text"]): row for row in extract(df).collect()}
    expected = [(i, f"own {i}") for i in range(9)] + [(100 + i, f"Home\nNews\nother {i}") for i in range(2)]
    expected += [(200 + i, "copy\nof one") for i in range(5)] + [(300 + i, f"said {i}\noften") for i in range(4)]
    expected += [(400, "Home\nNews\nx"), (401, "Home\nNews"), (None, ""), (402, "")]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert all(row["n_chars"] == len(row["text"]) for row in got.values())
    assert got[(300, "said 0\noften")]["n_template_blocks"] == 2
    assert extract(df.limit(0)).count() == 0


def test_given_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet".replace("sf0.001", "sf0.01"))
    got = {row["page_id"]: row["text"] for row in extract(pages).collect()}
    for page in pages.collect():
        article = page["html"].partition("<article>")[2].partition("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert got[page["page_id"]] == "\n".join(b for b in blocks if b)


def test_recurring_prose_of_articles_is_deleted_on_hosts_with_many_pages(spark):
    notice = "<p>Subscribe now</p><ul><li>Share</li><li>Print</li></ul><table><tr><td>Fees</td></tr></table>"
    article = lambda i, extra: f"<article><h2>title {i}</h2><p>said {i}</p>{extra}</article>"
    pages = [(i, f"http://many.example/{i}", f"<p>lead {i}</p><p>Every page</p>{article(i, notice)}") for i in range(12)]
    pages += [(100 + i, f"http://few.example/{i}", f"<p>lead {i}</p>{article(i, notice)}") for i in range(9)]
    # A quotation on a part of the pages stays, copies of a page count once.
    pages += [(200 + i, f"http://quotes.example/{i}", article(i, "<p>quoted</p>" if i < 10 else "")) for i in range(24)]
    pages += [(300 + i, f"http://copies.example/{i}", article(0, notice)) for i in range(15)]
    got = {r["page_id"]: r for r in extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    kept = "\nSubscribe now\nShare\nPrint\nFees"
    for i in range(12):
        assert got[i]["text"] == f"lead {i}\ntitle {i}\nsaid {i}" and got[i]["n_template_blocks"] == 5
    assert all(got[100 + i]["text"] == f"title {i}\nsaid {i}{kept}" for i in range(9))
    assert all(got[200 + i]["text"] == f"title {i}\nsaid {i}" + "\nquoted" * (i < 10) for i in range(24))
    assert all(got[300 + i]["text"] == f"title 0\nsaid 0{kept}" for i in range(15))


def test_words_of_names_delete_no_article_text():
    probes = "<h2 id='related-work'>a</h2><h2 id='comments'>h</h2><p class='notice-of-terms'>b</p><section class='social-history'>c</section><div id='ad-hoc-methods'>d</div>"
    assert text(f"<article>{probes}<p>x</p></article>") == "a\nh\nb\nc\nd\nx"
    assert text(f"{probes}<div class='related-posts'>r</div><div id='commentList'>q</div>") == "a\nb\nc\nd"


def articles_of(pages):
    for page in pages.collect():
        article = page["html"].partition("<article>")[2].partition("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        yield page["page_id"], "\n".join(b for b in blocks if b)


def test_counts_alone_find_the_content(spark, folder):
    """The given pages with names that no list knows: menus and adverts differ from page to page, their paths do not."""
    pages = spark.read.parquet(f"{folder}/pages.parquet".replace("sf0.001", "sf0.1"))
    named = {"nav>": "div>", 'div class="ad">': "div>", "footer>": "section>", "article>": 'div class="w4">'}
    renamed = F.col("html")
    for old, new in named.items():
        renamed = F.replace(renamed, F.lit(f"<{old}"), F.lit(f"<{new}"))
    for old, new in {"nav": "div", "footer": "section", "article": "div"}.items():
        renamed = F.replace(renamed, F.lit(f"</{old}>"), F.lit(f"</{new}>"))
    expected = dict(articles_of(pages))
    got = {r["page_id"]: r for r in extract(pages.withColumn("html", renamed)).collect()}
    assert {number: row["text"] for number, row in got.items()} == expected
    # As they are, names would do; the counts delete all the same blocks: the items of the menu, the advert and the footer.
    plain = {r["page_id"]: r for r in extract(pages).collect()}
    assert {number: row["text"] for number, row in plain.items()} == expected
    for page in pages.collect():
        parts = re.findall(r'<li>.*?</li>|<div class="ad">.*?</div>|<footer>.*?</footer>', page["html"], re.S)
        removed = sum(bool(re.sub("<[^>]*>", "", part).strip()) for part in parts)
        assert got[page["page_id"]]["n_template_blocks"] == plain[page["page_id"]]["n_template_blocks"] == removed


def test_paths_beside_the_content(spark):
    def page(i, side="", more=""):
        body = f"<h1>title {i}</h1><p class='lead'>lead {i}</p><div class='body-{i}'><p>{'said %d ' % i * 30}</p></div>"
        return f"<div class='top'>offer {i * 7}</div><div class='post'>{body}{more}</div><div class='x'>see {i}<div>and {i}</div></div>{side}"

    pages = [(i, f"http://many.example/{i}", page(i, f"<div class='once'>only {i}</div>" if i < 3 else "")) for i in range(12)]
    # Pages of another layout have no content path; copies of a page are one page; hosts with few pages keep all.
    pages += [(50 + i, f"http://many.example/g{i}", f"<div class='x'>gallery {i}</div>") for i in range(4)]
    pages += [(100 + i, f"http://few.example/{i}", page(i)) for i in range(9)]
    pages += [(200 + i, f"http://copies.example/{i}", page(0)) for i in range(30)]
    pages += [(300 + i, None, page(i)) for i in range(12)]
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    own = lambda i: f"title {i}\nlead {i}\n{('said %d ' % i * 30).strip()}"
    every = lambda i: f"offer {i * 7}\n{own(i)}\nsee {i}\nand {i}"
    assert all(got[i] == own(i) + f"\nonly {i}" * (i < 3) for i in range(12))
    assert all(got[50 + i] == f"gallery {i}" for i in range(4))
    assert all(got[100 + i] == every(i) for i in range(9)) and all(got[300 + i] == every(i) for i in range(12))
    assert all(got[200 + i] == every(0) for i in range(30))
