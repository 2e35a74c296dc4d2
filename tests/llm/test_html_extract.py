import html
import re

from pyspark.sql import functions as F

from salesmart.llm import html_extract
from salesmart.llm.html_extract import main_text


def article(page):
    """The text of the first article element of a simple page."""
    inside = re.search(r"<article>(.*?)(</article>|<footer|\Z)", page, re.S)[1]
    inside = re.sub(r"</?(p|h1|br)>", "\n", inside)
    return " ".join(html.unescape(re.sub(r"</?[a-z][^>]*>", "", inside)).split())


def test_pages_against_their_articles(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = html_extract.report(pages).collect()
    assert len(got) == pages.count()
    want = {r.page_id: article(r.html) for r in pages.collect()}
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)


BODY = "".join(f"<p>Sentence number {k}, with some words in it. It goes on, and ends.</p>" for k in range(6))
TEXT = " ".join(f"Sentence number {k}, with some words in it. It goes on, and ends." for k in range(6))


def test_noise_around_an_article():
    page = (f"<html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home, now.</a></ul></nav>"
            f"<div class='cookie-notice'>We use cookies, as all do. Fine.</div><main><article><h1>Title</h1>{BODY}"
            f"<aside>Related: things, more things.</aside><div class=ad>Buy now, buy here. Cheap.</div><form>Name: <input></form></article>"
            f"<section id=comments><p>First! I like it, a lot. Really, a very long comment it is, with many words in it.</p></section></main>"
            f"<footer>&copy; us</footer><script>var x='<p>no</p>';</script></body></html>")
    assert main_text(page) == "Title " + TEXT


def test_article_without_article_element():
    page = (f"<html><body><div id=top><a href=/>One</a> <a href=/>Two</a></div><div class=wrap><div class=c7><h2>Head</h2>{BODY}</div>"
            f"<div class=c8><ul><li><a href=/1>Link one</a><li><a href=/2>Link two</a></ul></div></div><div class=footer>End. Of, all.</div></body></html>")
    assert main_text(page) == "Head " + TEXT


def test_markup_details():
    assert main_text("<article><p>a&amp;b &lt;c&gt; &#233;&eacute; &notanentity; x<b>y</b>z<br>n\n\t m</p></article>") == "a&b <c> éé ¬anentity; xyz n m"
    assert main_text("<article><p>one<p>two<div>three</div>four") == "one two three four"
    assert main_text('<article><p title="a > b">t</p><!-- <p>no</p> --><script>"</p>"</script></article>') == "t"
    assert main_text("<article><p>cut o") == "cut o"
    assert main_text("plain text") == "plain text"
    assert main_text("<nav>menu</nav>") == "" and main_text("<") == "<" and main_text("a < b") == "a < b"
    assert main_text("<article>" + '<a "' * 3000 + "</article>") is not None
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert main_text(deep) == "deep"


def test_malformed_attributes_and_no_backtracking():
    assert main_text("<article><p title=it's>that's</p><p title='a > b' class=\"x < y\">t</p><p title=\"open>u</p>") == "that's t u"
    for text in ('<y ' + '"a" ' * 5000, "<y " + "='" * 5000, "<" * 20000, "<y " * 20000, "<!" * 20000, "<p a=" + "x" * 100000):
        assert main_text(text) is not None  # each takes a moment only


def test_edges(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "u", " "), (3, "u", "<article><p>" + "word, " * 60000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("mine"), "n_chars": F.lit(1)})
    got = {(r.page_id, r.n_chars) for r in html_extract.report(pages).collect()}
    assert got == {(1, 0), (2, 0), (None, 0), (3, 60000 * 6 - 1)}
    assert html_extract.extract(pages).columns.count("text") == 1
    assert html_extract.report(pages.limit(0)).count() == 0


def test_article_split_over_sections():
    first, second = (" ".join(f"Sentence {k} of part {part}, with some words in it. It goes on, and ends." for k in range(n)) for part, n in ((1, 6), (2, 4)))
    one, two = ("".join(f"<p>{s}ends.</p>" for s in t.split("ends.")[:-1]) for t in (first, second))
    page = (f"<html><body><div class=wrap><section id=s1><h2>One</h2>{one}</section><section id=s2>{two}</section>"
            f"<div class=c8><ul><li><a href=/1>Link one</a><li><a href=/2>Link two</a></ul></div></div></body></html>")
    assert main_text(page) == f"One {first} {second}"
