import html
import re
import time

import pytest

from quillsift.llm import html_extract as X
from quillsift.llm.html_tree import parse


@pytest.fixture(scope="module")
def trees(spark, folder):
    return X.train(spark.read.parquet(f"{folder}/pages.parquet"))


def article(source):
    """Of the given tables: the blocks of the article element, by a pattern."""
    inner = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
    blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_given_pages_give_their_articles(spark, folder, trees):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    rows = X.extract(pages, trees).collect()
    assert len(rows) == pages.count()
    assert [r["page_id"] for r in rows if r["text"] != article(r["html"])] == []


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("just &lt;text&#x21;", "just <text!"),
        ("<p>a<p>b<div>c</div>d", "a\nb\nc\nd"),
        ("<article><p>one\n two&nbsp;<b>th</b>ree<br>four</p><script>var x = '</p>';</script><!-- <p>no</p> --><p>x &amp; y</p>", "one two three four\nx & y"),
    ],
)
def test_parsing(trees, source, text):
    assert "\n".join(t for _, t, _ in parse(source).blocks) == text


def test_other_layouts(trees):
    story = "A long paragraph of the story, with several words. And another sentence."
    source = (
        "<html><body><div id='cookie-banner'>We use cookies on this site.</div><header><a href='/'>Home</a></header>"
        "<div class='sidebar'><h3>Popular</h3><ul><li><a href='/x'>Some link</a></li><li><a href='/y'>Other link</a></li></ul></div>"
        f"<div class='post-content'><h1>Title of it</h1><p>{story}</p><p>{story} <a href='/z'>More here</a>.</p><div class='advert'>Buy now</div></div>"
        f"<section id='comments'><p>{story}</p></section><form><p>Subscribe to us</p></form><footer>Copyright</footer></body></html>"
    )
    assert X.main_texts([source], trees) == [f"Title of it\n{story}\n{story} More here."]


def test_choice_is_hierarchical(trees):
    page = parse("<div><p>a</p><div><p>b</p></div></div>")
    assert X.decode(page, [1.0, -9.0, 2.0, -1.0, 2.0]) == [True] + [False] * 4
    kept = X.decode(page, [1.0, -0.5, 2.0, -1.0, 2.0])
    assert kept == [True] * 5


def test_rows_columns_and_long_pages(spark, trees):
    long = "<article>" + "<p>word and word, again.</p>" * 20_000
    deep = "<div>" * 3000 + "<p>deep text</p>"
    rows = [(1, long, "t"), (1, long, "t"), (2, None, "t"), (3, deep, "t"), (4, '<p class="' * 300 + "<" * 500, "t")]
    got = X.extract(spark.createDataFrame(rows, "page_id long, html string, odds string"), trees).collect()
    assert [len(r["text"].split("\n")) for r in got[:2]] == [20_000] * 2 and got[2]["text"] == "" and got[0]["odds"] == "t"
    assert X.train(spark.createDataFrame([], "page_id long, html string")).feature


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<article><p>a</p><svg class=\"i\"/><p>all the rest</p></article>", "a\nall the rest"),
        ("<p>a</p><svg class='x>y' /><p>b</p><svg><path d='M0'/>no</svg><p>c</p>", "a\nb\nc"),
        ("<p>a</p><script src='x.js'/></script><iframe src=\"u\"/><p>b</p>", "a\nb"),
        ("<p>a</p><iframe src=http://x.org/>no</iframe><p>b</p><svg/>", "a\nb"),
    ],
)
def test_skipped_elements_closed_in_their_own_tag(source, text):
    assert "\n".join(t for _, t, _ in parse(source).blocks) == text


@pytest.mark.parametrize("piece", ['<svg x="', "<x-a>", "<", "<!", "<a b='", "<p x=\"'", "<!--", "<li>", "</p>", "<x-a></y-b>", "<p><td><x-a><hr>"])
def test_hostile_pages_are_read_in_linear_time(piece):
    size = (1 << 20) // len(piece)
    for text in (piece * size, piece * size + ">"):
        start = time.perf_counter()
        parse(text)
        assert time.perf_counter() - start < 10
    deep = "<x-a>" * 100_000 + "</y-b>" * 100_000 + "<p>end"
    assert [b[1] for b in parse(deep).blocks] == ["end"]


def test_tags_whose_quotes_never_close_end_at_their_first_bracket():
    assert [b[1] for b in parse('<p>one</p><p title="it>two</p><p>three</p>').blocks] == ["one", "two", "three"]
    assert [b[1] for b in parse("<p>a < b</p><p>c").blocks] == ["a < b", "c"]
