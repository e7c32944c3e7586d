import pytest
from pyspark.sql import functions as F

from shelfsense.functions import html
from shelfsense.sources import files, pages

LINKS = """<a href="/b">b</a> <a class=x href='c?q=1'>c</a> <a href="//h.org/d/#top">d</a>
<a href="mailto:me@x.org">m</a> <a href="/gone">g</a> <a href="../a">up</a>"""
PAGES = [
    (1, "http://h.org/a", f"<title>A</title><p>start</p>{LINKS}"),
    (2, "http://h.org/b", "<title>B</title>same text"),
    (3, "http://h.org/c", '<title>B</title>same text<a href="/hidden"></a>'),
    (4, "http://h.org/d", '<p>four</p><a href="e">e</a><a href="/a">back</a>'),
    (5, "http://h.org/e", '<p>five</p><a href="/deep">f</a>'),
    (6, "http://h.org/deep", "<p>six</p>"),
    (7, "http://h.org/hidden", "<p>seven</p>"),
]


@pytest.fixture(scope="module")
def stored(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


def walk(spark, stored, *seeds, **limits):
    frame = spark.createDataFrame(list(enumerate(seeds)), "position int, url string")
    result = pages.crawl(stored, frame, **limits)
    found = sorted((r["depth"], r["url"].removeprefix("http://h.org/")) for r in pages.crawl_summary(result).collect())
    return found, sorted(r["url"] for r in result.errors.collect())


def test_walk_by_levels(spark, stored):
    found, errors = walk(spark, stored, " http://h.org/a/?x=1 ", "", max_depth=2, max_pages=None)
    # c repeats the text of b, so it is dropped and its link is not followed.
    assert found == [(0, "a"), (1, "b"), (1, "d"), (2, "e")]
    assert errors == ["http://h.org/gone"]


def test_page_limit_ends_the_walk_in_queue_order(spark, stored):
    assert walk(spark, stored, "http://h.org/a", max_depth=2, max_pages=3) == ([(0, "a"), (1, "b"), (1, "d")], [])
    assert walk(spark, stored, "http://h.org/a", max_depth=3, max_pages=5)[0][-1] == (3, "deep")
    assert walk(spark, stored, "http://h.org/none", max_depth=1)[0] == []


def test_pages_join_the_collection(spark, stored):
    seeds = spark.createDataFrame([(0, "http://h.org/a")], "position int, url string")
    reviews = spark.createDataFrame([(1, 2, "t", "body", 4.0, "c")], "product_id long, customer_id long, product_title string, review_body string, star_rating double, product_category string")
    merged = {r["product_id"]: r for r in pages.add_pages(reviews, pages.crawl(stored, seeds, max_depth=0)).collect()}
    page = merged["http://h.org/a"]
    assert set(merged) == {"1", "http://h.org/a"}
    assert page["customer_id"] == "crawl:http://h.org/a" and page["product_category"] == "h.org" and page["star_rating"] is None


@pytest.mark.parametrize(
    "base, link, expected",
    [
        ("http://h.org/x/y", "z", "http://h.org/x/z"),
        ("http://h.org/x/y", "/z/?q#f", "http://h.org/z"),
        ("http://h.org/x/y", "//o.org:80/p/", "http://o.org:80/p"),
        ("http://h.org/x/y", "?q=1", "http://h.org/x/y"),
        ("http://h.org/x/y", "#top", "http://h.org/x/y"),
        ("http://h.org/x/y", "../../a/./b/../c", "http://h.org/a/c"),
        ("http://h.org/x/y", "HTTPS://O.org", "https://O.org/"),
        ("http://h.org/x/y", "mailto:a@b", "mailto:a@b"),
    ],
)
def test_resolve(spark, base, link, expected):
    frame = spark.createDataFrame([(base, link)], "b string, l string")
    assert frame.select(html.resolve_url(F.col("b"), F.col("l"))).first()[0] == expected


def test_visible_text_and_title(spark):
    page = """<!DOCTYPE html><title> T &amp;lt; </title><style>p{}</style><script>x="</p>"</script><!-- no <b>
    --><p>one<b> two </b>three</p>&eacute;&#8364;&#x41;&nbsp;<br>a < b &bogus;"""
    frame = spark.createDataFrame([(page, "u"), ("plain", "u")], "h string, u string")
    rows = frame.select(html.visible_text(F.col("h")), html.page_title(F.col("h"), F.col("u"))).collect()
    assert rows[0][0] == "T &lt; one two three é€A a < b &bogus;"
    assert rows[0][1] == " T &lt; " and tuple(rows[1]) == ("plain", "u")


@pytest.mark.parametrize(
    "markup, text",
    [
        ("&#9999999;&#x110000;&#0;&#xD800;", "\ufffd" * 4),
        ("it&apos;s &#128; &#x97;", "it's € —"),
        ("caf&eacute bar &notit; &amp;lt; &#38;lt;", "café bar ¬it; &lt; &lt;"),
        ('<p title="a>b">hi</p>', "hi"),
        ("<a title=it's href=x>one</a> it's", "one it's"),
        ('<p title="open>two', "two"),
    ],
)
def test_text_of_hostile_markup(spark, markup, text):
    frame = spark.createDataFrame([(markup,)], "h string")
    assert frame.select(html.visible_text(F.col("h"))).first()[0] == text


def test_links_and_title_of_hostile_markup(spark):
    page = """<!-- <title>no</title><a href="/no"></a> --><script>"<a href='/no'>"</script><title>yes</title>
    <a title="1>0" href="/q">x</a><a data-href="/no" HREF = 'two'>y</a><a href=three>z</a><a name=none>n</a><abbr href="/no">"""
    row = spark.createDataFrame([(page,)], "h string").select(
        html.page_title(F.col("h"), F.lit("u")), F.transform(html.page_links(F.col("h")), html.unquote_link)
    ).first()
    assert tuple(row) == ("yes", ["/q", "two", "three"])


def test_csv_and_tsv(spark, tmp_path):
    rows = [("p", "c", "t", ' He said "hi",\n then left ', 4.0, "k"), ("q", None, "t", "x", 1.0, "k")]
    frame = spark.createDataFrame(rows, files.REVIEW_SCHEMA)
    files.write_csv(frame, str(tmp_path / "csv"))
    assert [tuple(r) for r in files.read_reviews(spark, str(tmp_path / "csv")).collect()] == rows[:1]
    (tmp_path / "v.tsv").write_text("id\tn\textra\na\t1\tx\nbad line\nb\t2\ty\n")
    from pyspark.sql import types as T

    schema = T.StructType().add("id", "string").add("n", "integer").add("extra", "string")
    good = files.read_vendor_tsv(spark, str(tmp_path / "v.tsv"), schema, ["id", "n"])
    assert sorted(map(tuple, good.collect())) == [("a", 1), ("b", 2)]


def test_corpus_from_sources(spark):
    left = spark.createDataFrame([(2, "b"), (1, "a"), (3, None)], "id int, t string")
    right = spark.createDataFrame([("c", 4)], "t string, id int")
    rows = files.prepare_corpus([left, right], 2, [F.col("id").asc()]).collect()
    assert sorted(map(tuple, rows)) == [(1, "a"), (2, "b"), (4, "c")]
