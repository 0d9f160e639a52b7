"""Block extraction on awkward pages and against an independent reader of the test pages."""

import html
import re

import pytest
from pyspark.sql import types as T

from civicpanel.llm import html_text

LONG = "word " * 30 + "end."


@pytest.fixture(scope="module")
def tree(spark):
    return html_text.trained(spark)


def test_tree_learns_its_table(tree):
    import numpy as np

    rows = np.array(html_text.LABELLED, float)
    assert (html_text.classify(tree, rows[:, :-1]) == rows[:, -1].astype(bool)).all()


@pytest.mark.parametrize(
    "page, expected",
    [
        ("", ""),
        ("<article><p>One.<p>Two &amp; three&nbsp;&lt;4&#x41;</article>", "One. Two & three <4A"),
        ("<nav><a href='/'>Home</a></nav><article><h1>T</h1><p>A<br>b</p></article><footer>F</footer>", "T A b"),
        ("<article><p><b>Head.<br><p>Text  \n more</p></article><footer>&copy; x</footer>", "Head. Text more"),
        ("<article><p>a</p><script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> --><p>b", "a b"),
        (f"<article><p>{LONG}</p><section class='comments'><p>{LONG} reader</p></section></article>", LONG),
        (f"<div class='sidebar'><p>{LONG}x</p></div><main><p>ok</p></main><form><p>{LONG}y</p></form>", "ok"),
        (f"<div id=cookie-notice>{LONG}</div><div class='post'><p>ok <a href=x>link</a></p></div>", "ok link"),
        (f"<header><h1>Site</h1></header><article><header><h1>Own</h1></header><p>x</p></article>", "Own x"),
        ("<article><p>a</p><div class=\"ad\">Buy</div><p>b</p></article", "a b"),
        ("<article><p>a<b>b</b><i> c</i></p></div></span><p>1 < 2 &am", "ab c 1 < 2 &am"),
        (f"<body><ul><li><a>A</a><li><a>B</a></ul><h2>Title of it</h2><p>{LONG}</p><p>{LONG}</p><p>Go</p></body>",
         f"Title of it {LONG} {LONG}"),
        *((f"<article><p>a {tag} b</p><p>c</p></article>", "a b c") for tag in (
            "<svg width='1'/>", "<math/>", "<object data=x />", "<audio src=x />", "<video src=x>", "<iframe src=x />",
            "<video-player></video-player>", "<style-guide></style-guide>", "<svg><title>no</title><g><svg/><a>no</a></g></svg>",
            "<video><source src=x><p>no</p></video>", "<noscript><div>no</div></noscript>", "<script-x>", "<style>no</style >")),
        ("<article><div>a<svg><g>no</div><p>b</p></article><svg></svg>", "a b"),
        ("<article><p title='a>b'>x</p><p data-x=\"un'closed\">y</p></article>", "x y"),
    ],
)
def test_pages(tree, page, expected):
    assert html_text.main_text(page, tree) == expected


def test_awkward_rows(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<article>" + "<p>x</p>" * 50_000), (2, "u", "<p"), (2, "u", "<p")]
    schema = T.StructType(
        [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]
    )
    pages = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS text", "'z' AS n_chars")
    found = html_text.extract(pages).collect()
    assert sorted(r.n_chars for r in found) == [0, 0, 0, 0, 99_999]
    assert html_text.extract(pages.where("false")).collect() == []


def test_query_against_the_article_element(spark, data):
    from civicpanel.llm.queries import op8_html_text

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    for r in op8_html_text(spark, data).collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id] or "", re.S)
        plain = re.sub(r"</?(p|h\d|br|article)\b[^>]*>", " ", inside[1]) if inside else ""
        expected = " ".join(html.unescape(re.sub(r"<[^>]*(>|$)", "", plain)).split())
        assert r.text == expected and r.n_chars == len(expected)
