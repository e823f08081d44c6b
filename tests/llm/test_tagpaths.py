"""Main text of literal pages, and of all driver pages against their sources."""

import pytest
from tests.conftest import DATA

from caresift.llm import tagpaths

PAGES = {
    "": "",
    "plain text, no tags": "plain text, no tags",
    "<article><h1>T&amp;C</h1><p>a  b\n c<p>d&nbsp;<b>e</b>f</article><footer>no</footer>": "T&C\na b c\nd ef",
    "<nav><a>menu</a></nav><main><header><h1>H</h1></header><p>x</p><aside>no</aside><form>no <input></form></main>": "H\nx",
    "<header>no</header><article>one<br>two<script>var t='</p><p>no';</script><style>no{}</style> three</article>": "one two three",
    "<article><div class='comments'><p>no</p></div><div id='cookie-notice'>no</div><section>yes</section></article>": "yes",
    "<article><ul><li>a<li>b <i>c</i></ul><table><tr><td>d<td>e</table><!-- no <p>no</p> --></article>": "a\nb c\nd\ne",
    "<article>a < b &lt; c<p title=\"x > y\">d</article>": "a < b < c\nd",
    "<html><head><title>no</title></head><body><div role=main>text<div hidden>no</div></div><div>no</div></body>": "text",
    "<article><p>&amp;amp; &#233;&#x4e2d; &bogus; &amp</p></article><article>two</article>": "&amp; é中 &bogus; &\ntwo",
    "<article><p>open <b>bold<p>next</b> rest": "open bold\nnext rest",
    "<ARTICLE><P>Upper</P></ARTICLE>": "Upper",
    "<article><p>x</p></article": "x",
}


@pytest.mark.parametrize("page", PAGES)
def test_literal(page):
    assert tagpaths.main_text(page) == PAGES[page]


def test_ratios_choose_without_marks():
    body = "".join(f"<p>Sentence {k}, with words; more of them follow here, and an end.</p>" for k in range(6))
    page = f"<body><div><span>Home</span></div><div><div>{body}</div></div><div>Copyright</div></body>"
    assert tagpaths.main_text(page).count("\n") == 5 and "Home" not in tagpaths.main_text(page)


BODY = "".join(f"<p>Sentence {k}, with words; more of them follow here, and an end.</p>" for k in range(6))


@pytest.mark.parametrize("short", ["<article><p>Short teaser</p></article>", "<div><article>Nice one!</article></div>"])
def test_a_short_article_does_not_suppress_the_page(short):
    page = f"<body><div><span>Home</span></div><div><div>{BODY}</div></div>{short}<div>Copyright</div></body>"
    got = tagpaths.main_text(page).split("\n")
    assert sum(x.startswith("Sentence") for x in got) == 6 and not {"Home", "Copyright"} & set(got)


KEPT = [
    "<body class='has-sidebar'><article>{}</article></body>",
    "<html class='no-menu'><body class='ad'><article>{}</article></body></html>",
    "<article class='post comments-open'>{}</article>",
    "<main id='share'>{}</main>",
    "<div class='x-social-y'><article>{}</article></div><p>no</p>",
    "<html><head><title>no</title><meta charset=utf-8><article>{}</article></html>",
    "<head><link rel=x>{}",
    "<body><form><nav>no</nav>{}<div class='comments'>no</div></form></body>",
    "<body><form><nav>no</nav><article>{}</article><div hidden>no</div></form></body>",
]


@pytest.mark.parametrize("page", KEPT)
def test_bars_do_not_empty_a_page(page):
    got = tagpaths.main_text(page.format(BODY)).split("\n")
    assert len(got) == 6 and all(x.startswith("Sentence") for x in got)


def test_hidden_text_alone_is_no_text():
    assert tagpaths.main_text("<body><div hidden><p>no</p></div></body>") == ""


def test_null_and_hostile_pages():
    assert tagpaths.main_text(None) == ""
    assert tagpaths.main_text("<article>" * 3000 + "deep") == "deep"
    assert tagpaths.main_text("<a <a " * 5000 + "x").count("<a") == 9_999
    assert len(tagpaths.main_text("<article>" + "<p>w.</p>" * 20_000)) == 20_000 * 3 - 1


def test_rows(spark):
    rows = [(1, None, None, "c"), (2, "u", "<article>Hi</article>", "c"), (2, "u", "<article>Hi</article>", "c"), (None, "v", "", "c")]
    got = tagpaths.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, None, "", 0), (2, "u", "Hi", 2), (2, "u", "Hi", 2), (None, "v", "", 0)], key=repr)
    assert tagpaths.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_driver_pages_are_documents(spark):
    """The pages were made from documents: a heading, then the document's lines."""
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet").select("text").collect()
    bodies = {"\n".join(x for x in (" ".join(line.split()) for line in r[0].split("\n")) if x) for r in docs}
    got = tagpaths.op7_tag_paths(spark, f"{DATA}/sf0.1").collect()
    assert all(r["text"].split("\n", 1)[1] in bodies for r in got)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
