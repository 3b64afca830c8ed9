import math
import time

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshet.llm import html_text
from freshet.llm.html_text import extracted, main_text, parse

PARAGRAPHS = ["The first paragraph has quite a few words in it.", "The second one, too, says a good deal &amp; more.", "Short.", "A last &lt;p&gt; with caf&eacute; and&#32;&#x41;."]
TEXT = ["The first paragraph has quite a few words in it.", "The second one, too, says a good deal & more.", "Short.", "A last <p> with café and A."]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
NOISE = (
    "<nav><ul><li><a href=/a>Home</a></li></ul></nav><div class='ad top'>Buy this now, it is very good and cheap, really.</div>",
    "<aside>Related things that one could read instead of this, and so many of them.</aside><div id=comments><p>First comment, with a lot to say about it all.</p></div>"
    "<form><p>Your name and your mail address, please</p><input name=q></form><div role='dialog'>We use cookies to make it all better.</div>"
    "<footer>&copy; somebody, somewhere</footer><script>var x = '<p>not text</p>';</script><style>p{}</style>",
)


def test_article_without_what_stands_around_it():
    for around in (("<article><h1>Title</h1>", "</article>"), ("<main><h1>Title</h1>", "</main>"), ("<div class=text><h1>Title</h1>", "</div>"), ("<h1>Title</h1>", "")):
        page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{NOISE[0]}{around[0]}{BODY}{around[1]}{NOISE[1]}</body></html>"
        assert main_text(page) == "\n".join(["Title", *TEXT]), around


def test_noise_inside_the_article():
    page = f"<body><article>{PARAGRAPHS[0]}<div class='share-buttons'>Share</div>{BODY}<section class=comments><p>I say</p></section></article></body>"
    assert main_text(page) == "\n".join([TEXT[0], *TEXT])


def test_frames_named_after_what_they_have_beside_the_article():
    page = f"<body><div class='page with-sidebar'><div class=header>Site</div><article><div class='article-header'><h1>Title</h1></div>{BODY}</article><div class=sidebar>Links and such</div></div></body>"
    assert main_text(page) == "\n".join(["Title", *TEXT])
    assert main_text(f"<body><div class=related><article>{BODY}</article></div><article><p>Own text of the page</p></article></body>") == "Own text of the page"


def test_broken_markup():
    assert main_text("<article><p><b>One two three four five.<br><p>Two & two<p>a < b <i>c</i><!-- <p>no --><ul><li>x<li>y</ul>") == "One two three four five.\nTwo & two\na < b c\nx\ny"
    assert main_text("just text  with\n spaces") == "just text with spaces"
    assert main_text("<p>open <script>never closed </p>") == "open"
    assert main_text("<article><p>cut off in a ta<b cla") == "cut off in a ta<b cla"
    assert main_text("<p>a" + "<div>" * 5000 + "deep") in ("a\ndeep", "deep")


def test_white_space_and_blocks():
    assert main_text("<article><p>a\n\t b <span>c</span>d<br>e&nbsp;f</p>g<table><tr><td>h<td>i</table></article>") == "a b cd e f\ng\nh\ni"


@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<a href='x'>", "</a>", "text ", "&amp;", "&#x", "<", ">", "<!--", "-->", "<li>", "</ul>", "<b", '"', "<td>", "<script>", "</body>"]), max_size=25).map("".join))
def test_any_input_gives_text(html):
    assert parse(html).tag == "html"
    text = main_text(html)
    assert all(line == " ".join(line.split()) and line for line in text.split("\n")) or text == ""


def test_column(spark):
    rows = [(1, None), (2, ""), (3, f"<article>{BODY}</article>"), (3, f"<article>{BODY}</article>"), (4, "<article>" + BODY * 3000 + "</article>")]
    frame = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r["found"] for r in frame.select("page_id", extracted("html").alias("found")).collect()}
    assert got == {1: "", 2: "", 3: "\n".join(TEXT), 4: "\n".join(TEXT * 3000)}
    assert frame.limit(0).select(extracted("html")).count() == 0


def test_all_dense_parts_below_the_body():
    links = "<div><ul><li><a href=/a>Something else</a></li><li><a href=/b>And one more of these</a></li></ul></div>"
    for tag in ("section", "div"):
        assert main_text(f"<body>{links}<{tag}>{BODY}</{tag}><{tag}>{BODY}</{tag}>{links}</body>") == "\n".join(TEXT * 2)
        assert main_text(f"<body><{tag}>{BODY}</{tag}>{links}<{tag}>{BODY}</{tag}></body>") == "\n".join(TEXT * 2)
    assert main_text(f"<body><h1>T</h1><div>{BODY}</div>{links}</body>") == "\n".join(["T", *TEXT])
    assert main_text(f"<body><div>{BODY}</div><div>{links}<section>{BODY}</section></div></body>") == "\n".join(TEXT * 2)


def test_wrappers_that_hold_the_text_are_no_asides():
    links = "<nav><a href=/a>Home</a></nav>"
    wrappers = ["form id=aspnetForm", "div class=elementor-widget-container", "div class='page with-comments'", "div class=share-layout"]
    for wrapper in wrappers:
        end = f"</{wrapper.split()[0]}>"
        for page in (f"<{wrapper}><article>{BODY}</article>{end}", f"<article><{wrapper}>{BODY}{end}</article>", f"<{wrapper}>{links}<div>{BODY}</div>{end}"):
            assert main_text(f"<body>{links}{page}<footer>somebody</footer></body>") == "\n".join(TEXT), page
    assert main_text(f"<body><div class=widget>{BODY}</div></body>") == "\n".join(TEXT)
    assert main_text(f"<body><div class=widget><article>{BODY}</article></div></body>") == "\n".join(TEXT)


def test_asides_beside_the_text_stay_asides():
    small = "<form><p>Your name and mail, please</p></form><div class='share-buttons'>Share this</div><div class=comments><p>I say</p></div>"
    for start, end in (("<article>", "</article>"), ("<div>", "</div>")):
        assert main_text(f"<body>{start}{BODY}{small}{end}{small}</body>") == "\n".join(TEXT)
    assert main_text(f"<body><article><p>{TEXT[0]}</p><div class=comments>{BODY * 3}</div></article><div class=related-posts>{BODY}</div></body>") == TEXT[0]
    assert main_text(f"<body><div hidden><article>{BODY}</article></div><p>{TEXT[0]}</p></body>") == TEXT[0]


SENTENCES = "".join(f"<p>Sentence number {i} of the article has some words in it, more or less.</p>" for i in range(8))
COMMENTS = "".join(f"<p>Reader comment {i} says this and that about it, at some length and then more.</p>" for i in range(24))


def sentences(page):
    text = main_text(page)
    return text.count("Sentence"), text.count("Reader")


def test_articles_come_first_and_all_of_them():
    short = "<article><p>A short text of the article.</p></article>"
    assert main_text(f"<body>{short}<div id='responses'>{COMMENTS}</div></body>") == "A short text of the article."
    assert main_text(f"<body>{short}<div class=below>{COMMENTS}</div></body>") == "A short text of the article."
    for around in ("", "main", "div"):
        start, end = (f"<{around}>", f"</{around}>") if around else ("", "")
        assert sentences(f"<body>{start}<article>{SENTENCES}</article><article>{SENTENCES}</article>{end}</body>") == (16, 0)
    cards = "<article><a href=/x>Another article that one could read</a></article>" * 3
    assert sentences(f"<body><article>{SENTENCES}</article>{cards}</body>") == (8, 0) and "Another" not in main_text(f"<body><article>{SENTENCES}</article>{cards}</body>")
    assert sentences(f"<body><div>{SENTENCES}</div><div id=responses>{COMMENTS}</div></body>") == (8, 0)


def test_density_decides_on_sparse_names():
    for part in ("section id=login", "div class=menu-of-the-day", "div class=toolbar", "div id=header"):
        end = part.split()[0]
        assert sentences(f"<body><article>{SENTENCES}<{part}>{SENTENCES}</{end}></article></body>") == (16, 0), part
        assert sentences(f"<body><div>{SENTENCES}<{part}>{SENTENCES}</{end}></div></body>") == (16, 0), part
    login = "<div id=login><label>Name</label><input><label>Password</label><input><span>Go</span></div>"
    menu = "<div class=menu><ul><li><a href=x>One part of the site</a><li><a href=y>Another part of it</a></ul></div>"
    for start, end in (("<article>", "</article>"), ("<div>", "</div>")):
        page = f"<body>{menu}{start}{login}{SENTENCES}{menu}{end}{login}</body>"
        assert sentences(page) == (8, 0) and not any(w in main_text(page) for w in ("Password", "site"))


def counted(node):
    """Characters, tags, link characters and link tags below a node, by plain recursion."""
    totals = [0, 0, 0, 0]
    for child in node.children:
        if isinstance(child, str):
            totals[0] += len("".join(child.split()))
        elif not child.aside and child.tag not in html_text.UNSEEN:
            inner = counted(child)
            totals = [a + b for a, b in zip(totals, [inner[0], inner[1] + 1, inner[2], inner[3] + (child.tag == "a")])]
    if node.tag == "a":
        totals[2] = totals[0]
    return totals


def brute_density(node, body):
    chars, tags, link_chars, link_tags = counted(node)
    all_chars, _, all_links, _ = counted(body)
    if not chars:
        return 0.0
    t, lc, lt = max(1, tags), max(1, link_chars), max(1, link_tags)
    share = all_links / all_chars if all_chars else 0.0
    base = math.log(chars / max(1, chars - link_chars) * link_chars + share * chars + math.e)
    return chars / t * max(0.0, math.log(chars / lc * t / lt + 1e-9)) / base


PARTS = ["<p>", "</p>", "<div>", "</div>", "<a href='x'>", "</a>", "<li>", "<ul>", "</ul>", "<nav>", "</nav>", "<b>", "</b>", "some words here ", "x", "<script>y</script>", "<td>", "<br>"]


@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join))
def test_densities_equal_plain_recursion(html):
    root = parse(html)
    for node in html_text.measure(root):
        inner = [c for c in node.children if not isinstance(c, str) and not c.aside and c.tag not in html_text.UNSEEN]
        assert [node.chars, node.tags, node.link_chars, node.link_tags] == counted(node)
        assert node.density == pytest.approx(brute_density(node, root), rel=1e-12, abs=1e-12)
        assert node.density_sum == pytest.approx(sum(brute_density(c, root) for c in inner), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("part", ["<div>", "<a ", "<ul><li>x", "<article>", "<a x=\">\" ", "<span>x</b>", "<p>word ", "<div class=sidebar><article>x", "<table><tr><td>x", "<form><p>x</p>", "<div class=menu>x", "</", "<", "<b>x"])
def test_a_megabyte_of_awkward_markup_takes_seconds(part):
    page = part * (1_000_000 // len(part))
    start = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - start < 10


def test_quotes_that_hide_the_rest():
    assert main_text("<p>one</p><a title=\"x>two</a><p>three</p>") == "one\ntwo\nthree"
    assert main_text("<p>a</p><b x='>' y=\">\">bold</b> end") == "a\nbold end"
