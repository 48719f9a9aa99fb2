"""Extraction against the article that pages were made of."""

import html
import re
import time

from airtrack.llm import main_text, queries

PAGES = "page_id long, url string, html string, text string, id int"


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


def test_real_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    found = queries.op10_main_text(spark, "/root/testdata/sf0.01").collect()
    assert len(found) == len(pages)
    for r in found:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, article(pages[r.page_id].html), len(r.text))


BODY = "<p>First &amp; best<br>part of\n  the &eacute;t&#233; text</p><div>Second <b>bo</b>ld part</div>"
TEXT = "First & best part of the été text\nSecond bold part"


def learned(spark):
    return main_text.weights(main_text.training_pages(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")))


def test_boilerplate_is_left_out(spark):
    score = learned(spark)
    around = [
        ("<nav><a href='/x'>Menu one</a></nav>", "<footer>The foot of it</footer>"),
        ("<header><h1>Site name</h1></header><aside>Side words</aside>", "<div class='comments'><p>I liked this a lot</p></div>"),
        ('<div id="cookie-notice">We use cookies</div>', "<form><label>Mail</label><input><button>Send</button></form>"),
        ("<!-- <p>no</p> --><script>var a='<p>x</p>';</script><style>p{}</style>", "<div class=advert>Buy this now</div>"),
    ]
    for before, after in around:
        for tag in ("article", "main"):
            page = f"<html><head><title>T</title></head><body>{before}<{tag}>{BODY}</{tag}>{after}</body></html>"
            assert main_text.extract(page, score) == TEXT
            inside = f"<html><body><{tag}>{BODY}{before}{after}<p>Last words</p></{tag}></body>"
            assert main_text.extract(inside, score).split("\n")[-1] == "Last words"
            assert len(main_text.extract(inside, score).split("\n")) == 3


def test_region_without_article(spark):
    page = f"<body><nav><ul><li><a>one</a></li><li><a>two</a></li></ul></nav><div class='content'>{BODY}</div><footer>end of page</footer></body>"
    assert main_text.extract(page, learned(spark)).split("\n")[-1] == "Second bold part"


def test_names_do_not_drop_an_article(spark):
    score = learned(spark)
    for opening in ('<article class="post has-form">', '<main id="search-results">', '<main><article class="post has-form">'):
        assert main_text.extract(f"<body><nav>Menu</nav>{opening}{BODY}", score) == TEXT
    page = f'<main>{BODY}<article class="comment-3"><p>I liked this a lot</p></article><article class="comment">Me too</article></main>'
    assert main_text.extract(page, score) == TEXT


def test_references_are_decoded_piece_by_piece(spark):
    assert main_text.extract("<article>a &<b>lt;</b> &amp;lt; b</article>", learned(spark)) == "a &lt; &lt; b"


def test_unclosed_tags_take_linear_time():
    for piece in ("<a ", "<a '", '<script x="', "<a b='>", "<"):
        begun = time.perf_counter()
        main_text.extract(piece * (1_000_000 // len(piece)), {})
        assert time.perf_counter() - begun < 4
    assert main_text.extract("<p>one</p>two <a href='", {}).split("\n")[0] == "one"


def best_by_trying(gains):
    return max([0.0, *(sum(gains[i:j]) for i in range(len(gains)) for j in range(i + 1, len(gains) + 1))])


def test_region_is_the_maximum():
    """With plain words and tags the kept words less the tags between them reach the best sum of any region."""
    score = {"tag i": -1.5, "tag /i": -1.5}
    for pattern in ("a b <i></i> c", "a <i></i><i></i> b c d", "<i></i> a b c <i></i> d e f g <i></i>", "a <i></i> b <i></i> c"):
        pieces = re.findall(r"</?i>|[a-z]", pattern)
        gains = [-1.5 if p[0] == "<" else 1.0 for p in pieces]
        text = main_text.extract(pattern, score)
        first, last = pieces.index(text.split()[0]), pieces.index(text.split()[-1])
        assert sum(gains[first : last + 1]) == best_by_trying(gains)


def test_edges(spark):
    score = learned(spark)
    rows = [(1, "u", None, "a", 1), (2, None, "", "a", 1), (3, "u", "no markup at all", "a", 1), (4, "u", "<p>a</p>", "a", 1), (4, "u", "<p>a</p>", "a", 1)]
    rows += [(None, "u", "<p>" * 20_000 + "deep" + "</div>" * 20_000, None, None), (5, "u", "<article><p>open &lt; words", None, 1), (6, "u", "<script>never closed", None, 1)]
    rows += [(7, "u", "<article>" + "<p>word</p>" * 30_000 + "</article>", None, 1), (8, "u", "<a b='", None, 1), (9, "u", "1 < 2 & 3", None, 1)]
    found = {}
    for r in main_text.main_text(spark.createDataFrame(rows, PAGES), score).collect():
        found.setdefault(r.id, []).append(r.text)
    assert found[1] == found[2] == found[6] == [""] and found[3] == ["no markup at all"] and found[4] == ["a", "a"]
    assert found[None] == ["deep"] and found[5] == ["open < words"] and len(found[7][0].split("\n")) == 30_000 and found[9] == ["1 < 2 & 3"]
    empty = spark.createDataFrame([], PAGES)
    assert main_text.training_pages(empty) == [] and main_text.main_text(empty, {}).count() == 0
    assert main_text.extract(f"<body><article>{BODY}</article></body>", {}).endswith("Second bold part")
