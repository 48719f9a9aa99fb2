"""Main text of web pages: the contiguous region of a page whose words and tags score highest in sum."""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airtrack.llm.common import in_small_batches, spots

#: Pages that weights are learned from, at most.
TRAINING_PAGES = 512

# HTML vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style noscript template title textarea select option button iframe object svg math canvas audio video".split())
RAW = "script|style|noscript|template|textarea|title|svg|iframe"
CONTENT = frozenset("article main".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
SECTIONS = CONTENT | BOILERPLATE | frozenset(("section", "div", "body", "table", "ul", "ol"))
#: Words in class, id and role values that name parts of a page which are not its text.
LABELS = frozenset(
    "ad ads adv advert advertisement advertising adbox adslot banner banners breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus feedback footer form header masthead menu modal nav navbar navigation newsletter notice "
    "notices notification popup promo promoted promotion related replies reply respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar widget contentinfo complementary alert gdpr".split()
)

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|</?[a-zA-Z][^>]*>|<[!?/][^>]*>|[^<]+|<",
    re.S | re.I,
)
#: A last comment or raw element that goes on to the end of the page.
_UNENDED = re.compile(rf"<!--(?!.*-->\Z)|<({RAW})\b(?!.*</\1\s*>\Z)", re.S | re.I)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDES = re.compile(r"""\shidden(?=[\s=>/])|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none""", re.I)
_PART = re.compile(r"[a-z0-9]+")


def _marks(tag: str) -> list[str]:
    return [x.lower() for found in _MARKS.findall(tag) for value in found for x in value.split()]


def _is_boilerplate(name: str, marks: list[str], inside: bool) -> bool:
    """Whether an element is not part of the text.  The outermost ``article`` or ``main`` always is; one inside of it is not if one of
    its names begins with a label, as comments do that are articles of their own."""
    if name in CONTENT:
        return inside and any(part in LABELS for mark in marks for part in _PART.findall(mark)[:1])
    return name in BOILERPLATE or any(part in LABELS for mark in marks for part in _PART.findall(mark))


def tokens(page: str) -> list[tuple[str, str, str, bool, bool]]:
    """The page in order as ``(kind, feature, text, inside content, inside boilerplate)``.

    ``kind`` is ``word`` for text, ``tag`` for markup and ``block`` for markup that ends a block.  A text's feature is the
    element it belongs to: the nearest section or labelled element.  Hidden elements leave only a tag.
    """
    out: list[tuple[str, str, str, bool, bool]] = []
    open_: list[tuple[str, str, bool, bool, bool]] = [("", "body", False, False, False)]
    depth: Counter[str] = Counter()
    piece = ""
    closed = page.rfind(">") + 1  # no tag ends after it; searching for one from every "<" would take the square of the rest
    for m in _TOKEN.finditer(page, 0, closed):
        piece = m.group()
        _, place, inside, outside, hidden = open_[-1]
        if piece[0] != "<" or len(piece) == 1:
            if not hidden:
                out.append(("word", place, piece, inside, outside))
            continue
        if m.group(1) or not (name := _NAME.match(piece)):
            out.append(("tag", "raw" if m.group(1) else "other", "", inside, outside))
            continue
        name = name.group(1).lower()
        kind = "block" if name in BLOCKS else "tag"
        if piece[1] == "/":
            if depth[name]:
                while open_[-1][0] != name:
                    depth[open_.pop()[0]] -= 1
                depth[open_.pop()[0]] -= 1
            out.append((kind, "/" + name, "", *open_[-1][2:4]))
            continue
        marks = _marks(piece)
        apart = _is_boilerplate(name, marks, inside)
        if name not in VOID and not piece.endswith("/>"):
            label = f"{name}.{marks[0]}" if marks else name
            open_.append((
                name, label if marks or name in SECTIONS else place, inside or name in CONTENT and not apart,
                outside or apart, hidden or name in HIDDEN or bool(_HIDES.search(piece)),
            ))
            depth[name] += 1
        out.append((kind, name, "", inside, outside))
    if closed < len(page) and not open_[-1][4] and not _UNENDED.match(piece):
        out.append(("word", open_[-1][1], page[closed:], *open_[-1][2:4]))
    return out


def weights(pages: list[str]) -> dict[str, float]:
    """Score per word or tag, by feature, from pages that label their own text with an ``article`` or ``main`` element.

    Words of an element score the logarithm of how much more often it holds text inside than outside, between -3 and 1; tags
    score at most -0.1.
    """
    inner, outer = Counter(), Counter()
    for page in pages:
        found = tokens(page)
        if not any(t[3] for t in found):
            continue
        for kind, feature, text, inside, outside in found:
            if n := len(text.split()) if kind == "word" else 1:
                side = inner if inside and not outside else outer
                side[("word " if kind == "word" else "tag ") + feature] += n
    scale = (sum(outer.values()) + 1) / (sum(inner.values()) + 1)
    score = {}
    for key in inner.keys() | outer.keys():
        odds = math.log((inner[key] * scale + 1) / (outer[key] + 1))
        score[key] = max(-3.0, min(1.0, odds)) if key.startswith("word ") else max(-2.0, min(-0.1, odds))
    return score


def extract(page: str, score: dict[str, float]) -> str:
    """Blocks of the best region, joined by line feeds.

    Text in boilerplate elements scores -1 a word outside of a content element and nothing inside of one, and is left out of the
    result in any case.  Elements that the labelled pages do not hold score 1 a word.
    """
    found = tokens(page)
    best, best_from, best_to, run, run_from = 0.0, 0, 0, 0.0, 0
    for i, (kind, feature, text, inside, outside) in enumerate(found):
        if kind != "word":
            gain = score.get("tag " + feature, -0.2)
            gain = -0.01 if inside else gain
        else:
            n = len(text.split())
            gain = score.get("word " + feature, 1.0) * n
            if outside:
                gain = 0.0 if inside else min(-1.0 * n, gain)
            elif inside:
                gain = float(n)
        if run <= 0:
            run, run_from = 0.0, i
        run += gain
        if run > best:
            best, best_from, best_to = run, run_from, i + 1
    blocks, now = [], []
    for kind, feature, text, _, outside in found[best_from:best_to]:
        if kind == "word":
            if not outside:
                now.append(entities.unescape(text))
        elif feature == "br":
            now.append(" ")
        elif kind == "block":
            blocks.append("".join(now))
            now = []
    blocks.append("".join(now))
    clean = (" ".join(b.split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def training_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most: int = TRAINING_PAGES) -> list[str]:
    """At most ``most`` pages that hold an article or main element: the smallest hash of each of ``most`` buckets of ids."""
    spot, bucket = spots(10, most, id_col)
    labelled = pages.filter(F.col(html_col).rlike(r"(?i)<(article|main)\b")).select(
        spot, bucket, F.col(html_col).alias("html")
    )
    picks = labelled.groupBy("bucket").agg(F.min("spot").alias("spot"))
    found = labelled.join(F.broadcast(picks), ["bucket", "spot"]).groupBy("spot").agg(F.min("html").alias("html"))
    return [row.html for row in sorted(found.collect())]


def main_text(
    pages: DataFrame, score: dict[str, float], id_col: str = "page_id", html_col: str = "html"
) -> DataFrame:
    """``id, url, text`` of every row of ``pages``; ``text`` is empty where the page is null, empty or has no words.

    Words score positive and tags negative, with the weights of :func:`weights`; one scan finds the contiguous region with
    the largest sum (ties: the first).  Menus, headers, footers, sidebars, notices, adverts, forms and comments inside the
    region are left out, character references decoded, white space inside a block made one space.  Repeated rows give
    repeated results; other columns are ignored; pages of any length are read whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x, score) if (x := cell.as_py()) else "" for cell in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])

    schema = T.StructType([
        T.StructField("id", pages.schema[id_col].dataType), T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()),
    ])
    rows = pages.select(F.col(id_col).alias("id"), F.col("url").alias("url"), F.col(html_col).alias("html"))
    return in_small_batches(rows).mapInArrow(run, schema)
