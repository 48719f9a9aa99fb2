"""Benchmark decontamination by pigeonhole edit matching."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airtrack.lineage import pin
from airtrack.llm.common import in_small_batches, without

#: Edits that a match may hold, as a share of the item's length.
ERROR_RATE = 0.08
#: Characters of benchmark text that one reading of the documents looks for; a larger benchmark is read in blocks.
BLOCK_CHARS = 2_000_000

_GAPS = re.compile(r"[\W_]+")
#: A character beyond ASCII that is neither letter nor digit; without one, bytes can be normalised by table.
_ODD = re.compile(r"[^\x00-\x7f](?<![^\W_])")
_SPACED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_WORDS = re.compile(r"[^\W_]+")


def normal(text: str | None) -> str:
    """Lower case; anything between letters and digits is one space."""
    if not text:
        return ""
    low = _lower(text)
    if _ODD.search(low):
        return _GAPS.sub(" ", low).strip()
    return b" ".join(low.encode().translate(_SPACED).split()).decode()


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) > 1 else c.lower() for c in text)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` consecutive pieces with their offsets; a match with so few edits holds one of them unchanged."""
    cuts = [len(item) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """Fewest edits between ``pattern`` and a substring of ``text``, and where the first such substring ends."""
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << len(pattern) - 1
    plus, minus, score, best = full, 0, len(pattern), None
    for end, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        vertical = eq | minus
        across = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | ~(across | plus) & full, plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(vertical | up) & full, up & vertical
        if score <= most and (best is None or score < best[0]):
            best = score, end
    return best


def find(text: str, search: ahocorasick.Automaton, items: list[tuple[object, str, int]]) -> list[tuple[int, int, int, int]]:
    """``item, edits, start, end`` of the best match of every item in a normalised text."""
    near: dict[int, list[tuple[int, int]]] = {}
    for end, owners in search.iter(text):
        for item, offset, size in owners:
            _, pattern, errors = items[item]
            start = end + 1 - size - offset
            near.setdefault(item, []).append((max(0, start - errors), start + len(pattern) + errors))
    out = []
    for item, windows in near.items():
        _, pattern, errors = items[item]
        windows.sort()
        merged = [list(windows[0])]
        for a, b in windows[1:]:
            if a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        best = None
        for a, b in merged:
            if (hit := myers(pattern, text[a:b], errors)) and (best is None or hit[0] < best[0]):
                best = hit[0], a + hit[1]
        if best:
            edits, end = best
            low = max(0, end - len(pattern) - edits)
            back = myers(pattern[::-1], text[low:end][::-1], errors)
            out.append((item, edits, end - back[1] if back else low, end))
    return out


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Where the characters ``start`` to ``end`` of the normalised text are in the text itself."""
    at, first, last = 0, None, 0
    for m in _WORDS.finditer(_lower(text)):
        size = m.end() - m.start()
        if at + size > start and first is None:
            first = m.start() + max(0, start - at)
        if at < end:
            last = m.start() + min(size, end - at)
        at += size + 1
        if at >= end:
            break
    return (first if first is not None else last), last


@lru_cache(maxsize=2)
def _search(block: tuple[tuple[object, str], ...], rate: float) -> tuple[ahocorasick.Automaton, list[tuple[object, str, int]]]:
    items = [(key, text, int(len(text) * rate)) for key, text in block]
    owners: dict[str, list[tuple[int, int, int]]] = {}
    for i, (_, text, errors) in enumerate(items):
        for offset, piece in pieces(text, errors):
            owners.setdefault(piece, []).append((i, offset, len(piece)))
    search = ahocorasick.Automaton()
    for piece, who in owners.items():
        search.add_word(piece, who)
    search.make_automaton()
    return search, items


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``id, item_id, edits, start, end``: the best match of every item in every document that holds it.

    An item of ``n`` normalised characters may differ by ``e = error_rate * n`` edits.  Cut into ``e + 1`` pieces, at least one
    piece of a match is unchanged; exact hits of all pieces are found in one scan of each whole text, and Myers'
    bit-parallel distance decides the surroundings of each hit.  ``start`` and ``end`` are code points of the document's
    own text; of equally good matches the first is given.

    The benchmark is a query set: it is dealt by a hash of the item into blocks of about ``block_chars`` characters, and the
    documents are read once per block, so that what is sent to executors stays bounded.  Items and documents that are null
    or have no letter or digit match nothing; repeated items count once; repeated documents give repeated rows; an empty
    table gives an empty result.
    """
    items = pin(
        benchmark.select(benchmark[item_col].alias("item_id"), benchmark[item_text_col].alias("text"))
        .filter(F.col("text").rlike(r"[\p{L}\p{N}]")).distinct()
    )
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    rows = in_small_batches(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).filter("text is not null"))
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("item_id", benchmark.schema[item_col].dataType),
        T.StructField("edits", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    ])
    result = None
    for k in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        block = tuple(sorted(((r.item_id, t) for r in own if (t := normal(r.text))), key=lambda x: (str(x[0]), x[1])))
        found = rows.mapInArrow(_scanner(block, error_rate, _arrow_types(schema)), schema)
        result = found if result is None else result.unionByName(found)
    return result


def _arrow_types(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _scanner(block: tuple[tuple[object, str], ...], rate: float, schema: pa.Schema):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            if block:
                search, items = _search(block, rate)
                for i, cell in enumerate(batch.column(1)):
                    raw = cell.as_py()
                    for item, edits, start, end in find(normal(raw), search, items):
                        out.append((batch.column(0)[i].as_py(), items[item][0], edits, *original_span(raw, start, end)))
            columns = list(zip(*out)) if out else [[]] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return scan


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    return without(docs, matches(docs, benchmark, id_col, text_col).select("id").distinct(), id_col)
