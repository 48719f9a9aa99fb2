"""Language by cross-parsing: how few phrases of a language's sample text spell a document."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airtrack.llm.common import in_small_batches, spots, without

UNDETERMINED = "und"
#: Bounds of the sample: documents per language, the length that they should be near to, characters per language after which no
#: further document is taken, and languages.
PIECES, PIECE_CHARS, SAMPLE_CHARS, MAX_LANGUAGES = 64, 500, 64_000, 256
#: Texts are parsed in blocks of so many bytes, so that long texts need no more memory than short ones.
BLOCK = 1024
#: Bytes of text that one vectorised pass takes.
PASS_BYTES = 1_000_000

_NOT_LETTERS = regex.compile(r"\P{L}+")
#: A character beyond ASCII that is no letter; without one, bytes can be normalised by table.
_ODD = regex.compile(r"[^\x00-\x7f\p{L}]")
_SPACED = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def held_out(id_col: str) -> F.Column:
    """True for the fifth of all ids that nothing is learned from; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def letters(text: str | None) -> bytes:
    """Lower case, letters only, anything between letters as one space."""
    if not text:
        return b""
    low = text.lower()
    if _ODD.search(low):
        return _NOT_LETTERS.sub(" ", low).strip().encode()
    return b" ".join(low.encode().translate(_SPACED).split())


def sample(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", pieces: int = PIECES,
    piece_chars: int = PIECE_CHARS,
) -> dict[str, bytes]:
    """Labelled text per language: at most ``pieces`` whole documents.

    Of each of ``pieces`` hash buckets of ids the document whose length is nearest to ``piece_chars`` is taken (ties: the smallest
    hash), so the sample does not depend on how rows are stored; none is added to a language that has :data:`SAMPLE_CHARS`
    already.  Only rows that are not held out, with a label and at least one letter, are learned from.  Of more than
    :data:`MAX_LANGUAGES` labels those with most such rows are learned.
    """
    spot, bucket = spots(5, pieces, id_col)
    usable = docs.filter(F.col(lang_col).isNotNull() & ~held_out(id_col) & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), bucket, spot, F.abs(F.length(text_col) - piece_chars).alias("far"), F.col(text_col).alias("text"),
    )
    picks = usable.groupBy("lang", "bucket").agg(F.min(F.struct("far", "spot")).alias("pick"), F.count(F.lit(1)).alias("n"))
    labels = picks.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).select("lang")
    rows = picks.join(F.broadcast(labels), "lang").select("lang", "bucket", "pick.*").collect()
    if not rows:
        return {}
    keys, room = [], {}
    for row in sorted(rows, key=lambda r: (r.lang, r.far, r.spot)):
        if room.get(row.lang, 0) < SAMPLE_CHARS:
            keys.append((row.lang, row.bucket, row.far, row.spot))
            room[row.lang] = room.get(row.lang, 0) + row.far + piece_chars
    kept = docs.sparkSession.createDataFrame(keys, usable.drop("text").select("lang", "bucket", "far", "spot").schema)
    found = usable.join(F.broadcast(kept), ["lang", "bucket", "far", "spot"]).groupBy("lang", "spot").agg(F.min("text").alias("text"))
    texts: dict[str, list[bytes]] = {}
    for row in sorted(found.collect()):
        texts.setdefault(row.lang, []).append(letters(row.text))
    return {lang: b" ".join(x for x in parts if x) for lang, parts in texts.items() if any(parts)}


def automaton(text: bytes, code: np.ndarray, width: int) -> np.ndarray:
    """Transitions of the suffix automaton of ``text`` as one array, ``state * width + symbol``.

    An entry is the next state times ``width``.  Where no substring continues, it is the bitwise complement of the state
    that a new phrase beginning with this symbol is in: negative entries are phrase ends.
    """
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in code[np.frombuffer(text, np.uint8)].tolist():
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    first = np.zeros(width, np.int64)
    for c, to in moves[0].items():
        first[c] = to
    dense = np.tile(~(first * width), (len(moves), 1))
    for state, out in enumerate(moves):
        for c, to in out.items():
            dense[state, c] = to * width
    return dense.ravel().astype(np.int32)


@lru_cache(maxsize=2)
def _model(samples: tuple[tuple[str, bytes], ...]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Languages, symbol of each byte, all automata in one array, and bits per phrase and language."""
    used = sorted({b for _, text in samples for b in text})
    code = np.zeros(256, np.int32)  # 0: a byte that no sample holds
    code[used] = np.arange(1, len(used) + 1)
    parts, starts, at = [], [], 0
    for _, text in samples:
        table = automaton(text, code, len(used) + 1)
        parts.append(np.where(table < 0, table - at, table + at))
        starts.append(at)
        at += len(table)
    bits = np.array([max(1.0, np.log2(len(text) + 1)) for _, text in samples])
    return [lang for lang, _ in samples], code, np.concatenate(parts), np.column_stack([starts, bits])


def phrases(texts: list[bytes], code: np.ndarray, table: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Phrases of every text (rows) per language (columns), blocks of all texts advancing side by side.

    A byte that no sample holds ends the phrase before it; the phrases that ends of blocks cut off are counted as one.
    """
    sizes = np.array([len(t) for t in texts])
    blocks = np.maximum(1, -(-sizes // BLOCK))
    owner = np.repeat(np.arange(len(texts)), blocks)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = np.repeat(np.cumsum(sizes) - sizes, blocks) + inner * BLOCK
    length = np.minimum(BLOCK, sizes[owner] - inner * BLOCK)
    order = np.argsort(-length, kind="stable")
    owner, begin, length = owner[order], begin[order], length[order]
    symbols = code[np.frombuffer(b"".join(texts), np.uint8)]
    active = np.searchsorted(-length, -np.arange(BLOCK), side="left")
    state = np.repeat(starts.astype(np.int32)[:, None], len(owner), axis=1)
    ended = np.zeros(state.shape, np.int32)
    for step in range(int(length.max(initial=0))):
        n = active[step]
        to = table.take(state[:, :n] + symbols[begin[:n] + step])
        ended[:, :n] += to < 0
        np.maximum(to, ~to, out=state[:, :n])
    counts = np.zeros((len(texts), len(starts)))
    np.add.at(counts, owner, ended.T)
    return counts + 1


def predict(
    docs: DataFrame, samples: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, lang_pred, score`` of every row.

    A text is cut into the longest substrings that occur in a language's sample; phrases times bits per phrase is the
    cross-entropy with that language, and the smallest wins (ties: the first label).  ``score`` is one minus the ratio of
    the best to the second, 1 with a single language.  Text that is null or has no letter, and any text when nothing was
    learned, is ``und`` with score 0.  The sample alone is sent to executors; its size is bounded by :func:`sample`.
    """
    learned = tuple(sorted(samples.items()))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            names, scores = [UNDETERMINED] * len(ids), np.zeros(len(ids))
            if learned:
                langs, code, table, columns = _model(learned)
                starts, bits = columns.T
                rows, texts, held = [], [], 0
                for i, cell in enumerate(column):
                    if text := letters(cell.as_py()):
                        rows.append(i)
                        texts.append(text)
                        held += len(text)
                    if held and (held > PASS_BYTES or i == len(column) - 1):
                        cost = phrases(texts, code, table, starts) * bits
                        best = cost.argmin(axis=1)
                        least = cost[np.arange(len(rows)), best]
                        cost[np.arange(len(rows)), best] = np.inf
                        scores[rows] = 1 - least / cost.min(axis=1)
                        for row, k in zip(rows, best):
                            names[row] = langs[k]
                        rows, texts, held = [], [], 0
            yield pa.record_batch([ids, pa.array(names, pa.string()), pa.array(scores)], names=["id", "lang_pred", "score"])

    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return in_small_batches(rows).mapInArrow(judge, schema)


def known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language can be told, all columns as they are."""
    found = predict(docs, sample(docs, id_col, text_col, lang_col), id_col, text_col)
    return without(docs, found.filter(F.col("lang_pred") == UNDETERMINED).select("id").distinct(), id_col)
