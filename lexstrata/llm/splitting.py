"""Cutting long texts at natural boundaries (problem 2).

Method: pointer doubling. Every position where a piece could end is joined to the end of the piece that would follow it,
overlap included; this successor is found for all positions at once. Squaring the successor table (following it twice,
four times, ...) marks all cuts that the greedy walk from the start visits, in a logarithmic number of vector steps.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Unicode white space (fixed values), and what is left between it.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: What a word is: a run of characters that are not white space, or one of letters and digits.
WORDS = {"white": regex.compile(f"[^{WHITE}]+"), "alnum": re.compile(r"[^\W_]+")}
#: What ends a paragraph, sentence or clause: a blank line, or a mark, with what closes behind it, before white space.
BOUNDARY = re.compile(r"\n[ \t\r\xa0]*\n|[.!?…,;:–—][»”\"’)\]]*(?=\s|$)")


def word_number(text: str) -> int:
    """Number of runs of letters and digits."""
    return len(WORDS["alnum"].findall(text))


def boundaries(text: str, starts: np.ndarray) -> np.ndarray:
    """Numbers of words (rising) behind which the text has a natural boundary, from one pass over it."""
    ends = np.fromiter((m.end() for m in BOUNDARY.finditer(text)), dtype=np.int64)
    places = np.unique(np.searchsorted(starts, ends, side="left"))
    return places[places > 0]


def cuts(places: np.ndarray, n: int, limit: int, overlap: int) -> np.ndarray:
    """Ends (exclusive word numbers) of the pieces of a text of ``n`` words with natural boundaries behind ``places`` words.

    Every possible end is joined to the end of the piece that follows it, which starts ``overlap`` words before: its
    farthest legal successor, which is the last boundary within the limit that lies behind it and brings more than the
    overlap; where no boundary does, the word at the limit.
    """
    if n <= limit:
        return np.array([n] if n else [], dtype=np.int64)
    ends = np.arange(n + 1)
    starts = np.maximum(ends - overlap, 0)
    starts[0] = 0
    far = np.minimum(starts + limit, n)
    after = far.copy()
    if len(places):
        last = np.searchsorted(places, far, side="right") - 1
        found = np.where(last >= 0, places[np.maximum(last, 0)], -1)
        good = (far < n) & (found > np.maximum(ends, starts + overlap))
        after[good] = found[good]
    after[n] = n
    reached = np.array([after[0]])
    jump = after
    while True:  # all cuts within 2^k pieces, then 2^(k+1)
        wider = np.unique(np.concatenate([reached, jump[reached]]))
        if len(wider) == len(reached):
            return wider
        reached, jump = wider, jump[jump]


def pieces(text: str, limit: int, overlap: int, word: str = "white") -> list[tuple[int, int, int, int]]:
    """(first word, end word, first character, end character) of each piece; what stands between words goes with the one before."""
    spans = [m.span() for m in WORDS[word].finditer(text)]
    if not spans:
        return []
    overlap = min(max(overlap, 0), limit // 2)
    if len(spans) > limit:
        ends = cuts(boundaries(text, np.array([a for a, _ in spans])), len(spans), limit, overlap).tolist()
    else:
        ends = [len(spans)]
    starts = [0, *(max(0, e - overlap) for e in ends[:-1])]
    return [(a, b, spans[a][0] if a else 0, spans[b][0] if b < len(spans) else len(text)) for a, b in zip(starts, ends)]


def split_long(df: DataFrame, limit: int = 220, default_overlap: int = 40, keep_short: bool = False, id_col: str = "item_id", text_col: str = "testo", overlap_col: str | None = "split_overlap_words", word: str = "white") -> DataFrame:
    """The pieces of every text of more than ``limit`` words.

    Columns: ``id_col``, piece (from 0), pieces, split_word_start, word_count, overlap (words shared with the piece
    before), testo (the words with the white space between them as it was). Each piece has at most ``limit`` words and
    all words are in some piece. A word is a run of characters that are not Unicode white space, or with ``word`` alnum
    one of letters and digits. A null overlap means
    ``default_overlap``; it is at most half the limit and not below 0. Shorter texts give one piece with ``keep_short``
    and else no row; null, empty and blank texts give no row; repeated rows give their pieces each; other columns are
    ignored; an empty table gives no row.
    """
    schema = T.StructType([df.schema[id_col], *(T.StructField(n, T.IntegerType()) for n in ("piece", "pieces", "split_word_start", "word_count", "overlap")), T.StructField("testo", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows, out = [], []
                for i, (text, overlap) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                    # as many words need as many characters and spaces
                    if not text or (not keep_short and len(text) < 2 * limit):
                        continue
                    own = pieces(text, limit, default_overlap if overlap is None else overlap, word)
                    if len(own) < 2 and not keep_short:
                        continue
                    before = 0
                    for k, (a, b, c, d) in enumerate(own):
                        rows.append(i)
                        out.append((k, len(own), a, b - a, max(0, before - a), text[c:d].strip()))
                        before = b
                columns = list(zip(*out)) if out else [()] * 6
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int32())), *(pa.array(c, pa.int32()) for c in columns[:5]), pa.array(columns[5], pa.string())], names=schema.names)

    shared = F.col(overlap_col).cast("int") if overlap_col else F.lit(None).cast("int")
    return df.select(F.col(id_col), F.col(text_col).alias("_text"), shared.alias("_overlap")).mapInArrow(run, schema)
