"""Quality rules on repetition: the characters of a text that stand inside repeated n-grams or lines.

Texts are cut into words, words into numbers.  Rolling hashes name the n-grams of each
length in ``LIMITS``; n-grams of a text that share a hash are compared word by word, so a
collision of hashes counts for nothing.  A word is covered at length n if it stands in an
n-gram that occurs at least twice in its text, the first occurrence included; the coverage
is the share of the words' characters that covered words hold.  Only places repeated at one
length can be repeated at the next, so each length looks at what the one before it left.
Lines count as repeated when an equal line stands before them.

A text passes if for every length its coverage is at most the limit, and the characters of
repeated lines and the symbols per word stay within theirs.  The limits shrink with n: a
repeated 3-gram is common in prose, a repeated 10-gram is not.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``, lines are split at \\n, those without a
word do not count; a NULL, empty or blank text has no words and fails the base rule; a text is
read whole however long it is (one text stays in one task); repeated rows are judged each by
itself; ties cannot arise; an empty table gives an empty result; other columns are ignored
(``keep`` hands them on, whatever their names).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as T

#: n-gram length -> largest percentage of characters inside repeated n-grams
LIMITS = {3: 50, 5: 30, 7: 25, 10: 20}
LINE_PCT = 30
SYMBOL_PCT = 10
BASE_N, BASE_WORDS, BASE_PCT = 5, 10, 20
SYMBOLS = b"#*$%&|<>"
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(text: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Exact integer sums of ``weight`` by text."""
    out = np.zeros(n, np.int64)
    np.add.at(out, text, weight)
    return out


def covered(code: np.ndarray, text: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """length -> which words stand in an n-gram that its text holds twice or more.

    ``code`` numbers the words, ``text`` the texts they are from, in order."""
    mix, h, out = T.mixed(code), T.mixed(text), {}
    alive = np.arange(len(code))
    for size in range(1, max(lengths) + 1):
        h = T.rolled(h, mix, size)
        if size not in lengths:
            continue
        at = alive[alive <= len(code) - size]
        at = at[text[at] == text[at + size - 1]]
        order, first = T.same(h[at], [text[at], *(code[at + j] for j in range(size))])
        twice = ~first
        twice[:-1] |= ~first[1:]
        alive = np.sort(at[order[twice]])
        edge = np.zeros(len(code) + 1, np.int64)
        edge[alive] += 1
        np.subtract.at(edge, alive + size, 1)
        out[size] = np.cumsum(edge)[:-1] > 0
    return out


def measure(column: pa.Array, lengths: list[int]) -> dict[str, np.ndarray]:
    """The measures of each text of a block: MEASURES, dup_line_chars and cover_<n>."""
    data, bounds = T.joined(column)
    n = len(column)
    word = ~_SPACE[data]
    lead = (data & 0xC0) != 0x80
    chars_to = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=chars_to[1:])
    text, start, end = T.runs(word, bounds)
    chars = chars_to[end] - chars_to[start]
    code, _ = T.numbered(T.strings(data, word, start, end))
    symbols = np.flatnonzero(_SYMBOL[data])
    out = {"n_words": _per_text(text, np.ones(len(text), np.int64), n), "word_chars": _per_text(text, chars, n),
           "n_symbols": _per_text(np.searchsorted(bounds, symbols, side="right") - 1, np.ones(len(symbols), np.int64), n)}
    inside = data != 0x0A
    line_text, line_start, line_end = T.runs(inside, bounds)
    words_to = np.zeros(len(data) + 1, np.int64)
    np.cumsum(word, out=words_to[1:])
    line_code, _ = T.numbered(T.strings(data, inside, line_start, line_end))
    real = np.flatnonzero(words_to[line_end] > words_to[line_start])
    order = real[np.lexsort((real, line_code[real], line_text[real]))]
    again = np.zeros(len(order), bool)
    again[1:] = (line_code[order[1:]] == line_code[order[:-1]]) & (line_text[order[1:]] == line_text[order[:-1]])
    dup = order[again]
    out["n_dup_lines"] = _per_text(line_text[dup], np.ones(len(dup), np.int64), n)
    in_dup = np.zeros(len(data) + 1, np.int64)
    in_dup[line_start[dup]] += 1
    in_dup[line_end[dup]] -= 1
    out["dup_line_chars"] = _per_text(text, chars * (np.cumsum(in_dup)[start] > 0), n)
    cover = covered(code, text, sorted({*lengths, BASE_N}))
    out["n_repeat_words"] = _per_text(text, cover[BASE_N].astype(np.int64), n)
    for size in lengths:
        out[f"cover_{size}"] = _per_text(text, chars * cover[size], n)
    return out


def verdict(m: dict[str, np.ndarray], limits: dict[int, int], line_pct: int, symbol_pct: int) -> tuple[np.ndarray, np.ndarray]:
    """(fails the base rule, passes all rules) of each text measured."""
    base = (m["n_words"] < BASE_WORDS) | (100 * m["n_repeat_words"] > BASE_PCT * m["n_words"])
    kept = ~base & (100 * m["n_symbols"] <= symbol_pct * m["n_words"])
    kept &= 100 * m["dup_line_chars"] <= line_pct * m["word_chars"]
    for n, pct in limits.items():
        kept &= 100 * m[f"cover_{n}"] <= pct * m["word_chars"]
    return base, kept


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: dict[int, int] | None = None,
          line_pct: int = LINE_PCT, symbol_pct: int = SYMBOL_PCT) -> DataFrame:
    """(doc_id, MEASURES, dup_line_chars, cover_<n>, base_failed, kept) of every row."""
    limits = dict(LIMITS if limits is None else limits)
    names = [*MEASURES, "dup_line_chars", *(f"cover_{n}" for n in sorted(limits))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in T.blocks(batches, "text"):
            m = measure(block.column("text"), sorted(limits))
            columns = [block.column("doc_id"), *(pa.array(m[x]) for x in names), *map(pa.array, verdict(m, limits, line_pct, symbol_pct))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names, "base_failed", "kept"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    columns = [f"doc_id {kind}", *(f"{x} long" for x in names), "base_failed boolean", "kept boolean"]
    return rows.mapInArrow(run, ", ".join(columns))


def keep(docs: DataFrame, text_col: str = "text", limits: dict[int, int] | None = None,
         line_pct: int = LINE_PCT, symbol_pct: int = SYMBOL_PCT) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns, in one pass over them."""
    limits = dict(LIMITS if limits is None else limits)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_place = pa.RecordBatch.from_arrays(batch.columns, names=[str(i) for i in range(batch.num_columns)])
            for block in T.blocks([by_place], str(at)):
                passes = verdict(measure(block.column(at), sorted(limits)), limits, line_pct, symbol_pct)[1]
                yield pa.RecordBatch.from_arrays(block.filter(pa.array(passes)).columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
