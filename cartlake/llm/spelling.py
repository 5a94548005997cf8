"""Spelling variants: words one edit apart, by search schemes over bidirectional FM-indexes.

Vocabulary.  Texts are cut into runs of letters; a documented rule deletes one letter of about
one run in 97 (planted misspellings).  Blocks count their results, Spark adds them up.

Search.  If two words differ by one edit, one half of the query stands unchanged in the
other word: its first half as a prefix or its rest as a suffix.  So the vocabulary is dealt
twice, by first and by last letters, as many as half a query has but KEY at most; a query
meets the words of its own prefix and of its own suffix only.  Keys are dealt to cells by
a hash.  Each cell holds an FM-index of its words, between delimiters:
wavelet matrices of the text and of the reversed text, whose suffix-rank intervals are kept
in step.  The scheme "prefix" matches the delimiter and the first half to the letter,
going left, then extends to the right across the other half with one error; "suffix"
is its mirror image.  At each place the symbols that occur in an interval give the
replaced and the inserted letters; skipping a letter of the query gives the deleted one.  The
interval of a whole delimited word is one rank, that of the word.  All queries of a cell
step together in numpy.

A cell of more than CELL_WORDS words is cut by a hash of the word into blocks of the index and
of the queries, each pair of blocks a task; no key is left to one task.

Forms and roots.  A word's form is its near word of largest count if that is at least
twice the word's own.  Roots come from pointer doubling: counts double at each step, so
log2(log2(count)) rounds of a join on a written table end it.

Defined results: runs are ``[A-Za-z\\u00C0-\\u00FF]+``, only A-Z are lower-cased; NULL and empty
texts have none; a NULL id reads as empty in the rule; long texts are read whole; repeated
rows each count; of near words as frequent the first in code-point order is the form; a word
without near words is its own root; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens as T
from .common import materialize, shuffle_width, text_or_empty

LEAST_CHARS, LEAST_COUNT, RATIO = 5, 3, 2
RULE = 97
KEY = 4
CELL_WORDS = 1 << 15
_TABLE_CHARS = 64
_BYTE = np.arange(256)
_ASCII = ((_BYTE >= 0x41) & (_BYTE <= 0x5A)) | ((_BYTE >= 0x61) & (_BYTE <= 0x7A))
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def _crc_steps() -> np.ndarray:
    """The byte table of CRC-32, from its polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_steps()


def block_words(ids: list, texts: pa.Array) -> Counter:
    """Counts of a block's resulting words of LEAST_CHARS letters or more.

    The CRC of ``<id>:<run>`` is that of the id, moved by the run's bytes, xor that of the
    run: one CRC per distinct run and one table per row, not one per occurrence."""
    data, bounds = T.joined(texts)
    data = _LOWER[data]
    letter = _ASCII[data] | (data == 0xC3)  # U+00C0 to U+00FF: 0xC3 and one more byte
    letter[1:] |= data[:-1] == 0xC3
    text, start, end = T.runs(letter, bounds)
    code, distinct = T.numbered(T.strings(data, letter, start, end))
    runs = distinct.to_pylist()
    own = np.array([zlib.crc32(r.encode()) for r in runs], np.uint32)
    heads = [f"{'' if i is None else i}:".encode() for i in ids]
    moved = np.zeros((_TABLE_CHARS + 1, len(heads)), np.uint32)
    moved[0] = [zlib.crc32(h) for h in heads]
    for n in range(1, _TABLE_CHARS + 1):
        moved[n] = _CRC[moved[n - 1] & 0xFF] ^ (moved[n - 1] >> 8)
    size = end - start
    short = size <= _TABLE_CHARS
    h = moved[np.where(short, size, 0), text] ^ own[code] if len(code) else np.zeros(0, np.uint32)
    for i in np.flatnonzero(~short):
        h[i] = zlib.crc32(runs[code[i]].encode(), zlib.crc32(heads[text[i]]))
    changed = h % RULE == 0
    counts = np.bincount(code[~changed], minlength=len(runs))
    out = Counter({runs[i]: int(counts[i]) for i in np.flatnonzero(counts) if len(runs[i]) >= LEAST_CHARS})
    for i in np.flatnonzero(changed):
        run = runs[code[i]]
        at = int(h[i]) % len(run)
        if len(run) > LEAST_CHARS:
            out[run[:at] + run[at + 1:]] += 1
    return out


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of every word that occurs ``least`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for block in T.blocks(batches, "text"):
            held.update(block_words(block.column("id").to_pylist(), block.column("text")))
            if len(held) >= 1 << 18:
                yield _counts(held)
                held = Counter()
        yield _counts(held)

    rows = docs.select(F.col(id_col).cast("string").alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _counts(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])


class Wavelet:
    """Rank and the distinct symbols of ranges of a sequence, by a wavelet matrix."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            to = np.zeros(len(bit) + 1, np.int32)
            np.cumsum(bit, out=to[1:])
            self.ones.append(to)
            self.zeros.append(len(bit) - int(to[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rank of ``symbol`` up to lo, up to hi, symbols below it in between)."""
        start, less = np.zeros_like(lo), np.zeros_like(lo)
        for level in range(self.bits):
            ones, zeros = self.ones[level], self.zeros[level]
            bit = (symbol >> (self.bits - 1 - level)) & 1
            one_lo, one_hi, one_start = ones[lo], ones[hi], ones[start]
            less += np.where(bit, (hi - lo) - (one_hi - one_lo), 0)
            lo = np.where(bit, zeros + one_lo, lo - one_lo)
            hi = np.where(bit, zeros + one_hi, hi - one_hi)
            start = np.where(bit, zeros + one_start, start - one_start)
        return lo - start, hi - start, less

    def distinct(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """(range, symbol, rank up to lo, up to hi, symbols below it in between) of every symbol of every range."""
        of, symbol = np.arange(len(lo)), np.zeros(len(lo), np.int64)
        start, less = np.zeros_like(lo), np.zeros_like(lo)
        for level in range(self.bits):
            ones, zeros = self.ones[level], self.zeros[level]
            one_lo, one_hi, one_start = ones[lo], ones[hi], ones[start]
            width0 = (hi - lo) - (one_hi - one_lo)
            left, right = width0 > 0, one_hi > one_lo
            join = lambda a, b: np.concatenate([a[left], b[right]])
            of = join(of, of)
            less = join(less, less + width0)
            symbol = join(symbol * 2, symbol * 2 + 1)
            lo, hi = join(lo - one_lo, zeros + one_lo), join(hi - one_hi, zeros + one_hi)
            start = join(start - one_start, zeros + one_start)
        return of, symbol, lo - start, hi - start, less


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of a sequence in order, by prefix doubling; the end sorts first."""
    n = len(text)
    rank, width = text.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while True:
        after = np.zeros(n, np.int64)
        after[:max(n - width, 0)] = rank[width:] + 1 if width > 0 else 0
        key = rank * (int(rank.max()) + 2 if n else 1) + after
        order = np.argsort(key, kind="stable")
        fresh = np.zeros(n, np.int64)
        fresh[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.zeros(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        width *= 2


class Index:
    """A bidirectional FM-index over distinct sorted words, each between delimiters (symbol 0)."""

    def __init__(self, words: list[str]):
        self.words = words
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        self.letters = np.unique(points)
        size = np.array([len(w) for w in words], np.int64)
        start = np.cumsum(size + 1) - size
        text = np.zeros(int(size.sum()) + len(words) + 1, np.int64)
        text[np.arange(len(points)) + np.repeat(start - (np.cumsum(size) - size), size)] = np.searchsorted(self.letters, points) + 1
        self.n = len(text)
        bits = max(1, int(len(self.letters)).bit_length())
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(self.letters) + 1))])
        # a text's own end goes round to its first symbol: both are delimiters, so the order holds
        self.left, self.right = (Wavelet(t[suffix_order(t) - 1], bits) for t in (text, text[::-1].copy()))

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols of each word in a row, their numbers); a letter no word of the index has is -1."""
        size = np.array([len(w) for w in words], np.int64)
        out = np.full((len(words), int(size.max(initial=0)) + 1), -1, np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        place = np.minimum(np.searchsorted(self.letters, points), max(len(self.letters) - 1, 0))
        known = self.letters[place] == points if len(self.letters) else np.zeros(len(points), bool)
        row = np.repeat(np.arange(len(words)), size)
        column = np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)
        out[row, column] = np.where(known, place + 1, -1)
        return out, size

    def extend(self, side: str, symbol: np.ndarray, fwd: np.ndarray, rev: np.ndarray, width: np.ndarray):
        """Intervals (starts in the text's and the reversed text's order, width) after one more symbol to a side."""
        matrix, lead, follow = (self.left, fwd, rev) if side == "left" else (self.right, rev, fwd)
        lo, hi, less = matrix.step(np.maximum(symbol, 0), lead, lead + width)
        lead, follow, width = self.below[np.maximum(symbol, 0)] + lo, follow + less, np.where(symbol >= 0, hi - lo, 0)
        return (lead, follow, width) if side == "left" else (follow, lead, width)

    def branch(self, side: str, fwd: np.ndarray, rev: np.ndarray, width: np.ndarray):
        """(state, symbol, fwd, rev, width) for every symbol that can come next on a side."""
        matrix, lead, follow = (self.left, fwd, rev) if side == "left" else (self.right, rev, fwd)
        of, symbol, lo, hi, less = matrix.distinct(lead, lead + width)
        lead, follow, width = self.below[symbol] + lo, follow[of] + less, hi - lo
        return (of, symbol, lead, follow, width) if side == "left" else (of, symbol, follow, lead, width)

    def near(self, queries: list[str], scheme: str) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of all words one edit from a query, the edit outside the half that ``scheme`` matches."""
        symbols, size = self.symbols(queries)
        half = size // 2
        anchor, onward = ("left", "right") if scheme == "prefix" else ("right", "left")
        # the exact part runs from the middle outwards to the delimiter, the rest from the middle the other way
        exact = half if scheme == "prefix" else size - half
        rest = size - exact

        def symbol_at(q: np.ndarray, j: np.ndarray, part: str) -> np.ndarray:
            """The j-th symbol from the middle; past the word's end the delimiter."""
            to_left = (part == "exact") == (scheme == "prefix")
            at = half[q] - 1 - j if to_left else half[q] + j
            inside = (at >= 0) & (at < size[q])
            return np.where(inside, symbols[q, np.clip(at, 0, symbols.shape[1] - 1)], 0)

        q = np.arange(len(queries))
        fwd, rev, width = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.full(len(q), self.n)
        for j in range(int(exact.max(initial=0)) + 1):
            go = np.flatnonzero(j <= exact[q])  # the last step is the delimiter
            f, r, w = self.extend(anchor, symbol_at(q[go], np.full(len(go), j), "exact"), fwd[go], rev[go], width[go])
            fwd[go], rev[go], width[go] = f, r, w
            q, fwd, rev, width = (x[width > 0] for x in (q, fwd, rev, width))
        clean = (q, np.zeros(len(q), np.int64), fwd, rev, width)
        dirty = [np.zeros(0, np.int64)] * 5
        found_q, found_w = [], []
        while len(clean[0]) or len(dirty[0]):
            q, j, fwd, rev, width = clean
            open_ = j <= rest[q]
            skipped = (q[j < rest[q]], j[j < rest[q]] + 1, *(x[j < rest[q]] for x in (fwd, rev, width)))
            of, symbol, f, r, w = self.branch(onward, fwd, rev, width)
            inner = symbol > 0
            of, symbol, f, r, w = (x[inner] for x in (of, symbol, f, r, w))
            own = symbol_at(q[of], j[of], "rest")
            inserted = (q[of], j[of], f, r, w)
            other = (symbol != own) & (j[of] < rest[q[of]])
            replaced = (q[of][other], j[of][other] + 1, f[other], r[other], w[other])
            states = [np.concatenate(x) for x in zip(dirty, skipped, inserted, replaced)]
            dirty = self._onward(states, onward, rest, symbol_at, found_q, found_w)
            f, r, w = self.extend(onward, symbol_at(q, j, "rest"), fwd, rev, width)
            live = (w > 0) & (j < rest[q])
            clean = (q[live], j[live] + 1, f[live], r[live], w[live])
        pairs = np.unique(np.stack([np.concatenate([np.zeros(0, np.int64), *found_q]),
                                    np.concatenate([np.zeros(0, np.int64), *found_w])]), axis=1)
        return pairs[0], pairs[1]

    def _onward(self, states, side, rest, symbol_at, found_q, found_w):
        """One exact step of the states that hold their error; whole delimited words are found."""
        q, j, fwd, rev, width = states
        f, r, w = self.extend(side, symbol_at(q, j, "rest"), fwd, rev, width)
        done = (w > 0) & (j >= rest[q])
        found_q.append(q[done])
        found_w.append(f[done] - 1)  # words stand in order: the rank of a delimited word, behind the text's end, is its place
        live = (w > 0) & (j < rest[q])
        return [q[live], j[live] + 1, f[live], r[live], w[live]]


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, n_near, form, form_n): near words of every word of (word, n) that has any, the best of them."""
    spark = words.sparkSession
    cells = max(shuffle_width(spark), -(-words.count() // cell_words))

    def reach(size: Column) -> Column:
        """Letters of the key of queries of this size."""
        return F.least(F.floor(size / 2), F.lit(KEY)).cast("int")

    size = F.length("word")
    sizes = F.filter(F.array(size - 1, size, size + 1), lambda m: m >= LEAST_CHARS)
    asked, held = F.array(reach(size)), F.array_distinct(F.transform(sizes, reach))
    dealt = None
    for scheme in ("prefix", "suffix"):
        for asks, reaches in ((True, asked), (False, held)):
            some = words.select("word", "n", F.explode(reaches).alias("k"))
            key = F.substr("word", F.lit(1), F.col("k")) if scheme == "prefix" else F.right("word", F.col("k"))
            some = some.select(F.lit(scheme).alias("scheme"), F.pmod(F.xxhash64(key), F.lit(cells)).alias("cell"),
                               F.lit(asks).alias("asks"), "word", "n")
            dealt = some if dealt is None else dealt.unionByName(some)
    dealt = dealt.distinct()  # keys of several lengths may meet in a cell
    cuts = dealt.where(~F.col("asks")).groupBy("scheme", "cell").agg(F.ceil(F.count(F.lit(1)) / (2 * cell_words)).cast("int").alias("cuts"))
    dealt = dealt.join(cuts, ["scheme", "cell"])
    own = F.pmod(F.xxhash64("word", F.lit("block")), F.col("cuts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other")
    dealt = dealt.select("scheme", "cell", own.alias("own"), every, "asks", "word", "n")
    i, j = (F.when(F.col("asks"), F.col(a)).otherwise(F.col(b)) for a, b in (("other", "own"), ("own", "other")))
    task = F.concat_ws("/", "scheme", "cell", i, j)  # one column: a task is not tied to its cell's partition

    def search(cell: pa.Table) -> pa.Table:
        scheme = cell["scheme"][0].as_py()
        rows = [cell["word"].to_pylist(), cell["n"].to_pylist(), cell["asks"].to_pylist()]
        held = sorted((w, n) for w, n, a in zip(*rows) if not a)
        queries = [w for w, n, a in zip(*rows) if a]
        out = {}
        if held and queries:
            index = Index([w for w, _ in held])
            for q, w in zip(*(x.tolist() for x in index.near(queries, scheme))):
                word, (other, n) = queries[q], held[w]
                half = len(word) // 2
                if scheme == "suffix" and other[:half] == word[:half]:
                    continue  # the prefix scheme has found it
                count, best = out.get(word, (0, (0, "")))
                if (-n, other) < (-best[0], best[1]):
                    best = (n, other)
                out[word] = (count + 1, best)
        return pa.table({"word": pa.array(list(out), pa.string()),
                         "n_near": pa.array([x[0] for x in out.values()], pa.int64()),
                         "form": pa.array([x[1][1] for x in out.values()], pa.string()),
                         "form_n": pa.array([x[1][0] for x in out.values()], pa.int64())})

    tasks = dealt.select(task.alias("task"), "scheme", "asks", "word", "n").groupBy("task")
    found = tasks.applyInArrow(search, "word string, n_near long, form string, form_n long")
    best = F.min_by(F.struct("form", "form_n"), F.struct(-F.col("form_n"), F.col("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", "b.form", "b.form_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of (word, form): the end of its chain of forms."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        to = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialize(at.join(to, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        at = step.select("word", "root")
        if step.where("moved").isEmpty():
            return at


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT, ratio: int = RATIO,
          cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the vocabulary."""
    words = materialize(vocabulary(docs, id_col, text_col, least), "spelling-words")
    near = words.join(near_words(words, cell_words), "word", "left")
    strong: Column = F.col("form_n") >= ratio * F.col("n")
    near = materialize(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("form")).alias("form"),
                                   F.when(strong, F.col("form_n")).alias("form_n")), "spelling-near")
    ends = roots(near.where("form IS NOT NULL"))
    return near.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
