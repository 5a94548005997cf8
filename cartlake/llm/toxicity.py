"""Toxicity: a support vector machine on a gap-weighted subsequence kernel with Nystroem landmarks.

The kernel compares two strings by the character triples they share as subsequences:
a triple spread over s characters counts DECAY ** (s - 3), up to SPAN characters, so
inserted characters and gaps weaken a match and do not break it; of inserted letters that
is up to two in every gap, or four in one.
A text is represented by its strings: its words, runs of single letters joined to one
string, and windows over all its letters and digits with white space and punctuation left
out ("id iot", "i - d - i - o - t", "i--d--i--o--t").  A window is a run of tokens of at
most JOINED characters from the start of one to the end of another; in tokens longer than
that, and in scripts written without spaces, one starts at every character, so there
insults of two characters count too.  A text's margin is that of its most toxic string,
and a logistic curve turns the margin into a score.

Training uses at most ``max_per_class`` different labelled texts of either label, the first in
the order of a hash of the text; of their clean strings every so many-th goes into a fit, about
CLEAN_STRINGS of them beside the worst ones.  Sentences of toxic texts are not labelled one by one, so the
string that stands for a toxic text is chosen again after each fit (the first time by how
much the text's character 5-grams are commoner in toxic texts); sentences of clean texts
all count as clean, represented by their worst strings.  Each fit adds the worst window
of every text to its strings.  There are far more windows than words, so their margins are
lowered by as much as the highest ones of clean texts exceed those of words.

Defined results: a NULL or empty text, or one without a window of two characters, gets
the score of the lowest margin; long texts are read whole, a string longer than WINDOW
characters in windows that overlap by OVERLAP, so a passage of up to OVERLAP characters
lies whole in one of them wherever it stands; equal texts score alike; with no labelled
row of either label there is nothing to learn and every score is 0; labels, language,
source and id are never inputs of a score; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import grouped, materialize

MAX_PER_CLASS = 1200
CLEAN_STRINGS = 4000
#: strings turned into triple counts at a time
ITEMS = 512
SPAN, DECAY, BITS = 7, 0.85, 18
LANDMARKS = 192
LOWEST = -3.0
LIMIT = 0.3
CLEAN = 0.998
MAX_STRINGS = 400_000
WINDOW, OVERLAP = 64, 32
JOINED, BLOCK = 20, 1 << 17
#: lengths of the windows inside long tokens, and more in scripts without spaces (from code point UNSPACED on)
INNER, SHORT, UNSPACED = (4, 6, 9, 14, JOINED), (2, 3), 0x2E80
#: all but white space, punctuation and invisible marks
TOKEN = re.compile(r"[^\s\x00-/:-@\[-`{-\xbf\u2000-\u206f\u3000-\u303f\ufe00-\ufe0f\ufeff\uff01-\uff0f\uff1a-\uff20]+")
STEPS = tuple((a, b) for b in range(2, SPAN) for a in range(1, b))
SPACED = re.compile(r"\b\w[^\w\n]\w[^\w\n]\w(?:[^\w\n]\w)*\b")
MARKS = ".,;:!?\"'()[]{}<>*_-~`"


def pieces(string: str) -> list[str]:
    """A string as it is, or the overlapping windows of a long one."""
    if len(string) <= WINDOW:
        return [string]
    return [string[i:i + WINDOW] for i in range(0, len(string) - OVERLAP, WINDOW - OVERLAP)]


def names(low: str) -> set[str]:
    """Short names of the strings of a text in lower case: words as they stand, and after a line feed
    runs of single letters and the pieces of words longer than WINDOW."""
    out = set(low.split())
    for run in SPACED.findall(low):
        out.add("\n" + re.sub(r"\W", "", run))
    if max(map(len, out), default=0) > WINDOW:
        for name in [w for w in out if len(w) > WINDOW]:
            out.remove(name)
            out.update("\n" + p for p in pieces(_named(name)))
    return out


def _named(name: str) -> str:
    return name[1:] if name[0] == "\n" else name.strip(MARKS)


def _judged(w: str) -> bool:
    return len(w) >= 3 or len(w) == 2 and ord(w[0]) >= UNSPACED


def strings(text: str) -> set[str]:
    """The strings of a text that the kernel judges."""
    return set(filter(_judged, map(_named, names(text.lower()))))


def _parts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return codes * np.uint64(0x9E3779B97F4A7C15), codes * np.uint64(0xC2B2AE3D27D4EB4F), codes * np.uint64(0x165667B19E3779F9)


def _feature(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The names of triples, from the ``_parts`` of their characters."""
    h = x + y
    h += z
    return _named_by(h)


def _named_by(h: np.ndarray) -> np.ndarray:
    """The names of triples, from the sums of their parts, which are overwritten."""
    h >>= np.uint64(29)
    h &= np.uint64((1 << BITS) - 1)
    return h.view(np.int64)


def _triples(items: list[str]):
    """Yields (feature, weight, valid) of every character of the items' joined codes for
    each spread, after the starts of the items."""
    marked = ["^" + w for w in items]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    ends = np.repeat(starts + lengths, lengths)
    at = np.arange(len(codes))
    x, y, z = _parts(codes)
    for a, b in STEPS:
        n = len(codes) - b
        if n <= 0:
            continue
        yield starts, _feature(x[:n], y[a:a + n], z[b:b + n]), DECAY ** (b - 2), at[:n] + b < ends[:n]


def margins(items: list[str], weights: np.ndarray) -> np.ndarray:
    """Sum of a string's triples' weights over its norm."""
    total, norm, starts = None, None, None
    for starts, feature, weight, valid in _triples(items):
        got = np.where(valid, weights[feature] * weight, 0.0)
        if total is None:
            size = len(got) + STEPS[0][1]
            total, norm = np.zeros(size), np.zeros(size)
        total[:len(got)] += got
        norm[:len(got)] += valid * weight ** 2
    if total is None:
        return np.zeros(len(items))
    return np.add.reduceat(total, starts) / np.sqrt(np.maximum(np.add.reduceat(norm, starts), 1e-9))


def _runs(text_ends: np.ndarray, begins: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the windows of joined tokens that lie between ``begins`` and ``ends``;
    ``text_ends`` holds the end of each token's text."""
    lows, highs = [], []
    at, k = np.arange(len(begins)), 0
    while len(at):
        at = at[at + k < len(begins)]
        at = at[(ends[at + k] <= text_ends[at]) & (ends[at + k] - begins[at] <= JOINED)]
        lows.append(begins[at])
        highs.append(ends[at + k])
        k += 1
    long = np.repeat(ends - begins > JOINED, ends - begins)
    limit = np.repeat(text_ends, ends - begins)
    unspaced = codes >= UNSPACED
    for sizes, where in ((INNER, np.flatnonzero(long | unspaced)), (SHORT, np.flatnonzero(unspaced))):
        for size in sizes:
            lows.append(where)
            highs.append(np.minimum(where + size, limit[where]))
    return np.concatenate(lows), np.concatenate(highs)


@cache
def _token_codes() -> np.ndarray:
    """Whether a character is TOKEN's, by its code point; those from 0xFFFF on are."""
    return np.fromiter((TOKEN.match(chr(c)) is not None for c in range(1 << 16)), bool, 1 << 16)


def _worst(texts: list[str], weights: np.ndarray) -> list[tuple[float, str]]:
    """(margin, window) of each text's window of the largest margin: what ``margins`` gives
    for the window as a string, from sums over the triples before each place."""
    none = (-np.inf, "")
    lows = [t.lower() for t in texts]
    codes = np.frombuffer("".join(lows).encode("utf-32-le", "surrogatepass"), np.uint32)
    # the characters of tokens; a token opens after another character and where a text does
    inside = _token_codes()[np.minimum(codes, 0xFFFF)]
    at = np.flatnonzero(inside)
    if not len(at):
        return [none] * len(texts)
    lasts = np.cumsum(np.fromiter(map(len, lows), np.int64, len(lows)))
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    firsts = lasts[:-1][lasts[:-1] < len(codes)]
    opens[firsts] = inside[firsts]
    opens = np.flatnonzero(opens)
    owner = np.searchsorted(lasts, opens, "right")
    codes = codes[at].astype(np.uint64)
    ends = np.append(np.searchsorted(at, opens[1:]), len(at))
    sizes = np.diff(ends, prepend=0)
    last = np.searchsorted(owner, owner, "right") - 1
    low, high = _runs(ends[last], ends - sizes, ends, codes)
    fits = high - low >= 2
    low, high = low[fits], high[fits]
    if not len(low):
        return [none] * len(texts)
    length = high - low
    n = len(codes)
    x, y, z = _parts(np.concatenate((codes, np.zeros(SPAN, np.uint64))))
    mark = _parts(np.array([ord("^")], np.uint64))[0]
    start = np.zeros(n, bool)
    start[low] = True
    start = np.flatnonzero(start)
    place = np.zeros(n, np.int64)
    place[start] = np.arange(len(start))
    first = np.zeros((len(start), SPAN))                        # triples with the mark of the start
    norm = np.zeros(JOINED + 1)
    total = np.zeros(len(low))
    for b in range(2, SPAN):
        scale, inner, opening = DECAY ** (b - 2), np.zeros(n + 1), np.zeros(len(start))
        ends_of, ends_opening = x[:max(n - b, 0)] + z[b:max(n, b)], mark + z[start + b - 1]
        for a in range(1, b):
            if n > b:
                inner[1:n - b + 1] += weights.take(_named_by(ends_of + y[a:n - b + a]))
            opening += weights.take(_named_by(ends_opening + y[start + a - 1]))
        first[:, b] = opening * scale
        inner = np.cumsum(inner) * scale
        total += inner[np.maximum(high - b, low)] - inner[low]
        norm += (b - 1) * np.maximum(0, np.arange(JOINED + 1) + 1 - b) * scale ** 2
    total += np.cumsum(first, axis=1)[place[low], np.minimum(length, SPAN - 1)]
    margin = total / np.sqrt(np.maximum(norm[length], 1e-9))
    text = np.repeat(owner, sizes)[low]
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, text, margin)
    out = [none] * len(texts)
    for i in np.flatnonzero(margin == best[text]).tolist():
        out[text[i]] = (float(margin[i]), codes[low[i]:high[i]].astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass"))
    return out


def worst_windows(texts: list[str], weights: np.ndarray) -> list[tuple[float, str]]:
    """``_worst`` in blocks of about BLOCK characters; a longer text is read in parts that
    overlap by as much as holds any window whose separators are not extremely long."""
    parts = [(i, t[at:at + BLOCK]) for i, t in enumerate(texts) for at in range(0, max(1, len(t) - BLOCK // 8), BLOCK * 7 // 8)]
    out = [(-np.inf, "")] * len(texts)
    for some in grouped(parts, lambda x: len(x[1]), BLOCK):
        for (i, _), got in zip(some, _worst([t for _, t in some], weights)):
            out[i] = max(out[i], got)
    return out


def _matrix(items: list[str], columns: dict[int, int]) -> np.ndarray:
    """Normalised triple counts of the items, on the columns the landmarks have."""
    lookup = np.full(1 << BITS, -1, np.int64)
    lookup[np.fromiter(columns, np.int64, len(columns))] = np.fromiter(columns.values(), np.int64, len(columns))
    out = np.zeros((len(items), len(columns)), np.float32)
    norm = np.zeros(len(items))
    for starts, feature, weight, valid in _triples(items):
        owner = np.searchsorted(starts, np.arange(len(feature)), "right") - 1
        np.add.at(norm, owner, valid * weight ** 2)
        column = lookup[feature]
        hit = valid & (column >= 0)
        np.add.at(out, (owner[hit], column[hit]), weight)
    out /= np.sqrt(np.maximum(norm, 1e-9))[:, None].astype(np.float32)
    return out


def _svm(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 300) -> tuple[np.ndarray, float]:
    """Squared hinge loss with balanced classes, by accelerated gradient descent."""
    balance = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    z = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    rate = 1.0 / (2 * float((balance[:, None] * z ** 2).sum()) + ridge)
    w = v = np.zeros(z.shape[1])
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (z @ v))
        grad = -2 * z.T @ (balance * y * slack) + ridge * v
        new = v - rate * grad
        w, v = new, new + t / (t + 3) * (new - w)
    return w[:-1], float(w[-1])


class Model:
    """Weights of triples, offsets of words and windows and the curve from margins to scores."""

    def __init__(self, weights: np.ndarray, offset: float, slope: float, shift: float):
        self.weights, self.offset, self.slope, self.shift = weights, offset, slope, shift
        self.window_offset = offset

    def scores(self, items: list[str]) -> np.ndarray:
        return margins(items, self.weights) + self.offset

    def probability(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-(self.slope * margin + self.shift))))


def fit(texts: list[str], labels: list[int], landmarks: int = LANDMARKS, rounds: int = 4) -> Model | None:
    """A model from labelled texts; None if one of the labels is missing."""
    y = np.array(labels)
    if not (y == 1).any() or not (y == 0).any():
        return None
    sets = [sorted(strings(t)) for t in texts]
    n_words = [len(s) for s in sets]
    # first choice of toxic strings: 5-grams that are commoner in toxic texts
    seen = [Counter(), Counter()]
    for s, label in zip(sets, y):
        seen[label].update({("^" + w)[i:i + 5] for w in s for i in range(max(1, len(w) - 3))})
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    odds = {g: np.log((c + 0.5) / (n1 + 1)) - np.log((seen[0][g] + 0.5) / (n0 + 1)) for g, c in seen[1].items()}

    def first_score(w: str) -> float:
        return max((odds.get(("^" + w)[i:i + 5], -9.0) for i in range(max(1, len(w) - 3))), default=-9.0)

    known: dict[str, float] = {}
    for s in sets:
        for w in s:
            if w not in known:
                known[w] = first_score(w)
    toxic_use, clean_use = Counter(), Counter()
    for s, label in zip(sets, y):
        (toxic_use if label else clean_use).update(s)
    by_gram: dict[str, str] = {}
    for w in sorted(toxic_use, key=lambda w: (-known[w], -toxic_use[w], w)):
        best = max((("^" + w)[i:i + 5] for i in range(max(1, len(w) - 3))), key=lambda g: (odds.get(g, -9.0), g))
        by_gram.setdefault(best, w)
    toxic_marks = list(by_gram.values())[: landmarks * 2 // 3]
    clean_marks = [w for w, _ in sorted(clean_use.items(), key=lambda x: (-x[1], x[0]))[: landmarks // 3]]
    marks = list(dict.fromkeys(toxic_marks + clean_marks))
    columns = {f: i for i, f in enumerate(sorted({int(f) for _, feat, _, ok in _triples(marks) for f in feat[ok]}))}
    phi = _matrix(marks, columns)                               # landmarks x triples
    value, vector = np.linalg.eigh((phi @ phi.T).astype(float) + 1e-3 * np.eye(len(marks)))
    root = vector @ np.diag(np.maximum(value, 1e-6) ** -0.5) @ vector.T      # kernel ** -1/2
    model, windows = None, []
    for _ in range(rounds):
        positive, negative = [], Counter()
        best: list[float] = []
        for s, label in zip(sets, y):
            if not s:
                best.append(LOWEST)
                continue
            top = sorted(s, key=lambda w: -known[w])[:3]
            best.append(known[top[0]])
            if label:
                positive.append(top[0])
                positive += [w for w in top[1:] if toxic_use[w] >= 3 and toxic_use[w] > 8 * clean_use[w]]
            else:
                negative.update(top)
        positive = [w for w in positive if w not in negative or toxic_use[w] > 3 * clean_use[w]]
        if not positive or not negative:
            break
        spread = sorted(clean_use)[:: max(1, len(clean_use) // CLEAN_STRINGS)]
        bad = sorted(set(negative) | set(spread))
        named = positive + bad
        x = np.vstack([_matrix(named[i:i + ITEMS], columns) @ phi.T @ root for i in range(0, len(named), ITEMS)])
        w, b = _svm(x, np.array([1.0] * len(positive) + [-1.0] * len(bad)))
        weights = np.zeros(1 << BITS)
        weights[np.fromiter(columns, np.int64, len(columns))] = phi.T @ (root @ w)
        model = Model(weights, b, 1.0, 0.0)
        names = list(known)
        known = dict(zip(names, model.scores(names).tolist()))
        windows = worst_windows(texts, weights)
        for (margin, w), s, label in zip(windows, sets, y):
            if w and w not in s:
                s.append(w)
                known[w] = margin + b
                (toxic_use if label else clean_use)[w] += 1
    if model is None:
        return None
    top = np.array([max((known[w] for w in s[:n]), default=LOWEST) for s, n in zip(sets, n_words)])
    joined = np.array([max(margin + model.offset, LOWEST) for margin, _ in windows])
    excess = np.quantile(joined[y == 0], CLEAN) - np.quantile(top[y == 0], CLEAN)
    model.window_offset -= max(0.0, float(excess))
    top = np.maximum(top, joined + model.window_offset - model.offset)
    slope, shift = 1.0, 0.0
    for _ in range(2000):                                       # logistic curve
        p = 1 / (1 + np.exp(-(slope * top + shift)))
        err = p - y
        slope -= 0.5 * float((err * top).mean())
        shift -= 0.5 * float(err.mean())
    model.slope, model.shift = max(slope, 1e-3), shift
    return model


#: a text's place in the order of the sample, and a second hash that tells texts with one place apart
DRAWS = 1 << 40


def _drawn(text: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(text), F.lit(DRAWS)).alias("draw"), F.xxhash64(text, F.lit(1)).alias("again")]


def _chosen(keys: DataFrame, max_per_class: int) -> DataFrame:
    """The ``max_per_class`` first rows of (draw, again, label, ...) of either label, as a broadcast of that bounded size.

    ``keys`` holds a row per different text; only draws below a bound that leaves four times as many are gathered."""
    counts = {r["label"]: r["count"] for r in keys.groupBy("label").count().collect()}
    found: list = []
    for label in (0, 1):
        n = counts.get(label, 0)
        for bound in (4 * max_per_class * DRAWS // max(n, 1), DRAWS):
            some = keys.where((F.col("label") == label) & (F.col("draw") < min(bound, DRAWS))).orderBy("draw", "again").limit(max_per_class).collect()
            if len(some) == min(n, max_per_class):
                break
        found += some
    return F.broadcast(keys.sparkSession.createDataFrame(found, keys.schema))


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic",
          max_per_class: int = MAX_PER_CLASS) -> Model | None:
    """Fits on at most ``max_per_class`` different texts of each label of (text, label).

    Texts are chosen by their hashes; only the chosen ones are sent, whole."""
    rows = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("int").alias("label"))
    rows = rows.where(F.col("text").isNotNull() & F.col("label").isin(0, 1)).select("text", "label", *_drawn(F.col("text")))
    keys = ["draw", "again", "label"]
    chosen = _chosen(materialize(rows.select(*keys).distinct(), "toxic-draws"), max_per_class)
    some = rows.join(chosen, keys).groupBy(*keys).agg(F.first("text").alias("text")).orderBy("label", "draw", "again").collect()
    return fit([r["text"] for r in some], [r["label"] for r in some])


def _judge(model: Model, new: set[str], margin_of: dict[str, float]) -> None:
    """Adds the margins of the strings with the names ``new``; one too short to be judged has the least."""
    named = {name: _named(name) for name in new}
    items = sorted(set(filter(_judged, named.values())))
    margin: dict[str, float] = {}
    for i in range(0, len(items), 50_000):
        part = items[i:i + 50_000]
        margin.update(zip(part, model.scores(part).tolist()))
    margin_of.update((name, margin.get(w, -np.inf)) for name, w in named.items())


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, score, k0, k1, ...: the columns in ``keep``), a row for each row of ``docs``."""
    return _scored(docs, model, F.col(id_col), docs.schema[id_col].dataType.simpleString(), text_col, keep)


def _scored(docs: DataFrame, model: Model | None, id_column: Column, id_type: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    schema = ", ".join([f"doc_id {id_type}", "score double",
                        *(f"`k{i}` {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margin_of: dict[str, float] = {}
        for batch in batches:
            values = np.zeros(batch.num_rows)
            for lo in range(0, batch.num_rows, 256) if model else ():
                texts = [t or "" for t in batch.column(1)[lo:lo + 256].to_pylist()]
                sets = [names(t.lower()) for t in texts]
                if len(margin_of) > MAX_STRINGS:
                    margin_of.clear()
                _judge(model, set().union(*sets).difference(margin_of), margin_of)
                for i, (s, (margin, _)) in enumerate(zip(sets, worst_windows(texts, model.weights))):
                    top = max(map(margin_of.__getitem__, s), default=-np.inf)
                    top = max(top, margin + model.window_offset)
                    values[lo + i] = model.probability(LOWEST if top == -np.inf else top)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values), *batch.columns[2:]],
                                             names=["doc_id", "score", *(f"k{i}" for i in range(len(keep)))])

    out = docs.select(id_column.alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep))).mapInArrow(run, schema)
    return out


def reject(docs: DataFrame, model: Model | None, limit: float = LIMIT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, with all their columns."""
    names = docs.columns
    scored = _scored(docs, model, F.lit(0), "int", text_col, tuple(names))
    return scored.where(F.col("score") < limit).select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(names)))


def held_out(id_column):
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """(text, toxic): at most ``max_per_class`` different texts of each label, the first in the
    order of a hash of the text, of the documents whose id is not held out.

    Only ids, hashes and labels are joined; the texts are fetched by a broadcast of the chosen ids."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    texts = texts.select("id", "text", *_drawn(F.col("text")))
    keys = texts.select("id", "draw", "again").join(marked, "id").groupBy("draw", "again", "label").agg(F.min("id").alias("id"))
    chosen = _chosen(materialize(keys, "toxic-draws"), max_per_class)
    some = texts.join(chosen, ["id", "draw", "again"]).groupBy("draw", "again", "label").agg(F.first("text").alias("text"))
    return materialize(some.select("text", F.col("label").alias("toxic")), "toxic-labelled")
