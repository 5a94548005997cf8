"""Document fingerprints by locally consistent parsing.

A text's characters are the first sequence of names.  Each level turns a sequence into a
shorter one:

* runs of one name become one name (of the name and the run's length);
* deterministic coin tossing gives every name a label from the lowest bit in which it
  differs from its left neighbour; three tosses bring 64-bit names to a handful of labels
  of which no two neighbours are equal;
* a phrase starts at each label that is larger than both its neighbours, and the phrase's
  contents are its name on the next level.

Where a phrase starts depends on a few names around it only, so equal substrings are cut
into the same phrases wherever they stand, up to a few phrases at their ends.  The
fingerprint keeps the ``KEEP`` smallest phrase names of the levels from ``FROM`` on (of the
highest level a short text has); two fingerprints' likeness is the share of common names
among the smallest of their union.

Defined results: a NULL text is an empty text; an empty text's fingerprint is the empty
string, and like 1.0 to another empty one, 0.0 to any other; equal texts have equal
fingerprints; the next document is the next row in ascending order of id, then text, NULL
ids first, and the last one's is the first; texts of any length are parsed whole; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import grouped, materialize, shuffle_width, text_or_empty

KEEP = 32
FROM = 2
BATCH_CHARS = 1 << 17
_U = np.uint64


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(32))


def _toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 2 * (lowest bit that differs from the left neighbour) + that bit of one's own."""
    left = np.empty_like(x)
    left[1:] = x[:-1]
    left[first] = ~x[first]                        # no neighbour: differs in the lowest bit
    diff = x ^ left
    low = diff & (~diff + _U(1))
    at = (low.astype(np.float64).view(_U) >> _U(52)) - _U(1023)      # a power of two's exponent
    return (at << _U(1)) | ((x >> at) & _U(1))


def _next_level(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and document starts of the next level."""
    first = np.zeros(len(x), bool)
    first[starts] = True
    opens = first.copy()
    opens[1:] |= x[1:] != x[:-1]
    runs = np.flatnonzero(opens)
    length = np.diff(np.append(runs, len(x))).astype(_U)
    y = np.where(length > 1, _mixed(x[runs] + length * _U(0x9E3779B97F4A7C15)), x[runs])
    first = first[runs]
    label = y
    for _ in range(3):
        label = _toss(label, first)
        # an equal neighbour cannot follow but at a start, which has none
    top = first.copy()
    if len(y) > 2:
        top[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~first[2:] & ~first[:-2]
    cuts = np.flatnonzero(top)
    inside = np.arange(len(y)) - np.repeat(cuts, np.diff(np.append(cuts, len(y))))
    names = np.add.reduceat(_mixed(y + (inside.astype(_U) + _U(1)) * _U(0x165667B19E3779F9)), cuts)
    return _mixed(names), np.flatnonzero(first[cuts])


def phrase_names(texts: list[str], start_level: int = FROM) -> tuple[np.ndarray, np.ndarray]:
    """(text index, name) of all phrases of levels from ``start_level`` on, and of the top
    level of texts that end below it; for non-empty texts."""
    owner = np.array([i for i, t in enumerate(texts) if t], np.int64)
    if not len(owner):
        return np.zeros(0, np.int64), np.zeros(0, _U)
    sizes = np.array([len(texts[i]) for i in owner], np.int64)
    x = _mixed(np.frombuffer("".join(texts[i] for i in owner).encode("utf-32-le", "surrogatepass"), np.uint32).astype(_U))
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    out_owner, out_name = [], []
    level = 0
    while len(owner):
        counts = np.diff(np.append(starts, len(x)))
        done = counts == 1
        take = np.repeat(done | (level >= start_level), counts)
        out_owner.append(np.repeat(owner, counts)[take])
        out_name.append(_mixed(x[take] + _U(level)))
        if done.all():
            break
        rest = np.repeat(~done, counts)
        x, owner, counts = x[rest], owner[~done], counts[~done]
        x, starts = _next_level(x, np.concatenate(([0], np.cumsum(counts)[:-1])))
        level += 1
    return np.concatenate(out_owner), np.concatenate(out_name)


def fingerprints(texts: list[str], keep: int = KEEP) -> list[np.ndarray]:
    """The smallest distinct phrase names of each text, as 32-bit numbers in ascending order."""
    owner, name = phrase_names(texts)
    name >>= _U(32)
    both = np.unique((owner.astype(_U) << _U(32)) | name)
    owner, name = (both >> _U(32)).astype(np.int64), both & _U(0xFFFFFFFF)
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [name[cut[i]:min(cut[i] + keep, cut[i + 1])] for i in range(len(texts))]


def as_hex(print_: np.ndarray) -> str:
    return print_.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, keep: int = KEEP) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:keep]
    return float(np.intersect1d(np.intersect1d(a, b, True), union, True).size / len(union))


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _rows(pairs: list[tuple]) -> list[list]:
    """Columns n_chars ... near_next of (id, text, next text)."""
    texts = [t for _, t, _ in pairs]
    changed = [edited(t, n) for _, t, n in pairs]
    own, other, following = fingerprints(texts), fingerprints(changed), fingerprints([n for *_, n in pairs[-1:]])
    after = own[1:] + following                    # the pairs are consecutive
    return [[len(t) for t in texts], [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            [as_hex(x) for x in own], [as_hex(x) for x in other],
            [likeness(a, b) for a, b in zip(own, other)], [likeness(a, b) for a, b in zip(own, after)]]


_OUT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_TYPES = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
_NAMES = [f.split()[0] for f in _OUT.split(", ")]


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    cols = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    line = cols.repartitionByRange(shuffle_width(spark), "doc_id").sortWithinPartitions("doc_id", "text")

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A range in order: every row but the last meets its next one here; the first and
        the last row go on as they are, to meet those of the neighbouring ranges."""
        part = TaskContext.get().partitionId()

        def docs_in():
            for batch in batches:
                for i, t in enumerate(batch.column(1)):
                    yield batch.column(0)[i].as_py(), t.as_py()

        def block(role: str, rows: list[tuple], texts: list, columns: list[list]) -> pa.RecordBatch:
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([role] * n, pa.string()), pa.array([part] * n, pa.int64()),
                 pa.array([r[0] for r in rows], id_type), pa.array(texts, pa.string()),
                 *(pa.array(c, t) for c, t in zip(columns, _TYPES))], names=["role", "part", "doc_id", "text", *_NAMES])

        nothing = [[None]] * len(_TYPES)
        last = None
        for some in grouped(docs_in(), lambda d: len(d[1]) + 1, BATCH_CHARS):
            if last is None:
                yield block("first", some[:1], [some[0][1]], nothing)
            else:
                some = [last, *some]
            pairs = [(i, t, n) for (i, t), (_, n) in zip(some, some[1:])]
            if pairs:
                yield block("row", pairs, [None] * len(pairs), _rows(pairs))
            last = some[-1]
        if last is not None:
            yield block("last", [last], [last[1]], nothing)

    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    walked = materialize(line.mapInArrow(walk, f"role string, part long, doc_id {kind}, text string, {_OUT}"), "fp-line")
    # one number for each range that has rows
    parts = walked.where("role = 'first'").select("part")
    order = Window.orderBy("part")
    follows = parts.select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next_part"))
    ends = (walked.where("role = 'last'").select("part", "doc_id", "text").join(follows, "part")
            .join(walked.where("role = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text")),
                  "next_part").select("doc_id", "text", "next_text"))

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = (None, batch.column(1)[i].as_py(), batch.column(2)[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:i + 1], *(pa.array(c, t) for c, t in zip(_rows([pair]), _TYPES))],
                    names=["doc_id", *_NAMES])

    return walked.where("role = 'row'").select("doc_id", *_NAMES).unionByName(
        ends.mapInArrow(meet, f"doc_id {kind}, {_OUT}"))
