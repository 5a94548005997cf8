"""Whole Arrow text columns cut into runs of bytes and counted as n-grams, in numpy.

A block's texts are read as one byte array.  Separators of every contract here are ASCII,
which no UTF-8 character above 0x7F contains, so bytes can be classified one by one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 21
U = np.uint64
#: odd multipliers of the rolling hash and its finisher (splitmix64's constants)
_STEP, _FIRST, _SECOND = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each value."""
    x = np.asarray(x).astype(U)
    x = (x ^ (x >> U(30))) * _FIRST
    x = (x ^ (x >> U(27))) * _SECOND
    return x ^ (x >> U(31))


def blocks(batches: Iterable[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again in batches of about ``limit`` bytes of ``text``; a longer text stands alone, whole."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total, lo = np.cumsum(size), 0
        while lo < batch.num_rows:
            before = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts end to end, their bounds); NULL reads as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return whole, bounds - bounds[0]


def runs(member: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the maximal runs of member bytes, none across texts."""
    cut = np.zeros(len(member) + 1, bool)
    cut[bounds] = True
    before, after = np.zeros(len(member), bool), np.zeros(len(member), bool)
    before[1:], after[:-1] = member[:-1], member[1:]
    start = np.flatnonzero(member & (~before | cut[:-1]))
    end = np.flatnonzero(member & (~after | cut[1:])) + 1
    return np.searchsorted(bounds, start, side="right") - 1, start, end


def strings(data: np.ndarray, member: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The runs as an Arrow string column."""
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[member]))


def numbered(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of each value, the distinct values by number): equal values, and only those, share a number."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def rolled(h: np.ndarray, code: np.ndarray, n: int) -> np.ndarray:
    """Rolling hash of the n-grams that start at each place, from ``h``, that of the (n - 1)-grams."""
    size = max(len(code) - n + 1, 0)
    return h[:size] * _STEP + code[len(code) - size:]


def same(names: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): places by class, and where a class starts in ``order``.  Classes are exact:
    places share one when all their ``rows`` agree; ``names`` are hashes of these that only speed it up."""
    order = np.argsort(names)
    first = np.ones(len(order), bool)
    if len(order):
        near = names[order[1:]] == names[order[:-1]]
        alike = near.copy()
        for row in rows:
            alike &= row[order[1:]] == row[order[:-1]]
        if (near & ~alike).any():  # unequal n-grams share a hash: sort by the values themselves
            order = np.lexsort(rows)
            alike = np.ones(len(order) - 1, bool)
            for row in rows:
                alike &= row[order[1:]] == row[order[:-1]]
        first[1:] = ~alike
    return order, first
