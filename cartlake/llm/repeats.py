"""Repeated passages: bytes covered by a string of ``length`` bytes that starts anywhere else too.

The order of all suffixes, cut to ``length`` bytes, is never built for the whole corpus.
Names (64-bit, from doubling: the name of 2w bytes is made of two names of w bytes) stand
for prefixes, and positions are sampled first, so that most suffixes are discarded before
anything is sorted:

1. sample: in each window of ``length`` bytes the leftmost smallest name of GRAM bytes is
   sampled.  Equal windows sample equal names at equal offsets, so a window whose sampled
   name occurs at one place only is unique, with everything else that hangs on it.
2. merge: the positions left over are named by their whole prefix, names are dealt out by
   value and sorted, and neighbours with equal names are repeats.

A period-v difference cover (the usual sample) would need (sqrt v) / v of all positions in
one shuffle, ten times as many as the window minima; see the README.

What is dealt out is pre-aggregated: a block of texts sends every name once, with a mark if
it held it more than once, so that a passage in a third of all documents makes one entry a
block.  Equal texts are one text: sampled and sorted once, removed whole if long enough.

Defined results: a NULL text is an empty text; texts shorter than ``length`` lose nothing;
matches never cross documents; strings are judged on the input; overlaps with itself count;
texts of any length are read whole; repeated rows are copies of each other like any two
equal texts; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grouped, materialize, shuffle_width, text_or_empty

LENGTH = 400
GRAM = 128
BLOCK_BYTES = 1 << 18
#: positions of one block of the merge, and names of one of its buckets
MERGE_BYTES = 1 << 20
BUCKET_NAMES = 2_000_000
_U = np.uint64
_A, _B = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * _B + b
    h ^= h >> _U(31)
    h *= _A
    h ^= h >> _U(29)
    return h


def prefix_names(data: np.ndarray, length: int) -> np.ndarray:
    """Names of the ``length`` bytes from each position on (as far as there are as many)."""
    level = _pair(data.astype(_U), np.full(1, 7, _U))
    out, at, width = None, 0, 1
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, _U)
    while width <= length:
        if length & width:
            part = level[at:at + n]
            out = part.copy() if out is None else _pair(out, part)
            at += width
        if 2 * width <= length:
            level = _pair(level[:-width], level[width:])
        width *= 2
    return out


def _sampled(names: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` names the position of its leftmost smallest one."""
    at, span = np.arange(len(names)), 1
    value = names
    while span < width:
        step = min(span, width - span)
        right = value[step:] < value[:-step]
        at = np.where(right, at[step:], at[:-step])
        value = np.minimum(value[step:], value[:-step])
        span += step
    return at


def anchors(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, position, name) of the sampled names of texts of at least ``length`` bytes."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, _U),)
    names = prefix_names(data, gram)
    at = _sampled(names, length - gram + 1)
    owner = np.repeat(np.arange(len(texts)), sizes)[:len(at)]
    inside = np.arange(len(at)) + length <= ends[owner]
    # positions rise within a text, so equal ones stand together
    keep = inside.copy()
    keep[1:] &= (at[1:] != at[:-1]) | ~inside[:-1] | (owner[1:] != owner[:-1])
    at, owner = at[keep], owner[keep]
    return owner, at - (ends - sizes)[owner], names[at]


def _candidates(size: int, positions: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Starts whose windows hold one of the anchors, as a mask over all starts."""
    n = size - length + 1
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.maximum(positions - (length - gram), 0), 1)
    np.add.at(edge, np.minimum(positions + 1, n), -1)
    return np.cumsum(edge[:-1]) > 0


def _named(texts: list[bytes], positions: list[np.ndarray], length: int, gram: int, buckets: int):
    """(names, bucket of each, text index, start) of the candidates of a block."""
    parts = []
    for i, (text, anchor) in enumerate(zip(texts, positions)):
        data = np.frombuffer(text, np.uint8)
        start = np.flatnonzero(_candidates(len(data), anchor, length, gram))
        name = prefix_names(data, length)[start]
        other = prefix_names(data, gram)[start]            # independent of the name's bits
        parts.append((name, ((other * _A) >> _U(33)) % _U(buckets), np.full(len(start), i), start))
    return [np.concatenate([p[j] for p in parts]) for j in range(4)]


def _distinct(name: np.ndarray, bucket: np.ndarray):
    """Order of a block's names by bucket and name, where each distinct one opens, and the marked distinct names."""
    order = np.lexsort((name, bucket))
    name, bucket = name[order], bucket[order]
    opens = np.ones(len(name), bool)
    opens[1:] = (name[1:] != name[:-1]) | (bucket[1:] != bucket[:-1])
    first = np.flatnonzero(opens)
    count = np.diff(np.append(first, len(name)))
    one = (name[first] & ~_U(1)) | (count > 1).astype(_U)   # the lowest bit: more than once in the block
    return order, opens, one, bucket[first].astype(np.int64)


def _pack(rows: list[tuple]) -> tuple[list[bytes], list[np.ndarray]]:
    return [r[0] for r in rows], [np.array(r[1], np.int64) for r in rows]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row a document."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    sha = F.sha2(F.col("text").cast("binary"), 256)
    source = source.select("doc_id", "text", sha.alias("sha"))
    # 60 bits of the digest stand for a text in the large shuffles
    source = source.withColumn("ref", F.conv(F.substring("sha", 1, 15), 16, 10).cast("long"))
    marks = materialize(source.select("doc_id", "sha", F.octet_length("text").cast("long").alias("n_bytes")), "rep-marks")

    def sample(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs = batch.column(0).to_pylist()
            first = dict(zip(reversed(refs), range(len(refs) - 1, -1, -1)))     # of equal texts of a batch one is sampled
            rows = ((r, t.as_buffer().to_pybytes()) for i, (r, t) in enumerate(zip(refs, batch.column(1)))
                    if first[r] == i and len(t.as_buffer()) >= length)
            for some in grouped(rows, lambda r: len(r[1]), BLOCK_BYTES):
                owner, at, name = anchors([t for _, t in some], length, gram)
                of = np.array([r for r, _ in some], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name.view(np.int64)), pa.array(of[owner]), pa.array(at.astype(np.int32))],
                    names=["name", "ref", "at"])

    entries = source.select("ref", F.col("text").cast("binary").alias("text")).mapInArrow(
        sample, "name long, ref long, at int")
    entries = materialize(entries, "rep-anchors")
    place = F.struct("ref", "at")
    # written, so that the join reads both sides straight from its shuffle and AQE can split a name held by many texts
    again = materialize(entries.groupBy("name").agg(F.min(place).alias("low"), F.max(place).alias("high"))
                        .where("low != high").select("name"), "rep-again")
    wanted = materialize(entries.join(again, "name").groupBy("ref").agg(
        F.sort_array(F.collect_set("at")).alias("anchors")), "rep-wanted")
    texts = source.join(wanted, "ref").select("ref", "sha", "text", "anchors").dropDuplicates(["ref", "sha"])

    def block_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for i in range(batch.num_rows):
                    yield tuple(c[i].as_py() for c in batch.columns)
        for some in grouped(rows(), lambda r: len(r[1]), MERGE_BYTES):
            block = int.from_bytes(hashlib.sha256("".join(r[0] for r in some).encode()).digest()[:8], "big", signed=True)
            count = sum(int(_candidates(len(r[1]), np.array(r[2], np.int64), length, gram).sum()) for r in some)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([count]), pa.array([[r[0] for r in some]], pa.list_(pa.string())),
                 pa.array([[r[1] for r in some]], pa.list_(pa.binary())),
                 pa.array([[r[2] for r in some]], pa.list_(pa.list_(pa.int32())))],
                names=["block", "n", "shas", "texts", "anchors"])

    blocks = materialize(texts.select("sha", F.col("text").cast("binary").alias("text"), "anchors").mapInArrow(
        block_rows, "block long, n long, shas array<string>, texts array<binary>, anchors array<array<int>>"), "rep-blocks")
    total = blocks.agg(F.sum("n")).first()[0] or 0
    buckets = max(shuffle_width(spark), -(-total // BUCKET_NAMES))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(zip(batch["texts"][i].as_py(), batch["anchors"][i].as_py()))
                name, bucket, _, _ = _named(*_pack(rows), length, gram, buckets)
                _, _, one, of = _distinct(name, bucket)
                cut = np.searchsorted(of, np.arange(buckets + 1))
                has = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(has), batch["block"][i].as_py(), np.int64)), pa.array(has),
                     pa.array([one[cut[b]:cut[b + 1]].tobytes() for b in has], pa.binary())],
                    names=["block", "bucket", "names"])

    def compare(group: pa.Table) -> pa.Table:
        """Which names of each block's row occur more than once in the bucket."""
        rows = [np.frombuffer(x, _U) for x in group["names"].to_pylist()]
        every = np.concatenate(rows)
        order = np.argsort(every >> _U(1), kind="stable")
        bare = (every >> _U(1))[order]
        same = np.zeros(len(bare), bool)
        same[1:] = bare[1:] == bare[:-1]
        same[:-1] |= same[1:]
        repeated = np.zeros(len(every), bool)
        repeated[order] = same
        repeated |= (every & _U(1)) > 0
        cut = np.cumsum([0, *map(len, rows)])
        return pa.table({"block": group["block"], "bucket": group["bucket"],
                         "flags": pa.array([np.packbits(repeated[a:b]).tobytes() for a, b in zip(cut, cut[1:])], pa.binary())})

    dealt = blocks.mapInArrow(deal, "block long, bucket long, names binary")
    flags = dealt.groupBy("bucket").applyInArrow(compare, "block long, bucket long, flags binary")
    answers = flags.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "flags"))).alias("answers"))

    def cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shas = batch["shas"][i].as_py()
                rows = list(zip(batch["texts"][i].as_py(), batch["anchors"][i].as_py()))
                name, bucket, owner, start = _named(*_pack(rows), length, gram, buckets)
                order, opens, one, of = _distinct(name, bucket)
                size = np.bincount(of, minlength=buckets)
                flag = np.concatenate([np.unpackbits(np.frombuffer(a["flags"], np.uint8))[:size[a["bucket"]]]
                                       for a in batch["answers"][i].as_py()]).astype(bool)
                repeated = np.zeros(len(name), bool)
                repeated[order] = flag[np.cumsum(opens) - 1]
                removed, spans, kept = [], [], []
                for t, (text, _) in enumerate(rows):
                    own = slice(*np.searchsorted(owner, [t, t + 1]))
                    hits = start[own][repeated[own]]
                    edge = np.zeros(len(text) + 1, np.int64)
                    np.add.at(edge, hits, 1)
                    np.add.at(edge, hits + length, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    removed.append(int(gone.sum()))
                    spans.append(int((gone & ~np.concatenate(([False], gone[:-1]))).sum()))
                    kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shas, pa.string()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())],
                    names=["sha", "n_removed", "n_spans", "kept_sha256"])

    found = (blocks.join(answers, "block").select("shas", "texts", "anchors", "answers")
             .mapInArrow(cut_out, "sha string, n_removed long, n_spans long, kept_sha256 string"))
    copies = marks.groupBy("sha").agg(F.count("*").alias("rows")).where("rows > 1")
    empty = hashlib.sha256(b"").hexdigest()
    out = marks.join(found, "sha", "left").join(copies, "sha", "left")
    whole = F.col("rows").isNotNull() & (F.col("n_bytes") >= length)
    return out.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
