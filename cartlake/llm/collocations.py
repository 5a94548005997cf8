"""Phrases whose words belong together: frequent word n-grams by Misra-Gries, counted exactly, scored.

A first pass names every n-gram (its language included) by a 64-bit hash.  The top bits of
a name choose one of ``buckets``; a block of text sends each bucket its names and counts,
sorted and packed.  A bucket merges these summaries into one Misra-Gries summary of more than
mass / threshold counters: when it overflows, the largest count that makes enough of them
vanish is taken off all.  What is taken off a name stays below the threshold, so an n-gram
that reaches the threshold is still held; a name goes on if its count and what was taken off
together reach it.  Each bucket marks its names in its part of a table of FILTER_BITS
bits, whose size does not depend on the data; that table alone is broadcast.

A second pass counts the n-grams whose name is marked, by their words and not their hashes,
so collisions cost time but never change a count.  Parts of a frequent phrase are as
frequent, so these counts hold every count a score needs.

Defined results: A-Z are lower-cased; texts are cut at [.,;:!?\\x0A-\\x0D] into pieces and
these at spaces and tabs into words; NULL and empty texts have no words; a NULL language is
``und``; a text is read whole however long it is; repeated rows each count; ties rank by count,
then by phrase in UTF-8 byte order; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens as T
from .common import materialize, shuffle_width, text_or_empty

THRESHOLD = 10
LONGEST = 3
TOP = 2_000
SUBSUMED_PCT = 50
#: text bytes a bucket is meant for: its summary then holds some 3 million counters
BUCKET_BYTES = 64 << 20
SUMMARY_NAMES = 2 << 20
SENT_PHRASES = 1 << 19
FILTER_BITS = 27
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


class Grams:
    """The words of a block of texts, numbered, and the names of the n-grams that start at each."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        data, bounds = T.joined(texts)
        data = _LOWER[data]
        kind = _KIND[data]
        word = kind == 0
        text, start, end = T.runs(word, bounds)
        breaks = np.cumsum(kind == 2)
        self.piece = (breaks[start] if len(start) else start) + text * (len(data) + 1)
        self.code, self.words = T.numbered(T.strings(data, word, start, end))
        lang_code, self.langs = T.numbered(pc.fill_null(langs, "und").cast(pa.large_string()))
        self.lang = lang_code[text]
        names = _hashed(self.words)[self.code] if len(self.code) else np.zeros(0, np.uint64)
        self._mix, self._hash = names, _hashed(self.langs)[self.lang] if len(self.lang) else names

    def by_length(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, places where an n-gram starts, their names)."""
        h = self._hash
        for n in range(1, LONGEST + 1):
            h = T.rolled(h, self._mix, n)
            at = np.arange(len(h))
            if n > 1:
                at = np.flatnonzero(self.piece[:len(h)] == self.piece[n - 1:n - 1 + len(h)])
            yield n, at, T.mixed(h[at] + np.uint64(n))


def _hashed(values: pa.Array) -> np.ndarray:
    """64-bit hashes of strings, the same in every process."""
    return np.fromiter((xxhash.xxh64_intdigest(x) for x in values.cast(pa.large_binary()).to_pylist()), np.uint64, len(values))


def pack(names: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted 32-bit names and their counts: differences by byte plane, compressed."""
    steps = np.diff(names.astype(np.uint32), prepend=np.uint32(0))
    planes = [np.ascontiguousarray(x.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes() for x in (steps, counts)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(2, 4, -1)
    steps, counts = (np.ascontiguousarray(x.T).view("<u4").ravel() for x in raw)
    return np.cumsum(steps, dtype=np.uint32), counts.astype(np.int64)


class Summary:
    """A Misra-Gries summary of at most ``capacity`` counters over sorted names, merged with others."""

    def __init__(self, capacity: int):
        self.capacity, self.off = capacity, 0
        self.names, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merge(self, others: list[tuple[np.ndarray, np.ndarray]]) -> None:
        names, place = np.unique(np.concatenate([self.names, *(n for n, _ in others)]), return_inverse=True)
        total = np.zeros(len(names), np.int64)
        np.add.at(total, place, np.concatenate([self.counts, *(c for _, c in others)]))
        if len(names) > self.capacity:
            least = np.partition(total, len(total) - self.capacity - 1)[len(total) - self.capacity - 1]
            self.off += int(least)
            total -= least
            names, total = names[total > 0], total[total > 0]
        self.names, self.counts = names, total


def summaries(rows: DataFrame, bits: int) -> DataFrame:
    """(bucket, mass, packed): the names of blocks of (lang, text) by the top ``bits`` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names in _gathered(block_names(b) for b in T.blocks(batches, "text")):
            names, counts = tallied(names, 32 - bits)
            edge = np.searchsorted(names, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))
            full = np.flatnonzero(np.diff(edge))
            inner = (names & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            packed = [pack(inner[edge[b]:edge[b + 1]], counts[edge[b]:edge[b + 1]]) for b in full]
            mass = [int(counts[edge[b]:edge[b + 1]].sum()) for b in full]
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(mass, pa.int64()), pa.array(packed, pa.binary())],
                                             names=["bucket", "mass", "packed"])

    return rows.mapInArrow(run, "bucket int, mass long, packed binary")


def tallied(names: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct names without their last ``shift`` bits, counts); sorts in place."""
    names >>= np.uint64(shift)
    names.sort()
    opens = np.ones(len(names), bool)
    np.not_equal(names[1:], names[:-1], out=opens[1:])
    opens = np.flatnonzero(opens).astype(np.int32)
    return names[opens], np.diff(opens, append=np.int32(len(names)))


def block_names(block: pa.RecordBatch) -> np.ndarray:
    grams = Grams(block.column("lang"), block.column("text"))
    return np.concatenate([names for _, _, names in grams.by_length()])


def _gathered(parts: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """The names of several blocks together, about SUMMARY_NAMES at a time."""
    some, size = [], 0
    for names in parts:
        some.append(names)
        size += len(names)
        if size >= SUMMARY_NAMES:
            yield np.concatenate(some)
            some, size = [], 0
    if some:
        yield np.concatenate(some)


def frequent(found: DataFrame, bits: int, threshold: int) -> DataFrame:
    """(bucket, marks): for each bucket, its part of the table of marks of names that may reach ``threshold``."""

    def merged(cell: pa.Table) -> pa.Table:
        summary = Summary(pc.sum(cell["mass"]).as_py() // threshold + 1)
        waiting, size = [], 0
        for packed in cell["packed"]:
            waiting.append(unpack(packed.as_py()))
            size += len(waiting[-1][0])
            if size >= summary.capacity:  # some at a time, so that sorting stays in proportion to the entries
                summary.merge(waiting)
                waiting, size = [], 0
        summary.merge(waiting)
        held = summary.names[summary.counts + summary.off >= threshold]
        marks = np.zeros(1 << (FILTER_BITS - bits), np.uint8)
        marks[held >> np.uint32(32 - (FILTER_BITS - bits))] = 1
        return pa.table({"bucket": cell["bucket"].slice(0, 1), "marks": pa.array([np.packbits(marks).tobytes()], pa.binary())})

    return found.groupBy("bucket").applyInArrow(merged, "bucket int, marks binary")


def counted(rows: DataFrame, table: np.ndarray, bits: int, threshold: int) -> DataFrame:
    """(lang, phrase, a): exact counts of the n-grams whose name is marked in ``table`` and that reach
    ``threshold``; the empty phrase holds a language's number of words.

    Counts travel as packed lists of sorted phrases, by language and bucket."""
    held = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, size = [], 0
        for block in T.blocks(batches, "text"):
            for part in block_phrases(block, held.value, bits):
                some.append(part)
                size += part.num_rows
            if size >= SENT_PHRASES:
                yield packed_phrases(pa.concat_tables(some))
                some, size = [], 0
        if some:
            yield packed_phrases(pa.concat_tables(some))

    def merged(cell: pa.Table) -> pa.Table:
        whole = zstandard.ZstdDecompressor()
        phrases = pa.chunked_array([pa.array(whole.decompress(x.as_py())[:-1].split(b"\n"), pa.binary()) for x in cell["phrases"]])
        counts = pa.chunked_array([pa.array(np.frombuffer(whole.decompress(x.as_py()), "<i8")) for x in cell["counts"]])
        total = pa.table({"phrase": phrases, "a": counts}).group_by("phrase").aggregate([("a", "sum")])
        enough = pc.or_(pc.greater_equal(total["a_sum"], threshold), pc.equal(total["phrase"], pa.scalar(b"", pa.binary())))
        total = total.filter(enough)
        return pa.table({"lang": pa.array([cell["lang"][0].as_py()] * total.num_rows, pa.string()),
                         "phrase": total["phrase"].cast(pa.string()), "a": total["a_sum"]})

    sent = rows.mapInArrow(run, "lang string, bucket int, phrases binary, counts binary")
    return sent.groupBy("lang", "bucket").applyInArrow(merged, "lang string, phrase string, a long")


def block_phrases(block: pa.RecordBatch, marks: np.ndarray, bits: int) -> Iterator[pa.Table]:
    """(lang, bucket, phrase, a) of a block's n-grams that are marked, by n; and its words by language."""
    g = Grams(block.column("lang"), block.column("text"))
    langs = np.bincount(g.lang, minlength=len(g.langs))
    yield _phrases(g, np.flatnonzero(langs), np.zeros(int((langs > 0).sum()), np.int32),
                   pa.array([""] * int((langs > 0).sum()), pa.large_string()), langs[langs > 0])
    for n, at, names in g.by_length():
        place = names >> np.uint64(64 - FILTER_BITS)
        marked = (marks[place >> np.uint64(3)] >> (np.uint64(7) - (place & np.uint64(7))).astype(np.uint8)) & 1
        at, names = at[marked > 0], names[marked > 0]
        order, first = T.same(names, [g.lang[at], *(g.code[at + j] for j in range(n))])
        opens = np.flatnonzero(first)
        one = at[order[opens]]
        words = [g.words.take(pa.array(g.code[one + j])) for j in range(n)]
        bucket = (names[order[opens]] >> np.uint64(64 - bits) if bits else np.zeros(len(opens))).astype(np.int32)
        yield _phrases(g, g.lang[one], bucket, pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())),
                       np.diff(np.append(opens, len(order))))


def _phrases(g: Grams, lang: np.ndarray, bucket: np.ndarray, phrase: pa.Array, a: np.ndarray) -> pa.Table:
    return pa.table({"lang": g.langs.take(pa.array(lang, pa.int64())), "bucket": pa.array(bucket, pa.int32()),
                     "phrase": phrase, "a": pa.array(a, pa.int64())})


def packed_phrases(rows: pa.Table) -> pa.RecordBatch:
    """One row per language and bucket: its phrases in order, each ended by a line feed (no word holds one), and counts."""
    rows = rows.group_by(["lang", "bucket", "phrase"]).aggregate([("a", "sum")])
    rows = rows.sort_by([(x, "ascending") for x in ("lang", "bucket", "phrase")]).combine_chunks()
    lang, bucket = T.numbered(rows["lang"].combine_chunks())[0], rows["bucket"].to_numpy()
    edge = np.flatnonzero(np.append((lang[1:] != lang[:-1]) | (bucket[1:] != bucket[:-1]), True)) + 1
    edge = np.concatenate([[0], edge])
    ended = pc.binary_join_element_wise(rows["phrase"], pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
    data, bounds = T.joined(ended.combine_chunks())
    counts, small = rows["a_sum"].to_numpy().astype("<i8"), zstandard.ZstdCompressor(level=1)
    first = pa.array(edge[:-1])
    return pa.RecordBatch.from_arrays(
        [rows["lang"].combine_chunks().take(first).cast(pa.string()), rows["bucket"].combine_chunks().take(first),
         pa.array([small.compress(data[bounds[lo]:bounds[hi]].tobytes()) for lo, hi in zip(edge, edge[1:])], pa.binary()),
         pa.array([small.compress(counts[lo:hi].tobytes()) for lo, hi in zip(edge, edge[1:])], pa.binary())], names=["lang", "bucket", "phrases", "counts"])


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", threshold: int = THRESHOLD) -> DataFrame:
    """(lang, phrase, n_words, a) of every n-gram of up to LONGEST words that occurs ``threshold``
    times or more in its language, and the number of words of each language under the empty phrase, n_words 0."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = max(shuffle_width(spark), -(-size // BUCKET_BYTES), 1)
    bits = min(FILTER_BITS - 3, (wanted - 1).bit_length())
    table = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    part = len(table) >> bits
    for row in frequent(summaries(rows, bits), bits, threshold).collect():  # FILTER_BITS bits in all
        table[row.bucket * part:(row.bucket + 1) * part] = np.frombuffer(row.marks, np.uint8)
    found = counted(rows, table, bits, threshold)
    n = F.when(F.col("phrase") == "", F.lit(0)).otherwise(F.size(F.split("phrase", " ", -1)))
    return found.select("lang", "phrase", n.alias("n_words"), "a")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", threshold: int = THRESHOLD,
                 top: int = TOP, subsumed_pct: int = SUBSUMED_PCT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases."""
    counts = materialize(phrase_counts(docs, text_col, lang_col, threshold), "phrase-counts")
    phrases = counts.where("n_words > 1")
    word = F.split("phrase", " ", -1)
    cuts = F.transform(F.sequence(F.lit(1), F.col("n_words") - 1), lambda k: F.struct(
        k.alias("cut"), F.array_join(F.slice(word, F.lit(1), k), " ").alias("first"),
        F.array_join(F.slice(word, k + 1, F.col("n_words") - k), " ").alias("rest")))
    cut = phrases.select("lang", "phrase", "n_words", "a", F.inline(cuts))
    part = counts.where("n_words > 0").select(F.col("lang").alias("part_lang"), F.col("phrase").alias("part"), F.col("a").alias("part_a"))
    for side, out in (("first", "l"), ("rest", "r")):
        cut = cut.join(part, (F.col("lang") == F.col("part_lang")) & (F.col(side) == F.col("part"))).withColumnRenamed("part_a", out)
        cut = cut.drop("part_lang", "part", side)
    score = F.expr("(1000000BD * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    best = cut.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "a", "l", "r")).alias("b")).select("lang", "phrase", "b.a", "b.l", "b.r", "b.score")
    inner = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(2)), lambda k: F.array_join(F.slice(word, k, F.lit(2)), " ")))
    longer = (phrases.where("n_words = 3").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = best.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < subsumed_pct * F.col("a")))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    shard = F.pmod(F.xxhash64("phrase"), F.lit(16))
    few = (kept.withColumn("shard", shard).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "shard").orderBy(*order)))
           .where(F.col("rank") <= top).drop("rank", "shard"))
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    words = counts.where("n_words = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
