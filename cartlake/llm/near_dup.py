"""Near-duplicate documents: banded MinHash, stars around central sets, prefix filter over differences, exact Jaccard.

A document's set holds a 64-bit name of each of its distinct word n-grams; equal sets are one
class, so copies never meet.  Each of ``rows`` x ``bands`` hash functions takes the smallest of a
set, the values of a band's functions are one value, and sets with an equal value stand in one
list.  Two sets with Jaccard similarity t stand in a common list with a probability of
1 - (1 - t^rows)^bands; there are as many bands as keep that of a miss at MISS for a pair just
similar enough.  Unlike sets share a rare name or two, but seldom the smallest of several functions.

The pairs of a list are not formed.  Its members meet its most central one, its pivot (most other
members over all lists; for STARS turns, each turn those outside the components of the pivots
before), and exact similarities of these pairs give components.  Of a link (x, y) of a list
that they miss, one member, say x, is outside the pivot's component.  Then the differences of x
and of y from the pivot c (names that one has and the other lacks) share a name: if they shared
none, all that x and y have in common would be in c, and everything in x or c would be in x or y
or c, so that x would be as much like c as like y.  So

* the names in a list's differences are put in one order, rarest first;
* a set stands in the inverted lists of its difference, as far as a similar set could be alike;
* two sets meet if the places of the shared name, together, allow enough overlap: the first name
  that both differences hold has only names before it that one of the two lacks.

Copies edited at random share few rare differences, so they meet few others whatever their number.
No list is cut, and every pair that meets is compared by its full sets.  Two linked sets fail to
meet with a probability of at most MISS.

Defined results: words are split at [\\x20\\x09-\\x0D] after A-Z are lower-cased; a text
with fewer than n words has its whole sequence as its one n-gram; a NULL, empty or blank
text has an empty set and is linked with nothing; rows that share an id are compared by
their own texts and share the id's smallest component; a NULL id links like any other and
never is a component's smallest; ties cannot arise; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import grouped, materialize, may_hold as _may_hold, surely_not_held

#: bands at most, unless bands of one row need more
BANDS = 40
MISS = 1e-5
STARS = 2
BLOCK_BYTES = 1 << 18
PIECE_BYTES = 1 << 22
_LOWER = bytes(range(256)).lower()
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_U = np.uint64


def needed(k: int, pct: int) -> int:
    """The largest count that sets of similarity pct / 100 share among k sketch values but with a probability of MISS."""
    t, below, m = pct / 100, 0.0, 0
    while m <= k:
        below += math.comb(k, m) * t ** m * (1 - t) ** (k - m)
        if below > MISS:
            break
        m += 1
    return min(m, k)


def sketch_size(k: int, pct: int) -> int:
    """k, or the smallest size above it at which similar sets share a value but with a probability of MISS."""
    while pct > 0 and needed(k, pct) < 1:
        k += 1
    return k


def banding(pct: int, most: int = BANDS) -> tuple[int, int]:
    """(rows, bands): the most rows of a band with which no more than ``most`` bands are needed."""
    shapes = [(rows, sketch_size(1, pct ** rows / 100 ** (rows - 1))) for rows in range(1, 33)]
    return max((x for x in shapes if x[1] <= most), default=shapes[0])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(32))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, name) of each word of a block of bytes."""
    at = np.flatnonzero(~_SPACE[data])
    opens = np.ones(len(at), bool)
    opens[1:] = np.diff(at) > 1
    first = np.flatnonzero(opens)
    if not len(first):
        return first, np.zeros(0, _U)
    place = np.arange(1, len(at) + 1) - np.repeat(first, np.diff(np.append(first, len(at))))
    letters = _mixed(data[at].astype(_U) + place.astype(_U) * _U(0x165667B19E3779F9))
    return at[first], _mixed(np.add.reduceat(letters, first))


def _pieces(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of about PIECE_BYTES that end between words, so that a long text is named in bounded memory."""
    lo = 0
    while lo < len(data):
        hi = min(lo + PIECE_BYTES, len(data))
        while hi < len(data) and not _SPACE[data[hi]]:
            hi += 1
        yield lo, data[lo:hi]
        lo = hi


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct names of each text's word n-grams."""
    raw = [(t or "").encode("utf-8").translate(_LOWER) for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    parts = [(lo + start, name) for lo, piece in _pieces(data) for start, name in [_words(piece)]]
    starts, names = (np.concatenate(x) for x in zip(*parts))
    bounds = np.searchsorted(starts, np.cumsum([0, *(len(r) + 1 for r in raw)]))

    def grams(words: np.ndarray, size: int, seed: int) -> np.ndarray:
        h = np.full(max(len(words) - size + 1, 0), seed, _U)
        for i in range(size):
            h = _mixed(h * _U(0x9E3779B97F4A7C15) + words[i:i + len(h)])
        return h

    every = grams(names, n, 0)
    out = []
    for lo, hi in zip(bounds, bounds[1:]):
        if hi - lo >= n:
            own = every[lo:hi - n + 1]
        else:
            own = grams(names[lo:hi], hi - lo, hi - lo) if hi > lo else np.zeros(0, _U)
        out.append(np.unique(own.view(np.int64)))
    return out


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(first columns, texts) of rows of about BLOCK_BYTES."""
    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        for some in grouped(rows, lambda r: len(r[1] or ""), BLOCK_BYTES):
            yield [r[0] for r in some], [r[1] for r in some]


def band_values(sets: list[np.ndarray], rows: int, bands: int) -> list[np.ndarray]:
    """Each set's band values; an empty set has none."""
    out = [np.zeros(0, np.int64)] * len(sets)
    some = [i for i, s in enumerate(sets) if len(s)]
    if not some:
        return out
    names = np.concatenate([sets[i] for i in some]).view(_U)
    opens = np.cumsum([0, *(len(sets[i]) for i in some[:-1])])
    odd = _mixed(np.arange(1, rows * bands + 1).astype(_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
    values = np.empty((len(some), bands), np.int64)
    for band in range(bands):
        h = np.full(len(some), band, _U)
        for factor in odd[band * rows:(band + 1) * rows]:       # names are random, so their odd multiples order them anew
            h = _mixed(h * _U(0x9E3779B97F4A7C15) + np.minimum.reduceat(names * factor, opens))
        values[:, band] = h.view(np.int64)
    for i, own in zip(some, values):
        out[i] = own
    return out


def _signatures(docs: DataFrame, id_col: str, text_col: str, n: int, rows: int, bands: int) -> DataFrame:
    """(doc_id, n, sig, bands): sig names the whole set."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _blocks(batches):
            sets = shingle_sets(texts, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array(band_values(sets, rows, bands), pa.list_(pa.int64()))], names=["doc_id", "n", "sig", "bands"])
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n long, sig binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(sig, names) of the classes in wanted (doc_id, sig): the texts are read again."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for wanted_sigs, texts in _blocks(batches):
            sets = shingle_sets(texts, n)
            sigs = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            fits = [i for i, (a, b) in enumerate(zip(sigs, wanted_sigs)) if a == b]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sigs[i] for i in fits], pa.binary()),
                 pa.array([sets[i] for i in fits], pa.list_(pa.int64()))], names=["sig", "names"])
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    joined = _may_hold(texts, "__id", wanted, "doc_id").join(wanted, F.col("__id").eqNullSafe(F.col("doc_id")))
    return joined.select("sig", "__text").mapInArrow(run, "sig binary, names array<long>").dropDuplicates(["sig"])


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """(node, comp) of the nodes of edges (a, b): comp is the component's smallest node.
    Labels sink along edges and jump to their labels' labels until nothing changes."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, f"{purpose}-edges")
    label = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                        .select("node", F.least("node", "low").alias("comp")), f"{purpose}-labels")
    while True:
        near = (both.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("comp").alias("near")))
        sunk = label.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("to"))
        jump = label.select(F.col("node").alias("to"), F.col("comp").alias("beyond"))
        new = materialize(sunk.join(jump, "to").select("node", "was", F.least("to", "beyond").alias("comp")),
                          f"{purpose}-labels")
        if new.where(F.col("was") != F.col("comp")).isEmpty():
            return new.select("node", "comp")
        label = new.select("node", "comp")


def _with_names(pairs: DataFrame, sets: DataFrame, *sides: str) -> DataFrame:
    """``pairs`` with the full sets of the classes in columns ``sides``, as <side>_names."""
    wanted = pairs
    for side in sides:
        pairs = pairs.join(_may_hold(sets, "sig", wanted, side).select(F.col("sig").alias(side), F.col("names").alias(f"{side}_names")), side)
    return pairs


def _links(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    full = _with_names(pairs, sets, "b", "a").withColumn("both", F.size(F.array_intersect("a_names", "b_names")))
    full = full.where(F.col("both") * 100 >= (F.size("a_names") + F.size("b_names") - F.col("both")) * pct)
    return materialize(full.select("a", "b"), "dup-links")


def _alike(n: Column, other: Column, pct: int) -> Column:
    return F.least(n, other) * 100 >= F.greatest(n, other) * pct


def _lists(classes: DataFrame) -> DataFrame:
    """(value, sig, rows): the lists of at least two classes, and their length."""
    entries = classes.select("sig", F.explode("bands").alias("value"))
    often = entries.groupBy("value").agg(F.count("*").alias("rows")).where("rows > 1")
    return entries.join(often, "value")


def _classes(marks: DataFrame) -> DataFrame:
    return marks.where("n > 0").groupBy("sig").agg(
        F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("bands").alias("bands"))


def _label(lists: DataFrame, comp: DataFrame | None) -> DataFrame:
    if comp is None:
        return lists.withColumn("comp", F.col("sig"))
    return lists.join(comp.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
        "comp", F.coalesce("comp", "sig"))


def _pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _merged(links: DataFrame, comp: DataFrame | None) -> DataFrame | None:
    """The components ``comp`` (node, comp) after ``links`` are added: only links between two
    components, as links of their labels, are walked."""
    if comp is None:
        return None if links.isEmpty() else components(links, "dup")
    for side in ("a", "b"):
        label = comp.select(F.col("node").alias(side), F.col("comp").alias("label"))
        links = links.join(label, side, "left").withColumn(side, F.coalesce("label", side)).drop("label")
    between = materialize(links.where("a != b").distinct(), "dup-between")
    if between.isEmpty():
        return comp
    joined = components(between, "dup")
    moved = (comp.join(joined.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left")
             .select("node", F.coalesce("to", "comp").alias("comp")))
    return materialize(moved.unionByName(joined.join(comp.select("node"), "node", "left_anti")), "dup-comp")


def _outside(now: DataFrame) -> DataFrame:
    """The rows of lists (value, pivot, comp, ...) with a member outside the component of the pivot, and
    ``outside``, whether the row's is."""
    own = now.where("sig = pivot").select("value", F.col("comp").alias("own"))
    now = now.join(own, "value").withColumn("outside", F.col("comp") != F.col("own")).drop("own")
    still = now.where("outside").select("value").distinct()
    return now.join(still, "value", "left_semi")


def _met(lists: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """(a, b): the pairs in ``lists`` (pivot, sig, n, comp, outside) that may be similar, not in one component,
    and not both in the pivot's."""
    of = materialize(lists.where("sig != pivot").select("pivot", "sig", "n", "comp", "outside").distinct(), "dup-of")
    names = _with_names(of, sets, "sig", "pivot")
    differs = F.concat(F.array_except("sig_names", "pivot_names"), F.array_except("pivot_names", "sig_names"))
    differs = materialize(names.select("pivot", "sig", "n", "comp", "outside", differs.alias("names")), "dup-differs")
    entries = differs.select("pivot", "sig", "n", "comp", "outside", F.size("names").alias("size"), F.explode("names").alias("name"))
    often = entries.groupBy("pivot", "name").agg(F.count("*").alias("df"), F.max("outside").alias("any")).where("df > 1 AND any")
    # names that nobody outside shares come first; a similar set lacks them, as all names before the first shared one
    order, mine = Window.partitionBy("pivot", "sig").orderBy("df", "name"), Window.partitionBy("pivot", "sig")
    held = entries.join(often.drop("any"), ["pivot", "name"]).withColumn(
        "place", F.row_number().over(order) - 1 + F.col("size") - F.count("*").over(mine))
    held = materialize(held.where(F.col("place") * pct <= F.col("n") * (100 - pct)).select(
        "pivot", "name", "sig", "n", "comp", "outside", "place"), "dup-held")
    other = held.select("pivot", "name", *(F.col(c).alias(f"other_{c}") for c in ("sig", "n", "comp", "outside", "place")))
    fits = ((F.col("place") + F.col("other_place")) * (100 + pct) <= (F.col("n") + F.col("other_n")) * (100 - pct))
    once = ~F.col("other_outside") | (F.col("sig") < F.col("other_sig"))
    met = held.where("outside").join(other, ["pivot", "name"]).where(
        (F.col("comp") != F.col("other_comp")) & once & _alike(F.col("n"), F.col("other_n"), pct) & fits)
    return met.select(*_pairs(F.col("sig"), F.col("other_sig"))).distinct()


def class_components(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, n: int, pct: int) -> DataFrame | None:
    """(node, comp) of the classes (by sig) that have links; None without any."""
    lists = materialize(_lists(classes), "dup-lists")
    central = lists.groupBy("sig").agg(F.sum(F.col("rows") - 1).alias("others"))
    members = materialize(classes.select("sig", "low", "n").join(central, "sig"), "dup-members")
    sets = materialize(_sets(docs, members.select(F.col("low").alias("doc_id"), "sig"), id_col, text_col, n), "dup-sets")
    lists = lists.drop("rows").join(members.drop("low"), "sig")
    first = lists.groupBy("value").agg(F.max_by("sig", F.struct("others", "sig")).alias("pivot"))
    rest = materialize(lists.join(first, "value"), "dup-stars")
    comp, star = None, rest
    for _ in range(STARS):
        pairs = star.where("sig != pivot").select(*_pairs(F.col("sig"), F.col("pivot"))).distinct()
        comp = _merged(_links(materialize(pairs, "dup-pairs"), sets, pct), comp)
        rest = materialize(_outside(_label(rest.drop("comp", "outside"), comp)), "dup-rest")
        if rest.isEmpty():
            return comp
        # those outside meet the most central one of them
        away = rest.where("outside").drop("pivot")
        star = away.join(away.groupBy("value").agg(F.max_by("sig", F.struct("others", "sig")).alias("pivot")), "value")
    return _merged(_links(materialize(_met(rest, sets, pct), "dup-met"), sets, pct), comp)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    similarity_pct: int = 80, bands: int = BANDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row a document; ``similarity_pct`` of
    100 * intersection >= pct * union links two documents."""
    marks = materialize(_signatures(docs, id_col, text_col, words, *banding(similarity_pct, bands)), "dup-marks")
    classes = materialize(_classes(marks), "dup-classes")
    comp = class_components(docs, classes, id_col, text_col, words, similarity_pct)
    low = _label(classes.select("sig", "low"), comp)
    smallest = low.groupBy("comp").agg(F.min("low").alias("component_id"))
    of_class = low.join(smallest, "comp").select("sig", "component_id")
    out = marks.select("doc_id", "n", "sig").join(of_class, "sig", "left").withColumn(
        "component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component, and of rows that
    repeat an id and a text one.  Documents without words, and without an id, stay."""
    judged = near_duplicates(docs, id_col, text_col, **options)
    drop = (judged.where("NOT kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("gone"))
            .join(judged.where("kept").select("doc_id").distinct(), "doc_id", "left_anti"))
    drop = materialize(drop.select("doc_id"), "dup-dropped")
    again = judged.where("kept AND n_shingles > 0").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    again = materialize(again.select("doc_id"), "dup-again")
    # only texts whose id is in one of the two meet them; all others go past the shuffle
    some = drop.unionByName(again)
    rest = surely_not_held(docs, id_col, some, "doc_id")
    stay = _may_hold(docs, id_col, some, "doc_id").join(
        drop.select(F.col("doc_id").alias("__gone")), F.col(id_col) == F.col("__gone"), "left_anti")
    if again.isEmpty():
        return rest.unionByName(stay)
    # rows that repeat an id: one of each text stays
    stay = stay.join(again.select(F.col("doc_id").alias("__again")), F.col(id_col) == F.col("__again"), "left")
    twice = stay.where(F.col("__again").isNotNull()).drop("__again")
    stay = stay.where(F.col("__again").isNull()).drop("__again").unionByName(twice.dropDuplicates([id_col, text_col]))
    return rest.unionByName(stay)
