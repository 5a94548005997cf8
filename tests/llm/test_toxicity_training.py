"""Which rows the toxicity model learns from, and the kernel against plain counting."""

import random
import zlib
from itertools import combinations

import numpy as np

from cartlake.llm import toxicity

DOCS = "doc_id long, text string, __row int, k0 string, label int, draw long"


def corpus(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 7)))
    texts = [" ".join(word() for _ in range(25)) for _ in range(200)]
    texts += [f"{texts[i]} you blockhead {texts[i + 1]}" for i in range(80)]
    rows = [(i, t, 1, "x", 0, 5) for i, t in enumerate(texts)] + [(900, None, None, None, None, None), (901, "", 1, "x", 1, 1)]
    rows += [(1000 + i, texts[0], 1, "x", 0, 5) for i in range(150)]      # a large group of copies
    labels = [(r[0], int("blockhead" in (r[1] or "")), 1) for r in rows] + [(None, 1, 1), (5000, None, 0)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_labelled_rows_are_different_texts_that_are_not_held_out(spark):
    docs, labels = corpus(spark)
    marked = {r.doc_id: r.toxic for r in labels.collect()}
    free = {(r.text, marked[r.doc_id]) for r in docs.collect()
            if r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    every = [(r.text, r.toxic) for r in toxicity.labelled_rows(docs, labels).collect()]
    assert len(every) == len(set(every)) and set(every) == free
    some = [(r.text, r.toxic) for r in toxicity.labelled_rows(docs, labels, max_per_class=20).collect()]
    assert len(some) == len(set(some)) == 40 and set(some) <= free
    assert some and sorted(some) == sorted((r.text, r.toxic) for r in toxicity.labelled_rows(docs, labels, max_per_class=20).collect())
    none = spark.createDataFrame([], DOCS)
    assert toxicity.labelled_rows(none, labels).count() == 0 and toxicity.train(toxicity.labelled_rows(none, labels)) is None


def test_train_score_and_reject(spark):
    docs, labels = corpus(spark)
    model = toxicity.train(toxicity.labelled_rows(docs, labels))
    got = toxicity.score(docs, model).collect()
    bad = {r.doc_id for r in docs.collect() if "blockhead" in (r.text or "")}
    assert len(got) == docs.count() and all((r.score >= toxicity.LIMIT) == (r.doc_id in bad) for r in got)
    kept = toxicity.reject(docs, model)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted((tuple(r) for r in docs.collect() if r.doc_id not in bad), key=repr)
    assert all(r.score == 0 for r in toxicity.score(docs, None).collect())
    assert toxicity.reject(spark.createDataFrame([], DOCS), model).count() == 0


def test_training_joins_no_texts(spark):
    docs, labels = corpus(spark)
    texts = docs.select("doc_id", "text")
    keys = texts.select("doc_id", *toxicity._drawn(texts["text"])).join(labels, "doc_id")
    assert "text" not in keys.columns
    model = toxicity.train(docs.join(labels.where("toxic IS NOT NULL"), "doc_id").select("text", "toxic"), max_per_class=60)
    assert model is not None


def test_margins_equal_plain_subsequence_sums():
    """Every triple of characters i < j < k with k - i < SPAN counts DECAY ** (k - i - 2), by plain loops."""
    rng, pick = np.random.default_rng(4), random.Random(4)
    weights = rng.normal(size=1 << toxicity.BITS)
    items = ["".join(pick.choice("abcé日") for _ in range(n)) for n in (2, 3, 5, 8, 20, 40)]

    def margin(item):
        codes = np.frombuffer(("^" + item).encode("utf-32-le"), np.uint32).astype(np.uint64)
        x, y, z = toxicity._parts(codes)
        total = norm = 0.0
        for i, j, k in combinations(range(len(codes)), 3):
            if k - i < toxicity.SPAN:
                weight = toxicity.DECAY ** (k - i - 2)
                total += weights[toxicity._feature(x[i:i + 1], y[j:j + 1], z[k:k + 1])[0]] * weight
                norm += weight ** 2
        return total / norm ** 0.5
    assert np.allclose(toxicity.margins(items, weights), [margin(i) for i in items])
