"""Stages of the pipeline deal out the whole texts that a join changes, not those that it leaves as they are."""

from cartlake.llm import common, near_dup, pii


def spied(monkeypatch, module, name):
    """The results of ``module.name`` from now on."""
    out, plain = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *a: out.append(plain(*a)) or out[-1])
    return out


def test_every_row_is_on_one_of_the_two_sides(spark):
    rows = spark.range(5000).selectExpr("IF(id % 100 = 0, NULL, id % 900) AS key", "id")
    wanted = spark.createDataFrame([(i,) for i in range(0, 900, 90)] + [(None,), (90,)], "which long")
    held = [r.id for r in common.may_hold(rows, "key", wanted, "which").collect()]
    rest = [r.id for r in common.surely_not_held(rows, "key", wanted, "which").collect()]
    assert sorted(held + rest) == list(range(5000)) and 5 * len(held) < len(rest)
    assert all(i % 100 and i % 900 % 90 for i in rest)
    assert common.surely_not_held(rows, "key", wanted.limit(0), "which").count() == 5000


def test_kept_texts_go_past_the_join_with_dropped_ones(spark, monkeypatch):
    near, rest = spied(monkeypatch, near_dup, "_may_hold"), spied(monkeypatch, near_dup, "surely_not_held")
    texts = [f"text {i} a{i} b{i} c{i} d{i} e{i}" for i in range(200)]
    rows = [*enumerate(texts), (500, texts[7]), (7, texts[7]), (9, texts[9] + " other"), (None, texts[3]), (None, None), (600, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, near_dup.keep_one(docs, words=3, similarity_pct=85).collect()), key=repr)
    assert got == sorted([*enumerate(texts), (9, texts[9] + " other"), (None, texts[3]), (None, None), (600, None)], key=repr)
    assert near[-1].columns == rest[-1].columns == docs.columns and rest[-1].count() > 190
    assert near[-1].count() + rest[-1].count() == len(rows)


def test_texts_without_added_spans_go_past_the_join_with_them(spark, monkeypatch):
    rest = spied(monkeypatch, pii, "surely_not_held")
    texts = [f"see {i} and 4111{i} here" for i in range(400)] + [f"mail u{i}@host{i % 7}.org today" for i in range(120)]
    texts += ["mail joe @ example.org today", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert got[520] == "mail [EMAIL] today" and got[400] == "mail [EMAIL] today" and got[3] == texts[3]
    assert len(got) == len(texts) and rest[-1].count() > 500
