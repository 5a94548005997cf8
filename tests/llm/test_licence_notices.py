"""Planted licence notices: what is found, what is left alone, odd inputs."""

import random

from cartlake.llm import licences

SCHEMA = "doc_id long, text string, uid long, families string, p double"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))


def wrapped(rng, text):
    """The words over lines of three to nine, as comments."""
    words, out = text.split(" "), []
    while words:
        k = rng.randint(3, 9)
        out.append("# " + " ".join(words[:k]))
        words = words[k:]
    return "\n".join(out)


def test_planted_notices_precision_and_recall(spark):
    rng = random.Random(21)
    rows, want = [], {}
    for f, statements in licences.TEMPLATES.items():
        for s in statements:
            for form in (s, wrapped(rng, s), f"{prose(rng, 40)}. {s}. {prose(rng, 40)}"):
                want[len(rows)] = f
                rows.append((len(rows), f"{prose(rng, 60)}\n\n{form}\n\n{prose(rng, 60)}", 1, "x", 0.5))
    for clean in (*licences.NO_FAMILY, "the license plate was lost", "copyright of the photographs stays with their authors",
                  "redistribution of water to the fields", "terms of the lease may be changed", "a creative commons for artists in town"):
        want[len(rows)] = ""
        rows.append((len(rows), f"{prose(rng, 60)}\n\n{clean}. {prose(rng, 30)}", 1, "x", 0.5))
    got = {r.doc_id: r.families for r in licences.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    hits = sum(want[i] != "" and want[i] in got[i].split(",") for i in want)
    named = sum(len([x for x in v.split(",") if x]) for v in got.values())
    right = sum(want[i] != "" and want[i] in v.split(",") for i, v in got.items())
    print(f"notices {sum(f != '' for f in want.values())}, found {hits}; families named {named}, right {right}")
    assert hits >= 0.95 * sum(f != "" for f in want.values())
    assert right >= 0.95 * named
    assert all(got[i] == "" for i, f in want.items() if f == "")


def test_long_paragraphs_and_odd_rows(spark):
    rng = random.Random(2)
    notice = licences.TEMPLATES["MIT"][2]
    long = f"{prose(rng, 20_000)} {notice} {prose(rng, 20_000)}"
    rows = [(1, long, None, None, None), (2, None, None, None, None), (3, "", None, None, None), (None, notice, 5, "MIT", 1.0), (None, notice, 5, "MIT", 1.0)]
    got = sorted((tuple(r) for r in licences.scan(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted([(1, 1, 1, "MIT"), (2, 0, 0, ""), (3, 0, 0, ""), (None, 1, 1, "MIT"), (None, 1, 1, "MIT")], key=repr)
    assert licences.scan(spark.createDataFrame([], SCHEMA)).count() == 0
