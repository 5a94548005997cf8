"""The path-template tree against hand-computed templates and a plain recursive version."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest

from cartlake.llm import url_filter

SCHEMA = "page_id long, url string"


def judged(spark, urls, **options):
    rows = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), SCHEMA), **options).collect()
    assert len(rows) == len(urls)
    return {r.page_id: r for r in rows}


def plain_tree(urls):
    """{(host, segments): (template, purity, evidence)} of (host, segments, blocked, allowed) by recursion."""
    smooth = lambda b, d, prior: round((b + url_filter.ALPHA * prior) / (d + url_filter.ALPHA), 9)
    width = lambda n: math.sqrt(0.5 * math.log(2 / url_filter.DELTA) / n)
    out = {}

    def walk(template, prior, purity, evidence, paths):
        """paths: (key, rest, n, blocked, decided)"""
        if len({tuple(p[1]) for p in paths}) == 1:
            for key, rest, *_ in paths:
                out[key] = ("/".join([template, *rest]), purity, evidence)
            return
        while all(p[1] for p in paths) and len({p[1][0] for p in paths}) == 1:
            template += "/" + paths[0][1][0]
            paths = [(key, rest[1:], *w) for key, rest, *w in paths]
        kids = defaultdict(list)
        for p in paths:
            kids[p[1][0] if p[1] else None].append(p)
        sums = {k: [sum(p[i] for p in v) for i in (2, 3, 4)] for k, v in kids.items()}
        every = [sum(v[i] for v in sums.values()) for i in range(3)]
        segs = [sum(v[i] for k, v in sums.items() if k is not None) for i in range(3)]
        steps = defaultdict(list)
        for k, (n, b, d) in sums.items():
            others = segs[0] - n
            if k is None:
                step = ""
            elif k in ("{n}", "{x}") or others <= 0:
                step = "/" + k
            elif width(n) >= url_filter.TELL:
                step = "/{rare}"
            elif width(n) + width(others) < url_filter.TELL and all(abs(x / n - (s - x) / others) <= width(n) + width(others) for x, s in ((b, segs[1]), (d, segs[2]))):
                step = "/*"
            else:
                step = "/" + k
            steps[step].append(k)
        for step, members in steps.items():
            scale = {k: 1 / sums[k][0] if step == "/{rare}" else 1.0 for k in members}
            own = [sum(sums[k][i] for k in members) for i in range(3)]
            inner = smooth(every[1] - own[1], every[2] - own[2], prior)
            b, d = (sum(sums[k][i] * scale[k] for k in members) for i in (1, 2))
            below = [(key, rest[1:], *(x * scale[k] for x in w)) for k in members for key, rest, *w in kids[k]]
            if step == "":
                for key, *_ in below:
                    out[key] = (template, smooth(b, d, inner), round(d, 9))
            else:
                walk(template + step, inner, smooth(b, d, inner), round(d, 9), below)

    hosts = defaultdict(lambda: defaultdict(lambda: [0, 0, 0]))
    for host, segments, blocked, allowed in urls:
        w = hosts[host][tuple(segments)]
        w[0], w[1], w[2] = w[0] + 1, w[1] + blocked, w[2] + blocked + allowed
    for host, paths in hosts.items():
        b, d = (sum(w[i] for w in paths.values()) for i in (1, 2))
        walk(host, url_filter.PRIOR, smooth(b, d, url_filter.PRIOR), round(d, 9),
             [((host, s), list(s), *w) for s, w in paths.items()])
    return out


def test_tree_against_recursion(spark):
    rng = random.Random(5)
    urls = []
    for _ in range(3000):
        host = rng.choice("abc")
        first = rng.choices(["x", "y", "z", "w", f"slug{rng.randrange(400)}"], [9, 6, 4, 1, 5])[0]
        rest = [rng.choice(["p", "q", "{n}", "{x}", f"s{rng.randrange(60)}"]) for _ in range(rng.randrange(5))]
        blocked = int(rng.random() < {"x": 0.9, "y": 0.85}.get(first, 0.2))
        allowed = int(not blocked and rng.random() < 0.5)
        urls.append((host, [first, *rest] if rng.random() < 0.95 else [], blocked, allowed))
    want = plain_tree(urls)
    tree = url_filter.template_tree(spark.createDataFrame(
        urls, "host string, segments array<string>, blocked long, allowed long"))
    got = {(r.host, tuple(r.segments)): (r.template, r.purity, r.evidence) for r in tree.collect()}
    assert got.keys() == want.keys()
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(got[k][1:] == pytest.approx(want[k][1:], abs=1e-6) for k in want)
    assert {"{rare}", "*", "x", "{n}"} <= {s for t, _, _ in want.values() for s in t.split("/")}


def test_one_blocked_url_blocks_no_other(spark):
    urls = ["http://a.example.com/de/1"] + [f"http://a.example.com/en/{i}" for i in range(10)]
    got = judged(spark, urls)
    assert [got[i].verdict for i in range(11)] == ["block"] + ["allow"] * 10
    # outside /en: 1 of 1 blocked, (1 + 2) / (1 + 4); nothing of its own
    assert (got[3].template, got[3].purity, got[3].evidence) == ("a.example.com/en/{n}", 0.6, 0.0)
    urls = [f"http://a.example.com/{lang}/{i}" for lang in ("de", "en") for i in range(40)]
    got = judged(spark, urls)
    assert [got[i].verdict for i in range(80)] == ["block"] * 40 + ["allow"] * 40
    # /de: nothing decided outside it, prior 0.5, (40 + 2) / 44; /en: prior (40 + 2) / 44, no evidence
    assert (got[0].template, got[0].purity, got[0].evidence) == ("a.example.com/de/{n}", 0.954545455, 40.0)
    assert (got[40].template, got[40].purity, got[40].evidence) == ("a.example.com/en/{n}", 0.954545455, 0.0)


def test_variable_segments_are_generalised_and_rejected(spark):
    rules = [("spam.com", f"/slug-{chr(97 + i)}/", "block") for i in range(12)]
    urls = [f"http://spam.com/slug-{chr(97 + i)}/buy" for i in range(15)] + ["http://other.com/slug-a/buy"]
    got = judged(spark, urls, rules=rules)
    # 15 rare branches of weight one, 12 blocked: purity (12 + 4 * 0.5) / 16
    assert {got[i].template for i in range(15)} == {"spam.com/{rare}/buy"}
    assert got[14].purity == 0.875 and got[14].evidence == 12 and got[14].verdict == "block" and got[14].rule is None
    assert got[15].verdict == "allow"
    # one branch with many urls has one vote
    urls = [f"http://spam.com/slug-a/{i}" for i in range(7)] + [f"http://spam.com/en/{i}" for i in range(7)]
    got = judged(spark, urls, rules=rules)
    assert [got[i].verdict for i in range(14)] == ["block"] * 7 + ["allow"] * 7


def test_deep_paths_are_read_to_their_end(spark):
    deep = "/".join(["part"] * 3000)
    rules = [("d.com", f"/{deep}/bad/", "block")]
    urls = [f"http://d.com/{deep}/{last}/{'w' * (i + 1)}" for last in ("bad", "good") for i in range(40)]
    got = judged(spark, urls + ["http://d.com//a//b/", "http://d.com/a/b"], rules=rules)
    assert got[0].template.split("/")[3001] == "bad" and got[40].template.split("/")[3001] == "good"
    assert {got[i].verdict for i in range(40)} == {"block"} and {got[i].verdict for i in range(40, 82)} == {"allow"}
    assert got[80].template == got[81].template


def test_repeated_rows_and_extra_columns(spark):
    rows = [(1, "http://a.com/x", "h", "s", 0.5)] * 3 + [(None, None, None, None, None)]
    got = url_filter.judge(spark.createDataFrame(
        rows, "page_id long, url string, host string, segments string, purity double")).collect()
    assert sorted((r.page_id or 0, r.host, r.path, r.verdict) for r in got) == [
        (0, "", "", "allow")] + [(1, "a.com", "/x", "allow")] * 3
