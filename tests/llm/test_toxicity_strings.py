"""A text's strings and windows by plain loops, and that scoring does no match a token."""

import random
import re

import numpy as np

from cartlake.llm import toxicity

SIGNS = "aaabcéx日本İß \n\t.-,_' ​﻿ \x1c\x85。￿5\U0001F600  "
PLAIN_RUN = re.compile(r"(?<!\w)(?:\w[^\w\n]){2,}\w(?!\w)")


def texts(n):
    rng = random.Random(3)
    some = ["".join(rng.choice(SIGNS) for _ in range(rng.choice((0, 1, 3, 9, 40, 300)))) for _ in range(n)]
    return some + ["a b c dog _ x y z", "i-d-i-o-t!", "ab" * 90 + " ,,cd,,", "_a _ b c", "日本 日", "x." + "y" * 64 + "!"]


def plain_strings(text):
    low = text.lower()
    words = {w.strip(toxicity.MARKS) for w in low.split()} | {re.sub(r"\W", "", r) for r in PLAIN_RUN.findall(low)}
    long = lambda w: [w] if len(w) <= 64 else [w[i:i + 64] for i in range(0, len(w) - 32, 32)]
    return {p for w in words if len(w) >= 3 or len(w) == 2 and ord(w[0]) >= 0x2E80 for p in long(w)}


class Untouched:
    def findall(self, *_):
        raise AssertionError("a match a token")


def test_strings_are_those_of_plain_loops():
    assert all(toxicity.strings(t) == plain_strings(t) for t in texts(1500))


def test_margins_by_name_are_those_of_the_strings():
    model = toxicity.Model(np.random.default_rng(2).normal(size=1 << toxicity.BITS), 0.5, 1.0, 0.0)
    known = {}
    for t in texts(300):
        own = toxicity.names(t.lower())
        toxicity._judge(model, own.difference(known), known)
        judged = sorted(plain_strings(t))
        want = max(model.scores(judged), default=-np.inf) if judged else -np.inf
        assert np.isclose(max(map(known.__getitem__, own), default=-np.inf), want) or want == -np.inf == max(map(known.__getitem__, own), default=-np.inf)
    assert max(map(len, known)) <= toxicity.WINDOW + 1


def test_tokens_of_texts_come_from_a_table(monkeypatch):
    weights = np.random.default_rng(2).normal(size=1 << toxicity.BITS)
    table = toxicity._token_codes() if hasattr(toxicity, "_token_codes") else None
    some = texts(100)
    tokens = [toxicity.TOKEN.findall(t.lower()) for t in some]
    monkeypatch.setattr(toxicity, "TOKEN", Untouched())
    for t, own, (margin, window) in zip(some, tokens, toxicity.worst_windows(some, weights)):
        assert window in "".join(own) and (margin == -np.inf) == (not window)
        if window:
            assert np.isclose(toxicity.margins([window], weights)[0], margin)
    assert table is not None and len(table) == 1 << 16
