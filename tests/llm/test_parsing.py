"""The fingerprints' parsing against a plain version over Python integers, one text at a time."""

from __future__ import annotations

import itertools
import random

import numpy as np

from cartlake.llm import fingerprint

FULL = (1 << 64) - 1


def mixed(h):
    h = ((h ^ (h >> 33)) * 0xFF51AFD7ED558CCD) & FULL
    h = ((h ^ (h >> 29)) * 0xC4CEB9FE1A85EC53) & FULL
    return h ^ (h >> 32)


def toss(x):
    out = []
    for i, own in enumerate(x):
        left = x[i - 1] if i else own ^ FULL
        at = next(b for b in range(64) if (own ^ left) >> b & 1)
        out.append(2 * at + (own >> at & 1))
    return out


def next_level(x):
    """Runs to names, three tosses, a phrase at each label above both its neighbours, two names a phrase at least."""
    y = []
    for name, run in itertools.groupby(x):
        length = len(list(run))
        y.append(mixed((name + length * 0x9E3779B97F4A7C15) & FULL) if length > 1 else name)
    label = toss(toss(toss(y)))
    assert all(a != b for a, b in zip(label, label[1:]))
    cuts = [0, *(i for i in range(2, len(y) - 1) if label[i] > max(label[i - 1], label[i + 1])), len(y)]
    return [mixed(sum(mixed((name + (j + 1) * 0x165667B19E3779F9) & FULL) for j, name in enumerate(y[a:b])) & FULL)
            for a, b in zip(cuts, cuts[1:])]


def plain_names(text):
    x, out = [mixed(ord(c)) for c in text], []
    for level in itertools.count():
        if not x:
            return out
        if len(x) == 1 or level >= fingerprint.FROM:
            out += [mixed((name + level) & FULL) for name in x]
        if len(x) == 1:
            return out
        x = next_level(x)


def some_texts():
    rng = random.Random(3)
    letters = ["ab", "abcdefgh ", "aé漢😀 \n", "a"]
    return ["", "a", "aa", "ab", "aab", "abb", "x" * 5000, *(
        "".join(rng.choices(rng.choice(letters), k=rng.randrange(1, 400))) for _ in range(300))]


def test_phrases_of_every_level():
    texts = some_texts()
    owner, name = fingerprint.phrase_names(texts)
    got = [[] for _ in texts]
    for i, n in zip(owner.tolist(), name.tolist()):
        got[i].append(n)
    for text, names in zip(texts, got):
        assert sorted(names) == sorted(plain_names(text)), repr(text[:40])


def test_fingerprints_and_likeness():
    texts = some_texts()
    prints = fingerprint.fingerprints(texts)
    plain = [sorted({n >> 32 for n in plain_names(t)})[:fingerprint.KEEP] for t in texts]
    assert [p.tolist() for p in prints] == plain
    for (a, pa), (b, pb) in zip(zip(prints, plain), zip(prints[1:], plain[1:])):
        if pa and pb:
            union = sorted(set(pa) | set(pb))[:fingerprint.KEEP]
            assert fingerprint.likeness(a, b) == len(set(union) & set(pa) & set(pb)) / len(union)
        else:
            assert fingerprint.likeness(a, b) == float(not pa and not pb)
    assert fingerprint.as_hex(np.array([1, 255], np.uint64)) == "00000001000000ff"


def test_phrases_do_not_depend_on_neighbours_in_the_batch():
    texts = some_texts()
    alone = [fingerprint.fingerprints([t])[0].tolist() for t in texts]
    assert alone == [p.tolist() for p in fingerprint.fingerprints(texts)]
    assert alone == [p.tolist() for p in fingerprint.fingerprints(texts[::-1])][::-1]
