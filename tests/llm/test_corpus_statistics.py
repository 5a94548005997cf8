"""Quality rules, phrases and spelling variants against brute force on small tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cartlake.llm import collocations, quality, spelling
from cartlake.llm import tokens as T

# columns named like those the operators make, to clash with them
SCHEMA = "doc_id long, text string, lang string, n long, word string, a long, `kept` boolean, bucket int"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark, texts, langs=("en", "de", None)):
    rows = [(i, t, langs[i % len(langs)], 7, "w", 1, False, 3) for i, t in enumerate(texts)]
    rows += [(None, None, None, None, None, None, None, None), (None, "", "en", 1, "", 1, True, 0), (902, " \n\t ", "en", 1, "", 1, True, 0)]
    return spark.createDataFrame(rows + rows[:1], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 7))) for _ in range(40)] + ["The", "OF", "#", "a|b", "x y", "日本"]
    seps = [" ", " ", " ", " ", "\n", "\t", ". ", ", ", "\x0b", "  ", ";"]
    out = ["".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(3, 150))) for _ in range(60)]
    line = "one two three four five six seven eight nine ten eleven"
    out += [line, "\n".join([line] * 6), f"{line}\n{line}\n\n \n", "to be " * 400, "#### $$$ " * 30 + line, "z" * 50_000, line + " " + "q" * 30_000 + " " + line]
    return out


def rules(text):
    """Measures by plain loops."""
    w = re.findall(WORD, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    again = [x for i, x in enumerate(lines) if x in lines[:i]]

    def cover(n):
        at = defaultdict(list)
        for i in range(len(w) - n + 1):
            at[tuple(w[i:i + n])].append(i)
        return {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + n)}
    chars = sum(map(len, w))
    covers = {n: sum(len(w[i]) for i in cover(n)) for n in quality.LIMITS}
    symbols, dup_chars = len(re.findall(r"[#*$%&|<>]", text or "")), sum(len("".join(re.findall(WORD, x))) for x in again)
    failed = len(w) < 10 or 100 * len(cover(5)) > 20 * len(w)
    ok = not failed and 100 * symbols <= quality.SYMBOL_PCT * len(w) and 100 * dup_chars <= quality.LINE_PCT * chars
    return (len(w), chars, symbols, len(again), len(cover(5)), dup_chars, *(covers[n] for n in sorted(covers)), failed,
            ok and all(100 * covers[n] <= p * chars for n, p in quality.LIMITS.items()))


def test_quality_equals_plain_loops(spark, texts):
    docs = table(spark, texts)
    rows = docs.collect()
    got = Counter(tuple(r) for r in quality.judge(docs).collect())
    assert got == Counter((r.doc_id, *rules(r.text)) for r in rows)
    kept = quality.keep(docs)
    assert kept.schema == docs.schema
    assert Counter(map(tuple, kept.collect())) == Counter(tuple(r) for r in rows if rules(r.text)[-1])
    none = spark.createDataFrame([], SCHEMA)
    assert quality.judge(none).count() == 0 and quality.keep(none).count() == 0


def test_colliding_hashes_do_not_count():
    code, text = np.array([0, 1, 2, 3, 0, 1]), np.zeros(6, np.int64)
    order, first = T.same(np.zeros(5, np.uint64), [text[:5], code[:5], code[1:]])
    classes = np.split(order, np.flatnonzero(first)[1:])
    assert sorted(sorted(c.tolist()) for c in classes) == [[0, 4], [1], [2], [3]]


def test_a_summary_keeps_every_frequent_name():
    rng = np.random.default_rng(5)
    stream = np.concatenate([rng.integers(0, 5000, 6000), np.repeat(np.arange(9000, 9040), 10), np.full(3000, 77)]).astype(np.uint32)
    rng.shuffle(stream)
    summary = collocations.Summary(len(stream) // 10 + 1)
    for part in np.array_split(stream, 12):
        names, counts = np.unique(part, return_counts=True)
        back = collocations.unpack(collocations.pack(names, counts))
        assert (back[0] == names).all() and (back[1] == counts).all()
        summary.merge([back])
    true = Counter(stream.tolist())
    held = dict(zip(summary.names.tolist(), summary.counts.tolist()))
    assert summary.off > 0 and len(held) <= summary.capacity
    assert all(held[x] + summary.off >= n >= held[x] for x, n in true.items() if n >= 10)
    assert summary.off * (summary.capacity + 1) <= len(stream)


def phrases(rows, threshold, top):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) < 2 or a < threshold:
            continue
        if len(p) == 2 and any(len(q) == 3 and x == lang and p in (q[:2], q[1:]) and b >= threshold and 100 * b >= 50 * a
                               for (x, q), b in f.items()):
            continue
        score, _, l, r = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return {(lang, rank, p.decode(), -a, l, r, total[lang], -score)
            for lang, found in out.items() for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1)}


def test_phrases_equal_plain_counting(spark, texts):
    docs = table(spark, texts)
    rows = [(r.lang, r.text) for r in docs.collect()]
    for threshold, top in ((10, 2000), (4, 7)):
        got = collocations.collocations(docs, threshold=threshold, top=top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert {tuple(r) for r in got.collect()} == phrases(rows, threshold, top)
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(rows):
    n = Counter()
    for doc_id, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += len(run) >= 5
    n = {w: c for w, c in n.items() if c >= 3}
    out, form = {}, {}
    for w in n:
        close = sorted((-n[v], v) for v in n if near(w, v))
        best = close[0][1] if close and -close[0][0] >= 2 * n[w] else None
        form[w], out[w] = best, len(close)
    result = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        result.add((w, n[w], out[w], form[w], n.get(form[w]), root))
    return result


def test_spelling_equals_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abéÿ") for _ in range(rng.randint(5, 8))) for _ in range(25)] + ["aaaaa", "aaaaaa", "aaaaaaa", "x" * 90, "x" * 91]

    def changed(w):
        i = rng.randrange(len(w))
        return rng.choice([w, w, w[:i] + w[i + 1:], w[:i] + rng.choice("abé") + w[i:], w[:i] + rng.choice("abÀ") + w[i + 1:], w.title()])
    docs = table(spark, [" ".join(changed(rng.choice(base)) + rng.choice([",", "", "7", "日"]) for _ in range(120)) for _ in range(40)]
                 + ["colour " * 4 + "colours " * 9 + "coloures " * 21 + "colouress " * 48])
    want = variants([(r.doc_id, r.text) for r in docs.collect()])
    assert any(root != form for _, _, _, form, _, root in want if form)
    for cell_words in (1 << 15, 20):  # 20: blocks of an index and of its queries
        got = spelling.group(docs, cell_words=cell_words)
        assert {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got.collect()} == want
    assert spelling.group(spark.createDataFrame([], SCHEMA)).count() == 0


def test_index_finds_single_edits_beyond_the_exact_half():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(5, 9))) for _ in range(400)})
    index, asked = spelling.Index(words), [*words[::3], "zzzzz", "abzab", "aaaaaaaaaaaa"]
    for scheme in ("prefix", "suffix"):
        def stands(q, w):
            h = len(q) // 2
            return w[:h] == q[:h] if scheme == "prefix" else w.endswith(q[h:])
        want = {(i, j) for i, q in enumerate(asked) for j, w in enumerate(words) if near(q, w) and stands(q, w)}
        assert set(zip(*(x.tolist() for x in index.near(asked, scheme)))) == want


def test_blocks_hold_every_row_and_whole_texts():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n if n else None for n in (0, 5, 50, 3, 0, 7)])], names=["text"])
    cut = list(T.blocks([batch], "text", 10))
    assert pa.Table.from_batches(cut) == pa.Table.from_batches([batch])
    assert max(b.num_rows for b in cut) < 6
