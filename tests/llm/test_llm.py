"""Small brute-force tests of the training-data operators: odd rows, empty tables, exact results."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cartlake.llm import bpe, fingerprint, licences, mixing, near_dup, pii, repeats, topk, toxicity, url_filter

SCHEMA = "doc_id long, text string, source string, score double"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def docs_of(spark, texts, extra=()):
    """Documents with NULLs, an empty text, a repeated row and a clashing extra column."""
    rows = [(i, t, f"s{i % 3}", 0.5) for i, t in enumerate(texts)]
    rows += [(900, None, None, None), (901, "", "s1", None), (902, "  \n ", None, 1.0), rows[0], *extra]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeé ñ.")[:1] for _ in range(rng.randint(1, 6))).strip() or "x" for _ in range(200)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 120))) for _ in range(25)]
    near = [t + " tail" for t in base[:8]] + [t.upper() for t in base[8:12]]
    return base + near + ["z" * 3000]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_bpe_equals_the_library_and_decodes(spark, texts):
    ranks = bpe.read_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = docs_of(spark, texts)
    for r in bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN).collect():
        text = next((x.text for x in docs.collect() if x.doc_id == r.doc_id), None) or ""
        assert r.ids == " ".join(map(str, own.encode_ordinary(text))) and r.decoded == text
    assert bpe.digests(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0
    machine = bpe.Transducer(ranks)
    long = b"abcab" * 2000
    assert list(machine.tokens(long)) == own.encode_ordinary("abcab" * 2000) == machine.encode(long)


def test_utf8_stream_holds_back_unfinished_characters():
    stream, data = bpe.Utf8Stream(), "aé€😀z".encode()
    assert "".join(stream.feed(data[i:i + 1]) for i in range(len(data))) + stream.end() == "aé€😀z"


def test_near_duplicates_equal_brute_force(spark, texts):
    docs = docs_of(spark, texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs, words=3, similarity_pct=85).collect()}

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    low = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                    low[a] = low[b] = min(low[a], low[b])
    assert got == {i: (len(s), low[i]) for i, s in sets.items()}
    assert near_dup.near_duplicates(empty(spark)).count() == 0
    kept = near_dup.keep_one(docs, words=3, similarity_pct=85)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in sets if low[i] == i)


def test_repeats_equal_brute_force(spark):
    rng = random.Random(2)
    shared = "".join(rng.choice("abcd ") for _ in range(900))
    some = [shared[:600] + "x", "q" + shared[100:], shared[150:549], shared[150:550], "a" * 401, "ab" * 450, "é" * 300]
    some += [shared[rng.randint(0, 200):rng.randint(500, 900)] + str(i) for i in range(12)]
    docs = docs_of(spark, some)
    data = [((r.doc_id, i), (r.text or "").encode()) for i, r in enumerate(docs.collect())]
    seen = Counter(b[i:i + 400] for _, b in data for i in range(len(b) - 399))
    want = Counter()
    for (d, _), b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - 399):
            if seen[b[i:i + 400]] > 1:
                gone[i:i + 400] = b"\1" * 400
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        want[d, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()] += 1
    assert Counter(tuple(r) for r in repeats.find(docs).collect()) == want
    assert repeats.find(empty(spark)).count() == 0


def test_fingerprints(spark, texts):
    docs = docs_of(spark, texts)
    rows = fingerprint.compare_with_next(docs).collect()
    line = sorted(((r.doc_id, r.text or "") for r in docs.collect()))
    want = Counter((d, len(t), hashlib.sha256(fingerprint.edited(t, n).encode()).hexdigest())
                   for (d, t), (_, n) in zip(line, line[1:] + line[:1]))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    first = [r for r in rows if r.doc_id == 0]
    assert len(first) == 2 and first[0].fingerprint == first[1].fingerprint
    one, other = fingerprint.fingerprints([texts[0] * 3, "some lead " + texts[0] * 3])
    assert fingerprint.likeness(one, other) > 0.5
    assert fingerprint.compare_with_next(empty(spark)).count() == 0


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(3)
    parts = ["a@b.c", "@", ".", "_x@d.e-f", "1.2.3.4", ".5", "4041894974608795", "4111 1111-1111 1111", " ", "+",
             "+1 (456) 555-2186", "é", "999", "256.1.1.1", "%", "😀"]
    docs = docs_of(spark, ["".join(rng.choice(parts) for _ in range(rng.randint(1, 20))) for _ in range(150)])
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    def fits(kind, hit):
        d = re.sub("[^0-9]", "", hit)
        return {"email": True, "ip": all(int(p) < 256 for p in hit.split(".")) if kind == "ip" else False,
                "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in pii.find(docs).select("doc_id", pii.as_text(pii.F.col("base")).alias("b"), pii.as_text(pii.F.col("spans")).alias("s")).collect():
        want = [f"{k}:{m.start()}:{m.end()}" for k, p in plain.items() for m in re.finditer(p, texts[r.doc_id]) if fits(k, m[0])]
        assert r.b == ",".join(want)
        assert set(want) <= set(r.s.split(",")) | {""}
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.where("text LIKE '%a@b.c%'").isEmpty()
    assert pii.find(empty(spark)).count() == 0


def number(rng, n=16):
    return "".join(rng.choice("0123456789") for _ in range(n))


def test_personal_data_limits_see_all_candidates(spark):
    """Few addresses among many numbers and many copies still get a limit."""
    rng = random.Random(5)
    texts = [f"see {number(rng)} and {number(rng, 8)} here" for _ in range(1500)] + ["copy 5555 1234 x"] * 2000
    texts += [f"mail u{i}@host{i % 7}.org today" for i in range(120)] + ["mail joe @ example.org today"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.s for r in pii.find(docs, max_train=200).select("doc_id", pii.as_text(pii.F.col("spans")).alias("s")).collect()}
    assert got[len(texts) - 1] == "email:5:22"


def test_personal_data_in_loose_formats_is_found(spark):
    rng = random.Random(7)
    texts = []
    for i in range(160):
        texts += [f"write to u{i}.x@host{i % 9}.org now", f"host {rng.randint(1, 254)}.{rng.randint(0, 255)}.0.{i} is up",
                  f"call +1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)} soon",
                  f"order {number(rng, 11)} came", f"sum {number(rng, 8)} and {number(rng, 18)} here",
                  f"v {rng.randint(256, 999)}.1.2.{i} old", f"paid {i} @ 3.{10 + i} each"]
    loose = ["joe (at) example (dot) org", "joe @ example.org", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "1 (456) 555-2186"]
    bad = ["order 45655521861 x", "300.1.2.3 x", "7 @ 3.50 x"]
    docs = spark.createDataFrame(list(enumerate(texts + [f"call or write {x} today" for x in loose] + bad * 12)), "doc_id long, text string")
    got = {r.doc_id: r.s for r in pii.find(docs).select("doc_id", pii.as_text(pii.F.col("spans")).alias("s")).collect()}
    kinds = ["email", "email", "ip", "phone"]
    n = len(texts)
    assert [got[n + i] for i in range(4)] == [f"{k}:14:{14 + len(x)}" for k, x in zip(kinds, loose)]
    assert got[n + 4] == "" and got[n + 5] == ""


def test_personal_data_is_rewritten_into_loose_formats(spark):
    hits = [(0, "joe@x.example.org"), (1, "10.2.3.4"), (2, "4111 1111-1111 1111"), (3, "+1 (456) 555-2186")]
    df = spark.createDataFrame(hits, "kind int, hit string").select("kind", pii._rewritten(pii.F.col("kind"), pii.F.col("hit")).alias("x"))
    got = {r.kind: r.x for r in df.collect()}
    assert {"joe@x.example.org", "joe @ x.example.org", "joe (at) x (dot) example (dot) org", "joe[at]x.example.org"} <= set(got[0])
    assert sum(x.count(":") == 7 for x in got[1]) == 2
    assert "4111.1111.1111.1111" in got[2] and "1 (456) 555-2186" in got[3] and "1.456.555.2186" in got[3]


def test_mix_meets_targets(spark, texts):
    docs = docs_of(spark, texts)
    rows = mixing.mix(docs).collect()
    by = {}
    for r in rows:
        by.setdefault((r.source, r.source_size, r.target), []).append(r)
        assert r.taken <= 2 * r.size
    for (_, size, target), some in by.items():
        assert sum(r.size for r in some) == size and abs(sum(r.taken for r in some) - target) <= 0.5
    assert abs(sum(t for _, _, t in by) - 1.5 * sum(s for _, s, _ in by)) < 1e-6
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=repr) == sorted(map(tuple, rows), key=repr)
    assert mixing.repeat(docs).columns == docs.columns
    assert mixing.mix(empty(spark)).count() == 0


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(120)]
    rows += [(200, None), (201, [1.0, None]), (202, [float("nan")] * 8), (203, rows[5][1]), (204, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = {i: np.floor(np.array(v) * 256).astype(int) for i, v in rows if v and None not in v and not np.isnan(v).any()}
    want = set()
    for q in (i for i in good if i % 50 == 0):
        order = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q)[:5]
        want |= {(q, r, i, -s) for r, (s, i) in enumerate(order, 1)}
    got = topk.top_k(df.where("vec_id % 50 = 0"), df, shard_rows=40, query_rows=2)
    assert {tuple(r) for r in got.collect()} == want
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_toxicity_learns_gapped_insults(spark):
    rng = random.Random(6)
    calm = ["the", "cat", "went", "over", "under", "with", "house", "table", "river"]
    rows = [" ".join(rng.choice(calm) for _ in range(20)) for _ in range(80)]
    bad = [r + " you " + rng.choice(["blockhead", "numbskull"]) for r in rows[:40]]
    model = toxicity.fit(rows + bad, [0] * 80 + [1] * 40)
    docs = spark.createDataFrame([(1, bad[0], 1), (2, rows[70], 0), (3, None, 0), (4, "", 1), (5, "the block-head", 1)],
                                 "doc_id long, text string, score int")
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert got[1] > 0.5 > got[2] and got[3] == got[4] <= got[2] and got[5] > got[2]
    assert toxicity.reject(docs, model).columns == docs.columns
    assert toxicity.fit(rows, [0] * 80) is None


def test_toxicity_reads_long_strings_whole(spark):
    rng = random.Random(8)
    calm = ["the", "cat", "went", "over", "under", "with", "house", "table", "river"]
    rows = [" ".join(rng.choice(calm) for _ in range(20)) for _ in range(80)]
    bad = [r + " you " + rng.choice(["blockhead", "numbskull"]) for r in rows[:40]]
    model = toxicity.fit(rows + bad, [0] * 80 + [1] * 40)
    plain = "".join(rng.choice(calm) for _ in range(300))
    docs = spark.createDataFrame([(0, plain)] + [(at, plain[:at] + "blockhead" + plain[at:]) for at in (40, 251, 300, 1000)],
                                 "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(plain) > 1000 and min(got[at] for at in (40, 251, 300, 1000)) > got[0]
    for n in (63, 64, 65, 96, 97, 1000):
        word = "".join(chr(0x4E00 + i) for i in range(n))
        found = toxicity.strings(word)
        assert all(any(word[i:i + toxicity.OVERLAP] in w for w in found) for i in range(n - toxicity.OVERLAP + 1))


def test_toxicity_windows_join_what_separators_part(spark):
    rng = random.Random(6)
    calm = ["the", "cat", "went", "over", "under", "with", "house", "table", "river"]
    rows = [" ".join(rng.choice(calm) for _ in range(20)) for _ in range(80)]
    bad = [r + " you " + rng.choice(["blockhead", "numbskull", "笨蛋"]) for r in rows[:60]]
    model = toxicity.fit(rows + bad, [0] * 80 + [1] * 60)
    shapes = ["b l o c k h e a d", "b - l - o - c - k - h - e - a - d", "block head", "b--l--o--c--k--h--e--a--d",
              "b.\nl.\no.\nc.\nk.\nh.\ne.\na.\nd", "thecat" * 60 + "blockhead" + "overthehouse" * 9, "笨蛋", "你好笨蛋你们", "笨 蛋"]
    docs = spark.createDataFrame([(i, "the cat went " + x + " over") for i, x in enumerate(shapes + ["t a b l e", "你好"])],
                                 "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all(got[i] >= toxicity.LIMIT for i in range(len(shapes))), got
    assert got[len(shapes)] < toxicity.LIMIT and got[len(shapes) + 1] < toxicity.LIMIT
    for t in [*rows[:5], *bad, "a b c 笨蛋你好 " + "z" * 70]:      # a window weighs what it weighs as a string
        margin, window = toxicity.worst_windows([t], model.weights)[0]
        assert abs(margin - toxicity.margins([window], model.weights)[0]) < 1e-9


def test_url_verdicts(spark):
    rows = [(1, "http://A.Example.NET/en/1"), (2, "https://x.net/a"), (3, None), (4, "no url"), (5, "http://h.example.com/de/4?x#y"),
            (6, "http://h.example.com/en/4"), (7, "ftp://my.org/fr/"), (8, "http://q.com"), (2, "https://x.net/a")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(
        spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[1] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[2] == ("x.net", "/a", "net/", "block") and got[5] == ("h.example.com", "/de/4", "example.com/de/", "block")
    assert got[3] == got[4] == ("", "", None, "allow") and got[7][2:] == ("org/fr/", "allow") and got[8] == ("q.com", "", None, "allow")
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_licences(spark, texts):
    docs = docs_of(spark, texts, [(50, "intro\nReleased under the MIT License.\nend", "s", 0.0),
                                  (51, "Licensed under the Apache License, Version 2.0.", "s", 0.0),
                                  (52, "you need a driving licence here", "s", 0.0)])
    got = {r.doc_id: r.families for r in licences.scan(docs).collect()}
    assert got[50] == "MIT" and got[51] == "Apache-2.0" and got[52] == "" and got[900] == ""


def test_licence_notices_wrapped_or_double(spark, texts):
    gpl = ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by",
           "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version."]
    mpl = ["This Source Code Form is subject to the terms of the Mozilla Public", "License, v. 2.0. If a copy of the MPL was not distributed with this",
           "file, You can obtain one at http://mozilla.org/MPL/2.0/."]
    gpl2 = [x.replace("version 3", "version 2") for x in gpl]
    docs = docs_of(spark, texts, [(i, t, "s", 0.0) for i, t in enumerate([
        "Name\n\n" + "\n".join(gpl) + "\n\nmore", "\n".join(" * " + x for x in ["Name", "", *gpl]), "\n".join("# " + x for x in mpl),
        "This project is licensed under the terms of the MIT license or the Apache License, Version 2.0.", "\n".join(gpl2),
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"], 50)])
    got = {r.doc_id: r.families for r in licences.scan(docs).collect()}
    assert [got[i] for i in range(50, 56)] == ["GPL-3.0", "GPL-3.0", "MPL-2.0", "Apache-2.0,MIT", "", "CC-BY-NC-4.0"]


def test_shingle_names_of_blocks_equal_brute_force(monkeypatch):
    from cartlake.llm import near_dup
    texts = [None, "", " \t\r\n", "a", "a b", "A  B", "b a", "a b c", "a b c a b c", "x y éÉ z w",
             "w" * 50 + " tail of it", "a b c", " ".join(str(i % 7) for i in range(500))]

    def brute(text):
        words = (text or "").encode().translate(bytes(range(256)).lower()).split()
        if not words:
            return set()
        size = min(3, len(words))
        return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}

    for piece in (1 << 22, 5):                     # pieces end between words, however small
        monkeypatch.setattr(near_dup, "PIECE_BYTES", piece)
        got = [set(s.tolist()) for s in near_dup.shingle_sets(texts, 3)]
        want = [brute(t) for t in texts]
        assert [len(s) for s in got] == [len(s) for s in want]
        assert all((len(a & b) == len(c & d)) for a, c in zip(got, want) for b, d in zip(got, want))
    assert [len(s) for s in near_dup.shingle_sets([""], 3)] == [0]


def test_sketch_overlap_follows_the_similarity():
    from math import comb
    for k, pct in ((32, 50), (32, 80), (32, 85), (32, 100), (64, 30)):
        m, t = near_dup.needed(k, pct), pct / 100
        assert 1 <= m <= k and sum(comb(k, i) * t ** i * (1 - t) ** (k - i) for i in range(m)) <= 1e-5
    assert near_dup.needed(32, 50) < 16 and near_dup.needed(32, 80) < 16
    assert near_dup.sketch_size(32, 80) == 32 and near_dup.needed(near_dup.sketch_size(32, 10), 10) >= 1


def test_rows_that_a_join_needs_stay_and_most_others_go_before_it(spark):
    rows = spark.range(20000).selectExpr("CAST(id AS STRING) AS key", "id").unionByName(
        spark.createDataFrame([(None, -1), ("7", -2)], "key string, id long"))
    wanted = spark.createDataFrame([(str(i),) for i in range(0, 20000, 1000)] + [(None,), ("7",), ("7",)], "which string")
    got = near_dup._may_hold(rows, "key", wanted, "which")
    assert got.columns == ["key", "id"]
    ids = sorted(r.id for r in got.collect())
    assert set(ids) >= {-2, -1, 7, *range(0, 20000, 1000)} and len(ids) == len(set(ids)) < 200
    assert near_dup._may_hold(rows, "key", wanted.limit(0), "which").count() == 0


def test_wide_rows_are_filtered_before_the_shuffle_of_their_join(spark, monkeypatch):
    """Neither whole texts nor whole sets are dealt out for a join that needs a few of them."""
    met = []
    plain = near_dup._may_hold
    monkeypatch.setattr(near_dup, "_may_hold", lambda *a: met.append(a[1]) or plain(*a))
    docs = spark.createDataFrame([(i, f"w{i} a b c d e f g h i j k l m n") for i in range(6)], "doc_id long, text string")
    got = near_dup.near_duplicates(docs, words=1, similarity_pct=85).collect()
    assert {r.component_id for r in got} == {0} and met[0] == "__id" and met.count("sig") >= 2


def test_bounded_tables_and_blocks_give_the_same_tokens(spark, texts, monkeypatch):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    codec = bpe.Codec(bpe.read_ranks(RANKS), public_tokenizers.PATTERN, max_pieces=20, max_states=30)
    for t in texts * 2:
        assert codec.encode(t) == " ".join(map(str, own.encode_ordinary(t)))
        assert len(codec.pieces) <= 20 and len(codec.pieces.older) <= 20
    assert len(codec.machine.pairs) <= 4 * 30
    # a common piece outlives a generation: it is not encoded again
    met = []
    plain = codec.machine.encode
    monkeypatch.setattr(codec.machine, "encode", lambda data: met.append(data) or plain(data))
    for i in range(100):
        codec.encode(f"qzx{i}")
        codec.encode("qzxcommon")
    assert met.count(b"qzxcommon") <= 1
    docs = docs_of(spark, texts)
    got = sorted((r.doc_id, r.n_tokens, r.ids) for r in bpe.encode(docs, RANKS, public_tokenizers.PATTERN, tables=(30, 20)).collect())
    assert got == sorted((r.doc_id, len(i := own.encode_ordinary(r.text or "")), " ".join(map(str, i))) for r in docs.collect())
