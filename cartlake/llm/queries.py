"""One query per operator over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, collocations, fingerprint, licences, mixing, near_dup, pii, quality, repeats, spelling, topk, toxicity,
               url_filter)
from .common import table


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=3, similarity_pct=85)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(toxicity.labelled_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.find(table(spark, sf_dir, "documents"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))

    def count(k: int):
        return F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")

    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"),
                        pii.as_text(F.col("spans")).alias("spans"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe.digests(table(spark, sf_dir, "documents"),
                       public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select("doc_id", *quality.MEASURES, "base_failed", "kept")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {f.__name__: f for f in (
    op1_topk, op2_url_filter, op3_minhash, op4_toxicity, op5_repeats, op6_fingerprint, op7_pii, op8_mix_sources, op9_licences,
    op10_bpe, op11_collocations, op12_quality, op13_spelling)}

ORACLE_SQL = {
    "op1_topk": """
WITH fit AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2]))::BIGINT AS score
  FROM fit q JOIN fit c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op3_minhash": r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM split),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS an, b.n AS bn, count(*) AS shared
  FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * shared >= 85 * (an + bn - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, node) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.node = edges.a),
lowest AS (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN lowest USING (doc_id)
""",
    "op8_mix_sources": r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT AS draw
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source),
weighed AS (SELECT *, CASE rank % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM sources),
rounds(k, level, n) AS (
  SELECT 0, sum(source_size)::DOUBLE * 150 / 100 / sum(weight), 0 FROM weighed
  UNION ALL
  SELECT k + 1, CASE WHEN w IS NULL THEN level ELSE (words::DOUBLE * 150 / 100 - full_words) / w END, clamped FROM (
    SELECT k, level, n, (SELECT sum(source_size) FROM weighed) AS words,
           (SELECT coalesce(sum(source_size * 2), 0) FROM weighed WHERE source_size * 2 <= weight * level) AS full_words,
           (SELECT sum(weight) FROM weighed WHERE NOT (source_size * 2 <= weight * level)) AS w,
           (SELECT count(*) FROM weighed WHERE source_size * 2 <= weight * level) AS clamped
    FROM rounds) WHERE clamped > n),
last AS (SELECT level FROM rounds ORDER BY k DESC LIMIT 1),
targets AS (SELECT source, source_size, least((source_size * 2)::DOUBLE, weight * level) AS target FROM weighed, last),
goals AS (
  SELECT *, round(target)::BIGINT AS goal,
         CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS copies FROM targets),
lined AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.copies,
         g.goal - g.copies * g.source_size - coalesce(sum(s.size) OVER (
           PARTITION BY s.source ORDER BY s.draw, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, (copies * size + greatest(0, least(size, rest)))::BIGINT AS taken FROM lined
""",
    "op11_collocations": r"""
WITH pieces AS (
  SELECT lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, coalesce(text, '') AS text FROM documents)),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM split, (VALUES (1), (2), (3)) sizes(k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cuts AS (
  SELECT lang, phrase, a, s.cut, array_to_string(string_split(phrase, ' ')[1:s.cut], ' ') AS p, array_to_string(string_split(phrase, ' ')[s.cut + 1:], ' ') AS q
  FROM f JOIN (VALUES (2, 1), (3, 1), (3, 2)) s(k, cut) USING (k) WHERE a >= 10),
scored AS (
  SELECT c.lang, c.phrase, c.a, cut, x.a AS l, y.a AS r, ((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.p JOIN f y ON y.lang = c.lang AND y.phrase = c.q),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + 1], ' ') AS phrase, max(a) AS a
  FROM f, (VALUES (1), (2)) starts(i) WHERE k = 3 AND a >= 10 GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase WHERE g.a IS NULL OR 100 * g.a < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
""",
    "op12_quality": r"""
WITH rows AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM rows),
places AS (SELECT rid, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM split),
ahead AS (
  SELECT rid, i, x || ' ' || lead(x, 1) OVER p || ' ' || lead(x, 2) OVER p AS g3, lead(x, 3) OVER p || ' ' || lead(x, 4) OVER p AS to5,
         lead(x, 5) OVER p || ' ' || lead(x, 6) OVER p AS to7, lead(x, 7) OVER p || ' ' || lead(x, 8) OVER p || ' ' || lead(x, 9) OVER p AS to10
  FROM places WINDOW p AS (PARTITION BY rid ORDER BY i)),
grams AS (
  SELECT rid, 3 AS k, i, g3 AS g FROM ahead WHERE g3 IS NOT NULL
  UNION ALL SELECT rid, 5, i, g3 || ' ' || to5 FROM ahead WHERE to5 IS NOT NULL
  UNION ALL SELECT rid, 7, i, g3 || ' ' || to5 || ' ' || to7 FROM ahead WHERE to7 IS NOT NULL
  UNION ALL SELECT rid, 10, i, g3 || ' ' || to5 || ' ' || to7 || ' ' || to10 FROM ahead WHERE to10 IS NOT NULL),
twice AS (SELECT rid, k, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, k, g) > 1),
cover AS (SELECT DISTINCT rid, k, unnest(range(i, i + k)) AS i FROM twice),
covered AS (
  SELECT rid, count(*) FILTER (k = 5) AS n5, sum(length(x)) FILTER (k = 3) AS c3, sum(length(x)) FILTER (k = 5) AS c5,
         sum(length(x)) FILTER (k = 7) AS c7, sum(length(x)) FILTER (k = 10) AS c10
  FROM cover JOIN places USING (rid, i) GROUP BY rid),
lines AS (SELECT rid, unnest(range(len(string_split(text, chr(10))))) AS place, unnest(string_split(text, chr(10))) AS line FROM rows),
dups AS (
  SELECT rid, count(*) AS n, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS chars
  FROM (SELECT rid, line FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
        QUALIFY row_number() OVER (PARTITION BY rid, line ORDER BY place) > 1) GROUP BY rid),
all_of AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(d.n, 0)::BIGINT AS n_dup_lines,
         coalesce(c.n5, 0)::BIGINT AS n_repeat_words, coalesce(d.chars, 0) AS dup_chars,
         coalesce(c3, 0) AS c3, coalesce(c5, 0) AS c5, coalesce(c7, 0) AS c7, coalesce(c10, 0) AS c10
  FROM split LEFT JOIN covered c USING (rid) LEFT JOIN dups d USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * n_symbols <= 10 * n_words AND 100 * dup_chars <= 30 * word_chars
         AND 100 * c3 <= 50 * word_chars AND 100 * c5 <= 30 * word_chars AND 100 * c7 <= 25 * word_chars AND 100 * c10 <= 20 * word_chars AS kept
FROM all_of
""",
    "op13_spelling": r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
counts AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS h FROM runs WHERE length(run) >= 5 GROUP BY ALL),
named AS (
  SELECT run, n, xor(list_reduce([4294967295] || list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
                                 lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM counts, crc),
results AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM named),
words AS (SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
variants AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS s FROM less),
near AS (
  SELECT a.word, b.word AS other FROM variants a JOIN variants b ON a.i = b.i AND a.s = b.s AND a.word <> b.word
  UNION SELECT a.word, b.word FROM variants a JOIN words b ON b.word = a.s
  UNION SELECT b.word, a.word FROM variants a JOIN words b ON b.word = a.s),
best AS (
  SELECT near.word, other, n, count(*) OVER (PARTITION BY near.word) AS n_near FROM near JOIN words ON words.word = other
  QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) = 1),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN b.n >= 2 * w.n THEN other END AS form, CASE WHEN b.n >= 2 * w.n THEN b.n END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
chain(word, last) AS (SELECT word, word FROM formed UNION ALL SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.last WHERE form IS NOT NULL)
SELECT f.word, f.form, c.last AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c USING (word) JOIN formed e ON e.word = c.last AND e.form IS NULL
""",
}
