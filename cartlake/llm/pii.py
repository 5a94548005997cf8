"""Personal data: fixed patterns, plus candidate spans chosen by boosted trees (DataFrame operations only).

Base spans are the leftmost non-overlapping matches of one pattern a kind that pass the
kind's check (parts of an ip, Luhn, number of digits); a match that fails is dropped.

Beyond them, high-recall generators propose spans that may overlap one another and the
base spans: bracketed and spaced addresses, numbers of 7 to 19 digits in any grouping,
dotted and colon-separated addresses.  Gradient-boosted trees score each candidate by its
format and the text around it.  They learn from the corpus itself: a candidate that covers
a base span is personal, and so is the same one rewritten into the formats that only the
generators know (bracketed and spaced address, number without plus or with other marks,
colon-separated address of the same context); one that overlaps no base span and fails a
real check (top-level name, parts of an ip, Luhn, number of digits, or a word such as
"order" before it) is not.  Other candidates have no label.  Copies of a
candidate in the same context are one; a hash deals them to two halves.  The trees are fit
on about ``max_train`` of the first half, as many of each kind and label as there are, up to
an equal share.  On all of the second half, copies counted, a threshold is set for each
kind, the lowest at which precision reaches ``precision``; a kind that never reaches it
adds nothing.  Of the chosen candidates that
overlap no base span, the best one of each overlapping cluster is added.

Patterns use possessive and anchored forms of the plain ones: they match the same spans
in linear time and do not recurse on long runs.

Defined results: a NULL or empty text has no spans; positions count code points, ends are
exclusive; texts of any length are read whole; repeated rows are judged alike; an empty
table, or one without both sorts of candidates, adds no spans; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, may_hold, surely_not_held, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: kind -> the pattern of its base spans
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: kind -> a cheap sign without which its pattern cannot match
SIGN = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
#: kind -> the pattern of its candidates
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?@\x20?|\x20?[\[(](?i:at)[\])]\x20?)"
             r"[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(](?i:dot)[\])]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z:.])(?:[0-9]++(?:\.[0-9]++){3,}+|(?:[0-9A-Fa-f]{1,4}+:){7}+[0-9A-Fa-f]{1,4}+)(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]{0,2}+[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])[(+]{0,2}+[0-9](?:[\x20()./-]{0,2}+[0-9]){6,14}+(?![0-9])",
}
LOOSE_SIGN = {"email": r"@|[\[(][aA][tT][\])]", "ip": r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]",
              "card": r"[0-9][\x20./-]{0,2}[0-9]", "phone": r"[0-9][\x20()./-]{0,2}[0-9]"}
CUES = r"(?i)\b(?:e-?mail|mail|contact|write|ip|host|address|server|card|visa|credit|account|phone|tel|call|mobile|fax)\b"
NOT_CUES = r"(?i)\b(?:isbn|issn|order|invoice|version|page|id|no|nr|ref|doi)\W*$"
FEATURES = ("kind", "n_chars", "n_digits", "n_letters", "n_marks", "n_groups", "first_group", "last_group",
            "luhn", "part_max", "plus", "at", "prev_kind", "next_kind", "cue", "counter_cue")
MAX_TRAIN = 20_000
BLOCK = 128
PRECISION = 0.97


def _found(text: Column, pattern: str, sign: str) -> Column:
    """array<struct<start, end, hit, prev, next>> of the pattern's matches: what lies
    between matches, from split, gives their places.  Places add up block by block, so a
    text with very many matches costs no quadratic copying."""
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.arrays_zip(hits.alias("hit"), F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"),
                         F.slice(gaps, F.lit(2), F.size(hits)).alias("after"))
    one = "struct<start:int,end:int,hit:string,prev:string,next:string>"
    none, no_blocks = F.array().cast(f"array<{one}>"), F.array().cast(f"array<array<{one}>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"),
                        F.right(x["gap"], F.lit(24)).alias("prev"), F.left(x["after"], F.lit(1)).alias("next"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def block(all_pairs: Column):
        def add(acc: Column, i: Column) -> Column:
            inner = F.aggregate(F.slice(all_pairs, i * BLOCK + 1, F.lit(BLOCK)),
                                F.struct(acc["at"].alias("at"), none.alias("out")), step)
            return F.transform(F.array(inner), lambda r: F.struct(
                r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out")))[0]
        return add

    def places(all_pairs: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), no_blocks.alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.floor(F.size(all_pairs) / BLOCK).cast("int")), zero,
                           block(all_pairs), lambda acc: F.flatten(acc["out"]))

    return F.when(text.rlike(sign), F.transform(F.array(pairs), places)[0]).otherwise(none)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    values = F.transform(F.split(F.reverse(digits), "", -1), lambda c, i: (F.ascii(c) - 48) * (i % 2 + 1))
    total = F.aggregate(values, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).when(d < 0, 0).otherwise(d))
    return (F.length(digits) > 0) & (total % 10 == 0)


def _passes(kind: str, hit: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        n = F.length(_digits(hit))
        return (n >= 13) & (n <= 19) & luhn(F.substring(_digits(hit), 1, 19))
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<kind int, start, end>> by kind, then start."""
    def of(k: int, kind: str) -> Column:
        kept = F.filter(_found(text, BASE[kind], SIGN[kind]), lambda x: _passes(kind, x["hit"]))
        return F.transform(kept, lambda x: F.struct(
            F.lit(k).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return F.concat(*(of(k, kind) for k, kind in enumerate(KINDS)))


def _candidates(text: Column) -> Column:
    def of(k: int, kind: str) -> Column:
        return F.transform(_found(text, LOOSE[kind], LOOSE_SIGN[kind]), lambda x: F.struct(
            F.lit(k).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["hit"].alias("hit"),
            x["prev"].alias("prev"), x["next"].alias("next")))
    return F.concat(*(of(k, kind) for k, kind in enumerate(KINDS)))


def _char_kind(c: Column) -> Column:
    return (F.when(F.coalesce(c, F.lit("")) == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike("[0-9]"), 2)
            .when(c.rlike(r"\p{L}"), 3).otherwise(4))


def _features(c: DataFrame) -> DataFrame:
    """Format and context features; none of them is the base check itself but Luhn and the ip parts."""
    hit, digits = F.col("hit"), _digits(F.col("hit"))
    groups = F.filter(F.split(hit, "[^0-9A-Za-z]+", -1), lambda g: g != "")
    numbers = F.transform(F.filter(groups, lambda g: g.rlike("^[0-9]{1,6}$")), lambda g: g.cast("int"))
    plain = F.regexp_replace(hit, r"^[+(]+", "")
    values = {
        "n_chars": F.length(plain), "n_digits": F.length(digits),
        "n_letters": F.length(F.regexp_replace(hit, r"[^A-Za-z]", "")),
        "n_marks": F.length(F.regexp_replace(plain, "[0-9A-Za-z]", "")), "n_groups": F.size(groups),
        "first_group": F.coalesce(F.length(F.get(groups, F.lit(0))), F.lit(0)),
        "last_group": F.coalesce(F.length(F.get(groups, F.size(groups) - 1)), F.lit(0)),
        "luhn": luhn(F.substring(digits, 1, 19)).cast("int"), "part_max": F.coalesce(F.array_max(numbers), F.lit(-1)),
        "plus": hit.startswith("+").cast("int"), "at": hit.contains("@").cast("int"),
        "prev_kind": _char_kind(F.right(F.col("prev"), F.lit(1))), "next_kind": _char_kind(F.col("next")),
        "cue": F.col("prev").rlike(CUES).cast("int"), "counter_cue": F.col("prev").rlike(NOT_CUES).cast("int"),
    }
    c = c.withColumns({n: v.cast("double") for n, v in values.items()}).withColumn("kind", F.col("kind").cast("double"))
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(c)


def _against_base(rows: DataFrame) -> DataFrame:
    """The candidates of rows (uid, base, candidates), one row each, with ``covers`` (a base
    span of its kind lies in it) and ``taken`` (it overlaps some base span): both kinds of
    spans run along the text once, by window."""
    spans = rows.select("uid", F.explode("base").alias("b")).select(
        "uid", "b.kind", "b.start", "b.end", F.lit(True).alias("is_base"))
    cands = rows.select("uid", F.explode("candidates").alias("c")).select("uid", "c.*", F.lit(False).alias("is_base"))
    line = Window.partitionBy("uid").orderBy("start")
    back, ahead = (line.rangeBetween(Window.unboundedPreceding, 0), line.rangeBetween(0, Window.unboundedFollowing))
    same = Window.partitionBy("uid", "kind").orderBy("start").rangeBetween(0, Window.unboundedFollowing)
    both = cands.unionByName(spans, allowMissingColumns=True).withColumns({
        "last_end": F.max(F.when(F.col("is_base"), F.col("end"))).over(back),
        "next_start": F.min(F.when(F.col("is_base"), F.col("start"))).over(ahead),
        "same_end": F.min(F.when(F.col("is_base"), F.col("end"))).over(same)})
    no = F.lit(False)
    return (both.where(~F.col("is_base"))
            .withColumn("taken", F.coalesce(F.col("last_end") > F.col("start"), no)
                        | F.coalesce(F.col("next_start") < F.col("end"), no))
            .withColumn("covers", F.coalesce(F.col("same_end") <= F.col("end"), no))
            .drop("is_base", "last_end", "next_start", "same_end"))


def _fails(kind: Column, hit: Column, prev: Column) -> Column:
    """Whether a candidate is known not to be personal."""
    checks = [hit.rlike(r"(?i)[a-z]{2,}$"), hit.contains(":") | _passes("ip", hit), _passes("card", hit), _passes("phone", hit)]
    fails = F.coalesce(*(F.when(kind == k, ~ok) for k, ok in enumerate(checks)))
    return fails | ((kind != KINDS.index("email")) & prev.rlike(NOT_CUES) & ~prev.rlike(CUES))


def _rewritten(kind: Column, hit: Column) -> Column:
    """array<string>: a personal hit as it is and in the formats that only the generators know."""
    def swap(pattern: str, new: str, of: Column = hit) -> Column:
        return F.regexp_replace(of, pattern, new)
    number, at = swap(r"^[+(]+", ""), r"\x20?@\x20?"
    forms = {
        "email": [swap(at, " @ "), swap(at, " (at) "), swap(at, "[at]")]
                 + [F.concat(swap("@.*", ""), F.lit(a), swap(r"\.", d, swap("^[^@]*@", ""))) for a, d in ((" (at) ", " (dot) "), (" [at] ", "[dot]"))],
        "ip": [swap("(.{4})(?=.)", "$1:", F.md5(hit)), swap("(.{4})(?=.)", "$1:", F.upper(F.md5(hit)))],
        "card": [swap(r"[\x20-]", "."), swap(r"[\x20-]", "/"), swap(r"[\x20-]", "  ")],
        "phone": [number, swap(r"[\x20()-]+", ".", number), swap(r"[\x20().]+", "-", number), swap(r"[().-]+", " ", number)],
    }

    def whole(name: str) -> Column:
        """The forms of a kind that its generator proposes whole."""
        return F.filter(F.array(*forms[name]), lambda x: x.rlike(f"^(?:{LOOSE[name]})$"))
    own = F.coalesce(*(F.when(kind == k, whole(name)) for k, name in enumerate(KINDS)))
    return F.array_distinct(F.concat(F.array(hit), own))


def _labelled(flat: DataFrame) -> DataFrame:
    """(kind, hit, prev, next, label, draw, n): the distinct labelled candidates, and how many
    there are of each.  The rewritten forms of a candidate have its draw, so they stay in its half."""
    fails = _fails(F.col("kind"), F.col("hit"), F.col("prev"))
    some = flat.where(F.col("covers") | (~F.col("taken") & fails)).withColumn("label", F.col("covers").cast("double"))
    some = some.withColumn("draw", F.xxhash64("kind", "hit", "prev", "next"))
    some = some.groupBy("kind", "hit", "prev", "next", "label", "draw").agg(F.count("*").alias("n"))
    forms = F.when(F.col("label") == 1, _rewritten(F.col("kind"), F.col("hit"))).otherwise(F.array("hit"))
    return some.withColumn("hit", F.explode(forms))


def _chosen(rows: DataFrame, max_train: int, precision: float) -> DataFrame | None:
    """(uid, added: array<struct<kind, start, end>>) from rows (uid, base, candidates); None if nothing can be learnt."""
    flat = materialize(_against_base(rows), "pii-candidates")
    known = materialize(_labelled(flat), "pii-labelled")
    train, tune = known.where("draw & 1 = 0"), known.where("draw & 1 = 1")
    sizes = train.groupBy("kind", "label").agg(F.count("*").alias("n")).collect()
    if len({r["label"] for r in sizes}) < 2:
        return None
    share = max_train / (2 * len(KINDS))
    rate = F.coalesce(*(F.when((F.col("kind") == r["kind"]) & (F.col("label") == r["label"]), F.lit(share / r["n"]))
                        for r in sizes))
    some = train.where(F.pmod(F.shiftright("draw", 1), F.lit(1 << 20)) < rate * (1 << 20))
    some = materialize(_features(some).select("features", "label"), "pii-train")
    if some.agg(F.countDistinct("label")).first()[0] < 2:
        return None
    model = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, seed=7, maxBins=32).fit(some)

    def score(df: DataFrame) -> DataFrame:
        return model.transform(_features(df)).withColumn("p", F.element_at(vector_to_array("probability"), 2))

    bins = (score(tune).groupBy("kind", F.floor(F.col("p") * 100).alias("bin"))
            .agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect())
    limits = {}
    for kind in range(len(KINDS)):
        good = n = 0.0
        for row in sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["bin"]):
            good, n = good + row["good"], n + row["n"]
            if (good + 0.5) / (n + 1) >= precision and row["bin"] >= 50:
                limits[kind] = row["bin"] / 100
    if not limits:
        return None
    limit = F.coalesce(*(F.when(F.col("kind") == k, F.lit(v)) for k, v in limits.items()), F.lit(2.0))
    good = score(flat.where(~F.col("taken"))).where(F.col("p") >= limit)
    # candidates that overlap form a cluster; its best one is added
    line = Window.partitionBy("uid").orderBy("start", "end", "kind")
    before = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    good = good.withColumn("opens", F.coalesce(before <= F.col("start"), F.lit(True)).cast("int"))
    good = good.withColumn("cluster", F.sum("opens").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    best = good.groupBy("uid", "cluster").agg(F.max_by(
        F.struct(F.col("kind").cast("int").alias("kind"), "start", "end"),
        F.struct("p", -F.col("start"), F.col("end"), -F.col("kind"))).alias("span"))
    return best.groupBy("uid").agg(F.collect_list("span").alias("added"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
         max_train: int = MAX_TRAIN, precision: float = PRECISION) -> DataFrame:
    """(doc_id, base, spans, row): spans as array<struct<kind, start, end>> by kind, then
    start, kind an index into KINDS; ``spans`` holds the base and the added ones, ``row``
    the columns named in ``keep``."""
    text = text_or_empty(text_col)
    kept = F.struct(*(F.col(c) for c in keep)) if keep else F.lit(0)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"),
                       base_spans(text).alias("base"), _candidates(text).alias("candidates"), kept.alias("row"))
    rows = materialize(rows, "pii-spans")
    added = _chosen(rows.select("uid", "base", "candidates"), max_train, precision)
    if added is None:
        return rows.select("doc_id", "base", F.col("base").alias("spans"), "row")
    added = materialize(added, "pii-added")
    rows = rows.select("uid", "doc_id", "base", "row")
    both = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    # only rows that may have an added span meet them; all others, with their texts, go past the shuffle
    met = may_hold(rows, "uid", added, "uid").join(added, "uid", "left").select("doc_id", "base", both.alias("spans"), "row")
    rest = surely_not_held(rows, "uid", added, "uid")
    return rest.select("doc_id", "base", F.col("base").alias("spans"), "row").unionByName(met)


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))))


def _redacted(text: Column, spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    order = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))

    def step(acc: Column, x: Column) -> Column:
        apart = x["start"] >= acc["at"]
        mark = F.concat(F.lit("["), F.upper(F.get(names, x["kind"])), F.lit("]"))
        piece = F.when(apart, F.concat(F.substr(text, acc["at"] + 1, x["start"] - acc["at"]), mark)).otherwise("")
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(order, zero, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substr(text, acc["at"] + 1)))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; overlapping
    spans are replaced together, under the first one's kind."""
    found = find(docs, id_col, text_col, keep=tuple(docs.columns), **options)
    text = F.col(f"row.`{text_col}`")
    new = F.when(F.size("spans") > 0, _redacted(text, F.col("spans"))).otherwise(text)
    return found.select(*((new if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
