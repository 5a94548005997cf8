"""URL verdicts from host rules and, beyond them, a path-template tree (DataFrame operations only).

The rules decide every url they fit.  Their verdicts, together with the url shapes,
train the tree: below each host, branching by branching, a segment becomes

* a typed wildcard (``{n}``, ``{x}``) when it is a number or an identifier,
* ``{rare}`` when it has too few urls to be told from anything (the Hoeffding width of its own
  shares reaches ``TELL``): variable segments.  Each enters the wildcard with
  weight one, however many urls it has, and keeps that weight in all levels below, so
  no single branch speaks for the others,
* ``*`` when its shares of blocked and of decided urls are like its siblings' within the widths
  of both sides, and these stay below ``TELL`` together: similar branches merge,
* itself when it differs, or when its siblings are too few to tell.

The tree goes on until nothing branches; segments that all urls of a template share are taken
at once, so there are as many turns as branchings along a path, not as segments.

A template (host plus path of these) is rejected when it holds at least ``MIN_DECIDED`` decided urls
of its own (by weight) and its smoothed purity, (blocked + ALPHA * prior) / (decided + ALPHA), reaches
``reject``.  Its prior is the smoothed purity of its parent's urls *outside* it, from the parent's own
prior, starting at PRIOR: no url is counted twice on the way down.

Defined results: a NULL url or one without ``://`` has an empty host and path and is
allowed; an empty path has no segments, and empty segments are skipped; repeated rows are judged
alike and all returned, and each counts; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: (host, path prefix, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DELTA = 0.05
TELL = 0.5
ALPHA = 4.0
PRIOR = 0.5
REJECT = 0.8
MIN_DECIDED = 6
NUMBER = r"^[0-9]+([.][A-Za-z0-9]+)?$"
IDENTIFIER = r"^(?=.*[0-9])[A-Za-z0-9_-]{8,}([.][A-Za-z0-9]+)?$"


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_index(host: Column, path: Column, rules=RULES) -> Column:
    """Index of the longest rule (host plus path) that fits, else NULL; of two as long, the earlier."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i][0] + rules[i][1]), i))
    dotted = F.concat(F.lit("."), host)
    return F.coalesce(*(F.when(dotted.endswith(f".{rules[i][0]}") & path.startswith(rules[i][1]), F.lit(i))
                        for i in order), F.lit(None).cast("int"))


def _segments(path: Column) -> Column:
    """The path's segments, numbers and identifiers as typed wildcards."""
    return F.transform(F.filter(F.split(path, "/", -1), lambda s: s != ""), lambda s: (
        F.when(s.rlike(NUMBER), "{n}").when(s.rlike(IDENTIFIER), "{x}").otherwise(s)))


def _smoothed(blocked: Column, decided: Column, prior: Column) -> Column:
    # weights are sums of fractions: rounded, so that their order of addition decides nothing
    return F.round((blocked + F.lit(ALPHA) * prior) / (decided + F.lit(ALPHA)), 9)


def _width(n: Column) -> Column:
    """Hoeffding's half width for a share of n observations at confidence 1 - DELTA."""
    return F.try_divide(F.lit(math.sqrt(0.5 * math.log(2.0 / DELTA))), F.sqrt(n))


def _shared_length(a: Column, b: Column) -> Column:
    """The length of the longest common prefix of two arrays."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    differs = F.array_position(same, False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(same)).cast("int")


def _branch(open_: DataFrame) -> DataFrame:
    """One turn: every open path moves past its template's shared segments and one branching.
    ``rest`` is what is left of it, NULL when its template is final."""
    sums = [F.sum(c).alias(c) for c in ("n", "blocked", "decided")]
    # the least and the greatest path share what all share
    ends = open_.groupBy("template").agg(F.min("rest").alias("least"), F.max("rest").alias("greatest")).select(
        "template", (F.col("least") == F.col("greatest")).alias("single"),
        _shared_length(F.col("least"), F.col("greatest")).alias("shared"))
    here = open_.join(ends, "template").withColumn("under", F.concat("template", F.concat_ws("", F.transform(
        F.slice("rest", F.lit(1), F.col("shared")), lambda s: F.concat(F.lit("/"), s)))))
    here = here.withColumn("head", F.coalesce(F.concat(F.lit("/"), F.get("rest", F.col("shared"))), F.lit("")))
    here = materialize(here, "url-turn")
    child = here.where("NOT single").groupBy("under", "head").agg(*sums, F.first("prior").alias("prior"))
    total = child.groupBy("under").agg(
        *(F.sum(c).alias(f"all_{c}") for c in ("n", "blocked", "decided")),
        *(F.sum(F.when(F.col("head") != "", F.col(c))).alias(f"seg_{c}") for c in ("n", "blocked", "decided")))
    both = child.join(total, "under")
    others = F.col("seg_n") - F.col("n")
    width = _width(F.col("n")) + _width(others)
    alike = [F.round(F.abs(F.col(c) / F.col("n") - F.try_divide(F.col(f"seg_{c}") - F.col(c), others)), 9) <= width
             for c in ("blocked", "decided")]
    alone = (F.col("head") == "") | F.col("head").isin("/{n}", "/{x}") | (F.col("seg_n") <= F.col("n"))
    step = (F.when(alone, F.col("head")).when(_width(F.col("n")) >= TELL, "/{rare}")
            .when((width < TELL) & reduce(Column.__and__, alike), "/*").otherwise(F.col("head")))
    scale = F.when(F.col("step") == "/{rare}", 1 / F.col("n")).otherwise(F.lit(1.0))
    moves = both.withColumn("step", step).withColumn("scale", scale)
    # what a step's branches weigh in their parent, and what they weigh as its own evidence
    own = moves.groupBy("under", "step").agg(
        F.sum("blocked").alias("out_blocked"), F.sum("decided").alias("out_decided"),
        F.sum(F.col("blocked") * F.col("scale")).alias("in_blocked"),
        F.sum(F.col("decided") * F.col("scale")).alias("in_decided"),
        F.first("all_blocked").alias("all_blocked"), F.first("all_decided").alias("all_decided"),
        F.first("prior").alias("above"))
    outside = _smoothed(F.col("all_blocked") - F.col("out_blocked"), F.col("all_decided") - F.col("out_decided"), F.col("above"))
    own = own.withColumn("prior", outside).select(
        "under", "step", "prior", _smoothed(F.col("in_blocked"), F.col("in_decided"), F.col("prior")).alias("purity"),
        F.round("in_decided", 9).alias("evidence"))
    moves = moves.select("under", "head", "step", "scale").join(own, ["under", "step"])
    split = here.where("NOT single").drop("prior", "purity", "evidence").join(moves, ["under", "head"]).select(
        "host", "segments", F.concat("under", "step").alias("template"),
        F.when(F.col("head") != "", F.slice("rest", F.col("shared") + 2, F.greatest(F.size("rest"), F.lit(1)))).alias("rest"),
        *((F.col(c) * F.col("scale")).alias(c) for c in ("n", "blocked", "decided")), "prior", "purity", "evidence")
    whole = here.where("single").select(
        "host", "segments", F.col("under").alias("template"), F.lit(None).cast("array<string>").alias("rest"),
        "n", "blocked", "decided", "prior", "purity", "evidence")
    return materialize(split.unionByName(whole), "url-tree")


def template_tree(urls: DataFrame) -> DataFrame:
    """urls (host, segments, blocked, allowed: 0/1 each) as one row a (host, typed path), with its
    ``template``, the template's ``purity`` and its ``evidence``, the weight of its decided urls.

    Only distinct typed paths with their counts go from turn to turn."""
    paths = materialize(urls.groupBy("host", "segments").agg(
        F.count("*").cast("double").alias("n"), F.sum("blocked").cast("double").alias("blocked"),
        F.sum(F.col("blocked") + F.col("allowed")).cast("double").alias("decided")), "url-paths")
    root = paths.groupBy("host").agg(F.sum("blocked").alias("b"), F.sum("decided").alias("evidence")).select(
        "host", F.lit(PRIOR).alias("prior"), _smoothed(F.col("b"), F.col("evidence"), F.lit(PRIOR)).alias("purity"), "evidence")
    tree = paths.withColumn("template", F.col("host")).withColumn("rest", F.col("segments")).join(root, "host")
    closed = tree.where("false")
    while not tree.isEmpty():
        turn = _branch(tree)
        closed = closed.unionByName(turn.where("rest IS NULL"))
        tree = turn.where("rest IS NOT NULL")
    return closed.select("host", "segments", "template", "purity", "evidence")


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          reject: float = REJECT, min_decided: float = MIN_DECIDED) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity, evidence), one row a page; the last
    three are NULL for urls without a host."""
    url = F.col(url_col).cast("string")
    base = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    base = base.withColumn("rule_at", rule_index(F.col("host"), F.col("path"), rules))
    verdicts = F.array(*(F.lit(v) for _, _, v in rules))
    base = base.withColumn("ruled", F.get(verdicts, F.col("rule_at")))
    base = materialize(base.withColumn("segments", _segments(F.col("path"))), "url-pages")
    known = base.where("host != ''").select(
        "host", "segments", *(F.coalesce(F.col("ruled") == v, F.lit(False)).cast("long").alias(c)
                              for v, c in (("block", "blocked"), ("allow", "allowed"))))
    tree = template_tree(known)
    on = (F.col("p.host") == F.col("t.host")) & (F.col("p.segments") == F.col("t.segments"))
    rejected = (F.col("t.evidence") >= min_decided) & (F.col("t.purity") >= reject)
    by_method = F.when(rejected, "block").otherwise("allow")
    texts = F.array(*(F.lit(h + p) for h, p, _ in rules))
    return base.alias("p").join(tree.alias("t"), on, "left").select(
        "p.page_id", "p.host", "p.path", F.get(texts, F.col("p.rule_at")).alias("rule"),
        F.coalesce(F.col("p.ruled"), by_method).alias("verdict"), "t.template", "t.purity", "t.evidence")
