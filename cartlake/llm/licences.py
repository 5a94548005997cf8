"""Licence statements: paragraph classifier and template comparison (DataFrame operations only).

Texts are split at blank lines, after comment marks are taken off the starts of lines.  A
paragraph that holds a cue word is read in units: its lines that hold one, and windows of
WINDOW words over its joined lines, so that wrapped notices are seen whole.  What is worked
out per paragraph is written before paragraphs are cut into units, so that work stays in
proportion to their length.  Units that share a word pair with a template go to a
multinomial logistic regression over hashed word unigrams and bigrams; no other unit could
be confirmed.  It is trained on the templates below, whole and with words left out, against
the class "unknown": statements that name no licence, and units of the corpus that share
word pairs with templates but hold less than half of what a confirmation takes (at most
``max_lines`` different ones, the first in the order of a hash).  The probability from which a
family counts is set on all such units that the fit has not seen, so that no more than
``false_rate`` of them reach it for any family.

A unit confirms every family that the regression gives this probability and of which the unit
holds enough of a template's word pairs; a paragraph that names another version or kind
of the GNU licences does not confirm GPL-3.0 or LGPL-3.0.

Defined results: a NULL or empty text has no paragraphs; long texts are read whole;
repeated rows and repeated paragraphs each count; of two families as likely the first in
the table is predicted; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

UNKNOWN = "unknown"
#: family -> statements; public licence notices.  Fixed values.
TEMPLATES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0",
                   "you may not use this file except in compliance with the License",
                   "SPDX-License-Identifier: Apache-2.0"),
    "MIT": ("Released under the MIT License", "This project is licensed under the terms of the MIT license",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
            "SPDX-License-Identifier: MIT"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3",
                "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
                "SPDX-License-Identifier: GPL-3.0-only"),
    "LGPL-3.0": ("licensed under the GNU Lesser General Public License, version 3",),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted",
                     "Licensed under the BSD 3-Clause License"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0",
                     "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0",
                     "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC0-1.0": ("dedicated to the public domain under CC0 1.0 Universal",),
}
#: statements that name no family.  Fixed values.
NO_FAMILY = ("Licensed under the terms below", "See the license for details", "All rights reserved", "Copyright the authors",
             "This work is licensed under its own terms", "a driving license is needed", "Released under a commercial license")
CUES = r"(?i)licen[cs]e|copyright|permission is hereby|redistribut|public domain|creative commons|all rights reserved"
#: family -> what must not stand in a paragraph, unless the second pattern does
OTHERS = {"GPL-3.0": (r"(?i)\b(?:lesser|library|affero)\b|\bversion\s[0-24-9]", r"(?i)\bGNU\s+General\s+Public\s+License[^.]{0,120}\bversion\s3"),
          "LGPL-3.0": (r"(?i)\bversion\s[0-24-9]", r"(?i)\bversion\s3")}
MARKS = r"(?m)^[\x20\t]*+(?:/\*++|\*++/?+|//++|#++|--++|;++|%++|>++|<!--|dnl\b|REM\b)?+[\x20\t]*+"
WINDOW, STEP = 24, 8
MAX_LINES = 2_000
FALSE_RATE = 0.01
CONTAINED = 0.6


def words(paragraph: Column) -> Column:
    return F.filter(F.split(F.lower(paragraph), r"[^\p{L}\p{N}.]+|\.(?=\s|$)", -1), lambda w: w != "")


def bigrams(tokens: Column) -> Column:
    first, second = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))), F.slice(tokens, F.lit(2), F.size(tokens))
    return F.zip_with(first, second, lambda a, b: F.concat_ws(" ", a, b))


def _features(df: DataFrame) -> DataFrame:
    df = df.withColumn("tokens", words(F.col("paragraph")))
    df = df.withColumn("pairs", bigrams(F.col("tokens"))).withColumn("grams", F.concat("tokens", "pairs"))
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=1 << 12, binary=True).transform(df)


def _variants(spark: SparkSession, families: list[str]) -> DataFrame:
    """(label, paragraph): every statement whole, and with each word in turn left out."""
    rows = [(families.index(f), t) for f, ts in TEMPLATES.items() for t in ts] + [(len(families), t) for t in NO_FAMILY]
    given = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(text).alias("text")) for label, text in rows])
    whole = spark.range(1).select(F.inline(given)).withColumn("w", F.split("text", " "))
    at = F.sequence(F.lit(0), F.size("w"))
    shorter = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("i")), F.slice("w", F.col("i") + 2, F.size("w"))), " ")
    return whole.withColumn("i", F.explode(at)).select("label", shorter.alias("paragraph"))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, paragraphs): those with a cue word, lines kept."""
    text = text_or_empty(text_col)
    blocks = F.split(F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), MARKS, ""), r"\n\s*\n", -1)
    joined = F.filter(blocks, lambda x: F.regexp_replace(x, r"\s+", " ").rlike(CUES))
    cue = F.regexp_replace(text, r"[\s/*#;%>-]+", " ").rlike(CUES) | text.rlike(CUES)
    return docs.select(F.col(id_col).alias("doc_id"), F.when(cue, joined).otherwise(
        F.array().cast("array<string>")).alias("paragraphs"))


def units(paragraph: Column) -> Column:
    """array<string>: the lines with a cue word, and windows over the joined words."""
    lines = F.filter(F.split(paragraph, "\n", -1), lambda x: x.rlike(CUES))
    every = F.filter(F.split(paragraph, r"\s+", -1), lambda w: w != "")

    def windows(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - WINDOW + STEP - 1, F.lit(0)), F.lit(STEP))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, F.lit(WINDOW)), " "))
    return F.array_distinct(F.concat(lines, F.transform(F.array(every), windows)[0]))


def _held(pairs: Column) -> Column:
    """array<struct<family, share>>: the share of each template's bigrams that stand in ``pairs``."""
    families = list(TEMPLATES)
    rows = [F.struct(F.lit(families.index(f)).alias("family"), F.array(*map(F.lit, _plain_bigrams(t))).alias("pairs"))
            for f, ts in TEMPLATES.items() for t in ts]

    def share(some: Column) -> Column:
        return F.size(F.array_intersect(some, pairs)) / F.size(some)
    return F.transform(F.array(*rows), lambda t: F.struct(t["family"].alias("family"), share(t["pairs"]).alias("share")))


def _plain_bigrams(text: str) -> list[str]:
    tokens = [w for w in re.split(r"[^\w.]+|\.(?=\s|$)", text.lower()) if w]
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(tokens, tokens[1:])))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lines: int = MAX_LINES,
         false_rate: float = FALSE_RATE, contained: float = CONTAINED) -> DataFrame:
    """(doc_id, n_candidates, n_confirmed, families): families as names in order, comma-joined."""
    spark = docs.sparkSession
    families = list(TEMPLATES)
    unknown = len(families)
    rows = materialize(paragraphs(docs, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()), "lic-paragraphs")
    joined = F.regexp_replace(F.col("whole"), r"\s+", " ")
    barred = F.array_compact(F.array(*(F.when(joined.rlike(words) & ~joined.rlike(unless), F.lit(families.index(f)))
                                       for f, (words, unless) in OTHERS.items())))
    # written here: above the next explode these patterns would run once per unit over the whole paragraph
    whole = materialize(rows.select("uid", F.posexplode("paragraphs").alias("at", "whole")).withColumn("barred", barred), "lic-whole")
    grams = F.array(*map(F.lit, sorted({g for ts in TEMPLATES.values() for t in ts for g in _plain_bigrams(t)})))
    flat = whole.select("uid", "at", "barred", F.explode(units(F.col("whole"))).alias("paragraph"))
    # and here: the optimizer would copy the bigrams' expression into every template's comparison
    flat = materialize(_features(flat).where(F.arrays_overlap("pairs", grams)).select("uid", "at", "barred", "paragraph", "features", "pairs"), "lic-pairs")
    flat = materialize(flat.withColumn("shares", _held(F.col("pairs"))).drop("pairs").withColumn(
        "most", F.array_max(F.transform("shares", lambda t: t["share"]))), "lic-shares")
    seen = F.pmod(F.xxhash64("paragraph"), F.lit(4)) != 0
    vague = flat.where(F.col("most") < contained / 2).select(F.lit(unknown).alias("label"), "paragraph", "features")
    some = vague.where(seen).groupBy("paragraph").agg(F.first("features").alias("features")).withColumn("draw", F.xxhash64("paragraph"))
    some = some.orderBy("draw", "paragraph").limit(max_lines).select(F.lit(unknown).alias("label"), "paragraph", "features")
    given = _features(_variants(spark, families)).select("label", "paragraph", "features")
    known = materialize(given.where(seen).unionByName(some).coalesce(1).sort("label", "paragraph"), "lic-train")
    model = LogisticRegression(maxIter=30, regParam=1e-3, family="multinomial").fit(known)

    def predicted(df: DataFrame) -> DataFrame:
        return model.transform(df).withColumn("p", vector_to_array(F.col("probability")))
    unseen = vague.where(~seen).unionByName(given.where(~seen & (F.col("label") == unknown)))
    limit = predicted(unseen).agg(F.percentile_approx(F.array_max(F.slice("p", 1, unknown)), F.lit(1 - false_rate), F.lit(10_000))).first()[0]
    limit = 0.5 if limit is None else limit
    sure = predicted(flat.where(F.col("most") >= contained))
    found = F.filter("shares", lambda t: (t["share"] >= contained) & ~F.array_contains("barred", t["family"]) & (F.get("p", t["family"]) > limit))
    sure = sure.select("uid", "at", F.explode(F.transform(found, lambda t: t["family"])).alias("family"))
    names = F.array(*map(F.lit, families))
    per = sure.groupBy("uid").agg(F.countDistinct("at").alias("n"), F.sort_array(F.collect_set(F.get(names, F.col("family")))).alias("names"))
    return rows.join(per, "uid", "left").select(
        "doc_id", F.size("paragraphs").cast("long").alias("n_candidates"), F.coalesce("n", F.lit(0)).alias("n_confirmed"),
        F.coalesce(F.array_join("names", ","), F.lit("")).alias("families"))
