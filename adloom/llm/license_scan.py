"""Licences of files: TF-IDF cosine of header lines and licence files to templates, inherited along directories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import stored

#: Notices to compare with; several may stand for one licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, to deal in the software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3 of the License."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD License."),
    ("MPL-2.0", "This source code is subject to the terms of the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "All rights reserved."),
    # the identifier stands three times, so that the frame of such a line does not make up for another identifier
    *((name, f"SPDX-License-Identifier: {name} {name} {name}") for name in ("Apache-2.0", "MIT", "GPL-3.0", "LGPL-3.0", "BSD-3-Clause", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0")),
)

#: A line that holds one of these is a header.
ANCHOR = r"(?i)licens|licenc|copyright|rights reserved|public domain|redistribut|permission is|spdx"


#: What a comment line begins with, and runs of such lines.
MARK = r"[ \t]*(?:#+|//+|/\*+|\*+/?|--+|;+|%+|<!--+)"
COMMENTS = rf"(?m)(?:^{MARK}[^\r\n]*(?:\r?\n|$))++"


def header_units(text: Column) -> Column:
    """Header texts: lines with an anchor word, and runs of neighbouring comment lines with one, without their comment signs, as one text."""
    lines = F.filter(F.split(text, r"[\r\n]+"), lambda x: x.rlike(ANCHOR))
    runs = F.filter(F.regexp_extract_all(text, F.lit(COMMENTS), F.lit(0)), lambda x: x.rlike(ANCHOR))
    bare = F.transform(runs, lambda x: F.regexp_replace(F.regexp_replace(x, rf"(?m)^{MARK}|\*+/[ \t]*$|-->[ \t]*$", " "), r"\s+", " "))
    return F.array_distinct(F.concat(lines, bare))


def license_share(text: Column) -> Column:
    """Share of the characters of a text that stand in lines with an anchor word; 0 for empty and null text."""
    lines = F.filter(F.split(text, r"[\r\n]+"), lambda x: x.rlike(ANCHOR))
    held = F.aggregate(lines, F.lit(0), lambda n, x: n + F.char_length(x))
    return F.coalesce(F.try_divide(held, F.char_length(text)), F.lit(0.0))


def _tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _counts(units: DataFrame) -> DataFrame:
    """unit, token, tf."""
    return units.select("unit", F.explode(_tokens(F.col("text"))).alias("token")).groupBy("unit", "token").agg(F.count(F.lit(1)).alias("tf"))


def template_scores(units: DataFrame, templates=TEMPLATES, threshold: float = 0.6) -> DataFrame:
    """unit, license, score: the best template of each distinct text in `units` (unit, text, n) whose cosine reaches the threshold.

    Document frequencies of template words are counted over all units, weighted by n. Any other word weighs as much as a word
    that no unit has. Ties go to the first licence by name. The templates are a parameter, so their words are broadcast.
    """
    spark = units.sparkSession
    named = spark.createDataFrame([(f"{i:04d}", lic, text) for i, (lic, text) in enumerate(templates)], "unit string, license string, text string")
    terms = _counts(named)
    counts = stored(_counts(units), "license-terms")
    seen = F.broadcast(terms.select("token").distinct())
    total = units.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"] + len(templates)
    df = counts.join(seen, "token").join(units.select("unit", "n"), "unit").groupBy("token").agg(F.sum("n").alias("df"))
    idf = lambda n: F.log(F.lit(float(total + 1)) / (n + 1)) + 1
    weights = terms.select("token").distinct().join(df, "token", "left").select("token", idf(F.coalesce("df", F.lit(0))).alias("idf")).collect()
    known = F.broadcast(spark.createDataFrame(weights, "token string, idf double"))
    template_weights = terms.join(known, "token").select(F.col("unit").alias("template"), "token", (F.col("tf") * F.col("idf")).alias("tw"))
    template_norms = template_weights.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tn"))
    of_template = template_weights.join(template_norms, "template").join(named.select(F.col("unit").alias("template"), "license"), "template").collect()
    sparse = F.broadcast(spark.createDataFrame(of_template, "template string, token string, tw double, tn double, license string"))

    weighed = counts.join(known, "token", "left").select("unit", "token", (F.col("tf") * F.coalesce("idf", idf(F.lit(0)))).alias("w"))
    norms = weighed.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("un"))
    dots = weighed.join(sparse, "token").groupBy("unit", "license", "template", "tn").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("un") * F.col("tn")), 9)
    best = dots.join(norms, "unit").select("unit", "license", cosine.alias("score")).where(F.col("score") >= threshold)
    return best.groupBy("unit").agg(F.min(F.struct((-F.col("score")).alias("neg"), "license")).alias("b")).select("unit", "b.license", (-F.col("b.neg")).alias("score"))


def directory_of(path: Column) -> Column:
    """Up to the last slash; the root is the empty directory."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def scan_licenses(files: DataFrame, templates=TEMPLATES, threshold: float = 0.6) -> DataFrame:
    """One row per row of `files` (file_id, path, text, is_license_file): file_id, path, license, score, origin, license_dir.

    A header is a line with an anchor word, or the run of comment lines that it stands in; a licence file is also compared as a whole. Equal texts are compared once. origin:
    `header` or `file` if the file's own text reaches the threshold, `inherited` from the nearest ancestor directory (its
    own included) that holds a licence file with a licence, else `none`. Several licences at once: the best score, then
    the name. Null path is the root's, null text has no headers, a null flag is false. Repeated rows are files of their own. Texts of
    any length are read whole, columns of other names are ignored, and an empty table gives no rows.
    """
    of = files.select("file_id", F.coalesce("path", F.lit("")).alias("path"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("is_license_file", F.lit(False)).alias("flag"))
    lines = header_units(F.col("text"))
    found = of.select("path", "file_id", "flag", F.explode(F.when(F.col("flag"), F.array_append(lines, F.col("text"))).otherwise(lines)).alias("line"))
    headers = stored(found.select("path", "file_id", "flag", F.trim("line").alias("line"), F.sha2(F.trim("line"), 256).alias("unit")), "license-headers")
    units = stored(headers.groupBy("unit", F.col("line").alias("text")).agg(F.count(F.lit(1)).alias("n")), "license-units")
    scores = stored(template_scores(units, templates, threshold), "license-scores")
    hits = headers.select("path", "file_id", "flag", "unit").join(scores, "unit")
    best = F.min(F.struct((-F.col("score")).alias("neg"), "license")).alias("b")
    own = stored(hits.groupBy("path", "file_id").agg(best).select("path", "file_id", "b.license", (-F.col("b.neg")).alias("score")), "license-own")

    holding = hits.where("flag").groupBy(directory_of(F.col("path")).alias("license_dir")).agg(best).select("license_dir", F.col("b.license").alias("dir_license"), (-F.col("b.neg")).alias("dir_score"))
    parts = F.split("dir", "/")
    chain = F.concat(F.array(F.lit("")), F.when(F.col("dir") != "", F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))).otherwise(F.array().cast("array<string>")))
    dirs = of.select(directory_of(F.col("path")).alias("dir")).distinct()
    above = dirs.select("dir", F.explode(F.array_distinct(chain)).alias("license_dir")).join(holding, "license_dir")
    nearest = stored(above.groupBy("dir").agg(F.max_by(F.struct("license_dir", "dir_license", "dir_score"), F.length("license_dir")).alias("d")), "license-dirs")

    keyed = of.select("file_id", "path", "flag", directory_of(F.col("path")).alias("dir"))
    same = F.col("own.path").eqNullSafe(F.col("f.path")) & F.col("own.file_id").eqNullSafe(F.col("f.file_id"))
    out = keyed.alias("f").join(own.alias("own"), same, "left").join(nearest.alias("n"), F.col("f.dir") == F.col("n.dir"), "left")
    mine = F.col("own.license").isNotNull()
    return out.select(
        F.col("f.file_id").alias("file_id"), F.col("f.path").alias("path"),
        F.coalesce("own.license", "n.d.dir_license").alias("license"), F.coalesce("own.score", "n.d.dir_score").alias("score"),
        F.when(mine & F.col("flag"), "file").when(mine, "header").when(F.col("n.d").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~mine, F.col("n.d.license_dir")).alias("license_dir"),
    )
