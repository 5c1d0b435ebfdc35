"""Licence scans: TF-IDF cosine of headers and licence files to templates, then inheritance from directories.

The header of a file is its lines with a licence cue, wherever they stand.  A file whose words are mostly
header, or whose name says so, is a licence file.  Headers are scored once for each distinct text.  Weights
are tf x (ln((1 + N) / (1 + df)) + 1) over all headers of the corpus and the templates; a header takes the
licence of the template of the largest cosine, if it reaches the threshold; of equal ones the first by name.

A file without a licence of its own inherits that of the nearest directory above it (its own first) which
holds licence files; of several licences there the most frequent counts, then the first by name.

Only DataFrame functions are used.  Intermediate tables hold paths and digests, no whole texts.

Defined cases: null and empty texts have no header.  A null path has no directory, so nothing to inherit.
Repeated rows count as often as they occur and all stay.  Empty tables give an empty result.  Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexroll.operators.lineage import written
from lexroll.operators.skew import join_to_keys

# Fixed: wording of notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."
        " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license. SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License. CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as"
        " published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3. SPDX-License-Identifier: LGPL-3.0"),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, without restriction. The software"
        " is provided as is, without warranty of any kind. SPDX-License-Identifier: MIT",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "Copyright. All rights reserved."),
)
CUES = ("licen", "copyright", "spdx", "warranty", "redistribut", "public domain", "all rights reserved", "permission is")
LICENCE_NAME = "(?i)(^|/)(un)?licen[cs]e([.-][^/]*)?$|(?i)(^|/)(copying|notice)([.-][^/]*)?$"
TERMS = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
WORDS = "[^ \\t-\\r]+"
FILE_SHARE = 0.3
MIN_COSINE = 0.5


def _has_cue(text: Column) -> Column:
    low = F.lower(text)
    return reduce(lambda a, b: a | b, (F.contains(low, F.lit(c)) for c in CUES))


def header_of(text: Column) -> Column:
    """The lines of a text with a licence cue, null if there are none."""
    lines = F.filter(F.split(text, "\n"), _has_cue)
    return F.when(_has_cue(text), F.array_join(lines, "\n"))


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERMS), F.lit(0))


def template_terms(spark: SparkSession, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(number, licence, term, tf): a fixed, small table."""
    listed = [F.struct(F.lit(i).alias("number"), F.lit(n).alias("licence"), F.lit(t).alias("wording")) for i, (n, t) in enumerate(templates)]
    rows = spark.range(1).select(F.explode(F.array(*listed)).alias("t")).select("t.*")
    terms = rows.select("number", "licence", F.explode(_terms(F.col("wording"))).alias("term"))
    return terms.groupBy("number", "licence", "term").agg(F.count("*").alias("tf"))


def header_licences(headers: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = MIN_COSINE) -> DataFrame:
    """(digest, rows, licence, score) from distinct headers (digest, header, rows)."""
    spark = headers.sparkSession
    own = template_terms(spark, templates)
    terms = written(
        headers.select("digest", "rows", F.explode(_terms(F.col("header"))).alias("term"))
        .groupBy("digest", "rows", "term").agg(F.count("*").alias("tf"))
    )
    files = (headers.agg(F.sum("rows")).first()[0] or 0) + len(templates)
    seen = terms.select("term", "rows").unionByName(own.select("term", F.lit(1).cast("long").alias("rows")))
    idf = written(
        seen.groupBy("term").agg(F.sum("rows").alias("df"))
        .withColumn("idf", F.log((F.lit(1.0) + files) / (F.lit(1.0) + F.col("df"))) + 1)
    )
    weighted = join_to_keys(terms, idf, "term", "df").withColumn("w", F.col("tf") * F.col("idf"))
    norms = weighted.groupBy("digest", "rows").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    wanted = own.join(idf, "term").select("number", "licence", "term", (F.col("tf") * F.col("idf")).alias("tw"))
    wanted_norms = wanted.groupBy("number").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm"))
    # The templates' terms, some hundred rows, go to every task.
    dots = (
        weighted.join(F.broadcast(wanted), "term").groupBy("digest", "number", "licence")
        .agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
        .join(F.broadcast(wanted_norms), "number")
    )
    scored = dots.join(norms, "digest").withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("tnorm")), 6))
    best = scored.groupBy("digest", "rows").agg(F.min(F.struct((-F.col("score")).alias("less"), "licence")).alias("best"))
    return best.select("digest", "rows", F.col("best.licence").alias("licence"), (-F.col("best.less")).alias("score")).where(
        F.col("score") >= least
    )


def _ancestors(directory: Column) -> Column:
    """The directories above and including one, with their depth; "" is above all."""
    parts = F.split(directory, "/")
    below = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("above")))
    top = F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("above")))
    return F.when(directory == "", top).otherwise(F.concat(top, below))


def scan_licences(
    files: DataFrame, path_col: str = "path", text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES,
    least: float = MIN_COSINE, file_share: float = FILE_SHARE,
) -> DataFrame:
    """(path, licence, how, score) for every row: ``how`` is "header", "inherited" or null."""
    path, text = F.col(path_col), F.col(text_col)
    header = header_of(text)
    share = F.regexp_count(F.col("header"), F.lit(WORDS)) / F.regexp_count(F.col("text"), F.lit(WORDS))
    # Without files that have no header, the table holds few texts; the others keep their path only.
    scanned = files.select(path.alias("path"), header.alias("header"), F.when(header.isNotNull(), text).alias("text"))
    slim = written(
        scanned.select(
            "path", F.when(F.contains("path", F.lit("/")), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), "").alias("dir"),
            "header", F.sha2("header", 256).alias("digest"),
            F.coalesce(F.when(F.col("header").isNotNull(), (share >= file_share) | F.col("path").rlike(LICENCE_NAME)), F.lit(False)).alias("is_licence_file"),
        )
    )
    headers = slim.where("digest IS NOT NULL").groupBy("digest").agg(F.first("header").alias("header"), F.count("*").alias("rows"))
    facts = written(header_licences(written(headers), templates, least))
    own = written(
        join_to_keys(slim.select("path", "dir", "digest", "is_licence_file"), facts, "digest", "rows")
        .select("path", "dir", "is_licence_file", "licence", "score")
    )
    in_dirs = own.where("is_licence_file AND licence IS NOT NULL AND dir IS NOT NULL").groupBy("dir", "licence").agg(F.count("*").alias("n"))
    said = in_dirs.groupBy("dir").agg(F.min(F.struct((-F.col("n")).alias("less"), "licence"))["licence"].alias("inherited"))
    dirs = written(own.where("dir IS NOT NULL").groupBy("dir").agg(F.count("*").alias("files")))
    above = dirs.select("dir", "files", F.explode(_ancestors(F.col("dir"))).alias("a")).select("dir", "files", "a.*")
    under = above.groupBy("above").agg(F.count("*").alias("under"))
    facts_above = written(said.withColumnRenamed("dir", "above").join(under, "above"))
    nearest = join_to_keys(above, facts_above, "above", "under").where("inherited IS NOT NULL")
    for_dirs = written(nearest.groupBy("dir", "files").agg(F.max_by("inherited", "depth").alias("inherited")))
    out = join_to_keys(own, for_dirs, "dir", "files")
    how = F.when(F.col("licence").isNotNull(), "header").when(F.col("inherited").isNotNull(), "inherited")
    return out.select("path", F.coalesce("licence", "inherited").alias("licence"), how.alias("how"), "score")
