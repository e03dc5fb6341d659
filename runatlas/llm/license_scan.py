"""License scans: TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

A file's headers are its lines (anywhere in the file) with a licence cue or ``LEAST_RARE`` different rare terms of
the templates, each also with the line after it, and cut into sentences, long sentences into windows of words. A
licence file (named so, or short and hinting at a licence) is always compared as a whole. The terms of headers,
weighted by TF-IDF, are joined with the terms of the templates; the template with the highest cosine, if
at least ``LEAST_COSINE``, is the header's. Document frequencies are those of all headers of the corpus
and of the templates.

A directory's licence is that of its licence files. A file without a licence of its own takes that of the
nearest directory on its path that has one. Directories are resolved first, each by joining its ancestors
with the licensed directories; the files are then joined with their directory, so the work at a
directory does not grow with its files, and an exchange of their own lets a frequent directory be split.

Only the templates' terms are broadcast, a fixed list. Cases: null or empty text has no licence of its own; a null path is
a file without a directory, which inherits nothing. Ties of cosine go to the template first in the list, ties of licence
files in a directory to the higher cosine, then the name. Repeated paths are rows of their own.
"""

from __future__ import annotations

import re
from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runatlas.llm.scratch import Scratch, plain_columns

LEAST_COSINE = 0.45
SHORT_WORDS = 40  # a file of at most this many words that hints at a licence counts as a licence file
LICENSE_NAME = r"(?i)^(un)?licen[sc]e|^copying|^notice"
CUE = r"(?i)licen[sc]|copyright|all rights reserved|spdx-"

# Statements by which licences are declared; names are SPDX identifiers.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, to deal in the Software without restriction. MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it under the terms of the GNU General Public License version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted. BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright. All rights reserved. Unauthorized copying is prohibited. Proprietary and confidential."),
)
_WORD = "[a-z0-9]+"
#: Terms of templates that any text may have; the others are rare ones.
ORDINARY = frozenset(
    "0 1 2 3 4 a all and any are by can code copy copying deal except file for form forms free general in is it may not of or "
    "person program public released source subject terms the this to under use v version with without work you".split()
)
LEAST_RARE = 2  # different rare terms that make a line a header without a cue
WINDOW = 32  # words of a window of a long sentence; each begins half a window after the one before
_RARE = r"\b(?:" + "|".join(sorted({t for _, text in TEMPLATES for t in re.findall(_WORD, text.lower())} - ORDINARY)) + r")\b"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def hints(text: Column) -> Column:
    """Whether a text may hold a statement: a cue, or several rare terms of the templates."""
    rare = F.regexp_extract_all(F.lower(text), F.lit(_RARE), F.lit(0))
    return F.coalesce(text.rlike(CUE) | (F.size(F.array_distinct(rare)) >= LEAST_RARE), F.lit(False))


def _sentences(line: Column) -> Column:
    """The sentences of a line, long ones in overlapping windows of words."""
    def windows(sentence: Column) -> Column:
        words = F.split(sentence, r"\s+")
        starts = F.sequence(F.lit(1), F.size(words), F.lit(WINDOW // 2))
        cut = F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(WINDOW)), " "))
        return F.when(F.size(words) > WINDOW + WINDOW // 2, cut).otherwise(F.array(sentence))

    return F.flatten(F.transform(F.split(line, r"(?<=[.!?;])\s+"), windows))


def header_texts(files: DataFrame) -> DataFrame:
    """``(file, part, header)``: lines that hint at a licence, with the line after, and in sentences; part ``all`` is a licence file."""
    hinted = files.filter("hinted")
    lines = F.split("text", "\r?\n")
    numbered = F.transform(lines, lambda line, i: F.struct(line.alias("line"), F.get(lines, i + 1).alias("next")))
    parts = hinted.select("file", F.posexplode(numbered).alias("n", "z")).filter(hints(F.col("z.line")))
    parts = parts.select("file", "n", "z.line", "z.next", F.filter(_sentences(F.col("z.line")), hints).alias("sentences"))
    both = F.when(~hints(F.col("next")), F.concat_ws("\n", "line", "next"))
    headers = F.array_distinct(F.concat(F.array_compact(F.array("line", both)), "sentences"))
    cut = parts.select("file", "n", F.posexplode(headers).alias("k", "header"))
    cut = cut.select("file", F.concat_ws("/", F.col("n").cast("string"), F.col("k").cast("string")).alias("part"), "header")
    whole = files.filter("license_file and text is not null").select("file", F.lit("all").alias("part"), F.col("text").alias("header"))
    return cut.union(whole)


def _template_terms(spark) -> tuple[DataFrame, int]:
    rows = []
    for number, (name, text) in enumerate(TEMPLATES):
        found = re.findall(_WORD, text.lower())
        rows += [(number, name, term, found.count(term)) for term in sorted(set(found))]
    return spark.createDataFrame(rows, "number int, license string, term string, tf int"), len(TEMPLATES)


def best_licenses(files: DataFrame, scratch: Scratch, least: float = LEAST_COSINE) -> DataFrame:
    """Per file with a licence of its own: ``(file, license, cosine)``, by the best of its headers."""
    spark = files.sparkSession
    headers = scratch.save(header_texts(files).distinct(), "headers")  # equal rows share a key
    terms = headers.select("file", "part", F.explode(words_of(F.col("header"))).alias("term"))
    terms = terms.groupBy("file", "part", "term").agg(F.count("*").alias("tf"))
    terms = scratch.save(terms, "terms")
    templates, n_templates = _template_terms(spark)
    known = templates.select("term").distinct()
    n = headers.count() + n_templates
    # Frequencies of template terms: a table of fixed size.
    in_headers = terms.join(F.broadcast(known), "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    in_templates = templates.groupBy("term").agg(F.count("*").alias("df"))
    frequency = in_headers.union(in_templates).groupBy("term").agg(F.sum("df").alias("df")).collect()
    idf = {r["term"]: log(1 + n / r["df"]) for r in frequency}
    rare = log(1 + n)  # of a term in no template: it only adds to a header's length
    vectors: dict[int, tuple[str, dict[str, float]]] = {}
    for r in templates.collect():
        vectors.setdefault(r["number"], (r["license"], {}))[1][r["term"]] = (1 + log(r["tf"])) * idf[r["term"]]
    weighted = []
    for number, (name, vector) in vectors.items():
        norm = sqrt(sum(w * w for w in vector.values()))
        weighted += [(number, name, term, w / norm, idf[term]) for term, w in vector.items()]
    table = F.broadcast(spark.createDataFrame(weighted, "number int, license string, term string, weight double, idf double"))
    weights = F.broadcast(spark.createDataFrame(sorted(idf.items()), "term string, idf double"))
    own = (1 + F.log("tf")) * F.coalesce("idf", F.lit(rare))
    norms = terms.join(weights, "term", "left").groupBy("file", "part").agg(F.sqrt(F.sum(own * own)).alias("norm"))
    dots = (
        terms.join(table, "term")
        .groupBy("file", "part", "number", "license")
        .agg(F.sum((1 + F.log("tf")) * F.col("idf") * F.col("weight")).alias("dot"))
    )
    cosine = F.least(F.round(F.col("dot") / F.col("norm"), 9), F.lit(1.0))
    scored = dots.join(norms, ["file", "part"]).select("file", "number", "license", cosine.alias("cosine")).filter(F.col("cosine") >= least)
    best = F.max(F.struct("cosine", (-F.col("number")).alias("first"), "license")).alias("best")
    return scored.groupBy("file").agg(best).select("file", "best.license", "best.cosine")


def _ancestors(directory: Column) -> Column:
    """All directories on the way, the deepest last; the root is the empty path."""
    names = F.split(directory, "/")
    depths = F.sequence(F.lit(0), F.size(names))
    return F.when(directory == "", F.array(F.lit(""))).otherwise(
        F.transform(depths, lambda d: F.array_join(F.slice(names, F.lit(1), d), "/"))
    )


def scan_licenses(files: DataFrame, id_column: str = "file_id", path_column: str = "path", text_column: str = "text") -> DataFrame:
    """Per row: ``file_id``, ``path``, ``license``, ``cosine``, ``origin`` (own, inherited or none) and ``inherited_from``."""
    scratch = Scratch(files.sparkSession, "licenses")
    files = plain_columns(files, file_id=id_column, path=path_column, text=text_column)
    name = F.element_at(F.split("path", "/"), -1)
    directory = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.when(F.col("path").isNotNull(), F.lit("")))
    words = F.when(F.length("text") <= 40 * SHORT_WORDS, F.size(F.split(F.trim("text"), r"\s+")))
    short = F.col("hinted") & F.coalesce(words <= SHORT_WORDS, F.lit(False))
    license_file = F.coalesce(name.rlike(LICENSE_NAME), F.lit(False)) | short
    # Rows are told apart by id, path and text, so equal rows share one key and one answer.
    prepared = files.withColumn("file", F.sha2(F.concat_ws("\u0000", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0001")) for c in ("file_id", "path", "text")]), 256))
    prepared = prepared.withColumn("hinted", hints(F.col("text"))).withColumn("directory", directory).withColumn("license_file", license_file)
    listed = scratch.save(prepared.select("file_id", "path", "file", "directory", "license_file"), "files")
    own = scratch.save(best_licenses(prepared.select("file", "text", "license_file", "hinted"), scratch), "own")

    licensed = listed.filter("license_file and directory is not null").join(own, "file").groupBy("directory")
    best = F.max(F.struct("cosine", "license")).alias("best")
    licensed = scratch.save(licensed.agg(best).select("directory", F.col("best.license").alias("license"), F.col("best.cosine").alias("cosine")), "licensed")
    directories = listed.filter("directory is not null").select("directory").distinct()
    ways = directories.select("directory", F.posexplode(_ancestors(F.col("directory"))).alias("depth", "ancestor"))
    nearest = (
        ways.join(licensed.withColumnRenamed("directory", "ancestor"), "ancestor")
        .groupBy("directory")
        .agg(F.max(F.struct("depth", "ancestor", "license", "cosine")).alias("near"))
    )
    nearest = scratch.save(nearest, "nearest")
    found = listed.join(own, "file", "left").join(nearest, "directory", "left")
    inherited = F.col("license").isNull() & F.col("near").isNotNull()
    return found.select(
        "file_id",
        "path",
        F.coalesce("license", "near.license").alias("license"),
        F.coalesce("cosine", "near.cosine").alias("cosine"),
        F.when(F.col("license").isNotNull(), "own").when(inherited, "inherited").otherwise("none").alias("origin"),
        F.when(inherited, F.col("near.ancestor")).alias("inherited_from"),
    )
