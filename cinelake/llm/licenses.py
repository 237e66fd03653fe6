"""Licence scans (6): TF-IDF cosine of text segments to templates, inherited along directories; DataFrame functions only.

1. Document frequencies of all words are counted over all documents.
2. Segments are the lines of a text, and its paragraphs of several lines.  Only a segment that
   holds an anchor word can reach the threshold: a template's anchors are its heaviest words, so
   many that the rest of its unit vector is shorter than the threshold.  The segments left are
   exploded to words, joined with the words' document frequencies and the templates' weights and
   summed to cosines.
3. A document's licence is its best segment.  It is a licence file if matching segments make up
   half of its words, or by its name; others carry a header.
4. A document without a licence takes that of the nearest directory above it that holds a licence
   file: every distinct directory is joined once with its ancestors' licences, documents then
   with their directory.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import pick, written

# Notices as authors put them in files (licence, text).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
            " (the Software), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"
                " as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
                     " following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
]
THRESHOLD = 0.8
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
FILE_SHARE = 0.5

_SPLIT = r"[^a-z0-9.]+|\.(?![0-9])|(?<![0-9])\."


def words_of(text: str) -> list[str]:
    return [w for w in re.split(_SPLIT, text.lower()) if w]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda w: w != "")


def _upper(path: Column, levels: Column) -> Column:
    """The first ``levels`` names of a path."""
    return F.call_function("substring_index", path, F.lit("/"), levels)


def _rows(spark, schema: str, rows: list[tuple]) -> DataFrame:
    """A small table of literals."""
    names = [c.split()[0] for c in schema.split(",")]
    values = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(names, r, strict=True)]) for r in rows])
    return spark.range(1).select(F.inline(values.cast(f"array<struct<{schema.replace(' ', ':')}>>")))


def _weights(documents: int, df: dict[str, int], templates: list[tuple[str, str]]) -> tuple[dict[str, float], float, list[dict[str, float]]]:
    """idf of the templates' words, idf of a word of one document, and the templates' unit vectors."""
    def idf(n: int) -> float:
        return math.log((1 + documents) / (1 + n)) + 1
    known = {w: idf(df.get(w, 0)) for _, t in templates for w in words_of(t)}
    vectors = []
    for _, t in templates:
        v = {w: words_of(t).count(w) * known[w] for w in set(words_of(t))}
        length = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({w: x / length for w, x in v.items()})
    return known, idf(1), vectors


def anchors(vector: dict[str, float], threshold: float) -> list[str]:
    """The heaviest words of a unit vector, until the others' norm is below ``threshold``."""
    rest, out = 1.0, []
    for w, x in sorted(vector.items(), key=lambda i: (-i[1], i[0])):
        if rest < threshold * threshold - 1e-9:
            break
        out.append(w)
        rest -= x * x
    return out


def license_headers(docs: DataFrame, templates: list[tuple[str, str]], threshold: float, id_col: str, path_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, path, license, score, covered, n_words): one row per document, its best matching segment or null."""
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_col, path=path_col, text=text_col).select(
        "doc_id", F.col("path").cast("string"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    vocabulary = sorted({w for _, t in templates for w in words_of(t)})
    documents = rows.count()
    counts = written(rows.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df")),
                     "license-counts")
    # the vocabulary is that of the templates: a few hundred rows at most reach the driver
    counted = counts.where(F.col("w").isin(vocabulary)).collect()
    _, _, vectors = _weights(documents, {r["w"]: r["df"] for r in counted}, templates)
    gate = "|".join(sorted({re.escape(w) for v in vectors for w in anchors(v, threshold)}))
    may = F.lit(f"(?i)(?<![a-z0-9])(?:{gate})(?![a-z0-9])")

    def segment(values: Column, kind: int) -> Column:
        return F.transform(F.filter(values, lambda s: F.regexp_like(s, may)), lambda s: F.struct(
            F.lit(kind).alias("kind"), F.unhex(F.sha2(s, 256)).alias("sid"), s.alias("segment")))

    lines = F.split("text", r"\r?\n")
    paragraphs = F.filter(F.split("text", r"\r?\n[\t ]*(?:\r?\n[\t ]*)+"), lambda p: p.rlike(r"\S[\t ]*\r?\n"))
    none = F.array().cast("array<struct<kind:int,sid:binary,segment:string>>")
    held = written(rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "path",
        F.when(F.regexp_like("text", may), F.size(_words(F.col("text")))).alias("n_words"),
        F.when(F.regexp_like("text", may), F.concat(segment(lines, 0), segment(paragraphs, 1))).otherwise(none).alias("segments")), "license-segments")
    # a segment that repeats, in one document or in thousands, is scored once
    # its words carry its digest, not its text
    segments = held.select(F.inline("segments")).groupBy("sid").agg(F.first("segment").alias("segment"))
    texts = segments.select("sid", F.explode(_words(F.col("segment"))).alias("w")).groupBy("sid", "w").agg(F.count(F.lit(1)).alias("tf"))
    idf = F.log((1 + F.lit(float(documents))) / (1 + F.coalesce("df", F.lit(0)))) + 1
    weights = _rows(spark, "w string,template int,weight double", [(w, i, float(x)) for i, v in enumerate(vectors) for w, x in v.items()])
    measured = written(texts.join(counts, "w", "left").select("sid", "w", "tf", (F.col("tf") * idf).alias("x")), "license-words")
    norms = measured.groupBy("sid").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"), F.sum("tf").alias("words"))
    # the weights hold the templates' words only
    dots = (measured.join(F.broadcast(weights), "w").groupBy("sid", "template").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
            .join(norms, "sid").withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= threshold))
    name = F.array(*[F.lit(k) for k, _ in templates])
    best = written(dots.groupBy("sid", "words").agg(F.max(F.struct("score", (-F.col("template")).alias("t"))).alias("m"))
                   .select("sid", "words", F.col("m.score").alias("score"), F.element_at(name, 1 - F.col("m.t")).alias("license")), "license-best")
    found = (held.where(F.size("segments") > 0).select("row", F.inline("segments")).drop("segment").join(best, "sid")
             .groupBy("row").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"), "license")).alias("m"),
                                 F.sum(F.when(F.col("kind") == 0, F.col("words"))).alias("in_lines"),
                                 F.sum(F.when(F.col("kind") == 1, F.col("words"))).alias("in_paragraphs")))
    found = found.select(F.col("row").alias("found_row"), "m.license", "m.score",
                         F.greatest(F.coalesce("in_lines", F.lit(0)), F.coalesce("in_paragraphs", F.lit(0))).alias("covered"))
    return held.drop("segments").join(found, F.col("row") == F.col("found_row"), "left").drop("found_row")


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id",
         path_col: str = "path", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, path, license, score, origin (``file``, ``header``, ``inherited`` or null), from_dir.

    Equal scores go to the earlier template; of several licence files in one directory the best
    score rules, then the smallest name.  Null and empty texts match nothing but may inherit; a
    null path has no directory; null and repeated ids are carried along, one result per row.
    """
    own = license_headers(docs, templates or TEMPLATES, threshold, id_col, path_col, text_col)
    is_file = F.regexp_like("path", F.lit(FILE_NAME)) | (F.col("covered") >= F.col("n_words") * FILE_SHARE)
    depth = F.size(F.split("path", "/")) - 1
    own = written(own.withColumn("is_file", F.coalesce(is_file, F.lit(False)) & F.col("license").isNotNull())
                  .withColumn("dir", F.when(F.col("path").isNotNull(), _upper(F.col("path"), depth))), "license-own")
    ruling = (own.where(F.col("is_file") & F.col("dir").isNotNull()).groupBy("dir")
              .agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("m"))
              .select(F.col("dir").alias("ancestor"), F.col("m.license").alias("up_license"), (-F.col("m.s")).alias("up_score")))
    dirs = own.where("license is null and dir is not null").select("dir").distinct()
    levels = F.when(F.col("dir") == "", F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size(F.split("dir", "/"))))
    above = (dirs.select("dir", F.explode(levels).alias("level"))
             .withColumn("ancestor", _upper(F.col("dir"), F.col("level"))).join(ruling, "ancestor")
             .groupBy("dir").agg(F.max(F.struct("level", "ancestor", "up_license", "up_score")).alias("m")))
    above = written(above.select(F.col("dir").alias("in_dir"), "m.ancestor", "m.up_license", "m.up_score"), "license-inherited")
    origin = (F.when(F.col("is_file"), "file").when(F.col("license").isNotNull(), "header")
              .when(F.col("up_license").isNotNull(), "inherited"))
    return (own.join(above, (F.col("dir") == F.col("in_dir")) & F.col("license").isNull(), "left")
            .select("doc_id", "path", F.coalesce("license", "up_license").alias("license"), F.coalesce("score", "up_score").alias("score"),
                    origin.alias("origin"), F.when(F.col("license").isNull(), F.col("ancestor")).alias("from_dir")))
