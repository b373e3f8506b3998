"""Licence scan: TF-IDF cosine of notices to templates, then inheritance.

A notice is a line most of whose words are template words, or a whole run of
such neighbours.
Every notice is compared with every template as a sparse TF-IDF vector: the
inverse document frequency of a template word is counted over all files; a word
that is in no template weighs like one that no file holds, and only lengthens
the notice. The best template at or above LEAST_COSINE names the licence.

A file is a licence file if its name says so, or if a notice makes up at least
LICENCE_SHARE of its words. A directory has the licence of its best licence file;
a file without a notice of its own inherits from its nearest ancestor directory
that has one. Ancestors are joined per directory, not per file, so a directory
that holds a third of all files is one row until its files look it up (heavy
directories are split off and broadcast, they are few by counting).

All steps are DataFrame expressions; what is broadcast is bounded by the
templates. Defined cases: null and empty texts have no notice and only inherit;
a null path is the root directory; equal paths are separate files; ties go to
the higher cosine, then the licence first in alphabetical order, then the
smaller path; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audix.llm.shared import join_by_key, stored

WORD = "[a-z0-9]+"
LINE_SHARE = 0.6
LEAST_COSINE = 0.6
LICENCE_SHARE = 0.5
LICENCE_NAME = r"(?i)^(un)?licen[cs]e|^copying|^notice"

# Customary notices and opening words of public licences.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights. CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
]


def template_words(templates: list[tuple[str, str]]) -> list[tuple[int, str, str, int]]:
    """(template number, licence, word, count) rows."""
    return [(i, name, w, n) for i, (name, text) in enumerate(templates)
            for w, n in sorted(Counter(re.findall(WORD, text.lower())).items())]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def scan(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST_COSINE) -> DataFrame:
    """file_id, path, licence (or null), cosine, origin (notice, inherited or
    none) and directory (that gave an inherited licence) of files(file_id, path,
    text)."""
    spark = files.sparkSession
    rows = template_words(templates)
    vocabulary = sorted({r[2] for r in rows})
    table = spark.createDataFrame(rows, "template int, licence string, word string, n long")
    base = files.select(F.col("file_id").cast("long").alias("file_id"),
                        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    # document frequencies of the template words, over all files
    total = base.count()
    seen = base.select(F.explode(F.array_distinct(F.filter(_words(F.col("text")), lambda w: w.isin(vocabulary)))).alias("word"))
    df = seen.groupBy("word").agg(F.count("*").alias("df"))
    unseen = F.lit(total + 1.0)
    idf = F.broadcast(table.select("word").distinct().join(df, "word", "left")
                      .select("word", (F.log(unseen / (F.coalesce("df", F.lit(0)) + 1)) + 1).alias("idf")))
    weights = table.join(idf, "word").withColumn("w", F.col("n") * F.col("idf"))
    norms = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    vectors = stored(weights.join(norms, "template")
                     .select("template", "licence", "word", "idf", (F.col("w") / F.col("size")).alias("unit")), "templates")

    # runs of neighbouring lines made of template words
    lines = (base.select("file_id", "path", F.size(_words(F.col("text"))).alias("all_words"),
                         F.posexplode(F.split("text", "\n")).alias("line", "t"))
             .withColumn("words", _words(F.col("t")))
             .withColumn("known", F.filter("words", lambda w: w.isin(vocabulary)))
             .where((F.size("words") > 0) & (F.size("known") >= LINE_SHARE * F.size("words")))
             .select("file_id", "path", "all_words", "line", "words"))
    place = Window.partitionBy("file_id", "path").orderBy("line")
    runs = stored(lines.withColumn("run", F.col("line") - F.dense_rank().over(place)), "notices")
    single = runs.withColumn("notice", F.concat(F.lit("line "), F.col("line").cast("string")))
    noted = single.unionByName(runs.withColumn("notice", F.concat(F.lit("run "), F.col("run").cast("string"))))
    words = (noted.select("file_id", "path", "notice", F.explode("words").alias("word"))
             .groupBy("file_id", "path", "notice", "word").agg(F.count("*").alias("n")))
    weighed = (words.join(idf, "word", "left")
               .withColumn("w", F.col("n") * F.coalesce("idf", F.log(unseen) + 1)))
    key = ["file_id", "path", "notice"]
    size = weighed.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"), F.sum("n").alias("n_words"))
    dots = (weighed.join(F.broadcast(vectors.select("template", "licence", "word", "unit")), "word")
            .groupBy(*key, "template", "licence").agg(F.sum(F.col("w") * F.col("unit")).alias("dot")))
    scored = dots.join(size, key).withColumn("cosine", F.round(F.col("dot") / F.col("size"), 6)).where(F.col("cosine") >= least)
    best_first = F.struct((-F.col("cosine")).alias("c"), "licence", "notice")
    own = stored(scored.groupBy(*key, "n_words")
                 .agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b"))
                 .select(*key, "n_words", (-F.col("b.c")).alias("cosine"), F.col("b.licence").alias("licence"))
                 .groupBy("file_id", "path").agg(F.min(best_first).alias("b"), F.max("n_words").alias("n_words"))
                 .select("file_id", "path", F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine"), "n_words"),
                 "own")

    # licences of directories, from their licence files
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    lengths = runs.groupBy("file_id", "path").agg(F.max("all_words").alias("all_words"))
    licence_files = (own.join(lengths, ["file_id", "path"])
                     .where(F.regexp_extract("path", "[^/]*$", 0).rlike(LICENCE_NAME)
                            | (F.col("n_words") >= LICENCE_SHARE * F.col("all_words"))))
    given = (licence_files.withColumn("directory", directory).groupBy("directory")
             .agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence", "path")).alias("b"))
             .select("directory", F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine")))

    # nearest ancestor, directory by directory
    located = base.select("file_id", "path").withColumn("home", directory)
    homes = located.groupBy("home").agg(F.count("*").alias("n"))
    parts = F.split("home", "/")
    above = (homes.withColumn("depth", F.explode(F.sequence(F.lit(0), F.when(F.col("home") == "", 0).otherwise(F.size(parts)))))
             .withColumn("directory", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/")))
    above = stored(above, "above")
    often = above.groupBy("directory").agg(F.count("*").alias("often"))
    nearest = (join_by_key(above, given.join(often, "directory"), ["directory"], "often", above.count())
               .groupBy("home", "n").agg(F.max(F.struct("depth", "directory", "licence", "cosine")).alias("g"))
               .select("home", "n", "g.directory", F.col("g.licence").alias("given"), F.col("g.cosine").alias("given_cosine")))
    nearest = stored(homes.join(nearest, ["home", "n"], "left"), "nearest")
    placed = join_by_key(located, nearest, ["home"], "n", total).drop("home", "n")
    found = placed.join(own.select("file_id", "path", "licence", "cosine"), ["file_id", "path"], "left")
    has = F.col("licence").isNotNull()
    return found.select(
        "file_id", "path", F.coalesce("licence", "given").alias("licence"),
        F.when(has, F.col("cosine")).otherwise(F.col("given_cosine")).alias("cosine"),
        F.when(has, "notice").when(F.col("given").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~has, F.col("directory")).alias("directory"))
