"""License scan: MinHash bands retrieve templates, exact containment verifies.

Texts and templates become words (letters and digits, lower case) and shingles
of five words.  A text window has ``WINDOW`` shingles and windows start every
``WINDOW`` shingles, so that windows overlap by four words and each shingle lies
in one window.  Every run of up to ``WINDOW`` shingles of a template is a
template window.  ``BANDS`` MinHashes of a window are a band each: a window
that shares one of its four shingles with a template's run has a Jaccard
similarity of 1/4 or more to the run of the shared ones, so some band agrees
with probability ``1 - 0.75 ** 24`` (0.999) at least, and surely when a run
fills the window.

A template of fewer than five words is one shingle, its whole word sequence;
every run of as many words of a text is compared with it, so none is missed.

Retrieved pairs are verified on the shingles themselves; a document has a
license where the share of the template's distinct shingles found in its
retrieved windows is ``CONTAINMENT`` or more.

The templates are a parameter and bounded (``MAX_SHINGLES``), so their tables
are broadcast; the library here holds common notices, not all there are.
Defined results: a null, empty or shorter text has no license, and a template
without words is never found; a document may have several licenses (the header of
an AGPL text also holds over 0.8 of the GPL's);
rows that share an id are one document; a null id is one document too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 5
WINDOW = 4
BANDS = 24
CONTAINMENT = 0.8
MAX_SHINGLES = 20_000
#: license notices (fixed values)
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-header": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                   "Public License as published by the Free Software Foundation"),
    "mit": "Released under the MIT License",
    "mit-grant": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files, to deal in the Software without restriction"),
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "bsd-names": ("nor the names of its contributors may be used to endorse or promote products derived from this software "
                  "without specific prior written permission"),
    "bsd-warranty": "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties",
    "mit-warranty": "The software is provided \"as is\", without warranty of any kind",
    "lgpl": "GNU Lesser General Public License",
    "lgpl-header": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                    "General Public License as published by the Free Software Foundation"),
    "agpl": "GNU Affero General Public License",
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice"),
    "unlicense": "This is free and unencumbered software released into the public domain",
    "cc0-1.0-deed": "dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law",
    "cc-by": "Licensed under CC BY 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "epl": "made available under the terms of the Eclipse Public License",
    "bsl-1.0": "Distributed under the Boost Software License, Version 1.0",
    "zlib": "This software is provided 'as-is', without any express or implied warranty",
}
#: notices of fewer than ``WIDTH`` words (fixed values)
NOTICES = {
    "all-rights-reserved": "All rights reserved",
    "cc0-1.0": "CC0 1.0 Universal",
    "spdx": "SPDX-License-Identifier",
    "copyright-line": "Copyright (c)",
    **{f"copyright-{year}": f"Copyright {year}" for year in range(1970, 2050)},
}


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(w: Column) -> Column:
    n = F.size(w) - WIDTH + 1
    return F.when(n >= 1, F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(w, i, WIDTH), " "))
                  ).otherwise(F.array().cast("array<string>"))


def _band_key(hashes: list[Column], band: Column) -> Column:
    """The window's MinHash in ``band`` as a key; nulls are passed over."""
    low = F.least(*[F.when(h.isNotNull(), F.xxhash64(h, band)) for h in hashes])
    return F.xxhash64(low, band)


def template_windows(spark, templates: dict[str, str]) -> DataFrame:
    """``(license, total, run)``: every run of up to ``WINDOW`` shingles."""
    lib = (spark.createDataFrame(list(templates.items()), "license string, body string")
           .withColumn("s", shingles(words(F.col("body")))).withColumn("total", F.size(F.array_distinct("s"))))
    return (lib.select("license", "total", "s", F.explode(F.sequence(F.lit(1), F.greatest(F.size("s"), F.lit(1)))).alias("i"))
            .select("license", "total", "s", "i", F.explode(F.sequence(F.lit(1), F.lit(WINDOW))).alias("n"))
            .where("i + n - 1 <= size(s)").select("license", "total", F.slice("s", F.col("i"), F.col("n")).alias("run")))


def short_templates(spark, templates: dict[str, str]) -> DataFrame:
    """``(license, n, run)``: the word sequences of the templates of ``n < WIDTH`` words."""
    lib = spark.createDataFrame(list(templates.items()), "license string, body string").withColumn("w", words(F.col("body")))
    return lib.select("license", F.size("w").alias("n"), F.array_join("w", " ").alias("run")).where(F.col("n").between(1, WIDTH - 1))


def short_finds(spans: DataFrame, short: DataFrame) -> DataFrame:
    """``(id, license)`` where ``w`` of ``(id, w)`` holds the whole sequence of a short template.

    Every word is looked up among the templates' first words; runs are formed
    only where one begins."""
    sizes = sorted(r["n"] for r in short.select("n").distinct().collect())  # fewer than WIDTH
    firsts = short.select(F.substring_index("run", " ", 1).alias("word")).distinct()
    begun = spans.select("id", "w", F.posexplode("w").alias("at", "word")).join(F.broadcast(firsts), "word", "left_semi")
    runs = [F.when(F.size("w") >= F.col("at") + n, F.array_join(F.slice("w", F.col("at") + 1, n), " ")) for n in sizes]
    found = begun.select("id", F.explode(F.array(*runs).cast("array<string>")).alias("run"))
    return found.join(F.broadcast(short), "run").select("id", "license").distinct()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
         containment: float = CONTAINMENT) -> DataFrame:
    """``(id_col, license, n_shingles, containment)`` for every license found."""
    spark = docs.sparkSession
    templates = {**TEMPLATES, **NOTICES} if templates is None else templates
    runs, short = template_windows(spark, templates), short_templates(spark, templates)
    if runs.where("size(run) = 1").count() + short.count() > MAX_SHINGLES:
        raise ValueError(f"templates of over {MAX_SHINGLES} shingles")
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    own = [F.get("run", F.lit(i)) for i in range(WINDOW)]
    own = [F.when(r.isNotNull(), F.xxhash64(r)) for r in own]
    index = runs.select("license", "run", band).select("license", _band_key(own, F.col("band")).alias("key")).distinct()

    spans = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("w"))
    # overlapping windows: WINDOW + WIDTH - 1 words, a new one every WINDOW words
    starts = F.when(F.size("w") >= WIDTH, F.sequence(F.lit(1), F.size("w") - WIDTH + 1, F.lit(WINDOW)))
    windows = (spans.select("id", "w", F.explode(starts).alias("at"))
               .select("id", F.slice("w", F.col("at"), WINDOW + WIDTH - 1).alias("w")))
    word = [F.get("w", F.lit(i)) for i in range(WINDOW + WIDTH - 1)]
    parts = [F.when(F.size("w") >= i + WIDTH, F.xxhash64(F.concat_ws(" ", *word[i:i + WIDTH]))) for i in range(WINDOW)]
    windows = windows.select("id", "w", *[p.alias(f"s{i}") for i, p in enumerate(parts)])
    keys = windows.select("id", "w", *[f"s{i}" for i in range(WINDOW)], band).select(
        "id", "w", _band_key([F.col(f"s{i}") for i in range(WINDOW)], F.col("band")).alias("key"))
    # the library is bounded by MAX_SHINGLES
    pairs = keys.join(F.broadcast(index), "key").select("id", "w", "license").distinct()
    body = runs.where("size(run) = 1").select("license", "total", F.col("run")[0].alias("shingle")).distinct()
    exact = (pairs.select("id", "license", F.explode(shingles(F.col("w"))).alias("shingle"))
             .join(F.broadcast(body), ["license", "shingle"]))
    share = F.countDistinct("shingle") / F.first("total")
    whole = short_finds(spans, short).select("id", "license", F.lit(1).cast("long").alias("n_shingles"), F.lit(1.0).alias("containment"))
    return (exact.groupBy("id", "license").agg(F.countDistinct("shingle").cast("long").alias("n_shingles"), share.alias("containment"))
            .unionByName(whole).where(F.col("containment") >= containment)
            .select(F.col("id").alias(id_col), "license", "n_shingles", "containment"))
