"""License scans through MinHash bands.

Texts and templates are lower-cased and split into runs of letters and digits; their
shingles are five words (a shorter text: all its words). Overlapping windows of two
neighbouring shingles (six words, moving by one) are hashed by ``BANDS`` MinHash
functions of one row each, and a template is retrieved by any window whose band equals
one of its own windows'. A window that lies wholly in a template collides in every band;
one that shares half its shingles, the least that a template of a single shingle leaves,
collides with probability 1 - 0.5 ** BANDS = 0.996. Retrieved templates are verified by
the exact containment of their shingles in the text: ``CONTAINED`` or more is a match,
unless another license's version of the same notice is contained to a higher degree.
A template of fewer than five words matches where its words stand in the text in a row.

The templates are a short parameter list, so their keys are literals of the query: the
scan needs no join and no shuffle. Only DataFrame functions are used. Defined cases: null
and empty texts match nothing; repeated rows give one result row each; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catloss.llm.common import text_or_empty
from catloss.llm.line_dedup import bind

WIDTH = 5
BANDS = 8
CONTAINED = 0.8

# fixed values: usual notices of public licenses
NOTICES = {
    "Apache-2.0": [
        "Apache License Version 2.0, January 2004",
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "GPL-3.0": [
        "licensed under the GNU General Public License, version 3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, version 3 of the License",
        "under the terms of the GNU General Public License version 3 as published by the Free Software Foundation",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ],
    "GPL-2.0": [
        "licensed under the GNU General Public License, version 2",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License",
        "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ],
    "LGPL": [
        "under the terms of the GNU Lesser General Public License",
        "under the terms of the GNU Library General Public License",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991",
    ],
    "AGPL-3.0": ["under the terms of the GNU Affero General Public License", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "MPL-1.1": ["The contents of this file are subject to the Mozilla Public License Version 1.1", "Mozilla Public License Version 1.1"],
    "EPL-1.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0", "Eclipse Public License - v 1.0"],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "Eclipse Public License - v 2.0"],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0",
        "Boost Software License - Version 1.0 - August 17th, 2003",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
    ],
    "Artistic-1.0": ["The intent of this document is to state the conditions under which a Package may be copied, such that the Copyright Holder maintains some semblance of artistic control over the development of the package"],
    "Artistic-2.0": [
        "under the terms of the Artistic License 2.0",
        "under the terms of the Artistic License version 2.0",
        "This license establishes the terms under which a given free software Package may be copied, modified, distributed, and/or redistributed",
    ],
    "MPL-2.0": ["Mozilla Public License Version 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0-1.0": ["dedicated to the public domain under CC0 1.0 Universal"],
}


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _per_shingle(words: Column, make: Callable[[Column], Column], width: int = WIDTH) -> Column:
    """make(start) for each shingle of the words, from 0."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - width, F.lit(0))), make)


def _hashes(words: Column) -> Column:
    return _per_shingle(words, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WIDTH)]))


def _texts(words: Column, width: int = WIDTH) -> Column:
    return F.array_distinct(_per_shingle(words, lambda i: F.concat_ws(" ", F.slice(words, i + 1, width)), width))


def _bands(hashes: Column) -> Column:
    """Band keys of all windows of two neighbouring shingles; the first and the last one also stand alone."""

    def band(k: int) -> Column:
        def windows(a: Column) -> Column:
            return F.transform(F.sequence(F.lit(-1), F.size(a) - 1), lambda i: F.least(F.get(a, i), F.get(a, i + 1)))  # at the ends alone

        return bind(F.transform(hashes, lambda x: F.xxhash64(F.lit(k), x)), windows)

    return F.concat(*[band(k) for k in range(BANDS)])


def _template_rows(spark: SparkSession, notices: dict[str, list[str]]) -> list:
    rows = [(name, text) for name, texts in notices.items() for text in texts]
    words = spark.createDataFrame(rows, "license string, text string").select("license", _words(F.col("text")).alias("words"))
    keyed = words.select("license", F.size("words").alias("n"), bind(F.col("words"), lambda w: bind(_hashes(w), _bands)).alias("bands"), bind(F.col("words"), lambda w: _texts(w)).alias("shingles"))
    return keyed.collect()  # the parameter list


def scan(docs: DataFrame, notices: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows (doc_id, matches: array of (license, containment)) for each document; the best notice counts for a license."""
    notices = NOTICES if notices is None else notices
    every_template = _template_rows(docs.sparkSession, notices)
    templates = [t for t in every_template if t["n"] >= WIDTH]
    short = {w: [t for t in every_template if t["n"] == w] for w in sorted({t["n"] for t in every_template}) if 0 < w < WIDTH}
    longs = lambda x: F.array(*[F.lit(v) for v in sorted(set(x))]).cast("array<bigint>")
    every = longs(k for t in templates for k in t["bands"])
    # notices of other licenses that share half of a notice's shingles: versions of one text
    rivals = [
        [j for j, o in enumerate(templates) if o["license"] != t["license"] and 2 * len({*t["shingles"]} & {*o["shingles"]}) >= len(t["shingles"])]
        for t in templates
    ]
    listed = F.array(*[
        F.struct(F.lit(t["license"]).alias("license"), F.lit(i).alias("number"), F.array(*map(F.lit, rivals[i])).cast("array<int>").alias("rivals"), longs(t["bands"]).alias("bands"), F.array(*[F.lit(s) for s in t["shingles"]]).alias("shingles"))
        for i, t in enumerate(templates)
    ])

    def matches(words: Column) -> Column:
        retrieved = bind(F.array_intersect(bind(_hashes(words), _bands), every), lambda hits: F.when(
            F.size(hits) > 0, F.filter(listed, lambda t: F.arrays_overlap(t["bands"], hits))))

        def verify(found: Column) -> Column:
            contained = bind(_texts(words), lambda own: F.transform(found, lambda t: F.struct(
                t["license"].alias("license"), t["number"].alias("number"), t["rivals"].alias("rivals"), (F.size(F.array_intersect(t["shingles"], own)) / F.size(t["shingles"])).alias("containment"))))
            best = bind(F.filter(contained, lambda m: m["containment"] >= CONTAINED), lambda ms: F.filter(ms, lambda m: ~F.exists(
                ms, lambda o: F.array_contains(m["rivals"], o["number"]) & (o["containment"] > m["containment"]))))
            return F.when(F.size(found) > 0, F.transform(best, lambda m: F.struct(m["license"].alias("license"), m["containment"].alias("containment"))))

        return bind(retrieved, verify)

    def short_matches(words: Column, width: int) -> Column:
        """Matches of the templates of ``width`` words."""
        listed = F.array(*[F.struct(F.lit(t["license"]).alias("license"), F.lit(1.0).alias("containment"), F.lit(t["shingles"][0]).alias("text")) for t in short[width]])
        own = bind(_texts(words, width), lambda own: F.filter(listed, lambda t: F.array_contains(own, t["text"])))
        return F.transform(own, lambda m: F.struct(m["license"].alias("license"), m["containment"].alias("containment")))

    none = F.array().cast("array<struct<license:string,containment:double>>")

    def all_matches(words: Column) -> Column:
        return F.concat(F.coalesce(matches(words), none) if templates else none, *[short_matches(words, w) for w in short])

    found = docs.select("doc_id", bind(_words(text_or_empty()), lambda w: F.when(F.size(w) > 0, all_matches(w))).alias("found"))
    return found.select("doc_id", F.coalesce("found", none).alias("matches"))
