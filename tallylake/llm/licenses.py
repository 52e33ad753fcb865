"""License scans: MinHash bands over overlapping windows retrieve templates, containment verifies.

All of it is DataFrame functions. A text's words are cut into windows of a few sizes that overlap by half. A window
has one minimum per hash function over its shingles, and each band is one such minimum, so
a window and a template with Jaccard similarity J share a band with chance
``1 - (1 - J) ** BANDS``. Window sizes step by two and windows by a half, so some window
holds a full copy of a template and has at most four times its shingles: J is 1/4 or more,
and with 64 bands a copy is missed once in 10^8.

Windows without any shingle of a template can't share a minimum with one, so they are left out
before any minimum is taken. Candidates are then checked by the exact share of the
template's shingles that the window contains.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm.words import word_array

SHINGLE_WORDS = 5
BANDS = 64
MIN_CONTAINMENT = 0.8
MAX_TEMPLATE_SHINGLES = 20_000  # bound of all templates together; they are constants of the plan

# Published license statements by their usual short names.
TEMPLATES: Mapping[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version. This program is distributed in the hope "
        "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:"
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:"
    ),
    "BSD-2-Clause-conditions": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
    "BSD-3-Clause-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission."
    ),
    "BSD-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "MIT-disclaimer": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT."
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies."
    ),
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "GPL-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version."
    ),
    "LGPL-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
        "the License, or (at your option) any later version."
    ),
    "LGPL-3.0-notice": (
        "is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "AGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version."
    ),
    "EPL-2.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
        "a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "CC0-1.0-notice": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and "
        "neighboring rights to this software to the public domain worldwide. This software is distributed "
        "without any warranty."
    ),
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "CC-BY-NC-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ),
    "CC-BY-ND-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."
    ),
}


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def license_words(text: Column) -> Column:
    """Words in lower case without punctuation at either end; words of punctuation alone are left out."""
    words = F.transform(
        word_array(F.lower(text)), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    )
    return F.filter(words, lambda w: w != "")


def shingle_array(words: Column, n: int = SHINGLE_WORDS) -> Column:
    """64-bit hashes of all ``n``-word shingles in order; a text with fewer words has none."""

    def hashes(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - n),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]),
        )

    return _bound(
        words, lambda w: F.when(F.size(w) >= n, hashes(w)).otherwise(F.array().cast("array<bigint>"))
    )


def minima(window: Column, bands: int = BANDS) -> Column:
    """The smallest hash of a window's shingles under each of the hash functions."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda k: F.array_min(F.transform(window, lambda x: F.xxhash64(x, k))),
    )


def template_table(spark: SparkSession, templates: Mapping[str, str]) -> list[tuple[str, list[int]]]:
    """(license, distinct shingles) of every template of at least one shingle."""
    rows = spark.createDataFrame(list(templates.items()), "license string, text string")
    rows = rows.select("license", F.array_distinct(shingle_array(license_words(F.col("text")))).alias("s"))
    found = [(r["license"], sorted(r["s"])) for r in rows.collect() if r["s"]]
    if sum(len(s) for _, s in found) > MAX_TEMPLATE_SHINGLES:
        raise ValueError("scan large template collections in parts")
    return sorted(found)


def window_size(shingles: Sequence) -> int:
    """Twice a template's shingles, rounded up to a power of two: the windows it is sought in."""
    return 2 << max(1, len(shingles) - 1).bit_length()


def window_sizes(templates: Sequence[tuple[str, Sequence]]) -> list[int]:
    return sorted({window_size(s) for _, s in templates})


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
    min_containment: float = MIN_CONTAINMENT,
) -> DataFrame:
    """(doc_id, license, containment, first_word, n_windows): the licenses found in each text.

    ``containment`` is the largest share of a template's shingles that one window contains,
    ``n_windows`` how many windows reach ``min_containment``, ``first_word`` where the first of them
    starts. A template of fewer than five words can't be found. NULL and empty
    texts have no row; repeated rows count together under their doc_id. Other columns are ignored.
    """
    spark = docs.sparkSession
    table = template_table(spark, templates)
    all_shingles = sorted({x for _, s in table for x in s})
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select("doc_id", shingle_array(license_words(F.col("text"))).alias("s"))

    def windows_at(size: int):
        """The two windows of a size that hold a place: (size, start) each."""
        half = size // 2

        def around(place: Column) -> Column:
            last = (F.floor(place / half) * half).cast("int")
            return F.array(
                *[F.struct(F.lit(size).alias("size"), x.alias("start")) for x in (last, last - half)]
            )

        return around

    def touched(s: Column) -> Column:
        """The windows that hold a template's shingle."""
        marked = F.transform(s, lambda x, i: F.when(x.isin(all_shingles), i))

        def windows(places: Column) -> Column:
            found = F.concat(*[F.flatten(F.transform(places, windows_at(n))) for n in window_sizes(table)])
            return F.array_distinct(F.filter(found, lambda w: w["start"] >= 0))

        return _bound(F.array_compact(marked), windows)

    windows = rows.select("doc_id", "s", F.explode(touched(F.col("s"))).alias("w"))
    windows = windows.select(
        "doc_id", "w.size", "w.start", F.slice("s", F.col("w.start") + 1, F.col("w.size")).alias("part")
    )
    # the templates are few and bounded, so their bands are constants next to each window's
    signed = windows.withColumn("bands", minima(F.col("part")))
    constants = spark.createDataFrame(table, "license string, shingles array<bigint>")
    constants = constants.select("license", minima(F.col("shingles")).alias("bands"))
    lowest = {row["license"]: row["bands"] for row in constants.collect()}  # 64 numbers a template
    by_license = dict(table)

    def share(part: Column, license: str) -> Column:
        wanted = by_license[license]
        found = F.size(F.array_intersect(part, F.array(*[F.lit(x) for x in wanted])))
        return found / F.lit(float(len(wanted)))

    def retrieved(license: str) -> Column:
        own = F.array(*[F.lit(x) for x in lowest[license]])
        return F.exists(F.zip_with("bands", own, lambda a, b: a == b), lambda same: same)

    hits = F.array_compact(
        F.array(
            *[
                F.when(
                    (F.col("size") == window_size(shingles)) & retrieved(name),
                    F.struct(F.lit(name).alias("license"), share(F.col("part"), name).alias("containment")),
                )
                for name, shingles in table
            ]
        )
    )
    found = signed.select("doc_id", "start", F.explode(hits).alias("hit")).filter(
        F.col("hit.containment") >= min_containment
    )
    return found.groupBy("doc_id", F.col("hit.license").alias("license")).agg(
        F.max("hit.containment").alias("containment"),
        F.min("start").cast("long").alias("first_word"),
        F.count("*").alias("n_windows"),
    )


def oracle(templates: Mapping[str, str] = TEMPLATES, min_containment: float = MIN_CONTAINMENT) -> str:
    """DuckDB SQL for the same rows, every window compared with every template by its shingles."""
    wanted = {}
    for name, text in templates.items():
        words = [re.sub(r"^[\W_]+|[\W_]+$", "", w) for w in text.lower().split()]
        words = [w for w in words if w]
        grams = sorted({" ".join(words[i : i + 5]) for i in range(len(words) - SHINGLE_WORDS + 1)})
        if grams:
            wanted[name] = grams
    quoted = lambda texts: "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in texts) + "]"
    rows = ", ".join(
        f"('{name}', {quoted(grams)}, {window_size(grams)})" for name, grams in wanted.items()
    )
    sizes = ", ".join(f"({n})" for n in window_sizes(list(wanted.items())))
    return rf"""
WITH t(license, grams, size) AS (VALUES {rows}),
every AS (SELECT list_distinct(flatten(list(grams))) AS grams FROM t),
d AS (SELECT doc_id, list_filter(list_transform(
        regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+'),
        lambda w: regexp_replace(w, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')), lambda w: w <> '') AS w
      FROM documents),
s AS (SELECT doc_id, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS s
      FROM d WHERE len(w) >= 5),
c AS (SELECT s.* FROM s, every WHERE list_has_any(s, grams)),
z(size) AS (VALUES {sizes}),
v AS (SELECT doc_id, size, start, s[start + 1:start + size] AS part
      FROM (SELECT doc_id, s, size, unnest(range(0, len(s), size // 2)) AS start FROM c, z)),
f AS (SELECT doc_id, license, v.size, start,
             len(list_intersect(list_distinct(part), grams)) / len(grams)::DOUBLE AS containment
      FROM v JOIN t ON t.size = v.size WHERE list_has_any(part, grams))
SELECT doc_id, license, max(containment) AS containment,
       CAST(min(start) AS BIGINT) AS first_word, count(*) AS n_windows
FROM f WHERE containment >= {min_containment} GROUP BY doc_id, license
"""
