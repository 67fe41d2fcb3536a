"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

Texts and templates are sets of five-word shingles. For each size of template a text is cut into overlapping windows
such that any stretch as long as the template lies in one of them; the window is at most about twice as long, so a
window that holds the needed share of a template has a known least Jaccard similarity to it. The number of bands (of
one minimum each) is set so that at that similarity a template is missed with a probability of at most MISSED. What
bands retrieve is then decided on the shingles themselves.

Shingle hashes are made by Spark's own functions, minima by numpy for many texts at once. No shuffle; the templates are
a short list that travels with the job.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.llm.catalog import query, table
from boxloom.llm.words import NOT_WORD, lower_ascii, runs, split_words

SHINGLE, CONTAINED, MISSED = 5, 0.8, 1e-4
#: the words that are hashed, in a text as it is
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

# Notices and opening clauses as their licences publish them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3"],
    "GPL-2.0-or-later": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0"],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
}


def shingle_hashes(words: str) -> Column:
    return runs(F.col(words), SHINGLE, lambda w: F.xxhash64(*w))


def window_of(shingles: int, contained: float = CONTAINED) -> tuple[int, int, int]:
    """(stride, strides in a window, bands) for templates of so many shingles."""
    stride = max(1, shingles // 4)
    width = -(-(shingles + stride - 1) // stride)
    held = math.ceil(contained * shingles)
    similarity = held / (width * stride + shingles - held)
    return stride, width, 1 if similarity == 1 else math.ceil(math.log(MISSED) / math.log(1 - similarity))


def multipliers(n: int) -> np.ndarray:
    """Odd numbers by rule: multiplying by one and mixing the halves makes another order of the hashes."""
    return (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def reordered(hashes: np.ndarray, by: np.uint64) -> np.ndarray:
    h = (hashes ^ (hashes >> np.uint64(32))) * by
    return h ^ (h >> np.uint64(29))


def candidates(hashes: np.ndarray, ends: np.ndarray, sets: list[np.ndarray], contained: float = CONTAINED):
    """(template, first and last + 1 place of a window) over texts that end at ``ends`` in the joined hashes."""
    found = set()
    for size in sorted({len(s) for s in sets}):
        stride, width, bands = window_of(size, contained)
        own = [i for i, s in enumerate(sets) if len(s) == size]
        starts = np.r_[0, ends[:-1]]
        counts = -(-(ends - starts) // stride)
        text = np.repeat(np.arange(len(ends)), counts)
        begin = starts[text] + (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)) * stride
        if not len(begin):
            continue
        last = np.minimum(np.arange(len(text)) + width, np.cumsum(counts)[text])  # windows end with their text
        for by in multipliers(bands):
            low = np.minimum.reduceat(reordered(hashes, by), begin)
            least = low.copy()
            for k in range(1, width):
                np.minimum(least[:-k], np.where(text[k:] == text[:-k], low[k:], least[:-k]), out=least[:-k])
            for i in own:
                for w in np.flatnonzero(least == reordered(sets[i], by).min()):
                    found.add((i, int(begin[w]), int(min(begin[last[w] - 1] + stride, ends[text[w]]))))
    return found


def matches(hashes: np.ndarray, ends: np.ndarray, sets: list[np.ndarray], contained: float = CONTAINED):
    """(text, template, first shingle, last shingle, containment), one row for each stretch; stretches do not overlap."""
    best: dict = {}
    for i, a, b in candidates(hashes, ends, sets, contained):
        t = int(np.searchsorted(ends, a, "right"))
        from_, to = int(ends[t - 1]) if t else 0, int(ends[t])
        a, b = max(from_, a - len(sets[i])), min(to, b + len(sets[i]))  # copies with insertions may stick out
        at = np.flatnonzero(np.isin(hashes[a:b], sets[i])) + a
        # copies in one window are told apart by the distance between their shingles
        for part in np.split(at, np.flatnonzero(np.diff(at) > len(sets[i])) + 1):
            share = len(np.unique(hashes[part])) / len(sets[i])
            if share >= contained:
                best.setdefault((t, i), set()).add((int(part[0]) - from_, int(part[-1]) - from_, share))
    for (t, i), spans in sorted(best.items()):
        end = -1
        for a, b, share in sorted(spans, key=lambda s: (s[0], -s[1])):
            if a > end:
                yield t, i, a, b, share
                end = b


def find_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None, contained: float = CONTAINED) -> DataFrame:
    """``doc_id, license, template, start, end, containment``: one row for each stretch that holds a template.

    ``template`` is its place in the license's list; start and end are code points of the original text. Of overlapping
    stretches of one template the first counts; different templates may overlap. Templates below five words cannot
    match and are rejected. Null, empty and short texts match nothing; repeated rows are each reported.
    """
    listed = [(name, k, text) for name, texts in (TEMPLATES if templates is None else templates).items() for k, text in enumerate(texts)]
    spark = docs.sparkSession
    worded = spark.createDataFrame(
        [(i, t) for i, (*_, t) in enumerate(listed)], "i int, text string"
    ).select("i", split_words(lower_ascii(F.col("text")), NOT_WORD).alias("_w")).select("i", shingle_hashes("_w").alias("_h"))
    sets = [np.unique(np.array(r["_h"], np.int64).view(np.uint64)) for r in worded.orderBy("i").collect()]
    if not all(len(s) for s in sets):
        raise ValueError("templates need five words or more")
    names = [(name, k) for name, k, _ in listed]
    columns = "doc_id long, license string, template int, start int, end int, containment double"

    def made(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                ids, texts, lists = b.slice(at, 512).columns
                hashes = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
                rows = []
                for t, i, first, last, share in matches(hashes, ends, sets, contained):
                    words = list(WORD.finditer(texts[t].as_py()))
                    rows.append((ids[t].as_py(), *names[i], words[first].start(), words[last + SHINGLE - 1].end(), share))
                if rows:
                    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                        [x.split()[0] for x in columns.split(", ")],
                    )

    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", split_words(lower_ascii(F.col("text")), NOT_WORD).alias("_w"))
        .select("doc_id", "text", shingle_hashes("_w").alias("_h")).mapInArrow(made, columns)
    )


@query("op7_licenses")
def op7_licenses(spark, folder):
    return find_licenses(table(spark, folder, "documents").select("doc_id", "text"))
