"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

All within a row, by DataFrame functions: no shuffle, no join, nothing that a
frequent license could heat up. The templates are a parameter of bounded size
(checked), and their index becomes literals of the plan.

A text's words give shingles of five words and one hash for each. Windows of some
consecutive shingles give one least hash for each of the BANDS seeds; a band is
one such value. A template's windows are a fifth of its shingles long, at most
WINDOW and at least one, and are indexed at every offset. A text's windows of
each of these lengths begin at every second shingle, so a run of unchanged
shingles one longer than a window always meets an equal one, and a text with 0.8
of a template's shingles in their places has such a run: that is the guarantee.
Beyond it, each seed hashes the hashes anew, so the orders are independent and
windows of Jaccard similarity j meet with probability 1 - (1 - j) ** BANDS: 0.9959
at 0.6, which is windows of four that differ in one shingle, the most alike that
are not equal; 0.984 at 0.5, of three that do; 0.912 at 0.333, of two that do. A
window of one shingle has one value, its hash.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import own_name

SHINGLE = 5
WINDOW = 4
BANDS = 6
LEAST = 0.8
MAX_TEMPLATES = 500
MAX_WORDS = 20_000

#: Characters that count as blanks, so that comment and list marks leave no words.
MARKS = tuple(".,;:!?()\"'*#/-<>|=~+_%[]{}&$@^`")
#: Orders of the shingles' hashes, one a band: they are hashed with these before the least is taken.
SEEDS = tuple(int.from_bytes(hashlib.sha256(bytes([i])).digest()[:7], "big") for i in range(BANDS))

#: Fixed texts: notices as they are commonly printed.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-3.0": "licensed under the GNU General Public License, version 3",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}


def words(text: Column) -> Column:
    """Lower-case words; the characters of MARKS separate words as blanks do."""
    odd = "\t\n\x0b\f\r" + "".join(MARKS)
    return F.filter(F.split(F.translate(F.lower(F.coalesce(text, F.lit(""))), odd, " " * len(odd)), " "), lambda w: w != "")


def shingles(word: Column) -> Column:
    """A hash for each five words in turn; for one to four words, one hash of them all."""
    many = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(word) - SHINGLE, F.lit(0))),
        lambda i: F.xxhash64(*(F.get(word, i + j) for j in range(SHINGLE))),
    )
    return F.when(F.size(word) > 0, many).otherwise(F.array().cast("array<bigint>"))


def window_of(shingles: int) -> int:
    """The length of the windows of a template with so many shingles."""
    return max(1, min(WINDOW, shingles // 5))


def bands(hashes: Column, window: int, step: int) -> Column:
    """The band values of all windows of a length, at every step-th shingle, the last one included; each hash is hashed once with each seed."""
    if window == 1:
        return hashes

    def of_seed(turned: Column) -> Column:
        last = F.greatest(F.size(turned) - window, F.lit(0))
        starts = F.array_append(F.sequence(F.lit(0), last, F.lit(step)), last)
        return F.transform(starts, lambda at: F.least(*(F.get(turned, at + i) for i in range(window))))

    again = lambda seed: lambda h: F.xxhash64(F.lit(seed), h)
    turned = F.array(*(F.transform(hashes, again(seed)) for seed in SEEDS))
    values = F.flatten(F.transform(turned, of_seed))
    return F.when(F.size(hashes) >= window, values).otherwise(F.array().cast("array<bigint>"))


def index(spark: SparkSession, templates: dict[str, str]) -> list[dict]:
    """Each template's distinct shingle hashes, window length and band values; templates are few and their size is checked."""
    if len(templates) > MAX_TEMPLATES or sum(len(t.split()) for t in templates.values()) > MAX_WORDS:
        raise ValueError(f"over {MAX_TEMPLATES} templates or {MAX_WORDS} words: give them in parts")
    rows = spark.createDataFrame(sorted(templates.items()), "name string, text string").coalesce(1)
    rows = rows.select("name", shingles(words(F.col("text"))).alias("hashes"))
    every = F.array(*(bands(F.col("hashes"), w, 1) for w in range(1, WINDOW + 1)))
    found = [(r.name, set(r.hashes), r.bands) for r in rows.select("name", "hashes", every.alias("bands")).collect()]
    return [{"name": n, "hashes": sorted(h), "window": window_of(len(h)), "bands": sorted(set(b[window_of(len(h)) - 1]))} for n, h, b in found if h]


def _is_in(values: list[int]):
    return lambda b: b.isin(values)


def _longs(values: list[int]) -> Column:
    return F.array(*(F.lit(v).cast("long") for v in values)).cast("array<bigint>")


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """docs with `matches`: array of (name, found, total) of each template of which `least` of the shingles occur in the text.

    found and total count distinct shingles. Order does not matter, nor does what
    stands between. Null and empty texts match nothing; repeated rows match alike;
    an empty table gives an empty result. A column named matches is replaced.
    """
    entries = index(docs.sparkSession, TEMPLATES if templates is None else templates)
    keep = [c for c in docs.columns if c.lower() != "matches"]
    kind = "array<struct<name:string,found:int,total:int>>"
    if not entries:
        return docs.select(*keep, F.array().cast(kind).alias("matches"))
    word, hashes, met = (own_name(docs.columns, x) for x in ("words", "hashes", "met"))
    rows = docs.select(*keep, words(F.col("text")).alias(word))
    rows = rows.select(*keep, shingles(F.col(word)).alias(hashes))
    retrieved = []
    for window in sorted({e["window"] for e in entries}):
        known = sorted({b for e in entries if e["window"] == window for b in e["bands"]})
        retrieved.append(F.filter(bands(F.col(hashes), window, 2), _is_in(known)))
    rows = rows.select(*keep, hashes, F.concat(*retrieved).alias(met))
    tried = []
    for e in entries:
        found = F.size(F.array_intersect(hashes, _longs(e["hashes"])))
        total = len(e["hashes"])
        near = F.arrays_overlap(met, _longs(e["bands"]))
        tried.append(F.when(near & (found >= least * total), F.struct(
            F.lit(e["name"]).alias("name"), found.alias("found"), F.lit(total).alias("total"))))
    matches = F.when(F.size(met) > 0, F.array_compact(F.array(*tried))).otherwise(F.array().cast(kind))
    return rows.select(*keep, matches.cast(kind).alias("matches"))
