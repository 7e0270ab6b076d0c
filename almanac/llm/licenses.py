"""License scans by MinHash bands over overlapping text windows, in DataFrame functions only.

Templates of n word shingles belong to the size class S, the least power of two with S >= n;
the windows of a class have 2 S shingles and begin at every S-th, so each run of n shingles
lies whole in a window. Such a window that holds at least the share CONTAINED of a template
has a Jaccard similarity of over CONTAINED / 2 / (2 + (1 - CONTAINED) / 2) with it (n > S / 2),
and BANDS bands of one row miss it with a probability of at most (1 - s) ** BANDS. Retrieved
pairs are verified by exact shingle containment.

A window and a template can only agree in a band if the shingle with the template's least
hash is in the window. So only windows around such shingles are built; this leaves out no
pair that any band would retrieve. The gate is a hash table in two literals: a shingle's low
bits address a byte, which sends nearly all others away, then a bucket of whole hashes.

Notices of fewer than SHINGLE words are one shingle of their own length and are compared exactly.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality import let

SHINGLE, CONTAINED, BANDS = 5, 0.8, 32
#: Templates up to which their band table is broadcast (BANDS rows of about 50 bytes each).
BROADCAST_TEMPLATES = 10_000
#: Bytes of the gate's first table for each of its shingles.
GATE_CELLS = 16
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Notices, grants and (-text) whole texts of public licenses, by name.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0-header", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mit", "Released under the MIT License"),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("0bsd-text", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd-2-clause-text", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("bsl-1.0-text", """Boost Software License - Version 1.0 - August 17th, 2003
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc-text", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("mit-text", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("unlicense-text", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("zlib-text", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
]

#: Notices of fewer than SHINGLE words, by name.
NOTICES = [
    ("all-rights-reserved", "All rights reserved"),
    ("isc-spdx", "SPDX-License-Identifier: ISC"),
    ("mit-spdx", "SPDX-License-Identifier: MIT"),
    ("unlicense-spdx", "SPDX-License-Identifier: Unlicense"),
]


def miss_bound(contained: float = CONTAINED, bands: int = BANDS) -> float:
    """The most likely it gets that no band retrieves a window that holds this share of a template."""
    s = contained / 2 / (2 + (1 - contained) / 2)
    return (1 - s) ** bands


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SEPARATORS), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """Hashes of all runs of SHINGLE words."""
    return let(words, lambda w: F.when(F.size(w) < SHINGLE, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)), lambda i: F.xxhash64(F.slice(w, i, F.lit(SHINGLE))))))


def band_keys(shingles: Column, bands: int) -> Column:
    """One key a band: the band's number hashed with the least of the shingles' hashes under its function."""
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda j: F.xxhash64(j, F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, j)))))


def gate(entries: dict[int, set[int]]) -> Callable[[Column], Column]:
    """A function from a shingle's hash to the bits of the size classes that it is gated for, NULL for any other shingle."""
    n = max(16, 1 << (len(entries) - 1).bit_length()) if entries else 16
    few, buckets = bytearray(n * GATE_CELLS), [[] for _ in range(n)]
    for x in sorted(entries):
        few[x & (len(few) - 1)] = 1
        buckets[x & (n - 1)].append((x, sum(1 << k for k in entries[x])))
    deep = max(map(len, buckets))
    slots = [y for x in buckets for y in [*x, *[(None, None)] * (deep - len(x))]]
    keys, masks = (F.from_json(F.lit(json.dumps([y[k] for y in slots])), kind) for k, kind in ((0, "array<bigint>"), (1, "array<int>")))
    first = F.lit(bytes(few))

    def of(h: Column) -> Column:
        at = h.bitwiseAND(F.lit(n - 1)).cast("int") * deep
        found = F.coalesce(*(F.when(F.get(keys, at + j) == h, F.get(masks, at + j)) for j in range(deep)))
        return F.when(F.substring(first, h.bitwiseAND(F.lit(len(few) - 1)).cast("int") + 1, F.lit(1)) == F.lit(b"\x01"), found)

    return of


def _table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(n).alias("license_id"), F.lit(t).alias("template")) for n, t in templates))
    return spark.range(1).select(F.inline(rows)).withColumn("set", F.array_distinct(shingles_of(words_of(F.col("template")))))


def short_notices(docs: DataFrame, notices: list[tuple[str, str]] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``scan`` for notices of fewer than SHINGLE words, each found wherever its words follow one another.

    As for a template of one shingle, windows have two and begin at every word. A notice without
    words, or of SHINGLE or more, is refused.
    """
    spark = docs.sparkSession
    if not notices:
        return spark.createDataFrame([], "doc_id {}, license_id string, containment double, first_word long, n_windows long".format(docs.schema[id_col].dataType.simpleString()))
    rows = F.array(*(F.struct(F.lit(n).alias("license_id"), F.lit(t).alias("notice")) for n, t in notices))
    known = {r.license_id: r.words for r in spark.range(1).select(F.inline(rows)).select("license_id", words_of(F.col("notice")).alias("words")).collect()}
    if wrong := [n for n, w in known.items() if not 0 < len(w) < SHINGLE]:
        raise ValueError(f"notices without words or of {SHINGLE} words or more: {wrong}")

    def places(words: Column, name: str, notice: list[str]) -> Column:
        own = F.array(*map(F.lit, notice))
        at = F.filter(F.transform(words, lambda w, i: F.when((w == notice[0]) & (F.slice(words, i + 1, len(notice)) == own), i)), lambda i: i.isNotNull())
        return F.struct(F.lit(name).alias("license_id"), at.alias("at"))

    text = F.col(text_col).cast("string")
    may = F.lit(False)
    for notice in known.values():
        may = may | F.lower(text).contains(max(notice, key=len))
    some = docs.where(may).select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), words_of(text).alias("words"))
    found = some.select("doc_id", "text_key", F.inline(let(F.col("words"), lambda w: F.array(*(places(w, n, x) for n, x in known.items()))))).where(F.size("at") > 0)
    begins = F.array_distinct(F.flatten(F.transform("at", lambda p: F.array(p, F.greatest(p - 1, F.lit(0))))))
    out = found.select("doc_id", "text_key", "license_id", F.lit(1.0).alias("containment"), F.get("at", 0).cast("long").alias("first_word"), F.size(begins).cast("long").alias("n_windows"))
    return out.dropDuplicates(["doc_id", "text_key", "license_id"]).drop("text_key")


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, contained: float = CONTAINED, bands: int = BANDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license_id, containment, first_word, n_windows): every template of which a window of the text holds the share.

    A null or short text matches nothing; a null id stays null. Rows that repeat an id and text
    are one document. Of windows that tie the first gives first_word. A very long text is one row
    of work, and only its windows around gated shingles are built. An empty table or list of templates gives no rows; other columns are
    dropped. Templates of fewer than SHINGLE words are refused.
    """
    spark = docs.sparkSession
    out = "doc_id {}, license_id string, containment double, first_word long, n_windows long".format(docs.schema[id_col].dataType.simpleString())
    if not templates:
        return spark.createDataFrame([], out)
    table = _table(spark, templates)
    least = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda j: F.array_min(F.transform("set", lambda x: F.struct(F.xxhash64(x, j).alias("m"), x.alias("x"))))["x"])
    known = table.select("license_id", F.size("set").alias("n"), F.array_distinct(least).alias("least")).collect()
    if short := [r.license_id for r in known if not r.n]:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
    size_of = {r.license_id: 1 << (r.n - 1).bit_length() for r in known}
    sizes = sorted(set(size_of.values()))
    gated = gate({x: {sizes.index(size_of[r.license_id]) for r in known if x in r.least} for x in {x for r in known for x in r.least}})

    text = F.col(text_col).cast("string")
    hashed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), words_of(text).alias("words")).withColumn("sh", shingles_of(F.col("words")))
    at = let(F.col("sh"), lambda sh: F.filter(F.transform(sh, lambda h, i: F.struct(i.alias("pos"), gated(h).alias("of"))), lambda x: x["of"].isNotNull()))
    held = hashed.withColumn("at", at).where(F.size("at") > 0)

    def begins(k: int, size: int) -> Column:
        """Begins of the windows of one class that hold a shingle gated for it."""
        own = F.filter("at", lambda x: x["of"].bitwiseAND(F.lit(1 << k)) != 0)
        of = F.flatten(F.transform(own, lambda x: F.array(F.floor(x["pos"] / size).cast("int"), F.greatest(F.floor(x["pos"] / size).cast("int") - 1, F.lit(0)))))
        return F.transform(F.array_distinct(of), lambda w: F.struct(F.lit(size).alias("size"), (w * size).alias("begin")))

    each = held.select("doc_id", "text_key", "words", "sh", F.inline(F.flatten(F.array(*(begins(k, x) for k, x in enumerate(sizes))))))
    windows = each.select("doc_id", "text_key", "size", "begin", F.slice("sh", F.col("begin") + 1, 2 * F.col("size")).alias("sh"), F.slice("words", F.col("begin") + 1, 2 * F.col("size") + (SHINGLE - 1)).alias("words"))
    keyed = windows.select("doc_id", "text_key", "size", "begin", "words", F.explode(F.array_distinct(band_keys(F.col("sh"), bands))).alias("key"))

    class_of = F.create_map(*(F.lit(x) for pair in size_of.items() for x in pair))
    exact = let(words_of(F.col("template")), lambda w: F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)), lambda i: F.array_join(F.slice(w, i, F.lit(SHINGLE)), " "))))
    banded = table.select("license_id", class_of[F.col("license_id")].alias("size"), exact.alias("exact"), F.explode(F.array_distinct(band_keys(F.col("set"), bands))).alias("key"))
    if len(templates) <= BROADCAST_TEMPLATES:
        banded = F.broadcast(banded)
    pairs = keyed.join(banded, ["size", "key"]).groupBy("doc_id", "text_key", "size", "begin", "license_id").agg(F.first("words").alias("words"), F.first("exact").alias("exact"))
    own = let(F.col("words"), lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)), lambda i: F.array_join(F.slice(w, i, F.lit(SHINGLE)), " ")))
    # an intersection keeps the window's order, so its first shingle is the first that is held; both are found through hash sets
    common = pairs.withColumn("own", own).withColumn("common", F.array_intersect("own", "exact")).withColumn("share", F.size("common") / F.size("exact")).where(F.col("share") >= contained)
    judged = common.select("doc_id", "text_key", "license_id", "begin", "share", (F.array_position("own", F.get("common", 0)) - 1).alias("at"))
    return judged.groupBy("doc_id", "text_key", "license_id").agg(F.max("share").alias("containment"), F.min(F.col("begin") + F.col("at")).cast("long").alias("first_word"), F.count("*").alias("n_windows")).drop("text_key")
