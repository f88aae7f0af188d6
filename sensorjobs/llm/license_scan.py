"""License scans: MinHash bands over overlapping text windows, then exact containment, in DataFrame functions only.

Words are runs of letters and digits, lower case; shingles are five words. For every template length
(rounded up to a ladder of lengths) a text is cut into windows a quarter longer than the template,
a quarter apart, so a copy lies whole in some window. A window and a template that it contains to
0.8 have a Jaccard similarity of at least about 0.5; ``bands`` bands of one minimum each then collide
with probability ``1 - 0.5 ** bands`` (0.99998 at 16). Collisions are verified by the exact share of
the template's shingles that the window, and a quarter window on both sides, contains.

Only windows with at least one shingle of a template are hashed; the others contain nothing of any
template. The set of template shingles is written into the plan while it is small (``most_shingles``);
beyond that every window is hashed and the joins do the rest.

Defined results
---------------
* null and empty texts match nothing; whole texts are scanned; templates of fewer than five words
  are one shingle of all their words and match windows of that many words;
* a document that holds a template several times has one row for it: the best containment, and the
  first window of that containment; rows with the same id count as one document;
* empty documents or templates: empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs.llm.common import materialize

WIDTH = 5

#: Notices, openings and whole texts of public licenses, as their publishers word them.
TEMPLATES = (
    ("mit-notice", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("bsd-2-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("zlib-text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("unlicense-text", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."),
)


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def shingles(w: str) -> Column:
    """Hashes of the five-word shingles of the array column ``w``; of all words if they are fewer."""
    n = F.size(w)
    many = F.transform(F.sequence(F.lit(0), F.greatest(n - WIDTH, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WIDTH)]))
    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(many)


def step(c: Column) -> Column:
    """A quarter of a class's words."""
    return F.greatest(F.lit(1), F.floor(c / 4)).cast("int")


def signature(window: Column, bands: int) -> Column:
    """The bands of a window: (band, least hash)."""
    return F.array(*[F.struct(F.lit(b).alias("band"), F.array_min(F.transform(window, lambda x: F.xxhash64(x, F.lit(b)))).alias("least")) for b in range(bands)])  # noqa: B023


def prepare(templates: DataFrame, bands: int, ladder: float = 1.15) -> DataFrame:
    """(``license``, ``t``: shingles, ``c``: length class in words, ``keys``) of the templates with words."""
    rows = templates.select("license", words(F.col("text")).alias("w")).filter(F.size("w") > 0).withColumn("t", F.array_distinct(shingles("w")))
    n = F.greatest(F.size("w"), F.lit(WIDTH))
    c = F.ceil(F.pow(F.lit(ladder), F.ceil(F.log(n / WIDTH) / F.log(F.lit(ladder)) - 1e-9)) * WIDTH - 1e-9).cast("int")
    return rows.select("license", "t", c.alias("c")).withColumn("keys", signature(F.col("t"), bands))


def scan(docs: DataFrame, templates: DataFrame, id_column: str = "doc_id", text: str = "text", least: float = 0.8, bands: int = 16, most_shingles: int = 20_000) -> DataFrame:
    """(``doc_id``, ``license``, ``containment``, ``first_word``) of every template that a document contains."""
    known = materialize(prepare(templates, bands), "license-templates")
    listed = [r[0] for r in known.select(F.explode("t").alias("x")).distinct().limit(most_shingles + 1).collect()]
    # The ladder has few steps, so each document meets few classes, however many templates there are.
    classes = sorted(r[0] for r in known.select("c").distinct().collect())
    # once() keeps the optimizer from copying the array's expression into each place that reads it.
    once = lambda c: F.explode(F.array(c))
    texts = docs.select(F.col(f"`{id_column}`").alias("doc_id"), once(words(F.col(f"`{text}`"))).alias("w"))
    rows = texts.select("doc_id", once(shingles("w")).alias("s")).filter(F.size("s") > 0)
    if len(listed) <= most_shingles:
        if not listed:
            return rows.filter(F.lit(False)).select("doc_id", F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).cast("long").alias("first_word"))
        hits = F.filter(F.transform("s", lambda x, i: F.when(x.isin(listed), i)), lambda i: i.isNotNull())
        rows = rows.withColumn("hits", once(hits)).filter(F.size("hits") > 0)
    rows = rows.withColumn("c", F.explode(F.array(*[F.lit(c) for c in classes]))).withColumn("q", step(F.col("c")))
    last = F.floor((F.size("s") - 1) / F.col("q"))
    span = F.col("c") - WIDTH + 1 + F.col("q")  # shingles of a window
    if len(listed) <= most_shingles:
        reach = lambda i: F.sequence(F.greatest(F.lit(0), F.floor((i - span) / F.col("q")) + 1), F.least(last, F.floor(i / F.col("q"))))
        numbers = F.array_distinct(F.flatten(F.transform("hits", reach)))
    else:
        numbers = F.sequence(F.lit(0).cast("bigint"), last)
    windows = rows.select("doc_id", "c", "q", "s", F.explode(numbers).alias("k")).withColumn("start", (F.col("k") * F.col("q")).cast("int"))
    windows = windows.withColumn("window", once(F.slice("s", F.col("start") + 1, span.cast("int"))))
    region = F.slice("s", F.greatest(F.lit(1), F.col("start") + 1 - F.col("q")), (span + 2 * F.col("q")).cast("int"))
    keyed = windows.select("doc_id", "c", "start", region.alias("region"), F.explode(signature(F.col("window"), bands)).alias("key"))
    wanted = known.select("license", "t", "c", F.explode("keys").alias("key"))
    met = keyed.join(wanted, ["c", "key"]).withColumn("containment", F.size(F.array_intersect("t", "region")) / F.size("t"))
    best = met.filter(F.col("containment") >= least).groupBy("doc_id", "license").agg(F.max(F.struct("containment", (-F.col("start")).alias("back"))).alias("b"))
    return best.select("doc_id", "license", F.col("b.containment").alias("containment"), (-F.col("b.back")).cast("long").alias("first_word"))


def template_table(spark: SparkSession) -> DataFrame:
    """The templates above as (``license``, ``text``)."""
    return spark.createDataFrame(list(TEMPLATES), "license string, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: every license template in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scan(docs, template_table(spark))
