"""License scan with MinHash bands over text windows, in DataFrame functions only.

Each license template is cut into parts of up to 12 words; a part is its set of five-word
shingles.  Documents are read in overlapping windows, one width for short parts (5 or 6
words) and one for long ones (7 to 12), with strides that put every occurrence whole
into some window.  A window and a part with an equal MinHash band (one row each) retrieve the
part's license for the document.  Exact containment verifies it: a license is found when the
document holds at least 0.8 of the license's distinct shingles, wherever they stand, so words
that were put in, left out or changed cost only the shingles they touch.

``BANDS`` is set from the least Jaccard similarity of a window and a part inside it
(1 shingle of 4, 3 of 14): the chance that all bands of one such pair miss is below ``MISS``.
A document with 0.8 of a license's shingles holds 0.8 of those of at least one of its parts
(7 of 8, or all of 4 or fewer), which keeps the pair above that similarity; a changed word
touches only shingles next to each other, so they stand in one window.  Equal bands
need a common shingle, so documents that share no shingle with any template are left out
before windows are formed; this loses nothing.

Defined results: null or empty texts and templates under five words match nothing; rows
with a null id are never reported; rows that share an id count as one document; an empty
table gives no rows; other columns are ignored.  ``first_word`` is the number of the first word
of a shared shingle.  Templates are a bounded parameter (name, text), whole license texts or notices.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import BREAKS, let, starts, word_hashes

SHINGLE, SHARE, MISS = 5, 0.8, 1e-6
#: (most words of a part, words of a window)
CLASSES = ((6, 8), (12, 18))
BANDS = max(math.ceil(math.log(MISS) / math.log(1 - least / (width - SHINGLE + 1))) for (_, width), least in zip(CLASSES, (1, 3), strict=True))

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution. """
_BSD3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission. """
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, """
_ISC_NOTICE = "provided that the above copyright notice and this permission notice appear in all copies. "
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

# fixed values: license notices, then whole license texts
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("BSD-conditions", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                       "that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("Apache-2.0-notice", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to
in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("GPL-3.0-notice", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("MIT-text", _MIT),
    ("BSD-2-Clause-text", _BSD2 + _BSD_END),
    ("BSD-3-Clause-text", _BSD2 + _BSD3 + _BSD_END),
    ("ISC-text", _ISC + _ISC_NOTICE + _ISC_END),
    ("0BSD-text", _ISC.rstrip(", ") + ". " + _ISC_END),
)


def _shingles(h: Column) -> Column:
    return F.transform(starts(F.size(h), SHINGLE), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)]))


def _with_shingles(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, let(word_hashes(F.col("text")), _shingles).alias("s"))


def _bands(shingles: Column) -> Column:
    """(band, least hash) of a shingle set under each of the band's hash functions."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.struct(
        j.alias("band"), F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, j))).alias("low")))


def template_parts(templates=TEMPLATES) -> list[tuple[str, int, int, str]]:
    """(license, part, class, text) of each part; a last part under five words joins by overlapping."""
    out = []
    longest = CLASSES[-1][0]
    for name, text in templates:
        ws = [w for w in re.split("[ " + "".join("\\" + c for c in BREAKS) + "]+", text.lower()) if w]
        if len(ws) < SHINGLE:
            continue
        # parts overlap by four words so that each shingle of the template stands in exactly one part
        step = longest - SHINGLE + 1
        cuts = [ws[i: i + longest] for i in range(0, max(1, len(ws) - SHINGLE + 1), step)]
        for k, part in enumerate(cuts):
            out.append((name, k, next(c for c, (most, _) in enumerate(CLASSES) if len(part) <= most), " ".join(part)))
    return out


def scan_licenses(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, containment, n_shingles, first_word) of each license in each document."""
    spark = docs.sparkSession
    parts = spark.createDataFrame(template_parts(templates), "license string, part int, class int, text string")
    parts = _with_shingles(parts, "license", "part", "class").withColumn("s", F.array_distinct("s"))
    # templates are a bounded parameter, worked out once; how their few rows are joined is left to Spark, which sees their size
    known = parts.collect()
    parts = spark.createDataFrame(known, parts.schema)
    listed = sorted({x for r in known for x in r["s"]})
    kept = parts.select("license", "class", F.inline(_bands(F.col("s"))).alias("band", "low")).distinct()
    terms = parts.select("license", F.explode("s").alias("x")).distinct()
    sizes = terms.groupBy("license").agg(F.count("*").cast("int").alias("n_shingles"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id IS NOT NULL")
    near = _with_shingles(rows, "doc_id").filter(F.exists("s", lambda x: x.isin(listed)))

    def windows_of(s: Column, c: int, most: int, width: int) -> Column:
        first = F.sequence(F.lit(0), F.greatest(F.size(s) - 1, F.lit(0)), F.lit(width - most + 1))
        return F.transform(first, lambda i: F.struct(F.lit(c).alias("class"), F.slice(s, i + 1, F.lit(width - SHINGLE + 1)).alias("w")))

    def windows(s: Column) -> Column:
        both = F.concat(*[windows_of(s, c, *size) for c, size in enumerate(CLASSES)])
        return F.filter(both, lambda x: F.exists(x["w"], lambda y: y.isin(listed)))

    opened = near.select("doc_id", F.inline_outer(let(F.col("s"), windows)).alias("class", "w")).filter("w IS NOT NULL")
    banded = opened.select("doc_id", "class", F.inline(_bands(F.col("w"))).alias("band", "low"))
    retrieved = banded.join(kept, ["class", "band", "low"]).select("doc_id", "license").distinct()
    shared = near.select("doc_id", F.posexplode("s").alias("at", "x")).filter(F.col("x").isin(listed)).groupBy("doc_id", "x").agg(F.min("at").alias("at"))
    held = shared.join(terms, "x").groupBy("doc_id", "license").agg(F.count("*").alias("n"), F.min("at").alias("first_word"))
    return (held.join(sizes, "license").withColumn("containment", F.col("n") / F.col("n_shingles")).filter(F.col("containment") >= SHARE)
            .join(retrieved, ["doc_id", "license"], "left_semi")
            .select("doc_id", "license", "containment", "n_shingles", F.col("first_word").cast("long").alias("first_word")))


def sql(templates=TEMPLATES) -> str:
    """The same findings in DuckDB SQL, without retrieval: every template against every document that shares a shingle."""
    quoted = ", ".join("('" + name + "', '" + text.replace("'", "''") + "')" for name, text in templates)
    blank = "translate(lower(coalesce(text, '')), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || '" + BREAKS[5:].replace("'", "''") + f"', repeat(' ', {len(BREAKS)}))"
    words = f"list_filter(string_split({blank}, ' '), lambda w: w <> '')"
    runs = f"unnest(list_transform(generate_series(1, len(w) - {SHINGLE - 1}), lambda i: struct_pack(pos := i - 1, g := array_to_string(w[i:i + {SHINGLE - 1}], ' '))))"
    return f"""
WITH t(license, text) AS (VALUES {quoted}),
tg AS (SELECT DISTINCT license, x.g AS g FROM (SELECT license, {runs} AS x FROM (SELECT license, {words} AS w FROM t))),
sizes AS (SELECT license, CAST(count(*) AS INTEGER) AS n_shingles FROM tg GROUP BY 1),
dg AS (SELECT doc_id, x.g AS g, min(x.pos) AS pos FROM (SELECT doc_id, {runs} AS x FROM (SELECT doc_id, {words} AS w FROM documents WHERE doc_id IS NOT NULL)) GROUP BY 1, 2),
held AS (SELECT doc_id, license, count(*) AS n, CAST(min(pos) AS BIGINT) AS first_word FROM dg JOIN tg USING (g) GROUP BY 1, 2)
SELECT doc_id, license, CAST(n AS DOUBLE) / n_shingles AS containment, n_shingles, first_word
FROM held JOIN sizes USING (license) WHERE CAST(n AS DOUBLE) / n_shingles >= {SHARE}
"""
