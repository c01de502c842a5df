"""Licence notices: MinHash bands over overlapping windows, then exact containment.

Spark functions only. A window and a template that share a band's minwise
shingle make a candidate; a candidate counts if the words around its window
hold enough of the template's own shingles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Short notices by which texts name their licence.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "Released under CC0 1.0 Universal.",
}

# The words by which files and their headers grant a licence.
_SOFTWARE_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
    "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
    "OR OTHER DEALINGS IN THE SOFTWARE."
)
_REDISTRIBUTIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
    "other materials provided with the distribution."
)
_HOLDERS_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE."
)
TEXTS = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including '
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: The above copyright notice and this permission notice shall be included in all copies "
    f"or substantial portions of the Software. {_SOFTWARE_AS_IS}",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
    "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause": f"{_REDISTRIBUTIONS} {_HOLDERS_AS_IS}",
    "BSD-3-Clause": f"{_REDISTRIBUTIONS} 3. Neither the name of the copyright holder nor the names of its "
    "contributors may be used to endorse or promote products derived from this software without specific prior "
    f"written permission. {_HOLDERS_AS_IS}",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
    "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
    "binary, for any purpose, commercial or non-commercial, and by any means.",
}
_ANY_LATER = (
    "This {thing} is free software{colon} you can redistribute it and/or modify it under the terms of the {name} "
    "as published by the Free Software Foundation; either version {version} of the License, or (at your option) any "
    "later version. This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
    "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for "
    "more details."
)
_GPL, _LGPL = "GNU General Public License", "GNU Lesser General Public License"
HEADERS = {
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
    "in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
    'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
    "KIND, either express or implied. See the License for the specific language governing permissions and "
    "limitations under the License.",
    "GPL-2.0": _ANY_LATER.format(thing="program", colon=";", name=_GPL, version="2"),
    "GPL-3.0": _ANY_LATER.format(thing="program", colon=":", name=_GPL, version="3"),
    "LGPL-2.1": _ANY_LATER.format(thing="library", colon=";", name=_LGPL, version="2.1"),
    "LGPL-3.0": _ANY_LATER.format(thing="library", colon=":", name=_LGPL, version="3"),
    "AGPL-3.0": _ANY_LATER.format(thing="program", colon=":", name="GNU Affero General Public License", version="3"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
    "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}
SPDX = (
    "Apache-2.0", "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
    "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "MPL-2.0", "CC-BY-4.0",
    "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "Unlicense",
)


@dataclass(frozen=True)
class Bands:
    """Windows of ``window`` words every ``stride`` words, in ``bands`` bands of one minwise shingle.

    A window that holds a whole template of t shingles among its w shares no
    band with it with the probability (1 - t / w) ** bands: 0.007 for an SPDX
    line of two shingles among fourteen, and one window in two holds it twice,
    0.0005 for the shortest notice of three. A template longer than a window is
    cut by them into parts. One that lies in it whole and holds the template's
    smallest shingle of a band shares that band, so a verbatim copy of 24 words
    or more always has such a window, unless all its smallest lie at its ends.
    """

    shingle: int = 3
    window: int = 16
    stride: int = 8
    bands: int = 32
    percent: int = 80


def templates(spark: SparkSession) -> DataFrame:
    """``license_id``, ``form`` and ``text`` of all that is above."""
    rows = [
        (name, form, text)
        for form, texts in (("notice", NOTICES), ("header", HEADERS), ("text", TEXTS))
        for name, text in texts.items()
    ]
    rows += [(name, "spdx", f"SPDX-License-Identifier: {name}") for name in SPDX]
    return spark.createDataFrame(rows, "license_id string, form string, text string")


def _words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    spaced = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def _shingles(words: Column, n: int) -> Column:
    """The sequences of ``n`` neighbouring words, as text."""
    starts = F.sequence(F.lit(1), F.size(words) - n + 1)
    joined = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) >= n, joined).otherwise(F.array().cast("array<string>"))


def _computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once for each row.

    As the output of a generator it is not moved into the expressions that use
    it, where it would be computed for each element again.
    """
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def _hashed(df: DataFrame, n: int) -> DataFrame:
    """``df`` with ``hashes``, those of the shingles of its ``words``."""
    single = _computed(df, "single", F.transform("words", lambda w: F.xxhash64(w)))
    starts = F.sequence(F.lit(0), F.size("single") - n)
    of = F.transform(
        starts, lambda i: F.xxhash64(*(F.get(F.col("single"), i + k) for k in range(n)))
    )
    some = F.when(F.size("single") >= n, of).otherwise(F.array().cast("array<bigint>"))
    return _computed(single, "hashes", some).drop("single")


def _minima(hashes: Column, bands: int) -> Column:
    """The smallest shingle hash under each band's function."""

    def under(j: int) -> Column:
        return F.array_min(F.transform(hashes, lambda x: F.xxhash64(x, F.lit(j))))

    return F.array(*(under(j) for j in range(bands)))


def licences(
    docs: DataFrame,
    notices: DataFrame | None = None,
    how: Bands = Bands(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs`` and notice found in it: ``doc_id``, ``license_id``, ``form``, and

    ``start`` (the first window's first word), ``matched`` and ``of`` (distinct
    shingles of the notice that are found, and that it has). ``notices`` have
    ``license_id``, ``text`` and, if there are several for a licence, ``form``.

    Whole texts are searched. A window can share a band only if it holds a
    shingle that is some notice's smallest in that band, so texts without any of
    these have no candidates and are cut into no windows. The notices are small:
    they come to the driver and go out as literals, so that a window is compared
    in the task that has its text, and only what is found is shuffled.

    Of notices found around one window, those count whose found share is largest.
    Words are runs of letters and digits without regard to case. A notice of
    fewer words than a shingle is never found, nor is a null or empty text. Rows
    without an id are found too; rows that repeat an id count as one, with their
    best match. Other columns are not read.
    """
    spark = docs.sparkSession
    notices = templates(spark) if notices is None else notices
    if "form" not in notices.columns:
        notices = notices.withColumn("form", F.lit("notice"))
    noted = _computed(notices.select("license_id", "form", "text"), "words", _words(F.col("text")))
    known = (
        _hashed(noted, how.shingle)
        .withColumn("own", F.array_distinct(_shingles(F.col("words"), how.shingle)))
        .where(F.size("own") > 0)
        .select("license_id", "form", "own", F.size("words").alias("length"), "hashes")
    )
    known = _computed(known, "minima", _minima(F.col("hashes"), how.bands))
    told = known.select("license_id", "form", "own", "length", "minima").collect()
    if not told:
        return docs.where(F.lit(False)).select(
            F.col(key).alias("doc_id"), F.lit("").alias("license_id"), F.lit("").alias("form"),
            *(F.lit(0).alias(c) for c in ("start", "matched", "of")),
        )
    smallest = _smallest(known, how.bands)
    telling = F.array(*(F.lit(x) for x in smallest))
    reach = max(r.length for r in told)

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    hashed = _hashed(_computed(rows, "words", _words(F.col("text"))).drop("text"), how.shingle)
    likely = hashed.where(F.arrays_overlap("hashes", telling))
    span = how.window - how.shingle + 1
    last = F.greatest(F.size("hashes") - span, F.lit(0))
    starts = F.array_distinct(
        F.concat(F.sequence(F.lit(0), last, F.lit(how.stride)), F.array(last))
    )
    # Only windows that may share a band get the words around them.
    starts = F.filter(
        starts, lambda s: F.arrays_overlap(F.slice("hashes", s + 1, F.lit(span)), telling)
    )
    windows = F.transform(
        starts,
        lambda s: F.struct(
            s.alias("start"),
            F.slice("hashes", s + 1, F.lit(span)).alias("hashes"),
            F.slice(
                "words",
                F.greatest(s + 1 - reach, F.lit(1)),
                F.lit(how.window + reach) + F.least(s, F.lit(reach)),
            ).alias("around"),
        ),
    )
    cut = likely.select("doc_id", F.inline(windows))
    cut = _computed(cut, "minima", _minima(F.col("hashes"), how.bands))
    # The notices a window shares a band with, and how much of each lies around it: all in the row's own task.
    banded = F.array(
        *(F.struct(F.lit(i).alias("notice"), F.array(*map(F.lit, r.minima)).alias("minima")) for i, r in enumerate(told))
    )
    alike = F.filter(
        banded,
        lambda t: F.exists(F.zip_with(t["minima"], F.col("minima"), lambda x, y: x == y), lambda same: same),
    )
    cut = _computed(cut, "notices", F.transform(alike, lambda t: t["notice"])).where(F.size("notices") > 0)
    cut = _computed(cut, "near", _shingles(F.col("around"), how.shingle))
    numbered = spark.createDataFrame(
        [(i, r.license_id, r.form, r.own) for i, r in enumerate(told)],
        "notice int, license_id string, form string, own array<string>",
    )
    found = cut.select("doc_id", "start", "near", F.explode("notices").alias("notice")).join(
        F.broadcast(numbered), "notice"  # the notices are literals of the plan already
    )
    common = F.size(F.array_intersect("own", "near"))
    matched = found.select(
        "doc_id", "license_id", "form", "start", common.alias("matched"), F.size("own").alias("of")
    ).where(F.col("matched") * 100 >= F.col("of") * how.percent)
    # Where a notice resembles another one, the one that is there in a larger part counts.
    share = F.col("matched") / F.col("of")
    beside = Window.partitionBy("doc_id", "start")
    matched = matched.withColumn("most", F.max(share).over(beside)).where(share == F.col("most"))
    best = F.max(F.struct("matched", (-F.col("start")).alias("back"), "of")).alias("best")
    return matched.groupBy("doc_id", "license_id", "form").agg(best).select(
        "doc_id",
        "license_id",
        "form",
        (-F.col("best.back")).alias("start"),
        F.col("best.matched").alias("matched"),
        F.col("best.of").alias("of"),
    )


def _smallest(known: DataFrame, bands: int) -> list[int]:
    """Hashes of the shingles that are some notice's smallest in some band."""
    each = known.select("minima", F.explode("hashes").alias("hash"))
    own = F.array(*(F.xxhash64(F.col("hash"), F.lit(j)) for j in range(bands)))
    rows = each.where(F.arrays_overlap(own, "minima")).select("hash").distinct().collect()
    return sorted(r.hash for r in rows)
