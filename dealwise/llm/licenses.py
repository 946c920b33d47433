"""License scans: Dice coefficient over word bigrams, DataFrame functions only.

Units of a document are each of its lines and, if it has more than one, the whole
text.  A unit is normalised (lower case, words of letters, digits and dots inside
numbers) and compared to licence templates by the Dice coefficient
2 |A and B| / (|A| + |B|) of the sets of word bigrams.  Dice >= t needs
t / (2 - t) <= |A| / |B| <= (2 - t) / t, so a template is a candidate only for
units in its size bounds, and a unit outside all bounds is dropped before its
bigrams are made.

Passages are runs of words that cross lines or are part of one: every run of up to
``SPAN`` times a template's words that starts and ends with one of its bigrams is
compared, so trimming loses none.  Of the runs from one bigram the best counts.  See
:func:`license_passages`.

Null, empty and one-word units have no bigrams and match nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealwise.functions.once import evaluate_once

# Public licence notices and texts, as their owners publish them.
TEMPLATES = {
    "MIT-notice": "Licensed under the MIT License.",
    "MIT-released": "Released under the MIT License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0-line": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0-line": "Dedicated to the public domain under CC0 1.0.",
    "BSD-3-Clause-line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "ARR": "All rights reserved.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details. You should have received a copy of the GNU General Public "
        "License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    "AGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        "the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero "
        "General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    "LGPL-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version. This library is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Lesser General Public License for more details."),
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
        "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific "
        "prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND "
        "ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
        "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
        "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE."),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
        "versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. "
        "This notice may not be removed or altered from any source distribution."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize "
        "copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
        "software to the public domain. We make this dedication for the benefit of the public at large and to the "
        "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
        "perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "
        "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For "
        "more information, please refer to <https://unlicense.org>"),
}
THRESHOLD = 0.8
#: A passage has at most so many times the bigrams of its template's text.
SPAN = 2

#: A word after lower-casing; the same pattern reads in Java, Python and RE2.
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"


def template_bigrams(templates: dict[str, str]) -> dict[str, list[str]]:
    out = {}
    for name, body in templates.items():
        words = re.findall(WORD, body.lower())
        out[name] = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
    return out


def _words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), 0)


def license_matches(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per (document, unit, template) with Dice >= ``threshold``.

    Columns: the id, ``line`` (from 0; -1 for the whole text), ``license`` and
    ``dice``.  Rows that repeat give their matches again.  ``templates`` is a
    configuration of the caller and is sent with the plan.
    """
    grams = template_bigrams(templates or TEMPLATES)
    low = min(len(g) for g in grams.values()) * threshold / (2 - threshold)
    high = math.floor(max(len(g) for g in grams.values()) * (2 - threshold) / threshold + 1e-6)
    telling = sorted(set().union(*[anchors(g, needed(g, threshold)) for g in grams.values()]))
    table = F.array(*[F.struct(F.lit(n).alias("license"), F.lit(g).alias("grams")) for n, g in grams.items()])
    body = F.coalesce(F.col(text), F.lit(""))
    # no word crosses a line, so the words of the lines are those of the text
    rows = evaluate_once(df.select(F.col(doc_id).alias("id"), F.split(body, "\n", -1).alias("parts")), ws=F.transform("parts", _words))
    whole = F.when(F.size("ws") > 1, F.flatten("ws")).otherwise(F.array().cast("array<string>"))
    rows = rows.select("id", F.posexplode(F.concat(F.array(whole), F.col("ws"))).alias("pos", "w"))
    # a match has more words than the smallest template's lower bound and holds a telling word,
    # and no part of it has more bigrams than the greatest upper bound
    rows = rows.where((F.size("w") > low) & F.arrays_overlap("w", F.lit(telling)))
    rows = rows.where(F.when(F.size("w") > 4 * high, F.size(F.array_distinct(_bigrams(F.slice("w", 1, 2 * high)))) <= high)
                      .otherwise(True))
    pairs = F.array_distinct(_bigrams(F.col("w")))
    rows = rows.select("id", "pos", pairs.alias("grams")).withColumn("n", F.size("grams"))
    # the slack is for rounding at the bounds; the Dice below decides
    fits = F.filter(table, lambda t: (F.col("n") * (2 - threshold) >= F.size(t["grams"]) * threshold - 1e-6)
                    & (F.col("n") * threshold <= F.size(t["grams"]) * (2 - threshold) + 1e-6))
    found = rows.select("id", "pos", "n", "grams", F.explode(fits).alias("t"))
    dice = 2.0 * F.size(F.array_intersect("grams", "t.grams")) / (F.col("n") + F.size("t.grams"))
    return (found.select(F.col("id").alias(doc_id), (F.col("pos") - 1).cast("int").alias("line"),
                         F.col("t.license").alias("license"), dice.alias("dice"))
            .where(F.col("dice") >= threshold))


def needed(grams: list[str], threshold: float) -> int:
    """How many of the bigrams a text with a Dice of ``threshold`` holds at least."""
    return max(1, math.ceil(len(grams) * threshold / (2 - threshold) - 1e-9))


def anchors(grams: list[str], need: int) -> set[str]:
    """Words of which any text with ``need`` of the bigrams holds one; long words first."""
    left, out = set(grams), set()
    while len(left) >= need:
        n = Counter(w for g in left for w in set(g.split(" ")))
        best = max(n, key=lambda w: (len(w) > 5 or "." in w, n[w], w))
        out.add(best)
        left = {g for g in left if best not in g.split(" ")}
    return out


def _bigrams(w: Column) -> Column:
    return F.when(F.size(w) > 1, F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1),
                                            lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>"))


def license_passages(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per (document, template, passage) with Dice >= ``threshold``, where no unit does.

    Columns as in :func:`license_matches`; ``line`` is where the passage begins.  Of the
    runs from one bigram the one with the greatest Dice counts (then the shorter), and of
    those of a template that overlap the greatest stays (then the first).  A passage that
    touches a line that matches the template itself is left out, as is one inside a line
    that matches any template, and so are all of a text that matches as a whole.

    The work for a text grows with its words times the span of a template, however many
    passages it holds: a run's bigrams are counted on from the run shorter by one, and
    runs are compared with neighbours only.
    """
    templates = templates or TEMPLATES
    kinds, words = [], set()
    for name, grams in template_bigrams(templates).items():
        need = needed(grams, threshold)
        span = SPAN * (len(re.findall(WORD, templates[name].lower())) - 1)
        words |= anchors(grams, need)
        kinds.append(F.struct(F.lit(name).alias("license"), F.lit(grams).alias("grams"), F.lit(need).alias("need"),
                              F.lit(span).alias("span")))

    def dice(own: Column, other: Column) -> Column:
        return 2.0 * F.size(F.array_intersect(own, other)) / (F.size(own) + F.size(other))

    rows = evaluate_once(df.select(F.col(doc_id).alias("id"), F.split(text, "\n", -1).alias("parts")), ws=F.transform("parts", _words))
    rows = rows.where(F.exists("ws", lambda w: F.arrays_overlap(w, F.lit(sorted(words)))))
    rows = evaluate_once(rows.select("id", "ws"), g=_bigrams(F.flatten("ws")))
    every = sorted(set().union(*template_bigrams(templates).values()))
    rows = evaluate_once(rows, known=F.array_intersect("g", F.lit(every)))
    near = F.filter(F.array(*kinds), lambda t: F.size(F.array_intersect(F.col("known"), t["grams"])) >= t["need"])
    rows = evaluate_once(rows.where(F.size("known") > 0), near=near).where(F.size("near") > 0).drop("known")

    # templates that each line matches, the line of each word, and for each bigram (places
    # from 1) the place of the same one before it
    def names(line: Column) -> Column:
        own = F.array_distinct(_bigrams(line))
        return F.get(F.transform(F.array(own), lambda b: F.transform(
            F.filter(F.array(*kinds), lambda t: (F.size(b) * threshold <= F.size(t["grams"]) * (2 - threshold) + 1e-6)
                     & (dice(b, t["grams"]) >= threshold)), lambda t: t["license"])), F.lit(0))

    rows = evaluate_once(rows, units=F.transform("ws", names),
                         lines=F.flatten(F.transform("ws", lambda w, i: F.array_repeat(i, F.size(w)))),
                         sorted=F.sort_array(F.transform("g", lambda x, i: F.struct(x.alias("x"), (i + 1).alias("i")))))
    last = lambda k: F.get("sorted", k - 1)
    rows = evaluate_once(rows, before=F.sort_array(F.transform("sorted", lambda e, k: F.struct(
        e["i"].alias("i"), F.when(last(k)["x"] == e["x"], last(k)["i"]).otherwise(0).alias("last")))))
    rows = rows.select("id", "g", "units", "lines", "before", F.explode("near").alias("t"))
    rows = evaluate_once(rows, size=F.size("t.grams"), whole=dice(F.array_distinct("g"), F.col("t.grams")) >= threshold,
                         places=F.transform("before", lambda e: F.struct(
                             e["i"].alias("i"), e["last"].alias("last"),
                             F.array_contains("t.grams", F.get("g", e["i"] - 1)).alias("hit"))))
    rows = evaluate_once(rows.where(~F.col("whole")), h=F.transform(F.filter("places", lambda e: e["hit"]), lambda e: e["i"]))

    # the best run from every place whose run can hold enough of the template
    at = lambda k: F.get("h", k - 1)
    starts = F.when(F.size("h") >= F.col("t.need"), F.transform(F.filter(
        F.sequence(F.lit(1), F.size("h") - F.col("t.need") + 1), lambda p: at(p + F.col("t.need") - 1) - at(p) < F.col("t.span")), at))

    def longest(a: Column) -> Column:
        """The run from place ``a`` with the greatest Dice, as (dice, a, b)."""
        # the score of the run so far is taken up one step late; only a new bigram of the
        # template raises it, so the first place with the greatest score is one of its ends
        score = lambda z: 2.0 * z["hit"] / (z["own"] + F.col("size"))
        end = lambda z: F.when(score(z) > z["dice"], z["i"]).otherwise(z["b"])

        def grown(z: Column, e: Column) -> Column:
            fresh = e["last"] < a
            return F.struct(F.when(fresh, z["own"] + 1).otherwise(z["own"]).alias("own"),
                            F.when(fresh & e["hit"], z["hit"] + 1).otherwise(z["hit"]).alias("hit"), e["i"].alias("i"),
                            F.greatest(z["dice"], score(z)).alias("dice"), end(z).alias("b"))
        zero = F.struct(*[F.lit(0).alias(c) for c in ("own", "hit", "i")], F.lit(0.0).alias("dice"), F.lit(0).alias("b"))
        return F.aggregate(F.slice("places", a, F.col("t.span")), zero, grown, lambda z: F.struct(
            F.greatest(z["dice"], score(z)).alias("dice"), a.alias("a"), end(z).alias("b")))

    rows = evaluate_once(rows.drop("g", "before"), starts=starts).where(F.size("starts") > 0)
    rows = evaluate_once(rows, good=F.filter(F.transform("starts", longest), lambda r: r["dice"] >= threshold))
    rows = rows.drop("places", "h", "starts")

    # in rounds: a run that no better one overlaps stays, and what overlaps it goes
    meet = lambda r, s: (s["a"] <= r["b"] + 1) & (r["a"] <= s["b"] + 1)
    beats = lambda s, r: (s["dice"] > r["dice"]) | ((s["dice"] == r["dice"]) & (s["a"] < r["a"]))
    around = lambda runs, i: F.slice(runs, F.greatest(F.lit(1), i + 1 - F.col("t.span")), 2 * F.col("t.span") + 1)
    run = lambda r: [r[c].alias(c) for c in ("dice", "a", "b")]

    def settled(z: Column) -> Column:
        rest = z["rest"]
        marked = F.transform(rest, lambda r, i: F.struct(*run(r), (~F.exists(
            around(rest, i), lambda s: beats(s, r) & meet(r, s))).alias("stays")))
        return F.get(F.transform(F.array(marked), lambda m: F.struct(
            F.transform(F.filter(m, lambda r, i: ~F.exists(around(m, i), lambda s: s["stays"] & meet(r, s))),
                        lambda r: F.struct(*run(r))).alias("rest"),
            F.concat(z["kept"], F.transform(F.filter(m, lambda r: r["stays"]), lambda r: F.struct(*run(r)))).alias("kept"))), F.lit(0))

    none = F.array().cast("array<struct<dice:double,a:int,b:int>>")
    best = F.aggregate(F.sequence(F.lit(1), F.size("good")), F.struct(F.col("good").alias("rest"), none.alias("kept")),
                       lambda z, _: F.when(F.size(z["rest"]) > 0, settled(z)).otherwise(z), lambda z: z["kept"])
    rows = rows.where(F.size("good") > 0).select("id", "units", "lines", "t", F.explode(best).alias("r"))
    rows = rows.select("*", F.get("lines", F.col("r.a") - 1).alias("line"), F.get("lines", F.col("r.b")).alias("until"))
    unit = F.exists(F.slice("units", F.col("line") + 1, F.col("until") - F.col("line") + 1),
                    lambda n: F.array_contains(n, F.col("t.license")))
    named = (F.col("line") == F.col("until")) & (F.size(F.get("units", F.col("line"))) > 0)
    return rows.where(~unit & ~named).select(F.col("id").alias(doc_id), F.col("line").cast("int").alias("line"),
                                             F.col("t.license").alias("license"), F.col("r.dice").alias("dice"))
