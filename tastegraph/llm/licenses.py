"""Operator 4: licence scans.

Lines and whole texts are normalised (A-Z lower-cased, everything but letters
and digits of ASCII to single spaces) and compared with licence notices by
the Dice coefficient of their sets of word bigrams.  A set of n bigrams can
only reach coefficient t with one of m if n lies between t / (2 - t) * m and
(2 - t) / t * m, which rules out nearly all lines before any bigram is
built.  DataFrame functions only; nothing is shuffled but the matches.

Besides, windows of words over the whole text, whatever its line breaks, are
compared with the notices and with licence bodies and standard headers.  A
window that reaches t shares t / (2 - t) * m bigrams with a template of m at
least, so texts and starts with fewer are left out unseen.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licence notices by SPDX identifier.
NOTICES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright to the public domain."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("reserved", "All rights reserved."),
)
#: Bodies, standard headers and opening paragraphs, compared in windows only.
BODIES = (
    ("AGPL-3.0",
     'This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License '
     'as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program'
     ' is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY'
     ' or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.'),
    ("AGPL-3.0",
     'GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is '
     'permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.'),
    ("Apache-2.0",
     'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
     'You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to '
     'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
     'KIND, either express or implied. See the License for the specific language governing permissions and limitations under the '
     'License.'),
    ("Apache-2.0",
     'Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND '
     'DISTRIBUTION'),
    ("BSD-2-Clause",
     'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following '
     'conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the '
     'following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the'
     ' following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE'
     ' COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED '
     'WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR '
     'CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT '
     'LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED '
     'AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY '
     'WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("BSD-3-Clause",
     'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following '
     'conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the '
     'following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the'
     ' following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the '
     'copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without '
     'specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
     'IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE '
     'ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, '
     'EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, '
     'DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, '
     'OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY'
     ' OF SUCH DAMAGE.'),
    ("BSL-1.0",
     'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying '
     'documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software,'
     ' and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so'),
    ("GPL-2.0",
     'This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as '
     'published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is'
     ' distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or'
     ' FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.'),
    ("GPL-2.0",
     'GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. 51 Franklin Street, Fifth '
     'Floor, Boston, MA 02110-1301 USA Everyone is permitted to copy and distribute verbatim copies of this license document, but '
     'changing it is not allowed.'),
    ("GPL-3.0",
     'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as '
     'published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is'
     ' distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or'
     ' FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.'),
    ("GPL-3.0",
     'GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy'
     ' and distribute verbatim copies of this license document, but changing it is not allowed.'),
    ("ISC",
     'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided '
     'that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR '
     'DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT'
     ' SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM '
     'LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN '
     'CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("LGPL-3.0",
     'This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License '
     'as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This library'
     ' is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY'
     ' or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.'),
    ("LGPL-3.0",
     'GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted '
     'to copy and distribute verbatim copies of this license document, but changing it is not allowed.'),
    ("MIT",
     'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files '
     '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
     'merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is '
     'furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included '
     'in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
     'IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN '
     'NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF '
     'CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("MPL-2.0",
     'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with'
     ' this file, You can obtain one at https://mozilla.org/MPL/2.0/.'),
    ("Unlicense",
     'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, '
     'sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-'
     'commercial, and by any means.'),
    ("Zlib",
     "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
     'damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including '
     'commercial applications, and to alter it and redistribute it freely, subject to the following restrictions'),
)
LEAST = 0.8


def bigrams_of(notice: str) -> list[str]:
    words = re.sub(r"[^a-z0-9]+", " ", notice.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_bounds(m: int, least: float) -> tuple[float, float]:
    """Set sizes that can reach the coefficient with a set of ``m``."""
    return m * least / (2 - least), m * (2 - least) / least


def normalised(text: Column) -> Column:
    folded = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " "))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def windows(seq: Column, templates: list[tuple[str, list[str]]], least: float) -> Column:
    """For the bigrams ``seq`` of a text in order: array of (dice, license,
    first, last), the best window from each word where one may reach ``least``.

    Windows start and end with a bigram of the template, as others are no
    better, and have at most the upper bound of its set sizes in bigrams."""
    every = sorted({g for _, grams in templates for g in grams})
    known = F.array(*(F.struct(F.lit(name).alias("license"), F.split(F.lit("|".join(grams)), r"\|").alias("grams"), F.lit(len(grams)).alias("m"),
                               F.lit(math.ceil(size_bounds(len(grams), least)[0] - 1e-9)).alias("need"),
                               F.lit(math.floor(size_bounds(len(grams), least)[1] + 1e-9)).alias("most")) for name, grams in templates))
    common = F.array_intersect(seq, F.split(F.lit("|".join(every)), r"\|"))
    fitting = _let(common, lambda c: F.filter(known, lambda t: (F.size(c) >= t["need"]) & (F.size(F.array_intersect(t["grams"], c)) >= t["need"])))
    count, start = F.lit(0), F.lit(0.0)

    def best(g: Column, t: Column) -> Column:
        def step(a: Column, f: Column) -> Column:
            n, c, size = a["n"] + F.when(f > 0, 1).otherwise(0), a["c"] + F.when(f == 2, 1).otherwise(0), a["size"] + 1
            dice = 2 * c / (n + t["m"])
            better = (f == 2) & (dice > a["dice"])
            return F.struct(n.alias("n"), c.alias("c"), size.alias("size"), F.when(better, dice).otherwise(a["dice"]).alias("dice"),
                            F.when(better, size).otherwise(a["length"]).alias("length"))

        # 0 for a bigram that was there before, 2 for one of the template
        flags = F.transform(g, lambda x, k: F.when(F.array_position(g, x) != k + 1, 0).when(F.array_contains(t["grams"], x), 2).otherwise(1))
        none = F.struct(count.alias("n"), count.alias("c"), count.alias("size"), start.alias("dice"), count.alias("length"))
        return F.aggregate(flags, none, step)

    def of(t: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(seq) - 1), lambda p: F.array_contains(t["grams"], F.get(seq, p)))
        starts = _let(at, lambda a: F.filter(a, lambda p, k: F.get(a, k + t["need"] - 1) < p + t["most"]))
        return F.transform(starts, lambda p: _let(_let(F.slice(seq, p + 1, t["most"]), lambda g: best(g, t)), lambda b: F.struct(
            b["dice"].alias("dice"), t["license"].alias("license"), p.alias("first"), (p + b["length"]).alias("last"))))

    return F.flatten(F.transform(fitting, of))


def scan(docs: DataFrame, notices=NOTICES, least: float = LEAST, bodies=BODIES) -> DataFrame:
    """One row per input row's doc_id and text: doc_id, license (of the best
    notice in any line, window or the whole text; ties by identifier), dice
    and n_notices (lines at ``least`` or above, or windows that do not overlap
    if these are more; the whole text counts where the text has no such line).
    Without a match: null, 0.0 and 0.

    Null and empty texts match nothing; null doc_ids and repeated rows keep a
    row each; an empty table gives no rows.
    """
    sets = [(name, grams, *size_bounds(len(grams), least)) for name, grams in ((n, bigrams_of(t)) for n, t in notices)]
    lowest, highest = min(s[2] for s in sets), max(s[3] for s in sets)
    base = docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    parts = base.select("doc_id", "digest", F.explode(F.concat(
        F.transform(F.split("text", "\n"), lambda x, i: F.struct(F.lit(True).alias("line"), i.alias("at"), x.alias("part"))),
        F.array(F.struct(F.lit(False).alias("line"), F.lit(0).alias("at"), F.col("text").alias("part"))))).alias("p")).select("doc_id", "digest", "p.*")
    parts = parts.withColumn("words", F.split(normalised(F.col("part")), " ")).drop("part")
    w = F.col("words")
    # n words have n - 1 bigrams at most, and n different ones have n - 1 different bigrams at least
    small = (F.size(w) - 1 >= lowest) & (F.size(F.array_distinct(w)) - 1 <= highest)
    parts = parts.filter(F.when(F.col("line"), small).otherwise(w.isNotNull()))
    parts = parts.withColumn("seq", F.transform(F.slice(w, F.lit(1), F.size(w) - 1), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1))))
    parts = parts.withColumn("grams", F.array_distinct("seq"))
    n, nowhere = F.size("grams"), F.lit(None).cast("int")
    scores = [F.when(n.between(lo, hi), F.struct((2 * F.size(F.array_intersect("grams", F.array(*map(F.lit, grams)))) / (n + len(grams))).alias("dice"),
                                                 F.lit(name).alias("license"), nowhere.alias("first"), nowhere.alias("last"))) for name, grams, lo, hi in sets]
    templates = [(name, bigrams_of(text)) for name, text in (*notices, *bodies)]
    found = F.concat(F.array_compact(F.array(*scores)), F.when(F.col("line"), F.array()).otherwise(windows(F.col("seq"), templates, least)))
    # a row per notice of fitting size or window, then only the matches
    hits = parts.select("doc_id", "digest", "line", "at", F.explode(found).alias("best")).filter(F.col("best.dice") >= least)
    spans = F.sort_array(F.collect_list(F.when(F.col("best.first").isNotNull(), F.struct("best.last", "best.first"))))
    apart = F.aggregate(spans, F.struct(F.lit(-1).alias("last"), F.lit(0).cast("long").alias("n")), lambda a, x: F.when(
        x["first"] > a["last"], F.struct(x["last"].alias("last"), (a["n"] + 1).alias("n"))).otherwise(a), lambda a: a["n"])
    hits = hits.groupBy("doc_id", "digest").agg(
        F.min(F.struct((-F.col("best.dice")).alias("d"), F.col("best.license").alias("license"))).alias("best"),
        F.greatest(F.count_distinct(F.when(F.col("line"), F.col("at"))), apart, F.lit(1)).alias("n_notices")).toDF("_id", "_digest", "best", "n_notices")
    rows = docs.select("doc_id", F.xxhash64("text").alias("digest"))
    return rows.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left").select(
        "doc_id", "best.license", F.coalesce(-F.col("best.d"), F.lit(0.0)).alias("dice"), F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"))
