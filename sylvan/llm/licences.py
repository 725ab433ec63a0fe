"""Licence scan in DataFrame expressions only: the whole text, normalised to lower-case words, against licence texts and
notices by the Dice coefficient of word pairs.

Lines, blanks and punctuation don't count, so it is all one whether a notice is wrapped, stands alone or inside a longer line.
A template with m pairs is compared with the windows of m pairs that begin at one of its own pairs (shorter at the end of the
text). Size bounds decide first: with b distinct pairs in the template, a Dice coefficient of at least d needs d / (2 - d) * b
of them in the text, so a text with fewer known pairs is compared with no window of that template. Every occurrence of a
template counts: a window gives way to a nearer one of the same template that begins less than half the template's length from it (of equals to the earlier one). A window that overlaps one of another template gives way if the other has
more in common, less the pairs that only the window or only the template has; so a whole text wins over a sentence of it
(of equals the nearer wins, then the earlier in the list).

A window looks at its own pairs alone, as at most m hits follow its first one within it, and windows of other templates are looked for among the
few that can stand so near; so the work is the words times a template's length, however often a notice occurs.

Everything happens within a row: nothing is shuffled and nothing leaves the JVM. Nulls: a null text is empty and has no licence; a
null doc_id keeps its row. Repeated rows give repeated rows. An empty table gives no rows. Further columns are ignored."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED "
    "TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
    "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_MIT_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
)


def _gnu(name: str, versions: str, library: bool = False) -> str:
    """The notice that files under a GNU licence carry."""
    kind = "library" if library else "program"
    return (
        f"This {kind} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, {versions}. "
        f"This {kind} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. "
        f"You should have received a copy of the GNU {name} along with this {kind}. If not, see <https://www.gnu.org/licenses/>."
    )


#: Licence texts and notices that are compared, by licence.
NOTICES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _MIT_PERMISSION),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("all-rights-reserved", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC_WARRANTY),
    ("AGPL-3.0", _gnu("Affero General Public License", "either version 3 of the License, or (at your option) any later version")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", _BSD + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD + _BSD_THIRD + _BSD_WARRANTY),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GPL-2.0", _gnu("General Public License", "either version 2 of the License, or (at your option) any later version")),
    ("GPL-3.0", _gnu("General Public License", "either version 3 of the License, or (at your option) any later version")),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_WARRANTY),
    ("LGPL-2.1", _gnu("Lesser General Public License", "either version 2.1 of the License, or (at your option) any later version", library=True)),
    ("LGPL-3.0", _gnu("Lesser General Public License", "either version 3 of the License, or (at your option) any later version", library=True)),
    ("MIT", _MIT_PERMISSION + "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that "
        "you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must "
        "not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
]


@dataclass(frozen=True)
class Licences:
    """percent: least Dice coefficient in hundredths."""

    percent: int = 80


def _words(text: str) -> list[str]:
    return re.sub("[^0-9a-z]+", " ", text.lower()).split()


def _template(text: str) -> tuple[int, list[str]]:
    """Number of pairs, and the distinct ones."""
    pairs = [" ".join(p) for p in zip(_words(text), _words(text)[1:], strict=False)]
    return len(pairs), sorted(set(pairs))


TEMPLATES = [(name, *_template(text)) for name, text in NOTICES]
_quoted = lambda texts: ", ".join(f"'{t}'" for t in texts)  # noqa: E731  words are letters and digits


def matches(text: Column, conf: Licences = Licences()) -> Column:
    """An array of (licence, start, stop, common, total) in order of start: the words from start, counted from 0, to stop, exclusive,
    are near the licence; the Dice coefficient is 2 * common / total."""
    d = conf.percent
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^0-9a-z]+", " ")), " ")
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))
    known = sorted({p for _, _, pairs in TEMPLATES for p in pairs})
    templates = ", ".join(
        f"named_struct('place', {i}, 'licence', '{name}', 'm', {m}, 'b', {len(own)}, 'pairs', array({_quoted(own)}))" for i, (name, m, own) in enumerate(TEMPLATES)
    )
    enough = lambda t, n: n * (200 - d) >= t["b"] * d
    in_step = lambda column, step: F.transform(F.array(column), step)[0]  # noqa: E731  a value that is used more than once

    def found(p: Column) -> Column:
        hits = F.filter(F.transform(p, lambda x, i: F.struct(i.alias("i"), x.alias("p"))), lambda x: x["p"].isin(known))
        return in_step(hits, lambda h: F.when(F.size(h) > 0, nearest(p, h)))

    def nearest(p: Column, hits: Column) -> Column:
        kinds = F.array_distinct(F.transform(hits, lambda x: x["p"]))
        some = in_step(kinds, lambda k: F.filter(F.expr(f"array({templates})"), lambda t: enough(t, F.size(k)) & enough(t, F.size(F.array_intersect(k, t["pairs"])))))
        return F.flatten(F.transform(some, lambda t: in_step(F.filter(hits, lambda x: F.array_contains(t["pairs"], x["p"])), lambda own: occurrences(windows(p, t, own), t))))

    def windows(p: Column, t: Column, own: Column) -> Column:
        """The windows that are near enough, in order of their start."""

        def window(s: Column, k: Column) -> Column:
            inside = F.array_distinct(F.transform(F.filter(F.slice(own, k + 1, t["m"]), lambda y: y["i"] < s["i"] + t["m"]), lambda y: y["p"]))
            return in_step(F.size(inside), lambda common: F.when(enough(t, common), in_step(F.slice(p, s["i"] + 1, t["m"]), lambda whole: sized(s, common, whole))))

        def sized(s: Column, common: Column, whole: Column) -> Column:
            return in_step(F.size(F.array_distinct(whole)) + t["b"], lambda total: F.when(
                common * 200 >= total * d,
                F.struct((common / total).alias("half"), (-t["place"]).alias("order"), t["licence"].alias("licence"), s["i"].cast("long").alias("start"),
                    (s["i"] + F.size(whole) + 1).cast("long").alias("stop"), common.alias("common"), total.alias("total"), t["m"].alias("m")),
            ))

        return F.filter(F.transform(own, window), lambda x: x.isNotNull())

    def occurrences(near: Column, t: Column) -> Column:
        better = lambda y, x: (y["half"] > x["half"]) | (y["half"] == x["half"]) & (y["start"] < x["start"])
        close = lambda y, x: F.abs(y["start"] - x["start"]) * 2 < t["m"]
        half = F.floor(t["m"] / 2).cast("int") + 1
        beside = lambda all_, k: F.slice(all_, F.greatest(k - half, F.lit(0)) + 1, 2 * half + 1)
        return in_step(near, lambda all_: F.filter(all_, lambda x, k: ~F.exists(beside(all_, k), lambda y: better(y, x) & close(y, x))))

    def clear(found_: Column) -> Column:
        worth = lambda z: F.struct(3 * z["common"] - z["total"], z["half"], z["order"])
        over = lambda y, x: (y["start"] < x["stop"]) & (x["start"] < y["stop"])
        by_start = F.array_sort(F.transform(found_, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), *(x[c].alias(c) for c in ("licence", "common", "total", "half", "order", "m")))))
        # windows of one template begin at least half its length apart, so no more than these begin within the length of another
        longest, least = (lambda all_: F.array_max(F.transform(all_, lambda x: x["stop"] - x["start"]))), (lambda all_: F.array_min(F.transform(all_, lambda x: x["m"])))
        reach = lambda all_: F.size(F.array_distinct(F.transform(all_, lambda x: x["order"]))) * (F.floor(2 * longest(all_) / least(all_)).cast("int") + 2)
        beside = lambda all_, k, r: F.slice(all_, F.greatest(k - r, F.lit(0)) + 1, 2 * r + 1)
        kept = lambda all_, r: F.filter(all_, lambda x, k: ~F.exists(beside(all_, k, r), lambda y: (worth(y) > worth(x)) & over(y, x)))
        chosen = in_step(by_start, lambda all_: in_step(reach(all_), lambda r: kept(all_, r)))
        return F.transform(chosen, lambda x: F.struct(*(x[c].alias(c) for c in ("start", "stop", "licence", "common", "total"))))

    none = F.array().cast("array<struct<start:bigint,stop:bigint,licence:string,common:int,total:int>>")
    return F.coalesce(in_step(in_step(pairs, found), lambda x: F.when(F.size(x) > 0, clear(x))), none)


def scan(docs: DataFrame, conf: Licences = Licences()) -> DataFrame:
    """`docs(doc_id, text)` to `(doc_id, found)`, found as `matches`."""
    return docs.select("doc_id", matches(F.col("text"), conf).alias("found"))


def digest(scanned: DataFrame) -> DataFrame:
    best = F.array_max(F.transform("found", lambda x: F.round(2 * x["common"] / x["total"], 6)))
    return scanned.select(
        "doc_id", F.size("found").cast("long").alias("n_found"), F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda x: x["licence"]))), ",").alias("licences"),
        F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["licence"], x["start"], x["stop"])), ",").alias("hits"), F.coalesce(best, F.lit(0.0)).alias("best_dice"),
    )


_VALUES = ", ".join(f"({i}, '{name}', {m}, [{_quoted(own)}])" for i, (name, m, own) in enumerate(TEMPLATES))
#: The same in SQL, by all windows that begin at a pair of a template, without the size bounds.
SQL = f"""
WITH t(place, licence, m, own) AS (VALUES {_VALUES}), tp AS (SELECT place, m, len(own) AS b, licence, unnest(own) AS pair FROM t),
w AS (SELECT doc_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^0-9a-z]+', ' ', 'g')), ' ') AS w FROM documents),
p AS (SELECT doc_id, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) AS p FROM w),
h AS (SELECT doc_id, unnest(range(len(p))) AS i, unnest(p) AS pair FROM p),
own AS (SELECT doc_id, i, pair, place, m, b, licence FROM h JOIN tp USING (pair)),
c AS (
  SELECT s.doc_id, s.place, s.i, s.m, s.b, s.licence, count(DISTINCT y.pair) AS common FROM own s JOIN own y ON y.doc_id = s.doc_id AND y.place = s.place AND y.i >= s.i AND y.i < s.i + s.m
  GROUP BY ALL HAVING common * 120 >= s.b * 80
),
d AS (SELECT c.*, len(list_distinct(p[i + 1:i + m])) + b AS total, len(p[i + 1:i + m]) AS n FROM c JOIN p USING (doc_id)),
r AS (SELECT *, i AS start, i + n + 1 AS stop, common / total AS half, 3 * common - total AS worth FROM d WHERE common * 200 >= total * 80),
best AS (
  SELECT * FROM r x WHERE NOT EXISTS (
    SELECT 1 FROM r y WHERE y.doc_id = x.doc_id AND y.place = x.place AND 2 * abs(y.i - x.i) < x.m AND (y.half > x.half OR y.half = x.half AND y.i < x.i)
  )
),
k AS (
  SELECT * FROM best x WHERE NOT EXISTS (
    SELECT 1 FROM best y WHERE y.doc_id = x.doc_id AND y.start < x.stop AND x.start < y.stop 
      AND (y.worth > x.worth OR y.worth = x.worth AND (y.half > x.half OR y.half = x.half AND y.place < x.place))
  )
),
g AS (
  SELECT doc_id, count(*) AS n_found, array_to_string(list_sort(list(DISTINCT licence)), ',') AS licences, string_agg(licence || ':' || start || ':' || stop, ',' ORDER BY start, stop, licence) AS hits,
    max(round(2 * common / total, 6)) AS best_dice FROM k GROUP BY doc_id
)
SELECT doc_id, coalesce(n_found, 0) AS n_found, coalesce(licences, '') AS licences, coalesce(hits, '') AS hits, coalesce(best_dice, 0.0) AS best_dice
FROM documents LEFT JOIN g USING (doc_id)
"""
