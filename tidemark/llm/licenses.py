"""Licence scans: Dice coefficient over word bigrams against templates. DataFrame operations only."""

from __future__ import annotations

import re
from collections import Counter
from itertools import accumulate
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licence, template text. The notices as their authors publish them.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met: Redistributions of source code must retain the above copyright "
                     "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
                     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
WARRANTY = ("This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
            "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details.")
#: Standard header notices: licence, its name, what it covers, its version, the sign in its first sentence, where to get a copy.
for _license, _name, _work, _version, _sign, _copy in [
    ("GPL-2.0", "General Public License", "program", "2", ";", "if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."),
    ("GPL-3.0", "General Public License", "program", "3", ",", "If not, see <https://www.gnu.org/licenses/>."),
    ("LGPL-2.1", "Lesser General Public License", "library", "2.1", ";", "if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"),
    ("LGPL-3.0", "Lesser General Public License", "library", "3", ",", "If not, see <https://www.gnu.org/licenses/>."),
    ("AGPL-3.0", "Affero General Public License", "program", "3", ",", "If not, see <https://www.gnu.org/licenses/>."),
]:
    _first = (f"This {_work} is free software{':' if _sign == ',' else ';'} you can redistribute it and/or modify it under the terms of the GNU {_name} as "
              f"published by the Free Software Foundation{_sign} either version {_version} of the License, or (at your option) any later version.")
    TEMPLATES += [(_license, _first), (_license, f"{_first} {WARRANTY.format(_work, _name)} You should have received a copy of the GNU {_name} along with this {_work}; {_copy}")]
AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
         "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
         "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
         "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
         "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
         "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
NO_ENDORSEMENT = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
                  "from this software without specific prior written permission.")
_bsd = next(text for name, text in TEMPLATES if name == "BSD-2-Clause" and text.startswith("Redistribution"))
_mit = next(text for name, text in TEMPLATES if name == "MIT" and text.startswith("Permission"))
_apache = next(text for name, text in TEMPLATES if name == "Apache-2.0" and "may not use" in text)
TEMPLATES += [
    ("BSD-2-Clause", f"{_bsd} {AS_IS}"),
    ("BSD-3-Clause", f"{_bsd} {NO_ENDORSEMENT}"),
    ("BSD-3-Clause", f"{_bsd} {NO_ENDORSEMENT} {AS_IS}"),
    ("MIT", f"{_mit} THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
            "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
            "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache-2.0", f"{_apache} Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
                   "limitations under the License."),
]
#: Whole texts. That of AGPL-3.0 is the one of GPL-3.0 with the parts that differ put in.
WHOLE_TEXTS = [(p.stem, p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
#: Templates of more bigrams are compared by array, not by a join.
LONG = 400
DICE = 0.8
#: What separates words. Both engines of the tests read it alike.
NO_WORD = r"[^\p{L}\p{N}]+"


def bigrams_of(text: str) -> list[str]:
    words = re.sub(r"[^\w]+|_", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def anchors(templates: list[list[str]], dice: float) -> list[tuple[str, str]]:
    """Bigrams of which any text that reaches ``dice`` with a template must hold one, as (word, other word). Reaching
    ``dice`` takes at least dice / (2 - dice) of the template's bigrams, so of each template as many are taken as leave
    fewer than that. Words are taken by the bigrams that they add to all templates, long ones first: each is a scan of
    the texts, and long ones are rare in other texts."""
    need = [int(len(own) - len(own) * dice / (2 - dice)) + 1 for own in templates]
    held: dict[str, set[tuple[int, str]]] = {}
    for t, own in enumerate(templates):
        for g in own:
            for w in g.split():
                held.setdefault(w, set()).add((t, g))
    chosen, taken = set(), [set() for _ in templates]

    def gain(w: str) -> int:
        new = [0] * len(templates)
        for t, g in held[w]:
            new[t] += g not in taken[t]
        return sum(min(n, need[t] - len(taken[t])) for t, n in enumerate(new) if len(taken[t]) < need[t])

    while any(len(own) < n for own, n in zip(taken, need)):
        gains = {w: n for w in held if (n := gain(w))}
        best = max(gains, key=lambda w: (len(w) >= 6, gains[w] * len(w), w))
        for t, g in sorted(held.pop(best)):
            if g not in taken[t] and len(taken[t]) < need[t]:
                x, y = g.split()
                chosen.add((best, y if x == best else x))
                taken[t].add(g)
    return sorted(chosen)


def least_words(bigrams: list[str], dice: float) -> int:
    """Words of a template that any text reaching ``dice`` with it must hold: with fewer, even those of the most
    bigrams, less than dice / (2 - dice) of the bigrams have both their words."""
    uses = sorted(Counter(w for g in bigrams for w in g.split()).values(), reverse=True)
    return 1 + sum(1 for x in accumulate(uses) if x < 2 * len(bigrams) * dice / (2 - dice) - 1e-6)


def holds_any(text: Column, bigrams: list[tuple[str, str]]) -> Column:
    """Whether a text holds both words of one of the bigrams; each longer word is looked for once."""
    out = F.lit(False)
    for word in sorted({a for a, _ in bigrams}):
        other = F.lit(False)
        for b in sorted(b for a, b in bigrams if a == word):
            other = other | F.contains(text, F.lit(b))
        out = out | (F.contains(text, F.lit(word)) & other)
    return out


def units_of(low: DataFrame) -> DataFrame:
    """(id, unit): lines, sentences, paragraphs and whole texts."""
    lines = F.split("low", "\n")
    sentences = F.split(F.regexp_replace("low", r"([.!?])[ \t]+", "$1\n"), "\n")
    paragraphs = F.split("low", r"\n[ \t\r]*\n")
    return low.select("id", F.explode(F.array_distinct(F.concat(lines, sentences, paragraphs, F.array("low")))).alias("unit"))


def sized_bigrams(units: DataFrame, low_size: float, high_size: float) -> DataFrame:
    """(id, passage, bigrams, a) of the units with a number ``a`` of distinct bigrams between the two."""
    words = units.withColumn("words", F.split("passage", " ")).filter(F.size("words") > low_size)
    pairs = F.zip_with(F.slice("words", 1, F.size("words") - 1), F.slice("words", 2, F.size("words") - 1), lambda x, y: F.concat(x, F.lit(" "), y))
    bigrams = words.filter(F.size("words") >= 2).select("id", "passage", F.array_distinct(pairs).alias("bigrams"))
    return bigrams.withColumn("a", F.size("bigrams")).filter(F.col("a").between(low_size, high_size))


def short_scores(low: DataFrame, templates: list[tuple[int, str, list[str]]], dice: float) -> DataFrame:
    """(id, passage, template, license, dice) of passages that reach ``dice``, by an equality join on bigrams."""
    rows = [(i, name, len(own), g) for i, name, own in templates for g in own]
    known = low.sparkSession.createDataFrame(rows, "template int, license string, b int, bigram string")
    sizes = [r[2] for r in rows] or [1]
    need = anchors([t[2] for t in templates], dice)
    units = units_of(low.filter(holds_any(F.col("low"), need))).filter(holds_any(F.col("unit"), need))
    passages = units.select("id", F.trim(F.regexp_replace("unit", NO_WORD, " ")).alias("passage")).distinct()
    bigrams = sized_bigrams(passages, min(sizes) * dice / (2 - dice), max(sizes) * (2 - dice) / dice)
    each = bigrams.select("id", "passage", "a", F.explode("bigrams").alias("bigram"))
    bound = F.col("a").between(F.col("b") * F.lit(dice / (2 - dice)), F.col("b") * F.lit((2 - dice) / dice))
    common = each.join(known, "bigram").filter(bound).groupBy("id", "passage", "template", "license", "a", "b").agg(F.count("*").alias("c"))
    return common.withColumn("dice", 2 * F.col("c") / (F.col("a") + F.col("b"))).filter(F.col("dice") >= dice).select("id", "passage", "template", "license", "dice")


def long_scores(low: DataFrame, templates: list[tuple[int, str, list[str]]], dice: float) -> DataFrame:
    """The same for long templates: only texts with enough words of theirs are cut into passages, whose bigrams stay in
    their rows."""
    sizes = [len(own) for _, _, own in templates]
    least = min(sizes) * dice / (2 - dice)
    # That many bigrams have a word more, of a letter and a separator each.
    known = F.split(F.lit("\n".join(sorted({w for _, _, own in templates for g in own for w in g.split()}))), "\n")
    worded = F.size(F.array_intersect(F.split("low", NO_WORD), known)) >= min(least_words(own, dice) for _, _, own in templates)
    units = units_of(low.filter(F.length("low") > 2 * least).filter(worded)).filter(F.length("unit") > 2 * least)
    passages = units.select("id", F.trim(F.regexp_replace("unit", NO_WORD, " ")).alias("passage"))
    held = sized_bigrams(passages, least, max(sizes) * (2 - dice) / dice)

    def score(i: int, name: str, own: list[str]) -> Column:
        b = len(own)
        common = F.size(F.array_intersect("bigrams", F.split(F.lit("\n".join(own)), "\n")))
        fits = F.col("a").between(b * dice / (2 - dice), b * (2 - dice) / dice)
        return F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.when(fits, 2 * common / (F.col("a") + F.lit(b))).alias("dice"))

    each = held.select("id", "passage", F.explode(F.array(*[score(*t) for t in templates])).alias("s"))
    return each.select("id", "passage", "s.*").filter(F.col("dice") >= dice).distinct()


def scan(
    docs: DataFrame, templates: list[tuple[str, str]] | None = None, *, dice: float = DICE, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, license, template, dice, passages): licences whose template a passage of the document matches.

    Passages are a document's lines, its sentences, its paragraphs and the whole text, lower-cased, with anything but
    letters and digits as one space. Dice is 2 * common / (a + b) over distinct word bigrams. A passage counts for its
    best template (the first one of equals), a licence with its best passage; ``passages`` is the number of different
    passages that matched.

    Texts are pruned twice before a bigram is made, without loss: by bigrams' words of which every match holds a pair, and by size,
    as ``dice`` bounds the ratio of the two bigram counts. What is left meets the templates in an equality join on
    bigrams, again under the size bound, so a passage never meets a template it shares nothing with. Templates are a
    constant of the call and small enough to broadcast. Whole licence texts are compared without a join, with passages
    long enough for them only.

    NULL and empty texts match nothing; a NULL id is reported as NULL; rows that repeat an id are reported together;
    other columns are ignored. Empty input gives no rows.
    """
    templates = TEMPLATES + WHOLE_TEXTS if templates is None else templates
    sized = [(i, name, own) for i, (name, text) in enumerate(templates) if (own := bigrams_of(text))]
    low = docs.select(F.col(id_col).alias("id"), F.lower(F.col(text_col)).alias("low"))
    scored = short_scores(low, [t for t in sized if len(t[2]) <= LONG], dice)
    if long := [t for t in sized if len(t[2]) > LONG]:
        scored = scored.unionByName(long_scores(low, long, dice))
    best = scored.groupBy("id", "passage").agg(F.max(F.struct("dice", (-F.col("template")).alias("t"), "license")).alias("m"))
    found = best.groupBy("id", "m.license").agg(F.max(F.struct("m.dice", "m.t")).alias("m"), F.count("*").alias("passages"))
    return found.select(F.col("id").alias(id_col), "license", (-F.col("m.t")).alias("template"), "m.dice", "passages")


def sql(templates: list[tuple[str, str]] | None = None, dice: float = DICE) -> str:
    """The same without pruning by words, for DuckDB."""
    templates = TEMPLATES + WHOLE_TEXTS if templates is None else templates
    values = ", ".join(f"({i}, '{name}', {len(own)}, '{g}')" for i, (name, text) in enumerate(templates) if (own := bigrams_of(text)) for g in own)
    return rf"""
WITH t(template, license, b, bigram) AS (VALUES {values}),
l AS (SELECT doc_id, lower(text) AS low FROM documents),
u AS (SELECT doc_id, unnest(string_split(low, chr(10))) AS unit FROM l
    UNION SELECT doc_id, unnest(string_split(regexp_replace(low, '([.!?])[ \t]+', '\1' || chr(10), 'g'), chr(10))) FROM l
    UNION SELECT doc_id, unnest(string_split_regex(low, '\n[ \t\r]*\n')) FROM l
    UNION SELECT doc_id, low FROM l),
p AS (SELECT DISTINCT doc_id, trim(regexp_replace(unit, '{NO_WORD}', ' ', 'g')) AS passage FROM u),
w AS (SELECT doc_id, passage, string_split(passage, ' ') AS words FROM p),
g AS (SELECT doc_id, passage, list_distinct(list_transform(generate_series(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1])) AS bigrams
    FROM w WHERE len(words) >= 2),
e AS (SELECT doc_id, passage, len(bigrams) AS a, unnest(bigrams) AS bigram FROM g),
s AS (SELECT doc_id, passage, template, license, 2.0::DOUBLE * count(*) / (a + b) AS dice FROM e JOIN t USING (bigram)
    GROUP BY doc_id, passage, template, license, a, b HAVING 2.0::DOUBLE * count(*) / (a + b) >= {dice}),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY doc_id, passage ORDER BY dice DESC, template) = 1),
n AS (SELECT *, count(*) OVER (PARTITION BY doc_id, license) AS passages FROM m)
SELECT doc_id, license, template, dice, passages FROM n
QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY dice DESC, template) = 1"""
