"""Licence scans with DataFrame functions only.

Templates are normalised (lower case, runs of letters and digits) and known by
their sets of adjacent word pairs.  A document is looked at in units: each line,
each paragraph of several lines, and the whole text if it has several
paragraphs; and, for every template, the passages of the whole text that share
pairs with it.  A passage runs from one shared pair to another, over at most
``gap`` pairs between neighbours that are not shared, and is as long as it can
be; so a licence in paragraphs, in comments or inside a line of other words is
one passage wherever it stands.  The Dice coefficient of unit and template is 2 |A n B| / (|A| + |B|)
over the pairs.  It can reach ``threshold`` t only if |A| lies between
t / (2 - t) |B| and (2 - t) / t |B|: units of other sizes are dropped by their
word count before any pair is made, and of the rest each meets only the
templates of fitting size.  Whitespace, case and punctuation never matter.

Defined results: a null or empty text has no units; units of fewer than two
words have no pairs and match nothing; a unit that fits several templates gives
a row for each; equal units of a document give a row each, repeated rows too;
null ids stay null.  A line that is a licence is a passage as well, and gives a
row as each.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import id_and_text

# Notices and texts of public licences.
BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution."
)
BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "ISC full": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."
    ),
    "BSD-2-Clause full": f"{BSD_TERMS} {BSD_DISCLAIMER}",
    "BSD-3-Clause full": (
        f"{BSD_TERMS} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        f"promote products derived from this software without specific prior written permission. {BSD_DISCLAIMER}"
    ),
    "AGPL header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."
    ),
    "BSD-2-Clause": BSD_TERMS,
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0 notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

THRESHOLD = 0.8


def gap(size: int) -> int:
    """Pairs that a passage of a template of ``size`` pairs may skip at once."""
    return 2 + size // 16


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def pairs_of(text: str) -> list[str]:
    words = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def share_bounds(threshold: float) -> tuple[float, float]:
    """Least and largest size of a matching unit as a share of the template's,
    both widened a little so that rounding leaves no size on the bound out."""
    return threshold / (2 - threshold) - 1e-9, (2 - threshold) / threshold + 1e-9


def _bounds(templates: dict[str, str], threshold: float) -> tuple[int, str]:
    """Number of words that a unit must exceed, and SQL for the sizes that can match."""
    sizes = sorted({len(pairs_of(t)) for t in templates.values()})
    low, high = share_bounds(threshold)
    fits = " or ".join(f"size(pairs) between {low * s} and {high * s}" for s in sizes)
    return math.ceil(low * sizes[0]), fits


COMMON = {"under", "with", "this", "that", "from", "such", "other", "than", "your", "into"}


def anchors(templates: dict[str, str], threshold: float) -> list[str]:
    """A small set of words, rather long than common, one of which every
    matching unit holds."""
    chosen: set[str] = set()
    for text in templates.values():
        pairs = [p.split(" ") for p in pairs_of(text)]
        need = len(pairs) - math.ceil(threshold / (2 - threshold) * len(pairs) - 1e-9) + 1
        while sum(bool(chosen & set(p)) for p in pairs) < need:
            gain = Counter(w for p in pairs if not chosen & set(p) for w in set(p))
            chosen.add(max(gain, key=lambda w: (w not in COMMON, len(w) > 1, gain[w] * len(w) ** 2, w)))
    return sorted(chosen)


def licensed(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per unit and licence that match: doc_id, unit ('line',
    'paragraph', 'text' or 'passage'), unit_no (from 0, of its kind; for a passage
    the place of its first word among the words of the text), licence, n_pairs
    (distinct ones), dice.  No shuffle; the templates are literals of the plan."""
    given = {k: v for k, v in (TEMPLATES if templates is None else templates).items() if pairs_of(v)}
    schema = "doc_id long, unit string, unit_no int, licence string, n_pairs int, dice double"
    if not given:
        return docs.sparkSession.createDataFrame([], schema)
    least, fits = _bounds(given, threshold)
    literal = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    known = ", ".join(f"named_struct('licence', {literal(k)}, 'pairs', array({', '.join(map(literal, pairs_of(v)))}))" for k, v in given.items())
    every = sorted({p for v in given.values() for p in pairs_of(v)})

    units = """
        concat(
            transform(split(text, '\\n'), (u, i) -> named_struct('unit', 'line', 'unit_no', i, 'body', u)),
            filter(transform(split(text, '\\n[ \\t\\r]*\\n'), (u, i) -> named_struct('unit', 'paragraph', 'unit_no', i, 'body', u)), x -> contains(x.body, '\\n')),
            if(text rlike '\\n[ \\t\\r]*\\n', array(named_struct('unit', 'text', 'unit_no', 0, 'body', text)), cast(array() as array<struct<unit:string,unit_no:int,body:string>>)))
    """
    anchor = f"(?<![a-z0-9])(?:{'|'.join(anchors(given, threshold))})(?![a-z0-9])"
    texts = id_and_text(docs, id_col, text_col).where(F.lower("text").rlike(anchor))
    rows = texts.select("doc_id", F.explode(F.expr(units)).alias("u")).select("doc_id", "u.*").where(F.lower("body").rlike(anchor))
    # explode(array(x)) keeps the filters from working x out a second time
    words = "explode(array(filter(split(lower(body), '[^a-z0-9]+'), w -> w <> '')))"
    rows = rows.select("doc_id", "unit", "unit_no", F.expr(words).alias("words")).where(F.size("words") > least)
    pairs = "explode(array(array_distinct(transform(slice(words, 1, size(words) - 1), (w, i) -> concat(w, ' ', get(words, i + 1))))))"
    rows = rows.select("doc_id", "unit", "unit_no", F.expr(pairs).alias("pairs")).where(fits)
    rows = rows.where(f"arrays_overlap(pairs, array({', '.join(map(literal, every))}))")
    low, high = share_bounds(threshold)
    met = f"""filter(transform(filter(array({known}), t -> size(pairs) between {low} * size(t.pairs) and {high} * size(t.pairs)),
        t -> named_struct('licence', t.licence, 'dice', 2D * size(array_intersect(pairs, t.pairs)) / (size(pairs) + size(t.pairs)))),
        x -> x.dice >= {threshold})"""
    found = rows.select("doc_id", "unit", "unit_no", F.size("pairs").alias("n_pairs"), F.explode(F.expr(met)).alias("m"))
    found = found.select("doc_id", "unit", "unit_no", "m.licence", "n_pairs", "m.dice")
    return found.unionByName(_passages(texts, given, threshold))


def _passages(texts: DataFrame, given: dict[str, str], threshold: float) -> DataFrame:
    literal = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    among = lambda pairs: f"in ({', '.join(map(literal, pairs))})"
    every = sorted({p for v in given.values() for p in pairs_of(v)})
    low = share_bounds(threshold)[0]
    found, known = [], []
    for licence, text in given.items():
        own = pairs_of(text)
        known.append(f"named_struct('licence', {literal(licence)}, 'pairs', array({', '.join(map(literal, own))}))")
        apart = gap(len(own)) + 1
        found.append(
            f"""flatten(transform(array(transform(filter(shared, x -> x.pair {among(own)}), x -> x.at)), h -> filter(zip_with(
                filter(h, (x, k) -> k = 0 or x - get(h, k - 1) > {apart}), filter(h, (x, k) -> k = size(h) - 1 or get(h, k + 1) - x > {apart}),
                (a, b) -> named_struct('template', {len(known) - 1}, 'at', a, 'n', b - a + 1)), y -> y.n >= {low * len(own)})))"""
        )
    # explode(array(x)) keeps later columns from working x out again
    words = texts.select("doc_id", F.expr("explode(array(filter(split(lower(text), '[^a-z0-9]+'), w -> w <> '')))").alias("words"))
    pairs = "explode(array(transform(slice(words, 1, size(words) - 1), (w, i) -> concat(w, ' ', get(words, i + 1)))))"
    rows = words.where("size(words) > 1").select("doc_id", F.expr(pairs).alias("pairs"))
    shared = f"explode(array(filter(transform(pairs, (p, i) -> named_struct('at', i, 'pair', p)), x -> x.pair {among(every)})))"
    rows = rows.select("doc_id", "pairs", F.expr(shared).alias("shared")).where("size(shared) > 0")
    rows = rows.select("doc_id", "pairs", F.explode(F.expr(f"concat({', '.join(found)})")).alias("y"))
    rows = rows.select(
        "doc_id", F.col("y.at").alias("unit_no"), F.expr("array_distinct(slice(pairs, y.at + 1, y.n))").alias("own"), F.expr(f"get(array({', '.join(known)}), y.template)").alias("t")
    )
    dice = F.expr("2D * size(array_intersect(own, t.pairs)) / (size(own) + size(t.pairs))")
    rows = rows.select("doc_id", F.lit("passage").alias("unit"), "unit_no", "t.licence", F.size("own").alias("n_pairs"), dice.alias("dice"))
    return rows.where(F.col("dice") >= threshold)
