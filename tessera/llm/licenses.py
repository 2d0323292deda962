"""Licence scans by Dice coefficient over word bigrams.

A document is looked at as a whole, by paragraph (split at empty lines), by line, and in
windows of as many words as a template has, at every place of its whole word sequence: a
licence set in several paragraphs, wrapped anew or written inside a sentence is found too.
Each unit is normalised to lower-case words of letters and digits and compared with the
licence templates as a set of word bigrams: ``2 * shared / (unit bigrams + template bigrams)``.

Two bounds prune templates before any set is intersected: with a threshold t,
only templates with between ``n * t / (2 - t)`` and ``n * (2 - t) / t`` bigrams
can reach t against a unit of n bigrams; and of those only templates that share
a bigram with the unit can.  Windows are formed only for templates of which the whole text
holds at least ``size * t / (2 - t)`` different bigrams, as a matching window must; templates
of fewer than ``MIN_WINDOW`` words have none (two words in a sentence grant nothing).

Cases: a null or empty text has no units; a unit of one word is that word, as
is such a template; equal Dice values go to the smaller template name; repeated
units and rows get equal results; an empty template list finds nothing; result
columns replace input columns of the same name.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tessera.llm.common import read_table, with_text_columns
from tessera.llm.decontaminate import normalised_words

THRESHOLD = 0.85
MIN_WINDOW = 4

#: Licence names as they stand in one-line statements.
NAMES = {
    "Apache-2.0": "Apache License, Version 2.0",
    "BSD-2-Clause": "BSD 2-Clause License",
    "BSD-3-Clause": "BSD 3-Clause License",
    "CC-BY-4.0": "CC BY 4.0",
    "CC-BY-NC-4.0": "CC BY-NC 4.0",
    "CC-BY-SA-4.0": "CC BY-SA 4.0",
    "GPL-2.0": "GNU General Public License, version 2",
    "GPL-3.0": "GNU General Public License, version 3",
    "LGPL-3.0": "GNU Lesser General Public License, version 3",
    "MIT": "MIT License",
    "MPL-2.0": "Mozilla Public License, v. 2.0",
}
STATEMENTS = (
    "Licensed under {}.",
    "Licensed under the {}.",
    "Released under the {}.",
    "Distributed under the {}.",
    "This work is licensed under {}.",
    "This work is licensed under the {}.",
)

#: Licence texts without their copyright lines.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details. You should have received a copy of the GNU General Public License along with this program.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}


def default_templates() -> list[tuple[str, str]]:
    said = [(name, s.format(text)) for name, text in NAMES.items() for s in STATEMENTS]
    return said + list(TEXTS.items())


def bigrams(words: list[bytes]) -> frozenset[bytes]:
    if len(words) == 1:
        return frozenset(words)
    return frozenset(a + b" " + b for a, b in zip(words, words[1:], strict=False))


class Templates:
    """Templates sorted by size, with an index from bigram to the templates that hold it."""

    def __init__(self, templates: Iterable[tuple[str, str]], threshold: float) -> None:
        sets = sorted({(name, bigrams(normalised_words(text.encode()))) for name, text in templates}, key=lambda x: (len(x[1]), x[0], sorted(x[1])))
        self.sets = [x for x in sets if x[1]]
        self.sizes = [len(s) for _, s in self.sets]
        self.threshold = threshold
        self.holders: dict[bytes, list[int]] = {}
        for k, (_, s) in enumerate(self.sets):
            for g in s:
                self.holders.setdefault(g, []).append(k)
        # Templates with windows: name, number of words, bigrams, least number of them that a match shares.
        lengths = {(name, len(w), bigrams(w)) for name, text in templates if len(w := normalised_words(text.encode())) >= MIN_WINDOW}
        self.windowed = [(name, m, s, len(s) * threshold / (2 - threshold) - 1e-9) for name, m, s in sorted(lengths, key=lambda x: (x[0], x[1], sorted(x[2])))]
        self.in_window: dict[bytes, list[int]] = {}
        for k, (_, _, s, _) in enumerate(self.windowed):
            for g in s:
                self.in_window.setdefault(g, []).append(k)
        self.known = frozenset(self.in_window)

    def matches(self, words: list[bytes]) -> Iterator[tuple[str, float]]:
        """(template name, Dice) of every template that reaches the threshold against a unit."""
        # A unit of w words has at most w - 1 distinct bigrams, at least one.
        t = self.threshold
        if not words or not self.sizes or max(1, len(words) - 1) < self.sizes[0] * t / (2 - t):
            return
        unit = bigrams(words)
        n = len(unit)
        lo = bisect_left(self.sizes, n * t / (2 - t) - 1e-9)
        hi = bisect_right(self.sizes, n * (2 - t) / t + 1e-9)
        if lo >= hi:
            return
        candidates = {k for g in unit if g in self.holders for k in self.holders[g] if lo <= k < hi}
        for k in candidates:
            name, other = self.sets[k]
            dice = 2.0 * len(unit & other) / (n + len(other))
            if dice >= t:
                yield name, dice


    def windows(self, words: list[bytes]) -> Iterator[tuple[str, float]]:
        """(template name, Dice) of every window of a template's length that reaches the threshold."""
        row = [a + b" " + b for a, b in zip(words, words[1:], strict=False)]
        held = Counter(k for g in self.known.intersection(row) for k in self.in_window[g])
        for k, n in held.items():
            name, m, other, least = self.windowed[k]
            if n < least or len(words) < m:
                continue
            here: Counter[bytes] = Counter()
            shared = 0
            for i, g in enumerate(row):
                here[g] += 1
                shared += here[g] == 1 and g in other
                if i >= m - 1:
                    old = row[i - m + 1]
                    here[old] -= 1
                    if not here[old]:
                        del here[old]
                        shared -= old in other
                if i >= m - 2:
                    dice = 2.0 * shared / (len(here) + len(other))
                    if dice >= self.threshold:
                        yield name, dice


def units(text: bytes) -> Iterator[bytes]:
    """Lines, paragraphs of several lines, and the whole text if it has several paragraphs."""
    paragraphs = text.split(b"\n\n")
    for p in paragraphs:
        lines = p.split(b"\n")
        yield from lines
        if len(lines) > 1:
            yield p
    if len(paragraphs) > 1:
        yield text


def scan_licenses(
    df: DataFrame, text_col: str = "text", templates: Iterable[tuple[str, str]] | Mapping[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """Add ``license`` (best match or null), ``dice`` (0 without a match), ``n_matches`` (units that match), ``n_windows`` (windows
    that match) and ``licenses`` (sorted names)."""
    templates = list(templates.items() if isinstance(templates, Mapping) else templates or ()) if templates is not None else None
    shared = df.sparkSession.sparkContext.broadcast(Templates(default_templates() if templates is None else templates, threshold))

    def rows(texts: Iterator[bytes | None]) -> Iterator[tuple]:
        known = shared.value
        for text in texts:
            best: dict[str, float] = {}
            n = 0
            for unit in units(text or b""):
                found = list(known.matches(normalised_words(unit)))
                n += bool(found)
                for name, dice in found:
                    best[name] = max(dice, best.get(name, 0.0))
            inside = 0
            for name, dice in known.windows(normalised_words(text or b"")):
                inside += 1
                best[name] = max(dice, best.get(name, 0.0))
            top = min(best.items(), key=lambda x: (-x[1], x[0]), default=(None, 0.0))
            yield top[0], top[1], n, inside, ",".join(sorted(best))

    return with_text_columns(df, text_col, StructType.fromDDL("license string, dice double, n_matches long, n_windows long, licenses string"), rows)


def q_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(n)}, {quote(t)})" for n, t in default_templates())
    words = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    grams = "CASE WHEN len(w) = 1 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END"
    return f"""
WITH para AS (SELECT doc_id, text, unnest(string_split(text, chr(10) || chr(10))) AS p FROM documents),
u AS (
  SELECT doc_id, unnest(string_split(p, chr(10))) AS x FROM para
  UNION ALL SELECT doc_id, p FROM para WHERE contains(p, chr(10))
  UNION ALL SELECT doc_id, text FROM documents WHERE contains(text, chr(10) || chr(10))),
t AS (SELECT name, {grams} AS g FROM (SELECT name, {words.format('x')} AS w FROM (VALUES {values}) AS v(name, x)) WHERE len(w) > 0),
big AS (SELECT max(len(g)) AS most FROM t),
g AS (SELECT doc_id, row_number() OVER () AS unit, {grams} AS g FROM (SELECT doc_id, {words.format('x')} AS w FROM u) WHERE len(w) > 0),
m AS (SELECT doc_id, unit, name, 2.0 * len(list_intersect(g.g, t.g))::DOUBLE / (len(g.g) + len(t.g)) AS dice FROM g, t, big
  WHERE len(g.g) <= most * {(2 - THRESHOLD) / THRESHOLD} AND len(t.g) BETWEEN len(g.g) * {THRESHOLD / (2 - THRESHOLD)} - 1 AND len(g.g) * {(2 - THRESHOLD) / THRESHOLD} + 1),
x AS (SELECT DISTINCT name, len(w) AS m, list_sort({grams}) AS g FROM (SELECT name, {words.format('x')} AS w FROM (VALUES {values}) AS v(name, x)) WHERE len(w) >= {MIN_WINDOW}),
dw AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS n, {words.format('text')} AS w FROM documents),
db AS (SELECT DISTINCT n, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM dw),
xb AS (SELECT name, m, g, unnest(g) AS b FROM x),
near AS (SELECT n, name, m, g FROM db JOIN xb USING (b) GROUP BY n, name, m, g HAVING count(*) >= len(g) * {THRESHOLD / (2 - THRESHOLD)} - 1e-9),
wd AS (SELECT doc_id, n, name, 2.0 * len(list_intersect(v, g))::DOUBLE / (len(v) + len(g)) AS dice FROM (
  SELECT doc_id, n, name, g, list_distinct(list_transform(range(s, s + m - 1), lambda i: w[i] || ' ' || w[i + 1])) AS v FROM (
    SELECT doc_id, n, name, g, m, w, unnest(range(1, len(w) - m + 2)) AS s FROM near JOIN dw USING (n) WHERE len(w) >= m))),
wk AS (SELECT doc_id, name, dice FROM wd WHERE dice >= {THRESHOLD}),
wn AS (SELECT doc_id, count(*) AS n_windows FROM wk GROUP BY doc_id),
k AS (SELECT doc_id, unit, name, max(dice) AS dice FROM m WHERE dice >= {THRESHOLD} GROUP BY ALL),
b AS (SELECT doc_id, arg_min(name, (-dice, name)) AS license, max(dice) AS dice, count(DISTINCT unit) AS n_matches,
  string_agg(DISTINCT name, ',' ORDER BY name) AS licenses FROM (SELECT doc_id, unit, name, dice FROM k UNION ALL SELECT doc_id, NULL, name, dice FROM wk) GROUP BY doc_id)
SELECT d.doc_id, license, coalesce(dice, 0.0)::DOUBLE AS dice, coalesce(n_matches, 0)::BIGINT AS n_matches, coalesce(n_windows, 0)::BIGINT AS n_windows, coalesce(licenses, '') AS licenses
FROM documents d LEFT JOIN b USING (doc_id) LEFT JOIN wn USING (doc_id)
"""


SQL = _sql()
