"""Licence texts by canonical digest: native expressions and one hash join with the known digests."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Short public licence texts and the usual one-line notices.
_SHORT = (
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        f"Software. {_AS_IS}",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_AS_IS,
    ),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC_AS_IS),
    ("BSD-2-Clause", f"{_BSD_HEAD} {_BSD_TAIL}"),
    (
        "BSD-3-Clause",
        f"{_BSD_HEAD} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        f"or promote products derived from this software without specific prior written permission. {_BSD_TAIL}",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)
#: Names and files (in `licence_texts`) of whole licences, and where their appendix begins, if it may be left out.
_FILES = (
    ("Apache-2.0", "Apache-2.0", "   APPENDIX: How to apply"),
    ("Artistic-1.0-Perl", "Artistic", None),
    ("BSD-3-Clause", "BSD", None),
    ("CC0-1.0", "CC0-1.0", None),
    ("GFDL-1.2", "GFDL-1.2", "ADDENDUM: How to use"),
    ("GFDL-1.3", "GFDL-1.3", "ADDENDUM: How to use"),
    ("GPL-1.0", "GPL-1", "Appendix: How to Apply|How to Apply These Terms"),
    ("GPL-2.0", "GPL-2", "How to Apply These Terms"),
    ("GPL-3.0", "GPL-3", "How to Apply These Terms"),
    ("LGPL-2.0", "LGPL-2", "How to Apply These Terms"),
    ("LGPL-2.1", "LGPL-2.1", "How to Apply These Terms"),
    ("LGPL-3.0", "LGPL-3", None),
    ("MPL-1.1", "MPL-1.1", "EXHIBIT A"),
    ("MPL-2.0", "MPL-2.0", "Exhibit A - Source Code"),
)
#: Titles that may stand before a short licence.
_TITLES = {
    "MIT": ("MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)", "Expat License", "License: MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "License: ISC"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)", "0BSD License", "Zero Clause BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "BSD License", "Simplified BSD License", 'BSD 2-Clause "Simplified" License'),
    "BSD-3-Clause": (
        "BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "BSD License", "New BSD License",
        "Modified BSD License", "Revised BSD License", 'BSD 3-Clause "New" or "Revised" License',
    ),
}


def _whole_texts() -> list[tuple[str, str]]:
    """The files, with and without appendix, and short texts below a title."""
    out = []
    for name, file, appendix in _FILES:
        text = (Path(__file__).parent / "licence_texts" / f"{file}.txt").read_text(encoding="utf-8")
        at = [x.start() for x in re.finditer(appendix, text)] if appendix else []
        out += [(name, x) for x in (text, text[: at[-1]] if at else text)]
    titled = [(name, f"{title}\n\n{text}") for name, text in _SHORT if len(text) > 300 for title in _TITLES[name]]
    return list(dict.fromkeys(out + titled))


#: The short texts come first; then those that they do not hold.
KNOWN = (*_SHORT, *(x for x in _whole_texts() if x not in _SHORT))
#: Spellings that count as the same, and marks that do not count, between spaces.
EQUIVALENT = (
    (" licence", " license"),
    (" sublicence", " sublicense"),
    (" sub license", " sublicense"),
    (" copyright owner", " copyright holder"),
    (" organisation", " organization"),
    (" authorised", " authorized"),
    (" non commercial", " noncommercial"),
    (" favour", " favor"),
    (" relicence", " relicense"),
    (" unlicence", " unlicense"),
    # List marks of the BSD licences, also where a line breaks after them; bullets are punctuation.
    *((f" {x}{gap}redistributions", " redistributions") for x in ("1", "2", "a", "b", "i", "ii") for gap in (" ", "  \n ", "  \n  ")),
    *((f" {x}{gap}neither", " neither") for x in ("3", "c", "iii") for gap in (" ", "  \n ", "  \n  ")),
)


def _other_word(words: set[str]) -> str:
    """A pattern for the begin of any word but these, without looking ahead."""
    first: dict[str, set[str]] = {}
    for word in words - {""}:
        first.setdefault(word[0], set()).add(word[1:])
    letters = "".join(sorted(first))
    here = "".join(chr(x) for x in range(97, 123) if chr(x) not in letters) if "" in words else rf"^{letters}\n"
    return "(" + "|".join([f"[{here}]", *(x + _other_word(first[x]) for x in letters)]) + ")"


def _follow(pattern: str) -> set[str]:
    words = {x for _, text in KNOWN for x in re.findall(rf"{pattern}\s+([a-z]+)", text.lower())}
    return words | {x.replace(b.strip(), a.strip()) for x in words for a, b in EQUIVALENT}


# Patterns mean the same in Java and RE2.
# A copyright line has a sign, a year or a place for one, or a holder: a word that does not follow `copyright` in a licence.
# Other lines of a licence may begin with these words where it is wrapped there.
_SIGN = r"(©|\(c\)|[0-9<{]|\[)[^\n]*"
_COPYRIGHT_LINE = (
    rf"(^|\n)[ \t]*(copyright([ \t:]*{_SIGN}|[ \t:]+{_other_word(_follow('copyright') | {' ', chr(9)})}[^\n]*)|©[^\n]*"
    rf"|\(c\)([ \t]*(©|[0-9<{{]|\[)[^\n]*|[ \t]+{_other_word((_follow('[(]c[)]') - {'copyright'}) | {' ', chr(9)})}[^\n]*)"
    r"|all rights reserved([^a-z\n][^\n]*)?)"
)
#: ASCII, then no-break and other spaces, dashes, quotes, bullets and dots, marks without width.
_PUNCTUATION = "[!-/:-@\\[-`{-~ \t\r\x0b\x0c\u00a0\u00ab\u00b7\u00bb\u00ad\u2000-\u200f\u2010-\u2027\u202f\u2030-\u205e\u2060\u25a0-\u25ff\u3000\ufeff]+"


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines and punctuation, one spelling; a line break between lines that have words."""
    value = F.regexp_replace(F.lower(text), _COPYRIGHT_LINE, "\n")
    value = F.concat(F.lit(" "), F.regexp_replace(value, _PUNCTUATION, " "))
    value = F.replace(value, F.lit("\n"), F.lit(" \n "))
    for other, word in EQUIVALENT:
        value = F.replace(value, F.lit(other), F.lit(word))
    return F.trim(F.regexp_replace(F.regexp_replace(value, " +", " "), "( ?\n ?)+", "\n"), F.lit(" \n"))


def digest(value: Column) -> Column:
    return F.sha2(F.replace(value, F.lit("\n"), F.lit(" ")).cast("binary"), 256)


def known_digests(spark: SparkSession, known: tuple = KNOWN) -> DataFrame:
    """digest, licence, size of the known texts; the least name where two agree."""
    texts = spark.createDataFrame(list(known), "licence string, text string").withColumn("canonical", canonical(F.col("text")))
    by = texts.groupBy(digest(F.col("canonical")).alias("digest"))
    return by.agg(F.min("licence").alias("licence"), F.max(F.length("canonical")).alias("size"))


def scan(docs: DataFrame, known: tuple = KNOWN) -> DataFrame:
    """doc_id, canonical_sha256, licence, notices: the licence that the whole text is, and those its lines state.

    `licence` comes from a hash join of the digests of entire canonical texts with the known ones;
    `notices` lists, in order and joined by commas, the licences whose entire known text is one line
    of the document. A null text has null in all three; an empty one the digest of the empty text
    and no licence. Every row is returned, repeated ones too; other columns are ignored. The known
    table has as many rows as `known`, whatever the input.
    """
    table = known_digests(docs.sparkSession, known)
    rows = table.collect()  # one for each known text
    sizes, pairs = sorted({x["size"] for x in rows}), sorted((x["digest"], x["licence"]) for x in rows)
    names = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    texts = docs.select(F.col("doc_id").cast("long"), canonical(F.col("text")).alias("canonical"))
    lines = F.filter(F.split("canonical", "\n"), lambda x: F.length(x).isin(sizes))
    named = F.array_compact(F.transform(lines, lambda x: F.try_element_at(names, F.sha2(x.cast("binary"), 256))))
    marked = texts.select(
        "doc_id",
        digest(F.col("canonical")).alias("canonical_sha256"),
        F.array_join(F.array_sort(F.array_distinct(named)), ",").alias("notices"),
    )
    known_texts = table.select(F.col("digest").alias("canonical_sha256"), "licence")
    return marked.join(F.broadcast(known_texts), "canonical_sha256", "left").select(
        "doc_id", "canonical_sha256", "licence", "notices"
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def canonical_sql(text: str) -> str:
    value = f"regexp_replace(lower({text}), {_quoted(_COPYRIGHT_LINE)}, '\n', 'g')"
    value = f"replace(' ' || regexp_replace({value}, {_quoted(_PUNCTUATION)}, ' ', 'g'), '\n', ' \n ')"
    for other, word in EQUIVALENT:
        value = f"replace({value}, '{other}', '{word}')"
    return f"trim(regexp_replace(regexp_replace({value}, ' +', ' ', 'g'), '( ?\n ?)+', '\n', 'g'), ' \n')"


def scan_sql(known: tuple = KNOWN) -> str:
    """The same over table `documents`."""
    values = ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in known)
    return f"""
        WITH known AS (
            SELECT sha256(replace(c, '\n', ' ')) AS digest, min(licence) AS licence
            FROM (SELECT licence, {canonical_sql("t")} AS c FROM (VALUES {values}) AS k(licence, t)) GROUP BY 1
        ), texts AS (
            SELECT row_number() OVER () AS r, doc_id, {canonical_sql("text")} AS c FROM documents
        ), lines AS (
            SELECT r, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
            FROM (SELECT r, unnest(string_split(c, '\n')) AS line FROM texts) JOIN known ON sha256(line) = digest GROUP BY r
        )
        SELECT doc_id, sha256(replace(c, '\n', ' ')) AS canonical_sha256, licence,
            CASE WHEN c IS NULL THEN NULL ELSE coalesce(notices, '') END AS notices
        FROM texts LEFT JOIN known ON sha256(replace(c, '\n', ' ')) = digest LEFT JOIN lines USING (r)
    """
