"""License scans by canonical digest lookup, in DataFrame functions only.

A text's canonical form is lower case, without copyright lines (lines that begin with a copyright sign or word, or are
only `all rights reserved`), with every run of ASCII punctuation, white space and typographic marks as one space, and
with equivalent spellings made one. Its SHA-256 is looked up among the digests of known licences: a hash join of entire
texts. The same lookup of every line finds notices inside longer documents. The known digests are a fixed table, so
that side of the join is broadcast; nothing is shuffled.

Cases: a null text counts as empty; an empty canonical form matches nothing; license_id and notice_ids are null and
empty without a match; a digest that two licences share goes to the one that sorts first; repeated rows give repeated
rows, an empty table none.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents
from .license_digests import FULL

#: Spellings that licence matching guidelines hold to be equal.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "authorisation": "authorization", "authorised": "authorized", "centre": "center",
    "favour": "favor", "fulfil": "fulfill", "labour": "labor", "licence": "license", "licences": "licenses", "licenced": "licensed",
    "organisation": "organization", "recognise": "recognize", "sub license": "sublicense", "non commercial": "noncommercial",
    "whilst": "while", "copyright owner": "copyright holder", "https": "http", "merchantibility": "merchantability",
}

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_TAIL = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

#: Names that notices give to licences.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"), "MIT": ("MIT License",), "ISC": ("ISC License",),
    "BSD-2-Clause": ("BSD 2-Clause License",), "BSD-3-Clause": ("BSD 3-Clause License",), "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GPL-2.0"), "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GPL-3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1",), "LGPL-3.0": ("GNU Lesser General Public License, version 3",), "AGPL-3.0": ("GNU Affero General Public License, version 3",),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"), "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"), "CC0-1.0": ("CC0 1.0",), "Unlicense": ("Unlicense",), "Zlib": ("zlib License",), "BSL-1.0": ("Boost Software License, Version 1.0",),
}
_FORMS = [a + b for a in ("", "This work is ", "This project is ", "This software is ") for b in ("licensed under ", "released under ", "distributed under ")]
_SUFFIXES = {"GPL-2.0": ("", "-only", "-or-later"), "GPL-3.0": ("", "-only", "-or-later"), "LGPL-2.1": ("", "-only", "-or-later"), "LGPL-3.0": ("", "-only", "-or-later"), "AGPL-3.0": ("", "-only", "-or-later")}
_NOTICES = [(i, f + the + n) for i, names in NAMES.items() for n in names for f in _FORMS for the in ("", "the ")]
_NOTICES += [(i, f"SPDX-License-Identifier: {i}{x}") for i in sorted({*NAMES, *FULL.values()}) for x in _SUFFIXES.get(i, ("",))]

#: Licence identifier and an entire text under which it is known: full texts, and the usual one-line notices. FULL has further full texts.
KNOWN = (
    *_NOTICES,
    ("MIT", _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("MIT", "The MIT License\n" + _MIT),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_TAIL),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _ISC_TAIL),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is in the public domain."),
)

_LINES = r"\n[\x20\t>*#/;-]*((copyright|\(c\)|©)[^\n]*|all rights reserved[\x20\t.\r]*(\n|$))"
_MARKS_IN_LINE = r"[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f“”‘’–—…]+"
_MARKS = r"[\x00-\x2f\x3a-\x60\x7b-\x7f“”‘’–—…]+"


#: Digests that a lookup may hold; they are part of the plan.
MOST_KNOWN = 20_000


def canonical(text: str) -> str:
    t = re.sub(_LINES, "\n", "\n" + text.lower())
    t = "  " + re.sub(_MARKS, "  ", t) + "  "
    for a, b in SPELLINGS.items():
        t = t.replace(f" {a.replace(' ', '  ')} ", f" {b.replace(' ', '  ')} ")
    return re.sub(" +", " ", t).strip(" ")


def digests(known: tuple = KNOWN) -> dict[str, str]:
    """Licence identifier by the digest of its canonical text; those of FULL belong to KNOWN."""
    return (FULL if known is KNOWN else {}) | {hashlib.sha256(canonical(t).encode()).hexdigest(): i for i, t in sorted(known, reverse=True)}


def canonical_column(text: Column) -> Column:
    t = F.regexp_replace(F.concat(F.lit("\n"), F.lower(text)), _LINES, "\n")
    t = F.concat(F.lit("  "), F.regexp_replace(t, _MARKS, "  "), F.lit("  "))
    for a, b in SPELLINGS.items():
        t = F.replace(t, F.lit(f" {a.replace(' ', '  ')} "), F.lit(f" {b.replace(' ', '  ')} "))
    return F.trim(F.regexp_replace(t, " +", " "))


def shared_form(text: Column) -> Column:
    """What the canonical form and those of all lines share: the text without copyright lines and marks, with spellings of one word made one.

    Marks become two spaces but for the line's end, which keeps its own between them; where spellings of two words cross it,
    only the whole form has them.
    """
    t = F.regexp_replace(F.concat(F.lit("\n"), F.lower(text)), _LINES, "\n")
    t = F.replace(F.regexp_replace(t, _MARKS_IN_LINE, "  "), F.lit("\n"), F.lit("  \n  "))
    t = F.concat(t, F.lit("  "))
    for a, b in SPELLINGS.items():
        if " " not in a:
            t = F.replace(t, F.lit(f" {a} "), F.lit(f" {b.replace(' ', '  ')} "))
    return t


def canonical_columns(t: Column) -> tuple[Column, Column]:
    """The canonical form, and those of all lines, of a text's shared form."""

    def ended(x: Column) -> Column:
        x = F.regexp_replace(x, " +", "  ")
        for a, b in SPELLINGS.items():
            if " " in a:
                x = F.replace(x, F.lit(f" {a.replace(' ', '  ')} "), F.lit(f" {b.replace(' ', '  ')} "))
        return F.trim(F.replace(x, F.lit("  "), F.lit(" ")))

    # the text begins with a line's end of its own
    return ended(F.replace(t, F.lit("\n"))), F.transform(F.split(t, "\n"), ended)


def scan(df: DataFrame, known: tuple = KNOWN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of df: digest and words of the canonical text, the licence it is, and those of its lines."""
    of = digests(known)
    if len(of) > MOST_KNOWN:
        raise ValueError(f"more than {MOST_KNOWN} known texts")
    # MOST_KNOWN rows of some hundred bytes at most
    table = F.broadcast(df.sparkSession.createDataFrame(sorted(of.items()), "canonical_sha256 string, license_id string"))
    # a map is searched entry by entry, so the digests are dealt out by their first two digits
    dealt = [[x for pair in sorted(of.items()) if int(pair[0][:2], 16) == k for x in pair] or ["", ""] for k in range(256)]
    lookup = F.array(*[F.create_map(*[F.lit(x) for x in part]) for part in dealt])
    t = F.coalesce(F.col(text), F.lit(""))
    # generators, so that neither the shared form nor the result is computed again for each use
    rows = df.select(F.col(key).alias("doc_id"), F.explode(F.array(shared_form(t))).alias("t"))
    whole, lines = canonical_columns(F.col("t"))
    lines = F.transform(lines, lambda x: F.when(x != "", F.sha2(x, 256)))
    lines = F.transform(lines, lambda h: F.get(lookup, F.conv(F.substring(h, 1, 2), 16, 10).cast("int"))[h])
    found = F.filter(lines, lambda x: x.isNotNull())
    rows = rows.select("doc_id", F.explode(F.array(F.struct(whole.alias("c"), found.alias("found")))).alias("x")).select("doc_id", "x.c", "x.found")
    rows = rows.select(
        "doc_id", F.sha2("c", 256).alias("canonical_sha256"),
        F.when(F.col("c") == "", 0).otherwise(F.char_length("c") - F.char_length(F.replace("c", F.lit(" "))) + 1).cast("long").alias("canonical_words"),
        F.size("found").cast("long").alias("n_notices"), F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("notice_ids"),
    )
    return rows.join(table, "canonical_sha256", "left").select("doc_id", "canonical_sha256", "canonical_words", "license_id", "n_notices", "notice_ids")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _sql_canonical(text: str) -> str:
    t = f"regexp_replace(chr(10) || lower({text}), '{_LINES}', chr(10), 'g')"
    t = f"'  ' || regexp_replace({t}, '{_MARKS}', '  ', 'g') || '  '"
    for a, b in SPELLINGS.items():
        t = f"replace({t}, ' {a.replace(' ', '  ')} ', ' {b.replace(' ', '  ')} ')"
    return f"trim(regexp_replace({t}, ' +', ' ', 'g'), ' ')"


ORACLE_SQL = f"""
WITH k(h, license_id) AS (VALUES {", ".join(f"('{h}', '{i}')" for h, i in sorted(digests().items()))}),
d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT n, unnest(string_split(t, chr(10))) AS line FROM d),
f AS (SELECT n, k.license_id AS i FROM l JOIN k ON k.h = sha256({_sql_canonical("line")})),
g AS (SELECT n, count(*) AS c, string_agg(DISTINCT i, ',' ORDER BY i) AS ids FROM f GROUP BY n),
c AS (SELECT n, doc_id, {_sql_canonical("t")} AS c FROM d)
SELECT doc_id, sha256(c.c) AS canonical_sha256, CASE WHEN c.c = '' THEN 0 ELSE length(c.c) - length(replace(c.c, ' ', '')) + 1 END::BIGINT AS canonical_words,
  k.license_id, coalesce(g.c, 0)::BIGINT AS n_notices, coalesce(g.ids, '') AS notice_ids
FROM c LEFT JOIN g ON g.n = c.n LEFT JOIN k ON k.h = sha256(c.c)
"""
