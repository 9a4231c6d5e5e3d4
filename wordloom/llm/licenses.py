"""Licence scans by digests of canonical texts.

A text and the known licences are brought to one canonical form: lower case, without
copyright notices, with one spelling of words that have several, and with every run of
other characters than letters and digits as one space. Two texts are the same licence
if their canonical forms are equal, which a hash join on the SHA-256 of the form
decides. For whole texts the form is made coarser before it is hashed: a title in
front, numbers of list items and the named holders of BSD terms are no difference.
The lookup on single lines, by the plain form, finds the notices that texts carry. Lines
without any of ``MARKERS``, which every known text has, are not looked up.

The known licences are a table ``(license, text)``; :func:`known` holds common ones
in full and customary notices. It is joined by digest without a hint: the planner broadcasts
it while its size allows.

Defined cases: a null or empty text has the empty form, which is no licence. A licence
whose form is empty is left out; of licences with equal forms the first by name is
reported. Repeated rows are answered each; lines of rows that repeat an id and a text
are counted together. Other columns are passed through, but one with the name of an
output column is replaced by it.
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.texts import replacing, text_key, unused

# The form of a copyright notice, phrases that end one, and spellings that mean the
# same. A notice goes on for a bounded number of characters, so that no further terms go with it.
SIGN = r"(?:\(c\)|©|&copy;)"
YEAR = r"(?:(?:19|20)[0-9][0-9]|20xx|[<\[{(]?(?:years?|yyyy)\b)"
NOTICE = rf"(?:portions )?(?:copyright ?(?:{SIGN}|{YEAR}|[<\[{{])|{SIGN} ?{YEAR})"
NOTICE_SIZE = 160
OPENERS = (
    "all rights reserved|everyone is permitted|licensed under|permission is granted"
    "|permission is hereby granted|permission to use|redistribution and use"
    "|released under|spdx license|this library is|this program is|this work is"
)
SPELLINGS = (
    (r"licence", "license"),
    (r"sub license", "sublicense"),
    (r"(author|initial|organ|real|recogn|util)is(e|ing|ation)", "$1iz$2"),
    (r"(behavi|col|fav|hon|lab)our", "$1or"),
    (r"non (commercial|infring)", "non$1"),
    (r"(^| )https ", "$1http "),
)

# Short licences in full and the lines by which texts name a licence.
_PERMISSION = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted"
)
_ISC_WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE."""
_BSD_TERMS = """
Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution.
"""
_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER
IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
END_OF_TERMS = "END OF TERMS AND CONDITIONS"


def _full_texts() -> tuple[tuple[str, str], ...]:
    """The long licences, each whole and without what follows its terms."""
    found = []
    for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text = file.read_text()
        found.append((file.stem, text))
        terms, end, _ = text.partition(END_OF_TERMS)
        if end:
            found += [(file.stem, terms + end), (file.stem, terms)]
    return tuple(found)


LICENSES = (
    ("0BSD", f"{_PERMISSION}.{_ISC_WARRANTY}"),
    ("BSD-2-Clause", f"{_BSD_TERMS}{_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"{_BSD_TERMS}{_BSD_NAMES}{_BSD_WARRANTY}"),
    (
        "ISC",
        f"{_PERMISSION}, provided that the above copyright notice and this permission notice "
        f"appear in all copies.{_ISC_WARRANTY}",
    ),
    ("MIT", _MIT),
    ("MIT", f"MIT License{_MIT}"),
    ("MIT", f"The MIT License (MIT){_MIT}"),
    *_full_texts(),
)

# What makes no difference between canonical forms of whole texts.
TITLE = (
    r"^(?:the )?(?:(?:new |modified |revised |simplified )?(?:bsd (?:[23]|two|three) clause"
    r"|[23] clause bsd|isc|mit|bsd zero clause|zero clause bsd) license"
    r"|(?:new|modified|revised|simplified) bsd license|0bsd)(?: (?:mit|isc))?(?: |$)"
)
HOLDERS = (
    (r" (?:[1-3]|[a-c]|i{1,3}) (redistributions (?:of|in)|neither the names?) ", " $1 "),
    (
        r" neither the names? of .{1,300}? nor the names of (?:its|their|any|other)? ?contributors may ",
        " neither the name of holder nor the names of its contributors may ",
    ),
    (r" provided by .{1,200}? as is and any express ", " provided by holder as is and any express "),
    (r" in no event shall .{1,200}? be liable ", " in no event shall holder be liable "),
)
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
)


# A word of every text above, before spellings are made one.
MARKERS = "licen|granted|redistribution"


def known(spark: SparkSession) -> DataFrame:
    """``(license, text)`` of the licences and notices above."""
    names, texts = zip(*(LICENSES + NOTICES))
    # An Arrow table becomes a local relation, whose size the planner knows.
    return spark.createDataFrame(pa.table({"license": list(names), "text": list(texts)}))


def _without_notices(lowered: Column) -> Column:
    """``lowered`` without copyright notices.

    A notice begins with its form and ends with its paragraph, at the next notice, or where
    the terms begin. Lines are no part of this, so it does not matter how a text is wrapped.
    """
    out = F.regexp_replace(lowered, r"\n[^\p{L}\p{N}]*\n", "\x1e")
    out = F.regexp_replace(out, r"[^\p{L}\p{N}\x1e()©<\[{&;]+", " ")
    out = F.regexp_replace(out, rf"({OPENERS}|{NOTICE})", "\x1e$1")
    out = F.regexp_replace(out, rf"{NOTICE}[^\x1e]{{0,{NOTICE_SIZE}}}", " ")
    return F.regexp_replace(out, "all rights reserved", " ")


def canonical(text: Column) -> Column:
    """The canonical form of ``text``."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    marks = [F.contains(lowered, F.lit(mark)) for mark in ("copyright", "(c)", "©", "&copy;", "all rights")]
    out = F.when(reduce(Column.__or__, marks), _without_notices(lowered)).otherwise(lowered)
    out = F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))
    for pattern, spelling in SPELLINGS:
        out = F.regexp_replace(out, pattern, spelling)
    return out


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form, as hex digits."""
    return F.sha2(canonical(text), 256)


def matched(form: Column) -> Column:
    """The canonical ``form`` of a whole text without the differences that are none."""
    terms = F.regexp_replace(form, TITLE, "")
    bsd = terms
    for pattern, one in HOLDERS:
        bsd = F.regexp_replace(bsd, pattern, one)
    return F.when(terms.startswith("redistribution and use in source and binary forms"), bsd).otherwise(
        terms
    )


EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def digests(known_texts: DataFrame, whole: bool = False) -> DataFrame:
    """``(digest, license)``, one row per canonical form, or per form that ``whole`` texts match."""
    form = canonical(F.col("text"))
    hashed = F.sha2(matched(form) if whole else form, 256)
    found = known_texts.select(hashed.alias("digest"), "license")
    found = found.where(F.col("digest") != EMPTY)
    return found.groupBy("digest").agg(F.min("license").alias("license"))


def scan(
    docs: DataFrame,
    known_texts: DataFrame,
    text: str = "text",
    digest_as: str = "canonical_sha256",
    license_as: str = "license",
) -> DataFrame:
    """``docs`` with the digest of each whole text and the licence it is, null for none."""
    docs = replacing(docs, digest_as, license_as)
    wanted, found = unused(docs.columns, "known_digest"), unused(docs.columns, "known_license")
    table = digests(known_texts, whole=True).select(
        F.col("digest").alias(wanted), F.col("license").alias(found)
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    form, match = unused(docs.columns, "canonical_form"), unused(docs.columns, "match_digest")
    formed = docs.select(*columns, canonical(F.col(f"`{text}`")).alias(form))
    hashed = formed.select(
        *columns,
        F.sha2(F.col(form), 256).alias(digest_as),
        F.sha2(matched(F.col(form)), 256).alias(match),
    )
    joined = hashed.join(table, F.col(match) == F.col(wanted), "left")
    return joined.select(*columns, digest_as, F.col(found).alias(license_as))


def notices(
    docs: DataFrame,
    known_texts: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    markers: str = MARKERS,
) -> DataFrame:
    """``(doc_id, text_key, n_lines, licenses)`` of the texts with a line that is a known text.

    ``markers`` is a pattern that each of ``known_texts`` has in lower case; lines without it are
    passed over. Only lines that are found are shuffled. What is collected for a text
    are distinct names of the known table.
    """
    lines = docs.select(
        F.col(doc_id).alias("doc_id"),
        text_key(F.col(text)).alias("text_key"),
        F.explode_outer(F.split(F.col(text), "\n", -1)).alias("line"),
    )
    lines = lines.where(F.lower("line").rlike(markers))
    hashed = lines.select("doc_id", "text_key", digest(F.col("line")).alias("digest"))
    found = hashed.join(digests(known_texts), "digest")
    return found.groupBy("doc_id", "text_key").agg(
        F.count("*").alias("n_lines"), F.sort_array(F.collect_set("license")).alias("licenses")
    )
