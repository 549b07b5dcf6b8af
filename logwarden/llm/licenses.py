"""License scan by canonical digests of whole texts and of their lines."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .license_texts import whole_texts

#: Licence tables up to this many rows are broadcast.
BROADCAST_LICENSES = 100_000

# Public licence notices and short licence texts by SPDX id.
LICENSES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("ISC", """ISC License
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", """MIT License
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
)
# Spellings that count as equal (the second is used).
SPELLINGS = (
    ("licence", "license"),
    ("licencing", "licensing"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("noncommercial", "non commercial"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
)
# Forms of a notice at the start of a line, and what makes a line prose instead.
#: A sign, "copyright" or "(c)" with a sign or a year, "Copyright" with a name, "all rights reserved".
NOTICE = (
    r"^[^\p{L}\p{N}©(]*(?:©|\([cC]\)\s*(?:©|(?i:copyright)|(?:19|20)\d\d)"
    r"|(?i:copyright)[\s:,]*(?:©|\([cC]\)|(?:19|20)\d\d)|(?i:all rights reserved)"
    r"|[Cc]opyright\s+(?:[Bb]y\s+)?\p{Lu})"
)
#: Dots that end no sentence.
ABBREVIATIONS = r"(?i)\b(?:inc|ltd|corp|co|llc|jr|sr|dr|prof|st|al)\.|all rights reserved\.?"
#: One sentence after another.
PROSE = r"\p{Ll}{2}[.!?]\s+\p{L}"
#: A line of more characters that is no notice is part of a licence's body.
HEADING_CHARS = 60
NO_WORD = r"[^\p{L}\p{M}\p{N}]+"
#: Letters at the end of a text by which texts that cannot be known are passed over.
TAIL_LETTERS, TAIL_CHARS = 12, 200


def _spelled(words: Column) -> Column:
    for spelling, used in SPELLINGS:
        words = F.replace(words, F.lit(spelling), F.lit(used))
    return F.trim(words)


def is_notice(line: Column) -> Column:
    return line.rlike(NOTICE) & ~F.regexp_replace(line, ABBREVIATIONS, "").rlike(PROSE)


def canonical(text: Column) -> Column:
    """Words in small letters and equal spelling, without punctuation and without the notices ahead of the body.

    The body begins with the first line of more than ``HEADING_CHARS`` that is no notice or, without one, with
    the last line that holds words and is none. Notices ahead of it are left out, however long.
    """
    def start(lines: Column, notices: Column) -> Column:
        body = F.transform(lines, lambda line, i: (F.length(line) > HEADING_CHARS) & ~F.get(notices, i))
        words = F.reverse(F.transform(lines, lambda line, i: line.rlike(r"[\p{L}\p{N}]") & ~F.get(notices, i)))
        last = F.size(lines) + 1 - F.nullif(F.array_position(words, True), F.lit(0))
        return F.coalesce(F.nullif(F.array_position(body, True), F.lit(0)), last, F.size(lines) + 1)

    def kept(lines: Column, notices: Column, start: Column) -> Column:
        return F.array_join(F.filter(lines, lambda line, i: (i + 1 >= start) | ~F.get(notices, i)), "\n")

    def of_lines(lines: Column) -> Column:
        return _let(F.transform(lines, is_notice), lambda notices: _let(
            start(lines, notices), lambda at: kept(lines, notices, at)
        ))

    body = _let(F.split(text, "\n"), of_lines)
    return _spelled(F.regexp_replace(F.lower(body), NO_WORD, " "))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def license_digest(text: Column) -> Column:
    """SHA-256 (hex) of the canonical text; null if nothing is left of it."""
    found = canonical(text)
    return F.when(found != "", F.sha2(found, 256))


_SPELT_ALIKE = str.maketrans("cz", "ss", "u")


def _letters(text: str) -> str:
    return "".join(filter(str.isalnum, text.lower()))


def tail(text: str) -> str | None:
    """The last letters of a text, the same for all its spellings; None if they do not show in its last characters.

    Notices stand ahead of a text, so they are not in them.
    """
    letters = _letters(text[-40:])
    if len(letters) < 2 * TAIL_LETTERS and len(text) > 40:
        letters = _letters(text[-TAIL_CHARS:])
    letters = letters.translate(_SPELT_ALIKE)
    if len(letters) < TAIL_LETTERS and len(text) > TAIL_CHARS:
        return None
    return letters[-TAIL_LETTERS:]


def known_licenses() -> list[tuple[str, str]]:
    """The notices and short texts above and all variants of the whole texts in ``license_texts``."""
    return [*LICENSES, *whole_texts({name: text for name, text in LICENSES if "\n" in text})]


def license_table(spark: SparkSession, licenses=None) -> DataFrame:
    licenses = known_licenses() if licenses is None else licenses
    return spark.createDataFrame([*licenses], "license string, text string")


_UNIT = "doc_id {}, _of string, _place int, _text string"


def _possible(docs: DataFrame, tails: set[str] | None) -> DataFrame:
    """Whole texts (place -1) and lines (from 0) that end like a known text; the others have no known digest.

    All of them if ``tails`` is None. ``_of`` is the MD5 sum of the whole text.
    """

    def may_be(text: str) -> bool:
        if tails is None:
            return True
        found = tail(text)
        return found is None or found in tails

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, units, ids = [], [], batch.column(0)
            for i, text in enumerate(batch.column(1).cast(pa.large_string()).to_pylist()):
                if text is None:
                    continue
                found = [(-1, text)] if may_be(text) else []
                found += [(place, line) for place, line in enumerate(text.split("\n")) if may_be(line)]
                if found:
                    of = hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()
                    rows += [i] * len(found)
                    units += [(of, *unit) for unit in found]
            columns = zip(*units, strict=True) if units else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows, pa.int64())),
                 *[pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string()), strict=True)]],
                names=["doc_id", "_of", "_place", "_text"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(find, _UNIT.format(kind))


def scan_licenses(docs: DataFrame, licenses: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the known licences in it.

    ``license`` is the licence that the whole text is, ``line_licenses`` those that
    single lines are (distinct, in order, joined by commas), ``n_license_lines`` the number
    of such lines. Both are found by ``license_digest``; digests are only computed of texts and
    lines whose last letters are those of a known text. ``licenses`` has license and text; texts
    with equal digests count for the license first in order. Null, empty and wordless texts have
    no licence. Rows equal in doc_id and text have equal results. An empty table gives none.
    """
    known = licenses if licenses is not None else license_table(docs.sparkSession)
    known = known.select(canonical(F.col("text")).alias("_canonical"), "license").filter(
        "_canonical <> '' AND license IS NOT NULL"
    )
    known = stage(known.select(
        "_canonical", F.sha2("_canonical", 256).alias("_digest"), "license"
    ).groupBy("_digest").agg(F.min("license").alias("_license"), F.first("_canonical").alias("_canonical")), "licenses")
    digests, tails = known.select("_digest", "_license"), None
    if known.count() <= BROADCAST_LICENSES:
        digests = F.broadcast(digests)
        ends = known.select(F.right("_canonical", F.lit(TAIL_CHARS)).alias("end")).collect()
        tails = {tail(r.end) for r in ends}
        if None in tails or any(len(t) < TAIL_LETTERS for t in tails):
            tails = None  # a known text of few letters: notices may be in what it ends with
    rows = docs.select("doc_id", "text")
    units = _possible(rows, tails).select(
        F.col("doc_id").alias("_doc_id"), "_of", "_place", license_digest(F.col("_text")).alias("_unit")
    )
    of_line = F.col("_place") >= 0
    hits = units.join(digests, F.col("_unit") == F.col("_digest")).groupBy("_doc_id", "_of").agg(
        F.min(F.when(~of_line, F.col("_license"))).alias("license"),
        F.array_join(F.array_sort(F.collect_set(F.when(of_line, F.col("_license")))), ",").alias("line_licenses"),
        F.countDistinct(F.when(of_line, F.col("_place"))).alias("n_license_lines"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_text") == F.col("_of"))
    return rows.select("doc_id", F.md5("text").alias("_text")).join(hits, same, "left").select(
        "doc_id", "license", F.nullif("line_licenses", F.lit("")).alias("line_licenses"),
        F.coalesce("n_license_lines", F.lit(0).cast("long")).alias("n_license_lines"),
    )
