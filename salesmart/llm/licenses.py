"""License scans by canonical digest lookup.

A text is brought to canonical form (letter case, quotation marks and dashes, copyright
lines, punctuation, white space and equivalent spellings are normalised), digested, and
its digest hash-joined with the digests of known license texts in the same form.  Entire
texts are looked up: the whole document, and every paragraph (line) of it as a text of
its own, which finds notices inside other prose.  No Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import text_of

# Known license texts and notices, one entry for each accepted wording.
MIT_TEXT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be "
    "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
    "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
    "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
    "OTHER DEALINGS IN THE SOFTWARE.")
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
                   "specific language governing permissions and limitations under the License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", MIT_TEXT),
    ("MIT", "MIT License " + MIT_TEXT),
    ("MIT", "The MIT License (MIT) " + MIT_TEXT),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
            "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR "
            "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
            "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
            "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("proprietary", "All rights reserved."),
]

# Spellings that count as equal; the left is written as the right.  Words in
# canonical form (lower case, single spaces), longer ones first.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("calibre", "caliber"), ("cancelled", "canceled"), ("capitalisations", "capitalizations"),
    ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"), ("copyright holder", "copyright owner"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("https", "http"), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("maximise", "maximize"),
    ("modelled", "modeled"), ("modelling", "modeling"), ("non commercial", "noncommercial"), ("offence", "offense"),
    ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"), ("per cent", "percent"),
    ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("signalling", "signaling"), ("sub license", "sublicense"), ("sublicence", "sublicense"), ("utilisation", "utilization"),
    ("whilst", "while"), ("wilful", "wilfull"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: every run of ASCII characters but line ends, letters and digits, of no-break spaces,
#: dashes, quotation marks and bullets is one space
PUNCTUATION = "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F\u00a0\u2010-\u2015\u2018-\u201f\u2022]+"
LINE_ENDS = " ?\n[ \n]*"
#: a line that only says whose copyright it is: the mark, then by or a year, or names and a year
COPYRIGHT_LINE = "^(copyright |c )+(by |[0-9]{4}|[a-z]+( [a-z]+)? [0-9]{4}).*$"


def canonical_lines(text: Column) -> Column:
    """The canonical form of each non-empty line of a text, copyright lines left out."""
    t = F.translate(text, UPPER + "\r\u2028\u2029", LOWER + "\n\n\n")
    t = F.regexp_replace(F.replace(t, F.lit("\u00a9"), F.lit(" c ")), PUNCTUATION, " ")

    def spelt(x: Column) -> Column:
        x = F.concat(F.lit(" "), F.trim(x), F.lit(" "))
        for a, b in SPELLINGS:
            x = F.replace(x, F.lit(f" {a} "), F.lit(f" {b} "))
        return F.trim(x)
    lines = F.transform(F.split(t, LINE_ENDS), spelt)
    return F.filter(lines, lambda x: (x != "") & ~x.rlike(COPYRIGHT_LINE))


def known_digests(spark: SparkSession, known=None) -> DataFrame:
    """(digest, license): one row for each known text, bounded by the list's length."""
    rows = spark.createDataFrame(list(known or KNOWN), "license string, text string")
    whole = F.array_join(canonical_lines(F.col("text")), " ")
    return rows.select(F.sha2(whole, 256).alias("digest"), "license").groupBy("digest").agg(
        F.min("license").alias("license"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known=None) -> DataFrame:
    """One row per document: ``id_col``, digest (SHA-256 of the canonical whole text),
    license (of the known text that the whole document equals, or null), n_notices (lines
    that equal a known text) and notices (their licenses, sorted, comma-joined).

    A null text counts as empty; an empty text, or one of copyright lines alone, has the
    digest of the empty text and no license.  Rows equal in id and text, and null ids, are
    reported each with the same result.  Other columns are ignored.  An empty table gives
    an empty result.
    """
    known_rows = F.broadcast(known_digests(docs.sparkSession, known))     # bounded: the list above
    lines = canonical_lines(text_of(text_col))
    rows = docs.select(F.col(id_col).alias("id"), lines.alias("lines")).select(
        "id", "lines", F.sha2(F.array_join("lines", " "), 256).alias("whole"))
    # the whole text (position -1) and every line, looked up by digest
    units = F.concat(F.array(F.struct(F.lit(-1).alias("pos"), F.col("whole").alias("digest"))),
                     F.transform("lines", lambda x, i: F.struct(i.alias("pos"), F.sha2(x, 256).alias("digest"))))
    hits = rows.select("id", "whole", F.explode(units).alias("unit")).select("id", "whole", "unit.*").join(
        known_rows, "digest", "left")
    is_whole = F.col("pos") == -1
    found = hits.groupBy("id", "whole").agg(
        F.count_if(is_whole).alias("rows"), F.max(F.when(is_whole, F.col("license"))).alias("license"),
        F.collect_set(F.when(~is_whole & F.col("license").isNotNull(), F.struct("pos", "license"))).alias("notices"))
    # equal rows were counted, not lost
    found = found.select("*", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))))
    return found.select(
        F.col("id").alias(id_col), F.col("whole").alias("digest"), "license",
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.sort_array(F.array_distinct(F.transform("notices", lambda n: n["license"]))), ",")
        .alias("notices"))


def scan_sql(table: str = "documents", known=None) -> str:
    """DuckDB SQL for :func:`scan` over ``table`` (doc_id, text)."""
    def q(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def canon(text: str) -> str:
        t = f"translate({text}, {q(UPPER)} || chr(13) || chr(8232) || chr(8233), {q(LOWER)} || repeat(chr(10), 3))"
        t = f"regexp_replace(replace({t}, chr(169), ' c '), {q(PUNCTUATION)}, ' ', 'g')"
        x = "' ' || trim(x, ' ') || ' '"
        for a, b in SPELLINGS:
            x = f"replace({x}, ' {a} ', ' {b} ')"
        lines = f"list_transform(regexp_split_to_array({t}, {q(LINE_ENDS)}), lambda x: trim({x}, ' '))"
        return f"list_filter({lines}, lambda x: x <> '' AND NOT regexp_matches(x, {q(COPYRIGHT_LINE)}))"

    values = ", ".join(f"({q(name)}, {q(text)})" for name, text in (known or KNOWN))
    return f"""
    WITH known AS (SELECT sha256(array_to_string({canon('t')}, ' ')) AS d, min(n) AS license
                   FROM (VALUES {values}) AS k(n, t) GROUP BY 1),
    rows AS (SELECT row_number() OVER () AS r, doc_id, {canon("coalesce(text, '')")} AS lines FROM {table}),
    wholes AS (SELECT r, doc_id, sha256(array_to_string(lines, ' ')) AS digest FROM rows),
    units AS (SELECT r, sha256(unnest(lines)) AS d FROM rows),
    hits AS (SELECT r, count(*) AS n, array_to_string(list_sort(list_distinct(list(license))), ',') AS notices
             FROM units JOIN known USING (d) GROUP BY r)
    SELECT w.doc_id, w.digest, k.license, coalesce(h.n, 0) AS n_notices, coalesce(h.notices, '') AS notices
    FROM wholes w LEFT JOIN known k ON k.d = w.digest LEFT JOIN hits h ON h.r = w.r"""
