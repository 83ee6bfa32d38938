"""Licence scan by canonical digest lookup, in DataFrame functions only.

A text is put in canonical form: lower case, copyright lines left out, punctuation and white
space as single blanks, equivalent spellings as one. The digest of the whole canonical text, and of each
whole canonical line, is hash-joined to the digests of known licence texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import Scratch, fresh_name

# fixed values: equivalent spellings in licence texts, and the one they are read as
SPELLINGS = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("copyright holder", "copyright owner"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("honour", "honor"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licences", "licenses"),
    ("merchantibility", "merchantability"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("offence", "offense"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("recognise", "recognize"),
    ("sub license", "sublicense"),
    ("sublicence", "sublicense"),
    ("whilst", "while"),
    ("wilful", "willful"),
]

# fixed values: published licence texts and the notices that stand for a licence
KNOWN = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
]

# fixed values: lines of a notice that name holders, not terms; a line of terms may begin with the word as well, and with
# its sign as the third clause of a list: that is a notice only before a year, the word or "by"
_YEAR = r"[<\[{]?(?:\d{4}|year\b|yyyy\b)"
NOTICE = (rf"^[ \t]*(?:copyright[ \t]*:?[ \t]*(?:\(c\)|©|by\b|{_YEAR})[^\n]*"
          rf"|\(c\)[ \t]*(?:copyright\b|by\b|{_YEAR})[^\n]*|©[^\n]*|all rights reserved[ \t\r.]*)$")
# lines end at line feeds alone, in Java as in the SQL
COPYRIGHT_LINE, SQL_COPYRIGHT_LINE = "(?dm)" + NOTICE, "(?m)" + NOTICE
SEPARATORS = r"[^\p{L}\p{N}\n]+"
# the widest spellings first, so that none is cut by a shorter one
_ORDERED = sorted(SPELLINGS, key=lambda p: (-len(p[0]), p[0]))
_ANY_SPELLING = r"\b(?:" + "|".join(a for a, _ in _ORDERED) + r")\b"
# spellings of several words, which a line feed may part
_WIDE = [p for p in _ORDERED if " " in p[0]]


def canonical_lines(text: Column) -> Column:
    """The text in canonical form, still with its line feeds; null becomes empty."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    plain = F.regexp_replace(plain, SEPARATORS, " ")
    spelt = plain
    for old, new in _ORDERED:
        spelt = F.regexp_replace(spelt, rf"\b{old}\b", new)
    return F.when(plain.rlike(_ANY_SPELLING), spelt).otherwise(plain)


def joined_lines(lines: Column) -> Column:
    joined = F.trim(F.regexp_replace(lines, r"[ \n]+", " "))
    for old, new in _WIDE:
        joined = F.regexp_replace(joined, rf"\b{old}\b", new)
    return joined


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """``digest, license_id, size``: the known texts, canonical; one row a digest (least id)."""
    texts = spark.createDataFrame(known, "license_id string, text string")
    whole = joined_lines(canonical_lines(F.col("text")))
    return (texts.select("license_id", whole.alias("c")).where("c <> ''")
            .groupBy(F.sha2("c", 256).alias("digest")).agg(F.min("license_id").alias("license_id"), F.min(F.length("c")).alias("size")))


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text", known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``digest`` (SHA-256 of the whole canonical text), ``license_id`` (the
    licence that the whole text is, or null), ``line_licenses`` (sorted ids of whole lines, comma between) and
    ``license_lines`` (their number).

    Null and empty texts have the digest of the empty text and no licence. Lines without letters or digits are no
    licence. Rows that repeat get equal results; rows that agree in key and text are one document. An empty table gives
    no rows. Result columns whose name the input has get underscores. ``known`` is a fixed list of the caller: its table
    is as small whatever the data, and broadcast for that.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "licenses")
    rest = [c for c in docs.columns if c != text]
    digest, one, many, count = (fresh_name(rest, n) for n in ("digest", "license_id", "line_licenses", "license_lines"))
    table = F.broadcast(known_digests(spark, known))
    sizes = sorted({r["size"] for r in known_digests(spark, known).select("size").collect()})  # len(known) numbers at most
    lines = canonical_lines(F.col(text))
    # a line can only be a known text if it is as long as one
    maybe = F.filter(F.transform(F.split(lines, "\n", -1), lambda x: F.trim(x)), lambda x: F.length(x).isin(sizes) if sizes else F.lit(False))
    base = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)], F.col(key).alias("k"), F.xxhash64(text).alias("h"),
                       lines.alias("lines"))
    base = scratch.table(base.select("*", F.sha2(joined_lines(F.col("lines")), 256).alias("d"),
                                     F.filter(F.transform(F.split("lines", "\n", -1), lambda x: F.trim(x)),
                                              lambda x: F.length(x).isin(sizes) if sizes else F.lit(False)).alias("maybe")).drop("lines"))
    found = (base.select("k", "h", F.posexplode("maybe").alias("pos", "line")).select("k", "h", "pos", F.sha2("line", 256).alias("digest"))
             .join(table, "digest").dropDuplicates(["k", "h", "pos"]).groupBy("k", "h")
             .agg(F.array_join(F.sort_array(F.collect_set("license_id")), ",").alias("ids"), F.count(F.lit(1)).alias("n")))
    named = base.join(table.select(F.col("digest").alias("d"), F.col("license_id").alias("whole")), "d", "left").alias("b")
    out = named.join(found.alias("f"), F.col("b.k").eqNullSafe(F.col("f.k")) & (F.col("b.h") == F.col("f.h")), "left")
    return out.select(*[F.col(f"b.c{i}").alias(c) for i, c in enumerate(rest)], F.col("b.d").alias(digest), F.col("b.whole").alias(one),
                      F.coalesce("f.ids", F.lit("")).alias(many), F.coalesce("f.n", F.lit(0)).cast("bigint").alias(count))


def scan_sql(known: list[tuple[str, str]] = KNOWN) -> str:
    """DuckDB SQL of ``license_scan`` over ``documents (doc_id, text)``."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def lines(text: str) -> str:
        out = f"regexp_replace(lower(coalesce({text}, '')), {quoted(SQL_COPYRIGHT_LINE)}, '', 'g')"
        out = f"regexp_replace({out}, {quoted(SEPARATORS)}, ' ', 'g')"
        for old, new in _ORDERED:
            out = f"regexp_replace({out}, '\\b{old}\\b', {quoted(new)}, 'g')"
        return out

    def joined(of: str) -> str:
        out = f"trim(regexp_replace({of}, '[ \\n]+', ' ', 'g'))"
        for old, new in _WIDE:
            out = f"regexp_replace({out}, '\\b{old}\\b', {quoted(new)}, 'g')"
        return out

    values = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in known)
    return f"""
WITH known AS (
  SELECT digest, min(license_id) AS license_id FROM (
    SELECT license_id, {joined(lines('text'))} AS c FROM (VALUES {values}) AS v(license_id, text))
  , LATERAL (SELECT sha256(c) AS digest) WHERE c <> '' GROUP BY digest),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {lines('text')} AS ls FROM documents),
whole AS (SELECT r, doc_id, sha256({joined('ls')}) AS digest FROM d),
l AS (SELECT r, sha256(trim(unnest(string_split(ls, chr(10))))) AS digest FROM d),
hit AS (SELECT r, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids, count(*) AS n
        FROM l JOIN known USING (digest) GROUP BY r)
SELECT w.doc_id, w.digest, k.license_id, coalesce(h.ids, '') AS line_licenses, coalesce(h.n, 0)::BIGINT AS license_lines
FROM whole w LEFT JOIN known k USING (digest) LEFT JOIN hit h USING (r)"""
