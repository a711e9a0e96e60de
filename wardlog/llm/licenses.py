"""Licence scans: canonical digests of whole texts, and of single lines, joined to known ones.

Two texts are the same licence when their canonical forms are equal: letters A-Z lower-cased,
copyright lines removed (but not lines that merely begin with the word, as wrapped terms do), typographic quotes and
punctuation turned into blanks, a leading title line such as "The MIT License (MIT)" dropped, runs of blanks
collapsed, and equivalent spellings unified. Only the 256-bit digests of canonical forms meet in
the join, so no text is shuffled and nothing is compared pair by pair. Column expressions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlog.llm.common import texts
from wardlog.session import materialize

# Equivalent spellings, unified from left to right after punctuation is gone.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("per cent", "percent"),
    ("copyright owner", "copyright holder"), ("acknowledgement", "acknowledgment"), ("favour", "favor"),
    ("organisation", "organization"), ("behaviour", "behavior"), ("analogue", "analog"), ("judgement", "judgment"),
    ("labour", "labor"), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("recognise", "recognize"),
    ("merchantibility", "merchantability"), ("https", "http"),
)
TYPOGRAPHIC = "“”‘’–—«»• "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words before which "copyright" is part of running text, so that its line is no copyright line.
RUNNING = "notice|holder|owner|law|licen[cs]e|interest|statement|disclaimer|treat|protect|infring|and|or|in|is|on|to|the work"
WRAPPED = f"\\n[^\\na-z0-9]*(copyright (?:{RUNNING}))"
COPYRIGHT_LINE = "\\n[^\\na-z0-9]*(?:copyright|©|all rights reserved|\\(c\\)(?: copyright|[^\\n]*[0-9]{4}))[^\\n]*"
TITLE_LINE = ("^[ \\n]*(?:the )?(?:new |modified |revised |simplified |[234] clause )?(?:mit|isc|bsd|zlib|x11)"
              "(?: [234] clause)?(?: license| licence)?(?: mit| isc| x11| bsd| [234] clause| new| revised| simplified)* *\\n")
PUNCTUATION = "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# Public licence texts and the notices by which files refer to them.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the terms of
the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)
# SHA-256 of the canonical forms of whole licence files as published.
DIGESTS = (
    ("0BSD", "25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c"),
    ("Apache-2.0", "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b"),
    ("Apache-2.0", "6aa661403864282a4d084f1551e8149a5f1a7b5e8b05b6db8e1a8a28d0badc64"),
    ("Apache-2.0", "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe"),
    ("Artistic-1.0-Perl", "687e166aefc4fff2545711af3d6844374ff13fb25aa48d3861a3b56361f815a3"),
    ("BSD-2-Clause", "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("BSD-3-Clause", "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b"),
    ("GFDL-1.3", "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d"),
    ("GPL-1.0", "9e12a40a9b22c45d116f19e1746b08ea0b853519de3e03ceb780f2a36d5f388c"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "9085ee283b8c84517846c5acafee37391c28bb825b7ecec4aaa90768f2f283b0"),
    ("LGPL-2.0", "5b313222545879140519fc4f8ac7558088e9529f29bda08d2b75946987652f50"),
    ("LGPL-2.1", "6ce9e9dc5005db9536b303ace5104e7d79eb77fa76f5ca2e335ea6401497ea1e"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6"),
    ("MPL-2.0", "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
    ("PSF-2.0", "8295946602d6bebee344262714363fd035c5c857480438c14f2d11126b59034f"),
    ("Zlib", "1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7"),
)
CATALOGUE = "license_id string, text string, canonical_sha256 string"


def catalogue(spark: SparkSession) -> DataFrame:
    """The texts and digests shipped here. Any frame with ``license_id`` and ``text`` will do instead; where it has a
    ``canonical_sha256``, that stands for the text."""
    texts_known = [(name, text, None) for name, text in KNOWN]
    return spark.createDataFrame([*texts_known, *[(name, None, digest) for name, digest in DIGESTS]], CATALOGUE)


def without_marks(text: Column) -> Column:
    """Lower-cased text without copyright lines, title line and punctuation; other line feeds stay."""
    plain = F.translate(F.translate(text, UPPER, LOWER), TYPOGRAPHIC, " " * len(TYPOGRAPHIC))
    joined = F.regexp_replace(F.concat(F.lit("\n"), plain), WRAPPED, " $1")
    kept = F.regexp_replace(F.regexp_replace(joined, COPYRIGHT_LINE, ""), PUNCTUATION, " ")
    return F.regexp_replace(kept, TITLE_LINE, "\n")


def spelled(plain: Column) -> Column:
    """One canonical form from marks-free text: single blanks, unified spellings."""
    single = F.trim(F.regexp_replace(plain, "[ \\n]+", " "))
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, single)


def canonical(text: Column) -> Column:
    return spelled(without_marks(text))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Per row: digest of the whole canonical text, its licence, and licences of single lines.

    Result: ``doc_id, canonical_sha256, license_id`` (null: the text is no known licence),
    ``notices`` (distinct licences of lines, sorted, joined by commas, '' if none) and
    ``n_notice_lines``. A null text counts as empty; an empty form matches nothing. If a digest has
    several licences, the alphabetically first wins. Repeated rows stay repeated.
    """
    given = F.col("canonical_sha256") if "canonical_sha256" in known.columns else F.lit(None).cast("string")
    digests = known.select("license_id", given.alias("given"), canonical(F.coalesce("text", F.lit(""))).alias("form"))
    digests = digests.where("form <> '' or given is not null").groupBy(
        F.coalesce("given", F.sha2("form", 256)).alias("digest")).agg(F.min("license_id").alias("license_id"))
    rows = texts(docs).select("doc_id", without_marks(F.coalesce("text", F.lit(""))).alias("plain"))
    forms = F.filter(F.transform(F.split("plain", "\n"), spelled), lambda c: c != "")
    # Texts are read and normalised once; from here on only digests are kept.
    rows = materialize(rows.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", F.sha2(spelled(F.col("plain")), 256).alias("canonical_sha256"),
        F.transform(forms, lambda c: F.unhex(F.sha2(c, 256))).alias("lines")), "canonical-digests")
    lines = rows.select("row_id", F.explode("lines").alias("line"))
    found = lines.join(digests.select(F.unhex("digest").alias("line"), "license_id"), "line").groupBy("row_id").agg(
        F.array_join(F.sort_array(F.collect_set("license_id")), ",").alias("notices"), F.count(F.lit(1)).alias("n"))
    whole = rows.drop("lines").join(digests.withColumnRenamed("digest", "canonical_sha256"), "canonical_sha256", "left")
    return whole.join(found, "row_id", "left").select(
        "doc_id", "canonical_sha256", "license_id", F.coalesce("notices", F.lit("")).alias("notices"),
        F.coalesce("n", F.lit(0)).alias("n_notice_lines"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def duckdb_sql(table: str = "documents") -> str:
    """The scan as DuckDB SQL, for checking."""
    def marks(text: str) -> str:
        plain = f"translate(translate({text}, '{UPPER}', '{LOWER}'), {_quoted(TYPOGRAPHIC)}, '{' ' * len(TYPOGRAPHIC)}')"
        joined = f"regexp_replace(chr(10) || {plain}, {_quoted(WRAPPED)}, ' \\1', 'g')"
        kept = f"regexp_replace(regexp_replace({joined}, {_quoted(COPYRIGHT_LINE)}, '', 'g'), {_quoted(PUNCTUATION)}, ' ', 'g')"
        return f"regexp_replace({kept}, {_quoted(TITLE_LINE)}, chr(10))"

    def spell(plain: str) -> str:
        single = f"trim(regexp_replace({plain}, '[ \\n]+', ' ', 'g'))"
        return reduce(lambda c, pair: f"replace({c}, '{pair[0]}', '{pair[1]}')", SPELLINGS, single)

    known = ", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in KNOWN)
    published = ", ".join(f"({_quoted(i)}, {_quoted(d)})" for i, d in DIGESTS)
    return f"""
with digests as (
  select sha256(form) as digest, min(license_id) as license_id
  from (select license_id, {spell(marks('text'))} as form from (values {known}) k(license_id, text)) where form <> '' group by 1
  union all select digest, min(license_id) from (values {published}) p(license_id, digest) group by 1),
docs as (select row_number() over () as row_id, doc_id, {marks("coalesce(text, '')")} as plain from {table}),
whole as (select row_id, doc_id, sha256({spell('plain')}) as canonical_sha256 from docs),
lines as (select row_id, {spell('line')} as form from (select row_id, unnest(string_split(plain, chr(10))) as line from docs)),
found as (select row_id, string_agg(distinct license_id, ',' order by license_id) as notices, count(*) as n
  from lines join digests on sha256(form) = digest where form <> '' group by 1)
select doc_id, canonical_sha256, license_id, coalesce(notices, '') as notices, coalesce(n, 0) as n_notice_lines
from whole left join digests on digest = canonical_sha256 left join found using (row_id)
"""
