"""License scans by canonical digest: texts are normalised as a whole and joined to the digests of known licences.

Normalising drops lines that are a licence's title, a copyright line (with a year, a mark, or a name alone) or "All rights reserved", lower-cases A-Z, unifies equivalent spellings, and turns everything that is neither
a letter, a digit nor non-ASCII into single spaces. The whole text is looked up, and so is each of its lines by itself,
for the one-line notices that documents carry. With the table below, only text that names a word which every known licence
has is hashed; with a caller's table, all text is.

Defined results: null and empty texts, and texts without a match, have no licence (null) and no notices (empty
string); rows are told apart by a row number, so repeated rows are rows of their own with equal results; other columns are not read.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lines that only name a licence or its version (after lower-casing).
TITLES = (
    r"(the )?mit license( \(mit\))?", r"(the )?isc license( \(iscl?\))?", r"(the )?(new |modified |simplified |revised )?bsd ([23][- ]clause )?license", r"(the )?zlib license", r"(the )?unlicense",
    r"apache license(, version 2\.0)?", r"version 2\.0, january 2004", r"https?://www\.apache\.org/licenses/", r"gnu (lesser )?general public license", r"version (2, june 1991|2\.1, february 1999|3, 29 june 2007)",
    r"mozilla public license,? (version )?2\.0", r"creative commons legal code", r"cc0 1\.0 universal",
)
#: Lines that say whose copyright it is: with a year or a mark, or with nothing but a name. A line of a licence that merely begins with the word stays.
OWNER = r"(?i:copyright|copr\.|\(c\))[^\n]*(?:\([cC]\)|©|[12][0-9]{3}|[yY]{4}|(?i:<year>|\[year\]))[^\n]*|©[^\n]*|Copyright(?:[ \t]+(?:by|the|of|and|[A-Z][a-z][^ \t\n]*)){1,9}[ \t\r]*"
COPYRIGHT = rf"(?m)^[ \t]*(?:{OWNER}|(?i:all rights reserved\.?|{'|'.join(TITLES)})[ \t\r]*)$"
OTHER = r"[^a-z0-9\x{80}-\x{10FFFF}]+"
#: Every known text has one of these after lower-casing.
KEYWORDS = r"(licen[sc]e|permission|redistribution|warrant|public domain)"
#: Equivalent spellings, applied to the words of a text in this order.
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("favour", "favor"),
    ("copyright holder", "copyright owner"),
    ("https", "http"),
    (" per cent ", " percent "),
)
#: Texts of known licences and notices.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense-notice": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-notice": "Released under the MIT License.",
    "CC-BY-NC-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-ND-notice": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-notice": "Licensed under CC BY-SA 4.0.",
    "public-domain-notice": "This work is in the public domain.",
}
#: Licences with a file of their own: Apache-2.0, BSD-3-Clause-UC, CC0-1.0, GPL-2.0, GPL-3.0, LGPL-2.1, LGPL-3.0, MPL-2.0, Unlicense; "-terms" is one without what follows its terms.
KNOWN |= {p.stem: p.read_text() for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
END = "END OF TERMS AND CONDITIONS"
KNOWN |= {f"{k}-terms": v[: v.index(END) + len(END)] for k, v in KNOWN.items() if END in v}
KNOWN["BSD-3-Clause"] = KNOWN["BSD-2-Clause"].replace("THIS SOFTWARE IS", "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\nTHIS SOFTWARE IS", 1)


def normalised(text: Column) -> Column:
    """The words of a text in one spelling, between single spaces."""
    t = F.translate(F.regexp_replace(text, COPYRIGHT, ""), UPPER, LOWER)
    t = F.regexp_replace(t, OTHER, " ")
    for old, new in SPELLINGS:
        t = F.replace(t, F.lit(old), F.lit(new))
    return F.trim(t)


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def known(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """digest, license of the known texts."""
    rows = spark.createDataFrame(sorted((texts or KNOWN).items()), "license string, body string")
    return rows.select(digest(F.col("body")).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license"))


def report(docs: DataFrame, licences: DataFrame | None = None) -> DataFrame:
    """doc_id, license_id of the whole text, notices (licences that lines are, comma-joined) of each row. The table of known digests has a fixed size and is broadcast."""
    table = known(docs.sparkSession) if licences is None else licences
    likely = lambda t: F.translate(t, UPPER, LOWER).rlike(KEYWORDS) if licences is None else t.isNotNull()
    named = likely(F.col("text"))
    lines = F.filter(F.split("text", "\n", -1), likely)
    digests = F.array_distinct(F.transform(lines, digest))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("key"), F.when(named, digest(F.col("text"))).alias("whole"), F.when(named, digests).alias("lines"))
    rows = common.written(rows)
    parts = F.concat(F.array(F.struct(F.col("whole").alias("digest"), F.lit(True).alias("whole"))), F.transform("lines", lambda d: F.struct(d.alias("digest"), F.lit(False).alias("whole"))))
    hits = rows.where("lines is not null").select("key", F.explode(parts).alias("p")).select("key", "p.*").join(F.broadcast(table), "digest")
    by = hits.groupBy("key").agg(F.min(F.when(F.col("whole"), F.col("license"))).alias("license_id"), F.array_join(F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("license")))), ",").alias("notices"))
    return rows.select("doc_id", "key").join(by, "key", "left").select("doc_id", "license_id", F.coalesce("notices", F.lit("")).alias("notices"))


def oracle() -> str:
    """The same rows in DuckDB SQL."""

    def norm(t: str) -> str:
        t = f"regexp_replace(translate(regexp_replace({t}, '{COPYRIGHT}', '', 'g'), '{UPPER}', '{LOWER}'), '{OTHER}', ' ', 'g')"
        for old, new in SPELLINGS:
            t = f"replace({t}, '{old}', '{new}')"
        return f"sha256(trim({t}))"

    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(KNOWN.items()))
    named = f"regexp_matches(translate({{}}, '{UPPER}', '{LOWER}'), '{KEYWORDS}')"
    return f"""
WITH known AS (SELECT {norm('body')} AS digest, min(license) AS license FROM (VALUES {values}) v(license, body) GROUP BY 1),
lines AS (SELECT DISTINCT doc_id, license FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) l JOIN known ON {norm('line')} = digest WHERE {named.format('line')})
SELECT d.doc_id, k.license AS license_id, coalesce(n.notices, '') AS notices
FROM documents d LEFT JOIN known k ON {named.format('d.text')} AND {norm('d.text')} = k.digest
LEFT JOIN (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS notices FROM lines GROUP BY 1) n ON d.doc_id = n.doc_id"""
