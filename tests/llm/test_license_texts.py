"""Whole licence files, and tables that callers pass."""

import textwrap

import duckdb

from geoloom.llm import licenses


def test_whole_files_match_with_and_without_title(spark):
    k = licenses.KNOWN
    head = "MIT License\n\nCopyright (c) 2020 Someone\nAll rights reserved.\n\n"
    rows = [(1, head + k["MIT"], "MIT"), (2, k["Unlicense"], "Unlicense"), (3, "The Unlicense\n\n" + k["Unlicense"], "Unlicense"), (4, "BSD 3-Clause License\n\nCopyright 2020, X\n\n" + k["BSD-3-Clause"], "BSD-3-Clause"), (5, "MIT License", None)]
    for i, name in enumerate(("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0")):
        lines = k[name].strip().split("\n")
        rows += [(10 + i, k[name], name), (30 + i, "\n".join(lines[2:]).replace("\n", "\r\n"), name)]
    got = {r.doc_id: r.license_id for r in licenses.report(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    assert got == {d: want for d, _, want in rows}


def test_a_caller_s_table_needs_no_keyword(spark):
    table = licenses.known(spark, {"beer": "Buy me a beer."})
    df = spark.createDataFrame([(1, "BUY me a beer"), (2, "x\nbuy me a beer!\ny"), (3, None)], "doc_id long, text string")
    assert sorted(tuple(r) for r in licenses.report(df, table).collect()) == [(1, "beer", "beer"), (2, None, "beer"), (3, None, "")]


#: As published, wrapped, with a line that begins with the word copyright.
ISC = """ISC License

Copyright (c) 2004-2010 by Some Consortium, Inc. ("SC")

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""


def planted():
    k, rewrapped = licenses.KNOWN, lambda t, n: "\n".join(textwrap.fill(p, n) for p in t.split("\n"))
    rows = [(1, ISC, "ISC"), (2, ISC.replace("Copyright (c) 2004-2010 by Some Consortium, Inc. (\"SC\")", "Copyright Some Body and Others"), "ISC"), (3, "© Someone\n" + k["MIT"], "MIT"), (4, "Copyright\n" + k["MIT"], None), (5, "Copyright notice of Someone\n" + k["Zlib"], None)]
    for n in (40, 61, 72, 78):  # wherever lines break, and so whichever of them begins with the word
        rows += [(100 * n + i, f"Copyright 2021 The {name} Authors\n\n" + rewrapped(k[name], n), name) for i, name in enumerate(("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Zlib"))]
    return rows + [(9, "many words " * 200_000 + "licence", None), (3, "© Someone\n" + k["MIT"], "MIT")]


def test_wrapped_texts_match_whichever_line_begins_with_the_word(spark):
    rows = planted()
    got = sorted((r.doc_id, r.license_id or "") for r in licenses.report(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect())
    assert got == sorted((d, want or "") for d, _, want in rows)


def test_sql_gives_the_same_rows_over_planted_texts(spark):
    rows = [r for r in planted() if r[0] != 3]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [list(r[:2]) for r in rows])
    want = sorted(con.sql(licenses.oracle()).fetchall(), key=str)
    got = sorted((tuple(r) for r in licenses.report(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()), key=str)
    assert got == want and sum(r[1] is not None for r in got) > 20
