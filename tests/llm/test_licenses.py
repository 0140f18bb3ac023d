"""License scans: spellings, whole texts and lines, and the SQL version."""

import re

import duckdb

from geoloom.llm import licenses


def test_every_known_text_has_a_keyword():
    assert all(re.search(licenses.KEYWORDS, t.lower()) for t in licenses.KNOWN.values())


def test_variants_match_and_others_do_not(spark):
    mit = licenses.KNOWN["MIT"]
    rows = [
        (1, mit), (2, "Copyright (c) 2019 Someone\n\n" + mit.upper().replace(",", " ,")), (3, mit.replace("sublicense", "sub-licence").replace("NONINFRINGEMENT", "NON-INFRINGEMENT")),
        (4, mit + " more"), (5, "Some text.\nreleased under the MIT licence\nLicensed under CC BY-NC 4.0!"), (6, None), (7, ""), (7, "license"), (8, "x" * 10000),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as digest", "2 as key")
    got = sorted((r.doc_id, r.license_id, r.notices) for r in licenses.report(df).collect())
    assert got[0][1:] == got[1][1:] == got[2][1:] == ("MIT", "")
    assert got[3][1] is None and got[4] == (5, None, "CC-BY-NC-notice,MIT-notice")
    assert got[5:] == [(6, None, ""), (7, None, ""), (7, None, ""), (8, None, "")]
    assert licenses.report(df.limit(0)).count() == 0


def test_sql_gives_the_same_rows(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{d}/documents.parquet'")
    want = sorted(con.sql(licenses.oracle()).fetchall(), key=str)
    got = sorted(((r.doc_id, r.license_id, r.notices) for r in licenses.report(spark.read.parquet(f"{d}/documents.parquet")).collect()), key=str)
    assert got == want and any(r[2] for r in got)
