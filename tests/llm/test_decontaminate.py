"""Decontamination against a brute-force version."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from geoloom.llm import decontaminate


def norm(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return [(m.group(), m.span()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)]


def brute(docs, items):
    out = {}
    for d, t in docs:
        w = [x for x, _ in norm(t)]
        hit, ids = set(), set()
        for i, q in items:
            v = [x for x, _ in norm(q)]
            for k in range(max(1, len(v) - 9)) if v else []:
                win = v[k : k + 10]
                for p in range(len(w) - len(win) + 1):
                    if w[p : p + len(win)] == win:
                        hit |= set(range(p, p + len(win)))
                        ids.add(str(i))
        out[d] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))
    return out


def made():
    r = random.Random(2)
    v = [f"w{i}" for i in range(40)] + ["Été", "naïve", "日本", "x_y", "A1"]
    items = [(i, " ".join(r.choice(v) for _ in range(r.choice((3, 9, 10, 25))))) for i in range(12)]
    items += [(20, items[0][1].upper()), (21, None), (22, "... --"), (23, "")]
    docs = [(0, None), (1, ""), (2, "-- !!")]
    for d in range(3, 60):
        w = [r.choice(v) for _ in range(r.choice((5, 60, 300)))]
        for _ in range(r.randrange(3)):
            q = (r.choice(items)[1] or "").split()
            k = r.randrange(len(w))
            w[k:k] = q[r.randrange(3) :]
        docs.append((d, r.choice((" ", ", ", "\n", " \x00")).join(w)))
    return docs, items


def test_report_matches_brute_force(spark):
    docs, items = made()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 150):
        rows = decontaminate.report(df, bench, block_bytes=block).collect()
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows}
        assert got == brute(docs, items)
        texts = dict(docs)
        for r in rows:
            assert sum(len(norm(texts[r.doc_id][s.start : s.end])) for s in r.spans) == r.n_hit


def test_sql_matches(spark, tmp_path):
    import duckdb

    docs, items = made()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "b"))
    con = duckdb.connect()
    for n, at in (("documents", "d"), ("benchmark", "b")):
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM '{tmp_path}/{at}/*.parquet'")
    rows = con.sql(decontaminate.oracle())
    at = {c: i for i, c in enumerate(rows.columns)}
    assert {r[at["doc_id"]]: tuple(r[at[c]] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in rows.fetchall()} == brute(docs, items)


def test_long_and_repeated_texts(spark):
    """A text of 300,000 words with a passage at either end, and the same row three times, with blocks that share it."""
    docs, items = made()
    long = f"{items[2][1]} {'w1 zz ' * 150_000} {items[3][1]}"
    rows = [(1, long), (2, items[2][1]), (2, items[2][1]), (2, items[2][1])]
    for block in (1 << 20, 150):
        got = decontaminate.report(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block).collect()
        want = brute(rows[1:2] + [(1, f"{items[2][1]} zz zz {items[3][1]}")], items)
        assert sorted(r.doc_id for r in got) == [1, 2, 2, 2]
        assert all((r.n_hit, r.n_items, r.items_sha256) == want[r.doc_id][1:4] for r in got)


def test_empty_tables_and_clashing_names(spark):
    docs, items = made()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.report(df.limit(0), bench).count() == 0
    assert decontaminate.report(df, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.scanned(df.withColumn("items", F.lit(1)).withColumn("spans", F.lit("x")), bench).where("size(items) > 0").count() > 0
